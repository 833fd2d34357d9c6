"""Fit a preparation on train / validation / scoring tables, and apply it to new ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.operators.clean import (
    decimal_to_float,
    drop_columns,
    fill_missing,
    final_projection,
    require_features,
)
from featurelab.operators.dedup import dedup, dedup_splits
from featurelab.operators.dominant import dominant_ratio
from featurelab.operators.encode import apply_encoding, fit_encoder
from featurelab.operators.sampling import ROW_ID, identify_rows, rebalance, sample_to
from featurelab.operators.scale import DEFAULT_BINS, QUANTILES, apply_scaler, fit_scaler
from featurelab.operators.selectors import (
    AdversarialSettings,
    CorrelationSettings,
    ForwardSettings,
    NoiseSettings,
    PermutationSettings,
    SelectorResult,
    drop_adversarial,
    drop_correlated,
    select_forward,
    select_noise,
    select_permutation,
)
from featurelab.operators.selectors.base import settings_from
from featurelab.operators.splits import Splits, classify, match_types, settle_types
from featurelab.plans.config import Config
from featurelab.plans.state import State, load_state, save_state
from featurelab.sources.scratch import Scratch, stage
from featurelab.sources.sinks import result_name, save_splits, scoring_base, write_report, write_table


@dataclass(frozen=True)
class Progress:
    splits: Splits
    state: State


Step = Callable[[Progress, Config], Progress]


def _drop(progress: Progress, step: str, names) -> Progress:
    names = tuple(names)
    if not names:
        return progress
    return Progress(drop_columns(progress.splits, names), progress.state.with_dropped(step, names))


def drop_forced_step(p: Progress, cfg: Config) -> Progress:
    return _drop(p, "drop_forced_cols", cfg.force_drop)


def decimal_step(p: Progress, cfg: Config) -> Progress:
    return replace(p, splits=p.splits.map(lambda df: decimal_to_float(df, cfg.skip)))


def fill_step(p: Progress, cfg: Config) -> Progress:
    values = cfg.section("missing_values")
    state = replace(p.state, fill_numeric=values["numeric"], fill_categorical=values["categorical"])
    return Progress(p.splits.map(lambda df: _fill(df, state)), state)


def _fill(df: DataFrame, state: State) -> DataFrame:
    return fill_missing(df, state.inputs, state.fill_numeric, state.fill_categorical)


def uninformative_step(p: Progress, cfg: Config) -> Progress:
    """Train alone decides; the columns go everywhere."""
    features = p.state.roles.features
    found = dominant_ratio(p.splits.train, features, cfg.section("drop_uninformative")["threshold"])
    names = {r.feature_name for r in found.select("feature_name").collect()}
    return _drop(p, "drop_uninformative", [c for c in features if c in names])


def dedup_step(p: Progress, cfg: Config) -> Progress:
    splits = dedup_splits(
        p.splits,
        cfg.dedup_subset,
        cfg.row_key,
        scoring=bool(cfg.section("deduplicate").get("scoring")),
        staged=_fits_on_tables(cfg, "deduplicate"),
    )
    return Progress(splits, replace(p.state, dedup_subset=tuple(cfg.dedup_subset)))


def _sample_for_fit(df: DataFrame, cfg: Config, size: int | None) -> DataFrame:
    if not size:
        return df
    known = identify_rows(df, cfg.row_key, by_content=cfg.by_content)
    return sample_to(known.df, known.keys, size, known.count, "fit-sample")


def encoding_step(p: Progress, cfg: Config) -> Progress:
    columns = list(p.state.roles.categorical)
    if not columns:
        return p
    section = cfg.section("categorical_encoding")
    method = section["method"]
    sample = _sample_for_fit(p.splits.train, cfg, section.get("sample_size"))
    encoder = fit_encoder(sample, columns, method, cfg.row_key, cfg.target)
    train = p.splits.train
    aligned = p.splits.map(lambda df: df if df is train else match_types(df, train))
    splits = aligned.map(lambda df: apply_encoding(df, encoder, columns, method))
    roles = p.state.roles.as_numeric(columns) if method == "target_encoder" else p.state.roles
    return Progress(splits, replace(p.state, roles=roles, encoding=method, encoder=encoder))


def scaling_step(p: Progress, cfg: Config) -> Progress:
    columns = list(p.state.roles.numeric)
    if not columns:
        return p
    section = cfg.section("scaling")
    sample = _sample_for_fit(p.splits.train, cfg, section.get("sample_size"))
    scaler = fit_scaler(
        sample,
        columns,
        section["method"],
        bins=section.get("bins", DEFAULT_BINS),
        n_quantiles=section.get("n_quantiles", QUANTILES),
        exact=section.get("exact_quantiles", True),
    )
    return Progress(p.splits.map(lambda df: apply_scaler(df, scaler)), replace(p.state, scaler=scaler))


def _selector_step(name: str, select: Callable, settings: type, numeric_only: bool = False) -> Step:
    """Selectors see all features once categories are encoded, before that the numeric ones."""

    def step(p: Progress, cfg: Config) -> Progress:
        roles = p.state.roles
        every = p.state.encoder is not None and not numeric_only
        features = roles.features if every else roles.numeric
        if not features:
            return p
        section = dict(cfg.section(name))
        if cfg.artifacts and "history_path" in {f.name for f in fields(settings)}:
            section["history_path"] = f"{cfg.artifacts}/reports/{name}_history"
        chosen = settings_from(settings, section)
        result: SelectorResult = select(p.splits, roles, features, chosen, cfg.task, cfg.row_key)
        if cfg.artifacts:
            for report, table in result.reports.items():
                fmt = "json" if report == "history" else "csv"
                write_report(table, f"{cfg.artifacts}/reports/{name}_{report}", fmt)
        return _drop(p, name, result.drop)

    return step


# The step names of a configuration.
STEPS: dict[str, Step] = {
    "drop_forced_cols": drop_forced_step,
    "convert_decimal": decimal_step,
    "fill_missing": fill_step,
    "drop_uninformative": uninformative_step,
    "deduplicate": dedup_step,
    "categorical_encoding": encoding_step,
    "scaling": scaling_step,
    "drop_correlated": _selector_step("drop_correlated", drop_correlated, CorrelationSettings, True),
    "drop_adversarial": _selector_step("drop_adversarial", drop_adversarial, AdversarialSettings),
    "noise_selection": _selector_step("noise_selection", select_noise, NoiseSettings),
    "forward_selection": _selector_step("forward_selection", select_forward, ForwardSettings),
    "permutation_selection": _selector_step(
        "permutation_selection", select_permutation, PermutationSettings
    ),
}

# Steps that run jobs over the tables; what comes before them is worth staging.
FITTING = set(STEPS) - {"drop_forced_cols", "convert_decimal", "fill_missing"}


def _fits_on_tables(cfg: Config, after: str | None = None) -> bool:
    """Whether any step, or any after the named one, runs jobs over the tables."""
    later = cfg.steps[cfg.steps.index(after) + 1 :] if after else cfg.steps
    return bool(FITTING.intersection(later))


def _reduce(df: DataFrame, cfg: Config, balance: bool, size: int | None) -> DataFrame:
    """Balance the classes, then sample down to about `size` rows.

    Both are filters. The result is written once if steps will fit on it, so that
    they do not scan the whole source again.
    """
    if not balance and not size:
        return df
    size = int(size or 0)
    known = identify_rows(df, cfg.row_key, cfg.target if balance else None, cfg.by_content)
    reduced, rows = known.df, known.count
    if balance:
        share = cfg.section("rebalancing").get("positive_frac", 1.0)
        reduced = rebalance(reduced, cfg.target, share, known.keys, classes=known.classes)
        rows = reduced.count() if size and reduced is not known.df else rows
    if size and size < rows:
        reduced = sample_to(reduced, known.keys, size, rows).drop(ROW_ID)
        return stage(reduced, "sample", size) if _fits_on_tables(cfg) else reduced
    reduced = reduced.drop(ROW_ID)
    return stage(reduced, "balanced") if balance and _fits_on_tables(cfg) else reduced


def shrink(splits: Splits, cfg: Config) -> Splits:
    """Rebalancing and sampling of train and validation, as configured; scoring stays whole."""
    apply_to = cfg.section("rebalancing").get("apply_to", "train")
    balanced = {"train": ("train",), "test": ("valid",), "both": ("train", "valid")}.get(apply_to, ())
    if "rebalancing" not in cfg.steps:
        balanced = ()
    sizes = cfg.sampling if cfg.sampling.get("use_sampling", False) else {}
    valid = splits.valid
    if valid is not None:
        valid = _reduce(valid, cfg, "valid" in balanced, sizes.get("test_sample_size"))
    return Splits(
        _reduce(splits.train, cfg, "train" in balanced, sizes.get("train_sample_size")), valid, splits.scoring
    )


def _output(df: DataFrame, state: State) -> DataFrame:
    """Final columns, computed values as float."""
    changed = set()
    if state.encoding == "target_encoder":
        changed.update(state.inputs.categorical)
    if state.scaler is not None:
        changed.update(r.feature for r in state.scaler.select("feature").collect())
    kept = final_projection(df, state.roles)
    casts = {c: F.col(c).cast("float") for c in kept.columns if c in changed and c in state.roles.features}
    return kept.withColumns(casts) if casts else kept


def run(splits: Splits, config: Mapping | str | Config) -> tuple[Splits, State]:
    """Rebalance, sample, classify the columns, take the configured steps in order,
    and save tables and state where the configuration says so."""
    cfg = Config.of(config)
    unknown = [s for s in cfg.steps if s not in STEPS and s != "rebalancing"]
    if unknown:
        raise ValueError(f"unknown steps: {unknown}")
    smaller = shrink(splits, cfg)
    forced = tuple(cfg.section("categorical_encoding").get("force_categorical") or ())
    roles = classify(smaller.train, cfg.index, cfg.target, cfg.skip, forced)
    progress = Progress(
        smaller.map(lambda df: settle_types(df, roles)),
        State(roles=roles, inputs=roles, steps=cfg.steps, row_key=cfg.row_key),
    )
    for name in cfg.steps:
        if name != "rebalancing":
            progress = STEPS[name](progress, cfg)
    state = progress.state
    out = progress.splits.map(lambda df: _output(df, state))
    if cfg.artifacts:
        save_state(out.train.sparkSession, state, cfg.artifacts)
    if cfg.result:
        save_splits(out, cfg.result)
    return out, state


def apply(df: DataFrame, state: State, deduplicate: bool | None = None) -> DataFrame:
    """The fitted steps on a new table, by the code that fitted them.

    Repeated rows go if the run deduplicated, unless `deduplicate` says otherwise.
    """
    steps = set(state.steps)
    df = settle_types(df, state.inputs)
    if "convert_decimal" in steps:
        df = decimal_to_float(df, state.inputs.skip)
    if "fill_missing" in steps:
        df = _fill(df, state)
    if "deduplicate" in steps if deduplicate is None else deduplicate:
        df = dedup(df, state.dedup_subset or [state.inputs.index], state.row_key)
    if state.encoder is not None:
        df = apply_encoding(df, state.encoder, list(state.inputs.categorical), state.encoding)
    if state.scaler is not None:
        df = apply_scaler(df, state.scaler)
    out = _output(df, state)
    require_features(out, state.roles.features)
    return out


class Preparation:
    """A configuration bound to a session: `fit` once, `transform` as often as needed.

    `close` deletes the intermediate tables of both; do so once their results are written.
    """

    def __init__(self, spark: SparkSession, config: Mapping | str) -> None:
        self.spark = spark
        self.config = Config.of(config)
        self.state: State | None = None
        self.scratch = Scratch(spark)

    def close(self) -> None:
        self.scratch.close()

    def fit(
        self, train: DataFrame, valid: DataFrame | None = None, scoring: DataFrame | None = None
    ) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
        with self.scratch:
            out, self.state = run(Splits(train, valid, scoring), self.config)
        return tuple(out)

    def transform(self, df: DataFrame, deduplicate: bool | None = None) -> DataFrame:
        """Apply the state of this fit, or the one saved at the configured place, and save the result."""
        if self.state is None:
            if not self.config.artifacts:
                raise FileNotFoundError("nothing was fitted and no artifact folder is configured")
            self.state = load_state(self.spark, self.config.artifacts)
        with self.scratch:
            out = apply(df, self.state, deduplicate)
        result = self.config.result
        if result:
            fmt = result.get("format_scoring", "parquet")
            suffix = result.get("suffix", "_preprocessed")
            write_table(out, fmt, result_name(fmt, scoring_base(result), "scoring", suffix))
        return out
