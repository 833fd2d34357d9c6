"""Models per fold: boosted trees for scores and importances, linear models for contributions.

Trees are MLlib's. Each fold's fit is a distributed job over that fold's rows;
folds are started from a few driver threads, as MLlib's own cross-validation does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelab.functions.hashing import Keys, key_list
from featurelab.functions.metrics import rmse, roc_auc
from featurelab.operators.folds import FOLD, IS_TRAIN, kfold, train_flag
from featurelab.operators.forest import Forest, exchanged_scores, forest_of, path_contributions
from featurelab.operators.permute import NOISE, add_noise
from featurelab.operators.sampling import Identified, identify_rows, sample_to
from featurelab.sources.scratch import dealt, is_small, scratch_path, stage

LABEL, VECTOR, SCORE = "_label", "_features", "_score"
IMPORTANCE_SCHEMA = "fold_id int, feature_name string, importance double"
IMPORTANCE_KINDS = ("gain", "split", "shap", "linear")


@dataclass(frozen=True)
class Task:
    """What is predicted and how it is judged."""

    name: str
    metric: str
    higher_is_better: bool

    @staticmethod
    def of(name: str) -> Task:
        if name == "binary_classification":
            return Task(name, "auc", True)
        if name == "regression":
            return Task(name, "rmse", False)
        raise ValueError(f"unknown task type: {name!r}")

    @property
    def is_classification(self) -> bool:
        return self.metric == "auc"


BINARY = Task.of("binary_classification")


_SETTINGS = (
    "learning_rate", "max_depth", "max_bins", "seed", "row_fraction", "feature_fraction",
    "early_stopping_rounds",
)


@dataclass(frozen=True)
class TreeParams:
    rounds: int = 100
    learning_rate: float = 0.05
    max_depth: int = 5
    max_bins: int = 64
    row_fraction: float = 0.8
    feature_fraction: float = 0.6
    min_rows_per_leaf: int = 10
    early_stopping_rounds: int = 10  # rounds without gain after which a fit ends; 0: never
    seed: int = 42

    def with_settings(self, settings: Mapping) -> TreeParams:
        known = {k: settings[k] for k in _SETTINGS if k in settings}
        if "num_boost_round" in settings:
            known["rounds"] = settings["num_boost_round"]
        return replace(self, **known)


@dataclass(frozen=True)
class FoldFrame:
    """Labelled rows with fold and train flag, staged with a folder per fold for repeated fits.

    `sizes` has the rows of each fold if they are so many that fits deal them out anew.
    """

    df: DataFrame
    features: tuple[str, ...]
    folds: int
    keys: tuple[str, ...]
    rows: int
    arities: Mapping[str, int] = field(default_factory=dict)
    sizes: Mapping[int, int] = field(default_factory=dict)


def fold_frame(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Keys,
    folds: int,
    valid_frac: float = 0.3,
    categorical: Sequence[str] = (),
    sample_size: int | None = None,
    seed: int = 42,
    noise: bool = False,
) -> FoldFrame:
    """Sample, number the folds, and stage just the columns the fits need.

    With `noise` a random feature is added to the given ones.
    """
    keys = key_list(keys)
    # keys are kept under names of their own, as a key may also be a feature
    plain = df.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col(label).cast("double").alias(LABEL),
        *[F.col(c).cast("double").alias(c) for c in features],
    ).filter(F.col(LABEL).isNotNull())
    known: Identified = identify_rows(plain, [f"_key{i}" for i in range(len(keys))])
    sampled = sample_to(known.df, known.keys, sample_size, known.count, salt="model-sample")
    if noise:
        sampled, features = add_noise(sampled, known.keys, NOISE, f"noise{seed}"), [*features, NOISE]
    flagged = train_flag(
        kfold(sampled, known.keys, folds, salt=f"fold{seed}"), known.keys, valid_frac, salt=f"split{seed}"
    )
    rows = min(known.count, sample_size or known.count)
    staged = stage(flagged, "folds", rows, folder_by=FOLD)
    codes = [c for c in categorical if c in features]
    # codes run from -2 (missing) upwards; shifted by 2 they are category numbers
    tops = staged.agg(*[F.max(c).alias(c) for c in codes], F.count("*").alias("_rows")).first()
    arities = {c: int(tops[c]) + 3 for c in codes if tops[c] is not None}
    sizes = {}
    if not is_small(staged, tops["_rows"]):
        sizes = {r[FOLD]: r["count"] for r in staged.groupBy(FOLD).count().collect()}
    return FoldFrame(staged, tuple(features), folds, tuple(known.keys), tops["_rows"], arities, sizes)


def fold_rows(frame: FoldFrame, fold: int, columns: Sequence[str], flag: int | None = None) -> DataFrame:
    """The given columns of a fold's rows, of all or of those with a train flag, as fits take them.

    MLlib keeps the rows it fits on as objects, many times as large as in the files, so a partition has a bounded
    number of rows.
    """
    rows = frame.df.filter(F.col(FOLD) == fold)
    if flag is not None:
        rows = rows.filter(F.col(IS_TRAIN) == flag)
    rows = rows.select(*columns)
    return dealt(rows, frame.sizes[fold]) if fold in frame.sizes else rows


def vector_inputs(
    frame: FoldFrame, features: Sequence[str], max_bins: int, values: Mapping[str, Column] | None = None
) -> dict[str, Column]:
    """Inputs of the feature vector; categories are marked nominal and must fit into the bins."""
    source = {c: F.col(c) for c in features} | dict(values or {})
    inputs = {}
    for i, c in enumerate(features):
        arity = frame.arities.get(c)
        if arity is not None and arity > max_bins:
            raise ValueError(f"{c!r} has {arity} categories, more than max_bins = {max_bins}")
        if arity is not None:
            nominal = {"ml_attr": {"type": "nominal", "name": c, "num_vals": arity}}
            inputs[f"_x{i}"] = (source[c] + 2.0).alias(f"_x{i}", metadata=nominal)
        else:
            inputs[f"_x{i}"] = source[c].alias(f"_x{i}")
    return inputs


def with_vector(df: DataFrame, inputs: Mapping[str, Column]) -> DataFrame:
    wide = df.select("*", *inputs.values())
    return VectorAssembler(inputCols=list(inputs), outputCol=VECTOR).transform(wide).drop(*inputs)


def per_fold(frame: FoldFrame, work: Callable[[int], object], parallelism: int = 4) -> dict[int, object]:
    in_session = inheritable_thread_target(frame.df.sparkSession)(work)
    with ThreadPool(max(1, min(parallelism, frame.folds))) as pool:
        return dict(enumerate(pool.map(in_session, range(frame.folds))))


def best_prefix(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """(rounds to keep, whether the search ended): the least error before `patience` rounds in a row brought none lower."""
    best = 0
    for k, error in enumerate(errors):
        if error < errors[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def cut_model(model, rounds: int):
    """The ensemble of the first trees of a model."""
    if rounds >= model.getNumTrees:
        return model
    context = SparkContext._active_spark_context
    package = context._jvm.org.apache.spark.ml
    trees = context._gateway.new_array(package.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(context._gateway.jvm.double, rounds)
    fitted, known = model._java_obj.trees(), model.treeWeights
    for k in range(rounds):
        trees[k], weights[k] = fitted[k], float(known[k])
    kind = type(model)
    family = package.classification if kind is GBTClassificationModel else package.regression
    java = getattr(family, kind.__name__)(f"{model.uid}_{rounds}", trees, weights)
    return kind(java).setFeaturesCol(VECTOR)


def fit_folds(
    frame: FoldFrame, features: Sequence[str], task: Task, params: TreeParams, parallelism: int = 4
) -> dict[int, object]:
    """One boosted-tree model per fold, cut where the error on the fold's validation rows is least.

    With early stopping a fit may end after `early_stopping_rounds` without gain. MLlib cannot go on with a model, but
    fits the same first trees again: a fit of some rounds is repeated with twice as many while it has
    not waited that long. So a round that brings nothing ends no fit, and the trees do not depend on the steps.
    """
    inputs = vector_inputs(frame, features, params.max_bins)
    estimator = (GBTClassifier if task.is_classification else GBTRegressor)(
        featuresCol=VECTOR,
        labelCol=LABEL,
        stepSize=params.learning_rate,
        maxDepth=params.max_depth,
        maxBins=params.max_bins,
        subsamplingRate=params.row_fraction,
        featureSubsetStrategy=str(params.feature_fraction),
        minInstancesPerNode=params.min_rows_per_leaf,
        seed=params.seed,
    )
    patience = params.early_stopping_rounds

    def fit(fold: int):
        fitted, held_out = (
            with_vector(fold_rows(frame, fold, [LABEL, *features], k), inputs).select(LABEL, VECTOR) for k in (1, 0)
        )
        rounds = min(params.rounds, 3 * patience) if patience else params.rounds
        while True:
            model = estimator.fit(fitted, {estimator.maxIter: rounds})
            if not patience or rounds == 1:
                return model
            keep, ended = best_prefix(model.evaluateEachIteration(*_judged(held_out, task)), patience)
            if ended or rounds == params.rounds:
                return cut_model(model, keep)
            rounds = min(params.rounds, 2 * rounds)

    return per_fold(frame, fit, parallelism)


def _judged(held_out: DataFrame, task: Task) -> tuple:
    """What MLlib's errors of all prefixes are taken from: log loss for classes, else squared error."""
    return (held_out,) if task.is_classification else (held_out, "squared")


def load_forests(frame: FoldFrame, models: Mapping[int, object]) -> dict[int, Forest]:
    """The nodes of each fold's model, by way of its saved form."""
    spark = frame.df.sparkSession
    paths = {fold: scratch_path(spark, "model") for fold in models}
    per_fold(frame, lambda fold: models[fold].save(paths[fold]) if fold in models else None)
    rows = None
    for fold, path in paths.items():
        part = spark.read.parquet(f"{path}/data").select(F.lit(fold).alias(FOLD), "treeID", "nodeData")
        rows = part if rows is None else rows.unionByName(part)
    found: dict[int, list] = {fold: [] for fold in models}
    for row in rows.collect():  # as many nodes as the models in the driver have
        found[row[FOLD]].append(row)
    return {
        fold: forest_of(sorted(nodes, key=lambda r: (r["treeID"], r["nodeData"]["id"])), models[fold].treeWeights)
        for fold, nodes in found.items()
    }


def score(
    df: DataFrame, models: Mapping[int, object], task: Task, inputs: Mapping[str, Column]
) -> DataFrame:
    """Each row scored by its own fold's model."""
    vectors = with_vector(df, inputs)
    parts = []
    for fold, model in models.items():
        scored = model.transform(vectors.filter(F.col(FOLD) == fold))
        value = (
            vector_to_array(F.col("rawPrediction"))[1] if task.is_classification else F.col("prediction")
        )
        parts.append(scored.select(*df.columns, value.alias(SCORE)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def evaluate(df: DataFrame, task: Task, by: Sequence[str], times: str | None = None) -> DataFrame:
    """The task's metric per group, in the column "metric"; `times` as in `roc_auc`."""
    if task.is_classification:
        return roc_auc(df, LABEL, SCORE, by, times).select(*by, F.col("auc").alias("metric"))
    return rmse(df, LABEL, SCORE, by, times).select(*by, F.col("rmse").alias("metric"))


def fold_metrics(
    frame: FoldFrame, features: Sequence[str], models: Mapping[int, object], task: Task, max_bins: int
) -> dict[int, float]:
    """Metric on each fold's validation rows.

    Batches of rows walk down the trees, and equal scores of a batch are counted; a missing value raises, as in the fit.
    """
    held_out = frame.df.filter(F.col(IS_TRAIN) == 0)
    missing = F.raise_error(F.lit("a feature has missing values; fill gaps first"))
    values = [
        F.when(v.isNotNull() & ~F.isnan(v), v).otherwise(missing)
        for v in vector_inputs(frame, features, max_bins).values()
    ]
    scored = exchanged_scores(held_out, load_forests(frame, models), values, [], LABEL)
    scored = scored.withColumnsRenamed({"label": LABEL, "score": SCORE})
    found = {r[FOLD]: r["metric"] for r in evaluate(scored, task, [FOLD], "rows").collect()}
    for fold, value in found.items():
        if value is None:
            raise ValueError(f"fold {fold}: the validation rows hold one class only")
    return found


def tree_importance(
    df: DataFrame, models: Mapping[int, object], features: Sequence[str], kind: str
) -> DataFrame:
    """(fold_id, feature_name, importance) from the fitted trees; features never used get 0."""
    spark = df.sparkSession
    if kind == "gain":
        rows = []
        for fold, model in models.items():
            found = model.featureImportances.toArray()  # of a cut model: up to the last feature it uses
            rows += [(fold, c, float(found[i]) if i < len(found) else 0.0) for i, c in enumerate(features)]
        return spark.createDataFrame(rows, IMPORTANCE_SCHEMA)
    if kind != "split":
        raise ValueError(f"unknown tree importance: {kind!r}")
    every = spark.createDataFrame(
        [(fold, i, c) for fold in models for i, c in enumerate(features)],
        "fold_id int, feature_index int, feature_name string",
    )
    counts = None
    for fold, model in models.items():
        path = scratch_path(spark, "model")
        model.save(path)
        nodes = spark.read.parquet(f"{path}/data").filter("nodeData.leftChild >= 0")
        part = nodes.select(F.lit(fold).alias(FOLD), F.col("nodeData.split.featureIndex").alias("feature_index"))
        counts = part if counts is None else counts.unionByName(part)
    splits = counts.groupBy(FOLD, "feature_index").agg(F.count("*").alias("splits"))
    return every.join(splits, [FOLD, "feature_index"], "left").select(
        FOLD, "feature_name", F.coalesce("splits", F.lit(0)).cast("double").alias("importance")
    )


def mean_contribution(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(feature_name, importance): avg(|w * (x - mean x)|).

    How far a linear model's output moves with each feature; for independent
    features these are the mean absolute Shapley values of the linear model.
    """
    names = list(weights)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    means = numbers.agg(*[F.avg(c).alias(c) for c in names]).first()
    moved = [
        F.avg(F.abs(F.lit(float(weights[c])) * (F.col(c) - F.lit(means[c])))).alias(c) for c in names
    ]
    entries = [
        F.struct(F.lit(c).alias("feature_name"), F.col(c).alias("importance")) for c in names
    ]
    return numbers.agg(*moved).select(F.inline(F.array(*entries)))


def linear_importance(
    frame: FoldFrame, features: Sequence[str], task: Task, every_row: bool = False, parallelism: int = 4
) -> DataFrame:
    """Contributions of a linear model fitted per fold, on validation rows or on all rows.

    Category codes enter as plain numbers.
    """
    estimator = (
        LogisticRegression(regParam=0.01, maxIter=50)
        if task.is_classification
        else LinearRegression(regParam=0.01, maxIter=50)
    ).setFeaturesCol(VECTOR).setLabelCol(LABEL)
    inputs = {f"_x{i}": F.col(c).alias(f"_x{i}") for i, c in enumerate(features)}

    def contributions(fold: int) -> list[tuple[int, str, float]]:
        rows = frame.df.filter(F.col(FOLD) == fold)
        fitted = fold_rows(frame, fold, [LABEL, *features], None if every_row else 1)
        model = estimator.fit(with_vector(fitted, inputs).select(LABEL, VECTOR))
        weights = dict(zip(features, model.coefficients.toArray().tolist()))
        judged = rows if every_row else rows.filter(F.col(IS_TRAIN) == 0)
        return [(fold, r.feature_name, r.importance) for r in mean_contribution(judged, weights).collect()]

    found = per_fold(frame, contributions, parallelism)
    rows = [row for part in found.values() for row in part]
    return frame.df.sparkSession.createDataFrame(rows, IMPORTANCE_SCHEMA)


def values_of(frame: FoldFrame, features: Sequence[str], prefix: str = "") -> list[Column]:
    """The numbers that the trees split on, as in `vector_inputs`."""
    return [F.col(prefix + c) + (2.0 if c in frame.arities else 0.0) for c in features]


def contribution_importance(
    frame: FoldFrame, features: Sequence[str], models: Mapping[int, object], every_row: bool = False
) -> DataFrame:
    """Mean absolute contributions along the trees' paths, on validation rows or on all rows."""
    rows = frame.df if every_row else frame.df.filter(F.col(IS_TRAIN) == 0)
    return path_contributions(rows, load_forests(frame, models), values_of(frame, features), features)


def importance_by_fold(
    frame: FoldFrame, features: Sequence[str], task: Task, params: TreeParams, kind: str
) -> tuple[DataFrame, dict[int, object]]:
    """Importances and the tree models they belong to ("linear" needs no tree)."""
    if kind not in IMPORTANCE_KINDS:
        raise ValueError(f"unknown importance type: {kind!r}")
    if kind == "linear":
        return linear_importance(frame, features, task), {}
    models = fit_folds(frame, features, task, params)
    return model_importance(frame, features, models, kind), models


def model_importance(
    frame: FoldFrame, features: Sequence[str], models: Mapping[int, object], kind: str
) -> DataFrame:
    if kind == "shap":
        return contribution_importance(frame, features, models)
    return tree_importance(frame.df, models, features, kind)
