"""Everything a run learned, kept as small tables, and re-applied by the same step code."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.operators.splits import Roles
from featurelab.sources.sinks import DROPPED_SCHEMA, append_dropped, write_manifest

FEATURES_SCHEMA = "pos int, name string, role string"


@dataclass(frozen=True)
class State:
    """`roles` are the final ones, `inputs` those right after classification."""

    roles: Roles
    inputs: Roles
    steps: tuple[str, ...] = ()
    dedup_subset: tuple[str, ...] = ()
    row_key: tuple[str, ...] = ()
    fill_numeric: float = 0
    fill_categorical: str = "NA"
    encoding: str | None = None
    encoder: DataFrame | None = None
    scaler: DataFrame | None = None
    dropped: tuple[tuple[str, str], ...] = ()

    def with_dropped(self, step: str, names) -> State:
        return replace(
            self,
            roles=self.roles.without(names),
            dropped=self.dropped + tuple((step, c) for c in names),
        )


def roles_table(spark: SparkSession, roles: Roles) -> DataFrame:
    """(pos, name, role): features first in column order, then the rest."""
    names = [*roles.features, *roles.other, roles.index]
    names += [roles.target] if roles.target else []
    names += roles.skip
    return spark.createDataFrame([(i, c, roles.role_of(c)) for i, c in enumerate(names)], FEATURES_SCHEMA)


def roles_from(table: DataFrame) -> Roles:
    rows = table.orderBy("pos").collect()  # one row per column

    def having(*wanted: str) -> tuple[str, ...]:
        return tuple(r.name for r in rows if r.role in wanted)

    return Roles(
        index=having("index")[0],
        target=next(iter(having("target")), None),
        skip=having("skip"),
        features=having("categorical", "numeric"),
        categorical=having("categorical"),
        other=having("other"),
    )


def save_state(spark: SparkSession, state: State, path: str) -> None:
    """Folders below `path`: features, inputs, dropped, encoder, scaler, manifest."""
    for name, roles in (("features", state.roles), ("inputs", state.inputs)):
        roles_table(spark, roles).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    spark.createDataFrame([], DROPPED_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/dropped")
    for step in dict.fromkeys(step for step, _ in state.dropped):
        append_dropped(spark, f"{path}/dropped", step, [c for s, c in state.dropped if s == step])
    for name, table in (("encoder", state.encoder), ("scaler", state.scaler)):
        if table is not None:
            table.write.mode("overwrite").parquet(f"{path}/{name}")
    write_manifest(
        spark,
        f"{path}/manifest",
        {
            "steps": json.dumps(state.steps),
            "dedup_subset": json.dumps(state.dedup_subset),
            "row_key": json.dumps(state.row_key),
            "fill_numeric": str(state.fill_numeric),
            "fill_categorical": state.fill_categorical,
            "encoding": state.encoding or "",
            "dropped_path": f"{path}/dropped",
            "features_path": f"{path}/features",
            "encoder_path": f"{path}/encoder" if state.encoder is not None else "",
            "scaler_path": f"{path}/scaler" if state.scaler is not None else "",
        },
    )


MANIFEST_SCHEMA = (
    "steps string, dedup_subset string, row_key string, fill_numeric string, fill_categorical string, "
    "encoding string, encoder_path string, scaler_path string"
)


def _split(text: str | None) -> tuple[str, ...]:
    return tuple(json.loads(text)) if text else ()


def load_state(spark: SparkSession, path: str) -> State:
    try:
        manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/manifest").first()
    except AnalysisException as missing:
        raise FileNotFoundError(f"no fitted state in {path}") from missing
    features = roles_from(spark.read.schema(FEATURES_SCHEMA).parquet(f"{path}/features"))
    if not features.features:
        raise ValueError("the saved list of features is empty")
    return State(
        roles=features,
        inputs=roles_from(spark.read.schema(FEATURES_SCHEMA).parquet(f"{path}/inputs")),
        steps=_split(manifest.steps),
        dedup_subset=_split(manifest.dedup_subset),
        row_key=_split(manifest.row_key),
        fill_numeric=float(manifest.fill_numeric),
        fill_categorical=manifest.fill_categorical,
        encoding=manifest.encoding or None,
        encoder=spark.read.parquet(manifest.encoder_path) if manifest.encoder_path else None,
        scaler=spark.read.parquet(manifest.scaler_path) if manifest.scaler_path else None,
        dropped=tuple(
            (r.step, r.feature)
            for r in spark.read.schema(DROPPED_SCHEMA).parquet(f"{path}/dropped").orderBy(F.col("step"), "feature").collect()
        ),
    )
