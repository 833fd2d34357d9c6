from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from featurelab import Preparation
from featurelab.operators.encode import apply_encoding, fit_label
from featurelab.operators.selectors.base import settings_from
from featurelab.operators.selectors.noise import NoiseSettings
from featurelab.sources import scratch
from featurelab.sources.sinks import save_splits, write_single_file
from featurelab.operators.splits import Splits


def staged(spark):
    folder = scratch.shared_folder(spark).removeprefix("file:") + "/featurelab"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_close_deletes_what_a_fit_staged(spark):
    before = staged(spark)
    rows = spark.range(200).select(
        "id", (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 5).cast("string").alias("c")
    )
    steps = ["deduplicate", "categorical_encoding"]
    config = {
        "common": {"index_col": "id", "target_col": "y"},
        "preprocessing": {"categorical_encoding": {"method": "label_encoder"}, "deduplicate": {"subset": ["id"]}},
        "pipeline_steps": steps,
    }
    prep = Preparation(spark, config)
    train, _, _ = prep.fit(rows)
    assert train.count() == 200 and staged(spark) > before
    assert prep.transform(rows).count() == 200
    prep.close()
    assert staged(spark) == before


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="share no folder"):
        scratch.shared_folder(Session())


def test_long_dictionaries_read_the_source_once(spark):
    columns = [f"c{i}" for i in range(4)]
    df = spark.range(500).select("id", *[F.concat(F.lit(c), F.col("id") % (90 + i)).alias(c) for i, c in enumerate(columns)])
    encoder = fit_label(df, columns, "id")
    coded = apply_encoding(df, encoder, columns, "label_encoder", broadcast_rows=1)
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    short = apply_encoding(df, encoder, columns, "label_encoder")
    assert sorted(coded.collect()) == sorted(short.collect())


def test_scoring_needs_a_place(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="save_path_scoring"):
        save_splits(Splits(df, None, df), {"format": "parquet", "save_path": "/nowhere"})


def test_single_file_has_a_bound(spark, tmp_path):
    with pytest.raises(ValueError, match="single file"):
        write_single_file(spark.range(11), f"{tmp_path}/x", rows=10)


def test_unknown_settings_are_named():
    with pytest.warns(UserWarning, match="n_fold"):
        settings_from(NoiseSettings, {"n_fold": 3})
