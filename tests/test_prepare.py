from __future__ import annotations

import copy
import random

import pytest
from pyspark.sql import functions as F

from featurelab import Preparation, Splits, apply, load_state, run, save_state
from featurelab.sources import append_dropped, read_dropped, read_input, save_splits, write_report, write_table

CONFIG = {
    "common": {"index_col": "id", "target_col": "y", "skip_cols": ["note"], "force_drop_cols": ["tags"]},
    "sampling": {"use_sampling": False},
    "preprocessing": {
        "rebalancing": {"positive_frac": 0.4, "apply_to": "both"},
        "drop_uninformative": {"threshold": 0.95},
        "missing_values": {"numeric": 0, "categorical": "NA"},
        "deduplicate": {"subset": ["id"]},
        "categorical_encoding": {"method": "label_encoder", "force_categorical": ["code"]},
        "scaling": {"method": "standard"},
        "drop_correlated": {"threshold": 0.95, "importances": {"use_shap": True, "n_partitions": 2, "num_boost_round": 4, "max_depth": 2}},
        "noise_selection": {"cv_folds": 2, "selection_rate": 0.5, "num_boost_round": 3, "max_depth": 2},
    },
    "pipeline_steps": [
        "rebalancing", "drop_forced_cols", "convert_decimal", "fill_missing", "drop_uninformative",
        "deduplicate", "categorical_encoding", "scaling",
    ],
}


def config(**changes):
    out = copy.deepcopy(CONFIG)
    for path, value in changes.items():
        *parents, last = path.split("__")
        place = out
        for p in parents:
            place = place[p]
        place[last] = value
    return out


@pytest.fixture(scope="module")
def splits(spark):
    rnd = random.Random(11)

    def rows(start, n):
        return [
            (
                i, int(rnd.random() < 0.2), f"n{i}", "t", rnd.choice(["a", "b", None]), rnd.randrange(3),
                rnd.gauss(0, 1), None if rnd.random() < 0.2 else rnd.random(), "same", rnd.random() < 0.5,
            )
            for i in range(start, start + n)
        ]

    schema = "id int, y int, note string, tags string, c string, code int, x double, gap double, const string, flag boolean"
    frames = []
    for start, n in ((0, 400), (380, 200), (900, 100)):
        df = spark.createDataFrame(rows(start, n), schema)
        frames.append(df.withColumn("price", (F.col("x") * 10).cast("decimal(12,2)")))
    frames[2] = frames[2].unionByName(frames[2].limit(10)).drop("y")
    return Splits(*frames)


def test_run(splits):
    out, state = run(splits, CONFIG)
    assert state.roles.features == ("c", "code", "x", "gap", "flag", "price")
    assert state.roles.categorical == ("c", "code")
    assert state.dropped == (("drop_forced_cols", "tags"), ("drop_uninformative", "const"))
    assert out.train.columns == ["id", "y", "note", "c", "code", "x", "gap", "flag", "price"]
    types = dict(out.train.dtypes)
    assert types["c"] == types["code"] == "int" and types["x"] == types["flag"] == types["price"] == "float"
    assert out.scoring.columns == [c for c in out.train.columns if c != "y"]
    share = out.train.agg(F.avg("y")).first()[0]
    assert share >= 0.4
    assert out.train.join(out.valid, "id").count() == 0
    assert out.scoring.count() == 110
    stats = out.train.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert stats[0] == pytest.approx(0, abs=1e-5) and stats[1] == pytest.approx(1, abs=1e-5)


@pytest.mark.parametrize("method", ["label_encoder", "target_encoder"])
def test_apply_repeats_the_run(splits, method):
    cfg = config(
        preprocessing__categorical_encoding__method=method,
        pipeline_steps=[s for s in CONFIG["pipeline_steps"] if s != "rebalancing"],
    )
    out, state = run(Splits(splits.train), cfg)
    expected = sorted(map(tuple, out.train.collect()))
    assert sorted(map(tuple, apply(splits.train.repartition(5), state).collect())) == expected


def test_same_result_for_any_partitioning(splits):
    steps = [s for s in CONFIG["pipeline_steps"] if s != "scaling"]
    results = []
    for n in (1, 7):
        out, _ = run(splits.map(lambda df: df.repartition(n)), config(pipeline_steps=steps))
        results.append([sorted(map(tuple, df.collect()), key=repr) for df in out])
    assert results[0] == results[1]


def test_saved_state(spark, splits, tmp_path):
    _, state = run(splits, CONFIG)
    save_state(spark, state, f"{tmp_path}/state")
    loaded = load_state(spark, f"{tmp_path}/state")
    assert loaded.roles == state.roles and loaded.inputs.categorical == state.inputs.categorical
    assert loaded.steps == state.steps and sorted(loaded.dropped) == sorted(state.dropped)
    expected = sorted(map(tuple, apply(splits.scoring, state).collect()))
    assert len(expected) == 100
    assert sorted(map(tuple, apply(splits.scoring, loaded).collect())) == expected
    assert apply(splits.scoring, loaded, deduplicate=False).count() == 110
    with pytest.raises(KeyError):
        apply(splits.scoring.drop("x"), loaded)
    with pytest.raises(FileNotFoundError):
        load_state(spark, f"{tmp_path}/nothing")


def test_selectors_inside_a_run(spark, splits, tmp_path):
    cfg = config(
        artifacts={"path": f"{tmp_path}/art"},
        pipeline_steps=["fill_missing", "categorical_encoding", "drop_correlated", "noise_selection"],
    )
    out, state = run(Splits(splits.train), cfg)
    gone = {c for _, c in state.dropped}
    assert gone & {"x", "price"}
    assert not gone & set(out.train.columns)
    assert set(read_dropped(spark, f"{tmp_path}/art/dropped")) == gone
    report = spark.read.option("header", True).csv(f"{tmp_path}/art/reports/drop_correlated_importances")
    scores = [float(r.score) for r in report.collect()]
    assert len(scores) == len({"x", "gap", "flag", "price"}) and scores == sorted(scores, reverse=True)


def test_sampling_and_missing_splits(splits):
    cfg = config(
        sampling={"use_sampling": True, "train_sample_size": 200, "test_sample_size": 50},
        pipeline_steps=["fill_missing"],
    )
    out, _ = run(splits, cfg)
    assert 150 < out.train.count() < 250 and 30 < out.valid.count() < 75 and out.scoring.count() == 110
    alone, _ = run(Splits(splits.train), cfg)
    assert alone.valid is None


def test_object_with_results(spark, splits, tmp_path):
    cfg = config(
        artifacts={"path": f"{tmp_path}/art"},
        result={"format": "parquet", "save_path": f"{tmp_path}/out", "save_path_scoring": f"{tmp_path}/sc", "suffix": "_p"},
    )
    train, valid, scoring = Preparation(spark, cfg).fit(*splits)
    assert spark.read.parquet(f"{tmp_path}/out/train_p.parquet").count() == train.count()
    assert spark.read.parquet(f"{tmp_path}/out/test_p.parquet").count() == valid.count()
    assert spark.read.parquet(f"{tmp_path}/sc/scoring_p.parquet").count() == 110
    again = Preparation(spark, cfg).transform(splits.scoring)
    assert again.count() == 100
    assert spark.read.parquet(f"{tmp_path}/sc/scoring_p.parquet").count() == 100


def test_yaml_configuration(spark, splits, tmp_path):
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "config.yaml"
    path.write_text(yaml.safe_dump(CONFIG))
    _, state = run(splits, str(path))
    assert state.roles.features == ("c", "code", "x", "gap", "flag", "price")


def test_wrong_settings(spark, splits, tmp_path):
    with pytest.raises(ValueError):
        run(splits, config(pipeline_steps=["fill_missing", "polish"]))
    with pytest.raises(ValueError):
        run(splits, config(common__task_type="ranking"))
    with pytest.raises(ValueError):
        save_splits(splits, {"format": "orc", "save_path": str(tmp_path)})
    with pytest.raises(ValueError):
        write_table(splits.train, "xlsx", str(tmp_path))
    with pytest.raises(ValueError):
        write_report(splits.train, str(tmp_path), "xlsx")
    with pytest.raises(FileNotFoundError):
        Preparation(spark, CONFIG).transform(splits.train)


def test_state_applies_to_a_stream(spark, splits, tmp_path):
    _, state = run(splits, CONFIG)
    splits.scoring.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(splits.scoring.schema).parquet(f"{tmp_path}/in")
    out = apply(stream, state, deduplicate=False)
    query = (
        out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True).start(f"{tmp_path}/out")
    )
    query.awaitTermination(120)
    expected = apply(splits.scoring, state, deduplicate=False)
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == sorted(map(tuple, expected.collect()))


def test_tables_and_records(spark, splits, tmp_path):
    write_table(splits.train, "hive", "featurelab_test_train", f"{tmp_path}/t")
    write_table(splits.valid, "hive", "featurelab_test_train", f"{tmp_path}/t")
    assert read_input(spark, "featurelab_test_train").count() == 200
    assert read_input(spark, f"{tmp_path}/t").count() == 200
    assert read_input(spark, None) is None and read_input(spark, splits.train) is splits.train
    assert read_dropped(spark, f"{tmp_path}/none") == []
    append_dropped(spark, f"{tmp_path}/d", "one", ["b", "a"])
    append_dropped(spark, f"{tmp_path}/d", "two", ["c"])
    append_dropped(spark, f"{tmp_path}/d", "three", [])
    assert read_dropped(spark, f"{tmp_path}/d") == ["a", "b", "c"]
    assert read_dropped(spark, f"{tmp_path}/d", "two") == ["c"]
