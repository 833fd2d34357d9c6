from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurelab.functions.quantiles import approx_quantiles, exact_quantiles
from featurelab.operators import encode
from featurelab.operators.encode import apply_encoding, fit_encoder, fit_label, fit_target
from featurelab.operators.scale import apply_scaler, fit_scaler


@pytest.fixture(scope="module")
def colours(spark):
    rows = [(1, "red", 1), (2, "blue", 0), (3, None, 1), (4, "red", 0), (5, "green", 1), (6, "blue", 1)]
    return spark.createDataFrame(rows, "id int, c string, y int")


@pytest.fixture
def by_shuffle(monkeypatch):
    """Treat every dictionary as too long for a broadcast, "red" alone as frequent."""
    monkeypatch.setattr(encode, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(encode, "FREQUENT_SHARE", 0.33)


def test_labels_in_order_of_first_key(spark, colours):
    encoder = fit_label(colours.repartition(4), ["c"], "id")
    assert {r.value: r.code for r in encoder.collect()} == {"red": 1.0, "blue": 2.0, None: 3.0, "green": 4.0}
    new = spark.createDataFrame([(1, "blue"), (2, "pink"), (3, None)], "id int, c string")
    got = apply_encoding(new, encoder, ["c"], "label_encoder")
    assert dict(got.dtypes)["c"] == "int" and got.columns == ["id", "c"]
    assert {r.id: r.c for r in got.collect()} == {1: 2, 2: -1, 3: 3}


def test_missing_value_unseen_in_the_fit(spark, colours):
    encoder = fit_label(colours.filter("c is not null"), ["c"], "id")
    got = apply_encoding(colours, encoder, ["c"], "label_encoder")
    assert got.filter("id = 3").first().c == -2


def test_composite_keys(spark):
    df = spark.createDataFrame([(2, 1, "b"), (1, 9, "a"), (1, 3, "c")], "k1 int, k2 int, c string")
    got = {r.value: r.code for r in fit_label(df, ["c"], ["k1", "k2"]).collect()}
    assert got == {"c": 1.0, "a": 2.0, "b": 3.0}


def test_target_means(spark, colours):
    encoder = fit_target(colours, ["c"], "y", min_samples_leaf=2, smoothing=1.0)
    prior = 4 / 6

    def smoothed(n, mean):
        w = 1 / (1 + math.exp(-(n - 2)))
        return prior * (1 - w) + mean * w

    expected = {"red": smoothed(2, 0.5), "blue": smoothed(2, 0.5), "green": smoothed(1, 1.0), None: prior}
    assert {r.value: r.code for r in encoder.collect()} == pytest.approx(expected)
    new = spark.createDataFrame([(1, "pink"), (2, None), (3, "green")], "id int, c string")
    got = {r.id: r.c for r in apply_encoding(new, encoder, ["c"], "target_encoder").collect()}
    assert got == pytest.approx({1: prior, 2: prior, 3: expected["green"]})


def test_long_dictionaries_give_the_same_codes(spark, colours, by_shuffle):
    new = spark.createDataFrame([(i, c) for i, c in enumerate(["red", "blue", "pink", None] * 20)], "id int, c string")
    for method, encoder in (("label_encoder", fit_label(colours, ["c"], "id")), ("target_encoder", fit_target(colours, ["c"], "y"))):
        by_join = apply_encoding(new, encoder, ["c"], method)
        codes = {r.value: r.code for r in encoder.collect()}
        unknown = -1 if method == "label_encoder" else codes[None]
        expected = {i: codes.get(c, unknown) for i, c in ((r.id, r.c) for r in new.collect())}
        assert {r.id: r.c for r in by_join.collect()} == pytest.approx(expected)


def test_many_values_keep_dense_codes(spark):
    df = spark.range(5000).select("id", F.md5(F.col("id").cast("string")).alias("c"))
    encoder = fit_label(df, ["c"], "id")
    got = apply_encoding(df, encoder, ["c"], "label_encoder")
    assert got.filter("c <> id + 1").count() == 0


def test_unknown_methods(spark, colours):
    with pytest.raises(ValueError):
        fit_encoder(colours, ["c"], "one_hot", "id")
    with pytest.raises(ValueError):
        fit_encoder(colours, ["c"], "target_encoder", "id")
    with pytest.raises(ValueError):
        fit_scaler(colours, ["y"], "robust")


@pytest.fixture(scope="module")
def numbers(spark):
    rnd = random.Random(5)
    rows = [(i, float(rnd.randrange(40)), rnd.gauss(0, 9), 4.0, None if i % 9 == 0 else rnd.random()) for i in range(700)]
    return spark.createDataFrame(rows, "id int, tied double, x double, const double, gaps double").repartition(3)


def arrays(df, columns):
    rows = df.orderBy("id").collect()
    return {c: np.array([np.nan if r[c] is None else r[c] for r in rows]) for c in columns}


COLUMNS = ["tied", "x", "const", "gaps"]


@pytest.mark.parametrize("method", ["standard", "minmax", "binning"])
def test_scalers_against_numpy(numbers, method):
    got = arrays(apply_scaler(numbers, fit_scaler(numbers, COLUMNS, method, bins=6)), COLUMNS)
    for c, x in arrays(numbers, COLUMNS).items():
        low, width = np.nanmin(x), (np.nanmax(x) - np.nanmin(x)) or 1.0
        expected = {
            "standard": (x - np.nanmean(x)) / (np.nanstd(x) or 1.0),
            "minmax": (x - low) / width,
            "binning": np.clip(np.floor((x - low) / width * 6), 0, 5),
        }[method]
        np.testing.assert_allclose(got[c], expected, atol=1e-9)


def test_values_outside_the_fitted_range(spark, numbers):
    wide = spark.createDataFrame([(1, -1e6), (2, 1e6)], "id int, x double")
    fitted = numbers.select("id", "x")
    assert [r.x for r in apply_scaler(wide, fit_scaler(fitted, ["x"], "binning", bins=5)).orderBy("id").collect()] == [0.0, 4.0]
    low, high = (r.x for r in apply_scaler(wide, fit_scaler(fitted, ["x"], "minmax")).orderBy("id").collect())
    assert low < 0 and high > 1
    assert [r.x for r in apply_scaler(wide, fit_scaler(fitted, ["x"], "quantile")).orderBy("id").collect()] == [0.0, 1.0]


@pytest.mark.parametrize("points", [1, 2, 5, 101, 1000])
def test_exact_quantiles_against_numpy(numbers, points):
    got = {r.feature: r.quantiles for r in exact_quantiles(numbers, COLUMNS, points).collect()}
    for c, x in arrays(numbers, COLUMNS).items():
        known = x[~np.isnan(x)]
        expected = np.quantile(known, np.linspace(0, 1, min(points, len(known))))
        np.testing.assert_allclose(got[c], expected, atol=1e-9)


def test_quantiles_of_one_row_and_of_none(spark):
    df = spark.createDataFrame([(2.5, None)], "x double, y double")
    assert {r.feature: r.quantiles for r in exact_quantiles(df, ["x", "y"], 10).collect()} == {"x": [2.5]}


def test_approximate_quantiles_are_close(numbers):
    got = {r.feature: r.quantiles for r in approx_quantiles(numbers, ["x"], 11).collect()}
    x = arrays(numbers, ["x"])["x"]
    np.testing.assert_allclose(got["x"], np.quantile(x, np.linspace(0, 1, 11)), atol=0.5)


@pytest.mark.parametrize("exact", [True, False])
def test_quantile_scaling(numbers, exact):
    fitted = fit_scaler(numbers, COLUMNS, "quantile", n_quantiles=50, exact=exact)
    params = {r.feature: np.array(r.params) for r in fitted.collect()}
    got = arrays(apply_scaler(numbers, fitted), COLUMNS)
    for c, x in arrays(numbers, COLUMNS).items():
        q, shares = params[c], np.linspace(0, 1, len(params[c]))
        for value, out in zip(x, got[c]):
            if np.isnan(value):
                assert np.isnan(out)
            elif value == q[0]:
                assert out == 0.0
            elif value == q[-1]:
                assert out == 1.0
            else:
                right = np.interp(value, q, shares)
                left = 1 - np.interp(-value, -q[::-1], shares)
                assert out == pytest.approx((left + right) / 2, abs=1e-9)


def test_short_dictionaries_are_one_broadcast(spark, monkeypatch):
    names = [f"c{i}" for i in range(10)]
    df = spark.range(60).select("id", *[F.concat(F.lit("v"), (F.col("id") * (i + 1) % (i + 2)).cast("string")).alias(c) for i, c in enumerate(names)])
    encoder = fit_label(df, names, "id")
    got = apply_encoding(df, encoder, names, "label_encoder")
    rows = got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") == 10
    assert final.count("BroadcastExchange") == 10 and final.count("ReusedExchange") == 9  # which name what they reuse
    codes = {(r.feature, r.value): int(r.code) for r in encoder.collect()}
    plain = {r.id: r for r in df.collect()}
    assert all(r[c] == codes[c, plain[r.id][c]] for r in rows for c in names)
    # what does not fit together has dictionaries of its own
    monkeypatch.setattr(encode, "BROADCAST_BYTES", 60)
    again = apply_encoding(df, encoder, names, "label_encoder", broadcast_rows=9).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
