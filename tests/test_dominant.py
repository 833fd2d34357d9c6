from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from featurelab.operators.dominant import dominant_ratio, value_bounds, value_shares

COLUMNS = ["const", "third", "gaps", "zeros", "unique", "words", "days", "lists"]


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    return spark.range(0, 3000, 1, 7).select(
        F.lit("c").alias("const"),
        F.when(i % 3 == 0, 7).otherwise(i).alias("third"),
        F.when(i % 10 == 0, i).alias("gaps"),
        F.when(i % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("zeros"),
        (i / 7).alias("unique"),
        F.concat(F.lit("w"), (i % 5).cast("string")).alias("words"),
        F.date_add(F.to_date(F.lit("2024-01-01")), (i % 4).cast("int")).alias("days"),
        F.array(i % 2).alias("lists"),
    )


def brute(table):
    rows = [r.asDict() for r in table.collect()]
    return {
        c: max(Counter(str(r[c]).replace("-0.0", "0.0") for r in rows).values()) / len(rows) for c in COLUMNS
    }


def test_value_shares_match_counting(table):
    got = {r.feature_name: r.ratio for r in value_shares(table, COLUMNS).collect()}
    assert got == pytest.approx(brute(table))


@pytest.mark.parametrize("threshold", [0.99, 0.9, 0.5, 0.3, 0.2, 0.001])
def test_threshold_keeps_exactly_the_dominated_columns(table, threshold):
    expected = {c: r for c, r in brute(table).items() if r >= threshold}
    got = {r.feature_name: r.ratio for r in dominant_ratio(table, COLUMNS, threshold).collect()}
    assert got == pytest.approx(expected)


def test_third_of_rows_in_one_value_among_distinct_ones(table):
    got = dominant_ratio(table, ["third", "unique"], 0.33).collect()
    assert [(r.feature_name, r.max_cnt, r.total_cnt) for r in got] == [("third", 1001, 3000)]


def test_no_columns_and_no_rows(spark, table):
    assert dominant_ratio(table, [], 0.5).collect() == []
    assert dominant_ratio(table.limit(0), ["const"], 0.5).collect() == []


def test_long_texts_are_counted_by_hash(spark):
    long = F.repeat(F.lit("x"), 1_000_000)
    df = spark.range(0, 30, 1, 3).select(
        F.when(F.col("id") < 20, long).otherwise(F.concat(long, F.col("id").cast("string"))).alias("t"),
        F.concat(long, (F.col("id") % 10).cast("string")).alias("u"),
    )
    total, bounds = value_bounds(df, ["t", "u"])
    assert total == 30 and bounds["t"] == (20, 20) and bounds["u"] == (3, 3)
    assert {r.feature_name: r.max_cnt for r in value_shares(df, ["t", "u"]).collect()} == {"t": 20, "u": 3}


def test_bounds_hold_and_leave_only_flat_columns_open(table):
    total, bounds = value_bounds(table, COLUMNS)
    assert "lists" not in bounds
    for name, share in brute(table).items():
        if name in bounds:
            low, high = bounds[name]
            assert low <= round(share * total) <= high
    assert {c for c, (low, high) in bounds.items() if low < high} == {"unique"}
