from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from featurelab.operators.clean import (
    decimal_to_float,
    drop_columns,
    fill_missing,
    final_projection,
    require_features,
    unpivot_text,
)
from featurelab.operators.splits import Splits, classify, match_types, settle_types

MIXED = "id long, i int, d double, s string, b boolean, m decimal(15,2), day date, a array<int>"
NAN = float("nan")


@pytest.fixture(scope="module")
def mixed(spark):
    day = dt.date(2024, 1, 2)
    return spark.createDataFrame(
        [
            (1, 1, 0.0, "x", True, Decimal("12345678.91"), day, [1]),
            (2, None, -0.0, "NA", False, Decimal("1.50"), day, [1]),
            (3, 2, NAN, None, None, None, None, None),
            (4, 2, None, "x", True, Decimal("1.50"), day, [2]),
        ],
        MIXED,
    )


def test_train_is_required():
    with pytest.raises(ValueError):
        Splits(None)


def test_classify(mixed):
    roles = classify(mixed, "id", None, skip=["s"], force_categorical=["i"])
    assert roles.categorical == ("i",)
    assert roles.numeric == ("d", "b", "m")
    assert roles.features == ("i", "d", "b", "m")
    assert roles.other == ("day", "a")
    assert [roles.role_of(c) for c in ("id", "s", "i", "d", "day")] == [
        "index", "skip", "categorical", "numeric", "other",
    ]


def test_roles_are_immutable(mixed):
    roles = classify(mixed, "id")
    smaller = roles.without(["s", "d"])
    assert "s" in roles.categorical and "s" not in smaller.categorical
    assert roles.as_numeric(["s"]).numeric == ("i", "d", "s", "b", "m")


def test_forced_category_becomes_text_and_boolean_a_number(mixed):
    roles = classify(mixed, "id", force_categorical=["i"])
    types = dict(settle_types(mixed, roles).dtypes)
    assert types["i"] == "string" and types["b"] == "int"


def test_match_types(spark):
    model = spark.createDataFrame([(1, 2)], "x int, y int")
    other = spark.createDataFrame([(1, 2.0, "z")], "x long, y double, w string")
    assert match_types(other, model).dtypes == [("x", "int"), ("y", "int"), ("w", "string")]


def test_unpivot_mixes_types_and_merges_zeros(mixed):
    long = unpivot_text(mixed, ["i", "d", "s", "b", "m", "a"])
    assert long.columns == ["id", "day", "feature_name", "feature_value"]
    assert long.count() == 24
    zeros = long.filter("feature_name = 'd' and id < 3").select("feature_value").distinct().collect()
    assert [r[0] for r in zeros] == ["0.0"]


def test_unpivot_is_one_expand(mixed):
    plan = unpivot_text(mixed, ["i", "d", "s"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "Generate" not in plan


def test_fill_missing(mixed):
    roles = classify(mixed, "id")
    got = {r.id: r for r in fill_missing(settle_types(mixed, roles), roles, -1, "NA").collect()}
    assert got[3].d == -1.0 and got[4].d == -1.0 and got[2].i == -1
    assert got[3].s == "NA" and got[3].b == -1 and got[3].m == Decimal("-1.00")
    assert got[3].day is None and got[3].a is None


def test_forced_category_is_filled_with_text(mixed):
    roles = classify(mixed, "id", force_categorical=["i"])
    got = fill_missing(settle_types(mixed, roles), roles, 0, "NA").filter("id = 2").first()
    assert got.i == "NA"


def test_decimal_to_float(mixed):
    got = decimal_to_float(mixed)
    assert dict(got.dtypes)["m"] == "float"
    assert got.filter("id = 1").first().m == 12345679.0
    assert dict(decimal_to_float(mixed, ["m"]).dtypes)["m"] == "decimal(15,2)"


def test_drop_and_project(mixed):
    splits = drop_columns(Splits(mixed, None, mixed.drop("i")), ["i", "none"])
    assert "i" not in splits.train.columns and splits.valid is None
    roles = classify(mixed, "id", "b", ["day"]).without(["d"])
    assert final_projection(mixed, roles).columns == ["id", "i", "s", "b", "m", "day"]


def test_required_features(mixed):
    require_features(mixed, ["i"])
    with pytest.raises(KeyError):
        require_features(mixed.select(F.col("i")), ["i", "s"])
