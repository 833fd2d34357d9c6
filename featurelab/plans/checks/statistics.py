"""Correlation, metrics, shuffles and votes."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurelab.functions.metrics import rmse, roc_auc
from featurelab.operators.clean import unpivot_numbers
from featurelab.operators.correlated import correlated, pearson_pairs
from featurelab.operators.folds import kfold
from featurelab.operators.models import mean_contribution
from featurelab.operators.permute import add_noise, permute
from featurelab.operators.selectors import drift_auc
from featurelab.operators.splits import Splits
from featurelab.operators.votes import (
    above_noise,
    above_threshold,
    importance_rank,
    mean_metric,
    top_feature,
    vote,
)
from featurelab.plans.checks.inputs import (
    DOCUMENT_FEATURES,
    DOCUMENT_SQL,
    LINE_NUMBERS,
    auc_sql,
    document_features,
    hash_sql,
    moment,
    table,
    urgent_orders,
)

QUERIES, SQL = {}, {}


def _numbers(spark, folder):
    """Lineitem numbers with two columns derived from others."""
    return table(spark, folder, "lineitem").select(
        *LINE_NUMBERS,
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (-2 * F.col("l_quantity")).alias("minus_quantity"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        F.lit(1.5).alias("constant"),
        F.lit(0.1).alias("tenth"),
        F.lit(0.7).alias("seven_tenths"),
    )


_CONSTANTS = ("constant", "tenth", "seven_tenths")
_PAIRED = [*LINE_NUMBERS, "net", "minus_quantity", *_CONSTANTS]
_NUMBERS_SQL = """
    select l_quantity, l_extendedprice, l_discount, l_tax, cast(l_linenumber as double) as l_linenumber,
           l_extendedprice * (1 - l_discount) as net, -2 * l_quantity as minus_quantity,
           1.5::double as constant, 0.1::double as tenth, 0.7::double as seven_tenths, cast(l_returnflag = 'R' as double) as returned
    from lineitem
"""


def _pairs_sql() -> str:
    names = sorted(_PAIRED)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    parts = [
        f"select '{a}' as f1, '{b}' as f2, "
        + ("max(null::double)" if {a, b} & {*_CONSTANTS} else f"corr({a}, {b})")
        + " as r from n"
        for a, b in pairs
    ]
    return f"with n as ({_NUMBERS_SQL}) " + " union all ".join(parts)


def pearson(spark, folder):
    return pearson_pairs(_numbers(spark, folder), _PAIRED).withColumn("r", F.round("r", 6))


SQL["pearson"] = f"select f1, f2, round(r, 6) as r from ({_pairs_sql()})"


_FLAGS = [f"part_{i}" for i in range(22)]
_WIDE = ["far", "farther", "l_quantity", "tenth", *_FLAGS]


def pearson_wide(spark, folder):
    """More than 25 columns: most nearly always zero, two far from zero with little spread."""
    quantity = F.col("l_quantity")
    lines = table(spark, folder, "lineitem").select(
        "l_quantity",
        (quantity + 1.7e9).alias("far"),
        (1.7e9 - F.col("l_linenumber") + quantity / 4).alias("farther"),
        F.lit(0.1).alias("tenth"),
        *[(F.col("l_partkey") % 97 == i).cast("int").alias(c) for i, c in enumerate(_FLAGS)],
    )
    return pearson_pairs(lines, _WIDE).withColumn("r", F.round("r", 6))


_WIDE_PAIRS = [(a, b) for a in sorted(_WIDE) for b in sorted(_WIDE) if a < b]
SQL["pearson_wide"] = f"""
    with n as (select l_quantity, l_quantity + 1.7e9 as far, 1.7e9 - l_linenumber + l_quantity / 4 as farther,
               {', '.join(f"cast(l_partkey % 97 = {i} as double) as {c}" for i, c in enumerate(_FLAGS))}
               from lineitem)
    """ + " union all ".join(
    f"select '{a}' as f1, '{b}' as f2, "
    + ("max(null::double)" if "tenth" in (a, b) else f"round(corr({a}, {b}), 6)")
    + " as r from n"
    for a, b in _WIDE_PAIRS
)


def correlated_verdict(spark, folder):
    """Scores are the absolute correlations with the label, rounded so that both engines agree on ties."""
    numbers = _numbers(spark, folder)
    label = pearson_pairs(numbers, [*_PAIRED, "returned"]).filter("f1 = 'returned' or f2 = 'returned'")
    name = F.when(F.col("f1") == "returned", F.col("f2")).otherwise(F.col("f1"))
    scores = label.select(name.alias("feature_name"), F.round(F.abs("r"), 9).alias("score"))
    return correlated(pearson_pairs(numbers, _PAIRED), scores, 0.9)


SQL["correlated_verdict"] = f"""
    with p as ({_pairs_sql()}), n as ({_NUMBERS_SQL}),
    s as ({' union all '.join(f"select '{c}' as f, " + ("max(null::double)" if c in _CONSTANTS else f"round(abs(corr({c}, returned)), 9)") + " as score from n" for c in _PAIRED)})
    select distinct case when coalesce(a.score, 0) < coalesce(b.score, 0) then f1 else f2 end as feature_name
    from p left join s a on a.f = f1 left join s b on b.f = f2
    where abs(r) >= 0.9
"""


def auc_lineitem(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    out = roc_auc(lines, "returned", "l_extendedprice", ["l_linestatus"])
    return out.select("l_linestatus", "pos_cnt", "neg_cnt", F.round("auc", 9).alias("auc"))


SQL["auc_lineitem"] = f"""
    select a.l_linestatus, pos_cnt, neg_cnt, round(auc, 9) as auc
    from ({auc_sql("select *, cast(l_returnflag = 'R' as int) as returned from lineitem", "returned", "l_extendedprice", "l_linestatus")}) a
    join (select l_linestatus, count(*) filter (where l_returnflag = 'R') as pos_cnt,
                 count(*) filter (where l_returnflag <> 'R') as neg_cnt
          from lineitem group by l_linestatus) c on a.l_linestatus = c.l_linestatus
"""


def _document_long(spark, folder):
    docs = document_features(spark, folder).drop("toxic")
    return unpivot_numbers(docs, DOCUMENT_FEATURES)


_DOCUMENT_LONG = f"""
    select doc_id, quality, feature_name, feature_value
    from ({DOCUMENT_SQL}) unpivot (feature_value for feature_name in ({', '.join(DOCUMENT_FEATURES)}))
"""


def auc_documents(spark, folder):
    out = roc_auc(_document_long(spark, folder), "quality", "feature_value", ["feature_name"])
    return out.select("feature_name", F.round("auc", 9).alias("auc"))


SQL["auc_documents"] = f"""
    select feature_name, round(auc, 9) as auc
    from ({auc_sql(_DOCUMENT_LONG, "quality", "feature_value", "feature_name")})
"""


def rmse_by_flag(spark, folder):
    lines = table(spark, folder, "lineitem")
    guess = 1500 * F.col("l_quantity")
    out = rmse(lines, "l_extendedprice", guess, ["l_returnflag"])
    return out.select("l_returnflag", F.round("rmse", 4).alias("rmse"))


SQL["rmse_by_flag"] = """
    select l_returnflag, round(sqrt(avg((l_extendedprice - 1500 * l_quantity) ** 2)), 4) as rmse
    from lineitem group by l_returnflag
"""


def feature_drift(spark, folder):
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    late = F.col("o_orderdate") >= moment("1996-06-01 00:00:00")
    out = drift_auc(Splits(orders.filter(~late), orders.filter(late)), ["o_custkey", "o_totalprice", "year"])
    return out.withColumn("auc", F.round("auc", 9))


_DRIFT = """
    select cast(o_orderdate >= timestamp '1996-06-01 00:00:00' as int) as tag, feature_name, feature_value
    from (select o_orderdate, cast(o_custkey as double) as o_custkey, o_totalprice,
                 cast(year(o_orderdate) as double) as "year" from orders)
    unpivot (feature_value for feature_name in (o_custkey, o_totalprice, "year"))
"""
SQL["feature_drift"] = f"""
    select feature_name, round(greatest(auc, 1 - auc), 9) as auc
    from ({auc_sql(_DRIFT, "tag", "feature_value", "feature_name")})
"""


def noise_column(spark, folder):
    orders = add_noise(table(spark, folder, "orders"), "o_orderkey")
    return orders.select("o_orderkey", F.round("noise_feature", 9).alias("noise_feature"))


SQL["noise_column"] = f"""
    select o_orderkey, round({hash_sql('o_orderkey', 'noise')} / 4294967296.0::double, 9) as noise_feature
    from orders
"""


def permute_in_fold(spark, folder):
    orders = kfold(table(spark, folder, "orders"), "o_orderkey", 4)
    shuffled = permute(orders, ["o_totalprice", "o_orderpriority"], "o_orderkey", ["fold_id"])
    return shuffled.select("o_orderkey", "fold_id", "perm_o_totalprice", "perm_o_orderpriority")


SQL["permute_in_fold"] = f"""
    with f as (select *, cast({hash_sql('o_orderkey', 'fold')} % 4 as int) as fold_id,
                      {hash_sql('o_orderkey', 'permute')} as h from orders)
    select o_orderkey, fold_id,
           coalesce(lead(o_totalprice) over w, first_value(o_totalprice) over w) as perm_o_totalprice,
           coalesce(lead(o_orderpriority) over w, first_value(o_orderpriority) over w) as perm_o_orderpriority
    from f window w as (partition by fold_id order by h, o_orderkey)
"""


def permute_hot_groups(spark, folder):
    """Values shuffled among the events of a type; the key, a user, repeats, so content decides too."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    shuffled = permute(events, ["value"], ["user_id", "event_id"], ["event_type"])
    return shuffled.select("event_id", "event_type", "perm_value")


SQL["permute_hot_groups"] = f"""
    select event_id, event_type, coalesce(lead(value) over w, first_value(value) over w) as perm_value
    from (select *, {hash_sql("concat_ws(':', user_id, event_id)", 'permute')} as h from events)
    window w as (partition by event_type order by h, user_id, event_id)
"""


def _fold_importance(spark, folder):
    """A fold importance table without a model: |AUC - 1/2| of each document feature per fold."""
    docs = add_noise(kfold(document_features(spark, folder), "doc_id", 4), "doc_id").drop("toxic")
    long = unpivot_numbers(docs, [*DOCUMENT_FEATURES, "noise_feature"])
    table_ = roc_auc(long, "quality", "feature_value", ["fold_id", "feature_name"])
    return table_.select("fold_id", "feature_name", F.round(F.abs(F.col("auc") - 0.5), 9).alias("importance"))


_LONG_FOLDS = f"""
    select fold_id, quality, feature_name, feature_value
    from (select *, cast({hash_sql('doc_id', 'fold')} % 4 as int) as fold_id,
                 {hash_sql('doc_id', 'noise')} / 4294967296.0::double as noise_feature from ({DOCUMENT_SQL}))
    unpivot (feature_value for feature_name in ({', '.join(DOCUMENT_FEATURES)}, noise_feature))
"""
_IMPORTANCE = f"""
    select fold_id, feature_name, round(abs(auc - 0.5), 9) as importance
    from ({auc_sql(_LONG_FOLDS, "quality", "feature_value", "fold_id, feature_name")})
"""


def importance_by_fold(spark, folder):
    return _fold_importance(spark, folder)


SQL["importance_by_fold"] = _IMPORTANCE


def vote_ratio_noise(spark, folder):
    flags = above_noise(_fold_importance(spark, folder), "noise_feature")
    return vote(flags, "is_above_noise", 4, 0.7)


SQL["vote_ratio_noise"] = f"""
    with i as ({_IMPORTANCE}), n as (select fold_id, importance as noise from i where feature_name = 'noise_feature')
    select feature_name, cast(sum(cast(importance > noise as int)) as bigint) as votes,
           sum(cast(importance > noise as int)) / 4.0::double as ratio
    from i join n on i.fold_id = n.fold_id where feature_name <> 'noise_feature'
    group by feature_name having ratio >= 0.7
"""


def excluded_by_vote(spark, folder):
    """The analysed features that did not get enough votes."""
    importance = _fold_importance(spark, folder).filter("feature_name <> 'noise_feature'")
    flags = above_threshold(importance, 0.05, "importance")
    kept = vote(flags, "is_above_threshold", 4, 0.7)
    return importance.select("feature_name").distinct().join(kept, "feature_name", "left_anti")


SQL["excluded_by_vote"] = f"""
    with i as ({_IMPORTANCE})
    select feature_name from i where feature_name <> 'noise_feature' group by feature_name
    having not sum(cast(importance > 0.05 as int)) / 4.0 >= 0.7
"""


def vote_ratio_threshold(spark, folder):
    flags = above_threshold(_fold_importance(spark, folder), 0.05, "importance")
    return vote(flags, "is_above_threshold", 4, 0.7)


SQL["vote_ratio_threshold"] = f"""
    select feature_name, cast(sum(cast(importance > 0.05 as int)) as bigint) as votes,
           sum(cast(importance > 0.05 as int)) / 4.0::double as ratio
    from ({_IMPORTANCE}) group by feature_name having ratio >= 0.7
"""


def ranked_features(spark, folder):
    out = importance_rank(_fold_importance(spark, folder))
    return out.withColumn("importance", F.round("importance", 6))


SQL["ranked_features"] = f"""
    select feature_name, round(avg(importance), 6) as importance from ({_IMPORTANCE})
    group by feature_name order by avg(importance) desc, feature_name
"""


def most_important(spark, folder):
    return top_feature(_fold_importance(spark, folder)).withColumn("importance", F.round("importance", 6))


SQL["most_important"] = SQL["ranked_features"] + " limit 1"


def mean_fold_auc(spark, folder):
    orders = kfold(urgent_orders(spark, folder), "o_orderkey", 8)
    per_fold = roc_auc(orders, "urgent", "o_totalprice", ["fold_id"])
    return mean_metric(per_fold, "auc").withColumn("auc", F.round("auc", 9))


SQL["mean_fold_auc"] = f"""
    select round(avg(auc), 9) as auc from ({auc_sql(
        f"select *, cast(o_orderpriority = '1-URGENT' as int) as urgent, {hash_sql('o_orderkey', 'fold')} % 8 as fold_id from orders",
        "urgent", "o_totalprice", "fold_id")})
"""


def linear_contribution(spark, folder):
    lines = table(spark, folder, "lineitem")
    weights = {"l_quantity": 0.02, "l_extendedprice": -0.00001, "l_discount": 3.5, "l_tax": 0.0}
    return mean_contribution(lines, weights).withColumn("importance", F.round("importance", 8))


SQL["linear_contribution"] = """
    with m as (select avg(l_quantity) as q, avg(l_extendedprice) as p, avg(l_discount) as d from lineitem)
    select 'l_quantity' as feature_name, round(avg(abs(0.02 * (l_quantity - q))), 8) as importance from lineitem, m
    union all select 'l_extendedprice', round(avg(abs(-0.00001::double * (l_extendedprice - p))), 8) from lineitem, m
    union all select 'l_discount', round(avg(abs(3.5::double * (l_discount - d))), 8) from lineitem, m
    union all select 'l_tax', 0.0
"""

QUERIES.update({name: globals()[name] for name in SQL})
