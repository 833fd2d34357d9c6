"""Scans, projections, sampling, folds and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurelab.operators.clean import (
    decimal_to_float,
    drop_columns,
    fill_missing,
    final_projection,
    unpivot_text,
)
from featurelab.operators.dedup import TAG, dedup, dedup_splits, tag_and_union
from featurelab.operators.dominant import dominant_ratio, value_shares
from featurelab.operators.folds import fold_sizes, kfold, train_flag
from featurelab.operators.sampling import bernoulli, class_counts, rebalance, sample_to, take_exact
from featurelab.operators.splits import Splits, classify
from featurelab.plans.checks.inputs import (
    LINE_KEY,
    LINE_KEY_TEXT,
    digest_sql,
    hash_sql,
    moment,
    table,
    urgent_orders,
)
from featurelab.sources.tables import read_table

QUERIES, SQL = {}, {}


def scan_parquet(spark, folder):
    return table(spark, folder, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


SQL["scan_parquet"] = """
    select * replace (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate) from lineitem
"""


def scan_table(spark, folder):
    table(spark, folder, "customer").createOrReplaceTempView("featurelab_customer")
    return read_table(spark, "featurelab_customer")


SQL["scan_table"] = "select * from customer"


def column_roles(spark, folder):
    """Role of every column, with the number of values it holds."""
    docs = table(spark, folder, "embeddings").join(
        table(spark, folder, "documents").withColumnRenamed("doc_id", "vec_id"), "vec_id"
    )
    roles = classify(docs, "vec_id", "label", ["source"], ["n_chars"])
    counts = docs.agg(*[F.count(c).alias(c) for c in docs.columns])
    entries = [
        F.struct(F.lit(c).alias("name"), F.lit(roles.role_of(c)).alias("role"), F.col(c).alias("n_values"))
        for c in docs.columns
    ]
    return counts.select(F.inline(F.array(*entries)))


SQL["column_roles"] = """
    with j as (select * from embeddings e join documents d on e.vec_id = d.doc_id)
    select 'vec_id' as name, 'index' as role, count(vec_id) as n_values from j
    union all select 'embedding', 'other', count(embedding) from j
    union all select 'label', 'target', count(label) from j
    union all select 'text', 'categorical', count("text") from j
    union all select 'lang', 'categorical', count(lang) from j
    union all select 'source', 'skip', count(source) from j
    union all select 'n_chars', 'categorical', count(n_chars) from j
"""


_MONEY = ("l_extendedprice", "l_discount", "l_tax")


def unpivot_long(spark, folder):
    lines = table(spark, folder, "lineitem")
    lines = lines.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    # money as numbers of two digits, whose text form is the same everywhere
    lines = lines.withColumns({c: F.col(c).cast("decimal(12,2)") for c in _MONEY})
    return unpivot_text(lines, ["l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate", *_MONEY])


SQL["unpivot_long"] = f"""
    select l_orderkey, l_partkey, l_suppkey, feature_name, feature_value
    from (select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as varchar) as l_linenumber,
                 cast(l_quantity as varchar) as l_quantity, l_returnflag, l_linestatus,
                 strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate,
                 {', '.join(f"cast(cast({c} as decimal(12,2)) as varchar) as {c}" for c in _MONEY)} from lineitem)
    unpivot include nulls (feature_value for feature_name in (
        l_linenumber, l_quantity, l_returnflag, l_linestatus, l_shipdate, {', '.join(_MONEY)}))
"""


def _lines_with_gaps(spark, folder):
    """Lineitem with a constant column and one that is mostly NULL."""
    lines = table(spark, folder, "lineitem")
    rare = F.when(F.col("l_linenumber") == 7, F.col("l_tax"))
    return lines.withColumns({"constant": F.lit("same"), "mostly_null": rare})


_SHARES = """
    with v as (
        select * from (
            select cast(l_orderkey as varchar) as l_orderkey, cast(l_partkey as varchar) as l_partkey,
                   cast(l_suppkey as varchar) as l_suppkey, cast(l_linenumber as varchar) as l_linenumber,
                   cast(l_quantity as varchar) as l_quantity, cast(l_extendedprice as varchar) as l_extendedprice,
                   cast(l_discount as varchar) as l_discount, cast(l_tax as varchar) as l_tax,
                   l_returnflag, l_linestatus, cast(l_shipdate as varchar) as l_shipdate, 'same' as constant,
                   cast(case when l_linenumber = 7 then l_tax end as varchar) as mostly_null
            from lineitem)
        unpivot include nulls (value for feature_name in (*))
    ), c as (select feature_name, value, count(*) as cnt from v group by feature_name, value)
    select feature_name, cast(sum(cnt) as bigint) as total_cnt, max(cnt) as max_cnt,
           round(max(cnt) / cast(sum(cnt) as double), 9) as ratio
    from c group by feature_name
"""


def value_share_report(spark, folder):
    lines = _lines_with_gaps(spark, folder)
    return value_shares(lines, lines.columns).withColumn("ratio", F.round("ratio", 9))


SQL["value_share_report"] = _SHARES


def dominant_columns(spark, folder):
    lines = _lines_with_gaps(spark, folder)
    return dominant_ratio(lines, lines.columns, 0.3).withColumn("ratio", F.round("ratio", 9))


SQL["dominant_columns"] = f"select * from ({_SHARES}) where ratio >= 0.3"


def drop_forced(spark, folder):
    orders = table(spark, folder, "orders")
    return drop_columns(Splits(orders, orders), ["o_orderdate", "o_orderstatus", "not_there"]).valid


SQL["drop_forced"] = "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders"


def decimals_as_float(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("skipped"),
    )
    return decimal_to_float(orders, ["skipped"]).select(
        "o_orderkey",
        F.round(F.col("price").cast("double"), 4).alias("price"),
        F.col("skipped").cast("string").alias("skipped"),
    )


SQL["decimals_as_float"] = """
    select o_orderkey, round(cast(cast(cast(o_totalprice as decimal(15,2)) as float) as double), 4) as price,
           cast(cast(o_totalprice as decimal(15,2)) as varchar) as skipped
    from orders
"""


def filled_gaps(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        *LINE_KEY,
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
        F.when(F.col("l_tax") > 0.04, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("tax"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
    )
    return fill_missing(lines, classify(lines, "l_orderkey"), -1.0, "NA")


SQL["filled_gaps"] = """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           coalesce(nullif(l_discount, 0), -1.0) as discount,
           case when l_tax > 0.04 then -1.0 else l_tax end as tax,
           coalesce(nullif(l_returnflag, 'N'), 'NA') as flag
    from lineitem
"""


def output_columns(spark, folder):
    orders = urgent_orders(spark, folder)
    roles = classify(orders, "o_orderkey", "urgent", ["o_custkey"]).without(["o_orderpriority"])
    return final_projection(orders, roles)


SQL["output_columns"] = """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           cast(o_orderpriority = '1-URGENT' as int) as urgent
    from orders
"""


def label_counts(spark, folder):
    return class_counts(urgent_orders(spark, folder), "urgent")


SQL["label_counts"] = """
    select cast(o_orderpriority = '1-URGENT' as int) as urgent, count(*) as cnt from orders group by 1
"""


def rebalanced(spark, folder):
    return rebalance(urgent_orders(spark, folder), "urgent", 0.3, "o_orderkey").select(
        "o_orderkey", "urgent", "o_totalprice"
    )


SQL["rebalanced"] = f"""
    with o as (select *, cast(o_orderpriority = '1-URGENT' as int) as urgent from orders),
    p as (select count(*) as pos from o where urgent = 1),
    n as (select *, row_number() over (order by {digest_sql('o_orderkey', 'rebalance')}) as rn
          from o where urgent = 0)
    select o_orderkey, urgent, o_totalprice from o where urgent = 1
    union all
    select o_orderkey, urgent, o_totalprice from n, p
    where rn <= floor(cast(pos as decimal(18,0)) * 7 / 3)
"""


def hash_sample(spark, folder):
    orders = table(spark, folder, "orders")
    return sample_to(orders, "o_orderkey", 5000).select("o_orderkey", "o_custkey", "o_totalprice")


SQL["hash_sample"] = f"""
    select o_orderkey, o_custkey, o_totalprice from orders
    where {hash_sql('o_orderkey', 'sample')}
          < least(1.0, 5000 / cast((select count(*) from orders) as double)) * 4294967296
"""


def sample_exact_n(spark, folder):
    return take_exact(table(spark, folder, "lineitem"), LINE_KEY, 2500).select(*LINE_KEY, "l_quantity")


SQL["sample_exact_n"] = f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from lineitem
    order by {digest_sql(LINE_KEY_TEXT, 'take')} limit 2500
"""


def sample_users_whole(spark, folder):
    """Rows are told apart by their key: all events of a user fall into the same fold and sample."""
    events = kfold(table(spark, folder, "events"), "user_id", 5)
    return bernoulli(events, "user_id", 0.4).select("event_id", "user_id", "fold_id")


SQL["sample_users_whole"] = f"""
    select event_id, user_id, cast({hash_sql('user_id', 'fold')} % 5 as int) as fold_id
    from events where {hash_sql('user_id', 'sample')} < 0.4 * 4294967296
"""


def _folded(spark, folder):
    orders = kfold(table(spark, folder, "orders"), "o_orderkey", 8)
    return train_flag(orders, "o_orderkey", 0.3)


def kfold_split(spark, folder):
    return _folded(spark, folder).select("o_orderkey", "fold_id", "is_train")


_FOLDS = f"""
    select o_orderkey, cast({hash_sql('o_orderkey', 'fold')} % 8 as int) as fold_id,
           cast({hash_sql('o_orderkey', 'split')} >= 0.3 * 4294967296 as int) as is_train
    from orders
"""
SQL["kfold_split"] = _FOLDS


def fold_counts(spark, folder):
    return fold_sizes(_folded(spark, folder))


SQL["fold_counts"] = f"""
    select fold_id, count(*) as total_cnt, cast(sum(is_train) as bigint) as train_cnt,
           cast(sum(1 - is_train) as bigint) as valid_cnt
    from ({_FOLDS}) group by fold_id
"""


def dedup_single(spark, folder):
    return dedup(table(spark, folder, "documents"), ["text"], "doc_id")


SQL["dedup_single"] = """
    select * from documents qualify row_number() over (partition by text order by doc_id) = 1
"""


def _event_splits(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    border = F.to_timestamp(F.lit("2024-01-08 00:00:00")) if dict(events.dtypes)["ts"] == "timestamp" else moment("2024-01-08 00:00:00")
    late = F.col("ts") >= border
    return Splits(events.filter(~late).drop("ts"), events.filter(late).drop("ts"))


def dedup_cross_split(spark, folder):
    unique = dedup_splits(_event_splits(spark, folder), ["user_id", "event_type"], "event_id")
    return tag_and_union(unique.train, unique.valid)


_EVENTS = """
    select event_id, user_id, event_type, value, cast(ts < timestamp '2024-01-08 00:00:00' as int) as is_train_
    from events
"""
SQL["dedup_cross_split"] = f"""
    select * from ({_EVENTS})
    qualify row_number() over (partition by user_id, event_type order by is_train_ desc, event_id) = 1
"""


def union_tagged(spark, folder):
    splits = _event_splits(spark, folder)
    both = tag_and_union(splits.train, splits.valid)
    return both.groupBy(TAG, "event_type").agg(F.count("*").alias("cnt"), F.max("event_id").alias("last_id"))


SQL["union_tagged"] = f"""
    select is_train_, event_type, count(*) as cnt, max(event_id) as last_id from ({_EVENTS}) group by 1, 2
"""

QUERIES.update({name: globals()[name] for name in SQL})
