"""Sinks and saved state: written, read back, and compared."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from featurelab.functions.metrics import roc_auc
from featurelab.operators.clean import unpivot_numbers
from featurelab.operators.dominant import dominant_ratio
from featurelab.operators.splits import Splits
from featurelab.plans.checks.fitted import APPLY_CONFIG, CONFIG, SQL as FITTED_SQL
from featurelab.plans.checks.fitted import _CATEGORICAL, _NUMERIC, _rounded, order_facts
from featurelab.plans.checks.inputs import auc_sql, digest_sql, hash_sql, moment, table, urgent_orders
from featurelab.plans.prepare import Preparation, run
from featurelab.plans.state import save_state
from featurelab.sources.scratch import scratch_path
from featurelab.sources.sinks import (
    append_dropped,
    save_splits,
    write_report,
    write_single_file,
    write_table,
)

QUERIES, SQL = {}, {}


def _moments_as_text(df, column):
    """The time column written out, so that both engines name it alike."""
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


def _moment_sql(column):
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') as {column}"


def parquet_sink(spark, folder):
    path = scratch_path(spark, "sink")
    write_table(table(spark, folder, "orders"), "parquet", path)
    return _moments_as_text(spark.read.parquet(path), "o_orderdate")


SQL["parquet_sink"] = f"select * replace ({_moment_sql('o_orderdate')}) from orders"


def table_sink(spark, folder):
    """A catalog table, replaced if it exists; its files lie in the shared folder."""
    events = table(spark, folder, "events")
    write_table(events, "hive", "featurelab_events", scratch_path(spark, "table"))
    return _moments_as_text(spark.table("featurelab_events"), "ts")


SQL["table_sink"] = f"select * replace ({_moment_sql('ts')}) from events"


def single_file_sink(spark, folder):
    """A small aggregate in one part file."""
    path = scratch_path(spark, "single")
    per_flag = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("cnt"))
    write_single_file(per_flag, path)
    return spark.read.parquet(path)


SQL["single_file_sink"] = "select l_returnflag, count(*) as cnt from lineitem group by l_returnflag"


def routed_results(spark, folder):
    """Train and validation to one place, scoring to another, by the configured names."""
    orders = table(spark, folder, "orders")
    third = F.col("o_orderkey") % 3
    splits = Splits(*(orders.filter(third == i) for i in range(3)))
    base = scratch_path(spark, "results")
    names = save_splits(
        splits,
        {"format": "parquet", "save_path": base, "save_path_scoring": f"{base}-scoring", "suffix": "_out"},
    )
    parts = [spark.read.parquet(path).withColumn("split", F.lit(name)) for name, path in names.items()]
    return _moments_as_text(parts[0].unionByName(parts[1]).unionByName(parts[2]), "o_orderdate")


SQL["routed_results"] = f"""
    select * replace ({_moment_sql('o_orderdate')}), case o_orderkey % 3 when 0 then 'train' when 1 then 'test' else 'scoring' end as split
    from orders
"""


def routed_tables(spark, folder):
    """Train and validation as catalog tables, scoring as files."""
    orders = table(spark, folder, "orders")
    third = F.col("o_orderkey") % 3
    splits = Splits(*(orders.filter(third == i) for i in range(3)))
    spark.sql("create database if not exists featurelab_results")
    names = save_splits(
        splits,
        {
            "format": "hive",
            "save_path": "featurelab_results",
            "save_path_scoring": scratch_path(spark, "scoring"),
            "suffix": "_out",
        },
    )
    read = {"train": spark.table, "test": spark.table, "scoring": spark.read.parquet}
    parts = [read[name](place).withColumn("split", F.lit(name)) for name, place in names.items()]
    return _moments_as_text(parts[0].unionByName(parts[1]).unionByName(parts[2]), "o_orderdate")


SQL["routed_tables"] = SQL["routed_results"]


def dropped_record(spark, folder):
    """Two steps append what they drop; the record is read back."""
    path = scratch_path(spark, "dropped")
    lines = table(spark, folder, "lineitem")
    for threshold in (0.3, 0.45):
        found = dominant_ratio(lines, lines.columns, threshold)
        append_dropped(spark, path, f"above {threshold}", [r.feature_name for r in found.collect()])
    return spark.read.parquet(path)


SQL["dropped_record"] = """
    with s as (
        select feature, max(cnt) / cast(sum(cnt) as double) as ratio
        from (select feature, value, count(*) as cnt
              from (select * replace (cast(l_shipdate as varchar) as l_shipdate)
                    from (select cast(columns(*) as varchar) from lineitem))
              unpivot include nulls (value for feature in (*)) group by feature, value)
        group by feature)
    select 'above 0.3' as step, feature from s where ratio >= 0.3
    union all select 'above 0.45', feature from s where ratio >= 0.45
"""


def feature_lists(spark, folder):
    """Final features of a run, from its saved state, with the number of values in each."""
    facts = order_facts(spark, folder)
    path = scratch_path(spark, "state")
    _, state = run(Splits(facts), APPLY_CONFIG)
    save_state(spark, state, path)
    saved = spark.read.parquet(f"{path}/features").filter(F.col("role").isin("numeric", "categorical"))
    counts = facts.agg(*[F.count(c).alias(c) for c in facts.columns])
    entries = [F.struct(F.lit(c).alias("name"), F.col(c).alias("n_values")) for c in facts.columns]
    return saved.join(counts.select(F.inline(F.array(*entries))), "name").select("pos", "name", "role", "n_values")


SQL["feature_lists"] = """
    with f as (
        select o_orderkey, o_orderstatus, c_mktsegment, c_nationkey, o_totalprice, quantity, n_lines, discount,
               nullif(c_mktsegment, 'BUILDING') as segment_gap
        from orders join customer on c_custkey = o_custkey
        left join (select l_orderkey, sum(l_quantity) as quantity, count(*) as n_lines, avg(l_discount) as discount
                   from lineitem group by l_orderkey) on l_orderkey = o_orderkey)
    select 0 as pos, 'o_orderstatus' as name, 'numeric' as role, count(o_orderstatus) as n_values from f
    union all select 1, 'c_mktsegment', 'numeric', count(c_mktsegment) from f
    union all select 2, 'c_nationkey', 'numeric', count(c_nationkey) from f
    union all select 3, 'price', 'numeric', count(o_totalprice) from f
    union all select 4, 'quantity', 'numeric', count(quantity) from f
    union all select 5, 'n_lines', 'numeric', count(n_lines) from f
    union all select 6, 'discount', 'numeric', count(discount) from f
    union all select 7, 'segment_gap', 'numeric', count(segment_gap) from f
"""


def saved_state_applied(spark, folder):
    """Encoder and scaler saved, loaded and applied by a new object: the same as `prepared_new_rows`."""
    facts = order_facts(spark, folder)
    early = F.col("o_orderdate") < moment("1996-01-01 00:00:00")
    config = APPLY_CONFIG | {"artifacts": {"path": scratch_path(spark, "artifacts")}}
    Preparation(spark, config).fit(facts.filter(early))
    out = Preparation(spark, config).transform(facts.filter(~early))
    return _rounded(out, [*_NUMERIC, *_CATEGORICAL], 4)


SQL["saved_state_applied"] = FITTED_SQL["prepared_new_rows"]


def importance_report(spark, folder):
    """Features by drift from even ranking, written as CSV, highest first."""
    orders = urgent_orders(spark, folder)
    long = unpivot_numbers(orders.select("urgent", "o_custkey", "o_totalprice"), ["o_custkey", "o_totalprice"])
    scores = roc_auc(long, "urgent", "feature_value", ["feature_name"]).select(
        "feature_name", F.round(F.abs(F.col("auc") - 0.5), 6).alias("importance")
    )
    path = scratch_path(spark, "report")
    write_report(scores.orderBy(F.desc("importance"), "feature_name"), path, "csv")
    return spark.read.option("header", True).schema("feature_name string, importance double").csv(path)


_LONG = """
    select urgent, feature_name, feature_value from (
        select cast(o_orderpriority = '1-URGENT' as int) as urgent, cast(o_custkey as double) as o_custkey, o_totalprice
        from orders) unpivot (feature_value for feature_name in (o_custkey, o_totalprice))
"""
SQL["importance_report"] = f"""
    select feature_name, round(abs(auc - 0.5), 6) as importance
    from ({auc_sql(_LONG, "urgent", "feature_value", "feature_name")})
"""


def run_manifest(spark, folder):
    """The one-row record of a run's artifacts, without the paths, beside the rows it was fitted on."""
    facts = order_facts(spark, folder)
    path = scratch_path(spark, "state")
    out, state = run(Splits(facts), CONFIG)
    save_state(spark, state, path)
    manifest = spark.read.json(f"{path}/manifest")
    rows = out.train.count()
    return manifest.select("steps", "dedup_subset", "encoding", "fill_categorical", F.lit(rows).alias("rows"))


SQL["run_manifest"] = f"""
    with o as (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority = '1-URGENT' as urgent
               from orders join customer on c_custkey = o_custkey),
    n as (select *, row_number() over (order by {digest_sql('o_orderkey', 'rebalance')}) as rn
          from o where not urgent),
    kept as (select o_custkey, o_orderstatus from o where urgent
             union select o_custkey, o_orderstatus from n
             where rn <= floor(cast((select count(*) from o where urgent) as decimal(18,0)) * 7 / 3))
    select '{json.dumps(CONFIG["pipeline_steps"])}' as steps, '["o_custkey", "o_orderstatus"]' as dedup_subset,
           'label_encoder' as encoding, 'NA' as fill_categorical, count(*) as rows
    from kept
"""

QUERIES.update({name: globals()[name] for name in SQL})
