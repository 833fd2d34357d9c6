"""Encoders, scalers and whole preparation runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurelab.operators.encode import apply_encoding, fit_label, fit_target
from featurelab.operators.sampling import sample_to
from featurelab.operators.scale import apply_scaler, fit_scaler
from featurelab.operators.splits import Splits
from featurelab.plans.checks.inputs import LINE_KEY, digest_sql, hash_sql, moment, table, urgent_orders
from featurelab.plans.prepare import apply, run

QUERIES, SQL = {}, {}


def _dictionary(encoder, digits=None):
    code = F.col("code") if digits is None else F.round("code", digits)
    return encoder.select("feature", "value", "n", code.alias("code"))


def label_dictionary(spark, folder):
    return _dictionary(fit_label(table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"], "o_orderkey"))


SQL["label_dictionary"] = """
    select feature, value, n, cast(row_number() over (partition by feature order by first) as double) as code
    from (
        select 'o_orderstatus' as feature, o_orderstatus as value, count(*) as n, min(o_orderkey) as first
        from orders group by o_orderstatus
        union all
        select 'o_orderpriority', o_orderpriority, count(*), min(o_orderkey) from orders group by o_orderpriority
    )
"""


def label_encode(spark, folder):
    orders = table(spark, folder, "orders")
    columns = ["o_orderstatus", "o_orderpriority"]
    encoder = fit_label(orders, columns, "o_orderkey")
    return apply_encoding(orders, encoder, columns, "label_encoder").select("o_orderkey", *columns)


def _codes_sql(column: str, source: str, key: str) -> str:
    return f"""select {column} as value, cast(row_number() over (order by min({key})) as int) as code
               from {source} group by {column}"""


SQL["label_encode"] = f"""
    select o_orderkey, s.code as o_orderstatus, p.code as o_orderpriority
    from orders
    join ({_codes_sql('o_orderstatus', 'orders', 'o_orderkey')}) s on s.value = o_orderstatus
    join ({_codes_sql('o_orderpriority', 'orders', 'o_orderkey')}) p on p.value = o_orderpriority
"""


def label_encode_long(spark, folder):
    """Dictionaries of as many entries as rows, taken through the shuffled look-up."""
    customers = table(spark, folder, "customer").withColumn("balance", F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    columns = ["c_name", "balance", "c_mktsegment"]
    encoder = fit_label(customers, columns, "c_custkey")
    coded = apply_encoding(customers, encoder, columns, "label_encoder", broadcast_rows=2)
    return coded.select("c_custkey", *columns)


_LONG = "(select *, cast(cast(c_acctbal as decimal(12,2)) as varchar) as balance from customer)"
SQL["label_encode_long"] = f"""
    select c_custkey, n.code as c_name, b.code as balance, m.code as c_mktsegment
    from {_LONG} c
    join ({_codes_sql('c_name', _LONG, 'c_custkey')}) n on n.value = c.c_name
    join ({_codes_sql('balance', _LONG, 'c_custkey')}) b on b.value = c.balance
    join ({_codes_sql('c_mktsegment', _LONG, 'c_custkey')}) m on m.value = c.c_mktsegment
"""


def label_encode_unknown(spark, folder):
    """Fit on the parts of small sizes; most names appear there, some are unknown, some missing."""
    parts = table(spark, folder, "part").withColumn("kind", F.nullif(F.col("p_name"), F.lit("small ring")))
    encoder = fit_label(parts.filter("p_size < 2"), ["kind"], "p_partkey")
    return apply_encoding(parts, encoder, ["kind"], "label_encoder").select("p_partkey", "kind")


SQL["label_encode_unknown"] = """
    with p as (select *, nullif(p_name, 'small ring') as kind from part),
    d as (select kind as value, cast(row_number() over (order by min(p_partkey)) as int) as code
          from p where p_size < 2 group by kind)
    select p_partkey,
           cast(case when kind is null then coalesce((select code from d where value is null), -2)
                     else coalesce(code, -1) end as int) as kind
    from p left join d on d.value = p.kind
"""


def label_encode_sampled(spark, folder):
    """The dictionary is fitted on a hash sample, as with a configured sample size."""
    customers = table(spark, folder, "customer")
    sample = sample_to(customers, "c_custkey", 300, salt="fit-sample")
    encoder = fit_label(sample, ["c_name"], "c_custkey")
    return apply_encoding(customers, encoder, ["c_name"], "label_encoder").select("c_custkey", "c_name")


SQL["label_encode_sampled"] = f"""
    with s as (select * from customer where {hash_sql('c_custkey', 'fit-sample')}
               < least(1.0, 300 / cast((select count(*) from customer) as double)) * 4294967296),
    d as ({_codes_sql('c_name', 's', 'c_custkey')})
    select c_custkey, coalesce(code, -1) as c_name from customer left join d on value = c_name
"""


def target_encode(spark, folder):
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type"),
        "l_partkey",
    )
    lines = lines.withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    encoder = fit_target(lines.filter("l_quantity <= 30"), ["p_brand", "p_type"], "returned")
    encoded = apply_encoding(lines, encoder, ["p_brand", "p_type"], "target_encoder")
    return encoded.select(
        *LINE_KEY, F.round("p_brand", 8).alias("p_brand"), F.round("p_type", 8).alias("p_type")
    )


def _means_sql(column: str) -> str:
    return f"""
        select value, p.prior * (1 - w) + m * w as code from (
            select {column} as value, avg(returned) as m,
                   1 / (1 + exp(-(count(*) - 100) / 20.0::double)) as w
            from f group by {column}), (select avg(returned) as prior from f) p
    """


SQL["target_encode"] = f"""
    with j as (select *, cast(l_returnflag = 'R' as int) as returned
               from lineitem join part on p_partkey = l_partkey),
    f as (select * from j where l_quantity <= 30)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           round(coalesce(b.code, (select avg(returned) from f)), 8) as p_brand,
           round(coalesce(t.code, (select avg(returned) from f)), 8) as p_type
    from j left join ({_means_sql('p_brand')}) b on b.value = p_brand
           left join ({_means_sql('p_type')}) t on t.value = p_type
"""


def _scaled_customers(spark, folder, method, **options):
    customers = table(spark, folder, "customer")
    columns = ["c_acctbal", "c_nationkey"]
    fitted = fit_scaler(customers.filter("c_custkey % 3 > 0"), columns, method, **options)
    out = apply_scaler(customers, fitted)
    return out.select("c_custkey", *[F.round(c, 8).alias(c) for c in columns])


_FIT = "with f as (select * from customer where c_custkey % 3 > 0) select c_custkey, "


def scale_standard(spark, folder):
    return _scaled_customers(spark, folder, "standard")


SQL["scale_standard"] = f"""{_FIT}
    round((c_acctbal - m) / s, 8) as c_acctbal, round((c_nationkey - mn) / sn, 8) as c_nationkey
    from customer, (select avg(c_acctbal) as m, stddev_pop(c_acctbal) as s,
                           avg(c_nationkey) as mn, stddev_pop(c_nationkey) as sn from f)
"""


def scale_minmax(spark, folder):
    return _scaled_customers(spark, folder, "minmax")


SQL["scale_minmax"] = f"""{_FIT}
    round((c_acctbal - lo) / (hi - lo), 8) as c_acctbal,
    round((c_nationkey - ln) / cast(hn - ln as double), 8) as c_nationkey
    from customer, (select min(c_acctbal) as lo, max(c_acctbal) as hi,
                           min(c_nationkey) as ln, max(c_nationkey) as hn from f)
"""


def scale_binning(spark, folder):
    return _scaled_customers(spark, folder, "binning", bins=7)


SQL["scale_binning"] = f"""{_FIT}
    least(6.0, greatest(0.0, floor((c_acctbal - lo) / (hi - lo) * 7))) as c_acctbal,
    least(6.0, greatest(0.0, floor((c_nationkey - ln) / cast(hn - ln as double) * 7))) as c_nationkey
    from customer, (select min(c_acctbal) as lo, max(c_acctbal) as hi,
                           min(c_nationkey) as ln, max(c_nationkey) as hn from f)
"""


def scale_quantile(spark, folder):
    return _scaled_customers(spark, folder, "quantile", n_quantiles=21)


def _interpolated(column: str) -> str:
    """Mean of the interpolation from the left and from the right over 21 quantiles."""
    return f"""
        select x, case when x = lo then 0.0 when x = hi then 1.0 when x < lo then 0.0 when x > hi then 1.0
                       else (ra + la) / 2 end as y
        from (
            select x, min(g0.v) as lo, max(g0.v) as hi,
                   -- right: last grid point with v <= x, left: first grid point with v >= x
                   max(case when g0.v <= x then g0.k + least(1, coalesce((x - g0.v) / nullif(g0.nxt - g0.v, 0), 0)) end) / 20 as ra,
                   min(case when g0.v >= x then g0.k - least(1, coalesce((g0.v - x) / nullif(g0.v - g0.prv, 0), 0)) end) / 20 as la
            from (select distinct cast({column} as double) as x from customer),
                 (select k, v, lead(v) over (order by k) as nxt, lag(v) over (order by k) as prv
                  from (select unnest(range(21)) as k, unnest(
                      (select quantile_cont(cast({column} as double), [i / 20.0::double for i in range(21)]) from f)
                  ) as v)) g0
            group by x
        )
    """


SQL["scale_quantile"] = f"""
    with f as (select * from customer where c_custkey % 3 > 0)
    select c_custkey, round(a.y, 8) as c_acctbal, round(n.y, 8) as c_nationkey
    from customer join ({_interpolated('c_acctbal')}) a on a.x = c_acctbal
                  join ({_interpolated('c_nationkey')}) n on n.x = c_nationkey
"""


# ---------------------------------------------------------------- whole runs


def order_facts(spark, folder):
    """One row per order with columns of every role."""
    lines = table(spark, folder, "lineitem")
    per_order = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"),
        F.count("*").alias("n_lines"),
        F.avg("l_discount").alias("discount"),
    )
    customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return (
        urgent_orders(spark, folder)
        .join(customers, "o_custkey")
        .join(per_order, "o_orderkey", "left")
        .select(
            "o_orderkey", "urgent", "o_custkey", "o_orderdate", "o_orderstatus", "c_mktsegment",
            "c_name", "c_nationkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
            "quantity", "n_lines", "discount", F.lit("EUR").alias("currency"),
            F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment_gap"),
        )
    )


_FACTS = """
    select o_orderkey, cast(o_orderpriority = '1-URGENT' as int) as urgent, o_custkey, o_orderdate,
           o_orderstatus, c_mktsegment, c_nationkey,
           cast(cast(o_totalprice as decimal(15,2)) as float) as price,
           coalesce(quantity, 0) as quantity, coalesce(n_lines, 0) as n_lines, coalesce(discount, 0) as discount,
           coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA') as segment_gap
    from orders join customer on c_custkey = o_custkey
    left join (select l_orderkey, sum(l_quantity) as quantity, count(*) as n_lines, avg(l_discount) as discount
               from lineitem group by l_orderkey) on l_orderkey = o_orderkey
"""

CONFIG = {
    "common": {
        "task_type": "binary_classification",
        "index_col": "o_orderkey",
        "target_col": "urgent",
        "skip_cols": ["o_custkey"],
        "force_drop_cols": ["c_name"],
    },
    "sampling": {"use_sampling": False},
    "preprocessing": {
        "rebalancing": {"positive_frac": 0.3, "apply_to": "train"},
        "drop_uninformative": {"threshold": 0.99},
        "missing_values": {"numeric": 0, "categorical": "NA"},
        "deduplicate": {"subset": ["o_custkey", "o_orderstatus"]},
        "categorical_encoding": {"method": "label_encoder"},
        "scaling": {"method": "standard"},
    },
    "pipeline_steps": [
        "rebalancing",
        "drop_forced_cols",
        "convert_decimal",
        "fill_missing",
        "drop_uninformative",
        "deduplicate",
        "categorical_encoding",
        "scaling",
    ],
}
_NUMERIC = ["c_nationkey", "price", "quantity", "n_lines", "discount"]
_CATEGORICAL = ["o_orderstatus", "c_mktsegment", "segment_gap"]


def date_splits(facts):
    day = F.col("o_orderdate")
    first, second = moment("1996-01-01 00:00:00"), moment("1998-01-01 00:00:00")
    return Splits(
        facts.filter(day < first), facts.filter((day >= first) & (day < second)), facts.filter(day >= second)
    )


def _rounded(df, columns, digits):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def prepared_splits(spark, folder):
    """A full run; the three results under each other."""
    out, _ = run(date_splits(order_facts(spark, folder)), CONFIG)
    named = [df.withColumn("split", F.lit(name)) for name, df in zip(("train", "valid", "scoring"), out)]
    return _rounded(named[0].unionByName(named[1]).unionByName(named[2]), _NUMERIC, 3)


def _encoded(column: str, source: str) -> str:
    return f"""(select {column} as value, row_number() over (order by min(o_orderkey)) as code
                from {source} group by {column})"""


def _standard(column: str) -> str:
    return f"""round(cast(cast((u.{column} - (select avg({column}) from train))
               / (select stddev_pop({column}) from train) as float) as double), 3) as {column}"""


SQL["prepared_splits"] = f"""
    with facts as ({_FACTS}),
    raw as (select *, case when o_orderdate < timestamp '1996-01-01' then 'train'
                           when o_orderdate < timestamp '1998-01-01' then 'valid' else 'scoring' end as split from facts),
    ranked as (select *, row_number() over (order by {digest_sql('o_orderkey', 'rebalance')}) as rn
               from raw where split = 'train' and urgent = 0),
    balanced as (
        select * from raw where split <> 'train' or urgent = 1
        union all
        select * exclude (rn) from ranked
        where rn <= floor(cast((select count(*) from raw where split = 'train' and urgent = 1) as decimal(18,0)) * 7 / 3)
    ),
    once as (
        select * from balanced where split <> 'scoring'
        qualify row_number() over (partition by o_custkey, o_orderstatus
                                   order by case split when 'train' then 0 else 1 end, o_orderkey) = 1
    ),
    train as (select * from once where split = 'train'),
    u as (select * from once union all select * from balanced where split = 'scoring')
    select o_orderkey, urgent, o_custkey, split,
           cast(coalesce(a.code, -1) as int) as o_orderstatus, cast(coalesce(b.code, -1) as int) as c_mktsegment,
           cast(coalesce(c.code, -1) as int) as segment_gap,
           {', '.join(_standard(c) for c in _NUMERIC)}
    from u left join {_encoded('o_orderstatus', 'train')} a on a.value = u.o_orderstatus
           left join {_encoded('c_mktsegment', 'train')} b on b.value = u.c_mktsegment
           left join {_encoded('segment_gap', 'train')} c on c.value = u.segment_gap
"""

APPLY_CONFIG = CONFIG | {
    "preprocessing": CONFIG["preprocessing"]
    | {
        "categorical_encoding": {"method": "target_encoder"},
        "scaling": {"method": "minmax"},
        "deduplicate": {"subset": ["o_custkey"]},
    },
    "pipeline_steps": [s for s in CONFIG["pipeline_steps"] if s != "rebalancing"],
}


def prepared_new_rows(spark, folder):
    """Fit on early orders, apply the state to all later ones."""
    facts = order_facts(spark, folder)
    early = F.col("o_orderdate") < moment("1996-01-01 00:00:00")
    _, state = run(Splits(facts.filter(early)), APPLY_CONFIG)
    out = apply(facts.filter(~early), state)
    return _rounded(out, [*_NUMERIC, *_CATEGORICAL], 4)


def _target_mean(column: str) -> str:
    return f"""(select value, p.prior * (1 - w) + m * w as code from (
                select {column} as value, avg(urgent) as m, 1 / (1 + exp(-(count(*) - 100) / 20.0::double)) as w
                from train group by {column}), (select avg(urgent) as prior from train) p)"""


def _minmax(column: str, table_: str) -> str:
    return f"""round(cast(cast((u.{column} - (select min({column}) from {table_}))
               / cast((select max({column}) - min({column}) from {table_}) as double) as float) as double), 4) as {column}"""


_WITH_CODES = f"""
    select t.* exclude ({', '.join(_CATEGORICAL)}),
           {', '.join(f"coalesce(j{i}.code, (select avg(urgent) from train)) as {c}" for i, c in enumerate(_CATEGORICAL))}
    from %s t {' '.join(f"left join {_target_mean(c)} j{i} on j{i}.value = t.{c}" for i, c in enumerate(_CATEGORICAL))}
"""

SQL["prepared_new_rows"] = f"""
    with facts as ({_FACTS}),
    train as (select * from facts where o_orderdate < timestamp '1996-01-01'
              qualify row_number() over (partition by o_custkey order by o_orderkey) = 1),
    new_rows as (select * from facts where o_orderdate >= timestamp '1996-01-01'
                 qualify row_number() over (partition by o_custkey order by o_orderkey) = 1),
    coded_train as ({_WITH_CODES % 'train'}), coded as ({_WITH_CODES % 'new_rows'})
    select o_orderkey, urgent, o_custkey,
           {', '.join(_minmax(c, 'coded_train') for c in [*_NUMERIC, *_CATEGORICAL])}
    from coded u
"""

QUERIES.update({name: globals()[name] for name in SQL})
