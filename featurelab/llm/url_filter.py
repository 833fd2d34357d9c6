"""URL filters: fixed rules first, then the reputation of the host by empirical Bayes.

Only DataFrame functions. Outcomes are pages with a label (bad: quality 0). Their counts form three
levels: public suffix (last label of the host), registered domain (last two labels) and host. Each
level has a beta-binomial prior centred on the posterior mean of the level above:

    mean = (bad + STRENGTH * mean_above) / (n + STRENGTH)

with the share over all labelled pages above the suffixes. The strength of each level is fitted by
the method of moments from the spread of the groups with at least two labels, and kept between
`MIN_STRENGTH` and `MAX_STRENGTH`. A host is blocked if even the lower bound of its posterior,
mean - Z * deviation, exceeds `BLOCK_ABOVE`; hosts without labels inherit the means above them
and, having no counts of their own, get the widest bound.

Null urls and urls without `://` have an empty host and path; they fit no rule and take part like
any other host. Repeated rows are judged one by one, labels that are null are no outcomes, and a page
labelled twice counts twice. Without labels every url is allowed unless a rule blocks it. An empty
table gives an empty result. Only id and url are read, so columns with clashing names do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm.common import read
from featurelab.sources.scratch import stage

#: (verdict, host, path prefix); the longest that fits wins.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MIN_STRENGTH = 1.0
MAX_STRENGTH = 1000.0
Z = 1.645
BLOCK_ABOVE = 0.3

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def rule_columns(host: Column, path: Column, rules: Sequence) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, site, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(
            path, F.lit(prefix)
        )
        name = F.when(fits, F.lit(site + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def strength(groups: DataFrame) -> Column:
    """Prior strength by moments: how little the groups' shares differ beyond chance.

    With group shares p_i of n_i labels and overall share p, the beta-binomial has
    sum n_i (p_i - p)^2 = p (1 - p) sum (1 + (n_i - 1) r), and the strength is 1 / r - 1.
    """
    n, k = F.sum("n").cast("double"), F.count(F.lit(1)).cast("double")
    bad = F.sum("bad").cast("double")
    p = F.try_divide(bad, n)
    squares = F.sum(F.col("bad") * F.col("bad") / F.col("n")) - F.try_divide(bad * bad, n)
    chance = p * (1 - p)
    r = F.try_divide(squares - chance * k, chance * (n - k))
    fitted = F.when(r > 0, F.try_divide(F.lit(1.0), r) - 1).otherwise(MAX_STRENGTH)
    bounded = F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), fitted))
    return groups.where(F.col("n") >= 2).agg(bounded).scalar()


def reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior mean and deviation per host from rows (host, bad: 0, 1 or null for no label).

    Counts are summed before they move and written once; all that follows has one row per
    host, domain or suffix.
    """
    hosts = stage(
        outcomes.groupBy("host").agg(
            F.count("bad").alias("n"),
            F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"),
        ),
        "hosts",
    ).withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})

    def summed(level: DataFrame, *by: str) -> DataFrame:
        return level.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    domains = summed(hosts, "domain", "suffix")
    suffixes = summed(domains, "suffix")
    share = F.coalesce(F.try_divide(F.sum("bad"), F.sum("n")), F.lit(0.0))
    overall = hosts.agg(share).scalar()

    def shrunk(above: Column, weight: Column) -> Column:
        return (F.col("bad") + weight * above) / (F.col("n") + weight)

    s = suffixes.select("suffix", shrunk(overall, strength(suffixes)).alias("m1"))
    d = domains.join(s, "suffix").select(
        "domain", shrunk(F.col("m1"), strength(domains)).alias("m2")
    )
    h = (
        hosts.withColumn("weight", strength(hosts))
        .join(d, "domain")
        .select(
            "host",
            shrunk(F.col("m2"), F.col("weight")).alias("mean"),
            (F.col("n") + F.col("weight")).alias("weight"),
        )
    )
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return h.select("host", "mean", spread.alias("deviation"))


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence = RULES,
    key: str = "page_id",
    url: str = "url",
    label_key: str = "doc_id",
) -> DataFrame:
    """(key, host, path, rule, verdict, bad_share, bad_bound) of every url."""
    rows = pages.select(
        F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    outcomes = labels.select(
        F.col(label_key).alias("key"), (F.col("quality") == 0).cast("int").alias("bad")
    )
    hosts = reputation(rows.select("key", "host").join(outcomes, "key", "left"))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    bound = F.col("mean") - Z * F.col("deviation")
    learnt = F.when(bound > BLOCK_ABOVE, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(hosts, "host", "left").select(
        F.col("key").alias(key),
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, learnt).alias("verdict"),
        F.round("mean", 6).alias("bad_share"),
        F.round(bound, 6).alias("bad_bound"),
    )


def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return judge(read(spark, folder, "pages"), read(spark, folder, "labels"))
