"""Near duplicates: SetSketch bands find candidates, likelihood thins them, full sets decide.

1. One pass over the texts makes, for each document, its number of distinct word shingles, a
   128-bit digest of the set and a SetSketch. Equal sets become one class: copies are not compared.
2. Bands of registers put classes into buckets. With 32 bands of 4 registers, two sets of
   similarity 0.8 share none with probability 5e-8.
3. Each member of a bucket is compared with the head of its bucket, the member that meets most
   others: work in proportion to the members. Pairs whose estimated similarity is below the
   threshold by five deviations are left out; the others are decided on their full sets.
4. Buckets that still hold several components go to an exact prefix join: shingles are ordered
   from rare to frequent, and sets of similarity t share one of their first n - ceil(t n) + 1.
   Only pairs between components are considered, so a large group is not paired with itself.

Links join documents transitively; `component_id` is the smallest id of the component.

Words are the runs without ASCII white space, with A-Z lowered. A text with fewer words than a shingle
has one shingle, the whole sequence; null texts and texts without words have none and are linked with
nothing. Shingles are compared by a 64-bit hash. Rows that share an id count as one document
that has the links of all its texts, and each of the rows is returned. A row without id links nothing and
is kept; it carries the component of the documents with an equal set, if there are any. Ties cannot occur: ids decide. An empty table gives an empty result. Only id
and text are read, so columns with clashing names do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm import setsketch
from featurelab.llm.common import BROADCAST_IDS, read, semi_join, ship, tidy
from featurelab.llm.components import components
from featurelab.llm.setsketch import BANDS, M, mix, passes, sketches
from featurelab.sources.scratch import stage

#: Percent of the union that the intersection must hold.
SIMILAR = 80
#: Five standard deviations of the estimate at the threshold: sqrt(0.8 * 0.2 / M).
SLACK = 5 * (0.8 * 0.2 / M) ** 0.5
#: Shingles handled at a time inside a task.
AT_A_TIME = 400_000


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    of = xxhash.xxh3_64_intdigest
    hashed = np.array([of(w) for w in words], np.uint64)
    k = min(size, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for at in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashed[at : len(words) - k + 1 + at])
    return np.unique(out)


def _in_parts(values, size: int):
    """Lists of (position, set) that hold about AT_A_TIME shingles."""
    part, held = [], 0
    for at, value in enumerate(values):
        found = shingle_set(value.as_py(), size)
        part.append((at, found))
        held += len(found)
        if held >= AT_A_TIME:
            yield part
            part, held = [], 0
    if part:
        yield part


def described(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(id, n, d1, d2, bands) of every row: set size, digest and registers by band."""
    ship(df.sparkSession)

    def describe(batches):
        for batch in batches:
            for part in _in_parts(batch.column(1), size):
                sets = [s for _, s in part]
                counts = np.array([len(s) for s in sets], np.int64)
                owner = np.repeat(np.arange(len(sets)), counts)
                registers = sketches(np.concatenate(sets), owner, len(sets))
                digests = np.array([digest_of(s) for s in sets])
                bands = pa.array(np.ascontiguousarray(registers).view(np.int64).reshape(-1))
                offsets = pa.array(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part[0][0], len(part)),
                        pa.array(counts),
                        pa.array(digests[:, 0].copy()),
                        pa.array(digests[:, 1].copy()),
                        pa.ListArray.from_arrays(offsets, bands),
                    ],
                    ["id", "n", "d1", "d2", "bands"],
                )

    rows = df.select(F.col(key).cast("long").alias("id"), text)
    return rows.mapInArrow(tidy(describe), "id bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>")


def digest_of(found: np.ndarray) -> np.ndarray:
    """Two numbers that stand for a set."""
    return np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)


def sets_of(df: DataFrame, key: str, text: str, size: int, wanted: DataFrame, count: int) -> DataFrame:
    """(node, shingles) of the classes `wanted` (node, id, d1, d2); shingles as sorted 64-bit numbers in a blob.

    A class is told by its smallest id and its digest: an id may come with several texts.
    """

    def make(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(v.as_py(), size) for v in part.column(1)]
                digests = np.array([digest_of(s) for s in sets]).reshape(-1, 2)
                columns = [pa.array(digests[:, i].copy()) for i in (0, 1)]
                blobs = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, blobs], ["id", "d1", "d2", "shingles"])

    rows = df.select(F.col(key).cast("long").alias("id"), text)
    made = semi_join(rows, wanted.select("id").distinct(), "id", count).mapInArrow(
        tidy(make), "id bigint, d1 bigint, d2 bigint, shingles binary"
    )
    small = F.broadcast(wanted) if count <= BROADCAST_IDS else wanted
    return made.join(small, ["id", "d1", "d2"]).select("node", "shingles").dropDuplicates(["node"])


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose joint estimate is not clearly below the threshold."""
    cutoff = SIMILAR / 100 - SLACK

    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.array(batch.column(i).values).view(np.uint16).reshape(batch.num_rows, M)
                for i in (4, 5)
            )
            na, nb = (np.array(batch.column(i)) for i in (2, 3))
            mask = passes(a, b, na, nb, cutoff)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(mask)), batch.column(1).filter(pa.array(mask))], ["a", "b"]
            )

    def side(x: str) -> DataFrame:
        return classes.select(
            F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bands").alias(f"bands{x}")
        )

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    # sizes alone can rule a pair out
    joined = joined.where(
        (100 * F.col("na") >= SIMILAR * F.col("nb")) & (100 * F.col("nb") >= SIMILAR * F.col("na"))
    )
    return joined.select("a", "b", "na", "nb", "bandsa", "bandsb").mapInArrow(tidy(keep), "a bigint, b bigint")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough."""

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= SIMILAR * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"]
            )

    a = sets.withColumnsRenamed({"node": "a", "shingles": "sa"})
    b = sets.withColumnsRenamed({"node": "b", "shingles": "sb"})
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb")
    return joined.mapInArrow(tidy(check), "a bigint, b bigint")


def _from_prefixes(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs between components, by prefix and position; exact for all rows of `rest`.

    rest: (node, component, small), where `small` marks members of components that are not the
    largest in some bucket; at least one side of every pair is such a member.
    """

    def explode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [np.frombuffer(s.as_buffer(), np.int64) for s in part.column(3)]
                owner = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
                tokens = np.concatenate(sets) if sets else np.empty(0, np.int64)
                cols = [part.column(i).take(owner) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(tokens)], ["node", "component", "small", "token"])

    rows = rest.join(sets, "node").select("node", "component", "small", "shingles")
    tokens = stage(
        rows.mapInArrow(tidy(explode), "node bigint, component bigint, small boolean, token bigint"), "tokens"
    )
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    ordered = (
        tokens.join(often, "token")
        .groupBy("node", "component", "small")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))  # one document
        .withColumn("n", F.size("t"))
    )
    length = F.col("n") - F.ceil(F.col("n") * SIMILAR / 100).cast("int") + 1
    prefixes = (
        ordered.select("node", "component", "small", "n", F.posexplode(F.slice("t", F.lit(1), length)).alias("p", "x"))
        .where("x.df > 1")
        .select("node", "component", "small", "n", "p", F.col("x.token").alias("token"))
    )
    prefixes = stage(prefixes, "prefixes")
    x = prefixes.where("small").alias("x")
    y = prefixes.alias("y")
    # if this is the first token they share, no more than the rest of either can follow
    most = 1 + F.least(F.expr("x.n - x.p - 1"), F.expr("y.n - y.p - 1"))
    needed = (F.col("x.n") + F.col("y.n")) * SIMILAR <= (100 + SIMILAR) * most
    pairs = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.component") != F.col("y.component"))
        & needed
        & (~F.col("y.small") | (F.col("x.node") < F.col("y.node"))),
    )
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row; `size` words in a shingle."""
    docs = stage(described(df, key, text, size), "described")
    classes = (
        docs.where("n > 0 and id is not null")
        .groupBy("d1", "d2")
        .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    )
    # a number for each class, in the order of their ids: different classes may have the same smallest id
    ordered = classes.orderBy("id", "d1", "d2").withColumn("node", F.monotonically_increasing_id())
    classes = stage(ordered, "classes")
    bands = classes.select("node", F.posexplode("bands").alias("band", "value")).select(
        "node", F.xxhash64("band", "value").alias("bucket")
    )
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    bands = stage(bands.join(shared, "bucket"), "buckets")
    # the head meets most others over all bands; then the smallest number
    busy = bands.groupBy("node").agg(F.sum("members").alias("busy"))
    ranked = bands.join(busy, "node").select("bucket", "node", "busy")
    most = ranked.groupBy("bucket").agg(F.max("busy").alias("busy"))
    heads = (
        ranked.join(most, ["bucket", "busy"]).groupBy("bucket").agg(F.min("node").alias("b"))
    )
    stars = bands.join(heads, "bucket").where("node != b").select(F.col("node").alias("a"), "b").distinct()

    def sets_for(nodes: DataFrame) -> DataFrame:
        nodes = stage(nodes, "nodes")
        count = nodes.count()
        wanted = semi_join(classes.select("node", "id", "d1", "d2"), nodes, "node", count)
        return stage(sets_of(df, key, text, size, stage(wanted, "wanted"), count), "sets")

    def confirmed(candidates: DataFrame) -> DataFrame:
        candidates = stage(candidates, "candidates")
        nodes = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
        return stage(_confirmed(candidates, sets_for(nodes)), "links")

    links = confirmed(_likely(stars, classes))
    found = components(links)

    # buckets that hold several components still
    component = F.coalesce("component", "node")
    placed = bands.join(found, "node", "left").select("bucket", "node", component.alias("component"))
    held = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    held = held.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component")).alias("top")
    )
    open_ = held.where("parts > 1").select("bucket", F.col("top.component").alias("largest"))
    rest = (
        placed.join(open_, "bucket")
        .groupBy("node", "component")
        .agg(F.max(F.col("component") != F.col("largest")).alias("small"))
    )
    rest = stage(rest, "rest")
    sets = sets_for(rest.select("node"))
    late = stage(_confirmed(_from_prefixes(rest, sets), sets), "links")
    links = links.union(late)
    # an id whose rows differ links their classes
    several = docs.where("n > 0 and id is not null").groupBy("id").agg(
        F.count_distinct("d1", "d2").alias("sets")
    )
    several = several.where("sets > 1").select("id")
    own = docs.join(several, "id").select("id", "d1", "d2").join(classes.select("d1", "d2", "node"), ["d1", "d2"])
    first = own.groupBy("id").agg(F.min("node").alias("b"))
    links = links.union(own.join(first, "id").where("node != b").select(F.col("node").alias("a"), "b").distinct())

    # the first class of a component has its smallest id
    member = classes.select("d1", "d2", "node").join(components(links), "node", "left")
    member = member.select("d1", "d2", F.coalesce("component", "node").alias("part"))
    lowest = classes.select(F.col("node").alias("part"), F.col("id").alias("component"))
    named = member.join(lowest, "part").select("d1", "d2", "component")
    out = docs.join(named, ["d1", "d2"], "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def op9_setsketch_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents"))
