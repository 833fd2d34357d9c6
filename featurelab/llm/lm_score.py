"""LM scoring by cross-entropy difference of two matched n-gram models.

The models predict a byte from the four before it, so both share one vocabulary, the 256 bytes, and
no text has unknown tokens. The target model is fitted on the documents labelled good (quality 1), the
background model on all documents. A document's score is the mean over its bytes of

    -log2 p_target(byte | before) + log2 p_background(byte | before)

so low scores are close to the target. Four zero bytes stand before each text.

Both models use all five-grams of the corpus, interpolated with trigrams, these with bigrams, single bytes and the
uniform distribution, by Witten-Bell from the model's own counts. No count is cut off; order four is no step.

Null and empty texts have no tokens and a null score. Repeated rows are counted and scored each; a
document with several labels counts as target if any of them is good. Without target documents the
target model is uniform. An empty table gives an empty result. Only ids, texts and labels are read, so
columns with clashing names do not matter.

Five-grams are summed inside each task, then over tasks: what moves grows with the input. A document's
frequent five-grams are looked up in a broadcast of at most `HOT` entries, those most counted; the others are
summed for each document and joined with the table of all five-grams, in which none of them is a hot key. The
division has no influence on the scores. Also broadcast are at most 256^3 trigrams. A text is known in
that join by a 64-bit hash and its length; repeated texts share their sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm.common import BROADCAST_IDS, read, ship, tidy
from featurelab.sources.scratch import stage

SIZE = 256
ORDER = 5
HOT = 2**21  # five-grams that may be broadcast
CHUNK = 2_000_000  # bytes counted at a time


def ngrams(text: str) -> np.ndarray:
    """Number of the five-gram that ends at each byte of a text."""
    data = np.frombuffer(b"\0" * (ORDER - 1) + text.encode("utf-8", "surrogatepass"), np.uint8)
    data, n = data.astype(np.int64), len(data) - ORDER + 1
    out = data[:n]
    for k in range(1, ORDER):
        out = (out << 8) | data[k : k + n]
    return out


def counted(rows: DataFrame) -> DataFrame:
    """(gram, n, target) summed over rows (text, good)."""

    def count(batches):
        # counts of this task, both models
        every: dict[bool, tuple[np.ndarray, np.ndarray]] = {}

        def add(good: bool, parts: list[np.ndarray]) -> None:
            grams, n = np.unique(np.concatenate(parts), return_counts=True)
            if good in every:
                old, before = every[good]
                both, place = np.unique(np.concatenate([old, grams]), return_inverse=True)
                n = np.bincount(place, np.concatenate([before, n]), len(both)).astype(np.int64)
                grams = both
            every[good] = grams, n

        held: dict[bool, list] = {True: [], False: []}
        size = {True: 0, False: 0}
        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1)):
                text, good = text.as_py(), bool(good.as_py())
                if not text:
                    continue
                grams = ngrams(text)
                held[good].append(grams)
                size[good] += len(grams)
                if size[good] >= CHUNK:
                    add(good, held[good])
                    held[good], size[good] = [], 0
        for good, parts in held.items():
            if parts:
                add(good, parts)
        for good, (grams, n) in every.items():
            for at in range(0, len(grams), 100_000):
                part = n[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[at : at + 100_000]),
                        pa.array(part),
                        pa.array(part if good else np.zeros_like(part)),
                    ],
                    ["gram", "n", "target"],
                )

    found = rows.mapInArrow(tidy(count), "gram bigint, n bigint, target bigint")
    return found.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))


class Trigrams:
    """Witten-Bell trigrams over bytes from distinct trigrams and their counts.

    p(c | h) = (count(hc) + kinds(h) p(c | shorter h)) / (count(h) + kinds(h)), down to the
    uniform distribution, with kinds(h) the distinct bytes seen after h.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        seen = counts > 0
        self.grams, self.counts = grams[seen].astype(np.int64), counts[seen].astype(np.float64)
        two = np.bincount(self.grams & 0xFFFF, self.counts, SIZE**2).reshape(SIZE, SIZE)
        single = two.sum(0)
        total, kinds = single.sum(), (single > 0).sum()
        one = (single + kinds / SIZE) / (total + kinds) if total else np.full(SIZE, 1 / SIZE)
        self.two = interpolated(two, two.sum(1, keepdims=True), (two > 0).sum(1, keepdims=True), one)
        self.after = np.bincount(self.grams >> 8, self.counts, SIZE**2)
        self.kinds = np.bincount(self.grams >> 8, minlength=SIZE**2)

    def probability(self, grams: np.ndarray) -> np.ndarray:
        grams = grams.astype(np.int64)
        n = np.zeros(len(grams))
        if len(self.grams):
            near = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            n = np.where(self.grams[near] == grams, self.counts[near], 0.0)
        shorter = self.two.reshape(-1)[grams & 0xFFFF]
        return interpolated(n, self.after[grams >> 8], self.kinds[grams >> 8], shorter)


def interpolated(count, after, kinds, shorter):
    """(count + kinds * shorter) / (after + kinds); the shorter one where nothing came after."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(after > 0, (count + kinds * shorter) / (after + kinds), shorter)


def by_gram(df: DataFrame) -> tuple[np.ndarray, ...]:
    """The columns on the driver, in the order of `gram`."""
    table = df.toArrow()
    order = np.argsort(table["gram"].to_numpy())
    columns = tuple(c.to_numpy()[order] for c in table.columns)
    del table
    pa.default_memory_pool().release_unused()
    return columns


def deltas(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """(gram, n, delta) of every five-gram: log2 of its background less its target probability."""
    three = (
        counts.groupBy(F.col("gram").bitwiseAND(0xFFFFFF).alias("gram"))
        .agg(F.sum("n").alias("n"), F.sum("target").alias("target"))
    )
    grams, n, target = by_gram(three)  # at most 256^3 rows, by the vocabulary
    models = spark.sparkContext.broadcast((Trigrams(grams, n), Trigrams(grams, target)))
    del grams, n, target

    def fall_back(batches):
        back, good = models.value
        for batch in batches:
            low = np.array(batch.column(0), np.int64) & 0xFFFFFF
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(back.probability(low)), pa.array(good.probability(low))],
                ["gram", "n", "target", "p", "q"],
            )

    context = F.shiftright("gram", 8)
    after = counts.groupBy(context.alias("h")).agg(
        F.sum("n").alias("after"),
        F.sum("target").alias("tafter"),
        F.count(F.lit(1)).alias("kinds"),
        F.count_if(F.col("target") > 0).alias("tkinds"),
    )

    def mixed(n: str, after: str, kinds: str, p: str) -> Column:
        of = (F.col(n) + F.col(kinds) * F.col(p)) / (F.col(after) + F.col(kinds))
        return F.when(F.col(after) > 0, of).otherwise(F.col(p))

    five = counts.mapInArrow(tidy(fall_back), "gram bigint, n bigint, target bigint, p double, q double")
    delta = F.log2(mixed("n", "after", "kinds", "p")) - F.log2(mixed("target", "tafter", "tkinds", "q"))
    return stage(five.withColumn("h", context).join(after, "h").select("gram", "n", delta.alias("delta")), "deltas")


def frequent(table: DataFrame) -> Column:
    """Whether a five-gram is among the most counted, at most HOT: n of the least power of two that fits."""
    power = F.floor(F.log2(F.col("n") + 0.5)).cast("int").alias("power")
    held = 0
    least = 64
    for row in table.groupBy(power).agg(F.count(F.lit(1)).alias("grams")).orderBy(F.desc("power")).collect():
        held += row.grams
        if held > HOT:
            break
        least = row.power
    return F.col("n") >= 2.0**least


def scored(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """(key, n_tokens, score) of every row."""
    spark = docs.sparkSession
    ship(spark)
    good = labels.where(F.col(label) == 1).select(F.col("doc_id").alias("id")).distinct()
    good = stage(good, "good")
    marks = good.withColumn("good", F.lit(True))
    marks = F.broadcast(marks) if good.count() <= BROADCAST_IDS else marks
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    counts = stage(counted(rows.join(marks, "id", "left").select("text", "good")), "grams")
    table = deltas(spark, counts)
    hot = frequent(table)
    sent = spark.sparkContext.broadcast(by_gram(table.where(hot).select("gram", "delta")))  # at most HOT rows

    def look_up(value: str) -> tuple[np.ndarray, float, np.ndarray]:
        """Five-grams, sum over the frequent ones, and the others."""
        known, own = sent.value
        of = ngrams(value)
        if not len(known):
            return of, 0.0, of
        near = np.minimum(np.searchsorted(known, of), len(known) - 1)
        found = known[near] == of
        return of, float(own[near[found]].sum()), of[~found]

    def mark(value: str) -> int:
        return xxhash.xxh3_64_intdigest(value.encode("utf-8", "surrogatepass")) - 2**63

    def known_part(batches):
        for batch in batches:
            prints, sizes, sums, open_ = [], [], [], []
            for value in batch.column(1):
                value = value.as_py()
                of, total, rest = look_up(value) if value else ([], None, [])
                prints.append(mark(value) if value else None)
                sizes.append(len(of))
                sums.append(total)
                open_.append(len(rest))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(prints, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.float64()),
                    pa.array(open_, pa.int64()),
                ],
                ["id", "print", "n", "known", "open"],
            )

    def rest_part(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                prints, sizes, grams, times = [], [], [], []
                for value in batch.column(0).slice(at, 200):
                    value = value.as_py()
                    of, _, rest = look_up(value) if value else ([], None, [])
                    if len(rest):
                        gram, n = np.unique(rest, return_counts=True)
                        prints.append(np.full(len(gram), mark(value), np.int64))
                        sizes.append(np.full(len(gram), len(of), np.int64))
                        grams.append(gram)
                        times.append(n)
                if grams:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in (prints, sizes, grams, times)],
                        ["print", "n", "gram", "times"],
                    )

    rest = rows.select("text").mapInArrow(tidy(rest_part), "print bigint, n bigint, gram bigint, times bigint")
    rest = rest.join(table.where(~hot).select("gram", "delta"), "gram")
    # repeated texts come several times: their mean is that of one
    mean = F.sum(F.col("times") * F.col("delta")) / F.sum("times")
    means = rest.groupBy("print", "n").agg(mean.alias("mean"))
    means = stage(means, "rest")
    out = rows.mapInArrow(tidy(known_part), f"id {kind}, print bigint, n bigint, known double, open bigint")
    few = means.count() <= BROADCAST_IDS // 8
    out = out.join(F.broadcast(means) if few else means, ["print", "n"], "left")
    score = (F.col("known") + F.when(F.col("open") > 0, F.col("open") * F.col("mean")).otherwise(0.0)) / F.col("n")
    score = F.when(F.col("n") > 0, F.round(score, 9))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_tokens"), score.alias("score"))


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scored(read(spark, folder, "documents"), read(spark, folder, "labels"))
