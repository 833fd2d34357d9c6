"""Benchmark decontamination: every passage of the corpus queries a BM25 index of the test items.

Scores are BM25 of a passage against an item, divided by the score of the item against itself, so 1 means
that every word of the item occurs. Retrieved is every item with a score of `THRESHOLD` or more, by
block-max WAND: items lie in blocks; each term keeps its largest share for each block. Frequent
terms, whose shares together stay below half the threshold in every item, are not looked up at first: a
block is scored only if the largest shares of the passage's other terms, plus the largest sum of
frequent terms in the block, reach the threshold. The bound never underestimates, so nothing is lost.

A hit is confirmed on the words themselves: of the item's five-word shingles 80 % must occur in the
passage, and half of those of its question and of its answer. The question reaches to the last
question mark, or is the first half of the words; a part of fewer than five words is one shingle.

Passages are windows of twice the words of the longest item, stepping by half, so every copy of an
item lies within one. Words are letters, digits and underscores in lower case. The index is built
for shards of the items, each at most `SHARD_CHARS` characters of text, and one shard is broadcast
at a time; word statistics come from all items.

Texts and items that are null or have no words match nothing. Equal items are taken once, rows of
documents one by one, and a null id stays null. Empty tables give an empty result. Only ids and texts
are read, so columns with clashing names do not matter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm.common import read, ship, tidy
from featurelab.sources.scratch import stage

THRESHOLD = 0.6
OVERLAP = 80  # percent of the shingles of an item
PART = 50  # percent of the shingles of its question, and of its answer
SHINGLE = 5
BLOCK = 16  # items
K1, B = 1.2, 0.75
SHARD_CHARS = 16_000_000

_words = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    at = text.rfind("?")
    if at >= 0 and words_of(text[at:]):
        return words_of(text[: at + 1]), words_of(text[at:])
    words = words_of(text)
    half = (len(words) + 1) // 2
    return words[:half], words[half:]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    if not words:
        return set()
    k = min(SHINGLE, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


class Index:
    """Items of one shard; `idf` for their words and the mean length come from all items."""

    def __init__(self, items: list[tuple[int, str]], idf: dict[str, float], mean_length: float):
        kept = [(i, t, words_of(t)) for i, t in items]
        kept = [x for x in kept if x[2]]
        vocabulary = sorted({w for _, _, ws in kept for w in ws})
        self.number = {w: n for n, w in enumerate(vocabulary)}
        shares = []
        for _, _, ws in kept:
            terms, tf = np.unique([self.number[w] for w in ws], return_counts=True)
            weight = np.array([idf[vocabulary[t]] for t in terms])
            weight *= tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ws) / mean_length))
            shares.append((terms, weight / weight.sum()))
        # items with alike rarest words side by side make tight block bounds
        order = sorted(range(len(kept)), key=lambda i: vocabulary[shares[i][0][shares[i][1].argmax()]])
        self.items = [kept[i][0] for i in order]
        self.texts = [kept[i][1] for i in order]
        self.shares = [shares[i] for i in order]
        self.step = max((len(x[2]) for x in kept), default=1)
        self.blocks = -(-len(kept) // BLOCK)
        self._bounds(len(vocabulary))

    def _bounds(self, terms: int) -> None:
        often = np.zeros(terms, np.int64)
        for t, _ in self.shares:
            often[t] += 1
        # frequent terms, as many as keep every item's sum of them below half the threshold
        place = np.empty(terms, np.int64)
        place[np.argsort(-often, kind="stable")] = np.arange(terms)
        first = terms
        for t, s in self.shares:
            by_place = np.argsort(place[t])
            over = np.searchsorted(np.cumsum(s[by_place]), THRESHOLD / 2)
            if over < len(t):
                first = min(first, int(place[t][by_place][over]))
        self.frequent = place < first
        self.rest = np.zeros(self.blocks)  # largest sum of frequent terms in a block
        best: dict[tuple[int, int], float] = {}
        for i, (t, s) in enumerate(self.shares):
            block = i // BLOCK
            self.rest[block] = max(self.rest[block], s[self.frequent[t]].sum())
            for term, share in zip(t[~self.frequent[t]].tolist(), s[~self.frequent[t]].tolist()):
                best[term, block] = max(best.get((term, block), 0.0), share)
        rows = sorted(best)
        self.post_block = np.array([b for _, b in rows], np.int64)
        self.post_share = np.array([best[r] for r in rows])
        counts = np.bincount(np.array([t for t, _ in rows], np.int64), minlength=terms)
        self.post_start = np.concatenate([[0], np.cumsum(counts)])

    def hits(self, text: str | None) -> list[tuple[int, float]]:
        """(item, best score) of the confirmed items of a text."""
        words = words_of(text)
        get = self.number.get
        terms = np.array([get(w, -1) for w in words], np.int64)
        at = np.flatnonzero(terms >= 0)
        rare = at[~self.frequent[terms[at]]]
        if not len(rare):
            return []
        # distinct (window, rare term); window k covers the steps k and k + 1
        step = rare // self.step
        windows = np.concatenate([step, step - 1])
        both = np.concatenate([terms[rare], terms[rare]])
        pairs = np.unique((windows * len(self.number) + both)[windows >= 0])
        if not len(pairs):  # a text of a single step
            pairs = np.unique(terms[rare])
        window, term = pairs // len(self.number), pairs % len(self.number)
        size = self.post_start[term + 1] - self.post_start[term]
        entry = np.repeat(self.post_start[term] - np.cumsum(size) + size, size) + np.arange(size.sum())
        place, group = np.unique(
            np.repeat(window, size) * self.blocks + self.post_block[entry], return_inverse=True
        )
        bound = np.bincount(group, self.post_share[entry]) + self.rest[place % self.blocks]
        found: dict[int, float] = {}
        for where in place[bound >= THRESHOLD - 1e-9].tolist():
            w, block = divmod(where, self.blocks)
            low = w * self.step
            passage = words[low : low + 2 * self.step]
            inside = np.zeros(len(self.number), bool)
            inside[terms[low : low + 2 * self.step][terms[low : low + 2 * self.step] >= 0]] = True
            for i in range(block * BLOCK, min(len(self.items), (block + 1) * BLOCK)):
                t, s = self.shares[i]
                score = float(s[inside[t]].sum())
                if score >= THRESHOLD - 1e-9 and self.confirm(self.texts[i], passage):
                    found[i] = max(found.get(i, 0.0), score)
        best: dict[int, float] = {}
        for i, score in found.items():
            best[self.items[i]] = max(best.get(self.items[i], 0.0), score)
        return sorted(best.items())

    @staticmethod
    def confirm(item: str, passage: list[str]) -> bool:
        """Whether the passage holds enough of the item, of its question and of its answer."""

        def share(part: list[str]) -> float:
            wanted = shingles(part)
            if not wanted:
                return 100.0
            k = min(SHINGLE, len(part))
            there = {tuple(passage[i : i + k]) for i in range(len(passage) - k + 1)}
            return 100 * len(wanted & there) / len(wanted)

        question, answer = question_and_answer(item)
        return share(words_of(item)) >= OVERLAP and share(question) >= PART and share(answer) >= PART


def indexes(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Index]:
    """The index of each shard of the items."""
    spark = benchmark.sparkSession
    ship(spark)
    items = stage(
        benchmark.select(F.col(key).alias("item"), F.col(text).alias("text"))
        .where("item is not null and text is not null")
        .distinct(),
        "items",
    )

    def terms(batches):
        for batch in batches:
            rows = [words_of(t) for t in batch.column(1).to_pylist()]
            distinct = [(w, len(ws)) for ws in rows for w in dict.fromkeys(ws)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w for w, _ in distinct], pa.string()),
                    pa.array([n for ws in rows for n in [len(ws)] + [0] * (len(set(ws)) - 1) if ws], pa.int64()),
                ],
                ["term", "length"],
            )

    # the length of an item stands at the first of its terms
    held = stage(items.mapInArrow(tidy(terms), "term string, length bigint"), "terms")
    count, total = held.where("length > 0").agg(F.count(F.lit(1)), F.sum("length")).first()
    chars = items.agg(F.sum(F.length("text"))).first()[0]
    if not count:
        return
    often = held.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    shards = -(-chars // SHARD_CHARS)
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == shard)
        own = part.mapInArrow(tidy(terms), "term string, length bigint").select("term").distinct()
        idf = {
            r.term: math.log(1 + (count - r.df + 0.5) / (r.df + 0.5))
            for r in own.join(often, "term").toLocalIterator()
        }
        yield Index([(r.item, r.text) for r in part.collect()], idf, total / count)


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, item_id, score) for every item that a document holds."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shape = f"id {kind}, item_id bigint, score double"
    out = spark.createDataFrame([], shape)
    for index in indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def search(batches, sent=sent):
            found = sent.value
            for batch in batches:
                at, item, score = [], [], []
                for n, value in enumerate(batch.column(1)):
                    for i, s in found.hits(value.as_py()):
                        at.append(n)
                        item.append(i)
                        score.append(round(s, 6))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at, pa.int32())),
                        pa.array(item, pa.int64()),
                        pa.array(score, pa.float64()),
                    ],
                    ["id", "item_id", "score"],
                )

        out = out.union(rows.mapInArrow(tidy(search), shape))
    return out.withColumnRenamed("id", key)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no item; all columns, no shuffle."""
    place = docs.columns.index(text)
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches, sent=sent):
            found = sent.value
            for batch in batches:
                keep = [not found.hits(v.as_py()) for v in batch.column(place)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(tidy(clean), docs.schema)
    return docs


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
