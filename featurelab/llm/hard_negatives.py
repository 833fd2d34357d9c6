"""Hard negatives of anchors by a secondary sort of pair scores.

A score is the inner product of two vectors whose components are scaled and rounded down. Anchors meet all rows in
blocks: anchors are taken in chunks of at most `CHUNK_BYTES`, which are sent to the tasks, and rows stream past them. A
task keeps, for each anchor, only what can still be among the first ones over all its rows: that is the
pre-aggregation; nothing is lost, as the first k of a whole are among the first k of its parts.

The kept scores are packed into keys (anchor, descending score, role, id), whose bytes sort in that order, dealt out by anchor,
and sorted within partitions by Spark. An iterator reads each partition once. The first pass lets through the first positives
of each anchor. In the second pass positives are in the stream, too: each opens a window of scores, negatives that
follow go to all open windows that hold them and are not full, and a window below the stream's score is
closed. The iterator holds a few windows and no anchor's rows.

Rows with a null id, label or vector, or a component that is null or not finite, take no part. Vectors of different length have no
score. Rows of the anchor's own id are no partners. Equal rows count once; rows of one id with different vectors or
labels each count, and as anchors each have their own windows. Ties go by id. An empty table, or one without
anchors, gives an empty result. Scores are exact integers; if they could reach 2^53, it raises. Only id, label and vector are
read, so columns with clashing names do not matter.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm.common import read, ship, tidy
from featurelab.sources.scratch import stage

#: Bytes of the anchors' vectors that are sent to the tasks at a time.
CHUNK_BYTES = 32 << 20
BLOCK = 1024  # rows, and anchors, that are multiplied at a time
EXACT = 1 << 53
POSITIVE, NEGATIVE = 0, 1
KEY = struct.Struct(">QQBQ")
LOWEST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Rules:
    """A negative's score lies between `low` and `high` hundredths of its positive's."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95

    def __post_init__(self) -> None:
        if not 0 <= self.low < self.high <= 100 or min(self.positives, self.negatives) < 1:
            raise ValueError("windows lie at or below their positive: 0 <= low < high <= 100")

    def window(self, score: int) -> tuple[int, int]:
        """The least and the greatest score of negatives; nothing lies between them for scores below 0."""
        return -(-self.low * score // 100), self.high * score // 100


def pack(anchor: int, score: int, role: int, row: int) -> bytes:
    """A key whose bytes sort by anchor, descending score, role, id."""
    return KEY.pack(anchor, (1 << 63) - 1 - score, role, row + (1 << 63))


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, role, row = KEY.unpack(key)
    return anchor, (1 << 63) - 1 - score, role, row - (1 << 63)


class Best:
    """The first k different (descending score, id) of each of n lists."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.scores = np.full((lists, k), LOWEST)
        self.ids = np.zeros((lists, k), np.int64)

    def offer(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        """Scores of lists `at` (rows) with different ids (columns), where `fits`."""
        k = self.k
        worst = self.scores[at, k - 1]
        fits = fits & (scores >= worst[:, None])
        if not fits.any():
            return
        if scores.shape[1] > k:  # raise the bar by the block's own k-th score; its ties stay
            masked = np.where(fits, scores, LOWEST)
            bar = -np.partition(-masked.astype(np.float64), k - 1, axis=1)[:, k - 1]
            fits &= scores >= bar[:, None]
        row, column = np.nonzero(fits)
        touched = np.unique(row)
        old = self.scores[at[touched]].ravel()
        there = old != LOWEST
        rows = np.concatenate([row, np.repeat(touched, k)[there]])
        values = np.concatenate([scores[row, column], old[there]])
        names = np.concatenate([ids[column], self.ids[at[touched]].ravel()[there]])
        order = np.lexsort((names, -values, rows))
        rows, values, names = rows[order], values[order], names[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1]) | (names[1:] != names[:-1])
        rows, values, names = rows[new], values[new], names[new]
        first = np.r_[True, rows[1:] != rows[:-1]]
        place = np.arange(len(rows)) - np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))
        keep = place < k
        rows, values, names, place = at[rows[keep]], values[keep], names[keep], place[keep]
        self.scores[at[touched]] = LOWEST
        self.scores[rows, place], self.ids[rows, place] = values, names

    def items(self) -> Iterator[tuple[int, int, int]]:
        for i, j in zip(*np.nonzero(self.scores != LOWEST)):
            yield int(i), int(self.scores[i, j]), int(self.ids[i, j])


@dataclass(frozen=True)
class Anchors:
    """A chunk of anchors of one vector length: number, id, label, vector, and windows of the second pass."""

    numbers: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray | None = None  # anchors x positives
    high: np.ndarray | None = None


def _rows_of(batch: pa.RecordBatch):
    """(ids, labels, vectors) of a batch by vector length; ids within one part differ."""
    ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    lists = batch.column(2)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat, starts = lists.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)]
    for size in np.unique(sizes):
        at = np.nonzero(sizes == size)[0]
        vectors = flat[starts[at][:, None] + np.arange(size)] if size else np.zeros((len(at), 0))
        order = np.argsort(ids[at], kind="stable")
        known = ids[at][order]
        first = np.r_[True, known[1:] != known[:-1]]
        turn = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        for k in range(turn.max() + 1):  # one turn, unless ids repeat
            part = order[turn == k]
            yield int(size), ids[at[part]], labels[at[part]], vectors[part].astype(np.float64)


def _score_blocks(batches, chunk: dict[int, Anchors]):
    """(size, anchors as a slice, scores, same label, other id, ids) block by block."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            for size, ids, labels, vectors in _rows_of(batch.slice(at, BLOCK)):
                anchors = chunk.get(size)
                if anchors is None:
                    continue
                for start in range(0, len(anchors.ids), BLOCK):
                    part = slice(start, start + BLOCK)
                    ours = anchors.vectors[part]
                    if size and np.abs(ours).max() * np.abs(vectors).max() * size >= EXACT:
                        raise ValueError("scores reach 2^53, beyond which they are not exact")
                    scores = (ours @ vectors.T).astype(np.int64)
                    same = anchors.labels[part][:, None] == labels[None, :]
                    other = anchors.ids[part][:, None] != ids[None, :]
                    yield size, np.arange(start, start + len(ours)), scores, same, other, ids


def _keys(rows: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    waiting: list[bytes] = []
    for key in rows:
        waiting.append(key)
        if len(waiting) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(waiting, pa.binary())], ["key"])
            waiting = []
    yield pa.RecordBatch.from_arrays([pa.array(waiting, pa.binary())], ["key"])


def _best_positives(chunk: dict[int, Anchors], rules: Rules) -> Callable:
    def run(batches):
        best = {size: Best(len(a.ids), rules.positives) for size, a in chunk.items()}
        for size, at, scores, same, other, ids in _score_blocks(batches, chunk):
            best[size].offer(at, scores, ids, same & other)

        def rows():
            for size, kept in best.items():
                numbers = chunk[size].numbers.tolist()
                for i, score, row in kept.items():
                    yield pack(numbers[i], score, POSITIVE, row)

        yield from _keys(rows())

    return run


def _best_negatives(chunk: dict[int, Anchors], rules: Rules) -> Callable:
    def run(batches):
        best = {size: [Best(len(a.ids), rules.negatives) for _ in range(rules.positives)] for size, a in chunk.items()}
        for size, at, scores, same, other, ids in _score_blocks(batches, chunk):
            allowed = other & ~same
            low, high = chunk[size].low[at], chunk[size].high[at]
            for k, kept in enumerate(best[size]):
                kept.offer(at, scores, ids, allowed & (scores >= low[:, k, None]) & (scores <= high[:, k, None]))

        def rows():
            for size, windows in best.items():
                numbers = chunk[size].numbers.tolist()
                found = {(i, score, row) for kept in windows for i, score, row in kept.items()}
                for i, score, row in found:
                    yield pack(numbers[i], score, NEGATIVE, row)

        yield from _keys(rows())

    return run


def _stream(batches) -> Iterator[tuple[int, int, int, int]]:
    """The different keys of a sorted partition."""
    before = None
    for batch in batches:
        for key in batch.column(0).to_pylist():
            if key != before:
                yield unpack(key)
            before = key


def _first_positives(rules: Rules) -> Callable:
    """(anchor number, rank, score, id) of each anchor's first positives, in the order of the stream."""

    def run(batches):
        out, anchor, rank = [], None, 0
        for number, score, _, row in _stream(batches):
            rank = rank + 1 if number == anchor else 1
            anchor = number
            if rank <= rules.positives:
                out.append((number, rank, score, row))
        columns = zip(*out) if out else ([], [], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], list("nrsi")
        )

    return run


def _emit(rules: Rules) -> Callable:
    """(anchor number, positive, rank, negative, scores): windows open and fill while the stream goes by."""
    names = ("n", "p", "r", "x", "ps", "ns")
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def batch(rows):
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], list(names))

    def run(batches):
        out, anchor, windows = [], None, []
        for number, score, role, row in _stream(batches):
            if number != anchor:
                anchor, windows = number, []
            if role == POSITIVE:
                low, high = rules.window(score)
                if low <= high:
                    windows.append([low, high, 0, score, row])
                continue
            windows = [w for w in windows if w[0] <= score and w[2] < rules.negatives]
            for window in windows:
                if score <= window[1]:
                    window[2] += 1
                    out.append((number, window[4], window[2], row, window[3], score))
            if len(out) >= 10_000:
                yield batch(out)
                out = []
        yield batch(out)

    return run


def _sorted_stream(keys: DataFrame, read_stream: Callable, shape: str) -> DataFrame:
    """Keys dealt out by anchor and sorted within partitions, read by an iterator."""
    dealt = keys.repartition(F.substring("key", 1, 8)).sortWithinPartitions("key")
    return dealt.mapInArrow(tidy(read_stream), shape)


def usable(df: DataFrame, row: str, label: str | Column, vector: str, scale: float) -> DataFrame:
    """(id, label, vector of scaled components, rounded down) of the rows that take part."""
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    complete = F.col(row).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & finite
    return df.where(complete).select(
        F.col(row).cast("bigint").alias("id"), label.cast("bigint").alias("label"), values.alias("vector")
    )


def mine(
    df: DataFrame,
    is_anchor: Column,
    row: str = "vec_id",
    label: str | Column = "label",
    vector: str = "embedding",
    scale: float = 256.0,
    rules: Rules = Rules(),
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); one row for each negative found."""
    spark = df.sparkSession
    ship(spark)
    rows = usable(df, row, label, vector, scale)
    chosen = usable(df.where(is_anchor), row, label, vector, scale).distinct()
    anchors = stage(chosen.withColumn("number", F.monotonically_increasing_id()), "anchors")
    total = anchors.agg(F.sum(8 * F.size("vector") + 64).alias("bytes")).first()["bytes"] or 0
    chunks = -(-2 * total // chunk_bytes)  # half full on average, as a hash fills them
    part = F.pmod(F.xxhash64("number"), F.lit(max(chunks, 1)))
    parts = []
    for k in range(chunks):
        chunk = _anchors(anchors.where(part == k).toArrow())  # bounded by chunk_bytes
        if not chunk:
            continue
        sent = spark.sparkContext.broadcast(chunk)
        found = _sorted_stream(
            rows.mapInArrow(tidy(_on(sent, _best_positives, rules)), "key binary"),
            _first_positives(rules), "number bigint, rank int, score bigint, id bigint",
        )
        positives = stage(found, "positives")
        with_windows = spark.sparkContext.broadcast(_windows(chunk, positives.toArrow(), rules))
        negatives = rows.mapInArrow(tidy(_on(with_windows, _best_negatives, rules)), "key binary")
        # the positives join the stream
        opening = positives.select("number", "score", "id").mapInArrow(_as_keys, "key binary")
        shape = "number bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        parts.append(stage(_sorted_stream(negatives.unionByName(opening), _emit(rules), shape), "negatives"))
        sent.unpersist()
        with_windows.unpersist()
    if not parts:
        shape = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], shape)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    names = anchors.select("number", F.col("id").alias("anchor_id"))
    return out.join(names, "number").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _on(sent, work: Callable, rules: Rules) -> Callable:
    def run(batches):
        yield from work(sent.value, rules)(batches)

    return run


def _as_keys(batches):
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
        yield from _keys(pack(number, score, POSITIVE, row) for number, score, row in rows)


def _anchors(table: pa.Table) -> dict[int, Anchors]:
    out = {}
    vectors = [np.asarray(v, np.float64) for v in table["vector"].to_pylist()]
    ids, labels, numbers = (table[c].to_numpy() for c in ("id", "label", "number"))
    sizes = np.array([len(v) for v in vectors], int)
    for size in np.unique(sizes):
        at = np.nonzero(sizes == size)[0]
        together = np.stack([vectors[i] for i in at]) if size else np.zeros((len(at), 0))
        out[int(size)] = Anchors(numbers[at], ids[at], labels[at], together)
    return out


def _windows(chunk: dict[int, Anchors], positives: pa.Table, rules: Rules) -> dict[int, Anchors]:
    """The chunk with the windows of its positives; places without a positive hold nothing."""
    scores = {}
    for number, rank, score in zip(*(positives[c].to_pylist() for c in ("number", "rank", "score"))):
        scores[number, rank] = score
    out = {}
    for size, a in chunk.items():
        low = np.ones((len(a.ids), rules.positives), np.int64)
        high = np.zeros_like(low)
        for i, number in enumerate(a.numbers.tolist()):
            for k in range(rules.positives):
                score = scores.get((number, k + 1))
                if score is not None:
                    low[i, k], high[i, k] = rules.window(score)
        out[size] = Anchors(a.numbers, a.ids, a.labels, a.vectors, low, high)
    return out


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label=moved)
