"""Alignment of the tokens that two tokenizers make of the same text.

A text is encoded by both with a blank in front. Each side's cumulative byte ends go into a dictionary from
end to number of tokens; the ends that both have, found by intersecting the two sets of keys and
sorted, slice both id lists into groups. Tokens of one group are linked, each of one side with each
of the other. A pair of ids counts once for each document that holds it linked; a link is best if no
other pair of its first id has a higher count in the whole corpus (ties count as best).

Texts are cut into segments where both tokenizers are sure to have a border; each different segment is encoded and aligned
once, as long as it is remembered, and a text is put together from its segments.

The links of each document are kept as distinct pairs with the number of their occurrences. Counting the
documents of each pair is a partial aggregation before the shuffle. For looking the counts up, the most counted
pairs, at most `HOT_PAIRS` of them by their histogram, are broadcast; only links of rarer pairs are shuffled, and
each of these has few rows.

Texts that are null or empty, or that one of the tokenizers does not keep byte for byte, have no
tokens. Texts are taken whole. Repeated rows are documents of their own, also in the counts; null
ids stay. An empty table gives an empty result. Only id and text are read, so columns with clashing names
do not matter. Vocabularies (1.6 and 0.5 MB) are read by the driver and sent with the task.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm.common import read, ship, tidy
from featurelab.llm.piece_bpe import Pieces, read_model
from featurelab.llm.token_count import BLANK
from featurelab.sources.scratch import stage

MERGE_FILE = "byte_bpe_50k.json"
#: Pairs that may be broadcast with their counts (about 20 bytes each).
HOT_PAIRS = 1 << 19
BATCH_CHARS = 200_000  # encoded at a time
MAX_SEGMENTS = 250_000  # segments that are remembered, short ones only, and as many of the time before
MEMO_CHARS = 48
# Before a blank after a letter, digit or sign, both tokenizers have a border, whatever stands around it: the first
# one's split pattern has no match that goes on from such a character into a blank, and the second one no such piece.
# (A single blank at the end of a text stays with what is before it: alone it would be an empty text for the second one.)
SEGMENTS = re.compile(r"(?<=[\w!-~])(?= [\s\S])").split
PAIR_BASE = 1 << 32  # a pair of ids as one number: first * PAIR_BASE + second


def byte_names() -> dict[str, int]:
    """The byte of each character in entries of a byte-level vocabulary: printable
    characters of Latin-1 stand for themselves, the other bytes, in order, for those from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def linked(first: list[int], second: list[int], cuts: list[tuple[int, int]]) -> tuple:
    """(pairs, counted pairs, sums, said) of a segment: what its links add to a text.

    A pair stands in `pairs` once for each link; those of large groups are counted instead. The sums are those of tokens on both
    sides, groups and links. Everything is made of tuples of numbers, which are light.
    """
    pairs, often, said, links, a0, b0 = [], None, [], 0, 0, 0
    for a1, b1 in cuts:
        if a1 - a0 == 1 == b1 - b0:
            a, b = first[a0], second[b0]
            pairs.append(a * PAIR_BASE + b)
            said.append(f"{a}|{b}")
            links += 1
        else:
            ours, theirs = first[a0:a1], second[b0:b1]
            said.append(",".join(map(str, ours)) + "|" + ",".join(map(str, theirs)))
            size = len(ours) * len(theirs)
            links += size
            if size <= 64:
                pairs += [a * PAIR_BASE + b for a in ours for b in theirs]
            else:
                often = often or Counter()
                times = Counter(theirs).items()
                for a, n in Counter(ours).items():
                    for b, m in times:
                        often[a * PAIR_BASE + b] += n * m
        a0, b0 = a1, b1
    counted = tuple(often.items()) if often else ()
    return tuple(pairs), counted, (len(first), len(second), len(cuts), links), ";".join(said)


class Aligner:
    """Both tokenizers; `entry` makes of a segment's ids and group ends what is remembered of it."""

    def __init__(self, merges: str, model: bytes, entry: Callable):
        import sentencepiece
        import tokenizers

        self.entry = entry
        self.first = tokenizers.Tokenizer.from_str(merges)
        self.first.encode_special_tokens = True  # their strings in a text are ordinary text
        byte = byte_names()
        vocabulary = json.loads(merges)["model"]["vocab"]
        self.first_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            if all(c in byte for c in entry):
                self.first_bytes[i] = bytes([byte[c] for c in entry])
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = Pieces(model)
        self.second_bytes = pieces.texts
        if any(BLANK in piece.lstrip(BLANK) for piece in pieces.ids):
            raise ValueError("a piece goes on from a letter into a blank")
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}  # those before; what is used again moves on

    def segments(self, texts: Sequence[str | None]) -> Iterator[list[tuple]]:
        """The entries of each text's segments; none where a tokenizer does not keep the text."""
        at = 0
        while at < len(texts):
            batch, chars = [], 0
            while at < len(texts) and chars < BATCH_CHARS:
                batch.append(SEGMENTS(f" {texts[at]}") if texts[at] else [])
                chars += len(texts[at] or "")
                at += 1
            known, older = self.known, self.older
            long: dict[str, tuple | None] = {}
            new = []
            for segment in set().union(*batch):
                if segment not in known:
                    if segment in older:
                        known[segment] = older[segment]
                    else:
                        new.append(segment)
            for segment, found in zip(new, self.align(new)):
                (known if len(segment) <= MEMO_CHARS else long)[segment] = found
            for parts in batch:
                found = [known[s] for s in parts] if not long else [known[s] if s in known else long[s] for s in parts]
                yield [] if None in found else found
            if len(known) > MAX_SEGMENTS:
                self.known, self.older = {}, known

    def align(self, segments: list[str]) -> Iterator[tuple | None]:
        """Common ends of both encodings of each segment, which begins with a blank."""
        if not segments:
            return
        first_bytes, second_bytes, entry = self.first_bytes, self.second_bytes, self.entry
        firsts = self.first.encode_batch(segments, add_special_tokens=False)
        seconds = self.second.encode([s[1:] for s in segments], num_threads=1)
        for segment, encoding, second in zip(segments, firsts, seconds):
            first = encoding.ids
            parts = [first_bytes[i] for i in first]
            others = [second_bytes[i] for i in second]
            said = segment.encode()
            if b"".join(parts) != said or b"".join(others) != said:
                yield None
                continue
            by_end = dict(zip(accumulate(map(len, parts)), range(1, len(parts) + 1)))
            other_end = dict(zip(accumulate(map(len, others)), range(1, len(others) + 1)))
            common = sorted(by_end.keys() & other_end.keys())
            yield entry(first, second, [(by_end[end], other_end[end]) for end in common])


def whole(segments: list[tuple]) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """Both id lists of a text and, for each group, the number of tokens of each up to its end."""
    first, second, cuts = [], [], []
    for ours, theirs, ends in segments:
        a, b = len(first), len(second)
        cuts.extend([(a + x, b + y) for x, y in ends])
        first.extend(ours)
        second.extend(theirs)
    return first, second, cuts


def links_of(segments: list[tuple]) -> tuple[dict[int, int], tuple[int, ...], str]:
    """Distinct linked pairs of a text with their occurrences; tokens, groups and links; the groups as text."""
    if not segments:
        return {}, (0, 0, 0, 0), ""
    each, counted, sums, said = zip(*segments)
    pairs = Counter(chain.from_iterable(each))
    for many in filter(None, counted):
        for pair, times in many:
            pairs[pair] += times
    return pairs, tuple(map(sum, zip(*sums))), ";".join(said)


_OPEN: dict[tuple, Aligner] = {}


def _ids_and_ends(*entry) -> tuple:
    return entry


def aligner(merges: str, model: bytes, entry: Callable = linked) -> Aligner:
    """One pair of tokenizers for each Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    name = hashlib.sha256(merges.encode() + model).digest(), entry.__name__
    if name not in _OPEN:
        gc.set_threshold(100_000, 20, 50)  # remembered segments form no cycles
        _OPEN.clear()
        _OPEN[name] = Aligner(merges, model, entry)
    return _OPEN[name]


def _vocabularies(merges: str | None, model: str | None) -> tuple[str, bytes]:
    import public_tokenizers

    with open(merges or public_tokenizers.path(MERGE_FILE), encoding="utf-8") as file:
        return file.read(), read_model(model)


def aligned(
    df: DataFrame, key: str = "doc_id", text: str = "text", merges: str | None = None, model: str | None = None
) -> DataFrame:
    """(key, first array<int>, second array<int>, groups array<struct<first_end, second_end>>) of every row.

    A group's tokens are those from the end of the group before it up to its own ends.
    """
    ship(df.sparkSession)
    files, rows = _vocabularies(merges, model), df.select(key, text)
    pair = pa.struct([("first_end", pa.int32()), ("second_end", pa.int32())])

    def align(batches):
        tool = aligner(*files, _ids_and_ends)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [whole(parts) for parts in tool.segments(part.column(1).to_pylist())]
                cuts = [[{"first_end": a, "second_end": b} for a, b in c] for _, _, c in found]
                columns = [pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array(cuts, pa.list_(pair))], list("kabc"))

    kind = rows.schema[0].dataType.simpleString()
    shape = f"k {kind}, a array<int>, b array<int>, c array<struct<first_end: int, second_end: int>>"
    return rows.mapInArrow(tidy(align), shape).toDF(key, "first", "second", "groups")


def document_links(
    df: DataFrame, key: str = "doc_id", text: str = "text", merges: str | None = None, model: str | None = None
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups_sha256, pairs array<bigint>, times array<bigint>) of every row."""
    ship(df.sparkSession)
    files, rows = _vocabularies(merges, model), df.select(key, text)

    def link(batches):
        tool = aligner(*files)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                counts, digests, pairs, times = [], [], [], []
                for parts in tool.segments(part.column(1).to_pylist()):
                    found, sums, said = links_of(parts)
                    counts.append(sums)
                    digests.append(hashlib.sha256(said.encode()).hexdigest() if parts else "")
                    pairs.append(list(found))
                    times.append(list(found.values()))
                longs = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *longs, pa.array(digests, pa.string()), *lists], list("kabglspt")
                )

    kind = rows.schema[0].dataType.simpleString()
    shape = f"k {kind}, a bigint, b bigint, g bigint, l bigint, s string, p array<bigint>, t array<bigint>"
    return rows.mapInArrow(tidy(link), shape).toDF(
        key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"
    )


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, docs, best) of every linked pair of ids: documents that hold it, and whether no pair of the
    same first id is in more."""
    counts = stage(
        links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "pairs"
    )
    first = F.shiftright("pair", 32)
    highest = counts.groupBy(first.alias("first")).agg(F.max("docs").alias("most"))  # a row for each id of a vocabulary
    judged = counts.withColumn("first", first).join(F.broadcast(highest), "first")
    return judged.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def broadcast_from(counts: DataFrame, most: int) -> int:
    """The least power of two of documents from which on there are no more than `most` pairs."""
    power = F.floor(F.log2("docs")).cast("int").alias("power")
    sizes = {r["power"]: r["count"] for r in counts.groupBy(power).count().collect()}  # at most 64 rows
    total, power = 0, max(sizes, default=0) + 1
    while power > 0 and total + sizes.get(power - 1, 0) <= most:
        power -= 1
        total += sizes.get(power, 0)
    return 1 << power


def link_statistics(
    df: DataFrame, key: str = "doc_id", text: str = "text", merges: str | None = None, model: str | None = None,
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    found = document_links(df, key, text, merges, model)
    docs = stage(found.withColumn("_row", F.monotonically_increasing_id()), "links")
    counts = stage(pair_counts(docs), "counts")
    limit = broadcast_from(counts, hot_pairs)
    each = docs.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "_row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")
    )
    hot = F.broadcast(counts.where(F.col("docs") >= limit))
    rare = counts.where(F.col("docs") < limit)

    def sums(joined: DataFrame) -> DataFrame:
        return joined.groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
        )

    both = sums(each.join(hot, "pair")).unionByName(sums(each.join(hot, "pair", "left_anti").join(rare, "pair")))
    total = both.groupBy("_row").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    plain = docs.select("_row", F.col(key).alias("_key"), "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return plain.join(total, "_row", "left").select(
        F.col("_key").alias(key), "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256",
    )


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return link_statistics(read(spark, folder, "documents"))
