"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton lists the pieces that end at each character; the dynamic program keeps,
for each place, the best score and the number of pieces on the way there, and no path. Ties go as
in the tokenizers library: of equal scores to one place, the piece that begins first stays. A character
that is no piece costs the lowest score less 10 and counts as its UTF-8 bytes (byte fallback).

The pieces and scores are those of a sentencepiece model file, whose text form is: a blank before the
text, blanks as U+2581, nothing else changed. No piece of such a model goes on from a letter into
a blank, so the best path falls apart into those of the words with the blanks before them;
words met before are looked up. The file is checked for that, and read by the driver (0.5 MB).

Scores are summed as double precision within a word and over words. Null and empty texts have no
tokens and a score of 0. Texts are taken whole, repeated rows one by one; an empty table gives an
empty result. Only id and text are read, so columns with clashing names do not matter.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from featurelab.llm.common import read, ship, tidy

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
UNKNOWN_COST = 10.0
MAX_WORDS = 300_000  # looked-up words, short ones only
MEMO_CHARS = 48
NORMAL = 1  # type of an ordinary piece in the model file

_cut = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+").findall


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            yield tag >> 3, data[at : at + size]
            at += size


def pieces_of(model: bytes) -> dict[str, float]:
    """Ordinary pieces of a sentencepiece model and their scores."""
    out = {}
    for number, piece in fields(model):
        if number == 1:
            parts = dict(fields(piece))
            if parts.get(3, NORMAL) == NORMAL:
                out[parts[1].decode()] = struct.unpack("<f", parts.get(2, b"\0" * 4))[0]
    return out


class Counter:
    def __init__(self, pieces: dict[str, float]):
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece goes on from a letter into a blank")
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values()) - UNKNOWN_COST
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.known: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best path."""
        n = len(word)
        best: list[float | None] = [0.0] + [None] * n
        count = [0] * (n + 1)
        done = 0  # places up to here are final

        def unknown(upto: int) -> None:
            """Close the places up to `upto`: a character that is no piece is the last to try."""
            nonlocal done
            while done < upto:
                char = word[done]
                if char not in self.single:
                    score = best[done] + self.unknown
                    if best[done + 1] is None or score > best[done + 1]:
                        best[done + 1] = score
                        count[done + 1] = count[done] + len(char.encode("utf-8", "surrogatepass"))
                done += 1

        # matches come by end, and for one end from the first start on
        for last, (size, score) in self.automaton.iter(word):
            unknown(last)
            start = last + 1 - size
            score += best[start]
            if best[last + 1] is None or score > best[last + 1]:
                best[last + 1] = score
                count[last + 1] = count[start] + 1
        unknown(n)
        return count[n], best[n]

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        tokens, total, known = 0, 0.0, self.known
        for word in _cut(BLANK + text.replace(" ", BLANK)):
            found = known.get(word)
            if found is None:
                found = self.word(word)
                if len(word) <= MEMO_CHARS:
                    if len(known) >= MAX_WORDS:
                        known.clear()
                    known[word] = found
            tokens += found[0]
            total += found[1]
        return tokens, total


_OPEN: dict[bytes, Counter] = {}


def counter(model: bytes) -> Counter:
    """One automaton for each model and Python worker."""
    name = hashlib.sha256(model).digest()
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = Counter(pieces_of(model))
    return _OPEN[name]


def counted(
    df: DataFrame, key: str = "doc_id", text: str = "text", model_path: str | None = None
) -> DataFrame:
    """(key, n_tokens, score) of every row."""
    import public_tokenizers

    ship(df.sparkSession)
    with open(model_path or public_tokenizers.path(MODEL), "rb") as file:
        model = file.read()
    rows = df.select(key, text)

    def count(batches):
        of = counter(model).text
        for batch in batches:
            found = [of(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([s for _, s in found], pa.float64()),
                ],
                ["k", "n", "s"],
            )

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(tidy(count), f"k {kind}, n bigint, s double").toDF(key, "n_tokens", "score")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counted(read(spark, folder, "documents"))
