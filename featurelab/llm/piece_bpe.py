"""SentencePiece BPE: exact encoding by backtracking over the pieces, and decoding.

The text gets a blank in front, and blanks become U+2581. An Aho-Corasick automaton lists the pieces
that begin at each character. From left to right the longest one is taken that may follow the piece
before it; where none may, the position is marked in a bitfield as failed, the last piece is taken
back and the next shorter one is tried. Whether a piece may follow another is found by merging the two
together: they must come out as themselves. A sequence of which that holds for all neighbours is
the result of the merges, and there is one only, also for each beginning of the text; so a position
that failed once has failed for good, and the work is linear in the text.

Merges go by score, the leftmost first among equals. Characters that are no piece become the pieces
of their UTF-8 bytes. No merge crosses a border over which no piece goes; the text is cut where
that is sure for every model of this kind (before blanks, around characters that occur in no longer
piece), and words met before are looked up in a memo of bounded size.

Null and empty texts have no pieces, only the end id if one is asked for. Texts are taken whole; rows
one by one, so repeated rows get equal answers and an empty table an empty result. Only id and text are
read, so columns with clashing names do not matter. The model file (0.5 MB) is read by the driver and
sent with the task; models of another type, or that change texts otherwise, raise.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from featurelab.llm.common import read, ship, tidy
from featurelab.llm.token_count import BLANK, fields

MODEL = "piece_bpe_32k.model"
MAX_PAIRS = 400_000
MAX_WORDS = 250_000
MEMO_CHARS = 48

# fixed values of the model format: types of pieces, and the model type of merges
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2

# one U+FFFD for each byte that is no part of a character
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """What the model file says: pieces with their scores, bytes, and the text of each id."""

    def __init__(self, model: bytes):
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes = [-1] * 256
        self.texts: list[bytes | None] = []  # None for ids that stand for no text
        self.end = -1
        kinds = set()
        for number, value in fields(model):
            if number == 1:
                parts = dict(fields(value))
                piece, kind, at = parts[1].decode(), parts.get(3, NORMAL), len(self.texts)
                kinds.add(kind)
                text = piece.replace(BLANK, " ").encode()
                if kind == NORMAL:
                    self.ids[piece] = at
                    self.scores[piece] = struct.unpack("<f", parts.get(2, b"\0" * 4))[0]
                elif kind == BYTE:
                    byte = int(piece[3:5], 16)
                    self.bytes[byte], text = at, bytes((byte,))
                elif kind == CONTROL:
                    text = None
                    self.end = at if piece == "</s>" else self.end
                elif kind == UNKNOWN:
                    text = " ⁇ ".encode()
                self.texts.append(text)
            elif number == 2 and dict(fields(value)).get(3, 1) != MERGES:
                raise ValueError("not a model of merges")
            elif number == 3:
                rules = dict(fields(value))
                if rules.get(2) or not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("the model changes texts in a way that is not known here")
        if kinds & {USER_DEFINED, UNUSED} or min(self.bytes) < 0:
            raise ValueError("the model has pieces of a kind that is not known here")


class Encoder:
    def __init__(self, model: bytes):
        self.pieces = pieces = Pieces(model)
        self.names = list(map(str, range(len(pieces.texts))))
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.of = {at: piece for piece, at in pieces.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, at in pieces.ids.items():
            if self.merged(piece) == [piece]:  # others never come out of the merges
                self.automaton.add_word(piece, (len(piece), at))
        self.automaton.make_automaton()
        longer = [p for p in pieces.ids if len(p) > 1]
        within = set("".join(longer))
        alone = "".join(re.escape(c) for c in map(chr, range(128)) if c not in within)
        # a piece that goes on from another character into a blank forbids the cut before blanks
        bridged = any(BLANK in p.lstrip(BLANK) for p in longer)
        word = f"[^{alone}]+" if bridged else f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+"
        self.cut = re.compile(f"[{alone}]|{word}" if alone else word).findall

    def merged(self, text: str) -> list[str]:
        """The merges by their definition: neighbours of highest score, leftmost first. For short texts."""
        parts, score = list(text), self.pieces.scores.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = score(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: int, right: int) -> bool:
        """Whether the merges leave the border between two pieces alone."""
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        a, b = self.of[left], self.of[right]
        known = self.pairs[left << 32 | right] = self.merged(a + b) == [a, b]
        return known

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of a word, by backtracking from the longest matches."""
        size = len(word)
        begin: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for last, match in self.automaton.iter(word):
            begin[last + 1 - match[0]].append(match)  # from the shortest to the longest
        if begin[0] and begin[0][-1][0] == size:
            return (begin[0][-1][1],)
        pairs, out = self.pairs, []
        failed = bytearray(size // 8 + 1)
        taken: list[tuple[int, int, int, int]] = []  # position, which match, piece, piece before
        at, which, before = 0, len(begin[0]) - 1, -1
        while at < size:
            matches = begin[at]
            if not matches:
                # a character that is no piece stands in no longer piece either: what is before it is final
                out.extend([piece for _, _, piece, _ in taken])
                out.extend([self.pieces.bytes[b] for b in word[at].encode("utf-8", "surrogatepass")])
                taken.clear()
                at, before = at + 1, -1
                which = len(begin[at]) - 1 if at < size else 0
                continue
            while which >= 0:
                length, piece = matches[which]
                after = at + length
                if not failed[after >> 3] & 1 << (after & 7):
                    fits = before < 0 or pairs.get(before << 32 | piece)
                    if fits or (fits is None and self.fit(before, piece)):
                        break
                which -= 1
            if which >= 0:
                taken.append((at, which, piece, before))
                at, before = after, piece
                which = len(begin[at]) - 1 if at < size else 0
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at, which, _, before = taken.pop()
                which -= 1
        out.extend([piece for _, _, piece, _ in taken])
        return tuple(out)

    def encode(self, text: str | None, end: bool = False) -> list[int]:
        out: list[int] = []
        if text:
            words, extend = self.words, out.extend
            for word in self.cut(BLANK + text.replace(" ", BLANK)):
                ids = words.get(word)
                if ids is None:
                    ids = self.word(word)
                    if len(word) <= MEMO_CHARS:
                        if len(words) >= MAX_WORDS:
                            words.clear()
                        words[word] = ids
                extend(ids)
        if end:
            out.append(self.pieces.end)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids, without the blank in front if the first piece brings one."""
        out, part, texts = [], [], self.pieces.texts
        for i in ids:
            if texts[i] is not None:
                part.append(i)
            elif part:  # bytes on both sides of such an id make no character
                out.append(part)
                part = []
        out.append(part)
        said = [b"".join(map(texts.__getitem__, part)) for part in out]
        if out[0] and self.of.get(out[0][0], "").startswith(BLANK):
            said[0] = said[0][1:]
        return "".join([data.decode("utf-8", "each_byte") for data in said])


_OPEN: dict[bytes, Encoder] = {}


def encoder(model: bytes) -> Encoder:
    """One encoder for each model and Python worker."""
    name = hashlib.sha256(model).digest()
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = Encoder(model)
    return _OPEN[name]


def read_model(path: str | None = None) -> bytes:
    import public_tokenizers

    with open(path or public_tokenizers.path(MODEL), "rb") as file:
        return file.read()


def encoded(
    df: DataFrame, key: str = "doc_id", text: str = "text", model_path: str | None = None, end: bool = True
) -> DataFrame:
    """(key, tokens array<int>, n_tokens) of every row."""
    ship(df.sparkSession)
    model, rows = read_model(model_path), df.select(key, text)

    def encode(batches):
        of = encoder(model).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [of(value.as_py(), end) for value in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(len, ids), pa.int64())],
                    ["k", "t", "n"],
                )

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(tidy(encode), f"k {kind}, t array<int>, n bigint").toDF(key, "tokens", "n_tokens")


def decoded(df: DataFrame, key: str = "doc_id", tokens: str = "tokens", model_path: str | None = None) -> DataFrame:
    """(key, text) of every row of ids; null for null."""
    ship(df.sparkSession)
    model, rows = read_model(model_path), df.select(key, tokens)

    def decode(batches):
        of = encoder(model).decode
        for batch in batches:
            texts = [None if ids.as_py() is None else of(ids.as_py()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["k", "t"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(tidy(decode), f"k {kind}, t string").toDF(key, "text")


def round_trip(
    df: DataFrame, key: str = "doc_id", text: str = "text", model_path: str | None = None
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row: encoded with an end id, then decoded."""
    ship(df.sparkSession)
    model, rows = read_model(model_path), df.select(key, text)

    def digest(batches):
        tok = encoder(model)
        name = tok.names.__getitem__
        for batch in batches:
            counts, by_ids, by_text = [], [], []
            for value in batch.column(1):
                ids = tok.encode(value.as_py(), end=True)
                counts.append(len(ids))
                by_ids.append(hashlib.sha256(" ".join(map(name, ids)).encode()).hexdigest())
                by_text.append(hashlib.sha256(tok.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())],
                ["k", "n", "i", "t"],
            )

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(tidy(digest), f"k {kind}, n bigint, i string, t string").toDF(
        key, "n_tokens", "ids_sha256", "decoded_sha256"
    )


def op11_piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(read(spark, folder, "documents"))
