"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding.

The merges (ranks) are compiled, on demand, into a deterministic transducer over bytes. It rests on
two facts about BPE: every prefix of a piece has one last token, and a token may follow another one
exactly if the two, encoded together, stay apart. A state holds the last token that was emitted and
the bytes since then with the last token of each of their prefixes. Reading a byte finds the last
token of the longer prefix; whatever lies before the boundaries that all possible continuations
share is emitted. A continuation must begin with bytes that begin some token, so the lookahead is
bounded by the longest token. A transition is made when it has been met `MEETINGS` times (until then the rest of
the piece is encoded by the same rule without keeping states), and states are kept up to
`MAX_STATES`; then the table is dropped and grows again, which changes no result.

Decoding takes ids in chunks; a state machine for UTF-8 holds back the bytes of a character that is
not complete yet.

Each match of the split pattern is encoded by itself, without special tokens. Null and empty texts
have no tokens. Texts are taken whole, and rows one by one: repeated rows get equal answers and an
empty table an empty result. Only id and text are read, so columns with clashing names don't matter.
The vocabulary (under 1 MB) is read by the driver and sent with the task.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from featurelab.llm.common import read, ship, tidy

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MAX_STATES = 50_000
MEETINGS = 8  # of a transition before it is made
MAX_PAIRS = 200_000
MAX_PIECES = 250_000  # memoized pieces, short ones only
MEMO_BYTES = 64
CHUNK = 16_384  # ids decoded at a time
ROWS = 256  # encoded at a time


def parse_ranks(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE by its definition: join the neighbours of lowest rank, leftmost first. For short pieces."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        joined = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        known = [r for r in joined if r is not None]
        if not known:
            break
        at = joined.index(min(known))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class State:
    """The token emitted last (-1 at the start) and the bytes since then.

    For each end within those bytes: the last token up to there, and a bit mask of the boundaries
    that the encoding up to there has. `live` are the places where an undecided token may begin.
    """

    __slots__ = ("before", "pending", "lasts", "masks", "live", "moves")

    def __init__(self, before, pending, lasts, masks, live):
        self.before: int = before
        self.pending: bytes = pending
        self.lasts: tuple[int, ...] = lasts
        self.masks: tuple[int, ...] = masks
        self.live: tuple[int, ...] = live
        # byte -> (emitted tokens, state), or how often it was met if not made yet
        self.moves: dict[int, tuple | int] = {}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.max_states = max_states
        self.tokens = dict(zip(ranks.values(), ranks.keys()))
        self.sizes = {i: len(t) for i, t in self.tokens.items()}
        self.beginnings = {t[:k] for t in ranks for k in range(1, len(t))}  # proper prefixes
        self.automaton = ahocorasick.Automaton()  # over bytes, as characters up to U+00FF
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: dict[int, tuple[list, list]] = {}
        self.reset()

    def reset(self) -> None:
        self.start = State(-1, b"", (), (), ())
        self.states = {(-1, b""): self.start}

    def edges_of(self, token: int) -> tuple[list, list]:
        """How a token grows at its left and at its right edge: (bytes, rank made, rank used up)."""
        found = self.edges.get(token)
        if found is None:
            text = self.tokens[token]
            parts, made = [text[i : i + 1] for i in range(len(text))], -1
            left, right = [], []
            first, last, since_first, since_last = parts[0], parts[-1], -1, -1
            while len(parts) > 1:
                joined = [self.ranks.get(a + b, len(self.ranks)) for a, b in zip(parts, parts[1:])]
                made = min(joined)
                at = joined.index(made)
                if made == len(self.ranks):
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                if at == 0:
                    left.append((first, since_first, made))
                    first, since_first = parts[0], made
                if at == len(parts) - 1:
                    right.append((last, since_last, made))
                    last, since_last = parts[-1], made
            left.append((first, since_first, len(self.ranks)))
            right.append((last, since_last, len(self.ranks)))
            found = self.edges[token] = left, right
        return found

    def fit(self, left: int, right: int) -> bool:
        """Whether `right` can follow `left`: no merge across their border comes before the
        merges inside them, the leftmost first among equals."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.apart(left, right)
        return known

    def apart(self, left: int, right: int) -> bool:
        rank, ends = self.ranks.get, self.edges_of(left)[1]
        for y, made_y, used_y in self.edges_of(right)[0]:
            for x, made_x, used_x in ends:
                if made_x <= used_y and made_y < used_x:
                    m = rank(x + y)
                    if m is not None and m < used_x and m <= used_y:
                        return False
        return True

    def last_tokens(self, state: State, tail: bytes) -> list[int]:
        """Last tokens of the encodings up to each byte after the emitted ones.

        It is the longest token that may follow the last token of what lies before it.
        """
        text, lasts, before = state.pending + tail, list(state.lasts), state.before
        pairs, fit, done = self.pairs.get, self.fit, len(lasts)
        # matches come by end, and for one end the longest first
        for last, (size, token) in self.automaton.iter(text.decode("latin-1")):
            if last < done:
                continue
            if last > done:
                raise ValueError("the vocabulary lacks a byte")
            start = last + 1 - size
            left = lasts[start - 1] if start else before
            fits = left < 0 or pairs((left, token))
            if fits or (fits is None and fit(left, token)):
                lasts.append(token)
                done += 1
        if done < len(text):
            raise ValueError("the vocabulary lacks a byte")
        return lasts

    def way(self, lasts) -> list[int]:
        """Tokens from the last tokens of all prefixes."""
        at, out, sizes = len(lasts), [], self.sizes
        while at > 0:
            out.append(lasts[at - 1])
            at -= sizes[out[-1]]
        out.reverse()
        return out

    def move(self, state: State, byte: int) -> tuple[tuple[int, ...], State]:
        """Make the transition of a state by a byte: emitted tokens and the next state."""
        text = state.pending + bytes((byte,))
        n = len(text)
        lasts = tuple(self.last_tokens(state, text[-1:]))
        token = lasts[-1]
        since = n - self.sizes[token]
        mask = (state.masks[since - 1] if since else 0) | 1 << n
        masks = (*state.masks, mask)
        live = [p for p in (*state.live, n - 1) if text[p:] in self.beginnings]
        shared = mask  # boundaries in every way to go on; what begins at n keeps this encoding
        for p in live:
            shared &= masks[p - 1] if p else 0
        emitted: tuple[int, ...] = ()
        before = state.before
        if shared:
            cut = shared.bit_length() - 1
            emitted = tuple(self.way(lasts[:cut]))
            before = emitted[-1]
            text, lasts = text[cut:], lasts[cut:]
            masks = tuple([m >> cut & ~1 for m in masks[cut:]])
            live = [p - cut for p in live]
        following = self.states.get((before, text))
        if following is None:
            following = State(before, text, lasts, masks, tuple(live))
            self.states[before, text] = following
        state.moves[byte] = emitted, following
        return emitted, following

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.states) > self.max_states:
            self.reset()
        state, out = self.start, []
        for at, byte in enumerate(piece):
            step = state.moves.get(byte, 0)
            if step.__class__ is int:
                if step < MEETINGS:  # determinised when the path is met often
                    state.moves[byte] = step + 1
                    out.extend(self.way(self.last_tokens(state, piece[at:])))
                    return tuple(out)
                step = self.move(state, byte)
            if step[0]:
                out.extend(step[0])
            state = step[1]
        out.extend(self.way(state.lasts))
        return tuple(out)


class Utf8Stream:
    """Bytes in, text out; the bytes of an unfinished character wait for the next chunk.

    Bytes that are not UTF-8 become lone surrogates and come back by `encode_back`.
    """

    def __init__(self) -> None:
        self.waiting = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:  # not a continuation: a lead byte or ASCII
                need = 2 if 0xC2 <= byte <= 0xDF else 3 if 0xE0 <= byte <= 0xEF else 0
                need = 4 if 0xF0 <= byte <= 0xF4 else need
                return back if need > back else 0
        return 0

    def push(self, data: bytes) -> str:
        data = self.waiting + data
        cut = len(data) - self.unfinished(data)
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "surrogateescape")

    def finish(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "surrogateescape")


def encode_back(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


class Tokenizer:
    """Encoder and decoder of one vocabulary; pieces met before are taken from a memo."""

    def __init__(self, blob: bytes, pattern: str, max_pieces: int = MAX_PIECES):
        self.max_pieces = max_pieces
        self.transducer = Transducer(parse_ranks(blob))
        self.split = regex.compile(pattern).findall
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}  # the memo before; what is used again moves on

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        memo, extend = self.memo, out.extend
        for piece in self.split(text):
            ids = memo.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                data = piece.encode("utf-8", "surrogatepass") if ids is None else b""
                if ids is None:
                    ids = self.transducer.encode_piece(data)
                if len(data) <= MEMO_BYTES:
                    if len(memo) >= self.max_pieces:
                        self.older, self.memo = memo, {}
                        memo = self.memo
                    memo[piece] = ids
            extend(ids)
        return out

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of the ids, in parts."""
        ids, stream = list(ids), Utf8Stream()
        tokens = self.transducer.tokens
        for at in range(0, len(ids), CHUNK):
            yield stream.push(b"".join(map(tokens.__getitem__, ids[at : at + CHUNK])))
        yield stream.finish()


_OPEN: dict[tuple[bytes, str, int], Tokenizer] = {}


def tokenizer(blob: bytes, pattern: str, max_pieces: int = MAX_PIECES) -> Tokenizer:
    """One tokenizer for each vocabulary and Python worker."""
    name = (hashlib.sha256(blob).digest(), pattern, max_pieces)
    if name not in _OPEN:
        gc.set_threshold(100_000, 20, 50)  # states and memo are kept, so looking at them often finds nothing
        _OPEN.clear()
        _OPEN[name] = Tokenizer(blob, pattern, max_pieces)
    return _OPEN[name]


def _vocabulary(path: str | None) -> tuple[bytes, str]:
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of at most ROWS rows; batches may hold many megabytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def encoded(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    verify: bool = False,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """(key, tokens array<int>, n_tokens) of every row.

    With `verify`, also whether the decoded tokens give the text again. `max_pieces` bounds the memo of a Python worker
    (about 200 bytes a piece, and as many of the time before); it changes no result.
    """
    ship(df.sparkSession)
    blob, pattern = _vocabulary(vocabulary)
    rows = df.select(key, text)

    def encode(batches):
        tok = tokenizer(blob, pattern, max_pieces)
        for part in slices(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            ids = [tok.encode(t) for t in texts]
            columns = [part.column(0), pa.array(ids, pa.list_(pa.int32()))]
            columns.append(pa.array(map(len, ids), pa.int64()))
            if verify:
                same = ["".join(tok.decode(i)) == t for i, t in zip(ids, texts)]
                columns.append(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, ["k", "t", "n", "same"][: len(columns)])

    shape = f"k {rows.schema[0].dataType.simpleString()}, t array<int>, n bigint"
    names = [key, "tokens", "n_tokens"]
    if verify:
        shape, names = f"{shape}, same boolean", [*names, "decoded_equal"]
    return rows.mapInArrow(tidy(encode), shape).toDF(*names)


def round_trip(
    df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row: encoded, then decoded again."""
    ship(df.sparkSession)
    blob, pattern = _vocabulary(vocabulary)
    rows = df.select(key, text)

    def digest(batches):
        tok = tokenizer(blob, pattern)
        names = {i: str(i) for i in tok.transducer.tokens}
        for part in slices(batches):
            counts, by_ids, by_text = [], [], []
            for text in part.column(1).to_pylist():
                ids = tok.encode(text or "")
                counts.append(len(ids))
                joined = ",".join(map(names.__getitem__, ids))
                by_ids.append(hashlib.sha256(joined.encode()).hexdigest())
                back = hashlib.sha256()
                for said in tok.decode(ids):
                    back.update(encode_back(said))
                by_text.append(back.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())],
                ["k", "n", "i", "t"],
            )

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(
        tidy(digest), f"k {kind}, n bigint, i string, t string"
    ).toDF(key, "n_tokens", "ids_sha256", "decoded_sha256")


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(read(spark, folder, "documents"))
