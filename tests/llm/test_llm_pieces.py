"""Piece encoding, token alignment and hard negatives: against the libraries and brute force."""

from __future__ import annotations

import collections
import functools
import hashlib
import json
import math
import os

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featurelab.llm import align, hard_negatives, piece_bpe
from featurelab.llm.queries import QUERIES
from tools.check import duck

FOLDER = "/root/testdata/sf0.001"
SIGNS = [
    "a", "e", "t", "the", "ing", "an", " ", "  ", "   ", "\n", "\t", "0", "12", "=", "==", "é", "ü", "世", "界", "벨", "梦",
    "𝔘", "😀", "▁", " ", "​", "�", "İ", "<s>", "</s>", "<0x41>", "<|endoftext|>", "Ġ", "ﬁ", "\x00", ".", ",",
]
TEXTS = st.lists(st.sampled_from(SIGNS), max_size=25).map("".join)

#: (id, text); the other columns carry names that the operators use inside.
DOCS = [
    (1, "one two three"), (1, "one two three"), (2, None), (3, ""), (None, "one two"), (None, None), (4, "▁one"),
    (5, "word " * 30_000), (6, " \n\t "), (7, "x" * 5_000), (8, "über ☃ 😀 <s> <|endoftext|>"),
]
SHAPE = "doc_id bigint, text string, k string, pair string, _row string, _key string, tokens string, id string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "k", "p", "r", "y", "t", "d") for i, t in DOCS], SHAPE)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.Encoder(piece_bpe.read_model())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_bpe.MODEL))


@pytest.fixture(scope="module")
def documents():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    with duck(FOLDER) as con:
        return con.execute("select doc_id, text from documents order by doc_id").fetchall()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# piece encoding


@settings(max_examples=300, deadline=None)
@given(text=TEXTS | st.text(max_size=40))
def test_pieces_equal_library(pieces, library, text):
    ids = pieces.encode(text, end=True)
    assert ids == [*library.encode(text), 2]
    assert pieces.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("text", [" " * 20_001, "a" * 9_000, "ab" * 5_000, "=" * 4_999, "世" * 3_000, " a" * 5_000, "\n" * 999])
def test_long_runs_of_pieces(pieces, library, text):
    assert pieces.encode(text) == library.encode(text)


@settings(max_examples=200, deadline=None)
@given(ids=st.lists(st.sampled_from([0, 1, 2, 35, 229, 230, 231, 259, 260, 29871, 1000]) | st.integers(0, 31_999), max_size=8))
def test_any_ids_are_decoded_as_by_the_library(pieces, library, ids):
    # an unknown id at the start keeps its blank; bytes that are no character become U+FFFD each
    assert pieces.decode(ids) == library.decode(ids)


def field(number: int, value: bytes | int | float) -> bytes:
    """A field of a protobuf message: text, a float, or a small number."""
    import struct

    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    if isinstance(value, int):
        return bytes([number << 3, value])
    size, out = len(value), b""
    while size > 127:
        out, size = out + bytes([size & 127 | 128]), size >> 7
    return bytes([number << 3 | 2]) + out + bytes([size]) + value


def tiny_model(scores: dict[str, float], kind: int = 2, whites: int = 0) -> bytes:
    special = [("<unk>", 2), ("<s>", 3), ("</s>", 3)]
    rows = [(p.encode(), 0.0, k) for p, k in special] + [(f"<0x{b:02X}>".encode(), 0.0, 6) for b in range(256)]
    rows += [(p.encode(), s, 1) for p, s in scores.items()]
    out = b"".join(field(1, field(1, p) + field(2, s) + field(3, k)) for p, s, k in rows)
    return out + field(2, field(3, kind)) + field(3, field(1, b"identity") + field(3, 1) + field(4, whites))


def test_backtracking_is_needed_and_finds_the_merges():
    # "abc" is the longest piece at the start, but "bcd" is merged first
    model = tiny_model({"cd": -1.0, "bcd": -2.0, "ab": -3.0, "abc": -4.0, "▁": -9.0, "a": -9.0, "b": -9.0, "c": -9.0, "d": -9.0})
    tool = piece_bpe.Encoder(model)
    names = {i: p for p, i in tool.pieces.ids.items()}
    for word in ("abcd", "abcabcd", "aabcdcdab", "bcdabc" * 5):
        assert [names[i] for i in tool.word(word)] == tool.merged(word)
    assert [names[i] for i in tool.word("abcd")] == ["a", "bcd"]


@settings(max_examples=150, deadline=None)
@given(
    pieces_=st.lists(st.text("abc▁", min_size=2, max_size=5), max_size=12, unique=True),
    data=st.data(),
    words=st.lists(st.text("abc▁x", min_size=1, max_size=18), min_size=1, max_size=6),
)
def test_any_vocabulary_by_definition(pieces_, data, words):
    """Scores tie, pieces may be out of reach of the merges and go on from letters into blanks."""
    ranks = data.draw(st.lists(st.integers(-4, -1), min_size=len(pieces_), max_size=len(pieces_)))
    scores = {c: -9.0 for c in "abc▁"} | dict(zip(pieces_, map(float, ranks)))
    tool = piece_bpe.Encoder(tiny_model(scores))
    names = {i: p for p, i in tool.pieces.ids.items()}
    for word in words:
        got = "".join(names.get(i, "x") + "|" for i in tool.word(word))
        assert got == "".join(p + "|" for p in tool.merged(word))
        text = word.replace("▁", " ")
        whole = [p for p in tool.merged("▁" + word)]
        assert [names.get(i, "x") for i in tool.encode(text)] == whole


@pytest.mark.parametrize("kind, whites", [(1, 0), (2, 1)])
def test_other_models_are_refused(kind, whites):
    with pytest.raises(ValueError):
        piece_bpe.Encoder(tiny_model({"a": -1.0}, kind, whites))


def test_memos_may_be_dropped(monkeypatch, library):
    monkeypatch.setattr(piece_bpe, "MAX_PAIRS", 5)
    monkeypatch.setattr(piece_bpe, "MAX_WORDS", 3)
    tool = piece_bpe.Encoder(piece_bpe.read_model())
    text = "The quick brown fox jumps over 12 lazy dogs, über 世界 and further."
    assert tool.encode(text) == library.encode(text)
    assert tool.encode(text) == library.encode(text)


def test_piece_tables(docs, nothing, library):
    rows = piece_bpe.encoded(docs).collect()
    assert sorted((r.doc_id or 0, list(r.tokens), r.n_tokens) for r in rows) == sorted(
        (i or 0, [*library.encode(t or ""), 2], len(library.encode(t or "")) + 1) for i, t in DOCS
    )
    back = piece_bpe.decoded(piece_bpe.encoded(docs)).collect()
    assert collections.Counter((r.doc_id, r.text) for r in back) == collections.Counter(
        (i, (t or "").replace("▁", " ")) for i, t in DOCS
    )
    assert piece_bpe.round_trip(nothing).count() == piece_bpe.encoded(nothing).count() == 0


def test_op11(spark, documents, library):
    got = {r.doc_id: r for r in QUERIES["op11_piece_bpe"](spark, FOLDER).collect()}
    assert len(got) == len(documents)
    for key, text in documents:
        ids = [*library.encode(text or ""), 2]
        want = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
        assert (got[key].n_tokens, got[key].ids_sha256, got[key].decoded_sha256) == want


# alignment


@functools.cache
def entries_of(first):
    byte = align.byte_names()
    assert sorted(byte.values()) == list(range(256))
    return {i: bytes(byte[c] for c in e) for e, i in first.get_vocab().items() if "<|endoftext|>" != e}


@functools.cache
def tools_of(first):
    with open(public_tokenizers.path(align.MERGE_FILE), encoding="utf-8") as file:
        files = file.read(), piece_bpe.read_model()
    return [align.Aligner(*files, entry) for entry in (align.linked, align._ids_and_ends)]


def slow_alignment(texts, first, library):
    """Groups by walking both id lists; links and counts by dictionaries over all texts."""
    entries = entries_of(first)
    groups = []
    for text in texts:
        whole = f" {text}".encode() if text else b""
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = library.encode(text) if text else []
        piece = [library.id_to_piece(i) for i in b]
        other = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, piece)]
        if not text or b"".join(entries[i] for i in a) != whole or b"".join(other) != whole:
            groups.append([])
            continue
        out, ours, theirs, x, y, j = [], [], [], 0, 0, 0
        for i in a:
            ours.append(i)
            x += len(entries[i])
            while y < x:
                theirs.append(b[j])
                y += len(other[j])
                j += 1
            if x == y:
                out.append((ours, theirs))
                ours, theirs = [], []
        groups.append(out)
    links = [collections.Counter((a, b) for ours, theirs in g for a in ours for b in theirs) for g in groups]
    count = collections.Counter(pair for one in links for pair in one)
    most = collections.defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    rows = []
    for g, one in zip(groups, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append(
            (
                sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(one.values()),
                sum(n for p, n in one.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in one.items()),
                sha(said) if g else "",
            )
        )
    return rows


@pytest.fixture(scope="module")
def first():
    tool = tokenizers.Tokenizer.from_file(public_tokenizers.path(align.MERGE_FILE))
    tool.encode_special_tokens = True
    return tool


def as_rows(df):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return collections.Counter((r.doc_id, *(r[n] for n in names)) for r in df.collect())


@pytest.mark.parametrize("hot", [0, 7, align.HOT_PAIRS])
def test_alignment_of_awkward_rows(docs, first, library, hot):
    """Counts come from broadcast pairs, from the join, or from both."""
    want = slow_alignment([t for _, t in DOCS], first, library)
    got = as_rows(align.link_statistics(docs, hot_pairs=hot))
    assert got == collections.Counter((i, *row) for (i, _), row in zip(DOCS, want))


def test_alignment_tables(docs, nothing, first, library):
    assert align.link_statistics(nothing).count() == align.aligned(nothing).count() == 0
    rows = [r for r in align.aligned(docs).collect() if r.doc_id == 8]
    assert list(rows[0]["first"]) == first.encode(" über ☃ 😀 <s> <|endoftext|>", add_special_tokens=False).ids
    assert (rows[0].groups[-1].first_end, rows[0].groups[-1].second_end) == (len(rows[0]["first"]), len(rows[0].second))


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXTS, min_size=1, max_size=3))
def test_groups_by_walking(first, library, texts):
    tool, full = tools_of(first)
    want = slow_alignment(texts, first, library)
    for text, row in zip(texts, want):
        (parts,) = tool.segments([text])
        _, sums, said = align.links_of(parts)
        assert (*sums, sha(said) if parts else "") == (*row[:4], row[6])
        (parts,) = full.segments([text])
        a, b, cuts = align.whole(parts)
        assert (len(a), len(b), len(cuts)) == row[:3]
        assert not parts or a == first.encode(f" {text}", add_special_tokens=False).ids and b == library.encode(text)


def test_broadcast_bound(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1, 1, 1, 2, 3, 4, 9, 9])], "pair bigint, docs bigint")
    assert [align.broadcast_from(counts, most) for most in (0, 1, 2, 3, 4, 5, 8)] == [16, 16, 8, 4, 4, 2, 1]


def test_op12(spark, documents, first, library):
    want = slow_alignment([t for _, t in documents], first, library)
    got = as_rows(QUERIES["op12_token_alignment"](spark, FOLDER))
    assert got == collections.Counter((i, *row) for (i, _), row in zip(documents, want))


# hard negatives


def slow_mine(rows, every, rules=hard_negatives.Rules(), scale=256):
    """By definition, over whole lists."""
    good = {
        (i, l, tuple(math.floor(scale * x) for x in v))
        for i, l, v in rows
        if None not in (i, l, v) and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, l, v in good:
        if i % every:
            continue
        scored = {
            (-sum(a * b for a, b in zip(v, w)), j, l == m) for j, m, w in good if j != i and len(v) == len(w)
        }
        positives = [x for x in sorted(scored) if x[2]][: rules.positives]
        for p, j, _ in positives:
            fits = [x for x in sorted(scored) if not x[2] and -rules.low * p <= -100 * x[0] <= -rules.high * p]
            out += [(i, j, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(fits[: rules.negatives])]
    return collections.Counter(out)


VECTORS = "vec_id bigint, label int, embedding array<float>, id string, number string, key string, n string"


def mined(spark, rows, every, parts=3, **more):
    df = spark.createDataFrame([(i, l, v, "i", "n", "k", "x") for i, l, v in rows], VECTORS).repartition(parts)
    return collections.Counter(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % every == 0, **more).collect())


def points(n, seed, size=4, step=4, labels=3):
    import random

    deal = random.Random(seed)
    return [(i, deal.randrange(labels), [deal.randrange(-step, 3 * step) / 16 for _ in range(size)]) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_negatives_with_many_ties(spark, parts):
    rows = points(240, 5)
    want = slow_mine(rows, 20)
    assert len(want) > 50
    assert mined(spark, rows, 20, parts) == want


def test_negatives_in_chunks_of_anchors(spark):
    rows = points(150, 6)
    assert mined(spark, rows, 10, chunk_bytes=600) == slow_mine(rows, 10)


def test_one_vector_in_a_third_of_all_rows(spark):
    rows = points(120, 7) + [(1000 + i, i % 3, [0.5, 0.5, 0.25, 0.25]) for i in range(60)]
    assert mined(spark, rows, 20, 4) == slow_mine(rows, 20)


def test_other_rules(spark):
    rules = hard_negatives.Rules(positives=2, negatives=4, low=0, high=100)
    rows = points(90, 8)
    assert mined(spark, rows, 15, rules=rules) == slow_mine(rows, 15, rules)
    with pytest.raises(ValueError):
        hard_negatives.Rules(high=101)


def test_awkward_vectors(spark):
    rows = points(60, 9) + [
        (None, 1, [0.5] * 4), (100, None, [0.5] * 4), (110, 1, None), (120, 1, [0.5, None, 0.5, 0.5]),
        (130, 1, [float("nan")] * 4), (140, 1, [float("inf"), 0.0, 0.0, 0.0]), (150, 1, []), (160, 2, []), (161, 1, []),
        (170, 0, [0.5, 0.5]), (171, 0, [0.5, 0.25]), (172, 1, [0.25, 0.5]), (-10, 0, [0.5] * 4),
    ]
    rows += rows[:20]  # repeated rows
    rows += [(10, 2, [0.75] * 4), (21, 0, [0.5] * 4), (21, 1, [0.5] * 4)]  # ids with several vectors or labels
    want = slow_mine(rows, 10)
    assert -10 in {r[0] for r in want} and 10 in {r[0] for r in want}
    assert mined(spark, rows, 10) == want


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, [], 10) == mined(spark, points(9, 1)[1:], 10) == collections.Counter()
    with pytest.raises(Exception, match="2\\^53"):
        mined(spark, [(0, 1, [1e9]), (1, 1, [1e9])], 10)


def test_keys_sort_as_their_parts():
    parts = [(a, s, r, i) for a in (0, 3, 1 << 40) for s in (-(1 << 60), -1, 0, 7) for r in (0, 1) for i in (-5, 0, 9)]
    want = sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))
    assert [hard_negatives.unpack(k) for k in sorted(hard_negatives.pack(*p) for p in parts)] == want


def test_negative_plan_deals_by_anchor_and_sorts(spark):
    keys = spark.createDataFrame([(b"x" * 25,)], "key binary")
    found = hard_negatives._sorted_stream(keys, hard_negatives._emit(hard_negatives.Rules()), "n bigint, p bigint, r int, x bigint, ps bigint, ns bigint")
    plan = json.dumps(found._jdf.queryExecution().toString())
    assert "Sort [key" in plan and "substring(key" in plan and plan.count("Exchange") == 1
