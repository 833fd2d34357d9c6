"""The text queries over whole tables: against their SQL, else against brute force."""

from __future__ import annotations

import collections
import hashlib
import html
import math
import os
import re

import public_tokenizers
import pytest
import tiktoken
import tokenizers

import __spark_entry__ as entry_points
import corpus_pipeline
from featurelab.llm import bpe, decontaminate, quality, sharding, token_count
from featurelab.llm.queries import QUERIES, SQL
from tools.check import compare, duck

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    with duck(FOLDER) as connection:
        yield connection


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("select doc_id, text from documents order by doc_id").fetchall()


@pytest.fixture(scope="module")
def benchmark(con):
    return con.execute("select item_id, text from benchmark").fetchall()


def rows_of(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_all_are_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note


def test_op1(spark, documents):
    table = sharding.fill([f"shard-{i:03d}" for i in range(sharding.SHARDS)])
    for row in rows_of(spark, "op1_sharding"):
        assert row.slot == int(hashlib.md5(str(row.doc_id).encode()).hexdigest()[:12], 16) % sharding.SLOTS
        assert row.shard == table[row.slot]


def test_op3(spark, documents):
    model = open(public_tokenizers.path(token_count.MODEL), "rb").read()
    pieces = token_count.pieces_of(model)
    low = min(pieces.values())
    names = [(dict(token_count.fields(v))[1].decode(), i) for i, (n, v) in enumerate(token_count.fields(model)) if n == 1]
    vocabulary = [(p, pieces.get(p, low)) if p in pieces or p.startswith("<0x") else (f"\0{i}", low) for p, i in names]
    library = tokenizers.Tokenizer(tokenizers.models.Unigram(vocabulary, 0, byte_fallback=True))
    texts = dict(documents)
    for row in rows_of(spark, "op3_token_counts"):
        assert row.n_tokens == len(library.encode("▁" + texts[row.doc_id].replace(" ", "▁")).tokens)


def test_op4(spark, con):
    pages = con.execute("select page_id, html from pages").fetchall()
    got = {r.page_id: r.text for r in rows_of(spark, "op4_html_extraction")}
    assert len(got) == len(pages)
    for page_id, page in pages:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        parts = [re.sub(r"</?b>", "", p).replace("<br>", " ") for p in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(html.unescape(p).split()) for p in parts]
        assert got[page_id] == "\n\n".join(b for b in blocks if b)


def brute_leaks(documents, benchmark):
    plain = {i: " ".join(decontaminate.words_of(t)) for i, t in benchmark}
    return {
        (d, i)
        for d, text in documents
        for i, item in plain.items()
        if f" {item} " in f" {' '.join(decontaminate.words_of(text))} "
    }


def test_op5(spark, documents, benchmark):
    found = {(r.doc_id, r.item_id) for r in rows_of(spark, "op5_decontamination")}
    assert found == brute_leaks(documents, benchmark)
    assert found


def test_op7(spark, documents):
    ranks = bpe.parse_ranks(open(public_tokenizers.path(bpe.VOCABULARY), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(documents)
    for row in rows_of(spark, "op7_byte_bpe"):
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


class PlainModel:
    """Counts in dictionaries, and the interpolation as it is defined."""

    def __init__(self, texts):
        self.n, self.after, self.kinds = collections.Counter(), collections.Counter(), collections.Counter()
        for text in texts:
            data = b"\0\0\0\0" + text.encode()
            for i in range(4, len(data)):
                for k in (0, 1, 2, 4):
                    h, c = data[i - k : i], data[i]
                    self.kinds[h] += (h, c) not in self.n
                    self.n[h, c] += 1
                    self.after[h] += 1

    def p(self, h, c):
        shorter = self.p(h[2:] if len(h) == 4 else h[1:], c) if h else 1 / 256
        if not self.after[h]:
            return shorter
        return (self.n[h, c] + self.kinds[h] * shorter) / (self.after[h] + self.kinds[h])


def test_op8(spark, con, documents):
    good = {r[0] for r in con.execute("select doc_id from labels where quality = 1").fetchall()}
    every, target = PlainModel(t for _, t in documents), PlainModel(t for i, t in documents if i in good)
    got = {r.doc_id: r for r in rows_of(spark, "op8_lm_scoring")}
    assert len(got) == len(documents)
    for doc_id, text in documents[:25]:
        data = b"\0\0\0\0" + text.encode()
        bits = [
            math.log2(every.p(data[i - 4 : i], data[i]) / target.p(data[i - 4 : i], data[i]))
            for i in range(4, len(data))
        ]
        assert got[doc_id].score == pytest.approx(sum(bits) / len(bits), abs=1e-5)
        assert got[doc_id].n_tokens == len(bits)


def brute_components(documents, size):
    sets = {}
    for i, text in documents:
        words = text.encode().lower().split()
        k = min(size, len(words))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if k else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_op9(spark, documents):
    wanted = brute_components(documents, 4)
    for row in rows_of(spark, "op9_setsketch_near_dup"):
        assert (row.n_shingles, row.component_id) == wanted[row.doc_id]
        assert row.kept == (row.doc_id == row.component_id)


def test_near_copies_that_no_head_joins(spark):
    """A chain of copies, each changed a little more, and changed copies of one text."""
    from featurelab.llm.near_dup import near_duplicates

    base = [f"w{i}" for i in range(120)]
    texts = []
    for step in range(40):
        texts.append((step, " ".join(base[:step] + [f"new{i}" for i in range(step)] + base[step:])))
    for k in range(60):
        words = list(base[::-1])
        for e in range(k % 9):
            words[(k * 7 + e * 13) % 120] = f"edit{k}x{e}"
        texts.append((1000 + k, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    wanted = brute_components(texts, 4)
    for row in near_duplicates(df).collect():
        assert (row.n_shingles, row.component_id) == wanted[row.doc_id]


def brute_lines(docs):
    """Line dedup by its definition."""
    seen, out = set(), []
    for doc_id, text in docs:
        lines = text.split("\n")
        held = [i for i, line in enumerate(lines) if line.strip(" \t\r\x0b\x0c")]
        gone = set()
        for k in range(len(held) - 2):
            window = tuple(lines[i].strip(" \t\r\x0b\x0c") for i in held[k : k + 3])
            if window in seen:
                gone.update(range(held[k], held[k + 2] + 1))
            seen.add(window)
        left = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        if left.split() or not gone:
            out.append((doc_id, left))
    return out


def test_pipeline(spark, documents, benchmark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    by_stage = []
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, FOLDER)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        by_stage.append(docs)
    kept = {r.doc_id for r in quality.measured(spark.read.parquet(f"{FOLDER}/documents.parquet")).where("kept").select("row.doc_id").collect()}
    states = [sorted((r.doc_id, r.text) for r in d.collect()) for d in by_stage[:4]]
    assert {i for i, _ in states[0]} == kept
    assert states[1] == brute_lines(states[0])
    groups = brute_components(states[1], 5)
    assert states[2] == [(i, t) for i, t in states[1] if groups[i][1] == i]
    leaking = {d for d, _ in brute_leaks(states[2], benchmark)}
    assert states[3] == [(i, t) for i, t in states[2] if i not in leaking]
    ranks = bpe.parse_ranks(open(public_tokenizers.path(bpe.VOCABULARY), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = {r.doc_id: r for r in by_stage[4].collect()}
    for doc_id, text in states[3]:
        assert tokens[doc_id].tokens == library.encode_ordinary(text)
        assert tokens[doc_id].decoded_equal
    assert len(tokens) == len(states[3])
    assert all(d.columns == columns for d in by_stage[:4])
    assert all(r.n_chars == len(r.text) for r in by_stage[3].collect())
