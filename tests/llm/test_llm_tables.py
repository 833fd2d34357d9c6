"""The text operators on tables: awkward rows, empty tables, clashing names, layouts."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from featurelab.llm import bpe, decontaminate, html_extract, line_dedup, lm_score, near_dup, pipeline
from featurelab.llm import quality, sharding, token_count, url_filter
from featurelab.llm.components import components

PROSE = (
    "The quick brown fox jumps over the lazy dog while seven quiet geese watch from a bank of the "
    "river and think about nothing in particular until evening comes."
)
OTHER = " ".join(f"another{i} word{i}" for i in range(30)) + "."
LONG = "\n".join(f"line {i} of a very long text, number {i * 7} of many." for i in range(6000))
ITEM = "Which animal jumps over the lazy dog in the well known sentence? It is the quick brown fox, of course."
LABELS = [(1, 1, 0), (2, 0, 0), (None, 1, 1), (4, None, None), (1, 1, 0), (99, 1, 0)]

#: (id, text); extra columns carry names that operators use inside.
DOCS = [
    (1, PROSE),
    (1, PROSE),
    (2, PROSE.replace("comes", "arrives")),
    (3, ""),
    (4, None),
    (None, PROSE),
    (None, None),
    (5, LONG),
    (6, "  \n\t\n "),
    (7, OTHER),
    (7, f"{OTHER} {ITEM} Some more words."),
    (8, "word"),
    (9, "über ☃ 😀 \u00a0 x\r\ny\x0bz"),
]
SHAPE = (
    "doc_id bigint, text string, lang string, row string, key string, id string, kept string, n_words int, "
    "print int, ranges string, clean_text string, tokens string, n_chars bigint, w string, slot string"
)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, "r", None, "i", "k", 3, 4, "g", "c", "t", 5, "w", "s") for i, t in DOCS]
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, ITEM), (1, ITEM), (2, None), (None, PROSE), (3, ""), (4, "?"), (5, "unrelated words only here")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def by_text(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_quality(docs, nothing):
    rows = quality.measured(docs).select("row.doc_id", "row.text", "n_words", "base_failed", "kept").collect()
    assert len(rows) == len(DOCS)
    for row in rows:
        assert row.n_words == len((row.text or "").encode().split())
        assert row.base_failed == (row.n_words < 20)
        assert row.kept == (not row.base_failed)
    assert quality.measured(nothing).count() == 0


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("A plain sentence with a | bar and # 1 sign.", False),
        ("Home | News | Sport | About us | Contact", True),
        ("word### other*** more%%% and$$$", True),
        ("BUY!! NOW!! AND!! HERE!!", True),
        ("Licensed under the Apache License, Version 2.0.", True),
        ("This site uses cookies.", True),
        ("He said: no!! Then he went home and slept for a week.", False),
    ],
)
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(quality.line_fails(F.col("line"))).first()[0] == fails


def test_quality_rejects_what_loses_too_much(spark):
    good, bad = "A sentence of ten words stands here for the test.", "Home | News | Sport | About | More | Jobs | Ads |"
    texts = [(1, "\n".join([good] * 1 + [OTHER, bad])), (2, "\n".join([bad, bad.lower(), bad.upper(), good]))]
    rows = quality.measured(spark.createDataFrame(texts, "doc_id int, text string")).orderBy("row.doc_id").collect()
    assert [(r.kept, r.n_lines_removed) for r in rows] == [(True, 1), (False, 3)]
    assert bad not in rows[0].clean_text


def brute_repeats(words, size=8):
    at = {}
    for i in range(len(words) - size + 1):
        at.setdefault(tuple(words[i : i + size]), []).append(i)
    return len({p for starts in at.values() if len(starts) > 1 for s in starts for p in range(s, s + size)})


def test_repeated_words(spark):
    texts = ["a " * 30, PROSE, f"{PROSE} {PROSE}", " ".join(map(str, range(9))) * 3, "a b c d e f g h", ""]
    texts += [" ".join(str(i * i % 11) for i in range(n)) for n in (20, 50, 200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    for row in quality.measured(df).select("row.doc_id", "n_repeat_words").collect():
        assert row.n_repeat_words == brute_repeats(texts[row.doc_id].split())


def test_sharding(docs, nothing):
    names = [f"s{i}" for i in range(5)]
    rows = sharding.placed(docs, names, 101).collect()
    assert len(rows) == len(DOCS)
    assert all(r.shard_name == names[r.shard] for r in rows)
    assert len({(r.row.doc_id, r.slot) for r in rows if r.row.doc_id is not None}) == 9
    assert {r.slot for r in rows if r.row.doc_id is None and r.row.text} != {
        r.slot for r in rows if r.row.doc_id is None and not r.row.text
    }
    assert sharding.placed(nothing, names, 101).count() == 0


def test_written_shards_hold_every_row(spark, docs, tmp_path):
    sharding.write_shards(docs.select("doc_id", "text"), f"{tmp_path}/out", ["a", "b"])
    assert by_text(spark.read.parquet(f"{tmp_path}/out"), "doc_id", "text") == by_text(docs, "doc_id", "text")


def test_token_counts(docs, nothing):
    rows = token_count.counted(docs).collect()
    assert len(rows) == len(DOCS)
    assert {r.doc_id: r.n_tokens for r in rows}[3] == 0
    assert token_count.counted(nothing).count() == 0


def test_bpe(docs, nothing):
    rows = bpe.round_trip(docs.where("doc_id != 7")).collect()
    import hashlib

    texts = dict(DOCS)
    for row in rows:
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()
    encoded = bpe.encoded(docs, verify=True).collect()
    assert len(encoded) == len(DOCS)
    assert all(r.decoded_equal and r.n_tokens == len(r.tokens) for r in encoded)
    assert bpe.encoded(nothing).count() == bpe.round_trip(nothing).count() == 0


def test_line_dedup_edges(docs, nothing):
    rows = line_dedup.deduplicated(docs).select("row.doc_id", "row.text", "left_text", "n_removed").collect()
    assert len(rows) == len(DOCS)
    assert all(r.text == r.left_text and r.n_removed == 0 for r in rows)
    assert line_dedup.deduplicated(nothing).count() == 0


def test_line_dedup_covers_and_merges(spark):
    a, b, c, d, e = (f"line {x} here" for x in "abcde")
    texts = [
        (1, [a, b, c, d]),
        (2, ["new", a, "", b, c, d, "end"]),  # two overlapping windows, a blank line inside
        (3, [a, b, "other", c, d]),  # never three in a row
        (4, [a, b, c, a, b, c, e]),  # later occurrences, also within the document
        (None, ["x", "y", "z"]),
        (5, ["x ", "y", " z"]),  # white space around lines does not count
    ]
    df = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts], "doc_id bigint, text string")
    rows = line_dedup.deduplicated(df).select("row.doc_id", "left_text", "n_removed").collect()
    assert {r.doc_id: (r.left_text.split("\n"), r.n_removed) for r in rows} == {
        1: ([a, b, c, d], 0),
        2: (["new", "end"], 5),
        3: ([a, b, "other", c, d], 0),
        4: ([e], 6),
        None: (["x", "y", "z"], 0),
        5: ([""], 3),
    }


def test_decontamination_edges(docs, nothing, benchmark, spark):
    rows = decontaminate.leaks(docs, benchmark).collect()
    assert [(r.doc_id, r.item_id, r.score) for r in rows] == [(7, 1, 1.0)]
    left = decontaminate.without_leaks(docs, benchmark)
    assert left.columns == docs.columns
    assert left.count() == len(DOCS) - 1
    assert decontaminate.leaks(nothing, benchmark).count() == 0
    none = spark.createDataFrame([], benchmark.schema)
    assert decontaminate.leaks(docs, none).count() == 0
    assert decontaminate.without_leaks(docs, none).count() == len(DOCS)


def test_decontamination_in_shards(docs, benchmark, monkeypatch, spark):
    many = benchmark.union(spark.range(50).select("id", F.concat(F.lit("item with a number "), F.col("id").cast("string"), F.lit(" and the end of it"))))
    whole = by_text(decontaminate.leaks(docs, many), "doc_id", "item_id", "score")
    monkeypatch.setattr(decontaminate, "SHARD_CHARS", 500)
    assert by_text(decontaminate.leaks(docs, many), "doc_id", "item_id", "score") == whole


def test_lm_edges(docs, nothing, labels):
    rows = lm_score.scored(docs, labels).collect()
    assert len(rows) == len(DOCS)
    assert {r.doc_id: r.score for r in rows}[3] is None
    assert all(r.n_tokens > 0 for r in rows if r.score is not None)
    target = next(r.score for r in rows if r.doc_id == 1)
    assert target < next(r.score for r in rows if r.doc_id == 8)
    assert lm_score.scored(nothing, labels).count() == 0
    uniform = lm_score.scored(docs, labels.where("doc_id < 0")).collect()
    assert all(r.score > 0 for r in uniform if r.doc_id == 1)


def witten_bell(texts):
    """Probability of the last byte of a five-gram, by the definition; texts: {text: times}."""
    after = {}
    for text, times in texts.items():
        data = b"\0" * 4 + text.encode()
        for i in range(4, len(data)):
            for k in (0, 1, 2, 4):
                held = after.setdefault(data[i - k : i], {})
                held[data[i]] = held.get(data[i], 0) + times

    def p(gram):
        out = 1 / 256
        for k in (0, 1, 2, 4):
            held = after.get(gram[4 - k : 4], {})
            if held:
                out = (held.get(gram[4], 0) + len(held) * out) / (sum(held.values()) + len(held))
        return out

    return p


def _check_scores(spark, texts, good):
    """texts: [(text, times)]; good: texts of the target model."""
    rows = [(i, t) for i, (t, times) in enumerate(texts) for _ in range(times)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1) for i in good], "doc_id bigint, quality int")
    back, target = witten_bell(dict(texts)), witten_bell({texts[i][0]: texts[i][1] for i in good})
    got = lm_score.scored(df, labels).distinct().collect()
    assert len(got) == len(texts)
    for row in got:
        data = b"\0" * 4 + texts[row.doc_id][0].encode()
        grams = [data[i - 4 : i + 1] for i in range(4, len(data))]
        wanted = sum(math.log2(back(g)) - math.log2(target(g)) for g in grams) / len(grams)
        assert row.score == pytest.approx(wanted, abs=1e-8)
        assert row.n_tokens == len(grams)


@pytest.mark.parametrize("hot", [0, 100])
def test_lm_looks_up_or_joins(spark, monkeypatch, hot):
    monkeypatch.setattr(lm_score, "HOT", hot)
    _check_scores(spark, [(PROSE, 2), (OTHER, 1), (ITEM, 3), ("short", 1), (PROSE.replace("e", "é"), 1)], [0, 2])


def test_lm_keeps_rare_five_grams(spark):
    # each five-gram of the second text is less than 1 / 2^22 of the corpus
    _check_scores(spark, [(PROSE * 60, 470), (OTHER, 1), (ITEM, 1)], [1])


def test_near_dup_edges(docs, nothing):
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == len(DOCS)
    found = {(r.doc_id, r.component_id, r.kept) for r in rows}
    assert {(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (7, 7, True)} <= found
    assert {(r.n_shingles > 0, r.component_id, r.kept) for r in rows if r.doc_id is None} == {
        (True, 1, True),
        (False, None, True),
    }
    assert near_dup.near_duplicates(nothing).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    got = {r.node: r.component for r in rows}
    assert len(rows) == len(got)
    assert all(got[i] == 0 for i in range(41))
    assert all(got[i] == 100 for i in range(100, 140))
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


URLS = [
    ("https://WWW.Example.COM/de/1?x#y", "www.example.com", "/de/1", "example.com/de/", "block"),
    ("http://a.example.net/en/2", "a.example.net", "/en/2", "example.net/en/", "allow"),
    ("http://a.example.net/fr/2", "a.example.net", "/fr/2", "net/", "block"),
    ("http://example.net", "example.net", "", None, "allow"),
    ("http://badnet/x", "badnet", "/x", None, "allow"),
    ("http://net/x", "net", "/x", "net/", "block"),
    ("x.org/fr/", "", "", None, "allow"),
    ("a://b.org/fr/?u=http://c.net/", "b.org", "/fr/", "org/fr/", "allow"),
    ("://?", "", "", None, "allow"),
    ("http://h.org?q/fr/", "h.org", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_urls(spark, labels):
    pages = spark.createDataFrame(
        [(i, u[0], "h", "m") for i, u in enumerate(URLS)], "page_id bigint, url string, host string, mean string"
    )
    none = labels.where("false")
    rows = sorted(url_filter.judge(pages, none).collect())
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [u[1:] for u in URLS]
    assert url_filter.judge(pages.where("false"), labels).count() == 0


def test_reputation_shrinks(spark):
    urls, quality_of = [], []
    for host, n, bad in (("a.bad.org", 40, 36), ("b.bad.org", 2, 2), ("c.bad.org", 0, 0), ("a.good.org", 40, 1), ("b.good.org", 1, 1)):
        for k in range(max(n, 1)):
            urls.append((len(urls), f"http://{host}/{k}"))
            if n:
                quality_of.append((len(urls) - 1, int(k >= bad), 0))
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    outcomes = spark.createDataFrame(quality_of, "doc_id bigint, quality int, toxic int")
    got = {r.host: (r.verdict, r.bad_share) for r in url_filter.judge(pages, outcomes).collect()}
    assert got["a.bad.org"][0] == "block" and got["a.good.org"][0] == "allow"
    assert got["b.good.org"][0] == "allow"  # one bad page of an otherwise good domain
    assert got["b.bad.org"][1] > got["c.bad.org"][1] > got["b.good.org"][1] * 0.5


def test_wrapper_takes_constant_parts_away(spark):
    def page(i, host="h.org"):
        return (i, f"http://{host}/{i}", f"<body><div>Top line of the site</div><div><p>Own text number {i}.</p></div><div>Last line</div></body>")

    rows = [page(i) for i in range(6)] + [page(3)] + [page(50, "few.org")]
    rows += [(None, "http://h.org/n", None), (60, None, "<p>no url</p>"), (61, "http://h.org/", "")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit(1))
    got = html_extract.extracted(df).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[2] == "Own text number 2."
    assert texts[50].split("\n\n") == ["Top line of the site", "Own text number 50.", "Last line"]
    assert texts[None] == texts[61] == "" and texts[60] == "no url"
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extracted(df.where("false")).count() == 0


def test_wrapper_holds_the_nodes_of_all_pages(spark):
    def page(i):
        return f"<body><div class=top>Top line of the site</div><p>{OTHER} Own text number {i}.</p></body>"

    # the smallest ids of the host are empty, null, and an error page; one page is very deep
    rows = [(0, ""), (1, None), (2, "<h1>Not found</h1>"), *((i, page(i)) for i in range(3, 12))]
    rows.append((12, "<div>" * 3000 + "deep"))
    df = spark.createDataFrame([(i, "http://h.org/", h) for i, h in rows], "page_id bigint, url string, html string")
    texts = {r.page_id: r.text for r in html_extract.extracted(df).collect()}
    assert texts[5] == f"{OTHER} Own text number 5."
    assert texts[0] == texts[1] == "" and texts[2] == "Not found" and texts[12] == "deep"


def _extract(spark, pages):
    """Blocks of the pages of one host."""
    rows = [(i, "http://h.org/", p) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text.split("\n\n") for r in html_extract.extracted(df).collect()}


def _paragraphs(name, n=8):
    return [f"{name} says {k} things about {name}{k * k} and then some more." for k in range(n)]


def _page(i, blocks, box="div"):
    """A page with template around the blocks and a menu of links of its own."""
    body = "".join(f"<p>{b}</p>" for b in blocks)
    menu = f"<ul><li><a href=x>menu {i}</a></ul>"
    return f"<body>{menu}<div class=t>Welcome to the site</div><{box}>{body}</{box}><div class=u>Bye</div></body>"


@pytest.mark.parametrize("others", [1, 2, 7])
@pytest.mark.parametrize("copies", [2, 3, 9])
def test_copies_of_an_article_are_no_template(spark, copies, others, box="div"):
    same = _paragraphs("Anna")
    pages = [_page(i, [f"Edition {i}", *same], box) for i in range(copies)]
    pages += [_page(copies + i, _paragraphs(f"Person{i}"), box) for i in range(others)]
    got = _extract(spark, pages)
    for i in range(copies):
        assert [b for b in got[i] if b.startswith("Anna")] == same
    for i in range(others):
        assert [b for b in got[copies + i] if b.startswith("Person")] == _paragraphs(f"Person{i}")
    if others == 7:  # enough variety to know the template
        assert "Bye" not in got[copies + 1] and "Bye" not in got[0]


def test_copies_of_a_declared_article_are_no_template(spark):
    test_copies_of_an_article_are_no_template(spark, 9, 2, "article")


def test_template_in_a_declared_article(spark):
    pages = [_page(i, _paragraphs(f"Person{i}"), "article").replace("<article>", "<article><p>Read our news</p>") for i in range(5)]
    pages = [p.replace("<div class=t>", "<main><div class=t>").replace("</body>", "</main></body>") for p in pages]
    got = _extract(spark, pages)
    for i in range(5):
        assert got[i] == _paragraphs(f"Person{i}")
    # the declared article holds template only
    pages = [f"<article>Read our news</article><div>{' '.join(_paragraphs(f'Person{i}'))}</div>" for i in range(5)]
    got = _extract(spark, pages)
    assert got[2] == [" ".join(_paragraphs("Person2"))]


def test_names_and_forms_around_the_page(spark):
    inner = "".join(f"<p>{b}</p>" for b in _paragraphs("Anna"))
    side = "<div class=sidebar>More of it</div>"
    got = _extract(spark, [f"<body class=with-sidebar><form id=f>{inner}{side}</form></body>"])
    assert got[0] == _paragraphs("Anna")


def test_stages_on_awkward_rows(spark, docs, nothing, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = [
        pipeline.quality_rules,
        pipeline.line_dedup_stage,
        pipeline.near_dup_stage,
        pipeline.decontamination_stage,
    ]
    for stage in stages:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert out.count() <= len(DOCS)
        assert stage(spark, nothing, str(tmp_path)).count() == 0
    assert pipeline.bpe_stage(spark, docs, str(tmp_path)).count() == len(DOCS)


CLASHING = ["shard", "shard_name", "slot", "_clean", "_left", "row", "text_", "clean_text", "left_text", "kept", "body"]


def test_names_that_clash(spark, benchmark, tmp_path):
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(i, t, *CLASHING) for i, t in DOCS]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, {extra}")
    for stage in (pipeline.quality_rules, pipeline.line_dedup_stage):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert {tuple(r)[2:] for r in out.collect()} == {tuple(CLASHING)}
    assert sharding.write_shards(docs, f"{tmp_path}/out", ["a", "b"]) == "shard_"
    written = spark.read.parquet(f"{tmp_path}/out")
    assert written.count() == len(DOCS) and {r["shard"] for r in written.collect()} == {"shard"}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_ids_with_several_texts_keep_all_links(spark, parts):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (5, f"{a} more"), (6, f"{b} more"), (7, c), (9, f"{c} more"), (9, f"{a} else"), (12, "alone")]
    docs = spark.createDataFrame(rows[:: 1 if parts < 7 else -1], "doc_id bigint, text string").repartition(parts)
    got = near_dup.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, 12 if i == 12 else 1) for i, _ in rows)
    assert {r.doc_id for r in got if r.kept} == {1, 12}
