"""Parts of the text operators that need no Spark, against definitions and other libraries."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from featurelab.llm import bpe, decontaminate, html_extract, html_tree, lm_score, setsketch, sharding
from featurelab.llm import token_count

BLOB = open(public_tokenizers.path(bpe.VOCABULARY), "rb").read()
RANKS = bpe.parse_ranks(BLOB)
TEXTS = st.text(
    alphabet=st.one_of(st.sampled_from("ab the'sll  \n\t=-_019éß日本☃😀"), st.characters(codec="utf-8")),
    max_size=120,
)


@pytest.fixture(scope="module")
def tok():
    return bpe.Tokenizer(BLOB, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
    )


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_bpe_equals_library_and_round_trips(tok, reference, text):
    ids = tok.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert "".join(tok.decode(ids)) == text


@pytest.mark.parametrize("text", ["a" * 5000, "=" * 3001, " " * 4000, "ab" * 900, "日本" * 700, "\n" * 999])
def test_bpe_long_runs(tok, reference, text):
    assert tok.encode(text) == reference.encode_ordinary(text)


def test_bpe_states_may_be_dropped(reference):
    small = bpe.Tokenizer(BLOB, public_tokenizers.PATTERN)
    small.transducer.max_states = 20
    text = " ".join("".join(random.Random(i).choices("abcdefgh", k=9)) for i in range(200))
    assert small.encode(text) == reference.encode_ordinary(text)
    assert len(small.transducer.states) < 400


def test_bpe_makes_only_transitions_met_often(reference):
    own = bpe.Transducer(RANKS)
    rare = b" ofthedenea"
    for _ in range(3):
        assert list(own.encode_piece(rare)) == reference.encode_ordinary(rare.decode())
    assert len(own.states) == 1
    for _ in range(200):
        assert list(own.encode_piece(rare)) == reference.encode_ordinary(rare.decode())
    assert len(own.states) == len(rare) + 1  # in the end the whole way is made


def test_bpe_memo_is_bounded(reference):
    small = bpe.Tokenizer(BLOB, public_tokenizers.PATTERN, max_pieces=30)
    text = " ".join("".join(random.Random(i % 90).choices("abcdefgh", k=9)) for i in range(400))
    assert small.encode(text) == reference.encode_ordinary(text)
    assert len(small.memo) <= 30 and len(small.older) <= 30
    whole = bpe.tokenizer(BLOB, public_tokenizers.PATTERN)
    assert bpe.tokenizer(BLOB, public_tokenizers.PATTERN, 30).max_pieces == 30 != whole.max_pieces


def test_pairs_fit_exactly_if_they_stay_apart(tok):
    pick = random.Random(3)
    ids = list(tok.transducer.tokens)
    tok.encode("The transducer learns pairs of tokens from the words it reads, thereby and otherwise.")
    pairs = list(tok.transducer.pairs)[:500]
    pairs += [(pick.choice(ids), pick.choice(ids)) for _ in range(2000)]
    for left, right in pairs:
        both = tok.transducer.tokens[left] + tok.transducer.tokens[right]
        assert tok.transducer.fit(left, right) == (bpe.merge(both, RANKS) == [left, right])


@given(st.text(max_size=40), st.lists(st.integers(1, 5), max_size=60))
def test_utf8_stream_never_cuts_a_character(text, sizes):
    data, stream, out, at = text.encode("utf-8", "surrogatepass"), bpe.Utf8Stream(), [], 0
    for size in [*sizes, len(data)]:
        out.append(stream.push(data[at : at + size]))
        at += size
    out.append(stream.finish())
    assert bpe.encode_back("".join(out)) == data
    if all(not 0xD800 <= ord(c) < 0xE000 for c in text):
        assert "".join(out) == text


def test_utf8_stream_keeps_bytes_that_are_not_utf8():
    stream = bpe.Utf8Stream()
    out = stream.push(b"a\xff\xe2\x82") + stream.push(b"x\xf0\x9f") + stream.finish()
    assert bpe.encode_back(out) == b"a\xff\xe2\x82x\xf0\x9f"


@pytest.fixture(scope="module")
def unigram():
    model = open(public_tokenizers.path(token_count.MODEL), "rb").read()
    pieces = token_count.pieces_of(model)
    lowest = min(pieces.values())
    vocabulary = []
    for number, value in token_count.fields(model):
        if number == 1:
            parts = dict(token_count.fields(value))
            name = parts[1].decode()
            used = parts.get(3, 1) in (1, 6)
            vocabulary.append((name if used else f"\0{name}", pieces.get(name, 0.0) if used else lowest))
    library = tokenizers.Tokenizer(tokenizers.models.Unigram(vocabulary, 0, byte_fallback=True))
    return token_count.Counter(pieces), library


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_counts_equal_library(unigram, text):
    own, library = unigram
    wanted = len(library.encode("▁" + text.replace(" ", "▁")).tokens) if text else 0
    assert own.text(text)[0] == wanted


def test_count_ties_keep_the_piece_that_begins_first():
    pieces = {"a": -1.0, "b": -1.0, "ab": -2.0, "aba": -3.0, "▁": 0.0}
    assert token_count.Counter(pieces).text("ab") == (2, -2.0)  # ▁, ab: as good as ▁, a, b
    assert token_count.Counter(pieces).text("aba") == (2, -3.0)


def test_count_refuses_pieces_across_words():
    with pytest.raises(ValueError, match="blank"):
        token_count.Counter({"a▁b": 0.0})


def test_lookup_table_by_the_rule():
    names, size = [f"s{i}" for i in range(7)], 101
    orders = []
    for name in names:
        offset, skip = sharding.preference(name, size)
        orders.append([(offset + k * skip) % size for k in range(size)])
        assert sorted(orders[-1]) == list(range(size))
    wanted: dict[int, int] = {}
    turn = 0
    while len(wanted) < size:
        shard = turn % len(names)
        wanted[next(s for s in orders[shard] if s not in wanted)] = shard
        turn += 1
    table = sharding.fill(names, size)
    assert table == [wanted[s] for s in range(size)]
    held = np.bincount(table)
    assert held.max() - held.min() <= 1


def test_lookup_table_changes_little_when_a_shard_leaves():
    names = [f"s{i}" for i in range(20)]
    before, after = sharding.fill(names, 2003), sharding.fill(names[:-1], 2003)
    moved = sum(a != b for a, b in zip(before, after) if b != 19 and a != 19)
    assert moved < 0.1 * 2003


@pytest.mark.parametrize(("names", "size"), [(["a"], 100), ([], 7), (["a", "a"], 7), (list("abcdefgh"), 7)])
def test_lookup_table_refuses(names, size):
    with pytest.raises(ValueError, match="prime"):
        sharding.fill(names, size)


def _sets(*sets):
    elements = np.concatenate([np.array(sorted(s), np.uint64) for s in sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return setsketch.sketches(setsketch.mix(elements), owner, len(sets)).astype(int)


def test_sketches_merge_by_the_maximum():
    a, b = set(range(1, 300)), set(range(200, 900))
    one, two, both = _sets(a, b, a | b)
    assert (np.maximum(one, two) == both).all()


def test_sketches_do_not_depend_on_company_and_estimate_similarity():
    pick = random.Random(5)
    agree = []
    for trial in range(60):
        base = pick.sample(range(10**9), 500)
        a, b = set(base[:450]), set(base[50:])  # similarity 0.8
        first, second = _sets(a, b)
        assert (_sets(a)[0] == first).all()
        agree.append((first == second).mean())
        n = np.array([450])
        assert setsketch.passes(first[None], second[None], n, n, 0.8 - 0.18)[0]
        assert not setsketch.passes(first[None], second[None], n, n, 0.98)[0]
    assert abs(np.mean(agree) - 0.8) < 0.02


def test_sizes_alone_can_rule_out():
    same = np.zeros((1, setsketch.M), int)
    assert not setsketch.passes(same, same, np.array([10]), np.array([100]), 0.5)[0]


def _largest(a, b):
    """Size of the largest matching by trying all order-preserving choices."""
    if a[0] != b[0]:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), _largest(x[0], y[0]) + best(x[1:], y[1:]))

    return 1 + best(a[1], b[1])


TREES = st.recursive(
    st.builds(lambda t: [t, []], st.sampled_from("abc")),
    lambda kids: st.builds(lambda t, k: [t, k], st.sampled_from("abc"), st.lists(kids, max_size=3)),
    max_leaves=7,
)


@settings(max_examples=200, deadline=None)
@given(TREES, TREES)
def test_tree_matching_is_largest(a, b):
    pairs = html_tree.match(a, b)
    assert len(pairs) == _largest(a, b)
    assert len(set(pairs.values())) == len(pairs)


@settings(max_examples=200, deadline=None)
@given(TREES, TREES)
def test_merged_tree_holds_both(a, b):
    a, b = ["r", [a]], ["r", [b]]
    both = html_tree.merged(a, b)
    for tree in (a, b):
        assert len(html_tree.match(both, tree)) == len(list(html_tree.preorder(tree)))
    assert html_tree.unpacked(html_tree.packed(both)) == both


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header class="masthead">Site</header><nav><ul><li><a href=x>Home</a><li>About</ul></nav>
<div id="cookie-notice">We use cookies</div>
<article><header><h1>A &amp; title</h1><span>by me</span></header><p><b>One <i>two</i><br><p>three&nbsp;&quot;four&quot
<div class="ad">buy</div><form>mail <input></form><ul><li>x<li>y</ul><aside>side</aside>
<table><tr><td>c1<td>c2</table><section class="comments"><p>nice!</p></section>tail <script>1</script>end</article>
<div class="sidebar">More</div><footer>&copy; us</footer></body></html>"""


def test_article_text():
    page = html_extract.Page(PAGE)
    blocks = ["A & title", "One two", 'three "four"', "x", "y", "c1", "c2", "tail end"]
    assert page.text(None, set(), {}).split("\n\n") == blocks


def test_article_in_a_wrapper_named_like_a_sidebar():
    page = html_extract.Page('<div class="with-sidebar"><main><p>text</p></main><div class=menu>m</div></div>')
    assert page.text(None, set(), {}) == "text"


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<p", "<!-- open", "plain &lt; text", "</p></div>"])
def test_broken_pages(html):
    text = html_extract.Page(html).text(None, set(), {})
    assert text == ("plain < text" if html and "plain" in html else text)


def test_deep_page_needs_no_recursion():
    assert html_extract.Page("<div>" * 5000 + "deep").text(None, set(), {}) == "deep"


def test_question_and_answer():
    cut = decontaminate.question_and_answer
    assert cut("What is it? A stone.") == (["what", "is", "it"], ["a", "stone"])
    assert cut("one two three") == (["one", "two"], ["three"])
    assert cut("Is it?") == (["is"], ["it"])


def _index(items):
    words = [set(decontaminate.words_of(t)) for _, t in items]
    every = set().union(*words) if words else set()
    n = len(items)
    df = {w: sum(w in x for x in words) for w in every}
    idf = {w: np.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
    mean = sum(len(decontaminate.words_of(t)) for _, t in items) / n
    return decontaminate.Index(items, idf, mean)


def test_block_max_bounds_lose_nothing():
    pick = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "a"] * 60
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.randint(8, 40)))) for i in range(120)]
    index = _index(items)
    number = {w: n for w, n in index.number.items()}
    caught = 0
    for trial in range(150):
        words = pick.choices(vocabulary, k=pick.randint(0, 400))
        if trial % 3:
            at = pick.randint(0, len(words))
            leak = items[pick.randrange(120)][1].split()
            words[at:at] = leak[: len(leak) - trial % 4]
        wanted: dict[int, float] = {}
        for low in range(0, max(len(words), 1), index.step):
            passage = words[low : low + 2 * index.step]
            inside = {number[w] for w in passage if w in number}
            for i, (terms, shares) in enumerate(index.shares):
                score = sum(s for t, s in zip(terms.tolist(), shares.tolist()) if t in inside)
                if score >= decontaminate.THRESHOLD - 1e-9 and index.confirm(index.texts[i], passage):
                    wanted[index.items[i]] = max(wanted.get(index.items[i], 0), score)
        found = dict(index.hits(" ".join(words)))
        assert found == pytest.approx(wanted)
        caught += bool(found)
    assert caught > 30


def test_models_are_distributions():
    data = lm_score.ngrams("the cat sat on the mat") & 0xFFFFFF
    grams, counts = np.unique(data, return_counts=True)
    model = lm_score.Trigrams(grams, counts)
    for context in (0, ord("t") << 8 | ord("h"), 0x4142):
        every = (context << 8) + np.arange(256)
        assert model.probability(every).sum() == pytest.approx(1.0)


def test_ngram_numbers():
    assert lm_score.ngrams("ab").tolist() == [ord("a"), ord("a") << 8 | ord("b")]
    assert [hex(x) for x in lm_score.ngrams("abcdef")][-1] == "0x6263646566"
    assert len(lm_score.ngrams("é")) == 2


def test_a_changed_word_does_not_hide_a_leak():
    words = [f"w{i}" for i in range(40)]
    index = _index([(1, " ".join(words)), (2, "something else entirely, and not very long")])
    changed = [*words[:12], "other", *words[13:]]
    assert [i for i, _ in index.hits(f"before it {' '.join(changed)} and after")] == [1]
    assert index.hits(" ".join(words[:20])) == []  # half of it is no leak
    assert index.hits(" ".join(sorted(words))) == []  # the same words in another order neither
