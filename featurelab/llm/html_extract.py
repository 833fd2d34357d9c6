"""HTML extraction by wrapper induction over the pages of a host.

Every page is parsed into a tree. The distinct label trees of all pages of a host, merged by simple tree
matching, are its wrapper; every page of the host is aligned with it by the same matching. Texts that at
least `CONSTANT` percent of the host's distinct articles have at the same node of the wrapper are template;
nodes whose text varies are slots. Copies of one article count once: pages count by marks that copies
share, and only what is the same over `LEAST_PAGES` or more marks can be template. A page with less than `OWN`
percent of text of its own counts as a copy, so the template of pages that hold hardly anything else stays.
The article is what the slots hold, without the parts that are no article by kind: menus, page headers,
footers, sidebars, notices, adverts, forms, comments, scripts and styles, told by element, role, class and
id. A class, an id or a form does not make an element such a part that holds most of the text of a page
without declared article. Where a page declares its article (`article`, `main`), only the slots in it count,
unless all it holds is template.

Blocks are divided by block elements; white space in a block becomes one space, and blocks are
joined by an empty line. Character references are decoded. Nothing is cut.

A null or empty page has an empty text, and neither lends to the wrapper nor counts for the template.
Pages without host form a host of their own, with less than `LEAST_PAGES` distinct articles there is no
template. Repeated rows are extracted each and count as one page for the template; rows with a null id are
like others. Trees are merged in a fixed order, by hash, so the layout of the table does not matter. An
empty table gives an empty result. Only id, url and page are read, so columns with clashing names do not
matter.

Pages are not moved: wrappers and templates are broadcast while they fit in `BROADCAST_BYTES`, beyond
that they are joined by host. The counts behind the templates are aggregated before the shuffle.
"""

from __future__ import annotations

import json

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm.common import BROADCAST_IDS, read, ship, tidy
from featurelab.llm.html_tree import (
    HEADINGS,
    INLINE,
    INVISIBLE,
    Element,
    elements,
    label_tree,
    match,
    merged,
    numbering,
    one_space,
    own_text,
    packed,
    parse,
    unpacked,
)
from featurelab.llm.url_filter import host_of
from featurelab.sources.scratch import stage

CONSTANT = 50  # percent of the distinct articles of a host
LEAST_PAGES = 3
OWN = 20  # percent of a page's text that is its own, if it is no copy
MARKS = 3
BROADCAST_BYTES = 32_000_000
MAX_ALIGNED = 2_000  # alignments kept in a worker
MERGERS = 64  # parts of a host whose trees are merged side by side


class Page:
    def __init__(self, html: str | None):
        self.root = parse(html)
        for node in elements(self.root):  # what holds the article does not stand beside it
            if node.article and not node.beside:
                above = node.parent
                while above is not None:
                    above.beside = False
                    above = above.parent
        self.articles = self._articles()
        if not self.articles:
            self._free_containers()

    def _free_containers(self) -> None:
        """A name or a form does not put the element beside the article that holds most of the text."""
        sizes: dict[int, int] = {}  # characters outside links and sure parts beside the article
        for node in reversed(list(elements(self.root))):
            if node.tag == "a" or (node.beside and not node.named):
                continue
            size = len(own_text(node))
            sizes[id(node)] = size + sum(sizes.get(id(k), 0) for k in node.kids if not isinstance(k, str))
        for node in elements(self.root):
            if node.named and 2 * sizes.get(id(node), 0) > sizes[id(self.root)]:
                node.beside = False

    def _articles(self) -> list[Element]:
        """The outermost declared articles that do not stand in a part beside the article."""
        found, waiting = [], [self.root]
        while waiting:
            node = waiting.pop()
            if node.beside:
                continue
            if node.article:
                found.append(node)
                continue
            waiting.extend(k for k in reversed(node.kids) if not isinstance(k, str))
        return found

    def aligned(self, wrapper: str | None, memo: dict) -> dict[int, int]:
        """{place in this page: node of the wrapper}"""
        tree = label_tree(self.root)
        if not wrapper:
            return {}
        pairs = aligned(wrapper, packed(tree), memo)
        return {place: pairs[n] for place, n in enumerate(numbering(self.root, tree)) if n in pairs}

    def candidates(self) -> list[tuple[Element, bool]]:
        """Elements outside the parts beside the article, and whether in a link."""
        found, waiting = [], [(self.root, False)]
        while waiting:
            node, linked = waiting.pop()
            if node.beside:
                continue
            linked = linked or node.tag == "a"
            found.append((node, linked))
            waiting.extend((k, linked) for k in reversed(node.kids) if not isinstance(k, str))
        return found

    def described(self) -> tuple[str, list[int], list[int], list[int]]:
        """Label tree; number of the node, hash and length of every text that may be template.

        The text of links has no length: menus do not tell copies of an article apart.
        """
        tree = label_tree(self.root)
        number = numbering(self.root, tree)
        nodes, hashes, lengths = [], [], []
        for node, linked in self.candidates():
            text = own_text(node)
            if text:
                nodes.append(number[node.place])
                hashes.append(text_hash(text))
                lengths.append(0 if linked else len(text))
        return packed(tree), nodes, hashes, lengths

    def text(self, wrapper: str | None, template: set[tuple[int, int]], memo: dict) -> str:
        places = self.aligned(wrapper, memo) if template else {}
        if self.articles:
            text, fixed = self._text_of(self.articles, places, template)
            if text or not fixed:
                return text
        # all that the declared elements hold is template: the slots are elsewhere
        return self._text_of([self.root], places, template)[0]

    def _text_of(
        self, starts: list[Element], places: dict[int, int], template: set[tuple[int, int]]
    ) -> tuple[str, bool]:
        """Text of the slots below the starts, and whether template was left out."""
        left_out = False
        blocks: list[str] = []
        parts: list[str] = []

        def flush() -> None:
            block = one_space("".join(parts))
            parts.clear()
            if block:
                blocks.append(block)

        def constant(node: Element) -> bool:
            return bool(
                template
                and node.place in places
                and (places[node.place], text_hash(own_text(node))) in template
            )

        for start in starts:
            flush()
            waiting: list = [(start, False)]
            while waiting:
                node, header = waiting.pop()
                if node is None:
                    flush()
                elif isinstance(node, str):
                    parts.append(node)
                elif node.beside:
                    if node.tag not in INLINE and node.tag not in INVISIBLE:
                        flush()
                elif header and node.tag not in HEADINGS:
                    waiting.extend((k, True) for k in reversed(node.kids) if not isinstance(k, str))
                elif node.tag == "header":  # only the headings of an article's own header
                    flush()
                    if starts is self.articles:
                        waiting.extend((k, True) for k in reversed(node.kids) if not isinstance(k, str))
                elif node.tag == "br":
                    parts.append(" ")
                else:
                    block = node.tag not in INLINE
                    if block:
                        flush()
                        waiting.append((None, False))
                    fixed = constant(node)
                    left_out = left_out or fixed
                    waiting.extend(
                        (k, False) for k in reversed(node.kids) if not (fixed and isinstance(k, str))
                    )
        flush()
        return "\n\n".join(blocks), left_out


def aligned(wrapper: str, tree: str, memo: dict) -> dict[int, int]:
    """{node of the tree: node of the wrapper}, both by preorder number"""
    key = (wrapper, tree)
    if key not in memo:
        if len(memo) >= MAX_ALIGNED:
            memo.clear()
        memo[key] = match(unpacked(wrapper), unpacked(tree))
    return memo[key]


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def _with(pages: DataFrame, more: DataFrame, size: int) -> DataFrame:
    """Pages with the columns of their host."""
    return pages.join(F.broadcast(more) if size <= BROADCAST_BYTES else more, "host", "left")


def _bytes(df: DataFrame, column: str) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(column) + 32), F.lit(0))).first()[0]


def described(pages: DataFrame) -> DataFrame:
    """(host, print, tree, nodes, hashes, lengths) of every page that holds something; pages: host, html.

    `tree` is the label tree; a text stands with the preorder number of its node.
    """

    def describe(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                rows = [(text_hash(h), *Page(h).described()) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.string()),
                        pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                        pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                        pa.array([r[4] for r in rows], pa.list_(pa.int32())),
                    ],
                    ["host", "print", "tree", "nodes", "hashes", "lengths"],
                )

    held = pages.where("html is not null and html != ''").select("host", "html")
    shape = "host string, print bigint, tree string, nodes array<int>, hashes array<bigint>, lengths array<int>"
    return stage(held.mapInArrow(tidy(describe), shape), "described_pages")


def wrappers(trees: DataFrame) -> DataFrame:
    """(host, wrapper) merged from the distinct (host, tree): by `MERGERS` parts of a host, then these.

    Rows are sorted, not gathered: a task holds one merged tree.
    """

    def merge(batches):
        at, tree = None, None
        for batch in batches:
            for host, part, more in zip(*(c.to_pylist() for c in batch.columns)):
                if at == (host, part):
                    tree = merged(tree, unpacked(more))
                    continue
                if at is not None:
                    yield one(at[0], tree)
                at, tree = (host, part), unpacked(more)
        if at is not None:
            yield one(at[0], tree)

    def one(host, tree):
        return pa.RecordBatch.from_arrays(
            [pa.array([host], pa.string()), pa.array([packed(tree)], pa.string())], ["host", "tree"]
        )

    for parts in (MERGERS, 1):
        rows = trees.distinct().select("host", F.pmod(F.xxhash64("tree"), F.lit(parts)).alias("part"), "tree")
        rows = rows.repartition("host", "part").sortWithinPartitions("host", "part", F.xxhash64("tree"), "tree")
        trees = stage(rows.mapInArrow(tidy(merge), "host string, tree string"), "wrappers")
    return trees.withColumnRenamed("tree", "wrapper")


def _short(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_IDS // 8 else df


def _constant(counts: DataFrame, column: str) -> DataFrame:
    """Rows (host, node, hash) that hold CONSTANT percent of what the host's pages count."""
    all_ = counts.where("node < 0").select("host", F.col(column).alias("all"))
    constant = counts.where("node >= 0").join(all_, "host")
    return constant.where((F.col("all") >= LEAST_PAGES) & (F.col(column) >= LEAST_PAGES)).where(
        100 * F.col(column) >= CONSTANT * F.col("all")
    )


def _marks(texts: DataFrame) -> DataFrame:
    """(host, print, m0, m1, ...): marks that copies of one article share.

    A mark is one text of the page, drawn by its hash with the chance of its length from the texts that
    the host's pages do not have in common; from all texts if the others are below OWN percent of
    the page, because then it differs from other pages no more than copies do.
    """
    own = F.when(F.col("common").isNull(), F.col("length")).otherwise(0)
    sums = [F.sum("length").alias("every"), F.sum(own).alias("own")]
    for s in range(MARKS):
        chance = (F.shiftrightunsigned(F.xxhash64(F.lit(s), "hash"), 11) + 1) / F.lit(2.0**53)
        drawn = F.struct((-F.log(chance) / F.col("length")).alias("at"), "hash")
        sums.append(F.min(drawn).alias(f"every{s}"))
        sums.append(F.min(F.when(F.col("common").isNull(), drawn)).alias(f"own{s}"))
    pages = texts.where("length > 0").groupBy("host", "print").agg(*sums)
    enough = 100 * F.col("own") >= OWN * F.col("every")
    return pages.select(
        "host",
        "print",
        *(F.when(enough, F.col(f"own{s}.hash")).otherwise(F.col(f"every{s}.hash")).alias(f"m{s}") for s in range(MARKS)),
    )


def templates(pages: DataFrame, wrapper: DataFrame, size: int) -> DataFrame:
    """(host, template): the constant texts as a JSON list of [node, hash]; pages as of `described`."""

    def align(batches):
        memo: dict = {}
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                at, found, hashes, lengths = [], [], [], []
                for n, row in enumerate(zip(*(part.column(i) for i in range(2, 7)))):
                    tree, nodes, texts, sizes, over = (v.as_py() for v in row)
                    pairs = aligned(over, tree, memo)
                    held = {(-1, 0): 0}  # node -1 counts the page itself
                    for x, text, size in zip(nodes, texts, sizes):
                        if x in pairs:
                            held[pairs[x], text] = max(held.get((pairs[x], text), 0), size)
                    for (node, text), size in held.items():
                        at.append(n)
                        found.append(node)
                        hashes.append(text)
                        lengths.append(size)
                where = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(where),
                        part.column(1).take(where),
                        pa.array(found, pa.int32()),
                        pa.array(hashes, pa.int64()),
                        pa.array(lengths, pa.int32()),
                    ],
                    ["host", "print", "node", "hash", "length"],
                )

    joined = _with(pages, wrapper, size).select("host", "print", "tree", "nodes", "hashes", "lengths", "wrapper")
    shape = "host string, print bigint, node int, hash bigint, length int"
    # repeated pages count once
    texts = stage(joined.mapInArrow(tidy(align), shape).distinct(), "texts")
    text = ["host", "node", "hash"]
    counts = texts.groupBy(*text).agg(F.count(F.lit(1)).alias("pages"))
    # a text with fewer pages than LEAST_PAGES has no more variety than these
    counts = stage(counts.where(F.col("pages") >= LEAST_PAGES), "counts")
    common = _constant(counts, "pages")
    common = stage(common.select(*text, F.lit(True).alias("common")), "common")
    pages_of = texts.join(_short(common), text, "left")
    marks = stage(_marks(pages_of.where("node >= 0")), "marks")
    # texts without length have no mark; the page itself counts where it has one
    held = texts.join(_short(counts.select(*text)), text).join(marks, ["host", "print"])
    variety = held.groupBy(*text).agg(*(F.count_distinct(f"m{s}").alias(f"m{s}") for s in range(MARKS)))
    variety = stage(variety, "variety")
    constant = variety
    for s in range(MARKS):
        constant = constant.join(_constant(variety, f"m{s}").select(*text), text, "left_semi")
    return stage(
        constant.groupBy("host").agg(
            F.to_json(F.collect_list(F.array(F.col("node").cast("long"), F.col("hash")))).alias("template")
        ),
        "templates",
    )


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    ship(pages.sparkSession)
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(
        host_of(F.col(url)).alias("host"),
        F.col(key).alias("id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
    )
    found = described(rows)
    wrapper = wrappers(found.select("host", "tree"))
    size = _bytes(wrapper, "wrapper")
    template = templates(found, wrapper, size)
    induced = stage(wrapper.join(template, "host"), "induced")
    more = _bytes(induced, "wrapper") + _bytes(induced, "template")

    def extract(batches):
        memo: dict = {}
        known: dict[str, set] = {}
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                texts = []
                for page, tree, fixed in zip(part.column(2), part.column(3), part.column(4)):
                    fixed = fixed.as_py()
                    if fixed and fixed not in known:
                        if len(known) >= MAX_ALIGNED:
                            known.clear()
                        known[fixed] = {(n, h) for n, h in json.loads(fixed)}
                    texts.append(
                        Page(page.as_py()).text(tree.as_py(), known[fixed] if fixed else set(), memo)
                    )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())], ["id", "url", "text"]
                )

    joined = _with(rows, induced, more).select("id", "url", "html", "wrapper", "template")
    out = joined.mapInArrow(tidy(extract), f"id {kind}, url string, text string")
    return out.select(
        F.col("id").alias(key),
        F.col("url").alias(url),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(read(spark, folder, "pages"))
