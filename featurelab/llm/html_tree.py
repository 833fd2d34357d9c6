"""Pages as trees: tolerant parsing, label trees, and simple tree matching."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from html.parser import HTMLParser

#: Fixed values of the HTML standard: elements by how they affect structure.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
INVISIBLE = set("script style template noscript".split())
#: Stand inside a paragraph without ending it.
PHRASING = INLINE | INVISIBLE | set(
    "audio button canvas iframe map math object optgroup option picture select svg textarea video".split()
)
#: An element of the key ends an open element of its values, up to the nearest container.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
CONTAINERS = set("ul ol dl table tbody thead tfoot select div section article main body html".split())

#: Elements that are never part of an article.
FOREIGN = set(
    "head script style noscript template iframe svg canvas object nav footer aside form button "
    "select textarea dialog menu".split()
)
#: Words in class and id that name parts beside the article.
BESIDE = set(
    "nav navbar navigation menu footer sidebar ad ads advert advertisement adverts banner promo sponsor "
    "sponsored cookie cookies consent gdpr notice notices newsletter subscribe signup popup modal overlay "
    "breadcrumb breadcrumbs share sharing social comment comments respond reply replies disqus related "
    "recommended login search pagination pager toolbar masthead".split()
)
ROLES = set(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_parts = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+").findall


class Element:
    __slots__ = ("tag", "kids", "parent", "beside", "named", "article", "label", "place")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Element | None):
        self.tag = tag
        self.parent = parent
        self.kids: list[Element | str] = []
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        role = (attrs.get("role") or "").lower()
        self.label = f"{tag}.{'.'.join(sorted((attrs.get('class') or '').split()))}"
        self.article = tag in ("article", "main") or role in ("main", "article")
        sure = (
            (tag in FOREIGN and tag != "form")
            or role in ROLES
            or "hidden" in attrs
            or attrs.get("aria-hidden") == "true"
        )
        # beside only by a name or as a form: not if it holds most of the page
        self.named = not sure and (tag == "form" or any(p.lower() in BESIDE for p in _parts(names)))
        self.beside = sure or self.named
        self.place = -1  # number of its node in the label tree


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#page", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            self._end(CLOSES[tag], CONTAINERS)
        if tag not in PHRASING:  # a block ends an open paragraph
            self._end({"p"}, CONTAINERS | {"li", "td", "th", "blockquote", "dd"})
        element = Element(tag, dict(attrs), self.at)
        self.at.kids.append(element)
        if tag not in VOID:
            self.at = element

    def handle_startendtag(self, tag, attrs):
        # XML style; HTML closes only void elements that way
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._end({tag}, set())

    def handle_data(self, data):
        self.at.kids.append(data)

    def _end(self, tags: set[str], stop: set[str]) -> None:
        """Close the nearest open element among the tags, unless a stop tag lies nearer."""
        node = self.at
        while node.parent is not None:
            if node.tag in tags:
                self.at = node.parent
                return
            if node.tag in stop:
                return
            node = node.parent


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def elements(root: Element) -> Iterator[Element]:
    """All elements in page order, without recursion."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        waiting.extend(k for k in reversed(node.kids) if not isinstance(k, str))


def one_space(text: str) -> str:
    return " ".join(text.split())


def own_text(node: Element) -> str:
    return one_space(" ".join(k for k in node.kids if isinstance(k, str)))


def label_tree(root: Element) -> list:
    """The tree of labels as [label, children]: siblings of one label are one node.

    Nodes are numbered in order of creation, and every element gets the number of its node. The tree
    is as large as the variety of the page, not as its length.
    """
    tree: list = [root.label, []]
    index: dict[tuple[int, str], int] = {}
    nodes = [tree]
    root.place = 0
    for node in elements(root):
        if node.parent is None:
            continue
        key = (node.parent.place, node.label)
        if key not in index:
            index[key] = len(nodes)
            made: list = [node.label, []]
            nodes[node.parent.place][1].append(made)
            nodes.append(made)
        node.place = index[key]
    return tree


def numbering(root: Element, tree: list) -> list[int]:
    """Preorder number of every node of a label tree, by its order of creation."""
    order = {id(t): n for n, t in enumerate(preorder(tree))}
    by_place: dict[int, int] = {0: 0}
    nodes = {0: tree}
    for node in elements(root):
        if node.place not in nodes:
            parent = nodes[node.parent.place]
            nodes[node.place] = next(c for c in parent[1] if c[0] == node.label)
            by_place[node.place] = order[id(nodes[node.place])]
    return [by_place[i] for i in range(len(by_place))]


def preorder(tree: list) -> Iterator[list]:
    waiting = [tree]
    while waiting:
        node = waiting.pop()
        yield node
        waiting.extend(reversed(node[1]))


def packed(tree: list) -> str:
    """A label tree as flat JSON, however deep it is."""
    out, waiting = [], [(tree, 0)]
    while waiting:
        node, depth = waiting.pop()
        out.append([depth, node[0]])
        waiting.extend((k, depth + 1) for k in reversed(node[1]))
    return json.dumps(out)


def unpacked(text: str) -> list:
    path: list[list] = []
    for depth, label in json.loads(text):
        node: list = [label, []]
        del path[depth:]
        if path:
            path[-1][1].append(node)
        path.append(node)
    return path[0]


def depth_of(tree: list) -> int:
    deepest, waiting = 0, [(tree, 1)]
    while waiting:
        node, depth = waiting.pop()
        deepest = max(deepest, depth)
        waiting.extend((k, depth + 1) for k in node[1])
    return deepest


def match(a: list, b: list) -> dict[int, int]:
    """Simple tree matching: {preorder number in b: preorder number in a} of the largest matching.

    Roots match if their labels do; children match in order, by the dynamic program that makes the
    sum of their matchings largest.
    """
    number = [{id(t): n for n, t in enumerate(preorder(x))} for x in (a, b)]
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 2 * depth_of(b) + 1000))

    def best(x: list, y: list) -> tuple[int, list]:
        if x[0] != y[0]:
            return 0, []
        rows, cols = len(x[1]), len(y[1])
        sums = [[0] * (cols + 1) for _ in range(rows + 1)]
        pairs: dict[tuple[int, int], list] = {}
        for i in range(1, rows + 1):
            for j in range(1, cols + 1):
                size, inner = best(x[1][i - 1], y[1][j - 1])
                top = max(sums[i - 1][j], sums[i][j - 1])
                if size and sums[i - 1][j - 1] + size > top:
                    top = sums[i - 1][j - 1] + size
                    pairs[i, j] = inner
                sums[i][j] = top
        found = [(number[1][id(y)], number[0][id(x)])]
        i, j = rows, cols
        while i and j:
            if sums[i][j] == sums[i - 1][j]:
                i -= 1
            elif sums[i][j] == sums[i][j - 1]:
                j -= 1
            else:
                found += pairs[i, j]
                i, j = i - 1, j - 1
        return sums[rows][cols] + 1, found

    return dict(best(a, b)[1])


def merged(a: list, b: list) -> list:
    """The label tree `a` with the nodes of `b` that match none of its own, each behind its left neighbour."""
    if a[0] != b[0]:
        raise ValueError("trees of different roots")
    pairs = match(a, b)
    out = [[t[0], []] for t in preorder(a)]  # nodes of a, in preorder
    number = {id(t): n for n, t in enumerate(preorder(a))}
    for n, t in enumerate(preorder(a)):
        out[n][1] = [out[number[id(k)]] for k in t[1]]
    own = {id(t): n for n, t in enumerate(preorder(b))}
    for t in preorder(b):
        if own[id(t)] not in pairs:
            continue
        kids, at = out[pairs[own[id(t)]]][1], 0
        for k in t[1]:
            if own[id(k)] in pairs:
                there = out[pairs[own[id(k)]]]
                at = next(i for i, x in enumerate(kids) if x is there) + 1
            else:
                kids.insert(at, k)
                at += 1
    return out[0]
