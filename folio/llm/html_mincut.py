"""Main text of HTML pages by minimum-cut labelling.

A page is cut into its text blocks. A linear classifier prices each block as content or
boilerplate (length, links, sentence ends, tag) and what its DOM ancestors say they are is
added; the price is the capacity to the terminals. The classifier is a logistic regression
fitted on the pages themselves: blocks inside article and main are examples of content, those
inside nav, aside, footer and the like of boilerplate. Names (class, id, role) speak against a
block only where the whole name is one of a part (``sidebar-left``, not ``tag-search`` or
``comments-open``), and never against main. Neighbours in page order and siblings in the
DOM are tied by smoothness edges. The minimum cut separates content from the rest.

Blocks whose price outweighs all their ties are decided at once (that keeps the cut minimal)
and their ties become prices of their neighbours; blocks of one or two ties are folded into
their neighbours and decided after them. Both take linear time; a greatest flow decides what is
left, which is nothing where siblings nest as elements do.

Results for odd input: null or empty html, or a page without content, gives an empty text;
unclosed tags, comments and quotes are read as browsers do, roughly; repeated rows are read
each; null ids and urls stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|select|iframe|title|annotation|annotation-xml)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>?"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-z][a-z0-9:-]*)([^>]*)>"
    r"|([^<]+|<)", re.DOTALL | re.IGNORECASE)
_NAMED = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_MAY_HIDE = re.compile(r"hidden|display", re.IGNORECASE)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_NAMES = re.compile(r"[a-z]+", re.IGNORECASE)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

BLOCKS = frozenset("""address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td
tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
AGAINST_TAGS = frozenset("nav footer aside form dialog menu button fieldset head".split())
FOR_TAGS = frozenset("article main".split())
AGAINST = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored sponsors promo promoted promotion
cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar sidenav side
widget widgets related recommended recommendations recommendation teaser teasers share sharing social follow comment comments
commentlist disqus discussion respond reply replies reviews menu nav navbar navigation breadcrumb breadcrumbs footer masthead
topbar toolbar pagination pager login search legal copyright disclaimer skip complementary contentinfo tags outbrain taboola""".split())
FOR = frozenset("content article articlebody post entry story main body text page".split())

#: What may stand beside such words in the name of a part.
BESIDE = frozenset("""a area areas bar bars block blocks body bottom box button buttons col column container content first fixed form global group
header heading holder icon icons inner item items last left line link links list lists main mobile module outer page panel post posts article
articles story stories entry primary region right row secondary section site slot small sticky sub text title top unit up wrap wrapper zone""".split())
#: Words against that are also subjects (``legal-article``) or, as an id, a heading's anchor.
SUBJECTS = frozenset("""alert banner discussion follow legal navigation notice notices promotion recommendation recommendations related reply
respond response reviews search share sharing side social tags""".split())

#: Price of a block: prior weights of its features (positive speaks for content) and what its
#: ancestors add. The text's part of a price stays within ``MOST``, so that what stands inside
#: an article is kept unless an ancestor speaks against it.
PRIOR = (-0.8, 2.4, -4.0, 0.8, 0.6)  # constant, length, links, sentence, heading
INSIDE, OUTSIDE, MIXED, MOST = 4.0, -7.0, -5.0, 3.5
NEXT, NEXT_SIBLING, SIBLING = 0.25, 0.9, 0.5

#: The fit reads about this many pages, drawn by a hash of page_id and url over all pages, and
#: brings one row for each of at most 520 cells of features to the driver.
FIT_PAGES = 20_000
LONG, LENGTHS, SHARES = 120.0, 12, 4

#: Parts of names that say which other parts a page has (``page-with-sidebar``), and parts
#: that a wrapper's name may list beside the content's (``content-sidebar-wrap``).
_HAS = re.compile(r"(?:^|[-_])(?:has|no|with|without)[-_].*", re.IGNORECASE)
_LAYOUT = re.compile(r"[-_](?:layout|wrap|wrapper|container|page|site)$", re.IGNORECASE)
PARTS = frozenset("sidebar sidenav side nav navbar navigation menu header footer masthead topbar toolbar".split())
HARD, NAMED, WEAK = 4, 2, 1  # votes against: of tags and hidden elements, of names, of layout wrappers


class _Open:
    __slots__ = ("tag", "says", "inside", "outside", "node", "content")

    def __init__(self, tag, says, inside, outside, node, content):
        self.tag, self.says, self.inside, self.outside, self.node, self.content = tag, says, inside, outside, node, content


def _hidden(attributes: str) -> bool:
    """Does an element have the attribute hidden, aria-hidden=true or display:none?"""
    if not _MAY_HIDE.search(attributes):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).strip()
        if name == "hidden" and value.lower() != "false" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


def _words(token: str) -> set[str]:
    return set(_NAMES.findall(_CAMEL.sub(" ", token).lower()))


def _says(tag: str, attributes: str, inside: bool) -> tuple[int, int]:
    """1 if an element names itself content, -1 boilerplate, 0 neither; and the kind of a
    vote against. The page itself (html, body) says neither."""
    if tag == "html" or tag == "body":
        return 0, 0
    if tag in AGAINST_TAGS or (tag == "header" and not inside) or (attributes and _hidden(attributes)):
        return -1, HARD
    names: set[str] = set()
    kind = 0
    if attributes:
        for found in _NAMED.finditer(attributes):
            is_id = found[0][:2].lower() == "id"
            if is_id and tag in ANCHORED:
                continue
            for token in (found[1] or found[2] or found[3] or "").split():
                words = _words(_HAS.sub("", token))
                names |= words
                if tag == "main" or tag in FOR_TAGS and not (words and words <= OWN):
                    continue
                if not _is_part(token, words, inside):
                    continue
                if is_id and inside and words & AGAINST <= SUBJECTS:
                    continue
                layout = _LAYOUT.search(token) and (words & FOR or token.lower().endswith("layout")) and words & AGAINST <= PARTS
                kind |= WEAK if layout else NAMED
    if kind:
        return -1, NAMED if kind & NAMED else WEAK
    return (1 if tag in FOR_TAGS or names & FOR else 0), 0


def _is_part(token: str, words: set[str], inside: bool) -> bool:
    """Is a name that of a part of the page which is not its main text?"""
    against = words & AGAINST or ("header" in words and not inside and words)
    if not against or not words <= AGAINST | BESIDE | PARTS:
        return False
    head = _NAMES.findall(_CAMEL.sub(" ", token).lower())[-1]
    return not (head in FOR and against <= SUBJECTS)


ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p pre".split())  # their ids are anchors into the text
#: Names that make a part of an article element.
OWN = frozenset("ad ads advert advertisement comment comments reply teaser related sponsored promo widget recommended".split())


class Features(NamedTuple):
    """Features of a block's text: length and share of links in steps, sentence, heading."""

    length: int
    share: int
    sentence: int
    heading: int


def values(f: Features) -> tuple[float, ...]:
    return 1.0, f.length / LENGTHS, f.share / SHARES, float(f.sentence), float(f.heading)


class Block:
    """A text block: ``says`` is what its ancestors add to its price, ``label`` whether their
    tags alone tell it content (1) or boilerplate (0), else None."""

    __slots__ = ("text", "features", "says", "label", "parent")

    def __init__(self, text, features, says, label, parent):
        self.text, self.features, self.says, self.label, self.parent = text, features, says, label, parent

    def price(self, weights) -> float:
        # links do not speak against what an article holds
        f = self.features if self.label != 1 else self.features._replace(share=0)
        score = sum(w * x for w, x in zip(weights, values(f), strict=True))
        return max(-MOST, min(MOST, score)) + self.says


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    nodes = 1
    stack = [_Open("", 0, False, 0, 0, False)]
    depth: dict[str, int] = {}
    pieces: list[str] = []
    links: list[str] = []
    in_link = 0

    def flush():
        nonlocal pieces, links
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                top = stack[-1]
                linked = len(" ".join(unescape("".join(links)).split())) if links else 0
                content = top.content and not top.outside
                features = Features(int(LENGTHS * min(1.0, len(text) / LONG)), round(SHARES * min(1.0, linked / len(text))),
                                    int(text[-1] in ".!?…\"'”»:"), int(top.tag in ("h1", "h2", "h3", "blockquote", "pre")))
                says = OUTSIDE if top.says < 0 else MIXED if top.outside else INSIDE if top.inside else 0.0
                label = 1 if content else 0 if top.outside & HARD else None
                parent = stack[-2].node if len(stack) > 1 and top.tag in ("p", "li", "td", "th", "dd", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "pre") else top.node
                out.append(Block(text, features, says, label, parent))
            pieces, links = [], []

    for token in _TOKEN.finditer(html):
        text = token[8]
        if text is not None:
            pieces.append(text)
            if in_link:
                links.append(text)
            continue
        tag = token[3] or token[6]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), token[2] or token[5], token[4] or token[7] or ""
        if tag == "a":
            in_link = 0 if closing else 1
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in BLOCKS:
            continue
        flush()
        in_link = 0 if tag != "li" else in_link
        if closing:
            if depth.get(tag):
                while True:
                    top = stack.pop()
                    depth[top.tag] -= 1
                    if top.tag == tag:
                        break
            continue
        if tag in VOID or attributes.endswith("/") and tag in VOID:
            continue
        while len(stack) > 1 and (stack[-1].tag == "p" or (stack[-1].tag == tag and tag in ("li", "dt", "dd", "option", "tr", "td", "th"))):
            depth[stack.pop().tag] -= 1
        top = stack[-1]
        says, kind = _says(tag, attributes, top.inside)
        outside = top.outside
        if says > 0 and tag in FOR_TAGS:  # what wraps the main part of a page only names its layout
            outside &= HARD if tag == "main" else ~WEAK
        stack.append(_Open(tag, says or (-1 if top.says < 0 and tag not in FOR_TAGS else 0 if not top.inside else top.says), top.inside or says > 0, outside | kind, nodes,
                           top.content or (says > 0 and tag in FOR_TAGS)))
        nodes += 1
        depth[tag] = depth.get(tag, 0) + 1
    flush()
    return out


def ties(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: page neighbours, and the next sibling in the DOM."""
    edges, last = [], {}
    for i, block in enumerate(found):
        before = last.get(block.parent)
        if i:
            edges.append((i - 1, i, NEXT_SIBLING if before == i - 1 else NEXT))
        if before is not None and before != i - 1:
            edges.append((before, i, SIBLING))
        last[block.parent] = i
    return edges


def minimum_cut(price: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the side of content in a cut of least cost: a node on the
    other side pays its positive price, one on this side its negative, an edge that is cut
    its weight."""
    price = list(price)
    near: list[dict[int, float]] = [{} for _ in price]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * len(price)
    folded: list[tuple[int, float, dict[int, float]]] = []
    out = [False] * len(price)
    work = deque(range(len(price)))
    while work:
        i = work.popleft()
        if out[i]:
            continue
        if abs(price[i]) >= sum(near[i].values()):
            side[i] = price[i] > 0
            for j, w in near[i].items():
                price[j] += w if side[i] else -w
        elif len(near[i]) <= 2:
            folded.append((i, price[i], near[i]))
            _fold(i, price, near)
        else:
            continue
        out[i] = True
        for j in near[i]:
            del near[j][i]
            work.append(j)
    left = [i for i, gone in enumerate(out) if not gone]
    if left:
        for i, s in zip(left, _augment(price, near, left), strict=True):
            side[i] = s
    for i, p, tied in reversed(folded):
        side[i] = p + sum(w if side[j] else -w for j, w in tied.items()) > 0
    return side


def _fold(i: int, price: list[float], near: list[dict[int, float]]) -> None:
    """What a block of one or two ties costs at its best, as prices of its neighbours and a
    tie between them (exact: the least over a block's side is again a cost of that form)."""
    p, tied = price[i], list(near[i].items())
    if len(tied) == 1:
        (a, w), = tied
        price[a] += max(-w, min(w, p))
        return
    (a, wa), (b, wb) = tied
    none, only_a, only_b, both = min(0.0, wa + wb - p), min(wa, wb - p), min(wb, wa - p), min(wa + wb, -p)
    tie = max(0.0, (only_a + only_b - none - both) / 2)
    price[a] -= only_a - none - tie
    price[b] -= only_b - none - tie
    if tie:
        near[a][b] = near[b][a] = near[a].get(b, 0.0) + tie


LEAST = 1e-12  # flow and capacities below this count as none


def _augment(price, near, left) -> list[bool]:
    """Greatest flow from all content nodes to all others, by rounds of blocking flows on
    the levels of a breadth-first search (exact)."""
    rest = {i: dict(near[i]) for i in left}
    supply = {i: price[i] for i in left}
    while True:
        sources = [i for i in left if supply[i] > LEAST]
        level = dict.fromkeys(sources, 0)
        queue, reached = deque(sources), False
        while queue:
            i = queue.popleft()
            reached |= supply[i] < -LEAST
            for j, w in rest[i].items():
                if w > LEAST and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not reached:
            return [i in level for i in left]
        ways = {i: list(rest[i]) for i in level}
        for source in sources:
            path = [source]
            while path and supply[source] > LEAST:
                i = path[-1]
                if supply[i] < -LEAST:
                    steps = list(zip(path, path[1:], strict=False))
                    flow = min(supply[source], -supply[i], *(rest[a][b] for a, b in steps))
                    supply[source] -= flow
                    supply[i] += flow
                    for a, b in steps:
                        rest[a][b] -= flow
                        rest[b][a] = rest[b].get(a, 0.0) + flow
                    full = next((k for k, (a, b) in enumerate(steps) if rest[a][b] <= LEAST), len(path) - 1)
                    del path[full + 1:]
                    continue
                while ways[i] and not (rest[i][ways[i][-1]] > LEAST and level[ways[i][-1]] == level[i] + 1):
                    ways[i].pop()
                if ways[i]:
                    path.append(ways[i][-1])
                else:
                    path.pop()
                    if path:
                        ways[path[-1]].pop()


def main_text(html: str | None, weights: tuple[float, ...] = PRIOR) -> str:
    found = blocks(html or "")
    keep = minimum_cut([b.price(weights) for b in found], ties(found))
    return "\n\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many labelled blocks have which features."""
    counts: Counter = Counter()
    for batch in batches:
        for html in batch.column(0):
            counts.update((*b.features, b.label) for b in blocks(html.as_py() or "") if b.label is not None)
    if counts:
        columns = [pa.array(c, pa.int32()) for c in zip(*counts, strict=True)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], names=[*Features._fields, "label", "n"])


def fit(pages: DataFrame) -> tuple[float, ...]:
    """Weights of the classifier, from blocks whose tags tell what they are; the prior where
    one of both kinds is missing. Copies of a page are drawn or left together."""
    rows = pages.count()
    draw = F.xxhash64("page_id", "url").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    drawn = pages.filter(draw < F.lit(min(1.0, FIT_PAGES / max(1, rows)))).select("html")
    cells = drawn.mapInArrow(_cells, "length int, share int, sentence int, heading int, label int, n long") \
        .groupBy(*Features._fields, "label").agg(F.sum("n").alias("n")).collect()
    return regression([(Features(*r[:4]), r["label"], r["n"]) for r in sorted(cells)])


def regression(cells: list[tuple[Features, int, int]]) -> tuple[float, ...]:
    """Logistic regression over counted cells, both labels of equal weight, drawn to the prior
    (ridge); Newton's method."""
    of = [sum(n for _, label, n in cells if label == k) for k in (0, 1)]
    if not all(of):
        return PRIOR
    x = np.array([values(f) for f, _, _ in cells])
    y = np.array([float(label) for _, label, _ in cells])
    weight = np.array([FIT_WEIGHT * n / of[label] for _, label, n in cells])
    prior = np.array(PRIOR)
    w = prior.copy()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + (w - prior)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), slope)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(round(float(v), 6) for v in w)


#: Weight of all examples of a label beside the prior's.
FIT_WEIGHT = 50.0


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; no shuffle but the cells of the fit."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    weights = fit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), weights) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
