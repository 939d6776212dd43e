"""The HTML pass: one parse per page, all HTML-derived raw columns.

Spark has no HTML tree functions, so this is the single place where Python runs:
``mapInArrow`` hands each task Arrow batches of ``(keys..., html)`` and gets back
Arrow batches of the raw fields. Everything that can be native (JSON fields,
defaults, slug, front matter, cleanup, joins) happens after it in Spark.

Tree recovery for sloppy HTML follows a small, fixed rule set: void elements
have no children; a block-level start tag closes an open ``p``; a new ``li``
closes the open ``li`` of the same list; an end tag closes everything above
its matching open element; unmatched end tags are ignored; nothing is reopened.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import unquote_plus

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from folio.functions.text import SHORT_PAGE_MAX_CHARS
from folio.session import HTML_SLICE_BYTES

# --- fixed values -----------------------------------------------------------
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen",
             "link", "meta", "param", "source", "track", "wbr"}
P_CLOSING_TAGS = {"address", "article", "aside", "blockquote", "details", "div", "dl",
                  "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
                  "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol",
                  "p", "pre", "section", "table", "ul"}
SCOPE_TAGS = {"applet", "caption", "html", "table", "td", "th", "marquee", "object",
              "template", "button"}
LIST_SCOPE_TAGS = SCOPE_TAGS | {"ul", "ol"}
WS = " \t\n\x0b\x0c\r"
# Interactive page furniture removed from the body by the ``clean`` option
# (tag, class token): share popups, subscribe widgets, share buttons, post footer.
CLEAN_SELECTORS = [("div", "share-dialog"), ("div", "subscribe-widget"), ("div", "subscribe-footer"),
                   ("p", "button-wrapper"), ("div", "post-footer")]
# ---------------------------------------------------------------------------

_URL_RX = re.compile(r"^[ \t\n\x0b\x0c\r]*(?i:https?|ftp)://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)")
_BAD_PCT = re.compile(r"%(?![0-9A-Fa-f]{2})")
_TRAIL_WS = re.compile(r"[ \t\n\x0b\x0c\r]+$")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag, attrs):
        self.tag = tag
        self.attrs = attrs
        self.children = []


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node(None, {})
        self.stack = [self.root]
        self.open = Counter()    # open elements by tag: most lookups end here
        # open p and a (li) since the innermost scope (list scope) element: a lookup never
        # walks to a scope's edge in vain, so deep pages take linear time
        self.scopes, self.list_scopes = [Counter()], [0]

    @staticmethod
    def _attrs(attrs):
        d = {}
        for k, v in attrs:
            if k not in d:
                d[k] = "" if v is None else v
        return d

    def _push(self, node):
        tag = node.tag
        self.stack.append(node)
        self.open[tag] += 1
        if tag in LIST_SCOPE_TAGS:
            self.list_scopes.append(0)
            if tag in SCOPE_TAGS:
                self.scopes.append(Counter())
        elif tag == "li":
            self.list_scopes[-1] += 1
        elif tag in ("p", "a"):
            self.scopes[-1][tag] += 1

    def _pop_to(self, i):
        for n in reversed(self.stack[i:]):
            tag = n.tag
            self.open[tag] -= 1
            if tag in LIST_SCOPE_TAGS:
                self.list_scopes.pop()
                if tag in SCOPE_TAGS:
                    self.scopes.pop()
            elif tag == "li":
                self.list_scopes[-1] -= 1
            elif tag in ("p", "a"):
                self.scopes[-1][tag] -= 1
        del self.stack[i:]

    def _close_in_scope(self, tag):
        if not (self.list_scopes[-1] if tag == "li" else self.scopes[-1][tag]):
            return
        i = len(self.stack) - 1
        while self.stack[i].tag != tag:
            i -= 1
        self._pop_to(i)

    def handle_starttag(self, tag, attrs):
        if tag in P_CLOSING_TAGS:
            self._close_in_scope("p")
        elif tag == "li":
            self._close_in_scope("li")
        elif tag == "a":         # anchors never nest
            self._close_in_scope("a")
        node = Node(tag, self._attrs(attrs))
        self.stack[-1].children.append(node)
        if tag not in VOID_TAGS:
            self._push(node)

    def handle_startendtag(self, tag, attrs):
        if tag in P_CLOSING_TAGS:
            self._close_in_scope("p")
        self.stack[-1].children.append(Node(tag, self._attrs(attrs)))

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        st = self.stack
        for i in range(len(st) - 1, 0, -1):
            if st[i].tag == tag:
                self._pop_to(i)
                return

    def handle_data(self, data):
        ch = self.stack[-1].children
        if ch and isinstance(ch[-1], str):
            ch[-1] = ch[-1] + data
        else:
            ch.append(data)


def parse_html(html: str) -> Node:
    b = _TreeBuilder()
    b.feed(html)
    b.close()
    return b.root


def iter_elements(node: Node):
    """Elements below ``node`` in document (pre-)order."""
    stack = list(reversed(node.children))
    while stack:
        n = stack.pop()
        if isinstance(n, Node):
            yield n
            stack.extend(reversed(n.children))


def node_text(node: Node) -> str:
    out = []
    stack = list(reversed(node.children))
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            out.append(n)
        else:
            stack.extend(reversed(n.children))
    return "".join(out)


def image_local_path(src):
    """Python twin of ``folio.functions.image_local_path`` (U4); it is needed
    inside the pass because the path is part of the Markdown text."""
    if src is None or not src.strip(WS):
        return None
    s = src
    i = s.rfind("/https%3A")
    if i >= 0:
        tail = s[i + 1:]
        if _BAD_PCT.search(tail):
            return None
        s = unquote_plus(tail, encoding="utf-8", errors="replace")
    m = _URL_RX.match(s)
    if not m:
        return None
    host, path = m.group(1), _TRAIL_WS.sub("", m.group(2))
    if len(path) < 1:
        return None
    return host + "/" + path[1:]


def url_slug(url):
    """Python twin of ``folio.functions.url_slug`` (U1), for the filter of known ids only:
    the exact decision is made on the column."""
    m = _URL_RX.match(url) if url else None
    return next((x for x in reversed(_TRAIL_WS.sub("", m.group(2)).split("/")) if x), None) if m else None


def _first(node, tag):
    for e in iter_elements(node):
        if e.tag == tag:
            return e
    return None


def _figure(node, content, child_imgs, errors):
    img = _first(node, "img")
    src = img.attrs.get("src") if img is not None else None
    if src is None:
        return "", child_imgs
    cap_node = _first(node, "figcaption")
    caption = node_text(cap_node) if cap_node is not None else ""
    alt = img.attrs.get("alt", "")
    title = img.attrs.get("title", "")
    local = image_local_path(src)
    if local is None:          # V7: drop the unusable image, keep the page
        errors[0] += 1
        return "", child_imgs
    md = "\n![%s](%s \"%s\")\n" % (alt or caption, local, title)
    if caption:
        md += "*" + caption + "*\n"
    return md, [(src, alt, title, caption, local)] + child_imgs


def _finish(node, c, imgs, errors):
    t = node.tag
    if t == "figure":
        return _figure(node, c, imgs, errors)
    if t == "p":
        return "\n" + c + "\n", imgs
    if t in ("h1", "h2", "h3"):
        return "\n" + "#" * int(t[1]) + " " + c + "\n", imgs
    if t in ("strong", "b"):
        return "**" + c + "**", imgs
    if t in ("em", "i"):
        return "*" + c + "*", imgs
    if t == "a":
        href = node.attrs.get("href")
        return "[%s](%s)" % (c, "null" if href is None else href), imgs
    if t == "li":
        return "* " + c + "\n", imgs
    if t in ("ul", "ol"):
        return "\n" + c, imgs
    if t == "hr":
        return "\n---\n", imgs
    if t == "blockquote":
        return "\n> " + c.replace("\n", "\n> ") + "\n", imgs
    return c, imgs


_END = object()


def to_markdown(children):
    """Markdown of a node list plus image records, iteratively (no
    recursion limit on deeply nested pages)."""
    errors = [0]
    top_parts, top_imgs = [], []
    stack = [(None, iter(children), top_parts, top_imgs)]
    while stack:
        node, it, parts, imgs = stack[-1]
        child = next(it, _END)
        if child is _END:
            stack.pop()
            if node is None:
                break
            md, own = _finish(node, "".join(parts), imgs, errors)
            stack[-1][2].append(md)
            stack[-1][3].extend(own)
        elif isinstance(child, str):
            parts.append(child)
        else:
            stack.append((child, iter(child.children), [], []))
    return "".join(top_parts), top_imgs, errors[0]


def _has_classes(node, *classes):
    toks = node.attrs.get("class", "").split()
    return all(c in toks for c in classes)


def remove_furniture(root: Node) -> None:
    """Drop the CLEAN_SELECTORS elements (and their subtrees) in place."""
    stack = [root]
    while stack:
        n = stack.pop()
        keep = []
        for c in n.children:
            if isinstance(c, Node) and any(c.tag == t and _has_classes(c, k) for t, k in CLEAN_SELECTORS):
                continue
            keep.append(c)
            if isinstance(c, Node):
                stack.append(c)
        n.children = keep


def count_images(root: Node) -> int:
    """Images that compiling would give: the figures with a usable source."""
    n = 0
    for e in iter_elements(root):
        if e.tag == "figure":
            img = _first(e, "img")
            n += img is not None and image_local_path(img.attrs.get("src")) is not None
    return n


def extract(html: str, parts: frozenset, known=None) -> dict:
    """All requested raw fields of one page (``clean`` in ``parts`` removes
    page furniture before the body is compiled). ``known``: asked for the id of the canonical
    link; a page that may be known is not compiled, but marked as ``deferred``."""
    root = parse_html(html)
    if "clean" in parts:
        remove_furniture(root)
    out = {}
    canon = ld = title = author = published = None
    div_body = article = body = None
    links = []
    for e in iter_elements(root):
        t = e.tag
        if t == "link" and canon is None and e.attrs.get("rel") == "canonical":
            canon = e
        elif t == "script" and ld is None and e.attrs.get("type") == "application/ld+json":
            ld = e
        elif t == "title" and title is None:
            title = e
        elif t == "meta":
            if author is None and e.attrs.get("name") == "author":
                author = e
            if published is None and e.attrs.get("property") == "article:published_time":
                published = e
        elif t == "div" and div_body is None and e.children and _has_classes(e, "body", "markup"):
            div_body = e
        elif t == "article" and article is None and e.children:
            article = e
        elif t == "body" and body is None:
            body = e
        if t == "a" and "links" in parts and "href" in e.attrs:
            links.append({"pos": len(links), "href": e.attrs["href"],
                          "text": node_text(e).strip(WS)})
    if "meta" in parts:
        out["canonical_href"] = canon.attrs.get("href") if canon is not None else None
        out["ld_json"] = node_text(ld) if ld is not None else None
        ld_ok = True
        if ld is not None:
            try:
                json.loads(out["ld_json"]) if out["ld_json"].strip(WS) else None
            except ValueError:
                ld_ok = False
        out["ld_json_valid"] = ld_ok
        out["title_text"] = node_text(title) if title is not None else None
        out["meta_author"] = author.attrs.get("content") if author is not None else None
        out["meta_published"] = published.attrs.get("content") if published is not None else None
    if "body" in parts or "images" in parts:
        chosen, kind = ((div_body, "div.body.markup") if div_body is not None else
                        (article, "article") if article is not None else
                        (body, "body") if body is not None else (root, None))
        out["deferred"] = known is not None and canon is not None and known(url_slug(canon.attrs.get("href")))
        if out["deferred"]:
            out["body_kind"], out["n_images"] = kind, count_images(chosen)
            md = imgs = errs = None
        else:
            md, imgs, errs = to_markdown(chosen.children)
            out["n_images"] = len(imgs)
        if "body" in parts:
            out["body_kind"] = kind
            out["body_md"] = md
            out["image_errors"] = errs
        if "images" in parts and imgs is not None:
            out["images"] = [{"pos": i, "src": s, "alt": a, "title": ti, "caption": c,
                              "local_path": lp} for i, (s, a, ti, c, lp) in enumerate(imgs)]
    if "links" in parts:
        out["links"] = links
    if "short_body_text" in parts:
        # U13 looks at short pages only; without a body tag the page's own text stands in
        if len(html) >= SHORT_PAGE_MAX_CHARS:
            out["short_body_text"] = None
        elif body is not None:
            out["short_body_text"] = node_text(body)
        else:
            root.children = [c for c in root.children if not (isinstance(c, Node) and c.tag == "head")]
            out["short_body_text"] = node_text(root)
    return out


IMAGE_T = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("src", T.StringType()),
                        T.StructField("alt", T.StringType()), T.StructField("title", T.StringType()),
                        T.StructField("caption", T.StringType()),
                        T.StructField("local_path", T.StringType())])
LINK_T = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()),
                       T.StructField("text", T.StringType())])
DEFERRED_FIELDS = [("deferred", T.BooleanType()), ("n_images", T.IntegerType())]
PART_FIELDS = {
    "meta": [("canonical_href", T.StringType()), ("ld_json", T.StringType()),
             ("ld_json_valid", T.BooleanType()), ("title_text", T.StringType()),
             ("meta_author", T.StringType()), ("meta_published", T.StringType())],
    "body": [("body_kind", T.StringType()), ("body_md", T.StringType()),
             ("image_errors", T.IntegerType())],
    "images": [("images", T.ArrayType(IMAGE_T))],
    "links": [("links", T.ArrayType(LINK_T))],
    "short_body_text": [("short_body_text", T.StringType())],
}
ALL_PARTS = frozenset(PART_FIELDS)


def _by_bytes(batch, html_col: str, most: int = HTML_SLICE_BYTES):
    """A batch in runs of rows of about ``most`` bytes of HTML, so that large pages
    bound the worker's memory by bytes and not by rows."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(html_col)), 0).to_pylist()
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield batch.slice(lo)


def html_pass(pages: DataFrame, keys: list[str], html_col: str = "html",
              parts=ALL_PARTS, keep_html: bool = False, known=None, only=None) -> DataFrame:
    """Run the HTML pass over ``pages`` and return ``keys`` + raw fields
    (+ ``parse_error``). Only ``keys`` and ``html`` cross into Python; ``html``
    is dropped from the output unless ``keep_html``.

    ``known``: a ``KeyFilter`` of ids; pages it may hold are not compiled, and the columns
    ``deferred`` and ``n_images`` tell so. ``only``: (key column, ``KeyFilter``); rows whose
    key it does not hold are left out unparsed."""
    parts = frozenset(parts)
    data_parts = parts - {"clean"}
    src = pages.select(*keys, html_col)
    in_schema = src.schema
    fields = [f for f in in_schema.fields if keep_html or f.name != html_col]
    for p in sorted(data_parts):
        fields += [T.StructField(n, t) for n, t in PART_FIELDS[p]]
    extra = DEFERRED_FIELDS if known is not None else []
    fields += [T.StructField(n, t) for n, t in extra]
    fields.append(T.StructField("parse_error", T.StringType()))
    out_schema = T.StructType(fields)
    out_names = [f.name for f in fields]
    raw_names = [n for p in sorted(data_parts) for n, _ in PART_FIELDS[p]] + [n for n, _ in extra]
    passthrough = [f.name for f in in_schema.fields if keep_html or f.name != html_col]

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow_schema = to_arrow_schema(out_schema)
        for whole in batches:
            if only is not None:
                whole = whole.filter(pa.array([only[1](k) for k in whole.column(only[0]).to_pylist()], pa.bool_()))
            for batch in _by_bytes(whole, html_col):
                res = {n: [] for n in raw_names}
                errs = []
                for h in batch.column(html_col).to_pylist():
                    if h is None:
                        vals, err = {}, None
                    else:
                        try:
                            vals, err = extract(h, parts, known), None
                        except Exception as e:  # K7: the page is quarantined, the batch goes on
                            vals, err = {}, f"{type(e).__name__}: {e}"
                    for n in raw_names:
                        res[n].append(vals.get(n))
                    errs.append(err)
                arrays = []
                for n in out_names:
                    kind = arrow_schema.field(n).type
                    if n in passthrough:   # the batch's own column, never copied through Python
                        arrays.append(batch.column(n).cast(kind))
                    else:
                        arrays.append(pa.array(errs if n == "parse_error" else res[n], type=kind))
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    return src.mapInArrow(run, out_schema)
