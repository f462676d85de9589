"""HTML extraction with site style trees.

The pages of a host are merged into one style tree: nodes are element paths
(tag and class), and each keeps how its pages present it (sequences of
children) and what they say in it.  Nodes that all pages present alike and
fill alike have a low importance and their branches are removed, wherever in
the page they stand.  In addition, elements that are navigation, notices,
forms and the like by their tag, role or class are removed on every page, as
most hosts have too few pages to show it.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .common import pieces

GAMMA = 0.9  # damping of a node's own presentation against its children
LOW = 0.5  # branches under this importance are removed: most of what they show, other pages of the host show too
LEAST_PAGES = 8  # different pages of a host that must show a node
DEEPEST = 24  # elements below this depth count as part of their ancestor there

# ---- page to blocks

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:@][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "template"}  # text up to the end tag
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul"}
NOISE_TAGS = RAW | {"head", "nav", "footer", "aside", "form", "button", "select", "option", "input", "label", "dialog", "menu", "svg", "canvas", "object", "audio", "video", "map"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "note"}
NOISE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "commentlist", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "form", "gdpr", "header", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "overlay", "pager", "pagination", "popup", "promo",
    "promotion", "recommended", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor",
    "sponsored", "subscribe", "subscription", "teaser", "toolbar", "topbar", "tracking", "widget"}
# Start tags that end an open element: tag -> tags they end, up to a container.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"}}
HOLDS = {"ul", "ol", "dl", "table", "article", "section", "main", "div", "body", "nav", "aside", "footer", "header", "form", "blockquote", "td", "th"}
ENDS_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "html", "body", "head"}
MAIN = {"article", "main"}


def _names(text: str) -> set[str]:
    spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", text)
    return set(re.findall(r"[a-z]+", spaced.lower()))


class Element:
    __slots__ = ("tag", "label", "depth", "path", "noise", "main", "children")

    def __init__(self, tag: str, attributes: str, up: Element | None):
        given = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
        css, role = given.get("class", ""), given.get("role", "").lower()
        self.tag = tag
        self.label = ".".join([tag, *sorted(set(css.split()))])
        self.depth = up.depth + 1 if up else 0
        self.path = self.label if up is None else up.path if self.depth > DEEPEST else f"{up.path}/{self.label}"
        within = up is not None and up.main
        self.main = within or tag in MAIN or role in ("main", "article")
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", given.get("style", "")) is not None
        named = tag not in ("html", "body", "article", "main") and bool(NOISE_WORDS & (_names(css) | _names(given.get("id", ""))))
        self.noise = (up is not None and up.noise) or tag in NOISE_TAGS or role in NOISE_ROLES or hidden or named or (tag == "header" and not within)
        self.children: list[str] = []


def blocks(page: str | None) -> tuple[list[tuple[Element, str]], list[Element]]:
    """The text blocks of a page with the block element that each stands in, and all elements, in page order.

    Text of an element that a rule removes makes blocks of its own, so that it
    does not part the text around it.
    """
    page = page or ""
    top = Element("", "", None)
    stack, every, out = [top], [top], []
    held: list[str] = []
    aside: list[str] = []  # text within removed elements
    at = 0

    def flush() -> None:
        if aside:
            text = _SPACE.sub(" ", "".join(aside)).strip()
            aside.clear()
            if text:
                out.append((last_aside, text))
        if held:
            text = _SPACE.sub(" ", "".join(held)).strip()
            held.clear()
            if text:
                out.append((stack[-1] if stack[-1].tag in BLOCK or len(stack) == 1 else next(e for e in reversed(stack) if e.tag in BLOCK or e is top), text))

    def close(count: int) -> None:
        del stack[len(stack) - count:]

    last_aside = top

    def hold(text: str) -> None:
        nonlocal last_aside
        if not stack[-1].noise:
            held.append(text)
        else:
            if stack[-1] is not last_aside and aside:
                block = _SPACE.sub(" ", "".join(aside)).strip()
                aside.clear()
                if block:
                    out.append((last_aside, block))
            last_aside = stack[-1]
            aside.append(text)

    size = len(page)
    while at < size:
        found = _TAG.search(page, at)
        piece = page[at:found.start() if found else size]
        if piece:
            hold(entities.unescape(piece))
        if found is None:
            break
        at = found.end()
        if found[1] is not None:
            hold(found[1])
        tag = (found[3] or found[6] or "").lower()
        if not tag:
            continue
        if found[2] or found[5]:  # an end tag
            if tag in BLOCK:
                flush()
            depth = next((k for k, e in enumerate(reversed(stack[1:]), 1) if e.tag == tag), 0)
            if depth and (tag in BLOCK or not any(e.tag in BLOCK for e in stack[len(stack) - depth + 1:])):
                close(depth)
            continue
        if tag in BLOCK:
            flush()
        if tag in ENDS_P:
            depth = next((k for k, e in enumerate(reversed(stack[1:]), 1) if e.tag == "p" or e.tag in HOLDS), 0)
            if depth and stack[-depth].tag == "p":
                close(depth)
        if tag in ENDS:
            depth = 0
            for k, e in enumerate(reversed(stack[1:]), 1):
                if e.tag in ENDS[tag]:
                    depth = k
                elif e.tag in HOLDS and e.tag not in ("td", "th") or e.tag == "table":
                    break
            if depth:
                close(depth)
        element = Element(tag, found[4] or found[7] or "", stack[-1])
        stack[-1].children.append(element.label)
        every.append(element)
        if tag in VOID or (found[4] or found[7] or "").rstrip().endswith("/") and tag not in BLOCK | RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        stack.append(element)
    flush()
    return out, every


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"


def host_of(url: Column) -> Column:
    """The host of an address in lower case, '' without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


# ---- style trees

_NODE = "array<struct<path: string, kind: string, feature: bigint>>"
_NODE_TYPE = pa.list_(pa.struct([("path", pa.string()), ("kind", pa.string()), ("feature", pa.int64())]))


def _signed(text: str) -> int:
    x = xxhash.xxh64_intdigest(text)
    return x - (1 << 64) if x >> 63 else x


def _observations(pages: list[str | None]) -> pa.Array:
    """What each page adds to its host's tree: child sequences ('style') and texts ('text') of all its nodes."""
    out = []
    for page in pages:
        found, every = blocks(page)
        rows = [{"path": e.path, "kind": "style", "feature": _signed("\n".join(e.children))} for e in every if e.children]
        rows += [{"path": e.path, "kind": "text", "feature": _signed(text)} for e, text in found]
        out.append(rows)
    return pa.array(out, _NODE_TYPE)


def _spread(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Entropy of `n` within the keys, in units of the logarithm of the node's pages (`pages`)."""
    total = F.sum("n")
    nats = F.log(total) - F.sum(F.col("n") * F.log("n")) / total
    return rows.groupBy(*keys).agg(F.when(F.max("pages") > 1, nats / F.log(F.max("pages"))).otherwise(0.0).alias("entropy"), F.max("pages").alias("pages"), F.count(F.lit(1)).alias("kinds"))


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, pages, importance) of every node of every host's tree.

    Importance as in site style trees: of a leaf, one less the mean entropy of
    its texts over the pages that show it; of an inner node, its presentation
    entropy and its children's mean importance, weighted 1 - g^l and g^l for
    l ways of presentation; 1 for a node of one page.  Copies of a page, under
    whatever address of the host, count once, so a story that a host shows
    again is no template.  Elements below DEEPEST count as part of their
    ancestor there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "html", 4 << 20):
                yield pa.RecordBatch.from_pydict({"host": piece.column("host"), "page": piece.column("page"), "rows": _observations(piece.column("html").to_pylist())})

    seen = pages.select(host_of(pages[url]).alias("host"), F.xxhash64(pages[html]).alias("page"), pages[html].alias("html")).mapInArrow(run, f"host string, page bigint, rows {_NODE}")
    each = cut(seen.select("host", "page", F.inline("rows")).distinct())  # one row for a page, node and feature
    shown = each.select("host", "path", "page").distinct().groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
    style = each.filter("kind = 'style'").groupBy("host", "path", "feature").agg(F.count(F.lit(1)).alias("n"))
    own = _spread(style.join(shown, ["host", "path"]), ["host", "path"]).select("host", "path", "pages", F.when(F.col("pages") > 1, F.col("entropy")).otherwise(1.0).alias("style"), F.col("kinds").alias("ways"))
    # A text that m pages of M share has entropy log m / log M.
    text = each.filter("kind = 'text'").groupBy("host", "path", "feature").agg(F.count(F.lit(1)).alias("n")).join(shown, ["host", "path"])
    shared = F.when(F.col("pages") > 1, F.least(F.log("n") / F.log("pages"), F.lit(1.0))).otherwise(0.0)
    says = text.groupBy("host", "path").agg((1 - F.avg(shared)).alias("says"), F.max("pages").alias("pages"))
    nodes = cut(own.join(says.withColumnRenamed("pages", "_p"), ["host", "path"], "full").select(
        "host", "path", F.coalesce("pages", "_p").alias("pages"), "style", "ways", "says", F.size(F.split("path", "/")).alias("depth")))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    done, below = None, None
    for depth in range(deepest, 0, -1):
        level = nodes.filter(F.col("depth") == depth)
        if below is not None:
            level = level.join(below, ["host", "path"], "left")
        else:
            level = level.withColumn("children", F.lit(None).cast("double"))
        parts = F.col("children").isNotNull().cast("int") + F.col("says").isNotNull().cast("int")
        inner = F.coalesce(F.try_divide(F.coalesce("children", F.lit(0.0)) + F.coalesce("says", F.lit(0.0)), parts), F.lit(1.0))
        damp = F.pow(F.lit(GAMMA), F.col("ways"))
        level = cut(level.select("host", "path", "pages", F.when(F.col("ways").isNull(), inner).otherwise((1 - damp) * F.col("style") + damp * inner).alias("importance")))
        below = level.select("host", F.substring_index("path", "/", depth - 1).alias("path"), "importance").groupBy("host", "path").agg(F.avg("importance").alias("children"))
        done = level if done is None else done.unionByName(level)
    return done if done is not None else nodes.select("host", "path", "pages", F.lit(1.0).alias("importance"))


def low_branches(tree: DataFrame, low: float = LOW, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, paths): nodes below html and body of low importance, on enough pages to tell."""
    depth = F.size(F.split("path", "/"))
    return tree.filter((F.col("importance") < low) & (F.col("pages") >= least_pages) & (depth > 3)).groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("paths"))


# ---- extraction

def _within(path: str, low: set[str] | frozenset[str]) -> bool:
    """Is the node, or one above it, among the low branches?"""
    while path:
        if path in low:
            return True
        path = path.rpartition("/")[0]
    return False


def extract(page: str | None, low: set[str] | frozenset[str] = frozenset()) -> tuple[str, int]:
    """The article of a page, blocks joined by line ends, and how many characters of the page stood in low branches.

    Removed are low branches and what a rule names; with an article or main
    element only what stands in one is kept.  The tree takes no more than half
    of a page's article: more of it is a story that other pages tell as well.
    """
    found, _ = blocks(page)
    known: dict[str, bool] = {}

    def is_low(e: Element) -> bool:
        if e.path not in known:
            known[e.path] = _within(e.path, low)
        return known[e.path]

    taken = sum(len(t) for e, t in found if is_low(e)) if low else 0
    kept = [(e, t) for e, t in found if not e.noise]
    inside = [(e, t) for e, t in kept if e.main]
    kept = inside or kept
    if taken:
        high = [(e, t) for e, t in kept if not is_low(e)]
        if not inside or 2 * sum(len(t) for _, t in high) >= sum(len(t) for _, t in kept):
            kept = high
    return "\n".join(t for _, t in kept), taken


def main_text(page: str | None, low: set[str] | frozenset[str] = frozenset()) -> str:
    """The article of a page: see `extract`."""
    return extract(page, low)[0]


def main_texts(pages: DataFrame, keep: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: id, url, text of the article, its code points, and the characters in low branches of the page.

    A null or empty page has an empty text; a null url or one without a host
    counts as host ''; repeated rows are extracted each, and count once in
    the tree.  Columns other than those named are not read.  Pages meet the
    low branches of their host in a join; hosts without any are not in it.
    """
    branches = cut(low_branches(style_tree(pages, url, html)))
    named = pages.select(host_of(pages[url]).alias("host"), pages[keep].alias("_id"), pages[url].alias("url"), pages[html].alias("_html"))
    placed = named.join(branches, "host", "left").select("_id", "url", "_html", F.coalesce("paths", F.array().cast("array<string>")).alias("paths"))

    kind = placed.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_html", 4 << 20):
                made = [extract(p, frozenset(low)) for p, low in zip(piece.column("_html").to_pylist(), piece.column("paths").to_pylist())]
                texts = [text for text, _ in made]
                yield pa.RecordBatch.from_pydict({
                    "_id": piece.column("_id"), "url": piece.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64()),
                    "n_low": pa.array([taken for _, taken in made], pa.int64())})

    return placed.mapInArrow(run, f"_id {kind}, url string, text string, n_chars long, n_low long").withColumnRenamed("_id", keep)
