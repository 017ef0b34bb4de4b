"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged by path: an element's path is its
ancestors' tags with their classes and ids (digits made alike), and with its
place among its likes where it is a div or section (from the ninth like on all
share one place, so that lists of any length have few paths). For each path of a host two
entropies are kept, over the pages that have it, equal pages counted once: of
its presentation, the sequence of its children's tags and pieces of text, and of
its content, the text below it. Both are divided by the log of the page count,
so 0 means the same on every page and 1 different on each. A path's importance is
(1 - GAMMA) * presentation + GAMMA * content. Branches of the whole page, menus
and footers as well as parts of the article, are of low importance where

* their content's entropy is under ``BAR``: the site repeats this text; or
* their importance is under ``FORM``, as that of a slot of fixed form is whatever
  it is filled with, while a neighbouring branch with at least as much text has
  an importance of ``MAIN`` or more.

Headings are never of low importance, running text inside a block never for its
form. Paths with fewer than ``MIN_PAGES`` pages on their host are judged by one
tree that all such pages share, whatever their host.

Roles settle what the tree leaves open. Tags, classes, ids and roles that say
menu, header, footer, sidebar, advert, notice, form, comment and the like remove
an element; within an article a name does so only if all of its parts say so, or
nothing (``share-bar``, not ``social-history``); article and main keep what they hold from being removed for its form,
and where a page has them, outside of all removed branches, its text is taken
from the outermost of them, else from the body. Scripts, styles and other silent
elements have no text. If low branches held all text, only roles are applied.

Any string is a page: the parser takes it in one pass, in time in proportion to its
length, and never fails on it (see ``Dom``). White space within a block becomes one space, blocks are joined by one space. A
page is parsed once to be counted and once to be read: keeping the parsed form
would write more than the pages themselves; the counted form is a few hashes a
path, written once. Statistics are counted by
aggregation over every page; of them only the low paths are joined back, a short
array for each host, broadcast while small and otherwise joined by host and a
salt of ``SALTS`` values, so that a large host is dealt over as many tasks.

Null html gives an empty text, null urls count as one host, texts of any length
are read whole, an empty table gives no rows. Repeated rows each get their text.
Columns of the input are kept; where one has the name of the new column, that
gets an underscore behind its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, free, packed, settle, unpacked
from .urlfilter import host

GAMMA = 0.5
BAR = 0.1
FORM = 0.6
MAIN = 0.7
MIN_PAGES = 10
BROADCAST_PATHS = 200_000
SALTS = 64

#: Elements without content, with content that is no text, and those that break lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe svg math object canvas audio video head title".split())
ROLE_TAGS = frozenset("nav header footer aside form button select textarea dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What opens inside these leaves an outer paragraph open.
_SCOPES = frozenset("table caption td th button template object".split())
_IN_P = frozenset("br caption dd dt head html body option tbody td tfoot th thead tr".split())
#: Parts of class names, ids and roles of what isn't the article.
ROLE_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice notification gdpr popup modal overlay "
    "newsletter subscribe subscription share sharing social related recommended recommendations comment comments disqus respond reply widget toolbar pagination pager skip login signup search form contentinfo complementary".split()
)
#: Parts of names that say nothing of what an element holds.
PLAIN_WORDS = frozenset("area bar block body bottom box btn button buttons col container content footer group head header icon inner item items left line link links list main outer panel right row section slot top unit wrap wrapper".split())
#: Flags of a path: it has elements below it, is a heading, stands inside an article, is no block.
INNER, HEADING, SHELTERED, INLINE = 1, 2, 4, 8
_PLACED = ("div", "section")
_PLACES = 8
_CUT = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"[0-9]+")
_STATS = ("page", "path", "parent", "style", "content", "flags", "chars")


def _hash(*parts) -> int:
    v = xxhash.xxh64_intdigest("\x00".join(map(str, parts)))
    return v - (1 << 64) if v >> 63 else v


def _is_role(tag: str, attrs: dict, within: bool = False) -> bool:
    """Whether tag and names say that an element isn't text. Within an article a name must say nothing else."""
    if tag in ROLE_TAGS:
        return True
    named = " ".join(filter(None, (attrs.get("class"), attrs.get("id"), attrs.get("role")))).lower()
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if not named or tag in ("html", "body", "main", "article"):
        return False
    if not within:
        return not ROLE_WORDS.isdisjoint(_CUT.split(named))
    for name in named.split():
        parts = set(filter(None, _CUT.split(name)))
        if not ROLE_WORDS.isdisjoint(parts) and parts <= ROLE_WORDS | PLAIN_WORDS:
            return True
    return False


class Node:
    __slots__ = ("children", "likes", "path", "role", "tag")

    def __init__(self, tag: str, path: int, role: bool) -> None:
        self.tag, self.path, self.role, self.children, self.likes = tag, path, role, [], None


_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_ATTR = re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_LONG = re.compile(r"&#([xX]?)0*([1-9A-Fa-f][0-9A-Fa-f]{8,});?|&#([xX]?)0{6,}([0-9A-Fa-f]*);?")
#: Elements whose content is text up to their end tag.
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in "script style textarea title xmp iframe noembed noframes".split()}


def _number(m: re.Match) -> str:
    """References of many digits: zeros in front go; beyond all code points they are the replacement character."""
    if m[2] and (m[1] or m[2].isdigit()):
        return "\ufffd"
    if m[4] and len(m[4]) < 9 and (m[3] or m[4].isdigit()):
        return f"&#{m[3]}{m[4]};"
    return "\ufffd" if m[4] is not None and not m[4] else m[0][:8]


def _decoded(text: str) -> str:
    if "&" not in text:
        return text
    return unescape(_LONG.sub(_number, text) if "&#" in text else text)


class Dom:
    """Builds Nodes from a page in one pass; children are Nodes and strings.

    Nothing in a page is an error, and every step moves on: a comment, declaration or
    tag without an end reaches to the end of the page, an attribute's quote that is
    never closed is no quote, an end tag without its start is nothing. Open tags are
    counted, and each open element knows whether a paragraph is open around it, so
    that the stack is only walked where it is cut.
    """

    def __init__(self) -> None:
        self.root = Node("", 0, False)
        self.stack: list[tuple[Node, bool]] = [(self.root, False)]
        self.open: dict[str, int] = {}

    def feed(self, html: str) -> None:
        at, end, quotes = 0, len(html), {'"': True, "'": True}
        while at < end:
            lt = html.find("<", at)
            if lt < 0:
                return self.text(html[at:])
            if lt > at:
                self.text(html[at:lt])
            mark = html[lt + 1 : lt + 2]
            if mark in ("!", "?"):
                stop = html.find("-->", lt + 2) + 2 if html.startswith("<!--", lt) else html.find(">", lt)
                if stop < lt:
                    return None
                at = stop + 1
            elif mark == "/":
                name = _NAME.match(html, lt + 2)
                stop = html.find(">", lt)
                if stop < 0:
                    return None
                if name:
                    self.close(name[0].lower())
                at = stop + 1
            elif name := _NAME.match(html, lt + 1):
                at, attrs, alone = self._attributes(html, name.end(), quotes)
                if at < 0:
                    return None
                tag = name[0].lower()
                self.start(tag, attrs, alone)
                if tag in RAW and not alone:
                    stop = RAW[tag].search(html, at)
                    self.text(html[at : stop.start() if stop else end], raw=tag in ("script", "style"))
                    at = stop.start() if stop else end
            else:
                self.text("<")
                at = lt + 1
        return None

    @staticmethod
    def _attributes(html: str, at: int, quotes: dict[str, bool]) -> tuple[int, dict[str, str], bool]:
        """(place behind the tag, or -1 where it has no end; its attributes; whether it closes itself)."""
        attrs: dict[str, str] = {}
        while True:
            gap = _GAP.match(html, at)
            at = gap.end()
            if at >= len(html):
                return -1, attrs, False
            if html[at] == ">":
                return at + 1, attrs, gap[0].endswith("/")
            name = _ATTR.match(html, at)
            at, value = name.end(), ""
            if equals := _EQUALS.match(html, at):
                at = equals.end()
                quote, close = html[at : at + 1], -1
                if quotes.get(quote):
                    close = html.find(quote, at + 1)
                    quotes[quote] = close >= 0  # once there is none, there is none further on
                if close >= 0:
                    value, at = html[at + 1 : close], close + 1
                else:
                    bare = _BARE.match(html, at)
                    value, at = bare[0], bare.end()
            attrs.setdefault(name[0].lower(), _decoded(value))

    def _cut(self, k: int) -> None:
        for node, _ in self.stack[k:]:
            self.open[node.tag] -= 1
        del self.stack[k:]

    def _cut_to(self, tag: str) -> None:
        k = len(self.stack) - 1
        while self.stack[k][0].tag != tag:
            k -= 1
        self._cut(k)

    def start(self, tag: str, attrs: dict[str, str], alone: bool) -> None:
        if self.stack[-1][1] and tag in BLOCKS and tag not in _IN_P:
            self._cut_to("p")
        top, in_p = self.stack[-1]
        named = _DIGITS.sub("0", " ".join(filter(None, (attrs.get("class"), attrs.get("id"))))) if attrs else ""
        place = 0
        if tag in _PLACED:
            top.likes = top.likes or {}
            place = top.likes[tag, named] = min(_PLACES, top.likes.get((tag, named), -1) + 1)
        within = bool(self.open.get("article") or self.open.get("main"))
        node = Node(tag, _hash(top.path, tag, named, place), tag in SILENT or _is_role(tag, attrs, within))
        top.children.append(node)
        if tag not in VOID and not alone:
            self.stack.append((node, tag == "p" or in_p and tag not in _SCOPES))
            self.open[tag] = self.open.get(tag, 0) + 1

    def close(self, tag: str) -> None:
        if self.open.get(tag):
            self._cut_to(tag)

    def text(self, data: str, raw: bool = False) -> None:
        self.stack[-1][0].children.append(data if raw else _decoded(data))


def parse(html: str | None) -> Node:
    dom = Dom()
    dom.feed(html or "")
    return dom.root


def _roots(root: Node, low: frozenset[int]) -> list[Node]:
    """The outermost articles, else mains, else bodies, else the page; none inside a removed branch."""
    found: dict[str, list[Node]] = {"article": [], "main": [], "body": []}
    stack = [(root, frozenset())]
    while stack:
        node, above = stack.pop()
        if node.role or node.path in low:
            continue
        if node.tag in found and node.tag not in above:
            found[node.tag].append(node)
            above = above | {node.tag}
        stack += [(c, above) for c in reversed(node.children) if isinstance(c, Node)]
    return found["article"] or found["main"] or found["body"] or [root]


def text_of(roots: list[Node], low: frozenset[int] = frozenset(), roles: bool = True) -> str:
    out: list[str] = []
    stack: list = list(reversed(roots))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.path not in low and not (x.role if roles else x.tag in SILENT):
            if x.tag in BLOCKS:
                out.append(" ")
                stack.append(" ")
            stack += reversed(x.children)
    return " ".join("".join(out).split())


def extract(html: str | None, low: frozenset[int] = frozenset(), roles: bool = True) -> str:
    """A page's text without its low paths; without roles by these paths alone."""
    root = parse(html)
    if not roles:
        return text_of([root], low, False)
    return text_of(_roots(root, low), low) or (text_of(_roots(root, frozenset())) if low else "")


def page_stats(html: str | None) -> list[tuple]:
    """The columns _STATS of each path of a page."""
    order: list[tuple[Node, int, bool]] = []
    stack = [(parse(html), 0, False)]
    while stack:
        node, parent, within = stack.pop()
        if node.tag in SILENT or node.tag in VOID:
            continue
        order.append((node, parent, within))
        within = within or (node.tag in ("article", "main") and not node.role)
        stack += [(c, node.path, within) for c in reversed(node.children) if isinstance(c, Node)]
    text: dict[int, tuple[int, int]] = {}
    paths: dict[int, list] = {}
    for node, parent, within in reversed(order):
        parts, kinds, chars, inner = [], [], 0, False
        for c in node.children:
            if isinstance(c, str):
                words = " ".join(c.split())
                if words:
                    parts.append(words)
                    kinds.append("#")
                    chars += len(words)
            else:
                kinds.append(c.tag)
                inner = inner or c.tag in BLOCKS and c.tag not in VOID
                if id(c) in text:
                    h, n = text[id(c)]
                    parts.append(h)
                    chars += n
        text[id(node)] = (_hash(*parts) if parts else 0, chars)
        flags = INNER * inner | HEADING * (node.tag in HEADINGS) | SHELTERED * within | INLINE * (node.tag not in BLOCKS)
        seen = paths.setdefault(node.path, [parent, [], [], 0, 0])
        seen[1] += [*kinds, "/"]
        seen[2].append(text[id(node)][0])
        seen[3] |= flags
        seen[4] += chars
    page = text[id(order[0][0])][0]
    return [(page, path, parent, _hash(*s), _hash(*c), flags, chars) for path, (parent, s, c, flags, chars) in paths.items() if path]


def _importance(seen: DataFrame, keys: list[str]) -> DataFrame:
    """keys, path, parent, m, flags, chars and the entropies style and content; seen: n rows of one value."""
    both = F.explode(F.array(F.struct(F.lit(0).alias("of"), F.col("style").alias("v")), F.struct(F.lit(1).alias("of"), F.col("content").alias("v"))))
    each = seen.select(*keys, "path", "parent", "flags", "chars", both.alias("x")).groupBy(*keys, "path", "x.of", "x.v")
    each = each.agg(F.count("*").alias("n"), F.min("parent").alias("parent"), F.bit_or("flags").alias("flags"), F.sum("chars").alias("chars"))
    sums = lambda k: F.sum(F.when(F.col("of") == k, F.col("n") * F.log("n")).otherwise(0.0))
    m = F.sum(F.when(F.col("of") == 0, F.col("n")).otherwise(0))
    by = each.groupBy(*keys, "path").agg(F.min("parent").alias("parent"), F.bit_or("flags").alias("flags"), m.alias("m"), sums(0).alias("s"), sums(1).alias("c"), (F.sum("chars") / 2).alias("chars"))
    entropy = lambda k: F.when(F.col("m") > 1, 1 - F.col(k) / F.col("m") / F.log("m")).otherwise(1.0)
    return by.select(*keys, "path", "parent", "m", "flags", (F.col("chars") / F.col("m")).alias("chars"), entropy("s").alias("style"), entropy("c").alias("content"))


def _low(trees: DataFrame, keys: list[str], sheltered: bool) -> DataFrame:
    """The rows of a tree's paths of low importance."""
    value = (1 - GAMMA) * F.col("style") + GAMMA * F.col("content")
    has = lambda f: F.col("flags").bitwiseAND(F.lit(f)) != 0
    rows = trees.withColumn("value", value)
    best = rows.where(has(INNER) & (F.col("value") >= MAIN)).groupBy(*keys, "parent").agg(F.max("chars").alias("most"))
    form = (F.col("value") < FORM) & (F.col("chars") <= F.col("most")) & ~has(INLINE) & (~has(SHELTERED) if sheltered else F.lit(True))
    low = (F.col("content") < BAR) | F.coalesce(form, F.lit(False))
    return rows.join(best, [*keys, "parent"], "left").where(low & ~has(HEADING))


def low_paths(pages: DataFrame, min_pages: int = MIN_PAGES, roles: bool = True) -> DataFrame:
    """host and low: each host's paths of low importance; pages: host and html."""

    def run(batches):
        for batch in batches:
            rows = [(h, *s) for h, html in zip(batch["site"], batch["html"]) for s in page_stats(html)]
            yield pd.DataFrame(rows, columns=["site", *_STATS])

    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("site", *_STATS)])
    sites = pages.select("host", F.xxhash64("host").alias("site"), "html")
    # written, since several aggregations start here and each would parse anew
    seen = settle(sites.select("site", "html").mapInPandas(run, schema).dropDuplicates(["site", "path", "page"]))
    own = settle(_importance(seen, ["site"]))
    few = own.where(F.col("m") < min_pages).select("site", "path")
    n_few = few.count()
    rest = seen.join(F.broadcast(few) if n_few <= BROADCAST_PATHS else few, ["site", "path"], "left_semi")
    wide = _low(_importance(rest, []).where(F.col("m") >= min_pages), [], roles)
    many = _low(own.where(F.col("m") >= min_pages), ["site"], roles).select("site", "path")
    low = many.unionByName(few.join(wide.select("path"), "path")).groupBy("site").agg(F.collect_set("path").alias("low"))
    return sites.select("host", "site").distinct().join(low, "site").select("host", "low")


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "text", broadcast_paths: int = BROADCAST_PATHS, roles: bool = True) -> DataFrame:
    """Adds ``out``, the main text of each page."""
    rows = pages.select(packed(pages).alias("row"), host(column(url_col)).alias("host"), column(html_col).alias("html"))
    low = settle(low_paths(rows, roles=roles))
    size = low.agg(F.coalesce(F.sum(F.size("low") + 1), F.lit(0))).first()[0]
    if size <= broadcast_paths:
        joined = rows.join(F.broadcast(low), "host", "left")
    else:
        dealt = low.select("host", "low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        salt = F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("salt", salt).join(dealt, ["host", "salt"], "left")

    def run(batches):
        for html, lows in batches:
            yield pd.Series([extract(h, frozenset() if x is None else frozenset(map(int, x)), roles) for h, x in zip(html, lows)])

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(run, T.StringType())
    read = joined.select("row", udf("html", "low").alias("found"))
    return read.select(*unpacked(read), F.col("found").alias(free(out, pages)))
