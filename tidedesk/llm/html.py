"""Main text of web pages by site template removal.

Subtrees of elements are hashed (tag, attributes, content), counted per host over different pages,
and deleted where they recur on ``MIN_PAGES`` pages of the host, however many it has. Subtrees whose text is for
the most part links are hashed by shape too (tags and attributes without text), so a menu goes whose links differ
by page. Elements whose tag, class, id or role says that they are no article text (menus, headers, footers,
sidebars, adverts, notices, forms, comments, scripts, styles) go as well; a class or id says so as a whole name, not by one of its parts.
Inside an article or main element the same holds for containers (``INNER``)
with at most half of its text: boxes that recur go, a paragraph that many articles share stays. Of several
articles side by side the one with the most text is taken.

Defined cases: null or empty html gives empty text; broken markup is read as far as it makes sense
(unclosed elements end with their parent, a stray ``<`` is text); copies of one page count once, so
they cannot make their own text a template; pages without a host form one group (with templates of its own); repeated rows are
extracted one by one. Other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidedesk.session import materialize

#: A subtree is template when it stands on this many different pages of its host.
MIN_PAGES = 4
#: Template tables up to this many rows are broadcast (8 bytes a hash); of larger ones each page gets those it holds, by shuffle.
BROADCAST_ROWS = 1_000_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/<>]*)(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^'\"<>])*+)>|<[!?/][^<>]*>"
    r"|<(?P<loose_end>/?)(?P<loose>[A-Za-z][^\s/<>]*)[^<>]*>", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                 "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body article main section div table ul ol dl td th blockquote nav aside header footer form".split())

# What is no article text.
DROP_TAGS = frozenset(
    "head script style noscript template nav footer aside form button select textarea iframe svg object canvas dialog "
    "menu audio video".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social comment comments commentlist disqus "
    "respond reply replies related recommended recommendations widget toolbar pagination pager search skip "
    "contentinfo complementary dialog".split())
#: Parts that say nothing by themselves in a name like ``cookie-bar`` or ``site_footer``.
GLUE_WORDS = frozenset(
    "site page post posts bar box block list links link buttons button wrapper wrap container inner outer section area item items top "
    "bottom left right col column global main js is has primary secondary".split())
#: What can be template inside an article or main element.
INNER = frozenset("div section aside ul ol dl table figure details center fieldset".split())
#: What can be told by its shape where links are most of its text.
MENU = frozenset("div section aside ul ol dl table nav header footer center".split())
MAIN_WORDS = frozenset("article main content post entry story".split())


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str = "") -> None:
        self.tag, self.attrs, self.kids = tag, attrs, []

    def words(self) -> set[str]:
        """Words of the names in class, id and role; those of a name with other parts than ``DROP_WORDS`` and
        ``GLUE_WORDS`` stay joined, since such a part says what the element is about."""
        found: set[str] = set()
        if self.attrs:
            for m in _ATTR.finditer(self.attrs):
                name = m[1].lower()
                if name in ("class", "id", "role"):
                    for token in (m[2] or m[3] or m[4] or "").lower().split():
                        parts = _WORD.findall(token)
                        known = all(p in DROP_WORDS or p in GLUE_WORDS or p in MAIN_WORDS or p == "header" or p.isdigit() for p in parts)
                        found.update(parts if known else [token])
                elif name == "hidden":
                    found.add("dialog")
        return found


def parse(source: str) -> Node:
    """A lenient tree; text stays undecoded. Time is proportional to the page times its depth of open inline elements."""
    root = Node("#root")
    stack, at, n = [root], 0, len(source)
    while at < n:
        m = _TOKEN.search(source, at)
        text = source[at:m.start() if m else n]
        if text:
            stack[-1].kids.append(text)
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or m["loose"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["loose_end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE and tag not in SCOPE:
                    break
            continue
        attrs = m["attrs"] or ""
        if tag not in INLINE and tag not in VOID:
            closes = CLOSES_ITSELF.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE:
                    break
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        if tag in VOID or attrs.endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            node.kids.append(source[at:end.start() if end else n])
            at = end.end() if end else n
            continue
        stack.append(node)
    return root


def _is_main(node: Node) -> bool:
    return node.tag in ("article", "main") and not node.words() & {"comment", "comments", "reply", "replies"}


def subtree_hashes(root: Node) -> dict[int, int]:
    """Content hash by ``id(node)`` of every element that can be template; what holds a main element has none."""
    return {i: hs[0] for i, hs in all_hashes(root).items()}


def all_hashes(root: Node) -> dict[int, list[int]]:
    """Hashes by ``id(node)`` of every element that can be template: of its content, and for menus of its shape.

    Inside a main element these are containers with at most half of the text of the innermost one.
    """
    every: dict[int, int] = {}
    size: dict[int, int] = {}
    linked: dict[int, int] = {}
    shape: dict[int, bytes] = {}
    worded: set[int] = set()  # parts of a sentence are no template by themselves
    order: list[tuple[Node, Node | None]] = []
    todo: list[tuple[Node, Node | None]] = [(root, None)]
    while todo:
        node, main = todo.pop()
        order.append((node, main))
        inner = node if _is_main(node) else main
        below = [k for k in node.kids if isinstance(k, Node)]
        todo += [(k, inner) for k in below]
        if len(below) < len(node.kids) and any(isinstance(k, str) and k.strip() for k in node.kids):
            worded.update(id(k) for k in below if k.tag in INLINE)
    holds_main: set[int] = set()
    for node, _ in reversed(order):
        h = hashlib.blake2b(f"{node.tag}\x00{' '.join(node.attrs.split())}".encode("utf-8", "surrogatepass"), digest_size=8)
        size[id(node)] = linked[id(node)] = 0
        kinds: list[bytes] = []  # shapes of the children, a run of equal ones once
        for k in node.kids:
            if isinstance(k, Node):
                h.update(b"\x01" + every[id(k)].to_bytes(8, "little", signed=True))
                size[id(node)] += size[id(k)]
                linked[id(node)] += linked[id(k)]
                if kinds[-1:] != [shape[id(k)]]:
                    kinds.append(shape[id(k)])
            elif squeezed := " ".join(k.split()):
                h.update(b"\x02" + squeezed.encode("utf-8", "surrogatepass"))
                size[id(node)] += len(squeezed)
        if node.tag == "a":
            linked[id(node)] = size[id(node)]
        every[id(node)] = int.from_bytes(h.digest(), "little", signed=True)
        kept = "" if node.tag == "a" else " ".join(node.attrs.split())
        shape[id(node)] = hashlib.blake2b(f"{node.tag}\x00{kept}\x03".encode("utf-8", "surrogatepass") + b"".join(kinds), digest_size=8).digest()
        if _is_main(node) or any(id(k) in holds_main for k in node.kids if isinstance(k, Node)):
            holds_main.add(id(node))
    out: dict[int, list[int]] = {}
    for node, main in order:
        i = id(node)
        if node is not root and i not in holds_main and i not in worded and (main is None or node.tag in INNER and 2 * size[i] <= size[id(main)]):
            out[i] = [every[i]]
            # one link has the shape of any other: only lists of them tell a menu
            if node.tag in MENU and size[i] and 2 * linked[i] > size[i]:
                out[i].append(int.from_bytes(shape[i], "little", signed=True))
    return out


def _unwanted(node: Node, inside_main: bool) -> bool:
    if node.tag in DROP_TAGS or node.tag == "header" and not inside_main:
        return True
    words = node.words()
    if node.tag in ("html", "body", "main"):
        return False
    if node.tag == "article":
        return bool(words & {"comment", "comments", "reply", "replies"})
    return bool(words & DROP_WORDS) or "header" in words and not inside_main


def _recurs(node: Node, hashes: dict[int, list[int]], template: set[int]) -> bool:
    return any(h in template for h in hashes.get(id(node), ()))


def blocks(start: Node, hashes: dict[int, list[int]], template: set[int], inside_main: bool) -> list[str]:
    """Texts of the blocks below ``start`` in page order, decoded, white space squeezed."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(text)

    todo: list = [(start, inside_main)]
    while todo:
        item, inside = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            held.append(item)
        elif item.tag == "br":
            held.append(" ")
        elif item is not start and (_unwanted(item, inside) or _recurs(item, hashes, template)):
            if item.tag not in INLINE:
                flush()
        else:
            inside = inside or _is_main(item)
            block = item.tag not in INLINE
            if block:
                flush()
                todo.append((None, inside))
            todo += [(k, inside) for k in reversed(item.kids)]
    flush()
    return out


def _find(root: Node, hashes: dict[int, list[int]], template: set[int], want) -> list[Node]:
    """Topmost wanted elements in page order, not inside unwanted or template subtrees."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node is not root and (_unwanted(node, False) or _recurs(node, hashes, template)):
            continue
        if want(node):
            found.append(node)
        else:
            todo += [k for k in reversed(node.kids) if isinstance(k, Node)]
    return found


def main_text(source: str | None, template: set[int] = frozenset()) -> str:
    """Text of the largest article, else of main elements, else of what the page has left."""
    if not source:
        return ""
    root = parse(source)
    hashes = all_hashes(root)
    for want in (lambda n: n.tag == "article", lambda n: n.tag == "main" or "main" in n.words() and n.tag != "body",
                 lambda n: n.tag in ("div", "section") and n.words() & MAIN_WORDS):
        texts = [" ".join(blocks(n, hashes, template, True)) for n in _find(root, hashes, template, want)]
        if any(texts):
            return max(texts, key=len)
    return " ".join(blocks(root, hashes, template, False))


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def page_subtrees(pages: DataFrame) -> DataFrame:
    """``host, page, subtree``: the distinct subtrees of each page; ``page`` is a hash of its html."""

    def run(batches):
        for batch in batches:
            names, marks, sizes, found = batch.column(0), batch.column(1), [], []
            for source in batch.column(2):
                text = source.as_py()
                own = np.array(sorted({h for hs in all_hashes(parse(text)).values() for h in hs}) if text else [], np.int64)
                sizes.append(len(own))
                found.append(own)
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [names.take(at), marks.take(at), pa.array(np.concatenate([np.empty(0, np.int64), *found]))], ["host", "page", "subtree"])

    rows = pages.select(host(F.col("url")).alias("host"), F.xxhash64("html").alias("page"), "html")
    return rows.mapInArrow(run, "host string, page long, subtree long").distinct()


def site_templates(subtrees: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, subtree``: hashes of :func:`page_subtrees` that recur on ``min_pages`` pages of the host."""
    return subtrees.groupBy("host", "subtree").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages).select("host", "subtree")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    subtrees = page_subtrees(pages)
    templates = materialize(site_templates(subtrees, min_pages), "site-templates")
    named = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    if templates.count() <= BROADCAST_ROWS:
        by_host: dict[str, set[int]] = {}
        for r in templates.collect():  # bounded by the count above
            by_host.setdefault(r["host"], set()).add(r["subtree"])
        shared = pages.sparkSession.sparkContext.broadcast(by_host)

        def run(sources: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            known = shared.value
            for htmls, hosts in sources:
                yield pd.Series([main_text(h if isinstance(h, str) else None, known.get(x, frozenset()))
                                 for h, x in zip(htmls, hosts, strict=True)], dtype="object")

        texts = named.select("page_id", "url", F.pandas_udf(run, "string")("html", "host").alias("text"))
    else:
        # what a page holds of its host's templates: the array is as long as the page has elements, not as the host has templates
        held = subtrees.join(templates, ["host", "subtree"], "left_semi").groupBy(F.col("host").alias("_host"), F.col("page").alias("_page")).agg(
            F.collect_list("subtree").alias("subtrees"))
        joined = named.join(held, (F.col("host") == F.col("_host")) & (F.xxhash64("html") == F.col("_page")), "left")

        def each(sources: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for htmls, known in sources:
                yield pd.Series([main_text(h if isinstance(h, str) else None, frozenset() if t is None else frozenset(t.tolist()))
                                 for h, t in zip(htmls, known, strict=True)], dtype="object")

        texts = joined.select("page_id", "url", F.pandas_udf(each, "string")("html", "subtrees").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
