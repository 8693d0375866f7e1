"""Main text of web pages by composite text density.

1. The page is read into a tree, tolerant of unclosed and stray tags. Subtrees that are
   boilerplate by their tag (navigation, header, footer, aside, form, script, style ...)
   or by a word of their class, id or role (advert, comment, menu, notice ...) go; but a
   wrapper of the page's article, main or most of its text stays, without what is
   boilerplate inside it.
2. Every node gets its composite text density: characters per tag, scaled by how much
   of it is link text, and a density sum, the densities of its children added.
3. The body's descendant (or the body) with the largest density sum is the core; the
   threshold is the smallest density on its path from the body. Every node that reaches
   it contributes the subtree with the largest density sum below it.
4. The text of the chosen subtrees, block by block: references decoded, white space to
   one space, trimmed, blocks in page order joined by one space.

Defined cases: null, empty or textless html gives the empty string; a page without
<body> or <article> is treated as a body; text outside any tag counts as a block;
repeated rows and null ids are kept, one output row per input row; an empty table gives
no rows; extra columns are ignored. No part of a page is cut, whatever its length.
"""

from __future__ import annotations

import html as references
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, read_table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|math|select|object)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
    r"(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_HINTS = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
DROPPED_TAGS = frozenset(
    "head nav header footer aside form menu button input label fieldset dialog audio video canvas".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner comment comments "
    "disqus replies respond responses discussion menu nav navbar navigation breadcrumb breadcrumbs sidebar footer "
    "masthead notice notices cookie cookies consent gdpr popup modal newsletter subscribe subscription share sharing "
    "social related recommended widget toolbar pagination pager search login signup alert complementary "
    "contentinfo".split())
KEPT_TAGS = frozenset(["html", "body", "article", "main"])
NEVER_TEXT = frozenset("head button input audio video canvas".split())
WRAPPER_TAGS = frozenset("form fieldset label dialog".split())     # of the dropped tags, may hold a whole page
WRAPPED_CHARS = 200       # outside links, for a wrapper without article or main
# an element that a new one closes when it is still open
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("article body div section table ul ol dl td th main blockquote nav aside header footer form".split())


class Node:
    __slots__ = ("tag", "parent", "items", "dropped", "article", "chars", "tags", "link_chars", "link_tags", "density", "sum", "chosen")

    def __init__(self, tag, parent=None, dropped=False, article=False):
        self.tag, self.parent, self.items, self.dropped, self.chosen = tag, parent, [], dropped, False
        self.article = article      # an article or main that isn't a comment's, by its hints

    def children(self):
        return [x for x in self.items if type(x) is Node and not x.dropped]


def _boilerplate(tag: str, attributes: str) -> bool:
    return tag in DROPPED_TAGS or tag not in KEPT_TAGS and _hinted(attributes)


def _hinted(attributes: str) -> bool:
    for found in _HINTS.finditer(attributes):
        value = (found[1] or found[2] or found[3] or "").lower()
        if not DROPPED_WORDS.isdisjoint(_WORDS.findall(value)):
            return True
    return False


def parse(page: str) -> Node:
    """The body as a tree; text items are raw (references not yet decoded)."""
    root = Node("body")
    at, here = 0, root
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            here.items.append(page[at:token.start()])
        at = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in ("html", "body"):
            if not token[2]:
                here = root
            continue
        if token[2]:
            # close the nearest open element of that name; a stray end tag is ignored
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        if tag == "br" or tag in VOID:
            here.items.append(" " if tag in ("br", "hr") else "")
            continue
        closing = CLOSES.get(tag)
        if closing or tag in BLOCKS:
            node = here
            while node.parent is not None and node.tag not in SCOPES:
                if node.tag == "p" or closing and node.tag in closing:
                    here = node.parent
                node = node.parent
        node = Node(tag, here, _boilerplate(tag, token[4]), tag in ("article", "main") and not _hinted(token[4]))
        here.items.append(node)
        if not token[4].rstrip().endswith("/"):
            here = node
    if at < len(page):
        here.items.append(page[at:])
    return root


def _plain(root: Node) -> dict[Node, tuple[int, int, bool, int]]:
    """Of every node, dropped ones included: characters outside links, those of them in an
    article or main that shows, whether an article or main is in it, and those that show."""
    order, todo, out = [], [root], {}
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.items if type(x) is Node]
    for node in reversed(order):
        chars = 0 if node.tag in ("a", "button") else sum(len("".join(x.split())) for x in node.items if type(x) is str)
        shown, inside, visible = 0, node.article, chars
        for x in node.items:
            if type(x) is Node:
                own = out[x]
                if node.tag not in ("a", "button"):
                    chars += own[0]
                    if not x.dropped:
                        shown += own[1]
                        visible += own[3]
                inside = inside or own[2]
        out[node] = (chars, visible if node.tag in ("article", "main") else shown, inside, visible)
    return out


def _unwrap(root: Node) -> None:
    """Take back the drop of wrappers: while no article or main shows a tenth of the body's
    text outside links, the largest dropped node that contains one, else a hinted node or
    form with most of that text. What is dropped inside it stays so."""
    while True:
        plain = _plain(root)
        total, shown = plain[root][:2]
        if 10 * shown >= total:
            return
        best, todo = None, [root]
        while todo:
            for x in todo.pop().items:
                if type(x) is not Node:
                    continue
                if not x.dropped:
                    todo.append(x)
                elif x.tag not in NEVER_TEXT:
                    chars, _, inside, _ = plain[x]
                    wraps = inside or (x.tag not in DROPPED_TAGS or x.tag in WRAPPER_TAGS) and 2 * chars > total \
                        and chars >= WRAPPED_CHARS
                    if wraps and chars and (best is None or (inside, chars) > best[0]):
                        best = (inside, chars), x
        if best is None:
            return
        best[1].dropped = False


def _measure(root: Node) -> None:
    """Characters, tags and their link shares of every node, bottom up, then densities."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node.children()
    for node in reversed(order):
        chars = sum(len("".join(x.split())) for x in node.items if type(x) is str)
        tags = link_chars = link_tags = 0
        for x in node.children():
            chars += x.chars
            tags += x.tags + 1
            link_chars += x.link_chars
            link_tags += x.link_tags
        if node.tag in ("a", "button"):
            link_chars, link_tags = chars, link_tags + 1
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, link_chars, link_tags
    all_chars, all_links = max(root.chars, 1), root.link_chars
    for node in order:
        node.density = _density(node, all_links / all_chars)
    for node in reversed(order):
        node.sum = sum(x.density for x in node.children())


def _density(node: Node, link_share: float) -> float:
    """Characters per tag, times a logarithm whose argument shrinks with the links' share
    and whose base grows with it; nodes without text have none."""
    if not node.chars:
        return 0.0
    tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    plain = max(node.chars - node.link_chars, 1)
    base = math.log(node.chars / plain * node.link_chars + link_share * node.chars + math.e)
    ratio = node.chars / links * tags / link_tags
    per_tag = node.chars / tags
    if base <= 1.0000001:          # no links at all: the base's limit, plain density grows with the ratio
        return per_tag * math.log(ratio + math.e)
    return max(0.0, per_tag * math.log(max(ratio, 1.0)) / math.log(base)) if base > 1 else per_tag


def _largest(node: Node) -> Node:
    """The node with the largest density sum in a subtree, the upper one of equals."""
    best, todo = node, [node]
    while todo:
        x = todo.pop()
        if x.sum > best.sum:
            best = x
        todo += x.children()
    return best


def _choose(root: Node) -> None:
    core = _largest(root)
    threshold, node = core.density, core
    while node is not None:
        threshold = min(threshold, node.density)
        node = node.parent
    core.chosen = True
    todo = root.children() if core is not root else []
    while todo:
        node = todo.pop()
        if node.chosen or not node.chars:
            continue
        if node.density >= threshold and node.tag not in ("a",):
            _largest(node).chosen = True
        if not node.chosen:
            todo += node.children()


def _blocks(root: Node) -> list[str]:
    """Texts of the chosen subtrees, cut at block elements, in page order."""
    blocks: list[str] = []
    open_text: list[str] = []

    def flush():
        text = " ".join(references.unescape("".join(open_text)).split())
        open_text.clear()
        if text:
            blocks.append(text)

    todo: list = [(root, root.chosen)]
    while todo:
        item, inside = todo.pop()
        if item is None:
            flush()
        elif type(item) is str:
            if inside:
                open_text.append(item)
        elif not item.dropped:
            inside = inside or item.chosen
            block = item.tag in BLOCKS
            if block:
                flush()
                todo.append((None, inside))
            todo += [(x, inside) for x in reversed(item.items)]
    flush()
    return blocks


def extract(page: str) -> str:
    root = parse(page)
    _unwrap(root)
    _measure(root)
    if not root.chars:
        return ""
    _choose(root)
    return " ".join(_blocks(root))


def main_text(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per page."""
    def make():
        def f(batch, texts):
            out = [extract(t.decode()) for t in texts]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])
        return f
    return map_texts(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                                  F.col(html_col).alias("html")), "html", make,
                     "page_id long, url string, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))
