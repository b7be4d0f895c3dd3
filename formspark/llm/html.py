"""Main text of web pages by composite text density.

1. The page is parsed into a DOM (one pass, no recursion): implied end tags of paragraphs, list items and table
   parts, raw text elements, comments, quoted attributes, a page cut off anywhere.
2. Elements that are never main text go first: scripts, styles, forms and their controls, menus, page headers, footers,
   asides, hidden elements, and elements whose class, id or role names an advert, menu, sidebar,
   notice, reader comments or the like. A form that holds most of the page's text is its frame, not a form.
3. Every node gets its composite density: characters per tag, times a logarithm that
   falls with the share of its text inside links. The *density sum* of a node adds the densities of its
   children and of its own runs of text.
4. The container with the largest density sum is the article. The least density on the path from the body to it is
   the threshold: containers beside it that reach the threshold belong to it too, and so do
   the headings and paragraphs between them. Inside an ``article`` or ``main`` element, that element is the whole.
   Lists and boxes of links inside the article are menus and go.
5. Blocks in page order: character references decoded, white space (also a line break) one space, joined by an
   empty line.

Defined cases: null, empty or wholly unwanted pages give an empty text; a page without tags is one block; unknown
tags stand inside a line; repeated rows are extracted each; long pages are read whole (one page is the
unit of a task's work); all columns of the input stay, the text comes in ``text`` (``out``), and an empty table stays one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import blocks
from ..operators.structs import column

BLOCK_BYTES = 8 << 20

# --- Fixed values: element names and words ------------------------------------------------
_VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
_RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
_HEAD = frozenset("base link meta title style script noscript template".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr li legend listing main menu nav ol optgroup option p plaintext pre search section summary "
    "table tbody tfoot thead tr td th ul xmp".split())
_CLOSES_P = _BLOCK - frozenset("body caption dd dt legend li optgroup option tbody td tfoot th thead tr".split()) | {"li", "dd", "dt"}
#: What the main text can be: anything that holds paragraphs, not a paragraph or a part of one.
_CONTAINER = frozenset("body article main section div center td th table tbody tr form details fieldset figure blockquote".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_LIST = frozenset("ul ol dl menu dir div section table center".split())
#: Cells of a table row are blocks to the parser, words of one line to the reader.
_CELL = frozenset("td th".split())
_SCOPE = frozenset("table td th caption".split())
_NEVER = frozenset(
    "script style xmp iframe noembed noframes textarea title noscript template nav aside footer menu search button select option "
    "optgroup datalist input label legend fieldset dialog svg math object applet audio video canvas map head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog toolbar tablist form".split())
#: Words that may begin or end a class or id of an unwanted element, whole.
_WORDS = frozenset(
    "ad ads adv banner nav nav2 topnav subnav header masthead footer menu notice notices alert alerts consent gdpr popup modal overlay toolbar "
    "share sharing social related recommended recommendations outbrain taboola teaser widget widgets pagination pager breadcrumbs "
    "login signin signup signup register search form rail tags respond replies reply disqus feedback survey skip copyright disclaimer legal".split())
#: Words that begin a word of a class or id of an unwanted element.
_PREFIXES = ("advert", "adsense", "adbox", "adslot", "sponsor", "promo", "sidebar", "footer", "navig", "navbar", "menu", "breadcrumb", "cookie", "comment",
             "newsletter", "subscri", "livefyre", "disqus")
_NOT = frozenset("no not has have with without is hide show".split())
# --------------------------------------------------------------------------------------------

_TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+))")
_REST = re.compile(r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+>""")
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _unwanted_name(value: str) -> bool:
    """Does a class or id (of one or more names) say that its element is no main text?"""
    for name in value.split():
        words = [w for w in _SPLIT.split(_CAMEL.sub("-", name).lower()) if w]
        if not words or words[0] in _NOT:
            continue
        if words[0] in _WORDS or words[-1] in _WORDS or any(w.startswith(_PREFIXES) for w in words):
            return True
    return False


class _Page:
    """The DOM of a page as parallel lists; a node's children have larger numbers than the node."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.noise = ["#root"], [-1], [False]
        self.inside = [False]                                    # in an article or main element
        self.runs: list[tuple[int, int, str]] = []               # (node, block, decoded text)
        self._block, self._stack, self._open = 0, [0], {}
        self._body = 0
        self._parse(html)

    # The open elements: a stack of nodes and, by name, the depths at which they are open.

    def _push(self, name: str, noise: bool) -> None:
        up = self._stack[-1]
        self.tag.append(name)
        self.parent.append(up)
        self.noise.append(noise or self.noise[up])
        self.inside.append(self.inside[up] or name in ("article", "main"))
        self._open.setdefault(name, []).append(len(self._stack))
        self._stack.append(len(self.tag) - 1)

    def _pop_to(self, depth: int) -> None:
        while len(self._stack) > depth:
            self._open[self.tag[self._stack.pop()]].pop()

    def _depth(self, name: str) -> int:
        at = self._open.get(name)
        return at[-1] if at else 0

    def _scope(self, names: frozenset | tuple) -> int:
        return max((self._depth(n) for n in names), default=0)

    def _close(self, name: str, scope: int) -> None:
        """Close the innermost open ``name`` unless it lies outside ``scope``."""
        at = self._depth(name)
        if at > scope:
            self._pop_to(at)

    def _parse(self, html: str) -> None:
        pos, n = 0, len(html)
        while pos < n:
            m = _TAG.search(html, pos)
            if not m:
                self._text(html[pos:])
                return
            if m.start() > pos:
                self._text(html[pos:m.start()])
            if m[1]:
                end = html.find("-->", m.start() + 2)
                pos = end + 3 if end >= 0 else n
            elif m[2]:
                end = html.find(">", m.end())
                pos = end + 1 if end >= 0 else n
            else:
                rest = _REST.match(html, m.end())
                end = rest.end() if rest else html.find(">", m.end()) + 1
                if end <= 0:  # cut off inside a tag
                    return
                name = m[4].lower()
                if m[3]:
                    self._end_tag(name)
                    pos = end
                else:
                    pos = self._start_tag(name, html[m.end():end - 1], html, end)

    def _text(self, text: str) -> None:
        if self.tag[self._stack[-1]] == "head" and text.strip():
            self._pop_to(self._depth("head"))
        node = self._stack[-1]
        if not self.noise[node]:
            self.runs.append((node, self._block, unescape(text)))

    def _start_tag(self, name: str, attrs: str, html: str, pos: int) -> int:
        if name == "html":
            return pos
        if name == "body":
            if self._depth("head"):
                self._pop_to(self._depth("head"))
            if not self._body:
                self._push(name, False)
                self._body = self._stack[-1]
            return pos
        if self._depth("head") and name not in _HEAD:
            self._pop_to(self._depth("head"))
        if name in _BLOCK and name not in _CELL:
            self._block += 1
        scope = self._scope(_SCOPE)
        if name in _CLOSES_P:
            self._close("p", scope)
        if name == "li":
            self._close("li", max(scope, self._scope(("ul", "ol", "menu", "dir"))))
        elif name in ("dd", "dt"):
            for other in ("dd", "dt"):
                self._close(other, max(scope, self._depth("dl")))
        elif name in ("tr", "td", "th", "tbody", "thead", "tfoot"):
            table = self._depth("table")
            for other in ("td", "th") if name in _CELL else ("td", "th", "tr") if name == "tr" else ("td", "th", "tr", "tbody", "thead", "tfoot"):
                self._close(other, table)
        elif name == "option":
            self._close("option", scope)
        elif name == "a":
            self._close("a", max(scope, self._scope(("p", "li", "div", "section", "article"))))
        if name in _VOID:
            if name == "br":
                self._text("\n")
            if name in ("hr", "br"):
                self._push(name, False)
                self._pop_to(len(self._stack) - 1)
            return pos
        if attrs.endswith("/") and name in ("svg", "math", "path"):
            return pos
        if name in _CELL:
            self._text(" ")
        self._push(name, self._unwanted(name, attrs))
        if name in _RAW:
            end = _END[name].search(html, pos)
            self._pop_to(len(self._stack) - 1)
            if not end:
                return len(html)
            close = html.find(">", end.end())
            return close + 1 if close >= 0 else len(html)
        return pos

    def _unwanted(self, name: str, attrs: str) -> bool:
        if name in _NEVER:
            return name != "noscript" or not self.inside[self._stack[-1]]
        if name == "header" and not self.inside[self._stack[-1]]:
            return True
        if "=" not in attrs and "hidden" not in attrs:
            return False
        for m in _ATTR.finditer(attrs):
            key = m[1].lower()
            if key == "hidden":
                return True
            if key not in ("class", "id", "role", "style", "aria-hidden"):
                continue
            value = unescape(m[2] or m[3] or m[4] or "")
            if key == "style" and _HIDDEN.search(value) or key == "aria-hidden" and value.strip().lower() == "true":
                return True
            if key == "role" and value.strip().lower() in _ROLES:
                return True
            if key in ("class", "id") and name != "main" and (name != "article" or "comment" in value.lower()) and _unwanted_name(value):
                return True
        return False

    def _end_tag(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name in _BLOCK and name not in _CELL:
            self._block += 1
        if name == "br":
            self._text("\n")
            return
        at = self._depth(name)
        if not at:
            return
        if name not in _BLOCK and name not in _NEVER:
            # An inline element does not close the blocks that were opened inside it.
            for depth in range(len(self._stack) - 1, at, -1):
                if self.tag[self._stack[depth]] in _BLOCK:
                    return
        elif name not in _SCOPE and name not in ("tr", "tbody", "thead", "tfoot", "head") and at < self._scope(_SCOPE):
            return
        self._pop_to(at)


def _density(chars: int, link_chars: int, tags: int, link_tags: int, body_share: float) -> float:
    """Composite text density; counts of zero count as one where they divide."""
    if not chars:
        return 0.0
    tags, lc, lt = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * lc + body_share * chars + math.e)
    return chars / tags * math.log(max(chars / lc * tags / lt, 1.0)) / math.log(base)


def _article(page: _Page) -> list[tuple[int, str]]:
    """(block, text) of the runs that belong to the main text, in page order."""
    n, tag, parent = len(page.tag), page.tag, page.parent
    own, chars, links = [0] * n, [0] * n, [0] * n
    tags, link_tags = [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = tag[i] == "a" or in_link[parent[i]]
    lengths = [len(" ".join(t.split())) for _, _, t in page.runs]
    for (node, _, _), c in zip(page.runs, lengths, strict=True):
        own[node] += c

    def count() -> None:
        for i in range(n):
            chars[i], tags[i], link_tags[i] = own[i], 0, 0
            links[i] = own[i] if in_link[i] else 0
        for i in range(n - 1, 0, -1):
            if not page.noise[i]:
                p = parent[i]
                chars[p] += chars[i]
                links[p] += links[i]
                tags[p] += tags[i] + 1
                link_tags[p] += link_tags[i] + (tag[i] == "a")

    count()
    forms = [i for i in range(1, n) if tag[i] == "form" and not page.noise[i] and 2 * chars[i] <= chars[0]]
    if forms:
        for i in forms:
            page.noise[i] = True
        for i in range(1, n):
            page.noise[i] = page.noise[i] or page.noise[parent[i]]
        own = [0 if page.noise[i] else c for i, c in enumerate(own)]
        count()
    body = page._body
    if not chars[body]:
        body = 0
    if not chars[body]:
        return []
    share = max(links[body], 1) / chars[body]
    dense = [0.0 if page.noise[i] else _density(chars[i], links[i], tags[i], link_tags[i], share) for i in range(n)]
    sums = [0.0] * n
    for i in range(1, n):
        sums[parent[i]] += dense[i]
    for (node, _, _), c in zip(page.runs, lengths, strict=True):
        if c and not page.noise[node]:
            sums[node] += _density(c, c if in_link[node] else 0, 1, 1 if in_link[node] else 0, share)
    live = [not page.noise[i] and chars[i] > 0 for i in range(n)]
    fit = [i for i in range(n) if live[i] and (i == body or tag[i] in _CONTAINER)]
    top = max(fit, key=lambda i: (sums[i], -i))
    whole, i = None, top
    while i >= 0 and whole is None:
        whole, i = (i if tag[i] in ("article", "main") else None), parent[i]
    if whole is not None:
        root, marked = whole, {whole}
    else:
        path, i = [top], top
        while i != body and parent[i] >= 0:
            i = parent[i]
            path.append(i)
        marked = _marked(n, parent, fit, sums, dense, min(dense[i] for i in path), body, top)
        root = _common(sorted(marked), parent)
    return _kept(page, root, marked, fit, chars, links, link_tags)


def _marked(n: int, parent: list[int], fit: list[int], sums: list[float], dense: list[float], threshold: float, body: int, top: int) -> set[int]:
    """Below every node that reaches the threshold, the container with the largest density sum."""
    best = {i: i for i in fit}
    for i in range(n - 1, 0, -1):  # children before parents
        if i in best:
            p = parent[i]
            if p not in best or (sums[best[i]], -best[i]) > (sums[best[p]], -best[p]):
                best[p] = best[i]
    marked, done = {top}, [False] * n
    open_ = [False] * n
    for i in range(n):
        p = parent[i]
        done[i] = i in marked or (p >= 0 and done[p])
        open_[i] = not done[i] and (i == body or (p >= 0 and open_[p])) and dense[i] >= threshold
        if open_[i] and i in best and i != body and best[i] != i and dense[best[i]] >= threshold:
            marked.add(best[i])
        elif open_[i] and i in best and i != body and best[i] == i:
            marked.add(i)
            done[i] = True
    return marked


def _common(nodes: list[int], parent: list[int]) -> int:
    """The lowest node above all of ``nodes``."""
    root = nodes[0]
    for i in nodes[1:]:
        while root != i:
            if root > i:
                root = parent[root]
            else:
                i = parent[i]
    return root


def _kept(page: _Page, root: int, marked: set[int], fit: list[int], chars: list[int], links: list[int], link_tags: list[int]) -> list[tuple[int, str]]:
    n, tag, parent = len(page.tag), page.tag, page.parent
    containers = set(fit)
    inside, below, holds = [False] * n, [False] * n, [False] * n
    for i in sorted(marked):
        j = i
        while j >= 0 and not holds[j]:
            holds[j] = True
            j = parent[j]
    for i in range(n):
        p = parent[i]
        below[i] = i == root or (p >= 0 and below[p])
        in_marked = i in marked or (p >= 0 and inside[p] and below[p])
        menu = tag[i] in _LIST and i != root and i not in marked and link_tags[i] > 1 and 3 * links[i] >= 2 * chars[i]
        # A container that holds nothing marked and lies in nothing marked stays out, with all it holds.
        outside = i in containers and not in_marked and not holds[i]
        inside[i] = in_marked
        if below[i] and (menu or outside or page.noise[i]):
            below[i] = inside[i] = False
    if root in marked:
        return [(b, t) for node, b, t in page.runs if below[node]]
    runs = [(node, b, t, inside[node]) for node, b, t in page.runs if below[node]]
    at = [k for k, r in enumerate(runs) if r[3]]
    lo, hi = (at[0], at[-1] + 1) if at else (0, 0)
    while lo > 0 and (_heading(runs[lo - 1][0], tag, parent) or not runs[lo - 1][2].strip()):
        lo -= 1
    return [(b, t) for _, b, t, _ in runs[lo:hi]]


def _heading(node: int, tag: list[str], parent: list[int]) -> bool:
    while node >= 0 and tag[node] not in _BLOCK:
        node = parent[node]
    return node >= 0 and tag[node] in _HEADING


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    lines: list[str] = []
    last = None
    for block, text in _article(_Page(html)):
        if block == last:
            lines[-1] += text
        else:
            lines.append(text)
            last = block
    return "\n\n".join(line for line in (" ".join(line.split()) for line in lines) if line)


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col`` as column ``out``, which replaces one of that name."""
    rows = pages.select(*[column(c) for c in pages.columns if c.lower() != out.lower() or c == html_col],
                        column(html_col).cast("string").alias("_html"))
    width = len(rows.columns) - 1
    schema = rows.schema

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_html", BLOCK_BYTES):
            text = pa.array([main_text(h) for h in block.column(width).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*block.columns[:width], text], names=[*block.schema.names[:width], "_html"])

    done = rows.mapInArrow(texts, schema)
    keep = [column(c) for c in rows.columns[:-1] if c.lower() != out.lower()]
    return done.select(*keep, F.col("_html").alias(out))
