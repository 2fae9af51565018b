"""Main text of web pages by tree scoring.

A tolerant scan builds the tree of block elements of one page. Paragraphs pass
points for length and commas to their ancestors, less with every level; a
container's sum is discounted by its link density; the best container is kept with
those siblings that read like text too. Parts that are never article text (menus,
scripts, asides, page headers and footers) give no points and no text. Parts that
only their names or a form make unlikely are left out too, unless they hold most
of the page's text and read like an article. Of several articles on a page those
stay that are worth a fifth of the best one. A page's only heading of the first
level stays when it stands before the container.

A page is a row and a row is a page: Spark spreads the pages, this file only says
what to do with one. Every step is linear in the page.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.words import slices
from millrace.session import ship_package

#: Fixed values of HTML: elements whose content is no markup, elements without content, and blocks.
RAW = frozenset("script style noscript textarea iframe noembed noframes xmp title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul template svg canvas object button head".split()
)
#: Elements that are no article text, and one that is none unless it wraps the page.
DROPPED = frozenset("nav footer aside select template svg canvas object button dialog menu head search fieldset".split())
WRAPPING = frozenset(["form"])
#: Words in class, id or role of parts that are no article text.
UNLIKELY = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies "
    "disqus dialog footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promoted recommended related respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "topbar widget widgets".split()
)
#: Words that say where or what kind of box a part is, and not what it holds.
PLACES = frozenset(
    "a area articles bar block body bottom box btn buttons col column container content cta div el form frame group holder icons id in inner item items "
    "layer layout left lg line links list main md module mobile outer overlay page panel placeholder posts primary right root row secondary section "
    "slot sm stories text title top unit view wrap wrapper zone".split()
)
#: First words of names that say what a part lacks or goes with, and of headers that belong to an article.
NEGATED = frozenset("no not non has with without".split())
ARTICLE_PARTS = frozenset("article post entry story content section".split())
#: What a word of UNLIKELY can't take away, and what ends a dropped part that was never closed.
TRUSTED = frozenset("html body main article h1".split())
COMMENTS = frozenset("comment comments respond disqus".split())
#: Words that size and reading don't make good again.
FINAL = COMMENTS | {"hidden"}
#: Elements that an opening tag of the same group closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
#: What keeps such a tag from closing one further out.
WITHIN = ("ul", "ol", "dl", "table", "select")
P_WITHIN = (*WITHIN, "body", "article", "section", "div", "td", "li")
#: Elements that pass their points to the parent and do not hold them.
PARAGRAPHS = frozenset("p pre li td th dd dt blockquote h1 h2 h3 h4 h5 h6 figcaption caption summary address center".split())
#: Elements that stay beside the best container by their own text and link density.
READS = PARAGRAPHS | frozenset("ul ol dl table section figure hgroup details header".split())
SEMANTIC = {"article": 25.0, "main": 15.0}

#: Comments, declarations, and tags; a quote opens a value right after an equals sign only, and only if it's closed.
TAG = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/][^a-zA-Z>][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)(?:>|\Z)""", re.S,
)
ATTR = re.compile(r"""([^\s=/>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
NAMES = frozenset("class id role hidden aria-hidden".split())
WORD = re.compile(r"[a-z]+")


def _judged(name: str, tag: str, inside: bool) -> str:
    """The word that makes a class, id or role unlikely, or nothing.

    A name means what its last word says that is no place or box: social-science
    is a science, cookie-notice a notice, ad-box an ad.
    """
    words = WORD.findall(name)
    if not words or words[0] in NEGATED:
        return ""
    if words[-1] in ("header", "title") and (inside or words[0] in ARTICLE_PARTS):
        return ""
    at = len(words) - 1
    while at > 0 and words[at] in PLACES:
        at -= 1
    word = words[at]
    return word if word in UNLIKELY and (tag not in TRUSTED or (tag == "article" and word in COMMENTS)) else ""


def _unlikely(tag: str, attrs: str, inside: bool) -> str:
    """The word that marks an element as no article text, or nothing."""
    for m in ATTR.finditer(attrs):
        name = m[1].lower()
        if name not in NAMES:
            continue
        value = (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true" and tag in BLOCKS):
            return "hidden"
        if name != "aria-hidden":
            for part in value.split():
                if word := _judged(part, tag, inside):
                    return word
    return ""


class Page:
    """The block tree of one page: parents, tags, points and the blocks of text in page order."""

    def __init__(self, source: str):
        self.tags, self.parent = ["#root"], [0]
        self.doubt: dict[int, bool] = {}  # nodes left out unless they read like the page: whether that can be
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters inside links
        self._stack: list[tuple[str, int, bool]] = [("#root", 0, False)]  # tag, node, dropped
        self._at: dict[str, list[int]] = defaultdict(list)  # the places of each open tag in the stack
        self._text: list[str] = []
        self._linked = self._depth = 0
        self._scan(source)

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((self._stack[-1][1], text, min(self._linked, len(text))))
            self._text = []
        self._linked = 0

    def _add(self, piece: str) -> None:
        if self._stack[-1][2]:
            return
        if "&" in piece:
            piece = html.unescape(piece)
        self._text.append(piece)
        if self._depth:
            self._linked += len(piece.strip())

    def _pop(self, to: int) -> None:
        while len(self._stack) > to:
            self._at[self._stack.pop()[0]].pop()

    def _last(self, tags: tuple[str, ...]) -> int:
        """The place of the innermost open one of these tags; 0 without one."""
        return max((self._at[t][-1] for t in tags if self._at.get(t)), default=0)

    def _close(self, tags: tuple[str, ...], within: tuple[str, ...] = ()) -> None:
        at = self._last(tags)
        if at > self._last(within):
            self._flush()
            self._pop(at)

    def _open(self, tag: str, attrs: str) -> None:
        self._flush()
        if tag in CLOSES:
            self._close(CLOSES[tag], P_WITHIN if tag == "p" else WITHIN)
        elif self._stack[-1][0] == "p":
            self._pop(len(self._stack) - 1)
        dropped = self._stack[-1][2]
        inside = bool(self._last(("article", "main")))
        word = _unlikely(tag, attrs, inside) if attrs else ""
        if dropped and tag in ("article", "main") and word not in COMMENTS:
            while self._stack[-1][2] and self._stack[-1][0] not in ("article", "main"):  # a part that was never closed
                self._pop(len(self._stack) - 1)
            dropped = self._stack[-1][2]
        self.tags.append(tag)
        self.parent.append(self._stack[-1][1])
        if word or tag in WRAPPING:
            self.doubt[len(self.tags) - 1] = word not in FINAL
        self._at[tag].append(len(self._stack))
        self._stack.append((tag, len(self.tags) - 1, dropped or tag in DROPPED or word in FINAL or (tag == "header" and not inside)))

    def _scan(self, source: str) -> None:
        at = 0
        while m := TAG.search(source, at):
            if m.start() > at:
                self._add(source[at : m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag, attrs = m[2].lower(), m[3]
            if m[1]:
                if tag == "a":
                    self._depth = max(0, self._depth - 1)
                elif tag in BLOCKS:
                    self._flush()
                    self._close((tag,))
            elif tag == "br" or tag == "hr":
                self._flush()
            elif tag in RAW:
                if not attrs.endswith("/"):
                    end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = end.end() if end else len(source)
            elif tag in VOID:
                continue
            elif tag in BLOCKS:
                if not attrs.endswith("/"):
                    self._open(tag, attrs)
                    self._depth = 0
            elif tag == "a":
                self._depth = 1
        self._add(source[at:])
        self._flush()

    def _readable(self) -> list[tuple[int, str, int]]:
        """The blocks outside doubtful parts, and in those that hold more than half the text and read like an article."""
        if not self.doubt:
            return self.blocks
        n = len(self.tags)
        chars, links, prose = [0] * n, [0] * n, [0] * n
        for node, text, linked in self.blocks:
            chars[node] += len(text)
            links[node] += linked
            prose[node] += len(text) > 80 and linked * 4 < len(text)
        for i in range(n - 1, 0, -1):  # children come after their parents
            prose[i] += 2 * (self.tags[i] in ("article", "main", "h1") and chars[i] > 0)
            for kind in (chars, links, prose):
                kind[self.parent[i]] += kind[i]
        out = [False] * n
        for i in range(1, n):
            reads = self.doubt.get(i, True) and chars[i] * 2 > chars[0] and links[i] * 4 < chars[i] and prose[i] >= 2
            out[i] = out[self.parent[i]] or (i in self.doubt and not reads)
        return [b for b in self.blocks if not out[b[0]]]

    def main_blocks(self) -> list[str]:
        n = len(self.tags)
        blocks = self._readable()
        if not blocks:
            return []
        points, chars, links = [0.0] * n, [0] * n, [0] * n
        for node, text, linked in blocks:
            chars[node] += len(text)
            links[node] += linked
            share = (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - linked / len(text))
            holder = self.parent[node] if self.tags[node] in PARAGRAPHS else node
            for level in (1, 2, 6):
                points[holder] += share / level
                if holder == 0:
                    break
                holder = self.parent[holder]
        articles = [False] * n  # outermost ones
        within = [0] * n  # the outermost article around a node
        for i in range(1, n):
            within[i] = within[self.parent[i]] or (i if self.tags[i] == "article" else 0)
            articles[i] = within[i] == i
        for i in range(n - 1, 0, -1):  # children come after their parents
            chars[self.parent[i]] += chars[i]
            links[self.parent[i]] += links[i]
        plain = lambda i: points[i] * (1 - links[i] / chars[i]) if chars[i] else -1.0
        worth = lambda i: plain(i) + (SEMANTIC.get(self.tags[i], 0.0) * (1 - links[i] / chars[i]) if chars[i] else 0.0)
        best = max(range(n), key=lambda i: (worth(i), chars[i]))
        if within[best]:  # the whole article, whichever part of it reads best
            best = within[best]
        kept = [False] * n
        kept[best] = True
        least, most = max(10.0, 0.2 * worth(best)), plain(best)
        for i in range(1, n):
            if kept[self.parent[i]]:
                kept[i] = True
            elif i == best or not chars[i]:
                continue
            elif articles[i] and articles[best]:
                kept[i] = plain(i) >= 0.2 * most
            elif best and self.parent[i] == self.parent[best]:
                density = links[i] / chars[i]
                reads = self.tags[i] in READS and ((chars[i] > 80 and density < 0.25) or not density)
                kept[i] = worth(i) >= least or reads
        heads = [i for i in range(1, n) if self.tags[i] == "h1" and chars[i]]
        if len(heads) == 1 and heads[0] < best and not links[heads[0]]:
            kept[heads[0]] = True
        return [text for node, text, _ in blocks if kept[node]]


def main_text(source: str | None) -> str:
    """The main text of a page, one line a block; empty for null, empty and text-free pages."""
    return "\n".join(Page(source).main_blocks()) if source else ""


def extract(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``keep`` with ``text``, the page's main text, for every row; a kept column of that name gives way to it."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{html_col}`").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text = [main_text(v.as_py()) for v in batch.column("h")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(text, pa.string())], names=["row", "text"])

    done = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in keep if c != "text"], "text")


def op6_html_extraction(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A line break (``br``) ends a block as a paragraph's end does, so what follows it
    is a line of its own. Null and empty pages, and those without text, have an empty
    text; repeated rows come out once each; other columns are ignored; an empty table
    gives no rows.
    """
    return extract(pages, ["page_id", "url"]).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
