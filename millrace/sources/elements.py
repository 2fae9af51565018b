"""Pages as arrays of elements with their places, so that nesting is a matter of intervals.

One Arrow pass reads a page's tags and gives every element its tag, class, id, start
tag and four places in the page: where its start tag begins and ends, where its
content ends, and where its end tag does. Elements stand in the page's order, and
those inside one follow it, so "inside that block" is a slice of the array. All
else (which element, what it says) is native expressions over page and array.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.session import ship_package

#: Elements without content, those whose content is no markup, and those that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title".split())
BLOCKS = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Elements that a next one of the same kind ends.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ELEMENT = pa.struct([
    ("tag", pa.string()), ("cls", pa.string()), ("id", pa.string()), ("head", pa.string()), ("start", pa.int32()), ("open", pa.int32()),
    ("close", pa.int32()), ("stop", pa.int32()), ("depth", pa.int32()), ("at", pa.int32()), ("n", pa.int32()),
])
ELEMENT_DDL = "array<struct<tag: string, cls: string, id: string, head: string, start: int, open: int, close: int, stop: int, depth: int, at: int, n: int>>"
_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>)")
_NAMED = {name: re.compile(rf"""(?i)(?<![\w-]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""") for name in ("class", "id")}


def _said(name: str, head: str) -> str:
    found = _NAMED[name].search(head)
    return " ".join((found[1] or found[2] or found[3] or "").split()) if found else ""


@lru_cache(8192)
def _named(head: str) -> tuple[str, str]:
    """Class and id of a start tag; pages of a site repeat most of theirs."""
    return (_said("class", head), _said("id", head)) if "=" in head else ("", "")


def read_elements(page: str) -> list[list]:
    """The elements of a page, in order, each a list of the fields of ``ELEMENT``.

    Linear in the page. An end tag without a start tag counts for nothing; it closes
    all that was left open inside its element. What is never closed ends where what
    holds it ends, at last with the page.
    """
    out: list[list] = []
    path: list[int] = []  # open elements
    held: dict[str, int] = {}  # how many of a tag are open

    def end(close: int, stop: int) -> None:
        element = out[path.pop()]
        held[element[0]] -= 1
        element[6], element[7], element[10] = close, stop, len(out) - element[9]

    at, lower = 0, None
    while found := _TAG.search(page, at):
        at = found.end()
        if found[2] is None:  # a comment
            at = page.find("-->", at) + 3
            if at == 2:
                break
            continue
        tag = found[2].lower()
        if found[1]:
            if held.get(tag):
                while out[path[-1]][0] != tag:
                    end(found.start(), found.start())
                end(found.start(), at)
            continue
        if tag in BLOCKS and path and out[path[-1]][0] == "p":
            end(found.start(), found.start())
        while path and tag in SIBLINGS and out[path[-1]][0] in SIBLINGS[tag]:
            last = out[path[-1]][0]
            end(found.start(), found.start())
            if last == tag:
                break
        head = found[0]
        out.append([tag, *_named(head), head, found.start(), at, at, at, len(path), len(out) + 1, 0])
        if tag in VOID or head.endswith("/>"):
            continue
        if tag in RAW:
            lower = lower or page.lower()
            close = lower.find(f"</{tag}", at) if len(lower) == len(page) else page.find(f"</{tag}", at)
            if close < 0:
                out[-1][6] = out[-1][7] = len(page)
                break
            at = page.find(">", close) + 1 or len(page)
            out[-1][6], out[-1][7] = close, at
            continue
        path.append(len(out) - 1)
        held[tag] = held.get(tag, 0) + 1
    while path:
        end(len(page), len(page))
    return out


def with_elements(pages: DataFrame, html: str = "html", name: str = "_e") -> DataFrame:
    """``pages`` with the array of elements of a column's page as column ``name``. A null page has none."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                read = [read_elements(page) for page in part.column("t").to_pylist()]
                at = [0]
                for elements in read:
                    at.append(at[-1] + len(elements))
                columns = list(zip(*[e for elements in read for e in elements])) or [()] * len(ELEMENT)
                flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ELEMENT)], fields=list(ELEMENT))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([part.column("row")]), pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat)], names=["row", "e"])

    done = rows.mapInArrow(run, T.StructType([rows.schema["row"], *T.StructType.fromDDL(f"e {ELEMENT_DDL}").fields]))
    return done.select("row.*", F.col("e").alias(name))


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with columns that are worked out once a row, whatever a later filter or projection does with them.

    A filter on a projection's column moves below it with the column's whole expression, and branches share nothing; what a generator gives stays a value.
    """
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def within(elements: Column, block: Column) -> Column:
    """The elements inside one of them, in order; none for a null block."""
    return F.coalesce(F.slice(elements, block["at"] + 1, block["n"]), F.slice(elements, 1, 0))


def has_class(element: Column, cls: str) -> Column:
    return F.concat(F.lit(" "), element["cls"], F.lit(" ")).contains(f" {cls} ")


def of(elements: Column, tag: str | None = None, cls: str | None = None, id_: str | None = None) -> Column:
    """The elements of a tag, a class and an id, where given."""

    def fits(e: Column) -> Column:
        out = F.lit(True) if tag is None else e["tag"] == tag
        out = out if cls is None else out & has_class(e, cls)
        return out if id_ is None else out & (e["id"] == id_)

    return F.filter(elements, fits)


def one(elements: Column, tag: str | None = None, cls: str | None = None, id_: str | None = None) -> Column:
    """The first such element, or null."""
    return F.try_element_at(of(elements, tag, cls, id_), F.lit(1))


def cut(page: Column, start: Column, stop: Column) -> Column:
    """What stands from one place of the page to another; empty where a place is null."""
    return F.coalesce(F.substring(page, start + 1, F.greatest(stop - start, F.lit(0))), F.lit(""))


def content(page: Column, element: Column) -> Column:
    """The markup inside an element; empty for none."""
    return cut(page, element["open"], element["close"])


def said(page: Column, element: Column) -> Column:
    """The text inside an element, white space collapsed; empty for none."""
    return text.plain_text(content(page, element))


def links_in(page: Column, elements: Column) -> Column:
    """array<struct<href,label>> of the links among some elements, in order."""
    href = lambda e: F.trim(F.replace(F.regexp_extract(e["head"], r"""(?is)(?<![\w-])href\s*=\s*["']?([^"'>]*)""", 1), F.lit("&amp;"), F.lit("&")))
    pair = F.transform(of(elements, "a"), lambda e: F.named_struct(F.lit("href"), href(e), F.lit("label"), said(page, e)))
    return F.filter(pair, lambda x: x["href"] != "")
