"""Landed pages of a paged service as a Spark data source, read in ranges of pages.

The folder holds one response a page under ``series=<name>/page=<number>/``, or several
under ``series=<name>/pages=<first>-<last>/``, each a line of page number, tab and
response: a folder and a file a page cost more than what is in them. Tasks read through Arrow's file systems (local and network folders, S3, GCS, HDFS), so the
path must be one that Arrow can open; the driver only lists names and sizes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from io import BufferedReader
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.session import ship_package

SCHEMA = "series string, page int, has_next boolean, n_items int, ord int, item string, fault string"

#: What a task reads at most, unless a single page is larger.
TASK_PAGES = 64
TASK_BYTES = 32 << 20

_PLACE = re.compile(r"series=([^/]*)/pages?=(\d+)(-\d+)?/[^/_.][^/]*$")


def opened(path: str):
    """(file system, path inside it) of a folder's address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


@dataclass
class PageRange(InputPartition):
    """The files of one task: (series, first page, path, whether it holds several pages), in order."""

    pages: list[tuple[str, int, str, bool]]


def page_items(body: bytes, results: str, more: list[str]) -> tuple[bool, list[str]]:
    """(has a next page, the items as JSON) of one response; a page without items is the last one."""
    answer = json.loads(body)
    items = answer.get(results) or []
    step = answer
    for name in more:
        step = step.get(name) if isinstance(step, dict) else None
    return bool(step) and bool(items), [json.dumps(x, ensure_ascii=False) for x in items]


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.results = options.get("results", "results")
        self.more = options.get("more", "page_metadata.hasNext").split(".")
        self.most = int(options.get("taskpages", TASK_PAGES))
        self.first = int(options.get("first", 0))
        self.last = int(options.get("last", 2**31 - 1))
        self.series = json.loads(options["series"]) if "series" in options else None

    def _wanted(self, series: str, page: int, last: int) -> bool:
        return page <= self.last and self.first <= last and (self.series is None or series in self.series)

    def partitions(self) -> list[PageRange]:
        from pyarrow import fs

        store, root = opened(self.path)
        found = []
        for info in store.get_file_info(fs.FileSelector(root, recursive=True)):
            place = info.type == fs.FileType.File and info.size and _PLACE.search(info.path)
            if place and self._wanted(unquote(place[1]), int(place[2]), int((place[3] or place[2]).lstrip("-"))):
                found.append((unquote(place[1]), int(place[2]), info.path, place[3] is not None, info.size))
        ranges: list[PageRange] = []
        size = 0
        for series, page, path, several, n in sorted(found):
            if not ranges or len(ranges[-1].pages) >= self.most or size + n > TASK_BYTES:
                ranges.append(PageRange([]))
                size = 0
            ranges[-1].pages.append((series, page, path, several))
            size += n
        return ranges or [PageRange([])]

    def _bodies(self, partition: PageRange) -> Iterator[tuple[str, int, bytes]]:
        store, _ = opened(self.path)
        for series, page, path, several in partition.pages:
            with store.open_input_stream(path) as stream:
                if not several:
                    yield series, page, stream.read()
                    continue
                for line in BufferedReader(stream):
                    number, _, body = line.partition(b"\t")
                    if self.first <= int(number) <= self.last:
                        yield series, int(number), body

    def read(self, partition: PageRange) -> Iterator[tuple]:
        for series, page, body in self._bodies(partition):
            try:
                more, items = page_items(body, self.results, self.more)
            except (ValueError, AttributeError, TypeError) as error:
                yield series, page, None, 0, -1, None, type(error).__name__
                continue
            yield from ((series, page, more, len(items), i, item, None) for i, item in enumerate(items))
            if not items:
                yield series, page, False, 0, -1, None, None


class LandedPages(DataSource):
    """Format ``landed_pages``: a row an item, and a row without an item for an empty or unreadable page.

    Options: ``path``; ``results``, the key of the list; ``more``, the dotted key that
    says whether a page follows; ``taskpages``, the most pages of a task. ``first``,
    ``last`` (page numbers) and ``series`` (a JSON list) choose the files before any is
    opened. They are options, not pushed filters: with those, on Spark 4.1.2, a query was
    seen to return only the pages that an earlier query on the same DataFrame had chosen.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def landed_pages(spark: SparkSession, path: str, series: list[str] | None = None, **options) -> DataFrame:
    """Every landed page of every series, or of the pages and series that the options choose."""
    ship_package(spark)
    spark.dataSource.register(LandedPages)
    reader = spark.read.format("landed_pages").options(**options)
    return (reader if series is None else reader.option("series", json.dumps(series))).load(path)


def last_pages(pages: DataFrame) -> DataFrame:
    """(series, last, complete): each series' first page without a successor, and whether all pages up to it were read.

    A series that never says it has ended has no ``last`` and isn't complete; nor is one
    with a missing or unreadable page.
    """
    each = pages.groupBy("series", "page").agg(F.bool_and("has_next").alias("more"), F.max("fault").alias("fault"))
    ends = F.min(F.when(~F.col("more"), F.col("page")))
    state = each.groupBy("series").agg(ends.alias("last"), F.array_sort(F.collect_set(F.when(F.col("fault").isNull(), F.col("page")))).alias("_read"))
    inside = F.size(F.filter("_read", lambda p: (p >= 1) & (p <= F.col("last"))))
    return state.select("series", "last", F.coalesce(inside == F.col("last"), F.lit(False)).alias("complete"))


def scanned(pages: DataFrame) -> DataFrame:
    """The items that a scan page by page would have seen: none behind a series' first page without a successor."""
    ends = pages.where("NOT has_next").groupBy("series").agg(F.min("page").alias("_last"))
    return pages.where("item IS NOT NULL").join(ends, "series", "left").where("_last IS NULL OR page <= _last").drop("_last")
