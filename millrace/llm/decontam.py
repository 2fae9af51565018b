"""Benchmark decontamination: a broadcast set of normalised test n-grams, and verified hits.

The windows of the benchmark go to every executor while they are few; documents are
then scanned where they lie, without a shuffle. The set is a handful of flat arrays:
a sorted hash a window, its place in one buffer of folded words, and the items that
hold it. A benchmark whose arrays would exceed a bound is joined with the documents'
windows by a 128-bit hash instead, with the same result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import LOWER_BYTES, cut_lineage
from millrace.llm.words import buffers, fold_table, hash_words, slices, windows
from millrace.session import ship_package

WINDOW = 10
#: Bytes of memory that the benchmark's windows may take in the driver and in every Python worker; beyond, they are joined.
MAX_BROADCAST_BYTES = 64 << 20
#: Bytes that a window takes besides its text: hash, start, end, and an item with its pointer.
WINDOW_BYTES = 40
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
SPAN_DDL = "spans array<struct<start: long, end: long>>"
#: All ASCII but digits and letters separates words.
TABLE = fold_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def _gram(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, i: int, n: int) -> bytes:
    """The folded words i..i+n-1, joined by a blank: what two windows must share."""
    return b" ".join(data[s:e].tobytes() for s, e in zip(starts[i : i + n], ends[i : i + n])).translate(LOWER_BYTES)


class Grams:
    """The distinct windows of one size as flat arrays, sorted by hash; ``items[ptr[i]:ptr[i + 1]]`` hold window i."""

    def __init__(self, h: np.ndarray, start: np.ndarray, end: np.ndarray, ptr: np.ndarray, items: np.ndarray):
        self.h, self.start, self.end, self.ptr, self.items = h, start, end, ptr, items


class Windows:
    """The benchmark's windows by size, over one buffer of all folded words joined by blanks."""

    def __init__(self, names: list[str], data: bytes, sizes: dict[int, Grams]):
        self.names, self.data, self.sizes = names, data, sizes

    def items_of(self, grams: Grams, h: np.uint64, gram: bytes) -> np.ndarray:
        """Numbers of the items that hold this very window; windows that only share its hash are passed over."""
        for i in range(int(np.searchsorted(grams.h, h)), len(grams.h)):
            if grams.h[i] != h:
                break
            if self.data[grams.start[i] : grams.end[i]] == gram:
                return grams.items[grams.ptr[i] : grams.ptr[i + 1]]
        return grams.items[:0]


def item_windows(items: list[str], texts: list[str | None], n: int = WINDOW) -> Windows:
    """The windows of the items, each item's once. An item of fewer than n words is one window."""
    at, (h,), starts, ends, data = hash_words(pa.array(texts, pa.large_string()), TABLE)
    folded = b" ".join(data[s:e].tobytes() for s, e in zip(starts, ends)).translate(LOWER_BYTES)
    sizes_of = ends - starts
    begin = np.concatenate([[0], np.cumsum(sizes_of + 1)])  # of each word in ``folded``
    names = sorted(set(items))
    number = {x: i for i, x in enumerate(names)}
    held = defaultdict(list)  # size -> (hashes, first words, items)
    for i, item in enumerate(items):
        a, b = int(at[i]), int(at[i + 1])
        if size := min(n, b - a):
            w = windows(h[a:b], size)
            held[size].append((w, np.arange(a, a + len(w)), np.full(len(w), number[item], np.int32)))
    out = {}
    for size, parts in held.items():
        w, first, item = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((first, item, w))
        w, first, item = w[order], first[order], item[order]
        start, end = begin[first], begin[first + size - 1] + sizes_of[first + size - 1]
        fresh = np.r_[True, w[1:] != w[:-1]]
        # windows of one hash are one window unless their bytes differ, which is tested where a hash comes twice
        group = np.cumsum(fresh) - 1
        odd = [k for k in np.flatnonzero(~fresh) if folded[start[k] : end[k]] != folded[start[k - 1] : end[k - 1]]]
        for k in sorted({int(group[k]) for k in odd}):
            run = np.flatnonzero(group == k)
            run = run[sorted(range(len(run)), key=lambda j: (folded[start[run[j]] : end[run[j]]], item[run[j]]))]
            span = np.flatnonzero(group == k)
            first[span], item[span], start[span], end[span] = first[run], item[run], start[run], end[run]
            fresh[span[1:]] = [folded[start[x] : end[x]] != folded[start[x - 1] : end[x - 1]] for x in span[1:]]
        group = np.cumsum(fresh) - 1
        once = np.r_[True, (group[1:] != group[:-1]) | (item[1:] != item[:-1])]
        lead = np.flatnonzero(fresh)
        out[size] = Grams(w[lead], start[lead], end[lead], np.searchsorted(group[once], np.arange(len(lead) + 1)), item[once])
    return Windows(names, folded, out)


def spans_of(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray, begin: int) -> list[dict[str, int]]:
    """The runs of hit words (sorted places) as spans of code points of the text that begins at byte ``begin``."""
    if not len(words):
        return []
    cut = np.flatnonzero(np.diff(words) > 1)
    out, at, chars = [], begin, 0
    for a, b in zip(words[np.r_[0, cut + 1]], words[np.r_[cut, len(words) - 1]]):
        chars += len(data[at : starts[a]].tobytes().decode())
        size = len(data[starts[a] : ends[b]].tobytes().decode())
        out.append({"start": chars, "end": chars + size})
        at, chars = ends[b], chars + size
    return out


def scan_batch(texts: pa.Array, known: Windows) -> tuple[np.ndarray, np.ndarray, list[list[str]], list[list[dict]]]:
    """(words, hit words, sorted items, spans of hit words) of each row."""
    at, (h,), starts, ends, data = hash_words(texts, TABLE)
    begins = buffers(texts)[1]
    n_words = np.diff(at)
    n_hit = np.zeros(len(texts), np.int64)
    items: list[list[str]] = [[] for _ in range(len(texts))]
    spans: list[list[dict]] = [[] for _ in range(len(texts))]
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    names: dict[int, set[int]] = defaultdict(set)
    for size, grams in known.sizes.items():
        w = windows(h, size)  # over the whole batch; those that cross rows are left out below
        if not len(w):
            continue
        place = np.minimum(np.searchsorted(grams.h, w), len(grams.h) - 1)
        for i in np.flatnonzero(grams.h[place] == w):
            row = int(np.searchsorted(at, i, side="right")) - 1
            if i + size <= at[row + 1]:
                ids = known.items_of(grams, w[i], _gram(data, starts, ends, i, size))
                if len(ids):
                    found[row].append((int(i), int(i) + size))
                    names[row].update(ids.tolist())
    for row, runs in found.items():
        hit = np.zeros(int(n_words[row]) + 1, np.int64)
        for a, b in runs:
            hit[a - at[row]] += 1
            hit[b - at[row]] -= 1
        places = np.flatnonzero(np.cumsum(hit) > 0)
        n_hit[row] = len(places)
        items[row] = [known.names[k] for k in sorted(names[row])]
        spans[row] = spans_of(places + at[row], starts, ends, data, begins[row])
    return n_words, n_hit, items, spans


def _rows(docs: DataFrame, keep: list[str], text: str, *more: Column) -> DataFrame:
    """The columns ``keep`` nested as ``row``, the text once: inside ``row``, or beside it as ``t``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), *([] if text in keep else [F.col(f"`{text}`").alias("t")]), *more)


def _text_of(batch: pa.RecordBatch, keep: list[str], text: str) -> pa.Array:
    return pc.struct_field(batch.column("row"), text) if text in keep else batch.column("t")


def _by_broadcast(docs: DataFrame, items: DataFrame, keep: list[str], text: str, n: int) -> DataFrame:
    got = items.collect()  # within MAX_BROADCAST_BYTES
    known = docs.sparkSession.sparkContext.broadcast(item_windows([r["item"] for r in got], [r["t"] for r in got], n))
    rows = _rows(docs, keep, text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n_words, n_hit, items, spans = scan_batch(_text_of(batch, keep, text), known.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, SPANS)],
                names=["row", "n_words", "n_hit", "items", "spans"],
            )

    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(f"n_words long, n_hit long, items array<string>, {SPAN_DDL}").fields])
    return rows.mapInArrow(scan, schema)


def _exploded(rows: DataFrame, keys: list[str], n: int, sizes: list[int] | None) -> DataFrame:
    """(keys, pos, size, h1, h2) of the windows of ``t``: of all ``sizes``, or of the one that an item has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, (h1, h2), *_ = hash_words(batch.column("t"), TABLE, 2)
            at = np.asarray(at)
            for size in sizes if sizes is not None else range(1, n + 1):
                w1, w2 = windows(h1, size), windows(h2, size)
                place = np.arange(len(w1))
                row = np.searchsorted(at, place, side="right") - 1
                fits = place + size <= at[row + 1]
                if sizes is None and size < n:
                    fits &= at[row + 1] - at[row] == size
                place, row = place[fits], row[fits]
                if len(place):
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(k).take(pa.array(row)) for k in keys], pa.array(place - at[row]), pa.array(np.full(len(row), size)), *[pa.array(w[fits].view(np.int64)) for w in (w1, w2)]],
                        names=[*keys, "pos", "size", "h1", "h2"],
                    )

    return rows.mapInArrow(run, T.StructType([*[rows.schema[k] for k in keys], *T.StructType.fromDDL("pos long, size long, h1 long, h2 long").fields]))


def _by_join(docs: DataFrame, items: DataFrame, keep: list[str], text: str, n: int) -> DataFrame:
    """The same by shuffle, for benchmarks that no executor should hold whole.

    Windows meet by size and a 128-bit hash of their words; a window that many
    documents share is a skewed plain join, which AQE splits. Only hashes and places
    are shuffled for that; the texts move once, to meet what was hit in them.
    """
    key = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in keep])), F.coalesce(F.col(f"`{text}`"), F.lit(""))]
    keys = [F.xxhash64(*key).alias("k1"), F.xxhash64(F.lit(7), *key).alias("k2")]
    test = cut_lineage(_exploded(items, ["item"], n, None).select("item", "size", "h1", "h2").distinct())
    sizes = [r[0] for r in test.select("size").distinct().collect()]  # at most n values
    grams = cut_lineage(test.select("size", "h1", "h2").distinct())
    found = cut_lineage(_exploded(docs.select(*keys, key[1].alias("t")), ["k1", "k2"], n, sizes).join(grams, ["size", "h1", "h2"]).distinct())
    covered = found.select("k1", "k2", F.explode(F.sequence("pos", F.col("pos") + F.col("size") - 1)).alias("p")).distinct()
    covered = covered.groupBy("k1", "k2").agg(F.array_sort(F.collect_list("p")).alias("hit"))
    names = found.join(test, ["size", "h1", "h2"]).select("k1", "k2", "item").distinct().groupBy("k1", "k2").agg(F.array_sort(F.collect_list("item")).alias("items"))
    hits = cut_lineage(covered.join(names, ["k1", "k2"]))
    rows = _rows(docs, keep, text, *keys).join(hits, ["k1", "k2"], "left").drop("k1", "k2")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = _text_of(batch, keep, text)
            at, _, starts, ends, data = hash_words(texts, TABLE)
            begins = buffers(texts)[1]
            hit = [np.array(x.as_py() or [], np.int64) for x in batch.column("hit")]
            spans = [spans_of(x + at[i], starts, ends, data, begins[i]) for i, x in enumerate(hit)]
            items = [x.as_py() or [] for x in batch.column("items")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(at), pa.int64()), pa.array([len(x) for x in hit], pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, SPANS)],
                names=["row", "n_words", "n_hit", "items", "spans"],
            )

    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(f"n_words long, n_hit long, items array<string>, {SPAN_DDL}").fields])
    return rows.mapInArrow(placed, schema)


def broadcast_bytes(items: DataFrame) -> int:
    """An upper bound of the memory that the items' windows take: their text, and so much a word."""
    words = F.regexp_count("t", F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    return items.agg(F.coalesce(F.sum(F.octet_length("t") + words * WINDOW_BYTES + F.octet_length("item")), F.lit(0))).first()[0]


def annotate(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text: str = "text", window: int = WINDOW, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(row, n_words, n_hit, items, spans) of every row; ``row`` nests the columns ``keep`` (all by default).

    n_hit counts words inside any occurrence of a benchmark window, items lists the
    ids of the benchmark's items with occurring windows, sorted as strings, spans
    the runs of hit words as start and end in code points. Null
    text has no words. An item without an id or words has no window; repeated items
    count once. An empty benchmark hits nothing.
    """
    ship_package(docs.sparkSession)
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("t"))
    run = _by_broadcast if broadcast_bytes(items) <= max_broadcast_bytes else _by_join
    return run(docs, items, docs.columns if keep is None else keep, text, window)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, columns unchanged."""
    return annotate(docs, benchmark, **options).where("n_hit = 0").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All rows of ``docs``, their text without the hit spans; texts without a hit stay as they are."""
    done = annotate(docs, benchmark, text=text, **options)
    whole = F.col(f"row.`{text}`")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end"]))
    starts = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.char_length(whole).cast("long")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(whole, (a + 1).cast("int"), (b - a).cast("int")))
    cut = F.when(F.size("spans") > 0, F.array_join(kept, "")).otherwise(whole)
    return done.select(*[cut.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op2_decontamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of documents."""
    return annotate(docs, benchmark, ["doc_id"], **options).select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
