"""Periodic runs of words: longest previous factors, LZ blocks, boundary extensions and copied runs.

A run is a stretch that repeats its first ``period`` words at least ``MIN_COPIES``
times over and can't be made longer. A text is handled as numbers, one a different
word:

1. Prefix doubling sorts the suffixes and leaves, for windows of 1, 2, 4 ... words,
   ranks that are equal where windows are. Common extensions of any two places, to
   the right and to the left, are then a handful of look-ups, LCP values among them.
2. A suffix's longest previous factor is its common prefix with the nearest
   suffixes before and after it, in suffix order, that begin earlier in the text.
   Walking by them cuts the text into LZ blocks.
3. Main: a run that touches a block's border has a period of less than a third of
   the two blocks there, so every such period is extended from the border both ways.
4. A run strictly inside a block lies in the block's earlier copy as well. Runs are
   kept by their start, and those inside the copy are copied along, from left to right.

Texts of a batch are laid end to end, each with numbers of its own, so nothing is
common to two of them and everything is done for all of them at once. Texts without
a repeated window of five words have no run and are left out. Time is n log n for n
words, and no row meets another: one pass, no shuffle.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import WHITE_CHARS, let
from millrace.llm.quality import words_of
from millrace.llm.words import cut_table, hash_words, join_words, numbered, slices, windows
from millrace.session import ship_package

#: A run has so many words at least, and so many copies of its period.
MIN_WORDS = 6
MIN_COPIES = 4
TABLE = cut_table(WHITE_CHARS.encode())
#: Bytes of text handled at a time.
SLICE = 2 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS_DDL = "array<struct<start: long, length: long, period: long>>"


def suffix_ranks(s: np.ndarray) -> list[np.ndarray]:
    """Ranks of the windows of 1, 2, 4 ... numbers from each place, until all differ: the last are those of the suffixes.

    A rank is the number of windows that are smaller, so sorting a group of equal
    ones further leaves all other ranks alone. Windows end with the text.
    """
    n = len(s)
    order = np.argsort(s, kind="stable")
    fresh = np.r_[True, s[order[1:]] != s[order[:-1]]]
    rank = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, width = [rank], 1
    tied = order[~(fresh & np.r_[fresh[1:], True])]
    while len(tied):
        after = tied + width
        key = rank[tied].astype(np.int64) * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        old = rank[tied]
        here = np.arange(len(tied))
        fresh = np.r_[True, key[1:] != key[:-1]]
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], here, 0))
        rank = rank.copy()
        rank[tied] = old + (np.maximum.accumulate(np.where(fresh, here, 0)) - group)
        levels.append(rank)
        tied = tied[~(fresh & np.r_[fresh[1:], True])]
        width *= 2
    return levels


def ahead(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many numbers agree from the places i and j on (i and j differ; a place at the end has none)."""
    n, i, j = len(levels[0]), i.copy(), j.copy()
    begin = i.copy()
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        same = (i < n) & (j < n) & (rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)])
        i += same * (1 << k)
        j += same * (1 << k)
    return i - begin


def back(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many numbers agree up to the places i and j, both included (-1 is before the text)."""
    i, j = i.copy(), j.copy()
    begin = i.copy()
    for k in range(len(levels) - 1, -1, -1):
        rank, a, b = levels[k], i - (1 << k) + 1, j - (1 << k) + 1
        same = (a >= 0) & (b >= 0) & (rank[np.maximum(a, 0)] == rank[np.maximum(b, 0)])
        i -= same * (1 << k)
        j -= same * (1 << k)
    return begin - i


def previous_factors(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(LPF, source): the longest factor from each place that begins earlier too, and where.

    Only suffixes that start with the same number matter, so the nearest earlier
    ones are looked for inside their group, by halving strides over running minima.
    """
    n = len(levels[0])
    place = np.empty(n, np.int64)
    place[levels[-1]] = np.arange(n)  # the suffix array
    low = levels[0][place].astype(np.int64)  # where the group begins
    fresh = np.r_[True, low[1:] != low[:-1]]
    sizes = np.diff(np.r_[np.flatnonzero(fresh), n])
    high = low + np.repeat(sizes, sizes)
    at = np.flatnonzero(high - low > 1)
    length, source = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    if not len(at):
        return length, source
    least = [place]  # least[k][x]: the smallest of the 2^k places up to x
    while 1 << len(least) < sizes.max():
        w, last = 1 << (len(least) - 1), least[-1]
        least.append(np.r_[last[:w], np.minimum(last[w:], last[:-w])])
    own, lo, hi = place[at], low[at], high[at]
    before, after = at - 1, at + 1
    for k in range(len(least) - 1, -1, -1):
        w, m = 1 << k, least[k]
        before -= ((before - w + 1 >= lo) & (m[np.maximum(before, 0)] > own)) * w
        after += ((after + w <= hi) & (m[np.minimum(after + w - 1, n - 1)] > own)) * w
    for other, there in ((before, before >= lo), (after, after < hi)):
        there = np.flatnonzero(there)
        i, j = own[there], place[other[there]]
        keep = j < i
        i, j = i[keep], j[keep]
        size = ahead(levels, i, j)
        better = size > length[i]
        length[i[better]], source[i[better]] = size[better], j[better]
    return length, source


def border_runs(levels: list[np.ndarray], cuts: np.ndarray) -> set[tuple[int, int, int]]:
    """(start, end, period) of the runs that touch a border of blocks; ``cuts`` are the blocks' starts and the end."""
    n = len(levels[0])
    size = np.diff(cuts)
    most = (np.r_[0, size] + np.r_[size, 0]) // (MIN_COPIES - 1)  # largest period to try at each border
    b = np.repeat(cuts, most)
    q = np.arange(len(b)) - np.repeat(np.cumsum(most) - most, most) + 1
    first = levels[0]
    best: dict[tuple[int, int], int] = {}
    # with four copies and more, two whole ones lie on one side of the border
    right = (b + q < n) & (first[np.minimum(b, n - 1)] == first[np.minimum(b + q, n - 1)])
    left = (b - q - 1 >= 0) & (first[np.maximum(b - 1, 0)] == first[np.maximum(b - q - 1, 0)])
    for ok, shift in ((right, 0), (left, 1)):
        i, period = b[ok] - shift * q[ok], q[ok]
        over, under = ahead(levels, i, i + period), back(levels, i - 1, i + period - 1)
        whole = over + under + period
        long = np.flatnonzero(whole >= np.maximum(MIN_WORDS, MIN_COPIES * period))
        for s, e, p in zip((i - under)[long].tolist(), (i + period + over)[long].tolist(), period[long].tolist()):
            best[s, e] = min(best.get((s, e), p), p)  # a stretch's smallest period is tried where its multiples are
    return {(s, e, p) for (s, e), p in best.items()}


def runs_of(s: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of a sequence of numbers, by start."""
    if len(s) < MIN_WORDS:
        return []
    levels = suffix_ranks(s)
    length, source = previous_factors(levels)
    step, cuts, at, n = np.maximum(length, 1).tolist(), [], 0, len(s)
    while at < n:
        cuts.append(at)
        at += step[at]
    known = sorted(border_runs(levels, np.array([*cuts, n])))
    blocks = np.array(cuts)
    for b in blocks[length[blocks] >= MIN_WORDS + 2].tolist():
        begin, size = int(source[b]), int(length[b])
        i = bisect_right(known, (begin, n, n))
        while i < len(known) and known[i][0] < begin + size:  # what is copied comes later in the list, and may be copied again
            first, end, p = known[i]
            if end < begin + size:
                insort(known, (first + b - begin, end + b - begin, p))
            i += 1
    return known


def _find(texts: pa.Array) -> tuple[np.ndarray, list[tuple[int, int, int]], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(offsets of rows in words, runs in places of the batch's words, (data, starts, ends) of the words)."""
    at, (h,), starts, ends, data = hash_words(texts, TABLE)
    grams = windows(h, MIN_WORDS - 1)
    chosen = [
        (a, b) for a, b in zip(at[:-1].tolist(), at[1:].tolist())
        if b - a >= MIN_WORDS and len(np.unique(grams[a : b - MIN_WORDS + 2])) < b - a - MIN_WORDS + 2
    ]
    if not chosen:
        return at, [], (data, starts, ends)
    words = np.concatenate([np.arange(a, b) for a, b in chosen])
    number, different = numbered(data, starts[words], ends[words])
    sizes = np.array([b - a for a, b in chosen])
    text = np.repeat(np.arange(len(chosen)), sizes)
    found = runs_of(text * np.int64(len(different)) + number)
    place = lambda x: int(words[x])  # noqa: E731  a run lies in one text, whose words lie together
    return at, [(place(s), place(e - 1) + 1, p) for s, e, p in found], (data, starts, ends)


def periodic_runs(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """(row, n_words, runs, collapsed) of every row; ``row`` nests the columns ``keep`` (all by default).

    ``runs`` holds start and length in words (numbered from 0) and the smallest
    period of every run, by start and period; ``collapsed`` is the text's words
    joined by one space, without those that any run contains after its first
    ``period`` words. Words are cut at white space and compared as they are. Null
    and empty texts have no words and collapse to an empty text; repeated rows and
    repeated or null ids are rows like others; an empty table gives no rows. No
    column of ``docs`` can clash, as they come nested.
    """
    ship_package(docs.sparkSession)
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            at, found, (data, starts, ends) = _find(batch.column("t"))
            drop = np.zeros(len(starts) + 1, np.int64)
            for s, e, p in found:
                drop[s + p] += 1
                drop[e] -= 1
            stay = np.cumsum(drop)[:-1] == 0
            texts = join_words(data, starts[stay], ends[stay], np.r_[0, np.cumsum(stay)][at])
            flat = np.array(found, np.int64).reshape(-1, 3)
            row = np.searchsorted(at, flat[:, 0], side="right") - 1
            flat_runs = pa.StructArray.from_arrays([pa.array(flat[:, 0] - at[row]), pa.array(flat[:, 1] - flat[:, 0]), pa.array(flat[:, 2])], fields=list(RUN))
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(at))), pa.int32()), flat_runs)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.diff(at), pa.int64()), lists, texts], names=["row", "n_words", "runs", "collapsed"])

    kinds = T.StructType.fromDDL(f"n_words long, runs {RUNS_DDL}, collapsed string")
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *kinds.fields]))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones the first by start, then period. Null without runs."""
    better = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda a, r: F.when(better(a, r), r).otherwise(a))


def planted(doc_id: Column, text: Column) -> Column:
    """The query's input: every tenth text, by the crc32 of its id, repeats itself from some word on."""

    def repeat(words: Column, g: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1
        at = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, at(i))), " ")

    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    return F.when(F.pmod(h, F.lit(10)) == 0, let(words_of(text), lambda w: F.when(F.size(w) > 0, repeat(w, g)).otherwise(F.lit("")))).otherwise(text)


def op11_periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row of documents.

    Texts are those of :func:`planted`. A null id plants nothing. Null and empty
    texts have no run: four nulls and the digests of the empty string. Repeated rows
    come out once each; other columns are ignored.
    """
    texts = docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    done = periodic_runs(texts, ["doc_id"]).select("row.doc_id", "runs", "collapsed", strongest(F.col("runs")).alias("top"))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), "")
    return done.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
