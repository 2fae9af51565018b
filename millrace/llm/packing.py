"""Best-fit packing of whole documents into sequences, for the corpus as one instance.

Lengths are integers up to the capacity, so the whole instance is a histogram of at
most ``capacity`` rows, however many documents there are. Only that histogram goes
to the driver. It is first shrunk by Martello-Toth dominance: small sets that no
other filling of a sequence can beat are fixed for good. Best-fit decreasing packs
what remains, for all documents of a length at once. The result is a list of runs
(length, ranks, first sequence, copies a sequence, offset), a few thousand at most;
documents are ranked within their length in a distributed way and meet their run in
a broadcast join.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from millrace.llm.common import cut_lineage
from millrace.llm.tokens import broadcast_vocabulary, encoder_of
from millrace.llm.words import slices

CAPACITY = 1024
#: Id put after every document.
END = 2

Run = tuple[int, int, int, int, int, int]


class Plan:
    """Runs of a packing: (length, first rank, last rank + 1, first sequence, copies a sequence, offset)."""

    def __init__(self) -> None:
        self.runs: list[Run] = []
        self.used: dict[int, int] = {}
        self.sequences = 0

    def put(self, length: int, n: int, first: int, copies: int, offset: int) -> None:
        """n documents of a length, ``copies`` in each of the sequences from ``first`` on."""
        a = self.used.get(length, 0)
        self.runs.append((length, a, a + n, first, copies, offset))
        self.used[length] = a + n

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n


def _best_pair(lengths: list[int], count: dict[int, int], room: int) -> tuple[int, int, int]:
    """(sum, a, b) of the fullest pair within ``room``; (0, 0, 0) without one."""
    best = (0, 0, 0)
    i, j = 0, bisect_left(lengths, room + 1) - 1
    while i <= j:
        a, b = lengths[i], lengths[j]
        if a + b > room or (i == j and count[a] < 2):
            j -= 1
        else:
            best = max(best, (a + b, a, b))
            i += 1
    return best


def _largest_second(lengths: list[int], count: dict[int, int], room: int) -> int:
    """The largest smaller part of any pair within ``room``; 0 without a pair."""
    for i in range(bisect_left(lengths, room // 2 + 1) - 1, -1, -1):
        d = lengths[i]
        if count[d] >= 2 or (i + 1 < len(lengths) and d + lengths[i + 1] <= room):
            return d
    return 0


def reduce_by_dominance(count: dict[int, int], capacity: int, plan: Plan) -> None:
    """Fixes sets that dominate every other filling around the largest length; shrinks ``count``.

    With the largest document in place, of size L, and room R = capacity - L:
    nothing fits: {L} alone. One document fills R exactly, or only one fits at all, or
    the largest that fits is at least as large as any pair that fits and no three
    fit: {L, that one}, because whatever else would stand there can move to its
    place. A pair that fills R exactly, when no three fit, its larger part is the
    largest that fits and its smaller part the largest smaller part of any pair that
    fits: {L, a, b}. Lengths without such a set are left alone. Removing documents
    keeps each of these conditions true, so all copies are fixed at once.
    """
    lengths = sorted(k for k, n in count.items() if n)

    def take(k: int, n: int) -> None:
        count[k] -= n
        if not count[k]:
            lengths.pop(bisect_left(lengths, k))

    for big in sorted(lengths, reverse=True):
        while count.get(big, 0):
            room = capacity - big
            own = count[big]
            take(big, 1)  # the other copies of this length may be companions
            smallest = sum(([k] * min(3, count[k]) for k in lengths[:3]), [])[:3]
            at = bisect_left(lengths, room + 1) - 1
            if at < 0:
                plan.put(big, own, plan.open(own), 1, 0)
                take(big, own - 1) if own > 1 else None
                break
            mate = lengths[at]
            pair, a, b = _best_pair(lengths, count, room)
            two = len(smallest) >= 2 and sum(smallest[:2]) <= room
            three = len(smallest) == 3 and sum(smallest) <= room
            if mate == room or not two or (not three and mate >= pair):
                n = own // 2 if mate == big else min(own, count[mate])
                first = plan.open(n)
                plan.put(big, n, first, 1, 0)
                plan.put(mate, n, first, 1, big)
                take(mate, n)
                take(big, n - 1) if n > 1 else None
            elif not three and pair == room and mate == b and a == _largest_second(lengths, count, room) and big > b > a:
                n = min(own, count[a], count[b])
                first = plan.open(n)
                for k, offset in ((big, 0), (b, big), (a, big + b)):
                    plan.put(k, n, first, 1, offset)
                take(a, n)
                take(b, n)
                take(big, n - 1) if n > 1 else None
            else:
                insert = big not in count or count[big] == 0
                count[big] += 1
                if insert:
                    insort(lengths, big)
                break


def best_fit(count: dict[int, int], capacity: int, plan: Plan) -> None:
    """Best-fit decreasing over the lengths that are left, all documents of a length at once.

    Sequences with the same room and history form a class; a class is filled or
    split as a whole, so work depends on the number of lengths and not of documents.
    """
    rooms: list[int] = []
    classes: dict[int, list[tuple[int, int]]] = {}

    def add(room: int, first: int, n: int) -> None:
        if room not in classes:
            classes[room] = []
            insort(rooms, room)
        classes[room].append((first, n))

    for length in sorted((k for k, n in count.items() if n), reverse=True):
        left = count[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                copies = capacity // length
                full, rest = divmod(left, copies)
                for n, k in ((full, copies), (1 if rest else 0, rest)):
                    if n:
                        first = plan.open(n)
                        plan.put(length, n * k, first, k, 0)
                        if capacity - k * length:
                            add(capacity - k * length, first, n)
                left = 0
                continue
            room = rooms[at]
            first, n = classes[room].pop()
            if not classes[room]:
                del classes[room]
                rooms.pop(at)
            copies = room // length
            full = min(n, left // copies)
            used = 0
            for m, k in ((full, copies), (1 if full < n and left % copies and full == left // copies else 0, left % copies)):
                if m:
                    plan.put(length, m * k, first + used, k, capacity - room)
                    left -= m * k
                    if room - k * length:
                        add(room - k * length, first + used, m)
                    used += m
            if used < n:
                add(room, first + used, n - used)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The runs of a packing of ``histogram`` (length -> documents), lengths from 1 to capacity."""
    plan, count = Plan(), dict(histogram)
    reduce_by_dominance(count, capacity, plan)
    best_fit(count, capacity, plan)
    return plan


PIECES = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32): every document encoded and, if too long, cut.

    Pieces but the first hold ``capacity`` ids; the first holds what is left over.
    """
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared)
        for batch in slices(batches):
            which, piece, start, length, crc = [], [], [], [], []
            for row, value in enumerate(batch.column("t")):
                ids = np.append(encoder.ids(value.as_py()), np.uint32(end)).astype("<u4")
                n = -(-len(ids) // capacity)
                head = len(ids) - (n - 1) * capacity
                at = 0
                for k in range(n):
                    to = head + k * capacity
                    which.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(ids[at:to].tobytes()))
                    at = to
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(cut, T.StructType([rows.schema["id"], *T.StructType.fromDDL(PIECES).fields]))


def assign(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (any columns and ``length``) with sequence_id and offset.

    Ranks within a length are running sums over (length, slice) counts plus a rank
    within the slice, a slice being a partition as written, so no task ever holds
    all documents of a common length.
    """
    spark = parts.sparkSession
    done = cut_lineage(parts.select("*", F.spark_partition_id().alias("_slice")))
    counts = cut_lineage(done.groupBy("length", "_slice").agg(F.count("*").alias("_n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``capacity`` rows
    plan = plan_packing(histogram, capacity)
    before = W.partitionBy("length").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = W.partitionBy("length", "_slice").orderBy(*[c for c in parts.columns if c != "length"])
    ranked = done.withColumn("_rank", F.row_number().over(inside) - 1).join(base, ["length", "_slice"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_base"))
    runs = spark.createDataFrame(plan.runs, "r_length long, r_from long, r_to long, r_first long, r_copies long, r_offset long")
    here = F.col("_rank") - F.col("r_from")
    return ranked.join(
        F.broadcast(runs), (F.col("length") == F.col("r_length")) & (F.col("_rank") >= F.col("r_from")) & (F.col("_rank") < F.col("r_to"))
    ).select(
        *parts.columns,
        (F.col("r_first") + F.floor(here / F.col("r_copies"))).cast("long").alias("sequence_id"),
        (F.col("r_offset") + (here % F.col("r_copies")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Null and empty texts are the end id alone. Repeated rows are packed one by one;
    rows without an id as well. An empty table packs to nothing.
    """
    return assign(pieces(docs, id_col, text, capacity, end, vocabulary), capacity).withColumnRenamed("id", id_col)


def op7_best_fit_packing(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The packing of every document into sequences of at most 1024 ids."""
    return pack(docs.select("doc_id", "text"), vocabulary=vocabulary)
