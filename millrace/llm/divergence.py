"""How sources differ from each other and from their language, by mergeable radix tries of terms.

1. Every task counts the terms of its documents in byte tries, one a language, with
   a counter a source and one of documents at the leaves. Tries that have grown to
   their bound are written out leaf by leaf and begun anew.
2. Leaves are dealt by ranges of (language, term), so a task gets all tries' leaves
   of its prefixes, merges them into tries again and walks those in UTF-8 order.
   Terms of too few documents end here; what is left is written once.
3. With each group's total, a walk over the terms adds up the divergence of every
   two sources of a language and keeps the strongest terms of every group. Sums and
   short lists of the tasks are merged by Spark, ties by the terms' bytes.

Counts are added in tries before anything is shuffled, so a source with a third of
all rows sends no more than others. Totals of the groups go to the tasks in blocks
of bounded size; every two blocks are one pass.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import spread, written
from millrace.llm.words import fold_table, hash_words, numbered, slices
from millrace.session import ship_package

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
#: Terms that a leaf of a trie holds before it branches, and the place of a term that ends at a branching.
BURST = 1024
END = -1
#: Counters that a task's tries hold before they are written out, and the bytes of their terms.
MAX_COUNTERS = 1 << 19
MAX_TERM_BYTES = 32 << 20
#: Leaves that a merging task gets on average.
LEAVES = 250_000
#: Groups whose totals a task of the last walk holds, about; a language's sums take 8 bytes for every two of them.
MAX_GROUPS = 2048
#: Terms times sources handled at a time.
CELLS = 1 << 20
#: Bytes of text handled at a time.
SLICE = 8 << 20
#: All ASCII but letters separates terms.
TABLE = fold_table(bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
LEAF = pa.struct([("source", pa.string()), ("n", pa.int64())])
LEAF_DDL = "lang string, term binary, counts array<struct<source: string, n: long>>"
SUMS_DDL = "lang string, source string, part string, item string, value long, top boolean"
#: Counts up to this keep ``SCALE * (count + 2)`` within 64 bits.
EXACT = 9_000_000_000


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for reference cycles meanwhile: tries have none, and millions of small objects to look through."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class Node:
    """A branching of a trie: what all terms below begin with, and what follows by its first byte (END where nothing does)."""

    __slots__ = ("prefix", "below")

    def __init__(self, prefix: bytes) -> None:
        self.prefix = prefix
        self.below: dict[int, Node | dict] = {}


class Trie:
    """A radix trie of byte strings with counters at its leaves.

    Branchings skip what all their terms share. A leaf is a container of up to
    ``BURST`` terms, which then becomes a branching. A term's counters are its
    occurrences by source, and its documents under None.
    """

    def __init__(self) -> None:
        self.top: Node | dict = {}

    def counters(self, term: bytes) -> dict[str | None, int]:
        """The counters of ``term``, made if there are none."""
        parent, byte, node = None, END, self.top
        while type(node) is Node:
            if not term.startswith(node.prefix):
                node = self._hang(parent, byte, self._split(node, term))
            parent, at = node, len(node.prefix)
            byte = term[at] if at < len(term) else END
            node = parent.below.get(byte)
            if node is None:
                node = parent.below[byte] = {}
        found = node.get(term)
        if found is None:
            found = node[term] = {}
            if len(node) > BURST:
                self._hang(parent, byte, self._burst(node))
        return found

    def _hang(self, parent: Node | None, byte: int, node: Node) -> Node:
        if parent is None:
            self.top = node
        else:
            parent.below[byte] = node
        return node

    @staticmethod
    def _split(node: Node, term: bytes) -> Node:
        """A branching above ``node`` where ``term`` leaves its prefix."""
        upper = Node(_shared(node.prefix, term))
        upper.below[node.prefix[len(upper.prefix)]] = node
        return upper

    @staticmethod
    def _burst(terms: dict) -> Node:
        node = Node(_shared(min(terms), max(terms)))
        at = len(node.prefix)
        for term, counters in terms.items():
            node.below.setdefault(term[at] if at < len(term) else END, {})[term] = counters
        return node

    def walk(self) -> Iterator[tuple[bytes, dict[str | None, int]]]:
        """(term, counters) in the order of the terms' bytes."""
        path = [self.top]
        while path:
            node = path.pop()
            if type(node) is Node:
                path.extend(child for _, child in sorted(node.below.items(), key=lambda kv: kv[0], reverse=True))
            else:
                yield from sorted(node.items(), key=lambda kv: kv[0])


def _shared(a: bytes, b: bytes) -> bytes:
    """What both begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:  # halving, as long terms share long beginnings
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[:low]


class Tries:
    """A trie a language, within the bounds of a task."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.by_lang: dict[str, Trie] = {}
        self.held = self.bytes = 0

    @property
    def full(self) -> bool:
        return self.held > MAX_COUNTERS or self.bytes > MAX_TERM_BYTES

    def add(self, lang: str, term: bytes, sources: Sequence[str | None], times: Sequence[int]) -> None:
        trie = self.by_lang.get(lang)
        if trie is None:
            trie = self.by_lang[lang] = Trie()
        have = trie.counters(term)
        if not have:
            have.update(zip(sources, times))
            self.held += len(have)
            self.bytes += len(term)
            return
        before = len(have)
        for source, n in zip(sources, times):
            have[source] = have.get(source, 0) + n
        self.held += len(have) - before

    def merge(self, batch: pa.RecordBatch) -> None:
        """Adds the leaves of other tries."""
        sources, times, at = _entries(batch)
        sources, times, at = _names(sources), times.to_numpy().tolist(), at.to_numpy().tolist()
        for lang, term, a, b in zip(_names(batch.column("lang")), _bytes(batch.column("term")), at, at[1:]):
            self.add(lang, term, sources[a:b], times[a:b])

    def leaves(self, min_docs: int = 0, rows: int = 8192) -> Iterator[pa.RecordBatch]:
        """The leaves in order; the empty term, which stands for its language's groups, always stays."""
        for lang in sorted(self.by_lang, key=str.encode):
            terms, sources, times, at = [], [], [], [0]
            for term, have in self.by_lang[lang].walk():
                if term and have[None] < min_docs:
                    continue
                terms.append(term)
                sources.extend(have)
                times.extend(have.values())
                at.append(len(times))
                if len(terms) == rows:
                    yield _leaves(lang, terms, sources, times, at)
                    terms, sources, times, at = [], [], [], [0]
            if terms:
                yield _leaves(lang, terms, sources, times, at)


def _leaves(lang: str, terms: list, sources: list, times: list, at: list) -> pa.RecordBatch:
    entries = pa.StructArray.from_arrays([pa.array(sources, pa.string()), pa.array(times, pa.int64())], fields=list(LEAF))
    columns = [pa.array([lang] * len(terms), pa.string()), pa.array(terms, pa.binary()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), entries)]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "counts"])


def _names(column: pa.Array) -> list[str | None]:
    """The values of a column with few different ones, each made once."""
    known = column.dictionary_encode()
    values = [*known.dictionary.to_pylist(), None]
    return [values[i] for i in known.indices.fill_null(-1).to_numpy().tolist()]


def _bytes(column: pa.Array) -> list[bytes]:
    """The values of a binary column, made in one go."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _entries(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(sources, numbers, offsets) of the counters of a batch of leaves."""
    lists = batch.column("counts")
    return lists.values.field(0), lists.values.field(1), lists.offsets


def _starts(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)


def _count(batch: pa.RecordBatch, tries: Tries) -> None:
    """Adds the terms of a batch (lang, source, t) and its groups."""
    at, _, starts, ends, data = hash_words(batch.column("t"), TABLE, 0)
    pairs = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
    groups = sorted(set(pairs))
    for lang, source in groups:
        tries.add(lang, b"", (source,), (0,))
    if not len(starts):
        return
    number, different = numbered(TABLE[data], starts, ends)
    terms, n = _bytes(different), len(different)
    # occurrences of a term in a row, then in a group; both by sorting numbers
    cell, times = np.unique(np.repeat(np.arange(len(at) - 1), np.diff(at)) * n + number, return_counts=True)
    index = {g: i for i, g in enumerate(groups)}
    group = np.array([index[p] for p in pairs], np.int64)[cell // n]
    langs = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in groups))}
    lang_of = np.array([langs[lang] for lang, _ in groups], np.int64)
    key = (lang_of[group] * n + cell % n) * len(groups) + group
    order = np.argsort(key)
    key, times = key[order], times[order]
    spot = _starts(key)
    total, docs = np.add.reduceat(times, spot).tolist(), np.diff(np.r_[spot, len(key)])
    owner = key[spot] // len(groups)
    lead = _starts(owner)
    docs, owner = np.add.reduceat(docs, lead).tolist(), owner[lead]
    by_number, names = [source for _, source in groups], list(langs)
    sources = [by_number[g] for g in (key[spot] % len(groups)).tolist()]
    for o, w, d, a, b in zip((owner // n).tolist(), (owner % n).tolist(), docs, lead.tolist(), [*lead[1:].tolist(), len(total)]):
        tries.add(names[o], terms[w], [*sources[a:b], None], [*total[a:b], d])


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, counts) of every term in at least ``min_docs`` documents of a language, written once.

    ``term`` is its bytes; ``counts`` lists its occurrences by source, and under the
    null source the number of its documents in the language. The empty term of a
    language lists all its sources, with 0.
    """
    ship_package(docs.sparkSession)
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = Tries()
        with uncollected():
            for batch in slices(batches, SLICE):
                _count(batch, tries)
                if tries.full:
                    yield from tries.leaves()
                    tries.clear()
            yield from tries.leaves()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = Tries()
        with uncollected():
            for batch in batches:
                tries.merge(batch)
            yield from tries.leaves(min_docs)

    parts = written(rows.mapInArrow(count, LEAF_DDL))
    tasks = max(spread(docs.sparkSession), -(-parts.count() // LEAVES))
    return written(parts.repartitionByRange(tasks, "lang", "term").mapInArrow(merge, LEAF_DDL))


def totals(kept: DataFrame) -> DataFrame:
    """(lang, source, n, v, all) of every group: its occurrences of kept terms, the language's kept terms and occurrences."""
    counts = kept.select("lang", F.explode("counts").alias("c")).where("c.source is not null")
    groups = counts.groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count(F.when(F.octet_length("term") > 0, 1)).alias("v")).join(groups.groupBy("lang").agg(F.sum("n").alias("all")), "lang")
    return written(groups.join(sizes, "lang"))


def share(count: np.ndarray, total: int, v: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 v)), exact for counts of any size."""
    big = count if count.size == 0 or int(count.max()) <= EXACT and total + 2 * v < 1 << 62 else count.astype(object)
    return (1 + SCALE * (big + 2) // (total + 2 * v)).astype(np.int64)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so the square fits."""
    d = p - q
    return d * d // (p + q)


class Walker:
    """What a task adds up over the terms: pairs of sources, and every group's strongest terms."""

    def __init__(self, left: dict, right: dict, same: bool, top: int):
        self.left, self.right, self.same, self.top = left, right, same, top
        self.sums: dict[str, np.ndarray] = {}
        self.best: dict[tuple[str, str], list[tuple[int, bytes]]] = {}

    def add(self, lang: str, leaves: pa.RecordBatch) -> None:
        """Leaves of one language."""
        mine, other = self.left.get(lang), self.right.get(lang)
        if mine is None or other is None:
            return
        sums = self.sums.setdefault(lang, np.zeros((len(mine["at"]), len(other["at"])), np.int64))
        width = max(1, CELLS // max(len(mine["at"]), len(other["at"])))
        for a in range(0, len(leaves), width):
            terms = leaves.column("term").slice(a, width).to_pylist()
            names, times, at = (x.to_pylist() for x in _entries(leaves.slice(a, width)))
            entries = [(i, names[k], times[k]) for i in range(len(terms)) for k in range(at[i], at[i + 1]) if terms[i] and names[k] is not None]
            count = self._table(mine, entries, len(terms))
            real = np.array([bool(t) for t in terms])
            p = self._shares(mine, count)
            q = p if self.same else self._shares(other, self._table(other, entries, len(terms)))
            for i in range(p.shape[1]):
                for j in range(i + 1 if self.same else 0, q.shape[1]):
                    sums[i, j] += int(apart(p[real, i], q[real, j]).sum())
            if self.same:
                total = np.zeros(len(terms), np.int64)
                np.add.at(total, [i for i, _, _ in entries], [n for _, _, n in entries])
                self._strongest(lang, mine, terms, count, p, share(total, mine["all"], mine["v"]))

    @staticmethod
    def _table(side: dict, entries: list[tuple[int, str, int]], rows: int) -> np.ndarray:
        out, at = np.zeros((rows, len(side["at"])), np.int64), side["at"]
        for i, source, n in entries:
            if source in at:
                out[i, at[source]] = n
        return out

    @staticmethod
    def _shares(side: dict, count: np.ndarray) -> np.ndarray:
        return np.stack([share(count[:, k], side["n"][k], side["v"]) for k in range(count.shape[1])], axis=1)

    def _strongest(self, lang: str, side: dict, terms: list[bytes], count: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
        for source, k in side["at"].items():
            seen = np.flatnonzero((count[:, k] > 0) & (p[:, k] > q))
            f = apart(p[seen, k], q[seen])
            if len(f) > self.top:  # only what reaches the value of rank ``top``; ties are told apart below
                strong = f >= np.partition(f, len(f) - self.top)[len(f) - self.top]
                seen, f = seen[strong], f[strong]
            have = self.best.setdefault((lang, source), [])
            have.extend((-int(x), terms[i]) for x, i in zip(f, seen))
            have.sort()
            del have[self.top :]

    def rows(self) -> Iterator[pa.RecordBatch]:
        out = []
        for lang, sums in self.sums.items():
            for a, i in self.left[lang]["at"].items():
                for b, j in self.right[lang]["at"].items():
                    if i < j or not self.same:
                        out.append((lang, a, "pair", b, int(sums[i, j]), False))
                        out.append((lang, b, "pair", a, int(sums[i, j]), False))
        for (lang, source), best in self.best.items():
            out.extend((lang, source, "term", term.decode(), -value, True) for value, term in best)
        names = ("lang", "source", "part", "item", "value", "top")
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_())
        for a in range(0, len(out), 1 << 14):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[a : a + (1 << 14)]), kinds)], names=list(names))


def _side(groups: DataFrame, block: int) -> dict:
    """The groups of one block by language, for the tasks."""
    out: dict[str, dict] = {}
    for r in groups.where(F.col("block") == block).orderBy("lang", "source").collect():  # about MAX_GROUPS rows
        side = out.setdefault(r["lang"], {"at": {}, "n": [], "v": r["v"], "all": r["all"]})
        side["at"][r["source"]] = len(side["n"])
        side["n"].append(r["n"])
    return out


def divergences(kept: DataFrame, top: int = TOP, max_groups: int = MAX_GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank) from the counts of :func:`term_counts`.

    Part pair: every other source of the language, by the sum of f over its kept
    terms. Part term: the ``top`` kept terms that stand out most against the
    language. Ranks go by value descending, then by the item's bytes. Groups are
    dealt to blocks by hash, about ``max_groups`` each; each two blocks are a pass.
    """
    spark = kept.sparkSession
    groups = totals(kept)
    blocks = max(1, -(-groups.count() // max_groups))
    groups = groups.withColumn("block", F.pmod(F.xxhash64("lang", "source"), F.lit(blocks)).cast("int"))
    passes = None
    for x in range(blocks):
        left = _side(groups, x)
        for y in range(x, blocks):
            right = left if y == x else _side(groups, y)
            sides = spark.sparkContext.broadcast((left, right))

            def walk(batches: Iterator[pa.RecordBatch], sides=sides, same=x == y) -> Iterator[pa.RecordBatch]:
                walker = Walker(*sides.value, same, top)
                for batch in slices(batches, SLICE):
                    langs = batch.column("lang").to_pylist()
                    cuts = [i for i in range(len(langs)) if i == 0 or langs[i] != langs[i - 1]]
                    for a, b in zip(cuts, [*cuts[1:], len(langs)]):
                        walker.add(langs[a], batch.slice(a, b - a))
                yield from walker.rows()

            done = kept.select("lang", "term", "counts").mapInArrow(walk, SUMS_DDL)
            passes = done if passes is None else passes.unionByName(done)
    found = written(passes)
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = found.where("not top").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(by_value))
    terms = found.where("top").drop("top").withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)


def op13_source_divergence(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) over all rows of documents.

    Null lang, source and text count as empty; a group without terms still has its
    pairs; a language without kept terms has pairs of value 0; a language with one
    source has no pairs. Repeated rows are documents of their own; other columns are
    ignored; an empty table gives no rows.
    """
    return divergences(term_counts(docs.select("lang", "source", "text")))
