"""Entity linking: merges, lookups and matches that Spark joins on keys, never by comparing everything."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from millrace.session import ship_package
from millrace.streaming.files import shared_folder


def some(column: str | Column) -> Column:
    """A value, or null where it is the empty string."""
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(""))


def first_filled(*columns: str | Column) -> Column:
    """The first value that isn't null or empty; empty if there is none."""
    return F.coalesce(*[some(c) for c in columns], F.lit(""))


def project(df: DataFrame, synonyms: dict[str, list[str]], constants: dict[str, str] | None = None) -> DataFrame:
    """The unified columns of a source: for each, the first filled of the source's synonyms that it has."""
    constants = constants or {}
    have = set(df.columns)
    out = []
    for name, names in synonyms.items():
        own = [F.col(n).cast("string") for n in names if n in have]
        out.append((F.lit(constants[name]) if name in constants else first_filled(*own) if own else F.lit("")).alias(name))
    return df.select(*out)


def union_sources(sources: list[DataFrame], seq: str = "source_seq") -> DataFrame:
    """All rows of all sources, each marked with its source's place; missing columns are null."""
    out = None
    for i, df in enumerate(sources):
        df = df.withColumn(seq, F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def merge_entities(rows: DataFrame, keys: list[str], empty_key: Column, order: list[str], values: list[str], provenance: str, sep: str = "+") -> DataFrame:
    """One row an entity: the first filled value of every column in source order, and all provenance, sorted.

    Rows whose key is empty are entities of their own. One shuffle, on the key; the
    values are minima of small structs, so they're combined before it.
    """
    own = rows.withColumn("_own", F.when(empty_key, F.struct(*order)))
    at = F.struct(*order)
    pick = [F.coalesce(F.min_by(some(v), F.when(some(v).isNotNull(), at)), F.lit("")).alias(v) for v in values]
    labels = F.array_join(F.array_sort(F.collect_set(provenance)), sep)
    return own.groupBy(*keys, "_own").agg(*pick, labels.alias(provenance), F.count("*").alias("n")).drop("_own")


def unique_key_join(left: DataFrame, right: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Left join on keys that one right row alone has; ambiguous keys match nothing."""
    single = right.groupBy(key).agg(F.count("*").alias("_n"), *[F.first(v).alias(v) for v in values]).where("_n = 1").drop("_n")
    return left.join(single, key, "left")


def last_write(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """(key, value) with the last value written for each key."""
    return df.groupBy(key).agg(F.max_by(value, seq).alias(value))


def fill_from(left: DataFrame, right: DataFrame, key: str, columns: list[str], note: tuple[str, str] | None = None) -> DataFrame:
    """Empty values of ``left`` filled from the row of ``right`` with the same key; a label is appended where one was."""
    twin = right.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    out = left.join(twin, key, "left")
    filled = [some(c).isNull() & some(f"_{c}").isNotNull() for c in columns]
    if note:
        any_filled = filled[0]
        for f in filled[1:]:
            any_filled = any_filled | f
        out = out.withColumn(note[0], F.when(any_filled, F.concat(F.col(note[0]), F.lit(note[1]))).otherwise(F.col(note[0])))
    for c in columns:
        out = out.withColumn(c, first_filled(c, f"_{c}"))
    return out.drop(*[f"_{c}" for c in columns])


def with_best(left: DataFrame, right: DataFrame, key: str, order: list, item: Column, most: int = 5) -> DataFrame:
    """Every left row with its best right item and up to ``most - 1`` others, best first."""
    best = right.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(*order))).where(F.col("_rn") <= most)
    packed = best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_rn", item.alias("item")))).alias("_all"))
    items = F.transform("_all", lambda x: x["item"])
    return left.join(packed, key, "left").withColumn("best", F.try_element_at(items, F.lit(1))).withColumn("others", F.slice(items, 2, most - 1)).drop("_all")


def prefix_pairs(left: DataFrame, right: DataFrame, a: str, b: str, least: int = 3) -> DataFrame:
    """Pairs where one name begins with the other, both of at least ``least`` letters.

    Each distinct name looks its own beginnings up by equality, so only pairs that
    hold are made, however many names share their first letters.
    """

    def begins(long: DataFrame, name: str, short: DataFrame, other: str) -> DataFrame:
        names = long.select(name).distinct().where(F.length(name) >= least)
        starts = names.select(name, F.explode(F.transform(F.sequence(F.lit(least), F.length(name)), lambda n: F.left(F.col(name), n))).alias(other))
        return starts.join(short.select(other).distinct(), other).select(a, b)

    pairs = begins(left, a, right, b).unionByName(begins(right, b, left, a)).distinct()
    return left.join(pairs, a).join(right, b)


def token_pairs(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs where the words of one name stand in the other side by side, met on the rarer of their words.

    A contained name has all its words in the other, so it is enough to meet on the
    one word of each that is rarest on both sides together.
    """
    words = left.select(F.explode(F.array_distinct(F.split(a, " "))).alias("_w")).unionByName(right.select(F.explode(F.array_distinct(F.split(b, " "))).alias("_w")))
    rarity = words.where("_w <> ''").groupBy("_w").agg(F.count("*").alias("_df"))

    def rarest(df: DataFrame, name: str, ids: str) -> DataFrame:
        exploded = df.select(name, F.explode(F.array_distinct(F.split(name, " "))).alias("_w")).where("_w <> ''").distinct().join(rarity, "_w")
        return exploded.groupBy(name).agg(F.min_by("_w", F.struct("_df", "_w")).alias("_w"))

    padded = lambda c: F.concat(F.lit(" "), F.col(c), F.lit(" "))
    names_a, names_b = left.select(a).distinct(), right.select(b).distinct()
    all_a = names_a.select(a, F.explode(F.array_distinct(F.split(a, " "))).alias("_w"))
    all_b = names_b.select(b, F.explode(F.array_distinct(F.split(b, " "))).alias("_w"))
    b_in_a = all_a.join(rarest(names_b, b, b), "_w").where(F.contains(padded(a), padded(b))).select(a, b)
    a_in_b = all_b.join(rarest(names_a, a, a), "_w").where(F.contains(padded(b), padded(a))).select(a, b)
    return b_in_a.unionByName(a_in_b).distinct()


def name_index(rows: DataFrame, key: str, least: int = 5) -> DataFrame:
    """The rows that a name may be looked up in: those whose key is long enough to tell companies apart."""
    return rows.where(F.char_length(key) >= least)


def merge_by_tokens(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """(b, a, n, error) of every distinct right name: merged with the one left name that it contains or is part of.

    With several such names or none, it is a row of its own; several are an error
    for somebody to look at, listed up to 200 characters.
    """
    pairs = token_pairs(left, right, a, b)
    found = pairs.groupBy(b).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(a)).alias("_all"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return right.select(b).distinct().join(found, b, "left").select(
        b, F.when(n == 1, F.col("_all")[0]).alias(a), n.alias("n"),
        F.when(n > 1, F.left(F.concat(F.lit("several: "), F.array_join("_all", " / ")), F.lit(200))).otherwise("").alias("error"),
    )


def cascade(left: DataFrame, right: DataFrame, group: str, kinds: list[tuple[Column, Column]], new: str, old: str) -> DataFrame:
    """(new, old, priority): the best of several kinds of match inside a group, earlier kinds first, then the smallest ``old``.

    A kind is a pair of expressions, one a side, that must be equal. Only the
    smallest ``old`` of a group and key can win, so the right side is reduced to it
    before it is joined: every left row meets one row a kind, whatever the groups' sizes.
    """
    matches = []
    for mine, theirs in kinds:
        best = right.select(group, theirs.alias("_k"), old).groupBy(group, "_k").agg(F.min(old).alias(old))
        matches.append(left.select(group, mine.alias("_k"), new).join(best, [group, "_k"]).select(new, old))
    every = union_sources(matches, "priority")
    return every.groupBy(new).agg(F.min(F.struct("priority", old)).alias("_best")).select(new, f"_best.{old}", "_best.priority")


def longest_suffix(df: DataFrame, text: Column, dim: DataFrame, suffix: str, value: str, name: str) -> DataFrame:
    """``name``: the value of the longest suffix of a dimension that a text ends with, else null.

    Each distinct text looks its own suffixes up by equality: the distinct lengths
    of the dimension are few, so a text has few candidates. Whether the dimension is
    broadcast is left to Spark, which knows its size. Empty suffixes fit nothing.
    """
    dim = dim.where(F.length(suffix) > 0)
    lengths = [r[0] for r in dim.select(F.length(suffix)).distinct().collect()]  # one number a length
    texts = df.select(text.alias("_text")).distinct()
    ends = texts.select("_text", F.explode(F.array_distinct(F.array(*[F.right(F.col("_text"), F.lit(n)) for n in lengths]))).alias(suffix)) if lengths else texts.select("_text", F.lit("").alias(suffix))
    hits = ends.join(dim.select(suffix, value), suffix).groupBy("_text").agg(F.max_by(value, F.length(suffix)).alias(name))
    return df.withColumn("_text", text).join(hits, "_text", "left").drop("_text")


#: Most ranges that are sent whole to every executor.
MAX_BROADCAST_RANGES = 10_000


def in_ranges(df: DataFrame, column: str, ranges: DataFrame, most: int = MAX_BROADCAST_RANGES) -> DataFrame:
    """Left join with ranges [lo, hi], which may overlap and have finite ends.

    Up to ``most`` ranges are broadcast. Beyond that they meet the distinct values by
    equality: a range lies in at most two bins of the power of two next to its
    width, and a value looks into one bin of each width that occurs.
    """
    if ranges.limit(most + 1).count() <= most:
        return df.join(F.broadcast(ranges), F.col(column).between(F.col("lo"), F.col("hi")), "left")
    bin_of = lambda x, level: F.floor(x / F.pow(F.lit(2.0), level))
    level = F.ceil(F.log2(F.greatest(F.col("hi") - F.col("lo"), F.lit(1)))).cast("int")
    binned = ranges.where("lo <= hi").withColumn("_level", level)
    levels = [r[0] for r in binned.select("_level").distinct().collect()]  # at most one for each power of two
    binned = binned.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("lo"), F.col("_level")), bin_of(F.col("hi"), F.col("_level")))))
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    values = values.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))).withColumn("_bin", bin_of(F.col(column), F.col("_level")))
    met = values.join(binned, ["_level", "_bin"]).where(F.col(column).between(F.col("lo"), F.col("hi"))).drop("_level", "_bin")
    return df.join(met, column, "left")


def reconcile(declared: DataFrame, obtained: DataFrame, key: str) -> DataFrame:
    """(key, declared, obtained, missing, ok): counts side by side; an undeclared key is fine."""
    both = declared.join(obtained, key, "full_outer")
    have = F.coalesce("obtained", F.lit(0).cast("long"))
    return both.select(key, "declared", have.alias("obtained"), F.greatest(F.coalesce("declared", F.lit(0)) - have, F.lit(0)).cast("long").alias("missing"), (F.col("declared").isNull() | (F.col("declared") <= have)).alias("ok"))


def recall(reference: DataFrame, run: DataFrame, key: str) -> DataFrame:
    """One row: common, missed, new and the share found, over distinct keys."""
    both = reference.select(key).distinct().withColumn("_r", F.lit(1)).join(run.select(key).distinct().withColumn("_f", F.lit(1)), key, "full_outer")
    common = F.count_if(F.col("_r").isNotNull() & F.col("_f").isNotNull())
    n = F.count("_r")
    return both.agg(common.alias("common"), F.count_if(F.col("_f").isNull()).alias("missed"), F.count_if(F.col("_r").isNull()).alias("new"), F.round(F.try_divide(common, n), 3).alias("recall"))


#: 64-bit words of the bitmap that goes with a set of tokens.
WORDS = 4


def _prefix_elsewhere(items: DataFrame, key: str | list[str], owner: str, tokens: str, least: int) -> DataFrame:
    """(key, others): as :func:`similar_elsewhere`, for any number of tokens.

    A prefix join, exact: with tokens ordered by rarity, the same order for all, two
    sets of a and b tokens that share ``least`` share one of the first a - least + 1
    and b - least + 1. So a set meets others by those alone, never by its most
    frequent ones, and what meets is counted in full. Items of one owner with the
    same tokens are one set. Sets of frequent tokens only meet many; those joins are
    plain ones on a token, which AQE splits.
    """
    keys = [key] if isinstance(key, str) else key
    classed = items.select(*keys, owner, F.array_sort(F.array_distinct(tokens)).alias("_a")).where(F.size("_a") >= least)
    name = [F.xxhash64(owner, "_a").alias("_x"), F.xxhash64(F.lit(7), F.col(owner), F.col("_a")).alias("_y")]
    held = classed.select(owner, "_a").distinct().select(*name, owner, F.explode("_a").alias("_t"))
    ordered = held.join(held.groupBy("_t").agg(F.count("*").alias("_n")), "_t").groupBy("_x", "_y", owner).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_t"))), lambda p: p["_t"]).alias("_o"))
    # a bitmap of the tokens: where one side's tokens have bits of their own, common bits bound common tokens
    bit = F.transform("_o", lambda t: F.pmod(F.xxhash64(t), F.lit(64 * WORDS)))
    word = lambda k: F.aggregate(F.filter(bit, lambda x: F.floor(x / 64) == k), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), (x % 64).cast("int"))))
    words = [word(k).alias(f"_w{k}") for k in range(WORDS)]
    marked = ordered.select("_x", "_y", owner, "_o", *words, (F.size(F.array_distinct(bit)) == F.size("_o")).alias("_own"))
    prefix = marked.withColumn("_t", F.explode(F.slice("_o", 1, F.size("_o") - least + 1)))
    other = prefix.select("_t", *[F.col(c).alias(f"_2{c}") for c in (owner, "_o", "_own", *(f"_w{k}" for k in range(WORDS)))])
    common = reduce(add, [F.bit_count(F.col(f"_w{k}").bitwiseAND(F.col(f"_2_w{k}"))) for k in range(WORDS)])
    possible = (F.col(owner) != F.col(f"_2{owner}")) & ((common >= least) | ~(F.col("_own") | F.col("_2_own")))
    # a set is named by its own hash only, and of another one just the owner comes out
    met = prefix.join(other, "_t").where(possible & (F.size(F.array_intersect("_o", "_2_o")) >= least)).select("_x", "_y", F.col(f"_2{owner}").alias("_other")).distinct()
    found = met.groupBy("_x", "_y").agg(F.count("*").alias("others"))
    return classed.select(*keys, *name).join(found, ["_x", "_y"]).select(*keys, "others")


#: Owners of one bitmap; most owners and tokens whose numbers are broadcast; most sets a token may be in for its group to meet in a task; triples held at a time there.
BITS, MAX_BROADCAST_OWNERS, MAX_BROADCAST_TOKENS, MAX_GROUP, MAX_TRIPLES = 63, 100_000, 2_000_000, 1_000_000, 1_000_000
#: Tokens that a bucket of groups takes, about; bytes of a table's dictionary of tokens; the largest number of 32 bits.
MAX_BUCKET, MAX_DICTIONARY, LAST = 2_000_000, 8 << 20, (1 << 31) - 1
#: Places of a table of pairs for each that is there, at most.
SPARSE = 32


def _sorted_places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 on in their order, and the places they had; sorted as one number each where 63 bits hold both, since that takes a fourth of the time."""
    shift = len(values).bit_length()
    if not len(values) or int(values.max()) >> (63 - shift):
        order = np.argsort(values, kind="stable")
        return values[order], order
    both = np.sort((values << shift) | np.arange(len(values)))
    return both >> shift, both & ((1 << shift) - 1)


def _shared_pairs(group: np.ndarray, owner: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, most: int = MAX_TRIPLES) -> Iterator[tuple[int, np.ndarray]]:
    """(block, bits a row): the other owners in a row's group with a row that has two of its tokens, in whatever row of theirs; blocks are of ``BITS`` owners."""
    if not len(tokens):
        return
    row = np.repeat(np.arange(len(group)), sizes)
    width = int(tokens.max()) + 1
    key, order = _sorted_places(group[row] * np.int64(width) + tokens)
    new = np.diff(key, prepend=-1) != 0
    starts = np.flatnonzero(new)
    of = owner[row[order]]
    several = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
    # a token that one owner alone has in a group finds nobody
    of = key[starts][several] // width
    behind = np.searchsorted(of, of, side="right") - np.arange(len(of)) - 1  # a kept pair of group and token, numbered in order: those that follow in its group
    kept, pair = np.empty(len(key), bool), np.empty(len(key), np.int64)
    several, new = np.repeat(several, np.diff(starts, append=len(key))), np.cumsum(several) - 1
    kept[order], pair[order] = several, np.repeat(new, np.diff(starts, append=len(key)))
    order = (np.cumsum(kept) - 1)[order[several]]
    row, pair = row[kept], pair[kept]
    after = np.cumsum(np.bincount(row, minlength=len(group)))[row] - np.arange(len(row)) - 1
    order = order[after[order] > 0]
    if not len(order):
        return
    blocks = np.unique(owner // BITS)
    found = {block: np.zeros(len(group), np.int64) for block in blocks.tolist()}
    own = {block: np.where(owner // BITS == block, np.int64(1) << (owner % BITS), 0) for block in found}
    # a table of all that may follow, where that isn't much more than what does; else sorting
    tabled = (behind <= SPARSE * np.bincount(pair[order], after[order], minlength=len(behind)))[pair[order]]
    for table in (True, False):
        mine = order[tabled == table]
        if not len(mine):
            continue
        # parts that end where a pair of group and token does, so that a task holds few triples at a time
        ends = np.append(np.flatnonzero(np.diff(pair[mine])) + 1, len(mine))
        upto = np.cumsum(after[mine])[ends - 1] + table * np.cumsum(behind[pair[mine[ends - 1]]]) // 8
        cuts = ends[np.append(np.flatnonzero(np.diff(upto // most)), len(ends) - 1)]
        for first, last in zip(np.append(0, cuts[:-1]), cuts):
            part = mine[first:last]
            n, of, p = after[part], row[part], pair[part]
            begin = np.cumsum(n) - n
            new = np.diff(p, prepend=-1) != 0
            room = np.cumsum(behind[p[new]])
            place = np.repeat((room - behind[p[new]])[np.cumsum(new) - 1] - p - 1, n) + pair[np.repeat(part + 1 - begin, n) + np.arange(n.sum())]
            if not table:
                ranks, by = _sorted_places(place)
                starts = np.flatnonzero(np.diff(ranks, prepend=-1))
                place[by] = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(by)))
            for block, bits in found.items():
                every = np.zeros(room[-1] if table else len(starts), np.int64)
                np.bitwise_or.at(every, place, np.repeat(own[block][of], n))
                np.bitwise_or.at(bits, of, np.bitwise_or.reduceat(every[place], begin))
    for block, bits in found.items():
        yield block, bits & ~own[block]


def _rows_upto(batches: Iterator[pa.RecordBatch], column: str, least: int) -> Iterator[pa.Table]:
    """Tables of at least so many rows, the last one aside, that don't part neighbours with the same number in a column."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < least:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        number = rows[column].to_numpy()
        others = np.flatnonzero(number != number[-1])
        stop = int(others[-1]) + 1 if len(others) else 0
        if stop:
            yield rows.slice(0, stop)
        held = rows.slice(stop).to_batches()
        n -= stop
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _packed(*numbers: np.ndarray) -> bytes:
    """Numbers compressed: of each array all first bytes, then all second ones and so on, since like bytes compress well."""
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in numbers]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(data: bytes, *kinds: tuple[int, type]) -> list[np.ndarray]:
    """What :func:`_packed` took: (length, dtype) of each array."""
    lengths = [n * np.dtype(kind).itemsize for n, kind in kinds]
    raw = np.frombuffer(pa.decompress(data, sum(lengths), codec="zstd"), np.uint8)
    parts = np.split(raw, np.cumsum(lengths)[:-1])
    return [np.ascontiguousarray(x.reshape(-1, n).T).view(kind).ravel() if n else np.empty(0, kind) for x, (n, kind) in zip(parts, kinds)]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(keys, owner, _j, _i), an item's rows together, to (keys, owner, _j, _o): an item's numbers, rarest first, where it has three.

    A copy, the same numbers of the same owner met shortly before, has that one's ``_j`` and no numbers.
    """
    for rows in _rows_upto(batches, "_j", 1_000_000):
        number = rows["_j"].to_numpy()
        begins = np.flatnonzero(np.diff(number, prepend=number[0] - 1))
        row = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(number)))
        key = np.unique((row << 32) | (LAST - rows["_i"].to_numpy().astype(np.int64)))
        row, token = key >> 32, (LAST - (key & LAST)).astype(np.int32)
        sizes = np.bincount(row, minlength=len(begins))
        token, begins, sizes = token[sizes[row] >= 3], begins[sizes >= 3], sizes[sizes >= 3]
        items = rows.drop_columns(["_j", "_i"]).take(pa.array(begins))
        owner = items.column(items.num_columns - 1).combine_chunks().dictionary_encode()
        owners = (owner.chunk(0) if isinstance(owner, pa.ChunkedArray) and owner.num_chunks else owner).indices.to_pylist() if len(begins) else []
        data, ends = token.tobytes(), (np.cumsum(sizes) * token.itemsize).tolist()
        seen: dict[tuple[int, bytes], int] = {}
        of = np.array([seen.setdefault((o, data[a:b]), k) for k, (o, a, b) in enumerate(zip(owners, [0, *ends], ends))], np.int64)
        first = of == np.arange(len(of))
        offsets = np.append(0, np.cumsum(np.where(first, sizes, 0))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(token[np.repeat(first, sizes)]), mask=pa.array(~first))
        yield from items.append_column("_j", pa.array(number[begins][of])).append_column("_o", lists).combine_chunks().to_batches()


def _deal(batches: Iterator[pa.RecordBatch], buckets: int, often: int) -> Iterator[pa.RecordBatch]:
    """(_j, _w, _o) to packed (_b, _n, _m, _data): a set goes to each of its tokens that has two behind it, with those; tokens numbered below ``often`` take none.

    A bucket has whole tokens. Of what lies behind a token only the steps from one number to the next are written.
    """
    for rows in _rows_upto(batches, "_j", 100_000):
        lists = rows["_o"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        number, owner = rows["_j"].to_numpy(), rows["_w"].to_numpy().astype(np.int32)
        token, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(sizes)), sizes)
        after = (np.cumsum(sizes)[row] - np.arange(len(row)) - 1).astype(np.int32)
        step = -np.diff(token, prepend=0).astype(np.int32)
        head = np.flatnonzero((after >= 2) & (token >= often))
        head = head[np.lexsort((token[head], token[head] % buckets))]
        bucket = token[head] % buckets
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        out = []
        for first, last in zip(starts, np.append(starts[1:], len(head))):
            part = head[first:last]
            n = after[part]
            begin = np.cumsum(n) - n
            behind = step[np.repeat(part + 1 - begin, n) + np.arange(n.sum())]
            group = np.diff(token[part] // buckets, prepend=0).astype(np.int32)
            out.append((int(bucket[first]), len(part), len(behind), _packed(group, number[row[part]], owner[row[part]], n, behind)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["_b", "_n", "_m", "_data"])


def _joined(number: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row for each number and block, in their order, with all bits."""
    order = np.lexsort((block, number))
    number, block, bits = number[order], block[order], bits[order]
    starts = np.flatnonzero((np.diff(number, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    return number[starts], block[starts], np.bitwise_or.reduceat(bits, starts) if len(starts) else bits


def _meet(rows: pa.Table, shift: int) -> pa.Table:
    """A bucket's sets to packed (_r, _n, _data): bitmaps of the owners that each meets there, by range of its number; some 500,000 tokens at a time."""
    packed = zip(rows["_data"].to_pylist(), rows["_n"].to_pylist(), rows["_m"].to_pylist())
    parts = [_unpacked(data, (n, np.int32), (n, np.int64), (n, np.int32), (n, np.int32), (m, np.int32)) for data, n, m in packed]
    group, number, owner, sizes, step = (np.concatenate(x) for x in zip(*[[np.cumsum(p[0]), *p[1:]] for p in parts]))
    del parts
    order = np.argsort(group, kind="stable")
    begin = (np.cumsum(sizes) - sizes)[order]
    group, number, owner, sizes = group[order], number[order], owner[order].astype(np.int64), sizes[order]
    upto = np.cumsum(sizes)
    ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group))
    cuts = ends[np.append(np.flatnonzero(np.diff(upto[ends - 1] // 500_000)), len(ends) - 1)]
    found = []
    for first, last in zip(np.append(0, cuts[:-1]), cuts):
        n = sizes[first:last]
        at = np.cumsum(n) - n
        behind = step[np.repeat(begin[first:last] - at, n) + np.arange(n.sum())].astype(np.int64)
        total = np.cumsum(behind)
        tokens = total - np.repeat(total[at] - behind[at], n)  # steps from the group's own token name a token there
        for block, bits in _shared_pairs(group[first:last], owner[first:last], n, tokens):
            some = np.flatnonzero(bits)
            found.append((number[first:last][some], np.full(len(some), block), bits[some]))
    number, block, bits = _joined(*(np.concatenate(x) for x in zip(*found))) if found else (np.empty(0, np.int64),) * 3
    starts = np.flatnonzero(np.diff(number >> shift, prepend=-1))
    out = []
    for first, last in zip(starts, np.append(starts[1:], len(number))):
        low = np.diff(number[first:last] & ((1 << shift) - 1), prepend=0).astype(np.int32)
        out.append((int(number[first] >> shift), int(last - first), _packed(low, block[first:last].astype(np.int32), bits[first:last])))
    ranges, lengths, data = zip(*out) if out else ((), (), ())
    return pa.table({"_r": pa.array(ranges, pa.int64()), "_n": pa.array(lengths, pa.int64()), "_data": pa.array(data, pa.binary())})


def _merge(rows: pa.Table, shift: int) -> pa.Table:
    """A range's bitmaps from all buckets, one row (_j, _block, _bits) for each set and block."""
    parts = [_unpacked(data, (n, np.int32), (n, np.int32), (n, np.int64)) for data, n in zip(rows["_data"].to_pylist(), rows["_n"].to_pylist())]
    low, block, bits = (np.concatenate(x) for x in zip(*[[np.cumsum(p[0]), *p[1:]] for p in parts]))
    number, block, bits = _joined(low + (rows["_r"][0].as_py() << shift), block.astype(np.int64), bits)
    return pa.table({"_j": number, "_block": block, "_bits": bits})


def _numbered(rows: DataFrame, number: str, *order: Column) -> DataFrame:
    """Rows with numbers from 0 on in this order; kept, so they stay the same wherever they are used."""
    held = rows.orderBy(*order).withColumn(number, F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright(F.col(number), 33)
    sizes = sorted(map(tuple, held.groupBy(part).count().collect()))
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    start = F.create_map(*[F.lit(x).cast("long") for (p, _), b in zip(sizes, before) for x in (p, b)])[part] if sizes else F.lit(0)
    return held.withColumn(number, (start + F.col(number).bitwiseAND(F.lit((1 << 33) - 1))).cast("int"))


def similar_elsewhere(items: DataFrame, key: str | list[str], owner: str, tokens: str, least: int = 3, most: int = MAX_GROUP) -> DataFrame:
    """(key, others): distinct other owners with an item that shares at least ``least`` tokens with a key's.

    Three tokens, the usual case, are found as below; other numbers by a prefix join,
    which is exact too, but compares the sets that share a rare token.

    Exact, and linear in the items: no two of them are compared. Two sets share three
    tokens if they share a triple, so it is enough to know each triple's owners. With
    tokens ordered by rarity a set goes to each of its tokens with those behind it; a
    task sees a token's sets and finds for each the owners of its pairs there, as
    bitmaps, after dropping what one owner alone has. Tokens in more than ``most`` sets
    have no task of their own: triples of such tokens only are counted by plain
    aggregation. A set of n tokens costs n^3 / 6 at worst, a triple as many
    bitmaps as it has 63 owners. Items of one owner with the same tokens are one set
    where they lie near each other; items without an owner are nobody's.

    Little goes to disk: items with their tokens, and then with the tokens' numbers, are
    compressed tables in the shared folder, and what is dealt out, sets and bitmaps, is
    packed.
    """
    if least != 3:
        return _prefix_elsewhere(items, key, owner, tokens, least)
    spark = items.sparkSession
    folder = f"{shared_folder(spark)}/sets-{uuid.uuid4().hex}"
    ship_package(spark)
    keys = [key] if isinstance(key, str) else key
    # tokens may cost much, so they are worked out once; the number keeps a filter of them from doing so again
    one = items.where(F.col(owner).isNotNull()).select(*keys, owner, F.monotonically_increasing_id().alias("_j"), F.col(tokens).alias("_a")).where(F.size("_a") >= 3)
    one.write.option("compression", "zstd").option("parquet.dictionary.page.size", MAX_DICTIONARY).parquet(f"{folder}/tokens")
    one = spark.read.parquet(f"{folder}/tokens")
    name = [F.xxhash64(owner).alias("_h0"), F.xxhash64(F.lit(7), F.col(owner)).alias("_h1")]
    counts = one.select(F.explode("_a").alias("_t"), *name).groupBy("_t").agg(F.count("*").alias("_n"), *[f(f"_h{k}").alias(f"_{f.__name__}{k}") for k in (0, 1) for f in (F.min, F.max)])
    known = _numbered(counts.where("_t IS NOT NULL AND (_min0 < _max0 OR _min1 < _max1)").select("_t", "_n"), "_i", F.desc("_n"), F.asc("_t"))
    often = known.where(F.col("_n") > most).count()

    each = one.select(*keys, owner, "_j", F.explode("_a").alias("_t"))
    if known.count() <= MAX_BROADCAST_TOKENS:
        each = each.join(F.broadcast(known.select("_t", "_i")), "_t")
    else:
        each = each.join(known.select("_t", "_i"), "_t").repartition("_j").sortWithinPartitions("_j")
    each = each.select(*keys, owner, "_j", "_i")
    each.mapInArrow(_gather, StructType([*each.schema.fields[:-1], StructField("_o", ArrayType(IntegerType()))])).write.option("compression", "zstd").parquet(f"{folder}/numbers")
    kept = spark.read.parquet(f"{folder}/numbers")

    owners = _numbered(kept.select(owner).distinct(), "_w", F.col(owner))
    n_owners = owners.count()
    sets = kept.where(F.col("_o").isNotNull()).join(F.broadcast(owners) if n_owners <= MAX_BROADCAST_OWNERS else owners, owner).select("_j", "_w", "_o")
    volume = kept.agg(F.sum(F.size("_o").cast("long") * (F.size("_o") - 1) / 2)).first()[0] or 0
    buckets = max(128, int(volume / MAX_BUCKET))
    shift = max(8, 16 - (n_owners // BITS).bit_length())
    dealt = sets.mapInArrow(partial(_deal, buckets=buckets, often=often), "_b long, _n long, _m long, _data binary")
    met = dealt.groupBy("_b").applyInArrow(lambda rows: _meet(rows, shift), "_r long, _n long, _data binary")
    every = met.groupBy("_r").applyInArrow(lambda rows: _merge(rows, shift), "_j long, _block long, _bits long")

    if often >= 3:
        few = F.size(F.filter("_o", lambda t: t >= often))
        heavy = sets.select("_j", "_w", F.slice("_o", few + 1, F.size("_o")).alias("_o")).where(F.size("_o") >= 3)
        heavy = heavy.select("_j", "_w", F.posexplode("_o").alias("_p", "_1"), "_o").select("_j", "_w", "_1", F.posexplode(F.slice("_o", F.col("_p") + 2, F.size("_o"))).alias("_p", "_2"), F.slice("_o", F.col("_p") + 2, F.size("_o")).alias("_o"))
        heavy = heavy.select("_j", "_w", "_1", "_2", F.explode(F.slice("_o", F.col("_p") + 2, F.size("_o"))).alias("_3"))
        block, bit = F.floor(F.col("_w") / BITS).alias("_block"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_w") % BITS).cast("int"))
        of = heavy.groupBy("_1", "_2", "_3", block).agg(F.bit_or(bit).alias("_bits"))
        other = F.when(F.floor(F.col("_w") / BITS) == F.col("_block"), F.col("_bits").bitwiseAND(F.bitwise_not(bit))).otherwise(F.col("_bits"))
        often_met = heavy.join(of, ["_1", "_2", "_3"]).select("_j", "_block", other.alias("_bits")).where("_bits <> 0")
        every = every.unionByName(often_met).groupBy("_j", "_block").agg(F.bit_or("_bits").alias("_bits"))
    found = every.groupBy("_j").agg(F.sum(F.bit_count("_bits")).cast("long").alias("others"))
    return kept.select(*keys, "_j").join(found, "_j").select(*keys, "others")
