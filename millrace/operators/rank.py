"""Ranking, de-duplication by order, quotas and sequences, as windows over a key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def ranked(df: DataFrame, keys: list, order: list, name: str = "rn") -> DataFrame:
    """``df`` with the row number inside its key; ``row_number() <= k`` filters become a top-k before the shuffle."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def keep_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of every key in an order; rows that an earlier filter took out can't hide others."""
    return ranked(df, keys, order, "_rn").where("_rn = 1").drop("_rn")


def keep_best(df: DataFrame, keys: list, score: list, seq: Column, unnamed: Column | None = None) -> DataFrame:
    """The row of every key with the best score, the earliest in a tie; rows without a name all stay."""
    own = [*keys, F.when(unnamed, seq)] if unnamed is not None else keys
    return keep_first(df, own, [*score, seq])


def top_k(df: DataFrame, keys: list, order: list, k: int) -> DataFrame:
    return ranked(df, keys, order, "_rn").where(F.col("_rn") <= k).drop("_rn")


def top_k_in_order(df: DataFrame, keys: list, score: Column, position: str, k: int) -> DataFrame:
    """The k best rows of a key, numbered in the order in which they stand."""
    best = top_k(df, keys, [score.desc(), F.col(position)], k)
    return ranked(best, keys, [F.col(position)], "place")


def order_spec(order: list) -> list[tuple[str, bool]]:
    """(column, descending) of entries given as ``name`` or ``-name``."""
    return [(o[1:], True) if o.startswith("-") else (o, False) for o in order]


def by(*names: str) -> list[Column]:
    """Order columns from names; a leading minus means descending."""
    return [F.col(n).desc() if d else F.col(n).asc() for n, d in order_spec(list(names))]


def interleave(df: DataFrame, group: list[str], order: list[str], limit: int | None = None) -> DataFrame:
    """One row of each group a round, groups in the order of their best row, up to a limit.

    ``order`` has names, ``-name`` for descending. The global cap is a top-n, which
    Spark takes from the partitions without sorting everything.
    """
    turns = ranked(df, group, by(*order), "turn")
    turns = turns.where(F.col("turn") <= limit) if limit is not None else turns  # no later turn can come out
    names = [n for n, _ in order_spec(order)]
    lead = turns.where("turn = 1").select(*group, *[F.col(n).alias(f"_l{i}") for i, n in enumerate(names)])
    keys = [F.col(f"_l{i}").desc() if d else F.col(f"_l{i}").asc() for i, (_, d) in enumerate(order_spec(order))]
    out = turns.join(lead, group).orderBy("turn", *keys)
    out = out.limit(limit) if limit is not None else out
    return out.drop(*[f"_l{i}" for i in range(len(names))])


def apportion(df: DataFrame, group: list[str], base: str, order: str, total: int) -> DataFrame:
    """``share`` of every row of a group by largest remainder, at most its base; the total is capped by their sum.

    ``group`` may be empty for one small table of quotas.
    """
    w = W.partitionBy(*group) if group else W.partitionBy(F.lit(1))
    sums = df.withColumn("_sum", F.sum(base).over(w))
    whole = sums.withColumn("_total", F.least(F.lit(total), F.col("_sum")))
    exact = whole.withColumn("_exact", F.col("_total") * F.col(base) / F.col("_sum")).withColumn("_floor", F.floor("_exact"))
    left = exact.withColumn("_left", F.col("_total") - F.sum("_floor").over(w))
    place = F.row_number().over(w.orderBy((F.col("_exact") - F.col("_floor")).desc(), F.col(order)))
    share = F.least(F.col("_floor") + (place <= F.col("_left")).cast("int"), F.col(base)).cast("long")
    return left.withColumn("share", share).drop("_sum", "_total", "_exact", "_floor", "_left")


def quota(df: DataFrame, keep: Column, keys: list, order: list, k: int) -> DataFrame:
    """Rows that pass, the first k of each key among those; rows that fail use up nothing."""
    return top_k(df.where(keep), keys, order, k)


def nested_caps(df: DataFrame, inner: list[str], outer: list[str], order: list, per_inner: int, per_outer: int) -> DataFrame:
    """At most ``per_inner`` rows of an inner key, then at most ``per_outer`` of an outer one, in order."""
    return top_k(top_k(df, [*outer, *inner], order, per_inner), outer, order, per_outer)


def numbered_ids(df: DataFrame, key: str, order: list[str], name: str = "id", pattern: str = "%s-%03d") -> DataFrame:
    """``key-001`` and so on inside each key; ``order`` has names, ``-name`` for descending.

    Rows are numbered inside each value of the first name, on top of the summed counts
    of the values before it, so no task has to number all rows of a common key.
    """
    lead = order_spec(order)[0][0]
    before = W.partitionBy("_k").orderBy(*[c for c in by(order[0].replace(lead, "_l"))]).rowsBetween(W.unboundedPreceding, -1)
    counts = df.groupBy(F.col(key).alias("_k"), F.col(lead).alias("_l")).agg(F.count("*").alias("_n"))
    base = counts.select("_k", "_l", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = ranked(df, [key, lead], by(*order), "_rn").join(base, F.col(key).eqNullSafe(F.col("_k")) & F.col(lead).eqNullSafe(F.col("_l")))
    return inside.withColumn(name, F.format_string(pattern, F.col(key), F.col("_rn") + F.col("_base"))).drop("_rn", "_k", "_l", "_base")


def runs(df: DataFrame, keys: list[str], flag: Column, order: list) -> DataFrame:
    """(keys, flag, n, first, last): stretches of rows with one flag, by the difference of two row numbers."""
    w = W.partitionBy(*keys).orderBy(*order)
    own = W.partitionBy(*keys, "_f").orderBy(*order)
    marked = df.withColumn("_f", flag).withColumn("_at", F.row_number().over(w))
    marked = marked.withColumn("_run", F.col("_at") - F.row_number().over(own))
    return marked.groupBy(*keys, F.col("_f").alias("flag"), "_run").agg(F.count("*").alias("n"), F.min("_at").alias("first"), F.max("_at").alias("last")).drop("_run")


def label_values(df: DataFrame, keys: list[str], is_label: Column, value: str, order: list) -> DataFrame:
    """(keys, label, value, ord): each label line with the value lines up to the next label, joined by a blank."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    marked = df.withColumn("_l", is_label).withColumn("_p", place).withColumn("_g", F.sum(F.col("_l").cast("int")).over(w)).where("_g > 0")
    lines = F.transform(F.array_sort(F.collect_list(F.when(~F.col("_l"), F.struct("_p", value)))), lambda x: x[value])
    return marked.groupBy(*keys, F.col("_g").alias("ord")).agg(F.max(F.when(F.col("_l"), F.col(value))).alias("label"), F.array_join(lines, " ").alias("value"))


def fair_next(items: DataFrame, done: DataFrame, group: str, index: str) -> DataFrame:
    """The next item of a queue: that of the group with fewest done, the earliest in a tie. One row."""
    counts = done.groupBy(group).agg(F.count("*").alias("_done"))
    return items.join(counts, group, "left").orderBy(F.coalesce("_done", F.lit(0)), F.col(index)).limit(1).drop("_done")


def even_sample(df: DataFrame, key: Column, fraction: float, seed: int = 7) -> DataFrame:
    """A repeatable share of the rows, by a hash of seed and key that any engine has."""
    digits = F.conv(F.left(F.md5(F.concat_ws(":", F.lit(seed), key)), F.lit(8)), 16, 10).cast("long")
    return df.where(digits < int(fraction * 2**32))


def fixed_order(df: DataFrame, column: str, values: Iterable[str], then: list) -> DataFrame:
    """Rows in a given order of one column, then by others; values that aren't listed are left out."""
    place = F.create_map(*[F.lit(x) for i, v in enumerate(values) for x in (v, i)])[F.col(column)]
    return df.withColumn("_place", place).where("_place is not null").orderBy("_place", *then).drop("_place")


def queue_after(queue: DataFrame, outcomes: DataFrame, key: list[str], item: str, position: str, lot: int) -> DataFrame:
    """(key, item, position, state) of every queued item after one lot of each queue.

    A lot is the first ``lot`` items. Items of it move to done or outside by their
    outcome; the first that meets a limit goes to the end of its queue and ends the
    lot, so what comes after it stays queued where it was. ``outcomes`` has key, item
    and result (done, outside or limit); an item without one stays queued.
    """
    places = ranked(queue, key, [F.col(position)], "_at").join(outcomes.select(*key, item, "result"), [*key, item], "left")
    taken = F.col("_at") <= lot
    ends = places.groupBy(*key).agg(F.min(F.when(taken & (F.col("result") == "limit"), F.col("_at"))).alias("_stop"), F.max(position).alias("_last"))
    stop = F.coalesce("_stop", F.lit(lot + 1))
    done = taken & (F.col("_at") < stop) & F.col("result").isin("done", "outside")
    moved = F.col("_at") == F.col("_stop")
    joined = places.join(ends, key)
    return joined.select(
        *key, item, F.when(F.coalesce(moved, F.lit(False)), F.col("_last") + 1).otherwise(F.col(position)).alias(position),
        F.when(F.coalesce(done, F.lit(False)), F.col("result")).otherwise("queued").alias("state"),
    )
