"""Stateful stream operators: per-day de-duplication, quotas, failure windows, windowed counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def once_a_day(stream: DataFrame, keys: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """The first row of every key and day; state older than the delay goes."""
    return stream.withColumn("day", F.to_date(ts)).withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, "day"])


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], size: str, delay: str) -> DataFrame:
    """(start, keys, n) of every window that the watermark has closed."""
    w = stream.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("w"), *keys).agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("start"), *keys, "n")


def within_quota(stream: DataFrame, key: str, item: str, order: list[str], limit: int) -> DataFrame:
    """(key, order, item, accepted): the first ``limit`` different items of each key; repeats of an accepted one are free.

    State is the accepted items, never more than the limit. Rows of a micro-batch are
    taken in order; an earlier row in a later batch can't displace what was accepted.
    """
    names = [key, *order, item]
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", accepted boolean"

    def run(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values(order)[names]
        accepted = []
        for value in rows[item]:
            if value not in seen and len(seen) < limit:
                seen.append(value)
            accepted.append(value in seen)
        state.update((seen,))
        yield rows.assign(accepted=accepted)

    grouped = stream.select(*names).groupBy(key)
    return grouped.applyInPandasWithState(run, schema, f"seen array<{kinds[item]}>", "append", GroupStateTimeout.NoTimeout)


def failure_window(stream: DataFrame, key: str, ts: str, ident: str, limit: int = 5, seconds: int = 900) -> DataFrame:
    """(key, ident, n, blocked) of every failure: how many the key has had since the first of its window.

    The window starts at a failure and ends exactly ``seconds`` later; the next
    failure starts another. A key is blocked when the window has its limit already.
    """
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    schema = f"{key} {kinds[key]}, {ident} {kinds[ident]}, n long, blocked boolean"

    def run(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, start = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values(["_us", ident])
        counts, blocked = [], []
        for at in rows["_us"]:
            if n == 0 or at - start >= seconds * 1_000_000:
                n, start = 0, int(at)
            blocked.append(n >= limit)
            n += 1
            counts.append(n)
        state.update((n, start))
        yield pd.DataFrame({key: rows[key], ident: rows[ident], "n": counts, "blocked": blocked})

    timed = stream.select(key, ident, F.unix_micros(ts).alias("_us"))
    return timed.groupBy(key).applyInPandasWithState(run, schema, "n long, start long", "append", GroupStateTimeout.NoTimeout)
