"""Hour-of-day curves: per entity and, with a coverage rule, per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_peaks(hours: DataFrame, keys: list[str], hour: str = "hour", value: str = "value", top: int = 3) -> DataFrame:
    """(keys, peak, peak_value, top, index, mean, closed) of each entity and day.

    Only hours with a positive value count. The peak is the largest, the earliest in
    a tie; index is the sum, mean is rounded to one place; a day without such an
    hour is closed.
    """
    open_ = F.when(F.col(value) > 0, F.struct((-F.col(value)).alias("v"), F.col(hour).alias("h")))
    packed = hours.groupBy(*keys).agg(F.array_sort(F.collect_list(open_)).alias("_o"), F.sum(F.when(F.col(value) > 0, F.col(value))).alias("_s"), F.count_if(F.col(value) > 0).alias("_n"))
    first = F.try_element_at("_o", F.lit(1))
    return packed.select(
        *keys, first["h"].alias("peak"), (-first["v"]).alias("peak_value"), F.array_join(F.transform(F.slice("_o", 1, top), lambda x: x["h"].cast("string")), ",").alias("top"),
        F.coalesce("_s", F.lit(0)).alias("index"), F.round(F.col("_s") / F.col("_n"), 1).alias("mean"), (F.col("_n") == 0).alias("closed"),
    )


def group_curve(hours: DataFrame, group: list[str], entity: str, hour: str = "hour", value: str = "value", first: int = 6, last: int = 23, share: float = 0.5) -> DataFrame:
    """(group, n, peak, quietest, h06..h23): the mean curve of a group's entities.

    n is the number of entities with any positive hour; an hour stays when at least
    a share of them, rounded up, are open in it, and its mean is over those. Groups
    without such an hour are left out.
    """
    live = hours.where(F.col(value) > 0)
    n = live.groupBy(*group).agg(F.count_distinct(entity).alias("n"))
    curve = live.groupBy(*group, hour).agg(F.count_distinct(entity).alias("_open"), F.avg(value).alias("_mean"))
    kept = curve.join(n, group).where(F.col("_open") >= F.greatest(F.lit(1), F.ceil(F.col("n") * share))).withColumn("_mean", F.round("_mean", 1))
    wide = [F.max(F.when(F.col(hour) == h, F.col("_mean"))).alias(f"h{h:02d}") for h in range(first, last + 1)]
    return kept.groupBy(*group, "n").agg(F.max_by(hour, F.struct("_mean", (-F.col(hour)).alias("x"))).alias("peak"), F.min_by(hour, F.struct("_mean", hour)).alias("quietest"), *wide)
