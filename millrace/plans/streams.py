"""Streaming queries over ``events`` as a file stream; the tables they write are compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.session import ship_package
from millrace.streaming import files, state


def _events(spark, sf_dir):
    ship_package(spark)
    return files.file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT DISTINCT user_id, event_type, ts::DATE AS day FROM events")
def stream_dedupe(spark, sf_dir):
    return files.run_to_end(state.once_a_day(_events(spark, sf_dir), ["user_id", "event_type"], "ts").select("user_id", "event_type", "day"))


@query("""WITH b AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT max(ts) AS last FROM events)
SELECT start, event_type, n FROM b, m WHERE start + INTERVAL 1 DAY <= last - INTERVAL 10 MINUTE""")
def stream_counts(spark, sf_dir):
    """Counts of the windows that the watermark closed."""
    return files.run_to_end(state.windowed_counts(_events(spark, sf_dir), "ts", ["event_type"], "1 day", "10 minutes"))


@query("""WITH k AS (SELECT user_id, ts, event_id, event_type || (json_extract(props, '$.k')::BIGINT % 5)::VARCHAR AS item FROM events),
f AS (SELECT user_id, item, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM k QUALIFY row_number() OVER (PARTITION BY user_id, item ORDER BY ts, event_id) = 1),
r AS (SELECT user_id, item, row_number() OVER (PARTITION BY user_id ORDER BY place) AS rn FROM (SELECT user_id, item, min(place) AS place FROM (SELECT k.user_id, k.item, row_number() OVER (PARTITION BY k.user_id ORDER BY ts, event_id) AS place FROM k) GROUP BY ALL))
SELECT k.user_id, k.event_id, k.item, rn <= 6 AS accepted FROM k JOIN r USING (user_id, item)""")
def stream_quota(spark, sf_dir):
    """A quota of six different items a user; repeats are free."""
    item = F.concat("event_type", (F.get_json_object("props", "$.k").cast("long") % 5).cast("string"))
    rows = _events(spark, sf_dir).select("user_id", F.unix_micros("ts").alias("us"), "event_id", item.alias("item"))
    return files.run_to_end(state.within_quota(rows, "user_id", "item", ["us", "event_id"], 6)).select("user_id", "event_id", "item", "accepted")


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'error'),
r AS (SELECT user_id, event_id, rn, us AS t0, 1 AS n FROM e WHERE rn = 1
UNION ALL SELECT e.user_id, e.event_id, e.rn, CASE WHEN e.us - r.t0 >= 259200000000 THEN e.us ELSE r.t0 END, CASE WHEN e.us - r.t0 >= 259200000000 THEN 1 ELSE r.n + 1 END FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1)
SELECT user_id, event_id, n::BIGINT AS n, n > 2 AS blocked FROM r""")
def stream_failures(spark, sf_dir):
    """Errors of a user counted from the first one of a window of three days; blocked from the third."""
    errors = _events(spark, sf_dir).where("event_type = 'error'")
    return files.run_to_end(state.failure_window(errors, "user_id", "ts", "event_id", limit=2, seconds=3 * 86400))
