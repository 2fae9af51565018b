"""Time and JSON queries over ``events`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.plans.registry import query
from millrace.session import table


@query("""SELECT event_id, ts::DATE BETWEEN DATE '2024-01-15' - 10 AND DATE '2024-01-15' + 1 AND event_id % 9 > 0 AS dated_only, event_id % 9 = 0 OR ts::DATE >= DATE '2024-01-05' AS undated_kept FROM events""")
def window_lookback(spark, sf_dir):
    """A look-back window that rejects undated rows, and a cut-off that keeps them."""
    day = F.when(F.col("event_id") % 9 > 0, F.to_date("ts"))
    today = F.lit("2024-01-15").cast("date")
    return table(spark, sf_dir, "events").select("event_id", dates.in_window(day, today, 10).alias("dated_only"), dates.since_or_unknown(day, F.lit("2024-01-05").cast("date")).alias("undated_kept"))


@query("""WITH d AS (SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2003-01-01') * 25 AS n, strftime(o_orderdate, '%Y-%m') AS bucket FROM orders)
SELECT o_orderkey, (n // 76 + CASE WHEN n % 76 > 38 OR (n % 76 = 38 AND n // 76 % 2 = 1) THEN 1 ELSE 0 END) / 10 AS months, bucket FROM d""")
def recency_months(spark, sf_dir):
    """Months of 30.4 days to one place, ties to even; the SQL counts in whole numbers, 10 / 30.4 being 25 / 76."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", dates.months_since(F.to_date("o_orderdate"), F.lit("2003-01-01").cast("date")).alias("months"), F.date_format("o_orderdate", "yyyy-MM").alias("bucket"))


@query("SELECT event_type, json_extract(props, '$.k')::BIGINT % 10 AS k, count(*) AS n FROM events GROUP BY ALL")
def json_props(spark, sf_dir):
    """Values inside JSON through the variant type."""
    k = F.variant_get(F.parse_json("props"), "$.k", "long")
    return table(spark, sf_dir, "events").groupBy("event_type", (k % 10).alias("k")).agg(F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def tumbling_counts(spark, sf_dir):
    w = table(spark, sf_dir, "events").groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
    return w.select(F.col("w.start").alias("start"), "event_type", "n", "users")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, new DESC) AS sid FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, sid""")
def session_counts(spark, sf_dir):
    """Sessions of a user, parted by half a day of silence."""
    s = table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "12 hours").alias("s")).agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("s.start").alias("start"), "n")


@query("""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S +0000') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE 'soon' END AS raw, o_orderdate FROM orders)
SELECT o_orderkey, CASE WHEN raw <> 'soon' THEN o_orderdate::DATE END AS d FROM t""")
def date_cascade(spark, sf_dir):
    """Dates in three written forms read back, and one that is none."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.concat(F.date_format(d, "EEE"), F.lit(", "), F.date_format(d, "dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))).when(k == 1, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00Z"))).when(k == 2, F.date_format(d, "yyyy/MM/dd")).otherwise("soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_date(raw).alias("d"))


@query("""SELECT o_orderkey, (DATE '2001-01-01' - (CASE o_orderkey % 3 WHEN 0 THEN (1 + o_orderkey % 5) * 30 WHEN 1 THEN (1 + o_orderkey % 5) * 7 ELSE 365 END)::INT)::DATE AS d FROM orders""")
def relative_dates(spark, sf_dir):
    n = (F.col("o_orderkey") % 5 + 1).cast("string")
    said = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("há "), n, F.lit(" meses"))).when(F.col("o_orderkey") % 3 == 1, F.concat(n, F.lit(" semanas atrás"))).otherwise("um ano atrás")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.relative_date(said, F.lit("2001-01-01").cast("timestamp")).alias("d"))


@query("""SELECT user_id, event_id, date_diff('second', lag(ts) OVER w, ts) AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def pacing_gaps(spark, sf_dir):
    """Seconds since a key's previous event."""
    from pyspark.sql import Window as W

    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    sec = lambda c: F.unix_seconds(F.date_trunc("second", c))
    return table(spark, sf_dir, "events").select("user_id", "event_id", (sec(F.col("ts")) - sec(F.lag("ts").over(w))).alias("gap"))
