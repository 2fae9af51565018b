"""Aggregation queries: counts, shares, curves, grids and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import peaks, rank
from millrace.plans.registry import query
from millrace.session import table


@query("SELECT c_mktsegment, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS negative, count(DISTINCT nullif(c_nationkey, 0)) AS nations, round(100.0 * count(*) FILTER (c_acctbal > 5000) / count(*), 1) AS rich_share FROM customer GROUP BY 1")
def group_counts(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("negative"), F.count_distinct(F.nullif("c_nationkey", F.lit(0))).alias("nations"),
        F.round(F.lit(100.0) * F.count_if(F.col("c_acctbal") > 5000) / F.count("*"), 1).alias("rich_share"),
    )


@query("SELECT l_returnflag, l_linestatus, CASE WHEN grouping(l_linestatus) = 1 THEN 'flag' ELSE 'both' END AS grain, count(*) AS n, sum(l_quantity)::BIGINT AS qty FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag))")
def grouping_sets(spark, sf_dir):
    """Two grains of one count in a single aggregation."""
    l = table(spark, sf_dir, "lineitem")
    g = l.groupingSets([[F.col("l_returnflag"), F.col("l_linestatus")], [F.col("l_returnflag")]], F.col("l_returnflag"), F.col("l_linestatus"))
    return g.agg(F.when(F.grouping("l_linestatus") == 1, "flag").otherwise("both").alias("grain"), F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("qty"))


@query("""WITH h AS (SELECT o_custkey, map_from_entries(list((o_orderstatus, n))) AS m FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) GROUP BY 1),
v AS (SELECT o_custkey, coalesce(m['F'], 0) AS f, coalesce(m['O'], 0) AS o, coalesce(m['P'], 0) AS p FROM h)
SELECT o_custkey, f + o + p AS total, round(100.0 * p / nullif(f + o + p, 0), 1) AS p_share FROM v""")
def histogram_share(spark, sf_dir):
    """The share of one bar in each customer's histogram of order states, kept as a map."""
    bars = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n")).groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n"))).alias("m"))
    total = F.aggregate(F.map_values("m"), F.lit(0).cast("long"), lambda a, x: a + x)
    return bars.select("o_custkey", total.alias("total"), F.round(F.try_divide(F.lit(100.0) * F.coalesce(F.col("m")["P"], F.lit(0)), total), 1).alias("p_share"))


def _hours(spark, sf_dir):
    """Events a user, weekday and hour as a percentage of the user's busiest cell, whole numbers."""
    e = table(spark, sf_dir, "events").groupBy("user_id", "event_type", F.dayofweek("ts").alias("day"), F.hour("ts").alias("hour")).agg(F.count("*").alias("n"))
    return e


_HOURS = "SELECT user_id, event_type, dayofweek(ts) + 1 AS day, hour(ts) AS hour, count(*) AS n FROM events GROUP BY ALL"


@query(f"""WITH h AS (SELECT user_id, day, hour, CASE WHEN sum(n) = 1 AND hour < 3 THEN 0 ELSE sum(n) END AS value FROM ({_HOURS}) GROUP BY user_id, day, hour),
o AS (SELECT user_id, day, count(*) FILTER (value > 0) AS n, coalesce(sum(value), 0) AS s, list(hour ORDER BY value DESC, hour) FILTER (value > 0) AS hs, max(value) FILTER (value > 0) AS pv FROM h GROUP BY user_id, day)
SELECT user_id, day::INT AS day, hs[1]::INT AS peak, pv::BIGINT AS peak_value, coalesce(array_to_string(list_slice(hs, 1, 3), ','), '') AS top, s::BIGINT AS index, round(s / nullif(n, 0), 1) AS mean, n = 0 AS closed FROM o""")
def peak_per_entity(spark, sf_dir):
    """Each user's and weekday's peak hour, best three, sum and mean; idle cells don't count."""
    h = _hours(spark, sf_dir).groupBy("user_id", "day", "hour").agg(F.sum("n").alias("v"))
    h = h.select("user_id", "day", "hour", F.when((F.col("v") == 1) & (F.col("hour") < 3), 0).otherwise(F.col("v")).alias("value"))
    return peaks.daily_peaks(h, ["user_id", "day"]).select("user_id", "day", "peak", F.col("peak_value").cast("long").alias("peak_value"), "top", F.col("index").cast("long").alias("index"), "mean", "closed")


_WIDE = ", ".join(f"max(mean) FILTER (hour = {h}) AS h{h:02d}" for h in range(6, 24))


@query(f"""WITH h AS (SELECT event_type, day, user_id, hour, n AS value FROM ({_HOURS})), s AS (SELECT event_type, day, count(DISTINCT user_id) AS n FROM h GROUP BY ALL),
c AS (SELECT event_type, day, hour, count(DISTINCT user_id) AS o, round(avg(value), 1) AS mean FROM h GROUP BY ALL), k AS (SELECT c.*, n FROM c JOIN s USING (event_type, day) WHERE o >= greatest(1, ceil(n * 0.05)))
SELECT event_type, day::INT AS day, n, first(hour ORDER BY mean DESC, hour)::INT AS peak, first(hour ORDER BY mean, hour)::INT AS quietest, {_WIDE} FROM k GROUP BY event_type, day, n""")
def peak_by_group(spark, sf_dir):
    """Mean curves by event type and weekday as a wide table, hours with too little coverage left out."""
    h = _hours(spark, sf_dir).withColumnRenamed("n", "value")
    # a twentieth of the users makes an hour count here: the sample has few events a user
    return peaks.group_curve(h, ["event_type", "day"], "user_id", share=0.05)


@query("""SELECT source, count(*) AS n, count(*) FILTER (n_chars > 1000) AS in_window, max(n_chars) AS newest, CASE WHEN count(*) FILTER (n_chars > 0) = 0 THEN 'sem_datas' WHEN max(n_chars) < 15000 THEN 'parado' ELSE 'vivo' END AS estado FROM documents GROUP BY source""")
def feed_health(spark, sf_dir):
    """Items, items in the window, the newest one, and a state by the first rule that fits."""
    state = F.when(F.count_if(F.col("n_chars") > 0) == 0, "sem_datas").when(F.max("n_chars") < 15000, "parado").otherwise("vivo")
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") > 1000).alias("in_window"), F.max("n_chars").alias("newest"), state.alias("estado"))


@query("""WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS kinds FROM orders GROUP BY 1)
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 5 WHEN 'MACHINERY' THEN 3 ELSE 0 END + least(4, coalesce(n, 0)) + 2 * least(2, coalesce(kinds, 0)) + CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS score FROM customer LEFT JOIN o USING (c_custkey)""")
def capped_score(spark, sf_dir):
    """An additive score whose terms are capped."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_distinct("o_orderpriority").alias("kinds"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    base = F.when(F.col("c_mktsegment") == "BUILDING", 5).when(F.col("c_mktsegment") == "MACHINERY", 3).otherwise(0)
    score = base + F.least(F.lit(4), zero("n")) + F.least(F.lit(2), zero("kinds")) * 2 + (F.col("c_acctbal") > 0).cast("int")
    return table(spark, sf_dir, "customer").join(o, "c_custkey", "left").select("c_custkey", score.cast("long").alias("score"))


@query("""WITH d AS (SELECT p, s FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW'), ('6-NONE')) a(p), (VALUES ('F'), ('O'), ('P')) b(s)),
r AS (SELECT o_orderpriority AS p, o_orderstatus AS s, o_orderkey AS k, row_number() OVER (PARTITION BY p, s ORDER BY k) AS rn FROM orders),
g AS (SELECT p, s, count(*) AS n, string_agg(k::VARCHAR, ',' ORDER BY k) FILTER (rn <= 10) AS firsts FROM r GROUP BY 1, 2)
SELECT p, s, coalesce(n, 0) AS n, coalesce(firsts, '') AS firsts FROM d LEFT JOIN g USING (p, s)""")
def grid(spark, sf_dir):
    """Every cell of a grid, the empty ones too, with its first ten items in order."""
    cells = spark.createDataFrame([(p, s) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE") for s in "FOP"], "p string, s string")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"), "o_orderkey")
    counts = o.groupBy("p", "s").agg(F.count("*").alias("n"))
    firsts = rank.top_k(o, ["p", "s"], ["o_orderkey"], 10).groupBy("p", "s").agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")).cast("array<string>"), ",").alias("firsts"))
    return cells.join(counts.join(firsts, ["p", "s"]), ["p", "s"], "left").select("p", "s", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("firsts", F.lit("")).alias("firsts"))


@query("""WITH f AS (SELECT l_partkey, l_returnflag AS m FROM lineitem WHERE l_quantity > 49 UNION SELECT l_partkey, l_linestatus FROM lineitem WHERE l_discount > 0.09)
SELECT l_partkey, array_to_string(list_sort(list(m)), '+') AS filters FROM f GROUP BY 1""")
def membership(spark, sf_dir):
    """All filters that an entity matched, old and new, as one sorted set."""
    l = table(spark, sf_dir, "lineitem")
    a = l.where("l_quantity > 49").groupBy("l_partkey").agg(F.collect_set("l_returnflag").alias("old"))
    b = l.where("l_discount > 0.09").groupBy("l_partkey").agg(F.collect_set("l_linestatus").alias("new"))
    none = F.array().cast("array<string>")
    both = F.array_sort(F.array_union(F.coalesce("old", none), F.coalesce("new", none)))
    return a.join(b, "l_partkey", "full_outer").select("l_partkey", F.array_join(both, "+").alias("filters"))


@query("""WITH m AS (SELECT max(o_orderdate) AS today FROM orders) SELECT o_orderpriority, min(date_diff('day', o_orderdate, today)) AS youngest, count(*) FILTER (date_diff('day', o_orderdate, today) <= 90) AS recent FROM orders, m GROUP BY 1""")
def reference_date(spark, sf_dir):
    """Ages measured from the latest date that the data themselves hold."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate")
    age = F.datediff("today", "o_orderdate")
    return o.join(F.broadcast(o.agg(F.max("o_orderdate").alias("today")))).groupBy("o_orderpriority").agg(F.min(age).cast("long").alias("youngest"), F.count_if(age <= 90).alias("recent"))


@query("""WITH n AS (SELECT count(DISTINCT c_nationkey) AS all_ FROM customer), g AS (SELECT c_mktsegment, count(DISTINCT c_nationkey) FILTER (c_acctbal > 9800) AS k, list(DISTINCT c_nationkey) FILTER (c_acctbal > 9800) AS l FROM customer GROUP BY 1)
SELECT c_mktsegment, k, round(k / all_, 3) AS share, coalesce(array_to_string(list_sort(l), ','), '') AS members FROM g, n WHERE k < all_""")
def gap_list(spark, sf_dir):
    """Categories that don't cover all, with their share and members."""
    c = table(spark, sf_dir, "customer")
    rich = F.when(F.col("c_acctbal") > 9800, F.col("c_nationkey"))
    g = c.groupBy("c_mktsegment").agg(F.count_distinct(rich).alias("k"), F.array_join(F.array_sort(F.collect_set(rich)).cast("array<string>"), ",").alias("members"))
    n = c.agg(F.count_distinct("c_nationkey").alias("all_"))
    return g.join(F.broadcast(n)).where("k < all_").select("c_mktsegment", "k", F.round(F.col("k") / F.col("all_"), 3).alias("share"), "members")


@query("""WITH a AS (SELECT source, count(*) AS n, count(DISTINCT lang) AS langs, count(*) FILTER (n_chars > 5000) AS long_ FROM documents GROUP BY source)
SELECT source, array_to_string(list_filter([CASE WHEN n < 50 THEN 'few' END, CASE WHEN langs < 4 THEN 'one-sided' END, CASE WHEN long_ < 5 THEN 'shallow' END], lambda x: x IS NOT NULL), ',') AS gaps FROM a""")
def synthesis_gaps(spark, sf_dir):
    """Threshold messages from one aggregate row a product."""
    a = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("lang").alias("langs"), F.count_if(F.col("n_chars") > 5000).alias("long_"))
    rules = F.array_compact(F.array(F.when(F.col("n") < 50, "few"), F.when(F.col("langs") < 4, "one-sided"), F.when(F.col("long_") < 5, "shallow")))
    return a.select("source", F.array_join(rules, ",").alias("gaps"))


@query("""SELECT source, count(*) AS n, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'fr') AS fr, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'es') AS es, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY source""")
def run_report(spark, sf_dir):
    """Counts by product and language, wide."""
    g = table(spark, sf_dir, "documents").groupBy("source")
    return g.agg(F.count("*").alias("n"), *[F.count_if(F.col("lang") == x).alias(x) for x in ("en", "fr", "de", "es")], F.sum("n_chars").cast("long").alias("chars"))


@query("SELECT w AS facet, count(*) AS n FROM (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY w")
def facet_counts(spark, sf_dir):
    words = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("facet"))
    return words.groupBy("facet").agg(F.count("*").alias("n"))


@query("""WITH q AS (SELECT p_brand AS brand, count(*) AS queued FROM part WHERE p_size < 10 GROUP BY 1), d AS (SELECT p_brand AS brand, count(DISTINCT p_partkey) AS done, count(*) AS lines FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_size >= 45 GROUP BY 1)
SELECT brand, coalesce(queued, 0) AS queued, coalesce(done, 0) AS done, coalesce(lines, 0) AS lines FROM q FULL JOIN d USING (brand)""")
def brand_status(spark, sf_dir):
    """What is queued and done for each brand, brands on one side only included."""
    p = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand")
    q = p.where("p_size < 10").groupBy("brand").agg(F.count("*").alias("queued"))
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    d = p.where("p_size >= 45").join(counts, "p_partkey").groupBy("brand").agg(F.count("*").alias("done"), F.sum("n").alias("lines"))
    return q.join(d, "brand", "full_outer").select("brand", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("queued", "done", "lines")])


@query("""SELECT CASE WHEN n_chars IS NULL OR n_chars = 0 THEN 'undated' WHEN n_chars < 200 THEN 'out of window' WHEN regexp_matches(text, '\\||!!|\\$\\$') THEN 'noise' ELSE 'kept' END AS reason, count(*) AS n FROM documents GROUP BY 1""".replace("\\\\", "\\"))
def scan_counters(spark, sf_dir):
    """Rows of a scan by the reason that kept or discarded them."""
    reason = F.when(F.coalesce("n_chars", F.lit(0)) == 0, "undated").when(F.col("n_chars") < 200, "out of window").when(F.col("text").rlike(r"\||!!|\$\$"), "noise").otherwise("kept")
    return table(spark, sf_dir, "documents").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT l_suppkey, string_agg(DISTINCT l_returnflag, ' | ' ORDER BY l_returnflag) AS flags, string_agg(DISTINCT l_linestatus, ' | ' ORDER BY l_linestatus DESC) AS states FROM lineitem GROUP BY 1""")
def ordered_strings(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey")
    return g.agg(F.array_join(F.sort_array(F.collect_set("l_returnflag")), " | ").alias("flags"), F.array_join(F.sort_array(F.collect_set("l_linestatus"), False), " | ").alias("states"))


@query("""SELECT count(DISTINCT o_custkey) AS customers, count(*) AS orders, count(*) FILTER (o_totalprice IS NOT NULL) AS priced, count(DISTINCT o_orderpriority) AS priorities, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS finished FROM orders""")
def site_totals(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.count_distinct("o_custkey").alias("customers"), F.count("*").alias("orders"), F.count("o_totalprice").alias("priced"), F.count_distinct("o_orderpriority").alias("priorities"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"))


@query("""SELECT message FROM (SELECT DISTINCT source || ': blocked' AS message FROM documents WHERE regexp_matches(text, 'All rights reserved') AND n_chars < 400)""")
def blocked_list(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where(F.contains("text", F.lit("All rights reserved")) & (F.col("n_chars") < 400))
    return d.select(F.concat("source", F.lit(": blocked")).alias("message")).distinct().orderBy("message")


@query("""WITH g AS (SELECT p_brand AS base, min_by(p_name, p_partkey) AS nome, min(p_partkey) AS first, list(DISTINCT p_type) AS ofertas FROM part GROUP BY 1) SELECT base, nome, first, array_to_string(list_sort(ofertas), ',') AS ofertas FROM g""")
def seed_groups(spark, sf_dir):
    """Seeds by base name: the first row's values and the union of offers."""
    g = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("base"))
    return g.agg(F.min_by("p_name", "p_partkey").alias("nome"), F.min("p_partkey").alias("first"), F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("ofertas"))
