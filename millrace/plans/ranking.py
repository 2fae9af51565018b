"""Ranking, quota and sequence queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import rank
from millrace.plans.registry import query
from millrace.session import table


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus <> 'P' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def keep_first(spark, sf_dir):
    """The first accepted order of every customer: filter first, so that a rejected one hides none."""
    o = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_custkey", "o_orderkey", "o_orderdate")
    return rank.keep_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""SELECT o_custkey, o_orderstatus, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey END
ORDER BY length(o_orderpriority) DESC, o_totalprice > 100000 DESC, o_orderkey) = 1""")
def keep_best(spark, sf_dir):
    """The most complete row of each group, the earliest in a tie; unnamed rows all stay."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderpriority", "o_totalprice")
    best = rank.keep_best(o, ["o_custkey", "o_orderstatus"], [F.length("o_orderpriority").desc(), (F.col("o_totalprice") > 100000).desc()], F.col("o_orderkey"), F.col("o_orderpriority") == "5-LOW")
    return best.select("o_custkey", "o_orderstatus", "o_orderkey")


@query("""WITH t AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS turn FROM documents), l AS (SELECT source, n_chars AS ln, doc_id AS ld FROM t WHERE turn = 1)
SELECT source, doc_id, turn FROM t JOIN l USING (source) ORDER BY turn, ln DESC, ld LIMIT 50""")
def round_robin(spark, sf_dir):
    """One document a source and round, the source with the best one first, fifty in all."""
    return rank.interleave(table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), ["source"], ["-n_chars", "doc_id"], 50).select("source", "doc_id", "turn")


_APPORTION = """WITH b AS (SELECT event_type, count(*) AS base FROM events GROUP BY 1), s AS (SELECT *, sum(base) OVER () AS t, least(1000, sum(base) OVER ()) AS total FROM b),
e AS (SELECT *, total * base / t AS exact, floor(total * base / t) AS fl FROM s), r AS (SELECT *, total - sum(fl) OVER () AS spare, row_number() OVER (ORDER BY exact - fl DESC, event_type) AS rn FROM e)
SELECT event_type, base, least(fl + CASE WHEN rn <= spare THEN 1 ELSE 0 END, base)::BIGINT AS share FROM r"""


@query(_APPORTION)
def apportion(spark, sf_dir):
    """A thousand units among event types by largest remainder."""
    base = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("base"))
    return rank.apportion(base, [], "base", "event_type", 1000).select("event_type", "base", "share")


@query("""WITH d AS (SELECT o_orderpriority AS p, count(*) AS done FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT o_orderkey, p FROM (SELECT o_orderkey, o_orderpriority AS p FROM orders WHERE o_orderstatus = 'O') LEFT JOIN d USING (p) ORDER BY coalesce(done, 0), o_orderkey LIMIT 1""")
def fair_queue(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "p")
    return rank.fair_next(o.where("o_orderstatus = 'O'").select("o_orderkey", "p"), o.where("o_orderstatus = 'F'"), "p", "o_orderkey")


@query("SELECT user_id, event_id FROM events WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 6")
def quota_per_group(spark, sf_dir):
    """The first six events of each user that count; the others use up nothing."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return rank.quota(e, F.col("event_type") != "error", ["user_id"], ["ts", "event_id"], 6).select("user_id", "event_id")


@query("""WITH p AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) <= 3)
SELECT user_id, event_type, event_id FROM p QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 10""")
def nested_caps(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return rank.nested_caps(e, ["event_type"], ["user_id"], ["ts", "event_id"], 3, 10).select("user_id", "event_type", "event_id")


@query("""WITH n AS (SELECT user_id, event_type = 'error' AS f, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place, row_number() OVER (PARTITION BY user_id, event_type = 'error' ORDER BY ts, event_id) AS own FROM events)
SELECT user_id, min(place) AS first, max(place) AS last, count(*) AS n FROM n WHERE f GROUP BY user_id, place - own HAVING count(*) >= 2""")
def consecutive_runs(spark, sf_dir):
    """Runs of at least two errors of a user in a row."""
    r = rank.runs(table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], F.col("event_type") == "error", ["ts", "event_id"])
    return r.where("flag AND n >= 2").select("user_id", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "n")


@query("""WITH g AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM conversations)
SELECT conv_id, g::BIGINT AS ord, max(text) FILTER (role = 'user') AS label, coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role <> 'user'), '') AS value FROM g WHERE g > 0 GROUP BY conv_id, g""")
def label_value_pairs(spark, sf_dir):
    """Each user turn with what follows it, as labels pair with values."""
    return rank.label_values(table(spark, sf_dir, "conversations"), ["conv_id"], F.col("role") == "user", "text", ["turn"]).select("conv_id", F.col("ord").cast("long").alias("ord"), "label", "value")


@query("SELECT printf('%s-%03d', o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)) AS id, o_orderkey FROM orders")
def sequential_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_orderdate")
    return rank.numbered_ids(o, "o_orderpriority", ["o_orderdate", "o_orderkey"]).select("id", "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate END AS d FROM orders ORDER BY d DESC NULLS LAST, o_orderkey LIMIT 300")
def newest_first(spark, sf_dir):
    """The newest three hundred, undated ones last."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderdate")).alias("d")).orderBy(F.desc_nulls_last("d"), "o_orderkey").limit(300)


@query("SELECT p_brand, count(DISTINCT p_type) AS types, count(*) AS n FROM part GROUP BY 1 ORDER BY types DESC, n DESC, p_brand LIMIT 30")
def top_ranking(spark, sf_dir):
    g = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count_distinct("p_type").alias("types"), F.count("*").alias("n"))
    return g.orderBy(F.desc("types"), F.desc("n"), "p_brand").limit(30)


@query("""SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') QUALIFY place <= 5""")
def fixed_order(spark, sf_dir):
    """The five best of each listed category in the list's order; other categories go."""
    listed = ["3-MEDIUM", "1-URGENT"]
    o = table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin(listed)).select("o_orderkey", "o_orderpriority", "o_totalprice")
    best = rank.ranked(o, ["o_orderpriority"], rank.by("-o_totalprice", "o_orderkey"), "place").where("place <= 5")
    return rank.fixed_order(best, "o_orderpriority", listed, ["place"]).select("o_orderkey", "o_orderpriority", "place")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey) AS rn FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS place FROM b WHERE rn <= 3""")
def best_in_order(spark, sf_dir):
    """The three largest lines of each order, numbered as they stand."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    best = rank.top_k(l, ["l_orderkey"], rank.by("-l_quantity", "l_linenumber", "l_partkey"), 3)
    return rank.ranked(best, ["l_orderkey"], ["l_linenumber", "l_partkey"], "place").select("l_orderkey", "l_linenumber", "l_partkey", "place")


@query("SELECT doc_id, source FROM documents WHERE ('0x' || left(md5('7:' || doc_id), 8))::BIGINT < 429496729")
def repeatable_sample(spark, sf_dir):
    """A tenth of the documents, the same ones every time."""
    return rank.even_sample(table(spark, sf_dir, "documents").select("doc_id", "source"), F.col("doc_id"), 0.1)
