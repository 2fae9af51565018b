"""Entity-linking queries over the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import link, rank
from millrace.plans.registry import query
from millrace.session import table


def _base(spark, sf_dir):
    """Customers and suppliers as two sources of one base, with a key that some of both share."""
    digits = lambda c: F.regexp_extract(c, "([0-9]+)$", 1).cast("long") % 500
    c = table(spark, sf_dir, "customer").select(F.lit("crm").alias("fonte"), F.col("c_nationkey").alias("pais"), digits("c_name").alias("key"), F.col("c_custkey").alias("seq"), F.col("c_name").alias("nome"), F.when(F.col("c_acctbal") > 5000, "").otherwise(F.col("c_mktsegment")).alias("setor"))
    s = table(spark, sf_dir, "supplier").select(F.lit("erp").alias("fonte"), F.col("s_nationkey").alias("pais"), digits("s_name").alias("key"), F.col("s_suppkey").alias("seq"), F.col("s_name").alias("nome"), F.lit("SUPPLY").alias("setor"))
    return link.union_sources([c, s])


SQL_BASE = """base AS (SELECT 0 AS source_seq, 'crm' AS fonte, c_nationkey AS pais, regexp_extract(c_name, '([0-9]+)$', 1)::BIGINT % 500 AS key, c_custkey AS seq, c_name AS nome, CASE WHEN c_acctbal > 5000 THEN '' ELSE c_mktsegment END AS setor FROM customer
UNION ALL SELECT 1, 'erp', s_nationkey, regexp_extract(s_name, '([0-9]+)$', 1)::BIGINT % 500, s_suppkey, s_name, 'SUPPLY' FROM supplier)"""


@query(f"""WITH {SQL_BASE} SELECT pais, key, min_by(nome, source_seq * 10000000000 + seq) AS nome, coalesce(min_by(nullif(setor, ''), source_seq * 10000000000 + seq) FILTER (setor <> ''), '') AS setor,
array_to_string(list_sort(list(DISTINCT fonte)), '+') AS fonte, count(*) AS n FROM base WHERE key <> 0 GROUP BY pais, key
UNION ALL SELECT pais, key, nome, setor, fonte, 1 FROM base WHERE key = 0""")
def entity_merge(spark, sf_dir):
    """Two sources merged on country and key, earlier sources first, rows with an empty key left alone."""
    return link.merge_entities(_base(spark, sf_dir), ["pais", "key"], F.col("key") == 0, ["source_seq", "seq"], ["nome", "setor"], "fonte")


@query("""SELECT c_custkey, first(o_orderkey ORDER BY hi DESC, o_totalprice DESC, o_orderkey) AS best, coalesce(array_to_string(list_slice(list(o_orderkey ORDER BY hi DESC, o_totalprice DESC, o_orderkey), 2, 5), ','), '') AS others
FROM (SELECT c_custkey, o_orderkey, o_totalprice, o_orderpriority IN ('1-URGENT', '2-HIGH') AS hi FROM customer LEFT JOIN orders ON o_custkey = c_custkey) GROUP BY c_custkey""")
def best_contact(spark, sf_dir):
    """Each customer with the best order and up to four others."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("hi"))
    out = link.with_best(table(spark, sf_dir, "customer").select("c_custkey"), o, "c_custkey", rank.by("-hi", "-o_totalprice", "o_orderkey"), F.col("o_orderkey"))
    return out.select("c_custkey", "best", F.coalesce(F.array_join("others", ","), F.lit("")).alias("others"))


@query("""SELECT o_orderkey, count(l_orderkey) AS n, count(*) FILTER (l_returnflag = 'R') AS returned, coalesce(string_agg(l_partkey::VARCHAR, ' | ' ORDER BY l_linenumber, l_partkey) FILTER (l_quantity >= 25), '') AS large
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def child_lists(spark, sf_dir):
    """Orders with conditional lists and counts of their lines, in a fixed order."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("l_quantity") >= 25, F.struct("l_linenumber", "l_partkey")))), lambda x: x["l_partkey"].cast("string")), " | ").alias("large"),
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    return o.select("o_orderkey", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "returned")], F.coalesce("large", F.lit("")).alias("large"))


@query("""WITH s AS (SELECT s_nationkey, any_value(s_name) AS s_name FROM supplier WHERE s_acctbal > 7000 GROUP BY s_nationkey HAVING count(*) = 1)
SELECT c_custkey, s_name FROM customer LEFT JOIN s ON s_nationkey = c_nationkey""")
def unique_key_join(spark, sf_dir):
    """Customers with the one rich supplier of their nation; nations with several match nobody."""
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 7000").select(F.col("s_nationkey").alias("nation"), "s_name")
    return link.unique_key_join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation")), s, "nation", ["s_name"]).select("c_custkey", "s_name")


BANDS = ((0.0, 9999.99, "low"), (10000.0, 49999.99, "mid"), (60000.0, 9.0e9, "high"))


@query(f"""WITH b(lo, hi, band) AS (VALUES {", ".join(map(str, BANDS))}) SELECT band, count(*) AS n, min(l_extendedprice) AS least FROM lineitem LEFT JOIN b ON l_extendedprice BETWEEN lo AND hi GROUP BY band""")
def range_join(spark, sf_dir):
    """Lines by price band; prices in no band keep a null one."""
    bands = spark.createDataFrame(BANDS, "lo double, hi double, band string")
    joined = link.in_ranges(table(spark, sf_dir, "lineitem").select("l_extendedprice"), "l_extendedprice", bands)
    return joined.groupBy("band").agg(F.count("*").alias("n"), F.min("l_extendedprice").alias("least"))


@query("""WITH a AS (SELECT DISTINCT p_name AS a FROM part WHERE length(p_name) >= 3), b AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS b FROM part)
SELECT a, b FROM a JOIN b ON length(b) >= 3 AND (starts_with(a, b) OR starts_with(b, a))""")
def prefix_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    a = p.select(F.col("p_name").alias("a")).distinct()
    b = p.select(F.substring_index("p_name", " ", 1).alias("b")).distinct()
    return link.prefix_pairs(a, b, "a", "b")


@query("""WITH a AS (SELECT DISTINCT p_name AS a FROM part), b AS (SELECT DISTINCT string_split(p_name, ' ')[-1] AS b FROM part)
SELECT a, b FROM a JOIN b ON contains(' ' || a || ' ', ' ' || b || ' ') OR contains(' ' || b || ' ', ' ' || a || ' ')""")
def token_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    a = p.select(F.col("p_name").alias("a")).distinct()
    b = p.select(F.substring_index("p_name", " ", -1).alias("b")).distinct()
    return link.token_pairs(a, b, "a", "b")


@query("""WITH old AS (SELECT s_suppkey AS old, s_nationkey AS n, s_acctbal AS bal FROM supplier),
m AS (SELECT c_custkey AS new, old, 0 AS priority, old AS o FROM customer JOIN old ON c_custkey = old AND c_nationkey = n
UNION ALL SELECT c_custkey, old, 1, old FROM customer JOIN old ON c_nationkey = n AND floor(c_acctbal / 1000) = floor(bal / 1000)
UNION ALL SELECT c_custkey, old, 2, old FROM customer JOIN old ON c_nationkey = n AND c_custkey % 10 = old % 10)
SELECT new, old, priority FROM m QUALIFY row_number() OVER (PARTITION BY new ORDER BY priority, o) = 1""")
def cascade_match(spark, sf_dir):
    """The best of three kinds of match for every customer, stricter kinds first."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("new"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("cb"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("old"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("sb"))
    kinds = [(F.col("new"), F.col("old")), (F.floor(F.col("cb") / 1000), F.floor(F.col("sb") / 1000)), (F.col("new") % 10, F.col("old") % 10)]
    return link.cascade(c, s, "nation", kinds, "new", "old")


@query("SELECT o_orderkey FROM orders ANTI JOIN (SELECT l_orderkey AS o_orderkey FROM lineitem WHERE l_quantity > 10) USING (o_orderkey)")
def resume_pending(spark, sf_dir):
    """What is still to do: keys without a finished record."""
    done = table(spark, sf_dir, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem SEMI JOIN (SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') USING (l_orderkey)")
def semi_join_keys(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").join(keys, "l_orderkey", "left_semi")


@query("""WITH m AS (SELECT o_custkey AS c_custkey, max_by(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1), t AS (SELECT o_custkey AS c_custkey, max_by(o_orderpriority, o_orderkey) AS smtp FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey, status, coalesce(smtp, '') AS smtp FROM customer LEFT JOIN m USING (c_custkey) LEFT JOIN t USING (c_custkey)""")
def last_write_lookups(spark, sf_dir):
    """Two lookups by key whose last write counts: every order's status, and the priority of finished ones."""
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    m = link.last_write(o, "c_custkey", "o_orderstatus", "o_orderkey").withColumnRenamed("o_orderstatus", "status")
    t = link.last_write(o.where("o_orderstatus = 'F'"), "c_custkey", "o_orderpriority", "o_orderkey").withColumnRenamed("o_orderpriority", "smtp")
    return table(spark, sf_dir, "customer").select("c_custkey").join(m, "c_custkey", "left").join(t, "c_custkey", "left").select("c_custkey", "status", F.coalesce("smtp", F.lit("")).alias("smtp"))


@query("""SELECT coalesce(s_suppkey, l_suppkey) AS suppkey, CASE WHEN s_suppkey IS NULL THEN 'only in returns' WHEN l_suppkey IS NULL THEN 'only in creditors' ELSE '' END AS note
FROM (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) FULL JOIN (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45) ON s_suppkey = l_suppkey""")
def orphan_accounting(spark, sf_dir):
    """Suppliers with a positive balance against suppliers of large returns, and who is on one side only."""
    s = table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select("s_suppkey")
    l = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity >= 45").select("l_suppkey").distinct()
    note = F.when(F.col("s_suppkey").isNull(), "only in returns").when(F.col("l_suppkey").isNull(), "only in creditors").otherwise("")
    return s.join(l, F.col("s_suppkey") == F.col("l_suppkey"), "full_outer").select(F.coalesce("s_suppkey", "l_suppkey").alias("suppkey"), note.alias("note"))


@query("""WITH last AS (SELECT c_nationkey AS n, max_by(c_mktsegment, c_custkey) AS segment FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1)
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN coalesce(segment, '') ELSE c_mktsegment END AS segment FROM customer LEFT JOIN last ON n = c_nationkey""")
def inherited_value(spark, sf_dir):
    """A missing value comes from the last neighbour of the same group that has one."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).otherwise("").alias("segment"))
    lender = c.where("segment <> ''").groupBy("c_nationkey").agg(F.max_by("segment", "c_custkey").alias("lent"))
    return c.join(lender, "c_nationkey", "left").select("c_custkey", link.first_filled("segment", "lent").alias("segment"))


@query("""WITH m AS (SELECT o_custkey AS k, 1 AS prio, o_orderstatus AS v, o_orderkey AS seq FROM orders UNION ALL SELECT o_custkey, 0, o_orderpriority, o_orderkey FROM orders WHERE o_orderstatus = 'F')
SELECT k, v FROM m QUALIFY row_number() OVER (PARTITION BY k ORDER BY prio, seq) = 1""")
def override_lookup(spark, sf_dir):
    """One map from two: what is done overrides what is queued."""
    o = table(spark, sf_dir, "orders").withColumn("k", F.col("o_custkey"))
    done, queue = o.where("o_orderstatus = 'F'").select("k", F.col("o_orderpriority").alias("v"), "o_orderkey"), o.select("k", F.col("o_orderstatus").alias("v"), "o_orderkey")
    return rank.keep_first(link.union_sources([done, queue]), ["k"], ["source_seq", "o_orderkey"]).select("k", "v")


@query("""WITH g AS (SELECT doc_id FROM labels WHERE quality = 1), r AS (SELECT doc_id FROM documents WHERE n_chars > 500 AND lang = 'en'), b AS (SELECT g.doc_id AS a, r.doc_id AS b FROM g FULL JOIN r USING (doc_id))
SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS common, count(*) FILTER (b IS NULL) AS missed, count(*) FILTER (a IS NULL) AS new, round(count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) / count(a), 3) AS recall FROM b""")
def recall_compare(spark, sf_dir):
    return link.recall(table(spark, sf_dir, "labels").where("quality = 1"), table(spark, sf_dir, "documents").where("n_chars > 500 AND lang = 'en'"), "doc_id")


@query("""WITH d AS (SELECT source, count(*) AS declared FROM documents WHERE source <> 'src3' GROUP BY source), o AS (SELECT source, count(*) AS obtained FROM documents SEMI JOIN labels USING (doc_id) GROUP BY source)
SELECT source, declared, coalesce(obtained, 0) AS obtained, greatest(coalesce(declared, 0) - coalesce(obtained, 0), 0) AS missing, declared IS NULL OR declared <= coalesce(obtained, 0) AS ok FROM d FULL JOIN o USING (source)""")
def reconcile_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    declared = docs.where("source <> 'src3'").groupBy("source").agg(F.count("*").alias("declared"))
    obtained = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").groupBy("source").agg(F.count("*").alias("obtained"))
    return link.reconcile(declared, obtained, "source")


@query("""WITH a AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45), b AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45)
SELECT 'both' AS side, k FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'lost', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'new', k FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""")
def set_compare(spark, sf_dir):
    """What two runs have in common, what was lost and what is new."""
    l = table(spark, sf_dir, "lineitem").where("l_quantity > 45")
    a, b = (l.where(F.col("l_returnflag") == f).select(F.col("l_suppkey").alias("k")).distinct() for f in ("R", "A"))
    named = lambda side, df: df.select(F.lit(side).alias("side"), "k")
    return named("both", a.intersect(b)).unionByName(named("lost", a.subtract(b))).unionByName(named("new", b.subtract(a)))


@query("""WITH u AS (SELECT 'customer' AS o, c_nationkey AS d FROM customer WHERE c_acctbal > 9000 UNION SELECT 'supplier', s_nationkey FROM supplier WHERE s_acctbal > 9000)
SELECT d, array_to_string(list_sort(list(o)), ',') AS origins FROM u GROUP BY d""")
def union_origins(spark, sf_dir):
    """Distinct candidates of several searches with where each came from."""
    c = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.lit("customer").alias("o"), F.col("c_nationkey").alias("d"))
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 9000").select(F.lit("supplier").alias("o"), F.col("s_nationkey").alias("d"))
    return c.unionByName(s).groupBy("d").agg(F.array_join(F.array_sort(F.collect_set("o")), ",").alias("origins"))


@query("""WITH l AS (SELECT l_suppkey, sum(l_quantity)::BIGINT AS qty, count(*) AS lines FROM lineitem GROUP BY 1), n AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1)
SELECT s_name, n_name, r_name, coalesce(qty, 0) AS qty, coalesce(lines, 0) AS lines, coalesce(customers, 0) AS customers, CASE WHEN lines IS NULL THEN 'not found' ELSE 'found' END AS status FROM supplier JOIN n ON s_nationkey = n_nationkey LEFT JOIN l ON l_suppkey = s_suppkey LEFT JOIN c ON c_nationkey = s_nationkey""")
def four_way_comparison(spark, sf_dir):
    """Companies with what three other tables know of them; what none knows is said to be so."""
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum("l_quantity").cast("long").alias("qty"), F.count("*").alias("lines"))
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "r_name")
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(F.count("*").alias("customers"))
    s = table(spark, sf_dir, "supplier").join(n, "s_nationkey").join(l, "s_suppkey", "left").join(c, "s_nationkey", "left")
    zero = lambda x: F.coalesce(x, F.lit(0)).cast("long").alias(x)
    return s.select("s_name", "n_name", "r_name", zero("qty"), zero("lines"), zero("customers"), F.when(F.col("lines").isNull(), "not found").otherwise("found").alias("status"))
