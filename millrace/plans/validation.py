"""Data-quality queries: rules, coverage, styles."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.plans.registry import query
from millrace.session import table


@query("""SELECT doc_id, 'short' AS rule FROM documents WHERE length(text) < 100 UNION ALL SELECT doc_id, 'menu' FROM documents WHERE contains(text, ' | ') UNION ALL SELECT doc_id, 'secret' FROM documents WHERE contains(text, 'token = ')
UNION ALL SELECT doc_id, 'length' FROM documents WHERE n_chars <> length(text) UNION ALL SELECT doc_id, 'language' FROM documents WHERE lang NOT IN ('en', 'fr', 'de')
UNION ALL SELECT doc_id, 'duplicate' FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1""")
def violations(spark, sf_dir):
    """Every rule that every document breaks, repeats included."""
    docs = table(spark, sf_dir, "documents")
    t = F.col("text")
    rules = {"short": F.char_length(t) < 100, "menu": F.contains(t, F.lit(" | ")), "secret": F.contains(t, F.lit("token = ")), "length": F.col("n_chars") != F.char_length(t), "language": ~F.col("lang").isin("en", "fr", "de")}
    hashed = docs.select("doc_id", F.sha2("text", 256).alias("h"))
    return quality.violations(docs, "doc_id", rules).unionByName(quality.duplicated(hashed, ["h"], "doc_id"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({c}::VARCHAR <> '') AS filled, count(*) FILTER ({c}::VARCHAR = '') AS empty, count(*) FILTER ({c} IS NULL) AS missing FROM (SELECT * FROM documents LEFT JOIN labels USING (doc_id))" for c in ("text", "lang", "source", "quality", "toxic")))
def coverage_matrix(spark, sf_dir):
    """How well each field is filled, with labels that only some documents have."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.coverage(rows, ["text", "lang", "source", "quality", "toxic"])


@query(r"""SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(text, '[—–]') THEN 'dash' END, CASE WHEN regexp_matches(lower(text), '\b(idiot|token)\b') THEN 'word' END,
CASE WHEN regexp_matches(lower(text), '\bnot (just|only)\b.*\bbut\b') THEN 'contrast' END, CASE WHEN regexp_matches(text, '(R\$|US\$|€)\s*[0-9]') THEN 'price' END], lambda x: x IS NOT NULL), ',') AS faults FROM documents""")
def style_rules(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(quality.style_faults(F.col("text"), ["idiot", "token"]), ",").alias("faults"))


@query(r"""WITH d AS (SELECT trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS t FROM documents), b AS (SELECT item_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS q FROM benchmark)
SELECT item_id, count(*) FILTER (contains(t, q)) AS n FROM b, d GROUP BY item_id""")
def citation_form(spark, sf_dir):
    """Documents that hold a whole passage, case and spacing aside.

    They meet on a word that the passage holds whole, or on its first characters.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", quality.normal_form(F.col("text")).alias("t"))
    items = table(spark, sf_dir, "benchmark").select("item_id", quality.normal_form(F.col("text")).alias("q"))
    likely = quality.likely_holders(items, docs, "item_id", "q", F.array("q"), "doc_id", "t")
    counts = likely.join(docs, "doc_id").where(F.contains("t", F.col("q"))).groupBy("item_id").agg(F.count("*").alias("n"))
    return items.select("item_id").join(counts, "item_id", "left").select("item_id", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("""WITH p AS (SELECT o_custkey AS plan, list(o_orderpriority) AS have FROM orders GROUP BY 1)
SELECT plan, array_to_string(list_sort(list_filter(['1-URGENT', '2-HIGH', '3-MEDIUM'], lambda x: NOT list_contains(have, x))), ',') AS missing, array_to_string(list_sort(list_filter(['4-NOT SPECIFIED', '5-LOW'], lambda x: NOT list_contains(have, x))), ',') AS unused,
array_to_string(list_sort(list_filter(list_distinct(have), lambda x: len(list_filter(have, lambda y: y = x)) > 1)), ',') AS repeated FROM p""")
def plan_check(spark, sf_dir):
    """What each plan lacks, leaves unused and plans twice."""
    plans = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("plan")).agg(F.collect_list("o_orderpriority").alias("have"))
    out = quality.plan_faults(plans, "plan", ["1-URGENT", "2-HIGH", "3-MEDIUM"], "have", ["4-NOT SPECIFIED", "5-LOW"])
    return out.select("plan", *[F.array_join(F.array_sort(c), ",").alias(c) for c in ("missing", "unused", "repeated")])
