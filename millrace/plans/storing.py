"""Feeds of whole documents, landed pages of services, sets of tables and keyed stores, each written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.session import ship_package, table
from millrace.sources import landed, markup, tablesets
from millrace.streaming import queues
from millrace.streaming.files import shared_folder
from millrace.streaming.upserts import KeyedStore


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- feeds


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
t AS (SELECT doc_id, i, trim(regexp_replace(regexp_replace(line, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]', ' ', 'g'), '[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS title FROM l)
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'rss' WHEN 1 THEN 'atom' ELSE 'urlset' END AS kind, 'https://x/' || doc_id || '?p=1&i=' || i AS url, md5(CASE WHEN doc_id % 4 = 3 THEN '' ELSE title END) AS title FROM t WHERE doc_id % 4 <> 2
UNION ALL SELECT doc_id, 'invalido', '', md5('') FROM documents WHERE doc_id % 4 = 2""")
def document_feeds(spark, sf_dir):
    """Feeds with an entry for each line of a whole text, in three formats; a feed that breaks off is invalid."""
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    shown = lambda c: escaped(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]", " "))
    d = table(spark, sf_dir, "documents").select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"), (F.col("doc_id") % 4).alias("form"))
    address = lambda i: F.concat(F.lit("https://x/"), F.col("doc_id").cast("string"), F.lit("?p=1&amp;i="), (i + 1).cast("string"))
    rss = lambda x, i: F.concat(F.lit("<item><title>"), shown(x), F.lit("</title><link>"), address(i), F.lit("</link></item>"))
    atom = lambda x, i: F.concat(F.lit('<entry><link rel="alternate" href="'), address(i), F.lit('"/><title><b>'), shown(x), F.lit("</b></title></entry>"))
    sites = lambda x, i: F.concat(F.lit("<url><loc>"), address(i), F.lit("</loc></url>"))
    entries = lambda f: F.array_join(F.transform("lines", f), "")
    body = (
        F.when(F.col("form") == 0, F.concat(F.lit("<rss><channel><title>own</title>"), entries(rss), F.lit("</channel></rss>")))
        .when(F.col("form") == 1, F.concat(F.lit('﻿<feed xmlns="http://www.w3.org/2005/Atom">'), entries(atom), F.lit("</feed>")))
        .when(F.col("form") == 2, F.concat(F.lit("<rss><channel>"), entries(rss)))
        .otherwise(F.concat(F.lit("<urlset>"), entries(sites), F.lit("</urlset>")))
    )
    return markup.feed_items(d.select("doc_id", body.alias("body")), ["doc_id"]).select("doc_id", "kind", "url", F.md5("title").alias("title"))


# --- landed pages of a service


#: Pages that one file holds.
TOGETHER = 64


def _landed(spark, sf_dir):
    """Orders as responses of a paged service: a series a priority, some with pages left over from an earlier scan, empty or broken ones."""
    digit, page = F.left("series", F.lit(1)), F.col("page")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series"), F.expr("CAST(o_orderkey DIV 1000 + 1 AS INT)").alias("page"), "o_orderkey", "o_totalprice")
    pages = o.groupBy("series", "page").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))).alias("items"))
    ends = F.broadcast(pages.groupBy("series").agg(F.max("page").alias("top")))  # a row a priority
    more = ~((page == F.col("top")) | ((digit == "1") & (page % 7 == 0)))
    items = F.when((digit == "2") & (page % 9 == 0), F.lit("")).otherwise(F.array_join(F.transform("items", lambda x: F.to_json(x)), ","))
    body = F.concat(F.lit('{"results":['), items, F.lit('],"page_metadata":{"hasNext":'), more.cast("string"), F.lit("}}"))
    value = F.when((digit == "3") & (page % 5 == 0), F.left(body, F.char_length(body) - 1)).otherwise(body)
    folder = _folder(spark, "pages")
    lines = F.concat(page.cast("string"), F.lit("\t"), value).alias("value")
    first = F.expr(f"(page - 1) DIV {TOGETHER} * {TOGETHER} + 1")
    held = F.concat(first.cast("string"), F.lit("-"), (first + TOGETHER - 1).cast("string")).alias("pages")
    dealt = pages.join(ends, "series").select("series", held, lines)
    dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "series", "pages").write.partitionBy("series", "pages").text(folder)
    return landed.landed_pages(spark, folder)


_PAGES = """WITH o AS (SELECT o_orderkey, o_totalprice, o_orderpriority AS series, o_orderkey // 1000 + 1 AS page FROM orders),
p AS (SELECT series, page, max(page) OVER (PARTITION BY series) AS top, left(series, 1) AS d FROM (SELECT DISTINCT series, page FROM o)),
e AS (SELECT *, d = '3' AND page % 5 = 0 AS broken, d = '2' AND page % 9 = 0 AS void FROM p),
l AS (SELECT series, min(page) FILTER (NOT broken AND (void OR page = top OR d = '1' AND page % 7 = 0)) AS last FROM e GROUP BY 1) """


@query(_PAGES + """SELECT series, page::INT AS page, o_orderkey, o_totalprice FROM o JOIN e USING (series, page) JOIN l USING (series) WHERE NOT broken AND NOT void AND (last IS NULL OR page <= last)""")
def landed_series(spark, sf_dir):
    """What a scan page by page sees of landed responses: up to the page that has no next one or no items."""
    items = landed.scanned(_landed(spark, sf_dir))
    return items.select("series", "page", F.from_json("item", "o_orderkey long, o_totalprice double").alias("r")).select("series", "page", "r.*")


@query(_PAGES + """SELECT series, max(last)::INT AS last, coalesce(count(*) FILTER (NOT broken AND page BETWEEN 1 AND last) = max(last), false) AS complete FROM e JOIN l USING (series) GROUP BY 1""")
def series_ends(spark, sf_dir):
    """Each series' last page, and whether every page up to it could be read."""
    return landed.last_pages(_landed(spark, sf_dir))


# --- tables that appear together


@query("""SELECT 'clientes' AS name, c_custkey::VARCHAR AS id, md5(c_name || chr(10) || c_mktsegment) AS body FROM customer
UNION ALL SELECT 'textos', doc_id::VARCHAR, md5(coalesce(text, '')) FROM documents
UNION ALL SELECT 'conversas', conv_id || '/' || turn, md5(coalesce(text, '')) FROM conversations
UNION ALL SELECT 'itens', item_id::VARCHAR, md5(coalesce(text, '')) FROM benchmark""")
def table_set_export(spark, sf_dir):
    """Five tables of whole texts, one of them empty, written as one over an older set and read again."""
    d, v = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), table(spark, sf_dir, "conversations")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("\n"), "c_mktsegment").alias("text"))
    said = v.select(F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("id"), "text")
    tables = {"clientes": c, "textos": d, "conversas": said, "itens": table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")}
    folder = _folder(spark, "set")
    tablesets.write_together({"clientes": d, "antigos": c}, folder)
    tablesets.write_together(tables | {"vazios": c.where("false")}, folder)
    out = None
    for name, rows in tablesets.read_together(spark, folder).items():
        part = rows.select(F.lit(name).alias("name"), "id", F.md5("text").alias("body"))
        out = part if out is None else out.unionByName(part)
    return out


# --- a store kept up to date by a stream


@query("""SELECT user_id, event_id, event_type, epoch_us(ts) AS us FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def keyed_store(spark, sf_dir):
    """The last event of every user, kept by a stream whose batches come neither in the order of time nor of users."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    folder = _folder(spark, "store")
    events.repartition(4, F.pmod(F.xxhash64("event_id"), F.lit(16))).write.parquet(f"{folder}/landed")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landed")
    return KeyedStore(spark, f"{folder}/users", events.schema, ["user_id"], ["us", "event_id"], 16).follow(stream)


# --- queues in lots


def _lot_sql(n: int, size: int) -> str:
    """SQL for ``n`` lots of a queue, each a pair of tables: what a lot does to the places that the one before left."""
    out = ["WITH q0 AS (SELECT o_custkey AS queue, o_orderkey AS item, o_orderkey AS pos FROM orders)"]
    for i in range(1, n + 1):
        out.append(f"""a{i} AS (SELECT *, CASE (item + {i}) % 5 WHEN 0 THEN 'limit' WHEN 1 THEN 'outside' WHEN 2 THEN NULL ELSE 'done' END AS r, row_number() OVER (PARTITION BY queue ORDER BY pos) AS rn, max(pos) OVER (PARTITION BY queue) AS top FROM q{i - 1})""")
        out.append(f"""b{i} AS (SELECT *, coalesce(min(CASE WHEN rn <= {size} AND r = 'limit' THEN rn END) OVER (PARTITION BY queue), {size}) AS stop FROM a{i})""")
        out.append(f"""q{i} AS (SELECT queue, item, CASE WHEN rn <= stop AND r = 'limit' THEN top + 1 ELSE pos END AS pos FROM b{i} WHERE rn > stop OR r IS NULL OR r = 'limit')""")
    found = " UNION ALL ".join(f"SELECT queue, {i}::BIGINT AS lot, item, CASE r WHEN 'limit' THEN 'queued' ELSE r END AS state FROM b{i} WHERE rn <= stop AND r IS NOT NULL" for i in range(1, n + 1))
    return ", ".join(out) + " " + found


@query(_lot_sql(4, 3))
def lot_queue(spark, sf_dir):
    """Orders wait in a queue a customer and are worked off in four lots of three, over two runs of one stream."""
    ship_package(spark)
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("queue"), F.col("o_orderkey").alias("item"))
    put = o.select("queue", F.lit(None).cast("long").alias("lot"), "item", F.col("item").alias("position"), F.lit(None).cast("string").alias("result"))
    rest = (F.col("item") + F.col("lot")) % 5
    result = F.when(rest == 0, "limit").when(rest == 1, "outside").when(rest > 2, "done")

    def came(first: int, last: int):
        each = o.withColumn("lot", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))))
        return each.select("queue", "lot", "item", F.lit(None).cast("long").alias("position"), result.alias("result")).where("result IS NOT NULL")

    folder = _folder(spark, "queue")
    for rows in (put.unionByName(came(1, 2)), came(3, 4)):
        rows.write.mode("append").parquet(f"{folder}/landed")
        done = queues.run_lots(spark.readStream.schema(put.schema).parquet(f"{folder}/landed"), 3, f"{folder}/lots")
    return done
