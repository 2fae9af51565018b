"""Company and case fields over sentences, links and metadata made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import companies
from millrace.plans.registry import query
from millrace.session import table


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'https://youtu.be/' || c_custkey END AS video, CASE WHEN c_custkey % 2 = 0 THEN ['https://news.com/long-article-' || c_custkey] ELSE []::VARCHAR[] END AS press,
c_custkey % 4 = 0 AS customers, c_custkey % 5 = 0 AS case_page FROM customer""")
def company_links(spark, sf_dir):
    """Videos, articles of the press, sentences that name customers, pages of cases."""
    k = F.col("c_custkey").cast("string")
    video = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("https://youtu.be/"), k)).otherwise("https://youtube.com/about")
    article = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("https://news.com/long-article-"), k)).otherwise("https://news.com/short")
    links = F.array(F.lit("https://acme.com/watch"), article, video, article)
    said = F.when(F.col("c_custkey") % 4 == 0, "Trusted by Nestle, Some Teams and Coca-Cola").otherwise("Nestle and Unilever: trusted by Acme, Many Brands and Kraft")
    url = F.concat(F.lit("https://acme.com"), F.when(F.col("c_custkey") % 5 == 0, "/case-studies/x").otherwise("/case-studies/"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", companies.demo_video(links).alias("video"), companies.press_links(links, F.lit("https://acme.com/"), ("news.com",)).alias("press"),
        companies.names_customers(said, "trusted by", F.lit("Acme")).alias("customers"), companies.is_case_page(url).alias("case_page"),
    )


@query("""WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus AS s, o_orderkey % 3 AS m FROM orders),
r AS (SELECT *, CASE WHEN s = 'F' AND m < 2 THEN 1 WHEN m = 1 THEN 2 WHEN s = 'F' THEN 3 END AS r FROM o),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY r NULLS LAST, o_orderkey) = 1)
SELECT o_custkey, CASE WHEN r < 3 THEN 'It is $' || o_orderkey || CASE WHEN m = 1 THEN ' per month' ELSE '' END WHEN r = 3 THEN 'Talk to sales' END AS preco, CASE WHEN r IS NULL THEN 'not found' ELSE 'literal' END AS tipo,
CASE WHEN r = 2 THEN 'https://x/about' WHEN r IS NOT NULL THEN 'https://x/pricing' END AS url FROM b""")
def company_prices(spark, sf_dir):
    """A price by where it stands: page of prices, context, page without one."""
    m, k = F.col("o_orderkey") % 3, F.col("o_orderkey").cast("string")
    page = F.when(F.col("o_orderstatus") == "F", "https://x/pricing").otherwise("https://x/about")
    said = F.when(m == 0, F.concat(F.lit("It is $"), k)).when(m == 1, F.concat(F.lit("It is $"), k, F.lit(" per month"))).otherwise("Talk to sales")
    rows = table(spark, sf_dir, "orders").select("o_custkey", page.alias("url"), F.lit(0).alias("priority"), F.col("o_orderkey").alias("pos"), said.alias("sentence"))
    return companies.prices(rows, "o_custkey", r"\$\d+$|\$\d+ per", "per month", "talk to sales")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Cited' WHEN 1 THEN 'Open' WHEN 2 THEN 'Head' END AS titulo, CASE c_custkey % 4 WHEN 0 THEN 'citation_title' WHEN 1 THEN 'og:title' WHEN 2 THEN 'h1' END AS origem,
CASE WHEN c_acctbal < 0 THEN 'negativo_ou_misto' ELSE 'positivo_ou_neutro' END AS sinal, CASE c_custkey % 5 WHEN 0 THEN 'autodeclarado' WHEN 1 THEN 'independente' WHEN 2 THEN 'independente' ELSE 'autodeclarado' END AS quem,
CASE c_custkey % 3 WHEN 0 THEN 'Acme Inc, (UK)' WHEN 1 THEN 'Acme Inc' END AS fornecedor FROM customer""")
def case_fields(spark, sf_dir):
    """Title by source, sign of the result, who vouches, the vendor's name as the page has it."""
    i = F.col("c_custkey")
    meta = F.when(i % 4 == 0, F.create_map(F.lit("og:title"), F.lit("Open"), F.lit("citation_title"), F.lit("Cited"))).when(i % 4 == 1, F.create_map(F.lit("og:title"), F.lit("Open"), F.lit("citation_title"), F.lit(""))).otherwise(F.create_map(F.lit("x"), F.lit("y")))
    url = F.when(i % 5 == 0, "https://www.vendor.com/a").when(i % 5 == 1, "https://arxiv.org/abs/1").otherwise("https://other.com/")
    evidence = F.when(i % 5 == 2, "Peer reviewed").when(i % 5 == 3, "self-declared")
    page = F.when(i % 3 == 0, "by Acme Inc, (UK) and others").when(i % 3 == 1, "by Acme Inc and others").otherwise("by nobody")
    title = companies.case_title(meta, F.when(i % 4 == 2, "Head").otherwise(""), F.lit(""))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", title["value"].alias("titulo"), title["source"].alias("origem"), companies.case_signal(F.when(F.col("c_acctbal") < 0, "It did  not match").otherwise("It matched")).alias("sinal"),
        companies.independence(url, F.lit("vendor.com"), ("arxiv.org",), evidence).alias("quem"), companies.name_on_page(F.lit("Acme Inc, (UK)"), page).alias("fornecedor"),
    )
