"""Queries over ``pages``: addresses, links, lists, robots rules and markup fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.operators import link, rank
from millrace.plans.registry import query
from millrace.session import table

#: The parts of an address in RE2, as millrace.functions.urls takes them apart.
SQL_PARTS = r"""
parts AS (SELECT page_id, url, html, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS net,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*[^?#]*\?([^#]*)', 1) AS q FROM pages),
addr AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(net, '^.*@', ''), ':.*$', ''), '^www\.', '') AS host,
    CASE WHEN path = '' THEN '/' WHEN path <> '/' AND path LIKE '%/' THEN left(path, length(path) - 1) ELSE path END AS p,
    array_to_string(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_|ref=|gclid|fbclid)')), '&') AS kept FROM parts),
canon AS (SELECT *, scheme || '://' || net || p || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical,
    array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS registrable FROM addr)
"""


@query(f"""WITH {SQL_PARTS},
firsts AS (SELECT * FROM canon QUALIFY row_number() OVER (PARTITION BY canonical ORDER BY page_id) = 1)
SELECT registrable AS domain, regexp_extract(path, '^/([a-z][a-z])/', 1) AS lang, count(*) AS n FROM firsts
GROUP BY ALL ORDER BY n DESC, domain, lang LIMIT 10""")
def pages_by_domain(spark, sf_dir):
    """Keep-first on the canonical address, then the ten commonest domains and languages."""
    pages = table(spark, sf_dir, "pages").select("page_id", urls.canonical(F.col("url")).alias("canonical"), "url")
    firsts = rank.keep_first(pages, ["canonical"], ["page_id"])
    named = firsts.select(urls.registrable(F.col("url")).alias("domain"), F.regexp_extract(urls.path(F.col("url")), "^/([a-z][a-z])/", 1).alias("lang"))
    return named.groupBy("domain", "lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "domain", "lang").limit(10)


@query(f"WITH {SQL_PARTS} SELECT page_id, canonical, host, registrable FROM canon")
def canonical_url(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.canonical(u).alias("canonical"), urls.host(u).alias("host"), urls.registrable(u).alias("registrable"))


@query(rf"""WITH {SQL_PARTS} SELECT page_id,
left(regexp_replace(lower(regexp_replace(url, '^[a-z]+://', '')), '[^a-z0-9]+', '-', 'g'), 70) || '-' || left(sha256(url), 10) AS slug,
trim(regexp_replace(path, '[-_/]+', ' ', 'g')) AS words FROM canon""")
def url_slug_hash(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.file_slug(u).alias("slug"), urls.path_words(u).alias("words"))


@query(r"""SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1) AS h1,
len(regexp_extract_all(html, '(?i)<a\s'))::BIGINT AS n_links, len(regexp_extract_all(html, '(?i)<p>'))::BIGINT AS n_paragraphs,
regexp_extract(html, '(?i)<html lang="([a-z]+)"', 1) AS lang FROM pages""")
def html_fields(spark, sf_dir):
    """Fields that fixed patterns reach, without Python."""
    h = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract(h, "(?is)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract(h, "(?is)<h1>(.*?)</h1>", 1).alias("h1"),
        F.regexp_count(h, F.lit(r"(?i)<a\s")).cast("long").alias("n_links"), F.regexp_count(h, F.lit("(?i)<p>")).cast("long").alias("n_paragraphs"),
        F.regexp_extract(h, '(?i)<html lang="([a-z]+)"', 1).alias("lang"),
    )


@query(r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href FROM pages)
SELECT href, count(*) AS n, count(DISTINCT page_id) AS n_pages FROM a GROUP BY href""")
def html_links(spark, sf_dir):
    """Every link target with the pages that have it."""
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)">'), F.lit(1))).alias("href"))
    return links.groupBy("href").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("n_pages"))


@query(r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hs, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS ts FROM pages),
e AS (SELECT page_id, unnest(hs) AS href, unnest(ts) AS label, unnest(range(1, len(hs) + 1)) AS pos FROM a)
SELECT page_id, pos, href, trim(regexp_replace(label, '\s+', ' ', 'g')) AS label FROM e WHERE regexp_matches(href, '^/[a-z]') AND length(label) >= 5""")
def anchor_items(spark, sf_dir):
    """Items of pages without a feed: links of one form whose text is long enough, in page order."""
    pattern = F.lit('<a href="([^"]*)">([^<]*)</a>')
    zipped = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("href"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("label"))
    items = table(spark, sf_dir, "pages").select("page_id", F.posexplode(zipped).alias("i", "a"))
    items = items.where(F.col("a.href").rlike("^/[a-z]") & (F.char_length("a.label") >= 5))
    return items.select("page_id", (F.col("i") + 1).cast("long").alias("pos"), F.col("a.href").alias("href"), F.trim(F.regexp_replace("a.label", r"\s+", " ")).alias("label"))


#: Domains, and a domain with a path, as a crawl's lists hold them.
BLOCKED = ("example.net", "cheap-pills.example.com", "example.org/fr")


@query(f"""WITH {SQL_PARTS} SELECT page_id, host FROM canon WHERE host = 'example.net' OR host LIKE '%.example.net'
OR host = 'cheap-pills.example.com' OR host LIKE '%.cheap-pills.example.com'
OR ((host = 'example.org' OR host LIKE '%.example.org') AND starts_with(ltrim(path, '/'), 'fr'))""")
def domain_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").where(urls.on_list(F.col("url"), BLOCKED))
    return pages.select("page_id", urls.host(F.col("url")).alias("host"))


#: Robots rules (kind, pattern); ``*`` is any run and ``$`` the end.
ROBOTS = (("disallow", "/"), ("allow", "/en/"), ("allow", "/*.html$"), ("disallow", "/en/*?page="), ("allow", "/fr/1"), ("disallow", "/fr/12"))


def robots_regex(pattern: str) -> str:
    """A robots pattern as a regular expression from the path's start."""
    end = "$" if pattern.endswith("$") else ""
    body = pattern.removesuffix("$")
    return "^" + "".join(".*" if c == "*" else "\\" + c if c in r".?+()[]{}^$|\\" else c for c in body) + end


def robots_allowed(path, rules=ROBOTS):
    """Permission of a path with its query: the longest pattern wins, allow wins a tie, no rule permits."""
    size = {kind: F.lit(-1) for kind in ("allow", "disallow")}
    for kind, pattern in rules:
        if pattern:
            size[kind] = F.greatest(size[kind], F.when(path.rlike(robots_regex(pattern)), len(pattern)).otherwise(-1))
    return (size["disallow"] < 0) | (size["allow"] >= size["disallow"])


_CASES = {k: ", ".join(f"CASE WHEN regexp_matches(target, '{robots_regex(p)}') THEN {len(p)} ELSE -1 END" for kind, p in ROBOTS if kind == k) for k in ("allow", "disallow")}


@query(f"""WITH {SQL_PARTS}, t AS (SELECT page_id, path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS target FROM canon),
r AS (SELECT page_id, greatest({_CASES['allow']}) AS a, greatest({_CASES['disallow']}) AS d FROM t)
SELECT page_id, d < 0 OR a >= d AS allowed FROM r""")
def robots_allow(spark, sf_dir):
    q = F.regexp_extract("url", r"^[^?#]*\?([^#]*)", 1)
    target = F.concat(urls.path(F.col("url")), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    return table(spark, sf_dir, "pages").select("page_id", robots_allowed(target).alias("allowed"))


#: A small dimension of host endings and what they stand for.
ZONES = (("com", "commercial"), ("example.com", "test"), ("pills.example.com", "shop"), ("net", "network"), ("org", "organisation"))


@query(f"""WITH {SQL_PARTS}, dim(suffix, zone) AS (VALUES {", ".join(map(str, ZONES))}),
m AS (SELECT page_id, max_by(zone, length(suffix)) AS zone FROM canon JOIN dim ON ends_with(host, suffix) GROUP BY page_id)
SELECT page_id, host, zone FROM canon LEFT JOIN m USING (page_id)""")
def suffix_country(spark, sf_dir):
    """The longest of a dimension's endings that fits each host."""
    hosts = table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"))
    return link.longest_suffix(hosts, F.col("host"), spark.createDataFrame(ZONES, "suffix string, value string"), "suffix", "value", "zone")


@query(f"""WITH {SQL_PARTS} SELECT page_id, CASE WHEN host = 'example.org' OR host LIKE '%.example.org' THEN 'associacao'
WHEN regexp_matches(host, '\\.(edu|ac\\.[a-z][a-z]|net)$') THEN 'academico' WHEN host LIKE 'blog.%' THEN 'comentarista' ELSE 'fornecedor' END AS grupo FROM canon""")
def source_group(spark, sf_dir):
    """An ordered cascade: the first rule that fits names the group."""
    h = urls.host(F.col("url"))
    group = (
        F.when(urls.on_list(F.col("url"), ["example.org"]), "associacao").when(h.rlike(r"\.(edu|ac\.[a-z][a-z]|net)$"), "academico")
        .when(h.startswith("blog."), "comentarista").otherwise("fornecedor")
    )
    return table(spark, sf_dir, "pages").select("page_id", group.alias("grupo"))


@query(f"""WITH {SQL_PARTS}, names(domain, publisher) AS (VALUES ('example.com', 'Com Press'), ('example.org', 'Org Press'))
SELECT page_id, coalesce(publisher, nullif(regexp_extract(html, '(?i)og:site_name" content="([^"]*)"', 1), ''), host) AS publisher FROM canon LEFT JOIN names ON registrable = domain""")
def publisher_of_url(spark, sf_dir):
    names = spark.createDataFrame([("example.com", "Com Press"), ("example.org", "Org Press")], "domain string, publisher string")
    pages = table(spark, sf_dir, "pages").withColumn("domain", urls.registrable(F.col("url")))
    own = link.some(F.regexp_extract("html", '(?i)og:site_name" content="([^"]*)"', 1))
    return pages.join(names, "domain", "left").select("page_id", F.coalesce("publisher", own, urls.host(F.col("url"))).alias("publisher"))


@query(f"""WITH {SQL_PARTS}, mail AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}')) AS email FROM documents),
src AS (SELECT regexp_extract(email, '@mail([0-9])', 1) AS k, email, doc_id FROM mail),
best AS (SELECT k, min_by(email, (doc_id, email)) AS email FROM src GROUP BY k)
SELECT page_id, host, coalesce(email, '') AS email, CASE WHEN email IS NULL THEN 'pages' ELSE 'pages+site' END AS fonte FROM canon LEFT JOIN best ON k = (page_id % 12)::VARCHAR""")
def email_fill(spark, sf_dir):
    """The first address per key of another source fills empty ones, and provenance says so."""
    pages = table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"), (F.col("page_id") % 12).cast("string").alias("k"), F.lit("").alias("email"), F.lit("pages").alias("fonte"))
    mail = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), F.lit(0))).alias("email"))
    best = mail.groupBy(F.regexp_extract("email", "@mail([0-9])", 1).alias("k")).agg(F.min_by("email", F.struct("doc_id", "email")).alias("email"))
    return link.fill_from(pages, best, "k", ["email"], ("fonte", "+site")).drop("k")


@query(f"""WITH {SQL_PARTS}, g AS (SELECT registrable AS domain, count(*) AS n, count(*) FILTER (q <> '') AS with_query, count(*) FILTER (scheme = 'https') AS secure,
count(DISTINCT nullif(host, '')) AS hosts FROM canon GROUP BY registrable)
SELECT *, (100 * n // sum(n) OVER ())::BIGINT AS percent FROM g""")
def host_shares(spark, sf_dir):
    """Conditional counts, distinct filled values, and each group's whole per cent of all."""
    u = F.col("url")
    pages = table(spark, sf_dir, "pages").select(urls.registrable(u).alias("domain"), urls.host(u).alias("host"), u)
    g = pages.groupBy("domain").agg(
        F.count("*").alias("n"), F.count_if(F.regexp_extract("url", r"^[^?#]*\?([^#]*)", 1) != "").alias("with_query"),
        F.count_if(u.startswith("https:")).alias("secure"), F.count_distinct(link.some("host")).alias("hosts"),
    )
    total = g.agg(F.sum("n").alias("_all"))
    return g.join(F.broadcast(total)).withColumn("percent", F.floor(F.col("n") * 100 / F.col("_all")).cast("long")).drop("_all")
