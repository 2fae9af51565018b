"""Scalar functions over columns of the driver's tables; where a form is made up from a key, the SQL says what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import contact, dates, text, urls
from millrace.plans.registry import query
from millrace.session import table


def _text(column):
    return F.col(column).cast("string")


@query("""SELECT c_custkey, 'Street ' || c_custkey || ', ' || c_mktsegment AS address, 'info' || c_custkey || '@mail' || c_nationkey || '.com' AS email, '+55 11 9' || lpad(c_custkey::VARCHAR, 8, '0') AS phone FROM customer""")
def address_split(spark, sf_dir):
    """Blocks of labelled lines taken apart: labels go, an e-mail and a telephone number leave the address."""
    k = _text("c_custkey")
    block = F.concat(F.lit("Address: Street "), k, F.lit("\n"), F.col("c_mktsegment"), F.lit("\n\nTel: +55 11 9"), F.lpad(k, 8, "0"), F.lit("\nE-mail: info"), k, F.lit("@mail"), _text("c_nationkey"), F.lit(".com"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.split_address(block).alias("a")).select("c_custkey", "a.*")


@query("""SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN 'Brazil' WHEN 1 THEN 'South Korea' ELSE 'Peru' END AS country, CASE c_nationkey % 3 WHEN 0 THEN 'PE' ELSE '' END AS state,
CASE c_nationkey % 3 WHEN 0 THEN 'Torre ' || c_mktsegment ELSE '' END AS building FROM customer""")
def address_places(spark, sf_dir):
    """Country, state and building of addresses in three styles; a country's name may have a comma."""
    n = F.col("c_nationkey") % 3
    address = (
        F.when(n == 0, F.concat(F.lit("Rua X 12, Torre "), "c_mktsegment", F.lit(", Recife - PE, Brasil")))
        .when(n == 1, F.concat(F.lit("1 Main Street, "), "c_name", F.lit(", Korea, Republic of"))).otherwise(F.concat("c_name", F.lit(", Lima, peru.")))
    )
    aliases = {"brasil": "Brazil", "korea, republic of": "South Korea"}
    found = table(spark, sf_dir, "customer").select("c_custkey", address.alias("a"))
    return found.select("c_custkey", text.country_of_address(F.col("a"), aliases).alias("country"), text.state_of_address(F.col("a")).alias("state"), text.building_of_address(F.col("a")).alias("building"))


@query("""SELECT c_custkey, 'Lodz Zabka ' || c_custkey AS polish, 'Istanbul Sogus ' || c_custkey AS turkish, 'ΕΡΕΥΝΑ ' || c_custkey AS greek,
CASE WHEN c_nationkey % 2 = 0 THEN 'ΕΤΑΙΡΙΑ' ELSE upper(c_mktsegment) END = 'ΕΤΑΙΡΙΑ' AS known FROM customer""")
def letter_folds(spark, sf_dir):
    """Letters that decomposition leaves alone, Greek capitals, and Greek words written with Latin look-alikes."""
    k = _text("c_custkey")
    polish, turkish = F.concat(F.lit("Łódź Żabka "), k), F.concat(F.lit("İstanbul Söğüş "), k)
    word = F.when(F.col("c_nationkey") % 2 == 0, F.lit("ETAIPIA")).otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.fold(F.translate(polish, *text.POLISH)).alias("polish"), text.fold(F.translate(turkish, *text.TURKISH)).alias("turkish"),
        text.greek_upper(F.concat(F.lit("έρευνα "), k)).alias("greek"), text.greek_category(word, ["ΕΤΑΙΡΙΑ"])["known"].alias("known"),
    )


@query(r"""SELECT doc_id, CASE WHEN n > 0 THEN length(regexp_replace(text, '\P{Latin}', '', 'g')) >= n * 0.7 END AS latin FROM (SELECT doc_id, text, length(regexp_replace(text, '\P{L}', '', 'g')) AS n FROM documents)""")
def script_majority(spark, sf_dir):
    """Whether a text is in Latin letters for the most part."""
    return table(spark, sf_dir, "documents").select("doc_id", text.mostly_script(F.col("text")).alias("latin"))


@query("""SELECT c_custkey, 'customer.com.br|customer.com|customer' || d || '.com.br|customer' || d || '.com' AS guesses, 'customer-' || d AS slug FROM (SELECT c_custkey, regexp_extract(c_name, '[0-9]+') AS d FROM customer)""")
def domain_guesses(spark, sf_dir):
    """Domains that a company of a name may have, and its slug."""
    name = F.replace(F.col("c_name"), F.lit("#"), F.lit(" "))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(text.domain_guesses(name), "|").alias("guesses"), text.slug(F.col("c_name")).alias("slug"))


@query("""SELECT s_suppkey, 'Acme ' || chr(65 + s_nationkey) AS from_logo, 'Annual Report ' || chr(65 + s_nationkey) AS from_document,
s_nationkey % 2 = 0 AS fits FROM supplier""")
def names_from_files(spark, sf_dir):
    """Names out of logo and document files, and whether a name and a domain agree."""
    digits, letter = F.regexp_extract("s_name", "[0-9]+", 0), F.char(F.col("s_nationkey") + 97)
    logo = F.concat(F.lit("https://x/img/logo-acme_"), letter, F.lit("-300x200.png?v=1"))
    pdf = F.concat(F.lit("/docs/annual-report-"), letter, F.lit("-v2-final.pdf"))
    domain = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("supplier"), digits, F.lit(".com"))).otherwise(F.lit("elsewhere.org"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.name_of_file(logo).alias("from_logo"), text.name_of_file(pdf).alias("from_document"), text.name_fits_domain(F.col("s_name"), domain).alias("fits"))


@query("""SELECT c_custkey, 'write to info' || c_custkey || '@mail.com now' AS shown, lpad(c_custkey::VARCHAR, 8, '0') AS plain FROM customer""")
def deobfuscated(spark, sf_dir):
    """Addresses written with (at) and [dot], and text XORed with its first byte."""
    k = _text("c_custkey")
    # XOR with 1 swaps the digits of each even and odd pair
    code = F.concat(F.lit("01"), F.hex(F.translate(F.lpad(k, 8, "0"), "0123456789", "1032547698")))
    hidden = F.concat(F.lit("write to info"), k, F.lit(" (at) mail [DOT] com now"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.deobfuscate(hidden).alias("shown"), text.xor_hex(code).alias("plain"))


@query("""SELECT o_orderkey, replace(format('{:,}', floor(o_totalprice)::BIGINT), ',', '.') AS shown, floor(o_totalprice) + 0.5 AS read,
CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN o_orderpriority || ' e ' || o_orderstatus ELSE o_orderpriority || ', ' || o_orderstatus || ' e x' END AS listed FROM orders""")
def numbers_and_lists(spark, sf_dir):
    """Numbers with a thousands mark, read back with a decimal comma; lists as prose."""
    shown = text.thousands(F.floor("o_totalprice"))
    s = F.col("o_orderstatus")
    parts = F.when(s == "F", F.array("o_orderpriority")).when(s == "O", F.array("o_orderpriority", "o_orderstatus")).otherwise(F.array(F.col("o_orderpriority"), s, F.lit("x")))
    return table(spark, sf_dir, "orders").select("o_orderkey", shown.alias("shown"), dates.number(F.concat(F.lit("R$ "), shown, F.lit(",5 por mes"))).alias("read"), text.listed(parts).alias("listed"))


@query("""SELECT c_custkey, c_name AS title, CASE c_mktsegment WHEN 'FURNITURE' THEN '' WHEN 'MACHINERY' THEN '' ELSE regexp_extract(c_name, '[0-9]+') || ' site ' || c_mktsegment END AS plain FROM customer""")
def titles_and_markdown(spark, sf_dir):
    """The first part of a page title; Markdown as plain words, placeholders as nothing."""
    m = F.col("c_mktsegment")
    marked = F.when(m == "FURNITURE", " **N/A** ").when(m == "MACHINERY", "-").otherwise(F.concat(F.lit("**"), F.regexp_extract("c_name", "[0-9]+", 0), F.lit("**  [site](https://x/y) `"), m, F.lit("`")))
    return table(spark, sf_dir, "customer").select("c_custkey", text.title_part(F.concat("c_name", F.lit(" | "), m, F.lit(" – home"))).alias("title"), text.without_markdown(marked).alias("plain"))


@query("""SELECT page_id, CASE WHEN page_id = 0 THEN '' ELSE 'https://' || regexp_extract(url, '://(.*)', 1) END AS completed, url AS target, 'p' || page_id AS id, page_id / 4.0 AS lat, -1.5::DOUBLE AS lng FROM pages""")
def url_parts(spark, sf_dir):
    """Schemes completed, redirects unwrapped, ids and coordinates read."""
    bare = F.when(F.col("page_id") == 0, " ").otherwise(F.concat(F.lit("//"), F.regexp_extract("url", "://(.*)", 1)))
    wrapped = F.concat(F.lit("https://r.example/go?a=1&url="), F.url_encode("url"))
    place = F.concat(F.lit("https://m.example/place/@"), F.format_string("%.2f", F.col("page_id") / 4), F.lit(",-1.50,17z?id=p"), _text("page_id"))
    p = table(spark, sf_dir, "pages").select("page_id", urls.with_scheme(bare).alias("completed"), urls.unwrapped(wrapped).alias("target"), urls.id_and_place(place).alias("_p"))
    return p.select("page_id", "completed", "target", "_p.id", "_p.lat", "_p.lng")


@query("""SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN '' WHEN c_nationkey = 1 THEN d[:4] || '-' || d[5:] ELSE '(' || c_nationkey || ') ' || d[:4] || '-' || d[5:] END AS phone, CASE WHEN c_nationkey = 0 THEN '' ELSE d END AS digits
FROM (SELECT c_custkey, c_nationkey, lpad(c_custkey::VARCHAR, 8, '0') AS d FROM customer)""")
def phone_forms(spark, sf_dir):
    d = F.lpad(_text("c_custkey"), 8, "0")
    number = F.when(F.col("c_nationkey") > 0, F.concat(F.left(d, F.lit(2)), F.lit(" "), F.substring(d, 3, 6), F.lit(" x")))
    area = F.when(F.col("c_nationkey") > 1, _text("c_nationkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", contact.phone(area, number).alias("phone"), contact.digits(number).alias("digits"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE CASE WHEN year(o_orderdate) >= 2000 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'not found' END END AS found,
CASE WHEN strftime(o_orderdate, '%Y-%m') BETWEEN '1995-01' AND '1996-06' THEN 'in' ELSE 'out' END AS monthly, CASE WHEN strftime(o_orderdate, '%Y-%m-%d') BETWEEN '1995-01-15' AND '1996-06-10' THEN 'in' ELSE 'out' END AS daily FROM orders""")
def page_dates(spark, sf_dir):
    """The day that a page gives in metadata, structured data or its address, and whether a date is in a window, as far as it's precise."""
    day, s = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus")
    meta = F.when(s == "F", F.concat(F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("T10:00:00Z")))
    jsonld = F.when(s == "O", F.concat(F.lit('{"@type": "Article", "datePublished" : "'), day, F.lit('T00:00"}')))
    url = F.concat(F.lit("https://x/"), F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("/post"))
    confidence = lambda v: dates.date_confidence(v, "1995-01-15", "1996-06-10")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.page_date(meta, jsonld, url).alias("found"), confidence(F.left(day, F.lit(7))).alias("monthly"), confidence(day).alias("daily"))


@query("""SELECT c_custkey, CASE WHEN a = 0 THEN b::VARCHAR WHEN b >= a THEN array_to_string(range(a, b + 1), ',') ELSE '' END AS grades FROM (SELECT c_custkey, c_custkey // 10 % 10 AS a, c_custkey % 10 AS b FROM customer)""")
def grade_codes(spark, sf_dir):
    """Grades that a curriculum code covers."""
    code = F.concat(F.lit("EF"), (F.floor(F.col("c_custkey") / 10) % 10).cast("string"), (F.col("c_custkey") % 10).cast("string"), F.lit("LP01"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(dates.grades_of_code(code), ",").alias("grades"))


@query("""SELECT doc_id, length(b)::BIGINT AS chars, CASE WHEN length(b) > 0 THEN (length(b) + 1799) // 1800 ELSE 0 END AS blocks, coalesce(right(b, (length(b) - 1) % 1800 + 1), '') AS last FROM (SELECT doc_id, text AS b FROM documents)""")
def fixed_blocks(spark, sf_dir):
    """Texts in blocks of a fixed size: how many, and the last one."""
    from millrace.sources.files import text_blocks

    b = table(spark, sf_dir, "documents").select("doc_id", "text", text_blocks(F.col("text")).alias("b"))
    return b.select("doc_id", F.char_length(F.array_join("b", "")).cast("long").alias("chars"), F.size("b").cast("long").alias("blocks"), F.coalesce(F.try_element_at("b", F.lit(-1)), F.lit("")).alias("last"))


@query("SELECT doc_id, text, CASE lang WHEN 'en' THEN 'utf-8' WHEN 'fr' THEN 'utf-16-le' ELSE 'utf-8' END AS codec FROM documents")
def charset_decision(spark, sf_dir):
    """Bodies in two encodings, with and without a header that says so, decoded again."""
    from millrace.session import ship_package

    ship_package(spark)
    french, german = F.col("lang") == "fr", F.col("lang") == "de"
    raw = F.when(french, F.encode("text", "UTF-16LE")).when(german, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8"))).otherwise(F.encode("text", "UTF-8"))
    header = F.when(french, "utf-16-le").when(F.col("lang") == "es", "no-such-codec")
    d = table(spark, sf_dir, "documents").select("doc_id", text.decode_bytes(raw, header).alias("d"))
    return d.select("doc_id", F.col("d.text").alias("text"), F.col("d.codec").alias("codec"))


@query(r"""WITH l AS (SELECT doc_id, pos, trim(line) AS x FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) WHERE trim(line) <> ''),
f AS (SELECT *, lag(x) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM l),
b AS (SELECT *, CASE WHEN before IS NULL OR NOT (regexp_matches(x, '^[\p{Ll},;:.)%]') OR (length(x) < 25 AND NOT regexp_matches(before, '[.!?"”'')…:]$'))) THEN 1 ELSE 0 END AS fresh FROM f),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM b),
p AS (SELECT doc_id, run, trim(regexp_replace(string_agg(x, ' ' ORDER BY pos), '\s+', ' ', 'g')) AS t FROM r GROUP BY doc_id, run HAVING count(*) < 4 OR 2 * count(*) FILTER (length(x) < 25) <= count(*))
SELECT doc_id, count(t) AS n, coalesce(sum(length(t)), 0)::BIGINT AS chars, coalesce(min_by(t, run), '') AS first FROM documents LEFT JOIN (SELECT * FROM p WHERE regexp_matches(t, '[.!?"”'')…]$')) p USING (doc_id) GROUP BY doc_id""")
def paragraph_blocks(spark, sf_dir):
    """Paragraphs put together from lines: how many, how long, and the first."""
    p = table(spark, sf_dir, "documents").select("doc_id", text.paragraphs(F.col("text"), most=None).alias("p"))
    return p.select("doc_id", F.size("p").cast("long").alias("n"), F.char_length(F.array_join("p", "")).cast("long").alias("chars"), F.coalesce(F.try_element_at("p", F.lit(1)), F.lit("")).alias("first"))


@query("""SELECT c_custkey, 'contato@own' || c_nationkey || '.com,zoe@own' || c_nationkey || '.com,comercial@gmail.com,bob@other.com' AS best, c_nationkey % 2 = 0 AS elsewhere FROM customer""")
def email_ranking(spark, sf_dir):
    """Addresses in order of use: own domain, preferred names, the alphabet; files and placeholders out; other regions told."""
    own = F.concat(F.lit("own"), _text("c_nationkey"), F.lit(".com"))
    emails = F.array(F.lit("bob@other.com"), F.concat(F.lit("Zoe@"), own), F.lit("logo@2x.png"), F.lit("comercial@gmail.com"), F.lit("user@mail.com"), F.concat(F.lit("contato@"), own), F.lit("bob@other.com"))
    region = F.when(F.col("c_nationkey") % 2 == 0, "sales.mexico@x.com").otherwise("mexicana@x.com")
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(contact.useful(emails, own), ",").alias("best"), contact.other_region(region).alias("elsewhere"))
