"""Records of sources: feeds, files, stores, fields, candidates, findings and reports, made from the driver's tables."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import classify, extract, filters, link, rank, review, stores
from millrace.plans.registry import query
from millrace.session import table
from millrace.sources import files, markup, sinks


def _text(column):
    return F.col(column).cast("string")


def _folder(spark):
    from millrace.streaming.files import shared_folder

    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


# --- predicates


@query("""SELECT s_suppkey, s_nationkey % 4 IN (1, 2) AS company, s_nationkey % 4 = 1 AND s_nationkey <> 5 AS commercial, s_nationkey % 3 = 0 AS brand FROM supplier""")
def sponsor_predicates(spark, sf_dir):
    """Names that look like companies', sponsors that buy, names of a brand."""
    n = F.col("s_nationkey")
    name = F.when(n % 4 == 0, "Dr. Ana Research").when(n % 4 == 1, F.concat(F.lit("Acme Research "), n.cast("string"))).when(n % 4 == 2, "Beta GmbH").otherwise("Just a Name")
    level = F.when(n % 4 == 1, "Gold").otherwise("Media")
    shop = F.when(n % 3 == 0, "Açaí do Zé").when(n % 3 == 1, "Acai do Ze Kids").otherwise("Outro")
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", filters.is_company(name).alias("company"), filters.is_commercial(name, level, ["acme5"]).alias("commercial"), filters.is_brand(shop, "^acai do ze", "kids").alias("brand")
    )


@query("""SELECT c_custkey FROM customer WHERE c_acctbal / 100 BETWEEN 10 AND 60 AND c_nationkey BETWEEN 3 AND 20 AND regexp_matches(c_mktsegment, '^(FURN|MACH)')""")
def bounding_box(spark, sf_dir):
    """Places inside a box whose category fits."""
    c = table(spark, sf_dir, "customer")
    return c.where(filters.in_box(F.col("c_acctbal") / 100, F.col("c_nationkey"), 10, 3, 60, 20) & F.col("c_mktsegment").rlike("^(FURN|MACH)")).select("c_custkey")


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'principal' ELSE 'secundaria' END AS role FROM customer WHERE c_mktsegment = 'FURNITURE' OR c_nationkey % 2 = 0""")
def activity_codes(spark, sf_dir):
    """Companies with an activity as their first or a further one."""
    further = F.when(F.col("c_nationkey") % 2 == 0, "BUILDING, FURNITURE ,X").when(F.col("c_nationkey") % 3 == 0, "FURNITURES")
    return table(spark, sf_dir, "customer").select("c_custkey", filters.activity_role(F.col("c_mktsegment"), further, "FURNITURE").alias("role")).where("role is not null")


@query("""SELECT doc_id FROM documents WHERE NOT contains(lower(text), 'idiot') AND NOT contains(lower(text), 'all rights reserved')""")
def forbidden_names(spark, sf_dir):
    return filters.without_names(table(spark, sf_dir, "documents"), "text", ["Idiot", "All Rights Reserved"]).select("doc_id")


@query("""SELECT p_partkey FROM part WHERE p_brand[7:7] IN ('1', '2')""")
def publishable_facts(spark, sf_dir):
    """Facts of a confidence that may be published."""
    confidence = F.translate(F.substring("p_brand", 7, 1), "12345", "ABCDE")
    return table(spark, sf_dir, "part").where(filters.publishable(confidence)).select("p_partkey")


@query(r"""SELECT doc_id, NOT contains(text, 'token = ') AND lang <> 'de' AS usable, regexp_matches(lower(text), 'tion|ment') AND contains(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]', '', 'g'), lang || 'e') AS confirmed,
regexp_matches(text, 'ing|ent') AND regexp_matches(text, 'tion') AS aprovada, CASE WHEN NOT regexp_matches(text, 'ing|ent') THEN 'no offer' WHEN NOT regexp_matches(text, 'tion') THEN 'off topic' ELSE '' END AS motivo FROM documents""")
def candidate_approval(spark, sf_dir):
    """Records that can be used, guessed sites that are right, candidates with a strong offer on the topic."""
    docs = table(spark, sf_dir, "documents")
    error, note = F.when(F.contains("text", F.lit("token = ")), "secret"), F.when(F.col("lang") == "de", "limited view")
    seen = filters.approved(docs, "text", "ing|ent", "tion")
    return seen.select("doc_id", filters.usable(error, note).alias("usable"), filters.site_confirmed(F.col("text"), F.concat("lang", F.lit("e")), ["tion", "ment"]).alias("confirmed"), "aprovada", "motivo")


@query("SELECT conv_id, turn FROM conversations WHERE role = 'user'")
def row_type(spark, sf_dir):
    """Rows of one type."""
    return table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn")


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'valido' WHEN 'O' THEN 'invalido' ELSE 'indeterminado' END AS status FROM orders""")
def status_vocabulary(spark, sf_dir):
    """A vendor's states in the one vocabulary."""
    return table(spark, sf_dir, "orders").select("o_orderkey", filters.normal_status(F.concat(F.lit(" "), F.lower("o_orderstatus")), {"f": "valido", "o": "invalido"}).alias("status"))


@query("""WITH f AS (SELECT event_type, user_id, min(event_id) AS first FROM events GROUP BY ALL), p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY first, user_id) AS place FROM f)
SELECT event_type, count(*) AS n, max(place) AS used FROM events JOIN p USING (event_type, user_id) WHERE place <= 6 GROUP BY event_type""")
def search_ceiling(spark, sf_dir):
    """Registered searches up to a ceiling a sweep; repeated ones use up nothing."""
    e = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    kept = filters.within_ceiling(e, ["event_type"], "user_id", "event_id", 6)
    return kept.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("used"))


@query("""SELECT n_name, o::INT AS ord, CASE o WHEN 0 THEN n_name || ' reviews' ELSE 'best ' || n_name || ' ' || n_name END AS consulta FROM nation, range(2) t(o)""")
def expanded_queries(spark, sf_dir):
    return filters.expanded_queries(table(spark, sf_dir, "nation"), "n_name", ["{} reviews", "best {} {}"])


@query("""WITH p AS (SELECT l_orderkey AS o_orderkey, min(l_shipdate)::DATE AS page FROM lineitem WHERE l_linenumber = 1 GROUP BY 1)
SELECT o_orderkey FROM orders LEFT JOIN p USING (o_orderkey) WHERE coalesce(page, o_orderdate::DATE) BETWEEN DATE '1997-06-30' - 400 AND DATE '1997-06-30' + 1""")
def late_contradiction(spark, sf_dir):
    """Items in the window by their listing, without those whose page gives another date outside it."""
    page = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_date(F.min("l_shipdate")).alias("page"))
    items = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")).join(page, "o_orderkey", "left")
    return filters.not_contradicted(items, "day", "page", F.lit("1997-06-30").cast("date"), 400).select("o_orderkey")


# --- names and people


@query("""SELECT c_custkey, c_nationkey % 4 IN (0, 1) AS decides, c_nationkey % 4 IN (0, 2) AS in_area FROM customer""")
def people_flags(spark, sf_dir):
    """Titles of people who decide, and of those who work in the trade."""
    n = F.col("c_nationkey") % 4
    title = F.when(n == 0, F.concat(F.lit("Sócio e Head of Insight, "), "c_name")).when(n == 1, F.concat(F.lit("Co-Founder & CEO "), "c_name")).when(n == 2, "UX Analyst").otherwise("Directorate clerk, database")
    return table(spark, sf_dir, "customer").select("c_custkey", extract.decision_maker(title).alias("decides"), extract.in_area(title).alias("in_area"))


@query("""WITH a AS (SELECT DISTINCT p_name AS a FROM part WHERE length(p_name) >= 5), b AS (SELECT DISTINCT CASE WHEN p_size % 3 = 0 THEN p_name || ' ' || p_type WHEN p_size % 3 = 1 THEN string_split(p_name, ' ')[2] ELSE p_type END AS b FROM part),
p AS (SELECT a, b FROM a JOIN b ON contains(' ' || a || ' ', ' ' || b || ' ') OR contains(' ' || b || ' ', ' ' || a || ' ')),
g AS (SELECT b, count(*) AS n, string_agg(a, ' / ' ORDER BY a) AS names, min(a) AS a FROM p GROUP BY b)
SELECT b, CASE WHEN n = 1 THEN a END AS a, coalesce(n, 0) AS n, CASE WHEN n > 1 THEN left('several: ' || names, 200) ELSE '' END AS error FROM b LEFT JOIN g USING (b)""")
def token_merge(spark, sf_dir):
    """Names merged with the one name of an index that fits; with several or none they stay apart."""
    p = table(spark, sf_dir, "part")
    a = link.name_index(p.select(F.col("p_name").alias("a")), "a")
    size = F.col("p_size") % 3
    b = p.select(F.when(size == 0, F.concat_ws(" ", "p_name", "p_type")).when(size == 1, F.get(F.split("p_name", " "), F.lit(1))).otherwise(F.col("p_type")).alias("b")).where("b is not null")
    return link.merge_by_tokens(a, b, "a", "b")


_PLACES = ("the", "and the", "released under", "all rights reserved", "licensed under the", "license", "que", "der", "de la")


@query(rf"""WITH n AS (SELECT unnest([{', '.join(map(repr, _PLACES))}]) AS name, unnest(range({len(_PLACES)})) AS ord), d AS (SELECT doc_id, ' ' || regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' ' AS t FROM documents)
SELECT doc_id, min_by(name, ord) AS first, min_by(name, (-length(name), name)) AS longest FROM d JOIN n ON contains(t, ' ' || name || ' ') GROUP BY doc_id""")
def names_in_text(spark, sf_dir):
    """The first and the longest of some names that a text has as whole words."""
    names = spark.createDataFrame([(n, i) for i, n in enumerate(_PLACES)], "name string, ord int")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    first = extract.mentions(docs, "doc_id", "text", names, "name", "ord").withColumnRenamed("name", "first")
    return first.join(extract.longest_mention(docs, "doc_id", "text", names, "name").withColumnRenamed("name", "longest"), "doc_id")


# --- classes and scores

_TYPES = {"platform": "ciones", "agency": "heit|ung "}


@query("""SELECT doc_id, CASE WHEN regexp_matches(head, '(?i)ciones') THEN 'platform' WHEN regexp_matches(head, '(?i)heit|ung ') THEN 'agency' WHEN regexp_matches(text, '(?i)ciones') THEN 'platform' WHEN regexp_matches(text, '(?i)heit|ung ') THEN 'agency' WHEN y >= 2022 THEN 'startup' ELSE 'indefinido' END AS type,
CASE WHEN doc_id % 5 = 0 THEN 'independente' WHEN regexp_matches(text, '(?i)(peer.?review|published in|white ?paper|study|estudo)') THEN 'estudo' WHEN regexp_matches(text, '[0-9]+\\s*%') THEN 'numero proprio' ELSE 'sem evidencia' END AS level,
CASE lang WHEN 'en' THEN 'validada' WHEN 'fr' THEN 'parcial' WHEN 'de' THEN 'sem base' ELSE 'outra' END AS basis FROM (SELECT *, left(text, 80) AS head, 2000 + doc_id % 40 AS y FROM documents)""".replace("\\\\", "\\"))
def company_types(spark, sf_dir):
    """Types by head, body and year; how claims are backed; the base of a validation."""
    status = F.when(F.col("lang") == "en", "validated").when(F.col("lang") == "fr", "parcial").when(F.col("lang") == "de", "").otherwise("x")
    return table(spark, sf_dir, "documents").select(
        "doc_id", extract.company_type(F.left("text", F.lit(80)), F.col("text"), F.col("doc_id") % 40 + 2000, _TYPES).alias("type"),
        extract.validation_level(F.col("text"), F.col("doc_id") % 5 == 0).alias("level"), extract.basis_of(status).alias("basis"),
    )


@query(r"""WITH c AS (SELECT doc_id, len(regexp_extract_all(strip_accents(lower(text)), '(?:^|[^a-z0-9])(?:thth|anan)')) AS n, len(regexp_extract_all(strip_accents(lower(text)), '(?:^|[^a-z0-9])(?:er|st)')) AS c FROM documents)
SELECT doc_id, CASE WHEN n = 0 AND c = 0 THEN 'none' WHEN n >= greatest(2, c / 2) THEN 'new' ELSE 'classic' END AS family FROM c""")
def method_family(spark, sf_dir):
    """The family whose terms prevail in a text."""
    return table(spark, sf_dir, "documents").select("doc_id", classify.family_by_ratio(F.col("text"), ["thth", "anan"], ["er", "st"]).alias("family"))


@query(r"""WITH s AS (SELECT conv_id, turn, text, len(list_distinct(list_transform(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{5,}'), lambda w: left(w, 6)))) AS stems FROM conversations)
SELECT conv_id, turn, round(stems * 2 + CASE WHEN regexp_matches(lower(text), '^(to|in|of)\b') AND ends_with(text, '?') THEN 1.5 ELSE 0 END - length(text)::DOUBLE / 400, 6) AS score,
CASE WHEN role = 'user' THEN 'question' WHEN length(text) > 400 THEN 'long' ELSE 'other' END AS section FROM s JOIN (SELECT conv_id, turn, role FROM conversations) USING (conv_id, turn)""")
def sentence_scores(spark, sf_dir):
    """Turns scored by stems, question words and length, and classed by the first rule that fits."""
    n = F.size(text.stems(F.col("text"), generic=[]))
    section = classify.first_fit([(F.col("role") == "user", "question"), (F.char_length("text") > 400, "long")], "other")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", classify.sentence_score(F.col("text"), n, ["to", "in", "of"]).alias("score"), section.alias("section"))


_FIELDS = {"license": "licensed under (?:the )?(\\w+)", "ending": "(\\w+)tion\\b"}


@query(r"""WITH s AS (SELECT doc_id, source, unnest(string_split(regexp_replace(replace(text, chr(10), chr(1)), '([.!?])\s+([A-Z0-9"''(])', '\1' || chr(1) || '\2', 'g'), chr(1))) AS x,
generate_subscripts(string_split(regexp_replace(replace(text, chr(10), chr(1)), '([.!?])\s+([A-Z0-9"''(])', '\1' || chr(1) || '\2', 'g'), chr(1)), 1) AS pos FROM documents),
f AS (SELECT source, doc_id, pos, trim(x) AS x FROM s WHERE length(trim(x)) >= 25),
a AS (SELECT source, min_by(regexp_extract(x, '(?i)licensed under (?:the )?([\p{L}\p{N}_]+)', 1), doc_id * 1000000 + pos) FILTER (regexp_matches(x, '(?i)licensed under (?:the )?([\p{L}\p{N}_]+)')) AS v, min(doc_id * 1000000 + pos) FILTER (regexp_matches(x, '(?i)licensed under (?:the )?([\p{L}\p{N}_]+)')) // 1000000 AS d FROM f GROUP BY source)
SELECT source, CASE WHEN v IS NULL THEN 'not found' ELSE 'literal' END AS kind, v AS license, d::VARCHAR AS url FROM a""")
def company_fields(spark, sf_dir):
    """The first sentence of a company's pages, in the order of the pages, that states a field."""
    pages = table(spark, sf_dir, "documents").select("source", _text("doc_id").alias("url"), "text", F.col("doc_id").alias("priority"))
    found = extract.page_sentences(pages, "source", "url", "text", "priority")
    r = extract.first_match(found, "source", {"license": _FIELDS["license"]})
    return r.select("source", F.col("license.tipo").alias("kind"), F.col("license.valor").alias("license"), F.col("license.url").alias("url"))


# --- projections and stores


@query("""SELECT 'crm' AS fonte, c_name AS nome, c_mktsegment AS setor, c_nationkey::VARCHAR AS pais, '' AS email, 'a | b' AS lista, 'k: ' || c_mktsegment AS mapa FROM customer
UNION ALL SELECT 'erp', s_name, '', s_nationkey::VARCHAR, 'x' || s_suppkey || '@y.com', '', '' FROM supplier WHERE s_acctbal >= 0""")
def unified_projection(spark, sf_dir):
    """Two sources in one set of columns by their synonyms; rows without a name go, lists and maps become text."""
    wanted = {"fonte": [], "nome": ["name", "c_name", "s_name"], "setor": ["segment", "c_mktsegment"], "pais": ["c_nationkey", "s_nationkey"], "email": ["mail"], "lista": ["l"], "mapa": ["m"]}
    c = table(spark, sf_dir, "customer").withColumn("l", text.rich_text(F.array(F.lit("a"), F.lit("b")), "list")).withColumn("m", text.rich_text(F.create_map(F.lit("k"), "c_mktsegment"), "map"))
    s = table(spark, sf_dir, "supplier").withColumn("s_name", F.when(F.col("s_acctbal") >= 0, F.col("s_name")).otherwise("")).withColumn("mail", F.concat(F.lit("x"), _text("s_suppkey"), F.lit("@y.com")))
    return link.project(c, wanted, {"fonte": "crm"}).unionByName(link.project(s, wanted, {"fonte": "erp"})).where("nome <> ''")


def _stores(spark, sf_dir):
    """Nations as stores: order priorities as stars, weekdays and hours of events as peaks, orders as reviews."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    stars = o.groupBy("c_nationkey", F.left("o_orderpriority", F.lit(1)).alias("s")).agg(F.count("*").cast("int").alias("n"))
    stars = stars.groupBy("c_nationkey").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("s", "n")))).alias("distribuicao_estrelas"))
    reviews = o.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct(_text("o_orderkey").alias("id"), F.col("o_orderpriority").alias("texto"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("data_estimada"), F.when(F.col("o_orderstatus") == "F", "obrigado").alias("resposta_proprietario"), F.when(F.col("o_orderstatus") == "O", "Guia local").alias("autor_info"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("estrelas")))).alias("avaliacoes"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lit("M").alias("marca"), _text("n_nationkey").alias("place_id"), F.col("n_name").alias("nome"), F.lit("u").alias("url"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.lit(4.5).alias("nota"), F.lit(3).alias("total_avaliacoes"), F.lit("").alias("endereco"), F.lit("c").alias("cidade"))
    peaks = F.create_map(F.lit("seg"), F.create_map(F.lit("9"), F.col("c_nationkey").cast("int"), F.lit("10"), F.lit(30)), F.lit("dom"), F.map_filter(F.create_map(F.lit("1"), F.lit(0)), lambda k, v: v > 0))
    return n.join(stars, "c_nationkey", "left").join(reviews, "c_nationkey", "left").select(
        "*", F.create_map(F.lit("seg"), F.lit("9-18")).alias("horario_funcionamento"), peaks.alias("horarios_pico"), F.create_map(F.lit("preco"), F.lit(2)).alias("topicos_avaliacoes"),
        F.array(F.lit("d1"), F.col("nome")).alias("destaques"), F.create_map(F.lit("pagamento"), F.array(F.lit("pix"), F.lit("cartao"))).alias("atributos"),
    )


@query("""WITH o AS (SELECT c_nationkey AS k, left(o_orderpriority, 1) AS s, * FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT 'lojas' AS tabela, count(*) AS n FROM nation UNION ALL SELECT 'funcionamento', count(*) FROM nation UNION ALL SELECT 'pico', 2 * count(*) FROM nation UNION ALL SELECT 'estrelas', count(*) FROM (SELECT DISTINCT k, s FROM o)
UNION ALL SELECT 'topicos', count(*) FROM nation UNION ALL SELECT 'destaques', 2 * count(*) FROM nation UNION ALL SELECT 'atributos', 2 * count(*) FROM nation UNION ALL SELECT 'avaliacoes', count(*) FROM o""")
def store_tables(spark, sf_dir):
    """Store documents as eight tables: the rows of each."""
    out = None
    for name, df in stores.store_tables(_stores(spark, sf_dir)).items():
        one = df.agg(F.lit(name).alias("tabela"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""WITH o AS (SELECT c_nationkey AS k, left(o_orderpriority, 1) AS s FROM orders JOIN customer ON c_custkey = o_custkey), g AS (SELECT k, count(*) FILTER (s IN ('1', '2')) AS bad, count(*) AS n FROM o GROUP BY k)
SELECT n_nationkey::VARCHAR AS place_id, n_name AS nome, CASE WHEN n > 0 THEN round_even(bad * 100.0::DOUBLE / n, 1) END AS pct_negativas FROM nation LEFT JOIN g ON k = n_nationkey""")
def store_overview(spark, sf_dir):
    """Stores with their share of negative marks."""
    return stores.store_tables(_stores(spark, sf_dir))["lojas"].select("place_id", "nome", "pct_negativas")


@query("""SELECT c_nationkey::VARCHAR AS place_id, o_orderkey::VARCHAR AS id, o_orderstatus = 'F' AS respondida, o_orderstatus = 'O' AS guia, strftime(o_orderdate, '%Y-%m') AS mes FROM orders JOIN customer ON c_custkey = o_custkey""")
def review_projection(spark, sf_dir):
    """Reviews as a dashboard shows them."""
    r = stores.compact_reviews(stores.store_tables(_stores(spark, sf_dir))["avaliacoes"], F.lit("1998-12-31").cast("date"))
    return r.select("place_id", "id", "respondida", "guia", "mes")


@query("""SELECT n_nationkey::VARCHAR AS place_id, n_name || ' (novo)' AS nome, 2 AS capturas, count(o_orderkey) AS avaliacoes FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""")
def merged_captures(spark, sf_dir):
    """Two captures of each store as one document: the fuller values, every review once."""
    s = _stores(spark, sf_dir)
    later = s.withColumn("ord", F.lit(1)).withColumn("nome", F.concat("nome", F.lit(" (novo)")))
    m = stores.merge_captures(s.withColumn("ord", F.lit(0)).unionByName(later))
    return m.select("place_id", "nome", F.col("capturas").cast("int").alias("capturas"), F.coalesce(F.size("avaliacoes"), F.lit(0)).cast("long").alias("avaliacoes"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name END AS valor, CASE WHEN c_acctbal > 0 THEN 'literal' ELSE 'not found' END AS tipo, CASE WHEN c_acctbal > 0 THEN 'it says ' || c_name END AS quote, 'https://x/' || c_custkey AS url FROM customer""")
def typed_evidence(spark, sf_dir):
    """Fields with what they are and where they come from."""
    v = F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise("")
    f = stores.literal_or_missing(v, F.concat(F.lit("it says "), "c_name"), F.concat(F.lit("https://x/"), _text("c_custkey")))
    return table(spark, sf_dir, "customer").select("c_custkey", f.alias("f")).select("c_custkey", "f.valor", "f.tipo", "f.quote", "f.url")


@query("""SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'literal' ELSE 'not found' END AS t, CASE WHEN c_acctbal > 0 THEN c_name END AS v, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment ELSE '' END AS ofertas, 'https://x/' || c_custkey AS urls FROM customer""")
def evidence_summary(spark, sf_dir):
    """Collected evidence in short: typed fields, inferred offers, pages."""
    none = F.lit(None).cast("string")
    url = F.concat(F.lit("https://x/"), _text("c_custkey"))
    base = stores.literal_or_missing(F.when(F.col("c_acctbal") > 0, F.col("c_name")), F.col("c_name"), url)
    offers = F.array(stores.evidence(F.col("c_mktsegment"), "literal", url), F.struct(F.col("c_mktsegment").alias("valor"), F.when(F.col("c_nationkey") % 2 == 0, "inferido").otherwise("not found").alias("tipo"), none.alias("quote"), url.alias("url"), none.alias("data")))
    r = review.evidence_summary(table(spark, sf_dir, "customer").select("c_custkey", base.alias("base"), offers.alias("ofertas")), "c_custkey", ["base"], "ofertas")
    return r.select("c_custkey", "base.t", "base.v", F.array_join("ofertas", ",").alias("ofertas"), F.array_join("urls", ",").alias("urls"))


# --- reviews of findings


@query(r"""WITH f AS (SELECT item_id, text, item_id % 7 = 0 AS bad_url, item_id % 5 = 0 AS bad_date FROM benchmark),
kept AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)
SELECT 'p-' || item_id AS id, 'url' AS rule FROM f WHERE bad_url UNION ALL SELECT 'p-' || item_id, 'page date' FROM f WHERE bad_date
UNION ALL SELECT 'p-' || item_id, 'page not kept' FROM f LEFT JOIN kept ON doc_id = item_id WHERE NOT bad_url AND doc_id IS NULL
UNION ALL SELECT 'p-' || item_id, 'quote not on page' FROM f JOIN kept ON doc_id = item_id WHERE NOT bad_url AND NOT contains(t, trim(regexp_replace(f.text, '\s+', ' ', 'g')))
UNION ALL SELECT 'p-' || item_id, 'price' FROM f WHERE item_id % 3 = 0 UNION ALL SELECT 'p-' || item_id, 'punctuation' FROM f WHERE item_id % 2 = 0""")
def run_validator(spark, sf_dir):
    """Findings of a run that break a rule, each rule told."""
    i = F.col("item_id")
    url = F.when(i % 7 == 0, "ftp://x").otherwise(F.concat(F.lit("https://x/"), i.cast("string")))
    angle = F.concat(F.when(i % 3 == 0, "R$ 10 ").otherwise("plain "), F.when(i % 2 == 0, "a — b").otherwise("a"))
    findings = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("p-"), i.cast("string")).alias("id"), url.alias("url"), F.col("text").alias("valor"), F.when(i % 5 == 0, "soon").when(i % 5 == 1, "not found").otherwise("2026-01-02").alias("data_pagina"), angle.alias("angulo"))
    pages = table(spark, sf_dir, "documents").select(F.concat(F.lit("https://x/"), _text("doc_id")).alias("url"), F.lit(True).alias("ok"), "text")
    return review.run_faults(findings, pages, "p", ["no such name at all"], ["angulo"])


@query("""WITH g AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS top FROM orders GROUP BY 1)
SELECT c_custkey, 'search ceiling' AS rule FROM customer WHERE c_nationkey > 20 UNION ALL SELECT c_custkey, 'too few findings' FROM customer LEFT JOIN g ON o_custkey = c_custkey WHERE coalesce(n, 0) < 5 AND c_acctbal < 5000
UNION ALL SELECT c_custkey, 'unknown finding' FROM customer LEFT JOIN g ON o_custkey = c_custkey WHERE c_mktsegment = 'FURNITURE' OR top IS NULL""")
def run_summary(spark, sf_dir):
    """Runs over their ceiling, with too few findings, or naming findings that aren't there."""
    found = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("id"))
    top = found.groupBy("c_custkey").agg(F.max("id").alias("top"))
    named = F.array(F.coalesce(F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(-1)).otherwise(F.col("top")), F.lit(-2)))
    gaps = F.when(F.col("c_acctbal") >= 5000, F.array(F.lit("gap"))).otherwise(F.array().cast("array<string>"))
    runs = table(spark, sf_dir, "customer").join(top, "c_custkey", "left").select("c_custkey", F.col("c_nationkey").alias("buscas_usadas"), F.lit(20).alias("teto_buscas"), named.alias("top_perguntas"), gaps.alias("lacunas"))
    return review.run_summary_faults(runs, found, "c_custkey", 5)


@query("""SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal <= 0 THEN 'nome missing' END, CASE WHEN c_nationkey % 3 = 0 THEN 'n is no int' END, CASE WHEN c_mktsegment NOT IN ('FURNITURE', 'BUILDING') THEN 'setor not allowed' END], lambda x: x IS NOT NULL), ',') AS faults FROM customer""")
def schema_stage(spark, sf_dir):
    """JSON documents against a schema of required fields, types and lists of values."""
    nome = F.when(F.col("c_acctbal") > 0, F.concat(F.lit('"nome": "'), "c_name", F.lit('", '))).otherwise("")
    n = F.when(F.col("c_nationkey") % 3 == 0, F.lit('"many"')).otherwise(_text("c_nationkey"))
    body = F.concat(F.lit("{"), nome, F.lit('"n": '), n, F.lit(', "setor": "'), "c_mktsegment", F.lit('"}'))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(review.schema_faults(body, {"nome": "string", "n": "int"}, {"setor": ["FURNITURE", "BUILDING"]}), ",").alias("faults"))


@query("""SELECT page_id, array_to_string(list_filter([CASE WHEN NOT regexp_matches(h, '<title>[^<]+</title>') THEN 'title' END, CASE WHEN NOT regexp_matches(h, 'rel="canonical"') THEN 'canonical' END, CASE WHEN NOT regexp_matches(h, 'charset=') THEN 'charset' END, CASE WHEN regexp_matches(h, '(?i)noindex') THEN 'noindex' END], lambda x: x IS NOT NULL), ',') AS faults
FROM (SELECT page_id, string_split(html, '</head>')[1] AS h FROM pages)""")
def site_checks(spark, sf_dir):
    """What public pages lack in their heads."""
    marks = {"title": "<title>[^<]+</title>", "canonical": 'rel="canonical"', "charset": "charset="}
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(review.site_faults(F.col("html"), marks), ",").alias("faults"))


@query(r"""WITH f AS (SELECT item_id, text, item_id % 4 AS k FROM benchmark), kept AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)
SELECT item_id::VARCHAR AS path, 'no url' AS rule FROM f WHERE k = 0 UNION ALL SELECT item_id::VARCHAR, 'literal without quote' FROM f WHERE k = 1 UNION ALL SELECT item_id::VARCHAR, 'outside tema' FROM f WHERE k = 2
UNION ALL SELECT item_id::VARCHAR, 'page not kept' FROM f LEFT JOIN kept ON doc_id = item_id WHERE k > 1 AND doc_id IS NULL
UNION ALL SELECT item_id::VARCHAR, 'quote not on page' FROM f JOIN kept ON doc_id = item_id WHERE k > 1 AND NOT contains(t, trim(regexp_replace(f.text, '\s+', ' ', 'g')))""")
def field_validator(spark, sf_dir):
    """Typed fields without an address, without a quote, with a quote that its page hasn't, or a value outside the list."""
    k = F.col("item_id") % 4
    fields = table(spark, sf_dir, "benchmark").select(
        _text("item_id").alias("path"), F.lit("tema").alias("campo"), F.when(k == 2, "other").otherwise("known").alias("valor"), F.lit("literal").alias("tipo"),
        F.when(k != 1, F.col("text")).alias("quote"), F.when(k != 0, F.concat(F.lit("https://x/"), _text("item_id"))).alias("url"),
    )
    pages = table(spark, sf_dir, "documents").select(F.concat(F.lit("https://x/"), _text("doc_id")).alias("url"), F.lit(True).alias("ok"), "text")
    return review.field_faults(fields, pages, "path", {"tema": ["known"]})


# --- queues


@query("""WITH q AS (SELECT o_orderpriority AS q, o_orderkey AS item, o_orderkey AS pos, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'outside' ELSE 'limit' END AS r FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY pos) AS rn, max(pos) OVER (PARTITION BY q) AS last FROM q), s AS (SELECT *, min(CASE WHEN rn <= 20 AND r = 'limit' THEN rn END) OVER (PARTITION BY q) AS stop FROM n)
SELECT q, item, CASE WHEN rn = stop THEN last + 1 ELSE pos END AS pos, CASE WHEN rn <= 20 AND rn < coalesce(stop, 21) THEN r ELSE 'queued' END AS state FROM s""")
def work_queue(spark, sf_dir):
    """Queues after one lot: done, outside, put back at the end, or not reached."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("q"), F.col("o_orderkey").alias("item"), F.col("o_orderkey").alias("pos"), "o_orderstatus")
    result = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "outside").otherwise("limit")
    return rank.queue_after(o.select("q", "item", "pos"), o.select("q", "item", result.alias("result")), ["q"], "item", "pos", 20)


# --- feeds and structured bodies


#: Orders, by key, of which one feed holds those of a priority.
FEED = 2500


def _feeds(spark, sf_dir, day: str, entry, around: tuple[str, str]):
    """Feeds of all orders of each priority, several a source, so that none grows with the table; a feed's entries in the order of their keys."""
    o = table(spark, sf_dir, "orders").withColumn("d", F.date_format("o_orderdate", day))
    lot = F.floor(F.col("o_orderkey") / FEED)
    bodies = o.groupBy(F.col("o_orderpriority").alias("source"), lot.alias("lot")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", entry.alias("x")))).alias("e"))
    return bodies.select("source", F.concat(F.lit(around[0]), F.array_join(F.transform("e", lambda e: e["x"]), ""), F.lit(around[1])).alias("body"))


def _element(name: str, *parts):
    return F.concat(F.lit(f"<{name}>"), *parts, F.lit(f"</{name}>"))


@query("""SELECT o_orderpriority AS source, 'rss' AS kind, 'https://x/' || o_orderkey AS url, 'Order & ' || o_orderkey AS title, o_orderdate::DATE AS day FROM orders
UNION ALL SELECT o_orderpriority, 'atom', 'https://x/' || o_orderkey, 'Order & ' || o_orderkey, o_orderdate::DATE FROM orders""")
def feed_entries(spark, sf_dir):
    """Entries of RSS and Atom feeds with their dates."""
    from millrace.functions.dates import parse_date

    k = F.col("o_orderkey").cast("string")
    rss = F.concat(F.lit("<item>"), _element("title", F.lit("Order &amp; "), k), _element("link", F.lit("https://x/"), k), _element("pubDate", F.date_format("o_orderdate", "EEE, dd MMM yyyy"), F.lit(" 10:00:00 GMT")), F.lit("</item>"))
    atom = F.concat(F.lit("<entry>"), _element("title", F.lit("Order &amp; "), k), F.lit('<link rel="alternate" href="https://x/'), k, F.lit('"/>'), _element("updated", F.col("d"), F.lit("T00:00:00Z")), F.lit("</entry>"))
    bodies = _feeds(spark, sf_dir, "yyyy-MM-dd", rss, ("<rss><channel>", "</channel></rss>")).unionByName(_feeds(spark, sf_dir, "yyyy-MM-dd", atom, ('<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>")))
    return markup.feed_items(bodies, ["source"]).select("source", "kind", "url", "title", parse_date(F.col("date")).alias("day"))


@query("""SELECT o_orderpriority AS source, 'https://x/' || o_orderkey || '.xml' AS url FROM orders WHERE o_orderstatus = 'P' OR o_orderdate::DATE >= DATE '1997-01-01'
QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderstatus = 'P', CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END DESC, 'https://x/' || o_orderkey || '.xml') <= 6""")
def sitemap_children(spark, sf_dir):
    """The sitemaps of an index worth opening: the newest ones first, undated ones last."""
    k = F.col("o_orderkey").cast("string")
    entry = F.concat(F.lit("<sitemap>"), _element("loc", F.lit("https://x/"), k, F.lit(".xml")), F.when(F.col("o_orderstatus") == "P", "").otherwise(_element("lastmod", F.col("d"))), F.lit("</sitemap>"))
    items = markup.feed_items(_feeds(spark, sf_dir, "yyyy-MM-dd", entry, ("<sitemapindex>", "</sitemapindex>")), ["source"])
    return markup.newest_children(items, "source", F.lit("1997-01-01").cast("date")).select("source", "url")


@query("""WITH u AS (SELECT o_orderpriority AS source, 'https://x/' || o_custkey AS canonical, o_orderkey AS ord, o_orderdate::DATE AS day FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderkey) = 1)
SELECT source, canonical, day FROM u WHERE day BETWEEN DATE '1997-12-31' - 365 AND DATE '1997-12-31' + 1 QUALIFY row_number() OVER (PARTITION BY source ORDER BY day DESC, ord) <= 300""")
def feed_sweep(spark, sf_dir):
    """Entries of urlsets as a sweep takes them: one an address, in the window, the newest first."""
    entry = F.concat(F.lit("<url>"), _element("loc", F.lit("HTTPS://X/"), F.col("o_custkey").cast("string"), F.lit("/?utm_source="), F.col("o_orderkey").cast("string")), _element("lastmod", F.col("d")), F.lit("</url>"))
    items = markup.feed_items(_feeds(spark, sf_dir, "yyyy-MM-dd", entry, ("<urlset>", "</urlset>")), ["source"])
    ordered = items.withColumn("ord", F.regexp_extract("url", "utm_source=([0-9]+)", 1).cast("long"))
    return markup.source_items(ordered, "source", F.lit("1997-12-31").cast("date"), 365, "(?i)^https").select("source", "canonical", "day")


@query("""SELECT event_id, event_type AS k, json_extract_string(props, '$.k') AS v, user_id AS answer FROM events""")
def json_lookup(spark, sf_dir):
    """Values under a key at any depth, and the JSON that an answer in prose holds."""
    from millrace.session import ship_package

    ship_package(spark)
    deep = F.concat(F.lit('{"@graph": [{"a": '), "props", F.lit('}, {"t": ["'), "event_type", F.lit('"]}]}'))
    said = F.concat(F.lit("Here it is:\n```json\n{\"id\": "), _text("user_id"), F.lit("}\n``` done"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.get(markup.json_values(deep, "t"), F.lit(0)).alias("k"), F.get(markup.json_values(deep, "k"), F.lit(0)).alias("v"), extract.answered(said, "id long")["id"].alias("answer")
    )


@query(r"""WITH p AS (SELECT page_id, url, regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g') AS h FROM pages),
f AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(h, '<title>([^<]*)</title>', 1), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS title, list_transform(regexp_extract_all(h, '<h1>([^<]*)</h1>', 1), lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS h1, regexp_extract_all(h, '<a href="([^"]*)">([^<]*)</a>', 1) AS href, regexp_extract_all(h, '<a href="([^"]*)">([^<]*)</a>', 2) AS label FROM p)
SELECT page_id, md5(array_to_string(list_filter(list_concat([title], h1, ['about ' || page_id, 'seen at ' || url, 'https://player.example/' || page_id], list_transform(range(1, len(href) + 1), lambda i: label[i] || ' ' || href[i])), lambda x: x <> ''), chr(10))) AS quotable,
contains(h, 'track(') AS script, contains(h, 'margin:0') AS style, contains(h, '/>') AS markup FROM f""")
def citable_text(spark, sf_dir):
    """What of a page quotes may come from: title, headings, metadata, image texts, frames, links and shown text; no script, style or markup."""
    extra = F.concat(F.lit('<meta name="description" content="about '), _text("page_id"), F.lit('"/></head>'))
    shown = F.concat(F.lit('<article><img alt="seen at '), "url", F.lit('"/><iframe src="https://player.example/'), _text("page_id"), F.lit('"></iframe>'))
    html = F.replace(F.replace("html", F.lit("</head>"), extra), F.lit("<article>"), shown)
    p = markup.parse_pages(table(spark, sf_dir, "pages").select("page_id", html.alias("html")), ["page_id"]).withColumn("v", markup.validation_text())
    before = F.left("v", F.char_length("v") - F.char_length("page.text") - 1)
    return p.select("page_id", F.md5(before).alias("quotable"), F.contains("v", F.lit("track(")).alias("script"), F.contains("v", F.lit("margin:0")).alias("style"), F.contains("v", F.lit("/>")).alias("markup"))


@query("""SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderstatus = 'F' AND o_orderdate <= TIMESTAMP '1997-06-30' AND o_orderpriority = '1-URGENT' ORDER BY o_orderdate DESC, o_orderkey LIMIT 6""")
def latest_posts(spark, sf_dir):
    """Published posts, none of the future, that link to a host."""
    o = table(spark, sf_dir, "orders")
    content = F.when(F.col("o_orderpriority") == "1-URGENT", "see https://host.example/x").otherwise("nothing")
    items = o.select(F.col("o_orderkey").alias("slug"), F.col("o_orderdate").alias("at"), F.when(F.col("o_orderstatus") == "F", "published").otherwise("draft").alias("status"), content.alias("content"))
    return files.posts(items, F.lit("1997-06-30").cast("timestamp"), "host.example").select(F.col("slug").alias("o_orderkey"), F.to_date("at").alias("day"))


# --- files, written to the shared folder and read again


@query("""SELECT c_custkey::VARCHAR AS id, c_name || chr(10) || '"' || c_mktsegment || '", x' AS nome, 'a | ' || c_mktsegment AS lista, 'k: ' || c_nationkey AS mapa, '' AS falta FROM customer""")
def csv_export(spark, sf_dir):
    """A flattened export with a fixed projection, read again: quotes, line breaks, lists, maps and missing columns."""
    c = table(spark, sf_dir, "customer")
    nome = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", x'))
    rows = c.select(F.col("c_custkey").alias("id"), nome.alias("nome"), F.array(F.lit("a"), "c_mktsegment").alias("lista"), F.create_map(F.lit("k"), "c_nationkey").alias("mapa"))
    folder = _folder(spark)
    sinks.write_csv(rows, folder, ["id", "nome", "lista", "mapa", "falta"])
    return files.csv_table(spark, folder).select("id", "nome", "lista", "mapa", F.coalesce("falta", F.lit("")).alias("falta"))


@query("""SELECT c_custkey::VARCHAR AS id, c_name AS nome FROM customer""")
def csv_with_preamble(spark, sf_dir):
    """Files with free text before the header."""
    lines = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.concat(_text("c_custkey"), F.lit(',"'), "c_name", F.lit('"')))).alias("l"))
    body = F.concat(F.lit("Notes:\nfree text, with commas\n\nid,nome\n"), F.array_join("l", "\n"))
    folder = _folder(spark)
    lines.select(body.alias("value")).repartition(3).write.option("lineSep", "\n\n").text(folder)
    # files of several notes: a header inside is no record
    read = files.csv_after_preamble(spark, folder, ["id", "nome"])
    return read.where(F.col("id").rlike("^[0-9]+$")).select("id", "nome")


@query("""SELECT c_custkey AS id, c_name AS nome, [c_mktsegment, 'x'] AS tags FROM customer""")
def json_documents(spark, sf_dir):
    """JSON lines written and read with a schema."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"), F.array(F.col("c_mktsegment"), F.lit("x")).alias("tags"))
    folder = _folder(spark)
    sinks.write_json(rows, folder)
    assert files.json_table(spark, f"{folder}-none", "id LONG").isEmpty()
    return files.json_table(spark, folder, "id LONG, nome STRING, tags ARRAY<STRING>", lines=True)


@query("""SELECT n_nationkey AS id, n_name AS nome FROM nation""")
def script_document(spark, sf_dir):
    """A report's JSON assigned to a variable of a script, read again."""
    payload = sinks.document(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("nome")))
    folder = _folder(spark)
    spark.createDataFrame([(f"window.DATA = {{\"rows\": {payload}}};",)], "value string").coalesce(1).write.text(folder)
    read = files.js_assignment(spark, folder, "window.DATA", "rows ARRAY<STRUCT<id INT, nome STRING>>")
    return read.select(F.inline("rows"))


@query("""SELECT DISTINCT 'https://x/' || n_regionkey AS url FROM nation UNION ALL SELECT 'https://y/' || n_name FROM nation""")
def markdown_seeds(spark, sf_dir):
    """Addresses in Markdown files, each once."""
    n = table(spark, sf_dir, "nation")
    line = F.concat(F.lit("- see [a](https://x/"), _text("n_regionkey"), F.lit("), then https://y/"), "n_name", F.lit("."))
    folder = _folder(spark)
    n.select(line.alias("value")).coalesce(1).write.text(folder)
    return files.markdown_links(spark, folder).select("url").distinct()


@query("""SELECT c_nationkey::VARCHAR AS shard, c_custkey::VARCHAR AS id, c_name || ' São; "x"' AS nome, NULL::VARCHAR AS extra FROM customer""")
def zipped_shards(spark, sf_dir):
    """Shards of headerless CSVs in zip files, in a Western encoding."""

    @F.pandas_udf("binary")
    def zipped(body: pd.Series) -> pd.Series:
        def one(text: str) -> bytes:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as z:
                z.writestr("m.csv", text.encode("latin-1"))
            return out.getvalue()

        return body.map(one)

    line = F.concat(_text("c_custkey"), F.lit(';"'), "c_name", F.lit(' São; ""x"""'))
    shards = table(spark, sf_dir, "customer").groupBy(_text("c_nationkey").alias("path")).agg(F.array_join(F.collect_list(line), "\n").alias("body"))
    rows = files.zipped_rows(shards.select("path", zipped("body").alias("content")), ["id", "nome", "extra"])
    return rows.select(F.col("path").alias("shard"), "id", "nome", "extra")


@query("""WITH r AS (SELECT p_brand, p_name, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part WHERE p_brand IN ('Brand#11', 'Brand#22'))
SELECT CASE p_brand WHEN 'Brand#22' THEN 1 ELSE 2 END AS place, '## ' || p_brand || chr(10) || chr(10) || string_agg('- ' || p_name || ' (' || p_partkey || ')', chr(10) ORDER BY rn) || chr(10) AS text FROM r GROUP BY p_brand""")
def markdown_digest(spark, sf_dir):
    """A digest by category in a given order, as Markdown."""
    line = F.concat("p_name", F.lit(" ("), _text("p_partkey"), F.lit(")"))
    d = sinks.digest(table(spark, sf_dir, "part"), "p_brand", ["Brand#22", "Brand#11"], line, [F.desc("p_retailprice"), "p_partkey"])
    return sinks.markdown(d, "p_brand").select(F.col("place").cast("int").alias("place"), "text")
