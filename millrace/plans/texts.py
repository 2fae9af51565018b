"""Queries over ``documents``: normal forms, languages, vocabularies, quotes, contacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import contact, text
from millrace.operators import classify, quality, rank
from millrace.plans.registry import query
from millrace.session import table

#: Vocabulary and signals of the sample queries, folded.
TERMS = ("tion", "hered", "enter", "que", "ciones", "licensed", "erung")
SIGNALS = ("reserved", "license", "token", "ouen")
THEMES = {"license": "licen[sc]ed? under|released under", "rights": "all rights reserved", "secret": "token\\s*=", "menu": "\\|", "loud": "!!"}
_VOCAB = "(^|[^a-z0-9])(" + "|".join(sorted(TERMS, key=lambda t: (-len(t), t))) + ")"


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean, length(trim(regexp_replace(text, '\s+', ' ', 'g')))::BIGINT AS n FROM documents")
def clean_text(spark, sf_dir):
    clean = text.collapse(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", clean.alias("clean"), F.char_length(clean).cast("long").alias("n"))


@query(rf"""SELECT doc_id, regexp_replace(regexp_replace(strip_accents(lower(string_split(text, chr(10))[1])), '\b({text.NAME_NOISE})\b', ' ', 'g'), '[^a-z0-9]', '', 'g') AS key FROM documents""")
def squeeze_key(spark, sf_dir):
    """The name key of each document's first line."""
    return table(spark, sf_dir, "documents").select("doc_id", text.squeeze_key(F.get(F.split("text", "\n"), F.lit(0))).alias("key"))


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(string_split(text, chr(10))[1])), '\b(the|and|of)\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS key FROM documents""")
def token_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.token_key(F.get(F.split("text", "\n"), F.lit(0)), "the|and|of").alias("key"))


_SCORE = {k: f"len(list_filter(ws, lambda w: w IN ({', '.join(repr(x) for x in v)})))" for k, v in text.TABLE_STOP_WORDS.items()}


@query(rf"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(left(text, 6000)), '[\p{{L}}\p{{N}}_]+') AS ws FROM documents),
s AS (SELECT doc_id, [{', '.join(_SCORE.values())}] AS sc FROM w)
SELECT doc_id, CASE WHEN list_max(sc) >= 3 THEN ['en', 'fr', 'de', 'es'][list_position(sc, list_max(sc))] ELSE 'en' END AS lang_guess FROM s""")
def language_guess(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.guess_language(F.col("text"), text.TABLE_STOP_WORDS).alias("lang_guess"))


@query(r"""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(replace(text, chr(10), chr(1)), '([.!?])\s+([A-Z0-9"''(])', '\1' || chr(1) || '\2', 'g'), chr(1))) AS s FROM documents)
SELECT doc_id, count(*) FILTER (length(trim(s)) >= 25) AS n_sentences, coalesce(max(length(trim(s))) FILTER (length(trim(s)) >= 25), 0)::BIGINT AS longest FROM s GROUP BY doc_id""")
def sentences(spark, sf_dir):
    """Sentences of at least 25 characters, and the longest one."""
    s = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.coalesce(F.array_max(F.transform("s", lambda x: F.char_length(x))), F.lit(0)).cast("long").alias("longest"))


@query(rf"""SELECT doc_id, len(regexp_extract_all(strip_accents(lower(text)), '{_VOCAB}'))::BIGINT AS hits FROM documents WHERE regexp_matches(strip_accents(lower(text)), '{_VOCAB}')""")
def vocab_match(spark, sf_dir):
    """Documents with vocabulary at the start of a word, and how often."""
    key = F.lower(text.fold(F.col("text")))
    found = table(spark, sf_dir, "documents").select("doc_id", classify.hits(key, TERMS, folded=True).cast("long").alias("hits"))
    return found.where("hits > 0")


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'all rights reserved') OR contains(lower(text), 'license, version 2.0') OR contains(lower(text), 'mit license')")
def keyword_any(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.where(classify.any_word(F.col("text"), ["all rights reserved", "license, version 2.0", "mit license"])).select("doc_id")


@query(" UNION ALL ".join(f"SELECT doc_id, '{k}' AS theme FROM documents WHERE regexp_matches(text, '(?i){v}')" for k, v in THEMES.items()))
def theme_coding(spark, sf_dir):
    return classify.code_themes(table(spark, sf_dir, "documents"), "text", THEMES, ["doc_id"])


@query("""WITH gold AS (SELECT doc_id, 'low' AS code FROM labels WHERE quality = 0 UNION SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1),
found AS (SELECT doc_id, 'low' AS code FROM documents SEMI JOIN labels USING (doc_id) WHERE regexp_matches(text, '\\||!!|\\$\\$|###') UNION SELECT doc_id, 'toxic' FROM documents SEMI JOIN labels USING (doc_id) WHERE contains(text, 'idiot')),
b AS (SELECT code, g.doc_id IS NOT NULL AS g, f.doc_id IS NOT NULL AS f FROM (SELECT * FROM gold) g FULL JOIN found f USING (doc_id, code)),
t AS (SELECT code, count(*) FILTER (g AND f) AS tp, count(*) FILTER (NOT g) AS fp, count(*) FILTER (NOT f) AS fn FROM b GROUP BY code),
e AS (SELECT * FROM t UNION ALL SELECT '*', coalesce(sum(tp), 0)::BIGINT, coalesce(sum(fp), 0)::BIGINT, coalesce(sum(fn), 0)::BIGINT FROM t)
SELECT code, tp, fp, fn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall FROM e""".replace("\\\\", "\\"))
def code_eval(spark, sf_dir):
    """Precision and recall of two rules against the labels, and of both together."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").join(labels.select("doc_id"), "doc_id", "left_semi")
    gold = labels.where("quality = 0").select("doc_id", F.lit("low").alias("code")).unionByName(labels.where("toxic = 1").select("doc_id", F.lit("toxic").alias("code")))
    found = docs.where(F.col("text").rlike(r"\||!!|\$\$|###")).select("doc_id", F.lit("low").alias("code")).unionByName(docs.where(F.contains("text", F.lit("idiot"))).select("doc_id", F.lit("toxic").alias("code")))
    return classify.evaluate(gold, found, "doc_id", "code")


@query("""WITH b AS (SELECT doc_id, n, substring(text, n * 1800 + 1, 1800) AS block FROM (SELECT doc_id, text, unnest(range(0, ((length(text) + 1799) // 1800))) AS n FROM documents)),
h AS (SELECT doc_id, n, (length(block) - length(replace(block, 'tion', ''))) // 4 + (length(block) - length(replace(block, 'ung', ''))) // 3 AS hits FROM b)
SELECT doc_id, n::BIGINT AS block, hits::BIGINT AS hits FROM h WHERE hits >= 2""")
def chunk_filter(spark, sf_dir):
    """Blocks of fixed size that hold at least two of an area's words."""
    docs = table(spark, sf_dir, "documents")
    blocks = docs.withColumn("n", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.char_length("text") / 1800) - 1, F.lit(0))))).where(F.char_length("text") > 0)
    block = F.substring(F.col("text"), (F.col("n") * 1800 + 1).cast("int"), F.lit(1800))
    words = F.array(F.lit("tion"), F.lit("ung"))
    count = F.aggregate(words, F.lit(0), lambda a, w: a + ((F.char_length("b") - F.char_length(F.replace("b", w, F.lit("")))) / F.char_length(w)).cast("int"))
    return blocks.select("doc_id", "n", block.alias("b")).select("doc_id", F.col("n").cast("long").alias("block"), count.cast("long").alias("hits")).where("hits >= 2")


@query(r"""WITH d AS (SELECT doc_id, source, list_filter(list_transform(string_split(regexp_replace(replace(text, chr(10), chr(1)), '([.!?])\s+([A-Z0-9"''(])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: trim(s)), lambda s: length(s) >= 25) AS ss FROM documents),
s AS (SELECT doc_id, source, unnest(ss) AS s, generate_subscripts(ss, 1) - 1 AS sentence FROM d),
t AS (SELECT DISTINCT doc_id, sentence, source, left(w, 6) AS stem FROM (SELECT doc_id, sentence, source, unnest(regexp_extract_all(lower(s), '[\p{L}\p{N}_]{5,}')) AS w FROM s)),
m AS (SELECT a.doc_id, a.sentence, b.source AS other FROM t a JOIN t b ON a.stem = b.stem AND a.source <> b.source GROUP BY a.doc_id, a.sentence, b.doc_id, b.sentence, b.source HAVING count(*) >= 3)
SELECT doc_id, sentence::BIGINT AS sentence, count(DISTINCT other) AS others FROM m GROUP BY doc_id, sentence""")
def stem_similarity(spark, sf_dir):
    """In how many other sources a sentence shares three stems with one; all sentences of whole texts, each a finding of its document's source."""
    from millrace.operators.link import similar_elsewhere

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(text.sentences(F.col("text"))).alias("sentence", "s"))
    found = docs.select("doc_id", F.col("sentence").cast("long").alias("sentence"), "source", text.stems(F.col("s"), generic=[]).alias("stems"))
    return similar_elsewhere(found, ["doc_id", "sentence"], "source", "stems")


@query(r"""WITH p AS (SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS q FROM benchmark),
d AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)
SELECT item_id, count(doc_id) AS n_docs, coalesce(min(doc_id), -1) AS first_doc FROM p LEFT JOIN d ON contains(t, q) GROUP BY item_id""")
def quote_check(spark, sf_dir):
    """Documents that hold each benchmark passage word for word.

    A quote and a text that holds it share the quote's longest inner word, or its
    first characters where it has none; only pairs that meet so are compared, by
    the quote check itself.
    """
    quotes = table(spark, sf_dir, "benchmark").select("item_id", text.quote_form(F.col("text"), False).alias("q"))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.quote_form(F.col("text"), False).alias("t"))
    likely = quality.likely_holders(quotes, docs, "item_id", "q", quality.fragments(F.col("q")), "doc_id", "t")
    found = likely.join(docs, "doc_id").where(quality.quote_holds(F.col("q"), F.col("t"))).select("item_id", "doc_id").distinct()
    counts = found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))
    return quotes.join(counts, "item_id", "left").select("item_id", F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"), F.coalesce("first_doc", F.lit(-1)).cast("long").alias("first_doc"))


_SIGNAL = "(^|[^a-z0-9])(" + "|".join(sorted(SIGNALS, key=lambda t: (-len(t), t))) + ")"


@query(rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, trim(regexp_replace(strip_accents(lower(line)), '\s+', ' ', 'g')) AS key FROM l WHERE length(line) >= 60),
s AS (SELECT doc_id, pos, line, len(regexp_extract_all(key, '{{_VOCAB}}')) AS v, len(regexp_extract_all(key, '{{_SIGNAL}}')) AS g FROM k),
b AS (SELECT * FROM s WHERE v > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY v + 2 * g DESC, pos) <= 5)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place, (v + 2 * g)::BIGINT AS score,
CASE WHEN length(line) <= 500 THEN line WHEN contains(left(line, 500), ' ') THEN regexp_replace(regexp_extract(left(line, 500), '(?s)^(.*) [^ ]*$', 1), '[,;:]+$', '') ELSE regexp_replace(left(line, 500), '[,;:]+$', '') END AS excerpt FROM b""".replace("{_VOCAB}", _VOCAB).replace("{_SIGNAL}", _SIGNAL))
def excerpts_topk(spark, sf_dir):
    """The five lines of each document with most vocabulary and signals, in their order."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return classify.excerpts(lines, "doc_id", "pos", "line", TERMS, SIGNALS)


_FREE, _ROLES = ", ".join(map(repr, contact.FREE)), ", ".join(map(repr, contact.ROLES))
SQL_MAIL = rf"""mails AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '{contact.IN_TEXT}')) AS email FROM documents),
kinds AS (SELECT doc_id, email, lower(email) AS e, string_split(lower(email), '@')[-1] AS dom, string_split(string_split(lower(email), '@')[1], '+')[1] AS local FROM mails),
tiers AS (SELECT doc_id, email, CASE WHEN regexp_matches(e, '{contact.ACCOUNTANT}') THEN 'contador' WHEN dom IN ({_FREE}) THEN 'gratuito' ELSE 'corporativo' END AS tipo,
CASE WHEN local IN ({_ROLES}) THEN 'funcao' ELSE 'nominal' END AS alcance,
CASE WHEN dom LIKE '%7.example.com' THEN 'E' WHEN regexp_matches(e, '{contact.ACCOUNTANT}') THEN 'D' WHEN dom IN ({_FREE}) THEN 'C' WHEN local IN ({_ROLES}) THEN 'B' ELSE 'A' END AS tier FROM kinds)"""


def _tiers(spark, sf_dir):
    mails = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(contact.IN_TEXT), F.lit(0)))).alias("email"))
    e = F.col("email")
    mx = F.when(contact.domain_of(e).endswith("7.example.com"), F.lit(False))  # unknown elsewhere, which demotes nothing
    return mails.select("doc_id", "email", contact.kind(e).alias("tipo"), contact.reach(e).alias("alcance"), contact.tier(e, mx).alias("tier"))


@query(f"WITH {SQL_MAIL} SELECT * FROM tiers")
def email_extract_tier(spark, sf_dir):
    return _tiers(spark, sf_dir)


@query(f"WITH {SQL_MAIL} SELECT tier, count(*) AS n, (100 * count(*) // (SELECT count(*) FROM tiers))::BIGINT AS percent FROM tiers GROUP BY tier")
def tier_share(spark, sf_dir):
    t = _tiers(spark, sf_dir).groupBy("tier").agg(F.count("*").alias("n"))
    return t.join(F.broadcast(t.agg(F.sum("n").alias("_all")))).select("tier", "n", F.floor(F.col("n") * 100 / F.col("_all")).cast("long").alias("percent"))


@query(rf"""WITH {SQL_MAIL}, v AS (SELECT doc_id, email, e, dom, local, CASE WHEN dom LIKE '%1.example.com' THEN 'sem_mx' WHEN dom LIKE '%2.example.com' THEN 'indeterminado' ELSE 'ok' END AS mx,
CASE WHEN dom LIKE '%3.example.com' THEN 'recusado' WHEN dom LIKE '%4.example.com' THEN 'aceito' ELSE '' END AS smtp FROM kinds)
SELECT doc_id, email, CASE WHEN mx = 'sem_mx' THEN 'invalido' WHEN mx <> 'ok' THEN 'indeterminado' WHEN smtp = 'recusado' THEN 'invalido' WHEN smtp = 'aceito' THEN 'valido' ELSE 'provavel' END AS verdict,
CASE WHEN mx = 'sem_mx' THEN 'sem_mx' WHEN mx <> 'ok' THEN 'mx' WHEN smtp IN ('recusado', 'aceito') THEN 'smtp' ELSE '' END AS reason FROM v
WHERE regexp_matches(email, '^[A-Za-z0-9._%+-]+@[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+$') AND NOT contains(email, '..')""")
def email_verdict(spark, sf_dir):
    """The validation cascade over addresses, with looked-up mail and mailbox states."""
    d = contact.domain_of(F.col("email"))
    mx = F.when(d.endswith("1.example.com"), "sem_mx").when(d.endswith("2.example.com"), "indeterminado").otherwise("ok")
    smtp = F.when(d.endswith("3.example.com"), "recusado").when(d.endswith("4.example.com"), "aceito").otherwise("")
    ok = F.col("email").rlike(r"^[A-Za-z0-9._%+-]+@[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+$") & ~F.contains("email", F.lit(".."))
    v = contact.verdict(F.col("email"), mx, smtp)
    return _tiers(spark, sf_dir).where(ok).select("doc_id", "email", v["verdict"].alias("verdict"), v["reason"].alias("reason"))


@query("""SELECT doc_id, CASE WHEN length(t) <= 60 THEN t WHEN contains(left(t, 60), ' ') THEN regexp_replace(regexp_extract(left(t, 60), '(?s)^(.*) [^ ]*$', 1), '[,;:]+$', '') ELSE regexp_replace(left(t, 60), '[,;:]+$', '') END AS short
FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)""".replace("\\\\", "\\"))
def truncated(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.shorten(text.collapse(F.col("text")), 60).alias("short"))


@query(r"""WITH s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) FILTER (regexp_matches(lower(line), 'cookie|all rights reserved|read more|licensed under')) AS boilerplate,
count(*) FILTER (length(line) > 20 AND upper(line) = line) AS capitals, count(*) FILTER (length(line) - length(replace(line, '|', '')) >= 2) AS piped FROM s GROUP BY doc_id""")
def noise_lines(spark, sf_dir):
    """Lines that the sentence miner rejects, by reason."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    x = F.col("line")
    return lines.groupBy("doc_id").agg(
        F.count_if(F.lower(x).rlike("cookie|all rights reserved|read more|licensed under")).alias("boilerplate"),
        F.count_if((F.char_length(x) > 20) & (F.upper(x) == x)).alias("capitals"), F.count_if(F.regexp_count(x, F.lit("[|]")) >= 2).alias("piped"),
    )


@query("SELECT doc_id, text AS repaired FROM documents")
def mojibake_repair(spark, sf_dir):
    """Texts broken by reading UTF-8 as latin-1, and repaired: the result is the text itself."""
    from millrace.session import ship_package

    ship_package(spark)
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, sf_dir, "documents").select("doc_id", text.repair_mojibake(broken).alias("repaired"))


@query(r"""WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
c AS (SELECT source, doc_id, pos, line, length(line) AS score FROM l WHERE length(line) BETWEEN 50 AND 120),
u AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) = 1),
p AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY source, doc_id ORDER BY score DESC, pos) <= 3),
s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id, pos) AS rn FROM p)
SELECT source || '-' || lpad(rn::VARCHAR, 3, '0') AS id, doc_id, line FROM s WHERE rn <= 40""")
def mined_sentences(spark, sf_dir):
    """Candidates without repeats, at most three a page and forty a product, with running ids."""
    lines = table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    fit = lines.withColumn("score", F.char_length("line")).where(F.col("score").between(50, 120))
    unique = rank.keep_first(fit, ["line"], ["doc_id", "pos"])
    capped = rank.nested_caps(unique, ["doc_id"], ["source"], rank.by("-score", "doc_id", "pos"), 3, 40)
    return rank.numbered_ids(capped, "source", ["-score", "doc_id", "pos"]).select("id", "doc_id", "line")
