"""Fields of company and case records out of page texts, each with where it was found."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import sentences, shorten
from millrace.operators.stores import evidence


def page_sentences(pages: DataFrame, owner: str, url: str, text: str, priority: str) -> DataFrame:
    """(owner, url, priority, pos, sentence): sentences of a company's pages in the order in which they count."""
    s = pages.select(owner, url, priority, F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))
    return s.select(owner, url, priority, "pos", "sentence")


def first_match(found: DataFrame, owner: str, fields: Mapping[str, str], url: str = "url", priority: str = "priority", context: Mapping[str, str] | None = None) -> DataFrame:
    """(owner, fields): for every field the first sentence that fits its expression, as typed evidence.

    All fields are found in one pass and one aggregation; a field that no sentence
    has is ``not found``. The value is the first group, or the whole match.
    """
    context = context or {}
    at = F.struct(F.col(priority), F.col(url), F.col("pos"))
    picks = []
    for name, rx in fields.items():
        fits = F.col("sentence").rlike("(?iu)" + rx)
        fits = fits & F.col("sentence").rlike("(?iu)" + context[name]) if name in context else fits
        whole = F.regexp_extract("sentence", f"(?iu){rx}", 0)
        value = F.coalesce(F.nullif(F.regexp_extract("sentence", f"(?iu)(?:{rx})", 1), F.lit("")), whole) if "(" in rx.replace("(?:", "") else whole
        hit = F.struct(value.alias("v"), F.col("sentence").alias("q"), F.col(url).alias("u"))
        picks.append(F.min_by(F.when(fits, hit), F.when(fits, at)).alias(name))
    rows = found.groupBy(owner).agg(*picks)
    typed = lambda c: F.when(c.isNotNull(), evidence(c["v"], "literal", c["u"], shorten(c["q"]))).otherwise(evidence(F.lit(None), "not found", F.lit(None).cast("string")))
    return rows.select(owner, *[typed(F.col(n)).alias(n) for n in fields])


def company_type(head: Column, body: Column, founded: Column, rules: Mapping[str, str], default: str = "indefinido", young: int = 2022) -> Column:
    """A type by patterns in a page's head, then in its body, then by its year; the first that fits."""
    out = None
    for text in (head, body):
        for name, rx in rules.items():
            out = F.when(text.rlike("(?iu)" + rx), name) if out is None else out.when(text.rlike("(?iu)" + rx), name)
    return out.when(founded >= young, "startup").otherwise(default)


def validation_level(text: Column, independent: Column) -> Column:
    """How a claim is backed: independently, by a named study, by its own numbers, or not at all."""
    return (
        F.when(independent, "independente").when(text.rlike(r"(?i)(peer.?review|published in|white ?paper|study|estudo)"), "estudo")
        .when(text.rlike(r"\d+\s*%"), "numero proprio").otherwise("sem evidencia")
    )


def basis_of(status: Column) -> Column:
    return F.when(status.startswith("valid"), "validada").when(status.startswith("parc"), "parcial").when(status == "", "sem base").otherwise("outra")


def mentions(texts: DataFrame, key: str, text: str, names: DataFrame, name: str, order: str) -> DataFrame:
    """(key, name): the first of some names, in their own order, that a text has as whole words.

    Text and name meet on the name's first word, so only likely pairs are compared;
    words travel without their text, which joins the pairs that met.
    """
    low = lambda c: F.concat(F.lit(" "), F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    words = texts.select(key, low(F.col(text)).alias("_t"))
    keyed = names.select(name, order, F.trim(low(F.col(name))).alias("_n")).where("_n <> ''").withColumn("_w", F.substring_index("_n", " ", 1))
    met = words.select(key, F.explode(F.array_distinct(F.split(F.trim("_t"), " "))).alias("_w")).join(keyed, "_w").drop("_w")
    return met.join(words, key).where(F.contains("_t", F.concat(F.lit(" "), F.col("_n"), F.lit(" ")))).groupBy(key).agg(F.min_by(name, order).alias(name))


def longest_mention(texts: DataFrame, key: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """(key, name): the longest of some names that a text has as whole words; the first in the alphabet of equally long ones."""
    ordered = names.select(name, F.struct((-F.char_length(name)).alias("n"), F.col(name).alias("x")).alias("_order"))
    return mentions(texts, key, text, ordered, name, "_order")


#: Titles of people who decide on research, and words of those who work in it.
DECIDES = (
    "ceo", "chief executive", "founder", "co-?founder", "fundador", "s[oó]cio", "owner", "propriet[aá]ri", "president", "presidente", "managing director", "diretor", "director",
    "vp\\b", "vice[- ]president", "head of", "partner", "general manager", "country manager", "managing partner", "cmo", "cio", "coo", "cfo",
)
WORKS_IN = (
    "insight", "research", "pesquisa", "market intelligence", "intelig[eê]ncia", "consumer", "shopper", "analytics", "data", "estrat[eé]gi", "strategy", "cx", "ux",
)


def decision_maker(title: Column) -> Column:
    """Whether a job title is one that decides; a word of the list must stand whole."""
    return F.coalesce(title.rlike(r"(?iu)\b(" + "|".join(DECIDES) + r")\b"), F.lit(False))


def in_area(title: Column) -> Column:
    """Whether a job title is one of the trade."""
    return F.coalesce(title.rlike(r"(?iu)\b(" + "|".join(WORKS_IN) + r")\b"), F.lit(False))


def answered(answer: Column, schema: str) -> Column:
    """The JSON that a model's answer holds, read with a schema; null when it holds none."""
    return F.from_json(F.regexp_extract(answer, r"(?s)(\[.*\]|\{.*\})", 1), schema)
