"""Checks of finding documents, evidence fields and pages, and what a report says of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.functions.text import quote_form
from millrace.operators.quality import duplicated, quote_holds, violations

#: Kinds of a typed field, and the form of a page's date.
KINDS = ("literal", "inferido", "not found", "not accessible")
PAGE_DAY = r"^\d{4}(-\d{2}-\d{2})?$"
#: Punctuation and contrasts that findings avoid, and talk of prices.
DASHES = "[—–]"
CONTRAST = r"(?i)\bn[ãa]o (?:é|e) (?:só|apenas)\b.*\bmas\b|\bnot (?:just|only)\b.*\bbut\b"
PRICES = r"(?i)(?:R\$|US\$|€)\s*\d|\bgr[áa]tis\b|\bgratuit|\bfree\b"


def field_faults(fields: DataFrame, pages: DataFrame, path: str, vocabularies: Mapping[str, list[str]] | None = None, name: str = "campo") -> DataFrame:
    """(path, rule) of every typed field that breaks a rule; ``fields`` has path, name, valor, tipo, quote, url.

    A field has a URL; a literal has a quote; a quote stands on its page, which was
    kept; a value is of its field's vocabulary, where that has one. ``pages`` has
    url, ok and text; a page that isn't there counts as not kept. Quotes meet only
    the page they name.
    """
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    own = {"no url": ~filled("url"), "literal without quote": (F.col("tipo") == "literal") & ~filled("quote"), "unknown kind": ~F.coalesce(F.col("tipo").isin(*KINDS), F.lit(False))}
    for field, values in (vocabularies or {}).items():
        own[f"outside {field}"] = (F.col(name) == field) & F.col("tipo").isin("literal", "inferido") & ~F.coalesce(F.col("valor").isin(*values), F.lit(False))
    named = fields.where(filled("quote") & F.col("url").startswith("http")).select(path, "quote", "url")
    kept = pages.select("url", "ok", F.col("text").alias("_t")).dropDuplicates(["url"])
    read = named.join(kept, "url", "left")
    held = quote_holds(quote_form(F.col("quote"), False), quote_form(F.col("_t"), False))
    missing = ~F.coalesce(F.col("ok"), F.lit(False))
    told = read.select(path, F.when(missing, "page not kept").when(~held, "quote not on page").alias("rule")).where("rule is not null")
    return violations(fields, path, own).unionByName(told)


def run_faults(findings: DataFrame, pages: DataFrame, product: str, forbidden: list[str], ours: list[str]) -> DataFrame:
    """(id, rule) of every finding of a run that breaks a rule.

    ``findings`` has id, url, valor, data_pagina and the texts ``ours``. Ids are
    unique and begin with the product; addresses are web addresses, once with the
    same quote; the quote stands on the kept page; dates are days or years; no
    forbidden name, long dash, contrast formula or price in texts of ours.
    """
    everything = F.lower(F.concat_ws("\n", *[F.col(c).cast("string") for c in findings.columns]))
    named = F.lit(False)
    for word in forbidden:
        named = named | F.contains(everything, F.lit(word.lower()))
    mine = F.concat_ws("\n", *ours)
    rules = {
        "id prefix": ~F.col("id").startswith(f"{product}-"), "url": ~F.coalesce(F.col("url").rlike(r"^https?://\S+$"), F.lit(False)),
        "page date": (F.col("data_pagina") != "not found") & ~F.col("data_pagina").rlike(PAGE_DAY), "forbidden name": named,
        "punctuation": mine.rlike(DASHES) | mine.rlike(CONTRAST), "price": mine.rlike(PRICES),
    }
    broken = violations(findings, "id", rules)
    counted = findings.groupBy("id").agg(F.count("*").alias("_n")).where("_n > 1").select("id", F.lit("repeated id").alias("rule"))
    same = duplicated(findings.select("id", urls.canonical(F.col("url")).alias("_u"), F.lower(quote_form(F.col("valor"), False)).alias("_v")), ["_u", "_v"], "id")
    quoted = findings.select("id", F.lit("literal").alias("tipo"), "valor", F.col("valor").alias("quote"), "url", F.lit("").alias("campo"))
    return broken.unionByName(counted).unionByName(same).unionByName(field_faults(quoted, pages, "id").where("rule in ('page not kept', 'quote not on page')"))


def run_summary_faults(run: DataFrame, findings: DataFrame, key: str, least: int) -> DataFrame:
    """(key, rule) of runs: more searches than their ceiling, findings named that aren't there, too few findings and no gap said.

    ``run`` has key, buscas_usadas, teto_buscas, top_perguntas and lacunas; ``findings`` has key and id.
    """
    n = findings.groupBy(key).agg(F.count("*").alias("_n"))
    counted = run.join(n, key, "left")
    few = (F.coalesce("_n", F.lit(0)) < least) & (F.size("lacunas") <= 0)
    own = violations(counted, key, {"search ceiling": F.col("buscas_usadas") > F.col("teto_buscas"), "too few findings": few})
    named = run.select(key, F.explode("top_perguntas").alias("id")).distinct()
    return own.unionByName(named.join(findings.select(key, "id"), [key, "id"], "left_anti").select(key, F.lit("unknown finding").alias("rule")))


def schema_faults(document: Column, required: Mapping[str, str], allowed: Mapping[str, list[str]] | None = None) -> Column:
    """array<string>: required fields that a JSON object lacks or has with another type, values outside a list, or that it's none."""
    parsed = F.try_parse_json(document)
    top = F.schema_of_variant(parsed)
    checks = [F.when(parsed.isNull() | ~top.startswith("OBJECT"), F.lit("not an object"))]
    for field, kind in required.items():
        got = F.try_variant_get(parsed, f"$.{field}", kind)
        raw = F.try_variant_get(parsed, f"$.{field}", "string")
        checks.append(F.when(parsed.isNotNull() & top.startswith("OBJECT"), F.when(raw.isNull(), F.lit(f"{field} missing")).when(got.isNull(), F.lit(f"{field} is no {kind}"))))
    for field, values in (allowed or {}).items():
        got = F.try_variant_get(parsed, f"$.{field}", "string")
        checks.append(F.when(got.isNotNull() & ~got.isin(*values), F.lit(f"{field} not allowed")))
    return F.array_compact(F.array(*checks))


def site_faults(html: Column, marks: Mapping[str, str]) -> Column:
    """array<string>: what a public page lacks in its head, each mark a pattern; and a ban on indexing that it has."""
    head = F.element_at(F.split(html, "(?i)</head>"), 1)
    checks = [F.when(~head.rlike(rx), F.lit(name)) for name, rx in marks.items()]
    return F.array_compact(F.array(*checks, F.when(head.rlike("(?i)noindex"), F.lit("noindex"))))


def evidence_summary(record: DataFrame, key: str, fields: list[str], listed: str) -> DataFrame:
    """(key, fields, listed, urls): typed fields in short form, the values of a list that were inferred, and the pages behind all of it."""
    short = lambda c: F.struct(F.col(f"{c}.tipo").alias("t"), F.col(f"{c}.valor").alias("v"), F.coalesce(F.col(f"{c}.quote"), F.lit("")).alias("q"), F.coalesce(F.col(f"{c}.url"), F.lit("")).alias("u")).alias(c)
    inferred = F.transform(F.filter(listed, lambda o: o["tipo"] == "inferido"), lambda o: o["valor"])
    pages = F.array_distinct(F.filter(F.array(*[F.col(f"{c}.url") for c in fields]), lambda u: u.isNotNull() & (u != "")))
    return record.select(key, *[short(c) for c in fields], inferred.alias(listed), pages.alias("urls"))
