"""Data-quality operators: quotes, rules and their violations, coverage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Characters by which passages without a whole word meet texts.
GRAM = 8
#: Most quotes whose keys are sent whole to every executor; with more, the words of the texts are shuffled to meet them.
MAX_BROADCAST_QUOTES = 10_000


def fragments(quote: Column) -> Column:
    """The parts of a quote between ``...``, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(quote, r"\s*(?:\.\.\.|…)\s*"), lambda p: F.trim(p)), lambda p: p != "")


def likely_holders(quotes: DataFrame, docs: DataFrame, item: str, quote: str, parts: Column, doc: str, text: str) -> DataFrame:
    """(item, quote, doc) with every pair in which a text holds all of ``parts``, and few others.

    A part's words but its first and last are whole words of any text that holds it,
    so pairs meet on the longest of these. Where there is none, they meet on the
    first characters of the longest part. Words and characters travel without texts,
    and while the quotes are few, only those that meet one travel at all.
    """
    few = quotes.limit(MAX_BROADCAST_QUOTES + 1).count() <= MAX_BROADCAST_QUOTES
    small = F.broadcast if few else (lambda df: df)
    inner = F.flatten(F.transform(parts, lambda p: F.slice(F.split(p, " "), 2, F.greatest(F.size(F.split(p, " ")) - 2, F.lit(0)))))
    longest = lambda a: F.array_max(F.transform(a, lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))["w"]
    keyed = quotes.select(item, longest(inner).alias("_w"), F.left(longest(parts), F.lit(GRAM)).alias("_g"))
    words = docs.select(doc, F.explode(F.array_distinct(F.split(text, " "))).alias("_w"))
    out = words.join(small(keyed.where("_w is not null").select(item, "_w")), "_w").select(item, doc)
    short = keyed.where("_w is null and _g is not null").select(item, "_g", F.char_length("_g").alias("_n"))
    for (n,) in short.select("_n").distinct().collect():  # at most GRAM + 1 lengths
        grams = F.transform(F.sequence(F.lit(1), F.char_length(text) - n + 1), lambda i: F.substring(F.col(text), i, F.lit(n)))
        held = docs.where(F.char_length(text) >= n).select(doc, F.explode(F.array_distinct(grams)).alias("_g"))
        out = out.unionByName(held.join(small(short.where(F.col("_n") == n).select(item, "_g")), "_g").select(item, doc))
    return out.distinct().join(small(quotes.select(item, quote)), item).select(item, quote, doc)


def quote_holds(quote: Column, text: Column) -> Column:
    """Whether all fragments of a quote stand in a text in order; ``...`` parts fragments. Both in quote form.

    No fragment, or a null on either side, is false.
    """
    parts = fragments(quote)
    step = lambda at, p: F.when(at == 0, F.lit(0)).otherwise(
        F.when(F.position(p, text, at) > 0, F.position(p, text, at) + F.char_length(p)).otherwise(0)
    )
    return F.coalesce((F.size(parts) > 0) & (F.aggregate(parts, F.lit(1), step) > 0), F.lit(False))


def violations(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """(key, rule) for every rule that a row breaks, all rules in one pass; a rule that is null holds."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]))
    return df.select(key, F.explode(broken).alias("rule"))


def duplicated(df: DataFrame, keys: list[str], key: str, rule: str = "duplicate") -> DataFrame:
    """(key, rule) for every row but the first of those that share ``keys``.

    The first one is a minimum, combined before the shuffle, so no task holds all
    copies of a very common row.
    """
    firsts = df.groupBy(*keys).agg(F.min(key).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    return df.join(firsts, keys).where(F.col(key) != F.col("_first")).select(key, F.lit(rule).alias("rule"))


def coverage(df: DataFrame, columns: list[str], missing: Column | None = None) -> DataFrame:
    """(field, filled, empty, missing): how each column is filled, in one pass over the rows."""
    stats = []
    for c in columns:
        v = F.col(c).cast("string")
        stats += [F.count_if(v.isNotNull() & (v != "")).alias(f"{c}_filled"), F.count_if(v == "").alias(f"{c}_empty"), F.count_if(v.isNull()).alias(f"{c}_missing")]
    one = df.agg(*stats)
    rows = F.array(*[F.struct(F.lit(c).alias("field"), *[F.col(f"{c}_{k}").alias(k) for k in ("filled", "empty", "missing")]) for c in columns])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def normal_form(text: Column) -> Column:
    """The form in which prose citations are compared: lower case, single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def style_faults(text: Column, words: list[str]) -> Column:
    """Names of the style rules that a text breaks: long dashes, forbidden words, contrast formulas, prices."""
    listed = "|".join(words)
    tests = (("dash", text.rlike("[—–]")), ("word", F.lower(text).rlike(rf"\b({listed})\b")), ("contrast", F.lower(text).rlike(r"\bnot (just|only)\b.*\bbut\b")), ("price", text.rlike(r"(R\$|US\$|€)\s*\d")))
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))


def plan_faults(plan: DataFrame, key: str, required: list[str], used: str, offered: list[str]) -> DataFrame:
    """(key, missing, unused, repeated): what a plan leaves out, and what it plans twice."""
    have = F.col(used)
    want, all_ = F.array(*[F.lit(x) for x in required]), F.array(*[F.lit(x) for x in offered])
    twice = F.filter(F.array_distinct(have), lambda x: F.size(F.filter(have, lambda y: y == x)) > 1)
    return plan.select(key, F.array_except(want, have).alias("missing"), F.array_except(all_, have).alias("unused"), F.array_sort(twice).alias("repeated"))
