"""Rule cascades, vocabularies, scores and their evaluation."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import search_key, shorten


def _quoted(term: str) -> str:
    return re.sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", term)


def vocabulary(terms: Iterable[str]) -> str:
    """One expression for many terms: the start of a word, longest terms first, any ending."""
    return "(?<![a-z0-9])(?:" + "|".join(_quoted(t) for t in sorted(set(terms), key=lambda t: (-len(t), t))) + ")"


def hits(text: Column, terms: Iterable[str], folded: bool = False) -> Column:
    """How often terms (already folded) start a word of the text; 0 for null."""
    key = text if folded else search_key(text, compatible=False)
    return F.coalesce(F.regexp_count(key, F.lit(vocabulary(terms))), F.lit(0))


def any_word(text: Column, words: Iterable[str]) -> Column:
    """Whether any of some lower-case strings is part of the text."""
    return F.coalesce(F.lower(text).rlike("|".join(_quoted(w) for w in words)), F.lit(False))


def code_themes(df: DataFrame, text: str, themes: Mapping[str, str], keep: list[str]) -> DataFrame:
    """(keep, theme): a row for every theme whose expression a text fits; a handful of themes in one pass."""
    named = F.array(*[F.when(F.col(text).rlike("(?iu)" + rx), F.lit(name)) for name, rx in themes.items()])
    return df.select(*keep, F.explode(F.array_compact(named)).alias("theme"))


def evaluate(gold: DataFrame, found: DataFrame, key: str, code: str) -> DataFrame:
    """(code, tp, fp, fn, precision, recall) of each code, and of all of them under ``*``; null where nothing counts."""
    both = gold.select(key, code).distinct().withColumn("_g", F.lit(1)).join(found.select(key, code).distinct().withColumn("_f", F.lit(1)), [key, code], "full_outer")
    totals = both.groupBy(F.col(code)).agg(
        F.count_if(F.col("_g").isNotNull() & F.col("_f").isNotNull()).alias("tp"), F.count_if(F.col("_g").isNull()).alias("fp"), F.count_if(F.col("_f").isNull()).alias("fn")
    )
    micro = totals.agg(F.lit("*").alias(code), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")])
    every = totals.unionByName(micro)
    return every.withColumn("precision", F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), 6)).withColumn("recall", F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), 6))


def first_fit(rules: Iterable[tuple[Column, str]], default: str) -> Column:
    """The name of the first rule that fits."""
    out = None
    for test, name in rules:
        out = F.when(test, name) if out is None else out.when(test, name)
    return F.lit(default) if out is None else out.otherwise(default)


def family_by_ratio(text: Column, new: Iterable[str], classic: Iterable[str]) -> Column:
    """The family whose terms prevail: the new one from two hits on, and at least half of the classic ones' hits."""
    n, c = hits(text, new), hits(text, classic)
    return F.when((n == 0) & (c == 0), "none").when(n >= F.greatest(F.lit(2.0), c / 2), "new").otherwise("classic")


def sentence_score(sentence: Column, stems_hit: Column, question_words: Iterable[str]) -> Column:
    """Twice the stems, a bonus for a question word at the start, a little off for length."""
    asks = F.lower(sentence).rlike("^(" + "|".join(question_words) + r")\b") & sentence.endswith("?")
    return F.round(stems_hit * 2 + F.when(asks, 1.5).otherwise(0.0) - F.char_length(sentence) / F.lit(400.0), 6)


def excerpts(blocks: DataFrame, key: str, position: str, text: str, terms: Iterable[str], signals: Iterable[str], k: int = 5, least: int = 60, most: int = 500) -> DataFrame:
    """(key, place, score, excerpt): the k blocks with most vocabulary and signals, in the order in which they stand."""
    from millrace.operators.rank import top_k_in_order

    # folded once a block, and only blocks with vocabulary come out
    counts = lambda key: F.struct(hits(key, terms, True).alias("v"), hits(key, signals, True).alias("g"))
    found = F.filter(F.transform(F.array(search_key(F.col(text), compatible=False)), counts), lambda s: s["v"] > 0)
    scored = blocks.where(F.char_length(text) >= least).select(key, position, text, F.explode(found).alias("_s"))
    scored = scored.withColumn("score", F.col("_s.v") + F.col("_s.g") * 2)
    return top_k_in_order(scored, [key], F.col("score"), position, k).select(key, "place", "score", shorten(F.col(text), most).alias("excerpt"))
