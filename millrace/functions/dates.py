"""Dates and numbers as the sources write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days of a unit of a relative date.
UNIT_DAYS = {"minuto": 1 / 1440, "hora": 1 / 24, "dia": 1.0, "semana": 7.0, "mes": 30.0, "meses": 30.0, "ano": 365.0}
NOT_FOUND = "not found"


def parse_date(text: Column, long_form: bool = False) -> Column:
    """The date of an RFC 822, ISO or slashed date, in its own offset; null when it is none."""
    t = F.trim(text)
    bare = F.regexp_replace(t, r"^[A-Za-z]{3,9},\s*", "")
    rfc = F.try_to_date(F.regexp_extract(bare, r"^(\d{1,2} [A-Za-z]{3} \d{4})\b", 1), "d MMM yyyy")
    iso = F.try_to_date(F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    slashed = F.try_to_date(F.regexp_extract(t, r"^(\d{4}/\d{2}/\d{2})", 1), "yyyy/MM/dd")
    out = [rfc, iso, slashed]
    if long_form:
        out.append(F.try_to_date(F.regexp_extract(t, r"^([A-Za-z]{3} \d{1,2}, \d{4})", 1), "MMM d, yyyy"))
    return F.coalesce(*out)


def in_window(day: Column, today: Column, days: int, slack: int = 1) -> Column:
    """Inside the look-back window; an unknown day is not."""
    return F.coalesce(day.between(F.date_sub(today, days), F.date_add(today, slack)), F.lit(False))


def since_or_unknown(day: Column, cutoff: Column) -> Column:
    return day.isNull() | (day >= cutoff)


def page_date(meta: Column, jsonld: Column, url: Column) -> Column:
    """The day, or the year, that a page gives for itself: metadata, JSON-LD, then its address."""
    hyphens = lambda c: F.replace(c, F.lit("/"), F.lit("-"))
    some = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(
        some(hyphens(F.regexp_extract(F.coalesce(meta, F.lit("")), r"^(\d{4}[-/]\d{2}[-/]\d{2})", 1))),
        some(F.regexp_extract(F.coalesce(jsonld, F.lit("")), r'"datePublished"\s*:\s*"(\d{4}-\d{2}-\d{2})', 1)),
        some(hyphens(F.regexp_extract(F.coalesce(url, F.lit("")), r"/(20\d{2}/\d{2}/\d{2})/", 1))),
        some(F.regexp_extract(F.coalesce(url, F.lit("")), r"/(20\d{2})/", 1)),
        F.lit(NOT_FOUND),
    )


def relative_date(text: Column, now: Column) -> Column:
    """The day that ``há 3 meses`` means at ``now``; null when it says nothing of the kind."""
    t = F.translate(F.lower(text), "áâãêéíóôõúç", "aaaeeiooouc")
    word, unit = (F.regexp_extract(t, r"(\d+|uma?)\s+(minuto|hora|dia|semana|meses|mes|ano)", n) for n in (1, 2))
    n = F.when(word.startswith("u"), 1).otherwise(word.try_cast("int"))
    days = F.create_map(*[F.lit(x) for kv in UNIT_DAYS.items() for x in kv])[unit]
    return F.when(word != "", F.to_date(F.timestamp_seconds(F.unix_timestamp(now) - (n * days * 86400).cast("long"))))


def months_since(day: Column, today: Column) -> Column:
    return F.bround(F.datediff(today, day) / F.lit(30.4), 1)


def date_confidence(value: Column, first: str, last: str) -> Column:
    """in, out or unknown, compared as far as the value is precise."""
    n = F.length(value)
    inside = (value >= F.left(F.lit(first), n)) & (value <= F.left(F.lit(last), n))
    return F.when(value.isNull() | ~value.rlike(r"^\d{4}(-\d{2}){0,2}$"), "unknown").when(inside, "in").otherwise("out")


def number(text: Column) -> Column:
    """``1.234,5`` as a double; null without digits."""
    found = F.regexp_extract(text, r"\d[\d.]*(?:,\d+)?", 0)
    return F.when(found != "", F.replace(F.replace(found, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double"))


def grades_of_code(code: Column) -> Column:
    """Grades that a curriculum code covers: ``EF15`` from 1 to 5, ``EF07`` the seventh, ``EF67`` from 6 to 7."""
    pair = F.regexp_extract(code, r"^EF(\d)(\d)", 0)
    a, b = (F.regexp_extract(code, r"^EF(\d)(\d)", n).try_cast("int") for n in (1, 2))
    span = F.when(pair == "", F.array().cast("array<int>")).when(a == 0, F.array(b)).when(b >= a, F.sequence(F.least(a, b), F.greatest(a, b))).otherwise(F.array().cast("array<int>"))
    return F.transform(span, lambda g: g.cast("string"))
