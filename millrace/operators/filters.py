"""Predicates of the sources: places, brands, registries, forbidden names, guesses, queues."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import fold, squeeze_key


def in_box(lat: Column, lng: Column, south: float, west: float, north: float, east: float) -> Column:
    """Inside a box of coordinates; unknown coordinates are not."""
    return F.coalesce(lat.between(south, north) & lng.between(west, east), F.lit(False))


def is_brand(name: Column, pattern: str, exclude: str = "") -> Column:
    """A folded name that fits a brand's pattern and no excluded one."""
    n = fold(F.lower(name))
    out = n.rlike(pattern)
    return F.coalesce(out & ~n.rlike(exclude) if exclude else out, F.lit(False))


def activity_role(primary: Column, secondary: Column, code: str) -> Column:
    """principal or secundaria where a company has an activity code, else null."""
    listed = F.array_contains(F.transform(F.split(F.coalesce(secondary, F.lit("")), ","), lambda x: F.trim(x)), code)
    return F.when(primary == code, "principal").when(listed, "secundaria")


def without_names(df: DataFrame, text: str, names: Iterable[str]) -> DataFrame:
    """Rows whose text holds none of some names, case aside; a null text holds none."""
    hit = F.lit(False)
    for name in names:
        hit = hit | F.contains(F.lower(text), F.lit(name.lower()))
    return df.where(~F.coalesce(hit, F.lit(False)))


def is_company(name: Column, words: str = r"institut|research|insight|market|consult|analytics|pesquisa|studio|data", people: str = r"^(dr|prof|mr|mrs|ms|herr|frau)\.?\s") -> Column:
    """Whether a name looks like a company's: a word of the trade or a legal form, and no person's title."""
    n = fold(F.lower(F.trim(name)))
    legal = r"\b(gmbh|ag|ltd|ltda|inc|llc|s\.?a\.?|srl|bv|kk|co)\b\.?$"
    return F.coalesce((n.rlike(words) | n.rlike(legal)) & ~n.rlike(people), F.lit(False))


def is_commercial(name: Column, level: Column, organisers: Iterable[str], levels: Iterable[str] = ("media", "association", "charity", "organiser")) -> Column:
    """A sponsor that buys: neither an organiser nor at a level that isn't sold."""
    return ~squeeze_key(name).isin(*organisers) & ~F.lower(F.coalesce(level, F.lit(""))).isin(*levels)


def publishable(confidence: Column) -> Column:
    return confidence.isin("A", "B")


def usable(error: Column, note: Column | None = None) -> Column:
    """A record without an error, and not one whose collection was cut short."""
    ok = F.coalesce(error, F.lit("")) == ""
    return ok & ~F.coalesce(note.startswith("limit"), F.lit(False)) if note is not None else ok


def site_confirmed(page: Column, slug: Column, topics: Iterable[str] = ("research", "pesquisa", "insight", "market", "mercado")) -> Column:
    """A guessed site is right when its text has a word of the trade and the beginning of the name."""
    bare = F.regexp_replace(fold(F.lower(page)), "[^a-z0-9]", "")
    return F.coalesce(F.lower(page).rlike("|".join(topics)) & F.contains(bare, F.left(slug, F.lit(8))), F.lit(False))


def approved(df: DataFrame, head: str, offer: str, topic: str) -> DataFrame:
    """All candidates with ``aprovada`` and ``motivo``: a strong offer and the topic in the page's head, or what is missing."""
    strong, on_topic = F.col(head).rlike(offer), F.col(head).rlike(topic)
    reason = F.when(F.coalesce(strong & on_topic, F.lit(False)), "").when(~F.coalesce(strong, F.lit(False)), "no offer").otherwise("off topic")
    return df.withColumn("motivo", reason).withColumn("aprovada", reason == "")


def not_contradicted(items: DataFrame, day: str, page_day: str, today: Column, days: int) -> DataFrame:
    """Items whose date, the page's own where it gives a whole one, is in the window or unknown: a page that says it's old wins over a listing."""
    from millrace.functions.dates import in_window

    known = F.coalesce(page_day, day)
    return items.where(known.isNull() | in_window(known, today, days))


def normal_status(status: Column, meanings: Mapping[str, str], default: str = "indeterminado") -> Column:
    """A vendor's status in the one vocabulary; what isn't known stays undetermined."""
    by = F.create_map(*[F.lit(x) for kv in meanings.items() for x in kv])
    return F.coalesce(by[F.lower(F.trim(status))], F.lit(default))


def within_ceiling(searches: DataFrame, keys: list[str], query: str, order: str, ceiling: int) -> DataFrame:
    """Registered searches up to a ceiling a key; a query that was registered before uses up nothing."""
    from pyspark.sql import Window as W

    first = searches.groupBy(*keys, query).agg(F.min(order).alias("_first"))
    place = F.row_number().over(W.partitionBy(*keys).orderBy("_first", query))
    return searches.join(first.withColumn("_place", place), [*keys, query]).where(F.col("_place") <= ceiling).drop("_first", "_place")


def expanded_queries(topics: DataFrame, topic: str, templates: Iterable[str]) -> DataFrame:
    """(topic, ord, consulta): every topic in every template, ``{}`` being its place."""
    filled = F.array(*[F.replace(F.lit(t), F.lit("{}"), F.col(topic)) for t in templates])
    return topics.select(topic, F.posexplode(filled).alias("ord", "consulta"))
