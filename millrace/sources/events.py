"""Who shows and sponsors at events: landed event pages to one record a company and edition, natively."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.sources.directories import attribute, body, first, first_of, inner, links, no_query, opening, outside

#: Organisers, media and associations, levels that aren't sold, hosts that are no company's site.
ORGANISERS = ("greenbook", "quirk", "quirk's", "quirks", "quirk's media", "merlien", "merlien institute", "informa", "informa connect", "insights association", "esomar")
MEDIA = (
    "market research council", "women in research", "woman in research", "women in research (wire)", "the research club", "qrca", "association for qualitative research", "mrii",
    "insights association", "university of georgia | market research institute international", "mrii | university of georgia", "university of georgia", "the insights exchange",
    "research world", "greenbook", "professional insights collaborative", "40+ double dutch club", "insight management academy", "mrba", "market research benevolent association", "richmond events",
)
UNSOLD = ("presented by", "media partner", "media partners", "association partner", "learning partner", "brand partner", "partner", "partners", "client sponsor", "mrs is proud to support")
NO_SITE = r"cal\.com|calendly\.com|eventbrite\.|docs\.google\.com|forms\.gle|linktr\.ee|bit\.ly|hubspot\.com|zoom\.us|lu\.ma"
BOOTHS = ("exhibit", "exhibit+", "kiosk", "tech demo", "startup")
COLUMNS = ("nome", "site", "tipo_participacao", "nivel_patrocinio", "evento", "edicao", "ano", "pais", "email", "estande", "descricao", "url_fonte")


def own_site(url: Column) -> Column:
    """A URL without its query; empty when it's a booking, a form or a shortener."""
    return F.when(F.lower(url).rlike(NO_SITE), "").otherwise(no_query(url))


def _record(df: DataFrame, **values: Column) -> DataFrame:
    return df.select(*[values.get(c, F.lit("")).alias(c) for c in COLUMNS])


def _edition(column: str, editions: Mapping[str, tuple[str, ...]], part: int) -> Column:
    table = F.create_map(*[F.lit(x) for k, v in editions.items() for x in (k, v[part])])
    return F.coalesce(table[F.col(column)], F.lit(""))


def participation(stated: Column) -> Column:
    """struct<kind,level> of what an organiser states, such as ``Exhibitor, Presenter, Bronze Sponsor``."""
    low = F.lower(stated)
    shows, pays = F.contains(low, F.lit("exhibitor")), F.contains(low, F.lit("sponsor"))
    level = F.initcap(F.regexp_extract(stated, r"(?i)\b(Title|Platinum|Titanium|Gold|Silver|Bronze|Diamond|Founding)\b[^,]*Sponsor", 1))
    kind = F.when(shows & pays, "expositor e patrocinador").when(shows, "expositor").when(pays, "patrocinador").when(F.contains(low, F.lit("partner")), "parceiro").otherwise("outro")
    return F.struct(kind.alias("kind"), F.when(shows | pays, F.when(level != "", level).when(pays, "Sponsor").otherwise("")).otherwise("").alias("level"))


def profile_participants(pages: DataFrame, editions: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """One company a page (url, edicao, html), with the participation that the organiser wrote. ``editions``: city, year, country."""
    h = F.col("_h")
    rows = pages.select("url", "edicao", body().alias("_h"))
    part = participation(text.plain_text(inner(h, "p", "icon_sponsor")))
    site = F.coalesce(F.try_element_at(links(inner(h, "p", "company_url")), F.lit(1))["href"], F.lit(""))
    content = F.regexp_extract(h, rf"(?is){opening('div', 'content')}(.*)", 1)
    plain = F.filter(F.transform(F.regexp_extract_all(content, F.lit(r"(?is)<p>((?:(?!<a\b|</p).)*+)</p\s*>"), F.lit(1)), text.plain_text), lambda p: F.char_length(p) > 60)
    stand = text.plain_text(inner(F.regexp_extract(h, rf"(?is){opening('a', 'icon_pin')}.*?</a\s*>", 0), "span"))
    mail = first(F.transform(F.filter(links(h), lambda a: F.lower(a["href"]).startswith("mailto:")), lambda a: no_query(F.substr(a["href"], F.lit(8)))))
    return _record(
        rows, nome=F.trim(F.substring_index(text.plain_text(inner(h, "title")), " - The Quirks Event", 1)), site=F.when(site.startswith("http"), own_site(site)).otherwise(""),
        tipo_participacao=part["kind"], nivel_patrocinio=part["level"], evento=F.lit("Quirk's Event"), edicao=_edition("edicao", editions, 0), ano=_edition("edicao", editions, 1),
        pais=_edition("edicao", editions, 2), email=mail, estande=stand, descricao=F.left(first(plain), F.lit(600)), url_fonte=F.col("url"),
    )


def card_participants(pages: DataFrame, editions: Mapping[str, tuple[str, str]], card: str, level: str, name: str, own: tuple[str, ...], year: Column, kind) -> DataFrame:
    """Companies of cards on one page an edition (url, edicao, html): level, name (else the logo's text) and first foreign link.

    A card ends where the next begins. ``kind`` turns a level into a participation. ``editions``: event, country.
    The year is read before the cards are: beside ``explode`` Spark would read the whole page again for every card.
    """
    start = rf"""<div\b[^>]*class\s*=\s*["'][^"'>]*{card}[^"'>]*["'][^>]*>"""
    dated = pages.select("url", "edicao", year.alias("_y"), body().alias("_h"))
    cards = dated.select("url", "edicao", "_y", F.explode(F.regexp_extract_all("_h", F.lit(rf"(?is){start}(?:(?!{start}).)*+"), F.lit(0))).alias("_c"))
    holds = lambda cls: text.plain_text(F.regexp_extract("_c", rf"""(?is)<([a-z0-9]+)\b[^>]*class\s*=\s*["'][^"'>]*{cls}[^"'>]*["'][^>]*>(.*?)</\1\s*>""", 2))
    alt = text.collapse(attribute(F.regexp_extract("_c", r"(?is)<img\b[^>]*>", 0), "alt"))
    link = F.coalesce(F.try_element_at(outside(F.col("_c"), own), F.lit(1))["href"], F.lit(""))
    event = first_of(_edition("edicao", editions, 0), F.col("edicao"))
    return _record(cards, nome=first_of(holds(name), alt), site=own_site(link), tipo_participacao=kind(F.lower(holds(level))), nivel_patrocinio=holds(level), evento=event, edicao=event, ano=F.col("_y"), pais=_edition("edicao", editions, 1), url_fonte=F.col("url"))


def expo_participants(pages: DataFrame, editions: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Cards whose level is a booth, an unsold partnership or a sponsorship; the year of the heading, else of the menu's label."""
    menu = F.filter(F.transform(links(body()), lambda a: F.regexp_extract(a["label"], r"^(20\d{2})\s+Partners", 1)), lambda y: y != "")
    year = first_of(F.regexp_extract(text.plain_text(inner(body(), "h1")), r"(20\d{2})", 1), first(menu))
    kind = lambda low: F.when(low.isin(*BOOTHS), "expositor").when(low.isin(*UNSOLD), "parceiro").otherwise("patrocinador")
    return card_participants(pages, editions, r"Partner-module[^\"'>]*__partner(?![\w-])", "__tag", "__name", ("greenbook.org",), year, kind)


def forum_participants(pages: DataFrame, editions: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Cards of sponsors and partners; the year that the block's title states, none for past sponsors."""
    year = F.regexp_extract(text.plain_text(body()), r"Our\s+(20\d{2})", 1)
    return card_participants(pages, editions, r"(?<![\w-])sponsor-card(?![\w-])", "sponsor-type", "sponsor-name", ("mrmw.net",), year, lambda low: F.when(F.contains(low, F.lit("partner")), "parceiro").otherwise("patrocinador"))


def company_form(name: Column) -> Column:
    """A company's name in lower case without points, commas and a legal form at its end."""
    bare = F.regexp_replace(F.lower(text.collapse(F.coalesce(name, F.lit("")))), "[.,]", "")
    return F.trim(F.regexp_replace(bare, r"\s+(inc|llc|ltd|limited|gmbh|bv|sa|co)$", ""))


def sold(name: Column, level: Column, kind: Column) -> Column:
    """Whether a record is a company that bought its place: no organiser, medium or association, no unsold level, no mere speaker."""
    n = company_form(name)
    return (n != "") & ~n.isin(*ORGANISERS, *MEDIA) & ~F.lower(text.collapse(F.coalesce(level, F.lit("")))).isin(*UNSOLD) & kind.isin("expositor", "patrocinador", "expositor e patrocinador")


def participants(sources: list[DataFrame]) -> DataFrame:
    """All sources in one table, one record a company (by its form), event and edition, the fullest of each, with ``comercial``.

    Names that are empty stay apart by their page and site, so they never fall together.
    """
    rows = reduce(DataFrame.unionByName, sources)
    filled = reduce(lambda a, b: a + b, [(F.col(c) != "").cast("int") for c in COLUMNS])
    who = F.when(company_form(F.col("nome")) != "", company_form(F.col("nome"))).otherwise(F.concat(F.lit("#"), F.col("url_fonte"), F.lit(" "), F.col("site")))
    order = F.struct((-filled).alias("f"), *[F.col(c) for c in COLUMNS])
    best = rows.groupBy("evento", "edicao", who.alias("_w")).agg(F.min_by(F.struct(*COLUMNS), order).alias("r")).select("r.*")
    return best.withColumn("comercial", sold(F.col("nome"), F.col("nivel_patrocinio"), F.col("tipo_participacao")))

