"""Fields of company and case records that need more than the first fitting sentence."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import urls

#: Hosts of videos, addresses of customer cases and of prices, capitalised words that are no names, words of a poor result.
VIDEOS = r"(?i)youtube\.com/(embed|watch)|youtu\.be/|vimeo\.com/(video/)?\d|wistia\.(com|net)|loom\.com/(share|embed)|vidyard"
CASE_PAGES = r"(case-stud(y|ies)|customer-stor(y|ies)|success-stor(y|ies)|/customers|/cases?)/[^/]+"
PRICE_PAGES = r"pricing|plans|precos|precios|planos"
NOT_NAMES = (
    "We", "Our", "The", "Some", "Many", "Leading", "Fortune", "Global", "World", "Best", "Top", "And", "With", "From", "For", "All", "More", "Most", "Teams", "Brands", "Companies", "Clients",
    "Customers", "AI", "Read", "Learn", "See", "Join", "Over", "Hundreds", "Thousands", "Including", "Like", "Such", "Nossos", "Nuestros", "Os", "Las", "Los", "As", "A", "An", "In", "At", "Of",
    "To", "I", "It", "This",
)
POOR = r"(?i)fail|not\s+really|cannot|can't|worse|poor|overestimat|underestimat|no\s+better|misleading|flatten|bias|did\s+not\s+(match|replicate)"


def demo_video(hrefs: Column) -> Column:
    """The first address of a page's frames and links that shows a video; null without one."""
    return F.try_element_at(F.filter(hrefs, lambda u: u.rlike(VIDEOS)), F.lit(1))


def press_links(hrefs: Column, page: Column, press: Iterable[str], most: int = 8) -> Column:
    """Distinct links to articles of the press: on its list, on another host, with a path of more than eight characters."""
    fits = lambda u: urls.on_list(u, press) & (urls.host(u) != urls.host(page)) & (F.char_length(F.regexp_replace(urls.path(u), "^/+|/+$", "")) > 8)
    return F.slice(F.array_distinct(F.filter(hrefs, fits)), 1, most)


def names_customers(sentence: Column, phrase: str, company: Column) -> Column:
    """Whether two or more names other than the company's own follow the phrase that announces customers."""
    rest = F.regexp_extract(sentence, rf"(?isu)^.*?(?:{phrase})(.*)$", 1)
    names = F.regexp_extract_all(rest, F.lit(r"\b[A-Z][\w&'.-]*[\w&]"), F.lit(0))
    own = F.regexp_extract_all(company, F.lit(r"\w+"), F.lit(0))
    return F.coalesce(F.size(F.array_except(F.filter(names, lambda n: ~n.isin(*NOT_NAMES)), own)) >= 2, F.lit(False))


def is_case_page(url: Column) -> Column:
    return url.rlike(CASE_PAGES)


def prices(found: DataFrame, owner: str, price: str, context: str, unstated: str, url: str = "url", priority: str = "priority") -> DataFrame:
    """(owner, preco, tipo, url): a price on a page of prices, else one in context, else that such a page states none.

    ``found`` holds one sentence a row as ``extract.page_sentences`` gives them; one
    aggregation decides. A page of prices with neither is ``not found`` with its
    address; without any such page the address is null.
    """
    at = lambda rank: F.struct(F.lit(rank).alias("r"), F.col(priority).alias("p"), F.col(url).alias("u"), F.col("pos").alias("n"))
    on, has = F.col(url).rlike(PRICE_PAGES), F.col("sentence").rlike("(?iu)" + price)
    place = F.when(on & has, at(1)).when(has & F.col("sentence").rlike("(?iu)" + context), at(2)).when(on & F.col("sentence").rlike("(?iu)" + unstated), at(3)).when(on, at(4))
    best = found.withColumn("_at", place).groupBy(owner).agg(F.min_by(F.struct("_at", "sentence", url), F.when(F.col("_at").isNotNull(), F.col("_at"))).alias("b"))
    stated = F.coalesce(F.col("b")["_at"]["r"] < 4, F.lit(False))
    return best.select(owner, F.when(stated, F.col("b")["sentence"]).alias("preco"), F.when(stated, "literal").otherwise("not found").alias("tipo"), F.col("b")[url].alias("url"))


def case_title(meta: Column, heading: Column, title: Column) -> Column:
    """struct<value,source> of a page's title: what its metadata cite, its heading, its title; nulls without any."""
    filled = lambda c: F.nullif(c, F.lit(""))
    options = [(filled(F.try_element_at(meta, F.lit(k))), k) for k in ("citation_title", "og:title", "dc.title")] + [(filled(heading), "h1"), (filled(title), "title")]
    return F.coalesce(*[F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit(k).alias("source"))) for v, k in options], F.struct(F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("source")))


def case_signal(text: Column) -> Column:
    """A case whose results or title speak of failure or bias is mixed; others are positive or neutral."""
    return F.when(text.rlike(POOR), "negativo_ou_misto").otherwise("positivo_ou_neutro")


def independence(url: Column, vendor_domain: Column, academic: Iterable[str], evidence: Column) -> Column:
    """Who vouches for a case: its vendor's own page, an academic source, what the seed list says; else the vendor."""
    return (
        F.when(F.coalesce(urls.registrable(url) == vendor_domain, F.lit(False)), "autodeclarado").when(urls.on_list(url, academic), "independente")
        .when(F.coalesce(evidence.rlike("(?i)self"), F.lit(False)), "autodeclarado").when(F.coalesce(evidence.rlike("(?i)independent|third|peer"), F.lit(False)), "independente").otherwise("autodeclarado")
    )


def name_on_page(name: Column, text: Column) -> Column:
    """A name as a page has it: whole, else up to its first bracket, comma or slash; null when the page has neither."""
    head = F.trim(F.regexp_extract(name, r"^[^(,/]*", 0))
    on = lambda c: F.when((F.char_length(c) >= 2) & F.contains(text, c), c)
    return F.coalesce(F.when((name != "") & F.contains(text, name), on(name)), on(head))
