"""Member directories, logo walls and registers: landed pages to one typed record an entry.

A reader is one projection over (url, html) of JVM functions, so it stays in the
scan's stage; those that must know what lies inside what read the page's elements
first (``sources.elements``). What a site fixes (labels, own domains) stands in tables at
the top. A null body counts as empty; a page without a name keeps its row with
``erro``, as a run has to see it. Links are judged by their host, not by any part of the URL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import contact, text, urls
from millrace.operators.filters import site_confirmed
from millrace.sources.elements import content, cut, links_in, of, once, one, said, with_elements, within

#: Networks that are nobody's own site, states of Brazil, labels and own domains of the sources.
SOCIAL = ("linkedin.com", "facebook.com", "twitter.com", "x.com", "youtube.com", "instagram.com")
MESSENGERS = ("wa.me", "api.whatsapp.com")
STATES = "AC|AL|AP|AM|BA|CE|DF|ES|GO|MA|MT|MS|MG|PA|PB|PR|PE|PI|RJ|RN|RS|RO|RR|SC|SP|SE|TO"
BRAZIL_LABELS = {
    "tipo_empresa": ("tipo de empresa",), "endereco": ("endereço", "endereco"), "telefone": ("telefone",), "campos_atuacao": ("campos de atuação",),
    "metodos_tecnicas": ("métodos e técnicas",), "outros_servicos": ("outros serviços",),
}
COMPANY_TYPES = ("LocalBusiness", "Organization", "Corporation", "ProfessionalService")
SPAIN_OWN = ("ia-espana.org", "google.com", "cookiedatabase.org", "wordpress.org")
SPAIN_MAIL = ("secretaria@ia-espana.org", "info@ia-espana.org")
BRITISH_MAIL = ("info@mrs.org.uk", "support@ama.uk.com")
BRITISH_COUNTRIES = {
    "united states (usa)": "United States", "usa": "United States", "united states": "United States", "uk": "United Kingdom", "united kingdom": "United Kingdom",
    "england": "United Kingdom", "scotland": "United Kingdom", "wales": "United Kingdom", "northern ireland": "United Kingdom", "republic of ireland": "Ireland", "eire": "Ireland",
}
PERU_OWN = ("apeim.com.pe", "talkin.com.pe", "tudashboard.com")
PERU_NOISE = ("gremio sin fines de lucro", "políticas de privacidad", "inicio", "nombre de usuario")
STREETS = r"(?iu)\b(av\.|avda\.|avenida|calle|jr\.|jir[oó]n|urb\.|edificio|piso|of\.|oficina|centro empresarial|paseo|torre|mz\.|nro\.?|km\b|carretera)"
FRANCE_OWN = ("syntec-conseil.fr", "syntec-etudes.com", "syntec.fr")
NOT_MAIL = r"(?i)\.(png|jpe?g|gif|webp|svg|css|js)$|^leaflet@"


# --- parts of a page


def body(html: str = "html") -> Column:
    return F.coalesce(F.col(html), F.lit(""))


def opening(tag: str, cls: str) -> str:
    """A pattern for a start tag that has a class."""
    return rf"""<{tag}\b[^>]*\bclass\s*=\s*["'][^"'>]*(?<![\w-]){cls}(?![\w-])[^"'>]*["'][^>]*>"""


def inner(markup: Column, tag: str, cls: str | None = None) -> Column:
    """What the first element of a tag (and class) holds, up to the next end tag of that name; empty without one."""
    start = opening(tag, cls) if cls else rf"<{tag}\b[^>]*>"
    return F.regexp_extract(markup, rf"(?is){start}(.*?)</{tag}\s*>", 1)


def attribute(tag: Column, name: str) -> Column:
    """The quoted value of an attribute of one tag, references to ampersands decoded."""
    return F.replace(F.regexp_extract(tag, rf"""(?is)(?<![\w-]){name}\s*=\s*["']([^"'>]*)["']""", 1), F.lit("&amp;"), F.lit("&"))


def first(items: Column) -> Column:
    return F.coalesce(F.try_element_at(items, F.lit(1)), F.lit(""))


def meta(markup: Column, kind: str, name: str) -> Column:
    """The content of the first meta tag of a name or property."""
    return attribute(F.regexp_extract(markup, rf"""(?is)<meta\b[^>]*{kind}\s*=\s*["']{name}["'][^>]*>""", 0), "content")


def links(markup: Column) -> Column:
    """array<struct<href,label>> of all links with an address, in the page's order; a link ends at its end tag or where the next begins."""
    parts = F.filter(F.split(markup, r"(?i)<a(?=[\s/>])"), lambda p, i: (i > 0) & F.contains(p, F.lit(">")))
    pair = F.transform(parts, lambda p: F.named_struct(F.lit("href"), F.trim(attribute(F.regexp_extract(p, "^[^>]*>", 0), "href")), F.lit("label"), text.plain_text(F.concat(F.lit("<a"), F.split(p, r"(?i)</a\s*>", 2)[0]))))
    return F.filter(pair, lambda x: x["href"] != "")


def targets(markup: Column) -> Column:
    """The addresses of all links, as :func:`links` finds them, without their labels."""
    parts = F.filter(F.split(markup, r"(?i)<a(?=[\s/>])"), lambda p, i: (i > 0) & F.contains(p, F.lit(">")))
    return F.filter(F.transform(parts, lambda p: F.trim(attribute(F.substring_index(p, ">", 1), "href"))), lambda x: x != "")


def outside(markup: Column, own: Iterable[str]) -> Column:
    """Links to sites that aren't on a list."""
    return F.filter(links(markup), lambda x: x["href"].startswith("http") & ~urls.on_list(x["href"], own))


def first_outside(hrefs: Column, own: Iterable[str]) -> Column:
    """The first address of a site that isn't on a list, without its query; empty for none."""
    return no_query(first(F.filter(hrefs, lambda x: x.startswith("http") & ~urls.on_list(x, own))))


def no_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def mailed(markup: Column, own: Iterable[str] = ()) -> Column:
    """Addresses of mail links, each once, those of the directory itself left out."""
    return mailed_to(targets(markup), own)


def mailed_to(hrefs: Column, own: Iterable[str] = ()) -> Column:
    """Addresses of mail links among some targets, each once, those of the directory itself left out."""
    addresses = F.transform(F.filter(hrefs, lambda h: F.lower(h).startswith("mailto:")), lambda h: F.lower(F.trim(no_query(F.substr(h, F.lit(8))))))
    return F.array_distinct(F.filter(addresses, lambda e: (e != "") & ~e.isin(*own or ("",)) & ~e.rlike(NOT_MAIL)))


def lines(markup: Column) -> Column:
    """Visible lines: every tag ends one, scripts and styles are none, empty ones are out."""
    seen = F.regexp_replace(markup, r"(?is)<(script|style|noscript)\b(?:(?!</\1).)*+(?:</\1[^>]*>|\z)|<!--(?:(?!-->).)*+(?:-->|\z)", "\n")
    parts = F.transform(F.split(F.regexp_replace(seen, "<[^>]*>", "\n"), "\n"), text.plain_text)
    return F.filter(parts, lambda x: x != "")


def broken_lines(markup: Column) -> Column:
    """Lines that only line breaks and ends of blocks end; links and emphasis stay inside theirs."""
    flat = F.regexp_replace(F.regexp_replace(markup, r"\s+", " "), r"(?i)<br\b[^>]*>|</?(p|div|li|h[1-6]|tr|ul|td)\b[^>]*>", "\n")
    return F.filter(F.transform(F.split(flat, "\n"), text.plain_text), lambda x: x != "")


def _named(name: Column, why: str) -> Column:
    return F.when(name == "", why).otherwise("")


def first_of(*values: Column) -> Column:
    """The first of some values that isn't empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


# --- directories


def brazilian_members(pages: DataFrame) -> DataFrame:
    """Members whose text block lists ``<b>label:</b> value`` paragraphs; addresses hidden by XOR are shown, the state ends the address.

    Only what lies inside the block counts. A label that occurs twice counts by its last paragraph; ``n/a`` and dashes are empty.
    """
    h, e = F.col("_h"), F.col("_e")
    stated = lambda c: F.when(F.lower(c).isin("n/a", "na", "-", "--"), "").otherwise(c)
    rows = with_elements(pages.select("url", body().alias("_h")), "_h").withColumn("_b", one(e, "div", "area-texto")).withColumn("_in", within(e, F.col("_b")))
    label = lambda p: F.lower(F.regexp_replace(said(h, one(within(e, p), "b")), ":+$", ""))
    rows = rows.withColumn("_p", F.transform(of(F.col("_in"), "p"), lambda p: F.struct(label(p).alias("k"), p.alias("p"))))
    held = lambda labels: F.try_element_at(F.filter(F.col("_p"), lambda x: x["k"].isin(*labels)), F.lit(-1))["p"]

    def value(labels: Iterable[str]) -> Column:
        p = held(labels)
        b = one(within(e, p), "b")
        return stated(text.plain_text(F.concat(cut(h, p["open"], b["start"]), F.lit(" "), cut(h, b["stop"], p["close"]))))

    mail, site = held(("e-mail", "email")), held(("site",))
    hidden = attribute(F.coalesce(one(within(e, mail), "a", "__cf_email__")["head"], F.lit("")), "data-cfemail")
    to = F.filter(F.transform(links_in(h, within(e, mail)), lambda x: x["href"]), lambda x: F.lower(x).startswith("mailto:"))
    email = F.when(hidden != "", text.xor_hex(hidden)).otherwise(no_query(F.substr(first(to), F.lit(8))))
    site_links = links_in(h, within(e, site))
    rows = rows.select(
        "url", stated(said(h, one(F.col("_in"), "h3"))).alias("nome"), email.alias("email"), F.when(F.size(site_links) > 0, stated(site_links[0]["label"])).otherwise(stated(said(h, site))).alias("site"),
        F.lit("Brazil").alias("pais"), *[value(v).alias(k) for k, v in BRAZIL_LABELS.items()], F.when(F.col("_b").isNull(), "no text block").otherwise("").alias("erro"),
    )
    return rows.withColumn("uf", F.regexp_extract("endereco", rf"\b({STATES})\s*$", 1))


def _company_json(html: Column) -> Column:
    """The first JSON-LD item of a company's type, alone or in a list."""
    one = "struct<`@type`:string,name:string,telephone:string,keywords:string,address:struct<streetAddress:string,addressLocality:string,addressRegion:string,postalCode:string,addressCountry:string>>"
    scripts = F.regexp_extract_all(html, F.lit(r"""(?is)<script\b[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script\s*>"""), F.lit(1))
    read = lambda s: F.coalesce(F.when(F.ltrim(s).startswith("["), F.from_json(s, f"array<{one}>")).otherwise(F.array(F.from_json(s, one))), F.from_json(F.lit("[]"), f"array<{one}>"))
    return F.try_element_at(F.filter(F.flatten(F.transform(scripts, lambda s: read(F.trim(F.regexp_replace(s, r"\s+", " "))))), lambda x: F.coalesce(x["@type"].isin(*COMPANY_TYPES), F.lit(False))), F.lit(1))


def untracked(url: Column) -> Column:
    """A URL without the parameters that only track a click."""
    kept = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda q: (q != "") & ~F.lower(q).rlike("^(utm_|ref=)"))
    return F.concat(F.regexp_extract(url, r"^[^?#]*", 0), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""), F.regexp_extract(url, "#.*$", 0))


def global_companies(pages: DataFrame) -> DataFrame:
    """Profiles that carry JSON-LD; name, category and country else from the heading and the title's three forms."""
    rows = pages.select("url", body().alias("_h")).withColumn("_j", _company_json(F.col("_h")))
    said = lambda c: text.collapse(F.coalesce(c, F.lit("")))
    address = F.col("_j")["address"]
    title = F.split(text.plain_text(inner(F.col("_h"), "title")), r"\s*\|\s*")
    middle = F.when(F.size(title) >= 3, title[1]).otherwise("")
    split = r"^(.+?)(?:\s+from\s+|\s*,\s*)(.+)$"
    parts = F.array(*[said(address[p]) for p in ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry")])
    name = first_of(said(F.col("_j")["name"]), text.plain_text(inner(F.col("_h"), "h1")), F.when(F.size(title) >= 3, title[0]).otherwise(""))
    profile = F.filter(links(F.col("_h")), lambda x: x["href"].rlike(r"^https?://([\w-]+\.)?linkedin\.com/company"))
    return rows.select(
        "url", name.alias("nome"), said(F.col("_j")["telephone"]).alias("telefone"), said(F.col("_j")["keywords"]).alias("servicos"),
        first_of(said(address["addressCountry"]), F.when(middle.rlike(split), F.regexp_extract(middle, split, 2)).otherwise(middle)).alias("pais"),
        said(address["addressRegion"]).alias("regiao"), said(address["addressLocality"]).alias("cidade"), F.array_join(F.filter(parts, lambda p: p != ""), ", ").alias("endereco"),
        F.regexp_extract(middle, split, 1).alias("categoria"), F.left(text.collapse(meta(F.col("_h"), "name", "description")), F.lit(400)).alias("descricao"),
        no_query(F.coalesce(F.try_element_at(profile, F.lit(1))["href"], F.lit(""))).alias("linkedin"),
        untracked(F.coalesce(F.try_element_at(outside(F.col("_h"), (*SOCIAL, "google.com", "greenbook.org")), F.lit(1))["href"], F.lit(""))).alias("site"), _named(name, "no name").alias("erro"),
    )


def spanish_members(pages: DataFrame) -> DataFrame:
    """Company pages among an association's other pages: those with a marker of a profile and a contact of their own."""
    rows = once(pages.select("url", body().alias("_h")), _t=F.array_join(lines(F.col("_h")), "\n"), _a=targets(F.col("_h")))
    rows = once(rows, _m=mailed_to(F.col("_a"), SPAIN_MAIL), _o=first_outside(F.col("_a"), (*SOCIAL, *SPAIN_OWN)))
    rows = rows.where(F.lower("_t").rlike("especializaci|miembro de:|servicios:|contacto:") & ((F.size("_m") > 0) | (F.col("_o") != "")))
    name = first_of(F.regexp_replace(text.plain_text(inner(F.col("_h"), "title")), r"(?u)\s*[-–|]\s*Insights \+ Analytics Espa[nñ]a\s*$", ""), text.plain_text(inner(F.col("_h"), "h1")))
    written = F.filter(F.transform(contact.found_in(F.col("_h")), F.lower), lambda e: ~e.isin(*SPAIN_MAIL) & ~e.rlike(NOT_MAIL))
    rows = once(rows, _e=F.when(F.size("_m") > 0, F.col("_m")).otherwise(written), _n=name)
    mails, name = F.col("_e"), F.col("_n")
    return rows.select(
        "url", name.alias("nome"), first(mails).alias("email"), F.slice(mails, 2, 3).alias("emails_extras"), F.col("_o").alias("site"),
        F.lit("Spain").alias("pais"), F.left(text.collapse(F.regexp_extract("_t", r"(?s)Especializaci[oó]n:\s*\n(.{40,600}?)(?:\n[A-ZÁÉÍÓÚ][^\n]{0,40}:|\z)", 1)), F.lit(400)).alias("descricao"),
        text.collapse(F.regexp_extract("_t", r"Miembro de:\s*\n([^\n]{3,200})", 1)).alias("associacoes"), text.collapse(F.regexp_extract("_t", r"(\+?\d[\d\s().\-]{7,18}\d)", 1)).alias("telefone"), _named(name, "no name").alias("erro"),
    )


def british_suppliers(pages: DataFrame) -> DataFrame:
    """Suppliers by their own address block, since the page's microdata are the publisher's; further addresses fill what it lacks."""
    h = F.col("_h")
    rows = with_elements(pages.select("url", body().alias("_h")), "_h")
    rows = once(rows, _a=content(h, one(F.col("_e"), "p", "address_block")), _x=content(h, one(F.col("_e"), "div", id_="rbg_addresses")))
    rows = once(rows, _own=broken_lines(F.col("_a")), _more=broken_lines(F.col("_x")), _at=targets(F.col("_a")), _xt=targets(F.col("_x")))
    phone = lambda ls: first(F.filter(F.transform(ls, lambda x: text.collapse(F.regexp_extract(x, r"(?i)^Tel:\s*(.+)$", 1))), lambda x: x != ""))
    own, more = F.col("_own"), F.col("_more")
    rows = once(rows, _l=F.filter(own, lambda x: ~x.rlike(r"(?i)^(Tel:|email)") & ~x.rlike(r"^[\d\s\-.,;:|]{1,4}$")))
    logo = F.regexp_replace(attribute(F.regexp_extract(inner(h, "p", "company_logo"), r"(?is)<img\b[^>]*>", 0), "alt"), r"\s*Company Logo$", "")
    name = first_of(text.collapse(F.substring_index(meta(h, "property", "og:title"), "|", 1)), text.collapse(logo))
    rows = once(rows, _n=name, _d=first_of(F.array_join("_l", ", "), F.array_join(more, ", ")))
    name, address = F.col("_n"), F.col("_d")
    parts = F.transform(F.split(address, ","), lambda p: F.lower(F.regexp_replace(F.trim(p), r"^\.+|\.+$", "")))
    known = F.filter(parts, lambda p: p.isin(*BRITISH_COUNTRIES))
    named = F.create_map(*[F.lit(x) for kv in BRITISH_COUNTRIES.items() for x in kv])
    return rows.select(
        "url", name.alias("nome"), text.plain_text(inner(h, "span", "favourite_suppliers_ribbon")).alias("tipo_membro"), address.alias("endereco"), first_of(phone(own), phone(more)).alias("telefone"),
        F.coalesce(F.try_element_at("_l", F.lit(2)), F.lit("")).alias("cidade"), first_of(first(mailed_to(F.col("_at"), BRITISH_MAIL)), first(mailed_to(F.col("_xt"), BRITISH_MAIL))).alias("email"),
        first_outside(F.col("_at"), ("mrs.org.uk", "ama.uk.com")).alias("site"),
        F.coalesce(named[F.try_element_at(known, F.lit(-1))], F.lit("United Kingdom")).alias("pais"), F.left(text.collapse(meta(h, "name", "description")), F.lit(400)).alias("descricao"), _named(name, "no name").alias("erro"),
    )


def sourcebook_companies(pages: DataFrame) -> DataFrame:
    """Profiles whose place stands on the line below the name and whose site is behind a labelled button."""
    h = F.col("_h")
    rows = pages.select("url", body().alias("_h")).withColumn("_l", lines(h))
    name = first_of(text.collapse(F.substring_index(text.plain_text(inner(h, "title")), "|", 1)), text.plain_text(inner(h, "h1")))
    rows = rows.withColumn("nome", name).withColumn("_t", F.array_join("_l", "\n"))
    below = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.size("_l"), F.lit(1))), lambda i: F.struct(F.try_element_at("_l", i).alias("a"), F.try_element_at("_l", i + 1).alias("b"))), lambda x: x["a"].endswith(F.col("nome")) & F.char_length(x["b"]).between(2, 60))
    rows = rows.withColumn("_w", F.when(F.col("nome") != "", F.split(F.coalesce(F.try_element_at(below, F.lit(1))["b"], F.lit("")), r"\s*,\s*")).otherwise(F.array(F.lit(""))))
    several, last = F.size("_w") > 1, F.element_at("_w", -1)
    abroad = several & (F.length(last) > 3)
    button = F.filter(outside(h, ("quirks.com", "bluetoad.com", "fontawesome.com", "algolia.com")), lambda x: F.lower(x["label"]).rlike("website|visit site"))
    return rows.select(
        "url", "nome", F.col("_w")[0].alias("cidade"), F.when(several & ~abroad, last).otherwise("").alias("estado"), F.when(abroad, last).when(several, "United States").otherwise("").alias("pais"),
        F.left(text.collapse(F.regexp_extract("_t", r"(?s)Company Description\n(.{40,600}?)(?:\n[A-Z][^\n]{0,40}\n|\z)", 1)), F.lit(400)).alias("descricao"),
        no_query(F.coalesce(F.try_element_at(button, F.lit(1))["href"], F.lit(""))).alias("site"), _named(F.col("nome"), "no name").alias("erro"),
    )


def peruvian_members(pages: DataFrame) -> DataFrame:
    """Members by the lines of their contact block: mail and site, phones, address; what stands before them names the person and the job.

    Lines after the first contact line go on with the address when they have four
    characters. The displayed address of a mail link wins over its target.
    """
    h = F.col("_h")
    e = F.col("_e")
    boxes = F.transform(of(e, "div", "elementor-widget-text-editor"), lambda t: F.filter(of(within(e, t), "div", "elementor-widget-container"), lambda c: c["depth"] == t["depth"] + 1))
    blocks = F.transform(F.flatten(boxes), lambda c: content(F.col("html"), c))
    useful = F.filter(blocks, lambda b: (F.char_length(text.plain_text(b)) >= 15) & ~F.lower(text.plain_text(b)).rlike("|".join(PERU_NOISE)))
    rows = with_elements(pages.select("url", body().alias("html"))).select("url", first(useful).alias("_h")).withColumn("_l", broken_lines(h))
    mail, site = r"[A-Za-z0-9._%+-]+@\s?[A-Za-z0-9.-]+\.[A-Za-z]{2,}", r"(?i)^(https?://|www\.)\S+"
    phone = r"(?iu)^(t[eé]l[eé]fonos?|tel[eé]fs?|telf|central telef[oó]nica|whatsapp|fax|m[oó]vil|celular|cel)\b|^[+(]?\d[\d\s()+./\-]{6,}$"
    glued = r"(?iu)[,;.\s]*(?:t[eé]l[eé]fonos?|telf|tel)\.?\s*:?\s*(\d[\d\s()+./\-]{5,})$"
    kind = lambda x: F.when(x.rlike(mail) | x.rlike(site), "web").when(x.rlike(phone), "phone").when(x.rlike(STREETS), "street")
    rows = rows.withColumn("_k", F.transform("_l", lambda x: F.struct(kind(x).alias("k"), x.alias("x"))))
    start = F.array_position(F.transform("_k", lambda s: s["k"].isNotNull()), True)
    rows = rows.withColumn("_s", F.when(start > 0, start).otherwise(F.size("_l") + 1).cast("int"))
    head = F.slice(F.transform("_k", lambda s: s["x"]), 1, F.col("_s") - 1)
    rows = rows.withColumn("_c", head).withColumn("_f", F.slice("_k", F.col("_s"), F.size("_l") + 1))
    phones = F.flatten(F.transform("_f", lambda s: F.when(s["k"] == "phone", F.array(s["x"])).when((s["k"] == "street") & s["x"].rlike(glued), F.array(text.collapse(F.regexp_extract(s["x"], glued, 1)))).otherwise(F.array().cast("array<string>"))))
    streets = F.transform(F.filter("_f", lambda s: (s["k"] == "street") | (s["k"].isNull() & (F.char_length(s["x"]) >= 4))), lambda s: F.when(s["k"] == "street", text.collapse(F.regexp_replace(s["x"], glued, ""))).otherwise(s["x"]))
    tidy = lambda e: F.regexp_replace(F.lower(F.regexp_replace(e, r"\s+", "")), r"^[.,;:]+|[.,;:]+$", "")
    fits = lambda e: (e != "") & e.rlike(rf"(?i)^{mail}$") & ~e.rlike(NOT_MAIL) & ~F.substring_index(e, "@", -1).rlike("|".join(PERU_OWN).replace(".", r"\."))
    shown = F.transform(F.filter(links(h), lambda a: F.lower(a["href"]).startswith("mailto:")), lambda a: F.when(fits(tidy(a["label"])), tidy(a["label"])).otherwise(tidy(no_query(F.substr(a["href"], F.lit(8))))))
    written = F.transform(F.flatten(F.transform("_l", lambda x: F.regexp_extract_all(x, F.lit(mail), F.lit(0)))), tidy)
    mails = F.array_distinct(F.filter(F.concat(shown, written), fits))
    own = (*PERU_OWN, *SOCIAL, *MESSENGERS)
    linked = F.transform(outside(h, own), lambda a: no_query(a["href"]))
    typed = F.filter(F.transform("_l", lambda x: F.regexp_replace(F.regexp_extract(x, site, 0), "[.,;]+$", "")), lambda x: (x != "") & ~urls.on_list(urls.with_scheme(x), own))
    out = rows.select(
        "url", first(mails).alias("email"), F.slice(mails, 2, 3).alias("emails_extras"), first_of(first(linked), first(typed)).alias("site"), F.lit("Peru").alias("pais"),
        F.array_join(F.array_distinct(phones), " / ").alias("telefone"), F.array_join(F.array_distinct(streets), ", ").alias("endereco"), "_c", (h == "").alias("_none"),
    )
    return out


def with_person(rows: DataFrame, name: str = "nome") -> DataFrame:
    """Person, job and description out of the lines before the contact, after those that only repeat the company's name."""
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    marked = F.transform("_c", lambda x: F.coalesce(bare(x) != bare(F.col(name)), F.lit(True)))
    start = F.array_position(marked, True)
    kept = F.when(start > 0, F.slice("_c", start.cast("int"), F.size("_c") + 1)).otherwise(F.array().cast("array<string>"))
    item = lambda i: F.coalesce(F.try_element_at("_q", F.lit(i)), F.lit(""))
    lost = F.when(F.col("_none"), "no contact block").when(F.concat("email", "site", "telefone") == "", "no contact").otherwise("")
    return rows.withColumn("_q", kept).select(
        *[c for c in rows.columns if not c.startswith("_")], item(1).alias("contato"), item(2).alias("cargo"),
        F.left(text.collapse(F.array_join(F.slice("_q", 3, F.greatest(F.size("_q"), F.lit(1))), " ")), F.lit(400)).alias("descricao"), lost.alias("erro"),
    )


# --- logo walls


def logo_entries(pages: DataFrame, block: str, own: Iterable[str]) -> DataFrame:
    """Entries that are a logo with a link: the name is the picture's text, else its file's name.

    A link into a network is kept apart from the site; a name that doesn't fit its
    site's domain is marked for review. An address that a page repeats counts once.
    """
    found = pages.select(F.col("url").alias("url_perfil"), F.posexplode(F.regexp_extract_all(body(), F.lit(block), F.lit(0))).alias("ord", "_b"))
    picture = F.regexp_extract("_b", r"(?is)<img\b[^>]*>", 0)
    targets = F.transform(outside(F.col("_b"), own), lambda a: F.regexp_replace(F.regexp_extract(a["href"], "^[^?#]*", 0), "/+$", ""))
    networks = F.filter(targets, lambda u: urls.on_list(u, (*SOCIAL, *MESSENGERS)))
    sites = F.filter(targets, lambda u: ~urls.on_list(u, (*SOCIAL, *MESSENGERS)))
    src = attribute(picture, "src")
    rows = found.select(
        "url_perfil", "ord", first_of(text.collapse(attribute(picture, "alt")), text.name_of_file(src)).alias("nome"), F.regexp_extract(src, "[^/]*$", 0).alias("arquivo_logo"),
        first(sites).alias("site"), first(networks).alias("perfil_social"), first(mailed(F.col("_b"))).alias("email"),
        text.collapse(F.regexp_replace(text.plain_text(F.col("_b")), r"(?iu)visitar\s+sitio(\s+web)?", " ")).alias("descricao"),
    )
    named = F.regexp_replace(F.lower("nome"), "[^a-z0-9]", "")
    label = F.regexp_replace(F.substring_index(urls.host(F.col("site")), ".", 1), "[^a-z0-9]", "")
    fits = (F.col("site") != "") & (F.char_length(named) >= 3) & (label != "") & (F.contains(named, label) | F.contains(label, named))
    rows = rows.withColumn("revisar_nome", F.when(fits, "").otherwise("sim"))
    same = first_of(F.col("site"), F.col("perfil_social"), F.concat(F.lit("#"), F.col("ord").cast("string")))
    firsts = rows.groupBy("url_perfil", same.alias("_k")).agg(F.min_by(F.struct(*[c for c in rows.columns if c != "url_perfil"]), "ord").alias("_r"))
    return firsts.select("url_perfil", "_r.*")


def french_members(pages: DataFrame, roster: DataFrame) -> DataFrame:
    """Members of one field out of cards with a logo, each name once, and whether the full roster's cards name them too."""
    start = opening("[a-z]+", "annuaireSyntec")
    card = rf"(?is){start}(?:(?!{start}|</figure|</section|<footer).)*+"

    def cards(df: DataFrame) -> DataFrame:
        found = df.select("url", F.posexplode(F.regexp_extract_all(body(), F.lit(card), F.lit(0))).alias("ord", "_c"))
        img = F.regexp_extract("_c", r"(?is)<img\b[^>]*>", 0)
        name = first_of(text.collapse(attribute(img, "alt")), text.collapse(attribute(img, "title")))
        link = F.coalesce(F.try_element_at(links(F.col("_c")), F.lit(1))["href"], F.lit(""))
        site = F.when(urls.on_list(link, (*FRANCE_OWN, *SOCIAL)), "").otherwise(link)
        return found.select("url", "ord", name.alias("nome"), site.alias("site")).where("nome <> ''").withColumn("_k", F.upper("nome"))

    mine = cards(pages).groupBy("_k").agg(F.min_by(F.struct("url", "nome", "site"), F.struct("url", "ord")).alias("r")).select("_k", "r.*")
    listed = cards(roster).select("_k").distinct().withColumn("_in", F.lit(True))
    rows = mine.join(listed, "_k", "left")
    return rows.select(F.col("url").alias("url_perfil"), "nome", "site", F.lit("France").alias("pais"), F.when(F.col("_in"), "sim").otherwise("nao").alias("tambem_em_nos_membros"), F.when(F.col("site") == "", "no site").otherwise("").alias("erro"))


# --- registers


def award_recipients(found: DataFrame, details: DataFrame, answer: str = "body") -> DataFrame:
    """Recipients of awards: pages of a search's JSON answers, joined with the JSON of their own records by id."""
    s = found.select(F.explode(F.from_json(answer, "struct<results:array<struct<recipient_id:string,name:string,uei:string,code:string,amount:double>>>")["results"]).alias("r")).select("r.*")
    place = "struct<address_line1:string,address_line2:string,city_name:string,state_code:string,zip:string,zip5:string,country_name:string>"
    d = details.select("recipient_id", F.from_json(answer, f"struct<location:{place},business_types:array<string>,parent_name:string>").alias("d")).dropDuplicates(["recipient_id"])
    said = lambda c: F.trim(F.coalesce(c, F.lit("")))
    at = F.col("d")["location"]
    country = F.initcap(text.collapse(first_of(said(at["country_name"]), F.lit("United States"))))
    country = F.when(F.lower(country).isin("usa", "united states of america"), "United States").when(F.lower(country) == "uk", "United Kingdom").otherwise(country)
    rows = s.join(d, "recipient_id", "left")
    return rows.select(
        said(F.col("recipient_id")).alias("recipient_id"), said(F.col("name")).alias("nome"), said(F.col("uei")).alias("uei"), said(F.col("code")).alias("duns"), F.coalesce("amount", F.lit(0.0)).alias("valor_total"),
        F.trim(F.concat_ws(" ", F.nullif(at["address_line1"], F.lit("")), F.nullif(at["address_line2"], F.lit("")))).alias("endereco"), said(at["city_name"]).alias("cidade"), said(at["state_code"]).alias("estado"),
        first_of(said(at["zip"]), said(at["zip5"])).alias("cep"), country.alias("pais"), F.concat_ws(" | ", F.col("d")["business_types"]).alias("tipos_negocio"), said(F.col("d")["parent_name"]).alias("matriz"),
        F.when(said(F.col("recipient_id")) == "", "no recipient_id").otherwise("").alias("erro"),
    )


def site_enrichment(companies: DataFrame, pages: DataFrame, key: str, free: Iterable[str], paths: Iterable[str] = ("", "/contato", "/contato/", "/fale-conosco", "/contact", "/sobre")) -> DataFrame:
    """A site and an address for (key, razao, fantasia, email) out of landed pages.

    Candidates are the domain of the company's own address, then guesses from its
    names, the longest first. A guess counts only where its first page has a word of
    the trade and the name. Addresses are those of the first path that has any.
    Companies without a site stay, with ``origem_site`` ``not found``.
    """
    domain = contact.domain_of(F.col("email"))
    own = F.when((domain != "") & ~domain.isin(*free) & ~F.contains(domain, F.lit("contab")), F.array(F.struct(domain.alias("d"), F.lit("own address").alias("o")))).otherwise(F.from_json(F.lit("[]"), "array<struct<d:string,o:string>>"))
    longest = lambda c: F.transform(F.array_sort(F.transform(text.domain_guesses(c), lambda g: F.struct((-F.length(g)).alias("n"), g.alias("g")))), lambda x: F.struct(x["g"].alias("d"), F.lit("guess").alias("o")))
    tried = companies.select(key, first_of(text.squeeze_key(F.col("fantasia")), text.squeeze_key(F.col("razao"))).alias("_s"), F.posexplode(F.concat(own, longest(F.col("fantasia")), longest(F.col("razao")))).alias("_at", "_c"))
    tried = tried.select(key, "_s", "_at", F.col("_c.d").alias("_d"), F.col("_c.o").alias("origem_site")).where("_d <> ''")
    order = F.array(*[F.lit(p) for p in paths])
    landed = pages.select(urls.host(F.col("url")).alias("_d"), body().alias("_h"), (F.array_position(order, urls.path(F.col("url"))) - 1).alias("_p")).where("_p >= 0")
    home = landed.where("_p = 0").groupBy("_d").agg(F.min("_h").alias("_home"))
    met = tried.join(home, "_d")
    sure = site_confirmed(text.plain_text(F.col("_home")), F.col("_s"))
    right = met.withColumn("confirmado", (F.col("origem_site") == "own address") | sure).where("confirmado")
    best = right.groupBy(key).agg(F.min_by(F.struct("_d", "origem_site", "confirmado"), "_at").alias("_r")).select(key, "_r.*")
    mails = landed.select("_d", "_p", contact.useful(contact.found_in(F.col("_h")), F.col("_d"), ("comercial", "contato", "vendas", "atendimento", "sac", "novosnegocios", "hello", "info", "contact")).alias("_m")).where("size(_m) > 0")
    mails = mails.groupBy("_d").agg(F.min_by("_m", "_p").alias("emails_site"))
    rows = companies.select(key).join(best, key, "left").join(mails, "_d", "left")
    return rows.select(
        key, F.coalesce(F.concat(F.lit("https://"), "_d"), F.lit("")).alias("site"), F.coalesce("origem_site", F.lit("not found")).alias("origem_site"), F.coalesce("confirmado", F.lit(False)).alias("confirmado"),
        first(F.col("emails_site")).alias("email_comercial"),
    )

