"""Member records of national associations whose pages nest: blocks, columns and labelled text, one record a page.

Every reader takes (url, html) and gives one row a page. A page without the block
that makes a record keeps its row with ``erro``. What a site fixes stands at the top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text, urls
from millrace.sources.directories import attribute, body, first, first_of, lines, no_query
from millrace.sources.elements import content, cut, has_class, links_in, of, once, one, said, with_elements, within

#: Domains of the associations themselves, words of streets, labels.
GERMAN_OWN = ("adm-ev.de", "rat-marktforschung.de", "deutschlands-marktforscher.de", "cleverreach.com")
GERMAN_STREETS = r"(?iu)(stra(ss|ß)e|str\.|weg|platz|allee|ring|damm|gasse|ufer)"
GERMAN_FACTS = {"ano_fundacao": ("gründungsjahr",), "direcao": ("geschäftsführung",), "associacoes": ("mitgliedschaften",), "funcionarios": ("festangestellte mitarbeiter*innen", "festangestellte mitarbeiter")}
GERMAN_COLUMNS = {"unidades": "standorte", "metodos": "methoden", "setores": "branchen", "temas": "themen"}
ITALIAN_OWN = ("assirm.it",)
ITALIAN_PHONES = ("390258315750", "0258315750")
ITALIAN_LABELS = {"telefone": ("telefono", "tel"), "fax": ("fax",), "email": ("email", "e-mail", "mail")}
ADDRESS = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def german_institutes(pages: DataFrame) -> DataFrame:
    """Institutes by their contact list, facts and columns, each read inside its own block.

    A first address line that is neither a number nor a street is the company's own
    name. A link whose label or target is a mail address is one, whatever its scheme.
    Of repeated facts the last counts, of repeated items in a column the first.
    """
    h, e = F.col("_h"), F.col("_e")
    rows = with_elements(pages.select("url", body().alias("_h")), "_h")
    rows = once(rows, _n=said(h, one(within(e, one(e, cls="block-member-title")), "h1")), _c=one(e, "ul", "contact"))
    rows = once(rows, _in=within(e, F.col("_c")))
    rows = once(rows, _l=lines(content(h, one(F.col("_in"), "li", "contact__address"))), _a=links_in(h, F.col("_in")))
    head = _text(F.try_element_at("_l", F.lit(1)))
    named = (F.size("_l") > 2) & ~head.rlike(r"^\d") & ~head.rlike(GERMAN_STREETS)
    rows = once(rows, _own=F.when(named, head).otherwise(""), _r=F.when(named, F.slice("_l", 2, F.size("_l"))).otherwise(F.col("_l"))).drop("_l").withColumnRenamed("_r", "_l")
    place = r"^(\d{5})\s+(.+)$"
    town = _text(F.try_element_at(F.filter("_l", lambda x: x.rlike(place)), F.lit(-1)))
    own = lambda c: F.lower(c).rlike("|".join(GERMAN_OWN).replace(".", r"\."))

    # step by step, since inside a lambda whatever is named twice is worked out twice
    bare = lambda a: F.struct(a["href"].alias("href"), a["label"].alias("label"), F.regexp_replace(F.regexp_replace(a["href"], r"(?i)^[a-z]+://", ""), "/+$", "").alias("bare"))
    to = lambda a: F.when(F.lower(a["href"]).startswith("mailto:"), F.trim(no_query(F.substr(a["href"], F.lit(8))))).otherwise("")
    mail = lambda a: F.struct(a["href"].alias("href"), a["label"].alias("label"), first_of(to(a), F.when(a["label"].rlike(f"^{ADDRESS}$"), a["label"]), F.when(a["bare"].rlike(f"^{ADDRESS}$"), a["bare"])).alias("mail"))
    site = lambda a: F.lower(a["href"]).startswith("http") & ~urls.on_list(a["href"], GERMAN_OWN)
    kind = lambda a: F.struct(a.alias("a"), F.when(F.lower(a["href"]).startswith("tel:"), "tel").when(a["mail"] != "", F.when(own(a["mail"]), "none").otherwise("mail")).when(site(a), "site").alias("k"))
    value = lambda x: F.when(x["k"] == "tel", first_of(x["a"]["label"], F.substr(x["a"]["href"], F.lit(5)))).when(x["k"] == "mail", x["a"]["mail"]).otherwise(x["a"]["href"])
    judged = F.transform(F.transform(F.transform(F.transform("_a", bare), mail), kind), lambda x: F.struct(x["k"].alias("k"), value(x).alias("v")))
    rows = once(rows, _j=judged)
    of_kind = lambda k: _text(F.try_element_at(F.filter("_j", lambda x: (x["k"] == k) & (x["v"] != "")), F.lit(1))["v"])
    items = F.flatten(F.transform(of(e, cls="block-member-facts"), lambda b: of(within(e, b), cls="facts__item")))
    fact = lambda i: F.struct(F.lower(F.regexp_replace(said(h, one(within(e, i), cls="facts__description")), ":+$", "")).alias("k"), said(h, one(within(e, i), cls="facts__text")).alias("v"))
    columns = F.flatten(F.transform(of(e, cls="block-member-attributes"), lambda b: of(within(e, b), cls="attributes__column")))
    title = lambda c: F.lower(said(h, F.try_element_at(F.filter(within(e, c), lambda x: x["tag"].isin("h2", "h3")), F.lit(1))))
    listed = lambda c: F.filter(F.array_distinct(F.transform(of(within(e, c), "li"), lambda i: said(h, i))), lambda x: x != "")
    rows = once(rows, _f=F.transform(items, fact), _k=F.transform(columns, lambda c: F.struct(title(c).alias("k"), listed(c).alias("v"))))
    facts = lambda labels: first_of(*[_text(F.try_element_at(F.filter("_f", lambda x: x["k"] == n), F.lit(-1))["v"]) for n in labels])
    column = lambda label: _text(F.array_join(F.try_element_at(F.filter("_k", lambda x: (x["k"] == label) & (F.size(x["v"]) > 0)), F.lit(-1))["v"], " | "))
    name = first_of(F.col("_n"), F.when(F.col("_c").isNotNull(), F.col("_own")))
    profile = F.regexp_replace(said(h, one(e, cls="block-member-profile")), r"^Profil\s*", "")
    there = F.col("_c").isNotNull()
    return rows.select(
        "url", name.alias("nome"), F.array_join("_l", ", ").alias("endereco"), F.regexp_extract(town, place, 1).alias("cep"), F.regexp_extract(town, place, 2).alias("cidade"),
        of_kind("tel").alias("telefone"), of_kind("mail").alias("email"), of_kind("site").alias("site"), F.when(there, F.left(profile, F.lit(1200))).otherwise("").alias("descricao"),
        *[F.when(there, facts(v)).otherwise("").alias(k) for k, v in GERMAN_FACTS.items()], *[F.when(there, column(v)).otherwise("").alias(k) for k, v in GERMAN_COLUMNS.items()],
        F.when(~there, "no contact block").when(name == "", "no name").otherwise("").alias("erro"),
    )


def italian_associates(pages: DataFrame) -> DataFrame:
    """Associates by an information block and a text cut by headings.

    The contact paragraph is the first with a contact label; its labels come in any
    order, may repeat (the first value counts) or be missing, and what stands before
    the first one is the address. Other offices stand between their own heading and
    the company's data, each once. The description is cut at its headings wherever
    they are nested.
    """
    h, e = F.col("_h"), F.col("_e")
    rows = with_elements(pages.select("url", body().alias("_h")), "_h").withColumn("_b", one(e, "div", "info-istituto")).withColumn("_in", within(e, F.col("_b")))
    titles = F.flatten(F.transform(of(e, "article"), lambda a: of(within(e, a), "h1")))
    titled = lambda cls: said(h, F.try_element_at(F.filter(titles, lambda t: has_class(t, cls)), F.lit(1)))
    short, legal = titled("hideDesktopTitle"), titled("hideMobileTitle")
    name = first_of(short, said(h, F.try_element_at(titles, F.lit(1))), legal)

    # the contact paragraph, and its values by label
    labels = [x for xs in ITALIAN_LABELS.values() for x in xs]
    mark = rf"(?i)^\s*({'|'.join(labels)})\s*:"
    strong = lambda p: F.exists(of(within(e, p), "strong"), lambda s: said(h, s).rlike(mark))
    rows = rows.withColumn("_p", F.try_element_at(F.filter(of(F.col("_in"), "p"), strong), F.lit(1)))
    broken = F.split(F.regexp_replace(F.regexp_replace(content(h, F.col("_p")), r"\s+", " "), r"(?i)<br\b[^>]*>", "\n"), "\n")
    rows = rows.withColumn("_l", F.filter(F.transform(broken, lambda x: text.plain_text(F.regexp_replace(x, "<[^>]*>", ""))), lambda x: x != ""))
    regions = F.flatten(F.transform(F.filter("_l", lambda x: x.rlike(mark)), lambda x: text.label_regions(x, labels)))
    rows = rows.withColumn("_r", regions)
    value = lambda names: _text(F.try_element_at(F.filter("_r", lambda r: r["label"].isin(*names) & (r["value"] != "")), F.lit(1))["value"])
    address = _text(F.try_element_at(F.filter("_l", lambda x: ~x.rlike(mark)), F.lit(1)))
    inside = within(e, F.col("_p"))
    hidden = attribute(_text(one(inside, cls="__cf_email__")["head"]), "data-cfemail")
    to = first(F.filter(F.transform(links_in(h, inside), lambda a: a["href"]), lambda x: F.lower(x).startswith("mailto:")))
    written = value(ITALIAN_LABELS["email"])
    mail = first_of(F.when(written.rlike(f"^{ADDRESS}$"), written), F.when(hidden != "", text.xor_hex(hidden)), no_query(F.substr(to, F.lit(8))))
    ours = lambda m: F.lower(m).endswith("@assirm.it")
    phone = value(ITALIAN_LABELS["telefone"])

    # other offices: the paragraphs beside the heading's, up to the company's data
    start = F.try_element_at(F.filter(of(F.col("_in"), "p"), lambda p: F.exists(of(within(e, p), "strong"), lambda s: said(h, s).rlike(r"(?i)^\s*Altre sedi"))), F.lit(-1))
    rows = rows.withColumn("_s", start)
    beside = F.filter(of(F.col("_in"), "p"), lambda p: (p["start"] >= F.col("_s")["stop"]) & (p["depth"] == F.col("_s")["depth"]))
    end = r"(?i)Fondata nel|Capitale Sociale"
    offices = F.coalesce(F.transform(beside, lambda p: said(h, p)), F.array().cast("array<string>"))
    last = F.array_position(F.transform(offices, lambda x: x.rlike(end)), True)
    taken = F.when(last > 0, F.slice(offices, 1, last.cast("int"))).otherwise(offices)
    sites = F.array_distinct(F.filter(F.transform(taken, lambda x: F.trim(F.split(x, end, 2)[0])), lambda x: x != ""))

    running = F.array_join(lines(content(h, F.col("_b"))), "\n")
    linked = F.filter(links_in(h, F.col("_in")), lambda a: a["href"].startswith("http") & ~urls.on_list(a["href"], ITALIAN_OWN))
    typed = F.regexp_extract("_t", r"(?<![@\w.])(www\.[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?:/\S*)?)", 1)
    site = first_of(F.try_element_at(linked, F.lit(1))["href"], F.when((typed != "") & ~F.contains(typed, F.lit(ITALIAN_OWN[0])), F.concat(F.lit("https://"), typed)))

    # the description: text between headings, wherever these are nested
    rows = rows.withColumn("_t", running).withColumn("_d", one(e, "div", "desc-istituti"))
    heads = F.filter(within(e, F.col("_d")), lambda x: x["tag"].isin("h2", "h3", "h4"))
    rows = rows.withColumn("_g", heads)
    gap = lambda a, b: lines(F.regexp_replace(cut(h, a, b), r"(?is)<h1\b[^>]*>.*?</h1\s*>", " "))
    upto = lambda i: F.coalesce(F.get("_g", i)["start"], F.col("_d")["close"])
    parts = F.transform("_g", lambda g, i: F.struct(F.lower(said(h, g)).alias("k"), gap(g["stop"], upto(i + 1)).alias("v")))
    rows = rows.withColumn("_q", parts)
    section = lambda key: _text(F.array_join(F.try_element_at(F.filter("_q", lambda q: F.contains(q["k"], F.lit(key))), F.lit(1))["v"], " | "))
    mails = F.array_distinct(F.transform(F.regexp_extract_all("_t", F.lit(ADDRESS), F.lit(0)), F.lower))
    rows = rows.withColumn("_m", F.when(ours(mail), "").otherwise(mail))
    there = F.col("_b").isNotNull()
    fact = lambda pattern: text.collapse(F.regexp_extract("_t", pattern, 1))
    town = r"(\d{5})\s+([^\d,;]{2,40})$"
    return rows.select(
        "url", name.alias("nome"), legal.alias("razao_social"), address.alias("endereco"), F.regexp_extract(address, town, 1).alias("cap"), F.trim(F.regexp_extract(address, town, 2)).alias("cidade"),
        F.when(F.regexp_replace(phone, r"\D", "").isin(*ITALIAN_PHONES), "").otherwise(phone).alias("telefone"), value(ITALIAN_LABELS["fax"]).alias("fax"), F.col("_m").alias("email"),
        F.slice(F.filter(mails, lambda m: (m != F.lower("_m")) & ~ours(m)), 1, 3).alias("emails_extras"), site.alias("site"), F.left(F.array_join(sites, " | "), F.lit(500)).alias("outras_sedes"),
        fact(r"(?i)Attestato n\.?\s*\n?([^\n]+)").alias("attestato"), fact(r"(?i)Fondata nel\s*([0-9]{4})").alias("fundacao"), fact(r"(?i)Capitale Sociale\s*([^\n]*\d[^\n]*?)\s*i\.v\.").alias("capital_social"),
        F.left(F.array_join(gap(F.col("_d")["open"], upto(F.lit(0))), " "), F.lit(900)).alias("descricao"), F.left(section("gruppo dirigente"), F.lit(400)).alias("gruppo_dirigente"), F.left(section("specializzazioni"), F.lit(600)).alias("especializacoes"),
        F.when(~there, "no information block").when(name == "", "no name").otherwise("").alias("erro"),
    )
