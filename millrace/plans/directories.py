"""Directory, event and register pages of each site's form, made from the driver's tables, and the records they give."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.session import table
from millrace.sources import associations, directories, elements, events

FREE = ("gmail.com", "hotmail.com", "outlook.com", "yahoo.com")


def _filled(template: str, **columns: Column) -> Column:
    """A page's markup with ``{name}`` places filled from columns."""
    values = {k: v.cast("string") for k, v in columns.items()}
    return reduce(lambda out, kv: F.replace(out, F.lit("{" + kv[0] + "}"), F.coalesce(kv[1], F.lit(""))), values.items(), F.lit(template))


def _customers(spark, sf_dir):
    """The customers, dealt out by key: a page costs far more than the bytes of its row tell, so the number of tasks isn't left to the sizes."""
    return table(spark, sf_dir, "customer").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")


def _pages(spark, sf_dir, template: Column | str, **more: Column):
    """(url, html): one page a customer. ``{k}``: its key, ``{n}``: its name, ``{s}``: its segment."""
    c = _customers(spark, sf_dir)
    places = {"k": F.col("c_custkey"), "n": F.col("c_name"), "s": F.col("c_mktsegment"), **more}
    html = _filled(template, **places)
    return c.select(F.concat(F.lit("https://x/"), F.col("c_custkey").cast("string")).alias("url"), html.alias("html"))


#: Customers, by key, of which one page of a wall shows those of a nation.
WALL = 1000


def _walls(customers, card: Column, letter: str, head: str = "", between: str = ""):
    """(url, html): walls of cards in the order of keys, several pages a nation under its one address, so that a page doesn't grow with the table."""
    lot = F.floor(F.col("c_custkey") / WALL)
    dealt = customers.select("c_nationkey", lot.alias("lot"), "c_custkey", card.alias("b")).repartition(int(customers.sparkSession.conf.get("spark.sql.shuffle.partitions")), "c_nationkey", "lot")
    cards = F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "b"))), lambda x: x["b"])
    pages = dealt.groupBy("c_nationkey", "lot").agg(F.concat(F.lit(head), F.array_join(cards, between)).alias("html"))
    return pages.select(F.concat(F.lit(f"https://{letter}/"), F.col("c_nationkey").cast("string")).alias("url"), "html")


def _when(every: int, rest: int, value: str, other: str = "") -> Column:
    return F.when(F.col("c_custkey") % every == rest, value).otherwise(other)


@query("""SELECT 'https://x/' || k AS url, CASE WHEN k % 7 = 0 THEN '' ELSE n END AS nome, CASE WHEN k % 7 = 0 THEN '' WHEN k % 3 = 0 THEN 'ab@c.de' ELSE 'c' || k || '@x.com.br' END AS email, CASE WHEN k % 7 = 0 THEN '' ELSE 's' || k || '.br' END AS site, 'Brazil' AS pais,
CASE WHEN k % 7 = 0 THEN '' ELSE s END AS tipo_empresa, CASE WHEN k % 7 = 0 THEN '' ELSE 'Rua & ' || k || ', Recife PE' END AS endereco, '' AS telefone, CASE WHEN k % 7 = 0 THEN '' ELSE 'A B' END AS campos_atuacao, '' AS metodos_tecnicas, '' AS outros_servicos,
CASE WHEN k % 7 = 0 THEN 'no text block' ELSE '' END AS erro, CASE WHEN k % 7 = 0 THEN '' ELSE 'PE' END AS uf FROM (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s FROM customer)""")
def brazilian_directory(spark, sf_dir):
    """Label paragraphs, hidden addresses, states."""
    mail = F.when(F.col("c_custkey") % 3 == 0, '<a class="__cf_email__" data-cfemail="42232002216c2627">[hidden]</a>').otherwise(F.concat(F.lit('<a href="mailto:c'), F.col("c_custkey").cast("string"), F.lit('@x.com.br?subject=a">write</a>')))
    html = (
        '<div class="{box} wide"><h3> {n}\n</h3><p><b>Tipo de empresa:</b> {s}</p><p><b>E-mail:</b> {mail}</p><p><b>Site</b> <a href="http://www.s{k}.br/?a">s{k}.br</a></p><p>no label</p>'
        "<p><b>Endereço:</b> Rua &amp; {k},  Recife PE</p><p><b>Telefone:</b> N/A</p><p><b>Campos de atuação:</b> old</p><p><b>Campos de Atuação:</b> A <i>B</i></p></div>"
    )
    return directories.brazilian_members(_pages(spark, sf_dir, html, mail=mail, box=_when(7, 0, "other", "area-texto")))


@query("""SELECT 'https://x/' || k AS url, n AS nome, CASE WHEN k % 3 = 0 THEN '+1 5' ELSE '' END AS telefone, CASE WHEN k % 3 = 0 THEN 'a, b' ELSE '' END AS servicos, CASE WHEN k % 3 = 0 THEN 'Canada' WHEN k % 3 = 1 THEN 'Peru' ELSE 'Japan' END AS pais,
CASE WHEN k % 3 = 0 THEN 'QC' ELSE '' END AS regiao, '' AS cidade, CASE WHEN k % 3 = 0 THEN k || ' Main, QC, Canada' ELSE '' END AS endereco, CASE WHEN k % 3 < 2 THEN 'Panels' ELSE '' END AS categoria, 'About "' || s || '"' AS descricao,
'https://www.linkedin.com/company/c' || k AS linkedin, 'https://c' || k || '.com/p?id=1' AS site, '' AS erro FROM (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s FROM customer)""")
def global_directory(spark, sf_dir):
    """JSON-LD, alone or in a list, else the title's forms; tracking keys go."""
    record = '{"@type": "Corporation", "name": "{n}", "telephone": "+1 5", "keywords": "a, b", "address": {"streetAddress": "{k} Main", "addressRegion": "QC", "addressCountry": "Canada"}}'
    json = F.when(F.col("c_custkey") % 6 == 0, record).when(F.col("c_custkey") % 6 == 3, '[{"@type": "WebSite", "name": "x"}, ' + record + "]").otherwise('{"@type": "WebSite", "name": "no"}')
    title = F.when(F.col("c_custkey") % 3 == 0, "{n} | Panels from Chile | Book").when(F.col("c_custkey") % 3 == 1, "{n} | Panels, Peru | Book").otherwise("{n} | Japan | Book")
    html = (
        '<title>{title}</title><meta name="description" content="About &quot;{s}&quot; "><script type="application/ld+json">{json}</script><a href="/in">in</a><a href="https://www.linkedin.com/company/c{k}?trk=1">l</a>'
        '<a href="https://www.greenbook.org/z">g</a><a class="b" href="https://c{k}.com/p?utm_source=g&amp;id=1&amp;ref=2">site</a>'
    )
    c = _customers(spark, sf_dir)
    page = _filled(html, title=title, json=json)
    for name, column in (("n", "c_name"), ("k", "c_custkey"), ("s", "c_mktsegment")):
        page = F.replace(page, F.lit("{" + name + "}"), F.col(column).cast("string"))
    rows = directories.global_companies(c.select(F.concat(F.lit("https://x/"), F.col("c_custkey").cast("string")).alias("url"), page.alias("html")))
    return rows.withColumn("descricao", F.replace("descricao", F.lit("&quot;"), F.lit('"')))


@query("""SELECT 'https://x/' || k AS url, 'Firm ' || lower(s) AS nome, CASE WHEN k % 4 = 1 THEN '' ELSE 'a' || k || '@c.es' END AS email, CASE WHEN k % 4 = 1 THEN []::VARCHAR[] ELSE ['b@c.es'] END AS emails_extras, 'https://c' || k || '.es/' AS site, 'Spain' AS pais,
'Studies of markets and of the people in them: ' || lower(s) AS descricao, 'AEDEMO' AS associacoes, '+34 91 123 45 67' AS telefone, '' AS erro FROM (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s FROM customer) WHERE k % 4 > 0""")
def spanish_directory(spark, sf_dir):
    """Only company pages, without what the association puts on each."""
    mail = F.when(F.col("c_custkey") % 4 != 1, F.concat(F.lit('<a href="mailto:A'), F.col("c_custkey").cast("string"), F.lit('@c.es?x">m</a><a href="mailto:b@c.es">m</a>'))).otherwise("")
    html = (
        '<title>Firm {s} - Insights + Analytics España</title><a href="https://ia-espana.org/x">home</a><a href="mailto:info@ia-espana.org">i</a><img src="l@2x.png"><script>{k}</script>'
        "{lead}<p>Studies of markets and of the people in them: {s}</p><p>Miembro de{colon}</p><p>AEDEMO</p><p>Sede:</p><p>Tel +34 91 123 45 67</p>{mail}<a href=\"https://www.linkedin.com/x\">l</a><a href=\"https://c{k}.es/?utm=1\">web</a>"
    )
    shop = lambda a, b: F.when(F.col("c_custkey") % 4 == 0, b).otherwise(a)
    return directories.spanish_members(_pages(spark, sf_dir, html, mail=mail, lead=shop("<p>Especialización:</p>", ""), colon=shop(":", ""), s=F.lower("c_mktsegment")))


@query("""SELECT 'https://x/' || k AS url, n AS nome, 'Gold' AS tipo_membro, k || ' High Street, London, ' || CASE k % 3 WHEN 0 THEN 'Republic of Ireland' WHEN 1 THEN 'SW1' ELSE 'USA.' END AS endereco, '020 7' AS telefone, 'London' AS cidade,
CASE WHEN k % 2 = 0 THEN 'own@c.uk' ELSE 'more@c.uk' END AS email, 'https://c.uk/' || k AS site, CASE k % 3 WHEN 0 THEN 'Ireland' WHEN 1 THEN 'United Kingdom' ELSE 'United States' END AS pais, s AS descricao, '' AS erro FROM (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s FROM customer)""")
def british_directory(spark, sf_dir):
    """Address blocks, not the publisher's microdata; further addresses fill gaps."""
    place = F.when(F.col("c_custkey") % 3 == 0, "Republic of Ireland").when(F.col("c_custkey") % 3 == 1, "SW1").otherwise("USA.")
    html = (
        '<meta property="og:title" content="{n} | Guide"><meta name="description" content="{s}"><span class="favourite_suppliers_ribbon">Gold</span><p itemprop="telephone">1</p>'
        '<p class="address_block">{k} High Street<br>London<br/>{place}<br>| 2<br>{tel}<br>Email: <a href="mailto:info@mrs.org.uk">m</a> {mail}<br><a href="https://www.mrs.org.uk/a"></a><a href="https://c.uk/{k}?a=b"></a></p>'
        '<div id="rbg_addresses">Tel: 020 7<br><a href="mailto:more@c.uk">m</a></div>'
    )
    return directories.british_suppliers(_pages(spark, sf_dir, html, place=place, mail=_when(2, 0, '<a href="mailto:OWN@c.uk">m</a>'), tel=_when(2, 1, "Tel: 020 7")))


@query("""SELECT 'https://x/' || k AS url, n AS nome, 'Reno' AS cidade, CASE WHEN k % 3 = 0 THEN 'NV' ELSE '' END AS estado, CASE k % 3 WHEN 0 THEN 'United States' WHEN 1 THEN 'France' ELSE '' END AS pais,
'We do all kinds of research for all kinds of people in ' || s AS descricao, CASE WHEN k % 2 = 0 THEN 'https://c.com/' || k ELSE '' END AS site, '' AS erro FROM (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s FROM customer)""")
def sourcebook_directory(spark, sf_dir):
    """A place below the name, a site behind a button."""
    place = F.when(F.col("c_custkey") % 3 == 0, "Reno, NV").when(F.col("c_custkey") % 3 == 1, "Reno, France").otherwise("Reno")
    html = '<title>{n} | Book</title><h1>{n}</h1><div>{place}</div><a href="https://bluetoad.com/">Website of the magazine</a><h2>Company Description</h2><p>We do all kinds of research for all kinds of people in {s}</p><h3>Services</h3><a href="https://c.com/{k}?u=1">{label}</a>'
    return directories.sourcebook_companies(_pages(spark, sf_dir, html, place=place, label=_when(2, 0, "View Website", "Brochure")))


@query("""SELECT 'https://x/' || k AS url, n AS nome, 'now' || k || '@c.pe' AS email, ['two@c.pe'] AS emails_extras, 'https://c.pe/' || k AS site, 'Peru' AS pais, '(51) 1 234567 / 765 4321' AS telefone, 'Av. Lima ' || k || ', San Isidro' AS endereco,
'Ana ' || s AS contato, 'Gerente' AS cargo, 'more of it' AS descricao, '' AS erro FROM (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s FROM customer)""")
def peruvian_directory(spark, sf_dir):
    """Lines of a contact block sorted into mail, site, phone, address and person."""
    html = (
        '<div class="elementor-widget-text-editor"><div class="elementor-widget-container">Inicio of the whole site</div></div><div class="w elementor-widget-text-editor"> <div class="elementor-widget-container">'
        '<p>{n}<br>Ana {s}<br>Gerente<br>more of it</p><p><a href="mailto:old@c.pe">now{k}@ c.pe</a><br>two@c.pe<br><a href="https://facebook.com/c"></a><a href="https://c.pe/{k}?a">www.c.pe</a></p><p>(51) 1 234567<br>Av. Lima {k}, Telf: 765 4321<br>San Isidro<br>abc</p></div></div>'
    )
    pages = _pages(spark, sf_dir, html)
    names = table(spark, sf_dir, "customer").select(F.concat(F.lit("https://x/"), F.col("c_custkey").cast("string")).alias("url"), F.col("c_name").alias("nome"))
    return directories.with_person(directories.peruvian_members(pages).join(names, "url"))


@query("""WITH c AS (SELECT c_nationkey AS g, c_custkey AS k FROM customer), e AS (SELECT g, k, row_number() OVER (PARTITION BY g ORDER BY k) - 1 AS r FROM c)
SELECT 'https://w/' || g AS url_perfil, CASE WHEN k % 3 = 0 THEN 'Alpha ' || k ELSE 'Acme' END AS nome, 'logo-acme-' || k || '.png' AS arquivo_logo, CASE WHEN k % 4 = 0 THEN '' ELSE 'https://www.acme' || k || '.com.co' END AS site,
CASE WHEN k % 4 = 0 THEN 'https://facebook.com/acme' || k ELSE '' END AS perfil_social, '' AS email, 'Text ' || k AS descricao, CASE WHEN k % 3 = 0 OR k % 4 = 0 THEN 'sim' ELSE '' END AS revisar_nome FROM e""")
def logo_wall(spark, sf_dir):
    """Logos with links, names out of file names, networks apart; a page's repeated entry once."""
    k = F.col("c_custkey").cast("string")
    link = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("https://facebook.com/acme"), k)).otherwise(F.concat(F.lit("https://www.acme"), k, F.lit(".com.co/?utm=1#a")))
    alt = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("Alpha "), k)).otherwise("")
    box = _filled('<div class="logo"><img src="/i/logo-acme-{k}.png" alt="{alt}">Text {k} <a href="{link}">Visitar sitio Web</a></div>', k=F.col("c_custkey"), alt=alt, link=link)
    pages = _walls(table(spark, sf_dir, "customer"), F.concat(box, box), "w")
    rows = directories.logo_entries(pages, r'(?is)<div class="logo">.*?</div>', ("acei.co",))
    return rows.select("url_perfil", "nome", "arquivo_logo", "site", "perfil_social", "email", "descricao", "revisar_nome")


@query("""SELECT 'https://f/' || c_nationkey AS url_perfil, c_name AS nome, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'https://c' || c_custkey || '.fr' END AS site, 'France' AS pais, CASE WHEN c_custkey % 3 = 0 THEN 'nao' ELSE 'sim' END AS tambem_em_nos_membros,
CASE WHEN c_custkey % 4 = 0 THEN 'no site' ELSE '' END AS erro FROM customer""")
def french_directory(spark, sf_dir):
    """Cards of one field against the full roster."""
    link = F.when(F.col("c_custkey") % 4 == 0, "https://www.syntec.fr/x").otherwise(F.concat(F.lit("https://c"), F.col("c_custkey").cast("string"), F.lit(".fr")))
    card = _filled('<figure class="a annuaireSyntec"><a href="{l}"><img src="x" {attr}="{n}"></a></figure>', l=link, n=F.col("c_name"), attr=_when(2, 0, "alt", "title"))
    c = table(spark, sf_dir, "customer")
    roster = _walls(c.where("c_custkey % 3 <> 0"), F.replace(card, F.col("c_name"), F.upper("c_name")), "f", between="\n")
    return directories.french_members(_walls(c, card, "f", between="\n"), roster)


@query("""SELECT 'r' || c_custkey AS recipient_id, c_name AS nome, 'U' || c_custkey AS uei, '' AS duns, c_acctbal AS valor_total, CASE WHEN c_custkey % 3 > 0 THEN '1 Main Suite 2' ELSE '' END AS endereco, CASE WHEN c_custkey % 3 > 0 THEN 'Reno' ELSE '' END AS cidade,
CASE WHEN c_custkey % 3 > 0 THEN 'NV' ELSE '' END AS estado, CASE WHEN c_custkey % 3 > 0 THEN '89501' ELSE '' END AS cep, CASE WHEN c_custkey % 3 = 2 THEN 'South Korea' ELSE 'United States' END AS pais, CASE WHEN c_custkey % 3 > 0 THEN 'a | b' ELSE '' END AS tipos_negocio,
CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '' END AS matriz, '' AS erro FROM customer""")
def award_register(spark, sf_dir):
    """Pages of a search's answers and the recipients' own records, by id."""
    c = table(spark, sf_dir, "customer")
    result = F.struct(F.concat(F.lit("r"), F.col("c_custkey").cast("string")).alias("recipient_id"), F.col("c_name").alias("name"), F.concat(F.lit(" U"), F.col("c_custkey").cast("string")).alias("uei"), F.lit(None).cast("string").alias("code"), F.col("c_acctbal").alias("amount"))
    found = c.groupBy(F.floor(F.col("c_custkey") / 100)).agg(F.to_json(F.struct(F.collect_list(result).alias("results"))).alias("body"))
    land = F.when(F.col("c_custkey") % 3 == 1, "UNITED STATES OF AMERICA").otherwise("SOUTH  KOREA")
    place = F.struct(F.lit("1 Main").alias("address_line1"), F.lit("Suite 2").alias("address_line2"), F.lit("Reno ").alias("city_name"), F.lit("NV").alias("state_code"), F.lit("89501").alias("zip5"), land.alias("country_name"))
    own = c.where("c_custkey % 3 > 0").select(F.concat(F.lit("r"), F.col("c_custkey").cast("string")).alias("recipient_id"), F.to_json(F.struct(place.alias("location"), F.array(F.lit("a"), F.lit("b")).alias("business_types"), F.col("c_mktsegment").alias("parent_name"))).alias("body"))
    return directories.award_recipients(found, own)


@query("""SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'https://own' || c_custkey || '.com' WHEN 1 THEN 'https://acme' || c_custkey || 'a.com.br' ELSE '' END AS site, CASE c_custkey % 4 WHEN 0 THEN 'own address' WHEN 1 THEN 'guess' ELSE 'not found' END AS origem_site,
c_custkey % 4 < 2 AS confirmado, CASE c_custkey % 4 WHEN 0 THEN 'info@own' || c_custkey || '.com' WHEN 1 THEN 'contato@acme' || c_custkey || 'a.com.br' ELSE '' END AS email_comercial FROM customer""")
def site_enrichment(spark, sf_dir):
    """Own domains, confirmed guesses, guesses that their page doesn't confirm, and none."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    case = F.col("c_custkey") % 4
    companies = c.select(F.col("c_custkey").alias("k"), F.concat(F.lit("Acme"), k, F.lit("a Ltda")).alias("razao"), F.lit("").alias("fantasia"), F.when(case == 0, F.concat(F.lit("me@own"), k, F.lit(".com"))).when(case == 1, "x@gmail.com").otherwise("").alias("email"))
    host = F.when(case == 0, F.concat(F.lit("own"), k, F.lit(".com"))).otherwise(F.concat(F.lit("acme"), k, F.lit("a.com.br")))
    home = F.when(case == 0, F.concat(F.lit("<p>hello</p> zz@other.org info@own"), k, F.lit(".com"))).when(case == 1, F.concat(F.lit("<p>Market research by Acme"), k, F.lit("a</p>"))).otherwise("<p>Parked domain</p>")
    deep = F.when(case == 1, F.concat(F.lit("contato@acme"), k, F.lit("a.com.br"))).otherwise("")
    url = lambda path: F.concat(F.lit("https://www."), host, F.lit(path)).alias("url")
    pages = c.where("c_custkey % 4 < 3").select(url(""), home.alias("html")).unionAll(c.select(url("/contact"), deep.alias("html")))
    return directories.site_enrichment(companies, pages, "k", FREE)


_LEVELS = ("Exhibitor, Gold Sponsor", "Exhibitor", "Association Partner", "Presenter")


@query("""WITH q AS (SELECT c_name AS nome, 'https://c' || c_custkey || '.com/' AS site, ['expositor e patrocinador', 'expositor', 'parceiro', 'outro'][c_custkey % 4 + 1] AS tipo_participacao, ['Gold', '', '', ''][c_custkey % 4 + 1] AS nivel_patrocinio, 'Quirk''s Event' AS evento, 'Dallas' AS edicao, '2026' AS ano,
'United States' AS pais, 'm@c' || c_custkey || '.com' AS email, 'B' || c_custkey AS estande, 'A company that says in more than sixty letters what it does: ' || c_mktsegment AS descricao, 'https://x/' || c_custkey AS url_fonte, c_custkey % 4 < 2 AS comercial FROM customer),
i AS (SELECT CASE WHEN c_custkey = 0 THEN 'Greenbook' ELSE c_name END AS nome, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'https://c' || c_custkey || '.com/' END AS site, ['expositor', 'patrocinador', 'parceiro'][c_custkey % 3 + 1] AS tipo_participacao, ['Kiosk', 'Gold', 'Media Partner'][c_custkey % 3 + 1] AS nivel_patrocinio,
'IIeX Europe' AS evento, 'IIeX Europe' AS edicao, '2026' AS ano, 'Netherlands' AS pais, '' AS email, '' AS estande, '' AS descricao, 'https://i/' || c_nationkey AS url_fonte, c_custkey > 0 AND c_custkey % 3 < 2 AS comercial FROM customer),
m AS (SELECT c_name AS nome, 'https://c' || c_custkey || '.com/' AS site, CASE WHEN c_custkey % 2 = 0 THEN 'patrocinador' ELSE 'parceiro' END AS tipo_participacao, CASE WHEN c_custkey % 2 = 0 THEN 'Gold' ELSE 'Media partner' END AS nivel_patrocinio, 'MRMW Europe' AS evento, 'MRMW Europe' AS edicao, '' AS ano,
'Germany' AS pais, '' AS email, '' AS estande, '' AS descricao, 'https://m/' || c_nationkey AS url_fonte, c_custkey % 2 = 0 AS comercial FROM customer) SELECT * FROM q UNION ALL SELECT * FROM i UNION ALL SELECT * FROM m""")
def event_participants(spark, sf_dir):
    """Companies at three events by profile or card, the poorer of two records dropped, those that bought their place marked."""
    c = table(spark, sf_dir, "customer")
    stated = reduce(lambda out, i: out.when(F.col("c_custkey") % 4 == i, _LEVELS[i]), range(1, 4), F.when(F.col("c_custkey") % 4 == 0, _LEVELS[0]))
    html = (
        '<title>{n} - The Quirks Event</title><p class="icon_sponsor">{stated}</p><p class="company_url"><a href="https://c{k}.com/?a=1">site</a></p><a class="icon_pin"><span>B{k}</span></a><a href="mailto:m@c{k}.com?s">m</a>'
        '<div class="col-sm-9 content"><p>short</p><p>with a <a href="https://cdn.io/">link</a> that is longer than sixty letters, so it would count if links were allowed</p><p>A company that says in more than sixty letters what it does: {s}</p></div>'
    )
    shows = _pages(spark, sf_dir, html, stated=stated).withColumn("edicao", F.lit("dallas-2026"))
    editions = {"dallas-2026": ("Dallas", "2026", "United States")}
    level = F.when(F.col("c_custkey") % 3 == 0, "Kiosk").when(F.col("c_custkey") % 3 == 1, "Gold").otherwise("Media Partner")
    label = F.when(F.col("c_custkey") == 0, "Greenbook").otherwise(F.col("c_name"))
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('<p class="P__h__name">'), label, F.lit("</p>"))).otherwise(F.concat(F.lit('<img src="l" alt="'), label, F.lit('">')))
    site = F.when(F.col("c_custkey") % 5 == 0, "https://calendly.com/x").otherwise(F.concat(F.lit("https://c"), F.col("c_custkey").cast("string"), F.lit(".com/?x=1")))
    expo = _filled('<div class="Partner-module-scss__x1__partner"><span class="P__h__tag">{level}</span>{name}<a href="https://www.greenbook.org/company/x">p</a><a href="{site}">s</a></div>', level=level, name=name, site=site)
    forum = _filled('<div class="col sponsor-card"><div class="sponsor-type">{t}</div><h4 class="sponsor-name">{n}</h4><a href="https://c{k}.com/">x</a></div>', t=_when(2, 0, "Gold", "Media partner"), n=F.col("c_name"), k=F.col("c_custkey"))
    wall = lambda card, letter, head: _walls(c, card, letter, head).withColumn("edicao", F.lit(letter))
    poor = events.profile_participants(shows.withColumn("html", F.regexp_replace("html", '<a class="icon_pin">.*?</a>', "")), editions)
    return events.participants([
        events.profile_participants(shows, editions), poor,
        events.expo_participants(wall(expo, "i", "<h1>2026 IIEX Partners</h1>"), {"i": ("IIeX Europe", "Netherlands")}),
        events.forum_participants(wall(forum, "m", "<h2>Our Past Sponsors</h2>"), {"m": ("MRMW Europe", "Germany")}),
    ])


_BLOCKS = ("nav", "article", "footer")
_SHOWN = r"regexp_replace(html, '(?s)<script>.*?</script>|<style>.*?</style>|<!--.*?-->', '', 'g')"
_BLOCK = "regexp_extract(h, '(?s)<{0}>(.*?)</{0}>', 1)"
_TEXT = r"trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))".replace('\\"', '"')


@query("WITH p AS (SELECT page_id, " + _SHOWN + " AS h FROM pages) " + " UNION ALL ".join(
    f"SELECT page_id, '{b}' AS block, (len(regexp_extract_all({_BLOCK.format(b)}, '<a[ >]')))::BIGINT AS n_links, (len(regexp_extract_all({_BLOCK.format(b)}, '<p>')))::BIGINT AS n_paragraphs, sha256({_TEXT.format(_BLOCK.format(b))}) AS said_sha256 FROM p" for b in _BLOCKS))
def page_blocks(spark, sf_dir):
    """What lies inside each block of every page: links, paragraphs, closed or not, and the text."""
    pages = elements.with_elements(table(spark, sf_dir, "pages"))
    e = F.col("_e")
    rows = pages.select("page_id", "html", "_e", F.explode(F.array(*[F.lit(b) for b in _BLOCKS])).alias("block"))
    rows = rows.withColumn("_b", F.try_element_at(F.filter(e, lambda x: x["tag"] == F.col("block")), F.lit(1))).withColumn("_in", elements.within(e, F.col("_b")))
    count = lambda tag: F.size(elements.of(F.col("_in"), tag)).cast("long")
    return rows.select("page_id", "block", count("a").alias("n_links"), count("p").alias("n_paragraphs"), F.sha2(elements.said(F.col("html"), F.col("_b")), 256).alias("said_sha256"))


_GERMAN = (
    "<div class='block-member-title'><div><h1>{n}</h1></div></div><ul class='contact'>{head}<li class='contact__address'>{own}Lange Straße {k}<br>{zip} Köln</li><li><a href='tel:49{k}'>{phone}</a><a href='{mail}'>{label}</a></li>"
    "<li><div><a href='https://www.adm-ev.de/'>adm</a></div><a href='https://c{k}.de/'>web</a></li></ul><div class='block-member-profile'><h2>Profil</h2><div><p>{t}</div></div>"
    "<div class='block-member-facts'><div class='wrap'><div class='facts__item'><p class='facts__description'>Gründungsjahr:<p class='facts__text'>{year}</div></div></div>"
    "<div class='block-member-attributes'><div class='attributes__column'><h3>{column}</h3><ul><li>{s}<li>{s}<li>Online</ul></div></div><footer><a href='mailto:zz@foot.de'>f</a><ul><li class='contact__address'>9 Foot</ul></footer>"
)


@query("""WITH c AS (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s, c_nationkey AS g, CASE WHEN c_custkey % 4 = 0 THEN c_name || ' & ' || c_mktsegment ELSE c_mktsegment END AS t FROM customer)
SELECT 'https://x/' || k AS url, CASE WHEN k % 5 = 0 THEN CASE WHEN k % 6 = 0 THEN 'Customer Holding' ELSE '' END ELSE n END AS nome, 'Lange Straße ' || k || ', ' || (10000 + k % 80000) || ' Köln' AS endereco, (10000 + k % 80000)::VARCHAR AS cep, 'Köln' AS cidade,
CASE WHEN k % 2 = 0 THEN '+49 (' || g || ')' ELSE '49' || k END AS telefone, CASE k % 3 WHEN 0 THEN 'm' || k || '@c.de' WHEN 1 THEN 'l' || k || '@c.de' ELSE 'h' || k || '@c.de' END AS email, 'https://c' || k || '.de/' AS site, t AS descricao,
CASE WHEN k % 7 = 0 THEN '' ELSE (1950 + g)::VARCHAR END AS ano_fundacao, '' AS direcao, '' AS associacoes, '' AS funcionarios, CASE WHEN k % 2 = 1 THEN s || ' | Online' ELSE '' END AS unidades, CASE WHEN k % 2 = 0 THEN s || ' | Online' ELSE '' END AS metodos, '' AS setores, '' AS temas,
CASE WHEN k % 5 = 0 AND k % 6 > 0 THEN 'no name' ELSE '' END AS erro FROM c""")
def german_directory(spark, sf_dir):
    """Contact lists, facts and columns, each inside its block; addresses behind three forms of link, unclosed items, a footer with a list of its own."""
    k = F.col("c_custkey")
    text_of = lambda letter: F.concat(F.lit(letter), k.cast("string"), F.lit("@c.de"))
    mail = F.when(k % 3 == 0, F.concat(F.lit("mailto:"), text_of("m"), F.lit("?subject=x"))).when(k % 3 == 1, "/contact").otherwise(F.concat(F.lit("http://"), text_of("h"), F.lit("/")))
    return associations.german_institutes(_pages(
        spark, sf_dir, _GERMAN, mail=mail, label=F.when(k % 3 == 1, text_of("l")).otherwise("write"), head=_when(2, 0, "<li><ul><li>inner</ul>"), own=_when(6, 0, "Customer Holding<br>"),
        n=F.when(k % 5 == 0, "").otherwise(F.col("c_name")), phone=F.when(k % 2 == 0, F.concat(F.lit("+49 ("), F.col("c_nationkey").cast("string"), F.lit(")"))).otherwise(""), zip=(k % 80000 + 10000),
        year=F.when(k % 7 == 0, "").otherwise((F.col("c_nationkey") + 1950).cast("string")), column=_when(2, 0, "Methoden", "Standorte"), t=F.when(k % 4 == 0, F.concat(F.col("c_name"), F.lit(" &amp; "), F.col("c_mktsegment"))).otherwise(F.col("c_mktsegment")),
    ))


_ITALIAN = (
    "<article><div><h1 class='hideDesktopTitle'>{n}</h1><h1 class='hideMobileTitle'>{n} S.r.l.</h1></div></article><div class='info-istituto'><div><p><strong>Attestato n.</strong> {k}</p></div>"
    "<p>Via Roma {k} - 20121 Milano<br>{labels}</p><p><strong>Altre sedi</strong></p><p>Via {s}</p><p>Via {s}</p><p>Corso {k} Fondata nel {year}</p><p>Capitale Sociale € {k}.000 i.v.</p>{site}</div>"
    "<div class='desc-istituti'><p>About {s}<div><h2>Gruppo dirigente</h2><p>Anna<br>Bea</div><h3>Specializzazioni</h3><ul><li>{s}<li>Panel</ul></div><p><strong>Tel:</strong> 000</p>"
)


@query("""WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS n, c_mktsegment AS s, c_nationkey AS g FROM customer)
SELECT 'https://x/' || k AS url, CASE WHEN n = '' THEN 'S.r.l.' ELSE n END AS nome, trim(n || ' S.r.l.') AS razao_social, 'Via Roma ' || k || ' - 20121 Milano' AS endereco, '20121' AS cap, 'Milano' AS cidade,
CASE k % 3 WHEN 0 THEN '02 ' || k WHEN 1 THEN '' ELSE '06 ' || k END AS telefone, CASE WHEN k % 3 = 2 THEN '' ELSE '02 ' || g END AS fax, CASE k % 3 WHEN 0 THEN 'c' || k || '@c.it' WHEN 1 THEN 'l' || k || '@c.it' ELSE '' END AS email,
CASE WHEN k % 4 = 0 THEN ['office@c.it'] ELSE [] END::VARCHAR[] AS emails_extras, CASE WHEN k % 2 = 0 THEN 'https://c' || k || '.it' ELSE 'https://www.c' || k || '.it' END AS site, 'Via ' || s || ' | Corso ' || k AS outras_sedes, k::VARCHAR AS attestato, (1950 + g)::VARCHAR AS fundacao,
'€ ' || k || '.000' AS capital_social, 'About ' || s AS descricao, 'Anna | Bea' AS gruppo_dirigente, s || ' | Panel' AS especializacoes, '' AS erro FROM c""")
def italian_directory(spark, sf_dir):
    """Labels in any order, repeated and missing, values next to them, headings nested in the text they cut."""
    k = F.col("c_custkey")
    s = k.cast("string")
    strong = lambda label, value: F.concat(F.lit(f"<strong>{label}</strong> "), value, F.lit("<br>"))
    fax = strong("Fax:", F.concat(F.lit("02 "), F.col("c_nationkey").cast("string")))
    one = F.concat(strong("Telefono:", F.concat(F.lit("02 "), s)), fax, strong("Tel:", F.lit("99")), strong("E-mail:", F.concat(F.lit("c"), s, F.lit("@c.it"))))
    two = F.concat(strong("Mail:", F.concat(F.lit("<a href='mailto:l"), s, F.lit("@c.it?x'>write</a>"))), fax)
    three = F.concat(strong("Email:", F.lit("info@assirm.it")), strong("Tel:", F.concat(F.lit("06 "), s)))
    site = F.when(k % 2 == 0, F.concat(F.lit("<a href='https://www.assirm.it/n'>n</a><div><a href='https://c"), s, F.lit(".it'>s</a></div>"))).otherwise(F.concat(F.lit("<p>www.c"), s, F.lit(".it </p>")))
    site = F.concat(site, _when(4, 0, "<p>Office: Office@c.it, info@assirm.it</p>"))
    labels = F.when(k % 3 == 0, one).when(k % 3 == 1, two).otherwise(three)
    return associations.italian_associates(_pages(spark, sf_dir, _ITALIAN, n=F.when(k % 5 == 0, "").otherwise(F.col("c_name")), labels=labels, site=site, year=F.col("c_nationkey") + 1950))
