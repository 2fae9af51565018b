"""Elements of pages against plain checks, readers on nested and broken pages."""

import random
import time

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.sources import associations, directories, elements


def page(spark, *html):
    return spark.createDataFrame([(f"u{i}", h) for i, h in enumerate(html)], "url string, html string")


def test_intervals_nest_and_elements_are_in_order():
    rng = random.Random(1)
    pieces = ["<div class='a b'>", "<p>", "</p>", "</div>", "text", "<ul>", "<li>", "</li>", "</ul>", "<br>", "<script>x<p></script>", "<!-- <div> -->", "<b", "<i>", "</i>", "<td>", "<tr>", "<table>", "</table>", "</x>", "é\U0001f600"]
    for _ in range(400):
        source = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))
        found = elements.read_elements(source)
        for i, (tag, _, _, head, start, begin, close, stop, depth, at, n) in enumerate(found):
            assert at == i + 1 and source[start:begin] == head and start < begin <= close <= stop <= len(source)
            inside = [x for x in found if start < x[4] < close and x is not found[i]]
            assert inside == found[at : at + n], source
            assert all(x[7] <= close and x[8] > depth for x in inside)
            assert tag not in ("p", "li") or depth < 60


def test_linear_on_broken_markup():
    for bad in ("<a ", '<a href="x">', "<div>", "</div>", "<script>", "<!--", '<p class="', "<li><p>", "<b></i>"):
        start = time.time()
        elements.read_elements(bad * 100_000)
        assert time.time() - start < 10, bad


def test_unclosed_links_and_scripts_are_linear(spark):
    df = page(spark, "<a href='/x'>" * 20_000, "<script>" * 20_000, "<!--" * 20_000)
    start = time.time()
    assert df.select(F.size(directories.links(F.col("html"))).alias("n"), F.size(directories.lines(F.col("html"))).alias("m")).agg(F.max("n"), F.max("m")).first()[0] == 20_000
    assert time.time() - start < 30


def test_readers_stay_inside_their_block(spark):
    abroad = '<div class="area-texto"><h3>Acme</h3><p><b>Telefone:</b> 1111</p></div><footer><p><b>Telefone:</b> 9999 (association)</p></footer>'
    nested = '<div class="area-texto"><div class="in"><h3>Deep</h3></div><div><p><b>Telefone:</b> 2 <i>3</i></p></div><p><b>Site</b> none</p></div><h3>Other</h3>'
    got = {r["url"]: r for r in directories.brazilian_members(page(spark, abroad, nested, "<p><b>Telefone:</b> 5</p>", None)).collect()}
    assert [got[u]["telefone"] for u in ("u0", "u1", "u2", "u3")] == ["1111", "2 3", "", ""] and got["u1"]["nome"] == "Deep" and got["u1"]["site"] == "Site none"
    assert [got[u]["erro"] for u in ("u0", "u2", "u3")] == ["", "no text block", "no text block"]

    inner = '<div class="n">Acme Research SAC</div><p>Telf: 555 1234</p><div><p><a href="mailto:x@acme.pe">x@acme.pe</a></p></div>'
    peru = f'<div class="elementor-widget-text-editor"><div class="elementor-widget-container">{inner}</div></div><p>zz@other.pe</p>'
    row = directories.peruvian_members(page(spark, peru)).first()
    assert (row["email"], row["telefone"]) == ("x@acme.pe", "Telf: 555 1234")

    uk = '<meta property="og:title" content="N"><div id="rbg_addresses"><div>Tel: 1</div><div><a href="mailto:in@c.uk">m</a></div></div><a href="mailto:out@c.uk">m</a>'
    row = directories.british_suppliers(page(spark, uk)).first()
    assert (row["telefone"], row["email"]) == ("1", "in@c.uk")


def test_label_regions(spark):
    cases = [
        ("Tel: 1 Fax: 2", [("tel", "1"), ("fax", "2")]), ("fax 2 TELEFONO:3 Tel 4", [("fax", "2"), ("telefono", "3"), ("tel", "4")]), ("before E-mail: a@b.c", [("e-mail", "a@b.c")]),
        ("hotel: 5, Telefonos 6", []), ("", []), ("Tel", [("tel", "")]), ("Tel: Tel: 7", [("tel", ""), ("tel", "7")]), ("Straße Fax:ü", [("fax", "ü")]),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: [tuple(x) for x in r["v"]] for r in df.select("i", text.label_regions(F.col("t"), ["tel", "telefono", "fax", "e-mail", "mail"]).alias("v")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


GERMAN = """<div class="block-member-title"><h1>Umfrage &amp; Co</h1></div>
<ul class="x contact"><li class="contact__address">Umfrage Holding GmbH<br>Hauptstraße 5<br>10115 Berlin</li>
<li><a href="tel:+4930">+49 (30) 1</a></li><li><a href="http://sales@umfrage.de">write</a></li><li><a href="https://www.adm-ev.de/x">adm</a><a href="https://umfrage.de/">web</a></li></ul>
<div class="block-member-profile"><h2>Profil</h2><p>Wir <b>fragen</b>.</p></div>
<div class="block-member-facts"><div class="facts__item"><div class="facts__description">Gründungsjahr:</div><div class="facts__text">1999</div></div><div class="facts__item"><div class="facts__text">lost</div></div></div>
<div class="block-member-attributes"><div class="attributes__column"><h3>Methoden</h3><ul><li>CATI<li>CAWI<li>CATI</ul></div><div class="attributes__column"><h3>Themen</h3><ul><li>Auto</ul></div></div>
<div class="facts__item"><div class="facts__description">Geschäftsführung</div><div class="facts__text">outside</div></div>"""


def test_german_institutes(spark):
    bare = '<ul class="contact"><li class="contact__address">1 Weg<br>12345 Ulm</li><li><a href="mailto:info@adm-ev.de">i</a><a href="mailto:a@b.de?s=1">m</a></li></ul>'
    got = {r["url"]: r for r in associations.german_institutes(page(spark, GERMAN, bare, "<h1>no</h1>", None)).collect()}
    row = got["u0"]
    assert (row["nome"], row["endereco"], row["cep"], row["cidade"]) == ("Umfrage & Co", "Hauptstraße 5, 10115 Berlin", "10115", "Berlin")
    assert (row["telefone"], row["email"], row["site"], row["descricao"]) == ("+49 (30) 1", "sales@umfrage.de", "https://umfrage.de/", "Wir fragen .")
    assert (row["ano_fundacao"], row["direcao"], row["metodos"], row["temas"], row["setores"], row["erro"]) == ("1999", "", "CATI | CAWI", "Auto", "", "")
    assert (got["u1"]["email"], got["u1"]["endereco"], got["u1"]["erro"]) == ("a@b.de", "1 Weg, 12345 Ulm", "no name")
    assert got["u2"]["erro"] == got["u3"]["erro"] == "no contact block"


ITALIAN = """<article><h1 class="hideDesktopTitle">Ricerca</h1><h1 class="hideMobileTitle">Ricerca S.r.l.</h1></article>
<div class="info-istituto"><p><strong>Attestato n.</strong> 12</p><p>Via Roma 1 - 20121 Milano<br><strong>Fax:</strong> 02 2<br><strong>Telefono:</strong> 02 3057321<br><strong>Mail:</strong> <a class="__cf_email__" data-cfemail="42232002216c2627">x</a></p>
<p><strong>Altre sedi</strong></p><p>Via Po 2, Torino</p><p>Via Po 2, Torino</p><p>Corso 3 Fondata nel 1990</p><p>Capitale Sociale € 10.000 i.v. more@ric.it</p><a href="https://assirm.it/news">n</a><div><a href="https://ric.it">s</a></div></div>
<div class="desc-istituti"><h1>T</h1><p>First part<div><p>second<h2>Gruppo dirigente</h2><p>Anna<br>Bea</div><h3>Le Specializzazioni</h3><ul><li>CATI<li>Panel</ul></div><p>outside</p>"""


def test_italian_associates(spark):
    free = '<article><h1>Solo</h1></article><div class="info-istituto"><p><strong>Tel:</strong> 02 58315750</p><p>see www.solo.it/a and x@www.other.it</p></div>'
    got = {r["url"]: r for r in associations.italian_associates(page(spark, ITALIAN, free, "", None)).collect()}
    row = got["u0"]
    assert (row["nome"], row["razao_social"], row["endereco"], row["cap"], row["cidade"]) == ("Ricerca", "Ricerca S.r.l.", "Via Roma 1 - 20121 Milano", "20121", "Milano")
    assert (row["telefone"], row["fax"], row["email"], row["emails_extras"], row["site"]) == ("02 3057321", "02 2", "ab@c.de", ["more@ric.it"], "https://ric.it")
    assert (row["outras_sedes"], row["fundacao"], row["capital_social"], row["attestato"]) == ("Via Po 2, Torino | Corso 3", "1990", "€ 10.000", "12")
    assert (row["descricao"], row["gruppo_dirigente"], row["especializacoes"]) == ("First part second", "Anna | Bea", "CATI | Panel")
    assert (got["u1"]["nome"], got["u1"]["telefone"], got["u1"]["site"], got["u1"]["outras_sedes"], got["u1"]["endereco"]) == ("Solo", "", "https://www.solo.it/a", "", "")
    assert got["u2"]["erro"] == got["u3"]["erro"] == "no information block"
