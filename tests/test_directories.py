"""Readers of site pages on pages that aren't as they should be."""

from pyspark.sql import functions as F

from millrace.plans.directories import _pages, _walls
from millrace.sources import directories, events

READERS = [directories.brazilian_members, directories.global_companies, directories.british_suppliers, directories.sourcebook_companies]


def odd(spark):
    long = "<div class='area-texto'><h3>Long</h3>" + "<p><b>x:</b> y</p>" * 20_000 + "<p class=\"address_block\">" + "line<br>" * 20_000 + "</p>"
    return spark.createDataFrame([("null", None), ("empty", ""), ("open", "<div class=\"area-texto\"><p><b>site</b><a href='"), ("long", long), ("long", long)], "url string, html string")


def test_every_page_gives_one_row(spark):
    for read in READERS:
        rows = read(odd(spark)).select("url", "nome", "erro").collect()
        assert sorted(r["url"] for r in rows) == ["empty", "long", "long", "null", "open"], read.__name__
        assert all(r["erro"] for r in rows if r["url"] in ("null", "empty") and read is not directories.british_suppliers), read.__name__
    assert directories.spanish_members(odd(spark)).count() == 0
    assert {r["erro"] for r in directories.with_person(directories.peruvian_members(odd(spark)).withColumn("nome", F.lit("x"))).collect()} == {"no contact block"}


def test_hidden_json(spark):
    bad = [("a", '<script type="application/ld+json">{"@type": "Organization", "name": "A", "address": "one line"}</script>'), ("b", '<script type="application/ld+json">{broken</script><h1>B</h1>'), ("c", '<script type="application/ld+json">[1, {"@type": "Corporation", "name": "C"}]</script>')]
    got = {r["url"]: r["nome"] for r in directories.global_companies(spark.createDataFrame(bad, "url string, html string")).collect()}
    assert got["a"] == "A" and got["b"] == "B"


def test_cards_of_long_pages(spark):
    card = '<div class="sponsor-card"><div class="sponsor-type">Gold</div><h4 class="sponsor-name">N{}</h4>' + "text " * 2_000 + '<a href="https://zoom.us/x">x</a></div>'
    page = "<p>Our 2027 Sponsors</p>" + "".join(card.format(i) for i in range(50))
    rows = events.forum_participants(spark.createDataFrame([("u", "m", page), ("v", "m", None), ("w", "other", "")], "url string, edicao string, html string"), {"m": ("Forum", "Peru")})
    got = rows.collect()
    assert len(got) == 50 and {(r["site"], r["ano"], r["evento"], r["tipo_participacao"]) for r in got} == {("", "2027", "Forum", "patrocinador")}


def test_a_page_is_not_read_again_for_each_of_its_cards(spark):
    pages = spark.createDataFrame([("u", "m", "<h1>2026</h1>")], "url string, edicao string, html string")
    for read in (events.expo_participants, events.forum_participants):
        plan = read(pages, {"m": ("Forum", "Peru")})._jdf.queryExecution().optimizedPlan().toString()
        above, found, below = plan.partition("Generate explode")
        assert found and "html" not in above and "_h#" not in above and "_y#" in below, read.__name__


def test_walls_have_pages_that_do_not_grow(spark):
    customers = spark.range(5_000).select(F.col("id").alias("c_custkey"), (F.col("id") % 2).cast("int").alias("c_nationkey"))
    got = _walls(customers, F.concat(F.lit("<"), F.col("c_custkey").cast("string"), F.lit(">")), "w", "<h1>").collect()
    assert len(got) == 10 and {r["url"] for r in got} == {"https://w/0", "https://w/1"}
    held = [[int(k) for k in r["html"].removeprefix("<h1>")[1:-1].split("><")] for r in got]
    assert sorted(k for page in held for k in page) == list(range(5_000)) and all(page == sorted(page) and len(page) == 500 for page in held)


def test_logos_and_rosters_without_entries(spark):
    pages = spark.createDataFrame([("u", None), ("v", "<figure class='annuaireSyntec'><img alt='A'></figure><a href='https://foot.fr'>")], "url string, html string")
    assert [(r["nome"], r["site"], r["tambem_em_nos_membros"]) for r in directories.french_members(pages, pages.where("url = 'u'")).collect()] == [("A", "", "nao")]
    assert directories.logo_entries(pages, "(?is)<li>.*?</li>", ()).count() == 0


def test_awards_without_details(spark):
    found = spark.createDataFrame([('{"results": [{"recipient_id": null, "name": " A "}, {"recipient_id": "r", "name": "B", "amount": 2}]}',), ("{}",), (None,), ("junk",)], "body string")
    got = directories.award_recipients(found, spark.createDataFrame([("r", "junk"), ("r", "{}")], "recipient_id string, body string")).orderBy("nome").collect()
    assert [(r["nome"], r["pais"], r["valor_total"], r["erro"]) for r in got] == [("A", "United States", 0.0, "no recipient_id"), ("B", "United States", 2.0, "")]


def test_participants_keep_the_fuller_record(spark):
    row = {c: "" for c in events.COLUMNS} | {"evento": "e", "edicao": "d", "tipo_participacao": "expositor"}
    rows = [row | {"nome": "Acme, Inc."}, row | {"nome": "ACME", "site": "https://a.com"}, row | {"nome": "Insights Association"}, row | {"url_fonte": "p1"}, row | {"url_fonte": "p2"}]
    df = spark.createDataFrame([tuple(r[c] for c in events.COLUMNS) for r in rows], ", ".join(f"{c} string" for c in events.COLUMNS))
    got = sorted((r["nome"], r["comercial"]) for r in events.participants([df]).collect())
    assert got == [("", False), ("", False), ("ACME", True), ("Insights Association", False)]


def test_pages_are_dealt_out_whatever_their_table_weighs(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts > 1 and _pages(spark, "/root/testdata/sf0.001", "{n}").rdd.getNumPartitions() == parts


def test_a_page_is_read_once_for_the_filter_and_the_record(spark):
    from millrace.functions import urls
    from millrace.sources import directories

    pages = spark.createDataFrame([("u", "<title>A</title><p>Contacto:</p><a href='http://www.facebook.com/x'>f</a><a href='mailto:A@b.es?x'>m</a><a href='https://b.es/p?q'>s</a>"), ("v", "<p>Contacto:</p>")], "url string, html string")
    found = directories.spanish_members(pages)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?i)<a(?=") == 1
    assert [(r["nome"], r["email"], r["site"]) for r in found.collect()] == [("A", "a@b.es", "https://b.es/p")]
    hosts = pages.select(urls.on_list(F.col("url"), [f"d{i}.com" for i in range(9)]).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert hosts.count("[A-Za-z0-9+.-]*):") == 1


def test_a_link_is_judged_once(spark):
    from millrace.sources import associations

    pages = spark.createDataFrame([("u", "<ul class='contact'><li><a href='http://h@c.de/'>x</a><a href='https://c.de/'>web</a></li></ul>")], "url string, html string")
    found = associations.german_institutes(pages)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("(?i)^[a-z]+://") == 1
    assert [(r["email"], r["site"]) for r in found.collect()] == [("h@c.de", "https://c.de/")]
