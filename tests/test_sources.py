"""Sources and sinks on small landed files."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import quality, stores
from millrace.sources import adapters, files, markup, sinks

HTML = """<html><head><title> A  title </title><meta name="Description" content="about"><script type="application/ld+json">{"@graph": [{"datePublished": "2026-02-03"}]}</script>
<script>var hidden = "not citable";</script></head><body><h1>Head</h1><p>One<br>two &amp; three</p><img alt="a picture"><iframe src="https://v/1"></iframe><a href="/x">go on</a></body></html>"""


def test_page_fields(spark):
    df = spark.createDataFrame([(1, HTML), (2, None)], "page_id int, html string")
    got = {r["page_id"]: r["page"] for r in markup.parse_pages(df, ["page_id"]).collect()}
    p = got[1]
    assert (p["title"], p["h1"], p["meta"], p["alts"], p["iframes"]) == ("A title", ["Head"], {"description": "about"}, ["a picture"], ["https://v/1"])
    assert p["text"] == "Head\nOne\ntwo & three\ngo on" and p["links"][0]["href"] == "/x" and got[2]["text"] == ""
    v = markup.parse_pages(df, ["page_id"]).where("page_id = 1").select(markup.validation_text().alias("v")).first()[0]
    assert "a picture" in v and "about" in v and "https://v/1" in v and "not citable" not in v
    dates_ = markup.parse_pages(df, ["page_id"]).where("page_id = 1").select(markup.json_values(F.get("page.jsonld", F.lit(0)), "datePublished").alias("d")).first()[0]
    assert dates_ == ["2026-02-03"]


FEEDS = {
    "rss": b"<rss><channel><item><title>T</title><link>https://a/1?utm_source=x</link><pubDate>Mon, 26 Oct 2026 10:00:00 GMT</pubDate><description>d</description></item>"
    b"<item><title>T2</title><link>https://A/1/</link><pubDate>Mon, 26 Oct 2026 10:00:00 GMT</pubDate></item><item><title>Old</title><link>https://a/2</link><pubDate>Mon, 27 Jul 2026 10:00:00 GMT</pubDate></item>"
    b"<item><title>Undated</title><link>https://a/3</link></item></channel></rss>",
    "atom": b'\xef\xbb\xbf<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E</title><link rel="alternate" href="https://b/1"/><updated>2026-10-20T00:00:00Z</updated><summary>s</summary></entry></feed>',
    "map": b'<sitemapindex><sitemap><loc>https://c/old.xml</loc><lastmod>2020-01-01</lastmod></sitemap><sitemap><loc>https://c/new.xml</loc><lastmod>2026-10-01</lastmod></sitemap><sitemap><loc>https://c/u.xml</loc></sitemap></sitemapindex>',
    "bad": b"<html><body>",
}


def test_feeds_and_sitemaps(spark):
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in FEEDS.items()], "source string, body binary")
    items = markup.feed_items(df, ["source"])
    got = [(r["source"], r["kind"], r["url"]) for r in items.collect()]
    assert len(got) == 9 and ("bad", "invalido", "") in got and ("atom", "atom", "https://b/1") in got
    cutoff = F.lit("2026-07-29").cast("date")
    assert [r["url"] for r in markup.newest_children(items, "source", cutoff).collect()] == ["https://c/new.xml", "https://c/u.xml"]
    ordered = items.withColumn("ord", F.monotonically_increasing_id())
    kept = markup.source_items(ordered.where("source = 'rss'"), "source", F.lit("2026-10-27").cast("date"), 90)
    assert [r["canonical"] for r in kept.collect()] == ["https://a/1"]


def test_a_long_feed_is_read_without_its_tree():
    import tracemalloc

    body = b"<rss><channel><title>own</title>" + b"".join(b"<item><title>T%d</title><link>u%d</link><x><item><link>in</link></item></x></item><noise><a/></noise>" % (i, i) for i in range(20_000)) + b"</channel></rss>"
    tracemalloc.start()
    n = sum(1 for _ in markup.read_feed(body))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 40_000 and peak < 3 * len(body), (n, peak, len(body))
    assert [r[1] for r in markup.read_feed(body)][:3] == ["u0", "in", "u1"]
    assert list(markup.read_feed(body[:-1])) == [("invalido", "", "", "", "")]


def test_a_source_has_several_feeds(spark, tmp_path):
    from millrace.plans.records import _feeds

    spark.range(10_000).selectExpr("id AS o_orderkey", "'1-URGENT' AS o_orderpriority", "TIMESTAMP '1997-01-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    rows = _feeds(spark, str(tmp_path), "yyyy-MM-dd", F.concat(F.lit("<"), F.col("o_orderkey").cast("string"), F.lit(">")), ("[", "]")).collect()
    assert {r["source"] for r in rows} == {"1-URGENT"} and len(rows) == 4
    assert sorted(int(k) for r in rows for k in r["body"][2:-2].split("><")) == list(range(10_000))


def test_quotes(spark):
    cases = [("plain words here", "some plain  words here now", True), ("“quoted”", 'a "quoted" b', True), ("plain wordz", "plain words", False), ("Plain", "plain", False),
             ("first ... last", "the first and the last", True), ("last ... first", "the first and the last", False), ("...", "x", False), ("", "x", False), (None, "x", False)]
    df = spark.createDataFrame([(i, q, t) for i, (q, t, _) in enumerate(cases)], "i int, q string, t string")
    forms = df.select("i", text.quote_form(F.col("q")).alias("q"), text.quote_form(F.col("t")).alias("t"))
    got = [r[0] for r in forms.orderBy("i").select(quality.quote_holds(F.col("q"), F.col("t"))).collect()]
    assert got == [e for *_, e in cases]


def test_paragraphs(spark):
    line = "Some words of a long paragraph, and"
    long = "\n".join([line.capitalize() + ","] + ["and " + line.lower() + ","] * 60 + ["end."])
    cases = {
        # the menu runs into it: four short lines, not a paragraph
        "Menu\nHome\nAbout\nContact\nThis is a paragraph that\ngoes on here, and\nends well.\nA title without an end": [],
        "This is a paragraph that has\ngone on here, and\nends well.\n\nAnother sentence that stands on its own.": ["This is a paragraph that has gone on here, and ends well.", "Another sentence that stands on its own."],
        "He said:\nShort one.\nAn open line\nStub.\n, and  more  marks\u00a0here (yes)": ["Short one.", "An open line Stub. , and more marks here (yes)"],
        "": [], "\n \n": [], "only a title": [], None: [],
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*cases, long])], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(text.paragraphs(F.col("t"))).collect()]
    assert got[:-1] == list(cases.values())
    assert got[-1] == [got[-1][0]] and got[-1][0].endswith("end.") and len(got[-1][0]) < 1600  # what is over the limit is cut before this one
    whole = df.where(F.col("i") == len(cases)).select(text.paragraphs(F.col("t"), most=None)).first()[0]
    assert whole == [" ".join(long.split())]


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,nome\n1,\"x\ny\"\n".encode())
    assert [tuple(r) for r in files.csv_table(spark, str(tmp_path / "a.csv")).collect()] == [("1", "x\ny")]
    (tmp_path / "n.csv").write_text("Notes:\nfree text, with commas\n\nFirst Name,Company\nAna,\"Acme, Inc\"\n\nBo,Beta\n")
    got = files.csv_after_preamble(spark, str(tmp_path / "n.csv"), ["First Name", "Company"]).orderBy("ord").collect()
    assert [(r["First Name"], r["Company"]) for r in got] == [("Ana", "Acme, Inc"), ("Bo", "Beta")]
    (tmp_path / "d.js").write_text('window.DATA = {"a": [1, 2]};\n')
    assert files.js_assignment(spark, str(tmp_path / "d.js"), "window.DATA", "a ARRAY<INT>").first()["a"] == [1, 2]
    assert files.json_table(spark, str(tmp_path / "none.json"), "a INT").count() == 0
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("m.csv", "1;São\n2;\"a;b\"\n".encode("latin-1"))
    (tmp_path / "z.zip").write_bytes(raw.getvalue())
    rows = files.zipped_rows(files.binary_files(spark, str(tmp_path), "*.zip"), ["id", "cidade"]).collect()
    assert [(r["id"], r["cidade"]) for r in rows] == [("1", "São"), ("2", "a;b")]
    word = io.BytesIO()
    with zipfile.ZipFile(word, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p><w:t>Two</w:t></w:p></w:document>')
    (tmp_path / "w.docx").write_bytes(word.getvalue())
    (tmp_path / "w.md").write_text("see https://a.b/c), and https://a.b/c and https://d.e.")
    both = files.binary_files(spark, str(tmp_path), "w.*")
    chosen = files.preferred_document(both).select(files.document_text("path", "content")).collect()
    assert [r[0] for r in chosen] == ["One\nTwo"]
    assert [r["url"] for r in files.markdown_links(spark, str(tmp_path / "w.md")).orderBy("ord").collect()] == ["https://a.b/c", "https://d.e"]
    config, warnings = files.tolerant_config({"fontes": {"x": {"url": "u"}}}, {"fontes": [], "vocabulario": []})
    assert config["fontes"] == [{"name": "x", "url": "u"}] and warnings == ["missing: vocabulario"]


def test_adapter_records(spark):
    page = "<h1>Acme <b>Pesquisas</b></h1><table><tr><th>Telefone:</th><td>11 3456-7890</td></tr><tr><td><b>Endereço</b></td><td>Rua A, 1</td></tr></table><p>contato (at) acme.com.br</p>"
    listing = '<a href="/m/1" class="member-card">x</a><a href="/m/2" class="company">y</a><a href="/m/1" class="member">x</a>'
    labels = {"telefone": ("telefone", "fone"), "endereco": ("endere[çc]o",), "site": ("site", "website")}
    a = adapters.by_labels("abep", "Brazil", r'(?i)href="([^"#]+)"[^>]*class="[^"]*(?:member|company)', labels)
    keys = a.keys(spark.createDataFrame([(listing,)], "html string")).collect()
    assert sorted(r["key"] for r in keys) == ["/m/1", "/m/2"]
    rows = a.records(spark.createDataFrame([("u1", page), ("u2", "<p>no name</p>"), ("u3", None)], "url string, html string")).collect()
    assert [(r["nome"], r["telefone"], r["endereco"], r["email"], r["pais"]) for r in rows] == [("Acme Pesquisas", "11 3456-7890", "Rua A, 1", "contato@acme.com.br", "Brazil")]


STORE = {
    "marca": "M", "nome": "Loja", "url": "u", "place_id": "p1", "latitude": 1.0, "longitude": 2.0, "nota": 4.5, "total_avaliacoes": 3, "endereco": "e", "cidade": "c",
    "horario_funcionamento": {"seg": "9-18"}, "horarios_pico": {"seg": {"9": 10, "10": 30}, "dom": {}}, "distribuicao_estrelas": {"1": 1, "2": 0, "5": 3}, "topicos_avaliacoes": {"preco": 2},
    "destaques": ["d1"], "atributos": {"pagamento": ["pix", "cartao"]},
    "avaliacoes": [{"id": "r1", "autor_info": "Guia local", "estrelas": 5, "data_relativa": "", "data_estimada": "2026-07-01", "texto": "ok", "curtidas": 0, "resposta_proprietario": "obrigado", "fotos": 0}],
}


def test_store_tables_and_captures(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(STORE))
    df = spark.read.schema(stores.STORE).json(str(tmp_path / "s.json"))
    tables = stores.store_tables(df)
    counts = {k: v.count() for k, v in tables.items()}
    assert counts == {"lojas": 1, "funcionamento": 1, "pico": 2, "estrelas": 3, "topicos": 1, "destaques": 1, "atributos": 2, "avaliacoes": 1}
    assert tables["lojas"].first()["pct_negativas"] == 25.0
    r = stores.compact_reviews(tables["avaliacoes"], F.lit("2026-07-31").cast("date")).first()
    assert (r["meses"], r["respondida"], r["guia"], r["mes"]) == (1.0, True, True, "2026-07")
    two = df.withColumn("ord", F.lit(0)).unionByName(df.withColumn("ord", F.lit(1)).withColumn("nome", F.lit("Loja longa")))
    m = stores.merge_captures(two).first()
    assert (m["nome"], m["capturas"], len(m["avaliacoes"])) == ("Loja longa", 2, 1)
    sinks.write_tables({"lojas": tables["lojas"], "atributos": tables["atributos"]}, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "atributos")).count() == 2


def test_flat_rows(spark):
    df = spark.sql("SELECT array('a', 'b') AS l, map('k', 1) AS m, named_struct('x', 1) AS s, cast(null AS int) AS n, array(named_struct('nome', 'Ana', 'cargo', 'CEO'), named_struct('nome', 'Bo', 'cargo', '')) AS p")
    assert tuple(sinks.flat(df, ["l", "m", "s", "n", "gone"]).first()) == ("a | b", "k: 1", '{"x":1}', "", "")
    assert df.select(sinks.people(F.col("p"))).first()[0] == "Ana (CEO) | Bo"
    items = spark.createDataFrame([("b", 1, "x"), ("a", 2, "y"), ("a", 3, "z"), ("c", 4, "w")], "cat string, d int, t string")
    got = {r["cat"]: r["lines"] for r in sinks.digest(items, "cat", ["a", "b"], F.col("t"), [F.desc("d")]).collect()}
    assert got == {"a": ["z", "y"], "b": ["x"]}
