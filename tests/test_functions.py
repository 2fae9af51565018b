"""Scalar functions against case tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import contact, dates, text, urls


def evaluated(spark, values, fn, kind="string"):
    """fn applied to a column of values, results in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


CASES = [
    (text.collapse, {"  a \n\t b ": "a b", None: None, "": ""}),
    (text.fold, {"Ação Ñandú": "Acao Nandu", "ŁÓDŹ": "ŁODZ", "ascii": "ascii", "é": "e"}),
    (text.nfkc, {"ﬁ①": "fi1", None: None}),
    (text.quote_form, {"“Olá”  – x​y": '"Olá" - xy', "it’s": "it's"}),
    (text.squeeze_key, {"Pesquisas & Consultoria Ágil Ltda": "agil", "ACME S.A. Research": "acme", None: "", "Dados de Mercado": "dadosmercado"}),
    (text.token_key, {"The ACME  Group, Inc.": "the acme"}),
    (lambda c: text.squeeze_key(c, sharp_s=True), {"Straße GmbH": "strassegmbh"}),
    (lambda c: text.shorten(c, 10), {"alpha, beta gamma": "alpha", "short": "short", "abcdefghijklm": "abcdefghij"}),
    (lambda c: text.guess_language(c), {"the cat is in the house of that": "en", "o livro que não é para uma pessoa como": "pt", "el libro de las cosas en una": "es", "xyz": "en"}),
    (lambda c: F.array_join(text.stems(c), ","), {"Research about respondents and Respondent panels": "respon,panels"}),
    (lambda c: F.array_join(text.sentences(c), "|"), {"This is the first sentence here. And this is a second one. no capital": "This is the first sentence here.|And this is a second one. no capital", "Too short. Also.": ""}),
    (text.repair_mojibake, {"AÃ§Ã£o": "Ação", "fine": "fine", "Ação": "Ação", "Ã‰tude": "Étude", None: None}),
    (lambda c: text.mostly_script(c), {"Ελληνικά abc": False, "Latin text": True, "123": None}),
    (text.deobfuscate, {"a (at) b [dot] c": "a@b.c"}),
    (text.xor_hex, {"5a3b1a39": "a@c", "": ""}),
    (lambda c: text.country_of_address(c, {"uk": "United Kingdom", "korea, republic of": "South Korea"}), {"1 Road, London, UK": "United Kingdom", "Seoul, Korea, Republic of": "South Korea", "Rua 1, Brasil.": "Brasil"}),
    (text.state_of_address, {"Rua A, 10 - Goiânia - GO": "GO", "no state": ""}),
    (text.building_of_address, {"Av. B, 10, Edifício Sol, Centro": "Edifício Sol", "Av. B": ""}),
    (text.name_of_file, {"https://x/logo-acme_corp-300x200.png?v=1": "Acme Corp"}),
    (text.title_part, {"Acme | Home": "Acme"}),
    (text.without_markdown, {"**a** [b](http://c)": "a b", "not found": "", None: ""}),
    (text.greek_upper, {"Έρευνα": "ΕΡΕΥΝΑ"}),
    (urls.canonical, {
        "HTTPS://WWW.Ex.com/a/?utm_source=x&b=1&ref=z#f": "https://www.ex.com/a?b=1", "ex.com": "https://ex.com/", "http://ex.com:80/p;s=1?GCLID=1": "http://ex.com:80/p",
        "https://ex.com/?a=1&&b": "https://ex.com/?a=1&b", " https://ex.com/a/b/ ": "https://ex.com/a/b",
    }),
    (urls.host, {"https://user@www.Ex.com:8080/a": "ex.com", "www.a.b": "a.b"}),
    (urls.registrable, {"https://api.delve.ai/x": "delve.ai", "http://www.shop.acme.com.br": "acme.com.br", "localhost": "localhost"}),
    (urls.unwrapped, {"https://l.ex/?url=https%3A%2F%2Fa.b%2Fc&x=1": "https://a.b/c", "https://a.b": "https://a.b"}),
    (urls.path_words, {"https://a.b/some-post_title/2": "some post title 2"}),
    (lambda c: urls.id_and_place(c)["id"], {"https://m/x?cid=77&y": "77", "https://m/profile/abc/": "abc"}),
    (lambda c: urls.on_list(c, ["g2.com", "linkedin.com/in/"]), {"https://www.g2.com/x": True, "https://notg2.com": False, "https://br.linkedin.com/in/a": True, "https://linkedin.com/company/a": False}),
    (contact.kind, {"x@gmail.com": "gratuito", "contabil@firma.com": "contador", "a@firma.com": "corporativo", "": "", None: ""}),
    (contact.reach, {"info@f.com": "funcao", "info+a@f.com": "funcao", "ana@f.com": "nominal"}),
    (contact.tier, {"ana@f.com": "A", "info@f.com": "B", "x@gmail.com": "C", "escritorio@gmail.com": "D", "none": "E"}),
    (lambda c: contact.tier(c, F.lit(False)), {"ana@f.com": "E"}),
    (lambda c: contact.tier(c, F.lit(None).cast("boolean")), {"ana@f.com": "A"}),
    (lambda c: contact.verdict(c, F.lit("ok"), F.lit("aceito"))["verdict"], {"ana@f.com": "valido", "bad@": "invalido", "a@yopmail.com": "invalido"}),
    (lambda c: contact.verdict(c, F.lit(None), F.lit("recusado"))["verdict"], {"ana@f.com": "indeterminado"}),
    (lambda c: F.array_join(contact.useful(contact.found_in(c), F.lit("f.com")), ","), {"z@g.com a@f.com logo@2x.png info@g.com contato@f.com": "contato@f.com,a@f.com,info@g.com,z@g.com"}),
    (lambda c: contact.phone(F.lit("11"), c), {"34567890": "(11) 3456-7890", "": ""}),
    (dates.parse_date, {
        "Tue, 02 Sep 2025 23:30:00 -0300": datetime.date(2025, 9, 2), "2026-05-30T10:00:00Z": datetime.date(2026, 5, 30), "2026/05/30": datetime.date(2026, 5, 30),
        "2026-13-01": None, "soon": None, None: None,
    }),
    (lambda c: dates.relative_date(c, F.lit("2026-10-27 12:00:00").cast("timestamp")), {"há 3 meses": datetime.date(2026, 7, 29), "um ano atrás": datetime.date(2025, 10, 27), "uma hora atrás": datetime.date(2026, 10, 27), "ontem": None}),
    (lambda c: dates.date_confidence(c, "2026-01-01", "2026-06-30"), {"2026": "in", "2026-07": "out", "2026-06-30": "in", "not found": "unknown"}),
    (dates.number, {"nota 1.234,5 pts": 1234.5, "4,7": 4.7, "none": None}),
    (lambda c: F.array_join(dates.grades_of_code(c), ","), {"EF15AR01": "1,2,3,4,5", "EF07CI02": "7", "EF67": "6,7", "EI03": ""}),
    (lambda c: dates.page_date(F.lit(""), F.lit('{"datePublished": "2026-02-03"}'), c), {"https://a/2025/01/02/x": "2026-02-03"}),
    (lambda c: dates.page_date(F.lit(None), F.lit(None), c), {"https://a/2025/01/02/x": "2025-01-02", "https://a/2025/x": "2025", "https://a": "not found"}),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_case_table(spark, k):
    fn, cases = CASES[k]
    assert evaluated(spark, list(cases), fn) == list(cases.values())


def test_window_edges(spark):
    today = F.lit("2026-10-27").cast("date")
    values = ["2026-07-29", "2026-07-28", "2026-10-28", "2026-10-29", None]
    got = evaluated(spark, values, lambda c: dates.in_window(c.cast("date"), today, 90))
    assert got == [True, False, True, False, False]


def test_numbers_and_lists(spark):
    assert evaluated(spark, [1234567], text.thousands, "bigint") == ["1.234.567"]
    assert evaluated(spark, [["a", "b", "c"], ["a"], []], text.listed, "array<string>") == ["a, b e c", "a", ""]
    assert evaluated(spark, ["ACME Research Brasil"], lambda c: F.array_join(text.domain_guesses(c), ",")) == ["acme.com.br,acme.com,acmebrasil.com.br,acmebrasil.com"]


def test_charset_decision(spark):
    rows = [("Ação".encode(), None), ("Ação".encode("latin-1"), "iso-8859-1"), ("Ação".encode(), "iso-8859-1"), (b'<meta charset="cp1252">\x93x\x94', None), (b"\xef\xbb\xbfx", None)]
    df = spark.createDataFrame([(i, bytearray(b), h) for i, (b, h) in enumerate(rows)], "i int, b binary, h string")
    got = [r["t"]["text"] for r in df.orderBy("i").select(text.decode_bytes("b", "h").alias("t")).collect()]
    assert got == ["Ação", "Ação", "Ação", '<meta charset="cp1252">“x”', "x"]


def test_address_block(spark):
    got = evaluated(spark, ["Address: Street 1\nTel: +90 212 555 44 33\nCity\ne-mail: a@b.com"], text.split_address)[0]
    assert (got["address"], got["email"], got["phone"]) == ("Street 1, City", "a@b.com", "+90 212 555 44 33")
