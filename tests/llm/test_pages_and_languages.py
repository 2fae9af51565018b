"""HTML extraction on pages of known text; language identification by held-out accuracy."""

import pytest
from pyspark.sql import functions as F

from millrace.llm import html_text, language

SF = "/root/testdata/sf0.01"
PAGES = [
    (None, ""), ("", ""), ("plain < text &amp; more", "plain < text & more"),
    ("<nav><ul><li>menu</nav><article><h1>T&eacute;</h1><p>a&nbsp;b  c,\n d<p>e<br>f</article><footer>f</footer>", "Té\na b c, d\ne\nf"),
    ("<body class='has-sidebar'><header>Site</header><div class=cookie-notice>We use</div><main><p>One, two. Long enough text it is.</p><form><p>Name</p></form><div id=comments><p>nice, really</p></div></main>", "One, two. Long enough text it is."),
    ("<div class='content no-ads'><p>Kept, as it has none.</p><div class='ad-box'>Buy</div></div>", "Kept, as it has none."),
    ("<nav><a href=x>never closed<article><p>body text</article>", "body text"),
    ("<p>ok<script>var a='</p>'</script> go<style>p{}</style><!-- no --> on</p>", "ok go on"),
    ("<div><p>First paragraph, with commas, and with length to win.</p></div><div class='ad'>Buy</div><p>After it, a sibling that reads like text and is long enough to stay.</p>",
     "First paragraph, with commas, and with length to win.\nAfter it, a sibling that reads like text and is long enough to stay."),
]


@pytest.mark.parametrize(("source", "text"), PAGES)
def test_main_text(source, text):
    assert html_text.main_text(source) == text


def test_pieces_beside_the_best_container_stay():
    """Pages without article or main: all that reads like text beside the container, and no link lists."""
    line = "A paragraph of the article, with commas, and long enough to count as text, it is."
    text = f"<div class=text>{f'<p>{line}' * 5}</div>"
    for piece, said in (
        ("<ul><li>one<li>two<li>three</ul>", "one\ntwo\nthree"), ("<section><p>Short end.</section>", "Short end."), ("<blockquote>Quoted.</blockquote>", "Quoted."),
        ("<pre>x = 1</pre>", "x = 1"), ("<table><tr><td>1<td>2</table>", "1\n2"), ("<dl><dt>a<dd>b</dl>", "a\nb"), ("<figure><figcaption>Fig. 1</figcaption></figure>", "Fig. 1"),
        ("<ul><li><a href=x>menu</a><li><a href=y>more</a></ul>", ""),
    ):
        assert html_text.main_text(f"<div id=c><h1>T</h1>{text}{piece}</div>") == "\n".join(["T", *[line] * 5, *([said] if said else [])]), piece


PROSE = "A paragraph of the article, with commas, and long enough to count as text, it is."


@pytest.mark.parametrize(("source", "text"), [
    ("<article><h1>Head</h1><p title=don't>First it is.</p><p>It's second.</p></article>", "Head\nFirst it is.\nIt's second."),
    ('<article><p class="x"">one</p><p id="y">two</p></article>', "one\ntwo"),
    ("<article><p a='unclosed>one</p><p>two</article>", "one\ntwo"),
    ('<article><p data-x = "a > b">one</p><p data-y=a"b>two</p><br/><p / >three</article>', "one\ntwo\nthree"),
    ("<!--><article><p>one</p><!-- x --!>two</article><!-- open <p>three", "one\ntwo"),
    ("<article></section></div></p></b>one</li><p>two</nav></article>", "one\ntwo"),
    ('<article><div class="share-price"><p>one</p></div><div class="social-science"><p>two</p></div><div class="share-buttons">x</div><div id="related-posts">y</div></article>', "one\ntwo"),
    (f'<article><div class="article-header"><h1>T</h1></div><header><p>by me</p></header><p>{PROSE}</p><div class="ad-box">Buy</div></article>', f"T\nby me\n{PROSE}"),
    (f'<form id=f><h1>T</h1><div>{f"<p>{PROSE}</p>" * 3}</div></form>', "\n".join(["T", PROSE, PROSE, PROSE])),
    (f'<div class="modal-wrapper">{f"<p>{PROSE}</p>" * 3}</div><p>x</p>', "\n".join([PROSE] * 3 + ["x"])),
    (f'<article><p>one, it is</p></article><div class=comments>{f"<p>{PROSE}</p>" * 9}</div>', "one, it is"),
    (f"<div class=row><article><p>{PROSE}</p></article></div><div class=row><article><p>{PROSE[::-1]}</p></article></div><div><article><a href=x>teaser, and a link</a></article></div>", f"{PROSE}\n{PROSE[::-1]}"),
    (f"<div><div class=head><h1>T</h1></div><div><div>{f'<p>{PROSE}</p>' * 4}</div></div></div>", "\n".join(["T"] + [PROSE] * 4)),
    (f"<article><header><h1>T</h1></header><div>{f'<p>{PROSE}</p>' * 60}</div></article>", "\n".join(["T"] + [PROSE] * 60)),
])
def test_malformed_and_misleading_markup(source, text):
    assert html_text.main_text(source) == text


def test_work_grows_with_the_page_only():
    import time

    n = 100_000
    pages = ["<div>" * n + "</section>" * n + "x", "<dl><dd><ul>" + "<div>" * n + "<dt>a</dt>" * n, "<center>" * n + "<p>a</p>" * n, "<p a=\"" * n, "<p a='x" * n, "<" * n, "<!--" * n, "<article>" * n + "x", "<div class=share>" * n + "x"]
    for page in pages:
        start = time.time()
        html_text.main_text(page)
        assert time.time() - start < 10, page[:30]


def test_deep_and_long_pages_finish():
    assert html_text.main_text("<div>" * 30000 + "deep") == "deep"
    assert html_text.main_text("<p>" * 30000 + "x <a href='") == "x"


def test_extraction_rows(spark):
    rows = [(i, None if i == 2 else "u", h, "c") for i, (h, _) in enumerate(PAGES)]
    df = spark.createDataFrame([*rows, rows[3], (None, None, None, "c")], "page_id long, url string, html string, text string")
    got = html_text.op6_html_extraction(df).collect()
    assert len(got) == len(rows) + 2 and {(r["page_id"], r["text"], r["n_chars"]) for r in got if r["page_id"] is not None} == {(i, t, len(t)) for i, (_, t) in enumerate(PAGES)}
    assert html_text.op6_html_extraction(df.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.op9_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("long"))).first()
    assert n > 100 and right / n > 0.97


def test_odd_texts(spark):
    rows = [(1, "the cat sat", "en", 0), (2, "der hund lief", "de", 0), (3, None, "en", 0), (4, "", None, 0), (5, "1234 !?", "en", 0), (None, "the dog", "de", 0), (6, "the end " * 60000, None, 0), (6, "the end", None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = language.op9_language_id(df).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {3, 4, 5}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True]
    assert {r["lang_pred"] for r in language.op9_language_id(df.where("lang is null")).collect()} == {"und"}
    assert language.op9_language_id(df.limit(0)).count() == 0


def test_every_label_is_learned_and_repeats_count_once(spark):
    """Many labels, a rare one, one without letters, and one row repeated many times."""
    letters = [chr(0x4E00 + 40 * i) + chr(0x4E01 + 40 * i) for i in range(500)]
    rows = [(10 * i + 1, f"{w} {w[::-1]} {w}", f"l{i:03}") for i, w in enumerate(letters)]
    rows += [(7, "same text", "rep")] * 3000 + [(6, "other text", "rep"), (8, "123", "none"), (9, "\U00030010\U00030011", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {(r["doc_id"], r["lang_pred"], r["held_out"]) for r in language.op9_language_id(df).collect()}
    taught = [i for i in range(500) if (10 * i + 1, f"l{i:03}", False) in got]
    assert len(taught) > 350 and all(p == f"l{i // 10:03}" for i, p, held in got if i % 10 == 1 and not held)
    assert {p for i, p, _ in got if i == 9} != {"und"} and {p for i, p, _ in got if i == 8} == {"und"}
    train = df.where("lang = 'rep'").select("doc_id", "text", "lang").withColumnRenamed("doc_id", "key")
    model = language.fit(train, max_sample=2)
    assert len(model.languages) == 2 and set(model.languages) == {"rep"}


def test_the_smallest_hashes_of_each_label(spark):
    rows = spark.range(0, 4000).selectExpr("IF(id % 10 = 0, 'b', 'a') AS lang", "xxhash64(id) AS h")
    got = {(r["lang"], r["h"]) for r in language.smallest(rows, 70).collect()}
    by = {x: sorted(r["h"] for r in rows.where(f"lang = '{x}'").collect())[:70] for x in "ab"}
    assert got == {(x, h) for x, hs in by.items() for h in hs}
    assert language.smallest(rows, 10**6).count() == 4000


def test_model_by_hand(spark):
    """Counts, document frequencies, weights and the nearest centroid, all by plain Python."""
    import math
    import random

    rng = random.Random(3)
    words = {"x": "kala mira sano veli".split(), "y": "brot grux schnel wolk".split()}
    rows = [(i, " ".join(rng.choice(words[g]) for _ in range(rng.randint(1, 9))) + rng.choice([".", "!", " 12"]), g) for i in range(60) for g in "xy"[i % 2]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.op9_language_id(df).collect()}

    def grams(text):
        clean = " " + "".join(c.lower() if c.isalpha() else " " for c in text)
        while "  " in clean:
            clean = clean.replace("  ", " ")
        return [clean[i : i + n] for n in (1, 2, 3) for i in range(len(clean) - n + 1)]

    def count(text):
        out = {}
        for g in grams(text):
            out[g] = out.get(g, 0) + 1
        return out

    for _, text, _ in rows[:20]:  # hashing only merges n-grams: totals and single counts agree
        n, c = language.counts(text), count(text)
        assert n.sum() == sum(c.values()) and (n > 0).sum() <= len(c) and n.max() >= max(c.values())
    train = [r for r in rows if not got[r[0]]["held_out"]]
    model = language.fit(spark.createDataFrame(train, "key long, text string, lang string"))
    seen = [language.counts(t) > 0 for _, t, _ in train]
    for d in range(0, 4096, 7):
        assert abs(model.idf[d] - (math.log((1 + len(train)) / (1 + sum(bool(s[d]) for s in seen))) + 1)) < 1e-5
    for i, text, _ in rows:
        n = language.counts(text)
        v = [math.log1p(x) * float(w) for x, w in zip(n, model.idf)]
        norm = math.sqrt(sum(x * x for x in v))
        cosine = [sum(float(c) * x for c, x in zip(row, v)) / norm for row in model.centroids]
        k = max(range(len(cosine)), key=lambda j: cosine[j])
        assert got[i]["lang_pred"] == model.languages[k] and got[i]["rejected"] == (cosine[k] < model.floors[k] - 1e-6 or got[i]["rejected"] and cosine[k] < model.floors[k] + 1e-6)
        assert abs(got[i]["score"] - max(0, cosine[k]) * (0.5 if got[i]["rejected"] else 1)) < 1e-3
    far = model.predict("zzzz qqqq zzzz")
    assert far[2] and far[0] in ("x", "y") and far[1] < 0.3


def test_ngram_counts_ignore_steps(monkeypatch):
    text = "Hello, wörld  of  n-grams! " * 20
    whole = language.counts(text)
    for step in (1, 2, 3, 7):
        monkeypatch.setattr(language, "STEP", step)
        assert (language.counts(text) == whole).all()


def test_extraction_of_whole_tables(spark):
    """Every page of a table against its article's blocks, taken apart by plain patterns."""
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.op6_html_extraction(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", "\0", article)).split("\0")
        text = "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
        assert got[r["page_id"]] == text, r["page_id"]


def test_kept_columns_with_dots_and_the_names_of_results(spark):
    pages = spark.createDataFrame([(1, "old", "x", "<p>Some text here.<br>and more</p>")], "`a.b` long, text string, score string, html string")
    got = html_text.extract(pages, ["a.b", "text", "score"])
    assert got.columns == ["a.b", "score", "text"] and tuple(got.first()) == (1, "x", "Some text here.\nand more")
    docs = spark.createDataFrame([(i, "the cat and the dog and the bird" if i % 2 else "le chat et le chien et la vache", "en" if i % 2 else "fr", 5.0) for i in range(20)], "`a.b` long, text string, lang string, score double")
    model = language.fit(docs.select(docs["`a.b`"].alias("key"), "text", "lang"))
    done = language.predict(docs, model, ["a.b", "score", "lang"])
    assert done.columns == ["a.b", "lang", "lang_pred", "score", "rejected"] and all(r["lang"] == r["lang_pred"] and r["score"] <= 1 for r in done.collect())
