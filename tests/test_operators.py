"""Operators whose odd cases the driver's tables don't have."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import classify, link, peaks, quality, rank
from millrace.plans.pages import robots_allowed
from millrace.session import ship_package
from millrace.streaming import files, state


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_merge_keeps_countries_apart_and_fills_in_source_order(spark):
    a = spark.createDataFrame([("acme", "BR", "Acme", "", 1), ("", "BR", "Nameless", "", 2), ("", "BR", "Nameless", "", 3)], "key string, pais string, nome string, email string, seq int")
    b = spark.createDataFrame([("acme", "US", "Acme Inc", "us@a.com", 1), ("acme", "BR", "ACME", "br@a.com", 2)], "key string, pais string, nome string, email string, seq int")
    c = spark.createDataFrame([("acme", "BR", "late", "late@a.com", 1)], "key string, pais string, nome string, email string, seq int")
    every = link.union_sources([d.withColumn("fonte", F.lit(n)) for n, d in (("one", a), ("two", b), ("three", c))])
    out = link.merge_entities(every, ["pais", "key"], F.col("key") == "", ["source_seq", "seq"], ["nome", "email"], "fonte")
    assert rows(out, "pais", "key", "nome", "email", "fonte", "n") == [
        ("BR", "", "Nameless", "", "one", 1), ("BR", "", "Nameless", "", "one", 1), ("BR", "acme", "Acme", "br@a.com", "one+three+two", 3), ("US", "acme", "Acme Inc", "us@a.com", "two", 1)]


def test_projection_takes_first_filled_synonym(spark):
    df = spark.createDataFrame([("", "Ltd", None)], "name string, company string, mail string")
    out = link.project(df, {"nome": ["name", "company"], "email": ["mail"], "uf": ["state"], "fonte": []}, {"fonte": "x"})
    assert tuple(out.first()) == ("Ltd", "", "", "x")


def test_token_and_prefix_pairs(spark):
    a = spark.createDataFrame([("acme data group",), ("beta",), ("gamma data",)], "a string")
    b = spark.createDataFrame([("data group",), ("beta max",), ("data",), ("group data",)], "b string")
    assert rows(link.token_pairs(a, b, "a", "b"), "a", "b") == [("acme data group", "data"), ("acme data group", "data group"), ("beta", "beta max"), ("gamma data", "data")]
    assert rows(link.prefix_pairs(a, b, "a", "b"), "a", "b") == [("beta", "beta max")]


@pytest.mark.parametrize("most", [100, 0])
def test_ranges_overlap_and_leave_gaps(spark, most):
    r = spark.createDataFrame([(0.0, 9.5, "a"), (5.0, 5.0, "b"), (-3000.0, 70000.0, "c"), (80000.0, 80001.5, "d"), (9.0, 1.0, "none")], "lo double, hi double, n string")
    v = spark.createDataFrame([(1, 5.0), (2, 9.5), (3, -3000.0), (4, 75000.0), (5, 80001.5), (6, None), (7, 5.0)], "i int, x double")
    got = [(i, n or "") for i, n in ((r["i"], r["n"]) for r in link.in_ranges(v, "x", r, most).collect())]
    assert sorted(got) == [(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "c"), (3, "c"), (4, ""), (5, "d"), (6, ""), (7, "a"), (7, "b"), (7, "c")]


def test_longest_suffix(spark):
    df = spark.createDataFrame([(1, "a.example.com"), (2, "b.com"), (2, "b.com"), (3, "c.br"), (4, None), (5, "")], "i int, h string")
    dim = spark.createDataFrame([("com", "C"), ("example.com", "E"), ("", "none")], "s string, v string")
    assert rows(link.longest_suffix(df, F.col("h"), dim, "s", "v", "z").fillna("", ["z"]), "i", "z") == [(1, "E"), (2, "C"), (2, "C"), (3, ""), (4, ""), (5, "")]


def test_cascade_takes_the_strictest_kind(spark):
    new = spark.createDataFrame([(1, "g", "x"), (2, "g", "y"), (3, "h", "x"), (4, "g", None)], "new int, g string, k string")
    old = spark.createDataFrame([(9, "g", "x"), (2, "g", "x"), (5, "g", "y")], "old int, g string, k2 string")
    kinds = [(F.col("new"), F.col("old")), (F.col("k"), F.col("k2"))]
    assert rows(link.cascade(new, old, "g", kinds, "new", "old"), "new", "old", "priority") == [(1, 2, 1), (2, 2, 0)]


@pytest.mark.parametrize("total", [4, 10, 17, 30, 99])
def test_apportionment_sums_up(spark, total):
    base = {"P1": 10, "P2": 8, "P3": 6, "P4": 6}
    got = {r["v"]: r["share"] for r in rank.apportion(spark.createDataFrame(list(base.items()), "v string, base int"), [], "base", "v", total).collect()}
    assert sum(got.values()) == min(total, 30) and all(got[k] <= base[k] for k in base)


def test_round_robin_order(spark):
    df = spark.createDataFrame([("a", 9, 1), ("a", 8, 2), ("b", 7, 3), ("c", 10, 4), ("a", 1, 5)], "g string, score int, i int")
    assert [r["i"] for r in rank.interleave(df, ["g"], ["-score", "i"], 4).collect()] == [4, 1, 3, 2]


def test_vocabulary_starts_words(spark):
    cases = [("Synthetically made, SYNTHÉTIC data", 2), ("polysynthetic", 0), ("", 0), (None, 0), ("c++ and c+", 1)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(classify.hits(F.col("t"), ["synthetic", "c++"])).collect()] == [n for _, n in cases]


def test_scores_and_families(spark):
    df = spark.createDataFrame([("how does it work?",), ("it works.",)], "s string")
    got = [r[0] for r in df.select(classify.sentence_score(F.col("s"), F.lit(2), ["how", "what"])).collect()]
    assert got == [round(5.5 - 17 / 400, 6), round(4 - 9 / 400, 6)]
    fam = [r[0] for r in df.select(classify.family_by_ratio(F.lit("synthetic synthetic survey"), ["synthetic"], ["survey"])).limit(1).collect()]
    assert fam == ["new"]


def test_evaluation_without_counts_is_null(spark):
    gold = spark.createDataFrame([(1, "a"), (2, "a"), (1, "b")], "i int, c string")
    found = spark.createDataFrame([(1, "a"), (3, "c")], "i int, c string")
    got = {r["c"]: (r["tp"], r["fp"], r["fn"], r["precision"], r["recall"]) for r in classify.evaluate(gold, found, "i", "c").collect()}
    assert got["a"] == (1, 0, 1, 1.0, 0.5) and got["b"] == (0, 0, 1, None, 0.0) and got["c"] == (0, 1, 0, 0.0, None) and got["*"][:3] == (1, 1, 2)


def test_peak_curves(spark):
    df = spark.createDataFrame([("s1", "seg", 9, 10), ("s1", "seg", 10, 30), ("s1", "seg", 11, 30), ("s1", "dom", 9, 0), ("s2", "seg", 10, 50), ("s2", "seg", 20, 5), ("s3", "seg", 10, 0)], "loja string, dia string, hour int, value int")
    got = {(r["loja"], r["dia"]): (r["peak"], r["peak_value"], r["top"], r["index"], r["mean"], r["closed"]) for r in peaks.daily_peaks(df, ["loja", "dia"]).collect()}
    assert got[("s1", "seg")] == (10, 30, "10,11,9", 70, 23.3, False) and got[("s1", "dom")] == (None, None, "", 0, None, True)
    g = peaks.group_curve(df.withColumn("marca", F.lit("m")), ["marca", "dia"], "loja").collect()
    assert [(r["dia"], r["n"], r["peak"], r["h10"], r["h20"], r["h12"]) for r in g] == [("seg", 2, 10, 40.0, 5.0, None)]


def test_rules_and_plans(spark):
    df = spark.createDataFrame([(1, "a — b", ["x", "x"]), (2, "not just a but b R$ 5", ["y"])], "i int, t string, used array<string>")
    assert rows(df.select("i", F.array_join(quality.style_faults(F.col("t"), ["b"]), ",").alias("f")), "i", "f") == [(1, "dash,word"), (2, "word,contrast,price")]
    plan = {r["i"]: (r["missing"], r["unused"], r["repeated"]) for r in quality.plan_faults(df, "i", ["x", "z"], "used", ["y"]).collect()}
    assert plan == {1: (["z"], ["y"], ["x"]), 2: (["x", "z"], [], [])}
    assert rows(quality.violations(df, "i", {"long": F.length("t") > 10, "unknown": F.lit(None).cast("boolean")}), "i", "rule") == [(2, "long")]


def test_robots(spark):
    rules = [("disallow", "/"), ("allow", "/sitemap/*/x"), ("allow", "/a$"), ("disallow", "/a?b"), ("disallow", "")]
    cases = [("/x", False), ("/sitemap/1/x/y", True), ("/a", True), ("/ab", False), ("/a?b=1", False)]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(cases)], "i int, p string")
    assert [r[0] for r in df.orderBy("i").select(robots_allowed(F.col("p"), rules)).collect()] == [e for _, e in cases]


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    ship_package(spark)
    at = lambda m: datetime.datetime(2026, 1, 1, 0, 0) + datetime.timedelta(minutes=m)
    first = [("u", 1, at(0)), ("u", 2, at(5)), ("v", 3, at(0))]
    second = [("u", 4, at(14)), ("u", 5, at(15)), ("v", 6, at(15))]
    land = lambda part, n: spark.createDataFrame(part, "k string, i int, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "landed"))
    land(first, 0)
    make = lambda: state.failure_window(files.file_stream(spark, str(tmp_path / "landed")), "k", "ts", "i", limit=2, seconds=900)
    assert rows(files.run_to_end(make(), str(tmp_path / "out")), "i", "n", "blocked") == [(1, 1, False), (2, 2, False), (3, 1, False)]
    land(second, 1)
    assert rows(files.run_to_end(make(), str(tmp_path / "out")), "i", "n", "blocked")[3:] == [(4, 3, True), (5, 1, False), (6, 1, False)]


def test_quota_repeats_are_free(spark, tmp_path):
    ship_package(spark)
    spark.createDataFrame([("p", i, q) for i, q in enumerate(["a", "b", "a", "c", "d", "b"])], "k string, i int, q string").coalesce(1).write.parquet(str(tmp_path / "landed"))
    out = files.run_to_end(state.within_quota(files.file_stream(spark, str(tmp_path / "landed")), "k", "q", ["i"], 3), str(tmp_path / "out"))
    assert rows(out, "i", "accepted") == [(0, True), (1, True), (2, True), (3, True), (4, False), (5, True)]


def test_source_predicates(spark):
    from millrace.operators import filters

    df = spark.createDataFrame([("Ágil Pesquisas", -16.6, -49.2, "7320-3/00", "1,7320-3/00"), ("Dr. Ana", None, -49.2, "1", "2")], "nome string, lat double, lng double, p string, s string")
    got = [tuple(r) for r in df.select(
        filters.is_company(F.col("nome")), filters.in_box(F.col("lat"), F.col("lng"), -17, -50, -16, -49), filters.activity_role(F.col("p"), F.col("s"), "7320-3/00"),
        filters.activity_role(F.lit("9"), F.col("s"), "7320-3/00"), filters.is_brand(F.col("nome"), "agil", "xyz"), filters.normal_status(F.col("p"), {"1": "valido"}),
    ).collect()]
    assert got == [(True, True, "principal", "secundaria", True, "indeterminado"), (False, False, None, None, False, "valido")]
    assert filters.without_names(df, "nome", ["ANA"]).count() == 1
    s = spark.createDataFrame([("a", "q1", 1), ("a", "q2", 2), ("a", "q1", 3), ("a", "q3", 4)], "k string, q string, o int")
    assert rows(filters.within_ceiling(s, ["k"], "q", "o", 2), "q", "o") == [("q1", 1), ("q1", 3), ("q2", 2)]
    t = filters.expanded_queries(spark.createDataFrame([("x",)], "t string"), "t", ["what is {}", "{} price"])
    assert rows(t, "ord", "consulta") == [(0, "what is x"), (1, "x price")]
    c = filters.approved(spark.createDataFrame([("synthetic data platform",), ("platform",), (None,)], "h string"), "h", "platform", "synthetic")
    assert sorted(map(tuple, c.select("motivo", "aprovada").collect())) == [("", True), ("no offer", False), ("off topic", False)]


def test_extraction_takes_pages_in_order(spark):
    from millrace.operators import extract

    pages = spark.createDataFrame([("a", "u2", 1, "Founded in 2015 by two people in Berlin."), ("a", "u1", 0, "We were founded in 2012, as a company. Nothing else is said here."), ("b", "u3", 0, "No such thing is said on this page.")], "c string, url string, priority int, text string")
    s = extract.page_sentences(pages, "c", "url", "text", "priority")
    got = {r["c"]: r for r in extract.first_match(s, "c", {"year": r"founded in (\d{4})", "hq": r"in (Berlin|Paris)"}).collect()}
    assert (got["a"]["year"]["valor"], got["a"]["year"]["url"], got["a"]["hq"]["valor"], got["b"]["year"]["tipo"]) == ("2012", "u1", "Berlin", "not found")
    names = spark.createDataFrame([("Acme", 1), ("Acme Labs", 0), ("Be", 2)], "n string, o int")
    texts = spark.createDataFrame([(1, "By ACME labs, in 2026"), (2, "acmelabs"), (3, "To be or not")], "k int, t string")
    assert rows(extract.mentions(texts, "k", "t", names, "n", "o"), "k", "n") == [(1, "Acme Labs"), (3, "Be")]
    assert [r[0] for r in spark.sql("SELECT 'so: [{\"a\": 1}] ok' AS x").select(extract.answered(F.col("x"), "ARRAY<STRUCT<a INT>>")).collect()][0][0]["a"] == 1


def test_similar_items_of_other_owners(spark):
    df = spark.createDataFrame([(1, "o1", ["a", "b", "c", "d"]), (2, "o2", ["b", "c", "d"]), (3, "o3", ["a", "b"]), (4, "o1", ["b", "c", "d", "a"]), (5, "o4", ["d", "c", "b", "z", "b"])], "i int, o string, t array<string>")
    assert rows(link.similar_elsewhere(df, "i", "o", "t"), "i", "others") == [(1, 2), (2, 2), (4, 2), (5, 2)]


def test_similar_items_of_many_owners_compare_no_pairs(spark, monkeypatch):
    import random

    draw = random.Random(4)
    items = [(i, f"o{draw.randrange(150)}", sorted({f"t{int(draw.random() ** 2 * 60)}" for _ in range(draw.randrange(1, 9))})) for i in range(400)] + [(400, None, ["t0", "t1", "t2"])]
    expected = {i: len({p for _, p, u in items if p and p != o and len(set(t) & set(u)) >= 3}) for i, o, t in items if o}
    df = spark.createDataFrame(items, "i int, o string, t array<string>")
    monkeypatch.setattr(link, "_prefix_elsewhere", None)
    for most in (0, 60, 10_000):  # all triples counted by aggregation, some, none
        assert dict(rows(link.similar_elsewhere(df, "i", "o", "t", most=most), "i", "others")) == {i: n for i, n in expected.items() if n}
    group, owner, sizes = link.np.array([0, 0, 0, 1]), link.np.array([0, 70, 1, 2]), link.np.array([4, 3, 3, 3])
    tokens = link.np.array([5, 6, 7, 8, 5, 6, 7, 6, 7, 8, 5, 6, 7])
    for most in (1, 2, 100):  # rows of a group that share two tokens, in parts of any size
        assert {b: x.tolist() for b, x in link._shared_pairs(group, owner, sizes, tokens, most)} == {0: [2, 3, 1, 0], 1: [128, 0, 128, 0]}


def test_similar_items_shuffle_little(spark):
    import random

    def shuffled():
        executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
        return sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))

    draw = random.Random(5)
    items = [(i, f"o{i % 9}", [f"w{int(draw.random() ** 2 * 4000):04}" for _ in range(12)]) for i in range(10_000)]
    before = shuffled()
    link.similar_elsewhere(spark.createDataFrame(items, "i int, o string, t array<string>"), "i", "o", "t").collect()
    assert shuffled() - before < 4 * sum(len(w) for _, _, t in items for w in t)


def test_similar_items_in_many_numbers_and_copies(spark, monkeypatch):
    items = [(i, f"o{i % 3}", list("abcdz" if i % 2 else "bcde")) for i in range(60)] + [(60, "o4", list("xyz")), (61, "o5", list("xay")), (62, "o6", ["x", None, "a", "y"])]
    df = spark.createDataFrame(items, "i int, o string, t array<string>").repartition(3)
    expected = [(i, 2) for i in range(60)] + [(61, 1), (62, 1)]
    assert rows(link.similar_elsewhere(df, "i", "o", "t"), "i", "others") == expected
    monkeypatch.setattr(link, "MAX_BROADCAST_TOKENS", 0)
    monkeypatch.setattr(link, "MAX_BROADCAST_OWNERS", 0)
    assert rows(link.similar_elsewhere(df, "i", "o", "t"), "i", "others") == expected
    batches = [link.pa.RecordBatch.from_arrays([link.pa.array(k, "int64")], names=["k"]) for k in ([1, 1, 2], [], [2, 2], [2, 3, 3], [4])]
    assert [t["k"].to_pylist() for t in link._rows_upto(iter(batches), "k", 3)] == [[1, 1], [2, 2, 2, 2], [3, 3], [4]]
    numbers = [link.np.array(x, t) for x, t in (([1, -5, 1 << 40], "int64"), ([], "int32"), ([7, -1], "int32"))]
    assert [x.tolist() for x in link._unpacked(link._packed(*numbers), (3, "int64"), (0, "int32"), (2, "int32"))] == [x.tolist() for x in numbers]
