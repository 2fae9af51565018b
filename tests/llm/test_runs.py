"""Periodic runs against their definition, and the query's digests against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np

from millrace.llm import queries, runs

SF = "/root/testdata/sf0.001"


def by_definition(s):
    """(start, end, smallest period) of every stretch that repeats itself and can't be made longer."""
    found = {}
    for q in range(1, len(s) // runs.MIN_COPIES + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j > i and j - i + q >= max(runs.MIN_WORDS, runs.MIN_COPIES * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b, q) for (a, b), q in found.items())


def digest_row(doc_id, text):
    """The query's row of one document, by hand."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = by_definition(w)
    drop = {i for s, e, q in found for i in range(s + q, e)}
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    best = None
    for s, e, q in found:
        if best is None or (e - s) * best[2] > best[1] * q:
            best = (s, e - s, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def plain(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_runs_of_many_sequences():
    rng = random.Random(5)
    seen = 0
    for _ in range(3000):
        s = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            a, q = rng.randrange(len(s) + 1), rng.randint(1, 7)
            s[a:a] = (s[a : a + q] * 40)[: rng.randint(1, 45)]
        if s and rng.random() < 0.5:  # copies of runs, those of copies too
            s = s + [9] + s[rng.randrange(len(s)) :] + [8] + s
        want = by_definition(s)
        seen += len(want)
        assert runs.runs_of(np.array(s, np.int64)) == want, s
    assert seen > 2000


def test_long_sequences_are_not_quadratic():
    one = runs.runs_of(np.zeros(200_000, np.int64))
    assert one == [(0, 200_000, 1)]
    rng = np.random.default_rng(1)
    s = np.r_[rng.integers(0, 9000, 50_000), np.tile(rng.permutation(5000), 30)]
    assert (50_000, 200_000, 5000) in [(a, b, q) for a, b, q in runs.runs_of(s) if q > 1000]


def test_query_on_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert plain(queries.queries()["op11_periodic_runs"](spark, SF)) == sorted(map(repr, (digest_row(*d) for d in docs)))


def test_odd_rows(spark):
    planted = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0]
    free = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10]
    texts = [None, "", " \t\n", "one", "a a a a a", "a a a a a a", "x " * 50, "A a " * 9, "é é " * 7, "a\x00b " * 8, "p q r\n" * 30 + "end " + "p q r " * 5, "word " * 20_000 + "tail"]
    rows = [(i, t, 1, "r", "t") for k in (planted, free) for i, t in zip(k, texts)]
    rows += [(None, "z z z z z z z", 1, "r", "t"), rows[-1], rows[-1]]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, row string, t string").repartition(3)
    assert plain(runs.op11_periodic_runs(df)) == sorted(map(repr, (digest_row(r[0], r[1]) for r in rows)))
    assert runs.op11_periodic_runs(df.limit(0)).count() == 0
    whole = runs.periodic_runs(df.where("text like 'p q r%'").limit(1)).first()
    assert whole["row"]["t"] == "t" and whole["collapsed"] == "p q r end p q r" and [tuple(r) for r in whole["runs"]] == [(0, 90, 3), (91, 15, 3)]


def test_slices_and_batches_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 80)))) for i in range(200)]
    import pyarrow as pa

    at, found, _ = runs._find(pa.array([t for _, t in rows]))
    row = np.searchsorted(at, [s for s, _, _ in found], side="right") - 1
    got = [(int(r), int(s - at[r]), int(e - at[r]), p) for r, (s, e, p) in zip(row, found)]
    assert got == [(i, *x) for i, (_, t) in enumerate(rows) for x in by_definition(t.split())]
