"""Source divergence against plain Python, tries against dictionaries, bounds lowered so that every way is walked."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from millrace.llm import divergence


def by_hand(rows, min_docs=divergence.MIN_DOCS, top=divergence.TOP):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s))
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if groups[s][t] > 0 and p[s][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)}
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = ["alpha", "al", "alp", "beta", "Beta", "été", "ÉTÉ", "z", "日本", "a" * 3000] + [f"w{chr(97 + i)}{chr(97 + i % 7)}" for i in range(26)]
    rows = [(" ".join(rng.choice(words[: rng.randint(1, len(words))]) for _ in range(rng.randint(0, 30))), rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s1", "s1", "s2", "S3", "é", None])) for _ in range(n)]
    return rows + [(None, "xx", "only"), ("", "yy", "a"), ("...", "yy", "b"), ("rare words", "yy", "b")] + [("same row", "en", "s1")] * 12


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_plain_python(spark):
    rows = corpus(1)
    df = spark.createDataFrame([(*r, i, 1) for i, r in enumerate(rows)], "text string, lang string, source string, doc_id int, n int").repartition(5)
    assert found(divergence.op13_source_divergence(df)) == by_hand(rows)
    assert divergence.op13_source_divergence(df.limit(0)).count() == 0


def test_small_bounds_change_nothing(spark, monkeypatch):
    """Many small tries and several blocks of groups."""
    rows = corpus(2)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    monkeypatch.setattr(divergence, "CELLS", 7)
    kept = divergence.term_counts(df)
    for size in (6, 100):
        assert found(divergence.divergences(kept, max_groups=size)) == by_hand(rows)
    assert found(divergence.divergences(divergence.term_counts(df, min_docs=3), top=2)) == by_hand(rows, 3, 2)


def test_tries_are_flushed_and_merge(monkeypatch):
    import pyarrow as pa

    rng = random.Random(4)
    words = ["a", "ab", "abc", "b", "é", "ê", "k" * 500, "k" * 500 + "a", "k" * 499 + "z", *(f"k{'k' * i}" for i in range(20))]
    batches = [[" ".join(rng.choice(words) for _ in range(4)) for _ in range(3)] for _ in range(80)]
    want = defaultdict(Counter)
    for texts in batches:
        for lang, source, t in zip("xyx", "sst", texts):
            want[lang].update({(w, source): c for w, c in Counter(t.split()).items()})
            want[lang].update({(w, None): 1 for w in set(t.split())})
    for most, burst in ((3, 1), (50, 2), (10**6, 5), (10**6, 1024)):
        monkeypatch.setattr(divergence, "MAX_COUNTERS", most)
        monkeypatch.setattr(divergence, "BURST", burst)
        tries, whole, flushed = divergence.Tries(), divergence.Tries(), 0
        for texts in batches:
            divergence._count(pa.record_batch({"lang": ["x", "y", "x"], "source": ["s", "s", "t"], "t": texts}), tries)
            if tries.full:
                for batch in tries.leaves(rows=7):
                    whole.merge(batch)
                tries.clear()
                flushed += 1
        for batch in tries.leaves():
            whole.merge(batch)
        assert (flushed > 0) == (most < 100)
        for lang, trie in whole.by_lang.items():
            leaves = list(trie.walk())
            assert [t for t, _ in leaves] == sorted({t for t, _ in leaves})
            assert {(t.decode(), s): n for t, c in leaves for s, n in c.items() if t} == dict(want[lang])


def test_shares_are_exact_beyond_64_bits():
    count = np.array([0, 5, 10**13, 3 * 10**15], np.int64)
    total = int(count.sum())
    assert divergence.share(count, total, 4).tolist() == [1 + 10**9 * (int(c) + 2) // (total + 8) for c in count]
