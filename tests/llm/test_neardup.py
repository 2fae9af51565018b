"""Near duplicates against every pair of a small corpus, and against the rare cases."""

import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import common, neardup
from millrace.llm.common import connected_components

WORDS = [a + b for a in "ka lo mi ne ru sa to vi".split() for b in "x y z q w".split()]


def corpus(seed, groups=12, copies=14):
    """Groups of copies with one to many edits, so that similarities straddle the threshold."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [rng.choice(WORDS) for _ in range(rng.choice([1, 2, 3, 12, 60, 150]))]
        texts.append(base)
        for _ in range(rng.randint(1, copies)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS) + str(rng.randint(0, 10**6))
            texts.append(copy)
    rng.shuffle(texts)
    return [(i * 7 + 3, " ".join(t) if i % 3 else "\t".join(t).upper()) for i, t in enumerate(texts)]


def by_hand(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            n = len(sets[a] & sets[b])
            if n and n * 100 >= len(sets[a] | sets[b]) * percent and find(a) != find(b):
                comp[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 3, 85), (2, 5, 80)])
def test_components_equal_all_pairs(spark, seed, size, percent):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in neardup.near_duplicates(df, shingle=size, percent=percent).collect()}
    assert got == by_hand(rows, size, percent)


def test_loosely_similar_group_is_resolved_exactly(spark):
    rng = random.Random(9)
    base = [rng.choice(WORDS) + str(i) for i in range(120)]
    rows = []
    for i in range(90):  # copies of one text at all distances, linked by chains
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = f"new{i}{rng.random()}"
        rows.append((1000 - i, " ".join(copy)))
    got = {r["doc_id"]: tuple(r)[1:] for r in neardup.op1_minhash_near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == by_hand(rows, 3, 85)


def test_repeated_rows_in_a_loosely_similar_group(spark):
    """Rows of one id count once in the prefix join, other texts of the id on their own."""
    rng = random.Random(9)
    base = [rng.choice(WORDS) + str(i) for i in range(120)]
    rows = []
    for i in range(90):
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = f"new{i}{rng.random()}"
        rows.append((1000 - i, " ".join(copy)))
    df = spark.createDataFrame(rows + rows[::2], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in neardup.op1_minhash_near_dedup(df).collect()}
    assert got == by_hand(rows, 3, 85)

    rows = [(1, "a b c d"), (1, "A b c d"), (1, "x y z"), (2, "x y z")]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string").repartition(4)
    marks = [neardup.fingerprint(next(neardup.shingle_sets(pa.array([t]), 3))) for _, t in rows]
    wanted = spark.createDataFrame([(10, 1, *map(int, marks[0])), (20, 1, *map(int, marks[2]))], "id long, rep long, f1 long, f2 long")
    sets = neardup.full_sets(docs, wanted, "doc_id", "text", 3)
    assert sorted((r["id"], len(r["set"])) for r in sets.collect()) == [(10, 2), (20, 1)]

    pair = [base[:60], [*base[:59], "other"]]
    rest = spark.createDataFrame([(i, i, True) for i in (1, 2)], "id long, comp long, minor boolean")
    texts = [" ".join(t) for t in pair]
    twice = spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts) for _ in range(2 - i)], "doc_id long, text string")
    marks = [neardup.fingerprint(next(neardup.shingle_sets(pa.array([t]), 3))) for t in texts]
    wanted = spark.createDataFrame([(i + 1, i + 1, *map(int, m)) for i, m in enumerate(marks)], "id long, rep long, f1 long, f2 long")
    assert [tuple(r) for r in neardup._prefix_pairs(rest, neardup.full_sets(twice, wanted, "doc_id", "text", 3), 85).collect()] == [(1, 2)]


def test_odd_rows(spark):
    rows = [(5, None, 1, "f"), (4, "", 1, "f"), (3, "one", 1, "f"), (2, "ONE", 1, "f"), (None, "one", 1, "f"), (9, "a\x00b c d", 1, "f"), (9, "a\x00b c d", 1, "f"), (8, "a b c d", 1, "f"), (7, "w " * 90000, 1, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, f1 string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in neardup.op1_minhash_near_dedup(df).collect())
    assert got == sorted([("5", 0, "5", True), ("4", 0, "4", True), ("3", 1, "2", False), ("2", 1, "2", True), ("None", 1, "None", True), ("9", 1, "9", True), ("9", 1, "9", True), ("8", 2, "8", True), ("7", 1, "7", True)])
    left = neardup.drop_near_duplicates(df)
    assert left.columns == df.columns and left.count() == 8
    assert neardup.op1_minhash_near_dedup(df.limit(0)).count() == 0


def test_an_id_with_several_texts_loses_none(spark):
    """Rows are told apart by id and text, in the operator and in the pipeline's stage."""
    import corpus_pipeline

    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    near = a + " more"
    shapes = [
        ([(5, a), (5, b), (1, b), (7, a)], {(5, a): 5, (5, b): 1, (1, b): 1, (7, a): 5}, [(1, b), (5, a)]),
        ([(5, a), (5, b), (7, a), (7, b)], {(5, a): 5, (5, b): 5, (7, a): 5, (7, b): 5}, [(5, a), (5, b)]),
        ([(5, a), (5, a), (6, a), (5, b)], {(5, a): 5, (6, a): 5, (5, b): 5}, [(5, a), (5, a), (5, b)]),
        ([(5, ""), (5, a), (3, a), (None, a), (5, None)], {(5, ""): 5, (5, a): 3, (3, a): 3, (None, a): None, (5, None): 5}, [(None, a), (3, a), (5, ""), (5, None)]),
    ]
    for rows, want, left in shapes:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        components = neardup.classed(df, shingle=3, percent=85).select("id", "component_id").collect()
        assert sorted(map(repr, map(tuple, components))) == sorted(repr((k[0], want[k])) for k in rows)
        for got in (neardup.drop_near_duplicates(df), corpus_pipeline.near_dedup(spark, df, "")):
            assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, left))
    # many texts under few ids, at all distances: as many components as the texts have, none lost
    rng = random.Random(9)
    base = [rng.choice(WORDS) + str(i) for i in range(120)]
    texts = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = f"new{i}{rng.random()}"
        texts.append(" ".join(copy))
    apart = by_hand(list(enumerate(texts)), 3, 85)
    df = spark.createDataFrame([(i % 5, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    left = [r["text"] for r in neardup.drop_near_duplicates(df, shingle=3, percent=85).collect()]
    assert sorted(apart[texts.index(t)][1] for t in left) == sorted({c for _, c, _ in apart.values()})
    # two near copies under one id: one of them stays, and of the copies under other ids none
    df = spark.createDataFrame([(5, a), (5, near), (6, near)], "doc_id long, text string")
    assert [r["doc_id"] for r in neardup.drop_near_duplicates(df).collect()] == [5]


def test_ids_beyond_the_bitmap_are_joined(spark, monkeypatch):
    assert [neardup.id_bits(n) for n in (0, 1, 10**4, 10**7, 10**8)] == [1 << 16, 1 << 16, 1 << 17, 1 << 27, 0]
    rows = corpus(3, groups=6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(neardup, "MAX_ID_BITS", 1)
    got = {r["doc_id"]: tuple(r)[1:] for r in neardup.op1_minhash_near_dedup(df).collect()}
    assert got == by_hand(rows, 3, 85)


def test_a_hub_of_many_near_copies(spark):
    """One text and many copies of it with a word of their own: one component, and other columns, dots in names too, stay."""
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*base, f"own{i}"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int").repartition(6)
    got = neardup.op1_minhash_near_dedup(df)
    assert {(r["component_id"], r["kept"]) for r in got.where("doc_id > 0").collect()} == {(0, False)}
    left = neardup.drop_near_duplicates(df)
    assert left.columns == df.columns and [r["doc_id"] for r in left.collect()] == [0]


def test_components_of_a_star_and_of_too_few_rounds(spark, monkeypatch):
    n = 200_000
    star = spark.range(1, n + 1).selectExpr("id AS a", "0 AS b")
    for most in (common.MANY_EDGES, 0):  # both ways to join the minima
        monkeypatch.setattr(common, "MANY_EDGES", most)
        got = connected_components(star)
        assert got.count() == n + 1 and got.where("component <> 0").count() == 0
    with pytest.raises(RuntimeError):
        connected_components(spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long"), rounds=1)


def test_odd_sketch_estimates_high_similarity():
    sampler = neardup.Sampler()
    rng = np.random.default_rng(4)
    for j, closer in ((0.95, True), (0.85, True), (0.4, False)):
        for _ in range(40):
            n = 600
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            b = a.copy()
            b[: round(n * (1 - j) / (1 + j))] = rng.integers(0, 2**63, round(n * (1 - j) / (1 + j)), dtype=np.uint64)
            x, y = (sampler.sketch(sampler.samples(s)) for s in (a, b))
            ones = int(np.unpackbits((x ^ y).view(np.uint8)).sum())
            assert (ones <= neardup.largest_distance(85)) == closer


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 300)] + [(1000, 1001), (7, 7), (None, 4)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 301)}, 1000: 1000, 1001: 1000}


def test_words_ignore_slice_borders(monkeypatch):
    from millrace.llm import words

    text = pa.array(["ab cd  ef", None, "", "gh", "x" * 50 + " y"])
    whole = words.hash_words(text, neardup.TABLE)
    monkeypatch.setattr(words, "SLICE", 3)
    parts = words.hash_words(text, neardup.TABLE)
    assert [w.tolist() for w in whole[1]] == [w.tolist() for w in parts[1]] and whole[0].tolist() == parts[0].tolist() == [0, 3, 3, 3, 4, 6]
