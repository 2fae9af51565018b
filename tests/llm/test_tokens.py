"""Token attribution and packing against the vocabulary's own library and plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import decontam, packing, tokens

TEXTS = [
    None, "", "a", "Hello  world\n\n naïve   ", "x\ty<|endoftext|>z", "日本語 テキスト\n" * 3, "ab" * 5000, "word " * 3000, "  lead\r\n\x0b end", "It's 'llama' 12345 !!! ",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def test_pieces_round_trip(spark, library):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "no id")] + [(9, "It's 'llama' 12345 !!! ")], "doc_id long, text string")
    rows = packing.op7_best_fit_packing(df).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert len(by[9]) == 2 and len(by[None]) == 1
    for i, text in enumerate(TEXTS[:-1]):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r["piece"])):
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(part.tobytes())) and (k == 0 or r["length"] == 1024)
            at += r["length"]
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for q in sequences.values():
        at = 0
        for offset, length in sorted(q):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.op7_best_fit_packing(df.limit(0)).count() == 0


def test_long_runs_are_encoded_as_the_library_does(library):
    """Runs of white space that the pattern can't look over, alone and between words, and other long pieces."""
    with open(tokens.vocabulary_path(), "rb") as file:
        encoder = tokens.Encoder(file.read())
    runs = [" " * 10**6, "\n" * 600000, "\t " * 30000, "\r\n\u3000" * 20000, " " * 4096, "\n" * 4095, "\x1c" * 5000, "\u2003" * 5000 + "\x85" * 5000]
    for run in runs:
        for text in (run, f"word{run}word", f"a{run}", f"{run}é", f"x{run}<|endoftext|>{run}y", f"{run}'s{run}12"):
            assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, (run[:3], len(run), text[:2])
    for text in ("a" * 10**5, "=-" * 30000):
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.ids("x" + " " * 10**7 + "y").tolist() == [*encoder.ids("x"), *[encoder.ids(" ")[0]] * (10**7 - 1), *encoder.ids(" y")]


def test_a_document_of_white_space_is_counted_and_packed(spark):
    df = spark.createDataFrame([(1, "s", "a" + " " * 10**6 + "b"), (2, "s", "\n" * 10**6)], "doc_id long, source string, text string")
    counted = {r["doc_id"]: r["n_tokens"] for r in tokens.op4_token_counts(df).select("doc_id", "n_tokens").collect()}
    packed = {r["doc_id"]: r["n"] for r in packing.op7_best_fit_packing(df).groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert set(counted) == set(packed) == {1, 2} and all(n >= 10**5 for n in [*counted.values(), *packed.values()])


def test_spans_equal_offsets(spark, library):
    texts = ["plain text, two words", "", None, "naïve 日本語 😀 end\n\n x", "word " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in tokens.token_spans(df).collect():
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False)
        assert r["tokens"] == want.ids and list(zip(r["starts"], r["ends"])) == want.offsets, r["doc_id"]


def fewest(items, capacity):
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= items[i] and rooms[j] not in rooms[:j]:
                rooms[j] -= items[i]
                go(i + 1, rooms)
                rooms[j] += items[i]
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def flat(count):
    return sorted((k for k, n in count.items() for _ in range(n)), reverse=True)


def test_reduction_never_costs_a_sequence():
    rng = random.Random(5)
    for _ in range(400):
        capacity = rng.choice([10, 20, 30])
        count = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 8)))
        plan, left = packing.Plan(), dict(count)
        packing.reduce_by_dominance(left, capacity, plan)
        assert plan.sequences + fewest(flat(left), capacity) == fewest(flat(count), capacity)


def test_plan_is_a_packing():
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.choice([10, 64, 1024])
        count = {k: rng.randint(1, 40) for k in rng.sample(range(1, capacity + 1), rng.randint(1, 10))}
        fill, used = defaultdict(list), Counter()
        for length, a, b, first, copies, offset in packing.plan_packing(count, capacity).runs:
            for r in range(a, b):
                fill[first + (r - a) // copies].append((offset + (r - a) % copies * length, length))
                used[length] += 1
        assert used == count
        for q in fill.values():
            at = 0
            for offset, length in sorted(q):
                assert offset == at
                at += length
            assert at <= capacity


def by_offsets(library, texts, rule):
    """(tokens of each field, of each line of the last field) by the library's own offsets."""
    whole = "\n".join(t or "" for t in texts)
    spans = [(a, b) for a, b in library.encode(whole, add_special_tokens=False).offsets]
    at, fields = 0, []
    for t in texts:
        fields.append(at)
        at += len(t or "") + 1
    lines = [fields[-1]] + [i + 1 for i in range(fields[-1], len(whole)) if whole[i] == "\n" and i + 1 < len(whole)]
    owner = lambda bounds: Counter(max(i for i, x in enumerate(bounds) if x <= (a if rule == "first" else max(a, b - 1))) for a, b in spans)
    f, s = owner(fields), owner(sorted({*fields, *lines}))
    skip = len({*fields, *lines}) - len(lines)
    return [f[i] for i in range(len(fields))], [s[i + skip] for i in range(len(lines))]


@pytest.mark.parametrize("rule", ["first", "last"])
def test_attribution_equals_offsets(spark, library, rule):
    rows = [(1, "src", "plain text\nsecond line, longer\n\n\nlast"), (2, "a b", ""), (3, None, None), (4, "s", "x\n\n   \n y\n"), (4, "s", "x\n\n   \n y\n")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = tokens.token_counts(df, ["source", "text"], rule=rule).collect()
    assert len(got) == len(rows)
    for i, source, text in rows:
        r = next(r for r in got if r["doc_id"] == i)
        fields, lines = by_offsets(library, [source, text], rule)
        assert (r["field_tokens"], r["section_tokens"]) == (fields, lines) and r["n_tokens"] == sum(fields)
    assert tokens.op4_token_counts(df.limit(0)).count() == 0


def test_crossing_tokens_follow_the_rule():
    sizes, bounds = np.array([2, 5, 1]), np.array([0, 3, 4])
    assert [tokens.attribute(sizes, bounds, r)[0].tolist() for r in tokens.RULES] == [[2, 0, 1], [1, 0, 2], [1, 0, 2]]
    assert tokens.attribute(sizes, bounds)[1] == 1


def test_odd_benchmarks(spark):
    docs = spark.createDataFrame(
        [(None, None, "x"), (1, "", "y"), (2, "A b c", "z"), (2, "A b c", "z"), (3, "x " * 30000 + "a B c", "q"), (4, "İstanbul ÀB", "q")], "doc_id long, text string, row string"
    )
    bench = spark.createDataFrame([(5, "a b, C"), (5, "a b, C"), (None, "x x"), (7, None), (8, " ... "), (10, "İstanbul")], "item_id long, text string")
    a = decontam.op2_decontamination(docs, bench).collect()
    b = decontam.op2_decontamination(docs, bench, max_broadcast_bytes=0).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"]) for r in a) == [("1", 0, 0, 0), ("2", 3, 3, 1), ("2", 3, 3, 1), ("3", 30003, 3, 1), ("4", 2, 1, 1), ("None", 0, 0, 0)]
    cut = sorted((str(r["doc_id"]), r["text"]) for r in decontam.remove_spans(docs, bench).collect())
    assert cut == sorted((str(r["doc_id"]), r["text"]) for r in decontam.remove_spans(docs, bench, max_broadcast_bytes=0).collect())
    assert cut == [("1", ""), ("2", ""), ("2", ""), ("3", "x " * 30000), ("4", " ÀB"), ("None", None)]
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == 2
    assert decontam.op2_decontamination(docs.limit(0), bench.limit(0)).count() == 0


def test_both_ways_agree_at_the_bound(spark):
    """A benchmark just within and just beyond the bound, with repeats inside and between items, and its size in memory."""
    import pickle

    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    bench = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 9, 10, 11, 40])))) for i in range(300)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(20)) + " " + bench[rng.randrange(300)][1].upper()) for i in range(200)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    size = decontam.broadcast_bytes(b.select(b["item_id"].cast("string").alias("item"), b["text"].alias("t")))
    one, other = (sorted(map(str, decontam.annotate(d, b, max_broadcast_bytes=most).collect())) for most in (size, size - 1))
    assert one == other
    many = [" ".join(str(rng.random()) for _ in range(1000)) for _ in range(100)]
    built = decontam.item_windows([str(i) for i in range(100)], many)
    bound = sum(len(t) + 2 * 1000 * decontam.WINDOW_BYTES for t in many)
    assert len(pickle.dumps(built)) < bound and sum(len(g.h) for g in built.sizes.values()) > 10**5


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontam, "windows", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    known = decontam.item_windows(["a", "b", "c", "b"], ["one two", "three four", "one two", "one two"], 2)
    g = known.sizes[2]
    name = lambda gram: [known.names[i] for i in known.items_of(g, np.uint64(0), gram)]
    assert (name(b"one two"), name(b"three four"), name(b"five six")) == (["a", "b", "c"], ["b"], [])


def test_spans_are_code_points(spark):
    docs = spark.createDataFrame([(1, "ü 😀x, one TWO three; é one two three one two four")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three"), (2, "four")], "item_id long, text string")
    for most in (0, 1 << 24):
        r = decontam.annotate(docs, bench, window=3, max_broadcast_bytes=most).first()
        assert [r["row"]["text"][s["start"] : s["end"]] for s in r["spans"]] == ["one TWO three", "one two three", "four"] and r["n_hit"] == 7
