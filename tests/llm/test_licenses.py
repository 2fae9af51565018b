"""Licence notices against a join by hand, and odd rows."""

import math
import random
import re

import pytest

from millrace.llm import licenses


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def pairs(w):
    return {(a, b) for a, b in zip(w, w[1:])}


def by_hand(text, templates, percent):
    out = set()
    for block in re.split(r"\n[\x09-\x0D\x20]*\n", text or ""):
        have = pairs(words(block))
        for label, t in templates:
            want = pairs(words(t))
            if len(want & have) >= math.ceil(len(want) * percent / 100):
                out.add((label, len(want & have) / len(want)))
    return out


def test_join_equals_all_comparisons(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["ÉTÉ", "été"]
    templates = [(f"t{i}", " ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 25)))) for i in range(12)] + [("same", "w1 w1 w1 w1")]
    rows = []
    for i in range(400):
        parts = []
        for _ in range(rng.randint(0, 6)):
            w = rng.choice(templates)[1].split() if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            parts.append(rng.choice([" ", ", "]).join(w).upper())
        rows.append((i, rng.choice(["\n\n", "\n \t\n", "\n", " "]).join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for percent in (50, 80, 100):
        got = {r["row"]["doc_id"]: {(n["label"], n["containment"]) for n in r["notices"]} for r in licenses.licence_notices(df, templates=templates, percent=percent).collect()}
        assert got == {i: by_hand(t, templates, percent) for i, t in rows}
        assert any(got.values())


def test_notices_wrapped_over_lines_and_their_places(spark):
    mit = "x = 1\n\n# Permission is hereby granted, free of charge, to any\n#  person obtaining a copy of this software and\n# associated documentation files\n\ny"
    rows = [(1, mit), (2, mit.replace("\n#", "\n\n#")), (3, "Licensed under CC BY-NC 4.0."), (4, "GNU General Public License"), (5, "All rights\n\nreserved. all RIGHTS reserved")]
    got = {r["row"]["doc_id"]: r for r in licenses.licence_notices(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(n) for n in got[1]["notices"]] == [("mit", 2, 22, 1.0)] and got[2]["notices"] == []
    assert [tuple(n) for n in got[3]["notices"]] == [("cc-by-nc", 0, 5, 1.0)] and [tuple(p) for p in got[3]["places"]] == [("cc-by", 2)]
    assert [tuple(p) for p in got[4]["places"]] == [("gpl", 1)] and got[4]["notices"] == []
    assert [tuple(p) for p in got[5]["places"]] == [("reserved", 0), ("reserved", 3)]


def test_odd_rows(spark):
    rows = [(1, None, 1, "r", "t"), (2, "", 1, "r", "t"), (3, " \n\n ", 1, "r", "t"), (None, "cc by", 1, "r", "t"), (4, "CC-BY cc by", 1, "r", "t"), (4, "CC-BY cc by", 1, "r", "t"),
            (5, "ccby c c by", 1, "r", "t"), (6, "all rights reserved " * 40_000, 1, "r", "t"), (7, "Released under the MIT License.", 1, "r", "t"), (8, "released\x00under the mit license", 1, "r", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, row string, t string").repartition(2)
    got = sorted((str(r[0]), *r[1:]) for r in licenses.op12_license_scan(df).collect())
    none = (0, None, None, "", "", 0.0)
    assert got == sorted([
        ("1", 0, *none), ("2", 0, *none), ("3", 0, *none), ("None", 2, 1, 0, 0, "cc-by", "cc-by", 1.0), *[("4", 4, 2, 0, 2, "cc-by", "cc-by", 1.0)] * 2,
        ("5", 4, *none), ("6", 120_000, 40_000, 0, 119_997, "reserved", "reserved", 1.0), ("7", 5, 0, None, None, "", "mit", 1.0), ("8", 4, *none),
    ])
    assert licenses.op12_license_scan(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.licence_notices(df, templates=[("x", "one")])
