"""Licence notices by an exact set-similarity join of text blocks with templates.

A block is a stretch of a text without a blank line, a template the text of a
notice; both are sets of word pairs. A block matches a template when it contains
``PERCENT`` of a hundred of the template's pairs. The join is exact:

1. A first pass counts in how many blocks each of the templates' pairs stands, over
   the whole corpus; the counts, no more than the templates have pairs, give the
   global order, rarest first.
2. Prefix: of a template of t pairs that needs n, any block that matches holds one
   of the t - n + 1 rarest, so only those are looked up.
3. Length: the block has at least n pairs of any template.
4. Positions: behind the first shared pair, both must have enough pairs left.
5. What passes is counted in full, and confirmed on the bytes of the words.

Templates are a parameter of bounded size and go to the tasks; blocks stay where
they are read, so there is no shuffle but that of the counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import LOWER_BYTES
from millrace.llm.decontam import TABLE
from millrace.llm.words import buffers, hash_words, slices, windows
from millrace.session import ship_package

PERCENT = 80
#: Words that all templates may have together; they are held by every task.
MAX_TEMPLATE_WORDS = 200_000
#: Bytes of text handled at a time.
SLICE = 4 << 20
#: Between the words of two blocks: a line of white space alone.
BLANK_LINE = rb"\n[\x09-\x0D\x20]*\n"
#: Phrases of the query's contract and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices as licences ask for them to be written, and the short forms in use.
TEMPLATES = (
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the Apache License, Version"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-notice", "licensed under the GNU General Public License"),
    ("gpl-notice", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("public-domain", "has been dedicated to the public domain"),
    ("cc-by-nc", "licensed under CC BY-NC"),
    ("cc-by-sa", "licensed under CC BY-SA"),
    ("cc", "This work is licensed under a Creative Commons Attribution"),
)
NOTICE = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())])
PLACE = pa.struct([("label", pa.string()), ("start", pa.int64())])
OUT_DDL = "n_words long, places array<struct<label: string, start: long>>, notices array<struct<label: string, start: long, end: long, containment: double>>"


def words_of_text(text: str) -> list[bytes]:
    """The folded words of one text."""
    _, _, starts, ends, data = hash_words(pa.array([text], pa.large_string()), TABLE)
    return [data[s:e].tobytes().translate(LOWER_BYTES) for s, e in zip(starts, ends)]


class Templates:
    """The templates' pairs, numbered rarest first, and where each one's prefix holds them."""

    def __init__(self, templates: Sequence[tuple[str, str]], percent: int, blocks: dict[int, int] | None = None):
        self.labels = [label for label, _ in templates]
        sets = []
        for _, text in templates:
            words = words_of_text(text)
            if len(words) < 2:
                raise ValueError("a template needs two words")
            sets.append({b" ".join(words[i : i + 2]) for i in range(len(words) - 1)})
        hashes = {}
        for pair in set().union(*sets):
            _, (h,), *_ = hash_words(pa.array([pair.decode()], pa.large_string()), TABLE)
            hashes[pair] = int(windows(h, 2)[0])
        self.pairs = sorted(hashes, key=lambda p: ((blocks or {}).get(hashes[p], 0), p))
        rank = {pair: i for i, pair in enumerate(self.pairs)}
        by_hash = sorted((hashes[p], rank[p]) for p in self.pairs)
        self.hash, self.rank = np.array([h for h, _ in by_hash], np.uint64), np.array([r for _, r in by_hash], np.int64)
        self.sets = [np.array(sorted(rank[p] for p in s), np.int64) for s in sets]
        self.size = np.array([len(s) for s in sets], np.int64)
        self.need = np.array([math.ceil(len(s) * percent / 100) for s in sets], np.int64)
        held: list[list[tuple[int, int]]] = [[] for _ in self.pairs]
        for t, s in enumerate(self.sets):
            for i, r in enumerate(s[: len(s) - self.need[t] + 1]):
                held[r].append((t, i))
        self.ptr = np.cumsum([0, *map(len, held)])
        flat = [x for h in held for x in h]
        self.template, self.place = np.array([t for t, _ in flat], np.int64), np.array([i for _, i in flat], np.int64)


def _pairs(texts: pa.Array, known: Templates) -> tuple[tuple, np.ndarray, np.ndarray, np.ndarray]:
    """(hash_words of the batch, first words, blocks, ranks) of the templates' pairs that stand inside a block."""
    at, (h,), starts, ends, data = hashed = hash_words(texts, TABLE)
    if len(h) < 2:
        return hashed, *(np.zeros(0, np.int64) for _ in range(3))
    w = windows(h, 2)
    spot = np.minimum(np.searchsorted(known.hash, w), len(known.hash) - 1)
    first = np.flatnonzero(known.hash[spot] == w)
    begin = buffers(texts)[1]
    lo, hi = int(begin[0]), int(begin[-1])
    cuts = np.array([lo + m.start() for m in re.finditer(BLANK_LINE, data[lo:hi].data)], np.int64)
    borders = np.unique(np.r_[begin, cuts])
    block = np.searchsorted(borders, starts[first], side="right")
    inside = block == np.searchsorted(borders, starts[first + 1], side="right")
    return hashed, first[inside], block[inside], known.rank[spot[first[inside]]]


def _notices(texts: pa.Array, known: Templates) -> tuple[tuple, list[list[dict]]]:
    """(hash_words of the batch, notices of each row)."""
    hashed, first, block, rank = _pairs(texts, known)
    at, _, starts, ends, data = hashed
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    if not len(first):
        return hashed, out
    n = len(known.pairs)
    distinct = np.unique(block * n + rank)  # a block's pairs in global order
    b, r = distinct // n, distinct % n
    lead = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
    size = np.diff(np.r_[lead, len(b)])
    j = np.arange(len(b)) - np.repeat(lead, size)
    m = np.repeat(size, size)
    # prefix: every pair looks up the templates that have it in theirs
    times = known.ptr[r + 1] - known.ptr[r]
    pick = np.repeat(np.arange(len(b)), times)
    entry = np.arange(len(pick)) - np.repeat(np.cumsum(times) - times, times) + known.ptr[r[pick]]
    t, i = known.template[entry], known.place[entry]
    # the first shared pair of a block and a template decides by sizes and positions
    _, once = np.unique(b[pick] * len(known.sets) + t, return_index=True)
    pick, t, i = pick[once], t[once], i[once]
    left = 1 + np.minimum(known.size[t] - 1 - i, m[pick] - 1 - j[pick])
    ok = np.flatnonzero((m[pick] >= known.need[t]) & (left >= known.need[t]))
    for x in ok.tolist():
        mine, at_block = known.sets[t[x]], b[pick[x]]
        begin, stop = np.searchsorted(b, [at_block, at_block + 1])
        if len(np.intersect1d(mine, r[begin:stop], assume_unique=True)) < known.need[t[x]]:
            continue
        begin, stop = np.searchsorted(block, [at_block, at_block + 1])
        spots = [k for k in range(begin, stop) if rank[k] in mine and _stands(data, starts, ends, first[k], known.pairs[rank[k]])]
        shared = len({int(rank[k]) for k in spots})
        if shared >= known.need[t[x]]:
            row = int(np.searchsorted(at, first[spots[0]], side="right")) - 1
            out[row].append({"label": known.labels[t[x]], "start": int(first[spots[0]] - at[row]), "end": int(first[spots[-1]] + 2 - at[row]), "containment": shared / int(known.size[t[x]])})
    for found in out:
        found.sort(key=lambda d: (d["start"], d["end"], d["label"], d["containment"]))
    return hashed, out


def _stands(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, i: int, phrase: bytes) -> bool:
    """Whether the words from i on are those of a folded phrase."""
    n = phrase.count(b" ") + 1
    return b" ".join(data[s:e].tobytes() for s, e in zip(starts[i : i + n], ends[i : i + n])).translate(LOWER_BYTES) == phrase


def _places(hashed: tuple, phrases: Sequence[tuple[str, str]], rows: int) -> list[list[dict]]:
    """Where the phrases' words stand one behind the other, for each row by place."""
    at, (h,), starts, ends, data = hashed
    out: list[list[dict]] = [[] for _ in range(rows)]
    for phrase, label in phrases:
        words = words_of_text(phrase)
        _, (key,), *_ = hash_words(pa.array([phrase], pa.large_string()), TABLE)
        for i in np.flatnonzero(windows(h, len(words)) == windows(key, len(words))[0]).tolist():
            row = int(np.searchsorted(at, i, side="right")) - 1
            if i + len(words) <= at[row + 1] and _stands(data, starts, ends, i, b" ".join(words)):
                out[row].append({"label": label, "start": i - int(at[row])})
    for found in out:
        found.sort(key=lambda d: (d["start"], d["label"]))
    return out


def block_counts(docs: DataFrame, templates: Sequence[tuple[str, str]], text: str = "text") -> dict[int, int]:
    """In how many blocks each of the templates' pairs stands, by the pair's hash; pairs that stand nowhere are left out."""
    known = Templates(templates, PERCENT)
    hash_of = known.hash[np.argsort(known.rank)].astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(hash_of), np.int64)
        for batch in slices(batches, SLICE):
            _, _, block, rank = _pairs(batch.column(0), known)
            total += np.bincount(np.unique(block * len(hash_of) + rank) % len(hash_of), minlength=len(hash_of))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hash_of[held]), pa.array(total[held])], names=["h", "n"])

    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).mapInArrow(count, "h long, n long")
    return {r["h"] & (1 << 64) - 1: r["n"] for r in rows.groupBy("h").agg(F.sum("n").alias("n")).collect()}  # at most the templates' pairs


def licence_notices(
    docs: DataFrame, keep: list[str] | None = None, text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES, percent: int = PERCENT,
) -> DataFrame:
    """(row, n_words, places, notices) of every row; ``row`` nests the columns ``keep`` (all by default).

    ``places`` lists where a phrase's words stand consecutively, with its label;
    ``notices`` every block and template that match, from the first to the last
    shared pair (words from 0, end exclusive), with the share of the template that
    the block contains. Words are letters, digits and all beyond ASCII, A-Z folded.
    Null and empty texts have no words; repeated rows and ids come out once each; an
    empty table gives no rows. Columns of ``docs`` come nested, so no name clashes.
    Templates of fewer than two words, or too many to hold, raise.
    """
    ship_package(docs.sparkSession)
    if sum(len(words_of_text(t)) for _, t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    known = Templates(templates, percent, block_counts(docs, templates, text))
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            hashed, notices = _notices(batch.column("t"), known)
            places = _places(hashed, phrases, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(hashed[0]), pa.int64()), pa.array(places, pa.list_(PLACE)), pa.array(notices, pa.list_(NOTICE))],
                names=["row", "n_words", "places", "notices"],
            )

    return rows.mapInArrow(scan, T.StructType([rows.schema["row"], *T.StructType.fromDDL(OUT_DDL).fields]))


def op12_license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of documents.

    ``score`` is 1 where a base phrase stands, else the largest containment among
    the notices found, 0 without any. Null text: no words, empty labels, score 0.
    """
    done = licence_notices(docs, ["doc_id"])
    starts = F.transform("places", lambda p: p["start"])
    labels = lambda *columns: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.transform(c, lambda x: x["label"]) for c in columns]))), ",")
    return done.select(
        "row.doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("places").alias("base_labels"), labels("places", "notices").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("notices", lambda x: x["containment"])), F.lit(0.0))).alias("score"),
    )
