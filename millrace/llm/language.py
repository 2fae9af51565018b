"""Language identification by nearest centroid.

A text is the vector of its letter n-grams (one to three code points, case folded,
everything but letters a blank), hashed into a fixed number of dimensions, weighted
by TF-IDF and brought to unit length. Every language has several centroids, found by
spherical k-means; a text gets the language of the centroid with the largest cosine.
A text farther from its centroid than nearly all that the centroid was made from is
rejected: it keeps its language, is flagged, and its score is halved.

Document frequencies cover every labelled training text, and every label that one of
them has is learned. The k-means of a language works on a sample of its texts whose
size is a parameter: those with letters that have the smallest hashes of id and
text, each text once. Languages are fitted apart from one another, in parallel.
Model and frequencies are a few hundred KB for a few languages (some 64 KB each),
whatever the corpus, and are broadcast; prediction is one pass without a shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import cut_lineage
from millrace.llm.words import slices
from millrace.session import ship_package

DIMENSIONS = 4096
#: Most labelled texts of a language that its k-means sees.
MAX_SAMPLE = 1000
CENTROIDS = 4
#: Most sampled hashes that are sent to every executor; more are joined.
MAX_BROADCAST_ROWS = 200_000
#: Leading bits of a hash by which samples are counted.
BIN_BITS = 12
#: Quantile of the training cosines of a centroid below which a text is rejected.
REJECT = 0.001
#: What rejection leaves of a score.
REJECTED_SHARE = 0.5
UNDETERMINED = "und"
#: Code points of a text handled at a time.
STEP = 1 << 18
_ODD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case code point if it's a letter, else a blank."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def counts(text: str, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None without a letter."""
    shift = np.uint32(32 - dimensions.bit_length() + 1)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    total = np.zeros(dimensions, np.int64)
    carry = np.full(1, 32, np.uint32)
    seen = False
    table = _letters()
    for i in range(0, len(points), STEP):
        c = table[points[i : i + STEP]]
        seen = seen or bool((c != 32).any())
        own = np.concatenate([carry, c])
        own = own[np.concatenate([[True], (own[1:] != 32) | (own[:-1] != 32)])]  # one blank at most
        fresh = 0 if i == 0 else min(2, len(carry))
        h = own * _ODD[0]
        for n in (1, 2, 3):
            if n > 1:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _ODD[1] + own[n - 1 :] * _ODD[2]
            new = h[max(0, fresh - n + 1) :]
            total += np.bincount((new * _ODD[0]) >> shift, minlength=dimensions)
        carry = own[-2:]
    return total if seen else None


def weigh(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vector of damped counts times inverse document frequency."""
    v = np.log1p(n).astype(np.float32) * idf
    norm = np.sqrt((v * v).sum())
    return v / norm if norm else v


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit vectors by spherical k-means from a farthest-first start."""
    chosen = [x.mean(axis=0)]
    start = [int(np.argmax(x @ chosen[0]))]
    near = x @ x[start[0]]
    while len(start) < min(k, len(x)):
        start.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[start[-1]])
    c = x[start]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.sqrt((c * c).sum(axis=1, keepdims=True)), 1e-12)
    return c


def survey(train: DataFrame, dimensions: int, most: int) -> DataFrame:
    """(lang, h, dim, n): what one pass over ``train`` (lang, h, text) finds, a task's share a row.

    Rows with a dim say how many texts hold that dimension, those of dim
    ``dimensions`` how many have letters at all. Rows with a lang name the ``most``
    smallest hashes of its texts with letters; a task keeps no more of them.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(dimensions + 1, np.int64)
        least: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            new = defaultdict(list)
            for lang, h, value in zip(batch.column("lang").to_pylist(), batch.column("h").to_pylist(), batch.column("text")):
                n = counts(value.as_py(), dimensions)
                if n is not None:
                    df[:-1] += n > 0
                    df[-1] += 1
                    new[lang].append(h)
            for lang, hashes in new.items():
                least[lang] = np.unique(np.concatenate([least.get(lang, np.zeros(0, np.int64)), np.array(hashes, np.int64)]))[:most]
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.string()), pa.nulls(len(at), pa.int64()), pa.array(at), pa.array(df[at])], names=names)
        for lang, hashes in least.items():
            k = len(hashes)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * k, pa.string()), pa.array(hashes), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names=names)

    names = ["lang", "h", "dim", "n"]
    return train.select("lang", "h", "text").mapInArrow(partial, "lang string, h long, dim long, n long")


class Model:
    """Centroids (one row each), their languages and the cosine below which they reject."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, languages: list[str], floors: np.ndarray):
        self.idf, self.centroids, self.languages, self.floors = idf, centroids, languages, floors

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, rejected)."""
        n = counts(text, len(self.idf)) if text else None
        if n is None or not len(self.languages):
            return UNDETERMINED, 0.0, True
        cosine = self.centroids @ weigh(n, self.idf)
        best = int(np.argmax(cosine))
        rejected = bool(cosine[best] < self.floors[best])
        score = float(min(1.0, max(0.0, cosine[best]))) * (REJECTED_SHARE if rejected else 1.0)
        return self.languages[best], score, rejected


def smallest(hashes: DataFrame, most: int) -> DataFrame:
    """The ``most`` smallest hashes h of every lang, written.

    Hashes are counted by their leading bits first; only those before the limit are
    ranked, a stretch of leading bits at a time, so no task holds all of a language.
    """
    binned = cut_lineage(hashes.withColumn("bin", F.shiftright("h", 64 - BIN_BITS)))
    counts = binned.groupBy("lang", "bin").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    near = cut_lineage(counts.withColumn("before", before).where(F.col("before") < most).drop("n"))  # 2^BIN_BITS rows a language at most
    place = F.row_number().over(Window.partitionBy("lang", "bin").orderBy("h"))
    return cut_lineage(binned.join(near, ["lang", "bin"]).withColumn("at", place + F.col("before")).where(F.col("at") <= most).select("lang", "h"))


def idf_of(df: np.ndarray) -> np.ndarray:
    """Inverse document frequencies; the last entry of ``df`` is the number of texts."""
    return (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)


def fit(train: DataFrame, dimensions: int = DIMENSIONS, max_sample: int = MAX_SAMPLE, k: int = CENTROIDS) -> Model:
    """A model of ``train`` (key, text, lang), texts and langs not null.

    ``max_sample`` bounds the texts a language's k-means sees; rows of one key and
    text count once there. A label whose texts have no letters is not learned.
    """
    ship_package(train.sparkSession)
    train = train.select("lang", "text", F.xxhash64(F.lit(11), "key", "text").alias("h"))
    found = cut_lineage(survey(train, dimensions, max_sample))
    df = np.zeros(dimensions + 1, np.int64)
    for r in found.where("dim is not null").groupBy("dim").agg(F.sum("n").alias("n")).collect():  # one row a dimension
        df[r["dim"]] = r["n"]
    idf = idf_of(df)
    chosen = smallest(found.where("lang is not null").select("lang", "h").distinct(), max_sample)
    small = F.broadcast if chosen.count() <= MAX_BROADCAST_ROWS else (lambda df: df)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, vec = [], []
            for i, value in enumerate(batch.column("text")):
                n = counts(value.as_py(), dimensions)
                if n is not None:
                    at.append(i)
                    vec.append(weigh(n, idf).astype(np.float16).tobytes())
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("lang").take(rows), batch.column("h").take(rows), pa.array(vec, pa.binary())], names=["lang", "h", "vec"])

    def cluster(lang: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v, np.float16) for v in rows.sort_values("h")["vec"]]).astype(np.float32)
        c = k_means(x, k)
        cosine = x @ c.T
        own = np.argmax(cosine, axis=1)
        used = [i for i in range(len(c)) if (own == i).any()]
        return pd.DataFrame({
            "lang": [lang[0]] * len(used), "at": used, "centroid": [c[i].tobytes() for i in used],
            "floor": [float(np.quantile(cosine[own == i, i], REJECT)) for i in used],
        })

    sample = train.join(small(chosen), ["lang", "h"], "left_semi").mapInArrow(vectors, "lang string, h long, vec binary").dropDuplicates(["lang", "h"])
    # a group holds ``max_sample`` vectors at most
    fitted = sample.groupBy("lang").applyInPandas(cluster, "lang string, at int, centroid binary, floor double")
    rows = sorted(fitted.collect(), key=lambda r: (r["lang"], r["at"]))  # ``k`` rows a language
    centroids = np.array([np.frombuffer(r["centroid"], np.float32) for r in rows], np.float32).reshape(-1, dimensions)
    return Model(idf, centroids, [r["lang"] for r in rows], np.array([r["floor"] for r in rows]))


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with lang_pred, score and rejected, for every row; kept columns of those names give way to them."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            found = [model.predict(v.as_py()) for v in batch.column("t")]
            lang, score, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["row", "lang_pred", "score", "rejected"],
            )

    kinds = T.StructType.fromDDL("lang_pred string, score double, rejected boolean")
    done = rows.mapInArrow(run, T.StructType([rows.schema["row"], *kinds.fields]))
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in keep if c not in kinds.names], *kinds.names)


def op9_language_id(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every document.

    Rows whose crc32(doc_id) mod 5 is 0, or without an id, are held out; rows with
    a null text or lang teach nothing. Null texts and texts without a letter are
    ``und`` with a score of 0, as is everything when nothing was learned.
    """
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    rows = docs.select("doc_id", "text", "lang", fold.alias("held_out"))
    train = rows.where("not held_out and text is not null and lang is not null").select(F.col("doc_id").alias("key"), "text", "lang")
    return predict(rows, fit(train), ["doc_id", "held_out"])
