"""Near-duplicate documents by MinHash bands, odd sketches and exact confirmation.

Each document's word shingles give MinHash samples. Bands of samples are the keys of
candidate buckets; all samples are folded into an odd sketch, a bitmap of parities
in which two documents' XOR has few ones when nearly all samples agree. Links are
confirmed on the full shingle sets.

No bucket is ever turned into all its pairs:

1. Documents with equal sets are one class, found by a 128-bit set hash.
2. In every bucket of classes, all are compared with the smallest one (a star).
3. Only where a bucket still holds several components, its documents go through an
   exact prefix join: ordered by rarity among themselves, two sets of similarity t
   share one of their first n - ceil(t n) + 1 shingles. A copy with many edits
   starts with shingles of its own and meets nobody, so groups of thousands of
   loosely similar documents stay cheap, and no link is lost.

With 32 bands of 4 samples, a pair at the threshold shares no band once in 10^10
(0.85) or 2 * 10^7 (0.80) pairs; the sketch's margin is six standard deviations.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import WHITE_CHARS, connected_components, cut_lineage, hash128
from millrace.llm.words import fold_table, hash_words, mix, slices, windows
from millrace.session import ship_package

SHINGLE = 5
PERCENT = 80
BANDS = 32
ROWS = 4
SKETCH_BITS = 512
#: Bits of the odd sketch of a full set.
SET_BITS = 2048
#: Bits a wanted id in the map of ids whose sets are wanted, and the most bits of the map (16 MB); more ids than that serves are joined.
BITS_AN_ID = 10
MAX_ID_BITS = 1 << 27
#: Standard deviations of the similarity estimate by which the sketch may be wrong.
MARGIN = 6.0
TABLE = fold_table(WHITE_CHARS.encode())
#: Shingles handled at a time.
STEP = 4096


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's shingles; a short text is one shingle, no words are none."""
    at, (h,), *_ = hash_words(texts, TABLE)
    every = windows(h, size)
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            yield np.unique(every[a : b - size + 1])
        else:
            yield windows(h[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64)


def parities(place: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits, one where an odd number of members falls, as 64-bit words."""
    odd = (np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


class Sampler:
    """MinHash samples, their bands and their odd sketch, from fixed pseudo-random constants."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS):
        self.bands, self.rows, self.bits = bands, rows, bits
        k = np.arange(1, bands * rows + 1, dtype=np.uint64)
        self.flip = mix(k * np.uint64(0xD1342543DE82EF95))
        self.scale = mix(k * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
        self.order = k

    def samples(self, s: np.ndarray) -> np.ndarray:
        least = np.full(len(self.order), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(s), STEP):
            x = (s[i : i + STEP, None] ^ self.flip) * self.scale
            np.minimum(least, x.min(axis=0), out=least)
        return least

    def band_keys(self, m: np.ndarray) -> np.ndarray:
        rows = m.reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for r in range(self.rows):
            key = mix(key * np.uint64(0x9FB21C651E98DF25) ^ rows[:, r])
        return key

    def sketch(self, m: np.ndarray) -> np.ndarray:
        """Parities of the samples that fall on each bit, as 64-bit words."""
        place = (mix(m + self.order * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(self.bits)
        return parities(place, self.bits)


def largest_distance(percent: int, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS, margin: float = MARGIN) -> int:
    """Ones in the XOR of two sketches beyond which the pair can't reach the threshold.

    k samples differ in at most d = 2k(1 - J) entries of a sketch; d entries thrown
    on n bits leave n/2 (1 - exp(-2d/n)) odd ones, give or take sqrt(d).
    """
    k, t = bands * rows, percent / 100
    d = min(2 * k, 2 * k * (1 - t) + 2 * margin * math.sqrt(k * t * (1 - t)))
    return math.ceil(min(d, bits / 2 * (1 - math.exp(-2 * d / bits)) + margin * math.sqrt(d) / 2))


def fingerprint(s: np.ndarray) -> tuple[np.int64, np.int64]:
    """A 128-bit hash of a set of shingles."""
    f = mix(s ^ np.uint64(0x5851F42D4C957F2D))
    return f.sum().astype(np.int64), mix(f).sum().astype(np.int64)


def signatures(docs: DataFrame, id_col: str, text: str, shingle: int, sampler: Sampler) -> DataFrame:
    """(id, t1, t2, n, f1, f2, bands, sketch) of every row: text hash, set size, set hash, band keys and odd sketch."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), *_text_key(text), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], []]
            for s in shingle_sets(batch.column("t"), shingle):
                keys, sketch = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if len(s):
                    m = sampler.samples(s)
                    keys, sketch = sampler.band_keys(m).view(np.int64), sampler.sketch(m).view(np.int64)
                for column, value in zip(out, (len(s), *fingerprint(s), keys, sketch)):
                    column.append(value)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "t1", "t2")), *[pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), longs, longs))]],
                names=["id", "t1", "t2", "n", "f1", "f2", "bands", "sketch"],
            )

    kinds = T.StructType.fromDDL("n long, f1 long, f2 long, bands array<long>, sketch array<long>")
    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in ("id", "t1", "t2")), *kinds.fields]))


def _text_key(text: str) -> list[Column]:
    """A 128-bit hash of a row's text; a null text is an empty one."""
    return [h.alias(n) for n, h in zip(("t1", "t2"), hash128(F.coalesce(F.col(f"`{text}`"), F.lit(""))))]


def id_bits(wanted: int) -> int:
    """The bits of the map for so many ids, a power of two; 0 when they are too many for one."""
    bits = 1 << max(16, (wanted * BITS_AN_ID - 1).bit_length())
    return bits if bits <= MAX_ID_BITS else 0


def id_bitmap(ids: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the ids' hashes; false positives only."""
    bit = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = ids.select(F.floor(bit / 64).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("m"))
    got = words.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()  # at most MAX_ID_BITS / 64 rows
    out = np.zeros(bits // 64, np.int64)
    out[got["w"].to_numpy()] = got["m"].to_numpy()
    return out


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """(id, set, parity) of the classes in ``wanted`` (id, rep, f1, f2): their sets as hashes, and the sets' own odd sketches.

    ``rep`` is a document of the class, f1 and f2 the hash of its set; other texts
    of that document are other classes. Tasks drop what they have seen before.

    The XOR of two such sketches has at most as many ones as the sets have
    different members, whatever falls together, so it rules pairs out without error.
    While the ids are few enough for a bitmap, texts aren't shuffled: it lets nearly
    all others go where they are read, and the sets of the rest meet the ids
    themselves. Beyond that the texts meet the ids.
    """
    reps = wanted.select(F.col("rep").alias("id")).distinct()
    bits = id_bits(reps.count())
    known = docs.sparkSession.sparkContext.broadcast(id_bitmap(reps, bits)) if bits else None
    own = F.col(f"`{id_col}`")
    rows = docs.where(own.isNotNull()).select(own.alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"), F.pmod(F.xxhash64(own), F.lit(bits or 1)).alias("bit"))
    rows = rows if bits else rows.join(reps, "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            if known is not None:
                bitmap, bit = known.value, batch.column("bit").to_numpy()
                batch = batch.filter(pa.array((bitmap[bit >> 6] >> (bit & 63)) & 1 == 1))
            for part in slices([batch]):
                at, sets, marks = [], [], []
                for i, (key, s) in enumerate(zip(part.column("id").to_pylist(), shingle_sets(part.column("t"), shingle))):
                    mark = fingerprint(s)
                    if (key, *mark) not in seen:
                        seen.add((key, *mark))
                        at.append(i)
                        sets.append(s)
                        marks.append(mark)
                odd = [parities(mix(s) % np.uint64(SET_BITS), SET_BITS).view(np.int64) for s in sets]
                columns = [pa.array(c, pa.list_(pa.int64())) for c in ([s.view(np.int64) for s in sets], odd)]
                hashes = [pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(at, pa.int64())), *hashes, *columns], names=["id", "f1", "f2", "set", "parity"])

    kinds = T.StructType.fromDDL("f1 long, f2 long, set array<long>, parity array<long>")
    found = rows.mapInArrow(run, T.StructType([rows.schema["id"], *kinds.fields])).withColumnRenamed("id", "rep")
    return found.join(wanted, ["rep", "f1", "f2"]).groupBy("id").agg(F.first("set").alias("set"), F.first("parity").alias("parity"))


def _ones(a: str, b: str) -> Column:
    """Ones in the XOR of two bitmaps."""
    return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda x, y: x + y)


def _sizes(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _filtered(pairs: DataFrame, marks: DataFrame, percent: int, distance: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches leave possible; ``marks`` is (id, n, sketch)."""
    side = lambda s: marks.select(F.col("id").alias(s), F.col("n").alias(f"{s}n"), F.col("sketch").alias(f"{s}sketch"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_sizes("an", "bn", percent) & (_ones("asketch", "bsketch") <= distance)).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold, in whole numbers."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"
    )
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    sized = both.select("a", "b", common.alias("i"), (F.size("sa").cast("long") + F.size("sb")).alias("s"))
    return sized.where(F.col("i") * 100 >= (F.col("s") - F.col("i")) * percent).select("a", "b")


def _prefix_pairs(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``rest`` (id, comp, minor) in different components that share a rare shingle.

    Exact for the threshold: shingles are ordered by how many of these documents
    hold them, ties by hash, the same order for all. Shingles of one document alone
    can be in no intersection, so what is left bounds every similarity of it; that
    bound and the odd sketches of the full sets are tested inside the join, and only
    pairs that both leave possible come out. One side of a pair is always outside
    its bucket's main component (minor).

    The join looks at no more pairs than there are of documents that are apart and
    whose common shingles could still make them alike: for sets of equal size that
    differ in less than 2 * (100 - percent) of 100 members. A bucket of n documents
    that are all that close to each other and yet not linked costs n^2 / 2 tests of
    two bitmaps, spread over the shingles they meet on.
    """
    held = sets.join(rest.select("id").distinct(), "id").select("id", F.explode("set").alias("s"))
    rarity = held.groupBy("s").agg(F.count("*").alias("df"))
    ordered = held.join(rarity, "s").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("o"))
    n, shared = F.size("o"), F.filter("o", lambda x: x["df"] > 1)
    first = F.filter(F.slice("o", 1, n - F.ceil(n * percent / F.lit(100)).cast("int") + 1), lambda x: x["df"] > 1)
    kept = ordered.select("id", n.alias("n"), F.size(shared).alias("m"), first.alias("first"))
    # no partner at all can reach the threshold with what a document shares
    kept = kept.where(F.col("m") * 100 >= F.col("n") * percent).join(rest, "id").join(sets.select("id", "parity"), "id")
    prefix = cut_lineage(kept.select("id", "n", "m", "comp", "minor", "parity", F.explode("first.s").alias("s")))
    side = lambda d, x: d.select("s", *[F.col(c).alias(x if c == "id" else x + c) for c in ("id", "n", "m", "comp", "minor", "parity")])
    most = F.least("am", "bm")
    far = (F.col("acomp") != F.col("bcomp")) & (~F.col("bminor") | (F.col("a") < F.col("b")))
    possible = most * 100 >= (F.col("an") + F.col("bn") - most) * percent
    alike = _ones("aparity", "bparity") * (100 + percent) <= (F.col("an") + F.col("bn")) * (100 - percent)
    return side(prefix.where("minor"), "a").join(side(prefix, "b"), "s").where(far & possible & alike).select("a", "b").distinct()


def classed(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
    bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS,
) -> DataFrame:
    """(id, t1, t2, n, f1, f2, component_id, component) of every row: text hash, set size, set hash, the smallest id reachable, and the component's own name.

    The last two differ where several texts share an id: then components of one
    smallest id are told apart by its set. Rows without an id or words are in none.
    """
    ship_package(docs.sparkSession)
    sampler, distance = Sampler(bands, rows, bits), largest_distance(percent, bands, rows, bits)
    sig = cut_lineage(signatures(docs, id_col, text, shingle, sampler))
    classes = sig.where("n > 0 and id is not null").groupBy("f1", "f2", "n").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = cut_lineage(classes)
    # a class goes by its smallest id, and only where that is another class's, too, by id and set
    several = not classes.groupBy("rep").count().where("count > 1").isEmpty()
    node = F.struct("rep", "f1", "f2", "n") if several else F.col("rep")
    marks = classes.select(node.alias("id"), "n", "sketch")

    keys = classes.select(node.alias("id"), F.explode("bands").alias("key"))
    stars = cut_lineage(keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top"), F.count("*").alias("size")).where("hub < top"))
    members = cut_lineage(keys.join(stars, "key").select("key", "id", "hub", "size"))
    spokes = members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    likely = cut_lineage(_filtered(spokes, marks, percent, distance))
    wanted = cut_lineage(likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).unionByName(members.where("size > 2 and id <> hub").select("id")).distinct())
    wanted = cut_lineage(classes.select(node.alias("id"), "rep", "f1", "f2").join(wanted, "id", "left_semi"))
    sets = cut_lineage(full_sets(docs, wanted, id_col, text, shingle))
    links = cut_lineage(_confirmed(likely, sets, percent).distinct())
    comp = cut_lineage(connected_components(links))

    # buckets whose members, the hub aside, are still in several components
    placed = members.where("size > 2 and id <> hub").join(comp.withColumnRenamed("node", "id"), "id", "left")
    placed = cut_lineage(placed.select("key", "id", F.coalesce("component", "id").alias("comp")))
    shares = placed.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = cut_lineage(shares.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1").select("key", "main"))
    rest = placed.join(mixed, "key").groupBy("id", "comp").agg(F.max(F.col("comp") != F.col("main")).alias("minor"))
    rest = cut_lineage(rest)
    if not rest.isEmpty():
        more = cut_lineage(_prefix_pairs(rest, sets, percent))
        more = cut_lineage(_confirmed(more, sets, percent).distinct())
        if not more.isEmpty():
            comp = cut_lineage(connected_components(links.unionByName(more)))

    named = classes.select("f1", "f2", "n", node.alias("node")).join(comp, "node", "left")
    named = cut_lineage(named.select("f1", "f2", "n", F.coalesce("component", "node").alias("component")))
    out = sig.select("id", "t1", "t2", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
    smallest = F.col("component.rep") if several else F.col("component")
    return out.select("id", "t1", "t2", "n", "f1", "f2", F.when(F.col("id").isNotNull(), F.coalesce(smallest, "id")).alias("component_id"), F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; ``options`` are those of :func:`classed`.

    Words are cut at white space, A-Z folded. Two documents are linked when
    100 * intersection >= percent * union of their distinct shingles; a component is
    what links reach, named by its smallest id, which is the one kept. Documents
    without words are linked with nothing. Rows without an id are linked with
    nothing, have no component and are kept. A document is an id with a text: rows
    that repeat both are one, other texts of an id are documents of their own, each
    with the component that its text is in.
    """
    done = classed(docs, id_col, **options)
    return done.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` but those of redundant documents, columns unchanged.

    One document of each component stays: that of the smallest id, and of several
    texts of it in the component the one with the smallest hash. Rows are removed by
    id and text, so no other text of an id goes with them, and rows that repeat the
    document that stays are kept with it.
    """
    done = cut_lineage(classed(docs, id_col, text, **options).where("id is not null and n > 0"))
    stays = done.where("id = component_id").groupBy("component").agg(F.min(F.struct("id", "t1", "t2")).alias("s")).select("s.*").withColumn("stays", F.lit(True))
    gone = done.select("id", "t1", "t2").distinct().join(stays, ["id", "t1", "t2"], "left").where("stays is null").select("id", "t1", "t2")
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("id"), *_text_key(text))
    return rows.join(cut_lineage(gone), ["id", "t1", "t2"], "left_anti").select("row.*")


def op1_minhash_near_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document, for 3-word shingles and a similarity of 0.85."""
    return near_duplicates(docs.select("doc_id", "text"), shingle=3, percent=85)
