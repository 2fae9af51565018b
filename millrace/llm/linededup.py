"""Line dedup over the whole corpus with native functions only.

Lines are exploded, normalised and hashed; hashes are counted over documents, lines
over the threshold are dropped outside the first document, and the text is put
together again by position. Only hashes and positions are shuffled by hash, written
once for both of their uses; the text itself moves once, to meet the positions to
drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WHITE_CHARS, ascii_lower, cut_lineage, hash128, let, written

MIN_CHARS = 10
MIN_DOCS = 2


def line_key(line: Column) -> Column:
    """What makes two lines the same: no white space at the ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(WHITE_CHARS)))


def _lines(docs: DataFrame) -> DataFrame:
    """(id, th, pos, h1, h2) of every line that is long enough, of documents with an id."""
    exploded = docs.where(F.col("id").isNotNull()).select("id", "th", F.posexplode(F.split("t", "\n")).alias("pos", "line"))
    keyed = exploded.select("id", "th", "pos", line_key(F.col("line")).alias("key"))
    h1, h2 = hash128(F.col("key"))
    return keyed.where(F.char_length("key") >= MIN_CHARS).select("id", "th", "pos", h1.alias("h1"), h2.alias("h2"))


def keep_other(lines: Column, drop: Column) -> Column:
    """The lines whose position isn't in the sorted array ``drop``, in time linear in both."""
    ends = F.concat(drop, F.array(F.size(lines)))
    return let(
        ends,
        lambda e: F.flatten(
            F.transform(
                e,
                lambda p, k: let(
                    F.when(k == 0, F.lit(0)).otherwise(F.get(e, k - 1) + 1), lambda a: F.slice(lines, a + 1, p - a)
                ),
            )
        ),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, keep: list[str] | None = None) -> DataFrame:
    """(row, n_lines, n_dropped, clean_text) for every input row; ``row`` nests the columns ``keep`` (all by default).

    A key found in at least ``min_docs`` documents loses its lines everywhere but
    in the smallest id that holds it. Null or empty text is one empty line. Rows
    of one id count as one document; repeated rows get the same result each. Rows
    without an id count nowhere and lose nothing. When all lines go, clean_text is
    the empty string. Different texts of one id are told apart by a 64-bit hash.
    """
    kept = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    source = F.col(f"`{text}`")
    whole = F.coalesce(source, F.lit(""))
    marks = [F.col(f"`{id_col}`").alias("id"), F.xxhash64(whole).alias("th")]
    lines = written(_lines(docs.select(*marks, whole.alias("t"))))
    # a document counts once a key: partial aggregation first merges its repeats, then ids
    if min_docs == 2:
        common = lines.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    else:
        common = (
            lines.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one")).groupBy("h1", "h2")
            .agg(F.min("id").alias("first"), F.sum("one").alias("n")).where(F.col("n") >= min_docs)
        )
    # written once: both sides of the join are then plain exchanges, which AQE splits where one line is very common
    common = cut_lineage(common.select("h1", "h2", "first"))
    gone = (
        lines.join(common, ["h1", "h2"]).where(F.col("id") > F.col("first"))
        .groupBy(F.col("id").alias("gid"), F.col("th").alias("gth")).agg(F.collect_set("pos").alias("drop"))
    )
    # the text travels once, inside ``row`` where that has it
    rows = docs.select(row, *marks, *([] if text in kept else [source.alias("t")]))
    joined = rows.join(gone, (F.col("id") == F.col("gid")) & (F.col("th") == F.col("gth")), "left")
    joined = joined.select("row", F.coalesce(F.col("row")[text] if text in kept else F.col("t"), F.lit("")).alias("t"), F.array_sort(F.coalesce("drop", F.array().cast("array<int>"))).alias("drop"))
    return joined.select("row", "t", "drop", F.split("t", "\n").alias("lines")).select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("drop").cast("long").alias("n_dropped"),
        F.when(F.size("drop") == 0, F.col("t")).otherwise(F.array_join(keep_other(F.col("lines"), F.col("drop")), "\n")).alias("clean_text"),
    )


def op5_line_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row; see :func:`dedup_lines` for odd rows."""
    return dedup_lines(docs, keep=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("clean_text", 256).alias("kept_sha256")
    )
