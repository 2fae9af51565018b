"""Secret scans with native functions only: base patterns, and multipart credential linking.

Identifiers, secrets and endpoints are found as spans of code points. Strong kinds
are reported as they are. Weak candidates (a long mixed run, an identifier, a URL)
are reported only when a complementary part lies within a window in the same
document. That interval join runs over bins of the window's width: every part is
put into the bins that it covers and one on either side, and the parts of one role
in a bin of a document are one row. A bin is as wide as the window, so such a row is
small, and the row of a bin meets its candidates without making pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.common import cut_lineage, let

#: Fixed values of the base patterns: kind, pattern, group that is measured, least size.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Fixed values of the weak patterns. A secret needs letters and digits; see WEAK_TEST.
WEAK = (
    ("secret", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+", 0, 20),
    ("identifier", r"""(?i:access[_-]?key(?:[_-]?id)?|client[_-]?id|account[_-]?id|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", 0, 3),
    ("endpoint", r"(?i:https?|ftp|s3|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\x00-\x20\"'<>]+", 0, 8),
)
#: A weak secret mixes letters and digits, and is no run that the base kind hex has already.
WEAK_TEST = r"^(?=.*[0-9])(?=.*[A-Za-z])(?![0-9a-f]{24,}$)"
#: Order in which spans of one start are listed.
KINDS = [k for k, *_ in BASE + WEAK]
ROLE = {"assign": "secret", "hex": "secret", "secret": "secret", "access": "identifier", "identifier": "identifier", "endpoint": "endpoint"}
#: Which roles complete a weak candidate of a kind.
COMPLETES = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
#: Largest gap in code points between parts of one credential.
WINDOW = 200


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """array<struct<kind,ord,before,size,ok>> of the leftmost matches: the gap before each, and its size.

    ``split`` cuts at the same matches that ``regexp_extract_all`` returns, so a
    running sum of gaps and sizes gives positions.
    """
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    ok: Column
    measured = found if group == 0 else F.regexp_extract_all(text, p, F.lit(group))

    def build(found: Column, measured: Column) -> Column:
        return F.transform(
            F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), measured.alias("part")),
            lambda x, i: F.struct(
                F.lit(kind).alias("kind"),
                i.alias("ord"),
                F.char_length(x["gap"]).alias("before"),
                F.char_length(x["hit"]).alias("size"),
                ((F.char_length(x["part"]) >= least) & (x["hit"].rlike(WEAK_TEST) if kind == "secret" else F.lit(True))).alias("ok"),
            ),
        )

    empty = F.array().cast("array<struct<kind:string,ord:int,before:int,size:int,ok:boolean>>")
    return let(found, lambda f: F.when(F.size(f) > 0, F.filter(build(f, measured), lambda x: x["size"].isNotNull())).otherwise(empty))


def spans_of(docs: DataFrame) -> DataFrame:
    """(k1, k2, kind, start, end) of every match that passes; ``docs`` has k1, k2 and t."""
    hits = F.concat(*[_matches(F.col("t"), *k) for k in BASE + WEAK])
    parts = docs.select("k1", "k2", F.explode(hits).alias("m")).select("k1", "k2", "m.*")
    # one exchange by document serves the removal of repeated rows and the running sum
    parts = parts.repartition("k1", "k2").dropDuplicates(["k1", "k2", "kind", "ord"])
    run = W.partitionBy("k1", "k2", "kind").orderBy("ord").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("before").cast("long") + F.col("size")).over(run)
    return parts.withColumn("end", end).where("ok").select("k1", "k2", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(spans: DataFrame, window: int = WINDOW) -> DataFrame:
    """The weak spans with a complementary part at most ``window`` away in their document."""
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])[F.col("kind")]
    parts = spans.select("k1", "k2", role.alias("role"), "start", "end")
    # A part is put into the bins that its span covers and one on either side; a candidate
    # looks into every bin that its own span covers.
    def bins(more: int) -> Column:
        return F.explode(F.sequence(F.floor(F.col("start") / window) - more, F.floor(F.col("end") / window) + more)).alias("bin")

    reach = parts.select("k1", "k2", "role", "start", "end", bins(1))
    reach = reach.groupBy("k1", "k2", "bin", "role").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("at"))
    weak = spans.where(F.col("kind").isin(*COMPLETES)).select("*", bins(0))
    need = F.create_map(*[x for k, v in COMPLETES.items() for x in (F.lit(k), F.array(*[F.lit(r) for r in v]))])[F.col("kind")]
    weak = weak.withColumn("role", F.explode(need))
    close = F.exists("at", lambda x: (x["start"] <= F.col("end") + window) & (x["end"] >= F.col("start") - window))
    return weak.join(reach, ["k1", "k2", "bin", "role"]).where(close).select("k1", "k2", "kind", "start", "end").distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """(row, spans) for every input row: sorted array<struct<start,rank,kind,end>>; ``row`` nests the columns ``keep`` (all by default).

    A row is known by a 128-bit hash of its id and text, so null ids do no harm.
    Null text has no spans. Repeated rows get the same spans each. Very long texts
    are scanned whole. Texts are shuffled only if ``keep`` has them.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row")
    key = [F.col(id_col), F.coalesce(F.col(text), F.lit(""))]
    keys = [F.xxhash64(*key).alias("k1"), F.xxhash64(F.lit(7), *key).alias("k2")]
    # few rows, used three times below: the texts are scanned once
    spans = cut_lineage(spans_of(docs.select(*keys, key[1].alias("t"))))
    base = spans.where(F.col("kind").isin(*[k for k, *_ in BASE]))
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])[F.col("kind")]
    found = (
        base.unionByName(linked(spans, window))
        .groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans"))
    )
    # written first: both sides of the join are then plain exchanges, which AQE splits where one text is very common
    found = cut_lineage(found)
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return docs.select(kept, *keys).join(found, ["k1", "k2"], "left").select("row", F.coalesce("spans", none).alias("spans"))


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_secret_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row of documents."""
    found = scan(docs, keep=["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_text_of(base), 256).alias("base_sha256"),
        _text_of(F.col("spans")).alias("spans"),
    )
