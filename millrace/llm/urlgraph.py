"""URL filters with native functions only: rules, and trust spread over the host graph.

A few rules decide the pages they fit. Every other page is judged by its host:
trust flows from hosts with allowed pages along links, distrust flows from hosts
with blocked pages against links, to whoever links to them. Both are personalised
PageRank, run together as one set of joins over (direction, host) and scaled so
that a host without links keeps exactly its own share of evidence. A host's distrust
is what walks along its own links find: the mean of its targets', damped, however
many others link to them.

Trust that arrives is a sum over all who link, distrust a mean, so neither is held
against the other as it is. What a host's own pages say counts as it stands, and
links speak for the share of its pages that no rule fits alone: trust that arrives
as t by t / (1 + t), distrust as d by min(1, d). Both are shares of 0 to 1, and no
number of links makes up for a host's own blocked pages.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, UPPER, cut_lineage

#: (verdict, host, path prefix), as the query's contract states them.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING = 0.85
#: Rounds of the plain computation that tests hold ranks against; here only the tolerance ends them.
ROUNDS = 24
#: Rounds between checkpoints and tests for the end.
BATCH = 4
#: What may be missing of any host's rank at the end.
TOLERANCE = 1e-4
#: A host is blocked when the share of distrust exceeds that of trust by more than this.
THRESHOLD = 0.5
#: Absolute and scheme-relative targets of href and src attributes, up to the host's end.
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct<verdict,rule> of the longest rule that fits, or null.

    Rules are a short list given in code, so this stays one CASE in the scan's projection.
    """
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, at, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(at + prefix).alias("rule"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(a, b, n): links between different hosts, counted. ``pages`` has host and html."""
    targets = F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    links = pages.select(F.col("host").alias("a"), F.explode(targets).alias("b"))
    links = links.select("a", F.translate("b", UPPER, LOWER).alias("b")).where("a <> b and a <> '' and b <> ''")
    return links.groupBy("a", "b").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) of every host that gets some.

    ``edges`` is (a, b, n); ``seeds`` is (host, trust, distrust). The arcs of both
    directions are weighted by the links of the linking host and written once; a
    round is one join and one sum. A round damps the sum of what moves forward and
    the most that moves backward, so what the last batch moved bounds all that is
    left out; rounds end when that is no more than ``tolerance``.
    """
    out = edges.groupBy("a").agg(F.sum("n").alias("w"))
    forward = edges.join(out, "a").select(F.lit(True).alias("fwd"), F.col("a").alias("host"), F.col("b").alias("to"), (F.col("n") / F.col("w")).alias("p"))
    backward = edges.join(out, "a").select(F.lit(False).alias("fwd"), F.col("b").alias("host"), F.col("a").alias("to"), (F.col("n") / F.col("w")).alias("p"))
    arcs = cut_lineage(forward.unionByName(backward))
    start = cut_lineage(
        seeds.select(F.explode(F.array(F.struct(F.lit(True).alias("fwd"), "host", F.col("trust").alias("r")), F.struct(F.lit(False).alias("fwd"), "host", F.col("distrust").alias("r")))).alias("s"))
        .select("s.*").where("r > 0")
    )
    rank = start
    if not arcs.isEmpty():
        left, rest = math.inf, damping**BATCH / (1 - damping**BATCH)
        while left * rest > tolerance:
            before = rank
            for _ in range(BATCH):
                moved = rank.join(arcs, ["fwd", "host"]).select("fwd", F.col("to").alias("host"), (F.col("r") * F.col("p") * damping).alias("r"))
                rank = start.unionByName(moved).groupBy("fwd", "host").agg(F.sum("r").alias("r"))
            rank = cut_lineage(rank)
            step = rank.join(before.withColumnRenamed("r", "old"), ["fwd", "host"], "left").select("fwd", (F.col("r") - F.coalesce("old", F.lit(0.0))).alias("d"))
            left = step.agg(F.greatest(F.sum(F.when(F.col("fwd"), F.col("d"))), F.max(F.when(~F.col("fwd"), F.col("d"))))).first()[0] or 0.0
    share = lambda fwd: F.coalesce(F.sum(F.when(F.col("fwd") == fwd, F.col("r"))), F.lit(0.0))
    return rank.groupBy("host").agg(share(True).alias("trust"), share(False).alias("distrust"))


def excess(trust: Column, distrust: Column, good: Column, bad: Column) -> Column:
    """By how much distrust outweighs trust, from -1 to 1, given the ranks and the host's own shares of allowed and blocked pages."""
    open_share = F.lit(1.0) - good - bad
    arrived = F.greatest(trust - good, F.lit(0.0))
    found = F.least(F.greatest(distrust - bad, F.lit(0.0)), F.lit(1.0))
    return (bad + open_share * found) - (good + open_share * arrived / (arrived + 1))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """(row, host, path, rule, verdict, trust, distrust) for every input row, the row nested.

    Null urls and urls without ``://`` have an empty host and path, fit no rule and
    are allowed. Null html has no links. Hosts that no evidence reaches are allowed.
    """
    rows = pages.select(F.struct("*").alias("row"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    light = rows.select("host", "hit").where("host <> ''")
    share = lambda v: F.avg(F.when(F.col("hit.verdict") == v, 1.0).otherwise(0.0))
    seeds = light.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")).where("trust > 0 or distrust > 0")
    ranks = propagate(host_edges(rows.select("host", F.col("row.html").alias("html"))), seeds)
    own = seeds.select("host", F.col("trust").alias("good"), F.col("distrust").alias("bad"))
    # written once, so that a very common host is a plain skewed join that AQE can split
    scores = cut_lineage(ranks.join(own, "host", "left").select("host", "trust", "distrust", excess(*[F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust", "good", "bad")]).alias("excess")))
    rows = rows.join(scores, "host", "left")
    method = F.when(F.coalesce("excess", F.lit(0.0)) > threshold, "block").otherwise("allow")
    return rows.select(
        "row", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce(F.col("hit.verdict"), method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op3_url_filter(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page, with its host's trust and distrust."""
    judged = judge(pages.select("page_id", "url", "html"))
    return judged.select(
        F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict", F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust")
    )
