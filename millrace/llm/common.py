"""Pieces that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: White space of the text contracts: tab to carriage return, and the space.
WHITE = "\\x20\\x09-\\x0D"
WHITE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The same folding for UTF-8 bytes; bytes of other letters stay as they are.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; all-ASCII strings take the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hash128(value: Column) -> list[Column]:
    """Two independent 64-bit hashes, so that 10^12 keys still don't collide."""
    return [F.xxhash64(value), F.xxhash64(F.lit(7), value)]


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="millrace-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the cluster's shared folder (``spark.checkpoint.dir``).

    The folder is set here only where a local session names none, as in tests.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(spark: SparkSession) -> int:
    """The number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Edges beyond which minima are written before they are joined; no node has more neighbours than there are edges.
MANY_EDGES = 5_000_000


def _digest(links: DataFrame) -> Row:
    """The number of edges and two sums of their hashes, in which equal sets of edges agree."""
    sums = [F.sum(h.cast("decimal(38,0)")).alias(n) for n, h in zip("xy", hash128(F.struct("u", "v")))]
    return links.agg(F.count("*").alias("n"), *sums).first()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) with the smallest node reachable, for every node with an edge.

    Alternates the large-star and small-star steps, which shrink any path to a
    star in a number of rounds logarithmic in its length; every round is a
    shuffle of the edges that are left. Where they are so many that a node's
    neighbours could be too much for one task, minima are written before they are
    joined: the join then has plain exchanges, which AQE splits. What a round leaves
    is checkpointed, so that lost executors cost one round at most. It ends when no
    edge changes, and raises if ``rounds`` don't do. Self-loops and null ends are
    ignored.
    """
    links = cut_lineage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    before = _digest(links)
    for _ in range(rounds):
        apart = cut_lineage if before["n"] > MANY_EDGES else (lambda df: df)
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = apart(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        large = apart(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # small star: every smaller neighbour, and the node, go to the smallest neighbour
        nearest = apart(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(nearest, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        )
        links = cut_lineage(small.select("e.*").where("u <> v").distinct())
        now = _digest(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder, and read again.

    For wide tables that several later steps scan: columnar, compressed, pruned.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir().rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
