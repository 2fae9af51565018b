"""Streams from landed files, run to the end of what is there, and written as tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Where results and checkpoints may lie: the cluster's checkpoint folder, or a local one where a local session names none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="millrace-checkpoint-"))
    return context.getCheckpointDir().rstrip("/")


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, one file or a folder of them, as a stream of its files with the table's own schema.

    The path goes in as a pattern that only it fits: a plain path must be a folder here.
    """
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def run_to_end(stream: DataFrame, folder: str | None = None) -> DataFrame:
    """Runs a stream over everything that has landed and returns the table that it wrote.

    With the same folder, a later call goes on where this one stopped.
    """
    spark = stream.sparkSession
    folder = folder or f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/rows")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
