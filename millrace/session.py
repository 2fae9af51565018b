"""Session helpers shared by tests, the benchmark and interactive use."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def local_session(cpus: int | str | None = None, shuffle_partitions: int | None = None, memory: str = "6g") -> SparkSession:
    """A local session with the settings the engine expects of a cluster (AQE on, UTC)."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "8"
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables as a DataFrame; the path goes to Spark's reader untouched."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once an application, so that Python functions can import it there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="millrace-ship-")) / "millrace.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, Path(root.name) / path.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
