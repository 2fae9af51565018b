"""A table with one row a key that a stream keeps up to date, batch by batch, in buckets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class KeyedStore:
    """Rows by key under a folder that all executors share; only Spark's readers and writers touch it.

    ``rows/batch=<id>/bucket=<k>`` holds a bucket as batch ``id`` left it, and
    ``commits/batch=<id>``, a single file written last, says which buckets that batch
    wrote. A bucket's rows are those of its last commit. A batch that is replayed builds on
    the commits before its own id and replaces its own files, so nothing doubles; one that
    dies before its commit changes nothing for readers.

    Of the rows of a key the one with the greatest ``order`` stays, whichever batch brings
    it: a late older row loses. Rows without a key are dropped, nulls in ``order`` rank
    lowest. ``buckets`` is fixed for a folder; it bounds what the driver reads of a commit,
    and 1/``buckets`` of the table is what a batch with one key rewrites. Versions that no
    reader needs any more can be removed from outside.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: list[str], order: list[str], buckets: int = 64) -> None:
        self.spark, self.folder, self.schema, self.key, self.order, self.buckets = spark, folder.rstrip("/"), schema, key, order, buckets

    def _versions(self, before: int | None = None) -> list[tuple[int, int]]:
        """(bucket, batch) of every bucket's last commit: at most one a bucket."""
        try:
            commits = self.spark.read.schema("bucket int, batch long").parquet(f"{self.folder}/commits")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []
        known = commits if before is None else commits.where(F.col("batch") < before)
        return [(r["bucket"], r["batch"]) for r in known.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()]

    def _read(self, versions: list[tuple[int, int]]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.folder}/rows/batch={batch}/bucket={bucket}" for bucket, batch in sorted(versions)]
        return self.spark.read.schema(self.schema).parquet(*paths).select(*[f"`{n}`" for n in self.schema.names])

    def rows(self) -> DataFrame:
        """The table as the last commits left it."""
        return self._read(self._versions())

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Brings a batch's rows in; only the buckets that it touches are written."""
        names = [f"`{n}`" for n in self.schema.names]
        keys = [f"`{k}`" for k in self.key]
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")
        rank = F.struct(*[f"`{o}`" for o in self.order], F.to_json(F.struct(*names)))
        best = lambda df: df.groupBy(*keys).agg(F.max_by(F.struct(*names), rank).alias("_r")).select("_r.*")
        new = batch.select(*names).where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
        touched = [r[0] for r in new.select(bucket.alias("b")).distinct().collect()]
        if not touched:
            return
        old = self._read([v for v in self._versions(batch_id) if v[0] in set(touched)])
        merged = best(best(new).unionByName(old)).withColumn("bucket", bucket)
        merged.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/rows/batch={batch_id}")
        self.spark.createDataFrame([(b,) for b in sorted(touched)], "bucket int").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/batch={batch_id}")

    def follow(self, stream: DataFrame) -> DataFrame:
        """Runs a stream to the end of what has landed and returns the table; a later call goes on behind it."""
        writer = stream.writeStream.foreachBatch(self.upsert).option("checkpointLocation", f"{self.folder}/state")
        writer.trigger(availableNow=True).start().awaitTermination()
        return self.rows()
