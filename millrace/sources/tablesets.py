"""Several tables written as one: all of them appear with the commit, or none does.

A writing job puts its rows under a folder of its own. The commit on the driver names
the files of the tasks that ended well in a list, and then replaces the one small file
``CURRENT`` that says which list holds. Readers follow it, so a job that fails at any
point leaves the tables of before. Tasks write through Arrow's file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from millrace.session import ship_package
from millrace.sources.landed import opened
from millrace.sources.sinks import flat

CSV = {"quoteAll": "true", "escape": "\"", "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


#: Rows of an Arrow batch that are Python objects at a time.
SLICE = 64


@dataclass
class Files(WriterCommitMessage):
    """The files of one task: table to path, relative to the set's folder."""

    of: dict[str, str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.headers: dict[str, str] = json.loads(options["headers"])
        self.run = f"rows-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        """One file a table; a repeated or speculative attempt has names of its own. A batch's texts become Python's a slice at a time."""
        store, root = opened(self.path)
        files: dict[str, str] = {}
        streams: dict = {}
        attempt = uuid.uuid4().hex
        try:
            slices = (batch.slice(i, SLICE) for batch in iterator for i in range(0, batch.num_rows, SLICE))
            for name, line in (row for part in slices for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                if name not in streams:
                    files[name] = f"{self.run}/{name}/{attempt}.csv"
                    store.create_dir(f"{root}/{self.run}/{name}")
                    streams[name] = store.open_output_stream(f"{root}/{files[name]}")
                    streams[name].write(f"{self.headers[name]}\n".encode())
                streams[name].write(f"{line}\n".encode())
        finally:
            for stream in streams.values():
                stream.close()
        return Files(files)

    def commit(self, messages: list[Files | None]) -> None:
        store, root = opened(self.path)
        files = {name: sorted(m.of[name] for m in messages if m and name in m.of) for name in self.headers}
        store.create_dir(root)
        text = json.dumps({"headers": self.headers, "files": files})
        for name, body in ((f"{self.run}.json", text), ("CURRENT", f"{self.run}.json")):
            draft = f"{root}/_{name}-{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(body.encode())
            store.move(draft, f"{root}/{name}")

    def abort(self, messages: list[Files | None]) -> None:
        from pyarrow import fs

        store, root = opened(self.path)
        if store.get_file_info(f"{root}/{self.run}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.run}")


class TableSet(DataSource):
    """Format ``table_set``: rows (table, line) become CSV files of their tables, visible together."""

    @classmethod
    def name(cls) -> str:
        return "table_set"

    def schema(self) -> str:
        return "table string, line string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        if not overwrite:
            raise ValueError("a table set is written whole: mode overwrite")
        return _Writer(self.options)


def write_together(tables: dict[str, DataFrame], path: str) -> None:
    """Flattens the tables and writes them in one job; they replace those of before together. Empty tables keep their header."""
    spark = next(iter(tables.values())).sparkSession
    ship_package(spark)
    spark.dataSource.register(TableSet)
    quoted = lambda names: ",".join('"' + n.replace('"', '""') + '"' for n in names)
    parts = [flat(df).select(F.lit(name).alias("table"), F.to_csv(F.struct(*[f"`{c}`" for c in df.columns]), CSV).alias("line")) for name, df in tables.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    headers = json.dumps({name: quoted(df.columns) for name, df in tables.items()})
    rows.write.format("table_set").mode("overwrite").option("headers", headers).save(path)


def read_together(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the last commit, as strings; empty text where a value was missing."""
    base = path.rstrip("/")
    named = spark.read.text(f"{base}/CURRENT", wholetext=True).first()[0].strip()
    listed = json.loads(spark.read.text(f"{base}/{named}", wholetext=True).first()[0])
    out = {}
    for name, header in listed["headers"].items():
        columns = [c.replace('""', '"') for c in header[1:-1].split('","')]
        schema = ", ".join("`" + c.replace("`", "``") + "` STRING" for c in columns)
        files = [f"{base}/{f}" for f in listed["files"][name]]
        if files:
            df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).csv(files)
        else:
            df = spark.createDataFrame([], schema)
        out[name] = df.na.fill("")
    return out
