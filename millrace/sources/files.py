"""Landed files in the forms that the sources use, each as a DataFrame."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import ship_package


def csv_table(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", schema: T.StructType | None = None) -> DataFrame:
    """A CSV with quotes and line breaks in values; with a header and strings unless a schema is given. A BOM goes."""
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("multiLine", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.option("header", True).csv(path)
    first = df.columns[0]
    return df.withColumnRenamed(first, first.lstrip("﻿"))


def csv_after_preamble(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """A CSV whose header line comes after free text: rows of the file's lines behind it, as strings."""
    lines = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    start = F.regexp_instr("value", F.lit("(?m)^﻿?" + re.escape(",".join(header))))
    body = F.when(start > 0, F.substring(F.col("value"), start, F.length("value")))
    rows = lines.select("file", F.posexplode(F.split(body, r"\r?\n")).alias("ord", "line")).where("ord > 0 and trim(line) <> ''")
    names = ", ".join(f"`{h}` STRING" for h in header)
    return rows.select("file", "ord", F.from_csv("line", names, {"escape": '"'}).alias("r")).select("file", "ord", "r.*")


def json_table(spark: SparkSession, path: str, schema: str | T.StructType, lines: bool = False) -> DataFrame:
    """JSON arrays or objects (or one a line) with a given schema; a path that isn't there is an empty table."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.option("multiLine", not lines).schema(schema).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def js_assignment(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """The JSON that files assign to a JavaScript variable, one row a file."""
    text = spark.read.text(path, wholetext=True)
    inner = F.regexp_extract("value", rf"(?s)\b{re.escape(name)}\s*=\s*(.*?)\s*;?\s*$", 1)
    return text.select(F.from_json(inner, schema).alias("v")).where("v is not null").select("v.*")


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, content) of landed files of any kind."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")


def zipped_rows(files: DataFrame, names: list[str], sep: str = ";", encoding: str = "latin-1") -> DataFrame:
    """(path, member, names): the rows of headerless CSVs inside zip files, streamed file by file, as strings."""
    import csv

    ship_package(files.sparkSession)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "member", *names)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        with archive.open(member) as raw:
                            rows: list = []
                            for row in csv.reader(io.TextIOWrapper(raw, encoding, newline=""), delimiter=sep):
                                rows.append((path, member, *(row + [None] * len(names))[: len(names)]))
                                if len(rows) == 10_000:
                                    yield pd.DataFrame(rows, columns=schema.names)
                                    rows = []
                            yield pd.DataFrame(rows, columns=schema.names)

    return files.select("path", "content").mapInPandas(run, schema)


def docx_text(content: bytes | None) -> str:
    """The paragraphs of a Word file, one a line; empty for anything else."""
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as archive:
            root = ElementTree.fromstring(archive.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return ""
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    lines = ("".join(t.text or "" for t in p.iter(f"{ns}t")).strip() for p in root.iter(f"{ns}p"))
    return "\n".join(x for x in lines if x)


def pdf_text(content: bytes | None, most: int = 80) -> str:
    """The text of a PDF's first pages, where the optional reader is installed; else empty."""
    try:
        from pypdf import PdfReader
    except ImportError:
        return ""
    return "\n".join(page.extract_text() or "" for page in PdfReader(io.BytesIO(content or b"")).pages[:most])


@F.pandas_udf(T.StringType())
def document_text(path: pd.Series, content: pd.Series) -> pd.Series:
    """The text of a landed document by its kind: Word, PDF, or plain text in UTF-8."""
    kinds = {"docx": docx_text, "pdf": pdf_text}
    plain = lambda b: bytes(b or b"").decode("utf-8", "replace")
    return pd.Series([kinds.get(p.rsplit(".", 1)[-1].lower(), plain)(bytes(c)) for p, c in zip(path, content)])


def preferred_document(files: DataFrame, order: tuple[str, ...] = ("docx", "pdf", "md")) -> DataFrame:
    """One file of every name: the preferred kind of those that landed."""
    from millrace.operators.rank import keep_first

    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    place = F.array_position(F.array(*[F.lit(x) for x in order]), kind)
    named = files.withColumn("name", F.regexp_extract("path", r"([^/]+)\.[A-Za-z0-9]+$", 1)).withColumn("_p", place).where("_p > 0")
    return keep_first(named, ["name"], ["_p", "path"]).drop("_p")


def text_blocks(text: Column, size: int = 1800) -> Column:
    """A text in blocks of a fixed size."""
    n = F.ceil(F.char_length(text) / F.lit(size)).cast("int")
    empty = F.array().cast("array<string>")
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, (i - 1) * size + 1, F.lit(size)))).otherwise(empty)


def markdown_links(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, url) of the addresses in Markdown files, each once a file, in order."""
    from millrace.operators.rank import keep_first

    found = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.regexp_extract_all("value", F.lit(r"https?://[^\s)>\]|\"`]+"), F.lit(0))).alias("ord", "url"))
    clean = found.withColumn("url", F.regexp_replace("url", r"[.,;:]+$", ""))
    return keep_first(clean, ["file", "url"], ["ord"])


def tolerant_config(raw: dict, required: dict[str, object]) -> tuple[dict, list[str]]:
    """(config, warnings): missing keys get a default and a warning; a map keyed by name serves as a list."""
    out, warnings = dict(raw), []
    for key, default in required.items():
        if key not in out:
            warnings.append(f"missing: {key}")
            out[key] = default
        elif isinstance(default, list) and isinstance(out[key], dict):
            out[key] = [{"name": k} | (v if isinstance(v, dict) else {"value": v}) for k, v in out[key].items()]
    return out, warnings


def pending(targets: DataFrame, cache: DataFrame, key: str, state: str = "estado", retry: str = "erro") -> DataFrame:
    """Targets still to be read: those without a record, or whose record is a failure that may be retried."""
    return targets.join(cache.where(F.col(state) != retry).select(key), key, "left_anti")


def posts(items: DataFrame, now: Column, host: str, most: int = 6) -> DataFrame:
    """Published posts that are not in the future and link to a host, the newest first."""
    ok = (F.col("status") == "published") & (F.col("at") <= now) & F.contains("content", F.lit(host))
    return items.where(ok).orderBy(F.desc("at"), "slug").limit(most)
