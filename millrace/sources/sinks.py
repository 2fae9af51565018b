"""Ways out: flattened CSV, JSON documents, several tables at once, and digests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """All columns as strings: lists joined by `` | ``, maps as ``k: v``, structs as JSON, missing ones empty."""
    have = {f.name: f.dataType for f in df.schema}

    def one(name: str) -> Column:
        kind = have.get(name)
        if kind is None:
            return F.lit("").alias(name)
        c = F.col(f"`{name}`")
        if isinstance(kind, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: F.to_json(x) if isinstance(kind.elementType, T.StructType) else x.cast("string")), " | ")
        elif isinstance(kind, T.MapType):
            c = F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws(": ", e["key"], e["value"].cast("string"))), " | ")
        elif isinstance(kind, T.StructType):
            c = F.to_json(c)
        return F.coalesce(c.cast("string"), F.lit("")).alias(name)

    return df.select(*[one(c) for c in (columns or df.columns)])


def people(contacts: Column, name: str = "nome", role: str = "cargo") -> Column:
    """A list of people as ``name (role) | name``."""
    shown = F.transform(contacts, lambda p: F.when(F.coalesce(p[role], F.lit("")) == "", p[name]).otherwise(F.concat(p[name], F.lit(" ("), p[role], F.lit(")"))))
    return F.array_join(shown, " | ")


def write_csv(df: DataFrame, path: str, columns: Iterable[str] | None = None) -> None:
    """A folder of CSV files with a fixed projection and headers; the committer makes it appear whole."""
    flat(df, columns).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> list[str]:
    """Each table as a CSV folder under its name."""
    for name, df in tables.items():
        write_csv(df, f"{path.rstrip('/')}/{name}")
    return sorted(tables)


def write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """A Parquet table whose partitions are replaced one by one, so that a rerun of one day leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def digest(df: DataFrame, category: str, order: Iterable[str], line: Column, newest: list) -> DataFrame:
    """(category, place, lines): each category's lines in order, categories in a given order, unlisted ones left out."""
    from pyspark.sql import Window as W

    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(category))
    rows = df.withColumn("_place", place).where("_place > 0").withColumn("_rn", F.row_number().over(W.partitionBy(category).orderBy(*newest)))
    packed = rows.groupBy(category, F.col("_place").alias("place")).agg(F.array_sort(F.collect_list(F.struct("_rn", line.alias("line")))).alias("_l"))
    return packed.select(category, "place", F.transform("_l", lambda x: x["line"]).alias("lines"))


def markdown(lines: DataFrame, title: str) -> DataFrame:
    """(place, text): a section of a Markdown report for every category of a :func:`digest`, its lines as a list."""
    text = F.concat(F.lit("## "), F.col(title), F.lit("\n\n"), F.array_join(F.transform("lines", lambda x: F.concat(F.lit("- "), x)), "\n"), F.lit("\n"))
    return lines.select("place", text.alias("text"))


#: Most rows of a report that becomes one string.
MAX_DOCUMENT_ROWS = 100_000


def document(df: DataFrame, most: int = MAX_DOCUMENT_ROWS) -> str:
    """A report's table as one JSON array; larger tables are an error, for them there is :func:`write_json`."""
    rows = df.select(F.to_json(F.struct("*"))).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return "[" + ",".join(r[0] for r in rows) + "]"
