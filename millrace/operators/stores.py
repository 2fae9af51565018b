"""Store documents to normalised tables, and captures of one store merged into one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import months_since

#: The store document, as captures land it.
STORE = """marca STRING, nome STRING, url STRING, place_id STRING, latitude DOUBLE, longitude DOUBLE, nota DOUBLE, total_avaliacoes INT, endereco STRING, cidade STRING,
horario_funcionamento MAP<STRING,STRING>, horarios_pico MAP<STRING,MAP<STRING,INT>>, distribuicao_estrelas MAP<STRING,INT>, topicos_avaliacoes MAP<STRING,INT>,
destaques ARRAY<STRING>, atributos MAP<STRING,ARRAY<STRING>>,
avaliacoes ARRAY<STRUCT<id STRING, autor_info STRING, estrelas INT, data_relativa STRING, data_estimada STRING, texto STRING, curtidas INT, resposta_proprietario STRING, fotos INT>>"""


def negative_share(stars: Column) -> Column:
    """Per cent of one- and two-star marks, to one place; null without marks."""
    at = lambda k: F.coalesce(stars[k], F.lit(0))
    total = F.aggregate(F.map_values(stars), F.lit(0), lambda a, x: a + x)
    return F.bround(F.try_divide((at("1") + at("2")) * 100.0, total), 1)


def store_tables(stores: DataFrame) -> dict[str, DataFrame]:
    """The eight tables of a set of store documents, each keyed by place_id."""
    key = ["marca", "place_id"]
    lists = lambda m, a, b: stores.select(*key, F.explode(m).alias(a, b))
    hours = lists("horarios_pico", "dia", "_h").select(*key, "dia", F.explode("_h").alias("_hour", "pct")).select(*key, "dia", F.col("_hour").cast("int").alias("hora"), "pct")
    return {
        "lojas": stores.select(*key, "nome", "url", "latitude", "longitude", "nota", "total_avaliacoes", "endereco", "cidade", negative_share(F.col("distribuicao_estrelas")).alias("pct_negativas")),
        "funcionamento": lists("horario_funcionamento", "dia", "horario"),
        "pico": hours,
        "estrelas": lists("distribuicao_estrelas", "estrelas", "n"),
        "topicos": lists("topicos_avaliacoes", "topico", "n"),
        "destaques": stores.select(*key, F.posexplode("destaques").alias("ord", "destaque")),
        "atributos": lists("atributos", "grupo", "_a").select(*key, "grupo", F.explode("_a").alias("atributo")),
        "avaliacoes": stores.select(*key, F.explode("avaliacoes").alias("_r")).select(*key, "_r.*"),
    }


def compact_reviews(reviews: DataFrame, today: Column) -> DataFrame:
    """Reviews as a dashboard shows them: recency in months, reply and guide flags, month."""
    day = F.try_to_date("data_estimada")
    return reviews.select(
        "place_id", "id", "estrelas", "texto", months_since(day, today).alias("meses"), (F.coalesce("resposta_proprietario", F.lit("")) != "").alias("respondida"),
        F.coalesce(F.lower("autor_info").contains("guia"), F.lit(False)).alias("guia"), F.left("data_estimada", F.lit(7)).alias("mes"),
    )


def merge_captures(captures: DataFrame, order: str = "ord") -> DataFrame:
    """One document a place from several captures: the fullest scalars and maps, and all reviews once, first seen first."""
    full = lambda c: F.max_by(c, F.struct(F.size(F.map_filter(c, lambda k, v: v.isNotNull())), -F.col(order)))
    filled = lambda c: F.max_by(c, F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.struct(F.length(F.col(c).cast("string")), -F.col(order))))
    maps = ("horario_funcionamento", "horarios_pico", "distribuicao_estrelas", "topicos_avaliacoes")
    scalars = ("marca", "nome", "url", "endereco", "cidade")
    merged = captures.groupBy("place_id").agg(*[filled(c).alias(c) for c in scalars], *[full(c).alias(c) for c in maps], F.count("*").alias("capturas"))
    seen = captures.select("place_id", order, F.posexplode("avaliacoes").alias("_p", "_r")).groupBy("place_id", F.col("_r.id").alias("_id")).agg(F.min_by("_r", F.struct(order, "_p")).alias("_r"), F.min(F.struct(order, "_p")).alias("_o"))
    reviews = seen.groupBy("place_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_r"))), lambda x: x["_r"]).alias("avaliacoes"))
    return merged.join(reviews, "place_id", "left")


def evidence(value: Column, kind: str, url: Column, quote: Column | None = None, date: Column | None = None) -> Column:
    """A typed field: its value and where it comes from. Kinds are literal, inferido, not found and not accessible."""
    none = F.lit(None).cast("string")
    return F.struct(value.cast("string").alias("valor"), F.lit(kind).alias("tipo"), (quote if quote is not None else none).alias("quote"), url.alias("url"), (date if date is not None else none).alias("data"))


def literal_or_missing(value: Column, quote: Column, url: Column) -> Column:
    """A literal field with its quote, or one that says that nothing was found."""
    found = F.coalesce(value, F.lit("")) != ""
    return F.when(found, evidence(value, "literal", url, quote)).otherwise(evidence(F.lit(None), "not found", url))
