"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from millrace.llm import credentials, decontam, divergence, html_text, language, licenses, linededup, neardup, packing, quality, runs, sql, tokens, urlgraph


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.op9_language_id(_read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op10_quality_rules(_read(spark, sf_dir, "documents"))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op1_minhash_near_dedup(_read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op2_decontamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.op3_url_filter(_read(spark, sf_dir, "pages"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.op4_token_counts(_read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.op5_line_dedup(_read(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.op6_html_extraction(_read(spark, sf_dir, "pages"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op7_best_fit_packing(_read(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.op8_secret_scan(_read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.op11_periodic_runs(_read(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op12_license_scan(_read(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.op13_source_divergence(_read(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_minhash_near_dedup": op1_minhash_near_dedup,
        "op2_decontamination": op2_decontamination,
        "op3_url_filter": op3_url_filter,
        "op4_token_counts": op4_token_counts,
        "op5_line_dedup": op5_line_dedup,
        "op6_html_extraction": op6_html_extraction,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_secret_scan": op8_secret_scan,
        "op9_language_id": op9_language_id,
        "op10_quality_rules": op10_quality_rules,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_license_scan": op12_license_scan,
        "op13_source_divergence": op13_source_divergence,
    }


def oracle_sql() -> dict:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return sql.ORACLES | pipeline
