"""The opN queries over the tables in ``sf_dir``, and their DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ctw, decontaminate, linefreq, mixing, quality, recompress, secrets, simhash, tokencount, warc

ORACLES: dict[str, str] = {"op4_linefreq": linefreq.ORACLE, "op5_warc": warc.ORACLE, "op7_mixing": mixing.ORACLE, "op10_recompress": recompress.ORACLE}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with the corpus' word on who owns them."""
    return secrets.report(_table(spark, sf_dir, "documents"))


def op2_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and context-tree scores of every document."""
    return ctw.score(_table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item, windows of 13 words."""
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_linefreq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the line-frequency verdict of every document."""
    return linefreq.report(_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return warc.derive(warc.responses(_table(spark, sf_dir, "pages")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.report(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the target weights take, and how often."""
    return mixing.report(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score from boosted trees."""
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, before and after the same three edits to each."""
    return tokencount.count(_table(spark, sf_dir, "documents"), tokencount.revision())


def op10_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that a smaller document has in a window of 13."""
    return recompress.dedup(_table(spark, sf_dir, "documents"), texts=False)
