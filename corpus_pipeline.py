"""From raw documents to a training mix: five stages, each an operator of ``placeloom.llm``.

quality        documents that the classifier scores under its threshold go
near_dups      of each near-duplicate component the document with the least id stays
decontaminate  documents with benchmark passages go
secrets        secrets are cut out of the texts, widely copied examples stay
mix            documents are taken, up to four times, until the target weights of the sources are met

Each stage gets what the one before kept, written as Parquet and read again, with the columns of ``documents``; the
last adds ``copies``. A stage's own intermediate tables go when the next one starts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from placeloom.llm import decontaminate, mixing, quality, scratch, secrets, simhash

_left: dict[str, list[str]] = {}


def _stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        scratch.release(spark, _left.pop(app, []))
        before = set(scratch.tables(spark))
        out = f(spark, docs, sf_dir)
        _left[app] = [path for path in scratch.tables(spark) if path not in before]
        return out

    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


STAGES = [
    ("quality", _stage(lambda spark, docs, sf_dir: quality.keep(docs, _table(spark, sf_dir, "labels")))),
    ("near_dups", _stage(lambda spark, docs, sf_dir: simhash.keep_first(docs))),
    ("decontaminate", _stage(lambda spark, docs, sf_dir: decontaminate.remove(docs, _table(spark, sf_dir, "benchmark")))),
    ("secrets", _stage(lambda spark, docs, sf_dir: secrets.redact(docs))),
    ("mix", _stage(lambda spark, docs, sf_dir: mixing.mixed(docs))),
]

#: SQL can't say what trained trees or fingerprints do; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
