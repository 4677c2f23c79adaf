"""Documents dealt into blocks by a hash of the whole row, for operators that go over the texts several times.

A block is a group of whole documents of bounded total size that one task holds. What a block needs from the rest of
the corpus reaches it by a cogroup on the block's number: keys that the block asked for, never more than its own
texts have. The blocks are stored in buckets, so each pass reads them without a shuffle of the texts. Rows that agree in everything, or
whose id is null or repeated, spread like all others: the row's place in the input is part of the hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch
from .texts import text_bytes

#: Bytes of text to a block.
BLOCK_BYTES = 12 << 20
LEAST_BLOCKS = 8
#: Up to so many blocks, each gets a bucket of its own; beyond, chance evens them out.
PLACED = 2048
#: Buckets at most, each with several blocks from there on; Spark allows 100,000.
BUCKETS = 1 << 16


def _numbers(spark: SparkSession, n: int) -> list[int]:
    """Block numbers of which each hashes to another of ``n`` buckets."""
    if n > PLACED:
        return []
    tried = spark.range(0, n * 30, 1, 1).select(F.col("id").cast("int").alias("i")).select("i", F.pmod(F.hash("i"), F.lit(n)).alias("bucket"))
    found = [r.i for r in tried.groupBy("bucket").agg(F.min("i").alias("i")).collect()]
    return sorted(found) if len(found) == n else []


def deal(docs: DataFrame, name: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` and ``block``, stored in buckets of it. The number of blocks changes no result."""
    n = max(LEAST_BLOCKS, -(-text_bytes(docs) // block_bytes))
    numbers, nth = _numbers(docs.sparkSession, n), F.pmod(F.xxhash64(*docs.columns, F.monotonically_increasing_id()), F.lit(n)).cast("int")
    rows = docs.withColumn("block", nth)
    if numbers:
        rows = rows.withColumn("block", F.element_at(F.array(*(F.lit(i) for i in numbers)), F.col("block") + 1))
    out = scratch.bucketed(rows, name, "block", min(n, BUCKETS))
    scratch.tidy(docs.sparkSession)
    return out
