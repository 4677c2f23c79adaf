"""Intermediate tables in the shared folder the session names in ``spark.checkpoint.dir``.

What is needed twice is written here as Parquet, which also cuts its lineage: the files outlive any executor.
``release`` removes the tables of the session; call it once their readers are done.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_own: dict[str, str] = {}
_tables: dict[str, list[tuple[SparkSession, str]]] = {}
_named: dict[str, dict[str, str]] = {}


def root(spark: SparkSession) -> str:
    """The shared folder. Without one a single machine gets a temporary folder, and a cluster an error, as its executors share no disk."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="placeloom-")
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{root(spark)}/placeloom/{name}-{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append((spark, path))
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once and read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, name: str, *facts: Column) -> tuple[DataFrame, dict]:
    """``table``, with aggregates of the rows that the same pass finds."""
    seen = Observation()
    return table(df.observe(seen, *facts), name), seen.get


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """``df``, written once in buckets of ``column``, so that reading it grouped by that column needs no shuffle."""
    spark = df.sparkSession
    path, table_name = new_path(spark, name), f"placeloom_{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, column).write.option("compression", "zstd").option("path", path).format("parquet").bucketBy(buckets, column).saveAsTable(table_name)
    _named.setdefault(spark.sparkContext.applicationId, {})[table_name] = path
    return spark.table(table_name)


def tidy(spark: SparkSession) -> None:
    """Let the driver notice dropped shuffles, whose files the context cleaner then removes."""
    spark.sparkContext._jvm.System.gc()


def tables(spark: SparkSession) -> list[str]:
    """Paths of the tables that this session has written and not removed."""
    return [path for _, path in _tables.get(spark.sparkContext.applicationId, [])]


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Remove those tables, or all; what still reads them lazily must have run."""
    app, jvm, conf = spark.sparkContext.applicationId, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = set(tables(spark) if paths is None else paths)
    for name, path in list(_named.get(app, {}).items()):
        if path in gone:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            del _named[app][name]
    for path in gone:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    _tables[app] = [x for x in _tables.get(app, []) if x[1] not in gone]


def _at_exit() -> None:
    for written in list(_tables.values()):
        if written:
            with contextlib.suppress(Exception):  # the session may have ended
                release(written[0][0])


atexit.register(_at_exit)
