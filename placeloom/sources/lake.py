"""Folders of the data lake, step manifests and record files."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from email.utils import parsedate_to_datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def version_from_last_modified(header: str | None) -> str:
    """The day of an extract's Last-Modified header."""
    if not header:
        raise RuntimeError("the response has no Last-Modified header")
    return parsedate_to_datetime(header).date().isoformat()


@dataclass(frozen=True)
class Lake:
    """Tables under ``root`` as stage/source=/version=/iso2=; manifests say which steps are done."""

    spark: SparkSession
    root: str

    def path(self, stage: str, source: str, version: str, iso2: str) -> str:
        return f"{self.root.rstrip('/')}/{stage}/source={source}/version={version}/iso2={iso2}"

    def _fs(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def write(self, records: DataFrame, folder: str, step: str = "process", info: dict | None = None) -> int:
        """Records as Parquet, nested columns as JSON text, then the step's manifest; returns the rows."""
        plain = [F.to_json(c).alias(c) if records.schema[c].dataType.typeName() in ("map", "struct", "array") else F.col(c) for c in records.columns]
        records.select(*plain).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/records")
        n = self.spark.read.parquet(f"{folder}/records").count()
        self.mark_done(folder, step, {**(info or {}), "rows": n})
        return n

    def read(self, folder: str, schema: str) -> DataFrame:
        """Records again, with the nested columns of ``schema``; columns it doesn't name go."""
        from pyspark.sql.types import StructType

        rows = self.spark.read.parquet(f"{folder}/records")
        nested = lambda f: f.dataType.typeName() in ("map", "struct", "array")
        return rows.select(*(F.from_json(f.name, f.dataType.simpleString()).alias(f.name) if nested(f) else F.col(f.name) for f in StructType.fromDDL(schema) if f.name in rows.columns))

    def mark_done(self, folder: str, step: str, info: dict) -> None:
        fs, at = self._fs(f"{folder}/_SUCCESS.{step}.json")
        out = fs.create(at, True)
        out.write(bytearray(json.dumps(info, sort_keys=True).encode()))
        out.close()

    def done(self, folder: str, step: str) -> dict | None:
        """The step's manifest, or None if it has yet to run."""
        fs, at = self._fs(f"{folder}/_SUCCESS.{step}.json")
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()


#: Bytes of a file that are held at once.
CHUNK = 1 << 20


def sha256_of_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of the files there, any length: a task opens its files and reads them piece by piece.

    Driver and executors must see the folder under ``path``, as they do any input; the listing goes through Spark, the bytes through
    pyarrow's file systems.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")

    def digest(parts):
        import pandas as pd
        from pyarrow import fs

        for part in parts:
            sums = []
            for p in part.path:
                system, name = fs.FileSystem.from_uri(p if "://" in p else "file://" + p.removeprefix("file:"))
                with system.open_input_stream(name) as stream:
                    sums.append(sha256_of(iter(lambda: stream.read(CHUNK), b"")))
            yield pd.DataFrame({"path": part.path, "length": part.length, "sha256": sums})

    return found.mapInPandas(digest, "path string, length long, sha256 string")


def sha256_of(chunks) -> str:
    h = hashlib.sha256()
    for c in chunks:
        h.update(c)
    return h.hexdigest()
