"""Tables that change together: each commit writes new folders and then replaces one small file that names them all.

A reader sees the tables of one commit or of the next, never a mixture, and a job that dies leaves the last commit in
place. Several tables make one transaction; those that a commit doesn't mention stay as they are.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Busy(RuntimeError):
    """Another load holds the lock."""


@dataclass(frozen=True)
class Tables:
    """Tables under ``root``; ``_current`` there holds, as JSON, the folder of each."""

    spark: SparkSession
    root: str

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/{name}")

    def _fs(self):
        return self._path("_current").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _manifest(self) -> dict:
        fs, at = self._fs(), self._path("_current")
        if not fs.exists(at):
            return {"number": 0, "tables": {}}
        stream = fs.open(at)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def __contains__(self, name: str) -> bool:
        return name in self._manifest()["tables"]

    def names(self) -> list[str]:
        return sorted(self._manifest()["tables"])

    def number(self) -> int:
        """How many commits there have been."""
        return self._manifest()["number"]

    def read(self, name: str) -> DataFrame:
        folder = self._manifest()["tables"].get(name)
        if folder is None:
            raise KeyError(f"no table '{name}' in {self.root}")
        return self.spark.read.parquet(f"{self.root.rstrip('/')}/{folder}")

    def commit(self, changed: dict[str, DataFrame]) -> int:
        """All of ``changed`` or nothing becomes current; the commit's number. New rows may be made from the current tables."""
        old = self._manifest()
        tables = dict(old["tables"])
        for name, df in changed.items():
            folder = f"{name}/{uuid.uuid4().hex}"
            df.write.option("compression", "zstd").parquet(f"{self.root.rstrip('/')}/{folder}")
            tables[name] = folder
        new = {"number": old["number"] + 1, "tables": tables, "before": old["tables"]}
        self._replace(json.dumps(new, sort_keys=True).encode())
        return new["number"]

    def _replace(self, data: bytes) -> None:
        """The manifest is written beside and renamed over the old one, in one step where the file system has it."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        beside, at = self._path(f"_new-{uuid.uuid4().hex}"), self._path("_current")
        out = self._fs().create(beside, True)
        out.write(bytearray(data))
        out.close()
        over = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(beside, at, over)

    def vacuum(self) -> int:
        """Remove folders that neither the current commit nor the one before names; how many went. Not while another load writes."""
        manifest, fs, gone = self._manifest(), self._fs(), 0
        kept = {*manifest["tables"].values(), *manifest.get("before", {}).values()}
        for name in manifest["tables"]:
            for status in fs.listStatus(self._path(name)):
                if f"{name}/{status.getPath().getName()}" not in kept:
                    fs.delete(status.getPath(), True)
                    gone += 1
        return gone

    def locked(self, name: str = "load"):
        """A context that one load at a time can be in; others get ``Busy``. The lock is a file that only one can create."""
        return _Lock(self, self._path(f"_lock-{name}"))


class _Lock:
    def __init__(self, tables: Tables, at) -> None:
        self.tables, self.at = tables, at

    def __enter__(self) -> None:
        from py4j.protocol import Py4JJavaError

        try:
            self.tables._fs().create(self.at, False).close()
        except Py4JJavaError as e:
            if self.tables._fs().exists(self.at):
                raise Busy(f"{self.at} is held") from e
            raise

    def __exit__(self, *_) -> None:
        self.tables._fs().delete(self.at, False)
