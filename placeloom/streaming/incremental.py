"""Loads as they arrive: each micro-batch of places is merged by the batch operators. An addition; batches work alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import upsert
from ..sources.tables import Tables


def merge_stream(places: DataFrame, tables: Tables, checkpoint: str, name: str = "place", dirty: str = "dirty") -> StreamingQuery:
    """Upsert a stream of ``places`` (place_id, content_hash, cell, …, loaded_on) into the table ``name``.

    The newest row of an id in a batch counts. Places, the cells to recompute (cell, batch) and the batch's number change in one commit,
    so a batch that runs again after it was committed does nothing, and one that wasn't leaves no trace.
    """

    def merge(batch: DataFrame, number: int) -> None:
        tables_ = Tables(batch.sparkSession, tables.root)
        seen = tables_.read(dirty).agg(F.max("batch")).first()[0] if dirty in tables_ else None
        if seen is not None and seen >= number:
            return
        new = batch.groupBy("place_id").agg(F.max_by(F.struct(*batch.columns), F.col("loaded_on")).alias("r")).select("r.*")
        old = tables_.read(name)
        changed = new.join(old.select("place_id", F.col("content_hash").alias("was")), "place_id", "left").where("was IS NULL OR was <> content_hash").select("cell").distinct()
        marked = changed.withColumn("batch", F.lit(number).cast("long"))
        # a row without a cell says that the batch is in, also where it changed nothing
        marked = marked.unionByName(batch.sparkSession.range(1).select(F.lit(None).cast("long").alias("cell"), F.lit(number).cast("long").alias("batch")))
        tables_.commit({name: upsert.upsert(old, new, ["place_id"]), dirty: tables_.read(dirty).unionByName(marked) if dirty in tables_ else marked})

    return places.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
