"""The ingest queue as tables. One driver runs it, so claiming is a query and no lock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import job_key

STALE_HOURS = 6
MAX_ATTEMPTS = 3
# Named groups of countries.
GROUPS = {"pilot": ["KZ"], "central-asia": ["KZ", "UZ", "KG", "TJ", "TM"], "test-5": ["DE", "US", "AE", "JP", "BR"]}


def enqueue(jobs: DataFrame, new: DataFrame) -> DataFrame:
    """Jobs with the new ones whose key isn't there yet."""
    return jobs.unionByName(new.dropDuplicates(["job_key"]).join(jobs.select("job_key"), "job_key", "left_anti").select(*jobs.columns))


def claimable(jobs: DataFrame, now: Column, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Pending or stale jobs with attempts left and no dependency that isn't loaded, in the order to run them."""
    stale = F.col("status").isin("DOWNLOADING", "PROCESSING") & (F.col("locked_at") < now - F.make_dt_interval(hours=F.lit(STALE_HOURS)))
    ready = jobs.where(((F.col("status") == "PENDING") | stale) & (F.col("attempts") < max_attempts))
    needs = ready.select("id", F.explode("depends_on").alias("on"))
    open_ = jobs.where("status <> 'LOADED'").select(F.col("id").alias("on"))
    waiting = needs.join(open_, "on", "left_semi").select("id").distinct()
    return ready.join(waiting, "id", "left_anti").orderBy(F.when(F.col("kind") == "source", 0).otherwise(1), "created_at", "id")


def claim(jobs: DataFrame, now: Column, worker: str, max_attempts: int = MAX_ATTEMPTS) -> tuple[DataFrame, int | None]:
    """The jobs with the first claimable one taken by ``worker``, and its id."""
    first = claimable(jobs, now, max_attempts).select("id").first()
    if first is None:
        return jobs, None
    step = F.when(F.col("step").isNull(), F.lit("DOWNLOADING")).otherwise(F.lit("PROCESSING"))
    new = {"locked_by": F.lit(worker), "locked_at": now, "attempts": F.col("attempts") + 1, "started_at": F.coalesce("started_at", now), "status": step, "error": F.lit(None)}
    return _changed(jobs, F.col("id") == first.id, new), first.id


def _changed(jobs: DataFrame, which: Column, new: dict[str, Column]) -> DataFrame:
    return jobs.select(*(F.when(which, new[c]).otherwise(F.col(c)).cast(jobs.schema[c].dataType).alias(c) if c in new else F.col(c) for c in jobs.columns))


def checkpoint(jobs: DataFrame, job_id: int, now: Column, step: str | None = None, status: str = "PROCESSING", error: str | None = None, stats: dict | None = None) -> DataFrame:
    """The job's step, status and error; ``stats`` are merged over the old ones. Also for completion (LOADED) and failure (FAILED)."""
    new = {"status": F.lit(status), "locked_at": now, "error": F.lit(error)}
    if step is not None:
        new["step"] = F.lit(step)
    new |= _with_stats(stats)
    return _changed(jobs, F.col("id") == job_id, new)


def retry_failed(jobs: DataFrame, reset: bool = False) -> DataFrame:
    """Failed jobs are pending again; without ``reset`` they keep their attempts, so an exhausted one can't be claimed."""
    return _changed(jobs, F.col("status") == "FAILED", {"status": F.lit("PENDING")} | ({"attempts": F.lit(0)} if reset else {}))


def resolve_version(jobs: DataFrame) -> DataFrame:
    """Per country the version of its resolve job: the sorted list of its sources' versions."""
    part = F.concat_ws("=", "source_id", "version")
    return jobs.where("kind = 'source'").groupBy("iso2").agg(F.array_join(F.sort_array(F.collect_list(part)), "|").alias("version"))


def _new_jobs(jobs: DataFrame, rows: list[tuple], now: Column) -> DataFrame:
    """Pending jobs from (iso2, kind, source, version, pipeline, depends_on), with ids after the largest there is."""
    first = (jobs.agg(F.max("id")).first()[0] or 0) + 1
    keys = "n long, iso2 string, kind string, source_id string, version string, pipeline string, depends_on array<long>"
    new = jobs.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(rows)], keys)
    given = {"id": F.col("n") + first, "job_key": job_key(F.col("iso2"), F.col("kind"), F.col("source_id"), F.col("version"), F.col("pipeline")), "iso2": F.upper("iso2"), "status": F.lit("PENDING"), "attempts": F.lit(0), "created_at": now, "stats": F.create_map()}
    given |= {c: F.col(c) for c in ("kind", "source_id", "version", "pipeline", "depends_on")}
    return new.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in jobs.schema.fields))


def plan(jobs: DataFrame, iso2: str, versions: dict[str, str], pipeline: str, now: Column) -> DataFrame:
    """``jobs`` with those of a country: one for each source and version, and the resolve job that waits for all of them. Known keys add nothing."""
    sources = sorted(versions.items())
    out = enqueue(jobs, _new_jobs(jobs, [(iso2, "source", s, v, pipeline, []) for s, v in sources], now))
    wanted = [f"{iso2.upper()}:source:{s}:{v}:{pipeline}" for s, v in sources]
    waits = sorted(r.id for r in out.where(F.col("job_key").isin(*wanted)).select("id").collect())  # one for each source
    version = "|".join(f"{s}={v}" for s, v in sources)
    return enqueue(out, _new_jobs(out, [(iso2, "resolve", None, version, pipeline, waits)], now))


def set_version(jobs: DataFrame, job_id: int, version_id: int) -> DataFrame:
    return _changed(jobs, F.col("id") == job_id, {"dataset_version": F.lit(version_id)})


def _with_stats(stats: dict | None) -> dict[str, Column]:
    if not stats:
        return {}
    fresh = F.create_map(*(F.lit(str(x)) for kv in stats.items() for x in kv))
    return {"stats": F.map_concat(F.map_filter(F.coalesce("stats", F.create_map().cast("map<string,string>")), lambda k, _: ~F.map_contains_key(fresh, k)), fresh)}


def complete(jobs: DataFrame, job_id: int, now: Column, stats: dict | None = None) -> DataFrame:
    """The job is loaded: its last step done, its lock gone."""
    return _changed(jobs, F.col("id") == job_id, {"status": F.lit("LOADED"), "step": F.lit("done"), "finished_at": now, "locked_by": F.lit(None), "locked_at": F.lit(None)} | _with_stats(stats))


def fail(jobs: DataFrame, job_id: int, error: str) -> DataFrame:
    """The job has failed; its step and attempts stay, so that a retry goes on from there."""
    return _changed(jobs, F.col("id") == job_id, {"status": F.lit("FAILED"), "error": F.lit(error), "locked_by": F.lit(None), "locked_at": F.lit(None)})


def log_run(runs: DataFrame, job_id: int, step: str, worker: str, status: str, now: Column, stats: dict | None = None, error: str | None = None) -> DataFrame:
    """The run log with one more line."""
    values = {"job_id": F.lit(job_id), "step": F.lit(step), "worker": F.lit(worker), "started_at": now, "finished_at": now, "status": F.lit(status), "error": F.lit(error)}
    values["stats"] = F.create_map(*(F.lit(str(x)) for kv in (stats or {}).items() for x in kv))
    line = runs.sparkSession.range(1).select(*(values[f.name].cast(f.dataType).alias(f.name) for f in runs.schema.fields))
    return runs.unionByName(line)


def summary(jobs: DataFrame) -> DataFrame:
    """Failed jobs: (job_key, attempts, error)."""
    return jobs.where("status = 'FAILED'").select("job_key", "attempts", "error")
