"""Counts and status reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import categories as cat


def per_category(places: DataFrame) -> DataFrame:
    return places.groupBy("category_id").agg(F.count("*").alias("n"))


def rollup(places: DataFrame) -> DataFrame:
    """(category_id, n) of every category but the roots, its subtree included, zeros too; (null, n): unmapped.

    Counted per category before the few counts go up to their ancestors.
    """
    counts = per_category(places)
    up = counts.where("category_id IS NOT NULL").select(F.explode(cat.ancestors(F.col("category_id"))).alias("category_id"), "n").groupBy("category_id").agg(F.sum("n").alias("n"))
    tree = cat.dimension(places.sparkSession).where("parent_id IS NOT NULL").select(F.col("id").alias("category_id"))
    known = tree.join(up, "category_id", "left").select("category_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    return known.unionByName(counts.where("category_id IS NULL"))


def source_categories(places: DataFrame, mapped: bool, top: int) -> DataFrame:
    """The most frequent source categories that are mapped, or aren't."""
    some = places.where(F.col("category_id").isNotNull() if mapped else F.col("category_id").isNull())
    name = F.coalesce("source_category", F.lit("<none>")).alias("source_category")
    return some.groupBy(name, "category_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_category", "category_id").limit(top)


def unmapped_share(places: DataFrame) -> DataFrame:
    return places.agg(F.count("*").alias("total"), F.count_if(F.col("category_id").isNull()).alias("unmapped")).withColumn("percent", F.bround(F.lit(100.0) * F.col("unmapped") / F.nullif(F.col("total"), F.lit(0)), 1))


def totals(places: DataFrame, areas: DataFrame | None = None, dirty: DataFrame | None = None, countries: DataFrame | None = None) -> DataFrame:
    """One row: places and their cells; cities, dirty cells and countries where these tables are given."""
    out = places.agg(F.count("*").alias("places"), F.count_distinct("cell").alias("cells"))
    more = {"cities": areas.where("level = 'city'") if areas is not None else None, "dirty_cells": dirty, "countries": countries}
    for name, df in more.items():
        if df is not None:
            out = out.join(df.agg(F.count("*").alias(name)), F.lit(True))
    return out


def coverage(countries: DataFrame, jobs: DataFrame, places: DataFrame) -> DataFrame:
    """(iso2, name, status, places): the worst status of a country's jobs and its places."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    status = F.when(n("FAILED") > 0, "FAILED").when(n("DOWNLOADING", "PROCESSING") > 0, "PROCESSING").when(n("PENDING") > 0, "PENDING").otherwise("LOADED")
    by_job, by_place = jobs.groupBy("iso2").agg(status.alias("job_status")), places.groupBy("iso2").agg(F.count("*").alias("n_places"))
    out = countries.join(by_job, "iso2", "left").join(by_place, "iso2", "left")
    return out.select("iso2", "name", F.coalesce("job_status", F.lit("NOT_QUEUED")).alias("status"), F.coalesce("n_places", F.lit(0).cast("long")).alias("places"))


def by_status(covered: DataFrame) -> DataFrame:
    return covered.groupBy("status").agg(F.count("*").alias("countries"))


def freshness(versions: DataFrame, now: Column) -> DataFrame:
    """Of each source's active versions the latest, when it came and whole days since."""
    out = versions.where("status = 'active'").groupBy("source_id").agg(F.max("source_version").alias("latest_version"), F.max("ingested_at").alias("last_ingested_at"))
    days = F.floor((F.unix_micros(now) - F.unix_micros(F.col("last_ingested_at").cast("timestamp"))) / 86_400_000_000.0)
    return out.withColumn("days_since_ingest", days.cast("long"))


def places_in(places: DataFrame, areas: DataFrame, prefix: str) -> DataFrame:
    """Places per category in areas whose name starts so, whatever the case."""
    named = areas.where(F.col("name").ilike(prefix.replace("%", r"\%").replace("_", r"\_") + "%")).select("area_id")
    return places.join(named, "area_id", "left_semi").groupBy("category_id").agg(F.count("*").alias("n"))


def geojson(places: DataFrame, category: str, limit: int = 3000) -> DataFrame:
    """One row: a FeatureCollection of the category's places, the least ids first. The limit is the endpoint's."""
    rows = places.where(cat.within(F.col("category_id"), category)).orderBy("place_id").limit(limit)
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"), F.struct("name", F.col("category_id").alias("category")).alias("properties"))
    listed = rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("place_id", feature.alias("f")))), lambda x: x["f"]).alias("features"))
    return listed.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("geojson"))
