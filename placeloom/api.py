"""What the endpoints and commands answer, as functions that return DataFrames. No server, no request parsing.

Tables are those of a store: places, lineage, versions. Results of a score are kept per (city, category, version), for ten minutes.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import categories as cat
from .functions.fixed import TAXONOMY, lines
from .functions.geo import Box
from .functions.hexgrid import HexGrid
from .operators import reports, scoring, upsert
from .sources import places as sources
from .sources.tables import Busy, Tables

__all__ = ["CITIES", "Busy", "City", "NoData", "NotFound", "Store", "Unknown", "city"]


class NotFound(KeyError):
    """No such city."""


class Unknown(ValueError):
    """No such category or cell."""


class NoData(RuntimeError):
    """Nothing is loaded for the city."""


@dataclass(frozen=True)
class City:
    slug: str
    name: str
    country: str
    box: Box
    center: tuple[float, float]


# The cities there are.
CITIES = {"almaty": City("almaty", "Алматы", "KZ", Box(76.74, 43.15, 77.10, 43.40), (76.9286, 43.2389))}


def city(slug: str) -> City:
    if slug not in CITIES:
        raise NotFound(f"unknown city '{slug}'")
    return CITIES[slug]


def _category(category: str) -> str:
    if category not in cat.IDS:
        raise Unknown(f"unknown category '{category}'")
    return category


#: Seconds for which a score is kept.
KEPT_S = 600


@dataclass
class Store:
    """A city store: ``root`` holds places, lineage and versions, each load one commit. ``clock`` counts seconds."""

    spark: SparkSession
    root: str
    grid: HexGrid = field(default_factory=HexGrid)
    clock: Callable[[], float] = time.monotonic
    _scores: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.tables = Tables(self.spark, self.root)

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise NoData(f"nothing is loaded into {self.root}")
        return self.tables.read(name)

    def health(self, now: Column) -> DataFrame:
        return self.spark.range(1).select(F.lit("ok").alias("status"), now.alias("time"))

    def cities(self) -> DataFrame:
        """(slug, name, country, center, bbox) of the cities there are."""
        rows = [(c.slug, c.name, c.country, list(c.center), [c.box.xmin, c.box.ymin, c.box.xmax, c.box.ymax]) for c in CITIES.values()]
        return self.spark.createDataFrame(rows, "slug string, name string, country string, center array<double>, bbox array<double>")

    def sample(self, slug: str, raw: DataFrame, limit: int = 25) -> tuple[list[tuple[str, str]], DataFrame]:
        """Columns and a few rows of the raw places of a city."""
        if not 1 <= limit <= 200:
            raise Unknown("the limit is from 1 to 200")
        return sources.sample(raw, city(slug).box, limit)

    def _version(self, c: City) -> int:
        row = self.table("versions").where((F.col("country") == c.country) & (F.col("status") == "active")).orderBy(F.desc("ingested_at"), F.desc("id")).select("id").first()
        if row is None:
            raise NoData(f"nothing is loaded for {c.slug}")
        return row.id

    def _places(self, c: City) -> DataFrame:
        return self.table("places").where(c.box.contains(F.col("lon"), F.col("lat")))

    def status(self, now: Column) -> dict[str, DataFrame]:
        return {"totals": reports.totals(self.table("places")), "freshness": reports.freshness(self.table("versions"), now)}

    def meta(self, slug: str) -> DataFrame:
        """(id, name, group, n): places of every category but the roots, subtrees included."""
        names = self.spark.createDataFrame([(i, ru) for i, ru, *_ in lines(TAXONOMY)], "id string, name string")
        rolled = reports.rollup(self._places(city(slug)))
        out = rolled.join(names, F.col("category_id") == F.col("id"), "left").withColumn("root", cat.root(F.col("category_id")))
        groups = names.select(F.col("id").alias("root"), F.col("name").alias("group"))
        return out.join(groups, "root", "left").select(F.col("category_id").alias("id"), "name", "group", "n")

    def scores(self, slug: str, category: str) -> DataFrame:
        """Scores of the city's cells; kept for ten minutes, or until a newer version comes."""
        c = city(slug)
        key = (slug, _category(category), self._version(c))
        for old, (df, until) in list(self._scores.items()):
            if until <= self.clock() or (old[:2] == key[:2] and old != key):
                df.unpersist()
                del self._scores[old]
        if key not in self._scores:
            self._scores[key] = scoring.score(self._places(c), category, self.grid).persist(), self.clock() + KEPT_S
        return self._scores[key][0]

    def best(self, slug: str, category: str, limit: int = 5) -> DataFrame:
        """(place, cell, score, act10, landmark) of the best cells, spread out."""
        if not 1 <= limit <= 20:
            raise Unknown("the limit is from 1 to 20")
        found = scoring.best_cells(self.scores(slug, category), limit)
        return found.join(scoring.landmarks(found.select("cell"), self.table("places"), self.grid), "cell", "left").orderBy("place")

    def cell(self, cell: int, slug: str, category: str) -> dict[str, DataFrame]:
        if not 0 <= cell < 1 << 42:
            raise Unknown("no such cell")
        one = self.spark.createDataFrame([(cell,)], "cell long")
        scored = self.scores(slug, category)
        mine = scored.where(F.col("cell") == cell)
        lat, lon = self.grid.centre(F.col("cell"))
        return {
            "score": mine, "why": scoring.explained(mine, scored), "medians": scoring.medians(scored), "nearby": scoring.cell_detail(one, self.table("places"), category, grid=self.grid),
            "places_nearby": scoring.places_nearby(one, self.table("places"), self.grid), "center": one.select(lon.alias("lon"), lat.alias("lat")),
        }

    def places(self, slug: str, category: str, limit: int = 3000) -> DataFrame:
        return reports.geojson(self._places(city(slug)), _category(category), limit)

    def source_categories(self, slug: str, mapped: bool = False, limit: int = 80) -> DataFrame:
        return reports.source_categories(self._places(city(slug)), mapped, limit)

    def bootstrap(self, slug: str, raw: DataFrame, release: str, now: Column, force: bool = False) -> int | None:
        """Load a city from a places table: places, their lineage and the version in one commit. None if a version of the last 12 hours makes
        that needless; ``Busy`` if another load is on."""
        c = city(slug)
        with self.tables.locked("bootstrap"):
            there = "versions" in self.tables
            if there and not force and upsert.fresh_enough(self.table("versions"), now).where(F.col("country") == c.country).limit(1).count():
                return None
            new = sources.city_places(sources.extract_city(raw, c.box), c.country, self.grid)
            number = (self.table("versions").agg(F.max("id")).first()[0] or 0) + 1 if there else 1
            row = new.agg(F.count("*").alias("row_count")).select(F.lit(number).cast("long").alias("id"), F.lit("overture_places").alias("source_id"), F.lit(c.country).alias("country"), F.lit(release).alias("source_version"), F.lit("staged").alias("status"), now.cast("timestamp").alias("ingested_at"), "row_count")
            lineage = new.select(F.lit("overture_places").alias("source_id"), F.col("gers_id").alias("source_record_id"), F.lit(number).cast("long").alias("dataset_version"), "place_id", F.lit(1.0).alias("match_score"), F.lit("seed").alias("match_method"))
            versions = self.table("versions").unionByName(row) if there else row
            self.tables.commit({
                "places": upsert.upsert(self.table("places"), new, ["place_id"]) if there else new,
                "lineage": upsert.upsert(self.table("lineage"), lineage, ["source_id", "source_record_id", "dataset_version"], update=False) if there else lineage,
                "versions": upsert.activate(versions, number),
            })
        for old, _ in self._scores.values():
            old.unpersist()
        self._scores.clear()
        return number
