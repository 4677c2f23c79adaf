"""Commands over the engine: ``python -m placeloom <command>``. Sources are those of ``readers`` below, over what lies in the data root."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .config import Settings
from .functions.geo import Box
from .ingest import Engine, Source
from .operators import reports, spatial
from .sources import places


def readers(spark: SparkSession, settings: Settings) -> dict[str, Source]:
    """Releases of open places and areas at ``places_root``; tagged objects, decoded into Parquet, at <data_root>/osm/<country>/<version>."""
    release = lambda _: settings.release

    def scan(theme: str, kind: str):
        return places.scan(spark, settings.places_root, settings.release, theme, kind)

    def country(iso2: str):
        return spatial.countries(scan("divisions", "division_area").where(f"country = '{iso2}'"))

    def open_places(iso2: str, _: str):
        return places.from_places(places.extract_country(scan("places", "place"), country(iso2)), iso2)

    def areas(iso2: str, _: str):
        return places.divisions(scan("divisions", "division_area"), iso2)

    def tagged(iso2: str, version: str):
        row = country(iso2).first()
        return places.from_tags(spark.read.parquet(f"{settings.data_root}/osm/{iso2}/{version}"), iso2, Box(row.xmin, row.ymin, row.xmax, row.ymax))

    def newest(iso2: str) -> str:
        return places.latest_release(places.list_releases(spark, f"{settings.data_root}/osm/{iso2}"))

    made = (Source("overture_divisions", release, areas, areas=True), Source("overture_places", release, open_places), Source("osm", newest, tagged))
    return {s.id: s for s in made}


def main(argv: list[str] | None = None, engine: Engine | None = None) -> None:
    parser = argparse.ArgumentParser(prog="placeloom")
    of = parser.add_subparsers(dest="command", required=True)
    of.add_parser("seed", help="missing tables, sources, categories and their mappings")
    sync = of.add_parser("sync", help="countries from the release's divisions")
    sync.add_argument("--countries", help="codes, joined by commas; all by default")
    for name, what in (("country", "iso2"), ("region", "name")):
        one = of.add_parser(name, help=f"queue a {name}")
        one.add_argument(what)
        one.add_argument("--source", action="append")
        one.add_argument("--run", action="store_true")
    of.add_parser("world", help="queue every country of the registry").add_argument("--source", action="append")
    of.add_parser("update", help="queue every loaded country again")
    of.add_parser("work", help="run what is queued").add_argument("--most", type=int)
    of.add_parser("retry", help="queue failed jobs again").add_argument("--reset", action="store_true")
    of.add_parser("status", help="coverage, totals and freshness")
    of.add_parser("unmapped", help="source categories without a category").add_argument("--top", type=int, default=50)
    args = parser.parse_args(argv)
    if engine is None:
        spark, settings = SparkSession.builder.appName("placeloom").getOrCreate(), Settings.of()
        engine = Engine(spark, settings, readers(spark, settings))
    if args.command == "seed":
        engine.bootstrap()
    elif args.command == "sync":
        divisions = places.scan(engine.spark, engine.settings.places_root, engine.settings.release, "divisions", "division_area")
        print(engine.sync_registry(divisions, args.countries.split(",") if args.countries else None), "countries")
    elif args.command == "country":
        print(engine.enqueue(args.iso2, args.source))
    elif args.command == "region":
        print(engine.enqueue_region(args.name))
    elif args.command == "world":
        print(len(engine.enqueue_world(args.source or ("divisions", "overture"))), "countries queued")
    elif args.command == "update":
        print(len(engine.enqueue_update()), "countries queued")
    elif args.command == "retry":
        print(engine.retry_failed(args.reset), "jobs queued again")
    elif args.command == "status":
        for name, df in engine.status().items():
            print(name, *(row.asDict() for row in df.collect()), sep="\n  ")
    elif args.command == "unmapped":
        table = engine.tables.read("place")
        print(*(row.asDict() for row in [reports.unmapped_share(table).first(), *reports.source_categories(table, False, args.top).collect()]), sep="\n")
    if args.command == "work" or getattr(args, "run", False):
        print(engine.work(getattr(args, "most", None)), "jobs loaded")


if __name__ == "__main__":
    main()
