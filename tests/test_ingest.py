from datetime import datetime

import pytest
from pyspark.sql import functions as F

from placeloom.__main__ import main
from placeloom.config import Settings
from placeloom.functions.geo import Box, rectangle
from placeloom.ingest import Engine, Source
from placeloom.sources import places, schemas
from placeloom.sources.tables import Tables

LAT, LON, M = 43.2220, 76.9210, 1 / 111320
OPEN = "id string, name string, lat double, lon double, basic_category string, confidence double, phone string"


def open_rows(spark, version):
    rows = [("g1", "Coffee Boom", LAT, LON, "coffee_shop", 0.9, "+77001112233"), ("g2", "Europharma", LAT + 300 * M, LON, "pharmacy", 0.8, None), ("g3", "Somewhere in Paris", 48.85, 2.35, "cafe", 0.9, None)]
    rows += [(f"x{i}", f"Shop {'abcdefghijkl'[i] * 5}", LAT + (5000 + 900 * i) * M, LON, "supermarket", 0.9, None) for i in range(9)]
    if version == "v2":  # a place with another name, one that is gone, a new one
        rows[3] = ("x0", "Quite another name", *rows[3][2:])
        rows = [r for r in rows if r[0] != "x1"] + [("x9", "Shop zzzzz", LAT + 20_000 * M, LON, "supermarket", 0.9, None)]
    if version == "bad":
        rows = rows[:4] + [(f"p{i}", "Paris", 48.85, 2.35, "cafe", 0.9, None) for i in range(9)]
    return places.from_places(spark.createDataFrame(rows, OPEN), "KZ")


def tagged_rows(spark):
    rows = [("n1", {"amenity": "cafe", "cuisine": "coffee_shop", "name": "Кофе Бум", "phone": "8 700 111 22 33", "addr:street": "Abay"}, LAT + 15 * M, LON), ("n2", {"amenity": "pharmacy", "name": "Европа"}, LAT + 900 * M, LON)]
    return places.from_tags(spark.createDataFrame(rows, "osm_id string, tags map<string,string>, lat double, lon double"), "KZ")


def divisions(spark):
    box = lambda *b: spark.range(1).select(rectangle(Box(*b)).alias("rings"), F.struct(*(F.lit(float(v)).alias(n) for n, v in zip(("xmin", "ymin", "xmax", "ymax"), b))).alias("bbox"))
    rows = [("c", "country", "KZ", "Kazakhstan", (46.49, 40.57, 87.36, 55.44)), ("c2", "country", "UZ", "Uzbekistan", (55.0, 37.0, 73.0, 45.6)), ("r", "region", "KZ", "Almaty region", (76.0, 42.5, 78.0, 44.5)), ("t", "locality", "KZ", "Almaty", (76.8, 43.1, 77.1, 43.26))]
    out = None
    for i, kind, iso2, name, b in rows:
        one = box(*b).select(F.lit(i).alias("id"), F.lit(kind).alias("subtype"), F.lit(iso2).alias("country"), F.lit(name).alias("name"), F.struct(F.lit(name).alias("primary")).alias("names"), "rings", "bbox", F.lit(True).alias("is_land"))
        out = one if out is None else out.unionByName(one)
    return out


@pytest.fixture
def engine(spark, tmp_path):
    at = {"v": "v1", "t": datetime(2026, 1, 5, 12)}
    sources = (
        Source("overture_divisions", lambda _: "v1", lambda iso2, _: places.divisions(divisions(spark), iso2), areas=True), Source("overture_places", lambda _: at["v"], lambda _, v: open_rows(spark, v)), Source("osm", lambda _: "v1", lambda *_: tagged_rows(spark)),
    )
    made = Engine(spark, Settings(data_root=str(tmp_path / "lake"), store=str(tmp_path / "store")), {s.id: s for s in sources}, clock=lambda: at["t"])
    made.at = at
    made.bootstrap()
    made.sync_registry(divisions(spark))
    return made


def test_from_sources_to_places(spark, engine, capsys):
    ids = engine.enqueue("KZ")
    assert set(ids) == {"overture_divisions", "overture_places", "osm", "resolve"} and engine.enqueue("kz") == ids
    main(["work"], engine)
    assert "4 jobs loaded" in capsys.readouterr().out
    read = engine.tables.read
    jobs = {r.kind + ":" + (r.source_id or ""): r for r in read("ingest_job").collect()}
    assert {r.status for r in jobs.values()} == {"LOADED"} and jobs["source:overture_places"].stats["dropped"] == "1"
    stats = jobs["resolve:"].stats
    assert (stats["records"], stats["entities"], stats["merges"], stats["inserted"]) == ("13", "12", "1", "12") and int(stats["pairs_compared"]) >= 1 and stats["review_pairs"] == "0"
    place = {r.name: r for r in read("place").collect()}
    assert len(place) == 12 and "Coffee Boom" not in place
    boom = place["Кофе Бум"]
    assert boom.category_id == "food.cafe.coffee_shop" and boom.source_count == 2 and boom.phone == "+77001112233" and boom.address == {"street": "Abay"} and boom.area_id == "t" and boom.cell and boom.parent1 and str(boom.first_seen) == "2026-01-05"
    assert {r.area_id for r in read("place").where("name LIKE 'Shop%'").collect()} == {"r"}
    assert {r.area_id: r.parent_id for r in read("admin_area").where("country_iso2 = 'KZ'").collect()} == {"country:KZ": None, "r": "country:KZ", "t": "r"}
    assert {r.source_record_id: r.match_method for r in read("place_source").collect()}["g1"] == "rule:phone" and read("place_source").count() == 13
    assert {r.cell for r in read("dirty_cell").collect()} == {r.cell for r in place.values()}
    assert {(r.source_id, r.status) for r in read("dataset_version").collect()} == {("overture_divisions", "active"), ("overture_places", "active"), ("osm", "active")}
    assert read("pipeline_run").where("status = 'ok'").count() == 4 and schemas.violations(engine.tables).collect() == []

    # the same sources under a newer version: one place renamed, one gone, one new
    engine.tables.commit({"dirty_cell": schemas.empty(spark, "dirty_cell")})
    engine.at |= {"v": "v2", "t": datetime(2026, 2, 5, 12)}
    assert engine.enqueue_update() == ["KZ"] and engine.work() == 2
    stats = read("ingest_job").where("kind = 'resolve'").orderBy(F.desc("id")).first().stats
    assert (stats["inserted"], stats["updated"], stats["unchanged"], stats["not_seen"]) == ("1", "1", "10", "1")
    after = {r.name: r for r in read("place").collect()}
    assert len(after) == 13 and after["Quite another name"].place_id == place["Shop aaaaa"].place_id and str(after["Quite another name"].first_seen) == "2026-01-05" and str(after["Quite another name"].updated_at) == "2026-02-05"
    assert str(after["Shop bbbbb"].last_seen) == "2026-01-05" and str(after["Кофе Бум"].last_seen) == "2026-02-05" and str(after["Кофе Бум"].updated_at) == "2026-01-05"
    reasons = {r.cell: r.reason for r in read("dirty_cell").collect()}
    assert {reasons[after["Shop bbbbb"].cell], reasons[after["Shop zzzzz"].cell]} == {"not_seen", "new_or_changed"} and place["Кофе Бум"].cell not in reasons
    assert {r.source_version: r.status for r in read("dataset_version").where("source_id = 'overture_places'").collect()} == {"v1": "superseded", "v2": "active"}
    assert schemas.violations(engine.tables).collect() == []
    main(["status"], engine)
    main(["unmapped"], engine)
    said = capsys.readouterr().out
    assert "'LOADED'" in said and "'places': 13" in said and "'dirty_cells'" in said


def test_a_gate_that_holds(engine):
    engine.at["v"] = "bad"
    engine.enqueue("KZ", ["overture"])
    assert engine.work() == 0
    jobs = {r.kind: r for r in engine.tables.read("ingest_job").collect()}
    assert jobs["source"].status == "FAILED" and "quality gate" in jobs["source"].error and jobs["resolve"].status == "PENDING"
    assert engine.tables.read("dataset_version").first().status == "failed" and engine.tables.read("place").count() == 0
    assert engine.retry_failed() == 1 and engine.work() == 0 and engine.tables.read("ingest_job").where("kind = 'source'").first().attempts == 2


def test_groups(engine):
    with pytest.raises(ValueError):
        engine.enqueue_region("nowhere")
    assert set(engine.enqueue_region("pilot")) == {"KZ"} and engine.enqueue_world() == ["KZ", "UZ"]
    with pytest.raises(ValueError):
        engine.enqueue_update()
    with pytest.raises(ValueError):
        engine.sync_registry(divisions(engine.spark), ["kz", "XX"])
    assert engine.tables.read("ingest_job").where("iso2 = 'UZ'").count() == 3


def test_a_commit_is_whole_or_not_at_all(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "s"))
    one = spark.range(3).toDF("id")
    assert store.commit({"a": one, "b": one}) == 1 and store.names() == ["a", "b"]
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        store.commit({"a": one.limit(1), "b": broken})
    assert store.read("a").count() == 3 and store.number() == 1
    assert store.commit({"a": store.read("a").limit(2)}) == 2 and store.read("a").count() == 2 and store.read("b").count() == 3
    assert store.commit({"a": one}) == 3 and store.vacuum() >= 1 and store.read("a").count() == 3
    with pytest.raises(KeyError):
        store.read("c")


def test_settings():
    assert Settings.of({"PLACELOOM_MAX_ATTEMPTS": "5", "PLACELOOM_STORE": "s3a://x/y", "PLACELOOM_RELEASE": ""}) == Settings(max_attempts=5, store="s3a://x/y")


def test_rules_are_checked(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "s"))
    assert set(schemas.create_missing(store)) == set(schemas.TABLES) and schemas.create_missing(store) == []
    made = spark.createDataFrame([("a", "b", None), ("a", None, None), ("c", None, None)], schemas.TABLES["category"])
    store.commit({"category": made})
    assert {(r.table, r.rule): r.n for r in schemas.violations(store).collect()} == {("category", "unique(id)"): 1, ("category", "parent_id in category.id"): 1}
    schemas.drop_all(store)
    assert store.names() == []
