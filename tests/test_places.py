import pytest
from pyspark.sql import functions as F

from placeloom import api
from placeloom.functions import categories as cat
from placeloom.functions import geo
from placeloom.functions.hexgrid import HexGrid, offsets
from placeloom.operators import jobs, scoring, spatial, upsert, validation
from placeloom.sources import lake, places

GRID = HexGrid()
TARGET = "food.cafe.coffee_shop"


def test_bbox_and_adaptive_select(spark):
    rows = [("g1", ("Boom",), (76.9, 43.2, 76.9, 43.2), "coffee_shop", 0.9, ["+7 701"], "open"), ("g2", ("Paris",), (2.3, 48.8, 2.3, 48.8), "cafe", 0.8, [], "permanently_closed")]
    df = spark.createDataFrame(rows, "id string, names struct<primary:string>, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>, basic_category string, confidence double, phones array<string>, operating_status string")
    got = places.extract(df, geo.Box(76.0, 43.0, 77.0, 44.0))
    assert got.columns == ["id", "name", "lon", "lat", "basic_category", "confidence", "phone", "operating_status"]
    record = places.from_places(got, "KZ").first()
    assert (record.source_record_id, record.category_id, record.source_category, record.operating_status, record.source_confidence) == ("g1", TARGET, "coffee_shop", "open", 0.9) and record.cell is not None
    assert places.extract_city(df, api.CITIES["almaty"].box).count() == 1


def test_tags(spark):
    objects = [("n1", {"amenity": "cafe", "cuisine": "tea;coffee_shop", "name": "Кофе Бум", "phone": "8 700 111 22 33", "addr:street": "Abay", "disused:shop": ""}, 43.2, 76.9), ("n2", {"highway": "bus_stop"}, 43.2, 76.9), ("n3", {"amenity": "cafe"}, 43.2, 76.9), ("n4", {"shop": "odd", "name:en": "Odd", "abandoned": "yes"}, 43.2, 76.9), ("n5", {"natural": "tree", "name": "Oak"}, 43.2, 76.9)]
    df = spark.createDataFrame(objects, "osm_id string, tags map<string,string>, lat double, lon double")
    got = {r.source_record_id: r for r in places.from_tags(df, "KZ").collect()}
    assert set(got) == {"n1", "n2", "n4"}
    assert got["n1"].category_id == TARGET and got["n1"].phone_e164 == "+77001112233" and got["n1"].address == {"street": "Abay"} and got["n1"].operating_status == "unknown"
    assert got["n4"].name == "Odd" and got["n4"].operating_status == "closed" and got["n4"].category_id is None and got["n4"].source_category == "shop=odd"


def test_ways(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 2.0), (3, 2.0, 1.0), (4, None, None)], "node_id long, lat double, lon double")
    ways = spark.createDataFrame([(9, {"a": "b"}, [1, 2, 3, 1]), (8, {"a": "b"}, [4]), (7, {}, [1])], "way_id long, tags map<string,string>, refs array<long>")
    got = places.way_points(ways, nodes).collect()
    assert [(r.osm_id, round(r.lat, 6), r.lon) for r in got] == [("w9", 0.666667, 1.0)]


def test_aliases_versions_releases():
    assert places.source_id("Overture") == "overture_places" and lake.version_from_last_modified("Wed, 21 Oct 2015 07:28:00 GMT") == "2015-10-21"
    with pytest.raises(ValueError):
        places.source_id("nope")
    with pytest.raises(RuntimeError):
        lake.version_from_last_modified(None)
    assert places.latest_release(["2026-01-01.0", "2026-08-19.0"]) == "2026-08-19.0" and places.theme_path("s3://x/", "r", "places", "place").endswith("r/theme=places/type=place")


def test_lake_round_trip(spark, tmp_path):
    store = lake.Lake(spark, str(tmp_path))
    df = spark.createDataFrame([("a", {"k": "v"}, 1.5), ("b", None, None)], "source_record_id string, address map<string,string>, lat double")
    folder = store.path("processed", "osm", "v1", "KZ")
    assert store.done(folder, "process") is None and store.write(df, folder) == 2
    assert store.done(folder, "process") == {"rows": 2}
    assert sorted(map(tuple, store.read(folder, places.PLACE_SCHEMA).collect()), key=str) == sorted([("a", 1.5, {"k": "v"}), ("b", None, None)], key=str)


def test_validation(spark):
    rows = [("n1", "Lido", 43.2, 76.9, "food.cafe", 0.9), ("n2", "Lido", 43.2, 76.9, None, 0.9), ("n3", "Lido", 43.2, 76.9, "food.cafe", 0.1), ("n4", "", 43.2, 76.9, "food.cafe", 0.9)]
    df = spark.createDataFrame([(*r, "unknown") for r in rows], "source_record_id string, name string, lat double, lon double, category_id string, source_confidence double, operating_status string")
    box = geo.Box(46.49, 40.57, 87.36, 55.44)
    checked = validation.validate(df, box)
    assert {r.source_record_id: r.issues for r in checked.collect()} == {"n1": [], "n2": ["no_category"], "n3": ["low_confidence"], "n4": ["empty_name"]}
    report = validation.report(checked).first()
    assert (report.valid, report.dropped, report.warnings, report.score, report.passed) == (3, 1, 1, 0.625, False)
    assert validation.kept(checked).where("source_record_id = 'n3'").first().source_confidence == 0.08
    ten = validation.validate(df.limit(1).crossJoin(spark.range(10)), box)
    assert validation.report(ten, 20).first().delta_exceeded and validation.gate(ten, 11).passed
    with pytest.raises(validation.GateError):
        validation.gate(ten, 20)
    inside = F.col("lat") > 50
    assert validation.validate(df.limit(1), box, inside).first().issues == ["outside_polygon"]
    stop = df.limit(1).withColumn("name", F.lit("")).withColumn("category_id", F.lit("transport.bus_stop"))
    assert validation.validate(stop, box).first().issues == []


def _cell(q, r):
    return (q + (1 << 20)) * (1 << 21) + r + (1 << 20)


def _city(spark):
    rows = [(0, 0, "food.restaurant")] * 30 + [(0, 0, "education.university")] + [(0, 0, TARGET)] * 2 + [(6, 0, "food.restaurant")] * 30 + [(6, 0, TARGET)] * 9 + [(12, 0, "retail.convenience")] * 2
    return spark.createDataFrame([(_cell(q, r), c) for q, r, c in rows], "cell long, category_id string")


def test_score(spark):
    scored = scoring.score(_city(spark), TARGET)
    by = {r.cell: r for r in scored.collect()}
    a, b, c = (by[_cell(q, 0)] for q in (0, 6, 12))
    assert a.score > b.score and a.score > c.score and all(0 <= r.score <= 100 for r in by.values()) and a.comp20 == 40
    why = {r.cell: [(w.sign, w.reason) for w in r.why] for r in scoring.reasons(scored).collect()}
    assert ("-", "crowded") in why[b.cell] and [s for s, _ in why[a.cell]] == sorted((s for s, _ in why[a.cell]), key="+~-".index)
    top = scoring.best(scored, 3)
    far = lambda x, y: max(abs(dq), abs(dr), abs(dq + dr)) if (dq := (x >> 21) - (y >> 21)) is not None and (dr := (x & 0x1FFFFF) - (y & 0x1FFFFF)) is not None else 0
    assert len(top) == 3 and all(far(x.cell, y.cell) > 2 for i, x in enumerate(top) for y in top[:i])
    assert scoring.score(_city(spark).limit(0), TARGET).count() == 0
    assert [len(offsets(k)) for k in (0, 1, 2)] == [1, 7, 19]


def test_parent_category_counts_half(spark):
    df = spark.createDataFrame([(TARGET,), ("food.cafe",), ("food",), (None,), (TARGET + ".x",)], "c string")
    assert [r.h for r in df.select(cat.competitor_halves(TARGET, F.col("c")).alias("h")).collect()] == [2, 1, 0, 0, 2]


def test_polygons(spark):
    square = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0), (1.0, 1.0)]]
    df = spark.createDataFrame([(square, x, y) for x, y in ((0.5, 0.5), (2.0, 2.0), (4.0, 2.0), (5.0, 2.0), (1.0, 2.0))], "rings array<array<struct<x:double,y:double>>>, x double, y double")
    assert [r.c for r in df.select(geo.covers(F.col("rings"), F.col("x"), F.col("y")).alias("c")).collect()] == [True, False, True, False, True]
    one = df.select(geo.area(F.col("rings")).alias("a"), geo.inner_point(F.col("rings")).alias("p"), F.col("rings")).first()
    assert one.a == 12.0
    import struct

    wkb = struct.pack("<BII", 1, 3, 1) + struct.pack("<I10d", 5, 0, 0, 4, 0, 4, 4, 0, 4, 0, 0)
    got = spark.createDataFrame([(bytearray(wkb),), (None,)], "w binary").select(geo.rings_of_wkb(F.col("w")).alias("r")).collect()
    assert [(p.x, p.y) for p in got[0].r[0]][2] == (4.0, 4.0) and got[1].r is None
    assert [len(geo.Box(0, 0, 1, 1).tiles(0.4)), len(geo.Box(0, 0, 1, 1).tiles(2))] == [9, 1]


def test_upsert_twice_changes_nothing(spark):
    new = spark.createDataFrame([("a", "h1", 1), ("b", "h2", 2)], "place_id string, content_hash string, cell long")
    old = new.where("place_id = 'a'")
    once = upsert.upsert(old, new, ["place_id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, upsert.upsert(once, new, ["place_id"]).collect()))
    seen = once.withColumn("last_seen", F.lit("2024-01-01").cast("date"))
    assert upsert.changes(seen, new).first().asDict() == {"inserted": 0, "updated": 0, "unchanged": 2} and upsert.dirty_cells(seen, new).count() == 0
    assert upsert.upsert(old, new.withColumn("cell", F.lit(9).cast("long")), ["place_id"], update=False).where("place_id = 'a'").first().cell == 1


def test_stable_ids(spark):
    members = spark.createDataFrame([("e1", "osm", "n1"), ("e1", "overture_places", "g1"), ("e2", "osm", "n9")], "entity string, source_id string, source_record_id string")
    lineage = spark.createDataFrame([(s, r, "p-old", 1) for s, r in (("osm", "n1"), ("overture_places", "g1"), ("osm", "n9"))], "source_id string, source_record_id string, place_id string, dataset_version int")
    got = {r.entity: r for r in upsert.stable_ids(members, lineage).collect()}
    assert got["e1"].place_id == "p-old" and got["e2"].place_id != "p-old" and not got["e2"].reused


def test_jobs(spark):
    rows = [(1, "k1", "source", "LOADED", 0, []), (2, "k2", "source", "PENDING", 3, []), (3, "k3", "resolve", "PENDING", 0, [1]), (4, "k4", "resolve", "PENDING", 0, [2]), (5, "k5", "source", "FAILED", 1, [])]
    df = spark.createDataFrame([(*r, None, None, None, None, None, None) for r in rows], "id long, job_key string, kind string, status string, attempts int, depends_on array<long>, created_at timestamp, locked_at timestamp, locked_by string, step string, error string, started_at timestamp").withColumn("stats", F.lit(None).cast("map<string,string>"))
    now = F.lit("2024-01-01").cast("timestamp")
    after, taken = jobs.claim(df, now, "w")
    assert taken == 3 and after.where("id = 3").first().status == "DOWNLOADING" and after.where("id = 3").first().attempts == 1
    again = jobs.retry_failed(df)
    assert jobs.claimable(again, now).first().id == 5 and again.where("id = 5").first().attempts == 1
    done = jobs.checkpoint(jobs.checkpoint(df, 5, now, "download", stats={"a": 1}), 5, now, status="LOADED", stats={"b": 2})
    assert done.where("id = 5").first().stats == {"a": "1", "b": "2"}
    assert jobs.enqueue(df, df.where("id = 1").withColumn("id", F.lit(9).cast("long"))).count() == 5


def test_store(spark, tmp_path):
    rows = [(f"g{i}", (f"Place {i}",), (76.9 + i % 10 / 100, 43.2 + i % 7 / 100, 76.9, 43.2), ["coffee_shop", "cafe", "university", "odd"][i % 4], 0.9, "open") for i in range(80)]
    raw = spark.createDataFrame(rows, "id string, names struct<primary:string>, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>, basic_category string, confidence double, operating_status string")
    store, now = api.Store(spark, str(tmp_path / "store")), F.lit("2024-01-01").cast("timestamp")
    assert store.bootstrap("almaty", raw, "r1", now) == 1 and store.bootstrap("almaty", raw, "r1", now) is None and store.bootstrap("almaty", raw, "r2", now, force=True) == 2
    assert {r.id: r.status for r in store.table("versions").collect()} == {1: "superseded", 2: "active"} and store.table("places").count() == 80
    best = store.best("almaty", TARGET, 3).collect()
    assert len(best) == 3 and all(r.landmark for r in best) and store.scores("almaty", TARGET) is store.scores("almaty", TARGET)
    assert {r.id: r.n for r in store.meta("almaty").collect()}["food.cafe"] == 40
    one = store.cell(best[0].cell, "almaty", TARGET)
    assert one["places_nearby"].first().places >= one["nearby"].count() > 0 and all(w.text and "{" not in w.text for w in one["why"].first().why)
    assert store.table("lineage").count() == 160 and store.cities().first().slug == "almaty" and store.health(now).first().status == "ok"
    columns, rows = store.sample("almaty", raw, 3)
    assert ("id", "string") in columns and rows.count() == 3
    with store.tables.locked("bootstrap"), pytest.raises(api.Busy):
        store.bootstrap("almaty", raw, "r3", now, force=True)
    kept = store.scores("almaty", TARGET)
    store.clock = lambda at=store.clock() + api.KEPT_S + 1: at
    assert store.scores("almaty", TARGET) is not kept
    assert store.cell(best[0].cell, "almaty", TARGET)["nearby"].count() > 0 and '"FeatureCollection"' in store.places("almaty", "food.cafe").first()[0]
    for bad in (lambda: store.scores("paris", TARGET), lambda: store.scores("almaty", "no"), lambda: store.best("almaty", TARGET, 21)):
        with pytest.raises((api.NotFound, api.Unknown)):
            bad()


def test_stream(spark, tmp_path):
    from placeloom.sources.tables import Tables
    from placeloom.streaming.incremental import merge_stream

    schema = "place_id string, content_hash string, cell long, loaded_on int"
    spark.createDataFrame([("a", "h0", 1, 0), ("z", "h9", 9, 0)], schema).write.parquet(str(tmp_path / "table"))
    spark.createDataFrame([("a", "h1", 2, 1), ("a", "h2", 3, 2), ("b", "h3", 4, 1), ("z", "h9", 9, 1)], schema).write.parquet(str(tmp_path / "in"))
    store = Tables(spark, str(tmp_path / "store"))
    store.commit({"place": spark.read.parquet(str(tmp_path / "table"))})
    for again in range(2):  # a stream without its checkpoint begins anew, with the same batch numbers
        merge_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), store, str(tmp_path / f"ck{again}")).awaitTermination(120)
        assert {(r.place_id, r.content_hash) for r in store.read("place").collect()} == {("a", "h2"), ("b", "h3"), ("z", "h9")}
        assert {r.cell for r in store.read("dirty").collect() if r.cell is not None} == {3, 4} and store.number() == 2


def test_areas(spark):
    box = lambda a, b, c, d: [[(a, b), (c, b), (c, d), (a, d), (a, b)]]
    areas = spark.createDataFrame([("kz", "country", box(0.0, 0.0, 10.0, 10.0)), ("c", "city", box(1.0, 1.0, 3.0, 3.0)), ("d", "district", box(1.0, 1.0, 2.0, 2.0))], "area_id string, level string, rings array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(1, 1.5, 1.5), (2, 2.5, 2.5), (3, 9.0, 9.0), (4, 20.0, 1.0)], "point_id long, lon double, lat double")
    assert {r.point_id: r.area_id for r in spatial.assign(points, areas).collect()} == {1: "d", 2: "c", 3: "kz"}
    assert {r.area_id: r.parent_id for r in spatial.parents(areas).collect()} == {"c": "kz", "d": "c"}


def test_nearest_anywhere(spark):
    import math
    import random

    r = random.Random(3)
    points = [(i, r.uniform(76.8, 77.0), r.uniform(43.1, 43.3)) for i in range(30)] + [(100, 179.99, 10.0), (101, -20.0, -50.0), (102, 5.0, 89.5), (103, 76.901, 43.201)]
    sites = [(i, r.uniform(76.85, 76.95), r.uniform(43.15, 43.25)) for i in range(25)] + [(50, -179.99, 10.0), (51, 179.0, 10.0), (52, -170.0, -50.0), (53, -175.0, 89.4)]

    def metres(x1, y1, x2, y2):
        h = math.sin(math.radians(y2 - y1) / 2) ** 2 + math.cos(math.radians(y1)) * math.cos(math.radians(y2)) * math.sin(math.radians(x2 - x1) / 2) ** 2
        return round(2 * geo.EARTH_M * math.asin(min(1, math.sqrt(h))), 3)

    want = {(p, n): s for p, x, y in points for n, (_, s) in enumerate(sorted((metres(x, y, a, b), s) for s, a, b in sites)[:3], 1)}
    given = spark.createDataFrame(points, "point_id long, lon double, lat double"), spark.createDataFrame(sites, "site_id long, lon double, lat double")
    assert {(x.point_id, x.n): x.site_id for x in spatial.nearest_anywhere(*given, 3, 0.02).collect()} == want
    assert {(x.point_id, x.n): x.site_id for x in spatial.nearest(*given, 3, 0.02).collect()} != want


def test_nearest_of_crowded_spots(spark, monkeypatch):
    """Copies at a spot are not searched again, and ids that repeat count as in a join."""
    import random

    r = random.Random(5)
    spots = [(76.8 + r.randrange(40) / 100, 43.1 + r.randrange(40) / 100) for _ in range(30)]
    points = [(i, *spots[i % 30]) for i in range(3000)] + [(7, *spots[7]), (8, *spots[9]), (5000, None, 43.2)]
    sites = [(9000 - i, *spots[i % 10 * 3]) for i in range(2000)] + [(9000, *spots[0]), (7001, *spots[27]), (7001, *spots[27])]
    given = spark.createDataFrame(points, "point_id long, lon double, lat double"), spark.createDataFrame(sites, "site_id long, lon double, lat double")
    met, nearest = [], spatial.nearest

    def counted(p, s, *rest):
        met.append((p.count(), s.count()))
        return nearest(p, s, *rest)

    monkeypatch.setattr(spatial, "nearest", counted)
    got = sorted(map(tuple, spatial.nearest_anywhere(*given, 3).collect()))
    assert met and all(p <= 30 and s <= 10 * 3 for p, s in met)
    distance = F.round(geo.haversine_m(F.col("y"), F.col("x"), F.col("lat"), F.col("lon")), 3).alias("distance_m")
    pairs = given[0].where("lon IS NOT NULL").withColumnsRenamed({"lon": "x", "lat": "y"}).crossJoin(given[1]).select("point_id", "site_id", distance)
    assert got == sorted(map(tuple, spatial._best(pairs, 3).collect())) and len(got) == 9000
    few = sorted(map(tuple, spatial.nearest_anywhere(given[0].where("point_id < 9"), given[1].where("site_id = 7001"), 5, 100.0).collect()))
    assert few == sorted(map(tuple, spatial._best(pairs.where("point_id < 9 AND site_id = 7001"), 5).collect()))
    assert spatial.nearest_anywhere(given[0].limit(0), given[1], 3).count() == spatial.nearest_anywhere(given[0].limit(9), given[1].limit(0), 3).count() == 0
