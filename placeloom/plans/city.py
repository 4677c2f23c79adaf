"""Queries over city places: cells, the score, reports and the endpoints' tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import categories as cat
from ..functions import geo
from ..functions.fixed import TAXONOMY, lines
from ..operators import reports, scoring, spatial
from .fixtures import OFFSETS_SQL, PLACES_SQL, SCORE_SQL, TARGET, cell_sql, places

BOX = geo.Box(76.9, 43.22, 76.98, 43.28)


def _scored(spark, d):
    return scoring.score(places(spark, d), TARGET)


def opportunity_score(spark, d):
    return _scored(spark, d).select("cell", "score", "act10", "anc10", "comp20", *(F.round(c, 9).alias(c) for c in ("p_activity", "p_anchors", "balance", "p_gap")))


def hex_cell_counts(spark, d):
    return scoring.cell_counts(places(spark, d), TARGET)


def hex_ring_scatter(spark, d):
    return scoring.scatter(scoring.cell_counts(places(spark, d).where("operating_status <> 'closed'"), TARGET))


def hex_cells(spark, d):
    g = scoring.GRID
    lat, lon = g.centre(F.col("cell"))
    return places(spark, d).select("place_id", g.q(F.col("cell")).alias("q"), g.r(F.col("cell")).alias("r"), g.valid(F.col("cell")).alias("valid"), F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


def hex_parents(spark, d):
    g = scoring.GRID
    return places(spark, d).select("cell").distinct().select("cell", *(g.parent(F.col("cell"), n).alias(f"parent{n}") for n in (1, 2, 3)))


def score_medians(spark, d):
    return scoring.medians(_scored(spark, d))


def score_reasons(spark, d):
    one = F.explode("why").alias("w")
    return scoring.reasons(_scored(spark, d)).select("cell", one).select("cell", "w.sign", "w.reason", "w.number")


def score_quantiles(spark, d):
    return scoring.quantile_breaks(_scored(spark, d))


def best_spread(spark, d):
    return scoring.best_cells(_scored(spark, d), 5)


def landmark_per_cell(spark, d):
    p = places(spark, d)
    return scoring.landmarks(p.select("cell").distinct(), p)


def cell_competitors(spark, d):
    p = places(spark, d)
    return scoring.cell_detail(p.select("cell").distinct(), p, TARGET)


def category_counts(spark, d):
    return reports.per_category(places(spark, d))


def category_rollup(spark, d):
    return reports.rollup(places(spark, d))


def unmapped_top(spark, d):
    return reports.source_categories(places(spark, d), False, 5)


def mapped_top(spark, d):
    return reports.source_categories(places(spark, d), True, 5)


def unmapped_share(spark, d):
    return reports.unmapped_share(places(spark, d))


def totals(spark, d):
    return reports.totals(places(spark, d))


def bbox_filter(spark, d):
    return places(spark, d).where(BOX.contains(F.col("lon"), F.col("lat"))).select("place_id", "category_id")


def bbox_tiles(spark, d):
    """Places per tile of the box: the tiles are an equi-join key, not a range join."""
    inside = places(spark, d).where(BOX.contains(F.col("lon"), F.col("lat")))
    tile = lambda c, low, n: F.least(F.floor((F.col(c) - low) / 0.02), F.lit(n)).cast("int")
    return inside.groupBy(tile("lon", BOX.xmin, 3).alias("tx"), tile("lat", BOX.ymin, 2).alias("ty")).agg(F.count("*").alias("n"))


def city_places_geojson(spark, d):
    return reports.geojson(places(spark, d), "food.cafe").select(F.get_json_object("geojson", "$.type").alias("type"), F.size(F.from_json(F.get_json_object("geojson", "$.features"), "array<string>")).alias("features"), F.get_json_object("geojson", "$.features[0].properties.name").alias("first"))


def category_tree(spark, d):
    return cat.dimension(spark).select("id", "parent_id", "en", cat.depth(F.col("id")).alias("depth"))


def category_competition(spark, d):
    c = F.col("category_id")
    return places(spark, d).select("place_id", cat.competitor_halves(TARGET, c).alias("halves"), cat.is_anchor(c).alias("anchor"), cat.within(c, "food").alias("food"), F.round(cat.competition_balance((F.col("place_id") % 20).cast("double")), 6).alias("balance"))


def category_compat_join(spark, d):
    """Supplier and customer nations' categories that can describe one place: a join on the root, unknown ones aside."""
    p = places(spark, d).groupBy("category_id").agg(F.count("*").alias("n"))
    a, b = p.select(F.col("category_id").alias("a"), F.col("n").alias("na")), p.select(F.col("category_id").alias("b"), F.col("n").alias("nb"))
    return a.where("a IS NOT NULL").withColumn("root", cat.root(F.col("a"))).join(b.where("b IS NOT NULL").withColumn("root", cat.root(F.col("b"))), "root").select("a", "b", (F.col("na") * F.col("nb")).alias("pairs"))


def haversine_knn(spark, d):
    """The three universities nearest to every place."""
    p = places(spark, d)
    points = p.select(F.col("place_id").alias("point_id"), "lat", "lon")
    sites = p.where("category_id = 'education.university'").select(F.col("place_id").alias("site_id"), "lat", "lon")
    return spatial.nearest_anywhere(points, sites, 3)


def haversine_knn_exact(spark, d):
    p = places(spark, d)
    points = p.where("place_id % 100 = 0").select(F.col("place_id").alias("point_id"), "lat", "lon")
    sites = p.where("category_id = 'education.university'").select(F.col("place_id").alias("site_id"), "lat", "lon")
    return spatial.nearest_anywhere(points, sites, 3)


def _areas(spark):
    boxes = [("kz", "country", "Kazakhstan", geo.Box(46.49, 40.57, 87.36, 55.44)), ("r1", "region", "Almaty region", geo.Box(76.0, 42.5, 78.0, 44.5)), ("c1", "city", "Almaty", geo.Box(76.86, 43.2, 77.02, 43.32))]
    boxes += [(f"d{i}{j}", "district", f"District {i}{j}", geo.Box(76.86 + 0.04 * i, 43.2 + 0.04 * j, 76.9 + 0.04 * i, 43.24 + 0.04 * j)) for i in range(3) for j in range(3)]
    rows = [(a, b, c, [[(x, y) for x, y in ((v.xmin, v.ymin), (v.xmax, v.ymin), (v.xmax, v.ymax), (v.xmin, v.ymax), (v.xmin, v.ymin))]]) for a, b, c, v in boxes]
    return spark.createDataFrame(rows, "area_id string, level string, name string, rings array<array<struct<x:double,y:double>>>")


_AREAS_SQL = "areas(area_id, name, rank, xmin, ymin, xmax, ymax) AS (VALUES ('kz', 'Kazakhstan', 4, 46.49e0, 40.57e0, 87.36e0, 55.44e0), ('r1', 'Almaty region', 3, 76.0e0, 42.5e0, 78.0e0, 44.5e0), ('c1', 'Almaty', 2, 76.86e0, 43.2e0, 77.02e0, 43.32e0)), d AS (SELECT unnest(range(3)) AS i), e AS (SELECT unnest(range(3)) AS j), ar AS (SELECT * FROM areas UNION ALL SELECT 'd' || i || j, 'District ' || i || j, 1, 76.86e0 + 0.04e0 * i, 43.2e0 + 0.04e0 * j, 76.9e0 + 0.04e0 * i, 43.24e0 + 0.04e0 * j FROM d, e)"


def admin_area_assign(spark, d):
    p = places(spark, d).select(F.col("place_id").alias("point_id"), "lat", "lon")
    return spatial.assign(p, _areas(spark))


def admin_parent(spark, d):
    return spatial.parents(_areas(spark))


def area_sizes(spark, d):
    r = F.col("rings")
    box, p = geo.envelope(r), geo.inner_point(r)
    return _areas(spark).select("area_id", F.round(geo.area(r), 6).alias("size"), box["xmin"].alias("xmin"), F.round(p["x"], 6).alias("x"), F.round(p["y"], 6).alias("y"))


def places_in_area(spark, d):
    p = places(spark, d)
    inside = spatial.assign(p.select(F.col("place_id").alias("point_id"), "lat", "lon"), _areas(spark)).withColumnRenamed("point_id", "place_id")
    return reports.places_in(p.join(inside, "place_id"), _areas(spark), "district 1")


def flat_distance(spark, d):
    return places(spark, d).select("place_id", geo.flat_m(F.col("lat"), F.col("lon"), F.lit(43.2389), F.lit(76.9286)).alias("metres"))


_ASSIGN_SQL = "hit AS (SELECT place_id AS point_id, area_id, row_number() OVER (PARTITION BY place_id ORDER BY rank, (xmax - xmin) * (ymax - ymin), area_id) AS n FROM places JOIN ar ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax)"
_ROLL = ", ".join(f"('{x[0]}')" for x in lines(TAXONOMY))
_TREE = ", ".join(f"('{i}', {f"'{i.rpartition('.')[0]}'" if '.' in i else 'NULL'}, '{en}', {i.count('.') + 1})" for i, _, _, en in lines(TAXONOMY))
_S = f"WITH {SCORE_SQL}"
_P = f"WITH {PLACES_SQL}"
_COUNTS = "count(*) AS total, count(*) FILTER (category_id IN ('education.university', 'transport.metro')) AS anchors, CAST(sum(CASE WHEN category_id = 'food.cafe.coffee_shop' THEN 2 WHEN category_id = 'food.cafe' THEN 1 ELSE 0 END) AS BIGINT) AS comp2"

ORACLES = {
    "opportunity_score": f"{_S} SELECT cell, score, act10, anc10, comp20, round(p_activity, 9) AS p_activity, round(p_anchors, 9) AS p_anchors, round(balance, 9) AS balance, round(p_gap, 9) AS p_gap FROM scored",
    "hex_cell_counts": f"{_P} SELECT cell, {_COUNTS} FROM places GROUP BY cell",
    "hex_ring_scatter": f"{_S} SELECT cell, act10, anc10, comp20 FROM summed",
    "hex_cells": f"{_P} SELECT place_id, cq AS q, cr AS r, true AS valid, round(cr * 300.0e0 / 111320.0e0 + 43.2389e0, 6) AS lat, round((cq + cr / 2.0e0) * (sqrt(3.0e0) * 200.0e0) / (111320.0e0 * 0.72857e0) + 76.9286e0, 6) AS lon FROM places",
    "score_medians": f"{_S} SELECT median(act10 / 10.0e0) AS activity, median(anc10 / 10.0e0) AS anchors, median(comp20 / 20.0e0) AS competitors FROM scored",
    "score_reasons": f"""{_S}, v AS (SELECT cell, round_even(act10 / 10.0e0, 1) AS act, round_even(anc10 / 10.0e0, 1) AS anc, round_even(comp20 / 20.0e0, 1) AS comp, round_even(p_activity, 3) AS pa, round_even(p_anchors, 3) AS pn, round_even(p_gap, 3) AS pg FROM scored)
SELECT cell, '+' AS sign, 'busy' AS reason, act AS number FROM v WHERE pa >= 0.75 UNION ALL SELECT cell, '+', 'anchors', anc FROM v WHERE pn >= 0.75 AND anc > 0 UNION ALL SELECT cell, '+', 'some_competitors', comp FROM v WHERE comp >= 0.5 AND comp <= 3
UNION ALL SELECT cell, '+', 'fewer_competitors_than_usual', comp FROM v WHERE pg >= 0.7 AND comp >= 0.5 UNION ALL SELECT cell, '~', 'no_competitors', comp FROM v WHERE comp < 0.5 UNION ALL SELECT cell, '-', 'quiet', act FROM v WHERE pa <= 0.3 UNION ALL SELECT cell, '-', 'crowded', comp FROM v WHERE comp > 3""",
    "score_quantiles": f"{_S}, l AS (SELECT list(score ORDER BY score) AS s FROM scored) SELECT s[1] AS q0, " + ", ".join(f"s[1 + CAST(floor({p / 100} * (len(s) - 1)) AS BIGINT)] AS q{p}" for p in (50, 75, 90, 97)) + " FROM l",
    "landmark_per_cell": f"{_P}, {OFFSETS_SQL.strip()}, c AS (SELECT DISTINCT cell FROM places), n AS (SELECT c.cell, name, row_number() OVER (PARTITION BY c.cell ORDER BY coalesce(category_id IN ('education.university', 'transport.metro'), false) DESC, confidence DESC, place_id) AS k FROM c, steps JOIN places p ON p.cell = c.cell + step WHERE ring <= 1) SELECT cell, name AS landmark FROM n WHERE k = 1",
    "cell_competitors": f"""{_P}, {OFFSETS_SQL.strip()}, c AS (SELECT DISTINCT cell, cq, cr FROM places), m AS (SELECT cell, cr * 300.0e0 / 111320.0e0 + 43.2389e0 AS lat0, (cq + cr / 2.0e0) * (sqrt(3.0e0) * 200.0e0) / (111320.0e0 * 0.72857e0) + 76.9286e0 AS lon0 FROM c),
b AS (SELECT m.cell, ring, place_id, category_id, CAST(round_even(sqrt(pow((lon - lon0) * 111320.0e0 * cos(radians(lat0)), 2) + pow((lat - lat0) * 111320.0e0, 2)), 0) AS BIGINT) AS distance_m FROM m, steps JOIN places p ON p.cell = m.cell + step WHERE operating_status <> 'closed'),
k AS (SELECT cell, 'competitor' AS kind, place_id, distance_m FROM b WHERE ring <= 1 AND category_id IN ('food.cafe', 'food.cafe.coffee_shop') UNION ALL SELECT cell, 'anchor', place_id, distance_m FROM b WHERE category_id IN ('education.university', 'transport.metro')),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY cell, kind ORDER BY distance_m, place_id) AS INTEGER) AS n FROM k) SELECT cell, kind, place_id, distance_m, n FROM r WHERE n <= CASE kind WHEN 'anchor' THEN 10 ELSE 15 END""",
    "category_counts": f"{_P} SELECT category_id, count(*) AS n FROM places GROUP BY category_id",
    "category_rollup": f"{_P}, t(id) AS (VALUES {_ROLL}) SELECT t.id AS category_id, count(p.place_id) AS n FROM t LEFT JOIN places p ON p.category_id = t.id OR starts_with(p.category_id, t.id || '.') WHERE t.id LIKE '%.%' GROUP BY t.id UNION ALL SELECT NULL, count(*) FROM places WHERE category_id IS NULL",
    "unmapped_top": f"{_P} SELECT source_category, category_id, count(*) AS n FROM places WHERE category_id IS NULL GROUP BY ALL ORDER BY n DESC, source_category LIMIT 5",
    "mapped_top": f"{_P} SELECT source_category, category_id, count(*) AS n FROM places WHERE category_id IS NOT NULL GROUP BY ALL ORDER BY n DESC, source_category LIMIT 5",
    "unmapped_share": f"{_P} SELECT count(*) AS total, count(*) FILTER (category_id IS NULL) AS unmapped, round_even(100.0e0 * count(*) FILTER (category_id IS NULL) / count(*), 1) AS percent FROM places",
    "totals": f"{_P} SELECT count(*) AS places, count(DISTINCT cell) AS cells FROM places",
    "bbox_filter": f"{_P} SELECT place_id, category_id FROM places WHERE lon BETWEEN 76.9e0 AND 76.98e0 AND lat BETWEEN 43.22e0 AND 43.28e0",
    "bbox_tiles": f"{_P} SELECT CAST(least(floor((lon - 76.9e0) / 0.02e0), 3) AS INTEGER) AS tx, CAST(least(floor((lat - 43.22e0) / 0.02e0), 2) AS INTEGER) AS ty, count(*) AS n FROM places WHERE lon BETWEEN 76.9e0 AND 76.98e0 AND lat BETWEEN 43.22e0 AND 43.28e0 GROUP BY ALL",
    "city_places_geojson": f"{_P} SELECT 'FeatureCollection' AS type, CAST(least(count(*), 3000) AS INTEGER) AS features, min_by(name, place_id) AS first FROM places WHERE category_id = 'food.cafe' OR starts_with(category_id, 'food.cafe.')",
    "category_tree": f"SELECT * FROM (VALUES {_TREE}) t(id, parent_id, en, depth)",
    "category_competition": f"{_P} SELECT place_id, CASE WHEN category_id = 'food.cafe.coffee_shop' THEN 2 WHEN category_id = 'food.cafe' THEN 1 ELSE 0 END AS halves, coalesce(category_id IN ('education.university', 'transport.metro'), false) AS anchor, coalesce(starts_with(category_id, 'food.'), false) AS food, round(CASE WHEN place_id % 20 < 0.5 THEN 0.55e0 WHEN place_id % 20 <= 3 THEN 1.0e0 WHEN place_id % 20 <= 6 THEN 0.65e0 ELSE greatest(0.15e0, 0.65e0 - 0.07e0 * (place_id % 20 - 6)) END, 6) AS balance FROM places",
    "category_compat_join": f"{_P}, c AS (SELECT category_id AS c, count(*) AS n FROM places WHERE category_id IS NOT NULL GROUP BY 1) SELECT a.c AS a, b.c AS b, a.n * b.n AS pairs FROM c a JOIN c b ON split_part(a.c, '.', 1) = split_part(b.c, '.', 1)",
    "haversine_knn": f"""{_P}, m AS (SELECT p.place_id AS point_id, s.place_id AS site_id, round(2 * 6371008.8e0 * asin(least(1.0e0, sqrt(pow(sin(radians(s.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - p.lon) / 2), 2)))), 3) AS distance_m
FROM places p JOIN places s ON s.category_id = 'education.university'), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY point_id ORDER BY distance_m, site_id) AS INTEGER) AS n FROM m) SELECT * FROM r WHERE n <= 3""",
    "haversine_knn_exact": f"""{_P}, m AS (SELECT p.place_id AS point_id, s.place_id AS site_id, round(2 * 6371008.8e0 * asin(least(1.0e0, sqrt(pow(sin(radians(s.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - p.lon) / 2), 2)))), 3) AS distance_m
FROM places p JOIN places s ON s.category_id = 'education.university' WHERE p.place_id % 100 = 0), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY point_id ORDER BY distance_m, site_id) AS INTEGER) AS n FROM m) SELECT * FROM r WHERE n <= 3""",
    "admin_area_assign": f"{_P}, {_AREAS_SQL}, {_ASSIGN_SQL} SELECT point_id, area_id FROM hit WHERE n = 1",
    "admin_parent": f"WITH {_AREAS_SQL}, h AS (SELECT c.area_id, p.area_id AS parent_id, row_number() OVER (PARTITION BY c.area_id ORDER BY (p.xmax - p.xmin) * (p.ymax - p.ymin), p.rank, p.area_id) AS n FROM ar c JOIN ar p ON p.rank > c.rank AND (c.xmin + c.xmax) / 2 BETWEEN p.xmin AND p.xmax AND (c.ymin + c.ymax) / 2 BETWEEN p.ymin AND p.ymax) SELECT area_id, parent_id FROM h WHERE n = 1",
    "area_sizes": f"WITH {_AREAS_SQL} SELECT area_id, round((xmax - xmin) * (ymax - ymin), 6) AS size, xmin, round((xmin + xmax) / 2, 6) AS x, round((ymin + ymax) / 2, 6) AS y FROM ar",
    "places_in_area": f"{_P}, {_AREAS_SQL}, {_ASSIGN_SQL} SELECT category_id, count(*) AS n FROM hit JOIN ar USING (area_id) JOIN places p ON p.place_id = hit.point_id WHERE n = 1 AND name_1 ILIKE 'district 1%' GROUP BY category_id".replace("FROM hit JOIN ar USING (area_id) JOIN places p", "FROM hit JOIN (SELECT area_id, name AS name_1 FROM ar) ar USING (area_id) JOIN places p"),
    "flat_distance": f"{_P} SELECT place_id, CAST(round_even(sqrt(pow((lon - 76.9286e0) * 111320.0e0 * cos(radians(43.2389e0)), 2) + pow((lat - 43.2389e0) * 111320.0e0, 2)), 0) AS BIGINT) AS metres FROM places",
}

_CELLS = f"{_P}, m AS (SELECT DISTINCT cell AS own, cr * 300.0e0 / 111320.0e0 + 43.2389e0 AS lat, (cq + cr / 2.0e0) * (sqrt(3.0e0) * 200.0e0) / (111320.0e0 * 0.72857e0) + 76.9286e0 AS lon FROM places)"
_UP = ", ".join(cell_sql("m", f"up{n}", 200.0 * 7.0 ** (n / 2)) for n in (1, 2, 3))
ORACLES["hex_parents"] = f"{_CELLS}, {_UP} SELECT m.own AS cell, up1.cell AS parent1, up2.cell AS parent2, up3.cell AS parent3 FROM m JOIN up1 USING (own) JOIN up2 USING (own) JOIN up3 USING (own)"
_FAR = "greatest(abs(x // 2097152 - cell // 2097152), abs(x % 2097152 - cell % 2097152), abs(x // 2097152 - cell // 2097152 + x % 2097152 - cell % 2097152)) > 2"
ORACLES["best_spread"] = f"""WITH RECURSIVE {SCORE_SQL}, o AS (SELECT cell, score, act10, row_number() OVER (ORDER BY score DESC, act10 DESC, cell) AS i FROM scored), t AS (SELECT * FROM o WHERE i <= 95),
g(i, chosen) AS (SELECT 0, []::BIGINT[] UNION ALL SELECT g.i + 1, CASE WHEN len(chosen) < 5 AND len(list_filter(chosen, lambda x: NOT ({_FAR}))) = 0 THEN list_append(chosen, cell) ELSE chosen END FROM g JOIN t ON t.i = g.i + 1),
c AS (SELECT arg_max(chosen, i) AS l FROM g), u AS (SELECT unnest(l) AS cell, generate_subscripts(l, 1) AS place FROM c) SELECT CAST(place AS INTEGER) AS place, cell, score, act10 FROM u JOIN scored USING (cell)"""

QUERIES = {n: globals()[n] for n in ORACLES}
