"""Deterministic place data from the driver's tables, which have no geography: columns here, the same in SQL text for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hexgrid import HexGrid
from ..operators.scoring import GRID

TARGET = "food.cafe.coffee_shop"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str, grid: HexGrid = GRID) -> DataFrame:
    """City places from ``orders``: (place_id, name, lat, lon, category_id, source_category, operating_status, confidence, cell)."""
    k = F.col("o_orderkey")
    kind = k % 12
    dense = lambda n: F.when(k % 7 == 0, F.lit(n // 5)).otherwise(F.lit(n))  # noqa: E731 a seventh of all places are in a corner of the city
    out = table(spark, sf_dir, "orders").select(
        k.alias("place_id"), F.concat(F.lit("place "), k).alias("name"), ((k * 7919) % dense(1250)).cast("double") / 10000.0 + 43.2, ((k * 104729) % dense(1800)).cast("double") / 10000.0 + 76.85,
        F.when(kind <= 1, F.lit("food.cafe.coffee_shop")).when(kind == 2, F.lit("food.cafe")).when(kind == 3, F.lit("education.university")).when(kind == 4, F.lit("transport.metro")).when(kind != 5, F.lit("retail.convenience")),
        F.when(kind == 5, F.concat(F.lit("raw_"), k % 7)).otherwise(F.concat(F.lit("c"), kind)), F.when(k % 19 == 0, F.lit("closed")).otherwise(F.lit("open")), (k % 100).cast("double") / 100.0,
    ).toDF("place_id", "name", "lat", "lon", "category_id", "source_category", "operating_status", "confidence")
    return out.withColumn("cell", grid.cell(F.col("lat"), F.col("lon")))


PLACES_SQL = """
raw AS (SELECT o_orderkey AS place_id, 'place ' || o_orderkey AS name, CAST((o_orderkey*7919) % (CASE WHEN o_orderkey % 7 = 0 THEN 250 ELSE 1250 END) AS DOUBLE)/10000.0e0 + 43.2e0 AS lat, CAST((o_orderkey*104729) % (CASE WHEN o_orderkey % 7 = 0 THEN 360 ELSE 1800 END) AS DOUBLE)/10000.0e0 + 76.85e0 AS lon,
  CASE WHEN o_orderkey % 12 <= 1 THEN 'food.cafe.coffee_shop' WHEN o_orderkey % 12 = 2 THEN 'food.cafe' WHEN o_orderkey % 12 = 3 THEN 'education.university' WHEN o_orderkey % 12 = 4 THEN 'transport.metro' WHEN o_orderkey % 12 = 5 THEN NULL ELSE 'retail.convenience' END AS category_id,
  CASE WHEN o_orderkey % 12 = 5 THEN 'raw_' || (o_orderkey % 7) ELSE 'c' || (o_orderkey % 12) END AS source_category, CASE WHEN o_orderkey % 19 = 0 THEN 'closed' ELSE 'open' END AS operating_status, CAST(o_orderkey % 100 AS DOUBLE)/100.0e0 AS confidence
  FROM orders),
xy AS (SELECT *, (lon - 76.9286e0) * 111320.0e0 * 0.72857e0 AS x, (lat - 43.2389e0) * 111320.0e0 AS y FROM raw),
qr AS (SELECT *, (x * 0.5773502691896258e0 - y / 3.0e0) / 200.0e0 AS q, (y * 2.0e0 / 3.0e0) / 200.0e0 AS r FROM xy),
rd AS (SELECT *, floor(q + 0.5e0) AS rq, floor(r + 0.5e0) AS rr, floor(-q - r + 0.5e0) AS rs FROM qr),
hx AS (SELECT *, CASE WHEN abs(rq - q) > abs(rr - r) AND abs(rq - q) > abs(rs + q + r) THEN -rr - rs ELSE rq END AS cq, CASE WHEN abs(rq - q) > abs(rr - r) AND abs(rq - q) > abs(rs + q + r) THEN rr WHEN abs(rr - r) > abs(rs + q + r) THEN -rq - rs ELSE rr END AS cr FROM rd),
places AS (SELECT place_id, name, lat, lon, category_id, source_category, operating_status, confidence, CAST((cq + 1048576) * 2097152 + cr + 1048576 AS BIGINT) AS cell, CAST(cq AS BIGINT) AS cq, CAST(cr AS BIGINT) AS cr FROM hx)"""

OFFSETS_SQL = """
steps AS (SELECT dq, dr, greatest(abs(dq), abs(dr), abs(dq + dr)) AS ring, dq * 2097152 + dr AS step FROM (SELECT unnest(range(-2, 3)) AS dq), (SELECT unnest(range(-2, 3)) AS dr) WHERE greatest(abs(dq), abs(dr), abs(dq + dr)) <= 2)"""

SCORE_SQL = f"""{PLACES_SQL},{OFFSETS_SQL},
counts AS (SELECT cell, count(*) AS total, count(*) FILTER (category_id IN ('education.university', 'transport.metro')) AS anchors, sum(CASE WHEN category_id = 'food.cafe.coffee_shop' THEN 2 WHEN category_id = 'food.cafe' THEN 1 ELSE 0 END) AS comp2 FROM places WHERE operating_status <> 'closed' GROUP BY cell),
spread AS (SELECT cell + step AS cell, ring, total, anchors, comp2, CASE ring WHEN 0 THEN 10 WHEN 1 THEN 6 ELSE 3 END AS w FROM counts, steps),
summed AS (SELECT cell, CAST(sum(total * w) AS BIGINT) AS act10, CAST(sum(anchors * w) AS BIGINT) AS anc10, CAST(sum(CASE WHEN ring <= 1 THEN comp2 * w ELSE 0 END) AS BIGINT) AS comp20 FROM spread GROUP BY cell HAVING min(ring) <= 1),
sat AS (SELECT *, comp20 / (2.0e0 * (act10 + 10)) AS sat FROM summed),
p AS (SELECT *, (rank() OVER (ORDER BY act10) - 1 + count(*) OVER (ORDER BY act10)) / 2.0e0 / count(*) OVER () AS p_activity, (rank() OVER (ORDER BY anc10) - 1 + count(*) OVER (ORDER BY anc10)) / 2.0e0 / count(*) OVER () AS p_anchors,
  1.0e0 - (rank() OVER (ORDER BY sat) - 1 + count(*) OVER (ORDER BY sat)) / 2.0e0 / count(*) OVER () AS p_gap, CASE WHEN comp20 / 20.0e0 < 0.5e0 THEN 0.55e0 WHEN comp20 / 20.0e0 <= 3 THEN 1.0e0 WHEN comp20 / 20.0e0 <= 6 THEN 0.65e0 ELSE greatest(0.15e0, 0.65e0 - 0.07e0 * (comp20 / 20.0e0 - 6)) END AS balance FROM sat),
b AS (SELECT *, 0.35e0 * p_activity + 0.2e0 * p_anchors + 0.2e0 * balance + 0.25e0 * p_gap AS blend FROM p),
scored AS (SELECT *, CAST(round_even(100 * ((rank() OVER (ORDER BY blend) - 1 + count(*) OVER (ORDER BY blend)) / 2.0e0 / count(*) OVER ()), 0) AS INTEGER) AS score FROM b)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources' records of the same places, with duplicates inside one, from ``part``."""
    k = F.col("p_partkey")
    base = table(spark, sf_dir, "part").select(k.alias("k"), F.lower("p_name").alias("p"), F.col("p_name"))
    base = base.withColumn("lat", ((F.col("k") * 7919) % 2500).cast("double") / 10000.0 + 43.15).withColumn("lon", ((F.col("k") * 104729) % 3600).cast("double") / 10000.0 + 76.74)
    k = F.col("k")
    cat3 = F.when(k % 3 == 0, F.lit("food.cafe")).when(k % 3 == 1, F.lit("health.pharmacy")).otherwise(F.lit("retail.convenience"))
    phone = F.when(k % 5 == 0, F.concat(F.lit("+7701"), F.lpad(k.cast("string"), 7, "0")))
    domain = F.when(k % 7 == 0, F.concat(F.lit("shop"), k, F.lit(".kz")))
    none = F.lit(None).cast("string")

    def side(source, prefix, rows, lat, name, category, phone, domain):
        return rows.select(F.lit(source).alias("source_id"), F.concat(F.lit(prefix), "k").alias("source_record_id"), name.alias("core_name"), lat.alias("lat"), "lon", category.alias("category_id"), phone.alias("phone_e164"), domain.alias("domain"), (k % 100).cast("double").alias("c")).withColumn("source_confidence", F.col("c") / 100.0).drop("c")

    name_b = F.when(k % 4 == 0, F.concat("p", F.lit(" shop"))).when(k % 4 == 1, F.col("p")).when(k % 4 == 2, F.concat(F.lit("zzz "), "k")).otherwise(F.col("p"))
    a = side("osm", "n", base.where(k % 4 != 3), F.col("lat"), F.col("p"), cat3, phone, domain)
    b = side("overture_places", "g", base.where(k % 3 != 2), F.col("lat") + (k % 11).cast("double") * 10.0 / 111320.0, name_b, F.when(k % 13 == 0, F.lit("transport.rail")).otherwise(cat3), phone, domain)
    c = side("overture_places", "d", base.where(k % 17 == 3), F.col("lat") + 5.0 / 111320.0, F.col("p"), cat3, none, none)
    # two names that share three of four words, 40 m apart: for a person to judge
    away = F.col("lat") - 0.1
    grey = base.where(k % 19 == 7)
    e = side("osm", "f", grey, away, F.concat("p", F.lit(" alpha beta")), cat3, none, none)
    f = side("overture_places", "h", grey, away + 40.0 / 111320.0, F.concat("p", F.lit(" alpha gamma")), cat3, none, none)
    return a.unionByName(b).unionByName(c).unionByName(e).unionByName(f).withColumn("name", F.col("core_name")).withColumn("operating_status", F.when(F.substring("source_record_id", -1, 1) == "7", F.lit("closed")).otherwise(F.lit("unknown")))


RECORDS_SQL = """
base AS (SELECT p_partkey AS k, lower(p_name) AS p, CAST((p_partkey*7919) % 2500 AS DOUBLE)/10000.0e0 + 43.15e0 AS lat, CAST((p_partkey*104729) % 3600 AS DOUBLE)/10000.0e0 + 76.74e0 AS lon,
  CASE p_partkey % 3 WHEN 0 THEN 'food.cafe' WHEN 1 THEN 'health.pharmacy' ELSE 'retail.convenience' END AS c3, CASE WHEN p_partkey % 5 = 0 THEN '+7701' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') END AS phone, CASE WHEN p_partkey % 7 = 0 THEN 'shop' || p_partkey || '.kz' END AS dom FROM part),
recs AS (SELECT 'osm' AS source_id, 'n' || k AS source_record_id, p AS core_name, lat, lon, c3 AS category_id, phone AS phone_e164, dom AS domain, CAST(k % 100 AS DOUBLE) / 100.0e0 AS source_confidence FROM base WHERE k % 4 <> 3
  UNION ALL SELECT 'overture_places', 'g' || k, CASE k % 4 WHEN 0 THEN p || ' shop' WHEN 2 THEN 'zzz ' || k ELSE p END, lat + CAST(k % 11 AS DOUBLE) * 10.0e0 / 111320.0e0, lon, CASE WHEN k % 13 = 0 THEN 'transport.rail' ELSE c3 END, phone, dom, CAST(k % 100 AS DOUBLE) / 100.0e0 FROM base WHERE k % 3 <> 2
  UNION ALL SELECT 'overture_places', 'd' || k, p, lat + 5.0e0 / 111320.0e0, lon, c3, NULL, NULL, CAST(k % 100 AS DOUBLE) / 100.0e0 FROM base WHERE k % 17 = 3
  UNION ALL SELECT 'osm', 'f' || k, p || ' alpha beta', lat - 0.1e0, lon, c3, NULL, NULL, CAST(k % 100 AS DOUBLE) / 100.0e0 FROM base WHERE k % 19 = 7
  UNION ALL SELECT 'overture_places', 'h' || k, p || ' alpha gamma', lat - 0.1e0 + 40.0e0 / 111320.0e0, lon, c3, NULL, NULL, CAST(k % 100 AS DOUBLE) / 100.0e0 FROM base WHERE k % 19 = 7),
records AS (SELECT *, core_name AS name, CASE WHEN right(source_record_id, 1) = '7' THEN 'closed' ELSE 'unknown' END AS operating_status FROM recs)"""

LATITUDE = 43.275

DECIDED_SQL = f"""{RECORDS_SQL},
g AS (SELECT *, CAST(floor(lat / (150.0e0 / 111320.0e0)) AS BIGINT) AS gi, CAST(floor(lon / (150.0e0 / (111320.0e0 * cos(radians({LATITUDE}e0))))) AS BIGINT) AS gj FROM records),
pr AS (SELECT a.source_id AS asrc, a.source_record_id AS arec, b.source_id AS bsrc, b.source_record_id AS brec, a.core_name AS an, b.core_name AS bn, a.category_id AS ac, b.category_id AS bc, a.phone_e164 AS ap, b.phone_e164 AS bp, a.domain AS ad, b.domain AS bd,
  2 * 6371008.8e0 * asin(least(1.0e0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS d
  FROM g a JOIN g b ON abs(a.gi - b.gi) <= 1 AND abs(a.gj - b.gj) <= 1 AND (a.source_id, a.source_record_id) < (b.source_id, b.source_record_id)),
sm AS (SELECT *, len(list_intersect(list_distinct(string_split(an, ' ')), list_distinct(string_split(bn, ' ')))) / least(len(list_distinct(string_split(an, ' '))), len(list_distinct(string_split(bn, ' '))))::DOUBLE AS sim FROM pr WHERE split_part(ac, '.', 1) = split_part(bc, '.', 1)),
decided AS (SELECT asrc, arec, bsrc, brec, d, sim, CASE WHEN asrc = bsrc THEN CASE WHEN d <= 15 AND sim >= 0.97 THEN 'rule:same_source_duplicate' END WHEN ap = bp AND d <= 150 THEN 'rule:phone' WHEN ad = bd AND d <= 100 AND sim >= 0.6 THEN 'rule:domain' WHEN sim >= 0.92 AND d <= 75 THEN 'rule:name_close' WHEN sim >= 0.85 AND d <= 40 THEN 'rule:name_near' WHEN sim >= 0.75 AND d <= 60 THEN 'review:grey_zone' END AS method FROM sm)"""


#: Similarity of names by the recurrence itself: letter by letter of the first name, the first free equal letter of the second in reach. ``names`` has (a, b).
JARO_SQL = """
jw(a, b, i, hits) AS (SELECT a, b, 0, []::BIGINT[] FROM names UNION ALL
  SELECT a, b, i + 1, list_append(hits, coalesce(list_filter(range(greatest(1, i + 1 - reach), least(len(b), i + 1 + reach) + 1), lambda j: b[j] = a[i + 1] AND NOT list_contains(hits, j))[1], 0))
  FROM (SELECT *, greatest(0, greatest(len(a), len(b)) // 2 - 1) AS reach FROM jw) WHERE i < len(a)),
jm AS (SELECT a, b, list_filter(range(1, len(a) + 1), lambda x: hits[x] > 0) AS mine, list_sort(list_filter(hits, lambda x: x > 0)) AS theirs FROM jw WHERE i = len(a)),
js AS (SELECT a, b, len(mine) AS m, len(list_filter(range(1, len(mine) + 1), lambda x: a[mine[x]] <> b[theirs[x]])) AS swapped,
  CASE WHEN a[1] <> b[1] THEN 0 WHEN a[2] <> b[2] OR least(len(a), len(b)) < 2 THEN 1 WHEN a[3] <> b[3] OR least(len(a), len(b)) < 3 THEN 2 WHEN a[4] <> b[4] OR least(len(a), len(b)) < 4 THEN 3 ELSE 4 END AS pre FROM jm),
jaro AS (SELECT a, b, CASE WHEN a = '' OR b = '' THEN 0.0e0 WHEN a = b THEN 1.0e0 WHEN m = 0 THEN 0.0e0 ELSE (m / len(a)::DOUBLE + m / len(b)::DOUBLE + (m - swapped / 2.0e0) / m) / 3 END AS j, pre FROM js),
winkler AS (SELECT a, b, CASE WHEN j = 0 OR j = 1 THEN j ELSE j + pre * 0.1e0 * (1 - j) END AS sim FROM jaro)"""

_RULE = "CASE WHEN asrc = bsrc THEN CASE WHEN d <= 15 AND sim >= 0.97 THEN 'rule:same_source_duplicate' END WHEN ap = bp AND d <= 150 THEN 'rule:phone' WHEN ad = bd AND d <= 100 AND sim >= 0.6 THEN 'rule:domain' WHEN sim >= 0.92 AND d <= 75 THEN 'rule:name_close' WHEN sim >= 0.85 AND d <= 40 THEN 'rule:name_near' WHEN sim >= 0.75 AND d <= 60 THEN 'review:grey_zone' END"
_WORDS = "list_distinct(list_filter(string_split({}, ' '), lambda w: w <> ''))"


def resolved_sql(records: str = "records") -> str:
    """CTEs from the table of that name to ``members`` (its columns, entity, score, method): pairs of the grid, names' similarity, rules,
    components, and the greedy pass in the order of its pairs, one step a row."""
    pairs = DECIDED_SQL[len(RECORDS_SQL) :].split("sm AS")[0].strip().strip(",").replace("FROM records", f"FROM {records}")
    x, y = _WORDS.format("an"), _WORDS.format("bn")
    return f"""{pairs},
near AS (SELECT * FROM pr WHERE (ac IS NULL OR bc IS NULL OR split_part(ac, '.', 1) = split_part(bc, '.', 1)) AND d <= CASE WHEN asrc = bsrc THEN 15 ELSE 150 END),
names AS (SELECT DISTINCT an AS a, bn AS b FROM near),{JARO_SQL},
alike AS (SELECT near.*, greatest(w.sim, len(list_intersect({x}, {y})) / least(len({x}), len({y}))::DOUBLE) AS sim FROM near JOIN winkler w ON w.a = an AND w.b = bn),
ruled AS (SELECT *, {_RULE} AS method FROM alike),
told AS (SELECT *, CASE method WHEN 'rule:same_source_duplicate' THEN 0.85e0 WHEN 'rule:phone' THEN 0.95e0 WHEN 'rule:name_near' THEN 0.8e0 WHEN 'review:grey_zone' THEN round_even(sim, 3) ELSE 0.9e0 END AS score FROM ruled WHERE method IS NOT NULL),
links AS (SELECT asrc || chr(31) || arec AS ra, bsrc || chr(31) || brec AS rb, asrc AS sa, bsrc AS sb, score, d, method FROM told WHERE method <> 'review:grey_zone'),
ways AS (SELECT ra AS u, rb AS v FROM links UNION SELECT rb, ra FROM links UNION SELECT ra, ra FROM links UNION SELECT rb, rb FROM links),
reach(u, v) AS (SELECT u, v FROM ways UNION SELECT r.u, e.v FROM reach r JOIN ways e ON e.u = r.v),
comp AS (SELECT u, min(v) AS c FROM reach GROUP BY u),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY score DESC, d, ra, rb) AS n, links.* FROM links JOIN comp ON u = ra),
pass(c, n, labels, ok) AS (SELECT c, 0, list({{'r': u, 'x': u}}), false FROM comp GROUP BY c UNION ALL
  SELECT c, n + 1, CASE WHEN x = y OR held THEN labels ELSE list_transform(labels, lambda l: {{'r': l.r, 'x': CASE WHEN l.x = y THEN x ELSE l.x END}}) END, x = y OR NOT held FROM (
    SELECT *, x <> y AND sa <> sb AND list_has_any(list_transform(list_filter(labels, lambda l: l.x = x), lambda l: split_part(l.r, chr(31), 1)), list_transform(list_filter(labels, lambda l: l.x = y), lambda l: split_part(l.r, chr(31), 1))) AS held FROM (
      SELECT p.c, p.n, labels, t.sa, t.sb, list_filter(labels, lambda l: l.r = t.ra)[1].x AS x, list_filter(labels, lambda l: l.r = t.rb)[1].x AS y FROM pass p JOIN turns t ON t.c = p.c AND t.n = p.n + 1))),
ends AS (SELECT c, unnest(arg_max(labels, n)) AS l FROM pass GROUP BY c),
named AS (SELECT l.r AS rid, min(l.r) OVER (PARTITION BY c, l.x) AS entity FROM ends),
done AS (SELECT t.*, ok FROM pass JOIN turns t USING (c, n)),
hit AS (SELECT rid, arg_min(score, (-score, n)) AS score, arg_min(method, (-score, n)) AS method FROM (SELECT ra AS rid, score, method, n FROM done WHERE ok UNION ALL SELECT rb, score, method, n FROM done WHERE ok) GROUP BY rid),
members AS (SELECT r.*, coalesce(n.entity, r.source_id || chr(31) || r.source_record_id) AS entity, coalesce(h.score, 1.0e0) AS score, coalesce(h.method, 'seed') AS method FROM {records} r LEFT JOIN named n ON n.rid = r.source_id || chr(31) || r.source_record_id LEFT JOIN hit h ON h.rid = n.rid)"""


#: From ``members`` to ``entities``, the canonical record of each.
CANONICAL_SQL = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY CASE source_id WHEN 'osm' THEN 10 ELSE 20 END, -(CASE WHEN name <> '' THEN 1 ELSE 0 END + CASE WHEN phone_e164 IS NULL THEN 0 ELSE 1 END + CASE WHEN category_id IS NULL THEN 0 ELSE 1 END), source_id, source_record_id) AS pos,
  row_number() OVER (PARTITION BY entity ORDER BY -len(string_split(coalesce(category_id, ''), '.')) * CASE WHEN category_id IS NULL THEN 0 ELSE 1 END, CASE source_id WHEN 'osm' THEN 10 ELSE 20 END, source_id, source_record_id) AS deep FROM members),
entities AS (SELECT entity, coalesce(min_by(name, pos) FILTER (name <> ''), '') AS name, min_by(lat, pos) AS lat, min_by(lon, pos) AS lon, any_value(category_id) FILTER (deep = 1) AS category_id, min_by(phone_e164, pos) FILTER (phone_e164 IS NOT NULL) AS phone_e164, min_by(domain, pos) FILTER (domain IS NOT NULL) AS domain,
  CASE WHEN bool_and(operating_status = 'closed') THEN 'closed' ELSE min_by(operating_status, pos) END AS operating_status, round_even(least(0.99e0, 1 - exp(sum(ln(1 - least(greatest(source_confidence, 0), 0.99e0))))), 3) AS confidence, count(DISTINCT source_id) AS source_count FROM ranked GROUP BY entity)"""


def cell_sql(rows: str, name: str, size: float = 200.0) -> str:
    """CTEs from ``rows`` (lat, lon) to ``name`` with the cell of a grid of that size."""
    return f"""{name}_q AS (SELECT *, ((lon - 76.9286e0) * 111320.0e0 * 0.72857e0 * 0.5773502691896258e0 - (lat - 43.2389e0) * 111320.0e0 / 3.0e0) / {size!r}e0 AS {name}_x, ((lat - 43.2389e0) * 111320.0e0 * 2.0e0 / 3.0e0) / {size!r}e0 AS {name}_y FROM {rows}),
{name}_r AS (SELECT *, floor({name}_x + 0.5e0) AS {name}_a, floor({name}_y + 0.5e0) AS {name}_b, floor(-{name}_x - {name}_y + 0.5e0) AS {name}_c FROM {name}_q),
{name}_d AS (SELECT *, abs({name}_a - {name}_x) AS {name}_p, abs({name}_b - {name}_y) AS {name}_s, abs({name}_c + {name}_x + {name}_y) AS {name}_t FROM {name}_r),
{name} AS (SELECT * EXCLUDE ({name}_x, {name}_y, {name}_a, {name}_b, {name}_c, {name}_p, {name}_s, {name}_t), CAST((CASE WHEN {name}_p > {name}_s AND {name}_p > {name}_t THEN -{name}_b - {name}_c ELSE {name}_a END + 1048576) * 2097152 + (CASE WHEN {name}_p > {name}_s AND {name}_p > {name}_t THEN {name}_b WHEN {name}_s > {name}_t THEN -{name}_a - {name}_c ELSE {name}_b END) + 1048576 AS BIGINT) AS cell FROM {name}_d)"""
