"""Queries over source records: text, categories, validation, resolution, upserts, jobs and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import ingest
from ..functions import categories as cat
from ..functions import text
from ..functions.fixed import PHONE_RULES, PLACE_CATEGORIES, SHARED_HOSTS, TAG_CATEGORIES, inverted
from ..functions.geo import Box, MetricGrid
from ..operators import jobs, reports, resolve, upsert, validation
from ..sources import schemas
from .fixtures import CANONICAL_SQL, DECIDED_SQL, JARO_SQL, LATITUDE, PLACES_SQL, RECORDS_SQL, cell_sql, places, records, resolved_sql, table

BOX = Box(76.5, 43.0, 77.5, 43.5)
GRID = MetricGrid(resolve.BLOCK_M, LATITUDE)


def text_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", text.words_only(F.lower("text")).alias("plain"))


def name_norm_nfkc(spark, d):
    return table(spark, d, "documents").select("doc_id", text.name_norm(F.col("text")).alias("name_norm"))


def text_translit(spark, d):
    letters = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
    word = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.substr(F.lit(letters), ((F.col("p_partkey") * 7 + i * 11) % len(letters)).cast("int") + 1, F.lit(1)))
    return table(spark, d, "part").select("p_partkey", text.transliterate(F.array_join(word, "")).alias("latin"))


def core_tokens(spark, d):
    words = F.split(F.lower("p_name"), " ")
    return table(spark, d, "part").select("p_partkey", F.array_join(text.core_tokens(F.concat(F.array(F.lit("coffee"), F.lit("llp")), words), F.concat(F.array(F.lit("coffee"), F.lit("llp")), words)), " ").alias("core"))


def _phones(spark, d):
    k = F.col("o_orderkey")
    raw = F.when(k % 6 == 0, F.concat(F.lit("8 (701) "), F.lpad((k % 10000000).cast("string"), 7, "0"))).when(k % 6 == 1, F.concat(F.lit("+49 30 "), k)).when(k % 6 == 2, F.concat(F.lit("0049-"), k)).when(k % 6 == 3, F.concat(F.lit("0"), F.lpad((k % 1000000000).cast("string"), 9, "1"))).when(k % 6 == 4, F.lit("call us")).otherwise(k.cast("string"))
    country = F.element_at(F.array(*(F.lit(c) for c in ("KZ", "US", "DE", "AE", "JP", "BR", "RU", "XX"))), (F.floor(k / 6) % 8).cast("int") + 1)
    return table(spark, d, "orders").select(k, raw.alias("raw"), country.alias("country"))


def phone_e164(spark, d):
    return _phones(spark, d).select("o_orderkey", text.normalize_phone(F.col("raw"), F.col("country")).alias("phone"))


def domain_from_url(spark, d):
    url = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("https://www.instagram.com/"), "page_id")).when(F.col("page_id") % 5 == 1, F.concat(F.lit("WWW.Shop"), "page_id", F.lit(".KZ:8080/x"))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", text.normalize_domain(url).alias("domain"))


def token_set_sim(spark, d):
    a = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.lower("p_name").alias("a"))
    return a.join(a.select((F.col("k") - 1).alias("k"), F.col("a").alias("b")), "k").select("k", F.round(text.token_set_similarity(F.col("a"), F.col("b")), 9).alias("sim"))


def jaro_winkler_pairs(spark, d):
    a = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.lower("p_name").alias("a"))
    return a.join(a.select((F.col("k") - 1).alias("k"), F.col("a").alias("b")), "k").select("k", F.round(text.jaro_winkler(F.col("a"), F.col("b")), 9).alias("sim"))


def content_hashes(spark, d):
    p = places(spark, d)
    return p.select("place_id", text.flat_hash("name", "category_id", "operating_status").alias("flat"), text.name_uuid("6ba7b811-9dad-11d1-80b4-00c04fd430c8", F.col("name")).alias("uuid"), text.job_key(F.lit("kz"), F.lit("source"), F.col("category_id"), F.lit(None).cast("string"), F.lit("0.1.0")).alias("job_key"))


def category_map(spark, d):
    """Source category names drawn from the mapping and from nowhere, mapped with all three inputs."""
    names = sorted(inverted(PLACE_CATEGORIES))
    pick = lambda n: F.element_at(F.array(*(F.lit(x) for x in [*names, "unheard_of"])), ((F.col("p_partkey") * n) % (len(names) + 1)).cast("int") + 1)
    rows = table(spark, d, "part").select("p_partkey", pick(1).alias("basic"), F.when(F.col("p_partkey") % 3 == 0, pick(7)).otherwise(F.lit("other")).alias("main"), F.array(F.lit("root"), pick(11), F.lit("leaf")).alias("path"))
    return rows.select("p_partkey", cat.map_place(F.col("basic"), F.col("main"), F.when(F.col("p_partkey") % 2 == 0, F.col("path"))).alias("category_id"))


def tag_map(spark, d):
    names = sorted(inverted(TAG_CATEGORIES))
    keys = F.array(*(F.lit(x) for x in [*names, "shop=hairdresser", "office=it"]))
    tag = F.element_at(keys, (F.col("p_partkey") % (len(names) + 2)).cast("int") + 1)
    tags = F.map_from_arrays(F.array(F.substring_index(tag, "=", 1), F.lit("male"), F.lit("cuisine"), F.lit("name")), F.array(F.substring_index(tag, "=", -1), F.when(F.col("p_partkey") % 2 == 0, F.lit("yes")).otherwise(F.lit("no")), F.when(F.col("p_partkey") % 7 == 0, F.lit("tea;coffee_shop")).otherwise(F.lit("tea")), F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.lit("x"))))
    return table(spark, d, "part").select("p_partkey", cat.map_tags(tags).alias("category_id"), cat.primary_tag(tags).alias("tag"), cat.is_poi(tags).alias("poi"))


def grid_block_pairs(spark, d):
    pairs = resolve.candidates(records(spark, d), GRID, resolve.PAIR_COLUMNS)
    return pairs.select(F.col("a.source_record_id").alias("a"), F.col("b.source_record_id").alias("b"))


def _decided(spark, d):
    return resolve.decide(resolve.candidates(records(spark, d), GRID, resolve.PAIR_COLUMNS), text.token_set_similarity)


def match_decisions(spark, d):
    return _decided(spark, d).select(F.col("a.source_record_id").alias("a"), F.col("b.source_record_id").alias("b"), "method", "score", F.round("sim", 6).alias("sim"))


def match_names(spark, d):
    """The rules under the similarity of names, from the joins that resolution uses."""
    told = resolve.decide(resolve.near_pairs(records(spark, d), GRID))
    return told.select(F.col("a.source_record_id").alias("a"), F.col("b.source_record_id").alias("b"), "method", F.round("score", 9).alias("score"), F.round("sim", 9).alias("sim"))


def review_pairs(spark, d):
    return resolve.review_pairs(_decided(spark, d)).select("a_source", "a_rec", "b_source", "b_rec", "score")


def resolve_entities(spark, d):
    return resolve.resolve(records(spark, d), LATITUDE)["members"].select("source_id", "source_record_id", "entity", "score", "method")


def resolve_stats(spark, d):
    return resolve.resolve(records(spark, d), LATITUDE)["stats"]


def canonical_places(spark, d):
    return resolve.resolve(records(spark, d), LATITUDE)["entities"].select("entity", "name", "lat", "lon", "category_id", "phone_e164", "domain", "operating_status", "confidence", "source_count")


def ingest_places(spark, d):
    """Records of both sources from validation to places: resolved, with stable ids from an old lineage, cells and the dates of the load."""
    valid = validation.kept(_checked(spark, d)).drop("n")
    rows, _ = ingest.places_of(resolve.resolve(valid, LATITUDE), _lineage(spark, d), "KZ")
    new = ingest.loaded(schemas.empty(spark, "place"), rows, F.lit("2024-03-01").cast("date"))
    return new.select("place_id", "name", "lat", "lon", "cell", "category_id", "phone", "operating_status", "confidence", "source_count", "country_iso2", "first_seen", "closed_detected_at")


def canonical_by_name(spark, d):
    """Canonical records where the entity is the name and category: the merge rules alone, which SQL can say too."""
    members = records(spark, d).withColumn("entity", F.concat_ws("|", "core_name", "category_id"))
    return resolve.canonical(members).select("entity", "name", "lat", "category_id", "phone_e164", "domain", "operating_status", "confidence", "source_count", "n_records")


def _checked(spark, d):
    k = F.col("source_record_id")
    n = F.substring(k, 2, 20).cast("long")
    rows = records(spark, d).withColumn("n", n)
    rows = rows.withColumn("lat", F.when(n % 41 == 0, None).when(n % 41 == 1, 0.0).when(n % 41 == 2, 95.0).when(n % 41 == 3, 48.85).otherwise(F.col("lat"))).withColumn("lon", F.when(n % 41 == 1, 0.0).when(n % 41 == 3, 2.35).otherwise(F.col("lon")))
    rows = rows.withColumn("name", F.when(n % 37 == 0, F.lit("  ")).otherwise(F.col("name"))).withColumn("category_id", F.when(n % 31 == 0, None).when(n % 31 == 1, F.lit("no.such")).when(n % 31 == 2, F.lit("transport.bus_stop")).otherwise(F.col("category_id")))
    return validation.validate(rows, BOX)


def validate_issues(spark, d):
    return _checked(spark, d).select("source_record_id", F.array_join("issues", ",").alias("issues"), "dropped", "warned", F.round("source_confidence", 6).alias("confidence"))


def quality_report(spark, d):
    return validation.report(_checked(spark, d)).select("total", "valid", "dropped", "warnings", "score", "passed")


def quality_issues(spark, d):
    return validation.issue_counts(_checked(spark, d))


def quality_gate_delta(spark, d):
    return validation.report(_checked(spark, d), previous=100).select("total", "delta", "delta_exceeded", "passed")


def _lineage(spark, d):
    """Two old loads of the records: places by name and by phone."""
    r = records(spark, d)
    one = r.where(F.length("source_record_id") % 2 == 0).select("source_id", "source_record_id", F.concat(F.lit("p-"), "core_name").alias("place_id"), F.lit(1).alias("dataset_version"))
    two = r.where("phone_e164 IS NOT NULL").select("source_id", "source_record_id", F.concat(F.lit("p-"), "phone_e164").alias("place_id"), F.lit(2).alias("dataset_version"))
    return one.unionByName(two)


def latest_lineage(spark, d):
    return upsert.latest_lineage(_lineage(spark, d)).select("source_id", "source_record_id", "place_id", "dataset_version")


def stable_ids(spark, d):
    members = records(spark, d).withColumn("entity", F.concat_ws("|", "core_name", "category_id"))
    return upsert.stable_ids(members, _lineage(spark, d))


def _loads(spark, d):
    """The stored places and a new load: some changed, some moved, some new, some gone."""
    p = places(spark, d).select("place_id", "name", "category_id", "operating_status", "cell")
    k = F.col("place_id")
    hashed = lambda x: x.withColumn("content_hash", text.flat_hash("name", "category_id", "operating_status", F.col("cell").cast("string")))
    old = hashed(p.where(k % 10 != 9)).withColumn("last_seen", F.when(k % 8 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-02-01")).cast("date")).withColumn("first_seen", F.lit("2024-01-01").cast("date")).withColumn("closed_detected_at", F.lit(None).cast("date")).withColumn("updated_at", F.lit("2024-01-01").cast("date"))
    new = hashed(p.where(k % 10 != 8).withColumn("name", F.when(k % 6 == 0, F.concat("name", F.lit(" new"))).otherwise(F.col("name"))).withColumn("cell", F.when(k % 15 == 0, F.col("cell") + 1).otherwise(F.col("cell"))))
    return old, new


def upsert_places(spark, d):
    old, new = _loads(spark, d)
    return upsert.merge_places(old, new, F.lit("2024-03-01").cast("date")).select("place_id", "name", "cell", "first_seen", "last_seen", "closed_detected_at", "updated_at")


def upsert_counts(spark, d):
    return upsert.changes(*_loads(spark, d))


def dirty_cells(spark, d):
    return upsert.dirty_cells(*_loads(spark, d))


def not_seen(spark, d):
    return upsert.absent(*_loads(spark, d)).select("place_id", "last_seen")


def _versions(spark, d):
    e = table(spark, d, "events")
    status = F.when(F.col("event_type") == "error", F.lit("failed")).when(F.col("event_type") == "signup", F.lit("staged")).when(F.col("event_type") == "purchase", F.lit("superseded")).otherwise(F.lit("active"))
    return e.select(F.col("event_id").alias("id"), F.concat(F.lit("s"), F.col("user_id") % 5).alias("source_id"), F.concat(F.lit("c"), F.col("user_id") % 3).alias("country"), F.date_format("ts", "yyyy-MM-dd").alias("source_version"), status.alias("status"), F.col("ts").alias("ingested_at"), F.col("event_id").alias("row_count"))


NOW = "2030-01-01 00:00:00"


def source_freshness(spark, d):
    return reports.freshness(_versions(spark, d), F.lit(NOW).cast("timestamp"))


def version_activate(spark, d):
    return upsert.activate(_versions(spark, d), 100).select("id", "status")


def previous_rows(spark, d):
    return upsert.previous_rows(_versions(spark, d))


def _jobs(spark, d):
    e = table(spark, d, "events")
    k = F.col("event_id")
    status = F.when(F.col("event_type") == "error", F.lit("FAILED")).when(F.col("event_type") == "signup", F.lit("PROCESSING")).when(F.col("event_type") == "click", F.lit("LOADED")).otherwise(F.lit("PENDING"))
    return e.select(k.alias("id"), F.concat(F.lit("C"), k % 40).alias("iso2"), F.when(k % 4 == 3, F.lit("resolve")).otherwise(F.lit("source")).alias("kind"), status.alias("status"), (F.col("user_id") % 5).cast("int").alias("attempts"), F.col("ts").alias("created_at"), F.col("ts").alias("locked_at"), F.when(k % 4 == 3, F.array(k - 1, k - 2)).otherwise(F.array().cast("array<long>")).alias("depends_on"))


def claimable_jobs(spark, d):
    return jobs.claimable(_jobs(spark, d), F.lit(NOW).cast("timestamp")).select("id", "kind")


def coverage_status(spark, d):
    n = table(spark, d, "nation")
    countries = n.select(F.concat(F.lit("C"), F.col("n_nationkey") * 2).alias("iso2"), F.col("n_name").alias("name"))
    found = places(spark, d).select(F.concat(F.lit("C"), F.col("place_id") % 60).alias("iso2"))
    return reports.coverage(countries, _jobs(spark, d), found)


def countries_by_status(spark, d):
    return reports.by_status(coverage_status(spark, d))


_P, _R, _D = f"WITH {PLACES_SQL}", f"WITH {RECORDS_SQL}", f"WITH {DECIDED_SQL}"
_VERSIONS = "v AS (SELECT event_id AS id, 's' || (user_id % 5) AS source_id, 'c' || (user_id % 3) AS country, strftime(ts, '%Y-%m-%d') AS source_version, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'staged' WHEN 'purchase' THEN 'superseded' ELSE 'active' END AS status, ts AS ingested_at, event_id AS row_count FROM events)"
_JOBS = "j AS (SELECT event_id AS id, 'C' || (event_id % 40) AS iso2, CASE WHEN event_id % 4 = 3 THEN 'resolve' ELSE 'source' END AS kind, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PROCESSING' WHEN 'click' THEN 'LOADED' ELSE 'PENDING' END AS status, user_id % 5 AS attempts, ts AS locked_at FROM events)"
_COVER = f"{_P}, {_JOBS}, js AS (SELECT iso2, CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 'FAILED' WHEN count(*) FILTER (status = 'PROCESSING') > 0 THEN 'PROCESSING' WHEN count(*) FILTER (status = 'PENDING') > 0 THEN 'PENDING' ELSE 'LOADED' END AS st FROM j GROUP BY iso2), ps AS (SELECT 'C' || (place_id % 60) AS iso2, count(*) AS n FROM places GROUP BY 1), cv AS (SELECT c.iso2, name, coalesce(st, 'NOT_QUEUED') AS status, coalesce(n, 0) AS places FROM (SELECT 'C' || (n_nationkey * 2) AS iso2, n_name AS name FROM nation) c LEFT JOIN js USING (iso2) LEFT JOIN ps USING (iso2))"
_CHECKED = f"""{_R}, c0 AS (SELECT *, CAST(substr(source_record_id, 2) AS BIGINT) AS n FROM records),
c1 AS (SELECT * REPLACE (CASE n % 41 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0 WHEN 2 THEN 95.0e0 WHEN 3 THEN 48.85e0 ELSE lat END AS lat, CASE n % 41 WHEN 1 THEN 0.0e0 WHEN 3 THEN 2.35e0 ELSE lon END AS lon, CASE WHEN n % 37 = 0 THEN '  ' ELSE name END AS name, CASE n % 31 WHEN 0 THEN NULL WHEN 1 THEN 'no.such' WHEN 2 THEN 'transport.bus_stop' ELSE category_id END AS category_id) FROM c0),
c2 AS (SELECT *, CASE WHEN lat IS NULL OR lon IS NULL THEN ['missing_coordinates'] WHEN NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) THEN ['out_of_range'] WHEN abs(lat) < 1e-6 AND abs(lon) < 1e-6 THEN ['null_island'] ELSE list_filter([CASE WHEN NOT (lon BETWEEN 76.45e0 AND 77.55e0 AND lat BETWEEN 42.95e0 AND 43.55e0) THEN 'outside_bbox' END, CASE WHEN trim(name) = '' AND NOT coalesce(starts_with(category_id, 'transport.'), false) THEN 'empty_name' END, CASE WHEN category_id IS NULL THEN 'no_category' WHEN category_id = 'no.such' THEN 'unknown_category' END, CASE WHEN source_confidence < 0.3 THEN 'low_confidence' END, CASE WHEN operating_status = 'closed' THEN 'closed' END], lambda x: x IS NOT NULL) END AS issues FROM c1),
c3 AS (SELECT *, list_has_any(issues, ['missing_coordinates', 'out_of_range', 'null_island', 'outside_bbox', 'empty_name', 'unknown_category']) AS dropped FROM c2), c4 AS (SELECT *, NOT dropped AND list_has_any(issues, ['low_confidence', 'closed']) AS warned FROM c3)"""
_LOADS = f"""{_P}, hp AS (SELECT place_id, name, category_id, operating_status, cell FROM places),
old AS (SELECT *, md5(concat_ws('|', name, category_id, operating_status, CAST(cell AS VARCHAR))) AS h, CASE WHEN place_id % 8 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS last_seen FROM hp WHERE place_id % 10 <> 9),
n0 AS (SELECT place_id, CASE WHEN place_id % 6 = 0 THEN name || ' new' ELSE name END AS name, category_id, operating_status, CASE WHEN place_id % 15 = 0 THEN cell + 1 ELSE cell END AS cell FROM hp WHERE place_id % 10 <> 8), new AS (SELECT *, md5(concat_ws('|', name, category_id, operating_status, CAST(cell AS VARCHAR))) AS h FROM n0)"""
_LINEAGE = f"{_R}, ln AS (SELECT source_id, source_record_id, 'p-' || core_name AS place_id, 1 AS dataset_version FROM records WHERE length(source_record_id) % 2 = 0 UNION ALL SELECT source_id, source_record_id, 'p-' || phone_e164, 2 FROM records WHERE phone_e164 IS NOT NULL), ll AS (SELECT * FROM ln QUALIFY row_number() OVER (PARTITION BY source_id, source_record_id ORDER BY dataset_version DESC, place_id) = 1)"

_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"
_IDS = f"""mb AS (SELECT *, source_id || chr(1) || source_record_id AS key FROM members), sz AS (SELECT entity, count(DISTINCT source_id) AS sources, min(key) AS k FROM mb GROUP BY entity),
vt AS (SELECT entity, place_id, count(*) AS votes, min(key) AS fst FROM mb JOIN ll USING (source_id, source_record_id) GROUP BY ALL), md AS (SELECT entity, place_id FROM vt QUALIFY row_number() OVER (PARTITION BY entity ORDER BY votes DESC, fst) = 1), cl AS (SELECT entity, place_id FROM md JOIN sz USING (entity) QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY sources DESC, k, entity) = 1),
hs AS (SELECT sz.entity, cl.place_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(replace(k, chr(1), ':') || ':' || sz.entity)) AS h FROM sz LEFT JOIN cl USING (entity)),
ids AS (SELECT entity, coalesce(place_id, {_UUID}) AS place_id FROM hs)"""
_INGESTED = f"""{_CHECKED.removeprefix("WITH")}, {_LINEAGE.partition("ln AS")[2].join(["ln AS", ""])}, valid AS (SELECT * REPLACE (CASE WHEN warned THEN round_even(source_confidence * 0.8e0, 3) ELSE source_confidence END AS source_confidence) FROM c4 WHERE NOT dropped), {resolved_sql("valid")},{CANONICAL_SQL}, {_IDS},
{cell_sql("(SELECT * FROM entities JOIN ids USING (entity))", "placed")}"""


def _phone_sql() -> str:
    out = "CASE WHEN digits = '' THEN NULL WHEN starts_with(raw, '+') OR starts_with(raw, '00') THEN CASE WHEN length(f) BETWEEN 8 AND 15 THEN '+' || f END"
    for c, (code, lengths) in PHONE_RULES.items():
        n = ", ".join(map(str, lengths))
        own = "CASE"
        if code == "7":
            own += " WHEN length(digits) = 11 AND digits[1] IN ('7', '8') THEN '+7' || substr(digits, 2)"
        if code == "1":
            own += " WHEN length(digits) = 11 AND digits[1] = '1' THEN '+' || digits"
        own += f" WHEN starts_with(digits, '{code}') AND length(digits) - {len(code)} IN ({n}) THEN '+' || digits WHEN length(nat) IN ({n}) THEN '+{code}' || nat END"
        out += f" WHEN country = '{c}' THEN {own}"
    return out + " END"


_HOSTS = ", ".join(f"'{h}'" for h in SHARED_HOSTS)
_NAMES = sorted(inverted(PLACE_CATEGORIES))
_TAGS = sorted(inverted(TAG_CATEGORIES))
_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_values = lambda m: ", ".join(f"('{k}', '{v}')" for k, v in m.items())

ORACLES = {
    "text_normalize": r"SELECT doc_id, trim(regexp_replace(regexp_replace(replace(lower(text), 'ё', 'е'), '[^\p{L}\p{N}\s]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS plain FROM documents",
    "text_translit": "WITH w AS (SELECT p_partkey, unnest(range(6)) AS i FROM part), c AS (SELECT p_partkey, i, substr('абвгдежзийклмнопрстуфхцчшщъыьэюя', (p_partkey * 7 + i * 11) % 32 + 1, 1) AS c FROM w), m(c, t) AS (VALUES ('а','a'),('б','b'),('в','v'),('г','g'),('д','d'),('е','e'),('ж','zh'),('з','z'),('и','i'),('й','i'),('к','k'),('л','l'),('м','m'),('н','n'),('о','o'),('п','p'),('р','r'),('с','s'),('т','t'),('у','u'),('ф','f'),('х','h'),('ц','ts'),('ч','ch'),('ш','sh'),('щ','sh'),('ъ',''),('ы','y'),('ь',''),('э','e'),('ю','yu'),('я','ya')) SELECT p_partkey, string_agg(t, '' ORDER BY i) AS latin FROM c JOIN m USING (c) GROUP BY p_partkey",
    "core_tokens": "SELECT p_partkey, lower(p_name) AS core FROM part",
    "phone_e164": f"WITH p AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '8 (701) ' || lpad(CAST(o_orderkey % 10000000 AS VARCHAR), 7, '0') WHEN 1 THEN '+49 30 ' || o_orderkey WHEN 2 THEN '0049-' || o_orderkey WHEN 3 THEN '0' || lpad(CAST(o_orderkey % 1000000000 AS VARCHAR), 9, '1') WHEN 4 THEN 'call us' ELSE CAST(o_orderkey AS VARCHAR) END AS raw, ['KZ', 'US', 'DE', 'AE', 'JP', 'BR', 'RU', 'XX'][(o_orderkey // 6) % 8 + 1] AS country FROM orders), q AS (SELECT *, regexp_replace(raw, '[^0-9]', '', 'g') AS digits FROM p), r AS (SELECT *, CASE WHEN starts_with(raw, '00') THEN substr(digits, 3) ELSE digits END AS f, CASE WHEN starts_with(digits, '0') THEN substr(digits, 2) ELSE digits END AS nat FROM q) SELECT o_orderkey, {_phone_sql()} AS phone FROM r",
    "domain_from_url": f"WITH u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'https://www.instagram.com/' || page_id WHEN 1 THEN 'WWW.Shop' || page_id || '.KZ:8080/x' ELSE url END AS u FROM pages), h AS (SELECT page_id, lower(regexp_replace(regexp_extract(CASE WHEN contains(u, '://') THEN u ELSE 'http://' || u END, '://([^/?#]*)', 1), ':.*$', '')) AS h FROM u), b AS (SELECT page_id, CASE WHEN starts_with(h, 'www.') THEN substr(h, 5) ELSE h END AS b FROM h) SELECT page_id, CASE WHEN contains(b, '.') AND b NOT IN ({_HOSTS}) THEN b END AS domain FROM b",
    "token_set_sim": "WITH a AS (SELECT p_partkey AS k, list_distinct(string_split(lower(p_name), ' ')) AS a FROM part) SELECT x.k, round(len(list_intersect(x.a, y.a)) / least(len(x.a), len(y.a))::DOUBLE, 9) AS sim FROM a x JOIN a y ON y.k = x.k + 1",
    "content_hashes": f"{_P}, h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(name)) AS h FROM places) SELECT place_id, md5(concat_ws('|', name, category_id, operating_status)) AS flat, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid, 'KZ:source:' || coalesce(category_id, '-') || ':-:0.1.0' AS job_key FROM h",
    "category_map": f"WITH m(k, v) AS (VALUES {_values(inverted(PLACE_CATEGORIES))}), l AS (SELECT {_list([*_NAMES, 'unheard_of'])} AS l), r AS (SELECT p_partkey, l[p_partkey % {len(_NAMES) + 1} + 1] AS basic, CASE WHEN p_partkey % 3 = 0 THEN l[(p_partkey * 7) % {len(_NAMES) + 1} + 1] END AS main, CASE WHEN p_partkey % 2 = 0 THEN l[(p_partkey * 11) % {len(_NAMES) + 1} + 1] END AS mid FROM part, l) SELECT p_partkey, coalesce(a.v, b.v, c.v) AS category_id FROM r LEFT JOIN m a ON a.k = main LEFT JOIN m b ON b.k = mid LEFT JOIN m c ON c.k = basic",
    "tag_map": f"WITH m(k, v) AS (VALUES {_values(inverted(TAG_CATEGORIES))}), r AS (SELECT p_partkey, {_list([*_TAGS, 'shop=hairdresser', 'office=it'])}[p_partkey % {len(_TAGS) + 2} + 1] AS tag, p_partkey % 2 = 0 AS male, p_partkey % 7 = 0 AS coffee, p_partkey % 3 <> 0 AS named FROM part), c AS (SELECT *, CASE WHEN tag = 'amenity=cafe' AND coffee THEN 'food.cafe.coffee_shop' WHEN tag = 'shop=hairdresser' AND male THEN 'beauty.barber' WHEN tag = 'shop=hairdresser' THEN 'beauty.salon' ELSE v END AS category_id FROM r LEFT JOIN m ON m.k = tag) SELECT p_partkey, category_id, tag, (category_id IS NOT NULL AND (named OR starts_with(category_id, 'transport.') OR starts_with(category_id, 'finance.atm'))) OR (named AND split_part(tag, '=', 1) IN ('amenity', 'shop', 'leisure', 'tourism', 'office', 'healthcare', 'craft')) AS poi FROM c",
    "grid_block_pairs": f"{_D} SELECT arec AS a, brec AS b FROM pr",
    "match_decisions": f"{_D} SELECT arec AS a, brec AS b, method, CASE method WHEN 'rule:same_source_duplicate' THEN 0.85e0 WHEN 'rule:phone' THEN 0.95e0 WHEN 'rule:name_near' THEN 0.8e0 WHEN 'review:grey_zone' THEN round_even(sim, 3) ELSE 0.9e0 END AS score, round(sim, 6) AS sim FROM decided WHERE method IS NOT NULL",
    "review_pairs": f"{_D} SELECT asrc AS a_source, arec AS a_rec, bsrc AS b_source, brec AS b_rec, round_even(sim, 3) AS score FROM decided WHERE method = 'review:grey_zone'",
    "jaro_winkler_pairs": f"WITH RECURSIVE q AS (SELECT x.p_partkey AS k, lower(x.p_name) AS a, lower(y.p_name) AS b FROM part x JOIN part y ON y.p_partkey = x.p_partkey + 1), names AS (SELECT DISTINCT a, b FROM q),{JARO_SQL} SELECT k, round(sim, 9) AS sim FROM q JOIN winkler USING (a, b)",
    "match_names": f"WITH RECURSIVE {RECORDS_SQL}, {resolved_sql()} SELECT arec AS a, brec AS b, method, round(score, 9) AS score, round(sim, 9) AS sim FROM told",
    "resolve_entities": f"WITH RECURSIVE {RECORDS_SQL}, {resolved_sql()} SELECT source_id, source_record_id, entity, score, method FROM members",
    "resolve_stats": f"WITH RECURSIVE {RECORDS_SQL}, {resolved_sql()} SELECT (SELECT count(*) FROM members) AS records, (SELECT count(DISTINCT entity) FROM members) AS entities, (SELECT count(*) FROM pr) AS pairs_compared, (SELECT count(*) FROM done WHERE ok) AS merges, (SELECT count(*) FROM done WHERE NOT ok) AS merges_blocked, (SELECT count(*) FROM told WHERE method = 'review:grey_zone') AS review_pairs",
    "canonical_places": f"WITH RECURSIVE {RECORDS_SQL}, {resolved_sql()},{CANONICAL_SQL} SELECT * FROM entities",
    "ingest_places": f"WITH RECURSIVE {_INGESTED} SELECT place_id, name, lat, lon, cell, category_id, phone_e164 AS phone, operating_status, confidence, source_count, 'KZ' AS country_iso2, DATE '2024-03-01' AS first_seen, CASE WHEN operating_status = 'closed' THEN DATE '2024-03-01' END AS closed_detected_at FROM placed",
    "canonical_by_name": f"""{_R}, m AS (SELECT *, core_name || '|' || category_id AS entity, CASE source_id WHEN 'osm' THEN 10 ELSE 20 END AS pr, -(CASE WHEN name <> '' THEN 1 ELSE 0 END + CASE WHEN phone_e164 IS NULL THEN 0 ELSE 1 END + 1) AS filled FROM records),
o AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY pr, filled, source_id, source_record_id) AS n FROM m)
SELECT entity, min_by(name, n) AS name, min_by(lat, n) AS lat, any_value(category_id) AS category_id, min_by(phone_e164, n) FILTER (phone_e164 IS NOT NULL) AS phone_e164, min_by(domain, n) FILTER (domain IS NOT NULL) AS domain, CASE WHEN bool_and(operating_status = 'closed') THEN 'closed' ELSE min_by(operating_status, n) END AS operating_status,
round_even(least(0.99e0, 1 - exp(sum(ln(1 - least(greatest(source_confidence, 0), 0.99e0))))), 3) AS confidence, count(DISTINCT source_id) AS source_count, count(*) AS n_records FROM o GROUP BY entity""",
    "validate_issues": f"{_CHECKED} SELECT source_record_id, array_to_string(issues, ',') AS issues, dropped, warned, round(CASE WHEN warned THEN round_even(source_confidence * 0.8e0, 3) ELSE source_confidence END, 6) AS confidence FROM c4",
    "quality_report": f"{_CHECKED}, t AS (SELECT count(*) AS total, count(*) FILTER (NOT dropped) AS valid, count(*) FILTER (dropped) AS dropped, count(*) FILTER (warned) AS warnings FROM c4) SELECT *, round_even((valid - warnings + 0.5e0 * warnings) / total, 3) AS score, round_even((valid - warnings + 0.5e0 * warnings) / total, 3) >= 0.8 AS passed FROM t",
    "quality_issues": f"{_CHECKED} SELECT issue, count(*) AS n FROM (SELECT unnest(issues) AS issue FROM c4) GROUP BY issue",
    "quality_gate_delta": f"{_CHECKED}, t AS (SELECT count(*) AS total, count(*) FILTER (NOT dropped) AS valid, count(*) FILTER (warned) AS w FROM c4) SELECT total, round_even((valid - 100) / 100.0e0, 4) AS delta, abs((valid - 100) / 100.0e0) > 0.15 AS delta_exceeded, round_even((valid - 0.5e0 * w) / total, 3) >= 0.8 AND abs((valid - 100) / 100.0e0) <= 0.15 AS passed FROM t",
    "latest_lineage": f"{_LINEAGE} SELECT source_id, source_record_id, place_id, dataset_version FROM ll",
    "stable_ids": f"""{_LINEAGE}, mb AS (SELECT *, core_name || '|' || category_id AS entity, source_id || chr(1) || source_record_id AS key FROM records), sz AS (SELECT entity, count(DISTINCT source_id) AS sources, min(key) AS k FROM mb GROUP BY entity),
vt AS (SELECT entity, place_id, count(*) AS votes, min(key) AS fst FROM mb JOIN ll USING (source_id, source_record_id) GROUP BY ALL), md AS (SELECT entity, place_id FROM vt QUALIFY row_number() OVER (PARTITION BY entity ORDER BY votes DESC, fst) = 1), cl AS (SELECT entity, place_id FROM md JOIN sz USING (entity) QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY sources DESC, k, entity) = 1),
h AS (SELECT sz.entity, cl.place_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(replace(k, chr(1), ':') || ':' || sz.entity)) AS h FROM sz LEFT JOIN cl USING (entity))
SELECT entity, coalesce(place_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)) AS place_id, place_id IS NOT NULL AS reused FROM h""",
    "upsert_places": f"{_LOADS} SELECT n.place_id, n.name, n.cell, CASE WHEN o.place_id IS NULL THEN DATE '2024-03-01' ELSE DATE '2024-01-01' END AS first_seen, DATE '2024-03-01' AS last_seen, CASE WHEN n.operating_status = 'closed' THEN DATE '2024-03-01' END AS closed_detected_at, CASE WHEN o.h = n.h THEN DATE '2024-01-01' ELSE DATE '2024-03-01' END AS updated_at FROM new n LEFT JOIN old o USING (place_id) UNION ALL SELECT place_id, name, cell, DATE '2024-01-01', last_seen, NULL, DATE '2024-01-01' FROM old WHERE place_id NOT IN (SELECT place_id FROM new)",
    "upsert_counts": f"{_LOADS} SELECT count(*) FILTER (o.h IS NULL) AS inserted, count(*) FILTER (o.h <> n.h) AS updated, count(*) FILTER (o.h = n.h) AS unchanged FROM new n LEFT JOIN old o USING (place_id)",
    "dirty_cells": f"{_LOADS}, b AS (SELECT n.cell, o.cell AS was, o.h AS oh FROM new n LEFT JOIN old o USING (place_id) WHERE o.h IS NULL OR o.h <> n.h), u AS (SELECT cell, 1 AS w FROM b UNION ALL SELECT was, 2 FROM b WHERE oh IS NOT NULL UNION ALL SELECT cell, 3 FROM old WHERE last_seen = (SELECT max(last_seen) FROM old) AND place_id NOT IN (SELECT place_id FROM new)) SELECT cell, ['new_or_changed', 'moved_or_changed', 'not_seen'][min(w)] AS reason FROM u GROUP BY cell",
    "not_seen": f"{_LOADS} SELECT place_id, last_seen FROM old WHERE last_seen = (SELECT max(last_seen) FROM old) AND place_id NOT IN (SELECT place_id FROM new)",
    "source_freshness": f"WITH {_VERSIONS} SELECT source_id, max(source_version) AS latest_version, max(ingested_at) AS last_ingested_at, CAST(floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ingested_at))) / 86400000000.0e0) AS BIGINT) AS days_since_ingest FROM v WHERE status = 'active' GROUP BY source_id",
    "version_activate": f"WITH {_VERSIONS} SELECT v.id, CASE WHEN v.id = 100 THEN 'active' WHEN v.status = 'active' AND v.id < 100 AND v.source_id = t.source_id AND v.country = t.country THEN 'superseded' ELSE v.status END AS status FROM v, (SELECT source_id, country FROM v WHERE id = 100) t",
    "previous_rows": f"WITH {_VERSIONS} SELECT source_id, country, row_count FROM v WHERE status = 'active' QUALIFY row_number() OVER (PARTITION BY source_id, country ORDER BY ingested_at DESC, id DESC) = 1",
    "claimable_jobs": f"WITH {_JOBS} SELECT id, kind FROM j WHERE (status = 'PENDING' OR (status = 'PROCESSING' AND locked_at < TIMESTAMP '{NOW}' - INTERVAL 6 HOURS)) AND attempts < 3 AND NOT (kind = 'resolve' AND EXISTS (SELECT 1 FROM j x WHERE x.id IN (j.id - 1, j.id - 2) AND x.status <> 'LOADED'))",
    "coverage_status": f"{_COVER} SELECT * FROM cv",
    "countries_by_status": f"{_COVER} SELECT status, count(*) AS countries FROM cv GROUP BY status",
}

QUERIES = {n: globals()[n] for n in [*ORACLES, "name_norm_nfkc"]}
