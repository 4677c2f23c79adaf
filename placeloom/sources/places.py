"""Readers of place data. Columns vary between releases, so each select is built from the schema at hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import categories as cat
from ..functions import text
from ..functions.fixed import AREA_LEVELS, STATUS
from ..functions.geo import Box, covers, covers_any
from ..functions.hexgrid import HexGrid

PLACE_SCHEMA = (
    "source_id string, source_record_id string, name string, lat double, lon double, country_iso2 string, category_id string, source_category string, brand string, address map<string,string>, phone string, website string, "
    "opening_hours string, operating_status string, source_confidence double, raw map<string,string>, name_norm string, core_name string, phone_e164 string, domain string, cell long"
)
ALIASES = {"overture": "overture_places", "overture_places": "overture_places", "divisions": "overture_divisions", "overture_divisions": "overture_divisions", "osm": "osm", "openstreetmap": "osm"}


def source_id(name: str) -> str:
    if name.lower() not in ALIASES:
        raise ValueError(f"unknown source '{name}'; known: {', '.join(sorted(ALIASES))}")
    return ALIASES[name.lower()]


def theme_path(root: str, release: str, theme: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{release}/theme={theme}/type={kind}"


def scan(spark: SparkSession, root: str, release: str, theme: str, kind: str) -> DataFrame:
    """Parquet of one theme and type; both are partition columns."""
    return spark.read.option("basePath", f"{root.rstrip('/')}/{release}").parquet(theme_path(root, release, theme, kind))


def latest_release(names: list[str]) -> str:
    if not names:
        raise RuntimeError("no release found")
    return max(names)


def list_releases(spark: SparkSession, root: str) -> list[str]:
    """Names of the release folders under ``root``."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return sorted(x.getPath().getName() for x in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at) if x.isDirectory())


def sample(places: DataFrame, box: Box, limit: int = 25) -> tuple[list[tuple[str, str]], DataFrame]:
    """The columns of a places table with their types, and a few places of a box with what names their category. The limit is the feature."""
    have = set(places.schema.fieldNames())
    shown = [F.to_json(F.struct(c)).alias(c) for c in ("basic_category", "categories", "taxonomy") if c in have]
    rows = places.where(box.contains(F.col("bbox.xmin"), F.col("bbox.ymin"))).select(F.col("names.primary").alias("name"), *shown).limit(limit)
    return [(f.name, f.dataType.simpleString()) for f in places.schema.fields], rows


def place_select(df: DataFrame, profile: str = "pipeline") -> list[Column]:
    """The columns of a places table that are there, under our names. Profile ``city`` takes coordinates from the box and the taxonomy's parts."""
    have = set(df.schema.fieldNames())
    city = profile == "city"
    out = [F.col("id"), F.col("names.primary").alias("name")]
    if city or not {"lon", "lat"} <= have:
        out += [F.col("bbox.xmin").cast("double").alias("lon"), F.col("bbox.ymin").cast("double").alias("lat")]
    else:
        out += [F.col("lon"), F.col("lat")]
    optional = {
        "basic_category": [F.col("basic_category")], "categories": [F.col("categories.primary").alias("category_primary")],
        "taxonomy": [F.col("taxonomy.primary").alias("tax_primary"), F.col("taxonomy.hierarchy").alias("tax_hierarchy")] if city else [F.to_json("taxonomy").alias("taxonomy_json")],
        "confidence": [F.col("confidence")], "websites": [F.get("websites", F.lit(0)).alias("website")], "phones": [F.get("phones", F.lit(0)).alias("phone")], "brand": [F.col("brand.names.primary").alias("brand")],
        "addresses": [F.get("addresses", F.lit(0))["freeform"].alias("address")] if city else [F.to_json(F.get("addresses", F.lit(0))).alias("address_json")], "operating_status": [F.col("operating_status")],
    }
    return out + [c for name, columns in optional.items() if name in have for c in columns]


def land(df: DataFrame) -> Column:
    """Land areas only, as far as the release says which are."""
    have = set(df.schema.fieldNames())
    return F.col("is_land") if "is_land" in have else F.col("class") == "land" if "class" in have else F.lit(True)


def extract(places: DataFrame, box: Box, rings: Column | None = None, profile: str = "pipeline") -> DataFrame:
    """Places of a country: the box reaches the Parquet reader, the polygon decides."""
    rows = places.where(box.intersects()).select(*place_select(places, profile))
    return rows if rings is None else rows.where(covers(rings, F.col("lon"), F.col("lat")))


def extract_country(places: DataFrame, country: DataFrame, profile: str = "pipeline") -> DataFrame:
    """Places of the one country in ``country`` (its envelope and ``parts``), attached by a broadcast of that row; an error without a polygon."""
    row = country.select("xmin", "ymin", "xmax", "ymax", F.size("parts").alias("n")).first()
    if row is None or not row.n or row.n < 0:
        raise ValueError("the country has no polygon")
    rows = places.where(Box(row.xmin, row.ymin, row.xmax, row.ymax).intersects()).select(*place_select(places, profile))
    one = F.broadcast(country.select("parts"))
    return rows.join(one, F.lit(True)).where(covers_any(F.col("parts"), F.col("lon"), F.col("lat"))).drop("parts")


def extract_city(places: DataFrame, box: Box) -> DataFrame:
    """Places whose box starts inside the city's."""
    return places.where(box.contains(F.col("bbox.xmin"), F.col("bbox.ymin"))).select(*place_select(places, "city"))


def divisions(areas: DataFrame, country: str) -> DataFrame:
    """Regions, cities and districts of a country: (area_id, level, name, rings, parts or geometry)."""
    level = F.create_map(*(F.lit(x) for kv in AREA_LEVELS.items() for x in kv))
    shape = [c for c in ("rings", "parts", "geometry") if c in areas.columns]
    return areas.where((F.col("country") == country.upper()) & F.col("subtype").isin(*AREA_LEVELS) & land(areas)).select(F.col("id").alias("area_id"), F.try_element_at(level, F.col("subtype")).alias("level"), F.coalesce("names.primary", F.lit("")).alias("name"), *shape)


def _or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _status(c: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in STATUS.items() for x in kv))
    return F.coalesce(F.try_element_at(table, F.lower(c)), F.lit("unknown"))


def from_places(rows: DataFrame, iso2: str) -> DataFrame:
    """Rows of ``extract`` as place records; an address that isn't JSON is null."""
    basic, primary = cat.filled(_or_null(rows, "basic_category")), cat.filled(_or_null(rows, "category_primary"))
    raw = F.map_filter(F.create_map(*(x for k in ("basic_category", "category_primary", "taxonomy_json") for x in (F.lit(k), _or_null(rows, k)))), lambda _, v: v.isNotNull())
    out = rows.select(
        F.lit("overture_places").alias("source_id"), F.col("id").alias("source_record_id"), F.coalesce("name", F.lit("")).alias("name"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.lit(iso2).alias("country_iso2"), cat.map_place(basic, primary).alias("category_id"),
        F.coalesce(basic, primary).alias("source_category"), _or_null(rows, "brand").alias("brand"), F.from_json(_or_null(rows, "address_json"), "map<string,string>").alias("address"), _or_null(rows, "phone").alias("phone"), _or_null(rows, "website").alias("website"),
        F.lit(None).cast("string").alias("opening_hours"), _status(_or_null(rows, "operating_status")).alias("operating_status"), _or_null(rows, "confidence", "double").cast("double").alias("source_confidence"), raw.alias("raw"),
    )
    return enrich(out)


def from_tags(objects: DataFrame, iso2: str, box: Box | None = None, inside: Column | None = None) -> DataFrame:
    """Tagged objects (osm_id, tags, lat, lon) that are places, as place records, cut to the box and polygon."""
    tags = F.col("tags")
    tag = lambda *names: F.coalesce(*(cat.filled(F.try_element_at(tags, F.lit(n))) for n in names))
    some = objects.where(cat.is_poi(tags))
    for test in ([box.contains(F.col("lon"), F.col("lat"))] if box else []) + ([inside] if inside is not None else []):
        some = some.where(test)
    address = F.transform_keys(F.map_filter(tags, lambda k, _: k.startswith("addr:")), lambda k, _: F.substring(k, 6, 200))
    closed = tag("disused:shop", "disused:amenity").isNotNull() | (F.coalesce(tag("abandoned"), F.lit("")) == "yes")
    out = some.select(
        F.lit("osm").alias("source_id"), F.col("osm_id").alias("source_record_id"), F.coalesce(cat.tag_name(tags), F.lit("")).alias("name"), "lat", "lon", F.lit(iso2).alias("country_iso2"), cat.map_tags(tags).alias("category_id"), cat.primary_tag(tags).alias("source_category"),
        F.try_element_at(tags, F.lit("brand")).alias("brand"), F.when(F.size(address) > 0, address).alias("address"), tag("phone", "contact:phone").alias("phone"), tag("website", "contact:website").alias("website"), F.try_element_at(tags, F.lit("opening_hours")).alias("opening_hours"),
        F.when(closed, F.lit("closed")).otherwise(F.lit("unknown")).alias("operating_status"), F.lit(None).cast("double").alias("source_confidence"), tags.alias("raw"),
    )
    return enrich(out)


def way_points(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ways (way_id, tags, refs) at the mean of their nodes (node_id, lat, lon), a closing node counted once; ways without nodes go."""
    refs = F.when((F.size("refs") > 1) & (F.get("refs", F.lit(0)) == F.element_at("refs", -1)), F.slice("refs", F.lit(1), F.size("refs") - 1)).otherwise(F.col("refs"))
    one = ways.where(F.size("tags") > 0).select("way_id", F.explode(refs).alias("node_id"))
    mean = one.join(nodes.where("lat IS NOT NULL AND lon IS NOT NULL"), "node_id").groupBy("way_id").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    return ways.join(mean, "way_id").select(F.concat(F.lit("w"), "way_id").alias("osm_id"), "tags", "lat", "lon")


def enrich(records: DataFrame, grid: HexGrid | None = None) -> DataFrame:
    """Trimmed name, normalised forms, phone, domain and the cell of coordinates in range."""
    grid = grid or HexGrid()
    name = F.trim(F.coalesce("name", F.lit("")))
    ranged = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    out = records.withColumn("name", name)
    return out.withColumns({
        "name_norm": text.name_norm(F.col("name")), "core_name": text.core_name(F.col("name")), "phone_e164": text.normalize_phone(F.col("phone"), F.col("country_iso2")), "domain": text.normalize_domain(F.col("website")),
        "cell": F.when(ranged, grid.cell(F.col("lat"), F.col("lon"))),
    })


NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


def city_places(rows: DataFrame, iso2: str, grid: HexGrid | None = None, namespace: str = NAMESPACE) -> DataFrame:
    """Rows of ``extract_city`` as stored places; nameless, closed and doubtful ones go."""
    grid = grid or HexGrid()
    status, confidence = F.lower(F.coalesce(_or_null(rows, "operating_status"), F.lit(""))), _or_null(rows, "confidence", "double")
    primary = F.coalesce(cat.filled(_or_null(rows, "tax_primary")), cat.filled(_or_null(rows, "category_primary")))
    some = rows.where((F.trim(F.coalesce("name", F.lit(""))) != "") & ~status.isin("permanently_closed", "closed") & (confidence.isNull() | (confidence >= 0.3)))
    phone = _or_null(rows, "phone")
    out = some.select(
        text.name_uuid(namespace, F.concat(F.lit("overture:"), "id")).alias("place_id"), F.col("id").alias("gers_id"), F.trim("name").alias("name"), text.name_norm(F.trim("name")).alias("name_norm"), _or_null(rows, "brand").alias("brand"),
        cat.map_place(_or_null(rows, "basic_category"), primary, _or_null(rows, "tax_hierarchy", "array<string>")).alias("category_id"), F.coalesce(primary, cat.filled(_or_null(rows, "basic_category"))).alias("source_category"), "lon", "lat", grid.cell(F.col("lat"), F.col("lon")).alias("cell"),
        F.when(F.coalesce(_or_null(rows, "address"), F.lit("")) != "", F.to_json(F.struct(_or_null(rows, "address").alias("freeform")))).alias("address"), _or_null(rows, "website").alias("website"), F.coalesce(text.normalize_phone(phone, iso2), phone).alias("phone"),
        F.when(status.isin("open", "temporarily_closed"), status).otherwise(F.lit("unknown")).alias("operating_status"), F.bround(F.coalesce(confidence, F.lit(0.5)).cast("double"), 3).alias("confidence"),
    )
    return out.withColumn("content_hash", text.flat_hash(*(F.col(c).cast("string") for c in ("name", "category_id", "lon", "lat", "phone", "website", "operating_status"))))
