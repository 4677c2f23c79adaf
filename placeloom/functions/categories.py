"""The category tree and the mappings into it, as columns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixed import ANCHORS, KEPT_KEYS, NAMELESS, PLACE_CATEGORIES, TAG_CATEGORIES, TAG_KEYS, TAXONOMY, inverted, lines

IDS = [x[0] for x in lines(TAXONOMY)]
PLACE_MAP, TAG_MAP = inverted(PLACE_CATEGORIES), inverted(TAG_CATEGORIES)


def dimension(spark: SparkSession) -> DataFrame:
    """(id, parent_id, ru, kk, en), one row per category."""
    rows = [(i, i.rpartition(".")[0] or None, ru, kk, en) for i, ru, kk, en in lines(TAXONOMY)]
    return spark.createDataFrame(rows, "id string, parent_id string, ru string, kk string, en string")


def mapping(spark: SparkSession) -> DataFrame:
    """(source_id, source_category, category_id) of all sources."""
    rows = [("overture_places", k, v) for k, v in PLACE_MAP.items()] + [("osm", k, v) for k, v in TAG_MAP.items()]
    return spark.createDataFrame(rows, "source_id string, source_category string, category_id string")


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(table.items())))


def _looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(_map(table), key)


def map_place(basic: Column, primary: Column | None = None, hierarchy: Column | None = None) -> Column:
    """First hit of the primary name, the hierarchy from leaf to root, and the basic name."""
    tries = [] if primary is None else [_looked_up(PLACE_MAP, primary)]
    if hierarchy is not None:
        found = F.filter(F.transform(F.reverse(F.coalesce(hierarchy, F.array().cast("array<string>"))), lambda x: _looked_up(PLACE_MAP, x)), lambda x: x.isNotNull())
        tries.append(F.get(found, 0))
    return F.coalesce(*tries, _looked_up(PLACE_MAP, basic))


def _tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def map_tags(tags: Column) -> Column:
    """Combination rules first, then the first tag key whose key=value is known."""
    cuisine = F.split(F.coalesce(_tag(tags, "cuisine"), F.lit("")), ";")
    out = F.when((_tag(tags, "amenity") == "cafe") & F.array_contains(cuisine, "coffee_shop"), F.lit("food.cafe.coffee_shop"))
    out = out.when((_tag(tags, "shop") == "hairdresser") & (_tag(tags, "male") == "yes"), F.lit("beauty.barber")).when(_tag(tags, "shop") == "hairdresser", F.lit("beauty.salon"))
    return out.otherwise(F.coalesce(*(_looked_up(TAG_MAP, F.concat(F.lit(f"{k}="), _tag(tags, k))) for k in TAG_KEYS)))


def primary_tag(tags: Column) -> Column:
    """key=value of the first tag key that the object has."""
    return F.coalesce(*(F.concat(F.lit(f"{k}="), _tag(tags, k)) for k in TAG_KEYS))


def filled(c: Column) -> Column:
    """Null where empty."""
    return F.nullif(c, F.lit(""))


def tag_name(tags: Column) -> Column:
    return F.coalesce(*(filled(_tag(tags, k)) for k in ("name", "name:ru", "name:kk", "name:en")))


def nameless(category: Column) -> Column:
    out = F.lit(False)
    for p in NAMELESS:
        out = out | F.coalesce(category.startswith(p), F.lit(False))
    return out


def is_poi(tags: Column) -> Column:
    """A mapped object that is named or may be nameless, or a named one with a place's tag key."""
    named, category = tag_name(tags).isNotNull(), map_tags(tags)
    kept = F.lit(False)
    for k in KEPT_KEYS:
        kept = kept | F.map_contains_key(tags, k)
    return (category.isNotNull() & (named | nameless(category))) | (named & kept)


def root(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def compatible(a: Column, b: Column) -> Column:
    """Whether both can describe one place: same root, or either unknown."""
    return a.isNull() | b.isNull() | (root(a) == root(b))


def within(c: Column, ancestor: Column | str) -> Column:
    """Whether ``c`` is the ancestor or below it; false for null."""
    a = F.lit(ancestor) if isinstance(ancestor, str) else ancestor
    return F.coalesce((c == a) | F.startswith(c, F.concat(a, F.lit("."))), F.lit(False))


def depth(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", 0).otherwise(F.size(F.split(c, r"\.")))


def ancestors(c: Column) -> Column:
    """The category and all above it."""
    parts = F.split(c, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))


def is_anchor(c: Column) -> Column:
    out = F.lit(False)
    for p in ANCHORS:
        out = out | F.coalesce(c.startswith(p), F.lit(False))
    return out


def competitor_halves(target: str, c: Column) -> Column:
    """Twice a competitor's weight: 2 for the target and below, 1 for its parent unless that is a root, else 0."""
    parent = target.rpartition(".")[0]
    out = F.when(within(c, target), 2)
    if "." in parent:
        out = out.when(c == parent, 1)
    return out.otherwise(0)


def competition_balance(c: Column) -> Column:
    return F.when(c < 0.5, 0.55).when(c <= 3, 1.0).when(c <= 6, 0.65).otherwise(F.greatest(F.lit(0.15), 0.65 - 0.07 * (c - 6)))
