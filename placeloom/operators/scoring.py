"""Opportunity score of grid cells: percentiles of activity, anchors and saturation, explained.

Sums are whole numbers (ring weights times ten, competitor weights times two), so ties in the percentiles are exact.
Neighbourhoods scatter from occupied cells to the disk around them; nothing is looked up cell by cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import stored
from ..functions import categories as cat
from ..functions.fixed import RING_WEIGHTS, SCORE_WEIGHTS
from ..functions.geo import flat_m
from ..functions.hexgrid import HexGrid

GRID = HexGrid()


def cell_counts(places: DataFrame, target: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, cell, total, anchors, comp2) of ``places`` (by, cell, category_id)."""
    return places.groupBy(*by, "cell").agg(F.count("*").alias("total"), F.count_if(cat.is_anchor(F.col("category_id"))).alias("anchors"), F.sum(cat.competitor_halves(target, F.col("category_id"))).cast("long").alias("comp2"))


def scatter(counts: DataFrame, grid: HexGrid = GRID, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, cell, act10, anc10, comp20): ring-weighted sums for every occupied cell and its first ring."""
    ten = [round(10 * w) for w in RING_WEIGHTS]
    spread = counts.select(*by, "total", "anchors", "comp2", F.explode(grid.disk_by_ring(F.col("cell"), len(ten) - 1)).alias("n"))
    weight = F.element_at(F.array(*(F.lit(w) for w in ten)), F.col("n.ring") + 1)
    comp = F.when(F.col("n.ring") <= 1, F.col("comp2") * weight).otherwise(0)
    out = spread.groupBy(*by, F.col("n.cell").alias("cell")).agg(F.sum(F.col("total") * weight).alias("act10"), F.sum(F.col("anchors") * weight).alias("anc10"), F.sum(comp).alias("comp20"), F.min("n.ring").alias("nearest"))
    return out.where("nearest <= 1").drop("nearest")


#: Ranges of values by which cumulative counts are taken in two steps: of log(1 + value), so that small whole numbers keep a range each.
STEPS = 4096


def mid_ranks(rows: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(by, of, value, share): for each value of each column the share of rows below it, ties counting half.

    Values are counted first, so a value that most rows have is one row. Their counts are added up within ranges of values and over the
    ranges, so neither a large city nor a table without cities goes through one task. Values aren't negative.
    """
    one = F.explode(F.array(*(F.struct(F.lit(c).alias("of"), F.col(c).cast("double").alias("value")) for c in columns))).alias("v")
    keys = [*by, "of"]
    counts = rows.select(*by, one).groupBy(*by, F.col("v.of").alias("of"), F.col("v.value").alias("value")).agg(F.count("*").alias("n")).withColumn("range", F.floor(F.log1p("value") * STEPS))
    before = lambda *parts, order: Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.groupBy(*keys, "range").agg(F.sum("n").alias("in_range"))
    starts = ranges.select(*keys, "range", F.coalesce(F.sum("in_range").over(before(*keys, order="range")), F.lit(0)).alias("start"), F.sum("in_range").over(Window.partitionBy(*keys)).alias("all"))
    within = counts.withColumn("ahead", F.coalesce(F.sum("n").over(before(*keys, "range", order="value")), F.lit(0)))
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"s.{k}")) for k in [*keys, "range"]]
    met = within.alias("w").join(starts.alias("s"), same)
    below = F.col("start") + F.col("ahead")
    return met.select(*(F.col(f"w.{k}").alias(k) for k in keys), "value", ((below + below + F.col("n")) / 2 / F.col("all")).alias("share"))


def _with_rank(rows: DataFrame, ranks: DataFrame, column: str, name: str, by: tuple[str, ...]) -> DataFrame:
    mine = ranks.where(F.col("of") == column).select(*(F.col(k).alias(f"__{k}") for k in by), F.col("value").alias("__value"), F.col("share").alias(name))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by] + [F.col(column).cast("double") == F.col("__value")]
    return rows.join(mine, on).drop("__value", *(f"__{k}" for k in by))


def score(places: DataFrame, target: str, grid: HexGrid = GRID, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per candidate cell of ``places`` (cell, category_id, operating_status optional): score and its parts.

    ``by`` names columns, as a city, within which cells are ranked. Cells and blends are written out between the steps.
    """
    if "operating_status" in places.columns:
        places = places.where("operating_status <> 'closed'")
    raw = stored.table(scatter(cell_counts(places, target, by), grid, by).withColumn("sat", F.col("comp20") / (2.0 * (F.col("act10") + 10))), "cells")
    ranks, out = stored.table(mid_ranks(raw, ["act10", "anc10", "sat"], by), "ranks"), raw
    for column, name in (("act10", "p_activity"), ("anc10", "p_anchors"), ("sat", "p_sat")):
        out = _with_rank(out, ranks, column, name, by)
    out = out.withColumn("balance", cat.competition_balance(F.col("comp20") / 20.0)).withColumn("p_gap", 1.0 - F.col("p_sat"))
    w = SCORE_WEIGHTS
    blend = w["activity"] * F.col("p_activity") + w["anchors"] * F.col("p_anchors") + w["competition"] * F.col("balance") + w["gap"] * F.col("p_gap")
    blended = stored.table(out.withColumn("blend", blend), "blended")
    ranked = _with_rank(blended, mid_ranks(blended, ["blend"], by), "blend", "share", by)
    return ranked.withColumn("score", F.bround(100 * F.col("share"), 0).cast("int")).select(*by, "cell", "score", "act10", "anc10", "comp20", "p_activity", "p_anchors", "balance", "p_gap")


def medians(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(*(F.median(F.col(c) / d).alias(n) for n, c, d in (("activity", "act10", 10.0), ("anchors", "anc10", 10.0), ("competitors", "comp20", 20.0))))


def reasons(scored: DataFrame) -> DataFrame:
    """(cell, why): signs and codes with their number, + before ~ before -, from rounded values as shown."""
    act, anc, comp = (F.bround(F.col(c) / d, 1) for c, d in (("act10", 10.0), ("anc10", 10.0), ("comp20", 20.0)))
    p_act, p_anc, p_gap = (F.bround(c, 3) for c in ("p_activity", "p_anchors", "p_gap"))
    one = lambda when, sign, code, n: F.when(when, F.struct(F.lit(sign).alias("sign"), F.lit(code).alias("reason"), n.alias("number")))
    all_ = [
        one(p_act >= 0.75, "+", "busy", act), one((p_anc >= 0.75) & (anc > 0), "+", "anchors", anc), one((comp >= 0.5) & (comp <= 3), "+", "some_competitors", comp), one((p_gap >= 0.7) & (comp >= 0.5), "+", "fewer_competitors_than_usual", comp),
        one(comp < 0.5, "~", "no_competitors", comp), one((p_act < 0.75) & (p_act <= 0.3), "-", "quiet", act), one(comp > 3, "-", "crowded", comp),
    ]
    return scored.select("cell", F.array_compact(F.array(*all_)).alias("why"))


#: Wording of the reasons: {n} is the cell's number, {m} the median of all cells where the reason has one.
TEXTS = {
    "busy": ("Lively surroundings: activity {n}, half of all cells have {m} or less", "activity"), "quiet": ("Few places around: activity {n}, half of all cells have {m} or more", "activity"),
    "anchors": ("Places that draw people are close by: {n} by weight, {m} in the middle cell", "anchors"), "no_competitors": ("Nobody offers this nearby, so demand is unproven", None),
    "some_competitors": ("A few competitors within a ring ({n} by weight) show that there is demand", None), "crowded": ("Many competitors within a ring: {n} by weight, {m} in the middle cell", "competitors"),
    "fewer_competitors_than_usual": ("Fewer competitors than cells as lively usually have: {n}", None),
}


def explained(scored: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """(cell, why): the reasons of ``scored`` in words, with the medians of ``of`` (by default ``scored`` itself) beside the numbers."""
    shown = lambda c: F.regexp_replace(F.format_number(c, 1), r"\.0$", "")
    middle = F.broadcast(medians(scored if of is None else of))  # one row

    def words(w: Column) -> Column:
        out = F.lit(None).cast("string")
        for code, (pattern, median) in TEXTS.items():
            line = F.replace(F.lit(pattern), F.lit("{n}"), shown(w["number"]))
            line = F.replace(line, F.lit("{m}"), shown(F.col(median))) if median else line
            out = F.when(w["reason"] == code, line).otherwise(out)
        return F.struct(w["sign"].alias("sign"), out.alias("text"))

    return reasons(scored).join(middle, F.lit(True)).select("cell", F.transform("why", words).alias("why"))


def best(scored: DataFrame, n: int = 5, separation: int = 2) -> list:
    """The best cells, none within ``separation`` of a better one chosen; ties by activity, then cell.

    Greedy by nature: rows come in order until ``n`` are chosen. At most n disks are blocked, so few rows are ever read.
    """
    from ..functions.hexgrid import offsets

    ordered = scored.orderBy(F.desc("score"), F.desc("act10"), "cell")
    chosen, blocked = [], set()
    reach = n * len(offsets(separation))  # whatever stands after that many rows can't be needed
    for row in ordered.limit(reach).toLocalIterator():
        if row.cell not in blocked:
            chosen.append(row)
            blocked |= {row.cell + q * (1 << 21) + r for q, r in offsets(separation)}
            if len(chosen) == n:
                break
    return chosen


def best_cells(scored: DataFrame, n: int = 5, separation: int = 2) -> DataFrame:
    rows = [(i + 1, r.cell, r.score, r.act10) for i, r in enumerate(best(scored, n, separation))]
    return scored.sparkSession.createDataFrame(rows, "place int, cell long, score int, act10 long")


def landmarks(cells: DataFrame, places: DataFrame, grid: HexGrid = GRID) -> DataFrame:
    """(cell, landmark): the best named place within one ring, anchors first, then by confidence, then id."""
    near = cells.select("cell", F.explode(grid.disk(F.col("cell"), 1)).alias("at"))
    named = places.where("name <> ''").select(F.col("cell").alias("at"), "place_id", "name", cat.is_anchor(F.col("category_id")).alias("anchor"), "confidence")
    rank = Window.partitionBy("cell").orderBy(F.desc("anchor"), F.desc_nulls_last("confidence"), "place_id")
    return near.join(named, "at").withColumn("n", F.row_number().over(rank)).where("n = 1").select("cell", F.col("name").alias("landmark"))


def cell_detail(cells: DataFrame, places: DataFrame, target: str, competitors: int = 15, anchors: int = 10, grid: HexGrid = GRID) -> DataFrame:
    """Nearest competitors within one ring and anchors within two of each cell, with distances: (cell, kind, place_id, distance_m, n)."""
    near = cells.select("cell", F.explode(grid.disk_by_ring(F.col("cell"), 2)).alias("d")).select("cell", F.col("d.cell").alias("at"), F.col("d.ring").alias("ring"))
    open_ = places.where("operating_status <> 'closed'").select(F.col("cell").alias("at"), "place_id", "category_id", "lat", "lon")
    lat0, lon0 = grid.centre(F.col("cell"))
    both = near.join(open_, "at").withColumn("distance_m", flat_m(F.col("lat"), F.col("lon"), lat0, lon0))
    kinds = F.explode(F.array_compact(F.array(
        F.when((F.col("ring") <= 1) & (cat.competitor_halves(target, F.col("category_id")) > 0), F.lit("competitor")), F.when(cat.is_anchor(F.col("category_id")), F.lit("anchor")),
    )))
    rank = Window.partitionBy("cell", "kind").orderBy("distance_m", "place_id")
    out = both.withColumn("kind", kinds).withColumn("n", F.row_number().over(rank))
    return out.where(F.col("n") <= F.when(F.col("kind") == "anchor", anchors).otherwise(competitors)).select("cell", "kind", "place_id", "distance_m", "n")


def places_nearby(cells: DataFrame, places: DataFrame, grid: HexGrid = GRID) -> DataFrame:
    """(cell, places): open places within two rings of each cell, zero too."""
    near = cells.select("cell", F.explode(grid.disk(F.col("cell"), 2)).alias("at"))
    counts = places.where("operating_status <> 'closed'").groupBy(F.col("cell").alias("at")).agg(F.count("*").alias("n"))
    return near.join(counts, "at", "left").groupBy("cell").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("places"))


def quantile_breaks(scored: DataFrame) -> DataFrame:
    """Score limits of the map's colours: the values at the floor of each share of the sorted scores, from the counts of the 101 scores there are."""
    counts = scored.groupBy("score").agg(F.count("*").alias("n")).agg(F.sort_array(F.collect_list(F.struct("score", "n"))).alias("s"))
    total = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    upto = F.transform("s", lambda x: F.struct(x["score"].alias("score"), F.aggregate(F.filter("s", lambda y: y["score"] <= x["score"]), F.lit(0).cast("long"), lambda a, y: a + y["n"]).alias("n")))
    rows = counts.select(upto.alias("u"), total.alias("total"))

    def at(share: float) -> Column:
        place = F.floor(F.lit(share) * (F.col("total") - 1))
        return F.get(F.filter("u", lambda x: x["n"] > place), F.lit(0))["score"].alias(f"q{int(100 * share)}")

    return rows.select(*map(at, (0.0, 0.5, 0.75, 0.9, 0.97)))
