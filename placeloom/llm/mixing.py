"""Mixing sources to target weights with hierarchical budgets; DataFrame functions only.

The tree is domain, language, source. A budget of tokens enters at the root; each node's budget is dealt to its
children by weight, none getting more than its subtree can give (its tokens times ``max_epochs``). What a child
can't take goes to its siblings by weight, and only what a whole subtree can't take reaches the siblings of an
ancestor: water-filling from the top, as a node's capacity is the sum of its children's. With the children sorted by
capacity a weight, prefix sums give the level at once, in whole numbers, so there are no rounds and no float ties.

A leaf takes a prefix of its seeded epochs: whole epochs, then the documents of the last one in the order of
md5(seed:epoch:id) whose tokens start below what is left. Prefix sums are taken in two steps, within 4096 ranges of that hash and
over the ranges, so a leaf with a third of all documents is spread over as many tasks. Documents that share an
id and a leaf rank by their tokens; equal ones are taken one by one.

Defined edge results: a null or empty text has no tokens and is never taken; null domain, language or source are a
branch of their own; a null id sorts as an empty one; an absent weight is 1; a branch of weight 0 takes nothing;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch

SEED = 17
MAX_EPOCHS = 4
#: Hex digits of the hash that name a range of documents.
DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"

#: Target weights by level; what isn't named weighs 1. The query's domains are the sources' families.
WEIGHTS: dict[str, dict[str, int]] = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source": {"src0": 2}}


def source_family(families: int = 4) -> Column:
    """The domain of a source: its number modulo ``families``; sources without a number make one more."""
    number = F.regexp_extract(F.coalesce(F.col("source").cast("string"), F.lit("")), "([0-9]+)", 1)
    # digit by digit, so that a number of any length has its own remainder
    rest = F.aggregate(F.regexp_extract_all(number, F.lit("[0-9]"), 0), F.lit(0), lambda a, x: (a * 10 + x.cast("int")) % families)
    return F.when(number == "", F.lit("d")).otherwise(F.concat(F.lit("d"), rest.cast("string")))


def tokens() -> Column:
    """Words of the whole text."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(int(w))).otherwise(out)
    return out.cast("decimal(38,0)")


def _whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def deal(children: DataFrame, parent: list[str], level: str, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """``children`` (parent columns, level, cap, budget of the parent) with ``given``: what each may take.

    Sorted by capacity a weight, a child is filled if the level of water with it and all later ones open
    reaches its capacity: cap * open weight <= (budget - filled so far) * weight. The rest share by weight, rounded
    down; the few tokens that rounding leaves go one each to the first open children by name.
    """
    siblings = Window.partitionBy(*parent)
    # order by cap / weight without division: a level's weights are few, so compare in decimals wide enough to be exact
    rows = children.withColumn("w", _weight(level, weights)).withColumn("c", _whole(F.when(F.col("w") > 0, F.col("cap")).otherwise(0))).withColumn("b", _whole(F.col("budget")))
    rows = rows.withColumn("ratio", F.when(F.col("w") > 0, (F.col("c") / F.col("w")).cast("decimal(38,12)")).otherwise(F.lit(0)))
    ordered = siblings.orderBy("ratio", F.col(level).asc_nulls_first())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("filled_before", _whole(F.coalesce(F.sum("c").over(before), F.lit(0)))).withColumn("open_weight", _whole(F.sum("w").over(siblings)) - _whole(F.coalesce(F.sum("w").over(before), F.lit(0))))
    rows = rows.withColumn("full", (F.col("w") == 0) | (F.col("c") * F.col("open_weight") <= (F.col("b") - F.col("filled_before")) * F.col("w")))
    rows = rows.withColumn("left", F.col("b") - _whole(F.coalesce(F.sum(F.when(F.col("full"), F.col("c"))).over(siblings), F.lit(0)))).withColumn("open", _whole(F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings), F.lit(0))))
    part = F.expr("CASE WHEN full THEN c ELSE CAST((left * w) DIV open AS DECIMAL(38,0)) END")
    rows = rows.withColumn("part", part)
    spare = _whole(F.coalesce(F.sum(F.when(~F.col("full"), F.col("part"))).over(siblings), F.lit(0)))
    rows = rows.withColumn("spare", F.when(F.col("open") > 0, F.col("left") - spare).otherwise(0)).withColumn("nth", F.row_number().over(siblings.orderBy("full", F.col(level).asc_nulls_first())))
    given = F.col("part") + F.when(~F.col("full") & (F.col("nth") <= F.col("spare")), 1).otherwise(0)
    return rows.withColumn("given", given.cast("long")).drop("w", "c", "b", "ratio", "filled_before", "open_weight", "full", "left", "open", "part", "spare", "nth")


LEVELS = ("domain", "lang", "source")


def budgets(leaves: DataFrame, total: Column, weights: Mapping[str, Mapping[str, int]], max_epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, n_tokens) with ``given``, the tokens each is to yield; ``total`` may use supply."""
    current, parent = None, []
    for i, level in enumerate(LEVELS):
        keys = list(LEVELS[: i + 1])
        caps = leaves.groupBy(*keys).agg(F.sum(F.col("n_tokens") * max_epochs).alias("cap"), F.sum("n_tokens").alias("n"))
        if current is None:  # the rows of the first level are the domains
            rows = caps.withColumn("supply", F.sum("n").over(Window.partitionBy())).withColumn("budget", total.cast("long"))
        else:
            up = current.select(*(F.col(k).alias(f"up_{k}") for k in parent), F.col("given").alias("budget"))
            rows = caps.join(up, [F.col(k).eqNullSafe(F.col(f"up_{k}")) for k in parent])
        current = deal(rows.select(*keys, "cap", "budget"), parent, level, weights).select(*keys, "given")
        parent = keys
    return current


def _order(epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(SEED)), epoch, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def select(docs: DataFrame, domain: Column, total: Column | None = None, weights: Mapping[str, Mapping[str, int]] | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, copies, row): how often each row of ``docs`` is taken, if it is.

    ``total`` is the budget in tokens, by default all tokens there are (``supply``).
    """
    weights = WEIGHTS if weights is None else weights
    total = F.col("supply") if total is None else total
    rows = docs.select(F.col("doc_id"), domain.cast("string").alias("domain"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), tokens().alias("n_tokens"), F.xxhash64("text").alias("fp"))
    slim = scratch.table(rows.where("n_tokens > 0"), "mixing")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n_tokens"))
    given = budgets(leaves, total, weights, max_epochs)
    supply = leaves.select(*(F.col(k).alias(f"s_{k}") for k in LEVELS), F.col("n_tokens").alias("has"))
    plan = given.join(supply, [F.col(k).eqNullSafe(F.col(f"s_{k}")) for k in LEVELS])
    plan = scratch.table(plan.select(*LEVELS, F.expr("given DIV has").alias("epochs"), F.expr("given % has").alias("rest")), "budgets")

    leaf = [F.col(f"p_{k}") for k in LEVELS]
    whole = plan.select(*(F.col(k).alias(f"p_{k}") for k in LEVELS), "epochs", "rest")
    placed = slim.join(whole, [F.col(k).eqNullSafe(p) for k, p in zip(LEVELS, leaf)]).withColumn("h", _order(F.col("epochs").cast("string"))).withColumn("range", F.substring("h", 1, DIGITS)).drop("p_domain", "p_lang", "p_source")
    ranges = placed.groupBy(*LEVELS, "range").agg(F.sum("n_tokens").alias("in_range"))
    over = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("start", F.coalesce(F.sum("in_range").over(over), F.lit(0))).select(*(F.col(k).alias(f"r_{k}") for k in LEVELS), F.col("range").alias("r_range"), "start")
    within = Window.partitionBy(*LEVELS, "range").orderBy("h", "n_tokens", "fp").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    taken = summed.join(starts, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in LEVELS] + [F.col("range") == F.col("r_range")])
    copies = F.col("epochs") + F.when(F.col("start") + F.col("ahead") < F.col("rest"), 1).otherwise(0)
    return taken.withColumn("copies", copies.cast("long")).where("copies > 0").select("doc_id", *LEVELS, "n_tokens", "copies", "fp")


def report(docs: DataFrame, **options) -> DataFrame:
    """Documents that are taken, with their leaf, tokens and copies."""
    return select(docs, source_family(), **options).drop("fp")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The taken documents with all their columns and ``copies``, the epochs each is in.

    Rows that share id, source, language and text take part one by one, so their copies are summed over them.
    """
    chosen = select(docs, source_family(), **options).groupBy(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"), F.col("source").alias("__source"), F.col("fp").alias("__fp")).agg(F.sum("copies").alias("copies"))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("lang").cast("string").eqNullSafe(F.col("__lang")) & F.col("source").cast("string").eqNullSafe(F.col("__source")) & (F.xxhash64("text") == F.col("__fp"))
    kept = [c for c in docs.columns if c != "copies"]
    return docs.select(*kept).join(chosen, on).select(*kept, "copies")


def _cases(level: str) -> str:
    return f"CASE {' '.join(f"WHEN {level} = '{n}' THEN {w}" for n, w in WEIGHTS[level].items())} ELSE 1 END::HUGEINT"


def _dealt(name: str, parent: list[str], level: str, children: str) -> str:
    keys = ", ".join(parent) or "1"
    return f"""
{name}_a AS (SELECT *, {_cases(level)} AS w, cap::HUGEINT AS c, budget::HUGEINT AS b FROM ({children})),
{name}_b AS (SELECT *, coalesce(sum(c) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS fb, (sum(w) OVER (PARTITION BY {keys}) - coalesce(sum(w) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT AS ow
  FROM {name}_a WINDOW q AS (PARTITION BY {keys} ORDER BY (c * 1000000000000) // w, {level} NULLS FIRST)),
{name}_c AS (SELECT *, c * ow <= (b - fb) * w AS f FROM {name}_b),
{name}_d AS (SELECT *, (b - coalesce(sum(c) FILTER (f) OVER (PARTITION BY {keys}), 0))::HUGEINT AS l, coalesce(sum(w) FILTER (NOT f) OVER (PARTITION BY {keys}), 0)::HUGEINT AS o FROM {name}_c),
{name}_e AS (SELECT *, CASE WHEN f THEN c ELSE (l * w) // o END AS p FROM {name}_d),
{name}_f AS (SELECT *, CASE WHEN o > 0 THEN l - coalesce(sum(p) FILTER (NOT f) OVER (PARTITION BY {keys}), 0) ELSE 0 END AS s, row_number() OVER (PARTITION BY {keys} ORDER BY f, {level} NULLS FIRST) AS nth FROM {name}_e),
{name} AS (SELECT {", ".join([*parent, level])}, (p + CASE WHEN NOT f AND nth <= s THEN 1 ELSE 0 END)::BIGINT AS given FROM {name}_f)"""


def _same(a: str, b: str, keys) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


ORACLE = rf"""
WITH slim AS (SELECT * FROM (SELECT doc_id, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)', 1) = '' THEN 'd' ELSE 'd' || list_reduce(list_prepend(0, list_transform(regexp_extract_all(regexp_extract(source, '([0-9]+)', 1), '[0-9]'), lambda x: x::INT)), lambda a, x: (a * 10 + x) % 4) END AS domain, lang, source,
  len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_tokens, text FROM documents) WHERE n_tokens > 0),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS n_tokens FROM slim GROUP BY ALL),
{_dealt("d", [], "domain", "SELECT domain, sum(n_tokens) * 4 AS cap, (SELECT sum(n_tokens) FROM leaves) AS budget FROM leaves GROUP BY domain").lstrip()},
{_dealt("g", ["domain"], "lang", f"SELECT c.domain, c.lang, c.cap, d.given AS budget FROM (SELECT domain, lang, sum(n_tokens) * 4 AS cap FROM leaves GROUP BY ALL) c JOIN d ON {_same('c', 'd', LEVELS[:1])}").lstrip()},
{_dealt("x", ["domain", "lang"], "source", f"SELECT c.domain, c.lang, c.source, c.n_tokens * 4 AS cap, g.given AS budget FROM leaves c JOIN g ON {_same('c', 'g', LEVELS[:2])}").lstrip()},
placed AS (SELECT s.*, x.given // v.n_tokens AS epochs, x.given % v.n_tokens AS rest FROM slim s JOIN x ON {_same('s', 'x', LEVELS)} JOIN leaves v ON {_same('s', 'v', LEVELS)}),
summed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{SEED}:' || epochs || ':' || coalesce(doc_id::VARCHAR, '')), n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, copies FROM (SELECT *, (epochs + CASE WHEN ahead < rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM summed) WHERE copies > 0
"""
