import random
from collections import defaultdict
from fractions import Fraction

from oracle import same
from pyspark.sql import functions as F

from placeloom.llm import mixing as m


def case(spark, seed=3, n=200):
    r = random.Random(seed)
    docs = [(None, "a b c", None, None, 9), (1, None, "en", "src0", 9), (2, "", "en", "src1", 9), (3, "x", "en", "web", 9), (4, "tok " * 4000, "es", "src3", 9)]
    docs += [(i, "w " * r.randrange(1, 80), r.choice(["en", "en", "en", "de", "fr", "es", None]), f"src{min(r.randrange(40), 9) % 6}", 9) for i in range(10, n)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, range long")


def test_matches_sql(spark):
    df = case(spark)
    got = m.report(df)
    assert got.count() > 100
    same(got, m.ORACLE, documents=df.drop("range"))
    same(m.report(df.limit(0)), m.ORACLE, documents=df.limit(0).drop("range"))


def fill(budget, caps, weights):
    """Round after round: deal what is left to the open ones by weight."""
    got, open_ = {k: Fraction(0) for k in caps}, {k for k in caps if weights[k] and caps[k]}
    left = Fraction(budget)
    while left and open_:
        total = sum(weights[k] for k in open_)
        share, left_after = {k: left * weights[k] / total for k in open_}, Fraction(0)
        for k, v in share.items():
            take = min(v, caps[k] - got[k])
            got[k] += take
            left_after += v - take
        open_ = {k for k in open_ if got[k] < caps[k]}
        left = left_after
    return got


def test_budgets_match_repeated_dealing(spark):
    r = random.Random(8)
    leaves = {(f"d{a}", f"l{b}", f"s{c}"): r.choice([1, 5, 50, 900]) for a in range(3) for b in range(3) for c in range(4)}
    weights = {"domain": {"d0": 7, "d2": 0}, "lang": {"l1": 3}, "source": {"s2": 5}}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, n_tokens long")
    for total in (0, 10, 1500, 6000, 10**7):
        got = {(x.domain, x.lang, x.source): x.given for x in m.budgets(df, F.lit(total), weights, 2).collect()}
        caps = {k: 2 * v for k, v in leaves.items()}
        budget = {(): Fraction(total)}
        for depth, level in enumerate(m.LEVELS):
            following = {}
            for parent, b in budget.items():
                sub = defaultdict(int)
                for k, v in caps.items():
                    if k[:depth] == parent:
                        sub[k[: depth + 1]] += v
                # a subtree that may take nothing has no capacity
                following |= fill(b, sub, {k: weights[level].get(k[-1], 1) for k in sub})
            budget = following
        for k, v in budget.items():
            assert abs(got[k] - v) <= 3, (total, k, got[k], float(v))
        assert abs(sum(got.values()) - min(total, sum(v for k, v in caps.items() if k[0] != "d2"))) <= 0


def test_prefixes_and_columns(spark):
    df = case(spark)
    out = m.mixed(df, total=F.lit(500))
    assert out.columns == [*df.columns, "copies"]
    rows = out.collect()
    assert 0 < sum(x.copies * len(x.text.split()) for x in rows) < 500 + 30 * 80
    everything = m.mixed(df, total=F.col("supply") * 100)
    assert {x.copies for x in everything.collect()} == {m.MAX_EPOCHS}


def test_families_of_long_numbers(spark):
    names = ["src10001", "src7", "web", None, "a" + "9" * 60, "x0012"]
    got = [r.d for r in spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, source string").select("i", m.source_family(3).alias("d")).orderBy("i").collect()]
    assert got == [f"d{int(x) % 3}" if x else "d" for x in ("10001", "7", "", "", "9" * 60, "0012")]
