import random
from collections import Counter

import duckdb
import xxhash
from oracle import same

from placeloom.llm import linefreq as f


def case(seed=2):
    r = random.Random(seed)
    boiler = ["All rights reserved 2024 by us", "Click  HERE to subscribe now please"]
    docs = [(None, None, "a"), (1, "", None), (2, " \n\n ", "a"), (3, "one\ntwo\none\n one", "a"), (4, "é ü # | " * 30, "b")]
    for i in range(10, 260):
        lines = [" ".join(r.choice("ab cd ef gh ij kl".split()) + str(r.randrange(50)) for _ in range(r.randrange(1, 25))) for _ in range(r.randrange(4))]
        if i % 2:
            lines.insert(r.randrange(len(lines) + 1), boiler[i % 4 // 2].replace("2024", str(i)))
        docs.append((i, "\n".join(lines), r.choice(["a", "a", "a", "b", None])))
    docs += [(300 + i, "copy of the very same text with ten words or more", "a") for i in range(150)]
    docs += [docs[-1], (999, "tick tock " * 60_000, "b")]
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, line int, fp string")


def test_matches_sql(spark):
    df = frame(spark, case()[:-1])
    sql = f.ORACLE.replace("> 100)", "> 20)")
    got = f.report(df, max_docs=20)
    assert got.where("n_removed_words > 0").count() > 50 and got.where("base_failed").count() > 5 and got.where("NOT base_failed AND NOT kept").count() > 0
    assert got.where("doc_id BETWEEN 300 AND 449").select("kept").distinct().collect()[0].kept
    same(got, sql, documents=df.drop("line", "fp"))
    same(f.report(df.limit(0)), f.ORACLE, documents=df.limit(0).drop("line", "fp"))


def test_matches_sql_on_the_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(f.report(df), f.ORACLE, documents=df)


def test_repeats_two_ways(monkeypatch):
    r = random.Random(4)
    for n in (0, 4, 5, 6, 40, 300):
        words = [str(r.randrange(3)).encode() for _ in range(n)]
        wins = [tuple(words[i : i + 5]) for i in range(n - 4)]
        count = Counter(wins)
        want = len({j for i, w in enumerate(wins) if count[w] > 1 for j in range(i, i + 5)})
        monkeypatch.setattr(f, "_MANY", 1 << 30)
        assert f.repeated_words(words) == want
        monkeypatch.setattr(f, "_MANY", 0)
        assert f.repeated_words(words) == want


def normal(line):
    return "".join("0" if c in "123456789" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(x.decode() for x in line.encode().split()))


def test_clean_removes_the_lines(spark):
    """Every kept text is its own lines without the frequent ones of its host, which are counted here one by one."""
    docs = case()
    df = frame(spark, docs)
    kept = {r.doc_id for r in f.report(df, max_docs=20).where("kept").collect()}
    texts = {}
    for _, text, host in docs:
        for line in (text or "").split("\n"):
            if line.split():
                texts.setdefault((host, normal(line)), set()).add(text)
    common = {k for k, x in texts.items() if len(x) > 20}
    want = sorted((d, "\n".join(x for x in t.split("\n") if (h, normal(x)) not in common)) for d, t, h in docs if d in kept)
    got = sorted((r.doc_id, r.text) for r in f.clean(df, max_docs=20).collect())
    assert got == want
    # on host a either line is in many documents; a footer whose number has two digits is another line, and rare
    host = {d: h for d, _, h in docs}
    assert {h for h, _ in common} == {"a"} and any("click here" in x for _, x in common) and any("rights reserved 000" in x for _, x in common)
    assert not any("subscribe" in t or "reserved 1" in t for d, t in got if host[d] == "a" and d >= 100)
    assert any("rights reserved" in t for d, t in got if host[d] != "a") and any("reserved" in t for d, t in got if host[d] == "a" and d < 100)


def test_clean_against_the_sql_s_frequent_lines(spark):
    df = frame(spark, case()[:-1])
    con = duckdb.connect()
    con.register("documents", df.drop("line", "fp").toArrow())
    freq = f.ORACLE[: f.ORACLE.index("rem AS")].strip().rstrip(",").replace("> 100)", "> 20)")
    want = {(h, x) for h, x in con.execute(f"{freq} SELECT source, norm FROM freq").fetchall()}
    hashed = {(h, xxhash.xxh64_intdigest(x.encode()) - (1 << 63)) for h, x in want}
    assert want and {(r.host, r.line) for r in f.frequent(f.scan(df), 20).collect()} == hashed
