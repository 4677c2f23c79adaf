import random

import numpy as np
import xxhash

from placeloom.llm import simhash as s


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w.decode() for w in words.encode().split()]
    if not words:
        return 0
    k = min(3, len(words))
    hs = [xxhash.xxh64(" ".join(words[i : i + k]).encode(), seed=42).intdigest() for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(ids_prints):
    n = len(ids_prints)
    comp = list(range(n))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(ids_prints[i][1] ^ ids_prints[j][1]).count("1") <= 3:
                comp[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(ids_prints):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return [least[find(i)] for i in range(n)]


def case(seed=5):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Éa", "THE"]
    docs = [(None, None), (1, ""), (2, "one"), (3, "one two"), (3, "one two"), (4, " \n")]
    for i in range(10, 40):
        base = [r.choice(words) for _ in range(r.randrange(3, 400))]
        docs.append((i, " ".join(base)))
        for c in range(r.randrange(6)):
            copy = list(base)
            for _ in range(c // 2):
                copy[r.randrange(len(copy))] = r.choice(words)
            docs.append((i * 100 + c, "\n".join(copy)))
    return docs


def test_matches_brute_force(spark):
    docs = case()
    df = spark.createDataFrame([(*d, 7, "x") for d in docs], "doc_id long, text string, fp long, task string")
    prints = [(d, plain_fingerprint(t)) for d, t in docs]
    want = sorted(((d, f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints))), key=str)
    for chunk in (s.CHUNK, 2):
        got = sorted(map(tuple, s.report(df, chunk=chunk).collect()), key=str)
        assert got == want
    kept = s.keep_first(df)
    assert kept.schema == df.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _, c in want if d is None or d == c)
    assert s.report(df.limit(0)).count() == 0


def test_bit_sliced_distances(monkeypatch):
    r = np.random.default_rng(1)
    rows = r.integers(0, 1 << 63, 300, dtype=np.int64).view(np.uint64)
    for i in range(100, 300):
        flip = r.choice(64, r.integers(0, 6), replace=False)
        rows[i] = rows[r.integers(0, i)] ^ np.bitwise_or.reduce(np.uint64(1) << flip.astype(np.uint64), initial=np.uint64(0))
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if bin(int(rows[i] ^ rows[j])).count("1") <= 3}
    for batch in (1 << 18, 7):
        monkeypatch.setattr(s, "BATCH", batch)
        got = {(int(a), int(b)) for x, y in s.near(rows, np.full(300, 300)) for a, b in zip(x, y)}
        assert got == want


def test_components_of_long_chains(spark):
    r = random.Random(6)
    ids = r.sample(range(-1000, 1000), 300)
    edges = [(a, b) for a, b in zip(ids[:150], ids[1:150])] + [(ids[150], x) for x in ids[151:250]] + [(ids[260], ids[260])]
    got = {x.node: x.root for x in s.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == min(ids[:150]) for x in ids[:150]) and all(got.get(x, x) == min(ids[150:250]) for x in ids[150:250])
    assert len(got) == 148 + 1 + 99


def test_any_number_of_bands_links_the_same(spark):
    r = random.Random(8)
    prints = [r.getrandbits(64) for _ in range(60)]
    for _ in range(140):
        x = r.choice(prints)
        for b in r.sample(range(64), r.randrange(5)):
            x ^= 1 << b
        prints.append(x)
    prints = sorted({x - (1 << 64) if x >> 63 else x for x in prints})
    want = plain_components([(p, p & (1 << 64) - 1) for p in prints])
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for m, chunk in ((4, 1024), (5, 2), (6, 1024), (6, 2)):
        root = {x.node: x.root for x in s.components(s.links(df, chunk=chunk, m=m)).collect()}
        assert [root.get(p, p) for p in prints] == want
    assert [s.bands(n) for n in (10, 1 << 26, (1 << 26) + 1, 1 << 35, (1 << 35) + 1, 10**13)] == [4, 4, 5, 5, 6, 6]


def test_a_very_long_text(spark):
    text = "one two three four five six seven " * 300_000
    got = s.report(spark.createDataFrame([(2, text), (1, text.upper() + " eight"), (3, "else")], "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.component_id) for x in got) == [(1, 1), (2, 1), (3, 3)] and {x.fingerprint for x in got if x.doc_id == 2} == {f"{plain_fingerprint(text):016x}"}
