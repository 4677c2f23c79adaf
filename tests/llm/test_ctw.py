import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from placeloom.llm import ctw


def plain(docs, depth):
    """Counts in dictionaries, weights by recursion, one decision at a time."""
    low = lambda t: (t or "").encode().translate(ctw._LOWER)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    nodes = [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]

    def steps(text):
        data = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(data)):
            for k in range(8):
                node, bit = (1 << k) | data[i] >> (8 - k), data[i] >> (7 - k) & 1
                yield [(data[i - d : i], node) for d in range(depth + 1)], bit

    train = [low(t) for d, t in docs if not held(d)]
    for t in train:
        for at, bit in steps(t):
            for d in range(depth + 1):
                nodes[d][at[d]][bit] += 1
    lkt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    pw, share = [{} for _ in nodes], [{} for _ in nodes]
    for d in range(depth, -1, -1):
        below = defaultdict(float)
        if d < depth:
            for (c, n), v in pw[d + 1].items():
                below[c[1:], n] += v
        for at, (a, b) in nodes[d].items():
            kt = lkt(a, b)
            pw[d][at] = kt if d == depth else np.logaddexp(kt, below[at]) - math.log(2)
            share[d][at] = 1.0 if d == depth else math.exp(kt - np.logaddexp(kt, below[at]))
    out = []
    c = Counter(w for t in train for w in t.split())
    n, v, ends = sum(c.values()) + len(train), len(c) + bool(train), len(train)
    for doc_id, text in docs:
        total = 0.0
        for at, bit in steps(low(text)):
            p, rest = 0.5, 1.0
            mixed = 0.0
            for d in range(depth + 1):
                if at[d] not in nodes[d]:
                    break
                a, b = nodes[d][at[d]]
                own = (b + 0.5) / (a + b + 1)
                p = mixed + rest * own
                mixed += rest * share[d][at[d]] * own
                rest *= 1 - share[d][at[d]]
            total += math.log10(p if bit else 1 - p)
        counts = [c[w] for w in low(text).split()] + [ends]
        base = sum(math.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in counts)
        out.append((doc_id, held(doc_id), len(counts), sum(x > 0 for x in counts), n, base, total))
    return out


def check(spark, docs, **options):
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, block int, word string")
    got = sorted((tuple(r)[:-1] for r in ctw.score(df, **options).collect()), key=str)
    want = sorted(plain(docs, options.get("depth", ctw.DEPTH)), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_matches_a_plain_tree(spark):
    r = random.Random(9)
    words = ["the", "There", "Üb", "na", "banana", "x" * 30, "tion"]
    docs = [(None, None), (1, ""), (7, " \n"), (7, " \n")] + [(i, " ".join(r.choice(words[: 4 + i % 4]) for _ in range(r.randrange(40)))) for i in range(10, 60)] + [(10**9 + 4, "qqq unseen " * 3)]
    check(spark, docs)
    check(spark, docs[:20], depth=1)


def test_only_held_out(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    check(spark, [(i, "a b") for i in ids], depth=2)
    assert ctw.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_very_long_text(spark):
    r = random.Random(3)
    docs = [(1, " ".join(r.choice(["a", "bc", "É", "long"]) for _ in range(100_000))), (2, "a bc"), (None, None)]
    assert len(docs[0][1].encode()) > ctw.CHUNK
    check(spark, docs, depth=1)


@pytest.mark.parametrize("depth", [ctw.DEPTH, 6])
def test_beats_the_base_on_held_out_texts(spark, depth):
    got = ctw.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), depth=depth).where("held_out").collect()
    assert len(got) > 50 and sum(r.score for r in got) > sum(r.base_score for r in got)
    assert np.median([r.bits_per_byte for r in got]) < 3.5


def test_lookup():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 60, 5000).astype(np.uint64))
    ask = np.random.default_rng(1).permutation(np.repeat(keys, 3))
    assert (ctw.Lookup(keys, keys.astype(float))(ask) == ask.astype(float)).all() and len(ctw.Lookup(keys[:0], np.zeros(0))(keys[:0])) == 0


@pytest.mark.parametrize("radix", [2, 3])
def test_relays_change_nothing(spark, monkeypatch, radix):
    r = random.Random(4)
    docs = [(None, None), (1, ""), (2, "a a")] + [(i, " ".join(r.choice(["the", "There", "Üb", "banana", "x" * 70, f"w{i}"]) for _ in range(r.randrange(30)))) for i in range(10, 60)]
    monkeypatch.setattr(ctw.exchange, "RADIX", radix)
    monkeypatch.setattr(ctw.exchange, "COHORT", 3)
    monkeypatch.setattr(ctw.exchange, "shards", lambda n: radix * radix)
    check(spark, docs, block_bytes=300)


def test_relays_hold_as_much_whatever_the_corpus(monkeypatch):
    for blocks in (3000, 100_000, 2_000_000):
        n = ctw.exchange.shards(blocks)
        groups = n // ctw.exchange.RADIX
        assert ctw.exchange.cohort(n) / groups <= ctw.exchange.RELAY and -(-blocks // ctw.exchange.cohort(n)) * n <= 2 * blocks * ctw.exchange.RADIX // ctw.exchange.RELAY


def test_words_that_share_one_hash():
    one, two = np.array([5, 3, 5, 3, 5], np.uint64), np.array([1, 1, 2, 1, 1], np.uint64)
    first, which = ctw._same(one, two)
    assert [(int(one[i]), int(two[i])) for i in first] == [(3, 1), (5, 1), (5, 2)] and which.tolist() == [1, 0, 2, 0, 1]
    assert ctw._same(one[:0], two[:0])[0].tolist() == []
