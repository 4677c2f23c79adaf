import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from oracle import same

from placeloom.llm import recompress as r


def case(seed=7):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "ha", "ha", "ha"]
    text = lambda n: [rnd.choice(words) for _ in range(n)]
    passages = [text(n) for n in (12, 13, 14, 50, 200)] + [["ha"] * 30, ["a", "b"] * 20, ["ha"] * 14]
    docs = [(None, None), (1, ""), (2, "a b c"), (None, " ".join(passages[3])), (3, " ".join(passages[4])), (3, " ".join(passages[4]))]
    for i in range(10, 90):
        parts = [text(rnd.randrange(25))]
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            a, b = sorted((rnd.randrange(len(p) + 1), rnd.randrange(len(p) + 1))) if rnd.random() < 0.4 else (0, len(p))
            parts += [p[a:b], text(rnd.randrange(20))]
        docs.append((rnd.randrange(1000), rnd.choice([" ", "\n", "\t "]).join(w for p in parts for w in p)))
    return docs


@pytest.mark.parametrize("rounds", [0, 3])
def test_matches_sql(spark, rounds):
    df = spark.createDataFrame([(*d, 3, "x") for d in case()], "doc_id long, text string, block int, word string")
    got = r.dedup(df, rounds=rounds, texts=False)
    assert got.where("n_removed > 0").count() > 30
    same(got, r.ORACLE, documents=df.drop("block", "word"))


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert r.dedup(empty).count() == 0
    got = {x.doc_id: x for x in r.dedup(spark.createDataFrame([(2, "x y " + "t " * 20_000), (1, "t " * 15)], "doc_id long, text string")).collect()}
    assert got[2].text == "x y" and got[2].n_removed == 20_000 and got[1].n_removed == 0


def test_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(r.dedup(df, texts=False), r.ORACLE, documents=df)


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(1)
    words = [[rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randrange(400))] for _ in range(40)]
    shared = [rnd.choice([b"a", b"b", b"c", b"d", b"e", b"f"]) for _ in range(60)]
    words = [w[: len(w) // 2] + shared[rnd.randrange(30) :] + w[len(w) // 2 :] for w in words]
    seen, symbols = {}, {}
    count = 0
    for p in r.pieces(r.hashed([b" ".join(w) for w in words]), 13, 100):
        at = r.windows(p)
        made = r.parse(p, at, spans=(20,))
        for a, d, i in zip(made.anchors.tolist(), p.doc[at].tolist(), p.word[at].tolist()):
            count += 1
            assert seen.setdefault(tuple(words[d][i : i + 13]), a) == a
        for name, h, a, b in zip(made.name.tolist(), r.expansion(p, made.start, made.end).tolist(), made.start.tolist(), made.end.tolist()):
            d, i = int(p.doc[a]), int(p.word[a])
            stands_for = tuple(words[d][i : i + b - a])
            assert len(stands_for) >= 20 and symbols.setdefault((name, h), stands_for) == stands_for
    assert count == sum(max(0, len(w) - 12) for w in words) and len(seen) < count and symbols
    assert len(np.unique(list(seen.values()))) < len(seen)


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    rnd = random.Random(2)
    vocabulary = [b"a", b"b", b"ab", "É".encode(), b"x" * 64, b"x" * 65, b"y" * 3000, b"\x00", b"a\x1cb"]
    texts = [b"", b" \n", b"a"] + [rnd.choice([b" ", b"\n", b"\t\x0b", b"  "]).join(rnd.choice(vocabulary) for _ in range(rnd.randrange(60))) for _ in range(40)]
    monkeypatch.setattr(r, "BYTES", 500)
    got = r.hashed(texts)
    flat = [w for t in texts for w in t.split()]
    assert got.counts.tolist() == [len(t.split()) for t in texts] and len(got.one) == len(flat)
    by = {}
    for w, pair in zip(flat, zip(got.one.tolist(), got.two.tolist())):
        assert by.setdefault(w, pair) == pair
    assert len(set(by.values())) == len(by) == len({x for x, _ in by.values()}) == len({x for _, x in by.values()})


def sent(blocks, rounds=r.ROUNDS, spans=r.SPANS, shards=4):
    """Windows that the blocks, lists of (doc_id, text), ask about in the second step."""
    parts = [pa.table({"doc_id": pa.array([d for d, _ in b], pa.int64()), "text": [t for _, t in b], "block": pa.array([i] * len(b), pa.int32())}) for i, b in enumerate(blocks)]
    asked = pa.concat_tables([r.ask_anchors(p, 13, rounds, spans, shards) for p in parts])
    told = pa.concat_tables([r.answer_anchors(asked.filter(pc.equal(asked["shard"], s))) for s in range(shards)])
    found = [r.ask_windows(p, told.filter(pc.equal(told["block"], i)), 13, rounds, spans, shards) for i, p in enumerate(parts)]
    return [sum(len(r.unpack(x, "<u8")) for x in t.column("one").to_pylist()) for t in found]


def test_long_symbols_carry_the_repeats(monkeypatch):
    """Later copies of a long passage are known by symbol: few of its windows are asked about. Without long symbols, or without rounds to make them, all are."""
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(5000)}"
    passage = [word() for _ in range(3000)]
    blocks = [[(i, " ".join([word() for _ in range(40)] + passage + [word() for _ in range(40)]))] for i in range(6)]
    first, *later = sent(blocks)
    assert first >= 2988 and all(x < 1500 for x in later)
    assert all(x >= 2988 for x in sent(blocks, spans=()))
    monkeypatch.setattr(r, "LONG_ROUNDS", 0)
    assert all(x >= 2988 for x in sent(blocks, rounds=0))


@pytest.mark.parametrize("radix", [2, 3])
def test_relays_change_nothing(spark, monkeypatch, radix):
    df = spark.createDataFrame([(*d, 3, "x") for d in case()], "doc_id long, text string, block int, word string")
    monkeypatch.setattr(r.exchange, "RADIX", radix)
    monkeypatch.setattr(r.exchange, "COHORT", 3)
    monkeypatch.setattr(r.exchange, "shards", lambda n: radix * radix)
    same(r.dedup(df, texts=False, block_bytes=1500), r.ORACLE, documents=df.drop("block", "word"))


def test_a_document_of_several_pieces(spark, monkeypatch):
    rnd = random.Random(6)
    words = [f"w{rnd.randrange(300)}" for _ in range(700_000)]
    docs = [(2, " ".join(words)), (1, " ".join(words[262_100:262_200] + ["zz"] + words[524_000:600_000])), (3, "q " + " ".join(words[5:40]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: x.n_removed for x in r.dedup(df, texts=False).collect()}
    assert got == {1: 0, 2: 100 + 76_000, 3: 35}


def test_hot_rows_spread_over_blocks(spark):
    df = spark.createDataFrame([(None, f"text {i}") for i in range(600)] + [(7, f"other {i}") for i in range(600)] + [(8, "alike") for _ in range(600)], "doc_id long, text string")
    counts = {x.block: x["count"] for x in r.blocks.deal(df, "spread", 2000).groupBy("block").count().collect()}
    assert len(counts) >= 8 and max(counts.values()) < 3 * 1800 / len(counts)
