import zlib

import numpy as np
import pytest

from placeloom.llm import quality as q

DOCS = "/root/testdata/sf0.01"


def test_trees_learn_and_flat_arrays_agree_with_a_plain_walk():
    r = np.random.default_rng(3)
    x = r.random((3000, len(q.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.3)).astype(float)
    forest = q.fit(x[:2000], y[:2000])
    got = forest.predict(x)
    assert ((got[2000:] > 0.5) == y[2000:]).mean() > 0.95
    for i in range(5):
        raw = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] if x[i, forest.feature[node]] <= forest.limit[node] else forest.right[node]
            raw += forest.value[node]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_one_class_or_nothing():
    x = np.zeros((4, len(q.FEATURES)))
    assert q.fit(x[:0], np.zeros(0)).predict(x) == pytest.approx(np.full(4, 0.5))
    assert (q.fit(x, np.ones(4)).predict(x) > 0.9).all()


def test_held_out_accuracy_and_contract(spark):
    docs, labels = (spark.read.parquet(f"{DOCS}/{t}.parquet") for t in ("documents", "labels"))
    got = q.score(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    for i, row in rows.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7)
    held = [(rows[i].predicted, y) for i, y in truth.items() if rows[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95
    kept = q.keep(docs, labels)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in rows.items() if r.predicted}


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5, "a"), (None, "a b", 0.5, "a"), (2, "", 1.0, "b"), (2, "", 1.0, "b"), (3, "word " * 200_000, 0.1, "c")], "doc_id long, text string, score double, x string")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, quality int")
    assert q.score(docs, labels).count() == 5
    none = spark.createDataFrame([], labels.schema)
    assert {r.score for r in q.score(docs, none).collect()} == {0.5}
    assert q.score(docs.limit(0), labels).count() == 0
    assert q.keep(docs, none).count() == 0
