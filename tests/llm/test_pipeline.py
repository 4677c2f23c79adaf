from test_decontaminate import brute as contaminated
from test_secrets import brute as secret_rows
from test_simhash import plain_components, plain_fingerprint

from pyspark.sql import functions as F

import corpus_pipeline
from placeloom.llm import mixing, quality

DIR = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    secret = F.concat("text", F.lit(' token = "'), F.sha1(F.col("doc_id").cast("string")), F.lit('"'))
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 7 == 0, secret).otherwise(F.col("text"))).withColumn("n_chars", F.length("text").cast("long"))
    columns, labels = docs.columns, spark.read.parquet(f"{DIR}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dups", "decontaminate", "secrets", "mix"]
    tables = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], DIR).write.parquet(str(tmp_path / str(i)))
        tables.append(spark.read.parquet(str(tmp_path / str(i))))
        assert tables[-1].columns == columns + ["copies"] * (i == 4)
    rows = [t.collect() for t in tables]

    good = {r.doc_id for r in quality.score(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in rows[1]} == good and 0 < len(good) < len(rows[0])
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in rows[1]]
    assert sorted(r.doc_id for r in rows[2]) == sorted(set(plain_components(prints)))
    bad = {x[0] for x in contaminated([(r.doc_id, r.text) for r in rows[2]], items) if x[-1]}
    assert bad and {r.doc_id for r in rows[3]} == {r.doc_id for r in rows[2]} - bad
    assert [r.doc_id for r in sorted(rows[4])] == [r.doc_id for r in sorted(rows[3])]
    before = {r.doc_id: r for r in rows[3]}
    live = {x[0]: x[7] for x in secret_rows([(r.doc_id, r.text, r.source) for r in rows[3]])}
    for r in rows[4]:
        assert (r.text != before[r.doc_id].text) == (live[r.doc_id] > 0) and r.n_chars == len(r.text)
    assert any(live.values())
    taken = mixing.report(tables[4]).collect()
    assert sorted((r.doc_id, r.copies) for r in taken) == sorted((r.doc_id, r.copies) for r in rows[5])


def test_run(spark):
    out = corpus_pipeline.run(spark, DIR)
    assert out.columns[-1] == "copies" and out.count() > 50


def hard_rows(spark):
    """The small table with null, empty, repeated and very long rows, and columns named as operators name their own."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = [(None, None, None, None, None), (None, "", "en", "src1", 0), (10**9, None, "en", None, None), (10**9 + 1, " \n", None, "src2", 2)]
    rows += [(10**9 + 2, "same text of a row that stands here twice", "en", "src1", 41)] * 2 + [(10**9 + 3, "long words in a row " * 100_000, "de", "src3", 2_000_000)]
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(*docs.columns))
    names = ["score", "predicted", "fp", "component_id", "root", "contaminated", "starts", "hash", "cuts", "copies", "leaf", "domain", "weight", "block"]
    return docs.select("*", *(F.lit(i).alias(name) for i, name in enumerate(names)))


def test_stages_with_hard_rows_and_clashing_columns(spark, tmp_path):
    docs = hard_rows(spark)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DIR)
        assert [c for c in docs.columns if c != "copies"] == [c for c in out.columns if c != "copies"]
        out.write.parquet(str(tmp_path / str(i)))
        got = spark.read.parquet(str(tmp_path / str(i))).select("doc_id", "text", "fp", "block").collect()
        assert got and all((r.fp, r.block) == (2, 13) for r in got)
        ids = [r.doc_id for r in got]
        if name in ("decontaminate", "secrets"):  # nothing in these rows is either's business
            assert ids.count(None) == 2 and ids.count(10**9 + 2) == 2 and {10**9, 10**9 + 1, 10**9 + 3} <= set(ids)
        if name == "near_dups":
            assert ids.count(None) == 2 and 10**9 + 3 in ids


def test_stages_of_empty_tables(spark, tmp_path):
    docs = hard_rows(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DIR).count() == 0
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{DIR}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
