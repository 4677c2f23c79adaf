import gzip

import pytest
from oracle import same

from placeloom.llm import warc

PAGES = [
    (None, None, None), (1, "http://a/", ""), (2, "http://b/?q=é", "plain & simple"),
    (3, "http://c/", "<html><head><title>T &amp; t</title><style>p{x:1}</style></head><body><!-- no --><p>One<br/>two  <b>three</b>&nbsp;x</p>\n<SCRIPT a='1'>var t='</p>';</SCRIPT><div>&lt;kept&gt; &amp;lt; 3 < 4</div></body></html>"),
    (3, "http://c/", "<p>a</p>"), (5, "http://e/", "&#65;&#x42;&#X43; &copy;&mdash;&eacute; &#128512;&#x1F600; &amp;#65; &amp;amp; &nosuch; &#xD800; &#9; &#1114112; &#; & &lt &;x&&lt;"), (6, None, None), (4, "http://d/", "<div>word " * 20_000),
]


def pages(spark):
    return spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, block string, r int")


def test_matches_sql(spark):
    df = pages(spark)
    got = warc.derive(warc.responses(df))
    assert tuple(got.columns) == warc.RECORD
    same(got, warc.ORACLE, pages=df.drop("block", "r"))
    text = {r.target_uri: r.block for r in got.where("warc_type = 'conversion' AND page_id = 3").collect() if "One" in r.block}["http://c/"]
    assert text == "T & t\nOne\ntwo three x\n<kept> &lt; 3 < 4"
    assert [r.block for r in got.where("warc_type = 'conversion' AND page_id = 5").collect()] == ["ABC ©—é 😀😀 &#65; &amp; &nosuch; &#xD800; &#9; &#1114112; &#; & &lt &;x&<"]
    same(warc.derive(warc.responses(df.limit(0))), warc.ORACLE, pages=df.limit(0).drop("block", "r"))


def test_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    same(warc.derive(warc.responses(df)), warc.ORACLE, pages=df)


def test_files_round_trip(spark, tmp_path):
    records = warc.derive(warc.responses(pages(spark)))
    warc.write(records, str(tmp_path / "out"))
    back = sorted((r.warc_type, r.record_id, r.refers_to, r.header, bytes(r.block).decode()) for r in warc.read(spark, str(tmp_path / "out")).collect())
    assert back == sorted((r.warc_type, r.record_id, r.refers_to, r.header, r.block) for r in records.collect())
    conversion = {r[1] for r in back if r[0] == "conversion"}
    assert all(r[4].split("\r\n")[0].removeprefix("conversion: ") in conversion for r in back if r[0] == "metadata")


BLOCK = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>hi</p>\n\n\xff end"


def record(i, block=BLOCK, more=b""):
    return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:%d>\r\nWARC-Target-URI: http://q/\r\nWARC-Date: 2020-02-02T00:00:00Z\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, more, len(block), block)


def test_reads_responses(spark, tmp_path):
    digests = b"WARC-Payload-Digest: sha1:ABC\r\nWARC-Block-Digest: sha1:DEF\r\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(record(1, more=digests)) + gzip.compress(record(2)))
    (tmp_path / "in" / "b.warc").write_bytes(record(3, b"") + record(4))
    rows = warc.read(spark, str(tmp_path / "in"))
    assert sorted((r.record_id, bytes(r.block), r.truncated) for r in rows.collect()) == [(f"<urn:uuid:{i}>", b"" if i == 3 else BLOCK, False) for i in range(1, 5)]
    got = warc.derive(warc.from_warc(rows)).collect()
    assert len(got) == 8 and len({r.record_id for r in got}) == 8 and {r.refers_to for r in got} == {f"<urn:uuid:{i}>" for i in range(1, 5)}
    assert all(f"WARC-Refers-To: {r.refers_to}\r\n" in r.header for r in got)
    assert {r.block for r in got if r.warc_type == "conversion"} == {"hi\n\ufffd end", ""}
    first = {r.warc_type: r for r in got if r.refers_to == "<urn:uuid:1>"}
    assert first["conversion"].payload_digest == first["metadata"].payload_digest == "sha1:ABC"
    assert "sourcePayloadDigest: sha1:ABC\r\nsourceBlockDigest: sha1:DEF\r\n" in first["metadata"].block and "Server: x" in first["metadata"].block and first["metadata"].warc_date.startswith("2020")
    assert all(r.payload_digest.startswith("sha256:") for r in got if r.refers_to != "<urn:uuid:1>")


def test_reads_truncated_files(spark, tmp_path):
    whole = record(1) + record(2)
    (tmp_path / "in").mkdir()
    ends = {"a": whole.index(b"<urn:uuid:2>"), "b": whole.rindex(b"<p>") + 5, "c": len(whole) - 4, "d": len(whole) - 5, "e": 3, "f": 0, "g": whole.rindex(b"\r\n\r\nHTTP") if b"\r\n\r\nHTTP" in whole else 0, "h": whole.rindex(b"HTTP/1.1")}
    for name, n in ends.items():
        (tmp_path / "in" / f"{name}.warc").write_bytes(whole[:n])
    got = {}
    for name in ends:
        got[name] = [(r.record_id[-2], bytes(r.block), r.truncated) for r in warc.read(spark, str(tmp_path / "in" / f"{name}.warc")).collect()]
    one = ("1", BLOCK, False)
    assert got["a"] == [one] and got["e"] == got["f"] == [] and got["c"] == [one, ("2", BLOCK, False)] and got["d"] == [one, ("2", BLOCK[:-1], True)]
    assert got["b"] == [one, ("2", BLOCK[: BLOCK.index(b"<p>") + 5], True)] and got["g"] == [one] and got["h"] == [one, ("2", b"", True)]
    (tmp_path / "in" / "z.warc.gz").write_bytes(gzip.compress(whole[: ends["b"]]))
    marked = warc.derive(warc.from_warc(warc.read(spark, str(tmp_path / "in" / "z.warc.gz")))).where("warc_type = 'metadata'").collect()
    assert {r.refers_to: "sourceTruncated: length" in r.block for r in marked} == {"<urn:uuid:1>": False, "<urn:uuid:2>": True}


def test_a_split_file_is_an_error(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(1) * 200)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        with pytest.raises(Exception, match="split"):
            warc.read(spark, str(tmp_path / "a.warc")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
