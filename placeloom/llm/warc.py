"""WARC derivatives: linked metadata and plain-text conversion records of archived responses.

A response is a row with a target URI, a date, its HTTP headers and its payload, and where an archive gave them, its record id and
digests. Each gets two derived records: a ``metadata`` record (application/warc-fields) with the source's headers, digests and measures, and a
``conversion`` record with the payload as plain text. Both name the response's record id in WARC-Refers-To, with its target URI and
date, and carry digests: that of their own block, and the source's payload digest. A response's own id and digests stay as
they are; only where it has none are they made, ids from content (SHA-256 of kind, URI and payload digest, laid out as a version 8 UUID), so a
rerun makes the same records.

All of it is DataFrame functions in one pass without a shuffle. ``write`` stores records as WARC/1.1 text files,
one per partition, and ``read`` parses WARC files, plain or gzipped, back into rows, line by line as Spark streams them.

Plain text: comments, scripts, styles and heads' metadata go; block tags and <br> end a line; other tags go; the named
entities below and numeric ones, decimal or hexadecimal, are decoded once, others stay; runs of white space in a line become a space and
empty lines go. Defined edge results: a null or empty payload gives an empty conversion block; a null URI is
``urn:unknown``; a null date is ``DATE``; a number that is no character stays as it is; repeated rows give repeated records with the same
ids; other columns are passed by. Of a file that ends within a record's header that record is no row; one that ends within a
block gives a row with what there is and ``truncated``, and the metadata derived from it say so.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

DATE = "2024-01-01T00:00:00Z"
HEADERS = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"

# What ends a line, what is dropped whole, and the entities that are decoded.
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
DROPPED = ("script", "style", "noscript", "template")
ENTITIES = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "copy": "©", "reg": "®", "trade": "™", "hellip": "…", "mdash": "—", "ndash": "–", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "euro": "€", "pound": "£",
    "deg": "°", "middot": "·", "bull": "•", "times": "×", "sect": "§", "szlig": "ß", "auml": "ä", "ouml": "ö", "uuml": "ü", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü", "agrave": "à", "aacute": "á", "acirc": "â", "ccedil": "ç", "egrave": "è", "eacute": "é", "ecirc": "ê",
    "iacute": "í", "icirc": "î", "ntilde": "ñ", "oacute": "ó", "ocirc": "ô", "uacute": "ú", "ugrave": "ù",
}
_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z]{2,8});"

_STEPS = (
    (r"(?s)<!--.*?-->", " "), *((rf"(?is)<{t}(\s[^>]*)?>.*?</{t}\s*>", " ") for t in DROPPED), (r"[\x09-\x0D\x20]+", " "),
    (rf"(?i)</?({BLOCKS})(\s[^>]*)?/?>", "\n"), (r"<[!/?A-Za-z][^>]*>", ""),
)
_LINES = ((r"[\x20\x{00A0}]*\n[\x20\n]*", "\n"), (r"\x20{2,}", " "), (r"^[\x20\n]+|[\x20\n]+$", ""))


def _once(value: Column, f) -> Column:
    """``f`` of a value that is computed a single time, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def decoded(text: Column) -> Column:
    """Entities replaced by their characters, each once: the text is cut at every ``&`` and each piece begins with one or doesn't."""
    table = F.create_map(*(F.lit(x) for kv in ENTITIES.items() for x in kv))

    def numbered(name: Column) -> Column:
        code = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7)).try_cast("int")
        valid = lambda c: c.between(0x20, 0x10FFFF) & ~c.between(0xD800, 0xDFFF) & ~c.between(0x7F, 0x9F)
        return _once(code, lambda c: F.when(valid(c), F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")))

    def one(piece: Column) -> Column:
        char = lambda name: F.when(name == "", F.lit(None)).when(name.startswith("#"), numbered(name)).otherwise(F.try_element_at(table, name))
        swap = lambda name: _once(char(name), lambda c: F.when(c.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(c, F.substr(piece, F.length(name) + 2))))
        return _once(F.regexp_extract(piece, _ENTITY, 1), swap)

    joined = lambda pieces: F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one), ""))
    return _once(text, lambda t: F.when(F.contains(t, F.lit("&")), _once(F.split(t, "&", -1), joined)).otherwise(t))


def plain_text(html: Column) -> Column:
    """The text a page shows, a line for each block."""
    out = F.coalesce(html.cast("string"), F.lit(""))
    for pattern, to in _STEPS:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(to))
    out = decoded(out)
    for pattern, to in _LINES:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(to))
    return out


def record_id(kind: str, content: Column) -> Column:
    h = F.sha2(F.concat(F.lit(f"{kind} "), content), 256)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


RECORD = ("page_id", "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "content_length", "block_digest", "payload_digest", "header", "block")


def responses(pages: DataFrame, date: str = DATE, headers: str = HEADERS) -> DataFrame:
    """Pages (page_id, url, html) as responses (page_id, uri, date, headers, payload)."""
    return pages.select("page_id", F.col("url").alias("uri"), F.lit(date).alias("date"), F.lit(headers).alias("headers"), F.col("html").alias("payload"))


def derive(source: DataFrame) -> DataFrame:
    """Two records for each response (page_id, uri, date, headers, payload; record_id, payload_digest, block_digest, truncated where known), metadata first."""
    known = lambda c, kind="string": F.col(c).cast(kind) if c in source.columns else F.lit(None).cast(kind)
    base = source.select(
        "page_id", F.coalesce(F.col("uri").cast("string"), F.lit("urn:unknown")).alias("uri"), F.coalesce(F.col("date").cast("string"), F.lit(DATE)).alias("date"), F.coalesce(F.col("headers").cast("string"), F.lit("")).alias("headers"), F.coalesce(F.col("payload").cast("string"), F.lit("")).alias("payload"),
        known("record_id").alias("given_id"), known("payload_digest").alias("given_digest"), known("block_digest").alias("source_block_digest"), F.coalesce(known("truncated", "boolean"), F.lit(False)).alias("truncated"),
    )
    base = base.withColumn("own_digest", F.concat(F.lit("sha256:"), F.sha2("payload", 256))).withColumn("plain", plain_text(F.col("payload")))
    content = F.coalesce("given_id", F.concat("uri", F.lit(" "), "own_digest"))
    base = base.withColumn("payload_digest", F.coalesce("given_digest", "own_digest")).withColumn("source_id", F.coalesce("given_id", record_id("response", content))).withColumn("conversion_id", record_id("conversion", content)).withColumn("metadata_id", record_id("metadata", content))
    block_digest = F.when(F.col("source_block_digest").isNotNull(), F.concat(F.lit("\r\nsourceBlockDigest: "), "source_block_digest")).otherwise(F.lit(""))
    cut_off = F.when(F.col("truncated"), F.lit("\r\nsourceTruncated: length")).otherwise(F.lit(""))
    fields = F.concat(
        F.lit("conversion: "), "conversion_id", F.lit("\r\nsourcePayloadDigest: "), "payload_digest", block_digest, F.lit("\r\nsourcePayloadLength: "), F.octet_length("payload").cast("string"), F.lit("\r\nplainTextCharacters: "), F.length("plain").cast("string"), cut_off,
        F.lit("\r\nsourceHttpHeaders: "), F.replace(F.col("headers"), F.lit("\r\n"), F.lit("\r\n\t")), F.lit("\r\n"),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.col("metadata_id").alias("record_id"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.col("conversion_id").alias("record_id"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("plain").alias("block")),
    )
    out = base.select("page_id", "uri", "date", "source_id", "payload_digest", F.explode(kinds).alias("r")).select("page_id", "uri", "date", "source_id", "payload_digest", "r.*")
    out = out.withColumn("content_length", F.octet_length("block").cast("long")).withColumn("block_digest", F.concat(F.lit("sha256:"), F.sha2("block", 256)))
    line = lambda name, c: F.concat(F.lit(f"{name}: "), c, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("uri")), line("WARC-Refers-To", F.col("source_id")),
        line("WARC-Refers-To-Target-URI", F.col("uri")), line("WARC-Refers-To-Date", F.col("date")), line("WARC-Block-Digest", F.col("block_digest")), line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length").cast("string")),
    )
    return out.select("page_id", "warc_type", "record_id", F.col("source_id").alias("refers_to"), F.col("uri").alias("target_uri"), F.col("date").alias("warc_date"), "content_type", "content_length", "block_digest", "payload_digest", header.alias("header"), "block")


def write(records: DataFrame, path: str) -> None:
    """WARC/1.1 files: each record is its header, an empty line, its block and two line ends."""
    records.select(F.concat("header", F.lit("\r\n"), "block").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


READ = "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, payload_digest string, source_block_digest string, truncated boolean, header string, block binary"
_NAMED = ("warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-date", "warc-payload-digest", "warc-block-digest")
#: Bytes of blocks that a task gives back at once, give or take a record.
HELD = 16 << 20


class Parser:
    """Records of one file from its lines, one after the other."""

    def __init__(self) -> None:
        self.header: list[bytes] | None = None
        self.block: list[bytes] = []
        self.left = 0
        self.found: list[tuple] = []
        self.size = 0

    def line(self, data: bytes) -> None:
        """A line without its end, which is a line feed. A block that ends in one is whole when another line follows."""
        if self.block and not self.left:
            self._record(False)
        if self.header is None:
            if data.startswith(b"WARC/1."):
                self.header = [data.rstrip(b"\r")]
        elif not self.block and self.left == 0:
            if data.rstrip(b"\r"):
                self.header.append(data.rstrip(b"\r"))
                return
            size = self._fields().get("content-length", "0")
            self.left = int(size) if size.isdigit() else 0
            if not self.left:
                self._record(False)
        else:
            data += b"\n"
            self.block.append(data[: self.left])
            short, self.left = self.left < len(data), max(0, self.left - len(data))
            if short:
                self._record(False)

    def end(self) -> None:
        """The file is over; its last line may have had no end."""
        if self.header is not None and (self.block or self.left):
            if self.block:
                self.block[-1] = self.block[-1].removesuffix(b"\n")
            self._record(True)
        self.header, self.block, self.left = None, [], 0

    def _fields(self) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in self.header[1:])}

    def _record(self, truncated: bool) -> None:
        named = self._fields()
        header = "".join(x.decode("utf-8", "replace") + "\r\n" for x in self.header)
        self.found.append((*(named.get(n) for n in _NAMED), truncated, header, b"".join(self.block)))
        self.size += len(header) + len(self.found[-1][-1])
        self.header, self.block, self.left = None, [], 0


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files under ``path``, plain or gzipped: ``READ``. ``block`` is the record's bytes, as Content-Length says.

    Spark streams a file's lines to one task, so neither a file nor a part of one is held but the record at hand; a gzipped file is
    never split, and a plain one longer than ``spark.sql.files.maxPartitionBytes`` is an error that says so.
    """
    where = F.col("_metadata.file_path")
    whole = F.assert_true(F.col("_metadata.file_block_length") == F.col("_metadata.file_size"), F.concat(F.lit("a plain WARC file was split, raise spark.sql.files.maxPartitionBytes: "), where))
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path).select(where.alias("file"), F.col("value").cast("binary").alias("line"), whole.alias("ok"))

    schema = to_arrow_schema(StructType.fromDDL(READ))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file = Parser(), None

        def rows() -> pa.RecordBatch:
            found, parser.found, parser.size = parser.found, [], 0
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*found) if found else [[]] * len(schema), schema)], schema=schema)

        for batch in batches:
            for name, data in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()):
                if name != file:
                    parser.end()
                    file = name
                parser.line(data)
                if parser.size > HELD:
                    yield rows()
        parser.end()
        yield rows()

    return lines.mapInArrow(parse, READ)


def from_warc(records: DataFrame) -> DataFrame:
    """Response records of ``read`` as the input of ``derive``: HTTP headers and payload apart, UTF-8 with what isn't replaced; ids and digests as they are."""
    block = F.make_valid_utf8(F.col("block").cast("string"))
    cut = F.instr(block, "\r\n\r\n")
    return records.where("warc_type = 'response'").select(
        F.col("record_id").alias("page_id"), "record_id", "payload_digest", F.col("source_block_digest").alias("block_digest"), "truncated", F.col("target_uri").alias("uri"), F.col("warc_date").alias("date"),
        F.when(cut > 0, F.substring(block, F.lit(1), cut - 1)).otherwise(F.lit("")).alias("headers"), F.when(cut > 0, F.substr(block, cut + 4)).otherwise(block).alias("payload"),
    )


def _sql_text() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'" if "\n" not in s else "chr(10)"
    out = "coalesce(html, '')"
    for pattern, to in _STEPS:
        out = f"regexp_replace({out}, {q(pattern.replace('(?is)', '(?is)'))}, {q(to)}, 'g')"
    names = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in ENTITIES.items()) + "}"
    number = "CASE WHEN lower(n[2]) = 'x' THEN TRY_CAST('0x' || n[3:] AS INTEGER) ELSE TRY_CAST(n[2:] AS INTEGER) END"
    name = f"list_transform([regexp_extract(p, {q(_ENTITY)}, 1)], lambda n: CASE WHEN n[1] = '#' THEN CASE WHEN {number} BETWEEN 32 AND 1114111 AND NOT {number} BETWEEN 55296 AND 57343 AND NOT {number} BETWEEN 127 AND 159 THEN chr({number}) END ELSE {names}[n] END)[1]"
    rest = f"p[length(regexp_extract(p, {q(_ENTITY)}, 1)) + 2:]"
    out = f"list_transform([string_split({out}, '&')], lambda s: s[1] || array_to_string(list_transform(s[2:], lambda p: coalesce({name} || {rest}, '&' || p)), ''))[1]"
    for pattern, to in _LINES:
        out = f"regexp_replace({out}, {q(pattern)}, {q(to)}, 'g')"
    return out


def _sql_id(kind: str) -> str:
    h = f"sha256('{kind} ' || uri || ' ' || payload_digest)"
    return f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-8' || substr({h}, 14, 3) || '-a' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12) || '>'"


ORACLE = f"""
WITH b AS (SELECT page_id, coalesce(url, 'urn:unknown') AS uri, coalesce(html, '') AS payload, 'sha256:' || sha256(coalesce(html, '')) AS payload_digest, {_sql_text()} AS plain, chr(13) || chr(10) AS nl FROM pages),
i AS (SELECT *, {_sql_id("response")} AS refers_to, {_sql_id("conversion")} AS cid, {_sql_id("metadata")} AS mid FROM b),
r AS (SELECT page_id, uri, refers_to, payload_digest, nl, 'metadata' AS warc_type, mid AS record_id, 'application/warc-fields' AS content_type,
  'conversion: ' || cid || nl || 'sourcePayloadDigest: ' || payload_digest || nl || 'sourcePayloadLength: ' || strlen(payload) || nl || 'plainTextCharacters: ' || length(plain) || nl || 'sourceHttpHeaders: HTTP/1.1 200 OK' || nl || chr(9) || 'Content-Type: text/html; charset=utf-8' || nl AS block FROM i
  UNION ALL SELECT page_id, uri, refers_to, payload_digest, nl, 'conversion', cid, 'text/plain; charset=utf-8', plain FROM i),
d AS (SELECT *, strlen(block)::BIGINT AS content_length, 'sha256:' || sha256(block) AS block_digest FROM r)
SELECT page_id, warc_type, record_id, refers_to, uri AS target_uri, '{DATE}' AS warc_date, content_type, content_length, block_digest, payload_digest,
  'WARC/1.1' || nl || 'WARC-Type: ' || warc_type || nl || 'WARC-Record-ID: ' || record_id || nl || 'WARC-Date: {DATE}' || nl || 'WARC-Target-URI: ' || uri || nl || 'WARC-Refers-To: ' || refers_to || nl || 'WARC-Refers-To-Target-URI: ' || uri || nl || 'WARC-Refers-To-Date: {DATE}' || nl || 'WARC-Block-Digest: ' || block_digest || nl || 'Content-Type: ' || content_type || nl || 'Content-Length: ' || content_length || nl AS header, block
FROM d
"""
