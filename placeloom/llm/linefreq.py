"""Quality rules with cross-document line frequency.

Each text is read once for the base rules and its distinct normalised lines, as hashes. Lines are counted per
host over distinct documents: exact copies of a text are one document, so a text isn't rejected for having
copies. Lines in more than ``MAX_DOCS`` documents of a host are removed, and a document is depleted, hence rejected, if its
removed lines leave fewer than ``LEAST_WORDS`` words or less than ``LEAST_SHARE`` percent of its words.

Normalised: words joined by one space, A-Z to a-z, digits to 0. Lines without a word don't count. Line counts
are summed per task before the shuffle, and frequent lines return by a join that Spark can split where one
line is in a third of all documents.

Defined edge results: a null or empty text has no words, fails the base rules and isn't kept; a null source is a
host of its own; repeated rows are judged one by one; other columns are passed by.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch
from .texts import as_bytes, map_slices

MAX_DOCS = 100
LEAST_WORDS = 10
LEAST_SHARE = 20
WINDOW = 5

_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_NOT_COUNTED = _SPACE + bytes(range(0x80, 0xC0))  # white space, and all but the first byte of a character
_NOT_SYMBOL = bytes(b for b in range(256) if b not in b"#*$%&|<>")
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256))
#: Words from which windows are compared as numbers rather than tuples.
_MANY = 50_000

_SCAN = "row long, doc_id long, host string, fp long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<int>"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    if len(words) < _MANY:
        windows = list(zip(*(words[i:] for i in range(window))))
        if len(set(windows)) == n:
            return 0
        number: dict[tuple, int] = {}
        rank = np.fromiter((number.setdefault(w, len(number)) for w in windows), np.int64, n)
    else:
        ids: dict[bytes, int] = {}
        one = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
        rank = one[:n]
        for i in range(1, window):
            rank = np.unique(rank * len(ids) + one[i : n + i], return_inverse=True)[1]
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edge[at] += 1
    edge[at + window] -= 1
    return int((np.cumsum(edge) > 0).sum())


def lines_of(text: bytes) -> tuple[int, dict[int, int]]:
    """Repeated lines, and words by hash of the normalised line."""
    seen: set[bytes] = set()
    words: dict[int, int] = {}
    repeats = 0
    for line in text.split(b"\n"):
        w = line.split()
        if w:
            repeats += line in seen
            seen.add(line)
            h = xxhash.xxh64_intdigest(b" ".join(w).translate(_FOLD)) - (1 << 63)
            words[h] = words.get(h, 0) + len(w)
    return repeats, words


def _scanned(part: pa.RecordBatch) -> dict:
    out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words")}
    for text in as_bytes(part.column("text")):
        words = text.split()
        repeats, lines = lines_of(text)
        for k, v in zip(out, (len(words), len(text.translate(None, _NOT_COUNTED)), len(text.translate(None, _NOT_SYMBOL)), repeats, repeated_words(words), list(lines), list(lines.values()))):
            out[k].append(v)
    return out | {k: part.column(k) for k in ("row", "doc_id", "host", "fp")}


def scan(docs: DataFrame) -> DataFrame:
    """Base values and hashed lines of every row of ``docs`` (doc_id, text, source), read once and kept in a table."""
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.col("source").cast("string").alias("host"), F.xxhash64(text).alias("fp"), F.monotonically_increasing_id().alias("row"))
    return scratch.table(map_slices(rows, _scanned, _SCAN), "lines")


def frequent(scanned: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, line, n_docs) of the lines in more than ``max_docs`` distinct documents of their host."""
    distinct = scanned.groupBy("host", "fp").agg(F.any_value("lines").alias("lines"))
    return distinct.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > max_docs)


def report(docs: DataFrame, max_docs: int = MAX_DOCS, least_words: int = LEAST_WORDS, least_share: int = LEAST_SHARE) -> DataFrame:
    """One row per document: base values, words in removed lines, and the verdict."""
    scanned = scan(docs)
    common = scratch.table(frequent(scanned, max_docs), "frequent").select("host", "line")
    one = F.explode(F.arrays_zip("lines", "line_words")).alias("l")
    lines = scanned.select("row", "host", one).select("row", F.col("host").alias("its_host"), F.col("l.lines").alias("its_line"), F.col("l.line_words").alias("words"))
    removed = lines.join(common, F.col("its_host").eqNullSafe(F.col("host")) & (F.col("its_line") == F.col("line"))).groupBy("row").agg(F.sum("words").alias("removed"))
    out = scanned.drop("lines", "line_words", "host", "fp").join(removed, "row", "left").withColumn("n_removed_words", F.coalesce("removed", F.lit(0).cast("long")))
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < least_words) | (100 * left < least_share * F.col("n_words")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~depleted).alias("kept"), "n_removed_words")


def clean(docs: DataFrame, max_docs: int = MAX_DOCS, least_words: int = LEAST_WORDS, least_share: int = LEAST_SHARE) -> DataFrame:
    """(doc_id, text): kept documents without their removed lines.

    The hashes to remove return to each text by its id and hash, in arrays no longer than the text's own lines.
    """
    scanned = scan(docs)
    common = scratch.table(frequent(scanned, max_docs), "frequent").select("host", "line")
    lines = scanned.select(F.col("host").alias("its_host"), "doc_id", "fp", F.explode("lines").alias("its_line"))
    cut = lines.join(common, F.col("its_host").eqNullSafe(F.col("host")) & (F.col("its_line") == F.col("line"))).groupBy(F.col("doc_id").alias("id"), F.col("fp").alias("of"), "its_host").agg(F.collect_set("its_line").alias("cut"))

    @F.pandas_udf("string")
    def without(text: pd.Series, cut: pd.Series) -> pd.Series:
        return pd.Series([_without(t or "", set() if c is None else set(c.tolist()), least_words, least_share) for t, c in zip(text, cut)], dtype=object)

    source = F.col("source").cast("string")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), source.alias("src")).withColumn("print", F.xxhash64("text"))
    both = texts.join(cut, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("print") == F.col("of")) & F.col("src").eqNullSafe(F.col("its_host")), "left")
    return both.select("doc_id", without("text", "cut").alias("text")).where("text IS NOT NULL")


def _without(text: str, cut: set[int], least_words: int, least_share: int) -> str | None:
    data = text.encode()
    words = data.split()
    n = len(words)
    if n < 10 or 100 * repeated_words(words) > 20 * n:
        return None
    kept = [x for x in data.split(b"\n") if not x.split() or (xxhash.xxh64_intdigest(b" ".join(x.split()).translate(_FOLD)) - (1 << 63)) not in cut]
    out = b"\n".join(kept)
    left = len(out.split())
    return None if left < n and (left < least_words or 100 * left < least_share * n) else out.decode()


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT k, i, array_to_string(ws[i:i+4], ' ') AS win FROM (SELECT k, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS c FROM p) WHERE c > 1),
rep AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY k),
l AS (SELECT k, source, text, line, ln, translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS norm, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw
  FROM (SELECT k, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM d)),
lw AS (SELECT * FROM l WHERE nw > 0),
dup AS (SELECT k, count(*) - count(DISTINCT line) AS n FROM lw GROUP BY k),
freq AS (SELECT source, norm FROM lw GROUP BY source, norm HAVING count(DISTINCT text) > 100),
rem AS (SELECT lw.k, sum(lw.nw) AS n FROM lw JOIN freq ON lw.source IS NOT DISTINCT FROM freq.source AND lw.norm = freq.norm GROUP BY lw.k),
s AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
  coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(rem.n, 0) AS n_removed_words
  FROM w LEFT JOIN dup USING (k) LEFT JOIN rep USING (k) LEFT JOIN rem USING (k)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_words - n_removed_words AS n_left FROM s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_removed_words > 0 AND (n_left < 10 OR 100 * n_left < 20 * n_words)) AS kept, CAST(n_removed_words AS BIGINT) AS n_removed_words
FROM f
"""
