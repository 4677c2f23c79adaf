"""Secret scan with corpus-wide ownership frequency.

Each text is scanned once. Base kinds (assign, access, hex) are spans by pattern alone. Besides these, long
random-looking words are weak candidates, which a pattern can't tell from identifiers, digests of public files
or sample keys. The corpus tells: candidates are hashed, and each hash is aggregated by distinct repositories (documents,
exact copies of a text counting as one) and distinct owners (sources). A hash in more than ``MAX_REPOS``
repositories or ``MAX_OWNERS`` owners is a widely copied example; a live-looking one below both is specific to
its owner and becomes a span of kind ``owned``. Base spans stay whatever the corpus says; ``n_live`` and
``n_example`` say how many of a document's distinct candidates, base ones included, fall on either side.

Hashes are summed per task before they are shuffled and then per hash, so a value that a third of all documents copy is no hot
key. Verdicts come back per hash by a join whose sides Spark can split when one hash is hot.

Defined edge results: a null or empty text has no spans; a null source is one owner; repeated rows are
judged one by one and the copies count as one repository.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch
from .texts import map_slices

MAX_REPOS = 8
MAX_OWNERS = 2
#: Bits per character that a candidate must have to look random.
LIVE_BITS = 3.0

# The base kinds in order, and the least characters of what counts.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # from 32 on, the first match starts where the whole run does
WEAK = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}(?![A-Za-z0-9+/_-])")

_SCAN = "row long, doc_id long, fp long, owner string, repo string, n_assign long, n_access long, n_hex long, base string, starts array<int>, ends array<int>, kinds array<int>, hashes array<string>, live array<boolean>"


def looks_live(value: str) -> bool:
    """Digits and letters mixed, and as many bits per character as a random key has."""
    from math import log2

    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    return -sum(k / n * log2(k / n) for k in (value.count(c) for c in set(value))) >= LIVE_BITS


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, secret value) of base spans and weak candidates, by start, then kind."""
    out = [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    out.sort()
    ends = list(accumulate((b for _, b, _, _ in out), max))
    weak = []
    for m in WEAK.finditer(text):
        # of the base spans that start before its end, the farthest end is beyond its start: one overlaps it
        i = bisect_left(out, (m.end(),))
        if not (i and ends[i - 1] > m.start()) and looks_live(m[0]):
            weak.append((m.start(), m.end(), 3, m[0]))
    return sorted(out + weak)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def _scanned(part: pa.RecordBatch) -> dict:
    texts = [t or "" for t in part.column("text").to_pylist()]
    found = [find(t) for t in texts]
    base = [[x[:3] for x in f if x[2] < 3] for f in found]
    return {
        "row": part.column("row"), "doc_id": part.column("doc_id"), "fp": part.column("fp"), "owner": pc.fill_null(part.column("source"), "\0"), "repo": [hashlib.md5(t.encode()).hexdigest() if f else None for t, f in zip(texts, found)],
        "n_assign": [sum(k == 0 for _, _, k in b) for b in base], "n_access": [sum(k == 1 for _, _, k in b) for b in base], "n_hex": [sum(k == 2 for _, _, k in b) for b in base], "base": [joined(b) for b in base],
        "starts": [[x[0] for x in f] for f in found], "ends": [[x[1] for x in f] for f in found], "kinds": [[x[2] for x in f] for f in found],
        "hashes": [[hashlib.sha256(x[3].encode()).hexdigest()[:32] for x in f] for f in found], "live": [[looks_live(x[3]) for x in f] for f in found],
    }


def scan(docs: DataFrame) -> DataFrame:
    """Base spans and hashed candidates of every row of ``docs`` (doc_id, text, source), read once and kept in a table."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("fp"), F.monotonically_increasing_id().alias("row"))
    return scratch.table(map_slices(rows, _scanned, _SCAN), "secrets")


def candidates(scanned: DataFrame) -> DataFrame:
    """One row per span or candidate: row, owner, repo, hash, live, kind, start, end."""
    one = F.explode(F.arrays_zip("hashes", "live", "kinds", "starts", "ends")).alias("c")
    return scanned.where(F.size("hashes") > 0).select("row", "owner", "repo", one).select("row", "owner", "repo", *(F.col(f"c.{a}").alias(b) for a, b in (("hashes", "hash"), ("live", "live"), ("kinds", "kind"), ("starts", "start"), ("ends", "end"))))


def ownership(found: DataFrame, max_repos: int = MAX_REPOS, max_owners: int = MAX_OWNERS) -> DataFrame:
    """Per candidate hash: distinct repositories and owners, and whether it is a widely copied example or owned."""
    by_repo = found.groupBy("hash", "owner", "repo").agg(F.max("live").alias("live"))
    # a text that several owners have counts for each: copies across owners make an example sooner
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.max("live").alias("live"))
    total = by_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"), F.max("live").alias("live"))
    wide = (F.col("n_repos") > max_repos) | (F.col("n_owners") > max_owners)
    return total.select("hash", "n_repos", "n_owners", wide.alias("example"), (~wide & F.col("live")).alias("owned"))


REPORT = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_owned", "n_live", "n_example")


def _decided(scanned: DataFrame, max_repos: int, max_owners: int) -> DataFrame:
    """Per row with candidates: spans that stand (base, and weak ones that are owned) and the counts."""
    found = candidates(scanned)
    verdict = scratch.table(ownership(found, max_repos, max_owners), "ownership")
    told = found.join(verdict, "hash")
    stands = (F.col("kind") < 3) | F.col("owned")
    span = F.struct("start", "kind", "end")
    return told.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(stands, span))).alias("found"), F.count_if((F.col("kind") == 3) & F.col("owned")).alias("n_owned"),
        F.size(F.collect_set(F.when(F.col("owned"), F.col("hash")))).cast("long").alias("n_live"), F.size(F.collect_set(F.when(F.col("example"), F.col("hash")))).cast("long").alias("n_example"),
    )


def report(docs: DataFrame, max_repos: int = MAX_REPOS, max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per document: base counts and digest, all spans, and what the corpus says of its candidates."""
    scanned = scan(docs)
    decided = _decided(scanned, max_repos, max_owners)
    names = F.array(*(F.lit(k) for k in KINDS))
    text = F.transform("found", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return scanned.select("row", "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256")).join(decided, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(F.array_join(text, ","), F.lit("")).alias("spans"),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_owned", "n_live", "n_example")),
    )


def redact(docs: DataFrame, mark: str = "[secret]", max_repos: int = MAX_REPOS, max_owners: int = MAX_OWNERS) -> DataFrame:
    """The documents with every secret replaced by ``mark``; widely copied examples stay.

    A base span is cut unless its value is a widely copied example, however it looks; only weak candidates have to look live.
    A text that changes gets its new length in ``n_chars`` where that column exists; other columns stay. The
    spans to cut come back by document id and a hash of the text, so rows that share an id keep apart.
    """
    scanned = scan(docs)
    found = candidates(scanned)
    verdict = scratch.table(ownership(found, max_repos, max_owners), "ownership")
    # weak candidates all look live, so of these too the ones that aren't examples are the owned ones
    cuts = found.join(verdict.where("NOT example").select("hash"), "hash", "left_semi").groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__cuts"))
    by_text = scanned.select("row", F.col("doc_id").alias("__id"), F.col("fp").alias("__fp")).join(cuts, "row").groupBy("__id", "__fp").agg(F.max("__cuts").alias("__cuts"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([_redacted(t, c, mark) if t is not None and c is not None and len(c) else t for t, c in zip(text, cuts)], dtype=object)

    keys = docs.withColumn("__fp1", F.xxhash64(F.col("text").cast("string")))
    out = keys.join(by_text, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__fp1") == F.col("__fp")), "left")
    out = out.withColumn("__cut", cut("text", "__cuts"))
    changed = F.col("__cuts").isNotNull()
    new = {"text": F.col("__cut")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("__cut")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))


def _redacted(text: str, cuts, mark: str) -> str:
    out, at = [], 0
    for c in cuts:
        a, b = int(c["start"]), int(c["end"])
        if b <= at:
            continue
        out += [text[at : max(a, at)], mark]
        at = b
    return "".join(out) + text[at:]
