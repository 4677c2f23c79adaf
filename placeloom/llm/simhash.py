"""SimHash near-duplicates with bit-sliced comparison.

Every distinct fingerprint is compared with all that could be near. With radius r the 64 bits are cut into
m > r bands, and two fingerprints within r bits agree on m - r bands at least, so rows meet per choice of m - r bands and their value: an exact
candidate rule for any m. More bands make more tables of longer keys: 4 of 16 bits, 10 of 25 or 20 of 32. There are so many bands
that a key's rows don't grow with the corpus; their number changes no result. A task holds its rows sorted by band value, 64 rows to a block, and keeps them vertically: one
word per bit plane. All distances between a fingerprint and a block's 64 rows are counted together by
carry-save adders on two count planes, a third plane marking the lanes that passed the radius; a block is
abandoned as soon as all its lanes have.

Only a spanning forest of the links leaves a task, never all pairs of a group. A key with more than
``CHUNK`` distinct fingerprints is dealt out as pairs of chunks, so no task holds an unbounded group and no
link is lost. Components then form by rounds of star contraction on the small graph of linked fingerprints, written
out between rounds; documents get theirs by their fingerprint.

Defined edge results: a text without words, also a null one, has fingerprint zero and links like any other; a null id
never names a component unless all ids in it are null; repeated rows keep a row each; other columns are passed by.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from . import scratch
from .texts import as_bytes, map_slices

RADIUS = 3
SHINGLE = 3
SEED = 42
CHUNK = 1024
#: Rows that a task compares at once, give or take a batch.
HELD = 1 << 17
#: (fingerprint, block) comparisons that are counted at once.
BATCH = 1 << 18

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is in over half the hashes of the shingles, repeats included."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    k = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(flat[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[a : a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text, as a signed long."""

    def run(part: pa.RecordBatch) -> dict:
        prints = np.array([fingerprint(t, shingle) for t in as_bytes(part.column("text"))], np.uint64)
        return {"doc_id": part.column("doc_id"), "fp": prints.view(np.int64)}

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, fp long")


def planes(rows: np.ndarray) -> np.ndarray:
    """Bit planes of the rows, by block of 64: [plane, block], lane j of a word being row j of the block."""
    n = -(-len(rows) // 64)
    padded = np.zeros(n * 64, np.uint64)
    padded[: len(rows)] = rows
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(n, 64, 8), axis=2, bitorder="little")  # [block, lane, plane]
    return np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little").reshape(64, n, 8).copy().view("<u8")[:, :, 0]


def near(rows: np.ndarray, upto: np.ndarray, radius: int = RADIUS):
    """Pairs (i, j), i < j < upto[i], of rows within the radius, in batches; others within a compared block may come too."""
    assert radius == 3, "the two count planes and the mark count to three"
    plane = planes(rows)
    first, last = np.arange(len(rows)) // 64, np.maximum(upto - 1, 0) // 64
    blocks = last - first + 1
    total = np.cumsum(blocks)
    done = 0
    while done < len(rows):
        stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + BATCH, side="right")))
        b = blocks[done:stop]
        row = np.repeat(np.arange(done, stop), b)
        block = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(b) - b, b)
        one, two, over = (np.zeros(len(row), np.uint64) for _ in range(3))
        # lanes at or before the row itself, and beyond the end, count as over from the start
        ahead = np.clip(row + 1 - block * 64, 0, 64)
        over |= np.where(ahead >= 64, _ALL, (np.uint64(1) << np.minimum(ahead, 63).astype(np.uint64)) - np.uint64(1))
        used = np.clip(len(rows) - block * 64, 0, 64)
        over |= np.where(used >= 64, np.uint64(0), ~((np.uint64(1) << np.minimum(used, 63).astype(np.uint64)) - np.uint64(1)))
        value = rows[row]
        for p in range(64):
            if p % 4 == 0 and p:
                live = over != _ALL
                if not live.all():
                    row, block, one, two, over, value = (x[live] for x in (row, block, one, two, over, value))
                    if not len(row):
                        break
            bit = (value >> np.uint64(p)) & np.uint64(1)
            differs = plane[p][block] ^ (np.uint64(0) - bit)
            carry = one & differs
            one ^= differs
            more = two & carry
            two ^= carry
            over |= more
        hit = np.flatnonzero(over != _ALL)
        if len(hit):
            lanes = np.unpackbits((~over[hit]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, lane = np.nonzero(lanes)
            yield row[hit[at]], block[hit[at]] * 64 + lane
        done = stop


def roots(n: int, pairs) -> np.ndarray:
    """The least row of each row's component, from batches of pairs."""
    root = np.arange(n)

    def settle() -> None:
        while not np.array_equal(root[root], root):
            root[:] = root[root]

    for a, b in pairs:
        while len(a):
            ra, rb = root[a], root[b]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            settle()
    return root


def forest(values: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, least linked fingerprint) among rows sorted by group."""
    if not len(values):
        return values, values
    ends = np.flatnonzero(np.r_[groups[1:] != groups[:-1], True]) + 1
    upto = np.repeat(ends, np.diff(np.r_[0, ends]))
    root = roots(len(values), near(values.view(np.uint64), upto))
    linked = np.flatnonzero(root != np.arange(len(values)))
    return values[linked], values[root[linked]]


def bands(n: int, radius: int = RADIUS, chunk: int = CHUNK) -> int:
    """The fewest bands, up to three more than the radius, with which ``n`` fingerprints make about a chunk a key, were they spread evenly."""
    return next((m for m in (radius + 1, radius + 2) if n <= chunk << (64 * (m - radius) // m)), radius + 3)


def keys(m: int, radius: int = RADIUS) -> list[Column]:
    """A key of each table: its number, then the bits of the bands that agree."""
    edges = [64 * i // m for i in range(m + 1)]
    out = []
    for i, chosen in enumerate(combinations(range(m), m - radius)):
        key = F.lit(i).cast("long")
        for band in chosen:
            width = edges[band + 1] - edges[band]
            key = F.shiftleft(key, width) + F.shiftrightunsigned("fp", edges[band]).bitwiseAND(F.lit((1 << width) - 1))
        out.append(key)
    return out


def links(prints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK, m: int | None = None) -> DataFrame:
    """(u, v): a forest that spans the links among the distinct ``fp`` of ``prints``, table by table; ``m`` bands, by default as many as the rows need."""
    m = bands(prints.count(), radius) if m is None else m
    rows = prints.select("fp", F.explode(F.array(*keys(m, radius))).alias("part"))
    large = scratch.table(rows.groupBy("part").count().where(F.col("count") > chunk).select("part", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "bands")
    # with the fewest bands there are (radius + 1) << 16 keys at most, so the large ones may be broadcast
    large = F.broadcast(large) if m == radius + 1 else large
    dealt = rows.join(large, "part", "left").withColumn("mine", F.when(F.col("chunks").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")).otherwise(0))
    other = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))).alias("other")
    dealt = dealt.select("fp", "part", "mine", other).select("fp", "part", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"))
    group = F.xxhash64("part", "a", "b").alias("task")

    def compare(parts):
        """Whole tasks, as many at a time as make ``HELD`` rows; a task has two chunks of rows at most."""
        held = pd.DataFrame({"fp": np.zeros(0, np.int64), "task": np.zeros(0, np.int64)})
        for part in parts:
            held = pd.concat([held, part], ignore_index=True)
            if len(held) >= HELD:
                task = held.task.to_numpy()
                cut = int(np.searchsorted(task, task[-1]))
                u, v = forest(held.fp.to_numpy()[:cut], task[:cut])
                yield pd.DataFrame({"u": u, "v": v})
                held = held.iloc[cut:]
        if len(held):
            u, v = forest(held.fp.to_numpy(), held.task.to_numpy())
            yield pd.DataFrame({"u": u, "v": v})

    spread = dealt.select("fp", group).repartition("task").sortWithinPartitions("task", "fp")
    return spread.mapInPandas(compare, "u long, v long")


def classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, fp, component_id): each row's fingerprint and the least id it is linked with, in any number of steps."""
    prints = scratch.table(fingerprints(docs, shingle), "fingerprints")
    distinct = scratch.table(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    stars = components(links(distinct, radius, chunk))
    named = distinct.join(stars, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    least = scratch.table(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "roots")
    by_print = scratch.table(named.select(F.col("fp").alias("its"), F.col("root").alias("of")).join(least, F.col("of") == F.col("root")).select("its", "component_id"), "classes")
    return prints.join(by_print, F.col("fp") == F.col("its")).select("doc_id", "fp", "component_id")


def report(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """One row per document: its fingerprint in hex and its component."""
    return classes(docs, shingle, radius, chunk).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """The documents, all columns unchanged, with the least id of each component.

    Rows that share an id are one document: all stay or none. Rows without an id stay.
    """
    spare = classes(docs, shingle, radius, chunk).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(spare, "doc_id", "left_anti").select(*docs.columns)
