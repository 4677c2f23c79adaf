"""Benchmark decontamination with suffix arrays over shards of the corpus.

Each shard of documents (a slice of an Arrow batch) gets a suffix array over its words, and every suffix of
the benchmark is binary-searched in it. Equal ranges of the array are the verbatim occurrences. For the longest
match it is the other way round: words of a document are searched in a suffix array of the benchmark, in steps of
halving powers of two, so every document gets its own, of any length.

Words the benchmark doesn't have can't be part of a match, so a shard's array only holds the suffixes that
start in runs of benchmark words at least as long as the shortest window; all other suffixes sort apart from
every query. And of the benchmark's suffixes only those are searched whose first two words the shard has side by side. No document is cut, no shuffle happens, and the only broadcast is the benchmark, in blocks of
at most ``BLOCK_BYTES``: a larger benchmark is applied block by block, each pass carrying on the last one's hits.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters. A window is ``window``
consecutive words of an item; an item with fewer words, but not none, is one window. Defined edge results: a
null or empty text has no words and is never contaminated; an item whose id or text is null is ignored;
repeated rows are judged one by one; other columns are passed by.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import scratch
from .texts import ALNUM, as_bytes, map_slices, slices

BLOCK_BYTES = 8 << 20
#: Bytes of text to a shard; more would only make fewer, longer arrays.
SHARD_BYTES = 8 << 20
#: What ``ALNUM`` and a split make of a text, for Java.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Benchmark:
    """The items' words as numbers, with every suffix that is searched."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.ids: list[str] = []
        self.vocabulary: dict[bytes, int] = {b"|": -1}
        flat, item, left, need = [], [], [], []
        for item_id, text in items:
            words = text.translate(ALNUM).split()
            if not words:
                continue
            length = min(window, len(words))
            flat += [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] + [-2]
            n = len(words)
            item += [len(self.ids)] * (n + 1)
            left += [*range(n, 0, -1), 0]
            need += [length if i + length <= n else 0 for i in range(n)] + [0]
            self.ids.append(item_id)
        self.words = np.array(flat + [-2] * 2, np.int64)
        self.start = np.flatnonzero(np.array(left, np.int64)) if left else np.zeros(0, np.int64)
        self.item, self.left, self.need = (np.array(x, np.int64)[self.start] if x else np.zeros(0, np.int64) for x in (item, left, need))
        self.shortest = int(self.need[self.need > 0].min()) if len(self.need) else 0
        self.longest = int(self.left.max()) if len(self.left) else 0
        self.floor = self.shortest
        self.two = self.words[self.start] * (len(self.vocabulary) + 1) + self.words[self.start + 1] if len(self.start) else self.start

    @functools.cached_property
    def index(self) -> Index:
        """Built where it is first asked for, so that it isn't sent along."""
        return Index(self)


class Index:
    """Every place of the benchmark in the order of the words from it, with ranks of its runs of 1, 2, 4 ... words.

    ``ranks[k]`` at a place numbers the up to 2 ** k words from it, an item's end coming before every word; ``pairs[k]`` are
    the runs of 2 ** k whole words, as (rank of the first half, rank of the second) in one number, and ``known[k]`` their ranks.
    """

    def __init__(self, bench: Benchmark) -> None:
        n, self.names = len(bench.words), sorted(set(bench.ids))
        left, rank, order = np.zeros(n, np.int64), np.maximum(bench.words, 0), np.zeros(n, np.int64)
        left[bench.start] = bench.left
        self.wide = bench.longest + 1
        # the least item id, then the earliest place in it
        number = np.searchsorted(np.array(self.names, object), np.array(bench.ids, object)) if bench.ids else np.zeros(0, np.int64)
        first = bench.start[np.searchsorted(bench.item, np.arange(len(bench.ids)))]
        order[bench.start] = number[bench.item] * self.wide + bench.start - first[bench.item]
        self.ranks, self.pairs, self.known = [rank], [None], [None]
        h, size = 1, len(bench.vocabulary) + 1
        while h < bench.longest:
            after = np.zeros(n, np.int64)
            after[:-h] = np.where(left[:-h] > h, rank[h:], 0)
            values, at, turn = np.unique(rank * size + after, return_index=True, return_inverse=True)
            whole = left[at] >= 2 * h
            # places with no word have rank 0 and come first
            self.pairs.append((values[whole], size))
            self.known.append(np.flatnonzero(whole))
            rank = turn.astype(np.int64)
            self.ranks.append(rank)
            h, size = 2 * h, len(values) + 1
        self.array = np.argsort(rank, kind="stable")
        self.order = order[self.array]

    def levels(self, known: np.ndarray) -> list[np.ndarray]:
        """Ranks of the runs of 1, 2, 4 ... words from the words of documents; 0 where the benchmark has no such run."""
        out, h = [np.maximum(known, 0)], 1
        for pairs, ranks in zip(self.pairs[1:], self.known[1:]):
            values, size = pairs
            before, now = out[-1], np.zeros(len(known), np.int64)
            at = np.flatnonzero((before[:-h] > 0) & (before[h:] > 0)) if h < len(before) else np.zeros(0, np.int64)
            if not len(at) or not len(values):
                break
            key = before[at] * size + before[at + h]
            spot = np.minimum(np.searchsorted(values, key), len(values) - 1)
            same = values[spot] == key
            now[at[same]] = ranks[spot[same]]
            if not same.any():
                break
            out.append(now)
            h *= 2
        return out

    def longest(self, known: np.ndarray, doc: np.ndarray, n_docs: int, least: int) -> list[tuple[int, int, int, int]]:
        """(document, words, place, order) of the longest run of at least ``least`` words that each document shares with an item."""
        levels = self.levels(known)
        top = np.full(n_docs, -1, np.int64)
        for k, ranks in enumerate(levels):
            top[doc[ranks > 0]] = k
        # a longest match begins with a longest run of 2 ** k words
        at = np.concatenate([x[top[doc[x]] == k] for k, ranks in enumerate(levels) if 2 ** (k + 1) > least for x in [np.flatnonzero(ranks)]] or [np.zeros(0, np.int64)])
        if not len(at):
            return []
        lo, hi, length = np.zeros(len(at), np.int64), np.full(len(at), len(self.array), np.int64), np.zeros(len(at), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            there = at + length
            run = np.where(there < len(known), levels[k][np.minimum(there, len(known) - 1)], 0)
            live = np.flatnonzero(run)
            a = self._bound(k, lo[live], hi[live], length[live], run[live], False)
            b = self._bound(k, a, hi[live], length[live], run[live], True)
            some = b > a
            live = live[some]
            lo[live], hi[live] = a[some], b[some]
            length[live] += 1 << k
        by = np.lexsort((at, -length, doc[at]))
        by = by[np.r_[True, doc[at[by[1:]]] != doc[at[by[:-1]]]]]
        least_of: dict[tuple[int, int], int] = {}
        out = []
        for i in by.tolist():
            if length[i] >= least:
                span = int(lo[i]), int(hi[i])
                if span not in least_of:
                    least_of[span] = int(self.order[span[0] : span[1]].min())
                out.append((int(doc[at[i]]), int(length[i]), int(at[i]), least_of[span]))
        return out

    def _bound(self, k: int, lo: np.ndarray, hi: np.ndarray, length: np.ndarray, run: np.ndarray, right: bool) -> np.ndarray:
        """Within lo..hi, where all have the same ``length`` words, the first place whose next 2 ** k words aren't before (right: are after) the run."""
        lo, hi, ranks = lo.copy(), hi.copy(), self.ranks[k]
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            ours = ranks[self.array[mid] + length[open_]]
            up = ours <= run[open_] if right else ours < run[open_]
            lo[open_[up]] = mid[up] + 1
            hi[open_[~up]] = mid[~up]
        return lo


def suffix_array(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The positions ``at``, sorted by the up to ``depth`` or more words from each; by prefix doubling."""
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    h = 1
    while h < depth:
        after = np.zeros(len(rank), np.int64)
        after[:-h] = rank[h:] + 1
        values, rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)
        h *= 2
        if len(values) == len(rank):
            break
    return at[np.argsort(rank[at], kind="stable")]


def search(words: np.ndarray, array: np.ndarray, query: np.ndarray, start: np.ndarray, length: np.ndarray, right: bool) -> np.ndarray:
    """For each query suffix, cut to ``length`` words, the first place in the array that isn't smaller (right: that is larger)."""
    lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(array), np.int64)
    most = int(length.max()) if len(length) else 0
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        order = np.zeros(len(open_), np.int8)  # of the array's suffix against the query
        live = np.arange(len(open_))
        for j in range(most):
            live = live[(order[live] == 0) & (length[open_[live]] > j)]
            if not live.size:
                break
            ours = words[np.minimum(array[mid[live]] + j, len(words) - 1)]
            order[live] = np.sign(ours - query[start[open_[live]] + j])
        up = order <= 0 if right else order < 0
        lo[open_[up]] = mid[up] + 1
        hi[open_[~up]] = mid[~up]
    return lo


def judge(texts: list[bytes], bench: Benchmark, longest: bool = True) -> list[dict]:
    """Per text: number of words, covered ranges as (start, end), the items that occur and the longest match."""
    tokens = b" | ".join(t.translate(ALNUM) for t in texts).split()
    get = bench.vocabulary.get
    known = np.fromiter((get(t, 0) for t in tokens), np.int64, len(tokens))
    cuts = np.r_[-1, np.flatnonzero(known == -1), len(known)]
    rows = [{"n_words": int(b - a - 1), "ranges": [], "items": [], "longest": 0, "longest_item": None, "longest_at": None, "item_at": None} for a, b in zip(cuts, cuts[1:])]
    if longest and bench.floor and (known > 0).any():
        doc = np.maximum(np.searchsorted(cuts, np.arange(len(known)), side="left") - 1, 0)
        for d, length, at, order in bench.index.longest(known, doc, len(rows), bench.floor):
            item, place = divmod(order, bench.index.wide)
            rows[d] |= {"longest": length, "longest_item": bench.index.names[item], "longest_at": at - int(cuts[d]) - 1, "item_at": place}
    inside = known > 0
    edges = np.diff(np.r_[False, inside, False].astype(np.int8))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not (bench.shortest and (keep := end - begin >= bench.shortest).any()):
        return rows
    begin, end = begin[keep], end[keep]
    runs = end - begin
    # the runs side by side, a zero after each; where[i] is the word's place in the shard
    offset = np.cumsum(runs + 1) - runs - 1
    flat = np.zeros(int((runs + 1).sum()), np.int64)
    step = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    place, source = np.repeat(offset, runs) + step, np.repeat(begin, runs) + step
    flat[place] = known[source]
    where = np.zeros(len(flat), np.int64)
    where[place] = source
    array = suffix_array(flat, place, int(bench.need.max()))
    doc = np.searchsorted(cuts, where, side="left") - 1

    # a suffix whose first two words aren't side by side in the shard needs no search
    beside = np.unique(flat[:-1] * (len(bench.vocabulary) + 1) + flat[1:])
    asked = np.flatnonzero(bench.need)
    spot = np.minimum(np.searchsorted(beside, bench.two[asked]), len(beside) - 1)
    asked = asked[(bench.need[asked] == 1) | (beside[spot] == bench.two[asked])]
    start, need = bench.start[asked], bench.need[asked]
    lo = search(flat, array, bench.words, start, need, False)
    hi = search(flat, array, bench.words, start, need, True)
    count = hi - lo
    which = np.repeat(np.arange(len(asked)), count)
    found = array[np.repeat(lo, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)]
    if len(found):
        cover = np.zeros(len(known) + 1, np.int64)
        np.add.at(cover, where[found], 1)
        np.add.at(cover, where[found] + need[which], -1)
        edge = np.diff(np.r_[False, np.cumsum(cover[:-1]) > 0, False].astype(np.int8))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            d = int(np.searchsorted(cuts, a)) - 1
            rows[d]["ranges"].append((a - int(cuts[d]) - 1, b - int(cuts[d]) - 1))
        pairs = np.unique(doc[found] * len(bench.ids) + bench.item[asked[which]])
        for d, i in zip((pairs // len(bench.ids)).tolist(), (pairs % len(bench.ids)).tolist()):
            rows[d]["items"].append(bench.ids[i])
    return rows


def _blocks(benchmark: DataFrame, window: int, block_bytes: int):
    """The benchmark in parts of bounded size, each built on the driver."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").dropna()
    words = F.size(F.regexp_extract_all("text", F.lit(WORD), 0))
    size, floor = items.agg(F.sum(F.octet_length("text")), F.min(F.when(words > 0, F.least(words, F.lit(window))))).first()
    n = max(1, -(-(size or 0) // block_bytes))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        bench = Benchmark(sorted((r.item_id, r.text.encode()) for r in part.toLocalIterator()), window)
        bench.floor = floor or 0  # of all blocks, so that their number changes no result
        yield k == n - 1, bench


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long, longest_item string, longest_at long, item_at long"
_STARTS, _ENDS = "__starts", "__ends"
_CARRIED = "doc_id long, text string, starts array<long>, ends array<long>, items array<string>, longest long, longest_item string, longest_at long, item_at long"


def _place(row: dict) -> tuple:
    """The longest match first; of equal ones that which begins first, then the least item id and place in it."""
    return (-row["longest"], row["longest_at"] or 0, row["longest_item"] or "", row["item_at"] or 0)


def _merged(part: pa.RecordBatch, bench: Benchmark, longest: bool) -> list[dict]:
    rows = judge(as_bytes(part.column("text")), bench, longest)
    if "starts" in part.schema.names:
        for row, old in zip(rows, part.drop_columns(["text"]).to_pylist()):
            row["ranges"] += zip(old["starts"], old["ends"])
            row["items"] += old["items"]
            if _place(old) < _place(row):
                row |= {k: old[k] for k in ("longest", "longest_item", "longest_at", "item_at")}
    return rows


def report(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, longest: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: covered words, items that occur, the verdict, and its longest verbatim match.

    A document is contaminated if ``share`` times its covered words are at least its words, and any is covered.
    ``longest_match`` is in words, from word ``longest_at`` of the document and word ``item_at`` of the item: the longest run of words that the
    document shares with any item, if it has at least the words of the benchmark's shortest window. Of equal ones it is the first of the
    document, then that of the least item id and place.
    """
    current = docs.select("doc_id", "text")

    def last(part: pa.RecordBatch, bench: Benchmark) -> dict:
        rows = _merged(part, bench, longest)
        n_hit = [sum(b - a for a, b in _joined(r["ranges"])) for r in rows]
        items = [set(r["items"]) for r in rows]
        return {
            "doc_id": part.column("doc_id"), "n_words": [r["n_words"] for r in rows], "n_hit": n_hit, "n_items": [len(x) for x in items], "items_sha256": [_digest(x) for x in items],
            "contaminated": [h > 0 and share * h >= r["n_words"] for h, r in zip(n_hit, rows)],
            "longest_match": [r["longest"] for r in rows], "longest_item": [r["longest_item"] for r in rows], "longest_at": [r["longest_at"] for r in rows], "item_at": [r["item_at"] for r in rows],
        }

    def carry(part: pa.RecordBatch, bench: Benchmark) -> dict:
        rows = _merged(part, bench, longest)
        ranges = [_joined(r["ranges"]) for r in rows]
        return {
            "doc_id": part.column("doc_id"), "text": part.column("text"), "starts": [[a for a, _ in x] for x in ranges], "ends": [[b for _, b in x] for x in ranges], "items": [sorted(set(r["items"])) for r in rows],
            "longest": [r["longest"] for r in rows], "longest_item": [r["longest_item"] for r in rows], "longest_at": [r["longest_at"] for r in rows], "item_at": [r["item_at"] for r in rows],
        }

    for is_last, bench in _blocks(benchmark, window, block_bytes):
        if is_last:
            return map_slices(current, lambda part, bench=bench: last(part, bench), REPORT, limit=SHARD_BYTES)
        current = scratch.table(map_slices(current, lambda part, bench=bench: carry(part, bench), _CARRIED, limit=SHARD_BYTES), "decontaminate")
    raise AssertionError("there is always a last block")


def remove(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all columns unchanged, without the contaminated ones; no shuffle.

    Between blocks, whole rows are carried with their covered ranges, so each row is judged alone whatever its id; a row that is
    contaminated already isn't carried on, as more blocks only cover more of it.
    """
    covered = pa.list_(pa.int64())

    def pass_over(bench: Benchmark, is_last: bool):
        def run(batches):
            for part in slices(batches, limit=SHARD_BYTES):
                rows = judge(as_bytes(part.column("text")), bench, longest=False)
                if _STARTS in part.schema.names:
                    for row, a, b in zip(rows, part.column(_STARTS).to_pylist(), part.column(_ENDS).to_pylist()):
                        row["ranges"] += zip(a, b)
                    part = part.drop_columns([_STARTS, _ENDS])
                ranges = [_joined(r["ranges"]) for r in rows]
                hits = [sum(b - a for a, b in x) for x in ranges]
                if not is_last:
                    part = part.append_column(_STARTS, pa.array([[a for a, _ in x] for x in ranges], covered)).append_column(_ENDS, pa.array([[b for _, b in x] for x in ranges], covered))
                yield part.filter(pa.array([not (h > 0 and share * h >= r["n_words"]) for h, r in zip(hits, rows)]))

        return run

    current, carried = docs, StructType([*docs.schema.fields, *StructType.fromDDL(f"{_STARTS} array<long>, {_ENDS} array<long>").fields])
    for is_last, bench in _blocks(benchmark, window, block_bytes):
        out = current.mapInArrow(pass_over(bench, is_last), docs.schema if is_last else carried)
        if is_last:
            return out
        current = scratch.table(out, "decontaminate")
    raise AssertionError("there is always a last block")
