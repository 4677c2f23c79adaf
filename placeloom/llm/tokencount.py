"""Edit-aware token counts: segment trees of pre-tokens that re-encode only what an edit touches.

A document's pre-tokens are kept in runs of up to ``RUN``, each with its text, lengths and token counts, under a
segment tree of (characters, tokens) sums. An edit descends to its place, goes back to the last boundary that the
edit can't have moved (``MARGIN`` characters before it, more than the pattern ever looks ahead), pre-tokenises from there, and stops at
the first new boundary behind the edit that was one before: from equal boundaries on, equal text splits alike. Only the pre-tokens between are
encoded again; their runs' sums are updated along the paths to the root. The tree is laid out anew when a run outgrows
four times its size.

Counts are those of the byte-level BPE whose rank file is named by ``vocabulary``; it is read on the driver and
broadcast (its size is fixed by the tokenizer, about 1 MB). ``count`` builds trees and applies edits in one pass over the
documents; ``build`` and ``apply`` keep trees in a table between batches of edits.

Defined edge results: a null text is empty, with no tokens; places beyond the text's end mean its end, negative ones its
start; null edits do nothing; removed counts below zero remove nothing; repeated rows are counted one by one.
"""

from __future__ import annotations

import base64
import os
import sys
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import map_slices

VOCABULARY = os.environ.get("PLACELOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the pattern that goes with the rank file, white space spelled as the property.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
RUN = 64
MARGIN = 4
#: Pre-tokens whose counts a worker remembers.
REMEMBERED = 500_000


class Counter:
    """Tokens of a pre-token, remembered."""

    def __init__(self, ranks: bytes) -> None:
        self.split = regex.compile(PATTERN).findall
        self.scan = regex.compile(PATTERN).match
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known, encode = self.known, self.encoding.encode_ordinary
        if len(known) > REMEMBERED:
            known.clear()
        out = [known.get(p, 0) for p in pieces]
        if 0 in out:
            for i, n in enumerate(out):
                if not n:
                    out[i] = known[pieces[i]] = len(encode(pieces[i]))
        return out


class Tree:
    """A document's pre-tokens in runs, and sums over the runs: node i has children 2i and 2i + 1."""

    def __init__(self, counter: Counter, runs: list[list]) -> None:
        self.counter = counter
        self._lay(runs)

    @classmethod
    def of(cls, counter: Counter, text: str) -> Tree:
        pieces = counter.split(text)
        counts = counter.counts(pieces)
        return cls(counter, [["".join(p := pieces[i : i + RUN]), [len(x) for x in p], counts[i : i + RUN]] for i in range(0, len(pieces), RUN)])

    def _lay(self, runs: list[list]) -> None:
        self.runs = runs or [["", [], []]]
        self.width = 1 << (len(self.runs) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (text, _, counts) in enumerate(self.runs):
            self.chars[self.width + i], self.tokens[self.width + i] = len(text), sum(counts)
        for i in range(self.width - 1, 0, -1):
            self.chars[i], self.tokens[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _update(self, i: int) -> None:
        text, _, counts = self.runs[i]
        at = self.width + i
        self.chars[at], self.tokens[at] = len(text), sum(counts)
        while at := at >> 1:
            self.chars[at], self.tokens[at] = self.chars[2 * at] + self.chars[2 * at + 1], self.tokens[2 * at] + self.tokens[2 * at + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(r[0] for r in self.runs)

    def find(self, place: int) -> tuple[int, int]:
        """The run that holds the character at ``place`` (the last run for the end), and where the run starts."""
        at, start = 1, 0
        while at < self.width:
            at *= 2
            if place >= start + self.chars[at] and at + 1 < 2 * self.width and self.chars[at + 1]:
                start += self.chars[at]
                at += 1
        return min(at - self.width, len(self.runs) - 1), start

    def edit(self, start: int, removed: int, inserted: str) -> int:
        """Replace ``removed`` characters from ``start``; returns how many pre-tokens were encoded again."""
        start = min(max(start, 0), self.n_chars)
        removed = min(max(removed, 0), self.n_chars - start)
        if not removed and not inserted:
            return 0
        first, run_start = self.find(max(0, start - MARGIN))
        kept, at = 0, run_start  # pre-tokens of the first run that stay
        for n in self.runs[first][1]:
            if at + n > start - MARGIN:
                break
            at, kept = at + n, kept + 1
        last, old_end = first, run_start + len(self.runs[first][0])
        old = self.runs[first][0][at - run_start :]
        shift = len(inserted) - removed
        while True:
            while last + 1 < len(self.runs) and old_end < start + removed + MARGIN:
                last += 1
                old += self.runs[last][0]
                old_end += len(self.runs[last][0])
            ended = last + 1 >= len(self.runs) or all(not r[0] for r in self.runs[last + 1 :])
            text = old[: start - at] + inserted + old[start + removed - at :]
            # old boundaries behind the edit, in new places
            bounds, place = {}, run_start
            for i in range(first, last + 1):
                for j, n in enumerate(self.runs[i][1]):
                    if place >= start + removed:
                        bounds[place + shift - at] = (i, j)
                    place += n
            pieces, here, meets = [], 0, None
            while here < len(text):
                if here in bounds and here >= start - at + len(inserted):
                    meets = bounds[here]
                    break
                stop = self.counter.scan(text, here).end()
                if not ended and stop > len(text) - MARGIN:
                    break
                pieces.append(text[here:stop])
                here = stop
            if meets or ended or here >= len(text):
                break
            last += 1
            old += self.runs[last][0]
            old_end += len(self.runs[last][0])
        counts = self.counter.counts(pieces)
        head = self.runs[first]
        lengths, numbers = head[1][:kept], head[2][:kept]
        left = head[0][: at - run_start] + "".join(pieces)
        lengths = lengths + [len(p) for p in pieces]
        numbers = numbers + counts
        if meets:
            i, j = meets
            rest = self.runs[i]
            skip = sum(rest[1][:j])
            if i == first:
                left, lengths, numbers = left + rest[0][skip:], lengths + rest[1][j:], numbers + rest[2][j:]
            else:
                self.runs[i] = [rest[0][skip:], rest[1][j:], rest[2][j:]]
                self._update(i)
            stop_run = i
        else:
            stop_run = last + 1
        for i in range(first + 1, stop_run):
            self.runs[i] = ["", [], []]
            self._update(i)
        self.runs[first] = [left, lengths, numbers]
        if len(lengths) > 4 * RUN:
            self._lay([x for r in self.runs for x in _cut(r)])
        else:
            self._update(first)
        return len(pieces)


def _cut(run: list) -> Iterator[list]:
    text, lengths, counts = run
    at = 0
    for i in range(0, len(lengths), RUN):
        n = sum(lengths[i : i + RUN])
        yield [text[at : at + n], lengths[i : i + RUN], counts[i : i + RUN]]
        at += n


def _ranks(docs: DataFrame, vocabulary: str):
    with open(vocabulary, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _counter(ranks) -> Counter:
    """One for each worker process and vocabulary."""
    kept = sys.modules.setdefault("_placeloom_counters", type(sys)("_placeloom_counters")).__dict__.setdefault("kept", {})
    key = hash(ranks.value)
    if key not in kept:
        kept[key] = Counter(ranks.value)
    return kept[key]


EDIT = "struct<start:long,removed:long,inserted:string>"
REPORT = "doc_id long, n_chars long, n_tokens long, n_pretokens long, n_edits long, n_reencoded long, n_chars_after long, n_tokens_after long"


def _applied(tree: Tree, edits: Iterable[dict | None]) -> tuple[int, int]:
    n = again = 0
    for e in edits:
        if e and e["start"] is not None:
            n += 1
            again += tree.edit(e["start"], e["removed"] or 0, e["inserted"] or "")
    return n, again


def count(docs: DataFrame, edits: Column, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: tokens, and after its ``edits`` (an array of (start, removed, inserted), in order) tokens and work done."""
    ranks = _ranks(docs, vocabulary)

    def run(part: pa.RecordBatch) -> dict:
        counter = _counter(ranks)
        out: dict[str, list] = {k.split()[0]: [] for k in REPORT.split(", ")[1:]}
        for text, todo in zip(part.column("text").to_pylist(), part.column("edits").to_pylist()):
            tree = Tree.of(counter, text or "")
            before = (tree.n_chars, tree.n_tokens, sum(len(r[1]) for r in tree.runs))
            done = _applied(tree, todo or ())
            for k, v in zip(out, (*before, *done, tree.n_chars, tree.n_tokens)):
                out[k].append(v)
        return out | {"doc_id": part.column("doc_id")}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), edits.cast(f"array<{EDIT}>").alias("edits"))
    return map_slices(rows, run, REPORT)


_RUNS = "array<struct<text:string,lengths:array<int>,counts:array<int>>>"


def build(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, runs): trees to keep. One row per document; ids should be unique and not null."""
    ranks = _ranks(docs, vocabulary)

    def run(part: pa.RecordBatch) -> dict:
        trees = [Tree.of(_counter(ranks), t or "") for t in part.column("text").to_pylist()]
        return {"doc_id": part.column("doc_id"), "n_tokens": [t.n_tokens for t in trees], "runs": [[{"text": a, "lengths": b, "counts": c} for a, b, c in t.runs] for t in trees]}

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, f"doc_id long, n_tokens long, runs {_RUNS}")


def apply(trees: DataFrame, edits: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The trees after ``edits`` (doc_id, seq, start, removed, inserted), with ``n_reencoded``.

    A task walks its documents in order, each tree followed by its edits as they come, so a document with any
    number of edits takes the memory of its tree. Edits of unknown documents do nothing.
    """
    ranks = _ranks(trees, vocabulary)
    none = lambda kind: F.lit(None).cast(kind)
    both = trees.select("doc_id", none("long").alias("seq"), "runs", none("long").alias("start"), none("long").alias("removed"), none("string").alias("inserted")).unionByName(
        edits.select("doc_id", F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("seq"), none(_RUNS).alias("runs"), F.col("start").cast("long").alias("start"), F.col("removed").cast("long").alias("removed"), "inserted")
    )

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter, held, tree, again = _counter(ranks), None, None, 0

        def done() -> pd.DataFrame:
            return pd.DataFrame({"doc_id": [held], "n_tokens": [tree.n_tokens], "n_reencoded": [again], "runs": [[{"text": a, "lengths": b, "counts": c} for a, b, c in tree.runs]]})

        for part in parts:
            for row in part.itertuples(index=False):
                if row.runs is not None:
                    if tree is not None:
                        yield done()
                    held, again = row.doc_id, 0
                    tree = Tree(counter, [[r["text"], list(map(int, r["lengths"])), list(map(int, r["counts"]))] for r in row.runs])
                elif tree is not None and row.doc_id == held and row.start == row.start and row.start is not None:
                    again += tree.edit(int(row.start), 0 if row.removed is None or row.removed != row.removed else int(row.removed), row.inserted or "")
        if tree is not None:
            yield done()

    ordered = both.repartition("doc_id").sortWithinPartitions(F.col("doc_id"), F.col("seq").asc_nulls_first())
    return ordered.mapInPandas(run, f"doc_id long, n_tokens long, n_reencoded long, runs {_RUNS}")


def revision() -> Column:
    """The query's edits, from a text's length alone: a replacement at a quarter, a note at half, a cut at three quarters."""
    n = F.coalesce(F.length("text"), F.lit(0))
    one = lambda start, removed, inserted: F.struct(start.cast("long").alias("start"), F.lit(removed).cast("long").alias("removed"), F.lit(inserted).alias("inserted"))
    return F.array(one(F.floor(n / 4), 12, " revised passage"), one(F.floor(n / 2), 0, "\n\n[note 7] "), one(F.floor(3 * n / 4), 20, ""))
