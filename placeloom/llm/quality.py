"""Quality classifier: gradient-boosted trees over histograms of document statistics.

``features`` turns every whole text into a fixed vector of statistics; ``fit`` learns trees on a bounded
sample of labelled rows; ``predict`` walks all trees at once over flat arrays. Only statistics of the text
are inputs of a score: never labels, language, source or id.

The sample is the documented bound ``SAMPLE``: the labelled rows that are not held out, in the order of a
hash of their id, up to that many. Everything else covers all rows.

Defined edge results: a null text counts as empty and is scored as such; a null id is never held out and
never labelled; labels that are null are ignored; of several labels of one id each is a row; repeated documents are
scored one by one; with no label of one of the classes the score is the share of the other (0.5 with none).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch
from .texts import as_bytes, map_slices, slices

SAMPLE = 20_000
BINS = 64
THRESHOLD = 0.7

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_sd", "distinct_words", "top_word", "pairs_repeated", "windows_repeated",
    "log_lines", "words_a_line", "lines_repeated", "lines_ended", "lines_short", "upper", "capital_words", "digit", "punctuation", "symbol", "bar", "bang",
    "non_ascii", "words_plain", "entropy", "symbol_words", "lines_shouted",
)


def _span(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER, _DIGIT = _span("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _span("0123456789")
_SYMBOL, _PUNCTUATION = _span("#*$%&|<>@^~=+\\_{}[]/"), _span(".,;:'\"()-?!")
_ODD = _span("#*$%&|<>!")
_KEEP = bytes(b if _ODD[b] else 0x20 for b in range(256))


def statistics(text: bytes) -> list[float]:
    """The values of FEATURES for one whole text."""
    n = len(text)
    words = text.split()
    k = len(words)
    if not k:
        return [math.log1p(n)] + [0.0] * (len(FEATURES) - 1)
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    solid = n - int(hist[0x20]) - int(hist[0x09:0x0E].sum())
    p = hist[hist > 0] / n
    lengths = np.fromiter(map(len, words), np.int64, k)
    count: dict[bytes, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    windows = len(set(zip(words, words[1:], words[2:], words[3:], words[4:])))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    m = len(lines)
    odd = len(text.translate(_KEEP).split())
    return [
        math.log1p(n), math.log1p(k), solid / k, float(lengths.std()), len(count) / k, max(count.values()) / k, 1 - pairs / max(1, k - 1), 1 - windows / (k - 4) if k > 4 else 0.0,
        math.log1p(m), k / m, 1 - len(set(lines)) / m, sum(x[-1:] in b".!?" for x in lines) / m, sum(len(x) < 20 for x in lines) / m,
        float(hist[_UPPER].sum()) / solid, sum(w[:1].isupper() for w in words) / k, float(hist[_DIGIT].sum()) / solid, float(hist[_PUNCTUATION].sum()) / solid, float(hist[_SYMBOL].sum()) / solid,
        float(hist[0x7C]) / k, float(hist[0x21]) / k, float(hist[0x80:].sum()) / solid, sum(map(bytes.isalpha, words)) / k, float(-(p * np.log2(p)).sum()), odd / k, sum(map(bytes.isupper, lines)) / m,
    ]


FEATURES_SCHEMA = "doc_id long, x array<float>"


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""

    def run(part: pa.RecordBatch) -> dict:
        return {"doc_id": part.column("doc_id"), "x": [statistics(t) for t in as_bytes(part.column("text"))]}

    return map_slices(docs.select("doc_id", "text"), run, FEATURES_SCHEMA)


@dataclass
class Forest:
    """Trees as flat arrays. A leaf points at itself, so every row takes ``depth`` steps in every tree."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 for each row, all trees side by side."""
        out = np.full(len(x), self.base)
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                node = np.where(part[rows, self.feature[node]] <= self.limit[node], self.left[node], self.right[node])
            out[a : a + 4096] += self.value[node].sum(1)
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, least: float = 2.0, penalty: float = 1.0) -> Forest:
    """Boosting on the logistic loss; each level's splits come from one histogram over (node, feature, bin)."""
    n, k = x.shape if x.size else (0, len(FEATURES))
    share = float(y.mean()) if n else 0.5
    base = math.log((share + 1e-3) / (1 - share + 1e-3))
    feature, limit, left, right, value, roots = [], [], [], [], [], []
    if n and 0 < share < 1:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(k)]
        bins = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(k)], 1)
        width = BINS
        at = bins + np.arange(k) * width
        raw = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            first = len(feature)
            roots.append(first)
            open_, node = [first], np.zeros(n, np.int64)
            for a in (feature, limit, left, right, value):
                a.append(0)
            for level in range(depth + 1):
                m = len(open_)
                live = node >= 0
                total_g, total_h = (np.bincount(node[live], weights=v[live], minlength=m) for v in (g, h))
                for i, at_node in enumerate(open_):
                    left[at_node] = right[at_node] = at_node
                    value[at_node] = -rate * total_g[i] / (total_h[i] + penalty)
                if level == depth:
                    break
                place = (node[live, None] * (k * width) + at[live]).ravel()
                sum_g, sum_h = (np.bincount(place, weights=np.repeat(v[live], k), minlength=m * k * width).reshape(m, k, width).cumsum(2) for v in (g, h))
                rest_g, rest_h = total_g[:, None, None] - sum_g, total_h[:, None, None] - sum_h
                gain = sum_g**2 / (sum_h + penalty) + rest_g**2 / (rest_h + penalty) - (total_g**2 / (total_h + penalty))[:, None, None]
                gain[(sum_h < least) | (rest_h < least)] = 0
                best = gain.reshape(m, -1).argmax(1)
                child = np.full((m, 2), -1)
                following: list[int] = []
                for i, at_node in enumerate(open_):
                    j, b = divmod(int(best[i]), width)
                    if gain[i, j, b] <= 1e-9 or b >= len(edges[j]):
                        continue
                    feature[at_node], limit[at_node] = j, float(edges[j][b])
                    for side in (0, 1):
                        child[i, side] = len(following)
                        following.append(len(feature))
                        for a in (feature, limit, left, right, value):
                            a.append(0)
                    left[at_node], right[at_node] = following[-2:]
                    value[at_node] = 0
                split_at, split_bin = best // width, best % width
                rows = np.flatnonzero(live)
                went = (bins[rows, split_at[node[rows]]] > split_bin[node[rows]]).astype(np.int64)
                raw_leaf = child[node[rows], went]
                done = raw_leaf < 0
                raw[rows[done]] += np.array([value[i] for i in open_])[node[rows[done]]]
                node[rows] = raw_leaf
                open_ = following
                if not open_:
                    break
            if open_:
                live = node >= 0
                raw[live] += np.array([value[i] for i in open_])[node[live]]
    if not roots:
        feature, limit, left, right, value, roots = [0], [0.0], [0], [0], [0.0], [0]
    return Forest(base, np.array(roots), np.array(feature), np.array(limit, np.float64), np.array(left), np.array(right), np.array(value, np.float64), depth)


def held_out(column: str = "doc_id", of: int = 4, rest: int = 2):
    """Whether crc32 of the id as text leaves that remainder; false for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % of == rest, F.lit(False))


def _chosen(labels: DataFrame, sample: int) -> DataFrame:
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    return known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)


def train(x: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Trees from the labelled rows of ``x`` (doc_id, x) outside the held-out fold, ``sample`` rows at most."""
    rows = x.join(F.broadcast(_chosen(labels, sample)), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "x").limit(sample).select("x", "quality").toPandas()
    if rows.empty:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.stack(rows.x.to_numpy()).astype(np.float64), (rows.quality.to_numpy() > 0).astype(np.float64))


def predict(x: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``x`` with held_out, score and predicted."""

    def run(parts):
        for part in parts:
            score = forest.predict(np.stack(part.x.to_numpy()).astype(np.float64)) if len(part) else np.zeros(0)
            yield pd.DataFrame({"doc_id": part.doc_id, "held_out": part.held_out, "score": score, "predicted": (score >= threshold).astype("int32")})

    return x.select("doc_id", held_out().alias("held_out"), "x").mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Quality of every document; the texts are read once."""
    x = scratch.table(features(docs), "quality")
    return predict(x, train(x, labels, sample), threshold)


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The documents, all columns unchanged, whose score reaches the threshold; no shuffle of texts."""
    chosen = _chosen(labels, sample).select("doc_id").distinct()  # at most ``sample`` ids, so it may be broadcast
    forest = train(features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")), labels, sample)

    def run(batches):
        for part in slices(batches):
            scores = forest.predict(np.array([statistics(t) for t in as_bytes(part.column("text"))], np.float32).astype(np.float64))
            yield part.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(run, docs.schema)
