"""Scoring texts with context-tree weighting over bytes.

Each byte is eight binary decisions. A decision is made in a node: the bits of the byte so far, in the context of
the last d bytes, d from 0 to ``DEPTH``. A node holds how often each bit followed in training, which makes its
Krichevsky-Trofimov estimate; the weighted probability of a node mixes that estimate, by one half, with the product of
its longer contexts' (Willems, Shtarkov and Tjalkens). Training is one batch, so the mixture's weights are those
after all training texts: the share of a node's own estimate is its half over its weighted probability. A decision's probability is then
the sum over depths of estimate times share times what shallower depths left over. A context that training
never saw has no estimate; mixing ends at the longest one it did.

The tree grows with the corpus and is never broadcast. Documents are dealt into blocks; a block sends its distinct
(context, byte) pairs and words, with their counts, to shards by a hash of the last ``NEAR`` bytes of context and of the word. A
shard holds whole subtrees: it weighs all depths from ``NEAR`` on, so a frequent context of two bytes is split over the shards of its 256 longer ones.
Sums per node of the depth above leave it and meet in groups by that node's context, each of which weighs that depth. From sums of the depth above that
again, 65,536 nodes at most, the driver weighs the root's few levels. The shares go down the same way, and each shard then answers every block with an
array of code lengths and counts in the order that it asked in, so no key is sent back. Messages are packed rows; there are half as many shards as blocks,
which they reach through relays where they are many (see ``exchange``), so a shard's messages don't grow with the corpus, but for a three-byte
context's own: these are never split. Held-out texts ask but never count.

The base score is a unigram model of words with 0.1 added to each count, learned from the same texts; words go by two 64-bit hashes.

Defined edge results: a null or empty text is scored as an empty one (the end symbol, one token); a null id is never held out; repeated
rows are scored one by one and count as often as they occur; with no training text every bit has probability one half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks, exchange, scratch
from .recompress import hashed
from .texts import as_bytes, pack, unpack

DEPTH = 5
#: Bytes of context by which pairs are dealt to shards.
NEAR = 3
#: Groups in which the shards' sums meet.
GROUPS = 64
#: Stands before and after each text; no UTF-8 text has it.
EDGE = 0xFF
#: Bytes of text whose pairs are made together; small enough for the arrays to stay in cache.
CHUNK = 1 << 18

_U = np.uint64
_FREE = _U(0xFFFFFFFFFFFFFFFF)  # no pair: its upper bytes are zero
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def pairs(texts: list[bytes], depth: int = DEPTH) -> np.ndarray:
    """For every byte of the texts and the end of each: the ``depth`` bytes before it and itself, as one number."""
    pad = bytes([EDGE]) * depth
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t, bytes([EDGE]))), np.uint8)
    n = len(data) - depth
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(depth + 1):
        out <<= _U(8)
        out |= data[i : n + i]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + depth + 1
    ends = np.cumsum(sizes)[:-1]  # the pads that follow a text are no symbols
    keep = np.ones(n, bool)
    for i in range(depth):
        keep[ends + i - depth] = False
    return out[keep]


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts summed."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def near(depth: int) -> int:
    return min(NEAR, depth)


def place(keys: np.ndarray, depth: int) -> np.ndarray:
    """A hash of the last ``NEAR`` bytes of a pair's context."""
    return mix(((keys >> _U(8)) & _U((1 << 8 * near(depth)) - 1)) + _U(0x9E3779B97F4A7C15))


def counted(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of the texts in order, and how often each occurs."""
    keys, counts, held = [], [], 0
    for a, b in chunks(texts, 4 * CHUNK):
        k = np.sort(pairs(texts[a:b], depth))
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        keys.append(k[first])
        counts.append(np.diff(np.r_[first, len(k)]))
        held += len(first)
        if held > 1 << 21:
            k, c = _summed(np.concatenate(keys), np.concatenate(counts))
            keys, counts, held = [k], [c], 0
    return _summed(np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _by_shard(places: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted keys by shard, then value, and where the shards begin."""
    at = (places % _U(shards)).astype(np.int64)
    return np.argsort(at, kind="stable"), np.cumsum(np.r_[0, np.bincount(at, minlength=shards)])


def _same(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words given by both hashes: where the distinct ones stand, in order, and which of these each is."""
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    new = np.r_[True, a[1:] != a[:-1]][: len(a)]
    if not (new[1:] | (b[1:] == b[:-1])).all():  # two words may share the first
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
    which = np.empty(len(one), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


FAMILIES = {"pairs": (("pairs", "<u8"), ("pair_counts", "<i8")), "words": (("words", "<u8"), ("seconds", "<u8"), ("word_counts", "<i8"))}
RETURNS = {"pairs": (("log_p", "<f8"),), "words": (("counts", "<i8"),)}
ASKED = "shard int, block int, pairs binary, pair_counts binary, words binary, seconds binary, word_counts binary"


def _lowered(part: pa.Table) -> list[bytes]:
    return [t.translate(_LOWER) for t in as_bytes(part.column("text").combine_chunks())]


def ask(part: pa.Table, depth: int, shards: int) -> pa.Table:
    """A block's questions to every shard, with its counts in training texts (0: only asked for)."""
    texts, held = _lowered(part), part.column("held_out").to_pylist()
    (learned, n), (tested, _) = (counted([t for t, h in zip(texts, held) if h == rest], depth) for rest in (False, True))
    keys, counts = _summed(np.concatenate([learned, tested]), np.concatenate([n, np.zeros(len(tested), np.int64)]))
    order, bounds = _by_shard(place(keys, depth), shards)
    words = hashed(texts)
    first, which = _same(words.one, words.two)
    train = np.repeat(~np.array(held, bool), words.counts)
    seen = np.bincount(which[train], minlength=len(first))
    word_order, word_bounds = _by_shard(words.one[first], shards)
    first = first[word_order]
    asked = {"pairs": (bounds, [keys[order], counts[order]]), "words": (word_bounds, [words.one[first], words.two[first], seen[word_order]])}
    return exchange.messages(part.column("block")[0].as_py(), shards, FAMILIES, asked)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series at x + 8; good to 1e-13 of the value from one half on."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    product = x.copy()
    for i in range(1, 8):
        product *= x + i
    return series - np.log(product)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability that the KT estimator gives a sequence of n0 zeros and n1 ones."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


class Level:
    """The nodes of one depth: ``at`` (context, then place in the byte's tree), counts and weights."""

    def __init__(self, at: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None) -> None:
        self.at, self.n0, self.n1 = at, n0, n1
        kt = log_kt(n0.astype(np.float64), n1.astype(np.float64))
        self.pw = kt if below is None else np.logaddexp(kt, below) - math.log(2)
        self.share = np.ones(len(at)) if below is None else 1 / (1 + np.exp(np.minimum(below - kt, 700.0)))
        self.own = (n1 + 0.5) / (n0 + n1 + 1.0)

    def place(self, at: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.at, at), len(self.at) - 1)

    def descend(self, mixed: np.ndarray, rest: np.ndarray) -> None:
        """With what shallower depths gave and left over: the chance of a one if mixing ends here, and for deeper levels."""
        self.p = mixed + rest * self.own
        self.mixed, self.rest = mixed + rest * self.share * self.own, rest * (1 - self.share)


def shallower(at: np.ndarray, depth: int) -> np.ndarray:
    """Node numbers of one depth less: the context's oldest byte goes."""
    return (((at >> _U(8)) & _U((1 << 8 * depth) - 1)) << _U(8)) | (at & _U(0xFF))


def leaves(keys: np.ndarray, counts: np.ndarray) -> Level:
    """The deepest level from distinct pairs in order and their counts."""
    ats, zeros, ones = [], [], []
    context, symbol = keys >> _U(8), keys & _U(0xFF)
    for i in range(8):
        at = (context << _U(8)) | _U(1 << i) | (symbol >> _U(8 - i))
        bit = ((symbol >> _U(7 - i)) & _U(1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        one = np.add.reduceat(counts * bit, first)
        ats.append(at[first])
        ones.append(one)
        zeros.append(np.add.reduceat(counts, first) - one)
    at = np.concatenate(ats)
    order = np.argsort(at, kind="stable")
    return Level(at[order], np.concatenate(zeros)[order], np.concatenate(ones)[order], None)


def above(level: Level, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Node numbers of ``depth``, one less than the level's, with counts and weighted log probabilities summed."""
    at, group = np.unique(shallower(level.at, depth), return_inverse=True)
    total = lambda x: np.bincount(group, weights=x, minlength=len(at))
    return at, total(level.n0).astype(np.int64), total(level.n1).astype(np.int64), total(level.pw)


def subtree(keys: np.ndarray, counts: np.ndarray, depth: int) -> list[Level]:
    """Levels from ``near(depth)`` to ``depth`` of distinct pairs in order, counts above 0."""
    out = [leaves(keys, counts)]
    for d in range(depth - 1, near(depth) - 1, -1):
        out.insert(0, Level(*above(out[0], d)))
    return out


class Top:
    """The levels above the groups', from their sums: dense by (context, node), 65,536 values at most."""

    def __init__(self, sums: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], depth: int) -> None:
        self.last = near(depth) - 2
        size = 1 << 8 * (max(self.last, 0) + 1)
        self.p, self.mixed, self.rest = np.full(size, 0.5), np.zeros(size), np.ones(size)
        if not len(sums[0]):
            return
        levels = [Level(*sums)]
        for d in range(self.last - 1, -1, -1):
            levels.insert(0, Level(*above(levels[0], d)))
        levels[0].descend(np.zeros(len(levels[0].at)), np.ones(len(levels[0].at)))
        for d, (up, down) in enumerate(zip(levels, levels[1:])):
            at = up.place(shallower(down.at, d))
            down.descend(up.mixed[at], up.rest[at])
        every = np.arange(size, dtype=np.uint64)
        for d, level in enumerate(levels):  # the deepest that training saw
            here = shallower(every, d) if d < self.last else every
            at = level.place(here)
            hit = level.at[at] == here
            self.p[hit] = level.p[at[hit]]
        at = levels[-1].at.astype(np.int64)
        self.mixed[at], self.rest[at] = levels[-1].mixed, levels[-1].rest

    def over(self, at: np.ndarray) -> np.ndarray:
        """Where the nodes above those of the groups' depth stand; with contexts of one byte at most there are none, and all has its initial value."""
        return (shallower(at, self.last) if self.last >= 0 else at & _U(0xFF)).astype(np.int64)


def middle(keys: np.ndarray, depth: int) -> np.ndarray:
    """Node numbers of the groups' depth, one less than the shards', that the pairs meet, in order."""
    short = np.unique(keys & _U((1 << 8 * near(depth)) - 1))
    context, symbol = short >> _U(8), short & _U(0xFF)
    return np.unique(np.concatenate([(context << _U(8)) | _U(1 << i) | (symbol >> _U(8 - i)) for i in range(8)]))


def _by_group(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of nodes by group, then number, and where the groups begin."""
    return _by_shard(mix((at >> _U(8)) + _U(0x9E3779B97F4A7C15)), GROUPS)


def code(keys: np.ndarray, counts: np.ndarray, depth: int, mid: tuple[np.ndarray, ...]) -> np.ndarray:
    """log10 of the model's probability of each pair's byte in its context; distinct pairs in order, unseen ones with count 0.

    ``mid``: nodes of the depth above the shards' in order, with the chance of a one if mixing ends there, and for deeper levels.
    """
    over, p_over, mixed, rest = mid
    seen = counts > 0
    levels = subtree(keys[seen], counts[seen], depth) if seen.any() else []
    if levels:
        at = np.searchsorted(over, shallower(levels[0].at, near(depth) - 1))
        levels[0].descend(mixed[at], rest[at])
        for d, (up, down) in enumerate(zip(levels, levels[1:]), near(depth)):
            at = up.place(shallower(down.at, d))
            down.descend(up.mixed[at], up.rest[at])
    context, symbol = keys >> _U(8), keys & _U(0xFF)
    new = np.flatnonzero(~seen)
    short = (context[new] & _U((1 << 8 * (near(depth) - 1)) - 1)) << _U(8)
    out, p = np.zeros(len(keys)), np.zeros(len(keys))
    for i in range(8):
        node = _U(1 << i) | (symbol >> _U(8 - i))
        if levels:  # all of a seen pair's nodes are in the deepest level
            p[seen] = levels[-1].p[levels[-1].place((context[seen] << _U(8)) | node[seen])]
        p[new] = p_over[np.searchsorted(over, short | node[new])]
        for d, level in enumerate(levels, near(depth)):  # unseen ones may share nodes with them
            here = ((context[new] & _U((1 << 8 * d) - 1)) << _U(8)) | node[new]
            at = level.place(here)
            hit = level.at[at] == here
            p[new[hit]] = level.p[at[hit]]
        out += np.log10(np.where((symbol >> _U(7 - i)) & _U(1), p, 1 - p))
    return out


def _messages(part: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Pairs of each message, and all distinct ones with their summed counts."""
    each = [unpack(x, "<u8") for x in part.column("pairs").to_pylist()]
    counts = [unpack(x, "<i8") for x in part.column("pair_counts").to_pylist()]
    return each, *_summed(np.concatenate(each), np.concatenate(counts))


def _word_totals(part: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray]:
    """How many words each message has, which of the distinct ones each word is, and these ones' summed counts."""
    one, two, counts = ([unpack(x, kind) for x in part.column(c).to_pylist()] for c, kind in FAMILIES["words"])
    first, which = _same(np.concatenate(one), np.concatenate(two))
    total = np.zeros(len(first), np.int64)
    np.add.at(total, which, np.concatenate(counts))
    return list(map(len, one)), which, total


SUMS = "shard int, part int, at binary, n0 binary, n1 binary, pw binary, tokens long, distinct long"


def shard_sums(part: pa.Table, depth: int) -> pa.Table:
    """A shard's nodes of the depth above its own, those it has only been asked for with counts of 0, by group; its words' total and number in group -1."""
    _, keys, counts = _messages(part)
    at = middle(keys, depth)
    n0, n1, pw = (np.zeros(len(at), kind) for kind in ("<i8", "<i8", "<f8"))
    keys, counts = keys[counts > 0], counts[counts > 0]
    if len(keys):
        live, *sums = above(subtree(keys, counts, depth)[0], near(depth) - 1)
        for out, x in zip((n0, n1, pw), sums):
            out[np.searchsorted(at, live)] = x
    order, bounds = _by_group(at)
    asked = [g for g in range(GROUPS) if bounds[g] < bounds[g + 1]]
    total = _word_totals(part)[2]
    packed = [[None] + [pack(x[order][bounds[g] : bounds[g + 1]]) for g in asked] for x in (at, n0, n1, pw)]
    shard = part.column("shard")[0].as_py()
    return pa.table({
        "shard": pa.array([shard] * (len(asked) + 1), pa.int32()), "part": pa.array([-1, *asked], pa.int32()), **{c: pa.array(x, pa.binary()) for c, x in zip(("at", "n0", "n1", "pw"), packed)},
        "tokens": pa.array([int(total.sum())] + [0] * len(asked), pa.int64()), "distinct": pa.array([int((total > 0).sum())] + [0] * len(asked), pa.int64()),
    })


def _group(part: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, Level | None, np.ndarray]:
    """Sizes of a group's messages, which of its distinct nodes each of theirs is, these nodes, the level of those that training saw, and where these stand."""
    each, *sums = ([unpack(x, kind) for x in part.column(c).to_pylist()] for c, kind in (("at", "<u8"), ("n0", "<i8"), ("n1", "<i8"), ("pw", "<f8")))
    at, which = np.unique(np.concatenate(each), return_inverse=True)
    n0, n1, pw = (np.bincount(which, weights=np.concatenate(x), minlength=len(at)) for x in sums)
    live = np.flatnonzero(n0 + n1 > 0)
    level = Level(at[live], n0[live].astype(np.int64), n1[live].astype(np.int64), pw[live]) if len(live) else None
    return list(map(len, each)), which, at, level, live


TOPS = "at long, n0 long, n1 long, pw double"


def group_sums(part: pa.Table, depth: int) -> pa.Table:
    """A group's sums for the depth above its own."""
    level = _group(part)[3]
    if level is None or near(depth) < 2:
        return pa.table({c: pa.array([], pa.float64() if c == "pw" else pa.int64()) for c in exchange.names(TOPS)})
    at, n0, n1, pw = above(level, near(depth) - 2)
    return pa.table({"at": at.astype(np.int64), "n0": n0, "n1": n1, "pw": pw})


GIVEN = "shard int, part int, p binary, mixed binary, rest binary"


def group_answers(part: pa.Table, top: Top) -> pa.Table:
    """For each shard that asked: its nodes' chances of a one, what they mixed and left over, in its order."""
    sizes, which, at, level, live = _group(part)
    over = top.over(at)
    p, mixed, rest = top.p[over], top.mixed[over], top.rest[over]
    if level is not None:
        level.descend(mixed[live], rest[live])
        p[live], mixed[live], rest[live] = level.p, level.mixed, level.rest
    cuts = np.cumsum(sizes)[:-1]
    packed = {c: pa.array([pack(x) for x in np.split(v[which], cuts)], pa.binary()) for c, v in (("p", p), ("mixed", mixed), ("rest", rest))}
    return pa.table({"shard": part.column("shard"), "part": part.column("part"), **packed})


ANSWER = "block int, shard int, log_p binary, counts binary"


def answer(part: pa.Table, given: pa.Table, depth: int, shards: int) -> pa.Table:
    """For each block that asked: the code lengths of its pairs and the counts of its words, in its order."""
    each, keys, counts = _messages(part)
    at = middle(keys, depth)
    order, _ = _by_group(at)
    given = given.take(pa.array(np.argsort(given.column("part").to_numpy(), kind="stable")))
    values = [np.zeros(len(at)) for _ in range(3)]
    for out, c in zip(values, ("p", "mixed", "rest")):
        out[order] = np.concatenate([np.zeros(0), *(unpack(x, "<f8") for x in given.column(c).to_pylist())])
    log_p = code(keys, counts, depth, (at, *values))
    sizes, which, total = _word_totals(part)
    told = [pack(log_p[np.searchsorted(keys, k)]) for k in each]
    numbers = [pack(x) for x in np.split(total[which], np.cumsum(sizes)[:-1])]
    out = pa.table({"block": part.column("block"), "shard": part.column("shard"), "log_p": pa.array(told, pa.binary()), "counts": pa.array(numbers, pa.binary())})
    return exchange.tagged(out, part, shards, ANSWER, FAMILIES)


class Lookup:
    """Values of given distinct numbers, in a table with open addressing: two vectorised gathers from one place."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        self.key, self.value = np.full(1 << bits, _FREE), np.zeros(1 << bits)
        at = self._home(keys)
        while len(keys):
            free = self.key[at] == _FREE
            self.key[at[free]] = keys[free]
            mine = self.key[at] == keys
            self.value[at[mine]] = values[mine]
            keys, values, at = keys[~mine], values[~mine], (at[~mine] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Each key's value; all must be there."""
        at = self._home(keys)
        wrong = np.flatnonzero(self.key[at] != keys)
        while wrong.size:
            at[wrong] = (at[wrong] + 1) & self.mask
            wrong = wrong[self.key[at[wrong]] != keys[wrong]]
        return self.value[at]


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_log double, score double, n_bytes long"


def score_block(part: pa.Table, told: pa.Table, depth: int, shards: int, end_count: int) -> pa.Table:
    """Scores of a block's documents from the shards' answers."""
    texts = _lowered(part)
    keys, _ = counted(texts, depth)
    order, _ = _by_shard(place(keys, depth), shards)
    words = hashed(texts)
    first, which = _same(words.one, words.two)
    word_order, _ = _by_shard(words.one[first], shards)
    by = np.argsort(told.column("shard").to_numpy(), kind="stable")
    answers = told.select(["log_p", "counts"]).take(pa.array(by)).to_pylist()
    lookup = Lookup(keys[order], np.concatenate([unpack(x["log_p"], "<f8") for x in answers]))
    known = np.empty(len(first), np.int64)
    known[word_order] = np.concatenate([unpack(x["counts"], "<i8") for x in answers])
    # sums of a text's words: ends are put after each, so that no text is empty
    ends = np.cumsum(words.counts)
    value = np.insert(np.log10(known + 0.1)[which], ends, math.log10(end_count + 0.1))
    is_known = np.insert((known > 0)[which], ends, end_count > 0)
    starts = np.r_[0, np.cumsum(words.counts + 1)[:-1]]
    score = []
    for a, b in chunks(texts):
        each = lookup(pairs(texts[a:b], depth))
        stops = np.cumsum(np.fromiter((len(t) + 1 for t in texts[a:b]), np.int64, b - a))
        score.append(np.add.reduceat(each, np.r_[0, stops[:-1]]))
    return pa.table({
        "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n_tokens": pa.array(words.counts + 1, pa.int64()), "n_known": pa.array(np.add.reduceat(is_known.astype(np.int64), starts), pa.int64()),
        "base_log": pa.array(np.add.reduceat(value, starts), pa.float64()), "score": pa.array(np.concatenate(score) if score else np.zeros(0)), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
    })


def held_out(of: int = 10, rest: int = 0) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of == rest, F.lit(False))


def score(docs: DataFrame, depth: int = DEPTH, block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """One row per document: base and model scores, and the model's code length in bits per byte, end included."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", held_out())
    dealt = blocks.deal(rows, "ctw", block_bytes)
    shards = exchange.shards(dealt.select("block").distinct().count())
    asked = dealt.groupBy("block").applyInArrow(lambda part: ask(part, depth, shards), ASKED)
    asked = scratch.table(exchange.relayed(asked, shards, ASKED, FAMILIES, {"pairs": lambda keys: place(keys, depth)}), "asked")
    end_count = dealt.where("NOT held_out").count()

    sums = scratch.table(asked.groupBy("shard").applyInArrow(lambda part: shard_sums(part, depth), SUMS), "sums")
    totals = sums.where("part < 0").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    n, v = totals[0] + end_count, totals[1] + (end_count > 0)
    groups = sums.where("part >= 0").groupBy("part")
    # at most 256 ** (NEAR - 1) nodes: bounded, so the driver may hold them
    tops = groups.applyInArrow(lambda part: group_sums(part, depth), TOPS).groupBy("at").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "pw"))).orderBy("at").toPandas()
    top = Top((tops["at"].to_numpy().astype(np.uint64), tops.n0.to_numpy(), tops.n1.to_numpy(), tops.pw.to_numpy()), depth)

    given = groups.applyInArrow(lambda part: group_answers(part, top), GIVEN)
    told = asked.groupBy("shard").cogroup(given.groupBy("shard")).applyInArrow(lambda part, mid: answer(part, mid, depth, shards), ANSWER + exchange.tags(shards, FAMILIES))
    told = exchange.returned(told, shards, ANSWER, RETURNS)
    out = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lambda part, model: score_block(part, model, depth, shards, end_count), SCORED)
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), (F.col("base_log") - F.col("n_tokens") * math.log10(n + 0.1 * (v + 1))).alias("base_score"), "score",
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
