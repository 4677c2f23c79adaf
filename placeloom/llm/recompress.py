"""Substring deduplication by recompression: long repeats found by globally consistent symbols.

Every document is parsed bottom-up. The first round names runs of one token; each later round splits the
symbols by a hash bit into left and right ones and names every pair of a left and a right neighbour. A name is a hash
of what it stands for, so all tasks agree on all names without an exchange, and equal passages get equal symbols
inside; only near a passage's ends may its surroundings interfere.

Symbols work at two heights. A *long symbol* is a symbol that reaches one of ``SPANS`` words by its pair (or run). Two are the same if
names, lengths and a second hash of all their words agree, which stands for comparing their expansions. Where a long symbol also is
in a smaller document, every window inside it is a repeat, and nothing more is asked about it.
For the ends of passages, and for short ones, windows have *anchors*: how far surroundings can interfere is tracked, as each
symbol carries the range of words on which its making depended, and a window's anchor is the longest symbol of the lower rounds whose range
lies inside it (ties: by name), or a hash of the window where it has none, as inside long runs. Equal windows have
equal anchors, so no repeat is lost. Neighbouring windows mostly share an anchor: about a fifth as many as words leave a task.

1. blocks of documents send their distinct anchors and long symbols, these with the least document that has each, to shards by hash;
   a shard answers which anchors are in two documents or more and which long symbols another block has in a smaller document;
2. each block sends its windows that stand on a shared anchor, but for those inside such a long symbol, as 128-bit hashes of their
   words with the least document that has each. The least document of a window is never one that leaves it out: it would have
   to be in a long symbol that a smaller one has;
3. the shards answer with those windows that another block has in a smaller document;
4. blocks remove the words of windows that start in a smaller document, of another block or their own.

Passages in many documents are summed up in each block before any shuffle, so a hot one makes as many rows as there are
blocks. Messages go to a number of shards that grows with the blocks up to ``exchange.RADIX``, beyond it through relays: see there. Hash halves
of words are independent (128 bits in all), so a false repeat is out of reach; false sharing of an anchor only costs a check.

Defined edge results: a null or empty text has no words; documents of under ``window`` words keep all; rows with the same id are one
document's, so none is a smaller one for another; a null id counts as larger than all others; other columns are passed by.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, exchange, scratch
from .texts import as_bytes, pack, unpack

WINDOW = 13
#: Rounds whose symbols may be anchors.
ROUNDS = 3
#: Rounds in all, and the words from which a symbol is a long one. Pairs make a quarter of the symbols go in a round.
LONG_ROUNDS = 20
SPANS = (24, 96)
#: Words that are parsed together; a longer document is cut into pieces that overlap by a window less one word.
PIECE = 1 << 18

_U = np.uint64
_LAST = np.iinfo(np.int64).max


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


@dataclass
class Piece:
    """Words of several documents as two independent hashes each, a separator before, between and after them."""

    one: np.ndarray
    two: np.ndarray
    apart: np.ndarray
    doc: np.ndarray
    word: np.ndarray  # the word's place in its document


#: Words up to so many bytes are hashed all at once, as sums over their bytes; longer ones one by one.
SHORT = 64
#: Bytes that are hashed at once.
BYTES = 1 << 20

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _table(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each byte, and an odd one for each place in a short word."""
    return mix(np.arange(256, dtype=np.uint64) + _U(seed << 32)), mix(np.arange(SHORT, dtype=np.uint64) + _U(seed + 7 << 32)) | _U(1)


@functools.cache
def _tables() -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    return _table(11), _table(12)


@dataclass
class Words:
    """All words of several texts: two independent hashes each, and how many each text has."""

    one: np.ndarray
    two: np.ndarray
    counts: np.ndarray


def hashed(texts: list[bytes]) -> Words:
    """Words are what white space parts; equal words have equal hashes wherever they stand. Long texts are taken in parts that end at white space."""
    ones, twos, counts, of, held, size = [], [], [], [], [], 0

    def flush() -> None:
        for out, new in zip((ones, twos, counts), _hashed(held)):
            out.append(new)
        held.clear()

    for i, t in enumerate(texts):
        a = 0
        while a < len(t) or a == 0:
            cut = _GAP.search(t, a + BYTES)
            b = cut.end() if cut else len(t)
            held.append(t[a:b])
            of.append(i)
            size += b - a
            a = max(b, 1)
            if size >= BYTES:
                flush()
                size = 0
    flush()
    return Words(np.concatenate(ones), np.concatenate(twos), np.bincount(np.array(of, np.int64), weights=np.concatenate(counts), minlength=len(texts)).astype(np.int64))


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    joined = b" ".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    inside = ~_SPACE[data]
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    limits = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    counts = np.diff(np.r_[0, np.searchsorted(start, limits)])
    length = end - start
    out = []
    short = length <= SHORT
    at, n = start[short], length[short]
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    byte = data[np.repeat(at, n) + place]
    for values, odd in _tables():
        h = np.zeros(len(start), np.uint64)
        if len(at):
            h[short] = mix(np.add.reduceat(values[byte] * odd[place], np.cumsum(n) - n) + n.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        out.append(h)
    for i in np.flatnonzero(~short).tolist():
        digest = xxhash.xxh3_128_intdigest(joined[start[i] : end[i]])
        out[0][i], out[1][i] = digest & 0xFFFFFFFFFFFFFFFF, digest >> 64
    return out[0], out[1], counts


def pieces(words: Words, window: int, size: int = PIECE) -> Iterator[Piece]:
    """All windows of all documents, each in exactly one piece: documents together up to ``size`` words, longer ones cut with an overlap."""
    begin = np.r_[0, np.cumsum(words.counts)]
    held: list[tuple[int, int, int]] = []
    n = 0
    for d, count in enumerate(words.counts.tolist()):
        for a in range(0, max(1, count - window + 1), size):
            length = min(count - a, size + window - 1)
            held.append((d, a, length))
            n += length
            if n >= size:
                yield _piece(words, begin, held)
                held, n = [], 0
    if held:
        yield _piece(words, begin, held)


def _piece(words: Words, begin: np.ndarray, held: list[tuple[int, int, int]]) -> Piece:
    docs, firsts, lengths = (np.array(x, np.int64) for x in zip(*held))
    starts = np.cumsum(lengths + 1) - lengths
    total = int(lengths.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at, word = np.repeat(starts, lengths) + inside, np.repeat(firsts, lengths) + inside
    source = np.repeat(begin[docs], lengths) + word
    n = total + len(held) + 1
    out = Piece(np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.ones(n, bool), np.full(n, -1, np.int64), np.zeros(n, np.int64))
    out.one[at], out.two[at], out.apart[at], out.doc[at], out.word[at] = words.one[source], words.two[source], False, np.repeat(docs, lengths), word
    return out


def windows(p: Piece, window: int = WINDOW) -> np.ndarray:
    """Places where a window starts that no separator cuts."""
    n = len(p.apart) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    cuts = np.r_[0, np.cumsum(p.apart)]
    return np.flatnonzero(cuts[window:] == cuts[: n])


def window_hash(words: np.ndarray, at: np.ndarray, window: int, salt: int) -> np.ndarray:
    """Of the words from each place: their hashes times odd numbers, summed."""
    odd = mix(np.arange(1, window + 1, dtype=np.uint64) + _U(salt << 32)) | _U(1)
    out = np.zeros(len(at), np.uint64)
    for i in range(window):
        out += mix(words[at + i]) * odd[i]
    return mix(out)


@dataclass
class Symbols:
    """Symbols side by side: names, first word and the one after the last, which are separators, and the range of words they depend on."""

    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    apart: np.ndarray
    low: np.ndarray | None
    high: np.ndarray | None


def runs(p: Piece) -> Symbols:
    """The first round. What a word's run is depends on the words beside it."""
    n = len(p.one)
    same = (p.one[1:] == p.one[:-1]) & (p.two[1:] == p.two[:-1]) & ~p.apart[1:] & ~p.apart[:-1]
    start = np.flatnonzero(np.r_[True, ~same])
    count = np.diff(np.r_[start, n])
    name = mix(p.one[start] ^ (p.two[start] << _U(1)))
    name = np.where(count > 1, mix(name + count.astype(np.uint64) * _U(0xD6E8FEB86659FD93)), name)
    return Symbols(name, start, start + count, p.apart[start], np.maximum(start - 1, 0), np.minimum(start + count + 1, n))


def paired(s: Symbols, r: int, ranged: bool) -> tuple[Symbols, np.ndarray, np.ndarray]:
    """The next round, the symbols that it made, and the longer part's words of each. Unless ``ranged``, what they depend on isn't followed."""
    left = (mix(s.name + _U((2 * r + 1) * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF)) >> _U(63)).astype(bool)
    pair = np.flatnonzero(left[:-1] & ~left[1:] & ~s.apart[:-1] & ~s.apart[1:])
    stays = np.ones(len(s.name), bool)
    stays[pair + 1] = False
    low = high = None
    if ranged:
        # a symbol that stays does so because of the neighbour it might have joined
        low, high = s.low.copy(), s.high.copy()
        low[1:] = np.where(left[1:], low[1:], np.minimum(s.low[1:], s.low[:-1]))
        high[1:] = np.where(left[1:], high[1:], np.maximum(s.high[1:], s.high[:-1]))
        low[:-1] = np.where(left[:-1], np.minimum(low[:-1], s.low[1:]), low[:-1])
        high[:-1] = np.where(left[:-1], np.maximum(high[:-1], s.high[1:]), high[:-1])
        low[pair], high[pair] = np.minimum(s.low[pair], s.low[pair + 1]), np.maximum(s.high[pair], s.high[pair + 1])
        low, high = low[stays], high[stays]
    name, end = s.name.copy(), s.end.copy()
    name[pair] = mix(s.name[pair] * _U(0xA0761D6478BD642F) + mix(s.name[pair + 1] + _U(0xE7037ED1A0B428DB)))
    end[pair] = s.end[pair + 1]
    longer = np.maximum(s.end[pair] - s.start[pair], s.end[pair + 1] - s.start[pair + 1])
    made = np.cumsum(stays)[pair] - 1
    return Symbols(name[stays], s.start[stays], end[stays], s.apart[stays], low, high), made, longer


@dataclass
class Parse:
    """Of the window at each place the anchor: its words covered in the top four bits, then the symbol's name. Of the long symbols names, first word, end."""

    anchors: np.ndarray
    name: np.ndarray
    start: np.ndarray
    end: np.ndarray


def parse(p: Piece, at: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS, spans: tuple[int, ...] = SPANS, anchored: bool = True) -> Parse:
    """Anchors of the windows (unless not ``anchored``) and long symbols of a piece."""
    n, steps = len(p.one), max(1, window.bit_length())
    # best[k] at a place: the largest value offered to all of the 2 ** k places from there
    best = [np.zeros(n, np.uint64) for _ in range(steps)] if anchored else []
    long: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def offer(s: Symbols) -> None:
        """To all windows that hold a symbol's range: those from ``window`` words before its end up to its beginning."""
        fits = np.flatnonzero(~s.apart & (s.high - s.low <= window))
        value = (np.minimum(s.end[fits] - s.start[fits], 15).astype(np.uint64) << _U(60)) | (mix(s.name[fits]) >> _U(4))
        first, last = np.maximum(s.high[fits] - window, 0), s.low[fits]
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            some = np.flatnonzero(level == k)
            np.maximum.at(best[k], first[some], value[some])
            np.maximum.at(best[k], last[some] - (1 << k) + 1, value[some])

    s = runs(p)
    if anchored:
        offer(s)
    span = s.end - s.start
    for limit in spans:
        some = np.flatnonzero(~s.apart & (span >= limit))
        long.append((s.name[some], s.start[some], s.end[some]))
    for r in range(max(rounds, LONG_ROUNDS if spans else 0)):
        s, made, longer = paired(s, r, anchored and r < rounds)
        if anchored and r < rounds:
            offer(s)
        if not len(made):
            continue
        span = s.end[made] - s.start[made]
        for limit in spans:
            some = made[(span >= limit) & (longer < limit)]
            long.append((s.name[some], s.start[some], s.end[some]))
    out = np.zeros(0, np.uint64)
    if anchored:
        for k in range(steps - 1, 0, -1):
            half = 1 << (k - 1)
            np.maximum(best[k - 1], best[k], out=best[k - 1])
            np.maximum(best[k - 1][half:], best[k][:-half], out=best[k - 1][half:])
        out = best[0][at]
        bare = np.flatnonzero(out == 0)
        out[bare] = window_hash(p.one, at[bare], window, 3) >> _U(4)
    return Parse(out, *(np.concatenate([x[i] for x in long]) if long else np.zeros(0, k) for i, k in enumerate(("u8", "i8", "i8"))))


def expansion(p: Piece, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the words of each range, by one sum over the whole piece; with its length."""
    base = _U(0x9E6C63D0876A9A35)
    power = np.full(len(p.two) + 1, base)
    power[0] = _U(1)
    power = np.multiply.accumulate(power)
    back = np.full(len(p.two) + 1, _U(pow(int(base), -1, 1 << 64)))
    back[0] = _U(1)
    back = np.multiply.accumulate(back)
    upto = np.r_[_U(0), np.cumsum(mix(p.two ^ _U(0x5851F42D4C957F2D)) * power[:-1])]
    return mix((upto[end] - upto[start]) * back[start] + (end - start).astype(np.uint64) * _U(0xD1342543DE82EF95))


def _ids(part: pa.Table) -> np.ndarray:
    return part.column("doc_id").fill_null(_LAST).to_numpy().astype(np.int64)


def _texts(part: pa.Table) -> list[bytes]:
    return as_bytes(part.column("text").combine_chunks())


def _least(keys: list[np.ndarray], ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct keys in order, with the least and the largest id of each."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    keys, ids = [k[order] for k in keys], ids[order]
    if not len(ids):
        return keys, ids, ids
    first = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
    return [k[first] for k in keys], np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)


def _distinct(found: list[tuple[list[np.ndarray], np.ndarray, np.ndarray]], keys: int):
    """The same over the results of several pieces."""
    if not found:
        return [np.zeros(0, np.uint64)] * keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(found) == 1:
        return found[0]
    ks = [np.concatenate([k[i] for k, _, _ in found] * 2) for i in range(keys)]
    return _least(ks, np.concatenate([a for _, a, _ in found] + [b for _, _, b in found]))


@dataclass
class Block:
    """A block's pieces, with their windows, anchors and long symbols; the distinct anchors and symbols in order."""

    ids: np.ndarray
    pieces: list[Piece]
    at: list[np.ndarray]
    parses: list[Parse]
    sums: list[np.ndarray]

    @classmethod
    def of(cls, part: pa.Table, window: int, rounds: int, spans: tuple[int, ...], anchored: bool = True, words: Words | None = None) -> Block:
        made = list(pieces(hashed(_texts(part)) if words is None else words, window))
        at = [windows(p, window) for p in made]
        parses = [parse(p, a, window, rounds, spans, anchored) for p, a in zip(made, at)]
        return cls(_ids(part), made, at, parses, [expansion(p, x.start, x.end) for p, x in zip(made, parses)])

    def symbols(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Distinct long symbols, as names and expansions in order, with the least document of each."""
        found = [_least([x.name, h], self.ids[p.doc[x.start]]) for p, x, h in zip(self.pieces, self.parses, self.sums)]
        keys, low, _ = _distinct(found, 2)
        return keys, low

    def inside(self, known: list[np.ndarray], window: int) -> list[np.ndarray]:
        """For each piece's windows: whether they lie in a long symbol that is among ``known`` (sorted by name)."""
        out = []
        for p, at, x, h in zip(self.pieces, self.at, self.parses, self.sums):
            some = np.flatnonzero(_member(x.name, h, *known))
            edge = np.zeros(len(p.one) + 1, np.int64)
            np.add.at(edge, x.start[some], 1)
            np.add.at(edge, np.maximum(x.end[some] - window + 1, x.start[some]), -1)
            out.append(np.cumsum(edge)[at] > 0)
        return out


def _by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted keys by shard, then key, and where the shards begin in it."""
    at = (keys % _U(shards)).astype(np.int64)
    return np.argsort(at, kind="stable"), np.cumsum(np.r_[0, np.bincount(at, minlength=shards)])


ANCHORS = "shard int, block int, anchors binary, several binary, names binary, sums binary, least binary"
_ASKED = {"anchors": (("anchors", "<u8"), ("several", "u1")), "names": (("names", "<u8"), ("sums", "<u8"), ("least", "<i8"))}


def ask_anchors(part: pa.Table, window: int, rounds: int, spans: tuple[int, ...], shards: int) -> pa.Table:
    """A block's distinct anchors, and whether two of its documents have each; its distinct long symbols, and the least document of each."""
    block, found = Block.of(part, window, rounds, spans), []
    for p, at, x in zip(block.pieces, block.at, block.parses):
        a, d = x.anchors, p.doc[at]
        turn = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])]) if len(a) else np.zeros(0, np.int64)
        found.append(_least([a[turn]], block.ids[d[turn]]))
    (a,), low, high = _distinct(found, 1)
    order, bounds = _by_shard(a, shards)
    (name, sums), least = block.symbols()
    order2, bounds2 = _by_shard(name, shards)
    columns = {"anchors": (bounds, [a[order], (low != high).astype(np.uint8)[order]]), "names": (bounds2, [name[order2], sums[order2], least[order2]])}
    return exchange.messages(part.column("block")[0].as_py(), shards, _ASKED, columns)


SHARED = "block int, shard int, shared binary, later binary"


def answer_anchors(part: pa.Table) -> pa.Table:
    """For each block that asked, in its order: which of its anchors are in two documents or more, and which of its long symbols another has in a smaller one."""
    each = [unpack(x, "<u8") for x in part.column("anchors").to_pylist()]
    several = np.concatenate([unpack(x, "u1") for x in part.column("several").to_pylist()]) > 0
    keys = np.concatenate(each)
    out = np.zeros(len(keys), bool)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        group = np.cumsum(np.r_[True, keys[order][1:] != keys[order][:-1]]) - 1
        shared = (np.bincount(group) > 1) | (np.bincount(group, weights=several[order]) > 0)
        out[order] = shared[group]
    names, sums, least = ([unpack(x, kind) for x in part.column(c).to_pylist()] for c, kind in _ASKED["names"])
    later = _later([np.concatenate(names), np.concatenate(sums)], np.concatenate(least))
    split = lambda x, of: [pack(y.astype(np.uint8)) for y in np.split(x, np.cumsum([len(k) for k in of])[:-1])]
    return pa.table({"block": part.column("block"), "shard": part.column("shard"), "shared": pa.array(split(out, each), pa.binary()), "later": pa.array(split(later, names), pa.binary())})


def _later(keys: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Which rows have a key that another row has with a smaller id."""
    out = np.zeros(len(ids), bool)
    if len(ids):
        order = np.lexsort(keys[::-1])
        new = np.r_[True, np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)]
        first = np.minimum.reduceat(ids[order], np.flatnonzero(new))
        out[order] = first[np.cumsum(new) - 1] < ids[order]
    return out


def _told(told: pa.Table, column: str) -> np.ndarray:
    """An answer's bits in the order in which the block asked: by shard."""
    answers = told.select([column]).take(pa.array(np.argsort(told.column("shard").to_numpy(), kind="stable"))).column(0).to_pylist()
    return np.concatenate([np.zeros(0, np.uint8), *(unpack(x, "u1") for x in answers if x is not None)]) > 0


def _known(block: Block, told: pa.Table, shards: int) -> list[np.ndarray]:
    """The long symbols of a block that another has in a smaller document, by name."""
    (name, sums), _ = block.symbols()
    order = _by_shard(name, shards)[0]
    some = np.sort(order[_told(told, "later")])
    return [name[some], sums[some]]


WINDOWS = "shard int, block int, one binary, two binary, least binary"
_SENT = {"one": (("one", "<u8"), ("two", "<u8"), ("least", "<i8"))}


def ask_windows(part: pa.Table, told: pa.Table, window: int, rounds: int, spans: tuple[int, ...], shards: int) -> pa.Table:
    """A block's distinct windows on shared anchors and in no long symbol that is a repeat, with the least document that has each."""
    none = {"one": (np.zeros(shards + 1, np.int64), [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)])}
    if not part.num_rows or not told.num_rows:
        return exchange.messages(0, shards, _SENT, none)
    block = Block.of(part, window, rounds, spans)
    keys = np.unique(np.concatenate([x.anchors for x in block.parses])) if block.parses else np.zeros(0, np.uint64)
    wanted = np.sort(keys[_by_shard(keys, shards)[0]][_told(told, "shared")])
    found = []
    for p, at, x, known in zip(block.pieces, block.at, block.parses, block.inside(_known(block, told, shards), window)) if len(wanted) else ():
        at = at[~known & (wanted[np.minimum(np.searchsorted(wanted, x.anchors), len(wanted) - 1)] == x.anchors)]
        found.append(_least([window_hash(p.one, at, window, 1), window_hash(p.two, at, window, 2)], block.ids[p.doc[at]]))
    (one, two), low, _ = _distinct(found, 2)
    order, bounds = _by_shard(one, shards)
    return exchange.messages(part.column("block")[0].as_py(), shards, _SENT, {"one": (bounds, [one[order], two[order], low[order]])})


EARLIER = "block int, shard int, one binary, two binary"


def answer_windows(part: pa.Table) -> pa.Table:
    """For each block that asked: its windows that a smaller document of another block has."""
    each = [[unpack(x, kind) for x in part.column(c).to_pylist()] for c, kind in _SENT["one"]]
    one, two, least = (np.concatenate(x) for x in each)
    later = _later([one, two], least)
    cuts = np.cumsum([len(x) for x in each[0]])[:-1]
    picked = [[pack(x[m]) for x, m in zip(np.split(values, cuts), np.split(later, cuts))] for values in (one, two)]
    out = {"block": part.column("block"), "shard": part.column("shard"), "one": pa.array(picked[0], pa.binary()), "two": pa.array(picked[1], pa.binary())}
    if "who_one" in part.column_names:  # relayed: of those that are told, whose they are
        out["who_one"] = pa.array([pack(unpack(x, "<u2")[m]) for x, m in zip(part.column("who_one").to_pylist(), np.split(later, cuts))], pa.binary())
    return pa.table(out)


def _member(one: np.ndarray, two: np.ndarray, known_one: np.ndarray, known_two: np.ndarray) -> np.ndarray:
    """Which (one, two) are among the known pairs, these sorted by their first half."""
    if not len(known_one):
        return np.zeros(len(one), bool)
    at = np.searchsorted(known_one, one)
    out = np.zeros(len(one), bool)
    live = np.arange(len(one))
    while live.size:
        at_live = np.minimum(at[live], len(known_one) - 1)
        same = (at[live] < len(known_one)) & (known_one[at_live] == one[live])
        live, at_live = live[same], at_live[same]
        out[live] |= known_two[at_live] == two[live]
        live = live[~out[live]]
        at[live] += 1
    return out


def removed_words(block: Block, counts: np.ndarray, known: list[np.ndarray], earlier: tuple[np.ndarray, np.ndarray], window: int) -> list[np.ndarray | None]:
    """Per document the mask of words to remove, or None. ``known``: the long symbols, and ``earlier`` the windows, that smaller documents of other blocks have."""
    masks: list[np.ndarray | None] = [None] * len(counts)
    if not block.pieces:
        return masks
    one, two = (np.concatenate([window_hash(getattr(p, c), at, window, salt) for p, at in zip(block.pieces, block.at)]) for c, salt in (("one", 1), ("two", 2)))
    doc, place = (np.concatenate([getattr(p, c)[at].astype(np.int64) for p, at in zip(block.pieces, block.at)]) for c in ("doc", "word"))
    gone = np.concatenate(block.inside(known, window))
    order = np.argsort(earlier[0], kind="stable")
    gone |= _member(one, two, earlier[0][order], earlier[1][order])
    ordered = np.sort(one)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    own = np.flatnonzero(_member(one, np.zeros(len(one), np.uint64), twice, np.zeros(len(twice), np.uint64)))
    if len(own):
        ids = block.ids[doc[own]]
        gone[own] |= _later([one[own], two[own]], ids)
    at = np.flatnonzero(gone)
    at = at[np.lexsort((place[at], doc[at]))]
    for part in np.split(at, np.flatnonzero(np.diff(doc[at])) + 1) if len(at) else ():
        d = int(doc[part[0]])
        edge = np.zeros(int(counts[d]) + 1, np.int64)
        np.add.at(edge, place[part], 1)
        np.add.at(edge, place[part] + window, -1)
        masks[d] = np.cumsum(edge[:-1]) > 0
    return masks


REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _kept(text: bytes, mask: np.ndarray | None) -> bytes:
    words = text.split()
    return b" ".join(words if mask is None else [w for w, gone in zip(words, mask.tolist()) if not gone])


def block_report(part: pa.Table, told: pa.Table, window: int, spans: tuple[int, ...], shards: int, texts: bool) -> pa.Table:
    """A block's documents, from both answers: rows of ``told`` have either ``later`` or ``one`` and ``two``."""
    words = hashed(_texts(part))
    block = Block.of(part, window, 0, spans, anchored=False, words=words)
    keys = tuple(np.concatenate([np.zeros(0, np.uint64), *(unpack(x, "<u8") for x in told.column(c).to_pylist() if x is not None)]) for c in ("one", "two"))
    masks = removed_words(block, words.counts, _known(block, told, shards), keys, window)
    kept = [_kept(t, m) for t, m in zip(_texts(part), masks)]
    out = {
        "doc_id": part.column("doc_id"), "n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array([0 if m is None else int(m.sum()) for m in masks], pa.int64()),
        "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
    }
    if texts:
        out["text"] = pa.array([k.decode() for k in kept], pa.string())
    return pa.table(out)


def dedup(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, texts: bool = True, block_bytes: int = blocks.BLOCK_BYTES, spans: tuple[int, ...] = SPANS) -> DataFrame:
    """One row per document: words, removed words, the digest of what is kept and, with ``texts``, the kept text."""
    dealt = blocks.deal(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "recompress", block_bytes)
    shards = exchange.shards(dealt.select("block").distinct().count())
    spans = tuple(x for x in spans if x >= window)
    asked = dealt.groupBy("block").applyInArrow(lambda part: ask_anchors(part, window, rounds, spans, shards), ANCHORS)
    shared = scratch.table(exchange.answered(asked, answer_anchors, shards, (ANCHORS, SHARED), _ASKED, {"anchors": (("shared", "u1"),), "names": (("later", "u1"),)}), "anchors")
    scratch.tidy(docs.sparkSession)

    found = dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(lambda part, told: ask_windows(part, told, window, rounds, spans, shards), WINDOWS)
    earlier = scratch.table(exchange.answered(found, answer_windows, shards, (WINDOWS, EARLIER), _SENT, {"one": (("one", "<u8"), ("two", "<u8"))}), "repeats")
    scratch.tidy(docs.sparkSession)

    told = shared.select("block", "shard", "later").unionByName(earlier.where(F.octet_length("one") > 0), allowMissingColumns=True)
    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lambda part, answers: block_report(part, answers, window, spans, shards, texts), REPORT + ", text string" * texts)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT k, coalesce(doc_id, 9223372036854775807) AS id, i, array_to_string(ws[i:i+12], ' ') AS win FROM (SELECT k, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)),
g AS (SELECT k, i FROM (SELECT k, i, id, min(id) OVER (PARTITION BY win) AS least FROM p) WHERE least < id),
c AS (SELECT DISTINCT k, unnest(range(i, i + 13)) AS j FROM g),
n AS (SELECT k, count(*) AS n_removed, list(j) AS js FROM c GROUP BY k),
w AS (SELECT k, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM d),
t AS (SELECT w.k, string_agg(word, ' ' ORDER BY w.j) AS kept FROM w LEFT JOIN c ON c.k = w.k AND c.j = w.j WHERE c.k IS NULL GROUP BY w.k)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN n USING (k) LEFT JOIN t USING (k)
"""
