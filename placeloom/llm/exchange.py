"""Questions from blocks to shards by hash, and the answers back, in packed messages.

Up to ``RADIX`` shards, each block sends every shard one message, and the rows are blocks times shards at most ``RADIX``. Beyond that
messages take two hops: a block sends one message to each group of ``RADIX`` shards; a relay, one for each group and cohort of blocks, puts its
blocks' messages together and sends one to each shard of the group; answers go back the same way. A cohort is ``RELAY`` blocks for every group, so what
a relay holds is about ``RELAY`` blocks' messages whatever the corpus, and a block's rows are one a group and RADIX / RELAY behind the relays, while the
shards grow with the blocks, to RADIX times RADIX. The number of hops changes no result.

A family is columns of equal length, the first being the key whose remainder, or that of its place, is its shard. Whose a key is goes along as two bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import pack, unpack

#: Shards there are at least, messages of a block at most, blocks' worth of messages that a relay holds, and blocks of a cohort at most.
LEAST = 32
RADIX = 1024
RELAY = 16
COHORT = 1 << 14

Families = Mapping[str, tuple[tuple[str, str], ...]]
Place = Callable[[np.ndarray], np.ndarray]


def shards(blocks: int) -> int:
    """How many shards: half as many as blocks, so that a shard's messages are about as long as two blocks'."""
    n = max(LEAST, blocks // 2)
    return n if n <= RADIX else min(-(-n // RADIX) * RADIX, RADIX * RADIX)


def _groups(n: int) -> int:
    return n if n <= RADIX else n // RADIX


def cohort(n: int) -> int:
    """Blocks whose messages one relay puts together."""
    return min(COHORT, RELAY * _groups(n))


def messages(block: int, n: int, families: Families, columns: Mapping[str, tuple[np.ndarray, list[np.ndarray]]]) -> pa.Table:
    """A block's rows: for each shard, or group of them, the parts of its columns, packed. ``columns`` has, by family, where the shards begin in the columns, and these."""
    step = 1 if n <= RADIX else RADIX
    cuts = {f: bounds[::step] for f, (bounds, _) in columns.items()}
    asked = [i for i in range(_groups(n)) if any(c[i] < c[i + 1] for c in cuts.values())]
    out = {"shard": pa.array(asked, pa.int32()), "block": pa.array([block] * len(asked), pa.int32())}
    for f, (_, arrays) in columns.items():
        for (name, _), a in zip(families[f], arrays):
            out[name] = pa.array([pack(a[cuts[f][i] : cuts[f][i + 1]]) for i in asked], pa.binary())
    return pa.table(out)


def _relay(part: pa.Table, n: int, families: Families, places: Mapping[str, Place]) -> pa.Table:
    """The messages of a cohort's blocks to a group, put together by shard; within one by block, then in the block's order."""
    part = part.take(pa.array(np.argsort(part.column("block").to_numpy(), kind="stable")))
    group, who = part.column("shard")[0].as_py(), (part.column("block").to_numpy() % cohort(n)).astype("<u2")
    found: dict[str, tuple[np.ndarray, list[np.ndarray]]] = {}
    for f, columns in families.items():
        arrays = [[unpack(x, kind) for x in part.column(name).to_pylist()] for name, kind in columns]
        tags = np.repeat(who, [len(x) for x in arrays[0]])
        whole = [np.concatenate(x) for x in arrays]
        at = (places.get(f, _itself)(whole[0]) % np.uint64(n)).astype(np.int64) - group * RADIX
        order = np.argsort(at, kind="stable")
        found[f] = np.cumsum(np.r_[0, np.bincount(at, minlength=RADIX)]), [x[order] for x in [*whole, tags]]
    live = [i for i in range(RADIX) if any(b[i] < b[i + 1] for b, _ in found.values())]
    out = {"shard": pa.array([group * RADIX + i for i in live], pa.int32()), "block": pa.array([part.column("cohort")[0].as_py()] * len(live), pa.int32())}
    for f, columns in families.items():
        bounds, arrays = found[f]
        for name, x in zip([c for c, _ in columns] + [f"who_{f}"], arrays):
            out[name] = pa.array([pack(x[bounds[i] : bounds[i + 1]]) for i in live], pa.binary())
    return pa.table(out)


def _back(part: pa.Table, size: int, returns: Families) -> pa.Table:
    """A group's answers to a cohort, taken apart for its blocks: each in the order in which it asked."""
    part = part.take(pa.array(np.argsort(part.column("shard").to_numpy(), kind="stable")))
    group, nth = part.column("group")[0].as_py(), part.column("block")[0].as_py()
    found = {}
    for f, columns in returns.items():
        tags = np.concatenate([unpack(x, "<u2") for x in part.column(f"who_{f}").to_pylist()])
        order = np.argsort(tags, kind="stable")
        bounds = np.cumsum(np.r_[0, np.bincount(tags, minlength=size)])
        found[f] = bounds, [np.concatenate([unpack(x, kind) for x in part.column(name).to_pylist()])[order] for name, kind in columns]
    live = [i for i in range(size) if any(b[i] < b[i + 1] for b, _ in found.values())]
    out = {"block": pa.array([nth * size + i for i in live], pa.int32()), "shard": pa.array([group] * len(live), pa.int32())}
    for f, columns in returns.items():
        bounds, arrays = found[f]
        for (name, _), x in zip(columns, arrays):
            out[name] = pa.array([pack(x[bounds[i] : bounds[i + 1]]) for i in live], pa.binary())
    return pa.table(out)


def _itself(key: np.ndarray) -> np.ndarray:
    return key


def names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def tags(n: int, families: Families) -> str:
    """Columns that relayed messages, and the answers to them, have besides."""
    return "" if n <= RADIX else "".join(f", who_{f} binary" for f in families)


def relayed(asked: DataFrame, n: int, schema: str, families: Families, places: Mapping[str, Place] | None = None) -> DataFrame:
    """The messages as the shards get them: with ``tags``, and the cohort in place of the block, if they take two hops."""
    if n <= RADIX:
        return asked
    sized = asked.withColumn("cohort", F.floor(F.col("block") / cohort(n)).cast("int"))
    return sized.groupBy("shard", "cohort").applyInArrow(lambda part: _relay(part, n, families, places or {}), schema + tags(n, families))


def tagged(told: pa.Table, part: pa.Table, n: int, schema: str, families: Families) -> pa.Table:
    """A shard's answers, a row for each of its messages in their order, with whose they are: by default everyone's who asked."""
    for name in names(tags(n, families)[2:]) if n > RADIX else ():
        if name not in told.column_names:
            told = told.append_column(name, part.column(name))
    return told.select(names(schema + tags(n, families)))


def returned(told: DataFrame, n: int, schema: str, returns: Families) -> DataFrame:
    """Answers by block, in the order in which it asked: ``told`` has rows as ``tagged`` makes them."""
    if n <= RADIX:
        return told
    grouped = told.withColumn("group", F.floor(F.col("shard") / RADIX).cast("int")).groupBy("group", "block")
    return grouped.applyInArrow(lambda part: _back(part, cohort(n), returns).select(names(schema)), schema)


def answered(asked: DataFrame, answer: Callable[[pa.Table], pa.Table], n: int, schemas: tuple[str, str], families: Families, returns: Families) -> DataFrame:
    """Answers by block: ``answer`` gets all messages to a shard and gives a row for each of them, in their order.

    ``returns`` names, by family, the columns of an answer and their kinds. An answer of fewer values than were asked for says whose they are in ``who_<family>``.
    """
    asked_schema, schema = schemas
    told = relayed(asked, n, asked_schema, families).groupBy("shard").applyInArrow(lambda part: tagged(answer(part), part, n, schema, families), schema + tags(n, families))
    return returned(told, n, schema, returns)
