"""Walking over Arrow batches of documents in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a Python task holds as words at once. One longer text makes a slice of its own.
SLICE_BYTES = 2 << 20

#: Every byte to itself, but A-Z to a-z and what ends a word of [0-9a-z] and non-ASCII characters to a space.
ALNUM = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, cut so that a slice's texts have about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist() + [batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield batch.slice(a, b - a)


def map_slices(df: DataFrame, f: Callable[[pa.RecordBatch], dict], schema: str, column: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """``f`` of each slice, which returns columns by name in the order of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, limit):
            out = f(part)
            yield pa.RecordBatch.from_arrays([x if isinstance(x := out[k.name], pa.Array) else pa.array(x, k.type) for k in fields], schema=fields)

    return df.mapInArrow(run, schema)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts: for choosing a number of tasks, never a result."""
    return int(docs.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0)


def pack(a: np.ndarray) -> bytes:
    """An array's bytes by place, compressed: sorted numbers share their upper bytes."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(width, -1).T).reshape(-1).view(kind)
