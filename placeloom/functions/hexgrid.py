"""A hexagonal grid in axial coordinates on a local plane, as columns.

Cell ids are longs that hold (q, r); rings and disks are constant offsets, so neighbours are an explode and
no lookup. ``HexGrid`` is what the score needs of a grid; another one with the same methods can stand in for it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

BIAS = 1 << 20


def distance(q: int, r: int) -> int:
    return max(abs(q), abs(r), abs(q + r))


def offsets(k: int) -> list[tuple[int, int]]:
    """Steps to the cells within ``k``."""
    return [(q, r) for q in range(-k, k + 1) for r in range(-k, k + 1) if distance(q, r) <= k]


@dataclass(frozen=True)
class HexGrid:
    lon0: float = 76.9286
    lat0: float = 43.2389
    cos_ref: float = 0.72857
    size_m: float = 200.0

    def axial(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        x, y = (lon - self.lon0) * 111320.0 * self.cos_ref, (lat - self.lat0) * 111320.0
        q, r = (x * 0.5773502691896258 - y / 3.0) / self.size_m, (y * 2.0 / 3.0) / self.size_m
        rounded = lambda v: F.floor(v + 0.5)
        rq, rr, rs = rounded(q), rounded(r), rounded(-q - r)
        dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs + q + r)
        return F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq), F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)

    @staticmethod
    def id_of(q: Column, r: Column) -> Column:
        return ((q + BIAS) * (1 << 21) + (r + BIAS)).cast("long")

    def cell(self, lat: Column, lon: Column) -> Column:
        return self.id_of(*self.axial(lat, lon))

    @staticmethod
    def q(cell: Column) -> Column:
        return F.shiftright(cell, 21) - BIAS

    @staticmethod
    def r(cell: Column) -> Column:
        return cell.bitwiseAND(F.lit((1 << 21) - 1)) - BIAS

    @staticmethod
    def valid(cell: Column) -> Column:
        return F.coalesce((cell >= 0) & (cell < F.lit(1 << 42)), F.lit(False))

    def disk(self, cell: Column, k: int) -> Column:
        return F.array(*((cell + F.lit(q * (1 << 21) + r)).cast("long") for q, r in offsets(k)))

    def ring(self, cell: Column, k: int) -> Column:
        return F.array(*((cell + F.lit(q * (1 << 21) + r)).cast("long") for q, r in offsets(k) if distance(q, r) == k))

    def disk_by_ring(self, cell: Column, k: int) -> Column:
        """The disk as (cell, ring) pairs."""
        return F.array(*(F.struct((cell + F.lit(q * (1 << 21) + r)).cast("long").alias("cell"), F.lit(distance(q, r)).alias("ring")) for q, r in offsets(k)))

    def centre(self, cell: Column) -> tuple[Column, Column]:
        """(lat, lon) of the middle of a cell."""
        q, r = self.q(cell).cast("double"), self.r(cell).cast("double")
        x, y = (q + r / 2.0) * (math.sqrt(3.0) * self.size_m), r * (1.5 * self.size_m)
        return y / 111320.0 + self.lat0, x / (111320.0 * self.cos_ref) + self.lon0

    def parent(self, cell: Column, levels: int = 1) -> Column:
        """The cell of a grid sqrt(7) times coarser a level that holds this one's middle."""
        coarse = HexGrid(self.lon0, self.lat0, self.cos_ref, self.size_m * 7.0 ** (levels / 2))
        return coarse.cell(*self.centre(cell))
