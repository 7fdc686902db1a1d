"""Equi-joins of large rows with a table that is usually, but not surely, small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup is sent to every executor if its files hold at most this many bytes. Rows take several
# times that in memory, still far below what an executor has.
BROADCAST_MAX_BYTES = 8 << 20
# Bytes in memory per byte of a file, for rows that no file holds because an explode makes them.
UNPACKED = 10


@dataclass(frozen=True)
class Lookup:
    """A table joined by key, with the outcome of its size check.

    A small table is broadcast: the large side stays where it is and no key can
    be hot. A larger one is joined by a plain shuffle, for which AQE splits the
    partitions that turn out skewed, repeating the lookup for those only. Both ways read the
    same columns and give the same rows.
    """

    frame: DataFrame
    small: bool

    def of(self, frame: DataFrame) -> Lookup:
        """A table derived from this one that is no larger, joined the same way."""
        return replace(self, frame=frame)

    def select(self, *columns: Column | str) -> Lookup:
        return self.of(self.frame.select(*columns))

    def filter(self, condition: Column) -> Lookup:
        return self.of(self.frame.filter(condition))

    def join(self, rows: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
        """Join ``rows`` with the lookup on same-named columns (inner, left, left_semi or left_anti)."""
        if self.small:
            return rows.join(F.broadcast(self.frame), list(on), how)
        return rows.join(self.frame, list(on), how)

    def join_where(self, rows: DataFrame, on: Sequence[tuple[str, str]], also: Column, how: str) -> DataFrame:
        """Equi-join on (left, right) column pairs with a further condition on the matches."""
        condition = also
        for left, right in on:
            condition = condition & (F.col(left) == F.col(right))
        if self.small:
            return rows.join(F.broadcast(self.frame), condition, how)
        return rows.join(self.frame, condition, how)


def estimated_bytes(frame: DataFrame, fanout: int = 1) -> int:
    """Spark's estimate from file sizes and columns read; no job runs.

    Joins and unions are estimated at the product and the sum of their sides and filters at the whole, so
    an estimate below the bound errs on the safe side, but for an explode, which Spark takes to put out as many rows as it
    reads: whoever explodes states as ``fanout`` how many rows come of one. Those rows count as they are in memory.
    """
    size = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if fanout == 1 else size * fanout * UNPACKED


def measured(frame: DataFrame, max_bytes: int | None = None, fanout: int = 1) -> Lookup:
    """The table with the outcome of its size check, for which no job runs.

    A table that an explode multiplies is never small. A file says too little of its rows: a million ascending keys take a
    kilobyte where they are written as differences, and each of them becomes ``fanout`` rows of full width.
    """
    bound = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    return Lookup(frame, small=fanout == 1 and estimated_bytes(frame) <= bound)


def measured_together(
    frames: Mapping[str, DataFrame], max_bytes: int | None = None, fanouts: Mapping[str, int] | None = None
) -> dict[str, Lookup]:
    return {name: measured(frame, max_bytes, (fanouts or {}).get(name, 1)) for name, frame in frames.items()}


def fixed(frame: DataFrame) -> Lookup:
    """A table written out in the program, or bounded by the calendar: small by construction."""
    return Lookup(frame, True)
