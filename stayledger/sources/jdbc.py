"""JDBC tables and queries."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """How to divide a JDBC scan: one task per slice of a numeric or date column."""

    column: str
    lower: object
    upper: object
    slices: int


@dataclass(frozen=True)
class Slices:
    """How to divide a JDBC scan where values are uneven: one task per condition, which together hold every row once."""

    conditions: tuple[str, ...]


def slices_at(column: str, bounds: Sequence[object]) -> Slices:
    """Slices of a column between ascending bounds; a bound begins its slice, and nulls go with the least values."""
    literals = [_literal(bound) for bound in dict.fromkeys(bounds)]
    if not literals:
        return Slices(("1 = 1",))
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in itertools.pairwise(literals)]
    return Slices((f"{column} < {literals[0]} OR {column} IS NULL", *middle, f"{column} >= {literals[-1]}"))


def _literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def even_slices(keys: DataFrame, column: str, slices: int, accuracy: int = 10_000) -> Slices:
    """Slices of about equal numbers of rows, by quantiles of ``keys``.

    ``keys`` is any frame with the column: the table itself, of which only that column is read, or what an earlier run
    kept of it. Even steps between two bounds, as a ``Split`` makes them, leave most rows to a few tasks where booking
    numbers are dense in recent years. One aggregate of bounded size finds the bounds; a value that holds several
    slices' worth of rows is one slice, for no condition on the column can part it.
    """
    shares = [i / slices for i in range(1, slices)]
    if not shares:
        return slices_at(column, [])
    bounds = keys.agg(F.percentile_approx(column, shares, accuracy)).first()[0]
    return slices_at(column, bounds or [])


@dataclass(frozen=True)
class JdbcSource:
    """A database read lazily. Filters and column choices on the result reach the database."""

    spark: SparkSession
    url: str
    properties: dict[str, str]

    def table(self, name: str, split: Split | Slices | None = None) -> DataFrame:
        """A table, or a subquery given as ``(select ...) alias``.

        Without a split the scan is one task, right only for a dimension.
        """
        if split is None:
            return self.spark.read.jdbc(self.url, name, properties=self.properties)
        if isinstance(split, Slices):
            return self.spark.read.jdbc(self.url, name, predicates=list(split.conditions), properties=self.properties)
        return self.spark.read.jdbc(
            self.url,
            name,
            column=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.slices,
            properties=self.properties,
        )

    def even(self, name: str, column: str, slices: int) -> DataFrame:
        """A table in slices of about equal numbers of rows, for which its column is read once before."""
        return self.table(name, even_slices(self.query(f"select {column} from {name}"), column, slices))

    def query(self, sql: str, split: Split | Slices | None = None) -> DataFrame:
        """The result of a statement, read by the executors; no row passes through the driver."""
        return self.table(f"({sql}) q", split)


def jdbc_reader(source: JdbcSource, splits: Mapping[str, Split | Slices], names: Mapping[str, str] | None = None) -> Callable[[str], DataFrame]:
    """Tables by the names the jobs use; ``splits`` divides the scans of the large ones, ``names`` maps to database names."""

    def read(name: str) -> DataFrame:
        return source.table((names or {}).get(name, name), splits.get(name))

    return read


def parse_split(text: str) -> tuple[str, Split]:
    """``table:column:lower:upper:slices``, as given on a command line."""
    table, column, lower, upper, slices = text.split(":")
    return table, Split(column, int(lower) if lower.lstrip("-").isdigit() else lower, int(upper) if upper.lstrip("-").isdigit() else upper, int(slices))
