"""Row selection by key and order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayledger.operators.lookup import Lookup
from stayledger.settings import SQL_SETTINGS

BOOKING = ("operative_incoming", "booking_id")
LEAST = -(1 << 63)
BLOOM_SETTINGS = {name: value for name, value in SQL_SETTINGS.items() if "bloomFilter" in name}
# Bits of a pair's hash that one test of ``likely`` compares, and the number of tests.
HASH_BITS = 19
HASH_TESTS = 2


def in_scope(rows: DataFrame, bookings: Lookup, office: str, booking: str) -> DataFrame:
    """Rows of the wanted bookings, matched on the pair (office, booking).

    Few bookings are broadcast. More are joined by a shuffle, but of the rows that pass a Bloom filter of the wanted
    pairs, which Spark builds from the bookings and tests where the rows are read, so that what moves is near what is
    wanted, not the history. A session without our settings builds none for so large a table; ``likely`` takes its place.
    """
    pairs = bookings.select(F.col(BOOKING[0]).alias(office), F.col(BOOKING[1]).alias(booking))
    if bookings.small:
        return pairs.join(rows, [office, booking], "left_semi")
    # One key for the pair, so that one filter tests both numbers together. Spark builds a filter only from a side
    # that a comparison narrows, which files written for this purpose are without: theirs is always true.
    pair = F.struct(F.col(office).cast("bigint").alias("office"), F.col(booking).cast("bigint").alias("booking"))
    known = F.col(office).isNotNull() & F.col(booking).isNotNull()
    wanted = pairs.frame.where(known & (F.col(booking) >= F.lit(LEAST))).select(pair.alias("_wanted"))
    near = rows.where(known)
    if any(rows.sparkSession.conf.get(name, None) != value for name, value in BLOOM_SETTINGS.items()):
        near = likely(near, pairs.frame, office, booking)
    keyed = near.withColumn("_pair", pair)
    return keyed.join(wanted, F.col("_pair") == F.col("_wanted"), "left_semi").drop("_pair")


def likely(rows: DataFrame, pairs: DataFrame, office: str, booking: str) -> DataFrame:
    """Rows whose pair has the hash of a wanted one in every test; all wanted rows are among them.

    The distinct values of a few bits of the pairs' hash are broadcast, whose number their bits bound, however many pairs
    are wanted. No setting and no estimate of how many there are is needed. A day's bookings fill a small part of the
    values, so few other rows pass all tests.
    """
    for test in range(HASH_TESTS):
        hashed = F.xxhash64(F.col(office).cast("bigint"), F.col(booking).cast("bigint"))
        bits = F.shiftrightunsigned(hashed, test * HASH_BITS).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
        values = pairs.select(bits.alias("_value")).distinct()
        rows = rows.join(F.broadcast(values), bits == F.col("_value"), "left_semi")
    return rows


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``, which must leave no ties.

    The rank filter is applied on each side of the exchange, so a key with very
    many rows sends only one row per task.
    """
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def top_n(rows: DataFrame, order: Sequence[Column | str], n: int | None) -> DataFrame:
    """The first ``n`` rows in ``order``; all of them when no ``n`` is asked for."""
    return rows if n is None else rows.orderBy(*order).limit(n)
