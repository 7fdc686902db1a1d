"""As-of and interval joins against a keyed history, small or large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayledger.operators.lookup import Lookup

# Days that one piece of a key's time line spans when rows and history are merged.
SLICE_DAYS = 30


def latest_on_or_before(
    rows: DataFrame, history: Lookup, on: Sequence[tuple[str, str]], at: str, since: str
) -> DataFrame:
    """Attach the history row with the greatest ``since`` not after ``at``; nulls when there is none.

    ``history`` holds one row per key and ``since``, a date or a timestamp. The rows of a small one become disjoint
    validity intervals, so each row meets one match and the large side is neither sorted nor grouped. A large one is
    merged with the rows' distinct times.
    """
    if not history.small:
        return merged(rows, history.frame, on, at, since)
    keys = [right for _, right in on]
    until = F.lead(since).over(Window.partitionBy(*keys).orderBy(since))
    intervals = history.of(history.frame.withColumn("_until", until))
    valid = (F.col(at) >= F.col(since)) & (F.col("_until").isNull() | (F.col(at) < F.col("_until")))
    return intervals.join_where(rows, on, valid, "left").drop("_until")


def first_on_or_after(
    rows: DataFrame, history: Lookup, on: Sequence[tuple[str, str]], at: str, since: str
) -> DataFrame:
    """Attach the history row with the smallest ``since`` not before ``at``; nulls when there is none."""
    if not history.small:
        return merged(rows, history.frame, on, at, since, forward=True)
    keys = [right for _, right in on]
    previous = F.lag(since).over(Window.partitionBy(*keys).orderBy(since))
    intervals = history.of(history.frame.withColumn("_previous", previous))
    valid = (F.col(at) <= F.col(since)) & (
        F.col("_previous").isNull() | (F.col(at) > F.col("_previous"))
    )
    return intervals.join_where(rows, on, valid, "left").drop("_previous")


def merged(
    rows: DataFrame, history: DataFrame, on: Sequence[tuple[str, str]], at: str, since: str, forward: bool = False, slice_days: int = SLICE_DAYS
) -> DataFrame:
    """Attach the nearest history row before or at a row's time (after or at it with ``forward``) without pairing them.

    The distinct times the rows ask for and the history are stacked and ordered by time within a key, and the last
    quote seen is carried along. What then joins the rows is an equality on key and time with one quote
    at most, for which a hot key is split like in any other join.

    A key's time line is cut into pieces of ``slice_days``, sorted each by itself. The last quote of every piece is
    known from an aggregate of one row per key and piece; the one in force where a piece begins is put in front of it.
    That hand-over orders the pieces of a key, whose number the calendar bounds.

    Rows without key or time get nulls, as do those that no quote precedes; quotes without key or time match nothing.
    """
    names = [f"_key{i}" for i in range(len(on))]

    def keyed(frame: DataFrame, keys: Sequence[str], time: str, *more: Column) -> DataFrame:
        known = frame.dropna(subset=[*keys, time])
        return known.select(*(F.col(key).alias(name) for key, name in zip(keys, names, strict=True)), F.col(time).alias("_time"), *more)

    order = F.desc_nulls_first if forward else F.asc_nulls_first
    nearest = F.min_by if forward else F.max_by
    quotes = keyed(history, [right for _, right in on], since, F.lit(0).alias("_kind"), F.struct(*history.columns).alias("_quote"))
    asked = keyed(rows, [left for left, _ in on], at).distinct().withColumn("_kind", F.lit(1))
    piece = F.floor(F.unix_date(F.col("_time").cast("date")) / slice_days)
    stacked = quotes.unionByName(asked, allowMissingColumns=True).withColumn("_piece", piece)

    last = nearest("_quote", F.when(F.col("_kind") == 0, F.col("_time"))).alias("_last")
    so_far = Window.partitionBy(*names).orderBy(order("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        stacked.groupBy(*names, "_piece")
        .agg(last)
        .select(*names, "_piece", F.last("_last", ignorenulls=True).over(so_far).alias("_quote"))
        .where(F.col("_quote").isNotNull())
        .withColumn("_kind", F.lit(0))
    )
    along = Window.partitionBy(*names, "_piece").orderBy(order("_time"), "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        stacked.unionByName(carried, allowMissingColumns=True)
        .withColumn("_quote", F.last("_quote", ignorenulls=True).over(along))
        .where(F.col("_kind") == 1)
        .select(*names, "_time", "_quote")
    )
    same = F.col(at) == F.col("_time")
    for (left, _), name in zip(on, names, strict=True):
        same = same & (F.col(left) == F.col(name))
    return rows.join(found, same, "left").select(*rows.columns, "_quote.*")


def within_interval(
    rows: DataFrame, intervals: Lookup, on: Sequence[tuple[str, str]], at: Column, start: Column, end: Column
) -> DataFrame:
    """Rows joined with every interval of their key that contains ``at``, both ends included."""
    if not intervals.small:
        return within_binned(rows, intervals.frame, on, at, start, end)
    return intervals.join_where(rows, on, at.between(start, end), "inner")


def within_binned(
    rows: DataFrame, intervals: DataFrame, on: Sequence[tuple[str, str]], at: Column, start: Column, end: Column
) -> DataFrame:
    """``within_interval`` as an equality on key and bin of days, for intervals that cannot be broadcast.

    An interval goes to bins as wide as its own length class, the next power of two days: one bin or two. A row looks
    into its day's bin of every class that its key has. Key and bin give candidates at most some times as many as the
    matches, however many intervals a key has, and each pair once; the exact test follows.

    Both joins name their way: Spark's estimates know neither the rows that an explode puts out nor how few bytes of a
    file a row can take, so by them it would broadcast the very tables that are too large for that.
    """
    days = [F.unix_date(F.to_date(c)) for c in (start, end)]
    sized = (
        intervals.withColumns({"_first": days[0], "_past": days[1]})
        .where(start <= end)
        .withColumn("_class", F.ceil(F.log2(F.col("_past") - F.col("_first") + 1)).cast("int"))
    )
    width = F.expr("shiftleft(1L, _class)")
    binned = sized.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_first") / width), F.floor(F.col("_past") / width)))).drop("_first", "_past")
    # At most one class per power of two.
    classes = sized.groupBy(*(right for _, right in on)).agg(F.array_distinct(F.collect_set("_class")).alias("_classes"))
    classes = classes.select(*(F.col(right).alias(f"_{i}") for i, (_, right) in enumerate(on)), "_classes")
    known = F.lit(True)
    for i, (left, _) in enumerate(on):
        known = known & (F.col(left) == F.col(f"_{i}"))
    looking = (
        rows.withColumn("_day", F.unix_date(F.to_date(at)))
        .join(classes.hint("merge"), known)
        .withColumn("_look", F.explode("_classes"))
        .withColumn("_place", F.floor(F.col("_day") / F.expr("shiftleft(1L, _look)")))
        .drop("_day", "_classes", *(f"_{i}" for i in range(len(on))))
    )
    match = (F.col("_look") == F.col("_class")) & (F.col("_place") == F.col("_bin"))
    for left, right in on:
        match = match & (F.col(left) == F.col(right))
    return looking.join(binned.hint("merge"), match).where(at.between(start, end)).drop("_look", "_place", "_class", "_bin")
