"""Histories and intervals too large to broadcast: against plain search, and with the rows that joins put out counted."""

import random
from bisect import bisect_left, bisect_right
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stayledger.operators.asof import first_on_or_after, latest_on_or_before, merged, within_binned, within_interval
from stayledger.operators.lookup import Lookup
from tests.metrics import rows_out

QUOTES = "owner string, kind string, since timestamp_ntz, rate double"
ROWS = "n long, k string, t string, at timestamp_ntz"
ON = [("k", "owner"), ("t", "kind")]


def sample(pick, instants):
    start = datetime(1969, 11, 20)
    moment = [start + timedelta(minutes=pick.randrange(400_000)) if instants else start + timedelta(days=pick.randrange(300)) for _ in range(80)]
    quotes = {(k, t, pick.choice(moment)): pick.random() for k in "abc" for t in "xy" for _ in range(pick.randint(0, 25))}
    quotes = [(*key, rate) for key, rate in quotes.items()] + [(None, "x", start, 9.0), ("a", "x", None, 9.0)]
    rows = [(n, pick.choice(["a", "b", "c", "d", None]), pick.choice("xy"), pick.choice([*moment, None])) for n in range(600)]
    return quotes, rows + rows[:50]


def nearest(quotes, row, forward):
    _, k, t, at = row
    own = sorted((since, rate) for owner, kind, since, rate in quotes if (owner, kind) == (k, t) and None not in (k, since, at))
    since = [s for s, _ in own]
    place = (bisect_left(since, at) if forward else bisect_right(since, at) - 1) if own else -1
    return (k, t, *own[place]) if 0 <= place < len(own) else (None, None, None, None)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("instants", [False, True])
@pytest.mark.parametrize("slice_days", [1, 30, 10_000])
def test_merge_is_the_nearest_quote(spark, forward, instants, slice_days):
    quotes, rows = sample(random.Random(slice_days), instants)
    history, table = spark.createDataFrame(quotes, QUOTES), spark.createDataFrame(rows, ROWS).repartition(3)
    got = merged(table, history, ON, "at", "since", forward, slice_days)
    assert got.columns == ["n", "k", "t", "at", "owner", "kind", "since", "rate"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((*row, *nearest(quotes, row, forward)) for row in rows), key=str)


@pytest.mark.parametrize("join", [latest_on_or_before, first_on_or_after])
def test_merge_equals_the_broadcast_join(spark, join):
    pick = random.Random(3)
    rates = [(k, date(2020, 1, 1) + timedelta(days=d), k + d / 1000) for k in range(5) for d in pick.sample(range(400), 20)]
    history = spark.createDataFrame(rates, "key long, since date, rate double")
    rows = spark.createDataFrame([(n, pick.randrange(6), date(2019, 12, 1) + timedelta(days=pick.randrange(460))) for n in range(500)], "n long, k long, at date")
    small, large = (join(rows, Lookup(history, small), [("k", "key")], "at", "since") for small in (True, False))
    assert small.columns == large.columns and sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)


def test_empty_sides(spark):
    quotes, rows = spark.createDataFrame([], QUOTES), spark.createDataFrame([(1, "a", "x", datetime(2020, 1, 1))], ROWS)
    assert merged(rows, quotes, ON, "at", "since").first()["rate"] is None
    assert merged(rows.limit(0), quotes, ON, "at", "since").count() == 0


def test_a_key_of_many_quotes_meets_one_each(spark):
    # 10,000 quotes and 100,000 rows of one key.
    start = F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz")
    history = spark.range(10_000).select(F.lit(1).alias("owner"), (start + F.expr("make_dt_interval(0, 0, id * 7)")).alias("since"), F.col("id").alias("quote"))
    rows = spark.range(100_000).select("id", F.lit(1).alias("k"), (start + F.expr("make_dt_interval(0, 0, id * 13 % 70000)")).alias("at"))
    joined = merged(rows, history, [("k", "owner")], "at", "since").where("quote = id * 13 % 70000 div 7")
    counted = rows_out(spark, lambda: joined.write.format("noop").mode("overwrite").save())
    joins = [rows for name, _, rows in counted if "Join" in name]
    assert joins and max(joins) == 100_000
    assert not any("BroadcastNestedLoop" in name or "Cartesian" in name for name, *_ in counted)
    assert joined.count() == 100_000


TERMS = "owner long, low date, high date, place string"


def contains(rows, terms):
    return sorted((*r, *t) for r in rows for t in terms if r[1] == t[0] and None not in (r[2], t[1], t[2]) and t[1] <= r[2] <= t[2])


def test_bins_are_the_intervals(spark):
    pick = random.Random(5)
    day = date(1969, 6, 1)
    terms = []
    for i in range(250):
        low = day + timedelta(days=pick.randrange(500))
        terms.append((pick.randrange(4), low, low + timedelta(days=pick.choice([-1, 0, 0, 1, 6, 30, 31, 32, 90, 700])), f"p{i}"))
    terms += [(None, day, day, "n"), (1, None, day, "n"), (1, day, None, "n"), terms[0], (2, date(1, 1, 1), date(9999, 12, 31), "ever")]
    rows = [(n, pick.choice([0, 1, 2, 3, 9, None]), pick.choice([None] + [day + timedelta(days=d) for d in range(-20, 600, 7)])) for n in range(300)]
    table, intervals = spark.createDataFrame(rows, "n long, k long, at date").repartition(3), spark.createDataFrame(terms, TERMS)
    frames = [within_interval(table, Lookup(intervals, small), [("k", "owner")], F.col("at"), F.col("low"), F.col("high")) for small in (True, False)]
    assert frames[0].columns == frames[1].columns
    for frame in frames:
        assert sorted(map(tuple, frame.collect())) == contains(rows, terms)
    assert within_binned(table.limit(0), intervals, [("k", "owner")], F.col("at"), F.col("low"), F.col("high")).count() == 0


def test_exploded_terms_are_not_broadcast_on_an_estimate(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "owners"))
    owners = spark.read.parquet(str(tmp_path / "owners"))
    day = F.lit(date(1990, 1, 1))
    terms = owners.select(F.col("id").alias("owner"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("term"), day.alias("low"), day.alias("high"))
    rows = spark.range(1000).select("id", F.col("id").alias("k"), day.alias("at"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        joined = within_binned(rows, terms, [("k", "owner")], F.col("at"), F.col("low"), F.col("high"))
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Broadcast" not in text


def test_a_key_of_many_terms_pairs_near_the_matches(spark):
    # 10,000 terms of ten days and a few of a year, 2,000 rows, one key.
    terms = spark.range(10_000).select(
        F.lit(1).alias("owner"), F.date_add(F.lit(date(1990, 1, 1)), F.col("id").cast("int")).alias("low"),
        F.date_add(F.lit(date(1990, 1, 1)), (F.col("id") + F.when(F.col("id") % 100 == 0, 365).otherwise(9)).cast("int")).alias("high"),
    )
    rows = spark.range(2000).select("id", F.lit(1).alias("k"), F.date_add(F.lit(date(1990, 6, 1)), (F.col("id") * 5).cast("int")).alias("at"))
    joined = within_binned(rows, terms, [("k", "owner")], F.col("at"), F.col("low"), F.col("high"))
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        counted = rows_out(spark, lambda: joined.write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    matches = joined.count()
    joins = [rows for name, _, rows in counted if "Join" in name]
    assert 20_000 < matches < 30_000 and joins and max(joins) <= 4 * matches
