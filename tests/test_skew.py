"""Hot keys: spread over tasks, and no row lost or doubled by it."""

import pytest
from pyspark.sql import functions as F

from stayledger.operators.keys import first_per_key, in_scope
from stayledger.operators.lookup import Lookup, estimated_bytes, fixed, measured, measured_together


@pytest.fixture
def hot(spark):
    """30,000 rows, a third of them exact copies under one key."""
    return spark.range(0, 30_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 101).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("payload"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffled_joins_equal_broadcast(spark, hot, how):
    side = spark.range(50).select(F.col("id").alias("k"), *([] if "semi" in how or "anti" in how else [(F.col("id") * 2).alias("v")]))
    small = Lookup(side, True).join(hot, ["k"], how)
    large = Lookup(side, False).join(hot, ["k"], how)
    assert small.columns == large.columns

    def digest(frame):
        return frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*frame.columns).cast("decimal(38,0)"))).first()

    assert digest(small) == digest(large)


def test_shuffled_condition_joins_equal_broadcast(spark, hot):
    terms = spark.createDataFrame([(7, 0, 0), (7, 0, 5), (8, 0, 40_000), (99, 1, 2)], "kk long, low long, high long")
    inside = F.col("payload").between(F.col("low"), F.col("high"))
    small = Lookup(terms, True).join_where(hot, [("k", "kk")], inside, "left")
    expected = sorted(small.groupBy(*small.columns).count().collect(), key=str)
    large = Lookup(terms, False).join_where(hot, [("k", "kk")], inside, "left")
    assert small.columns == large.columns
    assert sorted(large.groupBy(*large.columns).count().collect(), key=str) == expected


def test_size_check(spark):
    frame = spark.range(10)
    size = estimated_bytes(frame)
    assert measured(frame, max_bytes=size).small and not measured(frame, max_bytes=size - 1).small
    both = measured_together({"a": frame, "b": spark.range(1000)}, max_bytes=size)
    assert (both["a"].small, both["b"].small) == (True, False)
    assert measured_together({}) == {}
    assert fixed(spark.range(1)).small


def test_exploded_rows_count_as_in_memory(spark, tmp_path):
    spark.range(40_000).write.parquet(str(tmp_path / "parts"))
    exploded = spark.read.parquet(str(tmp_path / "parts")).select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("n"), "id")
    stated = measured(exploded, fanout=10)
    assert estimated_bytes(exploded, 10) >= 10 * estimated_bytes(exploded) and not stated.small
    assert not measured_together({"a": exploded}, fanouts={"a": 10})["a"].small and measured(exploded).small


def test_scope_is_by_pair_not_by_column(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2)], "a long, b long")
    wanted = spark.createDataFrame([(1, 1), (2, 2)], "operative_incoming long, booking_id long")
    for small in (True, False):
        assert sorted(map(tuple, in_scope(rows, Lookup(wanted, small), "a", "b").collect())) == [(1, 1), (2, 2)]


def test_first_per_key_of_a_hot_key(hot):
    got = first_per_key(hot, ["k"], ["payload"])
    assert got.count() == 101 and got.filter("k = 7").first()["payload"] == 0
