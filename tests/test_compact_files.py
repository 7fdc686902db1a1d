"""Tables that take a few kB in files and very many rows in memory: their rows must not be broadcast."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from stayledger.operators.lookup import measured
from tests.metrics import rows_out

QUERIES = __spark_entry__.queries()
PARTS = 20_000
SHIPPED = datetime(1994, 12, 1)
TERMS = ((date(1995, 1, 1), date(1997, 12, 31)), (date(1997, 7, 1), date(2000, 6, 30)))


def compact(frame, path):
    frame.coalesce(1).write.options(**{"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false"}).parquet(str(path))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """20,000 parts in differences of their keys, so 200,000 contract terms; 400 lines of 100 bookings, an eighth of them hotels."""
    target = tmp_path_factory.mktemp("compact")
    shipped = F.lit(SHIPPED).cast("timestamp_ntz") + F.expr("make_dt_interval(cast(id * 6 as int))")
    tables = {
        "part": spark.range(PARTS).select(F.col("id").alias("p_partkey")),
        "nation": spark.range(25).selectExpr("cast(id as int) as n_nationkey", "'N' || id as n_name", "0 as n_regionkey"),
        "supplier": spark.range(30).selectExpr("id as s_suppkey", "cast(id % 25 as int) as s_nationkey"),
        "orders": spark.range(100).selectExpr("id as o_orderkey"),
        "lineitem": spark.range(400).select(
            F.expr("id div 4").alias("l_orderkey"), (F.col("id") * 7 % PARTS).alias("l_partkey"), (F.col("id") % 30).alias("l_suppkey"),
            F.expr("if(id % 8 = 0, 'A', 'N')").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), shipped.alias("l_shipdate"),
        ),
    }
    for name, frame in tables.items():
        compact(frame, target / f"{name}.parquet")
    return str(target)


def contracts_of_bookings():
    """(office, booking, contract, start, destination, its name) by plain search."""
    for n in range(400):
        booking, part, day = n // 4, n * 7 % PARTS, (SHIPPED + timedelta(days=n * 6)).date()
        for term, (start, end) in enumerate(TERMS):
            place = (part + term) % 30
            if n % 8 and booking % 25 % 5 == part % 5 and start <= day <= end and place < 25:
                yield booking % 25, booking, f"CT{part}", start, f"D{place}", f"N{place}"


def codes_of_bookings():
    """(office, booking, code): the hotel's destination, else the first contract's."""
    first = {}
    for office, booking, _, _, place, name in sorted(contracts_of_bookings()):
        first.setdefault(booking, f"{place}-{name}")
    for booking in range(100):
        nation = booking * 4 % 30 % 25
        code = first.get(booking, "NO_DESTINATION_CODE") if booking % 2 else f"D{nation}-N{nation}"
        yield booking % 25, booking, code


def broadcast_rows(spark, frame):
    counted = rows_out(spark, lambda: frame.write.format("noop").mode("overwrite").save())
    return max((rows for name, _, rows in counted if name == "BroadcastExchange"), default=0)


@pytest.mark.parametrize("name", ["contract_interval_join", "contract_interval_bins"])
def test_terms_of_a_small_file_are_not_broadcast(spark, folder, name):
    found = QUERIES[name](spark, folder)
    expected = sorted(set(contracts_of_bookings()))
    assert expected and sorted(map(tuple, found.select("grec_seq_rec", "seq_reserva", "nom_contrato", "contract_from", "cod_destino", "nom_destino2").collect())) == expected
    assert broadcast_rows(spark, found) <= 100


def test_destination_code_broadcasts_no_terms(spark, folder):
    found = QUERIES["destination_code"](spark, folder)
    expected = sorted(codes_of_bookings())
    assert len({code for _, _, code in expected[1::2]}) > 5
    assert sorted(map(tuple, found.collect())) == expected
    assert broadcast_rows(spark, found) <= 100


def test_exploded_tables_are_not_judged_by_their_files(spark, folder):
    parts = spark.read.parquet(f"{folder}/part.parquet")
    terms = parts.select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("term"))
    assert measured(parts).small and not measured(terms, fanout=10).small
