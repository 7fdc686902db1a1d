"""The wide extract moves its bookings once and its lines once, and neither loses nor doubles a row by it."""

from collections import Counter
from dataclasses import replace
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__
import workload.roles
from stayledger.operators import lookup
from stayledger.operators.lookup import Lookup, fixed
from stayledger.plans.wide import BOOKING_CURRENCY_MEASURES, EUR_MEASURES, build_wide_extract
from stayledger.sources.catalog import load_header_tables
from stayledger.sources.schemas import SCHEMAS
from tests.compare import differences, sample_tables
from tests.frames import frame
from tests.test_plans import FOLDER, above, plan
from workload.queries import REGISTRY, WIDE_RANGE
from workload.roles import Roles

DAY = datetime(2018, 1, 10)
MEASURES = [row[2] for row in BOOKING_CURRENCY_MEASURES] + [row[1] for row in EUR_MEASURES]


def booking(office, number, operator):
    given = {
        "grec_seq_rec": office,
        "seq_reserva": number,
        "gdiv_cod_divisa": "USD",
        "fec_creacion": DAY,
        "gtto_seq_ttoo": operator,
        "cod_pais_cliente": "ES" if number % 2 else None,
        "fint_cod_interface": "A",
        "seq_rec_invoicing": 1,
    }
    return tuple(given.get(part.split()[0]) for part in SCHEMAS["booking"].split(","))


ROWS = {
    # A booking that comes twice, its number under another operator, one without an office, two that have no operator.
    "booking": [booking(1, 1, 1), booking(1, 1, 1), booking(1, 1, 2), booking(2, 1, 2), booking(None, 2, 1), booking(1, 3, None), booking(1, 4, 9)],
    "tour_operator": [(1, "One", "FR"), (1, "Uno", "FR"), (2, "Two", "FR"), (None, "None", "FR")],
    "country": [("ES", "es"), ("FR", "fr")],
    "receptive": [(1, "C1", "O1", "Office")],
    "interface": [("A", "partner")],
    "booking_information": [(1, 1, DAY, "A", "app"), (None, 2, DAY, "A", "lost")],
    "hotel_sale": [(1, 1, 10, None), (None, 2, 10, None)],
    "hotel_master": [(10, "D1")],
    "destination": [("D1", "Palma", "ENG")],
    "other_service": [(2, 1, "K", "T", date(2018, 1, 1))],
    "contract_other": [(2, "K", "T", date(2018, 1, 1), date(2018, 1, 31), "D1")],
    "resale": [(1, 1, "RL"), (None, 2, "RL")],
    "daily_rate": [(date(2018, 1, 10), "USD", 0.5)],
}


@pytest.fixture(scope="module")
def tables(spark):
    schema = "grec_seq_rec bigint, rres_seq_reserva bigint, " + ", ".join(f"{name} double" for name in MEASURES)
    none = [None] * (len(MEASURES) - 1)
    views = {"view": spark.createDataFrame([(1, 1, 10.0, *none), (2, 1, 4.0, *none), (None, 2, 7.0, *none)], schema)}
    read = load_header_tables(lambda name: views.get(name) or frame(spark, name, ROWS[name]), list(views))
    return replace(read, **{name: fixed(side.frame) for name, side in vars(read).items() if isinstance(side, Lookup)})


@pytest.mark.parametrize("large", [(), ("operators",), ("receptives", "interfaces", "daily_rates"), ("operators", "countries", "daily_rates", "hotels")])
def test_odd_bookings_meet_their_operators(tables, large):
    given = replace(tables, **{name: Lookup(getattr(tables, name).frame, False) for name in large})
    rows = build_wide_extract(given, "2018-01-10 00:00:00", "2018-01-10 00:00:00")
    some = ["operative_incoming", "booking_id", "customer_name", "source_market", "TTV_EUR_currency", "Destination_code", "Application", "canrec_status", "NUMBER_ACTIVE_ACC_SERV"]
    first = ("ES", 5.0, "D1-Palma", "app", "Reventa", 1)
    assert Counter(map(tuple, rows.select(some).collect())) == {
        (1, 1, "One", *first): 2,
        (1, 1, "Uno", *first): 2,
        (1, 1, "Two", *first): 1,
        (2, 1, "Two", "ES", 2.0, "D1-Palma", None, None, 0): 1,
        (None, 2, "One", "FR", 0.0, "NO_DESTINATION_CODE", None, None, 0): 1,
        (None, 2, "Uno", "FR", 0.0, "NO_DESTINATION_CODE", None, None, 0): 1,
    }


def exchanges(text, column):
    """Exchanges above each scan that reads a column."""
    tree = text.splitlines()
    return [sum("Exchange hash" in line for line in above(tree, at)) for at, line in enumerate(tree) if "FileScan" in line and column in line]


@pytest.mark.parametrize("ours", [True, False])
@pytest.mark.parametrize("small", [True, False])
def test_bookings_move_once(spark, small, ours):
    tables = Roles(spark, FOLDER).header_tables()
    tables = replace(tables, operators=Lookup(tables.operators.frame, small))
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", str(not ours).lower())
    try:
        text = plan(build_wide_extract(tables, *WIDE_RANGE))
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    # With large operators, bookings without an office move to them and back.
    assert exchanges(text, "o_orderpriority") == ([1] if small else [1, 2])


@pytest.mark.parametrize("small", [True, False])
def test_a_further_side_moves_no_booking(spark, tables, small):
    rows = [booking(None if n % 3 == 0 else n % 25, n, n % 50) for n in range(1, 2001)]
    operators = frame(spark, "tour_operator", [(n, f"Operator {n}", "FR") for n in range(50)])
    given = replace(tables, header=frame(spark, "booking", rows).repartition(5), operators=Lookup(operators, small))
    totals = spark.range(1, 2001).selectExpr("id % 25 as grec_seq_rec", "id as seq_reserva", "id * 10 as n").groupBy("grec_seq_rec", "seq_reserva").sum("n")
    settings = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = build_wide_extract(given, "2018-01-10 00:00:00", "2018-01-10 00:00:00").join(totals, ["grec_seq_rec", "seq_reserva"], "left")
        text = plan(joined)
        got = Counter(map(tuple, joined.select("grec_seq_rec", "booking_id", "customer_name", "sum(n)").collect()))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert got == Counter((None if n % 3 == 0 else n % 25, n, f"Operator {n % 50}", None if n % 3 == 0 else n * 10) for n in range(1, 2001))
    tree = text.splitlines()
    moves = [sum("Exchange hash" in line for line in above(tree, at)) for at, line in enumerate(tree) if "Exchange RoundRobin" in line and "5), REP" in line]
    # The bookings; with large operators also the numbers of the operators they ask for, and the bookings without an office.
    assert moves[0] == 1 and len(moves) == (1 if small else 3) and max(moves) <= 3, moves


@pytest.mark.parametrize("name", ["concat_key_join", "booking_extract_wide"])
def test_lines_of_the_views_move_once_and_no_sums_of_them(spark, name):
    rows = REGISTRY[name](Roles(spark, FOLDER))
    tree = plan(rows).splitlines()
    moved = [below for at, below in zip(tree, tree[1:], strict=False) if "Exchange hash" in at]
    assert moved and not any("partial_sum" in below for below in moved)
    assert exchanges(plan(rows), "l_extendedprice") == [1, 1, 1]
    rows.collect()
    assert len([line for line in plan(rows).splitlines() if "ReusedExchange" in line and "l_extendedprice" in line]) == 2


# A third of the bookings have one operator, a third of the lines one booking.
HOT = {
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey",
    "lineitem": "CASE WHEN l_linenumber % 3 = 0 THEN 21 ELSE l_orderkey END AS l_orderkey",
    "events": "CASE WHEN event_id % 3 = 0 THEN 21 ELSE user_id END AS user_id",
}


@pytest.mark.parametrize("bound", [0, lookup.BROADCAST_MAX_BYTES])
def test_hot_keys_match_sql(spark, tmp_path, monkeypatch, bound):
    connection = duckdb.connect()
    for name in workload.roles.SAMPLE_SCHEMAS:
        replaced = f"REPLACE ({HOT[name]})" if name in HOT else ""
        connection.execute(f"COPY (SELECT * {replaced} FROM '{FOLDER}/{name}.parquet') TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    monkeypatch.setattr(lookup, "BROADCAST_MAX_BYTES", bound)
    wide = __spark_entry__.queries()["booking_extract_wide"](spark, str(tmp_path))
    assert differences(wide, sample_tables(str(tmp_path)), __spark_entry__.oracle_sql()["booking_extract_wide"]) == []
