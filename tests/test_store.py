"""The line store: equal rows, no line moved, and no bucket that holds a hot booking whole."""

import re
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from stayledger.operators import sales
from stayledger.plans import store_job
from stayledger.sources.store import PART, LineStore, write_lines
from tests.frames import book_rows, frame
from workload.queries import payments
from workload.roles import Roles

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def roles(spark):
    return Roles(spark, FOLDER)


@pytest.fixture(scope="module", params=[1_000_000, 5], ids=["plain", "hot bookings"])
def store(request, spark, roles, tmp_path_factory):
    made = LineStore(spark, str(tmp_path_factory.mktemp("store")), hot_lines=request.param, hot_parts=3)
    made.write("service", roles.lines, "seq_rec", "seq_reserva", 4)
    made.write("sale", roles.sales, "grec_seq_rec_s", "rres_seq_reserva", 4)
    return made


def rows(frame_):
    return Counter(map(tuple, frame_.select(sorted(frame_.columns)).collect()))


def line_exchanges(frame_):
    """Exchanges above the scan of the stored lines, other than of what is grouped by key already."""
    text = frame_._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text
    moved = []
    lines = text.splitlines()
    for at, one in enumerate(lines):
        if "FileScan" in one and "Bucketed: true" in one:
            depth = re.search(r"[A-Za-z*]", one).start()
            for above in reversed(lines[:at]):
                place = re.search(r"[A-Za-z*]", above)
                if place and place.start() < depth:
                    depth = place.start()
                    if "Exchange" in above or "HashAggregate" in above:
                        moved.append(above)
                        break
    return [m for m in moved if "Exchange" in m and "Broadcast" not in m]


@pytest.fixture(autouse=True)
def nothing_small(spark):
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")


def test_service_lines_in_scope_move_no_line(roles, store):
    bookings = roles.booking_view.select(
        F.col("operative_incoming").alias("seq_rec"), F.col("booking_id").alias("seq_reserva"), "booking_currency", "creation_date"
    )
    stored = store.open("service").join(bookings)
    assert line_exchanges(stored) == []
    assert rows(stored) == rows(bookings.join(roles.lines, ["seq_rec", "seq_reserva"]))
    day = bookings.where(F.col("creation_date") == F.lit(date(1996, 5, 2))).drop("creation_date", "booking_currency")
    semi = store.open("service").join(day, "left_semi")
    assert line_exchanges(semi) == [] and rows(semi) == rows(roles.lines.join(day, ["seq_rec", "seq_reserva"], "left_semi"))


def test_charged_sale_lines_move_no_line(roles, store):
    stored = sales.charged_lines(store.open("sale"), payments(roles))
    assert line_exchanges(stored) == [] and rows(stored) == rows(sales.charged_lines(roles.sales, payments(roles)))


def test_sale_tax_lines_move_no_line(roles, store):
    names = ["grec_seq_rec_s", "rres_seq_reserva", "date_ccy_exchange", "regime", "tax_aux"]
    from stayledger.operators.lookup import measured

    stored, plain = (sales.sale_tax_lines(s, roles.tax, measured(roles.header), sales.GENERAL).select(names) for s in (store.open("sale"), roles.sales))
    assert line_exchanges(stored) == [] and rows(stored) == rows(plain)


def test_a_hot_booking_is_spread_and_declared_anew(spark, tmp_path):
    lines = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("b"), F.lit(1).cast("long").alias("a"), F.lit(2.5).alias("amount"))
    made = LineStore(spark, str(tmp_path), hot_lines=100, hot_parts=8)
    made.write("t", lines.repartition(16), "a", "b", 8)
    spark.sql(f"DROP TABLE {made._table('t')}")
    stored = LineStore(spark, str(tmp_path), hot_lines=100, hot_parts=8).open("t")
    assert stored.frame.where("b = 7").select(PART).distinct().count() > 4
    # Also copies of one line, as all of booking 7 are here, are spread over the parts.
    assert stored.join(spark.createDataFrame([(1, 7), (1, 2500), (1, 9)], "a long, b long")).count() == 2001
    made.write("t", lines.limit(0), "a", "b", 8)
    assert made.open("t").frame.count() == 0


def test_lines_of_the_sources(spark, tmp_path):
    services, costs = book_rows()
    tables = {name: frame(spark, name, services.get(name, [])) for name in ("hotel", "circuit", "other", "transfer", "endowments", "extra")}
    tables["cost"] = frame(spark, "cost", costs)
    made = LineStore(spark, str(tmp_path))
    write_lines(made, tables.__getitem__, dict([store_job.parse_buckets("service=3"), store_job.parse_buckets("cost=2")]))
    assert made.open("service").frame.count() == 240 and made.open("cost").frame.count() == 120
    with pytest.raises(Exception):
        store_job.parse_buckets("tax=3")
