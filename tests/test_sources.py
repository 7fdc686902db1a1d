"""Readers and sinks. No database is started: the JDBC calls are recorded."""

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stayledger.operators.lines import SERVICES
from stayledger.plans import daily_job, jobs
from stayledger.sources import materialize
from stayledger.sources.catalog import load_books, parquet_reader, register_views
from stayledger.sources.inline import inline
from stayledger.sources.jdbc import JdbcSource, Split, even_slices, jdbc_reader, parse_split, slices_at
from stayledger.sources.materialize import checkpoint_folder, materialized, materialized_while
from stayledger.sources.sinks import report, run_path, write_extract
from tests.frames import FX_MAPPING, TAX, book_rows, booking, frame


class Recorder:
    def __init__(self):
        self.calls = []

    def jdbc(self, *positional, **named):
        self.calls.append((positional, named))
        return "frame"


def test_jdbc_table_query_and_split():
    reader = Recorder()
    source = JdbcSource(SimpleNamespace(read=reader), "jdbc:x", {"driver": "d"})
    assert source.table("t") == "frame"
    source.query("select a from b", Split("a", 1, 100, 4))
    assert reader.calls[0] == (("jdbc:x", "t"), {"properties": {"driver": "d"}})
    assert reader.calls[1] == (
        ("jdbc:x", "(select a from b) q"),
        {"column": "a", "lowerBound": 1, "upperBound": 100, "numPartitions": 4, "properties": {"driver": "d"}},
    )


def test_inline_is_a_literal(spark):
    table = inline(spark, [(1, None), (2, "b")], "a bigint, b string")
    assert [tuple(row) for row in table.collect()] == [(1, None), (2, "b")]
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()


def test_views_have_their_own_names(spark):
    register_views({"a": spark.range(2), "b": spark.range(3)}, prefix="stay_")
    assert spark.sql("select (select count(*) from stay_a) + (select count(*) from stay_b) as n").first()["n"] == 5


def test_rerun_replaces_its_own_day_only(spark, tmp_path):
    base = str(tmp_path)
    first, second = date(2018, 1, 1), date(2018, 1, 2)
    write_extract(spark.range(5), base, first)
    write_extract(spark.range(7), base, second)
    write_extract(spark.range(6), base, first)
    assert report(spark, run_path(base, first, "parquet")) == (6, ["id"])
    assert report(spark, run_path(base, second, "parquet")) == (7, ["id"])


def test_second_format_is_written_from_the_first(spark, tmp_path):
    paths = write_extract(spark.range(4), str(tmp_path), date(2018, 1, 1), ("csv", "parquet"))
    assert spark.read.csv(paths.paths["csv"], header=True).count() == 4
    assert spark.read.parquet(paths.paths["parquet"]).count() == 4
    with pytest.raises(ValueError):
        write_extract(spark.range(1), str(tmp_path), date(2018, 1, 1), ("xml",))


def test_avro_needs_its_module(spark, tmp_path):
    try:
        write_extract(spark.range(3), str(tmp_path), date(2018, 1, 1), ("avro",))
    except Exception as error:
        assert "avro" in str(error).lower()
    else:
        assert report(spark, run_path(str(tmp_path), date(2018, 1, 1), "avro"), "avro")[0] == 3


def test_daily_job_from_files_to_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(materialize, "checkpoint_folder", lambda spark, folder=None: str(tmp_path / "shared"))
    services, costs = book_rows()
    costs = [(*c[:3], "CHF", *c[4:]) if c[2] == 2 else c for c in costs]
    rows = {name: services.get(name, []) for name in SERVICES}
    rows |= {
        "cost": costs,
        "extra_bond": [(1, 1, 1, 10, "A")],
        "discount_bond": [(10, "A", "BAD")],
        "campaign": [("BAD", "A", "N")],
        "tax": TAX,
        "currency": [("EUR", 2)],
        "fx_rate": [
            (kind, day, code, rate)
            for kind, content in FX_MAPPING.items()
            for day, rates in content["EXCHANGE_RATES"].items()
            for code, rate in rates.items()
        ],
        "booking_interface": [booking(1, 1), booking(1, 2), booking(1, 3, created=date(1996, 5, 2))],
    }
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for name, content in rows.items():
        frame(spark, name, content).write.parquet(f"{source}/{name}")
    run = daily_job.run(spark, date(1996, 5, 1), parquet_reader(spark, source), target, ("parquet", "csv"), None)
    assert run.rows == 2 and "tax_transfer_pricing_eur" in run.columns and "unconverted_lines" not in run.columns
    # Four cost lines of booking 2 and what booking 1 has in a currency that no snapshot of the day knows.
    assert run.figures["unconverted_lines"] == sum(c[1] in (1, 2) and c[3] == "CHF" and not (c[1] == 1 and c[2] == 1) for c in costs) > 0
    jobs.tell("day", run)
    assert not list((tmp_path / "shared").glob("stayledger-*"))
    assert load_books(parquet_reader(spark, source)).tax.small
    written = spark.read.parquet(run_path(target, date(1996, 5, 1), "parquet"))
    assert written.filter("transfer_pricing > 0").count() == 2
    total = written.agg(F.sum("tax_transfer_pricing_eur")).first()[0]
    assert run.figures["tax_transfer_pricing_eur"] == total > 0
    assert report(spark, run.paths["parquet"])[0] == run.rows


def test_materialized_frame_reads_its_files(spark, tmp_path):
    frame_ = materialized(spark.range(10).filter("id > 3"), str(tmp_path))
    assert frame_.count() == 6
    text = frame_._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in text and "Range" not in text


def test_files_of_a_block_go_with_it(spark, tmp_path):
    with materialized_while(spark.range(10), str(tmp_path)) as held:
        assert held.count() == 10 and len(list(tmp_path.iterdir())) == 1
    assert list(tmp_path.iterdir()) == []
    with pytest.raises(ZeroDivisionError), materialized_while(spark.range(3), str(tmp_path)):
        1 / 0
    assert list(tmp_path.iterdir()) == []


def test_figures_are_observed_in_the_write(spark, tmp_path):
    extract = spark.range(100).select("id", (F.col("id") % 3).alias("left_out"))
    context = spark.sparkContext
    context.setJobGroup("writing", "")
    try:
        run = write_extract(extract, str(tmp_path), date(2018, 1, 1), ("parquet",), {"total": F.sum("id"), "thirds": F.sum("left_out")}, ["left_out"])
        jobs_run = context.statusTracker().getJobIdsForGroup("writing")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert (run.rows, run.columns, run.figures) == (100, ["id"], {"total": 4950, "thirds": 99}) and len(jobs_run) == 1
    assert spark.read.parquet(run.paths["parquet"]).columns == ["id"]
    assert write_extract(extract.limit(0), str(tmp_path), date(2018, 1, 2), figures={"total": F.sum("id")}).figures == {"total": None}


def test_slices_are_even_and_hold_every_row_once(spark):
    # Nine tenths of the numbers lie in the last hundredth of the range, and one number has a tenth of the rows.
    numbers = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id") * 500).when(F.col("id") % 10 == 1, 9_999_999).otherwise(9_900_000 + F.col("id")).alias("id"))
    numbers = numbers.unionByName(spark.createDataFrame([(None,)] * 40, "id long"))
    found = even_slices(numbers, "id", 10)
    counts = [numbers.filter(condition).count() for condition in found.conditions]
    assert sum(counts) == numbers.count() == 20_040 and len(counts) >= 9 and max(counts) < 1.5 * 2004
    reader = Recorder()
    JdbcSource(SimpleNamespace(read=reader), "jdbc:x", {}).table("t", found)
    assert reader.calls[0][1]["predicates"] == list(found.conditions)
    assert even_slices(numbers.limit(0), "id", 4).conditions == ("1 = 1",) == even_slices(numbers, "id", 1).conditions


def test_slices_of_days_and_texts(spark):
    assert slices_at("d", [date(2020, 1, 1), date(2020, 2, 1)]).conditions == (
        "d < DATE '2020-01-01' OR d IS NULL",
        "d >= DATE '2020-01-01' AND d < DATE '2020-02-01'",
        "d >= DATE '2020-02-01'",
    )
    assert slices_at("c", ["it's"]).conditions[1] == "c >= 'it''s'"
    assert slices_at("t", [datetime(2020, 1, 1, 12)]).conditions[1] == "t >= TIMESTAMP '2020-01-01 12:00:00'"


def test_checkpoint_folder_is_named():
    def session(conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf.get(key, default)))

    assert checkpoint_folder(session({"spark.checkpoint.dir": "hdfs:///c"})) == "hdfs:///c"
    assert checkpoint_folder(session({}), "/given") == "/given"
    with pytest.raises(ValueError):
        checkpoint_folder(session({}))


def test_jdbc_reader_splits_large_tables():
    recorder = Recorder()
    name, split = parse_split("cost:id:1:100:4")
    read = jdbc_reader(JdbcSource(SimpleNamespace(read=recorder), "jdbc:x", {}), {name: split}, {"tax": "db.tax"})
    read("cost")
    read("tax")
    assert recorder.calls[0] == (("jdbc:x", "cost"), {"column": "id", "lowerBound": 1, "upperBound": 100, "numPartitions": 4, "properties": {}})
    assert recorder.calls[1] == (("jdbc:x", "db.tax"), {"properties": {}})


def test_a_job_reads_files_or_a_database():
    def given(**named):
        return SimpleNamespace(**{"input": None, "jdbc": None, "property": [], "split": [], **named})

    with pytest.raises(ValueError):
        jobs.reader(None, given())
    with pytest.raises(ValueError):
        jobs.reader(None, given(input="a", jdbc="b"))
    recorder = Recorder()
    read = jobs.reader(SimpleNamespace(read=recorder), given(jdbc="jdbc:x", property=["user=me"], split=[parse_split("cost:id:1:9:2")]))
    read("cost")
    assert recorder.calls[0][1]["numPartitions"] == 2 and recorder.calls[0][1]["properties"] == {"user": "me"}


def test_a_failed_rerun_leaves_the_day(spark, tmp_path):
    base, day = str(tmp_path), date(2018, 1, 1)
    write_extract(spark.range(5), base, day)
    with pytest.raises(Exception):
        write_extract(spark.range(5).select(F.raise_error(F.lit("stop")).alias("id")), base, day)
    assert report(spark, run_path(base, day, "parquet")) == (5, ["id"])
