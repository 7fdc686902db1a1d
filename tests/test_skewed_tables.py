"""Sample tables in which one key owns a third of the rows, with no lookup small enough to broadcast."""

import duckdb
import pytest

import __spark_entry__
import workload.roles
from stayledger.operators import lookup
from stayledger.operators.lookup import Lookup
from tests.compare import differences, sample_tables

SOURCE = "/root/testdata/sf0.001"
QUERIES = __spark_entry__.queries()
STATEMENTS = __spark_entry__.oracle_sql()

# Rewritten columns of every third row; every sixth line is also forced into few line numbers.
HOT = {
    "orders": "CASE WHEN n % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey",
    "lineitem": """CASE WHEN n % 3 = 0 THEN 21 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN n % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
        CASE WHEN n % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey,
        CASE WHEN n % 6 = 0 THEN 3 ELSE l_linenumber END AS l_linenumber,
        CASE WHEN n % 3 = 0 THEN 'R' ELSE l_returnflag END AS l_returnflag,
        CASE WHEN n % 3 = 0 THEN 'O' ELSE l_linestatus END AS l_linestatus""",
    "events": "CASE WHEN n % 3 = 0 THEN 4 ELSE user_id END AS user_id",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name in workload.roles.SAMPLE_SCHEMAS:
        rows = f"SELECT * FROM '{SOURCE}/{name}.parquet'"
        if name in HOT:
            numbered = f"SELECT *, row_number() OVER () AS n FROM '{SOURCE}/{name}.parquet'"
            rows = f"SELECT * EXCLUDE (n) REPLACE ({HOT[name]}) FROM ({numbered})"
        connection.execute(f"COPY ({rows}) TO '{target}/{name}.parquet' (FORMAT parquet)")
    return str(target)


@pytest.mark.parametrize(
    "name",
    [
        "daily_extract_full",
        "cost_by_booking",
        "exclusion_keys",
        "sale_tax_lines",
        "tax_ttv",
        "tax_join_four_key",
        "fx_convert",
        "partner_rate_asof",
        "company_rate_type_asof",
        "booking_header",
        "destination_code",
        "contract_interval_join",
        "booking_key_semi",
        "first_row_join",
    ],
)
def test_query_matches_sql(spark, folder, name, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_MAX_BYTES", 0)
    monkeypatch.setattr(workload.roles, "fixed", lambda frame: Lookup(frame, False))
    assert differences(QUERIES[name](spark, folder), sample_tables(folder), STATEMENTS[name]) == []
