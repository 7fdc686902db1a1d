"""Source tables under the names the jobs use."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from stayledger.operators.fx import FxRates
from stayledger.operators.lines import SERVICES, service_lines
from stayledger.operators.lookup import measured_together
from stayledger.operators.measures import Books
from stayledger.plans.wide import HeaderTables
from stayledger.sources.schemas import SCHEMAS

Reader = Callable[[str], DataFrame]


def parquet_reader(spark: SparkSession, folder: str) -> Reader:
    """Tables as ``folder/<name>`` parquet directories, read with their declared schemas."""

    def read(name: str) -> DataFrame:
        source = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
        return source.parquet(f"{folder}/{name}")

    return read


def load_books(read: Reader) -> Books:
    """Everything the measures read. The lookups' sizes are estimated here, without a job; no table is cached."""
    lookups = measured_together(
        {name: read(name) for name in ("discount_bond", "campaign", "tax", "currency", "fx_rate")}
    )
    return Books(
        lines=service_lines({name: read(name) for name in SERVICES}),
        costs=read("cost"),
        extra_bonds=read("extra_bond"),
        discount_bonds=lookups["discount_bond"],
        campaigns=lookups["campaign"],
        tax=lookups["tax"],
        currencies=lookups["currency"],
        fx=FxRates(lookups["fx_rate"]),
    )


def load_header_tables(read: Reader, views: Sequence[str]) -> HeaderTables:
    """Everything the wide extract reads; ``views`` names the per-booking measure views."""
    lookups = measured_together(
        {
            name: read(name)
            for name in (
                "tour_operator",
                "country",
                "receptive",
                "interface",
                "hotel_master",
                "contract_other",
                "destination",
                "daily_rate",
            )
        }
    )
    return HeaderTables(
        header=read("booking"),
        operators=lookups["tour_operator"],
        countries=lookups["country"],
        receptives=lookups["receptive"],
        interfaces=lookups["interface"],
        information=read("booking_information"),
        hotel_sales=read("hotel_sale"),
        hotels=lookups["hotel_master"],
        others=read("other_service"),
        contracts=lookups["contract_other"],
        destinations=lookups["destination"],
        resales=read("resale"),
        daily_rates=lookups["daily_rate"],
        measures=[read(name) for name in views],
    )


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make tables available to SQL. Each gets its own name, never one that is redefined later."""
    for name, table in tables.items():
        table.createOrReplaceTempView(f"{prefix}{name}")
