"""What the jobs share: where tables come from."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stayledger.sources.catalog import Reader, parquet_reader
from stayledger.sources.jdbc import JdbcSource, jdbc_reader, parse_split
from stayledger.sources.sinks import FORMATS, Written


def add_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--input", help="folder of parquet tables")
    parser.add_argument("--jdbc", help="JDBC URL to read the tables from instead")
    parser.add_argument("--property", nargs="*", default=[], metavar="KEY=VALUE", help="JDBC connection properties")
    parser.add_argument("--split", nargs="*", default=[], type=parse_split, metavar="TABLE:COLUMN:LOWER:UPPER:SLICES")
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", nargs="+", choices=FORMATS, default=["parquet"])


def reader(spark: SparkSession, arguments: argparse.Namespace) -> Reader:
    if bool(arguments.input) == bool(arguments.jdbc):
        raise ValueError("name either --input or --jdbc")
    if arguments.input:
        return parquet_reader(spark, arguments.input)
    properties = dict(pair.split("=", 1) for pair in arguments.property)
    return jdbc_reader(JdbcSource(spark, arguments.jdbc, properties), dict(arguments.split))


def tell(name: str, written: Written) -> None:
    figures = ", ".join(f"{figure} {value}" for figure, value in written.figures.items())
    print(f"{name}: {written.rows} bookings, {len(written.columns)} columns, {figures}")
