"""Tables written out in a program."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def inline(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """Rows as a literal in the plan, without a Python task to produce them."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows, strict=True))
    table = pa.table({field.name: list(column) for field, column in zip(schema, columns, strict=True)})
    return spark.createDataFrame(table, schema)
