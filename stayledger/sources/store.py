"""Lines written once in the layout that the joins by booking use: bucketed and sorted by booking.

Joins of such a table with bookings then move the bookings only. A store is a folder of bucketed Parquet tables,
which any session declares again by its manifest; it needs no metastore.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayledger.operators.lines import SERVICES, service_lines
from stayledger.operators.lookup import Lookup, measured
from stayledger.sources.catalog import Reader

# A booking of more lines is spread over this many parts, each in a bucket of its own.
HOT_LINES = 1_000_000
HOT_PARTS = 64
PART = "store_part"
MANIFEST = "manifest"
MANIFEST_SCHEMA = "name string, office string, booking string, buckets int, schema string"
HOT_SCHEMA = "name string, office bigint, booking bigint"


@dataclass(frozen=True)
class StoredLines:
    """One table of a store. ``hot`` names the bookings whose lines are spread; it has a row per booking of more than HOT_LINES."""

    frame: DataFrame
    office: str
    booking: str
    hot: Lookup
    parts: int

    def of(self, frame: DataFrame) -> StoredLines:
        """Lines derived row by row from these, with the key columns and the part still there."""
        return replace(self, frame=frame)

    def join(self, bookings: DataFrame, how: str = "inner") -> DataFrame:
        """Lines with their booking's columns (or, by ``left_semi``, the lines of some bookings), without moving a line.

        ``bookings`` has the same key columns as the lines. The few hot ones among them are repeated once per part.
        """
        key = [self.office, self.booking]
        spread = self.hot.of(self.hot.frame.select(F.col("office").alias(self.office), F.col("booking").alias(self.booking), F.lit(self.parts).alias("_parts")))
        every = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
        placed = spread.join(bookings, key, "left").withColumn(PART, F.explode(every)).drop("_parts")
        return self.frame.join(placed, [*key, PART], how).drop(PART)


class LineStore:
    """Bucketed tables in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, hot_lines: int = HOT_LINES, hot_parts: int = HOT_PARTS):
        self.spark, self.folder, self.hot_lines, self.hot_parts = spark, folder, hot_lines, hot_parts

    def _table(self, name: str) -> str:
        """A catalog name of this folder's own."""
        return f"store_{zlib.crc32(self.folder.encode()):08x}_{name}"

    def write(self, name: str, lines: DataFrame, office: str, booking: str, buckets: int) -> None:
        """Write a table, sorted by booking within so many buckets; choose them so that one fits a task's memory several times.

        Lines of a booking of more than ``hot_lines`` get a part number by a hash of the whole line and of the file split
        it was read from, which a repeated task finds the same; so no bucket holds them all, copies included.
        """
        key = [office, booking]
        counted = lines.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > self.hot_lines)
        hot = counted.select(F.lit(name).alias("name"), F.col(office).cast("bigint").alias("office"), F.col(booking).cast("bigint").alias("booking"))
        hot.write.mode("overwrite").parquet(f"{self.folder}/hot/{name}")
        spread = self._hot(name).frame.select(F.col("office").alias(office), F.col("booking").alias(booking), F.lit(True).alias("_hot"))
        part = F.pmod(F.xxhash64(*lines.columns, F.spark_partition_id()), F.lit(self.hot_parts)).cast("int")
        parted = self._hot(name).of(spread).join(lines.withColumn("_part", part), key, "left")
        parted = parted.select(*lines.columns, F.when(F.col("_hot"), F.col("_part")).otherwise(0).alias(PART))
        columns = [*key, PART]
        dealt = parted.repartition(buckets, *columns)
        table = self._table(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        writer = dealt.write.mode("overwrite").bucketBy(buckets, *columns).sortBy(*columns)
        writer.option("path", f"{self.folder}/lines/{name}").saveAsTable(table)
        row = [(name, office, booking, buckets, dealt.schema.json())]
        self.spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{MANIFEST}/{name}")

    def _hot(self, name: str) -> Lookup:
        """A row per booking of more than ``hot_lines``, so few that they are broadcast unless their files are large."""
        return measured(self.spark.read.schema(HOT_SCHEMA).parquet(f"{self.folder}/hot/{name}"))

    def open(self, name: str) -> StoredLines:
        """A table of the store, declared in this session's catalog if it is not yet."""
        manifest = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.folder}/{MANIFEST}/{name}").first()
        table, key = self._table(name), [manifest["office"], manifest["booking"], PART]
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(manifest["schema"])))
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({', '.join(key)}) SORTED BY ({', '.join(key)}) "
                f"INTO {manifest['buckets']} BUCKETS LOCATION '{self.folder}/lines/{name}'"
            )
        return StoredLines(self.spark.table(table), key[0], key[1], self._hot(name), self.hot_parts)


# The line tables, with their key columns.
LINE_TABLES = {"service": ("seq_rec", "seq_reserva"), "cost": ("grec_seq_rec", "rres_seq_reserva"), "sale": ("grec_seq_rec_s", "rres_seq_reserva")}


def write_lines(store: LineStore, read: Reader, buckets: Mapping[str, int]) -> None:
    """Write the tables that ``buckets`` names; the six service tables become one, tagged."""
    for name, many in buckets.items():
        lines = service_lines({service: read(service) for service in SERVICES}) if name == "service" else read(name)
        store.write(name, lines, *LINE_TABLES[name], many)
