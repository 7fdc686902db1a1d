"""Result files, one directory per run date."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "avro", "csv")


@dataclass(frozen=True)
class Written:
    """What a run wrote: files by format, columns, rows and the figures it was asked to observe."""

    paths: dict[str, str]
    columns: list[str]
    rows: int
    figures: dict[str, object]


def run_path(base: str, run_date: date, fmt: str) -> str:
    return f"{base}/{fmt}/run_date={run_date.isoformat()}"


def write_extract(
    extract: DataFrame,
    base: str,
    run_date: date,
    formats: tuple[str, ...] = ("parquet",),
    figures: Mapping[str, Column] | None = None,
    unpublished: Sequence[str] = (),
) -> Written:
    """Write the extract of one run date; a rerun replaces that date only, once its files are complete.

    The plan runs once: further formats are written from the first one's files, and rows and ``figures`` (aggregates
    over the extract's rows, also of the ``unpublished`` columns, which the files leave out) are observed in that very
    write, so no job reads the output again for them. Dynamic overwrite stages the
    files and swaps them in at the end, so a rerun that fails leaves the day as it was.
    Avro needs Spark's avro module on the cluster.
    """
    unknown = set(formats) - set(FORMATS)
    if unknown or not formats:
        raise ValueError(f"formats must be among {FORMATS}, got {formats}")
    paths = {fmt: run_path(base, run_date, fmt) for fmt in formats}
    # A columnar first copy keeps the types for the others.
    ordered = sorted(formats, key=FORMATS.index)
    observation = Observation(f"extract-{uuid.uuid4().hex}")
    seen = extract.observe(observation, F.count(F.lit(1)).alias("rows"), *(figure.alias(name) for name, figure in (figures or {}).items()))
    extract = seen.drop(*unpublished)
    source = extract
    for fmt in ordered:
        dated = source.withColumn("run_date", F.lit(run_date.isoformat()))
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{base}/{fmt}")
        if source is extract and fmt not in ("csv", ordered[-1]):
            source = extract.sparkSession.read.schema(extract.schema).format(fmt).load(paths[fmt])
    observed = dict(observation.get)
    return Written(paths, extract.columns, observed.pop("rows"), observed)


def report(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[int, list[str]]:
    """Row count and columns of an extract that an earlier run wrote."""
    written = spark.read.format(fmt).load(path)
    return written.count(), written.columns
