"""Tables, lineage cuts and connected components shared by the operators of this package."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which executors share.

    Only a local session without that setting gets a temporary folder; on a cluster the setting is required.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-checkpoints-")
        context.setCheckpointDir(folder)
    return context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared folder; later steps and lost executors read it from there."""
    checkpoint_folder(frame.sparkSession)
    return frame.checkpoint()


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder of the file system that its name tells, if it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def packed_rows(docs: DataFrame, **more: Column) -> DataFrame:
    """Whole rows as one column ``row`` next to others, whose names so cannot clash with the rows' own."""
    return docs.select(F.struct(*docs.columns).alias("row"), *(column.alias(name) for name, column in more.items()))


def unpacked_rows(rows: DataFrame, columns: list[str], text: Column | None = None) -> DataFrame:
    """The rows again; with a new text, n_chars is counted anew."""
    new = {} if text is None else {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*(new.get(c, F.col("row")[c]).alias(c) for c in columns))


def shared_data(spark: SparkSession, data):
    """Plain data for all tasks; ``made_once`` builds what a Python worker makes of it, and keeps that between tasks."""
    return spark.sparkContext.broadcast({"data": data})


def made_once(shared, build):
    held = shared.value
    if "made" not in held:
        held["made"] = build(held["data"])
    return held["made"]


def spanning_edges(left: np.ndarray, right: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over nodes 0..nodes-1 that connects what the given edges connect."""
    root = np.arange(nodes)
    while True:
        a, b = root[left], root[right]
        open_ = a != b
        if not open_.any():
            break
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    moved = np.flatnonzero(root != np.arange(nodes))
    return moved, root[moved]


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node that an edge (a, b) touches; root is the least id it reaches.

    Alternating large-star and small-star rounds: the minimum of each node's neighbours is
    taken by a partial aggregate, so a node with many links is summed before it moves. The
    number of rounds grows with the logarithm of the longest path. Null ends and loops are ignored.
    """
    star = checkpointed(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = _signature(star)
    while seen[0]:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = checkpointed(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = _signature(star)
        if now == seen:
            break
        seen = now
    roots = star.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    return star.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots)


def _signature(star: DataFrame) -> tuple[int, int]:
    row = star.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
