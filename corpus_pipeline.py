"""Corpus cleaning: quality rules, near duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() applies them to documents, and
writes every stage's rows as Parquet for the next one to read.
"""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayledger.llm.common import checkpoint_folder, packed_rows, remove, table, unpacked_rows  # noqa: E402
from stayledger.llm.packing import packed, text_tokens  # noqa: E402
from stayledger.llm.pii import masked  # noqa: E402
from stayledger.llm.quality import quality  # noqa: E402
from stayledger.llm.simhash import without_near_copies  # noqa: E402
from stayledger.llm.suffix import without_repeats  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with all their columns.

    Null and empty texts have too few words and go. Rows equal in id, source and text are judged alike, rows that share an id
    only each by itself; very long texts are judged whole. No rows give no rows.
    """
    host = F.coalesce("source", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    rejected = quality(docs).where("not kept").select("row_key").distinct()
    keyed = packed_rows(docs, row_key=F.xxhash64(F.col("doc_id").isNull(), "doc_id", host, text))
    return unpacked_rows(keyed.join(rejected, "row_key", "left_anti"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group that SimHash links, by four-word shingles and up to four differing bits, with all its columns.

    It is the row of the least id, of equals the one of the least hash; rows without an id come last. Null and empty
    texts are one group. Very long texts count whole. No rows give no rows.
    """
    return without_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier, in a smaller id or earlier in the same text.

    Null and empty texts and all other columns stay; n_chars follows the text. Rows equal in id and text count as one. Very
    long texts are read whole. No rows give no rows.
    """
    return without_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; null and empty texts and all other columns stay, n_chars follows the text.

    Repeated rows are masked alike, very long texts whole. No rows give no rows.
    """
    return masked(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of permitted lengths, counted in tokens of a public tokenizer.

    A null or empty text is one end mark, a very long one several pieces; rows without an id and repeated rows are packed
    like any others. No rows give no rows.
    """
    return packed(docs, text_tokens(spark))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Suffix arrays, fingerprints by XXH64 and learned patterns have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        # The stage's files hold all that the next one needs.
        if before:
            remove(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
