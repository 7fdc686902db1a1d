"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import made_once, shared_data, table

FILE = "byte_bpe_50k.tiktoken"
CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 16
QUADRATIC = 1 << 16
BUFFER = 1 << 16
PLACED = "doc_id long, piece int, piece_start long, n_tokens int, shard int, bin_id long, bin_offset int, bin_size int, capacity int"


def cost(capacity: int) -> float:
    """What a sequence of this length costs: a fixed part, its tokens, and attention that grows with the square."""
    return OVERHEAD + capacity + capacity * capacity / QUADRATIC


def pack(lengths: np.ndarray, capacities: Sequence[int] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every piece, (size, capacity) of every bin; pieces must be in falling order of length.

    A piece goes to the open bin that it leaves the least room in. If it fits none, a bin is opened with the
    permitted length of least cost per token that it can come to hold, given the tokens still to be placed;
    of equals the smallest. At the end each bin is cut down to the least permitted length that holds
    its contents. Open bins are found by their room: a bit set tells which rooms there are.
    """
    allowed = sorted(capacities)
    costs = {c: cost(c) for c in allowed}
    by_room: list[list[int]] = [[] for _ in range(allowed[-1] + 1)]
    rooms, free = 0, 0
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    sizes: list[int] = []
    left = int(lengths.sum())
    for i, length in enumerate(lengths.tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            free -= length
        else:
            more = max(0, left - length - free)
            capacity = min((c for c in allowed if c >= length), key=lambda c: (costs[c] / min(c, length + more), c))
            b, room = len(sizes), capacity
            sizes.append(0)
            free += capacity - length
        bins[i], offsets[i] = b, sizes[b]
        sizes[b] += length
        room -= length
        left -= length
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    held = np.array(sizes, dtype=np.int64)
    return bins, offsets, held, np.array(allowed)[np.searchsorted(allowed, held)]


def packed(docs: DataFrame, tokens: Column, capacities: Sequence[int] = CAPACITIES, shards: int | None = None, buffer: int = BUFFER) -> DataFrame:
    """One row per piece of a document: which of its tokens, in which bin, where, and the bin's size and capacity.

    ``tokens`` is the number of tokens of a row, at least one (an end mark); rows longer than the largest
    capacity are cut into pieces of that length and a rest. Only ids and lengths move: rows are dealt
    over ``shards`` (one per ``buffer`` rows if not given) by a hash of id, length and place, and packed there in buffers of
    ``buffer`` pieces, longest first, so memory is bounded whatever a shard holds. A bin is named by (shard, bin_id). The
    result depends on rows and parameters alone, however Spark deals out its partitions.

    Null and empty texts are one end mark, very long ones many pieces. Null ids stay null, and rows that repeat an id are
    packed like any others. Pieces of equal length are ties, taken in the order of their hash. An empty table gives no rows; other columns are ignored.
    """
    largest = max(capacities)
    keyed = docs.select(F.col("doc_id").cast("long"), F.greatest(tokens, F.lit(1)).cast("long").alias("tokens"))
    pieces = keyed.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {largest}")))).select(
        "doc_id",
        F.col("piece").cast("int"),
        (F.col("piece") * largest).alias("piece_start"),
        F.least(F.lit(largest), F.col("tokens") - F.col("piece") * largest).cast("int").alias("n_tokens"),
    )
    shards = shards or max(1, -(-docs.count() // buffer))
    place = F.xxhash64("piece", "doc_id", "n_tokens")
    dealt = pieces.withColumn("shard", F.pmod(place, F.lit(shards)).cast("int")).repartition("shard")
    allowed = tuple(capacities)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        shard, rows, bins = None, 0, 0
        for batch in batches:
            shards_here = batch["shard"].to_numpy()
            at = 0
            while at < len(batch):
                if shards_here[at] != shard:
                    if rows:
                        yield _packed(held, allowed, bins)[0]
                    shard, held, rows, bins = shards_here[at], [], 0, 0
                many = min(int(np.searchsorted(shards_here, shard, side="right")) - at, buffer - rows)
                held.append(batch.slice(at, many))
                at, rows = at + many, rows + many
                if rows == buffer:
                    out, more = _packed(held, allowed, bins)
                    yield out
                    held, rows, bins = [], 0, bins + more
        if rows:
            yield _packed(held, allowed, bins)[0]

    return dealt.sortWithinPartitions("shard", "piece", place, "doc_id", "n_tokens").mapInArrow(work, PLACED)


def _packed(held: list[pa.RecordBatch], capacities: Sequence[int], first: int) -> tuple[pa.RecordBatch, int]:
    rows = pa.Table.from_batches(held).combine_chunks()
    lengths = rows["n_tokens"].to_numpy()
    order = np.argsort(-lengths, kind="stable")
    bins, offsets, size, capacity = pack(lengths[order], capacities)
    rows = rows.take(pa.array(order))
    for name, values, kind in (
        ("bin_id", bins + first, pa.int64()),
        ("bin_offset", offsets, pa.int32()),
        ("bin_size", size[bins], pa.int32()),
        ("capacity", capacity[bins], pa.int32()),
    ):
        rows = rows.append_column(name, pa.array(values, kind))
    return rows.to_batches()[0], len(size)


def token_lengths(spark: SparkSession, file: str, pattern: str) -> Callable[[str], Column]:
    """A function of a text column that counts its tokens by a public tokenizer's ranks, in batches; null and empty texts have none."""
    with open(file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    shared = shared_data(spark, (pattern, ranks))

    def build(data):
        import tiktoken

        return tiktoken.Encoding("packed", pat_str=data[0], mergeable_ranks=data[1], special_tokens={})

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encoding = made_once(shared, build)
        return pd.Series([len(encoding.encode_ordinary(text)) if text else 0 for text in texts], dtype="int64")

    return count


def text_tokens(spark: SparkSession) -> Column:
    """Tokens of ``text`` and an end mark: what a sequence of the packed rows really takes."""
    import public_tokenizers

    return token_lengths(spark, public_tokenizers.path(FILE), public_tokenizers.PATTERN)("text") + 1


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), text_tokens(spark))
