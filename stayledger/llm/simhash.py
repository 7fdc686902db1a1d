"""SimHash near-duplicates by a self-join of binary tries over the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, components, packed_rows, spanning_edges, table, unpacked_rows

BITS = 64
PARTS = 4
SEED = 42
WORDS = 4
PER_NODE = 1000
PER_BLOCK = 1 << 16
SHINGLES_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 18


def fingerprint(text: str | None, words: int = WORDS) -> bytes:
    """Eight bytes, highest bit first: each bit is set if it is set in over half of the shingles' hashes."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return bytes(BITS // 8)
    joined = b" ".join(tokens)
    ends = [end + i for i, end in enumerate(accumulate(map(len, tokens)))]
    starts = [0, *(end + 1 for end in ends[:-1])]
    ends = ends[words - 1 :] or ends[-1:]
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(ends), SHINGLES_AT_ONCE):
        spans = zip(starts[at:], ends[at : at + SHINGLES_AT_ONCE], strict=False)
        digests = b"".join([xxhash.xxh64_digest(joined[a:b], SEED) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, BITS // 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > len(ends)).tobytes()


def fingerprints(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """(key, fp) of every row (key, text); fp is the fingerprint as a signed integer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join([fingerprint(text.as_py(), words) for text in batch["text"]])
            prints = pa.array(np.frombuffer(raw, dtype=">i8").astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch["key"], prints], ["key", "fp"])

    return rows.select("key", "text").mapInArrow(work, f"key {dict(rows.dtypes)['key']}, fp long")


def similar_fingerprints(distinct: DataFrame, budget: int = 4, per_node: int = PER_NODE, per_block: int = PER_BLOCK) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column fp) with up to ``budget`` differing bits.

    Two such fingerprints differ in at most budget / 4 bits of one of their four quarters. So four tries
    are joined with themselves, each led by another quarter, and a pair of nodes is dropped as soon as it
    spends more than that on the leading quarter or more than the budget in all. The pairs of nodes at the
    top levels are dealt out by Spark: a fingerprint goes to the pairs that its own node is in. A task
    traverses the rest of its pair and returns a spanning forest of the links found, not the links. The
    number of top levels follows the number of fingerprints. A node that holds more than ``per_block`` of
    them is parted into blocks by hash, and every block of one node meets every block of the other in a task
    of its own. Only the numbers of blocks are broadcast: a row for each such node, at most PARTS << depth.
    """
    first = budget // PARTS
    quarter = BITS // PARTS
    count = distinct.count()
    depth = min(quarter, max(0, (max(1, count) // per_node).bit_length()))
    flips = [0] + ([1 << i for i in range(depth)] if first else [])
    if first > 1:
        flips = [m for m in range(1 << depth) if m.bit_count() <= first]
    turned = F.expr(f"shiftleft(fp, r * {quarter}) | shiftrightunsigned(fp, {BITS} - r * {quarter})")
    node = F.shiftrightunsigned("bits", BITS - depth) if depth else F.lit(0).cast("long")
    leaves = (
        distinct.select("fp")
        .withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        .withColumn("bits", F.when(F.col("r") == 0, F.col("fp")).otherwise(turned))
        .withColumn("node", node)
    )
    large = leaves.groupBy("r", "node").agg(F.ceil(F.count("*") / per_block).cast("int").alias("blocks")).where("blocks > 1")
    others = large.select("r", F.col("node").alias("other"), F.col("blocks").alias("lanes"))
    is_left = (F.col("node") < F.col("other")) | ((F.col("node") == F.col("other")) & (F.col("block") <= F.col("lane")))
    dealt = (
        leaves.withColumn("flip", F.explode(F.array(*[F.lit(m).cast("long") for m in flips])))
        .withColumn("other", F.col("node").bitwiseXOR(F.col("flip")))
        .join(F.broadcast(large), ["r", "node"], "left")
        .join(F.broadcast(others), ["r", "other"], "left")
        .withColumn("block", F.pmod(F.xxhash64("bits"), F.coalesce("blocks", F.lit(1)).cast("long")).cast("int"))
        .withColumn("lane", F.explode(F.sequence(F.lit(0), F.coalesce("lanes", F.lit(1)) - 1)))
        .withColumn("is_left", is_left)
        .select(
            "r",
            F.least("node", "other").alias("low"),
            F.greatest("node", "other").alias("high"),
            F.when(F.col("is_left"), F.col("block")).otherwise(F.col("lane")).alias("i"),
            F.when(F.col("is_left"), F.col("lane")).otherwise(F.col("block")).alias("j"),
            "is_left",
            "bits",
        )
    )

    def work(pairs: pd.DataFrame) -> pd.DataFrame:
        r, low, high, i, j = (int(pairs[c].iat[0]) for c in ("r", "low", "high", "i", "j"))
        bits = pairs["bits"].to_numpy().astype(np.uint64)
        side = pairs["is_left"].to_numpy()
        same = low == high and i == j
        left = np.sort(bits[side])
        right = left if same else np.sort(bits[~side])
        a, b = trie_join(left, right, same, depth, (low ^ high).bit_count(), first, budget)
        nodes = left if same else np.concatenate([left, right])
        a, b = spanning_edges(a, b, len(nodes))
        back = [_turn_back(nodes[x], r * quarter) for x in (a, b)]
        return pd.DataFrame({"a": back[0], "b": back[1]})

    return dealt.groupBy("r", "low", "high", "i", "j").applyInPandas(work, "a long, b long")


def _turn_back(bits: np.ndarray, by: int) -> np.ndarray:
    if by:
        bits = (bits >> np.uint64(by)) | (bits << np.uint64(BITS - by))
    return bits.astype(np.int64)


def trie_join(
    left: np.ndarray, right: np.ndarray, same: bool, level: int, spent: int, first: int, budget: int
) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the linked leaves below one pair of nodes; right leaves are numbered after left ones.

    Both arrays are sorted, so a node is a range of one; ``same`` tells that they are one array. A pair of
    nodes is split by the next bit into up to four pairs; those that differ in it spend one more of the
    budget. Blocks of pairs wait on a stack, and links are thinned to a forest whenever many have gathered,
    which bounds memory in dense groups.
    """
    quarter = BITS // PARTS
    zeros_left = [_zeros(left, at) for at in range(BITS)]
    zeros_right = zeros_left if same else [_zeros(right, at) for at in range(BITS)]
    nothing = np.empty(0, dtype=np.int64)
    found = [(nothing, nothing)]
    gathered, shift = 0, 0 if same else len(left)
    start = np.array([[0, len(left), 0, len(right), spent]], dtype=np.int64)
    stack = [(level, start)] if len(left) and len(right) else []
    while stack:
        level, pairs = stack.pop()
        if len(pairs) > PAIRS_AT_ONCE:
            half = len(pairs) // 2
            stack += [(level, pairs[:half]), (level, pairs[half:])]
            continue
        many = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        leaves = (many <= 8) if level < BITS else np.ones(len(pairs), dtype=bool)
        if leaves.any():
            a, b = _expand(pairs[leaves])
            near = np.bitwise_count(left[a] ^ right[b]) <= budget
            near &= (a < b) if same else True
            found.append((a[near], b[near] + shift))
            gathered += int(near.sum())
            if gathered > 4 * (len(left) + len(right)) + PAIRS_AT_ONCE:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                a, b = spanning_edges(a, b, shift + len(right))
                found, gathered = [(a, b)], len(a)
            pairs = pairs[~leaves]
        if not len(pairs):
            continue
        a0, a1, b0, b1, used = pairs.T
        am = a0 + zeros_left[level][a1] - zeros_left[level][a0]
        bm = b0 + zeros_right[level][b1] - zeros_right[level][b0]
        twin = (a0 == b0) & (a1 == b1) if same else np.zeros(len(pairs), dtype=bool)
        children = [
            np.column_stack([a0, am, b0, bm, used]),
            np.column_stack([am, a1, bm, b1, used]),
            np.column_stack([a0, am, bm, b1, used + 1]),
            np.column_stack([am, a1, b0, bm, used + 1])[~twin],
        ]
        pairs = np.concatenate(children)
        limit = first if level < quarter else budget
        keep = (pairs[:, 4] <= limit) & (pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2])
        if keep.any():
            stack.append((level + 1, pairs[keep]))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return a, b


def _zeros(bits: np.ndarray, level: int) -> np.ndarray:
    zero = (bits >> np.uint64(BITS - 1 - level)) & np.uint64(1) == 0
    return np.concatenate([[0], np.cumsum(zero)])


def _expand(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = pairs[:, 3] - pairs[:, 2]
    many = (pairs[:, 1] - pairs[:, 0]) * wide
    owner = np.repeat(np.arange(len(pairs)), many)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    return pairs[owner, 0] + at // wide[owner], pairs[owner, 2] + at % wide[owner]


def simhash_groups(docs: DataFrame, budget: int = 4, words: int = WORDS, per_node: int = PER_NODE) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept) per document row.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; shingles are four words, or all
    of a shorter text; a null or empty text has fingerprint zero and links like any other. Equal fingerprints
    are collapsed before the join, so a group of copies is one leaf. ``component_id`` is the least doc_id
    reachable by links; rows without doc_id take part, but never name a component. Rows that repeat a
    doc_id are one document and get equal results. Other columns are ignored; no rows give no rows.
    """
    prints = checkpointed(fingerprints(docs.select(F.col("doc_id").cast("long").alias("key"), "text"), words))
    joined = _rooted(prints, budget, per_node)
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(named, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        F.col("key").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), BITS // 4, "0").alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _rooted(prints: DataFrame, budget: int, per_node: int) -> DataFrame:
    """(fp, least, root) per distinct fingerprint: the least key that has it, and the root of its component."""
    by_print = prints.groupBy("fp").agg(F.min("key").alias("least"))
    links = components(similar_fingerprints(by_print, budget, per_node))
    return by_print.join(links, by_print["fp"] == links["id"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def without_near_copies(docs: DataFrame, budget: int = 4, words: int = WORDS, per_node: int = PER_NODE) -> DataFrame:
    """One whole row of every group that simhash_groups would link: the one of the least doc_id; rows without an id come last.

    An id does not decide: rows that share one but not their text are judged apart. Rows of one id are ordered by a hash
    of the whole row, so a repeated task keeps the same one; equal rows are kept once. Null and empty texts are a group,
    with all texts whose fingerprint is near zero. Other columns stay as they are; no rows give no rows.
    """
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    key = F.struct(F.col("doc_id").isNull().alias("none"), number.alias("id"), F.xxhash64(*docs.columns).alias("hash"))
    prints = checkpointed(fingerprints(docs.select(key.alias("key"), "text"), words))
    first = _rooted(prints, budget, per_node).groupBy("root").agg(F.min("least").alias("key")).select("key")
    kept = packed_rows(docs, key=key).join(first, "key", "left_semi").dropDuplicates(["key"])
    return unpacked_rows(kept, docs.columns)


def op9_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
