"""How quality filters act on each other: what each removes, in every order of applying them.

A table-driven transducer reads the bytes of many texts at once. Its outcome per document is a set of failed filters, and
everything else follows from how many documents fail which set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

SYMBOLS = b"#$%&*|"
NAMES = "ABCDE"
BLOCK_BYTES = 1 << 18
LONG_WORD = 32

# Kinds of bytes, and the transducer's tables over them: the state a byte leads to (in a word or not) and what it counts as.
_OTHER, _SPACE, _CAPITAL, _SYMBOL, _FURTHER = range(5)
KIND = np.zeros(256, dtype=np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
KIND[ord("A") : ord("Z") + 1] = _CAPITAL
KIND[list(SYMBOLS)] = _SYMBOL
KIND[0x80:0xC0] = _FURTHER
IN_WORD = np.array([True, False, True, True, True])
STARTS_POINT = np.array([True, True, True, True, False])

_BASE = np.uint64(0x9E3779B97F4A7C15)
_DOC = np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS = np.concatenate([np.ones(1, dtype=np.uint64), np.full(BLOCK_BYTES, _BASE)]).cumprod(dtype=np.uint64)
COUNTS = ("n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols")


def _powers(n: int) -> np.ndarray:
    if n < len(_POWERS):
        return _POWERS
    return np.concatenate([np.ones(1, dtype=np.uint64), np.full(n, _BASE)]).cumprod(dtype=np.uint64)


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from a on equal those from b on, for every row."""
    same = np.ones(len(a), dtype=bool)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        same[i] = data[a[i] : a[i] + size[i]].tobytes() == data[b[i] : b[i] + size[i]].tobytes()
    rows = np.flatnonzero(size <= LONG_WORD)
    for k in range(LONG_WORD):
        rows = rows[size[rows] > k]
        if not len(rows):
            break
        differ = data[a[rows] + k] != data[b[rows] + k]
        if differ.any():
            same[rows[differ]] = False
            rows = rows[~differ]
    return same


def first_spans(data: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Marks one span of each distinct word of each document.

    All spans go into one open hash table in rounds: a span writes itself into its slot if that is free, then reads who
    holds it. If the holder is of the same document and the same bytes, compared one by one, the span is done; else it
    goes on to the next slot.
    """
    many = len(start)
    size = end - start
    powers = _powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    hashes = (sums[end] - sums[start]) * powers[len(data) - start]
    hashes ^= doc.astype(np.uint64) * _DOC
    bits = max(1, (2 * many).bit_length())
    mask = (1 << bits) - 1
    slot = ((hashes ^ (hashes >> np.uint64(29))) * _BASE >> np.uint64(64 - bits)).astype(np.int64)
    held = np.full(1 << bits, -1, dtype=np.int64)
    first = np.zeros(many, dtype=bool)
    todo = np.arange(many)
    while len(todo):
        at = slot[todo]
        free = held[at] < 0
        held[at[free]] = todo[free]
        holder = held[at]
        own = holder == todo
        first[todo[own]] = True
        like = ~own & (hashes[holder] == hashes[todo]) & (doc[holder] == doc[todo]) & (size[holder] == size[todo])
        rows = np.flatnonzero(like)
        like[rows] = _same_bytes(data, start[todo[rows]], start[holder[rows]], size[todo[rows]])
        todo = todo[~(own | like)]
        slot[todo] = (slot[todo] + 1) & mask
    return first


def transduce(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts (COUNTS by document) of the documents data[bounds[i]:bounds[i + 1]], and document, start and end of one span per distinct word."""
    kind = KIND[data]
    inside = IN_WORD[kind]
    lengths = np.diff(bounds)
    held = lengths > 0
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[bounds[:-1][held]] = False
    after[bounds[1:][held] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(bounds, start, side="right") - 1
    first = first_spans(data, doc, start, end)

    def per_document(marks: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[bounds])

    n = len(lengths)
    counts = [np.bincount(doc, minlength=n), np.bincount(doc[first], minlength=n)]
    counts += [per_document(marks) for marks in (kind == _CAPITAL, STARTS_POINT[kind], kind == _SYMBOL)]
    return np.array(counts, dtype=np.int64), doc[first], start[first], end[first]


def _long_counts(data: np.ndarray) -> np.ndarray:
    """Counts of one long document, read in blocks that end where a word does."""
    total, words, at = np.zeros(len(COUNTS), dtype=np.int64), set(), 0
    while at < len(data):
        to = at + BLOCK_BYTES
        while to < len(data) and IN_WORD[KIND[data[to - 1]]]:
            gap = np.flatnonzero(~IN_WORD[KIND[data[to : to + BLOCK_BYTES]]])
            to += int(gap[0]) + 1 if len(gap) else BLOCK_BYTES
        part = data[at:to]
        counts, _, start, end = transduce(part, np.array([0, len(part)]))
        total += counts[:, 0]
        words.update(part[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist(), strict=True))
        at = to
    total[1] = len(words)
    return total


def counts_of(texts: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """COUNTS by document of an array of texts, null ones counted as empty, and a digest of each text."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, held = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None and held.size else np.empty(0, dtype=np.uint8)
    out = np.zeros((len(COUNTS), len(texts)), dtype=np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, side="right")) - 1)
        block = data[bounds[at] : bounds[to]]
        if len(block) > BLOCK_BYTES:
            out[:, at] = _long_counts(block)
        elif len(block):
            out[:, at:to] = transduce(block, bounds[at : to + 1] - bounds[at])[0]
        at = to
    spans = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    return out, [hashlib.sha256(data[a:b]).digest() for a, b in spans]


def text_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns, COUNTS and ``digest`` (SHA-256) per document row.

    Words are what ASCII white space parts, case-sensitive; capitals are A to Z; symbols are SYMBOLS; n_chars counts code
    points. Null texts count as empty. Very long texts are read whole, in blocks; repeated rows get equal results.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests = counts_of(batch["text"])
            columns = [batch[c] for c in keep] + [pa.array(c) for c in counts] + [pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *COUNTS, "digest"])

    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), *(f"{c} long" for c in COUNTS), "digest binary"])
    return docs.select(*keep, "text").mapInArrow(work, schema)


def failures() -> Column:
    """The filters that a text fails by its own counts, as bits: 1 for A and so on."""
    rules = [
        F.col("n_words") < 200,
        100 * F.col("n_distinct") < 50 * F.col("n_words"),
        100 * F.col("n_capitals") > 2 * F.col("n_chars"),
        F.col("n_symbols") > 0,
    ]
    bits = F.lit(0)
    for i, rule in enumerate(rules):
        bits = bits + F.when(rule, 1 << i).otherwise(0)
    return bits


def failed_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, n): how many rows of each part fail which set of filters, by label.

    E, the last bit, is set if a row with a smaller doc_id has the same text. Rows are summed by text before their least
    id is sought, so a text of many copies is a few rows: one for every part and set of failures. Rows without an id have
    no smaller one and make no other fail. Of several labels of an id, one that says so is enough.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), "text")
    counted = text_counts(rows, "doc_id", "part").select("doc_id", "part", "digest", failures().alias("fails"))
    named = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    flags = named.agg(*(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))))
    kind = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    each = counted.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n")).join(flags, "doc_id", "left")
    marked = each.select("doc_id", "part", "digest", "fails", "n", *kind, F.col("doc_id").isNull().alias("none"))
    by_text = marked.groupBy("digest", "part", "fails", "good", "toxic", "none").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least")
    )
    least = F.min("least").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("none"), F.col("n")).when(F.col("least") == least, F.col("at_least")).otherwise(0)
    parted = by_text.select("part", "fails", "good", "toxic", "n", firsts.alias("firsts")).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct("fails", F.col("firsts").alias("n")),
                F.struct((F.col("fails") + 16).alias("fails"), (F.col("n") - F.col("firsts")).alias("n")),
            )
        ).alias("x"),
    )
    return parted.where("x.n > 0").groupBy("part", F.col("x.fails").alias("fails"), "good", "toxic").agg(F.sum("x.n").alias("n"))


def interactions(sets: DataFrame, names: str = NAMES) -> DataFrame:
    """A row for every part, order of the filters and step, from (part, fails, good, toxic, n).

    For every set of filters a part's rows that fail none of it are summed once; all figures are differences of these
    sums. ``shapley`` sums what a filter removes over all orders: a set of s others stands before it in
    s! (k - 1 - s)! of the k! orders. A part without rows does not appear.
    """
    k = len(names)
    everything = (1 << k) - 1
    passed = {"rows": F.col("n"), "good": F.col("good") * F.col("n"), "toxic": F.col("toxic") * F.col("n")}
    sums = [
        F.array(*[F.sum(F.when(F.col("fails").bitwiseAND(F.lit(m)) == 0, value).otherwise(0)) for m in range(1 << k)]).alias(f"{name}_passing")
        for name, value in passed.items()
    ]
    orders = list(permutations(range(k)))
    befores = [sum(1 << x for x in order[:i]) for order in orders for i in range(k)]
    bits = [1 << x for order in orders for x in order]

    def shapley(x: int) -> Column:
        total = F.lit(0).cast("long")
        for m in range(1 << k):
            if not m >> x & 1:
                weight = factorial(m.bit_count()) * factorial(k - 1 - m.bit_count())
                total = total + weight * (F.col("rows_passing")[m] - F.col("rows_passing")[m | 1 << x])
        return total

    shares = F.array(*[shapley(x) for x in range(k)])
    parts = sets.groupBy("part").agg(*sums).withColumn("shares", shares)
    steps = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(bits) - 1))).alias("i")).select(
        "*", F.lit(befores)[F.col("i")].alias("before"), F.lit(bits)[F.col("i")].alias("bit")
    )
    after = F.col("before").bitwiseOR(F.col("bit"))

    def passing(name: str, mask: Column | int) -> Column:
        return F.col(f"{name}_passing")[mask]

    def lost(name: str) -> Column:
        return passing(name, F.col("before")) - passing(name, after)

    return steps.select(
        "part",
        F.lit(["".join(names[x] for x in order) for order in orders])[F.expr(f"i div {k}").cast("int")].alias("filter_order"),
        (F.col("i") % k + 1).alias("step"),
        passing("rows", after).alias("kept"),
        lost("rows").alias("removed"),
        (passing("rows", 0) - passing("rows", F.col("bit")) - lost("rows")).alias("redundant"),
        (passing("rows", F.lit(everything).bitwiseXOR(F.col("bit"))) - passing("rows", everything)).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.col("shares")[F.log2(F.col("bit")).cast("int")].alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(failed_sets(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0b\\f\\r]'), lambda x: x <> '') AS words
  FROM documents
), failed AS (
  SELECT part,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM d
), sets AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY part, fails
), letter AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), judged AS (
  SELECT part, filter_order, step, x, n, good, toxic, contains(fails, x) AS fails_it, fails = x AS only_it,
         translate(fails, earlier, '') <> fails AS gone
  FROM sets, steps
), result AS (
  SELECT part, filter_order, step, x,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails_it), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails_it), 0) AS redundant,
         coalesce(sum(n) FILTER (only_it), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND fails_it), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND fails_it), 0) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM result
"""
