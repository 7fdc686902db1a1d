"""Toxicity by a linear classifier over character n-grams that are scaled by their naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import made_once, shared_data, table

SIZES = (3, 4, 5)
BITS = 20
SMOOTH = 1.0
MIN_DOCS = 3
# Rows of each label that the weights are fitted on.
FIT_ROWS = 2000
LEAST_RATIO = 0.25
DECAY = 3e-4
STEPS = 60
BLOCK_CHARS = 1 << 18
THRESHOLD = 0.7

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _code_points(text: str | None) -> np.ndarray:
    """Code points in lower case, every white space a blank, with one before and after the text."""
    plain = " ".join(["", *(text or "").lower().split(), ""])
    return np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _buckets(points: np.ndarray, size: int) -> np.ndarray:
    """The bucket of the n-gram that begins at every place; n-grams that are cut off have none."""
    many = max(0, len(points) - size + 1)
    h = np.full(many, size, dtype=np.uint64)
    for k in range(size):
        h = h * _MIX + points[k : k + many]
        h ^= h >> np.uint64(29)
    return ((h * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str | None, useful: np.ndarray | None = None) -> np.ndarray:
    """The distinct buckets of a text's n-grams, ascending; with ``useful``, those of them that it marks.

    Long texts are read in overlapping blocks, so memory is bounded by the number of buckets.
    """
    points = _code_points(text)
    found = np.empty(0, dtype=np.int64)
    for at in range(0, max(1, len(points) - min(SIZES) + 1), BLOCK_CHARS):
        new = np.concatenate([_buckets(points[at : at + BLOCK_CHARS + size - 1], size) for size in SIZES])
        if useful is not None:
            new = new[useful[new]]
        found = np.unique(np.concatenate([found, new]) if len(found) else new)
    return found


def log_count_ratios(labelled: DataFrame) -> np.ndarray:
    """log((p / |p|) / (q / |q|)) per bucket, p and q the smoothed numbers of label-1 and label-0 rows that hold it.

    All rows of ``labelled`` (text, label) are counted: a task sums its rows in two arrays of 2 ** BITS numbers, and
    Spark sums the tasks'. Buckets in fewer than MIN_DOCS rows, and those whose ratio is below LEAST_RATIO either way, get
    0 and so leave the model. What reaches the driver is bounded by the number of buckets.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"].to_pylist(), strict=True):
                counts[label, features(text.as_py())] += 1
        seen = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(seen), 1 << 16):
            part = seen[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[0, part]), pa.array(counts[1, part])], ["bucket", "clean", "toxic"])

    sums = labelled.mapInArrow(work, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = sums.where(F.col("clean") + F.col("toxic") >= MIN_DOCS).select(F.col("bucket").cast("int"), "clean", "toxic").toArrow()
    bucket = found["bucket"].to_numpy()
    ratios = np.zeros(1 << BITS, dtype=np.float32)
    if not len(bucket):
        return ratios
    shares = [np.log(n + SMOOTH) - np.log((n + SMOOTH).sum()) for n in (found["toxic"].to_numpy(), found["clean"].to_numpy())]
    ratios[bucket] = shares[0] - shares[1]
    return np.where(np.abs(ratios) >= LEAST_RATIO, ratios, np.float32(0))


def fit(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, decay: float = DECAY, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights per bucket and an intercept of the logistic regression on ratio-scaled, binary features.

    Minimised with a square penalty by Nesterov's accelerated gradient from zero, so equal input gives equal weights.
    """
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = np.concatenate([*rows, np.empty(0, dtype=np.int64)])
    used, column = np.unique(flat, return_inverse=True)
    scale = ratios[used].astype(np.float64)
    value = scale[column]
    owner = np.repeat(np.arange(len(rows)), np.diff(starts))
    # Classes weigh the same.
    share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    norms = np.bincount(owner, value * value, len(rows))
    rate = 1 / (decay + 0.25 * (share * (norms + 1)).sum())
    weight, intercept = np.zeros(len(used)), 0.0
    ahead, ahead_i, t = weight, intercept, 1.0
    for _ in range(steps):
        margin = np.bincount(owner, value * ahead[column], len(rows)) + ahead_i
        error = share * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels)
        gradient = np.bincount(column, value * error[owner], len(used)) + decay * ahead
        new, new_i = ahead - rate * gradient, ahead_i - rate * error.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_i = new + (t - 1) / t_next * (new - weight), new_i + (t - 1) / t_next * (new_i - intercept)
        weight, intercept, t = new, new_i, t_next
    weights = np.zeros(len(ratios), dtype=np.float32)
    weights[used] = weight * scale
    return weights, float(intercept)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label) of the rows whose doc_id has a label; a doc_id with several labels has the greatest.

    Labels grow with the corpus, so they are never broadcast: the join is a shuffle at every size.
    """
    one = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg((F.max("label") > 0).cast("int").alias("label"))
    one = one.select(F.col("doc_id").cast("long"), "label").hint("shuffle_merge")
    return docs.select(F.col("doc_id").cast("long"), "text").join(one, "doc_id").select("text", "label")


def fit_sample(labels: DataFrame, rows: int) -> DataFrame:
    """So many labels of each kind, those whose doc_id has the least hash."""
    parts = [labels.where(kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for kind in ("label > 0", "label <= 0")]
    return parts[0].unionByName(parts[1])


def trained(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """Weights per bucket and an intercept, learnt from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, label) names.

    The log-count ratios cover all labelled rows. The weights are fitted on a bounded sample of them: the labels that
    fit_sample picks, and only their documents' buckets reach the driver. Without rows of both labels all weights are 0.
    """
    spark = docs.sparkSession
    ratios = log_count_ratios(labelled(docs, labels))
    useful = shared_data(spark, ratios != 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text.as_py(), useful.value["data"]) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch["label"]], ["found", "label"])

    picked = fit_sample(labels.select("doc_id", "label").where("doc_id is not null and label is not null"), fit_rows)
    ids = F.broadcast(picked.groupBy("doc_id").agg((F.max("label") > 0).cast("int").alias("label")))
    # However many rows repeat an id, one text of it is taken, and always the same.
    sample = docs.select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = sample.mapInArrow(work, "found array<int>, label int").toArrow()
    label = rows["label"].to_numpy()
    if not 0 < label.sum() < len(label):
        return np.zeros(1 << BITS, dtype=np.float32), 0.0
    found = [r.values.to_numpy().astype(np.int64) for r in rows["found"]]
    # Sums of floats depend on the order of rows.
    order = sorted(range(len(found)), key=lambda i: (int(label[i]), found[i].tobytes()))
    return fit([found[i] for i in order], label[order].astype(np.int64), ratios)


def scored(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) per document row: the probability of label 1, and 1 where it reaches the threshold.

    A score depends on the text alone. Null and empty texts are scored like any other, by the intercept and what little
    they hold; so are rows without an id, and repeated rows get equal scores. Very long texts are read whole, in blocks.
    Other columns are ignored; no rows give no rows.
    """
    shared = shared_data(docs.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shared.value["data"]
        useful = made_once(shared, lambda data: data[0] != 0)
        for batch in batches:
            margins = np.array([weights[features(text.as_py(), useful)].sum(dtype=np.float64) + intercept for text in batch["text"]])
            scores = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learnt from, by checksum of the id; a row without an id is not one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op13_nb_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = trained(docs.where(~held_out()), labels.where(~held_out()))
    return scored(docs, model).withColumn("held_out", held_out())
