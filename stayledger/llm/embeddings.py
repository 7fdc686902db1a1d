"""Embedding near-duplicates: coarse inverted lists, product-quantised residuals, exact cosine rerank."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, components, made_once, shared_data, spanning_edges, table

THRESHOLD = 0.95
SAMPLE = 16_384
PARTS = 8
CODES = 64
ROUNDS = 8
PER_LIST = 256
MOST_LISTS = 4096
PROBE_WIDTH = 4.0
BLOCK = 2048
PAIRS_AT_ONCE = 1 << 21
# Vectors of a length from which it has an index.
FEW = 4096
FOUND = "key long, n long, a long, b long"


def kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of the points by Lloyd's rounds from evenly spaced ones; an empty cluster keeps its centre."""
    k = min(k, len(points))
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        many = np.bincount(near, minlength=k)
        centres[many > 0] = sums[many > 0] / many[many > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres**2).sum(axis=1)
    return np.concatenate([np.argmin(half - points[i : i + 4096] @ centres.T, axis=1) for i in range(0, max(len(points), 1), 4096)])


class Index:
    """Coarse centres and the codebooks of residuals' subspaces, fitted on a sample of unit vectors."""

    def __init__(self, fitted: tuple):
        self.centres, self.cuts, self.books = fitted

    @staticmethod
    def fit(sample: np.ndarray, lists: int) -> tuple:
        centres = kmeans(sample, lists)
        rest = sample - centres[nearest(sample, centres)]
        cuts = np.array_split(np.arange(sample.shape[1]), min(PARTS, sample.shape[1]))
        return centres, cuts, [kmeans(rest[:, cut], CODES) for cut in cuts]

    def encode(self, units: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the length of what the codes leave out of each vector."""
        rest = units - self.centres[lists]
        codes = np.column_stack([nearest(rest[:, cut], book) for cut, book in zip(self.cuts, self.books, strict=True)])
        left = rest - np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], axis=1)
        return codes, np.sqrt((left**2).sum(axis=1))

    def probes(self, unit: np.ndarray, threshold: float, width: float) -> np.ndarray:
        """(vector, list) of the lists to visit so that of two vectors within the threshold one visits the other's list.

        Such vectors lie within the distance r, and the plane between the centres of their lists lies between them. What
        the two are away from it adds up to r at most, so one of them is within half of r: each need look no farther, for
        it is found by the other then. That is certain to cover all at full width, the square root of the dimensions; the
        part of a random direction towards the plane is smaller by that root, and ``width`` of its standard deviations
        are allowed for.
        """
        r = np.sqrt(2 - 2 * threshold) * min(1.0, width / np.sqrt(unit.shape[1])) / 2
        half = 0.5 * (self.centres**2).sum(axis=1)
        score = unit @ self.centres.T - half
        own = score.argmax(axis=1)
        gap = np.sqrt(np.maximum(0, 2 * half[own, None] + 2 * half - 2 * (self.centres[own] @ self.centres.T)))
        return score >= score.max(axis=1, keepdims=True) - r * gap - 1e-9


def unit_vectors(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(rows with a usable vector, their unit vectors in double precision)."""
    usable = [i for i, v in enumerate(vectors) if v is not None and len(v)]
    if not usable:
        return np.empty(0, dtype=int), np.empty((0, 0))
    points = np.stack([np.asarray(vectors.iloc[i], dtype=np.float64) for i in usable])
    with np.errstate(all="ignore"):
        scale = np.abs(points).max(axis=1, keepdims=True)
        points = points / np.where(scale > 0, scale, 1)
        length = np.sqrt((points**2).sum(axis=1))
    good = np.isfinite(length) & (length > 0) & np.isfinite(scale[:, 0])
    return np.array(usable)[good], points[good] / length[good, None]


def linked(
    vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, per_list: int = PER_LIST, width: float = PROBE_WIDTH, few: int = FEW
) -> tuple[DataFrame, DataFrame]:
    """((key, n) links of distinct vectors with multiplicity, (a, b) edges that connect them) over columns key, embedding, times.

    Vectors of different lengths have no cosine and link with nothing. Every length of ``few`` vectors or more has an
    index of its own; those of fewer are compared in full, each length in a task.
    """
    size = F.size("embedding")
    many = vectors.groupBy(size.alias("d")).count().where(F.col("count") >= few).orderBy(F.desc("count"), "d").collect()
    found = [indexed(vectors.where(size == r["d"]), r["count"], threshold, sample, per_list, width) for r in many]
    found.append(_compared(vectors.where(~size.isin([r["d"] for r in many])), threshold))
    found = reduce(DataFrame.unionByName, found)
    return found.where("key is not null").groupBy("key").agg(F.sum("n").alias("n")), found.where("a is not null").select("a", "b")


def _compared(vectors: DataFrame, threshold: float) -> DataFrame:
    """Links (key, n) and edges (a, b) of vectors whose lengths are all rare, by all cosines within a length."""

    def work(group: pd.DataFrame) -> pd.DataFrame:
        rows, units = unit_vectors(group["embedding"])
        keys, weight = group["key"].to_numpy()[rows], group["times"].to_numpy()[rows]
        links, forest = np.zeros(len(keys), dtype=np.int64), (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
        step = max(1, PAIRS_AT_ONCE // max(1, len(keys)))
        for at in range(0, len(keys), step):
            a, b = np.nonzero(units[at : at + step] @ units.T >= threshold - 1e-9)
            a = a + at
            close = (np.einsum("ij,ij->i", units[a], units[b]) >= threshold) & (a != b)
            a, b = a[close], b[close]
            np.add.at(links, a, weight[b])
            forest = spanning_edges(np.concatenate([forest[0], a]), np.concatenate([forest[1], b]), len(keys))
        return _found(keys, links, keys[forest[0]], keys[forest[1]])

    return vectors.groupBy(F.size("embedding").alias("d")).applyInPandas(work, FOUND)


def _found(keys: np.ndarray, links: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    out = pd.DataFrame({"key": keys, "n": links}, dtype="Int64")
    return pd.concat([out[out["n"] > 0], pd.DataFrame({"a": a, "b": b}, dtype="Int64")])[["key", "n", "a", "b"]]


def indexed(vectors: DataFrame, total: int, threshold: float, sample: int, per_list: int, width: float) -> DataFrame:
    """Links (key, n) and edges (a, b) of ``total`` vectors of one length.

    The index is fitted on ``sample`` vectors of least hash; every vector is indexed. The number of lists follows the
    number of vectors, up to MOST_LISTS. A vector is stored in its nearest list and visits all lists that its
    probes name. Lists are split in blocks of residents and of visitors by hash, so that no task holds a list that
    has a large part of all vectors. In a task table look-ups bound every cosine: the approximation by codes is
    off by at most the length of what the codes leave out, so no pair above the threshold is lost here. The pairs
    left are compared in double precision. A pair counts once, whichever of the two visited the other. Links are
    summed and thinned to a spanning forest in the task, so pairs are never rows. What is broadcast has a row per list.
    """
    spark = vectors.sparkSession
    lists = int(min(MOST_LISTS, max(1, total // per_list)))
    held = vectors.orderBy(F.xxhash64("key"), "key").select("embedding").limit(sample).toPandas()["embedding"]
    units = unit_vectors(held)[1] if len(held) else np.zeros((1, 1))
    shared = shared_data(spark, Index.fit(units, lists))

    def place(batches):
        index = made_once(shared, Index)
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.iloc[at : at + BLOCK]
                rows, points = unit_vectors(part["embedding"])
                if not len(rows):
                    continue
                visit = index.probes(points, threshold, width)
                home = nearest(points, index.centres)
                visit[np.arange(len(home)), home] = True
                part = part.iloc[rows]
                yield pd.DataFrame(
                    {
                        "key": part["key"].to_numpy(),
                        "times": part["times"].to_numpy(),
                        "unit": list(points),
                        "home": home,
                        "visits": [np.flatnonzero(v) for v in visit],
                    }
                )

    placed = checkpointed(
        vectors.select("key", "times", "embedding").mapInPandas(place, "key long, times long, unit array<double>, home int, visits array<int>")
    )
    sizes = placed.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    spread = F.pmod(F.xxhash64("key"), F.col("parts").cast("long")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rest = ("key", "times", "unit", "home", "visits")
    residents = placed.join(F.broadcast(sizes), "home").select(
        F.col("home").alias("list"), spread.alias("block"), every.alias("lane"), F.lit(True).alias("resident"), *rest
    )
    visitors = (
        placed.withColumn("list", F.explode("visits"))
        .join(F.broadcast(sizes.withColumnRenamed("home", "list")), "list")
        .select("list", every.alias("block"), spread.alias("lane"), F.lit(False).alias("resident"), *rest)
    )

    def work(group: pd.DataFrame) -> pd.DataFrame:
        index = made_once(shared, Index)
        here = int(group["list"].iat[0])
        resident = group["resident"].to_numpy()
        stay, come = group[resident], group[~resident]
        empty = pd.DataFrame({"key": [], "n": [], "a": [], "b": []}, dtype="Int64")
        if stay.empty or come.empty:
            return empty
        keys, guests = stay["key"].to_numpy(), come["key"].to_numpy()
        units, points = np.stack(stay["unit"].to_list()), np.stack(come["unit"].to_list())
        weight, weights = stay["times"].to_numpy(), come["times"].to_numpy()
        homes = come["home"].to_numpy()
        asks = np.zeros((len(stay), len(index.centres)), dtype=bool)
        for i, v in enumerate(stay["visits"]):
            asks[i, v] = True
        codes, missing = index.encode(units, np.full(len(units), here))
        links, guest_links = np.zeros(len(keys), dtype=np.int64), np.zeros(len(guests), dtype=np.int64)
        names, node = np.unique(np.concatenate([keys, guests]), return_inverse=True)
        forest = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
        step = max(1, PAIRS_AT_ONCE // len(keys))
        for at in range(0, len(guests), step):
            some = points[at : at + step]
            near = np.repeat((some @ index.centres[here])[:, None], len(keys), axis=1)
            for i, (cut, book) in enumerate(zip(index.cuts, index.books, strict=True)):
                near += (some[:, cut] @ book.T)[:, codes[:, i]]
            guest, host = np.nonzero(near + missing >= threshold - 1e-9)
            close = np.einsum("ij,ij->i", some[guest], units[host]) >= threshold
            guest, host = guest[close] + at, host[close]
            other = guests[guest] != keys[host]
            guest, host = guest[other], host[other]
            np.add.at(guest_links, guest, weight[host])
            unasked = ~asks[host, homes[guest]]
            np.add.at(links, host[unasked], weights[guest[unasked]])
            a, b = node[len(keys) + guest], node[host]
            forest = spanning_edges(np.concatenate([forest[0], a]), np.concatenate([forest[1], b]), len(names))
        return _found(np.concatenate([keys, guests]), np.concatenate([links, guest_links]), names[forest[0]], names[forest[1]])

    return checkpointed(residents.unionByName(visitors).groupBy("list", "block", "lane").applyInPandas(work, FOUND))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per vector row.

    Vectors link if their cosine in double precision is at least ``threshold`` and the index brings them together;
    labels and other columns are ignored. Rows with equal vectors are collapsed before the search and link with each other
    directly, as do vectors of one length only; each length is searched by itself. Null, empty, zero and non-finite vectors
    link with nothing and are kept. Rows without vec_id take part, but never name a component; if no other row is in theirs,
    component_id is null and they are kept. Rows that repeat an id are counted like others. An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    usable = whole & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("key", F.when(usable, F.xxhash64("embedding")))
    distinct = rows.where("key is not null").groupBy("key").agg(F.first("embedding").alias("embedding"), F.count("*").alias("times"), F.min("vec_id").alias("least"))
    distinct = checkpointed(distinct)
    counts, edges = linked(distinct, threshold, **options)
    links = components(edges)
    sets = distinct.select("key", "times", "least").join(links, distinct["key"] == links["id"], "left").select(
        "key", "times", "least", F.coalesce("root", "key").alias("root")
    )
    named = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    named = sets.join(named, "root").join(counts, "key", "left").select(
        "key", "component_id", (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")
    )
    out = rows.select("vec_id", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), component.isNull()).alias("kept"),
    )


def op6_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
