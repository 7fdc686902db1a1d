"""Cross-entropy difference of every document under a target and a background bigram model over all words.

The models are never held whole: a document's pairs are dealt out by their second word, where the counts that
their losses need meet, and the losses are summed per document again. A document is scored by what the others hold:
its own counts are taken out of the models it is part of.
"""

from __future__ import annotations

import pickle
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_folder, checkpointed, table

PRIOR = 32.0
FLOOR = 0.5
# Pairs that a task of the second step holds, and the share of them from which a word or a pair is split.
PAIRS_HELD = 1_000_000
HOT_SHARE = 0.25
WORDS_KNOWN = 1 << 19
# Bytes of texts that a task works on at once.
TEXT_AT_ONCE = 1 << 23
# Bits of the filter of the target's ids, a fixed number at every size, and bits that an id sets.
FILTER_BITS = 1 << 26
FILTER_HASHES = 4
# The edge before the first word and, if the vocabulary is bounded, all words out of it.
NONE = 0
COUNTS = ["background", "target", "background_heads", "target_heads"]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; words are lower-case runs between white space, counted per batch before they move."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch["text"]:
                counts.update((text.as_py() or "").lower().split())
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return texts.select("text").mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _Ids:
    """Word ids by hash; with a vocabulary only its words have one."""

    def __init__(self, known: set[str] | None):
        self.known, self.ids = known, {}

    def __call__(self, text: str | None) -> np.ndarray:
        ids, out = self.ids, []
        if len(ids) > WORDS_KNOWN:
            ids.clear()
        for word in (text or "").lower().split():
            at = ids.get(word)
            if at is None:
                at = NONE
                if self.known is None or word in self.known:
                    at = (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) or 1) - (1 << 63)
                    at = at or 1
                ids[word] = at
            out.append(at)
        return np.array(out, dtype=np.int64)


def _batch(batch: pa.RecordBatch, ids: _Ids) -> tuple[np.ndarray, ...]:
    """Words, the words before them, their documents, whether another word follows; numbers of words and flags of all documents."""
    texts = [ids(t.as_py()) for t in batch["text"]]
    many = np.array([len(t) for t in texts], dtype=np.int64)
    word = np.concatenate([*texts, np.empty(0, dtype=np.int64)])
    doc = np.repeat(np.arange(len(many)), many)
    ends = np.cumsum(many)
    first, last = (ends - many)[many > 0], ends[many > 0] - 1
    before = np.roll(word, 1)
    before[first] = NONE
    heads = np.ones(len(word), dtype=np.int64)
    heads[last] = 0
    return word, before, doc, heads, many, batch["chosen"].to_numpy(zero_copy_only=False).astype(np.int64)


def _summed(keys: tuple[np.ndarray, ...], *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """An order that sorts by the keys (the first leads), the starts of equal ones in it, and the sums of values per start."""
    order = np.lexsort(keys[::-1])
    heads = np.zeros(len(order), dtype=bool)
    heads[:1] = True
    for key in keys:
        heads[1:] |= key[order][1:] != key[order][:-1]
    starts = np.flatnonzero(heads)
    return order, starts, [np.add.reduceat(v[order], starts) if len(starts) else v[:0] for v in values]


def unigrams(docs: DataFrame, known, words) -> DataFrame:
    """(word, times as a second and as a first of a pair in both models) over all rows; the edge counts as a first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(known.value)
        for batch in settled(batches, words.value):
            word, _, doc, heads, many, chosen = _batch(batch, ids)
            word = np.concatenate([word, np.full(len(many), NONE)])
            seconds = np.concatenate([np.ones(len(doc), dtype=np.int64), np.zeros(len(many), dtype=np.int64)])
            heads = np.concatenate([heads, (many > 0).astype(np.int64)])
            of = np.concatenate([chosen[doc], chosen])
            order, starts, sums = _summed((word,), seconds, seconds * of, heads, heads * of)
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (word[order][starts], *sums)], ["word", *COUNTS])

    rows = docs.mapInArrow(work, "word long, " + ", ".join(f"{c} long" for c in COUNTS))
    return rows.groupBy("word").agg(*(F.sum(c).alias(c) for c in COUNTS))


def hot_pairs(docs: DataFrame, known, words, hot) -> DataFrame:
    """(first, second, background, target) of the pairs whose words are both hot."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(known.value)
        often = hot.value["word"]
        for batch in settled(batches, words.value):
            word, before, doc, _, _, chosen = _batch(batch, ids)
            own = np.flatnonzero(np.isin(word, often) & (np.isin(before, often) | (before == NONE)))
            word, before, of = word[own], before[own], chosen[doc[own]]
            order, starts, sums = _summed((before, word), np.ones(len(own), dtype=np.int64), of)
            columns = (before[order][starts], word[order][starts], *sums)
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in columns], ["first", "second", "background", "target"])

    rows = docs.mapInArrow(work, "first long, second long, background long, target long")
    return rows.groupBy("first", "second").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


def _mixed(word: np.ndarray, other: np.ndarray | int = 0) -> np.ndarray:
    """Hashes of numbers or pairs of them."""
    a = word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.asarray(other).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    a ^= a >> np.uint64(29)
    a *= np.uint64(0xBF58476D1CE4E5B9)
    return a ^ (a >> np.uint64(32))


def _sent(*parts) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts, protocol=5))


def _received(data: bytes) -> list:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _small(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _places(hot_words: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(hot_words, word), max(0, len(hot_words) - 1))
    return at, (hot_words[at] == word) if len(hot_words) else np.zeros(len(word), dtype=bool)


def _pair_places(hot: dict, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs among the hot ones, which are sorted by their hashes, and whether they are there."""
    at, found = _places(hot["pair_hash"], _mixed(word, before))
    if len(hot["pair_hash"]):
        found = found & (hot["first"][at] == before) & (hot["second"][at] == word)
    return at, found


def _seen(doc: np.ndarray) -> np.ndarray:
    """Marks the numbers that occur, up to the greatest."""
    marks = np.zeros(int(doc.max(initial=-1)) + 1, dtype=bool)
    marks[doc] = True
    return marks


def dealt(docs: DataFrame, known, words, hot, parts: int) -> DataFrame:
    """(part, batch, data): the pairs of a batch of documents that go to a part, or the batch's documents themselves.

    A pair goes by its second word, one of a hot word by both, a hot pair by its document.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(known.value)
        held = hot.value
        for number, batch in enumerate(settled(batches, words.value)):
            name = (TaskContext.get().partitionId() << 32) + number
            word, before, doc, heads, many, chosen = _batch(batch, ids)
            order, starts, (n, follow) = _summed((word, before, doc), np.ones(len(word), dtype=np.int64), heads)
            word, before, doc = (a[order][starts] for a in (word, before, doc))
            del heads, order, starts
            # The edge is the first of a pair like the entry of no word.
            edges = np.bincount(doc, follow * (word == NONE), len(many)).astype(np.int64) + 1
            by = _mixed(word)
            split = _places(held["word"], word)[1]
            by[split] = _mixed(word[split], before[split])
            # A document's counts of a hot word are parted among tasks, so they go with each of its pairs.
            own_n, own_follow = np.zeros(len(word), dtype=np.int32), np.zeros(len(word), dtype=np.int32)
            own_n[split], own_follow[split] = _spread((word[split], doc[split]), n[split], follow[split])
            own_follow += word == NONE
            is_hot = _pair_places(held, before, word)[1]
            by[is_hot] = _mixed(doc[is_hot], name)
            part = (by % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1])) if len(order) else np.empty(0, dtype=np.int64)
            to, data = [int(_mixed(np.array([number]), name)[0] % np.uint64(parts))], [_sent("docs", batch["doc_id"].to_pylist(), many, chosen, edges)]
            for rows in np.split(order, cuts[1:]) if len(order) else ():
                # The rows of a part are still in the order of their words.
                heads = np.flatnonzero(np.append(True, word[rows[1:]] != word[rows[:-1]]))
                distinct, times = word[rows[heads]], np.diff(np.append(heads, len(rows)))
                firsts, code = np.unique(before[rows], return_inverse=True)
                of = doc[rows] * 2 + chosen[doc[rows]]
                hot_rows = rows[split[rows]]
                own = (_small(own_n[hot_rows]), _small(own_follow[hot_rows]), _small(many[np.flatnonzero(_seen(doc[rows]))]))
                sent = _sent("pairs", distinct, _small(times), firsts, _small(code), _small(of), _small(n[rows]), _small(n[rows] - follow[rows]), *own)
                to.append(int(part[rows[0]]))
                data.append(sent)
            columns = [pa.array(to, pa.int64()), pa.array([name] * len(to), pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "batch", "data"])

    return docs.mapInArrow(work, "part long, batch long, data binary")


def _spread(keys: tuple[np.ndarray, ...], *values: np.ndarray) -> list[np.ndarray]:
    """For every row the sums of the values over the rows of its keys."""
    order, starts, sums = _summed(keys, *values)
    many = np.diff(np.append(starts, len(order)))
    out = []
    for s in sums:
        spread = np.empty(len(order), dtype=float)
        spread[order] = np.repeat(s, many)
        out.append(spread)
    return out


def _part_losses(hot, size: int, totals: dict[str, int]):
    """A function from a part's rows to (batch, data) with the summed losses of the batch's documents in this part."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        held = hot.value
        out, name, columns, split = [], [], [], []
        for batch, data in zip(rows["batch"].tolist(), rows["data"].tolist(), strict=True):
            kind, *parts = _received(data)
            if kind == "docs":
                out.append((batch, data))
                continue
            words, times, firsts, code, of, n, last, *own, sizes = parts
            name.append(batch)
            of, n = of.astype(np.int32), n.astype(np.int32)
            place = np.cumsum(_seen(of >> 1)) - 1
            columns.append((np.repeat(words, times), firsts[code], of, n, n - last.astype(np.int32), sizes[place[of >> 1]].astype(np.int32)))
            split.append([a.astype(np.int64) for a in own])
        if columns:
            word, before, of, n, follow, tokens = (np.concatenate(c) for c in zip(*columns, strict=True))
            owner = np.repeat(np.arange(len(name), dtype=np.int32), [len(c[0]) for c in columns])
            del columns, rows
            chosen = of & 1
            # A document is named by its message and its number there.
            doc = owner.astype(np.int64) << 32 | (of >> 1)
            pairs = _spread((word, before), n, n * chosen)
            singles = _spread((word,), n, n * chosen, follow, follow * chosen)
            at, found = _places(held["word"], word)
            for total, c in zip(singles, COUNTS, strict=True):
                total[found] = held[c][at[found]]
            own = _spread((word, doc), n, follow)
            for mine, sent in zip(own, zip(*split, strict=True), strict=True):
                mine[found] = np.concatenate(sent)
            at, found = _pair_places(held, before, word)
            for total, c in zip(pairs, ("pair_background", "pair_target"), strict=True):
                total[found] = held[c][at[found]]
            losses = []
            for k, (model, inside) in enumerate((("background", 1), ("target", chosen))):
                share = (singles[k] - inside * own[0] + FLOOR) / (totals[model] - inside * tokens + FLOOR * size)
                heads = singles[k + 2] - inside * own[1]
                losses.append(follow * np.log(heads + PRIOR) - n * np.log(pairs[k] - inside * n + PRIOR * share))
            order, starts, sums = _summed((doc,), *losses)
            doc = doc[order][starts]
            owner, doc = doc >> 32, doc & 0xFFFFFFFF
            cuts = np.searchsorted(owner, np.arange(len(name) + 1))
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                out.append((name[i], _sent("losses", _small(doc[a:b]), *(s[a:b].astype(np.float32) for s in sums))))
        return pd.DataFrame(out, columns=["batch", "data"])

    return work


def _document_losses(totals: dict[str, int]):
    """A function from all rows of a batch to its documents with their mean losses."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_received(data) for data in rows["data"].tolist()]
        ((_, doc_ids, many, chosen, edges),) = [p for p in parts if p[0] == "docs"]
        columns = {"doc_id": pd.array(doc_ids, dtype="Int64"), "n_tokens": many}
        for k, model in enumerate(("background", "target")):
            inside = (many > 0) & ((chosen > 0) | (model == "background"))
            total = np.log(totals[f"{model}_edge"] - inside * edges + PRIOR)
            for p in parts:
                if p[0] == "losses":
                    total[p[1]] += p[2 + k]
            columns[f"{model}_loss"] = [float(t / n) if n else None for t, n in zip(total.tolist(), many.tolist(), strict=True)]
        out = pd.DataFrame(columns)
        return out[["doc_id", "n_tokens", "target_loss", "background_loss"]]

    return work


def _bit_places(ids: np.ndarray) -> np.ndarray:
    """FILTER_HASHES places in a filter for each id."""
    return np.concatenate([(_mixed(ids, k + 1) % np.uint64(FILTER_BITS)).astype(np.int64) for k in range(FILTER_HASHES)])


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the ids (column doc_id, no nulls) as 64-bit words, summed in tasks and by Spark; its size is fixed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
        for batch in batches:
            at = _bit_places(batch["doc_id"].to_numpy())
            np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(words[used].view(np.int64))], ["at", "bits"])

    found = ids.mapInArrow(work, "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    words[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return words


def _in_filter(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each id; no answer is wrong but a yes."""
    at = _bit_places(ids)
    return (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).reshape(FILTER_HASHES, -1).all(axis=0)


def marked(docs: DataFrame, target: DataFrame) -> tuple[DataFrame, Broadcast]:
    """(doc_id, text, chosen) of all rows, in an order that a repeated task finds the same, and a filter of the target's ids.

    The target grows with the corpus, so it is never broadcast, and texts are heavy to move. Only rows whose id a Bloom
    filter of the target may hold are joined with the ids, once, and kept as files in the shared folder with what
    was found. All rows stand here as well as they are read, with a null for ``chosen``; ``settled`` leaves out those
    that were joined.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = target.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    words = spark.sparkContext.broadcast(id_filter(ids))

    @F.pandas_udf("boolean")
    def maybe(found: pd.Series) -> pd.Series:
        return pd.Series(_in_filter(words.value, found.to_numpy()))

    chosen = ids.withColumn("chosen", F.lit(True)).hint("shuffle_merge")
    joined = rows.where("doc_id is not null").where(maybe("doc_id")).join(chosen, "doc_id", "left")
    joined = joined.select("doc_id", "text", F.coalesce("chosen", F.lit(False)).alias("chosen"))
    path = f"{checkpoint_folder(spark)}/target-{uuid.uuid4().hex}"
    joined.write.option("compression", "zstd").parquet(path)
    both = rows.withColumn("chosen", F.lit(None).cast("boolean")).unionByName(spark.read.schema(joined.schema).parquet(path))
    return both.sortWithinPartitions("doc_id", F.xxhash64("text")), words


def settled(batches: Iterator[pa.RecordBatch], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Batches of ``marked`` rows, each row once and its ``chosen`` known, of a bounded size."""
    for batch in batches:
        open_ = batch["chosen"].is_null().to_numpy(zero_copy_only=False)
        drop = open_ & batch["doc_id"].is_valid().to_numpy(zero_copy_only=False)
        drop[drop] = _in_filter(words, batch["doc_id"].fill_null(0).to_numpy()[drop])
        batch = batch.filter(pa.array(~drop)) if drop.any() else batch
        batch = pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], batch["chosen"].fill_null(False)], ["doc_id", "text", "chosen"])
        ends = np.cumsum([0 if size is None else size for size in pc.binary_length(batch["text"]).to_pylist()])
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_AT_ONCE, side="right")))
            yield batch.slice(at, to - at)
            at = to


def scored(docs: DataFrame, target: DataFrame, vocabulary: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, difference) per document row.

    The target model counts the documents whose doc_id ``target`` names, the background model all documents; both count
    whole texts of all their rows. A row is scored by models without it: its own counts are taken out of the background
    and, if it is in the target, of that too, so that the score tells what a document is like and not where it was counted.
    The models are matched: one order, one prior and one vocabulary, all words of all
    documents or, if ``vocabulary`` is given, so many most frequent ones (of equals the first in the alphabet) and one
    entry for all others. Words are told apart by 64-bit hashes. Losses are means per token in nats; a low difference
    tells that a document is more like the target.

    The counts stay in Spark. Only words and pairs that would fill a good part of a task are collected and broadcast
    with their exact counts, at most a few per task of the second step, so that their rows can be split.

    Null and empty texts have no tokens and null losses. Null ids are scored but never in the target. Repeated
    rows count each time and get equal results, each without itself but with the others; without target rows the
    target model knows only its prior. Very long texts are read whole. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    known = None
    if vocabulary is not None:
        known = set(word_counts(docs).orderBy(F.desc("n"), "word").limit(vocabulary).select("word").toArrow()["word"].to_pylist())
    known = spark.sparkContext.broadcast(known)
    rows, held = marked(docs, target)
    words = checkpointed(unigrams(rows, known, held))
    seen = words.agg(F.count(F.when(F.col("word") != NONE, 1)).alias("words"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS[:2])).first()
    edge = words.where(F.col("word") == NONE).select(*COUNTS).first()
    totals = {"background": seen["background"], "target": seen["target"]}
    totals |= {f"{m}_edge": edge[f"{m}_heads"] if edge else 0 for m in ("background", "target")}
    size = 1 + (seen["words"] if vocabulary is None else vocabulary)
    parts = max(1, -(-seen["background"] // PAIRS_HELD))
    least = max(1, int(HOT_SHARE * PAIRS_HELD))
    # The entry of no word counts edges too, so its heads are known only here.
    hot_rows = words.where((F.col("background") >= least) | (F.col("word") == NONE)).orderBy("word").toArrow()
    hot = {c: hot_rows[c].to_numpy() for c in ("word", *COUNTS)}
    found = hot_pairs(rows, known, held, spark.sparkContext.broadcast(hot)).where(F.col("background") >= least).toArrow() if parts > 1 else None
    pairs = {c: found[c].to_numpy() if found else np.empty(0, dtype=np.int64) for c in ("first", "second", "background", "target")}
    hashes = _mixed(pairs["second"], pairs["first"])
    order = np.argsort(hashes)
    hot |= {"pair_hash": hashes[order], "first": pairs["first"][order], "second": pairs["second"][order]}
    hot |= {f"pair_{m}": pairs[m][order] for m in ("background", "target")}
    hot = spark.sparkContext.broadcast(hot)
    losses = dealt(rows, known, held, hot, parts).groupBy("part").applyInPandas(_part_losses(hot, size, totals), "batch long, data binary")
    out = losses.groupBy("batch").applyInPandas(
        _document_losses(totals), "doc_id long, n_tokens long, target_loss double, background_loss double"
    )
    return out.withColumn("difference", F.col("target_loss") - F.col("background_loss"))


def op2_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").where("quality = 1")
    return scored(table(spark, sf_dir, "documents"), target)
