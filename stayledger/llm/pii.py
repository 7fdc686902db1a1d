"""Personal data by base patterns, and by lexical contexts bootstrapped from what those find."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import checkpointed, packed_rows, table, unpacked_rows

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.5
MIN_SCORE = 0.7
# A word of a context counts by so many characters of it, those next to the identifier.
NEAREST = 64

_LOCAL = "A-Za-z0-9._%+-"
_EMAIL = rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_EMAIL_NEXT, _EMAIL_FRESH = re.compile(_EMAIL), re.compile(rf"(?<![{_LOCAL}]){_EMAIL}")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NUMBER = re.compile(r"\+?\(?[0-9][0-9() ./-]*[0-9]")
_AT_TOKEN = re.compile(r"(?<![^ \t-\r])[^ \t-\r@]++@[^ \t-\r]++")
_AT_SPELLED = re.compile(r"(?<![\w.+-])[\w.+-]++ ?[\[(]at[\])] ?[\w-]++(?: ?(?:\.|[\[(]dot[\])]) ?[\w-]++)+")
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_WORD = re.compile(r"\S+")
_EDGE = ".,;:!?\"'()[]{}<>|"

SPAN = "struct<kind:string,start:int,end:int,base:boolean,kinds:array<string>,value:string,patterns:array<string>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As the leftmost search for the address pattern, in linear time.

    An address can only start where a run of its first part starts, or where the last address ended.
    """
    at = 0
    while True:
        m = (_EMAIL_NEXT.match(text, at) if at else None) or _EMAIL_FRESH.search(text, at)
        if m is None:
            return
        yield m.span()
        at = m.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then by start; offsets in code points, ends exclusive."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def candidates(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, kinds it may be) of strings shaped like an identifier, whether a base pattern knows them or not."""
    for m in _NUMBER.finditer(text):
        digits = sum(map(str.isdigit, m[0])) if m.end() - m.start() >= 7 else 0
        kinds = [k for k, least, most in (("card", 13, 19), ("phone", 7, 15)) if least <= digits <= most]
        if m[0].count(".") == 3 and digits >= 4:
            kinds.append("ip")
        if kinds:
            yield *m.span(), kinds
    if "@" in text:
        for m in _AT_TOKEN.finditer(text):
            bare = m[0].rstrip(_EDGE)
            lead = len(bare) - len(bare.lstrip(_EDGE))
            if "@" in bare[lead:].strip("@"):
                yield m.start() + lead, m.start() + len(bare), ["email"]
    if "at]" in text or "at)" in text:
        for m in _AT_SPELLED.finditer(text):
            yield *m.span(), ["email"]
    if text.count(":") > 2:
        for m in _IP6.finditer(text):
            yield *m.span(), ["ip"]


class _Contexts:
    """The lexical patterns around places of a text: two words before, and one on each side."""

    def __init__(self, text: str):
        self.text = text
        spans = [m.span() for m in _WORD.finditer(text)]
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def patterns(self, start: int, end: int) -> list[str]:
        """Words that the place cuts count by what stands outside of it; the text's edges are ^ and $."""
        at = bisect_left(self.starts, start)
        left = [self._left(i, start) if i >= 0 else "^" for i in (at - 2, at - 1)]
        after = bisect_right(self.ends, end)
        right = "$"
        if after < len(self.ends):
            begin = max(self.starts[after], end)
            right = self.text[begin : min(self.ends[after], begin + NEAREST)].strip(_EDGE).lower()
        return [f"{left[0]} {left[1]} _", f"{left[1]} _ {right}"]

    def _left(self, i: int, start: int) -> str:
        end = min(self.ends[i], start)
        return self.text[max(self.starts[i], end - NEAREST) : end].strip(_EDGE).lower()


def scan(text: str) -> list[dict]:
    """Base spans and the candidates that overlap none of them, with the words around each."""
    rows = [(kind, a, b, True, [kind]) for kind, a, b in base_spans(text)]
    taken = sorted((a, b) for _, a, b, *_ in rows)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    for a, b, kinds in candidates(text):
        before = bisect_left(starts, b)
        if not before or reach[before - 1] <= a:
            rows.append((None, a, b, False, kinds))
    if not rows:
        return []
    contexts = _Contexts(text)
    names = ("kind", "start", "end", "base", "kinds", "value", "patterns")
    return [
        dict(zip(names, (*row, re.sub(r"[ ()/.-]", "", text[row[1] : row[2]]).lower(), contexts.patterns(row[1], row[2])), strict=True))
        for row in rows
    ]


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, spans): base spans and other candidates of every text with their contexts; the keys name the row."""

    schema = T.StructType.fromDDL(f"doc_id long, k1 long, k2 long, spans array<{SPAN}>")
    spans = to_arrow_type(schema["spans"].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([scan(text.as_py()) for text in batch["text"]], spans)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], ["doc_id", "k1", "k2", "spans"])

    text = F.coalesce("text", F.lit("")).alias("text")
    keys = (column.alias(name) for name, column in _keys().items())
    return docs.select(F.col("doc_id").cast("long"), *keys, text).mapInArrow(work, schema)


def _keys() -> dict[str, Column]:
    return {"k1": F.xxhash64("text"), "k2": F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.length("text"))}


def discovered(seen: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, min_score: float = MIN_SCORE) -> DataFrame:
    """(k1, k2, kind, start, end) of candidates that no base pattern found, by the contexts that their values stand in.

    The words around an identifier form its lexical patterns, and patterns and distinct values a graph. The values
    that base patterns found are the seeds, known for their kind. Each round scores a pattern and kind by the number
    of its known values over that of the values of any kind it extracts, keeps it if it has ``min_seeds`` known ones and
    ``min_confidence``, and scores every value by the chance that one of its kept patterns is right; a value of at
    least ``min_score`` is known from then on, like a seed. So values found in one context make patterns of others. What is
    known only grows, and the rounds go on until nothing is added.

    Every occurrence of a known value is returned, whatever surrounds it, of several kinds the one of the highest score, of
    equals the last in the alphabet. Counts are of distinct values, so copies of a document add nothing.
    """
    met = seen.select("k1", "k2", F.explode("spans").alias("s")).select("k1", "k2", "s.*")
    edges = (
        met.withColumn("kind", F.explode("kinds"))
        .select("value", "kind", "base", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "kind", "value")
        .agg(F.max("base").alias("base"))
    )
    # A pattern of fewer values can never have enough known ones.
    sizes = edges.groupBy("pattern").agg(F.countDistinct("value").alias("n")).where(F.col("n") >= min_seeds)
    edges = checkpointed(edges.join(sizes, "pattern"))
    # A value is a seed of its kind in all its contexts.
    seeds = edges.where("base").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    known, many = checkpointed(seeds), 0
    while (now := known.count()) > many:
        many = now
        patterns = (
            edges.join(known, ["value", "kind"])
            .groupBy("pattern", "kind")
            .agg(F.count("*").alias("hits"), F.first("n").alias("n"))
            .select("pattern", "kind", "hits", F.round(F.col("hits") / F.col("n"), 6).alias("confidence"))
            .where((F.col("hits") >= min_seeds) & (F.col("confidence") >= min_confidence))
        )
        chance = F.round(1 - F.exp(F.sum(F.log(1.000001 - F.col("confidence")))), 6)
        scores = edges.join(patterns, ["pattern", "kind"]).groupBy("value", "kind").agg(F.greatest(chance, F.lit(0.0)).alias("score"))
        found = scores.where(F.col("score") >= min_score).join(seeds, ["value", "kind"], "left_anti")
        known = checkpointed(seeds.unionByName(found))
    named = met.where("not base").select("k1", "k2", "start", "end", "value", F.explode("kinds").alias("kind")).join(known, ["value", "kind"])
    return named.groupBy("k1", "k2", "start", "end").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))


def personal_data(docs: DataFrame) -> DataFrame:
    """A row per document row: doc_id, keys k1 and k2, base and all spans as arrays of (rank, start, end).

    Base spans are exact and always stay; discovered ones never overlap them. Null texts count as empty and
    give empty arrays, null ids are kept. Rows with equal doc_id and text get equal results. An empty table
    gives no rows; other columns are ignored.
    """
    seen = checkpointed(scanned(docs))

    def row(kind, start, end):
        rank = F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int")
        return F.struct(rank.alias("rank"), start.alias("start"), end.alias("end"))

    more = discovered(seen).groupBy("k1", "k2").agg(F.collect_list(row(F.col("kind"), F.col("start"), F.col("end"))).alias("more"))

    return (
        seen.withColumn("base", F.transform(F.filter("spans", lambda s: s["base"]), lambda s: row(s["kind"], s["start"], s["end"])))
        .drop("spans")
        .join(more, ["k1", "k2"], "left")
        .withColumn("spans", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "more"))))
        .drop("more")
    )


def _joined(spans: str):
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["rank"]), s["start"], s["end"])), ",")


def masked(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets and n_chars counted anew.

    Of overlapping spans the first is replaced, of those that start together the longest. Null, empty and untouched texts
    stay as they are, repeated rows get equal results, very long texts are read whole. Other columns are kept, whatever their
    names; no rows give no rows.
    """
    found = personal_data(docs).select("k1", "k2", "spans").where(F.size("spans") > 0).dropDuplicates(["k1", "k2"])

    @F.pandas_udf("string")
    def mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans, strict=True):
            if found is not None and len(found):
                at, parts = 0, []
                for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        parts += [text[at : s["start"]], f"[{KINDS[s['rank'] - 1].upper()}]"]
                    at = max(at, s["end"])
                text = "".join(parts) + text[at:]
            out.append(text)
        return pd.Series(out)

    joined = packed_rows(docs, **_keys()).join(found, ["k1", "k2"], "left")
    own = F.col("row.text")
    return unpacked_rows(joined, docs.columns, F.when(F.col("spans").isNull(), own).otherwise(mask(own, "spans")))


def op3_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["rank"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(i + 1).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_discovered"),
    )
