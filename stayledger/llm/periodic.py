"""Periodic runs of words, found in a grammar of the text rather than in the text.

Re-Pair turns the word ids of a text into rules of two symbols and a short top sequence. A run either lies inside one
symbol or crosses the boundary between two, so only boundaries are searched: each rule's once, however often the rule
occurs, and the boundaries of the top sequence as those of a balanced tree over it.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

LEAST_WORDS = 6
LEAST_EXPONENT = 4
RUN = "start long, length long, period long"


class Rule(NamedTuple):
    left: int
    right: int
    start: int  # where the symbol stands for the first time
    middle: int  # where its right part begins there
    end: int


def word_ids(words: list) -> list[int]:
    seen: dict = {}
    return [seen.setdefault(w, len(seen)) for w in words]


def repair(ids: list[int]) -> tuple[dict[int, Rule], list[tuple[int, int]]]:
    """Rules by their symbols, parts before wholes, and the top sequence as (symbol, start).

    The most frequent pair of neighbours becomes a symbol, of equals the one seen first, until no pair repeats.
    """
    n = len(ids)
    counts = {pair: c for pair, c in Counter(zip(ids, islice(ids, 1, None))).items() if c > 1}
    if not counts:
        return {}, list(zip(ids, range(n)))
    where = defaultdict(list)
    for i, pair in enumerate(zip(ids, islice(ids, 1, None))):
        if pair in counts:
            where[pair].append(i)
    symbol, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(-c, where[pair][0], pair) for pair, c in counts.items()]
    heapq.heapify(heap)
    rules: dict[int, Rule] = {}
    ends = list(range(1, n + 1))
    fresh = max(ids) + 1
    while heap:
        key, first, pair = heapq.heappop(heap)
        now = counts.get(pair, 0)
        if now < 2:
            continue
        if now != -key:
            heapq.heappush(heap, (-now, first, pair))
            continue
        a, b = pair
        places, free = [], 0
        for i in where.pop(pair):
            if i >= free and symbol[i] == a and after[i] < n and symbol[after[i]] == b:
                places.append(i)
                free = after[i] + 1
        del counts[pair]
        if len(places) < 2:
            continue
        made = set()
        for i in places:
            j = after[i]
            k, h = after[j], before[i]
            if h >= 0 and (old := (symbol[h], a)) in counts:
                counts[old] -= 1
            if k < n and (old := (b, symbol[k])) in counts:
                counts[old] -= 1
            symbol[i], symbol[j] = fresh, -1
            after[i], ends[i] = k, ends[j]
            if k < n:
                before[k] = i
                new = (fresh, symbol[k])
                where[new].append(i)
                made.add(new)
            if h >= 0:
                new = (symbol[h], fresh)
                # A second symbol right after a first one has that pair already.
                if not (where[new] and where[new][-1] == h):
                    where[new].append(h)
                made.add(new)
        i = places[0]
        rules[fresh] = Rule(a, b, i, i + (rules[a].end - rules[a].start if a in rules else 1), ends[i])
        for new in made:
            if len(where[new]) > 1:
                counts[new] = len(where[new])
                heapq.heappush(heap, (-counts[new], where[new][0], new))
            else:
                del where[new]
        fresh += 1
    top, i = [], 0
    while i < n:
        top.append((symbol[i], i))
        i = after[i]
    return rules, top


def _common_after(ids: list[int], a: int, b: int, end: int) -> int:
    """How many words from a on equal those from b on, b + that <= end."""
    start, step = a, 8
    apart = b - a
    while step:
        if a + step + apart <= end and ids[a : a + step] == ids[a + apart : a + apart + step]:
            a += step
            step *= 2
        else:
            step //= 2
    return a - start


def _common_before(ids: list[int], a: int, b: int, start: int) -> int:
    """How many words before a equal those before b, a - that >= start."""
    was, step = a, 8
    apart = b - a
    while step:
        if a - step >= start and ids[a - step : a] == ids[a - step + apart : a + apart]:
            a -= step
            step *= 2
        else:
            step //= 2
    return was - a


class _Search:
    """Runs of a text: those that cross a boundary, and those inside symbols."""

    def __init__(self, ids: list[int], least: int, exponent: int):
        self.ids, self.least, self.exponent = ids, least, exponent
        counts = Counter(zip(ids, islice(ids, 1, None)))
        # A run of e periods holds each pair of neighbours in it e - 1 times at least.
        often = {pair for pair, c in counts.items() if c >= exponent - 1}
        self.places = defaultdict(list)
        for i, pair in enumerate(zip(ids, islice(ids, 1, None))):
            if pair in often:
                self.places[pair].append(i)

    def crossing(self, start: int, middle: int, end: int) -> list[tuple[int, int, int]]:
        """(start, end, period) of the runs of ids[start:end], as far as they go in there, that hold words on both sides of the middle.

        Such a run has two whole periods before the middle or after it, so its period leads from the pair of words at
        the middle to another place of that pair, and a square begins or ends there.
        """
        ids = self.ids
        places = self.places.get((ids[middle - 1], ids[middle]), ())
        reach = (end - start) // self.exponent
        if not places or not reach:
            return []
        lo, hi = bisect_left(places, max(start, middle - 1 - reach)), bisect_right(places, min(end - 2, middle - 1 + reach))
        found: list[tuple[int, int, int]] = []
        for q in sorted({abs(p - middle + 1) for p in places[lo:hi]} - {0}):
            right = middle + 2 * q <= end
            left = middle - 2 * q >= start
            for s, e, r in found:
                if q % r == 0:
                    # The square's root repeats a shorter one.
                    right = right and not (s <= middle and middle + 2 * q <= e)
                    left = left and not (s <= middle - 2 * q and middle <= e)
            bases = []
            if left and ids[middle - q : middle] == ids[middle - 2 * q : middle - q]:
                bases.append(middle - 2 * q)
            if right and ids[middle : middle + q] == ids[middle + q : middle + 2 * q]:
                bases.append(middle)
            for base in bases:
                s = base - _common_before(ids, base, base + q, start)
                e = base + q + _common_after(ids, base, base + q, end)
                if (s, e, q) not in found:
                    found.append((s, e, q))
        return [(s, e, q) for s, e, q in found if s < middle < e and e - s >= max(self.least, self.exponent * q)]


def _merged(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Stretches of one period that share a whole period are one run."""
    if len(runs) < 2:
        return runs
    out: list[tuple[int, int, int]] = []
    for s, e, q in sorted(runs, key=lambda r: (r[2], r[0], r[1])):
        if out and out[-1][2] == q and out[-1][1] - s >= q:
            out[-1] = (out[-1][0], max(e, out[-1][1]), q)
        else:
            out.append((s, e, q))
    return out


def word_runs(words: list, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of words, by start, then period.

    A run is a stretch with smallest period q, of at least ``least`` words and ``exponent`` periods (4 or more), that
    neither neighbouring word continues.
    """
    if exponent < 4:
        raise ValueError("a shorter run need not have two periods on one side of a boundary")
    if len(words) < least:
        return []
    ids = word_ids(words)
    rules, top = repair(ids)
    if not rules:
        return []
    search = _Search(ids, least, exponent)
    inside: dict[int, list[tuple[int, int, int]]] = {}
    for symbol, rule in rules.items():
        runs = search.crossing(rule.start, rule.middle, rule.end)
        runs = [(s - rule.start, e - rule.start, q) for s, e, q in runs]
        runs += inside.get(rule.left, ())
        if rule.right in inside:
            by = rule.middle - rule.start
            runs += [(s + by, e + by, q) for s, e, q in inside[rule.right]]
        if runs:
            inside[symbol] = _merged(runs)
    runs = []
    starts = [at for _, at in top] + [len(ids)]
    for i, (symbol, at) in enumerate(top):
        if symbol in inside:
            runs += [(s + at, e + at, q) for s, e, q in inside[symbol]]
        if i:
            # The balanced tree over the top sequence: this boundary parts the two halves of a block of 2 * half symbols.
            half = i & -i
            runs += search.crossing(starts[i - half], at, starts[min(i + half, len(top))])
    return sorted(((s, e - s, q) for s, e, q in _merged(runs)), key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    drop = [0] * (len(words) + 1)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    depth, out = 0, []
    for word, change in zip(words, drop):
        depth += change
        if not depth:
            out.append(word)
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; of equals the first, then the one of the least period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    exponent: int = LEAST_EXPONENT,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(doc_id, n_words, runs, strongest, collapsed) per document row; runs count words from 0.

    ``runs`` holds every run (start, length, period) by start, then period; ``strongest`` the one of the greatest
    length / period or null; ``collapsed`` the words that no run repeats, joined by single spaces. Words are what
    ASCII white space parts. ``rewrite``, if given, changes a document's words before they are searched.

    Null and empty texts have no words, no runs and an empty collapsed text. Ties of ``strongest`` go to the least
    start, then period. Rows are judged each by itself, so repeated rows and null ids give equal results; other columns
    are ignored; no rows give no rows. Time grows with n log n words of a text, memory with n.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def record(found):
        return dict(zip(("start", "length", "period"), found, strict=True))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many, all_runs, best, texts = [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                if rewrite:
                    words = rewrite(doc_id, words)
                runs = word_runs(words, least, exponent)
                top = strongest(runs)
                many.append(len(words))
                all_runs.append([record(r) for r in runs])
                best.append(top and record(top))
                texts.append(b" ".join(collapsed(words, runs) if runs else words).decode("utf-8", "surrogatepass"))
            columns = [batch["doc_id"], pa.array(many, pa.int64()), pa.array(all_runs, pa.list_(run)), pa.array(best, run), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "strongest", "collapsed"])

    schema = f"doc_id long, n_words long, runs array<struct<{RUN.replace(' long', ': long')}>>, strongest struct<{RUN.replace(' long', ': long')}>, collapsed string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, schema)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document by checksum of its id with a periodic end, so that runs can be expected."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, h = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if h:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_grammar_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, one in ten of which has a planted periodic end; a null id has none."""
    found = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[c].alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
