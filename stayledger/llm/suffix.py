"""Removal of byte strings that occur earlier, by suffix arrays over shards of windows that meet by content."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import packed_rows, table, unpacked_rows

LENGTH = 100
GRAM = 24
CHUNK = 1 << 20
SHARD = 1 << 24
HOT = 2048
# Pieces of a group that one task merges; larger groups are cut into windows.
MOST_PIECES = 20_000
# Pieces of one suffix array, which takes about a kB of a worker's memory for each.
ARRAY = 2_500
LARGEST = (1 << 63) - 1

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
_MIX_AGAIN = np.array([0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03], dtype=np.uint64)
_PLACES = np.uint64(2 * CHUNK - 1)

RUNS = "value long, d long, tag long, start int, n int, done boolean"
PIECES = "value long, sub long, d long, tag long, start int, n int, piece binary"
PIECE_NAMES = ("value", "sub", "d", "tag", "start", "n", "piece")


def chosen_grams(data: bytes, mix: np.ndarray = _MIX) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the gram that stands for the window of LENGTH bytes at every start.

    It is the gram of the least hash, the last of equals, so equal windows choose the same gram at the same
    place in them, and windows of one text that choose the same place overlap but are not equal.
    """
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    n = len(data) - GRAM + 1
    x = words[:n] * mix[0]
    x ^= words[8 : 8 + n] * mix[1]
    x ^= x >> np.uint64(31)
    x += words[16 : 16 + n] * mix[2]
    x ^= x >> np.uint64(29)
    x *= mix[3]
    x ^= x >> np.uint64(32)
    least = (x & ~_PLACES) | (_PLACES - np.arange(n, dtype=np.uint64))
    width, have = LENGTH - GRAM + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    place = (_PLACES - (least & _PLACES)).astype(np.int64)
    return x[place].view(np.int64), place


def text_runs(texts: list[bytes], mix: np.ndarray = _MIX) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, value, start, n): ranges of window starts that chose one gram; at most CHUNK bytes are worked on at once."""
    out: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def work() -> None:
        data = b"".join(piece for _, _, piece in held)
        lengths = np.array([len(piece) for _, _, piece in held])
        offsets = np.cumsum(lengths) - lengths
        values, places = chosen_grams(data, mix)
        ends = offsets + lengths - LENGTH + 1
        cuts = np.unique(np.concatenate([np.flatnonzero(places[1:] != places[:-1]) + 1, offsets, ends]))
        starts, stops = cuts[:-1], cuts[1:]
        if cuts[-1] < len(places):
            starts, stops = cuts, np.append(cuts[1:], len(places))
        owner = np.searchsorted(offsets, starts, side="right") - 1
        inside = starts < ends[owner]
        starts, stops, owner = starts[inside], stops[inside], owner[inside]
        which, base = (np.array([h[i] for h in held]) for i in (0, 1))
        out.append((which[owner], values[starts], starts - offsets[owner] + base[owner], stops - starts))

    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, CHUNK):
            piece = text[at : at + CHUNK + LENGTH - 1]
            if held and size + len(piece) > CHUNK:
                work()
                held, size = [], 0
            held.append((i, at, piece))
            size += len(piece)
    if held:
        work()
    if not out:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of each shard of rows; of equal runs in a shard only the first stays, the others are done ranges."""
    for batch in batches:
        ids, tags = batch["d"].to_numpy(), batch["tag"].to_numpy()
        texts = batch["data"].to_pylist()
        sizes = np.cumsum([len(t) for t in texts]) // SHARD
        for shard in np.unique(sizes):
            rows = np.flatnonzero(sizes == shard)
            which, value, start, n = text_runs([texts[i] for i in rows])
            value = _short(value)
            which = rows[which] if len(which) else which
            _, back, times = np.unique(value, return_inverse=True, return_counts=True)
            again = np.flatnonzero(times[back] > 1)
            again = again[np.lexsort((start[again], tags[which[again]], ids[which[again]]))]
            first: dict[tuple[int, bytes], tuple] = {}
            live = np.ones(len(value), dtype=bool)
            done = np.zeros(len(value), dtype=bool)
            for r in again.tolist():
                w, s = int(which[r]), int(start[r])
                at = (ids[w], tags[w], s)
                if first.setdefault((int(value[r]), texts[w][s : s + n[r] + LENGTH - 1]), at) != at:
                    live[r], done[r] = False, True
            dw, ds, dn = _joined_ranges(which[done], start[done], n[done])
            scatter = _scatter(ids[dw], tags[dw])
            w = np.concatenate([which[live], dw])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([value[live], scatter])),
                    pa.array(ids[w]),
                    pa.array(tags[w]),
                    pa.array(np.concatenate([start[live], ds]).astype(np.int32)),
                    pa.array(np.concatenate([n[live], dn]).astype(np.int32)),
                    pa.array(np.arange(len(w)) >= int(live.sum())),
                ],
                ["value", "d", "tag", "start", "n", "done"],
            )


def _short(value: np.ndarray) -> np.ndarray:
    """48 bits of gram hashes: what moves is smaller, and different grams of one value only meet in vain."""
    return (value.view(np.uint64) >> np.uint64(16)).astype(np.int64)


def _scatter(d: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """What spreads ranges over tasks. Near the tag, it takes little room in compressed rows; d parts copies of a text."""
    return (d.astype(np.int64).view(np.uint64) + tag.astype(np.int64).view(np.uint64)).view(np.int64)


def _joined_ranges(which: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((start, which))
    which, start, n = which[order], start[order], n[order]
    fresh = np.ones(len(which), dtype=bool)
    fresh[1:] = (which[1:] != which[:-1]) | (start[1:] != start[:-1] + n[:-1])
    heads = np.flatnonzero(fresh)
    return which[heads], start[heads], np.add.reduceat(n, heads) if len(heads) else n


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of every candidate run; runs of a very frequent value are cut anew by a second hash to part them."""
    for batch in batches:
        runs = batch["runs"]
        bounds = runs.offsets.to_numpy()
        fields = {f: runs.values.field(f).to_numpy(zero_copy_only=False) for f in ("value", "start", "n", "done", "times")}
        out: list[tuple] = []
        for i, (d, tag, data) in enumerate(zip(*(batch[c].to_pylist() for c in ("d", "tag", "data")), strict=True)):
            cut = slice(bounds[i], bounds[i + 1])
            for value, s, n, done, times in zip(*(fields[f][cut].tolist() for f in fields), strict=True):
                if done:
                    out.append((value, -1, d, tag, s, n, b""))
                elif times <= HOT:
                    out.append((value, 0, d, tag, s, n, data[s : s + n + LENGTH - 1]))
                else:
                    _, again, at, many = text_runs([data[s : s + n + LENGTH - 1]], _MIX_AGAIN)
                    for sub, a, m in zip(_short(again).tolist(), (at + s).tolist(), many.tolist(), strict=True):
                        out.append((value, sub, d, tag, a, m, data[a : a + m + LENGTH - 1]))
            if len(out) >= 10_000:
                yield _piece_batch(out)
                out = []
        if out:
            yield _piece_batch(out)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], PIECE_NAMES)


def suffix_array(data: bytes, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, rank of each) by their first ``depth`` bytes, by Larsson-Sadakane refinement.

    Suffixes are sorted by eight bytes first. Each round sorts only groups that are not yet of one suffix,
    by the ranks of the suffixes that begin where the known prefixes end; the known length doubles.
    """
    n = len(data)
    keys = np.ndarray((n,), ">u8", data + bytes(8), 0, (1,)).astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    heads = np.ones(n, dtype=bool)
    heads[1:] = keys[order[1:]] != keys[order[:-1]]
    first = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = first
    known = 8
    while known < depth:
        step = min(known, depth - known)
        alone = heads & np.append(heads[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        group = order[slots]
        after = group + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        keys = rank[group] * (n + 1) + second + 1
        by = np.argsort(keys, kind="stable")
        order[slots] = group[by]
        keys = keys[by]
        heads[slots[1:]] = (keys[1:] != keys[:-1]) | heads[slots[1:]]
        first = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
        rank[order[slots]] = first[slots]
        known += step
    return order, rank


def common_prefixes(data: bytes, at: np.ndarray, order: np.ndarray, base: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Kasai's common prefixes, up to LENGTH, of the windows at places ``at`` with those before them in ``order``.

    A window's prefix is at least the last window's less one if the window after that one's predecessor is in the
    set and comes before it, which the order of equal prefixes need not grant. All pieces (``n`` windows from
    index ``base``) advance together, a window at a time.
    """
    before = np.full(len(at), -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    spot = np.empty(len(at), dtype=np.int64)
    spot[order] = np.arange(len(at))
    text = np.frombuffer(data, dtype=np.uint8)
    piece = np.repeat(np.arange(len(n)), n)
    common = np.zeros(len(at), dtype=np.int64)
    height = np.zeros(len(n), dtype=np.int64)
    for j in range(int(n.max(initial=0))):
        rows = np.flatnonzero(n > j)
        w = base[rows] + j
        other = before[w]
        h = np.zeros(len(rows), dtype=np.int64)
        if j:
            last = before[w - 1]
            follows = (last >= 0) & (last + 1 < len(at))
            after = np.minimum(last + 1, len(at) - 1)
            follows &= (piece[after] == piece[np.maximum(last, 0)]) & (spot[after] < spot[w])
            h = np.where(follows & (other >= 0), np.maximum(height[rows] - 1, 0), 0)
        open_ = np.flatnonzero(other >= 0)
        while len(open_):
            p, q = at[w[open_]] + h[open_], at[other[open_]] + h[open_]
            open_ = open_[text[p] == text[q]]
            h[open_] += 1
            open_ = open_[h[open_] < LENGTH]
        common[w] = height[rows] = h
    return common


def _windows(data: bytes, at: np.ndarray) -> np.ndarray:
    every = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, dtype=np.uint8), LENGTH)
    return every[at].view(f"S{LENGTH}").ravel()


def _window_hashes(windows: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(windows), -(-LENGTH // 8) * 8), dtype=np.uint8)
    padded[:, :LENGTH] = windows.view(np.uint8).reshape(-1, LENGTH)
    h = np.full(len(windows), _MIX_AGAIN[0])
    for column in padded.view("<u8").T:
        h = (h ^ column) * _MIX[0]
        h ^= h >> np.uint64(29)
    return ((h * _MIX_AGAIN[1]) >> np.uint64(1)).astype(np.int64)


def _places(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces of n windows each, joined: the piece of every window, its place in the joined bytes, and where each piece's windows begin."""
    many = n.astype(np.int64)
    sizes = many + LENGTH - 1
    base = np.cumsum(many) - many
    owner = np.repeat(np.arange(len(many)), many)
    return owner, np.arange(len(owner)) - base[owner] + (np.cumsum(sizes) - sizes)[owner], base


def _parted(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Pieces of one large group as one piece per distinct window, dealt out by its whole bytes; and the windows that occur earlier among these."""
    value, _, d, tag, start, n, pieces = (list(c) for c in zip(*rows, strict=True))
    owner, at, base = _places(np.array(n))
    windows = _windows(b"".join(pieces), at)
    distinct, first = np.unique(windows, return_index=True)
    hashes = _window_hashes(distinct)
    offset = np.arange(len(owner)) - base[owner]
    out = []
    for w, h in zip(first.tolist(), hashes.tolist(), strict=True):
        r, o = int(owner[w]), int(offset[w])
        out.append((value[r], h, d[r], tag[r], start[r] + o, 1, pieces[r][o : o + LENGTH]))
    again = np.ones(len(owner), dtype=bool)
    again[first] = False
    where, begins, many = _joined_ranges(owner[again], np.array(start)[owner[again]] + offset[again], np.ones(int(again.sum()), dtype=np.int64))
    return out, [(d[r], tag[r], s, m) for r, s, m in zip(where.tolist(), begins.tolist(), many.tolist(), strict=True)]


def _range_rows(d: np.ndarray, tag: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Ranges of repeated windows as pieces that are done."""
    scatter = _scatter(d, tag)
    empty = pa.array([b""] * len(d), pa.binary())
    columns = [pa.array(scatter), pa.array(np.full(len(d), -1, dtype=np.int64)), pa.array(d.astype(np.int64)), pa.array(tag.astype(np.int64))]
    columns += [pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), empty]
    return pa.RecordBatch.from_arrays(columns, PIECE_NAMES)


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _merge(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Ranges of windows that occur earlier, from pieces sorted by (value, sub, d, tag, start).

    Every ARRAY pieces are a shard with a suffix array of its own. Pieces of one group (value, sub) that run on into the next
    shard are merged with it by binary search: the sorted windows seen so far are carried along. A group of more than
    ``most`` pieces is not merged here but cut into its windows, for another pass that deals them out by their bytes.
    """
    carried_key, carried, last = None, None, None
    held: list[tuple] = []  # the carried group's pieces, as long as they are few
    parted = False  # whether the carried group is being cut
    for batch in _slices(batches, ARRAY):
        value, sub, d, tag, start, n = (batch[c].to_numpy() for c in PIECE_NAMES[:-1])
        pieces = batch["piece"].to_pylist()
        out = [np.flatnonzero(sub == -1)]
        rows = np.flatnonzero(sub != -1)
        ranges = [(d[out[0]], tag[out[0]], start[out[0]], n[out[0]])]
        if len(rows):
            same = np.zeros(len(rows), dtype=bool)
            same[1:] = (value[rows[1:]] == value[rows[:-1]]) & (sub[rows[1:]] == sub[rows[:-1]])
            group = np.cumsum(~same) - 1
            end = int(group[-1])
            goes_on = carried_key == (int(value[rows[0]]), int(sub[rows[0]]))
            sizes = np.bincount(group)
            large = np.zeros(end + 1, dtype=bool)
            if most is not None:
                large = sizes > most
                large[0] |= goes_on and (parted or len(held) + sizes[0] > most)
            fresh: list[int] = []
            copies: list[int] = []
            cut: dict[int, list[tuple]] = {}
            if goes_on and large[0] and not parted:
                cut[0] = held
            seen: dict[tuple[int, bytes], int] = {}
            for r, g in zip(rows.tolist(), group.tolist(), strict=True):
                at = (value[r], sub[r], d[r], tag[r], start[r])
                if at != last:
                    if large[g]:
                        cut.setdefault(g, []).append(_row(r, value, sub, d, tag, start, n, pieces))
                    else:
                        (copies if seen.setdefault((g, pieces[r]), r) != r else fresh).append(r)
                last = at
            for some in cut.values():
                windows, again = _parted(some)
                yield _piece_batch(windows)
                if again:
                    ranges.append(tuple(np.array(c) for c in zip(*again, strict=True)))
            fresh_rows = np.array(fresh, dtype=np.int64)
            copy_rows = np.array(copies, dtype=np.int64)
            ranges.append((d[copy_rows], tag[copy_rows], start[copy_rows], n[copy_rows]))
            group_of = np.zeros(len(value), dtype=np.int64)
            group_of[rows] = group
            of = group_of[fresh_rows]
            contested = (np.bincount(of, minlength=end + 1) > 1)[of] | (of == end) | (goes_on & (of == 0))
            use = fresh_rows[contested]
            data = b"".join([pieces[r] for r in use.tolist()])
            owner, at, base = _places(n[use])
            repeated = np.zeros(len(at), dtype=bool)
            if len(at):
                _, rank = suffix_array(data)
                order = np.argsort(rank[at], kind="stable")
                repeated = common_prefixes(data, at, order, base, n[use].astype(np.int64)) >= LENGTH
            of = group_of[use]
            if goes_on and len(at):
                own = np.flatnonzero((of == 0)[owner])
                found = _windows(data, at[own])
                spot = np.minimum(np.searchsorted(carried, found), len(carried) - 1)
                repeated[own] |= (carried[spot] == found) if len(carried) else False
            new = np.flatnonzero((of == end)[owner] & ~repeated)
            known = np.sort(_windows(data, at[new])) if len(new) else np.empty(0, dtype=f"S{LENGTH}")
            if goes_on and end == 0 and not large[0]:
                known = np.insert(carried, np.searchsorted(carried, known), known)
            carried_key, carried = (int(value[rows[-1]]), int(sub[rows[-1]])), known
            parted = bool(large[end])
            if most is not None:
                mine = [] if parted else [_row(r, value, sub, d, tag, start, n, pieces) for r in fresh if group_of[r] == end]
                held = [*held, *mine] if goes_on and end == 0 and not parted else mine
            hit = np.flatnonzero(repeated)
            w, s, m = _joined_ranges(owner[hit], start[use[owner[hit]]] + hit - base[owner[hit]], np.ones(len(hit), dtype=np.int64))
            ranges.append((d[use[w]], tag[use[w]], s, m))
        yield _range_rows(*(np.concatenate(c) for c in zip(*ranges, strict=True)))


def _row(r: int, value, sub, d, tag, start, n, pieces) -> tuple:
    return int(value[r]), int(sub[r]), int(d[r]), int(tag[r]), int(start[r]), int(n[r]), pieces[r]


def _keys() -> dict[str, Column]:
    """Numbers by which a row is told apart and ordered: its doc_id, then bits of its text's hash; rows without an id come last.

    Rows without an id are told apart by 62 bits, those that share one by 40, which take less room.
    """
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    alone, among = F.shiftrightunsigned(text, 2) + F.lit(1 << 62), F.shiftrightunsigned(text, 24)
    return {"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(LARGEST)), "tag": F.when(F.col("doc_id").isNull(), alone).otherwise(among)}


def _documents(docs: DataFrame) -> DataFrame:
    keys = (column.alias(name) for name, column in _keys().items())
    return docs.select(*keys, F.coalesce("text", F.lit("")).cast("binary").alias("data"))


def repeated_ranges(texts: DataFrame, bytes_: str = "data") -> DataFrame:
    """(d, tag, spans) per document with bytes that occur earlier; spans are merged later by ``merged_spans``.

    Every window of LENGTH bytes is represented by a gram of it, chosen by content, so equal windows have equal values.
    Runs of windows with one value are counted by value; values that occur once have no equal windows. The
    bytes of the others are dealt out by value, where suffix arrays find equal windows. Equal runs of one scan shard
    are reduced to the first before anything moves, and very frequent values are dealt out by a second gram too. A
    group that is still large, as around a phrase that many documents hold in different surroundings, is cut into its
    windows, which a second pass deals out by all their bytes; so no task merges a large group.
    """
    data = texts.select("d", "tag", F.expr(bytes_).alias("data"))
    runs = data.mapInArrow(_runs, RUNS)
    times = F.count("*").over(Window.partitionBy("value")).alias("times")
    candidates = (
        runs.select("*", times)
        .where("done or times > 1")
        .groupBy("d", "tag")
        .agg(F.collect_list(F.struct("value", "start", "n", "done", "times")).alias("runs"))
    )
    pieces = texts.join(candidates, ["d", "tag"]).select("d", "tag", F.expr(bytes_).alias("data"), "runs").mapInArrow(_pieces, PIECES)

    def sorted_(rows: DataFrame) -> DataFrame:
        return rows.repartition("value", "sub").sortWithinPartitions("value", "sub", "d", "tag", "start")

    most = MOST_PIECES
    merged = sorted_(pieces).mapInArrow(lambda batches: _merge(batches, most), PIECES)
    ranges = sorted_(merged).mapInArrow(_merge, PIECES)
    span = F.struct("start", (F.col("start") + F.col("n") + LENGTH - 1).alias("stop"))
    return ranges.groupBy("d", "tag").agg(F.collect_list(span).alias("spans"))


def merged_spans(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs that the spans cover; spans that touch are one run."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    heads = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return list(zip(start[heads].tolist(), reach[np.append(heads[1:] - 1, len(start) - 1)].tolist(), strict=True))


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join(parts) + data[at:]


def _whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the parts of characters that they cut at their ends."""
    out = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _spans_of(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int]]]:
    spans = batch["spans"]
    bounds = spans.offsets.to_numpy()
    start, stop = (spans.values.field(f).to_numpy() for f in ("start", "stop"))
    for i in range(len(batch)):
        yield merged_spans(start[bounds[i] : bounds[i + 1]], stop[bounds[i] : bounds[i + 1]])


def _joined(docs: DataFrame) -> DataFrame:
    none = F.array().cast("array<struct<start:int,stop:int>>")
    texts = _documents(docs)
    joined = texts.join(repeated_ranges(texts), ["d", "tag"], "left")
    return joined.select("d", "tag", "data", F.coalesce("spans", none).alias("spans"))


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 per document row.

    A byte is removed if a string of LENGTH bytes that covers it also starts earlier: in a document of a smaller
    doc_id, or earlier in the same one. Overlaps count. Null texts count as empty. Rows without doc_id come
    after all others; rows of one doc_id are ordered by a hash of the text, and rows equal in both are one
    document, with equal results. An empty table gives no rows; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, tag, data, spans in zip(*(batch[c].to_pylist() for c in ("d", "tag", "data")), _spans_of(batch), strict=True):
                kept = _kept(data, spans)
                rows.append((None if tag >> 62 else d, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
            kinds = (*[pa.int64()] * 4, pa.string())
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return _joined(docs).mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated strings removed from text, whole characters only, and n_chars counted anew.

    What counts as earlier is as in ``repeated_bytes``; rows equal in id and text are one document and both stay as they are
    beside earlier ones. Null and empty texts stay. Very long texts are read whole. Other columns are kept, whatever their
    names; no rows give no rows.
    """
    keyed = packed_rows(docs, **_keys())
    joined = keyed.join(repeated_ranges(keyed, "cast(coalesce(row.text, '') as binary)"), ["d", "tag"], "left")

    @F.pandas_udf("string")
    def cut(texts, found):
        out = []
        for text, spans in zip(texts, found, strict=True):
            if text and spans is not None and len(spans):
                data = text.encode("utf-8")
                runs = merged_spans(np.array([s["start"] for s in spans]), np.array([s["stop"] for s in spans]))
                text = _kept(data, _whole_characters(data, runs)).decode("utf-8")
            out.append(text)
        return type(texts)(out, dtype=object)

    own = F.col("row.text")
    return unpacked_rows(joined, docs.columns, F.when(F.col("spans").isNull(), own).otherwise(cut(own, "spans")))


def op8_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))
