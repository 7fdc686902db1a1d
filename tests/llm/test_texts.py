"""Quality rules, personal data, repeated strings and packing against brute force."""

import base64
import hashlib
import random
import re
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from stayledger.llm import packing, pii, quality, suffix
from tests.compare import differences
from tests.llm.rows import EDGES, LONG, documents


def prose(pick, n):
    return " ".join(pick.choice(["alpha", "béta", "gamma", "delta", "eps", "zeta", "eta", "iota"]) for _ in range(n))


# -- quality ------------------------------------------------------------------


def test_quality_matches_sql(spark, tmp_path):
    pick = random.Random(4)
    footer = "All rights reserved 2019 by the owners of this page"
    rows = [r for r in EDGES if r[1] is not LONG]
    for i in range(60):
        own = "\n".join(prose(pick, 12) + str(pick.random()) for _ in range(4))
        rows.append((100 + i, f"{own}\n{footer.replace('2019', str(1990 + i))} ", "a" if i % 3 else "b"))
    rows += [(200 + i, f"{footer}\ntiny {i} a b c d e f g h i j k l m n o p q r s t", "a") for i in range(3)]
    copied = "\n".join(prose(pick, 12) for _ in range(9))
    rows += [(300 + i, copied, "a") for i in range(50)]
    rows += [(400, "one two three four five six seven eight nine " * 9), (401, "|a| # $ <b>\n\n|a| # $ <b>\n x\n x")]
    frame = documents(spark, rows, extra=True)
    frame.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    got = quality.quality(frame).drop("row_key")
    assert differences(got, connection, quality.OP7_SQL) == []
    kept = {r["doc_id"]: r for r in got.collect()}
    assert kept[101]["removed_chars"] > 0 and kept[101]["kept"] and kept[300]["kept"] and not kept[400]["kept"]
    assert quality.quality(documents(spark, [])).count() == 0


def test_depleted_documents_are_rejected(spark):
    pick = random.Random(9)
    boiler = "\n".join(f"boilerplate line {c} that stands on every page of this host" for c in "abcdef")
    rows = [(i, f"{boiler}\n" + "\n".join(prose(pick, 9) + str(pick.random()) for _ in range(20 if i % 2 else 1))) for i in range(60)]
    long = (1000, LONG)
    got = {r["doc_id"]: r for r in quality.quality(documents(spark, [*rows, long])).collect()}
    assert all(got[i]["kept"] == bool(i % 2) for i in range(60))
    assert got[1000]["kept"] and got[1000]["n_words"] == len(LONG.split()) and got[1000]["n_repeat_words"] == 0


@pytest.mark.parametrize("shared", [1, 3])
def test_pages_of_mostly_boilerplate_are_rejected_on_every_host(spark, shared):
    pick = random.Random(11)
    rows = []
    for h in range(8):
        boiler = "\n".join(f"{c} {'abcdefgh'[h]} " + " ".join(f"boilerplate{c * (k + 1)}" for k in range(20)) for c in "xyz"[:shared])
        rows += [(100 * h + i, f"{boiler}\n{prose(pick, 3)} {'abcdefghij'[i // 10]} {'abcdefghij'[i % 10]}", f"host{h}") for i in range(60)]
    copied = "\n".join(prose(pick, 12) for _ in range(9))
    rows += [(5000 + i, copied, "host0") for i in range(50)]
    docs = documents(spark, rows)
    got = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect()}
    assert not any(kept for d, kept in got.items() if d < 5000) and all(kept for d, kept in got.items() if d >= 5000)
    left = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert left == set(range(5000, 5050))


# -- personal data ------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def right(kind, s):
        digits = re.sub(r"\D", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(kind, *m.span()) for kind, p in PATTERNS.items() for m in re.finditer(p, text) if right(kind, m[0])]


def test_base_spans_are_the_patterns():
    pick = random.Random(0)
    for alphabet in ("ab1_+@..--0 (é", "0123456789 -", "+1 2(3).-4", "1.2.99.300.0"):
        for _ in range(20_000):
            text = "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 40)))
            assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("4111 1111-1111 1111x") == [("card", 0, 19)]


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 150_000, "1." * 150_000, "+1" + "(" * 300_000, "1:" * 150_000, "a@b.c 5551234567, " * 30_000):
        pii.scan(text)
    assert [(s["start"], s["base"]) for s in pii.scan("x@y.zz 5551234567 x@y.zz")] == [(0, True), (18, True), (7, False)]
    assert pii.base_spans("0" * 5000 + "1.2.3.4") == [("ip", 0, 5007)]


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"note {i}: please call me at {f'+1 (555) 555-{i:04d}' if i % 4 else f'555-555-{i:04d}'} today, order 20240{i:03d} came") for i in range(40)]
    got = {r["doc_id"]: r for r in pii.personal_data(documents(spark, rows + EDGES, extra=True)).collect() if r["doc_id"] is not None}
    for i, text in rows:
        if i > 6:
            start = text.index("at ") + 3
            assert [(s["rank"], s["start"], s["end"]) for s in got[i]["spans"]] == [(4, start, text.index(" today"))]
            assert len(got[i]["base"]) == bool(i % 4)
    masked = {r["doc_id"]: r for r in pii.masked(documents(spark, rows, extra=True)).collect()}
    assert masked[8]["text"] == "note 8: please call me at [PHONE] today, order 20240008 came"
    assert masked[8]["n_chars"] == len(masked[8]["text"]) and masked[8]["spans"] == "x4"
    assert pii.personal_data(documents(spark, [])).count() == 0 and pii.masked(documents(spark, [])).count() == 0


def test_what_is_found_finds_more(spark):
    # Twenty numbers found in one context stand in a second one too, with twenty that stand there only; a third context has ten of these.
    rows = [(i, f"please ring her at {f'+1 (555) 555-{i:04d}' if i % 3 else f'555-77{i:03d}'} before noon {i}") for i in range(60)]
    first = [f"555-77{i:03d}" for i in range(0, 60, 3)]
    second = [f"555-88{i:03d}" for i in range(20)]
    third = [f"555-99{i:03d}" for i in range(8)]
    rows += [(100 + i, f"{i} desk extension number {n} is staffed") for i, n in enumerate(first + second[:10])]
    rows += [(200 + i, f"{i} desk extension number {n} is staffed") for i, n in enumerate(second[10:])]
    rows += [(300 + i, f"{i} fax goes out over {n} as ever") for i, n in enumerate(second + third)]
    rows += [(400, f"one alone: {third[3]}!"), (401, "and 555-12345 nobody knows")]
    got = {r["doc_id"]: len(r["spans"]) - len(r["base"]) for r in pii.personal_data(documents(spark, rows)).collect()}
    assert all(got[d] == (d % 3 == 0) for d, _ in rows if d < 60) and all(got[d] for d, _ in rows if 100 <= d < 401) and not got[401]


def plain_discoveries(texts):
    """The graph of patterns and values in plain Python, to its fixed point."""
    spans = [(d, s) for d, text in texts for s in pii.scan(text or "")]
    edges = {(p, kind, s["value"]): False for _, s in spans for kind in s["kinds"] for p in s["patterns"]}
    for _, s in spans:
        for p in s["patterns"] if s["base"] else ():
            edges[p, s["kind"], s["value"]] = True
    values = {}
    for p, _, v in edges:
        values.setdefault(p, set()).add(v)
    edges = {e: base for e, base in edges.items() if len(values[e[0]]) >= pii.MIN_SEEDS}
    seeds = {(v, kind): 1.0 for (_, kind, v), base in edges.items() if base}
    known, many = dict(seeds), 0
    while len(known) > many:
        many = len(known)
        hits = Counter((p, kind) for p, kind, v in edges if (v, kind) in known)
        kept = {k: round(h / len(values[k[0]]), 6) for k, h in hits.items() if h >= pii.MIN_SEEDS}
        kept = {k: c for k, c in kept.items() if c >= pii.MIN_CONFIDENCE}
        missed = {}
        for p, kind, v in edges:
            if (p, kind) in kept:
                missed[v, kind] = missed.get((v, kind), 1.0) * (1.000001 - kept[p, kind])
        known = {k: round(1 - m, 6) for k, m in missed.items() if 1 - m >= pii.MIN_SCORE} | seeds
    out = set()
    for d, s in spans:
        kinds = [(known[s["value"], k], k) for k in s["kinds"] if (s["value"], k) in known]
        if kinds and not s["base"]:
            out.add((d, pii.KINDS.index(max(kinds)[1]) + 1, s["start"], s["end"]))
    return out


def test_discoveries_against_a_plain_graph(spark):
    pick = random.Random(14)
    frames = ["call {} now", "my {} is", "ring {} or {} today", "id {} end", "from {} to {}", "{}"]
    rows = []
    for i in range(250):
        numbers = [pick.choice([*[f"+1 (555) 555-{pick.randrange(900):04d}"] * 8, f"555-7{pick.randrange(40):04d}", f"{pick.randrange(10**14)}", f"user{pick.randrange(9)}@host", "a@b.cd"]) for _ in range(2)]
        rows.append((i, " ".join(pick.choice(frames[: 3 + i % 4]).format(*numbers) for _ in range(pick.randint(1, 3)))))
    rows += rows[:20]
    got = {(r["doc_id"], s["rank"], s["start"], s["end"]) for r in pii.personal_data(documents(spark, rows)).collect() for s in r["spans"] if s not in r["base"]}
    assert got == plain_discoveries(rows) and len(got) > 50


def test_contexts_of_long_words():
    long = "x" * 5000
    near = pii._Contexts(f"one {long} two {long}")
    at = 4 + 5000 + 1
    assert near.patterns(at, at + 3) == [f"one {'x' * 64} _", f"{'x' * 64} _ {'x' * 64}"]
    assert pii._Contexts("a,b").patterns(2, 3) == ["^ a _", "a _ $"]


def test_rare_or_mixed_contexts_find_nothing(spark):
    rows = [(i, f"value is {f'+1 (555) 555-{i:04d}' if i % 9 == 0 else f'55512{i:04d}'} here") for i in range(60)]
    assert all(len(r["spans"]) == len(r["base"]) for r in pii.personal_data(documents(spark, rows)).collect())


# -- repeated strings ---------------------------------------------------------


def removed(rows):
    seen, out = set(), {}
    for d, text in sorted(set(rows)):
        data = text.encode()
        cover = bytearray(len(data))
        for i in range(len(data) - 99):
            window = data[i : i + 100]
            if window in seen:
                cover[i : i + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, c in zip(data, cover, strict=True) if not c)
        runs = len(re.findall(rb"\x01+", bytes(cover)))
        out[d] = (len(data), sum(cover), runs, hashlib.sha256(kept).hexdigest())
    return out


def repeated_rows():
    pick = random.Random(3)
    shared = prose(pick, 60)
    rows = []
    for i in range(150):
        kinds = (prose(pick, 40), prose(pick, 10) + shared + prose(pick, 10), "a" * pick.randint(0, 400), (prose(pick, 3) + " ") * 30, shared[: pick.randint(90, 300)])
        rows.append((i, kinds[i % 5]))
    return rows + [(500, rows[1][1]), (501, "ab" * 3000), (502, "x" * 3000 + shared), (503, ""), (504, rows[7][1]), (504, rows[7][1])]


@pytest.mark.parametrize("hot, most", [(suffix.HOT, suffix.MOST_PIECES), (4, suffix.MOST_PIECES), (4, 3), (suffix.HOT, 1), (suffix.HOT, 40)])
def test_repeated_bytes_against_brute_force(spark, monkeypatch, hot, most):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "MOST_PIECES", most)
    rows = repeated_rows()
    got = suffix.repeated_bytes(documents(spark, rows, extra=True).repartition(3)).collect()
    assert len(got) == len(rows)
    wanted = removed(rows)
    for r in got:
        assert tuple(r)[1:] == wanted[r["doc_id"]], r["doc_id"]


def test_one_phrase_in_many_surroundings(spark, monkeypatch):
    # A phrase shorter than a window, different words around it: one value, no equal runs, few equal windows.
    monkeypatch.setattr(suffix, "HOT", 16)
    monkeypatch.setattr(suffix, "MOST_PIECES", 100)
    pick = random.Random(12)
    phrase = " all rights reserved by the owners of these pages, who made them in their own time "
    rows = [(i, f"{pick.random()} {prose(pick, 8)}{phrase}{prose(pick, 8)} {pick.random()}") for i in range(4000)]
    rows += [(5000 + i, rows[i][1][20:-10]) for i in range(0, 4000, 100)]
    docs = documents(spark, rows).repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.repeated_bytes(docs).collect()}
    assert got == removed(rows)
    # What a task merges of one group stays small: the pieces that the first pass leaves to the second are single windows.
    pieces = [(1, 0, i, 0, 0, len(t.encode()) - 99, t.encode()) for i, t in rows[:500]]
    batches = list(suffix._merge(iter([suffix._piece_batch(pieces[:60]), suffix._piece_batch(pieces[60:300]), suffix._piece_batch(pieces[300:])]), 100))
    got = [row for batch in batches for row in batch.to_pylist()]
    left = [row for row in got if row["sub"] != -1]
    assert left and {(row["n"], len(row["piece"])) for row in left} == {(1, 100)}
    # Every window is either handed on or found to occur earlier.
    seen = {(row["d"], row["start"] + k) for row in got for k in range(row["n"])}
    assert seen == {(d, s) for d in range(500) for s in range(len(pieces[d][-1]) - 99)}


def test_rows_of_one_hash_are_told_apart(spark):
    # Two texts of one 32-bit hash: their rows used to be taken for one.
    pick = random.Random(13)
    texts = [" ".join(pick.choice(["red", "green", "blue", "grey"]) + str(pick.randrange(10**6)) for _ in range(20)) for _ in range(40)]
    rows = [(None, t) for t in texts] + [(None, texts[0] + texts[1]), ((1 << 63) - 1, texts[2]), (1, texts[0])]
    got = suffix.repeated_bytes(documents(spark, rows)).collect()
    by = Counter((r["doc_id"], r["n_bytes"] == r["n_removed"]) for r in got)
    assert by[(1 << 63) - 1, False] == 1 and by[1, False] == 1 and by[None, True] >= 2
    assert all(k.dataType.typeName() == "long" for k in suffix._documents(documents(spark, rows)).schema[:2])


def test_repeated_bytes_of_odd_rows(spark):
    body = "the same words again and again, " * 9
    rows = EDGES + [(None, body), (None, body), (7, body), (8, body + "Z"), (8, "Y" + body)]
    got = suffix.repeated_bytes(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r["n_removed"] for r in got if r["doc_id"] in (1, 2, 3, 4)} == {0}
    assert suffix.repeated_bytes(documents(spark, [])).count() == 0
    left = suffix.without_repeats(documents(spark, [(1, "é" * 90), (2, "é" * 90 + "x"), (3, None)], extra=True)).orderBy("doc_id").collect()
    assert left[0]["n_chars"] < 90 and left[1]["text"].endswith("x") and left[2]["text"] is None and left[1]["d"] == "x0"


def test_merging_holds_few_pieces_at_once():
    pick = np.random.default_rng(4)
    rows = []
    for group in range(4000):
        whole = pick.bytes(179)
        rows += [(group, 0, 2 * group, 0, 0, 40, whole[:139]), (group, 0, 2 * group + 1, 0, 0, 40, whole[20:159])]
    batch = suffix._piece_batch(rows)
    tracemalloc.start()
    found = [tuple(r[c] for c in ("d", "start", "n")) for out in suffix._merge(iter([batch])) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(found) == [(2 * group + 1, 0, 20) for group in range(4000)]
    assert peak < 60e6


def test_suffix_array_and_common_prefixes():
    pick = random.Random(8)
    for _ in range(60):
        data = bytes(pick.choice(b"ab") for _ in range(pick.randint(100, 400))) * pick.randint(1, 2)
        order, rank = suffix.suffix_array(data)
        assert sorted(order.tolist()) == list(range(len(data)))
        keys = [data[i : i + 100] for i in order.tolist()]
        assert keys == sorted(keys)
        assert all((rank[a] == rank[b]) == (data[a : a + 100] == data[b : b + 100]) for a, b in zip(order, order[1:], strict=False))
        at = np.arange(len(data) - 99)
        sorted_at = np.argsort(rank[at], kind="stable")
        common = suffix.common_prefixes(data, at, sorted_at, np.array([0]), np.array([len(at)]))
        for a, b in zip(sorted_at.tolist(), sorted_at.tolist()[1:], strict=False):
            same = next((k for k in range(100) if data[a + k] != data[b + k]), 100)
            assert common[b] == same


# -- packing ------------------------------------------------------------------


def test_pack_is_whole_and_within_capacity():
    pick = np.random.default_rng(2)
    for capacities in ((64, 128, 256), (100,), (7, 1000)):
        lengths = np.sort(pick.integers(1, max(capacities) + 1, 700))[::-1]
        bins, offsets, size, capacity = packing.pack(lengths, capacities)
        for b in range(len(size)):
            rows = np.flatnonzero(bins == b)
            order = rows[np.argsort(offsets[rows])]
            assert offsets[order].tolist() == [0, *np.cumsum(lengths[order])[:-1].tolist()]
            assert size[b] == lengths[rows].sum() <= capacity[b]
            assert capacity[b] == min(c for c in capacities if c >= size[b])
        assert lengths.sum() / capacity.sum() > 0.9


def test_pack_is_best_fit():
    lengths = np.array([90, 60, 38, 9, 2])
    bins, _, size, capacity = packing.pack(lengths, (100,))
    assert bins.tolist() == [0, 1, 1, 0, 1] and size.tolist() == [99, 100] and capacity.tolist() == [100, 100]


def plain_pack(lengths, capacities):
    """Best fit by looking at every open bin: the least room that fits, of equals the one that came to it last."""
    bins, left = [], sum(lengths)
    for step, length in enumerate(lengths):
        fits = [b for b in bins if b["room"] >= length]
        if fits:
            b = min(fits, key=lambda b: (b["room"], -b["since"]))
        else:
            free = sum(b["room"] for b in bins)
            more = max(0, left - length - free)
            capacity = min((c for c in capacities if c >= length), key=lambda c: (packing.cost(c) / min(c, length + more), c))
            b = {"room": capacity, "pieces": []}
            bins.append(b)
        b["pieces"].append(step)
        b["room"] -= length
        b["since"] = step
        left -= length
    return [b["pieces"] for b in bins]


def test_pack_against_a_plain_search():
    pick = random.Random(5)
    for _ in range(300):
        capacities = sorted(pick.sample([4, 7, 8, 16, 30, 32, 64], pick.randint(1, 4)))
        lengths = sorted((pick.randint(1, capacities[-1]) for _ in range(pick.randint(1, 60))), reverse=True)
        bins, _, size, capacity = packing.pack(np.array(lengths), capacities)
        wanted = plain_pack(lengths, capacities)
        assert [np.flatnonzero(bins == b).tolist() for b in range(len(size))] == wanted
        held = [sum(lengths[i] for i in pieces) for pieces in wanted]
        assert size.tolist() == held and capacity.tolist() == [min(c for c in capacities if c >= h) for h in held]


def test_pack_is_near_the_optimum_of_small_cases():
    def parts(items):
        if not items:
            yield []
            return
        for rest in parts(items[1:]):
            yield [[items[0]], *rest]
            for i in range(len(rest)):
                yield [*rest[:i], [items[0], *rest[i]], *rest[i + 1 :]]

    pick = random.Random(6)
    worst = 1.0
    for _ in range(25):
        capacities = (8, 16, 32)
        lengths = sorted((pick.randint(1, 32) for _ in range(7)), reverse=True)

        def total(bins):
            return sum(packing.cost(min(c for c in capacities if c >= sum(b))) for b in bins)

        best = min(total(bins) for bins in parts(lengths) if all(sum(b) <= 32 for b in bins))
        _, _, size, _ = packing.pack(np.array(lengths), capacities)
        worst = max(worst, total([[s] for s in size.tolist()]) / best)
    assert worst <= 1.35


def test_lengths_are_the_tokenizer_s(spark):
    rows = EDGES + [(60, "<|endoftext|> x"), (61, "a" * 50_000), (62, " \n" * 500)]
    got = packing.packed(documents(spark, rows, extra=True), packing.text_tokens(spark)).collect()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(packing.FILE), "rb"))}
    encoding = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted, sums = Counter(), Counter()
    for d, text in rows:
        wanted[d] += len(encoding.encode_ordinary(text or "")) + 1
    for r in got:
        sums[r["doc_id"]] += r["n_tokens"]
    assert sums == wanted and wanted[60] > 3


def test_packing_does_not_depend_on_partitions(spark):
    docs = documents(spark, [(i, "w " * (i * 37 % 900)) for i in range(400)])
    counted = F.length("text") + 1
    results = []
    for many, batch in ((1, "10000"), (7, "33")):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        results.append(Counter(map(tuple, packing.packed(docs.repartition(many), counted, buffer=64).collect())))
        spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert results[0] == results[1] and len({r[4] for r in results[0]}) == 7


def test_packed_rows(spark):
    rows = EDGES + [(50 + i, "w " * (i * 37 % 900)) for i in range(200)] + [(7, "again")] * 30
    docs = documents(spark, rows, extra=True)
    got = packing.packed(docs, F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")) + 1, (128, 256, 512), shards=3, buffer=64).collect()
    tokens = {}
    for r in got:
        tokens.setdefault(r["doc_id"], []).append((r["piece_start"], r["n_tokens"]))
    wanted = {}
    for r in rows:
        wanted[r[0]] = wanted.get(r[0], 0) + len((r[1] or "").split()) + 1
    assert {d: sum(n for _, n in p) for d, p in tokens.items()} == wanted
    assert sorted(tokens[5])[1:3] == [(512, 512), (1024, 512)] and len(LONG.split()) + 1 == wanted[5]
    bins = {}
    for r in got:
        bins.setdefault((r["shard"], r["bin_id"]), []).append(r)
    for rows_ in bins.values():
        spans = sorted((r["bin_offset"], r["n_tokens"]) for r in rows_)
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and spans[0][0] == 0
        assert {r["bin_size"] for r in rows_} == {sum(n for _, n in spans)} and rows_[0]["bin_size"] <= rows_[0]["capacity"]
    assert packing.packed(documents(spark, []), F.lit(1)).count() == 0
