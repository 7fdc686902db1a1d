"""Components, SimHash tries and embeddings against brute force."""

import numpy as np
import pytest
import xxhash

from stayledger.llm import embeddings, simhash
from stayledger.llm.common import components
from tests.llm.rows import EDGES, documents


def reachable(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150), (150, 200), (-5, -9)]
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    frame = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    assert {r["id"]: r["root"] for r in components(frame).collect()} == reachable(edges, nodes)
    assert components(frame.limit(0)).count() == 0


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


@pytest.mark.parametrize("text", ["", None, "One two", "A b C d e f g a b c d", "É Ü ß x y\tz\n\nw v", "same " * 50, "no\x1cbreak here a b c"])
def test_fingerprint(text):
    assert int.from_bytes(simhash.fingerprint(text), "big") == plain_fingerprint(text)


@pytest.mark.parametrize(("per_node", "per_block"), [(150, 100_000), (100_000, 100_000), (150, 60), (100_000, 200)])
def test_trie_join_finds_all_links(spark, per_node, per_block):
    pick = np.random.default_rng(5)
    prints = {int(x) for x in pick.integers(0, 2**64, 60, dtype=np.uint64)} | {0, 2**64 - 1}
    for x in list(prints):
        for _ in range(int(pick.integers(0, 6))):
            y = x
            for b in pick.integers(0, 64, int(pick.integers(1, 7))):
                y ^= 1 << int(b)
            prints.add(y)
    prints |= {sum(1 << int(b) for b in pick.integers(0, 64, 2)) for _ in range(300)}
    linked = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    wanted = reachable(linked, prints)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    edges = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.similar_fingerprints(frame, per_node=per_node, per_block=per_block).collect()]
    assert all((a ^ b).bit_count() <= 4 or wanted[a] == wanted[b] for a, b in edges)
    got = reachable(edges, prints)
    assert len({(wanted[p], got[p]) for p in prints}) == len(set(wanted.values())) == len(set(got.values()))


def test_simhash_rows(spark):
    copies = [(10 + i, "the quick brown fox jumps over the lazy dog and runs on") for i in range(5)]
    rows = EDGES + copies
    got = simhash.simhash_groups(documents(spark, rows, extra=True)).collect()
    assert sorted((r["doc_id"] or -1) for r in got) == sorted((r[0] or -1) for r in rows)
    texts = dict(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert int(r["fingerprint"], 16) == plain_fingerprint(texts[r["doc_id"]])
    assert {r["component_id"] for r in got if r["doc_id"] and r["doc_id"] >= 10} == {10}
    assert {r["component_id"] for r in got if r["doc_id"] in (2, 3, 4)} == {2}
    assert simhash.simhash_groups(documents(spark, [])).count() == 0


def test_embeddings_against_brute_force(spark):
    pick = np.random.default_rng(3)
    centres = pick.normal(size=(40, 16))
    points = [*pick.normal(size=(500, 16)), *(c + 0.05 * pick.normal(size=16) for c in centres for _ in range(12))]
    points += [points[3], points[3], 2.0 * points[4]]
    rows = [(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)]
    odd = [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] + [1.0] * 15), (9004, [1.0, 2.0]), (9005, [None] + [1.0] * 15), (9006, [float("inf")] * 16)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame, per_list=40, few=1).collect()}
    unit = np.array([r[1] for r in rows])
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    wanted = reachable([tuple(map(int, p)) for p in np.argwhere(close)], range(len(rows)))
    found = sum(got[i]["n_links"] for i in range(len(rows)))
    assert 0.99 * close.sum() <= found <= close.sum()
    assert sum(got[i]["component_id"] == wanted[i] for i in range(len(rows))) >= 0.99 * len(rows)
    for i, _ in odd:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    exact = {r["vec_id"]: r for r in embeddings.near_duplicates(frame, per_list=40, width=4.0 * 16, few=1).collect()}
    assert [exact[i]["n_links"] for i in range(len(rows))] == close.sum(axis=1).tolist()
    assert [exact[i]["component_id"] for i in range(len(rows))] == [wanted[i] for i in range(len(rows))]
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("few", [1, 150, 10_000])
def test_embeddings_of_many_lengths(spark, few):
    pick = np.random.default_rng(5)
    rows = []
    for length, n in ((16, 200), (8, 30), (5, 7), (3, 2), (1, 1)):
        base = pick.normal(size=(max(1, n // 5), length))
        rows += [[float(x) for x in base[i % len(base)] + 0.03 * pick.normal(size=length)] for i in range(n)]
    rows += [rows[0], rows[205], rows[205]]
    ids = [None if i % 17 == 3 else 7 if i in (20, 21) else i for i in range(len(rows))]
    frame = spark.createDataFrame([(i, v, "x", 5) for i, v in zip(ids, rows, strict=True)], "vec_id long, embedding array<double>, key string, n int").repartition(3)
    got = embeddings.near_duplicates(frame, few=few, per_list=20, width=64.0).collect()
    same = [[len(a) == len(b) and np.dot(a, b) >= 0.95 * np.sqrt(np.dot(a, a) * np.dot(b, b)) for b in rows] for a in rows]
    root = reachable([(a, b) for a in range(len(rows)) for b in range(a) if same[a][b]], range(len(rows)))
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root[i]] = min(d, least.get(root[i], d))
    wanted = [(d, sum(same[i]) - 1, least.get(root[i]), least.get(root[i]) in (d, None) if d is not None else least.get(root[i]) is None) for i, d in enumerate(ids)]
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    assert sum(n for _, n, *_ in wanted) > 300


def test_codes_bound_the_cosine():
    pick = np.random.default_rng(1)
    unit = pick.normal(size=(800, 24))
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    index = embeddings.Index(embeddings.Index.fit(unit, 12))
    lists = embeddings.nearest(unit, index.centres)
    codes, missing = index.encode(unit, lists)
    coded = np.concatenate([book[codes[:, i]] for i, book in enumerate(index.books)], axis=1) + index.centres[lists]
    assert (np.abs(unit @ unit.T - unit @ coded.T) <= missing + 1e-9).all()


def test_one_of_two_near_vectors_visits_the_other_with_few_visits():
    pick = np.random.default_rng(2)
    unit = pick.normal(size=(4000, 64))
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    aside = pick.normal(size=unit.shape)
    aside -= (aside * unit).sum(axis=1, keepdims=True) * unit
    near = 0.95 * unit + np.sqrt(1 - 0.95**2) * aside / np.sqrt((aside**2).sum(axis=1, keepdims=True))
    index = embeddings.Index(embeddings.Index.fit(unit, 80))
    homes = [embeddings.nearest(points, index.centres) for points in (unit, near)]
    apart = homes[0] != homes[1]
    assert apart.sum() > 500

    def found(width):
        visits = [index.probes(points, 0.95, width) for points in (unit, near)]
        every = np.arange(len(unit))
        return visits[0][every, homes[1]] | visits[1][every, homes[0]], visits[0].sum(axis=1).mean()

    assert found(8.0)[0].all()
    either, visits = found(embeddings.PROBE_WIDTH)
    assert either.mean() > 0.999 and visits < 8
