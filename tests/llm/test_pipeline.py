"""The pipeline's stages, each on its own input, and the whole."""

import itertools
import random

import corpus_pipeline as pipeline
import pytest
from stayledger.llm import queries, simhash
from tests.llm.rows import EDGES, documents

BODY = " ".join(f"clean{i} sentence{i * 7} number{i * 13}" for i in range(40))


def test_each_query_has_a_number():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert numbers == list(range(1, 14)) and set(queries.SQL) <= set(queries.QUERIES)


def test_stages_take_effect_and_keep_columns(spark):
    other = " ".join(f"other{i} words{i * 3}" for i in range(50))
    passage = " ".join(f"shared{i} passage{i}" for i in range(60))
    rows = EDGES + [(10, BODY), (11, BODY), (12, BODY + " extra"), (13, other + " " + passage), (14, passage + " " + BODY[::-1]), (15, "write to me@site.org " + other[::-1]), (16, "spam " * 60)]
    docs = documents(spark, rows, extra=True)
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), before.schema)
        assert docs.columns == before.columns, name
    left = {r["doc_id"]: r for r in docs.collect()}
    assert 16 not in left and 11 not in left and 12 not in left and left[10]["text"] == BODY
    assert passage in left[13]["text"] and passage not in left[14]["text"]
    assert "me@site.org" not in left[15]["text"] and "[EMAIL]" in left[15]["text"] and left[15]["spans"] == "x4"
    assert all(r["n_chars"] == len(r["text"]) for r in left.values() if r["text"] is not None)


def test_near_duplicates_are_what_simhash_links(spark):
    pick = random.Random(5)
    rows = []
    for g in range(25):
        base = [f"w{pick.randrange(3000)}" for _ in range(120)]
        for k in range(4):
            words = list(base)
            for at in pick.sample(range(120), k):
                words[at] = f"new{g}x{k}x{at}"
            rows.append((10 * g + k, " ".join(words)))
    hot = [f"h{i}" for i in range(200)]
    rows += [(1000 + i, " ".join([*hot, f"own{i}"])) for i in range(150)]
    prints = {d: int.from_bytes(simhash.fingerprint(t)) for d, t in rows}
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    least = {d: d for d in prints}
    for _ in range(len(rows)):
        was = dict(least)
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
        if was == least:
            break
    docs = documents(spark, rows)
    assert len(pairs) > 1000 and len(set(least.values())) < 100
    assert {r["doc_id"] for r in pipeline.near_duplicates(spark, docs, "").collect()} == set(least.values())


def test_near_duplicates_judge_rows_by_their_texts(spark):
    other = " ".join(f"other{i} words{i * 3}" for i in range(50))
    third = " ".join(f"third{i} kind{i * 3}" for i in range(50))
    rows = [(1, BODY), (2, BODY + " extra"), (2, other), (3, third), (3, third), (None, other), (None, "no id"), (None, "no id"), (4, "some short text here now"), (4, "quite another text of four")]
    left = pipeline.near_duplicates(spark, documents(spark, rows, extra=True).repartition(3), "").collect()
    wanted = [(1, BODY), (2, other), (3, third), (None, "no id"), (4, "some short text here now"), (4, "quite another text of four")]
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=str) == sorted(wanted, key=str)


def test_run_on_sample_tables(spark):
    rows = pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "bin_id", "capacity"} <= set(rows.columns) and rows.count() > 100


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_stages_of_an_empty_table(spark, stage):
    assert stage(spark, documents(spark, []), "").count() == 0
