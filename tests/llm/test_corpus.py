"""Operators on whole tables: mixing, decontamination, search, and the pipeline."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import multi_index
from ledgerloom.llm.decontaminate import leaks
from ledgerloom.llm.mixing import BINS, key_bin, mix, mix_sql, source_targets, uniform
from ledgerloom.llm.multi_index import best_cells, pack, search
from ledgerloom.llm.quality_fm import score_texts, train
from tests.llm import brute

COLUMNS = ("doc_id", "size", "source_size", "target", "taken")


def mixed_by_sql(sf_dir: str | None = None, rows=None) -> list[tuple]:
    con = duckdb.connect()
    if rows is None:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    else:
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
        if rows:
            con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sorted(con.execute(mix_sql()).fetchall(), key=str)


def test_mix_equals_sql(spark, sf_dir):
    got = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str) == mixed_by_sql(sf_dir)
    assert all(r.taken == int(r.target) for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect())
    assert got.where("taken > 3 * size").isEmpty()


def test_mix_of_odd_rows(documents):
    rows = [(k, "w " * k, s) for k, s in enumerate(["a", "b", "b", None, "é", "z", "a", "c"] * 4)]
    rows += [(None, "no id", "a"), (3, "same id", "b"), (3, "same id", "b"), (70, None, "only"), (71, " \n", "only"), (72, "x y z ", "b"), (73, "w " * 30_000, "long")]
    got = mix(documents(rows))
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str) == mixed_by_sql(rows=rows)
    assert mix(documents([])).count() == 0
    assert [tuple(r) for r in mix(documents([(1, None)])).select("size", "target", "taken").collect()] == [(0, 0.0, 0)]


def test_targets_are_filled_by_weight(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 0, "e": 300, None: 40}
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    want, free, rest = {}, set(names), float(sum(sizes.values()))
    while True:
        level = rest / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not above:
            break
        want |= {s: 3.0 * sizes[s] for s in above}
        rest -= sum(3 * sizes[s] for s in above)
        free -= above
    want |= {s: weight[s] * level for s in free}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("weight", ["1.0", "0.05", "1000.0", "CASE id % 3 WHEN 0 THEN 0.05 ELSE 1.0 END"])
def test_bins_are_small_whatever_the_weights(spark, weight):
    keys = spark.range(50_000).select((-F.log(uniform("s", F.col("id"))) / F.expr(weight)).alias("key"))
    assert keys.groupBy(key_bin(F.col("key"))).count().agg(F.max("count")).first()[0] <= 3 * 50_000 / (math.e * BINS)


QUESTION = "Natalia sold clips to 48 of her friends in April, and then she sold half as many clips in May to Bob. How many clips did she sell?"


def test_leaks_of_the_test_data(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute.leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()} == want and want


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_other_numbers_and_names(documents, frame, monkeypatch, broadcast_rows):
    monkeypatch.setattr("ledgerloom.llm.decontaminate.BROADCAST_ROWS", broadcast_rows)
    items = frame("item_id long, text string", [(1, QUESTION), (2, "tiny thing"), (3, "one two three four"), (None, QUESTION), (5, None), (6, ""), (7, QUESTION + " And how many did her 48 friends and Bob pay in April for 48 clips?")])
    other = QUESTION.replace("48", "72").replace("April", "June").replace("May", "July").replace("Bob", "Ann")
    mixed_up = other.replace("72", "9") + " And how many did her 5 friends and Eve pay in August for 1 clips?"
    docs = documents([(1, f"bla bla. {other} bla"), (2, "x one two three four y"), (3, None), (4, ""), (5, QUESTION.upper()), (5, "other"), (6, "tiny thing"), (None, QUESTION), (8, mixed_up), (9, "many words of no interest here, " * 9000 + QUESTION)])
    got = {(r.doc_id, r.item_id): r.kind for r in leaks(docs, items).collect()}
    assert got[1, 1] == "reparameterised" and got[9, 1] == "copy" and got[2, 3] == "copy"
    assert (8, 7) not in got and (8, 1) in got
    assert got[6, 2] == "copy" and {d for d, _ in got} <= {1, 2, 5, 6, 8, 9}
    assert leaks(documents([]), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0


def test_a_copy_beside_variants(documents, frame):
    items = frame("item_id long, text string", [(1, QUESTION)])
    other = QUESTION.replace("48", "72").replace("April", "June").replace("May", "July").replace("Bob", "Ann")
    third = QUESTION.replace("48", "9").replace("April", "March").replace("May", "August").replace("Bob", "Eve")
    longer = QUESTION.replace("and then she", "and then of course she")
    docs = documents([(1, f"{QUESTION} {other}"), (2, f"{other}\n{third}"), (3, f"{third}\n{longer}\n{other}"), (4, third)])
    got = {(r.doc_id, r.item_id): (r.kind, r.n_same) for r in leaks(docs, items).collect()}
    assert got[1, 1] == ("copy", 4) and got[2, 1] == ("reparameterised", 0) and got[4, 1] == ("reparameterised", 0) and (3, 1) in got


def test_names_that_begin_sentences(documents, frame):
    problem = "Tom has 5 apples. Tom buys 3 more apples at the store. Tom then eats 2 of them. How many apples does Tom have now?"
    items = frame("item_id long, text string", [(1, problem), (2, "Tom has 5 red apples.")])
    docs = documents([(1, problem.replace("Tom", "Ann")), (2, "Well. Ann has 7 red apples. More text."), (3, problem), (4, problem.lower()), (5, "Ann has a dog. Bob has 5 cats. Eve then ran.")])
    got = {(r.doc_id, r.item_id): r.kind for r in leaks(docs, items).collect()}
    assert got == {(1, 1): "reparameterised", (2, 2): "reparameterised", (3, 1): "copy", (4, 1): "copy"}


def test_a_long_run_of_a_longer_item(documents, frame):
    import random

    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    items = frame("item_id long, text string", [(1, " ".join(words))])
    broken = " ".join(w if k % 10 else "other" for k, w in enumerate(words[100:220]))
    with_number = " ".join([*words[50:58], "77", *words[59:70]])
    docs = documents([(1, "some text. " + " ".join(words[100:250]) + " and more"), (2, " ".join(words[10:23])), (3, " ".join(words[10:22])), (4, broken), (5, with_number), (6, " ".join(words))])
    assert {r.doc_id for r in leaks(docs, items).collect()} == {1, 2, 6}


def test_short_items_and_tables_of_numbers(documents, frame):
    items = frame("item_id long, text string", [(1, "tiny thing"), (2, "1 2 3 4 5 6 7 8 9 10 11 12"), (3, "Yes")])
    docs = documents([(1, "Tiny thing!"), (2, "a tiny thing"), (3, " ".join(map(str, range(500)))), (4, "yes"), (5, "yes yes"), (6, "")])
    assert {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()} == {(1, 1), (4, 3)}


def nearest(ids: np.ndarray, x: np.ndarray, k: int) -> list[int]:
    score = x @ x[k]
    return [int(ids[j]) for j in np.lexsort((ids, -score)) if j != k][:20]


def test_recall(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = sorted(vectors.collect(), key=lambda r: r.vec_id)
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got: dict[int, list[int]] = {}
    for r in sorted(search(vectors, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == pytest.approx(float(x[np.searchsorted(ids, r.vec_id)] @ x[np.searchsorted(ids, r.query_id)]), abs=1e-12)
        assert r["rank"] == len(got[r.query_id])
    want = {int(i): nearest(ids, x, k) for k, i in enumerate(ids) if i % 20 == 0}
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9


def test_copies_and_unusable_vectors(frame):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, None), (120, [0.0, 0.0]), (140, [nan, 1.0]), (160, [1.0]), (180, [None, 1.0]), (220, [inf, 0.0]), (240, []), (None, [1.0, 2.0])]
    rows += [(200, [0.5, 1.0]), (200, [0.5, 1.0]), (260, [-3.0, 0.5])]
    vectors = frame("vec_id long, embedding array<float>", rows)
    got: dict[int, list[int]] = {}
    for r in sorted(search(vectors, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {0, 20, 40, 200, 260}
    assert got[0] == list(range(1, 21)) and got[20] == list(range(20)) and got[200] == list(range(20)) and got[260][0] == 200
    assert search(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert search(vectors.where("vec_id = 200"), F.col("vec_id") % 20 == 0).count() == 0


def test_shards_and_blocks_change_nothing(spark, sf_dir, monkeypatch):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    want = sorted(map(tuple, search(vectors, F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id").collect()))
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", 7)
    monkeypatch.setattr(multi_index.pack, "__defaults__", (40,))
    assert sorted(map(tuple, search(vectors, F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id").collect())) == want


def test_cells_come_best_first():
    rng = np.random.default_rng(3)
    a, b, counts = rng.normal(size=9), rng.normal(size=7), rng.integers(0, 4, 63)
    order = [c for c in np.argsort(-(a[:, None] + b[None, :]).ravel()) if counts[c]]
    assert best_cells(a, b, counts, 1e9) == order
    assert best_cells(a, b, counts, 10) == order[: int(np.searchsorted(np.cumsum(counts[order]), 10)) + 1]
    first, parts = pack(np.array([5, 4, 30, 1, 10, 0]), 10)
    assert first.tolist() == [0, 0, 1, 4, 5, 5] and parts.tolist() == [1, 1, 3, 1, 1, 1]


def test_pipeline_equals_brute_force(spark, sf_dir):
    """Each stage against a plain version of it, on what the plain version of the stage before has kept."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    model = train(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))
    docs = {i: t for (i, t), s in zip(docs.items(), score_texts(model, list(docs.values())), strict=True) if s >= 0.3}
    gone = brute.lines(list(docs.items()), least_copy=1)
    docs = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i][0]) for i, t in docs.items()}
    docs = {i: t for i, t in docs.items() if t.strip() or not gone[i][0]}
    docs = {i: docs[i] for i, (_, _, kept) in brute.components(list(docs.items()), size=5).items() if kept}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaky = {d for d, _ in brute.leaks(list(docs.items()), items)}
    docs = {i: t for i, t in docs.items() if i not in leaky}
    want = [r for r in mixed_by_sql(rows=[(i, t, source[i]) for i, t in docs.items()]) if r[4] > 0]
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str) == want


def test_rows_without_or_with_a_shared_id_are_cleaned(spark, documents, sf_dir):
    item = max((r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()), key=len)
    words = [f"word{k}" for k in range(60)]
    text, near = " ".join(words), " ".join([*words[:59], "other"])
    docs = documents([(None, f"before it {item} behind it"), (1, text), (1, "an unrelated text of quite another kind, under the same id"), (None, near), (2, "clean words only")])
    assert sorted(str(r.doc_id) for r in corpus_pipeline.decontamination_stage(spark, docs, sf_dir).collect()) == ["1", "1", "2", "None"]
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, sf_dir).collect()
    assert {r.text for r in kept} == {r.text for r in docs.collect()} - {near}


def test_stages_on_empty_and_odd_documents(spark, documents, sf_dir):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    odd = documents([(None, "text without an id, long enough to be looked at"), (1, None), (2, ""), (3, "the same text, twice over, in full"), (3, "the same text, twice over, in full")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents([]), sf_dir).count() == 0
        kept = stage(spark, odd, sf_dir)
        assert kept.columns == names
    near = corpus_pipeline.near_duplicate_stage(spark, odd, sf_dir).collect()
    assert sorted(str(r.doc_id) for r in near) == ["1", "2", "3", "None"]
    assert corpus_pipeline.mixing_stage(spark, documents([]), sf_dir).count() == 0
