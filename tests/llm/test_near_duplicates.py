from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerloom.llm import chosen_path
from ledgerloom.llm.chosen_path import components, near_duplicates, shingle_sets
from tests.llm import brute


def near_copies(seed: int, groups: int, sizes: list[int]) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        for _ in range(rng.choice(sizes)):
            rate = rng.choice([0, 0.02, 0.05, 0.08])
            out.append(" ".join(rng.choice(words) if rng.random() < rate else w for w in base))
    return list(enumerate(out))


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("leaf, levels, block", [(64, 10, 1024), (4, 2, 8)])
def test_components_equal_brute_force(documents, monkeypatch, leaf, levels, block):
    for name, value in (("LEAF", leaf), ("LEVELS", levels), ("BLOCK", block)):
        monkeypatch.setattr(chosen_path, name, value)
    rows = near_copies(3, 8, [1, 2, 3, 40]) + [(9000, "One"), (9001, "one"), (9002, "ONE two"), (9003, ""), (9004, None), (9005, " \n\t")]
    assert result(near_duplicates(documents(rows))) == brute.components(rows)


def crowd(n: int) -> list[tuple[int, str]]:
    """Near copies of one text that are seldom linked to one another: 5 of its 100 words are others."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(100)]
    return [(i, " ".join(f"x{i}.{k}" if k in gone else w for k, w in enumerate(base))) for i, gone in ((i, rng.sample(range(100), 5)) for i in range(n))]


def test_crowds_are_not_branched_over_and_over(documents, monkeypatch):
    levels = []

    def noted(df, rows_per_task=None):
        kept = cut(df, rows_per_task)
        if {"path", "n"} <= set(df.columns):
            levels.append(kept.count())
        return kept

    cut = chosen_path.cut
    monkeypatch.setattr(chosen_path, "cut", noted)
    monkeypatch.setattr(chosen_path, "LEAF", 8)
    rows = crowd(150)
    assert result(near_duplicates(documents(rows))) == brute.components(rows)
    assert sum(levels) < 5 * chosen_path.TREES * len(rows)


def test_a_crowd_is_confirmed_once_and_not_in_each_branch(documents, monkeypatch, tmp_path):
    confirmed, links_apart = tmp_path / "confirmed", chosen_path._links_apart

    def noted(size, percent):
        run = links_apart(size, percent)

        def noting(cell):
            with confirmed.open("a") as f:
                f.write(f"{cell.num_rows}\n")
            return run(cell)

        return noting

    monkeypatch.setattr(chosen_path, "_links_apart", noted)
    monkeypatch.setattr(chosen_path, "LEAF", 8)
    rows = crowd(150)
    assert result(near_duplicates(documents(rows))) == brute.components(rows)
    assert sum(map(int, confirmed.read_text().split())) < 3 * len(rows)


def test_crowds_in_many_blocks(documents, monkeypatch):
    for name, value in (("LEAF", 8), ("BLOCK", 40), ("ROOM", 3_000), ("TILE", 16), ("FEW", 2), ("MANY", 4), ("ROWS_SENT", 0)):
        monkeypatch.setattr(chosen_path, name, value)
    rows = crowd(150)
    assert result(near_duplicates(documents(rows))) == brute.components(rows)


def test_crowds_of_a_long_chain_are_confirmed_where_they_meet(documents, monkeypatch):
    """Texts that share most words with their neighbours, and others that come near them without a link."""
    keys, crowds_joined = [], chosen_path._crowds_joined

    def noted(rows, *others):
        keys.append(rows.groupBy("key").count().count())
        return crowds_joined(rows, *others)

    monkeypatch.setattr(chosen_path, "_crowds_joined", noted)
    rows = [(i, " ".join(f"w{k}" for k in range(2 * i, 2 * i + 100))) for i in range(500)]
    rows += [(1000 + i, " ".join(f"x{i}.{k}" if k % 12 == 0 else f"w{k}" for k in range(2 * i, 2 * i + 100))) for i in range(0, 500, 7)]
    assert result(near_duplicates(documents(rows))) == brute.components(rows)
    assert max(keys) > 1


def test_pairs_of_leaves_are_those_of_each_leaf():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 9, (5, chosen_path.FUNCTIONS)).astype(np.int16)
    sign = np.where(rng.random((90, chosen_path.FUNCTIONS)) < 0.15, rng.integers(0, 9, (90, chosen_path.FUNCTIONS)), base[rng.integers(0, 5, 90)]).astype(np.int16)
    n, part, end = rng.integers(80, 120, 90), rng.integers(0, 30, 90), np.repeat([1, 30, 32, 90], [1, 29, 2, 58])
    a, b, agree = chosen_path._candidate_pairs(end, sign, n, part, 80)
    whole = np.triu(chosen_path._candidates(sign, n, part, 80)) * (end[:, None] == end)
    assert len(a) > 100 and list(zip(a, b, agree)) == [(i, j, whole[i, j]) for i, j in zip(*np.nonzero(whole))]


def test_sets_of_one_part_are_not_compared():
    agree = chosen_path._candidates(np.zeros((4, chosen_path.FUNCTIONS), dtype=np.int16), np.array([10, 10, 10, 1]), np.array([7, 7, 3, 4]), 80)
    assert (agree > 0).tolist() == [[False, False, True, False], [False, False, True, False], [True, True, False, False], [False] * 4]


def test_branches_share_a_similar_pair_once_on_average(spark):
    paths = spark.range(4_000).withColumnRenamed("id", "path")
    for step in (1, chosen_path.STEP):
        lists = paths.select(chosen_path._branches(step).alias("lists")).collect()
        assert all(len(f) == step and all(0 <= k < chosen_path.FUNCTIONS for k in f) for r in lists for f in r.lists)
        assert abs(sum(len(r.lists) for r in lists) / len(lists) - 1.25**step) < 0.05


def test_documents_of_the_test_data(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(near_duplicates(docs)) == brute.components(rows)
    assert result(near_duplicates(docs, size=5)) == brute.components(rows, size=5)


def test_missing_and_repeated_ids(documents):
    text = "a b c d e f g h i j k l m n"
    rows = sorted(map(tuple, near_duplicates(documents([(None, text), (5, text), (5, text), (5, "other words"), (7, text), (None, "alone here")])).select("doc_id", "component_id", "kept").collect()), key=str)
    assert rows == sorted([(None, 5, False), (5, 5, True), (5, 5, True), (5, 5, True), (7, 5, False), (None, None, False)], key=str)
    assert near_duplicates(documents([])).count() == 0


def test_shingles_of_long_and_short_texts():
    texts = ["", None, "A", "a a a a", "x " * 70_000, "É é"]
    assert [len(s) for s in shingle_sets(texts)] == [len(brute.shingles(t, 2)) for t in texts]


def test_components_of_chains(spark):
    chain = [(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.part for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {90: 90, 95: 90, 100: 90}


@pytest.mark.parametrize("links_per_task", [0, 1 << 20])
def test_components_in_one_task_and_by_stars(spark, monkeypatch, links_per_task):
    monkeypatch.setattr(chosen_path, "LINKS_PER_TASK", links_per_task)
    rng = random.Random(11)
    links = [(rng.randrange(700), rng.randrange(700)) for _ in range(330)] + [(k, k + 1) for k in range(1000, 1300)] + [(5000, k) for k in range(5001, 5050)]
    root = {x: x for pair in links for x in pair}
    for _ in range(2000):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if all(root[a] == root[b] for a, b in links):
            break
    got = {r.node: r.part for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: p for k, p in root.items() if any(a != b and k in (a, b) for a, b in links)}
