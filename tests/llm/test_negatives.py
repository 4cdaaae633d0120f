"""Hard negatives against plain sums."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import packed_negatives as N
from ledgerloom.llm.queries import ORACLES, QUERIES
from tests.llm import brute

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def found(vectors, label=None) -> list[tuple]:
    got = N.hard_negatives(vectors, F.col("vec_id") % 100 == 0, F.col("label") if label is None else label)
    return sorted(tuple(r) for r in got.select(*COLUMNS).collect())


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = sorted(con.execute(ORACLES["op11_hard_negatives"]).fetchall())
    got = QUERIES["op11_hard_negatives"](spark, sf_dir)
    assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == want and want


@pytest.mark.parametrize("low, high, d", [(-300, 300, 64), (0, 1, 3), (-5, -2, 1), (-(10**7), 10**7, 40), (7, 7, 2)])
def test_packed_products_are_exact(low, high, d):
    rng = np.random.default_rng(d)
    a, c = rng.integers(low, high, (5, d), endpoint=True), rng.integers(low, high, (23, d), endpoint=True)
    ready = N.Packed(c, int(a.min()), int(a.max()))
    assert ready.fields >= 2
    assert (ready.scores(a) == a @ c.T).all()


def test_wide_products_are_cut_to_the_limit():
    a = np.array([[1 << 40, -(1 << 40)], [3, 4]])
    got = N.Packed(np.array([[1 << 40, 1], [1, 1 << 40]]), -(1 << 40), 1 << 40).scores(a)
    assert got.tolist() == [[N.LIMIT, -N.LIMIT], [3 * (1 << 40) + 4, 3 + (1 << 42)]]


def random_rows(n: int, d: int, labels: int, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).round(2)
    x[n // 3 : n // 2] = x[0]  # copies of one vector
    return [(int(i), int(rng.integers(labels)), v.tolist()) for i, v in zip(rng.permutation(3 * n)[:n], x, strict=True)]


@pytest.mark.parametrize("shard, block, tile", [(N.SHARD, N.BLOCK, N.TILE), (300, 20, 40)])
def test_equals_plain_sums(frame, monkeypatch, shard, block, tile):
    monkeypatch.setattr(N, "SHARD", shard)
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "TILE", tile)
    rows = random_rows(400, 5, 4)
    got = found(frame("vec_id long, label int, embedding array<float>", rows))
    assert got == brute.hard_negatives([(i, label, [float(np.float32(x)) for x in v]) for i, label, v in rows]) and len(got) >= 50


def test_odd_rows(frame):
    inf, nan = float("inf"), float("nan")
    good = random_rows(150, 3, 2, seed=3) + [(500, 0, [3.0, 4.0]), (600, 1, [1.0, 2.0, 0.5, 9.0]), (700, 1, []), (-100, 0, [-1.0, 0.2, 0.1])]
    bad = [(None, 1, [9.0, 9.0, 9.0]), (1000, None, [9.0, 9.0, 9.0]), (1100, 1, None), (1200, 1, [nan, 1.0, 1.0]), (1300, 0, [inf, 1.0, 1.0]), (1400, 0, [None, 1.0, 1.0])]
    vectors = frame("vec_id long, label int, embedding array<double>", good + good[:40] + bad)
    assert found(vectors) == brute.hard_negatives(good)
    assert found(vectors.limit(0)) == [] and found(vectors.where("vec_id = 500")) == []
    assert found(vectors.where("vec_id is null or label is null")) == []


def test_one_id_with_two_vectors(frame):
    rows = [(100, 0, [1.0, 0.0]), (100, 0, [0.0, 1.0]), (1, 0, [1.0, 1.0]), (2, 1, [1.0, 1.0]), (2, 1, [1.0, 0.9])]
    got = found(frame("vec_id long, label int, embedding array<double>", rows))
    assert got == brute.hard_negatives(rows) and len(got) == 4


def test_huge_components(frame):
    rows = [(100, 0, [1e300, 1.0]), (1, 0, [1e30, 1.0]), (2, 1, [1e30, 2.0]), (3, 1, [-1e30, 2.0]), (4, 1, [1.0, 1.0])]
    assert [r[:4] for r in found(frame("vec_id long, label int, embedding array<double>", rows))] == [(100, 1, 1, 2), (100, 1, 2, 4)]
