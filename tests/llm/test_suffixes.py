from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerloom.llm.suffix_dedup import common_prefixes, suffix_array, without_repeats
from tests.llm import brute


@pytest.mark.parametrize("seed", range(12))
def test_suffix_arrays_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 98 + seed % 4, 50 + 40 * seed).astype(np.uint8)
    data = np.concatenate([data, data[:60], data])
    order, place = suffix_array(data)
    text = data.tobytes()
    assert order.tolist() == sorted(range(len(text)), key=lambda k: text[k:])
    assert (place[order] == np.arange(len(text))).all()
    got = common_prefixes(data, order, place, 64, lane=17)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :][:64], text[order[k] :][:64]
        assert got[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def rows_with_passages(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh ijklmn é") for _ in range(n))
    passages = [text(rng.randint(150, 700)) for _ in range(6)]
    rows = [(i, text(rng.randint(0, 300)) + rng.choice(passages)[rng.randint(0, 90) :] + text(rng.randint(0, 50)) + rng.choice(passages)) for i in range(80)]
    rows += [(500, None), (501, ""), (502, "x" * 1000), (503, "ab" * 300), (504, text(250)), (504, "y"), (505, passages[0]), (505, passages[0])]
    return [*rows, (None, passages[1] + "zz"), (506, "hello " * 100)]


@pytest.mark.parametrize("shard_bytes", [1 << 21, 2500])
def test_removed_bytes_equal_brute_force(documents, shard_bytes):
    rows = rows_with_passages(5)
    got = [tuple(r)[:5] for r in without_repeats(documents(rows), shard_bytes=shard_bytes).collect()]
    assert sorted(got, key=str) == sorted(brute.without_repeats(rows), key=str)


def test_empty_table_and_pieces_of_long_texts(documents, monkeypatch):
    assert without_repeats(documents([])).count() == 0
    monkeypatch.setattr("ledgerloom.llm.suffix_dedup.PIECE", 700)
    rows = rows_with_passages(6)[:40]
    rows.append((900, "".join(t for _, t in rows[:20])))
    got = [tuple(r)[:5] for r in without_repeats(documents(rows)).collect()]
    assert sorted(got, key=str) == sorted(brute.without_repeats(rows), key=str)
