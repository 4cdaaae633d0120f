from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import line_dedup
from ledgerloom.llm.hashing import Spans, Texts
from ledgerloom.llm.line_dedup import deduplicated_lines, edit_distance, without_repeated_lines
from tests.llm import brute


@given(st.text("ab", max_size=14), st.text("abc", max_size=14), st.integers(1, 5))
@settings(max_examples=500, deadline=None)
def test_edit_distance_up_to_a_limit(a, b, most):
    assert edit_distance(a, b, most) == min(most + 1, brute.distance(a, b))


def test_keys_leave_room_in_shuffles():
    t = Texts(["a line that is long enough to be compared with others", "another line that is long enough, and of another length"], wide=True)
    keys = [key for _, key, _ in line_dedup.line_keys(Spans(t.symbols), t.starts, t.lengths, 2)]
    assert keys and all((key & np.uint64(0xFFFF) == 0).all() and len(np.unique(key)) == len(key) for key in keys)


def changed_lines(seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(24, 60))) for _ in range(15)]

    def change(line: str) -> str:
        chars = list(line)
        for _ in range(rng.randint(0, 4)):
            k, p = rng.random(), rng.randrange(len(chars))
            if k < 0.4:
                chars[p] = rng.choice("abcé")
            elif k < 0.7:
                chars.insert(p, "x")
            else:
                chars.pop(p)
        return "".join(chars)

    return [(i, "\n".join(change(rng.choice(base)) for _ in range(rng.randint(0, 5)))) for i in range(60)]


@pytest.mark.parametrize("small, block", [(48, 4096), (3, 6)])
def test_lines_equal_brute_force(documents, monkeypatch, small, block):
    monkeypatch.setattr(line_dedup, "SMALL_GROUP", small)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rows = [*changed_lines(4), (500, None), (501, ""), (502, "y" * 30 + "\n" + "y" * 30)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_near, r.n_links) for r in deduplicated_lines(documents(rows), least_copy=24).collect()}
    texts = dict(rows)
    want = {i: (0 if texts[i] is None else texts[i].count("\n") + 1, len(gone), near, links) for i, (gone, near, links) in brute.lines(rows).items()}
    assert got == want


def test_lines_are_taken_out(documents):
    line = "this is a line of more than twenty-four characters"
    rows = [(1, f"first words\n{line}"), (2, f"{line}\nlast words"), (3, line.replace("is a", "is ä")), (4, None), (5, ""), (None, line), (6, "short\nshort")]
    got = {r.doc_id: r.text for r in without_repeated_lines(documents(rows), least_copy=24).collect()}
    assert got == {1: rows[0][1], 2: "last words", 4: None, 5: "", None: line, 6: "short\nshort"}


def test_one_row_for_each_row(documents):
    line = "z" * 40
    got = sorted((r.doc_id, r.n_removed) for r in deduplicated_lines(documents([(1, line), (1, line), (2, line), (2, "other " * 9), (None, line)])).collect())
    assert got == [(1, 0), (1, 0), (2, 0), (2, 1)]
    assert deduplicated_lines(documents([])).count() == 0


def test_very_long_lines(documents):
    line = "".join(random.Random(1).choices("abcdefgh ", k=200_000))
    got = {r.doc_id: r.n_removed for r in deduplicated_lines(documents([(1, line), (2, "x" + line), (3, line[::-1])])).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_short_copies_go(documents):
    line = "a line that is compared with others, as it is long"
    rows = [(1, f"short\n{line}\n \n"), (2, f"short\nother\n{line}!\n \n"), (3, "shorter\nother\né\n\t\n\né"), (4, "short"), (None, "short"), (5, None), (6, "")]
    got = {r.doc_id: (r.n_removed, r.n_near, r.n_links) for r in deduplicated_lines(documents(rows), least_copy=1).collect()}
    assert got == {1: (0, 0, 1), 2: (2, 1, 1), 3: (2, 0, 0), 4: (1, 0, 0), 5: (0, 0, 0), 6: (0, 0, 0)}
    kept = {r.doc_id: r.text for r in without_repeated_lines(documents(rows), least_copy=1).collect()}
    assert kept == {1: rows[0][1], 2: "other\n \n", 3: "shorter\né\n\t\n", None: "short", 5: None, 6: ""}


def test_query_removes_short_copies(spark, sf_dir):
    """Every non-blank line stays in one place of the query's table at most, whatever its length."""
    from ledgerloom.llm.queries import op9_repeated_lines

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    long = {i: len(gone) for i, (gone, _, _) in brute.lines(rows).items()}
    seen, short = set(), dict.fromkeys(long, 0)
    for i, t in sorted(rows):
        for line in t.split("\n"):
            if line.strip() and len(line) < 24:
                short[i] += line in seen
                seen.add(line)
    assert sum(short.values()) > 0
    assert {r.doc_id: r.n_removed for r in op9_repeated_lines(spark, sf_dir).collect()} == {i: long[i] + short[i] for i in long}
