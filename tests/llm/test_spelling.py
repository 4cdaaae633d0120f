"""Spelling variants against a plain version."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import spelling as S
from ledgerloom.llm.queries import QUERIES
from tests.llm import brute

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def found(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def of_counts(spark, counts: dict[str, int], **options) -> list[tuple]:
    rows = spark.createDataFrame(list(counts.items()), "word string, n int")
    words = rows.select("word", F.explode(F.expr("sequence(1, n)")).alias("x"))
    return found(S.spelling_groups(words, **options))


def test_query_equals_plain_version(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute.spelling_groups(brute.slipped_words(rows))
    assert found(QUERIES["op13_spelling_groups"](spark, sf_dir)) == want
    assert any(r[1] for r in want) and any(r[2] != (r[1] or r[0]) for r in want)


@pytest.mark.parametrize("symbols", [1, 2, 5, 40])
def test_reduced_alphabet_changes_nothing(spark, symbols):
    rng = random.Random(symbols)
    words = {"".join(rng.choice("abç") for _ in range(rng.randint(4, 8))): rng.choice([2, 3, 4, 6, 9, 20, 50]) for _ in range(300)}
    got = of_counts(spark, words, symbols=symbols)
    assert got == brute.spelling_groups(words) and max(r[4] for r in got) > 3


def test_neighbourhoods_are_whole():
    words = ["abcabc", "abcab", "abcaba", "xabcabc", "ÿbcabc", "aabcabc"]
    forms = S.reduced(words, 3)
    around = set(S.hashes(forms[0][None], 3)[0].tolist())
    own = [int(S.hashes(f[None], 3)[0, 0]) for f in forms]
    assert set(own) <= around
    # itself, 6 deletions, 6 * 3 replacements and 7 * 3 insertions, counted with repeats
    assert S.hashes(forms[0][None], 3).shape == (1, 1 + 6 + 18 + 21)
    far = S.reduced(["abcabcab"], 3)[0]
    assert int(S.hashes(far[None], 3)[0, 0]) not in around


def test_chains_lead_to_their_end(spark):
    letters = "abcdefghijklmnop"
    words = {letters[: k + 5]: 3 * 2**k for k in range(11)}
    got = {r[0]: r for r in of_counts(spark, words)}
    assert {r[2] for r in got.values()} == {letters[:15]} and got["abcde"][1] == "abcdef" and got[letters[:15]][1] is None
    assert list(got.values()) == brute.spelling_groups(words)


def test_ties_and_limits(spark):
    words = {"house": 10, "hause": 5, "mouse": 10, "louse": 10, "hous": 99, "youse": 2, "blouse": 3, "naïve": 8, "naive": 4, "naive ": 30, "zzzzzz": 3}
    got = {r[0]: r[1:] for r in of_counts(spark, words)}
    assert got["hause"] == ("house", "house", 5, 1, 10) and got["blouse"] == ("louse", "louse", 3, 1, 10)
    assert got["house"] == (None, "house", 10, 3, None) and got["zzzzzz"] == (None, "zzzzzz", 3, 0, None) and "hous" not in got and "youse" not in got
    assert sorted((w, *r) for w, r in got.items()) == brute.spelling_groups(words)


def test_odd_documents(spark, documents):
    rows = [(None, "Grüße grüße GRÜßE Grüße"), (1, None), (2, ""), (3, "word1 words" * 3), (4, "ÀÉÎ×÷ýÿ " * 4), (4, "Ārger ārger " * 5), (5, "letter " * 30_000 + "lettre " * 3), (5, "letter " * 3)]
    docs = documents(rows)
    assert {r.word: r["count"] for r in S.runs(docs, 97).groupBy("word").count().collect()} == dict(brute.slipped_words(rows))
    assert {r.word: r["count"] for r in S.runs(docs, 3).groupBy("word").count().collect()} == dict(brute.slipped_words(rows, 3))
    assert found(S.spelling_groups(S.runs(docs, 97))) == brute.spelling_groups(brute.slipped_words(rows))
    assert found(S.spelling_groups(S.runs(documents([])))) == []
    assert found(S.spelling_groups(spark.createDataFrame([(None,)] * 4, "word string"))) == []


def test_symbols_are_few():
    assert np.concatenate(S.reduced(["abcdefghijklmnopqrstuvwxyzé"], 5)).max() <= 5
    assert S.reduced([]) == []
