"""Fingerprints that add up."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm.multiset_hash import SHORT, WIDTH, Fingerprints, combined, edited_fingerprints, edited_text


def plain(rows: list[tuple]) -> list[tuple]:
    """doc_id, n_chars, hash of the edited text, whether that is the text, and the text's and the edited text's fingerprint."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0]))
    out = []
    for k, (i, t) in enumerate(rows):
        e = edited_text(t, rows[(k + 1) % len(rows)][1])
        prints = Fingerprints.of([t, e]).bytes()
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), prints[0].hex(), prints[1].hex()))
    return out


def found(df) -> list[tuple]:
    return [tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint").collect()]


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    result = edited_fingerprints(docs.repartition(7)).cache()
    assert by_id(found(result)) == by_id(plain(rows))
    got = {r.doc_id: r for r in result.collect()}
    texts = dict(rows)
    ids = sorted(texts)
    for i, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].near_next == 1) >= (texts[i] == texts[after])
    assert {(a, b) for a in ids for b in ids if texts[a] == texts[b]} == {(a, b) for a in ids for b in ids if got[a].fingerprint == got[b].fingerprint}
    edited, following = (np.array([got[i][c] for i in ids]) for c in ("near_edited", "near_next"))
    assert np.median(edited) > 0.4 and np.median(following) < 0.1 and (edited > following).mean() > 0.97


def test_likeness_follows_the_texts(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).collect() if len(r.text.split()) > 50]
    pairs = [(a, edited_text(a, b)) for a, b in zip(texts, texts[1:], strict=False)]
    got = Fingerprints.of([a for a, _ in pairs]).like(Fingerprints.of([b for _, b in pairs]))
    want = []
    for pair in pairs:
        a, b = (Counter(p for line in t.split("\n") if (w := line.split()) for p in (zip(w, w[1:], strict=False) if len(w) > 1 else [w[0]])) for t in pair)
        want.append(2 * sum(n * b[x] for x, n in a.items()) / sum(n * n for c in (a, b) for n in c.values()))
    assert np.abs(got - want).mean() < 0.05 and np.abs(got - want).max() < 0.25


def test_paragraphs_come_and_go():
    one, two, three = "the first paragraph", "a second, with More words in it é", "third"
    whole = Fingerprints.of([f"{one}\n{two}\n{three}\n{two}"])
    turned = Fingerprints.of([f"{two}\n{three}\n{two}\n{one}"])
    assert whole.same(turned).all() and whole.bytes() == turned.bytes()
    assert not whole.same(Fingerprints.of([f"{one}\n{two}\n{three}"])).any()
    assert (whole - Fingerprints.of([two])).bytes() == Fingerprints.of([f"{one}\n{two}\n{three}"]).bytes()
    assert (Fingerprints.of([three]) + Fingerprints.of([f"{one}\n{two}"])).bytes() == Fingerprints.of([f"{one}\n{two}\n{three}"]).bytes()
    assert Fingerprints.read(whole.bytes()).bytes() == whole.bytes() and len(whole.bytes()[0]) == SHORT
    for n in (127, 128, 129, 32_768, 70_000):
        much = Fingerprints.of(["a b\n" * n])
        assert Fingerprints.read(much.bytes()).same(much).all() and len(much.bytes()[0]) in (SHORT, WIDTH)
    assert len(Fingerprints.of(["a b\n" * 129]).bytes()[0]) == WIDTH
    assert Fingerprints.of(["a b", "a b\n", "A b", "a  b", ""]).bytes() == [Fingerprints.of([t]).bytes()[0] for t in ("a b", "a b\n", "A b", "a  b", "")]
    assert len({*Fingerprints.of(["a b", "a b\n", "A b", "a  b", ""]).bytes()}) == 5


def test_odd_rows(documents):
    rows = [(5, "a"), (3, None), (4, ""), (7, "long text é \U0001f600 " * 40_000), (6, "word " * 9), (9, "é" * 5), (8, "one\n\ntwo\nthree\n")]
    result = edited_fingerprints(documents(rows))
    assert by_id(found(result)) == by_id(plain(rows))
    near = {r.doc_id: (r.near_edited, r.near_next) for r in result.collect()}
    assert near[3] == (1.0, 1.0) and near[4] == (1.0, 0.0) and near[5] == (1.0, 0.0)
    assert found(edited_fingerprints(documents([]))) == []
    assert [(*r[:3], r[3] == r[4]) for r in found(edited_fingerprints(documents([(1, "alone here")])))] == [(1, 10, hashlib.sha256(b"alonealone").hexdigest(), False)]


def test_equal_ids_and_none(documents):
    rows = [(1, "first text"), (2, "same"), (2, "same"), (2, "same"), (None, "no id"), (None, "no id")]
    want = by_id(plain(rows))
    for parts in (1, 5):
        assert by_id(found(edited_fingerprints(documents(rows).repartition(parts)))) == want
    two = edited_fingerprints(documents([(1, "some text"), (1, "other text"), (2, "x")]))
    assert found(two) == found(two) and two.count() == 3


def test_fingerprints_of_groups(documents):
    rows = [(k, f"text {k}\nline {k % 3}", "ab"[k % 2]) for k in range(20)]
    prints = edited_fingerprints(documents([r[:2] for r in rows])).withColumn("side", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    want = {side: Fingerprints.of(["\n".join(t for _, t, s in rows if s == side)]).bytes()[0].hex() for side in "ab"}
    assert {r.side: r.fingerprint for r in combined(prints, ["side"]).collect()} == want
