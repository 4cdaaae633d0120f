"""Text quality by a factorisation machine.

Features of a text are its hashed words, with log counts scaled to length one, one interval of each structure statistic, and one of
the length that the table states for it (its metadata). The
score is the logistic of  b + sum w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ],  which takes all pairwise
interactions into account in time linear in the number of features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import give_back, gives_back, slices
from ledgerloom.llm.hashing import Texts, chunks

#: Buckets of hashed words.
BUCKETS = 1 << 12
RANK = 8
#: The model is fitted on so many labelled rows at most: those with the smallest hash of their doc_id, a sample of fixed size.
MOST_ROWS = 12_000
EPOCHS = 8
#: predicted is 1 from this score on.
THRESHOLD = 0.3
#: Upper ends of the intervals of each statistic; shares unless named otherwise.
INTERVALS = {
    "log2 words": (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14),
    "characters per word": (2, 3, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 15),
    "distinct words": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "words equal to the one before": (0.0, 0.005, 0.02, 0.05, 0.1, 0.3, 0.6),
    "symbols": (0.0, 0.002, 0.01, 0.03, 0.06, 0.1, 0.2, 0.3),
    "exclamation marks": (0.0, 0.002, 0.01, 0.03, 0.06, 0.1, 0.2),
    "bars among words": (0.0, 0.01, 0.05, 0.1, 0.2, 0.3, 0.4),
    "capitals": (0.0, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5, 0.7),
    "digits": (0.0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.3),
    "stops": (0.0, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05, 0.1),
    "distinct lines": (0.1, 0.25, 0.5, 0.75, 0.9, 0.99),
    "words per line": (2, 4, 8, 16, 32, 64, 128, 256),
    "outside ASCII": (0.0, 0.01, 0.03, 0.06, 0.1, 0.3),
    "log2 stated characters": (2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 18),
}
EDGES = [np.array(v, dtype=float) for v in INTERVALS.values()]
OFFSETS = np.cumsum([0] + [len(e) + 1 for e in EDGES])
SIZE = BUCKETS + int(OFFSETS[-1])


#: Classes of bytes: symbols, exclamation marks, bars, capitals, digits, stops, first bytes outside ASCII; 0 is any other.
_CLASS = np.zeros(256, dtype=np.int64)
for _k, _chars in enumerate((b"#$%&*+<=>@[]^_`{}~\\", b"!", b"|", bytes(range(65, 91)), b"0123456789", b".,;:?", bytes(range(192, 256)))):
    _CLASS[list(_chars)] = _k + 1


class Model(NamedTuple):
    bias: float
    linear: np.ndarray
    factors: np.ndarray


class Features(NamedTuple):
    """Indices and values of texts, one after the other; those of text k begin at starts[k]. Every text has some."""

    index: np.ndarray
    value: np.ndarray
    starts: np.ndarray


def _count(number: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(number, minlength=n).astype(float)


def features(texts: list[str | None], stated: list[int | None] | None = None) -> Features:
    """Features of texts; NULL counts as empty. A stated length that is missing or negative is the text's own."""
    t, n = Texts(texts), len(texts)
    doc, start, end = t.words()
    word = t.hashes(start, end) >> np.uint64(24)
    n_words = _count(doc, n)
    repeated = _count(doc[1:][(word[1:] == word[:-1]) & (doc[1:] == doc[:-1])], n)
    # Sorted by text and hash, words of one kind are neighbours, and so are words of one bucket (the hash's first bits).
    keys = np.sort((doc.astype(np.uint64) << np.uint64(40)) | word)
    distinct = _count((keys[np.diff(keys, prepend=~keys[:1]) != 0] >> np.uint64(40)).astype(np.int64), n)
    bucket = keys >> np.uint64(28)
    first = np.flatnonzero(np.diff(bucket, prepend=~bucket[:1]) != 0)
    value = np.log1p(np.diff(np.append(first, len(keys))).astype(float))
    w_doc, w_index = (bucket[first] >> np.uint64(12)).astype(np.int64), (bucket[first] % np.uint64(BUCKETS)).astype(np.int64)
    value /= np.sqrt(np.bincount(w_doc, weights=value * value, minlength=n))[w_doc]
    l_doc, l_start, l_end = t.lines()
    n_lines = _count(l_doc, n)
    line = np.unique((l_doc.astype(np.uint64) << np.uint64(40)) | (t.hashes(l_start, l_end) >> np.uint64(24)))
    d_lines = _count((line >> np.uint64(40)).astype(np.int64), n)
    of = np.repeat(np.arange(n) * 8, t.lengths + 1)
    shares = np.bincount(of + _CLASS[t.symbols], minlength=8 * n).reshape(n, 8)
    outside = np.bincount(of[((t.symbols >= 128) & (t.symbols < 192))] // 8, minlength=n)
    chars, some = np.maximum(1, t.lengths - outside), np.maximum(1, n_words)
    length = np.array([-1 if c is None else c for c in stated or [None] * n], dtype=float)
    length = np.maximum(1, np.where(length < 0, chars, length))
    symbols, marks, bars, capitals, digits, stops, rest = (shares[:, k] for k in range(1, 8))
    stats = (np.log2(some), chars / some, distinct / some, repeated / some, (symbols + bars) / chars, marks / chars, bars / some, capitals / chars,
             digits / chars, stops / chars, d_lines / n_lines, n_words / n_lines, rest / chars, np.log2(length))
    own = np.stack([BUCKETS + OFFSETS[k] + np.searchsorted(e, x) for k, (e, x) in enumerate(zip(EDGES, stats, strict=True))], axis=1)
    index = np.concatenate([w_index, own.ravel()])
    value = np.concatenate([value, np.full(own.size, 0.5)])
    order = np.argsort(np.concatenate([w_doc, np.repeat(np.arange(n), own.shape[1])]), kind="stable")
    starts = np.concatenate([[0], np.cumsum(_count(w_doc, n) + own.shape[1])]).astype(np.int64)
    return Features(index[order], value[order], starts)


def score_texts(model: Model, texts: list[str | None], stated: list[int | None] | None = None) -> np.ndarray:
    """Scores in (0, 1), each computed from its own text and stated length alone."""
    out = np.empty(len(texts))
    for at, some in chunks(texts):
        f = features(some, stated and stated[at : at + len(some)])
        v = model.factors[f.index] * f.value[:, None]
        sums = lambda x: np.add.reduceat(x, f.starts[:-1], axis=0)  # noqa: E731, B023
        z = model.bias + sums(model.linear[f.index] * f.value) + 0.5 * (sums(v) ** 2 - sums(v * v)).sum(axis=1)
        out[at : at + len(some)] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return out


def fit(texts: list[str | None], labels: np.ndarray, epochs: int = EPOCHS, rank: int = RANK, seed: int = 7, stated: list[int | None] | None = None) -> Model:
    """Logistic loss by adaptive gradient steps over shuffled blocks of 128 texts, more often where there are few. Without both labels: a constant score."""
    rng = np.random.default_rng(seed)
    n, w = len(texts), np.zeros(SIZE, dtype=np.float32)
    v = rng.normal(0, 0.02, (SIZE, rank)).astype(np.float32)
    mean = (float(labels.sum()) + 0.5) / (n + 1)
    b = math.log(mean / (1 - mean))
    if n == 0 or labels.min() == labels.max():
        return Model(b, w, np.zeros_like(v))
    rows = []
    for at, some in chunks(texts):
        f = features(some, stated and stated[at : at + len(some)])
        rows += [(f.index[a:z], f.value[a:z]) for a, z in zip(f.starts[:-1], f.starts[1:], strict=True)]
    gw, gv, gb = np.full(SIZE, 1e-4, dtype=np.float32), np.full((SIZE, rank), 1e-4, dtype=np.float32), 1e-4
    for _ in range(max(epochs, 40_000 // n)):
        order = rng.permutation(n)
        for start in range(0, n, 128):
            block = order[start : start + 128]
            x = np.zeros((len(block), SIZE), dtype=np.float32)
            for r, k in enumerate(block):
                np.add.at(x[r], rows[k][0], rows[k][1])
            used = np.flatnonzero(x.any(axis=0))
            x = x[:, used]
            x2, vu = x * x, v[used]
            xv = x @ vu
            z = b + x @ w[used] + 0.5 * ((xv * xv) - x2 @ (vu * vu)).sum(axis=1)
            err = (1 / (1 + np.exp(-z)) - labels[block]).astype(np.float32) / len(block)
            dw = x.T @ err + 1e-5 * w[used]
            dv = x.T @ (err[:, None] * xv) - (x2.T @ err)[:, None] * vu + 1e-4 * vu
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += float(err.sum()) ** 2
            w[used] -= 0.1 * dw / np.sqrt(gw[used])
            v[used] -= 0.02 * dv / np.sqrt(gv[used])
            b -= 0.1 * float(err.sum()) / math.sqrt(gb)
    return Model(b, w, v)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of learning: crc32 of its id as text, modulo 5, is 0. False for NULL."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """A model from the labelled rows that are not held out, at most ``most_rows`` of them.

    Reads doc_id, text and n_chars if it is there, doc_id and quality. Labels other than 0 and 1, and those without a document, are left out; of
    contradicting labels of one doc_id the lower counts. The sample has a fixed size, so it is broadcast and fitted in one task; of several texts
    under one doc_id the first in order counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    one = F.struct(F.coalesce("text", F.lit("")).alias("text"), stated_length(documents).alias("stated"))
    rows = documents.select("doc_id", one.alias("one")).join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("one").alias("one")).select("doc_id", "one.text", "one.stated", "label")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "label", "text", "stated")), strict=True)), key=lambda r: r[0])
        m = fit([r[2] for r in got], np.array([r[1] for r in got], dtype=np.float32), stated=[r[3] for r in got])
        yield pa.record_batch([pa.array([m.bias]), pa.array([m.linear.tobytes()]), pa.array([m.factors.tobytes()])], names=["bias", "linear", "factors"])

    found = rows.repartition(1).mapInArrow(gives_back(learn), "bias double, linear binary, factors binary").collect()
    if not found:
        return fit([], np.zeros(0))
    bias, linear, factors = found[0]
    return Model(bias, np.frombuffer(linear, dtype=np.float32), np.frombuffer(factors, dtype=np.float32).reshape(SIZE, -1))


def stated_length(documents: DataFrame) -> Column:
    """What a table says of the length of its texts: n_chars, NULL where it has no such column."""
    return (F.col("n_chars") if "n_chars" in documents.columns else F.lit(None)).cast("long")


def score(model: Model, text: Column, stated: Column | None = None) -> Column:
    """Quality score of a text column and the lengths stated for it; NULL counts as empty."""

    @F.arrow_udf("double")
    def run(texts: pa.Array, lengths: pa.Array) -> pa.Array:
        out, at = [np.zeros(0)], 0
        for some in slices(texts):
            out.append(score_texts(model, some.to_pylist(), lengths.slice(at, len(some)).to_pylist()))
            at += len(some)
        give_back()
        return pa.array(np.concatenate(out))

    return run(text, F.lit(None).cast("long") if stated is None else stated)


def quality(documents: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Scores depend on the text and on n_chars, if the table has it, alone: not on labels, language, source or id. NULL and empty texts are scored by their (empty)
    statistics, whole texts whatever their length. Repeated rows and doc_ids give one row each; a NULL doc_id is kept and never
    learnt from. Without labels of both kinds every text gets the same score. Other columns are ignored.
    """
    scored = documents.select("doc_id", score(train(documents, labels, most_rows), F.col("text"), stated_length(documents)).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
