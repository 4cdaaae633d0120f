"""Spelling variants grouped under their most frequent form, by one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols. Words one edit apart have reduced words at most one edit apart, and over so few symbols a
reduced word's whole one-edit neighbourhood (itself, deletions, replacements, insertions) is short. The neighbourhoods are joined
with the reduced vocabulary, and the words behind the matches are compared as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut
from ledgerloom.llm.hashing import mixed

#: A run of letters; only A-Z are lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A word's form is at least so many times as frequent.
FACTOR = 2
#: Symbols that letters are hashed to: fewer make short neighbourhoods and more words to compare, more the reverse.
SYMBOLS = 5
#: A hash of a reduced word is a sum of symbols times powers of this odd number, modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
#: Each step to a form at least doubles a 64-bit count, so so many doublings of steps reach every root.
ROUNDS = 6


def lowered(word: Column) -> Column:
    """The word with A-Z in lower case."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, upper, lower))


def runs(documents: DataFrame, slip_every: int | None = None) -> DataFrame:
    """The column word with every run of letters of the texts. NULL texts have none.

    With ``slip_every``, a run loses one letter where that number divides h, the crc32 of doc_id, a colon and the run: the one at h
    modulo its length. Rows without doc_id lose none.
    """
    found = documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({LETTERS})"), F.lit(1))).alias("run"))
    found = found.select("doc_id", lowered(F.col("run")).alias("word"))
    if slip_every is None:
        return found.select("word")
    word = F.col("word")
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    slipped = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return found.select(F.when(h % slip_every == 0, slipped).otherwise(word).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """Distinct words of at least so many code points that occur at least so often: word, n."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def reduced(words: list[str], symbols: int = SYMBOLS) -> list[np.ndarray]:
    """Each word's letters as symbols from 1."""
    data = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    symbol = (mixed(data * np.uint64(_BASE)) >> np.uint64(33)) % np.uint64(symbols) + np.uint64(1)
    return np.split(symbol, np.cumsum([len(w) for w in words])[:-1]) if words else []


def hashes(forms: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """Hashes of reduced words of one length (rows): the word's own first, then those of its deletions, replacements and insertions."""
    n, length = forms.shape
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(length + 1, np.uint64(_BASE))]), dtype=np.uint64)
    before = np.zeros((n, length + 1), dtype=np.uint64)
    np.cumsum(forms * power[:length], axis=1, dtype=np.uint64, out=before[:, 1:])
    whole = before[:, -1:]
    # The part after a place, moved one place down or up.
    down = np.uint64(pow(_BASE, -1, 1 << 64)) * (whole - before[:, 1:])
    up = np.uint64(_BASE) * (whole - before)
    alphabet = np.arange(1, symbols + 1, dtype=np.uint64)
    # A sum modulo 2**64 does not show how many places it has, so the length is mixed in.
    parts = [
        (length, whole),
        (length - 1, before[:, :-1] + down),
        (length, (whole[:, :, None] + (alphabet[None, None, :] - forms[:, :, None]) * power[None, :length, None]).reshape(n, -1)),
        (length + 1, (before[:, :, None] + alphabet[None, None, :] * power[None, : length + 1, None] + up[:, :, None]).reshape(n, -1)),
    ]
    return np.concatenate([mixed(h ^ (np.uint64(of) << np.uint64(48))) for of, h in parts], axis=1)


def _by_form(neighbours: bool, symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            lengths = np.array([len(w) for w in words])
            split = reduced(words, symbols)
            for length in np.unique(lengths).tolist():
                chosen = np.flatnonzero(lengths == length)
                step = max(1, (1 << 20) // (2 * symbols * (length + 1)))
                for start in range(0, len(chosen), step):
                    at = chosen[start : start + step]
                    h = hashes(np.stack([split[k] for k in at]), symbols) if neighbours else hashes(np.stack([split[k] for k in at]), symbols)[:, :1]
                    h = np.sort(h, axis=1)
                    fresh = np.ones(h.shape, dtype=bool)
                    fresh[:, 1:] = h[:, 1:] != h[:, :-1]
                    row, _ = np.nonzero(fresh)
                    out = {"form": pa.array(h[fresh].view(np.int64))}
                    for c in batch.schema.names:
                        out[c] = batch.column(c).take(pa.array(at[row]))
                    yield pa.RecordBatch.from_pydict(out)

    return run


def near_words(vocab: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Pairs of words that differ by one inserted, deleted or replaced code point, in both directions: word, near, near_n."""
    around = vocab.select("word").mapInArrow(_by_form(True, symbols), "form long, word string")
    there = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    there = there.withColumn("word", F.col("near")).mapInArrow(_by_form(False, symbols), "form long, near string, near_n long, word string").drop("word")
    near = F.levenshtein("word", "near", 1) == 1
    return around.hint("shuffle_merge").join(there, (around["form"] == there["form"]) & near).select("word", "near", "near_n")


def roots(links: DataFrame) -> DataFrame:
    """Where following ``links`` (word, form) ends: word, root, for words with a form. Each round doubles the steps taken."""
    reached = cut(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    for _ in range(ROUNDS):
        ahead = reached.select(F.col("word").alias("at"), F.col("root").alias("further"))
        reached = cut(reached.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("at").isNotNull().alias("moved")))
        if reached.where("moved").isEmpty():
            break
    return reached.select("word", "root")


def spelling_groups(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, factor: int = FACTOR, symbols: int = SYMBOLS) -> DataFrame:
    """Words with the form they are likely to be a variant of, and the root that forms lead to.

    ``words`` has a column word with one row an occurrence; NULLs and words under ``least_length`` code points or ``least_count``
    occurrences are no words. A word's form is the near word with the most occurrences (ties: the first by code points) if that has
    at least ``factor`` times its own (two or more), else NULL. Columns: word, form, root, n, n_near (near words), form_n. Other
    columns are ignored; an empty table gives no rows. The result is the same whatever ``symbols`` is.
    """
    vocab = cut(vocabulary(words, least_length, least_count))
    pairs = near_words(vocab, symbols)
    own = vocab.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    each = own.unionByName(pairs.select("word", F.lit(None).cast("long").alias("n"), "near", "near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
    rows = each.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= factor * F.col("n")
    rows = cut(rows.select("word", F.when(fits, F.col("best.near")).alias("form"), "n", "n_near", F.when(fits, -F.col("best.less")).alias("form_n")))
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
