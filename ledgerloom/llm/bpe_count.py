"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into pieces by the tokenizer's pattern; the bytes of a piece form a linked list, and a heap yields the adjacent pair
of lowest rank, again and again, until no pair has a rank. The count is the number of bytes minus the number of merges; no token
identifiers are made. Counts of pieces seen before are kept, up to a number, so memory stays bounded for any corpus.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches

#: The pieces of byte-level tokenizers (fixed pattern).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pattern for texts of characters below LATIN_END, with the classes spelt out, for Python's faster engine.
LATIN_END = 0x250
_BEYOND = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]")
#: Pieces whose counts a task keeps; when there are more, it begins anew.
KEPT_PIECES = 600_000
_NUMBERS = list(range(-1, 257))
LIMIT = 1024


class Merges(NamedTuple):
    """pairs: (left << 32 | right) of symbols to the rank, which is also the merge's place; made: the symbol each merge makes."""

    pairs: dict[int, int]
    made: list[int]
    special: tuple[str, ...]


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def latin_pieces() -> str:
    chars = [chr(c) for c in range(LATIN_END)]
    members = lambda of: "".join(re.escape(c) for c in chars if of(c))
    letter = members(lambda c: unicodedata.category(c)[0] == "L")
    number = members(lambda c: unicodedata.category(c)[0] == "N")
    space = members(lambda c: c in "\t\n\v\f\r \x85\xa0")
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"


def load_merges(path: str) -> Merges:
    """Merges of a byte-level vocabulary file. Symbols 0 to 255 are the bytes, others are numbered as they appear."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    symbols: dict[str, int] = dict(byte_letters())
    pairs, made = {}, []
    for rank, merge in enumerate(content["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs.setdefault(symbols[left] << 32 | symbols[right], rank)
        made.append(symbols.setdefault(left + right, len(symbols)))
    special = sorted((t["content"] for t in content.get("added_tokens", ())), key=len, reverse=True)
    return Merges(pairs, made, tuple(special))


def count_piece(symbols: list[int], merges: Merges) -> int:
    """Tokens of a piece given as its bytes."""
    rank_of, made, n = merges.pairs.get, merges.made, len(symbols)
    after = _NUMBERS[2 : n + 2] if n < 255 else list(range(1, n + 1))
    before = _NUMBERS[: n + 1] if n < 255 else list(range(-1, n))
    ranks = [rank_of(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
    ranks.append(-1)
    heap = [r << 32 | k for k, r in enumerate(ranks) if r >= 0]
    heapq.heapify(heap)
    left = n
    while heap:
        entry = heapq.heappop(heap)
        rank, k = entry >> 32, entry & 0xFFFFFFFF
        if ranks[k] != rank:  # merged away or paired otherwise since
            continue
        symbols[k] = made[rank]
        gone = after[k]
        after[k] = follower = after[gone]
        ranks[gone] = -2
        left -= 1
        if follower < n:
            before[follower] = k
            ranks[k] = new = rank_of(symbols[k] << 32 | symbols[follower], -1)
            if new >= 0:
                heapq.heappush(heap, new << 32 | k)
        else:
            ranks[k] = -1
        if (p := before[k]) >= 0:
            ranks[p] = new = rank_of(symbols[p] << 32 | symbols[k], -1)
            if new >= 0:
                heapq.heappush(heap, new << 32 | p)
    return left


class Counter(dict):
    """Token counts of pieces, made when first asked for."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges
        self.latin, self.any = re.compile(latin_pieces()).findall, regex.compile(PIECES).findall
        self.special = regex.compile("|".join(map(regex.escape, merges.special))) if merges.special else None

    def __missing__(self, piece: str) -> int:
        if len(self) >= KEPT_PIECES:
            self.clear()
        count = count_piece(list(piece.encode("utf-8", "surrogatepass")), self.merges)
        if len(piece) < 64:
            self[piece] = count
        return count

    def pieces(self, text: str) -> list[str]:
        return self.any(text) if _BEYOND.search(text) else self.latin(text)

    def count(self, text: str) -> int:
        """Tokens of a text; each of the tokenizer's special strings in it is one token."""
        if self.special is None or not self.special.search(text):
            return sum(map(self.__getitem__, self.pieces(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(p))) for p in parts)


def token_counts(documents: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    ``vocabulary`` is the path of a byte-level vocabulary file, read on the driver and broadcast (its size is the file's). NULL
    and empty texts have 0 bytes and 0 tokens; texts are counted whole. Repeated rows and NULL doc_ids give one row each. Other
    columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(load_merges(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in small_batches(batches, "text", 4 << 20):
            counts = [counter.count(t.as_py() or "") for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = documents.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    id_type = documents.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
