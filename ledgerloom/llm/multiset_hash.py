"""Document fingerprints that add up: a homomorphic hash of the multiset of a text's paragraphs.

Every paragraph (a line) is hashed to a wide vector, and a text's fingerprint is the sum of its paragraphs' vectors, lane by lane,
modulo powers of two. So the order of paragraphs does not matter, equal multisets have equal fingerprints, and a paragraph is
inserted or deleted by adding or subtracting its vector, without the rest of the text.

A vector has two parts. Four lanes of 64 bits hold a cryptographic hash of the paragraph's bytes: they tell texts apart. 256 lanes of
16 bits hold plus or minus one for each two-word sequence in the paragraph, at a lane its hash gives: their sums keep the inner
products of the counts on average, so two fingerprints tell how much their texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, small_batches
from ledgerloom.llm.hashing import Texts, chunks, mixed

#: Lanes of 16 bits that tell likeness, and of 64 bits that tell texts apart.
LIKENESS_LANES, EXACT_LANES = 256, 4
#: Bytes of a fingerprint; of one whose lanes of 16 bits all lie within -128 to 127 too, since these are then written as one byte each.
WIDTH, SHORT = 2 * LIKENESS_LANES + 8 * EXACT_LANES, LIKENESS_LANES + 8 * EXACT_LANES


def _exact(texts: list[str]) -> np.ndarray:
    """Sums of the paragraphs' hashes modulo 2**64."""
    parts = [t.encode("utf-8", "surrogatepass").split(b"\n") for t in texts]
    digest = b"".join(hashlib.blake2b(p, digest_size=8 * EXACT_LANES).digest() for some in parts for p in some)
    of_paragraph = np.frombuffer(digest, dtype="<u8").reshape(-1, EXACT_LANES)
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]]).astype(np.int64)
    return np.add.reduceat(of_paragraph, first, axis=0, dtype=np.uint64)


def _likeness(texts: list[str]) -> np.ndarray:
    """Sums of plus or minus one, modulo 2**16. A paragraph of one word counts that word."""
    t = Texts(texts)
    doc, start, end = t.words()
    if not len(doc):
        return np.zeros((len(texts), LIKENESS_LANES), dtype=np.uint16)
    word = t.hashes(start, end)
    line = np.cumsum(t.symbols == 10)[start]
    with_next = np.concatenate([line[1:] == line[:-1], [False]])
    alone = ~with_next & np.concatenate([[True], ~with_next[:-1]])
    following = np.roll(word, -1)
    h = np.where(with_next, mixed(word * np.uint64(0x9E3779B97F4A7C15) + following), mixed(word))
    counts = with_next | alone
    h, doc = h[counts], doc[counts]
    sign = np.where(h >> np.uint64(63) == 1, 1.0, -1.0)
    lane = doc * LIKENESS_LANES + ((h >> np.uint64(20)) % np.uint64(LIKENESS_LANES)).astype(np.int64)
    sums = np.bincount(lane, weights=sign, minlength=len(texts) * LIKENESS_LANES).astype(np.int64)
    return sums.astype(np.uint16).reshape(len(texts), LIKENESS_LANES)


class Fingerprints:
    """Fingerprints of several texts, one a row."""

    def __init__(self, likeness: np.ndarray, exact: np.ndarray):
        self.likeness, self.exact = likeness, exact

    @classmethod
    def of(cls, texts: list[str]) -> Fingerprints:
        like, exact = [np.zeros((0, LIKENESS_LANES), dtype=np.uint16)], [np.zeros((0, EXACT_LANES), dtype=np.uint64)]
        for _, some in chunks(texts):
            like.append(_likeness(some))
            exact.append(_exact(some))
        return cls(np.concatenate(like), np.concatenate(exact))

    @classmethod
    def read(cls, data: list[bytes]) -> Fingerprints:
        like = np.zeros((len(data), LIKENESS_LANES), dtype=np.uint16)
        for k, row in enumerate(data):
            like[k] = np.frombuffer(row, dtype="i1" if len(row) == SHORT else "<i2", count=LIKENESS_LANES).astype(np.int16).view(np.uint16)
        exact = b"".join(row[-8 * EXACT_LANES :] for row in data)
        return cls(like, np.frombuffer(exact, dtype="<u8").reshape(-1, EXACT_LANES).astype(np.uint64))

    def __len__(self) -> int:
        return len(self.exact)

    def __getitem__(self, rows) -> Fingerprints:
        return Fingerprints(self.likeness[rows], self.exact[rows])

    def __add__(self, other: Fingerprints) -> Fingerprints:
        """With the other's paragraphs inserted."""
        return Fingerprints(self.likeness + other.likeness, self.exact + other.exact)

    def __sub__(self, other: Fingerprints) -> Fingerprints:
        """With the other's paragraphs deleted."""
        return Fingerprints(self.likeness - other.likeness, self.exact - other.exact)

    def bytes(self) -> list[bytes]:
        lanes = self.likeness.view(np.int16)
        short = (np.abs(lanes.astype(np.int32) * 2 + 1) <= 255).all(axis=1)
        return [row.astype("i1" if one else "<i2").tobytes() + exact.astype("<u8").tobytes() for row, one, exact in zip(lanes, short, self.exact, strict=True)]

    def same(self, other: Fingerprints) -> np.ndarray:
        return (self.likeness == other.likeness).all(axis=1) & (self.exact == other.exact).all(axis=1)

    def like(self, other: Fingerprints) -> np.ndarray:
        """1 for equal fingerprints, otherwise twice the inner product of the counts over the sum of their squares, estimated."""
        a, b = (x.likeness.astype(np.int16).astype(np.float64) for x in (self, other))
        common, both = (a * b).sum(axis=1), (a * a).sum(axis=1) + (b * b).sum(axis=1)
        estimate = np.clip(2 * common / np.where(both > 0, both, 1), 0.0, 1.0)
        return np.where(self.same(other), 1.0, estimate)


def edited_text(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [f.split()[0] for f in _RESULT.split(", ")]


def _rows(ids: list, texts: list[str], prints: Fingerprints, following: list[str], next_prints: Fingerprints) -> dict[str, pa.Array]:
    edits = [edited_text(a, b) for a, b in zip(texts, following, strict=True)]
    edited = Fingerprints.of(edits)
    return {
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edits], pa.string()),
        "fingerprint": pa.array(prints.bytes(), pa.binary()), "edited_fingerprint": pa.array(edited.bytes(), pa.binary()),
        "near_edited": pa.array(prints.like(edited)), "near_next": pa.array(prints.like(next_prints)),
    }


#: What a row of a sorted partition is: a finished document, the partition's first document, or its last.
DONE, HEAD, TAIL = 0, 1, 2


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their successors, in a partition sorted by doc_id; its first and last document as they are, for the neighbours."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    last: tuple | None = None

    def edge(kind: int, doc_id, text: str) -> pa.RecordBatch:
        none = {f.split()[0]: pa.nulls(1, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}[f.split()[1]]) for f in _RESULT.split(", ")}
        return pa.RecordBatch.from_pydict(none | {"doc_id": pa.array([doc_id], pa.int64()), "kind": pa.array([kind], pa.int32()), "part": pa.array([part], pa.int32()), "text": pa.array([text], pa.string())})

    for batch in small_batches(batches, "text", 2 << 20):
        ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
        prints = Fingerprints.of(texts)
        if last is None:
            yield edge(HEAD, ids[0], texts[0])
        else:
            ids, texts = [last[0], *ids], [last[1], *texts]
            prints = Fingerprints(np.concatenate([last[2].likeness, prints.likeness]), np.concatenate([last[2].exact, prints.exact]))
        if len(ids) > 1:
            done = _rows(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
            n = len(ids) - 1
            yield pa.RecordBatch.from_pydict(done | {"kind": pa.array([DONE] * n, pa.int32()), "part": pa.array([part] * n, pa.int32()), "text": pa.nulls(n, pa.string())})
        last = ids[-1], texts[-1], prints[-1:]
    if last is not None:
        yield edge(TAIL, last[0], last[1])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", 2 << 20):
        texts, following = batch.column("text").to_pylist(), batch.column("next_text").to_pylist()
        yield pa.RecordBatch.from_pydict(_rows(batch.column("doc_id").to_pylist(), texts, Fingerprints.of(texts), following, Fingerprints.of(following)))


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they are: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (hexadecimal), near_edited, near_next.

    The edited text has its last half (rounded down, in code points) replaced by as many code points from the beginning of the next
    document, or by all it has. Documents come in ascending order of doc_id, those without one last; rows of one doc_id in order of
    a hash of their texts, and equal rows follow each other. After the last comes the first, which may be the same. A NULL text is
    empty; two empty texts are alike with 1, an empty and another text with 0. Other columns are ignored; an empty table gives no rows.

    Texts are shuffled once, into sorted ranges; only the first and the last document of each range meet those of other ranges.
    """
    spark = documents.sparkSession
    order = [F.col("doc_id").asc_nulls_last(), F.col("_hash").asc(), F.col("_place").asc()]
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns({"_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
    ranges = docs.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    found = cut(ranges.mapInArrow(_in_order, f"{_RESULT}, kind int, part int, text string"))
    # One number for each range.
    parts = [r.part for r in found.where(F.col("kind") == HEAD).select("part").orderBy("part").collect()]
    successors = spark.createDataFrame([(p, parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)], "part int, next_part int")
    heads = found.where(F.col("kind") == HEAD).select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    tails = found.where(F.col("kind") == TAIL).select("part", "doc_id", "text")
    ends = tails.join(successors, "part").join(heads, "next_part").select("doc_id", "text", "next_text").mapInArrow(_pairs, _RESULT)
    rows = found.where(F.col("kind") == DONE).select(*_NAMES).unionByName(ends)
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def combined(fingerprints: DataFrame, by: list[str]) -> DataFrame:
    """The fingerprint of all paragraphs of each group's texts together, from the texts' ``fingerprint`` (hexadecimal) alone.

    Sums are formed in the tasks first, so that a group of any size sends one row a task.
    """
    names = list(by)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fingerprints.schema.fields if f.name in names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, Fingerprints] = {}
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in names), strict=True))
            prints = Fingerprints.read([bytes.fromhex(x) for x in batch.column("fingerprint").to_pylist()])
            where: dict[tuple, list[int]] = {}
            for k, key in enumerate(keys):
                where.setdefault(key, []).append(k)
            for key, rows in where.items():
                some = Fingerprints(prints.likeness[rows].sum(axis=0, dtype=np.uint16)[None], prints.exact[rows].sum(axis=0, dtype=np.uint64)[None])
                sums[key] = sums[key] + some if key in sums else some
        for key, some in sums.items():
            yield pa.RecordBatch.from_pydict({c: pa.array([v]) for c, v in zip(names, key, strict=True)} | {"fingerprint": pa.array([some.bytes()[0].hex()])})

    rows = fingerprints.where(F.col("fingerprint").isNotNull()).select(*names, "fingerprint")
    partial = rows.mapInArrow(add, f"{fields}, fingerprint string")
    return partial.repartition(*names).mapInArrow(add, f"{fields}, fingerprint string")
