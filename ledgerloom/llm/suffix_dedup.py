"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. Every string of that length (a window) has an
anchor: the smallest hash among its GRAM-byte grams. Equal windows have equal anchors at the same offset, so windows whose anchor
gram occurs once in the corpus are unique, and equal windows meet when text is dealt out by anchor. What is dealt out are contexts:
the bytes of consecutive windows of one anchor, copies of a context once, with their number.

Shards of contexts get a suffix array by Larsson-Sadakane refinement and common prefixes by Kasai's method; a run of suffixes with
``length`` common bytes is a repeated window. An anchor with more contexts than a shard holds is cut into several; their windows are
merged afterwards by binary search over sorted keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, small_batches
from ledgerloom.llm.hashing import Spans

LENGTH = 200
GRAM = 48
#: Bytes of contexts per suffix array.
SHARD_BYTES = 1 << 21
#: Window starts handled at once; longer texts are handled in pieces, with the same anchors.
PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def contexts(data: np.ndarray, doc_start: np.ndarray, doc_len: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Contexts of texts that lie one after the other: number of the text, anchor hash, context hash, first window (in the text),
    number of windows. ``data`` holds at most 2 ** 24 bytes."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, none
    spans, other = Spans(data), Spans(data, second=True)
    at = np.arange(len(data) - gram + 1)
    grams = spans.hashes(at, at + gram)
    anchor = (sliding_minimum((grams & ~_PLACE) | at.astype(np.uint64), length - gram + 1) & _PLACE).astype(np.int64)
    edge = np.zeros(len(anchor) + 1, dtype=np.int32)  # windows lie within one text
    fits = doc_len >= length
    np.add.at(edge, doc_start[fits], 1)
    np.add.at(edge, doc_start[fits] + doc_len[fits] - length + 1, -1)
    inside = np.cumsum(edge[:-1]) > 0
    opens = np.zeros(len(anchor), dtype=bool)
    opens[doc_start[fits]] = True
    opens[1:] |= anchor[1:] != anchor[:-1]
    opens &= inside
    first = np.flatnonzero(opens)
    ends = inside & ~np.concatenate([inside[1:] & ~opens[1:], [False]])
    last = np.flatnonzero(ends)
    doc = np.searchsorted(doc_start, first, side="right") - 1
    whole = other.hashes(first, last + length)
    return doc, grams[anchor[first]].view(np.int64), whole.view(np.int64), first - doc_start[doc], last - first + 1


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchor and context hashes of documents; place is first window << 8 | windows - 1."""

        def made(rows: list[int], texts: list[bytes], offsets: list[int]) -> pa.RecordBatch:
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            doc, anchor, context, first, n = contexts(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes, length)
            at = np.array(offsets, dtype=np.int64)[doc] + first
            return pa.record_batch([pa.array(anchor), pa.array(context), pa.array(np.array(rows, dtype=np.int64)[doc]), pa.array(at << 8 | (n - 1))], names=["anchor", "context", "row", "place"])

        for batch in small_batches(batches, "text", 4 << 20):
            rows, texts, offsets, size = [], [], [], 0
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                for start in range(0, max(0, len(data) - length) + 1, PIECE):
                    piece = data[start : start + PIECE + length - 1]
                    if size and size + len(piece) > PIECE:
                        yield made(rows, texts, offsets)
                        rows, texts, offsets, size = [], [], [], 0
                    if len(piece) >= length:
                        rows.append(row)
                        texts.append(piece)
                        offsets.append(start)
                        size += len(piece)
            if texts:
                yield made(rows, texts, offsets)

    return run


def packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    x = padded.astype(np.uint64)
    for width in (1, 2, 4):
        x = (x[: len(x) - width] << np.uint64(8 * width)) | x[width:]
    return x[: len(data)]


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the place of each in it.

    Larsson-Sadakane: suffixes are sorted by their first eight bytes; groups that are still equal after h bytes are refined by the
    rank of the suffix h bytes further on, and h doubles. Suffixes that stand alone are never touched again.
    """
    n = len(data)
    key = packed(data)
    order = np.argsort(key, kind="stable").astype(np.int64)
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))  # a group is named by its first place
    rank = np.empty(n + 1, dtype=np.int64)
    rank[order] = group
    rank[n] = -1
    alone = fresh & np.concatenate([fresh[1:], [True]])
    left = np.flatnonzero(~alone)
    h = 8
    while len(left):
        suffixes = order[left]
        second = rank[np.minimum(suffixes + h, n)] + 1
        both = (rank[suffixes].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        by = np.argsort(both, kind="stable")
        suffixes, both = suffixes[by], both[by]
        order[left] = suffixes
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        rank[suffixes] = np.maximum.accumulate(np.where(fresh, left, 0))
        alone = fresh & np.concatenate([fresh[1:], [True]])
        left = left[~alone]
        h *= 2
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(data: np.ndarray, order: np.ndarray, place: np.ndarray, most: int = LENGTH, lane: int = 512) -> np.ndarray:
    """Common bytes, ``most`` at most, of each suffix in the order and the one before it, by Kasai's method.

    From one place of the text to the next a common prefix shrinks by one at most. The text is cut into lanes that go through
    their places side by side; in a turn, each lane goes on comparing or moves on to its next place.
    """
    n = len(data)
    eight = np.concatenate([packed(data), np.zeros(most + 8, dtype=np.uint64)])
    one = np.concatenate([data, np.zeros(most + 8, dtype=np.uint8)])
    before = np.full(n + 1, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, dtype=np.int64)
    p = np.arange(0, n, lane, dtype=np.int64)
    stop = np.minimum(p + lane, n)
    h = np.zeros(len(p), dtype=np.int64)
    while len(p):
        q = before[p]
        some = q >= 0
        a, b = p + h, np.where(some, q, 0) + h
        room = n - np.maximum(a, b)
        by_eight = some & (eight[a] == eight[b]) & (h + 8 <= most) & (room >= 8)
        by_one = some & ~by_eight & (one[a] == one[b]) & (h < most) & (room >= 1)
        done = ~(by_eight | by_one)
        h += by_eight * 8 + by_one
        at = p[done]
        out[place[at]] = np.where(some[done], h[done], 0)
        p[done] += 1
        h[done] = np.maximum(h[done] - 1, 0)
        if done.any() and (p >= stop).any():
            goes = p < stop
            p, h, stop = p[goes], h[goes], stop[goes]
    return out


def repeated_windows(parts: list[bytes], copies: np.ndarray, length: int = LENGTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each context its windows' total number of occurrences within the parts, and the number of the run each belongs to."""
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    order, place = suffix_array(data)
    run = np.cumsum(common_prefixes(data, order, place, length) < length)
    n = sizes - length + 1
    part = np.repeat(np.arange(len(parts)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + starts[part]
    runs = run[place[at]]
    total = np.bincount(runs, weights=copies[part])[runs].astype(np.int64)
    edges = np.cumsum(n)[:-1]
    return list(zip(np.split(total, edges), np.split(runs, edges), strict=True))


def _ranges(repeated: np.ndarray) -> tuple[list[int], list[int]]:
    change = np.flatnonzero(np.diff(repeated.astype(np.int8), prepend=0, append=0))
    return change[0::2].tolist(), change[1::2].tolist()


_SHARD_SCHEMA = "anchor long, context long, first array<int>, stop array<int>, key_a long, key_b long, number long, window int"


def _shards(length: int, shard_bytes: int):
    names = ["anchor", "context", "first", "stop", "key_a", "key_b", "number", "window"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def solved(rows: list[tuple[int, int, int, bytes]], cut_anchor: int | None) -> pa.RecordBatch:
        """Repeated windows of each context; for the anchor that is cut into several shards, one key for each distinct window."""
        out: list[tuple] = []
        found = repeated_windows([r[3] for r in rows], np.array([r[2] for r in rows]), length)
        for (anchor, context, _, data), (total, runs) in zip(rows, found, strict=True):
            first, stop = _ranges(total > 1)
            if first:
                out.append((anchor, context, first, stop, None, None, None, None))
            if anchor == cut_anchor:
                symbols = np.frombuffer(data, dtype=np.uint8)
                at = np.arange(len(total))
                a, b = (Spans(symbols, second=s).hashes(at, at + length).view(np.int64).tolist() for s in (False, True))
                out += [(anchor, context, None, None, *x) for x in zip(a, b, total.tolist(), at.tolist(), strict=True)]
        if cut_anchor is not None:  # one row stands for all windows of a run
            seen: set[tuple[int, int]] = set()
            out = [r for r in out if r[4] is None or not ((r[4], r[5]) in seen or seen.add((r[4], r[5])))]
        return pa.record_batch([pa.array([r[c] for r in out], k) for c, k in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, bytes]] = []
        size, cut_anchor = 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "context", "copies", "bytes")]
            for row in zip(*columns, strict=True):
                if rows and row[:2] == rows[-1][:2]:
                    continue
                if size > shard_bytes:
                    if row[0] != rows[-1][0]:  # whole anchors
                        yield solved(rows, cut_anchor)
                        rows, size, cut_anchor = [], 0, None
                    elif rows[0][0] != row[0]:  # whole anchors, and the begun one anew
                        keep = next(k for k, r in enumerate(rows) if r[0] == row[0])
                        yield solved(rows[:keep], cut_anchor)
                        rows, cut_anchor = rows[keep:], None
                        size = sum(len(r[3]) for r in rows)
                    else:  # one anchor fills a shard
                        cut_anchor = row[0]
                        yield solved(rows, cut_anchor)
                        rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield solved(rows, cut_anchor)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of windows sorted by key_a and key_b: windows single in their shard that another shard has as well."""
    held: pa.Table | None = None

    def merged(t: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
        a, b, number = (t.column(c).to_numpy() for c in ("key_a", "key_b", "number"))
        end = len(a) if last else int(np.searchsorted(a, a[-1], side="left"))
        lowest, highest = np.searchsorted(a, a[:end], side="left"), np.searchsorted(a, a[:end], side="right")
        sums = np.concatenate([[0], np.cumsum(number)])
        total = sums[highest] - sums[lowest]
        mixed_keys = np.flatnonzero((highest - lowest > 1) & (b[lowest] != b[np.minimum(highest, len(b)) - 1]))
        for k in mixed_keys:  # two windows under one first key
            total[k] = number[lowest[k] : highest[k]][b[lowest[k] : highest[k]] == b[k]].sum()
        out = t.slice(0, end).select(["anchor", "context", "window"]).filter(pa.array((number[:end] == 1) & (total > 1)))
        return out.combine_chunks().to_batches()[0] if out.num_rows else pa.record_batch([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in out.columns], names=out.column_names), t.slice(end)

    for batch in batches:
        if batch.num_rows:
            t = pa.Table.from_batches([batch])
            out, held = merged(pa.concat_tables([held, t]) if held is not None else t, False)
            yield out
    if held is not None and held.num_rows:
        yield merged(held, True)[0]


def _cut_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The wanted contexts of texts, as bytes."""
        for batch in small_batches(batches, "text", 4 << 20):
            out: list[list] = [[], [], [], []]
            for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist(), strict=True):
                data = text.as_buffer().to_pybytes()
                for w in wanted:
                    first = w["place"] >> 8
                    for column, value in zip(out, (w["anchor"], w["context"], w["copies"], data[first : first + (w["place"] & 255) + length]), strict=True):
                        column.append(value)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["anchor", "context", "copies", "bytes"])

    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the given byte ranges taken out."""
    for batch in small_batches(batches, "text", 4 << 20):
        out: list[list] = [[], [], [], [], []]
        for text, ranges in zip(batch.column("text"), batch.column("ranges").to_pylist(), strict=True):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            kept, spans, at, removed = [], [], 0, 0
            for r in sorted((r["first"], r["stop"]) for r in ranges or ()):
                if spans and r[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], r[1])
                else:
                    spans.append([r[0], r[1]])
            for first, stop in spans:
                kept.append(data[at:first])
                removed += stop - first
                at = stop
            rest = b"".join([*kept, data[at:]])
            for column, value in zip(out, (len(data), removed, len(spans), hashlib.sha256(rest).hexdigest(), rest), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def without_repeats(documents: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (remaining bytes).

    Texts are UTF-8 bytes; NULL counts as empty. Matches never cross documents, but may lie in one document and overlap. Identical
    rows are separate documents and repeat each other. Rows without doc_id are documents like others. Other columns are ignored;
    an empty table gives no rows. Anchors and contexts are told apart by 64-bit hashes each, windows by their bytes. ``length`` is
    above GRAM and at most GRAM + 255.
    """
    docs = documents.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    anchors = docs.select("row", "text").mapInArrow(_anchors(length), "anchor long, context long, row long, place long")
    again = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    found = cut(anchors.join(again, "anchor"))

    distinct = found.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "place")).alias("at"))
    wanted = distinct.select("at.row", F.struct("anchor", "context", "copies", F.col("at.place").alias("place")).alias("w")).groupBy("row").agg(F.collect_list("w").alias("wanted"))
    texts = wanted.join(docs, "row")
    pieces = texts.mapInArrow(_cut_out(length), "anchor long, context long, copies long, bytes binary")
    # Identical rows give their contexts more than once; they stand next to each other.
    dealt = pieces.repartition("anchor").sortWithinPartitions("anchor", "context")
    solved = cut(dealt.mapInArrow(_shards(length, shard_bytes), _SHARD_SCHEMA))

    keys = solved.where("key_a is not null").select("anchor", "context", "key_a", "key_b", "number", "window")
    merged = keys.repartition("key_a").sortWithinPartitions("key_a", "key_b").mapInArrow(_merge, "anchor long, context long, window int")
    own = solved.where("first is not null").select("anchor", "context", F.inline(F.arrays_zip("first", "stop")))
    ranges = own.unionByName(merged.select("anchor", "context", F.col("window").alias("first"), (F.col("window") + 1).alias("stop")))
    start = F.shiftright("place", 8)
    in_rows = found.join(ranges, ["anchor", "context"]).select("row", F.struct((start + F.col("first")).alias("first"), (start + F.col("stop") + (length - 1)).alias("stop")).alias("r"))
    in_rows = in_rows.groupBy("row").agg(F.collect_set("r").alias("ranges"))
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return docs.join(in_rows, "row", "left").mapInArrow(_without, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
