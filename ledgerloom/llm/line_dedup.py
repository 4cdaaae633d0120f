"""Line deduplication by a segment-partition edit join.

Two lines within ``edits`` edits of each other share one of edits + 1 segments, at nearly the same place. Every distinct line
indexes its own segments by length and number, and probes the substrings that a shorter or equally long line's segments could
match. Lines that meet are filtered by a parity signature of their characters and verified by banded bit-parallel edit distance.

Copies of a line are one entry of the join, whatever their number. Lines that meet under a key are compared where they meet, in a
grid of blocks if they are many, and only each line's number of links leaves the block: no pair ever becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, give_back, gives_back, slices, small_batches
from ledgerloom.llm.hashing import Spans, Texts, chunks, mixed

EDITS = 2
#: Shorter lines (in code points) are never compared with different ones: two edits in a short line make another line.
LEAST_CHARS = 24
#: Up to so many entries under one key are looked at before they are sent on; groups of more than BLOCK are dealt out in blocks.
SMALL_GROUP = 48
BLOCK = 1_024
#: The bits of a key that count: the zeros take no room in shuffles, and lines that meet by chance are told apart by their edits.
KEY_BITS = np.uint64(0xFFFFFFFFFFFF0000)
#: Lines a task remembers, not to send keys of the same line again; when there are more, it begins anew.
REMEMBERED = 200_000


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits (insertion, deletion, replacement) between two strings, or most + 1 if there are more.

    Common ends are cut off. Column by column, the differences between vertical neighbours are kept as bits, for the band of
    ``most`` cells on either side of the diagonal only: the window of bits moves down by one row with every column.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    start = 0
    while start < len(a) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(a) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    rows: dict[str, int] = {}
    for i, c in enumerate(a):
        rows[c] = rows.get(c, 0) | 1 << i
    width = 2 * most + 1
    band, top = (1 << width) - 1, 1 << (width - 1)
    plus, minus = band >> (most + 1) << (most + 1), 0  # column 0: rows above the first one differ by 0, others by +1
    lowest = 0  # value of the window's lowest row
    for j, c in enumerate(b):
        plus, minus = plus >> 1 | top, minus >> 1
        eq = rows.get(c, 0)
        eq = (eq >> (j - most) if j >= most else eq << (most - j)) & band
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        rises = (minus | ~(horizontal | plus)) << 1 | 1
        falls = (plus & horizontal) << 1
        plus = (falls | ~(vertical | rises)) & band
        minus = rises & vertical & band
        lowest += 1 + (plus & 1) - (minus & 1)
    above = (2 << (len(a) - len(b) + most)) - 2
    return min(most + 1, lowest + (plus & above).bit_count() - (minus & above).bit_count())


def segments(length: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment i (from 0) of lines of the given lengths: even sizes, the longer ones last."""
    n = edits + 1
    size, longer = length // n, length % n
    return i * size + np.maximum(0, i - (n - longer)), size + (i >= n - longer)


def line_keys(spans: Spans, start: np.ndarray, length: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(line numbers, keys, kind) of index entries (kind 0) and probes (kind 1) of the lines.

    Probes that equal an index entry of the line itself are left out, as index entries also meet one another.
    """
    lines, out = np.arange(len(start)), []
    for shorter in range(edits + 1):
        of = lines[length - shorter >= LEAST_CHARS]
        other = length[of] - shorter
        for i in range(edits + 1):
            place, size = segments(other, i, edits)
            tag = (other * 16 + i).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            # Where a line with at most `edits` edits can hold the segment, seen from its left and from its right end.
            least = max(-i, shorter - (edits - i))
            most = min(i, shorter + (edits - i))
            for shift in range(least, most + 1):
                at = place + shift
                fits = (at >= 0) & (at + size <= length[of])
                key = mixed(spans.hashes(start[of][fits] + at[fits], start[of][fits] + at[fits] + size[fits]) ^ tag[fits]) & KEY_BITS
                out.append((of[fits], key, 0 if shorter == 0 and shift == 0 else 1))
    return out


def _signatures(t: Texts, start: np.ndarray, chosen: np.ndarray) -> list[np.ndarray]:
    """128 bits of the chosen lines, in two halves: each tells whether the characters that fall on it are an odd number."""
    bit = (t.symbols.astype(np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(20) & np.uint64(127)
    one = np.uint64(1) << (bit & np.uint64(63))
    return [np.bitwise_xor.reduceat(np.where(bit >> np.uint64(6) == half, one, np.uint64(0)), start)[chosen] if len(start) else one[:0] for half in (0, 1)]


def _occurrences(least_copy: int, described: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compared lines of documents, and shorter ones that count as copies: their place and two hashes; if described, length and parity signature too."""
        for batch in small_batches(batches, "text", 4 << 20):
            ids, copies, texts = (batch.column(c) for c in ("doc_id", "copy", "text"))
            for at, some in chunks(texts.to_pylist()):
                t = Texts(some, wide=True)
                doc, start, end = t.lines()
                first = np.searchsorted(doc, np.arange(len(some)))
                number = np.arange(len(doc)) - first[doc]
                dark = (t.symbols != 32) & ((t.symbols < 9) | (t.symbols > 13))
                dark = np.logical_or.reduceat(dark, start) if len(start) else dark[:0]
                chosen = np.flatnonzero((end - start >= LEAST_CHARS) | ((end - start >= least_copy) & dark))
                signs: list[np.ndarray] = []
                if described:
                    signs = _signatures(t, start, chosen)
                doc, start, end, number = doc[chosen], start[chosen], end[chosen], number[chosen]
                take = pa.array(at + doc)
                line = t.hashes(start, end) >> np.uint64(1)
                check = Spans(t.symbols, second=True).hashes(start, end)
                yield pa.record_batch(
                    [ids.take(take), copies.take(take), pa.array(number, pa.int32()), pa.array(line.astype(np.int64)), pa.array(check.view(np.int64)),
                     *([pa.array((end - start).astype(np.int32))] if described else []), *(pa.array(s.view(np.int64)) for s in signs)],
                    names=["doc_id", "copy", "line_no", "line", "check", "chars", "sign_a", "sign_b"][: 8 if described else 5],
                )

    return run


def _keys(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Index entries and probes of the lines a task has not seen yet: key, and line << 1 | kind."""
        seen: set[int] = set()
        for batch in small_batches(batches, "text", 4 << 20):
            for _, some in chunks(batch.column("text").to_pylist()):
                t = Texts(some, wide=True)
                _, start, end = t.lines()
                chosen = end - start >= LEAST_CHARS
                start, end = start[chosen], end[chosen]
                line, first = np.unique(t.hashes(start, end) >> np.uint64(1), return_index=True)
                fresh = np.fromiter((x not in seen for x in line.tolist()), dtype=bool, count=len(line))
                line, first = line[fresh], first[fresh]
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen.update(line.tolist())
                spans = Spans(t.symbols)
                for of, key, kind in line_keys(spans, start[first], (end - start)[first], edits):
                    yield pa.record_batch([pa.array(key.view(np.int64)), pa.array((line[of] << np.uint64(1) | np.uint64(kind)).view(np.int64))], names=["key", "entry"])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries under one key, sorted by key and entry: those of groups in which different lines meet, once each."""

    def out(key: np.ndarray, entry: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(key), pa.array(entry)], names=["key", "entry"])

    none = np.zeros(0, dtype=np.int64)
    held_key, held = none, none  # the group that may go on in the next batch
    large = None  # key of a group that is already known to be large
    for batch in batches:
        key = np.concatenate([held_key, batch.column("key").to_numpy()])
        entry = np.concatenate([held, batch.column("entry").to_numpy()])
        if not len(key):
            continue
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (entry[1:] != entry[:-1])])
        key, entry = key[fresh], entry[fresh]
        first = np.flatnonzero(np.diff(key, prepend=~key[:1]) != 0)
        size = np.diff(np.append(first, len(key)))
        goes = size > SMALL_GROUP
        for k in np.flatnonzero((size[:-1] > 1) & ~goes[:-1]).tolist():
            some = entry[first[k] : first[k] + size[k]]
            goes[k] = not (some & 1).all() and not (some >> 1 == some[0] >> 1).all()
        if large is not None:
            goes |= key[first] == large
        chosen = np.repeat(goes, size)
        yield out(key[chosen], entry[chosen])
        last = slice(first[-1], None)
        if goes[-1]:
            large, held_key, held = key[-1], none, none
        else:
            held_key, held = key[last], entry[last]
    if len(np.unique(held >> 1)) > 1 and not (held & 1).all():
        yield out(held_key, held)


def _own_keys(text: str, edits: int) -> dict[int, int]:
    """The keys of a line, each with the smallest kind the line has under it."""
    t = Texts([text], wide=True)
    found: dict[int, int] = {}
    for _, key, kind in line_keys(Spans(t.symbols), t.starts, t.lengths, edits):
        for k in key.view(np.int64).tolist():
            found[k] = min(kind, found.get(k, 1))
    return found


class _Blocks:
    """Counts the links of lines in blocks of the grid, and how many of them lead to earlier lines.

    Lines that meet under several keys are counted under the smallest one, so a pair never has to become a row.
    """

    def __init__(self, edits: int):
        self.edits = edits
        self.known: dict[int, tuple[str, dict[int, int]]] = {}

    def count(self, t: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        column = {c: t.column(c).to_numpy() for c in ("key", "line", "kind", "chars", "side", "copy", "line_no")}
        sign = np.stack([t.column("sign_a").to_numpy(), t.column("sign_b").to_numpy()], axis=1).view(np.uint64)
        ids, texts = t.column("doc_id").to_pylist(), t.column("line_text").combine_chunks()
        line, kind, chars, side = (column[c] for c in ("line", "kind", "chars", "side"))
        links: dict[int, list[int]] = {}

        def place(k: int) -> tuple:
            return ids[k], column["copy"][k], column["line_no"][k]

        def keys_of(k: int) -> tuple[str, dict[int, int]]:
            own = self.known.get(int(line[k]))
            if own is None:
                if len(self.known) > 20_000:
                    self.known.clear()
                text = texts[k].as_py()
                own = self.known[int(line[k])] = text, _own_keys(text, self.edits)
            return own

        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            key = int(column["key"][start])
            right = start + np.flatnonzero(side[start:end] != 0)
            for i in (start + np.flatnonzero(side[start:end] != 1)).tolist():
                some = right[right > i] if side[i] == 2 else right  # in a corner both sides hold the same lines
                near = (np.abs(chars[some] - chars[i]) <= self.edits) & (line[some] != line[i]) & ((kind[some] == 0) | (kind[i] == 0))
                some = some[near]
                for j in some[np.bitwise_count(sign[some] ^ sign[i]).sum(axis=1) <= 2 * self.edits].tolist():
                    (a, of_a), (b, of_b) = keys_of(i), keys_of(j)
                    if min(k for k in of_a.keys() & of_b.keys() if of_a[k] == 0 or of_b[k] == 0) == key and edit_distance(a, b, self.edits) <= self.edits:
                        later = i if place(j) < place(i) else j
                        for k in (i, j):
                            n = links.setdefault(int(line[k]), [0, 0])
                            n[0] += 1
                            n[1] += k == later
        counts = list(links.values())
        return pa.record_batch([pa.array(list(links), pa.int64()), *(pa.array([n[k] for n in counts], pa.int64()) for k in (0, 1))], names=["line", "n_links", "n_earlier"])


def _count_blocks(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks in order of (key, p, q), one after the other."""
        blocks, held = _Blocks(edits), None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            cell = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("key", "p", "q")], axis=1)
            first = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]).any(axis=1)]))
            if len(first) > 1:
                yield blocks.count(t, first)
            held = t.slice(first[-1])
        if held is not None:
            yield blocks.count(held, np.array([0, held.num_rows]))

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", 8 << 20):
        lines, texts = [], []
        for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
            parts = (text.as_py() or "").split("\n")
            for w in wanted.as_py():
                lines.append(w["line"])
                texts.append(parts[w["line_no"]])
        yield pa.record_batch([pa.array(lines, pa.int64()), pa.array(texts, pa.string())], names=["line", "line_text"])


def _identified(documents: DataFrame) -> DataFrame:
    """doc_id, copy and text; copy tells apart the texts that share a doc_id."""
    return documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("copy"), F.coalesce("text", F.lit("")).alias("text"))


def line_classes(documents: DataFrame, edits: int = EDITS, least_copy: int = 1) -> tuple[DataFrame, DataFrame]:
    """(occurrences, lines): every line of every document that is compared or counts as a copy, and every distinct line with its first occurrence and n_earlier,
    the number of distinct lines within ``edits`` edits that occur first before it, and n_links, of all such lines."""
    docs = _identified(documents)
    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, copy long, line_no int, line long, check long"
    # Read twice: with signatures for the distinct lines, and by the caller for the places of those that go.
    occurrences = docs.mapInArrow(gives_back(_occurrences(least_copy, described=False)), schema)
    described = docs.mapInArrow(gives_back(_occurrences(least_copy, described=True)), f"{schema}, chars int, sign_a long, sign_b long")
    place = F.struct("doc_id", "copy", "line_no")
    lines = described.groupBy("line", "check").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("chars", "sign_a", "sign_b")])
    lines = cut(lines)

    keys = docs.mapInArrow(gives_back(_keys(edits)), "key long, entry long")
    met = keys.repartition("key").sortWithinPartitions("key", "entry").mapInArrow(gives_back(_meet), "key long, entry long")
    met = cut(met.groupBy("key", F.shiftrightunsigned("entry", 1).alias("line")).agg(F.min(F.col("entry").bitwiseAND(F.lit(1))).alias("kind")))
    own = lines.select("line", "chars", "sign_a", "sign_b", "first.*").dropDuplicates(["line"])

    wanted = met.select("line").distinct().join(own.select("line", "doc_id", "copy", "line_no"), "line")
    wanted = wanted.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("line", "line_no")).alias("wanted"))
    texts = docs.join(wanted, ["doc_id", "copy"]).select("text", "wanted").mapInArrow(gives_back(_fetch), "line long, line_text string").dropDuplicates(["line"])

    sizes = met.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks"))
    members = met.join(sizes, "key").join(own, "line").join(texts, "line").withColumn("block", F.pmod(F.xxhash64("line"), F.col("n_blocks")).cast("int"))
    # The grid's cells (p, q) with p <= q: a row stands on side 0 of its own row, on side 1 of its own column, on both in the corner.
    cell = F.when(F.col("other") > F.col("block"), F.struct(F.col("block").alias("p"), F.col("other").alias("q"), F.lit(0).alias("side")))
    cell = cell.when(F.col("other") < F.col("block"), F.struct(F.col("other").alias("p"), F.col("block").alias("q"), F.lit(1).alias("side")))
    cell = cell.otherwise(F.struct(F.col("block").alias("p"), F.col("block").alias("q"), F.lit(2).alias("side")))
    columns = ["key", "line", "kind", "chars", "sign_a", "sign_b", "doc_id", "copy", "line_no", "line_text"]
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(*columns, cell.alias("c")).select(*columns, "c.*")
    cells = dealt.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "side", "line")
    counted = cells.mapInArrow(gives_back(_count_blocks(edits)), "line long, n_links long, n_earlier long")
    counts = counted.groupBy("line").agg(F.sum("n_links").alias("n_links"), F.sum("n_earlier").alias("n_earlier"))
    lines = lines.join(counts, "line", "left").fillna(0, ["n_links", "n_earlier"])
    return occurrences, lines.select("line", "check", "first", "n", "n_links", "n_earlier")


def _removed(documents: DataFrame, edits: int, least_copy: int) -> DataFrame:
    """Occurrences to remove: doc_id, copy, line_no, near (true if an earlier line differs, but little), n_links."""
    occurrences, lines = line_classes(documents, edits, least_copy)
    lines = lines.where((F.col("n") > 1) | (F.col("n_links") > 0))
    found = occurrences.select("doc_id", "copy", "line_no", "line", "check").join(lines, ["line", "check"])
    first = F.struct("doc_id", "copy", "line_no") == F.col("first")
    near = F.col("n_earlier") > 0
    return found.select("doc_id", "copy", "line_no", (near & first).alias("near"), (near | ~first).alias("removed"), "n_links")


def deduplicated_lines(documents: DataFrame, edits: int = EDITS, least_copy: int = 1) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, n_near (removed lines that first occur here, because an earlier line is
    within ``edits`` edits), n_links (of its lines, to other distinct lines).

    Lines end at line feeds; those of LEAST_CHARS code points or more are compared as they are. A line goes if it occurred before,
    by doc_id, text hash and line number, or if a line within ``edits`` edits did. Shorter lines of ``least_copy`` code points or
    more go if the same line occurred before, unless they are blank; with 1, no exact copy stays for its length. NULL and empty texts have 0 and 1 lines. Rows
    without doc_id give no row; identical rows are treated alike and count as one occurrence, while different texts under one
    doc_id are separate documents in a fixed order. Other columns are ignored; an empty table gives no rows.
    """
    marks = _removed(documents, edits, least_copy).groupBy("doc_id", "copy").agg(
        F.countDistinct(F.when(F.col("removed"), F.col("line_no"))).alias("n_removed"), F.countDistinct(F.when(F.col("near"), F.col("line_no"))).alias("n_near"),
        F.sum("n_links").alias("n_links"),
    )
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    rows = documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("copy"), n_lines.cast("long").alias("n_lines"))
    return rows.join(marks, ["doc_id", "copy"], "left").fillna(0, ["n_removed", "n_near", "n_links"]).drop("copy")


def without_repeated_lines(documents: DataFrame, edits: int = EDITS, least_copy: int = 1) -> DataFrame:
    """The documents (all columns) with the removed lines taken out of their texts; documents that lose all their text go.

    Rows without doc_id, and NULL and empty texts, stay as they are. See ``deduplicated_lines`` for which lines go.
    """
    marks = _removed(documents, edits, least_copy).where("removed").groupBy("doc_id", "copy").agg(F.collect_set("line_no").alias("gone"))
    marks = marks.withColumnsRenamed({"doc_id": "m_doc_id", "copy": "m_copy", "gone": "m_gone"})
    joined = documents.join(marks, (F.col("doc_id") == F.col("m_doc_id")) & (F.xxhash64("text") == F.col("m_copy")), "left")

    @F.arrow_udf("string")
    def keep(text: pa.Array, gone: pa.Array) -> pa.Array:
        out, at = [pa.array([], pa.string())], 0
        for some in slices(text):
            lines = ((t.as_py() or "").split("\n") for t in some)
            goes = (set(g.as_py() or ()) for g in gone.slice(at, len(some)))
            out.append(pa.array(["\n".join(x for k, x in enumerate(t) if k not in g) for t, g in zip(lines, goes, strict=True)], pa.string()))
            at += len(some)
        give_back()
        return pa.concat_arrays(out)

    text: Column = F.when(F.col("m_gone").isNull(), F.col("text")).otherwise(keep(F.col("text"), F.coalesce("m_gone", F.array().cast("array<int>"))))
    kept = joined.withColumn("text", text).where(F.col("m_gone").isNull() | (F.trim(F.translate("text", "\n\t\r", "   ")) != ""))
    return kept.select(*documents.columns)
