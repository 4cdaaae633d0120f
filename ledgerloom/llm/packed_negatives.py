"""Hard negatives by exact integer products, several of them in one multiplication (Kronecker packing).

Components are whole numbers. A bias makes those of the candidates non-negative, and the components of several candidates are put
side by side as fields of one wide whole number. Multiplied by an anchor's component (biased too) and summed over the dimensions,
each field holds its candidate's sum without touching the next one; the biases are then taken off again. Where two or more fields
fit into the 53 bits that a double holds exactly, the wide numbers are doubles, which BLAS multiplies; otherwise they are Python's
whole numbers of any width.

Anchors go in blocks against shards of all rows, one pair of them at a time in a task. The first round finds each anchor's
positives, the second the negatives between each positive's limits; a shard sends no more rows for each than the result can show.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut

POSITIVES = NEGATIVES = 5
#: A negative scores at least so many percent of its positive, and no more than it.
LEAST_PERCENT = 80
#: A component is the whole part of so many times the vector's.
SCALE = 256
#: Components of a shard and of a block of anchors, and the smallest number of rows worth a shard of its own.
SHARD, BLOCK, LEAST_SHARD_ROWS = 1 << 21, 1 << 18, 1_024
#: Scores worked on at a time in a task.
TILE = 1 << 21
#: Scores beyond these are cut to them, so that a hundredfold still fits 64 bits.
LIMIT = ((1 << 63) - 1) // 100
#: Bits of a double's whole numbers, and of one wide Python number.
DOUBLE_BITS, WIDE_BITS = 53, 1_024


def packed(components: np.ndarray, fields: int, bits: int, wide: bool) -> np.ndarray:
    """Rows of non-negative components, ``fields`` rows to one row of wide numbers with fields of ``bits``."""
    n, d = components.shape
    padded = np.zeros((-(-n // fields) * fields, d), dtype=components.dtype)
    padded[:n] = components
    parts = padded.reshape(-1, fields, d)
    if not wide:
        return (parts << (bits * np.arange(fields, dtype=np.int64))[None, :, None]).sum(axis=1).astype(np.float64)
    out = np.zeros((len(parts), d), dtype=object)
    for k in range(fields):
        out += parts[:, k].astype(object) << (bits * k)
    return out


def unpacked(product: np.ndarray, fields: int, bits: int, n: int) -> np.ndarray:
    """The fields of wide numbers, side by side again."""
    whole = product.astype(np.int64) if product.dtype != object else product
    mask = (1 << bits) - 1
    return np.stack([(whole >> (bits * k)) & mask for k in range(fields)], axis=2).reshape(len(product), -1)[:, :n]


class Packed:
    """Candidates of one length, ready to be multiplied with anchors whose components lie in [low, high]."""

    def __init__(self, candidates: np.ndarray, low: int, high: int):
        self.n, self.d = candidates.shape
        self.low = min(low, 0)
        exact = candidates if candidates.dtype == object else candidates.astype(np.int64)
        self.bias = min(int(candidates.min()), 0) if candidates.size else 0
        most = (int(candidates.max()) - self.bias if candidates.size else 0) * (max(high, 0) - self.low) * self.d
        self.bits = max(1, most.bit_length())
        self.wide = 2 * self.bits > DOUBLE_BITS
        self.fields = max(1, (WIDE_BITS if self.wide else DOUBLE_BITS) // self.bits)
        biased = exact.astype(object) - self.bias if self.wide else exact - self.bias
        self.words = packed(biased, self.fields, self.bits, self.wide).T
        self.sums = biased.sum(axis=1)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact products of the anchors with all candidates, cut to LIMIT."""
        exact = anchors.astype(object) if self.wide else anchors.astype(np.int64)
        raised = exact - self.low
        product = np.dot(raised if self.wide else raised.astype(np.float64), self.words)
        own = exact.sum(axis=1) * self.bias  # sum of (a + low)(c + bias), less what the biases add
        score = unpacked(product, self.fields, self.bits, self.n) + self.low * self.sums[None, :] + own[:, None]
        return np.clip(score, -LIMIT, LIMIT).astype(np.int64)


def all_scores(anchors: dict[int, tuple[np.ndarray, np.ndarray]], n_anchors: int, lengths: dict[int, tuple[np.ndarray, np.ndarray]], n: int):
    """(anchor numbers, scores with all candidates) in tiles. Both come by length: places and components. Missing components are 0."""
    ready: dict[tuple[int, int], Packed] = {}
    for la, (rows, a) in anchors.items():
        low, high = (int(a.min()), int(a.max())) if a.size else (0, 0)
        step = max(1, TILE // max(1, n))
        for start in range(0, len(rows), step):
            part = a[start : start + step]
            tile = np.zeros((len(part), n), dtype=np.int64)
            for lc, (places, c) in lengths.items():
                both = min(la, lc)
                if both:
                    if (la, lc) not in ready:
                        ready[la, lc] = Packed(c[:, :both], low, high)
                    tile[:, places] = ready[la, lc].scores(part[:, :both])
            yield rows[start : start + step], tile


def first_per_row(row: np.ndarray, place: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Indexes of the ``most`` best of each row, in order: score, best first, then place."""
    order = np.lexsort((place, -score, row))
    r = row[order]
    first = np.searchsorted(r, r)
    return order[np.arange(len(r)) - first < most]


def best_of_label(tile: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, score) of the ``most`` best allowed of each row; places are in id order."""
    low = np.iinfo(np.int64).min
    masked = np.where(allowed, tile, low)
    if masked.shape[1] > most:
        least = np.partition(masked, masked.shape[1] - most, axis=1)[:, masked.shape[1] - most]
        chosen = (masked >= least[:, None]) & (masked > low)
    else:
        chosen = masked > low
    row, place = np.nonzero(chosen)
    score = masked[row, place]
    keep = first_per_row(row, place, score, most)
    return row[keep], place[keep], score[keep]


def _small(x: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        if not len(x) or (x.min() >= np.iinfo(kind).min and x.max() <= np.iinfo(kind).max):
            return x.astype(kind)
    return x


_POSITIVE = pa.struct([("place", pa.int32()), ("positive_id", pa.int64()), ("score", pa.int64())])


def _to_blob(key: str, more: str | None = None):
    """Rows of a group as one row: ids, keys, labels, lengths and components as bytes, in order of (id, key)."""

    def blob(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([("vec_id", "ascending"), ("key", "ascending")])
        v = group.column("v").combine_chunks() if group.column("v").num_chunks != 1 else group.column("v").chunk(0)
        values = _small(v.flatten().to_numpy(zero_copy_only=False))
        columns = {key: pa.array([group.column(key)[0].as_py()], pa.int64()), "width": pa.array([values.itemsize], pa.int32())}
        for c in ("vec_id", "key", "label"):
            columns[f"{c}s"] = pa.array([group.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary())
        columns["lengths"] = pa.array([np.asarray(v.value_lengths(), dtype=np.int32).tobytes()], pa.binary())
        columns["vectors"] = pa.array([values.tobytes()], pa.binary())
        if more:
            columns[more] = pa.array([group.column(more).to_pylist()], pa.list_(pa.list_(_POSITIVE)))
        return pa.table(columns)

    return blob


_BLOB = "width int, vec_ids binary, keys binary, labels binary, lengths binary, vectors binary"


class _Rows:
    """A blob's rows again; components by length."""

    def __init__(self, row: dict, prefix: str):
        number = lambda c: np.frombuffer(row[prefix + c].as_buffer(), dtype=np.int64)
        self.ids, self.keys, self.labels = number("vec_ids"), number("keys"), number("labels")
        lengths = np.frombuffer(row[prefix + "lengths"].as_buffer(), dtype=np.int32)
        values = np.frombuffer(row[prefix + "vectors"].as_buffer(), dtype=f"i{row[prefix + 'width'].as_py()}")
        starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for d in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == d)
            self.by_length[d] = at, values[starts[at][:, None] + np.arange(d)[None, :]]


def _rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {c: batch.column(c)[k] for c in batch.schema.names}


def _positives(most: int):
    schema = "anchor_id long, anchor_key long, positive_id long, positive_key long, score long"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows_of(batch):
                a, c = _Rows(row, "a_"), _Rows(row, "c_")
                for rows, tile in all_scores(a.by_length, len(a.ids), c.by_length, len(c.ids)):
                    own = (a.ids[rows][:, None] == c.ids[None, :]) & (a.keys[rows][:, None] == c.keys[None, :])
                    r, p, s = best_of_label(tile, (a.labels[rows][:, None] == c.labels[None, :]) & ~own, most)
                    r = rows[r]
                    yield pa.record_batch([pa.array(x) for x in (a.ids[r], a.keys[r], c.ids[p], c.keys[p], s)], names=[f.split()[0] for f in schema.split(", ")])

    return find, schema


def _negatives(most: int, percent: int):
    schema = "anchor_id long, anchor_key long, place int, positive_id long, positive_score long, negative_id long, negative_key long, negative_score long"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows_of(batch):
                a, c = _Rows(row, "a_"), _Rows(row, "c_")
                positives = row["a_positives"].as_py()
                for rows, tile in all_scores(a.by_length, len(a.ids), c.by_length, len(c.ids)):
                    mine = [positives[i] for i in rows.tolist()]
                    highest = np.array([max(x["score"] for x in m) for m in mine])
                    lowest = np.array([min(x["score"] for x in m) for m in mine])
                    # Below zero no score lies between four fifths of a positive's and that itself.
                    other = a.labels[rows][:, None] != c.labels[None, :]
                    r, p = np.nonzero(other & (tile <= highest[:, None]) & (100 * tile >= percent * lowest[:, None]))
                    s = tile[r, p]
                    for k in range(max(map(len, mine))):
                        score = np.array([m[k]["score"] if k < len(m) else -1 for m in mine])
                        fits = np.flatnonzero((s <= score[r]) & (100 * s >= percent * score[r]) & (score[r] >= 0))
                        keep = fits[first_per_row(r[fits], p[fits], s[fits], most)]
                        if len(keep):
                            of, found = r[keep], p[keep]
                            named = np.array([m[k]["positive_id"] if k < len(m) else 0 for m in mine])
                            place = np.array([m[k]["place"] if k < len(m) else 0 for m in mine], dtype=np.int32)
                            who = rows[of]
                            columns = (a.ids[who], a.keys[who], place[of], named[of], score[of], c.ids[found], c.keys[found], s[keep])
                            yield pa.record_batch([pa.array(x) for x in columns], names=[f.split()[0] for f in schema.split(", ")])

    return find, schema


def hard_negatives(
    vectors: DataFrame, anchors: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT, scale: int = SCALE,
) -> DataFrame:
    """For each anchor and positive the best-scoring rows of another label that score no more than the positive, and near it.

    ``vectors`` has vec_id, label and embedding; ``anchors`` is a condition on vec_id and ``label`` the label to go by. A component
    x counts as floor(scale * x). Scores are exact integer products; higher come first, ties by smaller vec_id. An anchor's
    positives are its first rows of the same label, itself left out. Columns: anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score.

    Rows without vec_id, label or vector, or with a NULL or non-finite component, take no part. Rows alike in vec_id, label and
    vector are one; the same vec_id with other vectors is another row, and ties between them go by a hash. Where lengths differ, the
    missing components count as 0; an empty vector scores 0 with all. Components are cut to 64 bits and scores to LIMIT. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    v = F.col("embedding")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"), anchors.alias("asked"),
    ).where("label is not null").distinct()
    rows = cut(rows.withColumn("key", F.xxhash64("label", "v")))
    sizes = rows.agg(F.count("*").alias("n"), F.sum(F.size("v")).alias("c"), F.count_if("asked").alias("asked"), F.sum(F.when(F.col("asked"), F.size("v"))).alias("a")).first()
    n_shards = max(1, math.ceil((sizes.c or 0) / SHARD), min(spark.sparkContext.defaultParallelism, sizes.n // LEAST_SHARD_ROWS))
    n_blocks = max(1, math.ceil((sizes.a or 0) / BLOCK))

    def dealt(df: DataFrame, name: str, n: int) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("vec_id", "key"), F.lit(n)))

    shards = dealt(rows, "shard", n_shards).select("shard", "vec_id", "key", "label", "v").groupBy("shard").applyInArrow(_to_blob("shard"), f"shard long, {_BLOB}")
    shards = cut(shards.select("shard", *(F.col(f.split()[0]).alias(f"c_{f.split()[0]}") for f in _BLOB.split(", "))))
    asked = dealt(rows.where("asked"), "block", n_blocks).select("block", "vec_id", "key", "label", "v")

    def against_shards(blocks: DataFrame) -> DataFrame:
        """Every block of anchors beside every shard; blocks are sent to the shards."""
        names = [c for c in blocks.columns if c != "block"]
        each = blocks.select(*(F.col(c).alias(f"a_{c}") for c in names), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard"))
        return each.join(shards.hint("shuffle_merge"), "shard")

    blocks = asked.groupBy("block").applyInArrow(_to_blob("block"), f"block long, {_BLOB}")
    best = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("score"), "positive_id", "positive_key")
    found = against_shards(blocks).mapInArrow(*_positives(positives))
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    mine = found.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_key").alias("key")).agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "score"))).alias("positives"))

    kind = "array<struct<place:int,positive_id:bigint,score:bigint>>"
    blocks = asked.join(mine, ["vec_id", "key"]).groupBy("block").applyInArrow(_to_blob("block", "positives"), f"block long, {_BLOB}, positives array<{kind}>")
    near = Window.partitionBy("anchor_id", "anchor_key", "place").orderBy(F.desc("negative_score"), "negative_id", "negative_key")
    pairs = against_shards(blocks).mapInArrow(*_negatives(negatives, least_percent))
    ranked = pairs.withColumn("rank", F.row_number().over(near).cast("int")).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives_sql() -> str:
    """The registered query in SQL."""
    return f"""WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.c, b.c) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND {LEAST_PERCENT} * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}"""
