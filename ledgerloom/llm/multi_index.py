"""Approximate nearest neighbours by an inverted multi-index.

Each half of the vectors has its own codebook; a cell is a pair of centroids. A query goes through the cells by the sum of its
halves' inner products with the centroids, best first, with a heap over the sorted centroid lists, until the cells it has seen
hold a given share of all vectors; their entries are reranked by the exact inner product.

Copies of a vector are kept once, with the few smallest ids that any result can show, so a crowd of copies is one entry. Cells are
packed into shards of bounded size (large cells are split), and queries come in blocks: a task holds one shard and one block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut

NEAREST = 20
#: Share of the distinct vectors a query's cells must hold. High, because recall must reach 0.9 on vectors without clusters.
SHARE = 0.8
#: Codebooks are fitted on so many vectors at most: those with the smallest hash of their id, a sample of fixed size.
MOST_SAMPLE = 20_000
#: Vectors per cell aimed at, and the limits of centroids per half.
PER_CELL, LEAST_CENTROIDS, MOST_CENTROIDS = 32, 2, 512
SHARD_ROWS = 16_384
BLOCK_ROWS = 1_024


def usable(vector: Column) -> Column:
    """Whether a vector takes part: neither NULL nor empty nor zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit_codebook(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """k-means on rows, begun from distinct rows; fewer centroids if there are fewer distinct rows."""
    start = np.unique(x, axis=0)
    c = start[np.random.default_rng(seed).permutation(len(start))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        count = np.bincount(near, minlength=len(c))
        sums = np.stack([np.bincount(near, weights=col, minlength=len(c)) for col in x.T], axis=1)
        c[count > 0] = sums[count > 0] / count[count > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1) if len(x) else np.zeros(0, dtype=int)


def best_cells(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: float) -> list[int]:
    """Cells (numbered first * len(second) + second) by falling sum of the two scores, until they hold ``wanted`` vectors.

    The multi-sequence walk: both lists are sorted, a heap holds the pairs whose left and lower neighbours have been taken.
    """
    rows, cols = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b, n = first[rows].tolist(), second[cols].tolist(), len(second)
    heap, seen, taken, found = [(-(a[0] + b[0]), 0, 0)], {(0, 0)}, [], 0
    while heap and found < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(rows[i]) * n + int(cols[j])
        if counts[cell]:
            taken.append(cell)
            found += int(counts[cell])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (-(a[p] + b[q]), p, q))
    return taken


def pack(counts: np.ndarray, most: int = SHARD_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of each cell: small cells share a shard, a large cell has several of its own."""
    first, parts = np.zeros(len(counts), dtype=np.int64), np.ones(len(counts), dtype=np.int64)
    shard, filled = 0, 0
    for cell, n in enumerate(counts.tolist()):
        if n > most:
            shard += filled > 0
            first[cell], parts[cell], filled = shard, -(-n // most), 0
            shard += int(parts[cell])
        else:
            if filled + n > most:
                shard, filled = shard + 1, 0
            first[cell] = shard
            filled += n
    return first, parts


def search(vectors: DataFrame, queries: Column, k: int = NEAREST, share: float = SHARE, most_sample: int = MOST_SAMPLE) -> DataFrame:
    """The k nearest found for each query row: query_id, rank (from 1), vec_id, score (inner product in double precision).

    ``vectors`` has vec_id (a whole number) and embedding; ``queries`` is a condition on vec_id. Candidates are all rows but those
    with the query's own id; ties go to the smaller vec_id. Vectors that are NULL, empty, zero or hold NULL or non-finite
    components take no part, neither do rows without vec_id and vectors of another length than most have. Of rows with the same
    vec_id and vector one counts; the same vec_id with several vectors is searched, and may be found, with each of them, and the
    best score counts. Other columns are ignored. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d = lengths.d
    rows = rows.where(F.size("v") == d).distinct()
    # Distinct vectors under their smallest id, with the k + 1 smallest ids that share each.
    in_copies = Window.partitionBy("v").orderBy("vec_id")
    some = rows.withColumn("place", F.row_number().over(in_copies)).where(F.col("place") <= k + 1)
    distinct = cut(some.groupBy("v").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids")))
    # Rows of one id with several vectors need a key of their own.
    distinct = distinct.withColumn("key", F.xxhash64("v", "rep"))
    n = distinct.count()
    asked = rows.where(queries).withColumnRenamed("vec_id", "query_id").join(distinct.select("v", "key"), "v").select("query_id", "key")

    centroids = max(LEAST_CENTROIDS, min(MOST_CENTROIDS, math.ceil(math.sqrt(n / PER_CELL))))
    sample = distinct.select("key", "v").orderBy(F.xxhash64("key"), "key").limit(most_sample)
    half = (d + 1) // 2

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [f for f in frames if len(f)]
        x = np.stack(pd.concat(got).sort_values("key")["v"].to_list())
        books = [fit_codebook(x[:, :half], centroids), fit_codebook(x[:, half:], centroids) if d > 1 else np.zeros((1, 0))]
        yield pd.DataFrame({"part": [0, 1], "k": [len(c) for c in books], "c": [c.ravel().tolist() for c in books]})

    fitted = sample.repartition(1).mapInPandas(learn, "part int, k int, c array<double>").orderBy("part").collect()
    left, right = (np.array(r.c).reshape(r.k, half if r.part == 0 else d - half) for r in fitted)
    n_cells = len(left) * len(right)

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = np.stack(f["v"].to_list())
                yield pd.DataFrame({"key": f["key"], "rep": f["rep"], "cell": nearest(x[:, :half], left) * len(right) + nearest(x[:, half:], right), "v": f["v"]})

    placed = cut(distinct.select("key", "rep", "v").mapInPandas(cells, "key long, rep long, cell int, v array<double>"))
    counts = np.zeros(n_cells, dtype=np.int64)
    for r in placed.groupBy("cell").count().collect():  # at most MOST_CENTROIDS ** 2 rows
        counts[r.cell] = r["count"]
    first, parts = pack(counts)

    def to_shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            c = f["cell"].to_numpy()
            yield f.assign(shard=first[c] + np.abs(f["key"].to_numpy()) % parts[c])

    shard_schema = "shard long, keys binary, reps binary, cells binary, vectors binary"

    def to_blob(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(group["v"].to_list())
        blob = [group[c].to_numpy(t).tobytes() for c, t in (("key", np.int64), ("rep", np.int64), ("cell", np.int32))]
        return pd.DataFrame([[group["shard"].iloc[0], *blob, x.tobytes()]], columns=["shard", "keys", "reps", "cells", "vectors"])

    sharded = placed.mapInPandas(to_shards, "key long, rep long, cell int, v array<double>, shard long")
    shards = sharded.groupBy("shard").applyInPandas(to_blob, shard_schema)

    def probes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            x, out = np.stack(f["v"].to_list()), []
            for key, v, a, b in zip(f["key"], x, x[:, :half] @ left.T, x[:, half:] @ right.T, strict=True):
                by_shard: dict[int, list[int]] = {}
                for cell in best_cells(a, b, counts, max(share * n, k + 1)):
                    for s in range(int(first[cell]), int(first[cell] + parts[cell])):
                        by_shard.setdefault(s, []).append(cell)
                out += [(key, v.tobytes(), s, np.array(c, dtype=np.int32).tobytes()) for s, c in by_shard.items()]
            yield pd.DataFrame(out, columns=["key", "v", "shard", "cells"])

    asked = cut(asked)
    wanted = placed.join(asked.select("key").distinct(), "key", "left_semi").select("key", "v")
    asked_of = wanted.mapInPandas(probes, "key long, v binary, shard long, cells binary")
    # Blocks of about BLOCK_ROWS queries, by hash.
    n_blocks = max(1, math.ceil(asked.select("key").distinct().count() / BLOCK_ROWS))
    blocks = asked_of.withColumn("block", F.pmod("key", F.lit(n_blocks))).groupBy("shard", "block")
    blocks = blocks.agg(F.collect_list(F.struct("key", "v", "cells")).alias("asked"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row] for c in batch.schema.names}
                keys, reps, cell = (np.frombuffer(one[c].as_buffer(), dtype=t) for c, t in (("keys", np.int64), ("reps", np.int64), ("cells", np.int32)))
                x = np.frombuffer(one["vectors"].as_buffer(), dtype=np.float64).reshape(len(keys), d)
                local = {c: i for i, c in enumerate(np.unique(cell).tolist())}
                where = np.array([local[c] for c in cell.tolist()])
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for q in one["asked"]:
                    seen = np.zeros(len(local), dtype=bool)
                    seen[[local[c] for c in np.frombuffer(q["cells"].as_buffer(), dtype=np.int32).tolist() if c in local]] = True
                    at = np.flatnonzero(seen[where])
                    score = x[at] @ np.frombuffer(q["v"].as_buffer(), dtype=np.float64)
                    if len(at) > k + 1:
                        least = np.partition(score, len(at) - k - 1)[len(at) - k - 1]
                        at, score = at[score >= least], score[score >= least]
                    order = np.lexsort((reps[at], -score))[: k + 1]
                    out.append((np.full(len(order), q["key"].as_py()), keys[at[order]], score[order]))
                yield pa.record_batch([pa.array(np.concatenate([o[c] for o in out])) for c in range(3)], names=["key", "found", "score"])

    pairs = blocks.join(shards, "shard").drop("shard", "block").mapInArrow(rank, "key long, found long, score double")
    by_score = Window.partitionBy("key").orderBy(F.desc("score"), "rep")
    known = placed.select(F.col("key").alias("found"), "rep")
    best = pairs.join(known, "found").withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
    ids = distinct.select(F.col("key").alias("found"), F.explode("ids").alias("vec_id"))
    shown = asked.join(best.select("key", "found", "score").join(ids, "found"), "key").where(F.col("vec_id") != F.col("query_id"))
    shown = shown.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return shown.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
