"""Near-duplicate documents by a chosen-path set similarity join.

Every distinct shingle set is a node of a graph. Independent trees branch the sets by selected minwise tokens, again and again
where a branch is still large (with a second branch for one in four tokens, so that a similar pair stays together somewhere); small
branches, and larger ones that do not fall apart, are compared exhaustively by their minhash signatures, and candidate pairs are
confirmed on the full sets.

Only what connects is confirmed: a small cluster of candidates sends all its pairs, a crowd first a spanning forest. Crowds that
are then still in parts get their members' full texts, confirm all candidate pairs between parts in one block, and send as many
links as it takes to join them. Pairs inside a part cannot change it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, give_back, gives_back, small_batches, tasks_for
from ledgerloom.llm.hashing import Texts, chunks, mixed

#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Independent trees; a pair of similarity 0.8 is missed by all, at two levels, with a chance below 1e-6.
TREES = 16
#: So many trees go first; the others leave out branches whose sets these have joined already.
FIRST_TREES = 4
#: Minhash functions of a signature, and how many must agree for a candidate: four standard deviations below 0.8 * 128.
FUNCTIONS, AGREE = 128, 84
#: Branches of so many sets are compared; larger ones branch again, by one function first, then by STEP at once, and are compared in
#: a grid of blocks when they have stayed together through EARLY levels as at most CROWD sets, or through LEVELS levels.
LEAF, LEVELS, BLOCK = 64, 4, 2_048
STEP, EARLY, CROWD = 4, 3, 2 * BLOCK
#: Rows of small tables per task.
ROWS_PER_TASK = 20_000
#: So many rows are broadcast to the documents that hold their texts; more meet them in a shuffle of all texts.
ROWS_SENT = 500_000
#: Links that one task joins.
LINKS_PER_TASK = 1 << 20
#: Candidate clusters of so many sets send all pairs at once.
CLUSTER = 8
#: Rows of a matrix, and pairs of a list, that are compared at once; sets that one set is tested with at once, first and at most.
TILE, PAIRS = 128, 1 << 14
FEW, MANY = 16, 512
#: Shingles of the sets of a block of a crowd, on average at most.
ROOM = 1 << 21

_RNG = np.random.default_rng(20_01)
_XOR = _RNG.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64)
_SALT = np.uint64(0x94D049BB133111EB)
_MULTIPLY = _RNG.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[str | None], size: int = 2) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; a text of fewer words has its whole sequence as one shingle."""
    out = []
    for _, some in chunks(texts):
        t = Texts(some, lower=True)
        doc, start, end = t.words()
        word = t.hashes(start, end)
        first = np.searchsorted(doc, np.arange(len(some) + 1))
        for a, b in zip(first[:-1], first[1:], strict=True):
            n = min(size, b - a)
            h = np.full(max(0, b - a - n + 1) if n else 0, np.uint64(n), dtype=np.uint64)
            for k in range(n):
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + word[a + k : b - n + 1 + k])
            out.append(np.unique(h))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each function over the set."""
    least = np.full(FUNCTIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        least = np.minimum(least, ((shingles[at : at + 2048, None] ^ _XOR) * _MULTIPLY).min(axis=0))
    return least


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            sets = shingle_sets(batch.column("text").to_pylist(), size)
            hashes = [np.array([np.bitwise_xor.reduce(mixed(s ^ salt)) if len(s) else 0 for s in sets], dtype=np.uint64).view(np.int64) for salt in (np.uint64(0), _SALT)]
            least = np.stack([signature(s) for s in sets])
            signs = pa.FixedSizeListArray.from_arrays(pa.array((mixed(least.ravel()) >> np.uint64(48)).astype(np.uint16).view(np.int16)), FUNCTIONS)
            tops = pa.FixedSizeListArray.from_arrays(pa.array((mixed(least[:, :TREES].ravel())).view(np.int64)), TREES)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("copy"), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, hashes), signs.cast(pa.list_(pa.int16())), tops.cast(pa.list_(pa.int64()))],
                names=["doc_id", "copy", "n_shingles", "hash_a", "hash_b", "sign", "tops"],
            )

    return run


def _candidates(sign: np.ndarray, n: np.ndarray, part: np.ndarray, percent: int) -> np.ndarray:
    """Matrix of agreeing functions; 0 inside a part, where sizes rule a link out, or where too few agree."""
    agree, by_function = np.zeros((len(n), len(n)), dtype=np.uint8), np.ascontiguousarray(sign.T)
    for first in range(0, len(n), TILE):
        some = slice(first, first + TILE)
        tile = agree[some]
        same = np.empty(tile.shape, dtype=bool)
        for values in by_function:
            np.equal(values[some, None], values, out=same)
            tile += same.view(np.uint8)
        tile[tile < AGREE * percent // PERCENT] = 0
        tile[100 * np.minimum(n[some, None], n) < percent * np.maximum(n[some, None], n)] = 0
        tile[part[some, None] == part] = 0
    return agree


def _agreeing(same: np.ndarray) -> np.ndarray:
    """How many are true in each row of a matrix whose rows have a multiple of eight, 255 at most are true."""
    eights = np.ascontiguousarray(same).view(np.uint64).sum(axis=1, dtype=np.uint64)
    return (eights * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.int16)


def _candidate_pairs(end: np.ndarray, sign: np.ndarray, n: np.ndarray, part: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates among the rows of each leaf, whose rows stand together up to ``end``: places a < b and their agreeing functions.

    Signatures are compared by halves; a pair that cannot reach the number in the second is left out after the first.
    """
    least, half = AGREE * percent // PERCENT, FUNCTIONS // 2
    halves = [np.ascontiguousarray(sign[:, :half]), np.ascontiguousarray(sign[:, half:])]
    later = end - 1 - np.arange(len(end))
    before = np.cumsum(later) - later
    out = []
    for first in range(0, int(later.sum()), PAIRS):
        k = np.arange(first, min(first + PAIRS, int(later.sum())))
        a = np.searchsorted(before, k, side="right") - 1
        b = a + 1 + k - before[a]
        fit = (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])) & (part[a] != part[b])
        a, b = a[fit], b[fit]
        agree = _agreeing(halves[0][a] == halves[0][b])
        some = agree + half >= least
        a, b, agree = a[some], b[some], agree[some]
        agree += _agreeing(halves[1][a] == halves[1][b])
        some = agree >= least
        out.append((a[some], b[some], agree[some]))
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none, none, none)


def _forest(a: np.ndarray, b: np.ndarray, agree: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Cluster of each of n places that pairs (a, b) connect, and a spanning forest (numbers of pairs) of those that agree most."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    forest, order = [], np.argsort(-agree.astype(int), kind="stable")
    for k, i, j in zip(order.tolist(), a[order].tolist(), b[order].tolist(), strict=True):
        p, q = find(i), find(j)
        if p != q:
            root[max(p, q)] = min(p, q)
            forest.append(k)
    return np.array([find(x) for x in range(n)], dtype=np.int64), np.array(forest, dtype=np.int64)


def _clusters(agree: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Cluster of each set, and a spanning forest of the pairs that agree most (Prim), the same pairs in all blocks where several agree alike."""
    tie = mixed(node.astype(np.uint64)) >> np.uint64(16)
    best, nearest, cluster = np.zeros(len(agree), dtype=np.int64), np.zeros(len(agree), dtype=np.int64), np.arange(len(agree))
    out, forest, at = np.zeros(len(agree), dtype=bool), [], 0
    for _ in range(len(agree)):
        k = int(best.argmax())
        if best[k]:
            cluster[k] = cluster[nearest[k]]
            forest.append((int(nearest[k]), k))
        else:
            while out[at]:
                at += 1
            k = at
        out[k], best[k] = True, 0
        like = (agree[k].astype(np.int64) << 48) + (tie ^ tie[k]).astype(np.int64)
        nearer = (like > best) & (agree[k] > 0) & ~out
        best[nearer], nearest[nearer] = like[nearer], k
    return cluster, forest


def _first_pairs(node: np.ndarray, agree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of pairs to confirm first, and of the sets that stand in a crowd."""
    cluster, forest = _clusters(agree, node)
    size = np.bincount(cluster, minlength=len(cluster))[cluster]
    few = np.flatnonzero((size > 1) & (size <= CLUSTER))
    a, b = np.nonzero(np.triu(agree[np.ix_(few, few)]))
    i, j = np.array([p for p in forest if size[p[0]] > CLUSTER], dtype=np.int64).reshape(-1, 2).T
    return np.concatenate([few[a], i]), np.concatenate([few[b], j]), np.flatnonzero(size > CLUSTER)


def _compare_leaves(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by path: pairs (a, b) to confirm, and (path, node) of crowds. All leaves of a batch are compared at once."""
        held: pa.Table | None = None

        def leaves(t: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
            path = t.column("path").to_numpy()
            first = np.flatnonzero(np.diff(path, prepend=~path[:1]) != 0)
            ends = np.append(first[1:], len(path))
            rest = len(path) if last else int(first[-1])
            path, (node, sign, n, part) = path[:rest], _arrays(t.slice(0, rest))
            a, b, agree = _candidate_pairs(np.repeat(ends, ends - first)[:rest], sign, n, part, percent)
            cluster, forest = _forest(a, b, agree, rest)
            size = np.bincount(cluster, minlength=rest)[cluster]
            sent = np.concatenate([np.flatnonzero(size[a] <= CLUSTER), forest[size[a[forest]] > CLUSTER]])
            crowd = size > CLUSTER
            return _rows(node[a[sent]], node[b[sent]], path[crowd], node[crowd]), t.slice(rest)

        for batch in batches:
            if batch.num_rows:
                t = pa.Table.from_batches([batch])
                out, held = leaves(pa.concat_tables([held, t]) if held is not None else t, False)
                yield out
        if held is not None and held.num_rows:
            yield leaves(held, True)[0]

    return run


def _rows(a: np.ndarray, b: np.ndarray, path: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    """Different pairs, the smaller node first, and below them (path, node) of crowds."""
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1).astype(np.int64).reshape(-1, 2), axis=0)
    gap = lambda k: pa.nulls(k, pa.int64())
    column = lambda *x: pa.concat_arrays(x)
    of = lambda x: pa.array(np.ascontiguousarray(x), pa.int64())
    return pa.record_batch([column(of(pairs[:, 0]), gap(len(path))), column(of(pairs[:, 1]), gap(len(path))), column(gap(len(pairs)), of(path)), column(gap(len(pairs)), of(node))], names=["a", "b", "path", "node"])


def _arrays(t: pa.Table, part: str = "part") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, signatures, set sizes and parts of a table."""
    sign = t.column("sign").combine_chunks().flatten().to_numpy().reshape(-1, FUNCTIONS)
    return t.column("node").to_numpy(), sign, t.column("n_shingles").to_numpy(), t.column(part).to_numpy()


def _block_first(percent: int):
    def run(block: pa.Table) -> pa.Table:
        node, sign, n, part = _arrays(block)
        a, b, crowd = _first_pairs(node, _candidates(sign, n, part, percent))
        cell = block.column("path")[0].as_py() ^ block.column("p")[0].as_py() << 40 ^ block.column("q")[0].as_py() << 20
        return pa.Table.from_batches([_rows(node[a], node[b], np.full(len(crowd), cell, dtype=np.int64), node[crowd])])

    return run


def _links_apart(size: int, percent: int):
    def run(cell: pa.Table) -> pa.Table:
        """Links between different parts of a crowd, as many as it takes to join the parts; all candidate pairs are confirmed.

        Pairs of one value in ``done`` are known already. The spanning forest of the candidates goes first, then, from the smallest part on,
        each set with all its candidates in other parts. In a cell of two blocks the second step has only pairs between these; the
        pairs inside a block have cells of their own.
        """
        try:
            node, sign, n, done = _arrays(cell, "done")
            part, own = cell.column("part").to_numpy(), cell.column("own").to_numpy()
            agree = _candidates(sign, n, done, percent)
            agree[part[:, None] == part] = 0
            some = np.flatnonzero(agree.any(axis=1))
            out = _joining(shingle_sets(cell.column("text").take(pa.array(some)).to_pylist(), size), agree[np.ix_(some, some)], node[some], part[some], own[some], percent) if len(some) else []
            return pa.table({"a": pa.array([int(node[some[i]]) for i, _ in out], pa.int64()), "b": pa.array([int(node[some[j]]) for _, j in out], pa.int64())})
        finally:
            give_back()

    return run


def _joining(sets: list[np.ndarray], agree: np.ndarray, node: np.ndarray, part: np.ndarray, own: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (places) that join the parts of sets with these candidates."""
    n, joined = np.array([len(x) for x in sets]), np.unique(part, return_inverse=True)[1]
    number = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    numbers = np.split(number, np.cumsum(n)[:-1])
    held = np.zeros(int(number.max()) + 1, dtype=bool)
    out: list[tuple[int, int]] = []

    def test(i: int, with_: np.ndarray) -> None:
        held[numbers[i]] = True
        starts = np.cumsum(n[with_]) - n[with_]
        both = np.add.reduceat(held[np.concatenate([numbers[j] for j in with_])], starts, dtype=np.int64)
        held[numbers[i]] = False
        for j in with_[100 * both >= percent * (n[i] + n[with_] - both)].tolist():
            if joined[i] != joined[j]:
                joined[joined == joined[j]] = joined[i]
                out.append((i, j))

    for i, j in _clusters(agree, node)[1]:
        test(i, np.array([j]))
        agree[i, j] = agree[j, i] = 0
    if own.min() < own.max():
        agree[own[:, None] == own] = 0
    seen = np.zeros(len(n), dtype=bool)
    for i in np.argsort(np.bincount(joined)[joined], kind="stable").tolist():
        seen[i] = True
        left, step = np.flatnonzero((agree[i] > 0) & (joined != joined[i]) & ~seen), FEW
        left = left[np.argsort(-agree[i, left].astype(int), kind="stable")]
        while len(left):
            test(i, left[:step])
            left, step = left[step:], min(4 * step, MANY)
            left = left[joined[left] != joined[i]]
    return out


def _parts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of links, and the smallest node of each one's component."""
    node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j, least = at[: len(a)], at[len(a) :], np.arange(len(node))
    while True:
        before, low = least.copy(), np.minimum(least[i], least[j])
        for x in (before[i], before[j]):
            np.minimum.at(least, x, low)
        while not np.array_equal(least, least[least]):
            least = least[least]
        if np.array_equal(least, before):
            return node, node[least]


def _all_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v = (np.concatenate(x) for x in zip(*((b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches), (np.zeros(0, np.int64),) * 2, strict=True))
    yield pa.record_batch([pa.array(x, pa.int64()) for x in _parts(u, v)], names=["node", "part"])


def components(links: DataFrame) -> DataFrame:
    """(a, b) pairs of numbers to (node, part): the smallest number of each node's component.

    So many links as fit a task are joined in one. More are joined by alternating stars: every node is linked to its smallest neighbour, first from
    the larger side, then from the smaller, until nothing changes. Rows stay as many as the links, and rounds grow with the logarithm of a component's width.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), ROWS_PER_TASK)
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or now[0] == 0:
            break
        if before is None and now[0] <= LINKS_PER_TASK:
            return edges.coalesce(1).mapInArrow(gives_back(_all_parts), "node long, part long")
        before, tasks = now, tasks_for(now[0], ROWS_PER_TASK)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = cut(small.select("e.*").where("u <> v").coalesce(tasks).distinct(), ROWS_PER_TASK)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("part")).unionByName(roots.select("node", F.col("node").alias("part")))


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets make a link; texts has node and text."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text_a", 2 << 20):
            keep = []
            for x, y in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                p, q = shingle_sets([x.as_py(), y.as_py()], size)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
    return left.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b").mapInArrow(gives_back(linked), "a long, b long")


def _described(documents: DataFrame, size: int) -> DataFrame:
    id_type = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.xxhash64("text").alias("copy"), "text")
    return rows.mapInArrow(gives_back(_describe(size)), f"doc_id {id_type}, copy long, n_shingles long, hash_a long, hash_b long, sign array<short>, tops array<long>")


def _branches(step: int) -> Column:
    """Lists of ``step`` functions by which the sets of a path branch, 1.25 ** ``step`` lists on average.

    Sets of similarity 0.8 share the tokens of a list with a chance of 0.8 ** ``step``, so those of a pair are expected together once.
    """
    lists, share = 1.25**step, 1_000_000
    picks = lambda k: F.array(*(F.pmod(F.xxhash64("path", F.lit(k), F.lit(j)), F.lit(FUNCTIONS)).cast("int") for j in range(step)))
    sure = [picks(k) for k in range(int(lists))]
    one_more = F.pmod(F.xxhash64("path", F.lit(-1)), F.lit(share)) < round((lists - len(sure)) * share)
    return F.when(one_more, F.array(*sure, picks(len(sure)))).otherwise(F.array(*sure))


def _crowds_joined(rows: DataFrame, signs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) that join the parts of crowds, from rows (key, node, part, done): the sets of a key, in blocks against blocks if they are many."""
    rows = rows.join(signs, "node").join(texts, "node")
    many = rows.groupBy("key").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / ROOM)).cast("int").alias("n_blocks"))
    grid = rows.join(many, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    cells = grid.select("key", "node", "part", "done", "own", "n_shingles", "sign", "text", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    return cells.groupBy("key", "p", "q").applyInArrow(_links_apart(size, percent), "a long, b long")


def _tree_links(
    rows: DataFrame, known: DataFrame | None, signs: DataFrame, nodes: DataFrame, documents: DataFrame, size: int, percent: int
) -> tuple[DataFrame, DataFrame | None]:
    """Links (a, b) found by trees, from their first paths (node, path), as many as join what the trees bring together, and (node, group) of groups all of whose candidates were confirmed.

    ``known`` has the parts of nodes so far, and in ``done`` a larger group whose pairs are all confirmed already, or the part. Branches whose
    sets are all in one of these are left out, and elsewhere sets of one are not compared, since such pairs cannot change a part.

    A crowd's sets meet in many branches. If all sets that candidates connect to it are at most as many pairs as its sets in these branches, they are
    compared once, as a group, and not in each branch.
    """
    rows, parts = rows.select("node", "path"), None
    if known is not None:
        parts = known.select("node", F.col("done").alias("part"))
        rows = rows.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    part = F.col("node" if parts is None else "part")
    leaves = crowded = None
    for level in range(LEVELS):
        counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), *([F.min("part").alias("p"), F.max("part").alias("q")] if parts is not None else []))
        counts = counts.where("n > 1" if parts is None else "n > 1 and p < q").select("path", "n")
        rows = cut(rows.join(counts, "path"), ROWS_PER_TASK)
        leaf = rows.where(F.col("n") <= LEAF).select("path", "node", part.alias("part"))
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        rows = rows.where(F.col("n") > LEAF)
        # A branch that stays together holds sets that are much alike: more levels would only multiply them.
        stays = F.col("n") <= CROWD if level >= EARLY - 1 else F.lit(False)
        if level == LEVELS - 1:
            stays = F.lit(True)
        if level >= min(EARLY, LEVELS) - 1:
            crowd = rows.where(stays).select("path", "node", part.alias("part"), "n")
            crowded = crowd if crowded is None else crowded.unionByName(crowd)
            rows = rows.where(~stays)
        if level == LEVELS - 1 or rows.isEmpty():
            break
        kept = ["node", *(["part"] if parts is not None else [])]
        rows = rows.join(signs, "node").select(*kept, "path", "sign", F.explode(_branches(1 if level == 0 else STEP)).alias("f"))
        token = F.transform("f", lambda f: F.element_at("sign", f + 1))
        # Kept, as they are read twice: to be counted, and with their counts.
        rows = cut(rows.select(*kept, F.xxhash64("path", "f", token).alias("path")), ROWS_PER_TASK)

    schema = "a long, b long, path long, node long"
    compared = leaves.join(signs, "node").select("path", "node", "part", "n_shingles", "sign").repartition("path").sortWithinPartitions("path", "node")
    first = compared.mapInArrow(gives_back(_compare_leaves(percent)), schema)
    # What stayed together: blocks against blocks.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = crowded if crowded is not None else rows.select("path", "node", part.alias("part"), "n")
    grid = rows.withColumn("n_blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    grid = grid.select("path", "node", "part", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q")).join(signs, "node")
    from_grid = grid.groupBy("path", "p", "q").applyInArrow(_block_first(percent), schema)
    met = cut(first.unionByName(from_grid), ROWS_PER_TASK)
    tested = cut(met.where("a is not null").select("a", "b").distinct(), ROWS_PER_TASK)
    crowds = cut(met.where("path is not null").select("path", "node").distinct(), ROWS_PER_TASK)

    wanted = tested.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowds.select("node")).distinct()
    at = wanted.join(nodes.select("node", "at.*"), "node")
    if wanted.count() <= ROWS_SENT:
        at = F.broadcast(at)
    whole = documents.select("doc_id", F.xxhash64("text").alias("copy"), "text")
    same = whole["doc_id"].eqNullSafe(at["doc_id"]) & (whole["copy"] == at["copy"])
    texts = cut(whole.join(at, same).select("node", "text").dropDuplicates(["node"]), ROWS_PER_TASK)

    if crowds.isEmpty():
        return cut(_confirm(tested, texts, size, percent), ROWS_PER_TASK), None

    grouped = cut(components(tested).withColumnRenamed("part", "group"), ROWS_PER_TASK)
    cells = cut(crowds.join(grouped, "node"), ROWS_PER_TASK)
    in_cells = cells.groupBy("group", "path").agg(F.count(F.lit(1)).alias("n")).groupBy("group").agg(F.sum(F.col("n") * F.col("n")).alias("in_cells"))
    whole = cut(grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n")).join(in_cells, "group").where("n * n <= in_cells").select("group"), ROWS_PER_TASK)
    settled = cut(grouped.join(whole, "group", "left_semi"), ROWS_PER_TASK)
    links = cut(_confirm(tested.join(settled.select(F.col("node").alias("a")), "a", "left_anti"), texts, size, percent), ROWS_PER_TASK)
    of_node = lambda df: (df if known is None else df.join(known, "node", "left").withColumns({c: F.coalesce(c, "node") for c in ("part", "done")}))
    rows = of_node(settled.select(F.col("group").alias("key"), "node"))
    if known is None:
        rows = rows.select("key", "node", F.col("node").alias("part"), F.col("node").alias("done"))
    loose = cells.join(whole, "group", "left_anti")
    if not loose.isEmpty():
        # Crowds that these links, and those found before, leave in parts.
        sure = links if known is None else links.unionByName(known.select(F.col("node").alias("a"), F.col("part").alias("b")))
        now = cut(components(sure), ROWS_PER_TASK)
        apart = loose.join(now, "node", "left").select(F.xxhash64("path", "group").alias("key"), "node", F.coalesce("part", "node").alias("part"))
        open_cells = apart.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q").select("key")
        apart = apart.join(open_cells, "key", "left_semi")
        apart = apart.withColumn("done", F.col("node")) if known is None else apart.join(known.select("node", "done"), "node", "left").withColumn("done", F.coalesce("done", "node"))
        rows = rows.unionByName(apart)
    return links.unionByName(cut(_crowds_joined(rows, signs, texts, size, percent).distinct(), ROWS_PER_TASK)), settled


def near_duplicates(documents: DataFrame, size: int = 2, percent: int = PERCENT) -> DataFrame:
    """One row per row of documents: doc_id, copy (hash of the text), n_shingles, component_id, kept, component (a number).

    Documents are linked if 100 * intersection >= percent * union of their sets of ``size``-word shingles over words of non-space
    bytes with A-Z lower-cased (percent from 50 on). component_id is the smallest doc_id reachable, kept says whether it is the
    row's own. NULL, empty and blank texts have no shingles and stand alone. Rows with one doc_id are separate documents under
    that id; rows without doc_id can link others, have their component's id or NULL, and are never kept. ``component`` tells
    components apart that share an id; it is NULL without shingles. Other columns are ignored. Very long texts are read whole, and equal sets are one node however many rows have them.
    """
    docs = cut(_described(documents, size), ROWS_PER_TASK)
    some = docs.where("n_shingles > 0")
    # Equal sets: two 64-bit hashes and the size. Numbers are given before the rows are kept, so they stay.
    same_set = ["hash_a", "hash_b", "n_shingles"]
    sets = some.groupBy(*same_set).agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "copy")).alias("at"), *[F.first(c).alias(c) for c in ("sign", "tops")])
    nodes = cut(sets.withColumn("node", F.monotonically_increasing_id()), ROWS_PER_TASK)
    signs = nodes.select("node", "n_shingles", "sign")
    paths = nodes.select("node", F.posexplode("tops").alias("tree", "top")).select("node", "tree", F.xxhash64("tree", "top").alias("path"))

    links, settled = _tree_links(paths.where(F.col("tree") < FIRST_TREES), None, signs, nodes, documents, size, percent)
    parts = components(links)
    known = parts.withColumn("done", F.col("part"))
    if settled is not None:
        known = parts.join(settled, "node", "full").select("node", F.coalesce("part", "node").alias("part"), F.coalesce("group", "part").alias("done"))
    known = cut(known, ROWS_PER_TASK)
    more, _ = _tree_links(paths.where(F.col("tree") >= FIRST_TREES), known, signs, nodes, documents, size, percent)
    parts = cut(components(links.unionByName(more)), ROWS_PER_TASK)

    ids = nodes.select("node", "least_id").join(parts, "node").groupBy("part").agg(F.min("least_id").alias("linked_id"))
    linked = parts.join(ids, "part").select("node", "part", "linked_id")
    of_set = nodes.join(linked, "node", "left").select(*same_set, F.coalesce("part", "node").alias("component"), F.coalesce("linked_id", "least_id").alias("least"))
    out = docs.select("doc_id", "copy", *same_set).join(of_set, same_set, "left")
    least: Column = F.coalesce("least", "doc_id")
    return out.select("doc_id", "copy", "n_shingles", least.alias("component_id"), F.coalesce(F.col("doc_id") == least, F.lit(False)).alias("kept"), "component")
