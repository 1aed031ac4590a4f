"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample: k-means splits it into ``BRANCHES`` clusters,
each of those again, until a cluster is small. Every vector is then put into a leaf by
descending to the nearest centre at each level. A query walks the tree best bin first: a
priority queue holds all centres seen so far by distance, the nearest is opened next,
and every leaf that comes up is visited. How many leaves are visited is calibrated:
for a bounded sample of queries the true neighbours are found by comparing them with all
vectors, and visits are widened until ``TARGET_RECALL`` of those neighbours lie in the
visited leaves. A query goes on beyond that while its leaves hold too few rows.

How it runs: vectors are indexed in one pass. Leaves side by side form groups of about a
block of vectors; a larger leaf is cut into blocks, and so are the queries that visit a
group. Each pair of blocks is compared in one task, so neither a leaf with a third of all
vectors nor one that all queries visit is held whole. Leaves are visited in rounds, the nearest few
first, then four times as far each: a query goes to a group once a round, with the leaves it
visits there and the k-th distance it has so far, and a task returns only what lies within
that. So the rows returned are a few k for each query and round, however many leaves are visited. Tree, leaf counts and calibration queries are
bounded by parameters and travel with the job. Distances are exact, in double
precision, on the original vectors; only the choice of leaves is approximate.

Defined results: a vector that is null, zero, holds a null or non-finite component, has
another length than most, or no id, takes no part. Candidates are all rows but those with
the query's own id. Of several rows with a query's id the smallest vector asks, all
are candidates. Ties go to the smaller id. Fewer candidates than k: all of them.
Empty table: empty.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm import columns as C
from lendmill.llm.shipping import by_value

by_value(__name__)

NEIGHBOURS = 10
BRANCHES = 16

#: Vectors of a leaf aimed at, and the most leaves a tree has (leaves of larger tables grow).
LEAF_ROWS = 128
MOST_LEAVES = 4096

#: Sampled vectors per leaf to fit the tree on, and rounds of k-means.
SAMPLE_PER_LEAF = 16
ROUNDS = 8

#: Queries to calibrate with, and the share of their true neighbours to reach.
CALIBRATION = 128
TARGET_RECALL = 0.96

#: Rows of a block of vectors or of queries.
BLOCK_ROWS = 2048

#: Leaves of the first round of visits, and how much farther each later round goes.
FIRST_VISITS = 4
WIDEN = 4


# ---- tree ---------------------------------------------------------------------


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant per row, enough to rank centres."""
    return (centres**2).sum(axis=1) - 2 * x @ centres.T


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        own = _distances(x, centres).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return np.unique(centres, axis=0)


class Tree:
    """Nodes with the centres of their children; a child is a node's number or -1 - leaf."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 1):
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.n_leaves = 0
        small = max(2, math.ceil(len(sample) / max(leaves, 1)))
        self._grow(sample, small, np.random.default_rng(seed))

    def _leaf(self) -> int:
        self.n_leaves += 1
        return -self.n_leaves

    def _grow(self, x: np.ndarray, small: int, rng: np.random.Generator) -> int:
        number = len(self.nodes)
        self.nodes.append((np.zeros((1, x.shape[1])), []))
        k = min(BRANCHES, max(1, math.ceil(len(x) / small)))
        centres = _kmeans(x, k, rng) if k > 1 else x.mean(axis=0)[None] if len(x) else self.nodes[0][0]
        own = _distances(x, centres).argmin(axis=1)
        children = []
        for i in range(len(centres)):
            part = x[own == i]
            deeper = len(part) > 2 * small and len(part) < len(x)
            children.append(self._grow(part, small, rng) if deeper else self._leaf())
        self.nodes[number] = (centres, children)
        return number

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf each vector descends to."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            number, rows = todo.pop()
            centres, children = self.nodes[number]
            nearest = _distances(x[rows], centres).argmin(axis=1)
            for i, child in enumerate(children):
                own = rows[nearest == i]
                if len(own) and child >= 0:
                    todo.append((child, own))
                elif len(own):
                    out[own] = -1 - child
        return out

    def visits(self, q: np.ndarray) -> Iterator[int]:
        """Leaves best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, number = heapq.heappop(queue)
            if number < 0:
                yield -1 - number
                continue
            centres, children = self.nodes[number]
            far = ((centres - q) ** 2).sum(axis=1)
            for d, child in zip(far.tolist(), children, strict=True):
                heapq.heappush(queue, (d, child))


# ---- work inside tasks --------------------------------------------------------


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 1))
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _indexed(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaf = tree.leaf_of(_matrix(batch.column("vec")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(leaf, pa.int64()), batch.column("id"), batch.column("vec")], names=["leaf", "id", "vec"]
        )


def _asked(
    batches: Iterator[pa.RecordBatch],
    tree: Tree,
    rows: np.ndarray,
    group: np.ndarray,
    span: tuple[int, int],
    visits: int,
    k: int,
) -> Iterator[pa.RecordBatch]:
    """A row per query and group of leaves, with the leaves of the group that the query visits as its
    ``span``-th ones, and the distance that is still worth returning."""
    for batch in batches:
        take, groups, leaves = [], [], []
        for i, q in enumerate(_matrix(batch.column("vec"))):
            seen, mine = 0, {}
            for n, leaf in enumerate(tree.visits(q)):
                if n >= span[1] or n >= visits and seen > k:
                    break
                seen += int(rows[leaf])
                if n >= span[0] and rows[leaf]:
                    mine.setdefault(int(group[leaf]), []).append(leaf)
            take += [i] * len(mine)
            groups += mine
            leaves += mine.values()
        at = pa.array(take, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(groups, pa.int64()),
                pa.array(leaves, pa.list_(pa.int64())),
                *(batch.column(c).take(at) for c in ("id", "vec", "within")),
            ],
            names=["group", "leaves", "query", "vec", "within"],
        )


def _nearest(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the places of its k nearest vectors under other ids, with distances."""
    who, where, score = [], [], []
    for i, q in enumerate(queries):
        far = np.sqrt(((vectors - q) ** 2).sum(axis=1))
        far[ids == query_ids[i]] = np.inf
        best = np.arange(len(far))
        if len(far) > k:
            best = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1])
        best = best[np.isfinite(far[best])]
        best = best[np.lexsort((ids[best], far[best]))][:k]
        who.append(np.full(len(best), i))
        where.append(best)
        score.append(far[best])
    none = np.zeros(0, np.int64)
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else none.astype(kind)
    return join(who, np.int64), join(where, np.int64), join(score, np.float64)


def _compared(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k nearest of a block of vectors for each of a block of queries, in the leaves the query
    visits and within its distance."""
    parts = []
    if vectors.num_rows and queries.num_rows:
        x, ids = _matrix(vectors.column("vec")), vectors.column("id").to_numpy()
        leaf = vectors.column("leaf").to_numpy()
        in_leaf = {n: np.flatnonzero(leaf == n) for n in np.unique(leaf)}
        none = np.zeros(0, np.int64)
        query_ids, q = queries.column("query").to_numpy(), _matrix(queries.column("vec"))
        within = queries.column("within").to_numpy()
        for i, leaves in enumerate(queries.column("leaves").to_pylist()):
            at = np.concatenate([in_leaf.get(n, none) for n in leaves])
            _, where, score = _nearest(query_ids[i : i + 1], q[i : i + 1], ids[at], x[at], k)
            near = score <= within[i]
            parts.append((np.full(near.sum(), query_ids[i]), ids[at][where[near]], score[near]))
    kinds = {"query": pa.int64(), "id": pa.int64(), "score": pa.float64()}
    columns = zip(*parts, strict=True) if parts else ([np.zeros(0)],) * 3
    return pa.table({n: pa.array(np.concatenate(c), t) for (n, t), c in zip(kinds.items(), columns, strict=True)})


def _true_neighbours(
    batches: Iterator[pa.RecordBatch], query_ids: np.ndarray, queries: np.ndarray, k: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy()
        who, where, score = _nearest(query_ids, queries, ids, _matrix(batch.column("vec")), k)
        leaf = batch.column("leaf").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(who, pa.int64()),
                pa.array(ids[where], pa.int64()),
                pa.array(score, pa.float64()),
                pa.array(leaf[where], pa.int64()),
            ],
            names=["query", "id", "score", "leaf"],
        )


# ---- jobs ---------------------------------------------------------------------


def usable(vec: str | Column) -> Column:
    """No null or non-finite component, and not all zero."""
    x = F.col(vec) if isinstance(vec, str) else vec
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _sampled(vectors: DataFrame, n: int) -> pa.Table:
    """The n rows with the smallest hashes."""
    return vectors.orderBy(F.xxhash64("id", "vec"), "id").limit(n).toArrow()


class AnnIndex:
    """A fitted tree, and a table of all vectors with their leaves."""

    def __init__(
        self,
        vectors: DataFrame,
        id_col: str = "vec_id",
        vec_col: str = "embedding",
        leaf_rows: int = LEAF_ROWS,
        most_leaves: int = MOST_LEAVES,
        block_rows: int = BLOCK_ROWS,
    ):
        self.block_rows = block_rows
        rows = vectors.select(
            F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")
        ).where(F.col("id").isNotNull() & usable("vec"))
        sizes = rows.groupBy(F.size("vec").alias("size")).agg(F.count(F.lit(1)).alias("n"))
        first = sizes.orderBy(F.desc("n"), "size").first()
        self.dim, self.n = (first["size"], first["n"]) if first else (1, 0)
        rows = rows.where(F.size("vec") == self.dim)
        leaves = min(most_leaves, max(1, math.ceil(self.n / leaf_rows)))
        sample = _matrix(_sampled(rows, leaves * SAMPLE_PER_LEAF).column("vec"))
        self.tree = Tree(sample if self.n else np.zeros((1, 1)), leaves)
        tree = self.tree
        self.table = C.written(
            rows.mapInArrow(lambda b: _indexed(b, tree), "leaf long, id long, vec array<double>"),
            "ann-index",
        )
        self.rows = np.zeros(max(tree.n_leaves, 1), np.int64)
        for leaf, n in self.table.groupBy("leaf").count().collect():  # one row per leaf
            self.rows[leaf] = n

    def calibrate(self, k: int, target: float = TARGET_RECALL, queries: int = CALIBRATION) -> int:
        """Leaves to visit so that ``target`` of the true neighbours of sampled queries are in them."""
        sample = _sampled(self.table.select("id", "vec"), queries)
        ids, asked = sample.column("id").to_numpy(), _matrix(sample.column("vec"))
        if not len(ids):
            return 1
        found = self.table.mapInArrow(
            lambda b: _true_neighbours(b, ids, asked, k), "query long, id long, score double, leaf long"
        )
        place = [{leaf: n for n, leaf in enumerate(self.tree.visits(q))} for q in asked]
        needed = [place[r["query"]][r["leaf"]] + 1 for r in _top(found, k).collect()]
        if not needed:
            return 1
        return sorted(needed)[math.ceil(target * len(needed)) - 1]

    def _groups(self) -> tuple[np.ndarray, dict[int, int]]:
        """The group of each leaf, and the rows of each group: leaves side by side up to about a block."""
        before = np.concatenate([[0], np.cumsum(self.rows)[:-1]])
        _, group = np.unique(before // self.block_rows, return_inverse=True)
        return group, {g: int(self.rows[group == g].sum()) for g in range(int(group.max()) + 1)}

    def search(self, queries: DataFrame, k: int = NEIGHBOURS, visits: int | None = None) -> DataFrame:
        """``query``, ``rank``, ``id`` and ``score`` of the k nearest found for each row (id, vec)."""
        visits = self.calibrate(k) if visits is None else visits
        tree, rows, size, spark = self.tree, self.rows, self.block_rows, queries.sparkSession
        group, held = self._groups()
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        of_leaf = F.get(F.array(*[F.lit(int(g)) for g in group]), F.col("leaf").cast("int")).cast("long")
        vectors = self.table.withColumn("group", of_leaf)
        best = spark.createDataFrame([], "query long, id long, score double, rank int")
        start, stop = 0, FIRST_VISITS
        while start < len(rows):
            span = (start, stop if stop < visits else len(rows))
            # the k-th distance so far; what is farther off is not returned
            kth = best.where(F.col("rank") == k).select(F.col("query").alias("of"), "score")
            asking = queries.join(kth, F.col("id") == F.col("of"), "left").select(
                "id", "vec", F.coalesce("score", F.lit(float("inf"))).alias("within")
            )
            asked = C.written(
                asking.mapInArrow(
                    lambda b, span=span: _asked(b, tree, rows, group, span, visits, k),
                    "group long, leaves array<long>, query long, vec array<double>, within double",
                ),
                "ann-asked",
            )
            waiting = {r["group"]: r["count"] for r in asked.groupBy("group").count().collect()}
            cut = lambda n: max(1, math.ceil(n / size))
            cuts = [(g, cut(n), cut(waiting.get(g, 0))) for g, n in held.items() if g in waiting]
            # one row per group of leaves, a few thousand at most
            cuts = spark.createDataFrame(cuts, "group long, blocks long, query_blocks long")
            theirs = vectors.join(F.broadcast(cuts), "group").select(
                "group",
                "leaf",
                "id",
                "vec",
                F.pmod(F.xxhash64("id", "vec"), "blocks").alias("block"),
                every("query_blocks").alias("query_block"),
            )
            asked = asked.join(F.broadcast(cuts), "group").select(
                "group",
                "leaves",
                "query",
                "vec",
                "within",
                every("blocks").alias("block"),
                F.pmod(F.xxhash64("query"), "query_blocks").alias("query_block"),
            )
            keys = ("group", "block", "query_block")
            found = (
                theirs.groupBy(*keys)
                .cogroup(asked.groupBy(*keys))
                .applyInArrow(lambda v, q: _compared(v, q, k), "query long, id long, score double")
            )
            best = C.written(_top(best.drop("rank").unionByName(found), k), "ann-best")
            start, stop = span[1], span[1] * WIDEN
        return best.select("query", "rank", "id", "score")


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = NEIGHBOURS,
    **settings,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k nearest of the rows that ``queries`` picks."""
    index = AnnIndex(vectors, id_col, vec_col, **settings)
    picked = vectors.where(queries).select(F.col(id_col).cast("long").alias("id"))
    asking = (
        index.table.join(picked.distinct(), "id", "left_semi").groupBy("id").agg(F.min("vec").alias("vec"))
    )
    return index.search(asking, k).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )
