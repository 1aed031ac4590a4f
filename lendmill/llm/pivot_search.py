"""Exact top-k inner products by pivot-table elimination.

Components become integers, so scores are exact. A bounded sample gives the pivots: the
origin, then each time the sampled vector farthest from all pivots so far. The index holds
every vector's distance to every pivot. For a query q and a candidate x the triangle
inequality bounds their distance from below by the largest difference of their distances to
a pivot, and with it their inner product from above, (|q|^2 + |x|^2 - d^2) / 2; the origin
as a pivot makes this at least as sharp as |q||x|. Candidates are evaluated in order of
that bound, and a query stops when the next bound is below the k-th score it has.

How it runs: vectors lie in blocks of bounded size, cut from the cells of the nearest pivot;
a hot cell, or a vector that a third of all rows repeat, is many blocks. So do the
queries. A block is one packed row that also knows the least and largest distance to each
pivot, which bounds a pair of blocks as a whole. Each block of queries meets the blocks of
vectors in the order of those bounds, in rounds that reach four times as far each: the first
block, three more, twelve more and so on. A pair of blocks whose bound is below the least
k-th score of its queries is never sent, and a task returns only what beats the score that
its query already has, so the rows returned stay near 3k a query and round whatever
the table's size. Pairs of blocks left are compared in a task each.
All that reaches the driver are the sample, the rows per cell and their counts.

Where no pivot tells vectors apart (independent components in many dimensions), little is
eliminated, and the search is what exact search is then: the query set against all rows, in blocks.

Defined results: a vector takes no part that is null, holds null or non-finite components,
has no id, another length than most, or a component so large that scores could leave 64
bits; a zero vector does. Every row of the query set asks for itself, so of repeated
rows each does, and the others are its candidates. Ties go to the smaller id. Fewer
candidates than k: all of them. Empty table: empty.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm.columns import written
from lendmill.llm.shipping import by_value

by_value(__name__)

BEST = 5
SCALE = 256

#: Pivots, and sampled rows they are chosen from.
PIVOTS = 64
SAMPLE = 4096

#: Rows aimed at in a block of vectors and in a block of queries; queries bounded at a time.
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
AT_A_TIME = 32

#: How much farther a round reaches, and candidates evaluated before the first look at the bound.
WIDEN = 4
FIRST_LOOK = 128

#: Distances are rounded to 32 bits and differences of large numbers; bounds give way by this share.
SLACK = 1e-6

_BLOCK = "block long, rows long, tag binary, id binary, x binary, far binary, low array<double>, high array<double>, norm double"
_FOUND = "query_block long, tag long, query long, id long, score long"


def whole(vec: str | Column, scale: int = SCALE) -> Column:
    """floor(scale * component) in double precision; null unless all components are finite numbers."""
    x = F.col(vec) if isinstance(vec, str) else vec
    x = x.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(finite, F.transform(x, lambda v: F.floor(v * scale)))


# ---- pivots and blocks --------------------------------------------------------


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """The origin and up to n - 1 sampled vectors, each the farthest from those before it."""
    pivots = [np.zeros(sample.shape[1])]
    far = np.full(len(sample), np.inf)
    while len(pivots) < n and len(sample):
        far = np.minimum(far, ((sample - pivots[-1]) ** 2).sum(axis=1))
        if far.max() <= 0:
            break
        pivots.append(sample[far.argmax()])
    return np.array(pivots)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), dim)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    square = (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)
    return np.sqrt(np.maximum(square, 0)).astype(np.float32)


def _indexed(batches, pivots: np.ndarray, cells: int):
    """Each row with its distances to the pivots and its cell, the nearest of the first pivots."""
    for batch in batches:
        far = _distances(_matrix(batch.column("x"), pivots.shape[1]), pivots)
        near = far[:, 1 : cells + 1] if far.shape[1] > 1 else far
        cell = near.argmin(axis=1) if len(far) else np.zeros(0)
        flat = pa.ListArray.from_arrays(np.arange(len(far) + 1) * far.shape[1], far.ravel())
        names = ["id", "asks", "x", "far", "cell"]
        columns = [batch.column(n) for n in names[:3]]
        yield pa.RecordBatch.from_arrays([*columns, flat, pa.array(cell.astype(np.int64))], names=names)


def _packed(rows: pa.Table, dim: int, n_pivots: int) -> pa.Table:
    """A block as one row."""
    x, far = _matrix(rows.column("x"), dim).astype(np.int32), _matrix(rows.column("far"), n_pivots)
    norm = math.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max())
    return pa.table(
        {
            "block": [rows.column("block")[0].as_py()],
            "rows": [len(x)],
            "tag": [rows.column("tag").to_numpy().astype(np.int64).tobytes()],
            "id": [rows.column("id").to_numpy().astype(np.int64).tobytes()],
            "x": [x.tobytes()],
            "far": [far.astype(np.float32).tobytes()],
            "low": [far.min(axis=0).astype(float).tolist()],
            "high": [far.max(axis=0).astype(float).tolist()],
            "norm": [norm],
        }
    )


class Block:
    """A packed row, unpacked."""

    def __init__(self, row: dict):
        self.tag, self.id = (np.frombuffer(row[c], np.int64) for c in ("tag", "id"))
        n = len(self.id)
        self.x = np.frombuffer(row["x"], np.int32).reshape(n, -1).astype(np.int64)
        self.far = np.frombuffer(row["far"], np.float32).reshape(n, -1)
        self.square = (self.x.astype(np.float64) ** 2).sum(axis=1)


# ---- work inside tasks --------------------------------------------------------


def bounds(queries: Block, at: slice, vectors: Block) -> np.ndarray:
    """An upper bound of the score of each of some queries with each vector."""
    q = queries.far[at]
    apart = np.zeros((len(q), len(vectors.far)), np.float32)
    for ours, theirs in zip(q.T, vectors.far.T, strict=True):
        np.maximum(apart, np.abs(ours[:, None] - theirs[None, :]), out=apart)
    squares = queries.square[at][:, None] + vectors.square[None, :]
    # no pivot is farther off than the vectors' own distances to the origin say, times two
    slack = SLACK * (queries.far[at].max(axis=1)[:, None] + vectors.far.max(axis=1)[None, :])
    slack = slack + SLACK * np.sqrt(squares)
    apart = np.maximum(apart.astype(np.float64) - slack, 0)
    return (squares - apart**2) / 2 + SLACK * squares / 1000 + 1


def best_of(
    queries: Block, vectors: Block, known: dict[int, tuple[int, int]], k: int
) -> tuple[list[tuple[int, int, int]], int]:
    """(place of the query, place of the vector, score) of up to k per query that beat what is
    ``known`` for it, its k-th score and id by tag; and how many scores were evaluated."""
    out: list[tuple[int, int, int]] = []
    evaluated = 0
    largest = float(np.abs(queries.x).max(initial=0)) * float(np.abs(vectors.x).max(initial=0))
    in_double = largest * queries.x.shape[1] < 2**53
    vx = vectors.x.astype(np.float64) if in_double else vectors.x
    for start in range(0, len(queries.id), AT_A_TIME):
        at = slice(start, start + AT_A_TIME)
        for i, upper in enumerate(bounds(queries, at, vectors), start):
            q = queries.x[i].astype(vx.dtype)
            score, own = known.get(int(queries.tag[i]), (None, None))
            left = np.flatnonzero((upper >= score) if score is not None else np.full(len(upper), True))
            left = left[vectors.tag[left] != queries.tag[i]]
            left = left[np.argsort(-upper[left], kind="stable")]
            places, scores, look = np.zeros(0, np.int64), np.zeros(0, np.int64), FIRST_LOOK
            while len(left) and (score is None or upper[left[0]] >= score):
                now, left = left[:look], left[look:]
                look *= 2
                made = (vx[now] @ q).astype(np.int64)
                evaluated += len(now)
                if score is not None:
                    beats = (made > score) | ((made == score) & (vectors.id[now] < own))
                    now, made = now[beats], made[beats]
                places, scores = np.concatenate([places, now]), np.concatenate([scores, made])
                first = np.lexsort((vectors.id[places], -scores))[:k]
                places, scores = places[first], scores[first]
                if len(places) == k:
                    score, own = int(scores[-1]), int(vectors.id[places[-1]])
            out += [(i, int(p), int(s)) for p, s in zip(places, scores, strict=True)]
    return out, evaluated


def _compared(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    found: list = []
    q = v = None
    if vectors.num_rows and queries.num_rows:
        row = queries.to_pylist()[0]
        q, v = Block(row), Block(vectors.to_pylist()[0])
        known = {r["tag"]: (r["score"], r["id"]) for r in row["known"] or []}
        found, _ = best_of(q, v, known, k)
    who, where, score = (np.array([r[c] for r in found], np.int64) for c in range(3))
    pick = lambda side, values, at: getattr(side, values)[at] if len(at) else at
    block = queries.column("query_block")[0].as_py() if queries.num_rows else 0
    return pa.table(
        {
            "query_block": np.full(len(found), block, np.int64),
            "tag": pick(q, "tag", who),
            "query": pick(q, "id", who),
            "id": pick(v, "id", where),
            "score": score,
        }
    )


# ---- jobs ---------------------------------------------------------------------


def _cuts(counts: dict[int, int], cells: int, size: int, share: bool) -> tuple[list[int], list[int], int]:
    """First block and number of blocks of every cell; with ``share`` small cells share a block."""
    first, blocks, used, room = [], [], 0, 0
    for cell in range(cells):
        n = counts.get(cell, 0)
        if share and 0 < n <= room:
            first.append(used - 1)
            blocks.append(1)
            room -= n
            continue
        first.append(used)
        blocks.append(max(1, math.ceil(n / size)))
        if n:
            used += blocks[-1]
            room = size - n if n < size else 0
    return first, blocks, used


class PivotIndex:
    """The pivots, and a written table of all rows with their pivot distances."""

    def __init__(
        self,
        vectors: DataFrame,
        asks: Column,
        id_col: str = "vec_id",
        vec_col: str = "x",
        pivots: int = PIVOTS,
        block_rows: int = BLOCK_ROWS,
        query_rows: int = QUERY_ROWS,
    ):
        """``vec_col`` holds whole numbers, null where a vector takes no part; ``asks`` marks the queries."""
        rows = vectors.select(
            F.col(id_col).cast("long").alias("id"),
            F.coalesce(asks, F.lit(False)).alias("asks"),
            F.col(vec_col).cast("array<long>").alias("x"),
        ).where("id IS NOT NULL AND x IS NOT NULL")
        sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
        usual = sizes.orderBy(F.desc("n"), "size").first()
        self.dim, n = (usual["size"], usual["n"]) if usual else (0, 0)
        most = min(math.isqrt(2**62 // max(self.dim, 1)), 2**31 - 1)
        rows = rows.where((F.size("x") == self.dim) & F.forall("x", lambda v: v.between(-most, most)))
        sample = rows.orderBy(F.xxhash64("id", "x"), "id").limit(SAMPLE).select("x").toArrow()
        self.pivots = choose_pivots(_matrix(sample.column("x"), self.dim).astype(float), pivots)
        self.cells = max(1, min(len(self.pivots) - 1, math.ceil(n / block_rows)))
        self.block_rows, self.query_rows = block_rows, query_rows
        chosen, cells = self.pivots, self.cells
        indexed = rows.mapInArrow(
            lambda batches: _indexed(batches, chosen, cells),
            "id long, asks boolean, x array<long>, far array<float>, cell long",
        )
        self.table = written(indexed.withColumn("tag", F.monotonically_increasing_id()), "pivot-index")

    def _blocks(self, rows: DataFrame, size: int, share: bool) -> tuple[DataFrame, int]:
        """Rows packed into blocks, and the number of blocks."""
        counts = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}  # a row per pivot
        first, blocks, n = _cuts(counts, self.cells, size, share)
        of = lambda values: F.get(F.array(*map(F.lit, values)), F.col("cell").cast("int"))
        block = of(first) + F.pmod(F.xxhash64("tag"), of(blocks))
        dealt = rows.withColumn("block", block.cast("long"))
        dim, n_pivots = self.dim, len(self.pivots)
        packed = dealt.groupBy("block").applyInArrow(lambda t: _packed(t, dim, n_pivots), _BLOCK)
        return written(packed, "pivot-blocks"), n

    def _pairs(self, queries: DataFrame, vectors: DataFrame, n_queries: int) -> DataFrame:
        """For each block of queries the blocks of vectors, numbered by falling bound."""
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_queries, 1) - 1).cast("long")))
        v = vectors.select("block", "low", "high", "norm", every.alias("query_block"))
        q = queries.select(
            F.col("block").alias("query_block"),
            F.col("low").alias("q_low"),
            F.col("high").alias("q_high"),
            F.col("norm").alias("q_norm"),
        )
        above = F.array_max(F.zip_with("low", "q_high", lambda a, b: a - b))
        below = F.array_max(F.zip_with("q_low", "high", lambda a, b: a - b))
        size = F.col("norm") * F.col("norm") + F.col("q_norm") * F.col("q_norm")
        reach = F.array_max("high") + F.array_max("q_high") + F.sqrt(size)
        apart = F.greatest(F.lit(0.0), F.greatest(above, below) - SLACK * reach)
        upper = (size - apart * apart) / 2 + SLACK / 1000 * size + 1
        order = Window.partitionBy("query_block").orderBy(F.desc("upper"), "block")
        pairs = v.join(q, "query_block").select("query_block", "block", upper.alias("upper"))
        return written(pairs.withColumn("place", F.row_number().over(order) - 1), "pivot-pairs")

    def search(self, k: int = BEST) -> DataFrame:
        """``query``, ``rank``, ``id``, ``score``: the k best of every row that asks."""
        asking = self.table.where("asks")
        queries, n_queries = self._blocks(asking, self.query_rows, True)
        vectors, n_vectors = self._blocks(self.table, self.block_rows, False)
        pairs = self._pairs(queries, vectors, n_queries)
        asked = queries.select("block", "rows").withColumnsRenamed({"block": "query_block", "rows": "n"})
        queries = queries.withColumnRenamed("block", "query_block").select("query_block", "tag", "id", "x", "far")
        vectors = vectors.select("block", "tag", "id", "x", "far")
        spark = self.table.sparkSession
        best = spark.createDataFrame([], f"{_FOUND}, rank int")
        order = Window.partitionBy("tag").orderBy(F.desc("score"), "id")
        start, end = 0, 1
        while start < n_vectors:
            # the k-th of each query, at most a block's queries together
            kth = best.where(F.col("rank") == k).groupBy("query_block").agg(
                F.collect_list(F.struct("tag", "score", "id")).alias("known"),
                F.min("score").alias("least"),
                F.count(F.lit(1)).alias("full"),
            )
            round_ = pairs.where((F.col("place") >= start) & (F.col("place") < end))
            round_ = round_.join(asked, "query_block").join(kth, "query_block", "left")
            beaten = (F.col("full") == F.col("n")) & (F.col("upper") < F.col("least"))
            round_ = round_.where(~F.coalesce(beaten, F.lit(False)))
            ours = round_.select("query_block", "block", "known").join(queries, "query_block")
            pair = [F.col("query_block").alias("of"), F.col("block").alias("with")]
            theirs = round_.select(*pair).join(vectors, F.col("with") == F.col("block"))
            found = (
                theirs.groupBy("of", "with")
                .cogroup(ours.groupBy("query_block", "block"))
                .applyInArrow(lambda v, q: _compared(v, q, k), _FOUND)
            )
            found = best.drop("rank").unionByName(found)
            best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            best = written(best, "pivot-best")
            start, end = end, end * WIDEN
        return best.select("query", "rank", "id", "score")


def top_inner_products(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = BEST,
    scale: int = SCALE,
    **settings,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k best of every row that ``queries`` picks."""
    rows = vectors.select(
        F.col(id_col).alias("id"), queries.alias("asks"), whole(vec_col, scale).alias("x")
    )
    index = PivotIndex(rows, F.col("asks"), "id", "x", **settings)
    return index.search(k).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )
