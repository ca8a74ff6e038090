"""Exact top-k inner products by norm-sorted search with pruning.

All vectors are rotated by the eigenvectors of their second-moment matrix (the
right singular vectors of the table), which keeps inner products and moves
most of each vector's length into its first components. Candidates are met by
descending length. For a block of queries:

* no later candidate can enter once |query| * |candidate| is under the k-th
  score so far (Cauchy-Schwarz), which ends the search;
* before that, the partial sum over the first rotated components plus the
  product of both residual lengths bounds the score from above, and only
  candidates over the k-th score are scored in whole, in integers.

Bounds are floating point and are widened by a margin above their rounding
error, so nothing is pruned wrongly. A task holds one block of queries and
streams its share of the candidates in order; the best k of the shares are
merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import checkpointed, prepare

QUERY_BLOCK = 512      # queries that one task holds
CANDIDATE_SHARE = 65_536  # candidates of one share, about
HEAD = 16              # rotated components of the first bound
STEP = 1024            # candidates met at once
EXACT = float(1 << 53)  # integers under this are exact in floating point
RESULT = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                    scale: float = 64.0) -> DataFrame:
    """vec_id, v (array of bigint: floor(scale * x) of each component). Rows
    with a null id, a null vector, or a null or non-finite component are left
    out, and so are empty vectors."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.coalesce(finite, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Orthogonal matrix of the eigenvectors of sum(v v^T), largest first. Each
    task sums its own rows; dims x dims numbers reach the driver per task group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            m = _matrix(batch.column(0)).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["at", "x"])

    sums = vectors.select("v").mapInArrow(run, "at bigint, x double").groupBy("at").agg(F.sum("x").alias("x"))
    at, x = np.zeros(dims * dims, np.int64), np.zeros(dims * dims)
    for i, row in enumerate(sums.collect()):
        at[i], x[i] = row["at"], row["x"]
    moment = np.zeros(dims * dims)
    moment[at] = x
    values, axes = np.linalg.eigh(moment.reshape(dims, dims))
    return axes[:, np.argsort(-values)]


class _Block:
    """A block of queries with the k best so far of each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray, k: int, head: int):
        self.ids, self.q, self.k, self.head, self.axes = ids, vectors, k, head, axes
        rotated = vectors.astype(np.float64) @ axes
        self.first, self.norm = rotated[:, :head], np.sqrt((rotated ** 2).sum(axis=1))
        self.rest = np.sqrt((rotated[:, head:] ** 2).sum(axis=1))
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]  # scores, ids
        self.least = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> bool:
        """Look at candidates, the longest first. False: no later one can enter."""
        rotated = vectors.astype(np.float64) @ self.axes
        norm = np.sqrt((rotated ** 2).sum(axis=1))
        margin = 1e-9 * (1 + self.norm * norm.max())
        live = self.norm * norm.max() + margin >= self.least
        if not live.any():
            return False
        rest = np.sqrt((rotated[:, self.head:] ** 2).sum(axis=1))
        bound = self.first[live] @ rotated[:, :self.head].T + self.rest[live][:, None] * rest[None, :] + margin[live][:, None]
        least = self.least[live][:, None]
        near = bound >= least
        wanted = near.any(axis=0)
        if wanted.any():
            scores = self._scores(live, vectors[wanted], norm[wanted].max())
            enters = near[:, wanted] & (scores >= least) & (self.ids[live][:, None] != ids[wanted][None, :])
            for row in np.flatnonzero(enters.any(axis=1)):
                self._enter(np.flatnonzero(live)[row], ids[wanted][enters[row]], scores[row, enters[row]].astype(np.int64))
        return True

    def _scores(self, live: np.ndarray, vectors: np.ndarray, norm: float) -> np.ndarray:
        """Whole scores; through floating point only where that is exact."""
        if self.norm[live].max() * norm < EXACT:
            return self.q[live].astype(np.float64) @ vectors.astype(np.float64).T
        return self.q[live] @ vectors.T

    def _enter(self, at: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores, ids = np.concatenate([self.best[at][0], scores]), np.concatenate([self.best[at][1], ids])
        order = np.lexsort((ids, -scores))
        if len(set(ids.tolist())) < len(ids):  # rows that share an id count once
            order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
        order = order[:self.k]
        self.best[at] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[at] = scores[order[-1]]

    def rows(self) -> pa.RecordBatch:
        n = [len(s) for s, _ in self.best]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, n)), pa.array(np.concatenate([i for _, i in self.best])),
             pa.array(np.concatenate([s for s, _ in self.best]))], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int = 20, *, query_block: int = QUERY_BLOCK,
          candidate_share: int = CANDIDATE_SHARE, head: int = HEAD) -> DataFrame:
    """The k highest inner products of each query with every other vector.

    ``vectors``: vec_id, v (equal sizes), as from :func:`integer_vectors`;
    ``is_query``: condition for the rows that are queries. Returns query_id,
    rank (from 1), vec_id, score; ties go to the smaller vec_id. All others, if
    fewer than k. Rows with the query's own vec_id aren't its candidates; if a
    vec_id has several rows, its best row counts, once. Vectors of
    different sizes raise an error. Scores must fit in 64 bits.
    An empty table gives no rows.
    """
    spark = vectors.sparkSession
    prepare(spark)
    vectors = checkpointed(vectors.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c))
                           .withColumn("query", is_query))
    sizes = vectors.select(F.size("v").alias("d")).groupBy("d").count().limit(2).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if len(sizes) > 1:
        raise ValueError("vectors differ in size")
    dims = sizes[0]["d"]
    axes = rotation(vectors, dims)
    counts = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if("query").alias("q")).first()
    blocks, shares = (max(1, -(-counts[c] // size)) for c, size in (("q", query_block), ("n", candidate_share)))

    # A task's rows: its queries first (place -1), then candidates by descending length.
    asked = vectors.where("query").select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"),
                                          F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
                                          F.lit(0).alias("kind"), F.lit(0.0).alias("place"), "vec_id", "v")
    met = vectors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
                         F.pmod(F.xxhash64(F.col("vec_id"), F.lit(1)), F.lit(shares)).cast("int").alias("share"),
                         F.lit(1).alias("kind"), (-F.col("norm")).alias("place"), "vec_id", "v")
    tasks = blocks * shares
    dealt = (asked.unionAll(met).withColumn("task", F.col("block") * shares + F.col("share"))
             .repartition(max(1, min(tasks, 4096)), "task").sortWithinPartitions("task", "kind", "place", "vec_id")
             .select("task", "kind", "vec_id", "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block, done = None, [], None, False

        def opened():
            ids = np.concatenate([np.asarray(b.column(2)) for b in held])
            return _Block(ids, np.concatenate([_matrix(b.column(3)) for b in held]), axes, k, head)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            task, kind = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            cuts = np.flatnonzero(np.r_[True, (task[1:] != task[:-1]) | (kind[1:] != kind[:-1])])
            for at, end in zip(cuts, [*cuts[1:], len(task)], strict=True):
                if task[at] != now:
                    if block:
                        yield block.rows()
                    now, held, block, done = task[at], [], None, False
                if kind[at] == 0:
                    held.append(batch.slice(at, end - at))
                    continue
                if not held:
                    continue  # no query fell into this block
                block = block or opened()
                for a in range(at, end, STEP):
                    if done:
                        break
                    part = table.slice(a, min(STEP, end - a)).combine_chunks().to_batches()[0]
                    done = not block.meet(np.asarray(part.column(2)), _matrix(part.column(3)))
        if block:
            yield block.rows()

    shares_best = dealt.mapInArrow(run, RESULT).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (shares_best.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
