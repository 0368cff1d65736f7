"""Exact top-k search by columnar branch and bound.

Vectors are packed into blocks in vertical layout (one run of values for each
dimension).  A block of candidates meets a group of queries; inner products are
accumulated a block of dimensions at a time, the heaviest dimensions first.
After each, the mass that remains (the product of the norms over the dimensions
to come) bounds each candidate's score from both sides; candidates that cannot
reach a query's k-th best are dropped and the survivors compacted.  A task keeps
the best of each query over all blocks it sees and passes on only those, so the
bounds tighten as it goes and the final ranking reads k rows for a query and
task.

The blocks of the stated query set and of all rows are paired as rows of
blocks; memory is bounded by the two block sizes.

Values are floor(1024 * x) with x as double; products are exact: in doubles
where they stay below 2**53, else in Python integers (a score beyond a long is
given as the nearest long).

Defined cases: a vector takes no part if it or a component is null, or if
1024 * x is not finite; a query meets only vectors of its own length; every row
for which the condition holds asks, also if others have its vec_id, and meets
every row but itself; a null vec_id takes no part; equal rows are separate
queries and candidates; ties go to the smaller vec_id; an empty table gives an
empty result.

A query's own row is not looked for among the candidates: one more than k are
kept, and one that has the query's vec_id and its own product goes, if any of them
does.  (If none does, the own row ranks below them all; if several do, they are
alike in the result.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar_feeds.llm.common import kept, table

K = 10
SCALE = 1024
#: Vectors in a block of candidates and in a group of queries.
BLOCK, GROUP = 4096, 4096
DIMENSIONS = 16
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1

_PACKED = "dim int, ids binary, data binary"
_FOUND = "ask long, vec_id long, score long, own long"


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < float("inf")))


def pack(size: int):
    """Rows of packed blocks from rows (vec_id, embedding)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def row(dim: int) -> pa.RecordBatch:
            ids, vectors = zip(*held.pop(dim), strict=True)
            data = np.floor(np.array(vectors, dtype=np.float64).reshape(len(ids), dim) * SCALE).T
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()),
                 pa.array([np.ascontiguousarray(data).tobytes()], pa.binary())], ["dim", "ids", "data"])

        for rb in batches:
            lists = rb["embedding"]
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(int)
            for i, vec in enumerate(rb["vec_id"].to_pylist()):
                v = values[ends[i]:ends[i + 1]]
                held.setdefault(len(v), []).append((vec, v))
                if len(held[len(v)]) >= size:
                    yield row(len(v))
        for dim in list(held):
            yield row(dim)

    return run


class Best:
    """The best k of each query of one group, over the blocks seen so far."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, k: int, dimensions: int, exclude: bool = True):
        """``exclude``: a query's id is no candidate for it."""
        self.exclude = exclude
        self.ids, self.queries, self.k, self.dimensions = ids, data.T, k, dimensions
        self.scores: list = [np.empty(0)] * len(ids)
        self.found: list = [np.empty(0, np.int64)] * len(ids)
        self.most = np.abs(data).max(initial=0)

    def add(self, ids: np.ndarray, data: np.ndarray, batch: int = 128) -> None:
        dim = len(data)
        if dim == 0 or self.most * np.abs(data).max(initial=0) * dim < _EXACT:
            order = np.argsort(-(data * data).sum(1), kind="stable")
            x, q = data[order], self.queries[:, order]
            cuts = [*range(self.dimensions, dim, self.dimensions), dim]
            rest_x = [np.sqrt((x[c:] ** 2).sum(0)) for c in cuts]
            rest_q = [np.sqrt((q[:, c:] ** 2).sum(1)) for c in cuts]
            for a in range(0, len(q), batch):
                first = q[a:a + batch, :cuts[0]] @ x[:cuts[0]]
                for j, partial in enumerate(first):
                    self._branch(a + j, ids, partial, x, q[a + j], cuts, rest_x, [r[a + j] for r in rest_q])
        else:
            exact = np.array([[int(v) for v in row] for row in data], dtype=object)
            for i, row in enumerate(self.queries):
                other = self._others(i, ids)
                score = np.array([int(v) for v in row], dtype=object) @ exact
                self._merge(i, score[other], ids[other])

    def own(self) -> list[int]:
        """Each query's product with itself, at most a long."""
        if self.queries.shape[1] * self.most * self.most < _EXACT:
            return [int(x) for x in (self.queries * self.queries).sum(1)]
        return [min(_LONG, sum(int(x) ** 2 for x in q)) for q in self.queries]

    def _others(self, i: int, ids: np.ndarray) -> np.ndarray:
        return ids != self.ids[i] if self.exclude else np.ones(len(ids), bool)

    def _branch(self, i: int, ids, partial, x, q, cuts, rest_x, rest_q) -> None:
        alive = np.flatnonzero(self._others(i, ids))
        partial = partial[alive]
        for b, cut in enumerate(cuts):
            if b:
                partial = partial + q[cuts[b - 1]:cut] @ x[cuts[b - 1]:cut, alive]
            room = rest_x[b][alive] * (rest_q[b] * (1 + 1e-9)) + (1e-3 if cut < len(x) else 0)
            least = self.scores[i][-1] if len(self.scores[i]) == self.k else -np.inf
            if len(alive) > self.k:
                low = partial - room
                least = max(least, np.partition(low, len(low) - self.k)[len(low) - self.k])
            stay = partial + room >= least
            alive, partial = alive[stay], partial[stay]
            if not len(alive):
                return
        self._merge(i, partial, ids[alive])

    def _merge(self, i: int, scores, ids) -> None:
        scores = np.concatenate((self.scores[i], scores)) if len(self.scores[i]) else scores
        ids = np.concatenate((self.found[i], ids))
        if scores.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda j: (-int(scores[j]), ids[j]))[:self.k], dtype=int)
        else:
            order = np.lexsort((ids, -scores))[:self.k]
        self.scores[i], self.found[i] = scores[order], ids[order]


def search(vectors: DataFrame, asks: Column, k: int = K, block: int = BLOCK, group: int = GROUP,
           dimensions: int = DIMENSIONS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of ``vectors``
    (vec_id, embedding) for each row for which ``asks`` holds; rows of one id
    that ask have their results side by side."""
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), "embedding").where(
        usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    # the queries are numbered and written, once
    queries = kept(rows.where(asks).withColumn("ask", F.monotonically_increasing_id()), "topk-queries")
    asked = kept(queries.select(F.col("ask").alias("vec_id"), "embedding").mapInArrow(pack(group), _PACKED)
                 .toDF("q_dim", "q_ids", "q_data"), "topk-groups")
    pairs = rows.mapInArrow(pack(block), _PACKED).crossJoin(asked)  # rows of blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, Best] = {}
        for rb in batches:
            for dim, ids, data, q_dim, q_ids, q_data in zip(*(rb[c].to_pylist() for c in ("dim", "ids", "data", "q_dim", "q_ids", "q_data")), strict=True):
                if dim == q_dim:
                    n, m = len(ids) // 8, len(q_ids) // 8
                    key = (dim, q_ids)
                    if key not in best:
                        best[key] = Best(np.frombuffer(q_ids, np.int64), np.frombuffer(q_data, np.float64).reshape(dim, m), k + 1, dimensions, exclude=False)
                    best[key].add(np.frombuffer(ids, np.int64), np.frombuffer(data, np.float64).reshape(dim, n))
        for b in best.values():
            out = [(int(q), int(v), max(-_LONG, min(_LONG, int(s))), own) for q, own, ss, vs in zip(b.ids, b.own(), b.scores, b.found, strict=True)
                   for s, v in zip(ss, vs, strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["ask", "vec_id", "score", "own"])

    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    best = pairs.mapInArrow(run, _FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    asks_as = queries.select("ask", F.col("vec_id").alias("query_id"))
    mine = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    # of those alike, the first is taken for the row itself
    found = best.join(asks_as, "ask").withColumn("self", F.min(F.when(mine, F.col("rank"))).over(Window.partitionBy("ask")))
    after = F.col("self").isNotNull() & (F.col("rank") > F.col("self"))
    return (found.where(F.col("self").isNull() | (F.col("rank") != F.col("self")))
            .withColumn("rank", F.when(after, F.col("rank") - 1).otherwise(F.col("rank")).cast("int"))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def op6_topk_search(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP6_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.id, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.id <> c.id
  WHERE q.vec_id % 100 = 0),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
