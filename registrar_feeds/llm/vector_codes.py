"""Vector code compression: product quantisation with exact nearest entries.

Vectors become integers floor(SCALE * x) and are cut into equal consecutive
parts.  Each part position has a codebook, first the parts of the smallest
vec_ids; a round assigns every part to its nearest entry and moves the entries
to the floored means.  A vector's code is the list of its parts' entries.

The nearest entry is found in a geometric near-neighbour access tree (GNAT) over
the entries of a position: a node has a few split points far from each other,
the other entries belong to their nearest one, and for each pair of split point
and child the node holds the range of distances from the point to the child's
entries.  A query that lies at d from a split point can have no entry of the
child within r, its best distance so far, if d - r is above the range or d + r
below it; such a subtree is left out.  Distances in these tests are rounded so
that a subtree goes only if all of it is strictly farther; squared distances are
compared as integers, so ties go to the lower index.  Queries go down the tree
as arrays, a batch at a time.

A round is one pass over the vectors: a task passes on one count and one sum for
each component of the entries it used, at most entries x length rows however
many vectors it read.  The driver holds the codebooks alone (entries x length
integers).  The assigned rows are written once; the errors of a label are summed
before the shuffle and joined back, so a hot label is one row of each task.

Defined cases: a vector takes no part if it or a component is null or not
finite; a null vec_id is coded but never starts a codebook; of rows with equal
vec_ids the lesser vector comes first among the starting entries, and each one
counts; with fewer vectors than entries the codebooks are smaller; vectors of
another length than the first starting one have null code and error; a length
that PARTS does not divide is an error, as is a component whose integer has more
than 62 bits; sums beyond a long are given as the greatest long; null labels are
one label; equal rows are coded alike; an empty table gives an empty result.
Distances are exact at every size (int64, else Python integers).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar_feeds.llm.common import kept, table

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Split points of a node.
DEGREE = 8
_LONG = (1 << 63) - 1
_BITS = float(1 << 62)
#: Far above the rounding of a square root of an integer, far below any distance.
_ROUND = 2.0 ** -40


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))


def _squares(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``x`` to every point, as integers."""
    out = np.zeros((len(x), len(points)), x.dtype)
    for c in range(x.shape[1]):
        d = x[:, c, None] - points[None, :, c]
        out += d * d
    return out


class Gnat:
    """Tree over ``points``; ``index`` are the numbers that ties go by."""

    def __init__(self, points: np.ndarray, index: np.ndarray, degree: int = DEGREE):
        near = _squares(points, points[:1])[:, 0]
        splits = [0]
        while len(splits) < min(degree, len(points)):
            splits.append(next(i for i in np.argsort(-near, kind="stable") if i not in splits))
            near = np.minimum(near, _squares(points, points[splits[-1:]])[:, 0])
        rest = np.setdiff1d(np.arange(len(points)), splits)
        self.points, self.index = points[splits], index[splits]
        far = _squares(points[rest], self.points)
        home = far.argmin(1) if len(rest) else rest
        self.children = []
        for j in range(len(splits)):
            mine = rest[home == j]
            if len(mine):
                d = np.sqrt(far[home == j].astype(np.float64))
                self.children.append((d.min(0) * (1 - _ROUND), d.max(0) * (1 + _ROUND), Gnat(points[mine], index[mine], degree)))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance and index of the nearest point of each row."""
        best = np.full(len(x), (1 << 200) if x.dtype == object else _LONG, x.dtype)
        who = np.full(len(x), -1, np.int64)
        self._search(x, np.arange(len(x)), best, who)
        return best, who

    def _search(self, x: np.ndarray, rows: np.ndarray, best: np.ndarray, who: np.ndarray) -> int:
        """Returns the number of distances computed."""
        squares = _squares(x[rows], self.points)
        for i, name in enumerate(self.index):
            d = squares[:, i]
            closer = ((d < best[rows]) | ((d == best[rows]) & (name < who[rows]))).astype(bool)
            best[rows[closer]], who[rows[closer]] = d[closer], name
        seen = squares.size
        d = np.sqrt(squares.astype(np.float64))
        for low, high, child in self.children:
            r = np.sqrt(best[rows].astype(np.float64))[:, None] * (1 + _ROUND)
            out = (d * (1 - _ROUND) - high > r) | (low - d * (1 + _ROUND) > r)
            stay = rows[~out.any(1)]
            if len(stay):
                seen += child._search(x, stay, best, who)
        return seen


class Codebooks:
    """``entries``: integers by part, entry and position within the part."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.dim = entries.shape[0] * entries.shape[2]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.reshape(-1)).encode()).hexdigest()

    def assigner(self):
        """A function from integer vectors to (codes, squared distances), both
        one row a vector and one column a part."""
        parts, _, length = self.entries.shape
        most = max((abs(int(x)) for x in self.entries.reshape(-1)), default=0)
        trees: dict[type, list[Gnat]] = {}

        def assign(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            m = max(most, int(np.abs(x).max(initial=0)))
            kind = np.int64 if 4 * m * m * max(length, 1) < _LONG else object
            if kind not in trees:
                trees[kind] = [Gnat(p.astype(kind), np.arange(len(p))) for p in self.entries]
            found = [t.nearest(x[:, i * length:(i + 1) * length].astype(kind)) for i, t in enumerate(trees[kind])]
            return np.stack([w for _, w in found], 1), np.stack([d for d, _ in found], 1)

        return assign


def _integers(lists: pa.Array, dim: int, scale: int) -> np.ndarray:
    x = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).reshape(len(lists), dim)
    if np.abs(x).max(initial=0) >= _BITS:
        raise ValueError("a component has more than 62 bits")
    return x.astype(np.int64)


def _sums(books: Codebooks, scale: int):
    """Rows (at, n, total) of a task: number of parts and sum of components for
    each component ``at`` of the codebooks, entries in use only."""
    parts, entries, length = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = books.assigner()
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, length), object)
        for rb in batches:
            x = _integers(rb["embedding"], books.dim, scale)
            codes, _ = assign(x)
            wide = np.abs(x).max(initial=0) * max(len(x), 1) >= _BITS
            for p in range(parts):
                some = np.zeros((entries, length), object if wide else np.int64)
                mine = x[:, p * length:(p + 1) * length]
                np.add.at(some, codes[:, p], mine.astype(object) if wide else mine)
                total[p] += some.astype(object)
                n[p] += np.bincount(codes[:, p], minlength=entries)
        used = np.flatnonzero(np.repeat(n.reshape(-1), length))
        flat = total.reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(np.repeat(n.reshape(-1), length)[used], pa.int64()),
             pa.array([Decimal(int(flat[i])) for i in used], pa.decimal128(38, 0))], ["at", "n", "total"])

    return run


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of ``vectors`` (vec_id, embedding); None without a usable row."""
    rows = vectors.where(usable(F.col("embedding"))).select("vec_id", "embedding")
    ids = rows.where(F.col("vec_id").isNotNull()).orderBy("vec_id", "embedding")
    first = ids.limit(1).collect()
    if not first:
        return None
    dim = len(first[0]["embedding"])
    if dim % parts:
        raise ValueError(f"a vector of {dim} components has no {parts} equal parts")
    same = F.size("embedding") == dim
    seeds = ids.where(same).limit(entries).select("embedding").collect()
    start = _integers(pa.array([r[0] for r in seeds], pa.list_(pa.float64())), dim, scale)
    book = start.reshape(len(seeds), parts, dim // parts).transpose(1, 0, 2).astype(object)
    for _ in range(rounds):
        found = (rows.where(same).select("embedding").mapInArrow(_sums(Codebooks(book), scale), "at long, n long, total decimal(38,0)")
                 .groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
        book = book.copy()
        flat = book.reshape(-1)
        for r in found.collect():  # entries x length rows at most
            flat[r["at"]] = int(r["total"]) // r["n"]
    return Codebooks(book)


def compress(vectors: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """The usable rows of ``vectors`` (vec_id, label, embedding): vec_id, label,
    __code, __error."""
    rows = vectors.where(usable(F.col("embedding"))).select("vec_id", "label", "embedding")
    fields = [rows.schema["vec_id"], rows.schema["label"], T.StructField("__code", T.StringType()), T.StructField("__error", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = books.assigner()
        hexed = np.array([f"{i:02x}" for i in range(256)])
        for rb in batches:
            codes, squares = assign(_integers(rb["embedding"], books.dim, scale))
            total = squares.astype(object).sum(1) if len(squares) else []
            yield pa.RecordBatch.from_arrays(
                [rb["vec_id"], rb["label"], pa.array(["".join(r) for r in hexed[codes].tolist()], pa.string()),
                 pa.array([min(_LONG, int(t)) for t in total], pa.int64())], ["vec_id", "label", "__code", "__error"])

    same = F.size("embedding") == books.dim
    coded = rows.where(same).mapInArrow(run, T.StructType(fields))
    other = rows.where(~same).select("vec_id", "label", F.lit(None).cast("string").alias("__code"), F.lit(None).cast("long").alias("__error"))
    return coded.unionByName(other)


def op12_vector_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    books = train(vectors)
    if books is None:
        books = Codebooks(np.zeros((PARTS, 1, 0), object))
    coded = kept(compress(vectors, books), "codes")
    total = F.sum(F.col("__error").cast("decimal(20,0)"))
    labels = kept(coded.groupBy(F.col("label").alias("__label")).agg(
        F.when(total > _LONG, F.lit(_LONG)).otherwise(total).cast("long").alias("__sum")), "code-labels")
    return (coded.join(labels, F.col("label").eqNullSafe(F.col("__label")))
            .select("vec_id", F.col("__code").alias("code"), F.col("__error").alias("error"),
                    F.col("__sum").alias("label_error"), F.lit(books.digest()).alias("codebooks_sha256")))


def _assign_sql(book: str) -> str:
    return f"""SELECT id, p, k, d FROM (
  SELECT id, p, k, d, row_number() OVER (PARTITION BY id, p ORDER BY d, k) AS r
  FROM (SELECT v.id, v.p, b.k, sum((v.x - b.y) * (v.x - b.y)) AS d
        FROM v JOIN {book} b ON v.p = b.p AND v.i = b.i GROUP BY v.id, v.p, b.k)) WHERE r = 1"""


def _update_sql(book: str, assigned: str) -> str:
    return f"""SELECT b.p, b.k, b.i, CASE WHEN m.n IS NULL THEN b.y ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS y
  FROM {book} b LEFT JOIN (
    SELECT v.p, a.k, v.i, sum(v.x) AS s, count(*) AS n FROM v JOIN {assigned} a ON v.id = a.id AND v.p = a.p
    GROUP BY v.p, a.k, v.i) m ON b.p = m.p AND b.k = m.k AND b.i = m.i"""


OP12_SQL = f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT id, len(embedding) // 16 AS l, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS j FROM e),
v AS MATERIALIZED (SELECT id, j // l AS p, j % l AS i, floor(256 * x::DOUBLE)::HUGEINT AS x FROM c),
b0 AS MATERIALIZED (SELECT p, id - 1 AS k, i, x AS y FROM v WHERE id <= 64),
a0 AS MATERIALIZED ({_assign_sql("b0")}),
b1 AS MATERIALIZED ({_update_sql("b0", "a0")}),
a1 AS MATERIALIZED ({_assign_sql("b1")}),
b2 AS MATERIALIZED ({_update_sql("b1", "a1")}),
a2 AS MATERIALIZED ({_assign_sql("b2")}),
s AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, k, i)) AS h FROM b2),
r AS (SELECT id, string_agg(format('{{:02x}}', k), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY id),
f AS (SELECT e.vec_id, e.label, r.code, r.error FROM r JOIN e ON r.id = e.id),
t AS (SELECT label, sum(error)::BIGINT AS label_error FROM f GROUP BY label)
SELECT f.vec_id, f.code, f.error, t.label_error, s.h AS codebooks_sha256
FROM f JOIN t ON f.label IS NOT DISTINCT FROM t.label CROSS JOIN s
"""
