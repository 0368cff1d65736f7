import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from registrar_feeds.llm import topk_search as S

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, every=10, k=5):
    """Each row whose id is divisible by ``every`` asks, against every row but itself."""
    ok = [(v, [math.floor(Fraction(x) * 1024) for x in e]) for v, e in rows
          if v is not None and e is not None and all(x is not None and math.isfinite(x) and math.isfinite(x * 1024) for x in e)]
    out = []
    for i, (v, q) in enumerate(ok):
        if v % every == 0:
            found = sorted((-max(-S._LONG, min(S._LONG, sum(a * b for a, b in zip(q, c)))), w)
                           for j, (w, c) in enumerate(ok) if j != i and len(c) == len(q))
            out += [(v, r + 1, w, -s) for r, (s, w) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, every=10, k=5, schema=SCHEMA, **options):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return sorted(tuple(r) for r in S.search(df, F.col("vec_id") % every == 0, k, **options).collect())


@pytest.mark.parametrize("options", [{}, {"block": 17, "group": 3, "dimensions": 4}])
def test_equals_brute_force(spark, options):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(300)] + [(300 + i, [0.5] * 24) for i in range(40)]
    assert run(spark, rows, **options) == brute(rows)


def test_edge_cases(spark):
    rows = [(0, [1.0, 2.0]), (0, [0.5, 9.0]), (10, None), (20, [None, 1.0]), (30, [float("nan"), 1.0]), (40, [float("inf"), 0.0]),
            (None, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (50, [1.0]), (51, [2.0]), (60, []), (61, []),
            (70, [1e18, -1e18]), (71, [1e18, 1e18]), (72, [-1e300, 0.0]), (-10, [-0.0001, 0.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [], schema=SCHEMA) == []
    assert run(spark, rows[10:11]) == []


def test_repeated_ids_and_extra_columns(spark):
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 30)), rng.integers(-2, 3, 6).astype(float).tolist()) for _ in range(120)]
    rows += [(20, [0.0] * 6)] * 8 + rows[:10]
    assert len({v for v, _ in rows if v % 10 == 0}) < len([v for v, _ in rows if v % 10 == 0])
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, k=200, block=7, group=2) == brute(rows, k=200)
    more = [(*r, 1, 2, "x", None, 3) for r in rows]
    clash = SCHEMA + ", query_id long, rank int, ask string, score double, own long"
    assert run(spark, more, schema=clash) == brute(rows)


def test_two_rows_of_one_id_ask_and_meet_each_other(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (7, [0.5, 0.5])]
    one, half = 1024 * 1024, 1024 * 512
    assert run(spark, rows) == sorted([(0, 1, 7, half), (0, 2, 0, 0), (0, 1, 7, half), (0, 2, 0, 0)])
    assert run(spark, rows[:1] * 2) == [(0, 1, 0, one)] * 2


def test_bounds_drop_candidates_early():
    rng = np.random.default_rng(0)
    data = np.floor(rng.normal(size=(64, 500)) * 1024 * np.linspace(2, 0.01, 64)[:, None])
    best = S.Best(np.array([0]), data[:, :1], 5, 16)
    sizes = []
    merge = best._merge
    best._merge = lambda i, scores, ids: (sizes.append(len(ids)), merge(i, scores, ids))
    best.add(np.arange(500), data)
    assert sizes[0] < 100
    want = np.lexsort((np.arange(500), -(data[:, 0] @ data)))
    assert best.found[0].tolist() == [i for i in want.tolist() if i][:5]
