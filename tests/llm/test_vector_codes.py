import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from registrar_feeds.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """vec_id -> rows (code, error, label_error) and the digest, by plain loops."""
    ok = [(v, [math.floor(Fraction(x) * 256) for x in e], lab, e) for v, e, lab in rows
          if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    seeds = sorted(((v, e, z) for v, z, _, e in ok if v is not None), key=lambda s: s[:2])
    dim = len(seeds[0][2])
    size = dim // parts
    cut = lambda z: [z[p * size:(p + 1) * size] for p in range(parts)]
    first = [cut(z) for _, _, z in seeds if len(z) == dim][:entries]
    books = [[s[p] for s in first] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    same = [(v, cut(z), lab) for v, z, lab, _ in ok if len(z) == dim]

    def assign():
        return [[min((square(z[p], b), k) for k, b in enumerate(books[p])) for p in range(parts)] for _, z, _ in same]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [z[p] for (_, z, _), f in zip(same, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    total = {}
    for (_, _, lab), f in zip(same, found):
        total[lab] = total.get(lab, 0) + sum(d for d, _ in f)
    out = [(v, "".join(f"{k:02x}" for _, k in f), min(V._LONG, sum(d for d, _ in f)), lab) for (v, _, lab), f in zip(same, found)]
    out += [(v, None, None, lab) for v, z, lab, _ in ok if len(z) != dim]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((v, c, e, min(V._LONG, total[lab]) if lab in total else None, digest) for v, c, e, lab in out), key=str)


def run(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted((tuple(r) for r in V.op12_vector_codes(spark, str(tmp_path)).collect()), key=str)


def test_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(size=32) * rng.choice([0.02, 1.0])).tolist(), int(i) % 5 or None) for i in rng.permutation(300)]
    rows += [(300 + i, rows[0][1], 7) for i in range(50)]  # copies: ties between equal entries
    assert run(spark, tmp_path, rows) == brute(rows)


def test_edge_cases(spark, tmp_path):
    one, two = [0.5] * 16, [-0.001] * 16
    rows = [(1, one, 0), (1, two, 0), (1, one, None), (None, two, None), (2, None, 1), (3, [None] + one[1:], 1), (4, [float("nan")] + one[1:], 1),
            (5, [float("inf")] + one[1:], 1), (6, [1.0] * 8, 1), (7, [], 2), (8, [1e15] * 16, 3), (9, [-1e15, 3.0] * 8, 3), (9, [1e15 + 1] * 16, 3)]
    with_more = [(*r, None, None, None) for r in rows]
    got = run(spark, tmp_path, with_more, SCHEMA + ", code string, error long, p int")
    assert got == brute(rows)
    assert {r[0] for r in got if r[1] is None} == {6, 7}


def test_empty_table_and_bad_vectors(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == []
    assert run(spark, tmp_path / "b", [(1, None, 1), (None, [1.0] * 16, 2)]) != []
    assert [r[1] for r in run(spark, tmp_path / "c", [(1, [], 1), (2, [], 1)])] == ["00" * 16] * 2
    with pytest.raises(ValueError, match="equal parts"):
        run(spark, tmp_path / "d", [(1, [1.0] * 17, 1)])


@pytest.mark.parametrize("kind", [np.int64, object])
def test_tree_equals_scan_and_leaves_subtrees_out(kind):
    rng = np.random.default_rng(5)
    points = rng.integers(-300, 300, (64, 4)).astype(kind)
    points[40:44] = points[3]
    x = np.concatenate([rng.integers(-300, 300, (500, 4)).astype(kind), points])
    tree = V.Gnat(points, np.arange(64))
    best, who = tree.nearest(x)
    want = [min((int(((a - b) ** 2).sum()), k) for k, b in enumerate(points)) for a in x]
    assert list(zip(best.tolist(), who.tolist())) == want
    seen = tree._search(x, np.arange(len(x)), np.full(len(x), 1 << 62, kind), np.full(len(x), -1))
    assert seen < 0.9 * 64 * len(x)


def test_ties_between_subtrees_go_to_the_lower_index():
    points = np.array([[i, 0] for i in range(0, 40, 2)])
    tree = V.Gnat(points, np.arange(len(points))[::-1].copy(), degree=2)
    best, who = tree.nearest(np.array([[i, 0] for i in range(1, 38, 2)]))
    assert best.tolist() == [1] * 19 and who.tolist() == [19 - (i + 1) // 2 for i in range(1, 38, 2)]
