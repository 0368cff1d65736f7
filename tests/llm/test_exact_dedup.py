import hashlib

import pytest

from registrar_feeds.llm import exact_dedup as X
from tests.llm.helpers import CLASH, documents, edge_rows


def brute(rows):
    fold = str.maketrans(X.UPPER, X.LOWER)
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault((t or "").translate(fold), []).append(d)
    out = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        stays = ids.index(keep)
        out += [(d, keep, len(ids), i == stays, sha) for i, d in enumerate(ids)]
    return sorted(out, key=str)


def run(df, **options):
    return sorted((tuple(r) for r in X.exact_groups(df, **options).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"local_bytes": 500, "bucket_bytes": 700, "fan_bits": 2}])
def test_groups(spark, options):
    rows = [(i, f"Text {i % 40} " + "é" * (i % 7)) for i in range(500)] + [(1000 + i, "same") for i in range(400)]
    assert run(documents(spark, rows).repartition(5), **options) == brute(rows)


@pytest.mark.parametrize("options", [{}, {"local_bytes": 100, "bucket_bytes": 100}])
def test_edge_cases(spark, options):
    rows = edge_rows(3000) + [(11, "É"), (12, "é"), (13, "A\0b"), (14, "a\0B")]
    assert run(documents(spark, rows, CLASH).repartition(3), **options) == brute(rows)
    assert run(documents(spark, [])) == []


def test_table_compares_contents_when_hashes_are_equal():
    t = X.Table()
    assert [t.place(7, x) for x in (b"a", b"b", b"a", b"c", b"b")] == [0, 1, 0, 2, 1]
    for i in range(2000):
        assert t.place(i % 3, str(i).encode()) == t.place(i % 3, str(i).encode())
