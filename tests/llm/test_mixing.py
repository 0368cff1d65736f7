import re
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from registrar_feeds.llm import mixing as M
from tests.llm.helpers import CLASH, documents, edge_rows

WORD = re.compile("[^\x20\x09-\x0D]+")


@given(st.lists(st.integers(0, 50), min_size=1, max_size=12))
def test_targets(sizes):
    got = M.targets(sizes)
    assert sum(got) == Fraction(3, 2) * sum(sizes)
    assert all(t <= 2 * n for t, n in zip(got, sizes))
    # below the cap, targets are in proportion to the weights, and none at the cap would get less than it
    unit = {t / M.WEIGHTS[i % 3] for i, (t, n) in enumerate(zip(got, sizes)) if t < 2 * n}
    assert len(unit) <= 1
    for u in unit:
        assert all(2 * n <= u * M.WEIGHTS[i % 3] for i, (t, n) in enumerate(zip(got, sizes)) if t == 2 * n)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutations(n):
    image = M.permute(np.arange(n), n, 11)
    assert sorted(image) == list(range(n))
    assert (M.permute(image, n, 11, inverse=True) == np.arange(n)).all()
    assert n < 64 or (image != M.permute(np.arange(n), n, 12)).any()


@given(st.integers(1, 300), st.integers(1, 40), st.data())
def test_slots_take_the_target(size, block, data):
    target = data.draw(st.integers(0, 2 * size))
    key = lambda turn: M.pass_key(1, 0, turn)
    slots, cut = M.slots_of(size, target, block, key)
    blocks = -(-size // block)
    taken = 0
    for s in range(slots):
        b = int(M.permute(s % blocks, blocks, key(s // blocks))[0])
        taken += min(block, size - b * block, cut if s == slots - 1 else block)
    assert taken == target


def test_draws_give_every_source_its_slots():
    got = M.draws([1000, 0, 30, 700], 128, 1)
    per = {}
    for shard, source, first, n in got:
        assert per.get(source, 0) == first
        per[source] = first + n
    assert per == {0: 1000, 2: 30, 3: 700}
    assert all(sum(n for sh, _, _, n in got if sh == k) == 128 for k in range(got[-1][0]))
    assert got == M.draws([1000, 0, 30, 700], 128, 1)


def rows():
    return [(i, "tok " * (i % 50), "en", f"s{i % 4}" if i % 9 else None) for i in range(400)]


@pytest.mark.parametrize("options", [{}, {"block_words": 7, "shard_slots": 50, "chunk_docs": 20}])
def test_taken(spark, options):
    df = documents(spark, rows()).repartition(5)
    got = M.Mix(df, **options).taken().toPandas()
    assert len(got) == 400 and (got.taken <= 2 * got["size"]).all()
    assert (got.sort_values("doc_id")["size"].values == [len(WORD.findall(t)) for _, t, *_ in rows()]).all()
    source = {d: s for d, _, _, s in rows()}
    got["source"] = got.doc_id.map(lambda d: source[d] or "~null")
    per = got.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "max"), target=("target", "max"), taken=("taken", "sum"))
    assert (per["size"] == per.source_size).all()
    assert (abs(per.taken - per.target) <= 1).all()
    assert per.target.tolist() == [float(t) for t in M.targets(per["size"].tolist())]
    again = M.Mix(df, **options).taken().toPandas()
    assert got.drop(columns="source").sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()


def test_mixed_documents_hold_the_words_taken(spark):
    df = documents(spark, [(i, f"a{i} b{i}\nc{i}  d{i} " * (i % 30), "en", f"s{i % 3}") for i in range(200)], CLASH)
    taken = {r["doc_id"]: r["taken"] for r in M.Mix(df, block_words=16).taken().collect()}
    out = M.mixed_documents(df, block_words=16)
    assert out.columns == df.columns
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"]) and set(WORD.findall(r["text"])) <= {f"{x}{r['doc_id']}" for x in "abcd"}
    assert words == {d: n for d, n in taken.items() if n}


@pytest.mark.parametrize("options", [{}, {"block_words": 7, "shard_slots": 50, "chunk_docs": 20}])
def test_taken_does_not_hang_on_the_layout(spark, options):
    data = rows() + [(7, "tok " * 7, "en", "s3")] * 9 + [(None, "same words", "en", "s1")] * 5
    taken, texts = [], []
    for df in (documents(spark, data).coalesce(1), documents(spark, data[::-1]).repartition(7), documents(spark, data).repartition(3, "text")):
        taken.append(sorted(map(str, M.Mix(df, **options).taken().collect())))
        texts.append(sorted(map(str, M.mixed_documents(df, **options).collect())))
    assert taken[0] == taken[1] == taken[2] and texts[0] == texts[1] == texts[2]


def test_edge_cases(spark):
    df = documents(spark, edge_rows(3000), CLASH)
    got = M.Mix(df).taken().toPandas()
    assert len(got) == len(edge_rows()) and (got.taken <= 2 * got["size"]).all() and (got["size"] == 0).sum() == 4
    assert M.mixed_documents(df).columns == df.columns and M.mixed_documents(df).count() > 0
    assert M.Mix(documents(spark, [])).taken().count() == 0
    assert M.Mix(documents(spark, [(1, None, None, None)])).taken().collect()[0]["taken"] == 0
