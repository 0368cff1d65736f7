import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from registrar_feeds.llm import packing as P
from tests.llm.helpers import CLASH, documents, edge_rows


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 64), max_size=60))
def test_tournament_tree_finds_the_first_bin_that_fits(sizes):
    bins, offsets, used = P.first_fit_decreasing(sizes, 64)
    free, want = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, f in enumerate(free) if f >= sizes[i]), None)
        if b is None:
            free.append(64)
            b = len(free) - 1
        want[i] = (b, 64 - free[b])
        free[b] -= sizes[i]
    assert list(zip(bins, offsets)) == want and used == len(free)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), st.sampled_from(" \n\t'sdmtlvre")), max_size=40))
def test_rank_file_gives_the_ids_of_the_tokenizer(text):
    exact = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER)) if not hasattr(P, "_t") else P._t
    P._t = exact
    exact.encode_special_tokens = True
    assert P.encoder()(text) == exact.encode(text, add_special_tokens=False).ids


def test_texts_in_parts_have_the_same_ids(exact):
    text = "".join(f"Some words, {i} and more\n\n of them " for i in range(400))
    assert [i for p in P.parts(text, 100) for i in exact(p)] == exact(text)
    assert "".join(P.parts(text, 100)) == text


def check(df, rows, exact, length=64, **options):
    got = P.pack(df, length=length, **options).toPandas()
    want = sorted((d if d is not None else -1, np.array([*exact(t or ""), 0], "<u4").tobytes()) for d, t, *_ in rows)
    # documents back from their pieces: a document's pieces have gapless starts
    got["doc_id"] = got.doc_id.fillna(-1).astype(int)
    pieces = got.sort_values(["doc_id", "doc_tokens", "start"])
    back = sorted((int(d), b"".join(g.ids)) for d, g in pieces.groupby("doc_id"))
    by_doc = {}
    for d, ids in want:
        by_doc[d] = by_doc.get(d, 0) + len(ids)
    assert {d: len(ids) for d, ids in back} == by_doc
    single = [d for d, _ in want if [x for x, _ in want].count(d) == 1]
    assert [x for x in back if x[0] in single] == [x for x in want if x[0] in single]
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length).tolist()[:-1]] and g.length.sum() <= length
    assert (got.length == got.ids.map(len) // 4).all()
    return got


def test_every_token_lies_in_one_piece(spark, exact):
    rows = [(i, "lorem ipsum dolor " * (i % 37)) for i in range(300)]
    got = check(documents(spark, rows), rows, exact, group_docs=50)
    whole = got.length.sum()
    assert 1 - whole / (64 * got.sequence_id.nunique()) < 0.03
    digest = P.piece_digest(P.pack(documents(spark, rows[:20]), length=64)).collect()
    for r in digest:
        ids = np.array([*exact("lorem ipsum dolor " * (r.doc_id % 37)), 0], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids)


def test_edge_cases(spark, exact):
    check(documents(spark, edge_rows(3000), CLASH), edge_rows(3000), exact)
    assert P.pack(documents(spark, [])).count() == 0


@pytest.fixture(scope="module")
def as_filed():
    t = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    return lambda text: t.encode(text, add_special_tokens=False).ids


PIECES = ["<|endoftext|>", "<|endoftext|", "|>", "<", "a", "word", " ", "\n", "'s", "é", "漢", " b c", "12"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=20))
def test_added_tokens_have_the_ids_of_the_unmodified_tokenizer(as_filed, pieces):
    text = "".join(pieces)
    assert P.encoder()(text) == as_filed(text)
    assert P.encoder()("a <|endoftext|> b") == [64, 220, 50256, 275]


def test_added_tokens_in_long_texts_and_in_sequences(spark, as_filed, monkeypatch):
    text = "Some words and<|endoftext|>more of them <|endoftext|> " * 40
    encode = P.encoder()
    monkeypatch.setattr(P, "PART_CHARS", 50)
    assert encode(text) == as_filed(text)
    added = P.re.compile("and a|a b c")
    cut = list(P.parts("x and a b c d and a b c d", 4, added))
    assert "".join(cut) == "x and a b c d and a b c d" and len(cut) > 1
    assert sum(len(added.findall(p)) for p in cut) == len(added.findall("".join(cut)))
    rows = [(i, "lorem <|endoftext|> ipsum" * (i % 5)) for i in range(50)]
    check(documents(spark, rows), rows, as_filed)
