import numpy as np
from pyspark.sql import functions as F

from registrar_feeds.llm import language_id as G
from registrar_feeds.llm.common import table
from tests.llm.helpers import CLASH, documents, edge_rows

SMOKE = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = table(spark, SMOKE, "documents").select("doc_id", "lang")
    got = G.op9_language_id(spark, SMOKE).join(docs, "doc_id").where("held_out")
    r = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.count("*").alias("n"),
                F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r["n"] > 30 and r["a"] > 0.95 and 0 <= r["lo"] <= r["hi"] <= 1


def test_predictions_rest_on_the_text_alone(spark):
    docs = table(spark, SMOKE, "documents")
    model = G.train(docs)
    a = {r["doc_id"]: (r["__lang_pred"], r["__score"]) for r in G.identify(docs, model).collect()}
    b = G.identify(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")), model).collect()
    assert a == {r["doc_id"]: (r["__lang_pred"], r["__score"]) for r in b}


def test_held_out_rows_are_not_learned_from(spark):
    rows = [(i, "abc def ghi jkl", "aa") for i in range(40)] + [(100 + i, "xyz uvw rst opq", "bb") for i in range(40)]
    docs = documents(spark, rows)
    wrong = docs.withColumn("lang", F.when(G.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    model = G.train(wrong)
    assert model.langs == ["aa", "bb"]
    got = {(r["lang"], r["__lang_pred"]) for r in G.identify(docs, model).collect()}
    assert got == {("aa", "aa"), ("bb", "bb")}


def test_edge_cases(spark):
    rows = edge_rows(3000) + [(50, "123 .. 456"), (51, "¿? — 12")]
    docs = documents(spark, rows, CLASH)
    got = G.identify(docs, G.train(docs))
    assert got.columns == [*docs.columns, "__lang_pred", "__score"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["__lang_pred"] == G.UND) == (not letters) and 0 <= r["__score"] <= 1
    empty = documents(spark, [])
    assert G.train(empty) is None and G.identify(empty, None).count() == 0
    assert {r["__lang_pred"] for r in G.identify(docs, None).collect()} == {G.UND}


def test_long_texts_in_parts(monkeypatch):
    g, text = G.grams(), "Ein langer Satz, der geteilt wird. " * 5
    whole, parts = (np.zeros(1 << G.GRAM_BITS, bool) for _ in range(2))
    assert g(text, whole)
    monkeypatch.setattr(G, "PART_CHARS", 7)
    assert g(text, parts) and (whole == parts).all()


def test_kernel_is_the_presence_kernel():
    g, flags = G.grams(), np.zeros((3, 1 << G.GRAM_BITS), bool)
    for f, t in zip(flags, ("Hallo Welt", "hallo welt", "ganz anders")):
        assert g(t, f)
    assert (flags[0] == flags[1]).all() and (flags[0] & flags[2]).sum() < flags[0].sum() / 2
    assert not g("12 3", np.zeros(1 << G.GRAM_BITS, bool))


def test_many_languages_are_told_apart():
    """200 made languages of 80 grams each among 2,000 that all share."""
    rng = np.random.default_rng(7)
    own = [rng.choice(2000, 80, replace=False) for _ in range(200)]

    def texts(each):
        flags = np.zeros((200 * each, 2000), bool)
        for i in range(200 * each):
            flags[i, rng.choice(own[i // each], 50, replace=False)] = True
            flags[i, rng.integers(0, 2000, 15)] = True
        return flags, [f"l{i // each:03d}" for i in range(200 * each)]

    model = G.fit(*texts(10))
    flags, langs = texts(5)
    assert len(model.marks) == 800
    found = [model.langs[i] for i in model.scores(flags).argmax(1)]
    assert np.mean([a == b for a, b in zip(found, langs, strict=True)]) >= 0.95
