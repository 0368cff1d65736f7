import random
import re

import pyarrow as pa

from registrar_feeds.llm import divergence as D
from tests.llm.helpers import CLASH, documents, edge_rows


def brute(rows, least=10, top=10):
    """The result by plain counting; rows are (doc_id, text, lang, source)."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        within = {}
        for _, _, terms in mine:
            for t in set(terms):
                within[t] = within.get(t, 0) + 1
        keep = sorted(t for t, n in within.items() if n >= least)
        count = {s: dict.fromkeys(keep, 0) for s in {d[1] for d in mine}}
        for _, s, terms in mine:
            for t in terms:
                if t in count[s]:
                    count[s][t] += 1
        whole = {t: sum(c[t] for c in count.values()) for t in keep}

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(keep)) for t in keep}

        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in p:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in keep), o) for o in p if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in keep if count[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def sample(n=400, seed=1):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdéüλ漢" for b in "klmnopqrst"] + ["Hot", "x1y"]
    rows = []
    for i in range(n):
        lang, source = r.choice(["en", "en", "de"]), r.choice(["s0", "s0", "s1", "s2", "é", "Z"])
        some = r.sample(words, 12) if source != "s0" else words[:20]
        rows.append((i, " ".join(r.choices(some, weights=range(1, len(some) + 1), k=r.randint(0, 60))) + " Hot", lang, source))
    return rows


def run(df, **options):
    return sorted(tuple(r) for r in D.divergence(df, **options).collect())


def test_equals_brute_force(spark):
    rows = sample()
    want = brute(rows)
    df = documents(spark, rows).repartition(4)
    assert run(df) == want
    assert run(df, slice_terms=20, tile_sources=2) == want
    assert len([w for w in want if w[2] == "pair"]) == 40


def test_edge_cases(spark):
    rows = edge_rows(3000) + [(40 + i, "one two Three", None, ["s0", None, "", "s3"][i % 4]) for i in range(12)] + [(60, "!! 12 --", "xx", "s0"), (61, "", "xx", "s1")]
    assert run(documents(spark, rows, CLASH + ", item string, term string, p long")) == brute(rows)
    assert run(documents(spark, [])) == []
    alone = [(i, "same words", "en", "s0") for i in range(10)]
    assert run(documents(spark, alone)) == brute(alone) == []


def test_equal_values_rank_by_utf8_order(spark):
    rows = [(i, "b é a z 漢 c d e f g h" if i % 3 else "q", "en", f"s{i % 3}") for i in range(60)]
    got = run(documents(spark, rows))
    assert got == brute(rows)
    assert [r[3] for r in got if r[:3] == ("en", "s1", "term")] == ["a", "b", "c", "d", "e", "f", "g", "h", "z", "é"]


def test_cells_of_one_slice():
    # 70 terms: source 0 has level p=5 on all, source 1 p=5 on the first 64 and nothing on six
    rows = [(0, 1, -1, 70), (1, 2, -1, 70), (0, 5, 0, -1), (0, 5, 1, 63), (1, 5, 0, -1), (2, 9, -1, 70)]
    t = pa.table(dict(zip(("name", "p", "word", "bits"), ([r[i] for r in rows] for i in range(4)), strict=True)))
    f = lambda a, b: (a - b) ** 2 // (a + b)
    assert D.cells(t) == {(0, 1): 6 * f(5, 2), (0, 2): 70 * f(5, 9), (1, 2): 64 * f(5, 9) + 6 * f(2, 9)}


def test_counts_beyond_a_long_product(spark):
    from pyspark.sql import functions as F
    big = spark.createDataFrame([(8 * 10 ** 11, 10 ** 13, 10 ** 9)], "c long, n long, v long")
    got = big.select(D.share(F.col("c"), F.col("n"), F.col("v"))).first()[0]
    assert got == 1 + 10 ** 9 * (8 * 10 ** 11 + 2) // (10 ** 13 + 2 * 10 ** 9)
