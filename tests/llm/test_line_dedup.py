from pyspark.sql import functions as F

from registrar_feeds.llm import line_dedup as L
from tests.llm.helpers import CLASH, documents, edge_rows


def brute(rows, ratio=L.RATIO, least=L.MIN_PAGES):
    pages, lines = {}, {}
    for _, t, _, s in rows:
        pages[s] = pages.get(s, 0) + 1
        for x in {x.strip(" \t\r\x0b\x0c") for x in (t or "").split("\n")} - {""}:
            lines[s, x] = lines.get((s, x), 0) + 1
    bad = {k for k, n in lines.items() if n >= least and n > pages[k[0]] * ratio}
    return sorted(((d, None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\r\x0b\x0c")) not in bad))
                   for d, t, _, s in rows), key=str)


def run(df, **options):
    return sorted(((r["doc_id"], r["text"]) for r in L.drop_boilerplate(df, **options).collect()), key=str)


def test_lines_above_the_ratio_go(spark):
    rows = [(i, f"Menu\n page {i} \n  Menu\t\nshared {i % 10}\n\nend {i}", "en", f"h{i % 3}") for i in range(90)]
    rows += [(100 + i, f"Menu\nalone {i}", "en", "rare") for i in range(2)]
    assert run(documents(spark, rows)) == brute(rows)
    assert run(documents(spark, rows), ratio=0.2, min_pages=2) == brute(rows, 0.2, 2)


def test_edge_cases(spark):
    rows = edge_rows(2000) + [(20 + i, "only\r\nthis\n", None, None) for i in range(4)]
    df = documents(spark, rows, CLASH)
    assert run(df) == brute(rows)
    out = L.drop_boilerplate(df)
    assert out.columns[:len(df.columns)] == df.columns
    assert L.drop_boilerplate(documents(spark, [])).count() == 0
    gone = out.where("doc_id = 20").first()
    assert gone["text"] == "" and gone["__n_dropped"] == 2 and gone["__n_lines"] == 3


def test_a_hot_host_is_not_shuffled_as_text(spark):
    plan = L.drop_boilerplate(documents(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_host_of_a_url(spark):
    rows = [("http://A.example.com/x?y",), ("https://u:p@b.org:80#z",), ("//nohost",), (None,)]
    got = spark.createDataFrame(rows, "url string").select(L.url_host(F.col("url")).alias("h")).collect()
    assert [r["h"] for r in got] == ["a.example.com", "b.org", "", None]
