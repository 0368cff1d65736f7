"""Small tables for the operators' tests."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def documents(spark, rows, extra=""):
    """documents from (doc_id, text[, lang[, source]]) tuples; ``extra``: more
    columns, all null, as 'name type, ...'."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0",
             None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for x in filter(None, (x.strip() for x in extra.split(","))):
        name, kind = x.split()
        df = df.selectExpr("*", f"cast(null as {kind}) as `{name}`")
    return df


def edge_rows(long=30_000):
    """Nulls, empty, blank and very long texts, equal rows, ties."""
    return [
        (1, None, None, None), (2, "", "en", "s0"), (3, " \t\n ", "en", None), (None, "a b c d e f g", "en", "s1"),
        (None, None, None, None), (5, "one two three four five six", "en", "s0"), (5, "one two three four five six", "en", "s0"),
        (6, "One Two three four five six", "de", "s1"), (7, "word " * long, "en", "s0"), (8, "x" * long, None, "s2"),
        (9, "é ü 漢字 😀 text", "fr", "s2"), (10, "one two three four five six", "en", "s2"),
    ]


CLASH = ("keep_id long, score double, rank int, spans string, size long, taken long, pass int, words int, n long, "
         "uid long, rep long, sequence_id long, offset long, h long, ids binary, start long, host string, lines int")
