"""Boilerplate lines by site-relative frequency.

For each host, the number of its pages that contain a line is divided by the
number of its pages; lines above the ratio are dropped from every page of that
host.  Lines are compared without the white space around them, by two
independent 64-bit hashes, so the shuffle carries no text; counts are combined
before it, and a hot host or line is a few rows of each task.  What a host has
of such lines is at most its mean number of lines a page divided by the ratio,
so they return to the pages as one short array for each host; pages move only
if the table of these arrays is too large to broadcast, and then as a join
whose skew Spark can split.

A group of copies would put all its lines above the ratio, and so lose its
text in every copy.  ``copies=False``, which the corpus pipeline uses, counts
each page content once for its host (by a two-hash digest of the whole text),
with a line and in total, and leaves a page whole of which nothing with a
letter would remain.  ``op3_line_dedup`` counts every row, as its SQL does.

Defined cases: a null text stays null and its page counts for its host; a null
host is a host of its own; blank lines are never boilerplate; a page whose
lines all go is kept, with an empty text or, without copies, whole; a line that a page repeats counts
once there and goes everywhere; line order and line ends stay; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar_feeds.llm.common import table

#: A line on more than this part of its host's pages is boilerplate, ...
RATIO = 0.05
#: ... unless it is on fewer pages than this (one page proves no template).
MIN_PAGES = 3
_BLANKS = " \t\r\x0b\x0c"


def url_host(url: Column) -> Column:
    """Lower-case host of a URL, for tables that have no host column."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _bare(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANKS))


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(pages: DataFrame, host: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                copies: bool = True) -> DataFrame:
    """__host, __bad: the keys of its boilerplate lines, for hosts that have any."""
    rows = pages.select(host.alias("__host"), pages["text"].alias("__text"),
                        *([] if copies else [_key(pages["text"]).alias("__page")]))
    page = [] if copies else ["__page"]
    each = rows if copies else rows.select("__host", "__page").distinct()
    total = each.groupBy("__host").agg(F.count(F.lit(1)).alias("__pages"))
    lines = (rows.select("__host", *page, F.explode(F.array_distinct(F.transform(
                F.split("__text", "\n", -1), _bare))).alias("__line"))
             .where("__line <> ''").select("__host", *page, _key(F.col("__line")).alias("__key")))
    if not copies:
        lines = lines.distinct()
    counts = (lines.groupBy("__host", "__key").agg(F.count(F.lit(1)).alias("__n"))
              .where(F.col("__n") >= min_pages))
    return (counts.join(total.withColumnRenamed("__host", "__h"), F.col("__host").eqNullSafe(F.col("__h")))
            .where(F.col("__n") > F.col("__pages") * F.lit(ratio))
            .groupBy("__host").agg(F.collect_list("__key").alias("__bad")))


def drop_boilerplate(pages: DataFrame, host: str | Column = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, copies: bool = True) -> DataFrame:
    """``pages`` with boilerplate lines taken out of ``text``, and two columns
    more: __n_lines (lines of the text before) and __n_dropped."""
    at = pages[host] if isinstance(host, str) else host
    bad = boilerplate(pages, at, ratio, min_pages, copies)
    lines = F.split("text", "\n", -1)
    kept = F.when(F.col("__bad").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("__bad"), _key(_bare(x))), F.lit(False))))
    return (pages.withColumn("__at", at).join(bad, F.col("__at").eqNullSafe(F.col("__host")), "left")
            .withColumn("__lines", kept)
            .withColumn("__lines", F.col("__lines") if copies else F.when(
                F.exists("__lines", lambda x: x.rlike(r"\p{L}")), F.col("__lines")).otherwise(lines))
            .select(*[(F.array_join("__lines", "\n").alias("text") if c == "text" else pages[c])
                      for c in pages.columns],
                    F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("__n_lines"),
                    F.coalesce(F.size(lines) - F.size("__lines"), F.lit(0)).cast("long").alias("__n_dropped")))


def op3_line_dedup(spark, sf_dir):
    return drop_boilerplate(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), "text")


OP3_SQL = """
WITH pages AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
lines AS (
  SELECT DISTINCT doc_id, source, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)),
often AS (SELECT source, line, count(*) AS c FROM lines WHERE line <> '' GROUP BY source, line),
bad AS (
  SELECT o.source, list(o.line) AS bad
  FROM often o JOIN pages p ON o.source IS NOT DISTINCT FROM p.source
  WHERE o.c >= 3 AND o.c > p.n * 0.05::DOUBLE
  GROUP BY o.source),
cut AS (
  SELECT d.doc_id, string_split(d.text, chr(10)) AS had,
    list_filter(string_split(d.text, chr(10)), lambda x: NOT coalesce(list_contains(
      b.bad, trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12))), false)) AS has
  FROM documents d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, coalesce(len(had), 0)::BIGINT AS n_lines,
  coalesce(len(had) - len(has), 0)::BIGINT AS n_dropped,
  array_to_string(has, chr(10)) AS text
FROM cut
"""
