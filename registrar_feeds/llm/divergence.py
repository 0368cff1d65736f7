"""Divergence of the sources of a language, by count-level bitmaps.

A group is a (language, source) pair.  For each group, count level and word of 64
terms there is one 64-bit set of the terms that have this count in this group.
Two groups are compared word by word: a level of the one AND a level of the
other, then a popcount, gives the number of terms in that joint cell, and each
cell is multiplied by f of its two probabilities once, however many terms it has.
Terms that a group has not are its level zero, the complement of its other levels
in the word, so no zero is ever stored or shuffled.

The terms of a language are dealt by hash to slices of about SLICE terms, and
numbered within a slice by falling count, so that the words of rare terms have few
levels.  A task compares two tiles of about TILE sources each over one slice; its
sets are bounded by these two numbers, however many rows a source has.  Sums of
the tiles' cells add up to the pairs' values.

Term counts are combined in each task before they are shuffled, so a hot language,
source or term is a few rows of each; the ten terms of a group are cut in each
task before its window.  The result has one row for each ordered pair of sources
of a language, as asked.

All arithmetic is exact: counts and sums are longs, the products of p are taken
as decimals, f as longs (p is at most 10**9 + 1).

Defined cases: null text, language or source is the empty string; a row is one
document, also if its doc_id is null or repeated; an empty or blank text has no
terms, and its group occurs all the same; very long texts are whole rows of the
count; equal values rank by UTF-8 order of the item; a language without kept
terms gives its pairs with value 0; a lone source has no pairs; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar_feeds.llm.common import ascii_lower, kept, table

SCALE = 1_000_000_000
#: Documents of the language that a kept term is in, at least.
MIN_DOCUMENTS = 10
TOP = 10
#: Terms in a slice of a language, sources in a tile.
SLICE, TILE = 16_384, 32
_BREAKS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]++"
#: Cells of the AND of two levels that are held at once.
_CELLS = 1 << 20
_PART = "lang string, source string, item string, value long"


def term_counts(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """lang, source, term, c, total: occurrences of each kept term in a group
    that has it, and in its language; first: one row of each (lang, term)."""
    text = F.coalesce(docs["text"], F.lit(""))
    terms = F.filter(F.split(ascii_lower(text), _BREAKS), lambda t: t != "")
    rows = docs.select(_or_empty(docs["lang"]).alias("lang"), _or_empty(docs["source"]).alias("source"), terms.alias("terms"))
    # every occurrence counts, and once more the first of each document
    one = F.struct(F.lit(0).cast("long").alias("d"), F.col("terms").alias("t"))
    two = F.struct(F.lit(1).cast("long").alias("d"), F.array_distinct("terms").alias("t"))
    seen = (rows.select("lang", "source", F.explode(F.array(one, two)).alias("x"))
            .select("lang", "source", F.col("x.d").alias("d"), F.explode("x.t").alias("term")))
    counts = seen.groupBy("lang", "source", "term").agg(F.sum(1 - F.col("d")).alias("c"), F.sum("d").alias("d"))
    term = Window.partitionBy("lang", "term")
    return (counts.withColumn("total", F.sum("c").over(term)).withColumn("d", F.sum("d").over(term))
            .withColumn("first", F.row_number().over(term.orderBy("source")) == 1)
            .where(F.col("d") >= min_documents).drop("d"))


def _or_empty(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def share(count: Column, n: Column, v: Column) -> Column:
    """p = 1 + floor(SCALE * (count + 2) / (n + 2 * v)); 0 where there are no terms."""
    d = "decimal(20,0)"
    p = F.call_function("div", (F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast(d)).cast("decimal(32,0)"), (n + 2 * v).cast(d))
    return F.when(n + 2 * v > 0, 1 + p).otherwise(F.lit(0)).cast("long")


def cells(batch: pa.Table) -> dict[tuple[int, int], int]:
    """Sum of f over the terms of one slice for each pair of sources (by number
    in ``side``'s order), from rows (source, p, word, bits, terms): a source's
    levels, and one row with a null word that has its p at count zero and the
    number of the slice's terms."""
    names = batch["name"].to_numpy()
    p, bits = batch["p"].to_numpy(), batch["bits"].to_numpy().view(np.uint64)
    word = batch["word"].to_numpy()
    zero = word < 0
    terms = int(bits[zero].max(initial=0))
    at = np.argsort(names[zero], kind="stable")
    ids, nought = names[zero][at], p[zero][at]
    k = len(ids)
    who, p, bits, word = np.searchsorted(ids, names[~zero]), p[~zero], bits[~zero], word[~zero]
    order = np.lexsort((who, word))
    who, p, bits, word = who[order], p[order], bits[order], word[order]
    total = np.zeros((k, k), np.int64)
    starts = np.searchsorted(word, np.arange(-(-terms // 64) + 1))
    for w in range(len(starts) - 1):
        a, b = starts[w], starts[w + 1]
        every = np.uint64((1 << min(64, terms - 64 * w)) - 1)
        has = np.zeros(k, np.uint64)
        np.bitwise_or.at(has, who[a:b], bits[a:b])
        rest = every & ~has  # level zero
        some = np.flatnonzero(rest)
        group = np.concatenate((who[a:b], some))
        prob = np.concatenate((p[a:b], nought[some]))
        sets = np.concatenate((bits[a:b], rest[some]))
        step = max(1, _CELLS // max(len(sets), 1))
        for i in range(0, len(sets), step):
            n = np.bitwise_count(sets[i:i + step, None] & sets[None, :])
            x, y = np.nonzero(n)
            one, two = group[x + i], group[y]
            cell = one < two
            x, y, one, two = x[cell], y[cell], one[cell], two[cell]
            pa_, pb = prob[x + i], prob[y]
            f = (pa_ - pb) * (pa_ - pb) // (pa_ + pb)
            np.add.at(total, (one, two), n[x, y].astype(np.int64) * f)
    return {(int(ids[i]), int(ids[j])): int(total[i, j]) for i in range(k) for j in range(i + 1, k)}


def _tile_pair(t: pa.Table) -> pa.Table:
    lang, one, two = t["lang"][0].as_py(), t["one"][0].as_py(), t["two"][0].as_py()
    sources = sorted(set(t["source"].to_pylist()))
    number = {s: i for i, s in enumerate(sources)}
    tile = dict(zip(t["source"].to_pylist(), t["tile"].to_pylist(), strict=True))
    names = pa.array([number[s] for s in t["source"].to_pylist()], pa.int64())
    found = cells(pa.table({"name": names, "p": t["p"], "word": t["word"], "bits": t["bits"]}))
    out = []
    for (a, b), value in found.items():
        a, b = sources[a], sources[b]
        if (tile[a] == one and tile[b] == two) or (tile[a] == two and tile[b] == one):
            out += [(a, b, value), (b, a, value)]
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array([o[0] for o in out], pa.string()),
                     "item": pa.array([o[1] for o in out], pa.string()), "value": pa.array([o[2] for o in out], pa.int64())})


def divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, slice_terms: int = SLICE,
               tile_sources: int = TILE) -> DataFrame:
    """lang, source, part, item, value, rank: for each group the other sources of
    its language (part ``pair``), and its ``top`` terms above the language's
    share (part ``term``)."""
    counts = kept(term_counts(docs, min_documents), "divergence-counts")
    groups = docs.select(_or_empty(docs["lang"]).alias("lang"), _or_empty(docs["source"]).alias("source")).distinct()
    of_lang = counts.groupBy("lang").agg(F.sum("c").alias("n_lang"), F.sum(F.col("first").cast("long")).alias("v"))
    of_group = counts.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = (groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "n_lang", "v")]))
    slices = F.greatest(F.lit(1), F.ceil(F.col("v") / slice_terms)).cast("int")
    tiles = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / tile_sources)).cast("int")
    # one row for each group, and as many for each language
    groups = kept(groups.join(groups.groupBy(F.col("lang").alias("__lang")).agg(tiles.alias("tiles")), F.col("lang") == F.col("__lang"))
                  .select("lang", "source", "n", "n_lang", "v", "tiles", slices.alias("slices"),
                          F.pmod(F.xxhash64("source"), "tiles").cast("int").alias("tile")), "divergence-groups")
    return _pairs(counts, groups).unionByName(_terms(counts, groups, top))


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    placed = counts.join(groups, ["lang", "source"]).withColumn("slice", F.pmod(F.xxhash64("term"), "slices").cast("int"))
    number = F.dense_rank().over(Window.partitionBy("lang", "slice").orderBy(F.desc("total"), "term")) - 1
    levels = (placed.withColumn("at", number)
              .groupBy("lang", "slice", "source", "c", F.floor(F.col("at") / 64).cast("long").alias("word"))
              .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 64)).alias("bits"),
                   F.max(F.col("at") + 1).alias("terms"), *[F.first(c).alias(c) for c in ("n", "v", "tile", "tiles")]))
    levels = kept(levels.select("lang", "slice", "source", share(F.col("c"), F.col("n"), F.col("v")).alias("p"), "word", "bits",
                                "tile", "tiles", F.col("terms").cast("long").alias("terms")), "divergence-levels")
    of_slice = levels.groupBy("lang", "slice").agg(F.max("terms").alias("terms"))
    zero = (groups.select("*", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
            .join(of_slice, ["lang", "slice"], "left")
            .select("lang", "slice", "source", share(F.lit(0).cast("long"), F.col("n"), F.col("v")).alias("p"), F.lit(-1).cast("long").alias("word"),
                    F.coalesce("terms", F.lit(0)).cast("long").alias("bits"), "tile", "tiles"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    sides = (levels.drop("terms").unionByName(zero).select("*", other.alias("other"))
             .withColumn("one", F.least("tile", "other")).withColumn("two", F.greatest("tile", "other")))
    value = (sides.groupBy("lang", "slice", "one", "two").applyInArrow(_tile_pair, _PART)
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return value.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(counts: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    p, q = F.col("p"), F.col("q")
    rows = (counts.join(groups, ["lang", "source"])
            .select("lang", "source", "term", share(F.col("c"), F.col("n"), F.col("v")).alias("p"),
                    share(F.col("total"), F.col("n_lang"), F.col("v")).alias("q"))
            .where(p > q)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    F.call_function("div", (p - q) * (p - q), p + q).alias("value")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= top)


def op11_source_divergence(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS MATERIALIZED (
  SELECT id, lang, source, term, count(*) AS c
  FROM (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)
  GROUP BY id, lang, source, term),
k AS MATERIALIZED (SELECT lang, term, sum(c) AS total FROM w GROUP BY lang, term HAVING count(*) >= 10),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
c AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, k.total, coalesce(w.c, 0) AS c
  FROM g JOIN k ON g.lang = k.lang
    LEFT JOIN (SELECT lang, source, term, sum(c) AS c FROM w GROUP BY lang, source, term) w
    ON g.lang = w.lang AND g.source = w.source AND k.term = w.term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
p AS MATERIALIZED (
  SELECT c.lang, c.source, c.term, c.c,
    (1 + (1000000000::HUGEINT * (c.c + 2)) // (n.n + 2 * l.v))::HUGEINT AS p,
    (1 + (1000000000::HUGEINT * (c.total + 2)) // (l.n + 2 * l.v))::HUGEINT AS q
  FROM c JOIN n ON c.lang = n.lang AND c.source = n.source JOIN l ON c.lang = l.lang),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON a.lang = f.lang AND a.source = f.source AND b.source = f.item
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
WHERE part = 'pair' OR rank <= 10
"""
