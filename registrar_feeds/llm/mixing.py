"""Mixing sources to target weights.

The words of a source form one stream, cut into blocks of ``block_words``
words.  Each source gets a number of slots that takes its target from that
stream; an output shard draws its slots from the sources by a multinomial in
proportion to what each still has to give, so that the totals come out exactly.
Slot ``i`` of a source's pass stands for block ``perm(i)``, where ``perm`` is a
keyed pseudorandom permutation of the source's block numbers (a Feistel network
with cycle walking), so no block comes twice in a pass and no shuffle of the
corpus is needed.  The stream's order is that of a hash of doc_id, source and
text, so what is taken of a document hangs on the rows alone, not on files,
partitions or cores.  Slots and blocks meet in one equi-join on (source, block).

Defined cases: a null text has no words and its document takes no part (taken
0); a null source is a source of its own, ordered last; a source without words
has target 0; equal rows and equal doc_ids are separate documents; an empty
table gives an empty result.  Sources are few against documents: their totals
(one row each) are the only thing the driver sees.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrar_feeds.llm.common import kept, table, text_or_empty, word_count

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
CAP = 2
BLOCK_WORDS = 512
SHARD_SLOTS = 65536
CHUNK_DOCS = 1024
_MASK = (1 << 64) - 1


def targets(sizes: list[int], weights=WEIGHTS, share: Fraction = SHARE, cap: int = CAP) -> list[Fraction]:
    """Words each source is to give: ``share`` of all words by weight (the
    weights repeat over the sources), none above ``cap`` times its size; what
    lies above goes to the others by weight until none is above."""
    left = share * sum(sizes)
    open_ = {i: Fraction(weights[i % len(weights)]) for i in range(len(sizes))}
    out = [Fraction(0)] * len(sizes)
    while open_:
        total = sum(open_.values())
        full = [i for i, w in open_.items() if left * w / total > cap * sizes[i]]
        if not full:
            for i, w in open_.items():
                out[i] = left * w / total
            break
        for i in full:
            out[i] = Fraction(cap * sizes[i])
            del open_[i]
        left -= sum(out[i] for i in full)
    return out


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(i, n, key, inverse: bool = False) -> np.ndarray:
    """Image of ``i`` under the permutation of 0..n-1 that ``key`` names.

    Four Feistel rounds over the smallest even number of bits that holds ``n``;
    values outside are sent through again until they fall inside.
    """
    i, n, key = (np.atleast_1d(np.asarray(x)).astype(np.uint64) for x in (i, n, key))
    i, n, key = np.broadcast_arrays(i, n, key)
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = i.copy(), np.ones(len(i), bool)
    rounds = range(4)[::-1] if inverse else range(4)
    with np.errstate(over="ignore"):
        while todo.any():
            x, b, m, k = out[todo], bits[todo], mask[todo], key[todo]
            left, right = x >> b, x & m
            for r in rounds:
                if inverse:
                    left, right = right ^ (_mix64(left + k * np.uint64(4) + np.uint64(r + 1) * np.uint64(0x9E3779B97F4A7C15)) & m), left
                else:
                    left, right = right, left ^ (_mix64(right + k * np.uint64(4) + np.uint64(r + 1) * np.uint64(0x9E3779B97F4A7C15)) & m)
            out[todo] = (left << b) | right
            todo[todo] = out[todo] >= n[todo]
    return out.astype(np.int64)


def pass_key(seed: int, source: int, turn):
    return (seed * 1_000_003 + source) * 8 + turn


def slots_of(size: int, target: int, block: int, key) -> tuple[int, int]:
    """Slots that take ``target`` of ``size`` words, and the words of the last."""
    blocks = -(-size // block)
    turns, rest = divmod(target, size)
    if not rest:
        return turns * blocks, block
    short = blocks * block - size  # words that the last block lacks
    at = int(permute(blocks - 1, blocks, key(turns), inverse=True)[0])
    taken = lambda m: m * block - (short if at < m else 0)
    m = -(-rest // block)
    m += taken(m) < rest
    return turns * blocks + m, rest - taken(m - 1)


def draws(slots: list[int], shard_slots: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source, first slot, number of slots): multinomial per shard, in
    proportion to what each source still has to give."""
    rng = np.random.default_rng(seed)
    left, given = np.array(slots, dtype=np.int64), np.zeros(len(slots), dtype=np.int64)
    out, shard = [], 0
    while left.sum():
        take = np.zeros(len(slots), dtype=np.int64)
        want = int(min(shard_slots, left.sum()))
        while want:  # a source that is drawn beyond what it has passes the rest on
            rest = left - take
            take += np.minimum(rng.multinomial(want, rest / rest.sum()), rest)
            want = int(min(shard_slots, left.sum()) - take.sum())
        out += [(shard, int(s), int(given[s]), int(take[s])) for s in np.flatnonzero(take)]
        left, given, shard = left - take, given + take, shard + 1
    return out


class Mix:
    """One mix of ``docs`` (doc_id, text, source).

    ``docs``: the input's ``columns`` with ``__uid`` (a number of the row, for
    joins and among equal rows), ``__ha``, ``__hb`` and ``__hc`` (hashes of the
    content, and of all columns) and ``__size``.  ``sources``: a row for each source with its size and target.
    ``pieces``: what the mix takes: __uid, pass, first (word of the document,
    from 0), words, shard, slot.
    """

    def __init__(self, docs: DataFrame, columns=("doc_id",), block_words: int = BLOCK_WORDS,
                 shard_slots: int = SHARD_SLOTS, chunk_docs: int = CHUNK_DOCS, seed: int = 42):
        spark = docs.sparkSession
        cols = list(dict.fromkeys([*columns, "source"]))
        content = [docs[c] for c in ("doc_id", "source", "text")]
        kinds = dict(docs.dtypes)
        every = [docs[c] for c in cols if "map<" not in kinds[c] and "variant" not in kinds[c]]
        self.docs = kept(docs.select(
            *[docs[c] for c in cols], word_count(text_or_empty(docs)).alias("__size"),
            F.xxhash64(*content).alias("__ha"), F.xxhash64(F.lit(1), *content).alias("__hb"),
            F.xxhash64(F.lit(2), *every).alias("__hc"),
            F.monotonically_increasing_id().alias("__uid")), "mix-docs")
        total = (self.docs.groupBy("source").agg(F.sum("__size").alias("size"), F.count(F.lit(1)).alias("n"))
                 .collect())
        total.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        sizes = [r["size"] for r in total]
        goal = targets(sizes)
        whole = [int(t) for t in goal]
        keys = [lambda turn, s=s: pass_key(seed, s, turn) for s in range(len(total))]
        slots = [slots_of(n, t, block_words, k) if n else (0, 0) for n, t, k in zip(sizes, whole, keys, strict=True)]
        self.sources = spark.createDataFrame(
            [(i, r["source"], r["size"], float(t)) for i, (r, t) in enumerate(zip(total, goal, strict=True))],
            "__sid long, __source string, source_size long, target double")
        n_docs = sum(r["n"] for r in total)
        self.pieces = self._pieces(spark, slots, sizes, draws([a for a, _ in slots], shard_slots, seed),
                                   block_words, max(1, -(-n_docs // chunk_docs)), seed)

    def _pieces(self, spark, slots, sizes, drawn, block, chunks, seed) -> DataFrame:
        # the stream of a source: its documents by chunk (a hash), so that a
        # source with a large part of all rows is summed in many windows
        base = (self.docs.where("__size > 0").join(self.sources, F.col("source").eqNullSafe(F.col("__source")))
                .select("__uid", "__size", "__sid", "__ha", "__hb", "__hc",
                        F.pmod("__ha", F.lit(chunks)).alias("__chunk")))
        per = base.groupBy("__sid", "__chunk").agg(F.sum("__size").alias("__n"))
        before = Window.partitionBy("__sid").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
        offs = per.select("__sid", "__chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
        inside = Window.partitionBy("__sid", "__chunk").orderBy("__ha", "__hb", "__hc", "__uid").rowsBetween(Window.unboundedPreceding, -1)
        laid = (base.withColumn("__in", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
                .join(offs, ["__sid", "__chunk"])
                .select("__sid", "__uid", "__size", (F.col("__off") + F.col("__in")).alias("__at")))
        parts = (laid.withColumn("__block", F.explode(F.expr(
                    f"sequence(__at div {block}, (__at + __size - 1) div {block})")))
                 .withColumn("__from", F.greatest(F.col("__at"), F.col("__block") * block))
                 .withColumn("__to", F.least(F.col("__at") + F.col("__size"), (F.col("__block") + 1) * block)))

        info = spark.createDataFrame(
            [(sh, s, f, c, -(-sizes[s] // block), slots[s][0] - 1, slots[s][1]) for sh, s, f, c in drawn],
            "shard long, __sid long, __first long, __count long, __blocks long, __last long, __cut long")

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rb in batches:
                sid, slot, n = (rb[c].to_numpy() for c in ("__sid", "slot", "__blocks"))
                turn = slot // n
                at = permute(slot % n, n, pass_key(seed, sid, turn))
                yield pa.RecordBatch.from_arrays([rb["__sid"], pa.array(at), rb["shard"], rb["slot"], pa.array(turn), rb["__limit"]],
                                                 ["__sid", "__block", "shard", "slot", "pass", "__limit"])

        each = (info.withColumn("slot", F.explode(F.expr("sequence(__first, __first + __count - 1)")))
                .withColumn("__limit", F.when(F.col("slot") == F.col("__last"), F.col("__cut")).otherwise(F.lit(block).cast("long")))
                .mapInArrow(blocks, "__sid long, __block long, shard long, slot long, pass long, __limit long"))
        upto = F.least(F.col("__to"), F.col("__block") * block + F.col("__limit"))
        return (parts.join(each, ["__sid", "__block"])
                .select("__uid", "pass", (F.col("__from") - F.col("__at")).alias("first"),
                        (upto - F.col("__from")).alias("words"), "shard", "slot")
                .where("words > 0"))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken: one row per document."""
        per = self.pieces.groupBy("__uid").agg(F.sum("words").alias("taken"))
        return (self.docs.join(self.sources, F.col("source").eqNullSafe(F.col("__source")))
                .join(per, "__uid", "left")
                .select("doc_id", F.col("__size").alias("size"), "source_size", "target",
                        F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: for each document and pass the words taken from
    it, as they stand in its text, under its own columns (``n_chars``, where
    there is one, is counted anew).  What the mix does not take is gone; what
    it takes twice comes twice.  A document taken whole keeps its exact text.
    """
    columns = docs.columns
    mix = Mix(docs, columns, **options)
    spans = mix.pieces.groupBy("__uid", F.col("pass").alias("__pass")).agg(
        F.sort_array(F.collect_list(F.struct("first", "words"))).alias("__spans"),
        F.sum("words").alias("__taken"))
    word = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"), F.lit(0))
    cut = F.when(F.col("__taken") == F.col("__size"), F.col("text")).otherwise(
        F.concat_ws("", F.flatten(F.transform(
            "__spans", lambda s: F.slice(F.col("__words"), (s["first"] + 1).cast("int"), s["words"].cast("int"))))))
    out = (mix.docs.join(spans, "__uid")
           .withColumn("__words", F.when(F.col("__taken") < F.col("__size"), word))
           .withColumn("text", cut))
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*columns)


def op10_mix(spark, sf_dir):
    return Mix(table(spark, sf_dir, "documents")).taken()
