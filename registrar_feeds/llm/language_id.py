"""Language identification by string kernels.

The kernel of two texts is the number of hashed character n-grams (orders 1 to
3 together, presence only, letters folded to lower case) that both have, over
the root of the product of their numbers.  A Nyström map sends a text to its
kernels with landmark texts; one-versus-rest kernel ridge regression is solved
in that space.  Documents are scored in batches of matrix products.

The model is fitted on a bounded sample of labelled rows (``fit_rows``), spread
over the languages; of these the driver sees n-gram sets of fixed size, never
texts.  Only text and language of rows that are not held out are learned from.
Every document is predicted, from its whole text and nothing else.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so
is everything if there is no labelled row; a null doc_id is never learned from
and counts as not held out; equal rows are predicted alike; an empty table
gives an empty result.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar_feeds.llm.common import modest_batches, table

#: Labelled rows to learn from, and landmarks among them: so many, and so many of
#: each language at least.
FIT_ROWS = 2048
LANDMARKS = 128
LANDMARKS_EACH = 4
RIDGE = 0.1
GRAM_BITS = 16
BATCH = 64
PART_CHARS = 1 << 20
UND = "und"


class Grams:
    """The set of hashed n-grams of a text, as a table of 2**GRAM_BITS flags."""

    def __init__(self):
        points = sys.maxunicode + 1
        code = np.zeros(points, np.uint32)  # 0: no letter
        for p in range(points):
            c = chr(p)
            if c.isalpha():
                code[p] = (ord(c.lower()[0]) * 2654435761 & 0xFFFFFFFF) | 1
        self.code = code

    def __call__(self, text: str | None, flags: np.ndarray) -> bool:
        """Sets the flags of the text's n-grams; False if it has no letter.
        Long texts are taken in parts that share two characters."""
        found = False
        for at in range(0, len(text or ""), PART_CHARS):
            found |= self._part(text[at:at + PART_CHARS + 2], flags)
        return found

    def _part(self, text: str, flags: np.ndarray) -> bool:
        c = self.code[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        if not c.any():
            return False
        shift = np.uint32(32 - GRAM_BITS)
        letter = c != 0
        flags[c[letter] * np.uint32(0x9E3779B1) >> shift] = True
        if len(c) > 1:  # a gram of two or three has a letter next to its first place
            two = c[:-1] * np.uint32(0x85EBCA6B) + c[1:]
            ok = letter[:-1] | letter[1:]
            flags[two[ok] * np.uint32(0xC2B2AE35) >> shift] = True
        if len(c) > 2:
            three = two[:-1] * np.uint32(0x27D4EB2F) + c[2:]
            flags[three[letter[1:-1]] * np.uint32(0x165667B1) >> shift] = True
        return True


def grams() -> Grams:
    """One table of letters per worker process."""
    held = vars(unicodedata).setdefault("_held_letters", [])
    if not held:
        held.append(Grams())
    return held[0]


class Model:
    """Landmarks and the weights of their kernels for each language."""

    def __init__(self, langs: list[str], columns: np.ndarray, marks: np.ndarray, sizes: np.ndarray, weights: np.ndarray):
        self.langs, self.columns, self.marks, self.sizes, self.weights = langs, columns, marks, sizes, weights

    def scores(self, flags: np.ndarray) -> np.ndarray:
        """One row of ``flags`` per text; about 1 for its language, -1 for others."""
        kernel = flags[:, self.columns].astype(np.float32) @ self.marks.T
        kernel /= np.sqrt(np.maximum(flags.sum(1), 1)[:, None] * self.sizes[None, :])
        return kernel @ self.weights[:-1] + self.weights[-1]


def fit(flags: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    if not len(flags):
        return None
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    # landmarks: in turn from each language
    turn = np.empty(len(y), int)
    for k in range(len(names)):
        turn[y == k] = np.arange((y == k).sum())
    pick = np.sort(np.lexsort((y, turn))[:max(landmarks, LANDMARKS_EACH * len(names))])
    sizes = flags.sum(1).astype(np.float64)
    columns = np.flatnonzero(flags[pick].any(0))
    marks = flags[pick][:, columns].astype(np.float32)
    k = (flags[:, columns].astype(np.float32) @ marks.T) / np.sqrt(sizes[:, None] * sizes[pick][None, :])
    values, vectors = np.linalg.eigh(k[pick].astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = np.hstack([k @ root, np.ones((len(y), 1))])
    weight = 1.0 / np.bincount(y)[y]  # languages count alike, however many rows they have
    weight *= len(y) / weight.sum()
    target = np.where(np.arange(len(names))[None, :] == y[:, None], 1.0, -1.0)
    gram = phi.T @ (phi * weight[:, None]) + ridge * np.eye(phi.shape[1])
    solved = np.linalg.solve(gram, phi.T @ (target * weight[:, None]))
    weights = np.vstack([root @ solved[:-1], solved[-1:]])
    return Model(names, columns, marks, sizes[pick].astype(np.float32), weights.astype(np.float32))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """The model of the rows of ``docs`` that are not held out."""
    rows = docs.where(docs["doc_id"].isNotNull() & ~held_out(docs["doc_id"]) & docs["lang"].isNotNull())
    count = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count:
        return None
    per = max(1, fit_rows // len(count))
    # a thin slice of each language by hash, then the first of it by hash order
    rate = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, 4 * per / n))) for k, n in sorted(count.items())])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    order = Window.partitionBy("lang").orderBy("__place", "doc_id", "text")
    sample = (rows.where(place < rate * (1 << 30)).select("lang", "text", place.alias("__place"), "doc_id")
              .withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= per)
              .select("lang", "text", "__rank"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, flags = grams(), np.zeros(1 << GRAM_BITS, bool)
        for rb in batches:
            out = []
            for lang, rank, text in zip(rb["lang"].to_pylist(), rb["__rank"].to_pylist(), rb["text"], strict=True):
                flags[:] = False
                if g(text.as_py(), flags):
                    out.append((lang, rank, np.packbits(flags).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.binary()), strict=True)], ["lang", "rank", "bits"])

    got = sorted(sample.mapInArrow(sets, "lang string, rank int, bits binary").collect())
    if not got:  # no labelled text has a letter
        return None
    flags = np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in got], np.uint8).reshape(len(got), -1), axis=1)
    return fit(flags.astype(bool), [r["lang"] for r in got], landmarks, ridge)


def identify(docs: DataFrame, model: Model | None, batch: int = BATCH) -> DataFrame:
    """``docs`` with lang_pred and score (half of the winning regression value
    plus one, within 0 and 1) appended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, flags = grams(), np.zeros((batch, 1 << GRAM_BITS), bool)
        for rb in batches:
            lang, score = [UND] * rb.num_rows, [0.0] * rb.num_rows
            for at in range(0, rb.num_rows if model else 0, batch):
                texts = rb["text"].slice(at, batch).to_pylist()
                flags[:] = False
                rows = [i for i, t in enumerate(texts) if g(t, flags[i])]
                if rows:
                    s = model.scores(flags[rows])
                    for i, k, v in zip((at + i for i in rows), s.argmax(1), s.max(1), strict=True):
                        lang[i], score[i] = model.langs[k], float(min(1.0, max(0.0, (v + 1) / 2)))
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             [*rb.schema.names, "__lang_pred", "__score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__lang_pred", T.StringType()), T.StructField("__score", T.DoubleType())])
    return modest_batches(docs).mapInArrow(run, schema)


def lettered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter, by the letters that the
    n-grams know; it takes no model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, flags = grams(), np.zeros(1 << GRAM_BITS, bool)
        for rb in batches:
            yield rb.filter(pa.array([g(t.as_py(), flags) for t in rb["text"]], pa.bool_()))

    return modest_batches(docs).mapInArrow(run, docs.schema)


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"))
