"""Corpus pipeline: raw documents to packed training sequences.

Each stage takes the documents that the stage before it kept, as Parquet, and
all but the last return them under the columns of ``documents``:

1. language: documents that are in no language (no text or no letter) go, by
   their letters alone: the model's language and score reject none, and without
   labelled rows to learn from the rule is the same;
2. lines: boilerplate lines of a source go; every document stays.  Copies count
   as one page, and a document that would be left without a letter stays whole,
   so that the next stage still finds the text of copies;
3. near_duplicates: one document of each group of near copies stays, the one
   with the smallest doc_id; documents without words are in no group;
4. mix: sources are cut or repeated to their target weights;
5. pack: the pieces of training sequences, with their token ids.

Columns a stage does not change pass through it; ``n_chars``, where there is
one, follows a changed text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar_feeds.llm import language_id, line_dedup, mixing, ngram_join, packing
from registrar_feeds.llm.common import kept, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs)
    if model is None:
        return language_id.lettered(docs)
    found = language_id.identify(docs, model)
    return found.where(F.col("__lang_pred") != language_id.UND).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(docs, copies=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]
#: Learned and pseudorandom stages have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
