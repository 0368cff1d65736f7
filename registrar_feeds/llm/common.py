"""Helpers shared by the training-data operators.

Every operator selects the columns it needs from its input, so further columns
of any name do no harm, and names its own helper columns with ``__``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar_feeds.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Rows of text that go to Python at once.
BATCH_ROWS = 1000
#: Parquet looks at sizes after each row, not each hundredth, and ends a row group,
#: of which readers hold all rows at once, at 8 MB.
LARGE_ROWS = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
              "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
#: A maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]++"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, name: str, compression: str | None = None, large_rows: bool = False) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: what is read later is the same rows, also after an
    executor is lost, and nothing above is computed twice.  ``large_rows``: rows
    of megabytes are written, and so read, a few at a time.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}")
    df.write.options(**LARGE_ROWS if large_rows else {}).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def modest_batches(df: DataFrame) -> DataFrame:
    """``df``, for a step that hands texts to Python: Arrow batches of the
    session hold at most BATCH_ROWS rows, as their buffers lie outside the heap,
    several to a core.  The setting is only ever lowered."""
    key, spark = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return df


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; all other characters stay."""
    return F.translate(text, UPPER, LOWER)


def text_or_empty(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column], F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")
