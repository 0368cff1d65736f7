"""Registrar tables as catalog tables.

Each environment is a namespace (``registrar_live.sec_rec``) and its audit trail
another (``registrar_live_audit.sec_rec``), as the source keeps it in a second
database.  The tables are external: the catalog names the folders that
``write_tables`` or ``store_tables`` wrote, and dropping a name leaves the files.

``store_tables`` writes the section-meetings and meetings in the same number of
buckets of the meeting number, inside their year folders.  The meeting pattern
then joins and groups them without an exchange, where the session allows joins on
more keys than the buckets have (``spark.sql.requireAllClusterKeysForCoPartition``
false, as ``session.build_session`` has it).  A bucket is read by one task, so a
table is bucketed only if its fullest bucket is no more than MOST times the mean;
with a hotter meeting both are written by ranges, to be shuffled and split at run
time.  The number of buckets lies beside the files (``_buckets``), so a new session
names the tables as they were written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar_feeds.sources.registrar import (
    CODEC, _folder_columns, check_env, check_staged, read_staged, table_path, write_tables,
)
from registrar_feeds.sources.schemas import BUCKET_COLUMNS, PARTITION_COLUMNS, TABLES, staged_schema

#: Fullest bucket against the mean bucket, at most.
MOST = 4.0
_MARK = "_buckets"


def table_name(env: str, name: str) -> str:
    """``registrar_{env}.{name}``; the audit trail is ``registrar_{env}_audit.sec_rec``."""
    space = f"registrar_{check_env(env)}"
    return f"{space}_audit.sec_rec" if name == "audit_sec_rec" else f"{space}.{name}"


def _mark(spark: SparkSession, path: str):
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{_MARK}")
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def _buckets(spark: SparkSession, path: str) -> int | None:
    store, at = _mark(spark, path)
    if not store.exists(at):
        return None
    stream = store.open(at)
    try:
        return stream.readInt()
    finally:
        stream.close()


def _space(spark: SparkSession, full: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {full.split('.')[0]}")


def register_tables(spark: SparkSession, base: str, env: str = "live", names: tuple[str, ...] = TABLES) -> None:
    """Name the staged tables under ``base`` in the catalog; a name that is there
    already is pointed to the new folder.  Files are checked as on reading."""
    for name in names:
        path, full = table_path(base, env, name), table_name(env, name)
        files = read_staged(spark, name, path).inputFiles()
        folders = _folder_columns(path, files) if files else ()
        n = _buckets(spark, path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in staged_schema(name).fields)
        layout = f" PARTITIONED BY ({', '.join(folders)})" if folders else ""
        if n:
            layout += f" CLUSTERED BY ({', '.join(BUCKET_COLUMNS[name])}) SORTED BY ({', '.join(BUCKET_COLUMNS[name])}) INTO {n} BUCKETS"
        _space(spark, full)
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet{layout} LOCATION '{path}'")
        if folders:
            spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")


def catalog_tables(spark: SparkSession, env: str = "live", names: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    """The registrar tables of one environment, by their names in the catalog."""
    return {n: spark.table(table_name(env, n)).select(*staged_schema(n).names) for n in names}


def even(tables: dict[str, DataFrame], buckets: int) -> bool:
    """Whether no bucket of the bucketed tables holds more than MOST times the mean."""
    for name, columns in BUCKET_COLUMNS.items():
        sizes = (tables[name].groupBy(F.pmod(F.hash(*columns), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.max("n").alias("most"), F.sum("n").alias("all")).first())
        if sizes["all"] and sizes["most"] > MOST * max(1.0, sizes["all"] / buckets):
            return False
    return True


def store_tables(tables: dict[str, DataFrame], base: str, env: str = "live", buckets: int = 0, **layout) -> None:
    """Write staged tables (as ``write_tables``, which gets ``layout``) and name
    them in the catalog; with ``buckets``, those of ``BUCKET_COLUMNS`` bucketed."""
    spark = next(iter(tables.values())).sparkSession
    chosen = set(BUCKET_COLUMNS) if buckets and set(BUCKET_COLUMNS) <= set(tables) and even(tables, buckets) else set()
    write_tables({n: df for n, df in tables.items() if n not in chosen}, base, env, **layout)
    for name in sorted(chosen):
        df, path, full, keys = tables[name], table_path(base, env, name), table_name(env, name), BUCKET_COLUMNS[name]
        check_staged(name, df.schema)
        _space(spark, full)
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        # dealt as the buckets are: a task writes one file for each year it has
        parts = PARTITION_COLUMNS[name]
        dealt = df.repartition(buckets, *keys).sortWithinPartitions(*parts, *keys)
        (dealt.write.mode("overwrite").format("parquet").partitionBy(*parts).bucketBy(buckets, *keys).sortBy(*keys)
         .option("path", path).options(**_options(layout)).saveAsTable(full))
        store, at = _mark(spark, path)
        stream = store.create(at, True)
        stream.writeInt(buckets)
        stream.close()
    register_tables(spark, base, env, tuple(tables))


def _options(layout: dict) -> dict[str, str]:
    size = layout.get("row_group_bytes")
    return {"compression": CODEC, **({"parquet.block.size": str(size)} if size else {})}


__all__ = ["catalog_tables", "register_tables", "store_tables", "table_name"]
