"""Reading, staging and writing the registrar tables.

A run works on one environment: ``live`` or ``train`` (the training copy).
Tables live as Parquet under ``{base}/{env}/{table}``; the audit trail sits in
its own namespace, ``{base}/{env}/audit/sec_rec``.

Staging conforms a table to its fixed schema and right-trims its key columns,
so that joins and compares behave like the source's CHAR compares (trailing
blanks ignored).  Feeds read staged tables; writing the staged tables once
(``write_tables``) lets every later filter reach the Parquet scan.

What is staged is checked against the schema on both ends: a frame is before it
is written, and so are the files' own columns before they are read, as a forced
schema would read an absent column as nulls and empty a feed in silence.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar_feeds.sources.schemas import (
    AUDIT_NAMESPACE, BY_MONTH, CLUSTER_COLUMNS, KEY_COLUMNS, OPTIONAL_COLUMNS, PARTITION_COLUMNS, SCHEMAS,
    STAGED_EXTRA, TABLES, staged_schema,
)
from registrar_feeds.functions import codes as C
from registrar_feeds.session import shuffles_freed

# How staging derives the STAGED_EXTRA columns.
_DERIVED = {
    ("audit_sec_rec", "audit_date"): lambda: F.to_date(F.col("audit_timestamp")),
    ("audit_sec_rec", "audit_month"): lambda: F.date_format(F.col("audit_timestamp"), "yyyy-MM"),
    ("crs_rec", "course_key"): lambda: C.course_code("crs_no", "cat"),
    ("sec_rec", "course_key"): lambda: C.course_code("crs_no", "cat"),
    ("jenzcrs_rec", "course_key"): lambda: C.trim("course_code"),
    ("jenzcrs_rec", "term_sess"): lambda: C.term_sess("term_code"),
    ("jenzcrs_rec", "term_year"): lambda: C.term_year("term_code"),
    ("jenzcrs_rec", "key_year"): lambda: C.key_year("coursekey"),
    ("jenztrm_rec", "term_year"): lambda: C.term_year("term_code"),
}

ENVIRONMENTS = ("live", "train")

#: Codec of the staged files.
CODEC = "zstd"


def check_env(env: str) -> str:
    e = (env or "").strip().lower()
    if e not in ENVIRONMENTS:
        raise ValueError(f"environment must be one of {ENVIRONMENTS}, got {env!r}")
    return e


def table_path(base: str, env: str, name: str) -> str:
    root = f"{base.rstrip('/')}/{check_env(env)}"
    if name == "audit_sec_rec":
        return f"{root}/{AUDIT_NAMESPACE}/sec_rec"
    return f"{root}/{name}"


def stage_table(name: str, df: DataFrame) -> DataFrame:
    """Conform ``df`` to the schema of ``name``; right-trim its key columns;
    add the derived staging columns.

    A source column that is absent is an error, unless it is one of
    ``OPTIONAL_COLUMNS``: a missing join key would empty a feed in silence.
    """
    keys = set(KEY_COLUMNS.get(name, ()))
    have = set(df.columns)
    absent = [c for c in SCHEMAS[name].names if c not in have and c not in OPTIONAL_COLUMNS.get(name, ())]
    if absent:
        raise ValueError(f"table {name}: source columns absent: {', '.join(absent)}")
    cols = []
    for f in SCHEMAS[name].fields:
        c = F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        if f.name in keys:
            c = F.rtrim(c)
        cols.append(c.alias(f.name))
    out = df.select(*cols)
    return _with_derived(name, out, STAGED_EXTRA.get(name, ()))


def _with_derived(name: str, df: DataFrame, extra: tuple[tuple[str, T.DataType], ...]) -> DataFrame:
    """``df`` with these columns of ``STAGED_EXTRA`` appended."""
    return df.select("*", *[_DERIVED[(name, n)]().cast(t).alias(n) for n, t in extra]) if extra else df


def stage(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage_table(name, tables[name]) for name in TABLES}


def check_staged(name: str, found: T.StructType, folders: tuple[str, ...] = ()) -> None:
    """Raise unless ``found`` has every column of the staged table ``name`` with
    its type; those in ``folders`` (directory columns) by name alone, as a
    directory has no type.  Further columns do no harm."""
    have = {f.name: f.dataType for f in found.fields}
    want = staged_schema(name).fields
    absent = [f.name for f in want if f.name not in have]
    if absent:
        raise ValueError(f"staged table {name}: columns absent: {', '.join(absent)}")
    wrong = [f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}"
             for f in want if f.name not in folders and have[f.name] != f.dataType]
    if wrong:
        raise ValueError(f"staged table {name}: {'; '.join(wrong)}")


def _folder_columns(path: str, files: list[str]) -> tuple[str, ...]:
    """Directory columns (``name=value``) of the files below ``path``."""
    inside = files[0].split(path.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1].split("/")[:-1]
    return tuple(d.split("=", 1)[0] for d in inside if "=" in d)


def read_staged(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One staged table, after a check of the files' own columns.

    A table is always replaced as a whole, so one file's footer speaks for all;
    a table without rows may have no file.
    """
    df = spark.read.schema(staged_schema(name)).parquet(path)
    files = df.inputFiles()
    if files:
        check_staged(name, spark.read.parquet(path).schema, _folder_columns(path, files))
    return df


def read_tables(spark: SparkSession, base: str, env: str = "live", staged: bool = True,
                names: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    """The registrar tables of one environment, read with their fixed schemas.

    ``staged=False`` reads raw source extracts, under the schema of their files,
    and stages them on the fly; staged tables are read under the schema they
    were written with, and it is an error if their files lack a column of it or
    have it with another type.
    """
    check_env(env)
    out = {}
    for name in names:
        if staged:
            out[name] = read_staged(spark, name, table_path(base, env, name))
        else:
            out[name] = stage_table(name, spark.read.parquet(table_path(base, env, name)))
    return out


def write_tables(tables: dict[str, DataFrame], base: str, env: str = "live",
                 row_group_bytes: int | None = None, cluster: bool = True,
                 partition: bool = True, audit_by: str = "day", at_once: int = 4) -> None:
    """Write staged tables (those in ``tables``) as Parquet, one folder per table,
    ``at_once`` tables side by side: the last tasks of one leave no core idle.
    The shuffle files of a table go when it is written.

    ``partition`` writes the history tables of ``PARTITION_COLUMNS`` in one
    directory per year, term or day (read back with the same columns; the
    partition column comes last).  ``audit_by="month"`` compacts the audit trail
    to a directory per month: fewer and larger files, of which the time window
    skips those of other days by their statistics.  ``cluster`` deals rows to tasks by ranges of
    (partition columns, ``CLUSTER_COLUMNS``) and sorts them there: files hold
    disjoint ranges, so file and row-group statistics let the date windows skip
    them at any row-group size, and a directory has as many files as its share
    of the rows, at most one more for each border between tasks.
    ``row_group_bytes`` sets the Parquet row-group size: scans split at row
    groups, so it bounds the read parallelism of small tables (keep the default,
    128 MB, for large ones).
    """
    folders = {"day": PARTITION_COLUMNS, "month": BY_MONTH}[audit_by] if partition else {}
    for name, df in tables.items():
        check_staged(name, df.schema)

    def write(name: str) -> None:
        df = tables[name]
        columns = df.columns
        parts = folders.get(name, ())
        order = tuple(parts) + (CLUSTER_COLUMNS.get(name, ()) if cluster else ())
        # staging's columns that no row is dealt by are not shuffled but derived again
        late = tuple(x for x in STAGED_EXTRA.get(name, ()) if order and x[0] not in order)
        df = df.drop(*[n for n, _ in late])
        if order:
            # partition columns first: the partitioned writer needs that
            # order and would otherwise re-sort, losing the clustering
            if cluster:
                # a fixed number of tasks: writers of many folders stay parallel
                n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                df = df.repartitionByRange(n, *order) if parts else df.repartitionByRange(*order)
            df = _with_derived(name, df.sortWithinPartitions(*order), late).select(*columns)
        w = df.write.mode("overwrite").option("compression", CODEC)
        if parts:
            w = w.partitionBy(*parts)
        if row_group_bytes:
            w = w.option("parquet.block.size", str(row_group_bytes))
        w.parquet(table_path(base, env, name))

    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    with shuffles_freed(spark), ThreadPoolExecutor(max(1, at_once)) as threads:
        done = [threads.submit(inheritable_thread_target(spark)(write), name) for name in tables]
    for one in done:
        one.result()
