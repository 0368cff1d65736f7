"""Join helpers that Spark has no single call for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed ``prefix + name``: joins stay unambiguous."""
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def null_aware_anti_join(left: DataFrame, key: str | Column, right: DataFrame,
                         right_key: str) -> DataFrame:
    """``left WHERE key NOT IN (SELECT right_key FROM right)``, SQL semantics.

    NOT IN is three-valued: an empty set keeps every row (null keys too); a
    null in the set keeps none; otherwise rows with a null key drop and the
    rest is a plain anti join.  The size of the set and its nulls are scalar
    subqueries, read when the plan runs (building it starts no job); then an
    ordinary equi anti join runs, which the planner broadcasts or shuffles by
    the set's measured size.  Spark's own NOT IN plan would always broadcast
    the set (a nested-loop join when it is not small).
    """
    k = F.col(key) if isinstance(key, str) else key
    stats = right.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(right_key).isNull()).alias("n_null"))
    n, n_null = stats.select("n").scalar(), stats.select("n_null").scalar()
    keys = right.select(F.col(right_key).alias("__not_in_key")).where(F.col("__not_in_key").isNotNull())
    return (left.where((n == 0) | (k.isNotNull() & (n_null == 0)))
                .join(keys, k == F.col("__not_in_key"), "left_anti"))
