"""Positions of rows in export order, computed without one task.

A sorted frame is range-partitioned and sorted inside each partition.  Each
row is tagged with its partition and rank inside it, the tagged frame is
checkpointed (so both uses below see the same partitions), the partition
sizes are counted (one row per partition) and turned into offsets, and the
offsets - bounded by the partition count - are broadcast back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrar_feeds.session import checkpoint_root


def with_position(sorted_df: DataFrame, name: str = "position") -> DataFrame:
    checkpoint_root(sorted_df.sparkSession)
    cols = sorted_df.columns
    tagged = sorted_df.withColumn("__mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    pid = F.shiftright(F.col("__mid"), 33)
    local = F.col("__mid") - F.shiftleft(pid, 33)
    counts = tagged.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (tagged.join(F.broadcast(offsets), pid == F.col("__pid"))
                  .select((F.col("__off") + local).alias(name), *cols))
