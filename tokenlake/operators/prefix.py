"""Running totals over a global or per-group order, without a single-task sort.

The (group, order, value) columns are range-partitioned, so a group of any size
is spread over many tasks; the partition number is written down with the rows,
because range bounds come from sampling and must not be drawn twice. A row's
total is then the total of the earlier partitions plus the running sum inside
its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenlake.workspace import Workspace


def _ranged(df: DataFrame, groups: Sequence[str], order_col: str, value: str) -> DataFrame:
    narrow = df.select(*groups, order_col, F.col(value).cast("bigint").alias("_v"))
    placed = narrow.repartitionByRange(*groups, order_col).withColumn("_part", F.spark_partition_id())
    return Workspace(df.sparkSession, "prefix").save(placed, "placed")


def _offsets(placed: DataFrame) -> DataFrame:
    """(_part, _before): one row per partition, so this may pass through the driver."""
    rows = placed.groupBy("_part").agg(F.sum("_v").alias("t")).orderBy("_part").collect()
    before, out = 0, []
    for row in rows:
        out.append((row["_part"], before))
        before += row["t"]
    return placed.sparkSession.createDataFrame(out, "_part int, _before long")


def running_total(
    df: DataFrame, order_col: str, value: str, out: str = "offset", groups: Sequence[str] = ()
) -> DataFrame:
    """(groups, order_col, out): the sum of ``value`` over earlier rows of the group.

    ``order_col`` must be unique within a group.
    """
    placed = _ranged(df, groups, order_col, value)
    inside = Window.partitionBy(*groups, "_part").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    if groups:
        # One row per (group, partition) the group touches, so even a huge group is short here.
        earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        totals = (
            placed.groupBy(*groups, "_part")
            .agg(F.sum("_v").alias("_t"))
            .select(*groups, "_part", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_before"))
        )
        joined = placed.join(totals, [*groups, "_part"])
    else:
        joined = placed.join(F.broadcast(_offsets(placed)), "_part")
    total = F.col("_before") + F.coalesce(F.sum("_v").over(inside), F.lit(0))
    return joined.select(*groups, order_col, total.alias(out))


def locate_total(df: DataFrame, order_col: str, value: str, limit: int):
    """(key, total before it) of the row at which the running total reaches
    ``limit``, or None when the whole total is at most ``limit``."""
    placed = _ranged(df, (), order_col, value)
    rows = placed.groupBy("_part").agg(F.sum("_v").alias("t")).orderBy("_part").collect()
    if sum(r["t"] for r in rows) <= limit:
        return None
    before = 0
    for row in rows:
        if before + row["t"] >= limit:
            break
        before += row["t"]
    # One partition remains; its running total is needed only for one key.
    inside = Window.partitionBy("_part").orderBy(order_col)
    running = placed.filter(F.col("_part") == row["_part"]).withColumn("_run", F.sum("_v").over(inside))
    hit = (
        running.filter(F.col("_run") >= F.lit(limit - before))
        .agg(F.min_by(F.struct(order_col, "_run", "_v"), order_col).alias("h"))
        .first()["h"]
    )
    return hit[order_col], before + hit["_run"] - hit["_v"]
