"""Joining per-group tables onto rows when some groups may be very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenlake.workspace import Workspace

# Group tables up to this size are sent to every task.
BROADCAST_BYTES = 64 << 20
# Rows of one key that a single task should join.
ROWS_PER_SALT = 1_000_000


def _bytes_of(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        fields = len(kind.elementType.fields) if isinstance(kind.elementType, T.StructType) else 1
        return F.greatest(F.size(column), F.lit(0)) * F.lit(8 * fields) + 16
    return F.lit(8)


def table_bytes(df: DataFrame) -> int:
    """Approximate size of the rows of a table in memory."""
    width = F.lit(0)
    for field in df.schema.fields:
        width = width + _bytes_of(F.col(field.name), field.dataType)
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner", group_bytes: int | None = None
) -> DataFrame:
    """``rows`` joined to ``groups``, which has one row per key.

    A group table of proven size is broadcast, so ``rows`` stays in place. A
    larger one is joined by shuffle; the rows of heavy keys are spread over
    several tasks and only the group rows of those keys are copied to them.

    Without ``group_bytes`` the group table is written once and measured.
    """
    keys = list(keys)
    if group_bytes is None:
        groups = Workspace(groups.sparkSession, "groups").save(groups, "groups")
        group_bytes = table_bytes(groups)
    if group_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(groups), keys, how)
    return salted_join(rows, groups, keys, how)


def salted_join(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner", rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Shuffle join in which no task gets many more than ``rows_per_salt`` rows of a key."""
    keys = list(keys)
    # At most |rows| / rows_per_salt keys are heavy, so this table is small.
    heavy = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_salt)
        .select(*keys, F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts"))
    )
    # The salt is a hash of the row, so a task that runs again gives it again.
    salt = F.pmod(F.xxhash64(*rows.columns), F.coalesce(F.col("_salts"), F.lit(1))).cast("int")
    salted_rows = rows.join(F.broadcast(heavy), keys, "left").withColumn("_salt", salt).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    salted_groups = groups.join(F.broadcast(heavy), keys, "left").withColumn("_salt", copies).drop("_salts")
    return salted_rows.join(salted_groups, [*keys, "_salt"], how).drop("_salt")
