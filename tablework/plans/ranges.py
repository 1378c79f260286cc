"""Global order without a global task: range partitions plus per-range offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.plans.staging import stage

# monotonically_increasing_id keeps the row number inside a partition in its low 33 bits.
_LOCAL_POSITION = (1 << 33) - 1


def _range_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_index(df: DataFrame, order: str, out: str) -> DataFrame:
    """Number the rows 0, 1, 2, ... by ``order`` (one column without repeats).

    One range shuffle; every partition numbers its own sorted rows, and the
    number of rows in earlier partitions (one value per partition) is added.
    """
    placed = stage(
        df.repartitionByRange(_range_count(df), order)
        .sortWithinPartitions(order)
        .select("*", F.monotonically_increasing_id().alias("_at"))
        .select(
            *df.columns,
            F.shiftright("_at", 33).alias("_range"),
            F.col("_at").bitwiseAND(F.lit(_LOCAL_POSITION)).alias("_at"),
        ),
        "ranges",
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    # offsets: at most one row per shuffle partition
    return placed.join(F.broadcast(offsets), "_range").select(
        *df.columns, (F.col("_at") + F.col("_offset")).alias(out)
    )


def running_total(
    df: DataFrame, key: str, order: list[Column], weight: str, out: str
) -> DataFrame:
    """Running sum of ``weight`` by ``order`` within ``key``, for few keys with many rows each.

    A key's rows are spread over many ranges, so no task sees a whole key.
    """
    placed = stage(
        df.repartitionByRange(_range_count(df), F.col(key), *order).withColumn(
            "_range", F.spark_partition_id()
        ),
        "ranges",
    )
    earlier = (
        Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        placed.groupBy(key, "_range")
        .agg(F.sum(weight).alias("_sum"))
        .select(key, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    )
    local = (
        Window.partitionBy(key, "_range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # offsets: at most one row per key and shuffle partition
    return placed.join(F.broadcast(offsets), [key, "_range"]).select(
        *df.columns, (F.sum(weight).over(local) + F.col("_offset")).alias(out)
    )
