"""Grouped sums and averages over wide time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.numeric import row_sum


def sum_and_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    """``(group, total, mean)``; rows without a value do not count."""
    return df.groupBy(group).agg(F.sum(value).alias("total"), F.avg(value).alias("mean"))


def slot_names(slots: int = 144, prefix: str = "TS") -> list[str]:
    return [f"{prefix}{i}" for i in range(1, slots + 1)]


def widen(df: DataFrame, keys: Sequence[str], slot: str, value: str, slots: int = 144) -> DataFrame:
    """One row per series with a column per slot number 1..slots; empty slots are 0.

    A value in a slot outside that range, or in none, is an error: it has no column.
    """
    names = slot_names(slots)
    outside = F.concat(F.lit(f"no slot from 1 to {slots}: "), F.coalesce(F.col(slot).cast("string"), F.lit("null")))
    df = df.withColumn(slot, F.when(F.col(slot).between(1, slots), F.col(slot)).otherwise(F.raise_error(outside)))
    wide = df.groupBy(*keys).pivot(slot, list(range(1, slots + 1))).agg(F.sum(value))
    return wide.toDF(*keys, *names).fillna(0, subset=names)


def mean_popularity(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    slots_per_hour: int = 3,
    hours_per_day: int = 24,
) -> DataFrame:
    """Mean per hour and per day of a wide series: its sum over the hours and days it spans."""
    columns = list(columns or slot_names())
    hours = len(columns) / slots_per_hour
    total = row_sum(columns)
    return df.select(
        *keys,
        (total / hours).alias("per_hour"),
        (total / (hours / hours_per_day)).alias("per_day"),
    )
