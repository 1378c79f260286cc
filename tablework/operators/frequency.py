"""Frequency tables and their top entries, overall and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.operators.profile import by_column
from tablework.plans import unnest


def word_counts(df: DataFrame, tokens: str, *groups: str) -> DataFrame:
    """Occurrences of every word of a token column, per group if groups are given."""
    return (
        unnest(df.select(*groups, tokens), tokens, "word")
        .groupBy(*groups, "word")
        .agg(F.count("*").alias("n"))
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Occurrences of every value of several columns: ``(column_name, value, n)``."""
    return by_column(df, columns, "string").groupBy("column_name", "value").agg(
        F.count("*").alias("n")
    )


def top(counts: DataFrame, item: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent items; equal counts in item order."""
    return counts.orderBy(F.desc("n"), F.asc(item)).limit(n)


def top_per_group(counts: DataFrame, group: str, item: str, n: int = 100) -> DataFrame:
    """The ``n`` most frequent items of every group, with their ``rank``.

    Each partition first keeps its own ``n`` best per group, so a hot group
    sends no more rows than a small one.
    """
    best = Window.partitionBy(group).orderBy(F.desc("n"), F.asc(item))
    return counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def first_groups(ranked: DataFrame, group: str, take: int) -> DataFrame:
    """All rows of the first ``take`` groups by group value; a null group comes first."""
    groups = ranked.select(F.col(group).alias("_group")).distinct().orderBy("_group").limit(take)
    return ranked.join(F.broadcast(groups), F.col(group).eqNullSafe(F.col("_group")), "left_semi")


def top_value_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Most frequent value of every group, most frequent group first: ``(group, value, n)``."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"))
    return top_per_group(counts, group, value, 1).drop("rank").orderBy(F.desc("n"), F.asc(group))
