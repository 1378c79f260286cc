"""Column statistics: summary, median, mode, correlation, arg-max."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.numeric import pearson
from tablework.plans import running_total, stage

# Rank error of the sketch that brackets the median, as one part in ...
_SKETCH_ACCURACY = 10000
_BRACKET = 10 / _SKETCH_ACCURACY


def by_column(df: DataFrame, columns: Sequence[str], type_name: str = "double") -> DataFrame:
    """One row per cell: ``(column_name, value)``."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast(type_name).alias("value"))
        for c in columns
    ]
    return df.select(F.inline(F.array(*pairs)))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, n, mean, stddev, min, max)``, one aggregate over one scan."""
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def value_counts(df: DataFrame, columns: Sequence[str], type_name: str = "double") -> DataFrame:
    """``(column_name, value, n)`` of every value, nulls with 0, written once for several statistics."""
    counts = by_column(df, columns, type_name).groupBy("column_name", "value").agg(F.count("value").alias("n"))
    return stage(counts, "value_counts")


def median(df: DataFrame, columns: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """Exact median of every column as ``(column_name, median)``; null for a column of nulls.

    A sketch gives, in one scan, bounds that surely enclose the middle ranks.
    The second scan counts the values between the bounds one by one and all
    values below them as a single number; running totals over that small part
    then find the middle. No task ever holds a column's distinct values. With ``counts``, the
    ``value_counts`` of ``df`` as doubles, these are read instead of the second scan.
    """
    low, high = 0.5 - _BRACKET, 0.5 + _BRACKET
    found = df.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[
            F.percentile_approx(F.col(c).cast("double"), [low, high], _SKETCH_ACCURACY).alias(
                f"q_{i}"
            )
            for i, c in enumerate(columns)
        ],
    ).first()
    filled = [i for i in range(len(columns)) if found[f"n_{i}"]]
    blank = [(c,) for i, c in enumerate(columns) if i not in filled]
    blank = df.sparkSession.createDataFrame(blank, "column_name string").withColumn("median", F.lit(None).cast("double"))
    if not filled:
        return blank

    def per_column(values: dict[int, float | int]) -> Column:
        choice = F
        for i, value in values.items():
            choice = choice.when(F.col("column_name") == columns[i], F.lit(value))
        return choice

    lowest = per_column({i: found[f"q_{i}"][0] for i in filled})
    highest = per_column({i: found[f"q_{i}"][1] for i in filled})
    total = per_column({i: found[f"n_{i}"] for i in filled})
    values = by_column(df, [columns[i] for i in filled]).withColumn("n", F.lit(1)) if counts is None else counts
    bracket = (
        values.filter(F.col("value") <= highest)
        .select("column_name", F.when(F.col("value") >= lowest, F.col("value")).alias("value"), "n")
        .groupBy("column_name", "value")
        .agg(F.sum("n").alias("rows"))
    )
    ranked = running_total(bracket, "column_name", [F.col("value").asc_nulls_first()], "rows", "upto")

    def value_at(rank: Column) -> Column:
        holds = (F.col("upto") >= rank) & (F.col("upto") - F.col("rows") < rank)
        return F.max(F.when(holds, F.col("value")))

    lower, upper = F.floor((total + 1) / 2), F.floor(total / 2) + 1
    middle = (value_at(lower) + value_at(upper)) / 2
    found = ranked.groupBy("column_name").agg(
        F.coalesce(middle, F.raise_error(F.lit("median outside its bracket")).cast("double")).alias(
            "median"
        )
    )
    return found.unionByName(blank)


def mode(df: DataFrame, columns: Sequence[str], type_name: str = "double", counts: DataFrame | None = None) -> DataFrame:
    """Most frequent value of every column, the smallest one on a tie: ``(column_name, mode, n)``.

    A column of nulls has the mode null with 0 rows. ``type_name`` holds the values: take
    "decimal(38,0)" for bigints above 2^53. ``counts``: the ``value_counts`` of ``df``, if at hand.
    """
    if counts is None:
        counts = by_column(df, columns, type_name).groupBy("column_name", "value").agg(F.count("value").alias("n"))
    # nulls are counted as 0 and so come last
    first = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return counts.groupBy("column_name").agg(first.alias("top")).select(
        "column_name", F.col("top.value").alias("mode"), (-F.col("top.rank")).alias("n")
    )


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation of two columns, all parts taken from the data."""
    return df.agg(F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias("n"),
                  pearson(a, b).alias("corr"))


def arg_max(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """For every column the label of its largest value: ``(column_name, label, value)``.

    On a tie the largest label wins; a column of nulls has neither label nor value. All
    columns share one aggregate; values are compared in their own type.
    """
    rows = []
    for c in columns:
        pair = F.struct(F.col(c).alias("value"), F.col(label).alias("label"))
        best = F.max(F.when(F.col(c).isNotNull(), pair))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                best["label"].alias("label"),
                best["value"].cast("double").alias("value"),
            )
        )
    known = df.select(label, *columns)
    return known.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
