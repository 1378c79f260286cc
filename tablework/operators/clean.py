"""Casting, null removal, renaming, min-max normalisation, stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.numeric import min_max, to_number


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Parse text columns to the given types in one projection; bad values become null."""
    wanted = {name.lower(): kind for name, kind in types.items()}
    return df.select(
        *[
            to_number(c, wanted[c.lower()]).alias(c) if c.lower() in wanted else F.col(c)
            for c in df.columns
        ]
    )


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the rows that have a value in every (given) column."""
    return df.dropna(subset=list(columns) if columns else None)


def add_sum(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """New column ``out = a + b``; text columns are parsed first."""
    return df.withColumn(out, to_number(a) + to_number(b))


def normalise(df: DataFrame, columns: Sequence[str], prefix: str = "norm_") -> DataFrame:
    """Add ``prefix + column`` scaled to [0, 1].

    Minimum and maximum come from one scalar subquery over all columns, so the
    rows themselves are only projected: no join and no trip through the driver.
    """
    bounds = (
        df.agg(
            F.struct(
                *[F.min(c).alias(f"low_{c}") for c in columns],
                *[F.max(c).alias(f"high_{c}") for c in columns],
            ).alias("bounds")
        )
    ).scalar()
    return df.withColumns(
        {
            prefix + c: min_max(F.col(c), bounds[f"low_{c}"], bounds[f"high_{c}"])
            for c in columns
        }
    )


def sample_rows(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Sample without replacement: the rows whose key hashes below ``fraction``.

    The digest of seed and key decides, so a row is in or out however the table is
    split, and rows with equal keys go together. A null key counts as empty text.
    """
    if fraction >= 1:
        return df
    below = f"{max(0, round(fraction * 2**32)):08x}"
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return df.filter(F.substring(F.md5(text), 1, 8) < below)


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; equal rows are kept."""
    return reduce(DataFrame.unionByName, tables)
