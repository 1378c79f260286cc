"""Numeric column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(column: str, type_name: str = "double") -> Column:
    """Parse a text column; text that is no number becomes null."""
    return F.col(column).try_cast(type_name)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """``(value - low) / (high - low)``; null where the column is constant."""
    return F.try_divide(value - low, high - low)


def pearson(a: str, b: str) -> Column:
    """Sample correlation over the rows with both values; null where a column does not vary."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(x) * F.stddev_samp(y))


def row_sum(columns: Sequence[str]) -> Column:
    """Sum over the given columns of a row, in bigint."""
    cells = F.array(*[F.col(c).cast("bigint") for c in columns])
    return F.aggregate(cells, F.lit(0).cast("bigint"), lambda total, cell: total + cell)


def as_line(vector: str) -> Column:
    """The cells of an array as one comma-joined line of text."""
    return F.array_join(F.transform(vector, lambda x: x.cast("string")), ",")
