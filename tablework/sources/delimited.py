"""Delimited text files: every column is read as text, numbers are parsed afterwards."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    header: bool = True,
    names: Sequence[str] | None = None,
    drop_malformed: bool = False,
    **options: str,
) -> DataFrame:
    """Scan delimited files, all columns as text.

    ``drop_malformed`` drops rows with too few or too many fields. Column
    pruning is switched off for that read, because a pruned scan looks at fewer
    fields and would keep rows that a full scan drops. ``names`` gives the
    column names by position and saves the look at the header line.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    if drop_malformed:
        reader = reader.option("mode", "DROPMALFORMED").option("columnPruning", False)
    if names:
        reader = reader.schema(text_schema(names))
    return reader.options(**options).csv(paths if isinstance(paths, str) else list(paths))


def read_first(read: Callable[[str], DataFrame], paths: Sequence[str]) -> DataFrame:
    """Read the first path that exists, for instance a local one and then an HDFS one."""
    for path in paths[:-1]:
        try:
            return read(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return read(paths[-1])


def read_union(read: Callable[[str], DataFrame], paths: Sequence[str]) -> DataFrame:
    """Stack several files of one kind; equal rows are kept."""
    return reduce(DataFrame.unionByName, [read(path) for path in paths])
