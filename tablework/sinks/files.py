"""Result files, written by the executors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.numeric import as_line
from tablework.operators.clean import stack_tables


def write_delimited(
    df: DataFrame, path: str, mode: str = "errorifexists", one_file: bool = False, **options: str
) -> None:
    """CSV with a header. ``one_file`` is for results known to be small."""
    out = df.coalesce(1) if one_file else df
    out.write.mode(mode).options(header=True, **options).csv(path)


def write_vectors(df: DataFrame, vector: str, path: str, mode: str = "errorifexists") -> None:
    """Every array as one line of comma-joined numbers."""
    df.select(as_line(vector).alias("line")).write.mode(mode).text(path)


def write_popularity(
    df: DataFrame, platform: str, item: str, path: str, mode: str = "errorifexists"
) -> None:
    """``(item, avg_popularity)`` files in folders per platform and granularity."""
    long = df.select(
        platform,
        item,
        F.inline(
            F.array(
                F.struct(F.lit("hour").alias("granularity"), F.col("per_hour").alias("avg_popularity")),
                F.struct(F.lit("day").alias("granularity"), F.col("per_day").alias("avg_popularity")),
            )
        ),
    )
    long.write.mode(mode).partitionBy(platform, "granularity").option("header", True).csv(path)


def report_rows(sections: Mapping[str, DataFrame], key: str, value: str) -> DataFrame:
    """Ranked tables as one: ``(section, rank, key, value)``; each needs a ``rank`` column."""
    parts = [
        table.select(
            F.lit(name).alias("section"),
            F.col("rank"),
            F.col(key).cast("string").alias("key"),
            F.col(value).cast("string").alias("value"),
        )
        for name, table in sections.items()
    ]
    return stack_tables(parts)


def write_report(
    sections: Mapping[str, DataFrame], key: str, value: str, path: str, mode: str = "errorifexists"
) -> None:
    """Report tables in one folder per section."""
    rows = report_rows(sections, key, value)
    rows.write.mode(mode).partitionBy("section").option("header", True).csv(path)


def report_lines(sections: Mapping[str, DataFrame], key: str, value: str) -> DataFrame:
    """The report as text: ``(section_no, rank, key, value, line)``, a ``[section]`` line (rank 0) before each section.

    Null keys and values are empty; a line break inside one becomes a blank, as a row is one line.
    """
    number = F.create_map(*[x for i, name in enumerate(sections) for x in (F.lit(name), F.lit(i))])
    text = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\R", " ")
    rows = report_rows(sections, key, value).withColumn("line", F.concat_ws("\t", "rank", text("key"), text("value")))
    spark = rows.sparkSession
    heads = spark.createDataFrame([(n, 0, None, None, f"[{n}]") for n in sections], "section string, rank int, key string, value string, line string")
    every = heads.unionByName(rows)
    return every.select(number[F.col("section")].alias("section_no"), "rank", "key", "value", "line")


def write_report_text(
    sections: Mapping[str, DataFrame], key: str, value: str, path: str, mode: str = "errorifexists"
) -> None:
    """All sections, in the order given, as text files whose concatenation in name order is the report.

    Sections follow by rank, key and value. The sort is by ranges, so no task holds the report.
    """
    ordered = report_lines(sections, key, value).orderBy("section_no", "rank", "key", "value")
    ordered.select("line").write.mode(mode).text(path)


def write_matrix(matrix: DataFrame, group: str, path: str, mode: str = "errorifexists") -> None:
    """Square matrices, one folder per group."""
    matrix.write.mode(mode).partitionBy(group).option("header", True).csv(path)


def write_adjacency(lists: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Neighbour lists as JSON lines."""
    lists.write.mode(mode).json(path)
