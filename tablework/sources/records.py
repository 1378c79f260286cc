"""Marked-up text files with many records each."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablework.plans import dense_index, stage

_COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(line, text)``: all lines of the files in order of their names, numbered from 0.

    Rows of a split come in order, so a line's place is its file, split and row; the
    numbers are given by ranges of places, not in one task.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("at"),
        ).alias("_place"),
        F.col("value").alias("text"),
    )
    # written, as row numbers of a scan may differ between reads
    return dense_index(stage(lines, "lines"), "_place", "line").select("line", "text")


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    opening: str = "<BODY>",
    closing: str = "</BODY>",
    encoding: str = "ISO-8859-1",
    stride: int | None = None,
) -> DataFrame:
    """Texts between two markers as ``(path, pos, text)``: path and position identify a record.

    With a ``stride`` also ``(file_no, doc_id)``: the last number in the path, and
    ``file_no * stride + pos``. Files with equal numbers, or with ``stride`` records and
    more, are then an error, as their ids would clash.

    The closing marker is the line separator, so a large file is split like any
    line file and no task holds a whole one. The bytes are decoded after the
    split. ``pos`` counts the records of a file: rows are numbered inside a
    split, and the number of records in the earlier splits of the file is added.

    Compressed files (known by their ending) are read as streams, those that cannot be split by one
    task each, and a second time for their true size, which the file system does not know.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    scan = spark.read.option("lineSep", closing).text(paths)
    pieces = (
        scan.select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("_size"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_at"),
            F.octet_length("value").alias("_bytes"),
            F.decode(F.col("value").cast("binary"), encoding).alias("_piece"),
        )
        .withColumn("_found", F.contains("_piece", F.lit(opening)))
    )
    # One row per split. The text after a file's last closing marker is no record;
    # it is there when the pieces and their separators overrun the file size.
    splits = pieces.groupBy("path", "_split").agg(
        F.sum(F.col("_bytes") + len(closing.encode())).alias("_bytes"),
        F.max("_size").alias("_size"),
        F.max("_at").alias("_last"),
        F.count_if("_found").alias("_records"),
    )
    if any(re.search(_COMPRESSED, name) for name in scan.inputFiles()):
        splits = _true_sizes(splits, spark.read.option("lineSep", opening).text(paths), opening)
    whole = Window.partitionBy("path")
    earlier = whole.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.select(
        "path",
        "_split",
        F.coalesce(F.sum("_records").over(earlier), F.lit(0)).alias("_before"),
        F.when(
            (F.sum("_bytes").over(whole) > F.col("_size"))
            & (F.col("_split") == F.max("_split").over(whole)),
            F.col("_last"),
        ).alias("_open"),
    )
    inside = Window.partitionBy("path", "_split").orderBy("_at")
    records = (
        pieces.filter("_found")
        .withColumn("_pos", F.row_number().over(inside) - 1)
        .join(placed, ["path", "_split"])
        .filter(~F.equal_null("_at", "_open"))
    )
    pos = F.col("_before") + F.col("_pos")
    start = F.instr("_piece", opening) + len(opening)
    text = F.substring("_piece", start, F.length("_piece")).alias("text")
    if stride is None:
        return records.select("path", pos.alias("pos"), text)
    file_no = F.element_at(F.regexp_extract_all("path", F.lit("[0-9]+"), 0), -1).cast("bigint")
    # one row per file
    same = Window.partitionBy("_number")
    files = splits.select("path").distinct().withColumn("_number", F.coalesce(file_no, F.lit(0)))
    files = files.select("path", F.col("_number").alias("file_no"), F.count("*").over(same).alias("_files"))
    checked = (
        F.when(F.col("_files") > 1, F.raise_error(F.concat(F.lit("other files have the number of "), F.col("path"))))
        .when(pos >= stride, F.raise_error(F.concat(F.lit("more records than the stride in "), F.col("path"))))
        .otherwise(F.col("file_no") * stride + pos)
    )
    return records.join(files, "path").select("path", "file_no", pos.alias("pos"), checked.alias("doc_id"), text)


def _true_sizes(splits: DataFrame, cut_at_openings: DataFrame, opening: str) -> DataFrame:
    """``splits`` with the bytes that compressed files hold.

    Cut at the opening marker, all pieces of a file but the last end with one: their bytes and markers
    add up to the file, short of a marker if the file ends with one, and such a file is not closed either way.
    """
    sizes = (
        cut_at_openings.select(F.col("_metadata.file_path").alias("path"), F.octet_length("value").alias("_bytes"))
        .filter(F.col("path").rlike(_COMPRESSED))
        .groupBy("path")
        .agg((F.sum("_bytes") + (F.count("*") - 1) * len(opening.encode())).alias("_true"))
    )
    return splits.join(sizes, "path", "left").withColumn("_size", F.coalesce("_true", "_size")).drop("_true")
