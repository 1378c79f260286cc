"""Shingle sets: vocabulary, index, sparse 0/1 matrix and its corner."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.functions.text import letter_tokens, shingles
from tablework.plans import dense_index, join_by_count, unnest

#: An index of up to so many shingles is sent to every executor, so that no row of the matrix is shuffled to it.
_INDEX_ROWS = 1_000_000


def shingle_sets(df: DataFrame, row_id: str, text: str, k: int = 5, tokens=letter_tokens) -> DataFrame:
    """``(row_id, shingles)``: the distinct ``k``-character runs of every text."""
    return df.select(row_id, shingles(tokens(text), k).alias("shingles"))


def shingle_vocabulary(sets: DataFrame) -> DataFrame:
    """Every shingle that occurs anywhere, once, with the number of its rows: ``(shingle, n)``."""
    return unnest(sets.select("shingles"), "shingles", "shingle").groupBy("shingle").agg(F.count("*").alias("n"))


def shingle_index(sets: DataFrame) -> DataFrame:
    """Vocabulary numbered from 0 in text order: ``(shingle, n, idx)``."""
    return dense_index(shingle_vocabulary(sets), "shingle", "idx")


def shingle_matrix(sets: DataFrame, row_id: str, index: DataFrame) -> DataFrame:
    """The ones of the 0/1 matrix: ``(row_id, idx)``.

    Swapping the two columns is the transposed matrix. A shingle of very many rows
    is joined in place, see ``join_by_count``.
    """
    ones = unnest(sets.select(row_id, "shingles"), "shingles", "shingle")
    # a short text and two numbers each: every executor may hold more of them than of other keys
    return join_by_count(ones, index, ["shingle"], "n", limit=_INDEX_ROWS).select(row_id, "idx")


def matrix_corner(
    df: DataFrame, row_id: str, text: str, n: int = 100, k: int = 5, tokens=letter_tokens
) -> DataFrame:
    """First ``n`` shingles by text order x first ``n`` rows by id, zeros kept.

    ``(idx, shingle, col, row_id, present)``. The corner is ``n * n`` cells. The
    first shingles of the vocabulary are among the first ``n`` of every text, so
    only those leave a row; nothing is numbered beyond the corner.
    """
    first = shingle_sets(df, row_id, text, k, tokens).select(
        F.slice(F.sort_array("shingles"), 1, n).alias("shingles")
    )
    shingle = shingle_vocabulary(first).select("shingle").orderBy("shingle").limit(n)
    rows = df.select(row_id, text).orderBy(row_id).limit(n)
    rows = shingle_sets(rows, row_id, text, k, tokens)
    by_text, by_id = Window.orderBy("shingle"), Window.orderBy(row_id)
    # both windows run over at most n rows
    shingle = shingle.withColumn("idx", F.row_number().over(by_text) - 1)
    rows = rows.withColumn("col", F.row_number().over(by_id) - 1)
    corner = shingle.agg(F.sort_array(F.collect_list(F.struct("idx", "shingle"))).alias("corner"))
    cells = rows.withColumn("corner", corner.scalar()).select(
        "col", row_id, "shingles", F.inline("corner")
    )
    return cells.select(
        "idx",
        "shingle",
        "col",
        row_id,
        F.array_contains("shingles", F.col("shingle")).cast("int").alias("present"),
    )


def corner_lines(corner: DataFrame, row_id: str, n: int = 100) -> DataFrame:
    """The corner as a table with one row per shingle and a 0/1 column per row id."""
    wide = corner.groupBy("idx", "shingle").pivot("col", list(range(n))).agg(F.first("present"))
    return wide.toDF("idx", "shingle", *[f"d{i}" for i in range(n)])
