"""Comparison of two sides group by group, cut into cells of bounded size."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.plans.skew import join_by_count

Cell = Callable[[tuple, pa.Table, pa.Table], pa.Table]


# Blocks are made smaller than asked for, down to this, while there are idle cores.
_SMALLEST_BLOCK = 512


def _blocks(rows: str, block_rows: int, wanted: int):
    needed = F.ceil(F.col(rows) / block_rows)
    useful = F.least(F.ceil(F.col(rows) / _SMALLEST_BLOCK), F.lit(wanted))
    return F.greatest(needed, useful, F.lit(1)).cast("int")


def _block_of(row_id: str, blocks: str):
    return F.pmod(F.xxhash64(row_id), F.col(blocks)).cast("int")


def block_cells(
    left: DataFrame,
    right: DataFrame,
    group: str,
    row_id: str,
    cell: Cell,
    schema: str,
    block_rows: int = 16384,
    mirrored: bool = False,
    few_groups: bool = False,
) -> DataFrame:
    """Run ``cell`` on every (left block, right block) of each group.

    Both sides carry ``group`` and ``row_id``. The rows of a group fall into
    blocks of about ``block_rows`` by a hash of their id, so one hot group turns
    into many equal cells instead of one task, and a cell works on at most two
    blocks. A cell returns only the rows that pass its own test: no pair leaves
    the task unless it belongs to the result.

    ``mirrored``: both sides are the same table and only one of the cells
    (i, j) and (j, i) is wanted. ``few_groups``: a parameter bounds the number of
    groups, so their sizes may be broadcast.
    """
    # fresh column identities, as both sides may be the same table
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    n_left = left.groupBy(group).agg(F.count("*").alias("_n_left"))
    n_right = right.groupBy(group).agg(F.count("*").alias("_n_right"))
    wanted = math.isqrt(left.sparkSession.sparkContext.defaultParallelism - 1) + 1
    sizes = n_left.join(n_right, group).select(
        group,
        "_n_left",
        "_n_right",
        _blocks("_n_left", block_rows, wanted).alias("_left_blocks"),
        _blocks("_n_right", block_rows, wanted).alias("_right_blocks"),
    )

    def with_blocks(side: DataFrame, rows: str) -> DataFrame:
        if few_groups:
            return side.join(F.broadcast(sizes), group)
        return join_by_count(side, sizes, [group], rows)

    own = F.col("_own")
    if mirrored:
        left_cells = F.sequence(own, F.col("_right_blocks") - 1)
        right_cells = F.sequence(F.lit(0), own)
    else:
        left_cells = F.sequence(F.lit(0), F.col("_right_blocks") - 1)
        right_cells = F.sequence(F.lit(0), F.col("_left_blocks") - 1)
    left_rows = (
        with_blocks(left, "_n_left")
        .withColumn("_own", _block_of(row_id, "_left_blocks"))
        .select(*left.columns, own.alias("_i"), F.explode(left_cells).alias("_j"))
    )
    right_rows = (
        with_blocks(right, "_n_right")
        .withColumn("_own", _block_of(row_id, "_right_blocks"))
        .select(*right.columns, F.explode(right_cells).alias("_i"), own.alias("_j"))
    )
    keys = [group, "_i", "_j"]
    return left_rows.groupBy(*keys).cogroup(right_rows.groupBy(*keys)).applyInArrow(cell, schema)
