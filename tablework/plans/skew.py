"""Joins of many rows with one row per key: size checked, hot keys set apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.plans.staging import stage

# A key is hot above this fraction of the rows; so there are fewer than that many hot keys.
_HOT = 1000

# Narrow lookup rows that every executor may hold.
_LOOKUP_ROWS = 200_000


def join_lookup(
    rows: DataFrame, lookup: DataFrame, on, limit: int = _LOOKUP_ROWS
) -> DataFrame:
    """Inner join with a written table, broadcast only if it counts ``limit`` rows or fewer.

    Otherwise both sides are shuffled and merged (adaptive execution splits skewed
    partitions). The choice is not left to size estimates: they do not see that
    exploding an array multiplies rows, and may pick the exploded side.
    """
    small = lookup.limit(limit + 1).count() <= limit
    return rows.join(F.broadcast(lookup) if small else lookup.hint("merge"), on)


def _frequent(counts: DataFrame, rows: str, limit: int | None):
    """The condition on ``rows`` that sets hot keys apart, and of more than ``limit`` keys the most
    frequent, up to ``limit``, if they have nine tenths of the rows."""
    bits = F.length(F.bin(rows))
    found = counts.groupBy(bits.alias("bits")).agg(F.count("*").alias("keys"), F.sum(rows).alias("rows")).collect()  # at most 64 rows
    total = sum(r["rows"] or 0 for r in found)
    # a thousandth of the rows is hot however many keys there are; on few rows every key would be
    hot = (F.col(rows) * _HOT > total) & (F.col(rows) >= _HOT)
    keys = covered = 0
    if limit is None or sum(r["keys"] for r in found) <= limit:
        return hot
    for r in sorted((r for r in found if r["bits"]), key=lambda r: -r["bits"]):
        keys, covered = keys + r["keys"], covered + r["rows"]
        if keys > limit:
            break
        if total >= limit and covered * 10 >= total * 9:
            return hot | (F.col(rows) >= 1 << (r["bits"] - 1))
    return hot


def join_by_count(left: DataFrame, counts: DataFrame, keys: list[str], rows: str, limit: int | None = None) -> DataFrame:
    """Inner join of ``left`` with ``counts``: one row per key, ``rows`` = its rows in ``left``.

    The counts say which keys are hot. There can be no more than a thousand with
    over a thousandth of the rows each, so these few are broadcast and their rows
    stay where they are; only rows of ordinary keys are shuffled.

    ``limit``, for narrow counts: up to so many are broadcast in one join. Of more, so are the most
    frequent keys that make nearly all rows, and only rows of the rare ones are shuffled.
    """
    counts = stage(counts, "counts")
    if limit is not None and counts.limit(limit + 1).count() <= limit:
        return left.join(F.broadcast(counts), keys)
    hot = _frequent(counts, rows, limit)
    heavy = counts.filter(hot)
    if heavy.isEmpty():
        return join_lookup(left, counts, keys)
    light = counts.filter(~hot)
    hot_keys = F.broadcast(heavy.select(*keys))
    return left.join(F.broadcast(heavy), keys).unionByName(
        join_lookup(left.join(hot_keys, keys, "left_anti"), light, keys)
    )
