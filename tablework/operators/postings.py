"""Inverted lists: the transposed 0/1 matrix in stored form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tablework.plans import join_lookup, list_parts, pack, stage, unpack

#: A segment covers this many row ids, so no list is longer, and a frequent shingle has many.
SPAN = 4096
# Ones, or pairs, that a task gathers before it sends them on.
_HELD = 1 << 21
# A cell is a segment by as many shingle numbers as give it so many places.
_PLACES = 1 << 26
# Pairs of shingles that a segment meets at a time.
_PAIRS = 1 << 22
# Shingles with their partners that every executor may hold.
_ASKED = 1_000_000


def _runs(keys: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of equal rows in ``keys``."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    return zip(starts, np.append(starts[1:], len(new)))


def _gather(span: int, wide: int):
    """Ones as packed rows: those of a segment and ``wide`` shingle numbers that a task holds at a time."""

    def packed(held: list[tuple]) -> pa.RecordBatch:
        idx, ids = (np.concatenate(c) for c in zip(*held))
        segment, high = ids // span, idx // wide
        at = (idx - high * wide) * span + (ids - segment * span)
        if (np.diff(segment) < 0).any() or (np.diff(high) != 0).any():
            order = np.lexsort((high, segment))
            segment, high, at = segment[order], high[order], at[order]
        out = []
        for start, end in _runs([segment, high]):
            places = np.sort(at[start:end])
            places = places[np.append(True, np.diff(places) > 0)]
            out.append((segment[start], high[start], len(places), pack(np.diff(places, prepend=0))))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["segment", "high", "size", "places"])

    def gather(batches):
        held, rows = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            rows += batch.num_rows
            if rows >= _HELD:
                yield packed(held)
                held, rows = [], 0
        if rows:
            yield packed(held)

    return gather


def _lists(span: int, wide: int):
    """Cell: the lists of a segment and ``wide`` shingle numbers."""

    def lists(key: tuple, parts: pa.Table) -> pa.Table:
        segment, high = (k.as_py() for k in key)
        sizes, data = parts.column("size").to_pylist(), parts.column("places").to_pylist()
        places = [np.cumsum(unpack(d, n)) for n, d in zip(sizes, data)]
        places = places[0] if len(places) == 1 else np.sort(np.concatenate(places))
        places = places[np.append(True, np.diff(places) > 0)]
        idx = places // span
        at = (places - idx * span).astype(np.int32)
        first = np.flatnonzero(np.append(True, np.diff(idx) > 0))
        steps = np.diff(at, prepend=np.int32(0))
        steps[first] = at[first]
        ends = np.append(first, len(at)).astype(np.int32)
        return pa.table(
            {
                "idx": idx[first] + high * wide,
                "segment": np.full(len(first), segment, dtype=np.int64),
                "n": np.diff(ends),
                "deltas": pa.ListArray.from_arrays(pa.array(ends), pa.array(steps)),
            }
        )

    return lists


def posting_lists(ones: DataFrame, row_id: str, idx: str = "idx", span: int = SPAN) -> DataFrame:
    """``(idx, segment, n, deltas)``: the rows that hold a shingle, by segments of ``span`` row ids.

    ``deltas`` are the steps between rising ids, the first one from the segment's least
    possible id (``segment * span``), so all are small whole numbers. Repeated ones count once; nulls drop out.

    A task packs the ones it reads by segment before the only shuffle, some bytes for each; a segment's lists
    are then made together, a bounded number of shingles at a time.
    """
    ids = ones.select(F.col(idx).cast("long").alias("idx"), F.col(row_id).cast("long").alias("_id")).dropna()
    wide = max(1, _PLACES // span)
    cells = ids.mapInArrow(_gather(span, wide), "segment bigint, high bigint, size bigint, places binary")
    lists = cells.groupBy("segment", "high").applyInArrow(_lists(span, wide), "idx bigint, segment bigint, n int, deltas array<int>")
    return lists.withColumn("idx", F.col("idx").cast(ones.schema[idx].dataType))


@F.pandas_udf(ArrayType(IntegerType()))
def _places(deltas: pd.Series) -> pd.Series:
    return deltas.map(lambda d: np.cumsum(d, dtype=np.int32))


def posting_rows(lists: DataFrame, span: int = SPAN) -> DataFrame:
    """``(idx, row_id)``: the ones of the matrix again."""
    return lists.select("idx", "segment", F.explode(_places("deltas")).alias("_at")).select(
        "idx", (F.col("segment") * span + F.col("_at")).alias("row_id")
    )


def _gather_lists(batches):
    """Lists (idx, segment, block, deltas, partners) as packed rows, those of a segment and block that come together."""
    for batch in batches:
        idx, segment, block = (batch.column(c).to_numpy() for c in range(3))
        order = np.lexsort((idx, block, segment))
        idx, segment, block = idx[order], segment[order], block[order]
        sizes, steps = list_parts(batch.column(3).take(pa.array(order)))
        many, partners = list_parts(batch.column(4).take(pa.array(order)))
        step_at, partner_at = np.append(0, np.cumsum(sizes)), np.append(0, np.cumsum(many))
        out = []
        for start, end in _runs([segment, block]):
            near = np.repeat(idx[start:end], many[start:end])
            parts = [np.diff(idx[start:end], prepend=0), sizes[start:end], steps[step_at[start] : step_at[end]]]
            parts += [many[start:end], partners[partner_at[start] : partner_at[end]] - near]
            out.append((segment[start], block[start], [len(p) for p in parts], [pack(p) for p in parts]))
        columns = [pa.array(c) for c in zip(*out)]
        if out:
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "block", "sizes", "parts"])


def _meet(parts: pa.Table) -> pa.Table:
    """Cell: in how many rows of a segment both shingles of a pair lie; pairs without any are left out."""
    held = [[unpack(d, n) for d, n in zip(*row)] for row in zip(parts.column("parts").to_pylist(), parts.column("sizes").to_pylist())]
    idx = np.concatenate([np.cumsum(h[0]) for h in held])
    sizes, steps, many, partners = (np.concatenate([h[c] for h in held]) for c in range(1, 5))
    ends = np.cumsum(sizes)
    at = np.cumsum(steps)
    at -= np.repeat(np.where(ends > sizes, at[ends - sizes - 1], 0), sizes)
    a, b = np.repeat(np.arange(len(idx)), many), partners + np.repeat(idx, many)
    order = np.argsort(idx, kind="stable")
    found = np.minimum(np.searchsorted(idx[order], b), len(idx) - 1)
    other = order[found]
    met = idx[other] == b
    a, other = a[met], other[met]
    span = int(at.max()) + 1
    places = np.sort(np.repeat(np.arange(len(idx)), sizes) * span + at)
    names, counts = [], []
    work = np.cumsum(sizes[a])
    start = 0
    while start < len(a):
        done = work[start - 1] if start else 0
        end = max(int(np.searchsorted(work, done + _HELD, side="right")), start + 1)
        x, y = a[start:end], other[start:end]
        n = sizes[x]
        # the places of all lists x, looked up among those of y
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[x] - n, n)
        wanted = np.repeat(y, n) * span + at[inside]
        hit = places[np.minimum(np.searchsorted(places, wanted), len(places) - 1)] == wanted
        names.append((idx[x], idx[y]))
        counts.append(np.bincount(np.repeat(np.arange(len(x)), n), hit, len(x)).astype(np.int64))
        start = end
    empty = np.empty(0, dtype=np.int64)
    n = np.concatenate([empty, *counts])
    columns = [np.concatenate([empty, *c])[n > 0] for c in ([p[0] for p in names], [p[1] for p in names])]
    return pa.table({"a": columns[0], "b": columns[1], "_n": n[n > 0]})


def shared_rows(lists: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(a, b, n)``: in how many rows both shingles of each of ``pairs`` (a, b) lie, zeros kept.

    Lists learn their partners, broadcast up to a million shingles, then a segment's lists meet in one
    task, packed, with at most some four million pairs at a time: of more pairs each block has its own cells.
    """
    pairs = stage(pairs.select("a", "b").distinct(), "pairs")
    blocks = -(-max(pairs.count(), 1) // _PAIRS)
    block = F.pmod(F.xxhash64("a", "b"), F.lit(blocks)).cast("long")
    known = pairs.dropna().select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), block.alias("block"))
    both = F.array(F.struct(F.col("a").alias("idx"), F.col("b").alias("partner")), F.struct(F.col("b").alias("idx"), F.lit(None).cast("long").alias("partner")))
    sides = known.select("block", F.inline(both)).groupBy("idx", "block").agg(F.collect_list("partner").alias("partners"))
    asked = join_lookup(lists.withColumn("idx", F.col("idx").cast("long")), stage(sides, "partners"), "idx", limit=_ASKED)
    cells = asked.select("idx", "segment", "block", "deltas", "partners").mapInArrow(
        _gather_lists, "segment bigint, block bigint, sizes array<bigint>, parts array<binary>"
    )
    met = cells.groupBy("segment", "block").applyInArrow(_meet, "a bigint, b bigint, _n bigint")
    counts = met.groupBy("a", "b").agg(F.sum("_n").alias("n"))
    return pairs.join(counts, ["a", "b"], "left").select("a", "b", F.coalesce("n", F.lit(0)).alias("n"))
