"""k nearest neighbours, exact and by sign buckets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.functions.hashing import SignPlanes, probed_buckets, sign_buckets
from tablework.plans import block_cells, stage

_SCORES = 1 << 21  # similarities held at once inside a cell
_GROUP = 64  # columns of which only the best says how good the best of all are at least
_PAIRS = 1 << 16  # pairs of vectors held at once
_FEW_BUCKETS = 1 << 17  # bucket sizes that may be broadcast unseen
Z = 2.575829  # 99 of 100 intervals hold the true recall
_DIGITS = 9  # similarities are compared after rounding, so ties do not hang on float noise


def _cosine(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1)[None, :]
    return np.divide(q @ c.T, length, out=np.zeros((len(q), len(c))), where=length > 0)


def _jaccard(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    q, c = (q != 0).astype(np.float64), (c != 0).astype(np.float64)
    both = q @ c.T
    either = q.sum(axis=1)[:, None] + c.sum(axis=1)[None, :] - both
    return np.divide(both, either, out=np.zeros_like(both), where=either > 0)


def _agreement(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    share = np.empty((len(q), len(c)))
    by_place = np.ascontiguousarray(c.T)
    # few query rows at a time, so the counters stay in the processor's cache
    step = max(1, (1 << 18) // max(len(c), 1))
    hit = np.empty((min(step, len(q)), len(c)), dtype=bool)
    equal = np.empty(hit.shape, dtype=np.uint8 if q.shape[1] < 256 else np.int32)
    for at in range(0, len(q), step):
        rows = q[at : at + step]
        now, sums = hit[: len(rows)], equal[: len(rows)]
        sums[:] = 0
        for i, place in enumerate(by_place):
            np.equal(rows[:, i, None], place, out=now)
            sums += now
        np.divide(sums, q.shape[1], out=share[at : at + step])
    return share


MEASURES = {"cosine": _cosine, "jaccard": _jaccard, "agreement": _agreement}


def _matrix(side: pa.Table, measure: str) -> np.ndarray:
    cells = side.column("vec").combine_chunks()
    if len(pc.unique(pc.list_value_length(cells))) > 1 or cells.flatten().null_count:
        raise ValueError("vectors differ in length or have null cells")
    flat = cells.flatten().to_numpy(zero_copy_only=False)
    kind = flat.dtype if measure == "agreement" else np.float64
    return flat.reshape(len(cells), -1).astype(kind)


def _cosine_bound(q: np.ndarray, c: np.ndarray):
    """(bounds, scores of pairs, the bound that a score needs): half as wide numbers bound the cosines; None if some do not fit."""
    sides, lengths = [], []
    for side in (q, c):
        length = np.linalg.norm(side, axis=1)
        unit = np.divide(side, length[:, None], out=np.zeros_like(side), where=length[:, None] > 0).astype(np.float32)
        if not (np.isfinite(length).all() and np.isfinite(unit).all()):
            return None
        sides.append(unit)
        lengths.append(length)
    (x, y), (m, n) = sides, lengths

    def bounds(start: int, end: int) -> np.ndarray:
        return x[start:end] @ y.T

    def scores(r: np.ndarray, i: np.ndarray) -> np.ndarray:
        length = m[r] * n[i]
        return np.divide(np.einsum("ij,ij->i", q[r], c[i]), length, out=np.zeros(len(r)), where=length > 0)

    slack = (q.shape[1] + 8) * 2.0**-22
    return bounds, scores, lambda kth: (kth - slack).astype(np.float32)


def _bit_planes(rows: np.ndarray) -> list[list[np.ndarray]]:
    """By 64 places: for each of the ``_LOW`` lowest bits of a value, a word per row with that bit of every place."""
    words = []
    for at in range(0, rows.shape[1], 64):
        part = np.zeros((len(rows), 64), dtype=np.uint8)
        part[:, : rows[:, at : at + 64].shape[1]] = rows[:, at : at + 64].astype(np.uint8)
        words.append([np.packbits((part >> bit) & 1, axis=1).view(np.uint64)[:, 0] for bit in range(_LOW)])
    return words


def _agreement_bound(q: np.ndarray, c: np.ndarray):
    """Places equal in their lowest bits are at least as many as equal places, and many times faster to count."""
    places = q.shape[1]
    if q.dtype.kind not in "iu" or c.dtype.kind not in "iu" or not 0 < places < 1 << 15:
        return None
    x, y = _bit_planes(q), _bit_planes(c)

    def bounds(start: int, end: int) -> np.ndarray:
        equal = np.empty((end - start, len(c)), dtype=np.int16)
        differ, other = np.empty(len(c), dtype=np.uint64), np.empty(len(c), dtype=np.uint64)
        for row, counts in enumerate(equal, start):
            counts[:] = places
            for mine, theirs in zip(x, y):
                np.bitwise_xor(theirs[0], mine[0][row], out=differ)
                for bit in range(1, _LOW):
                    np.bitwise_xor(theirs[bit], mine[bit][row], out=other)
                    np.bitwise_or(differ, other, out=differ)
                counts -= np.bitwise_count(differ)
        return equal

    def scores(r: np.ndarray, i: np.ndarray) -> np.ndarray:
        return (q[r] == c[i]).sum(axis=1) / places

    return bounds, scores, lambda kth: np.rint(kth * places).astype(np.int16)


_LOW = 6  # bits of a value that are compared first
BOUNDS = {"cosine": _cosine_bound, "agreement": _agreement_bound}


def _in_parts(scores, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    parts = [scores(r[at : at + _PAIRS], c[at : at + _PAIRS]) for at in range(0, len(r), _PAIRS)]
    return np.round(np.concatenate(parts) if parts else np.empty(0), _DIGITS)


def _first(r: np.ndarray, c: np.ndarray, sim: np.ndarray, k: int):
    """The ``k`` best of each row, best first; the smaller id, which is the smaller c, on a tie."""
    best = np.lexsort((c, -sim, r))
    r, c, sim = r[best], c[best], sim[best]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < k
    return r[keep], c[keep], sim[keep]


def _own(sim: np.ndarray):
    """What stands for a row itself: less than any similarity."""
    return -np.inf if sim.dtype.kind == "f" else -1


def _over(bounds: np.ndarray, scores, needed, k: int):
    """(row, column, similarity) of the ``k`` best of each row, or None if too many are as good.

    The largest of ``k`` groups of columns are ``k`` columns; their similarities say which bounds can matter.
    """
    rows, wide = bounds.shape
    groups = wide // _GROUP
    if groups < 4 * k:
        return None
    most = bounds[:, : groups * _GROUP].reshape(rows, _GROUP, groups).max(axis=1)
    least = np.partition(most, groups - k, axis=1)[:, groups - k]
    r, c = np.nonzero(bounds >= least[:, None])
    if (least <= _own(bounds)).any() or len(r) > bounds.size // _GROUP:
        return None
    r, c, sim = _first(r, c, _in_parts(scores, r, c), k)
    kth = np.minimum.reduceat(sim, np.searchsorted(r, np.arange(rows)))
    r, c = np.nonzero((bounds >= needed(kth)[:, None]) & (bounds > _own(bounds)))
    if len(r) > bounds.size // 4:
        return None
    return _first(r, c, _in_parts(scores, r, c), k)


def _nearest(measure: str, k: int, with_self: bool):
    """Cell: the ``k`` best rows of the right block for every query of the left block."""
    score = MEASURES[measure]

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            order = np.argsort(right.column("id").to_numpy(), kind="stable")
            ids = right.column("id").to_numpy()[order]
            rows = _matrix(right, measure)[order]
            asked, queries = left.column("id").to_numpy(), _matrix(left, measure)
            own_from, own_to = (np.searchsorted(ids, asked, side) for side in ("left", "right"))
            step = max(1, _SCORES // len(ids))
            bound = BOUNDS[measure](queries, rows) if measure in BOUNDS else None

            def without_own(sim: np.ndarray, at: int) -> np.ndarray:
                if not with_self:
                    for i, (start, end) in enumerate(zip(own_from[at : at + len(sim)], own_to[at : at + len(sim)])):
                        sim[i, start:end] = _own(sim)
                return sim

            for at in range(0, len(asked), step):
                mine, found = asked[at : at + step], None
                if bound is not None:
                    bounds, scores, needed = bound
                    near = without_own(bounds(at, at + len(mine)), at)
                    found = _over(near, lambda r, c: scores(r + at, c), needed, k)
                if found is None:
                    sim = without_own(np.round(score(queries[at : at + step], rows), _DIGITS), at)
                    if k < len(ids):
                        kth = np.partition(sim, len(ids) - k, axis=1)[:, len(ids) - k]
                    else:
                        kth = np.full(len(mine), -np.inf)
                    r, c = np.nonzero((sim >= kth[:, None]) & (sim > -np.inf))
                    found = _first(r, c, sim[r, c], k)
                r, c, sim = found
                out.append((mine[r], ids[c], sim))
        kinds = (np.int64, np.int64, np.float64)
        columns = [np.concatenate(p) for p in zip(*out)] if out else [np.empty(0, t) for t in kinds]
        return pa.table(dict(zip(("query", "neighbour", "similarity"), columns)))

    return nearest


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), F.asc("neighbour"))
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query", "rank", "neighbour", "similarity")
    )


_SCORED = "query bigint, neighbour bigint, similarity double"


def exact_neighbours(
    queries: DataFrame,
    rows: DataFrame,
    k: int = 3,
    measure: str = "cosine",
    with_self: bool = False,
    block_rows: int = 32768,
) -> DataFrame:
    """``(query, rank, neighbour, similarity)`` by linear search; ``(id, vec)`` on both sides.

    Equal similarities are ranked by id. Rows without a vector take no part; vectors of
    different lengths, or with null cells, are an error. The search compares blocks of
    rows, and only ``k`` rows per query leave a cell. It takes queries x rows comparisons:
    it is for a query side that does not grow with the table.
    """
    everything = F.lit(0).alias("bucket")
    scored = block_cells(
        queries.filter(F.col("vec").isNotNull()).select("id", "vec", everything),
        rows.filter(F.col("vec").isNotNull()).select("id", "vec", everything),
        "bucket",
        "id",
        _nearest(measure, k, with_self),
        _SCORED,
        block_rows,
        few_groups=True,
    )
    return _best(scored, k)


def bucketed(df: DataFrame, planes: SignPlanes, vector: str = "vec") -> DataFrame:
    """Add ``bucket``: the row once per table of planes, with its table and sign bits."""
    spread_out = df.select("*", F.posexplode_outer(sign_buckets(vector, planes)).alias("_t", "_bits"))
    bucket = F.struct(F.col("_t").alias("t"), F.col("_bits").alias("bits"))
    return spread_out.withColumn("bucket", bucket).drop("_t", "_bits")


def planes_for(rows: int, dim: int, tables: int = 8, bucket_rows: int = 32, seed: int = 7) -> SignPlanes:
    """As many planes a table as leave about ``bucket_rows`` rows in a bucket: they grow with the table."""
    return SignPlanes(max(1, min(24, round(math.log2(max(rows, 1) / bucket_rows)))), tables, dim, seed)


def probed(df: DataFrame, planes: SignPlanes, weak: int, vector: str = "vec") -> DataFrame:
    """Like ``bucketed``, with the row once per bucket to be asked: ``2 ** weak`` of each table."""
    tables = df.select("*", F.posexplode(probed_buckets(vector, planes, weak)).alias("_t", "_asked"))
    each = tables.select(*df.columns, "_t", F.explode("_asked").alias("_bits"))
    return each.select(*df.columns, F.struct(F.col("_t").alias("t"), F.col("_bits").alias("bits")).alias("bucket"))


def approximate_neighbours(
    queries: DataFrame,
    rows: DataFrame,
    planes: SignPlanes,
    k: int = 3,
    measure: str = "cosine",
    with_self: bool = False,
    block_rows: int = 32768,
    weak: int = 0,
) -> DataFrame:
    """Like ``exact_neighbours``, among rows on the same side of all planes of some table.

    With ``weak``, a query asks for the rows on either side of its ``weak`` nearest planes of a table, which
    finds more with fewer tables and smaller buckets (see ``planes_for``). The rows stay in one bucket a table.

    A bucket that holds a large share of the rows is cut into blocks like the
    whole table in the exact search. Rows without a vector take no part. The sizes of
    the buckets are broadcast if there can be only few, else joined.
    """
    known = F.col("vec").isNotNull()
    placed = stage(bucketed(rows.filter(known).select("id", "vec"), planes), "buckets")
    if weak:
        asked = stage(probed(queries.filter(known).select("id", "vec"), planes, weak), "probes")
    elif queries is rows:
        asked = placed
    else:
        asked = bucketed(queries.filter(known).select("id", "vec"), planes)
    scored = block_cells(
        asked,
        placed,
        "bucket",
        "id",
        _nearest(measure, k, with_self),
        _SCORED,
        block_rows,
        few_groups=planes.tables << planes.planes <= _FEW_BUCKETS,
    )
    # several tables may find the same neighbour
    return _best(scored.groupBy("query", "neighbour").agg(F.max("similarity").alias("similarity")), k)


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """``(wanted, found, recall)``: the share of exact neighbours that were found."""
    wanted = exact.select("query", "neighbour")
    found = approximate.select("query", "neighbour", F.lit(1).alias("_hit"))
    return wanted.join(found, ["query", "neighbour"], "left").agg(
        F.count("*").alias("wanted"),
        F.count("_hit").alias("found"),
        F.try_divide(F.count("_hit"), F.count("*")).alias("recall"),
    )


def recall_interval(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """``(queries, wanted, found, recall, low, high)`` from a sample of queries, e.g. ``clean.sample_rows``.

    ``recall`` is the mean of the queries' own recalls, as neighbours of one query are not
    independent; the interval is ``Z`` standard errors wide on each side. One query alone has no interval.
    """
    wanted = exact.select("query", "neighbour")
    found = approximate.select("query", "neighbour", F.lit(1).alias("_hit"))
    each = wanted.join(found, ["query", "neighbour"], "left").groupBy("query").agg(
        F.count("*").alias("wanted"), F.count("_hit").alias("found")
    )
    share = F.col("found") / F.col("wanted")
    total = each.agg(
        F.count("*").alias("queries"),
        F.coalesce(F.sum("wanted"), F.lit(0)).alias("wanted"),
        F.coalesce(F.sum("found"), F.lit(0)).alias("found"),
        F.avg(share).alias("recall"),
        F.stddev_samp(share).alias("_spread"),
    )
    margin = F.lit(Z) * F.col("_spread") / F.sqrt("queries")
    # greatest and least would skip a missing margin
    low, high = (F.when(margin.isNotNull(), limit) for limit in (F.greatest(F.col("recall") - margin, F.lit(0.0)), F.least(F.col("recall") + margin, F.lit(1.0))))
    return total.select("queries", "wanted", "found", "recall", low.alias("low"), high.alias("high"))
