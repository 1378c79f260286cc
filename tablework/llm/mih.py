"""Nearest neighbours by multi-index hashing: rotated binary codes, indexed by substrings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tablework.plans import block_cells, stage

#: Bits of a code and of a substring.
BITS, SUBSTRING = 256, 16
#: The rotations and the radius are fitted on at most so many vectors; so many of them are
#: tried as queries, and the radius holds this share of their neighbours.
FIT_ROWS, TRIED, COVERED = 20_000, 256, 0.995
BLOCK_ROWS = 16_384


@dataclass
class BinaryCodes:
    """``center`` and ``rotation`` (dimension x bits) give a vector's bits by sign; ``radius``: the
    Hamming distance that is searched."""

    center: np.ndarray
    rotation: np.ndarray
    radius: int

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """(vectors, bits / 16) of uint16."""
        bits = (vectors - self.center) @ self.rotation > 0
        return np.packbits(bits, axis=1).view(np.uint16)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled by their largest component first, so no square is lost."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit_codes(vectors: np.ndarray, k: int, bits: int = BITS, rounds: int = 20, seed: int = 1) -> BinaryCodes:
    """Learns rotations that bring unit vectors close to the corners of the cube (alternating
    between corners and the best rotation to them), as many as make ``bits`` bits, and the
    radius that covers the ``k`` nearest neighbours of the tried vectors."""
    rng = np.random.default_rng(seed)
    unit = _unit(vectors.astype(np.float64))
    center = unit.mean(axis=0)
    shifted = unit - center
    dimension = unit.shape[1]
    # the principal axes, the widest first
    _, axes = np.linalg.eigh(shifted.T @ shifted)
    axes = axes[:, ::-1][:, : min(dimension, bits)]
    parts, made = [], 0
    while made < bits:
        rotation, _ = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))
        flat = shifted @ axes
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.sign(flat @ rotation).T @ flat)
            rotation = (u @ v).T
        parts.append((axes @ rotation)[:, : bits - made])
        made += parts[-1].shape[1]
    codes = BinaryCodes(center, np.concatenate(parts, axis=1), bits)
    own = codes.encode(unit)
    distances = []
    for i in rng.permutation(len(unit))[:TRIED]:
        near = unit @ unit[i]
        near[i] = -np.inf
        best = np.argsort(-near)[: min(k, len(unit) - 1)]
        distances += np.bitwise_count(own[best] ^ own[i]).sum(axis=1).tolist()
    if distances:
        codes.radius = int(np.quantile(distances, COVERED, method="higher"))
    return codes


class _Index:
    """Rows by the value of each substring of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.tables = codes, []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, starts = np.unique(codes[order, j], return_index=True)
            self.tables.append((order, values, np.append(starts, len(order))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is at most ``radius`` bits away.

        Of m substrings one of the first radius % m + 1 differs in at most radius // m
        bits, or one of the others in less. The values that near are looked up, or picked
        from those that occur if these are fewer.
        """
        m = len(self.tables)
        each, extra = divmod(radius, m)
        hit = np.zeros(len(self.codes), dtype=bool)
        for j, (order, values, starts) in enumerate(self.tables):
            most = each if j <= extra else each - 1
            if most < 0:
                continue
            probes = _flips(most)
            if len(probes) < len(values):
                wanted = np.sort(probes ^ code[j])
                at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
                at = at[values[at] == wanted]
            else:
                at = np.flatnonzero(np.bitwise_count(values ^ code[j]) <= most)
            n = starts[at + 1] - starts[at]
            hit[order[np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1) <= radius]


_made: dict[int, np.ndarray] = {}


def _flips(most: int) -> np.ndarray:
    """All values of a substring with at most ``most`` bits set."""
    if most not in _made:
        most_bits = min(most, SUBSTRING)
        _made[most] = np.array(
            [sum(1 << b for b in some) for n in range(most_bits + 1) for some in combinations(range(SUBSTRING), n)],
            dtype=np.uint16,
        )
    return _made[most]


def _matrix(column: pa.ChunkedArray, kind=np.float32) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy().reshape(len(lists), -1).astype(kind, copy=False)


def _scaled(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors over the power of two next to their largest component: their angles stay exactly the
    same, and squares of very large or small components are kept."""
    vectors = _matrix(column, np.float64)
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -power)


def _search(radius: int | None, take: int):
    """A cell: the ``take`` best rows of the right side within the radius, for each left row."""

    def cell(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out_q, out_r, out_s = [], [], []
        if queries.num_rows and rows.num_rows:
            vectors, own = _scaled(rows["vector"]), _scaled(queries["vector"])
            norms, own_norms = np.linalg.norm(vectors, axis=1), np.linalg.norm(own, axis=1)
            nodes, names = rows["node"].to_numpy(), queries["node"].to_numpy()
            index = _Index(_matrix(rows["code"], np.int32).astype(np.uint16))
            codes = _matrix(queries["code"], np.int32).astype(np.uint16)
            for i in range(len(names)):
                found = index.within(codes[i], radius) if radius is not None else np.arange(len(nodes))
                score = vectors[found] @ own[i] / (norms[found] * own_norms[i])
                best = np.lexsort((nodes[found], -score))[:take]
                out_q.append(np.full(len(best), names[i]))
                out_r.append(nodes[found[best]])
                out_s.append(score[best])
        none = np.zeros(0, dtype=np.int64)
        return pa.table(
            {
                "query": pa.array(np.concatenate([none, *out_q])),
                "node": pa.array(np.concatenate([none, *out_r])),
                "score": pa.array(np.concatenate([none.astype(float), *out_s])),
            }
        )

    return cell


def usable(vector: str | Column) -> Column:
    """Whether a vector has a direction: not null, all components finite, not all zero."""
    v = F.col(vector) if isinstance(vector, str) else vector
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(
    table: DataFrame, is_query: Column, k: int = 5, row_id: str = "vec_id", vector: str = "embedding", bits: int = BITS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of each query by cosine, without itself.

    Ranked from 1 by falling score, ties by the smaller id; fewer rows if there are fewer.
    Rows without an id, and vectors that are null, zero or hold null or non-finite
    components, take no part. Vectors of several dimensions have no angle: that is an error.
    Rows equal in id and vector are one. Other columns are not read. Components are taken
    as double, or float if the table has float.

    Equal vectors are one entry of the index with its k + 1 smallest ids, so a very common
    vector is one entry too. Codes and radius are fitted on at most FIT_ROWS vectors; every
    vector is indexed. Queries meet blocks of the index, in cells of bounded size: each
    cell indexes its block, retrieves every code within the radius and ranks these by
    cosine, in double precision. Queries with fewer than ``k`` rows within the radius are
    searched again without it.
    """
    of = "float" if isinstance(table.select(vector).schema[0].dataType.elementType, FloatType) else "double"
    rows = table.select(
        F.col(row_id).cast("long").alias("id"), F.col(vector).cast(f"array<{of}>").alias("vector"), is_query.alias("asks")
    ).filter(F.col("id").isNotNull() & usable("vector"))
    rows = stage(rows, "vectors")
    sizes = rows.agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")).first()
    if sizes["most"] is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    if sizes["least"] < sizes["most"]:
        raise ValueError(f"vectors of {sizes['least']} to {sizes['most']} dimensions have no angle")
    least = Window.partitionBy("vector").orderBy("id")
    kept = rows.select("id", "vector").distinct().withColumn("r", F.row_number().over(least)).filter(F.col("r") <= k + 1)
    entries = stage(
        kept.groupBy("vector").agg(F.min("id").alias("node"), F.sort_array(F.collect_set("id")).alias("ids")), "entries"
    )
    sample = entries.select("node", "vector").orderBy(F.xxhash64("node"), "node").limit(FIT_ROWS).toArrow()
    codes = fit_codes(_matrix(sample["vector"], np.float64), k, bits)
    shared = table.sparkSession.sparkContext.broadcast(codes)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(pa.chunked_array([batch.column("vector")]), np.float64))
            found = shared.value.encode(unit).astype(np.int32)
            at = pa.array(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32))
            lists = pa.ListArray.from_arrays(at, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("vector"), lists], names=["node", "vector", "code"])

    index = stage(
        entries.select("node", "vector").mapInArrow(encode, f"node long, vector array<{of}>, code array<int>"), "codes"
    ).withColumn("all", F.lit(0))
    asked = stage(
        rows.filter("asks").select("id", "vector").distinct().join(entries.select("vector", "node"), "vector").select("id", "node"),
        "queries",
    )
    names = asked.select("node").distinct()

    def search(nodes: DataFrame, radius: int | None) -> DataFrame:
        queries = stage(index.join(nodes.hint("merge"), "node"), "asked")
        found = block_cells(
            queries, index, "all", "node", _search(radius, k + 1), "query long, node long, score double",
            block_rows=BLOCK_ROWS, few_groups=True,
        )
        best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
        found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
        return stage(found.join(entries.select("node", "ids"), "node").select("query", "score", "ids"), "found")

    found = search(names, codes.radius)
    full = found.groupBy("query").agg(F.sum(F.size("ids")).alias("n")).filter(F.col("n") > k)
    short = names.join(full.select(F.col("query").alias("node")), "node", "left_anti")
    if not short.isEmpty():
        short = stage(short, "short")
        found = found.join(short.select(F.col("node").alias("query")), "query", "left_anti").unionByName(search(short, None))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.select(F.col("id").alias("query_id"), F.col("node").alias("query"))
        .join(found, "query")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter("vec_id != query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
