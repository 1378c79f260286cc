"""Sharding by vector bin packing: bytes, tokens and rows are balanced together."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.plans import running_total, stage

#: Groups that one task packs, and the pieces into which a shard's share must be divisible.
BLOCK_GROUPS, GRAIN = 16_384, 64
#: Bins of a block below the last level, for each bin of the result: finer items for the next level.
FINER = 4
#: Groups of each shard that may move when shards are trimmed, and moves at most.
TRIMMED, MOVES = 1024, 4000
_SIZES = ("bytes", "tokens", "rows")
#: What a deviation in bytes, tokens and rows costs when shards are trimmed: the law is on bytes.
_COSTS = np.array([1000.0, 1.0, 100.0])


def pack(sizes: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each item (a row of sizes). Items go by falling size, each to the bin whose
    residual capacity has the highest dot product with it, the first of equals."""
    total = np.maximum(sizes.sum(axis=0), 1)
    share = sizes / total * bins
    residual = np.ones((bins, sizes.shape[1]))
    place = np.empty(len(sizes), dtype=np.int64)
    for i in np.argsort(-share.sum(axis=1), kind="stable"):
        place[i] = np.argmax(residual @ share[i])
        residual[place[i]] -= share[i]
    return place


def trim(sizes: np.ndarray, place: np.ndarray, totals: np.ndarray, most: int = MOVES) -> np.ndarray:
    """The bins of the items after moves that lower the cost of all bins, the best first.

    ``totals``: (bins, sizes), with items that do not move included. The cost is the sum of
    squared shares by which a bin deviates from the mean, weighted by _COSTS; a move from s
    to t changes it by twice the item's weighted product with (item + t - s).
    """
    scale = _COSTS / np.maximum(totals.mean(axis=0), 1) ** 2
    place, totals = place.copy(), totals.astype(float)
    weighed = sizes * scale
    own = (weighed * sizes).sum(axis=1)
    for _ in range(most if len(sizes) else 0):
        change = own[:, None] + weighed @ totals.T - (weighed * totals[place]).sum(axis=1)[:, None]
        change[np.arange(len(place)), place] = 0
        i, t = np.unravel_index(np.argmin(change), change.shape)
        if change[i, t] >= -1e-12:
            break
        totals[place[i]] -= sizes[i]
        totals[t] += sizes[i]
        place[i] = t
    return place


def _packed(items: DataFrame, keys: list[str], bins: int, out: str) -> DataFrame:
    """``items`` (``keys`` and sizes) with the bin of each as ``out``.

    Blocks of items are packed on their own, into more bins than the result has; the bins of
    all blocks are then the items of the next level, a small part as many, until one block is
    left. The block of an item depends on its key alone.
    """
    count = items.count()
    blocks = max(1, -(-count // BLOCK_GROUPS))
    inner = bins if blocks == 1 else max(bins, min(FINER * bins, BLOCK_GROUPS // 4))
    kinds = ", ".join(f"{n} {t}" for n, t in items.dtypes)

    def one_block(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(keys, ignore_index=True)
        part["bin"] = pack(part[list(_SIZES)].to_numpy(dtype=float), inner)
        return part

    placed = stage(
        items.withColumn("block", F.pmod(F.xxhash64(*keys), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(one_block, f"{kinds}, block long, bin long"),
        "packed",
    )
    if blocks == 1:
        return placed.withColumnRenamed("bin", out).drop("block")
    above = placed.groupBy(F.col("block").alias("of_block"), F.col("bin").alias("of_bin")).agg(
        *[F.sum(c).alias(c) for c in _SIZES]
    )
    above = _packed(stage(above, "bins"), ["of_block", "of_bin"], bins, out).select(
        F.col("of_block").alias("block"), F.col("of_bin").alias("bin"), out
    )
    return placed.join(above, ["block", "bin"]).drop("block", "bin")


def _trimmed(placed: DataFrame, keys: list[str], bins: int, out: str) -> DataFrame:
    """``placed`` with some groups moved. Of each bin, TRIMMED groups at most may move: a bounded
    table, by the hash of the keys, on which the driver works out the moves."""
    placed = stage(placed, "placed")
    sums = placed.groupBy(out).agg(*[F.sum(c).alias(c) for c in _SIZES]).collect()
    totals = np.zeros((bins, len(_SIZES)))
    for row in sums:
        totals[row[out]] = [row[c] for c in _SIZES]
    order = Window.partitionBy(out).orderBy(F.xxhash64(*keys), *keys)
    some = placed.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= TRIMMED).drop("r")
    some = some.toPandas().sort_values([out, *keys], ignore_index=True)
    before = some[out].to_numpy(dtype=np.int64)
    some["moved"] = trim(some[list(_SIZES)].to_numpy(dtype=float), before, totals)
    moves = some[some["moved"].to_numpy() != before][[*keys, "moved"]]
    if not len(moves):
        return placed
    kinds = ", ".join(f"{n} {t}" for n, t in placed.select(*keys).dtypes)
    moves = placed.sparkSession.createDataFrame(list(moves.itertuples(index=False, name=None)), f"{kinds}, moved long")
    # at most MOVES rows
    return placed.join(F.broadcast(moves), keys, "left").withColumn(out, F.coalesce("moved", out)).drop("moved")


def shard(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, tokens, group, shard, slot.

    size: bytes of the text plus 1 (null: 1); tokens: words between ASCII white space;
    group: the digest of the text (null: of the empty one). Documents of a group share
    a shard, unless the group holds over a GRAIN-th of a shard's bytes, tokens or rows: it
    is then split by the hash of doc_id into parts below that, which are placed like groups.
    slot numbers the rows of a shard from 0, by doc_id. Null ids are allowed; other columns
    are not read. The same table gives the same shards on any cluster.

    Rows are summed per group before anything is packed, and packing goes in blocks, level by
    level; no task sees more than a block of groups. In the end a bounded number of groups
    moves between shards, bytes first: the driver sees totals and TRIMMED groups of each shard.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.size(F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), ""))
    rows = stage(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("bytes"),
            words.cast("long").alias("tokens"),
            F.lit(1).cast("long").alias("rows"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.md5(body).alias("group"),
        ),
        "rows",
    )
    total = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SIZES]).first()
    groups = rows.groupBy("group").agg(*[F.sum(c).alias(c) for c in _SIZES])
    parts = F.ceil(F.greatest(*[F.col(c) * (shards * GRAIN) / max(total[c], 1) for c in _SIZES]))
    # fewer than shards * GRAIN groups can exceed that share of each of the three totals
    large = stage(groups.select("group", parts.alias("parts")).filter((F.col("parts") > 1)), "large")
    rows = rows.join(F.broadcast(large), "group", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0)).cast("long")
    )
    items = stage(rows.groupBy("group", "part").agg(*[F.sum(c).alias(c) for c in _SIZES]), "items")
    keys = ["group", "part"]
    placed = _trimmed(_packed(items, keys, shards, "shard"), keys, shards, "shard").select(*keys, F.col("shard").cast("int"))
    found = rows.join(placed, ["group", "part"]).select(
        "doc_id", F.col("bytes").alias("size"), "text_crc32", "tokens", "group", "shard", F.lit(1).cast("long").alias("one")
    )
    order = [F.col(c).asc_nulls_last() for c in ("doc_id", "group")]
    numbered = running_total(found, "shard", order, "one", "slot")
    return numbered.withColumn("slot", F.col("slot") - 1).drop("one")
