"""Which rows hold a group's top words, as bitmaps over numbered rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tablework.operators.cooccur import present_in_group
from tablework.plans import dense_index, stage

_STRIP = 4096  # rows whose bits are spread out at once


def presence_bitmaps(df: DataFrame, row_id: str, group: str, tokens: str, words: DataFrame) -> DataFrame:
    """``(group, rank, word, bucket, bitmap)``: a bit per row of the group that holds the word.

    ``words`` is ``cooccur.vocabulary``; row ids do not repeat. Rows are numbered in order of their ids over all
    groups, and a bucket is 32,768 rows in a row, so a bitmap has 4 KB however frequent the word
    is; buckets without the word are left out. Rows with a null id take no part.
    """
    words = stage(words, "vocabulary")
    rows = df.filter(F.col(row_id).isNotNull())
    numbers = dense_index(rows.select(F.col(row_id).alias("_id")), "_id", "_no")
    numbered = stage(rows.join(numbers, F.col(row_id) == F.col("_id")).select(group, tokens, "_no"), "numbered")
    held = present_in_group(numbered, group, tokens, words, "_no").select(group, "_no", F.explode("present").alias("_word"))
    bits = held.groupBy(group, "_word", F.expr("bitmap_bucket_number(_no + 1)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(_no + 1))").alias("bitmap")
    )
    ranks = words.select(F.col(group).alias("_g"), F.posexplode("words").alias("_at", "word"))
    match = F.col("_g").eqNullSafe(F.col(group)) & (F.col("word") == F.col("_word"))
    return bits.join(ranks, match).select(group, (F.col("_at") + 1).alias("rank"), "word", "bucket", "bitmap")


def row_counts(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``n``: the rows that hold any of a key's words (or, for one word, the word)."""
    any_word = bitmaps.groupBy(*keys, "bucket").agg(F.expr("bitmap_or_agg(bitmap)").alias("any"))
    return any_word.groupBy(*keys).agg(F.sum(F.expr("bitmap_count(any)")).alias("n"))


def pair_counts(bitmaps: DataFrame, group: str) -> DataFrame:
    """``(group, r1, r2, n)`` with ``r1 <= r2``: rows that hold both words, pairs without one left out.

    The bitmaps of a group's bucket meet in one task: 4 KB a word, whatever the number of rows.
    Their bits are multiplied in strips of rows.
    """
    kind = bitmaps.schema[group].dataType
    schema = StructType(
        [StructField("g", kind), StructField("r1", IntegerType()), StructField("r2", IntegerType()), StructField("_n", LongType())]
    )
    arrow = to_arrow_type(kind)

    def count(table: pa.Table) -> pa.Table:
        ranks = table.column("rank").to_numpy()
        table = table.take(pa.array(order := np.argsort(ranks)))
        ranks = ranks[order]
        packed = np.frombuffer(b"".join(table.column("bitmap").to_pylist()), dtype=np.uint8).reshape(len(ranks), -1)
        both = np.zeros((len(ranks), len(ranks)))
        for at in range(0, packed.shape[1], _STRIP // 8):
            bits = np.unpackbits(packed[:, at : at + _STRIP // 8], axis=1).astype(np.float32)
            both += bits @ bits.T
        i, j = np.nonzero(np.triu(both))
        groups = pa.array([table.column("g")[0].as_py()] * len(i), type=arrow)
        return pa.table([groups, pa.array(ranks[i], pa.int32()), pa.array(ranks[j], pa.int32()), pa.array(both[i, j].astype(np.int64))], names=["g", "r1", "r2", "_n"])

    rows = bitmaps.select(F.col(group).alias("g"), "bucket", "rank", "bitmap")
    found = rows.groupBy("g", "bucket").applyInArrow(count, schema)
    return found.groupBy(F.col("g").alias(group), "r1", "r2").agg(F.sum("_n").alias("n"))
