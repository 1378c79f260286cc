"""Leaving out rows of a document table by (doc_id, hash of the text)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of two numbers that may be broadcast.
BROADCAST_KEYS = 500_000


def _match(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = keys.select(F.col("doc_id").alias("key_doc"), F.col("text_hash").alias("key_hash"))
    small = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    same = docs["doc_id"].eqNullSafe(keys["key_doc"]) & (F.xxhash64(docs["text"]) == keys["key_hash"])
    return docs.join(F.broadcast(keys) if small else keys.hint("merge"), same, how)


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id (null equals null) and text are not among ``keys``:
    doc_id, text_hash, the latter Spark's xxhash64 of the text. A few keys are broadcast,
    more are joined."""
    return _match(docs, keys, "left_anti")


def one_of_each(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` with a single row left of those of each key."""
    return without(docs, keys).unionByName(_match(docs, keys, "left_semi").dropDuplicates(["doc_id", "text"]))
