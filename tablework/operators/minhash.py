"""MinHash signatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.hashing import (
    MinHashFamily,
    signature_of_numbers,
    signature_of_text,
)
from tablework.functions.text import letter_tokens
from tablework.plans import spread


def text_signatures(
    df: DataFrame,
    row_id: str,
    text: str,
    family: MinHashFamily = MinHashFamily(),
    k: int = 5,
    tokens=letter_tokens,
) -> DataFrame:
    """``(row_id, sig)`` for every text with at least one ``k``-shingle. No shuffle.

    A shingle is numbered by a hash of its characters, so neither a vocabulary
    nor a join with it is needed.
    """
    texts = spread(df.select(row_id, text))
    line = F.array_join(tokens(text), " ")
    return texts.select(row_id, signature_of_text(line, family, k).alias("sig")).filter(
        F.col("sig").isNotNull()
    )


def set_signatures(
    df: DataFrame, row_id: str, numbers: str, family: MinHashFamily = MinHashFamily()
) -> DataFrame:
    """``(row_id, sig)`` for rows that hold their set as an array of numbers."""
    return df.select(row_id, signature_of_numbers(F.col(numbers), family).alias("sig")).filter(
        F.col("sig").isNotNull()
    )


def signature_cells(signatures: DataFrame, row_id: str) -> DataFrame:
    """Long form of the signature matrix: ``(row_id, i, value)``."""
    return signatures.select(row_id, F.posexplode("sig").alias("i", "value"))


def merge_signatures(signatures: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """``keys`` and ``sig``: the signature of the union of each group's sets, without the sets.

    The smallest hash value of a union is the smallest of its parts, place by place, so
    stored signatures of parts give those of larger groups, or of a table after an addition. One row
    per task and group is shuffled. Null signatures (empty sets) add nothing; a group of nothing else has no
    row. Signatures that do not have ``size`` values are an error. Without keys there is one group.
    """
    fits = F.when(F.size("sig") == size, F.col("sig")).otherwise(
        F.raise_error(F.lit("signatures differ in length")).cast("array<bigint>")
    )
    rows = signatures.filter(F.col("sig").isNotNull()).select(*keys, fits.alias("sig"))
    # an element each: the places are found in one pass without a row per value
    merged = rows.groupBy(*keys).agg(*[F.min(F.col("sig")[i]).alias(f"_{i}") for i in range(size)])
    return merged.select(*keys, F.array(*[f"_{i}" for i in range(size)]).alias("sig")).filter(F.col("sig")[0].isNotNull())
