"""Word co-occurrence within groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tablework.operators.frequency import top_per_group, word_counts
from tablework.plans import join_lookup, stage, unnest

# Groups whose word lists every executor may hold (a hundred words each).
_BROADCAST_GROUPS = 20_000

# Words by words of which a product is worked out at once.
_BLOCK = 512

# Words by words, about, that one task of ``gram`` counts.
_CELL = 1024


def vocabulary(df: DataFrame, group: str, tokens: str, size: int = 100) -> DataFrame:
    """The ``size`` most frequent words of every group as ``(group, words)``, best first.

    A row holds at most ``size`` words.
    """
    ranked = top_per_group(word_counts(df, tokens, group), group, "word", size)
    entries = F.sort_array(F.collect_list(F.struct("rank", "word")))
    return ranked.groupBy(group).agg(F.transform(entries, lambda e: e["word"]).alias("words"))


def _marks(line: np.ndarray, column: np.ndarray, rows: int, start: int, block: int) -> np.ndarray:
    """0/1 matrix of the rows and a block of the columns."""
    inside = (column >= start) & (column < start + block)
    marks = np.zeros((rows, min(block, max(int(column.max()) + 1 - start, 0))), dtype=np.float32)
    marks[line[inside], column[inside] - start] = 1
    return marks


def _count_pairs(group_type: pa.DataType, block: int = _BLOCK):
    """Per batch and group ``(g, w1, w2, n)`` with ``w1 <= w2``: rows that hold both words.

    A long list of words is taken block by block, so no more than a block by a block of
    the product is held, and only what is not zero leaves the task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column(0).dictionary_encode()
            codes = groups.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            row = np.repeat(np.arange(len(codes)), lists.value_lengths().to_numpy())
            words = lists.flatten().dictionary_encode()
            word = words.indices.to_numpy()
            # words numbered in text order
            order = np.argsort(np.array(words.dictionary.to_pylist(), dtype=object), kind="stable")
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            by_group = np.argsort(codes[row], kind="stable")
            row, word = row[by_group], rank[word[by_group]]
            codes_of = codes[row]
            starts = np.flatnonzero(np.diff(codes_of, prepend=np.iinfo(np.int64).min))
            for start, end in zip(starts, [*starts[1:], len(row)]):
                code = codes_of[start]
                here, column = np.unique(word[start:end], return_inverse=True)
                rows, line = np.unique(row[start:end], return_inverse=True)
                value = None if code < 0 else groups.dictionary[int(code)].as_py()
                text = words.dictionary.take(pa.array(order[here]))
                for left in range(0, len(here), block):
                    marks = _marks(line, column, len(rows), left, block)
                    for right in range(left, len(here), block):
                        others = marks if right == left else _marks(line, column, len(rows), right, block)
                        matrix = np.rint(marks.T @ others).astype(np.int64)
                        i, j = np.nonzero(np.triu(matrix) if right == left else matrix)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([value] * len(i), type=group_type),
                                text.take(pa.array(i + left)),
                                text.take(pa.array(j + right)),
                                pa.array(matrix[i, j]),
                            ],
                            names=["g", "a", "b", "n"],
                        )

    return count


def present_in_group(df: DataFrame, group: str, tokens: str, words: DataFrame, *keep: str, size: int = 100) -> DataFrame:
    """Per row those of its words that are in its own group's list, and the columns to ``keep``."""
    rows = df.select(F.col(group).alias("_row_group"), F.col(tokens).alias("_tokens"), *keep)
    same_group = F.col("_row_group").eqNullSafe(F.col(group))
    return join_lookup(rows, words, same_group, limit=_BROADCAST_GROUPS * 100 // size).select(
        group,
        *keep,
        F.coalesce(F.array_intersect("words", "_tokens"), F.array().cast("array<string>")).alias(
            "present"
        ),
    )


def _present_anywhere(df: DataFrame, tokens: str, group: str, words: DataFrame) -> DataFrame:
    """Per row and group those of the row's words that are in that group's list."""
    entries = stage(words.select(group, F.explode("words").alias("word")), "entries")
    # the staged row number stays the same however often the rows are read
    rows = stage(
        df.select(F.monotonically_increasing_id().alias("_row"), F.array_distinct(tokens).alias("_t")),
        "rows",
    )
    found = join_lookup(unnest(rows, "_t", "word"), entries, "word", limit=_BROADCAST_GROUPS)
    # a list is no longer than a group's word list
    return (
        found.groupBy("_row", group)
        .agg(F.collect_list("word").alias("present"))
        .select(group, "present")
    )


def cooccurrence(
    df: DataFrame,
    group: str,
    tokens: str,
    size: int = 100,
    words: DataFrame | None = None,
    all_rows: bool = False,
) -> DataFrame:
    """In how many rows of a group two of its top words appear together.

    Result: ``(group, r1, w1, r2, w2, n)`` for all pairs of a group's words, with
    zeros, both orders, and the document frequency where ``w1 = w2``. ``r1`` and
    ``r2`` are the words' ranks. With ``all_rows`` the pairs are counted in the
    rows of all groups instead of the group's own.

    Every task multiplies the 0/1 matrices of its own rows and adds up the
    products, so what is shuffled is one small matrix per task and group, however
    many rows the group has; no pair of words is a row before it is counted.
    """
    words = stage(words or vocabulary(df, group, tokens, size), "vocabulary")
    if all_rows:
        present = _present_anywhere(df, tokens, group, words)
    else:
        present = present_in_group(df, group, tokens, words)
    counts = _summed(present, group)
    cells = words.select(
        F.col(group).alias("_g"), "words", F.posexplode("words").alias("r1", "w1")
    ).select("_g", "r1", "w1", F.posexplode("words").alias("r2", "w2"))
    match = (
        F.col("_g").eqNullSafe(F.col("g"))
        & (F.least("w1", "w2") == F.col("a"))
        & (F.greatest("w1", "w2") == F.col("b"))
    )
    return cells.join(counts, match, "left").select(
        F.col("_g").alias(group),
        (F.col("r1") + 1).alias("r1"),
        "w1",
        (F.col("r2") + 1).alias("r2"),
        "w2",
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def gram(
    df: DataFrame, group: str, tokens: str, size: int = 5000, diagonal: bool = True, block: int = _CELL
) -> DataFrame:
    """Like ``cooccurrence`` for long lists of words: ``(group, r1, w1, r2, w2, n)`` with ``r1 <= r2`` and
    ``n > 0`` only, with or without the document frequencies (``r1 = r2``).

    The words of a group fall into blocks of about ``block`` by a hash, and a task counts the pairs of two
    blocks over all rows of the group, so the pairs become rows once, when they are added up, however
    many rows there are; what is shuffled are the words of a row, once for every block. Pairs that never meet
    are never rows, and neither a task nor the result holds a group's whole matrix.
    """
    words = stage(vocabulary(df, group, tokens, size), "vocabulary")
    counts = _by_cells(present_in_group(df, group, tokens, words, size=size), group, -(-size // block))
    if not diagonal:
        counts = counts.filter("a <> b")
    ranks = stage(words.select(F.col(group).alias("_g"), F.posexplode("words").alias("_r", "_w")), "ranks")
    for word, rank in (("a", "_ra"), ("b", "_rb")):
        same = F.col("_g").eqNullSafe(F.col("g")) & (F.col("_w") == F.col(word))
        counts = join_lookup(counts, ranks, same).withColumn(rank, F.col("_r") + 1).drop("_g", "_r", "_w")
    first = F.col("_ra") <= F.col("_rb")
    return counts.select(
        F.col("g").alias(group),
        F.least("_ra", "_rb").alias("r1"),
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("w1"),
        F.greatest("_ra", "_rb").alias("r2"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("w2"),
        "n",
    )


def _count_cells(group_type: pa.DataType):
    """Rows of cells, one cell after the other, ``(g, i, j, x, y)``: for every cell ``(g, a, b, n)``, the rows
    that hold a word ``a`` of their ``x`` and ``b`` of their ``y``. Where ``i = j``, ``y`` is null and is ``x``."""

    def pairs(key: tuple, names: tuple[dict, dict], sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        same = key[1] == key[2]
        left, right = (pa.array(list(d), type=pa.string()) for d in (names[0], names[0] if same else names[1]))
        for at in range(0, len(left), 64):
            part = sums[at : min(at + 64, len(left)), : len(right)]
            i, j = np.nonzero(np.triu(part, at) if same else part)
            columns = [pa.array([key[0]] * len(i), type=group_type), left.take(pa.array(i + at)), right.take(pa.array(j))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(part[i, j])], names=["g", "a", "b", "n"])

    def numbers(lists: pa.Array, names: dict) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all lists, and where each list starts."""
        words = lists.flatten().dictionary_encode()
        known = np.array([names.setdefault(w, len(names)) for w in words.dictionary.to_pylist()], dtype=np.int64)
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        return known[words.indices.to_numpy()], np.concatenate(([0], ends)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, names, sums = None, ({}, {}), np.zeros((0, 0), dtype=np.int64)
        for batch in batches:
            codes = [batch.column(0).dictionary_encode().indices.fill_null(-1), batch.column(1), batch.column(2)]
            moved = [np.diff(c.to_numpy(zero_copy_only=False)) != 0 for c in codes]
            cuts = [0, *(np.flatnonzero(np.any(moved, axis=0)) + 1), batch.num_rows] if batch.num_rows else []
            for start, end in zip(cuts, cuts[1:]):
                here = batch.slice(start, end - start)
                key = tuple(here.column(c)[0].as_py() for c in range(3))
                if key != last:
                    if last is not None:
                        yield from pairs(last, names, sums)
                    last, names, sums = key, ({}, {}), np.zeros((0, 0), dtype=np.int64)
                x, of_x = numbers(here.column(3), names[0])
                y, of_y = (x, of_x) if key[1] == key[2] else numbers(here.column(4), names[1])
                size = max(len(names[0]), len(names[1]))
                if size > len(sums):
                    grown = np.zeros((size + size // 4,) * 2, dtype=np.int64)
                    grown[: len(sums), : len(sums)] = sums
                    sums = grown
                for r in range(end - start):
                    # a row has a word once
                    sums[x[of_x[r] : of_x[r + 1], None], y[of_y[r] : of_y[r + 1]]] += 1
        if last is not None:
            yield from pairs(last, names, sums)

    return count


def _by_cells(present: DataFrame, group: str, blocks: int) -> DataFrame:
    """``(g, a, b, n)``: rows of the group that hold both words, every pair in one order."""
    cells = blocks * (blocks + 1) // 2
    cores = present.sparkSession.sparkContext.defaultParallelism
    # a single group, too, is work for all cores
    slices = -(-cores // cells)
    of_block = lambda b: F.filter("present", lambda w: F.pmod(F.xxhash64(w), F.lit(blocks)) == b)
    parts = present.select(F.col(group).alias("g"), F.pmod(F.xxhash64("present"), F.lit(slices)).alias("s"), *[of_block(b).alias(f"b{b}") for b in range(blocks)])
    cell = [
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"b{i}").alias("x"), (F.lit(None).cast("array<string>") if i == j else F.col(f"b{j}")).alias("y"))
        for i in range(blocks)
        for j in range(i, blocks)
    ]
    rows = unnest(parts.select("g", "s", F.array(*cell).alias("cells")), "cells", "cell").select("g", "s", "cell.*")
    rows = rows.filter((F.size("x") > 0) & (F.col("y").isNull() | (F.size("y") > 0)))
    # so many partitions that cells seldom share one
    dealt = rows.repartition(4 * max(cores, cells), "g", "i", "j", "s").sortWithinPartitions("g", "i", "j", "s")
    kind = present.schema[group].dataType
    schema = StructType([StructField("g", kind), StructField("a", StringType()), StructField("b", StringType()), StructField("n", LongType())])
    counted = dealt.select("g", "i", "j", "x", "y").mapInArrow(_count_cells(to_arrow_type(kind)), schema)
    if slices == 1:
        return counted
    counted = counted.select("g", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n")
    return counted.groupBy("g", "a", "b").agg(F.sum("n").alias("n"))


def _summed(present: DataFrame, group: str, block: int = _BLOCK) -> DataFrame:
    """``(g, a, b, n)``: rows of the group that hold both words, ``a <= b``."""
    kind = present.schema[group].dataType
    schema = StructType(
        [
            StructField("g", kind),
            StructField("a", StringType()),
            StructField("b", StringType()),
            StructField("n", LongType()),
        ]
    )
    partial = present.mapInArrow(_count_pairs(to_arrow_type(kind), block), schema)
    return partial.groupBy("g", "a", "b").agg(F.sum("n").alias("n"))


def as_matrix(pairs: DataFrame, group: str, size: int = 100) -> DataFrame:
    """Square form: one row per word, columns ``c1 .. c<size>`` by rank of the other word."""
    ranks = list(range(1, size + 1))
    wide = pairs.groupBy(group, "r1", "w1").pivot("r2", ranks).agg(F.first("n"))
    return wide.toDF(group, "rank", "word", *[f"c{r}" for r in ranks])
