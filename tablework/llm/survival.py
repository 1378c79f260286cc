"""Filter interaction audit: words of surviving subsets, added up by carry-save positional popcounts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.plans import stage

#: The filters, by bit of a subset.
FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
_ALL = SUBSETS - 1

#: For every mask of failed filters, the word whose bit S says that it survives subset S.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], dtype=np.uint32)


def failures(text: Column) -> Column:
    """The bits of A to D that a text fails: few words, repetitive, capitals, symbols."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.char_length(text), text.rlike("[#$%&*|]")]
    return sum(F.when(x, 1 << bit).otherwise(0) for bit, x in enumerate(failed))


def positional_popcount(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many words have each bit set, word i counting ``counts[i]`` times.

    A word enters the adder of weight 2^j for every bit j of its count. Three words of one weight
    become a sum of that weight and a carry of the next, 32 positions at once, until at most
    two words are left of each weight.
    """
    total = np.zeros(SUBSETS, dtype=np.int64)
    carried = np.zeros(0, dtype=np.uint32)
    weight = 0
    while len(carried) or (counts >> weight).any():
        level = np.concatenate([carried, words[(counts >> weight) & 1 == 1]])
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c, rest = level[:third], level[third : 2 * third], level[2 * third : 3 * third], level[3 * third :]
            either = a ^ b
            carries.append((a & b) | (either & c))
            level = np.concatenate([either ^ c, rest])
        for word in level:
            total += ((int(word) >> np.arange(SUBSETS)) & 1) << weight
        carried = np.concatenate(carries) if carries else np.zeros(0, dtype=np.uint32)
        weight += 1
    return total


def _popcounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, good, toxic, survivors) of each batch: part, good, toxic, failed, n."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = pa.Table.from_batches([batch.select(["part", "good", "toxic"])])
        index = pa.array(np.arange(batch.num_rows))
        groups = keys.append_column("i", index).group_by(["part", "good", "toxic"]).aggregate([("i", "list")])
        words = WORDS[batch.column("failed").to_numpy(zero_copy_only=False)]
        counts = batch.column("n").to_numpy(zero_copy_only=False)
        survivors = [positional_popcount(words[rows], counts[rows]).tolist() for rows in (x.values.to_numpy() for x in groups["i_list"])]
        yield pa.RecordBatch.from_arrays(
            [groups[c].combine_chunks() for c in ("part", "good", "toxic")] + [pa.array(survivors, pa.list_(pa.int64()))],
            names=["part", "good", "toxic", "survivors"],
        )


def survivors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part: part, and the survivors of every subset of filters among all its documents
    (``every``), those of quality 1 (``good``) and the toxic ones (``toxic``), as arrays by subset.

    ``docs``: doc_id, text, source; ``labels``: doc_id, quality, toxic; other columns are not read.
    A null text is empty, a null source is ''. A document without an id has no label, and is
    no copy and no original; rows of one id and text are not copies of each other. A label that occurs
    twice counts if any of its rows says 1.

    Copies are found by the digest of the text: rows are first counted by (id, part, digest),
    then by (digest, part, labels), so a text with very many copies is a few rows, the
    smallest id among them, before its rows meet. Words are added per batch where they are.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        failures(body).alias("failed"),
    )
    # staged: read again for rows without an id
    rows = stage(rows.groupBy("doc_id", "part", "digest", "failed").agg(F.count("*").alias("n")), "marked")
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    named = rows.filter(F.col("doc_id").isNotNull()).join(known, "doc_id", "left").select(
        *rows.columns, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    )
    key = ["part", "good", "toxic", "failed"]
    counted = named.groupBy("digest", *key).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least")
    )
    # the rows of a digest are now as many as its parts and labels
    counted = counted.withColumn("first", F.min("least").over(Window.partitionBy("digest")))
    originals = F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    copies = F.col("failed").bitwiseOR(F.lit(1 << FILTERS.index("E")))
    split = F.explode(
        F.array(
            F.struct(F.col("failed").alias("failed"), originals.alias("n")),
            F.struct(copies.alias("failed"), (F.col("n") - originals).alias("n")),
        )
    )
    marked = counted.select("part", "good", "toxic", split.alias("s")).select("part", "good", "toxic", "s.*").filter("n > 0")
    unnamed = rows.filter(F.col("doc_id").isNull()).select(
        "part", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "failed", "n"
    )
    added = marked.unionByName(unnamed).mapInArrow(_popcounts, "part string, good boolean, toxic boolean, survivors array<long>")
    # the popcounts of all batches, added position by position
    each = added.select("part", "good", "toxic", F.posexplode("survivors").alias("subset", "n"))
    sums = each.groupBy("part", "subset").agg(
        F.sum("n").alias("every"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    table = F.sort_array(F.collect_list(F.struct("subset", "every", "good", "toxic")))
    return sums.groupBy("part").agg(table.alias("t")).select("part", "t.every", "t.good", "t.toxic")


def _steps() -> Column:
    """Every order of the filters and every step in it: the subsets before and after."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, bit in enumerate(order, 1):
            name = "".join(FILTERS[b] for b in order)
            rows.append(f"named_struct('filter_order', '{name}', 'step', {step}, 'bit', {bit}, 'before', {before}, 'after', {before | 1 << bit})")
            before |= 1 << bit
    return F.expr(f"array({', '.join(rows)})")


def audit(table: DataFrame) -> DataFrame:
    """One row per part, filter_order and step, from the table that ``survivors`` makes.

    kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley (removed, summed over all
    orders) are sums and differences of survivors of subsets. Without documents there are no rows.
    """

    bits = range(len(FILTERS))

    def shapley(bit: int) -> Column:
        terms = []
        for s in range(SUBSETS):
            if not s >> bit & 1:
                size = s.bit_count()
                orders = factorial(size) * factorial(len(FILTERS) - 1 - size)
                terms.append(orders * (F.get("every", F.lit(s)) - F.get("every", F.lit(s | 1 << bit))))
        return sum(terms[1:], terms[0])

    rows = table.select(
        "*",
        F.array(*[shapley(b) for b in bits]).alias("shares"),
        F.array(*[F.get("every", F.lit(_ALL & ~(1 << b))) - F.get("every", F.lit(_ALL)) for b in bits]).alias("only"),
        F.array(*[F.get("every", F.lit(0)) - F.get("every", F.lit(1 << b)) for b in bits]).alias("failing"),
    )
    rows = rows.select("*", F.explode(_steps()).alias("o")).select("*", "o.*")
    removed = F.get("every", F.col("before")) - F.get("every", F.col("after"))
    return rows.select(
        "part",
        "filter_order",
        "step",
        F.get("every", F.col("after")).alias("kept"),
        removed.alias("removed"),
        (F.get("failing", F.col("bit")) - removed).alias("redundant"),
        F.get("only", F.col("bit")).alias("unique_fails"),
        (F.get("good", F.col("before")) - F.get("good", F.col("after"))).alias("good_lost"),
        (F.get("toxic", F.col("before")) - F.get("toxic", F.col("after"))).alias("toxic_lost"),
        F.get("shares", F.col("bit")).alias("shapley"),
    )
