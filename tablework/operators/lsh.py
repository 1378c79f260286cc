"""Near-duplicate candidates by banded signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.hashing import agreement, band_keys, equal_bytes, low_bits, low_bytes
from tablework.functions.text import letter_tokens
from tablework.plans import block_cells, join_by_count, running_total, stage

_SCORES = 1 << 18  # comparisons held at once inside a cell

# Rows of a block: a cell holds its pairs, 24 bytes each, so where all texts are alike a task holds
# 400 MB of them (with 16,384 rows it were 6.4 GB).
_CELL_ROWS = 4096

# Characters of the lines that a block of ``verified_pairs`` holds, more or less.
_BLOCK_CHARS = 1 << 19


def copy_groups(signatures: DataFrame, row_id: str) -> DataFrame:
    """``(rep, copies, sig)``: equal signatures as one row, under their smallest id.

    Copies are added up before the shuffle, so a signature shared by a third of
    all rows costs no more than any other, and its copies never meet in pairs.
    """
    return signatures.groupBy("sig").agg(
        F.min(row_id).alias("rep"), F.count("*").alias("copies")
    ).select("rep", "copies", "sig")


def copy_members(signatures: DataFrame, groups: DataFrame, row_id: str) -> DataFrame:
    """``(row_id, rep)`` for every row: which representative stands for it.

    Together with the pairs of representatives this states all pairs of rows:
    two rows belong together if they share ``rep`` or their reps are a pair.
    """
    key = F.md5(F.array_join(F.transform("sig", lambda v: v.cast("string")), ","))
    reps = groups.select(key.alias("_key"), "rep", "copies")
    rows = signatures.select(row_id, key.alias("_key"))
    return join_by_count(rows, reps, ["_key"], "copies").select(row_id, "rep")


def band_rows(groups: DataFrame, rows: int, bands: int) -> DataFrame:
    """``(rep, band, key)``: one row per band of every signature, with what else ``groups`` has of it."""
    # outer: a plain posexplode would have the keys worked out twice, see unnest
    return groups.select(
        *[c for c in groups.columns if c not in ("copies", "sig")], F.posexplode_outer(band_keys("sig", rows, bands)).alias("band", "key")
    )


def bucket_sizes(bands: DataFrame) -> DataFrame:
    """``(band, key, members)`` of the buckets with more than one member."""
    return (
        bands.groupBy("band", "key").agg(F.count("*").alias("members")).filter("members > 1")
    )


def _close_pairs(threshold: float, rows: int):
    """Cell for oversize buckets: pairs of a bucket at or above the threshold."""

    def matrix(side: pa.Table) -> np.ndarray:
        cells = side.column("sig").combine_chunks()
        return cells.flatten().to_numpy().reshape(len(cells), -1)

    def close(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found_a, found_b, found_s = [], [], []
        if left.num_rows and right.num_rows:
            band, same = key[0].as_py()["band"], key[1].as_py() == key[2].as_py()
            a, b = left.column("rep").to_numpy(), right.column("rep").to_numpy()
            x, y = matrix(left), matrix(right)
            step = max(1, _SCORES // len(b))
            for at in range(0, len(a), step):
                equal = np.zeros((len(a[at : at + step]), len(b)), dtype=np.int16)
                earlier = np.zeros(equal.shape, dtype=bool)
                hit, run = np.empty(equal.shape, dtype=bool), np.empty(equal.shape, dtype=bool)
                for i in range(x.shape[1]):
                    np.equal(x[at : at + step, i, None], y[None, :, i], out=hit)
                    equal += hit
                    if i // rows < band:
                        if i % rows == 0:
                            run[:] = True
                        run &= hit
                        if i % rows == rows - 1:
                            earlier |= run
                share = equal / x.shape[1]
                # a pair is reported by the first band it shares
                keep = (share >= threshold) & ~earlier
                if same:
                    keep &= a[at : at + step][:, None] < b[None, :]
                r, c = np.nonzero(keep)
                found_a.append(np.minimum(a[at + r], b[c]))
                found_b.append(np.maximum(a[at + r], b[c]))
                found_s.append(share[r, c])
        # the parts as they are: the pairs are not held a second time
        chunks = lambda parts, kind: pa.chunked_array([pa.array(p) for p in parts], kind)
        return pa.table(
            {
                "a": chunks(found_a, pa.int64()),
                "b": chunks(found_b, pa.int64()),
                "agreement": chunks(found_s, pa.float64()),
            }
        )

    return close


def candidate_pairs(
    groups: DataFrame,
    bands: int = 20,
    threshold: float = 0.8,
    bucket_limit: int = 100,
    block_rows: int = _CELL_ROWS,
) -> DataFrame:
    """``(a, b, agreement)``, ``a < b``: representatives that share a band and agree enough.

    Buckets of fewer than ``bucket_limit`` members list their pairs in place.
    Larger ones are not dropped: they are compared block against block, spread
    over many tasks, and only pairs at or above the threshold leave a task. The
    result is the same whatever the limit.
    """
    groups = stage(groups, "signatures")
    size = groups.select(F.size("sig").alias("k")).first()
    if size is None:
        return groups.sparkSession.createDataFrame([], "a bigint, b bigint, agreement double")
    if size["k"] % bands:
        raise ValueError(f"{bands} bands do not divide a signature of {size['k']} values")
    rows = size["k"] // bands

    words = [f"w{i}" for i in range(-(-size["k"] // 64))]
    bits = groups.select("rep", "sig", low_bits("sig").alias("bits"))
    placed = band_rows(bits.select("rep", "sig", *[F.col("bits")[i].alias(w) for i, w in enumerate(words)]), rows, bands)
    shared = stage(
        join_by_count(placed, bucket_sizes(placed), ["band", "key"], "members"), "buckets"
    )
    differ = sum(F.bit_count(F.col(f"x.{w}").bitwiseXOR(F.col(f"y.{w}"))) for w in words)
    # a bit of every value before anything else: nearly all pairs that meet by chance go where they are listed
    small = (
        shared.filter(F.col("members") < bucket_limit)
        .groupBy("band", "key")
        .agg(F.sort_array(F.collect_list(F.struct("rep", *words))).alias("reps"))
        .select("reps", F.posexplode("reps").alias("at", "x"))
        .select("x", F.explode(F.slice("reps", F.col("at") + 2, bucket_limit)).alias("y"))
        .filter(size["k"] - differ >= threshold * size["k"] - 1e-6)
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        .distinct()
    )
    # then one byte of every value: most others go before whole signatures are shuffled to them
    marks = groups.select("rep", low_bytes("sig").alias("mark"))
    mark_a = marks.select(F.col("rep").alias("a"), F.col("mark").alias("mark_a"))
    mark_b = marks.select(F.col("rep").alias("b"), F.col("mark").alias("mark_b"))
    small = (
        small.hint("merge")
        .join(mark_a, "a")
        .hint("merge")
        .join(mark_b, "b")
        .filter(equal_bytes("mark_a", "mark_b") >= threshold)
        .select("a", "b")
    )
    sig_a = groups.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
    sig_b = groups.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
    # merge: size estimates do not see how many pairs a bucket list makes
    close = (
        small.hint("merge")
        .join(sig_a, "a")
        .hint("merge")
        .join(sig_b, "b")
        .select("a", "b", agreement("sig_a", "sig_b").alias("agreement"))
        .filter(F.col("agreement") >= threshold)
    )
    large = shared.filter(F.col("members") >= bucket_limit).select("rep", "band", "key")
    if large.isEmpty():
        return close
    members = large.join(groups.select("rep", "sig"), "rep").select(
        "rep", "sig", F.struct("band", "key").alias("bucket")
    )
    from_large = block_cells(
        members,
        members,
        "bucket",
        "rep",
        _close_pairs(threshold, rows),
        "a bigint, b bigint, agreement double",
        block_rows,
        mirrored=True,
    )
    # a pair may share one small and one large bucket
    return close.union(from_large).distinct()


def _run_numbers(lines: list[str], k: int) -> list[np.ndarray]:
    """The ``k``-character runs of each line as rising numbers; the same run has the same number in all lines."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    letters, ranks = np.unique(points, return_inverse=True)
    count, most = max(len(points) - k + 1, 0), len(letters)
    codes = ranks[:count].astype(np.int64)
    for at in range(1, k):
        if most * len(letters) >= 1 << 62:
            kinds, codes = np.unique(codes, return_inverse=True)
            most = len(kinds)
        codes = codes * len(letters) + ranks[at : at + count]
        most *= len(letters)
    sizes = np.array([len(line) for line in lines], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    return [np.unique(codes[start : start + max(size - k + 1, 0)]) for start, size in zip(starts, sizes)]


def _similar(k: int):
    """Cell: Jaccard similarity of the sets of ``k``-character runs of pairs of lines."""

    def similar(pairs: pa.Table, lines: pa.Table) -> pa.Table:
        place = {digest: i for i, digest in enumerate(lines.column("digest").to_pylist())}
        runs = _run_numbers([line or "" for line in lines.column("line").to_pylist()], k)
        found = []
        for x, y in zip(pairs.column("x").to_pylist(), pairs.column("y").to_pylist()):
            both = np.sort(np.concatenate((runs[place[x]], runs[place[y]])), kind="stable")
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            found.append(shared / (len(both) - shared) if len(both) else None)
        return pa.table({"x": pairs.column("x"), "y": pairs.column("y"), "jaccard": pa.array(found, pa.float64())})

    return similar


def _blocks(asked: DataFrame, lines: DataFrame) -> DataFrame:
    """``(digest, block)`` of the lines in ``asked`` (x, y): lines that are linked come into one block, where it holds them.

    Which lines are together is a matter of cost only.
    """
    there, back = (F.struct(F.col(one).alias("digest"), F.col(other).alias("other")) for one, other in (("x", "y"), ("y", "x")))
    links = asked.select(F.inline(F.array(there, back)))
    hubs = links.groupBy("digest").agg(F.min("other").alias("hub")).select("digest", F.least("digest", "hub").alias("hub"))
    hubs = stage(hubs, "hubs")
    # the least of the neighbours' hubs, which nearly all lines of a group agree on
    further = links.join(hubs.withColumnRenamed("digest", "other").hint("merge"), "other").groupBy("digest").agg(F.min("hub").alias("hub"))
    chars = lines.groupBy("digest").agg(F.max(F.coalesce(F.char_length("line"), F.lit(0))).alias("chars"))
    placed = stage(further.join(chars.hint("merge"), "digest"), "hubs")
    weights = stage(placed.groupBy("hub").agg(F.ceil(F.sum("chars") / _BLOCK_CHARS).alias("parts"), F.sum("chars").alias("all")), "weights")
    whole = weights.agg(F.sum("all").alias("all")).first()["all"] or 0
    alone = F.xxhash64("hub", F.pmod(F.xxhash64("digest"), F.col("parts")))
    joint = F.pmod(F.xxhash64("hub"), F.lit(whole // _BLOCK_CHARS + 1))
    return placed.join(weights.hint("merge"), "hub").select("digest", F.when(F.col("parts") > 1, alone).otherwise(joint).alias("block"))


def _similarities(asked: DataFrame, lines: DataFrame, k: int) -> DataFrame:
    """``(x, y, jaccard)`` of pairs of different lines, by digest. A line is sent once to each pair of blocks that has a pair of it."""
    blocks = stage(_blocks(asked, lines), "blocks")
    side = lambda name: blocks.select(F.col("digest").alias(name), F.col("block").alias(f"block_{name}")).hint("merge")
    cells = asked.join(side("x"), "x").join(side("y"), "y")
    cells = cells.select("x", "y", F.least("block_x", "block_y").alias("i"), F.greatest("block_x", "block_y").alias("j"))
    cells = stage(cells, "cells")
    ends = F.array(*[F.struct("i", "j", F.col(name).alias("digest")) for name in ("x", "y")])
    wanted = cells.select(F.inline(ends)).distinct()
    texts = wanted.join(lines.dropDuplicates(["digest"]).select("digest", "line").hint("merge"), "digest")
    return cells.groupBy("i", "j").cogroup(texts.groupBy("i", "j")).applyInArrow(_similar(k), "x binary, y binary, jaccard double")


def verified_pairs(
    pairs: DataFrame,
    df: DataFrame,
    row_id: str,
    text: str,
    k: int = 5,
    threshold: float | None = None,
    tokens=letter_tokens,
) -> DataFrame:
    """``(a, b, jaccard)``: exact similarity of the shingle sets of candidate pairs.

    Only texts that are in some pair are read on. Pairs go to the lines of their texts, block by block, so a line
    that is in many pairs of its group is sent once, not once a pair; their sets, many times larger, are made
    there. Equal lines have similarity 1 and are one line.
    """
    wanted = pairs.select(F.inline(F.array(F.struct(F.col("a").alias(row_id)),
                                           F.struct(F.col("b").alias(row_id))))).distinct()
    used = df.select(row_id, text).join(wanted, row_id, "left_semi").repartition(row_id)
    line = F.array_join(tokens(text), " ")
    digest = F.unhex(F.md5(F.coalesce("line", F.lit("")))).alias("digest")
    lines = stage(used.select(row_id, line.alias("line")).select("*", digest), "lines")

    def named(name: str, other: str) -> DataFrame:
        return lines.select(F.col(row_id).alias(name), F.col("digest").alias(other), F.char_length("line").alias(f"n_{name}")).hint("merge")

    marked = pairs.select("a", "b").join(named("a", "x"), "a").join(named("b", "y"), "b")
    # a null text has no similarity
    marked = stage(marked.withColumn("known", F.col("n_a").isNotNull() & F.col("n_b").isNotNull()), "marked")
    equal = F.col("x") == F.col("y")
    same = marked.filter(equal).select("a", "b", F.when(F.col("known") & (F.col("n_a") >= k), F.lit(1.0)).alias("jaccard"))
    # the same two lines once, however many pairs have them
    asked = stage(marked.filter(~equal).select("x", "y").distinct(), "asked")
    apart = marked.filter(~equal).join(_similarities(asked, lines, k).hint("merge"), ["x", "y"])
    apart = apart.select("a", "b", F.when(F.col("known"), F.col("jaccard")).alias("jaccard"))
    found = same.unionByName(apart)
    return found if threshold is None else found.filter(F.col("jaccard") >= threshold)


def neighbour_lists(pairs: DataFrame, line_length: int = 1000) -> DataFrame:
    """``(a, line, neighbours)``: the partners ``b > a`` of every ``a`` in id order, ``line_length``
    to a line, so no row grows without bound. Lines are numbered from 0."""
    ones = pairs.select("a", "b", F.lit(1).alias("_one"))
    placed = running_total(ones, "a", [F.col("b")], "_one", "_place")
    line = F.floor((F.col("_place") - 1) / line_length).cast("int")
    return placed.groupBy("a", line.alias("line")).agg(F.sort_array(F.collect_list("b")).alias("neighbours"))


def copy_pairs(members: DataFrame, row_id: str) -> DataFrame:
    """``(a, b, agreement)``: every copy with its representative, from ``copy_members``."""
    copies = members.filter(F.col(row_id) != F.col("rep"))
    return copies.select(F.col("rep").alias("a"), F.col(row_id).alias("b"), F.lit(1.0).alias("agreement"))


def document_links(signatures: DataFrame, row_id: str, bands: int = 20, threshold: float = 0.8, **limits: int) -> DataFrame:
    """``(a, b, agreement)`` over all documents: the candidate pairs of representatives, and
    every copy with its representative.

    A group of copies makes one pair per copy; all pairs of its members, and of members
    of two linked groups, follow by joining ``copy_members`` on both sides.
    """
    signatures = stage(signatures, "signatures")
    groups = copy_groups(signatures, row_id)
    links = candidate_pairs(groups, bands, threshold, **limits)
    return links.unionByName(copy_pairs(copy_members(signatures, groups, row_id), row_id))
