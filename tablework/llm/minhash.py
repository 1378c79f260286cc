"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.text import LOWER, mix64, packed, sequences, slices, word_bounds, word_hashes
from tablework.plans import block_cells, join_by_count, join_lookup, stage
from tablework.plans.components import components

#: Signature coordinates = BANDS * ROWS. A pair of similarity 0.8 shares no band with
#: probability (1 - 0.8 ** 4) ** 32 < 5e-8.
BANDS, ROWS = 32, 4

#: Members of a bucket whose pairs are listed; larger buckets are compared in blocks of CELL_ROWS.
LISTED, CELL_ROWS = 30, 1024


def _mix32(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def circulant_signatures(values: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """(sets, size): coordinate k of a set is the least p(s(x) + k), where s and p are the
    two permutations of the 32-bit ring and the shift by k is circular. No set is empty."""
    first = _mix32((mix64(values) >> np.uint64(32)).astype(np.uint32))
    out = np.empty((len(offsets) - 1, size), dtype=np.uint32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(_mix32(first + np.uint32(k + 1)), offsets[:-1])
    return out


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): per text the sorted distinct 64-bit hashes of its word shingles."""
    data, offsets = packed(texts)
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets)
    values, at = sequences(word_hashes(data, starts, ends), first, size)
    sets = [np.unique(values[at[i] : at[i + 1]]) for i in range(len(at) - 1)]
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    return np.concatenate([*sets, values[:0]]), np.concatenate([[0], np.cumsum(sizes)])


def _set_codes(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit codes of each set; equal sets have equal codes."""
    codes = []
    for salt in (0x1B873593, 0x52DCE729):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(values ^ np.uint64(salt)), dtype=np.uint64)])
        codes.append((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
    return codes[0], codes[1]


def _sketch(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                values, offsets = shingle_sets(batch.column("text"), size)
                n = np.diff(offsets)
                code_1, code_2 = _set_codes(values, offsets)
                keys = np.zeros((len(n), bands), dtype=np.uint64)
                full = np.flatnonzero(n)
                if len(full):
                    cells = circulant_signatures(values, np.append(offsets[full], len(values)), bands * rows)
                    cells = cells.astype(np.uint64).reshape(len(full), bands, rows)
                    total = np.zeros((len(full), bands), dtype=np.uint64)
                    for r in range(rows):
                        total = mix64(total + cells[:, :, r])
                    keys[full] = total
                lists = pa.ListArray.from_arrays(
                    np.arange(0, len(n) * bands + 1, bands, dtype=np.int32), pa.array(keys.view(np.int64).ravel())
                )
                columns = {
                    "rid": batch.column("rid"), "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                    "n": pa.array(n), "code_1": pa.array(code_1), "code_2": pa.array(code_2), "keys": lists,
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                values, offsets = shingle_sets(batch.column("text"), size)
                code_1, code_2 = _set_codes(values, offsets)
                own = (code_1 == batch.column("code_1").to_numpy()) & (code_2 == batch.column("code_2").to_numpy())
                lists = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(values.view(np.int64)))
                out = pa.RecordBatch.from_arrays([batch.column("node"), lists], names=["node", "items"])
                yield out.filter(pa.array(own))

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("sizes"))
        .filter(100 * F.col("common") >= percent * (F.col("sizes") - F.col("common")))
        .select("a", "b")
    )


def _pairs_listed(rows: DataFrame, near: Column) -> DataFrame:
    """The pairs of members of a bucket that lie in different components."""
    other = rows.select(
        "bucket", F.col("node").alias("other"), F.col("n").alias("m"), F.col("component").alias("apart")
    )
    return (
        rows.join(other, "bucket")
        .filter((F.col("component") != F.col("apart")) & (F.col("node") < F.col("other")) & near)
        .select(F.col("node").alias("a"), F.col("other").alias("b"))
        .distinct()
    )


def _links_between(percent: int):
    """A cell that compares all full sets of two blocks and returns links enough to connect
    the components between which there are any: fewer than it has rows."""

    def cell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        links: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            left, right = left.combine_chunks(), right.combine_chunks()
            sides = [(t["node"].to_numpy(), t["component"].to_numpy(), t["n"].to_numpy()) for t in (left, right)]
            (node, own, n), (other, apart, m) = sides
            lists = right["items"].chunk(0)
            items = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(other)), np.diff(lists.offsets.to_numpy()))
            order = np.argsort(items, kind="stable")
            items, owner = items[order], owner[order]
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while parent.get(x, x) != x:
                    x = parent[x]
                return x

            for i, values in enumerate(left["items"].chunk(0)):
                mine = values.values.to_numpy()
                begin, end = np.searchsorted(items, mine, "left"), np.searchsorted(items, mine, "right")
                width = end - begin
                at = np.repeat(begin - (np.cumsum(width) - width), width) + np.arange(width.sum())
                common = np.bincount(owner[at], minlength=len(other))
                linked = (100 * common >= percent * (n[i] + m - common)) & (apart != own[i])
                for j in np.flatnonzero(linked):
                    x, y = root(int(own[i])), root(int(apart[j]))
                    if x != y:
                        parent[x] = y
                        links.append((int(min(node[i], other[j])), int(max(node[i], other[j]))))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cell


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, kept, chosen.

    Documents are linked if their sets of distinct ``shingle``-word runs (A-Z lower-cased,
    words between ASCII white space; a shorter text is one run) have a Jaccard similarity
    of at least ``percent`` / 100. component_id is the smallest doc_id reachable over
    links; kept: doc_id = component_id; chosen: kept, and for rows that repeat a doc_id
    the first of them only. Null, empty and blank texts have no set, are linked with
    nothing and are kept. Null ids are allowed: such a row counts in the sets and takes
    the smallest id of its component. Other columns are not read. ``text_hash`` is
    Spark's xxhash64 of the text.

    Equal sets are one node, so a group of copies is one row from there on. In each band
    bucket every member is compared with one hub (linear in the bucket); only members of a
    bucket that then still lie in different components are compared with each other, so no
    link between components is left out: pair by pair in small buckets, in large ones block
    by block inside the tasks, which return links enough to connect the components.
    Every comparison is made on the full sets, read again for candidates only.
    """
    rows_in = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    sketch = stage(
        rows_in.select(
            F.monotonically_increasing_id().alias("rid"), "doc_id", "text", F.xxhash64("text").alias("text_hash")
        ).mapInArrow(
            _sketch(shingle, bands, rows),
            "rid long, doc_id long, text_hash long, n long, code_1 long, code_2 long, keys array<long>",
        ),
        "sketch",
    )
    key = ["n", "code_1", "code_2"]
    classes = stage(
        sketch.filter("n > 0")
        .groupBy(*key)
        .agg(
            F.min("rid").alias("node"),
            F.min("doc_id").alias("least_id"),
            F.count("*").alias("copies"),
            F.min_by("doc_id", "rid").alias("node_doc"),
            F.min_by("keys", "rid").alias("keys"),
        ),
        "classes",
    )
    members = classes.select("node", "n", F.posexplode("keys").alias("band", "key"))
    buckets = stage(
        members.groupBy("band", "key")
        .agg(
            F.count("*").alias("members"),
            F.min(F.struct("node", "n")).alias("hub"),
        )
        .filter("members > 1"),
        "buckets",
    )
    shared = stage(join_by_count(members, buckets, ["band", "key"], "members"), "shared")
    nodes = shared.select("node").distinct()
    wanted = classes.join(nodes, "node").select(
        F.coalesce("node_doc", F.lit(0)).alias("at"), "node", "code_1", "code_2"
    )
    sets = stage(
        join_lookup(rows_in.withColumn("at", F.coalesce("doc_id", F.lit(0))), stage(wanted, "wanted"), "at")
        .select("text", "node", "code_1", "code_2")
        .mapInArrow(_sets(shingle), "node long, items array<long>")
        .groupBy("node")
        .agg(F.first("items").alias("items")),
        "sets",
    )
    near = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")

    to_hubs = (
        shared.select("node", "n", F.col("hub.node").alias("other"), F.col("hub.n").alias("m"))
        .filter((F.col("node") != F.col("other")) & near)
        .select(F.col("other").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    links = stage(_verified(to_hubs, sets, percent), "verified")
    where = stage(components(links), "components")
    placed = stage(
        shared.join(where, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed"
    )
    split = (
        placed.groupBy("band", "key")
        .agg(F.count("*").alias("left_over"), F.min("component").alias("c"), F.max("component").alias("d"))
        .filter("c < d")
        .drop("c", "d")
    )
    open_rows = stage(
        join_by_count(placed, split, ["band", "key"], "left_over").withColumn("bucket", F.xxhash64("band", "key")), "open"
    )
    more = stage(_verified(_pairs_listed(open_rows.filter(F.col("left_over") <= LISTED), near), sets, percent), "verified")
    large = open_rows.filter(F.col("left_over") > LISTED).select("bucket", "node", "component", "n")
    if not large.isEmpty():
        large = stage(large.join(sets, "node"), "large")
        cells = block_cells(
            large, large, "bucket", "node", _links_between(percent), "a long, b long", block_rows=CELL_ROWS, mirrored=True
        )
        more = more.unionByName(stage(cells.distinct(), "verified"))
    if not more.isEmpty():
        where = stage(components(links.unionByName(more)), "components")
    placed = classes.join(where, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    # of the rows with the component's id, the first in the tables is chosen
    named = stage(placed.join(least, "component").select(*key, "copies", "component", "component_id"), "named")
    result = join_by_count(sketch.filter("n > 0").drop("keys"), named, key, "copies")
    result = stage(result, "result")
    first = (
        result.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component")
        .agg(F.min("rid").alias("first"))
    )
    alone = sketch.filter("n = 0").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), F.lit(True).alias("chosen")
    )
    chosen = result.join(first.select(F.col("first").alias("rid"), F.lit(True).alias("chosen")), "rid", "left")
    return chosen.select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.coalesce("chosen", F.lit(False)).alias("chosen"),
    ).unionByName(alone)
