"""Source divergence audit: joint tables of count levels from products of one-hot matrices.

The share of a term in a group depends on its count there alone. So the divergence of two groups
is priced from their joint table: how many terms have count a in one and count b in the other. The
indicator columns of all (group, level), multiplied by their transpose, hold all of these tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.text import LOWER, packed, slices, word_bounds
from tablework.plans import join_lookup, stage

#: Documents of a language that must have a term, and the unit of a share.
LEAST_DOCS, UNIT = 10, 1_000_000_000
#: Terms, and sources on either side, of one product.
BLOCK_TERMS, BLOCK_SOURCES = 4096, 64

#: Bytes of text whose terms a task counts at a time.
_SLICE = 4 << 20

# All ASCII characters but letters lie between terms.
APART = np.arange(256) < 128
APART[[*range(65, 91), *range(97, 123)]] = False


def term_counts(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> pa.Table:
    """(lang, source, term, n, docs) of some rows: how often a group has a term, and in how many texts.

    Terms are runs of letters and non-ASCII characters, only A-Z lower-cased.
    """
    data, offsets = packed(texts)
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, APART)
    places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data[~APART[data]])).dictionary_encode()
    many = max(len(found.dictionary), 1)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    in_doc, n = np.unique(doc * many + found.indices.to_numpy(), return_counts=True)
    lang, source = (x.dictionary_encode() for x in (langs, sources))
    group = lang.indices.to_numpy().astype(np.int64) * max(len(source.dictionary), 1) + source.indices.to_numpy()
    cells, cell = np.unique(group[in_doc // many] * many + in_doc % many, return_inverse=True)
    lang_at, source_at = np.divmod(cells // many, max(len(source.dictionary), 1))
    # sums below 2^53, so exact
    sums = np.bincount(cell, weights=n, minlength=len(cells)).astype(np.int64)
    return pa.table(
        {
            "lang": lang.dictionary.take(pa.array(lang_at)),
            "source": source.dictionary.take(pa.array(source_at)),
            "term": found.dictionary.take(pa.array(cells % many)),
            "n": pa.array(sums),
            "docs": pa.array(np.bincount(cell, minlength=len(cells))),
        }
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", _SLICE):
            yield from term_counts(*[batch.column(c) for c in ("lang", "source", "text")]).to_batches()


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * kept)), exact for any long."""
    wide = "decimal(20,0)"
    over, under = (count + 2).cast(wide) * F.lit(UNIT).cast("decimal(10,0)"), (total + 2 * kept).cast(wide)
    return F.call_function("div", over, under) + 1


def priced(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def joint_table(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, count) of the cells, not 0, of the product of two one-hot matrices.

    Row t of the first has its 1 in column ``a[t]``, of the second in ``b[t]``; the product of
    the first's transpose with the second adds 1 at (a[t], b[t]) for every t. Whole numbers.
    """
    cell = a * n_b + b
    if n_a * n_b <= 4 * len(cell):
        n = np.bincount(cell, minlength=n_a * n_b)
        at = np.flatnonzero(n)
        return at // n_b, at % n_b, n[at]
    at, n = np.unique(cell, return_counts=True)
    return at // n_b, at % n_b, n


def _product(block_sources: int, key: tuple, rows: pa.Table, groups: pa.Table) -> pa.Table:
    """Divergences of the sources of block i from those of block j over one block of terms."""
    i, j = key[2].as_py(), key[3].as_py()
    number, least = groups["number"].to_numpy(), groups["p_zero"].to_numpy()
    order = np.argsort(number)
    number, least = number[order], least[order]
    names = groups["source"].take(pa.array(order))
    coded = pa.array(rows["term"].combine_chunks(), pa.string()).dictionary_encode()
    place = coded.indices.to_numpy().astype(np.int64)
    at, p = np.searchsorted(number, rows["number"].to_numpy()), rows["p"].to_numpy()
    # per source: the level of each term, and the share of each level; level 0 is count 0
    by_source = np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[by_source], np.arange(len(number) + 1))
    levels, shares = [], []
    for g in range(len(number)):
        own = by_source[cuts[g] : cuts[g + 1]]
        values, level = np.unique(p[own], return_inverse=True)
        # terms that none of these sources has are rows as well
        column = np.zeros(groups["terms"][0].as_py(), dtype=np.int64)
        column[place[own]] = level + 1
        levels.append(column)
        shares.append(np.concatenate([least[g : g + 1], values]))
    left, right = (np.flatnonzero(number // block_sources == x) for x in (i, j))
    out_g, out_h, out_v = [], [], []
    for g in left:
        for h in right:
            if i == j and h < g:
                continue
            a, b, n = joint_table(levels[g], levels[h], len(shares[g]), len(shares[h]))
            out_g.append(g)
            out_h.append(h)
            out_v.append(int((n * priced(shares[g][a], shares[h][b])).sum()))
    where = pa.array(np.array(out_g, dtype=np.int64)), pa.array(np.array(out_h, dtype=np.int64))
    lang = pa.array([key[0].as_py()] * len(out_g), pa.string())
    return pa.table({"lang": lang, "a": names.take(where[0]), "b": names.take(where[1]), "value": pa.array(out_v, pa.int64())})


def counts_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, counts). Groups: every (lang, source) that occurs; counts: lang, source, term, n
    (occurrences) and docs (documents with the term). Added up per task before the shuffle."""
    clean = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    groups = stage(docs.select(*clean).distinct(), "groups")
    rows = docs.select(*clean, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return groups, stage(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")


def divergences(
    docs: DataFrame, best: int = 10, block_terms: int = BLOCK_TERMS, block_sources: int = BLOCK_SOURCES
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has the divergence of a source from each
    other source of its lang, part ``term`` the ``best`` terms that it has more of than the lang.

    ``docs``: text, lang, source, nulls as ''; other columns are not read. A lang keeps the terms that
    LEAST_DOCS of its documents have; a source without terms has the least shares everywhere. Ranks are
    by falling value, then by the item's bytes. Without documents there are no rows.

    Terms are counted per task before the shuffle. A product takes ``block_terms`` terms and two blocks
    of ``block_sources`` sources of a lang: its tables are priced in the task, and only a number per
    pair leaves it. So neither a common term nor a large source makes a large task; the pairs are
    as many as the result has.
    """
    groups, counts = counts_of(docs)
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= LEAST_DOCS)
    kept = stage(kept.drop("docs"), "kept")
    matrix = stage(counts.drop("docs").join(kept, ["lang", "term"]), "matrix")
    langs = stage(kept.groupBy("lang").agg(F.count("*").alias("V"), F.sum("lang_n").alias("lang_total")), "langs")
    totals = matrix.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # sources are numbered within their lang
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = (
        groups.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", number.alias("number"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "V", "lang_total")])
    )
    p_zero = F.when(F.col("V") > 0, share(F.lit(0), F.col("total"), F.greatest("V", F.lit(1)))).otherwise(1)
    blocks = F.ceil(F.col("V") / block_terms).cast("int")
    sides = F.count("*").over(Window.partitionBy("lang"))
    groups = stage(
        groups.select(
            "*", p_zero.alias("p_zero"), F.greatest(blocks, F.lit(1)).alias("blocks"), F.ceil(sides / block_sources).cast("int").alias("sides")
        ),
        "sources",
    )
    entries = stage(
        join_lookup(matrix, groups, ["lang", "source"]).select(
            "lang",
            "source",
            "term",
            "number",
            "blocks",
            "sides",
            share(F.col("n"), F.col("total"), F.col("V")).alias("p"),
            share(F.col("lang_n"), F.col("lang_total"), F.col("V")).alias("q"),
        ),
        "entries",
    )
    term_block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    per_block = join_lookup(kept, langs.select("lang", F.ceil(F.col("V") / block_terms).cast("int").alias("blocks")), ["lang"])
    per_block = per_block.groupBy("lang", term_block).agg(F.count("*").alias("terms"))
    own = F.floor(F.col("number") / block_sources).cast("int")

    def cells(side: DataFrame) -> DataFrame:
        """Each row once per pair (i, j) of source blocks, i <= j, that its own block is in."""
        other = F.explode(F.sequence(F.lit(0), F.col("sides") - 1))
        return side.select("*", own.alias("own"), other.alias("other")).select(
            "*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
        )

    keys = ["lang", "block", "i", "j"]
    left = cells(entries.select("*", term_block)).select(
        *keys, "term", F.col("number").cast("long"), "p"
    )
    every = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    right = cells(every.join(per_block, ["lang", "block"], "left")).select(
        *keys, "source", F.col("number").cast("long"), F.col("p_zero").cast("long"), F.coalesce("terms", F.lit(0)).alias("terms")
    )
    # a closure, so that the tasks see the size of the blocks
    product = lambda key, rows, sources: _product(block_sources, key, rows, sources)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(product, "lang string, a string, b string, value long")
    values = stage(found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).filter("a != b"), "pairs")
    pairs = values.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        values.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    f = F.expr("(p - q) * (p - q) div (p + q)")
    more = entries.filter("p > q").select("lang", "source", F.col("term").alias("item"), f.alias("value"))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    of_pairs = pairs.select("*", ranked, F.lit("pair").alias("part")).select(columns)
    # the filter on the rank cuts every task's rows before they are shuffled
    of_terms = more.select("*", ranked).filter(F.col("rank") <= best).withColumn("part", F.lit("term")).select(columns)
    return of_pairs.unionByName(of_terms)
