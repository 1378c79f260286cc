"""Benchmark decontamination: a prefix-filtered join of item windows with document words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.plans import stage

WINDOW = 13

#: Windows that are broadcast at a time (a window is 13 words at most). More are joined in blocks.
BLOCK_WINDOWS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# All ASCII characters but digits and letters.
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str | Column) -> Column:
    """The words of a text: runs of digits, a-z (A-Z lower-cased) and non-ASCII characters."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _APART), "")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, length, items): the distinct windows, with the sorted ids of their items.

    A window is ``window`` consecutive words; an item of fewer words, but not none, is one.
    """
    cut = items.select("item_id", words("text").alias("all")).filter(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    return (
        cut.select("item_id", "all", F.explode(starts).alias("start"))
        .select("item_id", F.slice("all", F.col("start"), F.lit(window)).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item_id").alias("items"))
        .withColumn("length", F.size("words"))
    )


def rarest_tokens(windows: DataFrame, doc_words: DataFrame) -> DataFrame:
    """``windows`` with ``token`` and ``offset``: its word with the fewest occurrences in
    ``doc_words`` (column word), the first of several.

    A window is contained only if all of its words are, so the necessary prefix in the
    order of rarity is one word long.
    """
    placed = windows.select("id", F.posexplode("words").alias("offset", "word"))
    vocabulary = stage(placed.select("word").distinct(), "vocabulary")
    if vocabulary.limit(BLOCK_WINDOWS + 1).count() <= BLOCK_WINDOWS:
        doc_words = doc_words.join(F.broadcast(vocabulary), "word", "left_semi")
    counts = doc_words.groupBy("word").agg(F.count("*").alias("n"))
    rank = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "word")
    first = placed.join(counts, "word", "left").groupBy("id").agg(F.min(rank).alias("first"))
    return windows.join(
        first.select("id", F.col("first.word").alias("token"), F.col("first.offset").alias("offset")), "id"
    )


def _covered(spans: Column) -> Column:
    """Number of places in the union of the (start, stop) spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))

    def add(done: Column, span: Column) -> Column:
        new = F.greatest(span["stop"] - F.greatest(span["start"], done["stop"]), F.lit(0))
        return F.struct((done["n"] + new).alias("n"), F.greatest(done["stop"], span["stop"]).alias("stop"))

    return F.aggregate(F.sort_array(spans), zero, add, lambda done: done["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, n_items, items (sorted as strings).

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are not read. A document
    word is hit if it lies inside an occurrence of any window of any item. Null and empty
    texts have no words and no hits; rows with equal ids stay apart; windows of items
    without an id hit but are not listed. Without items nothing is hit.

    A document word that is the rarest word of some window proposes one start; the window's
    position and length must fit the document, and all of its words are compared, inside the
    join. The documents are not shuffled: windows go to the documents, in blocks of
    ``block`` windows with one pass over the documents each. Only a row per document and
    one per occurrence are then grouped, so a frequent word or passage makes no large group.
    """
    cut = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        words(F.col("text").cast("string")).alias("words"),
    )
    windows = item_windows(items.select("item_id", F.col("text").cast("string").alias("text")), window)
    windows = stage(windows.withColumn("id", F.monotonically_increasing_id()), "windows")
    doc_words = docs.select(F.explode(words(F.col("text").cast("string"))).alias("word"))
    keys = stage(rarest_tokens(windows, doc_words).withColumnRenamed("words", "sought"), "prefixes")
    blocks = max(1, -(-keys.count() // block))
    if blocks > 1:
        # all passes must see the same numbers
        cut = stage(cut, "numbered")
    placed = cut.select("*", F.posexplode_outer("words").alias("at", "word"))
    begin = F.col("at") - F.col("offset")
    fits = (
        (F.col("word") == F.col("token"))
        & (begin >= 0)
        & (begin + F.col("length") <= F.size("words"))
        & (F.slice("words", begin + 1, F.col("length")) == F.col("sought"))
    )
    found = None
    for i in range(blocks):
        some = keys.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i) if blocks > 1 else keys
        rows = placed.join(F.broadcast(some), fits, "inner" if i else "left")
        if not i:
            # the first place also stands for the document itself
            rows = rows.filter(F.col("id").isNotNull() | F.coalesce(F.col("at") == 0, F.lit(True)))
        rows = rows.select(
            "rid",
            "doc_id",
            "text_hash",
            F.greatest(F.coalesce(F.size("words"), F.lit(0)), F.lit(0)).alias("n_words"),
            F.when(F.col("id").isNotNull(), F.struct(begin.alias("start"), (begin + F.col("length")).alias("stop"))).alias("span"),
            "items",
        )
        found = rows if found is None else found.unionByName(rows)
    items_of = F.sort_array(F.transform(F.array_distinct(F.flatten("lists")), lambda x: x.cast("string")))
    return (
        found.groupBy("rid")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("text_hash").alias("text_hash"),
            F.max("n_words").cast("long").alias("n_words"),
            F.collect_set("span").alias("spans"),
            F.collect_set("items").alias("lists"),
        )
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            _covered(F.col("spans")).cast("long").alias("n_hit"),
            items_of.alias("items"),
        )
        .withColumn("n_items", F.size("items").cast("long"))
    )


def is_contaminated() -> Column:
    """At least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
