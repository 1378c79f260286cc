"""Language-model scores by prediction by partial matching over byte contexts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.text import LOWER, mix64, packed, slices
from tablework.plans import stage

#: Bytes of context.
ORDER = 5
#: The most frequent n-grams and words that every task holds; the others are joined.
HOT_GRAMS, HOT_WORDS = 1 << 19, 1 << 17

# Symbols: bytes plus one, and 0 for what stands before and at the end of a text.
_SYMBOL_BITS, _SYMBOLS = 9, 257
_SLICE = 512 << 10


def text_grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams, offsets): for each byte of a text, and its end, the ``order`` symbols before
    it and its own, packed into one number. A-Z are lower-cased."""
    data, offsets = packed(texts)
    n = len(offsets) - 1
    symbols = np.zeros(len(data) + (n + 1) * order, dtype=np.int64)
    lengths = np.diff(offsets)
    shift = np.repeat(np.arange(1, n + 1) * order, lengths)
    symbols[np.arange(len(data)) + shift] = LOWER[data].astype(np.int64) + 1
    grams = np.zeros(len(symbols) - order, dtype=np.int64)
    for j in range(order + 1):
        grams = (grams << _SYMBOL_BITS) | symbols[j : len(symbols) - order + j]
    # text i begins at offsets[i] + i * order; it has one place more than bytes, its end
    ends = np.cumsum(lengths + 1)
    place = np.arange(ends[-1] if n else 0) + np.repeat(np.arange(n) * (order - 1), lengths + 1)
    return grams[place], np.concatenate([[0], ends])


def text_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, offsets): the words between ASCII white space, A-Z lower-cased, of each text."""
    raw = pc.fill_null(texts, "").cast(pa.binary())
    data, offsets = packed(raw)
    lower = pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(LOWER[data])]
    )
    lists = pc.ascii_split_whitespace(lower)
    words = lists.flatten()
    at = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    real = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), before[at]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _gram_counts(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts):
            keys, n = _merged(parts)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["gram", "n"])

        parts, held = [], 0
        for whole in batches:
            for batch in slices(whole, "text", _SLICE):
                grams, _ = text_grams(batch.column("text"), order)
                parts.append(np.unique(grams, return_counts=True))
                held += len(parts[-1][0])
                if held > 2_000_000:
                    parts = [_merged(parts)]
                    held = len(parts[0][0])
                    if held > 1_500_000:
                        yield out(parts)
                        parts, held = [], 0
        if parts:
            yield out(parts)

    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 8 * _SLICE):
            words, _ = text_words(batch.column("text"))
            counts = pc.value_counts(words)
            yield pa.RecordBatch.from_arrays(
                [counts.field("values").cast(pa.string()), counts.field("counts")], names=["word", "n"]
            )


def _low_bits(symbols: Column, most: int) -> Column:
    """A mask of that many symbols."""
    return F.array(*[F.lit((1 << _SYMBOL_BITS * k) - 1).cast("long") for k in range(most + 1)])[symbols]


class PPM:
    """Counts of all byte contexts up to ``order`` in a corpus, as tables, and the scores they give.

    The context trie is the table of distinct (context, symbol) pairs with counts; it is
    counted per task and added up, so it grows with the corpus and is never in one place.
    A symbol seen n times in a context with t occurrences of d different symbols has
    probability (2n - 1) / 2t there, the escape to the next shorter context d / 2t
    (estimate D). Symbols of the longer context are excluded: their occurrences and
    number are taken off t and d. After the empty context come all symbols not seen, with
    equal shares. A text is its bytes (A-Z lower-cased) and an end.
    """

    def __init__(self, docs: DataFrame, order: int = ORDER, text: str = "text"):
        if not 0 < order * _SYMBOL_BITS + _SYMBOL_BITS < 64:
            raise ValueError("six bytes of context at most fit into a number")
        self.order = order
        rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        self.top = stage(
            rows.mapInArrow(_gram_counts(order), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams"
        )
        mask = _low_bits(F.col("j") + 1, order + 1)
        suffixes = self.top.select(F.explode(F.sequence(F.lit(0), F.lit(order))).alias("j"), "gram", "n")
        self.grams = stage(
            suffixes.select("j", F.col("gram").bitwiseAND(mask).alias("gram"), "n")
            .groupBy("j", "gram")
            .agg(F.sum("n").alias("n")),
            "orders",
        )
        shorter = self.grams.select((F.col("j") + 1).alias("j"), F.col("gram").alias("less"), F.col("n").alias("outer"))
        cut = _low_bits(F.col("j"), order)
        self.contexts = stage(
            self.grams.withColumn("less", F.col("gram").bitwiseAND(cut))
            .join(shorter, ["j", "less"], "left")
            .groupBy("j", F.shiftright("gram", _SYMBOL_BITS).alias("context"))
            .agg(F.sum("n").alias("t"), F.count("*").alias("d"), F.sum("outer").alias("e")),
            "contexts",
        )
        # a gram that occurs needs no shorter context
        full = self.contexts.filter(F.col("j") == order).select("context", "t")
        self.seen = stage(
            self.top.withColumn("context", F.shiftright("gram", _SYMBOL_BITS))
            .join(full, "context")
            .select("gram", "n", F.log10((2 * F.col("n") - 1) / (2 * F.col("t"))).alias("score")),
            "seen",
        )

    def gram_scores(self, grams: DataFrame) -> DataFrame:
        """(gram, score): log10 of the probability of the last symbol of each distinct gram."""
        rows = grams.select("gram", F.explode(F.sequence(F.lit(0), F.lit(self.order))).alias("j"))
        mask = _low_bits(F.col("j") + 1, self.order + 1)
        rows = rows.withColumn("part", F.col("gram").bitwiseAND(mask)).withColumn(
            "context", F.shiftright("part", _SYMBOL_BITS)
        )

        def look_up(level: str, hint: str) -> DataFrame:
            contexts = self.contexts.filter(level).hint(hint)
            parts = self.grams.filter(level).withColumnRenamed("gram", "part").hint(hint)
            return rows.filter(level).join(contexts, ["j", "context"], "left").join(parts, ["j", "part"], "left")

        # contexts of at most one byte are few (with their symbols 66,306 rows) and every gram has them
        found = look_up("j < 2", "broadcast").unionByName(look_up("j > 1", "merge"))
        seen = F.when(F.col("t").isNotNull(), F.struct("j", "n", "t", "d", "e"))
        steps = F.sort_array(F.collect_list(seen), asc=False)
        # from the longest context that occurs down to the first with the symbol
        start = F.struct(
            F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("e"), F.lit(0).cast("long").alias("d"), F.lit(False).alias("done")
        )

        def add(state, x):
            t, d = x["t"] - state["e"], x["d"] - state["d"]
            hit = x["n"].isNotNull()
            part = F.when(hit, F.log10((2 * x["n"] - 1) / (2 * t))).when(d > 0, F.log10(d / (2 * t))).otherwise(0.0)
            return F.struct(
                (state["score"] + F.when(state["done"], 0.0).otherwise(part)).alias("score"),
                F.coalesce(x["e"], F.lit(0).cast("long")).alias("e"),
                x["d"].alias("d"),
                (state["done"] | hit).alias("done"),
            )

        def end(state):
            rest = F.log10(F.greatest(_SYMBOLS - state["d"], F.lit(1)).cast("double"))
            return state["score"] - F.when(state["done"], 0.0).otherwise(rest)

        return found.groupBy("gram").agg(F.aggregate(steps, start, add, end).alias("score"))

    def frequent(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``most`` most frequent grams and their scores, in the order of the grams."""
        table = self.seen.orderBy(F.desc("n"), "gram").limit(most).select("gram", "score").toArrow()
        grams, scores = table["gram"].to_numpy(), table["score"].to_numpy()
        order = np.argsort(grams)
        return grams[order], scores[order]


class _Table:
    """Numbers by key, for many lookups: open addressing with half of the places free."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << self.bits)
        rest, at = np.arange(len(keys)), self._home(keys)
        while len(rest):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[rest[free]]
            placed = self.keys[at] == keys[rest]
            self.values[at[placed]] = values[rest[placed]]
            rest, at = rest[~placed], (at[~placed] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys.view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, found)."""
        at = self._home(keys)
        held = self.keys[at]
        rest = np.flatnonzero((held != keys) & (held != -1))
        while len(rest):
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
            held[rest] = self.keys[at[rest]]
            rest = rest[(held[rest] != keys[rest]) & (held[rest] != -1)]
        found = held == keys
        return np.where(found, self.values[at], 0.0), found


_SCORED = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, word string, gram long, n long"


def _scored(shared, order: int):
    """A row per document with what the frequent words and grams give, and a row for each
    other word and gram of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, scores, words, counts, total, kinds, n_ends = shared.value
        table = _Table(grams, scores)
        value_set = pa.array(words, pa.large_string())
        word_logs = np.log10((counts + 1) / (total + kinds + 1))
        end_log = float(np.log10((n_ends + 1) / (total + kinds + 1)))
        for whole in batches:
            for batch in slices(whole, "text", _SLICE):
                texts, n = batch.column("text"), batch.num_rows
                own_words, first = text_words(texts)
                at = pc.index_in(own_words, value_set=value_set)
                other = at.is_null().to_numpy(zero_copy_only=False)
                at = at.fill_null(0).to_numpy()
                doc = np.repeat(np.arange(n), np.diff(first))
                known = np.bincount(doc[~other], minlength=n) + (n_ends > 0)
                base = np.bincount(doc[~other], word_logs[at[~other]] if len(words) else None, n) + end_log
                own, offsets = text_grams(texts, order)
                value, found = table.get(own)
                gram_doc = np.repeat(np.arange(n), np.diff(offsets))
                score = np.add.reduceat(value, offsets[:-1]) if n else np.zeros(0)
                rid, none = batch.column("rid"), lambda kind, size: pa.nulls(size, kind)
                head = [
                    rid, batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(first) + 1), pa.array(known.astype(np.int64)),
                    pa.array(base), pa.array(score), none(pa.string(), n), none(pa.int64(), n), none(pa.int64(), n),
                ]
                names = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "word", "gram", "n"]
                yield pa.RecordBatch.from_arrays(head, names=names)

                def tail(docs, size, word, gram, count):
                    blank = [none(k, size) for k in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                    return pa.RecordBatch.from_arrays([rid.take(pa.array(docs)), *blank, word, gram, count], names=names)

                if other.any():
                    coded = pc.dictionary_encode(own_words.filter(pa.array(other)))
                    size = len(coded.dictionary)
                    pair, count = np.unique(doc[other] * size + coded.indices.to_numpy(), return_counts=True)
                    word = coded.dictionary.take(pa.array(pair % size)).cast(pa.string())
                    yield tail(pair // size, len(pair), word, none(pa.int64(), len(pair)), pa.array(count))
                if not found.all():
                    rest, rest_doc = own[~found], gram_doc[~found]
                    kind, code = np.unique(rest, return_inverse=True)
                    pair, count = np.unique(rest_doc * len(kind) + code, return_counts=True)
                    gram = pa.array(kind[pair % len(kind)])
                    yield tail(pair // len(kind), len(pair), none(pa.string(), len(pair)), gram, pa.array(count))

    return run


def score_texts(
    docs: DataFrame, learn: str = "learn", order: int = ORDER, hot_grams: int = HOT_GRAMS, hot_words: int = HOT_WORDS
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``docs``: doc_id, text, and a boolean column ``learn`` that says what to learn from; other
    columns are not read. ``score`` is the log10 probability of the text under the PPM model
    of all texts to learn from. ``base_score`` is that of its tokens under add-one counts of
    words, the end of a text being one token. Null texts count as empty: one token, the end.
    Null ``learn`` counts as false. Rows with equal ids stay apart. Without anything to learn
    from all symbols are equally likely.

    The texts are read twice, to count and to score. Words and grams among the most frequent
    (a fixed number, so a bound on what is broadcast) are looked up where the text is; the
    others go, once per document, to the tables of counts in a join.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(learn), F.lit(False)).alias("learn"),
    )
    train = rows.filter("learn")
    model = PPM(train, order)
    words = stage(
        train.select("text").mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_ends = train.count()
    total, kinds = sums["n"] + n_ends, sums["v"] + (n_ends > 0)
    best = words.orderBy(F.desc("n"), "word").limit(hot_words).toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(
        (*model.frequent(hot_grams), best["word"].to_pylist(), best["n"].to_numpy().astype(np.int64), total, kinds, n_ends)
    )
    scored = stage(
        rows.select(
            F.monotonically_increasing_id().alias("rid"), "doc_id", (~F.col("learn")).alias("held_out"), "text"
        ).mapInArrow(_scored(shared, order), _SCORED),
        "scored",
    )
    other_words = (
        scored.filter("word is not null")
        .select("rid", "word", F.col("n").alias("times"))
        .join(words.hint("merge"), "word", "left")
        .select(
            "rid",
            F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("n_known"),
            (F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(total + kinds + 1)))).alias("base"),
            F.lit(0.0).alias("score"),
        )
    )
    other_grams = scored.filter("gram is not null").select("rid", "gram", "n")
    unseen = other_grams.select("gram").distinct().join(model.seen.hint("merge"), "gram", "left_anti")
    gram_scores = model.seen.select("gram", "score").unionByName(stage(model.gram_scores(unseen), "gram_scores"))
    other_grams = other_grams.join(gram_scores.hint("merge"), "gram").select(
        "rid", F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base"), (F.col("n") * F.col("score")).alias("score")
    )
    head = scored.filter("n_tokens is not null")
    parts = head.select("rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score")
    for part in (other_words, other_grams):
        parts = parts.unionByName(part, allowMissingColumns=True)
    return (
        parts.groupBy("rid")
        .agg(
            *[F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens")],
            *[F.sum(c).alias(c) for c in ("n_known", "base", "score")],
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(total).cast("long").alias("train_tokens"),
            F.col("base").alias("base_score"),
            "score",
        )
    )
