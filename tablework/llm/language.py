"""Language identification: each document is a mixture of languages.

Expectation-maximisation estimates the shares from n-gram likelihoods; the set of
languages is the one with the highest penalised likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from tablework.llm.text import packed, slices

GRAM = 4
BITS = 16
#: Rounds of expectation-maximisation, pseudo-count of an n-gram, weight of the penalty
#: (overlapping n-grams are not independent).
ROUNDS, PSEUDO, PENALTY = 8, 0.1, 4.0


def letters(text: str | Column) -> Column:
    """Lower case, every run of other characters than letters one space, two spaces around."""
    return F.concat(F.lit("  "), F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), F.lit("  "))


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every n-gram of bytes."""
    data, offsets = packed(texts)
    if len(data) < GRAM:
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    wide = data.astype(np.uint32)
    code = np.zeros(len(data) - GRAM + 1, dtype=np.uint32)
    for j in range(GRAM):
        code = (code << np.uint32(8)) | wide[j : len(data) - GRAM + 1 + j]
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1)
    code >>= np.uint32(32 - BITS)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = text[: len(code)] == text[GRAM - 1 :]
    return code[whole], text[: len(code)][whole]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def flush():
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int64)), pa.array(n[at])],
                names=["lang", "bucket", "n"],
            )
        held.clear()

    for whole in batches:
        for batch in slices(whole, "letters"):
            code, text = _grams(batch.column("letters"))
            langs = batch.column("lang").dictionary_encode()
            own = langs.indices.to_numpy()[text]
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                n = np.bincount(code[own == i], minlength=1 << BITS)
                held[lang] = held[lang] + n if lang in held else n
            if len(held) > 64:
                yield from flush()
    yield from flush()


@dataclass
class LanguageModel:
    """``likelihood[bucket, language]``: half a megabyte a language at most, whatever the corpus."""

    langs: list[str]
    likelihood: np.ndarray


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Counts the n-grams of all rows with a label; each task sends one count per language
    and bucket. Rows without text or label are not learned from; without any rows the
    model knows no language."""
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = (
        rows.select(F.col(lang).cast("string").alias("lang"), letters(F.col(text).cast("string")).alias("letters"))
        .mapInArrow(_counts, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs = sorted(set(counts["lang"].to_pylist()))
    place = {x: i for i, x in enumerate(langs)}
    n = np.zeros((1 << BITS, len(langs)))
    at = np.array([place[x] for x in counts["lang"].to_pylist()], dtype=np.int64)
    n[counts["bucket"].to_numpy(), at] = counts["n"].to_numpy()
    likelihood = (n + PSEUDO) / (n.sum(axis=0) + PSEUDO * (1 << BITS))
    return LanguageModel(langs, likelihood.astype(np.float32))


def _shares(like: np.ndarray, weight: np.ndarray, doc: np.ndarray, starts: np.ndarray, total: np.ndarray, share: np.ndarray, rounds: int):
    """Shares of the components (columns of ``like``) per document, and the log likelihoods."""
    for _ in range(rounds):
        part = like * share[doc]
        part *= (weight / np.maximum(part.sum(axis=1), 1e-30))[:, None]
        share = np.add.reduceat(part, starts, axis=0) / total[:, None]
    fit = np.log(np.maximum(np.einsum("ij,ij->i", like, share[doc]), 1e-30)) * weight
    return share, np.add.reduceat(fit, starts)


def mixtures(model: LanguageModel, texts: pa.Array) -> np.ndarray:
    """(texts, languages + 1): the share of each language, and of the background, in each text.

    The background gives all n-grams the same likelihood; it takes what no language
    explains. Sets of one language more are tried as long as they raise a document's log
    likelihood by more than PENALTY * log(n) / 2. Texts without n-grams are all background.
    """
    k = len(model.langs)
    out = np.zeros((len(texts), k + 1))
    out[:, k] = 1
    code, text = _grams(texts)
    if not len(code) or not k:
        return out
    key, weight = np.unique((text << BITS) | code, return_counts=True)
    doc = key >> BITS
    weight = weight.astype(np.float32)
    full, starts = np.unique(doc, return_index=True)
    doc = np.repeat(np.arange(len(full)), np.diff(np.append(starts, len(doc))))
    total = np.add.reduceat(weight, starts)
    rows = key & ((1 << BITS) - 1)
    like = np.full((len(key), k + 1), 2.0**-BITS, dtype=np.float32)
    like[:, :k] = model.likelihood[rows]
    share, _ = _shares(like, weight, doc, starts, total, np.full((len(full), k + 1), 1 / (k + 1), np.float32), ROUNDS)
    order = np.argsort(-share[:, :k], axis=1, kind="stable")
    best, worth = np.zeros((len(full), k + 1)), np.full(len(full), -np.inf)
    going = np.arange(len(full))
    for size in range(1, k + 1):
        mine = np.isin(doc, going) if len(going) < len(full) else np.ones(len(doc), dtype=bool)
        new = np.zeros(len(full), dtype=np.int64)
        new[going] = np.arange(len(going))
        at = new[doc[mine]]
        first = np.searchsorted(at, np.arange(len(going)))
        chosen = np.concatenate([order[going, :size], np.full((len(going), 1), k)], axis=1)
        part = like[mine][np.arange(len(at))[:, None], chosen[at]]
        begin = np.maximum(share[going[:, None], chosen], 1e-3).astype(np.float32)
        own, fit = _shares(part, weight[mine], at, first, total[going], begin / begin.sum(axis=1, keepdims=True), ROUNDS // 2)
        gain = fit - PENALTY * size * np.log(total[going] + 1) / 2
        better = gain > worth[going]
        took = going[better]
        best[took] = 0
        best[took[:, None], chosen[better]] = own[better]
        worth[took] = gain[better]
        going = took
        if not len(going):
            break
    out[full] = best
    return out


#: What ``identify`` adds.
RESULT = StructType(
    [
        StructField("lang_pred", StringType()),
        StructField("score", DoubleType()),
        StructField("known", DoubleType()),
        StructField(
            "languages", ArrayType(StructType([StructField("lang", StringType()), StructField("share", DoubleType())]))
        ),
    ]
)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred (the language of the largest share, of equal ones the first
    by name), score (its share), known (the share of all languages, the rest being
    background) and languages (all chosen languages with their shares, largest first).

    Null texts, texts without a letter, and all texts if nothing was learned: ``und``,
    0, 0 and no languages. Columns that ``docs`` has under these names are replaced.
    One pass without a shuffle; each row is kept.
    """
    docs = docs.drop(*RESULT.names)
    own = docs.columns
    column = "letters"
    while column in own:
        column += "_"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_langs = shared.value.langs
        for whole in batches:
            for batch in slices(whole, column):
                share = mixtures(shared.value, batch.column(column))
                k = len(known_langs)
                some = np.array([len(x.strip()) > 0 for x in batch.column(column).fill_null("").to_pylist()], dtype=bool)
                some &= k > 0
                top = np.argmax(share[:, :k], axis=1) if k else np.zeros(len(some), dtype=np.int64)
                score = np.where(some, share[np.arange(len(some)), top], 0.0)
                known = np.where(some, 1 - share[:, k], 0.0)
                rows = [
                    [{"lang": known_langs[j], "share": float(row[j])} for j in np.argsort(-row[:k], kind="stable") if row[j] > 0] if ok else []
                    for row, ok in zip(share, some)
                ]
                added = [
                    pa.array([known_langs[t] if ok else "und" for t, ok in zip(top, some)], pa.string()),
                    pa.array(np.clip(score, 0, 1)),
                    pa.array(np.clip(known, 0, 1)),
                    pa.array(rows, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
                ]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], *added], names=[*own, *RESULT.names])

    with_letters = docs.withColumn(column, letters(F.col(text).cast("string")))
    return with_letters.mapInArrow(run, StructType([*docs.schema.fields, *RESULT.fields]))
