"""Quality classifier: Naive Bayes support vectors over n-gram indicators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tablework.llm.text import packed, slices, word_bounds, word_hashes

BITS = 18
GRAM = 4
#: The classifier is fitted on at most so many labelled rows, those of the smallest hashes.
FIT_ROWS = 10_000
#: Pseudo-count, cost of an error, passes over the rows.
PSEUDO, COST, PASSES = 1.0, 1.0, 12


def indicators(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features, offsets): per text the distinct hashed words and byte n-grams, sorted.
    Words are parted by ASCII white space; letter case counts."""
    data, offsets = packed(texts)
    n = len(offsets) - 1
    starts, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends) >> np.uint64(64 - BITS)
    keys = [(np.repeat(np.arange(n), np.diff(first)) << BITS) | words.astype(np.int64)]
    if len(data) >= GRAM:
        wide = data.astype(np.uint32)
        code = np.zeros(len(data) - GRAM + 1, dtype=np.uint32)
        for j in range(GRAM):
            code = (code << np.uint32(8)) | wide[j : len(code) + j]
        code = ((code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        whole = doc[: len(code)] == doc[GRAM - 1 :]
        keys.append((doc[: len(code)][whole] << BITS) | code[whole].astype(np.int64))
    found = np.unique(np.concatenate(keys))
    at = np.searchsorted(found, np.arange(n + 1) << BITS)
    return (found & ((1 << BITS) - 1)).astype(np.int32), at


@dataclass
class QualityModel:
    """``weights`` by feature (1 MB), then the bias; ``slope`` and ``shift`` turn a margin into log odds."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = np.diff(offsets)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[features], dtype=np.float64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.sqrt(np.maximum(n, 1)) + self.bias

    def scores(self, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        margin = self.margins(features, offsets)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def _train(
    features: np.ndarray, offsets: np.ndarray, labels: np.ndarray, some: np.ndarray, seed: int = 1, passes: int = PASSES
) -> tuple[np.ndarray, float]:
    """(weights, bias): dual coordinate descent on the rows ``some``, which hold both labels."""
    size, n, positive = 1 << BITS, len(some), int(labels[some].sum())
    p, q = np.full(size, PSEUDO), np.full(size, PSEUDO)
    for i in some:
        (p if labels[i] == 1 else q)[features[offsets[i] : offsets[i + 1]]] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    y = np.where(labels == 1, 1.0, -1.0)
    cost = np.where(labels == 1, COST * n / (2 * positive), COST * n / (2 * (n - positive)))
    scale = 1 / np.sqrt(np.maximum(np.diff(offsets), 1))
    weights, bias, dual = np.zeros(size), 0.0, np.zeros(len(labels))
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        most = 0.0
        for i in rng.permutation(some):
            own = features[offsets[i] : offsets[i + 1]]
            values = ratio[own] * scale[i]
            slope = y[i] * (weights[own] @ values + bias) - 1
            new = min(max(dual[i] - slope / (values @ values + 1), 0.0), cost[i])
            step = (new - dual[i]) * y[i]
            if step:
                weights[own] += step * values
                bias += step
                dual[i] = new
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return weights * ratio, bias


def _odds(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the log odds of label 1 over the margin, by Newton's method."""
    positive, n, a, b = int(labels.sum()), len(labels), 1.0, 0.0
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (n - positive + 2))
    for _ in range(50):
        prob = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        w = np.maximum(prob * (1 - prob), 1e-9)
        grad = np.array([((prob - target) * margin).sum(), (prob - target).sum()])
        hess = np.array([[(w * margin**2).sum() + 1e-6, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(features: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> QualityModel:
    """Rows are indicators times the log ratio of the classes' counts, over the root of their
    number. The dual of the hinge loss is raised one row at a time; errors in the rarer
    class cost more. The odds are fitted to margins of each fifth row by a model of the others.

    Without rows every score is 0.5; with one class only it is that class's smoothed share.
    """
    n, positive = len(labels), int(labels.sum())
    if positive in (0, n):
        share = (positive + 1) / (n + 2)
        return QualityModel(np.zeros(1 << BITS), 0.0, 0.0, float(np.log(share / (1 - share))))
    every, fifth = np.arange(n), np.arange(n) % 5 == 0
    weights, bias = model = _train(features, offsets, labels, every)
    tried = every
    if 0 < labels[~fifth].sum() < (~fifth).sum() and 0 < labels[fifth].sum() < fifth.sum():
        model, tried = _train(features, offsets, labels, every[~fifth]), every[fifth]
    rows = [features[offsets[i] : offsets[i + 1]] for i in tried]
    margin = np.array([model[0][own].sum() / np.sqrt(max(len(own), 1)) + model[1] for own in rows])
    return QualityModel(weights, bias, *_odds(margin, labels[tried]))


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Fits on at most ``fit_rows`` rows of ``docs`` (doc_id, text) with a label in ``labels``
    (doc_id, quality 0 or 1). Ids that are null, or labelled 0 as well as 1, are not learned
    from; null texts are. The sample is taken by hash before any text is read: its ids are
    broadcast, its features go to one task."""
    clear = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("label"), F.max("quality").cast("int").alias("other"))
        .filter("label = other")
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    order = F.xxhash64("doc_id", F.lit("sample"))
    chosen = clear.select("doc_id", "label").join(ids.hint("merge"), "doc_id", "left_semi").orderBy(order, "doc_id").limit(fit_rows)
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "label", "text")
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found, at = indicators(batch.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(found))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), lists], names=["doc_id", "label", "found"])

    def train(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists = table["found"].chunk(0)
        at = lists.offsets.to_numpy().astype(np.int64)
        model = fit(lists.flatten().to_numpy(), at - at[0], table["label"].to_numpy())
        weights = pa.array([model.weights.astype(np.float32).tolist()], pa.list_(pa.float32()))
        return pa.table({"weights": weights, "bias": [model.bias], "slope": [model.slope], "shift": [model.shift]})

    # rows that repeat an id come after the bound is applied again
    sample = rows.mapInArrow(features, "doc_id long, label int, found array<int>").orderBy(order, "doc_id", "found").limit(fit_rows)
    fitted = sample.groupBy().applyInArrow(train, "weights array<float>, bias double, slope double, shift double").toArrow().to_pylist()
    if not fitted:
        return QualityModel(np.zeros(1 << BITS), 0.0, 0.0, 0.0)
    return QualityModel(np.array(fitted[0]["weights"]), fitted[0]["bias"], fitted[0]["slope"], fitted[0]["shift"])


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with score (the probability of label 1) and predicted (1 from 0.5 on). Null and
    empty texts have no features and the score of the bias. Columns of these names are
    replaced. One pass without a shuffle."""
    added = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    docs = docs.drop(*added.names)
    own = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                score = shared.value.scores(*indicators(batch.column(text)))
                columns = [*[batch.column(c) for c in own], pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*own, *added.names])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added.fields]))
