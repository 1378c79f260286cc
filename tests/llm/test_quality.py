import random

import numpy as np
import pyarrow as pa

from tablework.llm.quality import COST, PASSES, PSEUDO, _train, fit, fit_quality, indicators, score_quality


def rows(seed, n):
    rng = random.Random(seed)
    good, bad = ["calm", "water", "stone", "and", "the"], ["BUY!!", "$$$", "now***", "and", "the"]
    return [(i, " ".join(rng.choice(good if i % 3 else bad) for _ in range(rng.randrange(4, 40))), int(i % 3 > 0)) for i in range(n)]


def test_held_out_accuracy(spark):
    train, test = rows(1, 300), rows(2, 200)
    docs = spark.createDataFrame([(d, t, 7.0) for d, t, _ in train] + [(3, None, 7.0), (None, "x", 7.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(d, q) for d, _, q in train] + [(9999, 1), (5, None), (None, 0), (6, 0), (6, 1)], "doc_id long, quality int")
    model = fit_quality(docs, labels)
    found = score_quality(spark.createDataFrame(test, "doc_id long, text string, quality int"), model).collect()
    assert sum(r.quality == r.predicted for r in found) > 0.97 * len(test)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    odd = [(1, None), (2, ""), (2, ""), (3, "x" * 100000), (None, "the")]
    found = score_quality(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert len(found) == 5 and len({r.score for r in found if not r.text}) == 1
    fewer = fit_quality(docs, labels, fit_rows=50)
    assert np.isfinite(fewer.weights).all()


def test_one_class_and_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert [r.score for r in score_quality(docs, fit_quality(docs, labels)).collect()] == [0.75, 0.75]
    assert [r.score for r in score_quality(docs, fit_quality(docs, labels.limit(0))).collect()] == [0.5, 0.5]
    assert score_quality(docs.limit(0), fit_quality(docs.limit(0), labels)).collect() == []


def test_margins_separate_the_classes():
    data = rows(3, 120)
    features, at = indicators(pa.array([t for _, t, _ in data]))
    labels = np.array([q for _, _, q in data])
    scores = fit(features, at, labels).scores(features, at)
    assert ((scores >= 0.5) == (labels == 1)).all()


def test_indicators_are_sets():
    features, at = indicators(pa.array(["ab ab ab", None, "ab"]))
    assert np.diff(at).tolist()[1] == 0
    one = [set(features[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
    assert one[2] <= one[0] and all(len(s) == n for s, n in zip(one, np.diff(at)))


def test_descent_closes_the_duality_gap():
    """The weights against the hinge loss and its dual, added up by plain loops over the rows."""
    data = rows(5, 90) + [(90, "calm $$$ water BUY!!", 1), (91, "calm $$$ water BUY!!", 0)]
    texts = pa.array([t for _, t, _ in data])
    features, at = indicators(texts)
    labels = np.array([q for _, _, q in data])
    sets = [features[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    kinds = sorted({f for s in sets for f in s})
    # pseudo-counts of the features that do not occur are in the sums too
    p, q = ({f: PSEUDO + sum(f in s for s, y in zip(sets, labels) if y == want) for f in kinds} for want in (1, 0))
    all_p, all_q = (sum(side.values()) + PSEUDO * ((1 << 18) - len(kinds)) for side in (p, q))
    ratio = {f: np.log(p[f] / all_p) - np.log(q[f] / all_q) for f in kinds}
    n = {y: int((labels == y).sum()) for y in (0, 1)}
    cost = [COST * len(labels) / (2 * n[y]) for y in labels]
    sign = [1.0 if y else -1.0 for y in labels]
    values = [{f: ratio[f] / len(s) ** 0.5 for f in s} for s in sets]

    def primal(weights, bias):
        assert not np.setdiff1d(np.flatnonzero(weights), kinds).size
        w = {f: weights[f] / ratio[f] if ratio[f] else 0.0 for f in kinds}
        margins = [y * (sum(w[f] * v for f, v in x.items()) + bias) for x, y in zip(values, sign)]
        return (sum(x * x for x in w.values()) + bias**2) / 2 + sum(c * max(0.0, 1 - m) for c, m in zip(cost, margins))

    # a plain dual ascent, many more rounds
    dual, v, b = [0.0] * len(sets), dict.fromkeys(kinds, 0.0), 0.0
    for _ in range(400):
        for i, x in enumerate(values):
            slope = sign[i] * (sum(v[f] * z for f, z in x.items()) + b) - 1
            new = min(max(dual[i] - slope / (sum(z * z for z in x.values()) + 1), 0.0), cost[i])
            step, dual[i] = (new - dual[i]) * sign[i], new
            b += step
            for f, z in x.items():
                v[f] += step * z
    best = sum(dual) - (sum(z * z for z in v.values()) + b * b) / 2
    every = np.arange(len(labels))
    loss = {n: primal(*_train(features, at, labels, every, passes=n)) for n in (PASSES, 400)}
    assert all(best <= x * (1 + 1e-9) for x in loss.values())
    # rounds end when no dual moves by a thousandth
    assert loss[400] - best <= 0.005 * best and loss[PASSES] - best <= 0.05 * best, (loss, best)
