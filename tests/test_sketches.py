import math

import numpy as np

from tablework.operators.sketches import RANK_ERROR, merge_sketches, quantile_sketches, sketch_quantiles


def test_merged_quantiles_have_small_rank_errors(spark):
    draw = np.random.RandomState(3)
    rows = [(str(g), int(d), float(x)) for g, d, x in zip(draw.choice(["a", "b"], 20_000, p=[0.9, 0.1]), draw.randint(0, 9, 20_000), draw.lognormal(size=20_000))]
    rows += [("tie", 1, 5.0)] * 3000 + [("tie", 2, 6.0)] * 1000 + [("none", 1, None), ("none", 1, math.nan), ("a", 1, None), (None, 3, 1.5)]
    df = spark.createDataFrame(rows, "g string, day int, x double")
    found = sketch_quantiles(merge_sketches(quantile_sketches(df, ["g", "day"], "x"), ["g"]), [0.0, 0.25, 0.5, 0.99, 1.0]).collect()
    assert {r.g for r in found} == {"a", "b", "tie", None}
    for r in found:
        own = np.array([x for g, _, x in rows if g == r.g and x is not None and not math.isnan(x)])
        assert r.n == len(own)
        below, up_to = (own < r.value).mean(), (own <= r.value).mean()
        assert below - RANK_ERROR <= r.share <= up_to + RANK_ERROR


def test_empty_table(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert sketch_quantiles(merge_sketches(quantile_sketches(df, ["g"], "x"), ["g"]), [0.5]).collect() == []
