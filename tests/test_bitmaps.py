from collections import Counter

import numpy as np

from tablework.operators import bitmaps, cooccur


def test_counts_from_bitmaps(spark):
    draw = np.random.RandomState(8)
    # 70,000 rows are three buckets; one group holds most of them
    groups = draw.choice(["hot", "b", None], 70_000, p=[0.8, 0.15, 0.05])
    rows = [(int(i), g, [f"w{v}" for v in draw.randint(0, 6, draw.randint(0, 3))]) for i, g in enumerate(groups)]
    rows += [(100_000, "hot", None), (None, "b", ["w1"]), (-5, "alone", ["x", "x"]), (-6, "alone", ["x"])]
    df = spark.createDataFrame(rows, "id bigint, g string, t array<string>").repartition(4)
    known = df.filter("id is not null")
    words = cooccur.vocabulary(known, "g", "t", 4)
    found = bitmaps.presence_bitmaps(df, "id", "g", "t", words)
    kept = found.collect()
    assert max(r.bucket for r in kept) == 3 and all(len(r.bitmap) == 4096 for r in kept)
    top = {(r.g, r.word): r["rank"] for r in kept}
    single, several, either = Counter(), Counter(), Counter()
    for i, g, t in rows:
        ranks = sorted({top[g, w] for w in t or [] if (g, w) in top}) if i is not None else []
        single.update((g, r) for r in ranks)
        either.update([g] if ranks else [])
        several.update((g, x, y) for x in ranks for y in ranks if x <= y)
    assert {(r.g, r["rank"]): r.n for r in bitmaps.row_counts(found, ["g", "rank"]).collect()} == single
    assert {r.g: r.n for r in bitmaps.row_counts(found, ["g"]).collect()} == either
    assert {(r.g, r.r1, r.r2): r.n for r in bitmaps.pair_counts(found, "g").collect()} == several


def test_empty(spark):
    df = spark.createDataFrame([], "id bigint, g string, t array<string>")
    found = bitmaps.presence_bitmaps(df, "id", "g", "t", cooccur.vocabulary(df, "g", "t"))
    assert found.collect() == bitmaps.pair_counts(found, "g").collect() == bitmaps.row_counts(found, ["g"]).collect() == []
