from collections import Counter
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from tablework.operators import cooccur


def brute_force(rows, size, all_rows=False):
    groups = {}
    for group, tokens in rows:
        groups.setdefault(group, []).append(tokens)
    out = {}
    for group, texts in groups.items():
        counts = Counter(w for t in texts for w in t)
        words = sorted(counts, key=lambda w: (-counts[w], w))[:size]
        for a, b in product(words, words):
            where = [t for _, t in rows] if all_rows else texts
            out[group, a, b] = sum(a in t and b in t for t in where)
    return out


def test_against_brute_force_with_a_hot_and_many_small_groups(spark):
    draw = np.random.RandomState(2)
    rows = [("hot", [f"w{i}" for i in draw.randint(0, 30, 12)]) for _ in range(300)]
    rows += [(f"g{g}", [f"w{i}" for i in draw.randint(0, 5, 4)]) for g in range(600) for _ in range(2)]
    rows += [(None, ["x", "y"]), (None, ["x"]), ("one", ["alone"])]
    empty = [("hot", None), ("hot", []), ("silent", None)]
    df = spark.createDataFrame(rows + empty, "g string, t array<string>").repartition(3)
    found = cooccur.cooccurrence(df, "g", "t", size=10)
    got = {(r.g, r.w1, r.w2): r.n for r in found.collect()}
    assert got == brute_force(rows, 10)
    assert all(got[g, b, a] == n for (g, a, b), n in got.items())


def test_matrix_form(spark):
    rows = [(1, ["a", "b"]), (1, ["a", "c"]), (1, ["a"])]
    df = spark.createDataFrame(rows, "g int, t array<string>")
    matrix = cooccur.as_matrix(cooccur.cooccurrence(df, "g", "t", size=3), "g", size=3)
    assert sorted(tuple(r) for r in matrix.collect()) == [
        (1, 1, "a", 3, 1, 1),
        (1, 2, "b", 1, 1, 0),
        (1, 3, "c", 1, 0, 1),
    ]


def test_counted_in_the_rows_of_all_groups(spark):
    draw = np.random.RandomState(6)
    rows = [(f"g{i % 4}", [f"w{v}" for v in draw.randint(0, 12, 6)]) for i in range(80)]
    df = spark.createDataFrame(rows, "g string, t array<string>").repartition(3)
    found = cooccur.cooccurrence(df, "g", "t", size=5, all_rows=True)
    assert {(r.g, r.w1, r.w2): r.n for r in found.collect()} == brute_force(rows, 5, all_rows=True)


def test_gram_in_blocks(spark):
    draw = np.random.RandomState(9)
    rows = [("hot", [f"w{v}" for v in draw.zipf(1.3, 25) if v < 400]) for _ in range(200)] + [(None, ["x", "y"]), (None, ["x"]), ("one", ["alone"])]
    df = spark.createDataFrame(rows + [("hot", None), ("silent", [])], "g string, t array<string>").repartition(3)
    want = {pair: n for pair, n in brute_force(rows, 150).items() if n}
    for block in (16, 512):
        found = cooccur.gram(df, "g", "t", 150, block=block).collect()
        assert all(r.r1 <= r.r2 for r in found)
        got = {(r.g, r.w1, r.w2): r.n for r in found}
        assert len(got) == len(found)
        assert got | {(g, b, a): n for (g, a, b), n in got.items()} == want
    assert {(r.w1, r.w2) for r in cooccur.gram(df.filter("g is null"), "g", "t", 9, diagonal=False).collect()} == {("x", "y")}
    assert cooccur.gram(df.filter("g = 'silent'"), "g", "t").collect() == []


def test_pairs_of_gram_leave_a_task_once(spark):
    rows = [("g", [f"w{v}" for v in range(40)])] * 400
    df = spark.createDataFrame(rows, "g string, t array<string>").repartition(20)
    cells = cooccur._by_cells(df.select("g", F.col("t").alias("present")), "g", 10)
    # 20 tasks of rows, but one row for every pair, without a sum behind the tasks
    assert cells.count() == 40 * 41 // 2
    assert "Aggregate" not in cells._jdf.queryExecution().executedPlan().toString()
    assert {r.n for r in cells.collect()} == {400}
