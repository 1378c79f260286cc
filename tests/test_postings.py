from itertools import combinations

import numpy as np
import pytest

from tablework.operators import postings


@pytest.mark.parametrize("span", [8, 4096])
def test_lists_give_the_ones_back(spark, span):
    draw = np.random.RandomState(5)
    ones = {(int(r), int(i)) for r, i in zip(draw.randint(-300, 20_000, 900), draw.randint(0, 9, 900))}
    ones |= {(r, 100) for r in range(0, 9000, 2)}  # a hot shingle
    rows = [*ones, *list(ones)[:50], (None, 3), (4, None)]
    df = spark.createDataFrame(rows, "doc bigint, idx bigint").repartition(5)
    lists = postings.posting_lists(df, "doc", span=span)
    kept = lists.collect()
    assert all(r.n == len(r.deltas) <= span and min(r.deltas[1:], default=1) > 0 for r in kept)
    assert sum(r.n for r in kept) == len(ones)
    assert {(r.row_id, r.idx) for r in postings.posting_rows(lists, span).collect()} == ones
    held = {}
    for r, i in ones:
        held.setdefault(i, set()).add(r)
    pairs = list(combinations(sorted(held), 2)) + [(100, 555)]
    asked = spark.createDataFrame(pairs * 2, "a bigint, b bigint")
    got = postings.shared_rows(lists, asked).collect()
    assert {(r.a, r.b): r.n for r in got} == {(a, b): len(held[a] & held.get(b, set())) for a, b in pairs}
    assert len(got) == len(pairs)


def test_empty(spark):
    none = postings.posting_lists(spark.createDataFrame([], "doc bigint, idx bigint"), "doc")
    assert none.collect() == postings.shared_rows(none, spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_ones_are_packed_before_the_shuffle(spark):
    ones = spark.range(20_000).selectExpr("id div 20 as doc", "id % 20 as idx").repartition(3)
    kinds = list(postings._gather(256, 8)([b for b in ones.toArrow().select(["idx", "doc"]).to_batches()]))
    # four segments by three cells of eight numbers, whatever the number of ones
    assert sum(b.num_rows for b in kinds) == 4 * 3
    lists = postings.posting_lists(ones, "doc", span=256)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(segment") == 1 and "collect_set" not in plan
    assert sorted((r.idx, r.segment, r.n) for r in lists.collect()) == [(i, s, min(256, 1000 - 256 * s)) for i in range(20) for s in range(4)]


def test_pairs_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(postings, "_PAIRS", 7)
    monkeypatch.setattr(postings, "_HELD", 5)
    monkeypatch.setattr(postings, "_PLACES", 64)
    ones = [(d, i) for d in range(-40, 60) for i in range(-3, 12) if d % (abs(i) + 1) == 0]
    df = spark.createDataFrame(ones, "doc bigint, idx int")
    lists = postings.posting_lists(df, "doc", span=16)
    assert dict(lists.dtypes)["idx"] == "int"
    pairs = [(a, b) for a in range(-4, 13) for b in range(-4, 13)] + [(None, 1)]
    got = postings.shared_rows(lists, spark.createDataFrame(pairs, "a int, b int"))
    rows = {i: {d for d, j in ones if j == i} for i in range(-4, 13)}
    assert {(r.a, r.b): r.n for r in got.collect()} == {(a, b): len(rows[a] & rows[b]) if a is not None else 0 for a, b in pairs}
    # every list is sent packed, its partners with it
    assert got._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(segment") >= 1
