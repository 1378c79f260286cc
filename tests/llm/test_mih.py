import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.llm.mih import _Index, fit_codes, nearest


def brute(rows, is_query, k=5):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in good:
        if is_query(q):
            a = np.array(v)
            scores = [(-(a @ np.array(w)) / np.linalg.norm(a) / np.linalg.norm(w), i) for i, w in good if i != q]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scores)[:k]]
    return out


def check(got, want, least_recall):
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {q for q in want if want[q]}
    hits = total = 0
    for q, rows in found.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, len(want[q]) + 1))
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(rows, rows[1:]))
        hits += len({i for _, i, _ in rows} & {i for i, _ in want[q]})
        total += len(want[q])
    assert hits >= least_recall * total


def test_recall_on_hard_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(3000, 32)).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check(nearest(df, F.col("vec_id") % 50 == 0).collect(), brute(rows, lambda i: i % 50 == 0), 0.9)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(40, 8)).astype(np.float32))]
    common = [1.0] + [0.5] * 7
    rows += [(100 + i, common) for i in range(30)] + [(100, common), (7, rows[7][1])]
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [float("nan")] * 8), (204, [float("inf")] + [1.0] * 7), (205, [None] + [1.0] * 7), (None, common)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    want = brute(rows, lambda i: i % 10 == 0)
    check(nearest(df, F.col("vec_id") % 10 == 0).collect(), want, 0.95)
    assert nearest(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0]), (50, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id) for r in nearest(one, F.col("vec_id") == 0).collect()] == [(0, 1, 50)]


def test_double_vectors(spark):
    """Components beyond the range of float, and squares beyond that of double, count."""
    rows = [(0, [1e-60, 0.0, 1e-60]), (1, [1e300, 1e300, 0.0]), (2, [1.0, 0.0, 1.0 + 1e-12]), (3, [3e-320, 0.0, 1e-323]), (4, [0.0, -1e200, 1e-200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in nearest(df, F.lit(True)).collect()}
    want = brute([(i, [x / max(map(abs, v)) for x in v]) for i, v in rows], lambda i: True)
    assert set(got) == {(q, r) for q in want for r in range(1, 5)}
    for q, best in want.items():
        for rank, (i, score) in enumerate(best, 1):
            assert abs(got[q, rank][1] - score) < 1e-9
    assert got[0, 1][0] == 2 and got[2, 1][0] == 0


def test_several_dimensions(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (50, [2.0, 1.0, 0.5])], "vec_id long, embedding array<float>")
    with pytest.raises(ValueError, match="2 to 3 dimensions"):
        nearest(df, F.col("vec_id") == 0)


@pytest.mark.parametrize("radius", [0, 5, 16, 40, 90])
def test_every_code_within_the_radius(radius):
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 1 << 16, (400, 16)).astype(np.uint16)
    codes[:200] = codes[0] ^ (1 << rng.integers(0, 16, (200, 16))).astype(np.uint16) * (rng.random((200, 16)) < 0.5)
    index = _Index(codes)
    for i in range(0, 400, 37):
        far = np.bitwise_count(codes ^ codes[i]).sum(axis=1)
        assert set(index.within(codes[i], radius)) == set(np.flatnonzero(far <= radius))


def test_rotation_keeps_angles():
    vectors = np.random.default_rng(7).normal(size=(500, 24))
    codes = fit_codes(vectors, 5, 48)
    first = codes.rotation[:, :24]
    assert np.allclose(first.T @ first, np.eye(24))
