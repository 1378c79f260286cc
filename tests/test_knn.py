import numpy as np
import pytest

from tablework.functions.hashing import SignPlanes
from tablework.operators import knn
from tablework.operators.clean import sample_rows


def cosine(x, y):
    return float(x @ y / np.sqrt((x @ x) * (y @ y)))


def jaccard(x, y):
    return float(((x != 0) & (y != 0)).sum() / max(((x != 0) | (y != 0)).sum(), 1))


def agreement(x, y):
    return float((x == y).mean())


def best(data, queries, k, score, allowed=lambda q, c: True):
    out = set()
    for q in queries:
        ranked = sorted((-round(score(data[q], data[c]), 9), c) for c in data if c != q and allowed(q, c))
        out |= {(q, rank, c) for rank, (_, c) in enumerate(ranked[:k], 1)}
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.RandomState(4)
    data = {i: np.round(draw.randn(8), 1) * draw.randint(0, 2, 8) + (draw.rand(8) < 0.1) for i in range(120)}
    for i in range(0, 120, 3):
        data[i] = data[0]  # a third of all rows are copies
    rows = [(i, [float(x) for x in v]) for i, v in data.items()]
    return data, spark.createDataFrame(rows, "id bigint, vec array<double>")


def found(df):
    return {(r["query"], r["rank"], r["neighbour"]) for r in df.collect()}


@pytest.mark.parametrize("measure, score", [("cosine", cosine), ("jaccard", jaccard), ("agreement", agreement)])
@pytest.mark.parametrize("block_rows", [4096, 17])
def test_exact_search(vectors, measure, score, block_rows):
    data, df = vectors
    safe = {i: v for i, v in data.items() if np.any(v)}
    rows = df.filter(df.id.isin(list(safe)))
    got = knn.exact_neighbours(rows, rows, 3, measure, block_rows=block_rows)
    assert found(got) == best(safe, safe, 3, score)


def test_some_queries_self_and_small_tables(vectors, spark):
    data, df = vectors
    queries = df.filter("id < 12")
    got = knn.exact_neighbours(queries, df, 1, "agreement", with_self=True)
    assert found(got) == {(q, 1, min(c for c in data if (data[c] == data[q]).all())) for q in range(12)}
    pair = df.filter("id in (1, 2)")
    assert found(knn.exact_neighbours(pair, pair, 5)) == {(1, 1, 2), (2, 1, 1)}


@pytest.mark.parametrize("block_rows", [4096, 9])
def test_bucket_search_ranks_the_rows_that_share_a_bucket(vectors, block_rows):
    data, df = vectors
    planes = SignPlanes(planes=3, tables=2, dim=8, seed=5)
    sides = {i: planes.normals @ v > 0 for i, v in data.items()}
    share = lambda q, c: bool((sides[q] == sides[c]).all(axis=1).any())
    got = knn.approximate_neighbours(df, df, planes, 3, "agreement", block_rows=block_rows)
    assert found(got) == best(data, data, 3, agreement, share)


def test_recall(vectors, spark):
    _, df = vectors
    exact = knn.exact_neighbours(df, df, 3, "agreement")
    assert knn.recall(exact, exact).first()["recall"] == 1.0
    nothing = spark.createDataFrame([], exact.schema)
    assert tuple(knn.recall(exact, nothing).first()) == (360, 0, 0.0)


def test_any_number_of_planes(vectors):
    data, df = vectors
    planes = SignPlanes(planes=20, tables=2, dim=8, seed=5)
    sides = {i: planes.normals @ v > 0 for i, v in data.items()}
    share = lambda q, c: bool((sides[q] == sides[c]).all(axis=1).any())
    got = knn.approximate_neighbours(df, df, planes, 3, "agreement")
    assert found(got) == best(data, data, 3, agreement, share)


def test_rows_without_a_vector_change_nothing(vectors, spark):
    data, df = vectors
    more = df.unionByName(spark.createDataFrame([(500 + i, None) for i in range(9)], df.schema))
    for block_rows in (4096, 17):
        got = knn.exact_neighbours(more, more, 3, "agreement", block_rows=block_rows)
        assert found(got) == best(data, data, 3, agreement)
    planes = SignPlanes(planes=3, tables=2, dim=8, seed=5)
    assert found(knn.approximate_neighbours(more, more, planes, 3)) == found(knn.approximate_neighbours(df, df, planes, 3))


@pytest.mark.parametrize("odd", [[1.0] * 3 + [2.0] * 2, [None] + [1.0] * 7])
def test_vectors_that_do_not_fit_are_an_error(vectors, spark, odd):
    _, df = vectors
    # lengths that would add up to whole rows again
    more = df.unionByName(spark.createDataFrame([(500, odd), (501, [1.0] * (16 - len(odd)))], df.schema))
    with pytest.raises(Exception, match="differ in length"):
        knn.exact_neighbours(more, more, 3).collect()


def test_recall_interval(spark):
    exact = spark.createDataFrame([(q, n) for q in range(30) for n in (100, 200)], "query bigint, neighbour bigint")
    found = exact.filter("query >= 10 OR neighbour = 100")
    got = knn.recall_interval(exact, found).first()
    shares = np.array([0.5] * 10 + [1.0] * 20)
    margin = knn.Z * shares.std(ddof=1) / np.sqrt(30)
    assert (got.queries, got.wanted, got.found) == (30, 60, 50)
    assert np.allclose([got.recall, got.low, got.high], [shares.mean(), shares.mean() - margin, min(shares.mean() + margin, 1)])
    one = knn.recall_interval(exact.filter("query = 0"), found).first()
    assert tuple(one) == (1, 2, 1, 0.5, None, None)
    assert tuple(knn.recall_interval(exact.filter("false"), found).first()) == (0, 0, 0, None, None, None)


def test_interval_of_a_sample_holds_the_full_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS vec")
    planes = SignPlanes(planes=4, tables=8, dim=64, seed=7)
    asked = sample_rows(rows, "id", 0.2)
    part = knn.recall_interval(knn.exact_neighbours(asked, rows, 3), knn.approximate_neighbours(asked, rows, planes, 3)).first()
    whole = knn.recall(knn.exact_neighbours(rows, rows, 3), knn.approximate_neighbours(rows, rows, planes, 3)).first()
    assert 50 < part.queries < 150 and part.low <= whole.recall <= part.high


@pytest.mark.parametrize("block_rows", [4096, 9])
def test_probes_reach_across_the_nearest_planes(vectors, block_rows):
    data, df = vectors
    planes = SignPlanes(planes=5, tables=2, dim=8, seed=5)
    along = {i: planes.normals @ v for i, v in data.items()}

    def reached(q, c):
        for x, y in zip(along[q], along[c]):
            near = np.argsort(np.abs(x), kind="stable")[:2]
            if all((a > 0) == (b > 0) for i, (a, b) in enumerate(zip(x, y)) if i not in near):
                return True
        return False

    got = knn.approximate_neighbours(df, df, planes, 3, "agreement", block_rows=block_rows, weak=2)
    assert found(got) == best(data, data, 3, agreement, reached)


def test_recall_and_share_of_probes_on_grouped_vectors(spark):
    draw = np.random.RandomState(3)
    centres = draw.randn(300, 32)
    rows = [(i, [float(x) for x in centres[i % 300] + 0.25 * draw.randn(32)]) for i in range(6000)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    planes = knn.planes_for(len(rows), 32, tables=2)
    asked = df.filter("id % 10 = 0")
    share = knn.probed(asked, planes, 2).select("bucket").join(knn.bucketed(df, planes).select("bucket"), "bucket").count() / (600 * 6000)
    recall = knn.recall(knn.exact_neighbours(asked, df, 3), knn.approximate_neighbours(asked, df, planes, 3, weak=2)).first()["recall"]
    print(f"planes {planes.planes}, recall {recall:.3f}, compared {share:.4f} of all pairs, counted once per table")
    assert recall >= 0.9 and share < 0.05


def test_planes_grow_with_the_table():
    assert [knn.planes_for(n, 8).planes for n in (0, 1, 64, 2000, 10**6, 10**12)] == [1, 1, 1, 6, 15, 24]


@pytest.mark.parametrize("measure, score", [("cosine", cosine), ("agreement", agreement)])
def test_bounds_give_the_best_without_scoring_every_pair(monkeypatch, measure, score):
    import pyarrow as pa

    draw = np.random.RandomState(6)
    rows = draw.randn(900, 8) if measure == "cosine" else draw.randint(0, 300, (900, 70)) // 40
    rows[10:14] = rows[9]
    # the same bytes at the end, but other values
    rows[20:24] = rows[19] if measure == "cosine" else rows[19] + 256
    ids = draw.permutation(900)
    side = pa.table({"id": pa.array(ids), "vec": pa.array(rows.tolist())})

    def every_pair(q, c):
        raise AssertionError("all pairs are scored")

    monkeypatch.setitem(knn.MEASURES, measure, every_pair)
    got = knn._nearest(measure, 3, False)(side.slice(0, 30), side)
    data = dict(zip(ids.tolist(), rows))
    want = [c for _, _, c in sorted(best(data, ids[:30].tolist(), 3, score), key=lambda x: (ids.tolist().index(x[0]), x[1]))]
    assert got["neighbour"].to_pylist() == want
    assert got["query"].to_pylist() == np.repeat(ids[:30], 3).tolist()
