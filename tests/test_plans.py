import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tablework.plans import StagedTables, block_cells, dense_index, join_by_count, running_total, stage, unnest


def test_dense_index_is_the_position_in_order(spark):
    words = sorted({f"{i * 7919 % 1000:03d}é" for i in range(500)})
    df = spark.createDataFrame([(w,) for w in reversed(words)], "w string").repartition(5)
    got = {r.w: r.at for r in dense_index(df, "w", "at").collect()}
    assert got == {w: i for i, w in enumerate(words)}
    assert dense_index(df.filter("false"), "w", "at").count() == 0


def test_running_total_over_ranges(spark):
    draw = np.random.RandomState(1)
    rows = [("hot", float(v), int(n)) for v, n in zip(draw.permutation(400), draw.randint(1, 9, 400))]
    rows += [("cold", 1.0, 4), ("cold", 0.5, 3)]
    df = spark.createDataFrame(rows, "k string, v double, n bigint").repartition(6)
    got = {(r.k, r.v): r.upto for r in running_total(df, "k", [F.col("v")], "n", "upto").collect()}
    want, sums = {}, {}
    for k, v, n in sorted(rows):
        sums[k] = sums.get(k, 0) + n
        want[k, v] = sums[k]
    assert got == want


def test_staged_tables_of_a_block_are_dropped_but_for_the_last(spark):
    outer = stage(spark.range(3), "outer")
    with StagedTables(spark) as tables:
        first = stage(outer, "first")
        with StagedTables(spark) as inner:
            second = stage(first, "second")
            stage(first.filter("false"), "empty")
            inner.drop(but=second)
        assert (len(tables.paths), len(inner.paths)) == (1, 1)
        third = stage(second, "third")
        tables.drop(but=third)
        assert len(tables.paths) == 1 and third.count() == 3
    # written outside the block
    after = stage(third, "after")
    assert len(tables.paths) == 1 and outer.count() == after.count() == second.count() == 3
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(first.inputFiles()[0])
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_staged_table_reads_back(spark):
    df = spark.range(10).withColumn("a", F.array("id"))
    back = stage(df, "t")
    assert back.columns == df.columns and back.count() == 10
    assert "parquet" in back._jdf.queryExecution().executedPlan().toString().lower()


def test_unnest_drops_rows_without_elements_and_adds_no_size_filter(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "i int, t array<string>")
    out = unnest(df, "t", "w")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (1, "b")]
    assert "size(" not in out._jdf.queryExecution().optimizedPlan().toString()


def _all_pairs(key, left, right):
    a, b = left.column("id").to_pylist(), right.column("id").to_pylist()
    pairs = [(x, y) for x in a for y in b]
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()),
                     "b": pa.array([p[1] for p in pairs], pa.int64()),
                     "rows": pa.array([max(len(a), len(b))] * len(pairs), pa.int64())})


def test_cells_cover_every_pair_once_and_stay_small(spark):
    df = spark.range(90).select("id", F.when(F.col("id") < 60, 0).otherwise(F.col("id") % 3).alias("g"))
    out = block_cells(df, df, "g", "id", _all_pairs, "a bigint, b bigint, rows bigint", block_rows=10).collect()
    groups = {r.id: r.g for r in df.collect()}
    want = sorted((a, b) for a in groups for b in groups if groups[a] == groups[b])
    assert sorted((r.a, r.b) for r in out) == want
    assert max(r.rows for r in out) < 30
    half = block_cells(df, df, "g", "id", _all_pairs, "a bigint, b bigint, rows bigint", block_rows=10, mirrored=True).collect()
    assert {frozenset((r.a, r.b)) for r in half} == {frozenset(p) for p in want}
    assert len(half) < len(want)


def test_join_by_count_with_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i}", i) for i in range(4000)]
    left = spark.createDataFrame(rows, "k string, i bigint").repartition(5)
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    joined = join_by_count(left, counts, ["k"], "n")
    sizes = {"hot": sum(1 for i in range(4000) if i % 3)}
    assert sorted((r.i, r.k, r.n) for r in joined.collect()) == [(i, k, sizes.get(k, 1)) for k, i in rows]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan
    some = counts.filter("n = 1")
    assert join_by_count(left, some, ["k"], "n").count() == 4000 - sizes["hot"]
    assert join_by_count(left, counts.filter("false"), ["k"], "n").count() == 0


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    from tablework.plans import staging

    monkeypatch.setattr(staging, "scratch_dir", lambda session: f"file://{tmp_path}/scratch")
    assert staging.stage(spark.range(3), "numbers").count() == 3
    assert any((tmp_path / "scratch").iterdir())
    staging.drop_staged(spark)
    assert not (tmp_path / "scratch").exists()


def test_components_of_chains_stars_and_loops(spark):
    from tablework.plans.components import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(300, 300), (301, 302), (302, 301)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {i: 0 for i in range(41)} | {i: 100 for i in [100, *range(200, 230)]} | {301: 301, 302: 301}
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).collect() == []


def test_join_by_count_sets_the_most_frequent_keys_apart(spark):
    from tablework.plans import skew

    # 20 keys of 64 rows each make nearly all rows, none of them a thousand; 40 keys have one
    rows = [(f"often{i}", j) for i in range(20) for j in range(64)] + [(f"once{i}", 0) for i in range(40)]
    left = spark.createDataFrame(rows, "k string, v int")
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    hot = counts.filter(skew._frequent(counts, "n", 25)).select("k").collect()
    assert {r.k for r in hot} == {f"often{i}" for i in range(20)}
    assert counts.filter(skew._frequent(counts, "n", 19)).count() == 0
    joined = join_by_count(left, counts, ["k"], "n", limit=25)
    want = sorted((k, v, 64 if k.startswith("often") else 1) for k, v in rows)
    assert sorted((r.k, r.v, r.n) for r in joined.collect()) == want
    # up to the limit every key is broadcast: no row of the left side is shuffled
    plan = join_by_count(left, counts, ["k"], "n", limit=60)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
