import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.operators import profile


@pytest.fixture(scope="module")
def numbers(spark):
    draw = np.random.RandomState(3)
    # a third of all rows share one value
    values = [5.0 if i % 3 == 0 else float(v) for i, v in enumerate(draw.lognormal(1, 2, 4000))]
    other = [float(v) for v in draw.randint(0, 9, 4000)]
    rows = [(v if i % 11 else None, o) for i, (v, o) in enumerate(zip(values, other))]
    return rows, spark.createDataFrame(rows, "a double, b double").repartition(7)


def columns(rows):
    return {
        "a": np.array([r[0] for r in rows if r[0] is not None]),
        "b": np.array([r[1] for r in rows]),
    }


def test_profile_against_the_formulas(numbers):
    rows, df = numbers
    for r in profile.profile(df, ["a", "b"]).collect():
        x = columns(rows)[r.column_name]
        assert (r.n, r.min, r.max) == (len(x), x.min(), x.max())
        assert r.mean == pytest.approx(x.mean())
        assert r.stddev == pytest.approx(np.sqrt(((x - x.mean()) ** 2).sum() / (len(x) - 1)))


@pytest.mark.parametrize("count", [1, 2, 3, 4, 999, 1000, 4000])
def test_median_is_exact(numbers, spark, count):
    rows, _ = numbers
    part = spark.createDataFrame(rows[:count], "a double, b double")
    found = {r.column_name: r.median for r in profile.median(part, ["a", "b"]).collect()}
    want = {c: np.median(x) if len(x) else None for c, x in columns(rows[:count]).items()}
    assert found == want


def test_median_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "a double")
    assert [tuple(r) for r in profile.median(empty, ["a"]).collect()] == [("a", None)]
    assert [tuple(r) for r in profile.mode(empty, ["a"]).collect()] == [("a", None, 0)]
    assert [tuple(r) for r in profile.arg_max(empty.selectExpr("a", "'x' as l"), "l", ["a"]).collect()] == [("a", None, None)]


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (1.0,), (2.0,), (None,), (None,), (None,)], "a double")
    assert [tuple(r) for r in profile.mode(df, ["a"]).collect()] == [("a", 1.0, 2)]


def test_correlation_against_numpy_and_the_sum_formula(spark):
    draw = np.random.RandomState(5)
    x = draw.randn(500)
    y = 0.3 * x + draw.randn(500)
    df = spark.createDataFrame([(float(p), float(q)) for p, q in zip(x, y)], "x double, y double")
    found = profile.correlation(df, "x", "y").first()["corr"]
    assert found == pytest.approx(np.corrcoef(x, y)[0, 1])
    n = len(x)
    by_sums = ((x * y).sum() - n * x.mean() * y.mean()) / ((n - 1) * x.std(ddof=1) * y.std(ddof=1))
    assert found == pytest.approx(by_sums)


def test_correlation_skips_rows_with_a_null(spark):
    rows = [(1.0, 2.0), (2.0, 3.9), (3.0, 6.1), (None, 900.0), (-700.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    want = np.corrcoef([1, 2, 3], [2, 3.9, 6.1])[0, 1]
    found = profile.correlation(df, "x", "y").first()
    assert (found["n"], found["corr"]) == (3, pytest.approx(want))


def test_modes_above_two_to_the_53(spark):
    df = spark.createDataFrame([(2**60 + 1,), (2**60 + 1,), (2**60,)], "a bigint")
    assert int(profile.mode(df, ["a"], "decimal(38,0)").first()["mode"]) == 2**60 + 1
    two = spark.createDataFrame([(2**60 + 1, "x"), (2**60, "y")], "a bigint, l string")
    assert profile.arg_max(two, "l", ["a"]).first()["label"] == "x"


def test_correlation_with_a_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert profile.correlation(df, "x", "y").first()["corr"] is None


def test_arg_max_takes_the_largest_label_on_a_tie(spark):
    df = spark.createDataFrame([("a", 9.0, 1.0), ("c", 9.0, 0.0), ("b", 1.0, None)], "l string, x double, y double")
    found = {r.column_name: (r.label, r.value) for r in profile.arg_max(df, "l", ["x", "y"]).collect()}
    assert found == {"x": ("c", 9.0), "y": ("a", 1.0)}


def test_statistics_from_stored_counts(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (2.0, None), (9.0, None)], "a double, b double").withColumn("c", F.lit(None).cast("double"))
    counts = profile.value_counts(df, ["a", "b", "c"])
    for one, other in ((profile.median(df, ["a", "b", "c"], counts), profile.median(df, ["a", "b", "c"])),
                       (profile.mode(df, ["a", "b", "c"], counts=counts), profile.mode(df, ["a", "b", "c"]))):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert {r.column_name: r.median for r in profile.median(df, ["a", "b", "c"], counts).collect()} == {"a": 2.0, "b": 5.0, "c": None}
    nothing = df.limit(0)
    assert profile.median(nothing, ["a"], profile.value_counts(nothing, ["a"])).first()["median"] is None
