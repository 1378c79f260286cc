from pyspark.sql import functions as F

from tablework.operators import frequency, series


def test_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), (["a", "c"],), ([],), (None,)], "t array<string>")
    counts = frequency.word_counts(df, "t")
    assert [tuple(r) for r in frequency.top(counts, "word", 2).collect()] == [("a", 2), ("b", 2)]


def test_top_per_group_with_small_and_null_groups(spark):
    rows = [("x", ["one"]), (None, ["two", "two", "one"]), ("y", [f"w{i % 7}" for i in range(50)])]
    counts = frequency.word_counts(spark.createDataFrame(rows, "g string, t array<string>"), "t", "g")
    found = frequency.top_per_group(counts, "g", "word", 3).collect()
    assert {(r.g, r["rank"], r.word, r.n) for r in found} == {
        ("x", 1, "one", 1),
        (None, 1, "two", 2),
        (None, 2, "one", 1),
        ("y", 1, "w0", 8),
        ("y", 2, "w1", 7),
        ("y", 3, "w2", 7),
    }
    ranked = frequency.top_per_group(counts.filter("g is not null"), "g", "word", 3)
    assert {r.g for r in frequency.first_groups(ranked, "g", 1).collect()} == {"x"}


def test_top_per_group_cuts_before_the_shuffle(spark):
    counts = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("word"), F.col("id").alias("n"))
    plan = frequency.top_per_group(counts, "g", "word", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_value_counts_and_top_value(spark):
    df = spark.createDataFrame([("t", "http"), ("t", "http"), ("t", "ftp"), ("u", "b"), ("u", "a")], "kind string, service string")
    counts = {(r.column_name, r.value): r.n for r in frequency.value_counts(df, ["kind", "service"]).collect()}
    assert counts == {("kind", "t"): 3, ("kind", "u"): 2, ("service", "http"): 2, ("service", "ftp"): 1, ("service", "a"): 1, ("service", "b"): 1}
    top = frequency.top_value_per_group(df, "kind", "service").collect()
    assert [tuple(r) for r in top] == [("t", "http", 2), ("u", "a", 1)]


def test_sums_skip_missing_scores_and_keep_the_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), (None, 4.0), ("b", None)], "g string, s double")
    found = {r.g: (r.total, r["mean"]) for r in series.sum_and_mean(df, "g", "s").collect()}
    assert found == {"a": (3.0, 1.5), None: (4.0, 4.0), "b": (None, None)}


def test_wide_series_means_beyond_the_int_range(spark):
    names = series.slot_names()
    df = spark.createDataFrame([(7, *[2_000_000_000] * 144)], "id int, " + ", ".join(f"{n} int" for n in names))
    row = series.mean_popularity(df, ["id"]).first()
    assert (row.per_hour, row.per_day) == (144 * 2e9 / 48, 144 * 2e9 / 2)
    short = series.mean_popularity(df, ["id"], names[:6]).first()
    assert (short.per_hour, short.per_day) == (6e9, 12e9 * 12)


def test_widen_fills_empty_slots(spark):
    df = spark.createDataFrame([(1, 2, 5), (1, 2, 1), (1, 3, 4)], "id int, slot int, v int")
    row = series.widen(df, ["id"], "slot", "v", slots=4).first()
    assert tuple(row) == (1, 0, 6, 4, 0)
