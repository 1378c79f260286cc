from tablework.operators import clean


def test_sum_of_text_columns_and_missing_parts(spark):
    df = spark.createDataFrame([("1.5", "2"), ("x", "2"), (None, "1")], "a string, b string")
    assert [r.s for r in clean.add_sum(df, "a", "b", "s").collect()] == [3.5, None, None]


def test_normalised_values_lie_between_zero_and_one(spark):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(-3, 8)], "x double, same double")
    rows = clean.normalise(df, ["x", "same"]).collect()
    assert [r.norm_x for r in rows] == [i / 10 for i in range(11)]
    assert {r.norm_same for r in rows} == {None}


def test_normalise_scans_without_join_or_shuffle_of_rows(spark):
    df = spark.range(10).selectExpr("cast(id as double) as x")
    plan = clean.normalise(df, ["x"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_rename_stack_and_sample(spark):
    df = spark.range(1000).toDF("id")
    assert clean.rename_by_position(df, ["key"]).columns == ["key"]
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("x", 1)], "v string, k int")
    assert [tuple(r) for r in clean.stack_tables([a, b]).collect()] == [(1, "x")] * 2
    first = clean.sample_rows(df, df.columns[0], 0.1, 42).collect()
    assert sorted(first) == sorted(clean.sample_rows(df.repartition(5), df.columns[0], 0.1, 42).collect())
    assert 50 < len(first) < 200
    assert len({r.id for r in first}) == len(first)
