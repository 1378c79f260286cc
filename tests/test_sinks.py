import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from tablework import sinks
from tablework.operators import cooccur
from tablework.sources import read_delimited, read_lines


def parts(path):
    return [p for p in Path(path).rglob("part-*")]


def test_delimited_modes_and_single_file(spark, tmp_path):
    df = spark.range(100).repartition(4).selectExpr("id", "id * 0.5 as half")
    path = str(tmp_path / "out")
    sinks.write_delimited(df, path)
    assert len(parts(path)) == 4
    with pytest.raises(AnalysisException):
        sinks.write_delimited(df, path)
    sinks.write_delimited(df, path, mode="overwrite", one_file=True)
    assert len(parts(path)) == 1
    assert read_delimited(spark, path).count() == 100


def test_vector_lines(spark, tmp_path):
    df = spark.createDataFrame([([1, 22, 3],)], "sig array<bigint>")
    sinks.write_vectors(df, "sig", str(tmp_path / "v"))
    assert [r.value for r in spark.read.text(str(tmp_path / "v")).collect()] == ["1,22,3"]


def test_popularity_folders(spark, tmp_path):
    df = spark.createDataFrame([("fb", 1, 2.0, 48.0), ("li", 2, 0.5, 12.0)], "platform string, IDLink int, per_hour double, per_day double")
    path = str(tmp_path / "p")
    sinks.write_popularity(df, "platform", "IDLink", path)
    assert (tmp_path / "p" / "platform=fb" / "granularity=day").is_dir()
    rows = read_delimited(spark, path).collect()
    assert {(r.platform, r.granularity, r.IDLink, r.avg_popularity) for r in rows} == {
        ("fb", "hour", "1", "2.0"), ("fb", "day", "1", "48.0"), ("li", "hour", "2", "0.5"), ("li", "day", "2", "12.0"),
    }


def test_report_sections(spark, tmp_path):
    a = spark.createDataFrame([(1, "w", 5)], "rank int, word string, n int")
    b = spark.createDataFrame([(1, "v", 4), (2, "u", 3)], "rank int, word string, n int")
    sinks.write_report({"title": a, "headline": b}, "word", "n", str(tmp_path / "r"))
    rows = read_delimited(spark, str(tmp_path / "r")).collect()
    assert {(r.section, r.rank, r.key, r.value) for r in rows} == {
        ("title", "1", "w", "5"), ("headline", "1", "v", "4"), ("headline", "2", "u", "3"),
    }


def test_matrix_and_adjacency(spark, tmp_path):
    df = spark.createDataFrame([("x", ["a", "b"]), ("x", ["a"])], "g string, t array<string>")
    matrix = cooccur.as_matrix(cooccur.cooccurrence(df, "g", "t", size=2), "g", size=2)
    sinks.write_matrix(matrix, "g", str(tmp_path / "m"))
    rows = read_delimited(spark, str(tmp_path / "m")).orderBy("rank").collect()
    assert [(r.g, r.word, r.c1, r.c2) for r in rows] == [("x", "a", "2", "1"), ("x", "b", "1", "1")]
    lists = spark.createDataFrame([(1, 0, [2, 5])], "a bigint, line int, neighbours array<bigint>")
    sinks.write_adjacency(lists, str(tmp_path / "j"))
    line = [t for p in parts(tmp_path / "j") for t in p.read_text().splitlines()]
    assert [json.loads(t) for t in line] == [{"a": 1, "line": 0, "neighbours": [2, 5]}]


def test_report_text_is_the_concatenation_of_its_files(spark, tmp_path):
    first = spark.createDataFrame([(2, "b", "1"), (1, None, "x\ny"), (1, "a", None), (1, "a", "0")], "rank int, k string, v string")
    many = spark.range(3000).selectExpr("cast(id + 1 as int) as rank", "cast(id as string) as k", "'v' as v").repartition(6)
    path = str(tmp_path / "r")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files from few rows
    try:
        sinks.write_report_text({"title": first, "none": first.filter("rank > 9"), "body": many}, "k", "v", path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = ["[title]", "1\t\tx y", "1\ta\t", "1\ta\t0", "2\tb\t1", "[none]", "[body]"] + [f"{i + 1}\t{i}\tv" for i in range(3000)]
    files = sorted(parts(path))
    assert len(files) > 1
    assert [t for f in files for t in f.read_text().splitlines()] == want
    assert [r.text for r in read_lines(spark, path).orderBy("line").collect()] == want
    assert [r.line for r in read_lines(spark, path).orderBy("line").collect()] == list(range(len(want)))
