import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablework.jobs import files
from tablework.operators import clean
from tablework.sources import read_delimited, read_first, read_records, read_union


def test_semicolon_file_is_text_and_bad_numbers_become_null(spark, tmp_path):
    (tmp_path / "power.txt").write_text("Date;Power;Volt\n1/1;1.5;230\n2/1;?;231\n3/1;2.5;\n")
    df = read_delimited(spark, str(tmp_path / "power.txt"), sep=";")
    assert {t for _, t in df.dtypes} == {"string"}
    numbers = clean.cast_columns(df.drop("Date"), {"power": "double", "volt": "double"})
    assert [tuple(r) for r in numbers.collect()] == [(1.5, 230.0), (None, 231.0), (2.5, None)]
    assert [tuple(r) for r in clean.drop_incomplete(numbers).collect()] == [(1.5, 230.0)]


def test_rows_with_a_wrong_number_of_fields_are_dropped_for_every_action(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,2\n3\n4,5,6\n"x, y",bad\n')
    df = read_delimited(spark, str(tmp_path / "a.csv"), drop_malformed=True)
    assert df.count() == len(df.collect()) == df.select("a").count() == 2
    # a field that is no number is not malformed
    assert {r.b for r in df.collect()} == {"2", "bad"}


def test_doubled_quotes_with_the_escape_option(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n"x ""q"" y",1\n')
    df = read_delimited(spark, str(tmp_path / "q.csv"), escape='"')
    assert df.first().a == 'x "q" y'


def test_headerless_file_gets_names_by_position(spark, tmp_path):
    (tmp_path / "c.data").write_text("0,tcp,a\n1,udp,b\n")
    path = str(tmp_path / "c.data")
    df = read_delimited(spark, path, header=False, names=["duration", "protocol", "label"])
    assert df.columns == ["duration", "protocol", "label"]
    assert df.count() == 2


def test_first_existing_path_is_read(spark, tmp_path):
    (tmp_path / "b.csv").write_text("a\n1\n")
    there, missing = str(tmp_path / "b.csv"), str(tmp_path / "nowhere.csv")
    read = lambda p: read_delimited(spark, p)
    assert read_first(read, [missing, there]).count() == 1
    with pytest.raises(AnalysisException):
        read_first(read, [missing, missing])


def test_union_keeps_equal_rows(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / f"{name}.csv").write_text("id,v\n1,2\n")
    df = read_union(lambda p: read_delimited(spark, p), [str(tmp_path / f"{n}.csv") for n in "xy"])
    assert [tuple(r) for r in df.collect()] == [("1", "2")] * 2


def make_stories(folder):
    """Two story files; returns what has to be found as {doc_id: text}."""
    want = {}
    for file_no, count in ((0, 40), (3, 7)):
        parts = ["<HEAD>x</HEAD>\n"]
        for pos in range(count):
            text = f"caf\xe9 {file_no} {pos}\n" + "word " * pos + "REUTER &#3;"
            want[file_no * 10000 + pos] = text
            parts.append(f"<ID {pos}><BODY>{text}</BODY></ID>\n")
            if pos % 5 == 0:
                parts.append("<ID>no body here</ID>\n")
        parts.append("<BODY>never closed" if file_no == 0 else "end\n")
        (folder / f"news-{file_no:03d}.sgm").write_bytes("".join(parts).encode("iso-8859-1"))
    return want


@pytest.mark.parametrize("split_bytes", [None, 700])
def test_records_between_markers(spark, tmp_path, split_bytes):
    want = make_stories(tmp_path)
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    try:
        if split_bytes:
            spark.conf.set(conf, split_bytes)
        rows = read_records(spark, str(tmp_path / "news-*.sgm"), stride=10000).collect()
    finally:
        spark.conf.set(conf, before)
    assert {r.doc_id: r.text for r in rows} == want
    assert len(rows) == len(want)
    assert {(r.file_no, r.pos) for r in rows} == {divmod(i, 10000) for i in want}


def test_file_ending_with_the_marker_keeps_its_last_record(spark, tmp_path):
    (tmp_path / "n-1.sgm").write_text("<BODY>one</BODY><BODY>two</BODY>")
    (tmp_path / "n-2.sgm").write_text("no marker at all")
    rows = read_records(spark, str(tmp_path / "n-*.sgm"), stride=10).collect()
    assert {(r.file_no, r.pos, r.text) for r in rows} == {(1, 0, "one"), (1, 1, "two")}


def test_files_with_equal_numbers(spark, tmp_path):
    for name in ("a-7.sgm", "b-7.sgm"):
        (tmp_path / name).write_text("<BODY>one</BODY><BODY>two</BODY>")
    rows = read_records(spark, str(tmp_path)).collect()
    assert len({(r.path, r.pos) for r in rows}) == len(rows) == 4
    with pytest.raises(Exception, match="other files have the number"):
        read_records(spark, str(tmp_path), stride=100).collect()
    with pytest.raises(Exception, match="more records than the stride"):
        read_records(spark, str(tmp_path / "a-7.sgm"), stride=1).collect()


def test_compressed_files_hold_the_records_of_the_plain_ones(spark, tmp_path):
    plain, packed = tmp_path / "plain", tmp_path / "packed"
    plain.mkdir(), packed.mkdir()
    want = make_stories(plain)
    more = {"news-004": "<BODY>one</BODY><BODY>two</BODY>", "news-005": "no marker at all", "news-006": "<BODY>a</BODY>x<BODY>", "news-007": "<BODY>a</BODY>\n", "news-008": ""}
    for name, text in more.items():
        (plain / f"{name}.sgm").write_text(text)
    for file in plain.iterdir():
        with gzip.open(packed / f"{file.name}.gz", "wb") as out:
            out.write(file.read_bytes())
    read = [{(r.path.rpartition("/")[2].removesuffix(".gz"), r.pos): r.text for r in read_records(spark, str(p)).collect()} for p in (plain, packed)]
    assert read[0] == read[1] and len(read[0]) == len(want) + 4
    both = read_records(spark, [str(plain), str(packed)]).collect()
    assert len(both) == 2 * len(read[0])


def test_places_count_over_the_files_of_a_folder(spark):
    rows = [(f"/g={g}/part-{file}", pos) for g in "ab" for file in range(4) for pos in range(file * 3 + (g == "a"))]
    df = spark.createDataFrame(rows, "path string, pos int").repartition(3)
    got = sorted(tuple(r) for r in files._places(df, F.substring("path", 4, 1)).select("path", "pos").collect())
    want = [(path, sum(p[:4] == path[:4] for p, _ in rows[:i])) for i, (path, _) in enumerate(rows)]
    assert got == sorted(want)
    assert files._places(df.limit(0), F.substring("path", 4, 1)).collect() == []
