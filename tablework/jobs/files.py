"""Jobs through files: write with the sinks, read back with the sources."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablework.functions.text import story_line, words
from tablework.jobs.tables import table, with_int
from tablework.jobs.texts import (
    CORNER_SQL,
    NEIGHBOURS_SQL,
    SIGNATURES_SQL,
    document_signatures,
    lsh_candidates,
    shingle_corner_lines,
)
from tablework.jobs.words import REPORT_SQL, report_sections
from tablework.operators import clean, lsh
from tablework.operators.cooccur import as_matrix, cooccurrence
from tablework.plans import join_lookup, stage
from tablework.plans.staging import scratch_dir
from tablework.sinks import (
    write_adjacency,
    write_delimited,
    write_matrix,
    write_popularity,
    write_report,
    write_report_text,
    write_vectors,
)
from tablework.sources import read_delimited, read_first, read_lines, read_records, read_union


def _folder(spark, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delimited_roundtrip(spark, folder):
    """Orders written as semicolon text, read as text, parsed back."""
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    path = _folder(spark, "orders")
    write_delimited(table(spark, folder, "orders").select(*names), path, sep=";")
    text = read_first(
        lambda p: read_delimited(spark, p, sep=";", names=names, drop_malformed=True),
        [path + "-elsewhere", path],
    )
    return clean.drop_incomplete(
        clean.cast_columns(
            text, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
        )
    )


DELIMITED_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
"""


def _places(records, group):
    """``records`` of files in folders per ``group``, with pos counted over all files of a folder, in order of their names.

    A number per file is all that is put in order; a folder may have any number of files.
    """
    files = records.groupBy("path", group.alias("_group")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("_group").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(files.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    return join_lookup(records, starts, "path").withColumn("pos", F.col("pos") + F.col("start"))


def records_roundtrip(spark, folder):
    """Documents written as marked-up text files, a folder per source, cut back into records.

    The records of a source keep their order, so the position says which document it was.
    A frequent source is several files: ranges of its ids.
    """
    path = _folder(spark, "stories")
    marked = table(spark, folder, "documents").select(
        "source",
        F.concat(F.lit("<TEXT><BODY>"), F.col("text"), F.lit("</BODY></TEXT>")).alias("value"),
        "doc_id",
    )
    ordered = marked.repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id")
    ordered.drop("doc_id").write.partitionBy("source").text(path)
    source = F.regexp_extract("path", "/source=([^/]*)/", 1)
    records = _places(read_records(spark, f"{path}/*/*.txt", encoding="UTF-8"), source)
    return records.select(source.alias("source"), "pos", "text")


RECORDS_SQL = """
SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, text FROM documents
"""


def compressed_records(spark, folder):
    """Documents in gzip files of records, as many as the ranges of ids, cut back as streams."""
    path = _folder(spark, "packed")
    text = F.concat(F.col("doc_id").cast("string"), F.lit("\n"), F.coalesce("text", F.lit("")))
    marked = table(spark, folder, "documents").select("doc_id", F.concat(F.lit("<TEXT><BODY>"), text, F.lit("</BODY></TEXT>")).alias("value"))
    marked.repartitionByRange("doc_id").select("value").write.option("compression", "gzip").text(path)
    found = read_records(spark, f"{path}/*.gz", encoding="UTF-8")
    head = F.instr("text", "\n")
    return found.select(F.substring("text", F.lit(1), head - 1).cast("bigint").alias("doc_id"), F.substring("text", head + 1, F.length("text")).alias("text"))


COMPRESSED_SQL = "SELECT doc_id, coalesce(text, '') AS text FROM documents"


def latin_stories(spark, folder):
    """Documents as ISO-8859-1 story files, with newlines, an end mark and numbered files."""
    path = _folder(spark, "latin")
    # a folder per remainder of the ids, its number in its name, with a file per range of ids
    stories = table(spark, folder, "documents").select(
        F.pmod("doc_id", F.lit(7)).alias("file"),
        "doc_id",
        F.concat(
            F.lit("<BODY>"), F.col("doc_id").cast("string"), F.lit("\n"), F.regexp_replace("text", "[^\\x{00}-\\x{FF}]", "?"),
            F.lit("REUTER &#3;</BODY>"),
        ).alias("value"),
    )
    ordered = stories.repartitionByRange("file", "doc_id").sortWithinPartitions("file", "doc_id").drop("doc_id")
    ordered.write.partitionBy("file").option("encoding", "ISO-8859-1").option("header", False).option("quote", "").option(
        "sep", "\x01"
    ).option("escapeQuotes", False).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    file = F.regexp_extract("path", "/file=([0-9]+)/", 1).cast("bigint")
    records = _places(read_records(spark, f"{path}/file=*/*.csv"), file)
    return records.select(file.alias("file"), "pos", story_line("text").alias("story"))


LATIN_SQL = r"""
SELECT file, row_number() OVER (PARTITION BY file ORDER BY doc_id) - 1 AS pos, replace(story, chr(10), ' ') AS story
FROM (SELECT doc_id % 7 AS file, doc_id, doc_id || chr(10) || regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g') AS story
      FROM documents)
"""


def headerless_malformed(spark, folder):
    """Lines without a header, some with a field too few or too many, which are dropped."""
    path = _folder(spark, "lines")
    fields = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_custkey").cast("string"))
    odd = F.when(F.pmod("o_orderkey", F.lit(5)) == 0, F.concat(fields, F.lit(",more")))
    odd = odd.when(F.pmod("o_orderkey", F.lit(5)) == 1, F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus"))
    table(spark, folder, "orders").select(odd.otherwise(fields).alias("value")).write.text(path)
    return read_delimited(spark, path, header=False, names=["key", "status", "customer"], drop_malformed=True)


HEADERLESS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS customer
FROM orders WHERE o_orderkey % 5 > 1
"""


def union_of_files(spark, folder):
    """The same table in two folders, read as one; equal rows are kept."""
    paths = [_folder(spark, name) for name in ("first", "second")]
    names = ["s_suppkey", "s_name", "s_acctbal"]
    for path in paths:
        write_delimited(table(spark, folder, "supplier").select(*names), path)
        write_delimited(table(spark, folder, "supplier").select(*names), path, mode="overwrite", one_file=True)
    text = read_union(lambda p: read_delimited(spark, p), paths)
    return clean.cast_columns(text, {"s_suppkey": "bigint", "s_acctbal": "double"})


UNION_FILES_SQL = """
SELECT s_suppkey, s_name, s_acctbal FROM supplier UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
"""


def popularity_files(spark, folder):
    """Mean popularity per user and event type, written by type and granularity and read back."""
    path = _folder(spark, "popularity")
    counts = table(spark, folder, "events").groupBy("event_type", "user_id").agg(
        (F.count("*") / 48).alias("per_hour"), (F.count("*") / 2).alias("per_day")
    )
    write_popularity(counts, "event_type", "user_id", path)
    back = spark.read.option("header", True).csv(path)
    return back.select(
        "event_type", "granularity", F.col("user_id").cast("bigint").alias("user_id"), F.col("avg_popularity").cast("double").alias("avg_popularity")
    )


POPULARITY_SQL = """
SELECT event_type, granularity, user_id, n / CASE granularity WHEN 'hour' THEN 48 ELSE 2 END AS avg_popularity
FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL), (VALUES ('hour'), ('day')) AS g(granularity)
"""


def report_files(spark, folder):
    """The word report, written in sections and read back."""
    path = _folder(spark, "report")
    write_report(report_sections(spark, folder), "key", "value", path)
    back = spark.read.option("header", True).csv(path)
    return back.select("section", F.col("rank").cast("int").alias("rank"), "key", "value")


def report_text(spark, folder):
    """The word report as one ordered text, written and read back as numbered lines."""
    path = _folder(spark, "report_text")
    write_report_text(report_sections(spark, folder), "key", "value", path)
    return read_lines(spark, path)


REPORT_TEXT_SQL = f"""
WITH r AS ({REPORT_SQL}),
every AS (SELECT CASE section WHEN 'sources' THEN 1 ELSE 0 END AS s, rank, key, value, rank || chr(9) || key || chr(9) || value AS text FROM r
          UNION ALL SELECT 0, 0, '', '', '[words per language]' UNION ALL SELECT 1, 0, '', '', '[sources]')
SELECT row_number() OVER (ORDER BY s, rank, key, value) - 1 AS line, text FROM every
"""


def corner_file(spark, folder):
    """The corner of the shingle matrix, written to one file and read back."""
    path = _folder(spark, "corner")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    write_delimited(shingle_corner_lines(spark, folder), path, one_file=True, **keep)
    back = spark.read.options(header=True, **keep).csv(path)
    ones = F.array_join(F.array(*[f"d{i}" for i in range(100)]), "")
    return back.select(F.col("idx").cast("int").alias("idx"), "shingle", ones.alias("ones"))


CORNER_FILE_SQL = (
    "SELECT CAST(idx AS INTEGER) AS idx, shingle, string_agg(CAST(present AS VARCHAR), '' ORDER BY col) AS ones "
    f"FROM ({CORNER_SQL}) GROUP BY idx, shingle"
)


def adjacency_files(spark, folder):
    """Neighbour lists written as JSON lines and read back."""
    path = _folder(spark, "adjacency")
    lists = lsh.neighbour_lists(stage(lsh_candidates(spark, folder), "pairs"))
    write_adjacency(lists, path)
    back = spark.read.schema("a bigint, line int, neighbours array<bigint>").json(path)
    return back.select("a", "line", F.array_join(F.col("neighbours").cast("array<string>"), ",").alias("neighbours"))


def matrix_files(spark, folder):
    """Word matrices written in a folder per language, read back as their sums per row."""
    path = _folder(spark, "matrix")
    tokens = table(spark, folder, "documents").select("lang", words("text").alias("tokens"))
    write_matrix(as_matrix(cooccurrence(tokens, "lang", "tokens", 10), "lang", 10), "lang", path)
    back = spark.read.option("header", True).csv(path)
    cells = F.array(*[F.col(f"c{i}").cast("bigint") for i in range(1, 11)])
    return back.select("lang", F.col("rank").cast("int").alias("rank"), "word", F.array_join(cells.cast("array<string>"), ",").alias("cells"))


MATRIX_SQL = r"""
WITH t AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '\w{2,}') AS w FROM documents),
n AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM t) GROUP BY ALL),
v AS (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM n QUALIFY r <= 10),
p AS (SELECT DISTINCT doc_id, lang, word, r FROM (SELECT doc_id, lang, unnest(w) AS word FROM t) JOIN v USING (lang, word)),
c AS (SELECT x.lang, x.r AS r1, y.r AS r2, count(*) AS n FROM p x JOIN p y ON x.doc_id = y.doc_id GROUP BY ALL)
SELECT a.lang, CAST(a.r AS INTEGER) AS rank, a.word, string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY b.r) AS cells
FROM v a JOIN v b USING (lang) LEFT JOIN c ON c.lang = a.lang AND r1 = a.r AND r2 = b.r GROUP BY a.lang, a.r, a.word
"""


def signature_lines(spark, folder):
    """Signatures written as comma-joined lines, the document's id first, read back."""
    path = _folder(spark, "signatures")
    with_id = document_signatures(spark, folder).select(F.concat(F.array("doc_id"), "sig").alias("line"))
    write_vectors(with_id, "line", path)
    cells = spark.read.text(path).select(F.split("value", ",").cast("array<bigint>").alias("cells"))
    return cells.select(F.col("cells")[0].alias("doc_id"), F.array_join(F.slice("cells", 2, 1000).cast("array<string>"), ",").alias("sig"))


LINES_SQL = f"""
WITH {SIGNATURES_SQL} SELECT doc_id, array_to_string(sig, ',') AS sig FROM signatures
"""


QUERIES = {
    "delimited_roundtrip": delimited_roundtrip,
    "records_roundtrip": records_roundtrip,
    "compressed_records": compressed_records,
    "latin_stories": latin_stories,
    "headerless_malformed": headerless_malformed,
    "union_of_files": union_of_files,
    "popularity_files": popularity_files,
    "report_files": report_files,
    "report_text": report_text,
    "corner_file": corner_file,
    "adjacency_files": adjacency_files,
    "matrix_files": matrix_files,
    "signature_lines": signature_lines,
}

SQL = {
    "delimited_roundtrip": DELIMITED_SQL,
    "records_roundtrip": RECORDS_SQL,
    "compressed_records": COMPRESSED_SQL,
    "latin_stories": LATIN_SQL,
    "headerless_malformed": HEADERLESS_SQL,
    "union_of_files": UNION_FILES_SQL,
    "popularity_files": POPULARITY_SQL,
    "report_files": with_int(REPORT_SQL, "rank"),
    "report_text": REPORT_TEXT_SQL,
    "corner_file": CORNER_FILE_SQL,
    "adjacency_files": NEIGHBOURS_SQL,
    "matrix_files": MATRIX_SQL,
    "signature_lines": LINES_SQL,
}
