"""Jobs on words: frequencies and co-occurrence."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.text import day_of, words
from tablework.jobs.tables import table, with_int
from tablework.operators import bitmaps, cooccur, frequency
from tablework.plans import spread, stage
from tablework.sinks.files import report_rows

WORDS_SQL = """
words AS (SELECT doc_id, lang, unnest(list_filter(regexp_split_to_array(lower(text), '\\W'),
                                                  lambda w: length(w) >= 2)) AS word FROM documents)
"""
TOP_SQL = """
ranked AS (SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank
           FROM (SELECT lang, word, count(*) AS n FROM words GROUP BY ALL) QUALIFY rank <= 100)
"""


def document_words(spark, folder):
    return spread(table(spark, folder, "documents").select("doc_id", "lang", "text")).select(
        "doc_id", "lang", words("text").alias("tokens")
    )


def word_top_total(spark, folder):
    counts = frequency.word_counts(document_words(spark, folder), "tokens")
    return frequency.top(counts, "word", 100)


TOTAL_SQL = f"""
WITH {WORDS_SQL} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 100
"""


def word_top_per_group(spark, folder):
    counts = frequency.word_counts(document_words(spark, folder), "tokens", "lang")
    return frequency.top_per_group(counts, "lang", "word", 100).orderBy("lang", "rank")


PER_GROUP_SQL = f"WITH {WORDS_SQL}, {TOP_SQL} SELECT lang, word, n, rank FROM ranked"


def word_top_per_day(spark, folder):
    days = table(spark, folder, "events").select(
        day_of("ts").alias("day"), words("event_type").alias("tokens")
    )
    counts = frequency.word_counts(days, "tokens", "day")
    return frequency.top_per_group(counts, "day", "word", 100).orderBy("day", "rank")


PER_DAY_SQL = """
SELECT day, word, n, row_number() OVER (PARTITION BY day ORDER BY n DESC, word) AS rank
FROM (SELECT substr(CAST(ts AS VARCHAR), 1, 10) AS day, event_type AS word, count(*) AS n
      FROM events GROUP BY ALL)
"""


def word_top_first_groups(spark, folder):
    """Top ten words of the first two roles of a conversation."""
    turns = table(spark, folder, "conversations").select("role", words("text").alias("tokens"))
    ranked = frequency.top_per_group(
        frequency.word_counts(turns, "tokens", "role"), "role", "word", 10
    )
    return frequency.first_groups(ranked, "role", 2)


FIRST_GROUPS_SQL = """
SELECT role, word, n, row_number() OVER (PARTITION BY role ORDER BY n DESC, word) AS rank
FROM (SELECT role, word, count(*) AS n
      FROM (SELECT role, unnest(list_filter(regexp_split_to_array(lower(text), '\\W'),
                                            lambda w: length(w) >= 2)) AS word FROM conversations)
      WHERE role IN (SELECT DISTINCT role FROM conversations ORDER BY role LIMIT 2)
      GROUP BY ALL)
QUALIFY rank <= 10
"""


def report_sections(spark, folder):
    """Two ranked tables, each with rank, key and value."""
    both = document_words(spark, folder)
    per_lang = frequency.top_per_group(
        frequency.word_counts(both, "tokens", "lang"), "lang", "word", 100
    )
    per_source = frequency.top_per_group(
        frequency.value_counts(table(spark, folder, "documents"), ["source"]),
        "column_name",
        "value",
        100,
    )
    return {
        "words per language": per_lang.withColumn("value", F.concat_ws(" ", "word", "n")).select(
            "rank", F.col("lang").alias("key"), "value"
        ),
        "sources": per_source.select("rank", F.col("value").alias("key"), F.col("n").alias("value")),
    }


def word_report(spark, folder):
    """Two ranked tables as one sectioned report."""
    return report_rows(report_sections(spark, folder), "key", "value")


REPORT_SQL = f"""
WITH {WORDS_SQL}, {TOP_SQL}
SELECT 'words per language' AS section, rank, lang AS key, word || ' ' || n AS value FROM ranked
UNION ALL
SELECT 'sources', row_number() OVER (ORDER BY n DESC, source), source, CAST(n AS VARCHAR)
FROM (SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 100)
"""


def cooccurrence(spark, folder):
    return cooccur.cooccurrence(document_words(spark, folder), "lang", "tokens")


PAIRS_SQL = f"""
{WORDS_SQL}, {TOP_SQL},
present AS (SELECT DISTINCT doc_id, lang, word, rank FROM words JOIN ranked USING (lang, word)),
counts AS (SELECT x.lang, x.rank AS r1, y.rank AS r2, count(*) AS n
           FROM present x JOIN present y ON x.doc_id = y.doc_id GROUP BY ALL),
pairs AS (SELECT a.lang, a.rank AS r1, a.word AS w1, b.rank AS r2, b.word AS w2, coalesce(c.n, 0) AS n
          FROM ranked a JOIN ranked b ON a.lang = b.lang
          LEFT JOIN counts c ON c.lang = a.lang AND c.r1 = a.rank AND c.r2 = b.rank)
"""
COOCCURRENCE_SQL = f"WITH {PAIRS_SQL} SELECT * FROM pairs"


def cooccurrence_all_rows(spark, folder):
    return cooccur.cooccurrence(document_words(spark, folder), "lang", "tokens", all_rows=True)


ALL_ROWS_SQL = f"""
WITH {WORDS_SQL}, {TOP_SQL},
present AS (SELECT DISTINCT doc_id, ranked.lang, ranked.word, rank
            FROM words JOIN ranked ON words.word = ranked.word),
counts AS (SELECT x.lang, x.rank AS r1, y.rank AS r2, count(*) AS n
           FROM present x JOIN present y ON x.doc_id = y.doc_id AND x.lang = y.lang GROUP BY ALL)
SELECT a.lang, a.rank AS r1, a.word AS w1, b.rank AS r2, b.word AS w2, coalesce(c.n, 0) AS n
FROM ranked a JOIN ranked b ON a.lang = b.lang
LEFT JOIN counts c ON c.lang = a.lang AND c.r1 = a.rank AND c.r2 = b.rank
"""


def cooccurrence_matrix(spark, folder):
    return cooccur.as_matrix(cooccurrence(spark, folder), "lang")


MATRIX_SQL = (
    f"WITH {PAIRS_SQL} SELECT lang, r1 AS rank, w1 AS word, "
    + ", ".join(f"max(n) FILTER (r2 = {r}) AS c{r}" for r in range(1, 101))
    + " FROM pairs GROUP BY lang, r1, w1"
)

def cooccurrence_gram(spark, folder):
    """Of each of a language's five thousand top words: its documents, how many words it meets and in how many rows, and the one it meets most."""
    pairs = stage(cooccur.gram(document_words(spark, folder), "lang", "tokens", 5000), "pairs")
    one, other = (
        pairs.select("lang", F.col(f"r{x}").alias("rank"), F.col(f"w{x}").alias("word"), F.col(f"r{y}").alias("other"), "n")
        for x, y in ((1, 2), (2, 1))
    )
    apart = F.col("rank") != F.col("other")
    # the most frequent partner, the first of equals
    most = F.max(F.when(apart, F.struct("n", (-F.col("other")).alias("minus"))))
    return (
        one.unionByName(other.filter(apart))
        .groupBy("lang", "rank", "word")
        .agg(
            F.max(F.when(~apart, F.col("n"))).alias("docs"),
            F.count_if(apart).alias("partners"),
            F.sum(F.when(apart, F.col("n")).otherwise(0)).alias("together"),
            (-most["minus"]).alias("best"),
        )
    )


GRAM_SQL = f"""
WITH {WORDS_SQL}, {TOP_SQL.replace("100", "5000")},
present AS MATERIALIZED (SELECT DISTINCT doc_id, lang, rank FROM words JOIN ranked USING (lang, word)),
counts AS MATERIALIZED (SELECT x.lang, x.rank, y.rank AS other, count(*) AS n FROM present x JOIN present y ON x.doc_id = y.doc_id GROUP BY ALL),
best AS (SELECT lang, rank, arg_max(other, n * 10000 - other) AS best FROM counts WHERE rank <> other GROUP BY ALL),
sums AS (SELECT lang, rank, max(n) FILTER (rank = other) AS docs, count(*) FILTER (rank <> other) AS partners,
                CAST(coalesce(sum(n) FILTER (rank <> other), 0) AS BIGINT) AS together FROM counts GROUP BY ALL)
SELECT lang, rank, word, docs, partners, together, CAST(best AS INTEGER) AS best
FROM sums JOIN ranked USING (lang, rank) LEFT JOIN best USING (lang, rank)
"""


def cooccurrence_bitmaps(spark, folder):
    """Documents of pairs of a language's hundred top words, from bitmaps, and those that hold any of the words (ranks 0)."""
    texts = document_words(spark, folder)
    top = cooccur.vocabulary(texts, "lang", "tokens")
    found = stage(bitmaps.presence_bitmaps(texts, "doc_id", "lang", "tokens", top), "bitmaps")
    some = bitmaps.row_counts(found, ["lang"]).select("lang", F.lit(0).alias("r1"), F.lit(0).alias("r2"), "n")
    return bitmaps.pair_counts(found, "lang").unionByName(some)


BITMAPS_SQL = f"""
WITH {PAIRS_SQL}
SELECT lang, r1, r2, n FROM pairs WHERE r1 <= r2 AND n > 0
UNION ALL SELECT lang, 0, 0, count(DISTINCT doc_id) FROM present GROUP BY lang
"""

QUERIES = {
    "cooccurrence_gram": cooccurrence_gram,
    "cooccurrence_bitmaps": cooccurrence_bitmaps,
    "word_top_total": word_top_total,
    "word_top_per_group": word_top_per_group,
    "word_top_per_day": word_top_per_day,
    "word_top_first_groups": word_top_first_groups,
    "word_report": word_report,
    "cooccurrence": cooccurrence,
    "cooccurrence_all_rows": cooccurrence_all_rows,
    "cooccurrence_matrix": cooccurrence_matrix,
}

SQL = {
    "cooccurrence_gram": with_int(GRAM_SQL, "rank"),
    "cooccurrence_bitmaps": with_int(BITMAPS_SQL, "r1", "r2"),
    "word_top_total": TOTAL_SQL,
    "word_top_per_group": with_int(PER_GROUP_SQL, "rank"),
    "word_top_per_day": with_int(PER_DAY_SQL, "rank"),
    "word_top_first_groups": with_int(FIRST_GROUPS_SQL, "rank"),
    "word_report": with_int(REPORT_SQL, "rank"),
    "cooccurrence": with_int(COOCCURRENCE_SQL, "r1", "r2"),
    "cooccurrence_all_rows": with_int(ALL_ROWS_SQL, "r1", "r2"),
    "cooccurrence_matrix": with_int(MATRIX_SQL, "rank"),
}
