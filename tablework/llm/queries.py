"""The numbered queries: each operator on its whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.decontaminate import contamination, is_contaminated
from tablework.llm.divergence import divergences
from tablework.llm.language import fit_languages, identify
from tablework.llm.linededup import dedup_lines
from tablework.llm.mih import nearest
from tablework.llm.minhash import near_duplicates
from tablework.llm.packing import shard
from tablework.llm.personal import KINDS, as_text, find_personal
from tablework.llm.pieces import read_model, tokenize
from tablework.llm.ppm import score_texts
from tablework.llm.quality import fit_quality, score_quality
from tablework.llm.survival import audit, survivors
from tablework.llm.warc import read_warc, scratch_folder, write_warc

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(modulus: int, remainder: int):
    """Whether the crc32 of the doc_id as text leaves ``remainder``; null ids are in no fold."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus == remainder


def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = score_texts(docs.select("doc_id", "text", (~fold(7, 2)).alias("learn")))
    # null ids are in no fold: not learned from, and not held out
    return found.withColumn("held_out", F.col("held_out") & F.col("doc_id").isNotNull())


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = fit_languages(docs.filter(~fold(5, 0)))
    held_out = F.coalesce(fold(5, 0), F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", held_out, "text"), model).drop("text")


def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def shards(spark: SparkSession, folder: str) -> DataFrame:
    found = shard(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def archives(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_folder(spark)
    write_warc(_table(spark, folder, "pages"), target)
    found = read_warc(spark, target, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ARCHIVES_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages
), d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest FROM p
), k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM k
"""


def quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = fit_quality(docs.filter(~fold(3, 1)), _table(spark, folder, "labels"))
    held_out = F.coalesce(fold(3, 1), F.lit(False)).alias("held_out")
    return score_quality(docs.select("doc_id", held_out, "text"), model).drop("text")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return dedup_lines(docs.select("doc_id", "text"))


def near_dups(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(_table(spark, folder, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = tokenize(docs, read_model())
    return found.select(
        "doc_id",
        "n_pieces",
        "pieces",
        F.sha2(F.concat_ws(",", F.col("pieces").cast("array<string>")), 256).alias("pieces_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


NEAR_DUPS_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), rarity AS (SELECT s, count(*) AS f FROM shingles GROUP BY s
), ranked AS (
  SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS r
  FROM shingles JOIN rarity USING (s) JOIN sizes USING (doc_id)
), prefix AS (SELECT doc_id, s, n FROM ranked WHERE r <= n - ceil(0.8 * n) + 1
), pairs AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS n, y.n AS m
  FROM prefix x JOIN prefix y ON x.s = y.s AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
), links AS (
  SELECT a, b FROM pairs JOIN shingles p ON p.doc_id = a JOIN shingles q ON q.doc_id = b AND q.s = p.s
  GROUP BY a, b, n, m HAVING 100 * count(*) >= 80 * (n + m - count(*))
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
), least_id AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_id LEFT JOIN sizes USING (doc_id)
"""


def decontaminated(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


_WORDS = f"""regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

DECONTAMINATED_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents
), items AS (SELECT item_id, w FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS s, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items)
), starts AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (SELECT doc_id, item_id, i, n FROM starts JOIN windows USING (n, s)
), hit AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal(_table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))


def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(survivors(_table(spark, folder, "documents"), _table(spark, folder, "labels")))


FILTER_AUDIT_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), known AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id
), marked AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(w) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY sha256(t)) THEN 16 ELSE 0 END) AS failed
  FROM docs LEFT JOIN known USING (doc_id)
), counts AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM marked GROUP BY ALL
), orders AS (
  SELECT a || b || c || d || e AS o FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) s1(a), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) s2(b),
    (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) s3(c), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) s4(d), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) s5(e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5
), steps AS (
  SELECT o, step, 1 << (ascii(o[step]) - 65) AS own, list_sum([1 << (ascii(x) - 65) FOR x IN string_split(o[1:step - 1], '') IF x <> ''])::INT AS earlier
  FROM orders, range(1, 6) r(step)
), tallied AS (
  SELECT part, o AS filter_order, step, own,
    coalesce(sum(n) FILTER ((failed & (coalesce(earlier, 0) | own)) = 0), 0) AS kept,
    coalesce(sum(n) FILTER ((failed & coalesce(earlier, 0)) = 0 AND (failed & own) > 0), 0) AS removed,
    coalesce(sum(n) FILTER ((failed & coalesce(earlier, 0)) > 0 AND (failed & own) > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (failed = own), 0) AS unique_fails,
    coalesce(sum(g) FILTER ((failed & coalesce(earlier, 0)) = 0 AND (failed & own) > 0), 0) AS good_lost,
    coalesce(sum(x) FILTER ((failed & coalesce(earlier, 0)) = 0 AND (failed & own) > 0), 0) AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM tallied
"""


def source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergences(_table(spark, folder, "documents").select("text", "lang", "source"))


SOURCE_DIVERGENCE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), kept AS (
  SELECT lang, term, count(*) AS n FROM docs GROUP BY ALL HAVING count(DISTINCT rid) >= 10
), sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY ALL
), g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), counts AS (SELECT lang, source, term, count(*) AS n FROM docs SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
), p AS (
  SELECT lang, g.source, term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * v) AS p,
    1 + 1000000000::HUGEINT * (kept.n + 2) // (sizes.total + 2 * v) AS q
  FROM g JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN totals t USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10
"""

QUERIES = {"op1_ppm_scores": lm_scores, "op4_language_mixture": languages, "op2_warc": archives, "op3_vector_bin_packing": shards, "op5_multi_index_hashing": neighbours, "op6_quality_nbsvm": quality, "op7_line_dedup": lines, "op8_benchmark_decontamination": decontaminated, "op9_minhash_near_dedup": near_dups, "op10_sentencepiece": pieces, "op11_personal_data": personal_data, "op12_filter_audit": filter_audit, "op13_source_divergence": source_divergence}
SQL = {"op2_warc": ARCHIVES_SQL, "op8_benchmark_decontamination": DECONTAMINATED_SQL, "op9_minhash_near_dedup": NEAR_DUPS_SQL, "op12_filter_audit": FILTER_AUDIT_SQL, "op13_source_divergence": SOURCE_DIVERGENCE_SQL}
