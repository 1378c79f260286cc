"""The corpus pipeline: language, repeated lines, near duplicates, benchmark passages, pieces.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. Null texts and texts without a letter go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.decontaminate import contamination, is_contaminated
from tablework.llm.keys import one_of_each, without
from tablework.llm.language import fit_languages, identify
from tablework.llm.linededup import dedup_lines
from tablework.llm.minhash import near_duplicates
from tablework.llm.pieces import read_model, tokenize
from tablework.plans import StagedTables, stage

#: A document goes if its languages explain less than this share of it.
LEAST_KNOWN = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the languages of the labels: not ``und``, and not mostly background."""
    found = identify(docs, fit_languages(docs))
    return found.filter((F.col("lang_pred") != "und") & (F.col("known") >= LEAST_KNOWN)).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that came before (n_chars follows); a document that has none left but blank ones goes."""
    found = dedup_lines(docs, exact_chars=1).filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"(?U)\S"))
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8): that with the smallest id."""
    found = near_duplicates(docs)
    rows = stage(
        found.groupBy("doc_id", "text_hash").agg(
            F.count("*").alias("rows"), F.count(F.when(F.col("chosen"), 1)).alias("chosen")
        ).filter("chosen < rows"),
        "copies",
    )
    return one_of_each(without(docs, rows.filter("chosen = 0")), rows.filter("chosen > 0"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words lie in passages of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(docs, items).filter(is_contaminated())
    return without(docs, stage(found.select("doc_id", "text_hash").distinct(), "contaminated"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_pieces, pieces, and whether they give the text back."""
    found = tokenize(docs, read_model())
    return found.select(
        "doc_id", "lang", "source", "n_chars", "n_pieces", "pieces", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip")
    )


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicate),
    ("decontaminate", decontaminate),
    ("pieces", pieces),
]

#: Language mixtures, edit distances over all lines and pieces are not for SQL; the tests
#: compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Once a stage is written, what it was made from is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with StagedTables(spark) as tables:
        for name, step in STAGES:
            docs = stage(step(spark, docs, sf_dir), name)
            tables.drop(but=docs)
    return docs
