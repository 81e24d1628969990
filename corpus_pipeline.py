"""Documents to packed training sequences, stage by stage.

Each stage gets the documents that its predecessor kept, written as Parquet and read again. The last
stage returns the packing plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm import best_fit, language, line_dedup, near_dedup, secrets
from betaloom.tables import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: A score below this is hardly better than a guess between four languages.
LEAST_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter and those of no recognisable language go; ``lang`` becomes the language found."""
    found = language.identify(docs)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages seen before go; documents of which nothing is left go too."""
    done = line_dedup.without_passages(line_dedup.deduplicated(docs))
    return counted(done.where((F.col("n_removed") + F.col("n_cut") == 0) | F.col("text").rlike(r"(?U)\S")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the one of the least id, nulls last, and of rows that share it the first written.

    Rows are known by a key of their own, written before they are grouped, so that repeated rows and null ids are told apart.
    """
    rows = materialize(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row_key")), "keyed")
    found = near_dedup.groups(rows.select(F.col("row_key").alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    named = rows.select("row_key", "doc_id").join(found, F.col("row_key") == F.col("key"))
    kept = named.groupBy("component_id").agg(F.min(place).alias("first")).select(F.col("first.row_key").alias("row_key"))
    return rows.join(kept, "row_key", "left_semi").select(*COLUMNS)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found gives way to a mark; no document goes."""
    return counted(secrets.redacted(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit.pack(docs)


def counted(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("doc_id", "text", "lang", "source", "cast(char_length(text) AS long) AS n_chars")


STAGES = [
    ("language_id", known_language),
    ("line_dedup", repeated_lines),
    ("minhash_near_dedup", near_duplicates),
    ("secret_scans", secret_spans),
    ("best_fit_packing", packing),
]

#: Classification, tokenisation and similarity aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
