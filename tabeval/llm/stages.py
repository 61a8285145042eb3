"""The stages of the pipeline: each applies one operator to all documents its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabeval.llm import decontam, langid, neardup, pieces, pii

PIECES_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
PII_KEY = "tabeval-surrogates"  # a deployment passes a secret of its own
LEAST_SIMILARITY = 0.01  # to the nearest landmark; below it a text is in no learned language


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that share hardly an n-gram with any learned language, go."""
    found = langid.identify_languages(docs, carry=True)
    return found.where((F.col("lang_pred") != "und") & (F.col("similarity") >= LEAST_SIMILARITY)).select("row.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    gone = neardup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontam.contaminated(docs, benchmark, carry=True).where("not contaminated").select("row.*")


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in ``text`` becomes surrogates; n_chars follows the new text."""
    done = pii.pseudonymise(docs, PII_KEY)
    changed = F.when(F.col("n_entities") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", changed).select(docs.columns)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' ids, with the number of tokens and whether decoding gives the text back."""
    done = pieces.encode(docs, PIECES_MODEL)
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")
