"""From documents to token ids: five stages, each working on all that the one before it kept.

Stages take (spark, docs, sf_dir). All but the last return the columns of documents; texts change in the line
stage (and n_chars with them), rows go in the others. Every stage takes null ids, null, empty and very long texts,
repeated rows and ids, columns of any other name (which it ignores) and tables without rows, which give a result
without rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import decontaminate, jaccard_dedup, line_dedup, quality_gam, sentencepiece_codec
from touchline.llm.common import one_per_id, shared_folder, table, written
from touchline.llm.queries import PIECE_MODEL

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts.

    Rows are judged one by one, repeated ones alike; a null text counts as an empty one. Without labels all have one score.
    """
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_gam.score_rows(docs.select(*COLUMNS), model)
    return scored.filter(F.col("_score") >= quality_gam.THRESHOLD).drop("_score")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; none goes.

    A null text stays null (and its n_chars), an empty one empty. Rows of one id, and of none, stay apart and count one by one.
    """
    clean = line_dedup.dedup_rows(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.char_length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the least id: five-word shingles, similarity 0.8 or more.

    Null texts are empty, and texts without words are copies of each other. Of several rows of one id the one with the
    greatest values counts; a null id is the least.
    """
    docs = one_per_id(docs, *COLUMNS)
    number = F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))
    first = jaccard_dedup.least_of_groups(docs.select(number.alias("id"), "text"))
    return docs.join(first, number == F.col("id"), "left_semi").select(*COLUMNS)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word that is hit by a benchmark window.

    Rows are judged by their text alone; null and empty texts stay, and without a benchmark all do.
    """
    return decontaminate.clean_rows(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of the text that they decode to.

    Null and empty texts have no ids. Of several rows of one id the one with the greatest text counts; a null id is kept.
    """
    return sentencepiece_codec.round_trip(docs, public_tokenizers.path(PIECE_MODEL))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark_free", benchmark_free),
    ("pieces", pieces),
]

# MinHash keys, a trained model and a lattice search are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage keeps is written to the shared folder and read by the next."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
