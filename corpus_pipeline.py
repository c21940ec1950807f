"""The training-data pipeline: identified, deduplicated, decontaminated and packed documents."""

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pairloom
from pairloom.llm.common import table
from pairloom.llm.decontaminate import remove_leaked
from pairloom.llm.language import keep_identified
from pairloom.llm.line_dedup import dedup_lines
from pairloom.llm.near_dedup import keep_one_of_each
from pairloom.llm.packing import pack
from pairloom.llm.tokens import tokenizer_file
from pairloom.sources.storage import materialize

# Functions for Python workers travel by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(pairloom)

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is known with some certainty stay."""
    return keep_identified(docs).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and with them the documents of which nothing else is left.

    ``n_chars`` is that of the remaining text.
    """
    cleaned = dedup_lines(docs)
    left = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", chars).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return keep_one_of_each(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return remove_leaked(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences."""
    return pack(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Language identification learns a model, near duplicates and packing hash and tokenize: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each one's result is written before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
