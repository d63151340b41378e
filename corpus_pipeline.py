"""Corpus pipeline: language ID, line dedup, near duplicates, decontamination, packing.

``run`` applies STAGES to ``documents``; each stage works on all that the one
before it kept, which is written as Parquet in between. SQL can't express the
stages (a fitted model, SimHash, best fit, tokenizer); tests/llm hold them
against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import _tables as T
from llm._ship import ship
from llm.decontaminate import clean
from llm.jaccard_join import one_of_each
from llm.language_id import accepted
from llm.line_dedup import without_repeated_lines
from llm.packing import pack


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: texts without a letter, or without a language of probability 0.5 or more, go."""
    return accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: repeated chunks of lines go from the texts, and texts of which nothing is left."""
    out = without_repeated_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group of near copies stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one row per piece, with its sequence and place there."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship(spark)
    docs = T.documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = T.store(docs, f"pipeline-{name}")
    return docs
