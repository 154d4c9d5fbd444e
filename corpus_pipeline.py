"""From documents to training windows: quality, language, boilerplate lines, near copies, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.llm import language, lines, minhash, packing, quality
from tabspark.llm.scratch import cut
from tabspark.sources.io import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the compression bands keep."""
    limits = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(quality.rules(F.col("text"), limits)["kept"])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear, with the language that was found."""
    own = [F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(docs.columns)]
    found = docs.select(*own, language.identify(docs, language.fit(docs)).alias("found"))
    found = found.filter(~language.rejected(F.col("found")))
    return found.select(*(F.col("found.lang" if c == "lang" else f"d{i}").alias(c) for i, c in enumerate(docs.columns)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; n_chars follows the text."""
    done = lines.drop_lines(docs, dropped=None)
    return done.select(*(F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return minhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document and the bin that holds it."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Compression, signatures and best fit have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
