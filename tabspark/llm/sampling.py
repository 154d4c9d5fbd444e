"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Times the wanted rows of a label that are sent for the choice.
SPARE = 2


def labelled(docs: DataFrame, labels: DataFrame, label: str, texts: int, key: str = "doc_id") -> DataFrame:
    """(h, text, label): at most ``texts`` documents of each label 0 and 1, distinct texts.

    The ids with the smallest hashes are chosen from ``labels`` alone, at most ``texts`` of
    each label, and sent to the documents, so no text moves but those of the sample. Hashes above a
    bound that leaves about ``SPARE`` times the wanted ids are not sent for the choice, so a task
    sees that many of a label and not all. An id or a text with both labels counts as 1. Null ids,
    texts and labels teach nothing.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(
        F.max(label).cast("int").alias("label")).withColumn("h", F.xxhash64("key"))
    many = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bound = F.lit(None).cast("bigint")
    for value, n in many.items():
        most = min(2**63 - 1, int(2**64 * min(1.0, SPARE * texts / n)) - 2**63)
        bound = F.when(F.col("label") == value, F.lit(most)).otherwise(bound)
    first = Window.partitionBy("label").orderBy("h", "key")
    chosen = known.filter(F.col("h") <= bound).withColumn("place", F.row_number().over(first)).filter(F.col("place") <= texts)
    found = docs.filter(F.col("text").isNotNull()).select(F.col(key).alias("key"), "text").join(F.broadcast(chosen.select("key", "label")), "key")
    return found.groupBy(F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"), F.max("label").alias("label"))
