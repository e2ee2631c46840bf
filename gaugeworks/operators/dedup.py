"""Content deduplication, keyed deduplication and upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.text import fingerprint, newlines


def by_content(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """Per document: its fingerprint (after newline translation), the first document with it, and whether that is itself.

    Only (fingerprint, first id) is aggregated and joined back, never texts.
    """
    named = docs.select(order, fingerprint(newlines(F.coalesce(F.col(text), F.lit("")))).alias("fingerprint"))
    first = named.groupBy("fingerprint").agg(F.min(order).alias("first_id"), F.count(F.lit(1)).alias("copies"))
    return named.join(first, "fingerprint").select(order, "fingerprint", "first_id", "copies", (F.col(order) == F.col("first_id")).alias("kept"))


def last_wins(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row of each key in a total order."""
    down = [F.col(o).desc() if isinstance(o, str) else o for o in order]
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*down))
    return rows.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def first_wins(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def upsert(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows replace those of equal key, others stay: an anti join and a union, as plain tables know no MERGE."""
    return existing.join(new.select(*key), list(key), "left_anti").unionByName(new)


def insert_missing(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows whose key is not there yet are added, nothing is replaced."""
    return existing.unionByName(new.join(existing.select(*key), list(key), "left_anti"))
