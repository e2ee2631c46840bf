"""The tables at hand in the roles of a labelled corpus: orders are questions, customers exercises, lineitems labels, parts concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("track"))
    return o.join(c, "o_custkey", "left").select(
        F.col("o_orderkey").alias("question_id"),
        F.col("o_custkey").alias("exercise_id"),
        "track",
        F.when(F.col("o_orderstatus") == "F", "ok").otherwise(F.col("o_orderstatus")).alias("status"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("language"),
    )


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey with its concept and section."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.concat_ws(".", "p_type", "p_brand").alias("concept_id"), F.col("p_type").alias("section_id"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("question_id"), "l_partkey", "l_linestatus")
    c = concepts(spark, sf_dir).select(F.col("p_partkey").alias("l_partkey"), "concept_id", "section_id")
    return l.join(c, "l_partkey").select("question_id", "concept_id", "section_id", F.col("l_partkey").alias("part_id"), F.col("l_linestatus").alias("run"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concepts(spark, sf_dir).select("concept_id", "section_id").distinct()
