"""Labelling runs as questions and labels, ready for the measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.text import kind_of, year_text
from gaugeworks.operators.measures import ranked_id, share

# Kinds of papers, the first part of a file name that fits wins.
KINDS = (("TPAlgo", "TPAlgo"), ("InfoU-exercices", "InfoU-exercices"), ("LCR", "LCR"), ("Info-rapport", "Info-rapport"), ("InfoA", "InfoA"), ("InfoC", "InfoC"), ("InfoF", "InfoF"))
OTHER = "autre"


def flatten(run: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(questions, labels) of runs as readers.runs gives them.

    Exercises that share an id stay apart as id, id~2, ... in order of appearance over all runs given: by run, then by the place
    `at` of the row (any type that can be ordered). A question's
    id is its exercise's with its ordinal. Attributes of the exercise travel with its questions, so there is no join.
    """
    nth = F.row_number().over(W.partitionBy("exercise_id").orderBy("run", "at"))
    e = run.withColumn("exercise_id", ranked_id(F.col("exercise_id"), nth))
    q = e.select("exercise_id", "file", "track", F.posexplode("questions").alias("i", "q")).select(
        F.concat_ws("#", "exercise_id", F.col("i").cast("string")).alias("question_id"), "exercise_id", "file", "track", "q.status", "q.reason", "q.language",
        F.coalesce("q.figure_missing", F.lit(False)).alias("figure_missing"), year_text(F.coalesce("file", "exercise_id")).alias("year"),
        kind_of(F.coalesce("file", "exercise_id"), KINDS, OTHER).alias("kind"), "q.labels",
    )
    labels = q.select("question_id", "exercise_id", F.posexplode("labels").alias("ord", "l")).select("question_id", "exercise_id", "ord", "l.concept_id", "l.quote")
    return q.drop("labels"), labels


def summary(questions: DataFrame, labels: DataFrame, n: int = 10) -> DataFrame:
    """A run's interim figures: questions, labels, unlabelled, missing figures, and the n top concepts' questions over all labels (not the measure of concentration)."""
    top = labels.groupBy("concept_id").agg(F.count_distinct("question_id").alias("q")).orderBy(F.col("q").desc(), "concept_id").limit(n).agg(F.sum("q").alias("q")).scalar()
    total = labels.agg(F.count(F.lit(1)).alias("n")).scalar()
    marked = labels.select("question_id").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    x = questions.agg(F.count(F.lit(1)).alias("questions"), F.count_if("figure_missing").alias("figures_missing"))
    return x.select("questions", total.alias("labels"), (F.col("questions") - marked).alias("unlabelled"), "figures_missing", share(F.coalesce(top, F.lit(0)), total).alias("top_share"))


def reasons(questions: DataFrame, status: str = "hors_referentiel") -> DataFrame:
    """Reasons of questions outside the catalogue."""
    return questions.filter(F.col("status") == status).groupBy("reason").agg(F.count(F.lit(1)).alias("questions"))
