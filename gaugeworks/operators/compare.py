"""Two runs side by side: instability by exercise, coverage gained and lost, deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.text import section_of

#: Instability from which an exercise is listed.
UNSTABLE = 0.5


def dispersion(a: DataFrame, b: DataFrame, questions_a: DataFrame) -> DataFrame:
    """By exercise in both runs: gap of label counts, per question of run A, and the Jaccard index of the concept sets (0 if both are empty).

    a, b: exercise_id, concept_id (null where an exercise has no label), a row per label; questions_a: exercise_id,
    question_id. Counts by (exercise, concept) take the place of sets, so no set is ever held in memory.
    """
    counted = a.withColumn("run", F.lit("a")).unionByName(b.withColumn("run", F.lit("b"))).groupBy("exercise_id", "concept_id").agg(F.count_if(F.col("run") == "a").alias("na"), F.count_if(F.col("run") == "b").alias("nb"))
    named = F.col("concept_id").isNotNull()
    per = counted.groupBy("exercise_id").agg(
        F.sum("na").alias("rows_a"),
        F.sum("nb").alias("rows_b"),
        F.sum(F.when(named, F.col("na")).otherwise(0)).alias("labels_a"),
        F.sum(F.when(named, F.col("nb")).otherwise(0)).alias("labels_b"),
        F.count_if(named & (F.col("na") > 0) & (F.col("nb") > 0)).alias("common"),
        F.count_if(named).alias("united"),
    )
    n = questions_a.select("exercise_id", "question_id").distinct().groupBy("exercise_id").agg(F.count(F.lit(1)).alias("questions"))
    gap = F.abs(F.col("labels_a") - F.col("labels_b"))
    return (
        per.filter("rows_a > 0 AND rows_b > 0")
        .join(n, "exercise_id", "left")
        .select(
            "exercise_id",
            F.coalesce("questions", F.lit(0)).alias("questions"),
            "labels_a",
            "labels_b",
            gap.alias("gap"),
            F.round(gap / F.greatest(F.coalesce("questions", F.lit(0)), F.lit(1)), 6).alias("gap_per_question"),
            F.round(F.col("common") / F.greatest("united", F.lit(1)), 6).alias("jaccard"),
        )
    )


def coverage_changes(used_a: DataFrame, used_b: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Each catalogue concept's fate between two runs: gained, lost, kept or silent in both."""
    a, b = (x.select("concept_id").distinct() for x in (used_a, used_b))
    flags = catalogue.join(a.withColumn("in_a", F.lit(True)), "concept_id", "left").join(b.withColumn("in_b", F.lit(True)), "concept_id", "left")
    in_a, in_b = F.col("in_a").isNotNull(), F.col("in_b").isNotNull()
    fate = F.when(in_a & in_b, "kept").when(in_b, "gained").when(in_a, "lost").otherwise("silent")
    return flags.select("concept_id", F.coalesce("section_id", section_of(F.col("concept_id"))).alias("section_id"), fate.alias("fate"))


def section_changes(used_a: DataFrame, used_b: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Sections awake in B alone, and those silent in both."""
    fates = coverage_changes(used_a, used_b, catalogue)
    per = fates.groupBy("section_id").agg(F.count_if(F.col("fate").isin("kept", "lost")).alias("a"), F.count_if(F.col("fate").isin("kept", "gained")).alias("b"))
    return per.select("section_id", F.when((F.col("a") == 0) & (F.col("b") > 0), "woken").when((F.col("a") == 0) & (F.col("b") == 0), "silent").otherwise("steady").alias("fate"))


def delta(measures_a: DataFrame, measures_b: DataFrame, columns: list[str]) -> DataFrame:
    """One row per measure of two one-row tables: a, b and b - a."""
    both = measures_a.select(F.lit("a").alias("run"), *columns).unionByName(measures_b.select(F.lit("b").alias("run"), *columns))
    one = both.agg(*[F.max(F.when(F.col("run") == r, F.col(c).cast("double"))).alias(f"{r}_{c}") for c in columns for r in "ab"])
    stack = ", ".join(f"'{c}', a_{c}, b_{c}, round(b_{c} - a_{c}, 6)" for c in columns)
    return one.selectExpr(f"stack({len(columns)}, {stack}) AS (measure, a, b, delta)")
