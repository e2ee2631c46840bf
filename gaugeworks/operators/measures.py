"""Measures of a labelled corpus.

questions: question_id, exercise_id, track, status, year, language (and any further field to group by).
labels:    question_id, concept_id; one row per label, repeats count as occurrences.
catalogue: concept_id, section_id.

Labels meet their questions once (one shuffle by question); all measures start from counts by (group, concept), which
Spark pre-aggregates on the map side, so a group or concept that holds a third of all rows is no bottleneck.
Ties are broken by id everywhere. Shares are percentages, 0 when nothing is there to share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.text import section_of
from gaugeworks.operators.order import numbered
from gaugeworks.sources.shared import written

#: Published noise of coverage, in points, between two equal runs.
COVERAGE_NOISE = 10.7
NONE = "∅"


def share(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.round(F.coalesce(100.0 * part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0)), digits)


def ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.round(F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0)), digits)


def rows_of(df: DataFrame) -> Column:
    """Number of rows, as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def sized(questions: DataFrame, labels: DataFrame) -> DataFrame:
    """questions with n_labels; questions without labels stay with 0."""
    n = labels.groupBy("question_id").agg(F.count(F.lit(1)).alias("n_labels"))
    return questions.join(n, "question_id", "left").fillna(0, ["n_labels"])


def aggregate(questions: DataFrame, labels: DataFrame, by: Sequence[str] = (), ok: str = "ok") -> DataFrame:
    """The measures of each group: questions, labels, exercises, concepts, unlabelled, mean, coverage with its bounds."""
    by = list(by)
    q = sized(questions, labels)
    one = q.groupBy(*by).agg(
        F.count(F.lit(1)).alias("questions"),
        F.sum("n_labels").alias("labels"),
        F.count_if(F.col("n_labels") == 0).alias("unlabelled"),
        F.count_if(F.col("status") == ok).alias("covered"),
    )
    exercises = questions.select(*by, F.coalesce(F.col("exercise_id").cast("string"), F.lit(NONE)).alias("e")).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("exercises"))
    used = labels.join(questions.select("question_id", *by), "question_id").select(*by, "concept_id").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("concepts"))
    if by:
        same = lambda x: [one[c].eqNullSafe(x[c]) for c in by]
        out = one.join(exercises, same(exercises), "left").select(one["*"], "exercises")
        out = out.join(used, [out[c].eqNullSafe(used[c]) for c in by], "left").select(out["*"], "concepts")
    else:
        out = one.select("*", exercises.scalar().alias("exercises"), used.scalar().alias("concepts"))
    covered = share(F.col("covered"), F.col("questions"))
    return out.select(
        *by,
        "questions",
        F.coalesce("labels", F.lit(0)).alias("labels"),
        "exercises",
        F.coalesce("concepts", F.lit(0)).alias("concepts"),
        "unlabelled",
        ratio(F.col("labels"), F.col("questions")).alias("mean_labels"),
        covered.alias("coverage"),
        F.round(F.greatest(covered - COVERAGE_NOISE, F.lit(0.0)), 6).alias("coverage_low"),
        F.round(F.least(covered + COVERAGE_NOISE, F.lit(100.0)), 6).alias("coverage_high"),
    )


def concept_counts(labels: DataFrame) -> DataFrame:
    """By concept: questions (distinct) and occurrences."""
    per = labels.groupBy("concept_id", "question_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("concept_id").agg(F.count(F.lit(1)).alias("questions"), F.sum("n").alias("occurrences"))


def top_concepts(questions: DataFrame, labels: DataFrame, n: int = 20) -> DataFrame:
    """The n concepts asked by most questions, with both shares."""
    counts = concept_counts(labels)
    return counts.orderBy(F.col("questions").desc(), "concept_id").limit(n).select(
        "concept_id",
        "questions",
        "occurrences",
        share(F.col("questions"), rows_of(questions)).alias("share_of_questions"),
        share(F.col("occurrences"), rows_of(labels)).alias("share_of_labels"),
    )


def concentration(labels: DataFrame, sizes: Sequence[int] = (1, 5, 10, 20, 50)) -> DataFrame:
    """Share of all occurrences that the n concepts with most questions hold, for several n."""
    counts = concept_counts(labels)
    # Ranks are needed for the head alone: a top-k, not a sort of all concepts.
    head = counts.orderBy(F.col("questions").desc(), "concept_id").limit(max(sizes))
    ranked = head.withColumn("rank", F.row_number().over(W.orderBy(F.col("questions").desc(), "concept_id")))
    sums = [F.sum(F.when(F.col("rank") <= n, F.col("occurrences")).otherwise(0)).alias(f"n{n}") for n in sizes]
    stack = ", ".join(f"{n}L, n{n}" for n in sizes)
    rows = ranked.agg(*sums).selectExpr(f"stack({len(sizes)}, {stack}) AS (top_n, occurrences)")
    return rows.select("top_n", "occurrences", share(F.col("occurrences"), rows_of(labels)).alias("share"))


def section_usage(labels: DataFrame, catalogue: DataFrame) -> DataFrame:
    """By catalogue section: its concepts, those used, occurrences and their share of all labels. Usage goes by the id's prefix, the total by the stored section."""
    used = labels.groupBy("concept_id").agg(F.count(F.lit(1)).alias("n")).withColumn("section_id", section_of(F.col("concept_id")))
    usage = used.groupBy("section_id").agg(F.count(F.lit(1)).alias("used"), F.sum("n").alias("occurrences"))
    sections = catalogue.groupBy("section_id").agg(F.count(F.lit(1)).alias("concepts"))
    return sections.join(usage, "section_id", "left").select(
        "section_id",
        "concepts",
        F.coalesce("used", F.lit(0)).alias("used"),
        F.coalesce("occurrences", F.lit(0)).alias("occurrences"),
        share(F.coalesce("occurrences", F.lit(0)), rows_of(labels)).alias("share"),
    )


def never_asked(labels: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Concepts that no label names, with how many of their section share that fate."""
    zero = catalogue.join(labels.select("concept_id").distinct(), "concept_id", "left_anti").select("section_id", "concept_id")
    silent = zero.groupBy("section_id").agg(F.count(F.lit(1)).alias("silent"))
    return zero.join(silent, "section_id")


def crosstab(questions: DataFrame, labels: DataFrame, field: str, values: Sequence[str]) -> DataFrame:
    """Occurrences by concept (rows) and a field's values (columns); null counts as the value 'None'."""
    rows = labels.join(questions.select("question_id", F.coalesce(F.col(field).cast("string"), F.lit("None")).alias(field)), "question_id")
    out = rows.groupBy("concept_id").pivot(field, list(values)).count().fillna(0)
    return out.select("concept_id", *[F.col(f"`{v}`").alias(v) for v in values])


def contingency(questions: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Questions by two fields with totals of all rows, those with a value that is not listed included; null counts as the value 'None'."""
    named = questions.select(F.coalesce(F.col(row).cast("string"), F.lit("None")).alias(row), F.coalesce(F.col(column).cast("string"), F.lit("None")).alias(column))
    return named.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values], F.count(F.lit(1)).alias("total"))


def status_histogram(questions: DataFrame) -> DataFrame:
    return questions.groupBy("status").agg(F.count(F.lit(1)).alias("questions"))


def _named_sets(fields: Sequence[str]) -> list[Column]:
    """grouped_by and value of a row of grouping sets by none or one of the fields."""
    kind, value = F.lit("all"), F.lit(None).cast("string")
    for f in reversed(fields):
        kind, value = F.when(F.grouping(f) == 0, f).otherwise(kind), F.coalesce(F.col(f).cast("string"), value)
    return [kind.alias("grouped_by"), value.alias("value")]


def everything(questions: DataFrame, labels: DataFrame, fields: Sequence[str], ok: str = "ok") -> DataFrame:
    """Questions, labels, unlabelled and coverage for the whole and each field's values: one pass of grouping sets."""
    sets = sized(questions, labels).groupingSets([[], *[[f] for f in fields]], *fields)
    n = F.count(F.lit(1))
    x = sets.agg(*_named_sets(fields), n.alias("questions"), F.sum("n_labels").alias("labels"), F.count_if(F.col("n_labels") == 0).alias("unlabelled"), F.round(F.count_if(F.col("status") == ok) * 100.0 / n, 6).alias("coverage"))
    return x.select("grouped_by", "value", "questions", "labels", "unlabelled", "coverage")


def all_measures(questions: DataFrame, labels: DataFrame, fields: Sequence[str], ok: str = "ok") -> DataFrame:
    """The measures of aggregate() for the whole and each field's values: grouped_by, value and its nine columns, from one shuffle of the labels.

    A question brings its labels' count and the numbers of its distinct concepts. Sums come from grouping sets that Spark adds up on the map side. For exact distinct counts each
    exercise and each concept gathers the values that it occurs with, a set as large as the field has values, and counts once for each of them: no task sorts questions by group.
    """
    concepts = numbered(labels, "concept_id")
    named = questions.withColumn("__exercise", F.coalesce(F.col("exercise_id").cast("string"), F.lit(NONE)))
    exercises = numbered(named, "__exercise").withColumnRenamed("code", "__code")
    per = labels.join(concepts, "concept_id", "left").groupBy("question_id").agg(F.count(F.lit(1)).alias("__labels"), F.collect_set("code").alias("__codes"))
    q = named.join(per, "question_id", "left").join(exercises, "__exercise")
    covered = F.coalesce(F.col("status") == ok, F.lit(False))
    q = written(q.select(*fields, F.coalesce("__labels", F.lit(0)).alias("__labels"), covered.alias("__covered"), "__code", "__codes"), "sized")

    n = F.col("__labels")
    sums = [F.count(F.lit(1)).alias("questions"), F.sum(n).alias("labels"), F.count_if(n == 0).alias("unlabelled"), F.count_if("__covered").alias("covered")]
    x = q.groupingSets([[], *[[f] for f in fields]], *fields).agg(*_named_sets(fields), *sums)
    x = x.groupBy("grouped_by", "value").agg(*[F.sum(c).alias(c) for c in ("questions", "labels", "unlabelled", "covered")])

    def distinct(rows: DataFrame, name: str) -> DataFrame:
        """How many codes occur in the whole and with each value: __kind, __value and a column of that name."""
        sets = rows.groupBy("code").agg(*[F.collect_set(F.struct(F.col(f).cast("string").alias("value"))).alias(f"__{k}") for k, f in enumerate(fields)])
        one = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
        each = lambda k, f: F.transform(f"__{k}", lambda s: one(f, s["value"]))
        every = [each(k, f) for k, f in enumerate(fields)]
        met = sets.select(F.explode(F.concat(F.array(one("all", F.lit(None).cast("string"))), *every)).alias("m"))
        return met.groupBy(F.col("m.kind").alias("__kind"), F.col("m.value").alias("__value")).agg(F.count(F.lit(1)).alias(name))

    for name, rows in (("exercises", q.select(*fields, F.col("__code").alias("code"))), ("concepts", q.select(*fields, F.explode("__codes").alias("code")).distinct())):
        x = x.join(distinct(rows, name), (F.col("grouped_by") == F.col("__kind")) & F.col("value").eqNullSafe(F.col("__value")), "left").drop("__kind", "__value")
    x = x.fillna(0, ["exercises", "concepts"])
    covered = share(F.col("covered"), F.col("questions"))
    return x.select(
        "grouped_by", "value", "questions", "labels", "exercises", "concepts", "unlabelled", ratio(F.col("labels"), F.col("questions")).alias("mean_labels"), covered.alias("coverage"),
        F.round(F.greatest(covered - COVERAGE_NOISE, F.lit(0.0)), 6).alias("coverage_low"), F.round(F.least(covered + COVERAGE_NOISE, F.lit(100.0)), 6).alias("coverage_high"),
    )


def with_rank(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Appearance rank among rows of equal key, in a given total order."""
    return rows.withColumn(name, F.row_number().over(W.partitionBy(*key).orderBy(*order)))


def ranked_id(key: Column, rank: Column) -> Column:
    """id, id~2, id~3, ..."""
    return F.when(rank == 1, key.cast("string")).otherwise(F.concat(key.cast("string"), F.lit("~"), rank.cast("string")))
