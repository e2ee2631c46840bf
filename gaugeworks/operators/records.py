"""Dashboard records: one row per label with its display fields, the facets over them, and a standalone page's data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.text import humanise, section_of
from gaugeworks.sources.shared import written

# Exams under one name, languages and their display names.
EXAMS = {"InfoC-0": "InfoC", "TPAlgo-MPI-rapport": "TPAlgo", "TPAlgo-rapport": "TPAlgo", "InfoLCR-rapport": "LCR", "InfoU-exercices": "InfoU", "Info-rapport": "Info-rapport"}
PROGRAMMING = ("ocaml", "c", "pseudocode", "mixte")
LANGUAGES = {"ocaml": "OCaml", "c": "C", "pseudocode": "Pseudo-code", "theorique": "Théorique", "mixte": "Mixte", "indetermine": "Indéterminé"}
THEORY, ALGORITHMS, UNKNOWN = "Théorie", "Algorithmique", "Inconnu"
LEVELS = 5


def named(value: Column, names: dict[str, str]) -> Column:
    out = value
    for k, v in names.items():
        out = F.when(value == k, v).otherwise(out)
    return out


def records(labels: DataFrame) -> DataFrame:
    """labels: file, concept_id, language, paper_language, track, and exercise_id if there. Year and exam come from the file's name, else from the exercise's id; the year is null where neither has one."""
    raw = r"^(\d{4})_([A-Za-z0-9\-]+)"
    if "exercise_id" in labels.columns:
        labels = labels.withColumn("file", F.when(F.col("file").rlike(raw), F.col("file")).otherwise(F.coalesce(F.col("exercise_id").cast("string"), F.col("file"))))
    has = F.coalesce(F.col("file").rlike(raw), F.lit(False))
    exam = F.regexp_extract("file", raw, 2)
    return labels.select(
        F.when(has, F.regexp_extract("file", raw, 1).cast("int")).alias("year"),
        F.when(has, named(exam, EXAMS)).otherwise(UNKNOWN).alias("exam"),
        section_of(F.col("concept_id")).alias("section"),
        humanise(F.regexp_replace("concept_id", r"^[^.]*\.", "")).alias("concept"),
        "concept_id",
        named(F.col("language"), LANGUAGES).alias("language"),
        named(F.col("paper_language"), LANGUAGES).alias("paper_language"),
        "track",
        F.when(F.col("language").isin(*PROGRAMMING), ALGORITHMS).otherwise(THEORY).alias("type"),
        F.lit(1).alias("weight"),
    )


def facets(rows: DataFrame, exams: Sequence[str] = (), sections: Sequence[str] = (), languages: Sequence[str] = (), types: Sequence[str] = (), years: Sequence[int] = ()) -> DataFrame:
    """Rows that pass all facets that are set; a null year passes no choice of years."""
    for name, values in (("exam", exams), ("section", sections), ("language", languages), ("type", types), ("year", years)):
        if values:
            rows = rows.filter(F.col(name).isin(list(values)))
    return rows


def by_year(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Weight by concept and year; concepts that nothing names stay with the null year and 0."""
    sums = rows.groupBy("concept_id", "year").agg(F.sum("weight").alias("weight"))
    return catalogue.select("concept_id").join(sums, "concept_id", "left").fillna(0, ["weight"])


def listed(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """All concepts: those of the catalogue, with 0 where no record names them, and observed ones that it lacks. concept_id, listed, weight."""
    sums = rows.groupBy("concept_id").agg(F.sum("weight").alias("weight"))
    own = catalogue.select("concept_id", F.lit(True).alias("listed")).distinct()
    return own.join(sums, "concept_id", "full_outer").select("concept_id", F.coalesce("listed", F.lit(False)).alias("listed"), F.coalesce("weight", F.lit(0)).alias("weight"))


def heat_order(concepts: DataFrame, by: str = "programme") -> DataFrame:
    """Rows of the heat map in one of its orders: programme (ord, unlisted concepts last), most, fewest (ties by programme), name (French collation).

    concepts: concept_id, weight, ord (place in the catalogue, null for unlisted ones).
    """
    programme = [F.col("ord").asc_nulls_last(), F.col("concept_id")]
    keys = {"programme": programme, "most": [F.col("weight").desc(), *programme], "fewest": [F.col("weight"), *programme], "name": [F.collate("concept_id", "fr"), F.col("concept_id")]}
    return concepts.orderBy(*keys[by])


def totals(rows: DataFrame) -> DataFrame:
    """All facet totals in one pass: by section and type, by concept and language, by section, by concept."""
    sets = rows.groupingSets([["section", "type"], ["concept_id", "language"], ["section"], ["concept_id"]], "section", "type", "concept_id", "language")
    return sets.agg(F.sum("weight").alias("weight"), F.grouping_id().alias("grouped"))


def section_totals(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """By section: weight, concepts hit and in all."""
    hit = rows.groupBy("concept_id").agg(F.sum("weight").alias("weight"))
    x = catalogue.select("concept_id", F.coalesce("section_id", section_of(F.col("concept_id"))).alias("section")).join(hit, "concept_id", "left")
    return x.groupBy("section").agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("weight"), F.count("weight").alias("hit"), F.count(F.lit(1)).alias("concepts"))


def concept_types(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Section and type of each concept: of its first record; theory for concepts without one."""
    first = rows.groupBy("concept_id").agg(F.min_by("type", F.struct("year", "exam", "type")).alias("type"))
    return catalogue.select("concept_id", "section_id").join(first, "concept_id", "left").fillna(THEORY, ["type"])


def smaller_values(values: DataFrame, name: str) -> DataFrame:
    """Each distinct value with the number of rows whose value is smaller (`below`). Ranges of values are counted apart and their totals added up, so no task holds all values."""
    counts = values.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("__rows"))
    ranged = written(counts.repartitionByRange(name).withColumn("__range", F.spark_partition_id()), "values")
    # One row a range.
    totals = ranged.groupBy("__range").agg(F.sum("__rows").alias("__all"))
    totals = totals.select("__range", (F.sum("__all").over(W.orderBy("__range")) - F.col("__all")).alias("__before"))
    inside = F.sum("__rows").over(W.partitionBy("__range").orderBy(name)) - F.col("__rows")
    return ranged.join(F.broadcast(totals), "__range").select(name, (F.col("__before") + inside).alias("below"))


def levels(values: DataFrame, name: str = "weight", by: str | None = None) -> DataFrame:
    """Colour levels 1..5 of positive values: linear, logarithmic, and by rank; 0 for 0. `by` compares within a group, else with all.

    The rank level is the share of smaller values among the others, 1 for a single value. Null values have no levels.
    """
    if by:
        top = F.max(name).over(W.partitionBy(by))
        n = F.count(F.lit(1)).over(W.partitionBy(by))
        x, rank = values, F.when(n == 1, 1.0).otherwise(F.percent_rank().over(W.partitionBy(by).orderBy(name)))
    else:
        r = values.agg(F.count(name).alias("n"), F.max(name).alias("top")).first()
        top = F.lit(r["top"])
        x = values.join(smaller_values(values, name), name, "left")
        rank = F.lit(1.0) if r["n"] < 2 else F.col("below") / (r["n"] - 1)
    v = F.col(name)
    level = lambda share: F.when(v <= 0, 0).otherwise(F.least(F.lit(LEVELS), F.greatest(F.lit(1), F.ceil(LEVELS * share)))).cast("int")
    return x.select(*values.columns, level(v / top).alias("linear"), level(F.log1p(v) / F.log1p(top)).alias("logarithmic"), level(rank).alias("ranked"))


def page(rows: DataFrame, title: str, most: int = 100_000) -> str:
    """A standalone page that embeds the records as JSON. For small aggregates: more than `most` rows are refused."""
    data = rows.limit(most + 1).toPandas()
    if len(data) > most:
        raise ValueError("aggregate before making a page")
    body = data.to_json(orient="records", force_ascii=False).replace("</", "<\\/")
    return f'<!doctype html><meta charset="utf-8"><title>{title}</title><script type="application/json" id="records">{body}</script>'
