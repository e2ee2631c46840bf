"""The concept catalogue: assembly of decisions, cross-references and their integrity, validation, injection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.text import is_infinitive

FATAL, EXPECTED = "fatal", "expected"
#: Findings that are expected at some stage; any other code is fatal.
MILD = ("xref_to_section", "dead_section", "section_over_ceiling", "empty_section", "too_many_concepts", "too_few_concepts", "no_infinitive", "slug_repeated", "unit_rejected", "self_exclusion")


def severity(code: Column) -> Column:
    return F.when(code.isin(*MILD), EXPECTED).otherwise(FATAL)


def unique_slugs(concepts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """slug, slug_2, slug_3 in the order of (section_id, ord) over all sections, counted on the original slug; a slug already in the catalogue counts as one before them."""
    rows = concepts.withColumn("__new", F.lit(1))
    if existing is not None:
        old = existing.select("slug", F.lit("").alias("section_id"), F.lit(-1).cast("long").alias("ord"), F.lit(0).alias("__new")).distinct()
        rows = rows.unionByName(old, allowMissingColumns=True)
    nth = F.row_number().over(W.partitionBy("slug").orderBy("__new", "section_id", "ord"))
    named = rows.withColumn("slug", F.when(nth == 1, F.col("slug")).otherwise(F.concat("slug", F.lit("_"), nth.cast("string"))))
    return named.filter("__new = 1").drop("__new").withColumn("id", F.concat_ws(".", "section_id", "slug"))


def assemble(decisions: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Concepts of accepted decisions and refusals (excerpt of at most 180 characters). A decision on an unknown unit keeps the id as its source.

    decisions: unit_id, ord, verdict, reason, concepts array<struct<slug, label, ...>>; units: unit_id, section_id, text.
    """
    d = decisions.join(units, "unit_id", "left").withColumn("source", F.coalesce("text", "unit_id"))
    refused = d.filter("verdict = 'refuse'").select("unit_id", "source", F.substring("source", 1, 180).alias("excerpt"), "reason")
    c = d.filter("verdict <> 'refuse'").select("section_id", "unit_id", "ord", "source", "verdict", F.posexplode("concepts").alias("i", "c"))
    c = c.select("section_id", "unit_id", (F.col("ord") * 1000 + F.col("i")).cast("long").alias("ord"), "source", "verdict", "c.*")
    return c, refused


def resolve(xrefs: DataFrame, concepts: DataFrame, sections: DataFrame) -> DataFrame:
    """Cross-references by name: a concept's slug, else its id, else a section, else unresolved with the raw name kept.

    xrefs: concept_id, raw; concepts: concept_id, slug; sections: section_id. Joins, in that order of preference; of equal slugs the last id counts.
    """
    by_slug = concepts.groupBy(F.col("slug").alias("raw")).agg(F.max("concept_id").alias("slug_id"))
    by_id = concepts.select(F.col("concept_id").alias("raw"), F.col("concept_id").alias("own_id")).distinct()
    by_section = sections.select(F.col("section_id").alias("raw"), F.col("section_id").alias("sec_id")).distinct()
    x = xrefs.join(by_slug, "raw", "left").join(by_id, "raw", "left").join(by_section, "raw", "left")
    see = F.coalesce("slug_id", "own_id", "sec_id")
    kind = F.when(F.coalesce("slug_id", "own_id").isNotNull(), "concept").when(F.col("sec_id").isNotNull(), "section")
    named = F.col("raw").isNotNull() & (F.col("raw") != "")
    return x.select("concept_id", F.when(named, see).alias("see"), F.when(named, kind).alias("see_type"), F.when(named & see.isNull(), F.col("raw")).alias("see_raw"))


def check_xrefs(xrefs: DataFrame, concepts: DataFrame, sections: DataFrame) -> DataFrame:
    """Findings on resolved cross-references over the whole final set: concept_id, code, severity, see."""
    ids = concepts.select(F.col("concept_id").alias("see"), F.lit(True).alias("is_concept")).distinct()
    secs = sections.select(F.col("section_id").alias("see"), F.lit(True).alias("is_section")).distinct()
    x = xrefs.join(ids, "see", "left").join(secs, "see", "left")
    t, has_c, has_s = F.col("see_type"), F.col("is_concept").isNotNull(), F.col("is_section").isNotNull()
    code = (
        F.when(F.col("see").isNull(), F.when(F.coalesce(F.col("see_raw"), F.lit("")) != "", "unresolved"))
        .when(t.isNull(), "untyped")
        .when((t == "concept") & ~has_c, "dead_concept")
        .when((t == "section") & ~has_s, "dead_section")
        .when(t == "section", "xref_to_section")
        .when(t != "concept", "unknown_type")
    )
    own = F.when(F.col("see") == F.col("concept_id"), "self_exclusion")
    found = x.select("concept_id", "see", F.explode(F.array_compact(F.array(code, own))).alias("code"))
    return found.select("concept_id", "code", severity(F.col("code")).alias("severity"), "see")


def xref_counts(xrefs: DataFrame) -> DataFrame:
    return xrefs.groupBy(F.coalesce("see_type", F.lit("unresolved")).alias("see_type")).agg(F.count(F.lit(1)).alias("xrefs"))


def validate(concepts: DataFrame, sections: DataFrame, ceiling: int, least: int, most: int) -> DataFrame:
    """Findings on the catalogue: target, code, severity. concepts: concept_id, section_id, slug, label."""
    one = lambda df, target, code: df.select(F.col(target).cast("string").alias("target"), F.lit(code).alias("code"))
    twice = concepts.groupBy("concept_id").count().filter("count > 1")
    slugs = concepts.groupBy("slug").agg(F.count_distinct("section_id").alias("n")).filter("n > 1")
    plain = concepts.filter(~is_infinitive(F.col("label")))
    per = sections.select("section_id").join(concepts.groupBy("section_id").count(), "section_id", "left").fillna(0, ["count"])
    total = concepts.agg(F.count(F.lit(1)).alias("n")).select(F.lit("catalogue").alias("target"), F.when(F.col("n") > most, "too_many_concepts").when(F.col("n") < least, "too_few_concepts").alias("code")).filter("code IS NOT NULL")
    out = one(twice, "concept_id", "id_repeated").unionByName(one(slugs, "slug", "slug_repeated")).unionByName(one(plain, "concept_id", "no_infinitive"))
    out = out.unionByName(one(per.filter(F.col("count") > ceiling), "section_id", "section_over_ceiling")).unionByName(one(per.filter("count = 0"), "section_id", "empty_section")).unionByName(total)
    return out.withColumn("severity", severity(F.col("code")))


def inject(catalogue: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The catalogue with the new concepts whose id it lacks, those refused (already there), and the recount by section. Existing concepts are never renamed."""
    added = new.join(catalogue.select("concept_id"), "concept_id", "left_anti")
    refused = new.join(catalogue.select("concept_id"), "concept_id", "left_semi")
    out = catalogue.unionByName(added)
    return out, refused, out.groupBy("section_id").agg(F.count(F.lit(1)).alias("concepts"))


def anomalies(findings: DataFrame) -> DataFrame:
    """The findings that block a publication when it is strict; else they are recorded in the manifest. findings: code, severity."""
    return findings.filter(F.col("severity") == FATAL)


def exit_code(findings: DataFrame, strict: bool) -> int:
    """2 where a strict publication meets an anomaly, else 0."""
    return 2 if strict and anomalies(findings).limit(1).count() else 0


def for_import(concepts: DataFrame) -> DataFrame:
    """Concepts as the relational table has them; without a section that of the id counts. concepts: concept_id, section_id, label, definition."""
    return concepts.select("concept_id", F.coalesce("section_id", F.substring_index("concept_id", ".", 1)).alias("section_id"), "label", "definition")
