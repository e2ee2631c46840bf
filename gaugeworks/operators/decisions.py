"""Validation of all decisions of a section in one flow: the set, the concepts, then the decisions on the concepts that are left."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.operators.rules import FATAL, Rule, apply_rules, decision_rules

KEY = ["section_id", "unit_id"]


@dataclass(frozen=True)
class Checked:
    """decisions: those that stand, repaired, with their concepts left; findings: section_id, target, code, severity; failed: sections with units of which no decision stands."""

    decisions: DataFrame
    findings: DataFrame
    failed: DataFrame


def validate(decisions: DataFrame, units: DataFrame, concept_rules: Sequence[Rule]) -> Checked:
    """decisions: section_id, unit_id, ord, verdict, reason, concepts array<struct<slug, ...>>; units: section_id, unit_id.

    A decision on a unit that is not of its section, and any but the first on a unit, are left out. Concepts that break a fatal rule
    go; the rules of decisions then see the number that is left. A finding's target is the unit, or unit/slug for a concept, as it was
    given (`?` without a slug). Null concepts count as none. A section whose units have no standing decision fails as a whole.
    """
    units = units.select(*KEY).distinct()
    known = decisions.join(units, KEY, "left_semi").withColumn("__nth", F.row_number().over(W.partitionBy(*KEY).orderBy("ord")))
    first = known.filter("__nth = 1").drop("__nth")
    whole = lambda rows, code: rows.select("section_id", F.col("unit_id").alias("target"), F.lit(code).alias("code"), F.lit(FATAL).alias("severity"))
    found = whole(decisions.join(units, KEY, "left_anti"), "invented_unit").unionByName(whole(known.filter("__nth > 1"), "repeated_decision"))
    found = found.unionByName(whole(units.join(decisions, KEY, "left_anti"), "no_decision"))

    fields = first.schema["concepts"].dataType.elementType.names
    concepts = first.select(*KEY, F.posexplode("concepts").alias("__i", "c")).select(*KEY, "__i", F.concat("unit_id", F.lit("/"), F.coalesce("c.slug", F.lit("?"))).alias("target"), "c.*")
    concepts = apply_rules(concepts, concept_rules)
    left = concepts.filter("fatal IS NULL").groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("__i", F.struct(*fields).alias("c")))).alias("__left"))

    judged = first.drop("concepts").join(left, KEY, "left").withColumn("concepts", F.coalesce(F.size("__left"), F.lit(0)))
    judged = apply_rules(judged.withColumn("concepts", F.greatest("concepts", F.lit(0))).withColumn("target", F.col("unit_id")), decision_rules())
    for rows in (concepts, judged):
        found = found.unionByName(rows.select("section_id", "target", F.explode("findings").alias("f")).select("section_id", "target", "f.code", "f.severity"))
    stands = judged.filter("fatal IS NULL").withColumn("concepts", F.transform("__left", lambda x: x["c"])).drop("__left", "findings", "fatal", "target")
    failed = units.select("section_id").distinct().join(stands, "section_id", "left_anti")
    return Checked(stands, found, failed)
