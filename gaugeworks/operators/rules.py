"""Rule registry: predicates and repairs as columns, findings as rows.

Rules run in order. The first fatal rule that a row breaks drops it and ends its checks; repairs of rules before that one are made,
and each later rule sees the repaired row. Everything is one projection per rule, so Catalyst fuses a registry
into one stage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.text import fold_latin

MOST_TRIGGERS, LEAST_DEFINITION = 6, 40
FATAL, REPAIR = "fatal", "repair"


@dataclass(frozen=True)
class Rule:
    """broken: a condition; repair: new values of columns for what is repaired, given only for repairable rules."""

    code: str
    severity: str
    broken: Callable[[], Column]
    repair: Mapping[str, Callable[[], Column]] | None = None

    def __post_init__(self) -> None:
        if self.severity == REPAIR and not self.repair:
            raise ValueError(f"{self.code}: a repairable rule needs a repair")
        if self.severity == FATAL and self.repair:
            raise ValueError(f"{self.code}: a fatal rule must not have a repair")


def key_form(text: Column) -> Column:
    """snake_case without marks."""
    return F.regexp_replace(F.regexp_replace(F.lower(fold_latin(F.coalesce(text, F.lit("")))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def concept_rules(languages: Sequence[str], sections: Sequence[str]) -> list[Rule]:
    c = F.col
    count = lambda x: F.coalesce(F.size(x), F.lit(0))
    allowed = F.array(*[F.lit(x) for x in languages])
    known = F.array(*[F.lit(x) for x in sections])
    langs = F.coalesce(c("languages"), F.expr("cast(array() as array<string>)"))
    return [
        Rule("slug_unusable", FATAL, lambda: key_form(c("slug")) == ""),
        Rule("slug_form", REPAIR, lambda: c("slug") != key_form(c("slug")), {"slug": lambda: key_form(c("slug"))}),
        Rule("no_trigger", FATAL, lambda: F.greatest(count(c("triggers")), F.lit(0)) < 1),
        Rule("many_triggers", REPAIR, lambda: count(c("triggers")) > MOST_TRIGGERS, {"triggers": lambda: F.slice(c("triggers"), 1, MOST_TRIGGERS)}),
        Rule("no_exclusion", FATAL, lambda: F.greatest(count(c("exclusions")), F.lit(0)) == 0),
        Rule("short_definition", FATAL, lambda: F.length(F.coalesce(c("definition"), F.lit(""))) < LEAST_DEFINITION),
        Rule("foreign_language", REPAIR, lambda: F.size(F.array_except(langs, allowed)) > 0, {"languages": lambda: F.filter(langs, lambda x: F.array_contains(allowed, x))}),
        Rule("unknown_section", FATAL, lambda: ~F.coalesce(F.array_contains(known, c("target_section")), F.lit(False))),
    ]


def decision_rules() -> list[Rule]:
    c = F.col
    n = lambda: F.coalesce(c("concepts"), F.lit(0))
    return [
        Rule("refused_with_concepts", FATAL, lambda: (c("verdict") == "refuse") & (n() > 0)),
        Rule("accepted_without_concepts", FATAL, lambda: (c("verdict") != "refuse") & (n() == 0)),
        Rule("split_of_one", REPAIR, lambda: (c("verdict") == "eclate") & (n() == 1), {"verdict": lambda: F.lit("admis_reformule")}),
        Rule("unsplit_of_many", REPAIR, lambda: c("verdict").isin("admis", "admis_reformule") & (n() > 1), {"verdict": lambda: F.lit("eclate")}),
        Rule("no_reason", REPAIR, lambda: F.trim(F.coalesce(c("reason"), F.lit(""))) == "", {"reason": lambda: F.lit("(no reason given)")}),
    ]


def apply_rules(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rows, repaired, with findings: array<struct<ord, code, severity>> up to the first fatal one, and fatal: the code that drops the row, or null."""
    hits = [f"__hit{k}" for k in range(len(rules))]
    for r, hit in zip(rules, hits, strict=True):
        rows = rows.withColumn(hit, F.coalesce(r.broken(), F.lit(False)))
        rows = rows.withColumns({name: F.when(F.col(hit), value()).otherwise(F.col(name)) for name, value in (r.repair or {}).items()})
    one = lambda k, r: F.when(F.col(hits[k]), F.struct(F.lit(k).alias("ord"), F.lit(r.code).alias("code"), F.lit(r.severity).alias("severity")))
    rows = rows.withColumn("__all", F.array_compact(F.array(*[one(k, r) for k, r in enumerate(rules)]))).drop(*hits)
    rows = rows.withColumn("__stop", F.try_element_at(F.filter("__all", lambda f: f["severity"] == FATAL), F.lit(1)))
    last = F.coalesce(F.col("__stop.ord"), F.lit(len(rules)))
    return rows.withColumn("findings", F.filter("__all", lambda f: f["ord"] <= last)).withColumn("fatal", F.col("__stop.code")).drop("__all", "__stop")


def findings(checked: DataFrame, key: str) -> DataFrame:
    return checked.select(key, F.explode("findings").alias("f")).select(key, "f.ord", "f.code", "f.severity")


def check_decisions(decisions: DataFrame, units: DataFrame) -> DataFrame:
    """Findings on the set of decisions: unit_id, code for invented units, repeated decisions (from the second on) and units without one.

    decisions: unit_id, ord; units: unit_id.
    """
    invented = decisions.join(units, "unit_id", "left_anti").select("unit_id", F.lit("invented_unit").alias("code"))
    nth = F.row_number().over(W.partitionBy("unit_id").orderBy("ord"))
    repeated = decisions.withColumn("n", nth).filter("n > 1").select("unit_id", F.lit("repeated_decision").alias("code"))
    silent = units.join(decisions, "unit_id", "left_anti").select("unit_id", F.lit("no_decision").alias("code"))
    return invented.unionByName(repeated).unionByName(silent)


def failed_sections(decisions: DataFrame) -> DataFrame:
    """Sections none of whose decisions survived. decisions: section_id, fatal."""
    return decisions.groupBy("section_id").agg(F.count_if(F.col("fatal").isNull()).alias("kept"), F.count(F.lit(1)).alias("given")).filter("kept = 0")
