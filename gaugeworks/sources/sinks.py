"""Writers: tables by run, nested documents, relational rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.papers import Extracted


def write_run(labels: DataFrame, path: str, run: str = "run") -> None:
    """Replaces the partitions of the runs at hand and no others: writing a run again is harmless, runs coexist."""
    labels.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run).parquet(path)


def nested(x: Extracted) -> DataFrame:
    """One row per document with its exercises and questions nested, as JSON writers want it."""
    q = x.questions.groupBy("doc_file", "ex").agg(F.array_sort(F.collect_list(F.struct("pos", "id", "number", "text", "solution", "figure_missing", "line"))).alias("questions"))
    e = x.exercises.join(q, ["doc_file", "ex"], "left").groupBy("doc_file").agg(F.array_sort(F.collect_list(F.struct("ex", "id", "title", "track", "preamble", "unattributed", "line", "questions"))).alias("exercises"))
    return x.documents.join(e, "doc_file", "left")


def write_documents(x: Extracted, path: str, log: DataFrame | None = None) -> None:
    """Documents as JSON under `documents`; what was left out, such as papers.lesser_tracks(), under `log`."""
    nested(x).write.mode("overwrite").json(f"{path}/documents" if log is not None else path)
    if log is not None:
        log.write.mode("overwrite").json(f"{path}/log")


def write_units(units: DataFrame, path: str) -> None:
    """Units of syllabi as JSON lines."""
    units.write.mode("overwrite").json(path)


def write_catalogue(concepts: DataFrame, refused: DataFrame, findings: DataFrame, path: str) -> None:
    """Concepts in a folder for each section, refusals, counts by section and the anomalies that were found, each as a table of its own."""
    from gaugeworks.operators.catalogue import anomalies

    concepts.write.mode("overwrite").partitionBy("section_id").json(f"{path}/sections")
    for name, rows in (("refusals", refused), ("manifest", manifest(concepts)), ("anomalies", anomalies(findings))):
        rows.write.mode("overwrite").json(f"{path}/{name}")


def label_rows(labels: DataFrame) -> DataFrame:
    """Relational form: one row per (question, concept, run), the last one given."""
    from gaugeworks.operators.dedup import last_wins

    return last_wins(labels, ["question_id", "concept_id", "run"], ["ord"])


def check_schema(df: DataFrame, expected: T.StructType) -> None:
    """Refuses a table whose columns or types are not those expected."""
    got = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in expected}
    if got != want:
        raise ValueError(f"schema drift: missing {sorted(set(want) - set(got))}, unknown {sorted(set(got) - set(want))}, changed {sorted(k for k in want if k in got and got[k] != want[k])}")


def manifest(concepts: DataFrame) -> DataFrame:
    return concepts.groupBy("section_id").agg(F.count(F.lit(1)).alias("concepts"))


