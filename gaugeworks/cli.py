"""Commands: python -m gaugeworks.cli COMMAND ... Each prints a text table; --out writes it as Parquet instead.

The process ends with 0, or with 2 where a paper lost too much text (extract) or differs from its golden summary (golden).
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import compare, matching, measures, papers, probes, records, reports, runs, syllabus
from gaugeworks.sources import readers, store

FIELDS = {"file": "file", "track": "track", "year": "year", "kind": "kind", "language": "language", "exercise": "exercise_id"}


#: Commands whose rows, or rows that meet a condition, are faults.
FAULTS = {"extract": "low", "golden": "field IS NOT NULL"}


def golden(spark: SparkSession, found: DataFrame, path: str) -> DataFrame:
    """Differences from the summaries at `path`; where none stand there yet, these become the golden ones and nothing differs."""
    try:
        expected = spark.read.schema(found.schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found.write.json(path)
        expected = spark.read.schema(found.schema).json(path)
    return papers.against_golden(found, expected).orderBy("doc_file", "field")


def load(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Publishes what is given of a corpus, a catalogue and a run in the store at the first path, all or nothing, and gives its tables' sizes."""
    rows: dict[str, DataFrame] = {}
    if a.corpus:
        rows |= store.corpus_rows(readers.corpus(spark, a.corpus))
    if a.catalogue:
        rows["concepts"] = readers.catalogue(spark, a.catalogue).select(F.col("concept_id").alias("id"), "section_id", "label", "ord")
    if a.labels:
        if not a.run:
            raise SystemExit("--labels needs --run, the run's name")
        rows |= store.run_rows(readers.runs(spark, [a.labels]), a.run)
    store.publish(spark, a.paths[0], rows)
    return spark.createDataFrame([(t, there.count()) for t in store.TABLES if (there := store.read(spark, a.paths[0], t)) is not None], "table string, rows long")


def command(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    name = a.command
    if name == "golden":
        return golden(spark, papers.summary(papers.extract(readers.papers(spark, a.paths[0]))), a.golden)
    if name == "import":
        return load(spark, a)
    if name == "gold":
        sides = [readers.catalogue(spark, p).select(F.col("concept_id").alias("id"), "label", F.col("section_id").alias("section")) for p in (a.paths[0], a.catalogue)]
        return matching.recall(matching.match_gold(*sides)).orderBy("section")
    if name == "extract":
        return papers.summary(papers.extract(readers.papers(spark, a.paths[0]))).orderBy("doc_file")
    if name == "segment":
        return syllabus.segment(readers.papers(spark, a.paths[0])).units.orderBy("doc_file", "first_line")
    if name == "probe":
        ps = readers.probes(a.probes)
        return probes.admission(probes.attest(probes.zones(readers.corpus(spark, a.paths[0])), ps, "doc_file"), ps, a.least).orderBy("probe")
    q, l = runs.flatten(readers.runs(spark, a.paths[:1] if name in ("dispersion", "compare") else a.paths))
    if name == "distribution":
        return measures.aggregate(q, l)
    if name == "summary":
        return runs.summary(q, l)
    if name == "top":
        return measures.top_concepts(q, l, a.n)
    if name in FIELDS:
        return measures.aggregate(q, l, [FIELDS[name]]).orderBy("questions", ascending=False)
    if name == "everything":
        return measures.all_measures(q, l, ["track", "year", "kind", "language"]).orderBy("grouped_by", "value")
    if name in ("section", "zero"):
        cat = readers.catalogue(spark, a.catalogue)
        return measures.section_usage(l, cat).orderBy(F.col("occurrences").desc(), "section_id") if name == "section" else measures.never_asked(l, cat).orderBy(F.col("silent").desc(), "section_id", "concept_id")
    if name == "crosstab":
        values = ["None" if r[0] is None else str(r[0]) for r in q.select(a.field).distinct().orderBy(a.field).collect()]
        return measures.crosstab(q, l, a.field, values).orderBy("concept_id")
    if name in ("dispersion", "compare"):
        q2, l2 = runs.flatten(readers.runs(spark, a.paths[1:2]))
        if name == "compare":
            columns = ["questions", "labels", "concepts", "unlabelled", "mean_labels", "coverage"]
            return compare.delta(measures.aggregate(q, l), measures.aggregate(q2, l2), columns)
        named = lambda qq, ll: qq.select("exercise_id", "question_id").join(ll.select("question_id", "concept_id"), "question_id", "left").select("exercise_id", "concept_id")
        return compare.dispersion(named(q, l), named(q2, l2), q).orderBy("gap_per_question", "gap", "questions", "labels_a", "labels_b", "jaccard", "exercise_id", ascending=False)
    if name == "records":
        return records.records(q.join(l.select("question_id", "concept_id"), "question_id").withColumn("paper_language", q["language"]))
    raise SystemExit(f"unknown command {name}")


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gaugeworks")
    p.add_argument("command", choices=["extract", "segment", "probe", "distribution", "summary", "top", "everything", "section", "zero", "crosstab", "dispersion", "compare", "records", "golden", "import", "gold", *FIELDS])
    p.add_argument("paths", nargs="+")
    p.add_argument("--catalogue")
    p.add_argument("--probes")
    p.add_argument("--field", default="language")
    p.add_argument("--least", type=int, default=2)
    p.add_argument("-n", type=int, default=20)
    p.add_argument("--out")
    p.add_argument("--golden", help="folder of golden summaries")
    p.add_argument("--corpus", help="import: nested corpus")
    p.add_argument("--labels", help="import: a labelling run")
    p.add_argument("--run", help="import: the run's name")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("gaugeworks").getOrCreate()
    df = command(spark, a)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        print(reports.table(df, a.command))
    return 2 if a.command in FAULTS and df.filter(FAULTS[a.command]).limit(1).count() else 0


if __name__ == "__main__":
    raise SystemExit(main())
