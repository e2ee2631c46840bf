"""Readers: papers, nested corpora, catalogues, runs, memos, probes."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.text import newlines
from gaugeworks.operators.probes import Probe

QUESTION = "struct<id:string,number:string,text:string,solution:string,figure_missing:boolean,line:int>"
EXERCISE = f"struct<id:string,title:string,level:int,track:string,preamble:string,unattributed:string,questions:array<{QUESTION}>,line:int>"
CORPUS = f"doc_file string, fingerprint string, track string, level int, header string, exercises array<{EXERCISE}>, source_chars int, noise_chars int, ratio double"
LABEL = "struct<concept_id:string,quote:string>"
RUN = f"exercise_id string, file string, track string, sections array<string>, paper_language string, questions array<struct<question_id:string,status:string,reason:string,object:string,language:string,figure_missing:boolean,labels:array<{LABEL}>>>, tokens map<string,bigint>"
MEMO = "key string, label string, payload string, meta string, seq long"
#: Where a row stands among the rows of all files: rows compare by path, then by place in the file.
PLACE = "struct<path:string,block:long,row:long>"


def placed(scan: DataFrame, name: str) -> DataFrame:
    """Rows of a file reader with their place, whatever the files' sizes and the order in which Spark reads them.

    Row numbers ascend within a part of a file, as one task reads it from its start; parts are told apart by where they begin.
    """
    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return scan.withColumn(name, place)


def papers(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """doc_file, text of whole files, line ends translated."""
    rows = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_name").alias("doc_file"), newlines(F.col("value")).alias("text"))


def corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CORPUS).json(path, multiLine=True)


def runs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Answers of several runs, each with its ordinal, and `at`, the exercise's place in its run: files by path, then as they stand in the file."""
    out = None
    for k, p in enumerate(paths):
        one = placed(spark.read.schema(RUN).json(p, multiLine=True), "at").withColumn("run", F.lit(k))
        out = one if out is None else out.unionByName(one)
    return out


def run_hash(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One 16-digit hash over the hashes of all files, in order of their paths."""
    files = spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("h"))
    return files.agg(F.array_sort(F.collect_list(F.struct("path", "h"))).alias("a")).select(F.substring(F.sha2(F.array_join(F.transform("a", lambda x: x["h"]), ""), 256), 1, 16).alias("hash"))


def exploded_labels(run: DataFrame) -> DataFrame:
    """One row per label of labelled questions: run, exercise_id, question_id, concept_id, quote."""
    q = run.select("run", "exercise_id", "track", F.explode("questions").alias("q"))
    return q.select("run", "exercise_id", "track", "q.question_id", "q.status", F.explode("q.labels").alias("l")).select("run", "exercise_id", "track", "question_id", "status", "l.concept_id", "l.quote")


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Concepts of a folder of section files (JSON, or YAML where a parser is installed) in order of their names: a few hundred rows that the driver reads."""
    rows = []
    for path in sorted(Path(folder).iterdir()):
        if path.suffix == ".json":
            found = json.loads(path.read_text(encoding="utf-8"))
        elif path.suffix in (".yaml", ".yml"):
            import yaml  # optional

            found = yaml.safe_load(path.read_text(encoding="utf-8"))
        else:
            continue
        rows += [(len(rows) + k, c["id"], c.get("section_id") or path.stem, c.get("slug"), c.get("label")) for k, c in enumerate(found.get("concepts", []))]
    return spark.createDataFrame(rows, "ord int, concept_id string, section_id string, slug string, label string")


def memo(spark: SparkSession, path: str) -> DataFrame:
    """Call memo in JSON lines: cut lines drop out, the last line of a key counts. Lines with a sequence number come after those without, in its order; others go by path, then by place in the file."""
    from gaugeworks.operators.labelling import latest

    rows = placed(spark.read.schema(MEMO).option("mode", "DROPMALFORMED").json(path, recursiveFileLookup=True), "at").filter("key IS NOT NULL")
    return latest(rows.select("key", "label", "payload", "meta", F.struct(F.coalesce("seq", F.lit(-1)).alias("seq"), "at").alias("ord")))


def exclusions(spark: SparkSession, path: str | None) -> DataFrame:
    """Mentions of what is excluded; none where no path is given or nothing stands there."""
    schema = "id string, scope string, object string, reason string, attributable boolean"
    try:
        return spark.createDataFrame([], schema) if path is None else spark.read.schema(schema).json(path, multiLine=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# The keys that a profile must have.
PROFILE_KEYS = ("matiere", "critere_admission", "axe_langage", "genres")


def profile(path: str) -> dict:
    """A subject's profile (JSON, or YAML where a parser is installed); missing keys are refused."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        found = json.loads(text)
    else:
        import yaml  # optional

        found = yaml.safe_load(text)
    if missing := [k for k in PROFILE_KEYS if k not in found]:
        raise ValueError(f"profile {path}: missing keys {missing}")
    return found


def probes(path: str) -> list[Probe]:
    """Probes of a JSON file, whatever the case; nameless ones and patterns that Java can't read are refused, as the session that runs them is there."""
    SparkSession.builder.getOrCreate()
    any_case = lambda pattern: pattern and f"(?iu){pattern}"
    return [Probe(p.get("name", ""), any_case(p["pattern"]), any_case(p.get("anti")), p.get("status", "open"), p.get("concept")) for p in json.loads(Path(path).read_text(encoding="utf-8"))]
