"""Relational tables that are published together: a load changes all of them or none.

Every load writes its rows under new names and then puts one small manifest in place by a rename that only the first of two writers of that number can do. Readers go by the
manifest with the highest number, so a load that fails anywhere before leaves what was there, and a reader never sees half of one. A table may be kept in parts by a column, such
as labels by run: only the parts that a load has rows of are written anew. Rows of an equal key are replaced, others stay; within a load the last one given counts. A load may be repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.dedup import last_wins, upsert

MANIFEST = "manifest-{:012d}.json"


@dataclass(frozen=True)
class Table:
    key: tuple[str, ...]
    #: Of the rows of one key in a load that with the greatest value here counts.
    order: str = "ord"
    part: str | None = None


TABLES = {
    "documents": Table(("fingerprint",)),
    "exercises": Table(("id",)),
    "questions": Table(("id",)),
    "concepts": Table(("id",)),
    "runs": Table(("id",)),
    "labels": Table(("question_id", "concept_id", "run"), part="run"),
}


def _files(spark: SparkSession, path: str):  # noqa: ANN202
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def current(spark: SparkSession, path: str) -> tuple[int, dict[str, dict[str, str]]]:
    """Number of the last manifest (0 if there is none), and by table the folder of each part ('' where a table has no parts)."""
    fs, folder = _files(spark, path)
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []
    found = [n for n in names if n.startswith("manifest-") and n.endswith(".json")]
    if not found:
        return 0, {}
    line = spark.read.text(f"{path}/{found[-1]}").first()[0]
    return int(found[-1][9:-5]), json.loads(line)


def read(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """A table as last published, or None."""
    folders = current(spark, path)[1].get(name)
    return spark.read.parquet(*[f"{path}/{f}" for f in folders.values()]) if folders else None


def publish(spark: SparkSession, path: str, rows: Mapping[str, DataFrame], tables: Mapping[str, Table] = TABLES) -> int:
    """Loads the rows into their tables, all or none, and returns the number of the manifest. Rows have their table's key and order columns; the order column isn't stored."""
    if unknown := set(rows) - set(tables):
        raise ValueError(f"unknown tables {sorted(unknown)}")
    number, manifest = current(spark, path)
    load = uuid.uuid4().hex
    for name, new in rows.items():
        t = tables[name]
        new = last_wins(new, t.key, [t.order]).drop(t.order)
        parts = [None] if t.part is None else [r[0] for r in new.select(t.part).distinct().collect()]  # the runs of one load
        for k, part in enumerate(parts):
            own = new if part is None else new.filter(F.col(t.part) == part)
            where = "" if part is None else str(part)
            there = manifest.get(name, {}).get(where)
            if there is not None:
                own = upsert(spark.read.parquet(f"{path}/{there}"), own, t.key)
            folder = f"{name}/{load}-{k}"
            own.write.parquet(f"{path}/{folder}")
            manifest.setdefault(name, {})[where] = folder
    fs, folder = _files(spark, path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    staged, final = make(folder, f".{load}.json"), make(folder, MANIFEST.format(number + 1))
    out = fs.create(staged, False)
    out.write(bytearray(json.dumps(manifest, ensure_ascii=False).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(staged, final):
        fs.delete(staged, False)
        raise RuntimeError(f"another load has published manifest {number + 1}: load again")
    return number + 1


def corpus_rows(corpus: DataFrame) -> dict[str, DataFrame]:
    """Documents, exercises and questions of a nested corpus (readers.corpus) as rows. Exercises that share an id within their file are numbered there in order of appearance; their questions' ids follow."""
    d = corpus.withColumn("ord", F.monotonically_increasing_id())
    documents = d.select(F.col("doc_file").alias("id"), "doc_file", "fingerprint", "track", "level", "source_chars", "noise_chars", "ratio", "ord")
    # The rank counts the same ids before an exercise in its own array, so no rows are brought together.
    ids = F.transform("exercises", lambda e: e["id"])
    ranked = F.transform("exercises", lambda e, i: F.struct(e.alias("e"), F.size(F.filter(F.slice(ids, F.lit(1), i + 1), lambda x: x == e["id"])).alias("rank"), i.alias("place")))
    e = d.select("doc_file", "ord", F.explode(ranked).alias("x")).select("doc_file", F.struct("ord", "x.place").alias("ord"), "x.rank", "x.e.*")
    e = e.withColumn("id", F.when(F.col("rank") > 1, F.concat("id", F.lit("~"), F.col("rank").cast("string"))).otherwise(F.col("id")))
    exercises = e.select("id", F.col("doc_file").alias("document_id"), "title", "level", "track", "preamble", "unattributed", "line", "rank", "ord")
    q = e.select(F.col("id").alias("exercise_id"), "ord", F.posexplode("questions").alias("nth", "q"))
    questions = q.select(F.concat("exercise_id", F.lit("#"), F.regexp_replace("q.id", "^[^#]*#", "")).alias("id"), "exercise_id", "q.number", "q.text", "q.solution", F.coalesce("q.figure_missing", F.lit(False)).alias("figure_missing"), "q.line", F.struct("ord", "nth").alias("ord"))
    return {"documents": documents, "exercises": exercises, "questions": questions}


def run_rows(run: DataFrame, name: str, protocol: str = "{}", signature: str | None = None) -> dict[str, DataFrame]:
    """A labelling run (readers.runs of one path) and its labels as rows; its questions' ids are those of corpus_rows()."""
    from gaugeworks.operators.measures import ranked_id, with_rank

    e = with_rank(run, ["exercise_id"], ["run", "at"], "__rank").withColumn("exercise_id", ranked_id(F.col("exercise_id"), F.col("__rank")))
    q = e.select("exercise_id", "at", F.posexplode("questions").alias("nth", "q"))
    labels = q.select(F.concat("exercise_id", F.lit("#"), F.regexp_replace("q.question_id", "^[^#]*#", "")).alias("question_id"), "q.status", "q.language", "at", "nth", F.posexplode("q.labels").alias("k", "l"))
    labels = labels.select("question_id", "l.concept_id", F.lit(name).alias("run"), "l.quote", "status", "language", F.struct("at", "nth", "k").alias("ord"))
    one = run.sparkSession.range(1).select(F.lit(name).alias("id"), F.lit(signature).cast("string").alias("signature"), F.lit(protocol).alias("protocol"), F.lit(0).alias("ord"))
    return {"runs": one, "labels": labels}
