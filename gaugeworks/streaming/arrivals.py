"""Arrivals as a stream: new papers, each content once, each run loaded idempotently.

Two ways to let each content pass once: unique() keeps fingerprints in the query's state, in memory, and suits streams of millions; once() keeps them as a table on disk that outlives the
query, and needs memory for one batch alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.functions.text import fingerprint, newlines
from gaugeworks.sources.sinks import write_run


def arriving(spark: SparkSession, path: str, glob: str = "*.md", per_trigger: int = 1000) -> DataFrame:
    """A stream of doc_file, text, fingerprint from new files; the checkpoint remembers which files were taken."""
    rows = spark.readStream.option("pathGlobFilter", glob).option("wholetext", True).option("maxFilesPerTrigger", per_trigger).schema("value string").text(path)
    rows = rows.select(F.col("_metadata.file_name").alias("doc_file"), newlines(F.col("value")).alias("text"))
    return rows.withColumn("fingerprint", fingerprint(F.col("text")))


def unique(stream: DataFrame) -> DataFrame:
    """Each content once over the whole life of the stream; state is one fingerprint per content, never a text."""
    return stream.dropDuplicates(["fingerprint"])


DIGITS = 2
REGISTRY = "fingerprint string, batch long, prefix string"


def registered(spark: SparkSession, path: str) -> DataFrame:
    """Fingerprints that have passed, with the batch that let them pass first."""
    try:
        return spark.read.schema(REGISTRY).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY)


def once(path: str, each: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A batch writer that gives `each` the rows whose content has not passed before, one for each content, the first by doc_file.

    The registry at `path` is a table in folders by the fingerprint's first DIGITS digits; of it a batch reads the folders of its own fingerprints and keeps what it has in common with them. A batch's
    fingerprints, bounded by the files of a trigger, are broadcast. They are registered after `each` is done, with the batch's number: a batch that was interrupted anywhere comes again with the same
    rows and passes the same ones, as what it registered itself doesn't count.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.groupBy("fingerprint").agg(F.min_by(F.struct(*batch.columns), F.col("doc_file")).alias("x")).select("x.*").withColumn("prefix", F.left("fingerprint", F.lit(DIGITS))).persist()
        try:
            prefixes = [r[0] for r in rows.select("prefix").distinct().collect()]  # 16 ** DIGITS at most
            known = registered(spark, path).filter(F.col("prefix").isin(prefixes) & (F.col("batch") != number))
            known = known.join(F.broadcast(rows.select("fingerprint")), "fingerprint", "left_semi").select("fingerprint").distinct()
            new = rows.join(F.broadcast(known), "fingerprint", "left_anti")
            each(new.select(*batch.columns), number)
            new.select("fingerprint", F.lit(number).cast("long").alias("batch"), "prefix").repartition("prefix").write.mode("append").partitionBy("prefix").parquet(path)
        finally:
            rows.unpersist()

    return write


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Takes all that is there, calls `each` per batch and ends. A batch that was interrupted comes again, so `each` must be idempotent."""
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def unseen(batch: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Rows of a batch whose key the registry lacks: what was paid for is not paid for again."""
    return batch.join(registry.select(key), key, "left_anti")


def load_run(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that replaces the runs of a batch and no others."""
    return lambda batch, _: write_run(batch, path)
