"""What the operators share: the shared folder, stored tables, Arrow batch bounds, the label split."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from types import ModuleType
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. Only where that is unset and Spark runs on one machine, as in tests, a new one is made."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds what one Arrow batch holds, as texts can be long."""
    if not 0 < int(spark.conf.get(BATCH_ROWS, "10000")) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Writes df once to the shared folder and returns the reading of it: lineage ends there, and lost executors cost only what reads it."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (
        df.write.option("compression", compression)
        .option("parquet.block.size", 16 << 20)
        .option("parquet.block.size.row.check.min", 1)
        .option("parquet.page.size.row.check.min", 1)
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows whose label may not be learned: crc32 of the id as text leaves 2 when divided by 4. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(name: str, make: Callable[[], T]) -> T:
    """What one task made, for later tasks of the same Python worker: vocabularies and bounded memories of words are built once, not once a task."""
    store = sys.modules.setdefault("_gaugeworks_kept", ModuleType("_gaugeworks_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]
