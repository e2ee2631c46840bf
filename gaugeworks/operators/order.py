"""Numbers of values in their order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.sources.shared import written


def numbered(values: DataFrame, name: str) -> DataFrame:
    """Each distinct value that isn't null, with `code`, its number from 0 in ascending order. Ranges of values are numbered apart, and each range starts after the rows of those before."""
    ranged = written(values.select(name).filter(F.col(name).isNotNull()).distinct().repartitionByRange(name).withColumn("__range", F.spark_partition_id()), "codes")
    # One row a range.
    totals = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__all"))
    totals = totals.select("__range", (F.sum("__all").over(W.orderBy("__range")) - F.col("__all")).alias("__before"))
    nth = F.row_number().over(W.partitionBy("__range").orderBy(name)) - 1
    return ranged.join(F.broadcast(totals), "__range").select(name, (F.col("__before") + nth).cast("long").alias("code"))
