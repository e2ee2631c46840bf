"""As-of join: for each left row the last right row before it (or the next after it) with the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def asof_before(left: DataFrame, right: DataFrame, key: str, time: str, value: str, bucket_seconds: int = 86400, order: str | None = None) -> DataFrame:
    """left with <value>: the right value of the greatest time strictly before; null if there is none.

    Time is cut into buckets. Rows meet inside (key, bucket), and a small table of the last value of each (key, bucket)
    carries over what lies in earlier buckets: a key that holds a third of all rows is spread over its buckets. Of right rows at one time the
    greatest value counts.
    """
    bucket = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (bucket_seconds * 1_000_000)).cast("long")
    r = right.select(key, F.col(time).alias("__t"), F.col(value).alias("__v"), bucket.alias("__b"))
    ends = r.groupBy(key, "__b").agg(F.max(F.struct("__t", "__v")).alias("__end"))
    l = left.withColumn("__b", bucket)
    points = ends.select(key, "__b", "__end").unionByName(l.select(key, "__b").distinct().withColumn("__end", F.lit(None).cast(ends.schema["__end"].dataType)))
    points = points.groupBy(key, "__b").agg(F.max("__end").alias("__end"))
    carried = points.withColumn("__carry", F.max("__end").over(W.partitionBy(key).orderBy("__b").rowsBetween(W.unboundedPreceding, -1))).select(key, "__b", "__carry")
    columns = left.columns
    both = l.select(key, "__b", F.col(time).alias("__t"), F.lit(None).cast(r.schema["__v"].dataType).alias("__v"), F.struct(*columns).alias("__row"))
    both = both.unionByName(r.select(key, "__b", "__t", "__v", F.lit(None).cast(both.schema["__row"].dataType).alias("__row")))
    here = F.max(F.when(F.col("__row").isNull(), F.struct("__t", "__v"))).over(W.partitionBy(key, "__b").orderBy(F.col("__t"), F.col("__row").isNull()).rowsBetween(W.unboundedPreceding, -1))
    found = both.withColumn("__here", here).filter("__row IS NOT NULL")
    out = found.join(carried, [key, "__b"], "left")
    return out.select("__row.*", F.coalesce("__here.__v", "__carry.__v").alias(value))
