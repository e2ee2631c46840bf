"""Packing: optimal length buckets by dynamic programming, token-budget batches inside each bucket.

The global length histogram is aggregated on the executors and reaches the driver with one row for each distinct length: n
distinct lengths need n * (n + 1) / 2 tokens or more, so even 1e13 tokens have under 4.5 million, and real corpora some thousands. The
dynamic program over it is exact. The best start of a last bucket never moves left as its end moves right, so each layer is
solved by halving in O(n log n). Rows are numbered inside their
bucket by a range partitioning on (bucket, id): no bucket is ever gathered in one task.

Defined results: a null or blank text has length 0 and goes to the first bucket, where it
counts as one token so that batches stay bounded; a document longer than the budget makes a
batch of its own; ties in the dynamic program take the lowest boundary; repeated ids are
separate rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.common import small_batches, stored

def word_count(text: str = "text") -> Column:
    """Tokens of a text: maximal runs without blanks; null counts as none."""
    return F.coalesce(F.size(F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets over the sorted distinct lengths with the least total padding.

    cost(i, j) = lengths[j] * (documents i..j) - (tokens i..j); best[k][j] = min over i of best[k-1][i-1] + cost(i, j).
    In whole numbers: exact while padded tokens stay under 2 ** 63.
    """
    n = len(lengths)
    if n == 0:
        return []
    x = lengths.astype(np.int64)
    docs = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    tokens = np.concatenate([[0], np.cumsum(x * counts)])
    best = x * docs[1:] - tokens[1:]
    cuts = [np.zeros(n, dtype=np.int64)]
    for _ in range(1, min(buckets, n)):
        now, cut = _layer(best, x, docs, tokens)
        cuts.append(cut)
        best = now
    ends, j = [], n - 1
    for cut in reversed(cuts):
        ends.append(int(lengths[j]))
        if cut[j] == 0:
            break
        j = int(cut[j]) - 1
    return sorted(ends)


def _layer(best: np.ndarray, x: np.ndarray, docs: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One more bucket: the least cost of each end j and the lowest start i of its last bucket (0: no further bucket). All middles of one depth are solved at once, each between the answers of its neighbours."""
    n = len(x)
    now, cut = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    before = np.concatenate([[0], best[:-1]])
    spans = np.array([[0, n - 1, 0, n - 1]])
    while len(spans):
        lo, hi, left, right = spans.T
        mid = (lo + hi) // 2
        width = np.minimum(mid, right) - left + 1
        first = np.concatenate([[0], np.cumsum(width)[:-1]])
        i = np.arange(width.sum()) - np.repeat(first - left, width)
        j = np.repeat(mid, width)
        total = before[i] + x[j] * (docs[j + 1] - docs[i]) - (tokens[j + 1] - tokens[i])
        least = np.minimum.reduceat(total, first)
        at = np.flatnonzero(total == np.repeat(least, width))
        start = i[at[np.searchsorted(at, first)]]
        now[mid], cut[mid] = least, start
        spans = np.concatenate([np.stack([lo, mid - 1, left, start], axis=1), np.stack([mid + 1, hi, start, right], axis=1)])
        spans = spans[spans[:, 0] <= spans[:, 1]]
    return now, cut


def boundaries(sized: DataFrame, buckets: int) -> list[int]:
    """Bucket bounds for a DataFrame with column n_tokens: one aggregation, one row for each distinct length to the driver."""
    rows = sized.groupBy("n_tokens").count().toPandas().sort_values("n_tokens")
    return best_boundaries(rows["n_tokens"].to_numpy(np.int64), rows["count"].to_numpy(np.int64), buckets)


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, seen = TaskContext.get().partitionId(), {}
    for x in batches:
        at = x.groupby("bucket").cumcount() + x["bucket"].map(lambda b: seen.get(b, 0))
        for b, n in x["bucket"].value_counts().items():
            seen[b] = seen.get(b, 0) + n
        yield x.assign(part=part, at=at.astype("int64"))


def pack(docs: DataFrame, buckets: int = 16, budget: int = 32768, n_tokens: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket (its ordinal), bucket_length, batch (inside the bucket), slot (inside the batch), padding.

    A batch of bucket b holds budget // bucket_length documents, so its padded size stays within the budget.
    """
    spark = docs.sparkSession
    small_batches(spark, 10000)
    sized = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), (word_count() if n_tokens is None else n_tokens).alias("n_tokens")), "packing-lengths")
    ends = boundaries(sized, buckets)
    ordinal = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]) if ends else F.expr("array(0L)"), lambda e: e < F.col("n_tokens")))
    ranged = sized.withColumn("bucket", ordinal).repartitionByRange("bucket", F.col("doc_id").asc_nulls_first(), "n_tokens")
    rows = stored(
        ranged.sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "n_tokens").mapInPandas(_numbered, "doc_id long, n_tokens long, bucket int, part int, at long"),
        "packing-rows",
    )
    # A range partition meets few buckets: this table has at most partitions + buckets rows, and so may be broadcast.
    starts = rows.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("rows"))
    starts = starts.select("bucket", "part", (F.sum("rows").over(W.partitionBy("bucket").orderBy("part")) - F.col("rows")).alias("start"))
    length = F.element_at(F.array(*[F.lit(e).cast("long") for e in ends or [0]]), F.col("bucket") + 1)
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1)))).cast("long")
    return (
        rows.join(F.broadcast(starts), ["bucket", "part"])
        .withColumn("bucket_length", length)
        .withColumn("rank", F.col("start") + F.col("at"))
        .select(
            "doc_id",
            "n_tokens",
            "bucket",
            "bucket_length",
            F.floor(F.col("rank") / capacity).cast("long").alias("batch"),
            (F.col("rank") % capacity).cast("long").alias("slot"),
            (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
        )
    )
