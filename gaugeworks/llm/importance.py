"""Resampling towards a target distribution: documents drawn by hashed n-gram importance weights and Gumbel noise.

1. A 256-byte table lower-cases A-Z and blanks every separator byte; what bytes.split yields are the words. Bytes of 128 and more are letters, so UTF-8 needs no decoding.
2. Features are runs of 1 to LONGEST words. zlib.crc32 goes on from the checksum of the run before, so a longer run costs one more word.
3. Counters of each Arrow batch reduce features to buckets; Spark adds them up by bucket. Both tables' counts have at most `buckets` rows, so they come to the driver, whatever the input's size.
4. A second pass over the texts adds up the bucket gains of each document. Texts are read twice and never stored or shuffled.
5. The draw orders (score, doc_id) over range partitions; ranks are places in a partition plus the rows of those before. No row goes to one task.

Defined results: a null text, or one without words, has no features, weight 0 and is never drawn while `least_words` is over 0; a null id is hashed as the empty
text and comes first among equal scores; repeated rows are rows of their own, in an order by id, features and weight; an empty target gives every
bucket the gain of t = T = 0; an empty table gives no rows; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.common import small_batches, stored

LONGEST, BUCKETS, LEAST_WORDS, SEED = 3, 10_000, 20, 42
#: As numerator and denominator.
SHARE = (5, 100)
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


def checksums(own: list[bytes], longest: int = LONGEST) -> list[int]:
    """crc32 of every run of 1 to `longest` words joined by one space, repeats included."""
    more = [b" " + w for w in own]
    level = list(map(crc32, own))
    out = level
    for k in range(1, longest):
        level = list(map(crc32, more[k:], level))
        out = out + level
    return out


def feature_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts by bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[int] = Counter()
        for x in batches:
            for t in x["text"]:
                seen.update([c % buckets for c in checksums(words(t), longest)])
        yield pd.DataFrame({"bucket": list(seen.keys()), "n": list(seen.values())}, dtype="int64")

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, dtype=np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    m = len(source)
    all_s, all_t = float(source.sum() + m), float(target.sum() + m)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, the same for an id wherever it is drawn."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED, id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            ids = [None if pd.isna(i) else int(i) for i in x["doc_id"]]
            rows = []
            for i, t in zip(ids, x["text"], strict=True):
                own = words(t)
                found = np.array(checksums(own, longest), dtype=np.int64)
                weight = int(gain[found % len(gain)].sum())
                rows.append((len(own), len(found), weight, weight + noise(i, seed)))
            out = pd.DataFrame(rows, columns=["n_words", "n_features", "weight", "score"], dtype="int64")
            out.insert(0, "doc_id", pd.array(ids, dtype="Int64"))
            yield out

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(weigh, "doc_id long, n_words long, n_features long, weight long, score long")


def _placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, seen = TaskContext.get().partitionId(), 0
    for x in batches:
        yield x.assign(part=part, at=np.arange(seen, seen + len(x)))
        seen += len(x)


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED, id_col: str = "doc_id") -> DataFrame:
    """Per row of docs: doc_id, n_features, weight, score, rank (its place in the draw, null if not drawn), n_words. Of the rows with at least `least_words` words the share (rounded down) with the highest scores is drawn, ties to the smaller id."""
    small_batches(docs.sparkSession)
    scored = stored(scores(docs, gains(feature_counts(docs, buckets, longest), feature_counts(target, buckets, longest)), longest, seed, id_col), "importance-scores")
    able = F.col("n_words") >= least_words
    wanted = share[0] * scored.filter(able).count() // share[1]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.col("weight")]
    dealt = scored.filter(able).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(dealt.mapInPandas(_placed, "doc_id long, n_words long, n_features long, weight long, score long, part int, at long"), "importance-order")
    # One row a partition: small enough for a broadcast and for one window.
    before = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = before.select("part", (F.sum("rows").over(W.orderBy("part")) - F.col("rows")).alias("before"))
    rank = F.col("before") + F.col("at") + 1
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    drawn = placed.join(F.broadcast(before), "part").withColumn("rank", F.when(rank <= wanted, rank)).select(*columns)
    return drawn.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")).select(*columns))
