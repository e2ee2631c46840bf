"""Passages found literally in documents, without comparing every passage with every document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANCHOR = 5
SHORT_AT_ONCE = 500


def containing(docs: DataFrame, passages: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """(doc id, item id) of all documents whose text holds a passage literally.

    A passage's inner words stand in the text as whole words, so up to ANCHOR of them are its anchor. Hashes of the anchors meet hashes of the texts'
    word sequences in one equi-join that moves ids and hashes alone; what meets is verified, each text once for all its passages. Passages of one or
    two words have no inner word: they are looked for in the texts directly, SHORT_AT_ONCE of them in one scan.
    """
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    p = passages.select(F.col(item_id).alias("__item"), F.col("text").alias("__passage"), F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("w"))
    p = p.withColumn("k", F.least(F.lit(ANCHOR), F.greatest(F.size("w") - 2, F.lit(0))))
    anchors = p.filter("k > 0").select("__item", F.xxhash64(F.array_join(F.slice("w", F.lit(2), F.col("k")), " ")).alias("__gram")).distinct()
    lengths = F.array(*[F.lit(k) for k in range(1, ANCHOR + 1)])
    sequences = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.size("ws") - k + 1, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice("ws", i, k), " ")))
    used = [r["k"] for r in p.filter("k > 0").select("k").distinct().collect()]  # at most ANCHOR values
    key = F.xxhash64("text").alias("__text")
    texts = docs.filter("text IS NOT NULL").select(F.col(doc_id).alias("__doc"), "text", key)
    grams = F.array_distinct(F.flatten(F.transform(F.filter(lengths, lambda k: k.isin(*used) if used else F.lit(False)), sequences)))
    met = texts.select("__doc", "__text", words.alias("ws")).select("__doc", "__text", F.explode(grams).alias("__gram")).join(anchors, "__gram").select("__doc", "__text", "__item").distinct()
    asked = met.join(p.filter("k > 0").select("__item", "__passage"), "__item").groupBy(F.col("__doc").alias("__of"), F.col("__text").alias("__same")).agg(F.collect_list(F.struct("__item", "__passage")).alias("asked"))
    held = texts.join(asked, F.col("__doc").eqNullSafe(F.col("__of")) & (F.col("__text") == F.col("__same"))).select("__doc", F.explode(F.filter("asked", lambda a: F.contains(F.col("text"), a["__passage"]))).alias("a"))
    found = held.select(F.col("__doc").alias(doc_id), F.col("a.__item").alias(item_id))
    short = [(r["__item"], r["__passage"]) for r in p.filter("k = 0").select("__item", "__passage").toLocalIterator()]
    for at in range(0, len(short), SHORT_AT_ONCE):
        some = F.array(*[F.struct(F.lit(i).alias("item"), F.lit(t).alias("passage")) for i, t in short[at : at + SHORT_AT_ONCE]])
        hit = texts.select("__doc", F.explode(F.filter(some, lambda s: F.contains(F.col("text"), s["passage"]))).alias("s"))
        found = found.unionByName(hit.select(F.col("__doc").alias(doc_id), F.col("s.item").alias(item_id)))
    return found.distinct()
