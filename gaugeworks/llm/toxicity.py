"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: how densely a lexicon's terms occur (hits per thousand words, their weights, distinct terms), how
many hits stand near a word of the second person, the rates of capitals, digits and punctuation, the rate of obfuscated words
(letters around digits or signs) and the lexicon hits that appear when these signs are read as letters.

The lexicon is a short fixed list and what the labelled sample teaches: words and word beginnings that texts labelled 1 hold
beyond chance by the log-likelihood ratio. Trees see a text
through the lexicon of the other half of the sample, so they do not trust it more than new texts warrant. Calibration uses
rows that the trees did not learn from, weighted back to the label rates before sampling.

The labelled sample is bounded: at most about MOST_TOXIC rows labelled 1 and MOST_CLEAN labelled 0, by a hash of
the id. It alone meets its texts (by a broadcast of ids, whose number is bounded so), and the trees learn on Spark.

Defined results: null and empty texts score like texts without hits; without usable labels all scores are 0; of repeated ids in the labels the
larger label counts, null labels are left out; repeated rows get equal scores; an empty table gives no rows; extra
columns are ignored by score() and kept by keep_clean().
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import held_out, kept, small_batches, stored

MOST_TOXIC, MOST_CLEAN = 3000, 6000
LEAST_TERM, LONGEST_STEM, TERMS = 4, 8, 500
LEAST_G = 14.0
NEAR = 40
CUT = 0.3
SEED = 5
#: Words of the second person in the languages at hand, and signs read as letters.
YOU = ("you", "your", "yours", "du", "dich", "dir", "dein", "deine", "euch", "tu", "te", "toi", "vous", "votre", "ton", "tes", "tú", "ti", "usted", "ustedes", "vosotros", "tus")
#: Insults that any English list holds; each counts from the start with the weight SEED_WEIGHT, learned terms add to these.
INSULTS = ("idiot", "moron", "stupid", "loser", "trash", "scum", "worthless", "pathetic", "disgusting", "clown", "dumb", "fool", "garbage", "imbecile", "jerk", "filth", "vermin", "degenerate", "bastard", "asshole", "bitch")
SEED_WEIGHT = 3.0
LEET = str.maketrans("013457@$!*", "oieastasi ")
CLASSES = ("other", "lower", "upper", "digit", "blank", "mark")
NAMES = ("hits", "log_hits", "density", "weighted", "heaviest", "distinct", "near_you", "you_rate", "upper_rate", "digit_rate", "mark_rate", "odd_rate", "odd_hits", "log_words")


def letter_kinds() -> np.ndarray:
    """Class of each code point of all planes: letters without case count as lower, marks that belong to letters as other."""
    kinds = np.full(0x110000, CLASSES.index("mark"), dtype=np.uint8)
    for k in range(len(kinds)):
        c = chr(k)
        if c.isupper() or c.istitle():
            kinds[k] = CLASSES.index("upper")
        elif c.isalpha():
            kinds[k] = CLASSES.index("lower")
        elif c.isnumeric():
            kinds[k] = CLASSES.index("digit")
        elif c.isspace():
            kinds[k] = CLASSES.index("blank")
        elif unicodedata.category(c)[0] in "MC":
            kinds[k] = CLASSES.index("other")
    return kinds


class Features:
    """Dense features of texts for one lexicon {term: weight}; a term ending in * is a word beginning."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            stem = term.removesuffix("*")
            old = self.lexicon.get(stem, None)
            now = {term.endswith("*"): weight}
            self.lexicon.add_word(stem, (stem, (old[1] if old else {}) | now))
        self.empty = not lexicon
        self.lexicon.make_automaton()
        self.you = re.compile(r"\b(?:" + "|".join(YOU) + r")\b")
        self.odd = re.compile(r"[^\W\d_][0134579@$!*]+[^\W\d_]")
        self.kinds = kept("toxicity kinds", letter_kinds)

    def hits(self, low: str) -> list[tuple[int, int, float, str]]:
        """(start, end, weight, term) of lexicon terms in lower-cased text; of those at one place the heaviest."""
        best: dict[int, tuple[int, int, float, str]] = {}
        if self.empty or not low:
            return []
        for last, (stem, forms) in self.lexicon.iter(low):
            start = last + 1 - len(stem)
            if start and low[start - 1].isalpha():
                continue
            whole = last + 1 == len(low) or not low[last + 1].isalpha()
            weight = max(forms.get(True, 0.0), forms.get(False, 0.0) if whole else 0.0)
            if weight > 0 and (start not in best or weight > best[start][2]):
                best[start] = (start, last + 1, weight, stem)
        return list(best.values())

    def row(self, text: str | None) -> list[float]:
        text = text or ""
        low = text.lower()
        if len(low) != len(text):
            low = "".join(c.lower()[0] for c in text)
        words = low.count(" ") + low.count("\n") + 1
        if text.isascii():
            kinds = np.bincount(self.kinds[np.frombuffer(text.encode(), dtype=np.uint8)], minlength=len(CLASSES)) / max(1, len(text))
        else:
            kinds = np.bincount(self.kinds[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")], minlength=len(CLASSES)) / len(text)
        hits = self.hits(low)
        you = self.you.findall(low)
        near = sum(1 for s, e, _, _ in hits if self.you.search(low[max(0, s - NEAR) : e + NEAR])) if you and hits else 0
        odd = len(self.odd.findall(low))
        odd_hits = max(0, len(self.hits(low.translate(LEET))) - len(hits)) if odd else 0
        return [
            float(len(hits)),
            math.log1p(len(hits)),
            1000 * len(hits) / words,
            1000 * sum(h[2] for h in hits) / words,
            max((h[2] for h in hits), default=0.0),
            float(len({h[3] for h in hits})),
            float(near),
            1000 * len(you) / words,
            *(float(kinds[CLASSES.index(k)]) for k in ("upper", "digit", "mark")),
            1000 * odd / words,
            float(odd_hits),
            math.log(words),
        ]


def featured(lexicon: dict[str, float]) -> Column:
    """Column expression over `text`: the features as array<double>."""

    @F.pandas_udf("array<double>")
    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(lexicon)
        for texts in batches:
            yield pd.Series([features.row(t) for t in texts])

    return rows(F.col("text").cast("string"))


def labelled_sample(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN) -> DataFrame:
    """text, toxic, fold (0..5) and weight of a bounded sample of labelled rows that are not held out."""
    known = labels.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, most_toxic / max(1, sizes.get(1, 0)))).otherwise(min(1.0, most_clean / max(1, sizes.get(0, 0))))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    ids = known.filter(draw < share).select(F.col("doc_id").alias("__gw_id"), "toxic", (1 / share).alias("weight"), F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(6)).cast("int").alias("fold"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("__gw_id"))
    return stored(rows.select("text", "toxic", "weight", "fold"), "toxicity-sample")


def terms_of(text: str | None) -> set[str]:
    words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
    out = {w for w in words if len(w) >= LEAST_TERM}
    return out | {w[:k] + "*" for w in out for k in range(LEAST_TERM, min(len(w), LONGEST_STEM) + 1)}


def lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """Lexicons of the even folds, the odd folds and all: terms with their log odds. At most TERMS each."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: dict[int, Counter] = {0: Counter(), 1: Counter(), 2: Counter(), 3: Counter()}
        for x in batches:
            for text, toxic, fold in zip(x["text"], x["toxic"], x["fold"], strict=True):
                n[2 * (fold % 2) + toxic].update(terms_of(text))
        # A term that no text labelled 1 of this task holds may still be one elsewhere, so counts of all are passed on.
        terms = list(set().union(*n.values()))
        if terms:
            yield pd.DataFrame({"term": terms} | {f"n{k}": [c[t] for t in terms] for k, c in n.items()})

    sums = [F.sum(f"n{k}").alias(f"n{k}") for k in range(4)]
    counts = sample.select("text", "toxic", "fold").mapInPandas(count, "term string, n0 long, n1 long, n2 long, n3 long").groupBy("term").agg(*sums).filter("n1 + n3 >= 3")
    counts = stored(counts, "toxicity-terms")
    total = sample.groupBy((F.col("fold") % 2).alias("half"), "toxic").count().collect()
    size = {(r["half"], r["toxic"]): r["count"] for r in total}
    out = []
    for halves in ((0,), (1,), (0, 1)):
        bad, good = (F.lit(0), F.lit(0))
        for h in halves:
            bad, good = bad + F.col(f"n{2 * h + 1}"), good + F.col(f"n{2 * h}")
        n_bad, n_good = (sum(size.get((h, t), 0) for h in halves) for t in (1, 0))
        share = n_bad / max(1, n_bad + n_good)
        part = lambda k, p: F.when(k > 0, k * F.log(k / (bad + good) / p)).otherwise(0.0)
        g = 2 * (part(bad, max(share, 1e-9)) + part(good, max(1 - share, 1e-9)))
        odds = F.log((bad + 0.5) / (n_bad + 1.0)) - F.log((good + 0.5) / (n_good + 1.0))
        top = counts.select("term", odds.alias("w"), g.alias("g"), bad.alias("b")).filter((F.col("b") >= 3) & (F.col("w") > 0.5) & (F.col("g") >= LEAST_G)).orderBy(F.col("g").desc(), "term").limit(TERMS)
        out.append(dict.fromkeys(INSULTS, SEED_WEIGHT) | {r["term"]: round(r["w"], 6) for r in top.collect()})
    return out


def scorer(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN):  # noqa: ANN201
    """Learns, and returns a function that adds the column __gw_score to a DataFrame with a column text."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, most_toxic, most_clean)
    if sample.select("toxic").distinct().count() < 2:
        return lambda x: x.withColumn("__gw_score", F.lit(0.0))
    even, odd, every = lexicons(sample)
    halves = [sample.filter(f"fold % 2 = {h}").withColumn("features", array_to_vector(featured(lex))) for h, lex in ((0, odd), (1, even))]
    rows = stored(halves[0].unionByName(halves[1]).select("features", F.col("toxic").cast("double").alias("toxic"), "weight", "fold"), "toxicity-features").coalesce(4).cache()
    # Folds 4 and 5 calibrate. Where one of the two lacks a label the sample is too small to be divided.
    split = rows.groupBy((F.col("fold") >= 4).alias("late")).agg(F.count_distinct("toxic").alias("n")).filter("n = 2").count() == 2
    learn, calibrate = (rows.filter("fold < 4"), rows.filter("fold >= 4")) if split else (rows, rows)
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=25, maxDepth=4, stepSize=0.2, subsamplingRate=0.8, minInstancesPerNode=5, seed=SEED).fit(learn)
    raw = lambda x: trees.transform(x).withColumn("__gw_raw", vector_to_array("probability")[1])
    isotonic = IsotonicRegression(featuresCol="__gw_raw", labelCol="toxic", weightCol="weight", predictionCol="__gw_iso").fit(raw(calibrate).select("__gw_raw", "toxic", "weight"))
    rows.unpersist()
    # The calibration is a few points of a step-wise line: interpolated with built-in functions. Raw probabilities keep order on its plateaus.
    bounds, values = isotonic.boundaries.toArray().tolist(), isotonic.predictions.toArray().tolist()

    def add(x: DataFrame) -> DataFrame:
        y = raw(x.withColumn("features", array_to_vector(featured(every))).withColumn("__gw_all", F.lit(0)))
        p = F.col("__gw_raw")
        flat = F.lit(values[0])
        for a, b, u, v in zip(bounds, bounds[1:], values, values[1:], strict=False):
            flat = F.when(p > a, F.lit(u) + (F.least(p, F.lit(b)) - a) * ((v - u) / (b - a) if b > a else 0.0)).otherwise(flat) if b > a else F.when(p >= b, F.lit(v)).otherwise(flat)
        return y.withColumn("__gw_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.999 * flat + 0.001 * p))).drop("features", "rawPrediction", "probability", "prediction", "__gw_raw", "__gw_all")

    return add


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    rows = scorer(docs, labels)(docs.select("doc_id", held_out().alias("held_out"), "text"))
    return rows.select("doc_id", "held_out", F.col("__gw_score").alias("score"), (F.col("__gw_score") >= CUT).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows that score under the cut. All columns stay."""
    packed = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__gw_row"))
    kept_rows = scorer(docs, labels)(packed).filter(F.col("__gw_score") < cut)
    return kept_rows.select("__gw_row.*")
