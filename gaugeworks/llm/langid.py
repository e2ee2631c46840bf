"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters' vectors, each permuted
(rotated) by its place; a document bundles (sums) the vectors of all its n-grams, a language those of its training
documents; the language with the largest cosine wins. As bundling is linear, a document is its n-gram counts
times the matrix of n-gram vectors, one matrix product for a batch of documents.

Profiles are centred on their common mean, as n-grams shared by all languages say nothing. They come from a
sample of at most PER_LANGUAGE expected training documents of each language, chosen by a hash of the id, whose counts are
summed on the executors.

Defined results: null text or text without letters gives `und` with score 0; with no training rows all is `und`;
ties go to the first language in order; a learned language is any non-null lang value of the training rows;
repeated rows get equal answers; extra columns are ignored by identify() and kept by keep_known().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import held_out, kept, small_batches

UND = "und"
DIMS = 1024
N = 3
SEED = 7
#: Letter classes, of which n-gram ids are numbers to this base: 0 is the gap between words, 1..26 a-z, then Latin-1's letters; any other letter is its code point.
LETTERS = 1 << 21
#: Classes below this one are a-z and Latin-1: their n-grams' vectors are kept.
COMMON = 64
AT_ONCE = 4096
#: Columns of kept n-gram vectors (128 MB); beyond it they are made anew.
MOST_COLUMNS = 1 << 15
PER_LANGUAGE = 2000


def letter_classes() -> np.ndarray:
    """Class of each code point of all planes: 0 for what is no letter; upper case as lower case."""
    table = np.zeros(0x110000, dtype=np.int32)
    latin = {}
    for c in range(len(table)):
        ch = chr(c)
        if not ch.isalpha():
            continue
        low = ord(ch.lower()[0])
        if 97 <= low <= 122:
            table[c] = low - 96
        elif low < 256:
            table[c] = latin.setdefault(low, 27 + len(latin))
        else:
            table[c] = low
    return table


class LetterVectors:
    """The random vector of each letter class, drawn from a seed of its own; remembered as bits."""

    def __init__(self) -> None:
        self.bits: dict[int, np.ndarray] = {}

    def __getitem__(self, letters: int | np.ndarray) -> np.ndarray:
        every = np.atleast_1d(letters)
        for c in every.tolist():
            if c not in self.bits:
                self.bits[c] = np.frombuffer(np.random.default_rng([SEED, c]).bytes(DIMS // 8), dtype=np.uint8)
        out = np.unpackbits(np.stack([self.bits[c] for c in every.tolist()]), axis=1).astype(np.float32) * 2 - 1
        return out if np.ndim(letters) else out[0]


class Profiler:
    """Turns texts into n-gram counts and these into vectors. N-grams of common letters have columns, numbered as they turn up, MOST_COLUMNS at most; when these are full all are dropped. N-grams of other letters are made for each batch."""

    def __init__(self) -> None:
        self.classes = letter_classes()
        self.letters = LetterVectors()
        self.column = np.full(COMMON**N, -1, dtype=np.int32)
        self.matrix = np.zeros((0, DIMS), dtype=np.float32)

    def grams_of(self, text: str) -> np.ndarray:
        """N-gram ids of a text; runs of other characters count as one gap."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kind = np.concatenate([[0], self.classes[code], [0]]).astype(np.int64)
        kind = kind[np.append(True, (kind[1:] != 0) | (kind[:-1] != 0))]
        if len(kind) < N:
            return np.zeros(0, dtype=np.int64)
        ids = np.zeros(len(kind) - N + 1, dtype=np.int64)
        for k in range(N):
            ids = ids * LETTERS + kind[k : len(kind) - N + 1 + k]
        return ids

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        """Bound n-gram vectors: the product of the letters' vectors, each rotated by its place."""
        out = np.ones((len(ids), DIMS), dtype=np.float32)
        for k in range(N):
            letters, at = np.unique(ids // LETTERS ** (N - 1 - k) % LETTERS, return_inverse=True)
            if len(letters):
                out *= np.roll(self.letters[letters], k, axis=1)[at]
        return out

    def bundle(self, texts: list[np.ndarray]) -> np.ndarray:
        """A vector for each list of n-gram ids."""
        every = np.concatenate(texts)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        place, common = np.zeros(len(every), dtype=np.int64), np.ones(len(every), dtype=bool)
        for k in range(N):
            letter = every >> (N - 1 - k) * (LETTERS.bit_length() - 1) & (LETTERS - 1)
            common &= letter < COMMON
            place = place * COMMON + (letter & (COMMON - 1))
        new = np.unique(place[common & (self.column[place] < 0)])
        if len(self.matrix) + len(new) > MOST_COLUMNS:
            self.column[:] = -1
            self.matrix = self.matrix[:0]
            new = np.unique(place[common])[:MOST_COLUMNS]
        if len(new):
            self.column[new] = len(self.matrix) + np.arange(len(new))
            ids = sum((new // COMMON**k % COMMON) * LETTERS**k for k in range(N))
            self.matrix = np.concatenate([self.matrix, self.vectors(ids)])
        common &= self.column[place] >= 0
        out = self.summed(len(texts), row[common], self.column[place[common]], self.matrix)
        if not common.all():
            other, at = np.unique(every[~common], return_inverse=True)
            for k in range(0, len(other), AT_ONCE):
                own = (at >= k) & (at < k + AT_ONCE)
                out += self.summed(len(texts), row[~common][own], at[own] - k, self.vectors(other[k : k + AT_ONCE]))
        return out

    @staticmethod
    def summed(n: int, row: np.ndarray, column: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """Counts by row and column, times the matrix."""
        width = len(matrix)
        return np.bincount(row * width + column, minlength=n * width).reshape(n, width).astype(np.float32) @ matrix


def profiles(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and their vectors, learned from text and lang of the rows that are not held out."""
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return [], np.zeros((0, DIMS), dtype=np.float32)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])[F.col("lang")]
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = kept("profiler", Profiler)
        for x in batches:
            for lang, texts in x.groupby("lang")["text"]:
                g, n = np.unique(np.concatenate([p.grams_of(t) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": g, "n": n})

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, total = kept("profiler", Profiler), {}
        for x in batches:
            for lang, own in x.groupby("lang"):
                n = own["n"].to_numpy(np.float64)
                got = np.append(n @ p.vectors(own["gram"].to_numpy(np.int64)), n.sum())
                total[lang] = total[lang] + got if lang in total else got
        for lang, v in total.items():
            yield pd.DataFrame({"lang": lang, "dim": np.arange(DIMS + 1), "v": v.round().astype(np.int64)})

    counts = rows.filter(draw < share).select("lang", F.col("text").cast("string").alias("text")).mapInPandas(count, "lang string, gram long, n long")
    sums = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).mapInPandas(bundle, "lang string, dim int, v long")
    # DIMS + 1 rows for each language, however many n-grams: the sums of whole numbers, and last the number of n-grams.
    got = sums.groupBy("lang", "dim").agg(F.sum("v").alias("v")).toPandas().sort_values(["lang", "dim"])
    langs = sorted(got["lang"].unique())
    out = got["v"].to_numpy(np.float64).reshape(len(langs), DIMS + 1)
    return langs, (out[:, :DIMS] / out[:, DIMS:]).astype(np.float32)


def predictor(langs: list[str], protos: np.ndarray) -> Column:
    """Column expression over `text`: struct of lang and score."""
    centre = protos.mean(axis=0) if len(langs) > 1 else np.zeros(DIMS, dtype=np.float32)
    unit = protos - centre
    unit = unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = kept("profiler", Profiler)
        for texts in batches:
            lang, score = np.full(len(texts), UND, dtype=object), np.zeros(len(texts))
            todo, grams, size = [], [], 0

            def flush(todo: list[int], grams: list[np.ndarray], lang: np.ndarray = lang, score: np.ndarray = score) -> None:
                v = p.bundle(grams) / np.array([[len(g)] for g in grams]) - centre
                cos = (v @ unit.T) / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                lang[todo] = [langs[k] for k in cos.argmax(axis=1)]
                score[todo] = np.clip(cos.max(axis=1), 0.0, 1.0)

            for k, text in enumerate(texts):
                ids = p.grams_of(text) if text is not None and langs else np.zeros(0, dtype=np.int64)
                if len(ids):
                    todo.append(k)
                    grams.append(ids)
                    size += len(ids)
                    if size > 1 << 18 or len(todo) == 128:
                        flush(todo, grams)
                        todo, grams, size = [], [], 0
            if todo:
                flush(todo, grams)
            yield pd.DataFrame({"lang": lang, "score": score})

    return predict(F.col("text").cast("string"))


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    small_batches(docs.sparkSession)
    guess = predictor(*profiles(docs, per_language))
    return docs.select("doc_id", held_out().alias("held_out"), guess.alias("g")).select("doc_id", "held_out", F.col("g.lang").alias("lang_pred"), F.col("g.score").alias("score"))


def keep_known(docs: DataFrame, languages: list[str] | None = None, least: float = 0.0, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows in a known language: not `und`, one of `languages` if given, with a score of `least` or more. All columns stay."""
    small_batches(docs.sparkSession)
    g = docs.withColumn("__gw_lang", predictor(*profiles(docs, per_language)))
    ok = (F.col("__gw_lang.lang") != UND) & (F.col("__gw_lang.score") >= least)
    if languages is not None:
        ok &= F.col("__gw_lang.lang").isin(languages)
    return g.filter(ok).select(*[F.col(f"`{c}`") for c in docs.columns])
