"""Regular-expression probes over text zones.

Most patterns can't match without some literal: one automaton of all probes' literals passes over each text once, and only the probes whose literal stands in it are run.
A handful of probes needs no automaton: Spark looks for their literals itself, and no text goes to Python.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.text import snippet


@dataclass(frozen=True)
class Probe:
    name: str
    pattern: str
    anti: str | None = None
    status: str = "open"
    concept: str | None = None

    def __post_init__(self) -> None:
        if not self.name:
            raise ValueError("a probe needs a name")
        if (spark := SparkSession.getActiveSession()) is not None:
            check_patterns(spark, [self])


def check_patterns(spark: SparkSession, probes: Sequence[Probe]) -> None:
    """Refuses patterns that Spark can't run: they are in Java's dialect."""
    for p in probes:
        for pattern in (p.pattern, p.anti):
            try:
                if pattern is not None:
                    spark._jvm.java.util.regex.Pattern.compile(pattern)
            except Exception as e:
                raise ValueError(f"probe {p.name}: {pattern!r} is no pattern: {getattr(e, 'java_exception', e)}") from None


def plain(text: str) -> str:
    """A form with one spelling of the letters that patterns may take for each other when case is ignored: small ones of A-Z and Latin-1, i, k and s for their like. Letter by letter, so that a part of a text stays a part."""
    if text.isascii():
        return text.lower()
    try:
        return text.encode("latin-1").translate(_LATIN).decode("latin-1")
    except UnicodeEncodeError:
        return text.translate(_LOWER)


_LOWER = {c: c + 32 for c in (*range(ord("A"), ord("Z") + 1), *range(0xC0, 0xDF)) if c not in (0xC5, 0xD7)} | {0x130: ord("i"), 0x131: ord("i"), 0x212A: ord("k"), 0x17F: ord("s")}
_LATIN = bytes(_LOWER.get(c, c) for c in range(256))
# What Python reads otherwise than Java.
_OTHERWISE = re.compile(r"\(\?[a-zA-Z]*x|\[\^?\[|&&|\\[QExuNpPhHRXGZ]")
# Letters that letters beyond A-Z equal when case is ignored by Unicode's rules.
_SHARED = "iksIKS"
# Letters of Latin-1 that no letter but their own large one equals.
_PAIRED = {chr(c) for c in range(0xC0, 0xFF)} - set("åÅ÷×ß")
#: Alternatives of one literal, from optional letters, that are followed at once.
MOST_SPELLINGS = 8
#: Up to so many probes Spark looks for the literals itself.
FEW = 16
#: Texts that go to Python at once.
BATCH = 500
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def required(pattern: str, paired: bool = False) -> list[str] | None:
    """Literals (in plain()) of which every match holds at least one, as long as can be; None where there is no such list or the dialects may differ. paired: letters beyond A-Z, and those with others that equal them, count where plain() has one spelling of them."""
    from re import _constants as c
    from re import _parser

    if _OTHERWISE.search(pattern):
        return None
    try:
        tree = _parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return None
    folded = re.search(r"\(\?[a-zA-Z]*i", pattern) is not None
    wide = folded and re.search(r"\(\?[a-zA-Z]*[uU]", pattern) is not None
    worth = lambda words: min(map(len, words))

    def best(items) -> list[str] | None:  # noqa: ANN001
        found, runs = [], [""]
        sure = lambda x: (paired and (x < 128 or chr(x) in _PAIRED)) or not ((folded and x > 127) or (wide and chr(x) in _SHARED))
        for op, arg in [*items, (None, None)]:
            if op is c.LITERAL and sure(arg):
                runs = [r + chr(arg) for r in runs]
                continue
            if op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[:2] == (0, 1) and len(arg[2]) == 1 and arg[2][0][0] is c.LITERAL and sure(arg[2][0][1]) and 2 * len(runs) <= MOST_SPELLINGS:
                runs = [x for r in runs for x in (r, r + chr(arg[2][0][1]))]
                continue
            if all(runs):
                found.append(sorted({plain(r) for r in runs}))
            runs = [""]
            if op is c.SUBPATTERN:
                found.append(best(arg[-1]))
            elif op is c.BRANCH:
                each = [best(b) for b in arg[1]]
                found.append(None if None in each else sorted({w for words in each for w in words}))
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT) and arg[0] > 0:
                found.append(best(arg[2]))
            elif op is c.ATOMIC_GROUP:
                found.append(best(arg))
        return max(filter(None, found), key=worth, default=None)

    return best(tree)


def candidates(text: str, probes: Sequence[Probe]):  # noqa: ANN201
    """array<int>: the numbers of the probes that may match a text, in order."""
    literals = [required(p.pattern, paired=True) or () for p in probes]
    if len(probes) <= FEW:
        # A literal without letters stands in the text as it is; a pattern with letters is cheaper run than its text brought to one form.
        bare = lambda ws: ws and all(w.upper() == w.lower() for w in ws)
        may = [F.when(F.exists(F.array(*map(F.lit, ws)), lambda w: F.contains(F.col(text), w)) if bare(ws) else F.lit(True), k) for k, ws in enumerate(literals)]
        return F.array_compact(F.array(*may)) if may else F.array().cast("array<int>")
    words: dict[str, list[int]] = {}
    for k, ws in enumerate(literals):
        for w in ws:
            words.setdefault(w, []).append(k)
    always = [k for k, ws in enumerate(literals) if not ws]

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def present(texts: pd.Series) -> pd.Series:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for w, own in words.items():
            machine.add_word(w, own)
        if words:
            machine.make_automaton()
        found = lambda t: sorted({k for _, own in machine.iter(plain(t)) for k in own}.union(always)) if words else always
        return texts.map(lambda t: [] if t is None else found(t))

    return present(F.col(text))


def zones(documents: DataFrame) -> DataFrame:
    """Texts of a nested corpus (doc_file, exercises of preamble, unattributed and questions of text and solution) as rows: doc_file, zone, text. Empty ones are left out."""
    e = documents.select("doc_file", F.explode("exercises").alias("e"))
    q = e.select("doc_file", F.explode("e.questions").alias("q"))
    parts = [
        e.select("doc_file", F.lit("preamble").alias("zone"), F.col("e.preamble").alias("text")),
        e.select("doc_file", F.lit("unattributed").alias("zone"), F.col("e.unattributed").alias("text")),
        q.select("doc_file", F.lit("question").alias("zone"), F.col("q.text").alias("text")),
        q.select("doc_file", F.lit("solution").alias("zone"), F.col("q.solution").alias("text")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("length(text) > 0")


def attest(rows: DataFrame, probes: Sequence[Probe], origin: str, text: str = "text", around: int = 80) -> DataFrame:
    """One row per (probe, zone) with a match: probe, origin, excerpt, rejected.

    Only the first match of a zone counts; an anti-pattern in its excerpt rejects the zone. A text meets the probes that may match it and no others; the probes, as many as the caller lists, are broadcast.
    """
    spark = rows.sparkSession
    check_patterns(spark, probes)
    if not 0 < int(spark.conf.get(BATCH_ROWS, "10000")) <= BATCH:
        spark.conf.set(BATCH_ROWS, str(BATCH))
    named = spark.createDataFrame([(k, p.name, p.pattern, p.anti) for k, p in enumerate(probes)], "k int, probe string, pattern string, anti string")
    met = rows.select(F.col(origin).alias("origin"), F.col(text).cast("string").alias("text")).filter("text IS NOT NULL")
    x = met.select("origin", "text", F.explode(candidates("text", probes)).alias("k")).join(F.broadcast(named), "k").filter(F.rlike("text", F.col("pattern")))
    start = F.length(F.element_at(F.split("text", F.col("pattern"), 2), 1))
    x = x.withColumn("start", start).withColumn("size", F.length(F.expr("regexp_extract(text, pattern, 0)")))
    x = x.withColumn("excerpt", snippet(F.col("text"), F.col("start"), F.col("start") + F.col("size"), around))
    # Where no probe has an anti-pattern, who doesn't ask for excerpts needn't have them made.
    rejected = F.coalesce(F.rlike("excerpt", F.col("anti")), F.lit(False)) if any(p.anti is not None for p in probes) else F.lit(False)
    return x.select("probe", "origin", "excerpt", rejected.alias("rejected"))


def admission(attested: DataFrame, probes: Sequence[Probe], least: int = 2) -> DataFrame:
    """By probe: distinct origins, zones, rejected zones and verdict; probes without a match are listed with zeros."""
    named = attested.sparkSession.createDataFrame([(p.name, p.status) for p in probes], "probe string, status string")
    kept = attested.groupBy("probe").agg(
        F.count_distinct(F.when(~F.col("rejected"), F.col("origin"))).alias("origins"),
        F.count_if(~F.col("rejected")).alias("zones"),
        F.count_if("rejected").alias("rejected"),
    )
    out = named.join(kept, "probe", "left").fillna(0, ["origins", "zones", "rejected"])
    admitted = F.col("origins") >= least
    change = F.when((F.col("status") == "created") & ~admitted, "regression").when(F.col("status").isin("candidate", "open") & admitted, "promotion").otherwise("none")
    return out.select("probe", "status", "origins", "zones", "rejected", admitted.alias("admitted"), change.alias("change"))


def report(attested: DataFrame, most: int = 12, size: int = 300) -> DataFrame:
    """Up to `most` excerpts of each probe, in order of origin: a report's head."""
    rank = F.row_number().over(W.partitionBy("probe").orderBy("origin", "excerpt"))
    return attested.filter("NOT rejected").withColumn("rank", rank).filter(F.col("rank") <= most).select("probe", "rank", "origin", F.substring("excerpt", 1, size).alias("excerpt"))


def named(probes: Sequence[Probe], part: str) -> list[Probe]:
    """The probes whose name contains `part`."""
    return [p for p in probes if part in p.name]


def ordered(admitted: DataFrame) -> DataFrame:
    """Probes attested by most files first, then by name."""
    return admitted.orderBy(F.col("origins").desc(), "probe")


def first_by_file(attested: DataFrame, most: int = 3) -> DataFrame:
    """The first excerpts of each probe in each file that no anti-pattern rejects."""
    rank = F.row_number().over(W.partitionBy("probe", "origin").orderBy("excerpt"))
    return attested.filter("NOT rejected").withColumn("rank", rank).filter(F.col("rank") <= most).select("probe", "origin", "rank", "excerpt")


def report_json(admitted: DataFrame, excerpts: DataFrame) -> DataFrame:
    """One JSON text by probe: its verdict and the excerpts of report(). probe, body."""
    own = excerpts.groupBy("probe").agg(F.array_sort(F.collect_list(F.struct("rank", "origin", "excerpt"))).alias("excerpts"))
    x = admitted.join(own, "probe", "left")
    return x.select("probe", F.to_json(F.struct("probe", "status", "origins", "zones", "rejected", "admitted", "change", F.coalesce("excerpts", F.array().cast("array<struct<rank:int,origin:string,excerpt:string>>")).alias("excerpts"))).alias("body"))
