"""A syllabus to sections and units, as relations over its numbered lines, and its restrictive mentions.

docs: doc_file, text. What a line means depends on the last heading before it: windows over (document, line). The rows of one
table and the headings of one document are folded as arrays, as their state is small and local.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.offsets import running
from gaugeworks.functions.text import newlines
from gaugeworks.sources.shared import settle

# Marks of the syllabus at hand, in Java's dialect.
HEADING = r"(?U)^(#{1,6})\s+(.*?)\s*$"
NUMBER = r"(?U)^(\d+(?:\.\d+)*|[A-Z](?:\.\d+)*)\s+(.+)$"
SEMESTER = r"(?U)\bS(?:1|2|3-4)\b"
PRACTICE = r"(?iuU)mise\s+en\s+(?:œ|oe)uvre"
RULE = r"^\|[\s:|-]+\|$"
BULLET = r"(?U)^\s*[-*•]\s+(.+)$"
LEAST_PROSE, LEAST_BULLET, LEAST_MENTION = 40, 20, 15


def clean(text: Column) -> Column:
    """Without spans, images, breaks, stars and repeated blanks."""
    t = F.regexp_replace(F.regexp_replace(text, r"<span[^>]*>|</span>", ""), r"!\[\]\([^)]*\)", "")
    t = F.replace(F.replace(t, F.lit("<br>"), F.lit(" ")), F.lit("*"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(t, "[ \t]+", " "), r"(?U)^\s+|\s+$", "")


def semester(text: Column) -> Column:
    """The last semester mark."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(SEMESTER), F.lit(0)), F.lit(-1))


def lines(docs: DataFrame) -> DataFrame:
    x = docs.select("doc_file", F.posexplode(F.split(newlines(F.col("text")), "\n")).alias("i", "raw"))
    return x.select("doc_file", (F.col("i") + 1).alias("line_no"), F.regexp_replace("raw", r"(?U)\s+$", "").alias("line"))


def headings(rows: DataFrame) -> DataFrame:
    """doc_file, line_no, level, number, title, practice, section_id, path.

    A dotted number takes its path from the last section registered under the number before its last dot; levels
    count for headings without a number only.
    """
    raw = clean(F.regexp_extract("line", HEADING, 2))
    h = rows.filter(F.col("line").rlike(HEADING)).select("doc_file", "line_no", F.length(F.regexp_extract("line", HEADING, 1)).alias("level"), raw.alias("raw"))
    number = F.when(F.col("raw").rlike(NUMBER), F.regexp_extract("raw", NUMBER, 1))
    title = F.when(F.col("raw").rlike(NUMBER), F.regexp_extract("raw", NUMBER, 2)).otherwise(F.col("raw"))
    title = F.regexp_replace(F.regexp_replace(F.regexp_replace(title, SEMESTER, ""), r"\(\s*\)", ""), r"(?U)\s+", " ")
    h = h.select("doc_file", "line_no", "level", number.alias("number"), F.regexp_replace(title, r"^[ .)(]+|[ .)(]+$", "").alias("title"))
    h = h.withColumn("practice", F.col("title").rlike(PRACTICE))
    h = h.withColumn("section_id", F.coalesce("number", F.substring(F.replace(F.lower("title"), F.lit(" "), F.lit("-")), 1, 40)))
    hs = h.groupBy("doc_file").agg(F.array_sort(F.collect_list(F.struct("line_no", "level", "number", "title", "practice", "section_id"))).alias("hs"))
    start = F.expr("named_struct('known', cast(array() as array<struct<number:string,path:array<string>>>), 'stack', cast(array() as array<struct<level:int,title:string>>), 'paths', cast(array() as array<array<string>>))")

    def step(acc: Column, x: Column) -> Column:
        parent = F.regexp_replace(x["number"], r"\.[^.]*$", "")
        above = F.try_element_at(F.filter(acc["known"], lambda k: k["number"] == parent), F.lit(-1))["path"]
        lower = F.filter(acc["stack"], lambda s: s["level"] < x["level"])
        own = F.array(x["title"])
        none = F.expr("cast(array() as array<string>)")
        path = F.when(x["number"].isNull(), F.concat(F.transform(lower, lambda s: s["title"]), own)).when(F.contains(x["number"], F.lit(".")), F.concat(F.coalesce(above, none), own)).otherwise(own)
        known = F.when(x["number"].isNotNull(), F.concat(acc["known"], F.array(F.struct(x["number"].alias("number"), path.alias("path"))))).otherwise(acc["known"])
        stack = F.when(x["practice"], lower).otherwise(F.concat(lower, F.array(F.struct(x["level"].alias("level"), x["title"].alias("title")))))
        return F.struct(known.alias("known"), stack.alias("stack"), F.concat(acc["paths"], F.array(path)).alias("paths"))

    paths = F.aggregate("hs", start, step, lambda acc: acc["paths"])
    out = hs.select("doc_file", F.explode(F.arrays_zip(F.col("hs"), paths.alias("path"))).alias("x"))
    return out.select("doc_file", "x.hs.*", "x.path")


def cells(line: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(F.trim(line), r"^\|", ""), r"\|$", "")
    return F.transform(F.split(inner, r"\|", -1), clean)


def _opens(cell: Column, before: Column) -> Column:
    """Does a cell begin an entry: a capital, after nothing or after the end of a sentence (semester marks aside)?"""
    end = F.regexp_replace(F.regexp_replace(before, SEMESTER, ""), r"(?U)\s+$", "")
    return cell.rlike(r"(?U)^\p{Lu}") & ((before == "") | end.rlike(r"[.:;!?]$"))


def entries(table: Column) -> Column:
    """The number, from 1, of the logical row that each of a table's physical rows array<struct<line_no, left, right>> belongs to: a new one opens where both columns do. Time in proportion to the rows."""
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("left"), F.lit("").alias("right"))

    def step(now: Column, x: Column) -> Column:
        opens = (now["left"] != "") & _opens(x["left"], now["left"]) & ((x["right"] == "") | _opens(x["right"], now["right"]))
        last = lambda c: F.when(x[c] != "", x[c]).otherwise(now[c]).alias(c)
        fresh = F.struct((now["n"] + 1).alias("n"), x["left"].alias("left"), x["right"].alias("right"))
        return F.when((now["n"] == 0) | opens, fresh).otherwise(F.struct(now["n"].alias("n"), last("left"), last("right")))

    return running(table, start, step, lambda now, x: now["n"], "array<int>", after=True)


@dataclass
class Syllabus:
    """units: doc_file, id, section_id, kind, left, right, text, first_line, last_line, semester; sections; rejected: doc_file, id, reason, line."""

    units: DataFrame
    sections: DataFrame
    rejected: DataFrame


def segment(docs: DataFrame, rejected_kinds: Sequence[str] = ()) -> Syllabus:
    # A long text is one row: its lines are made once and dealt out.
    rows = settle(lines(docs).repartition("doc_file", "line_no"))
    h = settle(headings(rows))
    w = W.partitionBy("doc_file").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    x = rows.join(h.select("doc_file", "line_no", "number", "practice", F.col("section_id").alias("own")), ["doc_file", "line_no"], "left")
    is_h = F.col("practice").isNotNull()
    x = x.withColumn("section_id", F.last(F.when(is_h & ~F.col("practice"), F.col("own")), ignorenulls=True).over(w))
    annex = F.last(F.when(is_h & ~F.col("practice") & F.col("number").isNotNull(), F.substring_index("number", ".", 1).rlike("^[A-Z]$")), ignorenulls=True).over(w)
    x = x.withColumn("kind", F.when(F.last("practice", ignorenulls=True).over(w), "mise_en_oeuvre").when(annex, "annexe").otherwise("prose"))
    pipe, blank = F.col("line").startswith("|"), F.col("line") == ""
    bullet = ~is_h & ~pipe & F.col("line").rlike(BULLET) & (F.col("kind") == "annexe")
    shape = F.when(is_h, "heading").when(pipe, "table").when(blank, "blank").when(bullet, "bullet").otherwise("prose")
    x = x.withColumn("shape", shape)
    x = x.withColumn("block", F.sum(F.coalesce((F.col("shape") != F.lag("shape").over(W.partitionBy("doc_file").orderBy("line_no"))).cast("int"), F.lit(0))).over(w))
    x = settle(x.filter("section_id IS NOT NULL AND shape IN ('table', 'bullet', 'prose')").select("doc_file", "line_no", "line", "section_id", "kind", "shape", "block"))

    t = x.filter("shape = 'table'").filter(~F.col("line").rlike(RULE)).withColumn("c", cells(F.col("line"))).filter("size(c) >= 2")
    t = t.select("doc_file", "block", "section_id", "line_no", F.col("c")[0].alias("left"), F.col("c")[1].alias("right"))
    t = t.filter(~(F.lower("left").startswith("notions") & F.lower("right").startswith("commentaires")))
    t = t.groupBy("doc_file", "block", "section_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "left", "right"))).alias("rows"))
    t = t.select("doc_file", "block", "section_id", F.explode(F.arrays_zip("rows", entries(F.col("rows")).alias("nth"))).alias("x")).select("doc_file", "block", "section_id", "x.nth", "x.rows.*")
    # Each logical row on its own, so that a long table is put together by many tasks.
    t = t.groupBy("doc_file", "block", "section_id", "nth").agg(F.array_sort(F.collect_list(F.struct("line_no", "left", "right"))).alias("rows"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))
    said = lambda c: F.array_join(F.filter(F.transform("rows", lambda x: x[c]), lambda v: v != ""), " ").alias(c)
    t = t.select("doc_file", "section_id", F.lit("table").alias("kind"), said("left"), said("right"), F.lit("").alias("text"), "first_line", "last_line")
    t = t.filter("left <> '' OR right <> ''").withColumn("semester", semester(F.concat_ws(" ", "left", "right")))

    p = x.filter("shape = 'prose'").groupBy("doc_file", "block", "section_id", "kind").agg(F.array_sort(F.collect_list(F.struct("line_no", clean(F.col("line")).alias("c")))).alias("ls"), F.min("line_no").alias("first_line"))
    joined = F.array_join(F.filter(F.transform("ls", lambda l: l["c"]), lambda c: c != ""), " ")
    p = p.select("doc_file", "section_id", "kind", F.lit("").alias("left"), F.lit("").alias("right"), joined.alias("text"), "first_line", (F.col("first_line") + 1).alias("last_line")).filter(F.length("text") >= LEAST_PROSE).withColumn("semester", semester(F.col("text")))

    b = x.filter("shape = 'bullet'").select("doc_file", "section_id", F.lit("annexe").alias("kind"), F.lit("").alias("left"), F.lit("").alias("right"), clean(F.regexp_extract("line", BULLET, 1)).alias("text"), F.col("line_no").alias("first_line"), F.col("line_no").alias("last_line"), F.lit(None).cast("string").alias("semester"))
    b = b.filter(F.length("text") >= LEAST_BULLET)

    units = t.unionByName(p).unionByName(b)
    nth = F.row_number().over(W.partitionBy("doc_file", "section_id", "kind").orderBy("first_line"))
    units = settle(units.withColumn("id", F.concat_ws("/", "section_id", "kind", F.when(nth < 100, F.lpad(nth.cast("string"), 2, "0")).otherwise(nth.cast("string")))))
    out = (F.col("kind") != "table") & F.col("kind").isin(list(rejected_kinds)) if rejected_kinds else F.lit(False)
    rejected = units.filter(out).select("doc_file", "id", F.concat(F.lit("kind left out: "), "kind").alias("reason"), F.col("first_line").alias("line"))
    return Syllabus(units.filter(~out), h.filter("NOT practice"), rejected)


def leave_out(s: Syllabus, titles: Sequence[str] = (), prefixes: Sequence[str] = ()) -> Syllabus:
    """Units of sections whose title holds one of `titles` or whose number is, or is under, one of `prefixes` become rejections."""
    hit = F.lit(False)
    for t in titles:
        hit |= F.contains(F.lower("title"), F.lit(t.lower()))
    for p in prefixes:
        hit |= (F.col("number") == p) | F.coalesce(F.col("number").startswith(f"{p}."), F.lit(False))
    gone = s.sections.filter(F.coalesce(hit, F.lit(False))).select("doc_file", "section_id").distinct()
    rejected = s.units.join(gone, ["doc_file", "section_id"], "left_semi").select("doc_file", "id", F.lit("section left out").alias("reason"), F.col("first_line").alias("line"))
    return Syllabus(s.units.join(gone, ["doc_file", "section_id"], "left_anti"), s.sections, s.rejected.unionByName(rejected))


def by_section(units: DataFrame) -> DataFrame:
    """Sections in order of appearance with their numbers of units."""
    return units.groupBy("doc_file", "section_id").agg(F.min("first_line").alias("first_line"), F.count(F.lit(1)).alias("units")).orderBy("doc_file", "first_line")


def mentions(docs: DataFrame, words: Sequence[str], sections: DataFrame) -> DataFrame:
    """Sentences that hold one of the restrictive words: doc_file, id, phrase, line_no, section_id (of the greatest start at or before the line)."""
    inner = "|".join("\\Q" + x + "\\E" for x in words)
    pattern = rf"(?iu)[^.;]*?(?:{inner})[^.;]*[.;]?"
    line = F.trim(F.regexp_replace(F.regexp_replace("line", r"<[^>]+>|\*\*|\|", " "), r"(?U)\s+", " "))
    found = lines(docs).select("doc_file", "line_no", F.posexplode(F.regexp_extract_all(line, F.lit(pattern), F.lit(0))).alias("i", "phrase"))
    found = found.withColumn("phrase", F.trim("phrase")).filter(F.length("phrase") >= LEAST_MENTION)
    both = found.select("doc_file", "line_no", F.lit(1).alias("k"), "i", "phrase", F.lit(None).cast("string").alias("sec")).unionByName(sections.select("doc_file", "line_no", F.lit(0).alias("k"), F.lit(0).alias("i"), F.lit(None).cast("string").alias("phrase"), F.col("section_id").alias("sec")))
    w = W.partitionBy("doc_file").orderBy("line_no", "k", "i")
    both = both.withColumn("section_id", F.coalesce(F.last("sec", ignorenulls=True).over(w), F.lit(""))).filter("k = 1")
    n = F.row_number().over(W.partitionBy("doc_file").orderBy("line_no", "i"))
    return both.select("doc_file", F.concat(F.lit("m"), F.when(n < 1000, F.lpad(n.cast("string"), 3, "0")).otherwise(n.cast("string"))).alias("id"), "phrase", "line_no", "section_id")


def classified(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Mentions with their class (id, scope, object, reason); unknown ids drop out. Only an excluded object allows labels outside the catalogue."""
    return found.join(classes, "id").withColumn("outside_allowed", F.col("scope") == "objet_exclu")


def admissible(s: Syllabus, expected: int, least_share: float, least_numbered: float) -> DataFrame:
    """By document: sections, share with numbers, and whether it looks like the syllabus expected."""
    n = s.sections.groupBy("doc_file").agg(F.count(F.lit(1)).alias("sections"), F.round(F.avg(F.col("number").isNotNull().cast("double")), 6).alias("numbered"))
    return n.withColumn("ok", (F.col("sections") >= int(expected * least_share)) & (F.col("numbered") >= least_numbered))
