"""Papers to exercises, questions and solutions, as relations.

docs: doc_file, text. Markers (headings, question and solution marks) come from patterns with their places; everything
order-dependent is a window over (document, place). A text is cut once, at all its marks, and travels in one row.

The stages in order: marks -> exercise boundaries -> pieces -> questions with attached solutions -> grouping by part ->
track propagation -> absorption of groups without questions -> conservation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.offsets import matches, running
from gaugeworks.functions.text import clean_block, exact_round, fingerprint, newlines, slug
from gaugeworks.sources.shared import settle

# The marks of the papers at hand, in Java's dialect.
_LEAD = r"^[ \t]{0,3}(?:<span[^>]*></span>)?[ \t]*(?:[-*+][ \t]+)?"
_NUMBER = r"((?:[^\d\n*#.]{1,40}?)\s)?([IVXLC]+(?:\.\d+)*|\d+(?:\.\d+)*)"
QUESTION = rf"(?mU){_LEAD}(?:#{{1,6}}\s*)?\*{{0,2}}Question\s+{_NUMBER}\s*(\([^)]{{0,40}}\))?\s*\.?\s*\*{{0,2}}\s*$"
QUESTION_INLINE = rf"(?mU){_LEAD}(?:#{{1,6}}[ \t]*)?\*{{0,2}}Question\s+{_NUMBER}\s*(\([^)]{{0,40}}\))?\s*\.?\*{{0,2}}\s*(?=\S)"
HEADING = r"(?mU)^(#{1,6})\s*(.+?)\s*$"
_SOLUTION = r"(?miuU)^[ \t]{0,3}(?:#{1,6}\s*)?\*{0,2}(?:Solution|Corrig[ée]|R[ée]ponse)\s*\*{0,2}\s*"
SOLUTION = _SOLUTION + r":?\s*\*{0,2}\s*$"
SOLUTION_INLINE = _SOLUTION + r":\s*\*{0,2}\s*(?=\S)"
FIGURE = r"(?iuU)!\[\]\([^)]*\)|\b(?:voir|cf\.?|dans|sur|à|de)\s+la\s+figure\b|\bfigure\s+\d+\b|\bci-(?:dessus|dessous|contre)\b"
NOISE = r"(?mU)<span id=\"page-[^\"]*\"></span>|^\s*\d{1,3}\s*$"
TRACKS = (
    ("mpi", r"(?iuU)BANQUES?\s+MPI\b|fili[èe]res?\s+MP\s*[-et]+\s*MPI|banques?\s+MP\s+et\s+MPI|fili[èe]re\s+MPI\b"),
    ("mp_info", r"(?iuU)banques?\s+MP\s+inter-ENS|fili[èe]re\s+MP\b|MP\s+option\s+info"),
)
UNMARKED = "non_marque"
HEAD_CHARS = 4000
PART_SHARE = 0.8
LEAST_RATIO = 0.95


def track_of(text: Column) -> Column:
    out = F.lit(UNMARKED)
    for name, pattern in reversed(TRACKS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def stem(file: Column) -> Column:
    return F.regexp_replace(file, r"\.[^.]*$", "")


def series(number: Column) -> Column:
    return F.when(number.rlike(r"(?U)^\p{L}"), F.substring_index(number, ".", 1)).otherwise("")


def is_roman(mark: Column) -> Column:
    return F.upper(mark).rlike("^[IVXLC]+$")


def part(number: Column) -> Column:
    """Part prefix of a hierarchical number: roman, or digits before a dot."""
    s = series(number)
    head = F.when(F.contains(number, F.lit(".")), F.substring_index(number, ".", 1)).otherwise("")
    return F.when(s != "", F.when(is_roman(s), s).otherwise("")).otherwise(F.when(head.rlike("^[0-9]+$"), head).otherwise(""))


def number_key(number: Column) -> Column:
    """Comparable array of a number's parts without its series; null if a part is neither digits nor roman."""
    values = F.create_map(*[F.lit(x) for kv in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100)) for x in kv])
    body = F.when(number.rlike(r"(?U)^\p{L}") & F.contains(number, F.lit(".")), F.regexp_replace(number, r"^[^.]*\.", "")).otherwise(number)
    pieces = F.split(body, r"\.")

    def roman(p: Column) -> Column:
        letters = F.reverse(F.filter(F.split(F.upper(p), ""), lambda c: c != ""))

        def step(acc: Column, c: Column) -> Column:
            v = F.element_at(values, c)
            return F.struct((acc["sum"] + F.when(v < acc["most"], -v).otherwise(v)).alias("sum"), F.greatest(acc["most"], v).alias("most"))

        return F.aggregate(letters, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("most")), step, lambda acc: acc["sum"])

    plain = lambda p: p.rlike("^[0-9]+$")
    return F.when(F.forall(pieces, lambda p: plain(p) | is_roman(p)), F.transform(pieces, lambda p: F.when(plain(p), p.try_cast("int")).otherwise(roman(p))))


def question_marks(text: Column) -> Column:
    """array<struct<start, end, number>>: both forms, the first wins at one place; the number carries its series."""

    def numbered(x: Column, pattern: str) -> Column:
        m = F.concat(x["match"], F.lit("x")) if pattern is QUESTION_INLINE else x["match"]
        qualifier = F.trim(F.regexp_extract(m, pattern, 1))
        number = F.regexp_extract(m, pattern, 2)
        word = F.substring(F.element_at(F.split(slug(qualifier, "-", 48, "", exact=False), "-"), -1), 1, 10)
        full = F.when((qualifier != "") & (word != ""), F.concat(word, F.lit("."), number)).otherwise(number)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), full.alias("number"))

    a = F.transform(matches(text, QUESTION), lambda x: numbered(x, QUESTION))
    b = F.transform(matches(text, QUESTION_INLINE), lambda x: numbered(x, QUESTION_INLINE))
    return _first_form_first(a, b)


def _first_form_first(a: Column, b: Column) -> Column:
    """Both arrays, without those of b that start where one of a does; each array is computed once."""
    both = F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), lambda x: F.concat(x["a"], F.filter(x["b"], lambda y: ~F.exists(x["a"], lambda z: z["start"] == y["start"]))))
    return F.array_sort(F.element_at(both, 1))


def solution_marks(text: Column) -> Column:
    return _first_form_first(matches(text, SOLUTION), matches(text, SOLUTION_INLINE))


def marks(docs: DataFrame) -> DataFrame:
    """doc_file, kind (q, s or t), pos, end, number, level, title; headings that are question or solution marks are left out."""
    found = docs.select("doc_file", question_marks(F.col("text")).alias("q"), solution_marks(F.col("text")).alias("s"), matches(F.col("text"), HEADING).alias("t"))
    q = found.select("doc_file", F.explode("q").alias("x")).select("doc_file", F.lit("q").alias("kind"), F.col("x.start").alias("pos"), F.col("x.end").alias("end"), "x.number", F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("title"))
    s = found.select("doc_file", F.explode("s").alias("x")).select("doc_file", F.lit("s").alias("kind"), F.col("x.start").alias("pos"), F.col("x.end").alias("end"), F.lit(None).cast("string").alias("number"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("title"))
    t = found.select("doc_file", F.explode("t").alias("x")).select(
        "doc_file", F.lit("t").alias("kind"), F.col("x.start").alias("pos"), F.col("x.end").alias("end"), F.lit(None).cast("string").alias("number"),
        F.length(F.regexp_extract("x.match", HEADING, 1)).alias("level"), F.trim(F.regexp_extract("x.match", HEADING, 2)).alias("title"),
    )
    taken = q.select("doc_file", "pos").unionByName(s.select("doc_file", "pos"))
    return q.unionByName(s).unionByName(t.join(taken, ["doc_file", "pos"], "left_anti").select(q.columns))


def exercise_level(m: DataFrame) -> DataFrame:
    """doc_file, level: the heading level with most groups that hold a question, then fewest without, then the lowest; 1 without headings."""
    t = m.filter("kind = 't'").select("doc_file", "level", "pos", F.col("pos").alias("bound"))
    q = m.filter("kind = 'q'").select("doc_file", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("level"), "pos", F.lit(None).cast("int").alias("bound"))
    w = W.partitionBy("doc_file", "level").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    inside = t.unionByName(q).withColumn("at", F.last("bound", ignorenulls=True).over(w))
    groups = inside.filter("at IS NOT NULL").groupBy("doc_file", "level", "at").agg(F.count_if(F.col("bound").isNull()).alias("n"))
    score = groups.groupBy("doc_file", "level").agg(F.count_if(F.col("n") > 0).alias("full"), F.count_if(F.col("n") == 0).alias("bare"))
    best = F.row_number().over(W.partitionBy("doc_file").orderBy(F.col("full").desc(), "bare", "level"))
    return score.withColumn("best", best).filter("best = 1").select("doc_file", "level")


def boundaries(docs: DataFrame, m: DataFrame) -> DataFrame:
    """doc_file, pos, title of each exercise's begin."""
    t, q = m.filter("kind = 't'"), m.filter("kind = 'q'")
    level = exercise_level(m).withColumnRenamed("level", "chosen")
    tagged = t.join(level, "doc_file").select("doc_file", "pos", "title", (F.col("level") == F.col("chosen")).alias("base"))
    base = tagged.filter("base").select("doc_file", "pos", "title")
    rows = m.filter("kind <> 's'").select("doc_file", "pos", F.when(F.col("kind") == "q", F.col("number")).alias("number"))
    w = W.partitionBy("doc_file").orderBy("pos")
    around = rows.withColumn("before", F.last("number", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))).withColumn("after", F.first("number", ignorenulls=True).over(w.rowsBetween(1, W.unboundedFollowing)))
    around = around.filter("number IS NULL AND before IS NOT NULL AND after IS NOT NULL").select("doc_file", "pos", "before", "after")

    def keyed(name: str) -> Column:
        return F.element_at(F.transform(F.array(F.col(name)), number_key), 1)

    sb, sa, pb, pa = series(F.col("before")), series(F.col("after")), part(F.col("before")), part(F.col("after"))
    a, b = keyed("before"), keyed("after")
    restart = F.when(sb != sa, is_roman(sb) & is_roman(sa)).when((pb != "") & (pa != "") & (pb != pa), True).otherwise(F.coalesce(b <= a, F.lit(False)))
    again = tagged.filter("NOT base").join(around, ["doc_file", "pos"]).filter(restart).select("doc_file", "pos", "title")
    found = base.unionByName(again).distinct()
    start = docs.select("doc_file", F.lit(0).alias("pos"), stem(F.col("doc_file")).alias("title"))
    found = found.unionByName(start.join(found.select("doc_file").distinct(), "doc_file", "left_anti"))
    first_q = q.groupBy("doc_file").agg(F.min("pos").alias("q0"))
    orphan = found.groupBy("doc_file").agg(F.min("pos").alias("b0")).join(first_q, "doc_file").filter("q0 < b0")
    opening = orphan.join(t.select("doc_file", "pos", "title"), "doc_file", "left").groupBy("doc_file").agg(F.max_by("title", F.when(F.col("pos") <= F.col("q0"), F.col("pos"))).alias("title"), F.max(F.when(F.col("pos") <= F.col("q0"), F.col("pos"))).alias("pos"))
    opening = opening.join(start.withColumnRenamed("title", "stem").drop("pos"), "doc_file").select("doc_file", F.coalesce("pos", F.lit(0)).alias("pos"), F.when(F.col("pos").isNull(), F.col("stem")).otherwise(F.col("title")).alias("title"))
    return found.unionByName(opening).distinct()


@dataclass
class Extracted:
    """documents: doc_file, fingerprint, track, level, header, source_chars, noise_chars, marks; exercises: doc_file, ex, id, title, track, preamble, unattributed, line;
    questions: doc_file, ex, ord, id, number, text, solution, figure_missing, line."""

    documents: DataFrame
    exercises: DataFrame
    questions: DataFrame


def pieces(docs: DataFrame, m: DataFrame, bounds: DataFrame) -> DataFrame:
    """One row per event (boundary b, question q, solution s): its content up to the next event, its exercise's ordinal and its line. Event 0 of each document is its header."""
    events = bounds.select("doc_file", F.struct("pos", F.col("pos").alias("end"), F.lit("b").alias("kind"), F.lit(None).cast("string").alias("number"), "title").alias("e"))
    events = events.unionByName(m.filter("kind <> 't'").select("doc_file", F.struct("pos", "end", "kind", "number", F.lit(None).cast("string").alias("title")).alias("e")))
    cuts = events.groupBy("doc_file").agg(F.array_sort(F.collect_list("e")).alias("es"), F.min(F.when(F.col("e.kind") == "b", F.col("e.pos"))).alias("b0"))
    cuts = cuts.withColumn("es", F.filter("es", lambda e: e["pos"] >= F.col("b0")))
    rows = docs.select("doc_file", "text").join(cuts, "doc_file")
    nexts = F.concat(F.transform(F.slice("es", 2, F.size("es")), lambda e: e["pos"]), F.array(F.length("text")))
    cut = F.zip_with("es", nexts, lambda e, n: F.struct(e.alias("e"), F.substring(F.col("text"), e["end"] + 1, n - e["end"]).alias("content"), _lines(F.col("text"), e["pos"]).alias("line")))
    header = F.array(F.struct(F.struct(F.lit(-1).alias("pos"), F.lit(-1).alias("end"), F.lit("h").alias("kind"), F.lit(None).cast("string").alias("number"), F.lit(None).cast("string").alias("title")).alias("e"), F.substring(F.col("text"), F.lit(1), F.col("b0")).alias("content"), F.lit(1).alias("line")))
    out = rows.select("doc_file", F.explode(F.concat(header, cut)).alias("x")).select("doc_file", "x.e.pos", "x.e.kind", "x.e.number", "x.e.title", clean_block(F.col("x.content")).alias("content"), "x.line")
    w = W.partitionBy("doc_file").orderBy("pos")
    return out.withColumn("ex", F.sum((F.col("kind") == "b").cast("int")).over(w))


def _lines(text: Column, pos: Column) -> Column:
    before = F.substring(text, F.lit(1), pos)
    return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1


def fold(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Questions (doc_file, ex, pos, number, nth, text, solution, line) and what of each exercise no question took (doc_file, ex, unattributed).

    A question mark whose number is known, after a solution mark, answers that number's first question. A solution mark
    answers the question before it if nothing answered that one yet; else it stays unattributed.
    """
    own = events.filter("kind IN ('q', 's')")
    w = W.partitionBy("doc_file", "ex").orderBy("pos")
    past = w.rowsBetween(W.unboundedPreceding, -1)
    by_number = W.partitionBy("doc_file", "ex", "number")
    e = own.withColumn("after_s", F.coalesce(F.max((F.col("kind") == "s").cast("int")).over(past), F.lit(0)) == 1)
    e = e.withColumn("first_pos", F.when(F.col("kind") == "q", F.min("pos").over(by_number)))
    e = e.withColumn("answers", (F.col("kind") == "q") & F.col("after_s") & (F.col("pos") > F.col("first_pos")))
    e = e.withColumn("row", (F.col("kind") == "q") & ~F.col("answers"))
    e = e.withColumn("nth", F.sum(F.col("row").cast("int")).over(by_number.orderBy("pos")))
    e = e.withColumn("last_q", F.last(F.when(F.col("row"), F.col("pos")).when(F.col("answers"), F.col("first_pos")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    e = e.withColumn("target", F.when(F.col("answers") | (F.col("kind") == "s"), F.col("last_q")))
    given = e.filter("target IS NOT NULL").withColumn("rn", F.row_number().over(W.partitionBy("doc_file", "ex", "target").orderBy("pos")))
    given = given.withColumn("taken", F.col("answers") | (F.col("rn") == 1))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "content"))), lambda x: x["content"]), c)
    solutions = given.filter("taken").groupBy("doc_file", "ex", F.col("target").alias("pos")).agg(joined("\n\n").alias("solution"))
    left = given.filter("NOT taken").select("doc_file", "ex", "pos", "content").unionByName(e.filter("kind = 's' AND target IS NULL").select("doc_file", "ex", "pos", "content"))
    left = left.filter("content <> ''").groupBy("doc_file", "ex").agg(joined("\n\n").alias("unattributed"))
    questions = e.filter("row").select("doc_file", "ex", "pos", "number", "nth", F.col("content").alias("text"), "line").join(solutions, ["doc_file", "ex", "pos"], "left")
    return questions, left


def recut(questions: DataFrame, left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An unattributed key with question marks of its own answers the last question of each number that has no solution; the first such piece counts."""
    found = left.join(questions.select("doc_file", "ex").distinct(), ["doc_file", "ex"], "left_semi").withColumn("q", question_marks(F.col("unattributed"))).filter("size(q) > 0")
    nexts = F.concat(F.transform(F.slice("q", 2, F.size("q")), lambda x: x["start"]), F.array(F.length("unattributed")))
    cut = F.zip_with("q", nexts, lambda x, n: F.struct(x["start"].alias("at"), x["number"].alias("number"), clean_block(F.substring(F.col("unattributed"), x["end"] + 1, n - x["end"])).alias("piece")))
    head = F.trim(F.regexp_replace(F.substring(F.col("unattributed"), F.lit(1), F.element_at("q", 1)["start"]), r"(?U)^\s+|\s+$", ""))
    parts = found.select("doc_file", "ex", head.alias("head"), F.explode(cut).alias("c")).select("doc_file", "ex", "head", "c.at", "c.number", "c.piece")
    last = questions.groupBy("doc_file", "ex", "number").agg(F.max("pos").alias("pos"))
    open_q = questions.filter("solution IS NULL").select("doc_file", "ex", "pos").join(last, ["doc_file", "ex", "pos"])
    tried = parts.join(open_q, ["doc_file", "ex", "number"], "left").withColumn("rn", F.row_number().over(W.partitionBy("doc_file", "ex", "number").orderBy(F.col("piece") == "", "at")))
    tried = tried.withColumn("takes", F.col("pos").isNotNull() & (F.col("piece") != "") & (F.col("rn") == 1))
    got = tried.filter("takes").select("doc_file", "ex", "pos", F.col("piece").alias("recut"))
    rest = tried.groupBy("doc_file", "ex").agg(F.first("head").alias("head"), F.array_sort(F.collect_list(F.when(~F.col("takes") & (F.col("piece") != ""), F.struct("at", "piece")))).alias("rest"))
    rest = rest.select("doc_file", "ex", F.array_join(F.concat(F.filter(F.array("head"), lambda h: h != ""), F.transform("rest", lambda x: x["piece"])), "\n\n").alias("rest"))
    questions = questions.join(got, ["doc_file", "ex", "pos"], "left").withColumn("solution", F.coalesce("solution", "recut")).drop("recut")
    left = left.join(rest, ["doc_file", "ex"], "left").select("doc_file", "ex", F.coalesce("rest", "unattributed").alias("unattributed"))
    return questions, left


def group_by_part(exercises: DataFrame, questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where most questions of a document carry a part prefix, these prefixes make the exercises.

    exercises: doc_file, ex, id, title, track, preamble, unattributed, line; questions: doc_file, ex, pos, number, ...; the result has new ordinals ex.
    """
    share = questions.groupBy("doc_file").agg((F.count_if(part(F.col("number")) != "") >= PART_SHARE * F.count(F.lit(1))).alias("by_part"))
    docs = share.filter("by_part").select("doc_file")
    q = questions.join(docs, "doc_file", "left_semi").withColumn("part", part(F.col("number")))
    e = exercises.join(docs, "doc_file", "left_semi")
    w = W.partitionBy("doc_file").orderBy("ex", "pos")
    q = q.withColumn("opens", F.coalesce(F.col("part") != F.lag("part").over(w), F.lit(True)).cast("int"))
    q = q.withColumn("grp", F.sum("opens").over(w)).withColumn("first_part", F.first("part").over(W.partitionBy("doc_file", "ex").orderBy("pos")))
    span = q.groupBy("doc_file", "ex").agg(F.min("grp").alias("g0"), F.max("grp").alias("g1"))
    e = e.join(span, ["doc_file", "ex"], "left").withColumn("g1", F.coalesce(F.last("g1", ignorenulls=True).over(W.partitionBy("doc_file").orderBy("ex")), F.lit(0))).withColumn("g0", F.coalesce("g0", "g1"))
    ordered = lambda col, sep, cond: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("ex", F.col(col).alias("v"))))), lambda x: x["v"]), sep)
    pre = e.groupBy("doc_file", F.col("g0").alias("grp")).agg(ordered("preamble", "\n\n", F.col("preamble") != "").alias("preamble"))
    key = e.groupBy("doc_file", F.col("g1").alias("grp")).agg(ordered("unattributed", "", F.col("unattributed") != "").alias("unattributed"))
    opener = q.filter("opens = 1").select("doc_file", "grp", "ex", "part", "first_part", F.col("line").alias("q_line"))
    named = opener.join(e.select("doc_file", "ex", "title", "track"), ["doc_file", "ex"]).select(
        "doc_file", "grp", F.concat(stem(F.col("doc_file")), F.lit("/partie-"), slug(F.col("part"))).alias("id"),
        F.when(F.col("part") == F.col("first_part"), F.col("title")).otherwise(F.concat(F.lit("Partie "), F.col("part"))).alias("title"), "track", F.col("q_line").alias("line"),
    )
    bare = e.filter("g1 = 0").groupBy("doc_file").agg(F.min_by("id", "ex").alias("id"), F.min_by("title", "ex").alias("title"), F.min_by("track", "ex").alias("track"), F.min("line").alias("line")).withColumn("grp", F.lit(0))
    groups = named.unionByName(bare.select(named.columns)).join(pre, ["doc_file", "grp"], "left").join(key, ["doc_file", "grp"], "left").fillna("", ["preamble", "unattributed"])
    new_e = groups.select("doc_file", F.col("grp").cast("long").alias("ex"), "id", "title", "track", "preamble", "unattributed", "line")
    new_q = q.join(named.select("doc_file", "grp", F.col("id").alias("g_id")), ["doc_file", "grp"])
    new_q = new_q.withColumn("ex", F.col("grp").cast("long")).withColumn("id", F.concat("g_id", F.lit("#Q"), "number")).select(questions.columns)
    old_e = exercises.join(docs, "doc_file", "left_anti").select(new_e.columns)
    return old_e.unionByName(new_e), questions.join(docs, "doc_file", "left_anti").unionByName(new_q)


def propagate_track(exercises: DataFrame, documents: DataFrame) -> DataFrame:
    """A title's own mark holds for the exercises after it, up to a title of a higher rank (a smaller level) without one; before any mark and after that the document's track does. Without a column `level` all titles are of one rank."""
    level = F.col("level") if "level" in exercises.columns else F.lit(1)
    mark = track_of(F.col("title"))
    e = exercises.join(documents.select("doc_file", F.col("track").alias("doc_track")), "doc_file")
    titles = e.groupBy("doc_file").agg(F.array_sort(F.collect_list(F.struct("ex", level.alias("level"), F.when(mark != UNMARKED, mark).alias("mark")))).alias("t"))
    state = lambda track, rank: F.struct(track.alias("track"), rank.alias("rank"))
    none = state(F.lit(None).cast("string"), F.lit(0))

    def after(now: Column, t: Column) -> Column:
        return F.when(t["mark"].isNotNull(), state(t["mark"], t["level"])).when(t["level"] < now["rank"], none).otherwise(now)

    told = running(F.col("t"), none, after, lambda now, t: F.struct(t["ex"].alias("ex"), after(now, t)["track"].alias("own")), "array<struct<ex:bigint,own:string>>")
    own = titles.select("doc_file", F.explode(told).alias("x")).select("doc_file", "x.ex", "x.own")
    return e.join(own, ["doc_file", "ex"]).withColumn("track", F.coalesce("own", "doc_track")).select(exercises.columns)


def absorb(exercises: DataFrame, questions: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exercises without questions dissolve: before the first with questions into the header, later ones into the next preamble, at the end into the last key. Documents without questions stay."""
    counts = questions.groupBy("doc_file", "ex").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("doc_file").orderBy("ex")
    e = exercises.join(counts, ["doc_file", "ex"], "left").withColumn("full", F.col("n").isNotNull())
    mark = F.when(F.col("full"), F.col("ex"))
    e = e.withColumn("next", F.first(mark, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))).withColumn("prev", F.last(mark, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    e = e.withColumn("any", F.max("full").over(W.partitionBy("doc_file")))
    said = F.array_join(F.filter(F.array("preamble", "unattributed"), lambda x: x != ""), "\n\n")
    bare = e.filter("any AND NOT full").select("doc_file", "ex", "prev", "next", said.alias("said")).filter("said <> ''")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ex", "said"))), lambda x: x["said"]), "\n\n")
    head = bare.filter("prev IS NULL").groupBy("doc_file").agg(joined.alias("said"))
    before = bare.filter("prev IS NOT NULL AND next IS NOT NULL").groupBy("doc_file", F.col("next").alias("ex")).agg(joined.alias("lead"))
    behind = bare.filter("prev IS NOT NULL AND next IS NULL").groupBy("doc_file", F.col("prev").alias("ex")).agg(joined.alias("tail"))
    both = lambda *cs: F.array_join(F.filter(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in cs]), lambda x: x != ""), "\n\n")
    kept = e.filter("full OR NOT any").join(before, ["doc_file", "ex"], "left").join(behind, ["doc_file", "ex"], "left")
    kept = kept.withColumn("preamble", both("lead", "preamble")).withColumn("unattributed", both("unattributed", "tail")).select(exercises.columns)
    docs = documents.join(head, "doc_file", "left").withColumn("header", both("header", "said")).select(documents.columns)
    return kept, docs


def unique_papers(docs: DataFrame) -> DataFrame:
    """One document of each content: the first by name."""
    named = docs.withColumn("text", newlines(F.col("text"))).withColumn("fingerprint", fingerprint(F.col("text")))
    first = named.groupBy("fingerprint").agg(F.min("doc_file").alias("doc_file"))
    return named.join(first, ["fingerprint", "doc_file"], "left_semi")


def extract(docs: DataFrame) -> Extracted:
    """The whole stage for a DataFrame of doc_file and text."""
    docs = settle(unique_papers(docs))
    m = settle(marks(docs))
    bounds = settle(boundaries(docs, m))
    events = settle(pieces(docs, m, bounds))
    level = exercise_level(m)
    noise = F.aggregate(F.regexp_extract_all("text", F.lit(NOISE), F.lit(0)), F.lit(0), lambda a, x: a + F.length(x))
    header = events.filter("kind = 'h'").select("doc_file", F.col("content").alias("header"))
    seen = m.filter("kind = 'q'").groupBy("doc_file").agg(F.count(F.lit(1)).alias("marks"))
    documents = docs.join(level, "doc_file", "left").join(header, "doc_file").join(seen, "doc_file", "left").select(
        "doc_file", "fingerprint", track_of(F.substring("text", 1, HEAD_CHARS)).alias("track"), F.coalesce("level", F.lit(1)).alias("level"), "header",
        F.length("text").alias("source_chars"), noise.alias("noise_chars"), F.coalesce("marks", F.lit(0)).alias("marks"),
    )
    documents = settle(documents)
    questions, left = fold(events)
    questions, left = (settle(x) for x in recut(settle(questions), settle(left)))
    b = events.filter("kind = 'b'").select("doc_file", "ex", F.concat(stem(F.col("doc_file")), F.lit("/"), slug(F.col("title"))).alias("id"), clean_block(F.col("title")).alias("title"), F.col("content").alias("preamble"), "line")
    exercises = b.join(left, ["doc_file", "ex"], "left").join(documents.select("doc_file", F.col("track").alias("dt")), "doc_file")
    own = track_of(F.col("title"))
    exercises = exercises.select("doc_file", "ex", "id", "title", F.when(own != UNMARKED, own).otherwise(F.col("dt")).alias("track"), "preamble", F.coalesce("unattributed", F.lit("")).alias("unattributed"), "line")
    suffix = F.when(F.col("nth") > 1, F.concat(F.lit("bis"), F.col("nth").cast("string"))).otherwise("")
    questions = questions.join(exercises.select("doc_file", "ex", F.col("id").alias("e_id")), ["doc_file", "ex"])
    questions = questions.select("doc_file", "ex", "pos", F.concat("e_id", F.lit("#Q"), "number", suffix).alias("id"), "number", "text", "solution", F.col("text").rlike(FIGURE).alias("figure_missing"), "line")
    exercises, questions = (settle(x) for x in group_by_part(settle(exercises), settle(questions)))
    exercises = propagate_track(exercises, documents)
    exercises, documents = (settle(x) for x in absorb(settle(exercises), questions, documents))
    return Extracted(documents, exercises, questions)


def summary(x: Extracted) -> DataFrame:
    """By document: counts, the conservation ratio with the two numbers of characters that make it, marks that no question took, and whether the ratio is too low or above 1."""
    q = x.questions.groupBy("doc_file").agg(
        F.count(F.lit(1)).alias("questions"),
        F.count_if(F.length("solution") > 0).alias("solutions"),
        F.count_if("figure_missing").alias("figures_missing"),
        F.sum(F.length("text") + F.coalesce(F.length("solution"), F.lit(0))).alias("q_chars"),
    )
    e = x.exercises.groupBy("doc_file").agg(F.count(F.lit(1)).alias("exercises"), F.sum(F.length("preamble") + F.length("unattributed")).alias("e_chars"))
    out = x.documents.join(e, "doc_file", "left").join(q, "doc_file", "left").fillna(0, ["exercises", "questions", "solutions", "figures_missing", "q_chars", "e_chars"])
    useful = F.col("source_chars") - F.col("noise_chars")
    kept = F.length("header") + F.col("e_chars") + F.col("q_chars")
    ratio = F.when(useful > 0, exact_round(kept / useful, 4)).otherwise(0.0)
    return out.select("doc_file", "fingerprint", "track", "level", "exercises", "questions", "solutions", "figures_missing", ratio.alias("ratio"), (F.col("marks") - F.col("questions")).alias("unplaced"), (ratio < LEAST_RATIO).alias("low"), (ratio > 1).alias("counted_twice"), kept.alias("kept_chars"), useful.alias("useful_chars"))


def best_track_only(exercises: DataFrame, priority: tuple[str, ...] = ("mpi", "mp_info", UNMARKED)) -> DataFrame:
    """Of each document the exercises of its best track."""
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("track"))
    return exercises.withColumn("__r", rank).withColumn("__best", F.min("__r").over(W.partitionBy("doc_file"))).filter("__r = __best").drop("__r", "__best")


def lesser_tracks(exercises: DataFrame, priority: tuple[str, ...] = ("mpi", "mp_info", UNMARKED)) -> DataFrame:
    """The log of best_track_only(): doc_file, id, track and the better track that was kept."""
    best = best_track_only(exercises, priority).select("doc_file", F.col("track").alias("kept_track")).distinct()
    return exercises.join(best, "doc_file").filter(~F.col("track").eqNullSafe(F.col("kept_track"))).select("doc_file", "id", "track", "kept_track")


def selected(exercises: DataFrame, only: str | None = None, limit: int | None = None) -> DataFrame:
    """The exercise of one id, and the first `limit` of what is selected in order of the corpus; all where neither is given."""
    out = exercises if only is None else exercises.filter(F.col("id") == only)
    return out.orderBy("doc_file", "ex").limit(limit) if limit else out


def low_documents(summaries: DataFrame) -> int:
    """How many papers lost too much text: a command that finds one ends with code 2."""
    return summaries.filter("low").count()


def against_golden(found: DataFrame, expected: DataFrame, slack: float = 1e-6) -> DataFrame:
    """Differences of summaries from those expected: doc_file, field, expected, found. Counts must be equal, the ratio may only be higher; a document on one side alone differs in the field `document`."""
    fields = ["track", "exercises", "questions", "solutions", "figures_missing"]
    a = found.select("doc_file", F.struct(*fields, "ratio").alias("f"))
    b = expected.select("doc_file", F.struct(*fields, "ratio").alias("e"))
    x = a.join(b, "doc_file", "full_outer")
    one = lambda name, bad: F.when(bad, F.struct(F.lit(name).alias("field"), F.col(f"e.{name}").cast("string").alias("expected"), F.col(f"f.{name}").cast("string").alias("found")))
    alone = F.when(F.col("f").isNull() | F.col("e").isNull(), F.struct(F.lit("document").alias("field"), F.col("e").isNotNull().cast("string").alias("expected"), F.col("f").isNotNull().cast("string").alias("found")))
    both = F.col("f").isNotNull() & F.col("e").isNotNull()
    checks = [one(n, both & ~F.col(f"f.{n}").eqNullSafe(F.col(f"e.{n}"))) for n in fields] + [one("ratio", both & (F.col("f.ratio") < F.col("e.ratio") - slack))]
    return x.select("doc_file", F.explode(F.array_compact(F.array(alone, *checks))).alias("d")).select("doc_file", "d.*")
