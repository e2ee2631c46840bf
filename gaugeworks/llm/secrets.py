"""Secret scans, with DataFrame functions alone: fixed patterns, and a battery of randomness tests.

Base spans come from three patterns (PATTERNS). The battery looks at other runs of 20 and more
characters of the usual encodings that hold a digit. Of each it infers the encoding and asks how well uniform random
symbols of that alphabet explain it: Pearson's chi-squared for uniform use of the alphabet, the runs test about the
alphabet's middle, and the serial correlation of neighbours, joined by Fisher's method to one p-value, the run's score. A run that mixes the two
base64 alphabets is cut into its parts in each, which may overlap; each part of 20 and more characters is tested,
unless it lies within another.

What is tested is the hypothesis that a run is ordinary writing. Its scores' distribution is learned from the corpus: every document of
SHORT and more characters gives PIECES pieces of its own text, from places by a hash, without runs that are tested themselves, projected to an alphabet (other
symbols dropped, words joined) and cut to the least length of a length class; each goes through the same battery. Shorter documents, which hold no
such piece, are joined by a hash into groups of about JOINED characters, equal texts once, that give as many pieces as their documents would. In a small table each
gives more of them, from other places, so that a class and encoding can expect NULLS pieces. A group too short for a piece is repeated; one without any
words takes PLAIN for ordinary writing. A run's p-value is the share of ordinary pieces of its encoding and
length class that score as high or higher. Benjamini and Hochberg's procedure, per length class as the battery gains power with
length, reports the runs that aren't ordinary as spans of the kind `random`, so that at most the share Q of these is expected to be
ordinary after all; they never overlap a base span.

The procedure needs only counts by length class, encoding and fine bins of log score, a table of
bounded size. Texts are read twice (their lengths, then the texts); only short ones are shuffled, once.

Runs are tested that hold a digit or a capital behind a small letter; runs of digits alone, of one case alone and under 20 symbols are not.

Defined results: null text is empty; an empty text has no spans; texts of any length are scanned whole, in time linear in their spans; repeated rows get equal
base spans and equal scores; an empty table gives no rows; extra columns are ignored by scan() and kept by redact().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.offsets import cut, let, matches, running
from gaugeworks.llm.common import stored

# Fixed values. Runs under the least length are dropped; where dropping can't change later matches the least length stands in the pattern.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
LEAST_VALUE = 6
# '=' is padding, so only the last of a run; elsewhere it parts runs, as in NAME=value.
RUN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:=++(?![A-Za-z0-9+/_-]))?+"
# A run with symbols of both base64 alphabets is no run of either: its parts in each are tested.
MIXED = "[+/].*[_-]|[_-].*[+/]"
PARTS = ("(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}+=*+", "(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+=*+")
HEX = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LOWER36 = "0123456789abcdefghijklmnopqrstuvwxyz"
UPPER36 = LOWER36.upper()
BASE62 = LOWER36 + UPPER36[10:]
BASE64 = BASE62 + "+/"
BASE64_URL = BASE62 + "-_"
Q = 0.05
BINS_PER_DECADE, LAST_BIN = 50, 600
LEAST_RUN = 20
#: Length classes: the floor of 2 log2 of the length, within these bounds.
FIRST_CLASS, LAST_CLASS = 8, 14
#: Families of alphabets that share ordinary pieces: the projection of a text, and how much of a text a piece needs for each symbol.
FAMILIES = (
    (HEX, lambda t: F.regexp_replace(F.lower(t), "[^0-9a-f]", ""), 7),
    (BASE32, lambda t: F.regexp_replace(F.upper(t), "[^A-Z2-7]", ""), 4),
    (LOWER36, lambda t: F.regexp_replace(F.lower(t), "[^0-9a-z]", ""), 4),
    (BASE62, lambda t: F.regexp_replace(F.initcap(t), "[^0-9A-Za-z]", ""), 4),
    (BASE64, lambda t: F.regexp_replace(F.initcap(t), "[^0-9A-Za-z]", ""), 4),
)
#: What a run must hold to be tested.
TESTED = "[0-9]|[a-z][A-Z]"
#: What is no ordinary writing in a stretch of text: its cut first and last words, and runs that are tested themselves.
NOT_ORDINARY = "^\\S++|\\S++$|[A-Za-z0-9+/_=-]{20,}+"
#: Pieces of each document, and pieces that each class and encoding can expect at least.
PIECES, NULLS = 2, 100
CELLS = (LAST_CLASS - FIRST_CLASS + 1) * len(FAMILIES)
#: Characters that the longest piece needs, and those of a group of shorter documents.
SHORT = 2 ** (LAST_CLASS // 2) * max(width for _, _, width in FAMILIES)
JOINED = 2000
SEED = 17
#: Ordinary writing for tables that hold none.
PLAIN = "Most of what people write is made of words that they have read before, and a few letters come up again and again while others are seldom seen. We know what to expect after the first half of a word, and so does anyone who reads it; that is why a line of symbols drawn at random looks strange on a page. "

SPANS = "array<struct<s:int,kind:int,e:int>>"


def spans_of(text: Column, pattern: str, kind: int, keep=None) -> Column:  # noqa: ANN001
    """Places of all leftmost non-overlapping matches that keep() lets stand."""
    found = matches(text, pattern)
    return F.transform(F.filter(found, keep) if keep else found, lambda x: F.struct(x["start"].alias("s"), F.lit(kind).alias("kind"), x["end"].alias("e")))


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, each pattern on its own, by start, then kind."""
    assign = spans_of(text, ASSIGN, 0, lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= LEAST_VALUE)
    return F.array_sort(F.concat(assign, spans_of(text, PATTERNS["access"], 1), spans_of(text, PATTERNS["hex"], 2)).cast(SPANS))


def upper_tail(z: Column) -> Column:
    """1 - Phi(z) by a rational approximation with an error under 1e-7 (its five constants are fixed values)."""

    def tail(z: Column) -> Column:
        x = F.abs(z) / math.sqrt(2)
        poly = lambda t: t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
        half = let(1 / (1 + 0.3275911 * x), lambda t: F.greatest(poly(t) * F.exp(-x * x) / 2, F.lit(1e-14)))
        return let(half, lambda h: F.when(z >= 0, h).otherwise(1 - h))

    return let(z, tail)


def alphabet_of(token: Column) -> Column:
    """The smallest usual alphabet that holds all symbols of a run; padding is no symbol. Null for what holds other symbols or is digits alone."""
    return (
        F.when(token.rlike("^[0-9]+$"), F.lit(None))
        .when(token.rlike("^[0-9a-f]+$"), F.lit(HEX))
        .when(token.rlike("^[0-9A-F]+$"), F.lit(HEX.upper()))
        .when(token.rlike("^[A-Z2-7]+$"), F.lit(BASE32))
        .when(token.rlike("^[0-9a-z]+$"), F.lit(LOWER36))
        .when(token.rlike("^[0-9A-Z]+$"), F.lit(UPPER36))
        .when(token.rlike("^[0-9A-Za-z]+$"), F.lit(BASE62))
        .when(token.rlike("^[0-9A-Za-z+/]+$"), F.lit(BASE64))
        .when(token.rlike("^[0-9A-Za-z_-]+$"), F.lit(BASE64_URL))
    )


def family_of(alphabet: Column) -> Column:
    return F.when(F.upper(alphabet) == HEX.upper(), 0).when(alphabet == BASE32, 1).when(F.upper(alphabet) == UPPER36, 2).when(alphabet == BASE62, 3).otherwise(4)


def class_of(n: Column) -> Column:
    return F.greatest(F.lit(FIRST_CLASS), F.least(F.lit(LAST_CLASS), F.floor(2 * F.log2(n.cast("double"))).cast("int")))


def randomness(x: Column) -> Column:
    """Joint p-value of the three tests for a struct of token (without padding), alphabet, n and a (their sizes as doubles); near 0 for what uniform random symbols don't explain."""
    n, a = x["n"], x["a"]
    squares = F.aggregate(F.split(x["alphabet"], ""), F.lit(0.0), lambda acc, c: acc + F.pow(n - F.length(F.replace(x["token"], c)), F.lit(2.0)))
    uniform = upper_tail((a / n * squares - n - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n))

    def sums(v: Column) -> Column:
        more = (F.size(v) - 1).cast("int")
        beside = lambda f: F.zip_with(F.slice(v, F.lit(1), more), F.slice(v, F.lit(2), more), f)
        total = lambda items, f=lambda u: u: F.aggregate(items, F.lit(0.0), lambda acc, u: acc + f(u))
        return F.struct(
            total(v).alias("sum"),
            total(v, lambda u: u * u).alias("sq"),
            total(beside(lambda u, w: u * w)).alias("by"),
            F.size(F.filter(v, lambda u: u >= a / 2)).cast("double").alias("high"),
            F.size(F.filter(beside(lambda u, w: (u >= a / 2) != (w >= a / 2)), lambda t: t)).cast("double").alias("turns"),
            v[0].alias("first"),
            F.element_at(v, -1).alias("last"),
        )

    def joined(y: Column) -> Column:
        both = 2 * y["high"] * (n - y["high"])
        spread = both * (both - n) / (n * n * (n - 1))
        runs = F.when(spread > 0, 2 * upper_tail(F.abs(y["turns"] - both / n) / F.sqrt(spread))).otherwise(F.lit(1e-14))
        mean = y["sum"] / n
        around = y["sq"] - n * mean * mean
        beside = y["by"] - mean * (2 * y["sum"] - y["first"] - y["last"]) + (n - 1) * mean * mean
        serial = F.when(around > 1e-9, 2 * upper_tail(F.abs((beside / around + 1 / n) * F.sqrt(n)))).otherwise(F.lit(1e-14))
        return let(
            -(F.log(uniform) + F.log(F.least(runs, F.lit(1.0))) + F.log(F.least(serial, F.lit(1.0)))),
            lambda half: F.exp(-half) * (1 + half + half * half / 2),
        )

    places = F.transform(F.split(x["token"], ""), lambda c: F.position(c, x["alphabet"]).cast("double") - 1)
    return let(let(places, sums), joined)


def scored(token: Column, alphabet: Column) -> Column:
    """Bin of a token's score: 0 for what uniform random symbols explain best. Null without an alphabet."""
    known = F.struct(token.alias("token"), alphabet.alias("alphabet"), F.length(token).cast("double").alias("n"), F.length(alphabet).cast("double").alias("a"))
    p = let(known, lambda k: F.when(k["a"].isNotNull() & (k["n"] >= LEAST_RUN), randomness(k)))
    return let(p, lambda v: F.when(v.isNotNull(), F.least(F.lit(LAST_BIN), F.floor(-F.log10(F.greatest(v, F.lit(1e-13))) * BINS_PER_DECADE)).cast("int")))


def candidates(text: Column) -> Column:
    """Runs to test: start, end, length class, family, bin of the score, and the run."""

    def tested(x: Column) -> Column:
        def of(token: Column) -> Column:
            return let(
                F.when(token.rlike(TESTED), alphabet_of(token)),
                lambda a: F.struct(x["start"].alias("s"), x["end"].alias("e"), class_of(F.length(token)).alias("cls"), family_of(a).alias("fam"), scored(token, a).alias("bin"), x["match"].alias("m")),
            )

        return let(F.regexp_replace(x["match"], "=+$", ""), of)

    def parts(x: Column) -> Column:
        """Of parts at one start the longest comes first; what ends no later than one before it lies within that."""
        both = F.array_distinct(F.concat(*[matches(x["match"], pattern) for pattern in PARTS]))
        ordered = F.array_sort(F.transform(both, lambda y: F.struct(y["start"].alias("start"), (-y["end"]).alias("back"), y["match"].alias("match"))))
        place = lambda end, y: F.struct((x["start"] + y["start"]).alias("start"), (x["start"] - y["back"]).alias("end"), F.when(-y["back"] > end, y["match"]).alias("match"))
        outer = running(ordered, F.lit(0), lambda end, y: F.greatest(end, -y["back"]), place, "array<struct<start:int,end:int,match:string>>")
        return F.when(x["match"].rlike(MIXED), F.filter(outer, lambda y: y["match"].isNotNull())).otherwise(F.array(x))

    runs = F.flatten(F.transform(F.filter(matches(text, RUN), lambda x: x["match"].rlike(TESTED)), parts))
    return F.filter(F.transform(runs, tested), lambda x: x["bin"].isNotNull())


def placed(tests: Column) -> Column:
    """Tests without their runs, as they are stored."""
    return F.transform(tests, lambda x: F.struct(*[x[c].alias(c) for c in ("s", "e", "cls", "fam", "bin")]))


def apart(tests: Column, base: Column) -> Column:
    """The tests that overlap no base span: at each test's end, the greatest end of the base spans that begin before it."""
    t = F.transform(tests, lambda x: F.struct(x["e"].alias("at"), F.lit(0).alias("base"), x["s"].alias("s"), x["e"].alias("e"), x["cls"].alias("cls"), x["fam"].alias("fam"), x["bin"].alias("bin")))
    b = F.transform(base, lambda x: F.struct(x["s"].alias("at"), F.lit(1).alias("base"), x["s"].alias("s"), x["e"].alias("e"), F.lit(0).alias("cls"), F.lit(0).alias("fam"), F.lit(0).alias("bin")))
    kind = "array<struct<free:boolean,x:struct<at:int,base:int,s:int,e:int,cls:int,fam:int,bin:int>>>"
    seen = running(F.array_sort(F.concat(t, b)), F.lit(-1), lambda end, x: F.when(x["base"] == 1, F.greatest(end, x["e"])).otherwise(end), lambda end, x: F.struct(((x["base"] == 0) & (end <= x["s"])).alias("free"), x.alias("x")), kind)
    return F.when((F.size(tests) > 0) & (F.size(base) > 0), F.transform(F.filter(seen, lambda y: y["free"]), lambda y: F.struct(*[y["x"][c].alias(c) for c in ("s", "e", "cls", "fam", "bin")]))).otherwise(tests)


def ordinary(text: Column, row: Column, pieces: Column) -> Column:
    """So many pieces of ordinary writing: length class, family and bin of the score. row: a hash that picks places, families and classes."""
    classes = LAST_CLASS - FIRST_CLASS + 1

    def piece(k: Column, n: Column) -> Column:
        h = F.xxhash64(row, k, F.lit(SEED))
        # The families of one document's pieces are neighbours in a ring, so all are met alike.
        fam = F.pmod(row + k, F.lit(len(FAMILIES))).cast("int")
        cls = (F.pmod(h, F.lit(classes)) + FIRST_CLASS).cast("int")
        size = F.greatest(F.lit(LEAST_RUN), F.ceil(F.pow(F.lit(2.0), cls / 2))).cast("int")
        return let(F.struct(h.alias("h"), fam.alias("fam"), cls.alias("cls"), size.alias("size"), n.alias("n")), of)

    def of(x: Column) -> Column:
        def token(k: int) -> Column:
            width = x["size"] * FAMILIES[k][2]
            at = F.pmod(F.shiftright(x["h"], 8), F.greatest(F.lit(1), x["n"] - width + 1)).cast("int")
            words = F.regexp_replace(F.substring(text, at + 1, width), NOT_ORDINARY, " ")
            return F.substring(FAMILIES[k][1](words), F.lit(1), x["size"])

        pick = lambda f: F.when(x["fam"] == 0, f(0)).when(x["fam"] == 1, f(1)).when(x["fam"] == 2, f(2)).when(x["fam"] == 3, f(3)).otherwise(f(4))
        alphabet = pick(lambda k: F.lit(FAMILIES[k][0]))
        return let(pick(token), lambda t: F.struct(x["cls"].alias("cls"), x["fam"].alias("fam"), F.when(F.length(t) == x["size"], scored(t, alphabet)).alias("bin")))

    return let(F.length(text), lambda n: F.filter(F.transform(F.sequence(F.lit(0), pieces - 1), lambda k: piece(k, n)), lambda y: y["bin"].isNotNull()))


def examined(docs: DataFrame, text: Column, row: Column, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """docs with the columns kept, __gw_base, __gw_tests and __gw_null, stored once; and the pieces of short documents' groups."""
    short = F.length(text) < SHORT
    r = docs.agg(F.count(F.lit(1)).alias("rows"), F.count_if(short).alias("short"), F.sum(F.when(short, F.length(text) + 1)).alias("chars")).first()
    of_each = F.lit(max(PIECES, -(-NULLS * CELLS // max(1, r["rows"] - r["short"]))))
    none = F.array().cast("array<struct<cls:int,fam:int,bin:int>>")
    own = F.when(~short, ordinary(text, row, of_each)).otherwise(none)
    x = docs.select(*keep, base_spans(text).alias("__gw_base"), placed(candidates(text)).alias("__gw_tests"), own.alias("__gw_null"))
    groups = max(1, (r["chars"] or 0) // JOINED)
    more = F.lit(max(-(-PIECES * r["short"] // groups), -(-NULLS * CELLS // groups)))
    writing = F.trim(F.regexp_replace(text, "[A-Za-z0-9+/_=-]{20,}+", " "))
    joined = docs.filter(short).select(F.pmod(row, F.lit(groups)).alias("group"), writing.alias("w")).groupBy("group").agg(F.array_join(F.array_sort(F.collect_set("w")), " ").alias("w"))
    whole = F.when(F.trim("w") == "", F.lit(PLAIN)).otherwise(F.concat("w", F.lit(" ")))
    filled = let(whole, lambda w: F.repeat(w, F.ceil(2 * SHORT / F.length(w)).cast("int")))
    return stored(x, "secrets-tested"), stored(joined.select(ordinary(filled, F.xxhash64("group"), more).alias("__gw_null")), "secrets-joined")


def limits(x: DataFrame, joined: DataFrame, q: float = Q) -> dict[tuple[int, int], int]:
    """By length class and family, the last bin whose runs are reported. Needs the counts by class, family and bin only."""
    count = lambda y, c, tests, nulls: y.select(F.explode(c).alias("x")).groupBy("x.cls", "x.fam", "x.bin").agg(F.count(F.lit(1)).alias("n")).select("cls", "fam", "bin", (F.col("n") * tests).alias("tests"), (F.col("n") * nulls).alias("nulls"))
    cells = count(x, "__gw_tests", 1, 0).unionByName(count(x, "__gw_null", 0, 1)).unionByName(count(joined, "__gw_null", 0, 1))
    cells = cells.groupBy("cls", "fam", "bin").agg(F.sum("tests").alias("tests"), F.sum("nulls").alias("nulls"))
    kind = W.partitionBy("cls", "fam")
    p = (1 + F.sum("nulls").over(kind.orderBy("bin"))) / (1 + F.sum("nulls").over(kind))
    cells = cells.withColumn("p", p)
    all_of = W.partitionBy("cls")
    k = F.sum("tests").over(all_of.orderBy("p"))
    passed = cells.withColumn("ok", F.col("p") <= F.try_divide(q * k, F.sum("tests").over(all_of))).withColumn("top", F.max(F.when(F.col("ok"), F.col("p"))).over(all_of))
    return {(r["cls"], r["fam"]): r["bin"] for r in passed.filter("p <= top").groupBy("cls", "fam").agg(F.max("bin").alias("bin")).collect()}


def with_spans(x: DataFrame, joined: DataFrame, q: float = Q) -> DataFrame:
    """What examined() gave, with the column __gw_spans: base spans and reported runs by start, then kind."""
    found = limits(x, joined, q)
    reported = F.lit(False)
    limit = F.create_map(*[F.lit(v) for (cls, fam), b in found.items() for v in (8 * cls + fam, b)]) if found else None
    free = apart(F.col("__gw_tests"), F.col("__gw_base"))
    added = F.filter(free, lambda y: (y["bin"] <= F.coalesce(F.element_at(limit, 8 * y["cls"] + y["fam"]), F.lit(-1))) if limit is not None else reported)
    added = F.transform(added, lambda y: F.struct(y["s"].alias("s"), F.lit(KINDS.index("random")).alias("kind"), y["e"].alias("e")))
    return x.withColumn("__gw_spans", F.array_sort(F.concat("__gw_base", added))).drop("__gw_tests", "__gw_null")


def told(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat(F.element_at(names, x["kind"] + 1), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, q: float = Q) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Only the places are stored, not the texts.
    x = with_spans(*examined(rows, F.col("text"), F.xxhash64("doc_id", "text"), ["doc_id"]), q)
    number = lambda spans, kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return x.select(
        "doc_id",
        number("__gw_base", 0).alias("n_assign"),
        number("__gw_base", 1).alias("n_access"),
        number("__gw_base", 2).alias("n_hex"),
        F.sha2(told("__gw_base"), 256).alias("base_sha256"),
        told("__gw_spans").alias("spans"),
        number("__gw_spans", 3).alias("n_random"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", q: float = Q) -> DataFrame:
    """docs with each stretch of overlapping spans replaced by a mark, and n_chars, if there, counted anew. Texts without spans, nulls included, stay."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.xxhash64(F.col("doc_id"), text) if "doc_id" in docs.columns else F.xxhash64(text)
    x = with_spans(*examined(docs, text, row, [F.col(f"`{c}`") for c in docs.columns]), q)
    between = running(F.col("__gw_spans"), F.lit(0), lambda end, s: F.greatest(end, s["e"]), lambda end, s: F.struct(F.when(s["s"] >= end, end).alias("start"), s["s"].alias("end")), "array<struct<start:int,end:int>>")
    pieces = cut(text, F.filter(between, lambda y: y["start"].isNotNull()))
    last = F.array_max(F.transform("__gw_spans", lambda s: s["e"]))
    clean = F.concat(F.array_join(pieces, mark), F.lit(mark), F.substring(text, last + 1, F.length(text)))
    hit = F.size("__gw_spans") > 0
    x = x.withColumn("__gw_text", F.when(hit, clean).otherwise(F.col("text")))
    columns = [F.col("__gw_text").alias("text") if c == "text" else F.when(hit, F.length("__gw_text")).otherwise(F.col("n_chars")).cast(t).alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c, t in docs.dtypes]
    return x.select(*columns)
