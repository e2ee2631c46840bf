"""Scalar functions as columns: fingerprints, slugs, normal forms, numbers, years, kinds."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.offsets import let

# Markup and single symbols that two spellings of one passage may differ in.
MARKUP = r"<[^>]{0,40}>|[\\*_`#$]|\{|\}"
SYMBOLS = {
    "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon",
    "ζ": "zeta", "η": "eta", "θ": "theta", "λ": "lambda", "μ": "mu", "ν": "nu",
    "ξ": "xi", "π": "pi", "ρ": "rho", "σ": "sigma", "τ": "tau", "φ": "phi",
    "χ": "chi", "ψ": "psi", "ω": "omega", "Γ": "gamma", "Δ": "delta",
    "Θ": "theta", "Λ": "lambda", "Σ": "sigma", "Φ": "phi", "Ω": "omega",
    "⩽": "<=", "≤": "<=", "⩾": ">=", "≥": ">=", "≠": "!=", "⟺": "<=>",
    "⇔": "<=>", "⟹": "=>", "⇒": "=>", "−": "-", "–": "-", "—": "-",
    "′": "'", "’": "'", "“": '"', "”": '"', "×": "x", "·": ".", "∈": "in",
}
#: Ranges that hold all these symbols: few of them, as a class of single signs takes Java ten times as long.
SYMBOL_RANGES = "[·×\u0391-\u03c9\u2013-\u2a7e]"
NOT_APPLICABLE = "sans_objet"
#: Letters with marks of Latin-1 and their bare letters, for the form of folding that stays in generated code.
MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
BARE = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def newlines(text: Column) -> Column:
    """Line ends as \\n, as text readers translate them."""
    return F.regexp_replace(text, "\r\n?", "\n")


def fingerprint(*parts: Column) -> Column:
    """First 16 hex digits of SHA-256; with several parts each is followed by a record separator."""
    joined = parts[0] if len(parts) == 1 else F.concat(*[x for p in parts for x in (p, F.lit("\x1e"))])
    return F.substring(F.sha2(joined.cast("binary"), 256), 1, 16)


@F.pandas_udf(T.StringType())
def fold_marks(text: pd.Series) -> pd.Series:
    """Letters without their combining marks, exactly (canonical decomposition)."""
    return text.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn"))


def fold_latin(text: Column) -> Column:
    """fold_marks for texts whose marked letters are Latin-1, in generated code."""
    return F.translate(text, MARKED, BARE)


def slug(text: Column, sep: str = "-", size: int | None = 48, default: str = "sans-titre", exact: bool = True) -> Column:
    """Lower-case ASCII letters and digits, others collapsed to one separator; cut, then defaulted when empty."""
    low = F.lower(fold_marks(text) if exact else fold_latin(text))
    s = F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", sep), f"^{sep}+|{sep}+$", "")
    s = F.substring(s, 1, size) if size else s
    return F.when(s == "", F.lit(default)).otherwise(s)


def literal_form(text: Column) -> Column:
    """Form in which a quoted passage must equal its source: no markup, one spelling of symbols, no blanks, lower case.

    Markup and signs are only replaced in texts that hold any, each step's value being computed once.
    """

    def spelled(t: Column) -> Column:
        for sign, name in SYMBOLS.items():
            t = F.replace(t, F.lit(sign), F.lit(name))
        return t

    bare = let(F.coalesce(text, F.lit("")), lambda t: F.when(t.rlike(r"[<\\*_`#${}]"), F.regexp_replace(t, MARKUP, "")).otherwise(t))
    one = let(bare, lambda t: F.when(t.rlike(SYMBOL_RANGES), spelled(t)).otherwise(t))
    return F.lower(F.regexp_replace(one, r"(?U)\s+", ""))


def clean_block(text: Column) -> Column:
    """Lines without blanks at their end, the whole without blanks around."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)[^\S\n]+(?=\n|\z)", ""), r"(?U)^\s+|\s+\z", "")


def section_of(concept_id: Column) -> Column:
    return F.substring_index(concept_id, ".", 1)


def year_text(name: Column) -> Column:
    return F.when(name.rlike(r"^\d{4}"), F.substring(name, 1, 4)).otherwise("?")


def year_number(name: Column) -> Column:
    return F.regexp_extract(name, r"^(\d{4})", 1).try_cast("int")


def kind_of(name: Column, ordered: Sequence[tuple[str, str]], default: str) -> Column:
    """The kind of the first substring that a name contains."""
    out = F.lit(default)
    for part, kind in reversed(list(ordered)):
        out = F.when(name.contains(part), kind).otherwise(out)
    return out


def humanise(name: Column) -> Column:
    """Blanks for underscores, none around, first letter upper case, the rest lower case."""
    t = F.regexp_replace(F.replace(name, F.lit("_"), F.lit(" ")), r"(?U)^\s+|\s+$", "")
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30)))


def nothing_as_null(value: Column) -> Column:
    return F.nullif(F.nullif(value, F.lit(NOT_APPLICABLE)), F.lit(""))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def line_number(text: Column, offset: Column) -> Column:
    """1-based line of a code-point offset."""
    before = F.substring(text, F.lit(1), offset)
    return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; 0 when both are empty."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; not symmetric, the first argument leads."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


def snippet(text: Column, start: Column, end: Column, around: int = 80) -> Column:
    """What stands around [start, end), blanks collapsed."""
    left = F.greatest(start - around, F.lit(0))
    return F.trim(F.regexp_replace(F.substring(text, left + 1, end + around - left), r"(?U)\s+", " "))


def head_and_tail(text: Column, most: int) -> Column:
    """The beginning and the end of texts longer than `most`, with a mark between."""
    half = most // 2
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.left(text, F.lit(half)), F.lit("\n[...]\n"), F.right(text, F.lit(most - half))))


def is_fingerprint(value: Column) -> Column:
    return value.rlike("^[0-9a-f]{16}$")


def event_key(key: Column) -> Column:
    """Object key of an arrival event: form-encoded."""
    return F.url_decode(key)


def is_infinitive(label: Column) -> Column:
    """Does a label begin with a capitalised French infinitive (a word in -er, -ir, -re, -oir)?"""
    return label.rlike(r"(?U)^[A-ZÉÈÀÇ][\w'-]*(?:er|ir|re|oir)\b")


def exact_round(value: Column, digits: int) -> Column:
    """Rounds a double by its exact binary value to at most 4 digits, ties to the even digit: 0.98125 gives 0.9812. Values of 8 and more are rounded as Spark does."""

    def scaled_by(power: int) -> Column:
        """value * 2 ** power is a whole number of under 2 ** 63, so all that follows is exact."""
        one = F.lit(1 << power).cast("decimal(21,0)") if power < 63 else F.lit(str(1 << power)).cast("decimal(21,0)")
        x = (value * float(1 << power)).cast("long").cast("decimal(19,0)") * F.lit(10**digits).cast("decimal(5,0)")
        rest = x % one
        whole = ((x - rest) / one).cast("long")
        up = (rest * 2 > one) | ((rest * 2 == one) & (whole % 2 == 1))
        return (whole + up.cast("long")) / float(10**digits)

    small = 2.0**-8  # below it doubles need more places
    return F.when(value >= 8, F.round(value, digits)).when(value >= small, scaled_by(60)).otherwise(scaled_by(68))
