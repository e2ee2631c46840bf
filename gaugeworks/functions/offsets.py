"""Places of regular-expression matches, without Python: lengths of matches and of what lies between them, summed up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
MATCHES = "array<struct<start:int,end:int,match:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, also where inner functions use it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(items: Column, start: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], empty: str, after: bool = False) -> Column:
    """What emit(state, item) gives for each item, where step(state, item) makes the next state; after: emit is given the state that the item made.

    An array that grows by one is copied at each step, so items are folded in blocks of BLOCK and the blocks flattened
    at the end: the work stays in proportion to the items. empty: the result's type, an array.
    """
    none, nones = F.array().cast(empty), F.array().cast(f"array<{empty}>")

    def inner(acc: Column, x: Column) -> Column:
        if after:
            return let(step(acc["state"], x), lambda now: F.struct(now.alias("state"), F.concat(acc["out"], F.array(emit(now, x))).alias("out")))
        return F.struct(step(acc["state"], x).alias("state"), F.concat(acc["out"], F.array(emit(acc["state"], x))).alias("out"))

    def outer(acc: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(acc["state"].alias("state"), none.alias("out")), inner)
        return let(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["blocks"], F.array(d["out"])).alias("blocks")))

    def whole(every: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int")), lambda k: F.slice(every, k * BLOCK + 1, F.lit(BLOCK)))
        return F.aggregate(blocks, F.struct(start.alias("state"), nones.alias("blocks")), outer, lambda acc: F.flatten(acc["blocks"]))

    return let(items, lambda every: F.when(F.size(every) > 0, whole(every)).otherwise(none))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of all matches in code points. The pattern must not match the empty text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    steps = let(found, lambda m: F.zip_with(m, F.slice(between, F.lit(1), F.size(m)), lambda x, g: F.struct(F.length(g).alias("gap"), F.length(x).alias("size"), x.alias("match"))))

    def place(at: Column, x: Column) -> Column:
        return F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["size"]).alias("end"), x["match"].alias("match"))

    return F.when(text.rlike(pattern), running(steps, F.lit(0), lambda at, x: at + x["gap"] + x["size"], place, MATCHES)).otherwise(F.array().cast(MATCHES))


def cut(text: Column, places: Column) -> Column:
    """The parts of a text at places array<struct<start, end>> in ascending order. A text is walked once for each block of places, not once for each place."""

    def block(own: Column) -> Column:
        low = own[0]["start"]
        return let(
            F.struct(low.alias("low"), F.substring(text, low + 1, F.element_at(own, -1)["end"] - low).alias("part")),
            lambda b: F.transform(own, lambda x: F.substring(b["part"], x["start"] - b["low"] + 1, x["end"] - x["start"])),
        )

    def whole(every: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int")), lambda k: let(F.slice(every, k * BLOCK + 1, F.lit(BLOCK)), block))
        return F.flatten(blocks)

    return let(places, lambda every: F.when(F.size(every) > 0, whole(every)).otherwise(F.array().cast("array<string>")))
