"""Periodic runs of words, found in a grammar that compresses each text.

1. Words get numbers. In a run of length max(LEAST, TIMES * period) every four words in a row stand again in the same text, so a word that no such
   four cover is in no run: it parts the text, and what lies between is called a stretch.
2. Re-Pair: the most frequent pair of neighbours becomes a new symbol until no pair stands twice. What is left of a stretch is joined by a balanced tree.
3. A run lies whole in the smallest symbol that holds it and crosses that symbol's boundary. So each symbol is asked once for the runs over its boundary: half of such a run
   lies on one side, so its period is that of a square at the side's end there (Z function), and comparing words a period apart gives both ends.
4. Each symbol's runs go to all places where the derivation has that symbol. Intervals of one period that overlap by a period or more are one run, so those that a
   symbol's ends cut short vanish in the whole ones.

All is per document and so a map over texts: nothing is shuffled. Time is in proportion to the repeated words times the grammar's depth.

Defined results: a null or blank text has no words and no runs and collapses to the empty text; a text of any length is read whole; repeated rows
get equal results; null ids stay null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import small_batches

LEAST, TIMES = 6, 4
GRAM = 4
BLANKS = r"[\x20\x09-\x0D]+"


def repeated(ids: np.ndarray) -> np.ndarray:
    """True for the words that GRAM words in a row which stand at least twice cover. Unequal ones with one hash only keep more."""
    n = len(ids) - GRAM + 1
    out = np.zeros(len(ids), dtype=bool)
    if n < 2:
        return out
    hashed = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        hashed = (hashed ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    order = np.argsort(hashed, kind="stable")
    same = hashed[order[1:]] == hashed[order[:-1]]
    starts = np.zeros(n, dtype=bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    for k in range(GRAM):
        out[k : k + n] |= starts
    return out


def re_pair(ids: list[int], stretches: list[tuple[int, int]], fresh: int) -> tuple[list[list[tuple[int, int]]], list[tuple[int, int, int, int, int]]]:
    """The stretches as lists of (symbol, its first word's place), and the rules (symbol, left, right, a place where it stands, the left part's length), older ones first. Symbols from `fresh` on are new."""
    sym, size = list(ids), {}
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)
    for s, e in stretches:
        before[s], after[e - 1] = -1, -1
        for i in range(s, e - 1):
            places[sym[i], sym[i + 1]].add(i)
    heap = [(-len(p), pair) for pair, p in places.items() if len(p) > 1]
    heapify(heap)
    rules = []
    while heap:
        count, pair = heappop(heap)
        now = places.get(pair, ())
        if len(now) != -count:  # counts fall as neighbours are replaced
            if len(now) > 1:
                heappush(heap, (-len(now), pair))
            continue
        a, b = pair
        new, fresh, touched, at = fresh, fresh + 1, set(), -1
        for i in sorted(places.pop(pair)):
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:  # an overlapping place is gone by now
                continue
            at = i
            p, q = before[i], after[j]
            if p >= 0:
                if (old := places.get((sym[p], a))) is not None:
                    old.discard(p)
                places[sym[p], new].add(p)
                touched.add((sym[p], new))
            if q >= 0:
                if (old := places.get((b, sym[q]))) is not None:
                    old.discard(j)
                before[q] = i
                places[new, sym[q]].add(i)
                touched.add((new, sym[q]))
            sym[i], sym[j], after[i] = new, -1, q
        size[new] = size.get(a, 1) + size.get(b, 1)
        rules.append((new, a, b, at, size.get(a, 1)))
        for other in touched:
            if len(places[other]) > 1:
                heappush(heap, (-len(places[other]), other))
    out = []
    for s, _ in stretches:
        own, i = [], s
        while i >= 0:
            own.append((sym[i], i))
            i = after[i]
        out.append(own)
    return out, rules


def squares(v: list[int]) -> list[tuple[int, int]]:
    """(period, reach) of the squares that begin v, each with its smallest period, in ascending order; reach is how far that period holds."""
    n, half = len(v), len(v) // 2
    if half == 0 or v[0] not in v[1 : half + 1]:
        return []
    z, low, high = [0] * n, 0, 0
    for k in range(1, n):
        m = min(high - k, z[k - low]) if k < high else 0
        while k + m < n and v[m] == v[k + m]:
            m += 1
        if k + m > high:
            low, high = k, k + m
        z[k] = m
    out, far = [], 0
    for q in range(1, half + 1):
        if z[q] >= q and 2 * q > far:  # else a smaller period holds for both halves
            out.append((q, q + z[q]))
            far = max(far, q + z[q])
    return out


def crossing(v: list[int], i: int, m: int, j: int, ahead: list[tuple[int, int]], behind: list[tuple[int, int]], least: int, times: int) -> set[tuple[int, int, int]]:
    """Runs (period, start, end) of v[i:j] over the boundary m. ahead: squares that begin v[m:j]; behind: those that end v[i:m], read backwards."""
    out = set()
    for q, reach in ahead:
        if times * q > j - i:
            break
        k = m
        while k > i and v[k - 1] == v[k - 1 + q]:
            k -= 1
        if k < m and m + reach - k >= max(least, times * q):
            out.add((q, k, m + reach))
    for q, reach in behind:
        if times * q > j - i:
            break
        k = m
        while k < j and v[k] == v[k - q]:
            k += 1
        if k > m and k - m + reach >= max(least, times * q):
            out.add((q, m - reach, k))
    return out


def runs_of(ids: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by start, then period."""
    covered = np.flatnonzero(np.diff(np.concatenate([[0], repeated(np.array(ids, dtype=np.int64)).astype(np.int8), [0]])))
    stretches = [(s, e) for s, e in zip(covered[::2].tolist(), covered[1::2].tolist(), strict=True) if e - s >= least]
    if not stretches:
        return []
    top, rules = re_pair(ids, stretches, max(ids) + 1)
    ahead: dict[int, list[tuple[int, int]]] = {}
    behind: dict[int, list[tuple[int, int]]] = {}
    size: dict[int, int] = {}
    local: dict[int, set[tuple[int, int, int]]] = {}
    leads: set[int] = set()  # symbols with runs inside

    def squares_of(symbol: int, s: int, e: int) -> None:
        if symbol not in ahead:
            ahead[symbol] = squares(ids[s:e]) if e - s > 1 else []
            behind[symbol] = squares(ids[s:e][::-1]) if e - s > 1 else []

    for new, a, b, at, left in rules:
        m = at + left
        end = m + size.get(b, 1)
        size[new] = end - at
        squares_of(a, at, m)
        squares_of(b, m, end)
        if end - at >= least and (own := crossing(ids, at, m, end, ahead[b], behind[a], least, times)):
            local[new] = {(q, s - at, e - at) for q, s, e in own}
        if new in local or a in leads or b in leads:
            leads.add(new)
    found: set[tuple[int, int, int]] = set()
    where: dict[int, list[int]] = defaultdict(list)
    for own, (_, end) in zip(top, stretches, strict=True):
        for symbol, at in own:
            if symbol in leads:
                where[symbol].append(at)
        bounds = [at for _, at in own] + [end]
        todo = [(0, len(own))]
        while todo:  # the balanced tree over what is left of the stretch
            lo, hi = todo.pop()
            if hi - lo < 2:
                continue
            mid = (lo + hi) // 2
            i, m, j = bounds[lo], bounds[mid], bounds[hi]
            if j - i >= least:
                found |= crossing(ids, i, m, j, squares(ids[m:j]), squares(ids[i:m][::-1]), least, times)
                todo += [(lo, mid), (mid, hi)]
    for new, a, b, _, left in reversed(rules):
        if new not in leads:
            continue
        at = where.pop(new)
        for q, s, e in local.get(new, ()):
            found.update((q, p + s, p + e) for p in at)
        if a in leads:
            where[a] += at
        if b in leads:
            where[b] += [p + left for p in at]
    merged: list[list[int]] = []
    for q, s, e in sorted(found):
        if merged and merged[-1][0] == q and s <= merged[-1][2] - q:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([q, s, e])
    return sorted((s, e - s, q) for q, s, e in merged)


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_words, runs (array of start, length, period by start, then period) and collapsed: the words outside all runs and those of each run's first period, joined by one space.

    `times` is at least 4 and `least` at least 6, as step 1 relies on both.
    """
    if least < LEAST or times < TIMES:
        raise ValueError(f"runs are sought from {LEAST} words and {TIMES} periods on")
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = []
            for text in x["text"]:
                own = text.encode("utf-8", "surrogatepass").split() if text else []
                numbers: dict[bytes, int] = defaultdict()
                numbers.default_factory = numbers.__len__
                found = runs_of(list(map(numbers.__getitem__, own)), least, times)
                kept = own
                if found:
                    keep = np.ones(len(own), dtype=bool)
                    for s, length, q in found:
                        keep[s + q : s + length] = False
                    kept = [own[k] for k in np.flatnonzero(keep)]
                rows.append((len(own), [{"start": s, "length": n, "period": q} for s, n, q in found], b" ".join(kept).decode("utf-8", "surrogatepass")))
            out = pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])
            out.insert(0, "doc_id", x["doc_id"].astype("Int64"))
            yield out

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInPandas(scan, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """What periodic_runs() gave as numbers and hashes: doc_id, n_runs, the longest run's start, length, period, exponent_milli, runs_sha256, collapsed_sha256, n_words."""
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("back"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    x = found.withColumn("first", first)
    return x.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("first.start").alias("start"),
        F.col("first.length").alias("length"),
        F.col("first.period").alias("period"),
        F.expr("1000 * first.length div first.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def planted(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs whose ids' checksums end in 0 repeat their words from some word on with some period, all by the checksum: a corpus with known runs. Other texts stay."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    own = F.filter(F.split(F.col("text").cast("string"), BLANKS), lambda w: w != "")

    def again(w: Column) -> Column:
        g, n = F.floor(h / 10), F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i))), " ")).otherwise(F.col("text"))

    from gaugeworks.functions.offsets import let

    return docs.withColumn("text", F.when(h % 10 == 0, let(own, again)).otherwise(F.col("text")))
