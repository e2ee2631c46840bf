"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Fingerprints: 64 majority bits of the XXH64 values of 3-word shingles, one pass over the texts.
2. Equal fingerprints become one row with their smallest id; what follows sees distinct fingerprints only.
3. The 64 bits are split into partitions, correlated bits together. Thresholds t_p with sum(t_p + 1) = radius + 1
   are allotted by dynamic programming on candidate counts estimated from bit statistics of all fingerprints.
   Two fingerprints within the radius agree within t_p in one partition at least, so nothing is lost.
4. Probe: each fingerprint meets those whose key in partition p lies within t_p of its own; verify by bit count.
5. A key that more than KEY_OWNERS fingerprints own is split by the same principle: the bits outside it are cut into radius + 1 groups, and
   two fingerprints within the radius agree on one group at least, so the key grows by each group in turn. Each split leaves a key fewer free
   bits; below log2(KEY_OWNERS) of them no key can have more owners, so the splitting ends after a few levels.
6. Components of the links by alternating star steps, checkpointed.

Defined results: a null or blank text has fingerprint zero and links like any other; a text of one or two words is
one shingle; a null id takes part, and yields to any other id; repeated rows are separate rows of one
component; an empty table gives no rows; extra columns are ignored by components() and kept by keep_one().
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import shared_folder, small_batches, stored

BITS, SEED = 64, 42
KEY_OWNERS = 64


def fingerprint(text: str | None, words: int = 3) -> int:
    """Majority bits of the hashes of all shingles of a text, repeats included."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    shingles = map(b" ".join, zip(*[w[k:] for k in range(words)], strict=False)) if len(w) >= words else [b" ".join(w)]
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of these hashes."""
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[k : k + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", keyed: bool = False) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row; keyed: its row_key() as well."""
    small_batches(docs.sparkSession)
    more = ["key"] if keyed else []

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            fp = np.array([fingerprint(t) for t in x["text"]], dtype=np.uint64).astype(np.int64)
            yield pd.DataFrame({"doc_id": x["doc_id"].astype("Int64"), "fp": fp} | {c: x[c] for c in more})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[row_key().alias(c) for c in more])
    return rows.mapInPandas(scan, "doc_id long, fp long" + ", key string" * keyed)


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how often bits i and j are both set: one 64 x 64 matrix from each task, summed by Spark."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, both = 0, np.zeros((BITS, BITS))
        for x in batches:
            bits = np.unpackbits(x["fp"].to_numpy(np.int64).astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
            n, both = n + len(bits), both + bits.T @ bits
        yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1), "n": np.append(both.ravel(), n).round().astype(np.int64)})

    cells = {r["cell"]: r["n"] for r in distinct.select("fp").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    return cells.get(BITS * BITS, 0), np.array([cells.get(k, 0) for k in range(BITS * BITS)], dtype=float).reshape(BITS, BITS)


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` equal groups: each group starts with the lowest free bit and takes the free bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, groups = list(range(BITS)), []
    for k in range(parts, 0, -1):
        size = round(len(free) / k)
        group = [free.pop(0)]
        while len(group) < size:
            gain = corr[np.ix_(group, free)].mean(axis=0)
            group.append(free.pop(int(np.argmax(gain.round(9)))))
        groups.append(sorted(group))
    return groups


def within(n: int, both: np.ndarray, group: list[int], t: int) -> float:
    """Estimated pairs that agree within t bits of the group, from the mean and the variance of the number of differing bits. Both know each bit's rate and how bits go together; a beta-binomial law has them."""
    if t < 0:
        return 0.0
    w, m = len(group), max(n, 1)
    p11 = both[np.ix_(group, group)] / m
    p = np.diag(p11)
    p10 = p[:, None] - p11
    p00 = 1 - p[:, None] - p[None, :] + p11
    # Two fingerprints drawn apart differ in bits i and j at once with 2 (p11 p00 + p10 p01).
    differ = 2 * p * (1 - p)
    joint = 2 * (p11 * p00 + p10 * p10.T)
    np.fill_diagonal(joint, differ)
    mean = differ.sum()
    if mean < 1e-9:
        return n * (n - 1) / 2
    q = min(mean / w, 1 - 1e-9)
    rho = ((joint.sum() - mean * mean) / (w * q * (1 - q)) - 1) / max(w - 1, 1)
    if rho < 1e-6:
        pmf = np.array([1.0])
        for d in differ:
            pmf = np.convolve(pmf, [1 - d, d])
        return n * (n - 1) / 2 * pmf[: t + 1].sum()
    rho = min(rho, 0.999)
    a, b = q * (1 / rho - 1), (1 - q) * (1 / rho - 1)
    beta = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    pmf = [math.exp(math.lgamma(w + 1) - math.lgamma(k + 1) - math.lgamma(w - k + 1) + beta(k + a, w - k + b) - beta(a, b)) for k in range(min(t, w) + 1)]
    return n * (n - 1) / 2 * min(1.0, sum(pmf))


def probes(width: int, t: int) -> int:
    """Keys within distance t of a key."""
    return 0 if t < 0 else sum(int(np.prod([(width - j) / (j + 1) for j in range(k)]).round()) for k in range(t + 1))


def allot(n: int, both: np.ndarray, groups: list[list[int]], radius: int) -> tuple[float, list[int]]:
    """Thresholds with sum(t + 1) = radius + 1 and the least estimated cost (candidates plus probes), by dynamic programming over groups."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for g in groups:
        now: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, ts) in best.items():
            for t in range(-1, radius - spent + 1):
                total = cost + within(n, both, g, t) + n * probes(len(g), t)
                if spent + t + 1 <= radius + 1 and (spent + t + 1 not in now or total < now[spent + t + 1][0]):
                    now[spent + t + 1] = (total, [*ts, t])
        best = now
    return best[radius + 1]


def plan(n: int, both: np.ndarray, radius: int) -> list[tuple[list[int], int]]:
    """The cheapest (bits, threshold) list over two to radius + 2 partitions; partitions with threshold -1 are left out."""
    options = []
    for parts in range(2, radius + 3):
        groups = correlated_groups(n, both, parts)
        cost, ts = allot(n, both, groups, radius)
        options.append((cost, parts, [(g, t) for g, t in zip(groups, ts, strict=True) if t >= 0]))
    return min(options)[2]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _mask(bits: list[int]) -> int:
    """Bit 0 is the most significant one, as in bit_statistics."""
    return _signed(sum(1 << (BITS - 1 - b) for b in bits))


def _flips(bits: list[int], t: int) -> list[int]:
    """XOR masks of all changes of at most t of these bits."""
    one = [1 << (BITS - 1 - b) for b in bits]
    masks = {0}
    for _ in range(t):
        masks |= {m ^ o for m in masks for o in one}
    return sorted(_signed(m) for m in masks)


def splits(parts: list[list[int]], radius: int) -> list[tuple[int, int, list[int]]]:
    """(level, path, masks of the groups) for each key to split: paths 0.. are the partitions; a path's children are its number times (radius + 1) and on, in the next level. Depends on the partitions alone, not on the data."""
    out, now = [], {k: [b for b in range(BITS) if b not in bits] for k, bits in enumerate(parts)}
    level = 0
    while now:
        nexts = {}
        for path, free in now.items():
            if 1 << len(free) > KEY_OWNERS:
                groups = [free[g :: radius + 1] for g in range(radius + 1)]
                out.append((level, path, [_mask(g) for g in groups]))
                nexts |= {path * (radius + 1) + g: [b for b in free if b not in own] for g, own in enumerate(groups)}
        now, level = nexts, level + 1
    return out


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b), a < b, between all distinct fingerprints within the radius."""
    n, both = bit_statistics(distinct)
    parts = plan(n, both, radius)
    owned = F.array(*[F.struct(F.lit(k).alias("part"), (F.col("fp").bitwiseAND(F.lit(_mask(bits)))).alias("key")) for k, (bits, _) in enumerate(parts)])
    # Read by several joins: made once, however many there are.
    own = stored(distinct.select("fp", F.explode(owned).alias("k")).select("fp", "k.part", "k.key"), "simhash-own-keys")

    def probing(k: int, bits: list[int], t: int) -> Column:
        masks = F.array(*[F.lit(m) for m in _flips(bits, t)])
        return F.transform(masks, lambda m: F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(bits))).bitwiseXOR(m).alias("key")))

    # With thresholds of 0 alone both sides probe the same keys: one order of each pair is enough.
    even = not any(t for _, t in parts)
    ask = own if even else distinct.select("fp", F.explode(F.concat(*[probing(k, bits, t) for k, (bits, t) in enumerate(parts)])).alias("k")).select("fp", "k.part", "k.key")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    order = F.col("a") < F.col("b") if even else F.col("a") != F.col("b")
    found, ways = [], splits([bits for bits, _ in parts], radius)
    for level in range(BITS):
        shared = stored(own.groupBy("part", "key").count().filter(F.col("count") > KEY_OWNERS).select("part", "key"), "simhash-shared-keys")
        any_shared = shared.limit(1).count() > 0
        calm = own.join(shared, ["part", "key"], "left_anti") if any_shared else own
        found.append(ask.withColumnRenamed("fp", "a").join(calm.withColumnRenamed("fp", "b"), ["part", "key"]).filter(order & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        if not any_shared:
            break
        # All paths of a level: their number depends on the partitions alone.
        groups = distinct.sparkSession.createDataFrame([(path, path * (radius + 1) + g, m) for at, path, masks in ways if at == level for g, m in enumerate(masks)], "part int, child int, mask long")
        longer = lambda rows: stored(rows.join(shared, ["part", "key"], "left_semi").join(F.broadcast(groups), "part").select("fp", F.col("child").alias("part"), F.col("key").bitwiseOR(F.col("fp").bitwiseAND(F.col("mask"))).alias("key")), "simhash-longer-keys")
        own = longer(own)
        ask = own if even else longer(ask)
    return reduce(DataFrame.unionByName, found).distinct()


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Components of the links (a, b): node and root (its component's smallest node), for nodes with links. Alternating large-star and small-star steps; each round ends in a checkpoint."""
    shared_folder(edges.sparkSession)
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").checkpoint()
    before = None
    for _ in range(rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        root = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(root, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").union(root.select("u", F.col("m").alias("v"))).distinct()
        e = small.checkpoint()
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(docs: DataFrame, radius: int = 2, id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (the component's smallest doc_id)."""
    rows = stored(fingerprints(docs, id_col), "simhash-fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = connected(links(distinct, radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Both sides of each join are plain tables, so that Spark can split a fingerprint or component with very many rows.
    named = stored(stored(rooted, "simhash-roots").join(stored(least, "simhash-least"), "root").select("fp", "component_id"), "simhash-components")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_key() -> Column:
    """Hash of a row's text, by which rows of one id are told apart."""
    return F.coalesce(F.md5(F.col("text").cast("string").cast("binary")), F.lit(""))


def one_of_each(docs: DataFrame, rows: DataFrame, roots: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row of docs for each component: the first by id (a null id is last), then by row_key(). rows: doc_id, key and fp of each row; roots: node and root of fps with links."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "count")
    of_fp = rows.groupBy("fp", "doc_id", "key").count().groupBy("fp").agg(F.min(first).alias("first"))
    of_root = of_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    kept = stored(of_root.select(F.col("first.doc_id").alias("__gw_id"), F.col("first.key").alias("__gw_same"), F.col("first.count").alias("n")), "simhash-kept")
    # The kept rows grow with the corpus, so they are never broadcast: one plan at every size.
    same = F.col(id_col).eqNullSafe(F.col("__gw_id")) & (F.col("__gw_key") == F.col("__gw_same"))
    out = docs.withColumn("__gw_key", row_key()).join(kept.select("__gw_id", "__gw_same").hint("merge"), same, "left_semi")
    # Texts are dealt out again only if a kept row, id and text, really repeats.
    return (out.dropDuplicates([id_col, "__gw_key"]) if kept.filter("n > 1").limit(1).count() else out).drop("__gw_key")


def keep_one(docs: DataFrame, radius: int = 2, id_col: str = "doc_id") -> DataFrame:
    """One document of each component, as one_of_each() says. All columns stay."""
    rows = stored(fingerprints(docs, id_col, keyed=True), "simhash-fingerprints")
    distinct = stored(rows.select("fp").distinct(), "simhash-distinct")
    return one_of_each(docs, rows, connected(links(distinct, radius)), id_col)
