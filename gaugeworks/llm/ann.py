"""Approximate nearest neighbours: stable random projections to a few dimensions, a kd-tree over them, and a chi-square stopping test.

Vectors are scaled to length one, so the nearest by Euclid are the nearest by cosine. A Gaussian (2-stable) projection to M
dimensions turns a distance d into a projected one whose square divided by d squared follows a chi-square law with M
degrees of freedom. A query takes its projected neighbours one after the other, nearest first, from the kd-tree, and verifies
them on the original vectors. It stops at the first whose squared projected distance is beyond LIMIT = chi2(CERTAINTY, M) times that of
the k-th found: a vector nearer than the k-th would be projected so far away with a probability of at most 1 - CERTAINTY.

The tree is spread over Spark. Its upper part, up to MOST_CELLS cells, comes from a sample of at most about SAMPLE projected points and is
the only thing every task holds; each vector is dealt to its cell once, and each cell (in parts of about PART_ROWS) has
its own lower tree. A query meets its own cell first; with the k-th distance found there it goes only to the cells whose
box is not beyond the stopping bound. Index rows and queries reach a cell as one sorted stream: the tree is built from the rows, then queries
are answered as they come. A cell with more than QUERY_BLOCK queries is copied, once for each block of so many.

Equal vectors are one point with their k + 1 smallest ids, which is all that ties can ask for, so copies cost nothing.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, as queries or
candidates; a vector's neighbours are those of its own length; a null id takes no part; rows equal in id and vector are one;
rows of one id with different vectors are different queries, each with ranks from 1 (query_row tells them apart), and different candidates; a
query leaves out all rows of its own id; ties go to the smaller id; with fewer candidates than k all are returned;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.common import small_batches, stored

M = 24
CERTAINTY = 0.95
LEAF = 32
CELL_ROWS, MOST_CELLS = 1 << 12, 1 << 13
PART_ROWS = 1 << 16
QUERY_BLOCK = 1 << 17
SAMPLE = 1 << 16
SEED = 11


def chi2_quantile(p: float, dof: int) -> float:
    """Inverse of the chi-square distribution for an even number of degrees of freedom, by bisection on its closed form."""
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        term = total = np.exp(-mid / 2)
        for i in range(1, dof // 2):
            term *= mid / 2 / i
            total += term
        lo, hi = (mid, hi) if 1 - total < p else (lo, mid)
    return (lo + hi) / 2


def axes(dim: int) -> np.ndarray:
    """The projection of vectors of this length."""
    return np.random.default_rng([SEED, dim]).standard_normal((dim, M))


def projected(vectors: list[np.ndarray]) -> np.ndarray:
    """Projections of unit vectors of any lengths."""
    out, sizes = np.zeros((len(vectors), M)), np.array([len(v) for v in vectors])
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        own = np.stack([vectors[i] for i in at])
        out[at] = own / np.linalg.norm(own, axis=1, keepdims=True) @ axes(int(dim))
    return out


class Cells:
    """The upper tree: median splits of a sample along its widest axis, and the box of each cell, open at the outside."""

    def __init__(self, points: np.ndarray, cells: int) -> None:
        self.axis, self.cut, self.below = [], [], []
        low, high, todo = [], [], [(0, np.arange(len(points)), cells, np.full(M, -np.inf), np.full(M, np.inf))]
        self.axis.append(-1), self.cut.append(0.0), self.below.append((0, 0))
        while todo:
            node, own, n, lo, hi = todo.pop()
            spread = np.ptp(points[own], axis=0) if n > 1 and len(own) > 1 else np.zeros(M)
            axis = int(np.argmax(spread))
            if spread[axis] <= 0:
                self.below[node] = (len(low), 0)
                low.append(lo), high.append(hi)
                continue
            cut = float(np.quantile(points[own, axis], (n // 2) / n))
            first = len(self.axis)
            self.axis[node], self.cut[node], self.below[node] = axis, cut, (first, first + 1)
            for side, size in ((0, n // 2), (1, n - n // 2)):
                self.axis.append(-1), self.cut.append(0.0), self.below.append((0, 0))
                a, b = lo.copy(), hi.copy()
                (b if side == 0 else a)[axis] = cut
                inside = points[own, axis] <= cut if side == 0 else points[own, axis] > cut
                todo.append((first + side, own[inside], size, a, b))
        self.low, self.high = np.array(low), np.array(high)

    def of(self, points: np.ndarray) -> np.ndarray:
        axis, cut, below = np.array(self.axis), np.array(self.cut), np.array(self.below)
        node = np.zeros(len(points), dtype=np.int64)
        while (inner := axis[node] >= 0).any():
            at = np.flatnonzero(inner)
            right = points[at, axis[node[at]]] > cut[node[at]]
            node[at] = below[node[at], right.astype(int)]
        return below[node, 0]

    def far(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each cell's box."""
        out = np.zeros((len(points), len(self.low)))
        for k in range(M):
            gap = np.maximum(self.low[None, :, k] - points[:, None, k], 0) + np.maximum(points[:, None, k] - self.high[None, :, k], 0)
            out += gap * gap
        return out


class KdTree:
    """Median splits along the widest axis down to leaves of LEAF points, as index ranges with bounding boxes."""

    def __init__(self, points: np.ndarray) -> None:
        self.order, ranges, todo = np.arange(len(points)), [], [(0, len(points))]
        while todo:
            a, b = todo.pop()
            if b - a <= LEAF:
                if b > a:
                    ranges.append((a, b))
                continue
            own = points[self.order[a:b]]
            axis, mid = int(np.argmax(own.max(axis=0) - own.min(axis=0))), (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, axis], mid)]
            todo += [(a, a + mid), (a + mid, b)]
        self.ranges = np.array(sorted(ranges), dtype=np.int64).reshape(-1, 2)
        self.points = points[self.order]
        self.low = np.array([self.points[a:b].min(axis=0) for a, b in self.ranges]).reshape(-1, points.shape[1])
        self.high = np.array([self.points[a:b].max(axis=0) for a, b in self.ranges]).reshape(-1, points.shape[1])

    def nearest(self, query: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(squared distances, points) in increasing order, in runs: a run holds what lies nearer than all leaves not opened yet."""
        gap = np.maximum(self.low - query, 0) + np.maximum(query - self.high, 0)
        far = (gap * gap).sum(axis=1)
        by = np.argsort(far, kind="stable")
        held, at_held, k, step = np.zeros(0), np.zeros(0, dtype=np.int64), 0, 2
        while k < len(by) or len(held):
            opened = [np.arange(a, b) for a, b in self.ranges[by[k : k + step]]]
            k, step = k + step, min(64, 2 * step)
            if opened:
                at = np.concatenate(opened)
                away = self.points[at] - query
                held, at_held = np.concatenate([held, (away * away).sum(axis=1)]), np.concatenate([at_held, at])
            ready = held <= (far[by[k]] if k < len(by) else np.inf)
            if ready.any():
                order = np.argsort(held[ready], kind="stable")
                yield held[ready][order], self.order[at_held[ready][order]]
                held, at_held = held[~ready], at_held[~ready]


class Index:
    """One part of one cell, of one vector length: the vectors, each with its ids, and their projections in a kd-tree."""

    def __init__(self, ids: list[np.ndarray], vectors: np.ndarray) -> None:
        self.vectors, self.many = vectors, np.array([len(i) for i in ids])
        self.ids, self.first = np.concatenate(ids), np.concatenate([[0], np.cumsum(self.many)])
        self.norm = np.linalg.norm(vectors, axis=1)
        self.axes = axes(vectors.shape[1])
        self.tree = KdTree(vectors / self.norm[:, None] @ self.axes)
        self.limit = chi2_quantile(CERTAINTY, M)

    def search(self, own: int, query: np.ndarray, k: int, least: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int]:
        """ids and cosines of the k best with a cosine of `least` or more, and how many vectors were verified. `least` is what the query has found elsewhere."""
        norm = float(np.linalg.norm(query))
        ids, score, verified = np.zeros(0, dtype=np.int64), np.zeros(0), 0

        def bound() -> float:
            worst = max(least, score[k - 1]) if len(score) >= k else least
            return self.limit * max(0.0, 2 - 2 * worst) + 1e-9

        for away, rows in self.tree.nearest(query / norm @ self.axes):
            at, step = 0, 32
            while at < len(rows):
                take = min(step, int(np.searchsorted(away[at:], bound(), side="right")))
                if not take:
                    return ids, score, verified
                some = rows[at : at + take]
                at, step, verified = at + take, min(256, 2 * step), verified + take
                cos = self.vectors[some] @ query / (self.norm[some] * norm)
                more = np.repeat(cos, self.many[some])
                names = np.concatenate([self.ids[self.first[r] : self.first[r + 1]] for r in some]) if self.many[some].max() > 1 else self.ids[self.first[some]]
                good = (names != own) & (more >= max(least, score[k - 1] if len(score) >= k else -np.inf))
                if good.any():
                    ids, score = np.concatenate([ids, names[good]]), np.concatenate([score, more[good]])
                    best = np.lexsort((ids, -score))[:k]
                    ids, score = ids[best], score[best]
        return ids, score, verified


FOUND = "query_id long, query_row long, verified long, ids array<long>, scores array<double>"


def answered(index: DataFrame, asked: DataFrame, sizes: DataFrame, k: int, tasks: int) -> DataFrame:
    """FOUND for each of asked (query_id, query_row, v, cell, least) and each part of its cell. index: ids, v, cell; sizes: cell, parts."""
    blocks = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks"))
    # One row for each cell, MOST_CELLS at most.
    known = F.broadcast(sizes.join(F.broadcast(blocks), "cell"))
    deal = lambda n, *by: F.pmod(F.xxhash64(*by), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = index.join(known, "cell").withColumn("part", deal("parts", "v")).withColumn("block", each("blocks"))
    rows = rows.select("cell", "part", "block", F.lit(0).alias("kind"), "ids", "v", F.lit(0).cast("long").alias("query_id"), F.lit(0).cast("long").alias("query_row"), F.lit(None).cast("double").alias("least"))
    queries = asked.join(known, "cell").withColumn("block", deal("blocks", "query_id", "query_row")).withColumn("part", each("parts"))
    queries = queries.select("cell", "part", "block", F.lit(1).alias("kind"), F.lit(None).cast("array<long>").alias("ids"), "v", "query_id", "query_row", "least")
    key = ["cell", "part", "block"]
    stream = rows.unionByName(queries).repartition(tasks, *key).sortWithinPartitions(*key, "kind")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, built = None, {}, {}
        for x in batches:
            out = []
            for at, kind, ids, v, q, row, least in zip(zip(x["cell"], x["part"], x["block"], strict=True), x["kind"], x["ids"], x["v"], x["query_id"], x["query_row"], x["least"], strict=True):
                if at != now:
                    now, held, built = at, {}, {}
                if kind == 0:
                    held.setdefault(len(v), []).append((np.asarray(ids, dtype=np.int64), v))
                    continue
                if len(v) not in built and len(v) in held:
                    own = held.pop(len(v))
                    built[len(v)] = Index([i for i, _ in own], np.stack([w for _, w in own]))
                if len(v) in built:
                    found, scores, n = built[len(v)].search(int(q), v, k, -np.inf if pd.isna(least) else float(least))
                    out.append((q, row, n, found, scores))
            yield pd.DataFrame(out, columns=["query_id", "query_row", "verified", "ids", "scores"]).astype({"query_id": "int64", "query_row": "int64"})

    return stored(stream.mapInPandas(scan, FOUND), "ann-found")


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, cell_rows: int = CELL_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score, query_row, verified (vectors compared for this query) for the queries: rows whose vec_id is divisible by `every`."""
    spark = vectors.sparkSession
    small_batches(spark, 5000)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).filter("vec_id IS NOT NULL AND size(v) > 0")
    v = v.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)).distinct()
    v = stored(v, "ann-rows")
    n = v.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_row long, verified long")

    draw = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) < F.lit(int(min(1.0, SAMPLE / n) * (1 << 30)))
    show = lambda batches: (pd.DataFrame({"p": list(projected(list(x["v"])))}) for x in batches)
    sample = v.filter(draw).select("v").mapInPandas(show, "p array<double>").toPandas()["p"]
    cells = Cells(np.stack(sorted(map(tuple, sample))) if len(sample) else np.zeros((0, M)), min(MOST_CELLS, -(-n // cell_rows)))

    def dealt(rows: DataFrame, schema: str) -> DataFrame:
        put = lambda batches: (x.assign(cell=cells.of(projected(list(x["v"])))) for x in batches)
        return rows.mapInPandas(put, schema + ", v array<double>, cell int")

    first = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    points = v.withColumn("n", first).filter(F.col("n") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select("ids", "v")
    index = stored(dealt(points, "ids array<long>"), "ann-index")
    sizes = stored(index.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts")), "ann-cells")
    queries = v.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("query_row"), "v")
    queries = stored(dealt(queries, "query_id long, query_row long"), "ann-queries")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(cells.low))

    def best(found: DataFrame) -> DataFrame:
        pairs = F.flatten(F.collect_list(F.arrays_zip(F.transform("scores", lambda s: -s).alias("far"), F.col("ids").alias("vec_id"))))
        return found.groupBy("query_id", "query_row").agg(F.slice(F.array_sort(pairs), 1, k).alias("best"), F.sum("verified").alias("verified"))

    home = answered(index, queries.withColumn("least", F.lit(None).cast("double")), sizes, k, tasks)
    least = best(home).select("query_id", "query_row", (-F.try_element_at("best", F.lit(k))["far"]).alias("least"))
    limit = chi2_quantile(CERTAINTY, M)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            reach = np.where(x["least"].isna(), np.inf, limit * np.maximum(0.0, 2 - 2 * x["least"].fillna(0.0)) + 1e-9)
            near = cells.far(projected(list(x["v"]))) <= reach[:, None]
            near[np.arange(len(x)), x["cell"].to_numpy()] = False
            yield x.assign(cells=[np.flatnonzero(r).astype(np.int32) for r in near])[["query_id", "query_row", "v", "least", "cells"]]

    far = queries.join(least, ["query_id", "query_row"]).mapInPandas(route, "query_id long, query_row long, v array<double>, least double, cells array<int>")
    far = stored(far, "ann-routes").select("query_id", "query_row", "v", "least", F.explode("cells").alias("cell"))
    out = best(home.unionByName(answered(index, far, sizes, k, tasks)))
    out = out.select("query_id", "query_row", "verified", F.posexplode("best").alias("i", "x"))
    return out.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.far")).alias("score"), "query_row", "verified")
