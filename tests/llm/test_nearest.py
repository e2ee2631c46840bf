import math

import numpy as np
import pytest

from gaugeworks.llm import ann


def brute(rows, k=5, every=50):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in ok:
        if i % every == 0:
            s = sorted((-float((q * v).sum() / (math.sqrt((q * q).sum()) * math.sqrt((v * v).sum()))), j) for j, v in ok if j != i)
            out[i] = s[:k]
    return out


def test_chi_square_quantile():
    assert ann.chi2_quantile(0.95, 8) == pytest.approx(15.5073, abs=1e-3)
    assert ann.chi2_quantile(0.5, 2) == pytest.approx(1.3863, abs=1e-3)


def test_recall_and_odd_vectors(spark):
    r = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in r.standard_normal(24).astype(np.float32)]) for i in range(1200)]
    same = rows[7][1]
    rows += [(1200 + i, same) for i in range(40)]
    rows += [(2000, None), (2050, []), (2100, [0.0] * 24), (2150, [float("nan")] + [1.0] * 23), (2200, [None] + [1.0] * 23), (None, same), (2250, [float("inf")] + [1.0] * 23)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "0.5D AS score")
    out = ann.nearest(df).orderBy("query_id", "rank").collect()
    want = brute(rows)
    got = {}
    for x in out:
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    assert set(got) == set(want)
    assert all([g[0] for g in got[q]] == [1, 2, 3, 4, 5] for q in got)
    hit = sum(len({g[1] for g in got[q]} & {w[1] for w in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hit >= 0.97
    assert [g[1] for g in got[1200]] == [w[1] for w in want[1200]]
    assert got[1200][0][2] == pytest.approx(1.0)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id, r.score) for r in ann.nearest(df).collect()] == [(0, 1, 0.0)]
    assert ann.nearest(df.filter("false")).count() == 0


def test_each_length_among_its_own(spark):
    """A cut vector with the smallest id takes nothing from the others."""
    rows = [(0, [1.0]), (50, [1.0, 0.0]), (51, [1.0, 1.0]), (52, [0.0, 1.0]), (53, [2.0])]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in out] == [(0, 1, 53), (50, 1, 51), (50, 2, 52)]


def test_repeated_ids(spark):
    """Rows equal in id and vector are one; other vectors under an id are queries and candidates of their own."""
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0])] + [(i, [float(i), 1.0]) for i in (1, 2, 3, 3, 4, 5, 6, 7, 8, 9)]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    by = {}
    for r in sorted(out, key=lambda r: r.rank):
        by.setdefault(r.query_row, []).append((r.rank, r.vec_id))
    assert sorted(by.values()) == sorted([[(1, 9), (2, 8), (3, 7), (4, 6), (5, 5)], [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]])


def test_the_search_stops_and_finds(spark):
    """Recall against brute force, and the share of vectors verified, on clustered data and on data without any structure, spread over many cells."""
    r = np.random.default_rng(3)
    centres = r.standard_normal((30, 48))
    for clustered, least, most in ((True, 0.93, 0.1), (False, 0.93, 0.6)):
        v = centres[r.integers(0, 30, 3000)] + 0.3 * r.standard_normal((3000, 48)) if clustered else r.standard_normal((3000, 48))
        rows = [(i, [float(x) for x in x]) for i, x in enumerate(v)]
        got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cell_rows=300).collect()
        want = brute(rows)
        hit = sum(1 for g in got if g.vec_id in {w[1] for w in want[g.query_id]}) / sum(map(len, want.values()))
        verified = sum({g.query_id: g.verified for g in got}.values()) / len(want) / len(rows)
        assert hit >= least, (clustered, hit)
        assert verified <= most, (clustered, verified)


def test_many_copies_cost_nothing(spark):
    """Two thirds of all rows are one vector: its queries verify a few points, not all copies."""
    r = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0]) if i % 3 else (i, [float(x) for x in r.standard_normal(3)]) for i in range(600)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect()
    of = [g for g in got if g.query_id == 50]
    assert [g.vec_id for g in of] == [1, 2, 4, 5, 7] and all(g.score == pytest.approx(1.0) for g in of)
    assert of[0].verified <= 64
