import math
import random

import pytest
import xxhash

from gaugeworks.llm import nearcopies, simhash


def brute_fingerprint(text):
    w = []
    for x in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" "):
        if x:
            w.append(x)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(fps, radius=2):
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and bin(a ^ b).count("1") <= radius:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {f: top(f) for f in fps}


def test_fingerprints():
    for t in ("A b C d e", "one", "one TWO", "É é x y z", "", None, "a\tb\nc  d e f g"):
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("hot", [64, 8])
def test_links_match_brute_force(spark, monkeypatch, hot):
    """Also where keys count as shared by many, so that they are split."""
    monkeypatch.setattr(simhash, "KEY_OWNERS", hot)
    r = random.Random(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):
        f = r.getrandbits(64)
        fps.add(f)
        for _ in range(8):
            f ^= 1 << r.randrange(64)
            if r.random() < 0.7:
                f ^= 1 << r.randrange(64)
            fps.add(f)
    want = brute_roots(sorted(fps))
    distinct = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {row.node: row.root for row in simhash.connected(simhash.links(distinct)).collect()}
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    full = {signed(f): got.get(signed(f), signed(f)) for f in fps}
    assert groups(full) == groups({signed(k): signed(v) for k, v in want.items()})


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_other_radii_and_crowded_keys(spark, radius):
    """Every link of a crowd of near fingerprints (each key has hundreds of owners, whatever the partition), by brute force."""
    r = random.Random(4)
    centre = r.getrandbits(64)
    fps = {centre} | {centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(1, 64, 4)} | {r.getrandbits(64) for _ in range(60)}
    want = {tuple(sorted((signed(a), signed(b)))) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= radius}
    got = [(x.a, x.b) for x in simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), radius).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_splits_end():
    for radius in (1, 2, 3):
        for bits in ([list(range(32)), list(range(32, 64))], [list(range(0, 64, 3)), list(range(1, 64, 3)), list(range(2, 64, 3))]):
            ways = simhash.splits(bits, radius)
            assert len({(at, path) for at, path, _ in ways}) == len(ways) < 20000
            assert max(at for at, _, _ in ways) < 16


def test_estimates_know_correlation():
    """Pairs of bits that always agree: agreement on a group is far likelier than of independent bits."""
    import numpy as np

    rng = np.random.default_rng(6)
    half = rng.integers(0, 2, (4000, 32))
    bits = np.repeat(half, 2, axis=1).astype(float)
    both, group = bits.T @ bits, list(range(16))
    true = sum(1 for _ in range(20000) if (bits[rng.integers(4000)][:16] != bits[rng.integers(4000)][:16]).sum() <= 2) / 20000
    got = simhash.within(4000, both, group, 2) / (4000 * 3999 / 2)
    assert 0.4 * true < got < 2.5 * true and true > 5 * sum(math.comb(16, k) for k in range(3)) / 2**16


def test_components_and_keeping_one(odd_docs, no_docs):
    out = simhash.components(odd_docs).collect()
    assert len(out) == 11
    blank = {r.component_id for r in out if r.fingerprint == "0" * 16}
    assert blank == {2}
    assert {r.component_id for r in out if r.doc_id in (1, 5)} == {1}
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, 1, 2, 4, 8, 9, 10]
    assert simhash.components(no_docs).count() == 0


def test_thresholds_cover_the_radius():
    import numpy as np

    n, both = 10**9, np.full((64, 64), 0.25 * 10**9) + np.eye(64) * 0.25 * 10**9
    chosen = simhash.plan(n, both, 2)
    assert sum(t + 1 for _, t in chosen) == 3
    few = simhash.plan(1000, both / 10**6, 2)
    assert sum(t + 1 for _, t in few) == 3


@pytest.mark.parametrize("stage", [simhash, nearcopies])
def test_one_row_of_each_component(spark, stage):
    """Null and repeated ids hide no text and save no copy."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b), (None, c), (1, c), (2, d), (2, a + " z"), (3, d), (3, d), (None, d), (4, "x"), (4, "y"), (4, "y")]
    kept = stage.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in kept.collect())
    near = stage is nearcopies or bin(simhash.fingerprint(a) ^ simhash.fingerprint(a + " z")).count("1") <= 2
    assert got == sorted([(-1, b), (1, c), (2, d), (2, a + " z"), (4, "x"), (4, "y")] + [(-1, a)] * (not near))


def test_keys_are_made_once(spark):
    """However many joins read them, as where a key has many owners."""
    fps = [(signed(((k * 0x9E3779B97F4A7C15) & 0xFFFFF) << 8),) for k in range(300)]
    found = simhash.links(spark.createDataFrame(fps, "fp long").distinct(), 2)
    # One side may ask for more keys than it has.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("explode(") <= 1
