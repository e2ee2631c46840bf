import itertools

import numpy as np

from gaugeworks.llm import packing


def padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts, strict=True))


def test_boundaries_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(1, 9))
        lengths = np.sort(rng.choice(60, n, replace=False)) + 1
        counts = rng.integers(1, 20, n)
        for k in range(1, 5):
            got = packing.best_boundaries(lengths, counts, k)
            assert len(got) <= k and got[-1] == lengths[-1]
            best = min(padding(lengths, counts, [*c, lengths[-1]]) for r in range(min(k, n)) for c in itertools.combinations(lengths[:-1], r))
            assert padding(lengths, counts, got) == best


def test_batches_fill_the_budget(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 37)) for i in range(500)], "doc_id long, text string")
    out = packing.pack(docs, buckets=4, budget=200).toPandas()
    assert sorted(out.doc_id) == list(range(500))
    assert (out.n_tokens == out.doc_id % 37).all() and (out.padding >= 0).all()
    for (_, _), g in out.groupby(["bucket", "batch"]):
        length = g.bucket_length.iloc[0]
        assert len(g) * length <= max(200, length)
        assert sorted(g.slot) == list(range(len(g)))
    for _, g in out.groupby("bucket"):
        sizes = g.groupby("batch").size()
        assert (sizes.drop(sizes.index.max()) == max(1, 200 // max(1, g.bucket_length.iloc[0]))).all()


def test_odd_rows(odd_docs, no_docs):
    out = packing.pack(odd_docs).toPandas()
    assert len(out) == 11 and out.n_tokens.max() == 30000 and (out.n_tokens == 0).sum() == 3
    assert packing.pack(no_docs).count() == 0


def plain_boundaries(lengths, counts, buckets):
    """The dynamic program as written in a textbook."""
    n = len(lengths)
    cost = lambda i, j: sum(c * (lengths[j] - x) for x, c in zip(lengths[i : j + 1], counts[i : j + 1], strict=True))
    best, cuts = [cost(0, j) for j in range(n)], [[0] * n]
    for _ in range(1, min(buckets, n)):
        now, cut = [0] * n, [0] * n
        for j in range(n):
            now[j], cut[j] = min([(cost(0, j), 0)] + [(best[i - 1] + cost(i, j), i) for i in range(1, j + 1)])
        best = now
        cuts.append(cut)
    return best[-1]


def test_long_lengths_are_exact():
    rng = np.random.default_rng(2)
    lengths = np.unique(np.concatenate([rng.integers(0, 60, 20), rng.integers(1000, 30000, 60)]))
    counts = rng.integers(1, 50, len(lengths))
    for k in (1, 2, 3, 7, 16):
        got = packing.best_boundaries(lengths, counts, k)
        assert len(got) <= k and got[-1] == lengths[-1]
        assert padding(lengths, counts, got) == plain_boundaries(lengths.tolist(), counts.tolist(), k)


def test_many_lengths_take_seconds():
    import time

    lengths = np.arange(1, 300_001)
    began = time.perf_counter()
    got = packing.best_boundaries(lengths, np.random.default_rng(3).integers(1, 9, len(lengths)), 16)
    assert len(got) == 16 and got[-1] == 300_000 and time.perf_counter() - began < 60


def test_whole_query_against_brute_force(spark):
    """Every column of every row, with texts of more than 1024 words, repeated ids and a null id."""
    rng = np.random.default_rng(5)
    words = [int(x) for x in np.concatenate([rng.integers(0, 50, 60), rng.integers(1000, 5000, 40)])]
    ids = [None, 3, 3, *range(100, 197)]
    docs = spark.createDataFrame([(i, "w " * n) for i, n in zip(ids, words, strict=True)], "doc_id long, text string")
    budget, got = 6000, packing.pack(docs, buckets=5, budget=6000).toPandas()
    lengths = sorted(set(words))
    counts = [words.count(x) for x in lengths]
    ends = packing.best_boundaries(np.array(lengths), np.array(counts), 5)
    assert padding(lengths, counts, ends) == plain_boundaries(lengths, counts, 5) == got.padding.sum()
    want = []
    for b, end in enumerate(ends):
        own = sorted(((i is not None, i or 0, n) for i, n in zip(ids, words, strict=True) if n <= end and (b == 0 or n > ends[b - 1])))
        size = max(1, budget // max(1, end))
        want += [(i if known else None, n, b, end, r // size, r % size, end - n) for r, (known, i, n) in enumerate(own)]
    rows = [tuple(None if x != x else int(x) for x in r) for r in got[["doc_id", "n_tokens", "bucket", "bucket_length", "batch", "slot", "padding"]].itertuples(index=False)]
    assert sorted(rows, key=str) == sorted(want, key=str)
