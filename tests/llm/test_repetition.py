import hashlib
import random
import re
import zlib

import pytest

from gaugeworks.llm import queries, repetition


def brute_runs(v, least=6, times=4):
    """(start, length, period) of all runs, trying every period at every place."""
    n, out = len(v), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if v[i] != v[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and v[i] == v[i + q]:
                i += 1
            w = v[s : i + q]
            if len(w) >= max(least, times * q) and not any(w[p:] == w[:-p] for p in range(1, q)):
                out.append((s, len(w), q))
    return sorted(out)


def brute_row(doc_id, text):
    """The query's row, from words by the contract's pattern."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), s, m, q, 1000 * m // q if runs else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def sequences(count, seed):
    r = random.Random(seed)
    for _ in range(count):
        n, symbols = r.randrange(0, 110), r.choice([1, 2, 3, 5, 30])
        v = [r.randrange(symbols) for _ in range(n)]
        for _ in range(r.randrange(4)):
            s, p = r.randrange(n + 1), 1 + r.randrange(9)
            for i in range(s + p, min(n, s + r.randrange(1, 70))):
                v[i] = v[i - p]
        yield v


def test_runs_equal_brute_force():
    found = 0
    for v in sequences(3000, 4):
        want = brute_runs(v)
        assert repetition.runs_of(v) == want, v
        found += len(want)
    assert found > 1000


@pytest.mark.parametrize("v", [[0] * 50, [0, 1] * 40, [0, 0, 1] * 30 + [0], [0] * 6 + [1] * 6, [0, 0, 0, 0, 1] * 12, [1, 2, 3] * 3, [1, 2, 3] * 4, ([7] * 9 + [8]) * 5])
def test_nested_runs(v):
    assert repetition.runs_of(v) == brute_runs(v)


def test_the_grammar_gives_the_text_back_and_repeats_no_pair():
    r = random.Random(6)
    for n in (8, 60, 400):
        v = [r.randrange(3) for _ in range(n)]
        top, rules = repetition.re_pair(v, [(0, n)], 3)
        parts = {new: (a, b) for new, a, b, _, _ in rules}

        def words(s):
            return words(parts[s][0]) + words(parts[s][1]) if s in parts else [s]

        assert [x for s, _ in top[0] for x in words(s)] == v
        left = [s for s, _ in top[0]]
        apart = {}
        for k, pair in enumerate(zip(left, left[1:], strict=False)):
            assert k - apart.setdefault(pair, k) < 2  # only an overlapping place is left


def test_the_query_equals_brute_force(spark, tmp_path):
    r = random.Random(9)
    rows = [(i, "".join(f"w{r.randrange(9)}" + r.choice([" ", "\n", "  ", "\t"]) for _ in range(r.randrange(0, 150)))) for i in range(400)]
    rows += [(5, rows[5][1]), (400, None), (401, ""), (402, " \n "), (None, "a b " * 9), (403, "one two three " * 3000), (404, "é ß x \x1c y " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "'x' AS start", "2 AS n_words").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    planted = 0
    want = []
    for i, t in rows:
        want.append(brute_row(i, t) if i != 403 else (403, 1, 0, 9000, 3, 3000000, hashlib.sha256(b"0,9000,3\n").hexdigest(), hashlib.sha256(b"one two three").hexdigest()))
        planted += i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    assert zlib.crc32(b"403") % 10 != 0 and planted > 20
    assert sorted(str(tuple(x)[:8]) for x in got.collect()) == sorted(map(str, want))


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = {r.doc_id: r for r in repetition.periodic_runs(odd_docs).collect()}
    assert [tuple(x) for x in rows[4].runs] == [(0, 30000, 1)] and rows[4].collapsed == "word"
    assert rows[3].runs == [] and rows[3].collapsed == "" and rows[None].n_words == 11
    assert repetition.periodic_runs(no_docs).collect() == []
    with pytest.raises(ValueError):
        repetition.periodic_runs(odd_docs, times=3)
