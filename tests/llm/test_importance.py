import hashlib
import math
import random
import re
import zlib

import pytest

from gaugeworks.llm import importance, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return w, [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, share=(5, 100), least=20):
    """(doc_id, n_features, weight, score, rank) by strings, decoded words and one sort."""
    of = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for f in brute_features(x)[1]:
                counts[of(f)] += 1
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1.0) * (all_s + 10000.0) / ((a + 1.0) * (all_t + 10000.0)))) for a, b in zip(s, t, strict=True)]
    out, able = [], []
    for i, x in docs:
        w, f = brute_features(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[of(g)] for g in f)
        row = [i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        out.append(row)
        if len(w) >= least:
            able.append(row)
    able.sort(key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1], r[2]))
    for k, row in enumerate(able[: share[0] * len(able) // share[1]]):
        row[4] = k + 1
    return sorted(map(str, map(tuple, out)))


def texts(n, seed=3):
    r = random.Random(seed)
    vocabulary = ["Alpha", "béta", "GAMMA", "delta2", "ΣΑΣ", "é", "x_y", "it's", "日本", "zeta", "eta", "THETA9"]
    return ["".join(r.choice(vocabulary) + r.choice([" ", "  ", ", ", "\n", "-", "\x00", " "]) for _ in range(r.randrange(0, 60))) for _ in range(n)]


def test_checksums_go_on_from_the_run_before():
    own = importance.words("Ab c-É 9Z")
    assert own == [b"ab", b"c", "É".encode(), b"9z"]
    joined = [b" ".join(own[i : i + k]) for k in (1, 2, 3) for i in range(len(own) - k + 1)]
    assert importance.checksums(own) == [zlib.crc32(x) for x in joined]
    assert importance.checksums([]) == [] and importance.checksums([b"a"]) == [zlib.crc32(b"a")]


def test_the_draw_equals_brute_force(spark, tmp_path):
    docs = list(enumerate(texts(400)))
    docs += [(7, docs[7][1]), (None, docs[9][1]), (None, None), (500, ""), (501, "... !!"), (502, "Long word " * 20000)]
    target = texts(12, 8) + [None, ""]
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS rank", "2 AS bucket").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op11_importance(spark, str(tmp_path))
    assert got.columns[:5] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)[:5]) for r in got.collect()) == brute(docs, target)


@pytest.mark.parametrize("share", [(1, 3), (1, 1), (0, 1)])
def test_ranks_are_whole_and_in_order_over_many_partitions(spark, share):
    docs = spark.createDataFrame(list(enumerate(texts(120, 5))), "doc_id long, text string")
    target = spark.createDataFrame([("alpha béta gamma",)], "text string")
    rows = importance.resample(docs, target, share=share, least_words=5).collect()
    drawn = sorted((r for r in rows if r["rank"] is not None), key=lambda r: r["rank"])
    able = [r for r in rows if r.n_words >= 5]
    assert [r["rank"] for r in drawn] == list(range(1, share[0] * len(able) // share[1] + 1))
    assert [(r.score, r.doc_id) for r in drawn] == [(r.score, r.doc_id) for r in sorted(able, key=lambda r: (-r.score, r.doc_id))][: len(drawn)]


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    target = odd_docs.select("text").limit(3)
    assert importance.resample(odd_docs, target).count() == 11
    assert importance.resample(odd_docs, target.filter("false")).count() == 11
    assert importance.resample(no_docs, target).collect() == []


def test_documents_like_the_target_are_drawn(spark):
    r = random.Random(2)
    near, far = [f"n{k}" for k in range(50)], [f"f{k}" for k in range(50)]
    docs = [(i, " ".join(r.choice(near if i % 10 == 0 else far) for _ in range(40))) for i in range(300)]
    target = spark.createDataFrame([(" ".join(r.choice(near) for _ in range(400)),)], "text string")
    rows = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), target).collect()
    drawn = [x.doc_id for x in rows if x["rank"] is not None]
    assert len(drawn) == 15 and all(i % 10 == 0 for i in drawn)
