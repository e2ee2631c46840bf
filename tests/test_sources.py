"""Readers, writers and arrivals."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators import papers, probes
from gaugeworks.sources import readers, sinks, store
from gaugeworks.streaming import arrivals


def test_papers_are_read_and_written(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.md").write_bytes("# E\r\nQuestion 1. Find it.\r\n".encode())
    (tmp_path / "in/b.txt").write_text("ignored")
    docs = readers.papers(spark, str(tmp_path / "in"))
    assert [(r.doc_file, "\r" in r.text) for r in docs.collect()] == [("a.md", False)]
    x = papers.extract(docs)
    sinks.write_documents(x, str(tmp_path / "out"))
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert rows[0].exercises[0].questions[0].text == "Find it."


def test_runs_replace_themselves_only(spark, tmp_path):
    path = str(tmp_path / "labels")
    mk = lambda rows: spark.createDataFrame(rows, "question_id string, concept_id string, run string")
    sinks.write_run(mk([("q", "a", "1"), ("q", "b", "2")]), path)
    sinks.write_run(mk([("q", "c", "1")]), path)
    assert sorted((r.concept_id, str(r.run)) for r in spark.read.parquet(path).collect()) == [("b", "2"), ("c", "1")]


def test_memo_catalogue_and_probes(spark, tmp_path):
    lines = [{"key": "k", "label": "l", "payload": "old"}, {"key": "k", "label": "l", "payload": "new"}]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, lines)) + '\n{"key": "cut')
    assert [r.payload for r in readers.memo(spark, str(tmp_path / "m.jsonl")).collect()] == ["new"]
    (tmp_path / "cat").mkdir()
    (tmp_path / "cat/b.json").write_text(json.dumps({"concepts": [{"id": "b.x", "slug": "x", "label": "X"}]}))
    (tmp_path / "cat/a.json").write_text(json.dumps({"concepts": [{"id": "a.y", "section_id": "z"}]}))
    assert [(r.concept_id, r.section_id) for r in readers.catalogue(spark, str(tmp_path / "cat")).orderBy("ord").collect()] == [("a.y", "z"), ("b.x", "b")]
    (tmp_path / "p.json").write_text(json.dumps([{"name": "p", "pattern": "x"}]))
    assert readers.probes(str(tmp_path / "p.json")) == [probes.Probe("p", "(?iu)x")]
    assert readers.exclusions(spark, None).count() == 0


def test_runs_are_read_in_order(spark, tmp_path):
    q = {"question_id": "q1", "status": "ok", "labels": [{"concept_id": "g.a", "quote": "x"}]}
    for k in (1, 2):
        (tmp_path / f"r{k}.json").write_text(json.dumps([{"exercise_id": f"e{k}", "questions": [q]}]))
    paths = [str(tmp_path / f"r{k}.json") for k in (1, 2)]
    rows = readers.exploded_labels(readers.runs(spark, paths)).collect()
    assert sorted((r.run, r.exercise_id, r.concept_id) for r in rows) == [(0, "e1", "g.a"), (1, "e2", "g.a")]
    assert len(readers.run_hash(spark, paths).first().hash) == 16


def test_schema_drift_is_refused(spark):
    df = spark.createDataFrame([(1,)], "a int")
    sinks.check_schema(df, T.StructType([T.StructField("a", T.IntegerType())]))
    with pytest.raises(ValueError, match="drift"):
        sinks.check_schema(df, T.StructType([T.StructField("b", T.IntegerType())]))


def test_arrivals_come_once(spark, tmp_path):
    box, out, state = tmp_path / "box", str(tmp_path / "out"), str(tmp_path / "state")
    box.mkdir()
    for name, text in (("a.md", "one"), ("b.md", "one"), ("c.md", "two")):
        (box / name).write_text(text)
    each = lambda batch, _: batch.write.mode("append").parquet(out)
    run = lambda: arrivals.run_available(arrivals.unique(arrivals.arriving(spark, str(box))), state, each)
    run()
    assert spark.read.parquet(out).count() == 2
    (box / "d.md").write_text("two")
    (box / "e.md").write_text("three")
    run()
    got = spark.read.parquet(out)
    assert got.count() == 3
    seen = spark.createDataFrame([(got.first().fingerprint,)], "fingerprint string")
    assert arrivals.unseen(got, seen, "fingerprint").count() == 2
    assert arrivals.unseen(got.withColumn("x", F.lit(1)), seen, "fingerprint").columns[-1] == "x"


def test_the_last_line_wins_whatever_the_files_sizes(spark, tmp_path):
    """Spark reads large files first; the order is that of paths and places, and of sequence numbers where lines have them."""
    line = lambda key, payload, **more: json.dumps({"key": key, "label": "l", "payload": payload, **more})
    folder = tmp_path / "memo"
    folder.mkdir()
    (folder / "a.json").write_text(line("k", "old") + "\n" + line("s", "numbered", seq=5) + "\n")
    (folder / "b.json").write_text("\n".join([line("k", "older"), *[line(f"f{i}", "x" * 500) for i in range(300)], line("k", "new"), line("s", "plain"), '{"key": "k", "payl']))
    (folder / "c.json").write_text(line("f1", "small and last"))
    got = {r.key: r.payload for r in readers.memo(spark, str(folder)).collect()}
    assert got["k"] == "new" and got["s"] == "numbered" and got["f1"] == "small and last" and len(got) == 302
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # parts of one file are read by several tasks
    try:
        assert {r.key: r.payload for r in readers.memo(spark, str(folder)).collect()} == got
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_repeated_exercises_are_numbered_by_path(spark, tmp_path):
    """a.json is small and comes first, b.json is large; two exercises of one file keep their order."""
    from gaugeworks.operators import runs

    one = lambda file, text: {"exercise_id": "E", "file": file, "track": "t", "questions": [{"question_id": "E#1", "status": "ok", "reason": text}]}
    (tmp_path / "a.json").write_text(json.dumps(one("a", "-")))
    (tmp_path / "b.json").write_text(json.dumps([one("b1", "x" * 100000), one("b2", "-")]))
    (tmp_path / "more.json").write_text(json.dumps(one("c", "-")))
    q, _ = runs.flatten(readers.runs(spark, [str(tmp_path / "[ab].json"), str(tmp_path / "more.json")]))
    assert {r.file: r.exercise_id for r in q.collect()} == {"a": "E", "b1": "E~2", "b2": "E~3", "c": "E~4"}


def corpus(spark, folder, text="t", file="one.md"):
    question = lambda n: {"id": f"E#Q{n}", "number": str(n), "text": f"{text}{n}", "line": n}
    doc = {"doc_file": file, "fingerprint": "f" + file, "track": "A", "exercises": [{"id": "E", "title": "first", "questions": [question(1), question(2)]}, {"id": "G", "questions": []}, {"id": "E", "title": "second", "questions": [question(1)]}]}
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(doc))
    return readers.corpus(spark, str(folder))


def test_exercises_are_ranked_within_their_file(spark, tmp_path):
    rows = store.corpus_rows(corpus(spark, tmp_path / "c"))
    assert sorted((r.id, r.rank, r.title) for r in rows["exercises"].collect()) == [("E", 1, "first"), ("E~2", 2, "second"), ("G", 1, None)]
    assert sorted((r.id, r.exercise_id) for r in rows["questions"].collect()) == [("E#Q1", "E"), ("E#Q2", "E"), ("E~2#Q1", "E~2")]


def test_a_load_changes_all_tables_or_none(spark, tmp_path):
    path = str(tmp_path / "db")
    run = lambda quote: [{"exercise_id": "E", "questions": [{"question_id": "E#Q1", "status": "ok", "labels": [{"concept_id": "c", "quote": quote}, {"concept_id": "c", "quote": quote + "!"}]}]}]
    (tmp_path / "r.json").write_text(json.dumps(run("old")))
    concepts = spark.createDataFrame([("c", "s", 1)], "id string, section_id string, ord int")
    load = lambda folder, text: store.corpus_rows(corpus(spark, tmp_path / folder, text)) | {"concepts": concepts} | store.run_rows(readers.runs(spark, [str(tmp_path / "r.json")]), "A")
    assert store.publish(spark, path, load("one", "t")) == 1
    assert {n: store.read(spark, path, n).count() for n in store.TABLES} == {"documents": 1, "exercises": 3, "questions": 3, "concepts": 1, "runs": 1, "labels": 1}
    assert store.read(spark, path, "labels").first().quote == "old!"

    def state():
        return {n: sorted(map(str, store.read(spark, path, n).collect())) for n in store.TABLES}

    before = state()
    broken = load("two", "new ")
    broken["concepts"] = concepts.withColumn("section_id", F.raise_error(F.lit("disk lost")).cast("string"))  # the fourth table
    with pytest.raises(Exception, match="disk lost"):
        store.publish(spark, path, broken)
    assert state() == before and store.current(spark, path)[0] == 1
    assert store.publish(spark, path, load("three", "new ")) == 2 and {r.text for r in store.read(spark, path, "questions").collect()} == {"new 1", "new 2"}
    again = state()
    assert store.publish(spark, path, load("four", "new ")) == 3 and state() == again
    (tmp_path / "r.json").write_text(json.dumps(run("other run")))
    store.publish(spark, path, store.run_rows(readers.runs(spark, [str(tmp_path / "r.json")]), "B"))
    assert sorted((r.run, r.quote) for r in store.read(spark, path, "labels").collect()) == [("A", "old!"), ("B", "other run!")]
    with pytest.raises(ValueError, match="unknown tables"):
        store.publish(spark, path, {"others": concepts})


def test_of_two_loads_at_once_the_second_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "db")
    rows = lambda v: {"concepts": spark.createDataFrame([("c", v, 1)], "id string, section_id string, ord int")}
    store.publish(spark, path, rows("first"))
    seen = store.current(spark, path)
    store.publish(spark, path, rows("second"))
    monkeypatch.setattr(store, "current", lambda *a: seen)  # it began before the second was done
    with pytest.raises(RuntimeError, match="load again"):
        store.publish(spark, path, rows("third"))
    monkeypatch.undo()
    assert [r.section_id for r in store.read(spark, path, "concepts").collect()] == ["second"] and store.read(spark, path, "labels") is None


def test_each_content_passes_once_over_restarts_and_replays(spark, tmp_path):
    """Against a registry of a hundred thousand fingerprints; one query is lost between its output and the registry."""
    inbox, registry, out = tmp_path / "in", str(tmp_path / "registry"), tmp_path / "out"
    inbox.mkdir()
    many = spark.range(100_000).select(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 16).alias("fingerprint"), F.lit(-1).cast("long").alias("batch")).withColumn("prefix", F.left("fingerprint", F.lit(arrivals.DIGITS)))
    many.repartition("prefix").write.partitionBy("prefix").parquet(registry)
    put = lambda name, text: (inbox / name).write_text(text)
    keep = lambda rows, n: rows.write.mode("overwrite").parquet(f"{out}/batch={n}")
    passed = lambda: sorted(r.text for r in spark.read.parquet(str(out)).collect())
    run = lambda each: arrivals.run_available(arrivals.arriving(spark, str(inbox)), str(tmp_path / "ck"), arrivals.once(registry, each))
    put("a.md", "one")
    put("b.md", "one")
    put("c.md", "77")  # registered before this stream began
    run(keep)
    assert passed() == ["one"]
    put("d.md", "two")
    put("e.md", "one")

    def lost(rows, n):
        keep(rows, n)
        raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        run(lost)
    run(keep)
    assert passed() == ["one", "two"]
    batch = arrivals.arriving(spark, str(inbox)).schema  # a batch whose fingerprints are registered, but that was not committed
    again = spark.createDataFrame([("d.md", "two", None)], batch).withColumn("fingerprint", F.substring(F.sha2("text", 256), 1, 16))
    number = arrivals.registered(spark, registry).join(again.select("fingerprint"), "fingerprint").first().batch
    seen = []
    arrivals.once(registry, lambda rows, n: seen.append(rows.count()))(again, number)
    arrivals.once(registry, lambda rows, n: seen.append(rows.count()))(again, number + 1)
    assert seen == [1, 0] and passed() == ["one", "two"]
