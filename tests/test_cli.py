"""Runs in JSON through the commands."""

import json

import pytest

from gaugeworks import cli
from gaugeworks.operators import labelling, papers, reports, runs
from gaugeworks.sources import readers


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("runs")
    label = lambda *c: [{"concept_id": x, "quote": "q"} for x in c]
    one = [
        {"exercise_id": "2021_InfoA/x", "file": "2021_InfoA.md", "track": "mpi", "questions": [{"question_id": "a", "status": "ok", "labels": label("g.a", "g.b")}, {"question_id": "b", "status": "hors_referentiel", "reason": "r", "labels": []}]},
        {"exercise_id": "2021_InfoA/x", "file": "2021_InfoA.md", "track": "mpi", "questions": [{"question_id": "a", "status": "ok", "labels": label("g.a")}]},
    ]
    two = [{"exercise_id": "2021_InfoA/x", "file": "2021_InfoA.md", "track": "mpi", "questions": [{"question_id": "a", "status": "ok", "labels": label("g.c")}]}]
    for name, x in (("one", one), ("two", two)):
        (d / f"{name}.json").write_text(json.dumps(x))
    (d / "cat").mkdir()
    (d / "cat/g.json").write_text(json.dumps({"concepts": [{"id": f"g.{c}"} for c in "abcd"]}))
    return d


def ask(command, *paths):
    return cli.argparse.Namespace(command=command, paths=list(paths), catalogue=None, probes=None, field="track", least=2, n=5)


def test_equal_ids_stay_apart(spark, files):
    q, l = runs.flatten(readers.runs(spark, [f"{files}/one.json"]))
    assert sorted({r.exercise_id for r in q.collect()}) == ["2021_InfoA/x", "2021_InfoA/x~2"]
    assert {(r.year, r.kind) for r in q.collect()} == {("2021", "InfoA")}
    assert l.count() == 3 and q.count() == 3
    s = runs.summary(q, l).first()
    assert (s.questions, s.labels, s.unlabelled, s.top_share) == (3, 3, 1, 100.0)
    assert [tuple(r) for r in runs.reasons(q).collect()] == [("r", 1)]


def test_commands(spark, files):
    p = ask("distribution", f"{files}/one.json")
    r = cli.command(spark, p).first()
    assert (r.questions, r.labels, r.exercises, r.concepts, r.unlabelled) == (3, 3, 2, 2, 1)
    p = ask("zero", f"{files}/one.json")
    p.catalogue = f"{files}/cat"
    assert [r.concept_id for r in cli.command(spark, p).collect()] == ["g.c", "g.d"]
    p = ask("dispersion", f"{files}/one.json", f"{files}/two.json")
    assert [(r.exercise_id, r.gap, r.jaccard) for r in cli.command(spark, p).collect()] == [("2021_InfoA/x", 1, 0.0)]
    p = ask("compare", f"{files}/one.json", f"{files}/two.json")
    assert {r.measure: r.delta for r in cli.command(spark, p).collect()}["labels"] == -2.0
    p = ask("crosstab", f"{files}/one.json")
    assert {r.concept_id: r.mpi for r in cli.command(spark, p).collect()} == {"g.a": 2, "g.b": 1}


def test_report_text(spark):
    text = reports.table(spark.createDataFrame([("a", 1.5), (None, 2.0)], "x string, y double"), "T")
    assert text.split("\n") == ["T", "x  y", "a  1.50", "   2.00"]
    assert "reserve: r" in reports.header({"version": "1"}, "0" * 16, ["r"])


def test_golden_summaries(spark):
    schema = "doc_file string, track string, exercises int, questions int, solutions int, figures_missing int, ratio double"
    found = spark.createDataFrame([("a", "mpi", 1, 2, 0, 0, 0.97), ("b", "mpi", 1, 2, 0, 0, 0.9), ("c", "mpi", 1, 1, 0, 0, 1.0)], schema)
    want = spark.createDataFrame([("a", "mpi", 1, 2, 0, 0, 0.96), ("b", "mpi", 1, 3, 0, 0, 0.95), ("d", "mpi", 1, 1, 0, 0, 1.0)], schema)
    assert sorted((r.doc_file, r.field) for r in papers.against_golden(found, want).collect()) == [("b", "questions"), ("b", "ratio"), ("c", "document"), ("d", "document")]


def test_two_phases(spark):
    from pyspark.sql import functions as F

    e = spark.createDataFrame([("e1", "m1"), ("e2", "m2")], "exercise_id string, message string")
    key = e.filter("exercise_id = 'e1'").select(labelling.call_key("r", "sections", F.col("exercise_id"), F.col("message"))).first()[0]
    memo = spark.createDataFrame([(key, 1, '{"sections": ["g", "t"]}')], "key string, ord int, payload string")
    first, second, open_ = labelling.two_phases(e, memo, "r", ["g", "t", "p"])
    assert [r.exercise_id for r in first.collect()] == ["e2"]
    assert [(r.exercise_id, r.sections) for r in second.collect()] == [("e1", ["g", "t"])]
    assert [r.exercise_id for r in open_.collect()] == ["e2"]


def test_exit_codes_golden_files_and_import(spark, files, tmp_path, capsys):
    (tmp_path / "papers").mkdir()
    paper = tmp_path / "papers/2021_InfoA.md"
    paper.write_text("# Exercise 1\n\nGiven here.\n\nQuestion 1\n\nWhat is a tree?\n\nQuestion 2\n\nWhat is a graph?\n")
    assert cli.main(["extract", str(tmp_path / "papers")]) == 2  # marks are a third of so short a text
    paper.write_text("# Exercise 1\n\nGiven here.\n\nQuestion 1\n\n" + "What is a tree? " * 60 + "\n\nQuestion 2\n\nWhat is a graph?\n")
    golden = str(tmp_path / "golden")
    assert cli.main(["extract", str(tmp_path / "papers")]) == 0
    assert cli.main(["golden", str(tmp_path / "papers"), "--golden", golden]) == 0  # made where there is none
    assert cli.main(["golden", str(tmp_path / "papers"), "--golden", golden]) == 0
    paper.write_text(paper.read_text() + "\nQuestion 3\n\nAnd a path?\n")
    assert cli.main(["golden", str(tmp_path / "papers"), "--golden", golden]) == 2
    assert "questions" in capsys.readouterr().out
    db = str(tmp_path / "db")
    assert cli.main(["import", db, "--catalogue", f"{files}/cat", "--labels", f"{files}/one.json", "--run", "A"]) == 0
    p = ask("import", db)
    p.catalogue, p.corpus, p.labels, p.run = None, None, f"{files}/two.json", "B"
    assert {r.table: r.rows for r in cli.command(spark, p).collect()} == {"concepts": 4, "runs": 2, "labels": 4}
    p = ask("gold", f"{files}/cat")
    p.catalogue = f"{files}/cat"
    assert {r.section: (r.gold, r.exact) for r in cli.command(spark, p).collect()} == {"all": (4, 4), "g": (4, 4)}
