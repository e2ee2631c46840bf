"""Whole flows: decisions of a section, resumed calls, written catalogues, selectors, orders."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions.text import exact_round
from gaugeworks.operators import catalogue, decisions, labelling, papers, probes, records, rules
from gaugeworks.sources import readers, sinks

CONCEPT = "struct<slug:string,triggers:array<string>,exclusions:array<string>,definition:string,languages:array<string>,target_section:string>"
GIVEN = f"section_id string, unit_id string, ord int, verdict string, reason string, concepts array<{CONCEPT}>"


def concept(slug="a", definition="d" * 40):
    return (slug, ["t"], ["e"], definition, ["c"], "s")


def test_decisions_are_judged_on_the_concepts_left(spark):
    rows = [
        ("s", "u1", 0, "eclate", "r", [concept(), concept("b", "short")]),
        ("s", "u1", 1, "admis", "r", [concept()]),
        ("s", "u2", 2, "admis", "r", [concept("b", "short")]),
        ("s", "u3", 3, "refuse", None, None),
        ("s", "gone", 4, "refuse", "r", []),
        ("t", "u5", 0, "admis", "r", None),
    ]
    units = spark.createDataFrame([("s", "u1"), ("s", "u2"), ("s", "u3"), ("s", "u4"), ("t", "u5")], "section_id string, unit_id string")
    got = decisions.validate(spark.createDataFrame(rows, GIVEN), units, rules.concept_rules(["c"], ["s"]))
    stands = {r.unit_id: (r.verdict, [c.slug for c in r.concepts or []]) for r in got.decisions.collect()}
    assert stands == {"u1": ("admis_reformule", ["a"]), "u3": ("refuse", [])}
    assert [r.section_id for r in got.failed.collect()] == ["t"]
    found = {(r.target, r.code) for r in got.findings.collect()}
    assert found == {
        ("u1", "repeated_decision"), ("gone", "invented_unit"), ("u4", "no_decision"), ("u1/b", "short_definition"), ("u1", "split_of_one"),
        ("u2/b", "short_definition"), ("u2", "accepted_without_concepts"), ("u3", "no_reason"), ("u5", "accepted_without_concepts"),
    }
    none = decisions.validate(spark.createDataFrame([], GIVEN), units, rules.concept_rules(["c"], ["s"]))
    assert none.decisions.count() == 0 and none.failed.count() == 2 and none.findings.count() == 5


def test_rounding_is_that_of_the_exact_value(spark):
    r = random.Random(1)
    values = [0.0, 1.0, 0.98125, 0.96875, 0.00005, 2.5, 7.99995, 9.3] + [r.random() for _ in range(2000)] + [r.randrange(32) / 32 for _ in range(64)] + [k / 20000 for k in range(1, 400, 2)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", exact_round(F.col("v"), 4).alias("r")).collect()
    assert all(x.r == round(x.v, 4) for x in got)


def test_calls_go_in_slices_and_only_once(spark, tmp_path):
    class Counting:
        """Answers in batches, and says how large they were."""

        def answers(self, system, messages, schema):
            return [{"said": m, "at_once": len(messages)} for m in messages]

    path = str(tmp_path / "memo")
    calls = spark.createDataFrame([(f"k{i}", f"m{i}") for i in range(40)], "key string, message string")
    some = labelling.resume(calls.filter("key < 'k2'"), Counting(), "s", {}, path).collect()
    assert all(json.loads(r.payload)["said"] == r.message for r in some)

    class Never:
        def answer(self, system, message, schema):
            if message == "m1":
                raise RuntimeError("asked again")
            return {"said": message}

    got = labelling.resume(calls, Never(), "s", {}, path).collect()
    assert len(got) == 40 and all(json.loads(r.payload)["said"] == r.message for r in got)
    sizes = [json.loads(r.payload)["at_once"] for r in labelling.ask(calls, Counting(), "s", {}, slices=1).collect()]
    assert max(sizes) == labelling.SLICE and len(sizes) == 40


def test_a_failing_call_costs_its_own_answer_only(spark, tmp_path):
    class Failing:
        def answer(self, system, message, schema):
            if message == "m7":
                raise RuntimeError("refused")
            return {"said": message}

    path = str(tmp_path / "memo")
    calls = spark.createDataFrame([(f"k{i}", f"m{i}") for i in range(40)], "key string, message string")
    got = {r.key: r for r in labelling.resume(calls, Failing(), "s", {}, path).collect()}
    assert len(got) == 40 and got["k7"].payload is None and got["k7"].error == "RuntimeError: refused"
    assert all(json.loads(r.payload)["said"] == r.message and r.error is None for k, r in got.items() if k != "k7")

    class Rest:
        def answer(self, system, message, schema):
            if message != "m7":
                raise RuntimeError("asked again")
            return {"said": "at last"}

    again = {r.key: r for r in labelling.resume(calls, Rest(), "s", {}, path).collect()}
    assert json.loads(again["k7"].payload) == {"said": "at last"} and all(r.payload and r.error is None for r in again.values())


def test_a_job_that_ends_loses_one_slice_at_most(spark, tmp_path):
    class Ending:
        """Ends its task, as a lost executor does."""

        def answer(self, system, message, schema):
            if message == "m7":
                raise KeyboardInterrupt
            return {"said": message}

    path = str(tmp_path / "memo")
    calls = spark.createDataFrame([(f"k{i}", f"m{i}") for i in range(40)], "key string, message string")
    with pytest.raises(Exception, match="KeyboardInterrupt"):
        labelling.resume(calls, Ending(), "s", {}, path, at_once=4)
    kept = {r.key for r in labelling._memo_at(spark, path).collect()}
    slices = calls.selectExpr("key", "pmod(xxhash64(key), 10) AS slice").collect()
    at = {r.key: r.slice for r in slices}
    assert kept == {k for k, s in at.items() if s < at["k7"]}

    class Counting:
        def answer(self, system, message, schema):
            if f"k{message[1:]}" in kept:
                raise RuntimeError("asked again")
            return {"said": message}

    got = labelling.resume(calls, Counting(), "s", {}, path, at_once=4).collect()
    assert len(got) == 40 and all(r.error is None and json.loads(r.payload)["said"] == r.message for r in got)


def test_many_quotes_of_one_question(spark):
    """Against Python, where one question holds most labels and quotes carry markup, signs and repeats."""
    r = random.Random(4)
    words = ["alpha", "β", "x", "≤", "**bold**", "tri", "É", "—", "`code`", "pile"]
    text = {q: " ".join(r.choice(words) for _ in range(40)) for q in range(6)}
    rows = []
    for q in range(6):
        for k in range(900 if q == 0 else 12):
            w = text[q].split()
            at = r.randrange(30)
            quote = " ".join(w[at : at + r.randrange(3, 9)])
            rows.append((q, k, r.choice(["s.a", "s.b", "t.c", "u.d"]) + str(r.randrange(90)), quote if r.random() < 0.7 else quote + " absent", ))
    rows += [(0, 900, "s.a1", None), (99, 0, "s.a", "unknown question here it is")]
    labels = spark.createDataFrame(rows, "question_id long, ord int, concept_id string, quote string")
    questions = spark.createDataFrame([(q, q % 2, t) for q, t in text.items()], "question_id long, exercise_id long, text string")
    sections = spark.createDataFrame([(0, "s"), (0, "t"), (1, "s")], "exercise_id long, section_id string")
    kept, out = labelling.validate_labels(labels, questions, sections)
    got = {(x.question_id, x.ord): "kept" for x in kept.collect()} | {(x.question_id, x.ord): x.reason for x in out.collect()}
    plain = lambda t: "".join((t or "").replace("**", "").replace("`", "").replace("β", "beta").replace("≤", "<=").replace("—", "-").split()).lower()
    want, seen = {}, set()
    for q, k, c, quote in rows:
        if q == 99:
            continue
        if c.split(".")[0] not in {0: ("s", "t"), 1: ("s",)}[q % 2]:
            want[q, k] = "not_selected"
        elif len((quote or "").split()) < labelling.LEAST_WORDS:
            want[q, k] = "too_short"
        elif plain(quote) not in plain(text[q]):
            want[q, k] = "not_literal"
        else:
            want[q, k] = "repeated" if (q, c) in seen else "kept"
            seen.add((q, c))
    assert got == want and len(set(want.values())) == 5


def test_a_catalogue_is_written_with_refusals_and_anomalies(spark, tmp_path):
    concepts = spark.createDataFrame([("a.x", "a", "x"), ("a.y", "a", "y"), ("b.z", "b", "z")], "concept_id string, section_id string, slug string")
    refused = spark.createDataFrame([("u", "why")], "unit_id string, reason string")
    findings = spark.createDataFrame([("a.x", "id_repeated", "fatal"), ("b", "empty_section", "expected")], "target string, code string, severity string")
    path = str(tmp_path)
    sinks.write_catalogue(concepts, refused, findings, path)
    assert spark.read.json(f"{path}/sections").count() == 3 and spark.read.json(f"{path}/refusals").count() == 1
    assert [r.code for r in spark.read.json(f"{path}/anomalies").collect()] == ["id_repeated"]
    assert {r.section_id: r.concepts for r in spark.read.json(f"{path}/manifest").collect()} == {"a": 2, "b": 1}
    assert (catalogue.exit_code(findings, True), catalogue.exit_code(findings, False), catalogue.exit_code(findings.filter("severity = 'expected'"), True)) == (2, 0, 0)


def test_profiles_need_their_keys_and_missing_exclusions_are_none(spark, tmp_path):
    p = tmp_path / "p.json"
    p.write_text(json.dumps(dict.fromkeys(readers.PROFILE_KEYS, 1)))
    assert readers.profile(str(p))["genres"] == 1
    p.write_text("{}")
    with pytest.raises(ValueError, match="missing keys"):
        readers.profile(str(p))
    assert readers.exclusions(spark, str(tmp_path / "none.json")).count() == 0


def test_selectors_and_orders(spark):
    e = spark.createDataFrame([("b", 0, "b/1"), ("a", 1, "a/2"), ("a", 0, "a/1")], "doc_file string, ex int, id string")
    assert [r.id for r in papers.selected(e, limit=2).collect()] == ["a/1", "a/2"] and [r.id for r in papers.selected(e, "b/1").collect()] == ["b/1"] and papers.selected(e).count() == 3
    assert [p.name for p in probes.named([probes.Probe("tri fusion", "x"), probes.Probe("pile", "y")], "tri")] == ["tri fusion"]
    c = spark.createDataFrame([("é", 5, 0), ("z", 5, 1), ("f", 1, None), ("a", 9, 2)], "concept_id string, weight int, ord int")
    order = lambda by: [r.concept_id for r in records.heat_order(c, by).collect()]
    assert order("programme") == ["é", "z", "a", "f"] and order("most") == ["a", "é", "z", "f"] and order("fewest") == ["f", "é", "z", "a"] and order("name") == ["a", "é", "f", "z"]


def test_a_probe_report_as_json(spark):
    ps = [probes.Probe("p", "cat"), probes.Probe("q", "dog")]
    found = probes.attest(spark.createDataFrame([("f1", "a cat"), ("f2", "the cat")], "doc_file string, text string"), ps, "doc_file")
    admitted = probes.admission(found, ps)
    got = {r.probe: json.loads(r.body) for r in probes.report_json(admitted, probes.report(found)).collect()}
    assert got["p"]["admitted"] and [x["origin"] for x in got["p"]["excerpts"]] == ["f1", "f2"] and got["q"]["excerpts"] == []
    assert [r.probe for r in probes.ordered(admitted).collect()] == ["p", "q"] and probes.first_by_file(found, 1).count() == 2
