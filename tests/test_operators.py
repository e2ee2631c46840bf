"""Integrity, matching, labelling, as-of, quotes, records on small rows of our own."""

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions import text as tx
from gaugeworks.operators import asof, catalogue, compare, dedup, labelling, matching, measures, probes, quotes, records, rules
from gaugeworks.operators.components import components


def test_rule_order_repairs_and_fatal(spark):
    rows = [
        (1, "Ünion Find", ["a"] * 8, ["x"], "d" * 50, ["c", "cobol"], "graphs"),
        (2, "!!!", ["a"], ["x"], "d" * 50, ["c"], "graphs"),
        (3, "ok", [], [], "short", ["perl"], "nowhere"),
        (4, "fine", ["a"], ["x"], "d" * 40, None, "graphs"),
        (5, "late", ["a"] * 7, ["x"], "short", ["perl"], "graphs"),
    ]
    df = spark.createDataFrame(rows, "id int, slug string, triggers array<string>, exclusions array<string>, definition string, languages array<string>, target_section string")
    out = rules.apply_rules(df, rules.concept_rules(["c", "ocaml"], ["graphs"]))
    got = {r.id: (r.slug, len(r.triggers), r.languages, r.fatal, [f.code for f in r.findings]) for r in out.collect()}
    assert got[1] == ("union_find", 6, ["c"], None, ["slug_form", "many_triggers", "foreign_language"])
    assert got[2][3:] == ("slug_unusable", ["slug_unusable"])
    assert got[3][3:] == ("no_trigger", ["no_trigger"])
    assert got[4][3:] == (None, [])
    assert got[5][3:] == ("short_definition", ["many_triggers", "short_definition"])
    assert rules.findings(out, "id").count() == 7


def test_decision_rules_and_sets(spark):
    rows = [("u1", "refuse", "no", 1), ("u2", "admis", "r", 0), ("u3", "eclate", " ", 1), ("u4", "admis", "r", 3)]
    out = {r.unit_id: r for r in rules.apply_rules(spark.createDataFrame(rows, "unit_id string, verdict string, reason string, concepts int"), rules.decision_rules()).collect()}
    assert out["u1"].fatal == "refused_with_concepts" and out["u2"].fatal == "accepted_without_concepts"
    assert out["u3"].verdict == "admis_reformule" and out["u3"].reason == "(no reason given)"
    assert out["u4"].verdict == "eclate"
    d = spark.createDataFrame([("a", 1), ("a", 2), ("z", 3)], "unit_id string, ord int")
    u = spark.createDataFrame([("a",), ("b",)], "unit_id string")
    assert sorted(map(tuple, rules.check_decisions(d, u).collect())) == [("a", "repeated_decision"), ("b", "no_decision"), ("z", "invented_unit")]


def test_rule_declarations():
    with pytest.raises(ValueError):
        rules.Rule("x", rules.REPAIR, lambda: F.lit(True))
    with pytest.raises(ValueError):
        rules.Rule("x", rules.FATAL, lambda: F.lit(True), {"a": lambda: F.lit(1)})


def test_cross_references(spark):
    concepts = spark.createDataFrame([("g.path", "path", "g"), ("g.cycle", "cycle", "g"), ("t.tree", "tree", "t")], "concept_id string, slug string, section_id string")
    sections = spark.createDataFrame([("g",), ("t",), ("p",)], "section_id string")
    x = spark.createDataFrame([("g.path", "cycle"), ("g.path", "t.tree"), ("g.path", "p"), ("g.path", "nothing"), ("g.path", None), ("g.path", "path")], "concept_id string, raw string")
    out = catalogue.resolve(x, concepts, sections)
    assert sorted((r.see or "", r.see_type or "", r.see_raw or "") for r in out.collect()) == [("", "", ""), ("", "", "nothing"), ("g.cycle", "concept", ""), ("g.path", "concept", ""), ("p", "section", ""), ("t.tree", "concept", "")]
    more = out.unionByName(spark.createDataFrame([("g.path", "gone", "concept", None), ("g.path", "gone", "section", None), ("g.path", "g.cycle", None, None), ("g.path", "g.cycle", "odd", None)], out.schema))
    codes = sorted((r.code, r.severity) for r in catalogue.check_xrefs(more, concepts, sections).collect())
    assert codes == [("dead_concept", "fatal"), ("dead_section", "expected"), ("self_exclusion", "expected"), ("unknown_type", "fatal"), ("unresolved", "fatal"), ("untyped", "fatal"), ("xref_to_section", "expected")]


def test_slugs_validation_and_injection(spark):
    c = spark.createDataFrame([("g", "a", 1), ("g", "a", 2), ("g", "a", 3), ("h", "a", 1)], "section_id string, slug string, ord long")
    old = spark.createDataFrame([("h", "a")], "section_id string, slug string")
    assert sorted(r.id for r in catalogue.unique_slugs(c, old).collect()) == ["g.a_2", "g.a_3", "g.a_4", "h.a_5"]
    cat = spark.createDataFrame([("g.a", "g", "a", "Parcourir un graphe"), ("g.b", "g", "b", "Arbres"), ("h.a", "h", "a", "Définir un type"), ("h.a", "h", "a", "Définir un type")], "concept_id string, section_id string, slug string, label string")
    secs = spark.createDataFrame([("g",), ("h",), ("k",)], "section_id string")
    codes = sorted((r.target, r.code) for r in catalogue.validate(cat, secs, 1, 1, 10).collect())
    assert codes == [("a", "slug_repeated"), ("g", "section_over_ceiling"), ("g.b", "no_infinitive"), ("h", "section_over_ceiling"), ("h.a", "id_repeated"), ("k", "empty_section")]
    new = spark.createDataFrame([("g.a", "g", "a", "x"), ("k.n", "k", "n", "y")], cat.schema)
    out, refused, count = catalogue.inject(cat, new)
    assert [r.concept_id for r in refused.collect()] == ["g.a"] and out.count() == 5
    assert {r.section_id: r.concepts for r in count.collect()} == {"g": 2, "h": 2, "k": 1}


def test_greedy_equals_one_by_one(spark):
    r = random.Random(1)
    for _ in range(3):
        pairs = {(f"a{r.randrange(6)}", f"b{r.randrange(6)}"): r.choice([0.7, 0.8, 0.9]) for _ in range(20)}
        want, used = {}, set()
        for (a, b), _ in sorted(pairs.items(), key=lambda x: (-x[1], x[0])):
            if a not in want and b not in used:
                want[a] = b
                used.add(b)
        df = spark.createDataFrame([(a, b, s) for (a, b), s in pairs.items()], "asked_id string, row_id string, score double")
        assert {x.asked_id: x.row_id for x in matching.greedy(df).collect()} == want


@pytest.mark.parametrize("most", [200_000, 3])
def test_greedy_over_components(spark, monkeypatch, most):
    """A long chain of falling scores, and pieces; also where a task takes three pairs at most and the rest falls apart round by round."""
    r = random.Random(2)
    n = 10_000 if most > 3 else 12
    chain = [(f"c{(k + 1) // 2:05}", f"d{k // 2:05}", 1 - k / (2 * n)) for k in range(n)]
    pieces = list({(f"a{(i := r.randrange(30))}", f"b{i // 3 * 3 + r.randrange(3)}"): r.choice([0.7, 0.8, 0.9]) for _ in range(70)}.items())
    rows = chain + [(a, b, s) for (a, b), s in pieces]
    want, used = {}, set()
    for a, b, _ in sorted(rows, key=lambda x: (-x[2], x[0], x[1])):
        if a not in want and b not in used:
            want[a] = b
            used.add(b)
    got = matching.greedy(spark.createDataFrame(rows, "asked_id string, row_id string, score double"), most)
    assert {x.asked_id: x.row_id for x in got.collect()} == want and got.count() == len(want)


def test_all_measures_equal_one_by_one(spark):
    r = random.Random(12)
    q = spark.createDataFrame([(k, r.choice(["a", "b", None, "c"]), r.choice(["x", "y", None]), r.choice(["ok", "no", None])) for k in range(300)], "question_id long, exercise_id string, track string, status string")
    l = spark.createDataFrame([(r.randrange(250), f"c{r.randrange(40)}") for _ in range(900)], "question_id long, concept_id string")
    columns = ["questions", "labels", "exercises", "concepts", "unlabelled", "mean_labels", "coverage", "coverage_low", "coverage_high"]
    got = measures.all_measures(q, l, ["track"])
    by = {(x.grouped_by, x.value): tuple(x[c] for c in columns) for x in got.collect()}
    want = {("all", None): tuple(measures.aggregate(q, l).select(*columns).first())} | {("track", x.track): tuple(x[c] for c in columns) for x in measures.aggregate(q, l, ["track"]).collect()}
    assert by == want and len(want) == 4


def test_components_equal_a_search(spark):
    r = random.Random(3)
    edges = [(r.randrange(120), r.randrange(120)) for _ in range(70)] + [(200 + k, 201 + k) for k in range(60)] + [(400, k) for k in range(300, 340)] + [(500, 500)]
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {x.node: x.root for x in got.collect()} == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("dice", [False, True])
@pytest.mark.parametrize("least", [0.3, 0.7, 1.0])
def test_overlapping_sets_equal_all_pairs(spark, dice, least):
    r = random.Random(5)
    make = lambda side, n: [(f"{side}{k}", sorted({f"m{int(r.random() ** 3 * 40)}" for _ in range(r.randrange(1, 12))})) for k in range(n)]
    left, right = make("l", 80), make("r", 90)
    score = lambda a, b: 2 * len(a & b) / (len(a) + len(b)) if dice else len(a & b) / len(a | b)
    want = {(i, j): score(set(a), set(b)) for i, a in left for j, b in right if score(set(a), set(b)) >= least}
    df = lambda rows: spark.createDataFrame(rows, "id string, members array<string>")
    assert {(x.left_id, x.right_id): x.score for x in matching.overlapping(df(left), df(right), least, dice).collect()} == want


def test_common_length_bounds_the_ratio():
    r = random.Random(7)
    for _ in range(500):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randrange(12))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert matching.common_length(a, b) == table[-1][-1]
        assert difflib.SequenceMatcher(None, a, b).ratio() * (len(a) + len(b)) <= 2 * table[-1][-1] + 1e-9


@pytest.mark.parametrize("least", [0.5, 0.7])
def test_similar_pairs_equal_all_pairs(spark, least):
    r = random.Random(6)
    words = "prouver par induction structurelle une équivalence écrire un programme récursif parcourir le graphe arbre é 😀 tri".split()
    def side(name, n):  # noqa: E301
        out = [(f"{name}.{'_'.join(r.choice(words) for _ in range(r.randrange(1, 5)))}{k % 7}", " ".join(r.choice(words) for _ in range(r.randrange(1, 6))).capitalize()) for k in range(n)]
        return out + [(f"{name}.", None), (f"{name}", ""), ("same_id", "Same"), (f"{name}.z", "!!"), (f"{name}.z", "Par le graphe")]

    asked, rows = side("gold", 120), side("mine", 150)
    want = {}
    for a, la in asked:
        for b, lb in rows:
            s = matching.similarity(la or "", a, lb or "", b)
            if s >= least:
                want[a, b] = max(s, want.get((a, b), 0))
    df = lambda x: spark.createDataFrame(x + x[:3] + [(None, "no id")], "id string, label string").selectExpr("*", "1 AS left", "'x' AS form")
    got = {(x.asked_id, x.row_id): x.score for x in matching.similar_pairs(df(asked), df(rows), least).collect()}
    assert got == want and len(want) > 100
    none = spark.createDataFrame([], "id string, label string")
    assert matching.similar_pairs(none, df(rows), least).count() == 0 and matching.similar_pairs(df(asked), none, least).count() == 0


def test_similarity_and_gold(spark):
    assert matching.similarity("Prouver par induction", "l.induction", "Prouver par l'induction", "l.prouver_induction") == max(
        difflib.SequenceMatcher(None, "prouver par induction", "prouver par l induction").ratio(), difflib.SequenceMatcher(None, "induction", "prouver_induction").ratio(), 0.5
    )
    gold = spark.createDataFrame([("g.path", "Find a path", "g"), ("g.cycles", "Detect cycles", "g"), ("t.x", "Something else", "t")], "id string, label string, section string")
    mine = spark.createDataFrame([("g.path", "Find a path", "g"), ("h.cycle", "Detect a cycle", "h"), ("q.zz", "Far away", "q")], "id string, label string, section string")
    out = {r.gold_id: (r.concept_id, r.how, r.other_section) for r in matching.match_gold(gold, mine).collect()}
    assert out == {"g.path": ("g.path", "exact", False), "g.cycles": ("h.cycle", "similar", True), "t.x": (None, "missing", False)}
    rec = {r.section: (r.gold, r.exact, r.matched) for r in matching.recall(matching.match_gold(gold, mine)).collect()}
    assert rec == {"all": (3, 1, 2), "g": (2, 1, 2), "t": (1, 0, 0)}
    lost = spark.createDataFrame([("g.path", None, None, "detect_cycle"), ("g.path", None, None, "qqqq")], "concept_id string, see string, see_type string, see_raw string")
    assert {r.see_raw: r.see for r in matching.repoint(lost, mine, 0.6).collect()}["qqqq"] is None


def test_label_checks(spark):
    q = spark.createDataFrame([("q1", "e", "Let $G$ be a graph with α ⩽ n vertices and edges")], "question_id string, exercise_id string, text string")
    s = spark.createDataFrame([("e", "g")], "exercise_id string, section_id string")
    rows = [("q1", 1, "h.a", "be a graph with alpha <= n"), ("q1", 2, "g.a", "too few"), ("q1", 3, "g.a", "this is not in the text"), ("q1", 4, "g.a", "be a graph with alpha <= n"), ("q1", 5, "g.a", "G be a graph with α"), ("qx", 6, "g.a", "x")]
    kept, out = labelling.validate_labels(spark.createDataFrame(rows, "question_id string, ord int, concept_id string, quote string"), q, s)
    assert [r.ord for r in kept.collect()] == [4]
    assert {r.ord: r.reason for r in out.collect()} == {1: "not_selected", 2: "too_short", 3: "not_literal", 5: "repeated"}
    a = spark.createDataFrame([("q1", 1, "ok", "sans_objet", "", "c"), ("q2", 1, "ok", "", "", "c")], "question_id string, ord int, status string, reason string, object string, language string")
    qs = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "question_id string")
    assert {r.question_id: (r.status, r.reason) for r in labelling.question_status(qs, a, kept).collect()} == {"q1": ("ok", None), "q2": ("indecidable", None), "q3": ("indecidable", None)}


def test_memo_and_replay(spark):
    calls = spark.createDataFrame([("e1", "m1"), ("e2", "m2")], "exercise_id string, message string").withColumn("key", labelling.call_key("run", "label", F.col("exercise_id"), F.col("message")))

    class Fake:
        def answer(self, system, message, schema):
            return {"echo": message}

    memo = labelling.ask(calls, Fake(), "s", {}).withColumn("ord", F.lit(1))
    assert labelling.to_call(calls, memo).count() == 0
    assert sorted(r.payload for r in labelling.answered(calls, memo).collect()) == ['{"echo": "m1"}', '{"echo": "m2"}']
    two = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "key string, ord int, payload string")
    assert [r.payload for r in labelling.latest(two).collect()] == ["new"]
    assert labelling.signature({"a": 1, "b": 2}) == labelling.signature({"b": 2, "a": 1})
    with pytest.raises(ValueError):
        labelling.check_protocol({"model": "x", "seed": None}, {"model": "y"})
    got = spark.createDataFrame([(["b", "zz", "b"],), (["a", "b", "c", "d", "e"],), ([],)], "s array<string>").select(labelling.kept_sections(F.col("s"), ["a", "b", "c", "d", "e"])).collect()
    assert [r[0] for r in got] == [["b", "a"], ["a", "b", "c", "d", "e"], ["a", "b"]]


def test_asof_with_a_hot_key(spark):
    r = random.Random(2)
    left = [(i, "hot" if r.random() < 0.6 else "cold", r.randrange(400000)) for i in range(150)]
    right = [(1000 + i, "hot" if r.random() < 0.6 else "cold", r.randrange(400000)) for i in range(60)]
    mk = lambda rows, name: spark.createDataFrame(rows, f"{name} int, k string, s int").selectExpr(name, "k", "timestamp_seconds(s) AS ts")
    got = {x.id: x.v for x in asof.asof_before(mk(left, "id"), mk(right, "v"), "k", "ts", "v", 3600).collect()}
    for i, k, s in left:
        best = max(((t, v) for v, kk, t in right if kk == k and t < s), default=(0, None))
        assert got[i] == best[1]


def test_quotes(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "xb c d e f gx"), (3, "one two"), (4, "zone twos")], "doc_id int, text string")
    items = spark.createDataFrame([(1, "b c d e f g"), (2, "c d e"), (3, "one two"), (4, "e")], "item_id int, text string")
    want = sorted((d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if i.text in d.text)
    assert sorted(map(tuple, quotes.containing(docs, items).collect())) == want


def test_probes_look_at_the_first_match(spark):
    rows = spark.createDataFrame([("a", "foo bar foo baz"), ("b", "foo baz"), ("c", "nothing")], "file string, text string")
    ps = [probes.Probe("p", "foo", anti="bar", status="created"), probes.Probe("q", "zz")]
    found = probes.attest(rows, ps, "file", around=8)
    assert sorted((r.probe, r.origin, r.rejected) for r in found.collect()) == [("p", "a", True), ("p", "b", False)]
    out = {r.probe: (r.origins, r.zones, r.rejected, r.admitted, r.change) for r in probes.admission(found, ps, 2).collect()}
    assert out == {"p": (1, 1, 1, False, "regression"), "q": (0, 0, 0, False, "none")}
    assert probes.report(found).count() == 1
    with pytest.raises(ValueError):
        probes.Probe("", "x")
    with pytest.raises(Exception):  # noqa: B017
        probes.Probe("bad", "(")


def test_probes_are_checked_in_the_dialect_that_runs_them(spark):
    with pytest.raises(ValueError, match="no pattern"):
        probes.Probe("n", r"(?P<a>the)")
    with pytest.raises(ValueError, match="no pattern"):
        probes.Probe("n", "a", anti="[")
    assert probes.Probe("n", r"(?<a>the)\p{L}").name == "n"


@pytest.mark.parametrize(("pattern", "words"), [
    ("tri fusion", ["tri fusion"]), ("(?i)Arbre", ["arbre"]), ("a(?:bc|def)g?", ["bc", "def"]), ("x*", None), ("a|b*", None), ("(pile|file)s? +LIFO", ["file", "pile"]), ("[aA]b", ["b"]),
    (r"\bgraphe\b", ["graphe"]), ("(?i)é tri", [" tri"]), ("(?iu)Tri par tas", ["tr", " par ta"][1:]), ("(?iu)ski", None), ("[[ab]c]d", None), (r"\p{L}x", None), ("(?<n>ab)", None), ("(?:ab){2,}c", ["ab"]), ("(?:ab)?c", ["c"]), ("(?!no)yes", ["yes"]), ("(?i:AB)cd", ["ab"]), ("a.b", ["a"]),
])
def test_literals_that_a_match_must_hold(pattern, words):
    assert probes.required(pattern) == words


def test_many_probes_equal_one_by_one(spark):
    r = random.Random(10)
    stems = ["arbre", "Pile", "graphe", "tri", "é", "hash", "x", "LIFO", "bc"]
    forms = ["{}", "(?i){}", "{} ?{}", "{}|{}", "(?:{}|{})s?", "[a-c]+{}", "{}.{{0,3}}{}", "\\b{}\\b", "(?i){}$", "^{}", "{}+", "({})?{}", "\\d{}", "(?=.*{}){}"]
    ps = [probes.Probe(f"p{k}", (f := r.choice(forms)).format(*[r.choice(stems) for _ in range(f.count("{}"))]), r.choice([None, None, r.choice(stems)])) for k in range(150)]
    texts = [(k, "".join(r.choice([*stems, " ", " ", "s", "1", "\n", "ABRE", "arBRE"]) for _ in range(r.randrange(14)))) for k in range(150)] + [(150, None), (151, ""), (152, "ΑΣΑ pile 😀 tri")]
    want = []
    for p in ps:
        for k, t in texts:
            if t and (m := re.search(p.pattern.replace("$", r"(?=\n?\Z)"), t)):
                excerpt = " ".join(t[max(0, m.start() - 3) : m.end() + 3].split())
                want.append((p.name, k, excerpt, bool(p.anti and re.search(p.anti, excerpt))))
    df = spark.createDataFrame(texts, "file long, text string").selectExpr("*", "1 AS k", "'x' AS pattern")
    assert sorted(map(tuple, probes.attest(df, ps, "file", around=3).collect())) == sorted(want) and len(want) > 1000


def test_dispersion_of_empty_sets_is_zero(spark):
    a = spark.createDataFrame([("e", None), ("f", "g.a"), ("h", "g.a")], "exercise_id string, concept_id string")
    b = spark.createDataFrame([("e", None), ("f", "g.a"), ("f", "g.b")], "exercise_id string, concept_id string")
    q = spark.createDataFrame([("e", 1), ("f", 2), ("f", 3)], "exercise_id string, question_id int")
    assert {r.exercise_id: (r.gap, r.gap_per_question, r.jaccard) for r in compare.dispersion(a, b, q).collect()} == {"e": (0, 0.0, 0.0), "f": (1, 0.5, 0.5)}


def test_upsert_and_ranks(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, dedup.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, dedup.insert_missing(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "d")]
    rows = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "id string, ord int")
    out = measures.with_rank(rows, ["id"], ["ord"]).select(measures.ranked_id(F.col("id"), F.col("rank")).alias("r"))
    assert sorted(x.r for x in out.collect()) == ["x", "x~2", "y"]


def test_records(spark):
    rows = spark.createDataFrame([("2021_InfoC-0.md", "graphs.shortest_path", "ocaml", "c", "mpi"), ("odd.md", "logic.proof", "theorique", None, "mpi")], "file string, concept_id string, language string, paper_language string, track string")
    out = {r.concept_id: r for r in records.records(rows).collect()}
    a, b = out["graphs.shortest_path"], out["logic.proof"]
    assert (a.year, a.exam, a.section, a.concept, a.language, a.type) == (2021, "InfoC", "graphs", "Shortest path", "OCaml", "Algorithmique")
    assert (b.year, b.exam, b.type) == (None, "Inconnu", "Théorie")
    assert records.facets(records.records(rows), years=[2021]).count() == 1
    cat = spark.createDataFrame([("graphs.shortest_path", "graphs"), ("graphs.cycle", "graphs")], "concept_id string, section_id string")
    assert [tuple(r) for r in records.section_totals(records.records(rows), cat).collect()] == [("graphs", 1, 1, 2)]
    assert {r.concept_id: r.type for r in records.concept_types(records.records(rows), cat).collect()}["graphs.cycle"] == "Théorie"
    lv = {r.c: (r.linear, r.ranked) for r in records.levels(spark.createDataFrame([("a", 0), ("b", 1), ("c", 10)], "c string, weight int")).collect()}
    assert lv["a"][0] == 0 and lv["c"] == (5, 5)
    assert "<\\/script>" in records.page(spark.createDataFrame([("</script>",)], "t string"), "x")


def test_text_functions(spark):
    import hashlib

    rows = spark.createDataFrame([("Œuvre Été à l'ÉCOLE\r\nx", "a\x1e")], "t string, u string")
    r = rows.select(tx.slug(F.col("t")), tx.fingerprint(F.col("t"), F.col("u")), tx.literal_form(F.lit("*τ* (G) ⩽ `x`")), tx.humanise(F.lit("graphes_REPR")), tx.year_text(F.lit("20x")), tx.newlines(F.col("t")), tx.line_number(F.lit("a\nb\nc"), F.lit(4)), tx.word_count(F.lit(" a b  c ")), tx.clean_block(F.lit("  a  \n b \n\n")), tx.nothing_as_null(F.lit("sans_objet"))).first()
    assert r[0] == "uvre-ete-a-l-ecole-x"
    assert r[1] == hashlib.sha256("Œuvre Été à l'ÉCOLE\r\nx\x1ea\x1e\x1e".encode()).hexdigest()[:16]
    assert r[2] == "tau(g)<=x" and r[3] == "Graphes repr" and r[4] == "?" and r[5].count("\r") == 0
    assert r[6] == 3 and r[7] == 3 and r[8] == "a\n b" and r[9] is None


def test_offsets(spark):
    import re

    from gaugeworks.functions.offsets import matches

    t = "é😀 ab1 cd22\n\nab333"
    got = spark.createDataFrame([(t,)], "t string").select(matches(F.col("t"), "[a-d]+[0-9]+").alias("m")).first().m
    assert [(m.start, m.end, m.match) for m in got] == [(m.start(), m.end(), m[0]) for m in re.finditer("[a-d]+[0-9]+", t)]


def test_blocks_keep_their_blank_lines(spark):
    rows = spark.createDataFrame([("  a \t\n\n b\u00a0\n\n\nc  \n\n",), ("",), (" \n ",), (None,)], "t string")
    assert [r[0] for r in rows.select(tx.clean_block(F.col("t"))).collect()] == ["a\n\n b\n\n\nc", "", "", None]


def test_tracks_end_at_a_title_of_higher_rank(spark):
    from gaugeworks.operators import papers

    titles = [(1, 2, "Intro"), (2, 2, "Annexe filière MPI"), (3, 2, "Exercice"), (4, 3, "Suite"), (5, 1, "Partie"), (6, 2, "Exercice"), (7, 2, "Filière MP"), (8, 2, "Fin")]
    e = spark.createDataFrame([("d", ex, level, t, "x") for ex, level, t in titles], "doc_file string, ex long, level int, title string, track string")
    docs = spark.createDataFrame([("d", "non_marque")], "doc_file string, track string")
    got = [r.track for r in papers.propagate_track(e, docs).orderBy("ex").collect()]
    assert got == ["non_marque", "mpi", "mpi", "mpi", "non_marque", "non_marque", "mp_info", "mp_info"]


def test_humanise_and_exam_from_the_exercise(spark):
    rows = spark.createDataFrame([("x.md", "2021_X-info/e1", "g.a", None, None, "mpi"), ("2020_Y.md", "2021_X/e1", "g._b", None, None, "mpi"), (None, "none", "g.c", None, None, "mpi")], "file string, exercise_id string, concept_id string, language string, paper_language string, track string")
    out = {r.concept_id: (r.year, r.concept) for r in records.records(rows).collect()}
    assert out == {"g.a": (2021, "A"), "g._b": (2020, "B"), "g.c": (None, "C")}


def test_totals_count_unlisted_values(spark):
    q = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, None), (4, "a", None)], "question_id int, r string, c string")
    assert sorted(map(tuple, measures.contingency(q, "r", "c", ["x"]).collect())) == [("None", 0, 1), ("a", 1, 3)]


def test_a_few_probes_need_no_python(spark):
    rows = spark.createDataFrame([("a", "x@y.z"), ("b", "none"), ("c", None)], "source string, text string")
    ps = [probes.Probe("mail", "[a-z]+@[a-z.]+"), probes.Probe("word", "(?i)NONE")]
    found = probes.attest(rows, ps, "source")
    assert "Python" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.probe, r.origin, r.excerpt) for r in found.collect()) == [("mail", "a", "x@y.z"), ("word", "b", "none")]


def test_literals_with_optional_letters_and_letters_that_others_equal(spark):
    assert probes.required("the ?und") == ["the und", "theund"]
    assert probes.required("(?iu)queing", paired=True) == ["queing"] and probes.required("(?iu)üthe", paired=True) == ["üthe"]
    ps = [probes.Probe(p, p) for p in ("(?iu)ski", "(?iu)été ?x", "(?i)été", "été", "(?iu)kiss", "s ?k", "(?iu)Åre", "(?iu)ÿb", "(?iu)straße", "(?i)ski") for p in (p, f"{p}(?:1|)")]
    assert len(ps) > probes.FEW
    texts = ["SKİ", "ſKı", "ÉTÉ X", "étéx", "ÉTé", "KISS", "kıſS", "s k", "S K", "Åre", "åRE", "Åre", "ŸB", "STRAẞE", "ski 日本", ""]
    rows = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "source string, text string")
    got = sorted((r.probe, r.origin) for r in probes.attest(rows, ps, "source").collect())
    want = sorted((p.name, r.source) for p in ps for r in rows.filter(rows.text.rlike(p.pattern)).collect())
    assert got == want and len(want) > 20


def test_excerpts_are_not_made_for_admission_without_anti_patterns(spark):
    rows = spark.createDataFrame([("a", "x@y.z")], "source string, text string")
    out = probes.admission(probes.attest(rows, [probes.Probe("mail", "@")], "source"), [probes.Probe("mail", "@")])
    assert "split(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_all_measures_sort_no_questions_by_group(spark):
    """Distinct counts whose state can't be hashed sort each question as often as there are sets and labels."""
    q = spark.createDataFrame([(1, "e", "t", "ok"), (2, "e", None, "P"), (3, None, "u", "ok")], "question_id long, exercise_id string, track string, status string")
    l = spark.createDataFrame([(1, "a.x"), (1, "a.x"), (2, "a.y"), (3, None)], "question_id long, concept_id string")
    found = measures.all_measures(q, l, ["track"])
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.grouped_by, r.value): (r.questions, r.labels, r.exercises, r.concepts) for r in found.collect()} == {("all", None): (3, 4, 2, 2), ("track", "t"): (1, 2, 1, 1), ("track", None): (1, 1, 1, 1), ("track", "u"): (1, 1, 1, 0)}
