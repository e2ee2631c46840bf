"""Segmentation of a syllabus of our own."""

import pytest

from gaugeworks.operators import syllabus

TEXT = """Before any heading.
# 1 Graphs (S1)
| Notions | Commentaires |
|---|---|
| Paths and cycles. | Defined on directed |
| | graphs. S2 |
| Trees. | Rooted ones only. |
| with leaves | and nodes. |

## 1.2 Searching
Breadth first and depth first searching of a graph are both needed here.
Only the iterative form is required; recursion is not required.

short line

### Mise en œuvre
The students write programs that search graphs in one of the languages.

# A Language
- Loops, conditions and functions of the language are known.
- tiny
# Unnumbered part
Text under the unnumbered part that still belongs to the annex section flag.
"""


@pytest.fixture(scope="module")
def s(spark):
    return syllabus.segment(spark.createDataFrame([("p.md", TEXT), ("empty.md", "")], "doc_file string, text string"))


def test_units(s):
    u = {r.id: r for r in s.units.collect()}
    assert set(u) == {"1/table/01", "1/table/02", "1.2/prose/01", "1.2/mise_en_oeuvre/01", "A/annexe/01", "unnumbered-part/annexe/01"}
    assert (u["1/table/01"].left, u["1/table/01"].right, u["1/table/01"].semester) == ("Paths and cycles.", "Defined on directed graphs. S2", "S2")
    assert (u["1/table/02"].left, u["1/table/02"].right) == ("Trees. with leaves", "Rooted ones only. and nodes.")
    assert u["1.2/prose/01"].text.startswith("Breadth first") and u["1.2/prose/01"].text.endswith("not required.")
    assert u["1.2/prose/01"].last_line == u["1.2/prose/01"].first_line + 1


def test_sections_and_paths(s):
    p = {r.section_id: (r.title, r.path) for r in s.sections.collect()}
    assert p["1"] == ("Graphs", ["Graphs"]) and p["1.2"] == ("Searching", ["Graphs", "Searching"])
    assert p["unnumbered-part"][1] == ["Unnumbered part"]


def test_rejections(spark):
    docs = spark.createDataFrame([("p.md", TEXT)], "doc_file string, text string")
    s = syllabus.segment(docs, ["annexe", "table"])
    assert sorted(r.id for r in s.rejected.collect()) == ["A/annexe/01", "unnumbered-part/annexe/01"]
    assert sum(r.kind == "table" for r in s.units.collect()) == 2
    left = syllabus.leave_out(s, titles=["SEARCH"], prefixes=["7"])
    assert {r.section_id for r in left.units.collect()} == {"1"}
    assert left.rejected.count() == 4


def test_mentions_and_admission(spark, s):
    docs = spark.createDataFrame([("p.md", TEXT)], "doc_file string, text string")
    got = [(r.id, r.phrase, r.section_id) for r in syllabus.mentions(docs, ["only", "not required"], s.sections.filter("doc_file = 'p.md'")).orderBy("id").collect()]
    assert [g[0] for g in got] == ["m001", "m002", "m003"]
    assert got[0][1] == "Rooted ones only." and got[0][2] == "1"
    assert got[1][2] == "1.2" and got[2][1].startswith("recursion")
    assert [r.ok for r in syllabus.admissible(s, 4, 0.5, 0.5).collect()] == [True]


def test_rows_of_a_long_table_are_numbered_not_gathered(spark):
    """Over several blocks: every third physical row opens a logical one, wherever a block ends; the array that is made holds a number a row."""
    from pyspark.sql import functions as F

    cells = [(f"Entry {k}", "Some") if k % 3 == 0 else ("", f"more {k}") if k % 3 == 1 else ("end.", "of it.") for k in range(1000)]
    table = spark.createDataFrame([([(k, a, b) for k, (a, b) in enumerate(cells)],)], "rows array<struct<line_no:int,left:string,right:string>>")
    assert table.select(syllabus.entries(F.col("rows"))).first()[0] == [k // 3 + 1 for k in range(1000)]
    text = "# 1 Long\n" + "".join(f"| {a} | {b} |\n" for a, b in cells)
    u = syllabus.segment(spark.createDataFrame([("l.md", text)], "doc_file string, text string")).units.orderBy("first_line").collect()
    assert len(u) == 334 and (u[100].left, u[100].right, u[100].first_line, u[100].last_line) == ("Entry 300 end.", "Some more 301 of it.", 302, 304)
