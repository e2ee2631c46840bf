"""The driver's contract, with and without the optional subpackage."""

import os
import subprocess
import sys

import pytest

import __spark_entry__

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_it_imports_without_the_optional_parts():
    code = (
        "import sys, importlib.abc\n"
        "class No(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name.startswith(('gaugeworks.llm', 'corpus_pipeline')): raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "assert 'top_concepts' in e.queries() and 'pipeline' not in e.queries() and not [q for q in e.queries() if q.startswith('op')]\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_the_flagship_query_runs(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert len(rows) == 20 and rows[0].questions >= rows[-1].questions


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["distribution_global", "dispersion_runs", "grouping_sets_all", "probes_two_sources", "literal_extract", "contingency_year_track", "paper_questions", "syllabus_units", "label_checks", "question_fates", "decision_findings", "decision_set", "slug_names", "assembled", "paper_summaries", "section_findings", "section_survivors", "official_list", "call_candidates", "best_tracks", "memo_replay", "concepts_for_import", "probe_files", "memo_files", "run_files", "overlapping_sets", "gold_matches", "many_probes", "published_labels", "all_measures"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for f in os.listdir(d):
        con.execute(f"create view {f.split('.')[0]} as select * from '{d}/{f}'")
    got = __spark_entry__.queries()[name](spark, d).toPandas()
    want = con.sql(__spark_entry__.oracle_sql()[name]).df()[list(got.columns)]
    key = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.astype(object).where(df.notna(), "null").itertuples(index=False))
    assert list(map(str, key(got))) == list(map(str, key(want)))
