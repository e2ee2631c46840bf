"""One query for each measure over the tables at hand, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions import text as tx
from gaugeworks.functions.offsets import matches
from gaugeworks.operators import compare, dedup, measures, probes
from gaugeworks.plans import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

CORPUS_SQL = """
    q AS (
        SELECT o_orderkey AS question_id, o_custkey AS exercise_id, c_mktsegment AS track,
               CASE WHEN o_orderstatus = 'F' THEN 'ok' ELSE o_orderstatus END AS status,
               CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS language
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    ), l AS (
        SELECT l_orderkey AS question_id, p_type || '.' || p_brand AS concept_id, p_type AS section_id, l_partkey AS part_id, l_linestatus AS run
        FROM lineitem JOIN part ON p_partkey = l_partkey
    ), cat AS (SELECT DISTINCT p_type || '.' || p_brand AS concept_id, p_type AS section_id FROM part),
    n AS (SELECT question_id, count(*) AS n FROM l GROUP BY 1),
    s AS (SELECT q.*, coalesce(n, 0) AS n_labels FROM q LEFT JOIN n USING (question_id))
"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return put


def _aggregate_sql(by: str | None) -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    used = f"SELECT {key}count(DISTINCT concept_id) AS concepts FROM l JOIN q USING (question_id) {group}"
    join = f"LEFT JOIN u ON u.{by} IS NOT DISTINCT FROM a.{by}" if by else "CROSS JOIN u"
    return f"""
        WITH {CORPUS_SQL}, u AS ({used}), a AS (
            SELECT {key}count(*) AS questions, CAST(sum(n_labels) AS BIGINT) AS labels, count(DISTINCT exercise_id) AS exercises,
                   count(*) FILTER (n_labels = 0) AS unlabelled, round(100.0::DOUBLE * count(*) FILTER (status = 'ok') / count(*), 6) AS coverage
            FROM s {group})
        SELECT {f"a.{by}, " if by else ""}questions, labels, exercises, coalesce(concepts, 0) AS concepts, unlabelled,
               round(labels::DOUBLE / questions, 6) AS mean_labels, coverage,
               round(greatest(coverage - 10.7, 0), 6) AS coverage_low, round(least(coverage + 10.7, 100), 6) AS coverage_high
        FROM a {join}
    """


@query(_aggregate_sql(None))
def distribution_global(spark: SparkSession, d: str) -> DataFrame:
    return measures.aggregate(fx.questions(spark, d), fx.labels(spark, d))


def _by(field: str, name: str) -> None:
    def f(spark: SparkSession, d: str) -> DataFrame:
        return measures.aggregate(fx.questions(spark, d), fx.labels(spark, d), [field])

    f.__name__ = name
    query(_aggregate_sql(field))(f)


for _field, _name in (("track", "by_track"), ("year", "by_year"), ("language", "by_language"), ("exercise_id", "by_exercise")):
    _by(_field, _name)

KINDS = (("URGENT", "exam"), ("HIGH", "exam"), ("MEDIUM", "report"), ("NOT", "workshop"))


@query(f"""
    WITH {CORPUS_SQL}
    SELECT CASE WHEN contains(language, 'URGENT') THEN 'exam' WHEN contains(language, 'HIGH') THEN 'exam' WHEN contains(language, 'MEDIUM') THEN 'report'
                WHEN contains(language, 'NOT') THEN 'workshop' ELSE 'other' END AS kind, count(*) AS questions, CAST(sum(n_labels) AS BIGINT) AS labels
    FROM s GROUP BY 1
""")
def by_kind(spark: SparkSession, d: str) -> DataFrame:
    q = measures.sized(fx.questions(spark, d), fx.labels(spark, d)).withColumn("kind", tx.kind_of(F.col("language"), KINDS, "other"))
    return q.groupBy("kind").agg(F.count(F.lit(1)).alias("questions"), F.sum("n_labels").alias("labels"))


@query(f"""
    WITH {CORPUS_SQL}
    SELECT concept_id, count(DISTINCT question_id) AS questions, count(*) AS occurrences,
           round(100.0::DOUBLE * count(DISTINCT question_id) / (SELECT count(*) FROM q), 6) AS share_of_questions,
           round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM l), 6) AS share_of_labels
    FROM l GROUP BY 1 ORDER BY questions DESC, concept_id LIMIT 20
""")
def top_concepts(spark: SparkSession, d: str) -> DataFrame:
    return measures.top_concepts(fx.questions(spark, d), fx.labels(spark, d), 20)


@query(f"""
    WITH {CORPUS_SQL}, c AS (SELECT concept_id, count(DISTINCT question_id) AS questions, count(*) AS occ FROM l GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY questions DESC, concept_id) AS rank FROM c), t(top_n) AS (VALUES (1), (5), (10), (20), (50))
    SELECT CAST(top_n AS BIGINT) AS top_n, CAST((SELECT sum(occ) FROM r WHERE rank <= top_n) AS BIGINT) AS occurrences,
           round(100.0::DOUBLE * (SELECT sum(occ) FROM r WHERE rank <= top_n) / (SELECT count(*) FROM l), 6) AS share FROM t
""")
def concentration_top_n(spark: SparkSession, d: str) -> DataFrame:
    return measures.concentration(fx.labels(spark, d))


@query(f"""
    WITH {CORPUS_SQL}, u AS (SELECT split_part(concept_id, '.', 1) AS section_id, count(DISTINCT concept_id) AS used, count(*) AS occurrences FROM l GROUP BY 1)
    SELECT section_id, count(*) AS concepts, coalesce(any_value(used), 0) AS used, coalesce(any_value(occurrences), 0) AS occurrences,
           round(100.0::DOUBLE * coalesce(any_value(occurrences), 0) / (SELECT count(*) FROM l), 6) AS share
    FROM cat LEFT JOIN u USING (section_id) GROUP BY 1
""")
def section_usage(spark: SparkSession, d: str) -> DataFrame:
    return measures.section_usage(fx.labels(spark, d), fx.catalogue(spark, d))


@query(f"""
    WITH {CORPUS_SQL}, asked AS (SELECT DISTINCT part_id FROM l JOIN q USING (question_id) WHERE status = 'P' AND track = 'BUILDING'),
    z AS (SELECT p_type AS section_id, p_partkey AS concept_id FROM part WHERE p_partkey NOT IN (SELECT part_id FROM asked))
    SELECT section_id, concept_id, count(*) OVER (PARTITION BY section_id) AS silent FROM z
""")
def never_asked(spark: SparkSession, d: str) -> DataFrame:
    """Parts as concepts: those that no unfinished question of one track asks for."""
    q = fx.questions(spark, d).filter("status = 'P' AND track = 'BUILDING'")
    asked = fx.labels(spark, d).join(q, "question_id", "left_semi").select(F.col("part_id").alias("concept_id"))
    parts = fx.concepts(spark, d).select(F.col("p_partkey").alias("concept_id"), "section_id")
    return measures.never_asked(asked, parts)


@query(
    f"WITH {CORPUS_SQL} SELECT concept_id, "
    + ", ".join(f"count(*) FILTER (language = '{p}') AS \"{p}\"" for p in fx.PRIORITIES)
    + " FROM l JOIN q USING (question_id) GROUP BY 1"
)
def crosstab_concept_language(spark: SparkSession, d: str) -> DataFrame:
    return measures.crosstab(fx.questions(spark, d), fx.labels(spark, d), "language", fx.PRIORITIES)


@query(f"""
    WITH {CORPUS_SQL}
    SELECT coalesce(CAST(year AS VARCHAR), 'None') AS year, count(*) FILTER (track = 'AUTOMOBILE') AS "AUTOMOBILE", count(*) FILTER (track = 'BUILDING') AS "BUILDING",
           count(*) FILTER (track = 'FURNITURE') AS "FURNITURE", count(*) FILTER (track = 'HOUSEHOLD') AS "HOUSEHOLD",
           count(*) AS total
    FROM q GROUP BY 1
""")
def contingency_year_track(spark: SparkSession, d: str) -> DataFrame:
    """One track is not listed as a column: the total counts it all the same."""
    return measures.contingency(fx.questions(spark, d), "year", "track", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"))


@query(f"WITH {CORPUS_SQL} SELECT status, count(*) AS questions FROM q GROUP BY 1")
def status_histogram(spark: SparkSession, d: str) -> DataFrame:
    return measures.status_histogram(fx.questions(spark, d))


@query(f"""
    WITH {CORPUS_SQL}
    SELECT CASE WHEN grouping(track) = 0 THEN 'track' WHEN grouping(year) = 0 THEN 'year' WHEN grouping(language) = 0 THEN 'language' WHEN grouping(status) = 0 THEN 'status' ELSE 'all' END AS grouped_by,
           coalesce(track, CAST(year AS VARCHAR), language, status) AS value, count(*) AS questions, CAST(sum(n_labels) AS BIGINT) AS labels,
           count(*) FILTER (n_labels = 0) AS unlabelled, round(100.0::DOUBLE * count(*) FILTER (status = 'ok') / count(*), 6) AS coverage
    FROM s GROUP BY GROUPING SETS ((), (track), (year), (language), (status))
""")
def grouping_sets_all(spark: SparkSession, d: str) -> DataFrame:
    return measures.everything(fx.questions(spark, d), fx.labels(spark, d), ("track", "year", "language", "status"))


def _runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Labels of two runs with their exercises."""
    rows = fx.labels(spark, d).join(fx.questions(spark, d).select("question_id", "exercise_id"), "question_id")
    return rows.filter("run = 'F'"), rows.filter("run = 'O'")


@query(f"""
    WITH {CORPUS_SQL}, x AS (SELECT exercise_id, question_id, concept_id, run FROM l JOIN q USING (question_id)),
    g AS (
        SELECT exercise_id, count(DISTINCT question_id) FILTER (run = 'F') AS questions, count(*) FILTER (run = 'F') AS labels_a, count(*) FILTER (run = 'O') AS labels_b,
               coalesce(list(DISTINCT concept_id) FILTER (run = 'F'), []) AS a, coalesce(list(DISTINCT concept_id) FILTER (run = 'O'), []) AS b
        FROM x GROUP BY 1)
    SELECT exercise_id, questions, labels_a, labels_b, abs(labels_a - labels_b) AS gap, round(abs(labels_a - labels_b)::DOUBLE / greatest(questions, 1), 6) AS gap_per_question,
           round(len(list_intersect(a, b))::DOUBLE / greatest(len(list_distinct(list_concat(a, b))), 1), 6) AS jaccard
    FROM g WHERE labels_a > 0 AND labels_b > 0
""")
def dispersion_runs(spark: SparkSession, d: str) -> DataFrame:
    a, b = _runs(spark, d)
    return compare.dispersion(a.select("exercise_id", "concept_id"), b.select("exercise_id", "concept_id"), a)


@query(f"""
    WITH {CORPUS_SQL}, m AS (
        SELECT run, count(*) AS labels, count(DISTINCT question_id) AS questions, count(DISTINCT concept_id) AS concepts, count(DISTINCT part_id) AS parts FROM l GROUP BY 1
    ), a AS (SELECT * FROM m WHERE run = 'F'), b AS (SELECT * FROM m WHERE run = 'O')
    SELECT 'labels' AS measure, a.labels::DOUBLE AS a, b.labels::DOUBLE AS b, round((b.labels - a.labels)::DOUBLE, 6) AS delta FROM a, b
    UNION ALL SELECT 'questions', a.questions, b.questions, b.questions - a.questions FROM a, b
    UNION ALL SELECT 'concepts', a.concepts, b.concepts, b.concepts - a.concepts FROM a, b
    UNION ALL SELECT 'parts', a.parts, b.parts, b.parts - a.parts FROM a, b
""")
def compare_runs(spark: SparkSession, d: str) -> DataFrame:
    l = fx.labels(spark, d)
    columns = ["labels", "questions", "concepts", "parts"]
    one = lambda run: l.filter(F.col("run") == run).agg(F.count(F.lit(1)).alias("labels"), F.count_distinct("question_id").alias("questions"), F.count_distinct("concept_id").alias("concepts"), F.count_distinct("part_id").alias("parts"))
    return compare.delta(one("F"), one("O"), columns)


_PART_FATES = """
    t AS (SELECT DISTINCT part_id, track FROM l JOIN q USING (question_id)), a AS (SELECT part_id FROM t WHERE track = 'BUILDING'), b AS (SELECT part_id FROM t WHERE track = 'MACHINERY'),
    f AS (SELECT p_partkey AS concept_id, p_type AS section_id, p_partkey IN (SELECT * FROM a) AS in_a, p_partkey IN (SELECT * FROM b) AS in_b FROM part)
"""


@query(f"WITH {CORPUS_SQL}, {_PART_FATES} SELECT concept_id, section_id, CASE WHEN in_a AND in_b THEN 'kept' WHEN in_b THEN 'gained' WHEN in_a THEN 'lost' ELSE 'silent' END AS fate FROM f")
def set_ops_runs(spark: SparkSession, d: str) -> DataFrame:
    """Parts as concepts, two tracks as the runs."""
    rows = fx.labels(spark, d).join(fx.questions(spark, d).select("question_id", "track"), "question_id").select(F.col("part_id").alias("concept_id"), "track")
    parts = fx.concepts(spark, d).select(F.col("p_partkey").alias("concept_id"), "section_id")
    return compare.coverage_changes(rows.filter("track = 'BUILDING'"), rows.filter("track = 'MACHINERY'"), parts)


@query(f"""
    WITH {CORPUS_SQL}, {_PART_FATES}, g AS (SELECT section_id, bool_or(in_a) AS a, bool_or(in_b) AS b FROM f GROUP BY 1)
    SELECT section_id, CASE WHEN NOT a AND b THEN 'woken' WHEN NOT a AND NOT b THEN 'silent' ELSE 'steady' END AS fate FROM g
""")
def section_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.labels(spark, d).join(fx.questions(spark, d).select("question_id", "track"), "question_id").select(F.col("part_id").alias("concept_id"), "track")
    parts = fx.concepts(spark, d).select(F.col("p_partkey").alias("concept_id"), "section_id")
    return compare.section_changes(rows.filter("track = 'BUILDING'"), rows.filter("track = 'MACHINERY'"), parts)


_LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS rank,
           CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) = 1 THEN l_orderkey || '#' || l_linenumber
                ELSE l_orderkey || '#' || l_linenumber || '~' || row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) END AS id
    FROM lineitem
""")
def repeat_rank(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.table(spark, d, "lineitem")
    ranked = measures.with_rank(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    key = F.concat_ws("#", "l_orderkey", "l_linenumber")
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("rank").cast("long").alias("rank"), measures.ranked_id(key, F.col("rank")).alias("id"))


@query("""
    WITH d AS (SELECT doc_id, left(sha256(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g')), 16) AS fingerprint FROM documents)
    SELECT doc_id, fingerprint, min(doc_id) OVER w AS first_id, count(*) OVER w AS copies, doc_id = min(doc_id) OVER w AS kept
    FROM d WINDOW w AS (PARTITION BY fingerprint)
""")
def fingerprint_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.by_content(fx.table(spark, d, "documents"))


@query("""
    SELECT doc_id, length(text) AS source_chars, length(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'), ' ')) AS kept_chars,
           round(length(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'), ' '))::DOUBLE / greatest(length(text), 1), 6) AS ratio,
           length(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'), ' '))::DOUBLE / greatest(length(text), 1) < 0.95 AS low
    FROM documents
""")
def conservation_ratio(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    kept = F.length(F.trim(F.regexp_replace(text, "[ \\t\\r\\n]+", " ")))
    ratio = kept / F.greatest(F.length(text), F.lit(1))
    return fx.table(spark, d, "documents").select("doc_id", F.length(text).cast("long").alias("source_chars"), kept.cast("long").alias("kept_chars"), F.round(ratio, 6).alias("ratio"), (ratio < 0.95).alias("low"))


NOISE = r"(?m)^[ \t]*[0-9]{1,3}[ \t]*$"


@query("""
    WITH m AS (SELECT doc_id, regexp_extract_all(text, '(?m)^[ \\t]*[0-9]{1,3}[ \\t]*$') AS m FROM documents)
    SELECT doc_id, len(m) AS noise_lines, coalesce(CAST(list_sum(list_transform(m, lambda x: length(x))) AS BIGINT), 0) AS noise_chars FROM m
""")
def noise_lines(spark: SparkSession, d: str) -> DataFrame:
    m = F.regexp_extract_all("text", F.lit(NOISE), F.lit(0))
    rows = fx.table(spark, d, "documents").select("doc_id", m.alias("m"))
    return rows.select("doc_id", F.size("m").cast("long").alias("noise_lines"), F.aggregate("m", F.lit(0), lambda a, x: a + F.length(x)).cast("long").alias("noise_chars"))


PROBES = (
    probes.Probe("licence", "(?i)licen[sc]ed? under", anti="(?i)apache", status="created"),
    probes.Probe("copyright", "(?i)copyright", status="candidate"),
    probes.Probe("mail", "[A-Za-z0-9._]+@[A-Za-z0-9.]+", status="open"),
    probes.Probe("nothing", "zzzzqqqq", status="created"),
)


def _probe_sql() -> str:
    rows = []
    for p in PROBES:
        first = f"regexp_extract(text, '{p.pattern}', 0)"
        at = f"(instr(text, {first}) - 1)"
        left = f"greatest({at} - 80, 0)"
        cut = f"trim(regexp_replace(substring(text, {left} + 1, {at} + length({first}) + 80 - {left}), '\\s+', ' ', 'g'), ' ')"
        rejected = f"regexp_matches({cut}, '{p.anti}')" if p.anti else "false"
        rows.append(f"SELECT '{p.name}' AS probe, source AS origin, {rejected} AS rejected FROM documents WHERE regexp_matches(text, '{p.pattern}')")
    names = ", ".join(f"('{p.name}', '{p.status}')" for p in PROBES)
    return f"""
        WITH att AS ({' UNION ALL '.join(rows)}), named(probe, status) AS (VALUES {names}),
        k AS (SELECT probe, count(DISTINCT origin) FILTER (NOT rejected) AS origins, count(*) FILTER (NOT rejected) AS zones, count(*) FILTER (rejected) AS rejected FROM att GROUP BY 1),
        x AS (SELECT probe, status, coalesce(origins, 0) AS origins, coalesce(zones, 0) AS zones, coalesce(rejected, 0) AS rejected FROM named LEFT JOIN k USING (probe))
        SELECT *, origins >= 2 AS admitted, CASE WHEN status = 'created' AND origins < 2 THEN 'regression' WHEN status IN ('candidate', 'open') AND origins >= 2 THEN 'promotion' ELSE 'none' END AS change FROM x
    """


@query(_probe_sql())
def probes_two_sources(spark: SparkSession, d: str) -> DataFrame:
    return probes.admission(probes.attest(fx.table(spark, d, "documents"), PROBES, "source"), PROBES, 2)


@query("""
    WITH u AS (SELECT conv_id, turn, text, role, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, turn, text AS question, CASE WHEN next_role = 'assistant' THEN next_text END AS solution FROM u WHERE role = 'user'
""")
def question_solution_fold(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    w = W.partitionBy("conv_id").orderBy("turn")
    rows = fx.table(spark, d, "conversations").select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("next_text"))
    return rows.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"), F.when(F.col("next_role") == "assistant", F.col("next_text")).alias("solution"))


HEADING = r"<h[1-6][^>]*>"


@query(f"""
    SELECT page_id, len(regexp_extract_all(html, '{HEADING}')) AS headings, len(regexp_extract_all(html, '<li>')) AS items,
           coalesce(list_min(list_transform(regexp_extract_all(html, '<h([1-6])', 1), lambda x: CAST(x AS INT))), 0) AS top_level,
           CASE WHEN regexp_matches(html, '{HEADING}') THEN length(split_part(html, regexp_extract(html, '{HEADING}', 0), 1)) ELSE -1 END AS first_at
    FROM pages
""")
def page_headings(spark: SparkSession, d: str) -> DataFrame:
    found = matches(F.col("html"), HEADING)
    rows = fx.table(spark, d, "pages").select("page_id", "html", found.alias("h"))
    level = F.array_min(F.transform("h", lambda x: F.substring(x["match"], 3, 1).cast("int")))
    return rows.select(
        "page_id",
        F.size("h").cast("long").alias("headings"),
        F.size(F.regexp_extract_all("html", F.lit("<li>"), F.lit(0))).cast("long").alias("items"),
        F.coalesce(level, F.lit(0)).alias("top_level"),
        F.when(F.size("h") > 0, F.element_at("h", 1)["start"]).otherwise(-1).cast("long").alias("first_at"),
    )


@query("""
    SELECT p_partkey, coalesce(nullif(left(trim(regexp_replace(lower(strip_accents(p_name)), '[^a-z0-9]+', '-', 'g'), '-'), 48), ''), 'sans-titre') AS slug,
           trim(regexp_replace(lower(strip_accents(p_type)), '[^a-z0-9]+', '_', 'g'), '_') AS key,
           upper(left(replace(p_brand, '_', ' '), 1)) || lower(substr(replace(p_brand, '_', ' '), 2)) AS shown
    FROM part
""")
def slugify(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "part").select("p_partkey", tx.slug(F.col("p_name")).alias("slug"), tx.slug(F.col("p_type"), "_", None, "").alias("key"), tx.humanise(F.col("p_brand")).alias("shown"))


@query("""
    WITH e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem WHERE l_linestatus = 'F') WHERE rn = 1),
    n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem WHERE l_linestatus = 'O') WHERE rn = 1)
    SELECT l_orderkey, l_partkey, l_linenumber, l_linestatus FROM e WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.l_orderkey = e.l_orderkey AND n.l_partkey = e.l_partkey)
    UNION ALL SELECT l_orderkey, l_partkey, l_linenumber, l_linestatus FROM n
""")
def upsert_runs(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.table(spark, d, "lineitem")
    keyed = lambda run: dedup.last_wins(rows.filter(F.col("l_linestatus") == run), ["l_orderkey", "l_partkey"], ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"])
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_linestatus"]
    return dedup.upsert(keyed("F").select(*columns), keyed("O").select(*columns), ["l_orderkey", "l_partkey"])


@query("SELECT DISTINCT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def literal_extract(spark: SparkSession, d: str) -> DataFrame:
    from gaugeworks.operators import quotes

    return quotes.containing(fx.table(spark, d, "documents"), fx.table(spark, d, "benchmark"))


@query("""
    WITH s AS (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'signup' GROUP BY 1, 2)
    SELECT p.event_id AS purchase_id, p.user_id, (SELECT max_by(s.event_id, s.ts) FROM s WHERE s.user_id = p.user_id AND s.ts < p.ts) AS signup_id
    FROM events p WHERE p.event_type = 'purchase'
""")
def asof_event_section(spark: SparkSession, d: str) -> DataFrame:
    from gaugeworks.operators.asof import asof_before

    e = fx.table(spark, d, "events")
    left = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", "ts")
    right = e.filter("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("signup_id"))
    return asof_before(left, right, "user_id", "ts", "signup_id").select("purchase_id", "user_id", "signup_id")


_SECTIONS = ("PROMO", "STANDARD", "ECONOMY", "SMALL")


def _rule_rows(spark: SparkSession, d: str) -> DataFrame:
    """Parts as proposed concepts: some of them break rules."""
    p = fx.table(spark, d, "part")
    return p.select(
        "p_partkey",
        F.col("p_name").alias("slug"),
        F.split("p_name", " ").alias("triggers"),
        F.when(F.col("p_size") > 5, F.array(F.col("p_brand"))).otherwise(F.expr("cast(array() as array<string>)")).alias("exclusions"),
        F.repeat("p_type", (F.col("p_size") % 7 + 4).cast("int")).alias("definition"),
        F.array(F.when(F.col("p_size") % 2 == 0, "c").otherwise("cobol")).alias("languages"),
        F.col("p_type").alias("target_section"),
    )


@query("""
    WITH r AS (
        SELECT p_partkey, trim(regexp_replace(lower(strip_accents(p_name)), '[^a-z0-9]+', '_', 'g'), '_') AS key, p_name, p_size, repeat(p_type, CAST(p_size % 7 + 4 AS INT)) AS definition,
               p_type IN ('PROMO', 'STANDARD', 'ECONOMY', 'SMALL') AS known FROM part
    ), f AS (
        SELECT p_partkey, CASE WHEN key = '' THEN 0 WHEN p_size <= 5 THEN 4 WHEN length(definition) < 40 THEN 5 WHEN NOT known THEN 7 ELSE 99 END AS stop,
               p_name <> key AS slug_form, len(string_split(p_name, ' ')) > 6 AS many, p_size % 2 <> 0 AS foreign_lang FROM r
    )
    SELECT p_partkey, 1 AS ord, 'slug_form' AS code, 'repair' AS severity FROM f WHERE slug_form AND stop > 1
    UNION ALL SELECT p_partkey, 3, 'many_triggers', 'repair' FROM f WHERE many AND stop > 3
    UNION ALL SELECT p_partkey, 6, 'foreign_language', 'repair' FROM f WHERE foreign_lang AND stop > 6
    UNION ALL SELECT p_partkey, stop, CASE stop WHEN 0 THEN 'slug_unusable' WHEN 4 THEN 'no_exclusion' WHEN 5 THEN 'short_definition' ELSE 'unknown_section' END, 'fatal' FROM f WHERE stop < 99
""")
def rule_findings(spark: SparkSession, d: str) -> DataFrame:
    from gaugeworks.operators import rules

    checked = rules.apply_rules(_rule_rows(spark, d), rules.concept_rules(("c", "ocaml"), _SECTIONS))
    return rules.findings(checked, "p_partkey")


@query("""
    WITH x AS (SELECT p_partkey, p_type || '.' || p_brand AS concept_id, CASE WHEN p_size % 3 = 0 THEN p_brand WHEN p_size % 3 = 1 THEN p_type ELSE p_name END AS raw FROM part),
    c AS (SELECT DISTINCT p_type || '.' || p_brand AS concept_id, p_brand AS slug FROM part), s AS (SELECT slug, max(concept_id) AS slug_id FROM c GROUP BY 1), t AS (SELECT DISTINCT p_type FROM part)
    SELECT x.p_partkey, coalesce(slug_id, p_type) AS see, CASE WHEN slug_id IS NOT NULL THEN 'concept' WHEN p_type IS NOT NULL THEN 'section' END AS see_type,
           CASE WHEN slug_id IS NULL AND p_type IS NULL THEN raw END AS see_raw
    FROM x LEFT JOIN s ON s.slug = raw LEFT JOIN t ON t.p_type = raw
""")
def xref_resolution(spark: SparkSession, d: str) -> DataFrame:
    from gaugeworks.operators import catalogue

    p = fx.table(spark, d, "part")
    raw = F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).when(F.col("p_size") % 3 == 1, F.col("p_type")).otherwise(F.col("p_name"))
    xrefs = p.select(F.col("p_partkey").cast("string").alias("concept_id"), raw.alias("raw"))
    concepts = p.select(F.concat_ws(".", "p_type", "p_brand").alias("concept_id"), F.col("p_brand").alias("slug")).distinct()
    out = catalogue.resolve(xrefs, concepts, p.select(F.col("p_type").alias("section_id")))
    return out.select(F.col("concept_id").cast("long").alias("p_partkey"), "see", "see_type", "see_raw")


@query()
def similarity_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Nations as the gold set, all distinct names of suppliers' nations, parts' names and segments as candidates."""
    from gaugeworks.operators import matching

    gold = fx.table(spark, d, "nation").select(F.concat_ws(".", F.lit("gold"), F.lower("n_name")).alias("id"), F.col("n_name").alias("label"))
    names = fx.table(spark, d, "part").select(F.concat_ws(".", F.lit("part"), F.lower("p_name")).alias("id"), F.col("p_name").alias("label")).distinct()
    return matching.similar_pairs(gold, names.unionByName(gold.select(F.regexp_replace("id", "gold", "nation").alias("id"), "label")), 0.5)


def _records(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.labels(spark, d).join(fx.questions(spark, d).select("question_id", "language"), "question_id")
    return rows.select(F.col("section_id").alias("section"), "concept_id", "language", F.when(F.col("run") == "F", "Algorithmique").otherwise("Théorie").alias("type"), F.lit(1).alias("weight"))


_RECORDS_SQL = "r AS (SELECT section_id AS section, concept_id, language, CASE WHEN run = 'F' THEN 'Algorithmique' ELSE 'Théorie' END AS type, 1 AS weight FROM l JOIN q USING (question_id))"


@query(f"""
    WITH {CORPUS_SQL}, {_RECORDS_SQL}
    SELECT section, type, concept_id, language, CAST(sum(weight) AS BIGINT) AS weight, grouping(section, type, concept_id, language) AS grouped
    FROM r GROUP BY GROUPING SETS ((section, type), (concept_id, language), (section), (concept_id))
""")
def dashboard_totals(spark: SparkSession, d: str) -> DataFrame:
    from gaugeworks.operators import records

    return records.totals(_records(spark, d))


@query(f"""
    WITH {CORPUS_SQL}, {_RECORDS_SQL}, f AS (SELECT * FROM r WHERE type = 'Théorie' AND language IN ('1-URGENT', '5-LOW')), h AS (SELECT concept_id, sum(weight) AS w FROM f GROUP BY 1)
    SELECT section_id AS section, CAST(coalesce(sum(w), 0) AS BIGINT) AS weight, count(w) AS hit, count(*) AS concepts FROM cat LEFT JOIN h USING (concept_id) GROUP BY 1
""")
def dashboard_sections(spark: SparkSession, d: str) -> DataFrame:
    """Section totals under two facets."""
    from gaugeworks.operators import records

    rows = records.facets(_records(spark, d), languages=["1-URGENT", "5-LOW"], types=["Théorie"])
    return records.section_totals(rows, fx.catalogue(spark, d))


@query(f"""
    WITH {CORPUS_SQL}, w AS (SELECT section_id, concept_id, count(*) AS weight FROM l GROUP BY 1, 2),
    x AS (SELECT *, max(weight) OVER (PARTITION BY section_id) AS top, percent_rank() OVER (PARTITION BY section_id ORDER BY weight) AS pr, count(*) OVER (PARTITION BY section_id) AS n FROM w)
    SELECT section_id, concept_id, weight, CAST(least(5, greatest(1, ceil(5 * (weight::DOUBLE / top)))) AS INT) AS linear,
           CAST(least(5, greatest(1, ceil(5 * (ln(1 + weight::DOUBLE) / ln(1 + top::DOUBLE))))) AS INT) AS logarithmic, CAST(least(5, greatest(1, ceil(5 * (CASE WHEN n = 1 THEN 1 ELSE pr END)))) AS INT) AS ranked
    FROM x
""")
def colour_levels(spark: SparkSession, d: str) -> DataFrame:
    from gaugeworks.operators import records

    w = fx.labels(spark, d).groupBy("section_id", "concept_id").agg(F.count(F.lit(1)).alias("weight"))
    return records.levels(w, "weight", "section_id")


@query("""
    WITH x AS (SELECT p_partkey AS id, p_type AS see, CASE p_size % 4 WHEN 0 THEN 'concept' WHEN 1 THEN 'section' WHEN 2 THEN NULL ELSE 'odd' END AS t FROM part WHERE p_size % 5 > 0
               UNION ALL SELECT p_partkey, NULL, NULL FROM part WHERE p_size % 5 = 0),
    c AS (SELECT CASE WHEN see IS NULL THEN 'unresolved' WHEN t IS NULL THEN 'untyped' WHEN t = 'concept' THEN 'dead_concept' WHEN t = 'section' THEN CASE WHEN see IN ('PROMO', 'ECONOMY') THEN 'xref_to_section' ELSE 'dead_section' END ELSE 'unknown_type' END AS code FROM x)
    SELECT code, CASE WHEN code IN ('xref_to_section', 'dead_section') THEN 'expected' ELSE 'fatal' END AS severity, count(*) AS n FROM c GROUP BY 1, 2
""")
def xref_findings(spark: SparkSession, d: str) -> DataFrame:
    from gaugeworks.operators import catalogue

    p = fx.table(spark, d, "part")
    named = F.col("p_size") % 5 > 0
    kind = F.when(F.col("p_size") % 4 == 0, "concept").when(F.col("p_size") % 4 == 1, "section").when(F.col("p_size") % 4 == 3, "odd")
    x = p.select(F.col("p_partkey").cast("string").alias("concept_id"), F.when(named, F.col("p_type")).alias("see"), F.when(named, kind).alias("see_type"), F.when(~named, F.col("p_name")).alias("see_raw"))
    concepts = p.select(F.concat_ws(".", "p_type", "p_brand").alias("concept_id")).distinct()
    sections = p.select(F.col("p_type").alias("section_id")).filter("section_id IN ('PROMO', 'ECONOMY')").distinct()
    return catalogue.check_xrefs(x, concepts, sections).groupBy("code", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("""
    WITH c AS (SELECT p_brand || '.' || p_name AS concept_id, p_brand AS section_id, p_name AS slug FROM part), per AS (SELECT section_id, count(*) AS n FROM c GROUP BY 1)
    SELECT concept_id AS target, 'id_repeated' AS code, 'fatal' AS severity FROM c GROUP BY 1 HAVING count(*) > 1
    UNION ALL SELECT slug, 'slug_repeated', 'expected' FROM c GROUP BY 1 HAVING count(DISTINCT section_id) > 1
    UNION ALL SELECT section_id, 'section_over_ceiling', 'expected' FROM per WHERE n > 80
    UNION ALL SELECT 'catalogue', 'too_many_concepts', 'expected' FROM c HAVING count(*) > 100
""")
def catalogue_findings(spark: SparkSession, d: str) -> DataFrame:
    from gaugeworks.operators import catalogue

    p = fx.table(spark, d, "part")
    c = p.select(F.concat_ws(".", "p_brand", "p_name").alias("concept_id"), F.col("p_brand").alias("section_id"), F.col("p_name").alias("slug"), F.lit("Définir").alias("label"))
    return catalogue.validate(c, c.select("section_id").distinct(), 80, 10, 100)


@query("""
    WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    SELECT user_id, event_type, event_id FROM x WHERE rn = 1
""")
def last_wins(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events")
    return dedup.last_wins(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT left(text, 90) AS message, count(*) AS calls FROM conversations GROUP BY 1")
def failure_groups(spark: SparkSession, d: str) -> DataFrame:
    from gaugeworks.operators import labelling

    return labelling.failures(fx.table(spark, d, "conversations").select(F.col("text").alias("message")))


def _literal_sql() -> str:
    t = "regexp_replace(coalesce(text, ''), '<[^>]{0,40}>|[\\\\*_`#$]|\\{|\\}', '', 'g')"
    for sign, name in tx.SYMBOLS.items():
        t = f"replace({t}, '{sign}', '{name.replace(chr(39), chr(39) * 2)}')"
    return f"SELECT doc_id, sha256(lower(regexp_replace({t}, '\\s+', '', 'g'))) AS form, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS words FROM documents"


@query(_literal_sql())
def literal_forms(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "documents").select("doc_id", F.sha2(tx.literal_form(F.col("text")).cast("binary"), 256).alias("form"), tx.word_count(F.col("text")).cast("long").alias("words"))


@query("""
    WITH a AS (SELECT source, doc_id, regexp_extract(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+', 0) AS m FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+')),
    x AS (SELECT source AS origin, m AS excerpt, row_number() OVER (ORDER BY source, m) AS rank FROM a)
    SELECT 'mail' AS probe, rank, origin, excerpt FROM x WHERE rank <= 12
""")
def probe_report(spark: SparkSession, d: str) -> DataFrame:
    """The head of a report: excerpts without context, twelve at most."""
    found = probes.attest(fx.table(spark, d, "documents"), PROBES[2:3], "source", around=0)
    return probes.report(found).withColumn("rank", F.col("rank").cast("long"))


import gaugeworks.plans.planted  # noqa: E402, F401  (registers its queries)
