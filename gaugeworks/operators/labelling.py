"""Labelling: prompts, sections kept, memo, replayed answers, validation of labels.

The model itself is a provider given by the user: a callable from a prompt to an answer. It is only called for keys that the memo lacks.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Mapping, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.offsets import let
from gaugeworks.functions.text import fingerprint, literal_form, nothing_as_null, word_count

LEAST_WORDS = 5
LEAST_SECTIONS, MOST_SECTIONS = 2, 4
EXERCISE_CHARS, SOLUTION_CHARS, PREFILTER_CHARS = 6000, 5000, 12000
SLICE = 15
QUOTES_AT_ONCE = 256


class Provider(Protocol):
    def answer(self, system: str, message: str, schema: Mapping) -> Mapping: ...


def message(title: Column, preamble: Column, questions: Column) -> Column:
    """The text that a call sends: the exercise's preamble and questions (array<struct<id, text, solution>>), each cut."""
    one = lambda q: F.concat(F.lit("["), q["id"], F.lit("]\n"), F.left(q["text"], F.lit(EXERCISE_CHARS)), F.when(q["solution"].isNotNull(), F.concat(F.lit("\nSolution: "), F.left(q["solution"], F.lit(SOLUTION_CHARS)))).otherwise(""))
    return F.concat_ws("\n\n", title, F.left(preamble, F.lit(EXERCISE_CHARS)), F.array_join(F.transform(questions, one), "\n\n"))


def answer_schema(concept_ids: Sequence[str], statuses: Sequence[str]) -> dict:
    """JSON schema of an answer; ids are an enumeration of what is allowed."""
    label = {"type": "object", "properties": {"concept_id": {"enum": list(concept_ids)}, "quote": {"type": "string"}}, "required": ["concept_id", "quote"]}
    question = {"type": "object", "properties": {"question_id": {"type": "string"}, "status": {"enum": list(statuses)}, "labels": {"type": "array", "items": label}}, "required": ["question_id", "status", "labels"]}
    return {"type": "object", "properties": {"questions": {"type": "array", "items": question}}, "required": ["questions"]}


def sections_schema(section_ids: Sequence[str]) -> dict:
    """JSON schema of a first-phase answer: at most MOST_SECTIONS of the sections there are."""
    return {"type": "object", "properties": {"sections": {"type": "array", "items": {"enum": list(section_ids)}, "minItems": LEAST_SECTIONS, "maxItems": MOST_SECTIONS}}, "required": ["sections"]}


def decision_schema(unit_ids: Sequence[str], sections: Sequence[str], languages: Sequence[str], verdicts: Sequence[str] = ("admis", "admis_reformule", "eclate", "refuse")) -> dict:
    """JSON schema of the decisions on a section's units."""
    words = {"type": "array", "items": {"type": "string"}}
    concept = {"slug": {"type": "string"}, "label": {"type": "string"}, "definition": {"type": "string"}, "triggers": words, "exclusions": {"type": "array", "items": {"type": "object"}}, "languages": {"type": "array", "items": {"enum": list(languages)}}, "target_section": {"enum": list(sections)}}
    decision = {"unit_id": {"enum": list(unit_ids)}, "verdict": {"enum": list(verdicts)}, "reason": {"type": "string"}, "concepts": {"type": "array", "items": {"type": "object", "properties": concept, "required": list(concept)}}}
    return {"type": "object", "properties": {"decisions": {"type": "array", "items": {"type": "object", "properties": decision, "required": list(decision)}}}, "required": ["decisions"]}


def candidates(kept: DataFrame, catalogue: DataFrame) -> DataFrame:
    """exercise_id and the concept ids that a call may name: those of its sections in their order, within one in the catalogue's order. Exercises without any are left out.

    kept: exercise_id, sections array; catalogue: concept_id, section_id, ord.
    """
    x = kept.select("exercise_id", F.posexplode("sections").alias("place", "section_id")).join(catalogue.select("section_id", "ord", "concept_id"), "section_id")
    all_ = F.array_sort(F.collect_list(F.struct("place", "ord", "concept_id")))
    return x.groupBy("exercise_id").agg(F.transform(all_, lambda c: c["concept_id"]).alias("candidates"))


def kept_sections(proposed: Column, profile: Sequence[str]) -> Column:
    """Valid sections, distinct, in order; under two are filled up in the profile's order, over four are all kept (and can be logged)."""
    order = F.array(*[F.lit(s) for s in profile])
    valid = F.array_distinct(F.filter(proposed, lambda s: F.array_contains(order, s)))
    return F.when(F.size(valid) < LEAST_SECTIONS, F.slice(F.array_distinct(F.concat(valid, order)), 1, LEAST_SECTIONS)).otherwise(valid)


def signature(protocol: Mapping) -> str:
    """16 digits that name a run's protocol: equal exactly for equal protocols."""
    import hashlib

    text = json.dumps(protocol, sort_keys=True, ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def check_protocol(expected: Mapping, effective: Mapping) -> None:
    """Expected values that are not null must be the effective ones."""
    wrong = {k: (v, effective.get(k)) for k, v in expected.items() if v is not None and effective.get(k) != v}
    if wrong:
        raise ValueError(f"the configuration is not the protocol's: {wrong}")


def call_key(run: str, phase: str, exercise_id: Column, text: Column, sections: Column | None = None) -> Column:
    parts = [F.lit(run), F.lit(phase), exercise_id, *([F.array_join(sections, ",")] if sections is not None else []), text]
    return fingerprint(*parts)


def to_call(calls: DataFrame, memo: DataFrame) -> DataFrame:
    """Calls whose key the memo lacks."""
    return calls.join(memo.select("key"), "key", "left_anti")


def latest(memo: DataFrame) -> DataFrame:
    """Of repeated keys the last line counts. memo: key, ord, payload."""
    nth = F.row_number().over(W.partitionBy("key").orderBy(F.col("ord").desc()))
    return memo.withColumn("__n", nth).filter("__n = 1").drop("__n")


def purge(memo: DataFrame, label: str | None = None) -> DataFrame:
    """The memo without calls whose label begins so; without any where none is given."""
    return memo.filter(F.lit(False)) if label is None else memo.filter(F.coalesce(~F.startswith("label", F.lit(label)), F.lit(True)))


def answered(calls: DataFrame, memo: DataFrame) -> DataFrame:
    """Calls with their answers, joined by key; a missing answer stays null and is reported, never asked again here."""
    return calls.join(latest(memo).select("key", "payload"), "key", "left")


def ask(calls: DataFrame, provider: Provider, system: str, schema: Mapping, slices: int = SLICE, size: int = SLICE) -> DataFrame:
    """Answers for calls (key, message): key, payload (JSON), error. `slices` partitions bound the number of calls at a time.

    A provider that takes batches (answers(system, messages, schema)) gets at most `size` messages at once, others one by one. A call that
    fails gives a row with the error's message and no payload, so that the answers beside it are kept.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        together = getattr(provider, "answers", None)
        step = size if together else 1
        for x in batches:
            for k in range(0, len(x), step):
                part = x.iloc[k : k + step]
                messages = list(part["message"])
                try:
                    got = together(system, messages, schema) if together else [provider.answer(system, messages[0], schema)]
                    payload, error = [json.dumps(a, ensure_ascii=False) for a in got], None
                    if len(payload) != len(part):
                        raise ValueError(f"{len(payload)} answers to {len(part)} messages")
                except Exception as e:  # whatever a provider raises is its calls' failure
                    payload, error = [None] * len(part), f"{type(e).__name__}: {e}"
                yield pd.DataFrame({"key": list(part["key"]), "payload": pd.Series(payload, dtype=object), "error": pd.Series([error] * len(part), dtype=object)})

    return calls.select("key", "message").repartition(slices).mapInPandas(run, "key string, payload string, error string")


def resume(calls: DataFrame, provider: Provider, system: str, schema: Mapping, path: str, label: str = "", at_once: int = SLICE, size: int = SLICE) -> DataFrame:
    """Asks what the memo at `path` lacks and returns all calls with their answers and errors.

    The calls go in slices of at_once * size at most, in the order of their keys' hashes, each one job: a slice's answers are lines of the
    memo before the next slice is asked, so what ends the job loses the answers of one slice at most, and a new run asks only the
    rest. A call that fails costs only its own answer, or its batch's; its error is in the column `error`. Each line has a sequence number: time, then slice.
    """
    from gaugeworks.sources.shared import settle

    spark = calls.sparkSession
    memo = _memo_at(spark, path)
    todo = to_call(calls.select("key", "message").dropDuplicates(["key"]), memo)
    many = getattr(provider, "answers", None) is not None
    width = at_once * (size if many else 1)
    n = max(1, -(-todo.count() // width))
    todo = settle(todo.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")))
    failed = None
    for k in range(n):
        got = settle(ask(todo.filter(F.col("slice") == k), provider, system, schema, at_once, size))
        seq = F.lit(time.time_ns())
        good = got.filter("payload IS NOT NULL").select("key", F.lit(label).alias("label"), "payload", F.lit(None).cast("string").alias("meta"), seq.alias("seq"))
        good.write.mode("append").json(path)
        bad = got.filter("payload IS NULL").select("key", "error")
        failed = bad if failed is None else failed.unionByName(bad)
    return answered(calls, _memo_at(spark, path)).join(failed, "key", "left")


def _memo_at(spark: SparkSession, path: str) -> DataFrame:
    """The memo, or an empty one where nothing stands yet."""
    from pyspark.errors import AnalysisException

    from gaugeworks.sources import readers

    try:
        return readers.memo(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "key string, label string, payload string, meta string, ord long")


def failures(errors: DataFrame) -> DataFrame:
    """Errors by the first 90 characters of their message."""
    return errors.groupBy(F.substring("message", 1, 90).alias("message")).agg(F.count(F.lit(1)).alias("calls"))


def validate_labels(labels: DataFrame, questions: DataFrame, sections: DataFrame, least_words: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Labels that hold, and rejected ones with their reason.

    The first reason counts: the concept is not among the exercise's kept sections; its quote has too few words; the quote is not literally in the question's
    text; the concept is already kept for the question. labels: question_id, ord, concept_id, quote; questions: question_id, exercise_id, text;
    sections: exercise_id, section_id. Labels of unknown questions are ignored.

    `ord` is a label's number in its question. A question's quotes go to its text in rows of at most QUOTES_AT_ONCE of them; there the text's form is made once and all quotes are looked for in it.
    What comes back has no text. Only the forms of quotes that the earlier reasons left are made.
    """
    q = questions.select("question_id", "exercise_id", "text")
    known = labels.join(q.select("question_id", "exercise_id"), "question_id").withColumn("section_id", F.substring_index("concept_id", ".", 1))
    x = known.join(sections.select("exercise_id", "section_id", F.lit(True).alias("chosen")).distinct(), ["exercise_id", "section_id"], "left")
    early = F.when(F.col("chosen").isNull(), "not_selected").when(word_count(F.coalesce("quote", F.lit(""))) < least_words, "too_short")
    x = x.select("question_id", "ord", "concept_id", "quote", early.alias("reason"))
    asked = F.struct("ord", "concept_id", "quote", "reason", F.when(F.col("reason").isNull(), literal_form(F.col("quote"))).alias("form"))
    rows = x.withColumn("asked", asked).groupBy("question_id", F.floor(F.col("ord") / QUOTES_AT_ONCE).alias("part")).agg(F.collect_list("asked").alias("asked"))
    texts = q.select("question_id", "text").join(rows, "question_id")
    here = let(
        F.struct(F.when(F.exists("asked", lambda a: a["form"].isNotNull()), literal_form(F.col("text"))).alias("text"), F.col("asked").alias("asked")),
        lambda z: F.transform(z["asked"], lambda a: F.struct(a["ord"].alias("ord"), a["concept_id"].alias("concept_id"), a["quote"].alias("quote"), F.when(a["form"].isNotNull() & ~F.contains(z["text"], a["form"]), "not_literal").otherwise(a["reason"]).alias("reason"))),
    )
    x = texts.select("question_id", F.inline(here))
    nth = F.row_number().over(W.partitionBy("question_id", "concept_id", F.col("reason").isNull()).orderBy("ord"))
    x = x.withColumn("reason", F.when(F.col("reason").isNull() & (nth > 1), "repeated").otherwise(F.col("reason")))
    columns = ["question_id", "ord", "concept_id", "quote"]
    return x.filter("reason IS NULL").select(*columns), x.filter("reason IS NOT NULL").select(*columns, "reason")


def question_status(questions: DataFrame, answers: DataFrame, kept: DataFrame) -> DataFrame:
    """Each question's status: that of its first answer, but `indecidable` where it said ok and no label held, or nothing was answered. answers: question_id, ord, status, reason, object, language."""
    first = answers.withColumn("__n", F.row_number().over(W.partitionBy("question_id").orderBy("ord"))).filter("__n = 1")
    n = kept.groupBy("question_id").agg(F.count(F.lit(1)).alias("labels"))
    x = questions.select("question_id").join(first, "question_id", "left").join(n, "question_id", "left")
    status = F.when(F.col("status").isNull() | ((F.col("status") == "ok") & F.col("labels").isNull()), "indecidable").otherwise(F.col("status"))
    return x.select("question_id", status.alias("status"), nothing_as_null(F.col("reason")).alias("reason"), nothing_as_null(F.col("object")).alias("object"), nothing_as_null(F.col("language")).alias("language"), F.coalesce("labels", F.lit(0)).alias("labels"))


def tokens(answers: DataFrame) -> DataFrame:
    """Tokens by exercise from maps of counters."""
    each = answers.select("exercise_id", F.explode("tokens").alias("counter", "n"))
    return each.groupBy("exercise_id").agg(F.sum("n").alias("tokens"))


def locality_order(calls: DataFrame, partitions: int) -> DataFrame:
    """Calls with the same sections side by side, so that a provider's prefix cache serves them; `ord` restores the corpus order later."""
    return calls.repartition(partitions, "sections").sortWithinPartitions("sections", "ord")


def excluded_objects(mentions: DataFrame, most: int = 40) -> DataFrame:
    """Objects that a prompt names as excluded: the first `most` mentions of that scope that name one."""
    return mentions.filter("scope = 'objet_exclu' AND length(object) > 0").orderBy("id").limit(most).select("id", "object")


def two_phases(exercises: DataFrame, memo: DataFrame, run: str, profile: Sequence[str], message_column: str = "message") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls of the first phase (which sections), of the second (labels within those), and exercises still without an answer to the first.

    exercises: exercise_id, message. First answers are JSON {"sections": [...]} in the memo. Nothing is called here: what the memo lacks is listed.
    """
    first = exercises.withColumn("message", F.left(message_column, F.lit(PREFILTER_CHARS))).withColumn("key", call_key(run, "sections", F.col("exercise_id"), F.left(F.col(message_column), F.lit(PREFILTER_CHARS))))
    got = answered(first, memo)
    proposed = F.coalesce(F.from_json("payload", "sections array<string>")["sections"], F.expr("cast(array() as array<string>)"))
    second = got.filter("payload IS NOT NULL").select("exercise_id", "message", kept_sections(proposed, profile).alias("sections"))
    second = second.withColumn("key", call_key(run, "labels", F.col("exercise_id"), F.col("message"), F.col("sections")))
    return to_call(first, memo), to_call(second, memo), got.filter("payload IS NULL").select("exercise_id")
