"""Evaluation of answers, run history and gates, routing of questions, data-quality checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio, sentence_count
from .documents import words_of
from .skew import salted_join

# Pass marks of an answer and the sentence limit of the style rule.
PASS_MARK = 0.6
MAX_SENTENCES = 4


def route_domains(questions: DataFrame, keywords: Mapping[str, Sequence[str]], text: str = "question",
                  key: str = "question_id") -> DataFrame:
    """One row per question and domain whose keywords it uses; a question that uses none goes to all."""
    words = F.col("_words")

    def score(terms: Sequence[str]) -> Column:
        return F.size(F.array_intersect(words, F.array(*[F.lit(t) for t in terms]))).cast("bigint")

    scored = F.array(*[F.struct(F.lit(d).alias("domain"), score(t).alias("score")) for d, t in keywords.items()])
    hit = F.filter("_scored", lambda s: s["score"] > 0)
    rows = questions.select(key, words_of(text).alias("_words")).withColumn("_scored", scored)
    return rows.select(key, F.inline(F.when(F.size(hit) > 0, hit).otherwise(F.col("_scored"))))


def _counted(_: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows_returned"))


def leg_trace(legs: Mapping[str, tuple[str, Callable[[], DataFrame]]], measure: Callable[[str, DataFrame], DataFrame] = _counted) -> DataFrame:
    """Rows returned by each leg of a routed question, with the query text and, if it cannot be planned, the error.

    ``measure`` gives one row with ``rows_returned`` for a domain and its answer; it can take sizes that are known already.
    """
    out = None
    for domain, (query, build) in legs.items():
        head = F.lit(domain).alias("domain"), F.lit(query).alias("query")
        try:
            one = measure(domain, build()).select(*head, "rows_returned", F.lit(None).cast("string").alias("error"))
        except AnalysisException as e:
            one = SparkSession.active().range(1).select(
                *head, F.lit(None).cast("bigint").alias("rows_returned"), F.lit(e.getCondition()).alias("error"))
        out = one if out is None else out.unionByName(one)
    return out


def _numbers(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"([0-9]+(?:\.[0-9]+)?)"), 1)


def eval_facts(answers: DataFrame, facts: DataFrame, key: str = "question_id", mark: float = PASS_MARK) -> DataFrame:
    """Score each answer without a model.

    Correctness is the share of expected facts the answer contains. Groundedness is the share of
    numbers in the answer that the evidence contains, 1 when it has no number. A missing answer or a
    question without expected facts scores 0 and fails.
    """
    said = F.coalesce(F.contains(F.lower("answer"), F.lower("fact")), F.lit(False))
    # The scores are grouped by the join key itself, so a question with very many facts is split here.
    found = salted_join(facts, answers.select(key, "answer"), (key,)).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_facts"), F.count_if(said).alias("n_found")
    )
    numbers = F.col("_numbers")
    known = F.size(F.filter(numbers, lambda n: F.array_contains(F.col("_known"), n)))
    grounded = F.when(F.col("answer").isNull(), 0.0).when(F.size(numbers) == 0, 1.0).otherwise(ratio(known, F.size(numbers)))
    rows = answers.join(found, key, "left").withColumn("_numbers", _numbers("answer")).withColumn("_known", _numbers("evidence"))
    scored = rows.withColumn("correctness", F.coalesce(F.round(ratio(F.col("n_found"), F.col("n_facts")), 4), F.lit(0.0))).withColumn(
        "groundedness", F.round(grounded, 4)
    )
    passed = (F.col("correctness") >= mark) & (F.col("groundedness") >= mark)
    return scored.withColumn("passed", passed).drop("_numbers", "_known", "n_facts", "n_found", "evidence")


def eval_guideline(answers: DataFrame, text: str = "answer", limit: int = MAX_SENTENCES) -> DataFrame:
    """Style rule: an answer has at most four sentences."""
    return answers.withColumn("sentences", sentence_count(text)).withColumn("concise", F.col("sentences") <= limit)


def eval_run_summary(results: DataFrame, run: Sequence[str]) -> DataFrame:
    """One header row per run. Scores have four decimals, so their mean is exact in DECIMAL in any row order."""

    def mean(score: str) -> Column:
        exact = F.try_divide(F.sum(F.col(score).cast("decimal(6,4)")), F.count(score).cast("decimal(18,0)"))
        return F.round(exact, 4).cast("double")

    return results.groupBy(*run).agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.count_if("passed").alias("n_pass"),
        F.round(ratio(F.count_if("passed"), F.count(F.lit(1))), 4).alias("pass_rate"),
        mean("correctness").alias("avg_correctness"),
        mean("groundedness").alias("avg_groundedness"),
    )


def win_run_delta(runs: DataFrame, tag: str = "run_tag", created: str = "created_at") -> DataFrame:
    """Pass rate of each run against the run before it of the same tag. One row per run, so groups are short."""
    before = F.lag("pass_rate").over(Window.partitionBy(tag).orderBy(created))
    return runs.withColumn("previous_rate", before).withColumn("rate_change", F.round(F.col("pass_rate") - before, 4))


def eval_gate(runs: DataFrame, tolerance: float = 0.0, tag: str = "run_tag", created: str = "created_at") -> DataFrame:
    """Block a run whose pass rate fell by more than the tolerance; the first run of a tag has no gate."""
    moved = win_run_delta(runs, tag, created)
    return moved.withColumn("gate", F.when(F.coalesce(F.col("rate_change") < -tolerance, F.lit(False)), "blocked").otherwise("open"))


def dq_rules(checks: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """Rows checked and violations per rule; a rule that evaluates to NULL is a violation."""
    out = None
    for rule, df, holds in checks:
        one = df.agg(
            F.count(F.lit(1)).alias("checked"), F.count_if(~F.coalesce(holds, F.lit(False))).alias("violations")
        ).select(F.lit(rule).alias("rule"), "checked", "violations")
        out = one if out is None else out.unionByName(one)
    return out


def dq_narrative(isolated: DataFrame, min_focus: float, max_other: float) -> DataFrame:
    """Whether the one segment moved at least so far while all others stayed within their limit."""
    moved = F.coalesce(F.abs("focus_delta_pp") >= min_focus, F.lit(False))
    flat = F.coalesce(F.col("max_other_abs_pp") <= max_other, F.lit(True))
    return isolated.withColumn("focus_moved", moved).withColumn("others_flat", flat).withColumn("signal_holds", moved & flat)


def schema_lint(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Missing or empty values of every required field, counted in one pass."""
    counts = [
        F.struct(F.lit(c).alias("field"), F.count(F.lit(1)).alias("checked"),
                 F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias("missing"))
        for c in required
    ]
    return df.agg(F.array(*counts).alias("_c")).select(F.inline("_c"))
