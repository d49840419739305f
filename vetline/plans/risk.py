"""Risk signals per vacancy, their long form, and the case queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.operators.referred import Referred, join_referred

# Fixed values of the signal contract.
RISK_CATEGORIES = ("crypto", "gambling", "payments", "grey_schemes", "scam")
MIN_TEXT_LENGTH = 300
SALARY_FROM_LIMIT = 500000
SALARY_TO_LIMIT = 700000

# name, type, severity, blocking, downstream action
SIGNALS = (
    ("missing_employer_info", "employer_based", "critical", False, "manual_review"),
    ("vague_job_description", "content_based", "warning", False, "analytics"),
    ("risk_domain_profile", "content_based", "warning", False, "analytics"),
    ("high_salary_outlier", "content_based", "warning", False, "analytics"),
    ("sanctions_match_employer", "employer_based", "critical", True, "alert"),
)


def _flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def _signal(name: str) -> Column:
    return F.col(f"risk_signal_{name}")


def join_text(vacancies: DataFrame, text: DataFrame | Referred) -> DataFrame:
    """Text of the same vacancy and the same load date; a text of another day does not count.

    Its length is taken before the join, so that where the text itself is not asked for it stays behind. Each task
    holds its vacancies in a hash table and lets the texts run past: sorting would write every text once more.
    Vacancies go to texts that they refer to, so that a text of many vacancies is shuffled once.
    """
    if isinstance(text, Referred):
        bodies = text.bodies.select(text.ref, "description_text", F.length("description_text").alias("text_length"))
        return join_referred(vacancies, Referred(text.rows.select("vacancy_id", "load_dt", text.ref), bodies, text.ref), ["vacancy_id", "load_dt"])
    described = text.select("vacancy_id", "load_dt", "description_text", F.length("description_text").alias("text_length"))
    return vacancies.hint("shuffle_hash").join(described, ["vacancy_id", "load_dt"], "left")


def join_employer(vacancies: DataFrame, employers: DataFrame) -> DataFrame:
    names = employers.select("employer_id", F.col("name").alias("employer_name"))
    return vacancies.join(names, "employer_id", "left")


def risk_signals(
    vacancies: DataFrame, text: DataFrame | Referred, employers: DataFrame, sanctioned: DataFrame | None = None
) -> DataFrame:
    """One row per vacancy with five signals, their counts, a level and an action.

    ``sanctioned`` may name employer ids found by screening; without it that signal is 0.
    """
    named = join_employer(vacancies, employers)
    hit = F.lit(0)
    if sanctioned is not None:
        hits = sanctioned.select("employer_id").distinct().withColumn("_hit", F.lit(1))
        named = named.join(hits, "employer_id", "left")
        hit = F.coalesce(F.col("_hit"), F.lit(0))
    # last, so that the texts are shuffled once, by their vacancy, and not again by employer
    joined = join_text(named, text)
    name, length = F.col("employer_name"), F.col("text_length")
    base = joined.select(
        "vacancy_id",
        "load_dt",
        "employer_id",
        "employer_name",
        "area_name",
        "title",
        "published_at",
        (~F.col("archived")).alias("is_active"),
        "salary_from",
        "salary_to",
        "expected_risk_category",
        "description_text",
        _flag(F.col("employer_id").isNull() | name.isNull() | (name == "")).alias("risk_signal_missing_employer_info"),
        _flag(length.isNull() | (length < MIN_TEXT_LENGTH)).alias(
            "risk_signal_vague_job_description"
        ),
        _flag(F.col("expected_risk_category").isin(*RISK_CATEGORIES)).alias("risk_signal_risk_domain_profile"),
        _flag((F.col("salary_from") >= SALARY_FROM_LIMIT) | (F.col("salary_to") >= SALARY_TO_LIMIT)).alias(
            "risk_signal_high_salary_outlier"
        ),
        hit.alias("risk_signal_sanctions_match_employer"),
    )
    by_severity = {
        severity: [_signal(n) for n, _, s, _, _ in SIGNALS if s == severity] for severity in ("warning", "critical")
    }
    warnings = sum(by_severity["warning"][1:], by_severity["warning"][0])
    criticals = sum(by_severity["critical"][1:], by_severity["critical"][0])
    counted = base.withColumns({"risk_warning_count": warnings, "risk_critical_count": criticals})
    return counted.withColumns(
        {
            "risk_level": F.when(F.col("risk_critical_count") > 0, "CRITICAL")
            .when(F.col("risk_warning_count") > 0, "WARNING")
            .otherwise("OK"),
            "downstream_action": F.when(_signal("sanctions_match_employer") == 1, "alert")
            .when(_signal("missing_employer_info") == 1, "manual_review")
            .when(F.col("risk_warning_count") > 0, "analytics")
            .otherwise("monitor"),
        }
    )


def risk_signals_long(wide: DataFrame) -> DataFrame:
    """The contract form: one row per vacancy, load date and signal."""
    domain = F.when(
        F.col("expected_risk_category").isin("crypto", "gambling", "payments"), F.col("expected_risk_category")
    ).otherwise("baseline")
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("risk_signal_name"),
                F.lit(kind).alias("risk_signal_type"),
                F.lit(severity).alias("severity"),
                F.lit(blocking).alias("blocking"),
                (_signal(name) == 1).alias("signal_value"),
                F.when(_signal(name) == 1, action).otherwise("monitor").alias("downstream_action"),
            )
            for name, kind, severity, blocking, action in SIGNALS
        ]
    )
    return (
        wide.select("vacancy_id", "load_dt", domain.alias("risk_domain"), F.explode(entries).alias("s"))
        .select("vacancy_id", "load_dt", "risk_domain", "s.*")
        .withColumn("false_positive_note", F.lit(None).cast("string"))
    )


# Our own rules: signal -> what the analyst should look at. The first fired one names the case.
CASES = (
    ("sanctions_match_employer", "POTENTIAL_SANCTIONS", "compare employer with the sanctions entry"),
    ("missing_employer_info", "ANONYMOUS_EMPLOYER", "identify the employer"),
    ("high_salary_outlier", "UNUSUAL_COMPENSATION", "check the salary against the market"),
    ("risk_domain_profile", "RISK_DOMAIN", "check the business for a licence"),
    ("vague_job_description", "VAGUE_DESCRIPTION", "request a full job description"),
)


def case_queue(wide: DataFrame) -> DataFrame:
    """One case per vacancy with a fired signal.

    A sanctions hit is escalated, another critical signal or two warnings get priority, the rest a light review.
    """

    def fired(position: int) -> Column:
        return F.array_compact(F.array(*[F.when(_signal(case[0]) == 1, case[position]) for case in CASES]))

    action = (
        F.when(_signal("sanctions_match_employer") == 1, "BLOCK_ESCALATE")
        .when((F.col("risk_critical_count") > 0) | (F.col("risk_warning_count") >= 2), "REVIEW_PRIORITY")
        .otherwise("REVIEW_LIGHT")
    )
    return wide.filter(F.col("risk_critical_count") + F.col("risk_warning_count") > 0).select(
        "vacancy_id",
        "load_dt",
        F.element_at(fired(1), 1).alias("risk_case_type"),
        action.alias("action_type"),
        F.concat_ws(",", fired(0)).alias("fired_signals"),
        F.concat_ws(
            "; ",
            F.concat(F.lit("level="), F.col("risk_level")),
            F.concat(F.lit("employer="), F.coalesce(F.nullif("employer_name", F.lit("")), F.lit("unknown"))),
            F.concat(F.lit("category="), F.coalesce("expected_risk_category", F.lit("none"))),
        ).alias("evidence_summary"),
        F.concat_ws("; ", fired(2)).alias("what_to_check"),
    )
