"""Risk signals, case queue, profiles and sanctions screening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.catalog.records import EMPLOYERS, FLAT_VACANCY, SILVER_TEXT
from vetline.catalog.registry import Data, query
from vetline.catalog.scalars import ASCII, GRAMS, NORMAL
from vetline.functions import status
from vetline.plans import risk, sanctions, screening
from vetline.plans import vacancies as vac
from vetline.plans.profiles import Profile, enabled_profiles, tag_profiles

# --- risk signals ------------------------------------------------------------------------------

# Names of signals, levels and actions, thresholds and output columns, in this SQL and the queries below.
RISK = f"""
SELECT *, high + vague + domain AS risk_warning_count, missing + 0 AS risk_critical_count,
       CASE WHEN missing = 1 THEN 'CRITICAL' WHEN high + vague + domain > 0 THEN 'WARNING' ELSE 'OK' END AS risk_level,
       CASE WHEN missing = 1 THEN 'manual_review' WHEN high + vague + domain > 0 THEN 'analytics' ELSE 'monitor' END
         AS downstream_action
FROM (SELECT v.vacancy_id, v.load_dt, v.employer_id, e.name AS employer_name, v.area_name, v.title, v.published_at,
             NOT v.archived AS is_active, v.salary_from, v.salary_to, v.expected_risk_category, t.description_text,
             CASE WHEN v.employer_id IS NULL OR e.name IS NULL OR e.name = '' THEN 1 ELSE 0 END AS missing,
             CASE WHEN t.description_text IS NULL OR length(t.description_text) < 300 THEN 1 ELSE 0 END AS vague,
             CASE WHEN v.expected_risk_category IN ('crypto', 'gambling', 'payments', 'grey_schemes', 'scam')
                  THEN 1 ELSE 0 END AS domain,
             CASE WHEN v.salary_from >= 500000 OR v.salary_to >= 700000 THEN 1 ELSE 0 END AS high
      FROM ({FLAT_VACANCY}) v
      LEFT JOIN ({SILVER_TEXT}) t ON v.vacancy_id = t.vacancy_id AND v.load_dt = t.load_dt
      LEFT JOIN ({EMPLOYERS}) e ON v.employer_id = e.employer_id)
"""
RISK_NAMED = f"""
SELECT vacancy_id, load_dt, employer_id, employer_name, area_name, title, published_at, is_active, salary_from, salary_to,
       expected_risk_category, description_text, missing AS risk_signal_missing_employer_info,
       vague AS risk_signal_vague_job_description, domain AS risk_signal_risk_domain_profile,
       high AS risk_signal_high_salary_outlier, 0 AS risk_signal_sanctions_match_employer,
       risk_warning_count, risk_critical_count, risk_level, downstream_action
FROM ({RISK})
"""


def _signals(t: Data) -> DataFrame:
    return risk.risk_signals(
        vac.flatten_vacancies(t["vacancy_bronze"]),
        vac.silver_text(t.referred_text()),
        vac.employers_batch(t["list_bronze"]),
    )


@query("risk_signals", RISK_NAMED)
def risk_signals(t: Data) -> DataFrame:
    return _signals(t)


@query(
    "risk_signals_long",
    f"""WITH r AS ({RISK}), s AS (
          SELECT *, 'missing_employer_info' AS name, 'employer_based' AS kind, 'critical' AS severity, false AS blocking,
                 missing AS v, 'manual_review' AS act FROM r
          UNION ALL SELECT *, 'vague_job_description', 'content_based', 'warning', false, vague, 'analytics' FROM r
          UNION ALL SELECT *, 'risk_domain_profile', 'content_based', 'warning', false, domain, 'analytics' FROM r
          UNION ALL SELECT *, 'high_salary_outlier', 'content_based', 'warning', false, high, 'analytics' FROM r
          UNION ALL SELECT *, 'sanctions_match_employer', 'employer_based', 'critical', true, 0, 'alert' FROM r)
        SELECT vacancy_id, load_dt, name AS risk_signal_name, kind AS risk_signal_type, severity, blocking,
               v = 1 AS signal_value,
               CASE WHEN expected_risk_category IN ('crypto', 'gambling', 'payments') THEN expected_risk_category
                    ELSE 'baseline' END AS risk_domain,
               CASE WHEN v = 1 THEN act ELSE 'monitor' END AS downstream_action,
               cast(NULL AS varchar) AS false_positive_note
        FROM s""",
)
def risk_signals_long(t: Data) -> DataFrame:
    return risk.risk_signals_long(_signals(t))


@query(
    "case_queue",
    f"""SELECT vacancy_id, load_dt,
               CASE WHEN missing = 1 THEN 'ANONYMOUS_EMPLOYER' WHEN high = 1 THEN 'UNUSUAL_COMPENSATION'
                    WHEN domain = 1 THEN 'RISK_DOMAIN' ELSE 'VAGUE_DESCRIPTION' END AS risk_case_type,
               CASE WHEN missing = 1 OR high + vague + domain >= 2 THEN 'REVIEW_PRIORITY' ELSE 'REVIEW_LIGHT' END
                 AS action_type,
               concat_ws(',', CASE WHEN missing = 1 THEN 'missing_employer_info' END,
                         CASE WHEN high = 1 THEN 'high_salary_outlier' END,
                         CASE WHEN domain = 1 THEN 'risk_domain_profile' END,
                         CASE WHEN vague = 1 THEN 'vague_job_description' END) AS fired_signals,
               'level=' || risk_level || '; employer=' || coalesce(nullif(employer_name, ''), 'unknown')
                 || '; category=' || coalesce(expected_risk_category, 'none') AS evidence_summary,
               concat_ws('; ', CASE WHEN missing = 1 THEN 'identify the employer' END,
                         CASE WHEN high = 1 THEN 'check the salary against the market' END,
                         CASE WHEN domain = 1 THEN 'check the business for a licence' END,
                         CASE WHEN vague = 1 THEN 'request a full job description' END) AS what_to_check
        FROM ({RISK}) WHERE missing + high + domain + vague > 0""",
)
def case_queue(t: Data) -> DataFrame:
    return risk.case_queue(_signals(t))


# --- search profiles ---------------------------------------------------------------------------


@query(
    "scan_profiles",
    "SELECT profile_id, text, why, expected_risk_category, enabled FROM {profile_rows} WHERE enabled",
)
def scan_profiles(t: Data) -> DataFrame:
    return enabled_profiles(t["profile_rows"])


TEXT_PROFILES = (
    Profile("P1_articles", (("the", "les", "der"), ("and", "und", "et")), "articles"),
    Profile("P2_endings", (("oron", "enst*", "ou*"), ("la", "with")), "endings"),
    Profile("P3_phrase", (("of the", "de la"),), "phrases"),
    Profile("P4_off", (("the",),), "off", enabled=False),
)
EDGE = r"(^|[^\p{{{{L}}}}\p{{{{N}}}}])({0})([^\p{{{{L}}}}\p{{{{N}}}}]|$)"
ENDING = r"[\p{{{{L}}}}\p{{{{N}}}}]*"


def _has(*terms: str) -> str:
    pattern = EDGE.format("|".join(terms))
    return f"regexp_matches(lower(text), '{pattern}')"


@query(
    "profile_tagging",
    f"""SELECT doc_id, 'P1_articles' AS search_profile, 'articles' AS expected_risk_category FROM {{documents}}
        WHERE {_has('the', 'les', 'der')} AND {_has('and', 'und', 'et')}
        UNION ALL SELECT doc_id, 'P2_endings', 'endings' FROM {{documents}}
        WHERE {_has('oron', 'enst' + ENDING.format(), 'ou' + ENDING.format()).replace('{{{{', '{{').replace('}}}}', '}}')}
          AND {_has('la', 'with')}
        UNION ALL SELECT doc_id, 'P3_phrase', 'phrases' FROM {{documents}} WHERE {_has('of the', 'de la')}""",
)
def profile_tagging(t: Data) -> DataFrame:
    tagged = tag_profiles(t["documents"].select("doc_id", "text"), "text", TEXT_PROFILES)
    return tagged.select("doc_id", "search_profile", "expected_risk_category")


@query(
    "profile_tagging_rows",
    r"""WITH profiles AS (SELECT * FROM {search_profiles} WHERE enabled),
             parts AS (SELECT doc_id, regexp_extract_all(lower(text), '[\pL\pN]+|[^\pL\pN]') AS t FROM {documents}),
             places AS (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i FROM parts),
             words AS (SELECT DISTINCT doc_id, t[i] AS w FROM places WHERE regexp_matches(t[i], '^[\pL\pN]')),
             phrases AS (SELECT DISTINCT doc_id, t[i] || ' ' || t[i + 2] AS phrase FROM places
                         WHERE t[i + 1] = ' ' AND regexp_matches(t[i], '^[\pL\pN]') AND regexp_matches(t[i + 2], '^[\pL\pN]')),
             first AS (SELECT DISTINCT doc_id, profile_id FROM (SELECT profile_id, unnest(one) AS w FROM profiles) JOIN words USING (w)),
             second AS (SELECT doc_id, profile_id FROM profiles JOIN (SELECT DISTINCT doc_id, left(w, 7) AS ending FROM words WHERE length(w) >= 7) USING (ending)
                        UNION SELECT doc_id, profile_id FROM profiles JOIN phrases USING (phrase))
        SELECT doc_id, profile_id AS search_profile, expected_risk_category
        FROM first JOIN second USING (doc_id, profile_id) JOIN profiles USING (profile_id)""",
)
def profile_tagging_rows(t: Data) -> DataFrame:
    tagged = tag_profiles(t["documents"].select("doc_id", "text"), "text", t["search_profiles"])
    return tagged.select("doc_id", "search_profile", "expected_risk_category")


# --- screening ---------------------------------------------------------------------------------


def _names(t: Data) -> DataFrame:
    return sanctions.screening_names(t["list_entities"], t["list_aliases"])


EXACT = f"""
SELECT i.input_id, i.input_name, i.norm AS normalized_input_name, s.entity_id, s.name_value AS matched_name, s.name_type,
       s.source_list, CASE WHEN s.entity_id IS NOT NULL THEN 'MATCH' ELSE 'NO_MATCH' END AS screening_result
FROM (SELECT input_id, input_name, {NORMAL.format('input_name')} AS norm FROM {{screening_inputs}}) i
LEFT JOIN {{list_names}} s ON i.norm = s.normalized_name
"""


@query("screen_exact", EXACT)
def screen_exact(t: Data) -> DataFrame:
    return screening.screen_exact(t["screening_inputs"], _names(t))


@query(
    "best_match_per_input",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY input_id
          ORDER BY CASE WHEN screening_result = 'MATCH' THEN 1 ELSE 2 END,
                   CASE name_type WHEN 'primary' THEN 1 WHEN 'alias' THEN 2 ELSE 99 END,
                   matched_name, entity_id, name_type, source_list) AS rn
        FROM ({EXACT})) WHERE rn = 1""",
)
def best_match_per_input(t: Data) -> DataFrame:
    return screening.screen_exact_best(t["screening_inputs"], _names(t))


# every pair of distinct normalised texts, scored by brute force
PAIRS = f"""
WITH i AS (SELECT input_id, input_name, {ASCII.format('input_name')} AS norm FROM {{screening_inputs}}),
     s AS (SELECT * FROM {{list_names}}),
     iv AS MATERIALIZED (SELECT norm, {GRAMS.format('norm')} AS g FROM (SELECT DISTINCT norm FROM i)),
     sv AS MATERIALIZED (SELECT normalized_name, {GRAMS.format('normalized_name')} AS g
                         FROM (SELECT DISTINCT normalized_name FROM s)),
     p AS MATERIALIZED (
       SELECT norm, normalized_name, CASE WHEN na + nb = 0 THEN 0.0 ELSE c / cast(na + nb - c AS double) END AS score
       FROM (SELECT iv.norm, sv.normalized_name, len(iv.g) AS na, len(sv.g) AS nb, len(list_intersect(iv.g, sv.g)) AS c
             FROM iv CROSS JOIN sv)
       WHERE (na + nb > 0 AND c / cast(na + nb - c AS double) > 0.7) OR norm = normalized_name)
"""
BEST = (
    PAIRS
    + """,
     m AS (SELECT i.input_name, i.norm, s.*, p.score, i.norm = s.normalized_name AS same
           FROM i JOIN p ON p.norm = i.norm JOIN s ON s.normalized_name = p.normalized_name),
     d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY input_name, name_value
             ORDER BY same DESC, score DESC, entity_id, name_type, source_list) AS drn FROM m) WHERE drn = 1),
     r AS (SELECT *, row_number() OVER (PARTITION BY input_name ORDER BY same DESC, score DESC, name_value) AS rn FROM d)
"""
)
BEST_COLUMNS = """input_name, norm AS normalized_input_name, entity_id, name_value AS matched_name,
    normalized_name AS matched_normalized_name, name_type, source_list, round(score, 4) AS similarity_score"""
VERDICT = """CASE WHEN same THEN 'MATCH' WHEN score >= 0.70 THEN 'POSSIBLE_MATCH' ELSE 'NO_MATCH' END AS screening_result"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("similarity_score", F.round("similarity_score", 4))


@query(
    "screen_fuzzy_top3",
    PAIRS
    + """SELECT input_name, norm AS normalized_input_name, entity_id, name_value AS matched_name, name_type, source_list,
                round(score, 4) AS similarity_score, rn
         FROM (SELECT i.input_name, i.norm, s.*, p.score, row_number() OVER (PARTITION BY i.input_name
                 ORDER BY p.score DESC, s.name_value, s.entity_id, s.name_type, s.source_list) AS rn
               FROM i JOIN p ON p.norm = i.norm AND p.score > 0.7 JOIN s ON s.normalized_name = p.normalized_name)
         WHERE rn <= 3""",
)
def screen_fuzzy_top3(t: Data) -> DataFrame:
    return _rounded(screening.screen_fuzzy_top(t["screening_inputs"], _names(t)))


@query("screen_fuzzy_best", BEST + f"SELECT {BEST_COLUMNS}, {VERDICT}, rn FROM r WHERE rn <= 3")
def screen_fuzzy_best(t: Data) -> DataFrame:
    return _rounded(screening.screen_fuzzy_best(t["screening_inputs"], _names(t)))


@query("dedup_pairs", BEST + f"SELECT {BEST_COLUMNS} FROM d")
def dedup_pairs(t: Data) -> DataFrame:
    return _rounded(screening.dedup_pairs(screening.similar_names(t["screening_inputs"], _names(t))))


@query("rank_candidates", BEST + "SELECT input_name, name_value AS matched_name, rn FROM r WHERE rn <= 3")
def rank_candidates(t: Data) -> DataFrame:
    pairs = screening.fuzzy_pairs(t["screening_inputs"], _names(t))
    return screening.rank_candidates(pairs).select("input_name", "matched_name", "rn")


@query("screening_verdict", BEST + f"SELECT screening_result, count(*) AS n FROM (SELECT {VERDICT} FROM d) GROUP BY 1")
def screening_verdict(t: Data) -> DataFrame:
    pairs = screening.fuzzy_pairs(t["screening_inputs"], _names(t))
    result = status.screening_verdict(F.col("normalized_input_name"), F.col("matched_normalized_name"), F.col("similarity_score"))
    return pairs.groupBy(result.alias("screening_result")).agg(F.count("*").alias("n"))


@query(
    "demo_results",
    BEST
    + f"""SELECT input_name, norm AS normalized_input_name, entity_id, name_value AS best_match,
                 normalized_name AS matched_normalized_name, name_type, source_list, round(score, 4) AS similarity_score,
                 {VERDICT} FROM r WHERE rn = 1""",
)
def demo_results(t: Data) -> DataFrame:
    return screening.demo_results(screening.screen_fuzzy_best(t["screening_inputs"], _names(t)))
