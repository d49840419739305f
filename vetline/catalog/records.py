"""Projections, joins, aggregations, windows and set operations on the record shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline import operators as op
from vetline.catalog.registry import Data, query
from vetline.operators.coverage import missing_ids
from vetline.operators.incremental import newest_file_per_date, rows_since_max_lazy
from vetline.plans import vacancies as vac
from vetline.plans import variants
from vetline.plans.manifest import build_manifest
from vetline.session import materialize

CUT = "1998-06-01"  # rows loaded before this day form the "old" side of incremental and upsert queries

FLAT_VACANCY = """
SELECT id AS vacancy_id, name AS title, published_at, cast(area->>'id' AS int) AS area_id, area->>'name' AS area_name,
       cast(employer->>'id' AS bigint) AS employer_id, cast(salary->>'from' AS decimal(18,2)) AS salary_from,
       cast(salary->>'to' AS decimal(18,2)) AS salary_to, salary->>'currency' AS salary_currency,
       schedule->>'name' AS schedule, employment->>'name' AS employment, experience->>'name' AS experience,
       archived, active_from, active_to, load_dt, search_profile, expected_risk_category
FROM {vacancy_bronze} WHERE employer IS NOT NULL AND (employer->>'id') IS NOT NULL
"""
SEEN = """
SELECT cast(employer->>'id' AS bigint) AS employer_id, employer->>'name' AS name, employer->>'url' AS url,
       cast(employer->>'trusted' AS boolean) AS trusted,
       cast(employer->>'accredited_it_employer' AS boolean) AS accredited_it_employer,
       cast(employer->>'country_id' AS int) AS country_id, min(load_dt) AS first_seen_dt, max(load_dt) AS last_seen_dt
FROM {list_bronze} WHERE employer IS NOT NULL AND (employer->>'id') IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6
"""
EMPLOYER_RANK = "last_seen_dt DESC NULLS LAST, name NULLS LAST, url NULLS LAST, trusted NULLS LAST, accredited_it_employer NULLS LAST, country_id NULLS LAST"
EMPLOYERS = f"""
SELECT employer_id, name, url, trusted, accredited_it_employer, country_id, first_dt AS first_seen_dt, last_seen_dt
FROM (SELECT *, min(first_seen_dt) OVER (PARTITION BY employer_id) AS first_dt,
             row_number() OVER (PARTITION BY employer_id ORDER BY {EMPLOYER_RANK}) AS rn FROM ({SEEN})) WHERE rn = 1
"""
SILVER_TEXT = """
SELECT id AS vacancy_id, regexp_replace(coalesce(description, ''), '<[^>]*>', '', 'g') AS description_text, load_dt
FROM {text_bronze}
"""
DETAILS = """
SELECT id AS vacancy_id, name AS vacancy_name, archived AS is_archived, published_at, created_at, initial_created_at,
       employer AS employer_json, description AS description_raw, branded_description AS branded_description_raw,
       key_skills AS key_skills_json, search_profile, expected_risk_category, load_dt, load_type, batch_idx, inserted_at
FROM {details_bronze}
"""
STAGED_EMPLOYERS = f"""
SELECT cast(employer_json->>'id' AS bigint) AS employer_id, employer_json->>'name' AS employer_name,
       employer_json->>'alternate_url' AS employer_alternate_url, employer_json->>'url' AS employer_api_url,
       employer_json->>'vacancies_url' AS employer_vacancies_url, cast(employer_json->>'trusted' AS boolean) AS is_trusted,
       cast(employer_json->>'accredited_it_employer' AS boolean) AS is_accredited_it_employer,
       cast(employer_json->>'is_identified_by_esia' AS boolean) AS is_identified_by_esia,
       cast(employer_json->>'country_id' AS int) AS country_id, employer_json->>'logo_urls' AS logo_urls_json,
       load_dt AS source_load_dt, inserted_at AS ingested_at
FROM ({DETAILS}) WHERE employer_json IS NOT NULL AND (employer_json->>'id') IS NOT NULL
"""


# --- projections and filters -------------------------------------------------------------------


@query("project_details", DETAILS)
def project_details(t: Data) -> DataFrame:
    return vac.project_details(t["details_bronze"])


@query("flatten_vacancy", FLAT_VACANCY)
def flatten_vacancy(t: Data) -> DataFrame:
    return vac.flatten_vacancies(t["vacancy_bronze"])


@query("flatten_employer", STAGED_EMPLOYERS)
def flatten_employer(t: Data) -> DataFrame:
    return vac.stage_employers(vac.project_details(t["details_bronze"]))


@query("flatten_vacancy_variant", FLAT_VACANCY)
def flatten_vacancy_variant(t: Data) -> DataFrame:
    """Through a stored table with VARIANT columns: parsed when landed, read by path."""
    landed = materialize(variants.with_variants(t["vacancy_bronze"], variants.LIST_JSON), "variant_bronze")
    return variants.flatten_vacancies(landed)


@query(
    "discover_columns",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS customer, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::varchar ELSE o_orderstatus END AS mixed,
              CASE WHEN o_orderkey % 5 = 0 THEN 0.5 ELSE o_custkey::double END AS number, o_orderkey % 7 = 0 AS flag
       FROM {orders}""",
)
def discover_columns(t: Data) -> DataFrame:
    """Records with a missing key, with numbers and texts in one field, and with whole and broken numbers in one."""
    text = F.expr(
        """concat('{', CASE WHEN o_orderkey % 3 <> 0 THEN concat('"customer":', o_custkey, ',') ELSE '' END,
                  '"mixed":', CASE WHEN o_orderkey % 2 = 0 THEN concat(o_custkey, '') ELSE concat('"', o_orderstatus, '"') END,
                  ',"number":', CASE WHEN o_orderkey % 5 = 0 THEN '0.5' ELSE concat(o_custkey, '') END,
                  ',"flag":', o_orderkey % 7 = 0, '}')"""
    )
    landed = materialize(t["orders"].select("o_orderkey", F.try_parse_json(text).alias("record")), "records")
    found = variants.discovered_columns(landed, "record", ["o_orderkey"])
    return found.withColumns({"number": F.col("number").cast("double"), "customer": F.col("customer").cast("bigint")})


def nested_items(t: Data) -> DataFrame:
    """List records with real nested objects, as an API client would hold them."""
    rows = t["list_bronze"]
    return rows.select(
        "id",
        "name",
        F.from_json("area", "id string, name string").alias("area"),
        F.from_json("employer", "id string, name string, trusted boolean").alias("employer"),
        F.from_json("salary", "`from` double, `to` double, currency string").alias("salary"),
        "published_at",
        F.concat(F.lit("https://example.org/vacancy/"), F.col("id").cast("string")).alias("alternate_url"),
        "archived",
    )


# A part of the columns of a list record.
WANTED = [
    "id", "name", "employer.name", "employer.id", "employer.trusted", "area.name", "area.id", "address.raw",
    "salary.from", "salary.to", "salary.currency", "experience.name", "published_at", "created_at", "archived",
]


@query(
    "select_existing_columns",
    """SELECT id, name, employer->>'name' AS "employer.name", employer->>'id' AS "employer.id",
              cast(employer->>'trusted' AS boolean) AS "employer.trusted", area->>'name' AS "area.name",
              area->>'id' AS "area.id", cast(salary->>'from' AS double) AS "salary.from",
              cast(salary->>'to' AS double) AS "salary.to", salary->>'currency' AS "salary.currency",
              published_at, archived
       FROM {list_bronze}""",
)
def select_existing_columns(t: Data) -> DataFrame:
    return op.existing_columns(nested_items(t), WANTED)


@query(
    "flatten_list_item",
    """SELECT cast(id AS varchar) AS id, name, area->>'name' AS region, 'etl' AS keyword, employer->>'name' AS employer,
              published_at, 'https://example.org/vacancy/' || cast(id AS varchar) AS url,
              cast(salary->>'from' AS double) AS salary_from, cast(salary->>'to' AS double) AS salary_to,
              salary->>'currency' AS currency, '2026-01-04' AS update_at
       FROM {list_bronze}""",
)
def flatten_list_item(t: Data) -> DataFrame:
    return vac.flatten_list_items(nested_items(t), "etl", F.lit("2026-01-04").cast("date"))


@query(
    "day_window_filter",
    """SELECT event_id, ts FROM {events}
       WHERE ts >= timestamp '2024-01-03 00:00:00' AND ts <= timestamp '2024-01-09 23:59:59.999999'""",
)
def day_window_filter(t: Data) -> DataFrame:
    return vac.day_window(t["events"], "ts", "2024-01-03", "2024-01-09").select("event_id", "ts")


@query(
    "stamp_lineage",
    """SELECT doc_id, 'P1_payments' AS search_profile, 'payments' AS expected_risk_category,
              '2026-01-04' AS load_dt, 'daily' AS load_type FROM {documents}""",
)
def stamp_lineage(t: Data) -> DataFrame:
    return op.stamp_lineage(
        t["documents"].select("doc_id"),
        search_profile="P1_payments",
        expected_risk_category="payments",
        load_dt="2026-01-04",
        load_type="daily",
    )


@query(
    "assign_batches",
    """SELECT o_orderkey, cast(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 200) AS int) AS batch_idx
       FROM {orders}""",
)
def assign_batches(t: Data) -> DataFrame:
    return op.assign_batches(t["orders"].select("o_orderkey"), 200, [F.col("o_orderkey")])


@query(
    "enrich_from_manifest",
    """WITH m AS (SELECT cast(doc_id AS varchar) AS vacancy_id, source AS search_profile, lang AS expected_risk_category,
                         cast(floor((row_number() OVER (ORDER BY doc_id) - 1) / 50) AS int) AS batch_idx
                  FROM {documents})
       SELECT m.vacancy_id, l.quality, l.toxic, m.search_profile, m.expected_risk_category, m.batch_idx
       FROM {labels} l JOIN m ON m.vacancy_id = cast(l.doc_id AS varchar)""",
)
def enrich_from_manifest(t: Data) -> DataFrame:
    manifest = t["manifest"].select("vacancy_id", "search_profile", "expected_risk_category")
    batched = op.assign_batches(manifest, 50, [F.col("vacancy_id").cast("bigint")])
    details = t["labels"].select(F.col("doc_id").cast("string").alias("vacancy_id"), "quality", "toxic")
    return op.enrich_from_manifest(details, batched)


# --- joins -------------------------------------------------------------------------------------


@query(
    "join_vacancy_text",
    f"""SELECT v.vacancy_id, v.load_dt, t.description_text
        FROM (SELECT id AS vacancy_id, load_dt FROM {{list_bronze}}) v
        LEFT JOIN ({SILVER_TEXT}) t ON v.vacancy_id = t.vacancy_id AND v.load_dt = t.load_dt""",
)
def join_vacancy_text(t: Data) -> DataFrame:
    from vetline.plans.risk import join_text

    vacancies = t["list_bronze"].select(F.col("id").alias("vacancy_id"), "load_dt")
    return join_text(vacancies, vac.silver_text(t.referred_text())).select("vacancy_id", "load_dt", "description_text")


@query(
    "join_vacancy_employer",
    f"""SELECT v.vacancy_id, v.employer_id, e.name AS employer_name
        FROM ({FLAT_VACANCY}) v LEFT JOIN ({EMPLOYERS}) e ON v.employer_id = e.employer_id""",
)
def join_vacancy_employer(t: Data) -> DataFrame:
    from vetline.plans.risk import join_employer

    joined = join_employer(vac.flatten_vacancies(t["vacancy_bronze"]), vac.employers_batch(t["list_bronze"]))
    return joined.select("vacancy_id", "employer_id", "employer_name")


SILVER_SKILLS = """
SELECT id AS vacancy_id, json_extract_string(x, '$.name') AS skill_name, load_dt
FROM (SELECT id, load_dt, unnest(from_json(key_skills, '["json"]')) AS x FROM {details_bronze})
"""


@query("lateral_explode", SILVER_SKILLS)
def lateral_explode(t: Data) -> DataFrame:
    return vac.silver_skills(t["details_bronze"])


@query(
    "anti_missing_ids",
    """SELECT DISTINCT cast(doc_id AS varchar) AS vacancy_id FROM {documents} d
       WHERE NOT EXISTS (SELECT 1 FROM {labels} l WHERE l.doc_id = d.doc_id)""",
)
def anti_missing_ids(t: Data) -> DataFrame:
    return missing_ids(t["manifest"], t["labels"], loaded_id="doc_id")


@query(
    "anti_new_rows",
    f"""SELECT id, name FROM {{csv_items}} n WHERE NOT EXISTS (SELECT 1 FROM {{csv_items}} o
        WHERE o.published_at < '{CUT}' AND o.id IS NOT DISTINCT FROM n.id AND o.name IS NOT DISTINCT FROM n.name)""",
)
def anti_new_rows(t: Data) -> DataFrame:
    """The whole history arrives again; rows from before the cut are there already."""
    items = t["csv_items"]
    return op.new_rows_only(items.filter(F.col("published_at") < CUT), items, ["id", "name"]).select("id", "name")


# --- aggregations ------------------------------------------------------------------------------


@query("employers_first_last_seen", SEEN)
def employers_first_last_seen(t: Data) -> DataFrame:
    return vac.employers_seen(t["list_bronze"])


@query(
    "distinct_ids",
    """SELECT count(DISTINCT l_orderkey) AS vacancies, count(DISTINCT l_partkey) AS parts, count(*) AS n FROM {lineitem}""",
)
def distinct_ids(t: Data) -> DataFrame:
    return t["lineitem"].agg(
        F.countDistinct("l_orderkey").alias("vacancies"),
        F.countDistinct("l_partkey").alias("parts"),
        F.count("*").alias("n"),
    )


@query(
    "failures_by_reason",
    "SELECT coalesce(reason, 'unknown') AS reason, count(*) AS n FROM {failures} GROUP BY 1",
)
def failures_by_reason(t: Data) -> DataFrame:
    return op.failure_counts(t["failures"], "reason")


@query(
    "failures_by_status",
    "SELECT coalesce(http_status, 'unknown') AS http_status, count(*) AS n FROM {failures} GROUP BY 1",
)
def failures_by_status(t: Data) -> DataFrame:
    return op.failure_counts(t["failures"], "http_status")


@query(
    "batch_status_counts",
    """SELECT batch_idx, count(*) FILTER (status = '200') AS ok, count(*) FILTER (status IS DISTINCT FROM '200') AS failed,
              count(*) FILTER (status = 'exception') AS exceptions, 0 AS is_total
       FROM {responses} GROUP BY batch_idx
       UNION ALL
       SELECT NULL, count(*) FILTER (status = '200'), count(*) FILTER (status IS DISTINCT FROM '200'),
              count(*) FILTER (status = 'exception'), 1 FROM {responses}""",
)
def batch_status_counts(t: Data) -> DataFrame:
    return op.batch_status_counts(t["responses"].withColumnRenamed("status", "http_status"))


@query(
    "batch_statuses",
    "SELECT batch_idx, coalesce(status, 'unknown') AS http_status, count(*) AS n FROM {responses} GROUP BY 1, 2",
)
def batch_statuses(t: Data) -> DataFrame:
    return op.batch_statuses(t["responses"].withColumnRenamed("status", "http_status"))


@query(
    "distinct_id_rows",
    "SELECT DISTINCT cast(l_orderkey AS varchar) AS id FROM {lineitem} WHERE l_orderkey IS NOT NULL",
)
def distinct_id_rows(t: Data) -> DataFrame:
    return op.distinct_ids(t["lineitem"], "l_orderkey")


@query(
    "profile_counts",
    "SELECT search_profile, count(*) AS n FROM {list_bronze} GROUP BY search_profile",
)
def profile_counts(t: Data) -> DataFrame:
    return op.profile_counts(t["list_bronze"])


@query(
    "max_mtime_by_dt",
    r"""SELECT regexp_extract(key, '/dt=([^/]*)', 1) AS dt, max(last_modified) AS last_modified
        FROM {file_keys} WHERE contains(key, '/dt=') GROUP BY 1""",
)
def max_mtime_by_dt(t: Data) -> DataFrame:
    return newest_file_per_date(t["file_keys"])


DISTINCT_SKILLS = """SELECT DISTINCT id AS vacancy_id, trim(json_extract_string(x, '$.name')) AS skill_name,
              load_dt AS source_load_dt, inserted_at AS ingested_at
       FROM (SELECT id, load_dt, inserted_at, unnest(from_json(key_skills, '["json"]')) AS x FROM {details_bronze})
       WHERE trim(json_extract_string(x, '$.name')) <> ''"""


@query("distinct_skills", DISTINCT_SKILLS)
def distinct_skills(t: Data) -> DataFrame:
    return vac.stage_skills(vac.project_details(t["details_bronze"]))


@query("distinct_skills_variant", DISTINCT_SKILLS)
def distinct_skills_variant(t: Data) -> DataFrame:
    landed = materialize(variants.with_variants(t["details_bronze"], variants.DETAIL_JSON), "variant_details")
    return variants.skills(landed)


def _map_text(column: str) -> F.Column:
    entry = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    return F.array_join(F.transform(F.map_entries(column), entry), ",").alias(column)


COVERAGE = """
WITH e AS (SELECT DISTINCT vacancy_id AS id FROM {manifest} WHERE vacancy_id <> ''),
     l AS (SELECT DISTINCT cast(doc_id AS varchar) AS id FROM {labels}),
     m AS (SELECT id FROM e WHERE id NOT IN (SELECT id FROM l)),
     c AS (SELECT (SELECT count(*) FROM e) AS expected_count, (SELECT count(*) FROM l) AS loaded_count,
                  (SELECT count(*) FROM m) AS missing_count),
     p AS (SELECT *, CASE WHEN expected_count = 0 THEN 0.0
                          ELSE loaded_count / cast(expected_count AS double) * 100 END AS coverage_pct FROM c)
SELECT '2024-01-01' AS ds, 'daily' AS load_type, expected_count, loaded_count, missing_count, coverage_pct,
       CASE WHEN expected_count = 0 THEN 'EMPTY_MANIFEST' ELSE 'OK' END AS coverage_reason,
       CASE WHEN expected_count = 0 THEN 'CRITICAL' WHEN missing_count = 0 THEN 'OK'
            WHEN missing_count <= 5 OR coverage_pct >= 99 THEN 'WARNING' ELSE 'CRITICAL' END AS severity,
       1 AS found_files, 1 AS failures_files,
       (SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT id FROM m ORDER BY id LIMIT 5)) AS sample_missing_ids,
       (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM
          (SELECT coalesce(reason, 'unknown') AS k, count(*) AS n FROM {failures} GROUP BY 1)) AS failures_by_reason,
       (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM
          (SELECT coalesce(http_status, 'unknown') AS k, count(*) AS n FROM {failures} GROUP BY 1)) AS failures_by_status
FROM p
"""


@query("coverage_report", COVERAGE)
def coverage_report(t: Data) -> DataFrame:
    report = op.coverage_report(
        t["manifest"],
        t["labels"],
        t["failures"],
        ds="2024-01-01",
        load_type="daily",
        found_files=1,
        failures_files=1,
        loaded_id="doc_id",
    )
    lists = {"sample_missing_ids", "failures_by_reason", "failures_by_status"}
    return report.select(
        *[name for name in report.columns if name not in lists],
        F.array_join("sample_missing_ids", ",").alias("sample_missing_ids"),
        _map_text("failures_by_reason"),
        _map_text("failures_by_status"),
    )


@query(
    "coverage_bitmaps",
    """SELECT source, count(*) AS expected_count, count(l.doc_id) AS loaded_count, count(*) - count(l.doc_id) AS missing_count
       FROM (SELECT DISTINCT doc_id, source FROM {documents}) d LEFT JOIN (SELECT DISTINCT doc_id FROM {labels}) l USING (doc_id) GROUP BY source""",
)
def coverage_bitmaps(t: Data) -> DataFrame:
    """Per source; the loaded ids come in two parts whose bitmaps are merged."""
    expected = op.id_bitmaps(t["documents"], "doc_id", ["source"])
    held = t["documents"].select("doc_id", "source").join(t["labels"].select("doc_id", "quality"), "doc_id")
    parts = [op.id_bitmaps(held.filter(part), "doc_id", ["source"]) for part in ("quality = 1", "quality IS DISTINCT FROM 1")]
    return op.bitmap_coverage(expected, op.merge_bitmaps(parts[0].union(parts[1]), ["source"]), ["source"])


@query(
    "coverage_severity",
    """SELECT source, count(*) AS expected, count(l.doc_id) AS loaded, count(*) - count(l.doc_id) AS missing,
              CASE WHEN count(*) - count(l.doc_id) = 0 THEN 'OK'
                   WHEN count(*) - count(l.doc_id) <= 5 OR count(l.doc_id) / cast(count(*) AS double) * 100 >= 99
                   THEN 'WARNING' ELSE 'CRITICAL' END AS severity
       FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id GROUP BY source""",
)
def coverage_severity(t: Data) -> DataFrame:
    from vetline.functions import coverage_severity as severity

    loaded = t["labels"].select("doc_id", F.lit(1).alias("hit"))
    counts = (
        t["documents"].select("doc_id", "source").join(loaded, "doc_id", "left")
        .groupBy("source")
        .agg(F.count("*").alias("expected"), F.count("hit").alias("loaded"))
        .withColumn("missing", F.col("expected") - F.col("loaded"))
    )
    pct = F.col("loaded") / F.col("expected") * 100
    return counts.withColumn("severity", severity(F.col("expected"), F.col("missing"), pct))


# --- windows, sorts, top-k ---------------------------------------------------------------------


@query(
    "latest_per_key",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY employer_id
          ORDER BY source_load_dt DESC NULLS FIRST, ingested_at DESC NULLS FIRST, is_trusted NULLS LAST) AS rn
        FROM ({STAGED_EMPLOYERS})) WHERE rn = 1""",
)
def latest_per_key(t: Data) -> DataFrame:
    staged = vac.stage_employers(vac.project_details(t["details_bronze"]))
    return vac.latest_employers(staged, F.col("is_trusted").asc_nulls_last())


@query(
    "topk_per_input",
    """SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn FROM {orders}) WHERE rn <= 3""",
)
def topk_per_input(t: Data) -> DataFrame:
    slim = t["orders"].select("o_custkey", "o_orderkey", "o_totalprice")
    return op.top_k(slim, ["o_custkey"], [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")], 3)


@query(
    "keep_first_per_id",
    """SELECT id, name, batch_idx, load_dt FROM (SELECT *, row_number() OVER (PARTITION BY id
          ORDER BY load_dt, batch_idx, name, salary) AS rn FROM {version_bronze}) WHERE rn = 1""",
)
def keep_first_per_id(t: Data) -> DataFrame:
    order = [F.col(name) for name in ("load_dt", "batch_idx", "name", "salary")]
    return op.keep_first(t["version_bronze"], "id", order).select("id", "name", "batch_idx", "load_dt")


@query(
    "sort_output",
    "SELECT id, expected_risk_category, load_dt FROM {list_bronze} ORDER BY expected_risk_category NULLS LAST, id",
)
def sort_output(t: Data) -> DataFrame:
    slim = t["list_bronze"].select("id", "expected_risk_category", "load_dt")
    return slim.orderBy(F.col("expected_risk_category").asc_nulls_last(), F.col("id"))


@query(
    "sample_missing_ids",
    """SELECT vacancy_id FROM {manifest} WHERE vacancy_id NOT IN (SELECT cast(doc_id AS varchar) FROM {labels})
       ORDER BY vacancy_id LIMIT 5""",
)
def sample_missing(t: Data) -> DataFrame:
    return op.sample_missing_ids(missing_ids(t["manifest"], t["labels"], loaded_id="doc_id"))


# --- set operations ----------------------------------------------------------------------------


@query(
    "union_names",
    "SELECT entity_id, name_value, name_type, source_list, load_timestamp, normalized_name FROM {list_names}",
)
def union_names(t: Data) -> DataFrame:
    from vetline.plans.sanctions import screening_names

    return screening_names(t["list_entities"], t["list_aliases"])


@query(
    "concat_batches",
    """SELECT doc_id AS id, text, lang, cast(NULL AS varchar) AS url FROM {documents}
       UNION ALL SELECT page_id, html, NULL, url FROM {pages}
       UNION ALL SELECT item_id, text, NULL, NULL FROM {benchmark}""",
)
def concat_batches(t: Data) -> DataFrame:
    return op.concat_batches(
        [
            t["documents"].select(F.col("doc_id").alias("id"), "text", "lang"),
            t["pages"].select(F.col("page_id").alias("id"), F.col("html").alias("text"), "url"),
            t["benchmark"].select(F.col("item_id").alias("id"), "text"),
        ]
    )


@query(
    "concat_drop_duplicates",
    f"""SELECT id, name, load_dt, batch_idx FROM (SELECT *, row_number() OVER (PARTITION BY id
           ORDER BY CASE WHEN load_dt < '{CUT}' THEN 0 ELSE 1 END, load_dt, batch_idx, name, salary) AS rn
         FROM {{version_bronze}}) WHERE rn = 1""",
)
def concat_drop_duplicates(t: Data) -> DataFrame:
    rows = t["version_bronze"]
    old, new = rows.filter(F.col("load_dt") < CUT), rows.filter(F.col("load_dt") >= CUT)
    order = [F.col(name) for name in ("load_dt", "batch_idx", "name", "salary")]
    return op.concat_keep_first(old, new, "id", order).select("id", "name", "load_dt", "batch_idx")


@query(
    "build_manifest",
    """SELECT cast(id AS varchar) AS vacancy_id, search_profile, cast(NULL AS varchar) AS expected_risk_category,
              coalesce(cast(load_dt AS varchar), '2026-01-04') AS load_dt, 'daily' AS load_type
       FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch_idx, load_dt, name, salary) AS rn
             FROM {version_bronze}) WHERE rn = 1""",
)
def manifest(t: Data) -> DataFrame:
    items = t["version_bronze"].withColumns(
        {"expected_risk_category": F.lit(None).cast("string"), "load_type": F.lit(None).cast("string")}
    )
    order = [F.col(name) for name in ("batch_idx", "load_dt", "name", "salary")]
    return build_manifest(items, "2026-01-04", "daily", order)


# --- incremental reads -------------------------------------------------------------------------


@query(
    "new_files_since",
    "SELECT key, last_modified FROM {file_keys} WHERE cast(last_modified AS date) > date '2024-01-20'",
)
def new_files_since(t: Data) -> DataFrame:
    return op.files_since(t["file_keys"], "2024-01-20")


@query(
    "partitions_to_reload",
    r"""SELECT dt, last_modified FROM (SELECT regexp_extract(key, '/dt=([^/]*)', 1) AS dt, max(last_modified) AS last_modified
          FROM {file_keys} WHERE contains(key, '/dt=') GROUP BY 1) WHERE cast(last_modified AS date) > date '2024-01-20'""",
)
def partitions_to_reload(t: Data) -> DataFrame:
    return op.partitions_to_reload(t["file_keys"], "2024-01-20")


@query(
    "incremental_since_max",
    f"""SELECT id, load_dt, batch_idx FROM {{version_bronze}}
        WHERE load_dt > (SELECT max(load_dt) FROM {{list_bronze}})""",
)
def incremental_since_max(t: Data) -> DataFrame:
    return op.rows_since_max(t["version_bronze"], t["list_bronze"]).select("id", "load_dt", "batch_idx")


@query(
    "incremental_since_max_empty",
    """SELECT id, load_dt FROM {list_bronze}
       WHERE load_dt > (SELECT max(load_dt) FROM {list_bronze} WHERE load_type = 'init')""",
)
def incremental_since_max_empty(t: Data) -> DataFrame:
    target = t["list_bronze"].filter("load_type = 'init'")
    return rows_since_max_lazy(t["list_bronze"], target).select("id", "load_dt")


@query(
    "incremental_since_max_coalesce",
    """SELECT id, load_dt FROM {list_bronze}
       WHERE load_dt > (SELECT coalesce(max(load_dt), date '1900-01-01') FROM {list_bronze} WHERE load_type = 'init')""",
)
def incremental_since_max_coalesce(t: Data) -> DataFrame:
    target = t["list_bronze"].filter("load_type = 'init'")
    return rows_since_max_lazy(t["list_bronze"], target, on_empty="all").select("id", "load_dt")


@query(
    "reload_single_date",
    "SELECT id, name, load_dt FROM {list_bronze} WHERE load_dt = date '1997-05-28'",
)
def reload_single_date(t: Data) -> DataFrame:
    return op.single_date(t["list_bronze"], "load_dt", "1997-05-28").select("id", "name", "load_dt")


@query(
    "mirror_incremental",
    f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY load_dt DESC, batch_idx DESC, name, salary) AS rn
                   FROM {{version_bronze}})
        SELECT id, name, salary, archived, load_dt, published_at, search_profile, batch_idx FROM s WHERE rn = 1""",
)
def mirror_incremental(t: Data) -> DataFrame:
    """A mirror built up to the cut, then brought up to date with what is newer than it holds."""
    source = t["version_bronze"]
    newest = [F.col("load_dt").desc(), F.col("batch_idx").desc(), F.col("name"), F.col("salary")]
    mirror = op.latest_per_key(source.filter(F.col("load_dt") < CUT), ["id"], newest)
    return op.merge_rows(mirror, op.rows_since_max(source, mirror), ["id"], latest_by=newest)


# --- upserts -----------------------------------------------------------------------------------

NEWEST = "load_dt DESC, batch_idx DESC, name, salary"
OLD_NEW = f"""
WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {NEWEST}) AS rn
                          FROM {{version_bronze}} WHERE load_dt < '{CUT}') WHERE rn = 1),
     n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {NEWEST}) AS rn
                          FROM {{version_bronze}} WHERE load_dt >= '{CUT}') WHERE rn = 1)
"""


def _newest() -> list:
    return [F.col("load_dt").desc(), F.col("batch_idx").desc(), F.col("name"), F.col("salary")]


def _old_new(t: Data) -> tuple[DataFrame, DataFrame]:
    rows = t["version_bronze"]
    old = op.latest_per_key(rows.filter(F.col("load_dt") < CUT), ["id"], _newest())
    return old, rows.filter(F.col("load_dt") >= CUT)


@query(
    "upsert_latest",
    OLD_NEW
    + """SELECT coalesce(n.id, o.id) AS id, CASE WHEN n.id IS NULL THEN o.name ELSE n.name END AS name,
                CASE WHEN n.id IS NULL THEN o.salary ELSE n.salary END AS salary,
                CASE WHEN n.id IS NULL THEN o.archived ELSE n.archived END AS archived,
                CASE WHEN n.id IS NULL THEN o.load_dt ELSE n.load_dt END AS load_dt,
                CASE WHEN n.id IS NULL THEN o.published_at ELSE n.published_at END AS published_at,
                CASE WHEN n.id IS NULL THEN o.search_profile ELSE n.search_profile END AS search_profile,
                CASE WHEN n.id IS NULL THEN o.batch_idx ELSE n.batch_idx END AS batch_idx
         FROM o FULL JOIN n ON o.id = n.id""",
)
def upsert_latest(t: Data) -> DataFrame:
    old, new = _old_new(t)
    return op.merge_rows(old, new, ["id"], latest_by=_newest())


VALID = """coalesce(cast(substring({0}.published_at, 1, 10) AS date), {0}.load_dt)"""


@query(
    "upsert_bronze_validity",
    OLD_NEW
    + f"""SELECT coalesce(n.id, o.id) AS id, CASE WHEN n.id IS NULL THEN o.name ELSE n.name END AS name,
                 CASE WHEN n.id IS NULL THEN o.archived ELSE n.archived END AS archived,
                 CASE WHEN n.id IS NULL THEN o.load_dt ELSE n.load_dt END AS load_dt,
                 coalesce({VALID.format('o')}, {VALID.format('n')}) AS active_from,
                 CASE WHEN n.id IS NULL THEN CASE WHEN o.archived THEN o.load_dt ELSE date '2999-01-01' END
                      WHEN n.archived THEN n.load_dt ELSE date '2999-01-01' END AS active_to
          FROM o FULL JOIN n ON o.id = n.id""",
)
def upsert_bronze_validity(t: Data) -> DataFrame:
    old, new = _old_new(t)
    merged = vac.upsert_bronze(vac.with_validity(old), new, latest_by=_newest())
    return merged.select("id", "name", "archived", "load_dt", "active_from", "active_to")


@query("upsert_employers_least_greatest", EMPLOYERS)
def upsert_employers_least_greatest(t: Data) -> DataFrame:
    """Loaded in two parts, the dates must come out as if loaded at once."""
    rows = t["list_bronze"]
    old = vac.employers_batch(rows.filter(F.col("load_dt") < CUT))
    new = vac.employers_batch(rows.filter(F.col("load_dt") >= CUT))
    return vac.upsert_employers(old, new)


@query(
    "insert_ignore",
    f"""SELECT vacancy_id, skill_name, load_dt FROM (
          SELECT *, row_number() OVER (PARTITION BY vacancy_id, skill_name
                                       ORDER BY CASE WHEN load_dt < '{CUT}' THEN 0 ELSE 1 END, load_dt) AS rn
          FROM (SELECT id AS vacancy_id, name AS skill_name, load_dt FROM {{version_bronze}})) WHERE rn = 1""",
)
def insert_ignore(t: Data) -> DataFrame:
    keys = ["vacancy_id", "skill_name"]
    rows = t["version_bronze"].select(F.col("id").alias("vacancy_id"), F.col("name").alias("skill_name"), "load_dt")
    old = op.latest_per_key(rows.filter(F.col("load_dt") < CUT), keys, [F.col("load_dt")])
    return op.insert_ignore(old, rows.filter(F.col("load_dt") >= CUT), keys, [F.col("load_dt")])


@query(
    "upsert_skills_update",
    """SELECT id AS vacancy_id, name AS skill_name, max(load_dt) AS load_dt FROM {version_bronze} GROUP BY 1, 2""",
)
def upsert_skills_update(t: Data) -> DataFrame:
    keys = ["vacancy_id", "skill_name"]
    rows = t["version_bronze"].select(F.col("id").alias("vacancy_id"), F.col("name").alias("skill_name"), "load_dt")
    old = op.latest_per_key(rows.filter(F.col("load_dt") < CUT), keys, [F.col("load_dt").desc()])
    return op.merge_rows(old, rows.filter(F.col("load_dt") >= CUT), keys, latest_by=[F.col("load_dt").desc()])


REPORTS = """
SELECT cast(ts AS date) AS load_dt, {0} AS load_type, count(*) AS expected_count,
       count(*) FILTER (event_type <> 'error') AS loaded_count,
       nullif(cast(sum(CASE WHEN event_type = 'error' AND value > 20 THEN 1 ELSE 0 END) AS bigint), 0) AS failures
FROM {{events}} WHERE {1} GROUP BY 1
"""


@query(
    "upsert_report",
    f"""SELECT load_dt, coalesce(n.load_type, o.load_type) AS load_type,
               coalesce(n.expected_count, o.expected_count) AS expected_count,
               coalesce(n.loaded_count, o.loaded_count) AS loaded_count,
               CASE WHEN n.load_type IS NULL THEN o.failures ELSE n.failures END AS failures
        FROM ({REPORTS.format("'first'", "true")}) o
        FULL JOIN ({REPORTS.format("'rerun'", "ts >= timestamp '2024-01-10 00:00:00'")}) n USING (load_dt)""",
)
def upsert_report(t: Data) -> DataFrame:
    def reports(rows: DataFrame, load_type: str) -> DataFrame:
        bad = F.count_if((F.col("event_type") == "error") & (F.col("value") > 20))
        return rows.groupBy(F.to_date("ts").alias("load_dt")).agg(
            F.lit(load_type).alias("load_type"),
            F.count("*").alias("expected_count"),
            F.count_if(F.col("event_type") != "error").alias("loaded_count"),
            F.nullif(bad, F.lit(0).cast("bigint")).alias("failures"),
        )

    events = t["events"]
    first = reports(events, "first")
    rerun = reports(events.filter(F.col("ts") >= F.lit("2024-01-10").cast("date")), "rerun")
    return op.merge_rows(first, rerun, ["load_dt"])


# --- data quality ------------------------------------------------------------------------------


@query(
    "dq_not_null",
    """SELECT unnest(['name', 'salary', 'employer', 'schedule', 'expected_risk_category']) AS column_name,
              unnest([count(*) - count(name), count(*) - count(salary), count(*) - count(employer),
                      count(*) - count(schedule), count(*) - count(expected_risk_category)]) AS failures
       FROM {list_bronze}""",
)
def dq_not_null(t: Data) -> DataFrame:
    return op.null_counts(t["list_bronze"], ["name", "salary", "employer", "schedule", "expected_risk_category"])


@query(
    "dq_observed",
    """SELECT unnest(['name', 'salary', 'employer', 'schedule', 'expected_risk_category']) AS column_name,
              unnest([count(*) - count(name), count(*) - count(salary), count(*) - count(employer),
                      count(*) - count(schedule), count(*) - count(expected_risk_category)]) AS failures
       FROM {list_bronze}""",
)
def dq_observed(t: Data) -> DataFrame:
    """The same counts, taken while the rows are stored."""
    from vetline.operators.quality import store_observed

    _, nulls = store_observed(t["list_bronze"], "list_bronze", ["name", "salary", "employer", "schedule", "expected_risk_category"])
    return t.spark.createDataFrame(list(nulls.items()), "column_name string, failures bigint")


@query(
    "dq_unique",
    """SELECT l_orderkey, l_partkey, count(*) AS n FROM {lineitem} GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dq_unique(t: Data) -> DataFrame:
    return op.duplicate_keys(t["lineitem"], ["l_orderkey", "l_partkey"])


@query(
    "dq_constraints",
    f"""WITH s AS ({SILVER_SKILLS}), e AS ({SEEN})
        SELECT 'vacancy_skills' AS table_name, 'vacancy_id' AS column_name, 'not_null' AS rule,
               count(*) - count(vacancy_id) AS failures FROM s
        UNION ALL SELECT 'vacancy_skills', 'skill_name', 'not_null', count(*) - count(skill_name) FROM s
        UNION ALL SELECT 'vacancy_skills', 'vacancy_id,skill_name', 'unique', count(*)
                  FROM (SELECT 1 FROM s WHERE skill_name IS NOT NULL GROUP BY vacancy_id, skill_name HAVING count(*) > 1)
        UNION ALL SELECT 'employers', 'employer_id', 'not_null', count(*) - count(employer_id) FROM e
        UNION ALL SELECT 'employers', 'name', 'not_null', count(*) - count(name) FROM e
        UNION ALL SELECT 'employers', 'employer_id', 'unique', count(*)
                  FROM (SELECT 1 FROM e GROUP BY employer_id HAVING count(*) > 1)""",
)
def dq_constraints(t: Data) -> DataFrame:
    from vetline.operators.quality import check_all

    return check_all(
        {
            "vacancy_skills": (
                vac.silver_skills(t["details_bronze"]),
                ["vacancy_id", "skill_name"],
                ["vacancy_id", "skill_name"],
            ),
            "employers": (vac.employers_seen(t["list_bronze"]), ["employer_id", "name"], ["employer_id"]),
        }
    )
