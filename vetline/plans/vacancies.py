"""Bronze records to staging and silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.functions import clean_html_spaced, display_text, json_fields, strip_tags, visible_text_lines
from vetline.operators.dedup import latest_per_key
from vetline.operators.merge import Rule, merge_rows
from vetline.operators.referred import Referred
from vetline.operators.shape import explode_json_array

OPEN_END = "2999-01-01"
LIST_ITEM_COLUMNS = (
    "id", "name", "region", "keyword", "employer", "published_at", "url", "salary_from", "salary_to", "currency",
    "update_at",
)


def project_details(details: DataFrame) -> DataFrame:
    """The staging view of the detail records."""
    renamed = {
        "id": "vacancy_id",
        "name": "vacancy_name",
        "archived": "is_archived",
        "published_at": "published_at",
        "created_at": "created_at",
        "initial_created_at": "initial_created_at",
        "employer": "employer_json",
        "description": "description_raw",
        "branded_description": "branded_description_raw",
        "key_skills": "key_skills_json",
        "search_profile": "search_profile",
        "expected_risk_category": "expected_risk_category",
        "load_dt": "load_dt",
        "load_type": "load_type",
        "batch_idx": "batch_idx",
        "inserted_at": "inserted_at",
    }
    return details.select(*[F.col(old).alias(new) for old, new in renamed.items()])


def _with_employer(bronze: DataFrame, *fields: str) -> DataFrame:
    """Employer JSON parsed once; rows without an employer id are dropped."""
    return bronze.withColumn("_employer", json_fields("employer", *fields)).filter(
        F.col("employer").isNotNull() & F.col("_employer.id").isNotNull()
    )


def flatten_vacancies(bronze: DataFrame) -> DataFrame:
    parsed = _with_employer(bronze, "id").withColumns(
        {
            "_area": json_fields("area", "id", "name"),
            "_salary": json_fields("salary", "from", "to", "currency"),
        }
    )
    money = "decimal(18,2)"
    return parsed.select(
        F.col("id").alias("vacancy_id"),
        F.col("name").alias("title"),
        "published_at",
        F.col("_area.id").cast("int").alias("area_id"),
        F.col("_area.name").alias("area_name"),
        F.col("_employer.id").cast("bigint").alias("employer_id"),
        F.col("_salary.from").cast(money).alias("salary_from"),
        F.col("_salary.to").cast(money).alias("salary_to"),
        F.col("_salary.currency").alias("salary_currency"),
        json_fields("schedule", "name")["name"].alias("schedule"),
        json_fields("employment", "name")["name"].alias("employment"),
        json_fields("experience", "name")["name"].alias("experience"),
        "archived",
        "active_from",
        "active_to",
        "load_dt",
        "search_profile",
        "expected_risk_category",
    )


def employers_seen(bronze: DataFrame) -> DataFrame:
    """One row per employer and attribute combination with its first and last load date."""
    fields = ("id", "name", "url", "trusted", "accredited_it_employer", "country_id")
    flat = _with_employer(bronze, *fields).select(
        F.col("_employer.id").cast("bigint").alias("employer_id"),
        F.col("_employer.name").alias("name"),
        F.col("_employer.url").alias("url"),
        F.col("_employer.trusted").cast("boolean").alias("trusted"),
        F.col("_employer.accredited_it_employer").cast("boolean").alias("accredited_it_employer"),
        F.col("_employer.country_id").cast("int").alias("country_id"),
        "load_dt",
    )
    return flat.groupBy(*flat.columns[:-1]).agg(
        F.min("load_dt").cast("date").alias("first_seen_dt"), F.max("load_dt").cast("date").alias("last_seen_dt")
    )


EMPLOYER_ORDER = ("name", "url", "trusted", "accredited_it_employer", "country_id")


def latest_employer_order() -> list:
    """Newest attributes first; the attributes themselves settle ties."""
    return [F.col("last_seen_dt").desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in EMPLOYER_ORDER]]


def employers_batch(bronze: DataFrame) -> DataFrame:
    """One row per employer: the newest attributes, the earliest and the latest date.

    One pass over the records and two aggregates that both combine before their shuffle, so an
    employer with a large share of the vacancies is a handful of rows by then.
    """
    seen = employers_seen(bronze)
    # oldest-last, then the attributes with NULLs at the end; the smallest rank wins
    rank = [-F.unix_date("last_seen_dt")]
    for name in EMPLOYER_ORDER:
        rank += [F.col(name).isNull(), F.col(name)]
    newest = F.min_by(F.struct(*EMPLOYER_ORDER), F.struct(*rank))
    return (
        seen.groupBy("employer_id")
        .agg(
            newest.alias("_newest"),
            F.min("first_seen_dt").alias("first_seen_dt"),
            F.max("last_seen_dt").alias("last_seen_dt"),
        )
        .select("employer_id", "_newest.*", "first_seen_dt", "last_seen_dt")
    )


def upsert_employers(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Attributes are replaced; the seen-dates only ever widen."""
    rules = {"first_seen_dt": Rule.LEAST, "last_seen_dt": Rule.GREATEST}
    return merge_rows(target, batch, ["employer_id"], rules)


def stage_employers(details: DataFrame) -> DataFrame:
    """Latest employer record per id from the staged details (NULL dates first, as in Postgres)."""
    fields = (
        "id", "name", "alternate_url", "url", "vacancies_url", "trusted", "accredited_it_employer",
        "is_identified_by_esia", "country_id", "logo_urls",
    )
    flat = (
        details.filter(F.col("employer_json").isNotNull())
        .withColumn("_e", json_fields("employer_json", *fields))
        .select(
            F.col("_e.id").cast("bigint").alias("employer_id"),
            F.col("_e.name").alias("employer_name"),
            F.col("_e.alternate_url").alias("employer_alternate_url"),
            F.col("_e.url").alias("employer_api_url"),
            F.col("_e.vacancies_url").alias("employer_vacancies_url"),
            F.col("_e.trusted").cast("boolean").alias("is_trusted"),
            F.col("_e.accredited_it_employer").cast("boolean").alias("is_accredited_it_employer"),
            F.col("_e.is_identified_by_esia").cast("boolean").alias("is_identified_by_esia"),
            F.col("_e.country_id").cast("int").alias("country_id"),
            F.col("_e.logo_urls").alias("logo_urls_json"),
            F.col("load_dt").alias("source_load_dt"),
            F.col("inserted_at").alias("ingested_at"),
        )
    )
    return flat.filter(F.col("employer_id").isNotNull())


def latest_employers(staged: DataFrame, *ties) -> DataFrame:
    order = [F.col("source_load_dt").desc_nulls_first(), F.col("ingested_at").desc_nulls_first(), *ties]
    return latest_per_key(staged, ["employer_id"], order)


def stage_skills(details: DataFrame) -> DataFrame:
    """Distinct trimmed skills per vacancy; blank ones are dropped."""
    items = explode_json_array(
        details.select("vacancy_id", "key_skills_json", "load_dt", "inserted_at"), "key_skills_json", "name", "_name"
    )
    return (
        items.select(
            "vacancy_id",
            F.nullif(F.trim("_name"), F.lit("")).alias("skill_name"),
            F.col("load_dt").alias("source_load_dt"),
            F.col("inserted_at").alias("ingested_at"),
        )
        .filter(F.col("skill_name").isNotNull())
        .distinct()
    )


def silver_skills(bronze_details: DataFrame) -> DataFrame:
    """Every array element as it is, duplicates and blanks included."""
    slim = bronze_details.select(F.col("id").alias("vacancy_id"), "key_skills", "load_dt")
    return explode_json_array(slim, "key_skills", "name", "skill_name").select("vacancy_id", "skill_name", "load_dt")


def stage_text(details: DataFrame) -> DataFrame:
    raw = display_text("branded_description_raw", "description_raw")
    return details.select(
        "vacancy_id",
        "description_raw",
        "branded_description_raw",
        raw.alias("text_raw"),
        clean_html_spaced(raw).alias("text_clean"),
        F.col("load_dt").alias("source_load_dt"),
        F.col("inserted_at").alias("ingested_at"),
    )


def silver_text(bronze_details: DataFrame | Referred, visible_lines: bool = False) -> DataFrame | Referred:
    """Text for the risk signals: tags stripped, or (the slower way) the visible text nodes.

    Of referred texts each is cleaned once, however many rows refer to it.
    """
    clean = visible_text_lines("description") if visible_lines else strip_tags("description")
    if isinstance(bronze_details, Referred):
        rows = bronze_details.rows.select(F.col("id").alias("vacancy_id"), "load_dt", bronze_details.ref)
        return Referred(rows, bronze_details.bodies.select(bronze_details.ref, clean.alias("description_text")), bronze_details.ref)
    return bronze_details.select(F.col("id").alias("vacancy_id"), clean.alias("description_text"), "load_dt")


def flatten_list_items(items: DataFrame, keyword: str, business_date=None) -> DataFrame:
    """Ten fields of the nested list record, NULL where a parent object is missing."""
    today = F.current_date() if business_date is None else F.lit(business_date)
    return items.select(
        F.col("id").cast("string").alias("id"),
        "name",
        F.col("area.name").alias("region"),
        F.lit(keyword).alias("keyword"),
        F.col("employer.name").alias("employer"),
        "published_at",
        F.col("alternate_url").alias("url"),
        F.col("salary.from").alias("salary_from"),
        F.col("salary.to").alias("salary_to"),
        F.col("salary.currency").alias("currency"),
        F.date_format(today, "yyyy-MM-dd").alias("update_at"),
    )


def day_window(df: DataFrame, column: str, first_day: str, last_day: str | None = None) -> DataFrame:
    """Rows from the start of the first day to the end of the last (the same day by default)."""
    start = F.lit(first_day).cast("date")
    end = F.date_add(F.lit(last_day or first_day).cast("date"), 1)
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def with_validity(rows: DataFrame) -> DataFrame:
    """Initial validity: from the publication day in its own zone, open unless archived."""
    published = F.to_date(F.substring("published_at", 1, 10))
    return rows.withColumns(
        {
            "active_from": F.coalesce(published, F.col("load_dt")),
            "active_to": F.when(F.col("archived"), F.col("load_dt")).otherwise(F.lit(OPEN_END).cast("date")),
        }
    )


def upsert_bronze(target: DataFrame, updates: DataFrame, latest_by=None) -> DataFrame:
    """Replace all but ``active_from``, which stays once set; ``active_to`` follows the new row."""
    rules = {
        "active_from": Rule.KEEP_FIRST,
        "active_to": F.when(F.col("new.archived"), F.col("new.load_dt")).otherwise(F.lit(OPEN_END).cast("date")),
    }
    return merge_rows(target, with_validity(updates), ["id"], rules, latest_by)
