"""The composed jobs: collected files to risk signals, and sanctions files to screening results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.operators.coverage import coverage_report
from vetline.operators.merge import Rule
from vetline.operators.pairstore import PairStore
from vetline.operators.quality import store_checked
from vetline.plans import risk, sanctions, screening, vacancies
from vetline.plans.manifest import build_manifest, file_order
from vetline.sources.jsonl import read_jsonl, read_jsonl_quarantine
from vetline.sources.listing import file_listing
from vetline.sources.sinks import replace_table
from vetline.sources.store import KeyedStore
from vetline.sources.xml import read_entities, read_individuals

BRONZE_LIST = """
    id bigint, name string, area string, salary string, employer string, schedule string, employment string,
    experience string, published_at string, created_at string, archived boolean, search_profile string,
    expected_risk_category string
"""
BRONZE_DETAILS = """
    id bigint, name string, archived boolean, employer string, description string, branded_description string,
    key_skills string, published_at string, created_at string, search_profile string, expected_risk_category string
"""
STORES = {
    "vacancies": (
        "vacancy_id bigint, title string, published_at string, area_id int, area_name string, employer_id bigint, "
        "salary_from decimal(18,2), salary_to decimal(18,2), salary_currency string, schedule string, "
        "employment string, experience string, archived boolean, active_from date, active_to date, load_dt date, "
        "search_profile string, expected_risk_category string",
        ["vacancy_id"],
    ),
    "employers": (
        "employer_id bigint, name string, url string, trusted boolean, accredited_it_employer boolean, "
        "country_id int, first_seen_dt date, last_seen_dt date",
        ["employer_id"],
    ),
    "vacancy_skills": ("vacancy_id bigint, skill_name string, load_dt date", ["vacancy_id", "skill_name"]),
    "vacancy_text": ("vacancy_id bigint, description_text string, load_dt date", ["vacancy_id"]),
}


def silver_stores(spark: SparkSession, warehouse: str, buckets: int | None = None) -> dict[str, KeyedStore]:
    return {
        name: KeyedStore(spark, f"{warehouse}/silver/{name}", schema, keys, buckets)
        for name, (schema, keys) in STORES.items()
    }


BRONZE_STORES = {
    "vacancies": (f"{BRONZE_LIST.strip()}, load_dt date, load_type string, active_from date, active_to date", ["id"]),
    "vacancy_details": (f"{BRONZE_DETAILS.strip()}, load_dt date, load_type string", ["id"]),
}
REPORT_STORE = (
    "load_dt date, load_type string, expected_count bigint, loaded_count bigint, missing_count bigint, coverage_pct double, "
    "severity string, found_files int, failures_by_reason string",
    ["load_dt"],
)
MANIFEST_ROWS = "vacancy_id string, search_profile string, expected_risk_category string, load_dt string, load_type string"
FAILURE_ROWS = "reason string, http_status string"


def bronze_stores(spark: SparkSession, warehouse: str, buckets: int | None = None) -> dict[str, KeyedStore]:
    return {
        name: KeyedStore(spark, f"{warehouse}/bronze/{name}", schema, keys, buckets)
        for name, (schema, keys) in BRONZE_STORES.items()
    }


def _newest(*ties: str) -> list[Column]:
    return [F.col("load_dt").desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in ties]]


def load_day(
    spark: SparkSession, landing: str, warehouse: str, ds: str, load_type: str = "daily", buckets: int | None = None
) -> None:
    """One business date: landed JSON lines to bronze and the four silver tables; bad lines go to quarantine.

    The date and load type are in the folder names, so only that date's files are read, once: what is landed is
    stored before bronze and silver take it. Bronze keeps one row per id with its validity: ``active_from`` stays as
    first set, all else follows the new row. A rerun changes nothing.
    """
    stores = silver_stores(spark, warehouse, buckets)
    bronze_tables = bronze_stores(spark, warehouse, buckets)
    day = F.lit(ds).cast("date")

    def landed(entity: str, schema: str) -> DataFrame:
        good, bad = read_jsonl_quarantine(spark, f"{landing}/{entity}/load_type={load_type}/dt={ds}", schema, ["id"])
        bad.write.mode("overwrite").json(f"{warehouse}/quarantine/{entity}/load_type={load_type}/dt={ds}")
        # stored once, and checked on the way: a row without key or date stops the load before any table changes
        return store_checked(good.withColumns({"load_dt": day, "load_type": F.lit(load_type)}), entity, ["id", "load_dt"])

    bronze = vacancies.with_validity(landed("vacancies_list", BRONZE_LIST))
    bronze_tables["vacancies"].upsert(bronze, _newest("published_at", "name"), {"active_from": Rule.KEEP_FIRST})
    stores["vacancies"].upsert(
        vacancies.flatten_vacancies(bronze), _newest("published_at", "title"), {"active_from": Rule.KEEP_FIRST}
    )
    stores["employers"].upsert(
        vacancies.employers_batch(bronze).filter("employer_id IS NOT NULL"),
        vacancies.latest_employer_order(),
        {"first_seen_dt": Rule.LEAST, "last_seen_dt": Rule.GREATEST},
    )
    details = landed("vacancy_details", BRONZE_DETAILS)
    bronze_tables["vacancy_details"].upsert(details, _newest("published_at", "name"))
    stores["vacancy_text"].upsert(vacancies.silver_text(details), _newest("description_text"))
    # a skill without a name has no key
    named = vacancies.silver_skills(details).filter("skill_name IS NOT NULL")
    stores["vacancy_skills"].insert_ignore(named, [F.col("load_dt")])


def _landed_files(spark: SparkSession, folder: str) -> DataFrame | None:
    """The JSON-lines files of a folder as one row each, None where the folder is missing."""
    try:
        return file_listing(spark, folder).filter(F.col("key").rlike(r"\.jsonl?(\.gz)?$"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_day_manifest(spark: SparkSession, landing: str, ds: str, load_type: str = "daily") -> str:
    """The ids that the day's list names, each once and in file order, as JSON lines beside it."""
    day = f"load_type={load_type}/dt={ds}"
    listed = read_jsonl(spark, f"{landing}/vacancies_list/{day}", BRONZE_LIST.replace("id bigint", "id string", 1) + ", load_dt string, load_type string", "DROPMALFORMED")
    placed = listed.select("*", F.struct(*file_order()).alias("place"))
    path = f"{landing}/vacancies_ids/{day}"
    build_manifest(placed, ds, load_type, [F.col("place")]).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def report_day(spark: SparkSession, landing: str, warehouse: str, ds: str, load_type: str = "daily", buckets: int | None = None) -> DataFrame:
    """The day's coverage: manifest against loaded details, with failures and how many files each has.

    The report is written as JSON beside the landed files and upserted by date into bronze. A missing manifest is
    reported as such; missing details or failures count as none.
    """
    day = f"load_type={load_type}/dt={ds}"
    parts = {"manifest": ("vacancies_ids", MANIFEST_ROWS), "details": ("vacancy_details", "id string"), "failures": ("vacancy_details_failures", FAILURE_ROWS)}
    frames, counts = {}, {}
    for name, (entity, schema) in parts.items():
        files = _landed_files(spark, f"{landing}/{entity}/{day}")
        counts[name] = 0 if files is None else files.count()
        frames[name] = read_jsonl(spark, f"{landing}/{entity}/{day}", schema, "DROPMALFORMED") if counts[name] else spark.createDataFrame([], schema)
    report = coverage_report(
        frames["manifest"],
        frames["details"],
        frames["failures"],
        ds=ds,
        load_type=load_type,
        found_files=counts["details"],
        failures_files=counts["failures"],
        manifest_present=counts["manifest"] > 0,
    )
    path = f"{landing}/reports/vacancy_details_coverage/{day}"
    report.write.mode("overwrite").json(path)
    stored = spark.read.schema(report.schema).json(path)
    row = stored.select(
        F.col("ds").cast("date").alias("load_dt"),
        *["load_type", "expected_count", "loaded_count", "missing_count", "coverage_pct", "severity", "found_files"],
        F.to_json("failures_by_reason").alias("failures_by_reason"),
    )
    KeyedStore(spark, f"{warehouse}/bronze/details_coverage_report", *REPORT_STORE, buckets).upsert(row, [F.col("load_type")])
    return stored


def refresh_risk_signals(spark: SparkSession, warehouse: str, sanctioned: DataFrame | None = None) -> DataFrame:
    """Recompute the gold table and give it back as stored."""
    stores = silver_stores(spark, warehouse)
    path = f"{warehouse}/gold/vacancy_risk_signals"
    replace_table(
        risk.risk_signals(
            stores["vacancies"].read(), stores["vacancy_text"].read(), stores["employers"].read(), sanctioned
        ),
        path,
    )
    return spark.read.parquet(path)


def load_sanctions(spark: SparkSession, xml_path: str, warehouse: str) -> DataFrame:
    """Truncate and reload the four tables of the list, then the screening names."""
    tables = sanctions.flatten_sanctions(read_individuals(spark, xml_path), read_entities(spark, xml_path))
    for name, df in tables.items():
        replace_table(sanctions.passthrough(name, df), f"{warehouse}/silver/sanctions_{name}")
    stored = {name: spark.read.parquet(f"{warehouse}/silver/sanctions_{name}") for name in ("entities", "aliases")}
    path = f"{warehouse}/silver/sanctions_names"
    replace_table(sanctions.screening_names(stored["entities"], stored["aliases"]), path)
    return spark.read.parquet(path)


def screen(inputs: DataFrame, names: DataFrame, warehouse: str) -> dict[str, DataFrame]:
    """The screening marts, stored; the demo mart is read off the stored fuzzy one.

    The similar names lie in a store: only inputs and names that it has not seen are compared, once for both fuzzy marts.
    """
    spark = inputs.sparkSession
    store = PairStore(spark, f"{warehouse}/gold/similar_names", screening.THRESHOLD)
    pairs = screening.update_pairs(store, inputs, names)
    marts = {
        "sanctions_exact_matches": screening.screen_exact(inputs, names),
        "sanctions_exact_matches_best": screening.screen_exact_best(inputs, names),
        "sanctions_fuzzy_matches": screening.screen_fuzzy_top(inputs, names, pairs=pairs),
        "sanctions_fuzzy_matches_best": screening.screen_fuzzy_best(inputs, names, pairs=pairs),
    }
    for name, df in marts.items():
        replace_table(df, f"{warehouse}/gold/{name}")
    stored = {name: spark.read.parquet(f"{warehouse}/gold/{name}") for name in marts}
    stored["sanctions_screening_results_demo"] = screening.demo_results(stored["sanctions_fuzzy_matches_best"])
    return stored
