"""Expected-versus-loaded reports and failure counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.functions.status import coverage_severity

SAMPLE_SIZE = 5


def _id_flags(manifest: DataFrame, details: DataFrame, expected_id: str, loaded_id: str) -> DataFrame:
    """One row per id with where it was seen; repeated ids collapse on the map side."""

    def tagged(df: DataFrame, column: str, expected: bool) -> DataFrame:
        key = F.col(column).cast("string")
        return df.filter(key != "").select(
            key.alias("id"), F.lit(expected).alias("expected"), F.lit(not expected).alias("loaded")
        )

    return (
        tagged(manifest, expected_id, True)
        .unionByName(tagged(details, loaded_id, False))
        .groupBy("id")
        .agg(F.bool_or("expected").alias("expected"), F.bool_or("loaded").alias("loaded"))
    )


def missing_ids(
    manifest: DataFrame, details: DataFrame, expected_id: str = "vacancy_id", loaded_id: str = "id"
) -> DataFrame:
    """Expected ids that were not loaded, each once."""
    return (
        _id_flags(manifest, details, expected_id, loaded_id)
        .filter(F.col("expected") & ~F.col("loaded"))
        .select(F.col("id").alias("vacancy_id"))
    )


def sample_missing_ids(missing: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """The first ids in string order (a top-k, never a full sort)."""
    return missing.orderBy("vacancy_id").limit(size)


def failure_counts(failures: DataFrame, column: str) -> DataFrame:
    """Rows per value of the column; a missing value counts as ``unknown``."""
    return failures.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias(column)).agg(
        F.count("*").alias("n")
    )


def profile_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("search_profile").agg(F.count("*").alias("n"))


def batch_status_counts(responses: DataFrame) -> DataFrame:
    """Ok, failed and exception counts per batch and over all batches (``batch_idx`` NULL).

    A response without a status is a failure, so that ok and failed add up to all.
    """
    ok = F.col("http_status").eqNullSafe("200")
    return (
        responses.rollup("batch_idx")
        .agg(
            F.count_if(ok).alias("ok"),
            F.count_if(~ok).alias("failed"),
            F.count_if(F.col("http_status") == "exception").alias("exceptions"),
            F.grouping("batch_idx").cast("int").alias("is_total"),
        )
    )


def batch_statuses(responses: DataFrame) -> DataFrame:
    """Responses per batch and status; a missing status counts as ``unknown``."""
    status = F.coalesce("http_status", F.lit("unknown")).alias("http_status")
    return responses.groupBy("batch_idx", status).agg(F.count("*").alias("n"))


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """Every id once, as text; missing and empty ones are none."""
    ids = df.select(F.col(column).cast("string").alias("id"))
    return ids.filter("id IS NOT NULL AND id <> ''").distinct()


def _count_map(failures: DataFrame, column: str) -> DataFrame:
    counts = failure_counts(failures, column)
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))))


def coverage_report(
    manifest: DataFrame,
    details: DataFrame,
    failures: DataFrame,
    *,
    ds: str | Column,
    load_type: str | Column,
    found_files: int | Column = 0,
    failures_files: int | Column = 0,
    manifest_present: bool = True,
    expected_id: str = "vacancy_id",
    loaded_id: str = "id",
) -> DataFrame:
    """The one-row report: counts, percentage, severity, sample of missing ids, failure maps.

    The sample and the two maps are one-row aggregates, put beside the counts as scalar subqueries.
    Ids loaded without being expected still count as loaded, so the percentage may pass 100.
    """

    def constant(value: object) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    flags = _id_flags(manifest, details, expected_id, loaded_id)
    missing = F.col("expected") & ~F.col("loaded")
    counts = flags.agg(
        F.count_if("expected").alias("expected_count"),
        F.count_if("loaded").alias("loaded_count"),
        F.count_if(missing).alias("missing_count"),
    )
    sample = sample_missing_ids(flags.filter(missing).select(F.col("id").alias("vacancy_id"))).agg(
        F.array_sort(F.collect_list("vacancy_id"))
    )
    pct = F.when(F.col("expected_count") == 0, F.lit(0.0)).otherwise(
        F.col("loaded_count") / F.col("expected_count") * 100
    )
    empty_reason = "EMPTY_MANIFEST" if manifest_present else "NO_MANIFEST"
    return (
        counts.withColumns(
            {
                "coverage_pct": pct,
                "sample_missing_ids": sample.scalar(),
                "failures_by_reason": _count_map(failures, "reason").scalar(),
                "failures_by_status": _count_map(failures, "http_status").scalar(),
            }
        )
        .select(
            constant(ds).alias("ds"),
            constant(load_type).alias("load_type"),
            "expected_count",
            "loaded_count",
            "missing_count",
            "coverage_pct",
            F.when(F.col("expected_count") == 0, empty_reason).otherwise("OK").alias("coverage_reason"),
            coverage_severity(F.col("expected_count"), F.col("missing_count"), F.col("coverage_pct")).alias(
                "severity"
            ),
            constant(found_files).cast("int").alias("found_files"),
            "sample_missing_ids",
            constant(failures_files).cast("int").alias("failures_files"),
            "failures_by_reason",
            "failures_by_status",
        )
    )


def id_bitmaps(df: DataFrame, id_column: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, bucket, ids)``: the whole-number ids as bitmaps, a row per 32768 ids in reach.

    Bitmaps of days or batches merge by :func:`merge_bitmaps` without another look at the ids.
    """
    number = F.col(id_column).try_cast("bigint")
    numbered = df.filter(number.isNotNull())
    return numbered.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("ids")
    )


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def bitmap_coverage(expected: DataFrame, loaded: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, expected_count, loaded_count, missing_count)`` from the bitmaps of both sides.

    Missing are the ids of either side less those that were loaded.
    """
    nothing = F.lit(None).cast("binary")
    both = expected.select(*keys, "bucket", F.col("ids").alias("wanted"), nothing.alias("held"), "ids").unionByName(
        loaded.select(*keys, "bucket", nothing.alias("wanted"), F.col("ids").alias("held"), "ids")
    )
    merged = both.groupBy(*keys, "bucket").agg(*[F.bitmap_or_agg(name).alias(name) for name in ("wanted", "held", "ids")])
    count = {name: F.bitmap_count(name) for name in ("wanted", "held", "ids")}
    return merged.groupBy(*keys).agg(
        F.sum(count["wanted"]).alias("expected_count"),
        F.sum(count["held"]).alias("loaded_count"),
        F.sum(count["ids"] - count["held"]).alias("missing_count"),
    )
