"""Small decision tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify_http_reason(status: Column) -> Column:
    return (
        F.when(status == 404, "not_found")
        .when(status == 429, "rate_limited")
        .when(status.between(500, 599), "server_error")
        .when(status == 403, "forbidden")
        .otherwise("http_error")
    )


def coverage_severity(expected: Column, missing: Column, pct: Column) -> Column:
    """CRITICAL without a manifest; OK when nothing is missing; WARNING for small gaps."""
    return (
        F.when(expected == 0, "CRITICAL")
        .when(missing == 0, "OK")
        .when((missing <= 5) | (pct >= 99), "WARNING")
        .otherwise("CRITICAL")
    )


def screening_verdict(left: Column, right: Column, score: Column) -> Column:
    return (
        F.when(left == right, "MATCH")
        .when(score >= 0.70, "POSSIBLE_MATCH")
        .otherwise("NO_MATCH")
    )
