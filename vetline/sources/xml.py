"""Consolidated sanctions list in XML: elements at any depth as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INDIVIDUAL_SCHEMA = """
    DATAID string, VERSIONNUM string,
    FIRST_NAME string, SECOND_NAME string, THIRD_NAME string, FOURTH_NAME string,
    REFERENCE_NUMBER string, LISTED_ON string, GENDER string, COMMENTS1 string,
    NATIONALITY array<struct<VALUE: string>>,
    INDIVIDUAL_ALIAS array<struct<ALIAS_NAME: string>>,
    INDIVIDUAL_DOCUMENT array<struct<TYPE_OF_DOCUMENT: string, NUMBER: string>>
"""
ENTITY_SCHEMA = """
    DATAID string, VERSIONNUM string, FIRST_NAME string,
    REFERENCE_NUMBER string, LISTED_ON string, COMMENTS1 string,
    ENTITY_ALIAS array<struct<ALIAS_NAME: string>>
"""


def _read(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("mode", "FAILFAST")
        .schema(schema)
        .load(path)
    )


def read_individuals(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "INDIVIDUAL", INDIVIDUAL_SCHEMA)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "ENTITY", ENTITY_SCHEMA)
