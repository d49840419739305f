"""JSON-lines and JSON-report readers with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetline.session import materialize

CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """Rows of a (partitioned) JSON-lines folder; blank lines are skipped, a bad line fails.

    ``mode`` is Spark's: with DROPMALFORMED bad lines, which a quarantine holds, are left out.

    Declare JSON-valued fields as ``string`` to get them as raw JSON text.
    """
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_report(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One row per file that holds a single JSON object over several lines."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def _as_text(field: T.StructField) -> T.StructField:
    """Scalars are read as they stand, quoted or not; nested types as declared."""
    nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
    return field if nested else T.StructField(field.name, T.StringType())


def read_jsonl_quarantine(spark: SparkSession, path: str, schema: str, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad lines as ``(file_path, line_no, line, reason)``.

    A line is bad if it does not parse, or if one of ``keys`` is missing in it or no value of its type.
    Other values that do not fit their type become NULL; a quoted number is a number. The lines are
    parsed once and stored; good rows and bad lines are both read from there.

    Lines are counted per input split, in parallel; the splits' counts (one row per split) are
    summed up along each file to number the bad lines the way an editor would.
    """
    declared = spark.createDataFrame([], schema).schema
    texts = T.StructType([*map(_as_text, declared.fields), T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    partition_columns = [c for c in lines.columns if c not in ("value", "_file", "_start", "_row")]
    parsed = lines.withColumn("_json", F.when(F.trim("value") != "", F.from_json("value", texts, options)))
    parsed = materialize(parsed, "lines")

    fields = {
        f.name: F.col(f"_json.{f.name}") if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f"_json.{f.name}").try_cast(f.dataType)
        for f in declared.fields
    }
    unkeyed = F.lit(False)
    for key in keys:
        unkeyed = unkeyed | fields[key].isNull()
    reason = F.when(F.col(f"_json.{CORRUPT}").isNotNull(), "not JSON").when(unkeyed, "no key")
    read = parsed.filter(F.col("_json").isNotNull()).withColumn("_reason", reason)
    good = read.filter(F.col("_reason").isNull()).select(*[value.alias(name) for name, value in fields.items()], *partition_columns)

    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        parsed.groupBy("_file", "_start")
        .agg(F.min("_row").alias("_first"), F.count("*").alias("_lines"))
        .withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
    )
    bad = (
        read.filter(F.col("_reason").isNotNull())
        .join(splits, ["_file", "_start"])
        .select(
            F.col("_file").alias("file_path"),
            (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias("line_no"),
            F.col("value").alias("line"),
            F.col("_reason").alias("reason"),
        )
    )
    return good, bad
