"""Registry of raw payloads, unique by content hash."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.operators.merge import new_rows_only


def raw_payloads(spark: SparkSession, path: str, source: str, source_url: str | None = None, load_dt: str | None = None) -> DataFrame:
    """One row per file with its text, hash, size, load time and what is known of its download as JSON.

    load_dt: a timestamp for all of them; by default the time of the job's statement.
    """
    loaded = F.current_timestamp() if load_dt is None else F.lit(load_dt).cast("timestamp")
    hashed = with_payload_hash(
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.lit(source).alias("source"),
            F.col("path").alias("object_key"),
            F.col("content").cast("string").alias("payload"),
            F.col("modificationTime").alias("inserted_at"),
        )
    )
    return hashed.withColumns({"load_dt": loaded, "metadata": payload_metadata(source_url)})


def write_payload_files(payloads: DataFrame, path: str) -> None:
    """One file per row of ``(object_key, payload)`` in one folder; keys are file names and must differ.

    Each task writes its files at their final places: a partitioned write of Spark has a committer move every folder
    and, on a local disk without Hadoop's native library, starts several processes for the rights of each file.
    A task that runs again writes the same files. The path may be any that pyarrow opens by its URI.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for key, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_output_stream(f"{root}/{key}", compression=None) as out:
                    out.write(payload)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["files"])

    store, root = fs.FileSystem.from_uri(path)
    store.create_dir(root, recursive=True)
    rows = payloads.select("object_key", F.coalesce(F.col("payload"), F.lit("")).cast("binary"))
    rows.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()


def payload_metadata(source_url: str | None = None) -> Column:
    """The JSON kept with a payload: where it is from, when it was stored, its hash and size."""
    known = F.struct(
        F.lit(source_url).cast("string").alias("source_url"),
        F.date_format(F.to_utc_timestamp("inserted_at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss").alias("downloaded_at_utc"),
        "sha256",
        "content_length",
    )
    return F.to_json(known, {"ignoreNullFields": "false"})


def with_payload_hash(payloads: DataFrame) -> DataFrame:
    return payloads.withColumns(
        {
            "sha256": F.sha2(F.col("payload").cast("binary"), 256),
            "content_length": F.octet_length("payload").cast("bigint"),
        }
    )


def register_payloads(registered: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming payloads whose content is not registered yet, one row per content."""
    return new_rows_only(registered, incoming, ["sha256"], [F.col("object_key").asc_nulls_last()])


def latest_payload(registered: DataFrame) -> DataFrame:
    """The newest payload; the query fails where none is registered.

    A running maximum per task, so no sort and one row per task in the shuffle.
    """
    row = F.struct(*registered.columns)
    newest = registered.agg(F.max_by(row, F.struct("inserted_at", "sha256")).alias("row"))
    checked = F.when(F.col("row").isNull(), F.raise_error(F.lit("no payload is registered"))).otherwise(F.col("row"))
    return newest.select(checked.alias("row")).select("row.*")
