"""The id manifest as a stream: it grows as list files land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.sources.store import KeyedStore

ITEMS = "id string, search_profile string, expected_risk_category string, load_dt string"
MANIFEST = "vacancy_id string, dt date, load_type string, search_profile string, expected_risk_category string, load_dt string, first_at string"
KEYS = ["vacancy_id", "dt", "load_type"]


def manifest_store(spark: SparkSession, path: str, buckets: int | None = None) -> KeyedStore:
    return KeyedStore(spark, path, MANIFEST, KEYS, buckets)


def stream_manifest(spark: SparkSession, source: str, store: KeyedStore, checkpoint: str, files_per_trigger: int = 1000) -> None:
    """Take in all list files that have arrived under ``load_type=/dt=`` since the last run, then stop.

    The store is the state: per id and day the first row by file time, path and place in the file, and that place
    (``first_at``). The first row does not depend on how files fall into batches, so that a replay, or a file that is
    read later than a newer one, gives the same manifest. A batch brings one row per key to the store, which
    rewrites the buckets of these keys only.
    """
    items = (
        spark.readStream.schema(f"{ITEMS}, load_type string, dt date")
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("mode", "DROPMALFORMED")
        .json(source)
        .select("*", F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start").alias("part"))
    )
    number = lambda column, digits: F.lpad(column.cast("string"), digits, "0")

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        # rows of one file part are numbered in their order; across parts the time and the path decide
        place = [number(F.unix_micros("part.file_modification_time"), 20), "part.file_path", number(F.col("part.file_block_start"), 20), number(F.monotonically_increasing_id(), 20)]
        rows = batch.filter("id <> ''").select(
            F.col("id").alias("vacancy_id"),
            "dt",
            "load_type",
            "search_profile",
            "expected_risk_category",
            F.coalesce("load_dt", F.col("dt").cast("string")).alias("load_dt"),
            F.concat_ws("|", *place).alias("first_at"),
        )
        earlier = F.col("new.first_at") < F.col("old.first_at")
        keep_first = {name: F.when(earlier, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")) for name in ("search_profile", "expected_risk_category", "load_dt", "first_at")}
        store.upsert(rows, [F.col("first_at")], keep_first)

    query = items.writeStream.foreachBatch(store_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
