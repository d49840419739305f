"""A Parquet table with a primary key that can be upserted in place.

Rows lie in buckets, a hash of the key. An upsert reads the buckets that its updates fall into and writes
them anew into a folder of its own; then a small file with the next number names the folder of every bucket.
Readers take the file with the highest number, so they see the rows before or after an upsert, never a part,
and a failure before that file is in place leaves the old rows as they were. Folders of the generation before
stay for readers that are under way; older ones are deleted. Upserting one batch twice gives the same
table, which makes a replay after a failure harmless.

The number of buckets and the key are stored with the table; a caller who names others is refused. So are rows
with a null in their key, which could not be told apart on a replay. Two upserts at a time are refused too: the
second one's file is there already. On a file system without an atomic rename the test for that file and the rename leave a
gap, so two writers need a lock outside. A reader that is older than two upserts may find its folders deleted.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.operators.dedup import latest_per_key
from vetline.operators.merge import Rule, merge_rows, new_rows_only
from vetline.session import materialize

BUCKET = "key_bucket"
FILE_ROWS = 2_000_000


class KeyedStore:
    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int | None = None):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        stored = self._state()
        if stored and (stored["keys"] != self.keys or buckets not in (None, stored["buckets"])):
            raise ValueError(f"{path} is stored with {stored['buckets']} buckets of {stored['keys']}")
        self.buckets = stored["buckets"] if stored else buckets or 256

    # -- the numbered files that name the folders

    def _hadoop(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _numbers(self) -> list[int]:
        system, folder = self._hadoop(f"{self.path}/_state")
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted(int(m[1]) for name in names if (m := re.fullmatch(r"(\d+)\.json", name)))

    def _load(self, number: int) -> dict:
        rows = self.spark.read.text(f"{self.path}/_state/{number:012d}.json").collect()
        return json.loads("".join(r[0] for r in rows))

    def _state(self) -> dict | None:
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else None

    def _switch(self, folders: dict[str, str]) -> None:
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 0
        system, temporary = self._hadoop(f"{self.path}/_state/.{uuid.uuid4().hex}")
        out = system.create(temporary)
        out.writeBytes(json.dumps({"buckets": self.buckets, "keys": self.keys, "folders": folders}))
        out.close()
        final = self._hadoop(f"{self.path}/_state/{number:012d}.json")[1]
        if system.exists(final) or not system.rename(temporary, final):
            raise RuntimeError(f"{self.path} was changed by another upsert")
        self._forget(number, folders)

    def _forget(self, number: int, folders: dict[str, str]) -> None:
        """Delete what neither this state nor the one before names."""
        older = [n for n in self._numbers() if n < number - 1]
        if not older:
            return
        kept = {*folders.values(), *self._load(number - 1)["folders"].values()}
        for n in older:
            for folder in {*self._load(n)["folders"].values()} - kept:
                system, path = self._hadoop(f"{self.path}/{folder}")
                system.delete(path, True)
            system, path = self._hadoop(f"{self.path}/_state/{n:012d}.json")
            system.delete(path, False)

    # -- rows

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        empty = self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(empty.schema).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else empty

    def read(self) -> DataFrame:
        state = self._state()
        return self._rows(sorted(state["folders"].values()) if state else [])

    def _rewrite(self, updates: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        # computed once: the bucket list and every branch of the merge read the stored rows
        updates = materialize(self._bucketed(updates), "updates")
        missing = F.greatest(*[F.col(k).isNull() for k in self.keys], F.lit(False))
        # at most `buckets` rows
        touched = updates.groupBy(BUCKET).agg(F.max(missing).alias("missing")).collect()
        if any(row["missing"] for row in touched):
            raise ValueError(f"updates of {self.path} hold a null in {self.keys}")
        if not touched:
            return
        state = self._state() or {"folders": {}}
        folders = dict(state["folders"])
        target = self._rows([folders[str(row[BUCKET])] for row in touched if str(row[BUCKET]) in folders])
        merged = self._bucketed(merge(target, updates.drop(BUCKET)).select(*target.columns))
        generation = f"rows-{uuid.uuid4().hex}"
        # a bucket is one file, or more where it is large; no task writes into all buckets
        (
            merged.repartition(BUCKET)
            .write.option("maxRecordsPerFile", FILE_ROWS)
            .partitionBy(BUCKET)
            .parquet(f"{self.path}/{generation}")
        )
        written = {str(row[BUCKET]): f"{generation}/{BUCKET}={row[BUCKET]}" for row in touched}
        self._switch({**folders, **written})

    def upsert(
        self,
        updates: DataFrame,
        latest_by: Sequence[Column],
        rules: Mapping[str, Rule | Column] | None = None,
    ) -> None:
        latest = latest_per_key(updates, self.keys, latest_by)
        self._rewrite(latest, lambda old, new: merge_rows(old, new, self.keys, rules, stored=True))

    def insert_ignore(self, updates: DataFrame, first_by: Sequence[Column]) -> None:
        first = latest_per_key(updates, self.keys, first_by)
        self._rewrite(first, lambda old, new: old.unionByName(new_rows_only(old, new, self.keys).select(*old.columns)))
