"""Session construction and the shared folders jobs may write to."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the work a hand-written plan would otherwise guess at: it coalesces
# small shuffle partitions, splits skewed ones and turns joins into broadcasts once the real
# size of a side is known.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "vetline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="vetline-")


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    A folder set on the context serves as well. Where there is neither, a local session (one process,
    as in tests) gets a temporary folder; on a cluster every machine would write to its own disk, so
    that is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_root()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root; every call gives another one."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    For rows that several branches of one plan use: they are computed once, the lineage ends there
    (a lost executor costs no recomputation), and the planner knows their real size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
