"""The training-data pipeline: every stage works on all that the stage before it kept.

Rows with a null id or a repeated id are documents like others: the stages tell rows apart by id and text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.llm import bpe, lines, minhash, quality, tiling
from vetline.llm.queries import table, vocabulary

_ID, _MARK = "__row_id", "__row_mark"


def _without(docs: DataFrame, rows: DataFrame, repeats: bool = True) -> DataFrame:
    """The documents whose id and text are not among `rows` (doc_id, mark); without `repeats` equal rows once."""
    marked = docs.withColumns({_ID: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), _MARK: F.xxhash64("text")})
    gone = rows.select(F.coalesce("doc_id", F.lit(-1)).alias(_ID), F.col("mark").alias(_MARK))
    kept = marked.join(gone, [_ID, _MARK], "left_anti")
    if not repeats:
        kept = kept.dropDuplicates([_ID, _MARK])
    return kept.drop(_ID, _MARK)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return _without(docs, quality.score(docs, table(spark, sf_dir, "labels")).filter("not kept"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites go; n_chars follows the text."""
    out = lines.remove_spread_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return _without(docs, minhash.near_duplicates(docs).filter("not kept"), repeats=False)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold most of a benchmark item go."""
    return _without(docs, tiling.contaminated(docs, table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    return bpe.encode(docs, vocabulary(), keep_ids=True).drop("decoded")


STAGES = [
    ("quality_classifier", classify_quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", decontaminate),
    ("bpe_encode", encode),
]

#: Classifier, signatures, tiles and token ids have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
