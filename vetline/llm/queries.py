"""The queries of this package by name; ORACLES holds DuckDB SQL where it can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.llm import bpe, conversations, lines, merkle, minhash, permutation, pii, ppm, quality, rules, suffixes, tiling, warc
from vetline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers  # its place is known where the vocabularies are installed only

    return public_tokenizers.path(name)


@query
def op9_bpe_chunk_reuse(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), vocabulary())


@query
def op10_minhash_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), percent=85).drop("mark")


ORACLES["op10_minhash_bayes"] = r"""
WITH RECURSIVE own AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS t
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) >= 5 THEN list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' '))
                                      WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END) AS g
  FROM own
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)
), reached(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), least_reached AS (
  SELECT x, min(y) AS y FROM reached GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id, least(doc_id, coalesce(y, doc_id)) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached ON x = doc_id
"""


@query
def op8_suffix_two_stage(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"))


@query
def op7_ppm(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.score(table(spark, folder, "documents"))


@query
def op3_quality_empirical_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("mark")


@query
def op4_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    return lines.remove_spread_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "text")


ORACLES["op4_line_spread"] = lines.ORACLE


@query
def op5_greedy_tiling(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("mark")


@query
def op6_warc_shards(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives).drop("url")


ORACLES["op6_warc_shards"] = """
WITH bodies AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), bits AS (
  SELECT *, max(page_id) OVER (PARTITION BY sha) AS response,
         list_aggregate(list_transform(string_split(sha, ''),
             lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', (instr('0123456789abcdef', c) - 1) * 4 + 1, 4)),
             'string_agg', '') AS b
  FROM bodies
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32),
           lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * cast(substr(b, 5 * i + 1, 1) AS int) + 8 * cast(substr(b, 5 * i + 2, 1) AS int)
               + 4 * cast(substr(b, 5 * i + 3, 1) AS int) + 2 * cast(substr(b, 5 * i + 4, 1) AS int) + cast(substr(b, 5 * i + 5, 1) AS int), 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < response THEN response END AS refers_to
FROM bits
"""


@query
def op1_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    return permutation.nearest(table(spark, folder, "embeddings"))


@query
def op2_pii_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


@query
def op12_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.judge(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


@query
def op13_merkle_windows(spark: SparkSession, folder: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(table(spark, folder, "documents"), changed={"text": lower}, changed_where=fifth).drop("source", "path")


ORACLES["op13_merkle_windows"] = merkle.ORACLE


@query
def op11_conversation_dawg(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return conversations.repair(conversations.damage(rows), ids=rows)
