"""Removal of lines that stand on many sites, with DataFrame functions only.

Each line's spread is the number of distinct sites that hold it. HyperLogLog sketches of the sites, merged
per line by aggregation, estimate it. Lines estimated well above or below the limit are settled; lines near
it (within a factor `slack`, far wider than the sketch's error) get an exact distinct count.

Lines are compared without the blanks at their ends and told apart by a 128-bit hash. Blank lines are never
removed. A null site counts as no site. A null text stays null, an empty one empty; a text that loses all
lines becomes empty. Repeated rows and repeated or null ids give a row each. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.session import materialize

MIN_SITES = 10
SLACK = 2.0
_MARK, _GONE = "__line_mark", "__lines_gone"


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line)))


def remove_spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, slack: float = SLACK, text: str = "text", site: str = "source", lg_k: int = 12) -> DataFrame:
    """The documents with all their columns, without lines that stand on `min_sites` sites or more.

    Two columns are added: n_lines and n_removed (in place of columns of these names).
    """
    marked = docs.withColumn(_MARK, F.xxhash64(text))
    lines = materialize(
        marked.select(F.col(_MARK).alias("mark"), F.col(site).cast("string").alias("site"), F.explode(F.split(text, "\n", -1)).alias("line"))
        .filter(F.trim("line") != "")
        .select("mark", "site", line_key(F.col("line")).alias("line"))
        .distinct(),
        "lines",
    )
    spread = materialize(lines.filter("site is not null").groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites")).filter(F.col("sites") >= min_sites / slack), "spread")
    near = spread.filter(F.col("sites") < min_sites * slack).select("line")
    exact = lines.join(near, "line", "left_semi").groupBy("line").agg(F.count_distinct("site").alias("sites")).filter(F.col("sites") >= min_sites)
    wide = spread.filter(F.col("sites") >= min_sites * slack).select("line").union(exact.select("line"))
    # texts with equal marks hold equal lines
    gone = lines.join(wide, "line").groupBy("mark").agg(F.collect_set("line").alias(_GONE)).withColumnRenamed("mark", _MARK)
    held = marked.join(gone, _MARK, "left")
    parts = F.split(text, "\n", -1)
    dropped = lambda line: (F.trim(line) != "") & F.array_contains(F.col(_GONE), line_key(line))
    kept = F.when(F.col(_GONE).isNull(), F.col(text)).otherwise(F.array_join(F.filter(parts, lambda line: ~dropped(line)), "\n"))
    n_removed = F.when(F.col(_GONE).isNull(), F.lit(0)).otherwise(F.size(F.filter(parts, dropped)))
    new = {"n_lines": F.coalesce(F.size(parts), F.lit(0)).cast("long"), "n_removed": n_removed.cast("long"), text: kept}
    return held.withColumns(new).drop(_MARK, _GONE)


#: DuckDB SQL for doc_id, n_lines, n_removed and text of `documents`
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), spread AS (
  SELECT trim(line) AS key, count(DISTINCT source) AS sites FROM lines WHERE trim(line) <> '' GROUP BY 1
), rest AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE sites >= {MIN_SITES}) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE sites IS NULL OR sites < {MIN_SITES}), '') AS text
  FROM lines LEFT JOIN spread ON trim(line) = key GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, rest.text AS text
FROM documents LEFT JOIN rest USING (doc_id)
"""
