"""Merkle manifest of a dataset, with fixed-offset window functions.

Each row is a leaf: the SHA-256 (lower-case hex) of its fields, each as `-` where it is null, else as its size in
UTF-8 bytes, `:` and its value. Within a group (source) leaves ascend by id, nulls first, then by leaf; every FANOUT
consecutive nodes are a run and become one node, the hash of their digests one behind the other, until one is left:
the group's subroot. Subroots, ordered by group (null first, bytewise), become the root in the same way.

Per level one window looks FANOUT - 1 rows back and ahead. What lies before the run (slot) or behind it (run
length) is masked; the rest are a node's siblings, and the first node of a run hashes its parent. The windows cover
spans of whole runs, so that the largest group is spread over as many tasks as it has spans. Places within a group
come from a range-partitioned sort and the row counts of its parts: no group is sorted in one task.

Going down again, each node takes the siblings on its parent's way to the root; a leaf's proof and the root folded
from a (changed) leaf follow from these. Texts are hashed where they are read and never shuffled, whatever their size.

Null fields, null ids and null groups are kept (a null group is one group); rows may repeat, each is a leaf. Of rows
with equal ids that with the smaller leaf comes first; rows that are equal in all fields take their places in any
order, which leaves the result as a whole the same. Extra columns are not read. An empty table has no root and no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetline.session import materialize

FANOUT = 16
SPAN = 256  # nodes a window covers: a multiple of FANOUT
_PLACE_BITS = 33  # monotonically_increasing_id keeps the partition above the row's 33 bits


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one behind the other."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def field(column: Column) -> Column:
    """A value as its size and itself, `-` for null."""
    held = column.cast("string")
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(held).cast("string"), F.lit(":"), held))


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with their place in their group (pos, from 0) and its size (n).

    Rows are range-partitioned by group and order and written; a place is that in the part of the group within the
    partition, plus the rows of the group's earlier parts.
    """
    # equal rows would stay together in one range: a number of their own spreads them
    numbered = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_tie")]
    ranged = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    held = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "placed").withColumn("_part", F.shiftright("_at", _PLACE_BITS))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        held.groupBy(group, "_part")
        .agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("n", F.sum("_rows").over(Window.partitionBy(group)))
        .withColumnsRenamed({group: "_group", "_part": "_of"})
        .drop("_rows")
    )
    joined = held.join(parts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
    return materialize(joined.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_group", "_of", "_at", "_part", "_first", "_before"), "nodes")


def with_siblings(nodes: DataFrame, group: str, fanout: int, span: int) -> DataFrame:
    """The nodes of groups with more than one, with the digests of the run before (left) and after (right) each."""
    slot = F.col("pos") % fanout
    length = F.least(F.lit(fanout), F.col("n") - (F.col("pos") - slot))
    near = Window.partitionBy(group, "_span").orderBy("pos")
    back = [F.when(slot >= k, F.lag("digest", k).over(near)).otherwise("") for k in range(fanout - 1, 0, -1)]
    ahead = [F.when(slot + k < length, F.lead("digest", k).over(near)).otherwise("") for k in range(1, fanout)]
    spans = nodes.filter("n > 1").withColumn("_span", F.floor(F.col("pos") / span))
    return spans.withColumn("left", F.concat(*back)).withColumn("right", F.concat(*ahead)).drop("_span")


def parents(runs: DataFrame, group: str, fanout: int) -> DataFrame:
    """The next level: the first node of each run hashes all of it."""
    first = runs.filter(F.col("pos") % fanout == 0)
    return first.select(group, F.floor(F.col("pos") / fanout).alias("pos"), F.ceil(F.col("n") / fanout).alias("n"), digest(F.col("digest"), F.col("right")).alias("digest"))


def _levels(nodes: DataFrame, group: str, fanout: int, span: int) -> list[DataFrame]:
    """All levels of nodes (group, pos, n, digest), the given one first; each is written."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = [nodes]
    while most > 1:
        levels.append(materialize(parents(with_siblings(levels[-1], group, fanout, span), group, fanout), "level"))
        most = math.ceil(most / fanout)
    return levels


def _ways(levels: list[DataFrame], tops: DataFrame, group: str, fanout: int, span: int, own: list[str]) -> DataFrame:
    """For the nodes of the first level: path, an array of (left, right) up to the root, and what `tops` adds.

    tops: group, path and other columns for the node that is left of each group. A node that is alone in its group
    is that node; any other joins its parent's way, level by level from above.
    """
    added = [c for c in tops.columns if c not in (group, "path")]
    above: DataFrame | None = None
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        kept = ["pos", *(own if depth == 0 else [])]
        alone = level.filter("n = 1").join(tops.withColumnRenamed(group, "_group"), F.col(group).eqNullSafe(F.col("_group"))).select(group, *kept, "path", *added)
        if above is not None:
            up = above.select(F.col(group).alias("_group"), F.col("pos").alias("_up"), F.col("path").alias("_path"), *added)
            runs = with_siblings(level, group, fanout, span).withColumn("_run", F.floor(F.col("pos") / fanout))
            step = F.array(F.struct("left", "right"))
            alone = alone.unionByName(
                runs.join(up, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_run") == F.col("_up"))).select(group, *kept, F.concat(step, "_path").alias("path"), *added)
            )
        # the level of leaves is the result and is not written here
        above = materialize(alone, "ways") if depth else alone
    return above


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    doc_id: str = "doc_id",
    group: str = "source",
    changed: dict[str, Column] | None = None,
    changed_where: Column | None = None,
    fanout: int = FANOUT,
    span: int = SPAN,
) -> DataFrame:
    """One row per document: doc_id, source, leaf, subroot, root, path, proof_sha256, folded_root, verified.

    path holds, level by level from the leaf to the root, the digests of the run before and after the node. `changed`
    and `changed_where` stand for a later state of the rows: where the condition holds, the leaf that is folded up the
    original path is that of the row with these columns in place of its own.
    """
    leaf = digest(*[field(F.col(c)) for c in fields])
    later = digest(*[field((changed or {}).get(c, F.col(c))) for c in fields])
    altered = F.coalesce(changed_where, F.lit(False)) if changed_where is not None else F.lit(False)
    leaves = docs.select(F.col(doc_id).alias("doc_id"), F.col(group).cast("string").alias("group"), leaf.alias("digest"), F.when(altered, later).alias("later"))
    levels = _levels(placed(leaves, "group", ["doc_id", "digest"]), "group", fanout, span)
    subroots = materialize(_union([level.filter("n = 1").select("group", "digest") for level in levels]), "subroots")
    tops = _levels(placed(subroots.select(F.lit(0).alias("all"), "group", "digest"), "all", ["group"]), "all", fanout, span)
    root = _union([level.filter("n = 1").select("all", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("digest").alias("root")) for level in tops])
    ways = _ways(tops, root, "all", fanout, span, ["group", "digest"]).select("group", "path", F.col("digest").alias("subroot"), "root")
    own = _ways(levels, materialize(ways, "subroot_ways"), "group", fanout, span, ["doc_id", "digest", "later"])
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    folded = F.aggregate("path", F.coalesce("later", "digest"), lambda node, p: digest(p["left"], node, p["right"]))
    return own.select(
        "doc_id",
        F.col("group").alias("source"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        digest(siblings).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


#: DuckDB SQL for the manifest of `documents`, a fifth of them tampered with
ORACLE = f"""
WITH RECURSIVE bits(i, v, k) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8
), fields AS (
  SELECT doc_id, source, concat(
           coalesce(strlen(doc_id::varchar)::varchar || ':' || doc_id::varchar, '-'), coalesce(strlen(source)::varchar || ':' || source, '-'),
           coalesce(strlen(lang)::varchar || ':' || lang, '-'), coalesce(strlen(n_chars::varchar)::varchar || ':' || n_chars::varchar, '-')) AS head,
         text, coalesce(xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint),
                                        lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % 5 = 0, false) AS tampered
  FROM documents, crc_table
), leaves AS (
  SELECT row_number() OVER () AS row_no, doc_id, source, tampered,
         sha256(head || coalesce(strlen(text)::varchar || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(text)::varchar || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS later
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row_no) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves
), nodes(depth, source, pos, n, digest) AS (
  SELECT 0, source, pos, n, leaf FROM placed
  UNION ALL
  SELECT depth + 1, source, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY depth, source, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}
), subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops(depth, pos, n, digest) AS (
  SELECT 100, pos, n, subroot FROM subroots
  UNION ALL
  SELECT depth + 1, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY depth, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}
), root AS (
  SELECT digest AS root FROM tops WHERE n = 1
), steps AS (
  SELECT a.depth, a.source, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.depth = b.depth AND a.source IS NOT DISTINCT FROM b.source AND a.pos // {FANOUT} = b.pos // {FANOUT}
  WHERE a.n > 1 GROUP BY ALL
), top_steps AS (
  SELECT a.depth, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM tops a JOIN tops b ON a.depth = b.depth AND a.pos // {FANOUT} = b.pos // {FANOUT}
  WHERE a.n > 1 GROUP BY ALL
), ways AS (
  SELECT p.row_no, s.depth, s.l, s.r FROM placed p JOIN steps s ON p.source IS NOT DISTINCT FROM s.source AND s.pos = p.pos // cast(power({FANOUT}, s.depth) AS bigint)
  UNION ALL
  SELECT p.row_no, s.depth, s.l, s.r FROM placed p JOIN subroots u ON p.source IS NOT DISTINCT FROM u.source
  JOIN top_steps s ON s.pos = u.pos // cast(power({FANOUT}, s.depth - 100) AS bigint)
), paths AS (
  SELECT row_no, sha256(string_agg(l || r, '' ORDER BY depth)) AS proof, list({{'l': l, 'r': r}} ORDER BY depth) AS way FROM ways GROUP BY row_no
), folds(row_no, digest, way) AS (
  SELECT row_no, CASE WHEN tampered THEN later ELSE leaf END, coalesce(way, []) FROM placed LEFT JOIN paths USING (row_no)
  UNION ALL
  SELECT row_no, sha256(way[1].l || digest || way[1].r), way[2:] FROM folds WHERE len(way) > 0
), folded AS (
  SELECT row_no, digest AS folded_root FROM folds WHERE len(way) = 0
)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN folded USING (row_no) JOIN subroots u ON placed.source IS NOT DISTINCT FROM u.source LEFT JOIN paths USING (row_no), root
"""
