from vetline.operators.batches import assign_batches, enrich_from_manifest
from vetline.operators.coverage import (
    batch_status_counts,
    batch_statuses,
    bitmap_coverage,
    coverage_report,
    distinct_ids,
    failure_counts,
    id_bitmaps,
    merge_bitmaps,
    missing_ids,
    profile_counts,
    sample_missing_ids,
)
from vetline.operators.dedup import concat_keep_first, keep_first, latest_per_key, top_k
from vetline.operators.incremental import files_since, partitions_to_reload, rows_since_max, single_date
from vetline.operators.merge import Rule, insert_ignore, merge_rows, new_rows_only
from vetline.operators.quality import check_constraints, duplicate_keys, null_counts
from vetline.operators.shape import concat_batches, existing_columns, explode_json_array, stamp_lineage
from vetline.operators.similarity import similarity_join

__all__ = [
    "Rule",
    "assign_batches",
    "batch_status_counts",
    "bitmap_coverage",
    "check_constraints",
    "concat_batches",
    "concat_keep_first",
    "coverage_report",
    "batch_statuses",
    "distinct_ids",
    "duplicate_keys",
    "enrich_from_manifest",
    "id_bitmaps",
    "merge_bitmaps",
    "existing_columns",
    "explode_json_array",
    "failure_counts",
    "files_since",
    "insert_ignore",
    "keep_first",
    "latest_per_key",
    "merge_rows",
    "missing_ids",
    "new_rows_only",
    "null_counts",
    "partitions_to_reload",
    "profile_counts",
    "rows_since_max",
    "sample_missing_ids",
    "similarity_join",
    "single_date",
    "stamp_lineage",
    "top_k",
]
