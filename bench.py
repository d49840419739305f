"""Time the headline queries: one JSON line with seconds per query (median of the repeats)."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vetline.catalog import QUERIES  # noqa: E402
from vetline.catalog.registry import TABLES  # noqa: E402
from vetline.session import build_session  # noqa: E402

HEADLINE = (
    "risk_signals",
    "risk_signals_long",
    "case_queue",
    "flatten_vacancy",
    "flatten_employer",
    "join_vacancy_text",
    "employers_first_last_seen",
    "latest_per_key",
    "topk_per_input",
    "keep_first_per_id",
    "lateral_explode",
    "distinct_skills",
    "coverage_report",
    "assign_batches",
    "upsert_latest",
    "upsert_bronze_validity",
    "upsert_employers_least_greatest",
    "insert_ignore",
    "mirror_incremental",
    "clean_html_staging",
    "strip_html_silver",
    "html_text_lines",
    "normalize_name",
    "profile_tagging",
    "screen_exact",
    "best_match_per_input",
    "screen_fuzzy_top3",
    "screen_fuzzy_best",
    "sanctions_flatten_entities",
    "scan_jsonl_quarantine",
    "dq_constraints",
    "dq_unique",
)


def stage(spark, folder: str, files: int) -> str:
    """Copy the tables into several files each, as a cluster stores them: one file is one scan task."""
    staged = tempfile.mkdtemp(prefix="vetline-bench-")
    for name in TABLES:
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        table.repartition(files).write.parquet(f"{staged}/{name}.parquet")
    return staged


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "vetline-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # small tables, many cores: split them finer than a cluster would
            "spark.sql.files.maxPartitionBytes": "4m",
            "spark.sql.files.openCostInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs = stage(spark, folder, int(cpus))
    # class loading and code generation belong to no query
    QUERIES["profile_counts"](spark, inputs).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, inputs).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "layout": f"{cpus} files per table",
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
