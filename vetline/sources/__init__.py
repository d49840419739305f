from vetline.sources.jsonl import read_jsonl, read_jsonl_quarantine, read_report
from vetline.sources.listing import file_listing
from vetline.sources.payloads import latest_payload, raw_payloads, register_payloads
from vetline.sources.sinks import (
    append_new_csv,
    overwrite_csv,
    read_csv_history,
    replace_table,
    write_jsonl_partitions,
    write_parquet_daily,
)
from vetline.sources.store import KeyedStore
from vetline.sources.tables import Tables
from vetline.sources.xml import ENTITY_SCHEMA, INDIVIDUAL_SCHEMA, read_entities, read_individuals

__all__ = [
    "ENTITY_SCHEMA",
    "INDIVIDUAL_SCHEMA",
    "KeyedStore",
    "Tables",
    "append_new_csv",
    "file_listing",
    "latest_payload",
    "overwrite_csv",
    "raw_payloads",
    "read_csv_history",
    "read_entities",
    "read_individuals",
    "read_jsonl",
    "read_jsonl_quarantine",
    "read_report",
    "register_payloads",
    "replace_table",
    "write_jsonl_partitions",
    "write_parquet_daily",
]
