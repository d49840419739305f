"""Sources and sinks: data derived from the tables is written as files and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.catalog.registry import Data, query
from vetline.operators.dedup import latest_per_key
from vetline.plans import sanctions
from vetline.session import materialize, scratch_path
from vetline.sources import jsonl, listing, payloads, sinks, xml
from vetline.sources.store import KeyedStore
from vetline.sources.tables import Tables
from vetline.streaming.ingest import stream_upsert

LIST_SCHEMA = """id bigint, name string, area string, salary string, employer string, archived boolean,
    published_at string, load_type string, dt date"""
LIST_SQL = """SELECT id, name, area, salary, employer, archived, published_at, load_type, load_dt AS dt FROM {list_bronze}"""


def _list_rows(t: Data) -> DataFrame:
    """List records with whole months as load dates, to keep the number of folders moderate."""
    return t["list_bronze"].select(
        "id", "name", "area", "salary", "employer", "archived", "published_at", "load_type",
        F.trunc("load_dt", "month").alias("dt"),
    )


MONTH_SQL = LIST_SQL.replace("load_dt AS dt", "cast(date_trunc('month', load_dt) AS date) AS dt")


@query("scan_jsonl", MONTH_SQL)
def scan_jsonl(t: Data) -> DataFrame:
    path = scratch_path(t.spark, "jsonl")
    sinks.write_jsonl_partitions(_list_rows(t), path)
    return jsonl.read_jsonl(t.spark, path, LIST_SCHEMA)


@query("sink_jsonl_partitioned", MONTH_SQL)
def sink_jsonl_partitioned(t: Data) -> DataFrame:
    """A first load with another content, then the rerun that replaces its partitions."""
    path = scratch_path(t.spark, "jsonl-rerun")
    rows = _list_rows(t)
    sinks.write_jsonl_partitions(rows.withColumn("name", F.lit("first load")), path)
    sinks.write_jsonl_partitions(rows, path)
    return jsonl.read_jsonl(t.spark, path, LIST_SCHEMA)


def _dirty_lines(t: Data, path: str) -> None:
    """JSON lines with cut-off records (pending orders) and a blank line after each urgent one."""
    record = F.to_json(F.struct("o_orderkey", "o_orderpriority", "o_totalprice"))
    cut = F.substring(record, F.lit(1), F.length(record) - 5)
    line = F.when(F.col("o_orderstatus") == "P", cut).otherwise(record)
    end = F.when(F.col("o_orderpriority") == "1-URGENT", "\n").otherwise("")
    t["orders"].select(F.concat(line, end)).write.text(path)


ORDER_SCHEMA = "o_orderkey bigint, o_orderpriority string, o_totalprice double"


@query(
    "scan_jsonl_quarantine",
    """SELECT o_orderstatus = 'P' AS is_bad, count(*) AS n,
              cast(sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey END) AS bigint) AS key_sum
       FROM {orders} GROUP BY 1""",
)
def scan_jsonl_quarantine(t: Data) -> DataFrame:
    path = scratch_path(t.spark, "dirty")
    _dirty_lines(t, path)
    good, bad = jsonl.read_jsonl_quarantine(t.spark, path, ORDER_SCHEMA)
    return (
        good.select(F.lit(False).alias("is_bad"), "o_orderkey")
        .unionByName(bad.select(F.lit(True).alias("is_bad"), F.lit(0).cast("bigint").alias("o_orderkey")))
        .groupBy("is_bad")
        .agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))
    )


@query(
    "scan_json_report",
    """SELECT cast(date_trunc('month', o_orderdate) AS date) AS ds, count(*) AS expected_count,
              count(*) FILTER (o_orderstatus = 'F') AS loaded_count FROM {orders} GROUP BY 1""",
)
def scan_json_report(t: Data) -> DataFrame:
    path = scratch_path(t.spark, "reports")
    reports = t["orders"].groupBy(F.trunc("o_orderdate", "month").alias("ds")).agg(
        F.count("*").alias("expected_count"), F.count_if(F.col("o_orderstatus") == "F").alias("loaded_count")
    )
    reports.write.option("pretty", True).partitionBy("ds").json(path)
    return jsonl.read_report(t.spark, path, "expected_count bigint, loaded_count bigint, ds date")


@query(
    "quarantined_lines",
    """SELECT left(record, length(record) - 5) AS line, 'not JSON' AS reason
       FROM (SELECT '{{"o_orderkey":' || o_orderkey || ',"o_clerk":"' || o_orderstatus || '"}}' AS record, o_orderstatus FROM {orders})
       WHERE o_orderstatus = 'P'""",
)
def quarantined_lines(t: Data) -> DataFrame:
    """The bad lines themselves; that good ones stay out shows in their absence."""
    path = scratch_path(t.spark, "cut")
    record = F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey").cast("string"), F.lit(',"o_clerk":"'), F.col("o_orderstatus"), F.lit('"}'))
    cut = F.substring(record, F.lit(1), F.length(record) - 5)
    t["orders"].select(F.when(F.col("o_orderstatus") == "P", cut).otherwise(record).alias("value")).write.text(path)
    _, bad = jsonl.read_jsonl_quarantine(t.spark, path, "o_orderkey bigint, o_clerk string", ["o_orderkey"])
    return bad.select("line", "reason")


@query("scan_table", "SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem}")
def scan_table(t: Data) -> DataFrame:
    return t.tables["lineitem"].select("l_orderkey", "l_linenumber", "l_quantity")


CSV_SCHEMA = "id string, name string, region string, keyword string, employer string, published_at string"


@query("scan_csv_history", "SELECT id, name FROM {csv_items}")
def scan_csv_history(t: Data) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    sinks.overwrite_csv(t["csv_items"], path)
    return sinks.read_csv_history(t.spark, path, CSV_SCHEMA)


@query("sink_csv_overwrite", "SELECT id, name, region, keyword, employer, published_at FROM {csv_items}")
def sink_csv_overwrite(t: Data) -> DataFrame:
    path = scratch_path(t.spark, "csv-overwrite")
    sinks.overwrite_csv(t["csv_items"].withColumn("name", F.lit("first load")), path)
    sinks.overwrite_csv(t["csv_items"], path)
    return t.spark.read.schema(CSV_SCHEMA).option("header", True).csv(path)


@query("sink_csv_append_new", "SELECT id, name, region, keyword, employer, published_at FROM {csv_items}")
def sink_csv_append_new(t: Data) -> DataFrame:
    """Everything up to 1999 is history; appending the whole set adds only the rest."""
    path = scratch_path(t.spark, "csv-append")
    items = t["csv_items"]
    sinks.overwrite_csv(items.filter(F.col("published_at") < "1999-01-01"), path)
    sinks.append_new_csv(items, path, CSV_SCHEMA)
    return t.spark.read.schema(CSV_SCHEMA).option("header", True).csv(path)


@query(
    "sink_parquet_daily",
    "SELECT o_orderkey, o_totalprice, cast(date_trunc('month', o_orderdate) AS date) AS dt FROM {orders}",
)
def sink_parquet_daily(t: Data) -> DataFrame:
    path = scratch_path(t.spark, "parquet-daily")
    rows = t["orders"].select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("dt"))
    sinks.write_parquet_daily(rows.withColumn("o_totalprice", F.lit(0.0)), path)
    sinks.write_parquet_daily(rows, path)
    return t.spark.read.schema("o_orderkey bigint, o_totalprice double, dt date").parquet(path)


# --- raw payloads ------------------------------------------------------------------------------


@query(
    "register_raw_payload",
    """SELECT 'documents' AS source, arg_min('doc_id=' || doc_id, 'doc_id=' || doc_id || '/') AS object_key, sha AS sha256, any_value(size) AS content_length,
              '2024-01-01 06:00:00' AS load_dt,
              '{{"source_url":"https://example.org/list","sha256":"' || sha || '","content_length":' || any_value(size) || '}}' AS metadata
       FROM (SELECT doc_id, sha256(coalesce(text, '') || chr(10)) AS sha, strlen(coalesce(text, '')) + 1 AS size FROM {documents}) GROUP BY sha""",
)
def register_raw_payload(t: Data) -> DataFrame:
    """A file per document, registered twice: the second time adds nothing."""
    path = scratch_path(t.spark, "raw")
    landed = F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).alias("payload")
    payloads.write_payload_files(t["documents"].select(F.format_string("doc_id=%d.txt", "doc_id").alias("object_key"), landed), path)
    raw = payloads.raw_payloads(t.spark, path, "documents", "https://example.org/list", "2024-01-01 06:00:00")
    # stored, so that every file is opened once
    raw = materialize(raw, "raw_payloads")
    first = payloads.register_payloads(raw.limit(0), raw)
    again = payloads.register_payloads(first, raw)
    key = F.regexp_extract("object_key", r"(doc_id=[^/.]*)\.txt$", 1).alias("object_key")
    when = F.date_format("load_dt", "yyyy-MM-dd HH:mm:ss").alias("load_dt")
    # the time of the file is another on every run
    metadata = F.regexp_replace("metadata", r'"downloaded_at_utc":"[0-9T:-]{19}",', "").alias("metadata")
    return first.unionByName(again).select("source", key, "sha256", "content_length", when, metadata)


@query(
    "register_payload_rows",
    """SELECT 'pages' AS source, min(url) AS object_key, sha256(html) AS sha256, strlen(html) AS content_length
       FROM {pages} GROUP BY html""",
)
def register_payload_rows(t: Data) -> DataFrame:
    incoming = payloads.with_payload_hash(
        t["pages"].select(F.lit("pages").alias("source"), F.col("url").alias("object_key"), F.col("html").alias("payload"))
    )
    return payloads.register_payloads(incoming.limit(0), incoming).select(
        "source", "object_key", "sha256", "content_length"
    )


@query(
    "latest_payload",
    """SELECT event_id, payload, inserted_at, sha256 FROM (SELECT event_id, props AS payload, ts AS inserted_at,
              sha256(props) AS sha256 FROM {events}) ORDER BY inserted_at DESC, sha256 DESC LIMIT 1""",
)
def latest_payload(t: Data) -> DataFrame:
    registered = t["events"].select(
        "event_id",
        F.col("props").alias("payload"),
        F.col("ts").alias("inserted_at"),
        F.sha2("props", 256).alias("sha256"),
    )
    return payloads.latest_payload(registered)


# --- sanctions list ----------------------------------------------------------------------------


def write_sanctions_xml(t: Data, path: str) -> None:
    """The list as XML, one folder per kind of element."""
    people, companies = t["person_rows"], t["company_rows"]
    aliases = t["person_aliases"].groupBy("entity_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("alias_name").alias("ALIAS_NAME")))).alias("INDIVIDUAL_ALIAS")
    )
    document = F.struct(F.col("doc_type").alias("TYPE_OF_DOCUMENT"), F.col("doc_number").alias("NUMBER"))
    individuals = people.join(aliases, "entity_id", "left").select(
        F.col("entity_id").alias("DATAID"),
        F.lit("1").alias("VERSIONNUM"),
        F.col("first_name").alias("FIRST_NAME"),
        F.col("second_name").alias("SECOND_NAME"),
        F.col("third_name").alias("THIRD_NAME"),
        F.col("fourth_name").alias("FOURTH_NAME"),
        F.col("reference_number").alias("REFERENCE_NUMBER"),
        F.col("listed_on").alias("LISTED_ON"),
        F.col("gender").alias("GENDER"),
        F.array(F.struct(F.col("nationality").alias("VALUE"))).alias("NATIONALITY"),
        "INDIVIDUAL_ALIAS",
        F.array(document).alias("INDIVIDUAL_DOCUMENT"),
    )
    entities = companies.select(
        F.col("entity_id").alias("DATAID"),
        F.lit("1").alias("VERSIONNUM"),
        F.col("first_name").alias("FIRST_NAME"),
        F.col("reference_number").alias("REFERENCE_NUMBER"),
        F.array(F.struct(F.col("alias_name").alias("ALIAS_NAME"))).alias("ENTITY_ALIAS"),
    )
    for df, tag in ((individuals, "INDIVIDUAL"), (entities, "ENTITY")):
        df.write.format("xml").option("rootTag", "CONSOLIDATED_LIST").option("rowTag", tag).save(f"{path}/{tag}")


def _sanctions(t: Data) -> dict[str, DataFrame]:
    path = scratch_path(t.spark, "xml")
    write_sanctions_xml(t, path)
    return sanctions.flatten_sanctions(
        xml.read_individuals(t.spark, f"{path}/INDIVIDUAL"),
        xml.read_entities(t.spark, f"{path}/ENTITY"),
        F.lit("2024-01-01"),
    )


STAMP = "'UN_SC_1267' AS source_list, '2024-01-01' AS load_timestamp"
FLAT = {
    "entities": f"""
        SELECT entity_id, '1' AS data_id, 'INDIVIDUAL' AS entity_type,
               concat_ws(' ', nullif(trim(first_name), ''), nullif(second_name, ''), nullif(third_name, ''),
                         nullif(fourth_name, '')) AS primary_name,
               reference_number AS un_reference_number, left(listed_on, 10) AS listed_on, {STAMP} FROM {{person_rows}}
        UNION ALL SELECT entity_id, '1', 'ENTITY', first_name, reference_number, NULL, {STAMP} FROM {{company_rows}}""",
    "aliases": f"""
        SELECT entity_id, alias_name, {STAMP} FROM {{person_aliases}}
        WHERE alias_name <> '' AND entity_id IN (SELECT entity_id FROM {{person_rows}})
        UNION ALL SELECT entity_id, alias_name, {STAMP} FROM {{company_rows}} WHERE alias_name <> ''""",
    "nationalities": f"SELECT entity_id, nationality, {STAMP} FROM {{person_rows}} WHERE nationality <> ''",
    "documents": f"""SELECT entity_id, doc_type, doc_number, {STAMP} FROM {{person_rows}}
        WHERE coalesce(doc_type, '') <> '' OR coalesce(doc_number, '') <> ''""",
}


def _register_sanctions(table: str) -> None:
    @query(f"sanctions_flatten_{table}", FLAT[table])
    def flatten(t: Data) -> DataFrame:
        return _sanctions(t)[table]

    @query(f"sanctions_passthrough_{table}", FLAT[table])
    def passthrough(t: Data) -> DataFrame:
        path = scratch_path(t.spark, "passthrough")
        sinks.replace_table(sanctions.passthrough(table, _sanctions(t)[table]), path)
        return t.spark.read.parquet(path)


for _table in FLAT:
    _register_sanctions(_table)


SUMMARY = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n, count(DISTINCT entity_id) AS entities FROM ({sql})"
    for name, sql in FLAT.items()
)


def _summary(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("entities")).select(
            F.lit(name).alias("table_name"), "n", "entities"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query("sanctions_flatten", SUMMARY)
def sanctions_flatten(t: Data) -> DataFrame:
    """All four tables of one parse, counted."""
    return _summary(_sanctions(t))


@query("sanctions_passthrough", SUMMARY)
def sanctions_passthrough(t: Data) -> DataFrame:
    return _summary({name: sanctions.passthrough(name, df) for name, df in _sanctions(t).items()})


@query(
    "scan_xml_individuals",
    """SELECT entity_id AS DATAID, '1' AS VERSIONNUM, trim(first_name) AS FIRST_NAME, second_name AS SECOND_NAME,
              reference_number AS REFERENCE_NUMBER, listed_on AS LISTED_ON, gender AS GENDER,
              coalesce(n, 0) AS aliases
       FROM {person_rows} LEFT JOIN (SELECT entity_id, count(*) AS n FROM {person_aliases} GROUP BY 1) USING (entity_id)""",
)
def scan_xml_individuals(t: Data) -> DataFrame:
    path = scratch_path(t.spark, "xml")
    write_sanctions_xml(t, path)
    return xml.read_individuals(t.spark, f"{path}/INDIVIDUAL").select(
        "DATAID", "VERSIONNUM", "FIRST_NAME", "SECOND_NAME", "REFERENCE_NUMBER", "LISTED_ON", "GENDER",
        F.coalesce(F.size("INDIVIDUAL_ALIAS"), F.lit(0)).cast("bigint").alias("aliases"),
    )


@query(
    "scan_xml_entities",
    "SELECT entity_id AS DATAID, first_name AS FIRST_NAME, reference_number AS REFERENCE_NUMBER FROM {company_rows}",
)
def scan_xml_entities(t: Data) -> DataFrame:
    path = scratch_path(t.spark, "xml")
    write_sanctions_xml(t, path)
    return xml.read_entities(t.spark, f"{path}/ENTITY").select("DATAID", "FIRST_NAME", "REFERENCE_NUMBER")


# --- tables ------------------------------------------------------------------------------------


@query("truncate_reload", "SELECT s_suppkey, s_name FROM {supplier}")
def truncate_reload(t: Data) -> DataFrame:
    path = scratch_path(t.spark, "reload")
    rows = t["supplier"].select("s_suppkey", "s_name")
    sinks.replace_table(t["customer"].select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name")), path)
    sinks.replace_table(rows, path)
    return t.spark.read.parquet(path)


SEGMENTS = "SELECT c_mktsegment, count(*) AS n, min(c_name) AS first_name FROM {customer} GROUP BY c_mktsegment"


def _segments(customer: DataFrame) -> DataFrame:
    return customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.min("c_name").alias("first_name"))


@query("materialize_view", SEGMENTS)
def materialize_view(t: Data) -> DataFrame:
    models = Tables(t.spark, t.tables.sources)
    models.publish_view("stg_segments", _segments(models["customer"]))
    return models["stg_segments"]


@query("materialize_table", SEGMENTS)
def materialize_table(t: Data) -> DataFrame:
    models = Tables(t.spark, t.tables.sources)
    models.publish_table("segments", _segments(models["customer"]), scratch_path(t.spark, "segments"))
    return models["segments"]


@query("materialized_refresh", SEGMENTS)
def materialized_refresh(t: Data) -> DataFrame:
    """Built from the suppliers first, then refreshed with the full recomputation."""
    models = Tables(t.spark, t.tables.sources)
    path = scratch_path(t.spark, "segments")
    stale = models["supplier"].select(
        F.lit("stale").alias("c_mktsegment"), F.col("s_suppkey").alias("n"), F.col("s_name").alias("first_name")
    )
    models.publish_table("segments", stale, path)
    models.publish_table("segments", _segments(models["customer"]), path)
    return models["segments"]


@query("file_listing_dates")
def file_listing_dates(t: Data) -> DataFrame:
    """A real listing: the files of a partitioned write, newest per load date."""
    from vetline.operators.incremental import newest_file_per_date

    path = scratch_path(t.spark, "listing")
    sinks.write_jsonl_partitions(_list_rows(t), path)
    return newest_file_per_date(listing.file_listing(t.spark, path)).select("dt")


# --- streaming ---------------------------------------------------------------------------------


@query(
    "stream_ingest_upsert",
    """SELECT id, name, load_dt, batch_idx FROM (SELECT *, row_number() OVER (PARTITION BY id
          ORDER BY load_dt DESC, batch_idx DESC, name) AS rn
        FROM {version_bronze}) WHERE rn = 1""",
)
def stream_ingest_upsert(t: Data) -> DataFrame:
    """Two deliveries of files and one stream run after each; the newest version of a key stays."""
    source, target = scratch_path(t.spark, "landing"), scratch_path(t.spark, "store")
    schema = "id bigint, name string, load_dt date, batch_idx int"
    store = KeyedStore(t.spark, target, schema, ["id"], buckets=8)
    rows = t["version_bronze"].select("id", "name", "load_dt", "batch_idx")
    newest = [F.col("load_dt").desc(), F.col("batch_idx").desc(), F.col("name")]
    checkpoint = scratch_path(t.spark, "progress")
    # deliveries follow the load date, so the newest version arrives last
    for part in (F.col("load_dt") < "1998-06-01", F.col("load_dt") >= "1998-06-01"):
        rows.filter(part).write.mode("append").json(source)
        stream_upsert(t.spark, source, schema, store, checkpoint, newest)
    return latest_per_key(store.read(), ["id"], newest)
