"""Scalar functions over whole columns of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline import functions as V
from vetline.catalog.registry import Data, query
from vetline.operators.shape import explode_json_array

NORMAL = r"""trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[-/]+', ' ', 'g'),
             '[^\p{{{{L}}}}\p{{{{N}}}}\s]+', '', 'g'), '\s+', ' ', 'g'))"""
ASCII = r"""trim(regexp_replace(lower(regexp_replace(regexp_replace({0}, '[/\-]', ' ', 'g'),
            '[^a-zA-Z0-9\s]', '', 'g')), '\s+', ' ', 'g'))"""
# list of the trigrams of an SQL text expression
GRAMS = r"""list_distinct(flatten(list_transform(
    list_filter(string_split(trim(regexp_replace(lower({0}), '[^\p{{{{L}}}}\p{{{{N}}}}]+', ' ', 'g')), ' '), lambda w: w <> ''),
    lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))"""


@query(
    "json_extract",
    """SELECT event_id, cast(props->>'$.k' AS bigint) AS k_big, cast(props->>'$.k' AS int) AS k_int,
              cast(props->>'$.k' AS decimal(18,2)) AS k_num, (props->>'$.missing') IS NULL AS no_field,
              cast(props->>'$.k' AS int) > 50 AS above
       FROM {events}""",
)
def json_extract(t: Data) -> DataFrame:
    k = F.col("p.k")
    return t["events"].withColumn("p", V.json_fields("props", "k", "missing")).select(
        "event_id",
        k.cast("bigint").alias("k_big"),
        k.cast("int").alias("k_int"),
        k.cast("decimal(18,2)").alias("k_num"),
        F.col("p.missing").isNull().alias("no_field"),
        (k.cast("int") > 50).alias("above"),
    )


@query(
    "json_array_elements",
    """SELECT id, json_extract_string(x, '$.name') AS skill_name
       FROM (SELECT id, unnest(from_json(key_skills, '["json"]')) AS x FROM {order_skills})""",
)
def json_array_elements(t: Data) -> DataFrame:
    return explode_json_array(t["order_skills"], "key_skills", "name", "skill_name").select("id", "skill_name")


@query(
    "to_json_or_none",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL WHEN 'click' THEN NULL
                             WHEN 'signup' THEN '{{}}' ELSE props END AS props_json
       FROM {events}""",
)
def to_json_or_none(t: Data) -> DataFrame:
    raw = (
        F.when(F.col("event_type") == "error", "null")
        .when(F.col("event_type") == "view", "NaN")
        .when(F.col("event_type") == "click", "[]")
        .when(F.col("event_type") == "signup", "{}")
        .otherwise(F.col("props"))
    )
    return t["events"].select("event_id", V.empty_json_to_null(raw).alias("props_json"))


@query(
    "to_bool_or_none",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN NULL
                               WHEN '3-MEDIUM' THEN false WHEN '2-HIGH' THEN o_orderstatus <> 'F' ELSE true END AS flag
       FROM {orders}""",
)
def to_bool_or_none(t: Data) -> DataFrame:
    priority = F.col("o_orderpriority")
    raw = (
        F.when(priority == "5-LOW", "null")
        .when(priority == "4-NOT SPECIFIED", "NaN")
        .when(priority == "3-MEDIUM", "false")
        .when(priority == "2-HIGH", F.when(F.col("o_orderstatus") == "F", "0").otherwise("1"))
        .otherwise(priority)
    )
    return t["orders"].select("o_orderkey", V.bool_or_null(raw).alias("flag"))


@query(
    "clean_html_staging",
    r"""SELECT vacancy_id, text_raw, nullif(trim(regexp_replace(regexp_replace(regexp_replace(text_raw,
               '<[^>]+>', ' ', 'g'), '&nbsp;', ' ', 'g'), '\s+', ' ', 'g')), '') AS text_clean
        FROM (SELECT vacancy_id, nullif(trim(coalesce(branded_description_raw, description_raw, '')), '') AS text_raw
              FROM {raw_text})""",
)
def clean_html_staging(t: Data) -> DataFrame:
    raw = V.display_text("branded_description_raw", "description_raw")
    return t["raw_text"].select("vacancy_id", raw.alias("text_raw")).withColumn(
        "text_clean", V.clean_html_spaced("text_raw")
    )


@query(
    "strip_html_silver",
    """SELECT vacancy_id, regexp_replace(coalesce(description_raw, ''), '<[^>]*>', '', 'g') AS description_text
       FROM {raw_text}""",
)
def strip_html_silver(t: Data) -> DataFrame:
    return t["raw_text"].select("vacancy_id", V.strip_tags("description_raw").alias("description_text"))


# the given pages have none of the elements that hide text or keep blanks, and four named references
PAGE_TEXT = r"""
WITH marked AS (
  -- a tag that the end of the page cuts off is text
  SELECT page_id, regexp_replace(html, '<([a-zA-Z/!?][^<>]*)$', chr(1) || '\1') AS html FROM {pages}
), cut AS (
  SELECT page_id, regexp_extract_all(html,
      '<!--[\s\S]*?--\s*>|<script[^>]*>[\s\S]*?</script>|<style[^>]*>[\s\S]*?</style>|</?[a-zA-Z][^>]*>|<![^>]*>|[^<]+') AS tokens FROM marked
), texts AS (
  SELECT page_id, list_transform(list_filter(tokens, lambda t: t[1] <> '<'), lambda t:
      replace(replace(replace(replace(replace(regexp_replace(t, '&amp;?', chr(2), 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), chr(1), '<'), chr(2), '&')) AS texts
  FROM cut
)
SELECT page_id, regexp_replace(array_to_string(list_transform(texts, lambda t:
    CASE WHEN regexp_matches(t, '[^ \n\t\f\r]') THEN t WHEN contains(t, chr(10)) THEN chr(10) ELSE ' ' END), chr(10)), '^\s+|\s+$', '', 'g') AS description_text
FROM texts
"""


@query("html_text_lines", PAGE_TEXT)
def html_text_lines(t: Data) -> DataFrame:
    return t["pages"].select("page_id", V.visible_text_lines("html").alias("description_text"))


@query("normalize_name", f"SELECT doc_id, {NORMAL.format('text')} AS normalized_name FROM {{documents}}")
def normalize_name(t: Data) -> DataFrame:
    return t["documents"].select("doc_id", V.normalize_name("text").alias("normalized_name"))


@query("normalize_name_ascii", f"SELECT doc_id, {ASCII.format('text')} AS normalized_name FROM {{documents}}")
def normalize_name_ascii(t: Data) -> DataFrame:
    return t["documents"].select("doc_id", V.normalize_name_ascii("text").alias("normalized_name"))


# the first and second name of neighbouring part rows, and both texts of a conversation step
@query(
    "trigram_similarity",
    f"""SELECT conv_id, turn, round(CASE WHEN len(a) + len(b) = 0 THEN 0.0
               ELSE len(list_intersect(a, b)) / cast(len(list_distinct(list_concat(a, b))) AS double) END, 4)
                 AS similarity_score
        FROM (SELECT u.conv_id, u.turn, {GRAMS.format('u.text')} AS a, {GRAMS.format('r.text')} AS b
              FROM {{conversations}} u JOIN {{conversations}} r ON r.conv_id = u.conv_id AND r.turn = u.turn + 1)""",
)
def trigram_similarity(t: Data) -> DataFrame:
    said = t["conversations"].select("conv_id", "turn", "text")
    reply = said.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    score = F.round(V.trigram_similarity("text", "reply"), 4)
    return said.join(reply, ["conv_id", "turn"]).select("conv_id", "turn", score.alias("similarity_score"))


@query(
    "person_name_concat",
    """SELECT entity_id, concat_ws(' ', trim(nullif(first_name, '')), trim(nullif(second_name, '')),
                                  trim(nullif(third_name, '')), trim(nullif(fourth_name, ''))) AS full_name
       FROM {person_rows}""",
)
def person_name_concat(t: Data) -> DataFrame:
    full_name = V.person_name("first_name", "second_name", "third_name", "fourth_name")
    return t["person_rows"].select("entity_id", full_name.alias("full_name"))


@query(
    "safe_text",
    """SELECT entity_id, CASE WHEN first_name <> '' THEN trim(first_name) END AS first_name,
              CASE WHEN third_name <> '' THEN trim(third_name) END AS third_name
       FROM {person_rows}""",
)
def safe_text(t: Data) -> DataFrame:
    return t["person_rows"].select(
        "entity_id", V.safe_text("first_name").alias("first_name"), V.safe_text("third_name").alias("third_name")
    )


@query("normalize_date", "SELECT entity_id, left(listed_on, 10) AS listed_on FROM {person_rows}")
def normalize_date(t: Data) -> DataFrame:
    return t["person_rows"].select("entity_id", V.date_prefix("listed_on").alias("listed_on"))


@query(
    "entity_hash",
    """SELECT entity_id, sha256(coalesce(first_name, 'None') || reference_number || coalesce(gender, 'None')) AS entity_hash
       FROM {person_rows}""",
)
def entity_hash(t: Data) -> DataFrame:
    return t["person_rows"].select(
        "entity_id", V.entity_hash("first_name", "reference_number", "gender").alias("entity_hash")
    )


@query(
    "classify_http_reason",
    """SELECT event_id, status, CASE WHEN status = 404 THEN 'not_found' WHEN status = 429 THEN 'rate_limited'
              WHEN status >= 500 AND status < 600 THEN 'server_error' WHEN status = 403 THEN 'forbidden'
              ELSE 'http_error' END AS reason
       FROM (SELECT event_id, 395 + cast(floor(value) AS int) * 3 AS status FROM {events})""",
)
def classify_http_reason(t: Data) -> DataFrame:
    rows = t["events"].select("event_id", (F.floor("value").cast("int") * 3 + 395).alias("status"))
    return rows.withColumn("reason", V.classify_http_reason(F.col("status")))


@query(
    "scalar_builtins",
    """SELECT o_orderkey, cast(o_orderdate AS date) AS d, coalesce(nullif(o_orderstatus, 'P'), 'none') AS status,
              lower(trim(' ' || o_orderpriority || ' ')) AS priority, length(o_orderpriority) AS n,
              least(o_totalprice, 100000.0) AS low, greatest(o_totalprice, 100000.0) AS high,
              round(o_totalprice / 1000, 0) AS thousands
       FROM {orders}""",
)
def scalar_builtins(t: Data) -> DataFrame:
    limit = F.lit(100000.0)
    return t["orders"].select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("d"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("none")).alias("status"),
        F.lower(F.trim(F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")))).alias("priority"),
        F.length("o_orderpriority").alias("n"),
        F.least("o_totalprice", limit).alias("low"),
        F.greatest("o_totalprice", limit).alias("high"),
        F.round(F.col("o_totalprice") / 1000, 0).alias("thousands"),
    )
