"""The record shapes of the jobs, derived from the given tables.

Each is plain SQL that Spark and DuckDB read alike; where they differ a shape has one text per engine.
Doubled braces are literal ones (JSON), single braces name a table or another shape.
"""

# Employer JSON of a customer row ``c`` and an order row ``o``: missing, without id, without name, or whole.
EMPLOYER = """
CASE WHEN c.c_acctbal < -900 THEN NULL
     WHEN c.c_acctbal < -800 THEN '{{"id":null,"name":"' || c.c_name || '"}}'
     ELSE '{{"id":"' || cast(c.c_custkey AS string) || '","name":'
       || CASE WHEN c.c_acctbal < -500 THEN 'null' WHEN c.c_acctbal < -300 THEN '""' ELSE '"' || c.c_name || '"' END
       || ',"url":"https://api.example.org/employers/' || cast(c.c_custkey AS string)
       || '","alternate_url":"https://example.org/employer/' || cast(c.c_custkey AS string)
       || '","vacancies_url":"https://api.example.org/vacancies?employer_id=' || cast(c.c_custkey AS string)
       || '","trusted":' || CASE WHEN o.o_orderstatus = 'F' THEN 'false' ELSE 'true' END
       || ',"accredited_it_employer":' || CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'true' ELSE 'false' END
       || ',"is_identified_by_esia":' || CASE WHEN c.c_acctbal < 0 THEN 'null' ELSE 'true' END
       || ',"country_id":' || cast(c.c_nationkey AS string)
       || ',"logo_urls":{{"90":"https://img.example.org/' || cast(c.c_custkey AS string) || '.png"}}}}'
END
"""
CATEGORY = """
CASE c.c_mktsegment WHEN 'FURNITURE' THEN 'crypto' WHEN 'MACHINERY' THEN 'scam' WHEN 'BUILDING' THEN 'retail'
                    WHEN 'AUTOMOBILE' THEN NULL ELSE 'office' END
"""
PAY_FROM = "cast(cast(floor(o.o_totalprice * 1.2) AS bigint) AS string)"
PAY_TO = "cast(cast(floor(o.o_totalprice * 1.5) AS bigint) AS string)"

SHAPES: dict[str, str | dict[str, str]] = {
    "list_bronze": f"""
        SELECT o.o_orderkey AS id,
               'Vacancy ' || cast(o.o_orderkey AS string) AS name,
               '{{{{"id":"' || cast(n.n_nationkey AS string) || '","name":"' || n.n_name || '"}}}}' AS area,
               CASE o.o_orderpriority
                 WHEN '5-LOW' THEN NULL
                 WHEN '4-NOT SPECIFIED' THEN '{{{{"from":' || {PAY_FROM} || ',"to":null,"currency":"KZT"}}}}'
                 WHEN '3-MEDIUM' THEN '{{{{"from":null,"to":' || {PAY_TO} || ',"currency":"KZT"}}}}'
                 ELSE '{{{{"from":' || {PAY_FROM} || ',"to":' || {PAY_TO} || ',"currency":"USD"}}}}' END AS salary,
               {EMPLOYER} AS employer,
               CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE '{{{{"name":"' || o.o_orderpriority || '"}}}}' END AS schedule,
               '{{{{"name":"' || c.c_mktsegment || '"}}}}' AS employment,
               '{{{{"name":null}}}}' AS experience,
               cast(cast(o.o_orderdate AS date) AS string) || 'T23:30:00+0300' AS published_at,
               cast(cast(o.o_orderdate AS date) AS string) || 'T08:00:00+0300' AS created_at,
               (o.o_orderstatus = 'F') AS archived,
               'P_' || c.c_mktsegment AS search_profile,
               {CATEGORY} AS expected_risk_category,
               cast(o.o_orderdate AS date) AS load_dt,
               'daily' AS load_type
        FROM {{orders}} o
        JOIN {{customer}} c ON o.o_custkey = c.c_custkey
        JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
    """,
    # the same with the validity dates of a first load
    "vacancy_bronze": """
        SELECT b.*, cast(substring(b.published_at, 1, 10) AS date) AS active_from,
               CASE WHEN b.archived THEN b.load_dt ELSE date '2999-01-01' END AS active_to
        FROM {list_bronze} b
    """,
    # several versions of one vacancy: its order lines, loaded when they shipped
    "version_bronze": """
        SELECT l.l_orderkey AS id, p.p_name AS name, l.l_shipmark AS salary, (l.l_returnflag = 'R') AS archived,
               cast(l.l_shipdate AS date) AS load_dt,
               CASE WHEN l.l_linestatus = 'O' THEN NULL
                    ELSE cast(cast(l.l_shipdate AS date) AS string) || 'T23:30:00+0300' END AS published_at,
               'P_' || l.l_returnflag AS search_profile, l.l_linenumber AS batch_idx
        FROM (SELECT *, cast(cast(l_extendedprice AS decimal(18,2)) AS string) AS l_shipmark FROM {lineitem}) l
        JOIN {part} p ON l.l_partkey = p.p_partkey
    """,
    # text of a vacancy: none where the customer has no document, on another load date for pending orders
    "text_bronze": """
        SELECT o.o_orderkey AS id,
               '<div><p>' || replace(d.text, chr(10), '</p>&nbsp;<p>') || '</p><!-- ' || d.source || ' --></div>'
                 AS description,
               CASE d.lang WHEN 'fr' THEN '' WHEN 'de' THEN '<b>' || d.source || '</b>' ELSE NULL END
                 AS branded_description,
               CASE WHEN o.o_orderstatus = 'P' THEN cast(cast(o.o_orderdate AS date) + INTERVAL 1 DAY AS date)
                    ELSE cast(o.o_orderdate AS date) END AS load_dt,
               o.o_orderdate AS inserted_at
        FROM {orders} o
        JOIN {documents} d ON d.doc_id = o.o_custkey
    """,
    # the same in two parts: rows, and the texts that they refer to
    "text_rows": """
        SELECT o.o_orderkey AS id, o.o_custkey AS text_id,
               CASE WHEN o.o_orderstatus = 'P' THEN cast(cast(o.o_orderdate AS date) + INTERVAL 1 DAY AS date)
                    ELSE cast(o.o_orderdate AS date) END AS load_dt,
               o.o_orderdate AS inserted_at
        FROM {orders} o
    """,
    "text_bodies": """
        SELECT d.doc_id AS text_id,
               '<div><p>' || replace(d.text, chr(10), '</p>&nbsp;<p>') || '</p><!-- ' || d.source || ' --></div>'
                 AS description,
               CASE d.lang WHEN 'fr' THEN '' WHEN 'de' THEN '<b>' || d.source || '</b>' ELSE NULL END
                 AS branded_description
        FROM {documents} d
    """,
    "details_bronze": f"""
        SELECT o.o_orderkey AS id, 'Vacancy ' || cast(o.o_orderkey AS string) AS name,
               (o.o_orderstatus = 'F') AS archived, {EMPLOYER} AS employer,
               '<p>' || n.n_name || '</p>' AS description, cast(NULL AS string) AS branded_description,
               k.key_skills,
               cast(cast(o.o_orderdate AS date) AS string) AS published_at,
               cast(cast(o.o_orderdate AS date) AS string) AS created_at,
               cast(NULL AS string) AS initial_created_at,
               'P_' || c.c_mktsegment AS search_profile, {CATEGORY} AS expected_risk_category,
               cast(o.o_orderdate AS date) AS load_dt, 'daily' AS load_type,
               c.c_nationkey AS batch_idx, o.o_orderdate AS inserted_at
        FROM {{orders}} o
        JOIN {{customer}} c ON o.o_custkey = c.c_custkey
        JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN {{order_skills}} k ON k.id = o.o_orderkey
    """,
    # JSON array with a repeated, a padded, a blank and a null name; empty or NULL for some orders
    "order_skills": """
        SELECT o.o_orderkey AS id,
               CASE o.o_orderpriority WHEN '5-LOW' THEN '[]' WHEN '1-URGENT' THEN NULL
                 ELSE '[{{"name":"' || c.c_mktsegment || '"}},{{"name":" "}},{{"name":null}},{{"name":"'
                   || o.o_orderpriority || '"}},{{"name":" ' || c.c_mktsegment || ' "}},{{"name":"'
                   || o.o_orderpriority || '"}},{{"name":"' || c.c_name || '"}}]' END AS key_skills
        FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
    """,
    # raw HTML beside plain text, both whole
    "raw_text": """
        SELECT 'page-' || cast(page_id AS string) AS vacancy_id, html || '&nbsp;' || url AS description_raw,
               CASE WHEN length(url) > 40 THEN '' ELSE NULL END AS branded_description_raw
        FROM {pages}
        UNION ALL
        SELECT 'doc-' || cast(doc_id AS string), text,
               CASE WHEN lang = 'de' THEN '<p>' || text || '</p>' ELSE NULL END
        FROM {documents}
    """,
    "manifest": """
        SELECT cast(doc_id AS string) AS vacancy_id, source AS search_profile, lang AS expected_risk_category,
               cast(NULL AS string) AS load_dt, cast(NULL AS string) AS load_type
        FROM {documents}
    """,
    "failures": """
        SELECT cast(event_id AS string) AS vacancy_id, status AS http_status,
               CASE WHEN status = '404' THEN 'not_found' WHEN status = '429' THEN 'rate_limited'
                    WHEN status = '503' THEN 'server_error' WHEN status = '403' THEN 'forbidden'
                    WHEN status = '418' THEN 'http_error' ELSE NULL END AS reason,
               user_id AS batch_idx
        FROM {responses} WHERE event_type = 'error'
    """,
    "responses": """
        SELECT event_id, event_type, user_id,
               CASE WHEN event_type <> 'error' THEN '200'
                    WHEN value < 2 THEN '404' WHEN value < 4 THEN '429' WHEN value < 8 THEN '503'
                    WHEN value < 12 THEN '403' WHEN value < 20 THEN '418' WHEN value < 30 THEN 'exception'
                    ELSE NULL END AS status,
               user_id AS batch_idx
        FROM {events}
    """,
    "file_keys": """
        SELECT 'bronze/details/load_type=daily/'
                 || CASE WHEN event_type = 'error' THEN 'failures/' ELSE 'dt=' || cast(cast(ts AS date) AS string) END
                 || '/part-' || cast(event_id AS string) || '.jsonl' AS key,
               ts AS last_modified
        FROM {events}
    """,
    "csv_items": """
        SELECT cast(o_orderkey AS string) AS id, 'Vacancy ' || o_orderpriority AS name, o_orderstatus AS region,
               'etl' AS keyword, 'Customer ' || cast(o_custkey AS string) AS employer,
               cast(cast(o_orderdate AS date) AS string) AS published_at
        FROM {orders}
    """,
    # lists to screen: every line of every document against every passage of the list
    "screening_inputs": {
        "spark": """
            SELECT doc_id * 100000 + pos AS input_id, line AS input_name
            FROM {documents} LATERAL VIEW posexplode(split(text, chr(10))) AS pos, line
        """,
        "duckdb": """
            SELECT doc_id * 100000 + unnest(range(len(string_split(text, chr(10))))) AS input_id,
                   unnest(string_split(text, chr(10))) AS input_name
            FROM {documents}
        """,
    },
    "list_entities": """
        SELECT cast(item_id AS string) AS entity_id, '1' AS data_id, 'INDIVIDUAL' AS entity_type,
               text AS primary_name, 'QDi.' || cast(item_id AS string) AS un_reference_number,
               '2015-04-07' AS listed_on, 'UN_SC_1267' AS source_list, '2024-01-01' AS load_timestamp
        FROM {benchmark}
    """,
    "list_aliases": {
        "spark": """
            SELECT cast(item_id AS string) AS entity_id, explode(split(text, chr(10))) AS alias_name,
                   'UN_SC_1267' AS source_list, '2024-01-01' AS load_timestamp
            FROM {benchmark}
        """,
        "duckdb": """
            SELECT cast(item_id AS string) AS entity_id, unnest(string_split(text, chr(10))) AS alias_name,
                   'UN_SC_1267' AS source_list, '2024-01-01' AS load_timestamp
            FROM {benchmark}
        """,
    },
    # Spark builds this one with plans.sanctions.screening_names
    "list_names": {"duckdb": r"""
        SELECT entity_id, name_value, name_type, source_list, load_timestamp,
               trim(regexp_replace(regexp_replace(regexp_replace(lower(name_value), '[-/]+', ' ', 'g'),
                    '[^\p{{L}}\p{{N}}\s]+', '', 'g'), '\s+', ' ', 'g')) AS normalized_name
        FROM (SELECT entity_id, primary_name AS name_value, 'primary' AS name_type, source_list, load_timestamp
              FROM {list_entities} WHERE primary_name IS NOT NULL
              UNION ALL
              SELECT entity_id, alias_name, 'alias', source_list, load_timestamp
              FROM {list_aliases} WHERE alias_name IS NOT NULL)
    """},
    "person_rows": """
        SELECT cast(c.c_custkey AS string) AS entity_id,
               CASE WHEN c.c_acctbal < 0 THEN NULL ELSE ' ' || c.c_mktsegment || ' ' END AS first_name,
               c.c_name AS second_name,
               CASE WHEN c.c_acctbal > 5000 THEN '' ELSE n.n_name END AS third_name,
               CASE WHEN c.c_mktsegment = 'BUILDING' THEN NULL ELSE cast(c.c_nationkey AS string) END AS fourth_name,
               'QDi.' || cast(c.c_custkey AS string) AS reference_number,
               CASE WHEN c.c_mktsegment = 'MACHINERY' THEN NULL ELSE 'Male' END AS gender,
               CASE WHEN c.c_mktsegment = 'FURNITURE' THEN NULL ELSE '2015-04-07-04:00' END AS listed_on,
               CASE WHEN c.c_acctbal < -500 THEN '' ELSE n.n_name END AS nationality,
               CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 'Passport' END AS doc_type,
               CASE WHEN c.c_acctbal < 100 THEN NULL ELSE 'N' || cast(c.c_custkey AS string) END AS doc_number
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
    """,
    "person_aliases": """
        SELECT DISTINCT cast(o_custkey AS string) AS entity_id,
               CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'Alias ' || o_orderpriority END AS alias_name
        FROM {orders}
    """,
    "company_rows": """
        SELECT 'S' || cast(s_suppkey AS string) AS entity_id, s_name AS first_name,
               'QDe.' || cast(s_suppkey AS string) AS reference_number,
               CASE WHEN s_acctbal < 0 THEN '' ELSE s_name || ' Ltd' END AS alias_name
        FROM {supplier}
    """,
    "profile_rows": """
        SELECT 'P_' || c_mktsegment AS profile_id, min(c_name) AS text, 'segment ' || c_mktsegment AS why,
               lower(c_mktsegment) AS expected_risk_category, (c_mktsegment <> 'HOUSEHOLD') AS enabled
        FROM {customer} GROUP BY c_mktsegment
    """,
    # a profile per document, from its own longer words: (one or the other) and (a word ending or a phrase)
    "search_profiles": {
        "spark": r"""
            SELECT concat('D', doc_id) AS profile_id,
                   array(array(get(w, 0), get(w, 1)), array(concat(left(get(w, 2), 7), '*'), regexp_extract(lower(text), r'\pL+ \pL+', 0))) AS groups,
                   source AS expected_risk_category, doc_id % 10 <> 0 AS enabled
            FROM (SELECT *, regexp_extract_all(lower(text), r'\pL\pL\pL\pL\pL\pL\pL\pL+', 0) AS w FROM {documents}) WHERE size(w) > 2
        """,
        "duckdb": r"""
            SELECT 'D' || doc_id AS profile_id, [w[1], w[2]] AS one, left(w[3], 7) AS ending,
                   regexp_extract(lower(text), '\pL+ \pL+', 0) AS phrase, source AS expected_risk_category, doc_id % 10 <> 0 AS enabled
            FROM (SELECT *, regexp_extract_all(lower(text), '\pL\pL\pL\pL\pL\pL\pL\pL+') AS w FROM {documents}) WHERE len(w) > 2
        """,
    },
}
