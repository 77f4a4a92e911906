"""The registered queries as SQL over the same tables, for another engine.

Rounded amounts are computed on whole cents, so no engine's rounding mode
matters: ``(2 * n + d) // (2 * d)`` is ``n / d`` rounded half up.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

TIME = "'%Y-%m-%d %H:%M:%S.%f'"


def moment(expression: str, name: str) -> str:
    return f"strftime({expression}, {TIME}) AS {name}"


def half_up(numerator: str, denominator: str) -> str:
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


SALES = """
WITH lines AS (
    SELECT *,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
        CAST(round(l_discount * 100) AS INTEGER) AS disc,
        l_shipdate AS booked
    FROM lineitem
    JOIN part ON l_partkey = p_partkey
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
), sales AS (
    SELECT
        l_orderkey * 10 + l_linenumber AS id,
        'ORD-' || l_orderkey AS order_id,
        CAST(o_custkey AS INTEGER) AS customer_id,
        CAST(l_partkey AS INTEGER) AS product_id,
        p_name AS product_name,
        p_type AS category,
        CAST(l_quantity AS INTEGER) AS quantity,
        price_cents,
        disc AS discount_pct,
        (price_cents * (100 - disc) + 50) // 100 AS total_cents,
        r_name AS region,
        n_name AS city,
        c_mktsegment AS payment_method,
        o_orderstatus AS channel,
        l_returnflag = 'R' AS is_returned,
        l_linenumber AS rating,
        booked,
        CAST(CAST(booked AS DATE) AS VARCHAR) AS event_date,
        CASE o_orderpriority
            WHEN '1-URGENT' THEN 'c' WHEN '2-HIGH' THEN 'c' WHEN '3-MEDIUM' THEN 'r'
            WHEN '4-NOT SPECIFIED' THEN 'u' WHEN '5-LOW' THEN 'd' END AS cdc_op,
        o_orderdate AS ordered,
        disc > 0 AS has_discount
    FROM lines
)"""


SALE = f"""
    id, order_id, customer_id, product_id, product_name, category, quantity,
    CAST(price_cents / 100.0 AS DECIMAL(10,2)) AS unit_price, discount_pct,
    CAST(total_cents / 100.0 AS DECIMAL(10,2)) AS total_price,
    region, city, payment_method, channel, is_returned, rating,
    {moment("booked", "event_time")}, event_date, has_discount"""

LAKE = f"""{SALE}, cdc_op,
    {moment("date_trunc('millisecond', ordered)", "cdc_ts")},
    {moment("ordered", "ingest_ts")}"""

FIRST_IMAGES = "cdc_op IN ('c', 'r')"


RATED = "rating BETWEEN 1 AND 5"
DAILY_MART = f"""{SALES}
SELECT event_date, region, category,
    count(*) AS total_orders,
    count(DISTINCT order_id) AS unique_orders,
    CAST(sum(quantity) AS BIGINT) AS total_quantity,
    CAST(CAST(sum(total_cents) AS BIGINT) / 100.0 AS DECIMAL(20,2)) AS total_revenue,
    CAST({half_up("sum(total_cents)", "count(*)")} AS BIGINT) / 100.0 AS avg_order_value,
    CASE WHEN count(*) FILTER ({RATED}) > 0 THEN CAST({
        half_up(f"100 * sum(rating) FILTER ({RATED})", f"count(*) FILTER ({RATED})")
    } AS BIGINT) / 100.0 END AS avg_rating,
    count(*) FILTER (is_returned) AS returned_orders,
    CAST({half_up("10000 * count(*) FILTER (is_returned)", "count(*)")} AS BIGINT) / 100.0
        AS return_rate_pct,
    count(*) FILTER (has_discount) AS discounted_orders
FROM sales WHERE {FIRST_IMAGES}
GROUP BY event_date, region, category"""


# Change records

ORACLES["cdc_payload_extract"] = f"""{SALES}
SELECT cdc_op AS op, CASE WHEN cdc_op <> 'd' THEN id END AS id, CASE WHEN cdc_op <> 'd' THEN order_id END AS order_id,
    {moment("ordered", "ingest_ts")}
FROM sales"""

ORACLES["cdc_decode_sales"] = f"{SALES} SELECT {LAKE} FROM sales WHERE {FIRST_IMAGES}"

ORACLES["cdc_decimal_decode"] = """
SELECT 'orders' AS kind, o_orderkey AS key, CAST(round(o_totalprice * 100) / 100.0 AS DECIMAL(10,2)) AS amount
FROM orders
UNION ALL
SELECT 'customer', c_custkey, CAST(round(c_acctbal * 100) / 100.0 AS DECIMAL(10,2)) FROM customer"""

ORACLES["cdc_op_filter"] = f"""{SALES}
SELECT cdc_op AS op, count(*) AS n_rows FROM sales WHERE {FIRST_IMAGES} AND NOT is_returned GROUP BY cdc_op"""

ORACLES["epoch_to_date"] = f"""
SELECT event_id,
    {moment("ts", "event_ts")},
    {moment("date_trunc('millisecond', ts)", "event_ts_millis")},
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
    CAST(CAST(ts AS DATE) + 1 AS VARCHAR) AS next_date,
    CAST(isodow(ts) AS INTEGER) AS weekday
FROM events"""

ORACLES["discount_flag"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    coalesce(CASE WHEN l_linestatus = 'O' THEN round(l_discount * 100) > 0 END, FALSE) AS has_discount
FROM lineitem"""

ORACLES["price_derivation"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST({
    half_up(
        "CAST(round(p_retailprice * 100) AS BIGINT) * (2 * CAST(l_quantity AS BIGINT) + 1)"
        " * (199 - 2 * CAST(round(l_discount * 100) AS BIGINT))",
        "400",
    )
} / 100.0 AS DECIMAL(12,2)) AS total_price
FROM lineitem JOIN part ON l_partkey = p_partkey"""

# Lake

ORACLES["lake_day_scan"] = f"{SALES} SELECT {LAKE} FROM sales WHERE event_date = '1998-04-01'"
ORACLES["day_load"] = ORACLES["lake_day_scan"]
ORACLES["day_append"] = f"{SALES} SELECT {LAKE} FROM sales WHERE event_date IN ('1998-04-01', '1998-04-02')"
ORACLES["lake_lifecycle"] = f"""{SALES} SELECT {LAKE} FROM sales
WHERE cdc_op IN ('c', 'r', 'u') AND booked + INTERVAL 1 MONTH > TIMESTAMP '1998-06-15 12:00:00'"""
ORACLES["stream_cdc_to_lake"] = f"{SALES} SELECT {LAKE} FROM sales WHERE {FIRST_IMAGES}"

# Sales models

ORACLES["stg_sales_events"] = f"""{SALES}
SELECT {SALE}, CASE WHEN rating BETWEEN 1 AND 5 THEN rating END AS valid_rating
FROM sales WHERE {FIRST_IMAGES}"""

ORACLES["stg_sales_view"] = ORACLES["stg_sales_events"]
ORACLES["mart_sales_daily"] = DAILY_MART
ORACLES["mart_ranked"] = f"""
SELECT event_date, region, category, total_revenue,
    CAST(rank() OVER (PARTITION BY event_date ORDER BY total_revenue DESC) AS INTEGER) AS place
FROM ({DAILY_MART})"""
ORACLES["mart_from_changes"] = DAILY_MART
ORACLES["mart_incremental"] = DAILY_MART
ORACLES["full_refresh"] = DAILY_MART

ORACLES["offset_audit"] = f"""{SALES}, placed AS (
    SELECT (id // 10) % 16 AS partition, row_number() OVER (PARTITION BY (id // 10) % 16 ORDER BY id) - 1 AS pos FROM sales
), kept AS (
    SELECT * FROM placed WHERE pos % 1000 NOT BETWEEN 200 AND 209
), gaps AS (
    SELECT partition, pos + 1 AS first, lead(pos) OVER (PARTITION BY partition ORDER BY pos) - 1 AS last FROM kept
)
SELECT 'sales' AS topic, CAST(partition AS INTEGER) AS partition, 'gap' AS kind, first, last, last - first + 1 AS n_offsets
FROM gaps WHERE last >= first
UNION ALL
SELECT 'sales', CAST(partition AS INTEGER), 'overlap', min(pos), max(pos), count(*)
FROM kept WHERE pos BETWEEN 100 AND 149 GROUP BY partition"""

ORACLES["stream_once"] = f"{SALES} SELECT {LAKE} FROM sales WHERE {FIRST_IMAGES}"


# JSON documents

DOCUMENTS = """
WITH docs AS (
    SELECT *, DATE '2026-03-15' + CAST(regexp_extract(source, '[0-9]+') AS INTEGER) AS load_date FROM documents
), parts AS (
    SELECT *, DATE '2026-03-15' + p_size AS load_date FROM part
)"""
ROW_KEY = "md5(CAST(load_date AS VARCHAR) || '-' || CAST({} AS VARCHAR))"
FETCHED = "strftime(load_date + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at"

ORACLES["json_stage_discover"] = f"""{DOCUMENTS}
SELECT {ROW_KEY.format("doc_id")} AS stage_row_key,
    doc_id AS raw_id, CAST(load_date AS VARCHAR) AS load_date, doc_id AS movie_id, {FETCHED},
    source || '/' || doc_id AS title,
    source AS original_title,
    lang AS original_language,
    text AS overview,
    CASE WHEN lang <> 'fr' THEN CAST(load_date AS VARCHAR) END AS release_date,
    CAST(n_chars / 8.0 AS DECIMAL(20,6)) AS popularity,
    CASE WHEN lang <> 'de' THEN CAST(n_chars AS DECIMAL(20,6)) END AS vote_average,
    CAST(n_chars AS INTEGER) AS vote_count,
    lang = 'en' AS is_adult,
    CAST(NULL AS BOOLEAN) AS is_video,
    CAST(NULL AS VARCHAR) AS poster_path,
    CAST(NULL AS VARCHAR) AS backdrop_path,
    '[' || doc_id || ',' || n_chars || ']' AS genre_ids_json
FROM docs"""

PART_DETAIL = """
    p_name AS title,
    lower(p_type) AS original_language,
    CASE WHEN p_type <> 'SMALL' THEN CAST(load_date AS VARCHAR) END AS release_date,
    p_size AS runtime_minutes,
    p_partkey * 1000 AS budget,
    CASE WHEN p_type <> 'LARGE' THEN p_partkey END AS revenue,
    CAST(p_retailprice AS DECIMAL(20,6)) AS popularity,
    CAST(p_size / 4.0 AS DECIMAL(20,6)) AS vote_average,
    p_size AS vote_count"""

ORACLES["stage_load_date"] = f"""{DOCUMENTS}
SELECT doc_id AS raw_id, CAST(load_date AS VARCHAR) AS load_date, doc_id AS movie_id,
    source || '/' || doc_id AS title, CAST(n_chars / 8.0 AS DECIMAL(20,6)) AS popularity
FROM docs WHERE load_date = DATE '2026-03-20'"""

ORACLES["json_stage_details"] = f"""{DOCUMENTS}
SELECT {ROW_KEY.format("p_partkey")} AS stage_row_key,
    p_partkey AS raw_id, CAST(load_date AS VARCHAR) AS load_date, p_partkey AS movie_id, {FETCHED},
    {PART_DETAIL},
    upper(p_name) AS original_title,
    p_name || ' "' || p_brand || '"' || chr(10) || p_type AS overview,
    CASE WHEN p_type <> 'PROMO' THEN p_brand END AS tagline,
    p_type AS movie_status,
    '' AS homepage,
    'tt' || p_partkey AS imdb_id,
    p_type = 'ECONOMY' AS is_adult,
    CASE WHEN p_type <> 'MEDIUM' THEN TRUE END AS is_video,
    '/' || p_partkey || '.jpg' AS poster_path,
    CAST(NULL AS VARCHAR) AS backdrop_path,
    '[{{"id":' || p_size || ',"name":"' || p_type || '"}}]' AS genres_json,
    '[{{"name":"' || p_brand || '"}}]' AS production_companies_json,
    '[]' AS production_countries_json,
    '{{"name":"' || p_name || '"}}' AS spoken_languages_json
FROM parts"""

ORACLES["variant_stage_discover"] = ORACLES["json_stage_discover"]
ORACLES["variant_stage_details"] = ORACLES["json_stage_details"]

ORACLES["nullif_cast"] = """
SELECT o_orderkey,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(round(o_totalprice * 100) / 100.0 AS DECIMAL(20,6)) END AS amount,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN o_custkey END AS customer,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus = 'F' END AS finished
FROM orders"""

ORACLES["surrogate_key"] = f"{DOCUMENTS} SELECT doc_id, {ROW_KEY.format('doc_id')} AS row_key FROM docs"

ORACLES["mart_movies_join"] = f"""{DOCUMENTS}
SELECT {ROW_KEY.format("doc_id")} AS mart_row_key,
    CAST(load_date AS VARCHAR) AS load_date, doc_id AS movie_id,
    source || '/' || doc_id AS title,
    lang AS original_language,
    CASE WHEN lang <> 'fr' THEN CAST(load_date AS VARCHAR) END AS release_date,
    CAST(n_chars / 8.0 AS DECIMAL(20,6)) AS popularity,
    CASE WHEN lang <> 'de' THEN CAST(n_chars AS DECIMAL(20,6)) END AS vote_average,
    CAST(n_chars AS INTEGER) AS vote_count,
    CAST(quality AS INTEGER) AS runtime_minutes,
    CASE WHEN quality IS NOT NULL THEN doc_id * 1000 END AS budget,
    CASE WHEN toxic <> 1 THEN doc_id * 30 END AS revenue
FROM docs LEFT JOIN labels USING (doc_id)"""

ORACLES["mart_movies_details"] = f"""{DOCUMENTS}
SELECT CAST(load_date AS VARCHAR) AS load_date, p_partkey AS movie_id, {PART_DETAIL} FROM parts"""

ORACLES["enrich_by_key"] = """
SELECT o_orderkey, c_custkey, o_orderstatus, c_name, c_acctbal, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey"""

ORACLES["ingest_details"] = f"""{DOCUMENTS}
SELECT CAST(load_date AS VARCHAR) AS load_date, doc_id AS movie_id, CAST(quality + 10 AS INTEGER) AS runtime
FROM docs JOIN labels USING (doc_id) WHERE lang <> 'en'"""

ORACLES["land_json"] = """
SELECT '2026-03-15' AS load_date, c_custkey AS movie_id, * FROM customer"""

TURNS = """
SELECT 'conv-' || conv_id AS listing, turn + 1 AS page, string_split(text, chr(10)) AS lines
FROM conversations WHERE role <> 'system'"""
ITEMS = """
SELECT listing, page, CAST(i AS INTEGER) AS line_no, lines[i] AS line
FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM found)"""

ORACLES["flatten_pages"] = f"""
WITH found AS ({TURNS}), items AS ({ITEMS}) SELECT *, page <= 2 AS in_cap FROM items"""
ORACLES["flatten_all_pages"] = f"""
WITH found AS ({TURNS}
    UNION ALL SELECT 'doc-' || doc_id, 1, string_split(text, chr(10)) FROM documents
) {ITEMS}"""

ORACLES["pages_to_raw"] = f"""
WITH found AS (
    SELECT conv_id AS listing, turn AS page, string_split(text, chr(10)) AS lines FROM conversations
), items AS (
    SELECT listing, page, line, CAST(listing * 65536 + line_no AS BIGINT) AS movie_id,
        DATE '2026-03-15' + CAST(listing % 365 AS INTEGER) AS load_date FROM ({ITEMS})
)
SELECT date_diff('day', DATE '1970-01-01', load_date) * 1099511627776 + movie_id AS id,
    CAST(load_date AS VARCHAR) AS load_date, movie_id, line
FROM (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY page DESC) AS place FROM items)
WHERE place = 1"""
ORACLES["variant_pages_to_raw"] = ORACLES["pages_to_raw"]

# Load modes

ORACLES["dedup_last"] = """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate,
    l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount
FROM (
    SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC,
            l_discount DESC) AS place
    FROM lineitem
) WHERE place = 1"""

ORACLES["insert_if_absent"] = f"""{DOCUMENTS}
SELECT doc_id, lang, n_chars * CASE WHEN quality IS NULL THEN 2 ELSE 1 END AS n_chars,
    CASE WHEN quality IS NULL THEN 'new' ELSE 'old' END AS origin,
    CAST(load_date AS VARCHAR) AS load_date
FROM docs LEFT JOIN labels USING (doc_id)"""

ORACLES["upsert_by_key"] = f"""{DOCUMENTS}
SELECT doc_id, lang, n_chars * CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS n_chars,
    CASE WHEN lang = 'en' THEN 'new' ELSE 'old' END AS origin,
    CAST(load_date AS VARCHAR) AS load_date
FROM docs LEFT JOIN labels USING (doc_id)
WHERE lang = 'en' OR quality IS NOT NULL"""

ORACLES["upsert_moved"] = f"""{DOCUMENTS}
SELECT doc_id, lang, n_chars * CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS n_chars,
    CASE WHEN lang = 'en' THEN 'new' ELSE 'old' END AS origin,
    CAST(load_date + CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS VARCHAR) AS load_date
FROM docs LEFT JOIN labels USING (doc_id)
WHERE lang = 'en' OR quality IS NOT NULL"""

ORACLES["replace_load_date"] = f"""{DOCUMENTS}
SELECT doc_id, n_chars * CASE WHEN load_date = DATE '2026-03-20' THEN 2 ELSE 1 END AS n_chars,
    CASE WHEN load_date = DATE '2026-03-20' THEN 'new' ELSE 'old' END AS origin,
    CAST(load_date AS VARCHAR) AS load_date, lang
FROM docs WHERE load_date <> DATE '2026-03-20' OR lang = 'en'"""

ORACLES["load_together"] = f"""{DOCUMENTS}
SELECT 'listing' AS kind, CAST(load_date AS VARCHAR) AS load_date, doc_id AS movie_id, doc_id AS payload_id
FROM docs
UNION ALL
SELECT 'details', CAST(load_date AS VARCHAR), doc_id, doc_id FROM docs JOIN labels USING (doc_id)"""

ORACLES["load_published"] = f"""{DOCUMENTS}
SELECT 'documents' AS kind, doc_id, lang, CAST(load_date AS VARCHAR) AS load_date, lang AS load
FROM docs WHERE lang IN ('en', 'es')
UNION ALL
SELECT 'labels', doc_id, lang, CAST(load_date AS VARCHAR), lang
FROM docs JOIN labels USING (doc_id) WHERE lang IN ('en', 'es')"""

ORACLES["load_audit"] = f"""{DOCUMENTS}
SELECT CAST(load_date AS VARCHAR) AS load_date, count(*) AS listed, count(quality) AS detailed,
    count(*) - count(quality) AS missing
FROM docs LEFT JOIN labels USING (doc_id) GROUP BY load_date"""

ORACLES["load_cursor"] = f"""{DOCUMENTS}
SELECT doc_id, lang, n_chars, 'source' AS origin, CAST(load_date AS VARCHAR) AS load_date
FROM docs WHERE load_date = DATE '2026-03-18'"""

# Retention, table layout, checks

EVENT = f"event_id, {moment('ts', 'ts')}, event_type"
ORACLES["retention_month"] = f"""
SELECT {EVENT} FROM events WHERE ts + INTERVAL 1 MONTH > TIMESTAMP '2024-02-15 00:00:00'"""
ORACLES["retention_weekends"] = f"""
SELECT {EVENT} FROM events
WHERE ts + INTERVAL 1 MONTH > TIMESTAMP '2024-02-15 00:00:00' OR isodow(ts) < 6"""
ORACLES["retention_table"] = f"""
SELECT {EVENT}, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date
FROM events WHERE ts + INTERVAL 1 MONTH > TIMESTAMP '2024-02-15 12:00:00'"""

ORACLES["computed_columns"] = """
SELECT p_partkey, size AS col_default, size * 33 AS col_stored, size + 1 AS col_alias
FROM (SELECT p_partkey, CAST(CASE WHEN p_type = 'ECONOMY' THEN p_size ELSE 42 END AS BIGINT) AS size FROM part)"""

ORACLES["literal_rows"] = """
SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN 'c' WHEN '2-HIGH' THEN 'c' WHEN '3-MEDIUM' THEN 'r'
        WHEN '4-NOT SPECIFIED' THEN 'u' WHEN '5-LOW' THEN 'd' END AS op, 7 AS weight
FROM orders"""
ORACLES["column_comments"] = """
SELECT 'c_custkey' AS column_name, 'number of the customer' AS remark, count(c_custkey) AS filled FROM customer
UNION ALL SELECT 'c_name', 'as on the invoice', count(c_name) FROM customer
UNION ALL SELECT 'c_mktsegment', NULL, count(c_mktsegment) FROM customer"""
ORACLES["array_column"] = " UNION ALL ".join(
    f"SELECT l_orderkey, {moment('l_shipdate', 'l_shipdate')}, {i} AS position, CAST({c} AS BIGINT) AS item"
    " FROM lineitem"
    for i, c in enumerate(("l_partkey", "l_suppkey", "l_linenumber"))
)

ORACLES["sorted_write"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {moment("o_orderdate", "o_orderdate")}, o_orderpriority
FROM orders"""
ORACLES["compressed_write"] = ORACLES["sorted_write"]

ORACLES["dq_not_null"] = f"""{DOCUMENTS}, joined AS (SELECT * FROM docs LEFT JOIN labels USING (doc_id))
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failures FROM joined"
    for c in ("doc_id", "load_date", "quality", "toxic")
)

ORACLES["dq_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLES["dq_report"] = f"""{DOCUMENTS}
SELECT 'not_null' AS "check", 'raw_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS failures FROM docs
UNION ALL SELECT 'not_null', 'movie_id', count(*) FILTER (doc_id IS NULL) FROM docs
UNION ALL SELECT 'not_null', 'load_date', count(*) FILTER (load_date IS NULL) FROM docs
UNION ALL SELECT 'not_null', 'release_date', count(*) FILTER (lang = 'fr') FROM docs
UNION ALL SELECT 'unique', 'raw_id', count(*) FROM (SELECT doc_id FROM docs GROUP BY doc_id HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'load_date', count(*)
    FROM (SELECT load_date FROM docs GROUP BY load_date HAVING count(*) > 1)"""
