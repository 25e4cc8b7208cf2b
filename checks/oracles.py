"""For each query the SQL that computes the same rows from the same tables."""

from __future__ import annotations

BOUNCE_MS = 4 * 3600 * 1000
LOOKBACK_S = 6 * 3600
AS_OF_MS = 1_700_000_000_000

# The page log: events seen as in mapping.page_log.
PL = r"""
ev AS (SELECT *, CAST(regexp_extract(props, '"k": (\d+)', 1) AS INTEGER) AS k FROM events),
pl AS (
  SELECT event_id, k, event_type, CAST(user_id AS VARCHAR) AS mid,
    CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
    'v' || (k % 3) AS vc, event_type AS ch, 'r' || (user_id % 5) AS ar,
    CASE event_type WHEN 'view' THEN 'good_list' WHEN 'click' THEN 'good_detail'
         WHEN 'purchase' THEN 'payment' WHEN 'signup' THEN 'home' ELSE '' END AS page_id,
    CASE WHEN k < 50 THEN NULL WHEN k < 60 THEN '' ELSE 'home' END AS last_page_id,
    CASE WHEN event_type = 'view' THEN 'View Item-' || k ELSE CAST(k AS VARCHAR) END AS item,
    CAST(floor(value) AS BIGINT) AS during_time, epoch_us(ts) // 1000 AS ts, ts AS t
  FROM ev)"""

BOUNCED = f"""
bounced AS (
  SELECT * FROM (
    SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, event_id) AS nxt FROM pl)
  WHERE coalesce(last_page_id, '') = '' AND (nxt IS NULL OR nxt - ts >= {BOUNCE_MS}))"""

VISITED = """
visited AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY mid, CAST(t AS DATE) ORDER BY ts, event_id) AS rn
    FROM pl WHERE coalesce(last_page_id, '') = '')
  WHERE rn = 1)"""

FLAT = "event_id, mid, is_new, page_id, ts"

SHOWN = """
shown AS (
  SELECT event_id, page_id, ts, x,
    CASE WHEN x % 3 = 0 THEN 'promotion' ELSE 'sku_id' END AS item_type
  FROM (SELECT event_id, page_id, ts, k, unnest([k, k + 1, k + 2][1:(k % 4)]) AS x
        FROM pl WHERE event_type = 'view'))"""

VISITOR_ROWS = """
rows4 AS (
  SELECT vc, ch, ar, is_new, 0 AS uv_ct, 1 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, during_time AS dur_sum, ts FROM pl
  UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 1, 0, 0, ts FROM pl WHERE coalesce(last_page_id, '') = ''
  UNION ALL SELECT vc, ch, ar, is_new, 1, 0, 0, 0, 0, ts FROM visited
  UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM bounced)"""

TXT = "'%Y-%m-%d %H:%M:%S'"


def visitor_totals(extra: str = "") -> str:
    return f"""
SELECT strftime(w, {TXT}) AS stt, strftime(w + INTERVAL 1 HOUR, {TXT}) AS edt, vc, ch, ar, is_new,
  CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
  CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
  CAST(sum(dur_sum) AS BIGINT) AS dur_sum, CAST({AS_OF_MS} AS BIGINT) AS ts
FROM (SELECT *, date_trunc('hour', make_timestamp(ts * 1000)) AS w FROM rows4) {extra}
GROUP BY w, vc, ch, ar, is_new"""


# Line items within 30 days of their order.
WIDE = """
wide AS (
  SELECT o.*, l.* FROM orders o JOIN lineitem l ON o_orderkey = l_orderkey
  WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 30 DAY)"""

MONEY = "CAST(CAST({} AS DECIMAL(18,2)) AS DOUBLE)"


def money(c: str) -> str:
    return MONEY.format(c)


# Purchases with the clicks of the same user up to six hours before, whole seconds.
PAID = f"""
p AS (SELECT *, date_trunc('second', ts) AS s FROM events WHERE event_type = 'purchase'),
c AS (SELECT *, date_trunc('second', ts) AS s FROM ev WHERE event_type = 'click'),
paid AS (
  SELECT p.event_id AS pid, c.event_id AS did, p.user_id, c.k, p.value AS pv, c.value AS cv,
    p.s AS ps, c.s AS cs
  FROM p JOIN c ON p.user_id = c.user_id
  WHERE c.s BETWEEN p.s - INTERVAL {LOOKBACK_S} SECOND AND p.s)"""

# All product measures; texts are times at UTC+8, so they lie eight hours earlier.
PRODUCT_ROWS = """
li AS (SELECT *, l_shipdate - INTERVAL 8 HOUR AS tm FROM lineitem),
se AS (SELECT event_type, CAST(k AS BIGINT) AS sku, 1201 + k % 4 AS appraise,
         date_trunc('second', ts) - INTERVAL 8 HOUR AS tm FROM ev),
m AS (
  SELECT CAST(k AS BIGINT) AS sku, t AS tm, 'click_ct' AS name, 1.0::DECIMAL(18,2) AS v, NULL::BIGINT AS id FROM pl WHERE page_id = 'good_detail'
  UNION ALL SELECT x, make_timestamp(ts * 1000), 'display_ct', 1, NULL FROM shown WHERE item_type = 'sku_id'
  UNION ALL SELECT sku, tm, 'favor_ct', 1, NULL FROM se WHERE event_type = 'signup'
  UNION ALL SELECT sku, tm, 'cart_ct', 1, NULL FROM se WHERE event_type = 'purchase'
  UNION ALL SELECT sku, tm, 'comment_ct', 1, NULL FROM se WHERE event_type = 'error'
  UNION ALL SELECT sku, tm, 'good_comment_ct', 1, NULL FROM se WHERE event_type = 'error' AND appraise = 1201
  UNION ALL SELECT l_partkey, tm, 'order_sku_num', CAST(l_quantity AS DECIMAL(18,2)), NULL FROM li
  UNION ALL SELECT l_partkey, tm, 'order_amount', CAST(l_extendedprice AS DECIMAL(18,2)), l_orderkey FROM li
  UNION ALL SELECT l_partkey, tm, 'payment_amount', CAST(l_extendedprice AS DECIMAL(18,2)), l_orderkey FROM li WHERE l_linestatus = 'F'
  UNION ALL SELECT l_partkey, tm, 'refund_amount', CAST(l_extendedprice AS DECIMAL(18,2)), l_orderkey FROM li WHERE l_returnflag = 'R'),
daily AS (
  SELECT sku, date_trunc('day', tm) AS w,
""" + ",\n".join(
    f"    CAST(coalesce(sum(v) FILTER (name = '{n}'), 0) AS {t}) AS {n}" for n, t in (
        ("display_ct", "BIGINT"), ("click_ct", "BIGINT"), ("favor_ct", "BIGINT"),
        ("cart_ct", "BIGINT"), ("order_sku_num", "BIGINT"), ("order_amount", "DOUBLE"),
        ("payment_amount", "DOUBLE"), ("refund_amount", "DOUBLE"), ("comment_ct", "BIGINT"),
        ("good_comment_ct", "BIGINT"))
) + ",\n" + ",\n".join(
    f"    count(DISTINCT id) FILTER (name = '{n}') AS {c}" for n, c in (
        ("order_amount", "order_ct"), ("payment_amount", "paid_order_ct"),
        ("refund_amount", "refund_order_ct"))
) + """
  FROM m GROUP BY sku, date_trunc('day', tm))"""

WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"


def words(c: str) -> str:
    return f"unnest({WORDS.format(c)})"


def page_words(window_s: int, as_of: bool) -> str:
    ts = f", CAST({AS_OF_MS} AS BIGINT) AS ts" if as_of else ""
    return f"""
SELECT keyword, count(*) AS ct, 'SEARCH' AS source,
  strftime(make_timestamp(w * 1000000), {TXT}) AS stt,
  strftime(make_timestamp((w + {window_s}) * 1000000), {TXT}) AS edt{ts}
FROM (SELECT {words('item')} AS keyword, ts // 1000 // {window_s} * {window_s} AS w
      FROM pl WHERE page_id = 'good_list' AND item IS NOT NULL)
GROUP BY keyword, w"""


ORACLES: dict[str, str] = {
    "bounces": f"WITH {PL}, {BOUNCED} SELECT {FLAT} FROM bounced",
    "entry_pages": f"WITH {PL} SELECT {FLAT} FROM pl WHERE coalesce(last_page_id, '') = ''",
    "valid_pages": f"WITH {PL} SELECT {FLAT} FROM pl WHERE page_id <> ''",
    "unique_visits": f"""
WITH {PL} SELECT {FLAT} FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, CAST(t AS DATE) ORDER BY ts, event_id) AS rn
  FROM pl) WHERE rn = 1""",
    "unique_entry_visits": f"WITH {PL}, {VISITED} SELECT {FLAT} FROM visited",
    "repair_is_new": f"""
WITH {PL} SELECT event_id, mid, page_id, ts,
  CASE WHEN is_new = '1' AND CAST(t AS DATE) <> min(CASE WHEN is_new = '1' THEN CAST(t AS DATE) END)
    OVER (PARTITION BY mid) THEN '0' ELSE is_new END AS is_new
FROM pl""",
    "split_logs_start": f"""
WITH {PL} SELECT {FLAT}, 'icon' AS entry FROM pl WHERE event_type = 'signup' AND k < 98""",
    "split_logs_page": f"""
WITH {PL} SELECT event_id, mid, page_id, last_page_id, item, during_time, ts,
  CAST(CASE WHEN event_type = 'view' THEN k % 4 ELSE 0 END AS INTEGER) AS displays
FROM pl WHERE event_type <> 'signup' AND k < 98""",
    "split_logs_display": f"""
WITH {PL}, {SHOWN} SELECT shown.page_id, item_type, CAST(x AS VARCHAR) AS item
FROM shown JOIN pl USING (event_id) WHERE k < 98""",
    "quarantine": f"WITH {PL} SELECT event_id FROM pl WHERE k >= 98",
    "visitor_rows": f"""
WITH {PL}, {BOUNCED}, {VISITED}, {VISITOR_ROWS}
SELECT vc, ch, ar, is_new, CAST(uv_ct AS BIGINT) AS uv_ct, CAST(pv_ct AS BIGINT) AS pv_ct,
  CAST(sv_ct AS BIGINT) AS sv_ct, CAST(uj_ct AS BIGINT) AS uj_ct, dur_sum, ts FROM rows4""",
    "visitor_stats": f"WITH {PL}, {BOUNCED}, {VISITED}, {VISITOR_ROWS} {visitor_totals()}",
    "product_clicks_displays": f"""
WITH {PL}, {SHOWN}
SELECT CAST(k AS BIGINT) AS sku_id, CAST(1 AS BIGINT) AS click_ct, CAST(0 AS BIGINT) AS display_ct, ts
FROM pl WHERE page_id = 'good_detail'
UNION ALL SELECT CAST(x AS BIGINT), 0, 1, ts FROM shown WHERE item_type = 'sku_id'""",
    "product_page_rows": f"""
WITH {PL}, {SHOWN}
SELECT CAST(k AS BIGINT) AS sku_id, CAST(1 AS BIGINT) AS click_ct, CAST(0 AS BIGINT) AS display_ct, ts
FROM pl WHERE page_id = 'good_detail'
UNION ALL SELECT CAST(x AS BIGINT), 0, 1, ts FROM shown WHERE item_type = 'sku_id'""",
    "unreadable_products": f"""
WITH {PL} SELECT item, ts FROM pl WHERE try_cast(item AS BIGINT) IS NULL""",
    "route_cdc_facts": """
SELECT 'dwd_order_info' AS topic,
  '{"id":' || o_orderkey || ',"user_id":' || o_custkey || '}' AS value FROM orders""",
    "route_cdc_dims": """
SELECT 'dim_user_info' AS sink_table, 'id' AS sink_pk, 'insert' AS type,
  CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment,
  CAST(NULL AS VARCHAR) AS region_id FROM customer
UNION ALL SELECT 'dim_base_province', 'id', 'insert', CAST(n_nationkey AS VARCHAR), n_name, NULL, NULL
FROM nation""",
    "dim_rows": """
SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CAST(0 AS BIGINT) AS ts FROM nation""",
    "upsert_dim": """
SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
    "order_wide": f"""
WITH {WIDE} SELECT CAST(l_linenumber AS BIGINT) AS detail_id, o_orderkey AS order_id,
  l_partkey AS sku_id, {money('l_extendedprice')} AS order_price,
  CAST(l_quantity AS BIGINT) AS sku_num, o_orderstatus AS order_status, o_custkey AS user_id,
  o_custkey % 25 AS province_id, {money('o_totalprice')} AS total_amount,
  {money('o_totalprice')} AS original_total_amount, CAST(0 AS DOUBLE) AS feight_fee,
  {money('l_discount')} AS split_activity_amount, {money('l_tax')} AS split_coupon_amount,
  {money('l_extendedprice')} AS split_total_amount,
  strftime(o_orderdate, {TXT}) AS create_time, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
  strftime(o_orderdate, '%H') AS create_hour, CAST(NULL AS VARCHAR) AS expire_time,
  CAST(NULL AS VARCHAR) AS operate_time
FROM wide""",
    "order_wide_dims": f"""
WITH {WIDE} SELECT CAST(l_linenumber AS BIGINT) AS detail_id, o_orderkey AS order_id,
  l_partkey AS sku_id, {money('l_extendedprice')} AS order_price,
  CAST(floor(date_diff('day', DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER),
    DATE '2024-01-01') / 365) AS INTEGER) AS user_age,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' WHEN c_custkey IS NOT NULL THEN 'M' END AS user_gender,
  n.n_name AS province_name, CAST(n.n_regionkey AS VARCHAR) AS province_area_code,
  'N-' || n.n_nationkey AS province_iso_code, 'ISO-' || n.n_nationkey AS province_3166_2_code,
  p_partkey % 1000 AS spu_id, s_name AS spu_name, p_partkey % 7 AS tm_id, r_name AS tm_name,
  CAST(p_size AS BIGINT) AS category3_id, g.n_name AS category3_name
FROM wide LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation n ON n.n_nationkey = o_custkey % 25
LEFT JOIN part ON p_partkey = l_partkey
LEFT JOIN supplier ON s_suppkey = p_partkey % 1000
LEFT JOIN region ON r_regionkey = p_partkey % 7
LEFT JOIN nation g ON g.n_nationkey = p_size""",
    "day_precision_join": """
SELECT o_orderkey AS order_id, o_custkey AS detail_id, strftime(o_orderdate, '%Y-%m-%d') AS create_date
FROM orders
WHERE CAST(o_orderdate + (o_orderkey % 30) * INTERVAL 1 HOUR AS DATE) = CAST(o_orderdate AS DATE)""",
    "payment_wide": f"""
WITH {PL}, {PAID} SELECT pid AS payment_id, did AS detail_id, user_id AS order_id,
  CAST(k AS BIGINT) AS sku_id, user_id, {money('pv')} AS total_amount,
  {money('cv')} AS split_total_amount, 'purchase' AS subject, '1101' AS payment_type,
  strftime(ps, {TXT}) AS payment_create_time, strftime(ps, {TXT}) AS callback_time,
  strftime(cs, {TXT}) AS order_create_time
FROM paid""",
    "first_hit_lookup": """
SELECT c_custkey, c_nationkey, c_mktsegment, first_value(c_name) OVER (
  PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS first_name FROM customer""",
    "search_keywords": f"""
SELECT keyword, count(*) AS ct, 'SEARCH' AS source, strftime(w, {TXT}) AS stt,
  strftime(w + INTERVAL 1 DAY, {TXT}) AS edt, CAST({AS_OF_MS} AS BIGINT) AS ts
FROM (SELECT {words('p_name')} AS keyword, date_trunc('day', l_shipdate) AS w
      FROM lineitem JOIN part ON p_partkey = l_partkey)
GROUP BY keyword, w""",
    "page_keywords": f"WITH {PL} {page_words(3600, True)}",
    "sql_keywords": f"WITH {PL} {page_words(10, False)}",
    "tokenize_documents": f"""
SELECT keyword, count(*) AS ct FROM (SELECT {words('text')} AS keyword FROM documents)
GROUP BY keyword""",
    "product_stats": f"""
WITH {PL}, {SHOWN}, {PRODUCT_ROWS}
SELECT strftime(w, {TXT}) AS stt, strftime(w + INTERVAL 1 DAY, {TXT}) AS edt, sku AS sku_id,
  p_name AS sku_name, {money('p_retailprice')} AS sku_price, p_partkey % 1000 AS spu_id,
  s_name AS spu_name, p_partkey % 7 AS tm_id, r_name AS tm_name,
  CAST(p_size AS BIGINT) AS category3_id, n_name AS category3_name,
  display_ct, click_ct, favor_ct, cart_ct, order_sku_num, order_amount, order_ct, payment_amount,
  paid_order_ct, refund_order_ct, refund_amount, comment_ct, good_comment_ct,
  CAST({AS_OF_MS} AS BIGINT) AS ts
FROM daily LEFT JOIN part ON p_partkey = sku
LEFT JOIN supplier ON s_suppkey = p_partkey % 1000
LEFT JOIN region ON r_regionkey = p_partkey % 7
LEFT JOIN nation ON n_nationkey = p_size""",
    "product_keywords": f"""
WITH {PL}, {SHOWN}, {PRODUCT_ROWS},
pairs AS (
  SELECT sku, w, click_ct AS ct, 'CLICK' AS source FROM daily
  UNION ALL SELECT sku, w, cart_ct, 'CART' FROM daily
  UNION ALL SELECT sku, w, order_ct, 'ORDER' FROM daily)
SELECT {words('p_name')} AS keyword, ct, source, strftime(w, {TXT}) AS stt,
  strftime(w + INTERVAL 1 DAY, {TXT}) AS edt, CAST({AS_OF_MS} AS BIGINT) AS ts
FROM pairs JOIN part ON p_partkey = sku WHERE ct > 0""",
    "parse_times": f"""
SELECT o_orderkey, epoch_ms(date_trunc('day', tm)) AS day_ms,
  epoch_ms(tm - INTERVAL 8 HOUR) AS zone_ms, strftime(tm - INTERVAL 8 HOUR, '%Y%m%d') AS day,
  strftime(tm - INTERVAL 8 HOUR, {TXT}) AS rowtime, strftime(tm, {TXT}) AS again,
  CAST({AS_OF_MS} AS BIGINT) AS as_of
FROM (SELECT o_orderkey, o_orderdate + (o_orderkey % 86400) * INTERVAL 1 SECOND AS tm FROM orders)""",
    "code_labels": """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'unpaid' WHEN 'P' THEN 'paid'
  WHEN 'F' THEN 'finished' END AS label FROM orders""",
    "user_age": """
SELECT CAST(c_custkey AS VARCHAR) AS ID, CAST(floor(date_diff('day',
  DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER), DATE '2024-01-01') / 365) AS INTEGER) AS age
FROM customer""",
    "text_functions": """
SELECT o_orderkey, 'order_info:' || o_orderstatus AS key, o_orderstatus IN ('O', ' F', 'P') AS listed,
  o_orderstatus = 'O' AS blank FROM orders""",
    "snake_to_camel": """
SELECT o_orderkey AS "orderKey", o_custkey AS "userId", o_orderstatus AS "orderStatus" FROM orders""",
}

# Streams: the same rows without those still open when the input ends.
ORACLES |= {
    "stream_bounces": f"""
WITH {PL}, {BOUNCED} SELECT {FLAT} FROM bounced
WHERE (ts // {BOUNCE_MS} + 2) * {BOUNCE_MS} <= (SELECT max(ts) FROM pl)""",
    "stream_unique_visits": f"""
WITH {PL} SELECT DISTINCT mid, strftime(t, '%Y%m%d') AS day FROM pl""",
    "stream_repair_is_new": f"""
WITH {PL}, ok AS (SELECT * FROM pl WHERE k < 98) SELECT mid, page_id, ts,
  CASE WHEN is_new = '1' AND CAST(t AS DATE) <> min(CASE WHEN is_new = '1' THEN CAST(t AS DATE) END)
    OVER (PARTITION BY mid) THEN '0' ELSE is_new END AS is_new
FROM ok""",
    "stream_visitor_stats": f"""
WITH {PL}, {BOUNCED}, {VISITED}, {VISITOR_ROWS},
closed AS (SELECT least(
  (SELECT max(ts) FROM visited),
  (SELECT max(ts) FROM bounced
   WHERE (ts // {BOUNCE_MS} + 2) * {BOUNCE_MS} <= (SELECT max(ts) FROM pl))) - 2000 AS ms)
SELECT * EXCLUDE (uv_ct) FROM (
  {visitor_totals("WHERE epoch_us(w + INTERVAL 1 HOUR) // 1000 <= (SELECT ms FROM closed)")})""",
    "stream_search_keywords": f"""
WITH {PL} SELECT * FROM ({page_words(3600, True)})
WHERE CAST(edt AS TIMESTAMP) <= (
  SELECT max(date_trunc('second', t)) FROM pl WHERE page_id = 'good_list') - INTERVAL 2 SECOND""",
    "stream_order_wide": f"""
WITH {WIDE} SELECT CAST(l_linenumber AS BIGINT) AS detail_id, o_orderkey AS order_id,
  l_partkey AS sku_id, {money('l_extendedprice')} AS order_price,
  strftime(o_orderdate, {TXT}) AS create_time FROM wide""",
    "stream_payment_wide": f"""
WITH {PL}, {PAID} SELECT pid AS payment_id, did AS detail_id, user_id AS order_id FROM paid""",
    "stream_product_stats": f"""
WITH {PL}, {SHOWN}, {PRODUCT_ROWS}
SELECT strftime(w, {TXT}) AS stt, strftime(w + INTERVAL 1 DAY, {TXT}) AS edt, sku AS sku_id,
  order_ct, order_sku_num, order_amount, refund_order_ct, refund_amount
FROM daily
WHERE order_ct > 0 AND w + INTERVAL 1 DAY <= least(
  (SELECT max(tm) FROM li), (SELECT max(tm) FROM li WHERE l_returnflag = 'R')) - INTERVAL 2 SECOND""",
    "job_user_log": f"""
WITH {PL}, {SHOWN}
SELECT 'dwd_start_log' AS topic, count(*) AS records FROM pl WHERE event_type = 'signup' AND k < 98
UNION ALL SELECT 'dwd_page_log', count(*) FROM pl WHERE event_type <> 'signup' AND k < 98
UNION ALL SELECT 'dwd_display_log', count(*) FROM shown JOIN pl USING (event_id) WHERE k < 98
UNION ALL SELECT 'dwd_quarantine', count(*) FROM pl WHERE k >= 98""",
    "job_business_facts": """
SELECT '{"id":' || o_orderkey || ',"user_id":' || o_custkey || '}' AS value FROM orders""",
    "job_business_dims": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(0 AS BIGINT) AS ts FROM customer
UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, 0 FROM nation""",
}

ORACLES |= {
    "job_dim_updates": """
SELECT coalesce(CAST(o_custkey AS VARCHAR), CAST(c_custkey AS VARCHAR)) AS id,
  coalesce(o_orderstatus, c_name) AS name,
  coalesce(CAST(o_orderkey AS VARCHAR), c_mktsegment) AS segment, coalesce(ts, 0) AS ts
FROM customer FULL JOIN (
  SELECT *, epoch_ms(o_orderdate) + o_orderkey % 86400000 AS ts, row_number() OVER (
    PARTITION BY o_custkey ORDER BY epoch_ms(o_orderdate) + o_orderkey % 86400000 DESC) AS rn
  FROM orders) o ON o_custkey = c_custkey
WHERE rn = 1 OR rn IS NULL""",
}

ORACLES |= {
    # The same bounces with times cut to the hour; equal times count in order of the id.
    "job_user_jump": f"""
WITH {PL}, cut AS (SELECT * REPLACE (ts // 3600000 * 3600000 AS ts) FROM pl),
b AS (SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, event_id) AS nxt FROM cut)
SELECT mid, is_new, vc, ch, ar, page_id, last_page_id, item, during_time, ts,
  CAST(CASE WHEN event_type = 'view' THEN k % 4 ELSE 0 END AS INTEGER) AS displays
FROM b WHERE coalesce(last_page_id, '') = '' AND (nxt IS NULL OR nxt - ts >= {BOUNCE_MS})
  AND (ts // {BOUNCE_MS} + 2) * {BOUNCE_MS} <= (SELECT max(ts) FROM cut)""",
    "job_payment_wide": f"""
SELECT o_orderkey * 10 AS payment_id, o_orderstatus AS subject, '1101' AS payment_type,
  strftime(o_orderdate, {TXT}) AS payment_create_time,
  strftime(o_orderdate + INTERVAL 30 DAY, {TXT}) AS callback_time,
  CAST(l_linenumber AS BIGINT) AS detail_id, o_orderkey AS order_id, l_partkey AS sku_id,
  CAST(l_quantity AS BIGINT) AS sku_num, o_custkey AS user_id, {money('o_totalprice')} AS total_amount,
  {money('l_extendedprice')} AS split_total_amount, strftime(l_shipdate, {TXT}) AS order_create_time
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY""",
    "job_order_wide": ORACLES["order_wide_dims"],
    "stream_late_rows": f"""
WITH {PL}, a AS (
  SELECT *, date_trunc('hour', t) AS w, least(3, (day(t) - 1) // 8 + CASE WHEN event_id % 50 = 0
    THEN 2 WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS b FROM pl),
marks AS (  -- by batch, how far the batches before it bring the watermark
  SELECT b.b, (SELECT max(ts) FROM a WHERE a.b < b.b) - 86400000 AS ms
  FROM (SELECT DISTINCT b FROM a) b),
judged AS (
  SELECT a.*, coalesce(epoch_ms(w + INTERVAL 1 HOUR) <= ms, FALSE) AS late FROM a JOIN marks USING (b))
SELECT event_id, mid, ch, ts, CAST(1 AS BIGINT) AS ct FROM judged WHERE late
UNION ALL
SELECT NULL, NULL, ch, epoch_ms(w), count(*) FROM judged WHERE NOT late
  AND epoch_ms(w + INTERVAL 1 HOUR) <= (SELECT max(ts) FROM a) - 86400000
GROUP BY w, ch""",
}

ORACLES |= {
    "route_as_of": """
WITH changes AS (
  SELECT 'order_info' AS tbl, epoch_ms(o_orderdate) AS ts, CAST(o_orderkey AS VARCHAR) AS id,
    CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS status, NULL AS name FROM orders
  UNION ALL SELECT 'user_info', 0, CAST(c_custkey AS VARCHAR), NULL, NULL, c_name FROM customer),
dated AS (SELECT *, CASE WHEN ts < 858124800000 THEN 0
  WHEN ts < 927244800000 THEN 1 ELSE 2 END AS v FROM changes)
SELECT CASE WHEN v = 2 OR tbl = 'user_info' THEN 'hbase' ELSE 'kafka' END AS sink_type,
  CASE WHEN tbl = 'user_info' THEN 'users'
    ELSE ['orders_old', 'orders_new', 'orders_dim'][v + 1] END AS sink_table,
  'id' AS sink_pk, 'insert' AS type, ts, id,
  CASE WHEN v <> 1 THEN user_id END AS user_id, CASE WHEN v > 0 THEN status END AS status,
  CASE WHEN v = 0 THEN name END AS name
FROM dated WHERE NOT (tbl = 'user_info' AND v = 2)""",
    "job_user_log_once": f"""
WITH {PL}, {SHOWN}, ok AS (SELECT * FROM pl WHERE k < 98),
flags AS (SELECT * REPLACE (CASE WHEN is_new = '1' AND CAST(t AS DATE) <> min(
    CASE WHEN is_new = '1' THEN CAST(t AS DATE) END) OVER (PARTITION BY mid)
  THEN '0' ELSE is_new END AS is_new) FROM ok)
SELECT CASE WHEN event_type = 'signup' THEN 'start' ELSE 'page' END AS topic, mid, is_new, vc, ch, ar,
  page_id, item, during_time, ts FROM flags
UNION ALL SELECT 'display', NULL, NULL, NULL, item_type, NULL, shown.page_id, CAST(x AS VARCHAR),
  NULL, NULL FROM shown JOIN pl USING (event_id) WHERE k < 98
UNION ALL SELECT 'quarantine', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 30 FROM pl WHERE k = 99
UNION ALL SELECT 'quarantine', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  length('{{"page":{{"page_id":"' || page_id || '"'
    || coalesce(',"last_page_id":"' || last_page_id || '"', '') || ',"item":"' || item
    || '","during_time":' || during_time || '}},"ts":' || ts || '}}') FROM pl WHERE k = 98""",
}

ORACLES |= {
    "distinct_orders_rolled_up": """
SELECT (epoch_ms(l_shipdate) // 2592000000) * 2592000000 AS start_ms, l_linenumber % 3 AS mode,
  count(DISTINCT l_orderkey) AS l_orderkey_exact, count(DISTINCT l_partkey) AS l_partkey_exact,
  TRUE AS l_orderkey_near, TRUE AS l_partkey_near
FROM lineitem GROUP BY ALL""",
    "unique_visit_state": f"""
WITH {PL} SELECT DISTINCT mid, strftime(t, '%Y%m%d') AS day,
  epoch_ms(date_trunc('day', t)) + 3 * 86400000 AS expires_ms FROM pl
WHERE date_trunc('day', t) + INTERVAL 3 DAY
  > (SELECT max(date_trunc('day', t)) FROM pl) - INTERVAL 3 DAY""",
}

SEQUENCE = f"""
WITH e AS (
  SELECT *, epoch_us(ts) // 1000 AS ms, lead(epoch_us(ts) // 1000) OVER w AS next_ms,
    lead(event_type) OVER w AS next_type, lead(event_id) OVER w AS next_id
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id)),
found AS (
  SELECT ms, event_id, next_id,
    CASE WHEN next_ms IS NULL OR next_ms - ms >= {BOUNCE_MS} THEN 'timed_out'
         WHEN next_type = 'click' THEN 'matched' END AS outcome
  FROM e WHERE event_type = 'view')
SELECT outcome, CASE outcome WHEN 'matched' THEN 2 ELSE 1 END AS length, event_id AS first,
  CASE outcome WHEN 'matched' THEN next_id END AS second
FROM found WHERE outcome IS NOT NULL"""

ORACLES |= {
    "view_then_click": SEQUENCE,
    "stream_view_then_click": f"""{SEQUENCE}
  AND (ms // {BOUNCE_MS} + 2) * {BOUNCE_MS} <= (SELECT max(epoch_us(ts) // 1000) FROM events)""",
    "bucketed_lookup": """
SELECT l_orderkey, l_linenumber, l_partkey, p_name AS part_name, p_retailprice AS price
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
}

# Events 24 years earlier, in the time of the line items.
EARLY = PL.replace("FROM events", "FROM (SELECT * REPLACE (ts - INTERVAL 8766 DAY AS ts) FROM events)")

ORACLES |= {
    "job_search_keyword": ORACLES["stream_search_keywords"],
    "job_product_keyword": ORACLES["product_keywords"],
    "sql_product_keywords": ORACLES["product_keywords"],
    "job_product_stats": ORACLES["product_stats"].replace(PL, EARLY) + f"""
WHERE w + INTERVAL 1 DAY <= (SELECT least(
  (SELECT max(make_timestamp(ts * 1000)) FROM (
    SELECT ts FROM pl WHERE page_id = 'good_detail'
    UNION ALL SELECT ts FROM shown WHERE item_type = 'sku_id')),
  (SELECT max(tm) FROM se WHERE event_type = 'signup'),
  (SELECT max(tm) FROM se WHERE event_type = 'purchase'),
  (SELECT max(tm) FROM se WHERE event_type = 'error'), (SELECT max(tm) FROM li),
  (SELECT max(tm) FROM li WHERE l_linestatus = 'F'),
  (SELECT max(tm) FROM li WHERE l_returnflag = 'R')) - INTERVAL 2 SECOND)""",
}
