"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from lakeloom.operators.quality import EMAIL, PHONE

M = "DECIMAL(18,2)"


def money(x: str) -> str:
    return f"CAST({x} AS {M})"


def total(x: str) -> str:
    return money(f"sum({x})")


DEDUP = """latest AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
    l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
    FROM lineitem) WHERE rn = 1)"""
LINES = f"""{DEDUP}, lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_line_number, l_partkey AS product_id, l_suppkey AS location_id, CAST(l_quantity AS BIGINT) AS quantity,
    {money('floor(round(l_extendedprice * 100) / l_quantity) / 100')} AS unit_price, {money('l_extendedprice')} AS gross_amount, {money(money('l_extendedprice') + ' * CAST(l_discount AS DECIMAL(4,2))')} AS discount_amount,
    {money(money('l_extendedprice') + ' * CAST(l_tax AS DECIMAL(4,2))')} AS tax_amount, l_returnflag AS return_flag, l_shipdate AS shipped_at FROM latest)"""
CUSTOMERS = f"""customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_name || '@example.com' AS email, lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS postal_code,
    c_mktsegment AS customer_segment, n_name AS nation, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""
ORDERS = f"""{CUSTOMERS}, o AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date, CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'F' THEN 'DELIVERED' ELSE 'PLACED' END AS order_status,
    {money('o_totalprice')} AS total, c.region, c.customer_segment,
    o_orderkey % 10 + 1 AS store_id, CASE WHEN o_orderkey % 3 = 0 THEN 'P' || CAST(o_orderkey % 5 AS VARCHAR) END AS promotion_id, CASE WHEN o_orderkey % 7 = 0 THEN 'RETRIED' ELSE 'CAPTURED' END AS payment_status FROM orders LEFT JOIN customers c ON o_custkey = c.customer_id)"""
DATE_KEY = "CAST(strftime({}, '%Y%m%d') AS INTEGER)"
SALES = f"""{LINES}, {ORDERS}, sales AS (
  SELECT l.* EXCLUDE (location_id, return_flag, shipped_at), {money('gross_amount - discount_amount')} AS net_amount, o.customer_id, o.order_date, o.order_status, o.region, o.customer_segment, o.store_id, o.promotion_id, o.payment_status,
    {DATE_KEY.format('o.order_date')} AS date_key, o.order_status = 'CANCELLED' AS is_cancelled, p_type AS category_id, p_type AS category_name, p_brand AS brand, p_name AS product_name,
    CAST(o.order_date AS DATE) AS full_date, CAST(year(o.order_date) AS INTEGER) AS year, CAST(month(o.order_date) AS INTEGER) AS month_number
  FROM lines l JOIN o ON l.order_id = o.order_id LEFT JOIN part ON l.product_id = p_partkey), sold AS (SELECT * FROM sales WHERE NOT is_cancelled)"""
RETURNS = """returns AS (SELECT order_id, order_line_number, product_id, quantity, ['DAMAGED', 'WRONG ITEM', 'CHANGED MIND'][order_line_number % 3 + 1] AS return_reason, gross_amount AS refund_amount, shipped_at + INTERVAL 14 DAY AS return_date FROM lines WHERE return_flag = 'R')"""
DATED = f"{RETURNS}, dated AS (SELECT r.*, o.order_date FROM returns r JOIN o ON r.order_id = o.order_id WHERE o.order_status <> 'CANCELLED')"
SHIPMENTS = "shipments AS (SELECT order_id, shipped_at, shipped_at + to_days(CAST(order_line_number AS INTEGER)) AS delivered_at FROM lines)"
PAYMENTS = """payments AS (
  SELECT CAST(order_id AS VARCHAR) || '-1' AS payment_id, order_id, 1 AS attempt_number, CASE WHEN order_id % 7 = 0 THEN 'FAILED' ELSE 'CAPTURED' END AS payment_status, total AS payment_amount, order_date + INTERVAL 1 DAY AS paid_at FROM o
  UNION ALL SELECT CAST(order_id AS VARCHAR) || '-2', order_id, 2, 'CAPTURED', total, order_date + INTERVAL 2 DAY FROM o WHERE order_id % 7 = 0)"""
INVENTORY = f"""stock AS (
  SELECT CAST(shipped_at AS DATE) AS snapshot_date, product_id, location_id, greatest(0, 50 - CAST(sum(quantity) AS BIGINT)) AS quantity_on_hand FROM lines GROUP BY ALL
), inventory AS (
  SELECT {DATE_KEY.format('snapshot_date')} AS date_key, product_id, location_id, quantity_on_hand, quantity_on_hand // 10 AS quantity_reserved, quantity_on_hand - quantity_on_hand // 10 AS quantity_available,
    quantity_on_hand - quantity_on_hand // 10 <= 0 AS is_stockout, quantity_on_hand - quantity_on_hand // 10 <= 10 AS is_below_reorder, snapshot_date, CAST(10 AS BIGINT) AS reorder_point FROM stock)"""
HOURS = "CAST(trunc((epoch({1}) - epoch({0})) / 3600) AS INTEGER)"
FULFILL = f"""{LINES}, {ORDERS}, {SHIPMENTS}, {RETURNS}, {PAYMENTS}, fulfillment AS (
  SELECT o.order_id, o.order_status, {DATE_KEY.format('o.order_date')} AS date_key, p.paid_at, s.shipped_at, s.delivered_at, r.returned_at,
    CASE WHEN o.order_status = 'CANCELLED' THEN o.order_date END AS cancelled_at, {HOURS.format('o.order_date', 's.shipped_at')} AS hours_to_ship, {HOURS.format('o.order_date', 's.delivered_at')} AS hours_to_deliver,
    o.order_date AS placed_at, o.store_id, n.order_line_count, n.order_net_amount
  FROM o LEFT JOIN (SELECT order_id, count(*) AS order_line_count, {total('gross_amount - discount_amount')} AS order_net_amount FROM lines GROUP BY order_id) n ON o.order_id = n.order_id
  LEFT JOIN (SELECT order_id, min(shipped_at) AS shipped_at, max(delivered_at) AS delivered_at FROM shipments GROUP BY order_id) s ON o.order_id = s.order_id
  LEFT JOIN (SELECT order_id, min(paid_at) AS paid_at FROM payments WHERE payment_status = 'CAPTURED' GROUP BY order_id) p ON o.order_id = p.order_id
  LEFT JOIN (SELECT order_id, min(return_date) AS returned_at FROM returns GROUP BY order_id) r ON o.order_id = r.order_id)"""
TOTALS = f"""{total('gross_amount')} AS gross_revenue, {total('discount_amount')} AS discount_total, {total('net_amount')} AS net_revenue, {total('tax_amount')} AS tax_total,
  CAST(sum(quantity) AS BIGINT) AS units, count(DISTINCT order_id) AS orders"""
LIFETIME = f"""lifetime AS (
  SELECT s.*, CAST(lifetime_value AS DOUBLE) / total_orders AS avg_order_value, CAST(date_diff('day', last_order_date, DATE '1999-01-01') AS INTEGER) AS days_since_last_order, total_orders > 1 AS is_repeat_customer, c.customer_segment, c.region
  FROM (SELECT customer_id, count(DISTINCT order_id) AS total_orders, {total('net_amount')} AS lifetime_value, CAST(min(order_date) AS DATE) AS first_order_date, CAST(max(order_date) AS DATE) AS last_order_date FROM sold GROUP BY customer_id) s
  LEFT JOIN customers c ON s.customer_id = c.customer_id)"""
COHORT = f"""signups AS (SELECT o_custkey AS customer_id, CAST(min(o_orderdate) AS DATE) AS signup_date FROM orders GROUP BY 1), cohort AS (
  SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month, CAST(date_diff('month', date_trunc('month', signup_date), date_trunc('month', order_date)) AS INTEGER) AS months_since_signup,
    count(DISTINCT s.customer_id) AS active_customers, count(DISTINCT order_id) AS orders, {total('net_amount')} AS net_revenue FROM sold s JOIN signups g ON s.customer_id = g.customer_id WHERE date_trunc('month', order_date) >= date_trunc('month', signup_date) GROUP BY 1, 2)"""
PERFORMANCE = f"""out_ AS (
  SELECT date_key, product_id, CAST(sum(quantity) AS BIGINT) AS units_sold, {total('net_amount')} AS net_revenue, count(DISTINCT order_id) AS orders, {money('coalesce(sum(net_amount) FILTER (WHERE promotion_id IS NOT NULL), 0)')} AS promo_revenue FROM sold GROUP BY 1, 2
), back AS (SELECT {DATE_KEY.format('order_date')} AS date_key, product_id, CAST(sum(quantity) AS BIGINT) AS units_returned FROM dated GROUP BY 1, 2), performance AS (
  SELECT coalesce(s.date_key, r.date_key) AS date_key, coalesce(s.product_id, r.product_id) AS product_id, coalesce(units_sold, 0) AS units_sold, {money('coalesce(net_revenue, 0)')} AS net_revenue, coalesce(orders, 0) AS orders, {money('coalesce(promo_revenue, 0)')} AS promo_revenue,
    coalesce(units_returned, 0) AS units_returned, CAST(coalesce(units_returned, 0) AS DOUBLE) / nullif(coalesce(units_sold, 0), 0) AS return_rate FROM out_ s FULL JOIN back r ON s.date_key = r.date_key AND s.product_id = r.product_id)"""
STORES = "stores AS (SELECT s_suppkey AS store_id, s_name AS store_name, r_name AS region FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"
STOCK = f"""{LINES}, {INVENTORY}, {STORES}, shelf AS (
  SELECT i.*, i.snapshot_date AS full_date, p_name AS product_name, p_brand AS brand, p_type AS category_name, t.store_name, t.region FROM inventory i LEFT JOIN part ON product_id = p_partkey LEFT JOIN stores t ON location_id = t.store_id)"""
CHANGES = """changes AS (
  SELECT o_orderkey AS k, 'c' AS op, o_orderkey * 10 AS lsn, o_orderstatus AS status, o_totalprice AS total FROM orders
  UNION ALL SELECT o_orderkey, 'u', o_orderkey * 10 + 5, 'X', o_totalprice * 2 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, 'u', o_orderkey * 10 - 1, 'S', o_totalprice FROM orders WHERE o_orderkey % 4 = 0
  UNION ALL SELECT o_orderkey, 'd', o_orderkey * 10 + 7, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 = 0
), latest_changes AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lsn DESC) AS rn FROM changes) WHERE rn = 1)"""
STATE = """state AS (SELECT o_orderkey AS k, 'OLD' AS status, o_totalprice AS total, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey * 10 + 6 WHEN o_orderkey % 7 <> 0 THEN o_orderkey * 10 - 5 END AS lsn FROM orders WHERE o_orderkey % 2 = 0)"""
SNAPSHOT = """before AS (SELECT p_partkey, p_brand, p_retailprice FROM part), after AS (
  SELECT p_partkey, p_brand, CASE WHEN p_partkey % 5 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice FROM part WHERE p_partkey % 13 <> 0
  UNION ALL SELECT p_partkey + 1000000, p_brand, p_retailprice FROM part WHERE p_partkey % 100 = 0)"""


def versions(extra: str = "") -> str:
    return f"""{CUSTOMERS}, history AS (
  SELECT customer_id, customer_segment, region, TIMESTAMP '1996-01-01' AS changed_at FROM customers
  UNION ALL SELECT customer_id, customer_segment, region, TIMESTAMP '1996-06-01' FROM customers
  UNION ALL SELECT customer_id, customer_segment, 'MOVED', TIMESTAMP '1997-01-01' FROM customers WHERE customer_id % 3 = 0
  UNION ALL SELECT customer_id, customer_segment, region, TIMESTAMP '1998-01-01' FROM customers WHERE customer_id % 9 = 0 {extra}
), marked AS (
  SELECT *, lag(region) OVER w AS before, row_number() OVER w AS rn FROM history WINDOW w AS (PARTITION BY customer_id ORDER BY changed_at)
), versions AS (
  SELECT customer_id, customer_segment, region, CASE WHEN rn = 1 THEN TIMESTAMP '1900-01-01' ELSE changed_at END AS effective_start_ts,
    coalesce(lead(changed_at) OVER w, TIMESTAMP '9999-12-31 23:59:59') AS effective_end_ts, lead(changed_at) OVER w IS NULL AS is_current
  FROM marked WHERE rn = 1 OR before <> region WINDOW w AS (PARTITION BY customer_id ORDER BY changed_at))"""


RUNS = """runs AS (
  SELECT event_type AS stage, 'entity_' || CAST(user_id % 12 AS VARCHAR) AS entity, CASE WHEN event_id % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status, event_id % 100 AS duration_s, event_id % 1000 + 5 AS rows_in, event_id % 1000 AS rows_out,
    event_id % 5 AS rows_quarantined, CAST(ts AS DATE) AS run_date, ts AS started_at, ts AS ended_at FROM events)"""
RESULTS = """results AS (
  SELECT 'entity_' || CAST(user_id % 12 AS VARCHAR) AS entity, CASE event_id % 3 WHEN 0 THEN 'fatal' WHEN 1 THEN 'error' ELSE 'warn' END AS severity,
    CASE WHEN event_id % 20 = 0 THEN 'FAILED' WHEN event_id % 50 = 1 THEN 'SKIPPED' ELSE 'PASSED' END AS status, event_type AS rule, 'range' AS type, CAST(event_id % 4 AS DOUBLE) / 4 AS pass_rate, ts AS checked_at FROM events)"""
CHECKS = f"""checks AS (
  SELECT event_type AS check_name, 'entity_' || CAST(user_id % 12 AS VARCHAR) AS entity, 'silver' AS source_layer, 'gold' AS target_layer, {money('event_id')} AS source_value, {money('event_id - event_id % 30')} AS target_value,
    {money('event_id % 30')} AS difference, {money('20')} AS tolerance, CASE WHEN event_id % 30 > 20 THEN 'FAILED' ELSE 'PASSED' END AS status, ts AS checked_at FROM events)"""
FRESH = """hours AS (SELECT entity, stage, max(ended_at) AS last_success, CAST(trunc((epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(max(ended_at)))) / 3600) AS INTEGER) AS hours_since FROM {} WHERE status = 'SUCCESS' GROUP BY 1, 2),
  fresh AS (SELECT *, CASE WHEN hours_since > 48 THEN 'BREACH' WHEN hours_since > 26 THEN 'WARN' ELSE 'OK' END AS status FROM hours)"""
SINCE = "TIMESTAMP '2024-01-25'"
BAD_LINE = "(l_quantity < 2 OR l_quantity > 49 OR l_discount >= 0.095)"


def hashed(columns: list[str]) -> str:
    parts = ", chr(1), ".join(f"coalesce(trim(CAST({c} AS VARCHAR)), '␀')" for c in columns)
    return f"sha256(concat({parts}))"


def recon(check: str, entity: str, a: str, b: str, ok: str) -> str:
    return f"'{check}' AS check_name, '{entity}' AS entity, {money(a)} AS source_value, {money(b)} AS target_value, {money(f'{money(a)} - {money(b)}')} AS difference, CASE WHEN {ok} THEN 'PASSED' ELSE 'FAILED' END AS status"


LINE_COLUMNS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

SQL = {
    "dedup_latest": f"WITH {DEDUP} SELECT * FROM latest",
    "dedup_report": f"SELECT count(*) AS rows_in, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_keys, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {LINE_COLUMNS} FROM lineitem)) AS exact_duplicates FROM lineitem",
    "exact_duplicates": f"SELECT {hashed(['text'])} AS record_hash, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1",
    "dup_count_window": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "dq_not_null_range_domain": """SELECT 'customer_present' AS rule, count(*) AS violations FROM orders WHERE o_orderkey % 11 = 0 HAVING count(*) > 0
      UNION ALL SELECT 'total_range', count(*) FROM orders WHERE o_totalprice < 1000 OR o_totalprice > 400000 HAVING count(*) > 0
      UNION ALL SELECT 'status_domain', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O') HAVING count(*) > 0""",
    "dq_regex_pii": f"SELECT * FROM (SELECT doc_id, coalesce(regexp_matches(text, '{EMAIL}') OR regexp_matches(text, '{PHONE}'), false) AS has_pii, coalesce(NOT regexp_matches(text, '^[A-Z]'), false) AS no_capital FROM documents) WHERE has_pii OR no_capital",
    "dq_expression_nullsafe": "SELECT count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS quarantined FROM (SELECT coalesce(o_totalprice / nullif(o_custkey % 10, 0) > 5000, true) AS ok FROM orders)",
    "dq_unique": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "dq_referential": "SELECT o_orderkey, customer FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS customer FROM orders) WHERE customer NOT IN (SELECT c_custkey FROM customer)",
    "dq_freshness": "SELECT age_hours, age_hours > 26 AS is_late FROM (SELECT CAST(floor(epoch(TIMESTAMP '2024-02-01')) - floor(epoch(max(ts))) AS DOUBLE) / 3600.0 AS age_hours FROM events)",
    "dq_volume": """SELECT day, rows, mean, coalesce(abs(rows - mean) <= 0.5 * mean, true) AS is_ok FROM (SELECT day, rows, CAST(sum(rows) OVER w AS DOUBLE) / nullif(count(*) OVER w, 0) AS mean
      FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY 1) WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
    "dq_route_split": f"""SELECT coalesce(a.l_returnflag, b.l_returnflag) AS l_returnflag, valid, warned, quarantined FROM
      (SELECT l_returnflag, count(*) AS valid, count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS warned FROM lineitem WHERE NOT {BAD_LINE} GROUP BY 1) a
      FULL JOIN (SELECT l_returnflag, count(*) AS quarantined FROM lineitem WHERE {BAD_LINE} GROUP BY 1) b ON a.l_returnflag = b.l_returnflag""",
    "dq_failed_rules": f"""WITH {DEDUP} SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_quantity < 2 OR l_quantity > 49 THEN 'quantity_range' END, CASE WHEN l_discount >= 0.095 THEN 'discount_small' END) AS failed_rules,
      CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'flag_domain' ELSE '' END AS warnings FROM latest WHERE {BAD_LINE}""",
    "lake_full_load": "SELECT p_partkey AS product_id, CASE WHEN p_partkey % 13 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 5 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS price, p_partkey % 13 = 0 AS is_deleted FROM part",
    "lake_two_snapshots": "SELECT p_partkey AS product_id, CASE WHEN p_partkey % 13 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 5 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS price, p_partkey % 13 = 0 AS is_deleted FROM part",
    "lake_scd2_valid_only": """SELECT p_partkey AS product_id, p_retailprice AS price, NOT (p_partkey % 13 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 5 = 0) AS is_current, p_partkey % 13 = 0 AS is_deleted FROM part
      UNION ALL SELECT p_partkey, p_retailprice + 1, true, false FROM part WHERE p_partkey % 13 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 5 = 0""",
    "cdc_unwrap": f"""WITH {CHANGES} SELECT k AS order_id, status, total, op AS _op, lsn AS _source_lsn, op = 'd' AS _is_delete, false AS _is_snapshot FROM changes""",
    "cdc_apply": f"""WITH {CHANGES}, {STATE} SELECT coalesce(c.k, s.k) AS order_id, CASE WHEN takes THEN c.status ELSE s.status END AS status, CASE WHEN takes THEN c.total ELSE s.total END AS total,
      CASE WHEN takes THEN c.lsn ELSE s.lsn END AS _source_lsn, CASE WHEN takes THEN c.op = 'd' ELSE false END AS is_deleted
      FROM (SELECT k, op, lsn, status, total FROM latest_changes) c FULL JOIN state s ON c.k = s.k, LATERAL (SELECT c.k IS NOT NULL AND (s.k IS NULL OR s.lsn IS NULL OR c.lsn >= s.lsn) AS takes)""",
    "merge_metrics": f"""WITH {CHANGES}, {STATE} SELECT count(*) FILTER (WHERE s.k IS NULL) AS inserted, count(*) FILTER (WHERE s.k IS NOT NULL AND (s.lsn IS NULL OR c.lsn >= s.lsn)) AS updated,
      count(*) FILTER (WHERE s.k IS NOT NULL AND c.lsn < s.lsn) AS ignored FROM latest_changes c LEFT JOIN state s ON c.k = s.k""",
    "lake_merge_counts": f"""WITH {CHANGES}, {STATE} SELECT count(*) FILTER (WHERE c.k IS NOT NULL AND s.k IS NULL) AS inserted, count(*) FILTER (WHERE c.k IS NOT NULL AND s.k IS NOT NULL AND (s.lsn IS NULL OR c.lsn >= s.lsn)) AS updated,
      count(*) FILTER (WHERE s.k IS NOT NULL AND c.lsn < s.lsn) AS ignored, count(*) AS rows FROM latest_changes c FULL JOIN state s ON c.k = s.k""",
    "lake_change_feed": f"""WITH {CHANGES}, {STATE} SELECT c.k AS order_id, c.status, c.lsn AS _source_lsn, CASE WHEN s.k IS NULL THEN 'insert' ELSE 'update' END AS change_type
      FROM latest_changes c LEFT JOIN state s ON c.k = s.k WHERE c.k % 5 = 0 AND (s.k IS NULL OR s.lsn IS NULL OR c.lsn >= s.lsn) AND (s.k IS NULL OR c.status IS DISTINCT FROM s.status OR c.total IS DISTINCT FROM s.total OR c.lsn IS DISTINCT FROM s.lsn)""",
    "lake_rescued_data": """SELECT o_orderkey AS id, o_custkey AS total, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS rescued, '2024-01-01' AS batch FROM orders WHERE o_orderkey % 3 = 0
      UNION ALL SELECT o_orderkey + 3000000000, o_custkey, o_orderstatus, NULL, '2024-01-02' FROM orders WHERE o_orderkey % 3 = 1
      UNION ALL SELECT CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END, CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 10 <> 0 THEN o_custkey END, NULL,
        CASE WHEN o_orderkey % 11 = 0 THEN '{"_broken":"order ' || o_orderkey || '"}' WHEN o_orderkey % 10 = 0 THEN '{"total":"about ' || o_custkey || '"}' END, '2024-01-03' FROM orders WHERE o_orderkey % 3 = 2""",
    "cdc_soft_delete": f"WITH {CHANGES} SELECT k AS order_id, true AS is_deleted, TIMESTAMP '2024-02-01' AS deleted_at FROM latest_changes WHERE op = 'd'",
    "cdc_changed_columns": """SELECT o_orderkey AS order_id, o_orderkey * 10 + 5 AS lsn, 'status' || CASE WHEN o_totalprice * 2 <> o_totalprice THEN ',total' ELSE '' END AS changed FROM orders WHERE o_orderkey % 3 = 0
      UNION ALL SELECT o_orderkey, o_orderkey * 10 - 1, 'status' FROM orders WHERE o_orderkey % 4 = 0""",
    "cdc_split_deletes": f"WITH {CHANGES} SELECT count(*) FILTER (WHERE op <> 'd') AS live, count(*) FILTER (WHERE op = 'd') AS deletes FROM changes",
    "snapshot_diff": f"""WITH {SNAPSHOT} SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, coalesce(a.p_retailprice, b.p_retailprice) AS p_retailprice,
      CASE WHEN b.p_partkey IS NULL THEN 'insert' WHEN a.p_partkey IS NULL THEN 'delete' ELSE 'update' END AS change_type
      FROM before b FULL JOIN after a ON a.p_partkey = b.p_partkey WHERE a.p_partkey IS NULL OR b.p_partkey IS NULL OR a.p_retailprice <> b.p_retailprice""",
    "full_load_deletes": f"""WITH {SNAPSHOT} SELECT p_partkey, p_retailprice, false AS is_deleted FROM after UNION ALL SELECT p_partkey, p_retailprice, true FROM before WHERE p_partkey NOT IN (SELECT p_partkey FROM after)""",
    "standardise_codes": "SELECT c_custkey, upper(c_mktsegment) AS customer_segment, CASE WHEN c_custkey % 4 <> 0 THEN trim(c_name) END AS name FROM customer",
    "scd1_merge": f"""SELECT p_partkey AS product_id, CASE WHEN p_partkey % 3 = 0 THEN p_brand || '!' ELSE p_brand END AS brand, {money('p_retailprice')} AS price FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0""",
    "scd2_build": f"WITH {versions()} SELECT * FROM versions",
    "scd2_late_change": f"WITH {versions(chr(10) + '  UNION ALL SELECT customer_id, customer_segment, ' + chr(39) + 'LATE' + chr(39) + ', TIMESTAMP ' + chr(39) + '1996-09-01' + chr(39) + ' FROM customers WHERE customer_id % 6 = 0')} SELECT * FROM versions",
    "scd2_intervals": f"WITH {versions()} SELECT customer_id, count(*) AS versions, true AS contiguous, CAST(1 AS BIGINT) AS current FROM versions GROUP BY customer_id",
    "asof_join": f"""WITH {versions()} SELECT o_orderkey, o_custkey AS customer_id, v.region FROM orders LEFT JOIN versions v ON o_custkey = v.customer_id AND v.effective_start_ts <= o_orderdate AND o_orderdate < v.effective_end_ts""",
    "inferred_members": f"""WITH {versions()} SELECT *, false AS is_inferred FROM versions
      UNION ALL SELECT DISTINCT o_custkey + 10000000, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), TIMESTAMP '1900-01-01', TIMESTAMP '9999-12-31 23:59:59', true, true FROM orders WHERE o_orderkey % 97 = 0""",
    "dim_date": f"""SELECT {DATE_KEY.format('d')} AS date_key, d AS full_date, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name, CAST(day(d) AS INTEGER) AS day_of_month, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
      CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(year(d) AS INTEGER) AS year_number, dayofweek(d) IN (0, 6) AS is_weekend, strftime(d, '%Y-%m') AS year_month,
      CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter, CAST(year(d) - CASE WHEN month(d) = 1 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year
      FROM (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2028-12-31', INTERVAL 1 DAY)) AS DATE) AS d)""",
    "conform_dim_product": "SELECT p_partkey AS product_id, p_type AS category_id, p_type LIKE '%E%' AS is_known FROM part",
    "surrogate_keys": f"SELECT o_orderkey, {hashed(['o_orderkey', 'o_orderstatus', 'o_orderpriority'])} AS record_hash, {DATE_KEY.format('o_orderdate')} AS date_key FROM orders",
    "fact_sales": f"WITH {SALES} SELECT order_id, order_line_number, product_id, customer_id, date_key, region, category_id, store_id, promotion_id, payment_status, order_status, quantity, unit_price, gross_amount, discount_amount, net_amount, tax_amount, is_cancelled FROM sales",
    "fact_fulfillment": f"WITH {FULFILL} SELECT * FROM fulfillment",
    "fact_inventory": f"WITH {LINES}, {INVENTORY} SELECT * EXCLUDE (snapshot_date, reorder_point) FROM inventory",
    "fact_returns": f"""WITH {LINES}, {ORDERS}, {RETURNS} SELECT r.order_id, order_line_number, product_id, customer_id, {DATE_KEY.format('return_date')} AS date_key, quantity, refund_amount, return_reason,
      CAST(date_diff('day', CAST(order_date AS DATE), CAST(return_date AS DATE)) AS INTEGER) AS days_to_return FROM returns r LEFT JOIN o ON r.order_id = o.order_id""",
    "fact_events": f"SELECT event_id, event_type, user_id AS customer_id, CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id, CASE WHEN event_id % 2 = 0 THEN 'web' ELSE 'app' END AS channel, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, {DATE_KEY.format('ts')} AS date_key FROM events",
    "fact_payment": f"""WITH {ORDERS}, {PAYMENTS} SELECT payment_id, p.order_id, customer_id, attempt_number, p.payment_status, payment_amount, p.payment_status = 'CAPTURED' AS is_successful, {DATE_KEY.format('paid_at')} AS date_key FROM payments p LEFT JOIN o ON p.order_id = o.order_id""",
    "fact_sales_versioned": f"""WITH {LINES}, {versions()}, lined AS (SELECT o_custkey, o_orderdate, {money('gross_amount - discount_amount')} AS net_amount FROM lines JOIN orders ON order_id = o_orderkey)
      SELECT v.region AS region_then, count(*) AS lines, {total('net_amount')} AS net_revenue FROM lined LEFT JOIN versions v ON o_custkey = v.customer_id AND v.effective_start_ts <= o_orderdate AND o_orderdate < v.effective_end_ts GROUP BY 1""",
    "agg_daily_sales": f"WITH {SALES} SELECT full_date, year, month_number, region, category_name, {TOTALS}, CAST({total('net_amount')} AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value FROM sold GROUP BY 1, 2, 3, 4, 5",
    "agg_lifetime": f"WITH {SALES}, {LIFETIME} SELECT * FROM lifetime",
    "agg_cohort": f"WITH {SALES}, {COHORT} SELECT * FROM cohort",
    "agg_product": f"WITH {SALES}, {DATED}, {PERFORMANCE} SELECT f.*, p_name AS product_name, p_brand AS brand FROM performance f LEFT JOIN part ON f.product_id = p_partkey",
    "q01_revenue_by_period": f"WITH {SALES} SELECT year, month_number, full_date, {total('gross_amount')} AS gross_revenue, {total('discount_amount')} AS discount_total, {total('net_amount')} AS net_revenue, count(DISTINCT order_id) AS orders FROM sold GROUP BY 1, 2, 3",
    "q02_revenue_by_region": f"WITH {SALES} SELECT region, year, month_number, {total('net_amount')} AS net_revenue, count(DISTINCT order_id) AS orders, CAST({total('net_amount')} AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value FROM sold WHERE region IS NOT NULL GROUP BY 1, 2, 3",
    "q03_revenue_by_product": f"WITH {SALES} SELECT category_name, brand, product_name, CAST(sum(quantity) AS BIGINT) AS units_sold, {total('net_amount')} AS net_revenue, count(DISTINCT order_id) AS orders FROM sold GROUP BY 1, 2, 3",
    "q04_average_order_value": f"""WITH {SALES}, t AS (SELECT order_id, year, month_number, region, customer_segment, {total('net_amount')} AS total FROM sold GROUP BY ALL)
      SELECT year, month_number, region, customer_segment, count(*) AS orders, quantile_disc(total, 0.5) AS median_order_value, CAST({total('total')} AS DOUBLE) / count(*) AS avg_order_value FROM t GROUP BY 1, 2, 3, 4""",
    "q05_lifetime_deciles": f"WITH {SALES}, {LIFETIME} SELECT * EXCLUDE (is_repeat_customer), CAST(ntile(10) OVER (ORDER BY lifetime_value DESC, customer_id) AS INTEGER) AS value_decile FROM lifetime",
    "q06_return_rate": f"""WITH {SALES}, {DATED}, s AS (SELECT product_id, category_name, brand, product_name, CAST(sum(quantity) AS BIGINT) AS units_sold FROM sold GROUP BY ALL), r AS (SELECT product_id, return_reason, CAST(sum(quantity) AS BIGINT) AS units_returned FROM dated GROUP BY ALL)
      SELECT s.*, return_reason, coalesce(units_returned, 0) AS units_returned, CAST(coalesce(units_returned, 0) AS DOUBLE) / nullif(units_sold, 0) AS return_rate FROM s LEFT JOIN r ON s.product_id = r.product_id""",
    "q07_inventory_availability": f"""WITH {STOCK} SELECT full_date, store_name, region, category_name, CAST(sum(quantity_available) AS BIGINT) AS units_available, count(*) FILTER (WHERE is_stockout) AS skus_out_of_stock, count(*) AS skus_tracked,
      CAST(sum(quantity_available) AS DOUBLE) / count(*) AS avg_units_per_sku FROM shelf GROUP BY 1, 2, 3, 4""",
    "q08_stockout_frequency": f"WITH {STOCK} SELECT product_id, product_name, brand, store_name, count(*) AS days_tracked, count(*) FILTER (WHERE is_stockout) AS days_out_of_stock, CAST(count(*) FILTER (WHERE is_stockout) AS DOUBLE) / count(*) AS stockout_rate FROM shelf GROUP BY 1, 2, 3, 4 HAVING count(*) FILTER (WHERE is_stockout) > 0",
    "q09_cohort_retention": f"WITH {SALES}, {COHORT} SELECT c.*, CAST(c.active_customers AS DOUBLE) / z.active_customers AS retention FROM cohort c LEFT JOIN cohort z ON c.cohort_month = z.cohort_month AND z.months_since_signup = 0",
    "q10_conversion": """WITH s AS (SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id, CAST(min(ts) AS DATE) AS full_date, arg_min(CASE WHEN event_id % 2 = 0 THEN 'web' ELSE 'app' END, (ts, CASE WHEN event_id % 2 = 0 THEN 'web' ELSE 'app' END)) AS channel,
      max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS v, max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS c, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p FROM events GROUP BY 1)
      SELECT full_date, channel, CAST(sum(v) AS BIGINT) AS sessions_with_view, CAST(sum(c) AS BIGINT) AS sessions_with_cart, CAST(sum(p) AS BIGINT) AS sessions_with_order, CAST(sum(p) AS DOUBLE) / nullif(sum(v), 0) AS conversion_rate, CAST(sum(c) AS DOUBLE) / nullif(sum(v), 0) AS cart_rate FROM s GROUP BY 1, 2""",
    "q11_fulfilment_time": f"""WITH {FULFILL}, {STORES} SELECT CAST(year(placed_at) AS INTEGER) AS year, CAST(month(placed_at) AS INTEGER) AS month_number, t.store_name, t.region, count(*) AS orders, quantile_disc(hours_to_ship, 0.95) AS p95_hours_to_ship,
      CAST(sum(hours_to_ship) AS DOUBLE) / count(*) AS avg_hours_to_ship, CAST(sum(hours_to_deliver) AS DOUBLE) / count(hours_to_deliver) AS avg_hours_to_deliver FROM fulfillment f LEFT JOIN stores t ON f.store_id = t.store_id
      WHERE order_status <> 'CANCELLED' AND hours_to_ship IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "q12_promotion_impact": f"""WITH {SALES} SELECT replace(promotion_id, 'P', 'Campaign ') AS promotion_name, CASE WHEN CAST(substr(promotion_id, 2) AS INTEGER) % 2 = 0 THEN 'PERCENT' ELSE 'FIXED' END AS promo_type, {money('CAST(substr(promotion_id, 2) AS INTEGER) * 5')} AS discount_value,
      count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units, {total('gross_amount')} AS gross_revenue, {total('discount_amount')} AS discount_given, {total('net_amount')} AS net_revenue,
      CAST({total('discount_amount')} AS DOUBLE) / CAST({total('gross_amount')} AS DOUBLE) AS effective_discount, CAST({total('net_amount')} AS DOUBLE) / count(DISTINCT order_id) AS aov_on_promotion FROM sold WHERE promotion_id IS NOT NULL GROUP BY 1, 2, 3""",
    "q13_latest_vs_trend": f"""WITH {SALES}, daily AS (SELECT date_key, region, {total('net_amount')} AS net_revenue, count(DISTINCT order_id) AS orders FROM sold GROUP BY 1, 2),
      trend AS (SELECT region, date_key, net_revenue, orders, CAST(sum(net_revenue) OVER w AS DOUBLE) / nullif(count(*) OVER w, 0) AS trailing_mean FROM daily WINDOW w AS (PARTITION BY region ORDER BY date_key ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
      SELECT *, (CAST(net_revenue AS DOUBLE) - trailing_mean) / nullif(trailing_mean, 0) AS variance FROM trend""",
    "executive_kpis": f"""WITH {SALES}, {LIFETIME}, {DATED}, {PERFORMANCE} SELECT (SELECT {total('net_amount')} FROM sold) AS total_net_revenue, (SELECT count(DISTINCT order_id) FROM sold) AS total_orders, (SELECT CAST({total('net_amount')} AS DOUBLE) / count(DISTINCT order_id) FROM sold) AS avg_order_value,
      (SELECT count(*) FROM lifetime) AS customers_with_orders, (SELECT count(*) FROM lifetime WHERE is_repeat_customer) AS repeat_customers, (SELECT CAST(sum(units_returned) AS DOUBLE) / sum(units_sold) FROM performance) AS return_rate""",
    "run_status": f"WITH {RUNS} SELECT run_date, stage, entity, status, count(*) AS runs, CAST(sum(duration_s) AS DOUBLE) / count(*) AS avg_duration_s, max(duration_s) AS max_duration_s, CAST(sum(rows_in) AS BIGINT) AS rows_in, CAST(sum(rows_out) AS BIGINT) AS rows_out, CAST(sum(rows_quarantined) AS BIGINT) AS rows_quarantined FROM runs WHERE started_at >= {SINCE} GROUP BY 1, 2, 3, 4",
    "duration_trend": f"""WITH {RUNS}, d AS (SELECT entity, stage, run_date, CAST(sum(duration_s) AS DOUBLE) / count(*) AS duration_s FROM runs WHERE status = 'SUCCESS' GROUP BY 1, 2, 3)
      SELECT *, avg(duration_s) OVER w AS rolling_mean FROM d WINDOW w AS (PARTITION BY entity, stage ORDER BY run_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "dq_summary": f"""WITH {RESULTS} SELECT entity, rule, type, severity, count(*) AS evaluations, count(*) FILTER (WHERE status = 'FAILED') AS failures, count(*) FILTER (WHERE status = 'SKIPPED') AS skipped, avg(pass_rate) AS avg_pass_rate, max(checked_at) AS last_evaluated
      FROM results WHERE checked_at >= {SINCE} GROUP BY 1, 2, 3, 4""",
    "reconciliation_status": f"WITH {CHECKS} SELECT CAST(checked_at AS DATE) AS check_date, * EXCLUDE (checked_at) FROM checks WHERE checked_at >= {SINCE}",
    "freshness_sla": f"WITH {RUNS}, kept AS (SELECT * FROM runs WHERE ended_at < DATE '2024-01-30' OR entity <> 'entity_3'), {FRESH.format('kept')} SELECT * FROM fresh",
    "pipeline_health": f"""WITH {RUNS}, {RESULTS}, {CHECKS}, {FRESH.format('runs')} SELECT (SELECT count(*) FROM runs WHERE started_at >= {SINCE} AND status = 'FAILED') AS failed_runs, (SELECT count(*) FROM results WHERE checked_at >= {SINCE} AND severity = 'fatal' AND status = 'FAILED') AS fatal_failures,
      (SELECT count(*) FROM checks WHERE checked_at >= {SINCE} AND status <> 'PASSED') AS reconciliation_failures, (SELECT count(*) FROM fresh WHERE status = 'BREACH') AS sla_breaches""",
    "sales_summary": f"WITH {SALES} SELECT full_date, year, strftime(full_date, '%B') AS month_name, CAST(quarter(full_date) AS INTEGER) AS quarter, region, customer_segment, product_name, brand, category_name, quantity, gross_amount, discount_amount, net_amount FROM sales",
    "inventory_health": f"WITH {STOCK} SELECT full_date, store_name, region, product_name, brand, quantity_on_hand, quantity_available, reorder_point, is_stockout, is_below_reorder FROM shelf",
    "pii_inventory": """SELECT * FROM (VALUES ('dim_customers', 'email', 'P0', 'email', 'true'), ('dim_customers', 'postal_code', 'P1', 'location', 'true'), ('dim_customers', 'city', 'P1', 'location', NULL), ('dim_customers', 'customer_id', 'P1', 'pseudonymous_key', NULL))
      t(table_name, column_name, data_classification, pii_type, masked)""",
    "mask_email": f"""WITH {CUSTOMERS}, v AS (SELECT customer_id, CASE WHEN customer_id % 5 = 0 THEN customer_name WHEN customer_id % 7 <> 0 THEN email END AS value FROM customers)
      SELECT customer_id, CASE WHEN value IS NULL THEN NULL WHEN contains(value, '@') THEN substr(sha256(value), 1, 12) || '@' || split_part(value, '@', 2) ELSE '***' END AS masked FROM v""",
    "mask_name": "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda p: substr(p, 1, 1) || '.'), ' ') AS masked FROM part",
    "mask_postal": f"WITH {CUSTOMERS} SELECT customer_id, substr(postal_code, 1, 3) || '**' AS masked FROM customers",
    "mask_cost": f"SELECT p_partkey AS product_id, CAST(NULL AS {M}) AS hidden, {money('p_retailprice')} AS shown FROM part",
    "row_filter": f"WITH {CUSTOMERS} SELECT customer_id, substr(sha256(email), 1, 12) || '@' || split_part(email, '@', 2) AS email, substr(postal_code, 1, 3) || '**' AS postal_code FROM customers WHERE customer_id % 10 <> 0",
    "recon_row_flow": f"""WITH {DEDUP}, routed AS (SELECT l_orderkey, l_linenumber FROM latest WHERE NOT {BAD_LINE} UNION SELECT l_orderkey, l_linenumber FROM latest WHERE {BAD_LINE})
      SELECT {recon('row_flow', 'order_items', 'a', 'b', 'a = b')} FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS a, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem INTERSECT SELECT * FROM routed)) AS b)
      UNION ALL SELECT {recon('row_flow', 'orders', 'a', 'b', 'a = b')} FROM (SELECT count(*) AS a, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS b FROM orders)
      UNION ALL SELECT {recon('row_flow', 'orders_shifted', 'a', 'b', 'a = b')} FROM (SELECT count(*) AS a, count(*) FILTER (WHERE o_orderkey - 1 IN (SELECT o_orderkey FROM orders)) AS b FROM orders)""",
    "recon_money": f"""WITH {SALES}, silver AS (SELECT sum(gross_amount) - sum(discount_amount) AS a FROM lines JOIN orders ON order_id = o_orderkey WHERE o_orderstatus <> 'P')
      SELECT {recon('net_revenue', 'fact_sales', 'a', 'b', 'abs(a - b) <= 0.01')} FROM silver, (SELECT sum(net_amount) AS b FROM sold)
      UNION ALL SELECT {recon('net_revenue', 'fact_sales_cut', 'a', 'b', 'abs(a - b) <= 0.01')} FROM silver, (SELECT sum(net_amount) AS b FROM sold WHERE quantity < 40)""",
    "recon_grain": f"""WITH {SALES} SELECT {recon('grain', 'fact_sales', 'a', 'b', 'a = b')} FROM (SELECT count(*) AS a, (SELECT count(*) FROM (SELECT DISTINCT order_id, order_line_number FROM sales)) AS b FROM sales)
      UNION ALL SELECT {recon('grain', 'lineitem', 'a', 'b', 'a = b')} FROM (SELECT count(*) AS a, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS b FROM lineitem)""",
    "recon_soft_delete": f"WITH {CHANGES} SELECT {recon('soft_delete_rate', 'orders', 'a', 'b', 'b <= a * 0.25')} FROM (SELECT count(*) AS a, count(*) FILTER (WHERE op = 'd') AS b FROM latest_changes)",
    "recon_surrogate_key": f"""WITH {versions()} SELECT {recon('surrogate_key', 'dim_customers', 'a', 'b', 'a = b')} FROM (SELECT count(*) AS a, count(DISTINCT (customer_id, effective_start_ts)) AS b FROM versions)
      UNION ALL SELECT {recon('surrogate_key', 'dim_customers_twice', 'a', 'b', 'a = b')} FROM (SELECT count(*) + count(*) FILTER (WHERE customer_id % 10 = 0) AS a, count(DISTINCT (customer_id, effective_start_ts)) AS b FROM versions)""",
    "recon_control_totals": f"WITH {SALES} SELECT 'control_totals' AS check_name, {money('60')} AS source_value, {money('n')} AS target_value, CASE WHEN abs(60 - n) <= 0.01 THEN 'PASSED' ELSE 'FAILED' END AS status FROM (SELECT coalesce(sum(net_amount), 0) AS n FROM sold)",
    "union_by_name": "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
    "scalar_subqueries": "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers, (SELECT max(l_quantity) FROM lineitem) AS most",
    "having_groups": f"SELECT o_custkey, count(*) AS orders, {total(money('o_totalprice'))} AS total FROM orders GROUP BY 1 HAVING count(*) > 12",
    "groupby_all": f"SELECT l_returnflag, l_linestatus, count(*) AS lines, {total(money('l_extendedprice'))} AS gross FROM lineitem GROUP BY ALL",
    "keyset_page": "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100 OFFSET 200",
    "trailing_revenue": f"""WITH {SALES}, daily AS (SELECT date_key, region, {total('net_amount')} AS net_revenue, count(DISTINCT order_id) AS orders FROM sold WHERE gross_amount >= 0 GROUP BY 1, 2),
      trend AS (SELECT region, date_key, net_revenue, orders, CAST(sum(net_revenue) OVER w AS DOUBLE) / nullif(count(*) OVER w, 0) AS trailing_mean FROM daily WINDOW w AS (PARTITION BY region ORDER BY date_key ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
      SELECT *, (CAST(net_revenue AS DOUBLE) - trailing_mean) / nullif(trailing_mean, 0) AS variance FROM trend""",
}
