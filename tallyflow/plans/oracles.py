"""The same results as ANSI SQL over the test tables, one statement per query.

Statements share named building blocks; ``_sql`` puts the blocks a statement needs in front of it.
"""

from __future__ import annotations

import re
from decimal import Decimal

from ..sources.sample import CATALOG, ISSUED, PLAN_ROWS, SNAPSHOT_TIMES, TODAY

AS_OF = "TIMESTAMP '2024-03-15 06:00:00'"
BLOCKS: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def _block(name: str, body: str) -> None:
    BLOCKS[name] = body


def _needs(text: str) -> set[str]:
    return {word for word in re.findall(r"[a-z_0-9]+", text) if word in BLOCKS}


def _sql(body: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in sorted(_needs(BLOCKS[name]) - {name}):
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in sorted(_needs(body)):
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in ordered) + "\n" + body


def _oracle(name: str, body: str) -> None:
    ORACLES[name] = _sql(body)


def _key(*parts: str) -> str:
    texts = [f"cast({p} AS VARCHAR)" for p in parts]
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(cast(length({t}) AS VARCHAR) || ':' || {t}, 'n')" for t in texts) + "))"


def _money(q: str, p: str) -> str:
    return f"cast(cast({q} AS DECIMAL(38,6)) * cast({p} AS DECIMAL(38,10)) AS DECIMAL(38,10))"


def _sum_amount(x: str) -> str:
    return f"cast(sum({x}) AS DECIMAL(38,10))"


def _sum_quantity(x: str) -> str:
    return f"cast(sum({x}) AS DECIMAL(28,6))"


# ---- inputs

_block("v_events", """
SELECT cast(event_id AS VARCHAR) AS event_id, ts AS event_ts, cast(ts AS DATE) AS event_date,
  'cust_' || user_id AS customer_id,
  CASE event_type WHEN 'click' THEN 'prod_api_requests' WHEN 'view' THEN 'prod_storage_gb'
    WHEN 'purchase' THEN 'prod_compute_minutes' WHEN 'signup' THEN 'prod_ai_tokens' ELSE 'prod_unknown' END AS product_id,
  CASE event_id % 3 WHEN 0 THEN 'plan_starter' WHEN 1 THEN 'plan_pro' ELSE 'plan_enterprise' END AS plan_id,
  CASE user_id % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'us-west-2' ELSE 'eu-central-1' END AS region,
  CASE event_type WHEN 'click' THEN 'requests' WHEN 'view' THEN 'gb_month' WHEN 'purchase' THEN 'minutes'
    WHEN 'signup' THEN 'tokens' ELSE 'count' END AS unit,
  cast(value AS DECIMAL(18,6)) AS quantity, 'API' AS source,
  CASE WHEN event_id % 50 = 0 THEN ts + INTERVAL 40 DAY ELSE ts + INTERVAL 1 HOUR END AS load_ts,
  'run_' || cast(cast(ts AS DATE) AS VARCHAR) AS batch_id,
  md5(concat_ws('-', cast(event_id AS VARCHAR), cast(value AS VARCHAR))) AS raw_hash, event_id AS n
FROM events""")
_block("v_deliveries", """
SELECT * FROM v_events UNION ALL
SELECT * REPLACE (event_ts + INTERVAL 1 SECOND AS event_ts) FROM v_events WHERE n % 100 = 0""")
_block("v_landed", """
SELECT *, cast(load_ts AS DATE) AS dt, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS stamp FROM v_deliveries""")
_block("v_json", """
SELECT *, '{"customer_id":"' || customer_id || '","event_id":"' || event_id || '","event_timestamp":"' || stamp
  || '","plan_id":"' || plan_id || '","product_id":"' || product_id || '","quantity":'
  || regexp_replace(cast(cast(quantity AS DOUBLE) AS VARCHAR), '\\.0$', '')
  || ',"region":"' || region || '","schema_version":"1.0","unit":"' || unit || '"}' AS doc FROM v_landed""")
_block("v_unique", """
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts DESC, raw_hash DESC) AS rk FROM v_deliveries
) WHERE rk = 1""")
_block("v_in_time", f"SELECT * FROM v_events WHERE load_ts <= TIMESTAMP '{ISSUED}'")

_PLAN_LIST = "['plan_free', 'plan_starter', 'plan_pro', 'plan_enterprise']"
_PLAN_INDEX = "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 WHEN 'AUTOMOBILE' THEN 1 WHEN 'MACHINERY' THEN 3 ELSE 2 END"
_STATUS = "CASE WHEN c_custkey % 5 < 3 THEN 'active' WHEN c_custkey % 5 = 3 THEN 'delinquent' ELSE 'cancelled' END"
_block("v_snapshots", f"""
SELECT c_custkey AS customer_sk, 'cust_' || c_custkey AS customer_id, c_name AS customer_name, {_STATUS} AS status,
  n_name AS country,
  {_PLAN_LIST}[1 + ({_PLAN_INDEX} + CASE WHEN k >= 1 AND c_custkey % 7 = 0 THEN 1 ELSE 0 END
    + CASE WHEN k >= 2 AND c_custkey % 11 = 0 THEN 1 ELSE 0 END) % 4] AS plan_id,
  moment AS ingest_ts, k
FROM customer JOIN nation ON c_nationkey = n_nationkey
CROSS JOIN (VALUES (0, TIMESTAMP '{SNAPSHOT_TIMES[0]}'), (1, TIMESTAMP '{SNAPSHOT_TIMES[1]}'),
  (2, TIMESTAMP '{SNAPSHOT_TIMES[2]}')) AS moments(k, moment)""")
_block("v_customers", """
SELECT customer_sk, customer_id, customer_name, status, country, plan_id, ingest_ts AS effective_start, true AS is_current
FROM v_snapshots WHERE k = 0""")
_block("v_rates", f"""
SELECT cast(rate_sk AS BIGINT) AS rate_sk, product_id, plan_id, unit, cast(price AS DECIMAL(18,10)) AS unit_price,
  'USD' AS currency, DATE '2024-01-01' AS effective_from, cast(NULL AS DATE) AS effective_to, true AS is_current
FROM (VALUES {CATALOG}) AS t(rate_sk, product_id, plan_id, unit, price)""")
_block("v_rates_split", """
SELECT rate_sk, product_id, plan_id, unit, unit_price, currency, DATE '2024-01-01' AS effective_from,
  DATE '2024-01-15' AS effective_to FROM v_rates
UNION ALL
SELECT rate_sk + 100, product_id, plan_id, unit, cast(unit_price * 2 AS DECIMAL(18,10)), currency, DATE '2024-01-16', NULL FROM v_rates""")
_block("v_plans", f"SELECT plan_id, cast(base_fee AS DECIMAL(18,2)) AS base_fee FROM (VALUES {PLAN_ROWS}) AS t(plan_id, plan_name, base_fee, currency)")
_block("v_catalog", """
SELECT 'rate_' || p_partkey AS rate_id, 'prod_' || lower(p_type) AS product_id, 'plan_' || lower(replace(p_brand, '#', '_')) AS plan_id,
  CASE WHEN p_size % 2 = 0 THEN 'each' ELSE 'box' END AS unit,
  cast(cast(cast(round(p_retailprice * 100) AS BIGINT) AS DECIMAL(18,0)) * cast(0.00001 AS DECIMAL(6,5)) AS DECIMAL(18,5)) AS price,
  'USD' AS currency, DATE '2024-01-01' + cast(p_partkey % 365 AS INTEGER) AS effective_from,
  CASE WHEN p_partkey % 3 = 0 THEN DATE '2025-12-31' END AS effective_to,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(cast(p_partkey AS BIGINT)) AS ingest_ts
FROM part""")
_block("v_order_costs", f"""
SELECT cast(l_shipdate AS DATE) AS date_id, o_custkey AS customer_sk, 'prod_' || lower(p_type) AS product_id, 'each' AS unit,
  {_sum_quantity("cast(l_quantity AS DECIMAL(18,6))")} AS total_quantity,
  {_sum_amount("cast(l_extendedprice AS DECIMAL(18,2))")} AS cost_amount, 'USD' AS currency
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4""")


def _daily(source: str) -> str:
    return f"""
SELECT event_date, customer_id, product_id, unit, {_sum_quantity("quantity")} AS total_quantity,
  count(*) AS event_count, max(event_ts) AS last_event_ts
FROM {source} GROUP BY event_date, customer_id, product_id, unit"""


def _costs(daily: str, rates: str, by_plan: bool) -> str:
    plan = "AND r.plan_id = c.plan_id" if by_plan else ""
    return f"""
SELECT g.event_date AS date_id, c.customer_sk, g.product_id, g.unit, g.total_quantity, g.total_quantity AS billable_quantity,
  {_money("g.total_quantity", "r.unit_price")} AS cost_amount, r.currency, r.rate_sk
FROM {daily} g JOIN v_customers c ON c.customer_id = g.customer_id
JOIN {rates} r ON r.product_id = g.product_id AND r.unit = g.unit {plan}
  AND g.event_date >= r.effective_from AND (r.effective_to IS NULL OR g.event_date <= r.effective_to)"""


def _headers(costs: str) -> str:
    total = _sum_amount("cost_amount")
    return f"""
SELECT {_key("customer_sk", "DATE '2024-01-01'")} AS invoice_id, customer_sk, DATE '2024-01-01' AS billing_period_start,
  DATE '2024-01-31' AS billing_period_end, TIMESTAMP '{ISSUED}' AS issued_ts, 'issued' AS status, {total} AS subtotal,
  cast(0 AS DECIMAL(38,10)) AS tax, {total} AS total, max(currency) AS currency
FROM {costs} WHERE date_id BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY customer_sk"""


def _lines(costs: str) -> str:
    invoice = _key("f.customer_sk", "DATE '2024-01-01'")
    return f"""
SELECT invoice_id, {_key("invoice_id", "'usage'", "product_id", "unit", "rate_sk")} AS line_item_id, 'usage' AS line_type,
  product_id, unit, quantity, unit_price, amount, rate_sk, usage_window_start, usage_window_end, 'close' AS calc_batch_id,
  DATE '2024-01-01' AS billing_period_start
FROM (
  SELECT {invoice} AS invoice_id, f.product_id, f.unit, f.rate_sk, {_sum_quantity("billable_quantity")} AS quantity,
    max(r.unit_price) AS unit_price, {_sum_amount("cost_amount")} AS amount, min(date_id) AS usage_window_start,
    max(date_id) AS usage_window_end
  FROM {costs} f LEFT JOIN v_rates r ON r.rate_sk = f.rate_sk
  WHERE date_id BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY 1, 2, 3, 4)"""


_block("v_daily", _daily("v_events"))
_block("v_daily_unique", _daily("v_unique"))
_block("v_daily_in_time", _daily("v_in_time"))
_block("v_costs", _costs("v_daily", "v_rates", True))
_block("v_costs_all", _costs("v_daily", "v_rates", False))
_block("v_costs_unique", _costs("v_daily_unique", "v_rates", True))
_block("v_costs_split", _costs("v_daily", "v_rates_split", True))
_block("v_costs_in_time", _costs("v_daily_in_time", "v_rates", True))
_block("v_costs_in_time_all", _costs("v_daily_in_time", "v_rates", False))
_block("v_invoices", _headers("v_costs"))
_block("v_invoices_all", _headers("v_costs_all"))
_block("v_invoices_in_time", _headers("v_costs_in_time"))
_block("v_invoices_in_time_all", _headers("v_costs_in_time_all"))
_block("v_lines", _lines("v_costs"))
_block("v_lines_all", _lines("v_costs_all"))
_block("v_lines_in_time", _lines("v_costs_in_time"))

# ---- sources and sinks

_oracle("a1_ingest_day_files", f"SELECT {AS_OF} AS ingest_ts, 'API' AS source, dt, 'run_1' AS batch_id, event_id, doc AS raw, true AS is_json FROM v_json")
_oracle("a2_newest_customer_snapshot", f"""
SELECT customer_id, customer_name, status, country, plan_id, {AS_OF} AS ingest_ts, 'seed' AS batch_id FROM v_snapshots WHERE k = 2""")
_oracle("a3_pricing_csv", """
SELECT 'seed' AS batch_id, DATE '2024-03-15' AS dt, product_id, plan_id, unit, cast(price AS VARCHAR) AS price, currency,
  cast(effective_from AS VARCHAR) AS effective_from, cast(effective_to AS VARCHAR) AS effective_to FROM v_catalog""")
_oracle("a4_dimension_csv", """
SELECT 'prod_' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
  'Size ' || p_size || ', "' || p_brand || '"' AS description FROM part""")
_oracle("a4_dimension_csv_rejects", "SELECT n_name AS product_id, n_name AS line FROM nation")
_oracle("a5_batch_reload", "SELECT 'run_' || dt AS batch_id, dt, count(*) AS row_count FROM v_landed GROUP BY dt")
_oracle("a6_day_rebuild", "SELECT * FROM v_daily")
_oracle("a7_append_once", "SELECT * FROM v_invoices")
_oracle("a8_backfill", "SELECT * FROM v_costs_unique")

# ---- parse

_oracle("b1_parse_usage", """
SELECT json_extract_string(doc, '$.event_id') AS event_id, cast(rtrim(json_extract_string(doc, '$.event_timestamp'), 'Z') AS TIMESTAMP) AS event_ts,
  cast(rtrim(json_extract_string(doc, '$.event_timestamp'), 'Z') AS TIMESTAMP)::DATE AS event_date,
  json_extract_string(doc, '$.customer_id') AS customer_id, json_extract_string(doc, '$.product_id') AS product_id,
  json_extract_string(doc, '$.plan_id') AS plan_id, json_extract_string(doc, '$.region') AS region,
  json_extract_string(doc, '$.unit') AS unit, cast(json_extract_string(doc, '$.quantity') AS DECIMAL(18,6)) AS quantity,
  source, 'run_' || dt AS batch_id, load_ts AS ingest_ts, dt FROM v_json""")
_oracle("b2_parse_customers", f"""
SELECT customer_id, customer_name, status, country, plan_id, {AS_OF} AS ingest_ts, 'seed' AS batch_id FROM v_snapshots""")
_oracle("b3_parse_rates", f"""
SELECT product_id, plan_id, unit, cast(price AS DECIMAL(18,10)) AS unit_price, currency, effective_from, effective_to,
  {AS_OF} AS ingest_ts, 'seed' AS batch_id FROM v_catalog""")
_oracle("b4_payload_hash", """
SELECT event_id, load_ts AS ingest_ts, md5(regexp_replace(doc, '"quantity":([0-9.]+)', '"quantity":"\\1"')) AS raw_hash FROM v_json""")
_block("v_defects", """
SELECT *, CASE n % 20 WHEN 1 THEN 'missing_event_id' WHEN 2 THEN 'missing_customer_id' WHEN 3 THEN 'missing_product_id'
  WHEN 4 THEN 'bad_timestamp' WHEN 5 THEN 'bad_quantity' WHEN 6 THEN 'negative_quantity' WHEN 7 THEN 'bad_json'
  ELSE CASE WHEN product_id = 'prod_unknown' THEN 'unknown_product' END END AS error_reason,
  CASE WHEN n % 20 = 6 THEN cast(-1.5 AS DECIMAL(18,6)) ELSE quantity END AS sent FROM v_events""")
_oracle("b5_quarantine", """
SELECT load_ts AS ingest_ts, event_date AS dt, source, error_reason, batch_id FROM v_defects WHERE error_reason IS NOT NULL""")
_oracle("b5_accepted", """
SELECT event_id, date_trunc('second', event_ts) AS event_ts, event_date, customer_id, product_id, cast(NULL AS VARCHAR) AS plan_id,
  cast(NULL AS VARCHAR) AS region, unit, quantity, source, batch_id, load_ts AS ingest_ts, event_date AS dt
FROM v_defects WHERE error_reason IS NULL""")

# ---- deduplicate, merge, dimensions

_oracle("c1_dedup_events", "SELECT * EXCLUDE (n) FROM v_unique")
_oracle("c1_dedup_order_lines", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, cast(l_quantity AS DECIMAL(18,6)) AS quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC) AS rk FROM lineitem
) WHERE rk = 1""")
_block("v_target", "SELECT * EXCLUDE (n) FROM v_events WHERE event_date < DATE '2024-01-16'")
_block("v_incoming", """
SELECT * EXCLUDE (n, rk) FROM (
  SELECT * REPLACE (cast(quantity * 2 AS DECIMAL(18,6)) AS quantity, load_ts + INTERVAL 1 DAY AS load_ts, 'run_2' AS batch_id,
    CASE WHEN n % 2 = 0 THEN md5(raw_hash || 'x') ELSE raw_hash END AS raw_hash),
    row_number() OVER (PARTITION BY event_id ORDER BY event_ts DESC) AS rk FROM v_deliveries
) WHERE rk = 1""")
_STAMPS = ("load_ts", "batch_id", "raw_hash")
_REST = ("event_ts", "event_date", "customer_id", "product_id", "plan_id", "region", "unit", "quantity", "source")


def _merge(changed_only: bool, replace: bool) -> str:
    hit = "t.raw_hash <> s.raw_hash" if changed_only else "true"
    moved = [f"CASE WHEN t.event_id IS NULL OR {hit} THEN s.{c} ELSE t.{c} END AS {c}" for c in _STAMPS]
    kept = [
        f"CASE WHEN t.event_id IS NULL OR {hit} THEN s.{c} ELSE t.{c} END AS {c}" if replace else f"coalesce(t.{c}, s.{c}) AS {c}"
        for c in _REST
    ]
    # Every target event is delivered again, so the incoming side covers the target.
    return f"""SELECT s.event_id, {", ".join(kept + moved)},
  CASE WHEN t.event_id IS NULL THEN 'insert' WHEN {hit} THEN 'update' ELSE 'keep' END AS action
FROM v_incoming s LEFT JOIN v_target t ON t.event_id = s.event_id"""


_oracle("c2_merge_asrun", _merge(False, False))
_oracle("c2_merge_fixed", _merge(True, False))
_oracle("c2_merge_replace", _merge(True, True))
_oracle("c3_latest_customers", "SELECT customer_id, customer_name, status, country, plan_id FROM v_snapshots WHERE k = 2")
_oracle("c4_latest_rates", """
SELECT product_id, plan_id, unit, cast(price AS DECIMAL(18,10)) AS unit_price, currency, effective_from, effective_to FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id, plan_id ORDER BY ingest_ts DESC) AS rk FROM v_catalog) WHERE rk = 1""")
_oracle("c5_customer_upsert", f"""
SELECT s.customer_id, s.customer_name, s.status, coalesce(d.country, s.country) AS country, s.plan_id,
  coalesce(d.effective_start, TIMESTAMP '{SNAPSHOT_TIMES[2]}') AS effective_start, true AS is_current
FROM v_snapshots s LEFT JOIN v_customers d ON d.customer_id = s.customer_id AND d.status <> 'cancelled' WHERE s.k = 2""")
_block("v_history", f"""
SELECT customer_id, customer_name, status, country, plan_id, ingest_ts AS effective_start,
  lead(ingest_ts) OVER (PARTITION BY customer_id ORDER BY ingest_ts) AS effective_end, record_hash
FROM (
  SELECT *, lag(record_hash) OVER (PARTITION BY customer_id ORDER BY ingest_ts) AS before
  FROM (SELECT *, {_key("customer_name", "status", "country", "plan_id")} AS record_hash FROM v_snapshots))
WHERE before IS DISTINCT FROM record_hash""")
_HISTORY = "SELECT *, effective_end IS NULL AS is_current FROM v_history"
_oracle("c6_customer_history", _HISTORY)
_oracle("c6_apply_snapshot", _HISTORY)
_oracle("c6_stored_history", _HISTORY)
_oracle("c6_any_order", _HISTORY)
_oracle("c7_append_rates", """
SELECT cast(NULL AS VARCHAR) AS rate_id, product_id, plan_id, unit, cast(price AS DECIMAL(18,10)) AS unit_price, currency,
  effective_from, effective_to, true AS is_current FROM v_catalog""")
_oracle("c7_second_load", """
SELECT DISTINCT cast(NULL AS VARCHAR) AS rate_id, product_id, plan_id, unit, cast(price AS DECIMAL(18,10)) AS unit_price, currency,
  effective_from, effective_to, true AS is_current FROM v_catalog""")
_block("v_versions", f"""
SELECT {_key("product_id", "plan_id", "unit", "effective_from")} AS rate_id, product_id, plan_id, unit,
  cast(price AS DECIMAL(18,10)) AS unit_price, currency, effective_from,
  CASE WHEN following IS NULL THEN effective_to ELSE least(following - 1, coalesce(effective_to, following - 1)) END AS effective_to,
  following IS NULL AS is_current
FROM (
  SELECT *, lead(effective_from) OVER (PARTITION BY product_id, plan_id, unit ORDER BY effective_from) AS following
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id, plan_id, unit, effective_from ORDER BY ingest_ts DESC) AS rk FROM v_catalog)
  WHERE rk = 1)""")
_oracle("c8_rate_versions", "SELECT * FROM v_versions")
# Day by day: the second load's version where it has one, else the first's; an open version holds to the next start of all.
_oracle("c8_stored_versions", f"""
SELECT * FROM (WITH newest AS (
  SELECT *, extract(second FROM ingest_ts)::INTEGER % 2 = 0 AS second,
    row_number() OVER (PARTITION BY product_id, plan_id, unit, effective_from, extract(second FROM ingest_ts)::INTEGER % 2 ORDER BY ingest_ts DESC) AS rk
  FROM v_catalog),
alone AS (
  SELECT *, lead(effective_from) OVER (PARTITION BY product_id, plan_id, unit, second ORDER BY effective_from) AS following
  FROM newest WHERE rk = 1),
closed AS (
  SELECT a.*, CASE WHEN following IS NOT NULL THEN least(coalesce(effective_to, following - 1), following - 1)
    WHEN effective_to IS NOT NULL THEN effective_to
    ELSE coalesce((SELECT min(o.effective_from) - 1 FROM alone o WHERE a.second AND NOT o.second AND o.product_id = a.product_id
      AND o.plan_id = a.plan_id AND o.unit = a.unit AND o.effective_from > a.effective_from), DATE '9999-12-31') END AS until
  FROM alone a),
edges AS (
  SELECT product_id, plan_id, unit, effective_from AS d FROM closed UNION SELECT product_id, plan_id, unit, (until + 1)::DATE FROM closed WHERE until < DATE '9999-12-31'),
spans AS (
  SELECT *, coalesce(lead(d) OVER (PARTITION BY product_id, plan_id, unit ORDER BY d) - 1, DATE '9999-12-31') AS last FROM edges),
won AS (
  SELECT s.*, c.effective_from AS started, c.price, c.currency, c.second
  FROM spans s JOIN closed c ON c.product_id = s.product_id AND c.plan_id = s.plan_id AND c.unit = s.unit AND s.d BETWEEN c.effective_from AND c.until
  QUALIFY row_number() OVER (PARTITION BY s.product_id, s.plan_id, s.unit, s.d ORDER BY c.second DESC) = 1),
runs AS (
  SELECT *, sum(CASE WHEN started = was AND second = side AND d = before + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY product_id, plan_id, unit ORDER BY d) AS run
  FROM (SELECT *, lag(started) OVER w AS was, lag(second) OVER w AS side, lag(last) OVER w AS before FROM won WINDOW w AS (PARTITION BY product_id, plan_id, unit ORDER BY d))),
versions AS (
  SELECT product_id, plan_id, unit, cast(any_value(price) AS DECIMAL(18,10)) AS unit_price, any_value(currency) AS currency, min(d) AS effective_from,
    nullif(max(last), DATE '9999-12-31') AS effective_to
  FROM runs GROUP BY product_id, plan_id, unit, run)
SELECT {_key("product_id", "plan_id", "unit", "effective_from")} AS rate_id, *,
  lead(effective_from) OVER (PARTITION BY product_id, plan_id, unit ORDER BY effective_from) IS NULL AS is_current
FROM versions)""")
_oracle("c8_stored_prices", "SELECT * EXCLUDE (rate_sk) FROM v_costs_split")
_oracle("c9_surrogate_keys", f"""
SELECT rate_id, {_key("product_id", "plan_id", "unit", "effective_to")} AS rate_key,
  {_key("product_id", "plan_id", "unit", "effective_from")} AS version_key FROM v_catalog""")
_oracle("c9_dense_keys", """
WITH buyers AS (SELECT DISTINCT cast(o_custkey AS VARCHAR) AS customer_id FROM orders),
  others AS (SELECT DISTINCT cast(c_custkey AS VARCHAR) AS customer_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))
SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_sk, 'buyers' AS load FROM buyers
UNION ALL SELECT customer_id, (SELECT count(*) FROM buyers) + row_number() OVER (ORDER BY customer_id), 'everyone' FROM others""")
_oracle("c10_date_dimension", """
SELECT d AS date_id, cast(year(d) AS INTEGER) AS year, cast(month(d) AS INTEGER) AS month, cast(day(d) AS INTEGER) AS day,
  cast(quarter(d) AS INTEGER) AS quarter, cast(isodow(d) AS INTEGER) AS day_of_week, isodow(d) >= 6 AS is_weekend
FROM (SELECT cast(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)""")

# ---- aggregation

_oracle("d1_daily_usage", "SELECT * FROM v_daily")
_oracle("d2_daily_usage_model", "SELECT * EXCLUDE (last_event_ts) FROM v_daily_unique")
_oracle("d3_daily_revenue", f"SELECT date_id, {_sum_amount('cost_amount')} AS daily_total FROM v_costs GROUP BY date_id")


def _by_month(costs: str) -> str:
    return f"""
SELECT customer_sk, cast(date_trunc('month', date_id) AS DATE) AS billing_period_start, last_day(date_id) AS billing_period_end,
  {_sum_amount("cost_amount")} AS subtotal, max(currency) AS currency FROM {costs} GROUP BY 1, 2, 3"""


def _by_product(costs: str) -> str:
    return f"""
SELECT customer_sk, cast(date_trunc('month', date_id) AS DATE) AS billing_period_start, product_id, unit,
  {_sum_quantity("total_quantity")} AS quantity, {_sum_amount("cost_amount")} AS amount, max(currency) AS currency
FROM {costs} GROUP BY 1, 2, 3, 4"""


_oracle("d4_monthly_customer_cost", _by_month("v_costs"))
_oracle("d4_monthly_order_cost", _by_month("v_order_costs"))
_oracle("d5_monthly_product_cost", _by_product("v_costs"))
_oracle("d5_monthly_order_products", _by_product("v_order_costs"))
_oracle("d6_current_customers", "SELECT count(DISTINCT customer_id) AS total_customers FROM v_customers WHERE is_current")
_oracle("d6_distinct_customers_rolled_up", """
WITH used AS (SELECT DISTINCT cast(ts AS DATE) AS event_date, user_id FROM events)
SELECT 'day' AS period, event_date AS start, count(DISTINCT user_id) AS customers FROM used GROUP BY ALL
UNION ALL SELECT 'month', cast(date_trunc('month', event_date) AS DATE), count(DISTINCT user_id) FROM used GROUP BY ALL
UNION ALL SELECT 'all', NULL, count(DISTINCT user_id) FROM used""")
_oracle("d7_having_positive_cost", f"SELECT customer_sk, {_sum_amount('cost_amount')} AS cost_amount FROM v_costs GROUP BY 1 HAVING sum(cost_amount) > 0")
_oracle("d7_having_repeated_key", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
_AVG_PRICE = "cast(avg(cast(r.unit_price AS DOUBLE)) + 1e-15 AS DECIMAL(18,10))"
_oracle("d8_usage_window", f"""
SELECT customer_sk, f.product_id, min(date_id) AS usage_window_start, max(date_id) AS usage_window_end, {_AVG_PRICE} AS avg_unit_price,
  max(f.rate_sk) AS max_rate_sk, max(f.currency) AS currency
FROM v_costs_all f LEFT JOIN v_rates r ON r.rate_sk = f.rate_sk GROUP BY 1, 2""")

# ---- pricing

_oracle("e1_current_customer", "SELECT g.*, c.customer_sk, c.plan_id FROM v_daily g JOIN v_customers c ON c.customer_id = g.customer_id")
_oracle("e2_effective_rate", """
SELECT event_date, customer_id, g.product_id, g.unit, total_quantity, rate_sk, unit_price, effective_from
FROM v_daily g JOIN v_rates_split r ON r.product_id = g.product_id AND r.unit = g.unit
  AND event_date BETWEEN effective_from AND coalesce(effective_to, DATE '9999-12-31')""")
_oracle("e3_daily_cost_asrun", "SELECT * FROM v_costs_all")
_oracle("e3_daily_cost_fixed", "SELECT * FROM v_costs_split")
_oracle("e4_daily_cost_model", f"""
SELECT g.event_date AS date_id, c.customer_sk, g.product_id, g.unit, g.total_quantity, g.total_quantity AS billable_quantity,
  {_money("g.total_quantity", "r.unit_price")} AS cost_amount, r.currency, g.event_count
FROM v_daily_unique g JOIN v_customers c ON c.customer_id = g.customer_id
JOIN v_rates_split r ON r.product_id = g.product_id AND r.unit = g.unit AND r.rate_sk > 100 AND g.event_date >= r.effective_from""")
_oracle("e5_plan_aware_cost", "SELECT * FROM v_costs")
_oracle("e6_point_in_time_customer", """
SELECT event_date, g.customer_id, product_id, unit, total_quantity, last_event_ts, plan_id, status, effective_start
FROM v_daily g JOIN v_history h ON h.customer_id = g.customer_id AND last_event_ts >= effective_start
  AND (effective_end IS NULL OR last_event_ts < effective_end)""")
_oracle("e6_after_last_snapshot", """
SELECT event_date + 60 AS event_date, g.customer_id, product_id, unit, total_quantity, plan_id, effective_start
FROM v_daily g JOIN v_history h ON h.customer_id = g.customer_id AND last_event_ts + INTERVAL 60 DAY >= effective_start
  AND (effective_end IS NULL OR last_event_ts + INTERVAL 60 DAY < effective_end)""")
_oracle("e7_base_fee_lines", f"""
SELECT invoice_id, {_key("invoice_id", "'base_fee'")} AS line_item_id, 'base_fee' AS line_type, cast(NULL AS VARCHAR) AS product_id,
  cast(NULL AS VARCHAR) AS unit, cast(1 AS DECIMAL(28,6)) AS quantity, cast(base_fee AS DECIMAL(18,10)) AS unit_price,
  cast(base_fee AS DECIMAL(38,10)) AS amount, cast(NULL AS BIGINT) AS rate_sk, billing_period_start AS usage_window_start,
  billing_period_end AS usage_window_end, 'close' AS calc_batch_id, billing_period_start
FROM v_invoices i JOIN v_customers c ON c.customer_sk = i.customer_sk JOIN v_plans p ON p.plan_id = c.plan_id""")
_oracle("e7_fees_by_month", """
SELECT customer_id, m AS billing_period_start, last_day(m) AS billing_period_end, h.plan_id, base_fee
FROM v_history h, (VALUES (DATE '2023-12-01'), (DATE '2024-01-01'), (DATE '2024-02-01')) AS months(m), v_plans p
WHERE p.plan_id = h.plan_id AND h.status <> 'cancelled' AND effective_start < m + INTERVAL 1 MONTH
  AND (effective_end IS NULL OR effective_end >= m + INTERVAL 1 MONTH)""")
_oracle("e7_close_all_customers", f"""
SELECT coalesce(i.invoice_id, {_key("c.customer_sk", "DATE '2024-01-01'")}) AS invoice_id, c.customer_sk, t AS subtotal, t AS total, 'USD' AS currency,
  t AS line_total, CASE WHEN c.status = 'cancelled' THEN 0 ELSE 1 END AS fee_lines
FROM (
  SELECT c.*, cast(coalesce(i.subtotal, 0) + CASE WHEN c.status = 'cancelled' THEN 0 ELSE p.base_fee END AS DECIMAL(38,10)) AS t
  FROM v_customers c JOIN v_plans p ON p.plan_id = c.plan_id LEFT JOIN v_invoices i ON i.customer_sk = c.customer_sk
) c LEFT JOIN v_invoices i ON i.customer_sk = c.customer_sk
WHERE i.invoice_id IS NOT NULL OR c.status <> 'cancelled'""")

# ---- invoicing

_oracle("f1_close_headers", "SELECT * FROM v_invoices_all")
_oracle("f1_close_headers_plan_aware", "SELECT * FROM v_invoices")


def _month_headers(costs: str, where: str, taxed: bool, rate: str = "0.08") -> str:
    def cents(factor: str) -> str:
        return f"cast(round(cast(sum(cost_amount) AS DECIMAL(28,10)) * cast({factor} AS DECIMAL(9,8)), 2) AS DECIMAL(38,10))"

    total = _sum_amount("cost_amount")
    tax, gross = (cents(f"'{rate}'"), cents(f"'{1 + Decimal(rate)}'")) if taxed else ("cast(0 AS DECIMAL(38,10))", total)
    start = "cast(date_trunc('month', date_id) AS DATE)"
    return f"""
SELECT {_key("customer_sk", start)} AS invoice_id, customer_sk, {start} AS billing_period_start, last_day(min(date_id)) AS billing_period_end,
  TIMESTAMP '{ISSUED}' AS issued_ts, 'issued' AS status, {total} AS subtotal, {tax} AS tax, {gross} AS total, max(currency) AS currency
FROM {costs} WHERE {where} GROUP BY customer_sk, {start} HAVING sum(cost_amount) > 0"""


_block("v_recent", _month_headers("v_costs_all", "date_id >= DATE '2023-11-01'", True))
_block("v_model", _month_headers("v_costs", "true", False))
_block("v_model_all", _month_headers("v_costs_all", "true", False))
_block("v_model_orders", _month_headers("v_order_costs", "true", False))
_oracle("f2_recent_month_headers", "SELECT * FROM v_recent")
_oracle("f2_odd_tax_rate", _month_headers("v_costs_all", "date_id >= DATE '2023-11-01'", True, "0.08875"))
_oracle("f2_recent_order_headers", _month_headers("v_order_costs", "date_id >= DATE '2001-04-01'", True))
_oracle("f3_model_headers", "SELECT * FROM v_model")
_oracle("f3_model_order_headers", "SELECT * FROM v_model_orders")
_oracle("f4_lines_by_rate", "SELECT * FROM v_lines_all")
_oracle("f5_lines_without_rate", f"""
SELECT invoice_id, {_key("invoice_id", "'usage'", "f.product_id", "f.unit")} AS line_item_id, 'usage' AS line_type, f.product_id, f.unit,
  {_sum_quantity("billable_quantity")} AS quantity, {_AVG_PRICE} AS unit_price, {_sum_amount("cost_amount")} AS amount,
  max(f.rate_sk) AS rate_sk, min(date_id) AS usage_window_start, max(date_id) AS usage_window_end, 'close' AS calc_batch_id,
  i.billing_period_start
FROM v_costs_all f JOIN v_recent i ON i.customer_sk = f.customer_sk AND date_id BETWEEN billing_period_start AND billing_period_end
LEFT JOIN v_rates r ON r.rate_sk = f.rate_sk GROUP BY invoice_id, f.product_id, f.unit, i.billing_period_start""")


def _model_lines(costs: str, headers: str) -> str:
    return f"""
SELECT {_key("invoice_id", "product_id", "unit")} AS line_item_id, invoice_id, 'usage' AS line_type, product_id, unit, quantity,
  cast(CASE WHEN quantity > 0 THEN round(cast(amount AS DOUBLE) / cast(quantity AS DOUBLE) + 1e-11, 6) ELSE 0 END AS DECIMAL(18,6)) AS unit_price,
  amount, p.currency
FROM ({_by_product(costs)}) p JOIN {headers} i ON i.customer_sk = p.customer_sk AND i.billing_period_start = p.billing_period_start
WHERE amount > 0"""


_oracle("f6_model_lines", _model_lines("v_costs_all", "v_model_all"))
_oracle("f6_model_order_lines", _model_lines("v_order_costs", "v_model_orders"))
_oracle("f7_period_bounds", """
SELECT DISTINCT cast(l_shipdate AS DATE) AS run_date, cast(date_trunc('month', l_shipdate) - INTERVAL 1 MONTH AS DATE) AS billing_period_start,
  cast(date_trunc('month', l_shipdate) - INTERVAL 1 DAY AS DATE) AS billing_period_end FROM lineitem""")
_oracle("f8_audit_trail", f"""
SELECT invoice_id, line_item_id, g.customer_id, g.product_id, g.event_date, 'run_' || g.event_date AS source_batch_id,
  {_key("g.event_date", "g.customer_id", "g.product_id", "g.unit", "g.total_quantity", "g.event_count")} AS agg_row_hash,
  l.rate_sk, calc_batch_id
FROM v_lines l JOIN v_invoices i USING (invoice_id) JOIN v_customers c USING (customer_sk)
JOIN v_daily g ON g.customer_id = c.customer_id AND g.product_id = l.product_id AND g.unit = l.unit
  AND g.event_date BETWEEN usage_window_start AND usage_window_end""")
_LABEL = "array_to_string(list_transform(string_split(replace({}, 'prod_', ''), '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def _plain(value: str, digits: int) -> str:
    return f"cast(cast(round({value}, {digits}) AS DECIMAL(38,{digits})) AS VARCHAR)"


_oracle("f9_invoice_document", f"""
SELECT i.invoice_id, left(i.invoice_id, 16) || '...' AS invoice_label, upper(i.status) AS status_label,
  billing_period_start || ' to ' || billing_period_end AS period, cast(cast(issued_ts AS DATE) AS VARCHAR) AS issued,
  coalesce(customer_name, 'N/A') AS bill_to, coalesce(customer_id, cast(i.customer_sk AS VARCHAR)) AS customer_label,
  '$' || {_plain("subtotal", 2)} AS subtotal_text, '$' || {_plain("tax", 2)} AS tax_text,
  '$' || {_plain("total", 2)} || '  ' || coalesce(currency, 'USD') AS total_text, line_item_id,
  {_LABEL.format("product_id")} AS product, line_type AS type, {_plain("quantity", 2)} AS quantity_text, unit,
  '$' || {_plain("unit_price", 4)} AS unit_price_text, '$' || {_plain("amount", 2)} AS amount_text
FROM v_invoices i LEFT JOIN v_customers c ON c.customer_sk = i.customer_sk
LEFT JOIN (SELECT * EXCLUDE (billing_period_start) FROM v_lines) l ON l.invoice_id = i.invoice_id""")

# ---- late arrivals


def _late(headers: str) -> str:
    return f"""
SELECT e.event_id, e.event_date, e.customer_id, e.product_id, e.quantity, e.unit, i.invoice_id, i.issued_ts, c.customer_sk, c.plan_id, e.n
FROM v_events e JOIN v_customers c ON c.customer_id = e.customer_id JOIN {headers} i ON i.customer_sk = c.customer_sk
  AND e.event_date BETWEEN i.billing_period_start AND i.billing_period_end
WHERE i.status = 'issued' AND e.load_ts > i.issued_ts"""


def _candidates(late: str, by_plan: bool) -> str:
    plan = "AND r.plan_id = e.plan_id" if by_plan else ""
    return f"""
SELECT e.event_id, e.event_date, e.invoice_id, DATE '2024-01-01' AS billing_period_start, e.product_id, e.unit, e.quantity, r.unit_price,
  {_money("e.quantity", "r.unit_price")} AS adjustment_amount, r.rate_sk,
  {_key("e.invoice_id", "'adjustment'", "e.event_id", "r.rate_sk")} AS line_item_id, e.n
FROM {late} e JOIN v_rates r ON r.product_id = e.product_id AND r.unit = e.unit {plan} AND e.event_date >= r.effective_from"""


_block("v_late", _late("v_invoices_in_time"))
_block("v_late_all", _late("v_invoices_in_time_all"))
_block("v_candidates", _candidates("v_late", True))
_oracle("g1_late_events", "SELECT * EXCLUDE (customer_sk, plan_id, n) FROM v_late")
_block("v_candidates_all", _candidates("v_late_all", False))
_oracle("g2_late_priced_asrun", "SELECT * EXCLUDE (n, line_item_id) FROM v_candidates_all")
_oracle("g2_late_priced_fixed", "SELECT * EXCLUDE (n) FROM v_candidates WHERE product_id <> 'prod_storage_gb'")
_oracle("g3_adjustment_lines", """
SELECT invoice_id, line_item_id, 'adjustment' AS line_type, product_id, unit, cast(quantity AS DECIMAL(28,6)) AS quantity, unit_price,
  adjustment_amount AS amount, rate_sk, event_date AS usage_window_start, event_date AS usage_window_end, 'late' AS calc_batch_id,
  billing_period_start FROM v_candidates""")
_ADJUSTED = """
SELECT i.* REPLACE (cast(subtotal + coalesce(extra, 0) AS DECIMAL(38,10)) AS subtotal, cast(total + coalesce(extra, 0) AS DECIMAL(38,10)) AS total)
FROM v_invoices_in_time i LEFT JOIN (SELECT invoice_id, sum(adjustment_amount) AS extra FROM v_candidates GROUP BY 1) a
  ON a.invoice_id = i.invoice_id"""
_oracle("g4_adjusted_headers", _ADJUSTED)
_oracle("g1_late_since_last", _ADJUSTED)
_oracle("g5_price_differences", f"""
SELECT * FROM (
  SELECT coalesce(w.invoice_id, b.invoice_id) AS invoice_id, coalesce(w.product_id, b.product_id) AS product_id,
    coalesce(w.unit, b.unit) AS unit, cast(coalesce(now, 0) AS DECIMAL(38,10)) AS recomputed_amount,
    cast(coalesce(billed, 0) AS DECIMAL(38,10)) AS billed_amount,
    cast(coalesce(q_now, 0) - coalesce(q_billed, 0) AS DECIMAL(28,6)) AS quantity_difference,
    cast(coalesce(now, 0) - coalesce(billed, 0) AS DECIMAL(38,10)) AS adjustment_amount
  FROM (SELECT invoice_id, product_id, unit, sum(cost_amount) AS now, sum(billable_quantity) AS q_now
    FROM v_costs f JOIN v_invoices_in_time i ON i.customer_sk = f.customer_sk AND date_id BETWEEN billing_period_start AND billing_period_end
    GROUP BY 1, 2, 3) w
  FULL JOIN (SELECT invoice_id, product_id, unit, sum(amount) AS billed, sum(quantity) AS q_billed FROM v_lines_in_time GROUP BY 1, 2, 3) b
    ON b.invoice_id = w.invoice_id AND b.product_id = w.product_id AND b.unit = w.unit)
WHERE adjustment_amount <> 0 OR quantity_difference <> 0""")
_half = "SELECT {inv} AS invoice_id, product_id, unit, sum(cost_amount) AS amount, sum(billable_quantity) AS q FROM {costs} WHERE date_id BETWEEN DATE '2024-01-01' AND DATE '2024-01-15' GROUP BY 1, 2, 3"
_oracle("g5_half_month", f"""
SELECT * FROM (
  SELECT coalesce(w.invoice_id, b.invoice_id) AS invoice_id, coalesce(w.product_id, b.product_id) AS product_id, coalesce(w.unit, b.unit) AS unit,
    cast(coalesce(w.amount, 0) AS DECIMAL(38,10)) AS recomputed_amount, cast(coalesce(b.amount, 0) AS DECIMAL(38,10)) AS billed_amount,
    cast(coalesce(w.q, 0) - coalesce(b.q, 0) AS DECIMAL(28,6)) AS quantity_difference,
    cast(coalesce(w.amount, 0) - coalesce(b.amount, 0) AS DECIMAL(38,10)) AS adjustment_amount
  FROM (SELECT * FROM ({_half.format(inv=_key("customer_sk", "DATE '2024-01-01'"), costs="v_costs")}) x WHERE invoice_id IN (
    SELECT {_key("customer_sk", "DATE '2024-01-01'")} FROM v_costs_in_time WHERE date_id BETWEEN DATE '2024-01-01' AND DATE '2024-01-15')) w
  FULL JOIN ({_half.format(inv=_key("customer_sk", "DATE '2024-01-01'"), costs="v_costs_in_time")}) b
    ON b.invoice_id = w.invoice_id AND b.product_id = w.product_id AND b.unit = w.unit)
WHERE adjustment_amount <> 0 OR quantity_difference <> 0""")
_oracle("g6_unmerged_days", """
SELECT event_date, count(*) AS missing_events, cast(sum(c) AS BIGINT) AS deliveries FROM (
  SELECT event_id, event_date, count(*) AS c FROM v_landed WHERE event_date <> dt GROUP BY 1, 2) s
WHERE NOT EXISTS (SELECT 1 FROM v_landed m WHERE m.event_id = s.event_id AND m.event_date = m.dt) GROUP BY event_date""")

# ---- data quality


def _check(name: str, count: str) -> str:
    return f"SELECT '{name}' AS \"check\", cast(({count}) AS BIGINT) AS violations"


def _duplicates(table: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


_oracle("h1_duplicate_events", _check("duplicate_event_id", _duplicates("v_deliveries", "event_id")))
_oracle("h2_negative_quantity", _check("negative_quantity", "SELECT count(*) FROM v_defects WHERE sent < 0 AND n % 20 <> 1"))
_UNPRICED = "NOT EXISTS (SELECT 1 FROM v_rates r WHERE r.product_id = g.product_id AND r.unit = g.unit AND g.event_date >= r.effective_from {})"
_oracle("h3_pricing_coverage", _check("unpriced_usage", f"SELECT count(*) FROM v_daily g WHERE {_UNPRICED.format('')}"))
_oracle("h3_pricing_coverage_by_plan", _check("unpriced_usage", f"""
SELECT count(*) FROM v_daily g LEFT JOIN v_customers c ON c.customer_id = g.customer_id WHERE {_UNPRICED.format("AND r.plan_id = c.plan_id")}"""))
_oracle("h3_unpriced_rows", f"SELECT * FROM v_daily g WHERE {_UNPRICED.format('')}")
_MISMATCH = """
SELECT count(*) FROM {} i JOIN (SELECT invoice_id, sum(amount) AS s FROM {} GROUP BY 1) l ON l.invoice_id = i.invoice_id
WHERE abs(subtotal - s) > 0.01"""
_oracle("h4_invoice_integrity", _check("invoice_integrity", _MISMATCH.format("v_invoices", "v_lines_in_time")))
_oracle("h4_with_fees", """
SELECT invoice_id, t AS subtotal, t AS total, t AS line_total FROM (
  SELECT invoice_id, cast(subtotal + base_fee AS DECIMAL(38,10)) AS t
  FROM v_invoices i JOIN v_customers c ON c.customer_sk = i.customer_sk JOIN v_plans p ON p.plan_id = c.plan_id)""")
_oracle("h5_integrity_asrun", """
SELECT header_total, line_total, cast(abs(header_total - line_total) AS DECIMAL(38,10)) AS difference FROM (
  SELECT cast(coalesce(sum(i.total), 0) AS DECIMAL(38,10)) AS header_total, cast(coalesce(sum(l.amount), 0) AS DECIMAL(38,10)) AS line_total
  FROM v_invoices_all i LEFT JOIN v_lines_all l ON l.invoice_id = i.invoice_id)""")
_oracle("h6_gate", "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join([
    _check("duplicate_event_id", _duplicates("v_unique", "event_id")),
    _check("negative_quantity", "SELECT count(*) FROM v_unique WHERE quantity < 0"),
    _check("invoice_integrity", _MISMATCH.format("v_invoices", "v_lines")),
]) + ")")
_oracle("h7_not_null", " UNION ALL ".join(
    _check(f"not_null_{c}", f"SELECT count(*) FROM v_events WHERE n % 20 IN ({r}, 7)")
    for c, r in (("event_id", 1), ("customer_id", 2), ("product_id", 3), ("quantity", 5), ("event_ts", 4))
))
_oracle("h8_unique", " UNION ALL ".join(
    _check(f"unique_{k}", _duplicates(t, k)) for t, k in (
        ("v_deliveries", "event_id"), ("v_customers", "customer_id"), ("v_invoices", "invoice_id"), ("v_lines", "line_item_id"))
))
_oracle("h9_accepted_values", " UNION ALL ".join([
    _check("accepted_values_product_id", "SELECT count(*) FROM v_events WHERE product_id = 'prod_unknown'"),
    _check("accepted_values_status", "SELECT count(*) FROM v_customers WHERE status NOT IN ('active', 'delinquent', 'cancelled')"),
]))
_oracle("h10_relationships", " UNION ALL ".join([
    _check("relationships_invoice_id", f"SELECT count(*) FROM ({_model_lines('v_costs', 'v_model')}) WHERE invoice_id NOT IN (SELECT invoice_id FROM v_model)"),
    _check("relationships_customer_sk", "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT customer_sk FROM v_costs)"),
]))

# ---- operations

_AUDIT = f"""
SELECT DISTINCT 'backfill_' || dt AS run_id, 'daily_usage_billing' AS job, 'ALL' AS task, dt AS execution_date, 'SUCCESS' AS status,
  {AS_OF} AS created_ts FROM v_landed"""
_oracle("i1_run_audit", _AUDIT)
_COUNTERS = f"""
SELECT count(*) FILTER (WHERE action = 'insert') AS rows_inserted, count(*) FILTER (WHERE action = 'update') AS rows_updated
FROM ({_merge(True, False)})"""
_oracle("i2_merge_counters", _COUNTERS)
_oracle("i2_observed_counters", _COUNTERS)
_oracle("i3_checkpoint", f"""
SELECT 'daily_usage_billing' AS job, max(event_ts) AS last_event_ts, max(load_ts) AS last_ingest_ts, max(dt) AS last_dt,
  {AS_OF} AS updated_ts FROM v_landed""")
_oracle("i3_after_checkpoint", """
SELECT event_id, event_ts, load_ts AS ingest_ts FROM v_landed
WHERE load_ts > (SELECT max(load_ts) FROM v_landed WHERE dt < DATE '2024-01-21')""")

# ---- serving

_COUNTS = f"""
(SELECT count(DISTINCT customer_id) FROM v_customers WHERE is_current) AS total_customers,
  (SELECT count(*) FROM {{}} WHERE status = 'issued') AS active_invoices,
  (SELECT count(*) FROM v_events WHERE event_date = DATE '{TODAY}') AS total_events_today"""
_oracle("j1_dashboard_asrun", f"""
SELECT cast(coalesce(sum(f.cost_amount), 0) AS DECIMAL(38,10)) AS total_revenue_mtd, {_COUNTS.format("v_invoices_all")},
  cast(coalesce(avg(daily_total), 0) AS DECIMAL(38,6)) AS avg_daily_revenue
FROM v_costs_all f LEFT JOIN (SELECT date_id, sum(cost_amount) AS daily_total FROM v_costs_all GROUP BY 1) d ON true
WHERE f.date_id >= DATE '2024-01-01'""")
_oracle("j1_dashboard_fixed", f"""
SELECT cast(coalesce(sum(daily_total), 0) AS DECIMAL(38,10)) AS total_revenue_mtd, {_COUNTS.format("v_invoices")},
  cast(coalesce(avg(daily_total), 0) AS DECIMAL(38,6)) AS avg_daily_revenue
FROM (SELECT date_id, sum(cost_amount) AS daily_total FROM v_costs WHERE date_id >= DATE '2024-01-01' GROUP BY 1)""")
_CUSTOMER_COLUMNS = "customer_sk, customer_id, customer_name, status, country, plan_id, is_current"
_oracle("j2_customers", f"SELECT {_CUSTOMER_COLUMNS} FROM v_customers WHERE is_current AND status = 'delinquent'")
_oracle("j2_customers_all", f"SELECT {_CUSTOMER_COLUMNS} FROM v_customers WHERE is_current")
_oracle("j3_customer_usage", """
SELECT date_id, product_id, unit, total_quantity, cost_amount, currency FROM v_costs JOIN v_customers USING (customer_sk)
WHERE customer_id = 'cust_1' AND date_id BETWEEN DATE '2024-01-05' AND DATE '2024-01-31'""")
_NAMED = """
SELECT i.invoice_id, i.customer_sk, c.customer_name, i.billing_period_start, i.billing_period_end, i.issued_ts, i.status, i.subtotal,
  i.tax, i.total, i.currency FROM v_invoices i LEFT JOIN v_customers c ON c.customer_sk = i.customer_sk AND c.is_current"""
_block("v_named", _NAMED)
_oracle("j4_invoices", "SELECT * FROM v_named WHERE status = 'issued'")
_oracle("j4_invoices_of_customer", "SELECT * FROM v_named WHERE customer_sk = 1")
_oracle("j5_invoice_detail", f"""
SELECT h.*, line_item_id, line_type, product_id, unit, quantity, unit_price, amount,
  CASE WHEN line_item_id IS NOT NULL THEN TIMESTAMP '{ISSUED}' END AS load_ts
FROM v_named h LEFT JOIN v_lines l ON l.invoice_id = h.invoice_id""")


def _report(costs: str, where: str) -> str:
    return f"""
SELECT date_id, product_id, unit, {_sum_quantity("total_quantity")} AS total_quantity, {_sum_amount("cost_amount")} AS cost_amount,
  max(currency) AS currency FROM {costs} JOIN v_customers USING (customer_sk) WHERE {where} GROUP BY 1, 2, 3"""


_block("v_report", _report("v_costs", f"date_id >= DATE '{TODAY}' - 90"))
_oracle("j6_usage_report", "SELECT * FROM v_report")
_oracle("j6_order_usage_report", _report("v_order_costs", "date_id >= DATE '1995-01-01'"))
_oracle("j7_latest_runs", f"SELECT run_id, job, status, created_ts FROM ({_AUDIT}) ORDER BY created_ts DESC, run_id DESC LIMIT 10")
_oracle("j8_current_rates", """
SELECT product_id, plan_id, unit, unit_price, currency, effective_from, effective_to FROM v_versions WHERE is_current""")

# ---- dashboard

_oracle("k1_revenue_over_time", f"SELECT date_id, {_sum_amount('cost_amount')} AS cost FROM v_report GROUP BY 1")
_oracle("k2_quantity_by_product", f"SELECT product_id, {_sum_quantity('total_quantity')} AS quantity FROM v_report GROUP BY 1")
_oracle("k3_quantity_trend", f"SELECT date_id, {_sum_quantity('total_quantity')} AS quantity FROM v_report WHERE product_id = 'prod_storage_gb' GROUP BY 1")
_oracle("k4_product_summary", f"""
SELECT product_id, {_sum_quantity("total_quantity")} AS quantity, {_sum_amount("cost_amount")} AS cost, min(unit) AS unit,
  {_LABEL.format("product_id")} AS name FROM v_report GROUP BY product_id""")
_oracle("k5_products_present", "SELECT DISTINCT product_id FROM v_report")
_oracle("k6_customer_cost_by_day", f"SELECT date_id, {_sum_amount('cost_amount')} AS cost FROM v_costs WHERE customer_sk = 1 GROUP BY 1")
_oracle("k6_customer_products", f"""
SELECT customer_sk, product_id, {_sum_quantity("total_quantity")} AS quantity, {_sum_amount("cost_amount")} AS cost FROM v_costs GROUP BY 1, 2""")
_oracle("k7_customer_search", "SELECT * FROM v_customers WHERE customer_name ILIKE '%customer#0000000%'")
_oracle("k8_recent_invoices", "SELECT * FROM v_named ORDER BY issued_ts DESC, invoice_id LIMIT 5")
_oracle("k9_rates_by_plan", """
SELECT plan_id, upper(replace(plan_id, 'plan_', '')[1]) || replace(plan_id, 'plan_', '')[2:] AS plan,
  count(*) OVER (PARTITION BY plan_id) AS rates_in_plan, product_id, unit, unit_price, currency, effective_from
FROM v_versions WHERE is_current""")
_oracle("k10_usage_matrix", "SELECT date_id, " + ", ".join(
    f"cast(coalesce(sum(total_quantity) FILTER (WHERE product_id = '{p}'), 0) AS DECIMAL(28,6)) AS {p}"
    for p in ("prod_api_requests", "prod_storage_gb", "prod_compute_minutes")
) + """, cast(coalesce(sum(total_quantity) FILTER (WHERE product_id = 'prod_ai_tokens'), 0) AS DECIMAL(28,6)) AS other_products
FROM v_report GROUP BY date_id""")
_oracle("k10_usage_by_product", f"SELECT date_id, product_id, {_sum_quantity('total_quantity')} AS quantity FROM v_report GROUP BY 1, 2")

# ---- scalar functions

_oracle("l1_payload_paths", """
SELECT json_extract_string(doc, '$.event_id') AS event_id, cast(json_extract_string(doc, '$.quantity') AS DOUBLE) AS quantity,
  json_extract_string(doc, '$.nothing') AS nothing FROM v_json""")
_oracle("l2_build_object", """
SELECT '{"currency":"' || currency || '","effective_from":"' || effective_from || '","effective_to":'
  || coalesce('"' || effective_to || '"', 'null') || ',"plan_id":"' || plan_id || '","price":"' || price || '","product_id":"'
  || product_id || '","unit":"' || unit || '"}' AS payload FROM v_catalog""")
_oracle("l3_casts", """
SELECT rate_id, effective_from, effective_to, cast(price AS DOUBLE) AS price, try_cast(plan_id AS DATE) AS not_a_date FROM v_catalog""")
_oracle("l4_dates", """
SELECT DISTINCT d AS day, cast(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end, d - 90 AS ninety_before,
  cast(d - INTERVAL 2 MONTH AS DATE) AS two_months_before FROM (SELECT cast(l_shipdate AS DATE) AS d FROM lineitem)""")
_oracle("l5_run_time", f"SELECT event_id, {AS_OF} AS as_of, load_ts > {AS_OF} AS after_run FROM v_events")
_oracle("l6_nulls", """
SELECT rate_id, coalesce(cast(effective_to AS VARCHAR), '9999-12-31') AS ends, effective_to IS NULL AS is_open, effective_to IS NOT NULL AS has_end
FROM v_catalog""")
_oracle("l7_conditionals", """
SELECT event_id, CASE WHEN quantity > 100 THEN 'large' WHEN quantity > 10 THEN 'medium' ELSE 'small' END AS size,
  CASE WHEN quantity > 0 THEN 1 ELSE 0 END AS is_positive FROM v_events""")
_oracle("l8_math", f"""
SELECT event_id, cast(round(quantity, 1) AS DECIMAL(18,1)) AS rounded, cast(abs(quantity - 50) AS DECIMAL(19,6)) AS distance,
  {_money("quantity", "0.000002")} AS amount, CASE WHEN quantity <> 0 THEN 1.0::DOUBLE / cast(quantity AS DOUBLE) END AS guarded FROM v_events""")
_oracle("l9_hashes", f"SELECT event_id, md5(customer_id) AS customer_md5, {_key('customer_id', 'event_date')} AS day_key FROM v_events")
_oracle("l10_predicates", """
SELECT event_id, customer_id, event_date, product_id FROM v_events
WHERE product_id IN ('prod_api_requests', 'prod_storage_gb', 'prod_compute_minutes', 'prod_ai_tokens')
  AND event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND customer_id NOT IN (SELECT customer_id FROM v_customers WHERE status = 'active')""")
_oracle("l11_product_labels", f"SELECT event_id, {_LABEL.format('product_id')} AS product FROM v_events")
_oracle("l12_plan_and_id_labels", """
SELECT event_id, upper(replace(plan_id, 'plan_', '')[1]) || replace(plan_id, 'plan_', '')[2:] AS plan, left(raw_hash, 8) AS short,
  left(raw_hash, 16) AS document_id FROM v_events""")
_oracle("l13_money_and_numbers", """
SELECT o_orderkey, '$' || p AS plain, '$' || p || '00' AS four, '$' || format('{:,d}', w) || right(p, 3) AS grouped,
  format('{:,d}', w) || regexp_replace(regexp_replace(right(p, 3), '0+$', ''), '\\.$', '') AS number
FROM (SELECT o_orderkey, cast(cast(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS p, cast(trunc(cast(o_totalprice AS DECIMAL(18,2))) AS BIGINT) AS w FROM orders)""")

# ---- streams: the batch results

_oracle("m1_stream_ingest", f"SELECT {AS_OF} AS ingest_ts, 'API' AS source, dt, event_id FROM v_landed")
_oracle("m2_stream_dedup", "SELECT event_id, event_ts, customer_id, product_id, quantity FROM v_unique")
_oracle("m2_compacted", "SELECT event_id, event_ts, customer_id, product_id, quantity FROM v_unique")
_oracle("m3_compacted", "SELECT * FROM v_daily_unique")
_oracle("m4_stream_rejects", "SELECT error_reason, count(*) AS rejected FROM v_defects WHERE error_reason IS NOT NULL GROUP BY 1")
_oracle("m3_stream_daily_usage", "SELECT * FROM v_daily_unique")
_oracle("m4_stream_upsert", f"""
SELECT event_id, event_ts, event_date, customer_id, product_id, plan_id, region, unit, quantity, 'API' AS source, {AS_OF} AS load_ts,
  'run_1' AS batch_id FROM v_unique""")
_oracle("m5_stream_late_routing", _ADJUSTED)
