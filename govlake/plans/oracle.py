"""Oracle SQL: for each registered query, the same result written in plain SQL
that DuckDB runs over the driver's parquet views.

Conventions (so both engines hash the same values): money is summed as
DECIMAL and cast to DOUBLE at the end, integer sums are cast to BIGINT,
rates are DOUBLE with NULLIF guards, and stamps are the fixed ``as_of``.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-03 00:00:00'"

_METHOD = """CASE o_orderpriority WHEN '1-URGENT' THEN 'CARD' WHEN '2-HIGH' THEN 'UPI'
  WHEN '3-MEDIUM' THEN 'WALLET' WHEN '4-NOT SPECIFIED' THEN 'NETBANKING' ELSE 'COD' END"""

ENTITIES = f"""
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
    CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST((c_custkey * 7) % 131 - 5 AS INT) END AS age,
    n_name AS city, c_mktsegment AS segment
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
sales_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey % 97 AS product_id, o_orderdate AS order_date,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'CANCELLED' END AS order_status,
    CASE WHEN o_orderkey % 53 = 0 THEN -CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
    CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE COALESCE(d.disc, CAST(0 AS DECIMAL(18,4))) END AS discount_amount
  FROM orders LEFT JOIN (
    SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS disc
    FROM lineitem GROUP BY l_orderkey) d ON o_orderkey = d.l_orderkey),
payments AS (
  SELECT o_orderkey * 10 + 1 AS payment_id, o_orderkey AS order_id,
    CASE o_orderkey % 10 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PENDING' ELSE 'SUCCESS' END AS payment_status,
    {_METHOD} AS payment_method, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders WHERE o_orderkey % 11 <> 0
  UNION ALL
  SELECT o_orderkey * 10 + 2, o_orderkey, 'SUCCESS', {_METHOD}, CAST(o_totalprice AS DECIMAL(18,2))
  FROM orders WHERE o_orderkey % 13 = 0),
refunds AS (
  SELECT l_orderkey * 10 + l_linenumber AS refund_id, l_orderkey AS order_id,
    CASE l_linenumber % 3 WHEN 0 THEN 'REJECTED' WHEN 1 THEN 'APPROVED' ELSE 'PENDING' END AS refund_status,
    CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(18,4))
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) END AS refund_amount,
    CASE l_linestatus WHEN 'F' THEN 'DAMAGED' ELSE 'LATE' END AS refund_reason
  FROM lineitem WHERE l_returnflag = 'R')"""

# Fact over the base policy (orders amount > 0, refunds refund_amount > 0),
# money still DECIMAL so KPIs sum exactly.
FACT = f"""
fact AS (
  SELECT o.order_id, o.customer_id, p.payment_id, r.refund_id, o.order_date, o.order_status,
    p.payment_status, p.payment_method, p.amount AS payment_amount,
    r.refund_status, r.refund_amount, r.refund_reason, o.discount_amount,
    p.amount - o.discount_amount AS net_amount, {AS_OF} AS processed_at
  FROM (SELECT * FROM sales_orders WHERE (amount > 0)) o
  LEFT JOIN customers c ON o.customer_id = c.customer_id
  LEFT JOIN payments p ON o.order_id = p.order_id
  LEFT JOIN (SELECT * FROM refunds WHERE (refund_amount > 0)) r ON o.order_id = r.order_id)"""


def with_ctes(*ctes: str):
    def build(body: str) -> str:
        return "WITH " + ",".join(ctes) + "\n" + body

    return build


W = with_ctes(ENTITIES)
WF = with_ctes(ENTITIES, FACT)

SUCCESS = "CASE WHEN payment_status = 'SUCCESS' THEN 1 ELSE 0 END"

SQL: dict[str, str] = {}

SQL["fact_orders"] = WF("""
SELECT order_id, customer_id, payment_id, refund_id, order_date, order_status, payment_status, payment_method,
  CAST(payment_amount AS DOUBLE) AS payment_amount, refund_status, CAST(refund_amount AS DOUBLE) AS refund_amount,
  refund_reason, CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(net_amount AS DOUBLE) AS net_amount,
  processed_at
FROM fact""")

SQL["kpi_daily_order_revenue"] = WF("""
SELECT CAST(order_date AS DATE) AS order_date, COUNT(DISTINCT order_id) AS total_orders,
  CAST(SUM(payment_amount) AS DOUBLE) AS gross_revenue, CAST(SUM(net_amount) AS DOUBLE) AS net_revenue
FROM fact GROUP BY 1""")

SQL["kpi_payment_success_rate"] = WF(f"""
SELECT CAST(order_date AS DATE) AS order_date, COUNT(payment_id) AS total_payments,
  CAST(SUM({SUCCESS}) AS BIGINT) AS successful_payments,
  ROUND(SUM({SUCCESS}) / NULLIF(COUNT(payment_id), 0) * 100, 2) AS payment_success_rate
FROM fact GROUP BY 1""")

SQL["kpi_refund_rate"] = WF("""
SELECT CAST(order_date AS DATE) AS order_date, COUNT(DISTINCT order_id) AS total_orders,
  COUNT(refund_id) AS refunded_orders, CAST(SUM(refund_amount) AS DOUBLE) AS total_refund_amount,
  ROUND(COUNT(refund_id) / NULLIF(COUNT(DISTINCT order_id), 0) * 100, 2) AS refund_rate
FROM fact GROUP BY 1""")

SQL["kpi_customer_lifetime_value"] = WF("""
SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders, CAST(SUM(net_amount) AS DOUBLE) AS lifetime_value,
  CAST(SUM(net_amount) AS DOUBLE) / NULLIF(CAST(COUNT(net_amount) AS DOUBLE), 0) AS avg_order_value
FROM fact GROUP BY customer_id""")

SQL["kpi_payment_method_performance"] = WF(f"""
SELECT payment_method, COUNT(payment_id) AS total_transactions,
  CAST(SUM({SUCCESS}) AS BIGINT) AS successful_transactions, CAST(SUM(net_amount) AS DOUBLE) AS total_revenue
FROM fact GROUP BY payment_method""")

SQL["kpi_discount_impact"] = WF("""
SELECT CAST(order_date AS DATE) AS order_date, CAST(SUM(discount_amount) AS DOUBLE) AS total_discount,
  CAST(SUM(payment_amount) AS DOUBLE) AS gross_revenue, CAST(SUM(net_amount) AS DOUBLE) AS net_revenue
FROM fact GROUP BY 1""")

KPI_DAILY_ALL = f"""
kpi_all AS (
SELECT CAST(order_date AS DATE) AS order_date, COUNT(DISTINCT order_id) AS total_orders,
  SUM(payment_amount) AS gross_revenue, SUM(net_amount) AS net_revenue,
  COUNT(payment_id) AS total_payments, CAST(SUM({SUCCESS}) AS BIGINT) AS successful_payments,
  ROUND(SUM({SUCCESS}) / NULLIF(COUNT(payment_id), 0) * 100, 2) AS payment_success_rate,
  COUNT(refund_id) AS refunded_orders, SUM(refund_amount) AS total_refund_amount,
  ROUND(COUNT(refund_id) / NULLIF(COUNT(DISTINCT order_id), 0) * 100, 2) AS refund_rate,
  SUM(discount_amount) AS total_discount
FROM fact GROUP BY 1)"""

WK = with_ctes(ENTITIES, FACT, KPI_DAILY_ALL)

SQL["kpi_daily_all"] = WK("""
SELECT order_date, total_orders, CAST(gross_revenue AS DOUBLE) AS gross_revenue, CAST(net_revenue AS DOUBLE) AS net_revenue,
  total_payments, successful_payments, payment_success_rate, refunded_orders,
  CAST(total_refund_amount AS DOUBLE) AS total_refund_amount, refund_rate, CAST(total_discount AS DOUBLE) AS total_discount
FROM kpi_all""")

SQL["fact_orders_dedup"] = W(f"""
SELECT o.order_id, o.customer_id, COALESCE(k.customer_known, FALSE) AS customer_known, o.order_date, o.order_status,
  COALESCE(p.payment_count, 0) AS payment_count, CAST(COALESCE(p.successful_payments, 0) AS BIGINT) AS successful_payments,
  CAST(p.payment_amount AS DOUBLE) AS payment_amount, CAST(p.successful_amount AS DOUBLE) AS successful_amount,
  COALESCE(r.refund_count, 0) AS refund_count, CAST(r.refund_amount AS DOUBLE) AS refund_amount,
  CAST(o.discount_amount AS DOUBLE) AS discount_amount,
  CAST(p.payment_amount - o.discount_amount AS DOUBLE) AS net_amount, {AS_OF} AS processed_at
FROM (SELECT * FROM sales_orders WHERE (amount > 0)) o
LEFT JOIN (SELECT DISTINCT customer_id, TRUE AS customer_known FROM customers) k ON o.customer_id = k.customer_id
LEFT JOIN (SELECT order_id, COUNT(payment_id) AS payment_count, SUM({SUCCESS}) AS successful_payments,
             SUM(amount) AS payment_amount, SUM(CASE WHEN payment_status = 'SUCCESS' THEN amount END) AS successful_amount
           FROM payments GROUP BY order_id) p ON o.order_id = p.order_id
LEFT JOIN (SELECT order_id, COUNT(refund_id) AS refund_count, SUM(refund_amount) AS refund_amount
           FROM (SELECT * FROM refunds WHERE (refund_amount > 0)) GROUP BY order_id) r ON o.order_id = r.order_id""")

# ------------------------------------------------------------ signals, insights
DM = """
dm AS (
SELECT order_date, total_orders, gross_revenue, net_revenue, payment_success_rate, refund_rate,
  CASE WHEN gross_revenue IS NOT NULL THEN total_discount END AS total_discount,
  CASE WHEN gross_revenue > 0 THEN ROUND(CAST(CASE WHEN gross_revenue IS NOT NULL THEN total_discount END AS DOUBLE) / CAST(gross_revenue AS DOUBLE) * 100, 2)
       ELSE 0.0 END AS discount_pct
FROM kpi_all WHERE net_revenue IS NOT NULL)"""

TR = """
tr AS (
SELECT *,
  CASE WHEN net_revenue_prev IS NOT NULL THEN ROUND(CAST(net_revenue - net_revenue_prev AS DOUBLE) / NULLIF(CAST(net_revenue_prev AS DOUBLE), 0) * 100, 2) END AS net_revenue_wow_pct,
  CASE WHEN orders_prev IS NOT NULL THEN ROUND(CAST(total_orders - orders_prev AS DOUBLE) / NULLIF(orders_prev, 0) * 100, 2) END AS orders_wow_pct
FROM (SELECT *, LAG(net_revenue, 1) OVER (ORDER BY order_date) AS net_revenue_prev,
        LAG(total_orders, 1) OVER (ORDER BY order_date) AS orders_prev FROM dm))"""

SIG = """
sig AS (
SELECT *,
  CASE WHEN payment_success_rate >= 97 THEN 'HEALTHY' WHEN payment_success_rate >= 95 THEN 'WARNING' ELSE 'CRITICAL' END AS payment_health,
  CASE WHEN refund_rate < 3 THEN 'LOW' WHEN refund_rate <= 8 THEN 'MEDIUM' ELSE 'HIGH' END AS refund_risk,
  CASE WHEN discount_pct < 10 THEN 'EFFICIENT' WHEN discount_pct <= 20 THEN 'MODERATE' ELSE 'WASTEFUL' END AS discount_health,
  (refund_rate > 8) OR (payment_success_rate < 95) OR (discount_pct > 20) AS risk_flag
FROM tr)"""

DRV = """
drv AS (
SELECT *,
  CASE WHEN net_revenue_wow_pct IS NULL THEN 'UNKNOWN'
       WHEN payment_success_rate < 95 AND net_revenue_wow_pct < 0 THEN 'OPERATIONAL_ISSUE'
       WHEN sign(net_revenue_wow_pct) = sign(orders_wow_pct) AND abs(orders_wow_pct) >= abs(net_revenue_wow_pct) / 2 THEN 'ORDER_VOLUME'
       WHEN discount_pct >= 10 AND net_revenue_wow_pct > 0 THEN 'PROMOTION'
       ELSE 'PRICE_MIX' END AS revenue_driver
FROM sig)"""


def NUM(c: str) -> str:
    return f"COALESCE(printf('%.2f', CAST(ROUND({c}, 2) AS DOUBLE)), 'n/a')"


INS = f"""
ins AS (
SELECT order_date AS insight_date, net_revenue, net_revenue_wow_pct, total_orders AS orders_count, orders_wow_pct,
  payment_success_rate, payment_health, refund_rate, refund_risk, discount_pct, discount_health, revenue_driver,
  CAST(order_date AS VARCHAR) || ': net revenue ' || {NUM('net_revenue')} || ' (' || {NUM('net_revenue_wow_pct')}
  || '% vs previous day) from ' || COALESCE(CAST(total_orders AS VARCHAR), 'n/a') || ' orders (' || {NUM('orders_wow_pct')}
  || '%). Payments ' || payment_health || ' at ' || {NUM('payment_success_rate')} || '%, refunds ' || refund_risk
  || ' at ' || {NUM('refund_rate')} || '%, discounts ' || discount_health || ' at ' || {NUM('discount_pct')}
  || '%. Driver: ' || revenue_driver || '.'
  || CASE WHEN risk_flag THEN ' Risk: ' || concat_ws('; ',
        CASE WHEN refund_rate > 8 THEN 'refund rate above 8%' END,
        CASE WHEN payment_success_rate < 95 THEN 'payment success below 95%' END,
        CASE WHEN discount_pct > 20 THEN 'discount above 20% of gross' END) || '.' ELSE '' END AS executive_summary,
  risk_flag, {AS_OF} AS generated_at
FROM drv)"""

WS = with_ctes(ENTITIES, FACT, KPI_DAILY_ALL, DM, TR, SIG, DRV, INS)

DM_COLS = """order_date, total_orders, CAST(gross_revenue AS DOUBLE) AS gross_revenue, CAST(net_revenue AS DOUBLE) AS net_revenue,
  payment_success_rate, refund_rate, CAST(total_discount AS DOUBLE) AS total_discount, CAST(discount_pct AS DOUBLE) AS discount_pct"""

SQL["daily_metrics"] = WS(f"SELECT {DM_COLS} FROM dm")
SQL["daily_metrics_joined"] = SQL["daily_metrics"]

SQL["daily_trends"] = WS(f"""
SELECT {DM_COLS}, CAST(net_revenue_prev AS DOUBLE) AS net_revenue_prev, orders_prev,
  CAST(net_revenue_wow_pct AS DOUBLE) AS net_revenue_wow_pct, orders_wow_pct FROM tr""")

SQL["weekly_change"] = WS("""
SELECT d.order_date, CAST(d.net_revenue AS DOUBLE) AS net_revenue, CAST(p.net_revenue AS DOUBLE) AS net_revenue_7d_prev,
  CAST(ROUND(CAST(d.net_revenue - p.net_revenue AS DOUBLE) / NULLIF(CAST(p.net_revenue AS DOUBLE), 0) * 100, 2) AS DOUBLE) AS net_revenue_7d_pct,
  d.total_orders, p.total_orders AS orders_7d_prev,
  ROUND(CAST(d.total_orders - p.total_orders AS DOUBLE) / NULLIF(p.total_orders, 0) * 100, 2) AS orders_7d_pct
FROM dm d LEFT JOIN dm p ON d.order_date = CAST(p.order_date + INTERVAL 7 DAY AS DATE)""")

SIG_COLS = f"""{DM_COLS}, CAST(net_revenue_prev AS DOUBLE) AS net_revenue_prev, orders_prev,
  CAST(net_revenue_wow_pct AS DOUBLE) AS net_revenue_wow_pct, orders_wow_pct, payment_health, refund_risk, discount_health, risk_flag"""

SQL["health_signals"] = WS(f"SELECT {SIG_COLS} FROM sig")

SQL["insight_input"] = WS("""
SELECT order_date AS date, CAST(net_revenue AS DOUBLE) AS net_revenue, CAST(net_revenue_wow_pct AS DOUBLE) AS net_revenue_wow_pct,
  total_orders, orders_wow_pct, payment_success_rate, payment_health, refund_rate, refund_risk,
  CAST(discount_pct AS DOUBLE) AS discount_pct, discount_health, risk_flag FROM sig""")

SQL["revenue_driver"] = WS("""
SELECT order_date, CAST(net_revenue_wow_pct AS DOUBLE) AS net_revenue_wow_pct, orders_wow_pct, revenue_driver FROM drv""")

INS_COLS = """insight_date, CAST(net_revenue AS DOUBLE) AS net_revenue, CAST(net_revenue_wow_pct AS DOUBLE) AS net_revenue_wow_pct,
  orders_count, orders_wow_pct, payment_success_rate, payment_health, refund_rate, refund_risk,
  CAST(discount_pct AS DOUBLE) AS discount_pct, discount_health, revenue_driver, executive_summary, risk_flag"""

SQL["daily_insights"] = WS(f"SELECT {INS_COLS}, generated_at FROM ins")

SQL["recent_insights"] = WS(f"SELECT {INS_COLS} FROM ins ORDER BY insight_date DESC LIMIT 14")


def PY(c: str) -> str:
    return f"COALESCE(CAST({c} AS VARCHAR), 'None')"


SQL["insight_context"] = WS(f"""
SELECT COUNT(*) AS days, string_agg(line, '\n' ORDER BY insight_date DESC) AS context_text FROM (
  SELECT insight_date,
    {PY('insight_date')} || ' | net revenue ' || {NUM('net_revenue')} || ' (week ' || {NUM('net_revenue_wow_pct')} || ' %) | orders '
    || {PY('orders_count')} || ' (week ' || {NUM('orders_wow_pct')} || ' %) | paid ' || {NUM('payment_success_rate')} || ' % [' || {PY('payment_health')}
    || '] | refunded ' || {NUM('refund_rate')} || ' % [' || {PY('refund_risk')} || '] | discounts ' || {NUM('discount_pct')}
    || ' % | moved by ' || {PY('revenue_driver')} || ' | needs attention: '
    || CASE WHEN risk_flag THEN 'yes' WHEN NOT risk_flag THEN 'no' ELSE 'unknown' END || chr(10) || '  ' || {PY('executive_summary')} AS line
  FROM ins ORDER BY insight_date DESC LIMIT 14)""")

_WS_RE = "[\\t\\n\\x0B\\f\\r ]"
_STRIP = f"'^{_WS_RE}+|{_WS_RE}+$'"

SQL["fenced_json"] = f"""
WITH said AS (
  SELECT conv_id, turn, role,
    CASE (conv_id + turn) % 3 WHEN 0 THEN 'Sure:' || chr(10) || '```json' || chr(10) || '{{"turn": ' || turn || '}}' || chr(10) || '```' || chr(10) || text
         WHEN 1 THEN '```' || chr(10) || text || chr(10) || '```'
         ELSE CASE WHEN turn % 2 = 0 THEN '{{"turn": ' || turn || '}}' ELSE text END END AS text
  FROM conversations),
raw AS (SELECT conv_id, turn, role, regexp_replace(text, {_STRIP}, '', 'g') AS raw FROM said),
f AS (SELECT *, CASE WHEN regexp_matches(raw, '(?s)```json(.*?)```') THEN 'json'
                     WHEN regexp_matches(raw, '(?s)```(.*?)```') THEN 'plain' ELSE 'none' END AS fence FROM raw),
b AS (SELECT conv_id, turn, role, fence,
        CASE fence WHEN 'json' THEN regexp_replace(regexp_extract(raw, '(?s)```json(.*?)```', 1), {_STRIP}, '', 'g')
                   WHEN 'plain' THEN regexp_replace(regexp_extract(raw, '(?s)```(.*?)```', 1), {_STRIP}, '', 'g')
                   ELSE raw END AS json_text FROM f)
SELECT conv_id, turn, role, fence, json_text, COALESCE(json_valid(json_text), FALSE) AS is_json FROM b"""

# ------------------------------------------------------------ silver gate
ORDER_COLS = "order_id, customer_id, product_id, order_date, order_status"
CUST_COLS = "customer_id, customer_name, age, city, segment"


def _stamp_silver(strategy, severity):
    return f"'{strategy}' AS guardian_strategy, '{severity}' AS drift_severity, {AS_OF} AS processed_at"


def _stamp_q(reason, strategy, severity):
    return (f"'{reason}' AS quarantine_reason, '{strategy}' AS guardian_strategy, "
            f"'{severity}' AS drift_severity, {AS_OF} AS quarantined_at")


SILVER_ORDERS_BODY = f"""
SELECT {ORDER_COLS}, CAST(amount AS DOUBLE) AS amount, CAST(discount_amount AS DOUBLE) AS discount_amount
FROM (SELECT {ORDER_COLS}, ABS(amount) AS amount, COALESCE(discount_amount, 0) AS discount_amount FROM sales_orders)
WHERE amount > 0 AND discount_amount <= amount"""

SQL["silver_orders"] = W(f"SELECT *, {_stamp_silver('BOTH', 'LOW')} FROM ({SILVER_ORDERS_BODY})")
SQL["quarantine_orders"] = W(f"""
SELECT {ORDER_COLS}, CAST(amount AS DOUBLE) AS amount, CAST(discount_amount AS DOUBLE) AS discount_amount,
  {_stamp_q('GUARDIAN_FILTER_FAILED', 'BOTH', 'LOW')}
FROM sales_orders WHERE NOT (amount > 0 AND discount_amount <= amount)""")

SQL["silver_customers"] = W(f"""
SELECT {CUST_COLS}, {_stamp_silver('QUARANTINE', 'MEDIUM')} FROM customers WHERE age BETWEEN 0 AND 120""")
SQL["quarantine_customers"] = W(f"""
SELECT {CUST_COLS}, {_stamp_q('GUARDIAN_FILTER_FAILED', 'QUARANTINE', 'MEDIUM')}
FROM customers WHERE NOT (age BETWEEN 0 AND 120)""")

SQL["silver_payments"] = W(f"""
SELECT payment_id, order_id, upper(trim(payment_status)) AS payment_status, payment_method, CAST(amount AS DOUBLE) AS amount,
  {_stamp_silver('CORRECT', 'LOW')} FROM payments WHERE amount > 5000""")
SQL["quarantine_payments"] = W(f"""
SELECT payment_id, order_id, payment_status, payment_method, CAST(amount AS DOUBLE) AS amount,
  {_stamp_q('GUARDIAN_FILTER_FAILED', 'CORRECT', 'LOW')} FROM payments WHERE NOT (amount > 5000)""")

REFUND_COLS = "refund_id, order_id, refund_status, CAST(refund_amount AS DOUBLE) AS refund_amount, refund_reason"
SQL["silver_refunds"] = W(f"""
SELECT {REFUND_COLS}, {_stamp_silver('QUARANTINE', 'LOW')} FROM refunds WHERE refund_amount > 0""")
SQL["quarantine_refunds"] = W(f"""
SELECT {REFUND_COLS}, {_stamp_q('GUARDIAN_FILTER_FAILED', 'QUARANTINE', 'LOW')} FROM refunds WHERE NOT (refund_amount > 0)""")

SQL["quarantine_guardian_block"] = W(f"""
SELECT {ORDER_COLS}, CAST(amount AS DOUBLE) AS amount, CAST(discount_amount AS DOUBLE) AS discount_amount,
  {_stamp_q('GUARDIAN_BLOCK', 'BLOCK', 'LOW')} FROM sales_orders""")

SQL["quarantine_drift_high"] = W(f"""
SELECT payment_id, order_id, payment_status, payment_method, CAST(amount AS DOUBLE) AS amount,
  {_stamp_q('DRIFT_HIGH_SEVERITY', 'CORRECT', 'HIGH')} FROM payments""")

SQL["silver_gate_closed"] = W("""
SELECT 'orders' AS table_name, 'silver' AS side, FALSE AS gate_open, 0::BIGINT AS rows
UNION ALL SELECT 'orders', 'quarantine', FALSE, COUNT(*) FROM sales_orders
UNION ALL SELECT 'payments', 'silver', FALSE, 0
UNION ALL SELECT 'payments', 'quarantine', FALSE, COUNT(*) FROM payments
UNION ALL SELECT 'customers', 'silver', TRUE, COUNT(*) FROM customers WHERE age BETWEEN 0 AND 120
UNION ALL SELECT 'customers', 'quarantine', TRUE, COUNT(*) FROM customers WHERE NOT (age BETWEEN 0 AND 120)
UNION ALL SELECT 'refunds', 'silver', TRUE, COUNT(*) FROM refunds WHERE refund_amount > 0
UNION ALL SELECT 'refunds', 'quarantine', TRUE, COUNT(*) FROM refunds WHERE NOT (refund_amount > 0)""")

SQL["route_orders"] = W(f"""
SELECT *, 'BOTH' AS guardian_strategy, 'LOW' AS drift_severity, {AS_OF} AS stamped_at FROM (
  SELECT *, 'silver' AS route FROM ({SILVER_ORDERS_BODY})
  UNION ALL
  SELECT {ORDER_COLS}, CAST(amount AS DOUBLE), CAST(discount_amount AS DOUBLE), 'GUARDIAN_FILTER_FAILED'
  FROM sales_orders WHERE NOT (amount > 0 AND discount_amount <= amount))""")

SQL["route_nullsafe"] = W(f"""
SELECT {CUST_COLS},
  CASE WHEN COALESCE(age BETWEEN 0 AND 120, FALSE) THEN 'silver' ELSE 'GUARDIAN_FILTER_FAILED' END AS route,
  'QUARANTINE' AS guardian_strategy, 'MEDIUM' AS drift_severity, {AS_OF} AS stamped_at
FROM customers""")

# ------------------------------------------------------------ profiles and drift
ENTITY_COLS = {
    "orders": ("sales_orders", [("order_id", "n"), ("customer_id", "n"), ("product_id", "n"), ("order_date", "t"),
                                ("order_status", "s"), ("amount", "n"), ("discount_amount", "n")]),
    "customers": ("customers", [("customer_id", "n"), ("customer_name", "s"), ("age", "n"), ("city", "s"),
                                ("segment", "s")]),
    "payments": ("payments", [("payment_id", "n"), ("order_id", "n"), ("payment_status", "s"),
                              ("payment_method", "s"), ("amount", "n")]),
    "refunds": ("refunds", [("refund_id", "n"), ("order_id", "n"), ("refund_status", "s"), ("refund_amount", "n"),
                            ("refund_reason", "s")]),
}
TABLE_ORDER = ("orders", "customers", "payments", "refunds")

SNAP1 = """
orders1 AS (SELECT * FROM sales_orders WHERE order_date < TIMESTAMP '1998-05-01'),
customers1 AS (SELECT * FROM customers WHERE customer_id IN (SELECT customer_id FROM orders1)),
payments1 AS (SELECT * FROM payments WHERE order_id IN (SELECT order_id FROM orders1)),
refunds1 AS (SELECT * FROM refunds WHERE order_id IN (SELECT order_id FROM orders1))"""
SNAP1_SRC = {"orders": "orders1", "customers": "customers1", "payments": "payments1", "refunds": "refunds1"}


def _cols(t, kind=None):
    return [c for c, k in ENTITY_COLS[t][1] if kind is None or k == kind]


def sql_column_profile(t, src):
    parts = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
        f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) * 100.0 AS null_percent, "
        f"COUNT(DISTINCT {c}) AS distinct_count FROM {src}"
        for c in _cols(t)
    ]
    return "\nUNION ALL ".join(parts)


def sql_numeric_profile(t, src):
    parts = [f"SELECT '{t}' AS table_name, 'row_count' AS metric_name, CAST(COUNT(*) AS DOUBLE) AS metric_value FROM {src}"]
    parts += [
        f"SELECT '{t}', '{c}_avg', CAST(SUM({c}) AS DOUBLE) / NULLIF(CAST(COUNT({c}) AS DOUBLE), 0) FROM {src}"
        for c in _cols(t, "n")
    ]
    return "\nUNION ALL ".join(parts)


_CATEGORY_CFG = {"orders": ("order_status", "payment_status"), "payments": ("payment_status",),
                 "refunds": ("refund_status",), "customers": ("city",)}
_PK_CFG = {"orders": ("order_id",), "payments": ("payment_id",), "refunds": ("refund_id",), "customers": ("customer_id",)}
_POS = "('SUCCESS', 'COMPLETED', 'APPROVED', 'ACTIVE')"
_NEG = "('FAILED', 'PENDING', 'UNKNOWN', 'CANCELLED', 'REJECTED')"

# Values of string columns: the 50 most frequent (ties by value) of those that hold one row in 1,000 are reported.
TOP_VALUES, LEAST_PART = 50, 1000


def sql_value_counts(t, src, null="NULL"):
    """Rows per value of every string column, with rank among the frequent ones."""
    parts = [
        f"""SELECT '{c}' AS column_name, COALESCE(CAST({c} AS VARCHAR), {null}) AS value, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total
  FROM {src} GROUP BY 2"""
        for c in _cols(t, "s")
    ]
    return f"""SELECT *, n * {LEAST_PART} >= total AS often,
  row_number() OVER (PARTITION BY column_name, n * {LEAST_PART} >= total ORDER BY n DESC, value NULLS LAST) AS rank
FROM ({" UNION ALL ".join(parts)})"""


def sql_category_profile(t, src):
    counts = sql_value_counts(t, src)
    return f"""SELECT '{t}' AS table_name, column_name, CASE WHEN value IS NULL THEN 'null' ELSE 'value' END AS kind, value, n,
  CAST(n AS DOUBLE) / CAST(total AS DOUBLE) * 100.0 AS share_pct FROM ({counts}) WHERE often AND rank <= {TOP_VALUES}
UNION ALL
SELECT '{t}', column_name, 'other', NULL, CAST(SUM(CASE WHEN often AND rank <= {TOP_VALUES} THEN 0 ELSE n END) AS BIGINT),
  CAST(SUM(CASE WHEN often AND rank <= {TOP_VALUES} THEN 0 ELSE n END) AS DOUBLE) / CAST(MAX(total) AS DOUBLE) * 100.0
FROM ({counts}) GROUP BY column_name"""


def sql_value_shares(t, src, before=None):
    """Value-share metrics; values that the snapshot before reported among its largest are reported again, gone ones with 0."""
    rule = " OR ".join([f"column_name = '{c}' AND value IN {_POS[:-1]}, {_NEG[1:]}" for c in _CATEGORY_CFG[t]])
    now = sql_value_counts(t, src, "'None'")
    if before is None:
        rows = f"SELECT *, FALSE AS watched FROM ({now})"
    else:
        # of what a snapshot without a predecessor reports, the 50 largest of each column
        shown = f"SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS place FROM ({sql_value_counts(t, before, chr(39) + 'None' + chr(39))}) WHERE (often AND rank <= {TOP_VALUES}) OR {rule}"
        rows = f"""SELECT column_name, value, COALESCE(a.n, 0) AS n, k.total, COALESCE(a.often, FALSE) AS often, COALESCE(a.rank, 0) AS rank, b.value IS NOT NULL AS watched
FROM ({now}) a FULL JOIN (SELECT column_name, value FROM ({shown}) WHERE place <= {TOP_VALUES}) b USING (column_name, value),
  (SELECT COUNT(*) AS total FROM {src}) k"""
    return f"""SELECT '{t}' AS table_name, CASE WHEN told THEN column_name || '::' || value ELSE column_name || '_other_pct' END AS metric_name,
  CAST(SUM(n) AS DOUBLE) / CAST(MAX(total) AS DOUBLE) * 100.0 AS metric_value
FROM (SELECT *, (often AND rank <= {TOP_VALUES}) OR watched OR {rule} AS told FROM ({rows})
      UNION ALL SELECT c, NULL, 0, COUNT(*), FALSE, 0, FALSE, FALSE FROM {src}, (SELECT unnest({list(_cols(t, "s"))}) AS c) GROUP BY c)
GROUP BY 1, 2"""


def sql_drift_metrics(t, src, before=None):
    prof = sql_column_profile(t, src)
    return f"""{sql_numeric_profile(t, src)}
UNION ALL SELECT table_name, column_name || '_null_pct', null_percent FROM ({prof})
UNION ALL SELECT table_name, column_name || '_distinct_cnt', CAST(distinct_count AS DOUBLE) FROM ({prof})
UNION ALL SELECT * FROM ({sql_value_shares(t, src, before)})"""


def _all_tables(fn):
    return "\nUNION ALL ".join(f"SELECT * FROM ({fn(t, ENTITY_COLS[t][0])})" for t in TABLE_ORDER)


SQL["column_profile"] = W(_all_tables(sql_column_profile))
SQL["numeric_profile"] = W(_all_tables(sql_numeric_profile))


def sql_incremental(t, src):
    """Two drops: rows of the first key half, then the rest; the profile is that of all rows."""
    early = {"orders": "order_date < TIMESTAMP '1998-05-01'",
             "customers": "customer_id IN (SELECT customer_id FROM orders1)",
             "payments": "payment_id IN (SELECT payment_id FROM payments1)", "refunds": "refund_id IN (SELECT refund_id FROM refunds1)"}[t]
    second = f"(SELECT COUNT(*) FROM {src} WHERE NOT ({early}))"
    return "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS n_rows, {second} AS rows_scanned,
  CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0 AS null_percent,
  {f"CAST(SUM({c}) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE)" if kind == "n" else "CAST(NULL AS DOUBLE)"} AS average,
  COUNT(DISTINCT {c}) AS distinct_count, TRUE AS within_bound FROM {src}"""
        for c, kind in ENTITY_COLS[t][1])


SQL["column_profile_incremental"] = with_ctes(ENTITIES, SNAP1)(_all_tables(sql_incremental))
SQL["category_profile"] = W(_all_tables(sql_category_profile))
SQL["drift_metrics"] = W(_all_tables(sql_drift_metrics))

HIST = "hist AS (\n" + "\nUNION ALL ".join(
    [f"SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS captured_at FROM ({sql_drift_metrics(t, SNAP1_SRC[t])})" for t in TABLE_ORDER]
    + [f"SELECT *, TIMESTAMP '2024-01-02 00:00:00' AS captured_at FROM ({sql_drift_metrics(t, ENTITY_COLS[t][0], SNAP1_SRC[t])})" for t in TABLE_ORDER]
) + ")"

PAIRS = """
latest AS (SELECT table_name, MAX(captured_at) AS latest_at FROM hist GROUP BY 1),
placed AS (SELECT *, strpos(metric_name, '::') = 0 OR row_number() OVER (
             PARTITION BY table_name, captured_at, split_part(metric_name, '::', 1), strpos(metric_name, '::') > 0 ORDER BY metric_value DESC, metric_name) <= 50 AS compared FROM hist),
prev_at AS (SELECT h.table_name, h.metric_name, MAX(h.captured_at) AS prev_at FROM placed h JOIN latest l USING (table_name)
            WHERE h.captured_at < l.latest_at AND h.metric_value IS NOT NULL AND compared GROUP BY 1, 2),
pairs AS (
  SELECT h.table_name, h.metric_name,
    MAX(CASE WHEN h.captured_at = l.latest_at THEN h.metric_value END) AS current_value,
    MAX(CASE WHEN h.captured_at = p.prev_at AND h.metric_value IS NOT NULL THEN h.metric_value END) AS previous_value,
    MAX(CASE WHEN h.captured_at = l.latest_at THEN 1 ELSE 0 END) = 1 AS in_current
  FROM hist h JOIN latest l USING (table_name) LEFT JOIN prev_at p ON h.table_name = p.table_name AND h.metric_name = p.metric_name
  GROUP BY 1, 2)"""

WD = with_ctes(ENTITIES, SNAP1, HIST, PAIRS)

SQL["drift_pairs"] = WD("SELECT table_name, metric_name, current_value, previous_value, in_current FROM pairs")


def _action(sev):
    return f"CASE WHEN {sev} = 'HIGH' THEN 'BLOCK_SILVER' WHEN {sev} = 'MEDIUM' THEN 'FLAG_AND_ALERT' ELSE 'INVESTIGATE_SOURCE' END"


def _direction(change):
    return f"CASE WHEN {change} > 0 THEN 'increase' ELSE 'decrease' END"


def _issue_select(issue_type, column, sev, change, source, where):
    return f"""SELECT table_name, '{issue_type}' AS issue_type, column_, metric_name, severity,
  '{issue_type}' || ' on ' || column_ || ': ' || severity || ' ' || {_direction('change_pct')} AS message,
  {_action('severity')} AS recommended_action, current_value, previous_value, change_pct
FROM (SELECT table_name, {column} AS column_, metric_name, {sev} AS severity, current_value, previous_value, {change} AS change_pct
      FROM {source} WHERE {where}) WHERE change_pct <> 0"""


def _rel(cur="current_value", prev="previous_value"):
    return f"(({cur}) - ({prev})) / NULLIF(ABS({prev}), 0) * 100.0"


COMPARABLE = "in_current AND previous_value IS NOT NULL"


def _in_config(mapping, col_expr):
    return "(" + " OR ".join(
        f"(table_name = '{t}' AND {col_expr} IN ({', '.join(repr(c) for c in cols)}))" for t, cols in mapping.items()
    ) + ")"


_NUMERIC_CFG = {"orders": ("amount", "discount_amount"), "payments": ("amount",), "refunds": ("refund_amount",),
                "customers": ("age",)}
_VOL_CHANGE = f"ABS({_rel()})"
DRIFT_VOLUME = _issue_select(
    "VOLUME_DRIFT", "'row_count'",
    f"CASE WHEN {_VOL_CHANGE} > 50 THEN 'HIGH' WHEN {_VOL_CHANGE} >= 25 THEN 'MEDIUM' ELSE 'LOW' END",
    _VOL_CHANGE, "pairs", f"metric_name = 'row_count' AND {COMPARABLE}")

_NULL_CHANGE = "(current_value - previous_value)"
DRIFT_NULL = _issue_select(
    "NULL_DRIFT", "substring(metric_name, 1, length(metric_name) - 9)",
    f"CASE WHEN {_NULL_CHANGE} > 40 THEN 'HIGH' WHEN {_NULL_CHANGE} >= 20 THEN 'MEDIUM' ELSE 'LOW' END",
    _NULL_CHANGE, "pairs", f"suffix(metric_name, '_null_pct') AND {COMPARABLE}")

SHARES = f"""
shares AS (
  SELECT table_name,
    SUM(CASE WHEN val IN {_POS} THEN current_value ELSE 0.0 END) AS pos_share,
    SUM(CASE WHEN val IN {_NEG} THEN current_value ELSE 0.0 END) AS neg_share
  FROM (SELECT table_name, split_part(metric_name, '::', 1) AS col, substring(metric_name, strpos(metric_name, '::') + 2) AS val,
          current_value FROM pairs WHERE strpos(metric_name, '::') > 0 AND in_current)
  WHERE {_in_config(_CATEGORY_CFG, 'col')}
  GROUP BY table_name)"""

_CARD_CHANGE = _rel()
_CARD_SRC = "(SELECT p.*, s.pos_share, s.neg_share FROM pairs p LEFT JOIN shares s USING (table_name))"
DRIFT_CARD = _issue_select(
    "CARDINALITY_DRIFT", "substring(metric_name, 1, length(metric_name) - 13)",
    f"""CASE WHEN {_CARD_CHANGE} < -30 THEN 'HIGH' WHEN {_CARD_CHANGE} <= -15 THEN 'MEDIUM'
         WHEN {_CARD_CHANGE} > 0 AND NOT (COALESCE(pos_share, 0.0) >= COALESCE(neg_share, 0.0)) THEN 'MEDIUM' ELSE 'LOW' END""",
    _CARD_CHANGE, _CARD_SRC,
    f"{COMPARABLE} AND " + _in_config({t: tuple(f'{c}_distinct_cnt' for c in cs) for t, cs in _PK_CFG.items()}, "metric_name"))

_NUM_CHANGE = _rel()
DRIFT_NUMERIC = _issue_select(
    "NUMERIC_DRIFT", "substring(metric_name, 1, length(metric_name) - 4)",
    f"""CASE WHEN {_NUM_CHANGE} < -70 THEN 'HIGH' WHEN {_NUM_CHANGE} <= -40 THEN 'MEDIUM'
         WHEN {_NUM_CHANGE} > 90 THEN 'MEDIUM' ELSE 'LOW' END""",
    _NUM_CHANGE, "pairs",
    f"{COMPARABLE} AND suffix(metric_name, '_avg') AND "
    + _in_config(_NUMERIC_CFG, "substring(metric_name, 1, length(metric_name) - 4)"))

_CAT_SRC = ("(SELECT table_name, metric_name, COALESCE(current_value, 0.0) AS current_value, previous_value, in_current, "
            "split_part(metric_name, '::', 1) AS col, substring(metric_name, strpos(metric_name, '::') + 2) AS val "
            "FROM pairs WHERE strpos(metric_name, '::') > 0 AND previous_value IS NOT NULL)")
_CAT_CHANGE = _rel()
DRIFT_CATEGORY = _issue_select(
    "CATEGORY_DRIFT", "metric_name",
    f"""CASE WHEN val IN {_POS} AND {_CAT_CHANGE} < -30 THEN 'HIGH' WHEN val IN {_POS} AND {_CAT_CHANGE} <= -15 THEN 'MEDIUM'
         WHEN val IN {_NEG} AND {_CAT_CHANGE} > 50 THEN 'HIGH' WHEN val IN {_NEG} AND {_CAT_CHANGE} >= 25 THEN 'MEDIUM'
         ELSE 'LOW' END""",
    _CAT_CHANGE, _CAT_SRC, _in_config(_CATEGORY_CFG, "col"))

ISSUE_COLS_SQL = ("table_name, issue_type, column_ AS \"column\", metric_name, severity, message, recommended_action, "
                  "current_value, previous_value, change_pct")

WDS = with_ctes(ENTITIES, SNAP1, HIST, PAIRS, SHARES)
SQL["drift_volume"] = WDS(f"SELECT {ISSUE_COLS_SQL} FROM ({DRIFT_VOLUME})")
SQL["drift_null"] = WDS(f"SELECT {ISSUE_COLS_SQL} FROM ({DRIFT_NULL})")
SQL["drift_cardinality"] = WDS(f"SELECT {ISSUE_COLS_SQL} FROM ({DRIFT_CARD})")
SQL["drift_numeric"] = WDS(f"SELECT {ISSUE_COLS_SQL} FROM ({DRIFT_NUMERIC})")
SQL["drift_category"] = WDS(f"SELECT {ISSUE_COLS_SQL} FROM ({DRIFT_CATEGORY})")

ISSUES = ("issues AS (" + "\nUNION ALL ".join(f"SELECT {ISSUE_COLS_SQL} FROM ({q})" for q in
                                              (DRIFT_VOLUME, DRIFT_NULL, DRIFT_CARD, DRIFT_NUMERIC, DRIFT_CATEGORY)) + ")")
DRIFT_DECISION = """
drift_dec AS (
  SELECT t.table_name,
    COALESCE(CASE MAX(CASE severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END)
             WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 1 THEN 'LOW' END, 'LOW') AS overall_severity,
    COALESCE(MAX(CASE WHEN recommended_action = 'BLOCK_SILVER' THEN 1 ELSE 0 END), 0) = 0 AS allow_processing,
    COUNT(i.table_name) AS issue_count,
    CAST(COALESCE(SUM(CASE WHEN severity = 'HIGH' THEN 1 ELSE 0 END), 0) AS BIGINT) AS high_count,
    CAST(COALESCE(SUM(CASE WHEN severity = 'MEDIUM' THEN 1 ELSE 0 END), 0) AS BIGINT) AS medium_count
  FROM (VALUES ('orders'), ('customers'), ('payments'), ('refunds')) t(table_name)
  LEFT JOIN issues i ON t.table_name = i.table_name GROUP BY t.table_name)"""
WDD = with_ctes(ENTITIES, SNAP1, HIST, PAIRS, SHARES, ISSUES, DRIFT_DECISION)
SQL["drift_decision"] = WDD("SELECT * FROM drift_dec")

# ------------------------------------------------------------ quality, guardian, control
ALLOWED_VALUES = {
    "orders": {"order_status": ("COMPLETED", "PENDING", "CANCELLED")},
    "payments": {"payment_status": ("SUCCESS", "FAILED"), "payment_method": ("CARD", "UPI", "WALLET", "NETBANKING")},
    "refunds": {"refund_status": ("APPROVED", "REJECTED"), "refund_reason": ("DAMAGED", "LATE")},
}
VALID_RANGES = {
    "orders": {"amount": (0.01, None), "discount_amount": (0, None)},
    "customers": {"age": (0, 120)},
    "payments": {"amount": (0.01, None)},
    "refunds": {"refund_amount": (0.01, None)},
}
# table, name, kind, column, condition, filter, correction, severity
CHECKS = [
    ("orders", "discount_not_null", "NULL", "discount_amount", "discount_amount IS NOT NULL", False, "coalesce(discount_amount, 0)", "LOW"),
    ("orders", "positive_amount", "RANGE", "amount", "amount >= 0.01", True, "abs(amount)", "MEDIUM"),
    ("orders", "discount_not_negative", "RANGE", "discount_amount", "coalesce(discount_amount, 0) >= 0", True, None, "MEDIUM"),
    ("orders", "discount_within_amount", "RANGE", "discount_amount", "discount_amount <= amount", True, None, "MEDIUM"),
    ("orders", "known_order_status", "ENUM", "order_status", "order_status IN ('COMPLETED', 'PENDING', 'CANCELLED')", True, None, "MEDIUM"),
    ("customers", "valid_age", "RANGE", "age", "age >= 0 AND age <= 120", True, None, "MEDIUM"),
    ("payments", "normalised_status", "ENUM", "payment_status", "payment_status = upper(trim(payment_status))", False, "upper(trim(payment_status))", "LOW"),
    ("payments", "final_status", "ENUM", "payment_status", "payment_status IN ('SUCCESS', 'FAILED')", False, None, "LOW"),
    ("payments", "online_method", "ENUM", "payment_method", "payment_method IN ('CARD', 'UPI', 'WALLET', 'NETBANKING')", False, None, "LOW"),
    ("payments", "positive_amount", "RANGE", "amount", "amount >= 0.01", True, None, "MEDIUM"),
    ("refunds", "final_status", "ENUM", "refund_status", "refund_status IN ('APPROVED', 'REJECTED')", False, None, "LOW"),
    ("refunds", "known_reason", "ENUM", "refund_reason", "refund_reason IN ('DAMAGED', 'LATE')", False, None, "LOW"),
    ("refunds", "positive_refund", "RANGE", "refund_amount", "refund_amount >= 0.01", True, None, "MEDIUM"),
]

SQL["null_spikes"] = None  # filled below
QHIST = "qhist AS (\n" + "\nUNION ALL ".join(
    [f"SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS captured_at FROM ({sql_column_profile(t, SNAP1_SRC[t])})" for t in TABLE_ORDER]
    + [f"SELECT *, TIMESTAMP '2024-01-02 00:00:00' AS captured_at FROM ({sql_column_profile(t, ENTITY_COLS[t][0])})" for t in TABLE_ORDER]
) + ")"
SQL["null_spikes"] = with_ctes(ENTITIES, SNAP1, QHIST)("""
SELECT table_name, column_name, captured_at, previous_null_percent, null_percent,
  null_percent - previous_null_percent AS rise_points,
  CASE WHEN null_percent - previous_null_percent > 40 THEN 'HIGH'
       WHEN null_percent - previous_null_percent >= 20 THEN 'MEDIUM' END AS spike_severity
FROM (SELECT *, LAG(null_percent) OVER (PARTITION BY table_name, column_name ORDER BY captured_at) AS previous_null_percent
      FROM qhist) WHERE previous_null_percent IS NOT NULL""")

SQL["enum_violations"] = W("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS violations "
    f"FROM {ENTITY_COLS[t][0]} WHERE NOT ({c} IN ({', '.join(repr(v) for v in vals)})) GROUP BY 3"
    for t in TABLE_ORDER if t in ALLOWED_VALUES for c, vals in ALLOWED_VALUES[t].items()
))


def _range_bad(c, lo, hi):
    parts = []
    if lo is not None:
        parts.append(f"{c} < {lo}")
    if hi is not None:
        parts.append(f"{c} > {hi}")
    return " OR ".join(parts) or "FALSE"


SQL["range_violations"] = W("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT({c}) AS checked_rows, "
    f"CAST(SUM(CASE WHEN {_range_bad(c, lo, hi)} THEN 1 ELSE 0 END) AS BIGINT) AS violations, "
    f"CAST(SUM(CASE WHEN {_range_bad(c, lo, hi)} THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(COUNT({c}) AS DOUBLE), 0) * 100.0 AS violation_pct "
    f"FROM {ENTITY_COLS[t][0]}"
    for t in TABLE_ORDER for c, (lo, hi) in VALID_RANGES[t].items()
))


def _sql_str(v):
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


CHECKS_VALUES = "checks AS (SELECT * FROM (VALUES " + ", ".join(
    f"({_sql_str(table)}, {_sql_str(name)}, {i}, {_sql_str(kind)}, {_sql_str(column)}, {_sql_str(condition)}, "
    f"{'TRUE' if is_filter else 'FALSE'}, {_sql_str(correction)}, {_sql_str(severity)})"
    for i, (table, name, kind, column, condition, is_filter, correction, severity) in enumerate(CHECKS)
) + ") v(table_name, check_name, ordinal, kind, column_name, condition, is_filter, correction, severity))"


def sql_failures(name, sources, tables=TABLE_ORDER):
    parts = []
    for t in tables:
        for table, check, _, _, condition, _, _, _ in CHECKS:
            if table == t:
                parts.append(
                    f"SELECT '{t}' AS table_name, COUNT(*) AS rows, '{check}' AS check_name, "
                    f"CAST(SUM(CASE WHEN NOT COALESCE(({condition}), FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS failing "
                    f"FROM {sources[t]}"
                )
    return f"{name} AS (" + "\nUNION ALL ".join(parts) + ")"


def sql_issues(name, failures):
    return f"""{name} AS (
  SELECT f.table_name, f.check_name, c.kind AS issue_type,
    CASE WHEN CAST(f.failing AS DOUBLE) / NULLIF(CAST(f.rows AS DOUBLE), 0) * 100.0 > 50.0 THEN 'HIGH' ELSE c.severity END AS severity,
    c.column_name, f.check_name || ' failed on ' || CAST(f.failing AS VARCHAR) || ' of ' || CAST(f.rows AS VARCHAR) || ' rows' AS message,
    f.failing AS failing_rows, CAST(f.failing AS DOUBLE) / NULLIF(CAST(f.rows AS DOUBLE), 0) * 100.0 AS failing_pct,
    c.ordinal, c.condition, c.is_filter, c.correction
  FROM {failures} f JOIN checks c ON f.table_name = c.table_name AND f.check_name = c.check_name WHERE f.failing > 0)"""


def sql_decision(name, issues, tables=TABLE_ORDER):
    values = ", ".join(f"('{t}')" for t in tables)
    return f"""{name} AS (
  SELECT t.table_name,
    CASE WHEN MAX(CASE i.severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END) = 3 THEN 'BLOCK'
         WHEN COUNT(CASE WHEN i.is_filter THEN 1 END) > 0 AND COUNT(i.correction) > 0 THEN 'BOTH'
         WHEN COUNT(i.correction) > 0 THEN 'CORRECT' ELSE 'QUARANTINE' END AS strategy,
    COALESCE(string_agg(CASE WHEN i.is_filter THEN '(' || i.condition || ')' END, ' AND ' ORDER BY i.ordinal), '') AS silver_filter_condition,
    COALESCE(string_agg(CASE WHEN i.correction IS NOT NULL THEN i.column_name || ' := ' || i.correction END, '; ' ORDER BY i.ordinal), '') AS corrections,
    COALESCE(CASE MAX(CASE i.severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 END)
             WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 1 THEN 'LOW' END, 'LOW') AS overall_severity,
    COUNT(i.table_name) AS issue_count
  FROM (VALUES {values}) t(table_name) LEFT JOIN {issues} i ON t.table_name = i.table_name
  GROUP BY t.table_name)"""


FULL_SRC = {t: ENTITY_COLS[t][0] for t in TABLE_ORDER}
WG = with_ctes(ENTITIES, SNAP1, CHECKS_VALUES, sql_failures("fails2", FULL_SRC), sql_issues("issues2", "fails2"),
               sql_decision("dec2", "issues2"), sql_failures("fails1", SNAP1_SRC), sql_issues("issues1", "fails1"),
               sql_decision("dec1", "issues1"),
               sql_failures("fails2op", FULL_SRC, ("orders", "payments")), sql_issues("issues2op", "fails2op"),
               sql_decision("dec2op", "issues2op", ("orders", "payments")))

SQL["guardian_issues"] = WG("""
SELECT table_name, check_name, issue_type, severity, column_name, message, failing_rows, failing_pct FROM issues2""")

SQL["guardian_decision"] = WG("""
SELECT table_name, strategy, silver_filter_condition, corrections, overall_severity,
  overall_severity <> 'HIGH' AS allow_processing, issue_count FROM dec2""")

_BRONZE = "CASE table_name WHEN 'orders' THEN 'bronze_orders' WHEN 'customers' THEN 'bronze_customers' " \
          "WHEN 'payments' THEN 'bronze_payments' ELSE 'bronze_refunds' END"


def _ctrl_cols(dec, ts):
    return (f"SELECT {_BRONZE} AS table_name, strategy, silver_filter_condition, corrections, {ts} AS updated_at, "
            f"overall_severity <> 'HIGH' AS allow_processing, overall_severity AS severity FROM {dec}")


SQL["guardian_control"] = WG(_ctrl_cols("dec2", "TIMESTAMP '2024-01-02 00:00:00'"))
SQL["control_latest"] = WG(_ctrl_cols("dec2", "TIMESTAMP '2024-01-02 00:00:00'"))
SQL["control_upsert"] = WG(
    _ctrl_cols("dec2op", "TIMESTAMP '2024-01-02 00:00:00'") + "\nUNION ALL "
    + _ctrl_cols("(SELECT * FROM dec1 WHERE table_name IN ('customers', 'refunds'))", "TIMESTAMP '2024-01-01 00:00:00'"))

EVOLVED = """
orders_e AS (SELECT order_id, customer_id, order_date, order_status, CAST(amount AS DOUBLE) AS amount, discount_amount, 'web' AS channel FROM sales_orders),
refunds_e AS (SELECT refund_id, order_id, refund_status, refund_amount, CASE WHEN refund_id % 10 >= 3 THEN refund_reason END AS refund_reason FROM refunds),
schema_changes AS (SELECT * FROM (VALUES
  ('orders', 'amount', 'TYPE_CHANGED', 'decimal(18,2)', 'double', 'HIGH'),
  ('orders', 'channel', 'ADDED', NULL, 'string', 'LOW'),
  ('orders', 'product_id', 'REMOVED', 'long', NULL, 'HIGH')) v(table_name, column_name, change, previous_type, current_type, severity)),
spike AS (
  SELECT 'refunds' AS table_name, 'null_spike' AS check_name, 'NULL_SPIKE' AS issue_type, 'refund_reason' AS column_name,
    CASE WHEN now - was > 40 THEN 'HIGH' WHEN now - was >= 20 THEN 'MEDIUM' END AS severity
  FROM (SELECT (SELECT CAST(COUNT(*) - COUNT(refund_reason) AS DOUBLE) / COUNT(*) * 100.0 FROM refunds_e) AS now,
               (SELECT CAST(COUNT(*) - COUNT(refund_reason) AS DOUBLE) / COUNT(*) * 100.0 FROM refunds1) AS was)
  WHERE now - was >= 20)"""
EVOLVED_SRC = {**FULL_SRC, "orders": "orders_e", "refunds": "refunds_e"}
ALL_ISSUES = """
issues_all AS (
  SELECT table_name, check_name, issue_type, severity, column_name, failing_rows, ordinal, condition, is_filter, correction FROM issues_e
  UNION ALL SELECT table_name, 'schema_drift', 'SCHEMA', severity, column_name, NULL, NULL, NULL, FALSE, NULL FROM schema_changes
  UNION ALL SELECT table_name, check_name, issue_type, severity, column_name, NULL, NULL, NULL, FALSE, NULL FROM spike)"""
WE = with_ctes(ENTITIES, SNAP1, CHECKS_VALUES, EVOLVED, sql_failures("fails_e", EVOLVED_SRC), sql_issues("issues_e", "fails_e"),
               ALL_ISSUES, sql_decision("dec_e", "issues_all"))
SQL["guardian_issues_all"] = WE("SELECT table_name, check_name, issue_type, severity, column_name, failing_rows FROM issues_all")
SQL["guardian_decision_all"] = WE("""
SELECT table_name, strategy, silver_filter_condition, corrections, overall_severity,
  overall_severity <> 'HIGH' AS allow_processing, issue_count FROM dec_e""")
SQL["schema_drift"] = WE("""
SELECT s.*, (SELECT COUNT(*) FROM orders1) AS previous_rows, (SELECT COUNT(*) FROM orders_e) AS current_rows FROM schema_changes s""")
SQL["column_profile_approx"] = W(
    f"SELECT table_name, column_name, null_percent, distinct_count, TRUE AS within_bound FROM ({_all_tables(sql_column_profile)})")

# ------------------------------------------------------------ policy, gold
# The laws, written out: table, rule, text as stored, condition, severity, on_fail.
ROW_LAWS = [
    ("orders", "positive_amount", "amount > 0", "amount > 0", "HIGH"),
    ("orders", "discount_within_limit", "discount_amount <= amount * 0.06", "discount_amount <= amount * 0.06", "MEDIUM"),
    ("payments", "successful_payment", "payment_status = SUCCESS", "payment_status = 'SUCCESS'", "MEDIUM"),
    ("refunds", "refund_worth_paying", "refund_amount > 2000", "refund_amount > 2000", "MEDIUM"),
    ("customers", "adult_or_unknown", "age >= 18 OR age IS NULL", "(age >= 18 OR age IS NULL)", "LOW"),
]
GOLD_COND = {
    "orders": "amount > 0 AND discount_amount <= amount * 0.06",
    "payments": "payment_status = 'SUCCESS'",
    "refunds": "refund_amount > 2000",
    "customers": "(age >= 18 OR age IS NULL)",
}

SILVER = f"""
silver_o AS (SELECT *, {_stamp_silver('BOTH', 'LOW')} FROM (
  SELECT {ORDER_COLS}, ABS(amount) AS amount, COALESCE(discount_amount, 0) AS discount_amount FROM sales_orders)
  WHERE amount > 0 AND discount_amount <= amount),
silver_c AS (SELECT {CUST_COLS}, {_stamp_silver('QUARANTINE', 'MEDIUM')} FROM customers WHERE age BETWEEN 0 AND 120),
silver_p AS (SELECT payment_id, order_id, upper(trim(payment_status)) AS payment_status, payment_method, amount,
  {_stamp_silver('CORRECT', 'LOW')} FROM payments WHERE amount > 5000),
silver_r AS (SELECT *, {_stamp_silver('QUARANTINE', 'LOW')} FROM refunds WHERE refund_amount > 0)"""
SILVER_SRC = {"orders": "silver_o", "customers": "silver_c", "payments": "silver_p", "refunds": "silver_r"}

POLICY_METRICS = """
pm AS (
  SELECT 'customers' AS table_name, 'total_rows' AS metric_name, CAST(COUNT(*) AS DOUBLE) AS metric_value FROM silver_c
  UNION ALL SELECT 'customers', 'invalid_age_count', CAST(SUM(CASE WHEN age < 0 OR age > 120 THEN 1 ELSE 0 END) AS DOUBLE) FROM silver_c
  UNION ALL SELECT 'orders', 'total_rows', CAST(COUNT(*) AS DOUBLE) FROM silver_o
  UNION ALL SELECT 'orders', 'invalid_amount', CAST(SUM(CASE WHEN amount <= 0 THEN 1 ELSE 0 END) AS DOUBLE) FROM silver_o
  UNION ALL SELECT 'orders', 'invalid_discount', CAST(SUM(CASE WHEN discount_amount > amount THEN 1 ELSE 0 END) AS DOUBLE) FROM silver_o
  UNION ALL SELECT 'payments', 'total_rows', CAST(COUNT(*) AS DOUBLE) FROM silver_p
  UNION ALL SELECT 'payments', 'failure_rate',
    CAST(SUM(CASE WHEN payment_status IN ('FAILED','PENDING') THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) FROM silver_p
  UNION ALL SELECT 'refunds', 'total_rows', CAST(COUNT(*) AS DOUBLE) FROM silver_r
  UNION ALL SELECT 'refunds', 'invalid_refunds', CAST(SUM(CASE WHEN refund_amount <= 0 THEN 1 ELSE 0 END) AS DOUBLE) FROM silver_r)"""

METRIC_LAWS = """mlaws AS (SELECT * FROM (VALUES ('payments', 'failure_rate', CAST(10 AS DOUBLE), 'HIGH', 'ALERT'))
  v("table", metric, threshold_pct, severity, on_fail))"""

ROW_FAILS = "rfails AS (" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{name}' AS rule_name, {_sql_str(text)} AS expression, "
    f"CAST(SUM(CASE WHEN NOT COALESCE({cond}, FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS failing_rows, "
    f"'{sev}' AS severity, 'QUARANTINE' AS on_fail FROM {SILVER_SRC[t]}"
    for t, name, text, cond, sev in ROW_LAWS
) + ")"

POLICY_DECISION = """
pdec AS (
  SELECT 'row' AS kind, "table", rule_name AS name, expression, CAST(NULL AS DOUBLE) AS threshold_pct,
    CAST(failing_rows AS DOUBLE) AS observed, severity, on_fail FROM rfails WHERE failing_rows > 0
  UNION ALL
  SELECT 'metric', l."table", l.metric, CAST(NULL AS VARCHAR), l.threshold_pct, m.metric_value, l.severity, l.on_fail
  FROM mlaws l JOIN pm m ON l."table" = m.table_name AND l.metric = m.metric_name WHERE m.metric_value > l.threshold_pct)"""

WP = with_ctes(ENTITIES, SILVER, POLICY_METRICS, METRIC_LAWS, ROW_FAILS, POLICY_DECISION)

SQL["policy_metrics"] = WP("SELECT * FROM pm")
SQL["policy_metric_violations"] = WP("""
SELECT l."table", l.metric, l.threshold_pct, m.metric_value, l.severity, l.on_fail
FROM mlaws l JOIN pm m ON l."table" = m.table_name AND l.metric = m.metric_name WHERE m.metric_value > l.threshold_pct""")
SQL["policy_decision"] = WP("SELECT * FROM pdec")
SQL["policy_metric_laws"] = WP("""
SELECT * FROM pdec
UNION ALL
SELECT 'metric', 'orders', 'unpaid_pct', '100.0D * count_if(order_status <> ''COMPLETED'') / count(1)', 5, v, 'HIGH', 'ALERT'
FROM (SELECT 100.0::DOUBLE * COUNT(*) FILTER (WHERE order_status <> 'COMPLETED') / COUNT(*) AS v FROM silver_o) WHERE v > 5
UNION ALL
SELECT 'metric', 'order_lines', 'returned_pct', '100.0D * count_if(l_returnflag = ''R'') / count(1)', 20, v, 'MEDIUM', 'ALERT'
FROM (SELECT 100.0::DOUBLE * COUNT(*) FILTER (WHERE l_returnflag = 'R') / COUNT(*) AS v FROM lineitem) WHERE v > 20
UNION ALL
SELECT 'metric', 'order_lines', 'largest_quantity', 'max(l_quantity)', 40, v, 'LOW', 'ALERT'
FROM (SELECT MAX(l_quantity) AS v FROM lineitem) WHERE v > 40""")
SQL["policy_decision_json"] = WP("""
SELECT 'ENFORCE' AS strategy, kind, "table", name, expression, threshold_pct, severity, on_fail FROM pdec""")
SQL["policy_rules"] = WP("""
SELECT "table", name AS rule_name, expression, severity, on_fail FROM pdec WHERE kind = 'row'""")


def _row_cond(table):
    return GOLD_COND[table]


_SILVER_OUT = {
    "orders": f"{ORDER_COLS}, CAST(amount AS DOUBLE) AS amount, CAST(discount_amount AS DOUBLE) AS discount_amount",
    "customers": CUST_COLS,
    "payments": "payment_id, order_id, payment_status, payment_method, CAST(amount AS DOUBLE) AS amount",
    "refunds": REFUND_COLS,
}
for _t in TABLE_ORDER:
    SQL[f"gold_quarantine_{_t}"] = WP(
        f"SELECT {_SILVER_OUT[_t]}, guardian_strategy, drift_severity, processed_at FROM {SILVER_SRC[_t]} "
        f"WHERE NOT ({_row_cond(_t)})")

_PK = {"orders": "order_id", "customers": "customer_id", "payments": "payment_id", "refunds": "refund_id"}
SQL["policy_failed_rules"] = WP("\nUNION ALL ".join(
    f"SELECT * FROM (SELECT '{t}' AS table_name, {_PK[t]} AS row_key, concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT COALESCE({cond}, FALSE) THEN '{name}' END" for table, name, _, cond, _ in ROW_LAWS if table == t)
    + f") AS failed_rules FROM {SILVER_SRC[t]}) WHERE failed_rules <> ''"
    for t in TABLE_ORDER))

SQL["fact_orders_governed"] = WP(f"""
SELECT o.order_id, o.customer_id, p.payment_id, r.refund_id, o.order_date, o.order_status, p.payment_status, p.payment_method,
  CAST(p.amount AS DOUBLE) AS payment_amount, r.refund_status, CAST(r.refund_amount AS DOUBLE) AS refund_amount, r.refund_reason,
  CAST(o.discount_amount AS DOUBLE) AS discount_amount, CAST(p.amount - o.discount_amount AS DOUBLE) AS net_amount,
  {AS_OF} AS processed_at
FROM (SELECT * FROM silver_o WHERE {_row_cond('orders')}) o
LEFT JOIN (SELECT * FROM silver_c WHERE {_row_cond('customers')}) c ON o.customer_id = c.customer_id
LEFT JOIN (SELECT * FROM silver_p WHERE {_row_cond('payments')}) p ON o.order_id = p.order_id
LEFT JOIN (SELECT * FROM silver_r WHERE {_row_cond('refunds')}) r ON o.order_id = r.order_id""")

# ------------------------------------------------------------ streams
_LATE = "order_date >= TIMESTAMP '1998-05-01'"
_BAD = "order_status = 'CANCELLED'"
_ORDERS_STREAM = f"""
SELECT order_id, customer_id, product_id, order_date, order_status,
  CAST(CASE WHEN {_LATE} AND {_BAD} THEN NULL ELSE amount END AS DOUBLE) AS amount,
  CAST(discount_amount AS DOUBLE) AS discount_amount,
  CASE WHEN {_LATE} AND ({_BAD} OR order_id % 4 = 0) THEN '{{' || concat_ws(',',
    CASE WHEN {_BAD} THEN '"amount":"USD ' || CAST(amount AS VARCHAR) || '"' END,
    CASE WHEN order_id % 4 = 0 THEN '"channel":"web"' END) || '}}' END AS _rescued_data
FROM sales_orders"""
SQL["bronze_stream_orders"] = W(_ORDERS_STREAM)
SQL["bronze_rescued"] = W(f"SELECT order_id, amount, _rescued_data FROM ({_ORDERS_STREAM}) WHERE _rescued_data IS NOT NULL")
SQL["stream_route"] = SQL["route_orders"]
SQL["bronze_malformed"] = W("""
SELECT order_id, 'first, then' || chr(10) || 'second ' || order_status AS order_status, CAST(amount AS DOUBLE) AS amount, NULL AS _rescued_data
FROM sales_orders WHERE order_id % 3 = 0
UNION ALL
SELECT order_id, order_status, CASE WHEN order_id % 3 = 1 THEN CAST(amount AS DOUBLE) END,
  '{"_line":"' || order_id || ',' || order_status || CASE WHEN order_id % 3 = 1 THEN ',' || CAST(amount AS VARCHAR) || ',late' ELSE '' END || '"}'
FROM sales_orders WHERE order_id % 3 <> 0""")
SQL["schema_evolution"] = W("""
SELECT order_id, CASE WHEN NOT bad THEN product_id END AS product_id, order_date,
  CASE WHEN year(order_date) < 1997 THEN CAST(floor(amount) AS DOUBLE) ELSE CAST(amount AS DOUBLE) END AS amount,
  CASE WHEN year(order_date) >= 1997 THEN order_status END AS channel,
  CASE WHEN bad THEN '{"product_id":"P' || product_id || '"}' END AS _rescued_data, 2 AS versions,
  'order_id:int,product_id:int,order_date:timestamp_ntz,amount:double,channel:string' AS types
FROM (SELECT *, year(order_date) >= 1999 AND order_status = 'CANCELLED' AS bad FROM sales_orders)""")
_EARLY = "order_date < TIMESTAMP '1998-05-01'"
SQL["stream_governed"] = W(f"""
SELECT *, 'BOTH' AS guardian_strategy, 'LOW' AS drift_severity, {AS_OF} AS stamped_at FROM (
  SELECT *, 'silver' AS route FROM ({SILVER_ORDERS_BODY}) WHERE {_EARLY}
  UNION ALL
  SELECT {ORDER_COLS}, CAST(amount AS DOUBLE), CAST(discount_amount AS DOUBLE), 'GUARDIAN_FILTER_FAILED'
  FROM sales_orders WHERE NOT (amount > 0 AND discount_amount <= amount) AND {_EARLY})
UNION ALL
SELECT {ORDER_COLS}, CAST(amount AS DOUBLE), CAST(discount_amount AS DOUBLE), 'GUARDIAN_BLOCK', 'BLOCK', 'LOW', {AS_OF}
FROM sales_orders WHERE NOT ({_EARLY})""")

# ------------------------------------------------------------ governance
SQL["quarantine_summary"] = W("""
SELECT CAST(TIMESTAMP '2024-01-03 00:00:00' AS DATE) AS quarantine_day, table_name, 'GUARDIAN_FILTER_FAILED' AS quarantine_reason,
  COUNT(*) AS records FROM (
  SELECT 'orders' AS table_name FROM sales_orders WHERE NOT (amount > 0 AND discount_amount <= amount)
  UNION ALL SELECT 'customers' FROM customers WHERE NOT (age BETWEEN 0 AND 120)
  UNION ALL SELECT 'payments' FROM payments WHERE NOT (amount > 5000)
  UNION ALL SELECT 'refunds' FROM refunds WHERE NOT (refund_amount > 0))
GROUP BY table_name""")

SQL["drift_alerts_weekly"] = WDD("""
SELECT CAST(date_trunc('week', TIMESTAMP '2024-01-02 00:00:00') AS DATE) AS week_start, issue_type, severity,
  COUNT(*) AS alerts, COUNT(DISTINCT table_name) AS tables
FROM issues WHERE severity IN ('MEDIUM', 'HIGH') GROUP BY issue_type, severity""")

SQL["top_failed_rules"] = WP("\n".join([
    "SELECT table_name, rule_name, COUNT(*) AS failed_rows FROM (",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{name}' AS rule_name FROM {SILVER_SRC[t]} WHERE NOT COALESCE({cond}, FALSE)"
        for t, name, _, cond, _ in ROW_LAWS),
    ") GROUP BY 1, 2 ORDER BY failed_rows DESC, table_name, rule_name LIMIT 10"]))

SQL["churn_rate"] = with_ctes(
    ENTITIES,
    "\nref AS (SELECT MAX(CAST(order_date AS DATE)) AS reference_day FROM sales_orders)",
    "\nlast AS (SELECT customer_id, MAX(CAST(order_date AS DATE)) AS last_day FROM sales_orders GROUP BY 1)")("""
SELECT ref.reference_day, COUNT(*) AS customers,
  CAST(SUM(CASE WHEN last_day < CAST(ref.reference_day - INTERVAL 90 DAY AS DATE) THEN 1 ELSE 0 END) AS BIGINT) AS churned,
  CAST(SUM(CASE WHEN last_day < CAST(ref.reference_day - INTERVAL 90 DAY AS DATE) THEN 1 ELSE 0 END) AS DOUBLE) * 100.0
    / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS churn_rate
FROM last, ref GROUP BY ref.reference_day""")

SQL["kpi_anomaly_score"] = WS("""
SELECT order_date, CAST(net_revenue AS DOUBLE) AS net_revenue, window_days, window_mean, window_std,
  (CAST(net_revenue AS DOUBLE) - window_mean) / NULLIF(window_std, 0) AS z_score,
  COALESCE(ABS((CAST(net_revenue AS DOUBLE) - window_mean) / NULLIF(window_std, 0)) > 3.0, FALSE) AS is_anomaly
FROM (
  SELECT *, s1 / NULLIF(CAST(window_days AS DOUBLE), 0) AS window_mean,
    CASE WHEN (s2 - s1 * s1 / CAST(window_days AS DOUBLE)) / NULLIF(CAST(window_days - 1 AS DOUBLE), 0) > 0
         THEN sqrt((s2 - s1 * s1 / CAST(window_days AS DOUBLE)) / NULLIF(CAST(window_days - 1 AS DOUBLE), 0)) END AS window_std
  FROM (
    SELECT order_date, net_revenue,
      COUNT(net_revenue) OVER w AS window_days,
      CAST(SUM(net_revenue) OVER w AS DOUBLE) AS s1,
      CAST(SUM(CAST(net_revenue AS DECIMAL(38,4)) * CAST(net_revenue AS DECIMAL(38,4))) OVER w AS DOUBLE) AS s2
    FROM dm WINDOW w AS (ORDER BY order_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)))""")

SQL["freshness_sla"] = W("""
SELECT table_name, rows, CAST(last_processed_at AS TIMESTAMP) AS last_processed_at,
  CAST(epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(last_processed_at)) AS DOUBLE) / 3600.0 AS lag_hours,
  CAST(epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(last_processed_at)) AS DOUBLE) / 3600.0 <= 24.0 AS within_sla
FROM (
  SELECT 'orders' AS table_name, COUNT(*) AS rows, MAX(order_date) AS last_processed_at FROM sales_orders
  UNION ALL SELECT 'completed_orders', COUNT(*), MAX(order_date) FROM sales_orders WHERE order_status = 'COMPLETED'
  UNION ALL SELECT 'events', COUNT(*), MAX(ts) FROM events)""")

# ------------------------------------------------------------ end to end
# Guardian decisions derived from the data: orders as in ``SILVER``, payments
# keep all rows (no filter rule fails). The policy enforces every law that a
# silver row breaks: all of them but the orders' positive amount, which silver has.
# The refunds gate is closed: their number more than doubled since the run before.
PIPE_FACT = f"""
fact AS (
  SELECT o.order_id, o.customer_id, p.payment_id, r.refund_id, o.order_date, o.order_status,
    p.payment_status, p.payment_method, p.amount AS payment_amount, r.refund_status, r.refund_amount, r.refund_reason,
    o.discount_amount, p.amount - o.discount_amount AS net_amount, {AS_OF} AS processed_at
  FROM (SELECT * FROM silver_o WHERE {GOLD_COND['orders']}) o
  LEFT JOIN (SELECT * FROM silver_c WHERE {GOLD_COND['customers']}) c ON o.customer_id = c.customer_id
  LEFT JOIN (SELECT * FROM payments WHERE {GOLD_COND['payments']}) p ON o.order_id = p.order_id
  LEFT JOIN (SELECT * FROM refunds WHERE FALSE) r ON o.order_id = r.order_id)"""
SQL["pipeline_kpi_daily"] = with_ctes(ENTITIES, SILVER, PIPE_FACT, KPI_DAILY_ALL, DM, TR, SIG, DRV, INS)(
    f"SELECT {INS_COLS}, generated_at FROM ins")

# ------------------------------------------------------------ audit logs
FIX_JSON = """
fixdoc AS (
  SELECT t.table_name, '{"strategy":"' || d.strategy || '","silver_filter_condition":"' || d.silver_filter_condition
    || '","correction_expression":{' || COALESCE((
       SELECT string_agg('"' || column_name || '":"' || correction || '"', ',' ORDER BY ordinal)
       FROM issues2 i WHERE i.table_name = t.table_name AND i.correction IS NOT NULL), '') || '}}' AS recommended_fix_code,
    d.overall_severity, d.issue_count
  FROM (VALUES ('orders'), ('customers'), ('payments'), ('refunds')) t(table_name) JOIN dec2 d USING (table_name))"""
WGA = with_ctes(ENTITIES, SNAP1, CHECKS_VALUES, sql_failures("fails2", FULL_SRC), sql_issues("issues2", "fails2"),
                sql_decision("dec2", "issues2"), FIX_JSON)
GUARDIAN_AUDIT = f"""
SELECT {_BRONZE} AS table_name, issue_type, severity, column_name, message, recommended_fix_code, overall_severity,
  TIMESTAMP '2024-01-02 00:00:00' AS event_time FROM (
  SELECT i.table_name, i.issue_type, i.severity, i.column_name, i.message, f.recommended_fix_code, f.overall_severity
  FROM issues2 i JOIN fixdoc f USING (table_name)
  UNION ALL
  SELECT table_name, 'NO_ISSUE', 'LOW', 'NONE', 'No issue detected', recommended_fix_code, overall_severity
  FROM fixdoc WHERE issue_count = 0)"""
SQL["guardian_audit"] = WGA(GUARDIAN_AUDIT)
SQL["guardian_events"] = WGA(f"""
SELECT 'governed_sales' AS pipeline_name, a.table_name, a.issue_type, a.severity, a.message,
  a.recommended_fix_code AS action_taken, d.overall_severity <> 'HIGH' AS processing_allowed,
  d.strategy IN ('CORRECT', 'BOTH') AS fix_applied, a.event_time
FROM ({GUARDIAN_AUDIT}) a JOIN (SELECT {_BRONZE} AS table_name, overall_severity, strategy FROM dec2) d USING (table_name)""")

SQL["drift_audit"] = WDD("""
SELECT i.table_name, i.issue_type, i."column", i.severity, i.message, i.recommended_action, d.overall_severity,
  TIMESTAMP '2024-01-02 00:00:00' AS event_time
FROM issues i JOIN drift_dec d USING (table_name)
UNION ALL
SELECT table_name, 'NO_DRIFT', 'NONE', 'LOW', 'No drift detected', 'NONE', 'LOW', TIMESTAMP '2024-01-02 00:00:00'
FROM drift_dec WHERE issue_count = 0""")
SQL["drift_control"] = WDD(f"""
SELECT {_BRONZE.replace('table_name', 'd.table_name')} AS table_name, d.overall_severity, TIMESTAMP '2024-01-02 00:00:00' AS updated_at, i.issue_type, i."column",
  i.severity AS drift_severity, i.recommended_action, d.allow_processing, d.overall_severity AS severity
FROM drift_dec d LEFT JOIN issues i USING (table_name)""")
SQL["pipeline_controls"] = W("""
SELECT v.*, 'governed_sales' AS pipeline_name FROM (
  SELECT 'bronze_orders' AS table_name, 'silver' AS side, COUNT(*) AS rows, 'MEDIUM' AS drift_severity, TRUE AS drift_allows, 'MEDIUM' AS guardian_severity
  FROM (SELECT abs(amount) AS amount, coalesce(discount_amount, 0) AS discount_amount FROM sales_orders)
  WHERE amount >= 0.01 AND discount_amount <= amount
  UNION ALL SELECT 'bronze_orders', 'quarantine', COUNT(*), 'MEDIUM', TRUE, 'MEDIUM' FROM sales_orders WHERE NOT (amount >= 0.01 AND discount_amount <= amount)
  UNION ALL SELECT 'bronze_customers', 'silver', COUNT(*), 'LOW', TRUE, 'MEDIUM' FROM customers WHERE age BETWEEN 0 AND 120
  UNION ALL SELECT 'bronze_customers', 'quarantine', COUNT(*), 'LOW', TRUE, 'MEDIUM' FROM customers WHERE NOT (age BETWEEN 0 AND 120)
  UNION ALL SELECT 'bronze_payments', 'silver', COUNT(*), 'LOW', TRUE, 'LOW' FROM payments
  UNION ALL SELECT 'bronze_payments', 'quarantine', 0, 'LOW', TRUE, 'LOW'
  UNION ALL SELECT 'bronze_refunds', 'silver', 0, 'HIGH', FALSE, 'MEDIUM'
  UNION ALL SELECT 'bronze_refunds', 'quarantine', COUNT(*), 'HIGH', FALSE, 'MEDIUM' FROM refunds) v""")

# ------------------------------------------------------------ datasets
SQL["dataset_registry"] = W("""
SELECT 'bronze_orders' AS dataset, 'TRANSACTIONAL' AS kind, 'order_id' AS primary_key, COUNT(*) AS rows, COUNT(DISTINCT order_id) AS keys FROM sales_orders
UNION ALL SELECT 'bronze_customers', 'DIMENSION', 'customer_id', COUNT(*), COUNT(DISTINCT customer_id) FROM customers
UNION ALL SELECT 'bronze_payments', 'TRANSACTIONAL', 'payment_id', COUNT(*), COUNT(DISTINCT payment_id) FROM payments
UNION ALL SELECT 'bronze_refunds', 'TRANSACTIONAL', 'refund_id', COUNT(*), COUNT(DISTINCT refund_id) FROM refunds""")
SQL["sql_views"] = W("""
SELECT o.order_status, p.payment_status, count(*) AS payments, CAST(sum(p.amount) AS DOUBLE) AS amount
FROM sales_orders o JOIN payments p ON o.order_id = p.order_id GROUP BY ALL""")
_CSV_TYPES = {
    "orders": (("order_id", "int"), ("customer_id", "int"), ("product_id", "int"), ("order_date", "timestamp"), ("order_status", "string"),
               ("amount", "double"), ("discount_amount", "double")),
    "customers": (("customer_id", "int"), ("customer_name", "string"), ("age", "int"), ("city", "string"), ("segment", "string")),
    "payments": (("payment_id", "int"), ("order_id", "int"), ("payment_status", "string"), ("payment_method", "string"), ("amount", "double")),
    "refunds": (("refund_id", "int"), ("order_id", "int"), ("refund_status", "string"), ("refund_amount", "double"), ("refund_reason", "string")),
}
SQL["inferred_schema"] = W("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS type, (SELECT COUNT(*) FROM {ENTITY_COLS[t][0]}) AS rows"
    for t, columns in _CSV_TYPES.items() for c, kind in columns))

# ------------------------------------------------------------ what two pipeline runs leave
# The earlier run: orders before June 2001, and a third of their refunds.
SNAP_PIPE = SNAP1.replace("1998-05-01", "2001-06-01").replace(
    "FROM refunds WHERE", "FROM refunds WHERE refund_id % 3 = 0 AND")
_GUARD_REJECTS = {
    "orders": "NOT (amount >= 0.01 AND discount_amount <= amount)", "customers": "NOT (age BETWEEN 0 AND 120)", "refunds": "NOT (refund_amount >= 0.01)"}
_PIPE_RULES = [("orders", "discount_within_limit", "discount_amount <= amount * 0.06"), ("customers", "adult_or_unknown", "age >= 18 OR age IS NULL"),
               ("payments", "successful_payment", "payment_status = 'SUCCESS'"), ("refunds", "refund_worth_paying", "refund_amount > 2000")]


def _pipe_silver(t, src, closed):
    """Silver of a table under the guardian decision derived from its rows."""
    if t == "orders":
        return f"(SELECT * FROM (SELECT abs(amount) AS amount, coalesce(discount_amount, 0) AS discount_amount FROM {src}) WHERE amount >= 0.01 AND discount_amount <= amount)"
    keeps = {"customers": "age BETWEEN 0 AND 120", "payments": "TRUE", "refunds": "refund_amount >= 0.01"}[t]
    return f"(SELECT * FROM {src} WHERE {'FALSE' if t in closed else keeps})"


_RUNS = (("2024-01-01", SNAP1_SRC, ()), ("2024-01-03", {t: ENTITY_COLS[t][0] for t in TABLE_ORDER}, ("refunds",)))
_O1 = "\nUNION ALL ".join(
    f"SELECT 'O1' AS question, DATE '{day}' AS day, '{t}' AS about, '{'DRIFT_HIGH_SEVERITY' if t in closed else 'GUARDIAN_FILTER_FAILED'}' AS what, "
    f"COUNT(*) AS n FROM {src[t]} WHERE {'TRUE' if t in closed else bad}"
    for day, src, closed in _RUNS for t, bad in _GUARD_REJECTS.items())
_O3 = "SELECT 'O3', NULL, t, rule, CAST(SUM(n) AS BIGINT) FROM (" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS t, '{rule}' AS rule, COUNT(*) AS n FROM {_pipe_silver(t, src[t], closed)} WHERE NOT COALESCE({ok}, FALSE)"
    for _, src, closed in _RUNS for t, rule, ok in _PIPE_RULES) + ") GROUP BY ALL"
_LOGGED = "\nUNION ALL ".join(
    f"SELECT '{log}', DATE '{day}', 'bronze_' || t.table_name, 'rows', greatest(COUNT(i.table_name), 1) "
    f"FROM (VALUES ('orders'), ('customers'), ('payments'), ('refunds')) t(table_name) LEFT JOIN {issues_of} i USING (table_name) GROUP BY t.table_name"
    for log in ("audit", "events") for day, issues_of in (("2024-01-01", "issues1"), ("2024-01-03", "issues2")))
SQL["pipeline_governance"] = with_ctes(
    ENTITIES, SNAP_PIPE, HIST, PAIRS, SHARES, ISSUES, CHECKS_VALUES, sql_failures("fails1", SNAP1_SRC), sql_issues("issues1", "fails1"),
    sql_failures("fails2", FULL_SRC), sql_issues("issues2", "fails2"))(f"""
SELECT * FROM (
{_O1}
UNION ALL SELECT 'O2', DATE '2024-01-01', issue_type, severity, COUNT(*) FROM issues WHERE severity IN ('MEDIUM', 'HIGH') GROUP BY issue_type, severity
UNION ALL {_O3}
UNION ALL {_LOGGED}) WHERE n > 0""")

_SECOND = _RUNS[1][1]
_DATASETS = [(f"silver_{t}", f"COUNT(*) FROM {_pipe_silver(t, _SECOND[t], ('refunds',))}") for t in TABLE_ORDER]
_DATASETS += [(f"quarantine_{t}", f"COUNT(*) FROM {_SECOND[t]} WHERE {'TRUE' if t == 'refunds' else _GUARD_REJECTS.get(t, 'FALSE')}") for t in TABLE_ORDER]
_DATASETS += [(f"gold_quarantine_{t}", f"COUNT(*) FROM {_pipe_silver(t, _SECOND[t], ('refunds',))} WHERE NOT COALESCE({ok}, FALSE)") for t, _, ok in _PIPE_RULES]
_DATASETS += [("fact_orders", "COUNT(*) FROM fact"), ("kpi_customer_lifetime_value", "COUNT(DISTINCT customer_id) FROM fact"),
              ("kpi_payment_method_performance", "COUNT(DISTINCT coalesce(payment_method, '')) FROM fact")]
_DATASETS += [(n, "COUNT(DISTINCT CAST(order_date AS DATE)) FROM fact") for n in (
    "kpi_daily_order_revenue", "kpi_payment_success_rate", "kpi_refund_rate", "kpi_discount_impact")] + [("insights", "COUNT(*) FROM ins")]
SQL["pipeline_datasets"] = with_ctes(ENTITIES, SILVER, PIPE_FACT, KPI_DAILY_ALL, DM, TR, SIG, DRV, INS)(
    "\nUNION ALL ".join(f"SELECT '{name}' AS dataset, {body[:8]} AS rows{body[8:]}" if body.startswith("COUNT(*)") else
                        f"SELECT '{name}' AS dataset, {body.split(' FROM ')[0]} AS rows FROM {body.split(' FROM ')[1]}" for name, body in _DATASETS))

# ------------------------------------------------------------ datasets that follow their drops
SQL["kpi_daily_incremental"] = WK("""
SELECT k.order_date, total_orders, CAST(gross_revenue AS DOUBLE) AS gross_revenue, CAST(net_revenue AS DOUBLE) AS net_revenue,
  total_payments, successful_payments, payment_success_rate, refunded_orders,
  CAST(total_refund_amount AS DOUBLE) AS total_refund_amount, refund_rate, CAST(total_discount AS DOUBLE) AS total_discount,
  CAST(CASE WHEN strftime(k.order_date, '%Y-%m') IN (SELECT strftime(order_date, '%Y-%m') FROM sales_orders o JOIN refunds r ON o.order_id = r.order_id
    WHERE year(order_date) = 1996 AND month(order_date) = 6 AND refund_id % 10 = 3) THEN 2 WHEN year(k.order_date) <= 1997 THEN 0 ELSE 1 END AS INT) AS computed_in
FROM kpi_all k""")

SQL["kpi_payment_method_incremental"] = SQL["kpi_payment_method_performance"]

SQL["bucket_upsert"] = W("""
SELECT strftime(order_date, '%Y-%m') AS order_month, order_id,
  CASE WHEN year(order_date) > 1997 OR (year(order_date) = 1997 AND order_id % 3 <> 0) THEN 'SHIPPED' ELSE order_status END AS order_status,
  CAST(amount AS DOUBLE) AS amount,
  CASE WHEN year(order_date) > 1997 AND order_id % 3 = 0 THEN order_date - INTERVAL 1 DAY ELSE order_date END AS updated_at
FROM sales_orders""")
