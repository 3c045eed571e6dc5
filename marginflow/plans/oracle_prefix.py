"""The commerce mapping written once more as SQL (DuckDB dialect) for the independent oracle.

Every oracle query is ``WITH <these CTEs> <query>``.  The CTEs are named ``c_*`` because the
driver already registers ``orders`` and ``customer`` as views.  The SQL is written from the
mapping definition, not generated from the Spark plan; it uses ``ROW_NUMBER`` where the
Spark side uses a grouped ``min`` and direct fan-out joins where the Spark side
pre-aggregates, so the two sides check each other.
"""

from __future__ import annotations


def r(expr: str, digits: int) -> str:
    """Deterministic half-away-from-zero rounding of a double, handed out as DOUBLE."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(30,12)), {digits}) AS DOUBLE)"


def rm(expr: str, digits: int = 2) -> str:
    """Round an exact decimal, handed out as DOUBLE."""
    return f"CAST(ROUND({expr}, {digits}) AS DOUBLE)"


def div(num: str, den: str) -> str:
    """Double division with NULL on a zero or NULL denominator."""
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


COMMERCE_CTES = r"""
c_customer_attrs AS (
    SELECT c.c_custkey,
        CASE WHEN n.n_regionkey IN (0, 1) THEN 'LV' WHEN n.n_regionkey IN (2, 3) THEN 'LT'
             WHEN n.n_regionkey = 4 THEN 'EE' END AS market,
        CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Paid Search' WHEN 'BUILDING' THEN 'Paid Social'
             WHEN 'FURNITURE' THEN 'Organic Search' WHEN 'HOUSEHOLD' THEN 'CRM'
             WHEN 'MACHINERY' THEN 'Affiliate' END AS acquisition_channel,
        CASE c.c_custkey % 5 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Home' WHEN 2 THEN 'Beauty'
             WHEN 3 THEN 'Sports' WHEN 4 THEN 'Pet Care' END AS category_interest,
        CASE WHEN c.c_custkey % 3 < 2 THEN 'mobile' ELSE 'desktop' END AS device_type,
        CASE WHEN c.c_acctbal < -1000 THEN 0.0 WHEN c.c_acctbal > 10000 THEN 1.0
             ELSE (c.c_acctbal + 1000.0) / 11000.0 END AS engagement_score
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
c_lines AS (
    SELECT l_orderkey,
        SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS price_sum,
        SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS discount_sum,
        BOOL_AND(l_returnflag = 'R') AS all_returned,
        SUM(CASE WHEN l_returnflag = 'R' AND l_linenumber >= 5
                 THEN CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
                 ELSE 0 END) AS refund_lines,
        MIN(l_suppkey) AS min_suppkey,
        CAST(MAX(l_shipdate) AS DATE) AS last_ship_date
    FROM lineitem GROUP BY l_orderkey
),
c_every AS (
    SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, 'O' || lpad(CAST(o.o_orderkey AS VARCHAR), 12, '0') AS order_id,
        CAST(o.o_orderdate AS DATE) AS order_date, l.l_orderkey IS NOT NULL AS has_lines, l.min_suppkey,
        l.last_ship_date, COALESCE(l.price_sum, 0) AS price_sum, COALESCE(l.discount_sum, 0) AS discount_sum,
        COALESCE(l.refund_lines, 0) AS refund_lines, COALESCE(l.all_returned, FALSE) AS all_returned,
        ROW_NUMBER() OVER (PARTITION BY o.o_custkey ORDER BY CAST(o.o_orderdate AS DATE),
                           'O' || lpad(CAST(o.o_orderkey AS VARCHAR), 12, '0')) AS nth_order
    FROM orders o LEFT JOIN c_lines l ON l.l_orderkey = o.o_orderkey
),
c_amounts AS (
    SELECT w.*, a.market, a.acquisition_channel,
        CAST(ROUND(CAST(w.price_sum AS DECIMAL(28,2)) * 0.001, 2) AS DECIMAL(18,2)) AS gross_revenue,
        CAST(ROUND(CAST(w.discount_sum AS DECIMAL(28,4)) * 0.001, 2) AS DECIMAL(18,2)) AS discount_amount,
        CASE w.min_suppkey % 3 WHEN 0 THEN 'BalticPost' WHEN 1 THEN 'FastShip' WHEN 2 THEN 'EconomyBox' END AS carrier,
        CAST(CASE a.acquisition_channel WHEN 'Paid Search' THEN 18 WHEN 'Paid Social' THEN 23
             WHEN 'Organic Search' THEN 5 WHEN 'CRM' THEN 4 WHEN 'Affiliate' THEN 15 END AS DECIMAL(18,2)) AS acq_cost
    FROM c_every w LEFT JOIN c_customer_attrs a ON a.c_custkey = w.o_custkey
),
c_amounts2 AS (
    SELECT x.*,
        CAST(CASE WHEN x.all_returned THEN x.gross_revenue
             ELSE ROUND(CAST(x.refund_lines AS DECIMAL(28,4)) * 0.001, 2) END AS DECIMAL(18,2)) AS refund_amount,
        CAST(ROUND(x.gross_revenue * 0.70, 2) AS DECIMAL(18,2)) AS product_cost,
        CAST(CASE WHEN NOT x.has_lines THEN 0 ELSE ROUND(CAST(CASE x.market WHEN 'LV' THEN 4.1 WHEN 'LT' THEN 4.8 WHEN 'EE' THEN 5.4 END AS DECIMAL(2,1))
             * CAST(CASE x.carrier WHEN 'BalticPost' THEN 0.95 WHEN 'FastShip' THEN 1.15
                    WHEN 'EconomyBox' THEN 0.82 END AS DECIMAL(3,2)), 2) END AS DECIMAL(18,2)) AS delivery_cost,
        CAST(CASE WHEN x.gross_revenue > 0 THEN ROUND(x.gross_revenue * 0.018 + 0.20, 2) ELSE 0 END
             AS DECIMAL(18,2)) AS payment_cost,
        CAST(CASE WHEN x.has_lines THEN 2.10 ELSE 0 END AS DECIMAL(18,2)) AS fulfillment_cost,
        CAST(CASE WHEN x.nth_order = 1 THEN x.acq_cost ELSE ROUND(x.acq_cost * 0.03, 2) END
             AS DECIMAL(18,2)) AS attributed_marketing_cost
    FROM c_amounts x
),
c_amounts3 AS (
    SELECT y.*, CAST(y.gross_revenue - y.discount_amount - y.refund_amount AS DECIMAL(18,2)) AS net_revenue,
        CASE WHEN y.refund_amount >= y.gross_revenue THEN 'refunded' ELSE 'completed' END AS order_status
    FROM c_amounts2 y
),
c_orders AS (
    SELECT z.order_id, 'C' || CAST(z.o_custkey AS VARCHAR) AS customer_id,
        'P' || CAST(z.o_custkey AS VARCHAR) AS prospect_id, z.order_date, z.market, z.acquisition_channel,
        CASE z.o_orderpriority WHEN '1-URGENT' THEN 'Electronics' WHEN '2-HIGH' THEN 'Home'
             WHEN '3-MEDIUM' THEN 'Beauty' WHEN '4-NOT SPECIFIED' THEN 'Sports' WHEN '5-LOW' THEN 'Pet Care' END
             AS category,
        z.order_status, z.gross_revenue, z.discount_amount, z.refund_amount, z.product_cost, z.delivery_cost,
        z.payment_cost, z.fulfillment_cost, z.attributed_marketing_cost, z.net_revenue,
        CAST(z.net_revenue - z.product_cost - z.delivery_cost - z.payment_cost - z.fulfillment_cost
             - z.attributed_marketing_cost AS DECIMAL(18,2)) AS contribution_margin
    FROM c_amounts3 z
),
c_deliveries AS (
    SELECT z.order_id, z.carrier, CAST(z.order_date + INTERVAL 3 DAY AS DATE) AS promised_date,
        z.last_ship_date AS delivered_date,
        CAST(CASE WHEN z.last_ship_date <= CAST(z.order_date + INTERVAL 3 DAY AS DATE) THEN 1 ELSE 0 END
             AS INTEGER) AS on_time,
        z.delivery_cost
    FROM c_amounts3 z WHERE z.has_lines
),
c_customers AS (
    SELECT 'C' || CAST(w.o_custkey AS VARCHAR) AS customer_id, 'P' || CAST(w.o_custkey AS VARCHAR) AS prospect_id,
        a.market, a.acquisition_channel, w.order_date AS acquisition_date
    FROM c_every w LEFT JOIN c_customer_attrs a ON a.c_custkey = w.o_custkey
    WHERE w.nth_order = 1 AND w.o_custkey IS NOT NULL
),
c_prospects AS (
    SELECT 'P' || CAST(a.c_custkey AS VARCHAR) AS prospect_id, a.market, a.acquisition_channel,
        a.category_interest, a.device_type, a.engagement_score, DATE '2001-01-01' AS assignment_date,
        CAST(CASE WHEN EXISTS (SELECT 1 FROM c_every w WHERE w.o_custkey = a.c_custkey
                                      AND w.order_date >= DATE '2001-01-01') THEN 1 ELSE 0 END
             AS INTEGER) AS converted
    FROM c_customer_attrs a
),
c_assignments AS (
    SELECT 'P' || CAST(c_custkey AS VARCHAR) AS prospect_id, 'free_shipping_threshold' AS experiment_id,
        CASE WHEN (c_custkey * 7919 + 17) % 1000 < 505 THEN 'control' ELSE 'treatment' END AS treatment,
        DATE '2001-01-01' AS assignment_date
    FROM customer
),
c_marketing AS (
    SELECT CAST(date_trunc('month', ts) AS DATE) AS month,
        CASE user_id % 3 WHEN 0 THEN 'LV' WHEN 1 THEN 'LT' WHEN 2 THEN 'EE' END AS market,
        CASE event_type WHEN 'click' THEN 'Paid Search' WHEN 'error' THEN 'Paid Social'
             WHEN 'purchase' THEN 'Organic Search' WHEN 'signup' THEN 'CRM' WHEN 'view' THEN 'Affiliate' END AS channel,
        CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS spend
    FROM events GROUP BY 1, 2, 3
)"""


def with_commerce(body: str, extra_ctes: str = "") -> str:
    """Full oracle query: the commerce CTEs, optional extra CTEs, then the body."""
    ctes = COMMERCE_CTES + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"
