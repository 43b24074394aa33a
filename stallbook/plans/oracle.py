"""The same results as ANSI-style SQL over the raw tables, for an independent engine.

Money is summed as decimal and shown as double; ratios divide doubles in the
same operand order as the operators; rounding goes through DECIMAL(38,12).
"""

from __future__ import annotations

from .registry import (
    CLV_TIERS,
    GOLD_TABLES,
    PASSIVE,
    PRICE,
    PROMOTER,
    REFRESHED,
    RULE_CONFIDENCE,
    RULE_SUPPORT,
    TARGET_RATE,
)


def rnd(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,12)), {places}) AS DOUBLE)"


def div(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0))"


def pct(part: str, whole: str, places: int) -> str:
    return rnd(f"{div(part, whole)} * 100.0", places)


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def day(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d')"


def stamp(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S.%f')"


# The part types that come second in a pair, which is all but the first in the alphabet.
SECOND_CATEGORIES = "'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'"

# --- shared relations ----------------------------------------------------------------

ORDERS = """
hdr AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date, o_orderstatus AS status,
         o_orderpriority AS payment_method,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 150 WHEN '2-HIGH' THEN 100 WHEN '3-MEDIUM' THEN 60 ELSE 0 END
              AS DECIMAL(8,2)) AS shipping_fee,
         CAST(CASE WHEN o_orderkey % 10 < 3 THEN o_orderkey % 201 ELSE 0 END AS DECIMAL(8,2)) AS discount_amount
  FROM orders)"""

PRODUCTS = """
prod AS (
  SELECT p_partkey AS product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_brand AS brand, p_name AS name,
         p_type AS category, CAST(p_retailprice AS DECIMAL(10,2)) AS cost_price,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 2 AS DECIMAL(10,2)) AS selling_price,
         p_size * 20 AS stock_quantity, 10 + p_partkey % 41 AS reorder_point, p_partkey % 10 AS supplier_id
  FROM part)"""

USERS = """
usr AS (
  SELECT c_custkey AS user_id, c_name AS name, lower(c_name) || '@example.com' AS email, n_name AS city,
         c_mktsegment AS member_level, DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS signup_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

SALES = f"""{ORDERS}, {PRODUCTS},
sales AS (
  SELECT h.order_id, h.user_id, h.order_date, h.payment_method, h.shipping_fee, h.discount_amount,
         p.product_id, p.brand, p.name, p.category, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS line_revenue,
         CAST(CAST(l_quantity AS BIGINT) * p.cost_price AS DECIMAL(18,2)) AS line_cost,
         strftime(h.order_date, '%Y-%m') AS order_month
  FROM lineitem JOIN hdr h ON l_orderkey = h.order_id JOIN prod p ON l_partkey = p.product_id
  WHERE h.status = 'F')"""

RETURNS = """
ret AS (
  SELECT l_partkey AS product_id, l_shipdate AS return_date, l_linestatus AS reason,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,2)) AS refund_amount,
         CASE WHEN l_linestatus = 'F' THEN 'Approved' ELSE 'Pending' END AS status
  FROM lineitem WHERE l_returnflag = 'R')"""

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, ts, value, CAST(value AS DECIMAL(18,2)) AS amount,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

BY_ORDER = """
ord AS (
  SELECT order_id, user_id, order_month, order_date, payment_method, discount_amount,
         max(shipping_fee) AS shipping_fee, sum(line_revenue) AS revenue, sum(line_cost) AS cost,
         sum(quantity) AS units, count(*) AS lines
  FROM sales GROUP BY ALL)"""

BY_USER = """
per_user AS (
  SELECT user_id, sum(revenue) AS revenue, sum(cost) AS cost, count(*) AS orders, sum(lines) AS lines,
         min(order_date) AS first_purchase, max(order_date) AS last_purchase
  FROM ord GROUP BY user_id)"""

PL = f"""
refunds AS (SELECT strftime(return_date, '%Y-%m') AS return_month, sum(refund_amount) AS total_refunds
            FROM ret GROUP BY 1),
months AS (SELECT order_month, sum(revenue) AS gross, sum(cost) AS cogs, sum(shipping_fee) AS shipping,
                  sum(discount_amount) AS discounts, count(*) AS total_orders
           FROM ord GROUP BY order_month),
pl AS (SELECT order_month, gross, cogs, shipping, discounts, coalesce(total_refunds, 0) AS refunds, total_orders,
              gross - discounts - coalesce(total_refunds, 0) AS net
       FROM months LEFT JOIN refunds ON order_month = return_month),
pl_out AS (
  SELECT order_month, {dbl('gross')} AS gross_revenue, {dbl('cogs')} AS total_cogs,
         {dbl('discounts')} AS total_discounts, {dbl('refunds')} AS total_refunds, {dbl('shipping')} AS total_shipping,
         {dbl('net')} AS net_revenue, {dbl('net - cogs')} AS gross_profit,
         {pct('net - cogs', 'net', 1)} AS gross_margin_pct, {big('total_orders')} AS total_orders
  FROM pl)"""

CHURN = f"""
last AS (SELECT user_id, max(order_date) AS last_order_date FROM sales GROUP BY user_id),
today AS (SELECT max(last_order_date) AS d FROM last),
churn0 AS (SELECT usr.*, last_order_date,
                  date_diff('day', CAST(last_order_date AS DATE), CAST((SELECT d FROM today) AS DATE)) AS days
           FROM usr LEFT JOIN last USING (user_id)),
churn AS (
  SELECT user_id, name, email, city, member_level, {stamp('last_order_date')} AS last_order_date,
         {big('coalesce(days, 180)')} AS days_since_last,
         CASE WHEN days IS NULL THEN 'New - No Purchase' WHEN days > 120 THEN 'Churned' WHEN days > 60 THEN 'At Risk'
              WHEN days > 30 THEN 'Dormant' ELSE 'Active' END AS churn_risk
  FROM churn0)"""

RFM = f"""
rfm AS (
  SELECT user_id,
         date_diff('day', CAST(last_purchase AS DATE), CAST((SELECT max(last_purchase) FROM per_user) AS DATE)) AS recency,
         {big('orders')} AS frequency, {big('lines')} AS line_frequency, {dbl('revenue')} AS monetary
  FROM per_user)"""

INVENTORY = f"""
sold AS (SELECT product_id, sum(quantity) AS total_sold FROM sales GROUP BY product_id),
inv0 AS (
  SELECT prod.*, coalesce(total_sold, 0) AS total_sold, s_name AS supplier_name,
         CASE WHEN coalesce(total_sold, 0) > 0
              THEN {rnd(div('stock_quantity', div('total_sold', '365')), 0)} ELSE 9999.0 END AS days_of_stock
  FROM prod LEFT JOIN sold USING (product_id) LEFT JOIN supplier ON supplier_id = s_suppkey),
inv AS (
  SELECT product_id, sku, brand, name, category, {dbl('cost_price')} AS cost_price,
         {dbl('selling_price')} AS selling_price, {big('stock_quantity')} AS stock_quantity,
         {big('reorder_point')} AS reorder_point, {big('total_sold')} AS total_sold, days_of_stock,
         CASE WHEN stock_quantity <= reorder_point THEN 'Critical - Reorder Now'
              WHEN stock_quantity <= reorder_point * 2 THEN 'Low Stock'
              WHEN days_of_stock > 365 THEN 'Overstock' ELSE 'Healthy' END AS inventory_status,
         {dbl('stock_quantity * cost_price')} AS inventory_value, supplier_name
  FROM inv0)"""

BRAND = f"""
sold_brand AS (
  SELECT brand, sum(line_revenue) AS revenue, sum(line_cost) AS cost, sum(quantity) AS units,
         count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS users
  FROM sales GROUP BY brand),
ret_brand AS (SELECT brand, count(*) AS returned, sum(refund_amount) AS refunded
              FROM ret JOIN prod USING (product_id) GROUP BY brand),
brand AS (
  SELECT brand, {dbl('revenue')} AS total_revenue, {dbl('revenue - cost')} AS total_profit,
         {big('units')} AS total_units, {big('orders')} AS total_orders, {big('users')} AS unique_customers,
         {big('coalesce(returned, 0)')} AS return_count, {dbl('coalesce(refunded, 0)')} AS refund_total,
         {big('orders')} AS sold_orders, {pct('revenue - cost', 'revenue', 1)} AS profit_margin_pct,
         {pct('coalesce(returned, 0)', 'orders', 1)} AS return_rate_pct,
         {rnd(div('revenue', 'users'), 2)} AS avg_revenue_per_customer
  FROM sold_brand LEFT JOIN ret_brand USING (brand))"""

AFFINITY = f"""
oc AS (SELECT DISTINCT order_id, category FROM sales),
multi AS (SELECT count(*) AS n FROM (SELECT order_id FROM oc GROUP BY order_id HAVING count(*) > 1)),
pairs AS (SELECT a.category AS cat1, b.category AS cat2, count(*) AS n
          FROM oc a JOIN oc b ON a.order_id = b.order_id AND a.category < b.category GROUP BY 1, 2),
affinity AS (SELECT cat1, cat2, {big('n')} AS co_occurrence_count,
                    {pct('n', '(SELECT n FROM multi)', 2)} AS affinity_score FROM pairs)"""

ABC = f"""
prev AS (SELECT product_id, sum(line_revenue) AS revenue, sum(quantity) AS units FROM sales GROUP BY product_id),
ranked AS (
  SELECT product_id, revenue, units, row_number() OVER w AS rnk,
         sum(revenue) OVER (ORDER BY revenue DESC, product_id ROWS UNBOUNDED PRECEDING) AS cum,
         (SELECT sum(revenue) FROM prev) AS total
  FROM prev WINDOW w AS (ORDER BY revenue DESC, product_id)),
abc AS (
  SELECT product_id, brand, name, category, {dbl('revenue')} AS total_revenue, {big('units')} AS total_units,
         {big('rnk')} AS revenue_rank, {dbl('cum')} AS cumulative_revenue, {pct('cum', 'total', 2)} AS cumulative_pct,
         CASE WHEN {pct('cum', 'total', 2)} <= 80 THEN 'A' WHEN {pct('cum', 'total', 2)} <= 95 THEN 'B' ELSE 'C' END
           AS abc_class,
         {pct('revenue', 'total', 2)} AS revenue_pct, revenue AS exact_revenue
  FROM ranked JOIN prod USING (product_id))"""

SENSITIVITY = f"""
sens0 AS (SELECT user_id, {div('sum(line_revenue)', 'count(*)')} AS avg_order_value, count(*) AS total_orders,
                 sum(quantity) AS total_items FROM sales GROUP BY user_id),
sens AS (
  SELECT user_id, avg_order_value, {big('total_orders')} AS total_orders, {big('total_items')} AS total_items,
         CASE WHEN avg_order_value < {PRICE['low']} AND total_orders > {PRICE['many']} THEN 'Price Sensitive - Frequent'
              WHEN avg_order_value > {PRICE['mid']} AND total_orders <= {PRICE['few']} THEN 'Quality Focused - Occasional'
              WHEN avg_order_value > {PRICE['high']} AND total_orders > {PRICE['many']} THEN 'Premium Loyal'
              ELSE 'Average Shopper' END AS sensitivity_segment
  FROM sens0)"""

NPS = f"""
nps_user AS (SELECT user_id, count(*) AS n, sum(line_revenue) AS spent FROM sales GROUP BY user_id),
nps_class AS (
  SELECT CASE WHEN n >= {PROMOTER[0]} AND spent > {PROMOTER[1]} THEN 'Promoter (9-10)'
              WHEN n >= {PASSIVE[0]} AND spent > {PASSIVE[1]} THEN 'Passive (7-8)' ELSE 'Detractor (0-6)' END AS nps_segment,
         count(*) AS user_count, sum(spent) AS revenue
  FROM nps_user GROUP BY 1)"""

FUNNEL = f"""
stages(stage_no, stage) AS (VALUES (1, 'view'), (2, 'click'), (3, 'signup'), (4, 'purchase')),
stage_counts AS (SELECT stage_no, stage, (SELECT count(*) FROM events WHERE event_type = stage) AS n FROM stages),
steps AS (SELECT stage_no, stage, n, lead(n) OVER (ORDER BY stage_no) AS following FROM stage_counts),
rates AS (SELECT stage_no, stage, n, {rnd(div('following', 'n') + ' * 100.0', 1)} AS conversion_rate FROM steps),
funnel AS (SELECT {big('stage_no')} AS stage_no, stage, {big('n')} AS count, conversion_rate,
                  {rnd('100.0 - conversion_rate', 1)} AS dropoff_rate FROM rates)"""


def window_counts(seconds: int, slide: int) -> str:
    """Sliding windows: each row repeated once per window that holds it."""
    copies = seconds // slide
    return f"""
win AS (
  SELECT to_timestamp(CAST(floor(epoch(ts) / {slide}) AS BIGINT) * {slide} - i * {slide}) AT TIME ZONE 'UTC' AS w0,
         event_type, user_id, value
  FROM events, range({copies}) AS r(i))"""


def bounds(seconds: int) -> str:
    return f"{stamp('w0')} AS window_start, {stamp(f'w0 + INTERVAL {seconds} SECOND')} AS window_end"


def heading(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def statements() -> dict[str, str]:
    sales = heading(SALES)
    events = heading(EVENTS)
    sql: dict[str, str] = {}

    # sales fact
    sql["sales_fact"] = f"""{sales}
SELECT order_id, product_id, user_id, category, quantity, {dbl('line_revenue')} AS line_revenue,
       {dbl('line_cost')} AS line_cost, {dbl('line_revenue - line_cost')} AS line_profit, order_month,
       strftime(order_date, '%G-W%V') AS order_week FROM sales"""
    sql["orders_rolled_up"] = f"""{heading(SALES, BY_ORDER)}
SELECT order_id, order_month, {stamp('order_date')} AS order_date, {dbl('revenue')} AS order_revenue,
       {dbl('cost')} AS order_cost, {dbl('shipping_fee')} AS shipping_fee, {dbl('discount_amount')} AS discount_amount
FROM ord"""
    sql["flat_clicks"] = f"""{events}
SELECT event_id, user_id, event_type, '/page/' || CAST(k AS VARCHAR) AS url, k AS duration_sec FROM ev"""
    sql["enriched_clicks"] = f"""{heading(EVENTS, USERS)}
SELECT event_id, ev.user_id, k AS duration_sec, name, city, member_level FROM ev LEFT JOIN usr USING (user_id)"""
    sql["dwell_by_city"] = f"""{heading(EVENTS, USERS)}
SELECT city, {big('count(event_id)')} AS events, {div('sum(k)', 'count(k)')} AS avg_dwell_sec
FROM ev LEFT JOIN usr USING (user_id) GROUP BY city"""

    # finance
    sql["sales_by_category"] = f"""{sales}
SELECT category, {dbl('sum(line_revenue)')} AS total_revenue, {big('count(*)')} AS total_orders
FROM sales GROUP BY category"""
    sql["daily_finance"] = f"""{sales}
SELECT {day('order_date')} AS order_date_only, {dbl('sum(line_revenue)')} AS daily_revenue,
       {dbl('sum(line_cost)')} AS daily_cost, {dbl('sum(line_revenue) - sum(line_cost)')} AS daily_gross_profit,
       {big('count(*)')} AS daily_orders
FROM sales GROUP BY 1"""
    sql["monthly_refunds"] = f"""{heading(RETURNS)}
SELECT strftime(return_date, '%Y-%m') AS return_month, {dbl('sum(refund_amount)')} AS total_refunds FROM ret GROUP BY 1"""
    sql["monthly_refunds_approved"] = f"""{heading(RETURNS)}
SELECT strftime(return_date, '%Y-%m') AS return_month, {dbl('sum(refund_amount)')} AS total_refunds
FROM ret WHERE status = 'Approved' GROUP BY 1"""
    pl_head = heading(SALES, RETURNS, BY_ORDER, PL)
    sql["monthly_pl"] = f"{pl_head} SELECT * FROM pl_out"
    sql["category_performance"] = f"""{sales}
SELECT category, {dbl('sum(line_revenue)')} AS total_revenue, {dbl('sum(line_cost)')} AS total_cost,
       {dbl('sum(line_revenue) - sum(line_cost)')} AS total_profit, {big('sum(quantity)')} AS total_units_sold,
       {big('count(DISTINCT order_id)')} AS total_orders, {big('count(DISTINCT product_id)')} AS product_count,
       {pct('sum(line_revenue) - sum(line_cost)', 'sum(line_revenue)', 1)} AS profit_margin_pct,
       {rnd(div('sum(line_revenue)', 'count(DISTINCT order_id)'), 2)} AS avg_order_value
FROM sales GROUP BY category"""
    sql["weekly_trend"] = f"""{sales}
SELECT strftime(date_trunc('week', order_date), '%Y-%m-%d') AS week_start, {dbl('sum(line_revenue)')} AS weekly_revenue,
       {dbl('sum(line_revenue) - sum(line_cost)')} AS weekly_profit, {big('sum(quantity)')} AS weekly_units,
       {big('count(DISTINCT order_id)')} AS weekly_orders, {big('count(DISTINCT user_id)')} AS weekly_active_users
FROM sales GROUP BY 1"""
    sql["discount_roi"] = f"""{heading(SALES, BY_ORDER)}
SELECT CASE WHEN discount_amount = 0 THEN 'No Discount' WHEN discount_amount <= 50 THEN '$1-50'
            WHEN discount_amount <= 100 THEN '$51-100' WHEN discount_amount <= 150 THEN '$101-150' ELSE '$150+' END
         AS discount_band,
       {big('count(*)')} AS order_count, {rnd(div('sum(revenue)', 'count(*)'), 2)} AS avg_order_value,
       {rnd(div('sum(units)', 'count(*)'), 1)} AS avg_items_per_order, {dbl('sum(revenue)')} AS total_revenue,
       {dbl('sum(revenue) - sum(cost)')} AS total_profit, {dbl('sum(discount_amount)')} AS total_discount_given,
       {rnd(div('sum(revenue)', 'greatest(sum(discount_amount), 1)'), 2)} AS discount_roi
FROM ord GROUP BY 1"""
    sql["payment_mix"] = f"""{sales}
SELECT payment_method, {big('count(DISTINCT order_id)')} AS total_orders, {dbl('sum(line_revenue)')} AS total_revenue,
       {rnd(div('sum(line_revenue)', 'count(*)'), 2)} AS avg_line_value,
       {big('count(DISTINCT user_id)')} AS unique_users,
       {rnd(div('sum(line_revenue)', '(SELECT sum(line_revenue) FROM sales)'), 2)} * 100.0 AS revenue_share_pct
FROM sales GROUP BY payment_method"""

    # products
    sql["product_performance"] = f"""{sales}
SELECT s.product_id, p.name, p.category, {big('p.stock_quantity')} AS stock_quantity,
       {big('sum(quantity)')} AS total_sold_quantity, {dbl('sum(line_revenue)')} AS total_revenue,
       CASE WHEN p.stock_quantity < 50 THEN 'Low Stock' WHEN p.stock_quantity < 150 THEN 'Medium' ELSE 'Healthy' END
         AS inventory_status
FROM sales s JOIN prod p ON s.product_id = p.product_id GROUP BY s.product_id, p.name, p.category, p.stock_quantity"""
    sql["inventory_health"] = f"{heading(SALES, INVENTORY)} SELECT * FROM inv"
    sql["returns_breakdown"] = f"""{heading(RETURNS, PRODUCTS)}
SELECT category, brand, reason, {big('count(*)')} AS return_count, {dbl('sum(refund_amount)')} AS total_refund
FROM ret JOIN prod USING (product_id) GROUP BY category, brand, reason"""
    sql["return_rate"] = f"""{heading(SALES, RETURNS)},
a AS (SELECT category, count(DISTINCT order_id) AS sold FROM sales GROUP BY category),
b AS (SELECT category, count(*) AS returned FROM ret JOIN prod USING (product_id) GROUP BY category)
SELECT category, {big('sold')} AS sold_orders, {big('coalesce(returned, 0)')} AS return_orders,
       {pct('coalesce(returned, 0)', 'sold', 2)} AS return_rate_pct
FROM a LEFT JOIN b USING (category)"""
    sql["supplier_scorecard"] = f"""{heading(PRODUCTS)},
po AS (SELECT l_suppkey AS supplier_id,
              date_diff('day', CAST(o_orderdate AS DATE) + 30, CAST(l_shipdate AS DATE)) AS late,
              CAST(l_quantity AS BIGINT) * cost_price AS value
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN prod ON l_partkey = product_id
       WHERE l_linestatus = 'F')
SELECT supplier_id, s_name AS supplier_name, n_name AS city,
       CASE WHEN s_acctbal >= 6000 THEN 'A' WHEN s_acctbal >= 2000 THEN 'B' ELSE 'C' END AS rating,
       {big('count(*)')} AS total_pos, {big('count(*) FILTER (WHERE late <= 0)')} AS on_time_count,
       {rnd(div('sum(late)', 'count(*)'), 1)} AS avg_days_late, {dbl('sum(value)')} AS total_procurement_value,
       {pct('count(*) FILTER (WHERE late <= 0)', 'count(*)', 1)} AS on_time_pct
FROM po JOIN supplier ON supplier_id = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
GROUP BY supplier_id, s_name, n_name, s_acctbal"""
    abc_head = heading(SALES, ABC)
    sql["abc_pareto"] = f"{abc_head} SELECT * EXCLUDE (exact_revenue) FROM abc"
    sql["abc_distribution"] = f"""{abc_head}
SELECT abc_class, {big('count(*)')} AS products, {dbl('sum(exact_revenue)')} AS revenue FROM abc GROUP BY abc_class"""
    brand_head = heading(SALES, RETURNS, BRAND)
    sql["brand_performance"] = f"{brand_head} SELECT * FROM brand"
    affinity_head = heading(SALES, AFFINITY)
    sql["category_affinity"] = f"{affinity_head} SELECT * FROM affinity"
    sql["top_pairs"] = f"{affinity_head} SELECT * FROM affinity ORDER BY affinity_score DESC, cat1, cat2 LIMIT 10"
    sql["affinity_matrix"] = f"""{affinity_head}
SELECT cat1, coalesce(COLUMNS(* EXCLUDE (cat1)), 0.0)
FROM (PIVOT (SELECT cat1, cat2, affinity_score FROM affinity) ON cat2 IN ({SECOND_CATEGORIES})
      USING max(affinity_score) GROUP BY cat1)"""

    # customers
    sql["member_summary"] = f"""{heading(SALES, USERS)}
SELECT member_level, {big('count(DISTINCT user_id)')} AS total_customers, {dbl('sum(line_revenue)')} AS total_spent,
       {big('count(*)')} AS total_orders, {div('sum(line_revenue)', 'count(DISTINCT user_id)')} AS avg_spent_per_user
FROM sales JOIN usr USING (user_id) GROUP BY member_level"""
    rfm_head = heading(SALES, BY_ORDER, BY_USER, RFM)
    sql["rfm_features"] = f"{rfm_head} SELECT user_id, recency, frequency, monetary FROM rfm"
    sql["rfm_features_by_line"] = (
        f"{rfm_head} SELECT user_id, recency, line_frequency AS frequency, monetary FROM rfm"
    )
    sql["cohort_retention"] = f"""{sales},
f AS (SELECT user_id, min(order_month) AS cohort_month FROM sales GROUP BY user_id)
SELECT cohort_month,
       date_diff('month', CAST(cohort_month || '-01' AS DATE), CAST(order_month || '-01' AS DATE)) AS months_since_first,
       {big('count(DISTINCT user_id)')} AS active_users
FROM sales JOIN f USING (user_id) GROUP BY 1, 2"""
    sql["city_sales"] = f"""{heading(SALES, USERS)}
SELECT city, {big('count(DISTINCT user_id)')} AS total_customers, {big('count(DISTINCT order_id)')} AS total_orders,
       {dbl('sum(line_revenue)')} AS total_revenue, {dbl('sum(line_revenue) - sum(line_cost)')} AS total_profit,
       {rnd(div('sum(line_revenue)', 'count(*)'), 2)} AS avg_item_value,
       {rnd(div('sum(line_revenue)', 'count(DISTINCT user_id)'), 2)} AS revenue_per_customer
FROM sales JOIN usr USING (user_id) GROUP BY city"""
    sql["clv"] = f"""{heading(SALES, USERS, BY_ORDER, BY_USER)},
c0 AS (SELECT u.user_id, u.name, u.city, u.member_level, u.signup_date, orders, revenue, cost, lines, first_purchase,
              last_purchase,
              date_diff('day', u.signup_date, CAST((SELECT max(last_purchase) FROM per_user) AS DATE)) AS age,
              date_diff('day', CAST(first_purchase AS DATE), CAST(last_purchase AS DATE)) AS active
       FROM per_user JOIN usr u USING (user_id)),
c1 AS (SELECT *, {rnd(div('orders', 'greatest(CAST(age AS DOUBLE) / 30.0, 1.0)'), 2)} AS freq FROM c0),
c2 AS (SELECT *, {rnd('freq * 12.0 * ' + div('revenue', 'greatest(orders, 1)'), 2)} AS annual FROM c1),
c3 AS (SELECT *, {rnd('annual * least(CAST(active AS DOUBLE) / 365.0 + 1.0, 3.0)', 2)} AS score FROM c2)
SELECT user_id, name AS user_name, city, member_level, {day('signup_date')} AS signup_date,
       {big('orders')} AS total_orders, {dbl('revenue')} AS total_revenue, {dbl('revenue - cost')} AS total_profit,
       {stamp('first_purchase')} AS first_purchase, {stamp('last_purchase')} AS last_purchase,
       {div('revenue', 'lines')} AS avg_item_value, {big('age')} AS customer_age_days, {big('active')} AS active_days,
       freq AS purchase_frequency, annual AS projected_annual_value, score AS clv_score,
       CASE WHEN score >= {CLV_TIERS[0]} THEN 'Platinum' WHEN score >= {CLV_TIERS[1]} THEN 'Gold'
            WHEN score >= {CLV_TIERS[2]} THEN 'Silver' ELSE 'Bronze' END AS clv_tier
FROM c3"""
    churn_head = heading(SALES, USERS, CHURN)
    sql["churn_risk"] = f"{churn_head} SELECT * FROM churn"
    sql["churn_summary"] = f"""{churn_head}
SELECT churn_risk, {big('count(*)')} AS user_count, {rnd(div('sum(days_since_last)', 'count(*)'), 1)} AS avg_days_inactive
FROM churn GROUP BY churn_risk"""
    sql["churn_distribution"] = (
        f"{churn_head} SELECT churn_risk, {big('count(*)')} AS user_count FROM churn GROUP BY churn_risk"
    )
    sens_head = heading(SALES, SENSITIVITY)
    sql["price_sensitivity"] = f"{sens_head} SELECT * FROM sens"
    sql["sensitivity_stats"] = f"""{sens_head}
SELECT sensitivity_segment, {big('count(*)')} AS count,
       {rnd(div('sum(CAST(avg_order_value AS DECIMAL(20,6)))', 'count(*)'), 2)} AS avg_order_value,
       {rnd(div('sum(total_orders)', 'count(*)'), 2)} AS avg_orders
FROM sens GROUP BY sensitivity_segment"""
    nps_head = heading(SALES, NPS)
    sql["nps_segments"] = f"""{nps_head}
SELECT nps_segment, {big('user_count')} AS user_count, {dbl('revenue')} AS total_revenue,
       {rnd(div('revenue', '(SELECT sum(revenue) FROM nps_class)') + ' * 100.0', 1)} AS nps_contribution
FROM nps_class"""
    counts = """
n AS (SELECT coalesce(sum(user_count) FILTER (WHERE nps_segment = 'Promoter (9-10)'), 0) AS p,
             coalesce(sum(user_count) FILTER (WHERE nps_segment = 'Detractor (0-6)'), 0) AS d,
             coalesce(sum(user_count), 0) AS t FROM nps_class)"""
    members = f"{big('p')} AS promoters, {big('d')} AS detractors, {big('t')} AS total_users FROM n"
    sql["nps_score"] = f"{nps_head}, {counts} SELECT coalesce({pct('p - d', 't', 1)}, 0.0) AS nps_score, {members}"
    sql["nps_score_reference_form"] = (
        f"{nps_head}, {counts} SELECT coalesce({pct('p - (t - p)', 't', 1)}, 0.0) AS nps_score, {members}"
    )
    sql["inactivity_histogram"] = f"""{churn_head},
x AS (SELECT CAST(days_since_last AS DOUBLE) AS x FROM churn WHERE churn_risk IN ('Active', 'Dormant')),
lim AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
h AS (SELECT greatest(CAST(ceil((x - lo) * 10 / (hi - lo)) AS BIGINT), 1) AS bin, count(*) AS n FROM x, lim GROUP BY 1)
SELECT {big('b')} AS bin, lo + (b - 1) * ((hi - lo) / 10.0) AS over, lo + b * ((hi - lo) / 10.0) AS up_to,
       {big('coalesce(n, 0)')} AS user_count
FROM range(1, 11) AS g(b) CROSS JOIN lim LEFT JOIN h ON h.bin = b"""
    sql["at_risk_top"] = f"""{churn_head}
SELECT user_id, name, email, city, member_level, days_since_last, churn_risk FROM churn
WHERE churn_risk IN ('At Risk', 'Churned') ORDER BY days_since_last DESC, user_id LIMIT 15"""
    sql["user_baskets"] = f"""{sales},
d AS (SELECT DISTINCT user_id, name FROM sales)
SELECT user_id, string_agg(name, ', ' ORDER BY name) AS items FROM d GROUP BY user_id"""
    # itemsets grow by an item of a larger number and keep the users who have all of it
    sql["association_rules"] = f"""{sales.replace("WITH", "WITH RECURSIVE", 1)},
d AS (SELECT DISTINCT user_id, name FROM sales),
t AS (SELECT count(DISTINCT user_id) AS n, ceil({RULE_SUPPORT} * count(DISTINCT user_id)) AS least FROM d),
one AS (SELECT name, row_number() OVER (ORDER BY name) AS i, list(user_id ORDER BY user_id) AS users
        FROM d GROUP BY name HAVING count(*) >= (SELECT least FROM t)),
sets AS (
  SELECT [name] AS items, i AS last, users FROM one
  UNION ALL
  SELECT * FROM (SELECT list_append(s.items, o.name) AS items, o.i AS last, list_intersect(s.users, o.users) AS users
                 FROM sets s JOIN one o ON o.i > s.last)
  WHERE len(users) >= (SELECT least FROM t)),
freq AS (SELECT items, len(users) AS c FROM sets),
each AS (SELECT list_filter(items, lambda x: x <> y) AS given, y, c
         FROM (SELECT items, c, unnest(items) AS y FROM freq WHERE len(items) > 1))
SELECT array_to_string(given, ', ') AS antecedent, y AS consequent, {div('each.c', 'g.c')} AS confidence,
       {div('each.c', 'g.c')} / {div('o.c', 't.n')} AS lift, {div('each.c', 't.n')} AS support
FROM each JOIN freq g ON g.items = each.given JOIN freq o ON o.items = [each.y] CROSS JOIN t
WHERE {div('each.c', 'g.c')} >= {RULE_CONFIDENCE}"""
    sql["vertical_rules"] = sql["association_rules"]

    # behaviour
    sql["daily_events"] = f"""SELECT {day('ts')} AS event_date, event_type, {big('count(*)')} AS event_count
FROM events GROUP BY 1, 2"""
    sql["channel_attribution"] = f"""{events}
SELECT (['search', 'social', 'email', 'direct', 'ads', 'partner'])[k % 6 + 1] AS referrer,
       {big('count(*)')} AS total_events, {big('count(DISTINCT user_id)')} AS unique_users
FROM ev GROUP BY 1"""
    sql["device_breakdown"] = f"""{events}
SELECT (['mobile', 'desktop', 'tablet'])[k % 3 + 1] AS device,
       (['android', 'ios', 'windows', 'macos'])[k % 4 + 1] AS os, {big('count(*)')} AS event_count
FROM ev GROUP BY 1, 2"""
    sql["support_summary"] = f"""{events}
SELECT event_type AS type, (['Low', 'Medium', 'High', 'Urgent'])[k % 4 + 1] AS priority,
       {big('count(*)')} AS ticket_count, {div('sum(nullif(k % 5, 0))', 'count(nullif(k % 5, 0))')} AS avg_satisfaction
FROM ev GROUP BY 1, 2"""
    sql["weekday_hour_heatmap"] = f"""{events}
SELECT dayname(ts) AS day_of_week, {big('hour(ts)')} AS hour_of_day, {big('count(*)')} AS order_count,
       {dbl('sum(amount)')} AS total_revenue
FROM ev GROUP BY 1, 2"""
    sql["weekday_seasonality"] = f"""{sales}
SELECT dayname(order_date) AS weekday, {big('isodow(order_date)')} AS weekday_order,
       {dbl('sum(line_revenue)')} AS total_revenue
FROM sales GROUP BY 1, 2"""
    sql["hour_seasonality"] = f"""{events}
SELECT {big('hour(ts)')} AS hour, {dbl('sum(amount)')} AS total_revenue FROM ev GROUP BY 1"""
    sql["funnel_conversion"] = f"{heading(FUNNEL)} SELECT * FROM funnel"
    sql["funnel_reference_form"] = f"""{heading(FUNNEL)},
r AS (SELECT stage_no, stage, n, {rnd(div('n', 'following') + ' * 100.0', 1)} AS conversion_rate FROM steps)
SELECT {big('stage_no')} AS stage_no, stage, {big('n')} AS count, conversion_rate,
       {rnd('100.0 - conversion_rate', 1)} AS dropoff_rate FROM r"""
    sql["dropoff_stages"] = f"{heading(FUNNEL)} SELECT stage, dropoff_rate FROM funnel WHERE dropoff_rate > 0"

    # dashboard figures
    sql["executive_kpis"] = f"""{heading(SALES, USERS, RETURNS, BY_ORDER, PL, CHURN)}
SELECT {dbl('sum(net)')} AS net_revenue, {dbl('sum(net - cogs)')} AS gross_profit,
       (SELECT {big("count(*) FILTER (WHERE churn_risk = 'Active')")} FROM churn) AS active_users,
       (SELECT {pct("count(*) FILTER (WHERE churn_risk = 'Churned')", 'count(*)', 1)} FROM churn) AS churn_rate_pct
FROM pl"""
    sql["revenue_series"] = f"{pl_head} SELECT order_month, net_revenue FROM pl_out"
    sql["brand_share"] = f"""{sales}
SELECT brand, {dbl('sum(line_revenue)')} AS total_revenue,
       {rnd(div('sum(line_revenue)', '(SELECT sum(line_revenue) FROM sales)') + ' * 100.0', 2)} AS share_pct
FROM sales GROUP BY brand"""
    sql["finance_points"] = f"""{pl_head}
SELECT row_number() OVER (ORDER BY order_month) - 1 AS x, gross_revenue AS y, net_revenue AS z, gross_revenue AS color
FROM pl_out"""
    sql["churn_points"] = f"""{heading(SALES, USERS, CHURN, BY_ORDER, BY_USER, RFM)}
SELECT name AS label, recency AS x, frequency AS y, monetary AS z,
       {big("CASE churn_risk WHEN 'Active' THEN 0 WHEN 'Dormant' THEN 1 WHEN 'At Risk' THEN 2 WHEN 'Churned' THEN 3 END")}
         AS color
FROM churn JOIN rfm USING (user_id)"""
    sql["rfm_points"] = f"{rfm_head} SELECT recency AS x, frequency AS y, monetary AS z, monetary AS color FROM rfm"
    sql["stock_points"] = f"""{heading(PRODUCTS)}
SELECT name AS label, {dbl('cost_price')} AS x, {big('stock_quantity')} AS y, {dbl('selling_price')} AS z,
       {big('stock_quantity')} AS color FROM prod"""
    sql["stage_points"] = f"""{heading(FUNNEL)}
SELECT {big('dense_rank() OVER (ORDER BY stage) - 1')} AS x, {big('1')} AS y, count AS z, count AS color FROM funnel"""
    sql["hour_points"] = f"""{events}
SELECT {big('hour(ts)')} AS x, {big('hour(ts) % 7')} AS y, {dbl('sum(amount)')} AS z, {dbl('sum(amount)')} AS color
FROM ev GROUP BY hour(ts)"""

    def shown(value: str, sign: str) -> str:
        return f"""CASE WHEN abs({value}) >= 1e9 THEN '{sign}' || format('{{:.1f}}', {value} / 1e9) || 'B'
            WHEN abs({value}) >= 1e6 THEN '{sign}' || format('{{:.1f}}', {value} / 1e6) || 'M'
            WHEN abs({value}) >= 1e3 THEN '{sign}' || format('{{:.1f}}', {value} / 1e3) || 'K'
            ELSE '{sign}' || format('{{:.0f}}', {value}) END"""

    sql["compact_totals"] = f"""
SELECT o_orderkey AS order_id, {shown('o_totalprice', '$')} AS shown,
       {shown('(o_totalprice * 10000)', '')} AS shown_large, {shown('(o_totalprice / 1000)', '$')} AS shown_small
FROM orders"""

    # monitoring
    sql["collection_counts"] = f"""
SELECT 'clickstream' AS collection, {big('count(*)')} AS documents FROM events
UNION ALL SELECT 'support_tickets', {big('count(*)')} FROM events"""
    sql["live_kpis"] = f"""{events},
m AS (SELECT max(ts) AS t FROM ev)
SELECT {big('count(*)')} AS total_orders,
       {big('count(*) FILTER (WHERE ts > t - INTERVAL 1 HOUR)')} AS hourly_orders,
       {big('count(*) FILTER (WHERE ts > t - INTERVAL 5 MINUTE)')} AS min5_orders,
       {stamp('max(ts) FILTER (WHERE ts > t - INTERVAL 1 HOUR)')} AS last_order,
       {dbl('coalesce(sum(amount) FILTER (WHERE ts > t - INTERVAL 24 HOUR), 0)')} AS daily_revenue,
       {big('count(DISTINCT user_id)')} AS unique_customers, {div('sum(amount)', 'count(amount)')} AS avg_order_value,
       {div('count(*) FILTER (WHERE ts > t - INTERVAL 5 MINUTE)', '300')} AS tx_per_sec
FROM ev, m"""
    sql["recent_orders"] = f"""{heading(ORDERS, USERS)}
SELECT order_id, {stamp('order_date')} AS order_date, strftime(order_date, '%H:%M:%S') AS order_time, name, status,
       {dbl('shipping_fee + discount_amount')} AS total
FROM hdr LEFT JOIN usr USING (user_id) ORDER BY hdr.order_date DESC, order_id DESC LIMIT 10"""
    sql["recent_events"] = f"""
SELECT event_id, user_id, event_type, {stamp('ts')} AS timestamp FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY ORDER BY event_id DESC LIMIT 100"""
    sql["recent_event_types"] = f"""
WITH r AS (SELECT event_id, event_type FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
           ORDER BY event_id DESC LIMIT 100)
SELECT event_type, {big('count(*)')} AS events FROM r GROUP BY event_type"""
    sql["orders_without_conflicts"] = """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'F'"""
    sql["status_distribution"] = (
        f"SELECT o_orderstatus AS status, {big('count(*)')} AS order_count FROM orders GROUP BY 1"
    )
    sql["minute_trend"] = f"""
WITH m AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS orders FROM events GROUP BY 1),
w AS (SELECT *, sum(orders) OVER five AS s, count(*) OVER five AS c FROM m
      WINDOW five AS (ORDER BY minute ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT {stamp('minute')} AS minute, {big('orders')} AS orders,
       CASE WHEN c = 5 THEN CAST(s AS DOUBLE) / 5.0 END AS moving_avg FROM w"""
    rate = div("count(*)", "3600")
    sql["throughput_scorecard"] = f"""
SELECT {stamp("date_trunc('hour', ts)")} AS step_start, {big('count(*)')} AS events,
       CAST({TARGET_RATE} AS DOUBLE) AS target_rate, {rate} AS actual_rate,
       {rnd(div(rate, str(TARGET_RATE)) + ' * 100.0', 1)} AS success_pct,
       CASE WHEN {div(rate, str(TARGET_RATE))} > 0.8 THEN 'PASS' ELSE 'FAIL' END AS status
FROM events GROUP BY date_trunc('hour', ts)"""
    sql["latency_classes"] = f"""
SELECT CASE WHEN value * 10 < 100 THEN 'good' WHEN value * 10 < 500 THEN 'fair' ELSE 'poor' END AS latency_class,
       {big('count(*)')} AS requests FROM events GROUP BY 1"""
    sql["latest_months"] = f"{pl_head} SELECT * FROM pl_out ORDER BY order_month DESC LIMIT 100"
    sql["latest_rfm"] = (
        f"{rfm_head} SELECT user_id, recency, frequency, monetary FROM rfm ORDER BY user_id DESC LIMIT 100"
    )
    sql["order_line_sample"] = f"""{heading(ORDERS)},
i AS (SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS line_amount FROM lineitem),
top AS (SELECT hdr.*, product_id, quantity, line_amount FROM hdr JOIN i USING (order_id)
        ORDER BY order_id, product_id, quantity, line_amount LIMIT 100)
SELECT order_id, user_id, {stamp('order_date')} AS order_date, status, payment_method,
       {dbl('shipping_fee')} AS shipping_fee, {dbl('discount_amount')} AS discount_amount, product_id, quantity,
       {dbl('line_amount')} AS line_amount FROM top"""

    # live monitors
    minutes = heading(window_counts(60, 60))
    sql["orders_by_minute"] = f"{minutes} SELECT {bounds(60)}, {big('count(*)')} AS orders FROM win GROUP BY w0"
    sql["amount_by_hour"] = f"""{heading(window_counts(3600, 3600))}
SELECT {bounds(3600)}, {dbl('sum(CAST(value AS DECIMAL(18,2)))')} AS revenue FROM win GROUP BY w0"""
    sql["sliding_rate"] = f"""{heading(window_counts(300, 60))}
SELECT {bounds(300)}, {big('count(*)')} AS events, {div('count(*)', '300')} AS tx_per_sec FROM win GROUP BY w0"""
    sql["event_mix_by_window"] = f"""{heading(window_counts(300, 300))}
SELECT {bounds(300)}, event_type, {big('count(*)')} AS events FROM win GROUP BY w0, event_type"""
    sql["sliding_kpis"] = f"""{heading(window_counts(3600, 300))}
SELECT {bounds(3600)}, {big('count(*)')} AS orders, {dbl('sum(CAST(value AS DECIMAL(18,2)))')} AS revenue,
       {big('count(DISTINCT user_id)')} AS customers,
       {div('sum(CAST(value AS DECIMAL(18,2)))', 'count(*)')} AS avg_value
FROM win GROUP BY w0"""
    sql["deduplicated_events"] = "SELECT event_id, user_id, event_type FROM events"
    # streams: the windows that the watermark has closed
    def closed(seconds: int, delay: int) -> str:
        return f"HAVING w0 + INTERVAL {seconds} SECOND <= (SELECT max(ts) FROM events) - INTERVAL {delay} SECOND"

    sql["stream_orders_by_minute"] = f"{sql['orders_by_minute']} {closed(60, 600)}"
    sql["stream_late_rows"] = sql["stream_orders_by_minute"]
    sql["stream_amount_by_hour"] = f"{sql['amount_by_hour']} {closed(3600, 3600)}"
    sql["stream_sliding_rate"] = f"{sql['sliding_rate']} {closed(300, 600)}"
    sql["stream_event_mix"] = f"{sql['event_mix_by_window']} {closed(300, 600)}"
    sql["stream_daily_funnel"] = f"""SELECT {day('ts')} AS event_date, event_type, {big('count(*)')} AS event_count
FROM events GROUP BY date_trunc('day', ts), {day('ts')}, event_type
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""
    sql["stream_sliding_kpis"] = f"""{heading(window_counts(3600, 300))}
SELECT {bounds(3600)}, {big('count(*)')} AS orders, {dbl('sum(CAST(value AS DECIMAL(18,2)))')} AS revenue,
       {div('sum(CAST(value AS DECIMAL(18,2)))', 'count(*)')} AS avg_value, TRUE AS customers_near
FROM win GROUP BY w0 {closed(3600, 3600)}"""
    sql["stream_deduplicated"] = sql["deduplicated_events"]
    first = f"SELECT event_id, user_id, event_type, {stamp('ts')} AS ts, value FROM events"
    last = "ts + CASE WHEN event_id % 3 = 0 THEN INTERVAL 5 MINUTE ELSE INTERVAL 0 MINUTE END"
    sql["earliest_of_copies"] = first
    sql["stream_earliest"] = f"{first} WHERE {last} + INTERVAL 1 HOUR <= (SELECT max({last}) FROM events) - INTERVAL 1 DAY"
    sql["late_users"] = f"""
WITH u AS (SELECT user_id, min(ts) + to_hours(CAST((user_id * 7) % 60 - 20 AS INTEGER)) AS recorded,
                  'user ' || CAST(user_id AS VARCHAR) AS label FROM events GROUP BY user_id)
SELECT event_id, e.user_id, {stamp('ts')} AS ts, label, {stamp('recorded')} AS recorded FROM events e
LEFT JOIN u ON u.user_id = e.user_id AND recorded BETWEEN ts - INTERVAL 1 DAY AND ts + INTERVAL 1 DAY"""
    sql["stream_late_users"] = sql["late_users"]
    rate = div("count(*)", "((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0)")
    sql["stream_throughput"] = f"""
WITH ends AS (SELECT min(epoch_us(ts)) AS low, (max(epoch_us(ts)) - min(epoch_us(ts))) // 3 + 1 AS step FROM events)
SELECT {big('(epoch_us(ts) - low) // step')} AS batch, {big('count(*)')} AS events, {stamp('min(ts)')} AS first,
       {stamp('max(ts)')} AS last, CAST({TARGET_RATE} AS DOUBLE) AS target_rate, {rate} AS actual_rate,
       {rnd(div(rate, str(TARGET_RATE)) + ' * 100.0', 1)} AS success_pct,
       CASE WHEN {div(rate, str(TARGET_RATE))} > 0.8 THEN 'PASS' ELSE 'FAIL' END AS status
FROM events, ends GROUP BY 1"""
    sql["stream_appended"] = sql["deduplicated_events"]
    sql["stream_enriched"] = f"""{heading(EVENTS, USERS)}
SELECT event_id, ev.user_id, '/page/' || CAST(k AS VARCHAR) AS url, k AS duration_sec, name, city
FROM ev LEFT JOIN usr USING (user_id)"""

    sql["minute_trend_last_hour"] = f"""
WITH m AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS orders FROM events
           WHERE ts > (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1),
w AS (SELECT *, sum(orders) OVER five AS s, count(*) OVER five AS c FROM m
      WINDOW five AS (ORDER BY minute ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT {stamp('minute')} AS minute, {big('orders')} AS orders,
       CASE WHEN c = 5 THEN CAST(s AS DOUBLE) / 5.0 END AS moving_avg FROM w"""
    sql["timed_minute_trend"] = sql["minute_trend_last_hour"]
    for name in ("recent_events", "recent_orders", "live_kpis"):
        sql[f"timed_{name}"] = sql[name]
    sql["mixed_clicks"] = f"""
WITH e AS (SELECT *, CAST(props ->> '$.k' AS INTEGER) AS k FROM events WHERE event_id % 97 <> 0),
d AS (SELECT CASE event_id % 3
        WHEN 0 THEN json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type)
        WHEN 1 THEN json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type, 'metadata',
                                json_object('url', '/page/' || k, 'session_duration_sec', CAST(k AS VARCHAR)))
        ELSE json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type, 'metadata',
                         json_object('page', json_object('url', '/page/' || k), 'session', json_object('duration_sec', k)))
      END AS j FROM e)
SELECT {big("j ->> '$.event_id'")} AS event_id, {big("j ->> '$.user_id'")} AS user_id, j ->> '$.event_type' AS event_type,
       coalesce(j ->> '$.metadata.url', j ->> '$.metadata.page.url') AS url,
       {big("coalesce(j ->> '$.metadata.session_duration_sec', j ->> '$.metadata.session.duration_sec')")} AS duration_sec
FROM d"""
    head, whole = "OBJECT<event_id: BIGINT, event_type: STRING, ", "user_id: BIGINT>"
    flat = "session_duration_sec: STRING, url: STRING"
    nested = "page: OBJECT<url: STRING>, session: OBJECT<duration_sec: BIGINT>"
    both = "page: OBJECT<url: STRING>, session: OBJECT<duration_sec: BIGINT>, session_duration_sec: STRING, url: STRING"
    sql["mixed_shapes"] = f"""
SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 3 = 0 THEN '{head}{whole}'
            WHEN event_id % 3 = 1 THEN '{head}metadata: OBJECT<{flat}>, {whole}'
            ELSE '{head}metadata: OBJECT<{nested}>, {whole}' END AS shape, {big('count(*)')} AS documents
FROM events GROUP BY 1
UNION ALL SELECT 'all: {head}metadata: OBJECT<{both}>, {whole}', NULL"""
    sql["table_rows"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {big('count(*)')} AS row_count FROM {t}"
        for t in ("orders", "lineitem", "customer", "part", "supplier", "events")
    )
    sql["documents_round_trip"] = f"SELECT {big('event_id')} AS event_id, {big('user_id')} AS user_id, event_type, value FROM events"
    for name, frequency, k in (("clusters_of_five", "frequency", 5), ("clusters_of_four", "line_frequency", 4)):
        sql[name] = f"""{rfm_head}
SELECT {big(f'count({frequency})')} AS users, round(sum(CAST(monetary AS DOUBLE)), 2) AS total, TRUE AS near_own_centre,
       {big(str(k))} AS segments, TRUE AS rising FROM rfm"""
    # rules of any size over the few categories: every subset of an order's set is counted
    sql["category_rules"] = f"""{sales},
d AS (SELECT order_id, list_sort(list(DISTINCT category)) AS items FROM sales GROUP BY order_id),
t AS (SELECT count(*) AS n FROM d),
names AS (SELECT list_sort(list(DISTINCT category)) AS every FROM sales),
masks AS (SELECT list_filter(every, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items
          FROM names, range(1, 64) AS r(m) WHERE m < (1 << len(every))),
freq AS (SELECT masks.items, count(*) AS c FROM masks JOIN d ON list_has_all(d.items, masks.items)
         GROUP BY masks.items HAVING count(*) >= ceil(0.01 * (SELECT n FROM t)))
SELECT list_aggregate(a.items, 'string_agg', ', ') AS antecedent, list_aggregate(b.items, 'string_agg', ', ') AS consequent,
       {div('w.c', 'a.c')} AS confidence, {div('w.c', 'a.c')} / {div('b.c', '(SELECT n FROM t)')} AS lift,
       {div('w.c', '(SELECT n FROM t)')} AS support
FROM freq w JOIN freq a ON list_has_all(w.items, a.items) AND len(a.items) = len(w.items) - 1
JOIN freq b ON list_has_all(w.items, b.items) AND len(b.items) = 1 AND NOT list_has_any(a.items, b.items)
WHERE {div('w.c', 'a.c')} >= {RULE_CONFIDENCE}"""
    sql["yearly_buyers_by_city"] = f"""{heading(SALES, USERS)}
SELECT city, strftime(order_date, '%Y') AS year, {big('count(DISTINCT user_id)')} AS buyers
FROM sales JOIN usr USING (user_id) GROUP BY ALL"""
    sql["quarterly_active_buyers"] = f"""{heading(SALES, USERS)},
bought AS (SELECT DISTINCT user_id, date_trunc('month', order_date) AS m FROM sales JOIN usr USING (user_id)),
months AS (SELECT DISTINCT m FROM bought)
SELECT strftime(months.m, '%Y-%m') AS order_month, {big('count(DISTINCT user_id)')} AS buyers
FROM months JOIN bought ON bought.m <= months.m AND bought.m > months.m - INTERVAL 3 MONTH GROUP BY months.m"""
    for table, query in GOLD_TABLES.items():
        sql[table] = sql[query]
        if f"refreshed_{query}" in REFRESHED:
            sql[f"refreshed_{query}"] = sql[query]
    return sql
