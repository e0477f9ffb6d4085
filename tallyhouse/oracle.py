"""SQL equivalents of the registered queries, for an SQL engine on the same tables.

Named parts are common table expressions; a query gets those it mentions. They
repeat the adapter's rules and the plain textbook form of each operator: single
windows for ranks, joins of whole lines for the fan-out, and so on.
"""

from __future__ import annotations

import re

# --- fixed values: unified names, and where a channel's raw table lacks a column ----------
CHANNELS = ("store", "catalog", "web")
SALE_FIELDS = (
    "sale_order_id item_sk customer_sk cdemo_sk hdemo_sk addr_sk store_sk call_center_sk "
    "catalog_page_sk warehouse_sk web_page_sk web_site_sk ship_mode_sk promo_sk sold_date_sk "
    "ship_date_sk sold_time_sk quantity wholesale_cost list_price sales_price ext_discount_amt "
    "ext_sales_price ext_wholesale_cost ext_list_price ext_tax coupon_amt ext_ship_cost net_paid "
    "net_paid_inc_tax net_paid_inc_ship net_paid_inc_ship_tax net_profit"
).split()
RETURN_FIELDS = (
    "return_order_id item_sk refunded_customer_sk returning_customer_sk refunded_cdemo_sk "
    "refunded_hdemo_sk refunded_addr_sk store_sk call_center_sk catalog_page_sk warehouse_sk "
    "web_page_sk ship_mode_sk reason_sk returned_date_sk returned_time_sk return_quantity "
    "return_amt return_tax return_amt_inc_tax fee return_ship_cost refunded_cash "
    "reversed_charge credit net_loss"
).split()
MONEY = set(SALE_FIELDS[18:] + RETURN_FIELDS[17:])
# The line data has no rule for these.
NEVER = set("call_center_sk catalog_page_sk web_page_sk web_site_sk ship_mode_sk".split())
SALES_LACK = {
    "store_sk": ("catalog", "web"),
    "warehouse_sk": ("store",),
    "ship_date_sk": ("store",),
    "ext_ship_cost": ("store",),
    "net_paid_inc_ship": ("store",),
    "net_paid_inc_ship_tax": ("store",),
}
RETURNS_LACK = {
    "store_sk": ("catalog", "web"),
    "warehouse_sk": ("store", "web"),
    "return_ship_cost": ("store",),
}
# --- end of fixed values -----------------------------------------------------------------

DEC = "DECIMAL(15,2)"
LINEAGE = "'driver' AS _batch_id, '2026-01-01 00:00:00' AS _ingested_at, '{}' AS _source_file"
LINE_LINEAGE = LINEAGE.format("lineitem.parquet")


def day_key(day: str) -> str:
    return f"CAST(2449719 + date_diff('day', DATE '1995-01-01', CAST({day} AS DATE)) AS INTEGER)"


def unit(column: str) -> str:
    return f"CAST((CAST({column} * 100 AS BIGINT) // units) * 0.01 AS {DEC})"


def ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0)"


def exact(part: str, whole: str, scale: int = 4) -> str:
    """The quotient with ``scale`` digits, halves away from zero, in whole numbers."""
    n, d = (f"CAST(({x}) * 100 AS HUGEINT)" for x in (part, whole))
    return (
        f"CASE WHEN {d} <> 0 THEN CAST(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END "
        f"* ((2 * {10**scale} * abs({n}) + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {10**scale} END"
    )


def total(column: str) -> str:
    return f"CAST(SUM({column}) AS BIGINT)"


def money(column: str) -> str:
    return f"CAST(SUM({column}) AS {DEC.replace('15', '25')})"


CTES: dict[str, str] = {}

CTES["lines"] = f"""
SELECT *,
  CASE o_orderkey % 3 WHEN 0 THEN 'store' WHEN 1 THEN 'catalog' ELSE 'web' END AS channel,
  CASE WHEN o_orderkey % 211 = 210 THEN NULL ELSE o_orderkey END AS order_no,
  CASE WHEN l_partkey % 97 = 96 THEN NULL ELSE l_partkey END AS item_sk,
  CAST(l_quantity AS INTEGER) AS units,
  CAST((CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) // 2) * 0.01 AS {DEC})
    AS ext_list_price,
  CAST(ext_list_price * CAST(l_discount AS DECIMAL(4,2)) AS {DEC}) AS ext_discount_amt,
  CAST(ext_list_price - ext_discount_amt AS {DEC}) AS ext_sales_price,
  CAST(ext_sales_price * CAST(l_tax AS DECIMAL(4,2)) AS {DEC}) AS ext_tax,
  CAST(ext_list_price * 0.60 AS {DEC}) AS ext_wholesale_cost
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["sale_lines"] = f"""
SELECT * EXCLUDE (order_no), order_no AS sale_order_id,
  CASE WHEN o_orderkey % 53 = 52 OR o_custkey % 41 = 40 THEN NULL ELSE o_custkey END
    AS customer_sk,
  CASE WHEN o_orderkey % 199 = 198 THEN NULL ELSE {day_key("o_orderdate")} END AS sold_date_sk,
  {day_key("l_shipdate")} AS ship_date_sk,
  o_custkey % 7 AS cdemo_sk, o_custkey % 10 AS hdemo_sk, o_custkey % 25 AS addr_sk,
  l_partkey % 20 AS promo_sk, o_orderkey % 86400 AS sold_time_sk,
  l_suppkey AS store_sk, l_suppkey AS warehouse_sk,
  CASE WHEN o_orderkey % 157 = 156 AND l_linenumber = 2 THEN 0 ELSE units END AS quantity,
  {unit("ext_wholesale_cost")} AS wholesale_cost,
  {unit("ext_list_price")} AS list_price,
  CASE WHEN o_orderkey % 163 = 162 AND l_linenumber = 3 THEN CAST(-1 AS {DEC})
    ELSE {unit("ext_sales_price")} END AS sales_price,
  CAST(0 AS {DEC}) AS coupon_amt,
  CAST(ext_list_price * 0.05 AS {DEC}) AS ext_ship_cost,
  CAST(CASE WHEN o_orderkey % 173 = 172 AND l_linenumber = 4 THEN -ext_sales_price
    ELSE ext_sales_price END AS {DEC}) AS net_paid,
  CAST(net_paid + ext_tax AS {DEC}) AS net_paid_inc_tax,
  CAST(net_paid + ext_ship_cost AS {DEC}) AS net_paid_inc_ship,
  CAST(net_paid + ext_ship_cost + ext_tax AS {DEC}) AS net_paid_inc_ship_tax,
  CAST(net_paid - ext_wholesale_cost AS {DEC}) AS net_profit
FROM lines"""

CTES["return_lines"] = f"""
SELECT * EXCLUDE (order_no), order_no AS return_order_id,
  o_custkey AS refunded_customer_sk,
  CASE WHEN channel = 'store' THEN o_custkey ELSE o_custkey + 1 END AS returning_customer_sk,
  o_custkey % 7 AS refunded_cdemo_sk, o_custkey % 10 AS refunded_hdemo_sk,
  o_custkey % 25 AS refunded_addr_sk, l_linenumber AS reason_sk,
  (o_orderkey + 60) % 86400 AS returned_time_sk,
  l_suppkey AS store_sk, l_suppkey AS warehouse_sk,
  CASE WHEN o_orderkey % 181 = 180 THEN NULL ELSE {day_key("l_shipdate")} END AS returned_date_sk,
  CASE WHEN o_orderkey % 149 = 148 THEN -1 ELSE greatest(1, units // 2) END AS return_quantity,
  CAST(CASE WHEN o_orderkey % 167 = 166 THEN -5 ELSE ext_sales_price * 0.50 END AS {DEC})
    AS return_amt,
  CAST(ext_tax * 0.50 AS {DEC}) AS return_tax,
  CAST(return_amt + return_tax AS {DEC}) AS return_amt_inc_tax,
  CAST(0.50 AS {DEC}) AS fee,
  CAST(ext_list_price * 0.02 AS {DEC}) AS return_ship_cost,
  return_amt AS refunded_cash,
  CAST(0 AS {DEC}) AS reversed_charge,
  CAST(return_amt * 0.20 AS {DEC}) AS credit,
  CAST(return_amt * 0.10 AS {DEC}) AS net_loss
FROM lines WHERE l_returnflag = 'R'"""



def is_money(field: str) -> bool:
    return field in MONEY


def staged(lines: str, fields: list[str], lack: dict[str, tuple]) -> str:
    columns = []
    for field in fields:
        if field in NEVER:
            columns.append(f"CAST(NULL AS INTEGER) AS {field}")
        elif field in lack:
            listed = ", ".join(f"'{c}'" for c in lack[field])
            columns.append(f"CASE WHEN channel NOT IN ({listed}) THEN {field} END AS {field}")
        else:
            columns.append(field)
    return f"SELECT channel, {', '.join(columns)}, {LINE_LINEAGE} FROM {lines}"


CTES["staged_sales"] = staged("sale_lines", SALE_FIELDS, SALES_LACK)
CTES["staged_returns"] = staged("return_lines", RETURN_FIELDS, RETURNS_LACK)
CTES["tagged_sales"] = """
SELECT *, CASE
  WHEN item_sk IS NULL THEN 'missing_item_sk'
  WHEN sale_order_id IS NULL THEN 'missing_order_id'
  WHEN sold_date_sk IS NULL THEN 'missing_sold_date'
  WHEN quantity <= 0 THEN 'non_positive_quantity'
  WHEN sales_price < 0 THEN 'negative_sales_price'
  WHEN net_paid < 0 THEN 'negative_net_paid' END AS _anomaly_reason
FROM staged_sales"""
CTES["tagged_returns"] = """
SELECT *, CASE
  WHEN item_sk IS NULL THEN 'missing_item_sk'
  WHEN return_order_id IS NULL THEN 'missing_order_id'
  WHEN returned_date_sk IS NULL THEN 'missing_returned_date'
  WHEN return_quantity <= 0 THEN 'non_positive_quantity'
  WHEN return_amt < 0 THEN 'negative_return_amt' END AS _anomaly_reason
FROM staged_returns"""
CTES["sales"] = "SELECT * FROM tagged_sales WHERE _anomaly_reason IS NULL"
CTES["returns"] = "SELECT * FROM tagged_returns WHERE _anomaly_reason IS NULL"


def calendar(first: str, last: str) -> str:
    return f"""
SELECT {day_key("day")} AS date_key, CAST(day AS DATE) AS calendar_date,
  CAST(year(day) AS INTEGER) AS calendar_year, CAST(month(day) AS INTEGER) AS month_of_year,
  CAST(day(day) AS INTEGER) AS day_of_month, CAST(quarter(day) AS INTEGER) AS quarter_of_year,
  year(day) || 'Q' || quarter(day) AS quarter_name,
  CAST(({day_key("day")} - 2415021) // 7 AS INTEGER) AS week_seq,
  CAST((year(day) - 1900) * 12 + month(day) - 1 AS INTEGER) AS month_seq,
  CAST((year(day) - 1900) * 4 + quarter(day) - 1 AS INTEGER) AS quarter_seq,
  CAST(dayofweek(day) AS INTEGER) AS day_of_week, dayname(day) AS day_name,
  CASE WHEN dayofweek(day) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN month(day) = 12 AND day(day) = 25 THEN 1 ELSE 0 END AS is_holiday,
  0 AS is_current_day, 0 AS is_current_week, 0 AS is_current_month, 0 AS is_current_year
FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS day)"""


CTES["dates"] = calendar(
    "(SELECT make_date(year(least((SELECT min(o_orderdate) FROM orders), "
    "(SELECT min(l_shipdate) FROM lineitem))), 1, 1))",
    "(SELECT make_date(year(greatest((SELECT max(o_orderdate) FROM orders), "
    "(SELECT max(l_shipdate) FROM lineitem))), 12, 31))",
)
CTES["items"] = f"""
SELECT p_partkey AS item_key, 'ITEM' || (p_partkey // 2) AS item_id, p_name AS item_description,
  trim(p_name) AS product_name, trim(p_brand) AS brand,
  CAST(substr(p_brand, 7) AS INTEGER) AS brand_id,
  'class ' || (p_size % 4) AS item_class, CAST(p_size % 4 AS INTEGER) AS item_class_id,
  trim(p_type) AS category, CAST(NULL AS INTEGER) AS category_id,
  'maker ' || (p_partkey % 5) AS manufacturer, CAST(NULL AS INTEGER) AS manufacturer_id,
  CAST(p_size AS VARCHAR) AS size, split_part(p_name, ' ', 1) AS color,
  CAST(NULL AS VARCHAR) AS units, CAST(NULL AS VARCHAR) AS container,
  CAST(NULL AS INTEGER) AS manager_id,
  CAST(p_retailprice AS {DEC}) AS current_price,
  CAST(CAST(p_retailprice AS {DEC}) * 0.60 AS {DEC}) AS wholesale_cost,
  CASE WHEN p_partkey % 2 = 0 THEN DATE '1995-01-01' ELSE DATE '1998-01-01' END AS rec_start_date,
  CASE WHEN p_partkey % 2 = 0 THEN DATE '1997-12-31' END AS rec_end_date,
  CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 1 END AS is_current
FROM part"""
CTES["customers"] = """
SELECT c_custkey AS customer_key, 'CUST' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS customer_id,
  CAST(NULL AS VARCHAR) AS salutation,
  CASE WHEN c_custkey % 29 <> 28 THEN split_part(c_name, '#', 1) END AS first_name,
  CASE WHEN c_custkey % 17 = 0 THEN '"' || split_part(c_name, '#', 2) || '" | jr'
    ELSE split_part(c_name, '#', 2) END AS last_name, first_name || ' ' || last_name AS customer_name,
  CASE WHEN c_custkey % 37 <> 36 AND c_acctbal > 4000 THEN 1 ELSE 0 END AS is_preferred_customer,
  CAST(1940 + c_custkey % 60 AS INTEGER) AS birth_year, CAST(NULL AS VARCHAR) AS birth_country,
  lower(replace(c_name, '#', '.')) || '@example.com' AS email_address,
  CAST(NULL AS INTEGER) AS first_sales_date_key, CAST(NULL AS INTEGER) AS first_shipto_date_key,
  'City of ' || n_name AS city, CAST(NULL AS VARCHAR) AS county, n_name AS state,
  lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip, r_name AS country,
  CAST(n_nationkey % 12 - 6 AS DOUBLE) AS gmt_offset,
  CASE WHEN (c_custkey % 7) % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  substr('SMDWU', CAST((c_custkey % 7) % 5 + 1 AS INTEGER), 1) AS marital_status,
  CASE WHEN c_custkey % 7 < 4 THEN 'College' ELSE 'Primary' END AS education_status,
  CASE WHEN (c_custkey % 7) % 3 = 0 THEN 'Good' ELSE 'Low Risk' END AS credit_rating,
  CAST(500 * (c_custkey % 7 + 1) AS INTEGER) AS purchase_estimate,
  CAST(c_custkey % 7 AS INTEGER) AS dependent_count,
  CASE WHEN c_custkey % 10 < 5 THEN '501-1000' ELSE '>10000' END AS buy_potential,
  CAST((c_custkey % 10) % 4 AS INTEGER) AS vehicle_count,
  CAST((c_custkey % 5) * 10000 + 1 AS INTEGER) AS income_lower_bound,
  CAST((c_custkey % 5 + 1) * 10000 AS INTEGER) AS income_upper_bound
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey"""
CTES["promotions"] = """
SELECT id AS promo_key, 'PROMO' || lpad(CAST(id AS VARCHAR), 3, '0') AS promo_id,
  'promo ' || id AS promo_name, CAST(1000 * id AS DOUBLE) AS cost, 1 AS response_target,
  'Unknown' AS purpose, CASE WHEN id % 4 = 0 THEN 0 ELSE 1 END AS is_active,
  CASE WHEN id % 2 = 0 THEN 1 ELSE 0 END AS via_dmail,
  CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END AS via_email, 0 AS via_catalog,
  CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END AS via_tv, 0 AS via_radio, 0 AS via_press,
  0 AS via_event, 0 AS via_demo, 2449719 + id AS start_date_key, 2449749 + id AS end_date_key,
  id + 1 AS item_key
FROM (SELECT DISTINCT l_partkey % 20 AS id FROM lineitem)"""
CTES["stores"] = """
SELECT s_suppkey AS store_key, 'STORE' || (s_suppkey // 2) AS store_id, trim(s_name) AS store_name,
  CAST(NULL AS VARCHAR) AS manager, CAST(NULL AS VARCHAR) AS company_name,
  CAST(s_suppkey % 300 + 1 AS INTEGER) AS employees, CAST(NULL AS INTEGER) AS floor_space,
  '8AM-8AM' AS hours, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS county,
  CAST(s_nationkey AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS zip,
  CAST(NULL AS VARCHAR) AS country, CAST(s_nationkey % 12 - 6 AS DOUBLE) AS gmt_offset,
  CAST(CAST(s_suppkey % 12 * 0.01 AS DECIMAL(5,2)) AS DOUBLE) AS tax_percentage,
  '1997-03-13' AS rec_start_date,
  CASE WHEN s_suppkey % 2 = 0 THEN '1999-03-13' END AS rec_end_date,
  CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 1 END AS is_current
FROM supplier"""
CTES["raw_stock"] = f"""
SELECT CASE WHEN k % 31 = 30 THEN NULL ELSE k END AS date_sk,
  CASE WHEN p % 97 = 96 THEN NULL ELSE p END AS item_sk,
  CASE WHEN s % 13 = 12 THEN NULL ELSE s END AS warehouse_sk,
  CAST(q AS INTEGER) AS quantity_on_hand, 'driver' AS _batch_id
FROM (SELECT {day_key("date_trunc('month', l_shipdate)")} AS k, l_partkey AS p, l_suppkey AS s,
  SUM(l_quantity) AS q FROM lineitem GROUP BY 1, 2, 3)"""
CTES["stock"] = """
SELECT * FROM raw_stock
WHERE date_sk IS NOT NULL AND item_sk IS NOT NULL AND warehouse_sk IS NOT NULL"""

CTES["daily_sales"] = f"""
SELECT sold_date_sk AS date_key, channel, {total("quantity")} AS units_sold,
  {money("ext_sales_price")} AS gross_sales, {money("ext_discount_amt")} AS discount_amount,
  {money("ext_tax")} AS tax_amount, {money("net_paid")} AS net_sales,
  {money("net_profit")} AS net_profit, COUNT(DISTINCT sale_order_id) AS order_count
FROM sales GROUP BY 1, 2"""
CTES["daily_returns"] = f"""
SELECT returned_date_sk AS date_key, channel, {total("return_quantity")} AS units_returned,
  {money("return_amt")} AS returns_amount
FROM returns GROUP BY 1, 2"""
CTES["monthly_sales"] = f"""
SELECT calendar_year, month_of_year, quarter_of_year, channel, {total("quantity")} AS units_sold,
  {money("ext_sales_price")} AS gross_sales, {money("net_paid")} AS net_sales,
  {money("net_profit")} AS net_profit, COUNT(DISTINCT sale_order_id) AS order_count,
  COUNT(DISTINCT customer_sk) AS unique_customers
FROM sales JOIN dates ON sold_date_sk = date_key GROUP BY 1, 2, 3, 4"""
CTES["monthly_returns"] = f"""
SELECT calendar_year, month_of_year, channel, {total("return_quantity")} AS units_returned,
  {money("return_amt")} AS returns_amount
FROM returns JOIN dates ON returned_date_sk = date_key GROUP BY 1, 2, 3"""
CTES["monthly_total"] = """
SELECT calendar_year, month_of_year, SUM(gross_sales) AS total_gross
FROM monthly_sales GROUP BY 1, 2"""
CTES["item_sales"] = f"""
SELECT item_sk, {total("quantity")} AS units_sold, {money("ext_sales_price")} AS gross_revenue,
  {money("net_paid")} AS net_revenue, {money("net_profit")} AS net_profit,
  COUNT(DISTINCT customer_sk) AS distinct_customers,
  {ratio(money("sales_price"), "COUNT(sales_price)")} AS avg_sales_price
FROM sales GROUP BY 1"""
CTES["item_returns"] = f"""
SELECT item_sk, {total("return_quantity")} AS units_returned, {money("return_amt")} AS returns_amount
FROM returns GROUP BY 1"""
CTES["item_top_channel"] = """
SELECT item_sk, channel FROM (
  SELECT item_sk, channel,
    ROW_NUMBER() OVER (PARTITION BY item_sk ORDER BY SUM(quantity) DESC, channel) AS rn
  FROM sales GROUP BY item_sk, channel) WHERE rn = 1"""
CTES["customer_sales"] = f"""
SELECT customer_sk, MIN(sold_date_sk) AS first_purchase_date_key,
  MAX(sold_date_sk) AS last_purchase_date_key,
  COUNT(DISTINCT channel || '-' || CAST(sale_order_id AS VARCHAR)) AS frequency,
  {total("quantity")} AS lifetime_units, {money("net_paid")} AS lifetime_value,
  COUNT(DISTINCT channel) AS channels_used
FROM sales WHERE customer_sk IS NOT NULL GROUP BY 1"""
CTES["preferred_channel"] = """
SELECT customer_sk, channel FROM (
  SELECT customer_sk, channel,
    ROW_NUMBER() OVER (PARTITION BY customer_sk ORDER BY SUM(net_paid) DESC, channel) AS rn
  FROM sales WHERE customer_sk IS NOT NULL GROUP BY customer_sk, channel) WHERE rn = 1"""
CTES["date_anchor"] = """
SELECT MAX(calendar_date) AS today FROM sales JOIN dates ON sold_date_sk = date_key"""


def quintile(order: str) -> str:
    return (
        f"CAST(ceil(5.0 * CAST(ROW_NUMBER() OVER (ORDER BY {order}, customer_sk) AS DOUBLE) "
        "/ CAST(COUNT(*) OVER () AS DOUBLE)) AS INTEGER)"
    )


CTES["rfm"] = f"""
SELECT c.*, calendar_date AS last_purchase_date,
  CAST(date_diff('day', calendar_date, (SELECT today FROM date_anchor)) AS INTEGER)
    AS recency_days,
  {quintile("calendar_date ASC")} AS r_score,
  {quintile("frequency ASC")} AS f_score,
  {quintile("lifetime_value ASC")} AS m_score
FROM customer_sales c JOIN dates ON last_purchase_date_key = date_key"""

CTES["mart_sales_performance"] = f"""
SELECT s.date_key, CAST(calendar_date AS VARCHAR) AS calendar_date, calendar_year, quarter_of_year,
  month_of_year, day_of_week, day_name, is_weekend, s.channel, units_sold, order_count,
  {exact("net_sales", "order_count", 2)} AS avg_order_value, gross_sales, discount_amount,
  tax_amount, net_sales, net_profit, {exact("net_profit", "gross_sales")} AS profit_margin,
  COALESCE(units_returned, 0) AS units_returned, COALESCE(returns_amount, 0) AS returns_amount,
  gross_sales - COALESCE(returns_amount, 0) AS net_revenue,
  {exact("COALESCE(units_returned, 0)", "units_sold")} AS returns_rate
FROM daily_sales s JOIN dates USING (date_key)
  LEFT JOIN daily_returns r ON s.date_key = r.date_key AND s.channel = r.channel"""
CTES["mart_channel_comparison"] = f"""
SELECT s.calendar_year, s.month_of_year, quarter_of_year, s.channel, units_sold, order_count,
  unique_customers, gross_sales, net_sales, net_profit,
  {exact("units_sold", "order_count", 2)} AS avg_basket_size,
  {exact("net_sales", "order_count", 2)} AS avg_order_value,
  {exact("net_profit", "gross_sales")} AS profit_margin,
  COALESCE(units_returned, 0) AS units_returned, COALESCE(returns_amount, 0) AS returns_amount,
  {exact("COALESCE(returns_amount, 0)", "gross_sales")} AS returns_rate,
  {exact("gross_sales", "total_gross")} AS share_of_total
FROM monthly_sales s
  LEFT JOIN monthly_returns r ON s.calendar_year = r.calendar_year
    AND s.month_of_year = r.month_of_year AND s.channel = r.channel
  LEFT JOIN monthly_total t ON s.calendar_year = t.calendar_year
    AND s.month_of_year = t.month_of_year"""
CTES["mart_product_analytics"] = f"""
SELECT item_key, item_id, product_name, brand, category, item_class, manufacturer, size, color,
  current_price, wholesale_cost, COALESCE(units_sold, 0) AS units_sold,
  COALESCE(gross_revenue, 0) AS gross_revenue, COALESCE(net_revenue, 0) AS net_revenue,
  COALESCE(net_profit, 0) AS net_profit, avg_sales_price,
  COALESCE(distinct_customers, 0) AS distinct_customers,
  COALESCE(units_returned, 0) AS units_returned, COALESCE(returns_amount, 0) AS returns_amount,
  {exact("COALESCE(units_returned, 0)", "units_sold")} AS returns_rate,
  tc.channel AS top_channel,
  RANK() OVER (ORDER BY COALESCE(s.gross_revenue, 0) DESC) AS rank_by_revenue,
  RANK() OVER (PARTITION BY category ORDER BY COALESCE(s.gross_revenue, 0) DESC)
    AS rank_in_category
FROM items LEFT JOIN item_sales s ON item_key = s.item_sk
  LEFT JOIN item_returns r ON item_key = r.item_sk
  LEFT JOIN item_top_channel tc ON item_key = tc.item_sk
WHERE is_current = 1"""
CTES["mart_customer_360"] = """
SELECT customer_key, customer_id, customer_name, email_address, city, state, zip, country, gender,
  marital_status, education_status, credit_rating, income_lower_bound, income_upper_bound,
  is_preferred_customer, first_purchase_date_key, last_purchase_date_key,
  CAST(last_purchase_date AS VARCHAR) AS last_purchase_date, recency_days, frequency,
  lifetime_value, lifetime_units, channels_used, r_score, f_score, m_score,
  CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_code,
  CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champion'
    WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal'
    WHEN r_score >= 4 AND f_score <= 2 THEN 'New'
    WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
    WHEN r_score = 1 THEN 'Lost'
    WHEN r_score IS NULL THEN 'Inactive' ELSE 'Potential' END AS segment,
  pc.channel AS preferred_channel
FROM customers LEFT JOIN rfm ON customer_key = rfm.customer_sk
  LEFT JOIN preferred_channel pc ON customer_key = pc.customer_sk"""

EVENT_AT = "date_trunc('second', ts)"
CTES["run_log"] = f"""
SELECT 'run-' || user_id || '-' || event_type AS step_run,
  'batch-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id,
  CASE event_id % 4 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold' ELSE 'dq' END
    AS layer,
  event_type AS step,
  CASE event_id % 3 WHEN 0 THEN 'started' WHEN 1 THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN event_id % 3 <> 0 THEN user_id END AS rows_in,
  CASE WHEN event_id % 3 = 1 THEN user_id END AS rows_out,
  {EVENT_AT} AS started_at,
  CASE WHEN event_id % 3 <> 0 THEN {EVENT_AT} + to_seconds(event_id % 60) END AS ended_at,
  CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 60 AS DOUBLE) END AS duration_sec,
  'spark' AS tool, 'event ' || event_id AS message
FROM events"""
CTES["run_state"] = """
SELECT * EXCLUDE (rn)
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY step_run ORDER BY
    COALESCE(ended_at, started_at) DESC, status <> 'started' DESC, batch_id DESC, layer DESC,
    step DESC, status DESC, rows_in DESC NULLS LAST, rows_out DESC NULLS LAST, started_at DESC,
    ended_at DESC NULLS LAST, duration_sec DESC NULLS LAST, message DESC) AS rn FROM run_log)
WHERE rn = 1"""
CTES["dq_result"] = """
SELECT 'dq-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id,
  CASE event_id % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS suite,
  'table_' || (user_id % 10) AS table_name, event_type AS expectation,
  CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS success, props AS observed_value,
  CAST(date_trunc('day', ts) AS TIMESTAMP) AS run_at
FROM events"""
CTES["perf_log"] = f"""
SELECT 'perf-' || (user_id % 8) AS run_id,
  CASE WHEN event_id % 2 = 0 THEN 'before' ELSE 'after' END AS phase, event_type AS query_name,
  event_id AS iteration, CAST(value AS DECIMAL(10,3)) AS duration_sec, user_id AS rows_returned,
  {EVENT_AT} AS started_at
FROM events"""
CTES["medians"] = """
SELECT query_name, phase,
  SUM(duration_sec) * CASE WHEN COUNT(*) = 2 THEN 0.5 ELSE 1.0 END AS median_sec
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_name, phase ORDER BY duration_sec) AS rn,
    COUNT(*) OVER (PARTITION BY query_name, phase) AS cnt FROM perf_log)
WHERE rn IN ((cnt + 1) // 2, (cnt + 2) // 2) GROUP BY 1, 2"""
CTES["phases"] = """
SELECT query_name, MAX(CASE WHEN phase = 'before' THEN median_sec END) AS b,
  MAX(CASE WHEN phase = 'after' THEN median_sec END) AS a
FROM medians GROUP BY 1"""


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def doubles(columns: list[str]) -> str:
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns) + ")"


SALE_MONEY = [f for f in SALE_FIELDS if is_money(f)]
RETURN_MONEY = [f for f in RETURN_FIELDS if is_money(f)]


def whole(columns: list[str], source: str, where: str = "") -> str:
    listed = [f"CAST({c} AS DOUBLE) AS {c}" if is_money(c) else c for c in columns]
    return f"SELECT {', '.join(listed)} FROM {source} {where}"


LINEAGE_COLUMNS = ["_batch_id", "_ingested_at", "_source_file"]
STAGED_SALES = ["channel", *SALE_FIELDS, *LINEAGE_COLUMNS]
STAGED_RETURNS = ["channel", *RETURN_FIELDS, *LINEAGE_COLUMNS]
SALES_FACT = ["channel", *SALE_FIELDS, "_batch_id"]
RETURNS_FACT = ["channel", *RETURN_FIELDS, "_batch_id"]

SQL: dict[str, str] = {}

SQL["bronze_lineage"] = (
    f"SELECT * REPLACE ({stamp('o_orderdate')} AS o_orderdate), {LINEAGE.format('orders.parquet')} "
    "FROM orders"
)
SQL["bronze_row_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
    for t in (
        "region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations"
    ).split()
)
SQL["dim_channel"] = """
SELECT channel_key, channel_code, channel_name, sales_lines
FROM (VALUES (1, 'store', 'Store'), (2, 'catalog', 'Catalog'), (3, 'web', 'Web'))
    AS seed (channel_key, channel_code, channel_name)
  LEFT JOIN (SELECT channel, COUNT(*) AS sales_lines FROM sales GROUP BY 1)
    ON channel_code = channel"""
for _channel in CHANNELS:
    _where = f"WHERE channel = '{_channel}'"
    SQL[f"stg_{_channel}_sales"] = whole(STAGED_SALES, "staged_sales", _where)
    SQL[f"stg_{_channel}_returns"] = whole(STAGED_RETURNS, "staged_returns", _where)
SQL["int_sales_tagged"] = whole([*STAGED_SALES, "_anomaly_reason"], "tagged_sales")
SQL["int_returns_tagged"] = whole([*STAGED_RETURNS, "_anomaly_reason"], "tagged_returns")
SQL["fact_sales"] = whole(SALES_FACT, "sales")
SQL["fact_returns"] = whole(RETURNS_FACT, "returns")
BROKEN = "WHERE _anomaly_reason IS NOT NULL"
SQL["fact_sales_anomalies"] = whole(["_anomaly_reason", *SALES_FACT], "tagged_sales", BROKEN)
SQL["fact_returns_anomalies"] = whole(["_anomaly_reason", *RETURNS_FACT], "tagged_returns", BROKEN)
SQL["anomaly_breakdown"] = f"""
SELECT 'fact_sales__anomalies' AS source_table, _anomaly_reason, COUNT(*) AS cnt
FROM tagged_sales {BROKEN} GROUP BY 2
UNION ALL SELECT 'fact_returns__anomalies', _anomaly_reason, COUNT(*)
FROM tagged_returns {BROKEN} GROUP BY 2"""
SQL["dim_customer"] = "SELECT * FROM customers"
SQL["dim_date"] = (
    "SELECT * REPLACE (CAST(calendar_date AS VARCHAR) AS calendar_date) FROM dates"
)
SQL["dim_item"] = (
    "SELECT * REPLACE (CAST(current_price AS DOUBLE) AS current_price, "
    "CAST(wholesale_cost AS DOUBLE) AS wholesale_cost, "
    "CAST(rec_start_date AS VARCHAR) AS rec_start_date, "
    "CAST(rec_end_date AS VARCHAR) AS rec_end_date) FROM items"
)
SQL["dim_store"] = "SELECT * FROM stores"
SQL["dim_promotion"] = "SELECT * FROM promotions"
SQL["fact_inventory"] = "SELECT * FROM stock"

DAY_MONEY = ["gross_sales", "discount_amount", "tax_amount", "net_sales", "net_profit"]
MONTH_MONEY = ["gross_sales", "net_sales", "net_profit"]
ITEM_MONEY = ["gross_revenue", "net_revenue", "net_profit"]
SQL["daily_sales"] = f"SELECT {doubles(DAY_MONEY)} FROM daily_sales"
SQL["daily_returns"] = f"SELECT {doubles(['returns_amount'])} FROM daily_returns"
SQL["monthly_sales"] = f"SELECT {doubles(MONTH_MONEY)} FROM monthly_sales"
SQL["monthly_returns"] = f"SELECT {doubles(['returns_amount'])} FROM monthly_returns"
SQL["item_sales"] = f"SELECT {doubles(ITEM_MONEY)} FROM item_sales"
SQL["item_returns"] = f"SELECT {doubles(['returns_amount'])} FROM item_returns"
SQL["item_top_channel"] = "SELECT * FROM item_top_channel"
SQL["customer_sales"] = f"SELECT {doubles(['lifetime_value'])} FROM customer_sales"
SQL["preferred_channel"] = "SELECT * FROM preferred_channel"
SQL["date_anchor"] = "SELECT CAST(today AS VARCHAR) AS today FROM date_anchor"
SQL["rfm_scores"] = """
SELECT customer_sk, recency_days, frequency, CAST(lifetime_value AS DOUBLE) AS lifetime_value,
  r_score, f_score, m_score FROM rfm"""
SQL["channel_share"] = f"""
SELECT calendar_year, month_of_year, channel, CAST(gross_sales AS DOUBLE) AS gross_sales,
  {exact("gross_sales", "SUM(gross_sales) OVER (PARTITION BY calendar_year, month_of_year)")}
    AS share_of_total
FROM monthly_sales"""

SQL["mart_sales_performance"] = (
    f"SELECT {doubles([*DAY_MONEY, 'returns_amount', 'net_revenue'])} FROM mart_sales_performance"
)
SQL["mart_channel_comparison"] = (
    f"SELECT {doubles([*MONTH_MONEY, 'returns_amount'])} FROM mart_channel_comparison"
)
SQL["mart_product_analytics"] = (
    f"SELECT {doubles([*ITEM_MONEY, 'returns_amount', 'current_price', 'wholesale_cost'])} "
    "FROM mart_product_analytics"
)
SQL["mart_customer_360"] = f"SELECT {doubles(['lifetime_value'])} FROM mart_customer_360"

SQL["annual_sales_by_channel"] = f"""
SELECT calendar_year, channel, CAST({money("net_paid")} AS DOUBLE) AS revenue,
  {total("quantity")} AS units, COUNT(*) AS line_count
FROM sales JOIN dates ON sold_date_sk = date_key GROUP BY 1, 2"""
SQL["top_25_customers"] = f"""
SELECT customer_id, customer_name, CAST({money("net_paid")} AS DOUBLE) AS lifetime_value,
  COUNT(DISTINCT channel) AS channels_used
FROM sales JOIN customers ON customer_sk = customer_key GROUP BY 1, 2
ORDER BY {money("net_paid")} DESC, 1, 2 LIMIT 25"""
SQL["sales_by_category"] = f"""
SELECT category, CAST({money("net_paid")} AS DOUBLE) AS revenue,
  COUNT(DISTINCT customer_sk) AS unique_customers
FROM sales JOIN items ON item_sk = item_key WHERE is_current = 1 GROUP BY 1"""
SQL["daily_sales_one_month"] = f"""
SELECT CAST(calendar_date AS VARCHAR) AS calendar_date, channel, {total("quantity")} AS units,
  CAST({money("net_paid")} AS DOUBLE) AS revenue
FROM sales JOIN dates ON sold_date_sk = date_key
WHERE calendar_year = 2001 AND month_of_year = 1 GROUP BY 1, 2"""


def brand_rates(min_units: int) -> str:
    sold, back = total("quantity"), f"COALESCE({total('return_quantity')}, 0)"
    return f"""
SELECT brand, {sold} AS units_sold, {back} AS units_returned, {exact(back, sold)} AS returns_rate
FROM sales s JOIN items ON s.item_sk = item_key
  LEFT JOIN returns r ON s.item_sk = r.item_sk AND sale_order_id = return_order_id
WHERE is_current = 1 GROUP BY 1 HAVING SUM(quantity) > {min_units}"""


SQL["returns_rate_by_brand"] = brand_rates(1000)
SQL["returns_rate_of_big_brands"] = brand_rates(30000)
_bucketed = [f"CAST({c} AS DOUBLE) AS {c}" if is_money(c) else c for c in SALES_FACT]
SQL["fact_sales_bucketed"] = f"""
SELECT {", ".join(_bucketed)},
  CAST((sold_date_sk - (SELECT MIN(sold_date_sk) - 365 FROM sales)) // 365 AS INTEGER)
    AS date_bucket
FROM sales"""

SQL["recent_runs"] = f"""
SELECT batch_id, layer, step, status, rows_in, rows_out, {stamp("started_at")} AS started_at,
  duration_sec, tool
FROM run_state ORDER BY run_state.started_at DESC, batch_id, step, status, layer,
  rows_in NULLS FIRST, rows_out NULLS FIRST, duration_sec NULLS FIRST LIMIT 50"""
SQL["run_log_state"] = f"""
SELECT * REPLACE ({stamp("started_at")} AS started_at, {stamp("ended_at")} AS ended_at)
FROM run_state"""
SQL["dq_latest"] = f"""
SELECT suite, table_name, expectation, success, observed_value, {stamp("run_at")} AS run_at
FROM dq_result WHERE batch_id = (SELECT batch_id FROM dq_result ORDER BY run_at DESC LIMIT 1)"""
SILVER_TABLES = {
    "dim_customer": "customers",
    "dim_item": "items",
    "dim_date": "dates",
    "dim_store": "stores",
    "fact_sales": "sales",
    "fact_returns": "returns",
    "fact_inventory": "stock",
    "fact_sales__anomalies": f"(SELECT * FROM tagged_sales {BROKEN})",
    "fact_returns__anomalies": f"(SELECT * FROM tagged_returns {BROKEN})",
}
MARTS = (
    "mart_sales_performance mart_customer_360 mart_product_analytics mart_channel_comparison"
).split()
SQL["layer_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, CAST(NULL AS VARCHAR) AS error "
    f"FROM {source}"
    for name, source in {**SILVER_TABLES, **{m: m for m in MARTS}}.items()
)
_summed = ["gross_sales", "net_sales", "net_profit", "returns_amount"]
SQL["sales_summary"] = f"""
SELECT channel, {total("units_sold")} AS units_sold, {total("order_count")} AS order_count,
  {", ".join(f"CAST({money(c)} AS DOUBLE) AS {c}" for c in _summed)}
FROM mart_sales_performance GROUP BY 1"""
SQL["top_products"] = """
SELECT item_id, product_name, brand, category, units_sold,
  CAST(gross_revenue AS DOUBLE) AS gross_revenue, returns_rate, top_channel, rank_by_revenue
FROM mart_product_analytics ORDER BY rank_by_revenue, item_key LIMIT 20"""
SQL["segment_summary"] = f"""
SELECT segment, COUNT(*) AS customers,
  CAST(CAST({ratio(money("lifetime_value"), "COUNT(lifetime_value)")} AS DECIMAL(15,2)) AS DOUBLE)
    AS avg_ltv,
  CAST(CAST({ratio(total("frequency"), "COUNT(frequency)")} AS DECIMAL(10,2)) AS DOUBLE)
    AS avg_frequency,
  CAST({total("recency_days")} // NULLIF(COUNT(recency_days), 0) AS INTEGER) AS avg_recency_days
FROM mart_customer_360 WHERE segment IS NOT NULL GROUP BY 1"""
SQL["perf_runs"] = f"""
SELECT run_id, MAX(CASE WHEN phase = 'before' THEN 1 ELSE 0 END) AS has_before,
  MAX(CASE WHEN phase = 'after' THEN 1 ELSE 0 END) AS has_after,
  {stamp("MIN(started_at)")} AS first_at, COUNT(*) AS row_count
FROM perf_log GROUP BY 1"""
SQL["perf_compare"] = f"""
SELECT query_name, CAST(CAST(b AS DECIMAL(10,3)) AS DOUBLE) AS before_sec,
  CAST(CAST(a AS DECIMAL(10,3)) AS DOUBLE) AS after_sec,
  CAST(CAST(b - a AS DECIMAL(10,3)) AS DOUBLE) AS delta_sec,
  CAST(CAST({ratio("b", "a")} AS DECIMAL(10,2)) AS DOUBLE) AS speedup_x,
  CASE WHEN CAST({ratio("b", "a")} AS DECIMAL(10,2)) >= 1.10 THEN 'ok'
    WHEN CAST({ratio("b", "a")} AS DECIMAL(10,2)) < 0.90 THEN 'bad' ELSE '' END AS verdict
FROM phases"""
SQL["perf_raw"] = f"""
SELECT run_id, phase, query_name, iteration, CAST(duration_sec AS DOUBLE) AS duration_sec,
  rows_returned, {stamp("started_at")} AS started_at
FROM perf_log WHERE run_id = 'perf-3'"""


# --- data quality: one SELECT per check ------------------------------------------------


def count_check(
    name: str, source: str, column: str, kind: str, elements: str, bad: str, mostly: float = 1.0
) -> str:
    seen = f"COUNT(*) FILTER (WHERE {elements})"
    wrong = f"COUNT(*) FILTER (WHERE {elements} AND {bad})"
    return (
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{kind}' AS expectation, "
        f"{seen} AS element_count, {wrong} AS unexpected_count, CASE WHEN {wrong} = 0 OR "
        f"CAST({seen} - {wrong} AS DOUBLE) / NULLIF({seen}, 0) >= {mostly} "
        f"THEN 1 ELSE 0 END AS success FROM {source} x"
    )


def _null(name: str, source: str, *columns: str) -> list[str]:
    return [count_check(name, source, c, "not_null", "TRUE", f"{c} IS NULL") for c in columns]


def _repeat(name: str, source: str, *columns: str) -> list[str]:
    return [
        count_check(
            name,
            source,
            c,
            "unique",
            f"{c} IS NOT NULL",
            f"{c} IN (SELECT {c} FROM {source} GROUP BY 1 HAVING COUNT(*) > 1)",
        )
        for c in columns
    ]


def _key(name: str, source: str, column: str) -> list[str]:
    return _null(name, source, column) + _repeat(name, source, column)


def _bad(name: str, source: str, kind: str, column: str, bad: str, mostly=1.0, where="TRUE") -> str:
    elements = f"{where} AND {column} IS NOT NULL"
    return count_check(name, source, column, kind, elements, bad, mostly)


def _orphan(name: str, source: str, column: str, parent: str) -> str:
    bad = f"{column} NOT IN ({parent})"
    return count_check(name, source, column, "references", f"{column} IS NOT NULL", bad)


def _values(name: str, source: str, column: str, *allowed) -> list[str]:
    listed = ", ".join(map(repr, allowed))
    return [_bad(name, source, "in_set", column, f"{column} NOT IN ({listed})")]


def _range(name: str, source: str, column: str, bad: str, mostly=1.0, where="TRUE") -> list[str]:
    return [_bad(name, source, "between", column, bad, mostly, where)]


def _own(function, tables: dict[str, str]):
    """The same, with a table's source looked up by its name."""
    return lambda name, *rest, **more: function(name, tables[name], *rest, **more)


RAW_SOURCES = {
    "store_sales": "(SELECT item_sk AS ss_item_sk, sale_order_id AS ss_ticket_number, "
    "quantity AS ss_quantity, sales_price AS ss_sales_price FROM sale_lines "
    "WHERE channel = 'store')",
    "catalog_sales": "(SELECT item_sk AS cs_item_sk, sale_order_id AS cs_order_number "
    "FROM sale_lines WHERE channel = 'catalog')",
    "web_sales": "(SELECT item_sk AS ws_item_sk, sale_order_id AS ws_order_number "
    "FROM sale_lines WHERE channel = 'web')",
    "inventory": "(SELECT item_sk AS inv_item_sk, warehouse_sk AS inv_warehouse_sk, "
    "date_sk AS inv_date_sk FROM raw_stock)",
    "customer": "(SELECT customer_key AS c_customer_sk, customer_id AS c_customer_id FROM customers)",
    "customer_address": "(SELECT n_nationkey AS ca_address_sk FROM nation)",
    "customer_demographics": "(SELECT DISTINCT c_custkey % 7 AS cd_demo_sk FROM customer)",
    "date_dim": "(SELECT date_key AS d_date_sk, calendar_year AS d_year FROM dates)",
    "time_dim": "(SELECT DISTINCT hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS t_time_sk "
    "FROM events)",
    "item": "(SELECT p_partkey AS i_item_sk FROM part)",
    "promotion": "(SELECT DISTINCT l_partkey % 20 AS p_promo_sk FROM lineitem)",
    "store": "(SELECT s_suppkey AS s_store_sk FROM supplier)",
}
SILVER_SOURCES = {
    **SILVER_TABLES,
    "dim_promotion": "promotions",
    "dim_channel": "(SELECT unnest([1, 2, 3]) AS channel_key, "
    "unnest(['store', 'catalog', 'web']) AS channel_code)",
}
GOLD_SOURCES = {m: m for m in MARTS}
SEGMENT_NAMES = ("Champion", "Loyal", "New", "At Risk", "Lost", "Inactive", "Potential")


def bronze_expectations() -> list[str]:
    null, repeat, span = (_own(f, RAW_SOURCES) for f in (_null, _repeat, _range))
    return [
        *null("customer", "c_customer_sk"),
        *repeat("customer", "c_customer_sk", "c_customer_id"),
        *null("store_sales", "ss_item_sk", "ss_ticket_number"),
        *span("store_sales", "ss_quantity", "ss_quantity NOT BETWEEN 0 AND 1000", 0.999),
        *span("store_sales", "ss_sales_price", "ss_sales_price NOT BETWEEN 0 AND 100000", 0.999),
        *null("catalog_sales", "cs_item_sk", "cs_order_number"),
        *null("web_sales", "ws_item_sk", "ws_order_number"),
        *repeat("date_dim", "d_date_sk"),
        *null("date_dim", "d_date_sk"),
        *span("date_dim", "d_year", "d_year NOT BETWEEN 1900 AND 2100"),
        *repeat("item", "i_item_sk"),
        *repeat("store", "s_store_sk"),
    ]


def silver_expectations() -> list[str]:
    null, repeat, span, values = (
        _own(f, SILVER_SOURCES) for f in (_null, _repeat, _range, _values)
    )
    return [
        *null("fact_sales", "item_sk", "sold_date_sk"),
        *values("fact_sales", "channel", *CHANNELS),
        *span("fact_sales", "quantity", "quantity NOT BETWEEN 1 AND 1000"),
        *span("fact_sales", "sales_price", "sales_price NOT BETWEEN 0 AND 100000", 0.999),
        *null("fact_returns", "item_sk"),
        *values("fact_returns", "channel", *CHANNELS),
        *span("fact_returns", "return_quantity", "return_quantity NOT BETWEEN 1 AND 1000"),
        *null("dim_customer", "customer_key"),
        *repeat("dim_customer", "customer_key"),
        *null("dim_item", "item_key"),
        *repeat("dim_item", "item_key"),
        *null("dim_date", "date_key"),
        *repeat("dim_date", "date_key"),
        *span("dim_date", "calendar_year", "calendar_year NOT BETWEEN 1900 AND 2100"),
        *repeat("dim_store", "store_key"),
    ]


def gold_expectations() -> list[str]:
    null, repeat, span, values = (_own(f, GOLD_SOURCES) for f in (_null, _repeat, _range, _values))
    return [
        *null("mart_sales_performance", "date_key"),
        *values("mart_sales_performance", "channel", *CHANNELS),
        *span("mart_sales_performance", "units_sold", "units_sold < 1"),
        *null("mart_customer_360", "customer_key"),
        *repeat("mart_customer_360", "customer_key"),
        *values("mart_customer_360", "segment", *SEGMENT_NAMES),
        *repeat("mart_product_analytics", "item_key"),
        *span("mart_product_analytics", "returns_rate", "returns_rate NOT BETWEEN 0 AND 1", 0.99),
        *values("mart_channel_comparison", "channel", *CHANNELS),
        *span("mart_channel_comparison", "share_of_total", "share_of_total NOT BETWEEN 0 AND 1", 0.99),
    ]


def bronze_build() -> list[str]:
    null, key = (_own(f, RAW_SOURCES) for f in (_null, _key))
    return [
        *null("store_sales", "ss_item_sk", "ss_ticket_number"),
        *null("catalog_sales", "cs_item_sk", "cs_order_number"),
        *null("web_sales", "ws_item_sk", "ws_order_number"),
        *null("inventory", "inv_item_sk", "inv_warehouse_sk", "inv_date_sk"),
        *key("customer", "c_customer_sk"),
        *key("customer", "c_customer_id"),
        *key("customer_address", "ca_address_sk"),
        *key("customer_demographics", "cd_demo_sk"),
        *key("date_dim", "d_date_sk"),
        *key("time_dim", "t_time_sk"),
        *key("item", "i_item_sk"),
        *key("promotion", "p_promo_sk"),
        *key("store", "s_store_sk"),
    ]


def silver_build() -> list[str]:
    null, key, span, values, orphan = (
        _own(f, SILVER_SOURCES) for f in (_null, _key, _range, _values, _orphan)
    )
    return [
        *key("dim_customer", "customer_key"),
        *null("dim_customer", "customer_id"),
        *values("dim_customer", "is_preferred_customer", 0, 1),
        *key("dim_item", "item_key"),
        *null("dim_item", "item_id"),
        *values("dim_item", "is_current", 0, 1),
        *key("dim_date", "date_key"),
        *span("dim_date", "calendar_year", "calendar_year NOT BETWEEN 1900 AND 2100"),
        *key("dim_store", "store_key"),
        *key("dim_promotion", "promo_key"),
        *null("fact_sales", "channel", "item_sk", "sold_date_sk"),
        *values("fact_sales", "channel", *CHANNELS),
        orphan("fact_sales", "item_sk", "SELECT item_key FROM items"),
        orphan("fact_sales", "sold_date_sk", "SELECT date_key FROM dates"),
        *span("fact_sales", "quantity", "quantity < 1"),
        *null("fact_returns", "channel", "item_sk"),
        *values("fact_returns", "channel", *CHANNELS),
        orphan("fact_returns", "item_sk", "SELECT item_key FROM items"),
        *null("fact_inventory", "item_sk", "warehouse_sk", "date_sk"),
        *null("fact_sales__anomalies", "_anomaly_reason"),
        *values(
            "fact_sales__anomalies",
            "_anomaly_reason",
            "missing_item_sk",
            "missing_order_id",
            "missing_sold_date",
            "non_positive_quantity",
            "negative_sales_price",
            "negative_net_paid",
        ),
        *null("fact_returns__anomalies", "_anomaly_reason"),
        *values(
            "fact_returns__anomalies",
            "_anomaly_reason",
            "missing_item_sk",
            "missing_order_id",
            "missing_returned_date",
            "non_positive_quantity",
            "negative_return_amt",
        ),
        *key("dim_channel", "channel_key"),
        *null("dim_channel", "channel_code"),
        *values("dim_channel", "channel_code", *CHANNELS),
    ]


def gold_build() -> list[str]:
    null, key, span, values, orphan = (
        _own(f, GOLD_SOURCES) for f in (_null, _key, _range, _values, _orphan)
    )
    return [
        *null("mart_sales_performance", "date_key", "channel"),
        orphan("mart_sales_performance", "date_key", "SELECT date_key FROM dates"),
        *values("mart_sales_performance", "channel", *CHANNELS),
        *span("mart_sales_performance", "units_sold", "units_sold < 1"),
        *key("mart_customer_360", "customer_key"),
        *values("mart_customer_360", "segment", *SEGMENT_NAMES),
        *span("mart_customer_360", "r_score", "r_score NOT BETWEEN 1 AND 5"),
        *key("mart_product_analytics", "item_key"),
        *null("mart_product_analytics", "rank_by_revenue"),
        *span("mart_product_analytics", "returns_rate", "returns_rate NOT BETWEEN 0 AND 1"),
        *null("mart_channel_comparison", "channel"),
        *values("mart_channel_comparison", "channel", *CHANNELS),
        *span("mart_channel_comparison", "share_of_total", "share_of_total NOT BETWEEN 0 AND 1"),
    ]


SQL["dq_suite_bronze"] = " UNION ALL ".join(bronze_expectations())
SQL["dq_suite_silver"] = " UNION ALL ".join(silver_expectations())
SQL["dq_suite_gold"] = " UNION ALL ".join(gold_expectations())
SQL["build_tests_bronze"] = " UNION ALL ".join(bronze_build())
SQL["build_tests_silver"] = " UNION ALL ".join(silver_build())
SQL["build_tests_gold"] = " UNION ALL ".join(gold_build())
SQL["dq_result_rows"] = f"""
SELECT 'driver' AS batch_id, 'silver' AS suite, table_name, expectation, success,
  column_name || ': ' || unexpected_count || ' of ' || element_count || ' unexpected'
    AS observed_value,
  '2026-01-01 00:00:00' AS run_at
FROM ({SQL["dq_suite_silver"]})"""


LOADED = {
    **{f"{c}_sales": f"sale_lines WHERE channel = '{c}'" for c in CHANNELS},
    **{f"{c}_returns": f"return_lines WHERE channel = '{c}'" for c in CHANNELS},
    "customer": "customer",
    "customer_address": "nation",
    "customer_demographics": "(SELECT DISTINCT c_custkey % 7 FROM customer)",
    "household_demographics": "(SELECT DISTINCT c_custkey % 10 FROM customer)",
    "income_band": "(SELECT DISTINCT c_custkey % 5 FROM customer)",
    "item": "part",
    "store": "supplier",
    "date_dim": "dates",
    "time_dim": RAW_SOURCES["time_dim"],
    "promotion": RAW_SOURCES["promotion"],
    "inventory": "raw_stock",
}
SQL["bronze_from_files"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, COUNT(*) AS row_count FROM {source}"
    for table, source in LOADED.items()
)
SQL["customer_from_file"] = """
SELECT CAST(c_custkey AS INTEGER) AS c_customer_sk,
  'CUST' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS c_customer_id,
  CASE WHEN c_custkey % 29 <> 28 THEN split_part(c_name, '#', 1) END AS c_first_name,
  CASE WHEN c_custkey % 17 = 0 THEN '"' || split_part(c_name, '#', 2) || '" | jr'
    ELSE split_part(c_name, '#', 2) END AS c_last_name,
  CASE WHEN c_custkey % 37 = 36 THEN NULL WHEN c_acctbal > 5000 THEN 'Y'
    WHEN c_acctbal > 4000 THEN 'y' ELSE 'N' END AS c_preferred_cust_flag,
  CAST(1940 + c_custkey % 60 AS INTEGER) AS c_birth_year
FROM customer"""

SQL["quoted_breaks_from_file"] = """
SELECT CAST(doc_id AS INTEGER) AS r_reason_sk, source AS r_reason_id,
  NULLIF(rtrim(text, ' '), '') AS r_reason_desc
FROM documents"""


def full_run_sql() -> str:
    """The run's steps: rows loaded and built, and whether each suite passes."""
    steps = [
        f"SELECT 'bronze' AS layer, 'load_{table}' AS step, 'success' AS status, "
        f"COUNT(*) AS rows_in, COUNT(*) AS rows_out FROM {source}"
        for table, source in LOADED.items()
    ]
    built = [("silver", [*SILVER_SOURCES.values()]), ("gold", MARTS)]
    for layer, sources in built:
        counts = " + ".join(f"(SELECT COUNT(*) FROM {source})" for source in sources)
        steps.append(f"SELECT '{layer}', 'build_{layer}', 'success', NULL, {counts}")
    for layer in ("bronze", "silver", "gold"):
        for step, suite in (("tests", "build_tests"), ("dq", "dq_suite")):
            steps.append(
                f"SELECT 'dq', '{step}_{layer}', CASE WHEN passed THEN 'success' ELSE 'failed' END, "
                f"NULL, CASE WHEN passed THEN checks END FROM (SELECT MIN(success) = 1 AS passed, "
                f"COUNT(*) AS checks FROM ({SQL[f'{suite}_{layer}']}))"
            )
    return f"SELECT 'driver' AS batch_id, * FROM ({' UNION ALL '.join(steps)})"


SQL["full_run_steps"] = full_run_sql()


_CUSTOMER = """(SELECT customer_key AS c_customer_sk, customer_id AS c_customer_id,
  first_name || ' ' AS c_first_name FROM customers)"""
_ITEM = """(SELECT item_key AS i_item_sk, item_id AS i_item_id, item_class_id AS i_class_id,
  CAST(NULL AS INTEGER) AS i_manufact_id FROM items)"""

SQL["dq_not_null"] = " UNION ALL ".join(
    _null("sales", "tagged_sales", "item_sk", "sale_order_id", "sold_date_sk", "customer_sk", "quantity")
    + _null("returns", "tagged_returns", "item_sk", "return_order_id", "returned_date_sk", "return_amt")
)
SQL["dq_unique"] = " UNION ALL ".join(
    _repeat("customer", _CUSTOMER, "c_customer_sk", "c_customer_id", "c_first_name")
    + _repeat("item", _ITEM, "i_item_sk", "i_item_id")
    + _repeat("sales", "tagged_sales", "sale_order_id")
)
SQL["dq_in_set"] = " UNION ALL ".join(
    [
        _bad("sales", "tagged_sales", "in_set", "channel", "channel NOT IN ('store', 'catalog', 'web')"),
        _bad("sales", "tagged_sales", "in_set", "quantity", "quantity NOT IN (1, 2, 3)"),
        _bad("item", _ITEM, "in_set", "i_manufact_id", "i_manufact_id NOT IN (1)"),
        _bad("item", _ITEM, "in_set", "i_class_id", "i_class_id NOT IN (0, 1, 2)"),
    ]
)
SQL["dq_range"] = " UNION ALL ".join(
    [
        _bad("sales", "tagged_sales", "between", "quantity", "quantity < 1"),
        _bad("sales", "tagged_sales", "between", "quantity", "quantity > 40"),
        _bad("sales", "tagged_sales", "between", "sales_price", "sales_price NOT BETWEEN 0 AND 100000"),
        _bad("sales", "tagged_sales", "between", "net_paid", "net_paid < 0", where="channel = 'web'"),
        _bad("returns", "tagged_returns", "between", "return_amt", "return_amt < 0"),
        _bad("returns", "tagged_returns", "between", "return_quantity", "return_quantity NOT BETWEEN 1 AND 20"),
    ]
)
SQL["dq_mostly"] = " UNION ALL ".join(
    [
        _bad("sales", "tagged_sales", "between", "sales_price", "sales_price NOT BETWEEN 0 AND 100000", 0.999),
        _bad("sales", "tagged_sales", "between", "quantity", "quantity NOT BETWEEN 1 AND 1000", 0.9999),
        _bad("sales", "tagged_sales", "in_set", "channel", "channel = 'catalog'", 0.6),
        _bad("returns", "tagged_returns", "between", "return_amt", "return_amt < 0", 0.99),
    ]
)
SQL["dq_relationships"] = " UNION ALL ".join(
    [
        _orphan("fact_sales", "sales", "item_sk", "SELECT item_key FROM items"),
        _orphan("fact_sales", "sales", "sold_date_sk", "SELECT date_key FROM dates"),
        _orphan("fact_sales", "sales", "item_sk", "SELECT item_key FROM items WHERE is_current = 1"),
        _orphan("fact_returns", "returns", "item_sk", "SELECT item_key FROM items"),
        _orphan("fact_returns", "returns", "returning_customer_sk", "SELECT customer_key FROM customers"),
    ]
)


_totals = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice * 1e-9 END"
_fifth = "ceil(5.0 * CAST(ROW_NUMBER() OVER (ORDER BY {}) AS DOUBLE) / COUNT(*) OVER ())"
SQL["quintile_with_nulls"] = f"""
SELECT o_orderkey, CAST({_fifth.format("price ASC NULLS FIRST, o_orderkey")} AS INTEGER) AS by_price,
  CAST({_fifth.format("day ASC NULLS FIRST, o_orderkey")} AS INTEGER) AS by_day
FROM (SELECT o_orderkey, {_totals} AS price,
  CASE WHEN o_orderkey % 5 <> 1 THEN CAST(o_orderdate AS DATE) END AS day FROM orders)"""
SQL["daily_sales_tuned"] = SQL["daily_sales_one_month"]
SQL["published_versions"] = """
SELECT 'fact_sales' AS table_name, COUNT(*) AS row_count FROM sales
UNION ALL SELECT 'fact_sales_unbucketed', COUNT(*) FROM sales
UNION ALL SELECT 'dim_date', COUNT(*) FROM dates
UNION ALL SELECT 'dim_date_unbucketed', COUNT(*) FROM dates"""
SQL["hashed_join"] = """
SELECT s.channel, COUNT(*) AS pairs, CAST(SUM(return_quantity) AS BIGINT) AS units_returned
FROM sales s JOIN returns r ON s.item_sk = r.item_sk AND sale_order_id = return_order_id
GROUP BY 1"""
TIMED = (
    "annual_sales_by_channel top_25_customers sales_by_category daily_sales_one_month "
    "returns_rate_by_brand"
).split()
SQL["timed_queries"] = " UNION ALL ".join(
    f"SELECT '{name}' AS query_name, 'before' AS phase, {n} AS iteration, "
    f"COUNT(*) AS rows_returned, 1 AS took_time FROM ({SQL[name]})"
    for name in TIMED
    for n in (1, 2)
)
SQL["gate_steps"] = f"""
SELECT 'dq_' || suite AS step, CASE WHEN bad = 0 THEN 'success' ELSE 'failed' END AS status,
  bad AS failed_checks, checks
FROM (SELECT 'keys' AS suite, COUNT(*) FILTER (WHERE success = 0) AS bad, COUNT(*) AS checks
    FROM ({" UNION ALL ".join(_repeat("item", _ITEM, "i_item_sk"))})
  UNION ALL SELECT 'versions', COUNT(*) FILTER (WHERE success = 0), COUNT(*)
    FROM ({" UNION ALL ".join(_repeat("item", _ITEM, "i_item_id") + _null("item", _ITEM, "i_item_id"))}))"""
SQL["dq_sample"] = """
SELECT 'orders' AS table_name, 'o_orderkey' AS column_name,
  CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END AS within, 1 AS success
FROM orders"""

SQL["monthly_sales_from_days"] = SQL["monthly_sales"]
SQL["unique_per_year"] = """
SELECT calendar_year, COUNT(DISTINCT sale_order_id) AS order_count,
  COUNT(DISTINCT customer_sk) AS unique_customers
FROM sales JOIN dates ON sold_date_sk = date_key GROUP BY 1"""
SQL["daily_sales_placed"] = SQL["daily_sales_one_month"]
SQL["returns_rate_placed"] = SQL["returns_rate_of_big_brands"]


def _per_bucket(table: str, rows: str, day: str) -> str:
    low, high = "(SELECT MIN(sold_date_sk) - 365 FROM sales)", "(SELECT MAX(sold_date_sk) + 365 FROM sales)"
    bucket = f"""CASE WHEN {day} BETWEEN {low} AND {high} THEN ({day} - {low}) // 365
  WHEN {day} IS NOT NULL THEN -1 END"""
    return f"""SELECT '{table}' AS table_name, CAST({bucket} AS INTEGER) AS date_bucket,
  COUNT(*) AS row_count FROM {rows} GROUP BY 2"""


SQL["placed_facts"] = " UNION ALL ".join(
    [
        _per_bucket("fact_sales", "sales", "sold_date_sk"),
        _per_bucket("fact_sales__anomalies", "(SELECT * FROM tagged_sales WHERE _anomaly_reason IS NOT NULL)", "sold_date_sk"),
        _per_bucket("fact_returns", "returns", "returned_date_sk"),
    ]
)
SQL["failed_load"] = """
SELECT 'first' AS load, 'loaded' AS outcome, 'first' AS rows_of, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'second', 'failed', 'first', COUNT(*) FROM customer"""


def _groups(table: str, rows: str, columns: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{columns}' AS columns,
  CAST(SUM(n) AS BIGINT) AS row_count, COUNT(*) AS exact_groups, 1 AS within
FROM (SELECT COUNT(*) AS n FROM {rows} GROUP BY {columns.replace(" ", ", ")})"""


SQL["column_group_counts"] = " UNION ALL ".join(
    [
        _groups("fact_sales", "sales", "channel sold_date_sk"),
        _groups("fact_sales", "sales", "item_sk sold_date_sk"),
        _groups("fact_returns", "returns", "item_sk return_order_id"),
        _groups("dim_date", "dates", "calendar_year month_of_year"),
        _groups("mart_sales_performance", "mart_sales_performance", "calendar_year month_of_year"),
    ]
)
SQL["analyzed_columns"] = " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
  COUNT(*) - COUNT({column}) AS nulls, CAST(MIN({column}) AS VARCHAR) AS low,
  CAST(MAX({column}) AS VARCHAR) AS high FROM {rows}"""
    for table, rows, columns in (
        ("fact_sales", "sales", "item_sk customer_sk sold_date_sk store_sk"),
        ("dim_item", "items", "item_key is_current"),
    )
    for column in columns.split()
)


def _thousand(column: str, kind: str, seen: str, bad: str) -> str:
    rows = "(SELECT * FROM orders ORDER BY md5('7|' || o_orderkey) LIMIT 1000)"
    return f"""SELECT 'orders' AS table_name, '{column}' AS column_name, '{kind}' AS expectation,
  COUNT(*) FILTER (WHERE {seen}) AS element_count, COUNT(*) FILTER (WHERE {bad}) AS unexpected_count,
  CASE WHEN COUNT(*) FILTER (WHERE {bad}) = 0 THEN 1 ELSE 0 END AS success
FROM (SELECT *, COUNT(*) OVER (PARTITION BY o_orderkey) AS same_order,
  COUNT(*) OVER (PARTITION BY o_custkey) AS same_customer FROM {rows})"""


SQL["dq_sample_rows"] = " UNION ALL ".join(
    [
        _thousand("o_orderkey", "unique", "o_orderkey IS NOT NULL", "same_order > 1"),
        _thousand("o_custkey", "unique", "o_custkey IS NOT NULL", "o_custkey IS NOT NULL AND same_customer > 1"),
        _thousand("o_totalprice", "between", "o_totalprice IS NOT NULL", "o_totalprice > 150000"),
        _thousand("o_orderstatus", "in_set", "o_orderstatus IS NOT NULL", "o_orderstatus <> 'F'"),
        _thousand(
            "o_custkey", "references", "o_custkey IS NOT NULL",
            "o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)",
        ),
    ]
)


def _needed(text: str) -> list[str]:
    """The parts ``text`` mentions, with the parts those mention, in defined order."""
    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & set(CTES) - found:
            found.add(name)
            todo.append(CTES[name])
    return [name for name in CTES if name in found]


def oracle_queries() -> dict[str, str]:
    result = {}
    for name, text in SQL.items():
        parts = [f"{part} AS ({CTES[part]})" for part in _needed(text)]
        result[name] = (f"WITH {', '.join(parts)} " if parts else "") + text.strip()
    return result
