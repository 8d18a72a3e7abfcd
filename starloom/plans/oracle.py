"""Independent ANSI-SQL statements (DuckDB dialect) for every registered query.

They run on the raw driver tables (views ``region nation customer supplier part orders
lineitem``) and rebuild the same chain in plain SQL: adapter -> first load of the star ->
query. Two rules keep them exact:

* no decimal division or AVG (DuckDB returns DOUBLE there): means and percentages are
  computed on integer cents with half-away-from-zero integer rounding;
* a surrogate key is the row number over the natural key, which is what the Spark load
  assigns on a first load.
"""

from __future__ import annotations

from starloom.plans.registry import (
    AS_OF_2,
    AS_OF_3,
    BULK,
    CHANGE_DAYS,
    CONFIG,
    EXACT,
    FACT_COLUMNS,
    MAILED_SINCE,
    PERIOD,
    RANGE,
    SECOND_LOAD,
)
from starloom.sources.adapter import COST_RATIO, STORE_TYPES
from starloom.sources.batches import (
    ABSENT_BELOW,
    COST_RISE,
    DEFAULT_ACTIVE_SINCE,
    DROPPED_FROM,
    EMAIL_DOMAIN,
    LONG_NAME,
    REPRICED_FROM,
    VARIANT_FROM,
)

AS_OF = CONFIG.as_of.isoformat()
AS_OF2 = AS_OF_2.isoformat()
AS_OF3 = AS_OF_3.isoformat()
GOLD = CONFIG.gold
SILVER = CONFIG.silver


# ---------------------------------------------------------------------------
# exact arithmetic helpers (SQL text)
# ---------------------------------------------------------------------------

def money(e: str) -> str:
    return f"CAST({e} AS DECIMAL(22,2))"


def cents(e: str) -> str:
    """An amount with at most two decimals as an integer number of cents."""
    return f"CAST(({e}) * 100 AS HUGEINT)"


def round_div(num: str, den: str) -> str:
    """num / den rounded half away from zero (integers in, integer out)."""
    return (f"(sign({num}) * sign({den}) * "
            f"((2 * abs({num}) + abs({den})) // (2 * abs({den}))))")


def hundredths(v: str) -> str:
    return f"CAST(CAST({v} AS DECIMAL(38,0)) * 0.01 AS DECIMAL(22,2))"


def mean(total: str, count: str) -> str:
    """ROUND(total / count, 2) of a 2-decimal total."""
    return hundredths(round_div(cents(total), f"CAST({count} AS HUGEINT)"))


def pct(part: str, whole: str, guard: bool = True) -> str:
    """ROUND(part / whole * 100, 2) of two 2-decimal amounts."""
    den = cents(whole)
    if guard:
        den = f"NULLIF({den}, 0)"
    return hundredths(round_div(f"({cents(part)} * 10000)", den))


# ---------------------------------------------------------------------------
# adapter + first load, as CTEs
# ---------------------------------------------------------------------------

_types = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(STORE_TYPES))
_item_order = ", ".join(
    f"{c} NULLS FIRST" for c in [
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ]
)

SOURCES = f"""
nat AS (
  SELECT n.n_nationkey, n.n_name, r.r_name
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
s_suppliers AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS supplier_id, s.s_name AS name,
         CAST(NULL AS VARCHAR) AS contact, n.n_name AS country,
         CAST(NULL AS INTEGER) AS lead_time_days
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
s_products AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS product_id, p.p_name AS name, p.p_type AS category,
         CAST(NULL AS VARCHAR) AS subcategory, p.p_brand AS brand,
         CAST(ROUND(CAST(p.p_retailprice AS DECIMAL(10,2)) * CAST('{COST_RATIO}' AS DECIMAL(3,2)), 2)
              AS DECIMAL(10,2)) AS cost,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS list_price,
         CAST(ps.primary_suppkey AS VARCHAR) AS supplier_id
  FROM part p
  LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS primary_suppkey FROM lineitem GROUP BY l_partkey) ps
    ON p.p_partkey = ps.l_partkey
),
s_customers AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS name,
         CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
         CAST(NULL AS VARCHAR) AS address, n.n_name AS city, CAST(NULL AS VARCHAR) AS state,
         CAST(NULL AS VARCHAR) AS zip, DATE '1992-01-01' AS created_date
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
s_stores AS (
  SELECT printf('STR%03d', n_nationkey) AS store_id,
         n_name || ' Store' AS name, n_name AS city, CAST(NULL AS VARCHAR) AS state,
         r_name AS region,
         CASE n_nationkey % {len(STORE_TYPES)} {_types} END AS type,
         CAST(NULL AS VARCHAR) AS manager, CAST(NULL AS DATE) AS open_date
  FROM nat
),
s_promotions AS (
  SELECT printf('PRM%03d', CAST(pct AS INTEGER)) AS promo_id,
         CAST(CAST(pct AS INTEGER) AS VARCHAR) || '% Off' AS name,
         'Percentage' AS type, pct AS discount_pct,
         CAST(NULL AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date, 'All' AS channel
  FROM (SELECT DISTINCT CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2)) AS pct
        FROM lineitem) WHERE pct > 0
),
s_orders AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id, CAST(o.o_custkey AS VARCHAR) AS customer_id,
         CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderstatus AS status,
         CAST(o.o_totalprice AS DECIMAL(12,2)) AS total_amount,
         printf('STR%03d', c.c_nationkey) AS store_id
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
s_order_items AS (
  SELECT printf('%d-%010d', l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_item_order}))
           AS item_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST((2 * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)
                    + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT))
                   AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS unit_price,
         CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2)) AS discount
  FROM lineitem
),
s_inventory AS (
  SELECT printf('STR%03d', s.s_nationkey) AS store_id,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         CAST(sum(CAST(l.l_quantity AS BIGINT)) AS INTEGER) AS quantity_on_hand,
         CAST(sum(CAST(l.l_quantity AS BIGINT)) // 5 AS INTEGER) AS reorder_point,
         max(CAST(l.l_shipdate AS DATE)) AS last_restock_date
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY s.s_nationkey, l.l_partkey
)"""

CUSTOMER_HASH = ("md5(concat_ws('|', coalesce(name, ''), coalesce(email, ''), "
                 "coalesce(address, ''), coalesce(city, ''), coalesce(state, '')))")

DIMS = f"""
spend AS (SELECT customer_id, sum(total_amount) AS total_spend FROM s_orders GROUP BY customer_id),
d_customer AS (
  SELECT CAST(row_number() OVER (ORDER BY c.customer_id) AS INTEGER) AS customer_key,
         c.customer_id, c.name AS customer_name, c.email, c.phone, c.address, c.city, c.state,
         c.zip AS zip_code,
         CASE WHEN sp.total_spend >= {GOLD} THEN 'Gold'
              WHEN sp.total_spend >= {SILVER} THEN 'Silver' ELSE 'Bronze' END AS customer_segment,
         DATE '{AS_OF}' AS effective_date, DATE '9999-12-31' AS expiry_date, true AS is_current,
         {CUSTOMER_HASH} AS row_hash
  FROM s_customers c LEFT JOIN spend sp ON c.customer_id = sp.customer_id
),
d_product AS (
  SELECT CAST(row_number() OVER (ORDER BY p.product_id) AS INTEGER) AS product_key,
         p.product_id, p.name AS product_name, p.category, p.subcategory, p.brand,
         p.cost AS cost_price, p.list_price, s.name AS supplier_name, s.country AS supplier_country,
         DATE '{AS_OF}' AS effective_date, DATE '9999-12-31' AS expiry_date, true AS is_current,
         md5(concat_ws('|', coalesce(p.name, ''), coalesce(p.category, ''),
             coalesce(p.subcategory, ''), coalesce(p.brand, ''),
             coalesce(CAST(p.cost AS VARCHAR), ''), coalesce(CAST(p.list_price AS VARCHAR), ''),
             coalesce(s.name, ''), coalesce(s.country, ''))) AS row_hash
  FROM s_products p LEFT JOIN s_suppliers s ON p.supplier_id = s.supplier_id
),
d_store AS (
  SELECT CAST(row_number() OVER (ORDER BY store_id) AS INTEGER) AS store_key, store_id,
         name AS store_name, city, state, region, type AS store_type, manager AS manager_name,
         open_date AS opening_date
  FROM s_stores
),
d_promotion AS (
  SELECT CAST(row_number() OVER (ORDER BY promo_id) AS INTEGER) AS promotion_key, promo_id,
         name AS promo_name, type AS promo_type, discount_pct, start_date, end_date, channel
  FROM s_promotions
),
fact AS (
  SELECT o.order_date AS full_date,
         CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS date_key,
         dc.customer_key, dc.customer_name, dc.customer_segment, dc.city, dc.state,
         dp.product_key, dp.product_name, dp.category, dp.brand,
         ds.store_key, ds.store_name, ds.region, ds.store_type,
         CASE WHEN i.discount > 0 THEN
           (SELECT promotion_key FROM d_promotion
             WHERE promo_id = (SELECT min(promo_id) FROM s_promotions)) END AS promotion_key,
         o.order_id,
         CAST(row_number() OVER (PARTITION BY o.order_id ORDER BY i.item_id) AS INTEGER) AS order_line_num,
         i.quantity, i.unit_price, p.cost AS unit_cost,
         CAST(ROUND(i.unit_price * i.quantity * i.discount * 0.01, 2) AS DECIMAL(10,2)) AS discount_amount,
         CAST(ROUND(i.unit_price * i.quantity - i.unit_price * i.quantity * i.discount * 0.01, 2)
              AS DECIMAL(12,2)) AS net_revenue,
         CAST(ROUND(i.unit_price * i.quantity - i.unit_price * i.quantity * i.discount * 0.01
                    - p.cost * i.quantity, 2) AS DECIMAL(12,2)) AS gross_profit,
         CAST(ROUND((i.unit_price * i.quantity - i.unit_price * i.quantity * i.discount * 0.01)
                    * 0.08, 2) AS DECIMAL(10,2)) AS tax_amount
  FROM s_order_items i
  JOIN s_orders o ON i.order_id = o.order_id
  JOIN d_customer dc ON o.customer_id = dc.customer_id
  JOIN d_product dp ON i.product_id = dp.product_id
  JOIN d_store ds ON o.store_id = ds.store_id
  JOIN s_products p ON i.product_id = p.product_id
)"""

PRELUDE = "WITH " + SOURCES.strip() + ",\n" + DIMS.strip()


def _with(body: str, extra_ctes: str = "") -> str:
    ctes = PRELUDE + (",\n" + extra_ctes.strip() if extra_ctes.strip() else "")
    return ctes + "\n" + body.strip()


# ---------------------------------------------------------------------------
# analytical queries
# ---------------------------------------------------------------------------

_lag_m = "lag(rev) OVER (ORDER BY y, mn)"
Q01 = _with(f"""
SELECT CAST(y AS SMALLINT) AS year_number, month_name,
       {money('rev')} AS monthly_revenue,
       {money('sum(rev) OVER (PARTITION BY y ORDER BY mn)')} AS ytd_revenue,
       {money(_lag_m)} AS prev_month_revenue,
       {pct(f'rev - {_lag_m}', _lag_m)} AS mom_growth_pct
FROM m""", """
m AS (SELECT year(full_date) AS y, month(full_date) AS mn,
             rpad(monthname(full_date), 9, ' ') AS month_name, sum(net_revenue) AS rev
      FROM fact GROUP BY 1, 2, 3)""")

Q02 = _with("""
SELECT region, category, total_revenue, category_rank FROM (
  SELECT region, category, CAST(rev AS DECIMAL(22,2)) AS total_revenue,
         CAST(rank() OVER (PARTITION BY region ORDER BY rev DESC NULLS FIRST) AS BIGINT) AS category_rank
  FROM cr) WHERE category_rank <= 5""", """
cr AS (SELECT region, category, sum(net_revenue) AS rev FROM fact GROUP BY 1, 2)""")

Q03 = _with("""
SELECT CAST(fp.cohort_month AS DATE) AS cohort_month,
       CAST(date_diff('month', fp.cohort_month, CAST(date_trunc('month', f.full_date) AS DATE)) AS INTEGER)
         AS months_since_first,
       CAST(count(DISTINCT f.customer_key) AS BIGINT) AS active_customers,
       CAST(sum(f.net_revenue) AS DECIMAL(22,2)) AS cohort_revenue
FROM fact f JOIN fp ON f.customer_key = fp.customer_key
GROUP BY 1, 2""", """
fp AS (SELECT customer_key, CAST(date_trunc('month', min(full_date)) AS DATE) AS cohort_month
       FROM fact GROUP BY 1)""")

Q04 = _with(f"""
SELECT customer_name, customer_segment, city, state,
       CAST(total_orders AS BIGINT) AS total_orders, CAST(total_items AS BIGINT) AS total_items,
       {money('rev')} AS total_revenue, {mean('rev', 'n')} AS avg_order_value,
       CAST(rank() OVER (ORDER BY rev DESC NULLS FIRST) AS BIGINT) AS revenue_rank
FROM g""", """
g AS (SELECT customer_name, customer_segment, city, state,
             count(DISTINCT order_id) AS total_orders, sum(quantity) AS total_items,
             sum(net_revenue) AS rev, count(net_revenue) AS n
      FROM fact GROUP BY 1, 2, 3, 4)""")

Q05 = _with(f"""
SELECT store_name, region, store_type, total_revenue, CAST(total_orders AS BIGINT) AS total_orders,
       {mean('rev', 'n')} AS avg_order_value,
       {mean('s_all', 'n_all')} AS avg_store_revenue,
       {hundredths(round_div(f"({cents('total_revenue')} * n_all - {cents('s_all')})", 'n_all'))}
         AS deviation_from_avg,
       CAST(rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS BIGINT) AS store_rank
FROM sr2""", """
sr AS (SELECT store_name, region, store_type, sum(net_revenue) AS rev,
              count(DISTINCT order_id) AS total_orders, count(net_revenue) AS n
       FROM fact GROUP BY 1, 2, 3),
sr2 AS (SELECT *, CAST(rev AS DECIMAL(22,2)) AS total_revenue,
               sum(CAST(rev AS DECIMAL(22,2))) OVER () AS s_all,
               CAST(count(*) OVER () AS HUGEINT) AS n_all
        FROM sr)""")

Q06 = _with("""
SELECT *, CAST(rank() OVER (ORDER BY profit_margin_pct DESC NULLS FIRST) AS BIGINT) AS margin_rank,
          CAST(rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS BIGINT) AS revenue_rank
FROM pm2""", f"""
pm AS (SELECT product_name, category, brand, sum(quantity) AS units, sum(net_revenue) AS rev,
              sum(gross_profit) AS prof, sum(discount_amount) AS disc
       FROM fact GROUP BY 1, 2, 3),
pm2 AS (SELECT product_name, category, brand, CAST(units AS BIGINT) AS units_sold,
               {money('rev')} AS total_revenue, {money('prof')} AS total_profit,
               {money('disc')} AS total_discount, {pct('prof', 'rev')} AS profit_margin_pct
        FROM pm)""")

Q07 = _with(f"""
SELECT week_start, {money('rev')} AS weekly_revenue, CAST(n_orders AS BIGINT) AS weekly_orders,
       {mean('sum(rev) OVER w4', 'count(rev) OVER w4')} AS moving_avg_4week,
       {money('sum(rev) OVER (PARTITION BY y ORDER BY w)')} AS ytd_revenue
FROM ws
WINDOW w4 AS (ORDER BY y, w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""", """
ws AS (SELECT year(full_date) AS y, weekofyear(full_date) AS w, min(full_date) AS week_start,
              sum(net_revenue) AS rev, count(DISTINCT order_id) AS n_orders
       FROM fact GROUP BY 1, 2)""")

Q08 = _with(f"""
SELECT customer_segment, CAST(cc AS BIGINT) AS customer_count, CAST(oo AS BIGINT) AS total_orders,
       {money('rev')} AS total_revenue, {mean('rev', 'n')} AS avg_order_value,
       {money('prof')} AS total_profit,
       {pct('rev', 'sum(rev) OVER ()', guard=False)} AS revenue_contribution_pct,
       {pct('prof', 'sum(prof) OVER ()', guard=False)} AS profit_contribution_pct
FROM sm""", """
sm AS (SELECT customer_segment, count(DISTINCT customer_key) AS cc, count(DISTINCT order_id) AS oo,
              sum(net_revenue) AS rev, count(net_revenue) AS n, sum(gross_profit) AS prof
       FROM fact GROUP BY 1)""")

Q09 = _with(f"""
SELECT coalesce(promo_name, 'No Promotion') AS promotion, coalesce(promo_type, 'N/A') AS promo_type,
       CAST(oo AS BIGINT) AS total_orders, CAST(units AS BIGINT) AS units_sold,
       {money('disc')} AS total_discount_given, {money('rev')} AS total_revenue,
       {money('prof')} AS total_profit, {mean('disc', 'nd')} AS avg_discount_per_order,
       {pct('rev', 'sum(rev) OVER ()', guard=False)} AS revenue_share_pct
FROM pm""", """
pm AS (SELECT p.promo_name, p.promo_type, count(DISTINCT f.order_id) AS oo, sum(f.quantity) AS units,
              sum(f.discount_amount) AS disc, sum(f.net_revenue) AS rev, sum(f.gross_profit) AS prof,
              count(f.discount_amount) AS nd
       FROM fact f LEFT JOIN d_promotion p ON f.promotion_key = p.promotion_key
       GROUP BY 1, 2)""")

_lag_q = "lag(rev) OVER (PARTITION BY category ORDER BY y, q)"
Q10 = _with(f"""
SELECT CAST(y AS SMALLINT) AS year_number, 'Q' || CAST(q AS VARCHAR) AS quarter_name, category,
       {money('rev')} AS quarterly_revenue, CAST(units AS BIGINT) AS units_sold,
       {money(_lag_q)} AS prev_quarter_revenue,
       {pct(f'rev - {_lag_q}', _lag_q)} AS qoq_growth_pct
FROM qc""", """
qc AS (SELECT year(full_date) AS y, quarter(full_date) AS q, category,
              sum(net_revenue) AS rev, sum(quantity) AS units
       FROM fact GROUP BY 1, 2, 3)""")

_days = f"(DATE '{AS_OF}' - last_purchase_date)"
Q11 = _with(f"""
SELECT customer_name, customer_segment, CAST(frequency AS BIGINT) AS frequency,
       {money('rev')} AS monetary, last_purchase_date,
       CAST({_days} AS INTEGER) AS days_since_last_purchase,
       CAST(ntile(3) OVER (ORDER BY {_days} ASC, customer_name, customer_segment) AS BIGINT) AS recency_score,
       CAST(ntile(3) OVER (ORDER BY frequency DESC, customer_name, customer_segment) AS BIGINT) AS frequency_score,
       CAST(ntile(3) OVER (ORDER BY rev DESC, customer_name, customer_segment) AS BIGINT) AS monetary_score
FROM rb""", """
rb AS (SELECT customer_name, customer_segment, count(DISTINCT order_id) AS frequency,
              sum(net_revenue) AS rev, max(full_date) AS last_purchase_date
       FROM fact GROUP BY 1, 2)""")


# ---------------------------------------------------------------------------
# loads, staging, refreshes, reports
# ---------------------------------------------------------------------------

CALENDAR_CTES = f"""
rng AS (
  SELECT make_date(CAST(least(year(min(o_orderdate)), {CONFIG.as_of.year}) AS BIGINT), 1, 1) AS lo,
         make_date(CAST(greatest(year(max(o_orderdate)), {CONFIG.as_of.year}) AS BIGINT), 12, 31) AS hi
  FROM orders),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
         FROM rng),
w_dim_date AS (
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       CAST(isodow(d) AS SMALLINT) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name,
       CAST(day(d) AS SMALLINT) AS day_of_month, CAST(dayofyear(d) AS SMALLINT) AS day_of_year,
       CAST(weekofyear(d) AS SMALLINT) AS week_of_year, CAST(month(d) AS SMALLINT) AS month_number,
       rpad(monthname(d), 9, ' ') AS month_name, CAST(quarter(d) AS SMALLINT) AS quarter_number,
       'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name, CAST(year(d) AS SMALLINT) AS year_number,
       CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS SMALLINT) AS fiscal_year,
       CAST(CASE WHEN month(d) IN (7, 8, 9) THEN 1 WHEN month(d) IN (10, 11, 12) THEN 2
                 WHEN month(d) IN (1, 2, 3) THEN 3 ELSE 4 END AS SMALLINT) AS fiscal_quarter,
       isodow(d) IN (6, 7) AS is_weekend, false AS is_holiday, CAST(NULL AS VARCHAR) AS holiday_name
FROM days)"""

DIM_DATE = "WITH " + CALENDAR_CTES.strip() + "\nSELECT * FROM w_dim_date"

DIM_CUSTOMER = _with("SELECT * FROM d_customer")
DIM_PRODUCT = _with("SELECT * FROM d_product")
DIM_STORE = _with("SELECT * FROM d_store")
DIM_PROMOTION = _with("SELECT * FROM d_promotion")

FACT_SALES = _with("""
SELECT date_key, customer_key, product_key, store_key, promotion_key, order_id, order_line_num,
       quantity, unit_price, unit_cost, discount_amount, net_revenue, gross_profit, tax_amount
FROM fact""")

FACT_INVENTORY = _with(f"""
SELECT dp.product_key, ds.store_key, CAST(strftime(DATE '{AS_OF}', '%Y%m%d') AS INTEGER) AS date_key,
       i.quantity_on_hand AS qty_on_hand, i.reorder_point, i.last_restock_date,
       DATE '{AS_OF}' AS snapshot_date
FROM s_inventory i
JOIN d_product dp ON i.product_id = dp.product_id
JOIN d_store ds ON i.store_id = ds.store_id""")


def _stage(name: str) -> str:
    return _with(f"SELECT * FROM s_{name}")


_email = f"lower(replace(c.name, '#', '.')) || '@{EMAIL_DOMAIN}'"
_REFRESH_CTES = f"""
active AS (SELECT DISTINCT customer_id FROM s_orders WHERE order_date >= DATE '{DEFAULT_ACTIVE_SINCE.isoformat()}'),
b2 AS (
  SELECT c.customer_id, c.name, CASE WHEN a.customer_id IS NOT NULL THEN {_email} ELSE c.email END AS email,
         c.address, c.city, c.state, a.customer_id IS NOT NULL AS changed
  FROM s_customers c LEFT JOIN active a ON c.customer_id = a.customer_id
),
b2h AS (SELECT customer_id, email, changed,
               {CUSTOMER_HASH} AS new_hash FROM b2),
n_first AS (SELECT count(*) AS n FROM d_customer),
closed AS (
  SELECT d.customer_key, d.customer_id, d.customer_name, d.email, d.phone, d.address, d.city, d.state,
         d.zip_code, d.customer_segment, d.effective_date,
         CASE WHEN b.changed THEN DATE '{AS_OF2}' - INTERVAL 1 DAY ELSE d.expiry_date END AS expiry_date,
         CASE WHEN b.changed THEN false ELSE d.is_current END AS is_current, d.row_hash
  FROM d_customer d JOIN b2h b ON d.customer_id = b.customer_id
),
opened AS (
  SELECT CAST((SELECT n FROM n_first) + row_number() OVER (ORDER BY d.customer_id) AS INTEGER) AS customer_key,
         d.customer_id, d.customer_name, b.email, d.phone, d.address, d.city, d.state,
         d.zip_code, d.customer_segment, DATE '{AS_OF2}' AS effective_date,
         DATE '9999-12-31' AS expiry_date, true AS is_current, b.new_hash AS row_hash
  FROM d_customer d JOIN b2h b ON d.customer_id = b.customer_id
  WHERE b.changed
)"""

SCD2_REFRESH = _with("""
SELECT customer_key, customer_id, customer_name, email, phone, address, city, state, zip_code,
       customer_segment, effective_date, CAST(expiry_date AS DATE) AS expiry_date, is_current, row_hash
FROM closed UNION ALL SELECT * FROM opened""", _REFRESH_CTES)

SCD2_REFRESH_DEFERRED = _with("""
SELECT customer_key, customer_id, customer_name, email, phone, address, city, state, zip_code,
       customer_segment, effective_date, CAST(expiry_date AS DATE) AS expiry_date, is_current, row_hash
FROM closed""", _REFRESH_CTES)

SCD1_STORE_REFRESH = _with("""
SELECT store_key, store_id, store_name, city, state, region, store_type,
       'Manager of ' || store_name AS manager_name, opening_date
FROM d_store""")

# -- fuller second extracts; a key is changed if its hash differs -------------------------------

_SEGMENT = (f"CASE WHEN total_spend >= {GOLD} THEN 'Gold' WHEN total_spend >= {SILVER} THEN 'Silver' ELSE 'Bronze' END")
_MIXED = f"""
mailed AS (SELECT DISTINCT customer_id FROM s_orders WHERE order_date >= DATE '{DEFAULT_ACTIVE_SINCE.isoformat()}'),
extract2 AS (
  SELECT c.customer_id, c.name, CASE WHEN m.customer_id IS NOT NULL THEN {_email} ELSE c.email END AS email,
         CASE WHEN m.customer_id IS NULL AND c.email IS NULL THEN '000-' || c.customer_id ELSE c.phone END AS phone,
         c.address, c.city, c.state, c.zip AS zip_code, sp.total_spend
  FROM s_customers c LEFT JOIN mailed m ON m.customer_id = c.customer_id LEFT JOIN spend sp ON sp.customer_id = c.customer_id
  WHERE coalesce(sp.total_spend, 0) >= {ABSENT_BELOW}
  UNION ALL SELECT 'S' || supplier_id, name, NULL, NULL, NULL, country, NULL, NULL, NULL FROM s_suppliers),
e2 AS (SELECT *, {CUSTOMER_HASH} AS new_hash, {_SEGMENT} AS segment FROM extract2),
state2 AS (
  SELECT e2.*, d.customer_id IS NULL AS is_new, d.row_hash <> new_hash AS is_changed
  FROM e2 LEFT JOIN d_customer d ON d.customer_id = e2.customer_id),
closed2 AS (
  SELECT d.* REPLACE (CASE WHEN x.is_changed THEN DATE '{AS_OF2}' - 1 ELSE d.expiry_date END AS expiry_date,
                      CASE WHEN x.is_changed THEN false ELSE d.is_current END AS is_current)
  FROM d_customer d LEFT JOIN state2 x ON x.customer_id = d.customer_id)"""


def _opened(where: str, day: str, after: str) -> str:
    return f"""
SELECT CAST(({after}) + row_number() OVER (ORDER BY customer_id) AS INTEGER) AS customer_key, customer_id, name AS customer_name,
       email, phone, address, city, state, zip_code, segment AS customer_segment, DATE '{day}' AS effective_date,
       DATE '9999-12-31' AS expiry_date, true AS is_current, new_hash AS row_hash
FROM state2 WHERE {where}"""


_N1 = "SELECT count(*) FROM d_customer"
SCD2_CUSTOMER_MIXED = _with("SELECT * FROM closed2 UNION ALL " + _opened("is_new OR is_changed", AS_OF2, _N1), _MIXED)
SCD2_CUSTOMER_TWICE = _with(
    "SELECT * FROM closed2 UNION ALL " + _opened("is_new", AS_OF2, _N1) + " UNION ALL "
    + _opened("is_changed", AS_OF3, f"({_N1}) + (SELECT count(*) FROM state2 WHERE is_new)"), _MIXED)

_PRODUCT_HASH = ("md5(concat_ws('|', coalesce(name, ''), coalesce(category, ''), coalesce(subcategory, ''), coalesce(brand, ''), "
                 "coalesce(CAST(cost AS VARCHAR), ''), coalesce(CAST(list_price AS VARCHAR), ''), coalesce(sname, ''), coalesce(country, '')))")
_PRODUCTS2 = f"""
risen AS (
  SELECT product_id, name, category, subcategory, brand,
         CASE WHEN list_price >= {REPRICED_FROM} THEN CAST(round(cost * CAST('{COST_RISE}' AS DECIMAL(3,2)), 2) AS DECIMAL(10,2))
              ELSE cost END AS cost, list_price, supplier_id FROM s_products WHERE supplier_id IS NOT NULL
  UNION ALL
  SELECT 'N' || product_id, name || ' II', category, subcategory, brand, cost, list_price, supplier_id
  FROM s_products WHERE list_price >= {VARIANT_FROM}),
p2 AS (
  SELECT r.*, s.name AS sname, s.country FROM risen r LEFT JOIN s_suppliers s ON s.supplier_id = r.supplier_id),
pstate AS (
  SELECT h.*, d.product_id IS NULL AS is_new, d.row_hash <> h.new_hash AS is_changed
  FROM (SELECT *, {_PRODUCT_HASH} AS new_hash FROM p2) h LEFT JOIN d_product d ON d.product_id = h.product_id),
popened AS (
  SELECT CAST((SELECT count(*) FROM d_product) + row_number() OVER (ORDER BY product_id) AS INTEGER) AS product_key, *
  FROM pstate WHERE is_new OR is_changed)"""
SCD2_PRODUCT = _with(f"""
SELECT d.* REPLACE (CASE WHEN x.is_changed THEN DATE '{AS_OF2}' - 1 ELSE d.expiry_date END AS expiry_date,
                    CASE WHEN x.is_changed THEN false ELSE d.is_current END AS is_current)
FROM d_product d LEFT JOIN pstate x ON x.product_id = d.product_id
UNION ALL
SELECT product_key, product_id, name, category, subcategory, brand, cost, list_price, sname, country, DATE '{AS_OF2}',
       DATE '9999-12-31', true, new_hash FROM popened""", _PRODUCTS2)

SCD1_PROMOTION = _with(f"""
SELECT promotion_key, promo_id, CASE WHEN discount_pct < {DROPPED_FROM} THEN upper(promo_name) ELSE promo_name END AS promo_name,
       promo_type, discount_pct, start_date, end_date, channel FROM d_promotion
UNION ALL
SELECT CAST((SELECT count(*) FROM d_promotion) + row_number() OVER (ORDER BY 'WEB' || promo_id) AS INTEGER), 'WEB' || promo_id,
       promo_name, promo_type, discount_pct, start_date, end_date, 'Web' FROM d_promotion""")

SCD1_STORE_MIXED = _with(f"""
SELECT store_key, store_id, store_name, city, state, region, store_type,
       CASE WHEN store_type = 'Online' THEN manager_name ELSE 'Manager of ' || store_name END AS manager_name, opening_date
FROM d_store
UNION ALL
SELECT CAST((SELECT count(*) FROM d_store) + row_number() OVER (ORDER BY 'PUP' || store_id) AS INTEGER), 'PUP' || store_id,
       store_name, city, state, region, 'Pick-up', 'Manager of ' || store_name, DATE '{AS_OF2}'
FROM d_store WHERE store_type = 'Online'""")

# -- later loads of the facts ---------------------------------------------------------------------

_FACT = ", ".join(FACT_COLUMNS)
_LINES = PRELUDE.replace("         o.order_id,\n", "         o.order_id, i.item_id,\n") + ",\n"
assert _LINES.count("i.item_id,") == 1
APPEND_SALES = _LINES + f"""
late AS (
  SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY order_id ORDER BY quantity >= {BULK}, item_id) AS INTEGER) AS order_line_num)
  FROM fact)
SELECT {_FACT} FROM late"""

SNAPSHOT_TWO_DAYS = _with(" UNION ALL ".join(f"""
SELECT dp.product_key, ds.store_key, CAST(strftime(DATE '{day}', '%Y%m%d') AS INTEGER) AS date_key, i.quantity_on_hand AS qty_on_hand,
       DATE '{day}' AS snapshot_date, true AS own_key, true AS later_key
FROM s_inventory i JOIN d_product dp ON i.product_id = dp.product_id JOIN d_store ds ON i.store_id = ds.store_id"""
    for day in (AS_OF, AS_OF2)))

_SECOND = f"""{_PRODUCTS2.strip()},
mailed AS (SELECT DISTINCT customer_id FROM s_orders WHERE order_date >= DATE '{DEFAULT_ACTIVE_SINCE.isoformat()}'),
copened AS (
  SELECT d.customer_key AS old_key, CAST(({_N1}) + row_number() OVER (ORDER BY d.customer_id) AS INTEGER) AS new_key
  FROM d_customer d JOIN mailed USING (customer_id)),
kept_products AS (SELECT d.product_key FROM d_product d JOIN risen r ON r.product_id = d.product_id),
moved AS (
  SELECT f.* REPLACE (
    CASE WHEN full_date >= DATE '{SECOND_LOAD.isoformat()}' THEN coalesce(c.new_key, f.customer_key) ELSE f.customer_key END AS customer_key,
    CASE WHEN full_date >= DATE '{SECOND_LOAD.isoformat()}' THEN coalesce(p.product_key, f.product_key) ELSE f.product_key END AS product_key,
    CASE WHEN full_date >= DATE '{SECOND_LOAD.isoformat()}' THEN coalesce(p.cost, f.unit_cost) ELSE f.unit_cost END AS unit_cost,
    CASE WHEN full_date >= DATE '{SECOND_LOAD.isoformat()}' AND p.cost IS NOT NULL
         THEN CAST(ROUND(f.unit_price * f.quantity - f.unit_price * f.quantity * f.pct * 0.01 - p.cost * f.quantity, 2) AS DECIMAL(12,2))
         ELSE f.gross_profit END AS gross_profit)
  FROM fact f LEFT JOIN copened c ON c.old_key = f.customer_key
  LEFT JOIN d_product d ON d.product_key = f.product_key
  LEFT JOIN popened p ON p.product_id = d.product_id AND p.is_changed)"""
SECOND_LOAD_FACT = _LINES.replace("i.quantity, i.unit_price, p.cost AS unit_cost,", "i.quantity, i.unit_price, i.discount AS pct, p.cost AS unit_cost,") \
    + _SECOND + f"\nSELECT {_FACT} FROM moved"
# growth counts lines of current product versions only
SECOND_LOAD_Q10 = (_LINES.replace("i.quantity, i.unit_price, p.cost AS unit_cost,", "i.quantity, i.unit_price, i.discount AS pct, p.cost AS unit_cost,")
                   + _SECOND + """,
gone AS (SELECT d.product_key FROM d_product d JOIN popened p ON p.product_id = d.product_id AND p.is_changed),
qc AS (SELECT year(full_date) AS y, quarter(full_date) AS q, category, sum(net_revenue) AS rev, sum(quantity) AS units
       FROM moved WHERE product_key NOT IN (SELECT product_key FROM gone) GROUP BY 1, 2, 3)
""" + Q10[Q10.index("SELECT CAST(y AS SMALLINT)"):])

_BY_DAY = """
SELECT full_date, count(*) AS lines, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
       CAST(sum(net_revenue) AS DECIMAL(22,2)) AS revenue, CAST(sum(gross_profit) AS DECIMAL(22,2)) AS profit
FROM moved WHERE {} GROUP BY 1"""
SALES_IN_RANGE = SECOND_LOAD_FACT[:SECOND_LOAD_FACT.rindex("SELECT")] + _BY_DAY.format(
    f"full_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'")
SALES_IN_PERIOD = SECOND_LOAD_FACT[:SECOND_LOAD_FACT.rindex("SELECT")] + _BY_DAY.format(
    f"(CASE WHEN month(full_date) >= 7 THEN year(full_date) + 1 ELSE year(full_date) END) = {PERIOD[0]} "
    f"AND ((month(full_date) + 5) % 12) // 3 + 1 = {PERIOD[1]}")

SECOND_LOAD_KEYS = _with("""
SELECT (SELECT count(*) FROM fact) AS sales_rows, (SELECT count(*) FROM fact) AS sales_keys, 0::BIGINT AS keys_below_1,
       snapshot_rows, snapshot_rows AS snapshot_keys, 0::BIGINT AS lines_without_day
FROM (SELECT count(*) FILTER (dp.product_key IS NOT NULL) + count(*) FILTER (r.product_id IS NOT NULL) AS snapshot_rows
      FROM s_inventory i JOIN d_store ds ON i.store_id = ds.store_id LEFT JOIN d_product dp ON i.product_id = dp.product_id
      LEFT JOIN d_product r ON r.product_id = i.product_id)""")

FACT_KEYS = _with("""
SELECT (SELECT count(*) FROM fact) AS sales_rows, (SELECT count(*) FROM fact) AS sales_keys, 0::BIGINT AS keys_below_1,
       count(*) AS snapshot_rows, count(*) AS snapshot_keys, 0::BIGINT AS lines_without_day
FROM s_inventory i JOIN d_product dp ON i.product_id = dp.product_id JOIN d_store ds ON i.store_id = ds.store_id""")

# -- versions by date: late batches, sales bound as of their dates -------------------------------------

_SINCE = f"full_date >= DATE '{CHANGE_DAYS[1].isoformat()}'"
FACT_AS_OF = _LINES + f"""{_PRODUCTS2.strip()},
mailed AS (SELECT DISTINCT customer_id FROM s_orders WHERE order_date >= DATE '{DEFAULT_ACTIVE_SINCE.isoformat()}'),
copened AS (
  SELECT d.customer_key AS old_key, CAST(({_N1}) + row_number() OVER (ORDER BY d.customer_id) AS INTEGER) AS new_key
  FROM d_customer d JOIN mailed USING (customer_id)),
dated AS (
  SELECT f.* REPLACE (CASE WHEN {_SINCE} THEN coalesce(c.new_key, f.customer_key) ELSE f.customer_key END AS customer_key,
                      CASE WHEN {_SINCE} THEN coalesce(p.product_key, f.product_key) ELSE f.product_key END AS product_key)
  FROM fact f LEFT JOIN copened c ON c.old_key = f.customer_key
  LEFT JOIN d_product d ON d.product_key = f.product_key
  LEFT JOIN popened p ON p.product_id = d.product_id AND p.is_changed)
SELECT {_FACT} FROM dated"""

SCD2_LATE = _with("""
SELECT customer_id, name AS customer_name, email, city, seen AS effective_date,
       coalesce(lead(seen) OVER k - 1, DATE '9999-12-31') AS expiry_date, lead(seen) OVER k IS NULL AS is_current,
       new_hash AS row_hash, true AS own_key, true AS no_overlap
FROM began WINDOW k AS (PARTITION BY customer_id ORDER BY seen)""", _MIXED.strip() + f""",
mailed2 AS (SELECT DISTINCT customer_id FROM s_orders WHERE order_date >= DATE '{MAILED_SINCE.isoformat()}'),
batch2 AS (
  SELECT c.customer_id, c.name, CASE WHEN m.customer_id IS NOT NULL THEN {_email} ELSE c.email END AS email, c.address, c.city, c.state
  FROM s_customers c LEFT JOIN mailed2 m ON m.customer_id = c.customer_id),
seen AS (
  SELECT DATE '{AS_OF}' AS seen, customer_id, name, email, city, {CUSTOMER_HASH} AS new_hash FROM s_customers
  UNION ALL SELECT DATE '{AS_OF2}', customer_id, name, email, city, {CUSTOMER_HASH} FROM batch2
  UNION ALL SELECT DATE '{AS_OF3}', customer_id, name, email, city, new_hash FROM e2),
began AS (SELECT * FROM seen QUALIFY lag(new_hash) OVER (PARTITION BY customer_id ORDER BY seen) IS DISTINCT FROM new_hash)""")

# -- a dirty extract: what is set apart, and what the rest adds up to --------------------------------------

_DIRTY = f"""
x_customers AS (SELECT * REPLACE (CASE WHEN city LIKE 'A%' THEN NULL ELSE name END AS name) FROM s_customers),
x_products AS (SELECT * REPLACE (CASE WHEN brand LIKE '%1' THEN repeat(brand, {LONG_NAME}) ELSE brand END AS brand) FROM s_products),
x_orders AS (SELECT * FROM s_orders UNION ALL SELECT * FROM s_orders WHERE day(order_date) = 13),
x_items AS (SELECT * REPLACE (CASE WHEN quantity = 50 THEN 'X' || product_id ELSE product_id END AS product_id) FROM s_order_items),
b_customers AS (SELECT *, CASE WHEN name IS NULL THEN 'not_null:name' END AS broken FROM x_customers),
b_products AS (SELECT *, CASE WHEN length(brand) > 50 THEN 'length:brand' END AS broken FROM x_products),
b_orders AS (
  SELECT *, concat_ws(',', CASE WHEN customer_id NOT IN (SELECT customer_id FROM b_customers WHERE broken IS NULL) THEN 'fk:customers' END,
                           CASE WHEN count(*) OVER (PARTITION BY order_id) > 1 THEN 'unique_key' END) AS broken FROM x_orders),
b_items AS (
  SELECT *, concat_ws(',', CASE WHEN order_id NOT IN (SELECT order_id FROM b_orders WHERE broken = '') THEN 'fk:orders' END,
                           CASE WHEN product_id NOT IN (SELECT product_id FROM b_products WHERE broken IS NULL) THEN 'fk:products' END)
    AS broken FROM x_items),
b_inventory AS (
  SELECT *, CASE WHEN product_id NOT IN (SELECT product_id FROM b_products WHERE broken IS NULL) THEN 'fk:products' END AS broken
  FROM s_inventory),
b AS (
  SELECT 'customers' AS tbl, customer_id AS row_id, broken FROM b_customers
  UNION ALL SELECT 'products', product_id, broken FROM b_products
  UNION ALL SELECT 'orders', order_id, nullif(broken, '') FROM b_orders
  UNION ALL SELECT 'order_items', item_id, nullif(broken, '') FROM b_items
  UNION ALL SELECT 'inventory', store_id || '|' || product_id, broken FROM b_inventory
  UNION ALL SELECT 'suppliers', supplier_id, NULL FROM s_suppliers
  UNION ALL SELECT 'stores', store_id, NULL FROM s_stores
  UNION ALL SELECT 'promotions', promo_id, NULL FROM s_promotions)"""
QUARANTINE_REJECTED = _with("SELECT * FROM b WHERE broken IS NOT NULL", _DIRTY)
QUARANTINE_COUNTS = _with("""
SELECT tbl, count(*) FILTER (broken IS NULL) AS accepted, count(*) FILTER (broken IS NOT NULL) AS rejected FROM b GROUP BY tbl""", _DIRTY)
QUARANTINE_Q01 = _LINES + _DIRTY.strip() + """,
m AS (SELECT year(full_date) AS y, month(full_date) AS mn,
             rpad(monthname(full_date), 9, ' ') AS month_name, sum(net_revenue) AS rev
      FROM fact WHERE item_id IN (SELECT item_id FROM b_items WHERE broken = '') GROUP BY 1, 2, 3)
""" + Q01[Q01.index("SELECT CAST(y AS SMALLINT)"):]

# -- data quality on given tables ---------------------------------------------------------------

DQ_UNIQUE_LINES = """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
DQ_NOT_NULL_STORES = _with("""
SELECT store_id, array_to_string(list_filter([CASE WHEN store_id IS NULL THEN 'store_id' END, CASE WHEN state IS NULL THEN 'state' END,
  CASE WHEN region IS NULL THEN 'region' END, CASE WHEN manager IS NULL THEN 'manager' END], lambda x: x IS NOT NULL), ',') AS null_columns
FROM s_stores WHERE store_id IS NULL OR state IS NULL OR region IS NULL OR manager IS NULL""")
DQ_FK_IDLE = _with(f"""
SELECT customer_id, name FROM s_customers
WHERE customer_id NOT IN (SELECT customer_id FROM s_orders WHERE order_date >= DATE '{SECOND_LOAD.isoformat()}')""")
DQ_DOMAIN_NAMES = _with("""
SELECT 'name' AS "column", name AS value, 24 AS max_length FROM s_products WHERE length(name) > 24
UNION ALL SELECT 'brand', brand, 7 FROM s_products WHERE length(brand) > 7
UNION ALL SELECT 'product_id', product_id, 20 FROM s_products WHERE length(product_id) > 20""")
DQ_DEFAULT = _with("SELECT * REPLACE (CAST(0 AS DECIMAL(5,2)) AS discount) FROM s_order_items")
DQ_LOADCOUNT = _with("""
SELECT a AS actual, e AS expected, a = e AS ok
FROM (SELECT (SELECT count(*) FROM fact) AS a UNION ALL SELECT count(*) FROM fact WHERE discount_amount > 0),
     (SELECT count(*) AS e FROM lineitem)""")
DQ_ROWCOUNTS_ALL = _with(" UNION ALL ".join(
    f"SELECT '{layer}.{t}' AS tbl, count(*) AS row_count FROM s_{t}" for layer, tables in (
        ("public", ["suppliers", "products", "customers", "stores", "promotions", "orders", "order_items", "inventory"]),
        ("staging", ["customers", "orders"])) for t in tables))

DQ_SALES_SANITY = _with("""
SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(DISTINCT order_id) AS BIGINT) AS distinct_orders,
       CAST(count(DISTINCT customer_key) AS BIGINT) AS distinct_customers,
       CAST(count(DISTINCT product_key) AS BIGINT) AS distinct_products,
       CAST(count(DISTINCT store_key) AS BIGINT) AS distinct_stores,
       CAST(sum(net_revenue) AS DECIMAL(22,2)) AS total_revenue,
       CAST(sum(gross_profit) AS DECIMAL(22,2)) AS total_profit
FROM fact""")

DQ_INVENTORY_LISTING = _with(f"""
SELECT ds.store_name, dp.product_name, i.quantity_on_hand AS qty_on_hand, i.reorder_point,
       i.last_restock_date, DATE '{AS_OF}' AS snapshot_date
FROM s_inventory i
JOIN d_product dp ON i.product_id = dp.product_id
JOIN d_store ds ON i.store_id = ds.store_id""")

DQ_ROWCOUNTS = _with(" UNION ALL ".join(
    f"SELECT 'staging.{t}' AS tbl, CAST(count(*) AS BIGINT) AS row_count FROM s_{t}"
    for t in ["suppliers", "products", "customers", "stores", "promotions", "orders",
              "order_items", "inventory"]
))


def _violations_sql() -> str:
    """One row per declared rule (same names as ``quality.violations``) with its count."""
    from starloom.contracts import STAGING, WAREHOUSE

    staging = {n: f"s_{n}" for n in STAGING}
    warehouse = {
        "dim_date": "w_dim_date", "dim_customer": "d_customer", "dim_product": "d_product",
        "dim_store": "d_store", "dim_promotion": "d_promotion",
        "fact_sales": "w_fact_sales", "fact_inventory_snapshot": "w_fact_inventory",
    }
    parts = []

    def add(check: str, count_sql: str) -> None:
        parts.append(f"SELECT '{check}' AS check_name, CAST(({count_sql}) AS BIGINT) AS violations")

    for contracts, tables in ((STAGING, staging), (WAREHOUSE, warehouse)):
        for name, rel in tables.items():
            c = contracts[name]
            cond = " OR ".join(f"{x} IS NULL" for x in c.required) or "false"
            add(f"{name}.not_null", f"SELECT count(*) FROM {rel} WHERE {cond}")
            uniques = ([("unique_key", c.key)] if c.key else []) + [
                ("unique_" + "_".join(u), u) for u in c.unique]
            for label, cols in uniques:
                add(f"{name}.{label}", f"SELECT count(*) FROM (SELECT 1 FROM {rel} "
                                       f"GROUP BY {', '.join(cols)} HAVING count(*) > 1)")
            for child_cols, parent, parent_cols in c.foreign_keys:
                if parent not in tables:
                    continue
                nn = " AND ".join(f"x.{k} IS NOT NULL" for k in child_cols)
                eq = " AND ".join(f"p.{pk} = x.{ck}" for ck, pk in zip(child_cols, parent_cols))
                add(f"{name}.fk_{parent}", f"SELECT count(*) FROM {rel} x WHERE {nn} AND NOT EXISTS "
                                           f"(SELECT 1 FROM {tables[parent]} p WHERE {eq})")
            lens = [f"(SELECT count(*) FROM {rel} WHERE length({col}) > {n})"
                    for col, n in c.lengths.items()]
            add(f"{name}.length", " + ".join(lens) if lens else "0")
    extra = CALENDAR_CTES.strip() + ",\n" + f"""
w_fact_sales AS (SELECT row_number() OVER () AS sales_key, * FROM fact),
w_fact_inventory AS (
  SELECT row_number() OVER () AS inventory_snapshot_key, dp.product_key, ds.store_key,
         CAST(strftime(DATE '{AS_OF}', '%Y%m%d') AS INTEGER) AS date_key,
         i.quantity_on_hand AS qty_on_hand, i.reorder_point, i.last_restock_date,
         DATE '{AS_OF}' AS snapshot_date
  FROM s_inventory i
  JOIN d_product dp ON i.product_id = dp.product_id
  JOIN d_store ds ON i.store_id = ds.store_id)"""
    return _with("\nUNION ALL\n".join(parts), extra)


DQ_VIOLATIONS = _violations_sql()


def _dirty_violations_sql() -> str:
    """The source contracts' rules counted over the dirty extract."""
    from starloom.contracts import SOURCE

    rel = {n: f"s_{n}" for n in SOURCE} | {"customers": "x_customers", "products": "x_products", "orders": "x_orders", "order_items": "x_items"}
    parts = []
    for name, c in SOURCE.items():
        r = rel[name]
        rules = {"not_null": f"SELECT count(*) FROM {r} WHERE " + " OR ".join(f"{x} IS NULL" for x in c.required),
                 "length": "SELECT " + " + ".join(f"count(*) FILTER (length({x}) > {n})" for x, n in c.lengths.items()) + f" FROM {r}",
                 "unique_key": f"SELECT count(*) FROM (SELECT 1 FROM {r} GROUP BY {', '.join(c.key)} HAVING count(*) > 1)"}
        for cols, parent, parent_cols in c.foreign_keys:
            rules[f"fk_{parent}"] = f"SELECT count(*) FROM {r} WHERE {cols[0]} NOT IN (SELECT {parent_cols[0]} FROM {rel[parent]})"
        parts += [f"SELECT '{name}.{k}' AS check_name, CAST(({q}) AS BIGINT) AS violations" for k, q in rules.items()]
    return _with("\nUNION ALL\n".join(parts), _DIRTY)


DQ_VIOLATIONS_DIRTY = _dirty_violations_sql()


_DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
               "timestamp_ntz": "TIMESTAMP"}


def _decimal_outputs_as(duck_type: str, sql_by_name: dict[str, str]) -> dict[str, str]:
    """Wrap each statement so that its DECIMAL output columns come out as DOUBLE or as VARCHAR,
    matching the driver-facing Spark queries. The decimal columns are found by describing each statement
    against empty tables with the driver schemas (no data is read)."""
    import duckdb

    from starloom.contracts import DRIVER_SCHEMAS

    con = duckdb.connect()
    for name, schema in DRIVER_SCHEMAS.items():
        cols = ", ".join(f"{f.name} {_DUCK_TYPES[f.dataType.simpleString()]}" for f in schema.fields)
        con.execute(f"CREATE TABLE {name} ({cols})")
    out = {}
    for name, sql in sql_by_name.items():
        rel = con.sql(sql)
        decimals = [c for c, t in zip(rel.columns, rel.types) if str(t).startswith("DECIMAL")]
        if decimals:
            repl = ", ".join(f"CAST({c} AS {duck_type}) AS {c}" for c in decimals)
            out[name] = f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS exact_result"
        else:
            out[name] = sql
    con.close()
    return out


SQL_EXACT: dict[str, str] = {
    "q01_monthly_trend": Q01,
    "q02_category_rank_by_region": Q02,
    "q03_cohort": Q03,
    "q04_top_customers": Q04,
    "q05_store_vs_avg": Q05,
    "q06_product_margin": Q06,
    "q07_weekly_moving_avg": Q07,
    "q08_segment_share": Q08,
    "q09_promo_effect": Q09,
    "q10_quarterly_growth": Q10,
    "q11_rfm": Q11,
    "dim_date": DIM_DATE,
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_store": DIM_STORE,
    "dim_promotion": DIM_PROMOTION,
    "fact_sales": FACT_SALES,
    "fact_inventory_snapshot": FACT_INVENTORY,
    **{f"stage_{t}": _stage(t) for t in [
        "orders", "order_items", "products", "customers", "suppliers", "stores", "promotions",
        "inventory"]},
    "scd2_customer_refresh": SCD2_REFRESH,
    "scd2_customer_refresh_deferred": SCD2_REFRESH_DEFERRED,
    "scd1_store_refresh": SCD1_STORE_REFRESH,
    "scd2_customer_mixed_refresh": SCD2_CUSTOMER_MIXED,
    "scd2_customer_deferred_twice": SCD2_CUSTOMER_TWICE,
    "scd2_product_refresh": SCD2_PRODUCT,
    "scd1_promotion_refresh": SCD1_PROMOTION,
    "scd1_store_mixed_refresh": SCD1_STORE_MIXED,
    "append_sales_late_line": APPEND_SALES,
    "append_sales_partial_batch": APPEND_SALES,
    "snapshot_two_days": SNAPSHOT_TWO_DAYS,
    "second_load_fact_sales": SECOND_LOAD_FACT,
    "second_load_q01": Q01,
    "second_load_q07": Q07,
    "second_load_q10": SECOND_LOAD_Q10,
    "q05_bitmap": Q05,
    "q07_bitmap": Q07,
    "q09_bitmap": Q09,
    "load_rollback": SECOND_LOAD_FACT,
    "fact_sales_as_of": FACT_AS_OF,
    "scd2_late_batch": SCD2_LATE,
    "quarantine_rejected": QUARANTINE_REJECTED,
    "quarantine_counts": QUARANTINE_COUNTS,
    "quarantine_q01": QUARANTINE_Q01,
    "dq_violations_dirty": DQ_VIOLATIONS_DIRTY,
    "sales_in_range": SALES_IN_RANGE,
    "sales_in_period": SALES_IN_PERIOD,
    "second_load_keys": SECOND_LOAD_KEYS,
    "fact_keys": FACT_KEYS,
    "dq_unique_lines": DQ_UNIQUE_LINES,
    "dq_not_null_stores": DQ_NOT_NULL_STORES,
    "dq_fk_idle_customers": DQ_FK_IDLE,
    "dq_domain_names": DQ_DOMAIN_NAMES,
    "dq_default": DQ_DEFAULT,
    "dq_loadcount": DQ_LOADCOUNT,
    "dq_rowcounts_all": DQ_ROWCOUNTS_ALL,
    "dq_sales_sanity": DQ_SALES_SANITY,
    "dq_inventory_listing": DQ_INVENTORY_LISTING,
    "dq_rowcounts": DQ_ROWCOUNTS,
    "dq_violations": DQ_VIOLATIONS,
}

SQL: dict[str, str] = {
    **_decimal_outputs_as("DOUBLE", SQL_EXACT),
    **{f"{n}_exact": q for n, q in _decimal_outputs_as("VARCHAR", {n: SQL_EXACT[n] for n in EXACT}).items()},
}
