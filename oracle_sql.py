"""Independent DuckDB SQL for every registered query.

Each statement recomputes its answer from the raw driver tables (views
``customer nation region part orders lineitem``) with DuckDB's own
functions: the extracts, the cleaning, the de-duplication, the dimensions,
the fact and the reports. Decimal results that Spark computes with exact
decimal arithmetic are computed here on integer cents, so no DOUBLE
rounding can creep into the comparison.
"""
from __future__ import annotations

import re

# Fixed values shared with the Spark side (see starweave.sources.extracts).
CUTOFF = "1998-06-01"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def sk(x: str) -> str:
    return f"CAST(('0x' || substr(sha256({x}), 1, 15)) AS BIGINT)"


def to_date(x: str) -> str:
    return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"


def cents_pct(g: str, n: str) -> str:
    """round(g / n * 100, 2) HALF_UP from integer cents g, n (n <> 0)."""
    return (f"CAST(CAST(sign({g}) * sign({n}) * ((abs({g}) * 20000 + abs({n})) // (2 * abs({n}))) "
            f"AS DECIMAL(38,0)) * 0.01 AS DECIMAL(18,2))")


def exact_avg(s: str, c: str) -> str:
    """HALF_UP mean to 2 decimals from a decimal sum and a count."""
    h = f"CAST(({s}) * 100 AS HUGEINT)"
    return (f"CASE WHEN ({c}) > 0 THEN CAST(CAST((CASE WHEN {h} < 0 THEN -1 ELSE 1 END) * "
            f"((abs({h}) * 2 + ({c})) // (2 * ({c}))) AS DECIMAL(38,0)) * 0.01 AS DECIMAL(38,2)) END")


def money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DECIMAL(18,2))"


def amount(x: str) -> str:
    return f"CAST(round({x}, 2) AS DECIMAL(38,2))"


def bool_text(x: str) -> str:
    t = f"lower(trim({x}))"
    return (f"CASE WHEN {t} IN ('t', 'true', 'y', 'yes', '1') THEN true "
            f"WHEN {t} IN ('f', 'false', 'n', 'no', '0') THEN false END")


CUST_RAW = """cust_base AS (
  SELECT c.c_custkey AS k, ' c' || CAST(c.c_custkey AS VARCHAR) AS customer_id,
         lower(split_part(c.c_name, '#', 1)) AS first_name,
         split_part(c.c_name, '#', 2) || ' ' AS last_name,
         ' ' || replace(c.c_name, '#', '.') || '@Example.COM' AS email,
         '+1 (' || CAST(c.c_nationkey + 100 AS VARCHAR) || ') 555-' || CAST(c.c_custkey AS VARCHAR) AS phone,
         lower(n.n_name) AS city,
         ' ' || lower(r.r_name) AS state,
         'usa ' AS country,
         CAST(c.c_nationkey * 10 + c.c_custkey % 3 + 10000 AS VARCHAR) AS zip_code,
         lower(c.c_mktsegment) AS customer_segment,
         strftime(DATE '1992-01-01' + CAST(c.c_custkey % 1000 AS INTEGER), '%Y-%m-%d') AS registration_date,
         TIMESTAMP '2024-01-01 00:00:00' AS ingested_at,
         'CRM_SYSTEM' AS source_system, '20240101000000' AS batch_id
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
cust_raw AS (
  SELECT * EXCLUDE (k) REPLACE (
    CASE WHEN k % 79 = 0 THEN '  ' ELSE customer_id END AS customer_id,
    CASE WHEN k % 97 = 0 THEN NULL WHEN k % 83 = 0 THEN 'no-at-sign' ELSE email END AS email,
    CASE WHEN k % 73 = 0 THEN NULL ELSE state END AS state,
    CASE WHEN k % 89 = 0 THEN 'not a date' ELSE registration_date END AS registration_date)
  FROM cust_base)"""

PROD_RAW = """prod_base AS (
  SELECT p_partkey AS k, 'p' || CAST(p_partkey AS VARCHAR) AS product_id,
         ' ' || p_name AS product_name,
         lower(p_type) AS category,
         'size ' || CAST(p_size AS VARCHAR) AS sub_category,
         ' ' || p_brand || ' ' AS brand,
         CAST(CAST(((CAST(round(p_retailprice * 100) AS BIGINT) * 6 + 5) // 10) * 0.01 AS DECIMAL(12,2)) AS VARCHAR) AS unit_cost,
         CAST(CAST(CAST(round(p_retailprice * 100) AS BIGINT) * 0.01 AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
         'sku-' || CAST(p_partkey AS VARCHAR) AS sku,
         replace(p_brand, 'Brand#', 's') AS supplier_id,
         CASE WHEN p_size >= 10 THEN 'yes' ELSE 'N' END AS is_active,
         strftime(DATE '1990-01-01' + CAST(p_size * 7 AS INTEGER), '%Y-%m-%d') AS created_date,
         CAST(CAST(p_size * 0.125 AS DECIMAL(8,3)) AS VARCHAR) AS weight_kg,
         TIMESTAMP '2024-01-01 00:00:00' AS ingested_at,
         'ERP_SYSTEM' AS source_system, '20240101000000' AS batch_id
  FROM part),
prod_raw AS (
  SELECT * EXCLUDE (k) REPLACE (
    CASE WHEN k % 101 = 0 THEN ' ' ELSE product_id END AS product_id,
    CASE WHEN k % 71 = 0 THEN NULL ELSE product_name END AS product_name,
    CASE WHEN k % 67 = 0 THEN 'abc' WHEN k % 59 = 0 THEN '99999.00' WHEN k % 37 = 0 THEN '0' ELSE unit_cost END AS unit_cost,
    CASE WHEN k % 61 = 0 THEN '0.00' WHEN k % 41 = 0 THEN '123456789.999' ELSE unit_price END AS unit_price,
    CASE WHEN k % 53 = 0 THEN 'maybe' ELSE is_active END AS is_active,
    CASE WHEN k % 47 = 0 THEN '2024-02-30' ELSE created_date END AS created_date,
    CASE WHEN k % 43 = 0 THEN 'heavy' ELSE weight_kg END AS weight_kg)
  FROM prod_base)"""

ORD_RAW = """ord_base AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS line, ' o' || CAST(l.l_orderkey AS VARCHAR) AS order_id,
         'o' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_line_id,
         'c' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
         'p' || CAST(l.l_partkey AS VARCHAR) AS product_id,
         strftime(o.o_orderdate, '%Y-%m-%d') AS order_date,
         strftime(l.l_shipdate, '%Y-%m-%d') AS ship_date,
         CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) AS quantity,
         CAST(CAST(CASE WHEN CAST(l.l_quantity AS BIGINT) <> 0
                   THEN CAST(round(l.l_extendedprice * 100) AS BIGINT) // CAST(l.l_quantity AS BIGINT) END
                   * 0.01 AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
         CAST(CAST(l.l_discount AS DECIMAL(5,4)) AS VARCHAR) AS discount_pct,
         o.o_orderpriority AS payment_method,
         lower(l.l_linestatus) AS order_channel,
         o.o_orderstatus AS order_status,
         l.l_shipdate AS ingested_at,
         'ECOMMERCE_PLATFORM' AS source_system, '20240101000000' AS batch_id
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey),
ord_raw AS (
  SELECT * EXCLUDE (k, line) REPLACE (
    CASE WHEN k % 199 = 0 AND line = 1 THEN '  ' ELSE order_line_id END AS order_line_id,
    CASE WHEN k % 197 = 0 THEN NULL ELSE order_id END AS order_id,
    CASE WHEN k % 191 = 0 THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN k % 139 = 0 THEN NULL WHEN k % 151 = 0 THEN 'p999999999' ELSE product_id END AS product_id,
    CASE WHEN k % 181 = 0 THEN replace(order_date, '-', '/') ELSE order_date END AS order_date,
    CASE WHEN k % 179 = 0 THEN '2024-02-30' ELSE ship_date END AS ship_date,
    CASE WHEN k % 173 = 0 THEN 'abc' WHEN k % 167 = 0 THEN '0' WHEN k % 113 = 0 THEN '1.7' WHEN k % 109 = 0 THEN '2000000000' ELSE quantity END AS quantity,
    CASE WHEN k % 163 = 0 THEN '0.00' WHEN k % 137 = 0 THEN '123456789.999' WHEN k % 109 = 0 THEN '99999999.00' ELSE unit_price END AS unit_price,
    CASE WHEN k % 157 = 0 THEN 'x' ELSE discount_pct END AS discount_pct)
  FROM ord_base)"""

def reasons(*rules: tuple[str, str]) -> str:
    """Names of the failed rules, in order; a rule that is NULL has failed."""
    parts = ", ".join(f"CASE WHEN NOT coalesce({cond}, false) THEN '{name}' END" for name, cond in rules)
    return f"list_filter([{parts}], lambda x: x IS NOT NULL) AS reasons"


def parsed(column: str) -> tuple[str, str]:
    return f"bad_{column}", f"raw_{column} IS NULL OR {column} IS NOT NULL"



CUST_STD = f"""cust_typed AS (
  SELECT nullif(upper(trim(customer_id)), '') AS customer_id,
         {initcap('trim(first_name)')} AS first_name,
         {initcap('trim(last_name)')} AS last_name,
         nullif(concat_ws(' ', {initcap('trim(first_name)')}, {initcap('trim(last_name)')}), '') AS full_name,
         lower(trim(email)) AS email,
         regexp_replace(phone, '[^0-9+\\-]', '', 'g') AS phone,
         {initcap('trim(city)')} AS city,
         upper(trim(state)) AS state,
         upper(trim(country)) AS country,
         trim(zip_code) AS zip_code,
         upper(trim(customer_segment)) AS customer_segment,
         {to_date('registration_date')} AS registration_date, registration_date AS raw_registration_date,
         source_system, batch_id, ingested_at
  FROM cust_raw),
cust_std AS (
  SELECT *, {reasons(("missing_customer_id", "customer_id IS NOT NULL"), ("missing_email", "email IS NOT NULL"),
                     parsed("registration_date"))}
  FROM cust_typed)"""

CUST_SILVER = """cust_silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ingested_at DESC NULLS LAST,
      first_name ASC NULLS FIRST, last_name ASC NULLS FIRST, email ASC NULLS FIRST, phone ASC NULLS FIRST,
      city ASC NULLS FIRST, state ASC NULLS FIRST, country ASC NULLS FIRST, zip_code ASC NULLS FIRST,
      customer_segment ASC NULLS FIRST, registration_date ASC NULLS FIRST, source_system ASC NULLS FIRST,
      batch_id ASC NULLS FIRST) AS rn
    FROM cust_std WHERE customer_id IS NOT NULL)
  WHERE rn = 1 AND len(reasons) = 0)"""

PROD_STD = f"""prod_typed AS (
  SELECT nullif(upper(trim(product_id)), '') AS product_id,
         {initcap('trim(product_name)')} AS product_name,
         {initcap('trim(category)')} AS category,
         {initcap('trim(sub_category)')} AS sub_category,
         trim(brand) AS brand,
         upper(trim(sku)) AS sku,
         upper(trim(supplier_id)) AS supplier_id,
         TRY_CAST(unit_cost AS DECIMAL(10,2)) AS unit_cost,
         TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
         TRY_CAST(weight_kg AS DECIMAL(8,3)) AS weight_kg,
         {bool_text('is_active')} AS is_active,
         {to_date('created_date')} AS created_date,
         unit_cost AS raw_unit_cost, unit_price AS raw_unit_price, weight_kg AS raw_weight_kg, is_active AS raw_is_active,
         created_date AS raw_created_date,
         source_system, batch_id, ingested_at
  FROM prod_raw),
prod_std AS (
  SELECT *, {reasons(("missing_product_id", "product_id IS NOT NULL"), ("missing_product_name", "product_name IS NOT NULL"),
                     parsed("unit_cost"), parsed("unit_price"), parsed("weight_kg"), parsed("is_active"), parsed("created_date"),
                     ("non_positive_cost", "unit_cost > 0"), ("non_positive_price", "unit_price > 0"),
                     ("price_below_cost", "unit_price >= unit_cost"))}
  FROM prod_typed)"""

PROD_SILVER = f"""prod_silver AS (
  SELECT product_id, product_name, category, sub_category, brand, sku, supplier_id, unit_cost, unit_price,
         CASE WHEN unit_price <> 0 THEN {cents_pct('CAST((unit_price - unit_cost) * 100 AS BIGINT)', 'CAST(unit_price * 100 AS BIGINT)')} END AS gross_margin_pct,
         weight_kg, is_active, created_date, source_system, batch_id, ingested_at
  FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY ingested_at DESC NULLS LAST,
      product_name ASC NULLS FIRST, category ASC NULLS FIRST, sub_category ASC NULLS FIRST,
      brand ASC NULLS FIRST, sku ASC NULLS FIRST, supplier_id ASC NULLS FIRST, unit_cost ASC NULLS FIRST,
      unit_price ASC NULLS FIRST, weight_kg ASC NULLS FIRST, is_active ASC NULLS FIRST,
      created_date ASC NULLS FIRST, source_system ASC NULLS FIRST, batch_id ASC NULLS FIRST) AS rn
    FROM prod_std WHERE product_id IS NOT NULL)
  WHERE rn = 1 AND len(reasons) = 0)"""

ORD_STD = f"""ord_typed AS (
  SELECT upper(trim(order_id)) AS order_id,
         nullif(upper(trim(order_line_id)), '') AS order_line_id,
         upper(trim(customer_id)) AS customer_id,
         upper(trim(product_id)) AS product_id,
         {to_date('order_date')} AS order_date,
         {to_date('ship_date')} AS ship_date,
         CASE WHEN regexp_full_match(trim(quantity), '[+-]?[0-9]+') THEN TRY_CAST(quantity AS INTEGER) END AS quantity,
         TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
         TRY_CAST(discount_pct AS DECIMAL(5,4)) AS discount_pct,
         {initcap('trim(payment_method)')} AS payment_method,
         {initcap('trim(order_channel)')} AS order_channel,
         {initcap('trim(order_status)')} AS order_status,
         quantity AS raw_quantity, unit_price AS raw_unit_price, discount_pct AS raw_discount_pct,
         order_date AS raw_order_date, ship_date AS raw_ship_date,
         source_system, batch_id, ingested_at
  FROM ord_raw),
ord_std AS (
  SELECT order_id, order_line_id, customer_id, product_id, order_date, ship_date, quantity, unit_price,
         discount_pct, discount_amount, gross_revenue,
         {money('gross_revenue - discount_amount')} AS net_revenue,
         CAST(date_diff('day', order_date, ship_date) AS INTEGER) AS days_to_ship,
         payment_method, order_channel, order_status, source_system, batch_id, ingested_at,
         {reasons(("missing_order_line_id", "order_line_id IS NOT NULL"), ("missing_order_id", "order_id IS NOT NULL"),
                  ("missing_customer_id", "customer_id IS NOT NULL"), ("missing_product_id", "product_id IS NOT NULL"),
                  parsed("quantity"), parsed("unit_price"), parsed("discount_pct"), parsed("order_date"), parsed("ship_date"),
                  ("non_positive_quantity", "quantity > 0"), ("non_positive_price", "unit_price > 0"),
                  ("revenue_overflow", "gross_revenue IS NOT NULL"))}
  FROM (SELECT *, TRY_CAST(round(CAST(unit_price AS DECIMAL(20,2)) * CAST(quantity AS DECIMAL(10,0)) * CAST(discount_pct AS DECIMAL(5,4)), 2)
                         AS DECIMAL(18,2)) AS discount_amount,
                  TRY_CAST(CAST(unit_price AS DECIMAL(20,2)) * CAST(quantity AS DECIMAL(10,0)) AS DECIMAL(18,2)) AS gross_revenue
        FROM ord_typed))"""

ORD_TIEBREAK = """ingested_at DESC NULLS LAST, order_id ASC NULLS FIRST, customer_id ASC NULLS FIRST,
      product_id ASC NULLS FIRST, order_date ASC NULLS FIRST, ship_date ASC NULLS FIRST,
      quantity ASC NULLS FIRST, unit_price ASC NULLS FIRST, discount_pct ASC NULLS FIRST,
      payment_method ASC NULLS FIRST, order_channel ASC NULLS FIRST, order_status ASC NULLS FIRST,
      source_system ASC NULLS FIRST, batch_id ASC NULLS FIRST"""

def ord_silver(name: str = "ord_silver", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_line_id ORDER BY {ORD_TIEBREAK}) AS rn
    FROM ord_std WHERE order_line_id IS NOT NULL AND ({where}))
  WHERE rn = 1 AND len(reasons) = 0)"""


GEO_BK = "concat_ws('_', coalesce(country, ''), coalesce(state, ''), coalesce(city, ''))"

DIMS = f"""dim_customer AS (
  SELECT customer_id AS customer_bk, first_name, last_name, full_name, email, phone, city, state, country,
         zip_code, customer_segment, registration_date, {sk('customer_id')} AS customer_sk
  FROM cust_silver),
dim_product AS (
  SELECT product_id AS product_bk, product_name, category, sub_category, brand, sku, supplier_id, unit_cost,
         unit_price, gross_margin_pct, weight_kg, is_active, created_date, {sk('product_id')} AS product_sk
  FROM prod_silver),
dim_geography AS (
  SELECT min(city) AS city, min(state) AS state, min(country) AS country, min(zip_code) AS zip_code,
         geography_bk, {sk('geography_bk')} AS geography_sk
  FROM (SELECT *, {GEO_BK} AS geography_bk FROM cust_silver)
  GROUP BY geography_bk),
cal_days AS (
  SELECT CAST(unnest(generate_series(CAST(date_trunc('year', lo) AS DATE), make_date(year(hi), 12, 31),
                                     INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT least(min(order_date), min(ship_date)) AS lo, greatest(max(order_date), max(ship_date)) AS hi
        FROM ord_silver)),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name, CAST(month(d) AS INTEGER) AS month,
         strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_abbrev,
         CAST(week(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
         CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
         strftime(d, '%a') AS day_abbrev, dayofweek(d) IN (0, 6) AS is_weekend,
         NOT (dayofweek(d) IN (0, 6)) AS is_weekday, strftime(d, '%Y-%m') AS year_month,
         CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
         CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fiscal_year,
         'FQ' || CAST(((month(d) - 7 + 12) % 12) // 3 + 1 AS VARCHAR) AS fiscal_quarter
  FROM cal_days),
cust_keys AS (
  SELECT c.customer_bk, c.customer_sk, g.geography_sk
  FROM dim_customer c LEFT JOIN dim_geography g
    ON concat_ws('_', coalesce(c.country, ''), coalesce(c.state, ''), coalesce(c.city, '')) = g.geography_bk)"""

FACT = f"""fact_base AS (
  SELECT ck.customer_sk, dp.product_sk, od.date_key AS order_date_sk, sd.date_key AS ship_date_sk,
         ck.geography_sk, o.order_id, o.order_line_id, o.payment_method, o.order_channel, o.order_status,
         o.quantity, o.unit_price, dp.unit_cost, o.discount_pct, o.discount_amount, o.gross_revenue,
         o.net_revenue, {money('o.quantity * dp.unit_cost')} AS cogs, o.days_to_ship, o.order_date,
         o.source_system, o.batch_id
  FROM ord_silver o
  LEFT JOIN dim_date od ON o.order_date = od.full_date
  LEFT JOIN dim_date sd ON o.ship_date = sd.full_date
  LEFT JOIN cust_keys ck ON o.customer_id = ck.customer_bk
  LEFT JOIN dim_product dp ON o.product_id = dp.product_bk),
fact_p AS (SELECT *, {money('net_revenue - cogs')} AS gross_profit FROM fact_base),
fact AS (
  SELECT customer_sk, product_sk, order_date_sk, ship_date_sk, geography_sk, order_id, order_line_id,
         payment_method, order_channel, order_status, quantity, unit_price, unit_cost, discount_pct,
         discount_amount, gross_revenue, net_revenue, cogs, gross_profit,
         CASE WHEN net_revenue <> 0
              THEN {cents_pct('CAST(gross_profit * 100 AS BIGINT)', 'CAST(net_revenue * 100 AS BIGINT)')}
              ELSE CAST(0 AS DECIMAL(18,2)) END AS gross_profit_pct,
         days_to_ship, order_date, source_system, batch_id
  FROM fact_p)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_C = (CUST_RAW, CUST_STD, CUST_SILVER)
BASE_P = (PROD_RAW, PROD_STD, PROD_SILVER)
BASE_O = (ORD_RAW, ORD_STD, ord_silver())
STAR = BASE_C + BASE_P + BASE_O + (DIMS, FACT)

SILVER_ORDER_COLS = ("order_id, order_line_id, customer_id, product_id, order_date, ship_date, quantity, "
                     "unit_price, discount_pct, discount_amount, gross_revenue, net_revenue, days_to_ship, "
                     "payment_method, order_channel, order_status, source_system, batch_id")
ORDER_UPDATE = [c.strip() for c in SILVER_ORDER_COLS.split(",")]


def _upsert_sql(keys: list[str]) -> str:
    cols = []
    for c in ORDER_UPDATE:
        if c in keys:
            cols.append(f"CASE WHEN t.{keys[0]} IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}")
        else:
            cols.append(f"CASE WHEN s.{keys[0]} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
    changed = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in ORDER_UPDATE if c not in keys)
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    action = (f"CASE WHEN t.{keys[0]} IS NULL THEN 'insert' WHEN s.{keys[0]} IS NULL THEN 'keep' "
              f"WHEN {changed} THEN 'update' ELSE 'noop' END AS merge_action")
    return (w(ORD_RAW, ORD_STD, ord_silver("b1", f"ingested_at < TIMESTAMP '{CUTOFF}'"),
              ord_silver("b2", f"ingested_at >= TIMESTAMP '{CUTOFF}'"))
            + f"SELECT {', '.join(cols)}, {action} FROM b1 t FULL OUTER JOIN b2 s ON {on}")


def _noop_sql() -> str:
    changed = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in ORDER_UPDATE if c != "order_line_id")
    return (w(ORD_RAW, ORD_STD, ord_silver("b1", f"ingested_at < TIMESTAMP '{CUTOFF}'"), ord_silver("b2"))
            + "SELECT merge_action, count(*) AS row_count FROM ("
            + "SELECT CASE WHEN t.order_line_id IS NULL THEN 'insert' WHEN s.order_line_id IS NULL THEN 'keep' "
            + f"WHEN {changed} THEN 'update' ELSE 'noop' END AS merge_action "
            + "FROM b1 t FULL OUTER JOIN b2 s ON t.order_line_id = s.order_line_id) GROUP BY merge_action")


def _check(table: str, name: str, observed: str, total: str, threshold: str, passed: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{name}' AS check_name, CAST({observed} AS BIGINT) AS observed, "
            f"CAST({total} AS BIGINT) AS total, CAST({threshold} AS DOUBLE) AS threshold, "
            f"CAST({passed} AS BOOLEAN) AS passed")


def _suite(table: str, source: str, min_rows=None, nulls=(), dup=None, dup_max="0.01", ranges=(), regex=()) -> str:
    """Union of check rows over ``source`` (a CTE or view name)."""
    parts = []
    agg = f"(SELECT count(*) AS n FROM {source})"
    if min_rows is not None:
        parts.append(_check(table, "row_count_check", "n", "n", str(float(min_rows)), f"n >= {min_rows}") + f" FROM {agg}")
    for c in nulls:
        q = f"(SELECT count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS x FROM {source})"
        parts.append(_check(table, f"null_check_{c}", "x", "n", "0.05",
                            "coalesce(n > 0 AND x / n <= 0.05, false)") + f" FROM {q}")
    if dup:
        keys = ", ".join(dup)
        q = (f"(SELECT (SELECT count(*) FROM {source}) AS n, "
             f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {source})) AS d)")
        parts.append(_check(table, "duplicate_check", "n - d", "n", dup_max,
                            f"n = 0 OR (n - d) / n <= {dup_max}") + f" FROM {q}")
    for c, lo, hi in ranges:
        cond = " AND ".join([f"{c} >= {lo}"] * (lo is not None) + [f"{c} <= {hi}"] * (hi is not None)) or "TRUE"
        q = f"(SELECT count(*) AS n, count(*) FILTER (WHERE NOT ({cond})) AS x FROM {source})"
        parts.append(_check(table, f"range_check_{c}", "x", "n", "NULL", "x = 0") + f" FROM {q}")
    for c, pat in regex:
        q = f"(SELECT count(*) AS n, count(*) FILTER (WHERE NOT regexp_matches({c}, '{pat}')) AS x FROM {source})"
        parts.append(_check(table, f"regex_check_{c}", "x", "n", "NULL", "x = 0") + f" FROM {q}")
    return "\nUNION ALL\n".join(parts)


def _ri(table: str, fk: str, dim: str, pk: str) -> str:
    q = (f"(SELECT count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.k)) AS o, count(*) AS n "
         f"FROM (SELECT DISTINCT {fk} AS k FROM fact) f)")
    return _check(table, f"ref_integrity_{fk}", "o", "n", "NULL", "o = 0") + f" FROM {q}"


FACT_COLS = ("customer_sk, product_sk, order_date_sk, ship_date_sk, geography_sk, order_id, order_line_id, "
             "payment_method, order_channel, order_status, quantity, unit_price, unit_cost, discount_pct, "
             "discount_amount, gross_revenue, net_revenue, cogs, gross_profit, gross_profit_pct, days_to_ship, "
             "order_date, source_system, batch_id")

EMAIL_RE = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"
PHONE_RE = r"^\+?[0-9-]+$"

SILVER_C_SUITE = dict(min_rows=1, nulls=("customer_id", "email", "full_name", "country"), dup=("customer_id",))
SILVER_P_SUITE = dict(min_rows=1, nulls=("product_id", "product_name", "unit_price"), dup=("product_id",),
                      ranges=(("unit_price", 0, None), ("unit_cost", 0, None)))
SILVER_O_SUITE = dict(min_rows=1, nulls=("order_id", "order_line_id", "customer_id", "product_id", "order_date"),
                      dup=("order_line_id",),
                      ranges=(("quantity", 1, None), ("unit_price", 0, None), ("net_revenue", 0, None)))
FACT_SUITE = dict(min_rows=1, nulls=("order_line_id", "customer_sk", "product_sk", "order_date_sk"), dup=("order_line_id",),
                  ranges=(("quantity", 1, None), ("net_revenue", 0, None), ("gross_profit", None, None)))


def _collision_sql(digits: int = 6, attempts: int = 5) -> str:
    """Two loads of order ids, attempt by attempt; whoever is left after the last has no row."""
    ctes = [f"k0 AS (SELECT DISTINCT order_id AS bk FROM ord_silver WHERE order_date < DATE '{CUTOFF}')",
            "k1 AS (SELECT DISTINCT order_id AS bk FROM ord_silver)", "had AS (SELECT '' AS bk, CAST(-1 AS BIGINT) AS key)"]
    had = "had"
    for load in (0, 1):
        for n in range(attempts):
            text = f"bk || '#{n}'" if n else "bk"
            ctes.append(f"had_{load}_{n} AS (SELECT * FROM {had} UNION ALL SELECT min(bk), key FROM (SELECT bk, "
                        f"CAST('0x' || substr(sha256({text}), 1, {digits}) AS BIGINT) AS key FROM k{load} WHERE bk NOT IN (SELECT bk FROM {had})) "
                        f"WHERE key NOT IN (SELECT key FROM {had}) GROUP BY key)")
            had = f"had_{load}_{n}"
    return w(*BASE_O, *ctes) + f"SELECT bk AS business_key, key AS surrogate_key FROM {had} WHERE key >= 0"


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_customers"] = w(CUST_RAW) + "SELECT * FROM cust_raw"
    q["bronze_products"] = w(PROD_RAW) + "SELECT * FROM prod_raw"
    q["bronze_orders"] = w(ORD_RAW) + "SELECT * FROM ord_raw"
    q["standardise_strings"] = (w(CUST_RAW, CUST_STD) + "SELECT customer_id, first_name, last_name, full_name, "
                                "email, phone, city, state, country, zip_code, customer_segment FROM cust_std")
    q["typed_casts"] = (w(ORD_RAW, ORD_STD) + "SELECT order_line_id, order_date, ship_date, quantity, unit_price, "
                        "discount_pct, discount_amount, gross_revenue, net_revenue, days_to_ship FROM ord_std")
    q["dedup_latest"] = (w(ORD_RAW, ORD_STD) + "SELECT order_line_id, order_id, customer_id, product_id, ship_date, "
                         "quantity, unit_price FROM ord_std WHERE order_line_id IS NOT NULL "
                         f"QUALIFY row_number() OVER (PARTITION BY order_line_id ORDER BY {ORD_TIEBREAK}) = 1")
    rules = [("missing_order_id", "order_id IS NOT NULL"), ("missing_customer_id", "customer_id IS NOT NULL"),
             ("missing_product_id", "product_id IS NOT NULL"), ("non_positive_quantity", "quantity > 0"),
             ("non_positive_price", "unit_price > 0"), ("negative_net_revenue", "net_revenue >= 0"),
             ("ship_before_order", "days_to_ship >= 0")]
    failed = "concat_ws(',', " + ", ".join(
        f"CASE WHEN NOT coalesce({cond}, false) THEN '{name}' END" for name, cond in rules) + ")"
    q["quarantine"] = (w(ORD_RAW, ORD_STD) + f"SELECT order_line_id, days_to_ship, net_revenue, reasons AS reject_reasons "
                       f"FROM (SELECT * EXCLUDE (reasons), {failed} AS reasons FROM ord_std WHERE order_line_id IS NOT NULL "
                       f"QUALIFY row_number() OVER (PARTITION BY order_line_id ORDER BY {ORD_TIEBREAK}) = 1) "
                       "WHERE reasons <> ''")
    for name, ctes, std, key, columns in (
            ("customers", BASE_C, "cust_std", "customer_id", "customer_id, email"),
            ("products", BASE_P, "prod_std", "product_id", "product_id, product_name, unit_cost, unit_price"),
            ("orders", BASE_O, "ord_std", "order_line_id", "order_line_id, order_id, quantity, unit_price")):
        order = re.search(rf"PARTITION BY {key} ORDER BY (.*?)\) AS rn", ctes[2], re.S)[1]
        q[f"quarantine_{name}"] = (w(*ctes) + f"SELECT {columns}, array_to_string(reasons, ',') AS reject_reasons FROM ("
                                   f"SELECT * FROM {std} WHERE {key} IS NULL UNION ALL "
                                   f"(SELECT * FROM {std} WHERE {key} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)) "
                                   "WHERE len(reasons) > 0")
    q["surrogate_key"] = (w(*BASE_C, *BASE_P) + f"SELECT 'customer' AS entity, customer_id AS business_key, "
                          f"{sk('customer_id')} AS surrogate_key FROM cust_silver UNION ALL "
                          f"SELECT 'product', product_id, {sk('product_id')} FROM prod_silver")
    q["surrogate_key_collisions"] = _collision_sql()
    q["distinct_geography"] = w(*BASE_C) + "SELECT DISTINCT city, state, country, zip_code FROM cust_silver"
    q["silver_customers"] = (w(*BASE_C) + "SELECT customer_id, first_name, last_name, full_name, email, phone, "
                             "city, state, country, zip_code, customer_segment, registration_date, source_system, "
                             "batch_id FROM cust_silver")
    q["silver_products"] = (w(*BASE_P) + "SELECT product_id, product_name, category, sub_category, brand, sku, "
                            "supplier_id, unit_cost, unit_price, gross_margin_pct, weight_kg, is_active, "
                            "created_date, source_system, batch_id FROM prod_silver")
    q["silver_orders"] = w(*BASE_O) + f"SELECT {SILVER_ORDER_COLS} FROM ord_silver"
    q["silver_orders_second_load"] = q["silver_orders"]  # the loads together hold every row
    q["dim_customer"] = w(*STAR) + "SELECT * FROM dim_customer"
    changed = "customer_sk % 7 = 0 AND phone IS NOT NULL"
    stamp = lambda cond: f"CASE WHEN {cond} THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END"
    q["dim_customer_second_load"] = w(*STAR) + (
        f"SELECT *, {stamp('customer_sk % 10 = 0')} AS created_at, {stamp(f'customer_sk % 10 = 0 OR ({changed})')} AS updated_at FROM dim_customer")
    q["dim_product"] = w(*STAR) + "SELECT * FROM dim_product"
    q["dim_geography"] = w(*STAR) + "SELECT * FROM dim_geography"
    q["dim_date"] = w(*STAR) + "SELECT * FROM dim_date"
    q["lookup_left_join"] = w(*STAR) + "SELECT order_line_id, customer_sk, product_sk, unit_cost FROM fact"
    q["role_playing_date_join"] = w(*STAR) + "SELECT order_line_id, order_date_sk, ship_date_sk FROM fact"
    q["geography_lookup"] = w(*STAR) + "SELECT order_line_id, customer_sk, geography_sk FROM fact"
    q["fact_sales"] = w(*STAR) + f"SELECT {FACT_COLS} FROM fact"
    q["zorder_rewrite"] = q["fact_sales"]
    q["partition_publish"] = q["fact_sales"]
    q["late_dimension_repair"] = q["fact_sales"]  # a repair gives what a rebuild gives
    q["scd1_upsert"] = _upsert_sql(["order_line_id"])
    q["scd1_upsert_multi"] = _upsert_sql(["order_id", "order_line_id"])
    q["scd1_unchanged_noop"] = _noop_sql()
    part = "CASE WHEN o_orderkey % 5 = 4 THEN 'a:b' ELSE '0' || CAST(o_orderkey % 5 AS VARCHAR) END"
    q["partition_publish_string"] = (
        f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '0' || CAST(o_orderkey % 4 AS VARCHAR) ELSE {part} END AS part, "
        "CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS priority FROM orders")
    q["partition_publish_noop"] = f"SELECT {part} AS part, count(*) AS row_count, CAST(0 AS BIGINT) AS touched FROM orders GROUP BY 1"
    early, late = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-02-01 00:00:00'"
    q["scd1_evolve"] = (
        w(ORD_RAW, ORD_STD, ord_silver("b1", f"ingested_at < TIMESTAMP '{CUTOFF}'"), ord_silver("b2", f"ingested_at >= TIMESTAMP '{CUTOFF}'"))
        + "SELECT coalesce(t.order_line_id, s.order_line_id) AS order_line_id, "
        "CASE WHEN s.order_line_id IS NOT NULL THEN s.quantity ELSE t.quantity END AS quantity, s.order_channel, "
        f"CASE WHEN t.order_line_id IS NULL THEN {late} ELSE {early} END AS created_at, "
        "CASE WHEN t.order_line_id IS NULL OR (s.order_line_id IS NOT NULL AND (t.quantity IS DISTINCT FROM s.quantity OR s.order_channel IS NOT NULL)) "
        f"THEN {late} ELSE {early} END AS updated_at, "
        "CASE WHEN t.order_line_id IS NULL THEN 'insert' WHEN s.order_line_id IS NULL THEN 'keep' "
        "WHEN t.quantity IS DISTINCT FROM s.quantity OR s.order_channel IS NOT NULL THEN 'update' ELSE 'noop' END AS merge_action "
        "FROM b1 t FULL OUTER JOIN b2 s ON t.order_line_id = s.order_line_id")
    q["zorder_strings"] = q["dim_customer"]
    q["dq_nulls"] = w(*STAR) + _suite("fact_sales", "fact", nulls=(
        "order_line_id", "customer_sk", "product_sk", "order_date_sk", "ship_date_sk", "geography_sk", "unit_cost"))
    q["dq_duplicates"] = w(ORD_RAW, ORD_STD) + _suite("bronze_orders", "ord_std", min_rows=1, dup=("order_line_id",))
    q["dq_range"] = w(*STAR) + _suite("fact_sales", "fact", ranges=(
        ("quantity", 1, None), ("net_revenue", 0, None), ("gross_profit", None, None),
        ("days_to_ship", 0, None), ("discount_pct", 0, 1)))
    q["dq_regex"] = w(*BASE_C) + _suite("silver_customers", "cust_silver",
                                        regex=(("email", EMAIL_RE), ("phone", PHONE_RE)))
    q["ref_integrity"] = w(*STAR) + "\nUNION ALL\n".join([
        _ri("fact_sales", "customer_sk", "dim_customer", "customer_sk"),
        _ri("fact_sales", "product_sk", "dim_product", "product_sk"),
        _ri("fact_sales", "order_date_sk", "dim_date", "date_key"),
        _ri("fact_sales", "ship_date_sk", "dim_date", "date_key"),
        _ri("fact_sales", "geography_sk", "dim_geography", "geography_sk")])
    keys = [("customer_sk", "dim_customer", "customer_sk", 3), ("product_sk", "dim_product", "product_sk", 5),
            ("order_date_sk", "dim_date", "date_key", 11)]
    q["ref_integrity_orphans"] = (
        w(*STAR) + "SELECT * FROM (" + "\nUNION ALL\n".join(
            _ri("fact_sales", fk, f"(SELECT * FROM {dim} WHERE {pk} % {m} <> 0)", pk) for fk, dim, pk, m in keys) + ")")
    dims = []
    for t, bk, s_ in (("dim_customer", "customer_bk", "customer_sk"), ("dim_product", "product_bk", "product_sk"),
                      ("dim_geography", "geography_bk", "geography_sk")):
        dims.append(_suite(t, t, min_rows=1, dup=(bk,)))
        dims.append(_suite(t + ":sk", t, dup=(s_,), dup_max="0.0"))
    q["dq_suite"] = w(*STAR) + "\nUNION ALL\n".join([
        _suite("silver_customers", "cust_silver", **SILVER_C_SUITE),
        _suite("silver_products", "prod_silver", **SILVER_P_SUITE),
        _suite("silver_orders", "ord_silver", **SILVER_O_SUITE),
        *dims,
        _suite("dim_date", "dim_date", min_rows=1, dup=("date_key",)),
        _suite("fact_sales", "fact", **FACT_SUITE)])
    counts = [("BRONZE", "crm_customers", "cust_raw"), ("BRONZE", "erp_products", "prod_raw"),
              ("BRONZE", "ecom_orders", "ord_raw"), ("SILVER", "customers", "cust_silver"),
              ("SILVER", "products", "prod_silver"), ("SILVER", "orders", "ord_silver"),
              ("GOLD", "dim_customer", "dim_customer"), ("GOLD", "dim_product", "dim_product"),
              ("GOLD", "dim_date", "dim_date"), ("GOLD", "dim_geography", "dim_geography"),
              ("GOLD", "fact_sales", "fact")]
    q["dq_overall"] = ("SELECT table_name, count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS failed, bool_and(passed) AS passed "
                       f"FROM ({q['dq_suite']}) GROUP BY table_name")
    q["layer_row_counts"] = w(*STAR) + "\nUNION ALL\n".join(
        f"SELECT '{l}' AS layer, '{n}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {v}"
        for l, n, v in counts)
    q["rpt_status"] = w(*STAR) + (
        f"SELECT order_status, count(*) AS orders, {amount('sum(net_revenue)')} AS total_revenue, "
        f"{amount('sum(gross_profit)')} AS total_gross_profit FROM fact GROUP BY order_status")
    q["rpt_category"] = w(*STAR) + (
        f"SELECT p.category, count(f.order_line_id) AS order_lines, CAST(sum(f.quantity) AS BIGINT) AS total_units, "
        f"{amount('sum(f.net_revenue)')} AS total_revenue, {amount('sum(f.gross_profit)')} AS total_profit, "
        f"{exact_avg('sum(f.gross_profit_pct)', 'count(f.gross_profit_pct)')} AS avg_margin_pct "
        "FROM fact f LEFT JOIN dim_product p ON f.product_sk = p.product_sk GROUP BY p.category")
    q["rpt_segment"] = w(*STAR) + (
        f"SELECT c.customer_segment, count(DISTINCT f.order_id) AS orders, "
        f"{amount('sum(f.net_revenue)')} AS total_revenue, "
        f"{exact_avg('sum(f.net_revenue)', 'count(f.net_revenue)')} AS avg_order_value "
        "FROM fact f LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk GROUP BY c.customer_segment")
    q["rpt_monthly"] = w(*STAR) + (
        f"SELECT d.year_month, count(f.order_line_id) AS transactions, {amount('sum(f.net_revenue)')} AS monthly_revenue, "
        f"{amount('sum(f.gross_profit)')} AS monthly_profit "
        "FROM fact f LEFT JOIN dim_date d ON f.order_date_sk = d.date_key GROUP BY d.year_month")
    q["rpt_top_products"] = w(*STAR) + (
        f"SELECT p.product_name, p.category, CAST(sum(f.quantity) AS BIGINT) AS units_sold, "
        f"{amount('sum(f.net_revenue)')} AS total_revenue, "
        f"{exact_avg('sum(f.gross_profit_pct)', 'count(f.gross_profit_pct)')} AS avg_margin_pct "
        "FROM fact f LEFT JOIN dim_product p ON f.product_sk = p.product_sk GROUP BY p.product_name, p.category "
        "ORDER BY total_revenue DESC NULLS LAST, p.product_name ASC NULLS FIRST, p.category ASC NULLS FIRST LIMIT 5")
    q["rpt_channel"] = w(*STAR) + (
        f"SELECT order_channel, payment_method, count(order_id) AS orders, {amount('sum(net_revenue)')} AS revenue "
        "FROM fact GROUP BY order_channel, payment_method")
    for name in ("status", "category", "segment", "monthly", "top_products", "channel"):
        q[f"rpt_{name}_incremental"] = q[f"rpt_{name}"]  # two loads give what one does
    return q
