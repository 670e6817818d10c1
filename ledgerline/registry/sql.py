"""The registered queries as SQL over the test tables, for checking results in another engine.

Written independently of the operators: flat joins, window functions and exact percentiles.
"""

from __future__ import annotations

from ledgerline.schemas import CATEGORY_COLUMNS, CHARTED_COLUMNS, DESCRIBED_COLUMNS


def half_even(expression: str, digits: int) -> str:
    return f"(round_even(({expression}) * 1e{digits}, 0) / 1e{digits})"


def doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


LINES = """lines AS (
  SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
         o_orderpriority AS ship_mode, c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
         r_name AS country, n_name AS city, n_name AS state, r_name AS region,
         p_partkey AS product_id, p_type AS category, p_brand AS sub_category, p_name AS product_name,
         sales, quantity, discount,
         CAST(sales * (margin - CAST(0.6 AS DECIMAL(2,1)) * discount) AS DECIMAL(14,2)) AS profit
  FROM (
    SELECT *, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_discount AS DECIMAL(4,2)) AS discount,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(14,2)) AS sales
    FROM lineitem
  ) l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN (
    SELECT *, CAST(lo + (hi - lo) * CAST(p_partkey % 100 AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(7,4)) AS margin
    FROM (
      SELECT *,
        CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN CAST(0.03 AS DECIMAL(3,2))
             WHEN p_type IN ('STANDARD', 'MEDIUM') THEN CAST(0.05 AS DECIMAL(3,2)) ELSE CAST(0.10 AS DECIMAL(3,2)) END AS lo,
        CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN CAST(0.15 AS DECIMAL(3,2))
             WHEN p_type IN ('STANDARD', 'MEDIUM') THEN CAST(0.18 AS DECIMAL(3,2)) ELSE CAST(0.35 AS DECIMAL(3,2)) END AS hi
      FROM part
    ) ranges
  ) p ON l_partkey = p_partkey
)"""

FINANCIALS = f"""{half_even('CAST(sales AS DOUBLE) / CAST(quantity AS DOUBLE)', 2)} AS unit_price,
  {half_even('CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE) * 1e2', 2)} AS profit_margin_pct,
  CASE WHEN discount = 0 THEN 'No Discount' WHEN discount <= 0.2 THEN 'Low (1-20%)'
       WHEN discount <= 0.35 THEN 'Medium (21-35%)' ELSE 'High (36%+)' END AS discount_bucket"""

TIME_FEATURES = """CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
  CAST(quarter(order_date) AS INTEGER) AS order_quarter, dayname(order_date) AS order_day_of_week,
  isodow(order_date) >= 6 AS is_weekend, month(order_date) IN (10, 11) AS is_festive_season"""

REPAIRED = """repaired AS (
  SELECT * REPLACE (CASE WHEN ship_date < order_date THEN CAST(order_date + INTERVAL 1 DAY AS DATE) ELSE ship_date END AS ship_date)
  FROM lines
)"""

EDA = f"""eda AS (
  SELECT *, CAST(date_diff('day', order_date, ship_date) AS INTEGER) AS days_to_ship, {FINANCIALS} FROM repaired
)"""

DIRTY = """marked AS (
  SELECT * REPLACE (CASE WHEN (order_id * 31 + product_id) % 67 <> 0 THEN customer_name END AS customer_name,
                    CASE WHEN (order_id * 17 + product_id) % 100 <> 0 THEN discount END AS discount)
  FROM lines
), dirty AS (
  SELECT * FROM marked UNION ALL SELECT * FROM marked WHERE (order_id * 13 + product_id) % 200 = 0
)"""

CLEAN = """filled AS (
  SELECT * REPLACE (coalesce(customer_name, 'Guest Customer') AS customer_name,
                    coalesce(discount, CAST(0 AS DECIMAL(4,2))) AS discount)
  FROM dirty
), distinct_rows AS (
  SELECT DISTINCT * FROM filled
), typed AS (
  SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
                    CAST(product_id AS VARCHAR) AS product_id)
  FROM distinct_rows
), clean AS (
  SELECT * REPLACE (CASE WHEN ship_date < order_date THEN CAST(order_date + INTERVAL 1 DAY AS DATE) ELSE ship_date END AS ship_date)
  FROM typed WHERE NOT coalesce(sales <= 0, FALSE) AND quantity > 0
)"""

BROKEN = """broken AS (
  SELECT * REPLACE (CASE order_id % 50 WHEN 7 THEN NULL WHEN 8 THEN -sales ELSE sales END AS sales,
                    CASE WHEN order_id % 50 = 9 THEN 0 ELSE quantity END AS quantity)
  FROM dirty
), unique_broken AS (
  SELECT DISTINCT * REPLACE (coalesce(customer_name, 'Guest Customer') AS customer_name, coalesce(discount, 0) AS discount) FROM broken
)"""

CUSTOMER_LIST = "customer_id, customer_name, segment, country, city, state, region"
PRODUCT_LIST = "product_id, product_name, category, sub_category"
ORDER_LIST = "order_id, customer_id, order_date, ship_date, ship_mode"
ITEM_LIST = "order_id, product_id, sales, quantity, discount, profit"

TABLES = f"""dim_customer AS (
  SELECT {CUSTOMER_LIST} FROM clean
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id, product_id, customer_name,
                             segment, country, city, state, region) = 1
), dim_product AS (
  SELECT {PRODUCT_LIST} FROM clean
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY order_date, order_id, product_name, category, sub_category) = 1
), header AS (
  SELECT {ORDER_LIST} FROM clean
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY product_id, order_date, ship_date, customer_id, ship_mode) = 1
), plain_item AS (
  SELECT order_id, product_id, CAST(sales AS DECIMAL(12,2)) AS sales, quantity, discount,
         CAST(profit AS DECIMAL(12,2)) AS profit FROM clean
), item AS (
  SELECT row_number() OVER (ORDER BY md5(concat_ws('|', order_id, product_id, CAST(sales AS VARCHAR),
           CAST(quantity AS VARCHAR), CAST(discount AS VARCHAR), CAST(profit AS VARCHAR))), {ITEM_LIST}) AS order_item_id,
         {ITEM_LIST}
  FROM plain_item
), summary AS (
  SELECT order_item_id, order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment, country, city,
         state, region, product_id, product_name, category, sub_category, sales, quantity, discount, profit
  FROM item JOIN header USING (order_id) JOIN dim_customer USING (customer_id) JOIN dim_product USING (product_id)
)"""

CUSTOMER_WINDOWS = """min(order_date) OVER (PARTITION BY customer_id) AS customer_first_order_date,
  CAST(date_diff('day', min(order_date) OVER (PARTITION BY customer_id), order_date) AS INTEGER) AS customer_tenure_days,
  CAST(dense_rank() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS INTEGER) AS customer_total_orders_to_date"""

MONTHLY = f"""months AS (
  SELECT last_day(order_date) AS order_date, CAST(sum(sales) AS DOUBLE) AS total_sales,
         CAST(sum(profit) AS DOUBLE) AS total_profit, count(DISTINCT order_id) AS order_count
  FROM lines GROUP BY 1
), calendar AS (
  SELECT last_day(CAST(m AS DATE)) AS order_date
  FROM (SELECT unnest(generate_series(date_trunc('month', min(order_date)), date_trunc('month', max(order_date)), INTERVAL 1 MONTH)) AS m
        FROM months)
), filled_months AS (
  SELECT order_date, coalesce(total_sales, 0) AS total_sales, coalesce(total_profit, 0) AS total_profit,
         coalesce(order_count, 0) AS order_count
  FROM calendar LEFT JOIN months USING (order_date)
), monthly AS (
  SELECT *, {half_even("(total_sales / nullif(lag(total_sales) OVER (ORDER BY order_date), 0) - 1e0) * 1e2", 2)} AS mom_growth_pct
  FROM filled_months
)"""


def weekly(keys: str = "") -> str:
    """Weeks labelled by their Sunday, gaps filled, with features and the split mark."""
    by = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""weeks AS (
  SELECT {by}CAST(date_trunc('week', order_date) + INTERVAL 6 DAY AS DATE) AS week_end, CAST(sum(sales) AS DOUBLE) AS total_sales
  FROM lines GROUP BY ALL
), week_calendar AS (
  SELECT {by}CAST(w AS DATE) AS week_end
  FROM (SELECT {by}unnest(generate_series(CAST(min(week_end) AS TIMESTAMP), CAST(max(week_end) AS TIMESTAMP), INTERVAL 7 DAY)) AS w
        FROM weeks {group})
), weekly AS (
  SELECT {by}week_end, coalesce(total_sales, 0) AS total_sales
  FROM week_calendar LEFT JOIN weeks USING ({by}week_end)
), features AS (
  SELECT *, CAST(date_diff('day', min(week_end) OVER ({part}), week_end) // 7 AS INTEGER) AS time_index,
         CAST(month(week_end) AS INTEGER) AS month, CAST(quarter(week_end) AS INTEGER) AS quarter,
         CAST(weekofyear(week_end) AS INTEGER) AS week_of_year,
         CAST(month(week_end) IN (10, 11) AS INTEGER) AS is_festive_season
  FROM weekly
), split AS (
  SELECT *, time_index < floor(count(*) OVER ({part}) * CAST(0.85 AS DOUBLE)) AS is_train FROM features
)"""


RFM = """last_day_seen AS (SELECT CAST(max(order_date) + INTERVAL 1 DAY AS DATE) AS today FROM lines
), rfm AS (
  SELECT customer_id, CAST(date_diff('day', max(order_date), any_value(today)) AS INTEGER) AS recency_days,
         count(DISTINCT order_id) AS frequency, CAST(sum(sales) AS DOUBLE) AS monetary
  FROM lines, last_day_seen GROUP BY customer_id
)"""

PROFILE = """clustered AS (SELECT *, CAST(customer_id % 4 AS INTEGER) AS cluster FROM rfm
), means AS (
  SELECT cluster, avg(recency_days) AS recency_days, avg(frequency) AS frequency, avg(monetary) AS monetary
  FROM clustered GROUP BY cluster
), ranked AS (
  SELECT *, rank() OVER (ORDER BY recency_days) + (count(*) OVER (PARTITION BY recency_days) - 1) / 2e0 AS recency_rank,
         rank() OVER (ORDER BY frequency DESC) + (count(*) OVER (PARTITION BY frequency) - 1) / 2e0 AS frequency_rank,
         rank() OVER (ORDER BY monetary DESC) + (count(*) OVER (PARTITION BY monetary) - 1) / 2e0 AS monetary_rank
  FROM means
), profile AS (
  SELECT *, recency_rank + frequency_rank + monetary_rank AS composite_rank,
         list_extract(['Champions', 'Loyal Customers', 'At Risk', 'Lost'],
           row_number() OVER (ORDER BY recency_rank + frequency_rank + monetary_rank, cluster)) AS segment
  FROM ranked
)"""

CLUSTER_SCORES = """z AS (
  SELECT customer_id, (ln(1 + recency_days) - avg(ln(1 + recency_days)) OVER ()) / stddev_pop(ln(1 + recency_days)) OVER () AS r,
         (ln(1 + frequency) - avg(ln(1 + frequency)) OVER ()) / stddev_pop(ln(1 + frequency)) OVER () AS f,
         (ln(1 + monetary) - avg(ln(1 + monetary)) OVER ()) / stddev_pop(ln(1 + monetary)) OVER () AS m
  FROM rfm
), labelled AS (SELECT *, (customer_id + customer_id % 7) % k AS c FROM z, (SELECT unnest(generate_series(2, 8)) AS k)
), distances AS (
  SELECT x.k, x.customer_id, x.c = y.c AS own, y.c, count(*) AS n,
         sum((x.r - y.r) * (x.r - y.r) + (x.f - y.f) * (x.f - y.f) + (x.m - y.m) * (x.m - y.m)) AS total
  FROM labelled x JOIN labelled y ON x.k = y.k GROUP BY ALL
), judged AS (
  SELECT k, customer_id, sum(total / (2 * n)) FILTER (own) AS cost, max(n) FILTER (own) AS size,
         max(total / greatest(n - 1, 1)) FILTER (own) AS a, min(total / n) FILTER (NOT own) AS b
  FROM distances GROUP BY k, customer_id
)
SELECT CAST(k AS INTEGER) AS clusters, count(*) AS customers, round(sum(cost), 6) AS inertia,
       round(avg(CASE WHEN size = 1 OR b IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM judged GROUP BY k"""

ITEMS = """bought AS (SELECT DISTINCT order_id, sub_category || '/' || category AS item FROM lines
), counts AS (SELECT item, count(*) AS order_count FROM bought GROUP BY item
), total AS (SELECT count(DISTINCT order_id) AS n FROM bought)"""

RULES = f"""pairs AS (
  SELECT a.item AS item_a, b.item AS item_b, count(*) AS co_occurrence_count
  FROM bought a JOIN bought b ON a.order_id = b.order_id AND a.item < b.item GROUP BY 1, 2
), measured AS (
  SELECT p.*, ca.order_count AS orders_a, cb.order_count AS orders_b, CAST(co_occurrence_count AS DOUBLE) / n AS support,
         (CAST(co_occurrence_count AS DOUBLE) / n) / ((CAST(ca.order_count AS DOUBLE) / n) * (CAST(cb.order_count AS DOUBLE) / n)) AS lift
  FROM pairs p JOIN counts ca ON p.item_a = ca.item JOIN counts cb ON p.item_b = cb.item, total
), rules AS (
  SELECT item_a AS product_a, item_b AS product_b, co_occurrence_count, {half_even('support', 5)} AS support,
         {half_even('CAST(co_occurrence_count AS DOUBLE) / orders_a', 4)} AS confidence_a_to_b,
         {half_even('CAST(co_occurrence_count AS DOUBLE) / orders_b', 4)} AS confidence_b_to_a,
         {half_even('lift', 3)} AS lift
  FROM measured WHERE support >= 1e-3 AND lift >= 12e-1
)"""

ALL_LINE_COLUMNS = (
    "order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment, country, city, state, region, "
    "product_id, category, sub_category, product_name, quantity, " + doubles("sales", "discount", "profit")
)


def q(body: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes or (LINES,))}\n{body.strip()}"


def _per_column(template: str, columns=DESCRIBED_COLUMNS, source: str = "eda") -> str:
    parts = [template.format(c=c, v=f"CAST({c} AS DOUBLE)", source=source) for c in columns]
    return "\nUNION ALL\n".join(parts)


def _box(source: str, columns, key: str = "") -> str:
    by = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    on = f"USING ({key})" if key else "ON TRUE"
    parts = [
        f"""SELECT {by}'{c}' AS metric, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
  min(v) FILTER (v BETWEEN q1 - 15e-1 * (q3 - q1) AND q3 + 15e-1 * (q3 - q1)) AS whisker_low,
  max(v) FILTER (v BETWEEN q1 - 15e-1 * (q3 - q1) AND q3 + 15e-1 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (NOT v BETWEEN q1 - 15e-1 * (q3 - q1) AND q3 + 15e-1 * (q3 - q1)) AS outliers
FROM (SELECT {by}CAST({c} AS DOUBLE) AS v FROM {source})
JOIN (SELECT {by}quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median,
             quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {source} {group}) {on} {group}"""
        for c in columns
    ]
    rounded = ", ".join(f"round({c}, 6) AS {c}" for c in ("q1", "median", "q3", "whisker_low", "whisker_high"))
    return f"SELECT {by}metric, {rounded}, outliers FROM (" + "\nUNION ALL\n".join(parts) + ")"


def _fences(columns=("sales", "profit")) -> str:
    parts = [
        f"""SELECT '{c}' AS metric, any_value(q1) AS q1, any_value(q3) AS q3, any_value(q1 - 15e-1 * (q3 - q1)) AS lower_bound,
  any_value(q3 + 15e-1 * (q3 - q1)) AS upper_bound,
  count(*) FILTER (NOT v BETWEEN q1 - 15e-1 * (q3 - q1) AND q3 + 15e-1 * (q3 - q1)) AS outliers, count(*) AS n
FROM (SELECT CAST({c} AS DOUBLE) AS v FROM clean),
     (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM clean)"""
        for c in columns
    ]
    return "\nUNION ALL\n".join(parts)


def _correlations(columns=DESCRIBED_COLUMNS) -> str:
    rows = []
    for a in columns:
        cells = ", ".join(
            f"1e0 AS {b}" if a == b else f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS {b}" for b in columns
        )
        rows.append(f"SELECT '{a}' AS metric, {cells} FROM eda")
    return "\nUNION ALL\n".join(rows)


def _null_counts(source: str, columns) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM {source}" for c in columns
    )


def _length_checks() -> str:
    from ledgerline.schemas import DECIMAL_LIMITS, ORDER_LINE_COLUMNS, TEXT_LENGTHS

    parts = [
        f"SELECT '{c}' AS column_name, count(*) FILTER (length(CAST({c} AS VARCHAR)) > {n}) AS oversized_values FROM dirty"
        for c, n in TEXT_LENGTHS.items() if c in ORDER_LINE_COLUMNS
    ] + [
        f"SELECT '{c}', count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL({p},{s})) IS NULL) FROM dirty"
        for c, (p, s) in DECIMAL_LIMITS.items()
    ]
    return "\nUNION ALL\n".join(parts)


def _observed_audit() -> str:
    from ledgerline.schemas import ORDER_LINE_COLUMNS

    counts = {
        ("shape", "rows_before"): "broken", ("shape", "rows_after"): "unique_broken WHERE coalesce(sales > 0, TRUE) AND quantity > 0",
        **{(s, c): f"broken WHERE {c} IS NULL" for s in ("missing", "filled") for c in ("customer_name", "discount")},
        ("rules", "ship_date before order_date"): "unique_broken WHERE ship_date < order_date",
        ("rules", "sales <= 0"): "unique_broken WHERE sales <= 0",
        ("rules", "quantity <= 0"): "unique_broken WHERE coalesce(sales > 0, TRUE) AND quantity <= 0",
        **{("unparsed", c): "broken WHERE order_id % 50 = 7" if c == "sales" else "broken WHERE FALSE" for c in ORDER_LINE_COLUMNS},
    }
    parts = [f"SELECT '{s}' AS section, '{m}' AS metric, CAST(count(*) AS DOUBLE) AS value FROM {t}" for (s, m), t in counts.items()]
    copies = "SELECT 'shape', 'copies_removed', CAST((SELECT count(*) FROM broken) - (SELECT count(*) FROM unique_broken) AS DOUBLE)"
    return "SELECT * FROM (" + "\nUNION ALL\n".join([*parts, copies]) + ") WHERE value > 0 OR section IN ('shape', 'unparsed')"


def _distinct_checks() -> str:
    groups = {"headline": "'all'", "regions": "region", "months": "CAST(CAST(date_trunc('month', order_date) AS DATE) AS VARCHAR)"}
    return "\nUNION ALL\n".join(
        f"SELECT '{scope}' AS scope, {name} AS name, '{c}' AS metric, count(DISTINCT {c}) AS distinct_values, TRUE AS within FROM lines GROUP BY ALL"
        for scope, name in groups.items() for c in ("order_id", "customer_id")
    )


MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _heatmap() -> str:
    cells = ", ".join(
        f"CASE WHEN (SELECT count(*) FROM lines WHERE month(order_date) = {i}) > 0 THEN "
        f"CAST(coalesce(sum(sales) FILTER (month(order_date) = {i}), 0) AS DOUBLE) END AS \"{m}\""
        for i, m in enumerate(MONTH_NAMES, 1)
    )
    return f"SELECT category, {cells} FROM lines GROUP BY category"


HEADLINE = """SELECT *, CAST(repeat_customers AS DOUBLE) / total_customers * 1e2 AS repeat_customer_rate_pct,
  CASE WHEN repeat_customers * 1e2 / total_customers > 50 THEN 'strong'
       WHEN repeat_customers * 1e2 / total_customers > 25 THEN 'moderate' ELSE 'weak' END AS retention
FROM (
  SELECT CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(profit) AS DOUBLE) AS total_profit,
         CAST(sum(profit) AS DOUBLE) / CAST(sum(sales) AS DOUBLE) * 1e2 AS profit_margin_pct,
         count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS total_customers,
         CAST(sum(sales) AS DOUBLE) / count(DISTINCT order_id) AS average_order_value,
         CAST(sum(sales) AS DOUBLE) / count(DISTINCT customer_id) AS customer_lifetime_value,
         (SELECT count(*) FROM (SELECT customer_id FROM lines GROUP BY 1 HAVING count(DISTINCT order_id) > 1)) AS repeat_customers
  FROM lines
)"""

REGIONAL = f"""SELECT region, CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(profit) AS DOUBLE) AS total_profit,
  count(DISTINCT order_id) AS order_count,
  {half_even("CAST(sum(sales) AS DOUBLE) / (SELECT CAST(sum(sales) AS DOUBLE) FROM lines) * 1e2", 2)} AS sales_share_pct
FROM lines GROUP BY region"""

TOP_PRODUCTS = """SELECT product_id, product_name, category, CAST(sum(sales) AS DOUBLE) AS total_sales,
  CAST(sum(profit) AS DOUBLE) AS total_profit, CAST(sum(quantity) AS BIGINT) AS units_sold
FROM lines GROUP BY 1, 2, 3 ORDER BY sum(sales) DESC, product_id LIMIT 10"""

PEAK_LOW = """SELECT kind, strftime(order_date, '%Y-%m') AS month, strftime(order_date, '%B %Y') AS month_name, total_sales
FROM (
  (SELECT 'peak' AS kind, order_date, total_sales FROM monthly ORDER BY total_sales DESC, order_date LIMIT 1)
  UNION ALL
  (SELECT 'low' AS kind, order_date, total_sales FROM monthly ORDER BY total_sales, order_date LIMIT 1)
)"""

EXTREMES = f"""SELECT 'highest' AS kind, metric, value FROM (SELECT * FROM signed ORDER BY value DESC, metric LIMIT 1)
UNION ALL
SELECT 'lowest_signed', metric, value FROM (SELECT * FROM signed ORDER BY value, metric LIMIT 1)"""

TREND = f"""SELECT region, category, round(regr_slope(total_sales, CAST(time_index AS DOUBLE)), 4) AS slope,
  round(regr_intercept(total_sales, CAST(time_index AS DOUBLE)), 4) AS intercept, count(*) AS train_weeks
FROM split WHERE is_train GROUP BY region, category"""

METRICS = """SELECT round(avg(abs(e)), 2) AS mae, round(sqrt(avg(e * e)), 2) AS rmse,
  round(1e0 - sum(e * e) / nullif(var_pop(total_sales) * count(*), 0), 4) AS r2
FROM (SELECT total_sales, total_sales - (intercept + slope * time_index) AS e
      FROM split, (SELECT regr_slope(total_sales, CAST(time_index AS DOUBLE)) AS slope,
                          regr_intercept(total_sales, CAST(time_index AS DOUBLE)) AS intercept
                   FROM split WHERE is_train)
      WHERE NOT is_train)"""

DENSITY = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS metric, CAST(point AS INTEGER) AS point, round(lo + point * (hi - lo) / 199, 6) AS x,
  round(sum(cnt * exp(-5e-1 * pow((lo + point * (hi - lo) / 199 - v) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 9) AS density
FROM (SELECT CAST({c} AS DOUBLE) AS v, count(*) AS cnt FROM repaired GROUP BY 1),
     (SELECT count(*) AS n, min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi,
             stddev_samp(CAST({c} AS DOUBLE)) * pow(CAST(count(*) AS DOUBLE), -2e-1) AS h FROM repaired),
     (SELECT unnest(range(200)) AS point)
GROUP BY point, lo, hi"""
    for c in CHARTED_COLUMNS
)

BINNED_DENSITY = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS metric, CAST(point AS INTEGER) AS point, round(lo + point * step, 6) AS x,
  round(coalesce(sum(mass * exp(-0.5e0 * pow((point - node / m) * step / h, 2))), 0) / any_value(n) / (h * sqrt(2e0 * pi())), 9) AS density,
  round(pow(step / m / h, 2) / 8e0 / (h * sqrt(2e0 * pi())), 9) AS error_bound
FROM (SELECT *, ceil(step * 16e0 / h) AS m FROM (
        SELECT n, lo, (hi - lo) / 199e0 AS step, std * pow(CAST(n AS DOUBLE), -0.2e0) AS h FROM (
          SELECT count({c}) AS n, min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi, stddev_samp(CAST({c} AS DOUBLE)) AS std FROM eda)))
CROSS JOIN (SELECT unnest(generate_series(0, 199)) AS point)
JOIN (
  SELECT node, sum(mass) AS mass FROM (
    SELECT unnest([{{'node': floor(place), 'mass': 1 - (place - floor(place))}}, {{'node': floor(place) + 1, 'mass': place - floor(place)}}], recursive := true)
    FROM (SELECT (CAST({c} AS DOUBLE) - lo) / (step / ceil(step * 16e0 / h)) AS place FROM eda, (
        SELECT lo, (hi - lo) / 199e0 AS step, std * pow(CAST(n AS DOUBLE), -0.2e0) AS h FROM (
          SELECT count({c}) AS n, min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi, stddev_samp(CAST({c} AS DOUBLE)) AS std FROM eda)))
  ) GROUP BY node
) ON TRUE
GROUP BY point, lo, step, h, m"""
    for c in CHARTED_COLUMNS
)

HISTOGRAM = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS metric, bin, round(lo + bin * w, 6) AS bin_start, count(*) AS row_count
FROM (SELECT CAST(least(floor((CAST({c} AS DOUBLE) - lo) / w), 39) AS INTEGER) AS bin, lo, w
      FROM repaired, (SELECT min(CAST({c} AS DOUBLE)) AS lo,
                             (max(CAST({c} AS DOUBLE)) - min(CAST({c} AS DOUBLE))) / 40 AS w FROM repaired))
GROUP BY bin, lo, w"""
    for c in CHARTED_COLUMNS
)


# The columns of a flat file with their types after conversion, in Spark's and in SQL's words.
CONVERTED = [
    *[(c, "date", "DATE") for c in ("order_date", "ship_date")],
    *[(c, "string", "VARCHAR") for c in (
        "order_id", "ship_mode", "customer_id", "customer_name", "segment", "country", "city", "state", "region", "product_id",
        "category", "sub_category", "product_name")],
    *[(c, "double", "DOUBLE") for c in ("sales", "discount", "profit")],
    ("quantity", "int", "INTEGER"),
]

# Tables and columns with the longest text or the decimal digits that each may hold.
TABLE_LIMITS = {
    "dim_customer": ("customers", {"customer_id": 20, "customer_name": 150, "segment": 30, "country": 60, "city": 80, "state": 80, "region": 20}),
    "dim_product": ("products", {"product_id": 20, "product_name": 150, "category": 50, "sub_category": 50}),
    "header": ("orders", {"order_id": 20, "customer_id": 20, "ship_mode": 30, "order_date": None, "ship_date": None}),
    "item": ("order_items", {"order_id": 20, "product_id": 20, "sales": (12, 2), "discount": (4, 2), "profit": (12, 2), "quantity": None,
                             "order_item_id": None}),
}


def _table_audit() -> str:
    parts = []
    for source, (name, columns) in TABLE_LIMITS.items():
        for c, limit in columns.items():
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'not null' AS rule, count(*) FILTER ({c} IS NULL) AS broken_rows FROM {source}")
            if isinstance(limit, int):
                parts.append(f"SELECT '{name}', '{c}', 'length', count(*) FILTER (length({c}) > {limit}) FROM {source}")
            elif limit:
                kind = f"DECIMAL({limit[0]},{limit[1]})"
                parts.append(f"SELECT '{name}', '{c}', 'length', count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {kind}) IS NULL) FROM {source}")
    return "\nUNION ALL\n".join(parts)


def _eda_report() -> str:
    described, moments = [], []
    for c in DESCRIBED_COLUMNS:
        v = f"CAST({c} AS DOUBLE)"
        figures = {"count": f"count({v})", "mean": half_even(f"avg({v})", 2), "std": half_even(f"stddev_samp({v})", 2), "min": half_even(f"min({v})", 2),
                   **{f"p{p}": half_even(f"quantile_cont({v}, {p / 100})", 2) for p in (25, 50, 75)}, "max": half_even(f"max({v})", 2)}
        described += [f"SELECT 'describe {m}' AS section, '{c}' AS metric, CAST({e} AS DOUBLE) AS value FROM eda" for m, e in figures.items()]
        moments += [
            f"SELECT '{name}', '{c}', {half_even(f'avg(pow(({v} - m) / s, {power})){less}', 2)} FROM eda, "
            f"(SELECT avg({v}) AS m, stddev_pop({v}) AS s FROM eda)" for name, power, less in (("skewness", 3, ""), ("kurtosis", 4, " - 3"))
        ]
    others = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS metric, {half_even(f'corr(CAST(sales AS DOUBLE), CAST({c} AS DOUBLE))', 2)} AS value FROM eda" for c in DESCRIBED_COLUMNS if c != "sales")
    return "\nUNION ALL\n".join([
        *described, *moments,
        "SELECT 'shape', 'row_count', CAST(count(*) AS DOUBLE) FROM eda", "SELECT 'shape', 'column_count', 13e0",
        f"SELECT 'correlation with sales', 'highest: ' || metric, value FROM (SELECT * FROM ({others}) ORDER BY value DESC, metric LIMIT 1)",
        f"SELECT 'correlation with sales', 'lowest_signed: ' || metric, value FROM (SELECT * FROM ({others}) ORDER BY value, metric LIMIT 1)",
        "SELECT 'category sales', category, CAST(sum(sales) AS DOUBLE) FROM eda GROUP BY category",
        "SELECT 'regional sales', region, CAST(sum(sales) AS DOUBLE) FROM eda GROUP BY region",
        f"SELECT 'extreme months', kind || ': ' || month, total_sales FROM ({PEAK_LOW})",
    ])


def _segment_report() -> str:
    sizes = "FROM clustered c JOIN (SELECT cluster, segment FROM profile) USING (cluster) GROUP BY segment"
    return "\nUNION ALL\n".join([
        f"SELECT 'customers' AS section, segment AS metric, CAST(count(*) AS DOUBLE) AS value {sizes}",
        *[f"SELECT '{c}', segment, {half_even(f'avg(c.{c})', 1)} {sizes}" for c in ("recency_days", "frequency", "monetary")],
    ])


NAMES = """names AS (SELECT sub_category || '/' || category AS item, product_name FROM lines
  QUALIFY row_number() OVER (PARTITION BY sub_category, category ORDER BY order_date, order_id, product_name) = 1)"""

RULE_REPORT = """SELECT 'evidence' AS section, metric, CAST(value AS DOUBLE) AS value FROM (
  UNPIVOT (SELECT (SELECT n FROM total) AS orders, (SELECT count(*) FROM counts) AS products,
             CAST((SELECT count(*) * (count(*) - 1) // 2 FROM counts) AS BIGINT) AS possible_pairs, count(*) AS rules,
             count(*) FILTER (co_occurrence_count < 10) AS thin_rules FROM rules)
  ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'lift', concat_ws(' + ', a.product_name, b.product_name), r.lift FROM
  (SELECT * FROM rules ORDER BY lift DESC, product_a, product_b LIMIT 10) r
  LEFT JOIN names a ON r.product_a = a.item LEFT JOIN names b ON r.product_b = b.item"""

FORECAST_REPORT = f"""SELECT 'split' AS section, CASE WHEN is_train THEN 'train weeks' ELSE 'test weeks' END AS metric,
  CAST(count(*) AS DOUBLE) AS value FROM split GROUP BY is_train
UNION ALL SELECT metric, 'Trend', value FROM (UNPIVOT ({METRICS}) ON COLUMNS(*) INTO NAME metric VALUE value)"""


def oracle_sql() -> dict[str, str]:
    clean = (LINES, DIRTY, CLEAN)
    tables = (*clean, TABLES)
    eda = (LINES, REPAIRED, EDA)
    return {
        # Headline figures and trends
        "monthly_trend": q("SELECT * FROM monthly", LINES, MONTHLY),
        "last_six_months": q("SELECT * FROM monthly ORDER BY order_date DESC LIMIT 6", LINES, MONTHLY),
        "peak_and_low_month": q(PEAK_LOW, LINES, MONTHLY),
        "headline_kpis": q(HEADLINE),
        "top_products": q(TOP_PRODUCTS),
        "top_products_by_name": q(
            """SELECT product_name, CAST(sum(sales) AS DOUBLE) AS total_sales,
  arg_min(category, {'d': order_date, 'o': order_id, 'c': category}) AS category
FROM lines GROUP BY product_name ORDER BY sum(sales) DESC, product_name LIMIT 10"""
        ),
        "regional_kpis": q(REGIONAL),
        "regional_share": q(
            f"""SELECT region, CAST(sum(sales) AS DOUBLE) AS total_sales,
  {half_even("CAST(sum(sales) AS DOUBLE) / (SELECT CAST(sum(sales) AS DOUBLE) FROM lines) * 1e2", 1)} AS share_pct
FROM lines GROUP BY region"""
        ),
        "category_summary": q(
            f"""SELECT category, CAST(sum(sales) AS DOUBLE) AS total_sales,
  {half_even("CAST(sum(CAST(profit_margin_pct AS DECIMAL(18,2))) AS DOUBLE) / count(*)", 2)} AS avg_margin_pct,
  count(DISTINCT order_id) AS order_count FROM eda GROUP BY category""", *eda),
        "category_sales": q("SELECT category, CAST(sum(sales) AS DOUBLE) AS total_sales FROM lines GROUP BY category"),
        "sales_heatmap": q(_heatmap()),
        "date_range": q("SELECT min(order_date) AS first_date, max(order_date) AS last_date FROM lines"),
        "kpi_report": q(
            f"""SELECT 'headline' AS section, metric, round(value, 6) AS value FROM (
  UNPIVOT (SELECT total_sales, total_profit, profit_margin_pct, CAST(total_orders AS DOUBLE) AS total_orders,
                  CAST(total_customers AS DOUBLE) AS total_customers, average_order_value, customer_lifetime_value,
                  CAST(repeat_customers AS DOUBLE) AS repeat_customers, repeat_customer_rate_pct FROM ({HEADLINE}))
  ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'monthly sales', strftime(order_date, '%Y-%m'), total_sales FROM (SELECT * FROM monthly ORDER BY order_date DESC LIMIT 6)
UNION ALL SELECT 'regional sales', region, total_sales FROM ({REGIONAL})
UNION ALL SELECT 'regional share', region, sales_share_pct FROM ({REGIONAL})
UNION ALL SELECT 'top products', CAST(product_id AS VARCHAR), total_sales FROM ({TOP_PRODUCTS})""", LINES, MONTHLY),
        # Features
        "net_amounts": q("SELECT order_id, product_id, quantity, " + doubles("discount", "sales", "profit") + " FROM lines"),
        "time_features": q(f"SELECT order_id, product_id, order_date, {TIME_FEATURES}, strftime(order_date, '%b') AS month_name, "
                           "strftime(order_date, '%Y-%m') AS month_label FROM lines"),
        "shipping_features": q("SELECT order_id, product_id, order_date, ship_date, days_to_ship FROM eda", *eda),
        "financial_features": q("SELECT order_id, product_id, unit_price, profit_margin_pct, discount_bucket FROM eda", *eda),
        "discount_buckets": q("SELECT discount_bucket, count(*) AS line_count, CAST(sum(sales) AS DOUBLE) AS total_sales "
                              "FROM eda GROUP BY discount_bucket", *eda),
        "customer_features": q(
            f"""SELECT *, customer_lifetime_order_count > 1 AS is_repeat_customer FROM (
  SELECT *, max(customer_total_orders_to_date) OVER (PARTITION BY customer_id) AS customer_lifetime_order_count FROM (
    SELECT order_id, product_id, customer_id, order_date, {CUSTOMER_WINDOWS} FROM lines))"""),
        "order_features": q(
            """SELECT order_id, product_id, order_total_sales, CASE WHEN order_total_sales < 2000 THEN 'Small'
  WHEN order_total_sales < 15000 THEN 'Medium' ELSE 'Large' END AS order_size_category
FROM (SELECT order_id, product_id, CAST(sum(sales) OVER (PARTITION BY order_id) AS DOUBLE) AS order_total_sales FROM lines)"""),
        "feature_table": q(
            f"""SELECT * EXCLUDE (order_total_sales, sales, discount, profit), {doubles('order_total_sales', 'sales', 'discount', 'profit')},
  customer_lifetime_order_count > 1 AS is_repeat_customer,
  CASE WHEN order_total_sales < 2000 THEN 'Small' WHEN order_total_sales < 15000 THEN 'Medium' ELSE 'Large' END AS order_size_category
FROM (
  SELECT *, max(customer_total_orders_to_date) OVER (PARTITION BY customer_id) AS customer_lifetime_order_count FROM (
    SELECT *, {TIME_FEATURES}, CAST(date_diff('day', order_date, ship_date) AS INTEGER) AS days_to_ship, {FINANCIALS},
           {CUSTOMER_WINDOWS}, sum(sales) OVER (PARTITION BY order_id) AS order_total_sales
    FROM summary))""", *tables),
        "seasonal_weight": q(
            """SELECT order_date, CAST(w AS DOUBLE) AS seasonal_weight, CAST(total_sales AS DOUBLE) AS total_sales,
  round(CAST(total_sales AS DOUBLE) / CAST(w AS DOUBLE), 6) AS deseasonalized_sales
FROM (SELECT order_date, sum(sales) AS total_sales,
        CASE WHEN month(order_date) IN (10, 11) THEN 1.6 WHEN month(order_date) = 1 THEN 1.3
             WHEN month(order_date) = 12 THEN 1.2 ELSE 1.0 END AS w
      FROM lines GROUP BY order_date)"""),
        "business_keys": """SELECT printf('ORD-%06d', l_orderkey + 1) AS order_key, printf('PROD-%05d', l_partkey + 1) AS product_key,
  printf('CUST-%05d', o_custkey + 1) AS customer_key FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "display_names": """SELECT p_partkey AS product_id, split_part(p_name, ' ', 1) || ' ' ||
  CASE WHEN split_part(p_name, ' ', 2) LIKE '%s' THEN left(split_part(p_name, ' ', 2), -1) ELSE split_part(p_name, ' ', 2) END
  AS display_name FROM part""",
        # Cleaning
        "dirty_lines": q(f"SELECT {ALL_LINE_COLUMNS} FROM dirty", LINES, DIRTY),
        "null_profile": q("SELECT * FROM (" + _null_counts("dirty", ["customer_name", "discount"]) + ") WHERE null_count > 0",
                          LINES, DIRTY),
        "fill_missing": q(f"SELECT {ALL_LINE_COLUMNS} FROM filled", *clean),
        "fill_decisions": q(
            """SELECT 'customer_name' AS column_name, count(*) AS filled_count, 'Guest Customer' AS filled_with FROM dirty WHERE customer_name IS NULL
UNION ALL SELECT 'discount', count(*), '0.0' FROM dirty WHERE discount IS NULL""", LINES, DIRTY),
        "dedup_rows": q(f"SELECT {ALL_LINE_COLUMNS} FROM distinct_rows", *clean),
        "convert_types": q(
            f"""SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
  CAST(product_id AS VARCHAR) AS product_id) FROM (SELECT {ALL_LINE_COLUMNS} FROM dirty)""", LINES, DIRTY),
        "category_profile": q(
            "SELECT column_name, CAST(position AS INTEGER) AS position, value, row_count, "
            + half_even("CAST(row_count AS DOUBLE) / n * 1e2", 2)
            + " AS share_pct, distinct_values <= 20 AS is_complete FROM (SELECT *, count(*) OVER (PARTITION BY column_name) AS distinct_values, "
            "CAST(sum(row_count) OVER (PARTITION BY column_name) AS BIGINT) AS n, "
            "row_number() OVER (PARTITION BY column_name ORDER BY row_count DESC, value) AS position FROM ("
            + "\nUNION ALL\n".join(
                f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS row_count FROM dirty WHERE {c} IS NOT NULL GROUP BY ALL"
                for c in CATEGORY_COLUMNS)
            + ")) WHERE position <= 20", LINES, DIRTY),
        "conversion_report": q("\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, 'string' AS type_before, '{kind.lower()}' AS type_after, count({c}) AS given, "
            f"count(*) FILTER ({c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS {sql_kind}) IS NULL) AS unparsed FROM dirty"
            for c, kind, sql_kind in CONVERTED), LINES, DIRTY),
        "rule_violations": q(
            """SELECT 'ship_date before order_date' AS rule, count(*) AS violations FROM typed WHERE ship_date < order_date HAVING count(*) > 0
UNION ALL SELECT 'sales <= 0', count(*) FROM typed WHERE sales <= 0 HAVING count(*) > 0
UNION ALL SELECT 'quantity <= 0', count(*) FROM typed WHERE sales > 0 AND quantity <= 0 HAVING count(*) > 0""", *clean),
        "repaired_ship_dates": q("SELECT order_id, product_id, order_date, ship_date FROM repaired", LINES, REPAIRED),
        "clean_table": q(f"SELECT {ALL_LINE_COLUMNS} FROM clean", *clean),
        "iqr_outliers": q(
            "SELECT metric, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower_bound, 6) AS lower_bound, "
            f"round(upper_bound, 6) AS upper_bound, outliers, {half_even('CAST(outliers AS DOUBLE) / n * 1e2', 2)} AS outlier_pct "
            f"FROM ({_fences()})", *clean),
        "outlier_flags": q(
            f"""SELECT order_id, product_id, {doubles('sales', 'profit')},
  NOT CAST(sales AS DOUBLE) BETWEEN f.lower_bound AND f.upper_bound AS is_sales_outlier,
  NOT CAST(profit AS DOUBLE) BETWEEN g.lower_bound AND g.upper_bound AS is_profit_outlier
FROM clean, (SELECT * FROM fences WHERE metric = 'sales') f, (SELECT * FROM fences WHERE metric = 'profit') g""",
            *clean, f"fences AS ({_fences()})"),
        "shape_audit": q(
            """SELECT (SELECT count(*) FROM dirty) AS rows_before, 19 AS columns_before,
  (SELECT count(*) FROM dirty) - (SELECT count(*) FROM distinct_rows) AS copies_removed,
  (SELECT count(*) FROM clean) AS rows_after, 19 AS columns_after""", *clean),
        "cleaning_report": q(
            f"""SELECT 'shape' AS section, 'rows_before' AS metric, CAST(count(*) AS DOUBLE) AS value FROM dirty
UNION ALL SELECT 'shape', 'copies_removed', CAST((SELECT count(*) FROM dirty) - (SELECT count(*) FROM distinct_rows) AS DOUBLE)
UNION ALL SELECT 'shape', 'rows_after', CAST(count(*) AS DOUBLE) FROM clean
UNION ALL SELECT 'missing', 'customer_name', CAST(count(*) AS DOUBLE) FROM dirty WHERE customer_name IS NULL
UNION ALL SELECT 'missing', 'discount', CAST(count(*) AS DOUBLE) FROM dirty WHERE discount IS NULL
UNION ALL SELECT 'rules', 'ship_date before order_date', CAST(count(*) AS DOUBLE) FROM typed WHERE ship_date < order_date
UNION ALL SELECT 'outliers', metric, CAST(outliers AS DOUBLE) FROM ({_fences()})""", *clean),
        "one_pass_cleaning_audit": q(_observed_audit(), LINES, DIRTY, BROKEN),
        # Normalized tables and audits
        "dim_customers": q("SELECT * FROM dim_customer", *tables),
        "dim_products": q("SELECT * FROM dim_product", *tables),
        "order_headers": q("SELECT * FROM header", *tables),
        "dim_customers_by_batches": q("SELECT * FROM dim_customer", *tables),
        "dim_products_by_batches": q("SELECT * FROM dim_product", *tables),
        "order_headers_by_batches": q("SELECT * FROM header", *tables),
        "order_items": q(f"SELECT order_item_id, order_id, product_id, quantity, {doubles('sales', 'discount', 'profit')} FROM item", *tables),
        "order_summary_view": q(
            f"SELECT order_item_id, {ALL_LINE_COLUMNS} FROM summary", *tables),
        "audit_primary_keys": """SELECT table_name, key_columns, count(*) FILTER (n > 1) AS repeated_keys,
  CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM (
  SELECT 'customers' AS table_name, 'c_custkey' AS key_columns, count(*) AS n FROM customer GROUP BY c_custkey
  UNION ALL SELECT 'products', 'p_partkey', count(*) FROM part GROUP BY p_partkey
  UNION ALL SELECT 'orders', 'o_orderkey', count(*) FROM orders GROUP BY o_orderkey
  UNION ALL SELECT 'order_items', 'l_orderkey,l_linenumber', count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber
) GROUP BY table_name, key_columns""",
        "audit_foreign_keys": """SELECT 'orders' AS child_table, 'customers' AS parent_table, 'o_custkey' AS key_column,
  count(DISTINCT o_custkey) AS orphan_keys, count(*) AS orphan_rows
FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'order_items', 'orders', 'l_orderkey', count(DISTINCT l_orderkey), count(*)
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'order_items', 'products', 'l_partkey', count(DISTINCT l_partkey), count(*)
FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)""",
        "audit_not_null": q(_null_counts("dirty", [c.split(" ")[0] for c in
                            "order_id order_date ship_date ship_mode customer_id customer_name segment country city state region "
                            "product_id category sub_category product_name sales quantity discount profit".split()]), LINES, DIRTY),
        "audit_checks": q(
            """SELECT 'ship_date >= order_date' AS check_name, count(*) FILTER (ship_date < order_date) AS broken_rows FROM dirty
UNION ALL SELECT 'sales > 0', count(*) FILTER (NOT sales > 0) FROM dirty
UNION ALL SELECT 'quantity > 0', count(*) FILTER (NOT quantity > 0) FROM dirty
UNION ALL SELECT 'discount between 0 and 1', count(*) FILTER (NOT discount BETWEEN 0 AND 1) FROM dirty""", LINES, DIRTY),
        "audit_lengths": q(_length_checks(), LINES, DIRTY),
        "audit_table_keys": q("\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, '{key}' AS key_columns, count(*) FILTER (n > 1) AS repeated_keys, "
            f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows FROM (SELECT count(*) AS n FROM {source} GROUP BY {key})"
            for source, name, key in (("dim_customer", "customers", "customer_id"), ("dim_product", "products", "product_id"),
                                      ("header", "orders", "order_id"), ("item", "order_items", "order_item_id"))), *tables),
        "audit_tables": q(_table_audit(), *tables),
        # Exploratory statistics
        "eda_report": q(_eda_report(), *eda, MONTHLY),
        "describe_numeric": q(_per_column(
            """SELECT '{c}' AS metric, count({v}) AS count, round(avg({v}), 7) AS mean, round(stddev_samp({v}), 6) AS std,
  round(min({v}), 6) AS min, round(quantile_cont({v}, 0.25), 6) AS p25, round(quantile_cont({v}, 0.5), 6) AS p50,
  round(quantile_cont({v}, 0.75), 6) AS p75, round(max({v}), 6) AS max FROM {source}"""), *eda),
        "quantile_sketch_checks": q(
            "SELECT metric, CAST(unnest([0.25, 0.5, 0.75]) AS DOUBLE) AS prob, rows, TRUE AS within FROM ("
            + _per_column("SELECT '{c}' AS metric, count({v}) AS rows FROM {source}") + ")", *eda),
        "distinct_sketch_checks": q(_distinct_checks()),
        "skew_kurtosis": q(
            "SELECT metric, round(skewness, 6) AS skewness, round(kurtosis, 6) AS kurtosis, CASE WHEN skewness > 0.5 THEN "
            "'right-skewed' WHEN skewness < -0.5 THEN 'left-skewed' ELSE 'roughly symmetric' END AS shape FROM ("
            + _per_column(
                """SELECT '{c}' AS metric, avg(pow(({v} - m) / s, 3)) AS skewness, avg(pow(({v} - m) / s, 4)) - 3 AS kurtosis
FROM {source}, (SELECT avg({v}) AS m, stddev_pop({v}) AS s FROM {source})""") + ")", *eda),
        "correlation_matrix": q(_correlations(), *eda),
        "correlation_extremes": q(EXTREMES, *eda, "signed AS (" + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS metric, round(corr(CAST(sales AS DOUBLE), CAST({c} AS DOUBLE)), 6) AS value FROM eda"
            for c in DESCRIBED_COLUMNS if c != "sales") + ")"),
        "histogram": q(HISTOGRAM, LINES, REPAIRED),
        "density_curve": q(DENSITY, LINES, REPAIRED),
        "density_curve_binned": q(BINNED_DENSITY, *eda),
        "box_summary": q(_box("eda", CHARTED_COLUMNS), *eda),
        "box_by_category": q(_box("eda", ["profit_margin_pct"], "category"), *eda),
        "bounded_sample": q(
            f"""SELECT CAST(discount AS DOUBLE) AS discount, profit_margin_pct, category FROM eda
ORDER BY md5(concat_ws('|', CAST(order_id AS VARCHAR), CAST(product_id AS VARCHAR), CAST(ship_date AS VARCHAR),
  CAST(quantity AS VARCHAR), CAST(discount AS VARCHAR), CAST(sales AS VARCHAR), CAST(profit AS VARCHAR))), discount,
  profit_margin_pct, category LIMIT 2000""", *eda),
        "loss_share_by_bucket": q(
            """SELECT discount_bucket, count(*) AS line_count, count(*) FILTER (profit_margin_pct < 0) AS loss_lines,
  CAST(count(*) FILTER (profit_margin_pct < 0) AS DOUBLE) / count(*) AS loss_share FROM eda GROUP BY discount_bucket""", *eda),
        "table_shape": q("SELECT count(*) AS row_count, 19 AS column_count FROM lines"),
        # Segmentation
        "rfm": q("SELECT * FROM rfm", LINES, RFM),
        "rfm_scaled": q(
            "SELECT customer_id, " + ", ".join(
                f"round((ln(1 + {c}) - (SELECT avg(ln(1 + {c})) FROM rfm)) / (SELECT stddev_pop(ln(1 + {c})) FROM rfm), 6) AS {c}_z"
                for c in ("recency_days", "frequency", "monetary")) + " FROM rfm", LINES, RFM),
        "cluster_scores": f"WITH {LINES}, {RFM}, {CLUSTER_SCORES}",
        "cluster_profile": q(
            """SELECT cluster, round(recency_days, 6) AS recency_days, round(frequency, 6) AS frequency, round(monetary, 6) AS monetary, recency_rank, frequency_rank, monetary_rank, composite_rank, segment FROM profile""",
            LINES, RFM, PROFILE),
        "segment_labels": q(
            """SELECT customer_id, c.recency_days, c.frequency, c.monetary, cluster, segment
FROM clustered c JOIN (SELECT cluster, segment FROM profile) USING (cluster)""", LINES, RFM, PROFILE),
        "segment_sizes": q(
            f"""SELECT segment, count(*) AS customers, {half_even('avg(c.recency_days)', 1)} AS recency_days,
  {half_even('avg(c.frequency)', 1)} AS frequency, {half_even('avg(c.monetary)', 1)} AS monetary,
  CASE segment WHEN 'Champions' THEN 'reward loyalty and offer new products first'
    WHEN 'Loyal Customers' THEN 'offer upgrades and complementary products'
    WHEN 'At Risk' THEN 'win back before the customer leaves' ELSE 're-engage at low cost by mail' END AS action
FROM clustered c JOIN (SELECT cluster, segment FROM profile) USING (cluster) GROUP BY segment""", LINES, RFM, PROFILE),
        "segment_points": q(
            """SELECT customer_id, segment, c.frequency, c.monetary, 300e0 / (c.recency_days + 10) AS point_size
FROM clustered c JOIN (SELECT cluster, segment FROM profile) USING (cluster)""", LINES, RFM, PROFILE),
        "segment_report": q(_segment_report(), LINES, RFM, PROFILE),
        "k_sweep_checks": q(
            """SELECT CAST(k AS INTEGER) AS clusters, (SELECT count(*) FROM rfm) AS customers, CAST(0 AS BIGINT) AS not_nearest,
  TRUE AS inertia_matches, CAST(1 AS INTEGER) AS selected FROM range(2, 9) t(k)""", LINES, RFM),
        # Market baskets
        "rule_report": q(RULE_REPORT, LINES, ITEMS, RULES, NAMES),
        "baskets": q(
            "SELECT order_id, string_agg(item, ',' ORDER BY item) AS items, CAST(count(*) AS INTEGER) AS item_count FROM bought GROUP BY order_id",
            LINES, ITEMS),
        "item_names": q(
            """SELECT sub_category || '/' || category AS item, product_name FROM lines
QUALIFY row_number() OVER (PARTITION BY sub_category, category ORDER BY order_date, order_id, product_name) = 1"""),
        "item_counts": q("SELECT * FROM counts", LINES, ITEMS),
        "pair_counts": q("SELECT item_a, item_b, co_occurrence_count FROM measured WHERE support >= 1e-3", LINES, ITEMS, RULES),
        "itemsets": q(
            f"SELECT items, size, order_count, {half_even('CAST(order_count AS DOUBLE) / n', 5)} AS support FROM (" + "\nUNION ALL\n".join(
                f"SELECT concat_ws(',', {', '.join(f'{t}.item' for t in 'abcd'[:k])}) AS items, {k} AS size, count(*) AS order_count FROM brand a "
                + " ".join(f"JOIN brand {b} ON {b}.order_id = a.order_id AND {p}.item < {b}.item" for p, b in zip("abc", "bcd"[: k - 1]))
                + " GROUP BY ALL" for k in (2, 3, 4))
            + "), (SELECT count(DISTINCT order_id) AS n FROM brand) WHERE CAST(order_count AS DOUBLE) / n >= 1e-3",
            LINES, "brand AS (SELECT DISTINCT order_id, sub_category AS item FROM lines)"),
        "association_rules": q("SELECT * FROM rules", LINES, ITEMS, RULES),
        "recommendations": q(
            """SELECT product, CAST(rank AS INTEGER) AS rank, recommended, lift FROM (
  SELECT *, row_number() OVER (PARTITION BY product ORDER BY lift DESC, product_a, product_b) AS rank FROM (
    SELECT product_a AS product, product_b AS recommended, * FROM rules
    UNION ALL SELECT product_b, product_a, * FROM rules))
WHERE rank <= 5""", LINES, ITEMS, RULES),
        "recommendation_lists": q(
            """SELECT product, string_agg(recommended, ',' ORDER BY rank) AS recommended FROM (
  SELECT *, row_number() OVER (PARTITION BY product ORDER BY lift DESC, product_a, product_b) AS rank FROM (
    SELECT product_a AS product, product_b AS recommended, * FROM rules
    UNION ALL SELECT product_b, product_a, * FROM rules))
WHERE rank <= 5 GROUP BY product""", LINES, ITEMS, RULES),
        "rules_top10": q(
            """SELECT a.product_name AS name_a, b.product_name AS name_b, r.* FROM
  (SELECT * FROM rules ORDER BY lift DESC, product_a, product_b LIMIT 10) r
  LEFT JOIN names a ON r.product_a = a.item LEFT JOIN names b ON r.product_b = b.item""",
            LINES, ITEMS, RULES,
            """names AS (SELECT sub_category || '/' || category AS item, product_name FROM lines
  QUALIFY row_number() OVER (PARTITION BY sub_category, category ORDER BY order_date, order_id, product_name) = 1)"""),
        "rule_evidence": q(
            """SELECT (SELECT n FROM total) AS orders, (SELECT count(*) FROM counts) AS products,
  (SELECT count(*) * (count(*) - 1) // 2 FROM counts) AS possible_pairs, count(*) AS rules,
  count(*) FILTER (co_occurrence_count < 10) AS thin_rules FROM rules""", LINES, ITEMS, RULES),
        # Forecasting
        "model_checks": q(
            """SELECT model, (SELECT count(*) FROM split WHERE NOT is_train) AS held_out_weeks, TRUE AS holds
FROM (VALUES ('Linear Regression'), ('Random Forest'), ('Harmonic Regression')) t(model)""", LINES, weekly()),
        "forecast_report": q(FORECAST_REPORT, LINES, weekly()),
        "weekly_sales": q("SELECT week_end, total_sales FROM weekly", LINES, weekly()),
        "weekly_features": q("SELECT * FROM features", LINES, weekly()),
        "chronological_split": q("SELECT week_end, total_sales, time_index, is_train FROM split", LINES, weekly()),
        "split_bounds": q(
            "SELECT is_train, min(week_end) AS first_week, max(week_end) AS last_week, count(*) AS weeks FROM split GROUP BY is_train",
            LINES, weekly()),
        "series_trend_forecast": q(TREND, LINES, weekly("region, category")),
        "forecast_metrics": q(METRICS, LINES, weekly()),
    }
