"""The registered queries once more, as DuckDB SQL over the same tables.

Written apart from the Spark plans: money is whole cents, averages are rounded
in integers, and medians, dates and ranks use what DuckDB has of its own.
"""

from __future__ import annotations


def half_up(total: str, count: str, digits: int) -> str:
    """total / count of non-negative integers, rounded half up, as a double."""
    scale = 10**digits
    return f"CAST((2 * {scale} * {total} + {count}) // (2 * {count}) AS DOUBLE) / {scale}"


def stored(value: str, digits: int = 4) -> str:
    """A non-negative double of so many digits, rounded half up to the two that are stored."""
    step = 10 ** (digits - 2)
    return f"CAST((CAST(round({value} * {10**digits}) AS BIGINT) + {step // 2}) // {step} AS DOUBLE) / 100"


def cents(total: str) -> str:
    return f"CAST({total} AS DOUBLE) / 100"


SALES = """
WITH lines AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS price
  FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_quantity, l_extendedprice, l_discount) = 1
),
sales AS (
  SELECT
    l_orderkey || '-' || l_linenumber AS order_id,
    lower(trim(p_name)) AS product_name,
    lower(trim(p_type)) AS category,
    CAST(l_quantity AS BIGINT) AS quantity,
    price,
    CAST(round(l_discount * 100) AS BIGINT) AS discount,
    CASE lower(r_name[1]) WHEN 'n' THEN 'North' WHEN 'e' THEN 'East' WHEN 'w' THEN 'West'
      WHEN 's' THEN 'South' ELSE lower(r_name) END AS region,
    CASE WHEN l_orderkey % 10 <> 0 THEN CAST(l_shipdate AS DATE) END AS sale_date,
    CASE WHEN o_custkey % 4 <> 0 THEN 'customer' || o_custkey || '@example.com' END
      AS customer_email,
    (CAST(l_quantity AS BIGINT) * price * (100 - CAST(round(l_discount * 100) AS BIGINT)) + 50)
      // 100 AS revenue
  FROM lines
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
)"""

RAW = r"""
WITH numbered AS (
  SELECT *, l_orderkey * 7 + l_linenumber AS v,
    CAST(CAST(l_quantity AS INT) AS VARCHAR) AS units,
    CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS price,
    'customer' || o_custkey || '@example.com' AS email
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
),
raw AS (
  SELECT v, l_orderkey || '-' || l_linenumber AS order_id,
    CASE v % 5 WHEN 1 THEN '  ' || upper(p_name) || chr(9) WHEN 2 THEN '' WHEN 3 THEN upper(p_name)
      WHEN 4 THEN '   ' ELSE p_name END AS product_name,
    CASE v % 8 WHEN 1 THEN lower(p_type) WHEN 2 THEN 'home applicance' WHEN 3 THEN 'Electronic'
      WHEN 4 THEN 'electronics gadgets' WHEN 5 THEN '' WHEN 6 THEN '  FURNITURE '
      WHEN 7 THEN 'home electronic items' ELSE p_type END AS category,
    CASE v % 7 WHEN 1 THEN '0' WHEN 2 THEN '-5' WHEN 3 THEN 'abc' WHEN 4 THEN ' ' || units || ' '
      WHEN 5 THEN '3.0' WHEN 6 THEN '+' || units ELSE units END AS quantity,
    CASE v % 6 WHEN 4 THEN 'n/a' WHEN 5 THEN '1e3'
      ELSE CASE v % 6 WHEN 3 THEN '-' ELSE '' END || (price // 100) || '.'
        || lpad(CAST(price % 100 AS VARCHAR), 2, '0') END AS unit_price,
    CASE v % 4 WHEN 0 THEN CAST(v % 140 - 10 AS VARCHAR)
      WHEN 1 THEN CAST(CAST(round(l_discount * 100) AS INT) AS VARCHAR)
      WHEN 2 THEN '' ELSE '99.9' END AS discount_percent,
    CASE v % 6 WHEN 2 THEN 'nort' WHEN 3 THEN '  ' || r_name || ' ' WHEN 4 THEN ''
      WHEN 5 THEN lower(n_name) ELSE r_name END AS region,
    CASE v % 8 WHEN 1 THEN strftime(l_shipdate, '%d/%m/%Y')
      WHEN 2 THEN strftime(l_shipdate, '%m-%d-%Y')
      WHEN 3 THEN strftime(l_shipdate, '%B %-d, %Y') WHEN 4 THEN ''
      WHEN 5 THEN strftime(l_shipdate, '%m/%d/%Y')
      WHEN 6 THEN '  ' || strftime(l_shipdate, '%Y-%m-%d') || ' ' WHEN 7 THEN 'not-a-date'
      ELSE strftime(l_shipdate, '%Y-%m-%d') END AS sale_date,
    CASE v % 5 WHEN 1 THEN ' ' || email || ' ' WHEN 2 THEN 'customer.example.com'
      WHEN 3 THEN 'customer' || o_custkey || '@example.net' WHEN 4 THEN '' ELSE email END
      AS customer_email
  FROM numbered
)"""

LINES = (
    RAW
    + """,
csv AS (
  SELECT v, concat_ws(',', order_id,
      CASE WHEN v % 17 = 0 THEN '"say ""' || product_name || '"", ok"' ELSE product_name END,
      category, quantity, unit_price, discount_percent, region,
      CASE WHEN contains(sale_date, ',') THEN '"' || sale_date || '"' ELSE sale_date END,
      CASE WHEN v % 19 = 0 THEN '"' ELSE '' END || customer_email) AS head
  FROM raw
),
csv_lines AS (
  SELECT CASE WHEN v % 13 = 0 THEN head WHEN v % 23 = 0 THEN head || ',0.0,extra'
      ELSE head || ',0.0' END AS line
  FROM csv
),
split AS (
  SELECT line, list_transform(
      regexp_extract_all(',' || line, ',((?:[^",]|"[^"]*(?:"|$))*)', 1),
      lambda f: trim(replace(f, '"', ''), ' ' || chr(9))) AS f
  FROM csv_lines
)"""
)


def _cleaned(source: str, keep: str = "") -> str:
    """Cleaned rows of a relation with the raw columns, money still double."""
    return f"""
parsed AS (
  SELECT {keep}order_id, trim(product_name, ' ' || chr(9)) AS p, lower(trim(category)) AS c,
    trim(quantity) AS q, TRY_CAST(trim(unit_price) AS DOUBLE) AS price,
    coalesce(TRY_CAST(trim(discount_percent) AS DOUBLE), 0) AS d, region AS r,
    trim(sale_date) AS s, customer_email AS e
  FROM {source}
),
typed AS (
  SELECT {keep}order_id,
    CASE WHEN coalesce(p, '') = '' THEN 'Unknown Product' ELSE lower(p) END AS product_name,
    CASE WHEN coalesce(c, '') = '' THEN 'uncategorized'
      WHEN contains(c, 'electronic') THEN split_part(c, 'electronic', 1) || 'electronics'
      ELSE replace(c, 'applicance', 'appliance') END AS category,
    CASE WHEN regexp_full_match(q, '[+-]?[0-9]+')
      THEN greatest(1, CAST(ltrim(q, '+') AS INT)) ELSE 0 END AS quantity,
    coalesce(price, 0) AS unit_price,
    least(greatest(d, 0), 70) AS discount_percent,
    CASE WHEN coalesce(trim(r), '') = '' THEN 'unknown' WHEN r[1] IN ('n', 'N') THEN 'North'
      WHEN r[1] IN ('e', 'E') THEN 'East' WHEN r[1] IN ('w', 'W') THEN 'West'
      WHEN r[1] IN ('s', 'S') THEN 'South' ELSE lower(trim(r)) END AS region,
    strftime(try_strptime(s,
      ['%Y-%m-%d', '%d/%m/%Y', '%m/%d/%Y', '%m-%d-%Y', '%B %d, %Y']), '%Y-%m-%d') AS sale_date,
    CASE WHEN e LIKE '%@%' AND e LIKE '%.com%' THEN trim(e) END AS customer_email
  FROM parsed
),
cleaned AS (
  SELECT *, floor(quantity * unit_price * (100 - discount_percent) + 0.5) / 100 AS revenue
  FROM typed
)"""


CLEAN_ROWS = RAW + "," + _cleaned("raw", "v, ")

MONTHLY = f"""
monthly AS (
  SELECT CAST(year(sale_date) AS BIGINT) AS year, CAST(month(sale_date) AS BIGINT) AS month,
    {cents("sum(revenue)")} AS total_revenue, CAST(sum(quantity) AS BIGINT) AS total_quantity,
    {half_up("sum(discount)", "count(*)", 4)} AS avg_discount,
    count(DISTINCT order_id) AS order_count
  FROM sales WHERE sale_date IS NOT NULL GROUP BY ALL
)"""

STATS = f"""
stats AS (
  SELECT product_name, category, {cents("sum(revenue)")} AS total_revenue,
    CAST(sum(quantity) AS BIGINT) AS total_units_sold,
    {half_up("sum(price)", "count(*)", 0)} / 100 AS avg_unit_price,
    {half_up("sum(discount)", "count(*)", 4)} AS avg_discount
  FROM sales WHERE quantity > 0 GROUP BY product_name, category
),
ranked AS (
  SELECT *,
    row_number() OVER (ORDER BY total_revenue DESC, product_name, category) AS revenue_rank,
    row_number() OVER (ORDER BY total_units_sold DESC, product_name, category) AS units_rank
  FROM stats
)"""

TOP = f"""{STATS},
top AS (
  SELECT * FROM ranked WHERE revenue_rank <= 10
)"""

TWO_STEP = f"""{STATS},
later AS (
  SELECT * EXCLUDE (revenue_rank, units_rank), CAST(NULL AS BIGINT) AS revenue_rank,
    row_number() OVER (ORDER BY total_units_sold DESC, product_name, category) AS units_rank
  FROM ranked WHERE revenue_rank > 10
),
two_step AS (
  SELECT * REPLACE (CAST(NULL AS BIGINT) AS units_rank) FROM ranked WHERE revenue_rank <= 10
  UNION ALL BY NAME
  SELECT * FROM later WHERE units_rank <= 10
)"""

REGIONS = f"""
best AS (
  SELECT region, product_name AS top_product, category AS top_category, sum(revenue) AS earned
  FROM sales GROUP BY region, product_name, category
  QUALIFY row_number() OVER (
    PARTITION BY region ORDER BY sum(revenue) DESC, product_name, category) = 1
),
regions AS (
  SELECT region, {cents("sum(revenue)")} AS total_revenue,
    count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
    {half_up("sum(revenue)", "count(DISTINCT order_id)", 0)} / 100 AS avg_order_value,
    {half_up("sum(discount)", "count(*)", 4)} AS avg_discount,
    any_value(top_product) AS top_product, any_value(top_category) AS top_category,
    round({cents("sum(revenue)")}
      / (SELECT {cents("sum(revenue) FILTER (revenue > 0)")} FROM sales) * 100, 2)
      AS market_share_pct
  FROM sales LEFT JOIN best USING (region) GROUP BY region
)"""


def _categories(median: str) -> str:
    return f"""
medians AS (
  SELECT category, median(discount) AS middle FROM sales
  WHERE category <> '' AND discount >= 0 GROUP BY category
),
categories AS (
  SELECT category, {half_up("sum(discount)", "count(*)", 4)} AS avg_discount,
    CAST(min(discount) AS DOUBLE) AS min_discount, CAST(max(discount) AS DOUBLE) AS max_discount,
    {median} AS median_discount, count(*) AS total_orders,
    {cents("sum(revenue)")} AS total_revenue,
    {cents("sum(price * quantity - revenue)")} AS discount_impact
  FROM sales LEFT JOIN medians USING (category)
  WHERE category <> '' AND discount >= 0 AND price > 0 AND quantity > 0
  GROUP BY category
)"""


CATEGORIES = _categories(half_up("sum(discount)", "count(*)", 4))
CATEGORIES_MEDIAN = _categories("round(any_value(middle), 4)")


def _anomaly(kind: str, score: str, percentile: float, condition: str, source: str = "sales") -> str:
    return f"""(SELECT order_id, product_name, category, region, quantity,
    CAST(price AS DOUBLE) / 100 AS unit_price, CAST(discount AS DOUBLE) AS discount_percent,
    CAST(revenue AS DOUBLE) / 100 AS revenue, strftime(sale_date, '%Y-%m-%d') AS sale_date,
    customer_email, '{kind}' AS anomaly_type, CAST({score} AS DOUBLE) AS anomaly_score,
    CAST({percentile} AS DOUBLE) AS percentile
  FROM {source} WHERE {condition} ORDER BY {score} DESC, order_id LIMIT 5)"""


# Power sums of whole cents, moved to the whole part of the mean; exact up to the last steps.
THRESHOLD = """(
  SELECT (CAST(m AS DOUBLE) + rest
    + 3 * sqrt(greatest(CAST(q - 2 * m * s + m * m * n AS DOUBLE) / n - rest * rest, 0))) / 100
  FROM (
    SELECT *, CAST(s - m * n AS DOUBLE) / n AS rest FROM (
      SELECT *, s // n AS m FROM (
        SELECT count(*) AS n, CAST(sum(CAST(price AS HUGEINT)) AS HUGEINT) AS s,
          CAST(sum(CAST(price AS HUGEINT) * price) AS HUGEINT) AS q
        FROM sales WHERE price > 0))))"""
FLIPPED = """,
flipped AS (
  SELECT * REPLACE (CASE WHEN quantity % 7 = 0 THEN -price ELSE price END AS price,
    CASE WHEN quantity % 7 = 0 THEN -revenue ELSE revenue END AS revenue) FROM sales
)"""
UNCLAMPED = ", unclamped AS (SELECT * REPLACE (quantity * 2.4 AS discount) FROM sales)"

HIGH_REVENUE = _anomaly("HIGH_REVENUE", "revenue / 100", 99.9, "revenue > 0")
HIGH_QUANTITY = _anomaly("HIGH_QUANTITY", "quantity", 99.9, "quantity > 0")
HIGH_DISCOUNT = _anomaly("HIGH_DISCOUNT", "discount", 99.0, "discount >= 100")
NEGATIVE = _anomaly(
    "NEGATIVE_VALUES",
    "abs(least(quantity, price / 100, revenue / 100))",
    0,
    "quantity < 0 OR price < 0 OR revenue < 0",
)
PRICE = _anomaly("PRICE_ANOMALY", "price / 100", 99.5, f"price / 100 > {THRESHOLD}")
ANOMALIES = (
    "anomalies AS ("
    + " UNION ALL ".join([HIGH_REVENUE, HIGH_QUANTITY, HIGH_DISCOUNT, NEGATIVE, PRICE])
    + ")"
)

FIELD_COLUMNS = ", ".join(
    f"f[{i}] AS {name}"
    for i, name in enumerate(
        [
            "order_id",
            "product_name",
            "category",
            "quantity",
            "unit_price",
            "discount_percent",
            "region",
            "sale_date",
            "customer_email",
            "revenue",
        ],
        start=1,
    )
)

STORED = CLEAN_ROWS + """,
stored AS (
  SELECT * REPLACE (CAST(unit_price AS DECIMAL(10, 2)) AS unit_price,
    CAST(discount_percent AS DECIMAL(5, 2)) AS discount_percent,
    CAST(revenue AS DECIMAL(12, 2)) AS revenue,
    coalesce(sale_date, '') AS sale_date, coalesce(customer_email, '') AS customer_email)
  FROM cleaned
),
firsts AS (
  SELECT * FROM stored
  QUALIFY row_number() OVER (
    PARTITION BY order_id
    ORDER BY sale_date = '', product_name, category, quantity, unit_price, discount_percent,
      region, sale_date, customer_email, revenue) = 1
)"""

_MONEY_AS_DOUBLE = """CAST(quantity AS BIGINT) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
    CAST(discount_percent AS DOUBLE) AS discount_percent, CAST(revenue AS DOUBLE) AS revenue"""


def oracle_sql() -> dict[str, str]:
    clean = {
        "clean_product": "product_name",
        "clean_category": "category",
        "clean_quantity": "CAST(quantity AS BIGINT) AS quantity",
        "clean_price": "unit_price",
        "clean_discount": "discount_percent",
        "clean_region": "region",
        "clean_email": "customer_email",
        "parse_date": "sale_date",
        "revenue": "revenue",
    }
    queries = {
        name: f"{CLEAN_ROWS} SELECT order_id, {column} FROM cleaned"
        for name, column in clean.items()
    }
    wide = f"{LINES}, wide AS (SELECT {FIELD_COLUMNS} FROM split WHERE len(f) >= 10)"
    queries |= {
        "csv_parse": f"{LINES} SELECT len(f) AS field_count, {FIELD_COLUMNS} FROM split",
        "row_width_filter": f"{LINES} SELECT f[1] AS order_id, len(f) AS field_count"
        " FROM split WHERE len(f) >= 10",
        "rejects": f"{LINES} SELECT line, 'insufficient columns' AS reason"
        " FROM split WHERE len(f) < 10",
        "clean_sales": f"{wide}, {_cleaned('wide')}"
        " SELECT * REPLACE (CAST(quantity AS BIGINT) AS quantity) FROM cleaned",
        "bulk_load_nullif": f"""{CLEAN_ROWS}
          SELECT order_id, sale_date, customer_email,
            CASE WHEN v % 9 <> 0 THEN product_name END AS product_name,
            CASE WHEN v % 9 <> 1 THEN category END AS category,
            CASE WHEN v % 9 <> 2 THEN CAST(quantity AS BIGINT) END AS quantity,
            CASE WHEN v % 9 <> 3 THEN unit_price END AS unit_price,
            CASE WHEN v % 9 <> 4 THEN discount_percent END AS discount_percent,
            CASE WHEN v % 9 <> 5 THEN region END AS region,
            CASE WHEN v % 9 <> 6 THEN revenue END AS revenue FROM cleaned""",
        "insert_ignore": f"""{STORED}
          SELECT order_id, product_name, category, region, nullif(sale_date, '') AS sale_date,
            nullif(customer_email, '') AS customer_email, {_MONEY_AS_DOUBLE} FROM firsts""",
        "str_to_date": f"""{RAW}
          SELECT order_id, CASE WHEN regexp_full_match(trim(sale_date), '\\d{{4}}-\\d\\d-\\d\\d')
            THEN strftime(CAST(trim(sale_date) AS DATE), '%Y-%m-%d') END AS sale_date FROM raw""",
        "month_label": f"""{SALES} SELECT DISTINCT strftime(sale_date, '%Y-%m') AS month_label
          FROM sales WHERE sale_date IS NOT NULL""",
        "monthly_sales": f"{SALES}, {MONTHLY} SELECT * FROM monthly",
        "rank_global": f"""{SALES}, {STATS}
          SELECT product_name, category, total_revenue, revenue_rank FROM ranked""",
        "join_rank_left": f"{SALES}, {STATS} SELECT * FROM ranked",
        "top_products": f"{SALES}, {TOP} SELECT * FROM top",
        "top_products_two_step": f"{SALES}, {TWO_STEP} SELECT * FROM two_step",
        "region_top_product": f"""{SALES}, {REGIONS}
          SELECT region, top_product AS product_name, top_category AS category,
            {cents("earned")} AS product_revenue FROM best""",
        "region_performance": f"{SALES}, {REGIONS} SELECT * FROM regions",
        "category_discount": f"{SALES}, {CATEGORIES} SELECT * FROM categories",
        "category_discount_median": f"{SALES}, {CATEGORIES_MEDIAN} SELECT * FROM categories",
        "category_median": f"""{SALES} SELECT category,
            round(median(discount), 4) AS median_discount, count(*) AS row_count
          FROM sales WHERE category <> '' AND discount >= 0 GROUP BY category""",
        "price_threshold": f"{SALES} SELECT {THRESHOLD} AS threshold",
        "cross_join_scalar": f"""{SALES} SELECT order_id, CAST(price AS DOUBLE) / 100 AS unit_price,
            t.limit_price AS threshold
          FROM sales CROSS JOIN (SELECT {THRESHOLD} AS limit_price) t
          WHERE price / 100 > t.limit_price""",
        "anomaly_high_revenue": f"{SALES} {HIGH_REVENUE}",
        "anomaly_high_quantity": f"{SALES} {HIGH_QUANTITY}",
        "anomaly_high_discount": f"""{SALES} {UNCLAMPED} {HIGH_DISCOUNT.replace(
            "FROM sales", "FROM unclamped")}""",
        "anomaly_negative": f"{SALES} {FLIPPED} {NEGATIVE.replace('FROM sales', 'FROM flipped')}",
        "anomaly_price": f"{SALES} {PRICE}",
        "anomaly_records": f"{SALES}, {ANOMALIES} SELECT * FROM anomalies",
        "refresh_report": f"""{SALES}, {MONTHLY}, {TOP}, {REGIONS}, {CATEGORIES}, {ANOMALIES}
          SELECT 'monthly_sales_summary' AS table_name, count(*) AS row_count FROM monthly
          UNION ALL SELECT 'top_products', count(*) FROM top
          UNION ALL SELECT 'region_wise_performance', count(*) FROM regions
          UNION ALL SELECT 'category_discount_map', count(*) FROM categories
          UNION ALL SELECT 'anomaly_records', count(*) FROM anomalies""",
        "check_months": f"""{SALES}, {MONTHLY} SELECT count(*) AS total_months,
            min(year) AS earliest_year, max(year) AS latest_year,
            round(sum(total_revenue), 2) AS grand_total_revenue,
            CAST(sum(order_count) AS BIGINT) AS total_orders FROM monthly""",
        "check_products": f"""{SALES}, {TWO_STEP} SELECT count(*) AS total_products,
            count(*) FILTER (revenue_rank <= 10) AS top_revenue_products,
            count(*) FILTER (units_rank <= 10) AS top_units_products,
            max(total_revenue) AS highest_revenue, max(total_units_sold) AS highest_units
          FROM two_step""",
        "check_regions": f"""{SALES}, {REGIONS} SELECT count(*) AS total_regions,
            round(sum(total_revenue), 2) AS grand_total_revenue,
            CAST(sum(total_orders) AS BIGINT) AS grand_total_orders,
            round(avg(market_share_pct), 2) AS avg_market_share,
            max(market_share_pct) AS highest_market_share FROM regions""",
        "check_share_total": f"""{SALES}, {REGIONS}
          SELECT round(sum(market_share_pct), 2) AS total_market_share_pct FROM regions""",
        "check_categories": f"""{SALES}, {CATEGORIES_MEDIAN} SELECT count(*) AS total_categories,
            {half_up(f"sum(CAST(round({stored('avg_discount')} * 100) AS BIGINT))", "count(*)", 2)} / 100
              AS overall_avg_discount,
            round(sum(total_revenue), 2) AS grand_total_revenue,
            round(sum(discount_impact), 2) AS total_discount_impact FROM categories""",
        "check_anomalies": f"""{SALES}, {ANOMALIES} SELECT anomaly_type,
            count(*) AS anomaly_count, round(max(anomaly_score), 2) AS max_score,
            round(min(anomaly_score), 2) AS min_score, round(avg(anomaly_score), 2) AS avg_score
          FROM anomalies GROUP BY anomaly_type""",
        "anomaly_listing": f"""{SALES}, {ANOMALIES} SELECT order_id, product_name, anomaly_type,
            round(anomaly_score, 2) AS anomaly_score, percentile FROM anomalies
          ORDER BY anomaly_type, anomaly_score DESC, order_id""",
        "dash_monthly": f"""{SALES}, {MONTHLY}
          SELECT * REPLACE ({stored("avg_discount")} AS avg_discount),
            format('{{:d}}-{{:02d}}', year, month) AS month_label
          FROM monthly ORDER BY year, month""",
        "dash_top_products": f"""{SALES}, {TOP} SELECT product_name, category, total_revenue,
            total_units_sold, avg_unit_price, revenue_rank FROM top ORDER BY revenue_rank""",
        "top5_products": f"""{SALES}, {TOP} SELECT product_name, category, total_revenue,
            total_units_sold, avg_unit_price, revenue_rank FROM top
          WHERE revenue_rank <= 5 ORDER BY revenue_rank""",
        "product_listing": f"""{SALES}, {TWO_STEP} SELECT product_name, category, total_revenue,
            total_units_sold, revenue_rank, units_rank FROM two_step
          ORDER BY coalesce(revenue_rank, 999), coalesce(units_rank, 999)""",
        "dash_regions": f"""{SALES}, {REGIONS} SELECT region, total_revenue, total_orders,
            market_share_pct, top_product FROM regions ORDER BY total_revenue DESC""",
        "dash_categories": f"""{SALES}, {CATEGORIES} SELECT category,
            {stored("avg_discount")} AS avg_discount, total_revenue,
            total_orders, discount_impact FROM categories
          ORDER BY 2 DESC, category LIMIT 10""",
        "dash_summary": f"""{SALES}, {MONTHLY}, {TOP}, {REGIONS} SELECT
            (SELECT round(sum(total_revenue), 2) FROM monthly) AS total_revenue,
            (SELECT CAST(sum(order_count) AS BIGINT) FROM monthly) AS total_orders,
            (SELECT count(DISTINCT region) FROM regions) AS total_regions,
            (SELECT count(*) FROM top) AS top_products_count""",
    }
    queries["dash_stored"] = queries["dash_summary"]
    fact = """SELECT order_id, product_name, category, CAST(quantity AS BIGINT) AS quantity,
        CAST(price AS DOUBLE) / 100 AS unit_price, CAST(discount AS DOUBLE) AS discount_percent,
        region, strftime(sale_date, '%Y-%m-%d') AS sale_date, customer_email,
        CAST(revenue AS DOUBLE) / 100 AS revenue FROM sales"""
    loaded = f"""SELECT order_id, product_name, category, region, sale_date, customer_email,
        CAST(quantity AS BIGINT) AS quantity, unit_price, discount_percent, revenue FROM cleaned"""
    last = "SELECT f[1] AS k, max(line) AS line FROM split WHERE len(f) >= 10 GROUP BY 1"
    first = last.replace("max(line)", "min(line)").replace("WHERE", "WHERE len(f[1]) % 3 = 0 AND")
    awkward = f"""{LINES}, judged AS (
        SELECT CASE len(line) % 10 WHEN 0 THEN '' WHEN 1 THEN repeat('x', 21) || line ELSE line END
            AS line,
          CASE WHEN len(line) % 10 = 0 THEN 'blank line' WHEN len(f) < 10 THEN 'insufficient columns'
            WHEN len(line) % 10 = 1 THEN 'does not fit the table' END AS reason
        FROM split)"""
    kept = "SELECT DISTINCT line, f FROM split WHERE len(f) >= 10"
    queries |= {
        name: f"""{LINES}, chosen AS ({last}),
          wide AS (SELECT {FIELD_COLUMNS} FROM chosen JOIN ({kept}) USING (line)),
          {_cleaned("wide")} {loaded}"""
        for name in ("stream_ingest", "header_ingest")
    } | {
        "ingest_table": f"""{LINES}, early AS (SELECT * FROM ({first}) JOIN ({kept}) USING (line)),
          late AS (SELECT * FROM ({last}) JOIN ({kept}) USING (line) ANTI JOIN early USING (k)),
          wide AS (SELECT {FIELD_COLUMNS} FROM (FROM early UNION ALL BY NAME FROM late)),
          {_cleaned("wide")} {loaded}""",
        "strict_rejects": f"{awkward} SELECT line, reason FROM judged WHERE reason IS NOT NULL",
        "blank_lines": f"""{awkward} SELECT count(*) FILTER (reason = 'blank line') AS blank_lines,
            count(*) AS rows_read, count(reason) AS rows_rejected FROM judged""",
        "csv_round_trip": f"{SALES} {fact}",
        "bulk_load": f"{SALES} {fact}",
        "csv_merged": f"{SALES} {fact}",
        "bulk_rejects": f"""{RAW} SELECT order_id, CASE
            WHEN trim(quantity) <> '' AND NOT regexp_full_match(trim(quantity), '[+-]?\\d+')
              THEN 'quantity does not fit'
            WHEN trim(unit_price) = 'n/a' THEN 'unit_price does not fit'
            WHEN len(customer_email) % 5 = 0 AND 9 * len(customer_email) > 100
              THEN 'customer_email does not fit' END AS reason
          FROM raw WHERE reason IS NOT NULL""",
        "stream_counts": f"""{LINES} SELECT count(*) AS rows_read,
            count(*) FILTER (len(f) < 10) AS rows_rejected,
            count(DISTINCT f[1]) FILTER (len(f) >= 10) AS rows_written FROM split""",
        "indexed_load": f"{SALES} {fact}",
    }
    monthly_stored = f"SELECT * REPLACE ({stored('avg_discount')} AS avg_discount) FROM monthly"
    region_stored = f"SELECT * REPLACE ({stored('avg_discount')} AS avg_discount) FROM regions"
    product_stored = f"SELECT * REPLACE ({stored('avg_discount')} AS avg_discount) FROM two_step"
    category_stored = f"""SELECT * REPLACE ({stored('avg_discount')} AS avg_discount,
        {stored('median_discount')} AS median_discount) FROM categories"""
    queries |= {
        "refresh_monthly_sales_summary": f"{SALES}, {MONTHLY} {monthly_stored}",
        "refresh_top_products": f"{SALES}, {TWO_STEP} {product_stored}",
        "refresh_region_wise_performance": f"{SALES}, {REGIONS} {region_stored}",
        "refresh_category_discount_map": f"{SALES}, {CATEGORIES_MEDIAN} {category_stored}",
        "refresh_anomaly_records": f"{SALES}, {ANOMALIES} SELECT * FROM anomalies",
    }
    queries["refresh_incremental"] = f"""{SALES}, {MONTHLY}, {TWO_STEP}, {REGIONS}, {CATEGORIES_MEDIAN},
        {ANOMALIES}
        SELECT 'monthly_sales_summary' AS summary, concat_ws('|', year, month) AS item,
          total_revenue AS amount, {stored('avg_discount')} AS rate, order_count AS number FROM monthly
        UNION ALL SELECT 'top_products', concat_ws('|', product_name, category), total_revenue,
          {stored('avg_discount')}, total_units_sold FROM two_step
        UNION ALL SELECT 'region_wise_performance', concat_ws('|', region, top_product),
          total_revenue, market_share_pct, total_orders FROM regions
        UNION ALL SELECT 'category_discount_map', category, discount_impact,
          {stored('median_discount')}, total_orders FROM categories
        UNION ALL SELECT 'anomaly_records', concat_ws('|', anomaly_type, order_id), anomaly_score,
          percentile, quantity FROM anomalies"""
    repeated = "repeated AS (SELECT * REPLACE (split_part(order_id, '-', 1) AS order_id) FROM sales)"
    nameless = """named AS (
        SELECT * REPLACE (CASE WHEN len(product_name) % 3 <> 0 THEN category END AS category) FROM sales)"""
    unnamed = "(product_name IS NULL OR category IS NULL)"
    ordered = STATS.replace("product_name, category)", "product_name, category NULLS FIRST)")
    queries |= {
        "monthly_distinct": f"{SALES}, {repeated}, {MONTHLY.replace('FROM sales', 'FROM repeated')}"
        " SELECT * FROM monthly",
        "region_distinct": f"{SALES}, {repeated}, {REGIONS.replace('FROM sales', 'FROM repeated')}"
        " SELECT * FROM regions",
        "top_products_nameless": f"""{SALES}, {nameless}, {ordered.replace('FROM sales', 'FROM named')}
          SELECT * REPLACE (CASE WHEN {unnamed} THEN 999 ELSE units_rank END AS units_rank)
          FROM ranked WHERE revenue_rank <= 10
          UNION SELECT * REPLACE (CAST(999 AS BIGINT) AS revenue_rank)
          FROM ranked WHERE units_rank <= 10 AND {unnamed}""",
    }
    return queries
