"""The same queries in plain SQL, written against the given tables."""

from __future__ import annotations

# Code points of white space.
_SPACES = "||".join(
    f"chr({code})"
    for code in [
        9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197,
        8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288,
    ]
)


def _mean(total: str, n: str, digits: int) -> str:
    """total / n rounded half up to `digits`, where total has two decimals."""
    scaled = f"(CAST(({total}) * 100 AS HUGEINT) * {10 ** (digits - 2)})"
    rounded = f"((2 * {scaled} + ({n})) // (2 * ({n})))"
    unit = "0." + "0" * (digits - 1) + "1"
    return (
        f"CASE WHEN ({n}) > 0 THEN CAST(CAST({rounded} AS DECIMAL(28,0))"
        f" * CAST({unit} AS DECIMAL({digits + 1},{digits})) AS DECIMAL(22,{digits})) END"
    )


def _percent(part: str, whole: str) -> str:
    rounded = f"((20000 * CAST({part} AS HUGEINT) + ({whole})) // (2 * ({whole})))"
    return (
        f"CASE WHEN ({whole}) = 0 THEN CAST(100 AS DECIMAL(5,2)) ELSE"
        f" CAST(CAST({rounded} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,2)) END"
    )


def _strip(c: str) -> str:
    return f"trim({c}, {_SPACES})"


def _text(c: str) -> str:
    return f"nullif({_strip(c)}, '')"


def _number(c: str) -> str:
    return f"TRY_CAST(replace({_strip(c)}, ',', '') AS DECIMAL(28,10))"


def _integer(c: str) -> str:
    return f"TRY_CAST(trunc({_number(c)}) AS INTEGER)"


_TIME = r"([01]?\d|2[0-3]):[0-5]?\d:([0-5]?\d|6[01])"


def _date(c: str) -> str:
    t = f"substr({_strip(c)}, 1, 25)"
    iso = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}(T{_TIME}(Z|\.\d{{1,6}})?)?$"
    return (
        f"CASE WHEN regexp_matches({t}, '{iso}')"
        f" THEN CAST(try_strptime(split_part({t}, 'T', 1), '%Y-%m-%d') AS DATE)"
        rf" WHEN regexp_matches({t}, '^\d{{1,2}}/\d{{1,2}}/\d{{4}}$') THEN"
        f" CAST(coalesce(try_strptime({t}, '%m/%d/%Y'), try_strptime({t}, '%d/%m/%Y')) AS DATE) END"
    )


def _key(day: str) -> str:
    return f"(year({day}) * 10000 + month({day}) * 100 + day({day}))"


def _money(c: str) -> str:
    return f"CAST({c} AS DECIMAL(22,2))"


# ------------------------------------------------------------ the star schema

_COST = (
    "CASE WHEN p_size % 10 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(10,2))"
    " * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(10,2)) END"
)

PRODUCTS = f"""products AS (
  SELECT p_partkey AS product_key, 'P' || p_partkey || '-csv' AS product_id, p_name AS title,
    p_type AS category, CAST(p_retailprice AS DECIMAL(10,2)) AS price, {_COST} AS cost,
    p_size AS stock_quantity, p_brand AS supplier, p_size % 7 <> 0 AS is_current
  FROM part)"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_key, 'C' || c_custkey || '-csv' AS customer_id,
    c_name AS full_name, lower(replace(c_name, '#', '')) || '@example.com' AS email,
    'City ' || c_nationkey AS city, CASE WHEN n_nationkey % 11 <> 0 THEN n_name END AS country,
    CASE WHEN n_nationkey % 11 <> 0 THEN r_name END AS region,
    c_mktsegment AS customer_segment, c_custkey % 13 <> 0 AS is_current
  FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
    ON c_nationkey = n_nationkey)"""

FACTS = """facts AS (
  SELECT CAST(l_shipdate AS DATE) AS day, l_partkey AS product_key, o_custkey AS customer_key,
    l_orderkey || '-' || l_linenumber AS sale_id, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount,
    CASE WHEN l_returnflag <> 'R' THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2))
      * CAST(0.55 AS DECIMAL(3,2)) AS DECIMAL(12,2)) END AS cost_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_PROFIT = "sum(f.total_amount) - coalesce(sum(f.cost_amount), 0)"

LOG = f"""runs AS (
  SELECT *, CAST(floor(value * 10) AS BIGINT) AS received FROM events),
log AS (
  SELECT 'batch-' || user_id AS batch_id,
    CASE WHEN event_id % 3 = 0 THEN 'csv_ingestion' ELSE 'api_ingestion' END AS pipeline_name,
    event_type AS source_name, CASE WHEN event_id % 3 = 0 THEN 'csv' ELSE 'api' END AS source_type,
    received AS records_received,
    CASE WHEN event_id % 3 = 0 THEN received ELSE received * 95 // 100 END AS records_stored,
    CASE WHEN event_id % 3 = 0 THEN 0 ELSE received - received * 95 // 100 END AS records_rejected,
    ts AS created_at, value,
    CASE WHEN event_type = 'error' THEN 'failed'
      WHEN event_id % 3 <> 0 AND received - received * 95 // 100 > 0 THEN 'partial'
      ELSE 'success' END AS status
  FROM runs),
scored AS (
  SELECT *, {_percent("records_stored", "records_received")} AS quality_score,
    CAST(epoch(date_trunc('second', created_at
      + to_microseconds(CAST(round(value * 1000000) AS BIGINT))))
      - epoch(date_trunc('second', created_at)) AS BIGINT) AS duration_seconds
  FROM log)"""

_K = "CAST(json_extract(props, '$.k') AS INTEGER)"

DETAILS = f"""details AS (
  SELECT 'batch-' || user_id AS batch_id, event_type AS source_name,
    CASE {_K} % 3 WHEN 0 THEN 'price must be positive'
      WHEN 1 THEN 'title cannot be null or empty' ELSE 'missing_key' END AS rejection_reason,
    {_K} % 10 + 1 AS rejection_count
  FROM events)"""

# ------------------------------------------------------------- received text


def _grouped(amount: str) -> str:
    return (
        f"CASE WHEN {amount} >= 1000 THEN CAST(floor({amount} / 1000) AS BIGINT) || ','"
        f" || right(CAST({amount} AS VARCHAR), 6) ELSE CAST({amount} AS VARCHAR) END"
    )


RAW_SALES = f"""priced AS (
  SELECT *, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS INTEGER) AS q,
    l_orderkey || '-' || l_linenumber AS id,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS total,
    CAST(CAST((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS INTEGER))
      // (2 * CAST(l_quantity AS INTEGER)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))
      AS DECIMAL(12,2)) AS unit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
raw_sales AS (
  SELECT
    CASE WHEN l_orderkey % 1013 = 0 THEN '  '
      WHEN l_orderkey % 3 = 0 THEN ' ' || id || chr(9) ELSE id END AS sale_id,
    'C' || o_custkey AS customer_id, 'P' || l_partkey AS product_id,
    CASE WHEN l_orderkey % 97 = 0 THEN 'abc' WHEN l_orderkey % 101 = 0 THEN ''
      WHEN l_orderkey % 103 = 0 THEN '-' || q WHEN l_orderkey % 2 = 0 THEN q || '.0'
      ELSE ' ' || q || ' ' END AS quantity,
    CASE WHEN l_orderkey % 113 = 0 THEN 'n/a' ELSE {_grouped("unit")} END AS unit_price,
    CASE WHEN l_orderkey % 89 = 0 THEN CAST(total * 2 AS VARCHAR)
      ELSE {_grouped("total")} END AS total_amount,
    CASE WHEN l_orderkey % 107 = 0 THEN 'not-a-date'
      WHEN l_orderkey % 109 = 0 THEN strftime(day, '%Y-%m-%d') || 'T00:00:00.000Z'
      WHEN l_orderkey % 7 = 0 THEN strftime(day, '%Y-%m-%d')
      WHEN l_orderkey % 7 = 1 THEN strftime(day, '%Y-%m-%d') || 'T10:30:00'
      WHEN l_orderkey % 7 = 2 THEN strftime(day, '%Y-%m-%d') || 'T23:59:59Z'
      WHEN l_orderkey % 7 = 3 THEN strftime(day, '%m/%d/%Y')
      WHEN l_orderkey % 7 = 4 THEN strftime(day, '%Y-%m-%d') || 'T10:30:00.123456Z'
      WHEN l_orderkey % 7 = 5 THEN ' ' || chr(9) || strftime(day, '%Y-%m-%d') || chr(10) || ' '
      ELSE year(day) || '-' || month(day) || '-' || day(day) END AS sale_date,
    o_orderpriority AS payment_method
  FROM priced)"""

_CLEAN_SALES = f"""clean_sales AS (
  SELECT {_text("sale_id")} AS source_sale_id, 'csv' AS source_system,
    customer_id AS source_customer_id, product_id AS source_product_id,
    {_integer("quantity")} AS quantity, {_number("unit_price")} AS unit_price,
    {_number("total_amount")} AS total_amount, {_date("sale_date")} AS sale_date,
    payment_method, sale_date AS raw_date, total_amount AS raw_total, quantity AS raw_quantity,
    unit_price AS raw_price
  FROM raw_sales)"""

RAW_PRODUCTS = f"""raw_products AS (
  SELECT 'P' || p_partkey AS product_id,
    CASE WHEN p_partkey % 53 = 0 THEN ' ' || chr(9) || ' ' ELSE '  ' || p_name END AS product_name,
    p_type AS category,
    CASE WHEN p_partkey % 59 = 0 THEN '-' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR)
      WHEN p_partkey % 61 = 0 THEN '$' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR)
      WHEN p_partkey % 67 = 0 THEN '1e3'
      ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS price,
    CASE WHEN p_partkey % 71 = 0 THEN '-1' ELSE coalesce(CAST({_COST} AS VARCHAR), '') END AS cost,
    p_size || '.9' AS stock_quantity, p_brand AS supplier
  FROM part),
api_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title,
    CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS price,
    'A ' || p_type || ' ' || p_name AS description, lower(p_type) AS category,
    'https://example.com/' || p_partkey AS image,
    CASE WHEN p_size % 8 <> 0 THEN (p_size // 9) || '.' || (p_size % 10) END AS rate,
    CAST(p_size * 3 AS VARCHAR) AS n
  FROM part)"""

_CLEAN_PRODUCTS = f"""clean_csv_products AS (
  SELECT {_text("product_id")} AS source_product_id, 'csv' AS source_system,
    {_text("product_name")} AS title, {_text("category")} AS category,
    {_number("price")} AS price, {_number("cost")} AS cost,
    CAST(NULL AS DECIMAL(28,10)) AS rating_rate, CAST(NULL AS INTEGER) AS rating_count,
    {_integer("stock_quantity")} AS stock_quantity, {_text("supplier")} AS supplier
  FROM raw_products),
clean_products AS (
  SELECT * FROM clean_csv_products UNION ALL
  SELECT id, 'api', {_text("title")}, {_text("category")}, {_number("price")}, NULL,
    {_number("rate")}, {_integer("n")}, NULL, NULL
  FROM api_products)"""


RAW_CUSTOMERS = f"""raw_customers AS (
  SELECT c_custkey AS k, 'C' || c_custkey AS customer_id,
    CASE WHEN c_custkey % 17 <> 0 THEN ' ' || split_part(c_name, '#', 1) END AS first_name,
    CASE WHEN c_custkey % 19 <> 0 THEN split_part(c_name, '#', 2) END AS last_name,
    CASE WHEN c_custkey % 23 = 0 THEN 'no address' WHEN c_custkey % 29 = 0 THEN 'user@host'
      ELSE ' User' || split_part(c_name, '#', 2) || '@Example.COM' END AS email,
    CASE WHEN c_custkey % 31 = 0 THEN 'none' WHEN c_custkey % 37 = 0 THEN 'ext '
      ELSE '+1 (555) ' || split_part(c_name, '#', 2) || ' ext.' END AS phone,
    'City ' || c_nationkey AS city,
    (['NY', 'fl', 'IL', 'TX', 'CA', 'KY', '', 'Hi'])[CAST(c_custkey % 8 AS INTEGER) + 1] AS state,
    (['USA', 'US', 'united states', 'Canada', 'Mexico', 'UK', 'Germany', 'France', 'Italy', 'Spain',
      'Netherlands', 'China', 'Japan', 'Australia', 'India', 'Singapore', 'Brazil', 'Argentina',
      'Chile', 'Colombia', 'Norway', 'Kenya', '', 'United Kingdom', 'usa'])[c_nationkey + 1] AS country,
    DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS day,
    CASE WHEN c_custkey % 5 = 0 THEN strftime(day, '%d/%m/%Y')
      WHEN c_custkey % 5 = 1 THEN strftime(day, '%m/%d/%Y')
      ELSE strftime(day, '%Y-%m-%d') END AS registration_date
  FROM customer)"""


def _region(country: str, state: str) -> str:
    """States and countries of the regions."""
    return f"""CASE WHEN {country} IS NULL OR {country} = '' THEN NULL
      WHEN lower({country}) IN ('usa', 'us', 'united states') THEN CASE lower({state})
        WHEN 'ny' THEN 'Northeast' WHEN 'nj' THEN 'Northeast' WHEN 'pa' THEN 'Northeast'
        WHEN 'ct' THEN 'Northeast' WHEN 'ma' THEN 'Northeast' WHEN 'ri' THEN 'Northeast'
        WHEN 'vt' THEN 'Northeast' WHEN 'nh' THEN 'Northeast' WHEN 'me' THEN 'Northeast'
        WHEN 'fl' THEN 'Southeast' WHEN 'ga' THEN 'Southeast' WHEN 'nc' THEN 'Southeast'
        WHEN 'sc' THEN 'Southeast' WHEN 'va' THEN 'Southeast' WHEN 'wv' THEN 'Southeast'
        WHEN 'md' THEN 'Southeast' WHEN 'de' THEN 'Southeast' WHEN 'dc' THEN 'Southeast'
        WHEN 'il' THEN 'Midwest' WHEN 'oh' THEN 'Midwest' WHEN 'mi' THEN 'Midwest'
        WHEN 'in' THEN 'Midwest' WHEN 'wi' THEN 'Midwest' WHEN 'mn' THEN 'Midwest'
        WHEN 'ia' THEN 'Midwest' WHEN 'mo' THEN 'Midwest' WHEN 'nd' THEN 'Midwest'
        WHEN 'sd' THEN 'Midwest' WHEN 'ne' THEN 'Midwest' WHEN 'ks' THEN 'Midwest'
        WHEN 'tx' THEN 'Southwest' WHEN 'ok' THEN 'Southwest' WHEN 'nm' THEN 'Southwest'
        WHEN 'az' THEN 'Southwest'
        WHEN 'ca' THEN 'West' WHEN 'wa' THEN 'West' WHEN 'or' THEN 'West' WHEN 'nv' THEN 'West'
        WHEN 'ut' THEN 'West' WHEN 'co' THEN 'West' WHEN 'wy' THEN 'West' WHEN 'mt' THEN 'West'
        WHEN 'id' THEN 'West' WHEN 'ak' THEN 'West' WHEN 'hi' THEN 'West' ELSE 'USA' END
      WHEN lower({country}) IN ('canada', 'mexico') THEN 'North America'
      WHEN lower({country}) IN ('uk', 'united kingdom', 'germany', 'france', 'italy', 'spain',
        'netherlands') THEN 'Europe'
      WHEN lower({country}) IN ('china', 'japan', 'australia', 'india', 'singapore')
        THEN 'Asia Pacific'
      WHEN lower({country}) IN ('brazil', 'argentina', 'chile', 'colombia') THEN 'Latin America'
      ELSE 'International' END"""


_EMAIL = f"""CASE WHEN contains({_strip("email")}, '@') THEN lower({_strip("email")}) END"""
_PHONE_KEPT = r"regexp_replace(phone, '[^\d+\-\s()]', '', 'g')"
_PHONE = f"CASE WHEN {_PHONE_KEPT} <> '' THEN {_strip(_PHONE_KEPT)} END"
_NAME = f"nullif(concat_ws(' ', {_text('first_name')}, {_text('last_name')}), '')"

_CLEAN_CUSTOMERS = f"""clean_customers AS (
  SELECT k, {_text("customer_id")} AS source_customer_id, 'csv' AS source_system,
    {_EMAIL} AS email, {_NAME} AS full_name, {_PHONE} AS phone, {_text("city")} AS city,
    {_text("state")} AS state, {_text("country")} AS country,
    {_date("registration_date")} AS registration_date
  FROM raw_customers)"""

_CARTS = f"""numbered AS (SELECT *, {_K} AS k FROM events),
carts AS (
  SELECT *, CAST(event_id AS VARCHAR) AS source_id, CAST(user_id AS VARCHAR) AS uid,
    CASE WHEN event_id % 9 = 0
      THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0') || 'Z'
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS cart_date
  FROM numbered),
cart_lines AS (
  SELECT carts.*, i, (k + i * 7) % 40 AS pid,
    CASE WHEN k % 11 <> i THEN k % 6 + i END AS qty
  FROM carts, range(0, 3) AS r(i) WHERE i < k % 4)"""

_CART_JSON = """SELECT source_id, uid AS user_id, cart_date,
  '[' || coalesce(string_agg(
     '{"productId":"' || pid || '"' || CASE WHEN qty IS NULL THEN '' ELSE ',"quantity":"' || qty || '"' END || '}',
     ',' ORDER BY i), '') || ']' AS products_json
FROM (SELECT carts.source_id, carts.uid, carts.cart_date, l.i, l.pid, l.qty
      FROM carts LEFT JOIN cart_lines l ON l.event_id = carts.event_id) GROUP BY ALL"""

# ----------------------------------------------------------------- validation


def _shown(c: str) -> str:
    cut = rf"regexp_replace(CAST({c} AS VARCHAR), '(\.\d*?)0+$', '\1')"
    return rf"regexp_replace({cut}, '\.$', '')"


def _null(c: str, name: str) -> str:
    return f"CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' THEN '{name} cannot be null or empty' END"


def _positive(c: str, name: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN '{name} cannot be null or empty'"
        f" WHEN {c} <= 0 THEN '{name} must be positive, got ' || {_shown(c)} END"
    )


def _total(message: bool = True) -> str:
    text = "'total_amount doesn''t match quantity * unit_price'"
    if message:
        text = (
            f"'total_amount (' || {_shown('total_amount')} || ') doesn''t match quantity * unit_price ('"
            f" || {_shown('(quantity * unit_price)')} || ')'"
        )
    return (
        "CASE WHEN abs(total_amount - quantity * unit_price)"
        f" > quantity * unit_price * CAST(0.01 AS DECIMAL(3,2)) THEN {text} END"
    )


_FUTURE = "sale_date > DATE '2001-06-30'"
_KEY = "CASE WHEN source_{0}_id IS NULL THEN 'missing_key' END"

SALE_ERRORS = [
    _positive("quantity", "quantity"),
    _positive("unit_price", "unit_price"),
    _positive("total_amount", "total_amount"),
    "CASE WHEN sale_date IS NULL THEN 'sale_date cannot be null or empty'"
    f" WHEN {_FUTURE} THEN 'sale_date cannot be in the future: ' || CAST(sale_date AS VARCHAR) END",
    _total(),
    _KEY.format("sale"),
]
PRODUCT_ERRORS = [
    _null("title", "title"),
    _positive("price", "price"),
    f"CASE WHEN cost < 0 THEN 'cost cannot be negative, got ' || {_shown('cost')} END",
    "CASE WHEN rating_rate NOT BETWEEN 0 AND 5 THEN"
    f" 'rating_rate must be between 0 and 5, got ' || {_shown('rating_rate')} END",
    _KEY.format("product"),
]
CUSTOMER_ERRORS = [
    r"CASE WHEN email <> '' AND NOT regexp_matches(email,"
    r" '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')"
    r" THEN 'email is not a valid email: ' || email END",
    _KEY.format("customer"),
]


def _checked(name: str, source: str, rules: list[str]) -> str:
    return (
        f"{name} AS (SELECT *, concat_ws('; ', {', '.join(rules)}) AS errors FROM {source})"
    )


_SALES = ",\n".join(
    [RAW_SALES, _CLEAN_SALES, _checked("sales", "clean_sales", SALE_ERRORS)]
)
_PRODUCTS = ",\n".join(
    [RAW_PRODUCTS, _CLEAN_PRODUCTS, _checked("checked_products", "clean_products", PRODUCT_ERRORS)]
)
_CUSTOMERS = ",\n".join(
    [RAW_CUSTOMERS, _CLEAN_CUSTOMERS, _checked("checked_customers", "clean_customers", CUSTOMER_ERRORS)]
)

_STAGED_SALES = f"""{_SALES},
staged_sales AS (
  SELECT source_sale_id, source_system, source_customer_id, source_product_id, quantity,
    CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
    CAST(total_amount AS DECIMAL(12,2)) AS total_amount, sale_date, payment_method
  FROM sales WHERE errors = ''
  QUALIFY row_number() OVER (PARTITION BY source_sale_id ORDER BY raw_date DESC,
    source_product_id DESC, raw_total DESC, raw_quantity DESC, source_customer_id DESC,
    raw_price DESC) = 1)"""

_RESOLVED = f"""{_STAGED_SALES},
{PRODUCTS},
{CUSTOMERS},
resolved AS (
  SELECT s.*, p.product_key, c.customer_key, {_key("s.sale_date")} AS date_key,
    CASE WHEN p.cost <> 0 AND s.quantity <> 0
      THEN CAST(p.cost * s.quantity AS DECIMAL(12,2)) END AS cost_amount,
    CASE WHEN p.product_key IS NULL THEN 'missing product'
      WHEN c.customer_key IS NULL THEN 'missing customer'
      WHEN s.sale_date NOT BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'
      THEN 'date not in calendar' END AS skip_reason
  FROM staged_sales s
  LEFT JOIN products p ON p.product_id = s.source_product_id || '-csv' AND p.is_current
  LEFT JOIN customers c ON c.customer_id = s.source_customer_id || '-csv' AND c.is_current)"""

# Sales whose product and customer are valid too, and whose day is in the calendar.
_LOADED = ",\n".join(
    [
        _STAGED_SALES,
        RAW_PRODUCTS,
        _CLEAN_PRODUCTS,
        _checked("checked_products", "clean_products", PRODUCT_ERRORS),
        RAW_CUSTOMERS,
        _CLEAN_CUSTOMERS,
        _checked("checked_customers", "clean_customers", CUSTOMER_ERRORS),
    ]
) + """,
loaded AS (
  SELECT s.source_sale_id, s.source_product_id || '-csv' AS product, s.source_customer_id || '-csv' AS customer,
    s.sale_date AS day, s.quantity, s.total_amount AS total, p.category
  FROM staged_sales s
  JOIN checked_products p USING (source_product_id, source_system)
  JOIN checked_customers c USING (source_customer_id, source_system)
  WHERE p.errors = '' AND c.errors = '' AND s.sale_date BETWEEN DATE '1995-01-01' AND DATE '2000-12-31')"""

_STAGED_PRODUCTS = f"""{_PRODUCTS},
{PRODUCTS},
valid AS (SELECT * FROM checked_products WHERE errors = ''),
earlier AS (
  SELECT 'P' || product_key AS source_product_id, 'csv' AS source_system, title, category,
    CAST(price - 1 AS DECIMAL(10,2)) AS price, cost, stock_quantity, supplier FROM products),
staged_products AS (
  SELECT coalesce(v.source_product_id, e.source_product_id) AS source_product_id,
    coalesce(v.source_system, e.source_system) AS source_system,
    CASE WHEN v.errors IS NULL THEN e.title ELSE v.title END AS title,
    CASE WHEN v.errors IS NULL THEN e.category ELSE v.category END AS category,
    CAST(CASE WHEN v.errors IS NULL THEN e.price ELSE v.price END AS DECIMAL(10,2)) AS price,
    CAST(CASE WHEN v.errors IS NULL THEN e.cost ELSE v.cost END AS DECIMAL(10,2)) AS cost,
    CAST(v.rating_rate AS DECIMAL(3,2)) AS rating_rate, v.rating_count,
    CASE WHEN v.errors IS NULL THEN e.stock_quantity ELSE v.stock_quantity END AS stock_quantity,
    CAST(CASE WHEN e.title IS NULL THEN DATE '2001-06-30' ELSE DATE '2001-01-01' END AS DATE) AS created_on,
    CAST(CASE WHEN v.errors IS NULL THEN DATE '2001-01-01' ELSE DATE '2001-06-30' END AS DATE) AS updated_on,
    CASE WHEN v.errors IS NULL THEN 'batch-1' ELSE 'batch-2' END AS batch_id,
    CASE WHEN v.errors IS NULL THEN 'kept' WHEN e.title IS NULL THEN 'inserted'
      ELSE 'updated' END AS action
  FROM valid v FULL OUTER JOIN earlier e
    ON v.source_product_id = e.source_product_id AND v.source_system = e.source_system)"""

# ------------------------------------------------------------------ SCD type 2

_SCD_PRODUCT = f"""WITH {_PRODUCTS},
{PRODUCTS},
staged AS (
  SELECT source_product_id || '-csv' AS product_id, title, category,
    CAST(price AS DECIMAL(10,2)) AS price, CAST(cost AS DECIMAL(10,2)) AS cost,
    stock_quantity, supplier
  FROM checked_products WHERE errors = '' AND source_system = 'csv'),
matched AS (
  SELECT o.product_id AS old_id, n.product_id AS new_id, o.title AS o_title,
    o.category AS o_category, o.price AS o_price, o.cost AS o_cost,
    o.stock_quantity AS o_stock, o.supplier AS o_supplier, n.*,
    CASE WHEN n.product_id IS NULL THEN 'kept' WHEN o.product_id IS NULL THEN 'inserted'
      WHEN (n.price IS NOT NULL AND n.price IS DISTINCT FROM o.price)
        OR (n.cost IS NOT NULL AND n.cost IS DISTINCT FROM o.cost) THEN 'updated'
      ELSE 'unchanged' END AS what
  FROM (SELECT * FROM products WHERE is_current) o
  FULL OUTER JOIN staged n ON o.product_id = n.product_id),
versions AS (
  SELECT product_id, title, category, price, cost, stock_quantity, supplier,
    DATE '2000-01-01' AS effective_from, DATE '2000-06-01' AS effective_to,
    false AS is_current, 'history' AS action FROM products WHERE NOT is_current
  UNION ALL
  SELECT new_id, title, category, price, cost, stock_quantity, supplier,
    DATE '2001-06-30', DATE '9999-12-31', true, what FROM matched
  WHERE what IN ('inserted', 'updated')
  UNION ALL
  SELECT old_id, o_title, o_category, o_price, o_cost, o_stock, o_supplier, DATE '2000-01-01',
    CASE WHEN what = 'updated' THEN DATE '2001-06-30' ELSE DATE '9999-12-31' END,
    what <> 'updated', CASE WHEN what = 'updated' THEN 'closed' ELSE what END FROM matched
  WHERE what IN ('updated', 'kept')
  UNION ALL
  SELECT old_id, title, category, o_price, o_cost, stock_quantity, supplier,
    DATE '2000-01-01', DATE '9999-12-31', true, what FROM matched WHERE what = 'unchanged')
SELECT *, CASE WHEN cost > 0 THEN CAST(CAST(
    ((2 * CAST((price - cost) * 100 AS HUGEINT) * 1000000 + CAST(price * 100 AS HUGEINT))
      // (2 * CAST(price * 100 AS HUGEINT))) AS DECIMAL(18,0))
    * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4)) END AS profit_margin
FROM versions"""

_SCD_CUSTOMER = f"""WITH {_CUSTOMERS},
dim AS (
  SELECT 'C' || k || '-csv' AS customer_id, city,
    CASE WHEN k % 7 = 0 THEN 'Elsewhere' ELSE {_text("country")} END AS country,
    k % 13 <> 0 AS is_current FROM raw_customers),
staged AS (
  SELECT source_customer_id || '-csv' AS customer_id, email, full_name, city, country,
    {_region("country", "state")} AS region, registration_date
  FROM checked_customers WHERE errors = ''),
matched AS (
  SELECT o.customer_id AS old_id, o.city AS o_city, o.country AS o_country, n.*,
    CASE WHEN n.customer_id IS NULL THEN 'kept' WHEN o.customer_id IS NULL THEN 'inserted'
      WHEN n.city IS DISTINCT FROM o.city OR n.country IS DISTINCT FROM o.country THEN 'updated'
      ELSE 'unchanged' END AS what
  FROM (SELECT * FROM dim WHERE is_current) o FULL OUTER JOIN staged n
    ON o.customer_id = n.customer_id)
SELECT customer_id, 'old@example.com' AS email, 'Old Name' AS full_name, city, country,
  'Old Region' AS region, CAST(NULL AS DATE) AS registration_date,
  'Regular' AS customer_segment, DATE '2000-01-01' AS effective_from,
  DATE '2000-06-01' AS effective_to, false AS is_current, 'history' AS action
FROM dim WHERE NOT is_current
UNION ALL
SELECT customer_id, email, full_name, city, country, region, registration_date, 'New',
  DATE '2001-06-30', DATE '9999-12-31', true, what FROM matched
WHERE what IN ('inserted', 'updated')
UNION ALL
SELECT old_id, 'old@example.com', 'Old Name', o_city, o_country, 'Old Region', NULL, 'Regular',
  DATE '2000-01-01',
  CASE WHEN what = 'updated' THEN DATE '2001-06-30' ELSE DATE '9999-12-31' END,
  what <> 'updated', CASE WHEN what = 'updated' THEN 'closed' ELSE what END FROM matched
WHERE what IN ('updated', 'kept')
UNION ALL
SELECT old_id, email, full_name, o_city, o_country, region, NULL, 'Regular',
  DATE '2000-01-01', DATE '9999-12-31', true, what FROM matched WHERE what = 'unchanged'"""

# ----------------------------------------------------------- marts and views

_SALES_DAILY = f"""WITH {FACTS}
SELECT {_key("day")} AS date_key, day AS full_date, year(day) AS year, month(day) AS month_num,
  strftime(day, '%B') AS month_name, strftime(day, '%A') AS day_name,
  dayofweek(day) IN (0, 6) AS is_weekend, count(DISTINCT sale_id) AS total_orders,
  CAST(sum(quantity) AS BIGINT) AS total_quantity, {_money("sum(total_amount)")} AS total_revenue,
  {_money("sum(cost_amount)")} AS total_cost, {_money(_PROFIT)} AS total_profit,
  {_mean("sum(total_amount)", "count(*)", 2)} AS avg_order_value,
  count(DISTINCT customer_key) AS unique_customers,
  count(DISTINCT product_key) AS unique_products
FROM facts f GROUP BY day"""

_PERFORMANCE = f"""WITH {FACTS},
{PRODUCTS}
SELECT p.product_key, p.product_id, p.title, p.category, p.price,
  count(DISTINCT f.sale_id) AS total_orders, CAST(sum(f.quantity) AS BIGINT) AS total_quantity_sold,
  {_money("sum(f.total_amount)")} AS total_revenue, {_money(_PROFIT)} AS total_profit,
  {_mean("sum(f.quantity)", "count(*)", 2)} AS avg_quantity_per_order,
  min(f.day) AS first_sale_date, max(f.day) AS last_sale_date,
  date_diff('day', max(f.day), DATE '2002-01-01') AS days_since_last_sale,
  rank() OVER (ORDER BY sum(f.total_amount) DESC) AS revenue_rank,
  rank() OVER (ORDER BY sum(f.quantity) DESC) AS quantity_rank
FROM facts f JOIN products p ON p.product_key = f.product_key AND p.is_current
GROUP BY p.product_key, p.product_id, p.title, p.category, p.price"""

_SUMMARY = f"""{FACTS},
{CUSTOMERS},
summary AS (
  SELECT c.customer_key, c.customer_id, c.full_name, c.email, c.city, c.country,
    count(DISTINCT f.sale_id) AS total_orders, CAST(sum(f.quantity) AS BIGINT) AS total_quantity,
    {_money("sum(f.total_amount)")} AS total_spent,
    {_mean("sum(f.total_amount)", "count(*)", 2)} AS avg_order_value,
    min(f.day) AS first_purchase_date, max(f.day) AS last_purchase_date,
    date_diff('day', max(f.day), DATE '2002-01-01') AS days_since_last_purchase,
    date_diff('day', min(f.day), DATE '2002-01-01') AS customer_tenure_days, c.customer_segment
  FROM facts f JOIN customers c ON c.customer_key = f.customer_key AND c.is_current
  GROUP BY c.customer_key, c.customer_id, c.full_name, c.email, c.city, c.country,
    c.customer_segment)"""

_RFM = f"""WITH {_SUMMARY},
ranked AS (
  SELECT *, count(*) OVER () AS n,
    rank() OVER (ORDER BY days_since_last_purchase) AS r,
    rank() OVER (ORDER BY total_orders DESC) AS f, rank() OVER (ORDER BY total_spent DESC) AS m
  FROM summary)
SELECT customer_id, (5 - (r - 1) * 5 // n) || '' || (5 - (f - 1) * 5 // n) || ''
  || (5 - (m - 1) * 5 // n) AS rfm_score FROM ranked"""

_CATEGORY = f"""{FACTS},
{PRODUCTS},
analysis AS (
  SELECT p.category, year(f.day) AS year, month(f.day) AS month_num,
    count(DISTINCT p.product_key) AS product_count, count(DISTINCT f.sale_id) AS total_orders,
    CAST(sum(f.quantity) AS BIGINT) AS total_quantity,
    {_money("sum(f.total_amount)")} AS total_revenue, {_money(_PROFIT)} AS total_profit,
    {_mean("sum(p.price)", "count(*)", 2)} AS avg_product_price,
    count(DISTINCT f.customer_key) AS unique_customers
  FROM facts f JOIN products p ON p.product_key = f.product_key AND p.is_current
  GROUP BY ALL)"""


def _change(base: str) -> str:
    """Change from `base` in per cent, rounded half away from zero."""
    gain = f"CAST((a.total_revenue - {base}) * 100 AS HUGEINT)"
    cents = f"CAST({base} * 100 AS HUGEINT)"
    size = f"((20000 * abs({gain}) + {cents}) // (2 * {cents}))"
    return (
        f"CASE WHEN {base} <> 0 THEN CAST(sign({gain}) * CAST({size} AS DECIMAL(18,0))"
        " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END"
    )


_GROWTH = f"""WITH {_CATEGORY}
SELECT a.category, a.year, a.month_num, {_change("m.total_revenue")} AS revenue_mom_change,
  {_change("y.total_revenue")} AS revenue_yoy_change
FROM analysis a
LEFT JOIN analysis m ON m.category IS NOT DISTINCT FROM a.category
  AND m.year * 12 + m.month_num = a.year * 12 + a.month_num - 1
LEFT JOIN analysis y ON y.category IS NOT DISTINCT FROM a.category
  AND y.year * 12 + y.month_num = a.year * 12 + a.month_num - 12"""

_VIEW_SUMS = (
    "count(*) AS orders, CAST(sum(f.quantity) AS BIGINT) AS units_sold,"
    f" {_money('sum(f.total_amount)')} AS revenue, {_money(_PROFIT)} AS profit"
)

_KPI = f"""{FACTS},
kpi AS (
  SELECT count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
    {_money("sum(total_amount)")} AS total_revenue, {_money(_PROFIT)} AS total_profit,
    {_mean("sum(total_amount)", "count(*)", 6)} AS avg_order_value,
    count(DISTINCT customer_key) AS unique_customers,
    count(DISTINCT product_key) AS unique_products
  FROM facts f)"""

_DAILY = f"""{FACTS},
daily AS (
  SELECT day AS full_date, strftime(day, '%A') AS day_name, strftime(day, '%B') AS month_name,
    year(day) AS year, {_VIEW_SUMS}
  FROM facts f GROUP BY day)"""

_BY_CATEGORY = f"""{FACTS},
{PRODUCTS},
by_category AS (
  SELECT p.category, {_VIEW_SUMS},
    {_mean("sum(f.total_amount)", "count(*)", 6)} AS avg_order_value
  FROM facts f JOIN products p ON p.product_key = f.product_key
  WHERE p.is_current GROUP BY p.category)"""

_TOP = f"""{FACTS},
{PRODUCTS},
top AS (
  SELECT p.product_id, p.title AS product_name, p.category, p.price, count(*) AS orders,
    CAST(sum(f.quantity) AS BIGINT) AS units_sold, {_money("sum(f.total_amount)")} AS revenue,
    rank() OVER (ORDER BY sum(f.total_amount) DESC) AS revenue_rank
  FROM facts f JOIN products p ON p.product_key = f.product_key
  WHERE p.is_current GROUP BY p.product_id, p.title, p.category, p.price)"""

_SEGMENTS = f"""{FACTS},
{CUSTOMERS},
segments AS (
  SELECT c.customer_segment, count(DISTINCT c.customer_key) AS customer_count,
    count(f.sale_id) AS total_orders, {_money("sum(f.total_amount)")} AS total_revenue,
    {_mean("sum(f.total_amount)", "count(f.sale_id)", 6)} AS avg_order_value
  FROM customers c LEFT JOIN facts f ON c.customer_key = f.customer_key
  WHERE c.is_current GROUP BY c.customer_segment)"""

_REGIONS = f"""WITH {FACTS},
{CUSTOMERS}
SELECT coalesce(c.region, 'Unknown') AS region, coalesce(c.country, 'Unknown') AS country,
  count(DISTINCT c.customer_key) AS customers, count(f.sale_id) AS orders,
  {_money("sum(f.total_amount)")} AS revenue
FROM customers c LEFT JOIN facts f ON c.customer_key = f.customer_key
WHERE c.is_current GROUP BY c.region, c.country"""

_MONTHS = f"""{FACTS},
months AS (
  SELECT year(day) AS year, month(day) AS month_num, strftime(any_value(day), '%B') AS month_name,
    count(*) AS orders, {_money("sum(f.total_amount)")} AS revenue, {_money(_PROFIT)} AS profit
  FROM facts f GROUP BY year(day), month(day))"""

_PIVOT = ", ".join(
    f"max(CASE WHEN year = {y} THEN {m} END) AS \"{y}_{m}\""
    for y in range(1995, 2002)
    for m in ("revenue", "profit")
)

_QUALITY = f"""{LOG},
quality AS (
  SELECT count(*) AS total_pipeline_runs,
    CAST(sum(records_received) AS BIGINT) AS total_records_received,
    CAST(sum(records_stored) AS BIGINT) AS total_records_stored,
    CAST(sum(records_rejected) AS BIGINT) AS total_records_rejected,
    {_percent("sum(records_stored)", "sum(records_received)")} AS overall_quality_score,
    count(*) FILTER (status = 'success') AS successful_runs,
    count(*) FILTER (status = 'failed') AS failed_runs
  FROM scored)"""

_SOURCES = f"""{LOG},
sources AS (
  SELECT source_name, source_type, count(*) AS run_count,
    CAST(sum(records_received) AS BIGINT) AS total_received,
    CAST(sum(records_stored) AS BIGINT) AS total_stored,
    CAST(sum(records_rejected) AS BIGINT) AS total_rejected,
    {_mean("sum(quality_score)", "count(*)", 6)} AS avg_quality_score,
    max(created_at) AS last_run
  FROM scored GROUP BY source_name, source_type)"""

_TREND = f"""{LOG},
trend AS (
  SELECT CAST(created_at AS DATE) AS run_date, count(*) AS pipeline_runs,
    CAST(sum(records_received) AS BIGINT) AS records_received,
    CAST(sum(records_stored) AS BIGINT) AS records_stored,
    CAST(sum(records_rejected) AS BIGINT) AS records_rejected,
    {_mean("sum(quality_score)", "count(*)", 6)} AS avg_quality_score
  FROM scored GROUP BY 1)"""

_DAILY_QUALITY = f"""WITH {LOG},
ingested AS (
  SELECT CAST(created_at AS DATE) AS day, count(*) AS total_pipelines_run,
    count(*) FILTER (status = 'success') AS successful_pipelines,
    count(*) FILTER (status = 'failed') AS failed_pipelines,
    CAST(sum(records_received) AS BIGINT) AS total_records_received,
    CAST(sum(records_stored) AS BIGINT) AS total_records_stored,
    CAST(sum(records_rejected) AS BIGINT) AS total_records_rejected,
    {_percent("sum(records_stored)", "sum(records_received)")} AS overall_quality_score
  FROM scored GROUP BY 1),
transformed AS (
  SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS total_transforms_run,
    count(*) FILTER (o_orderstatus = 'F') AS successful_transforms FROM orders GROUP BY 1),
checked AS (
  SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS total_rules_executed,
    count(*) FILTER (l_returnflag <> 'R') AS rules_passed,
    count(*) FILTER (l_returnflag = 'R') AS rules_failed FROM lineitem GROUP BY 1),
days AS (
  SELECT day FROM ingested UNION SELECT day FROM transformed UNION SELECT day FROM checked)
SELECT d.day AS summary_date, coalesce(total_pipelines_run, 0) AS total_pipelines_run,
  coalesce(successful_pipelines, 0) AS successful_pipelines,
  coalesce(failed_pipelines, 0) AS failed_pipelines,
  coalesce(total_records_received, 0) AS total_records_received,
  coalesce(total_records_stored, 0) AS total_records_stored,
  coalesce(total_records_rejected, 0) AS total_records_rejected, overall_quality_score,
  coalesce(total_transforms_run, 0) AS total_transforms_run,
  coalesce(successful_transforms, 0) AS successful_transforms,
  coalesce(total_rules_executed, 0) AS total_rules_executed,
  coalesce(rules_passed, 0) AS rules_passed, coalesce(rules_failed, 0) AS rules_failed
FROM days d LEFT JOIN ingested i ON i.day = d.day LEFT JOIN transformed t ON t.day = d.day
LEFT JOIN checked c ON c.day = d.day"""


def _rule(number: int, name: str, table: str, broken: str) -> str:
    failed = f"count(*) FILTER ({broken})"
    key = {"checked_products": "source_product_id", "checked_customers": "source_customer_id"}.get(
        table, "source_sale_id"
    )
    return (
        f"SELECT {number} AS rule_id, '{name}' AS rule_name, count(*) AS records_checked,"
        f" count(*) - {failed} AS records_passed, {failed} AS records_failed,"
        f" {_percent(f'(count(*) - {failed})', 'count(*)')} AS pass_rate,"
        f" CAST(to_json(coalesce(list_sort(list(DISTINCT {key}) FILTER ({broken} AND {key} IS NOT NULL))"
        f"[1:5], [])) AS VARCHAR) AS sample_failures FROM {table}"
    )


_RULES = f"WITH {_PRODUCTS},\n{_CUSTOMERS},\n{_SALES}\n" + "\nUNION ALL\n".join(
    [
        _rule(1, "product_price_positive", "checked_products", "price IS NULL OR price <= 0"),
        _rule(2, "product_title_not_null", "checked_products", "title IS NULL"),
        _rule(3, "customer_email_format", "checked_customers",
              r"email IS NOT NULL AND NOT regexp_matches(email,"
              r" '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')"),
        _rule(4, "sale_quantity_positive", "sales", "quantity IS NULL OR quantity <= 0"),
        _rule(5, "sale_date_not_future", "sales", _FUTURE),
        _rule(6, "sale_total_matches", "sales", f"({_total(False)}) IS NOT NULL"),
    ]
)

# One sale per order line, whatever the table repeats.
_SALE_LINES = """WITH lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS sale_id, l_linenumber AS line,
    max(l_partkey) AS part, CAST(max(l_quantity) AS INTEGER) AS quantity
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""

# Events as carts of one item, a file per type; a later event of a cart wins.
_CARTS_OF_EVENTS = """streamed AS (
  SELECT user_id || '-0' AS source_sale_id, CAST(max(event_id) % 7 + 1 AS INTEGER) AS quantity,
    DATE '2001-01-01' AS sale_date, 3::BIGINT AS n_batches
  FROM events GROUP BY user_id)"""

# Literal dates of 1992 to 2002: Good Friday, Easter Monday, the last Monday of May, the first one of
# September and the fourth Thursday of November.
_MOVING_DAYS = """
1992-04-17 1992-04-20 1992-05-25 1992-09-07 1992-11-26 1993-04-09 1993-04-12 1993-05-31 1993-09-06 1993-11-25
1994-04-01 1994-04-04 1994-05-30 1994-09-05 1994-11-24 1995-04-14 1995-04-17 1995-05-29 1995-09-04 1995-11-23
1996-04-05 1996-04-08 1996-05-27 1996-09-02 1996-11-28 1997-03-28 1997-03-31 1997-05-26 1997-09-01 1997-11-27
1998-04-10 1998-04-13 1998-05-25 1998-09-07 1998-11-26 1999-04-02 1999-04-05 1999-05-31 1999-09-06 1999-11-25
2000-04-21 2000-04-24 2000-05-29 2000-09-04 2000-11-23 2001-04-13 2001-04-16 2001-05-28 2001-09-03 2001-11-22
2002-03-29 2002-04-01 2002-05-27 2002-09-02 2002-11-28"""

# Events that land late, and the time up to which late ones are left out.
_LANDED = """landed AS (SELECT *, event_id % 50 = 3 AS held_up FROM events),
mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 12 DAY AS closed FROM landed WHERE NOT held_up)"""

_REASONS = "[" + ", ".join(
    [
        "CASE WHEN quantity IS NULL THEN 'quantity cannot be null or empty' WHEN quantity <= 0 THEN 'quantity must be positive' END",
        "CASE WHEN unit_price IS NULL THEN 'unit_price cannot be null or empty' WHEN unit_price <= 0 THEN 'unit_price must be positive' END",
        "CASE WHEN total_amount IS NULL THEN 'total_amount cannot be null or empty' WHEN total_amount <= 0 THEN 'total_amount must be positive' END",
        f"CASE WHEN sale_date IS NULL THEN 'sale_date cannot be null or empty' WHEN {_FUTURE} THEN 'sale_date cannot be in the future' END",
        _total(False),
        _KEY.format("sale"),
    ]
) + "]"

_MILLIS = _strip("sale_date")
_LENIENT = (
    f"coalesce({_date('sale_date')}, CASE WHEN regexp_matches({_MILLIS},"
    rf" '^\d{{4}}-\d{{1,2}}-\d{{1,2}}T{_TIME}\.\d{{1,9}}Z$')"
    f" THEN CAST(try_strptime(split_part({_MILLIS}, 'T', 1), '%Y-%m-%d') AS DATE) END)"
)

_CALENDAR = f"""WITH days AS (
  SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem
  UNION SELECT CAST(o_orderdate AS DATE) FROM orders)
SELECT {_key("d")} AS date_key, d AS full_date, dayofweek(d) + 1 AS day_of_week,
  strftime(d, '%A') AS day_name, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
  (dayofyear(d) + dayofweek(CAST(date_trunc('year', d) AS DATE)) - 1) // 7 + 1 AS week_of_year,
  month(d) AS month_num, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short,
  quarter(d) AS quarter, 'Q' || quarter(d) AS quarter_name, year(d) AS year,
  dayofweek(d) IN (0, 6) AS is_weekend, false AS is_holiday,
  CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS fiscal_year,
  CASE WHEN month(d) IN (7, 8, 9) THEN 1 WHEN month(d) IN (10, 11, 12) THEN 2
    WHEN month(d) IN (1, 2, 3) THEN 3 ELSE 4 END AS fiscal_quarter
FROM days"""

_SEGMENT_CASE = (
    "CASE WHEN {0} >= 1000 OR {1} >= 10 THEN 'Premium' WHEN {0} >= 500 OR {1} >= 5 THEN 'Regular'"
    " WHEN {0} >= 100 OR {1} >= 2 THEN 'Occasional' ELSE 'New' END"
)

_RUN_COLUMNS = (
    "batch_id, pipeline_name, source_name, source_type, records_received, records_stored,"
    " records_rejected, quality_score, status, duration_seconds, created_at"
)


def queries() -> dict[str, str]:
    return {
        "dim_date_full": _CALENDAR,
        "latest_batch": """SELECT event_id, event_type, strftime(ts, '%Y%m%d') AS batch_id
            FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)""",
        "clean_strings": f"""WITH {RAW_PRODUCTS}
            SELECT product_id, {_text("product_name")} AS title, {_text("supplier")} AS supplier
            FROM raw_products""",
        "clean_decimals": f"""WITH {RAW_SALES}
            SELECT {_text("sale_id")} AS sale_id, {_integer("quantity")} AS quantity,
              coalesce({_integer("quantity")}, 1) AS quantity_or_one,
              CAST({_number("unit_price")} AS DECIMAL(12,2)) AS unit_price,
              CAST({_number("total_amount")} AS DECIMAL(12,2)) AS total_amount FROM raw_sales""",
        "clean_dates": f"""WITH {RAW_SALES},
            dated AS (SELECT {_text("sale_id")} AS sale_id, {_date("sale_date")} AS d,
              {_LENIENT} AS lenient_date FROM raw_sales)
            SELECT sale_id, d AS sale_date, lenient_date, {_key("d")} AS date_key FROM dated""",
        "clean_contacts": f"""WITH {RAW_CUSTOMERS}
            SELECT customer_id, {_EMAIL} AS email, {_PHONE} AS phone, {_NAME} AS full_name,
              {_date("registration_date")} AS registration_date FROM raw_customers""",
        "region_map": f"""WITH {RAW_CUSTOMERS}
            SELECT customer_id, country, state, {_region("country", "state")} AS region
            FROM raw_customers""",
        "segment": f"""WITH totals AS (
              SELECT o_custkey AS customer_key, count(*) AS orders,
                sum(CAST(o_totalprice AS DECIMAL(12,2))) AS spent FROM orders GROUP BY o_custkey)
            SELECT customer_key, orders,
              {_SEGMENT_CASE.format("spent / 2000", "(orders // 2)")} AS segment FROM totals""",
        "flatten_products": f"""WITH {RAW_PRODUCTS}
            SELECT id AS source_id, title, price, description, category, image AS image_url,
              rate AS rating_rate, n AS rating_count, CAST(NULL AS VARCHAR) AS file_name,
              CAST(NULL AS BIGINT) AS line_number FROM api_products""",
        "flatten_users": f"""WITH {RAW_CUSTOMERS}
            SELECT CAST(k AS VARCHAR) AS source_customer_id, 'api' AS source_system,
              {_EMAIL} AS email, {_text("first_name")} AS first_name,
              {_text("last_name")} AS last_name, {_NAME} AS full_name, {_PHONE} AS phone, city,
              CAST(NULL AS VARCHAR) AS country FROM raw_customers""",
        "flatten_carts": f"WITH {_CARTS}\n{_CART_JSON}",
        "json_ingest": f"WITH {_CARTS}\n{_CART_JSON}",
        "explode_carts": f"""WITH {_CARTS}
            SELECT source_id || '-' || i AS source_sale_id, uid AS source_customer_id,
              CAST(pid AS VARCHAR) AS source_product_id, coalesce(qty, 1) AS quantity,
              CAST(50 AS DECIMAL(10,2)) AS unit_price,
              CASE WHEN coalesce(qty, 1) <> 0
                THEN CAST(50 * coalesce(qty, 1) AS DECIMAL(12,2)) END AS total_amount,
              {_date("cart_date")} AS sale_date, 'api_cart' AS payment_method FROM cart_lines""",
        "csv_ingest": f"""WITH {RAW_CUSTOMERS}
            SELECT customer_id, trim(first_name) AS first_name, last_name, trim(email) AS email,
              trim(phone) AS phone, city, nullif(state, '') AS state,
              nullif(country, '') AS country, registration_date,
              concat_ws(',', customer_id, coalesce(trim(first_name), ''), coalesce(last_name, ''),
                trim(email), trim(phone), city, state, country, registration_date) AS raw_line
            FROM raw_customers""",
        "validate_products": f"""WITH {_PRODUCTS}
            SELECT source_product_id, source_system, errors = '' AS is_valid,
              errors AS validation_errors FROM checked_products""",
        "validate_customers": f"""WITH {_CUSTOMERS}
            SELECT source_customer_id, source_system, errors = '' AS is_valid,
              errors AS validation_errors FROM checked_customers""",
        "validate_sales": f"""WITH {_SALES}
            SELECT source_sale_id, source_system, errors = '' AS is_valid,
              errors AS validation_errors FROM sales""",
        "rejection_counts": f"""WITH {_SALES},
            reasons AS (SELECT source_system, unnest({_REASONS}) AS rejection_reason, source_sale_id FROM sales)
            SELECT source_system, rejection_reason, count(*) AS rejection_count,
              CAST(to_json(coalesce(list_sort(list(DISTINCT source_sale_id)
                FILTER (source_sale_id IS NOT NULL))[1:5], [])) AS VARCHAR) AS sample_values
            FROM reasons WHERE rejection_reason IS NOT NULL GROUP BY source_system, rejection_reason""",
        "csv_line_numbers": """SELECT o_orderkey, true AS numbered_right, true AS named FROM orders""",
        "staging_customers_update": f"""WITH {_CUSTOMERS},
            users AS (SELECT CAST(k AS VARCHAR) AS source_customer_id, 'api' AS source_system,
              {_EMAIL} AS email, {_NAME} AS full_name FROM raw_customers),
            checked_users AS (SELECT *, concat_ws('; ', {', '.join(CUSTOMER_ERRORS)}) AS errors FROM users),
            valid AS (
              SELECT source_customer_id, source_system, email, full_name FROM checked_customers WHERE errors = ''
              UNION ALL
              SELECT source_customer_id, source_system, email, full_name FROM checked_users WHERE errors = ''),
            earlier AS (SELECT 'C' || c_custkey AS source_customer_id, 'csv' AS source_system,
              'old@example.com' AS email, 'Old' AS full_name FROM customer WHERE c_custkey % 2 = 0)
            SELECT coalesce(v.source_customer_id, e.source_customer_id) AS source_customer_id,
              coalesce(v.source_system, e.source_system) AS source_system,
              CASE WHEN v.source_system IS NULL THEN e.email ELSE v.email END AS email,
              CASE WHEN v.source_system IS NULL THEN e.full_name ELSE v.full_name END AS full_name,
              CASE WHEN v.source_system IS NULL THEN 'batch-1' ELSE 'batch-2' END AS batch_id,
              CASE WHEN v.source_system IS NULL THEN 'kept' WHEN e.source_system IS NULL THEN 'inserted'
                ELSE 'updated' END AS action
            FROM valid v FULL JOIN earlier e ON v.source_customer_id = e.source_customer_id
              AND v.source_system = e.source_system""",
        "staging_sales_update": f"""WITH {_STAGED_SALES},
            {_CARTS},
            cart_sales AS (SELECT source_id || '-' || i AS source_sale_id, 'api' AS source_system,
              CAST(coalesce(qty, 1) AS INTEGER) AS quantity, CAST(50 AS DECIMAL(28,10)) AS unit_price,
              CASE WHEN coalesce(qty, 1) <> 0 THEN CAST(50 * coalesce(qty, 1) AS DECIMAL(28,10)) END
                AS total_amount, {_date("cart_date")} AS sale_date FROM cart_lines),
            valid AS (
              SELECT source_sale_id, source_system, quantity FROM staged_sales
              UNION ALL
              SELECT source_sale_id, source_system, quantity FROM (
                SELECT *, concat_ws('; ', {', '.join(SALE_ERRORS)}) AS errors FROM cart_sales)
              WHERE errors = ''),
            earlier AS (SELECT l_orderkey || '-' || l_linenumber AS source_sale_id, 'csv' AS source_system,
              CAST(max(l_quantity) AS INTEGER) AS quantity FROM lineitem WHERE l_orderkey % 2 = 0
              GROUP BY l_orderkey, l_linenumber)
            SELECT coalesce(v.source_sale_id, e.source_sale_id) AS source_sale_id,
              coalesce(v.source_system, e.source_system) AS source_system,
              CASE WHEN v.source_system IS NULL THEN e.quantity ELSE v.quantity END AS quantity,
              CASE WHEN v.source_system IS NULL THEN 'batch-1' ELSE 'batch-2' END AS batch_id,
              CASE WHEN v.source_system IS NULL THEN 'kept' WHEN e.source_system IS NULL THEN 'inserted'
                ELSE 'updated' END AS action
            FROM valid v FULL JOIN earlier e ON v.source_sale_id = e.source_sale_id
              AND v.source_system = e.source_system""",
        "fact_append": f"""WITH {_RESOLVED}
            SELECT year(sale_date) AS year, month(sale_date) AS month, 2 * count(*) AS sales,
              CAST(2 * sum(total_amount) AS DECIMAL(22,2)) AS revenue
            FROM resolved WHERE skip_reason IS NULL GROUP BY ALL""",
        "ingestion_job": """SELECT 'batch-2' AS batch_id, * FROM (
              SELECT 'csv_customers' AS source_name, 'csv' AS source_type, count(*) AS records_received,
                count(*) AS records_stored, 0::BIGINT AS records_rejected,
                CAST(100 AS DECIMAL(5,2)) AS quality_score, 'success' AS status,
                CAST(NULL AS BOOLEAN) AS not_found, true AS times_in_order FROM customer
              UNION ALL
              SELECT 'api_carts', 'api', count(*), count(*), 0, 100, 'success', NULL, true FROM events
              UNION ALL
              SELECT 'csv_sales', 'csv', 0, 0, 0, 100, 'failed', true, NULL)""",
        "customer_steps": f"""WITH {_CUSTOMERS},
            counts AS (SELECT count(*) AS n, count(*) FILTER (errors <> '') AS bad FROM checked_customers)
            SELECT 'load_customers' AS step_name, 'staging.customers' AS target_table, n AS records_input,
              n - bad AS records_inserted, 0::BIGINT AS records_updated, bad AS records_rejected,
              'success' AS status FROM counts
            UNION ALL
            SELECT 'load_dim_customer', 'dw.dim_customer', n - bad, n - bad, 0, 0, 'success' FROM counts""",
        "rejected_records": f"""WITH {_SALES}
            SELECT 'csv_sales' AS source_name, source_sale_id AS record_key,
              array_to_string([x FOR x IN {_REASONS} IF x IS NOT NULL], '; ') AS rejection_reasons,
              quantity, sale_date FROM sales WHERE errors <> ''""",
        "fact_out_of_range": f"""{_SALE_LINES},
            costed AS (SELECT *, quantity * 1000 * CAST(CASE WHEN p_size % 5 = 0 THEN 99999999.99
              ELSE 1 + p_size END AS DECIMAL(10,2)) AS cost FROM lines JOIN part ON p_partkey = part)
            SELECT CASE WHEN cost >= 10000000000 THEN 'cost out of range' END AS skip_reason,
              count(*) AS sales, CAST(sum(CASE WHEN cost < 10000000000 THEN cost END) AS DECIMAL(28,2))
              AS cost_amount
            FROM costed GROUP BY 1""",
        "fact_second_load": f"""{_SALE_LINES}
            SELECT sale_id,
              part + CASE WHEN line IN (1, 3) AND p_size % 3 = 0 THEN 1000000000 ELSE 0 END AS product_key,
              quantity + CASE WHEN line = 3 THEN 1 ELSE 0 END AS quantity,
              CAST((1 + p_size + CASE WHEN line IN (1, 3) AND p_size % 3 = 0 THEN 1 ELSE 0 END)
                * (quantity + CASE WHEN line = 3 THEN 1 ELSE 0 END) AS DECIMAL(12,2)) AS cost_amount
            FROM lines JOIN part ON p_partkey = part""",
        "stream_ingest": f"""WITH {_CARTS_OF_EVENTS}
            SELECT source_sale_id, 'api' AS source_system, quantity, sale_date, n_batches FROM streamed""",
        "warehouse_run": f"WITH {_LOADED}\n" + "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS source, {key} AS key, count(*) AS orders,
              {'CAST(sum(quantity) AS BIGINT)' if name != 'month' else 'CAST(NULL AS BIGINT)'} AS quantity,
              CAST(sum(total) AS DECIMAL(22,2)) AS revenue
            FROM loaded GROUP BY ALL"""
            for name, key in {
                "daily": "strftime(day, '%Y%m%d')",
                "product": "product",
                "customer": "customer",
                "category": "concat_ws('-', category, year(day), month(day))",
                "month": "concat_ws('-', year(day), month(day))",
            }.items()
        ),
        "calendar_holidays": f"""WITH bounds AS (
              SELECT min(d) AS a, max(d) AS b FROM (
                SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem
                UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders)),
            days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)
            SELECT d AS full_date, dayname(d) AS day_name FROM days
            WHERE strftime(d, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25')
              OR d IN ({", ".join(f"DATE '{day}'" for day in _MOVING_DAYS.split())})
              OR dayofweek(d) = 1 AND (month(d) IN (1, 2) AND day(d) BETWEEN 15 AND 21
                OR month(d) = 10 AND day(d) BETWEEN 8 AND 14)""",
        "json_arrays": f"WITH {_CARTS}\n{_CART_JSON}",
        "ragged_csv": """WITH told AS (
              SELECT o_orderkey AS k, CAST(o_orderkey % 8 AS INTEGER) AS file,
                (o_orderkey % 13 = 0) <> (o_orderkey % 11 = 0) AS broken FROM orders),
            bad AS (SELECT DISTINCT file FROM told WHERE broken),
            kinds AS (
              SELECT CASE WHEN broken THEN 'reject_row_broken' ELSE 'reject_row_good' END AS kind, file, k FROM told
              UNION ALL
              SELECT CASE WHEN file IN (SELECT file FROM bad) THEN 'fail_file_broken' ELSE 'fail_file_good' END,
                file, k FROM told)
            SELECT kind, file, count(*) AS records, CAST(sum(k) AS BIGINT) AS keys FROM kinds GROUP BY kind, file""",
        "landed_day": """
            SELECT 'csv_products' AS source_name, 'csv' AS source_type, count(*) AS records, false AS not_found FROM part
            UNION ALL SELECT 'csv_customers', 'csv', count(*), false FROM customer
            UNION ALL SELECT 'csv_sales', 'csv', 0, true
            UNION ALL SELECT 'api_products', 'api', count(*), false FROM part
            UNION ALL SELECT 'api_users', 'api', count(*), false FROM customer
            UNION ALL SELECT 'api_carts', 'api', count(*), false FROM events""",
        "surrogate_keys": """SELECT l_returnflag, count(*) AS lines, count(*) AS different, count(*) AS new
            FROM lineitem GROUP BY l_returnflag""",
        "validate_raw_customers": rf"""WITH {RAW_CUSTOMERS}
            SELECT customer_id, concat_ws('; ',
              CASE WHEN email <> '' AND NOT regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}')
                THEN 'email is not a valid email' END,
              CASE WHEN registration_date <> '' AND NOT regexp_full_match(left(registration_date, 10), '\d{{4}}-\d{{1,2}}-\d{{1,2}}')
                THEN 'registration_date is not a valid date' END) AS reasons FROM raw_customers""",
        "catalog_tables": f"""WITH {_RESOLVED},
            months AS (SELECT year(sale_date) AS year, month(sale_date) AS month, count(*) AS sales,
              CAST(sum(total_amount - coalesce(cost_amount, 0)) AS DECIMAL(22,2)) AS profit
              FROM resolved WHERE skip_reason IS NULL GROUP BY ALL)
            SELECT *, (SELECT CAST(sum(sales) AS BIGINT) FROM months WHERE year <= 1996) AS seen_first,
              (SELECT max(year) FROM months WHERE year <= 1996) AS last_year_seen_first FROM months""",
        "stream_sales_once": f"""WITH {_LANDED}
            SELECT event_id, user_id, value FROM landed, mark WHERE NOT held_up OR ts > closed""",
        "stream_late_sales": f"""WITH {_LANDED}
            SELECT event_id, 'late' AS reason FROM landed, mark WHERE held_up AND ts <= closed""",
        "stream_daily_revenue": f"""WITH {_LANDED}
            SELECT CAST(ts AS DATE) AS sale_date, count(*) AS sales,
              CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS revenue
            FROM landed, mark WHERE NOT held_up AND date_trunc('day', ts) + INTERVAL 1 DAY <= closed
            GROUP BY CAST(ts AS DATE)""",
        "stream_to_staging_sales": """WITH counted AS (
              SELECT *, event_id % 7 + 1 AS q, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS more FROM events)
            SELECT CAST(event_id AS VARCHAR) AS source_sale_id, 'csv' AS source_system,
              CAST(user_id AS VARCHAR) AS source_customer_id, CAST(q + more AS INTEGER) AS quantity,
              CAST(2 * (q + more) AS DECIMAL(12,2)) AS total_amount, DATE '2001-01-01' AS sale_date,
              true AS left_alone FROM counted
            UNION ALL
            SELECT event_id || '-0', 'api', CAST(user_id AS VARCHAR), CAST(q AS INTEGER),
              CAST(50 * q AS DECIMAL(12,2)), DATE '2001-01-01', true FROM counted""",
        "staging_products": f"WITH {_STAGED_PRODUCTS} SELECT * FROM staged_products",
        "load_stats": f"""WITH {_STAGED_PRODUCTS}
            SELECT action, count(*) AS records FROM staged_products GROUP BY action""",
        "staging_customers": f"""WITH {_CUSTOMERS}
            SELECT source_customer_id, source_system, email, full_name, phone, city, state,
              country, registration_date, 'inserted' AS action
            FROM checked_customers WHERE errors = ''""",
        "staging_upsert": f"""WITH {_STAGED_SALES}
            SELECT *, 'inserted' AS action FROM staged_sales""",
        "scd2_product": _SCD_PRODUCT,
        "scd2_customer": _SCD_CUSTOMER,
        "fact_sales": f"""WITH {_RESOLVED}
            SELECT date_key, product_key, customer_key, source_sale_id AS sale_id, source_system,
              payment_method, quantity, unit_price, total_amount, cost_amount,
              year(sale_date) AS year, month(sale_date) AS month,
              CAST(total_amount - coalesce(cost_amount, 0) AS DECIMAL(14,2)) AS profit_amount
            FROM resolved WHERE skip_reason IS NULL""",
        "fact_skipped": f"""WITH {_RESOLVED}
            SELECT skip_reason, count(*) AS skipped FROM resolved
            WHERE skip_reason IS NOT NULL GROUP BY skip_reason""",
        "fact_merge": f"""WITH {_RESOLVED},
            new AS (SELECT source_sale_id AS sale_id, source_system, product_key, total_amount
              FROM resolved WHERE skip_reason IS NULL)
            SELECT * FROM new UNION ALL
            SELECT l_orderkey || '-' || l_linenumber, 'csv', l_partkey,
              CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.5 AS DECIMAL(2,1))
                AS DECIMAL(12,2))
            FROM lineitem WHERE l_orderkey || '-' || l_linenumber NOT IN (SELECT sale_id FROM new)""",
        "update_segments": f"""WITH {FACTS},
            {CUSTOMERS},
            totals AS (SELECT customer_key, sum(total_amount) AS spent, count(*) AS orders
              FROM facts GROUP BY customer_key)
            SELECT customer_id, is_current, CASE WHEN is_current AND orders IS NOT NULL THEN
              {_SEGMENT_CASE.format("spent", "orders")} ELSE customer_segment END AS customer_segment
            FROM customers LEFT JOIN totals USING (customer_key)""",
        "sales_daily": _SALES_DAILY,
        "product_performance": _PERFORMANCE,
        "customer_summary": f"WITH {_SUMMARY} SELECT * FROM summary",
        "customer_summary_bucketed": f"WITH {_SUMMARY} SELECT * FROM summary",
        "customer_rfm": _RFM,
        "category_analysis": f"WITH {_CATEGORY} SELECT * FROM analysis",
        "category_growth": _GROWTH,
        "kpi_summary": f"WITH {_KPI} SELECT * FROM kpi",
        "kpi_cards": f"""WITH {_KPI}
            SELECT total_revenue, total_orders, unique_customers, avg_order_value FROM kpi""",
        "daily_trend": f"WITH {_DAILY} SELECT * FROM daily",
        "daily_series": f"WITH {_DAILY} SELECT full_date, revenue, profit FROM daily ORDER BY 1",
        "sales_by_category": f"WITH {_BY_CATEGORY} SELECT * FROM by_category",
        "category_shares": f"WITH {_BY_CATEGORY} SELECT category, revenue FROM by_category",
        "top_products": f"WITH {_TOP} SELECT * FROM top",
        "top10_products": f"""WITH {_TOP}
            SELECT product_name, category, units_sold, revenue, revenue_rank FROM top
            ORDER BY revenue DESC, product_id LIMIT 10""",
        "customer_segments": f"WITH {_SEGMENTS} SELECT * FROM segments",
        "segment_counts": f"""WITH {_SEGMENTS}
            SELECT customer_segment, customer_count FROM segments""",
        "sales_by_region": _REGIONS,
        "monthly_sales": f"""WITH {_MONTHS}
            SELECT *, lag(revenue) OVER (ORDER BY year, month_num) AS prev_month_revenue
            FROM months""",
        "month_by_year": f"""WITH {_MONTHS}
            SELECT month_num, month_name, {_PIVOT} FROM months GROUP BY month_num, month_name""",
        "revenue_by_date_product": f"""WITH {FACTS}, {PRODUCTS}
            SELECT f.day AS full_date, p.title, {_money("sum(f.total_amount)")} AS revenue
            FROM facts f JOIN products p ON f.product_key = p.product_key GROUP BY 1, 2""",
        "ingestion_runs": f"""WITH {LOG}
            SELECT created_at, source_name, records_received, records_stored, records_rejected,
              quality_score, status, duration_seconds FROM scored""",
        "quality_summary": f"WITH {_QUALITY} SELECT * FROM quality",
        "quality_cards": f"""WITH {_QUALITY}
            SELECT overall_quality_score, total_records_received, total_records_stored,
              total_records_rejected FROM quality""",
        "status_counts": f"""WITH {_QUALITY}
            SELECT 'Success' AS status, successful_runs AS count FROM quality
            UNION ALL SELECT 'Failed', failed_runs FROM quality""",
        "quality_by_source": f"WITH {_SOURCES} SELECT * FROM sources",
        "source_volumes": f"""WITH {_SOURCES}
            SELECT source_name, total_received, total_stored, total_rejected FROM sources""",
        "quality_trend": f"WITH {_TREND} SELECT * FROM trend",
        "quality_series": f"WITH {_TREND} SELECT run_date, avg_quality_score FROM trend ORDER BY 1",
        "recent_runs": f"""WITH {LOG} SELECT {_RUN_COLUMNS} FROM scored
            ORDER BY created_at DESC, batch_id, source_name LIMIT 100""",
        "run_table": f"""WITH {LOG}
            SELECT pipeline_name, source_name, records_received, records_stored, quality_score,
              status, created_at FROM scored
            ORDER BY created_at DESC, batch_id, source_name LIMIT 20""",
        "run_summary": f"""WITH {LOG}
            SELECT source_name, CAST(sum(records_received) AS BIGINT) AS received,
              CAST(sum(records_stored) AS BIGINT) AS stored,
              CAST(sum(records_rejected) AS BIGINT) AS rejected,
              grouping(source_name) = 1 AS is_total,
              {_percent("sum(records_stored)", "sum(records_received)")} AS quality_score
            FROM scored GROUP BY ROLLUP (source_name)""",
        "rejection_analysis": f"""WITH {DETAILS}
            SELECT source_name, rejection_reason, CAST(sum(rejection_count) AS BIGINT)
              AS total_rejections, count(DISTINCT batch_id) AS affected_batches
            FROM details GROUP BY source_name, rejection_reason""",
        "rule_results": _RULES,
        "daily_quality_summary": _DAILY_QUALITY,
    }
