"""The same results in DuckDB SQL, for checking."""

from millrace.functions.routing import ROUTES
from millrace.functions.synth import DRAW_DIGITS
from millrace.operators import generate as g
from millrace.plans import temporal
from millrace.plans.queries import SEED

RAW = """
raw AS (
  SELECT
    CASE WHEN NOT (l_discount = 0 AND l_tax = 0)
         THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
    p_name AS product_name,
    p_type AS category,
    CASE WHEN l_discount > 0.095 AND l_tax > 0.075 THEN 'N/A'
         WHEN l_linenumber = 7 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.7'
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CASE WHEN p_size = 50 THEN 'N/A'
         ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
    CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS total_price,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'pending'
         ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS order_timestamp,
    CASE WHEN c_acctbal >= -900 THEN r_name END AS region
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

# Numbers that are not numbers become null; integers lose their fraction.
INT = "CAST(trunc(TRY_CAST(quantity AS DOUBLE)) AS INTEGER)"
DOUBLE = "TRY_CAST(unit_price AS DOUBLE)"
DATE = "TRY_CAST(left(order_timestamp, 10) AS DATE)"


def _clean(source: str) -> str:
    return f"""
clean AS (
  SELECT order_id, product_name, category, {INT} AS quantity,
         {DOUBLE} AS unit_price, total_price, customer_id, order_timestamp, region,
         {DATE} AS order_date, {INT} * {DOUBLE} AS revenue
  FROM {source} WHERE order_id IS NOT NULL
)"""


CLEAN = _clean("raw")

USERS = """
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         replace(lower(c_name), '#', '.') || '@example.com' AS email,
         n_name AS country,
         CAST(CAST(DATE '2020-01-01' + c_nationkey AS DATE) AS VARCHAR) AS signup_date,
         c_acctbal > 0 AS is_active
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

TRANSACTIONS = """
transactions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS txn_id, CAST(o_custkey AS VARCHAR) AS user_id,
         o_totalprice AS amount, 'USD' AS currency,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
              ELSE 'failed' END AS status,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS txn_date,
         o_orderpriority AS merchant
  FROM orders
)"""

OPERATION = """CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE'
              ELSE 'UPDATE' END"""

# Spark prints no trailing zeros in a fraction of a second, and no empty fraction.
ISO_TS = """rtrim(rtrim(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '0'), '.') || 'Z'"""

DAILY = """
SELECT order_date, region, count(*) AS order_count,
       CAST(sum(quantity) AS BIGINT) AS units,
       CAST(sum(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM clean GROUP BY order_date, region"""


def _scd2(key: str, attributes: str) -> str:
    return f"""
SELECT {key}, {attributes}, valid_from, valid_to, valid_to IS NULL AS is_current
FROM (
  SELECT *, lead(valid_from) OVER (PARTITION BY order_id ORDER BY valid_from, change_id)
            AS valid_to
  FROM log
) WHERE operation <> 'DELETE' AND (valid_to IS NULL OR valid_to > valid_from)"""


LOG = f"""
log AS (
  SELECT user_id AS order_id, {OPERATION} AS operation, ts AS valid_from,
         event_id AS change_id, value, props
  FROM events
)"""


def _case(column: str) -> str:
    branches = []
    for pattern, prefix in ROUTES:
        start, end = pattern.split("*")
        branches.append(
            f"WHEN starts_with({column}, '{start}') AND ends_with({column}, '{end}') "
            f"THEN '{prefix}'"
        )
    return f"CASE {' '.join(branches)} END"


# Generators


def _digest(label: str, key: str, seed: int = SEED) -> str:
    return f"md5(concat_ws(':', {seed}, '{label}', {key}))"


def _draw(label: str, key: str, below, seed: int = SEED) -> str:
    head = f"CAST('0x' || substr({_digest(label, key, seed)}, 1, {DRAW_DIGITS}) AS BIGINT)"
    return f"({head} % {below})"


def _uuid(label: str, key: str, seed: int = SEED) -> str:
    text = _digest(label, key, seed)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return "concat_ws('-', " + ", ".join(f"substr({text}, {a}, {n})" for a, n in cuts) + ")"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pick(label: str, values, key: str = "id", seed: int = SEED) -> str:
    return f"{_list(values)}[{_draw(label, key, len(values), seed)} + 1]"


def _moment(start: str, seconds: str) -> str:
    return (
        f"strftime(TIMESTAMP '{start}' + to_seconds({seconds}), '%Y-%m-%dT%H:%M:%SZ')"
    )


BUYERS = "(SELECT count(*) FROM customer)"


def _generated_sales(seed: int, users: str = BUYERS) -> dict[str, str]:
    quantity = f"({_draw('quantity', 'id', 20, seed)} + 1)"
    cents = f"({_draw('unit_price', 'id', 49_901, seed)} + 100)"
    product = f"[{_draw('product', 'id', len(g.PRODUCTS), seed)} + 1]"
    return {
        "order_id": _uuid("order", "id", seed),
        "product_name": _list(p[0] for p in g.PRODUCTS) + product,
        "category": _list(p[1] for p in g.PRODUCTS) + product,
        "quantity": f"CAST({quantity} AS INTEGER)",
        "unit_price": f"CAST({cents} AS DOUBLE) / 100",
        "total_price": f"CAST({quantity} * {cents} AS DOUBLE) / 100",
        "customer_id": _uuid("user", _draw("buyer", "id", users, seed), SEED),
        "order_timestamp": _moment("2024-01-01", _draw("ordered", "id", 366 * g.DAY, seed)),
        "region": _pick("region", g.REGIONS, seed=seed),
    }


def _select(columns: dict[str, str], source: str) -> str:
    return (
        "SELECT " + ",\n".join(f"{v} AS {k}" for k, v in columns.items()) + f" FROM {source}"
    )


def _ids(name: str, key: str) -> str:
    return f"(SELECT {key} AS id FROM {name})"


def _g1() -> str:
    columns = _generated_sales(SEED)
    missing = f"{_draw('missing', 'id', g.RATE_STEPS)} < {g.RATE_STEPS // 100}"
    columns["order_id"] = f"CASE WHEN NOT {missing} THEN {columns['order_id']} END"
    return _select(columns, _ids("orders", "o_orderkey"))


def _g2() -> str:
    first, last = _pick("first_name", g.FIRST_NAMES), _pick("last_name", g.LAST_NAMES)
    signup = f"DATE '2020-01-01' + CAST({_draw('signup', 'id', 4 * 365)} AS INTEGER)"
    return _select(
        {
            "user_id": _uuid("user", "id"),
            "first_name": first,
            "last_name": last,
            "email": f"lower({first} || '.' || {last}) || '@example.com'",
            "country": _pick("country", g.COUNTRIES),
            "signup_date": f"CAST(CAST({signup} AS DATE) AS VARCHAR)",
            "is_active": f"{_draw('active', 'id', 10)} < 8",
        },
        _ids("customer", "c_custkey"),
    )


def _g3() -> str:
    tenth = _draw("status", "id", 10)
    day = f"DATE '2024-01-01' + CAST({_draw('day', 'id', 366)} AS INTEGER)"
    return _select(
        {
            "txn_id": _uuid("transaction", "id"),
            "user_id": _uuid("user", _draw("payer", "id", BUYERS)),
            "amount": f"CAST({_draw('amount', 'id', 199_501)} + 500 AS DOUBLE) / 100",
            "currency": _pick("currency", g.CURRENCIES),
            "status": f"CASE WHEN {tenth} < 7 THEN 'completed' "
            f"WHEN {tenth} < 9 THEN 'pending' ELSE 'failed' END",
            "txn_date": f"CAST(CAST({day} AS DATE) AS VARCHAR)",
            "merchant": _pick("merchant", g.MERCHANTS),
        },
        _ids("orders", "o_orderkey"),
    )


def _g4_full() -> str:
    columns = _generated_sales(SEED)
    columns["operation"] = "'INSERT'"
    columns["updated_at"] = columns["order_timestamp"]
    return _select(columns, _ids("orders", "o_orderkey"))


def _g4() -> str:
    columns = _generated_sales(SEED + 1)
    tenth = _draw("operation", "id", 10)
    base = "(SELECT count(*) FROM orders)"
    key = f"CASE WHEN {tenth} < 2 THEN id + {base} ELSE {_draw('changed', 'id', base)} END"
    columns["order_id"] = _uuid("order", key)
    columns["operation"] = (
        f"CASE WHEN {tenth} < 2 THEN 'INSERT' WHEN {tenth} < 8 THEN 'UPDATE' "
        "ELSE 'DELETE' END"
    )
    columns["updated_at"] = _moment("2025-01-01", _draw("updated", "id", 30 * g.DAY))
    return _select(columns, _ids("events", "event_id"))


RAW_SALES = f"WITH {RAW} SELECT * FROM raw"
CLEAN_SALES = f"WITH {RAW}, {CLEAN} SELECT * FROM clean"

# Types of the job's output as Spark names them; the partition column comes last.
REPORT = ", ".join(
    f"('{name}', '{kind}', {i}, count({name}))"
    for i, (name, kind) in enumerate(
        (
            ("order_id", "string"),
            ("product_name", "string"),
            ("category", "string"),
            ("quantity", "int"),
            ("unit_price", "double"),
            ("total_price", "string"),
            ("customer_id", "string"),
            ("order_timestamp", "string"),
            ("order_date", "date"),
            ("revenue", "double"),
            ("region", "string"),
        )
    )
)

ORACLES = {
    "s1_csv_scan": RAW_SALES,
    "s2_schema_tolerant": f"""
WITH {RAW} SELECT * REPLACE (
  CASE WHEN order_timestamp < '1998' THEN total_price END AS total_price) FROM raw""",
    "s3_inline_table": f"""
WITH {RAW}, extra AS (
  SELECT * FROM raw UNION ALL SELECT * FROM (VALUES
    ('in-1', 'Kite', 'Toys', '4', '2.25', '9.00', '77', '2024-02-03T04:05:06Z', 'ASIA'),
    (NULL, 'Kite', 'Toys', '1', '2.25', '2.25', '78', '2024-02-03T05:05:06Z', 'ASIA'),
    ('in-2', 'Drum', 'Toys', 'x', '8.50', '8.50', NULL, '2024-02-04T00:00:00Z', NULL))
), {_clean("extra")} SELECT * FROM clean""",
    "s4_route_files": f"""
SELECT doc_id, file_name, {_case("file_name")} AS prefix FROM (
  SELECT doc_id, ['sales_', 'users_', 'transactions_', 'cdc_'][n_chars % 4 + 1] || lang
         || ['.csv', '.json', '.parquet', '.txt'][length(source) % 4 + 1] AS file_name
  FROM documents)""",
    "s5_manifest": f"""
SELECT file_name, {_case("file_name")} AS prefix,
       '/processed/' || {_case("file_name")} || file_name AS target
FROM (
  SELECT DISTINCT CASE o_orderpriority
      WHEN '1-URGENT' THEN 'sales_' || year(o_orderdate) || '.csv'
      WHEN '2-HIGH' THEN 'users_' || year(o_orderdate) || '.json'
      WHEN '3-MEDIUM' THEN 'transactions_' || year(o_orderdate) || '.parquet'
      WHEN '5-LOW' THEN 'cdc_' || year(o_orderdate) || '.csv'
      ELSE 'notes_' || year(o_orderdate) || '.txt' END AS file_name
  FROM orders)
WHERE {_case("file_name")} IS NOT NULL""",
    "s6_json": f"WITH {USERS} SELECT * FROM users",
    "s7_parquet": f"WITH {TRANSACTIONS} SELECT * FROM transactions",
    "s8_cdc_csv": f"""
SELECT CAST(user_id AS VARCHAR) AS order_id, event_type AS product_name,
       props AS category, '1' AS quantity,
       CAST(CAST(value AS DECIMAL(14,2)) AS VARCHAR) AS unit_price,
       CAST(CAST(value AS DECIMAL(14,2)) AS VARCHAR) AS total_price,
       CAST(event_id AS VARCHAR) AS customer_id, {ISO_TS} AS order_timestamp,
       CAST(NULL AS VARCHAR) AS region, {OPERATION} AS operation,
       {ISO_TS} AS updated_at
FROM events""",
    "f1_not_null": f"WITH {RAW} SELECT * FROM raw WHERE order_id IS NOT NULL",
    "f2_partition_read": f"{CLEAN_SALES} WHERE region = 'EUROPE'",
    "p1_columns": f"""
WITH {RAW} SELECT * REPLACE (lower(category) AS category),
  concat_ws('/', region, product_name) AS label FROM raw""",
    "p2_double": f"WITH {RAW} SELECT unit_price, {DOUBLE} AS as_double FROM raw",
    "p3_int": f"WITH {RAW} SELECT quantity, {INT} AS as_int FROM raw",
    "p4_date": f"WITH {RAW} SELECT order_timestamp, {DATE} AS as_date FROM raw",
    "p5_revenue": f"""
WITH {RAW} SELECT quantity, unit_price, {INT} * {DOUBLE} AS revenue FROM raw""",
    "p6_clean_sales": CLEAN_SALES,
    "p7_without_total": f"WITH {RAW}, {CLEAN} SELECT * EXCLUDE (total_price) FROM clean",
    "a1_row_metrics": f"""
WITH {RAW} SELECT count(*) AS rows_read, count(order_id) AS rows_kept FROM raw""",
    "l1_preview": f"""
{CLEAN_SALES} ORDER BY order_id, product_name, category, quantity NULLS FIRST,
  unit_price NULLS FIRST, total_price, customer_id, order_timestamp,
  region NULLS FIRST, order_date NULLS FIRST, revenue NULLS FIRST LIMIT 5""",
    "l2_schema_report": f"""
WITH {RAW}, {CLEAN}
SELECT r.name AS column, r.type AS type, true AS nullable,
       CAST(r.position AS INTEGER) AS position, r.filled AS filled
FROM (SELECT unnest([{REPORT}]::STRUCT(name VARCHAR, type VARCHAR, position INTEGER,
      filled BIGINT)[]) AS r FROM clean)""",
    "k1_partition_roundtrip": CLEAN_SALES,
    "k2_commit": CLEAN_SALES,
    "k3_formats": f"""
WITH {RAW}, {USERS}, {TRANSACTIONS},
lines AS (SELECT order_id, count(*) AS lines FROM raw GROUP BY order_id)
SELECT txn_id, t.user_id, amount, status, country, is_active, lines
FROM transactions t JOIN users u ON t.user_id = u.user_id
JOIN lines ON txn_id = order_id""",
    "k4_catalog": CLEAN_SALES,
    "j1_simple_etl": CLEAN_SALES,
    "j1_json": CLEAN_SALES,
    "g1_sales": _g1(),
    "g2_users": _g2(),
    "g3_transactions": _g3(),
    "g4_changes_full": _g4_full(),
    "g4_changes": _g4(),
    "c1_incremental": CLEAN_SALES,
    "c2_current_state": f"""
WITH {LOG}
SELECT order_id, valid_from AS updated_at, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id
            ORDER BY valid_from DESC, change_id DESC) AS n FROM log
) WHERE n = 1 AND operation <> 'DELETE'""",
    "c3_scd2": f"WITH {LOG} {_scd2('order_id', 'value, props')}",
    "c3_scd2_collapsed": f"""
WITH {LOG.replace("value, props", "value >= 50 AS large")},
alive AS (
  SELECT * FROM log
  QUALIFY lead(valid_from) OVER (PARTITION BY order_id ORDER BY valid_from, change_id)
          IS DISTINCT FROM valid_from
),
before AS (
  SELECT *, lag(operation) OVER w AS old_operation, lag(large) OVER w AS old_large
  FROM alive WINDOW w AS (PARTITION BY order_id ORDER BY valid_from)
),
changed AS (
  SELECT * FROM before
  WHERE old_operation IS NULL OR old_operation = 'DELETE' OR operation = 'DELETE'
     OR large IS DISTINCT FROM old_large
),
versions AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY order_id ORDER BY valid_from) AS valid_to
  FROM changed
)
SELECT order_id, large, valid_from, valid_to, valid_to IS NULL AS is_current
FROM versions WHERE operation <> 'DELETE'""",
    "c4_scd2_incremental": f"WITH {LOG} {_scd2('order_id', 'value, props')}",
    "c4_change_files": f"""
WITH log AS (
  SELECT CAST(user_id AS VARCHAR) AS order_id, event_type AS product_name,
         props AS category, CAST(CAST(value AS DECIMAL(14,2)) AS VARCHAR) AS unit_price,
         {OPERATION} AS operation, ts AS valid_from, event_id AS change_id
  FROM events
) {_scd2('order_id', 'product_name, category, unit_price')}""",
    "m1_pipeline": f"WITH {RAW}, {CLEAN} {DAILY}",
    "m2_enrich": f"""
WITH {RAW}, {CLEAN}, {USERS}
SELECT clean.*, users.* EXCLUDE (user_id)
FROM clean LEFT JOIN users ON customer_id = user_id""",
    "m3_daily_region": f"WITH {RAW}, {CLEAN} {DAILY}",
    "q1_sql": f"""
WITH {RAW}, {CLEAN}, {USERS}
SELECT u.country, s.category, count(*) AS orders,
       CAST(sum(s.quantity) AS BIGINT) AS units
FROM clean s JOIN users u ON s.customer_id = u.user_id
WHERE s.revenue >= 1000 AND u.is_active
GROUP BY u.country, s.category""",
} | temporal.ORACLES
ORACLES["c4_change_files_in_order"] = ORACLES["c4_change_files"]
ORACLES["m3_rollup"] = f"""
WITH {RAW}, {CLEAN}
SELECT order_date, region, category, GROUPING(order_date, region, category) AS grouping_id, count(*) AS order_count,
       CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM clean GROUP BY ROLLUP (order_date, region, category)"""
ORACLES["m3_sketches"] = f"""
WITH {RAW}, {CLEAN}
SELECT coalesce(strftime(order_date, '%Y-%m'), 'none') AS month, count(DISTINCT customer_id) AS buyers,
       true AS buyers_near, true AS median_near
FROM clean GROUP BY 1"""
ORACLES["e_event_totals"] = """
SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY 1, 2"""
