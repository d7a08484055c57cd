"""Independent DuckDB SQL for every registered query with an exact answer.

The SQL restates the fixture mapping directly on the given tables (it never
reads our files or tables), so a wrong reader, cleaner, dedupe, stream or
join shows up as a mismatch.  Column names and types match the Spark
outputs: epoch seconds for timestamps, DOUBLE cast from exact DECIMAL for
money, BIGINT counts.
"""

from __future__ import annotations

# Fixed values, restated here on purpose: the expectations must not come from
# the code they check.
ROUTES = [("fixed_width", 1996), ("tab_separated", 1998), ("comma_separated", 2000)]
DIRTY_MODULUS = 7
MONTH_RANGE, MONTH_STATE = ("1997-01", "1997-06"), "AC"
Q2_COLOR, Q2_STATE = "red", "AA"
RAW_ORDER_COLUMNS = (
    "submitted_at order_id customer_id sales_rep_id sales_rep_ssn sales_rep_first_name sales_rep_last_name sales_rep_address sales_rep_city "
    "sales_rep_state sales_rep_zip shipping_address_attention shipping_address_address shipping_address_city shipping_address_state "
    "shipping_address_zip product_id product_quantity product_sold_price"
).split()
# Width of each raw column in the fixed-width files.
WIDTHS = {'submitted_at': 15, 'order_id': 40, 'customer_id': 40, 'sales_rep_id': 40, 'sales_rep_ssn': 15, 'sales_rep_first_name': 15, 'sales_rep_last_name': 15, 'sales_rep_address': 40, 'sales_rep_city': 20, 'sales_rep_state': 2, 'sales_rep_zip': 5, 'shipping_address_attention': 30, 'shipping_address_address': 40, 'shipping_address_city': 20, 'shipping_address_state': 2, 'shipping_address_zip': 5, 'product_id': 40, 'product_quantity': 5, 'product_sold_price': 20}
ORDERS_COLUMNS = (
    "submitted_at submitted_yyyy_mm order_id customer_id sales_rep_id shipping_address_attention shipping_address_address "
    "shipping_address_city shipping_address_state shipping_address_zip ingest_file_name ingested_at"
).split()
EXPECTED_LENGTHS = {
    "submitted_at": [9],
    "sales_rep_ssn": [9, 11],
    "sales_rep_state": [2],
    "sales_rep_zip": [5],
    "shipping_address_state": [2],
    "shipping_address_zip": [5],
}
EXPECTED_MONTHS = 80  # 1995-01 to 2001-08


def _route_case(year_expr: str) -> str:
    whens = " ".join(f"WHEN {year_expr} <= {last} THEN '{name}'" for name, last in ROUTES)
    return f"CASE {whens} ELSE 'stream' END"


def _route_rank(col: str) -> str:
    whens = " ".join(f"WHEN {col} = '{name}' THEN {i}" for i, (name, _) in enumerate(ROUTES))
    return f"CASE {whens} ELSE {len(ROUTES)} END"


def _state(k: str) -> str:
    return f"(chr(CAST(65 + {k} // 5 AS INTEGER)) || chr(CAST(65 + {k} % 5 AS INTEGER)))"


_DIGITS = "lpad(CAST(s_suppkey AS VARCHAR), 9, '0')"

BASE = f"""
rep AS (
  SELECT l_orderkey AS o_orderkey, first(l_suppkey ORDER BY l_linenumber, l_suppkey) AS rep_suppkey
  FROM lineitem GROUP BY l_orderkey
),
ox AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, c.c_name, c.c_nationkey, cn.n_name AS c_nation,
         s.s_suppkey, s.s_name, s.s_nationkey, sn.n_name AS s_nation,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS ep,
         {_route_case('year(o.o_orderdate)')} AS route
  FROM orders o
  LEFT JOIN rep r ON r.o_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  LEFT JOIN supplier s ON r.rep_suppkey = s.s_suppkey
  LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
),
raw AS (
  SELECT CAST(ep AS VARCHAR) AS submitted_at,
         CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(s_suppkey AS VARCHAR) AS sales_rep_id,
         CASE WHEN s_suppkey % 3 = 0 OR (s_suppkey % 3 = 1 AND route = 'tab_separated')
              THEN substr({_DIGITS}, 1, 3) || '-' || substr({_DIGITS}, 4, 2) || '-' || substr({_DIGITS}, 6, 4)
              ELSE {_DIGITS} END AS sales_rep_ssn,
         split_part(s_name, '#', 1) AS sales_rep_first_name,
         split_part(s_name, '#', 2) AS sales_rep_last_name,
         CAST(s_suppkey AS VARCHAR) || ' Commerce St' AS sales_rep_address,
         s_nation AS sales_rep_city,
         {_state('s_nationkey')} AS sales_rep_state,
         lpad(CAST((s_suppkey * 7919) % 100000 AS VARCHAR), 5, '0') AS sales_rep_zip,
         CASE WHEN o_orderkey % {DIRTY_MODULUS} IN (0, 1) THEN NULL ELSE c_name END AS shipping_address_attention,
         CAST(o_custkey AS VARCHAR) || ' Main St' AS shipping_address_address,
         c_nation AS shipping_address_city,
         {_state('c_nationkey')} AS shipping_address_state,
         lpad(CAST((o_custkey * 104729) % 100000 AS VARCHAR), 5, '0') AS shipping_address_zip,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS product_quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS product_sold_price,
         route AS source,
         o_orderkey, o_orderdate, s_suppkey, l_extendedprice, l_quantity
  FROM lineitem JOIN ox ON lineitem.l_orderkey = ox.o_orderkey
  WHERE route <> 'stream'
),
sdoc AS (SELECT * FROM ox WHERE route = 'stream'),
orders_batch AS (
  SELECT DISTINCT ep AS submitted_epoch, strftime(o_orderdate, '%Y-%m') AS submitted_yyyy_mm,
         order_id, customer_id, sales_rep_id, shipping_address_attention, shipping_address_address,
         shipping_address_city, shipping_address_state, CAST(shipping_address_zip AS BIGINT) AS shipping_address_zip,
         source
  FROM raw JOIN (SELECT o_orderkey AS k, ep FROM ox) e ON e.k = raw.o_orderkey
),
orders_stream AS (
  SELECT ep AS submitted_epoch, strftime(o_orderdate, '%Y-%m') AS submitted_yyyy_mm,
         CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(s_suppkey AS VARCHAR) AS sales_rep_id, c_name AS shipping_address_attention,
         CAST(o_custkey AS VARCHAR) || ' Main St' AS shipping_address_address,
         c_nation AS shipping_address_city, {_state('c_nationkey')} AS shipping_address_state,
         CAST((o_custkey * 104729) % 100000 AS BIGINT) AS shipping_address_zip, 'stream' AS source
  FROM sdoc
),
orders_final AS (SELECT * FROM orders_batch UNION ALL SELECT * FROM orders_stream),
items_batch AS (
  SELECT order_id, product_id, CAST(l_quantity AS BIGINT) AS product_quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS sold_dec, source
  FROM raw
),
items_stream AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS BIGINT) AS product_quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS sold_dec,
         'stream' AS source
  FROM lineitem JOIN sdoc ON lineitem.l_orderkey = sdoc.o_orderkey
),
items_final AS (SELECT * FROM items_batch UNION ALL SELECT * FROM items_stream),
products_all AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         split_part(p_name, ' ', 1) AS color,
         split_part(p_name, ' ', 2) AS model_name,
         p_brand AS model_number,
         p_retailprice AS base_price,
         CAST(CASE WHEN p_partkey % 11 = 10 THEN '1.10' ELSE '1.0' || CAST(p_partkey % 11 AS VARCHAR) END AS DOUBLE) AS color_adj,
         CAST(CASE WHEN p_size % 11 = 10 THEN '1.00' ELSE '0.9' || CAST(p_size % 11 AS VARCHAR) END AS DOUBLE) AS size_adj,
         CASE WHEN p_size > 25 THEN p_retailprice END AS price,
         CAST(p_size AS VARCHAR) AS size
  FROM part
),
products AS (SELECT * FROM products_all WHERE price IS NOT NULL),
reps AS (
  SELECT sales_rep_id, CAST(replace(sales_rep_ssn, '-', '') AS BIGINT) AS sales_rep_ssn,
         sales_rep_first_name, sales_rep_last_name, sales_rep_address, sales_rep_city, sales_rep_state,
         CAST(sales_rep_zip AS BIGINT) AS sales_rep_zip,
         arg_min(source, {_route_rank('source')}) AS source,
         bool_or(sales_rep_ssn LIKE '%-%') AS _error_ssn_format
  FROM raw
  GROUP BY ALL
)
"""


def _with(body: str) -> str:
    return f"WITH {BASE.strip()}\n{body.strip()}"


_RAW_COLS = ", ".join(RAW_ORDER_COLUMNS)
_ORDER_COLS = (
    "submitted_epoch, submitted_yyyy_mm, order_id, customer_id, sales_rep_id, shipping_address_attention, "
    "shipping_address_address, shipping_address_city, shipping_address_state, shipping_address_zip, source"
)
_ITEM_COLS = "order_id, product_id, product_quantity, CAST(sold_dec AS DOUBLE) AS product_sold_price, source"
_FOUR_WAY = """
  FROM items_final li
  JOIN products p ON li.product_id = p.product_id
  JOIN orders_final o ON li.order_id = o.order_id
  JOIN reps r ON o.sales_rep_id = r.sales_rep_id
"""
_PROFIT = (
    "SELECT r.sales_rep_id, r.sales_rep_first_name, r.sales_rep_last_name, "
    "CAST(sum((li.sold_dec - CAST(p.price AS DECIMAL(10,2))) * li.product_quantity) AS DOUBLE) AS total_profit"
    + _FOUR_WAY
    + "GROUP BY r.sales_rep_id, r.sales_rep_first_name, r.sales_rep_last_name"
)


def _null_profile_sql() -> str:
    parts = [
        f"SELECT source, '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls "
        f"FROM raw GROUP BY source"
        for c in RAW_ORDER_COLUMNS
    ]
    return _with(" UNION ALL ".join(parts))


def _cleanliness_sql() -> str:
    """Injected defects in the delimited files; in the fixed-width files also
    the padding of every value shorter than its field."""
    k = f"o_orderkey % {DIRTY_MODULUS}"
    parts = []
    for c in RAW_ORDER_COLUMNS:
        attention = c == "shipping_address_attention"
        blank, null = (f"{k} = 0", f"{k} = 1") if attention else (f"{c} IS NULL", "false")
        # As written: the cleaned value in the raw CTE lost its defects.
        written = f"(CASE WHEN {k} = 0 THEN 0 WHEN {k} = 1 THEN 4 ELSE length({c}) + CASE WHEN {k} = 2 THEN 4 ELSE 0 END END)"
        written = written if attention else f"length(coalesce({c}, ''))"
        padded = f"{written} < {WIDTHS[c]}" + (f" OR {k} = 2" if attention else "")
        for where, untrimmed in (("= 'fixed_width'", padded), ("<> 'fixed_width'", f"{k} = 2" if attention else "false")):
            parts.append(
                f"SELECT 'raw:' || source AS dataset, '{c}' AS column_name, CAST(count(*) FILTER (WHERE {untrimmed}) AS BIGINT) AS untrimmed, "
                f"CAST(count(*) FILTER (WHERE {blank}) AS BIGINT) AS blank, CAST(count(*) FILTER (WHERE {null}) AS BIGINT) AS null_literal "
                f"FROM raw WHERE source {where} GROUP BY source"
            )
        parts.append(
            f"SELECT 'ingested' AS dataset, '{c}' AS column_name, CAST(0 AS BIGINT) AS untrimmed, "
            f"CAST(0 AS BIGINT) AS blank, CAST(0 AS BIGINT) AS null_literal"
        )
    return _with(" UNION ALL ".join(parts))


def _lengths_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE length({c}) NOT IN ({', '.join(map(str, ls))})) AS BIGINT) "
        f"AS violations, CAST(count({c}) AS BIGINT) AS checked FROM raw"
        for c, ls in EXPECTED_LENGTHS.items()
    ]
    return _with(" UNION ALL ".join(parts))


def _non_null_sql() -> str:
    exprs = {
        "submitted_at": "submitted_epoch",
        "ingest_file_name": "source",
        "ingested_at": "source",
    }
    parts = [
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {exprs.get(c, c)} IS NULL) AS BIGINT) AS nulls "
        f"FROM orders_final"
        for c in ORDERS_COLUMNS
    ]
    return _with(" UNION ALL ".join(parts))


def _cast_failures_sql() -> str:
    casts = {
        "submitted_at": "BIGINT",
        "sales_rep_ssn": "BIGINT",
        "sales_rep_zip": "INTEGER",
        "shipping_address_zip": "INTEGER",
        "product_quantity": "INTEGER",
        "product_sold_price": "DECIMAL(10,2)",
    }
    spark_names = {"BIGINT": "bigint", "INTEGER": "int", "DECIMAL(10,2)": "decimal(10,2)"}
    parts = []
    for c, t in casts.items():
        v = f"replace({c}, '-', '')" if c == "sales_rep_ssn" else c
        parts.append(
            f"SELECT '{c}' AS column_name, '{spark_names[t]}' AS target_type, "
            f"CAST(count(*) FILTER (WHERE {v} IS NOT NULL AND TRY_CAST({v} AS {t}) IS NULL) AS BIGINT) AS failures FROM raw"
        )
    return _with(" UNION ALL ".join(parts))


_EXPECTED_COUNTS = """
expected AS (
  SELECT 'orders' AS table_name, CAST(count(*) AS BIGINT) AS expected FROM orders_final
  UNION ALL SELECT 'line_items', CAST(count(*) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'products', CAST(count(*) AS BIGINT) FROM part WHERE p_size > 25
  UNION ALL SELECT 'sales_reps', CAST(count(DISTINCT s_suppkey) AS BIGINT) FROM raw
)
"""


def _month_index(m: str) -> str:
    return f"(CAST(substr({m}, 1, 4) AS INTEGER) * 12 + CAST(substr({m}, 6, 2) AS INTEGER))"


_KEPT = "submitted_yyyy_mm NOT IN ('1995-01', '1998-03', '2001-08')"


def _row(suite: str, check: str, violations: str, total: str, source: str = "") -> str:
    return f"SELECT '{suite}' AS suite, '{check}' AS check_id, CAST({violations} AS BIGINT) AS violations, CAST({total} AS BIGINT) AS total {source}"


# What every check of the gate must report on the data as it is.
_CHECK_ROWS = " UNION ALL ".join(
    [
        _row("install", "raw_files", "0", "5"),
        _row("ingest", "clean_strings", "0", str(len(RAW_ORDER_COLUMNS))),
        _row("ingest", "value_lengths", "0", f"sum({' + '.join(f'({c} IS NOT NULL)::INT' for c in EXPECTED_LENGTHS)})", "FROM raw"),
        _row("ingest", "file_year", "0", "count(*)", "FROM raw"),
        _row("ingest", "ingest_date", "0", "count(*)", "FROM raw"),
        _row("normalize", "non_null_keys", "0", "4 * count(*)", "FROM orders_final"),
        _row("normalize", "month_partitions", f"{EXPECTED_MONTHS} - count(DISTINCT submitted_yyyy_mm)", str(EXPECTED_MONTHS), "FROM orders_final"),
        _row("normalize", "row_counts", "0", "3"),
        _row("normalize", "flag_count", "0", "1"),
        _row("normalize", "schema_sales_reps", "0", "11"),
        _row("normalize", "schema_orders", "0", "12"),
        _row("normalize", "schema_line_items", "0", "6"),
        _row("products", "adj_range", "0", "2"),
        _row("products", "xml_count", "0", "count(*)", "FROM part"),
        _row("products", "schema_products", "0", "9"),
        _row("stream", "trigger_count", "0", "1"),
        _row("stream", "reconcile", "0", "2"),
        _row("questions", "q1_equal", "0", "count(DISTINCT shipping_address_state)", "FROM orders_final"),
        _row("questions", "q2_answered", "0", "1"),
        _row("questions", "q3_one_row", "0", "1"),
    ]
)

# The same of two stages on the data with injected defects.
_DEFECT_ROWS = (
    ", defect_counts AS ("
    + " UNION ALL ".join(
        [
            _row("ingest", "clean_strings", "count(*) FILTER (WHERE o_orderkey % 23 = 0)", str(len(RAW_ORDER_COLUMNS)), "FROM raw"),
            _row(
                "ingest",
                "value_lengths",
                "count(*) FILTER (WHERE o_orderkey % 11 = 0) + count(*) FILTER (WHERE o_orderkey % 13 = 0)",
                f"sum({' + '.join(f'({c} IS NOT NULL)::INT' for c in EXPECTED_LENGTHS)})",
                "FROM raw",
            ),
            _row("ingest", "file_year", "count(*) FILTER (WHERE o_orderkey % 13 = 0)", "count(*)", "FROM raw"),
            _row("ingest", "ingest_date", "0", "count(*)", "FROM raw"),
            _row("normalize", "non_null_keys", "count(*) FILTER (WHERE CAST(order_id AS BIGINT) % 19 = 0)", "4 * count(*)", f"FROM orders_final WHERE {_KEPT}"),
            _row("normalize", "month_partitions", f"{EXPECTED_MONTHS} - count(DISTINCT submitted_yyyy_mm)", str(EXPECTED_MONTHS), f"FROM orders_final WHERE {_KEPT}"),
            _row("normalize", "row_counts", "1", "3"),
            _row("normalize", "flag_count", "0", "1"),
        ]
    )
    + "), defect_rows AS (SELECT suite, check_id, CASE WHEN violations = 0 THEN 'passed' ELSE 'failed' END AS status, violations, total FROM defect_counts)"
)


ORACLE_SQL: dict[str, str] = {
    "fixed_width_ingest": _with(f"SELECT {_RAW_COLS}, source FROM raw WHERE source = 'fixed_width'"),
    "tsv_ingest": _with(f"SELECT {_RAW_COLS}, source FROM raw WHERE source = 'tab_separated'"),
    "csv_positional_rename": _with(f"SELECT {_RAW_COLS}, source FROM raw WHERE source = 'comma_separated'"),
    "batch_append": _with("SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS rows FROM raw GROUP BY 1"),
    "clean_strings": _with("SELECT source, order_id, product_id, shipping_address_attention FROM raw"),
    "null_profile": _null_profile_sql(),
    "lineage_columns": _with(
        "SELECT source, count(*) AS rows, true AS suffix_ok, true AS ingested_at_set FROM raw GROUP BY source"
    ),
    "ssn_error_flag": _with(
        "SELECT sales_rep_id, source, count(*) AS rows, "
        "CAST(count(*) FILTER (WHERE sales_rep_ssn LIKE '%-%') AS BIGINT) AS flagged_rows FROM raw GROUP BY ALL"
    ),
    "ssn_to_long": _with(
        "SELECT DISTINCT sales_rep_id, sales_rep_ssn, CAST(replace(sales_rep_ssn, '-', '') AS BIGINT) AS ssn_long FROM raw"
    ),
    "ssn_to_long_vectorized": _with(
        "SELECT DISTINCT sales_rep_id, sales_rep_ssn, CAST(replace(sales_rep_ssn, '-', '') AS BIGINT) AS ssn_long FROM raw"
    ),
    "epoch_to_timestamp": _with(
        "SELECT DISTINCT order_id, CAST(epoch(o_orderdate) AS BIGINT) AS submitted_epoch, "
        "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS submitted_text FROM raw"
    ),
    "type_conform": _with(
        "SELECT order_id, product_id, CAST(product_quantity AS BIGINT) AS product_quantity, "
        "CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS product_sold_price, "
        "CAST(shipping_address_zip AS BIGINT) AS shipping_address_zip, CAST(sales_rep_zip AS BIGINT) AS sales_rep_zip FROM raw"
    ),
    "sales_reps_dedupe": _with("SELECT * FROM reps"),
    "orders_dedupe": _with(f"SELECT {_ORDER_COLS} FROM orders_batch"),
    "orders_by_month_partition": _with("SELECT submitted_yyyy_mm, count(*) AS orders FROM orders_final GROUP BY 1"),
    "month_pruned_scan": _with(
        "SELECT order_id, customer_id, submitted_yyyy_mm FROM orders_final "
        f"WHERE submitted_yyyy_mm BETWEEN '{MONTH_RANGE[0]}' AND '{MONTH_RANGE[1]}' AND shipping_address_state = '{MONTH_STATE}'"
    ),
    "line_items_typed": _with(f"SELECT {_ITEM_COLS} FROM items_batch"),
    "xml_products": _with("SELECT * FROM products_all"),
    "priced_products": _with("SELECT * FROM products"),
    "product_adj_range": _with(
        "SELECT 'color_adj' AS column_name, min(color_adj) AS min, max(color_adj) AS max FROM products "
        "UNION ALL SELECT 'size_adj', min(size_adj), max(size_adj) FROM products"
    ),
    "product_line_items": _with(
        "SELECT li.product_id, li.order_id, li.product_quantity, CAST(li.sold_dec AS DOUBLE) AS product_sold_price, "
        "p.color, p.model_name, p.model_number, "
        "CAST(CAST(p.base_price AS DECIMAL(10,2)) AS DOUBLE) AS base_price, "
        "CAST(CAST(p.color_adj AS DECIMAL(10,1)) AS DOUBLE) AS color_adj, "
        "CAST(CAST(p.size_adj AS DECIMAL(10,2)) AS DOUBLE) AS size_adj, "
        "CAST(CAST(p.price AS DECIMAL(10,2)) AS DOUBLE) AS price, p.size "
        "FROM items_final li JOIN products p ON li.product_id = p.product_id"
    ),
    "json_static_explode": _with(f"SELECT {_ITEM_COLS} FROM items_stream"),
    "stream_orders": _with(f"SELECT {_ORDER_COLS} FROM orders_stream"),
    "stream_line_items": _with(f"SELECT {_ITEM_COLS} FROM items_stream"),
    "stream_restart": _with("SELECT source, count(*) AS orders FROM orders_final GROUP BY source"),
    "stream_replay": _with(f"SELECT {_ORDER_COLS} FROM orders_stream"),
    "stream_reconcile": _with(
        "SELECT 'orders' AS table_name, b.n AS base_rows, s.n AS new_rows, b.n + s.n AS actual_rows, true AS ok "
        "FROM (SELECT count(*) AS n FROM orders_batch) b, (SELECT count(*) AS n FROM orders_stream) s "
        "UNION ALL SELECT 'line_items', b.n, s.n, b.n + s.n, true "
        "FROM (SELECT count(*) AS n FROM items_batch) b, (SELECT count(*) AS n FROM items_stream) s"
    ),
    "snapshot_history": _with(
        "SELECT 'OVERWRITE' AS op, CAST(count(*) AS BIGINT) AS rows FROM orders_batch "
        "UNION ALL SELECT 'APPEND', CAST(count(*) AS BIGINT) FROM orders_stream"
    ),
    "snapshot_as_of": _with("SELECT submitted_yyyy_mm, count(*) AS orders FROM orders_batch GROUP BY 1"),
    "snapshot_restore": _with("SELECT source, count(*) AS rows FROM items_batch GROUP BY source"),
    "schema_enforced_append": _with("SELECT product_id, CAST(2 AS BIGINT) AS copies, price FROM products"),
    "orders_by_state": _with('SELECT shipping_address_state, count(*) AS "count" FROM orders_final GROUP BY 1'),
    "price_stats": _with(
        "SELECT CAST(((2 * CAST(sum(li.sold_dec) * 100 AS HUGEINT) * 10000 + count(*)) // (2 * count(*))) AS DOUBLE) / 1000000 "
        "AS avg_price, CAST(min(li.sold_dec) AS DOUBLE) AS min_price, CAST(max(li.sold_dec) AS DOUBLE) AS max_price"
        + _FOUR_WAY
        + f"WHERE p.color = '{Q2_COLOR}' AND o.shipping_address_state = '{Q2_STATE}' AND r._error_ssn_format"
    ),
    "profit_by_rep": _with(_PROFIT),
    "top_rep_by_profit": _with(f"SELECT * FROM ({_PROFIT}) ORDER BY total_profit DESC, sales_rep_id LIMIT 1"),
    "join_using": _with(
        "SELECT r.sales_rep_id, o.shipping_address_state, count(*) AS lines, "
        "CAST(sum(li.product_quantity) AS BIGINT) AS quantity, CAST(sum(li.sold_dec) AS DOUBLE) AS sold"
        + _FOUR_WAY
        + "GROUP BY 1, 2"
    ),
    "dq_cleanliness": _cleanliness_sql(),
    "dq_lengths": _lengths_sql(),
    "dq_file_year": _with(
        "SELECT source, count(*) AS total, CAST(0 AS BIGINT) AS violations FROM raw GROUP BY source"
    ),
    "dq_ingest_today": _with(
        "SELECT source, count(*) AS total, CAST(0 AS BIGINT) AS violations FROM raw GROUP BY source"
    ),
    "dq_non_null": _non_null_sql(),
    "dq_flag_count": _with(
        "SELECT count(*) AS reps, CAST(count(*) FILTER (WHERE _error_ssn_format) AS BIGINT) AS flagged_reps, "
        "CAST(0 AS BIGINT) AS ssn_missing FROM reps"
    ),
    "dq_cast_failures": _cast_failures_sql(),
    "dq_schema": _with(
        "SELECT 'sales_reps' AS table_name, CAST(11 AS BIGINT) AS columns, CAST(0 AS BIGINT) AS differences, count(*) AS rows FROM reps "
        "UNION ALL SELECT 'orders', 12, 0, count(*) FROM orders_final UNION ALL SELECT 'line_items', 6, 0, count(*) FROM items_final "
        "UNION ALL SELECT 'products', 9, 0, count(*) FROM products"
    ),
    "dq_partitions": _with(
        "SELECT CAST(count(DISTINCT submitted_yyyy_mm) AS BIGINT) AS present_months, "
        f"CAST({EXPECTED_MONTHS} - count(DISTINCT submitted_yyyy_mm) AS BIGINT) AS missing_months FROM orders_final"
    ),
    "dq_result_diff": _with(
        "SELECT count(DISTINCT shipping_address_state) AS rows, CAST(0 AS BIGINT) AS differing_rows FROM orders_final"
    ),
    "dq_count_reconcile": f"WITH {BASE.strip()},\n{_EXPECTED_COUNTS.strip()}\n"
    "SELECT e.table_name, e.expected, a.actual, e.expected = a.actual AS ok FROM expected e JOIN ("
    "SELECT 'orders' AS table_name, CAST(count(*) AS BIGINT) AS actual FROM orders_final "
    "UNION ALL SELECT 'line_items', CAST(count(*) AS BIGINT) FROM items_final "
    "UNION ALL SELECT 'products', CAST(count(*) AS BIGINT) FROM products "
    "UNION ALL SELECT 'sales_reps', CAST(count(*) AS BIGINT) FROM reps) a ON a.table_name = e.table_name",
    "dq_xml_count": _with(
        "SELECT count(*) AS xml_rows, count(price) AS priced, CAST(count(*) FILTER (WHERE price IS NULL) AS BIGINT) "
        "AS unpriced FROM products_all"
    ),
    "dq_result_order": _with("SELECT CAST(0 AS BIGINT) AS out_of_order FROM (SELECT count(*) AS n FROM orders_final) WHERE n >= 0"),
    "stream_batch_rows": _with(
        "SELECT o.n AS order_rows, i.n AS line_item_rows, true AS has_batches, true AS no_empty_batch "
        "FROM (SELECT count(*) AS n FROM orders_stream) o, (SELECT count(*) AS n FROM items_stream) i"
    ),
    "file_inventory": _with(
        "SELECT source, n > 0 AS has_files, n > 0 AS has_bytes FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS source, count(*) AS n FROM {of}"
            for name, of in (
                ("fixed_width", "raw WHERE source = 'fixed_width'"),
                ("tab_separated", "raw WHERE source = 'tab_separated'"),
                ("comma_separated", "raw WHERE source = 'comma_separated'"),
                ("stream", "sdoc"),
                ("products_xml", "part"),
                ("checkpoint", "sdoc"),
                ("orders_data", "orders_final"),
                ("line_items_data", "items_final"),
                ("sales_reps_data", "reps"),
                ("products_data", "products"),
            )
        )
        + ")"
    ),
    "catalog_objects": _with(
        "SELECT 'products' AS name, 'MANAGED' AS table_type, false AS is_temporary, true AS in_show_tables, false AS is_cached, "
        "true AS month_described, count(*) AS rows FROM products "
        "UNION ALL SELECT 'orders_by_month', 'MANAGED', false, true, false, true, count(DISTINCT submitted_yyyy_mm) FROM orders_final "
        "UNION ALL SELECT 'reps_view', 'TEMPORARY', true, true, true, true, count(*) FROM reps"
    ),
    "dq_lengths_defects": _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE length({c}) NOT IN ({', '.join(map(str, ls))})"
            + {"sales_rep_zip": " OR o_orderkey % 11 = 0", "submitted_at": " OR o_orderkey % 13 = 0"}.get(c, "")
            + f") AS BIGINT) AS violations, CAST(count({c}) AS BIGINT) AS checked FROM raw"
            for c, ls in EXPECTED_LENGTHS.items()
        )
    ),
    "dq_file_year_defects": _with(
        "SELECT source, count(*) AS total, CAST(count(*) FILTER (WHERE o_orderkey % 13 = 0) AS BIGINT) AS violations FROM raw GROUP BY source"
    ),
    "dq_cast_failures_defects": _with(
        "SELECT 'product_quantity' AS column_name, 'int' AS target_type, CAST(count(*) FILTER (WHERE o_orderkey % 17 = 0) AS BIGINT) AS failures FROM raw "
        "UNION ALL SELECT 'sales_rep_zip', 'int', CAST(0 AS BIGINT)"
    ),
    "dq_non_null_defects": _with(
        "SELECT * FROM (SELECT 'order_id' AS column_name, CAST(0 AS BIGINT) AS nulls UNION ALL SELECT 'submitted_yyyy_mm', 0 "
        f"UNION ALL SELECT 'customer_id', CAST(count(*) FILTER (WHERE CAST(order_id AS BIGINT) % 19 = 0) AS BIGINT) FROM orders_final WHERE {_KEPT})"
    ),
    "dq_partitions_defects": _with(
        "SELECT CAST(count(DISTINCT submitted_yyyy_mm) AS BIGINT) AS present_months, "
        f"CAST({EXPECTED_MONTHS} - count(DISTINCT submitted_yyyy_mm) AS BIGINT) AS missing_months FROM orders_final WHERE {_KEPT}"
    ),
    "dq_schema_defects": _with(
        "SELECT 'sales_reps' AS table_name, CAST(2 AS BIGINT) AS differences, count(*) AS rows FROM reps "
        "UNION ALL SELECT 'orders', 1, count(*) FROM orders_final UNION ALL SELECT 'line_items', 1, count(*) FROM items_final "
        "UNION ALL SELECT 'products', 1, count(*) FROM products"
    ),
    "dq_result_diff_defects": _with(
        "SELECT CAST(2 * count(DISTINCT CASE WHEN shipping_address_state = 'AA' THEN 1 END) AS BIGINT) AS changed_rows, "
        "CAST(0 AS BIGINT) AS outside_tolerance, count(DISTINCT shipping_address_state) AS unequal_without_tolerance FROM orders_final"
    ),
    "dq_check_results_defects": _with(_DEFECT_ROWS + " SELECT * FROM defect_rows"),
    "dq_stage_rollup_defects": _with(
        _DEFECT_ROWS + " SELECT suite, CAST(count(*) FILTER (WHERE status = 'passed') AS BIGINT) AS passed, count(*) AS checks, "
        "round(count(*) FILTER (WHERE status = 'passed') * 100.0 / count(*), 1) AS percent, bool_and(status = 'passed') AS all_passed "
        "FROM defect_rows GROUP BY suite"
    ),
    "dq_final_gate_defects": _with(
        _DEFECT_ROWS + " SELECT CAST(6 AS BIGINT) AS stages, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS stages_passed, false AS passed "
        "FROM (SELECT suite, bool_and(status = 'passed') AS ok FROM defect_rows GROUP BY suite)"
    ),
    "dq_check_results": _with(
        "SELECT suite, check_id, CASE WHEN violations = 0 THEN 'passed' ELSE 'failed' END AS status, violations, total FROM ("
        + _CHECK_ROWS
        + ")"
    ),
    "dq_stage_rollup": _with(
        "SELECT suite, count(*) AS passed, count(*) AS checks, CAST(100.0 AS DOUBLE) AS percent, true AS all_passed FROM (" + _CHECK_ROWS + ") GROUP BY suite"
    ),
    "dq_final_gate": _with(
        "SELECT CAST(6 AS BIGINT) AS stages, CAST(count(DISTINCT suite) AS BIGINT) AS stages_passed, bool_and(violations = 0) AS passed FROM (" + _CHECK_ROWS + ")"
    ),
}


# -- rejected records, timed stream, managed orders, SQL text ------------------------------------
# Fixed values, restated: keys of broken records, files and throttle of the
# timed run, the dropped and the rewritten month, defects.
BROKEN, FILES, THROTTLE = 29, 7, 2
LATE, UNDATED, TURNED = 31, 37, 5
_REJECTS = f"""
SELECT 'fixed_width' AS source, 'short line ' || o_orderkey AS text FROM orders WHERE o_orderkey % {BROKEN} = 0
UNION ALL SELECT 'tab_separated', 'broken ' || o_orderkey || repeat(chr(9), 18) || 'a' || chr(9) || 'b' FROM orders WHERE o_orderkey % {BROKEN} = 0
UNION ALL SELECT 'comma_separated', 'broken ' || o_orderkey || repeat(',', 18) || 'a,b' FROM orders WHERE o_orderkey % {BROKEN} = 0
UNION ALL SELECT 'stream', '{{"orderId": "' || o_orderkey || '", "products": [{{' FROM orders WHERE o_orderkey % {BROKEN} = 0
"""
_TIMED = f"""
SELECT 'orders' AS table_name, count(*) AS rows, CAST(0 AS BIGINT) AS differing_rows, CAST({-(-FILES // THROTTLE)} AS BIGINT) AS batches FROM orders_stream
UNION ALL SELECT 'line_items', count(*), CAST(0 AS BIGINT), CAST({-(-FILES // THROTTLE)} AS BIGINT) FROM items_stream
"""
ORACLE_SQL.update(
    {
        "rejected_records": f"SELECT source, text FROM ({_REJECTS})",
        "rejected_counts": _with(
            "SELECT source, CAST(accepted + rejected AS BIGINT) AS lines, accepted, rejected FROM "
            "(SELECT source, count(*) AS accepted FROM (SELECT source FROM raw UNION ALL SELECT source FROM orders_stream) GROUP BY source) "
            f"JOIN (SELECT source, count(*) AS rejected FROM ({_REJECTS}) GROUP BY source) USING (source)"
        ),
        "stream_throttled": _with(_TIMED),
        "stream_progress": _with(
            f"SELECT 'timed_orders' AS query_name, CAST({-(-FILES // THROTTLE)} AS BIGINT) AS triggers, count(*) AS input_rows, "
            "CAST(0 AS BIGINT) AS over_throttle, true AS in_bounds, CAST(1 AS BIGINT) AS started, CAST(1 AS BIGINT) AS ended FROM orders_stream"
        ),
        "orders_managed_by_month": _with(
            "SELECT submitted_yyyy_mm, count(*) AS orders, count(DISTINCT order_id) AS order_ids, true AS in_catalog FROM orders_final GROUP BY 1"
        ),
        "dq_months_in_catalog": _with(
            f"SELECT state, present - gone AS present_months, CAST({EXPECTED_MONTHS} - present + gone AS BIGINT) AS missing_months FROM "
            "(SELECT count(DISTINCT submitted_yyyy_mm) AS present, count(DISTINCT CASE WHEN submitted_yyyy_mm = '1997-05' THEN 1 END) AS dropped FROM orders_final), "
            "(VALUES ('whole', 0), ('one dropped', 1)) AS v(state, n), LATERAL (SELECT CAST(n * dropped AS BIGINT) AS gone)"
        ),
        "insert_by_name": _with(
            "SELECT submitted_yyyy_mm, count(*) AS orders, count(*) FILTER (WHERE customer_id IS NULL) AS no_customer, "
            "min(shipping_address_state) AS least_state, true AS bad_type_refused FROM orders_final GROUP BY 1"
        ),
        "price_stats_sql": ORACLE_SQL["price_stats"],
        "top_rep_by_profit_sql": ORACLE_SQL["top_rep_by_profit"],
        "dq_ingest_today_defects": _with(
            f"SELECT source, count(*) AS total, count(*) FILTER (WHERE o_orderkey % {LATE} = 0 OR o_orderkey % {UNDATED} = 0) AS violations FROM raw GROUP BY source"
        ),
        "product_adj_check": _with(
            "SELECT *, min = expected_min AND max = expected_max AS ok FROM ("
            "SELECT 'color_adj' AS column_name, min(color_adj) AS min, max(color_adj) AS max, 1.0::DOUBLE AS expected_min, 1.1::DOUBLE AS expected_max FROM products "
            "UNION ALL SELECT 'size_adj', min(size_adj), max(size_adj), 0.9::DOUBLE, 1.0::DOUBLE FROM products)"
        ),
        "product_adj_check_defects": _with(
            "SELECT *, min = expected_min AND max = expected_max AS ok FROM ("
            "SELECT 'color_adj' AS column_name, min(color_adj) AS min, max(CASE WHEN color_adj = 1.1 THEN 1.09 ELSE color_adj END)::DOUBLE AS max, "
            "1.0::DOUBLE AS expected_min, 1.1::DOUBLE AS expected_max FROM products "
            "UNION ALL SELECT 'size_adj', min(CASE WHEN size_adj = 0.9 THEN 0.85 ELSE size_adj END)::DOUBLE, max(size_adj), 0.9::DOUBLE, 1.0::DOUBLE FROM products)"
        ),
        "dq_flag_check": _with("SELECT count(DISTINCT sales_rep_id) AS reps, CAST(0 AS BIGINT) AS wrong_flags FROM raw"),
        "dq_flag_check_defects": _with(
            f"SELECT count(DISTINCT sales_rep_id) AS reps, count(DISTINCT sales_rep_id) FILTER (WHERE s_suppkey % {TURNED} = 0) AS wrong_flags FROM raw"
        ),
        "dq_result_positions": _with(
            'SELECT row_number() OVER (ORDER BY "count" DESC, shipping_address_state) - 1 AS position, shipping_address_state, "count" FROM '
            '(SELECT shipping_address_state, count(*) AS "count" FROM orders_final GROUP BY 1)'
        ),
        "dq_result_positions_defects": _with(
            "SELECT 'swapped' AS defect, CAST(p AS BIGINT) AS position FROM (SELECT count(DISTINCT shipping_address_state) AS n FROM orders_final), (VALUES (1), (2)) AS v(p) WHERE n > 2 "
            "UNION ALL SELECT 'first', CAST(0 AS BIGINT) UNION ALL SELECT 'last', count(DISTINCT shipping_address_state) - 1 FROM orders_final"
        ),
    }
)
