"""The registered queries in DuckDB SQL, written from the rules and not from the Spark code."""

from __future__ import annotations

FLOOR, FIRST_RUN, SECOND_RUN = "DATE '1994-12-31'", "DATE '1998-01-01'", "DATE '2002-01-01'"

RAW_ORDERS = """raw_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(o_orderdate AS DATE) AS order_purchase_date,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + 1 END AS order_approved_at,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + 3 END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 7 END AS order_delivered_customer_date,
    CAST(o_orderdate AS DATE) + 14 AS order_estimated_delivery_date,
    o_orderstatus AS order_status
  FROM orders)"""

RAW_ITEMS = """raw_order_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS DECIMAL(10,2)) AS freight_value,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS shipping_limit_date
  FROM lineitem)"""

RAW_CUSTOMERS = """raw_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, o_orderpriority AS customer_address, n_name AS customer_state,
    c_mktsegment AS customer_zip_code,
    CAST(o_orderdate AS DATE) - CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 30 END AS customer_created_date,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS customer_updated_date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

RAW_SELLERS = """raw_sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, l_returnflag AS seller_address, n_name AS seller_state,
    l_linestatus AS seller_zip_code,
    CAST(l_shipdate AS DATE) - CASE WHEN l_returnflag = 'R' THEN 0 ELSE 30 END AS seller_created_date,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS seller_updated_date
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

RAW_PRODUCTS = """raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS product_category,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS product_price, CAST(p_size AS VARCHAR) AS product_size_label,
    CAST(p_size AS FLOAT) AS product_length_cm, CAST(p_size AS FLOAT) AS product_height_cm,
    CAST(p_size AS FLOAT) AS product_width_cm,
    CAST(l_shipdate AS DATE) - CASE WHEN l_returnflag = 'R' THEN 0 ELSE 30 END AS product_created_date,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS product_updated_date
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

STG_ORDERS = """stg_orders AS (
  SELECT order_id, customer_id, order_purchase_date AS order_date, order_approved_at AS order_approved_date,
    order_delivered_carrier_date AS delivered_to_carrier_date,
    order_delivered_customer_date AS delivered_to_customer_date,
    order_estimated_delivery_date AS estimated_delivery_date, order_status
  FROM raw_orders
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_purchase_date NULLS FIRST, customer_id NULLS FIRST,
    order_approved_at NULLS FIRST, order_delivered_carrier_date NULLS FIRST,
    order_delivered_customer_date NULLS FIRST, order_estimated_delivery_date NULLS FIRST,
    order_status NULLS FIRST) = 1)"""

STG_ITEMS = """stg_order_items AS (
  SELECT i.order_id, order_item_id, product_id, seller_id, price AS item_value, freight_value, shipping_limit_date,
    order_purchase_date AS order_date
  FROM raw_order_items i JOIN raw_orders o ON i.order_id = o.order_id
  QUALIFY row_number() OVER (PARTITION BY i.order_id, order_item_id ORDER BY order_purchase_date NULLS FIRST,
    product_id NULLS FIRST, seller_id NULLS FIRST, price NULLS FIRST, freight_value NULLS FIRST,
    shipping_limit_date NULLS FIRST) = 1)"""

ORDER_TOTALS = """order_totals AS (
  SELECT order_id, CAST(sum(item_value) AS DECIMAL(20,2)) AS total_order_value,
    CAST(sum(freight_value) AS DECIMAL(20,2)) AS total_freight_value,
    min(shipping_limit_date) AS min_shipping_limit_date, max(shipping_limit_date) AS max_shipping_limit_date,
    count(order_item_id) AS item_count
  FROM stg_order_items GROUP BY order_id)"""

DAYS = """bounds AS (
  SELECT make_date(CAST(year(min(day)) AS INTEGER), 1, 1) AS first_day,
    make_date(CAST(year(max(day)) AS INTEGER), 12, 31) AS last_day
  FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)),
spine AS (
  SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds)"""

CALENDAR_COLUMNS = """CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month,
    CAST(day({d}) AS INTEGER) AS day, CAST(dayofweek({d}) + 1 AS INTEGER) AS day_of_week,
    CAST(weekofyear({d}) AS INTEGER) AS week_of_year, CAST(quarter({d}) AS INTEGER) AS quarter,
    CAST(dayofyear({d}) AS INTEGER) AS day_of_year, last_day({d}) = {d} AS is_month_end,
    day({d}) = 1 AS is_month_start, coalesce(dayofweek({d}) IN (0, 6), false) AS is_weekend"""

DIM_DATE = (
    DAYS
    + """,
dim_date AS (
  SELECT 0 AS date_key, CAST(NULL AS DATE) AS date, CAST(NULL AS INTEGER) AS year, CAST(NULL AS INTEGER) AS month,
    CAST(NULL AS INTEGER) AS day, CAST(NULL AS INTEGER) AS day_of_week, CAST(NULL AS INTEGER) AS week_of_year,
    CAST(NULL AS INTEGER) AS quarter, CAST(NULL AS INTEGER) AS day_of_year, CAST(NULL AS BOOLEAN) AS is_month_end,
    CAST(NULL AS BOOLEAN) AS is_month_start, CAST(NULL AS BOOLEAN) AS is_weekend
  UNION ALL
  SELECT CAST(rank() OVER (ORDER BY date) AS INTEGER), date, """
    + CALENDAR_COLUMNS.format(d="date")
    + " FROM spine)"
)

# Per dimension: raw CTE, key, raw columns with their mart names, tracked columns.
DIMENSIONS = {
    "customer": (
        RAW_CUSTOMERS,
        "customer_id",
        {"customer_address": "address", "customer_state": "state", "customer_zip_code": "zip_code_prefix"},
        ("address", "state", "zip_code_prefix"),
    ),
    "seller": (
        RAW_SELLERS,
        "seller_id",
        {"seller_address": "address", "seller_state": "state", "seller_zip_code": "zip_code_prefix"},
        ("address", "state", "zip_code_prefix"),
    ),
    "product": (
        RAW_PRODUCTS,
        "product_id",
        {
            "product_name": "product_name",
            "product_category": "category_name",
            "product_price": "price",
            "product_size_label": "size_label",
            "product_length_cm": "length_cm",
            "product_height_cm": "height_cm",
            "product_width_cm": "width_cm",
        },
        ("price", "category_name"),
    ),
}


def _staged(name: str, alias: str, condition: str) -> str:
    """Earliest raw row per key among those whose effective update date meets the condition."""
    _, key, columns, tracked = DIMENSIONS[name]
    renamed = ", ".join(f"{raw} AS {mart}" for raw, mart in columns.items() if raw != mart)
    same = "".join(f", {raw}" for raw, mart in columns.items() if raw == mart)
    rest = [c for c in columns.values() if c not in tracked] + ["created_date"]
    order = ", ".join(f"{c} NULLS FIRST" for c in ("updated_date", *tracked, *rest))
    return f"""{alias} AS (
  SELECT {key}, {', '.join(columns.values())}, created_date, updated_date
  FROM (SELECT {key}, {renamed}{same}, {name}_created_date AS created_date,
      coalesce({name}_updated_date, {name}_created_date) AS updated_date FROM raw_{name}s)
  WHERE {condition}
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"""


def _history(name: str) -> str:
    """CTEs from the raw feed to the dimension after both batches."""
    raw, key, columns, tracked = DIMENSIONS[name]
    attributes = ", ".join(columns.values())
    changed = "(" + " OR ".join(f"d.{c} <> s.{c}" for c in tracked) + ")"
    new = f"""SELECT sha256(s.{key} || '||' || CAST(s.updated_date AS VARCHAR)) AS {name}_sk, s.{key},
    {', '.join(f's.{c}' for c in columns.values())}, s.updated_date AS effective_from,
    CAST(NULL AS DATE) AS effective_to, true AS is_current"""
    return f"""{raw},
{_staged(name, f'{name}_stg1', f'updated_date > {FLOOR} AND updated_date < {FIRST_RUN}')},
{name}_dim1 AS ({new} FROM {name}_stg1 s),
{name}_watermark AS (SELECT coalesce(max(effective_to), {FLOOR}) AS max_date FROM {name}_dim1),
{_staged(name, f'{name}_stg2', f'updated_date >= {FIRST_RUN} AND updated_date > (SELECT max_date FROM {name}_watermark)')},
{name}_new AS ({new}
  FROM {name}_stg2 s FULL JOIN {name}_dim1 d ON s.{key} = d.{key} AND d.is_current
  WHERE (d.{key} IS NULL OR {changed}) AND s.{key} IS NOT NULL),
{name}_expired AS (
  SELECT d.{name}_sk, d.{key}, {', '.join(f'd.{c}' for c in columns.values())}, d.effective_from,
    {SECOND_RUN} - 1 AS effective_to, false AS is_current
  FROM {name}_stg2 s JOIN {name}_dim1 d ON s.{key} = d.{key} AND d.is_current WHERE {changed}),
{name}_delta AS (SELECT * FROM {name}_new UNION ALL SELECT * FROM {name}_expired),
dim_{name} AS (
  SELECT t.{name}_sk, t.{key}, {', '.join(f't.{c}' for c in columns.values())}, t.effective_from,
    CASE WHEN c.{name}_sk IS NOT NULL AND t.is_current THEN c.effective_to ELSE t.effective_to END AS effective_to,
    CASE WHEN c.{name}_sk IS NOT NULL AND t.is_current THEN c.is_current ELSE t.is_current END AS is_current
  FROM {name}_dim1 t LEFT JOIN {name}_delta c ON t.{name}_sk = c.{name}_sk
  UNION ALL
  SELECT {name}_sk, {key}, {attributes}, effective_from, effective_to, is_current FROM {name}_delta
  WHERE {name}_sk NOT IN (SELECT {name}_sk FROM {name}_dim1))"""


def _as_of(events: str, name: str) -> str:
    key = DIMENSIONS[name][1]
    return (
        f"LEFT JOIN dim_{name} {name[0]} ON {events}.{key} = {name[0]}.{key} "
        f"AND {events}.order_date >= {name[0]}.effective_from "
        f"AND ({events}.order_date < {name[0]}.effective_to OR {name[0]}.is_current)"
    )



def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


RAW = (RAW_ORDERS, RAW_ITEMS)
STAGED = (*RAW, STG_ORDERS, STG_ITEMS)

ORDER_ROLES = {
    "order_date_key": "order_date",
    "order_approved_date_key": "order_approved_date",
    "delivered_to_carrier_date_key": "delivered_to_carrier_date",
    "delivered_to_customer_date_key": "delivered_to_customer_date",
    "estimated_delivery_date_key": "estimated_delivery_date",
}

# DuckDB plans the OR of the date condition as a nested loop; IS NOT DISTINCT FROM is the same rule as a hash join.
def _hash_date_join(alias: str, column: str) -> str:
    return f"LEFT JOIN dim_date {alias} ON {column} IS NOT DISTINCT FROM {alias}.date"


FACT_ITEMS = _with(
    *STAGED,
    DIM_DATE,
    _history("seller"),
    _history("product"),
    select=f"""SELECT s.seller_sk, p.product_sk, i.order_id, i.order_item_id, i.item_value, i.freight_value,
  od.date_key AS order_date_key, sd.date_key AS shipping_limit_date_key
FROM stg_order_items i
{_hash_date_join('od', 'i.order_date')}
{_hash_date_join('sd', 'i.shipping_limit_date')}
{_as_of('i', 'seller')}
{_as_of('i', 'product')}""",
)

FACT_SUMMARY = _with(
    *STAGED,
    ORDER_TOTALS,
    DIM_DATE,
    _history("customer"),
    select=f"""SELECT c.customer_sk, o.order_id, o.order_status,
  t.total_order_value, t.total_freight_value, t.item_count,
  d1.date_key AS order_date_key, d3.date_key AS delivered_to_carrier_date_key,
  d4.date_key AS delivered_to_customer_date_key, d5.date_key AS estimated_delivery_date_key,
  d2.date_key AS order_approved_date_key, d6.date_key AS min_shipping_limit_date_key,
  d7.date_key AS max_shipping_limit_date_key
FROM stg_orders o LEFT JOIN order_totals t ON o.order_id = t.order_id
{_hash_date_join('d1', 'o.order_date')}
{_hash_date_join('d2', 'o.order_approved_date')}
{_hash_date_join('d3', 'o.delivered_to_carrier_date')}
{_hash_date_join('d4', 'o.delivered_to_customer_date')}
{_hash_date_join('d5', 'o.estimated_delivery_date')}
{_hash_date_join('d6', 't.min_shipping_limit_date')}
{_hash_date_join('d7', 't.max_shipping_limit_date')}
{_as_of('o', 'customer')}""",
)

EARLY = f"coalesce(order_purchase_date < {FIRST_RUN}, false)"


def _two_runs(fact: str, *dimensions: str, dated: bool = False) -> str:
    """A fact after two daily runs: each over its own orders, with the dimensions as they are after it."""
    first, second = fact, fact
    for name in dimensions:
        first = first.replace(f"LEFT JOIN dim_{name} ", f"LEFT JOIN {name}_dim1 ")
    first, second = (
        sql.replace("FROM raw_orders", f"FROM (SELECT * FROM raw_orders WHERE {batch})").replace(
            "JOIN raw_orders o ON", f"JOIN (SELECT * FROM raw_orders WHERE {batch}) o ON"
        )
        for sql, batch in ((first, EARLY), (second, f"NOT {EARLY}"))
    )
    days = (f", {FIRST_RUN} AS run_date", f", {SECOND_RUN} AS run_date") if dated else ("", "")
    return f"SELECT *{days[0]} FROM ({first}) UNION ALL SELECT *{days[1]} FROM ({second})"


# Columns that must have a value, in the order of the tables.
REQUIRED_ITEMS = (
    "seller_sk", "product_sk", "order_id", "order_item_id", "item_value", "freight_value",
    "order_date_key", "shipping_limit_date_key",
)
REQUIRED_SUMMARY = (
    "customer_sk", "order_id", "order_status", "total_order_value", "total_freight_value", "item_count",
    "order_date_key", "delivered_to_carrier_date_key", "delivered_to_customer_date_key", "estimated_delivery_date_key",
    "order_approved_date_key", "min_shipping_limit_date_key", "max_shipping_limit_date_key",
)


def _broken(sql: str, required: tuple[str, ...]) -> str:
    """The rows without a value where one must be, with the names of those columns."""
    names = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in required)
    return f"SELECT * FROM (SELECT *, concat_ws(',', {names}) AS broken FROM ({sql})) WHERE broken <> ''"


def _wide(sql: str, *amounts: str) -> str:
    """Amounts as the relaxed tables hold them."""
    wider = ", ".join(f"CAST({c} AS DECIMAL(20,2)) AS {c}" for c in amounts)
    return f"SELECT * REPLACE ({wider}) FROM ({sql})" if amounts else sql


def _complete(sql: str, zero: tuple[str, ...], narrow: dict[str, str], *surrogates: str) -> str:
    """A fact with unknown members and zeros instead of NULLs, in the types of the strict contracts."""
    columns = [f"coalesce({c}, 'unknown') AS {c}" for c in surrogates]
    columns += [f"coalesce({c}, 0) AS {c}" for c in zero]
    columns += [f"CAST(coalesce({c}, 0) AS {kind}) AS {c}" for c, kind in narrow.items()]
    return f"SELECT * REPLACE ({', '.join(columns)}) FROM ({sql})"


def _complete_dimension(name: str) -> str:
    """The dimension after both batches with its reserved version."""
    _, key, columns, _tracked = DIMENSIONS[name]
    blank = {c: "CAST(0 AS FLOAT)" for c in ("length_cm", "height_cm", "width_cm")} | {"price": "CAST(0 AS DECIMAL(10,2))"}
    unknown = ", ".join(blank.get(c, "'unknown'") for c in columns.values())
    return _with(
        _history(name),
        select=f"""SELECT * FROM dim_{name}
UNION ALL SELECT 'unknown', 'unknown', {unknown}, {FLOOR}, CAST(NULL AS DATE), true""",
    )


ROLE_KEYS = ", ".join(f"{key}_dim.date_key AS {key}" for key in ORDER_ROLES)
ROLE_JOINS = "\n".join(_hash_date_join(f"{key}_dim", f"o.{column}") for key, column in ORDER_ROLES.items())


def _first(sql: str, order_by: str, n: int) -> str:
    return f"SELECT * FROM ({sql}) ORDER BY {order_by} LIMIT {n}"


def _whole_feed(name: str) -> str:
    return f"{DIMENSIONS[name][0]},\n{_staged(name, f'stg_{name}', f'updated_date > {FLOOR}')}"


def _whole_dim(name: str) -> str:
    """The dimension after a single run over the whole feed: one current version per key."""
    key = DIMENSIONS[name][1]
    return f"""{_whole_feed(name)},
dim_{name} AS (SELECT {key}, sha256({key} || '||' || CAST(updated_date AS VARCHAR)) AS {name}_sk,
  updated_date AS effective_from, CAST(NULL AS DATE) AS effective_to, true AS is_current FROM stg_{name})"""


PIT_ITEMS = """SELECT i.order_id, i.order_item_id, i.{name}_id, i.order_date, {a}.{name}_sk
FROM stg_order_items i {join}"""


def all_oracles() -> dict[str, str]:
    raw_orders = _with(RAW_ORDERS, select="SELECT * FROM raw_orders")
    daily_items = _wide(_two_runs(FACT_ITEMS, "seller", "product"), "item_value", "freight_value")
    daily_summary = _two_runs(FACT_SUMMARY, "customer")
    sql = {
        "scan_parquet": "SELECT * FROM customer",
        "roundtrip_parquet": raw_orders,
        "table_overwrite": _with(RAW_ORDERS, STG_ORDERS, select="SELECT * FROM stg_orders"),
        "table_append": raw_orders,
        "table_scan": _with(RAW_ITEMS, select="SELECT order_id, order_item_id, price FROM raw_order_items"),
        "contract_check": _with(
            _whole_feed("product"),
            select="""SELECT sha256(product_id || '||' || CAST(updated_date AS VARCHAR)) AS product_sk, product_id,
  product_name, category_name, price, size_label, length_cm, height_cm, width_cm, updated_date AS effective_from,
  CAST(NULL AS DATE) AS effective_to, true AS is_current FROM stg_product""",
        ),
        "project_rename": _with(
            RAW_ORDERS,
            select="""SELECT order_id, customer_id, order_purchase_date AS order_date,
  order_approved_at AS order_approved_date, order_delivered_carrier_date AS delivered_to_carrier_date,
  order_delivered_customer_date AS delivered_to_customer_date,
  order_estimated_delivery_date AS estimated_delivery_date, order_status FROM raw_orders""",
        ),
        "derive_updated_date": _with(
            RAW_CUSTOMERS,
            select="""SELECT customer_id, customer_created_date,
  CAST(customer_updated_date AS VARCHAR) AS customer_updated_date,
  coalesce(customer_updated_date, customer_created_date) AS updated_date FROM raw_customers""",
        ),
        "incremental_filter": _with(
            RAW_CUSTOMERS,
            select=f"""SELECT customer_id, customer_address, customer_created_date, customer_updated_date
FROM raw_customers WHERE coalesce(customer_updated_date, customer_created_date) > {FIRST_RUN} - 1""",
        ),
        "filter_eq": raw_orders + " WHERE order_status = 'F'",
        "filter_in": raw_orders + " WHERE order_status IN ('O', 'P')",
        "scd2_changed_null_blind": _with(
            _history("customer"),
            select="""SELECT s.customer_id, nullif(d.address, '1-URGENT') <> nullif(s.address, '5-LOW')
  OR d.state <> s.state OR d.zip_code_prefix <> s.zip_code_prefix AS changed
FROM customer_stg2 s JOIN customer_dim1 d ON s.customer_id = d.customer_id""",
        ),
        "surrogate_key": _with(
            RAW_ORDERS,
            select="""SELECT order_id,
  sha256(customer_id || '||' || CAST(order_purchase_date AS VARCHAR)) AS customer_sk FROM raw_orders""",
        ),
        "scalar_calendar": _with(
            RAW_ORDERS,
            select="SELECT order_id, order_purchase_date, "
            + CALENDAR_COLUMNS.format(d="order_purchase_date")
            + " FROM raw_orders",
        ),
        "stg_orders": _with(RAW_ORDERS, STG_ORDERS, select="SELECT * FROM stg_orders"),
        "stg_order_items": _with(*RAW, STG_ITEMS, select="SELECT * FROM stg_order_items"),
        "join_inner_items_orders": _with(
            *RAW,
            select="""SELECT i.*, o.order_purchase_date FROM raw_order_items i
JOIN raw_orders o ON i.order_id = o.order_id""",
        ),
        "agg_order_items": _with(*RAW, STG_ITEMS, ORDER_TOTALS, select="SELECT * FROM order_totals"),
        "join_left_order_agg": _with(
            *STAGED,
            ORDER_TOTALS,
            select="""SELECT o.order_id, o.order_date, o.order_status, t.total_order_value, t.total_freight_value,
  t.min_shipping_limit_date, t.max_shipping_limit_date, t.item_count
FROM stg_orders o LEFT JOIN order_totals t ON o.order_id = t.order_id""",
        ),
        "join_fullouter_scd": _with(
            _history("customer"),
            select="""SELECT s.customer_id AS staged_id, d.customer_id AS dim_id, s.address AS staged_address,
  d.address AS dim_address, s.updated_date, d.effective_from
FROM customer_stg2 s FULL JOIN customer_dim1 d ON s.customer_id = d.customer_id AND d.is_current""",
        ),
        "date_spine": _with(DAYS, select="SELECT date FROM spine"),
        "dim_date": _with(DIM_DATE, select="SELECT * FROM dim_date"),
        "join_null_safe_date": _with(
            RAW_ORDERS,
            STG_ORDERS,
            DIM_DATE,
            select=f"""SELECT o.order_id, o.delivered_to_customer_date, d.date_key
FROM stg_orders o {_hash_date_join('d', 'o.delivered_to_customer_date')}""",
        ),
        "join_role_playing_dates": _with(
            RAW_ORDERS, STG_ORDERS, DIM_DATE, select=f"SELECT o.order_id, {ROLE_KEYS} FROM stg_orders o\n{ROLE_JOINS}"
        ),
        "date_key_arith": _with(
            RAW_ORDERS, STG_ORDERS, DIM_DATE, select=f"SELECT o.order_id, {ROLE_KEYS} FROM stg_orders o\n{ROLE_JOINS}"
        ),
        "pit_join_customer": _with(
            RAW_ORDERS,
            STG_ORDERS,
            _history("customer"),
            select=f"""SELECT o.order_id, o.customer_id, o.order_date, c.customer_sk
FROM stg_orders o {_as_of('o', 'customer')}""",
        ),
        "high_watermark": _with(
            _history("customer"),
            select=f"SELECT coalesce(max(effective_to), {FLOOR}) AS max_date FROM dim_customer",
        ),
        "stored_watermark": _with(
            _history("customer"),
            select=f"SELECT coalesce(max(effective_to), {FLOOR}) AS max_date FROM dim_customer",
        ),
        "contiguous_fact_order_summary": FACT_SUMMARY.replace(
            "LEFT JOIN dim_customer ",
            """LEFT JOIN (SELECT customer_sk, customer_id, effective_from,
  lead(effective_from) OVER w AS effective_to, lead(effective_from) OVER w IS NULL AS is_current
  FROM dim_customer WINDOW w AS (PARTITION BY customer_id ORDER BY effective_from, is_current, customer_sk)) """,
        ),
        "fact_order_items": FACT_ITEMS,
        "fact_order_summary": FACT_SUMMARY,
        "lookup_order": raw_orders + " WHERE order_id = '7'",
        "lookup_orders": raw_orders + " WHERE order_id IN ('7', '1', '32', '007', 'no key')",
        "topk_dim_date": _with(DIM_DATE, select="SELECT * FROM dim_date ORDER BY date_key LIMIT 5"),
        "topk_fact_items": _first(
            daily_items, "order_id, order_item_id, seller_sk NULLS FIRST, product_sk NULLS FIRST", 5
        ),
        "topk_fact_summary": _first(daily_summary, "order_id, customer_sk NULLS FIRST", 10),
        "daily_dim_date": _with(DIM_DATE, select="SELECT * FROM dim_date"),
        "daily_fact_order_items": daily_items,
        "daily_fact_order_summary": daily_summary,
        "rerun_fact_order_items": daily_items,
        "rerun_fact_order_summary": daily_summary,
        "quarantined_order_items": _broken(
            _wide(_two_runs(FACT_ITEMS, "seller", "product", dated=True), "item_value", "freight_value"), REQUIRED_ITEMS
        ),
        "quarantined_order_summary": _broken(_two_runs(FACT_SUMMARY, "customer", dated=True), REQUIRED_SUMMARY),
        "accepted_order_items": f"SELECT * FROM ({_two_runs(FACT_ITEMS, 'seller', 'product')}) WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_ITEMS),
        "complete_fact_order_items": _complete(
            _two_runs(FACT_ITEMS, "seller", "product"),
            ("order_date_key", "shipping_limit_date_key"),
            {},
            "seller_sk",
            "product_sk",
        ),
        "complete_fact_order_summary": _complete(
            daily_summary,
            (*ORDER_ROLES, "min_shipping_limit_date_key", "max_shipping_limit_date_key"),
            {"total_order_value": "DECIMAL(10,2)", "total_freight_value": "DECIMAL(10,2)", "item_count": "INTEGER"},
            "customer_sk",
        ),
        "daily_run_counts": _with(
            *STAGED,
            DIM_DATE,
            *(_whole_dim(name) for name in DIMENSIONS),
            select="\nUNION ALL\n".join(
                [
                    *(
                        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                        for t in ("dim_customer", "dim_date", "dim_product", "dim_seller")
                    ),
                    f"""SELECT 'fact_order_items', count(*) FROM stg_order_items i {_as_of('i', 'seller')}
{_as_of('i', 'product')}""",
                    f"SELECT 'fact_order_summary', count(*) FROM stg_orders o {_as_of('o', 'customer')}",
                ]
            ),
        ),
    }
    for name in ("seller", "product"):
        sql[f"pit_join_{name}"] = _with(
            *RAW, STG_ITEMS, _history(name), select=PIT_ITEMS.format(name=name, a=name[0], join=_as_of("i", name))
        )
    for name, (_, key, columns, _tracked) in DIMENSIONS.items():
        history = _history(name)
        sql[f"stg_{name}"] = _with(_whole_feed(name), select=f"SELECT * FROM stg_{name}")
        sql[f"scd2_new_{name}"] = _with(history, select=f"SELECT * FROM {name}_new")
        sql[f"scd2_expired_{name}"] = _with(history, select=f"SELECT * FROM {name}_expired")
        sql[f"scd2_delta_{name}"] = _with(history, select=f"SELECT * FROM {name}_delta")
        sql[f"merge_dim_{name}"] = _with(history, select=f"SELECT * FROM dim_{name}")
        sql[f"dim_{name}_after_2_batches"] = sql[f"merge_dim_{name}"]
        amounts = [c for c in columns.values() if c == "price"]
        sql[f"daily_dim_{name}"] = _wide(sql[f"merge_dim_{name}"], *amounts)
        sql[f"pit_join_{name}_bucketed"] = sql[f"pit_join_{name}"]
        sql[f"complete_dim_{name}"] = _complete_dimension(name)
        sql[f"topk_dim_{name}"] = _first(sql[f"daily_dim_{name}"], f"{key}, effective_from", 5)
    return sql
