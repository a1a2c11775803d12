"""Independent SQL for every query, for any engine that holds the test tables.

Window functions over whole tables are fine here: this text only ever checks
small data.
"""

from __future__ import annotations

from starmart.plans.wide import TABLES, WIDE_SQL

# Attribute columns of the wide records, per dimension.
CUSTOMER = ["customer_first_name", "customer_last_name", "customer_country"]
SELLER = ["seller_first_name", "seller_last_name", "seller_country"]
PRODUCT = [
    "product_name",
    "product_category",
    "product_price",
    "product_brand",
    "product_rating",
    "product_reviews",
]
STORE_KEY = ["store_name", "store_location", "store_city", "store_country"]
SUPPLIER = ["supplier_name", "supplier_city", "supplier_country"]
FACT = [
    "source_sale_id",
    "date_key",
    "customer_key",
    "seller_key",
    "product_key",
    "store_key",
    "supplier_key",
    "sale_quantity",
    "sale_total_price",
]


def _listed(columns, prefix="", suffix=""):
    return ", ".join(f"{prefix}{c}{suffix}" for c in columns)


def _first_per_key(source, key, attributes):
    return f"""
    SELECT {source} AS {key}, {source}, {_listed(attributes)} FROM (
      SELECT *, ROW_NUMBER() OVER (
        PARTITION BY {source} ORDER BY sale_id NULLS FIRST, {_listed(attributes, suffix=" NULLS FIRST")}) AS place
      FROM w WHERE {source} IS NOT NULL)
    WHERE place = 1"""


_JOINED = " || '||' || ".join(f"coalesce({c}, '')" for c in STORE_KEY)

_PARTS = {
    "w": WIDE_SQL.format(**{t: t for t in TABLES}),
    "customers": _first_per_key("sale_customer_id", "customer_key", CUSTOMER),
    "sellers": _first_per_key("sale_seller_id", "seller_key", SELLER),
    "products": _first_per_key("sale_product_id", "product_key", PRODUCT),
    "stores": f"""
    SELECT ROW_NUMBER() OVER (ORDER BY {_JOINED}, {_listed(STORE_KEY)}) AS store_key,
      store_name, store_location, store_city, store_state, store_country
    FROM (SELECT {_listed(STORE_KEY)}, min(store_state) AS store_state FROM w GROUP BY {_listed(STORE_KEY)})""",
    "suppliers": f"""
    SELECT ROW_NUMBER() OVER (ORDER BY {_listed(SUPPLIER, suffix=" NULLS FIRST")}) AS supplier_key, {_listed(SUPPLIER)}
    FROM (SELECT DISTINCT {_listed(SUPPLIER)} FROM w)""",
    "dates": """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
      CAST(day(d) AS INTEGER) AS day_num, CAST(month(d) AS INTEGER) AS month_num, strftime(d, '%B') AS month_name,
      CAST(quarter(d) AS INTEGER) AS quarter_num, CAST(year(d) AS INTEGER) AS year_num
    FROM (SELECT DISTINCT sale_date AS d FROM w WHERE sale_date IS NOT NULL)""",
    "fact": f"""
    SELECT ROW_NUMBER() OVER (ORDER BY {_listed(FACT, suffix=" NULLS FIRST")}) AS sale_key, {_listed(FACT)}
    FROM (
      SELECT w.sale_id AS source_sale_id, CAST(strftime(w.sale_date, '%Y%m%d') AS INTEGER) AS date_key,
        w.sale_customer_id AS customer_key, w.sale_seller_id AS seller_key, w.sale_product_id AS product_key,
        st.store_key, su.supplier_key, w.sale_quantity, w.sale_total_price
      FROM w
      LEFT JOIN stores st ON {" AND ".join(f"coalesce(w.{c}, '') = coalesce(st.{c}, '')" for c in STORE_KEY)}
      LEFT JOIN suppliers su ON {" AND ".join(f"w.{c} = su.{c}" for c in SUPPLIER)})""",
    "e": """
    SELECT f.*, c.sale_customer_id, c.customer_first_name, c.customer_last_name, c.customer_country,
      s.sale_seller_id, s.seller_first_name, s.seller_last_name, s.seller_country,
      p.sale_product_id, p.product_name, p.product_category, p.product_price, p.product_brand, p.product_rating,
      p.product_reviews, st.store_name, st.store_location, st.store_city, st.store_state, st.store_country,
      su.supplier_name, su.supplier_city, su.supplier_country,
      d.full_date, d.day_num, d.month_num, d.month_name, d.quarter_num, d.year_num,
      concat_ws(' ', c.customer_first_name, c.customer_last_name) AS customer_name,
      concat_ws(' ', s.seller_first_name, s.seller_last_name) AS seller_name
    FROM fact f
    LEFT JOIN customers c ON f.customer_key = c.customer_key
    LEFT JOIN sellers s ON f.seller_key = s.seller_key
    LEFT JOIN products p ON f.product_key = p.product_key
    LEFT JOIN stores st ON f.store_key = st.store_key
    LEFT JOIN suppliers su ON f.supplier_key = su.supplier_key
    LEFT JOIN dates d ON f.date_key = d.date_key""",
}


def _with(body: str, **other_parts: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in (_PARTS | other_parts).items()) + "\n" + body


# Whole cents, divided half up; no money in the tables is negative.
_CENTS = "CAST(round({0} * 100) AS HUGEINT)"


def _ratio(cents: str, count: str) -> str:
    return f"CAST((2 * ({cents}) + ({count})) // (2 * ({count})) AS DOUBLE) / 100"


def _average(column: str) -> str:
    return _ratio(f"sum({_CENTS.format(column)})", f"CAST(count({column}) AS HUGEINT)")


_REVENUE_CENTS = f"sum({_CENTS.format('sale_total_price')})"
ORDERS = "CAST(count(DISTINCT source_sale_id) AS BIGINT) AS total_orders"
UNITS = "CAST(sum(sale_quantity) AS BIGINT) AS total_units_sold"
REVENUE = f"CAST({_REVENUE_CENTS} AS DOUBLE) / 100 AS total_revenue"


def _group(keys: str, measures: list[str], order: str, limit: int | None = None) -> str:
    tail = f" LIMIT {limit}" if limit else ""
    ties = ", ".join(f"{k.strip()} NULLS FIRST" for k in keys.split(","))
    return f"SELECT {keys}, {', '.join(measures)} FROM e GROUP BY {keys} ORDER BY {order}, {ties}{tail}"


_SUPPLIERS = {
    "keys": "supplier_key, supplier_name, supplier_country",
    "measures": [ORDERS, REVENUE, f"{_average('product_price')} AS avg_product_price", UNITS],
    "order": "total_revenue DESC NULLS LAST, total_orders DESC NULLS LAST",
}

_MARTS = {
    "mart_sales_products": _group(
        "product_key, product_name, product_category",
        [
            ORDERS,
            UNITS,
            REVENUE,
            f"{_average('product_rating')} AS avg_rating",
            "CAST(max(product_reviews) AS BIGINT) AS total_reviews",
        ],
        "total_revenue DESC NULLS LAST, total_units_sold DESC NULLS LAST",
        10,
    ),
    "mart_sales_customers": _group(
        "customer_key, customer_name, customer_country",
        [ORDERS, REVENUE, f"{_average('sale_total_price')} AS avg_check"],
        "total_revenue DESC NULLS LAST, total_orders DESC NULLS LAST",
        10,
    ),
    "mart_sales_time": _group(
        "year_num, quarter_num, month_num, month_name",
        [ORDERS, UNITS, REVENUE, f"{_average('sale_total_price')} AS avg_order_value"],
        "year_num, month_num",
    ),
    "mart_sales_stores": _group(
        "store_key, store_name, store_city, store_country",
        [ORDERS, REVENUE, f"{_average('sale_total_price')} AS avg_check"],
        "total_revenue DESC NULLS LAST, total_orders DESC NULLS LAST",
        5,
    ),
    "mart_sales_suppliers": _group(**_SUPPLIERS, limit=5),
    "mart_product_quality": f"""
    SELECT *, CASE WHEN product_reviews > 0 THEN
        {_ratio("CAST(round(total_revenue * 100) AS HUGEINT)", "CAST(product_reviews AS HUGEINT)")} END
        AS revenue_per_review
    FROM (
      SELECT product_key, product_name, {_average("product_rating")} AS product_rating,
        CAST(max(product_reviews) AS BIGINT) AS product_reviews, {UNITS}, {ORDERS}, {REVENUE}
      FROM e GROUP BY product_key, product_name)""",
}

_NOT_NULL_SUPPLIERS = ["supplier_key", "total_orders", "total_revenue", "total_units_sold"]

_TABLE_NAMES = {
    "dim_customers": "customers",
    "dim_sellers": "sellers",
    "dim_products": "products",
    "dim_stores": "stores",
    "dim_suppliers": "suppliers",
    "dim_dates": "dates",
    "fact_sales": "fact",
}

_KEYS = ["customer_key", "seller_key", "product_key", "store_key", "supplier_key", "date_key", "sale_key"]

_NUMBER_TEXT = """
  SELECT l_orderkey, l_linenumber,
    CAST(l_partkey AS VARCHAR) || CASE WHEN l_linenumber = 3 THEN 'x' ELSE '' END AS part_number,
    CASE WHEN l_linenumber = 5 THEN '-' ELSE '' END || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
      || CASE l_linenumber WHEN 2 THEN '.7' WHEN 4 THEN '0000000000' ELSE '' END AS quantity,
    CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR)
      || CASE l_linenumber WHEN 1 THEN '5' WHEN 6 THEN ' EUR' ELSE '' END AS price,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey % 120 AS VARCHAR) END AS rating
  FROM lineitem"""

_TYPED = {
    "part_number": "TRY_CAST(trunc(TRY_CAST(part_number AS DECIMAL(38,6))) AS BIGINT)",
    "quantity": "TRY_CAST(trunc(TRY_CAST(quantity AS DECIMAL(38,6))) AS INTEGER)",
    "price": "TRY_CAST(price AS DECIMAL(14,2))",
    "rating": "TRY_CAST(rating AS DECIMAL(4,2))",
}

ORACLES: dict[str, str] = {
    "csv_ingest_typed": _with(
        "SELECT * REPLACE (CAST(sale_date AS VARCHAR) AS sale_date, CAST(product_price AS DOUBLE) AS product_price,"
        " CAST(product_rating AS DOUBLE) AS product_rating, CAST(sale_total_price AS DOUBLE) AS sale_total_price)"
        " FROM w"
    ),
    "normalize_strings": """
        SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name,
          nullif(trim(CASE WHEN c_custkey % 10 = 0 THEN '   ' ELSE c_mktsegment || '  ' END), '') AS c_mktsegment
        FROM customer""",
    "typed_casts": f"""
        SELECT l_orderkey, l_linenumber, {_TYPED["part_number"]} AS part_number, {_TYPED["quantity"]} AS quantity,
          CAST({_TYPED["price"]} AS DOUBLE) AS price, CAST({_TYPED["rating"]} AS DOUBLE) AS rating
        FROM ({_NUMBER_TEXT})""",
    "rejects_malformed": """
        SELECT l_orderkey AS sale_id,
          CASE WHEN l_linenumber = 1
            THEN concat_ws(',', l_orderkey, CAST(l_quantity AS INT), l_partkey, l_returnflag)
            ELSE concat_ws(',', l_orderkey, CAST(l_quantity AS INT)) END AS source_text,
          TRUE AS has_file
        FROM lineitem WHERE l_linenumber IN (1, 2)""",
    "rejects": f"WITH t AS ({_NUMBER_TEXT})\n"
    + " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS column_name, {c} AS source_value"
        f" FROM t WHERE {c} IS NOT NULL AND {typed} IS NULL"
        for c, typed in _TYPED.items()
    ),
    "parse_dates": """
        SELECT o_orderkey,
          CASE WHEN o_orderkey % 10 IN (0, 2, 3) THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
            AS order_date
        FROM orders""",
    "dim_customers": _with("SELECT * FROM customers"),
    "dim_sellers": _with("SELECT * FROM sellers"),
    "dim_products": _with(
        "SELECT * REPLACE (CAST(product_price AS DOUBLE) AS product_price,"
        " CAST(product_rating AS DOUBLE) AS product_rating) FROM products"
    ),
    "dim_stores": _with("SELECT * FROM stores"),
    "dim_suppliers": _with("SELECT * FROM suppliers"),
    "dim_dates": _with("SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dates"),
    "lookup_store_key": _with(
        f"SELECT w.sale_id, w.store_state, {_listed(STORE_KEY, 'w.')}, st.store_key FROM w LEFT JOIN stores st"
        f" USING ({_listed(STORE_KEY)})"
    ),
    "lookup_store_key_nulls": _with(
        f"SELECT w.sale_id, {_listed(STORE_KEY, 'w.')}, st.store_key FROM w LEFT JOIN stores st"
        f" ON {' AND '.join(f'w.{c} IS NOT DISTINCT FROM st.{c}' for c in STORE_KEY)}",
        w="SELECT * REPLACE (CASE WHEN sale_id % 5 <> 0 THEN store_location END AS store_location,"
        f" CASE WHEN sale_id % 7 <> 0 THEN store_city END AS store_city) FROM ({_PARTS['w']})",
    ),
    "lookup_supplier_key": _with(
        f"SELECT w.sale_id, {_listed(SUPPLIER, 'w.')}, su.supplier_key FROM w LEFT JOIN suppliers su"
        f" ON {' AND '.join(f'w.{c} = su.{c}' for c in SUPPLIER)}"
    ),
    "lookup_supplier_key_nullsafe": _with(
        f"SELECT w.sale_id, {_listed(SUPPLIER, 'w.')}, su.supplier_key FROM w LEFT JOIN suppliers su"
        f" ON {' AND '.join(f'w.{c} IS NOT DISTINCT FROM su.{c}' for c in SUPPLIER)}"
    ),
    "fact_sales": _with("SELECT * REPLACE (CAST(sale_total_price AS DOUBLE) AS sale_total_price) FROM fact"),
    "enriched_sales": _with(
        "SELECT * REPLACE (CAST(sale_total_price AS DOUBLE) AS sale_total_price,"
        " CAST(product_price AS DOUBLE) AS product_price, CAST(product_rating AS DOUBLE) AS product_rating,"
        " CAST(full_date AS VARCHAR) AS full_date) FROM e"
    ),
    **{name: _with(sql) for name, sql in _MARTS.items()},
    "dq_pk_violations": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_dense_key": """
        WITH o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 10 <> 0),
        k AS (SELECT k FROM o UNION ALL SELECT k FROM o WHERE k % 7 = 0),
        b AS (SELECT k AS bound, 1 AS n FROM k UNION ALL SELECT k + 1, -1 FROM k
          UNION ALL SELECT 1, -1 UNION ALL SELECT (SELECT count(*) FROM k) + 1, 1)
        SELECT CAST(bound AS BIGINT) AS bound, CAST(sum(n) AS BIGINT) AS balance
        FROM b GROUP BY bound HAVING sum(n) <> 0""",
    "dq_fk_violations": _with("""
        SELECT f.product_key, count(*) AS row_count FROM fact f
        WHERE f.product_key IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM products p WHERE p.product_key = f.product_key AND p.product_key % 10 <> 0)
        GROUP BY f.product_key"""),
    "dq_numeric_overflow": """
        SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice >= 9999.995""",
    "dq_null_contract": _with(
        f"SELECT unnest([{', '.join(repr(c) for c in _NOT_NULL_SUPPLIERS)}]) AS column_name,"
        f" unnest([{', '.join(f'count(*) - count({c})' for c in _NOT_NULL_SUPPLIERS)}]) AS null_count"
        f" FROM ({_group(**_SUPPLIERS)})"
    ),
    "dq_reconcile": _with("""
        SELECT (SELECT count(*) FROM w) AS raw_rows, (SELECT count(*) FROM fact) AS fact_rows,
          (SELECT count(*) FROM w) - (SELECT count(*) FROM fact) AS difference"""),
    "table_counts": _with(
        " UNION ALL ".join(
            [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {part}" for name, part in _TABLE_NAMES.items()]
            + [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql})" for name, sql in _MARTS.items()]
        )
    ),
    "full_refresh_idempotent": _with(_MARTS["mart_sales_customers"]),
    "full_refresh_star": _with(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, count(DISTINCT {key}) AS key_count,"
            f" CAST(min({key}) AS BIGINT) AS first_key, CAST(max({key}) AS BIGINT) AS last_key FROM {part}"
            for (name, part), key in zip(_TABLE_NAMES.items(), _KEYS)
        )
    ),
}

# Other plans for the same rows.
ORACLES["enriched_sales_large_dims"] = ORACLES["enriched_sales"]
ORACLES["enriched_sales_clustered_dims"] = ORACLES["enriched_sales"]
