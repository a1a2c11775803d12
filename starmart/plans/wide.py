"""The test tables in the layout of flat sales records.

``WIDE_SQL`` is valid in Spark and in any other SQL engine, once each ``{table}``
is replaced by a table name. Spark joins the same tables in the order of ``_SPARK_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

WIDE_SQL = """
SELECT l.l_orderkey AS sale_id,
  CAST(o.o_orderdate AS DATE) AS sale_date,
  o.o_custkey AS sale_customer_id,
  substr(c.c_name,1,8) AS customer_first_name, substr(c.c_name,10,9) AS customer_last_name,
  cn.n_name AS customer_country,
  l.l_suppkey AS sale_seller_id,
  substr(s.s_name,1,8) AS seller_first_name, substr(s.s_name,10,9) AS seller_last_name,
  sn.n_name AS seller_country,
  l.l_partkey AS sale_product_id, p.p_name AS product_name, p.p_type AS product_category, p.p_brand AS product_brand,
  CAST(p.p_retailprice AS DECIMAL(14,2)) AS product_price,
  CAST(CAST(10 + p.p_partkey % 41 AS DECIMAL(6,2)) * 0.10 AS DECIMAL(4,2)) AS product_rating,
  CAST((p.p_partkey % 7) * p.p_size AS INT) AS product_reviews,
  CAST(l.l_quantity AS INT) AS sale_quantity,
  CAST(l.l_extendedprice AS DECIMAL(14,2)) AS sale_total_price,
  c.c_mktsegment AS store_name, o.o_orderpriority AS store_location, cn.n_name AS store_city,
  l.l_returnflag AS store_state, cr.r_name AS store_country,
  s.s_name AS supplier_name, sn.n_name AS supplier_country,
  CASE WHEN sn.n_nationkey % 5 = 0 THEN NULL ELSE sr.r_name END AS supplier_city
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} cn ON c.c_nationkey = cn.n_nationkey
JOIN {region} cr ON cn.n_regionkey = cr.r_regionkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {nation} sn ON s.s_nationkey = sn.n_nationkey
JOIN {region} sr ON sn.n_regionkey = sr.r_regionkey
JOIN {part} p ON l.l_partkey = p.p_partkey
"""

# The same columns. Orders meet their customers first, as there are fewer of them than lines; then come the tables that may
# be too large for a broadcast, and last the small ones. So lines are shuffled twice at most, with narrow rows.
_SPARK_SQL = (
    WIDE_SQL.partition("FROM {lineitem}")[0]
    + """
FROM {lineitem} l
JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {nation} cn ON c.c_nationkey = cn.n_nationkey
JOIN {region} cr ON cn.n_regionkey = cr.r_regionkey
JOIN {nation} sn ON s.s_nationkey = sn.n_nationkey
JOIN {region} sr ON sn.n_regionkey = sr.r_regionkey
"""
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, if the scan has fewer tasks than that.

    A file gives at most one task per row group, so a small table in one group
    would keep every later step on one core. Larger scans are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def wide_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales lines as flat records."""
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    tables["lineitem"] = spread(tables["lineitem"])
    return spark.sql(_SPARK_SQL, **tables)
