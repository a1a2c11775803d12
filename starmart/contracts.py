"""Column contracts of the raw records, the star tables and the marts.

Names, order, types and nullability below are fixed values: they are the
published table layouts, so files and tables written elsewhere keep working.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "text": T.StringType(),
    "money": T.DecimalType(14, 2),
    "rating": T.DecimalType(4, 2),
}


def contract(layout: str) -> T.StructType:
    """Build a schema from ``type: names`` lines; a trailing ``!`` means not null."""
    fields = []
    for line in layout.strip().splitlines():
        kind, names = line.split(":")
        for name in names.split():
            fields.append(T.StructField(name.rstrip("!"), _TYPES[kind.strip()], not name.endswith("!")))
    return T.StructType(fields)


# The flat sales record, in file order.
RAW = contract(
    """
    long: sale_id
    date: sale_date
    long: sale_customer_id
    text: customer_first_name customer_last_name
    int: customer_age
    text: customer_email customer_country customer_postal_code
    text: customer_pet_type customer_pet_name customer_pet_breed
    long: sale_seller_id
    text: seller_first_name seller_last_name seller_email seller_country seller_postal_code
    long: sale_product_id
    text: product_name product_category
    money: product_price
    int: product_quantity
    text: pet_category
    money: product_weight
    text: product_color product_size product_brand product_material product_description
    rating: product_rating
    int: product_reviews
    date: product_release_date product_expiry_date
    int: sale_quantity
    money: sale_total_price
    text: store_name store_location store_city store_state store_country store_phone store_email
    text: supplier_name supplier_contact supplier_email supplier_phone supplier_address
    text: supplier_city supplier_country
    """
)

# The star tables.
STAR = {
    "dim_customers": contract(
        """
        long: customer_key! sale_customer_id
        text: customer_first_name customer_last_name
        int: customer_age
        text: customer_email customer_country customer_postal_code
        text: customer_pet_type customer_pet_name customer_pet_breed
        """
    ),
    "dim_sellers": contract(
        """
        long: seller_key! sale_seller_id
        text: seller_first_name seller_last_name seller_email seller_country seller_postal_code
        """
    ),
    "dim_products": contract(
        """
        long: product_key! sale_product_id
        text: product_name product_category
        money: product_price
        int: product_quantity
        text: pet_category
        money: product_weight
        text: product_color product_size product_brand product_material product_description
        rating: product_rating
        int: product_reviews
        date: product_release_date product_expiry_date
        """
    ),
    "dim_stores": contract(
        """
        long: store_key!
        text: store_name store_location store_city store_state store_country store_phone store_email
        """
    ),
    "dim_suppliers": contract(
        """
        long: supplier_key!
        text: supplier_name supplier_contact supplier_email supplier_phone supplier_address
        text: supplier_city supplier_country
        """
    ),
    "dim_dates": contract(
        """
        int: date_key!
        date: full_date
        int: day_num month_num
        text: month_name
        int: quarter_num year_num
        """
    ),
    "fact_sales": contract(
        """
        long: sale_key! source_sale_id
        int: date_key
        long: customer_key seller_key product_key store_key supplier_key
        int: sale_quantity
        money: sale_total_price
        """
    ),
}

# The mart tables.
MARTS = {
    "mart_sales_products": contract(
        """
        long: product_key!
        text: product_name product_category
        long: total_orders! total_units_sold!
        double: total_revenue! avg_rating
        long: total_reviews
        """
    ),
    "mart_sales_customers": contract(
        """
        long: customer_key!
        text: customer_name customer_country
        long: total_orders!
        double: total_revenue! avg_check!
        """
    ),
    "mart_sales_time": contract(
        """
        int: year_num! quarter_num! month_num!
        text: month_name
        long: total_orders! total_units_sold!
        double: total_revenue! avg_order_value!
        """
    ),
    "mart_sales_stores": contract(
        """
        long: store_key!
        text: store_name store_city store_country
        long: total_orders!
        double: total_revenue! avg_check!
        """
    ),
    "mart_sales_suppliers": contract(
        """
        long: supplier_key!
        text: supplier_name supplier_country
        long: total_orders!
        double: total_revenue! avg_product_price
        long: total_units_sold!
        """
    ),
    "mart_product_quality": contract(
        """
        long: product_key!
        text: product_name
        double: product_rating
        long: product_reviews
        long: total_units_sold! total_orders!
        double: total_revenue! revenue_per_review
        """
    ),
}

# The key of each table, also its row order inside stored files.
TABLE_KEYS = {
    "dim_customers": ("customer_key",),
    "dim_sellers": ("seller_key",),
    "dim_products": ("product_key",),
    "dim_stores": ("store_key",),
    "dim_suppliers": ("supplier_key",),
    "dim_dates": ("date_key",),
    "fact_sales": ("sale_key",),
    "mart_sales_products": ("product_key",),
    "mart_sales_customers": ("customer_key",),
    "mart_sales_time": ("year_num", "month_num"),
    "mart_sales_stores": ("store_key",),
    "mart_sales_suppliers": ("supplier_key",),
    "mart_product_quality": ("product_key",),
}


# Which key leads to which dimension, in join order.
DIMENSION_KEYS = {
    "dim_customers": "customer_key",
    "dim_sellers": "seller_key",
    "dim_products": "product_key",
    "dim_stores": "store_key",
    "dim_suppliers": "supplier_key",
    "dim_dates": "date_key",
}


def subset(schema: T.StructType, columns) -> T.StructType:
    """The fields of ``schema`` that occur in ``columns``, in contract order."""
    wanted = set(columns)
    return T.StructType([f for f in schema.fields if f.name in wanted])


def project_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Pin names, order and types; say which columns are missing."""
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the frame: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
