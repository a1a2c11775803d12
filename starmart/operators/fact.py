"""The sales fact: keys resolved, one row per sales record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from starmart.contracts import STAR
from starmart.operators.dimensions import MEMBER_ROWS, date_key
from starmart.operators.keys import SPREAD, assign_dense_key, blank_nulls, frequent_members, lookup
from starmart.sources.staging import Staging

FACT_COLUMNS = STAR["fact_sales"].names
_ORDER = [c for c in FACT_COLUMNS if c != "sale_key"]


def _own_columns() -> dict:
    """Fact columns that come from the sales record alone."""
    return {
        "source_sale_id": F.col("sale_id"),
        "date_key": date_key(F.col("sale_date")),
        "customer_key": F.col("sale_customer_id"),
        "seller_key": F.col("sale_seller_id"),
        "product_key": F.col("sale_product_id"),
        "sale_quantity": F.col("sale_quantity"),
        "sale_total_price": F.col("sale_total_price"),
    }


def resolve_store_key(df: DataFrame, stores: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Add ``store_key``. NULL counts as empty text in the comparison; the columns stay as they are."""
    parts = {c: f"_part_{c}" for c in natural_key}
    blanks = [blank.alias(parts[c]) for c, blank in zip(natural_key, blank_nulls(natural_key))]
    table = stores.select("store_key", *blanks, MEMBER_ROWS)
    frequent = frequent_members(table, MEMBER_ROWS)
    found = lookup(df.select("*", *blanks), table, list(parts.values()), ["store_key"], frequent=frequent)
    return found.drop(*parts.values())


def resolve_supplier_key(
    df: DataFrame, suppliers: DataFrame, columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Add ``supplier_key``; NULL where a supplier column is NULL, unless ``null_safe``."""
    return lookup(
        df,
        suppliers,
        columns,
        ["supplier_key"],
        null_safe=null_safe,
        frequent=frequent_members(suppliers, MEMBER_ROWS),
    )


def build_fact(
    raw: DataFrame,
    dims: Mapping[str, DataFrame],
    store_natural_key: Sequence[str],
    supplier_columns: Sequence[str],
    staging: Staging | None = None,
    columns: Sequence[str] = FACT_COLUMNS,
) -> DataFrame:
    """The fact, or only some ``columns`` of it.

    A lookup or the numbering happens only if its key is among ``columns``.
    The records' ``SPREAD`` numbers, if they have any, go along and may be
    among ``columns`` too. ``sale_key`` follows the sale id and then every other fact column, so rows
    with the same number of ties are equal rows.
    """
    wanted = set(_ORDER) if "sale_key" in columns else set(columns)
    carried = [SPREAD] if SPREAD in raw.columns else []
    if "store_key" in wanted:
        carried += store_natural_key
    if "supplier_key" in wanted:
        carried += supplier_columns
    own = [value.alias(name) for name, value in _own_columns().items() if name in wanted]
    fact = raw.select(*own, *carried)
    if "store_key" in wanted:
        fact = resolve_store_key(fact, dims["dim_stores"], store_natural_key).drop(*store_natural_key)
    if "supplier_key" in wanted:
        fact = resolve_supplier_key(fact, dims["dim_suppliers"], supplier_columns)
    if "sale_key" in columns:
        if staging is None:
            raise ValueError("sale_key needs a staging area")
        fact = assign_dense_key(fact.select(*[c for c in fact.columns if c in (*_ORDER, SPREAD)]), _ORDER, "sale_key", staging)
    return fact.select(*columns)
