"""From a stored star to stored marts."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from starmart.contracts import MARTS as MART_CONTRACTS
from starmart.operators.enrich import DIMENSION_KEYS
from starmart.operators.keys import SPREAD
from starmart.operators.marts import MARTS, decided_by_key, key_groups, mart_from_star
from starmart.plans.star import Star, stored_dims
from starmart.sources.staging import Staging
from starmart.sources.tables import JdbcStore, ParquetStore, at_once
from starmart.sources.versions import Snapshot

# The dimensions each mart reads.
MART_DIMENSIONS = {
    "mart_sales_products": ("dim_products",),
    "mart_sales_customers": ("dim_customers",),
    "mart_sales_time": ("dim_dates",),
    "mart_sales_stores": ("dim_stores",),
    "mart_sales_suppliers": ("dim_suppliers", "dim_products"),
    "mart_product_quality": ("dim_products",),
}


def mart_of(star: Star, mart: str, limit: bool = True) -> DataFrame:
    """A mart over a star that is not stored: only the parts it needs are made."""
    names = MART_DIMENSIONS[mart]
    columns = [DIMENSION_KEYS[n] for n in names] + ["source_sale_id", "sale_quantity", "sale_total_price"]
    if SPREAD in star.raw.columns:
        columns.append(SPREAD)
    dims = star.dims(*names)
    for name in names:
        if name != MARTS[mart].dimension:  # joined to the fact, after a look at its size
            dims[name] = star.staging.keep(dims[name], name)
    return mart_from_star(mart, star.fact(columns), dims, limit=limit, staging=star.staging)


def shared_groups(fact: DataFrame, staging: Staging) -> dict[str, DataFrame]:
    """For marts that describe one dimension: the fact aggregated by its key, once for all."""
    sharing: dict[str, list[str]] = {}
    for mart, spec in MARTS.items():
        if decided_by_key(mart):
            sharing.setdefault(spec.dimension, []).append(mart)
    groups = {}
    for dimension, marts in sharing.items():
        if len(marts) > 1:
            groups.update(dict.fromkeys(marts, staging.keep(key_groups(fact, *marts), f"{dimension}-groups")))
    return groups


def store_marts(star: ParquetStore | Snapshot, target: ParquetStore | JdbcStore, staging: Staging) -> dict[str, int]:
    """Refresh all mart tables from stored star tables; the rows written per mart.

    Rows are put in order only where a limit asks for it.
    """
    fact, dims = star.read("fact_sales"), stored_dims(star)
    groups = shared_groups(fact, staging)

    def write(mart: str) -> int:
        frame = mart_from_star(mart, fact, dims, ordered=False, groups=groups.get(mart), staging=staging)
        return target.write(frame, mart, MART_CONTRACTS[mart])

    return at_once({mart: partial(write, mart) for mart in MARTS})
