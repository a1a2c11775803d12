"""The six sales marts, as data, and two ways to compute them.

``sales_mart`` groups enriched sales, wherever they come from.

``mart_from_star`` gives the same rows from the star tables for less. Where all
descriptive group columns belong to one dimension, its key alone decides them, so
the fact is aggregated by that key first and the dimension is joined to the
groups. The fact is then never joined, nor shuffled with its descriptions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starmart.contracts import MARTS as MART_CONTRACTS, project_to, subset
from starmart.functions.money import half_up_ratio, money_avg, money_sum
from starmart.operators.enrich import DIMENSION_KEYS, FULL_NAMES, enrich, full_name
from starmart.sources.staging import Staging


def orders() -> Column:
    """Distinct sale ids, NULL not counted."""
    return F.count_distinct(F.col("source_sale_id"))


def units() -> Column:
    return F.sum(F.col("sale_quantity").cast("bigint"))


def revenue() -> Column:
    return money_sum(F.col("sale_total_price"))


def average_line() -> Column:
    """Average amount per sales line, not per order."""
    return money_avg(F.col("sale_total_price"))


def revenue_per_review(groups: DataFrame) -> DataFrame:
    ratio = half_up_ratio(F.col("total_revenue"), F.col("product_reviews").cast("bigint"))
    return groups.withColumn("revenue_per_review", ratio)


@dataclass(frozen=True)
class Mart:
    """``fact_measures`` need only the fact; ``dimension_measures`` aggregate attributes.

    ``dimension`` is set if its key decides all group columns. A measure of its
    own attributes is then the attribute itself: ``attributes`` maps the output name
    of each to its column.
    """

    keys: tuple[str, ...]
    fact_measures: Mapping[str, Callable[[], Column]]
    order: tuple[tuple[str, bool], ...]  # (column, descending)
    dimension_measures: Mapping[str, Callable[[], Column]] | None = None
    limit: int | None = None
    dimension: str | None = None
    attributes: Mapping[str, str] | None = None
    borrowed: tuple[str, ...] = ()  # columns of another dimension the measures read
    finish: Callable[[DataFrame], DataFrame] | None = None

    def measures(self) -> dict[str, Callable[[], Column]]:
        return {**self.fact_measures, **(self.dimension_measures or {})}


# Group columns, measures, order and row limits of the marts.
MARTS = {
    "mart_sales_products": Mart(
        keys=("product_key", "product_name", "product_category"),
        fact_measures={"total_orders": orders, "total_units_sold": units, "total_revenue": revenue},
        dimension_measures={
            "avg_rating": lambda: money_avg(F.col("product_rating")),
            "total_reviews": lambda: F.max("product_reviews"),
        },
        order=(("total_revenue", True), ("total_units_sold", True)),
        limit=10,
        dimension="dim_products",
        attributes={"avg_rating": "product_rating", "total_reviews": "product_reviews"},
    ),
    "mart_sales_customers": Mart(
        keys=("customer_key", "customer_name", "customer_country"),
        fact_measures={"total_orders": orders, "total_revenue": revenue, "avg_check": average_line},
        order=(("total_revenue", True), ("total_orders", True)),
        limit=10,
        dimension="dim_customers",
    ),
    "mart_sales_time": Mart(
        keys=("year_num", "quarter_num", "month_num", "month_name"),
        fact_measures={
            "total_orders": orders,
            "total_units_sold": units,
            "total_revenue": revenue,
            "avg_order_value": average_line,
        },
        order=(("year_num", False), ("month_num", False)),
    ),
    "mart_sales_stores": Mart(
        keys=("store_key", "store_name", "store_city", "store_country"),
        fact_measures={"total_orders": orders, "total_revenue": revenue, "avg_check": average_line},
        order=(("total_revenue", True), ("total_orders", True)),
        limit=5,
        dimension="dim_stores",
    ),
    "mart_sales_suppliers": Mart(
        keys=("supplier_key", "supplier_name", "supplier_country"),
        fact_measures={"total_orders": orders, "total_revenue": revenue, "total_units_sold": units},
        # The price belongs to another dimension, so it varies inside a supplier.
        dimension_measures={"avg_product_price": lambda: money_avg(F.col("product_price"))},
        order=(("total_revenue", True), ("total_orders", True)),
        limit=5,
        dimension="dim_suppliers",
        borrowed=("product_price",),
    ),
    "mart_product_quality": Mart(
        keys=("product_key", "product_name"),
        fact_measures={"total_units_sold": units, "total_orders": orders, "total_revenue": revenue},
        dimension_measures={
            "product_rating": lambda: money_avg(F.col("product_rating")),
            "product_reviews": lambda: F.max("product_reviews"),
        },
        order=(("total_revenue", True), ("product_rating", True)),
        dimension="dim_products",
        attributes={"product_rating": "product_rating", "product_reviews": "product_reviews"},
        finish=revenue_per_review,
    ),
}

# Fact columns the fact measures read.
_MEASURED = ("source_sale_id", "sale_quantity", "sale_total_price")


def sales_mart(enriched: DataFrame, mart: str, limit: bool = True, ordered: bool = True) -> DataFrame:
    """Group enriched sales into the named mart."""
    spec = MARTS[mart]
    groups = enriched.groupBy(*spec.keys).agg(*[m().alias(n) for n, m in spec.measures().items()])
    return _present(groups, mart, limit, ordered)


def key_groups(fact: DataFrame, *marts: str) -> DataFrame:
    """One row per dimension key with all fact measures of ``marts``.

    The marts must describe the same dimension. Marts that share a dimension can
    then share one pass over the fact.
    """
    specs = [MARTS[m] for m in marts]
    (dimension,) = {s.dimension for s in specs}
    measures = {n: m for s in specs for n, m in s.fact_measures.items()}
    return fact.groupBy(DIMENSION_KEYS[dimension]).agg(*[m().alias(n) for n, m in measures.items()])


def decided_by_key(mart: str) -> bool:
    """Whether all but the fact measures are attributes of one dimension."""
    spec = MARTS[mart]
    return spec.dimension is not None and set(spec.dimension_measures or ()) <= set(spec.attributes or ())


def mart_from_star(
    mart: str,
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    limit: bool = True,
    ordered: bool = True,
    groups: DataFrame | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """The named mart from star tables; equal to ``sales_mart`` over all of them joined.

    ``groups`` may hold the ``key_groups`` of a mart that is ``decided_by_key``. With
    ``staging`` the few rows of a limited mart are found first, and the dimension
    is only scanned for them instead of being joined to all groups.
    """
    spec = MARTS[mart]
    measures = [m().alias(n) for n, m in spec.measures().items()]
    if spec.dimension is None:
        rows = enrich(fact, dims, [*spec.keys, *_MEASURED], exact=True)
        return _present(rows.groupBy(*spec.keys).agg(*measures), mart, limit, ordered)

    key = DIMENSION_KEYS[spec.dimension]
    if decided_by_key(mart):
        groups = key_groups(fact, mart) if groups is None else groups
        late, early = dict(spec.attributes or {}), list(spec.fact_measures)
    else:
        groups = enrich(fact, dims, [key, *_MEASURED, *spec.borrowed], exact=True).groupBy(key).agg(*measures)
        late, early = {}, list(spec.measures())
    described = [c for c in spec.keys if c != key]
    columns = dict.fromkeys([p for c in described for p in FULL_NAMES.get(c, (c,))] + list(late.values()))
    members = dims[spec.dimension].select(key, *columns)
    if staging and limit and spec.limit:
        measured = project_to(groups, subset(MART_CONTRACTS[mart], [key, *early]))
        groups = staging.keep(measured.orderBy(*sort_columns(spec, [key])).limit(spec.limit), mart)
        members = members.join(F.broadcast(groups.select(key)), key, "left_semi")
    groups = groups.join(members, key, "left").select(
        *[(full_name(c) if c in FULL_NAMES else F.col(c)).alias(c) for c in spec.keys],
        *early,
        *[F.col(column).alias(name) for name, column in late.items()],
    )
    return _present(groups, mart, limit, ordered)


def _present(groups: DataFrame, mart: str, limit: bool, ordered: bool) -> DataFrame:
    """Derived columns, contract types, order and row limit.

    The group columns come last in the order, so equal measures cannot make
    the rows of a limited mart depend on chance.
    """
    spec = MARTS[mart]
    finished = spec.finish(groups) if spec.finish else groups
    result = project_to(finished, MART_CONTRACTS[mart])
    limit_rows = spec.limit if limit else None
    if ordered or limit_rows:
        result = result.orderBy(*sort_columns(spec, spec.keys))
    return result.limit(limit_rows) if limit_rows else result


def sort_columns(spec: Mart, keys: Sequence[str]) -> list[Column]:
    """The mart's order, then ``keys``. One key of a dimension decides as much as all of them."""
    chosen = [F.desc(c) if descending else F.asc_nulls_first(c) for c, descending in spec.order]
    return chosen + [F.asc_nulls_first(k) for k in keys if k not in dict(spec.order)]
