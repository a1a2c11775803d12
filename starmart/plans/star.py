"""From typed sales records to the star, part by part or as a stored whole."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, types as T

from starmart.contracts import STAR, project_to, subset
from starmart.operators.dimensions import (
    composite_key_dim,
    date_dim,
    distinct_row_dim,
    natural_key_dim,
)
from starmart.operators.enrich import DIMENSION_KEYS
from starmart.operators.fact import FACT_COLUMNS, build_fact
from starmart.operators.keys import SPREAD, with_spread
from starmart.plans.layout import FULL, StarLayout
from starmart.sources.staging import Staging, shuffles_freed
from starmart.sources.tables import JdbcStore, ParquetStore, at_once

DIMENSIONS = tuple(DIMENSION_KEYS)
STAR_TABLES = (*DIMENSIONS, "fact_sales")  # load order: the fact refers to the rest
SURVIVOR_ORDER = ["sale_id"]
_LOOKED_UP = {"dim_stores": "store_key", "dim_suppliers": "supplier_key"}


def stage_records(df: DataFrame, staging: Staging) -> DataFrame:
    """Sales records stored once, with numbers to scatter them by."""
    with shuffles_freed(staging.spark):
        return staging.keep(with_spread(df), "raw", compression="zstd")


class Star:
    """The parts of a star over one frame of sales records.

    Parts are made when asked for, each once. ``raw`` is read for every part, so
    it should come from ``stage_records``, except when only one part is wanted.
    """

    def __init__(self, raw: DataFrame, staging: Staging, layout: StarLayout = FULL):
        self.raw = raw
        self.staging = staging
        self.layout = layout.within(raw.columns)
        self._members: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    def members(self, name: str) -> DataFrame:
        """A dimension, with the number of sales per member where lookups use it."""
        if name not in self._members:
            self._members[name] = self._build(name)
        return self._members[name]

    def looked_up(self, name: str) -> DataFrame:
        """``members``, stored once: Spark then knows the size, and does not shuffle the sales for a small table."""
        if name not in self._stored:
            self._stored[name] = self.staging.keep(self.members(name), name)
        return self._stored[name]

    def _build(self, name: str) -> DataFrame:
        raw, layout = self.raw, self.layout
        match name:
            case "dim_customers":
                return natural_key_dim(
                    raw, "sale_customer_id", "customer_key", layout.customers, SURVIVOR_ORDER
                )
            case "dim_sellers":
                return natural_key_dim(raw, "sale_seller_id", "seller_key", layout.sellers, SURVIVOR_ORDER)
            case "dim_products":
                return natural_key_dim(raw, "sale_product_id", "product_key", layout.products, SURVIVOR_ORDER)
            case "dim_stores":
                return composite_key_dim(raw, "store_key", layout.store_key, layout.stores, self.staging)
            case "dim_suppliers":
                return distinct_row_dim(raw, "supplier_key", layout.suppliers, self.staging)
            case "dim_dates":
                return date_dim(raw, "sale_date")
        raise KeyError(name)

    def dim(self, name: str) -> DataFrame:
        """A dimension with its contract columns."""
        frame = self.members(name)
        return project_to(frame, subset(STAR[name], frame.columns))

    def dims(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.dim(name) for name in names or DIMENSIONS}

    def fact(self, columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
        """The fact, or some columns of it with no more work than they need."""
        everything = "sale_key" in columns
        needed = [name for name, key in _LOOKED_UP.items() if everything or key in columns]
        dims = at_once({name: partial(self.looked_up, name) for name in needed})
        fact = build_fact(self.raw, dims, self.layout.store_key, self.layout.suppliers, self.staging, columns)
        typed = subset(STAR["fact_sales"], columns)
        return project_to(fact, T.StructType([*typed.fields, *[f for f in fact.schema.fields if f.name == SPREAD]]))

    def store(self, store: ParquetStore) -> dict[str, int]:
        """Refresh all star tables, the fact last; the rows written per table."""

        def write(name: str) -> int:
            frame = self.members(name)
            return store.write(frame, name, subset(STAR[name], frame.columns))

        with shuffles_freed(self.staging.spark):
            written = at_once({name: partial(write, name) for name in DIMENSIONS})
            written["fact_sales"] = store.write(self.fact(), "fact_sales", STAR["fact_sales"])
        return written


def stored_dims(store: ParquetStore | JdbcStore) -> dict[str, DataFrame]:
    return {name: store.read(name) for name in DIMENSIONS}
