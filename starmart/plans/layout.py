"""Which raw columns make up which dimension."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields

from starmart.contracts import STAR


def _attributes(dimension: str, keys: int) -> tuple[str, ...]:
    return tuple(STAR[dimension].names[keys:])


@dataclass(frozen=True)
class StarLayout:
    """Attribute columns per dimension, in contract order."""

    customers: tuple[str, ...] = _attributes("dim_customers", 2)
    sellers: tuple[str, ...] = _attributes("dim_sellers", 2)
    products: tuple[str, ...] = _attributes("dim_products", 2)
    stores: tuple[str, ...] = _attributes("dim_stores", 1)
    # Fixed value: the columns that identify a store. The state is not among them.
    store_key: tuple[str, ...] = (
        "store_name",
        "store_location",
        "store_city",
        "store_country",
        "store_phone",
        "store_email",
    )
    suppliers: tuple[str, ...] = _attributes("dim_suppliers", 1)

    def within(self, columns: Iterable[str]) -> StarLayout:
        """The layout for records that have only some of the columns."""
        present = set(columns)
        return StarLayout(
            **{f.name: tuple(c for c in getattr(self, f.name) if c in present) for f in fields(self)}
        )


FULL = StarLayout()
