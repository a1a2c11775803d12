"""Denormalised sales: the fact with the attributes of its dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starmart.contracts import DIMENSION_KEYS
from starmart.operators.keys import SPREAD, frequent_rows, lookup

# Derived names and the columns they are made of.
FULL_NAMES = {
    "customer_name": ("customer_first_name", "customer_last_name"),
    "seller_name": ("seller_first_name", "seller_last_name"),
}

# Types of the enriched measures. Money leaves as double, rounded.
_READ_TYPES = {
    "sale_total_price": "double",
    "product_price": "double",
    "product_rating": "double",
    "sale_quantity": "bigint",
    "product_reviews": "bigint",
    "year_num": "int",
    "quarter_num": "int",
    "month_num": "int",
}

# A dimension whose needed columns take at most this many bytes, by the statistics of its
# stored table, is broadcast and needs no skew handling.
BROADCAST_BYTES = 8_000_000


def full_name(name: str) -> Column:
    """First and last name with a space between; NULL parts are left out."""
    return F.concat_ws(" ", *FULL_NAMES[name])


def estimated_bytes(df: DataFrame) -> int:
    """What Spark's statistics say about the size of ``df``; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def attach(
    rows: DataFrame,
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    take: list[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    spread: str = SPREAD,
) -> DataFrame:
    """Left join a dimension to ``rows`` on its key.

    Beyond ``broadcast_bytes`` the join shuffles. The frequent keys it needs are then counted
    on ``fact``, the plain table behind ``rows``, and not on what is joined already: so each
    large dimension adds the same to the plan.
    """
    table = dim.select(key, *take)
    if estimated_bytes(table) <= broadcast_bytes:
        return rows.join(F.broadcast(table), key, "left")
    return lookup(rows, table, [key], take, frequent=frequent_rows(fact, table, [key]), spread=spread)


def _weight(dim: DataFrame, key: str, take: list[str], broadcast_bytes: int) -> tuple[int, int]:
    """Joins that shuffle come first, narrow ones before wide ones, so that no row is shuffled with more than it must.

    Dimensions that Spark's own size check may still broadcast come after those that it cannot, and last those
    that are broadcast in any case.
    """
    size = estimated_bytes(dim.select(key, *take))
    own = dim.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    kinds = dim.schema
    return (2 if size <= broadcast_bytes else 1 if size <= own else 0), sum(_wide(kinds[c].dataType) for c in take)


def _wide(kind: T.DataType) -> int:
    return 20 if isinstance(kind, T.StringType) else 8


def enrich(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    needed: Iterable[str] | None = None,
    exact: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fact columns, dimension attributes and derived names, typed for analysis.

    ``exact`` keeps money as decimal, which is what sums should be made from.

    ``needed`` names the wanted columns. A dimension that gives none of them is
    not joined at all: keys are unique, so its join could not change anything
    else, but the optimiser cannot know that. ``dims`` may lack dimensions; a
    derived name is left out if its parts are.
    """
    everything = [c for name in DIMENSION_KEYS if name in dims for c in dims[name].columns]
    if needed is None:
        known = {*fact.columns, *everything}
        names = [name for name, parts in FULL_NAMES.items() if known.issuperset(parts)]
        wanted = list(dict.fromkeys([*fact.columns, *everything, *names]))
    else:
        wanted = list(needed)
    sources = set(wanted)
    for name, parts in FULL_NAMES.items():
        if name in sources:
            sources.update(parts)
    keys = [k for name, k in DIMENSION_KEYS.items() if name in dims and sources & set(dims[name].columns) - {k}]
    spread = "sale_key" if "sale_key" in fact.columns else SPREAD  # unique and stored, so it scatters rows best
    rows = fact.select(*[c for c in fact.columns if c in sources or c in keys or c == spread])
    joins, given = [], set(rows.columns)
    for name, key in DIMENSION_KEYS.items():
        take = [c for c in dims[name].columns if c in sources and c not in given] if name in dims else []
        given.update(take)
        if take:
            joins.append((dims[name], key, take))
    for dim, key, take in sorted(joins, key=lambda join: _weight(*join, broadcast_bytes)):
        rows = attach(rows, fact, dim, key, take, broadcast_bytes, spread)
    return rows.select(*[_enriched_column(c, exact) for c in wanted])


def _enriched_column(name: str, exact: bool) -> Column:
    if name in FULL_NAMES:
        return full_name(name).alias(name)
    kind = _READ_TYPES.get(name)
    if kind is None or (exact and kind == "double"):
        return F.col(name)
    value = F.round(name, 2) if kind == "double" else F.col(name)
    return value.cast(kind).alias(name)
