"""Text cleaning and typing that turns bad input into NULL, never into an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SALE_DATE_FORMAT = "M/d/yyyy"  # fixed value: the date format of the sales files


def normalize_strings(df: DataFrame) -> DataFrame:
    """Trim spaces in every text column and make empty text NULL."""
    return df.select(
        *[
            F.nullif(F.trim(F.col(f.name)), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def tolerant_cast(text: Column, kind: T.DataType) -> Column:
    """Type a text column; whatever does not fit becomes NULL.

    Whole numbers go through a decimal so that a fraction is cut off
    (``3.7`` is 3) and not refused. Decimals round half up.
    """
    if isinstance(kind, T.IntegralType):
        return text.try_cast(T.DecimalType(38, 6)).try_cast(kind)
    if isinstance(kind, T.DecimalType):
        return text.try_cast(kind)
    if isinstance(kind, T.DateType):
        return F.try_to_date(text, SALE_DATE_FORMAT)
    if isinstance(kind, T.StringType):
        return text
    raise TypeError(f"no tolerant cast to {kind.simpleString()}")


def parse_typed(df: DataFrame, schema: T.StructType, *extra: Column) -> DataFrame:
    """Type the columns of ``schema``; bad values become NULL. ``extra`` columns go along."""
    typed = [tolerant_cast(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*typed, *extra)


def parse_with_rejects(df: DataFrame, schema: T.StructType, keys: list[str], rejected: str, *extra: str) -> DataFrame:
    """Typed columns, and in ``rejected`` the values that typing lost, as an array.

    Each entry holds the row's ``keys`` as they were before typing, ``column_name`` and
    ``source_value``. Blank text is not a loss. Typing is a step of its own, so
    each value is typed once for both uses. ``extra`` columns go along.
    """
    checked = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    text = {c: f"_text_{c}" for c in dict.fromkeys([*keys, *checked])}
    typed = parse_typed(df, schema, *[F.col(c).alias(t) for c, t in text.items()], *[F.col(c) for c in extra])
    losses = [
        F.when(
            F.col(text[c]).isNotNull() & F.col(c).isNull(),
            F.struct(
                *[F.col(text[k]).alias(k) for k in keys],
                F.lit(c).alias("column_name"),
                F.col(text[c]).alias("source_value"),
            ),
        )
        for c in checked
    ]
    return typed.select(*schema.names, F.array_compact(F.array(*losses)).alias(rejected), *extra)


def explode_rejects(df: DataFrame, rejected: str) -> DataFrame:
    """One row per lost value. Rows that lost nothing give none; there is no shuffle."""
    return df.select(F.explode(rejected).alias("lost")).select("lost.*")


def find_rejects(df: DataFrame, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The values of a text frame that typing to ``schema`` loses."""
    return explode_rejects(parse_with_rejects(df, schema, keys, "rejected"), "rejected")
