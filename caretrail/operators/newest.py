"""The last row of a group by one fixed-width number.

`max_by` and the maximum of a struct keep a row of variable width, so Spark sorts every group for them. Here the columns of the order
are packed into one decimal of at most 38 digits, which a hash aggregate keeps in place: no sort on either side of the exchange, one
number per group in it. The columns come back out of the number, so what orders the rows needs no join, and the rest of the
row is joined by the id that was found, after the choice.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits that every value of a type fits in beside null, and what makes its least value one. Null is zero: before all others.
WIDTHS = {"boolean": (1, 1), "tinyint": (3, 2**7 + 1), "smallint": (5, 2**15 + 1), "int": (10, 2**31 + 1), "date": (10, 2**31 + 1), "bigint": (20, 2**63 + 1)}
DIGITS = 38


def _number(column: Column, kind: str) -> Column:
    plain = F.unix_date(column) if kind == "date" else column.cast("int") if kind == "boolean" else column
    return F.coalesce(plain.cast("decimal(20,0)") + F.lit(Decimal(WIDTHS[kind][1])), F.lit(Decimal(0)))


def packed(order: list[tuple[str, str]]) -> Column:
    """One decimal(38,0) that orders rows as the columns (name, type) do, nulls first."""
    total = sum(WIDTHS[kind][0] for _, kind in order)
    if total > DIGITS:
        raise ValueError(f"{order} take {total} digits of {DIGITS}: cast a column to a narrower type")
    parts, below = None, total
    for name, kind in order:
        below -= WIDTHS[kind][0]
        part = _number(F.col(name), kind) * F.lit(Decimal(10**below))
        parts = part if parts is None else parts + part
    return parts.cast(f"decimal({DIGITS},0)")


def unpacked(number: Column, order: list[tuple[str, str]]) -> list[Column]:
    """The columns of the order out of the number."""
    total = sum(WIDTHS[kind][0] for _, kind in order)
    text, at, out = F.lpad(number.cast("string"), total, "0"), 1, []
    for name, kind in order:
        width, least = WIDTHS[kind]
        value = F.nullif(F.substring(text, at, width).cast("decimal(20,0)"), F.lit(Decimal(0)).cast("decimal(20,0)")) - F.lit(Decimal(least))
        at += width
        plain = F.date_from_unix_date(value.cast("int")) if kind == "date" else value.cast("bigint").cast(kind)
        out.append(plain.alias(name))
    return out


def last_keys(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """`key` and `order` of the last row of every key; nulls come before all values, and rows that tie in the whole order are one.

    The order may hold booleans, whole numbers and dates of at most 38 digits together (a date and an int take 10, a long 20, a tinyint 3).
    """
    kinds = dict(df.dtypes)
    wide = [(name, kinds[name]) for name in order]
    best = df.select(*key, packed(wide).alias("__best")).groupBy(*key).agg(F.max("__best").alias("__best"))
    return best.select(*key, *unpacked(F.col("__best"), wide))


def last_rows(df: DataFrame, candidates: DataFrame, key: list[str], order: list[str], id: str) -> DataFrame:
    """Rows of `df` whose id is that of the last candidate of a key.

    The candidates are narrow (key, order, with the id among the order), so `df` may be anything that costs more to make; the id is unique in it.
    """
    return df.join(last_keys(candidates, key, order).select(id), id)
