"""Aggregations.

All of them are plain ``groupBy().agg()`` plans: Spark runs a partial aggregate
before the shuffle, so a key holding a third of the rows is collapsed to one row
per map task before it reaches a reducer.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_DIGITS = 2
#: Money is summed as whole numbers, so a total is the same for any partitioning.
MONEY_UNITS = 1_000_000


def money_sum(amount: str | Column) -> Column:
    """Exact sum of an amount, as a decimal of six digits; an all-null group gives null. A row adds two
    longs, its whole part and its millionths; decimals come in above the aggregate, once per group.
    A row keeps six decimals as far as a double has them (below 4e9 all). The millionths would need
    2^43 rows to overflow, the whole parts a total of 9.2e18: then the sum is an error, no wrong number."""
    c = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    whole = F.floor(c)
    millionths = F.rint((c - whole) * F.lit(float(MONEY_UNITS))).cast("long")
    total = F.sum(whole).cast("decimal(19,0)") + F.sum(millionths).cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(6,6)")
    return total.cast("decimal(38,6)")


def money(total: str | Column) -> Column:
    """A sum rounded to cents, as a double."""
    c = F.col(total) if isinstance(total, str) else total
    return F.round(c, MONEY_DIGITS).cast("double")


# A1/A2/A3 — grouped revenue and units in one pass. Revenue: null rows skipped, an
# all-null group gives null (Spark/SQL rules). Units: sum of smallint -> bigint.
def revenue_and_units(df: DataFrame, keys: Sequence[str | Column], revenue_name: str = "total_revenue",
                      units_name: str = "units", revenue_col: str = "revenue",
                      quantity_col: str = "quantity") -> DataFrame:
    return df.groupBy(*keys).agg(
        money_sum(revenue_col).alias(revenue_name),
        F.sum(quantity_col).alias(units_name),
    )


# A4 — pandas rules: null keys are dropped and an all-null group sums to 0.0
def revenue_zero_fill(df: DataFrame, key: str, revenue_name: str = "total_revenue",
                      revenue_col: str = "revenue") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.coalesce(money_sum(revenue_col), F.lit(0)).alias(revenue_name)
    )


# A5/A6 — whole-table totals as a one-row frame
def totals(df: DataFrame, **named: Column) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in named.items()])


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# A8 — share of the total held by rows flagged as "top" (e.g. the top 20 % of keys),
# as an aggregate expression so it combines with other totals in one pass
def top_share(is_top: Column, value: Column) -> Column:
    return F.sum(F.when(is_top, value).otherwise(F.lit(0))) / F.sum(value)
