"""The sales reports (R1-R6) over the sales model.

Inputs follow the model schema (``shopstat.schemas``): ``orders`` has
order_id, customer_id, product_id, quantity, order_date; ``products`` has
product_id, category, price; ``customers`` has customer_id, country.

Conventions fixed for every report:

* money is summed as decimals and rounded to cents at the end, growth to 6 decimals;
* descending sorts put nulls last and break ties on the key, so top-k is repeatable;
* unmatched products keep their units and contribute a null revenue.

Plan notes (what each report shuffles):

* ``top_customers_by_revenue`` — line-level join with products, partial aggregate
  per customer, one shuffle of (customer_id, 2 sums), ``TakeOrderedAndProject``.
* ``sales_by_category`` — aggregates units per product *before* the join
  (revenue = price x units is exact per product), so the product join sees one row
  per product instead of one per order line.
* ``monthly_trends`` — groups on the month's first day (a date), formats the
  label on the ~dozens of aggregated rows; the lag window runs on that small result.
* ``sales_by_country`` — aggregates per customer first, then joins customers
  (customer-sized, not order-sized) and re-aggregates per country.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstat.functions.exprs import growth_pct, month_label, month_start, revenue
from shopstat.operators.aggregates import money, money_sum, revenue_and_units, revenue_zero_fill
from shopstat.operators.joins import attach_country, enrich_orders

GROWTH_DIGITS = 6


# R1 — top N customers by revenue
def top_customers_by_revenue(orders: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    per_customer = customer_revenue(orders, products)
    return per_customer.orderBy(F.desc_nulls_last("total_revenue"), F.asc("customer_id")).limit(n)


def customer_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and units per customer (no limit): the shared input of R1 and R4."""
    return customer_revenue_of(enrich_orders(orders.select("customer_id", "product_id", "quantity"), products))


def customer_revenue_of(enriched: DataFrame) -> DataFrame:
    agg = revenue_and_units(enriched, ["customer_id"], "total_revenue", "units_purchased")
    return agg.select("customer_id", money("total_revenue").alias("total_revenue"), "units_purchased")


# R2 — revenue and units per product category (null category = unmatched products)
def sales_by_category(orders: DataFrame, products: DataFrame) -> DataFrame:
    per_product = orders.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    joined = per_product.join(products.select("product_id", "category", "price"), "product_id", "left")
    agg = joined.groupBy("category").agg(
        F.sum(revenue(F.col("price").cast("decimal(18,6)"), F.col("units").cast("decimal(19,0)"))).alias("total_revenue"),
        F.sum("units").alias("units_sold"),
    )
    return agg.select("category", money("total_revenue").alias("total_revenue"), "units_sold") \
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("category"))


# R3 — month-over-month revenue trend. Months without orders are not filled: the
# "previous month" is the previous month present. Rows without an order date form a
# null month, which comes last and is nobody's predecessor and has none.
def monthly_trends(orders: DataFrame, products: DataFrame) -> DataFrame:
    enriched = enrich_orders(orders.select("product_id", "quantity", "order_date"), products, ("price",))
    by_month = enriched.groupBy(month_start("order_date").alias("month_start")).agg(
        money(money_sum("revenue")).alias("month_revenue")
    )
    return month_trend(by_month)


def month_trend(by_month: DataFrame) -> DataFrame:
    """(month_start, month_revenue) -> the trend. One row per month: an unpartitioned
    window over this result is bounded by the number of distinct months, not by the data."""
    previous = F.lag("month_revenue").over(Window.orderBy(F.asc_nulls_last("month_start")))
    with_prev = by_month.withColumn("previous_month_revenue", F.when(F.col("month_start").isNotNull(), previous))
    return with_prev.select(
        month_label("month_start").alias("month"),
        "month_revenue",
        "previous_month_revenue",
        F.round(growth_pct("month_revenue", "previous_month_revenue"), GROWTH_DIGITS).alias("revenue_growth_pct"),
    ).orderBy(F.asc_nulls_last("month"))


# R4 — revenue and units per customer country (unknown customer -> null country)
def sales_by_country(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    enriched = enrich_orders(orders.select("customer_id", "product_id", "quantity"), products)
    per_customer = revenue_and_units(enriched, ["customer_id"], "revenue", "units")
    return country_rollup(per_customer, customers)


def country_rollup(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Per-customer (revenue, units) -> per-country totals. Sums of per-customer sums
    equal the line-level sums (an all-null customer stays null and is skipped)."""
    return country_totals(per_customer, customers).orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("country"))


def country_totals(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """The rows of ``country_rollup``, in no order."""
    agg = attach_country(per_customer, customers).groupBy("country").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("units").alias("units_sold")
    )
    return agg.select("country", money("total_revenue").alias("total_revenue"), "units_sold")


# R5 — top N customers with pandas null rules (null customer dropped, all-null -> 0.0)
def top_customers_zero_fill(orders: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    enriched = enrich_orders(orders.select("customer_id", "product_id", "quantity"), products)
    agg = revenue_zero_fill(enriched, "customer_id")
    return agg.select("customer_id", money("total_revenue").alias("total_revenue")) \
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc("customer_id")).limit(n)


# R6 — top N customers by revenue only
def top_customers_revenue_only(orders: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    enriched = enrich_orders(orders.select("customer_id", "product_id", "quantity"), products)
    agg = enriched.groupBy("customer_id").agg(money(money_sum("revenue")).alias("total_revenue"))
    return agg.orderBy(F.desc_nulls_last("total_revenue"), F.asc("customer_id")).limit(n)
