"""S11 — the report-writing job: all four reports, written as Parquet datasets.

Instead of joining the order lines three or four times (once per report), the job
scans and joins them once and computes every report's first aggregation in one
pass with GROUPING SETS ((customer_id), (category), (month_start)). That
aggregate (customers + categories + months rows) is written to the shared folder,
partitioned by grouping set, so that each report reads its own part alone and none
reads the order lines again; it is deleted when the reports are written.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstat.functions.exprs import month_start
from shopstat.operators.aggregates import money, money_sum
from shopstat.operators.joins import enrich_orders
from shopstat.operators.reports import country_rollup, country_totals, month_trend
from shopstat.session import discard, stored
from shopstat.sources.bucketed import open_bucketed
from shopstat.sources.files import save_together
from shopstat.sources.tables import load_parquet_nanos

# Dataset names of the stored reports (they differ from the function names for two of them).
OUTPUT_NAMES = {
    "sales_by_category": "revenue_by_category",
    "top_customers": "top_customers",
    "monthly_trends": "monthly_sales",
    "sales_by_country": "sales_by_country",
}

# grouping_id() values for grouping sets over (customer_id, category, month_start):
# a bit is set for every column NOT in the set.
_GID_CUSTOMER, _GID_CATEGORY, _GID_MONTH = 0b011, 0b101, 0b110


def shared_aggregate(orders: DataFrame, products: DataFrame) -> DataFrame:
    return enriched_aggregate(enrich_orders(orders.select("customer_id", "product_id", "quantity", "order_date"), products))


def enriched_aggregate(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("month_start", month_start("order_date")).groupingSets(
        [["customer_id"], ["category"], ["month_start"]], "customer_id", "category", "month_start"
    ).agg(
        money_sum("revenue").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.grouping_id().alias("gid"),
    )


def stored_aggregate(orders: DataFrame, products: DataFrame) -> tuple[DataFrame, str]:
    """The shared aggregate in a scratch table of one folder per grouping set, and its path."""
    return stored(shared_aggregate(orders, products), "report-aggregate", ("gid",))


def _per_customer(agg: DataFrame) -> DataFrame:
    return agg.filter(F.col("gid") == _GID_CUSTOMER).select("customer_id", "revenue", "units")


def _per_category(agg: DataFrame) -> DataFrame:
    return agg.filter(F.col("gid") == _GID_CATEGORY).select(
        "category", money("revenue").alias("total_revenue"), F.col("units").alias("units_sold"))


def long_report(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """U1 — categories and countries as one table (dimension, member, total_revenue,
    units_sold), from one pass over the order lines."""
    agg, _ = stored_aggregate(orders, products)
    by_category = _per_category(agg).withColumnRenamed("category", "member")
    by_country = country_totals(_per_customer(agg), customers).withColumnRenamed("country", "member")
    both = [part.select(F.lit(name).alias("dimension"), "member", "total_revenue", "units_sold")
            for name, part in (("category", by_category), ("country", by_country))]
    return both[0].unionByName(both[1])


def reports_from_aggregate(agg: DataFrame, customers: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    per_customer = _per_customer(agg)

    top = per_customer.select(
        "customer_id", money("revenue").alias("total_revenue"), F.col("units").alias("units_purchased")
    ).orderBy(F.desc_nulls_last("total_revenue"), F.asc("customer_id")).limit(n)

    category = _per_category(agg).orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("category"))

    monthly = month_trend(agg.filter(F.col("gid") == _GID_MONTH).select(
        "month_start", money("revenue").alias("month_revenue")))

    country = country_rollup(per_customer, customers)
    return {"top_customers": top, "sales_by_category": category,
            "monthly_trends": monthly, "sales_by_country": country}


def write_reports(orders: DataFrame, products: DataFrame, customers: DataFrame,
                  processed_dir: str, n: int = 10) -> dict[str, str]:
    """Compute the four reports and write them under ``processed_dir``; returns the paths."""
    return _write_reports_of(shared_aggregate(orders, products), customers, processed_dir, n)


def run_bucketed(spark: SparkSession, model_dir: str, processed_dir: str, n: int = 10) -> dict[str, str]:
    """The four reports over a stored bucketed model: no order line passes an exchange."""
    model = open_bucketed(spark, model_dir)
    return _write_reports_of(enriched_aggregate(model.enriched()), model.customers, processed_dir, n)


def _write_reports_of(aggregate: DataFrame, customers: DataFrame, processed_dir: str, n: int) -> dict[str, str]:
    spark = aggregate.sparkSession
    agg, scratch = stored(aggregate, "report-aggregate", ("gid",))
    paths = {name: os.path.join(str(processed_dir), f"{OUTPUT_NAMES[name]}.parquet") for name in OUTPUT_NAMES}

    # The reports are small (bounded by customers/categories/months); one file each. They take
    # their places together when all four are whole.
    reports = reports_from_aggregate(agg, customers, n)
    try:
        save_together({paths[name]: df for name, df in reports.items()}, single_file=True)
    finally:
        discard(spark, scratch)
    return paths


def run_analytics(spark: SparkSession, raw_dir: str, processed_dir: str, n: int = 10) -> dict[str, str]:
    """Read customers/products/orders Parquet from ``raw_dir`` and write the four reports.

    Accepts both Spark-written tables and pandas/pyarrow-written ones (int32 keys,
    int16 quantities, nanosecond timestamps)."""
    raw_dir = str(raw_dir)
    # Files written by pandas/pyarrow carry nanosecond timestamps: normalise on load.
    orders = load_parquet_nanos(spark, os.path.join(raw_dir, "orders.parquet")).select(
        F.col("order_id").cast("long"), F.col("customer_id").cast("long"),
        F.col("product_id").cast("long"), F.col("quantity").cast("smallint"),
        F.col("order_date").cast("timestamp_ntz"),
    )
    products = spark.read.parquet(os.path.join(raw_dir, "products.parquet")).select(
        F.col("product_id").cast("long"), "category", F.col("price").cast("double"),
    )
    customers = load_parquet_nanos(spark, os.path.join(raw_dir, "customers.parquet")).select(
        F.col("customer_id").cast("long"), "country",
    )
    return write_reports(orders, products, customers, processed_dir, n)
