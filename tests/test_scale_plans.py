"""The plans a large cluster gets: no dimension fits the broadcast threshold, so
every join is a shuffle join, and one customer and one product each hold a third
of the order lines. Results must equal a brute-force computation."""
from __future__ import annotations

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopstat import schemas
from shopstat.operators import reports as R
from shopstat.plans import analytics_job

N = 30_000
NULL = "<null>"


@contextlib.contextmanager
def no_auto_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(N)
    orders = ids.select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500 + 2).cast("long").alias("customer_id"),
        F.when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id") % 60 + 1).cast("long").alias("product_id"),
        (F.col("id") % 10 + 1).cast("smallint").alias("quantity"),
        (F.lit(dt.datetime(2023, 1, 1)).cast("timestamp_ntz")
         + F.make_dt_interval((F.col("id") % 700).cast("int"))).alias("order_date"),
    )
    # products 1..50 only: 51..61 are unknown products (null category / revenue)
    products = spark.range(1, 51).select(
        F.col("id").alias("product_id"), F.concat(F.lit("p"), F.col("id")).alias("name"),
        F.element_at(F.array(*[F.lit(c) for c in ["Books", "Home", "Sports"]]),
                     (F.col("id") % 3 + 1).cast("int")).alias("category"),
        (F.col("id") * 1.25).alias("price"))
    customers = spark.range(1, 400).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("c"), F.col("id")).alias("name"),
        F.concat(F.lit("country-"), (F.col("id") % 7)).alias("country"))
    assert [(f.name, f.dataType) for f in orders.schema] == [(f.name, f.dataType) for f in schemas.ORDERS]
    return orders, products, customers


def _brute(orders, products, customers):
    o, p, c = orders.toPandas(), products.toPandas(), customers.toPandas()
    e = o.merge(p, on="product_id", how="left")
    e["revenue"] = e["price"] * e["quantity"]
    return e, c


def _sum(s):
    return round(s.sum(min_count=1), 2) if s.notna().any() else None


def test_reports_with_shuffle_joins_and_hot_keys(spark, skewed):
    orders, products, customers = skewed
    e, c = _brute(orders, products, customers)
    with no_auto_broadcast(spark):
        top = R.top_customers_by_revenue(orders, products)
        plan = top._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        got_top = [tuple(r) for r in top.collect()]
        got_cat = {r.category: (r.total_revenue, r.units_sold) for r in R.sales_by_category(orders, products).collect()}
        got_cty = {r.country: (r.total_revenue, r.units_sold)
                   for r in R.sales_by_country(orders, products, customers).collect()}
        got_month = {r.month: r.month_revenue for r in R.monthly_trends(orders, products).collect()}

    per_c = e.groupby("customer_id").agg(rev=("revenue", _sum), units=("quantity", "sum")).reset_index()
    per_c["key"] = per_c["rev"].fillna(float("-inf"))
    per_c = per_c.sort_values(["key", "customer_id"], ascending=[False, True]).head(10)
    assert got_top == [(int(r.customer_id), r.rev, int(r.units)) for r in per_c.itertuples()]

    exp_cat = {(None if k == NULL else k): (_sum(g["revenue"]), int(g["quantity"].sum()))
               for k, g in e.groupby(e["category"].fillna(NULL))}
    assert got_cat == exp_cat

    ec = e.merge(c[["customer_id", "country"]], on="customer_id", how="left")
    exp_cty = {(None if k == NULL else k): (_sum(g["revenue"]), int(g["quantity"].sum()))
               for k, g in ec.groupby(ec["country"].fillna(NULL))}
    assert got_cty == exp_cty

    e["month"] = e["order_date"].dt.strftime("%Y-%m")
    assert got_month == {k: _sum(g["revenue"]) for k, g in e.groupby("month")}


def test_report_job_with_shuffle_joins(spark, skewed, tmp_dir):
    orders, products, customers = skewed
    with no_auto_broadcast(spark):
        paths = analytics_job.write_reports(orders, products, customers, tmp_dir)
        direct = R.top_customers_by_revenue(orders, products).collect()
    assert spark.read.parquet(paths["top_customers"]).orderBy(
        F.desc_nulls_last("total_revenue"), "customer_id").collect() == direct
