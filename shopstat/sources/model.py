"""The sales model (orders, products, customers) over the driver's TPC-H-like tables.

    orders    = lineitem JOIN orders ON l_orderkey = o_orderkey
                -> order_id, customer_id, product_id, quantity (smallint), order_date
    products  = part -> product_id, name, category (p_type), price (p_retailprice)
    customers = customer LEFT JOIN nation -> customer_id, name, country (n_name)

Only the columns a report needs survive column pruning, so reading through the
model costs no more than reading the raw tables.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstat.schemas import DRIVER_TABLES
from shopstat.sources.tables import load_parquet, table_path


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read with its declared schema (no footer inference at
    construction; a file whose types differ fails at scan time)."""
    return load_parquet(spark, table_path(sf_dir, name), DRIVER_TABLES.get(name))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = raw(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Both sides are fact-sized: a shuffle join on the order key (no hint; AQE may
    # still pick a broadcast at run time when one side turns out small).
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("smallint").alias("quantity"),
        F.col("o_orderdate").alias("order_date"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = raw(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = raw(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("country"),
    )


def write_model(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """Materialise the sales model once, in the raw layout the report job reads
    (``orders.parquet``, ``products.parquet``, ``customers.parquet``), so repeated
    report runs skip the order-line join. One file per partition; overwrite in place."""
    frames = {"orders": orders(spark, sf_dir), "products": products(spark, sf_dir),
              "customers": customers(spark, sf_dir)}
    paths = {}
    for name, df in frames.items():
        paths[name] = os.path.join(str(out_dir), f"{name}.parquet")
        df.write.mode("overwrite").parquet(paths[name])
    return paths
