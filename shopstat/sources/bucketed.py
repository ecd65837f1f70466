"""The sales model stored so that its join needs no exchange (J1 at scale).

Order lines and products are bucketed by product key and sorted inside a bucket (lines by product
and order key), with the same number of buckets. A report over the model joins them bucket by
bucket: the lines are shuffled once, when the model is stored, and by no report.

A bucket is read by one task, so no product may fill it. Products with more lines than an even
bucket holds (fewer than there are buckets, so a list of bounded size) are kept apart: their lines, and lines
without a product key, stay in ordinary files of any number, and join the short list of these
products, which the planner broadcasts by its stored size.

The model takes its place by one rename when it is whole. Bucketing is known to the catalogue
alone, so a table is declared for as long as it takes to write or to open it, and dropped again
(its files stay): nothing is left in the catalogue, and any session can open the folder.
"""
from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstat.operators.joins import enrich_orders
from shopstat.session import discard, stored
from shopstat.sources.files import staged_together
from shopstat.sources.storage import stored_bytes_value
from shopstat.sources.tables import load_parquet_nanos

#: Bytes of stored order lines a bucket is meant to hold.
BUCKET_BYTES = 128 << 20

LINES = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()), T.StructField("product_id", T.LongType()),
                      T.StructField("quantity", T.ShortType()), T.StructField("order_date", T.TimestampNTZType())])
PRODUCTS = T.StructType([T.StructField("product_id", T.LongType()), T.StructField("category", T.StringType()), T.StructField("price", T.DoubleType())])
CUSTOMERS = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("country", T.StringType())])
LAYOUT = T.StructType([T.StructField("buckets", T.LongType())])
#: Bucketed tables of the model: schema and order inside a bucket.
BUCKETED = {"lines": (LINES, ("product_id", "order_id")), "products": (PRODUCTS, ("product_id",))}


@dataclass(frozen=True)
class BucketedModel:
    """An opened model. ``lines`` and ``products`` are bucketed; ``apart`` holds the lines of the
    products in ``apart_products`` and those without a product key."""

    lines: DataFrame
    products: DataFrame
    apart: DataFrame
    apart_products: DataFrame
    customers: DataFrame

    def enriched(self) -> DataFrame:
        """J1 + P1 over all order lines; the lines pass no exchange."""
        return enrich_orders(self.lines, self.products).unionByName(enrich_orders(self.apart, self.apart_products))


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _temporary_table(spark: SparkSession):
    name = f"shopstat_{uuid.uuid4().hex}"
    return name, lambda: spark.sql(f"DROP TABLE IF EXISTS {name}")


def _write_bucketed(df: DataFrame, path: str, buckets: int, order: tuple[str, ...]) -> None:
    name, drop = _temporary_table(df.sparkSession)
    # The exchange deals rows as the buckets do: one file a bucket.
    dealt = df.repartition(buckets, "product_id")
    try:
        dealt.write.format("parquet").option("path", path).bucketBy(buckets, "product_id").sortBy(*order).saveAsTable(name)
    finally:
        drop()


def _read_bucketed(spark: SparkSession, path: str, buckets: int, schema: T.StructType, order: tuple[str, ...]) -> DataFrame:
    name, drop = _temporary_table(spark)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = str(path).replace("\\", "\\\\").replace("'", "\\'")
    try:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (product_id) SORTED BY ({', '.join(order)}) "
                  f"INTO {buckets} BUCKETS LOCATION '{place}'")
        return spark.table(name)
    finally:
        drop()


def bucket_model(spark: SparkSession, raw_dir: str, out_dir: str, buckets: int | None = None) -> str:
    """Store the raw model in ``raw_dir`` (orders, products and customers as Parquet) as a bucketed
    one in ``out_dir``; what was there stays until the new one is whole. ``buckets``: by the stored
    size of the lines if not given, and no fewer than the session's shuffle partitions."""
    raw_dir = str(raw_dir)
    orders_path = os.path.join(raw_dir, "orders.parquet")
    orders = _typed(load_parquet_nanos(spark, orders_path), LINES)
    products = _typed(spark.read.parquet(os.path.join(raw_dir, "products.parquet")), PRODUCTS)
    customers = _typed(load_parquet_nanos(spark, os.path.join(raw_dir, "customers.parquet")), CUSTOMERS)
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200") or 200), -(-stored_bytes_value(spark, orders_path) // BUCKET_BYTES))
    keyed = orders.filter("product_id IS NOT NULL")
    even = keyed.count() // buckets
    # More than an even bucket each: at most as many products as buckets. Written first, so that the planner knows the size.
    heavy, scratch = stored(keyed.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > even).select("product_id"), "heavy-products")
    heavy_lines = orders.join(heavy, "product_id", "left_semi").unionByName(orders.filter("product_id IS NULL"))
    with_key = products.filter("product_id IS NOT NULL")
    try:
        with staged_together(spark, [str(out_dir)]) as staged:
            at = staged[str(out_dir)]
            _write_bucketed(keyed.join(heavy, "product_id", "left_anti").select(*LINES.names), f"{at}/lines", buckets, BUCKETED["lines"][1])
            _write_bucketed(with_key, f"{at}/products", buckets, BUCKETED["products"][1])
            heavy_lines.select(*LINES.names).write.parquet(f"{at}/apart")
            with_key.join(heavy, "product_id", "left_semi").select(*PRODUCTS.names).write.parquet(f"{at}/apart_products")
            customers.write.parquet(f"{at}/customers")
            spark.createDataFrame([(buckets,)], LAYOUT).coalesce(1).write.parquet(f"{at}/layout")
    finally:
        discard(spark, scratch)
    return str(out_dir)


def open_bucketed(spark: SparkSession, path: str) -> BucketedModel:
    path = str(path)
    buckets = spark.read.schema(LAYOUT).parquet(f"{path}/layout").first()["buckets"]
    lines, products = (_read_bucketed(spark, f"{path}/{name}", buckets, schema, order) for name, (schema, order) in BUCKETED.items())
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}")
    return BucketedModel(lines, products, read("apart", LINES), read("apart_products", PRODUCTS), read("customers", CUSTOMERS))
