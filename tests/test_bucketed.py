"""The bucketed model: no exchange of order lines, hot and missing keys apart, whole or not there."""
from __future__ import annotations

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopstat.__main__ import main
from shopstat.operators import reports as R
from shopstat.operators.joins import enrich_orders
from shopstat.plans import analytics_job
from shopstat.sources import bucketed


@pytest.fixture()
def raw(spark, tmp_dir):
    """8,000 lines: a third of product 1, some without a product, some of a product that is not listed."""
    place = os.path.join(tmp_dir, "raw")
    product = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 211 + 2)
    spark.range(8000).select(F.col("id").alias("order_id"), (F.col("id") % 97).alias("customer_id"), product.alias("product_id"), (F.col("id") % 9 + 1).cast("smallint").alias("quantity"),
                             F.expr("timestamp_ntz '2024-01-15 10:00:00' + make_interval(0, cast(id % 5 as int))").alias("order_date")).write.parquet(f"{place}/orders.parquet")
    pd.DataFrame({"product_id": range(1, 200), "name": "x", "category": [f"c{i % 4}" for i in range(199)], "price": [i / 7 for i in range(199)]}).to_parquet(f"{place}/products.parquet", index=False)
    pd.DataFrame({"customer_id": range(97), "country": [f"l{i % 5}" for i in range(97)]}).to_parquet(f"{place}/customers.parquet", index=False)
    return place


def _raw_frames(spark, raw):
    return spark.read.parquet(f"{raw}/orders.parquet"), spark.read.parquet(f"{raw}/products.parquet")


def test_same_rows_as_the_plain_join(spark, raw, tmp_dir):
    made = bucketed.open_bucketed(spark, bucketed.bucket_model(spark, raw, os.path.join(tmp_dir, "made"), buckets=8))
    plain, got = enrich_orders(*_raw_frames(spark, raw)), made.enriched()
    assert got.count() == 8000
    names = ["order_id", "customer_id", "product_id", "quantity", "order_date", "category", "price", "revenue"]
    assert got.select(*names).exceptAll(plain.select(*names)).count() == 0
    assert [r.product_id for r in made.apart_products.collect()] == [1]
    assert {r.product_id for r in made.apart.select("product_id").distinct().collect()} == {None, 1}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("shopstat_")]


def test_no_exchange_of_order_lines(spark, raw, tmp_dir):
    made = bucketed.open_bucketed(spark, bucketed.bucket_model(spark, raw, os.path.join(tmp_dir, "made"), buckets=8))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = enrich_orders(made.lines, made.products)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in joined and "Exchange" not in joined and "Bucketed: true" in joined
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        for report in (R.customer_revenue_of(made.enriched()), analytics_job.enriched_aggregate(made.enriched())):
            exchanges = [x for x in report._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
            # partial sums by the report's keys alone
            assert exchanges and not any("product_id" in x for x in exchanges)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_bucket_holds_one_file_and_no_hot_product(spark, raw, tmp_dir):
    place = bucketed.bucket_model(spark, raw, os.path.join(tmp_dir, "made"), buckets=8)
    sizes = spark.read.parquet(f"{place}/lines").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) <= 8 and max(r["count"] for r in sizes) < 2 * 8000 / 8


def test_a_failed_rewrite_leaves_the_old_model(spark, raw, tmp_dir):
    place = bucketed.bucket_model(spark, raw, os.path.join(tmp_dir, "made"), buckets=4)
    with pytest.raises(Exception):
        bucketed.bucket_model(spark, os.path.join(tmp_dir, "nowhere"), place)
    broken = os.path.join(tmp_dir, "broken")
    for name in ("orders", "products"):
        spark.read.parquet(f"{raw}/{name}.parquet").write.parquet(f"{broken}/{name}.parquet")
    pd.DataFrame({"customer_id": ["a"], "country": ["l"]}).to_parquet(f"{broken}/customers.parquet", index=False)
    with pytest.raises(Exception):  # the customers are the last but one to be written
        bucketed.bucket_model(spark, broken, place)
    assert bucketed.open_bucketed(spark, place).enriched().count() == 8000
    assert [n for n in os.listdir(tmp_dir) if n.startswith("_")] == []
    bucketed.bucket_model(spark, raw, place, buckets=3)
    assert bucketed.open_bucketed(spark, place).enriched().count() == 8000


def test_empty_model(spark, tmp_dir):
    place = os.path.join(tmp_dir, "empty")
    for name, schema in (("orders", bucketed.LINES), ("products", bucketed.PRODUCTS), ("customers", bucketed.CUSTOMERS)):
        spark.createDataFrame([], schema).write.parquet(f"{place}/{name}.parquet")
    made = bucketed.open_bucketed(spark, bucketed.bucket_model(spark, place, os.path.join(tmp_dir, "made")))
    assert made.enriched().count() == 0


def test_command_line(spark, raw, tmp_dir, capsys):
    made, first, second = (os.path.join(tmp_dir, n) for n in ("made", "first", "second"))
    main(["bucket", "--raw", raw, "--out", made, "--buckets", "4"], spark)
    main(["analytics", "--bucketed", made, "--processed", first], spark)
    main(["analytics", "--raw", raw, "--processed", second], spark)
    capsys.readouterr()
    for name in analytics_job.OUTPUT_NAMES.values():
        a, b = (spark.read.parquet(f"{place}/{name}.parquet") for place in (first, second))
        assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 0
