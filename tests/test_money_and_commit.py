"""Exact sums in longs, the null-safe join, bags, malformed CSV records and staged writes."""
from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstat.operators.aggregates import money_sum
from shopstat.operators.compare import reconcile_bags
from shopstat.operators.joins import enrich_orders_null_safe
from shopstat.sources.files import read_csv, read_csv_set_aside, save_parquet, save_together


def _total(spark, values, parts=1):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(parts).agg(money_sum("x").alias("s")).first().s


def test_money_is_exact_for_any_partitioning(spark):
    values = [0.1, 0.2, -0.3, 1e12 + 0.25, -1e12, 19.99, -0.000001, 123456.789012] * 50
    want = sum(Decimal(repr(v)).quantize(Decimal("0.000001")) for v in values)
    assert [_total(spark, values, n) for n in (1, 3, 8)] == [want] * 3
    assert _total(spark, [None, None]) is None and _total(spark, [None, -2.5]) == Decimal("-2.5")
    assert _total(spark, [9e14, 9e14, 0.01]) == Decimal("1800000000000000.01")


def test_money_beyond_the_range_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)overflow"):
        _total(spark, [9e18, 9e18])


def test_null_keys_meet_null_keys(spark):
    orders = spark.createDataFrame([(1, None, 2), (2, 7, 1), (3, 8, 1), (4, None, 3)], "order_id long, product_id long, quantity int")
    products = spark.createDataFrame([(7, "a", 1.0), (None, "n", 2.0), (None, "m", 3.0)], "product_id long, category string, price double")
    got = [(r.order_id, r.product_id, r.category, r.revenue) for r in enrich_orders_null_safe(orders, products).collect()]
    assert sorted(got, key=str) == sorted([(1, None, "n", 4.0), (1, None, "m", 6.0), (2, 7, "a", 1.0), (3, 8, None, None), (4, None, "n", 6.0), (4, None, "m", 9.0)], key=str)
    none = enrich_orders_null_safe(orders, products.filter("product_id IS NOT NULL"))
    assert none.filter("product_id IS NULL AND category IS NULL").count() == 2


def test_null_keyed_rows_keep_tasks_of_their_own(spark):
    """Few bytes, but each row meets every product without a key: not merged into a task or two by their bytes."""
    orders = spark.range(20_000).select(F.col("id").alias("order_id"), F.lit(None).cast("long").alias("product_id"), F.lit(1).alias("quantity"))
    products = spark.createDataFrame([(None, "n", 2.0), (None, "m", 3.0)], "product_id long, category string, price double")
    joined = enrich_orders_null_safe(orders.repartition("order_id"), products)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and len(sizes) > 20 and max(sizes) < 10_000


def test_products_without_a_key_are_met_in_blocks(spark):
    """A line alone meets all of them: not in one task, also if they are equal, and their copies are not broadcast by the size of one."""
    orders = spark.createDataFrame([(1, None, 2)], "order_id long, product_id long, quantity int")
    for kinds in (20_000, 1):
        products = spark.range(20_000).select(F.lit(None).cast("long").alias("product_id"), (F.col("id") % kinds).cast("string").alias("category"),
                                              (F.col("id") % kinds * 0.5).alias("price"))
        joined = enrich_orders_null_safe(orders, products)
        assert "SortMergeJoin [_part" in joined._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 15_000
        assert joined.groupBy("category", "price", "revenue").count().filter(f"count <> {20_000 // kinds} OR revenue <> 2 * price").count() == 0
        assert joined.select("category").distinct().count() == kinds


def test_null_keyed_rows_are_spread(spark):
    orders = spark.range(20_000).select(F.col("id").alias("order_id"), F.lit(None).cast("long").alias("product_id"), F.lit(1).alias("quantity"))
    products = spark.createDataFrame([(None, "n", 2.0)], "product_id long, category string, price double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = enrich_orders_null_safe(orders, products)
        assert "CartesianProduct" not in joined._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


def test_bags_count_repeated_keys(spark):
    left = [(1, 5.0), (1, 5.0), (1, 6.0), (2, None), (3, 1.0), (None, 1.0)]
    right = [(1, 5.0), (1, 6.0), (2, None), (4, 1.0), (None, 1.0), (None, 1.0)]
    df = lambda rows: spark.createDataFrame(rows, "k long, v double")
    got = {(r.k, r.v): (r.left_count, r.right_count, r.status) for r in reconcile_bags(df(left), df(right), ["k"], ["v"]).collect()}
    a, b = Counter(left), Counter(right)
    status = lambda x, y: "match" if x == y else "left_only" if not y else "right_only" if not x else "differ"
    assert got == {key: (a[key], b[key], status(a[key], b[key])) for key in a | b}


def test_malformed_records_are_set_aside_and_never_nulled(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in.csv")
    with open(path, "w") as f:
        f.write("a,b,c\n1,x,2.5\n2,y,oops\n3,z\n,w,\n4,v,1.0,9\n5,u,7\n")
    schema = T.StructType.fromDDL("a int, b string, c double")
    good, bad = read_csv_set_aside(spark, path, schema)
    assert [tuple(r) for r in good.orderBy("b").collect()] == [(5, "u", 7.0), (None, "w", None), (1, "x", 2.5)]
    assert sorted(r.record for r in bad.collect()) == ["2,y,oops", "3,z", "4,v,1.0,9"] and good.count() + bad.count() == 6
    assert good.schema == schema and {os.path.basename(r.file) for r in bad.collect()} == {"in.csv"}
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, path, schema).collect()


def test_a_write_that_fails_leaves_the_old_datasets(spark, tmp_dir):
    paths = [os.path.join(tmp_dir, f"report{i}.parquet") for i in range(4)]
    save_together({p: spark.range(3) for p in paths}, single_file=True)
    broken = spark.range(3).select(F.raise_error(F.lit("broken on purpose")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken on purpose"):
        save_together({p: spark.range(9) for p in paths[:3]} | {paths[3]: broken}, single_file=True)
    assert [spark.read.parquet(p).count() for p in paths] == [3] * 4
    save_parquet(spark.range(5), paths[0])
    assert spark.read.parquet(paths[0]).count() == 5
    assert sorted(os.listdir(tmp_dir)) == [os.path.basename(p) for p in paths] and len(glob.glob(paths[1] + "/*.parquet")) == 1


def test_a_dataset_may_be_replaced_by_what_is_read_from_it(spark, tmp_dir):
    path = save_parquet(spark.range(4), os.path.join(tmp_dir, "own.parquet"))
    save_parquet(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 3
