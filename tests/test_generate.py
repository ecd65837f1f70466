"""Generated tables: the reference's sizes and types, invariants, and the same
rows for any partitioning or chunk size."""
from __future__ import annotations

import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstat.functions import random as rnd
from shopstat.plans import generate as G


def test_generate_all_small(spark, tmp_dir):
    paths = G.generate_all(spark, tmp_dir, n_customers=1000, n_products=200, n_orders=5000, seed=123)
    c = spark.read.parquet(paths["customers"])
    p = spark.read.parquet(paths["products"])
    o = spark.read.parquet(paths["orders"])
    assert (c.count(), p.count(), o.count()) == (1000, 200, 5000)
    assert dict(o.dtypes) == {"order_id": "bigint", "customer_id": "bigint", "product_id": "bigint",
                              "quantity": "smallint", "order_date": "timestamp_ntz"}
    assert o.select("order_id").distinct().count() == 5000
    assert o.agg(F.min("order_id"), F.max("order_id")).first() == (1, 5000)
    assert o.join(c, "customer_id", "left_anti").count() == 0
    assert o.join(p, "product_id", "left_anti").count() == 0
    assert o.filter(~F.col("quantity").between(1, 10)).count() == 0
    late = o.join(c, "customer_id").filter(F.col("order_date") < F.col("registration_date")).count()
    assert late == 0
    as_of_end = dt.datetime.combine(G.DEFAULT_AS_OF + dt.timedelta(days=1), dt.time())
    assert o.filter(F.col("order_date") >= F.lit(as_of_end)).count() == 0
    # 80/20: the 200 heaviest customers hold about 80 % of the orders
    per = o.groupBy("customer_id").count().orderBy(F.desc("count")).limit(200).agg(F.sum("count")).first()[0]
    assert 0.78 <= per / 5000 <= 0.85
    assert set(r.category for r in p.select("category").distinct().collect()) <= set(G.CATEGORIES)
    assert c.filter(~F.col("age").between(18, 90) | ~F.col("email").contains("@")).count() == 0
    assert p.filter(~F.col("rating").between(1.0, 5.0) | ~F.col("price").between(10.0, 500.0)).count() == 0


def test_same_rows_for_any_partitioning(spark):
    keys2 = spark.range(1, 2001, numPartitions=2).withColumnRenamed("id", "customer_id")
    keys7 = spark.range(1, 2001, numPartitions=7).withColumnRenamed("id", "customer_id")
    a, b = G.customers_for_keys(keys2), G.customers_for_keys(keys7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_orders_independent_of_chunking_and_partitions(spark):
    customers = G.customers_for_keys(spark.range(1, 301).withColumnRenamed("id", "customer_id"))
    big = G.orders_for_customers(customers, 4000, 50, chunk_rows=100_000, num_partitions=2)
    small = G.orders_for_customers(customers.repartition(5), 4000, 50, chunk_rows=7, num_partitions=6)
    assert big.count() == 4000
    assert big.exceptAll(small).count() == 0 and small.exceptAll(big).count() == 0


def test_hash_columns_equal_single_expression(spark):
    # keys beyond 2^31 and negative keys too
    df = spark.range(-1500, 1500).select((F.col("id") * 1_000_003_000).alias("k"))
    staged = rnd.with_hashes(df, "k", 42, {"h1": 1, "h9": 9})
    direct = df.select("k", rnd.hash53("k", 42, 1).alias("h1"), rnd.hash53("k", 42, 9).alias("h9"))
    assert staged.exceptAll(direct).count() == 0


def test_distributions(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"))
    h = rnd.with_hashes(df, "k", 7, {"a": 1, "b": 2, "c": 3})
    u = rnd.unit(F.col("a"))
    stats = h.select(
        u.alias("u"),
        rnd.normal(u, rnd.unit(F.col("b")), 35.0, 10.0).alias("n"),
        rnd.poisson(rnd.unit(F.col("c")), 50.0).alias("p"),
        rnd.uniform_int(u, 1, 11).alias("i"),
    ).agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("n"), F.stddev("n"), F.avg("p"), F.variance("p"),
          F.min("i"), F.max("i")).first()
    assert 0 < stats[0] and stats[1] < 1 and abs(stats[2] - 0.5) < 0.01
    assert abs(stats[3] - 35) < 0.3 and abs(stats[4] - 10) < 0.3
    assert abs(stats[5] - 50) < 0.3 and abs(stats[6] - 50) < 2.0
    assert (stats[7], stats[8]) == (1, 10)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 9_999, 10_000, 100_000, 1_000_000, 500_001, 1_000_002])
def test_permutation_is_a_bijection(spark, n):
    ids = G.permuted(spark.range(n).select(F.col("id").alias("pos")), "pos", n, 42)
    assert ids.schema["pos"].dataType == T.LongType()
    assert tuple(ids.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos")).first()) == (n, 0, n - 1)


@pytest.mark.parametrize("n", [10_000, 100_000, 1_000_000, 500_001, 1_000_002])
def test_neighbouring_ids_are_as_if_shuffled(spark, n):
    """Positions cut into 50 customers: neighbours share one about as often as a shuffle would have it."""
    rows = G.permuted(spark.range(n).select((F.col("id") * 50 / n).cast("int").alias("c"), F.col("id").alias("pos")), "pos", n, 42)
    c = np.empty(n, int)
    for r in rows.toPandas().itertuples():
        c[r.pos] = r.c
    for d in (*range(1, 11), 100, 1000):
        assert abs((c[d:] == c[:-d]).mean() - 0.02) < 6 * (0.02 / n) ** 0.5


def test_permutation_of_huge_ranges_stays_in_long(spark):
    n = 10**16 + 7
    got = G.permuted(spark.range(n - 1000, n).select(F.col("id").alias("pos")), "pos", n, 42)
    count, low, high = got.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos")).first()
    assert count == 1000 and 0 <= low < n // 100 and n - n // 100 < high < n
    assert got.filter(F.col("pos") < n).count() == 1000  # a filter that is pushed below the permutation


def test_streams_of_far_keys_and_other_seeds_share_nothing(spark):
    near = spark.range(20_000).select(F.col("id").alias("k"))
    base = rnd.with_hashes(near, "k", 42, {"h": 1, "g": 2})
    assert base.select("h").unionByName(base.select(F.col("g").alias("h"))).distinct().count() == 40_000
    for other, seed in ((near.select((F.col("k") + 2**31 - 1).alias("k")), 42), (near, 43), (near, 42 + 2**31)):
        assert rnd.with_hashes(other, "k", seed, {"h": 1}).join(base.select("h"), "h").count() == 0
    assert base.agg(F.max("h")).first()[0] >= 2**52


def test_negative_keys_give_uniforms_in_range(spark):
    df = spark.range(-5000, 0).select(F.col("id").alias("k"))
    u = rnd.with_hashes(df, "k", 3, {"h": 1}).select(rnd.unit(F.col("h")).alias("u"))
    lo, hi = u.agg(F.min("u"), F.max("u")).first()
    assert 0 < lo and hi < 1


def test_generator_variants_keep_exact_totals(spark):
    customers = G.customers_for_keys(spark.range(1, 201).withColumnRenamed("id", "customer_id"))
    for opts in ({"remainder": "weight"}, {"pareto_offset": 1e-6}, {"top_share": 0.6}):
        o = G.orders_for_customers(customers, 3000, 40, **opts)
        assert o.count() == 3000 and o.select("order_id").distinct().count() == 3000


def test_surplus_is_taken_only_from_keys_that_have_a_unit(spark):
    from shopstat.operators.allocation import skewed_allocation

    keys = spark.range(3001).select(F.col("id").alias("k"), F.when(F.col("id") == 3000, 0.0).otherwise(1.0).alias("w"))
    for total in (2999, 3000, 12_345):
        got = skewed_allocation(keys, "k", F.col("w"), total).agg(F.sum("order_count"), F.min("order_count")).first()
        assert got[0] == total and got[1] >= 0


def test_every_order_column_has_a_draw_of_its_own(spark):
    """Product, quantity, day and second: 53 bits each of the digest of their salts, not parts of one."""
    customers = G.customers_for_keys(spark.range(1, 31).withColumnRenamed("id", "customer_id"))
    registered = {r.customer_id: r.registration_date for r in customers.collect()}

    def u(order_id: int, salt: int) -> float:
        digest = hashlib.md5(f"{G.DEFAULT_SEED}:{salt // 2}:{order_id}".encode()).hexdigest()
        at = salt % 2 * rnd.HEX_DIGITS
        return min(((int(digest[at:at + rnd.HEX_DIGITS], 16) >> 3) + 0.5) / 2.0**53, 1.0 - 2.0**-53)

    rows = G.orders_for_customers(customers, 400, 50).collect()
    assert len(rows) == 400
    for r in rows:
        start = registered[r.customer_id]
        days = (G.DEFAULT_AS_OF - start.date()).days
        assert r.product_id == 1 + int(u(r.order_id, 22) * 50)
        assert r.quantity == 1 + int(u(r.order_id, 23) * 10)
        assert r.order_date == start + dt.timedelta(days=int(u(r.order_id, 24) * (days + 1)), seconds=int(u(r.order_id, 25) * 86400))
