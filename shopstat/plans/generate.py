"""Deterministic synthetic tables as Spark jobs.

Every column is a counter-based random function of the row key (see
``shopstat.functions.random``), so a table is the same for any partitioning and
any number of executors, and a re-run task recomputes exactly the rows it lost.

The functions take the key frame as input (``customer_id`` / ``product_id`` / ``id``
column), so they can extend any existing key set; ``generate_all`` builds the key
frames with ``spark.range``.

Orders: per-customer counts come from the skewed allocation (G12); each customer
is then split into chunks of at most ``chunk_rows`` orders, chunks are spread by a
hash repartition and expanded there, so a customer holding a third of all orders
is generated by many tasks, not one. Positions are laid end to end by an exclusive
prefix sum over customers in weight-rank order (W4, computed from the dense rank
without a sort) and mapped to order ids by a keyed permutation (O5), computed per row.
"""
from __future__ import annotations

import datetime as dt
import hashlib
import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstat.functions import random as rnd
from shopstat.functions.exprs import add_days_seconds, capitalize_first, clip, drop_last_char, epoch_seconds_to_ntz
from shopstat.operators.allocation import skewed_allocation
from shopstat.operators.joins import lookup_customer_attribute
from shopstat.operators.ranking import running_sum_by_rank

# ---- fixed values -----------------------------------------------------------
# Product categories (must equal the reference's five categories, in this order).
CATEGORIES = ["Electronics", "Clothing", "Home", "Sports", "Books"]
# Our own word lists standing in for a fake-data library.
FIRST_NAMES = ["Ada", "Bruno", "Chiara", "Dmitri", "Elena", "Farid", "Grace", "Hugo", "Ines", "Jonas",
               "Keiko", "Liam", "Maya", "Nikos", "Olga", "Pavel", "Quinn", "Rosa", "Sami", "Tara"]
LAST_NAMES = ["Adams", "Berg", "Costa", "Dubois", "Evans", "Fischer", "Garcia", "Hansen", "Ito", "Jensen",
              "Kowalski", "Larsen", "Moreau", "Novak", "Okafor", "Petrov", "Rossi", "Silva", "Tanaka", "Weber"]
CITIES = ["Lisbon", "Nairobi", "Osaka", "Lyon", "Quito", "Tallinn", "Perth", "Porto", "Accra", "Bergen",
          "Cusco", "Gdansk", "Hobart", "Izmir", "Kochi", "Leeds", "Malmo", "Nantes", "Oulu", "Split"]
COUNTRIES = ["Portugal", "Kenya", "Japan", "France", "Ecuador", "Estonia", "Australia", "Ghana", "Norway",
             "Peru", "Poland", "Turkey", "India", "United Kingdom", "Sweden", "Finland", "Croatia", "Chile",
             "Canada", "Brazil"]
WORDS = ["amber", "brisk", "cedar", "delta", "ember", "fable", "gleam", "harbor", "ivory", "jolly",
         "kettle", "lunar", "maple", "nimble", "orbit", "pebble", "quartz", "ripple", "solar", "timber"]
EMAIL_DOMAINS = ["example.com", "example.org", "example.net"]

# Salts: one per random column.
S_FIRST, S_LAST, S_DOMAIN, S_AGE, S_CITY, S_COUNTRY, S_REG = 1, 2, 3, 4, 6, 7, 8
S_CATEGORY, S_WORD, S_PRICE, S_STOCK, S_RATING = 11, 12, 13, 14, 15
S_WEIGHT, S_PRODUCT, S_QUANTITY, S_DAYS, S_SECONDS = 21, 22, 23, 24, 25
S_AMOUNT, S_DATE = 31, 32

DEFAULT_SEED = 42
DEFAULT_AS_OF = dt.date(2025, 6, 30)
BENCHMARK_START = dt.date(2018, 1, 1)
# Order-id permutation: rounds, and the prime of the polynomials that key them.
ROUNDS = 3
PRIME = 2147483647


def years_before(d: dt.date, years: int) -> dt.date:
    try:
        return d.replace(year=d.year - years)
    except ValueError:  # 29 February
        return d.replace(year=d.year - years, day=28)


def _epoch_seconds(d: dt.date) -> int:
    return int((d - dt.date(1970, 1, 1)).total_seconds())


# ---- G13 customers ----------------------------------------------------------
def _u(name: str):
    return rnd.unit(F.col(name))


def customers_for_keys(keys: DataFrame, seed: int = DEFAULT_SEED, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    salts = {"_h_first": S_FIRST, "_h_last": S_LAST, "_h_domain": S_DOMAIN, "_h_age1": S_AGE,
             "_h_age2": S_AGE + 1, "_h_city": S_CITY, "_h_country": S_COUNTRY, "_h_reg": S_REG}
    h = rnd.with_hashes(keys.select(F.col("customer_id").cast("long")), "customer_id", seed, salts)
    first = rnd.choice(_u("_h_first"), FIRST_NAMES)
    last = rnd.choice(_u("_h_last"), LAST_NAMES)
    start = years_before(as_of, 5)
    span = (as_of - start).days
    reg_day = F.date_add(F.lit(start), rnd.uniform_int(_u("_h_reg"), 0, span + 1).cast("int"))
    age = clip(F.round(rnd.normal(_u("_h_age1"), _u("_h_age2"), 35.0, 10.0)), 18, 90).cast("int")
    return h.select(
        "customer_id",
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.col("customer_id").cast("string"), F.lit("@"),
                 rnd.choice(_u("_h_domain"), EMAIL_DOMAINS)).alias("email"),
        age.alias("age"),
        rnd.choice(_u("_h_city"), CITIES).alias("city"),
        rnd.choice(_u("_h_country"), COUNTRIES).alias("country"),
        reg_day.cast("timestamp_ntz").alias("registration_date"),
    )


# ---- G14 products -----------------------------------------------------------
def products_for_keys(keys: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    salts = {"_h_category": S_CATEGORY, "_h_word": S_WORD, "_h_price": S_PRICE, "_h_stock": S_STOCK,
             "_h_rating1": S_RATING, "_h_rating2": S_RATING + 1}
    h = rnd.with_hashes(keys.select(F.col("product_id").cast("long")), "product_id", seed, salts)
    category = rnd.choice(_u("_h_category"), CATEGORIES)
    word = rnd.choice(_u("_h_word"), WORDS)
    rating = F.round(clip(rnd.normal(_u("_h_rating1"), _u("_h_rating2"), 4.0, 0.8), 1.0, 5.0), 1)
    return h.select(
        "product_id",
        F.concat_ws(" ", capitalize_first(word), drop_last_char(category)).alias("name"),
        category.alias("category"),
        F.round(rnd.uniform_real(_u("_h_price"), 10.0, 500.0), 2).alias("price"),
        rnd.poisson(_u("_h_stock"), 50.0).alias("stock"),
        rating.alias("rating"),
    )


# ---- G15 orders -------------------------------------------------------------
def permutation_keys(seed: int) -> list[tuple[int, int, int]]:
    """Per round: the two keys of its polynomials and the rotation after it."""
    out = []
    for r in range(ROUNDS):
        d = hashlib.sha256(f"{seed}:{r}".encode()).digest()
        x, y, shift = (int.from_bytes(d[at:at + 8], "big") for at in (0, 8, 16))
        out.append((x % PRIME, y % PRIME, shift >> 2))
    return out


def permuted(df: DataFrame, column: str, n: int, seed: int) -> DataFrame:
    """``column``, a position in [0, n), replaced by its image under a keyed permutation
    of [0, n). The positions form rows of isqrt(n); every round rotates each row by a keyed
    amount, then each column, then all positions. Each step is one to one for any n (the
    incomplete last row waits for the rotation of all), all products stay below 2^62, and
    nothing is shuffled between tasks."""
    n = max(n, 1)
    width = math.isqrt(n)
    rows = n // width
    keep = [f"`{c}`" for c in df.columns if c != column]

    def squared(x: str, key: int) -> str:
        y = f"(({x} + {key}) % {PRIME})"
        return f"({y} * {y} % {PRIME})"

    for across, down, shift in permutation_keys(seed):
        df = df.selectExpr(*keep, f"`{column}` AS _x", f"`{column}` div {width} AS _r", f"`{column}` % {width} AS _k")
        df = df.selectExpr(*keep, "_x", "_r", f"(_k + {squared('_r', across)}) % {width} AS _k")
        df = df.selectExpr(*keep, f"(CASE WHEN _r < {rows} THEN (_r + {squared('_k', down)}) % {rows} * {width} + _k ELSE _x END + {shift % n}) % {n} AS `{column}`")
    return df


def order_counts(customers: DataFrame, n_orders: int, seed: int = DEFAULT_SEED, top_share: float = 0.8,
                 remainder: str = "fraction", pareto_offset: float = 1.0,
                 num_partitions: int | None = None) -> DataFrame:
    """G7 + G12: Pareto weights per customer, then the exact skewed allocation."""
    keyed = rnd.with_hashes(customers.select("customer_id"), "customer_id", seed, {"_h_weight": S_WEIGHT})
    weight = rnd.pareto(_u("_h_weight"), 1.5, pareto_offset)
    return skewed_allocation(keyed, "customer_id", weight, n_orders, 0.2, top_share, remainder, num_partitions)


def orders_for_customers(customers: DataFrame, n_orders: int, n_products: int, seed: int = DEFAULT_SEED,
                         as_of: dt.date = DEFAULT_AS_OF, top_share: float = 0.8, remainder: str = "fraction",
                         first_product_id: int = 1, chunk_rows: int = 100_000,
                         rows_per_partition: int = 2_000_000, num_partitions: int | None = None,
                         pareto_offset: float = 1.0) -> DataFrame:
    """``customers`` needs customer_id and registration_date. ``pareto_offset`` is
    added to the Lomax draw: 1.0 gives classic Pareto weights, a tiny value (1e-6)
    the heavier-tailed variant."""
    spark = customers.sparkSession
    counts = order_counts(customers, n_orders, seed, top_share, remainder, pareto_offset, num_partitions)
    # Blocks of positions are laid end to end in weight-rank order; the rank is dense
    # and unique, so the prefix sum needs no sort of the customers (W4 by rank).
    placed = running_sum_by_rank(counts.select("customer_id", "weight_rank", "order_count"),
                                 "weight_rank", "order_count", "start_pos", inclusive=False)
    # The registration date travels with the customer row into the expansion.
    placed = lookup_customer_attribute(placed, customers, "registration_date")

    # Split every customer into chunks of at most chunk_rows orders (G11 guarded: no
    # chunk rows for a zero count), spread the chunks, then expand them.
    n_chunks = F.ceil(F.col("order_count") / F.lit(chunk_rows)).cast("int")
    chunks = placed.filter(F.col("order_count") > 0).select(
        "customer_id", "registration_date", "order_count", "start_pos",
        F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("chunk"),
    ).withColumn("chunk_start", F.col("start_pos") + F.col("chunk") * F.lit(chunk_rows)).withColumn(
        "chunk_len", F.least(F.lit(chunk_rows).cast("long"), F.col("order_count") - F.col("chunk") * F.lit(chunk_rows)))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200") or 200),
                math.ceil(n_orders / rows_per_partition))
    chunks = chunks.repartition(parts, "customer_id", "chunk")
    rows = chunks.select(
        "customer_id", "registration_date", "chunk_start",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunk_len") - 1)).alias("i"),
    ).select("customer_id", "registration_date", (F.col("chunk_start") + F.col("i")).alias("pos"))
    # The allocation is exact, so there are exactly N positions.
    ids = permuted(rows, "pos", n_orders, seed)
    salts = {"_h_product": S_PRODUCT, "_h_quantity": S_QUANTITY, "_h_days": S_DAYS, "_h_seconds": S_SECONDS}
    h = rnd.with_hashes(ids.select((F.col("pos") + 1).alias("order_id"), "customer_id", "registration_date"),
                        "order_id", seed, salts)
    days = F.greatest(F.datediff(F.lit(as_of), F.col("registration_date").cast("date")), F.lit(0))
    return h.select(
        "order_id",
        F.col("customer_id").cast("long").alias("customer_id"),
        rnd.uniform_int(_u("_h_product"), first_product_id, first_product_id + n_products).cast("long")
        .alias("product_id"),
        rnd.uniform_int(_u("_h_quantity"), 1, 11).cast("smallint").alias("quantity"),
        add_days_seconds(F.col("registration_date"), rnd.uniform_upto(_u("_h_days"), days),
                         rnd.uniform_int(_u("_h_seconds"), 0, 86400)).alias("order_date"),
    )


# ---- G17 format-benchmark table -----------------------------------------------
def benchmark_rows_for_keys(keys: DataFrame, seed: int = DEFAULT_SEED, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    salts = {"_h_first": S_FIRST, "_h_last": S_LAST, "_h_domain": S_DOMAIN, "_h_amount": S_AMOUNT,
             "_h_date": S_DATE, "_h_category": S_CATEGORY}
    h = rnd.with_hashes(keys.select(F.col("id").cast("long")), "id", seed, salts)
    first = rnd.choice(_u("_h_first"), FIRST_NAMES)
    last = rnd.choice(_u("_h_last"), LAST_NAMES)
    t0, t1 = _epoch_seconds(BENCHMARK_START), _epoch_seconds(as_of)
    return h.select(
        "id",
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.col("id").cast("string"), F.lit("@"),
                 rnd.choice(_u("_h_domain"), EMAIL_DOMAINS)).alias("email"),
        F.round(rnd.uniform_real(_u("_h_amount"), 10.0, 5000.0), 2).alias("amount"),
        epoch_seconds_to_ntz(rnd.uniform_int(_u("_h_date"), t0, t1 + 1)).alias("date"),
        rnd.choice(_u("_h_category"), CATEGORIES).alias("category"),
    )


# ---- G1 + G16 -----------------------------------------------------------------
def key_range(spark: SparkSession, n: int, name: str) -> DataFrame:
    """G1 — ids 1..n."""
    return spark.range(1, n + 1).withColumnRenamed("id", name)


def generate_all(spark: SparkSession, out_dir: str, n_customers: int = 100_000, n_products: int = 10_000,
                 n_orders: int = 1_000_000, seed: int = DEFAULT_SEED, as_of: dt.date = DEFAULT_AS_OF,
                 **order_options) -> dict[str, str]:
    """Generate customers, products and orders and store them as Parquet datasets."""
    customers = customers_for_keys(key_range(spark, n_customers, "customer_id"), seed, as_of)
    products = products_for_keys(key_range(spark, n_products, "product_id"), seed)
    paths = {name: os.path.join(str(out_dir), f"{name}.parquet") for name in ("customers", "products", "orders")}
    customers.write.mode("overwrite").parquet(paths["customers"])
    products.write.mode("overwrite").parquet(paths["products"])
    stored_customers = spark.read.parquet(paths["customers"])
    orders = orders_for_customers(stored_customers, n_orders, n_products, seed, as_of, **order_options)
    orders.write.mode("overwrite").parquet(paths["orders"])
    return paths
