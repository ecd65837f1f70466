"""

``queries()[name](spark, sf_dir)`` returns a DataFrame computed with the shopstat
operators over the driver tables in ``sf_dir``; ``oracle_sql()[name]`` is an
independent DuckDB statement over the same tables (registered as views) that
must give the same rows. Every query reads whole tables.
"""
from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from functools import reduce  # noqa: E402

from shopstat.functions import exprs as X  # noqa: E402
from shopstat.functions import random as rnd  # noqa: E402
from shopstat.functions.exprs import month_label, month_start  # noqa: E402
from shopstat.operators.compare import compare_to_baseline, reconcile, reconcile_bags  # noqa: E402
from shopstat.operators.joins import enrich_orders, enrich_orders_null_safe, lookup_customer_attribute  # noqa: E402
from shopstat.operators import aggregates as A  # noqa: E402
from shopstat.operators import reports as R  # noqa: E402
from shopstat.operators.allocation import skewed_allocation  # noqa: E402
from shopstat.operators.ranking import global_row_number, global_running_sum  # noqa: E402
from shopstat.plans import analytics_job  # noqa: E402
from shopstat.plans import generate as G  # noqa: E402
from shopstat.plans.dataset_report import dataset_report  # noqa: E402
from shopstat.plans.formats import check_formats, compare_formats, roundtrip  # noqa: E402
from shopstat.sources.storage import stored_bytes  # noqa: E402
from shopstat.sources.tables import load_parquet, load_parquet_nanos, table_path  # noqa: E402
from shopstat.schemas import DRIVER_TABLES, FORMAT_METRICS  # noqa: E402
from shopstat.sources.files import read_csv, read_csv_inferred, save_metrics, write_csv  # noqa: E402
from shopstat.session import discard, scratch_path, stored  # noqa: E402
from shopstat.sources import model  # noqa: E402
from shopstat.sources.bucketed import bucket_model, open_bucketed  # noqa: E402

try:  # the training-data queries are optional: without them, or a library they need, the others work alone
    from shopstat.llm import queries as llm  # noqa: E402
    import corpus_pipeline  # noqa: E402, F401
except ImportError as e:
    if os.path.exists(os.path.join(_HERE, "shopstat", "llm", "queries.py")):
        print(f"the training-data queries are left out: {e}", file=sys.stderr)
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
EARLY = dt.date(1992, 1, 1)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: top 10 customers by revenue on the sf0.001 tables."""
    return _top_customers(spark, SMOKE_DIR)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _sales(spark, d):
    return model.orders(spark, d), model.products(spark, d)


def _top_customers(spark, d):
    return R.top_customers_by_revenue(*_sales(spark, d), n=10)


def _reduced_catalog(spark, d):
    # The whole catalog with the largest sizes under other keys: order lines for those
    # parts find no product, which exercises the null-category / null-revenue rules.
    return model.raw(spark, d, "part").select(
        F.when(F.col("p_size") > 40, -F.col("p_partkey")).otherwise(F.col("p_partkey")).alias("product_id"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"))


def _report_job_output(name):
    def run(spark, d):
        out = scratch_path(spark, "report-job")
        paths = analytics_job.write_reports(model.orders(spark, d), model.products(spark, d),
                                            model.customers(spark, d), out)
        return spark.read.parquet(paths[name])
    return run


def _bucketed_model(spark, d):
    raw, out = scratch_path(spark, "raw-model"), scratch_path(spark, "bucketed-model")
    model.write_model(spark, d, raw)
    bucket_model(spark, raw, out)
    discard(spark, raw)
    return out


def _bucketed_customer_revenue(spark, d):
    return R.customer_revenue_of(open_bucketed(spark, _bucketed_model(spark, d)).enriched())


def _bucketed_report_job(spark, d):
    made, out = _bucketed_model(spark, d), scratch_path(spark, "bucketed-reports")
    paths = analytics_job.run_bucketed(spark, made, out)
    discard(spark, made)
    return spark.read.parquet(paths["sales_by_country"])


def _allocation(remainder):
    def run(spark, d):
        cust = model.raw(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), "c_acctbal")
        total = model.raw(spark, d, "lineitem").count()
        return skewed_allocation(cust, "customer_id", F.col("c_acctbal") + F.lit(1000.0), total,
                                 remainder=remainder)
    return run


def _allocation_top_share(spark, d):
    alloc = _allocation("fraction")(spark, d)
    return A.totals(
        alloc,
        n_keys=F.count(F.lit(1)),
        total_orders=F.sum("order_count"),
        top_orders=F.sum(F.when(F.col("is_top"), F.col("order_count")).otherwise(F.lit(0))),
        top_share=F.round(A.top_share(F.col("is_top"), F.col("order_count")), 6),
    )


def _global_rank(spark, d):
    c = model.raw(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"),
                                               F.col("c_acctbal").alias("acctbal"))
    return global_row_number(c, [F.col("acctbal").desc(), F.col("customer_id").asc()], "balance_rank")


def _running_total(spark, d):
    o = model.raw(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                             F.col("o_totalprice").alias("total_price"))
    r = global_running_sum(o, [F.col("order_id").asc()], "total_price", "running_total")
    return r.select("order_id", "total_price", F.round("running_total", 2).alias("running_total"))


def _gen_customers(spark, d):
    keys = model.raw(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"))
    return G.customers_for_keys(keys)


def _gen_products(spark, d):
    keys = model.raw(spark, d, "part").select(F.col("p_partkey").alias("product_id"))
    return G.products_for_keys(keys)


def _gen_orders(spark, d):
    customers = _gen_customers(spark, d)
    n_orders = model.raw(spark, d, "orders").count()
    n_products, first_product = model.raw(spark, d, "part").agg(F.count(F.lit(1)), F.min("p_partkey")).first()
    return G.orders_for_customers(customers, n_orders, n_products, first_product_id=first_product)


def _gen_orders_invariants(spark, d):
    orders = _gen_orders(spark, d)
    customers = _gen_customers(spark, d)
    products = _gen_products(spark, d)
    with_reg = orders.join(customers.select("customer_id", "registration_date"), "customer_id", "left")
    known_products = products.select("product_id").withColumn("_known", F.lit(True))
    checked = with_reg.join(known_products, "product_id", "left")
    return checked.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("order_id").alias("distinct_order_ids"),
        F.min("order_id").alias("min_order_id"),
        F.max("order_id").alias("max_order_id"),
        F.sum(F.when(F.col("registration_date").isNull(), 1).otherwise(0)).alias("orphan_customers"),
        F.sum(F.when(F.col("_known").isNull(), 1).otherwise(0)).alias("orphan_products"),
        F.sum(F.when(F.col("order_date") < F.col("registration_date"), 1).otherwise(0)).alias("dates_before_registration"),
        F.sum(F.when(~F.col("quantity").between(1, 10), 1).otherwise(0)).alias("quantity_out_of_range"),
    )


def _gen_order_counts(spark, d):
    n_orders = model.raw(spark, d, "orders").count()
    counts = G.order_counts(_gen_customers(spark, d), n_orders)
    return counts.select("customer_id", "weight_rank", "is_top", "quota", "order_count")


def _gen_benchmark(spark, d):
    keys = model.raw(spark, d, "events").select(F.col("event_id").alias("id"))
    return G.benchmark_rows_for_keys(keys)



def _csv_inferred(spark, d):
    # The types come from the CSV text alone; the casts then only widen (int to long).
    orders, at = model.raw(spark, d, "orders"), scratch_path(spark, "csv-inferred")
    read = read_csv_inferred(spark, write_csv(orders, at))
    return read.select(*[F.col(f.name).cast(f.dataType) for f in orders.schema.fields])


def _format_roundtrip(fmt):
    def run(spark, d):
        return roundtrip(model.raw(spark, d, "lineitem"), fmt, scratch_path(spark, f"roundtrip-{fmt}"))
    return run


def _format_comparison(spark, d):
    lines = model.raw(spark, d, "lineitem")
    return check_formats(lines, compare_formats(lines, scratch_path(spark, "format-comparison")))


def _metrics_sink(spark, d):
    # One row of measurements per event type, through the metrics file.
    ev = model.raw(spark, d, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("most"), F.min("value").alias("least"))
    nothing = F.lit(None).cast("double")
    rows = ev.select(F.col("event_type").alias("format"), F.concat(F.lit("events/"), "event_type").alias("file_path"),
                     X.bytes_to_mb("n").alias("file_size_mb"), F.col("most").alias("write_time_s"), F.col("least").alias("read_time_s"),
                     nothing.alias("peak_memory_mb"), X.larger_of("most", "least").alias("cpu_time_s"), X.energy_wh("most").alias("energy_wh"))
    return read_csv(spark, save_metrics(rows, scratch_path(spark, "metrics")), FORMAT_METRICS)


def _line_measures(spark, d):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return model.raw(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        X.narrow(quantity).alias("units"),
        X.floor_of(price).alias("whole_price"),
        X.round_to(X.fractional(price), 6).alias("price_fraction"),
        X.round_to(quantity / 8, 2, half_even=True).alias("eighths"),
        X.days_between("l_shipdate", F.lit(EARLY)).alias("days_since"),
        X.to_ntz("l_shipdate").alias("ship_midnight"),
        X.join_words("l_returnflag", "l_linestatus", sep="/").alias("flags"),
        X.larger_of("l_discount", "l_tax").alias("larger_rate"),
        X.fixed_text(price, 2, " EUR").alias("price_text"),
        X.energy_wh(quantity).alias("energy_wh"),
        X.bytes_to_mb(price).alias("megabytes"),
    )


def _generate_all(spark, d):
    # As many customers, products and orders as the given tables have, stored and read back.
    sizes = {"customers": "customer", "products": "part", "orders": "orders"}
    n = {name: model.raw(spark, d, t).count() for name, t in sizes.items()}
    paths = G.generate_all(spark, scratch_path(spark, "generated"), n["customers"], n["products"], n["orders"])
    frames = [spark.read.parquet(paths[name]).agg(
        F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"),
        F.min(key).alias("first_key"), F.max(key).alias("last_key"))
        for name, key in (("customers", "customer_id"), ("products", "product_id"), ("orders", "order_id"))]
    return reduce(DataFrame.unionByName, frames)


def _order_shuffle(spark, d):
    """For each distance, whether order ids that far apart have the same customer about as often as
    after a true shuffle: sum(p^2), within six standard deviations."""
    ids, _ = stored(_gen_orders(spark, d).select("order_id", "customer_id"), "order-shuffle")
    n = ids.count()
    per = ids.groupBy("customer_id").agg(F.count(F.lit(1)).alias("c"))
    expected = per.agg(F.sum(F.col("c") * F.col("c"))).first()[0] / float(n * n)
    shifted = ids.select(F.col("customer_id").alias("other"), F.explode(F.sequence(F.lit(1), F.lit(10))).alias("distance"), "order_id")
    pairs = shifted.withColumn("order_id", F.col("order_id") - F.col("distance")).join(ids, "order_id")
    share = F.avg((F.col("other") == F.col("customer_id")).cast("double"))
    return pairs.groupBy("distance").agg((F.abs(share - expected) < 6 * (expected / n) ** 0.5).alias("as_shuffled"))


def _random_streams(spark, d):
    """Properties of the random base over the event ids: distinct draws, draws shared with the next seed and
    with keys 2^31 - 1 further on, and whether moments lie within six standard errors."""
    keys = model.raw(spark, d, "events").select("event_id")
    draws, _ = stored(rnd.with_hashes(keys, "event_id", 42, {"h": 40, "g": 41}), "random-streams")
    next_seed = rnd.with_hashes(keys, "event_id", 43, {"h": 40}).select("h")
    far = rnd.with_hashes(keys.select((F.col("event_id") + 2**31 - 1).alias("event_id")), "event_id", 42, {"h": 40}).select("h")
    shared = [other.join(draws.select("h"), "h").count() for other in (next_seed, far)]
    u, v = rnd.unit("h"), rnd.unit("g")
    root = F.sqrt(F.count(F.lit(1)))

    def near(x, mean, sd):
        return F.abs(F.avg(x) - mean) < 6 * sd / root

    return draws.agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_distinct("h").alias("distinct_draws"),
        F.lit(shared[0]).cast("long").alias("shared_with_next_seed"), F.lit(shared[1]).cast("long").alias("shared_with_far_keys"),
        near(u, 0.5, 12**-0.5).alias("uniform_mean"), near(u * v, 0.25, (7 / 144) ** 0.5).alias("independent_salts"),
        near(rnd.uniform_int(u, 1, 11), 5.5, 8.25**0.5).alias("integer_mean"), near(rnd.normal(u, v, 35.0, 10.0), 35.0, 10.0).alias("normal_mean"),
        near(rnd.poisson(u, 50.0), 50.0, 50**0.5).alias("poisson_mean"),
        near((rnd.pareto(u, 1.5, 1.0) > 2.0).cast("double"), 2**-1.5, (2**-1.5 * (1 - 2**-1.5)) ** 0.5).alias("pareto_tail"),
        near((rnd.choice(u, G.CATEGORIES) == G.CATEGORIES[0]).cast("double"), 0.2, 0.4).alias("category_share"),
    )


def _event_metrics(spark, d):
    ev = model.raw(spark, d, "events")
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.round(F.sum("value"), 2).alias("total_value"),
        F.round(F.avg("value"), 6).alias("avg_value"),
    )


def _compare_to_baseline(spark, d):
    return compare_to_baseline(_event_metrics(spark, d), "event_type", "view",
                               ["n_events", "total_value", "avg_value"])


def _reconcile_top_customers(spark, d):
    left = R.customer_revenue(*_sales(spark, d))
    right = R.customer_revenue(model.orders(spark, d), _reduced_catalog(spark, d))
    return reconcile(left, right, "customer_id", ["total_revenue"])


def _null_safe(spark, d):
    # The whole tables with the key left out on both sides: of every seventh part's lines, and of a few parts.
    orders, products = _sales(spark, d)
    return enrich_orders_null_safe(orders.withColumn("product_id", F.when(F.col("product_id") % 7 != 0, F.col("product_id"))),
                                   products.withColumn("product_id", F.when(F.col("product_id") % 997 != 0, F.col("product_id"))))


def _reconcile_order_lines(spark, d):
    # An order holds many lines, and equal ones: every key repeats.
    left = model.orders(spark, d)
    right = left.filter("product_id % 11 <> 0").withColumn("quantity", F.when(F.col("product_id") % 5 != 0, F.col("quantity")))
    return reconcile_bags(left, right, ["order_id"], ["product_id", "quantity"])


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _table_row_counts(spark, d):
    frames = [A.row_count(model.raw(spark, d, t), "n_rows").select(F.lit(t).alias("table_name"), "n_rows")
              for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _orders_per_month(spark, d):
    o = model.orders(spark, d)
    return o.groupBy(month_start("order_date").alias("m")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("units")
    ).select(month_label("m").alias("month"), "n_lines", "units")


def _revenue_long(spark, d):
    return analytics_job.long_report(*_sales(spark, d), model.customers(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # R1-R6 reports
        "top_customers": _top_customers,
        "sales_by_category": lambda s, d: R.sales_by_category(*_sales(s, d)),
        "sales_by_category_unmatched": lambda s, d: R.sales_by_category(
            model.orders(s, d), _reduced_catalog(s, d)),
        "monthly_trends": lambda s, d: R.monthly_trends(*_sales(s, d)),
        "sales_by_country": lambda s, d: R.sales_by_country(*_sales(s, d), model.customers(s, d)),
        "top_customers_zero_fill": lambda s, d: R.top_customers_zero_fill(
            model.orders(s, d), _reduced_catalog(s, d)),
        "top_customers_revenue_only": lambda s, d: R.top_customers_revenue_only(*_sales(s, d)),
        "customer_revenue": lambda s, d: R.customer_revenue(*_sales(s, d)),
        # S11 report-writing job, each output read back
        "report_job_top_customers": _report_job_output("top_customers"),
        "report_job_revenue_by_category": _report_job_output("sales_by_category"),
        "report_job_monthly_sales": _report_job_output("monthly_trends"),
        "report_job_sales_by_country": _report_job_output("sales_by_country"),
        # J1 over the stored bucketed model
        "bucketed_customer_revenue": _bucketed_customer_revenue,
        "bucketed_report_job": _bucketed_report_job,
        # W2-W4 distributed rank / running total, G12 allocation, A8 share
        "global_rank": _global_rank,
        "running_total": _running_total,
        "skew_allocation": _allocation("fraction"),
        "skew_allocation_weight_rule": _allocation("weight"),
        "allocation_top_share": _allocation_top_share,
        # G13-G17 generated tables keyed by the driver tables
        "gen_customers": _gen_customers,
        "gen_products": _gen_products,
        "gen_orders": _gen_orders,
        "gen_order_counts": _gen_order_counts,
        "gen_orders_invariants": _gen_orders_invariants,
        "gen_format_benchmark": _gen_benchmark,
        "generate_all": _generate_all,
        # properties of the generator, against constants
        "order_shuffle": _order_shuffle,
        "random_streams": _random_streams,
        # S1-S8 sources and sinks, R7-R10 comparisons and stored-data report
        "scan_customer": lambda s, d: load_parquet(s, table_path(d, "customer"), DRIVER_TABLES["customer"]),
        "format_roundtrip_csv": _format_roundtrip("csv"),
        "format_roundtrip_parquet": _format_roundtrip("parquet"),
        "format_roundtrip_orc": _format_roundtrip("orc"),
        "csv_inferred_orders": _csv_inferred,
        "format_comparison": _format_comparison,
        "metrics_sink": _metrics_sink,
        "orders_normalised": lambda s, d: load_parquet_nanos(s, table_path(d, "orders")),
        "dataset_size_lineitem": lambda s, d: stored_bytes(s, table_path(d, "lineitem")),
        "stored_datasets": lambda s, d: dataset_report(s, d),
        "compare_to_baseline": _compare_to_baseline,
        "reconcile_top_customers": _reconcile_top_customers,
        # primitives: J1+P1 enriched rows, P2 month bucket, A6 counts + U1 union
        "reconcile_order_lines": _reconcile_order_lines,
        "enriched_orders_null_safe": _null_safe,
        "enriched_orders": lambda s, d: enrich_orders(*_sales(s, d)),
        "customers_model": lambda s, d: model.customers(s, d),
        "orders_with_customer_name": lambda s, d: lookup_customer_attribute(
            model.orders(s, d), model.customers(s, d), "name"),
        "orders_per_month": _orders_per_month,
        "line_measures": _line_measures,
        "table_row_counts": _table_row_counts,
        "revenue_long": _revenue_long,
    }
    if llm is not None:
        q |= llm.QUERIES
    return q


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

_MODEL = """
model_orders AS (
  SELECT l.l_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
         CAST(l.l_quantity AS SMALLINT) AS quantity, o.o_orderdate AS order_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
model_products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_retailprice AS price FROM part),
reduced_products AS (
  SELECT CASE WHEN p_size > 40 THEN -p_partkey ELSE p_partkey END AS product_id, p_type AS category, p_retailprice AS price FROM part),
model_customers AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS name, n.n_name AS country
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
enriched AS (
  SELECT o.*, p.category, p.price, p.price * o.quantity AS revenue
  FROM model_orders o LEFT JOIN model_products p USING (product_id)),
enriched_reduced AS (
  SELECT o.*, p.category, p.price, p.price * o.quantity AS revenue
  FROM model_orders o LEFT JOIN reduced_products p USING (product_id))
"""


def _with(body: str) -> str:
    return "WITH " + _MODEL.strip() + "\n" + body


_TOP = """SELECT customer_id, round(sum(revenue), 2) AS total_revenue,
       CAST(sum(quantity) AS BIGINT) AS units_purchased
FROM enriched GROUP BY customer_id
ORDER BY total_revenue DESC NULLS LAST, customer_id LIMIT 10"""

_CATEGORY = """SELECT category, round(sum(revenue), 2) AS total_revenue,
       CAST(sum(quantity) AS BIGINT) AS units_sold
FROM {src} GROUP BY category ORDER BY total_revenue DESC NULLS LAST, category NULLS LAST"""

_MONTHLY = """, m AS (
  SELECT strftime(order_date, '%Y-%m') AS month, round(sum(revenue), 2) AS month_revenue
  FROM enriched GROUP BY 1),
l AS (SELECT month, month_revenue, CASE WHEN month IS NOT NULL THEN lag(month_revenue) OVER (ORDER BY month NULLS LAST) END
        AS previous_month_revenue FROM m)
SELECT month, month_revenue, previous_month_revenue,
       round((month_revenue - previous_month_revenue) / nullif(previous_month_revenue, 0) * 100.0, 6)
         AS revenue_growth_pct
FROM l ORDER BY month NULLS LAST"""

_COUNTRY = """SELECT c.country, round(sum(e.revenue), 2) AS total_revenue,
       CAST(sum(e.quantity) AS BIGINT) AS units_sold
FROM enriched e LEFT JOIN model_customers c USING (customer_id)
GROUP BY c.country ORDER BY total_revenue DESC NULLS LAST, c.country NULLS LAST"""


# ---- DuckDB text of the counter-based random columns (the same digests) ----

def _f(v: float) -> str:
    """A double literal DuckDB parses as DOUBLE, exactly."""
    return format(float(v), ".17e")


def _sql_u(key, seed, salt):
    digest = f"md5('{seed}:{salt // 2}:' || CAST(CAST({key} AS BIGINT) AS VARCHAR))"
    bits = f"(CAST('0x' || substr({digest}, {1 + salt % 2 * 14}, 14) AS BIGINT) >> 3)"
    return f"least((CAST({bits} AS DOUBLE) + {_f(0.5)}) / {_f(2.0**53)}, {_f(1.0 - 2.0**-53)})"


def _sql_uniform_real(key, seed, salt, a, b):
    return f"({_f(a)} + {_sql_u(key, seed, salt)} * {_f(b - a)})"


def _sql_uniform_int(key, seed, salt, a, b_sql):
    return f"CAST({a} + floor({_sql_u(key, seed, salt)} * (({b_sql}) - {a})) AS BIGINT)"


def _sql_normal(key, seed, salt, mean, sd):
    z = f"(sqrt({_f(-2.0)} * ln({_sql_u(key, seed, salt)})) * cos({_f(rnd.TWO_PI)} * {_sql_u(key, seed, salt + 1)}))"
    return f"({_f(mean)} + {_f(sd)} * {z})"


def _sql_choice(key, seed, salt, values):
    lst = "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"
    return f"{lst}[1 + CAST(floor({_sql_u(key, seed, salt)} * {len(values)}) AS BIGINT)]"


def _sql_poisson(key, seed, salt, lam):
    cdf = "[" + ", ".join(_f(v) for v in rnd.poisson_cdf(lam)) + "]"
    return f"CAST(len(list_filter({cdf}, lambda c: c < {_sql_u(key, seed, salt)})) AS BIGINT)"


def _sql_pareto(key, seed, salt, alpha, offset):
    return (f"(pow({_f(1.0)} - {_sql_u(key, seed, salt)}, {_f(-1.0 / alpha)}) - {_f(1.0)} + {_f(offset)})")


def _sql_clip(x, lo, hi):
    return f"greatest(least({x}, {hi}), {lo})"


def _sql_customers(keys_sql: str, seed=G.DEFAULT_SEED, as_of=G.DEFAULT_AS_OF) -> str:
    k = "customer_id"
    first = _sql_choice(k, seed, G.S_FIRST, G.FIRST_NAMES)
    last = _sql_choice(k, seed, G.S_LAST, G.LAST_NAMES)
    start = G.years_before(as_of, 5)
    span = (as_of - start).days
    reg = f"CAST(DATE '{start.isoformat()}' + CAST({_sql_uniform_int(k, seed, G.S_REG, 0, str(span + 1))} AS INTEGER) AS TIMESTAMP)"
    age = f"CAST({_sql_clip('round(' + _sql_normal(k, seed, G.S_AGE, 35.0, 10.0) + ')', 18, 90)} AS INTEGER)"
    return f"""SELECT CAST(customer_id AS BIGINT) AS customer_id,
  concat_ws(' ', {first}, {last}) AS name,
  lower({first}) || '.' || lower({last}) || CAST(customer_id AS VARCHAR) || '@' || {_sql_choice(k, seed, G.S_DOMAIN, G.EMAIL_DOMAINS)} AS email,
  {age} AS age,
  {_sql_choice(k, seed, G.S_CITY, G.CITIES)} AS city,
  {_sql_choice(k, seed, G.S_COUNTRY, G.COUNTRIES)} AS country,
  {reg} AS registration_date
FROM ({keys_sql}) keys"""


def _sql_products(keys_sql: str, seed=G.DEFAULT_SEED) -> str:
    k = "product_id"
    cat = _sql_choice(k, seed, G.S_CATEGORY, G.CATEGORIES)
    word = _sql_choice(k, seed, G.S_WORD, G.WORDS)
    rating = f"round({_sql_clip(_sql_normal(k, seed, G.S_RATING, 4.0, 0.8), _f(1.0), _f(5.0))}, 1)"
    return f"""SELECT CAST(product_id AS BIGINT) AS product_id,
  concat_ws(' ', upper(substring({word}, 1, 1)) || lower(substring({word}, 2, {1 << 30})),
            substring({cat}, 1, length({cat}) - 1)) AS name,
  {cat} AS category,
  round({_sql_uniform_real(k, seed, G.S_PRICE, 10.0, 500.0)}, 2) AS price,
  {_sql_poisson(k, seed, G.S_STOCK, 50.0)} AS stock,
  {rating} AS rating
FROM ({keys_sql}) keys"""


def _sql_allocation(src: str, key: str, total_sql: str, top_fraction=0.2, top_share=0.8,
                    remainder="fraction") -> str:
    """CTE list ending in ``alloc`` (key, weight, weight_rank, is_top, quota, order_count).
    ``src`` is a CTE/table with columns (key, weight)."""
    order = "remainder" if remainder == "fraction" else "adj_weight"
    share = _f(top_share)
    return f"""al_r AS (SELECT {key}, CAST(weight AS DOUBLE) AS weight,
    row_number() OVER (ORDER BY weight DESC, {key}) AS weight_rank, count(*) OVER () AS n_keys FROM {src}),
al_f AS (SELECT *, weight_rank <= greatest(1, floor(n_keys * {_f(top_fraction)})) AS is_top FROM al_r),
al_s AS (SELECT sum(CASE WHEN is_top THEN weight ELSE {_f(0.0)} END) AS s_top,
                sum(CASE WHEN NOT is_top THEN weight ELSE {_f(0.0)} END) AS s_rest FROM al_f),
al_a AS (SELECT al_f.*, CASE WHEN al_s.s_top <= 0 OR al_s.s_rest <= 0 THEN {_f(1.0)}
    WHEN is_top THEN weight * (({share} * al_s.s_rest) / (({_f(1.0)} - {share}) * al_s.s_top))
    ELSE weight END AS adj_weight FROM al_f, al_s),
al_q AS (SELECT al_a.*, round(adj_weight / sum(adj_weight) OVER () * CAST(({total_sql}) AS DOUBLE), 6) AS quota FROM al_a),
al_b AS (SELECT al_q.*, floor(quota) AS base, round(quota - floor(quota), 6) AS remainder FROM al_q),
al_m AS (SELECT ({total_sql}) - CAST(sum(base) AS BIGINT) AS missing FROM al_b),
al_k AS (SELECT al_b.*, al_m.missing, row_number() OVER (ORDER BY CASE WHEN missing < 0 AND base > 0 THEN 1 ELSE 0 END, {order} DESC, {key})
    AS remainder_rank FROM al_b, al_m),
alloc AS (SELECT {key}, weight, weight_rank, is_top, quota,
    CAST(base + CASE WHEN missing > 0 AND remainder_rank <= missing THEN 1
                             WHEN missing < 0 AND n_keys - remainder_rank + 1 <= -missing THEN -1
                             ELSE 0 END AS BIGINT) AS order_count FROM al_k)"""


def _sql_gen_orders(seed=G.DEFAULT_SEED, as_of=G.DEFAULT_AS_OF) -> str:
    n = "(SELECT count(*) FROM orders)"
    n_products = "(SELECT count(*) FROM part)"
    first_product = "(SELECT min(p_partkey) FROM part)"
    oid = "order_id"
    squared = lambda x, key: f"((({x} + {key}) % {G.PRIME}) * (({x} + {key}) % {G.PRIME}) % {G.PRIME})"
    rounds = "\n".join(f"""a{i} AS (SELECT customer_id, registration_date, n, w, h, x, x // w AS r, (x % w + {squared('(x // w)', across)}) % w AS k FROM p{i}, par),
p{i + 1} AS (SELECT customer_id, registration_date,
  ((CASE WHEN r < h THEN (r + {squared('k', down)}) % h * w + k ELSE x END) + {shift} % n) % n AS x FROM a{i}),"""
                       for i, (across, down, shift) in enumerate(G.permutation_keys(seed)))
    days = f"greatest(date_diff('day', CAST(registration_date AS DATE), DATE '{as_of.isoformat()}'), 0)"
    rand_days = f"CAST(floor({_sql_u(oid, seed, G.S_DAYS)} * ({days} + 1)) AS BIGINT)"
    rand_secs = _sql_uniform_int(oid, seed, G.S_SECONDS, 0, "86400")
    keys = "SELECT c_custkey AS customer_id FROM customer"
    return f"""WITH cust AS ({_sql_customers(keys, seed, as_of)}),
w AS (SELECT customer_id, {_sql_pareto('customer_id', seed, G.S_WEIGHT, 1.5, 1.0)} AS weight FROM cust),
{_sql_allocation('w', 'customer_id', n)},
placed AS (SELECT a.customer_id, a.order_count, c.registration_date,
    coalesce(sum(a.order_count) OVER (ORDER BY a.weight_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_pos
  FROM alloc a JOIN cust c USING (customer_id) WHERE a.order_count > 0),
expanded AS (SELECT customer_id, registration_date, start_pos, unnest(range(order_count)) AS i FROM placed),
positioned AS (SELECT customer_id, registration_date, start_pos + i AS pos FROM expanded),
par AS (SELECT n, w, n // w AS h FROM (SELECT count(*) AS n, CAST(floor(sqrt(count(*))) AS BIGINT) AS w FROM orders)),
p0 AS (SELECT customer_id, registration_date, CAST(pos AS BIGINT) AS x FROM positioned),
{rounds}
numbered AS (SELECT customer_id, registration_date, x + 1 AS order_id FROM p{G.ROUNDS})
SELECT order_id, CAST(customer_id AS BIGINT) AS customer_id,
  CAST({first_product} + floor({_sql_u(oid, seed, G.S_PRODUCT)} * {n_products}) AS BIGINT) AS product_id,
  CAST({_sql_uniform_int(oid, seed, G.S_QUANTITY, 1, '11')} AS SMALLINT) AS quantity,
  registration_date + to_days(CAST({rand_days} AS INTEGER)) + to_seconds({rand_secs}) AS order_date
FROM numbered"""


def _sql_benchmark(keys_sql: str, seed=G.DEFAULT_SEED, as_of=G.DEFAULT_AS_OF) -> str:
    k = "id"
    first = _sql_choice(k, seed, G.S_FIRST, G.FIRST_NAMES)
    last = _sql_choice(k, seed, G.S_LAST, G.LAST_NAMES)
    t0, t1 = G._epoch_seconds(G.BENCHMARK_START), G._epoch_seconds(as_of)
    secs = _sql_uniform_int(k, seed, G.S_DATE, t0, str(t1 + 1))
    return f"""SELECT CAST(id AS BIGINT) AS id,
  concat_ws(' ', {first}, {last}) AS name,
  lower({first}) || '.' || lower({last}) || CAST(id AS VARCHAR) || '@' || {_sql_choice(k, seed, G.S_DOMAIN, G.EMAIL_DOMAINS)} AS email,
  round({_sql_uniform_real(k, seed, G.S_AMOUNT, 10.0, 5000.0)}, 2) AS amount,
  TIMESTAMP '1970-01-01 00:00:00' + to_seconds({secs}) AS date,
  {_sql_choice(k, seed, G.S_CATEGORY, G.CATEGORIES)} AS category
FROM ({keys_sql}) keys"""


def oracle_sql() -> dict[str, str]:
    o = {
        "top_customers": _with(_TOP),
        "sales_by_category": _with(_CATEGORY.format(src="enriched")),
        "sales_by_category_unmatched": _with(_CATEGORY.format(src="enriched_reduced")),
        "monthly_trends": _with(_MONTHLY),
        "sales_by_country": _with(_COUNTRY),
        "top_customers_zero_fill": _with("""SELECT customer_id, round(coalesce(sum(revenue), 0.0), 2) AS total_revenue
FROM enriched_reduced WHERE customer_id IS NOT NULL GROUP BY customer_id
ORDER BY total_revenue DESC, customer_id LIMIT 10"""),
        "top_customers_revenue_only": _with("""SELECT customer_id, round(sum(revenue), 2) AS total_revenue
FROM enriched GROUP BY customer_id ORDER BY total_revenue DESC NULLS LAST, customer_id LIMIT 10"""),
        "customer_revenue": _with("""SELECT customer_id, round(sum(revenue), 2) AS total_revenue,
       CAST(sum(quantity) AS BIGINT) AS units_purchased
FROM enriched GROUP BY customer_id"""),
    }
    o["report_job_top_customers"] = o["top_customers"]
    o["report_job_revenue_by_category"] = o["sales_by_category"]
    o["report_job_monthly_sales"] = o["monthly_trends"]
    o["report_job_sales_by_country"] = o["sales_by_country"]
    o["bucketed_customer_revenue"] = o["customer_revenue"]
    o["bucketed_report_job"] = o["sales_by_country"]

    acct_w = f"w AS (SELECT c_custkey AS customer_id, c_acctbal + {_f(1000.0)} AS weight FROM customer)"
    n_lines = "(SELECT count(*) FROM lineitem)"
    o["global_rank"] = """SELECT c_custkey AS customer_id, c_acctbal AS acctbal,
       row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS balance_rank FROM customer"""
    o["running_total"] = """SELECT o_orderkey AS order_id, o_totalprice AS total_price,
       round(sum(o_totalprice) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)
         AS running_total FROM orders"""
    o["skew_allocation"] = f"WITH {acct_w},\n{_sql_allocation('w', 'customer_id', n_lines)}\nSELECT * FROM alloc"
    o["skew_allocation_weight_rule"] = (f"WITH {acct_w},\n{_sql_allocation('w', 'customer_id', n_lines, remainder='weight')}"
                                        "\nSELECT * FROM alloc")
    o["allocation_top_share"] = f"""WITH {acct_w},\n{_sql_allocation('w', 'customer_id', n_lines)}
SELECT count(*) AS n_keys, CAST(sum(order_count) AS BIGINT) AS total_orders,
       CAST(sum(CASE WHEN is_top THEN order_count ELSE 0 END) AS BIGINT) AS top_orders,
       round(CAST(sum(CASE WHEN is_top THEN order_count ELSE 0 END) AS DOUBLE) / CAST(sum(order_count) AS DOUBLE), 6)
         AS top_share
FROM alloc"""
    o["gen_customers"] = _sql_customers("SELECT c_custkey AS customer_id FROM customer")
    o["gen_products"] = _sql_products("SELECT p_partkey AS product_id FROM part")
    o["gen_orders"] = _sql_gen_orders()
    keys = "SELECT c_custkey AS customer_id FROM customer"
    o["gen_order_counts"] = f"""WITH cust AS ({_sql_customers(keys)}),
w AS (SELECT customer_id, {_sql_pareto('customer_id', G.DEFAULT_SEED, G.S_WEIGHT, 1.5, 1.0)} AS weight FROM cust),
{_sql_allocation('w', 'customer_id', '(SELECT count(*) FROM orders)')}
SELECT customer_id, weight_rank, is_top, quota, order_count FROM alloc"""
    o["gen_orders_invariants"] = """SELECT count(*) AS n_rows, count(*) AS distinct_order_ids,
       CAST(1 AS BIGINT) AS min_order_id, count(*) AS max_order_id,
       CAST(0 AS BIGINT) AS orphan_customers, CAST(0 AS BIGINT) AS orphan_products,
       CAST(0 AS BIGINT) AS dates_before_registration, CAST(0 AS BIGINT) AS quantity_out_of_range
FROM orders"""
    o["gen_format_benchmark"] = _sql_benchmark("SELECT event_id AS id FROM events")
    o["scan_customer"] = "SELECT * FROM customer"
    for fmt in ("csv", "parquet", "orc"):
        o[f"format_roundtrip_{fmt}"] = "SELECT * FROM lineitem"
    o["csv_inferred_orders"] = "SELECT * FROM orders"
    o["format_comparison"] = """SELECT f.format, (SELECT count(*) FROM lineitem) AS rows_read, true AS rows_match, true AS has_size,
       true AS has_cpu, true AS has_energy, f.saving AS baseline_saving_pct
FROM (VALUES ('CSV', CAST(0 AS DOUBLE)), ('Parquet', NULL), ('ORC', NULL)) AS f(format, saving)"""
    watts = f"* {_f(65.0)} / {_f(3600.0)}"
    o["metrics_sink"] = f"""SELECT event_type AS format, 'events/' || event_type AS file_path, count(*) / {_f(1048576.0)} AS file_size_mb,
       max(value) AS write_time_s, min(value) AS read_time_s, CAST(NULL AS DOUBLE) AS peak_memory_mb,
       greatest(max(value), min(value)) AS cpu_time_s, max(value) {watts} AS energy_wh
FROM events GROUP BY event_type"""
    o["orders_normalised"] = "SELECT * FROM orders"
    o["line_measures"] = f"""SELECT l_orderkey, l_linenumber, CAST(l_quantity AS SMALLINT) AS units,
       CAST(floor(l_extendedprice) AS BIGINT) AS whole_price, round(l_extendedprice - floor(l_extendedprice), 6) AS price_fraction,
       round_even(l_quantity / 8, 2) AS eighths,
       CAST(date_diff('day', DATE '{EARLY.isoformat()}', CAST(l_shipdate AS DATE)) AS INTEGER) AS days_since,
       CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ship_midnight, concat_ws('/', l_returnflag, l_linestatus) AS flags,
       greatest(l_discount, l_tax) AS larger_rate, printf('%.2f EUR', l_extendedprice) AS price_text,
       l_quantity {watts} AS energy_wh, l_extendedprice / {_f(1048576.0)} AS megabytes
FROM lineitem"""
    o["generate_all"] = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS dataset, count(*) AS n_rows, count(*) AS n_keys, CAST(1 AS BIGINT) AS first_key, count(*) AS last_key FROM {t}"
        for name, t in (("customers", "customer"), ("products", "part"), ("orders", "orders")))
    o["order_shuffle"] = "SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS distance, true AS as_shuffled"
    o["random_streams"] = """SELECT count(*) AS n_keys, count(*) AS distinct_draws, CAST(0 AS BIGINT) AS shared_with_next_seed,
       CAST(0 AS BIGINT) AS shared_with_far_keys, true AS uniform_mean, true AS independent_salts, true AS integer_mean, true AS normal_mean,
       true AS poisson_mean, true AS pareto_tail, true AS category_share
FROM events"""
    # File sizes are read from the sf0.01 folder the correctness run uses.
    size_text = ("CASE WHEN b < 1024 THEN printf('%.2f B', round(b, 2)) "
                 "WHEN b < 1048576 THEN printf('%.2f KB', round(b / 1024.0, 2)) "
                 "WHEN b < 1073741824 THEN printf('%.2f MB', round(b / 1048576.0, 2)) "
                 "WHEN b < 1099511627776 THEN printf('%.2f GB', round(b / 1073741824.0, 2)) "
                 "ELSE printf('%.2f TB', round(b / 1099511627776.0, 2)) END")
    o["dataset_size_lineitem"] = """SELECT CAST(sum(size) AS BIGINT) AS total_bytes, count(*) AS n_files
FROM read_blob('/root/testdata/sf0.01/lineitem.parquet')"""
    o["stored_datasets"] = f"""WITH f AS (
  SELECT regexp_extract(filename, '[^/]+$') AS dataset, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS total_bytes
  FROM read_blob('/root/testdata/sf0.01/*') GROUP BY 1)
SELECT dataset, n_files, total_bytes, {size_text.replace('b ', 'CAST(total_bytes AS DOUBLE) ').replace('(b,', '(CAST(total_bytes AS DOUBLE),').replace('(b /', '(CAST(total_bytes AS DOUBLE) /')} AS size_text
FROM f ORDER BY dataset"""
    ev = f"""WITH ev AS (SELECT event_type, count(*) AS n_events, round(sum(value), 2) AS total_value,
                   round(avg(value), 6) AS avg_value FROM events GROUP BY event_type),
base AS (SELECT max(n_events) AS b_n, max(total_value) AS b_t, max(avg_value) AS b_a FROM ev WHERE event_type = 'view')"""
    pct = lambda b, x: (f"round(CASE WHEN {b} <> 0 THEN (CAST({b} AS DOUBLE) - CAST({x} AS DOUBLE)) / "
                        f"CAST({b} AS DOUBLE) * {_f(100.0)} WHEN {b} = 0 AND {x} IS NOT NULL THEN {_f(0.0)} END, 6)")
    o["compare_to_baseline"] = ev + f"""
SELECT event_type, n_events, total_value, avg_value,
       {pct('b_n', 'n_events')} AS n_events_change_pct,
       {pct('b_t', 'total_value')} AS total_value_change_pct,
       {pct('b_a', 'avg_value')} AS avg_value_change_pct
FROM ev, base"""
    o["reconcile_top_customers"] = _with(""", l AS (
  SELECT customer_id, round(sum(revenue), 2) AS total_revenue FROM enriched GROUP BY customer_id),
r AS (
  SELECT customer_id, round(sum(revenue), 2) AS total_revenue FROM enriched_reduced GROUP BY customer_id)
SELECT coalesce(l.customer_id, r.customer_id) AS customer_id, l.total_revenue AS left_total_revenue,
       r.total_revenue AS right_total_revenue, round(l.total_revenue - r.total_revenue, 6) AS diff_total_revenue,
       CASE WHEN r.customer_id IS NULL THEN 'left_only' WHEN l.customer_id IS NULL THEN 'right_only'
            WHEN l.total_revenue IS NOT DISTINCT FROM r.total_revenue
                 OR abs(l.total_revenue - r.total_revenue) <= 0.0 THEN 'match' ELSE 'differ' END AS status
FROM l FULL OUTER JOIN r ON l.customer_id = r.customer_id""")
    o["reconcile_order_lines"] = _with(""", r AS (
  SELECT order_id, product_id, CASE WHEN product_id % 5 <> 0 THEN quantity END AS quantity FROM model_orders WHERE product_id % 11 <> 0),
b AS (
  SELECT order_id, product_id, quantity, CAST(sum(x) AS BIGINT) AS left_count, CAST(sum(y) AS BIGINT) AS right_count
  FROM (SELECT order_id, product_id, quantity, 1 AS x, 0 AS y FROM model_orders UNION ALL SELECT order_id, product_id, quantity, 0, 1 FROM r) GROUP BY ALL)
SELECT *, CASE WHEN left_count = right_count THEN 'match' WHEN right_count = 0 THEN 'left_only'
               WHEN left_count = 0 THEN 'right_only' ELSE 'differ' END AS status
FROM b""")
    o["enriched_orders_null_safe"] = _with(""", k AS (
  SELECT order_id, customer_id, CASE WHEN product_id % 7 <> 0 THEN product_id END AS product_id, quantity, order_date FROM model_orders),
q AS (
  SELECT CASE WHEN product_id % 997 <> 0 THEN product_id END AS product_id, category, price FROM model_products)
SELECT k.*, q.category, q.price, q.price * k.quantity AS revenue
FROM k LEFT JOIN q ON k.product_id IS NOT DISTINCT FROM q.product_id""")
    o["enriched_orders"] = _with("SELECT * FROM enriched")
    o["customers_model"] = _with("SELECT * FROM model_customers")
    o["orders_with_customer_name"] = _with("""SELECT o.*, c.name
FROM model_orders o LEFT JOIN model_customers c USING (customer_id)""")
    o["orders_per_month"] = _with("""SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS n_lines,
       CAST(sum(quantity) AS BIGINT) AS units FROM model_orders GROUP BY 1""")
    o["table_row_counts"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for t in TABLES)
    o["revenue_long"] = _with(""", cat AS (""" + _CATEGORY.format(src="enriched") + """),
cty AS (""" + _COUNTRY + """)
SELECT 'category' AS dimension, category AS member, total_revenue, units_sold FROM cat
UNION ALL
SELECT 'country' AS dimension, country AS member, total_revenue, units_sold FROM cty""")
    if llm is not None:
        o |= llm.ORACLES
    return o
