"""Command line: the four jobs of the original project, run on Spark.

    python -m shopstat generate  --out DIR [--customers N --products N --orders N --seed S]
    python -m shopstat analytics (--raw DIR | --bucketed DIR) --processed DIR [--top N]
    python -m shopstat formats   --out DIR [--rows N]
    python -m shopstat compare   --raw DIR [--top N]
    python -m shopstat model     --tables DIR --out DIR
    python -m shopstat bucket    --raw DIR --out DIR [--buckets N]

``generate`` stores customers/products/orders and prints the stored-dataset report;
``analytics`` writes the four reports; ``formats`` runs the CSV/Parquet/ORC
comparison and stores the metrics CSV; ``compare`` reconciles the top customers
under Spark null rules with the zero-fill (pandas) rules on the same orders;
``model`` materialises the sales model from TPC-H-like tables (lineitem, orders,
part, customer, nation) in the raw layout the other commands read; ``bucket`` stores
such a layout bucketed by product, for reports that shuffle no order line.
Uses the active session if there is one (e.g. under spark-submit).
"""
from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import SparkSession

from shopstat.operators import reports as R
from shopstat.operators.compare import reconcile
from shopstat.plans import analytics_job, generate
from shopstat.plans.dataset_report import dataset_report
from shopstat.plans.formats import compare_formats, metrics_as_text
from shopstat.sources import model
from shopstat.sources.bucketed import bucket_model
from shopstat.sources.tables import load_parquet_nanos


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from shopstat.session import local_session
    return local_session()


def _read_sales(spark: SparkSession, raw: str):
    orders = load_parquet_nanos(spark, os.path.join(raw, "orders.parquet"))
    products = spark.read.parquet(os.path.join(raw, "products.parquet"))
    return orders, products


def main(argv=None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="shopstat")
    sub = p.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate")
    g.add_argument("--out", required=True)
    g.add_argument("--customers", type=int, default=100_000)
    g.add_argument("--products", type=int, default=10_000)
    g.add_argument("--orders", type=int, default=1_000_000)
    g.add_argument("--seed", type=int, default=generate.DEFAULT_SEED)
    a = sub.add_parser("analytics")
    source = a.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw")
    source.add_argument("--bucketed")
    a.add_argument("--processed", required=True)
    a.add_argument("--top", type=int, default=10)
    f = sub.add_parser("formats")
    f.add_argument("--out", required=True)
    f.add_argument("--rows", type=int, default=500_000)
    c = sub.add_parser("compare")
    c.add_argument("--raw", required=True)
    c.add_argument("--top", type=int, default=10)
    m = sub.add_parser("model")
    m.add_argument("--tables", required=True)
    m.add_argument("--out", required=True)
    b = sub.add_parser("bucket")
    b.add_argument("--raw", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--buckets", type=int)
    args = p.parse_args(argv)
    spark = spark or _session()

    if args.cmd == "generate":
        t0 = time.perf_counter()
        generate.generate_all(spark, args.out, args.customers, args.products, args.orders, args.seed)
        print(f"Generated in {time.perf_counter() - t0:.2f} s")
        dataset_report(spark, args.out).show(truncate=False)
    elif args.cmd == "analytics":
        run, source = (analytics_job.run_analytics, args.raw) if args.raw else (analytics_job.run_bucketed, args.bucketed)
        paths = run(spark, source, args.processed, args.top)
        for name, path in paths.items():
            print(name, "->", path)
            spark.read.parquet(path).show(truncate=False)
    elif args.cmd == "formats":
        table = generate.benchmark_rows_for_keys(generate.key_range(spark, args.rows, "id"))
        metrics = compare_formats(table, args.out, metrics_path=os.path.join(args.out, "benchmark_results.csv"))
        metrics_as_text(metrics).show(truncate=False)
    elif args.cmd == "compare":
        orders, products = _read_sales(spark, args.raw)
        left = R.top_customers_revenue_only(orders, products, args.top)
        right = R.top_customers_zero_fill(orders, products, args.top)
        reconcile(left, right, "customer_id", ["total_revenue"]).orderBy("customer_id").show(truncate=False)
    elif args.cmd == "model":
        for name, path in model.write_model(spark, args.tables, args.out).items():
            print(name, "->", path)
    elif args.cmd == "bucket":
        print("bucketed model ->", bucket_model(spark, args.raw, args.out, args.buckets))


if __name__ == "__main__":
    main()
