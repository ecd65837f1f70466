"""Sources and sinks: round trips, nanosecond Parquet, sizes, format comparison,
and the reference's end-to-end smoke (generate, run the report job, four outputs)."""
from __future__ import annotations

import datetime as dt
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shopstat.plans import analytics_job
from shopstat.plans import generate as G
from shopstat.plans.dataset_report import dataset_report
from shopstat.plans.formats import compare_formats, metrics_as_text, roundtrip
from shopstat.sources.files import read_csv, save_metrics, write_csv
from shopstat.sources.storage import stored_bytes_value
from shopstat.sources.tables import _footer_by_hadoop, _footers_in_tasks, file_groups, load_parquet_nanos


def _bench_table(spark, n=2000):
    return G.benchmark_rows_for_keys(spark.range(1, n + 1))


def test_roundtrips_are_lossless(spark, tmp_dir):
    src = _bench_table(spark)
    for fmt in ("csv", "parquet", "orc"):
        back = roundtrip(src, fmt, os.path.join(tmp_dir, f"t.{fmt}"))
        assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in src.schema]
        assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_csv_keeps_microseconds_and_smallint(spark, tmp_dir):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 5, 6, 7, 8, 9, 123456))], "q smallint, ts timestamp_ntz")
    path = write_csv(df, os.path.join(tmp_dir, "x.csv"))
    assert read_csv(spark, path, df.schema).collect() == df.collect()


def test_nanosecond_parquet_is_normalised(spark, tmp_dir):
    path = os.path.join(tmp_dir, "nanos.parquet")
    pdf = pd.DataFrame({"id": [1, 2, 3], "ts": pd.to_datetime(["2024-01-02 03:04:05.123456789",
                                                                "1999-12-31 23:59:59.000000000",
                                                                "2262-04-11 23:47:16.854775807"])})
    pdf["ts"] = pdf["ts"].astype("datetime64[ns]")
    pdf.to_parquet(path, engine="pyarrow", index=False)
    df = load_parquet_nanos(spark, path)
    assert dict(df.dtypes)["ts"] == "timestamp_ntz"
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(1, dt.datetime(2024, 1, 2, 3, 4, 5, 123456)), (2, dt.datetime(1999, 12, 31, 23, 59, 59)),
                   (3, dt.datetime(2262, 4, 11, 23, 47, 16, 854775))]


def _part(folder, name, ids, stamps, unit, **more):
    os.makedirs(folder, exist_ok=True)
    kind = pa.timestamp(unit, more.pop("tz", None))
    table = pa.table({"id": pa.array(ids, pa.int64()), "ts": pa.array(stamps, pa.int64()).cast(kind), **more})
    pq.write_table(table, os.path.join(folder, name), version="2.6", coerce_timestamps=None)


def test_files_of_several_writers(spark, tmp_dir):
    """An empty first file, nanoseconds, microseconds, a zoned column, a bigint that is no time, a
    column that one file alone has, and odd characters in the folder's name."""
    folder = os.path.join(tmp_dir, "mixed [a] {b}")
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    micros = int(at.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000 + 123456
    _part(folder, "a.parquet", [], [], "us")
    _part(folder, "b.parquet", [1, None], [micros * 1000 + 789, None], "ns")
    _part(folder, "c.parquet", [2], [micros], "us")
    _part(folder, "d e.parquet", [3], [micros], "us", tz="UTC")
    _part(folder, "f.parquet", [4], [-1], "ns", extra=pa.array([7], pa.int64()))
    df = load_parquet_nanos(spark, folder.replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}"))
    assert df.dtypes == [("id", "bigint"), ("ts", "timestamp_ntz"), ("extra", "bigint")]
    rows = sorted((tuple(r) for r in df.collect()), key=lambda r: r[0] or 0)
    assert rows == [(None, None, None), (1, at, None), (2, at, None), (3, at, None), (4, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), 7)]
    assert df.filter("id = 2").count() == 1 and spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false") == "false"


def test_several_writers_under_partition_folders(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "parts")
    for k, unit in ((1, "us"), (2, "ns"), (10, "ns")):
        _part(os.path.join(folder, f"k={k}"), "x.parquet", [k * 100], [10**9], unit)
    rows = sorted(tuple(r) for r in load_parquet_nanos(spark, folder).select("id", "ts", "k").collect())
    second, later = dt.datetime(1970, 1, 1, 0, 0, 1), dt.datetime(1970, 1, 1, 0, 16, 40)
    assert rows == [(100, later, 1), (200, second, 2), (1000, second, 10)]


def test_footers_that_only_the_driver_can_read(spark, tmp_dir):
    """A scheme that Arrow does not know: the same columns by Spark's own file system."""
    _part(tmp_dir, "n.parquet", [1], [5], "ns", other=pa.array([1], pa.int64()))
    uri = "file://" + os.path.join(tmp_dir, "n.parquet")
    (files, names, nanos), = file_groups(spark, [uri])
    assert (files, names, nanos) == ([uri], {"id", "ts", "other"}, {"ts"})
    assert [set(x) for x in _footer_by_hadoop(spark, uri)[1:]] == [names, nanos]
    unknown = pa.RecordBatch.from_arrays([pa.array(["viewfs://store/n.parquet"])], names=["uri"])
    assert [b.to_pylist() for b in _footers_in_tasks([unknown])] == [[{"uri": "viewfs://store/n.parquet", "layout": None, "names": None, "nanos": None}]]


def test_sizes_and_dataset_report(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store", "x", "store")  # the root's name repeats in its own path
    _bench_table(spark).write.parquet(os.path.join(root, "a.parquet"))
    _bench_table(spark, 10).coalesce(1).write.parquet(os.path.join(root, "b.parquet"))
    files = []
    for base, _, names in os.walk(root):
        files += [os.path.join(base, n) for n in names if not n.startswith((".", "_"))]
    assert stored_bytes_value(spark, root) == sum(os.path.getsize(f) for f in files)
    rep = {r.dataset: r for r in dataset_report(spark, root).collect()}
    assert set(rep) == {"a.parquet", "b.parquet"}
    assert rep["b.parquet"].n_files == 1 and rep["b.parquet"].size_text.endswith(("B", "KB"))


def test_format_comparison(spark, tmp_dir):
    metrics = compare_formats(_bench_table(spark), tmp_dir, metrics_path=os.path.join(tmp_dir, "metrics.csv"))
    rows = {r["format"]: r for r in metrics.collect()}
    assert set(rows) == {"CSV", "Parquet", "ORC"}
    assert rows["CSV"]["storage_saving_pct"] == 0.0 and rows["CSV"]["write_improvement_pct"] == 0.0
    assert rows["Parquet"]["file_size_mb"] < rows["CSV"]["file_size_mb"]
    assert rows["Parquet"]["storage_saving_pct"] > 0
    saved = spark.read.option("header", "true").csv(os.path.join(tmp_dir, "metrics.csv"))
    assert saved.count() == 3 and "energy_saving_pct" in saved.columns
    text = {r["Format"]: r for r in metrics_as_text(metrics).collect()}
    assert text["CSV"]["Storage Savings (%)"] == "0.00" and text["CSV"]["Energy (Wh)"] is not None
    for r in rows.values():
        assert r["cpu_time_s"] > 0 and r["energy_wh"] == pytest.approx(r["cpu_time_s"] * 65 / 3600)
    assert rows["CSV"]["energy_saving_pct"] == 0.0 and rows["ORC"]["energy_saving_pct"] is not None


def test_metrics_sink_column_names(spark, tmp_dir):
    m = spark.createDataFrame([("CSV", "x", 1.0)], "format string, file_path string, file_size_mb double")
    path = save_metrics(m, os.path.join(tmp_dir, "m.csv"))
    assert spark.read.option("header", "true").csv(path).columns == ["format", "file_path", "file_size_mb"]


def test_generate_then_run_analytics(spark, tmp_dir):
    raw, processed = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "processed")
    G.generate_all(spark, raw, n_customers=500, n_products=100, n_orders=2000, seed=42)
    paths = analytics_job.run_analytics(spark, raw, processed)
    for stored in ("revenue_by_category", "top_customers", "monthly_sales", "sales_by_country"):
        assert os.path.exists(os.path.join(processed, f"{stored}.parquet"))
    top = spark.read.parquet(paths["top_customers"])
    assert top.count() == 10
    assert spark.read.parquet(paths["sales_by_category"]).agg(F.sum("units_sold")).first()[0] == \
        spark.read.parquet(os.path.join(raw, "orders.parquet")).agg(F.sum("quantity")).first()[0]


def test_run_analytics_on_pandas_written_tables(spark, tmp_dir):
    """Inputs as a pandas/pyarrow generator writes them: int32 ids, int16 quantity,
    nanosecond timestamps, a product id with no product."""
    raw, processed = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "processed")
    os.makedirs(raw)
    pd.DataFrame({"customer_id": pd.array([1, 2], dtype="int32"), "name": ["a", "b"],
                  "country": ["France", "Kenya"],
                  "registration_date": pd.to_datetime(["2023-01-01", "2023-02-01"]).astype("datetime64[ns]")}) \
        .to_parquet(os.path.join(raw, "customers.parquet"), index=False)
    pd.DataFrame({"product_id": pd.array([1, 2], dtype="int32"), "name": ["x", "y"],
                  "category": ["Books", "Home"], "price": [10.0, 25.0]}) \
        .to_parquet(os.path.join(raw, "products.parquet"), index=False)
    pd.DataFrame({"order_id": pd.array([1, 2, 3, 4], dtype="int64"),
                  "customer_id": pd.array([1, 1, 2, 2], dtype="int32"),
                  "product_id": pd.array([1, 2, 1, 99], dtype="int32"),
                  "quantity": pd.array([2, 1, 1, 5], dtype="int16"),
                  "order_date": pd.to_datetime(["2024-01-15 10:00:00.000000001", "2024-01-20 00:00:00.000000000",
                                                "2024-03-01 00:00:00.000000000", "2024-03-02 23:59:59.000000000"])
                  .astype("datetime64[ns]")}) \
        .to_parquet(os.path.join(raw, "orders.parquet"), index=False)
    paths = analytics_job.run_analytics(spark, raw, processed)
    monthly = [tuple(r) for r in spark.read.parquet(paths["monthly_trends"]).orderBy("month").collect()]
    assert monthly == [("2024-01", 45.0, None, None), ("2024-03", 10.0, 45.0, -77.777778)]
    country = {r.country: (r.total_revenue, r.units_sold) for r in spark.read.parquet(paths["sales_by_country"]).collect()}
    assert country == {"France": (45.0, 3), "Kenya": (10.0, 6)}


def test_materialised_model_feeds_the_report_job(spark, tmp_dir):
    from conftest import SMALL_DIR
    from shopstat.operators import reports as R
    from shopstat.sources import model
    raw, processed = os.path.join(tmp_dir, "model"), os.path.join(tmp_dir, "processed")
    model.write_model(spark, SMALL_DIR, raw)
    paths = analytics_job.run_analytics(spark, raw, processed)
    direct = R.sales_by_country(model.orders(spark, SMALL_DIR), model.products(spark, SMALL_DIR),
                                model.customers(spark, SMALL_DIR))
    got = spark.read.parquet(paths["sales_by_country"])
    assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0


def test_declared_driver_schemas_match_the_files(spark):
    from conftest import SMALL_DIR
    from shopstat.schemas import DRIVER_TABLES
    for name, declared in DRIVER_TABLES.items():
        inferred = spark.read.parquet(os.path.join(SMALL_DIR, f"{name}.parquet")).schema
        assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in declared], name


def test_plain_bigints_zones_and_the_flag_are_left_alone(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mixed.parquet")
    pd.DataFrame({"ts": pd.to_datetime(["2024-01-02 03:04:05.000000999"]).astype("datetime64[ns]"), "seconds": [1_700_000_000],
                  "zoned": pd.to_datetime(["2024-01-02 03:04:05"], utc=True).astype("datetime64[us, UTC]")}).to_parquet(path, index=False)
    flag, zone = "spark.sql.legacy.parquet.nanosAsLong", spark.conf.get("spark.sql.session.timeZone")
    before = spark.conf.get(flag, None)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = load_parquet_nanos(spark, path)
        assert spark.conf.get(flag, None) == before
        moment = dt.datetime(2024, 1, 2, 3, 4, 5)
        assert [tuple(r) for r in df.collect()] == [(moment, 1_700_000_000, moment)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_money_is_exact_for_any_partitioning(spark):
    from shopstat.operators import reports as R
    rows = spark.range(200_000)
    orders = rows.select(F.col("id").alias("order_id"), (F.col("id") % 2).alias("customer_id"), (F.col("id") % 3).alias("product_id"),
                         F.lit(2).cast("smallint").alias("quantity"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("order_date"))
    products = spark.createDataFrame([(0, "a", 100_000.01), (1, "b", 99_999_999.99), (2, "c", 0.37)], "product_id long, category string, price double")
    cents = {"a": 66_667 * 2 * 10_000_001, "b": 66_667 * 2 * 9_999_999_999, "c": 66_666 * 2 * 37}
    for parts in (1, 7):
        df = orders.repartition(parts)
        assert R.monthly_trends(df, products).first()["month_revenue"] == sum(cents.values()) / 100
        assert {r.category: r.total_revenue for r in R.sales_by_category(df, products).collect()} == {k: c / 100 for k, c in cents.items()}
