"""The command line, run in-process on the test session."""
from __future__ import annotations

import os

from conftest import SMALL_DIR

import pandas as pd

from shopstat.__main__ import main


def test_compare_reads_pandas_files_in_a_fresh_session(spark, tmp_dir, capsys):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    pd.DataFrame({"product_id": pd.array([1], dtype="int32"), "name": ["x"], "category": ["Books"], "price": [10.0]}).to_parquet(
        os.path.join(raw, "products.parquet"), index=False)
    pd.DataFrame({"order_id": [1, 2], "customer_id": pd.array([1, 2], dtype="int32"), "product_id": pd.array([1, 99], dtype="int32"),
                  "quantity": pd.array([2, 1], dtype="int16"), "order_date": pd.to_datetime(["2024-01-15", "2024-01-16"]).astype("datetime64[ns]")}
                 ).to_parquet(os.path.join(raw, "orders.parquet"), index=False)
    fresh = spark.newSession()
    assert fresh.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false") == "false"
    main(["compare", "--raw", raw], fresh)
    assert "match" in capsys.readouterr().out


def test_generate_analytics_compare_formats_model(spark, tmp_dir, capsys):
    raw, processed = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "processed")
    main(["generate", "--out", raw, "--customers", "200", "--products", "30", "--orders", "1000"])
    main(["analytics", "--raw", raw, "--processed", processed])
    for stored in ("revenue_by_category", "top_customers", "monthly_sales", "sales_by_country"):
        assert os.path.exists(os.path.join(processed, f"{stored}.parquet"))
    main(["compare", "--raw", raw, "--top", "5"])
    main(["formats", "--out", os.path.join(tmp_dir, "fmt"), "--rows", "300"])
    assert os.path.exists(os.path.join(tmp_dir, "fmt", "benchmark_results.csv"))
    main(["model", "--tables", SMALL_DIR, "--out", os.path.join(tmp_dir, "model")])
    out = capsys.readouterr().out
    assert "Generated in" in out and "status" in out and "Storage Savings (%)" in out and "orders ->" in out
