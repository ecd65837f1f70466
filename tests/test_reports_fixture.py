"""Hand-computed edge fixture: unknown product, unknown customer, a month gap,
a null revenue group. Expected rows worked out by hand (see FIXTURES.md §4)."""
from __future__ import annotations

import datetime as dt

import pytest

from shopstat import schemas
from shopstat.operators import reports as R
from shopstat.plans import analytics_job


@pytest.fixture(scope="module")
def tables(spark):
    ts = dt.datetime
    orders = spark.createDataFrame([
        (1, 1, 1, 2, ts(2024, 1, 15, 10, 0, 0)),
        (2, 1, 2, 1, ts(2024, 1, 20, 0, 0, 0)),
        (3, 2, 1, 1, ts(2024, 3, 1, 0, 0, 0)),
        (4, 2, 99, 5, ts(2024, 3, 2, 23, 59, 59)),
        (5, 3, 98, 3, ts(2024, 3, 5, 12, 0, 0)),
    ], schemas.ORDERS)
    products = spark.createDataFrame([(1, "p1", "Books", 10.0), (2, "p2", "Home", 25.0)], schemas.PRODUCTS)
    customers = spark.createDataFrame([(1, "c1", "France"), (2, "c2", "Kenya")], schemas.CUSTOMERS)
    return orders, products, customers


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_top_customers(tables):
    o, p, _ = tables
    assert rows(R.top_customers_by_revenue(o, p)) == [(1, 45.0, 3), (2, 10.0, 6), (3, None, 3)]


def test_sales_by_category(tables):
    o, p, _ = tables
    assert rows(R.sales_by_category(o, p)) == [("Books", 30.0, 3), ("Home", 25.0, 1), (None, None, 8)]


def test_monthly_trends(tables):
    o, p, _ = tables
    assert rows(R.monthly_trends(o, p)) == [("2024-01", 45.0, None, None), ("2024-03", 10.0, 45.0, -77.777778)]


def test_sales_by_country(tables):
    o, p, c = tables
    assert rows(R.sales_by_country(o, p, c)) == [("France", 45.0, 3), ("Kenya", 10.0, 6), (None, None, 3)]


def test_zero_fill(tables):
    o, p, _ = tables
    assert rows(R.top_customers_zero_fill(o, p)) == [(1, 45.0), (2, 10.0), (3, 0.0)]


def test_revenue_only(tables):
    o, p, _ = tables
    assert rows(R.top_customers_revenue_only(o, p)) == [(1, 45.0), (2, 10.0), (3, None)]


def test_orders_without_a_date_form_the_last_month(spark):
    ts = dt.datetime
    o = spark.createDataFrame([(1, 1, 1, 3, ts(2024, 1, 1)), (2, 1, 1, 2, None)], schemas.ORDERS)
    p = spark.createDataFrame([(1, "a", "Books", 10.0)], schemas.PRODUCTS)
    assert rows(R.monthly_trends(o, p)) == [("2024-01", 30.0, None, None), (None, 20.0, None, None)]


def test_unknown_customers_stay_in_the_lookup(tables):
    from shopstat.operators.joins import lookup_customer_attribute

    o, _, c = tables
    got = lookup_customer_attribute(o, c, "name").collect()
    assert len(got) == 5 and {r.name for r in got if r.customer_id == 3} == {None}


def test_missing_baseline_is_an_error_and_unmeasured_is_null(spark):
    from shopstat.operators.compare import compare_to_baseline

    df = spark.createDataFrame([("a", 4.0, None), ("b", 3.0, None), ("z", None, 1.0)], "k string, m double, e double")
    with pytest.raises(ValueError):
        compare_to_baseline(df, "k", "none", ["m"])
    got = {r.k: (r.m_change_pct, r.e_change_pct) for r in compare_to_baseline(df, "k", "a", ["m", "e"]).collect()}
    assert got == {"a": (0.0, None), "b": (25.0, None), "z": (None, None)}


def test_month_with_zero_previous_revenue(spark):
    ts = dt.datetime
    o = spark.createDataFrame([(1, 1, 1, 1, ts(2024, 1, 1)), (2, 1, 2, 1, ts(2024, 2, 1))], schemas.ORDERS)
    p = spark.createDataFrame([(1, "a", "Books", 0.0), (2, "b", "Books", 5.0)], schemas.PRODUCTS)
    assert rows(R.monthly_trends(o, p)) == [("2024-01", 0.0, None, None), ("2024-02", 5.0, 0.0, None)]


def test_report_job_matches_reports(spark, tables, tmp_dir):
    o, p, c = tables
    paths = analytics_job.write_reports(o, p, c, tmp_dir)
    assert set(paths) == {"top_customers", "sales_by_category", "monthly_trends", "sales_by_country"}
    assert sorted(rows(spark.read.parquet(paths["top_customers"])), key=str) == sorted(
        rows(R.top_customers_by_revenue(o, p)), key=str)
    assert sorted(rows(spark.read.parquet(paths["sales_by_category"])), key=str) == sorted(
        rows(R.sales_by_category(o, p)), key=str)
    assert sorted(rows(spark.read.parquet(paths["monthly_trends"])), key=str) == sorted(
        rows(R.monthly_trends(o, p)), key=str)
    assert sorted(rows(spark.read.parquet(paths["sales_by_country"])), key=str) == sorted(
        rows(R.sales_by_country(o, p, c)), key=str)
    for stored in ("revenue_by_category", "top_customers", "monthly_sales", "sales_by_country"):
        assert any(v.endswith(f"{stored}.parquet") for v in paths.values())
