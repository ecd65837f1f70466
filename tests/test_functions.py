"""Column functions (P, F, A7 rows) on literal inputs."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shopstat.functions import exprs as X


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_text_functions(spark):
    assert one(spark, X.capitalize_first(F.lit("hELLO world")), X.drop_last_char(F.lit("Clothing")),
               X.join_words(F.lit("Blue"), F.lit("Hom")), X.fixed_text(F.lit(1.23456), 3, " s"),
               X.fixed_text(F.lit(None).cast("double"), 2)) == \
        ("Hello world", "Clothin", "Blue Hom", "1.235 s", None)


def test_human_size(spark):
    got = one(spark, *[X.human_size(F.lit(v)) for v in (512, 1536, 1152, 5 * 1024 ** 2, 3 * 1024 ** 3, 2 * 1024 ** 4)])
    assert got == ("512.00 B", "1.50 KB", "1.13 KB", "5.00 MB", "3.00 GB", "2.00 TB")


def test_growth_and_baseline(spark):
    assert one(spark, X.growth_pct(F.lit(10.0), F.lit(45.0)), X.growth_pct(F.lit(5.0), F.lit(0.0)),
               X.change_vs_baseline(F.lit(200.0), F.lit(50.0)), X.change_vs_baseline(F.lit(0.0), F.lit(5.0)),
               X.change_vs_baseline(F.lit(0.0), F.lit(5.0), guard_zero=False)) == \
        (-77.77777777777779, None, 75.0, 0.0, None)


def test_numeric_helpers(spark):
    got = one(spark, X.clip(F.lit(95), 18, 90), X.clip(F.lit(3), 18, 90), X.fractional(F.lit(2.75)),
              X.floor_of(F.lit(-1.5)), X.round_to(F.lit(2.5), 0), X.round_to(F.lit(2.5), 0, half_even=True),
              X.larger_of(F.lit(3.0), F.lit(7.0)), X.energy_wh(F.lit(3600.0)), X.bytes_to_mb(F.lit(1024 ** 2)),
              X.narrow(F.lit(7), "smallint"))
    assert got == (90, 18, 0.75, -2, 3.0, 2.0, 7.0, 65.0, 1.0, 7)


def test_dates(spark):
    ts = F.lit(dt.datetime(2024, 3, 2, 23, 59, 59)).cast("timestamp_ntz")
    got = one(spark, X.month_label(X.month_start(ts)), X.days_between(F.lit(dt.date(2024, 3, 10)), ts),
              X.add_days_seconds(ts, F.lit(1), F.lit(2)), X.epoch_seconds_to_ntz(F.lit(86_401)),
              X.epoch_micros_to_ntz(F.lit(1_500_000)), X.to_ntz(F.lit(dt.date(2024, 1, 1))))
    assert got == ("2024-03", 8, dt.datetime(2024, 3, 4, 0, 0, 1), dt.datetime(1970, 1, 2, 0, 0, 1),
                   dt.datetime(1970, 1, 1, 0, 0, 1, 500000), dt.datetime(2024, 1, 1))


def test_revenue_null_propagation(spark):
    assert one(spark, X.revenue(F.lit(None).cast("double"), F.lit(2)), X.revenue(F.lit(2.5), F.lit(4))) == \
        (None, 10.0)
