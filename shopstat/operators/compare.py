"""Comparisons between result tables: against a baseline row (R7) and between two
versions of the same report (R9)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstat.functions.exprs import change_vs_baseline
from shopstat.operators.joins import attach_baseline


# R7 — per metric, (baseline - value) / baseline * 100 for every row, where the
# baseline is the row whose ``key`` equals ``baseline_value``. Metrics listed in
# ``unguarded`` give null (not 0.0) when the baseline metric is 0.
def compare_to_baseline(df: DataFrame, key: str, baseline_value, metrics: Sequence[str],
                        suffix: str = "_change_pct", digits: int | None = 6,
                        unguarded: Sequence[str] = ()) -> DataFrame:
    joined = attach_baseline(df, key, baseline_value, metrics)
    out = []
    for m in metrics:
        pct = change_vs_baseline(F.col("base_" + m), F.col(m), guard_zero=m not in unguarded)
        out.append((F.round(pct, digits) if digits is not None else pct).alias(m + suffix))
    return joined.select(*df.columns, *out)


# R9 — reconcile two result tables on a key: values side by side, their difference,
# and a status per key: match / differ / left_only / right_only.
def reconcile(left: DataFrame, right: DataFrame, key: str, metrics: Sequence[str],
              tolerance: float = 0.0, digits: int | None = 6) -> DataFrame:
    l_ = left.select(F.col(key), F.lit(True).alias("_in_left"), *[F.col(m).alias("left_" + m) for m in metrics])
    r_ = right.select(F.col(key), F.lit(True).alias("_in_right"), *[F.col(m).alias("right_" + m) for m in metrics])
    j = l_.join(r_, key, "full_outer")
    same = F.lit(True)
    cols = [F.col(key)]
    for m in metrics:
        a, b = F.col("left_" + m), F.col("right_" + m)
        diff = a - b
        cols += [a, b, (F.round(diff, digits) if digits is not None else diff).alias("diff_" + m)]
        equal = a.eqNullSafe(b) | (F.abs(diff) <= F.lit(tolerance))
        same = same & F.coalesce(equal, F.lit(False))
    status = (F.when(F.col("_in_right").isNull(), F.lit("left_only"))
              .when(F.col("_in_left").isNull(), F.lit("right_only"))
              .when(same, F.lit("match")).otherwise(F.lit("differ")))
    return j.select(*cols, status.alias("status"))


# R9 with repeated keys — the two tables as bags: how often each row (key and values, nulls equal)
# comes on either side. Both sides are counted in one aggregation, so a repeated key costs its
# distinct rows and never multiplies; status: match / differ / left_only / right_only.
def reconcile_bags(left: DataFrame, right: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    columns = [*keys, *metrics]
    sides = [df.select(*columns, F.lit(a).cast("long").alias("_l"), F.lit(b).cast("long").alias("_r")) for df, a, b in ((left, 1, 0), (right, 0, 1))]
    both = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("_l").alias("left_count"), F.sum("_r").alias("right_count"))
    status = (F.when(F.col("left_count") == F.col("right_count"), "match").when(F.col("right_count") == 0, "left_only")
              .when(F.col("left_count") == 0, "right_only").otherwise("differ"))
    return both.withColumn("status", status)
