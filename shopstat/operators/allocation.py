"""G12 — skewed allocation: split ``total`` units over keys so the top
``top_fraction`` of keys by weight hold ``top_share`` of them, exactly ``total`` in all.

Steps:

1. rank keys by weight (descending, ties by key) — distributed rank (W2);
2. the top max(1, floor(n * top_fraction)) keys are "top"; their weights are scaled
   by m = top_share * S_rest / ((1 - top_share) * S_top) so their share of the
   total weight is ``top_share`` (uniform weights if either sum is not positive);
3. quota = weight / sum(weight) * total, rounded to 6 decimals (so engines that
   differ in the last bits of a sum agree); count = floor(quota);
4. the units still missing, total - sum(count), go one each to the keys with the
   largest remainder (``remainder="fraction"``; found from a histogram of the
   rounded remainders, no second sort of the keys) or the heaviest keys
   (``remainder="weight"``; a second distributed rank); a surplus is taken back
   from the other end.

The global quantities (n, S_top, S_rest, the shortfall and where it is cut) come
from three passes over the checkpointed ranking, each fetched once as scalars and
used as literals, so no pass over the key table is repeated by later actions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstat.operators.ranking import global_row_number

QUOTA_DIGITS = 6


def skewed_allocation(keys: DataFrame, key: str, weight: Column, total: int,
                      top_fraction: float = 0.2, top_share: float = 0.8,
                      remainder: str = "fraction", num_partitions: int | None = None) -> DataFrame:
    if remainder not in ("fraction", "weight"):
        raise ValueError("remainder must be 'fraction' or 'weight'")
    w = keys.select(F.col(key), weight.cast("double").alias("weight"))
    ranked = global_row_number(w, [F.col("weight").desc(), F.col(key).asc()], "weight_rank", num_partitions)

    n_keys = ranked.count()
    top_count = max(1, int(n_keys * float(top_fraction) // 1))
    flagged = ranked.withColumn("is_top", F.col("weight_rank") <= F.lit(top_count))
    s_top, s_rest = flagged.agg(
        F.sum(F.when(F.col("is_top"), F.col("weight")).otherwise(F.lit(0.0))),
        F.sum(F.when(~F.col("is_top"), F.col("weight")).otherwise(F.lit(0.0))),
    ).first()
    s_top, s_rest = s_top or 0.0, s_rest or 0.0
    if s_top <= 0 or s_rest <= 0:
        adjusted = F.lit(1.0)
        w_total = float(n_keys)
    else:
        scale = (float(top_share) * s_rest) / ((1.0 - float(top_share)) * s_top)
        adjusted = F.when(F.col("is_top"), F.col("weight") * F.lit(scale)).otherwise(F.col("weight"))
        w_total = scale * s_top + s_rest

    quotas = flagged.withColumn("adj_weight", adjusted).withColumn(
        "quota", F.round(F.col("adj_weight") / F.lit(w_total) * F.lit(float(total)), QUOTA_DIGITS)
    ).withColumn("base", F.floor("quota")).withColumn(
        "remainder", F.round(F.col("quota") - F.col("base"), QUOTA_DIGITS)
    )
    cut = _remainder_cut(quotas, total) if remainder == "fraction" else None
    if cut is not None:  # a shortfall, located on the remainder histogram in the same pass
        extra = F.when(_first_by_remainder(quotas, key, cut, num_partitions), F.lit(1)).otherwise(F.lit(0))
        out = quotas
    else:
        missing = int(total) - int(quotas.agg(F.sum("base")).first()[0] or 0)
        if missing == 0:
            extra = F.lit(0)
            out = quotas
        else:
            order_col = "remainder" if remainder == "fraction" else "adj_weight"
            if abs(missing) > n_keys:
                raise ValueError(f"the quotas miss the total by {missing}, more than a unit a key: it exceeds double precision")
            # A surplus is taken from the end of the order, where only keys with a unit to give stand.
            order = [F.col(order_col).desc(), F.col(key).asc()]
            if missing < 0:
                order.insert(0, (F.col("base") > 0).cast("int").asc())
            out = global_row_number(quotas, order, "remainder_rank", num_partitions)
            if missing > 0:
                extra = F.when(F.col("remainder_rank") <= F.lit(missing), F.lit(1)).otherwise(F.lit(0))
            else:
                extra = F.when(F.lit(n_keys) - F.col("remainder_rank") + 1 <= F.lit(-missing), F.lit(-1)) \
                    .otherwise(F.lit(0))
    count = (F.col("base") + extra).cast("long")
    return out.select(key, "weight", "weight_rank", "is_top", "quota", count.alias("order_count"))


def _remainder_cut(quotas: DataFrame, total: int):
    """One pass over the keys: a histogram of the rounded remainders (at most 10^6 + 1
    values, whatever the key count) with the floors summed per value. From it, the
    shortfall (total - sum of floors) and the remainder r* at which handing one unit
    to each key in (remainder desc, key asc) order runs out. None when there is no
    shortfall to hand out (none, or a surplus)."""
    hist = quotas.groupBy("remainder").agg(F.count(F.lit(1)).alias("n"), F.sum("base").alias("base_sum"))
    by_remainder = Window.orderBy(F.col("remainder").desc())
    higher = by_remainder.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_remainder.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hist = hist.select(
        "remainder", "n",
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("n_above"),
        (F.lit(int(total)) - F.sum("base_sum").over(everything)).alias("missing"),
    )
    return hist.filter((F.col("n_above") < F.col("missing"))
                       & (F.col("n_above") + F.col("n") >= F.col("missing"))).first()


def _first_by_remainder(quotas: DataFrame, key: str, cut, num_partitions: int | None) -> Column:
    """Condition selecting the first ``missing`` keys in (remainder desc, key asc) order
    without sorting all keys: every key above the cut remainder r*, and among the keys
    tied at r* the smallest ones (only those tied keys are ranked)."""
    r_star, still = cut["remainder"], cut["missing"] - cut["n_above"]
    if still == cut["n"]:
        return F.col("remainder") >= F.lit(r_star)
    tied = quotas.filter(F.col("remainder") == F.lit(r_star)).select(key)
    kth_key = global_row_number(tied, [F.col(key).asc()], "_tie_rank", num_partitions) \
        .filter(F.col("_tie_rank") == still).first()[key]
    return (F.col("remainder") > F.lit(r_star)) | ((F.col("remainder") == F.lit(r_star)) & (F.col(key) <= F.lit(kth_key)))
