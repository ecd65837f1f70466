"""Explicit schemas of the sales model, the generated tables and the results."""
from __future__ import annotations

from pyspark.sql import types as T

# ---- sales model (what the reports read) -----------------------------------
ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.ShortType()),
    T.StructField("order_date", T.TimestampNTZType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("country", T.StringType()),
])

# ---- results ----------------------------------------------------------------
FORMAT_METRICS = T.StructType([
    T.StructField("format", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file_size_mb", T.DoubleType()),
    T.StructField("write_time_s", T.DoubleType()),
    T.StructField("read_time_s", T.DoubleType()),
    T.StructField("peak_memory_mb", T.DoubleType()),
    T.StructField("cpu_time_s", T.DoubleType()),
    T.StructField("energy_wh", T.DoubleType()),
])


# ---- driver tables (TPC-H-like), declared so scans skip footer inference --------
def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()
DRIVER_TABLES = {
    "region": _st(("r_regionkey", _I), ("r_name", _S)),
    "nation": _st(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _st(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D),
                    ("c_mktsegment", _S)),
    "supplier": _st(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _st(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I),
                ("p_retailprice", _D)),
    "orders": _st(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
                  ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _st(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                    ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
                    ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _st(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D),
                  ("props", _S)),
}
