"""CSV files whose types are not known beforehand."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstat.sources.files import infer_csv, read_csv_inferred, write_csv


def _write(tmp_dir, **files):
    place = os.path.join(tmp_dir, "csv")
    os.makedirs(place)
    for name, text in files.items():
        with open(os.path.join(place, name + ".csv"), "w", encoding="utf-8") as f:
            f.write(text)
    return place


def test_types_come_from_all_records_of_all_files(spark, tmp_dir):
    many = "".join(f"{i},{i},x{i},2024-01-0{i % 9 + 1},2024-01-15T10:00:0{i % 9}.250000,true,,00{i}\n" for i in range(3000))
    place = _write(tmp_dir, a="id,v,name,d,t,b,none,code\n" + many, b="id,v,name,d,t,b,none,code\n5000000000,1.5,,,,,,\n")
    kinds = {f.name: f.dataType for f in infer_csv(spark, place, texts=["code"]).fields}
    assert kinds == {"id": T.LongType(), "v": T.DoubleType(), "name": T.StringType(), "d": T.DateType(), "t": T.TimestampNTZType(), "b": T.BooleanType(),
                     "none": T.StringType(), "code": T.StringType()}
    rows = read_csv_inferred(spark, place, ["code"])
    assert rows.count() == 3001 and rows.filter("code = '007'").count() == 1
    assert str(rows.filter("id = 7").first().t) == "2024-01-15 10:00:07.250000"
    last = rows.filter("id = 5000000000").first()
    assert (last.v, last.name, last.d) == (1.5, None, None)


def test_session_setting_is_restored(spark, tmp_dir):
    kept = spark.conf.get("spark.sql.timestampType")
    infer_csv(spark, _write(tmp_dir, a="x\n1\n"))
    with pytest.raises(Exception):
        infer_csv(spark, os.path.join(tmp_dir, "nowhere"))
    assert spark.conf.get("spark.sql.timestampType") == kept


def test_a_column_of_mixed_kinds_is_text_and_nothing_is_lost(spark, tmp_dir):
    rows = read_csv_inferred(spark, _write(tmp_dir, a="x,y\n1,1\ntwo,2\n3,\n"))
    assert rows.schema["x"].dataType == T.StringType() and sorted(r.x for r in rows.collect()) == ["1", "3", "two"]


def test_a_short_record_is_an_error(spark, tmp_dir):
    with pytest.raises(Exception):
        read_csv_inferred(spark, _write(tmp_dir, a="x,y\n1,1\n2\n")).collect()


def test_written_and_inferred(spark, tmp_dir):
    df = spark.range(100).select("id", (F.col("id") / 4).alias("v"), F.expr("timestamp_ntz '2024-02-29 23:59:59.000001'").alias("t"), F.lit("é, \"q\"").alias("s"))
    back = read_csv_inferred(spark, write_csv(df, os.path.join(tmp_dir, "out")))
    assert dict(back.dtypes) == {"id": "int", "v": "double", "t": "timestamp_ntz", "s": "string"}
    assert back.exceptAll(df.select(F.col("id").cast("int"), "v", "t", "s")).count() == 0
