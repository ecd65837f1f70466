"""Scratch tables: nothing is left when the driver program ends."""
from __future__ import annotations

import os
import subprocess
import sys

from conftest import ROOT

PROGRAM = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from shopstat.operators.ranking import global_row_number
from shopstat.session import local_session
spark = local_session(2)
spark.sparkContext.setCheckpointDir({folder!r})
df = spark.range(5000).select((F.col("id") % 7).alias("w"), "id")
rank = global_row_number(df, [F.col("w").desc(), F.col("id").asc()], "rk", 4)
assert [r.rk for r in rank.orderBy(F.desc("w"), "id").collect()] == list(range(1, 5001))
base = spark.sparkContext.getCheckpointDir()
print(len(os.listdir(os.path.join(base.removeprefix("file:"), "shopstat-scratch"))))
{end}
"""


def _run(tmp_dir, end):
    folder = os.path.join(tmp_dir, "ckpt")
    out = subprocess.run([sys.executable, "-c", PROGRAM.format(root=ROOT, folder=folder, end=end)], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[-1] == "1"  # the layout is there while its reader may come
    return [os.path.join(r, f) for r, _, fs in os.walk(folder) for f in fs]


def test_nothing_is_left(tmp_dir):
    assert _run(tmp_dir, "") == []


def test_nothing_is_left_after_a_stop(tmp_dir):
    assert _run(tmp_dir, "spark.stop()") == []
