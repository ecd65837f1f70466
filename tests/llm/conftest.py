from __future__ import annotations

import pytest


@pytest.fixture()
def table(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)
