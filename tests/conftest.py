import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session
    s = build_session("quarry-tests", "*", 8, driver_memory="4g")
    yield s
    s.stop()


def one(spark, expr, **cols):
    """Evaluate a Column expression over a one-row DataFrame of named literal columns."""
    from pyspark.sql import Row
    df = spark.createDataFrame([Row(**cols)]) if cols else spark.range(1)
    return df.select(expr.alias("v")).first()["v"]
