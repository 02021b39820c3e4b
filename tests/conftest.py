import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewright.session import remove_scratch, session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests",
        "local[4]",
        {"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    remove_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def text_frame(spark):
    """Frame of text columns from rows; columns may have no rows."""

    def make(columns, rows=()):
        names = columns.split() if isinstance(columns, str) else list(columns)
        return spark.createDataFrame(list(rows), ", ".join(f"`{n}` string" for n in names))

    return make


@pytest.fixture(scope="session")
def apply(spark):
    """Results of a column function over single values."""

    def run(fn, values, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
