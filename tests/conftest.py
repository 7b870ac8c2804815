import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from tallygraph.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", partitions=4, memory="4g")


@pytest.fixture(scope="session")
def column(spark):
    """Values of ``fn(col)`` over a list of inputs, in input order."""
    def run(values, fn, kind="string"):
        from pyspark.sql import functions as F
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("r")).collect()]
    return run
