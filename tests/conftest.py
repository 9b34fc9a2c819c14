import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from landfall.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "landfall-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column expression over given single values."""
    from pyspark.sql import types as T

    def run(expression, values, dtype):
        schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", dtype)])
        df = spark.createDataFrame(list(enumerate(values)), schema)
        rows = df.select("i", expression("x").alias("y")).orderBy("i").collect()
        return [r.y for r in rows]

    return run


def plan_text(df) -> str:
    """The physical plan as Spark prints it."""
    from contextlib import redirect_stdout
    from io import StringIO

    out = StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
