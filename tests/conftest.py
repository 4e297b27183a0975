import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
# annotators defined in tests must be importable by the Python workers
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])

from trackloom.session import local_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "trackloom-tests", "4g")
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over the columns of one literal row."""

    def value(expression, **columns):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()] or [F.lit(1).alias("_")])
        return row.select(expression).first()[0]

    return value


def plan_of(df) -> str:
    import io
    from contextlib import redirect_stdout

    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
