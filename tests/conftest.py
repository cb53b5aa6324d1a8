import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketmarts.session import build_session

    s = build_session("local[*]", 8, app="marketmarts-tests")
    yield s
    s.stop()


def one(spark, col, **cols):
    """Evaluate a column expression over one row of literal inputs."""
    from pyspark.sql import functions as F

    df = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast(t).alias(k)
                                 for k, (v, t) in cols.items()])
    return df.select(col).first()[0]
