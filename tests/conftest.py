import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from crawlmeta.session import checkpoint_dir, local_session
    s = local_session("*", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


def one(spark, col_fn, value, schema="v string"):
    """Evaluate a column function on one value."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col_fn("v").alias("out")).first()["out"]
