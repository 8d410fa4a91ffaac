import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from feedlake.session import get_spark
    s = get_spark("local[4]", app="feedlake-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="feedlake-test-ckpt-")})
    yield s
    s.stop()


def one(spark, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema)


def col_values(df, col):
    return [r[col] for r in df.collect()]
