import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from fleetlake.session import LOCAL_CONF, checkpoint_dir

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    session = b.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session)
    yield session
    session.stop()
