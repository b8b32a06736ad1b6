import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from biblink.session import REQUIRED_CONF, ensure_checkpoint_dir

    b = (SparkSession.builder.master("local[*]").appName("biblink-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def fx(spark):
    from biblink.plans.fixtures import Fixtures

    return Fixtures(spark, SF001)


def one_col(spark, values, name="x", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")
