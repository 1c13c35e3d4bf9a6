import os

import pytest
from pyspark.sql import SparkSession

os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def one(spark, f, values, kind="string"):
    """f of each value, in order."""
    df = spark.createDataFrame([(k, x) for k, x in enumerate(values)], f"k int, x {kind}")
    return [r[0] for r in df.select("k", f("x").alias("y")).orderBy("k").select("y").collect()]
