import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="layerwright-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("layerwright tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("sending_address", T.StringType()),
        T.StructField("receiving_address", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("location_region", T.StringType()),
        T.StructField("ip_prefix", T.StringType()),
        T.StructField("login_frequency", T.IntegerType()),
        T.StructField("session_duration", T.IntegerType()),
        T.StructField("purchase_pattern", T.StringType()),
        T.StructField("age_group", T.StringType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("anomaly", T.StringType()),
    ]
)
SOUND_ROW = {
    "timestamp": 1_700_000_000,
    "sending_address": "s1",
    "receiving_address": "r1",
    "amount": 250.0,
    "transaction_type": "transfer",
    "location_region": "Asia",
    "ip_prefix": "10.0",
    "login_frequency": 4,
    "session_duration": 60,
    "purchase_pattern": "random",
    "age_group": "new",
    "risk_score": 40.0,
    "anomaly": "low_risk",
}


@pytest.fixture(scope="session")
def rows(spark):
    """rows({"amount": 0.0}, {}) makes a frame of sound rows with these changes."""

    def make(*changes):
        data = [tuple({**SOUND_ROW, **change}[f] for f in SOURCE_SCHEMA.names) for change in changes]
        return spark.createDataFrame(data, SOURCE_SCHEMA)

    return make
