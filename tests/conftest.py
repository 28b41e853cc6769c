import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

from zonecast.session import prepare_session

# Frames built from plain datetimes take the zone of this process.
os.environ["TZ"] = "UTC"
time.tzset()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("zonecast-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield prepare_session(session)
    session.stop()


START = datetime(2024, 3, 4)  # a Monday


def hour(n: int) -> datetime:
    return START + timedelta(hours=n)


@pytest.fixture(scope="session")
def demand(spark):
    """Build hourly demand from (hour number, zone, demand) rows."""
    def build(rows):
        return spark.createDataFrame(
            [(hour(h), z, d) for h, z, d in rows], "hour timestamp, PULocationID int, demand bigint")
    return build


@pytest.fixture(scope="session")
def errors(spark):
    """Build an error table from (hour number, zone, actual, predicted, model) rows."""
    from zonecast.schemas import ERRORS

    def build(rows):
        out = []
        for h, z, actual, predicted, model in rows:
            miss = None if actual is None else float(predicted - actual)
            out.append((hour(h) - timedelta(hours=1), hour(h), z, float(actual), float(predicted), model,
                        miss, abs(miss), miss * miss))
        return spark.createDataFrame(out, ERRORS)
    return build


def explained(df) -> str:
    """The formatted physical plan, not shortened."""
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")
