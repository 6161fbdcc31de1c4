import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gridpulse.config import Pipeline  # noqa: E402
from gridpulse.session import job_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("gridpulse-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def pipeline(spark):
    return Pipeline(root=shared_folder(spark, "test")).backfill()


@pytest.fixture
def session(spark, pipeline):
    return job_session(spark, pipeline)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
