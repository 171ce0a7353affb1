import os

import pytest
from pyspark.sql import SparkSession

import outpour
import workload
from outpour.sources.session import ship_packages


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    tests = os.path.dirname(os.path.abspath(__file__))
    ship_packages(session, os.path.dirname(outpour.__file__), os.path.dirname(workload.__file__), tests)
    return session
