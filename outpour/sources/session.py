"""What a delivery needs from the session: a shared folder, and the package on the workers."""

from __future__ import annotations

import os
import shutil
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from outpour.errors import ConfigurationError


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for intermediate results in the folder the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ConfigurationError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder()
    return f"{folder.rstrip('/')}/{name}-{uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="outpour-")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: what uses them does not run their plan again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_packages(spark: SparkSession, *folders: str) -> None:
    """Put package folders on the Python path of the executors, once per session.

    For running from a source checkout: the driver hands the zipped folders to Spark, which copies
    them to the executors. Where the packages are installed on the cluster or given with
    ``--py-files`` this is not needed.
    """
    context = spark.sparkContext
    for folder in folders:
        parent, package = os.path.split(os.path.abspath(folder))
        shipped = f"{package}-{context.applicationId}.zip"
        if any(path.endswith(shipped) for path in context.listFiles):
            continue
        base = os.path.join(tempfile.mkdtemp(prefix="outpour-zip-"), shipped.removesuffix(".zip"))
        context.addPyFile(shutil.make_archive(base, "zip", parent, package))


def ship_own_package(spark: SparkSession) -> None:
    """Ship this package where it runs from a source checkout; an installed one is on the executors already."""
    folder = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if "site-packages" not in folder and "dist-packages" not in folder and not folder.endswith(".zip/outpour"):
        ship_packages(spark, folder)
