"""Written intermediate tables, and filters of keys that are broadcast."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import outpour
from outpour.operators.keyfilter import KeyFilter, look_at
from outpour.sources.session import shared_path, ship_packages

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, and batches of texts for Python small, if the session sets no size."""
    ship_packages(spark, os.path.dirname(os.path.abspath(outpour.__file__)))
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(4 << 20))


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that made them has been written, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the folder that all executors share.

    Cuts the lineage: what reads the table does not depend on executors that are lost later.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    with _shuffles_freed(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def gate(keys: DataFrame) -> KeyFilter:
    """A filter of the keys with false positives only, as large as the keys are many (and bounded, see ``keyfilter``)."""
    return look_at(keys, [F.col(column) for column in keys.columns])


def gated(df: DataFrame, keys: KeyFilter, columns: list[Column], flag: str) -> DataFrame:
    """Adds whether the key of a row may be among those of the gate, without a shuffle of the rows."""
    return keys.marked(df, columns, flag)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing will read again."""
    for table in tables:
        jvm, context = table.sparkSession._jvm, table.sparkSession._jsc
        path = jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(context.hadoopConfiguration()).delete(path, True)
