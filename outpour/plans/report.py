"""Reports over delivered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def failed_rows(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success"))


def succeeded_rows(results: DataFrame) -> DataFrame:
    return results.filter(F.col("success"))


def totals(results: DataFrame) -> DataFrame:
    """One row: total, succeeded, failed."""
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("success")).alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def status_summary(results: DataFrame) -> DataFrame:
    """Rows per status and error code."""
    return results.groupBy("success", "error_code").agg(F.count(F.lit(1)).alias("rows"))
