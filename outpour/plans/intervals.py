"""Batch mode without a mark: deliver what lies in intervals of time that are not covered yet, late rows among it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from outpour.contracts import Context
from outpour.errors import ConfigurationError
from outpour.operators.conform import conform
from outpour.operators.deliver import Send, attempt, record
from outpour.operators.history import skip_delivered
from outpour.operators.increment import instant
from outpour.operators.intervals import open_cells, rows_of
from outpour.plans.batch import RunSummary
from outpour.sources.session import written
from outpour.sources.tables import append_rows, require_table

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def run_intervals(
    spark: SparkSession,
    context: Context,
    sender_factory: Callable[[], Send],
    input_table: str,
    output_table: str,
    coverage_table: str,
    row_key: list[str],
    feed: str | None = None,
    grain: timedelta = timedelta(hours=1),
    **options,
) -> RunSummary:
    """Deliver the rows of ``input_table`` that have no result yet, and append them with their status to ``output_table``.

    The first pass reads ``row_key`` and ``updated_at`` and finds the cells of time, ``grain`` wide, that are not in
    ``coverage_table`` or hold other rows than then. Only those are read, and of the results only the same stretch of time. Of a
    cell that was covered before, rows with a result for their key and ``updated_at`` are left out, whether they succeeded
    or not (``retry_set`` has the failures), so a late row is sent once wherever it falls, and rows stamped in
    the future are not sent twice. Rows without a stamp are never sent and are counted.

    The cells go into ``coverage_table`` after the results. A run that breaks before leaves its cells open, and so does a
    fatal response (``SendError``): the next run sends the rest. Rows that arrive between the two passes are sent, and
    their cell is looked at once more. The summary has no ``mark``; ``intervals`` tells what is covered.
    """
    if grain < timedelta(microseconds=1):
        raise ConfigurationError("grain must be a positive time")
    for name in (input_table, coverage_table):
        require_table(spark, name)
    contract = context.contract
    feed, run_at = feed or contract.name, datetime.now(timezone.utc)
    rows, coverage = spark.table(input_table), spark.table(coverage_table)
    found = written(open_cells(rows, coverage, contract, row_key, feed, grain), "open-cells")
    stamped = found.filter(F.col("from_date").isNotNull())
    seen = found.agg(
        F.unix_micros(F.min("from_date")).alias("first"),
        F.unix_micros(F.max("to_date")).alias("last"),
        F.sum(F.when(F.col("from_date").isNull(), F.col("records"))).alias("unstamped"),
    ).first()
    first, last = (_EPOCH + timedelta(microseconds=seen[name] or 0) for name in ("first", "last"))
    rows = conform(rows_of(rows, stamped, grain, first, last), contract)
    if spark.catalog.tableExists(output_table):
        settled = spark.table(output_table)
        settled = settled.filter((F.col("updated_at") >= instant(first)) & (F.col("updated_at") < instant(last)))
        rows = skip_delivered(rows, settled.withColumn("success", F.lit(True)), row_key, version="updated_at")
    done = record(attempt(rows, context, sender_factory, **options), lambda sent: append_rows(sent, output_table))
    done.require_all()
    covered = stamped.select(F.lit(feed).alias("feed"), "*", instant(run_at).alias("run_timestamp"))
    append_rows(covered, coverage_table)
    return RunSummary(
        done.records, done.succeeded, done.records - done.succeeded, None, seen["unstamped"] or 0, 0, done.strays
    )
