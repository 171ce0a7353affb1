"""Batch mode: deliver the new rows of a table, append their statuses, record the run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from outpour.contracts import RUN_ID, Context
from outpour.errors import ConfigurationError
from outpour.operators.checks import require_sendable
from outpour.operators.conform import conform, missing_columns
from outpour.operators.deliver import Send, attempt, record
from outpour.operators.history import key_hash_columns, skip_delivered
from outpour.operators.increment import last_mark, new_rows
from outpour.operators.keyfilter import look_at
from outpour.sources.tables import append_rows, append_run, require_table, visible_results


@dataclass(frozen=True)
class RunSummary:
    """What a run did. ``mark`` is where the next incremental run starts.

    ``unstamped`` rows have no ``updated_at``, so an increment never takes them; ``ahead`` ones are stamped
    later than the start of the run, so the mark does not reach them and the next run takes them again.
    ``strays`` are failures in responses that named an item outside their batch; they fail no row.
    """

    records: int
    succeeded: int
    failed: int
    mark: datetime | None
    unstamped: int = 0
    ahead: int = 0
    strays: int = 0


def run_batch(
    spark: SparkSession,
    context: Context,
    sender_factory: Callable[[], Send],
    input_table: str,
    output_table: str,
    ledger_table: str | None = None,
    new_rows_only: bool = False,
    since: datetime | None = None,
    feed: str | None = None,
    overlap: timedelta = timedelta(0),
    skip_delivered_by: list[str] | None = None,
    look_back: timedelta | None = None,
    strict: bool = False,
    **options,
) -> RunSummary:
    """Deliver the rows of ``input_table`` and append them with their status to ``output_table``.

    With ``new_rows_only`` only rows with ``updated_at`` after the feed's mark in the ledger are
    taken (all rows in the first run); ``since`` overrides the mark, for a backfill.
    ``overlap`` reaches back before the mark, ``skip_delivered_by`` names the key by which rows
    already delivered, and not changed since (by ``updated_at``), are left out; ``look_back`` bounds
    how old results are read for that. ``options`` are those of ``deliver``.

    One pass: counts and the new mark are observed on the rows as they are written. The mark is
    the largest ``updated_at`` that was read, up to the start of the run, so rows that arrive while
    the run goes on are not missed and a stamp in the future holds nothing up. Where delivered rows
    are left out, they count for the mark too, by a pass over ``updated_at`` alone. Results are
    written before the ledger, so a run that breaks between the two is repeated, not lost. After a fatal
    response the rows of all batches that were sent are in the results, the ledger is left as it was, and
    ``SendError`` is raised: a later run with ``skip_delivered_by`` sends the rest.

    Where output and ledger tables have a run id, results of a run that broke stay out of sight
    (``visible_results``), for ``skip_delivered_by`` too. After a fatal response the run is recorded in the ledger
    under its old mark, so that what was sent is seen.
    """
    if new_rows_only and ledger_table is None:
        raise ConfigurationError("new_rows_only needs a ledger_table")
    if since is not None and not new_rows_only:
        raise ConfigurationError("since has no effect without new_rows_only")
    if ledger_table is not None:
        require_table(spark, ledger_table)
    run_id = _run_id(spark, output_table, ledger_table)
    contract = context.contract
    feed = feed or contract.name
    run_at = datetime.now(timezone.utc)
    mark = last_mark(spark.table(ledger_table), feed) if ledger_table is not None else None

    rows = spark.table(input_table)
    unstamped = 0
    if new_rows_only:
        source, rows = rows, new_rows(rows, contract, since or mark, overlap)
        if since or mark:
            unstamped = source.where(F.col("updated_at").isNull()).count()
    rows = conform(rows, contract)
    if strict:
        require_sendable(rows, contract, options.get("documented_checks", False))

    stamped = not missing_columns(rows, ["updated_at"])
    at = F.col("updated_at") if stamped else F.lit(None).cast("timestamp")
    latest, ahead = F.when(at <= F.lit(run_at), F.unix_micros(at)), (at > F.lit(run_at)).cast("long")
    stamps = [F.max(latest).alias("latest"), F.sum(ahead).alias("ahead")]
    read = {}
    if skip_delivered_by and spark.catalog.tableExists(output_table):
        results = spark.table(output_table)
        if run_id is not None:
            results = visible_results(results, spark.table(ledger_table))
        hashed = key_hash_columns(rows, results, skip_delivered_by)
        if hashed is None:
            seen, read = None, rows.agg(*stamps).first().asDict()
        else:
            also = {"latest": ("max", latest), "ahead": ("sum", ahead)}
            seen = look_at(rows, [F.expr(one) for one in hashed], also, skip_delivered_by)
            read = seen.metrics
        version = "updated_at" if stamped and not missing_columns(results, ["updated_at"]) else None
        since = None if look_back is None else run_at - look_back
        if seen is not None:
            options = {"most_copies": seen.most_copies} | options
        rows = skip_delivered(rows, results, skip_delivered_by, version=version, since=since, seen=seen, keys_first=True)
    attempted = attempt(rows, context, sender_factory, **options)
    own = [] if run_id is None else [F.lit(run_id).alias(RUN_ID.name)]
    done = record(attempted, lambda sent: append_rows(sent.select("*", *own), output_table), *stamps)
    if done.stop is not None and run_id is not None:
        append_run(spark, ledger_table, feed, mark, run_at, done.records, run_id)
    done.require_all()
    seen = done.metrics | read
    if seen["latest"] is not None:
        reached = datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=seen["latest"])
    else:
        reached = None if stamped else run_at
    mark = max((m for m in (mark, reached) if m is not None), default=None)
    if ledger_table is not None:
        append_run(spark, ledger_table, feed, mark, run_at, done.records, run_id)
    failed = done.records - done.succeeded
    return RunSummary(done.records, done.succeeded, failed, mark, unstamped, seen["ahead"] or 0, done.strays)


def _run_id(spark: SparkSession, output_table: str, ledger_table: str | None) -> str | None:
    """A new id for the run, if its results are to carry one."""
    if not spark.catalog.tableExists(output_table) or missing_columns(spark.table(output_table), [RUN_ID.name]):
        return None
    if ledger_table is None or missing_columns(spark.table(ledger_table), [RUN_ID.name]):
        raise ConfigurationError(f"results of {output_table} carry a run id, so a ledger_table with a run id is needed")
    return uuid4().hex
