"""Ad hoc mode: deliver a frame and get it back with statuses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from outpour.contracts import Context, result_schema
from outpour.errors import SendError
from outpour.operators.checks import require_sendable
from outpour.operators.conform import conform
from outpour.operators.deliver import Send, attempt, record
from outpour.sources.session import shared_path


def push(
    df: DataFrame,
    context: Context,
    sender_factory: Callable[[], Send],
    results_path: str | None = None,
    strict: bool = False,
    **options,
) -> DataFrame:
    """Deliver ``df`` now and return its columns plus the status of each row.

    The results are written once, to ``results_path`` or to a new folder under
    spark.checkpoint.dir, and read back: using them any number of times, or losing an executor
    afterwards, sends nothing again, and no row passes through the driver. ``strict`` raises
    before anything is sent if some row cannot be; otherwise such rows come back as failed.
    After a fatal response nothing more is sent, the results hold the rows of all batches that were sent,
    the refused one included, and ``SendError`` is raised, with ``results`` to read them.
    ``options`` are those of ``deliver``.
    """
    if strict:
        require_sendable(conform(df, context.contract), context.contract, options.get("documented_checks", False))
    path = results_path or shared_path(df.sparkSession, "push")
    attempted = attempt(df, context, sender_factory, **options)
    recorded = record(attempted, lambda rows: rows.write.parquet(path))
    schema = result_schema(conform(df, context.contract).schema)
    results = df.sparkSession.read.schema(schema).parquet(path)
    try:
        recorded.require_all()
    except SendError as error:
        error.results = results
        raise
    return results
