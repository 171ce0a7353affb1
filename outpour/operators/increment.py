"""Select the rows changed since the last run."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpour.contracts import Contract
from outpour.errors import ContractError
from outpour.operators.conform import missing_columns

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def instant(moment: datetime) -> Column:
    """A timestamp literal; a datetime without zone is taken as UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((aware - _EPOCH) // timedelta(microseconds=1)))


def high_water_marks(ledger: DataFrame) -> DataFrame:
    """The latest ``last_processed_date`` of each feed."""
    return ledger.groupBy("feed").agg(F.max("last_processed_date").alias("last_processed_date"))


def last_mark(ledger: DataFrame, feed: str) -> datetime | None:
    """The latest mark of one feed; None before its first run. Reads one number to the driver."""
    mark = ledger.filter(F.col("feed") == feed).agg(F.unix_micros(F.max("last_processed_date")).alias("mark"))
    micros = mark.first()["mark"]
    return None if micros is None else _EPOCH + timedelta(microseconds=micros)


def new_rows(
    df: DataFrame, contract: Contract, mark: datetime | None, overlap: timedelta = timedelta(0)
) -> DataFrame:
    """Rows whose ``updated_at`` lies after the mark; all rows when there is no mark.

    The comparison is strict, so rows without ``updated_at`` are never selected. ``overlap``
    reaches back before the mark for late rows; pair it with ``history.skip_delivered``. The
    bound is a literal, so the filter reaches the scan.
    """
    if missing_columns(df, ["updated_at"]):
        message = f"{contract.display_name}: increments need the column updated_at"
        raise ContractError(message, ["updated_at"], contract.name)
    return df if mark is None else df.filter(F.col("updated_at") > instant(mark - overlap))
