"""What a feed has delivered, as intervals of time, and which of them hold rows that were not there.

A mark says that everything up to an instant was read, so a row that arrives late below it is lost, or looked for by reading
again what lies before the mark. Here a ledger has one row for each cell of time (``grain`` wide) that a run read: how many
rows it held, and a digest of their keys and stamps in any order. A cell whose rows are others now is open. Runs read
open cells alone, however far back these are; neighbouring cells together are the intervals that are covered.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpour.contracts import Contract
from outpour.errors import ContractError
from outpour.functions.canonical import canonical
from outpour.operators.conform import missing_columns, quoted
from outpour.operators.increment import instant

_CELL = ["from_date", "to_date"]


def _start(stamp: Column, grain: timedelta) -> Column:
    """The start of a stamp's cell in microseconds; exact, also before 1970."""
    micros = F.unix_micros(stamp)
    return micros - F.pmod(micros, F.lit(grain // timedelta(microseconds=1)))


def cells(rows: DataFrame, contract: Contract, key: list[str], grain: timedelta) -> DataFrame:
    """from_date, to_date (exclusive), records and digest of each cell that holds rows; one of nulls for those without a stamp.

    Reads the key and ``updated_at`` alone, and is reduced to one row per cell before it is shuffled. The digest is made of the number of
    rows, the exclusive or of their hashes and a sum of these, so it does not depend on their order.
    """
    absent = missing_columns(rows, [*key, "updated_at"])
    if absent:
        raise ContractError(f"{contract.display_name}: intervals need the columns {absent}", absent, contract.name)
    stamp = F.col("updated_at")
    parts = [canonical(F.col(quoted(name)), rows.select(quoted(name)).schema[0].dataType) for name in key]
    hashed = rows.select(_start(stamp, grain).alias("start"), F.xxhash64(*parts, stamp).alias("hash"))
    found = hashed.groupBy("start").agg(
        F.count(F.lit(1)).alias("records"),
        F.bit_xor("hash").alias("folded"),
        F.sum(F.pmod("hash", F.lit(1 << 31))).alias("total"),
    )
    return found.select(
        F.timestamp_micros("start").alias("from_date"),
        F.timestamp_micros(F.col("start") + F.lit(grain // timedelta(microseconds=1))).alias("to_date"),
        "records",
        F.xxhash64("records", "folded", "total").alias("digest"),
    )


def _latest(coverage: DataFrame) -> DataFrame:
    """The last record of each cell of each feed."""
    last = F.max_by(F.struct("records", "digest"), F.struct("run_timestamp", "records", "digest"))
    return coverage.groupBy("feed", *_CELL).agg(last.alias("last")).select("feed", *_CELL, "last.*")


def open_cells(
    rows: DataFrame, coverage: DataFrame, contract: Contract, key: list[str], feed: str, grain: timedelta
) -> DataFrame:
    """The cells of ``rows`` that the feed has not covered, or not with these rows. As ``cells``."""
    known = _latest(coverage.filter(F.col("feed") == feed)).select(*_CELL, "digest")
    return cells(rows, contract, key, grain).join(known, [*_CELL, "digest"], "left_anti")


def rows_of(rows: DataFrame, found: DataFrame, grain: timedelta, first: datetime, last: datetime) -> DataFrame:
    """The rows whose stamp lies in a cell of ``found``, all of which lie between two instants.

    The instants reach the scan; the cells are few (one for each ``grain`` of time at most), so Spark broadcasts them.
    """
    within = (F.col("updated_at") >= instant(first)) & (F.col("updated_at") < instant(last))
    starts = found.select(F.unix_micros("from_date").alias("__cell"))
    marked = rows.filter(within).withColumn("__cell", _start(F.col("updated_at"), grain))
    return marked.join(starts, "__cell", "left_semi").drop("__cell")


def intervals(coverage: DataFrame) -> DataFrame:
    """The disjoint intervals that each feed has covered: feed, from_date, to_date (exclusive), records, in place of one mark.

    Cells that touch or overlap are one interval (cells of runs with different grains may overlap; then
    records counts rows of both). An empty ledger has none. One row per cell is what is sorted.
    """
    by_start = Window.partitionBy("feed").orderBy(*_CELL)
    reached = F.max("to_date").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    begins = (reached.isNull() | (F.col("from_date") > reached)).cast("int")
    numbered = _latest(coverage).withColumn("begins", begins)
    numbered = numbered.withColumn("island", F.sum("begins").over(by_start))
    whole = numbered.groupBy("feed", "island").agg(
        F.min("from_date").alias("from_date"), F.max("to_date").alias("to_date"), F.sum("records").alias("records")
    )
    return whole.drop("island")
