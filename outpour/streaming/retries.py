"""A stream that sends failed rows again after a wait, and each row once however often it arrives.

For each key is known how often its row was sent, whether that is settled, and the row while it may be needed again. Two
streams meet there: what arrives, and the results that this stream has written itself. A row whose result is a failure
is held until a timer is due and then goes out once more, with its attempt beside it; a key that is open or
was delivered lets no second row pass. State lives in the checkpoint, so all of this goes on after a restart.

A call of the state from Python costs far more than what is done with a row, so keys share states: a hash puts each into
one of ``CELLS``, and a cell is read and written once in a micro-batch, whatever the number of its keys.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from outpour.contracts import Context
from outpour.functions.canonical import is_plain
from outpour.operators.conform import conform, missing_columns, quoted
from outpour.operators.deliver import Send, attempt, record
from outpour.sources.tables import append_run
from outpour.streaming.increments import BATCH_COLUMN, RUN_COLUMN

ATTEMPT = "attempt"

# States that keys share. Part of a checkpoint: with another number its keys are looked for in other states.
CELLS = 1 << 14

# A row that could not be sent will not be sendable later.
SENT = "not coalesce(startswith(error_message, 'not sent: '), false)"

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _hashable(value):
    """A key's value as Spark groups it: what is inside of arrays and structs as tuples, NaN equal to itself."""
    if isinstance(value, dict):
        return tuple(map(_hashable, value.values()))
    if isinstance(value, (list, tuple)):
        return tuple(map(_hashable, value))
    return "NaN" if isinstance(value, float) and value != value else value


class _Open(NamedTuple):
    """What is known of a key: ``due`` and ``changed`` in milliseconds."""

    sent: int
    settled: bool
    due: int | None = None
    values: tuple | None = None
    changed: int = 0


class _Attempts(StatefulProcessor):
    """Hands on the rows that are to be sent now."""

    def __init__(self, row_schema: T.StructType, keys: int, wait: timedelta, attempts: int, remember: timedelta) -> None:
        self._names, self._keys, self._attempts = [*row_schema.names, ATTEMPT], keys, attempts
        self._wait, self._remember = (int(span / timedelta(milliseconds=1)) for span in (wait, remember))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle, self._row = handle, Row(*self._names)
        # Milliseconds after its last change a key is forgotten, and with it what is still open; so is a cell.
        self._state = handle.getValueState("cell", T.StructType([T.StructField("keys", T.BinaryType())]), self._remember)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        cell, waits = self._load(now), False
        # Results first: a row that arrives with them finds its key as they leave it.
        arrived, results = {}, {}
        for row in rows:
            _, *given = row
            one = _hashable(given[: self._keys])
            sent, again, values = given[self._keys :]
            if sent is not None:
                results.setdefault(one, []).append((sent, again))
            elif one not in arrived:
                arrived[one] = tuple(values.values())
        for one in results | arrived:
            state = cell.get(one)
            for sent, retry in sorted(results.get(one, ())):
                if state is None or sent != state.sent or state.settled:
                    continue
                if not retry or sent >= self._attempts:
                    state = _Open(sent if not retry else 0, not retry)
                elif self._wait <= 0:
                    state = _Open(sent + 1, False, values=state.values)
                    yield self._going(state)
                else:
                    state, waits = state._replace(due=now + self._wait), True
            if one in arrived and (state is None or (state.sent == 0 and not state.settled)):
                state = _Open(1, False, values=arrived[one])
                yield self._going(state)
            if state is not None:
                cell[one] = state._replace(changed=now)
        if waits:
            self._handle.registerTimer(now + self._wait)
        self._store(cell)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, until = timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs()
        cell = self._load(now)
        for one, state in cell.items():
            if state.due is not None and state.due <= until:
                cell[one] = _Open(state.sent + 1, False, values=state.values, changed=now)
                yield self._going(cell[one])
        self._store(cell)

    def _load(self, now: int) -> dict[tuple, _Open]:
        """The keys of the cell that are remembered."""
        if not self._state.exists():
            return {}
        known = {one: _Open(*state) for one, state in pickle.loads(self._state.get()[0]).items()}
        return {one: state for one, state in known.items() if state.changed + self._remember > now}

    def _store(self, cell: dict[tuple, _Open]) -> None:
        if cell:
            self._state.update((pickle.dumps({one: tuple(state) for one, state in cell.items()}, 5),))
        elif self._state.exists():
            self._state.clear()

    def _going(self, state: _Open) -> Row:
        return self._row(*state.values, state.sent)

    def close(self) -> None:
        pass


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that a query takes over when it starts."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_retrying_stream(
    rows: DataFrame,
    key: list[str],
    context: Context,
    sender_factory: Callable[[], Send],
    results_path: str,
    checkpoint_path: str,
    wait: timedelta = timedelta(minutes=5),
    attempts: int = 3,
    remember: timedelta = timedelta(days=7),
    retry: str = SENT,
    ledger_table: str | None = None,
    feed: str | None = None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start delivering a streaming frame, failures again after ``wait`` and up to ``attempts`` times in all.

    ``key`` names columns of plain types, not null, that say which rows are the same: while one is open, or after it was delivered, others with its key
    are left out, for as long as the key is remembered (``remember`` after its last change). A row whose
    attempts are used up may come again. ``retry`` is SQL over the columns of results that says which failures are worth it.
    Results are written as by ``run_stream``, each with its ``attempt``; a ledger gets a row for each micro-batch with rows.

    Timers are looked at in every micro-batch, and a query with a recurring trigger has those without new rows too. By default
    everything that is there is delivered, the results of earlier runs are taken up, and the query ends; then what is due is sent when
    there are new rows or results, and with ``wait`` zero as soon as a result is read.
    """
    spark = rows.sparkSession
    shaped = conform(rows, context.contract)
    row_schema = T.StructType([T.StructField(field.name, field.dataType) for field in shaped.schema])
    if missing_columns(shaped, key):
        raise ValueError(f"the frame lacks the key columns {missing_columns(shaped, key)}")
    keys = [row_schema[name] for name in key]
    read = T.StructType([
        *keys,
        T.StructField("success", T.BooleanType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField(ATTEMPT, T.IntegerType()),
    ])
    # So that there is something to read before the first result.
    folder = results_path.rstrip("/")
    spark.createDataFrame([], read).write.mode("overwrite").parquet(f"{folder}/{RUN_COLUMN}=none/{BATCH_COLUMN}=-1")
    results = spark.readStream.schema(read).parquet(folder)

    def keyed(sent: Column, again: Column, own: Column, frame: DataFrame) -> DataFrame:
        # Strings with a collation are compared by it.
        collated = {f.name for f in keys if isinstance(f.dataType, T.StringType) and not is_plain(f.dataType)}
        one = [F.expr(f"collation_key({quoted(name)})") if name in collated else F.col(quoted(name)) for name in key]
        cell = F.pmod(F.xxhash64(*one), F.lit(CELLS)).cast("int").alias("__cell")
        one = [column.alias(f"__key_{place}") for place, column in enumerate(one)]
        return frame.select(cell, *one, sent.cast("int").alias("__sent"), again.alias("__again"), own.alias("__row"))

    # One column, since each is a call for each row in Python.
    own = F.struct(*[F.col(quoted(name)) for name in row_schema.names])
    arriving = keyed(F.lit(None), F.lit(None).cast("boolean"), own, shaped)
    returning = keyed(F.col(ATTEMPT), ~F.col("success") & F.expr(retry), F.lit(None).cast(row_schema), results)
    going = (
        arriving.unionByName(returning)
        .groupBy("__cell")
        .transformWithState(
            _Attempts(row_schema, len(key), wait, attempts, remember),
            T.StructType([*row_schema, T.StructField(ATTEMPT, T.IntegerType())]),
            "Append",
            "ProcessingTime",
        )
    )

    def deliver_batch(batch: DataFrame, batch_id: int) -> None:
        run_at = datetime.now(timezone.utc)
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        target = f"{folder}/{RUN_COLUMN}={query}/{BATCH_COLUMN}={batch_id}"
        attempted = attempt(batch, context, sender_factory, **options)
        done = record(attempted, lambda sent: sent.write.mode("overwrite").parquet(target))
        if ledger_table is not None and done.records:
            append_run(spark, ledger_table, feed or context.contract.name, None, run_at, done.records)
        if done.stop is not None:
            raise RuntimeError(done.stop)

    trigger = trigger or {"availableNow": True}
    ends = bool(trigger.get("availableNow") or trigger.get("once"))
    with _settings(spark, {_PROVIDER: _ROCKSDB, _IDLE_BATCHES: "false" if ends else "true"}):
        return (
            going.writeStream.foreachBatch(deliver_batch)
            .option("checkpointLocation", checkpoint_path)
            .trigger(**trigger)
            .start()
        )
