"""Send batches and put the status of every row beside it.

The rows stay in the JVM. Only the item text of a row (and its batch numbers, if it has some)
goes to Python, through an iterator Arrow function, and only status columns come back;
columns that are passed through are never serialised for Python.

A fatal response does not fail the task that meets it, since Spark would run the task again and send
all its batches once more. It becomes part of the rows: the refused batch has its status, the batches
after it are marked as not sent, and the reason travels to the driver as an observed metric
(``attempt`` and ``record``). So what was sent is stored, once, before the driver raises.
"""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Tuple  # noqa: UP035 - arrow_udf reads the hint by this name
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpour.contracts import STATUS_FIELDS, Context
from outpour.errors import fatal_text, send_error
from outpour.functions.attribution import attribute_batch, count_strays, status_phrase
from outpour.operators.batches import number_batches, shape
from outpour.operators.checks import rejection_reasons
from outpour.operators.conform import conform, quoted
from outpour.sources.session import ship_own_package

DEFAULT_BATCH_SIZE = 1600

# Hidden, so that they cannot clash with the columns of a conformed frame.
_NUMBERS = ("__bucket", "__batch_no", "__item_number")

# What comes back from a task beside the status of a row: whether its batch was held back, why sending
# stopped (first row of a batch), and how many failures named no item of the batch (likewise).
_HELD, _STOP, _STRAYS = "__held", "__stop", "__strays"
_SENT_FIELDS = [
    *STATUS_FIELDS,
    T.StructField(_HELD, T.BooleanType()),
    T.StructField(_STOP, T.StringType()),
    T.StructField(_STRAYS, T.LongType()),
]

# Statuses go back to Spark when so many rows, or characters of their texts, are there.
_RETURNED_ROWS, _RETURNED_CHARS = 4096, 1 << 24

Failure = Tuple[int | None, str | None, str | None]


@dataclass(frozen=True)
class Request:
    """One batch on its way: where to, the envelope, and the items as JSON texts."""

    path: str
    base_url: str | None
    envelope: str
    items: list[str]
    bucket: int
    batch_no: int
    scope: str = ""

    @property
    def key(self) -> str:
        """Names this batch to a destination that drops repeats.

        A digest of the path, the envelope without trace id, and the items in any order: the same for a
        batch of the same items in every try of a task, every run and every partitioning. It tells
        batches apart by content, so a destination that drops repeats by it also drops a second batch of
        equal items; give such rows different contents.
        """
        return request_key(self.path, self.scope or self.envelope, self.items)

    def body(self) -> str:
        """JSON text of the whole request."""
        return f'{self.envelope[:-1]},"items":[{",".join(self.items)}]}}'


@dataclass(frozen=True)
class Outcome:
    """What became of a request; made by the functions below."""

    kind: str
    failed: tuple[Failure, ...] = ()
    status: int | None = None
    message: str | None = None


def ok() -> Outcome:
    """Every item was taken."""
    return Outcome("ok")


def partial(failed: list[Failure]) -> Outcome:
    """Some items failed: (item number or None, error code, message) each."""
    return Outcome("partial", failed=tuple(failed))


def transient(message: str) -> Outcome:
    """No usable response (timeout, broken connection): the batch failed, the run goes on."""
    return Outcome("transient", message=message)


def server_error(status: int, body: str) -> Outcome:
    """The destination broke: the batch failed, the run goes on."""
    return Outcome("server_error", status=status, message=body)


def fatal(status: int, body: str) -> Outcome:
    """The destination refused the request: the run stops with a ``SendError``."""
    return Outcome("fatal", status=status, message=body)


Send = Callable[[Request], Outcome]

_senders: dict[str, Send] = {}

# Why a delivery stopped in this Python worker; its later tasks here send nothing more.
_stopped: dict[str, str] = {}


def request_key(path: str, scope: str, items: list[str]) -> str:
    """Hex SHA-256 of path, scope and the sorted SHA-256 of each item, on lines of their own."""
    digests = sorted(hashlib.sha256(item.encode("utf-8", "surrogatepass")).hexdigest() for item in items)
    return hashlib.sha256("\n".join([path, scope, *digests]).encode()).hexdigest()


def _worker_sender(token: str, factory: Callable[[], Send]) -> Send:
    """The sender of this Python worker: made once per delivery and kept for its later tasks."""
    if token not in _senders:
        _senders.clear()
        _senders[token] = factory()
    return _senders[token]


class _Statuses:
    """Statuses on their way back to Spark, of many batches in one array.

    Every array that comes back is a message of its own, which costs more than the rows of a small batch. An array
    has some thousand rows, and texts far below what one array of them can hold.
    """

    def __init__(self) -> None:
        self.rows, self.chars = 0, 0
        self.success, self.codes, self.messages = [], [], []
        self.moments, self.counts, self.held = [], [], []
        self.stops, self.strays = {}, {}  # by row, of the few that have some

    def add(
        self,
        rows: int,
        places: list[int],
        found: tuple[list, list, list] | None,
        moment: datetime,
        held: bool,
        stop: str | None,
        strays: int,
    ) -> None:
        """The rows of one batch: those at ``places`` have an item, and ``found`` if it was sent."""
        for column, own in zip((self.success, self.codes, self.messages), found or [[None] * len(places)] * 3):
            if len(places) < rows:
                values = [None] * rows
                for place, value in zip(places, own):
                    values[place] = value
                own = values
            column.extend(own)
        if held:
            self.held.extend(self.rows + place for place in places)
        if stop is not None:
            self.stops[self.rows + places[0]] = stop
        if strays:
            self.strays[self.rows + places[0]] = strays
        self.moments.append(moment)
        self.counts.append(rows)
        self.rows += rows
        if found is not None:
            self.chars += sum(len(text) for texts in found[1:] for text in texts if text)
        self.chars += len(stop or "")

    def full(self) -> bool:
        return self.rows >= _RETURNED_ROWS or self.chars >= _RETURNED_CHARS

    def array(self) -> pa.StructArray:
        stops, held, strays = [None] * self.rows, np.zeros(self.rows, bool), np.zeros(self.rows, np.int64)
        for row, stop in self.stops.items():
            stops[row] = stop
        for row, count in self.strays.items():
            strays[row] = count
        held[self.held] = True
        moments = pa.array(self.moments, pa.timestamp("us", "UTC"))
        columns = [
            pa.array(self.success, pa.bool_()),
            pa.array(self.codes, pa.string()),
            pa.array(self.messages, pa.string()),
            moments.take(pa.array(np.repeat(np.arange(len(self.counts)), self.counts))),
            pa.array(held),
            pa.array(stops, pa.string()),
            pa.array(strays),
        ]
        return pa.StructArray.from_arrays(columns, [field.name for field in _SENT_FIELDS])


@dataclass(frozen=True)
class _Delivery:
    """What a task needs to know to send its batches."""

    factory: Callable[[], Send]
    token: str
    path: str
    base_url: str | None
    envelopes: tuple[str, str]  # without and with user ids
    scopes: tuple[str, str]  # the same without trace id
    batch_size: int
    processed_at: datetime | None

    def request(self, items: list[str], with_ids: bool, batch: tuple[int, int]) -> Request:
        return Request(self.path, self.base_url, self.envelopes[with_ids], items, *batch, self.scopes[with_ids])

    def send(
        self,
        texts: list[str | None],
        with_ids: np.ndarray,
        batch: tuple[int | None, int],
        to: _Statuses,
        broken: str | None = None,
    ) -> None:
        """Add the statuses of the rows of one batch to ``to``; rows without an item get a null success.

        Nothing is sent after a fatal response, nor a batch that is ``broken``, which stops the delivery too.
        """
        moment = self.processed_at or datetime.now(timezone.utc)
        places = [place for place, text in enumerate(texts) if text is not None]
        found, held, stop, strays = None, False, None, 0
        if places:
            if broken is not None:
                self._stop(fatal_text(None, broken, batch))
            held = self.token in _stopped
            if not held:
                items = texts if len(places) == len(texts) else [texts[place] for place in places]
                outcome = self._outcome(self.request(items, bool(with_ids.any() and with_ids[places].any()), batch))
                if outcome.kind == "fatal":
                    self._stop(fatal_text(outcome.status, outcome.message or "", batch))
                found = _statuses(outcome, len(items))
                strays = count_strays(outcome.failed, len(items))
            stop = _stopped.get(self.token)
        to.add(len(texts), places, found, moment, held, stop, strays)

    def _stop(self, reason: str) -> None:
        _stopped.clear()
        _stopped[self.token] = reason

    def _outcome(self, request: Request) -> Outcome:
        try:
            return _worker_sender(self.token, self.factory)(request)
        except (TimeoutError, ConnectionError) as error:
            return transient(str(error))
        except Exception as error:
            return Outcome("fatal", message=str(error))


def _statuses(outcome: Outcome, rows: int) -> tuple[list, list, list]:
    if outcome.kind in ("transient", "server_error", "fatal"):
        code = None if outcome.status is None else status_phrase(outcome.status)
        return [False] * rows, [code] * rows, [outcome.message] * rows
    return attribute_batch(outcome.failed, rows)


def _status_of_chunks(delivery: _Delivery):
    """Cut the rows of a partition, as they come, into batches of ``batch_size`` items."""

    def status(batches: Iterator[Tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        size, partition, number = delivery.batch_size, TaskContext.get().partitionId(), 0
        items = with_ids = None  # Spark's settings choose the type of the texts
        for more_items, more_with_ids in batches:
            items = more_items if items is None else pa.concat_arrays([items, more_items])
            with_ids = more_with_ids if with_ids is None else pa.concat_arrays([with_ids, more_with_ids])
            sendable = np.flatnonzero(items.is_valid())
            cuts = list(sendable[size - 1 :: size] + 1)
            # Rejected rows behind the last cut wait with the others: only a partition's last request may be short.
            if len(sendable) == 0:
                cuts.append(len(items))
            end = cuts[-1] if cuts else 0
            texts, flags = items[:end].to_pylist(), _flags(with_ids[:end])
            start, sent = 0, _Statuses()
            for cut in cuts:
                if cut > start:
                    delivery.send(texts[start:cut], flags[start:cut], (partition, number), sent)
                    number += 1
                start = cut
                if sent.full():
                    yield sent.array()
                    sent = _Statuses()
            if sent.rows:
                yield sent.array()
            items, with_ids = items[start:], with_ids[start:]
        if items is not None and len(items):
            sent = _Statuses()
            delivery.send(items.to_pylist(), _flags(with_ids), (partition, number), sent)
            yield sent.array()

    return status


def _status_of_numbered(delivery: _Delivery):
    """Send runs of rows that carry the same batch number."""

    def status(
        batches: Iterator[Tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]],
    ) -> Iterator[pa.Array]:
        names = ["items", "with_ids", "bucket", "batch_no", "item_number"]
        held = None
        for arrays in batches:
            more = pa.RecordBatch.from_arrays(list(arrays), names)
            held = more if held is None else pa.concat_batches([held, more])
            starts = _run_starts(held)
            # The last run may go on in the next rows; rejected rows need not wait for that.
            end = starts[-1] if starts else 0
            if starts and not held["batch_no"][end].is_valid:
                end = held.num_rows
            yield from send_runs(held.slice(0, end), [start for start in starts if start < end])
            held = held.slice(end) if end < held.num_rows else None
        if held is not None:
            yield from send_runs(held, [0])

    def send_runs(rows: pa.RecordBatch, starts: list[int]) -> Iterator[pa.StructArray]:
        ends, sent = [*starts[1:], rows.num_rows], _Statuses()
        texts, flags = rows["items"].to_pylist(), _flags(rows["with_ids"])
        items = rows["item_number"].fill_null(0).to_numpy()
        firsts = rows.select(["bucket", "batch_no"]).take(pa.array(starts, pa.int64()))
        batches = zip(firsts["bucket"].to_pylist(), firsts["batch_no"].to_pylist())
        for start, end, batch in zip(starts, ends, batches):
            if batch[1] is None:
                delivery.send([None] * (end - start), flags[start:end], (-1, -1), sent)
            else:
                in_order = items[start] == 1 and (np.diff(items[start:end]) == 1).all()
                together = in_order and end - start <= delivery.batch_size
                broken = None if together else "the rows of this batch are not together or not in order"
                delivery.send(texts[start:end], flags[start:end], batch, sent, broken)
            if sent.full():
                yield sent.array()
                sent = _Statuses()
        if sent.rows:
            yield sent.array()

    return status


def _flags(with_ids: pa.Array) -> np.ndarray:
    return with_ids.fill_null(False).to_numpy(zero_copy_only=False)


def _run_starts(rows: pa.RecordBatch) -> list[int]:
    """Where a run of equal batch numbers starts."""
    if rows.num_rows == 0:
        return []
    bucket = rows["bucket"].fill_null(-1).to_numpy()
    batch_no = rows["batch_no"].fill_null(-1).to_numpy()
    changes = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(batch_no) != 0)) + 1
    return [0, *changes.tolist()]


def spread_rows(df: DataFrame, parallelism: int | str | None) -> DataFrame:
    """Distribute rows over senders.

    None or ``"auto"`` gives twice the default parallelism or the shuffle partitions, whichever is more, so it
    follows the cluster and its settings and not the number of rows. A number gives exactly that many,
    ``"source"`` leaves the partitions as they are, without a shuffle. ``"rebalance"`` lets Spark even rows
    out by size: a small increment ends up in few full batches of one sender, a big one in bounded partitions.
    """
    if parallelism == "source":
        return df
    if parallelism == "rebalance":
        return df.hint("rebalance")
    if parallelism in (None, "auto"):
        spark = df.sparkSession
        set_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parallelism = max(2 * spark.sparkContext.defaultParallelism, set_partitions)
    return df.repartition(int(parallelism))


def attempt(
    df: DataFrame,
    context: Context,
    sender_factory: Callable[[], Send],
    batch_size: int = DEFAULT_BATCH_SIZE,
    parallelism: int | str | None = None,
    key: list[str] | None = None,
    bucket: Column | int | str | None = None,
    slices: int = 1,
    unique_rows: bool = False,
    trace_id: str | None = None,
    documented_checks: bool = False,
    processed_at: datetime | None = None,
    most_copies: int | None = None,
) -> DataFrame:
    """The rows of ``df`` with their status after delivery, and with the hidden columns that ``record`` takes.

    Without ``key`` each partition is cut into batches as its rows come; ``parallelism`` says
    how rows are spread before that. With ``key`` the batches are those of ``number_batches``
    and the same in every run. Rows that cannot be shaped are not sent; their status says why.

    The result is lazy, and sending happens when it is computed. After a fatal response the tasks of the
    same Python worker send nothing more; other workers stop at the refusal they meet themselves.
    """
    contract, spark = context.contract, df.sparkSession
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    ship_own_package(spark)
    if spark.conf.get("spark.speculation", "false") == "true":
        warnings.warn("spark.speculation is on: batches of slow tasks will be sent twice", stacklevel=2)
    rows = conform(df, contract)
    names = rows.columns
    if key is None:
        ready, extra, status_of = spread_rows(rows, parallelism), [], _status_of_chunks
    else:
        sendable = F.size(rejection_reasons(contract, documented_checks)) == 0
        count = parallelism if isinstance(parallelism, int) else None
        ready = number_batches(
            rows, batch_size, key, bucket, slices, unique_rows, sendable, count, _NUMBERS, True, most_copies
        )
        extra, status_of = _NUMBERS, _status_of_numbered

    delivery = _Delivery(
        sender_factory,
        uuid4().hex,
        contract.path,
        context.base_url_override,
        (context.envelope(trace_id), context.envelope(trace_id, with_user_ids=True)),
        (context.envelope(), context.envelope(with_user_ids=True)),
        batch_size,
        processed_at.replace(tzinfo=processed_at.tzinfo or timezone.utc) if processed_at else None,
    )
    status = F.arrow_udf(status_of(delivery), returnType=T.StructType(_SENT_FIELDS)).asNondeterministic()
    shaped = shape(ready, context, documented_checks)
    sent = shaped.withColumn("_status", status("_item", "_has_ids", *extra))
    rejected = F.size("_reasons") > 0
    reasons = F.concat(F.lit("not sent: "), F.array_join("_reasons", ", "))
    return sent.select(
        *[F.col(quoted(name)) for name in names],
        F.when(rejected, F.lit(False)).otherwise(F.col("_status.success")).alias("success"),
        F.when(rejected, F.col("_reasons")[0]).otherwise(F.col("_status.error_code")).alias("error_code"),
        F.when(rejected, reasons).otherwise(F.col("_status.error_message")).alias("error_message"),
        F.col("_status.processed_timestamp").alias("processed_timestamp"),
        *[F.col(f"_status.{name}").alias(name) for name in (_HELD, _STOP, _STRAYS)],
    )


def deliver(df: DataFrame, context: Context, sender_factory: Callable[[], Send], **options) -> DataFrame:
    """The rows of ``df`` with their status after delivery; ``options`` are those of ``attempt``.

    The result is lazy: write it exactly once, whole. An action that reads no status column sends nothing;
    two actions send twice, and a fatal response fails the task that meets it, which Spark then repeats. ``push``,
    ``run_batch`` and ``run_stream`` take care of all that.
    """
    sent = attempt(df, context, sender_factory, **options)
    raised = F.when(F.col(_STOP).isNotNull(), F.raise_error(F.col(_STOP)).cast("boolean")).otherwise(F.lit(True))
    return sent.filter(raised).drop(_HELD, _STOP, _STRAYS)


@dataclass(frozen=True)
class Recorded:
    """What was seen while the rows of an attempt were written."""

    records: int
    succeeded: int
    held: int
    strays: int
    stop: str | None
    metrics: dict

    def require_all(self) -> None:
        """Raise the ``SendError`` of a delivery that stopped; warn of failures that named no item."""
        if self.strays:
            text = f"responses named {self.strays} items that their batches do not have; these failures were ignored"
            warnings.warn(text, stacklevel=3)
        if self.stop is not None:
            raise send_error(self.stop)


def record(attempted: DataFrame, write: Callable[[DataFrame], None], *metrics: Column) -> Recorded:
    """Write the rows of an ``attempt`` that have a status, and say what was seen.

    Counted above the delivery, in the stage that writes: a task counts once there, however often an
    earlier stage has to be repeated after losing an executor. Rows that were held back are left out.
    """
    seen, went = Observation(), ~F.col(_HELD)
    observed = attempted.observe(
        seen,
        F.count_if(went).alias("__records"),
        F.count_if(went & F.col("success")).alias("__succeeded"),
        F.count_if(~went).alias("__held"),
        F.sum(_STRAYS).alias("__strays"),
        F.max(_STOP).alias("__stop"),
        *metrics,
    )
    write(observed.filter(went).drop(_HELD, _STOP, _STRAYS))
    found = dict(seen.get)
    own = [found.pop(f"__{name}") for name in ("records", "succeeded", "held", "strays", "stop")]
    return Recorded(own[0], own[1], own[2], own[3] or 0, own[4], found)
