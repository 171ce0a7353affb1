import re
import time
from datetime import timedelta
from uuid import uuid4

import pytest
from pyspark.sql import types as T

from outpour import Conversion, FirstParty, create_ledger_table, partial, run_retrying_stream, run_stream
from outpour.errors import send_error
from outpour.streaming import retries
from tests.senders import accepting, logging_sender, refusing, requests_in

CONTEXT = FirstParty("adv")
MEMBER = "id_type string, id_value string, segment_name string"


def arrive(spark, folder, *ids):
    spark.createDataFrame([("TDID", i, "s") for i in ids], MEMBER).write.mode("append").parquet(folder)


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "sent").mkdir()
    return {name: str(tmp_path / name) for name in ("in", "out", "checkpoint", "sent")}


def stream(spark, folders, factory, **options):
    rows = spark.readStream.schema(MEMBER).parquet(folders["in"])
    return run_stream(rows, CONTEXT, factory, folders["out"], folders["checkpoint"], **options)


def test_every_arrival_is_delivered_once(spark, folders):
    sender = logging_sender(folders["sent"])
    for ids in (["a", "b"], ["c"], []):
        if ids:
            arrive(spark, folders["in"], *ids)
        stream(spark, folders, sender).awaitTermination()
    sent = sorted(i["tdid"] for r in requests_in(folders["sent"]) for i in r["items"])
    assert sent == ["a", "b", "c"]
    results = spark.read.parquet(folders["out"])
    assert sorted((row["id_value"], row["stream_batch"]) for row in results.collect()) == [("a", 0), ("b", 0), ("c", 1)]
    assert results.filter("success").count() == 3


def test_new_checkpoint_keeps_earlier_results(spark, folders):
    """A new checkpoint starts again at batch 0, beside the results of the earlier one."""
    arrive(spark, folders["in"], "a", "b")
    for n in range(2):
        stream(spark, {**folders, "checkpoint": f"{folders['checkpoint']}{n}"}, accepting).awaitTermination()
    results = spark.read.parquet(folders["out"])
    assert results.count() == 4
    runs = [row["stream_run"] for row in results.select("stream_run").distinct().collect()]
    assert len(runs) == 2 and "None" not in runs


def test_refusal_stops_the_stream(spark, folders):
    arrive(spark, folders["in"], "a")
    with pytest.raises(Exception) as caught:
        stream(spark, folders, refusing).awaitTermination()
    assert send_error(caught.value).status_code == 401


def test_batches_by_key(spark, folders):
    arrive(spark, folders["in"], *[f"v{n}" for n in range(20)])
    sender = logging_sender(folders["sent"])
    stream(spark, folders, sender, key=["id_value"], batch_size=3, trigger={"once": True}).awaitTermination()
    assert all(len(r["items"]) <= 3 for r in requests_in(folders["sent"]))
    assert spark.read.parquet(folders["out"]).filter("success").count() == 20


def retrying(spark, folders, factory, **options):
    rows = spark.readStream.schema(MEMBER).parquet(folders["in"])
    return run_retrying_stream(rows, ["id_value"], CONTEXT, factory, folders["out"], folders["checkpoint"], **options)


def attempts(spark, folders):
    results = spark.read.schema("id_value string, attempt int, success boolean").parquet(folders["out"])
    return sorted((row["id_value"], row["attempt"], row["success"]) for row in results.collect())


def test_failures_are_sent_again_and_copies_are_not(spark, folders):
    ledger = create_ledger_table(spark, f"retry_ledger_{uuid4().hex}")
    options = {"wait": timedelta(0), "attempts": 2, "ledger_table": ledger}
    arrive(spark, folders["in"], "a", "b", "a")
    retrying(spark, folders, failing_all, **options).awaitTermination()
    assert attempts(spark, folders) == [("a", 1, False), ("b", 1, False)]
    arrive(spark, folders["in"], "b", "c")  # b is open
    retrying(spark, folders, accepting, **options).awaitTermination()
    found = [("a", 1, False), ("a", 2, True), ("b", 1, False), ("b", 2, True), ("c", 1, True)]
    assert attempts(spark, folders) == found
    arrive(spark, folders["in"], "a", "c")  # both were delivered
    retrying(spark, folders, accepting, **options).awaitTermination()
    assert attempts(spark, folders) == found
    assert [row[0] for row in spark.table(ledger).orderBy("run_timestamp").select("records_processed").collect()] == [2, 3]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def failing_all():
    return lambda request: partial([(None, "BAD", None)])


def test_nested_rows_are_kept_while_open(spark, folders):
    rows = spark.sql(
        """SELECT 'i' || id order_id, 't' tracking_tag_id, TIMESTAMP '2024-01-01 00:00:00.123456' timestamp_utc,
           array(named_struct('type', 'EUID', 'id', 'e')) user_ids, map('k', array(id)) extra FROM range(3)"""
    )
    rows.write.parquet(folders["in"])
    for factory in (failing_all, logging_sender(folders["sent"])):
        arriving = spark.readStream.schema(rows.schema).parquet(folders["in"])
        run_retrying_stream(
            arriving, ["order_id"], Conversion("p"), factory, folders["out"], folders["checkpoint"], wait=timedelta(0)
        ).awaitTermination()
    items = [item for request in requests_in(folders["sent"]) for item in request["items"]]
    assert sorted(item["order_id"] for item in items) == ["i0", "i1", "i2"]
    assert {(item["timestamp_utc"], str(item["user_id_array"])) for item in items} == {("2024-01-01T00:00:00.123456Z", "[['4', 'e']]")}


def test_used_up_attempts_and_rows_that_cannot_be_sent(spark, folders):
    arrive(spark, folders["in"], "a")
    rows = spark.createDataFrame([("CoreID", "x", "s")], MEMBER)
    rows.write.mode("append").parquet(folders["in"])
    for _ in range(4):
        retrying(spark, folders, failing_all, wait=timedelta(0), attempts=2).awaitTermination()
    assert attempts(spark, folders) == [("a", 1, False), ("a", 2, False), ("x", 1, False)]
    arrive(spark, folders["in"], "a")
    retrying(spark, folders, accepting, wait=timedelta(0), attempts=2).awaitTermination()
    assert attempts(spark, folders)[-2:] == [("a", 2, False), ("x", 1, False)] and ("a", 1, True) in attempts(spark, folders)


def test_timers_send_again_after_the_wait(spark, folders):
    arrive(spark, folders["in"], "a", "b")
    seen = folders["sent"] + "/failed"

    def once():
        def send(request):
            try:
                open(seen, "x").close()
            except FileExistsError:
                return partial([])
            return partial([(None, "BAD", None)])

        return send

    options = {"wait": timedelta(seconds=2), "trigger": {"processingTime": "200 milliseconds"}, "parallelism": 1}
    query = retrying(spark, folders, once, **options)
    try:
        until = time.time() + 90
        while len(attempts(spark, folders)) < 4 and time.time() < until:
            time.sleep(0.5)
    finally:
        query.stop()
    assert attempts(spark, folders) == [("a", 1, False), ("a", 2, True), ("b", 1, False), ("b", 2, True)]
    times = spark.read.parquet(folders["out"]).groupBy("attempt").agg({"processed_timestamp": "max"}).orderBy("attempt")
    first, second = (row[1] for row in times.filter("attempt is not null").collect())
    assert second - first >= timedelta(seconds=2)


def test_key_of_retries_is_checked(spark, folders):
    arrive(spark, folders["in"], "a")
    rows = spark.readStream.schema(MEMBER).parquet(folders["in"])
    with pytest.raises(ValueError, match="nothing"):
        run_retrying_stream(rows, ["nothing"], CONTEXT, accepting, folders["out"], folders["checkpoint"])


def test_keys_share_states(spark, folders, monkeypatch):
    """The number of states does not grow with the keys, and each key is still followed by itself."""
    monkeypatch.setattr(retries, "CELLS", 2)
    ids = [f"k{n}" for n in range(40)]
    arrive(spark, folders["in"], *ids, *ids)
    options = {"wait": timedelta(0), "attempts": 2}

    def odd_ones():
        return lambda request: partial([(n, "BAD", None) for n, item in enumerate(request.items, 1) if re.search(r"[13579]\"", item)])

    first = retrying(spark, folders, odd_ones, **options)
    first.awaitTermination()
    assert first.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    arrive(spark, folders["in"], "k1", "k2", "new")
    retrying(spark, folders, accepting, **options).awaitTermination()
    once = [(one, 1, int(one[1:]) % 2 == 0) for one in ids] + [("new", 1, True)]
    again = [(one, 2, True) for one in ids if int(one[1:]) % 2]
    assert attempts(spark, folders) == sorted(once + again)


class Held:
    """A state and its timers, in memory."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema, ttl):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class At:
    """The time of a micro-batch, or of a timer."""

    def __init__(self, at):
        self.at = at

    def getCurrentProcessingTimeInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentProcessingTimeInMs


def test_keys_of_a_cell_wait_and_are_forgotten_one_by_one():
    schema = T.StructType([T.StructField("v", T.StringType())])
    held, second = Held(), timedelta(seconds=1)
    operator = retries._Attempts(schema, 1, 2 * second, 3, 10 * second)
    operator.init(held)

    def step(at, *rows):
        return [tuple(row) for row in operator.handleInputRows((0,), iter(rows), At(at))]

    def due(at):
        return [tuple(row) for row in operator.handleExpiredTimer((0,), At(at), At(at))]

    nan = float("nan")
    assert step(0, (0, "a", None, None, {"v": "x"}), (0, nan, None, None, {"v": "y"}), (0, nan, None, None, {"v": "z"})) == [("x", 1), ("y", 1)]
    assert step(1000, (0, "a", 1, True, None)) == [] and held.timers == [3000]
    assert step(2000, (0, nan, 1, True, None), (0, "a", None, None, {"v": "w"})) == [] and held.timers == [3000, 4000]
    assert due(3000) == [("x", 2)]
    assert due(4000) == [("y", 2)]
    assert step(5000, (0, "a", 2, False, None)) == []  # delivered
    assert step(13999, (0, nan, None, None, {"v": "y"}), (0, "a", None, None, {"v": "x"})) == []
    assert step(23998, (0, "b", None, None, {"v": "q"})) == [("q", 1)]
    assert step(23999, (0, "a", None, None, {"v": "x"}), (0, nan, None, None, {"v": "y"})) == [("x", 1), ("y", 1)]
    assert step(40000, (0, "a", 1, True, None)) == [] and held.value is None
