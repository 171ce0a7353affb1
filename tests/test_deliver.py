import json
import os
import subprocess
import sys
import time
from datetime import datetime, timezone
from uuid import uuid4

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from outpour import (
    Conversion,
    FirstParty,
    Request,
    SendError,
    deliver,
    fatal,
    ok,
    partial,
    push,
    server_error,
    transient,
)
from outpour.operators import deliver as deliver_module
from outpour.operators.batches import gather_requests, number_batches
from outpour.operators.deliver import request_key, spread_rows
from tests.senders import accepting, failing_first_item, logging_sender, refusing, requests_in

STATUS = ["success", "error_code", "error_message", "processed_timestamp"]
CONTEXT = FirstParty("adv1", base_url_override="https://example.org")


def members(spark, rows, partitions=1, unknown=None):
    df = spark.range(0, rows, 1, partitions)
    kind = F.when(unknown, F.lit("CoreID")).otherwise("TDID") if unknown is not None else F.lit("TDID")
    return df.select("id", kind.alias("id_type"), F.concat(F.lit("v"), "id").alias("id_value"), F.lit("s").alias("segment_name"))


def run(df):
    return [tuple(row) for row in df.orderBy("id").select("id", *STATUS[:3]).collect()]


def test_batches_of_a_partition(spark, tmp_path):
    df = members(spark, 103, 2)
    delivered = push(df, CONTEXT, logging_sender(str(tmp_path)), batch_size=10, parallelism="source", trace_id="t")
    assert delivered.filter("success").count() == 103
    requests = requests_in(tmp_path)
    assert sorted(len(r["items"]) for r in requests) == [1, 2] + [10] * 10
    sent = [item["tdid"] for r in requests for item in r["items"]]
    assert sorted(sent) == sorted(f"v{n}" for n in range(103))
    assert sorted(r["batch"] for r in requests) == [[p, n] for p in (0, 1) for n in range(6)]
    assert {r["path"] for r in requests} == {"/data/advertiser"}
    assert requests[0]["envelope"]["data_load_trace_id"] == "t"


@pytest.mark.parametrize("records", [1, 7, 10000])
def test_batch_size_does_not_depend_on_arrow_batches(spark, tmp_path, records):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        df = members(spark, 50, 1, F.col("id") % 3 == 0)
        delivered = push(df, CONTEXT, logging_sender(str(tmp_path)), batch_size=4, parallelism="source")
        assert delivered.filter("success").count() == 33
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(len(r["items"]) for r in requests_in(tmp_path)) == [1] + [4] * 8


def test_unknown_identities_are_not_sent(spark, tmp_path):
    df = members(spark, 6, 1, F.col("id").isin(1, 2))
    rows = run(push(df, CONTEXT, logging_sender(str(tmp_path))))
    rejected = (False, "UNKNOWN_ID_TYPE", "not sent: UNKNOWN_ID_TYPE")
    assert rows == [(n, *(rejected if n in (1, 2) else (True, None, None))) for n in range(6)]
    assert sorted(item["tdid"] for r in requests_in(tmp_path) for item in r["items"]) == ["v0", "v3", "v4", "v5"]


def test_long_stretch_of_unknown_identities(spark, tmp_path):
    df = members(spark, 5000, 1, F.col("id").between(1, 4998))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        delivered = push(df, CONTEXT, logging_sender(str(tmp_path)), batch_size=2, parallelism="source")
        assert [row["id"] for row in delivered.filter("success").orderBy("id").collect()] == [0, 4999]
        assert delivered.count() == 5000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_item_error_skips_rejected_rows(spark):
    df = members(spark, 4, 1, F.col("id") == 0)
    rows = run(deliver(df, CONTEXT, failing_first_item, parallelism="source"))
    assert [row[1:3] for row in rows] == [(False, "UNKNOWN_ID_TYPE"), (False, "INVALID_ID"), (True, None), (True, None)]


def by_batch():
    def send(request):
        if request.batch_no == 0:
            return transient("timed out")
        if request.batch_no == 1:
            return server_error(502, "gateway")
        if request.batch_no == 2:
            raise TimeoutError("slow")
        if request.batch_no == 3:
            raise ConnectionResetError("reset")
        return partial([(2, "X", None), (None, None, None)]) if request.batch_no == 4 else ok()

    return send


def test_outcomes(spark):
    expected = [
        *[(False, None, "timed out")] * 2,
        *[(False, "Bad Gateway", "gateway")] * 2,
        *[(False, None, "slow")] * 2,
        *[(False, None, "reset")] * 2,
        (False, None, None),
        (False, "X", None),
        *[(True, None, None)] * 2,
    ]
    for options in ({"parallelism": "source"}, {"key": ["id"], "bucket": F.lit(0)}):
        rows = run(deliver(members(spark, 12), CONTEXT, by_batch, batch_size=2, **options))
        assert [row[1:] for row in rows] == expected


def delivery(send, batch_size):
    return deliver_module._Delivery(lambda: send, uuid4().hex, "p", None, ("{}", "{}"), ("{}", "{}"), batch_size, datetime(2024, 1, 1, tzinfo=timezone.utc))


def numbered_rows(items, batch_no, item_number, bucket=0):
    rows = len(items)
    numbers = [None if number is None else bucket for number in batch_no]
    return (
        pa.array(items, pa.string()),
        pa.array([False] * rows),
        pa.array(numbers, pa.int64()),
        pa.array(batch_no, pa.int64()),
        pa.array(item_number, pa.int32()),
    )


def test_small_batches_come_back_together():
    """The statuses of many batches make one array, with rejected rows and a batch over two reads among them."""
    requests = []

    def send(request):
        requests.append((request.bucket, request.batch_no, len(request.items)))
        return partial([(2, "X", "second"), (9, "Y", "stray")]) if request.batch_no % 2 else ok()

    places = [divmod(place, 5) for place in range(998)]
    rows = [("i", batch, item + 1) for batch, item in places] + [(None, None, None)] * 3
    reads = [numbered_rows(*zip(*part)) for part in (rows[:403], rows[403:])]
    arrays = list(deliver_module._status_of_numbered(delivery(send, 5))(iter(reads)))
    assert [len(array) for array in arrays] == [400, 601]
    assert requests == [(0, n, 5) for n in range(199)] + [(0, 199, 3)]
    found = [row for array in arrays for row in array.to_pylist()]
    failed = [batch % 2 == 1 and item == 1 for batch, item in places]
    assert [row["success"] for row in found] == [not bad for bad in failed] + [None] * 3
    assert [row["error_message"] for row in found] == ["second" if bad else None for bad in failed] + [None] * 3
    assert [row["__strays"] for row in found] == [int(batch % 2 == 1 and item == 0) for batch, item in places] + [0] * 3
    assert {row["processed_timestamp"] for row in found} == {datetime(2024, 1, 1, tzinfo=timezone.utc)}
    assert not any(row["__held"] or row["__stop"] for row in found)


def test_arrays_that_come_back_are_bounded(monkeypatch):
    rows = [("i", *divmod(place, 5)) for place in range(1000)]
    read = numbered_rows(*zip(*[(text, batch, item + 1) for text, batch, item in rows]))
    monkeypatch.setattr(deliver_module, "_RETURNED_ROWS", 100)
    arrays = list(deliver_module._status_of_numbered(delivery(lambda request: ok(), 5))(iter([read])))
    assert [len(array) for array in arrays] == [100] * 9 + [95, 5]  # the last batch might have gone on
    monkeypatch.setattr(deliver_module, "_RETURNED_CHARS", 50)
    arrays = list(deliver_module._status_of_numbered(delivery(lambda request: transient("ten chars!"), 5))(iter([read])))
    assert [len(array) for array in arrays] == [5] * 200


def test_a_stop_among_small_batches():
    """Of one array: the refused batch with its status, the later ones held back, rejected rows neither."""
    rows = [("i", 0, 1), ("i", 0, 2), ("i", 1, 1), ("i", 1, 2), (None, None, None), ("i", 2, 1)]
    send = delivery(lambda request: fatal(401, "no") if request.batch_no == 1 else ok(), 2)
    found = [row for array in deliver_module._status_of_numbered(send)(iter([numbered_rows(*zip(*rows))])) for row in array.to_pylist()]
    assert [row["success"] for row in found] == [True, True, False, False, None, None]
    assert [row["__held"] for row in found] == [False] * 5 + [True]
    assert [row["__stop"] is not None for row in found] == [False, False, True, False, False, True]


def test_refusal_stops_the_run(spark):
    with pytest.raises(SendError) as caught:
        push(members(spark, 5), CONTEXT, refusing, batch_size=2, parallelism="source")
    assert caught.value.status_code == 401
    assert caught.value.response_text == 'no "entry" [/outpour-fatal] here'
    assert caught.value.batch == (0, 0)


def test_refusal_keeps_what_was_sent(spark):
    def factory():
        return lambda request: fatal(403, "no") if request.batch_no == 2 else ok()

    df = members(spark, 9, 1, F.col("id") == 8)
    with pytest.raises(SendError) as caught:
        push(df, CONTEXT, factory, batch_size=2, parallelism="source")
    rows = run(caught.value.results)
    assert [row[0] for row in rows] == [0, 1, 2, 3, 4, 5, 8]
    assert [row[1:3] for row in rows] == [(True, None)] * 4 + [(False, "Forbidden")] * 2 + [(False, "UNKNOWN_ID_TYPE")]


TRIES = """
import os, sys
from uuid import uuid4
from pyspark.sql import SparkSession
from outpour import FirstParty, SendError, fatal, ok, push

folder = sys.argv[1]
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", folder + "/shared").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def factory():
    def send(request):
        with open(f"{folder}/{request.key}-{uuid4().hex}", "w") as file:
            file.write("x" * len(request.items))
        return fatal(401, "expired") if request.batch_no == 3 else ok()
    return send

rows = spark.range(0, 40, 1, 2).selectExpr("id", "'TDID' id_type", "'v' || id id_value", "'s' segment_name")
try:
    push(rows, FirstParty("adv"), factory, batch_size=3, parallelism="source")
except SendError as error:
    sent = error.results.count()
    print("STOPPED", error.status_code, sent, error.results.filter("success").count())
"""


def test_no_batch_is_sent_twice_when_tasks_may_be_repeated(tmp_path):
    """With four tries for each task, a refusal at the fourth batch repeats nothing and loses no result."""
    found = subprocess.run(
        [sys.executable, "-c", TRIES, str(tmp_path)], capture_output=True, text=True, timeout=200, cwd=os.getcwd()
    )
    files = [name for name in os.listdir(tmp_path) if name != "shared"]
    items = sum((tmp_path / name).stat().st_size for name in files)
    assert len({name.split("-")[0] for name in files}) == len(files)
    tasks = sum(1 for name in files) // 4
    assert tasks in (1, 2) and items == 12 * tasks
    assert f"STOPPED 401 {items} {9 * tasks}" in found.stdout, found.stderr[-2000:]


def echoing():
    return lambda request: partial([(None, request.key, None)])


def test_request_keys(spark):
    """The same for the same items in any order, partitioning and run; those of gathered requests."""
    df = members(spark, 300, 3)
    numbers = {"batch_size": 8, "key": ["id"], "bucket": F.expr("id div 50")}
    seen = []
    for frame, trace in ((df, None), (df.repartition(7), "t"), (df.orderBy(F.desc("id")), "u")):
        rows = push(frame, CONTEXT, echoing, trace_id=trace, **numbers).select("id", "error_code").collect()
        seen.append(dict(map(tuple, rows)))
    assert seen[0] == seen[1] == seen[2]
    numbered = number_batches(df, 8, ["id"], F.expr("id div 50"))
    gathered = gather_requests(numbered, CONTEXT, "other", with_key=True)
    assert {row["request_key"] for row in gathered.collect()} == set(seen[0].values())
    assert request_key("/p", "{}", ["a", "b"]) == request_key("/p", "{}", ["b", "a"])
    assert len({request_key("/p", "{}", ["a"]), request_key("/q", "{}", ["a"]), request_key("/p", "{}", ["a", "a"])}) == 3


def breaking():
    def send(request):
        if request.batch_no == 1:
            raise ValueError("broken sender")
        return ok()

    return send


def test_broken_sender_stops_the_run(spark):
    with pytest.raises(SendError, match="broken sender") as caught:
        push(members(spark, 5), CONTEXT, breaking, batch_size=2, parallelism="source")
    assert caught.value.status_code is None and caught.value.batch == (0, 1)


def test_numbered_batches_are_those_of_every_run(spark, tmp_path):
    df = members(spark, 200, 3, F.col("id") % 10 == 0)
    seen = []
    for n, unique_rows in enumerate((False, True, False)):
        folder = tmp_path / str(n)
        folder.mkdir()
        frame = df.repartition(5) if n == 2 else df
        options = {"key": ["id"], "bucket": F.expr("id div 50"), "unique_rows": unique_rows}
        delivered = push(frame, CONTEXT, logging_sender(str(folder)), batch_size=8, **options)
        assert delivered.count() == 200 and delivered.filter("success").count() == 180
        seen.append(sorted((r["batch"], [i["tdid"] for i in r["items"]]) for r in requests_in(folder)))
    assert seen[0] == seen[1] == seen[2]
    assert all(len(items) <= 8 for _, items in seen[0])


def test_one_sequence_of_batches(spark, tmp_path):
    """Under any setting the same batches, of which one is short."""
    df = members(spark, 300, 3, F.col("id") % 10 == 0)
    df = df.unionByName(df.filter("id = 7")).unionByName(df.filter("id = 7"))
    seen = []
    for n, frame in enumerate((df, df.repartition(5))):
        folder = tmp_path / str(n)
        folder.mkdir()
        delivered = push(frame, CONTEXT, logging_sender(str(folder)), batch_size=8, key=["id"], bucket="global", parallelism=3 + n)
        assert delivered.count() == 302 and delivered.filter("success").count() == 272
        seen.append(sorted((r["batch"], [i["tdid"] for i in r["items"]]) for r in requests_in(folder)))
    assert seen[0] == seen[1]
    assert [(batch[1], len(items)) for batch, items in seen[0]] == [(k, 8) for k in range(34)]


def test_numbered_batches_with_hashed_buckets(spark, tmp_path):
    df = members(spark, 300, 3)
    for unique_rows in (False, True):
        folder = tmp_path / str(unique_rows)
        folder.mkdir()
        delivered = push(df, CONTEXT, logging_sender(str(folder)), batch_size=8, key=["id"], unique_rows=unique_rows, parallelism=3)
        assert delivered.filter("success").count() == 300
        sent = [i["tdid"] for r in requests_in(folder) for i in r["items"]]
        assert sorted(sent) == sorted(f"v{n}" for n in range(300))


def test_numbered_batches_of_copies(spark, tmp_path):
    """Copies in several spans, between other rows and rows that are not sent."""
    copies = spark.range(0, 500, 1, 3).selectExpr("7 AS id", "'TDID' AS id_type", "'same' AS id_value", "'s' AS segment_name")
    df = copies.unionByName(members(spark, 60, 2, F.col("id") % 4 == 0))
    delivered = push(df, CONTEXT, logging_sender(str(tmp_path)), batch_size=2, key=["id"], bucket=F.expr("id div 30"))
    assert delivered.count() == 560 and delivered.filter("success").count() == 545
    requests = requests_in(tmp_path)
    sent = [item["tdid"] for r in requests for item in r["items"]]
    assert sorted(sent) == sorted(["same"] * 500 + [f"v{n}" for n in range(60) if n % 4])
    sizes = {tuple(r["batch"]): len(r["items"]) for r in requests}
    assert len(sizes) == len(requests)
    assert set(sizes.values()) <= {1, 2} and list(sizes.values()).count(1) <= 2


def test_columns_named_like_batch_numbers_pass_through(spark):
    df = members(spark, 30).withColumn("bucket", F.lit("mine")).withColumn("batch_no", F.col("id"))
    delivered = push(df, CONTEXT, accepting, batch_size=4, key=["id"])
    assert delivered.filter("success AND bucket = 'mine' AND batch_no = id").count() == 30


def test_sender_is_made_once_per_worker(spark, tmp_path):
    df = members(spark, 400, 16)
    push(df, CONTEXT, logging_sender(str(tmp_path)), batch_size=5, parallelism="source")
    requests = requests_in(tmp_path)
    assert len({r["sender"] for r in requests}) == len({r["pid"] for r in requests})


def test_one_instant_per_batch(spark):
    df = members(spark, 40)
    delivered = push(df, CONTEXT, slow, batch_size=10, parallelism="source")
    moments = delivered.groupBy(F.expr("id div 10")).agg(F.countDistinct("processed_timestamp")).collect()
    assert [row[1] for row in moments] == [1] * 4
    assert delivered.select("processed_timestamp").distinct().count() == 4


def slow():
    def send(request):
        time.sleep(0.01)
        return ok()

    return send


def test_given_instant(spark):
    at = datetime(2024, 3, 4, 5, 6, 7, tzinfo=timezone.utc)
    delivered = deliver(members(spark, 3), CONTEXT, accepting, processed_at=at)
    assert delivered.select(F.unix_seconds("processed_timestamp")).distinct().collect()[0][0] == int(at.timestamp())


def test_conversion_envelope_tells_of_user_ids(spark, tmp_path):
    df = spark.sql(
        """SELECT id, 't' tracking_tag_id, TIMESTAMP '2024-01-01' timestamp_utc,
           CASE WHEN id = 3 THEN array(named_struct('type', 'EUID', 'id', 'e')) END user_ids FROM range(0, 6, 1, 1)"""
    )
    push(df, Conversion("p"), logging_sender(str(tmp_path)), batch_size=2, parallelism="source")
    formats = {r["batch"][1]: r["envelope"].get("user_id_array_metadata_format") for r in requests_in(tmp_path)}
    assert formats == {0: None, 1: ["type", "id"], 2: None}


def test_request_body():
    request = Request("/p", None, CONTEXT.envelope(), ['{"tdid":"a"}', '{"tdid":"b"}'], 0, 0)
    assert json.loads(request.body()) == {**json.loads(CONTEXT.envelope()), "items": [{"tdid": "a"}, {"tdid": "b"}]}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spreading(spark):
    df = members(spark, 100, 3)
    assert spread_rows(df, "source").rdd.getNumPartitions() == 3
    assert spread_rows(df, 5).rdd.getNumPartitions() == 5
    assert spread_rows(df, "auto").rdd.getNumPartitions() == 8
    assert spread_rows(df, None).rdd.getNumPartitions() == 8
    assert "REBALANCE" in plan(spread_rows(df, "rebalance"))
    assert "Exchange" not in plan(deliver(df, CONTEXT, accepting, parallelism="source"))


def test_only_items_go_to_python(spark, tmp_path):
    """Columns that are passed through are not arguments of the Python function."""
    members(spark, 5).withColumn("wide", F.lit("x" * 50)).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    lines = [line for line in plan(deliver(df, CONTEXT, accepting)).split("\n") if "ArrowEvalPython" in line]
    assert len(lines) == 1 and "wide" not in lines[0].split("[pythonUDF0")[0]


def test_batch_size_is_checked(spark):
    with pytest.raises(ValueError):
        deliver(members(spark, 1), CONTEXT, accepting, batch_size=0)
