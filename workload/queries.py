"""Every registered query, by the name of its check SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpour import contracts as C
from outpour.errors import SendError
from outpour.functions.attribution import RESPONSE_TYPE
from outpour.functions.identity import identity_field
from outpour.operators import history
from outpour.operators.attribute import attribute, stray_items
from outpour.operators.batches import gather_requests, number_batches, shape
from outpour.operators.checks import quarantine, rejection_reasons
from outpour.operators.conform import conform, drop_hidden
from outpour.operators.deliver import deliver
from outpour.operators.increment import high_water_marks, last_mark, new_rows
from outpour.operators.intervals import intervals
from outpour.plans import report
from outpour.plans.batch import run_batch
from outpour.plans.intervals import run_intervals
from outpour.plans.push import push
from outpour.sources import tables
from outpour.sources.session import shared_path
from outpour.sources.tables import (
    append_rows,
    create_coverage_table,
    create_input_table,
    create_ledger_table,
    create_output_table,
)
from outpour.streaming.increments import run_stream
from outpour.streaming.retries import run_retrying_stream
from workload import senders
from workload.fixtures import MEMBERSHIPS, conversions, line_conversions, memberships, prepare, subject_requests, times

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

FIRST_PARTY = C.FirstParty("adv1", "prov1")
THIRD_PARTY = C.ThirdParty("prov1")
CONVERSION = C.Conversion("prov1", (C.DataOrigin("crm", "Partner"),))
DSR = [
    C.DsrAdvertiser("adv1", C.RequestType.OPT_OUT),
    C.DsrThirdParty("prov1", C.RequestType.DELETION),
    C.DsrMerchant(7, C.RequestType.DELETION),
]
SENT_AT = datetime(2024, 2, 1, 12, 0, 0)
SENT_AGAIN_AT = datetime(2024, 2, 2, 12, 0, 0)

STATUS = ["event_id", "success", "error_code", "error_message", "processed_timestamp"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _block(key: str):
    """Bucket of a numbered batch: blocks of ids, which stay bounded however many there are."""
    return F.expr(f"{key} div 500")


def _by_event() -> dict:
    return {"batch_size": 25, "key": ["event_id"], "bucket": _block("event_id"), "processed_at": SENT_AT}


# --- contracts ---------------------------------------------------------------------------------


@query
def conform_first_party(spark, sf_dir):
    return times(conform(memberships(spark, sf_dir), FIRST_PARTY.contract), "timestamp_ntz")


@query
def conform_third_party(spark, sf_dir):
    rows = memberships(spark, sf_dir).drop("timestamp_utc", "base_bid_cpm", "base_bid_cpm_metadata")
    return times(conform(rows, THIRD_PARTY.contract), "timestamp_ntz")


@query
def conform_dsr(spark, sf_dir):
    rows = subject_requests(spark, sf_dir).withColumn("_batch_id", F.lit(1))
    conformed = [conform(rows, dsr.contract).withColumn("contract", F.lit(dsr.contract.name)) for dsr in DSR]
    return conformed[0].unionByName(conformed[1]).unionByName(conformed[2])


@query
def conform_conversion(spark, sf_dir):
    rows = conform(conversions(spark, sf_dir), CONVERSION.contract)
    nested = ["user_ids", "line_items", "privacy_settings"]
    sizes = [F.when(F.col(n).isNotNull(), F.size(n)).alias(f"{n}_size") for n in nested]
    plain = [F.col(n) for n in rows.columns if n not in nested]
    return times(rows.select(*plain, *sizes, F.to_json("user_ids").alias("user_ids")), "timestamp_ntz")


@query
def conform_conversion_lines(spark, sf_dir):
    """Nested columns with all of their contents."""
    rows = conform(line_conversions(spark, sf_dir), CONVERSION.contract)
    nested = [F.to_json(n).alias(n) for n in ("line_items", "privacy_settings")]
    return rows.select("l_orderkey", "l_linenumber", *nested, F.to_json("user_ids").alias("user_ids"))


@query
def drop_hidden_columns(spark, sf_dir):
    rows = memberships(spark, sf_dir).withColumn("_rescued", F.col("note")).withColumn("_1", F.lit(1))
    return times(drop_hidden(rows), "timestamp_ntz")


# --- identities and checks ---------------------------------------------------------------------


@query
def id_normalize(spark, sf_dir):
    return memberships(spark, sf_dir).select(
        "event_id", "id_type", identity_field(F.col("id_type")).alias("id_field")
    )


@query
def id_quarantine(spark, sf_dir):
    sendable, rejected = quarantine(conform(memberships(spark, sf_dir), FIRST_PARTY.contract), FIRST_PARTY.contract)
    kept = sendable.select("event_id", "id_type", F.lit("").alias("reasons"))
    return kept.unionByName(rejected.select("event_id", "id_type", F.array_join("reject_reasons", ",").alias("reasons")))


@query
def contract_violations(spark, sf_dir):
    rows = conversions(spark, sf_dir)
    key = F.col("o_orderkey")
    many = F.transform(
        F.sequence(F.lit(1), F.lit(21)),
        lambda n: F.struct(F.lit("UID2").alias("type"), F.concat(F.lit("x"), n).alias("id")),
    )
    odd = F.array(F.struct(F.lit("CoreID").alias("type"), F.lit("y").alias("id")))
    user_ids = F.when(key % 13 == 0, many).when(key % 11 == 0, odd).otherwise(F.col("user_ids"))
    rows = rows.withColumn("user_ids", user_ids)
    rows = rows.withColumn("tracking_tag_id", F.when(key % 17 != 0, F.col("tracking_tag_id")))
    reasons = rejection_reasons(CONVERSION.contract, documented=True)
    judged = conform(rows, CONVERSION.contract).select("o_orderkey", F.array_join(reasons, ",").alias("reasons"))
    return judged.filter(F.col("reasons") != "")


# --- increments --------------------------------------------------------------------------------


def _runs(spark, sf_dir):
    """A run per feed (event type) and day, each up to its last event."""
    prepare(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    days = events.groupBy(F.col("event_type").alias("feed"), F.to_date("ts").alias("day"))
    runs = days.agg(F.max("ts").alias("last"), F.count(F.lit(1)).alias("records_processed"))
    last = F.col("last").cast("timestamp")
    return runs.select(
        "feed",
        last.alias("last_processed_date"),
        (last + F.expr("INTERVAL 1 MINUTE")).alias("run_timestamp"),
        "records_processed",
    )


def _ledger(spark, sf_dir):
    """The runs up to the 15th: what a later run starts from."""
    return _runs(spark, sf_dir).filter(F.col("last_processed_date") < "2024-01-16")


@query
def high_water_mark(spark, sf_dir):
    return times(high_water_marks(_runs(spark, sf_dir)), "timestamp_ntz")


@query
def incremental_rows(spark, sf_dir):
    mark = last_mark(_ledger(spark, sf_dir), "view")
    return times(new_rows(memberships(spark, sf_dir), FIRST_PARTY.contract, mark), "timestamp_ntz")


@query
def incremental_first_run(spark, sf_dir):
    mark = last_mark(_ledger(spark, sf_dir), "a feed without runs")
    return times(new_rows(memberships(spark, sf_dir), FIRST_PARTY.contract, mark), "timestamp_ntz")


@query
def incremental_override(spark, sf_dir):
    rows = new_rows(memberships(spark, sf_dir), FIRST_PARTY.contract, datetime(2024, 1, 20))
    return times(rows, "timestamp_ntz")


@query
def ledger_append(spark, sf_dir):
    ledger = _runs(spark, sf_dir)
    name = create_ledger_table(spark, _name("ledger"), shared_path(spark, "ledger"), "parquet")
    append_rows(ledger.filter(F.col("feed") == "view"), name)
    append_rows(ledger.filter(F.col("feed") != "view").select(*reversed(ledger.columns)), name)
    return times(spark.table(name), "timestamp_ntz")


# --- payloads ----------------------------------------------------------------------------------


def _items(rows, context, *keys):
    return shape(conform(rows, context.contract), context).select(*keys, F.col("_item").alias("item"))


@query
def payload_first_party(spark, sf_dir):
    return _items(memberships(spark, sf_dir), FIRST_PARTY, "event_id")


@query
def payload_third_party(spark, sf_dir):
    rows = memberships(spark, sf_dir)
    partner = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("p"), F.col("event_id")))
    return _items(rows.withColumn("cookie_mapping_partner_id", partner), THIRD_PARTY, "event_id")


@query
def payload_dsr(spark, sf_dir):
    rows = subject_requests(spark, sf_dir)
    items = [_items(rows, dsr, "c_custkey").withColumn("contract", F.lit(dsr.contract.name)) for dsr in DSR]
    return items[0].unionByName(items[1]).unionByName(items[2])


@query
def payload_conversion(spark, sf_dir):
    return _items(line_conversions(spark, sf_dir), CONVERSION, "l_orderkey", "l_linenumber")


@query
def payload_conversion_orders(spark, sf_dir):
    return _items(conversions(spark, sf_dir), CONVERSION, "o_orderkey")


def _nested(rows, field, *keys):
    item = CONVERSION.contract.item(F.lit(None).cast("string"))
    shaped = conform(rows, CONVERSION.contract).select(*keys, item.alias("item"))
    return shaped.select(*keys, F.posexplode(f"item.{field}").alias("pos", "entry"))


@query
def conversion_user_ids(spark, sf_dir):
    pairs = _nested(conversions(spark, sf_dir), "user_id_array", "o_orderkey")
    return pairs.select("o_orderkey", "pos", F.col("entry")[0].alias("code"), F.col("entry")[1].alias("id"))


@query
def conversion_line_items(spark, sf_dir):
    lines = _nested(line_conversions(spark, sf_dir), "line_items", "l_orderkey", "l_linenumber")
    return lines.select("l_orderkey", "l_linenumber", "pos", F.to_json("entry").alias("line_item"))


@query
def conversion_privacy(spark, sf_dir):
    settings = _nested(line_conversions(spark, sf_dir), "privacy_settings", "l_orderkey", "l_linenumber")
    return settings.select("l_orderkey", "l_linenumber", "pos", "entry.*")


# --- batches -----------------------------------------------------------------------------------


@query
def batch_numbers(spark, sf_dir):
    rows = memberships(spark, sf_dir).select("event_id", "id_value")
    return number_batches(rows, 25, ["event_id"], _block("event_id"))


@query
def batch_numbers_of_copies(spark, sf_dir):
    """Copies of a row: every line of an order counts as the order once more."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey")
    return number_batches(lines, 25, ["l_orderkey"], _block("l_orderkey"))


@query
def batch_numbers_global(spark, sf_dir):
    """One sequence of batches over all order lines, copies included."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_returnflag")
    return number_batches(lines, 25, ["l_orderkey", "l_returnflag"], "global").drop("bucket")


@query
def request_envelopes(spark, sf_dir):
    numbered = number_batches(conversions(spark, sf_dir), 3, ["o_orderkey"], _block("o_orderkey"))
    return gather_requests(numbered, CONVERSION, "trace-1").drop("body")


@query
def request_bodies(spark, sf_dir):
    rows = conform(memberships(spark, sf_dir), FIRST_PARTY.contract)
    sendable = F.size(rejection_reasons(FIRST_PARTY.contract)) == 0
    numbered = number_batches(rows, 25, ["event_id"], _block("event_id"), only=sendable)
    return gather_requests(numbered, FIRST_PARTY).select("bucket", "batch_no", "items", "body")


@query
def request_bodies_third_party(spark, sf_dir):
    rows = conform(memberships(spark, sf_dir).drop("timestamp_utc", "ttl_in_minutes"), THIRD_PARTY.contract)
    sendable = F.size(rejection_reasons(THIRD_PARTY.contract)) == 0
    numbered = number_batches(rows, 25, ["event_id"], _block("event_id"), unique_rows=True, only=sendable)
    return gather_requests(numbered, THIRD_PARTY).select("bucket", "batch_no", "items", "body")


@query
def request_bodies_dsr(spark, sf_dir):
    numbered = number_batches(subject_requests(spark, sf_dir), 25, ["c_custkey"], _block("c_custkey"))
    bodies = [gather_requests(numbered, dsr, "trace-2").withColumn("contract", F.lit(dsr.contract.name)) for dsr in DSR]
    united = bodies[0].unionByName(bodies[1]).unionByName(bodies[2])
    return united.select("contract", "bucket", "batch_no", "items", "has_user_ids", "body")


# --- delivery ----------------------------------------------------------------------------------


@query
def deliver_status(spark, sf_dir):
    delivered = deliver(memberships(spark, sf_dir), FIRST_PARTY, senders.reject_fifth_batches, **_by_event())
    return times(delivered, "timestamp_ntz")


@query
def deliver_map_column(spark, sf_dir):
    """A column that has neither a hash nor an order goes through numbered batches as it is."""
    tags = F.create_map(F.lit("type"), F.col("segment_name"), F.lit("note"), F.col("note"))
    rows = memberships(spark, sf_dir).withColumn("tags", tags)
    delivered = deliver(rows, FIRST_PARTY, senders.reject_bad_events, **_by_event())
    return times(delivered.select(*STATUS, F.to_json("tags").alias("tags")), "timestamp_ntz")


@query
def deliver_in_arrival_order(spark, sf_dir):
    delivered = deliver(
        memberships(spark, sf_dir), FIRST_PARTY, senders.reject_bad_events, batch_size=25, processed_at=SENT_AT
    )
    return times(delivered, "timestamp_ntz")


@query
def transient_failures(spark, sf_dir):
    delivered = deliver(memberships(spark, sf_dir), FIRST_PARTY, senders.break_often, **_by_event())
    return times(delivered, "timestamp_ntz")


@query
def adhoc_push(spark, sf_dir):
    rows = memberships(spark, sf_dir).withColumn("_rescued", F.lit("x"))
    return times(
        push(rows, FIRST_PARTY, senders.reject_bad_events, batch_size=25, processed_at=SENT_AT), "timestamp_ntz"
    )


@query
def adhoc_push_third_party(spark, sf_dir):
    rows = memberships(spark, sf_dir).select("event_id", "id_type", "id_value", "segment_name")
    return times(push(rows, THIRD_PARTY, senders.accept_all, processed_at=SENT_AT), "timestamp_ntz")


@query
def adhoc_push_dsr(spark, sf_dir):
    rows = subject_requests(spark, sf_dir)
    pushed = [
        push(rows, dsr, senders.accept_all, processed_at=SENT_AT).withColumn("contract", F.lit(dsr.contract.name))
        for dsr in DSR
    ]
    return times(pushed[0].unionByName(pushed[1]).unionByName(pushed[2]), "timestamp_ntz")


@query
def adhoc_push_conversion(spark, sf_dir):
    pushed = push(
        conversions(spark, sf_dir), CONVERSION, senders.accept_all, documented_checks=True, processed_at=SENT_AT
    )
    kept = ["o_orderkey", "value", "success", "error_code", "error_message", "processed_timestamp"]
    return times(pushed.select(*kept), "timestamp_ntz")


@query
def request_keys(spark, sf_dir):
    """The key that the sender was given for the request each row went out in."""
    sent = push(memberships(spark, sf_dir), FIRST_PARTY, senders.echo_key, trace_id="trace-3", **_by_event())
    return sent.filter("error_code <> 'UNKNOWN_ID_TYPE'").select("event_id", F.col("error_code").alias("request_key"))


# --- attribution of recorded responses ---------------------------------------------------------


def _responses(numbered, failed):
    """One response per batch, with failures that depend on the batch number."""
    batches = numbered.select("bucket", "batch_no").distinct()
    response = F.struct(
        F.lit("partial").alias("kind"),
        F.lit(None).cast("int").alias("status"),
        F.lit(None).cast("string").alias("message"),
        F.expr(failed).alias("failed"),
    ).cast(RESPONSE_TYPE)
    return batches.select("bucket", "batch_no", response.alias("response"))


def _attributed(spark, sf_dir, failed):
    numbered = number_batches(
        memberships(spark, sf_dir).select("event_id"), 25, ["event_id"], _block("event_id")
    )
    return attribute(numbered, _responses(numbered, failed)).drop("bucket", "batch_no")


@query
def attribution_last_wins(spark, sf_dir):
    failed = """
      CASE batch_no % 3
        WHEN 0 THEN array(struct(2, 'A', 'first'), struct(NULL, 'G', 'one'), struct(2, 'B', 'second'),
                          struct(NULL, 'H', 'two'))
        WHEN 1 THEN array(struct(5, 'A', 'first'), struct(5, 'C', 'last'))
      END
    """
    return _attributed(spark, sf_dir, failed)


@query
def attribution_null_error(spark, sf_dir):
    failed = """
      CASE batch_no % 3
        WHEN 0 THEN array(struct(CAST(NULL AS INT), CAST(NULL AS STRING), CAST(NULL AS STRING)))
        WHEN 1 THEN array(struct(3, NULL, NULL), struct(NULL, 'G', 'rest'))
      END
    """
    return _attributed(spark, sf_dir, failed)


@query
def attribution_all_failed(spark, sf_dir):
    """Large batches whose response names nearly every item."""
    failed = """
      concat(
        transform(sequence(1, 1500), n -> named_struct('item_number', n, 'error_code', 'ITEM', 'message', 'item ' || n)),
        array(named_struct('item_number', CAST(NULL AS INT), 'error_code', 'GEN', 'message', 'rest'))
      )
    """
    rows = memberships(spark, sf_dir).select("event_id")
    numbered = number_batches(rows, 1600, ["event_id"], F.expr("event_id div 8000"), unique_rows=True)
    return attribute(numbered, _responses(numbered, failed))


@query
def attribution_out_of_range(spark, sf_dir):
    failed = "array(struct(0, 'LOW', 'x'), struct(26 + CAST(batch_no AS INT), 'HIGH', 'x'), struct(4, 'IN', 'x'))"
    numbered = number_batches(
        memberships(spark, sf_dir).select("event_id"), 25, ["event_id"], _block("event_id")
    )
    responses = _responses(numbered, failed)
    attributed = attribute(numbered, responses).groupBy("bucket", "batch_no")
    counts = attributed.agg(F.count_if(~F.col("success")).alias("failed"), F.count(F.lit(1)).alias("items"))
    return counts.join(stray_items(numbered, responses), ["bucket", "batch_no"])


# --- tables and runs ---------------------------------------------------------------------------


def _name(kind):
    return f"delivery_{kind}_{uuid4().hex}"


def _stored(spark, rows, kind):
    """A table of the rows at a shared location."""
    name = _name(kind)
    rows.write.option("path", shared_path(spark, kind)).format("parquet").saveAsTable(name)
    return name


@query
def table_setup(spark, sf_dir):
    """The three tables, created twice over; what an upstream job appends is what a run reads."""
    contract = FIRST_PARTY.contract
    for name in (source := _name("input"),) * 2:
        create_input_table(spark, contract, name, shared_path(spark, "input"), "parquet")
    for name in (results := _name("output"),) * 2:
        create_output_table(spark, contract, name, shared_path(spark, "output"), "parquet")
    ledger = create_ledger_table(spark, _name("ledger"), shared_path(spark, "ledger"), "parquet")
    append_rows(memberships(spark, sf_dir).drop("event_id", "note"), source)
    run_batch(
        spark,
        FIRST_PARTY,
        senders.reject_bad_events,
        source,
        results,
        ledger,
        new_rows_only=True,
        batch_size=25,
        processed_at=SENT_AT,
    )
    return times(spark.table(results), "timestamp_ntz")


@query
def table_setup_extra(spark, sf_dir):
    """An output table for rows with further columns and a wider type than the contract has."""
    rows = memberships(spark, sf_dir).withColumn("ttl_in_minutes", F.col("ttl_in_minutes").cast("long"))
    source, results = _stored(spark, rows, "input"), _name("output")
    contract = FIRST_PARTY.contract
    create_output_table(spark, contract, results, shared_path(spark, "output"), "parquet", input_schema=rows.schema)
    run_batch(spark, FIRST_PARTY, senders.reject_bad_events, source, results, **_by_event())
    return times(spark.table(results), "timestamp_ntz")


@query
def visible_results(spark, sf_dir):
    """Runs over an increment each, and between them one that broke before it was recorded: its results do not count."""
    rows = memberships(spark, sf_dir)
    source, contract = _name("input"), FIRST_PARTY.contract
    rows.filter("updated_at < '2024-01-10'").write.option("path", shared_path(spark, "in")).format("parquet").saveAsTable(source)
    results = create_output_table(
        spark, contract, _name("output"), shared_path(spark, "out"), "parquet", input_schema=rows.schema, with_run_id=True
    )
    ledger = create_ledger_table(spark, _name("ledger"), shared_path(spark, "ledger"), "parquet", with_run_id=True)
    options = {"new_rows_only": True, "skip_delivered_by": ["event_id"], **_by_event()}
    run_batch(spark, FIRST_PARTY, senders.reject_bad_events, source, results, ledger, **options)
    broken = push(rows, FIRST_PARTY, senders.accept_all, processed_at=SENT_AT).withColumn("run_id", F.lit("broken"))
    append_rows(broken, results)
    append_rows(rows.filter("updated_at >= '2024-01-10'"), source)
    run_batch(spark, FIRST_PARTY, senders.reject_bad_events, source, results, ledger, **options)
    seen = tables.visible_results(spark.table(results), spark.table(ledger))
    return times(seen.drop("run_id"), "timestamp_ntz")


def _interval_runs(spark, sf_dir):
    """Three runs by intervals: a part of the events with a late start and holes, then all of them, then nothing new."""
    rows = memberships(spark, sf_dir)
    early = (F.col("updated_at") >= "2024-01-10") & (F.col("event_id") % 7 != 0)
    source, contract = _name("input"), FIRST_PARTY.contract
    rows.filter(early).write.option("path", shared_path(spark, "in")).format("parquet").saveAsTable(source)
    results = create_output_table(
        spark, contract, _name("output"), shared_path(spark, "out"), "parquet", input_schema=rows.schema
    )
    coverage = create_coverage_table(spark, _name("coverage"), shared_path(spark, "coverage"), "parquet")
    run = [spark, FIRST_PARTY, senders.reject_bad_events, source, results, coverage, ["event_id"], "members"]
    run_intervals(*run, **_by_event())
    append_rows(rows.filter(~early), source)
    run_intervals(*run, **_by_event())
    run_intervals(*run, **_by_event())
    return spark.table(results), spark.table(coverage)


@query
def interval_marks(spark, sf_dir):
    _, coverage = _interval_runs(spark, sf_dir)
    return times(intervals(coverage), "timestamp_ntz")


@query
def interval_rows(spark, sf_dir):
    """Late rows are sent once, whether their time was covered before or not, and nothing is sent again."""
    results, _ = _interval_runs(spark, sf_dir)
    return times(results, "timestamp_ntz")


@query
def results_append(spark, sf_dir):
    results = _name("results")
    for sent_at, sender in [(SENT_AT, senders.reject_bad_events), (SENT_AGAIN_AT, senders.accept_all)]:
        pushed = push(memberships(spark, sf_dir), FIRST_PARTY, sender, processed_at=sent_at).select(*STATUS)
        if sent_at is SENT_AT:
            pushed.write.option("path", shared_path(spark, "results")).format("parquet").saveAsTable(results)
        else:
            append_rows(pushed.select(*reversed(STATUS[:-1]), STATUS[-1]), results)
    return times(spark.table(results), "timestamp_ntz")


def _batch_run(spark, sf_dir, since=None):
    """An incremental run over all events, from the mark of an earlier ledger or from ``since``."""
    rows = memberships(spark, sf_dir)
    source = _stored(spark, rows, "input")
    results = _name("output")
    schema = C.result_schema(conform(rows, FIRST_PARTY.contract).schema)
    spark.catalog.createTable(results, path=shared_path(spark, "output"), source="parquet", schema=schema)
    ledger = _stored(spark, _ledger(spark, sf_dir), "ledger")
    run_batch(
        spark,
        FIRST_PARTY,
        senders.reject_bad_events,
        source,
        results,
        ledger,
        new_rows_only=True,
        since=since,
        feed="view",
        batch_size=25,
        processed_at=SENT_AT,
    )
    return results, ledger


@query
def batch_run(spark, sf_dir):
    results, _ = _batch_run(spark, sf_dir)
    return times(spark.table(results), "timestamp_ntz")


@query
def batch_run_ledger(spark, sf_dir):
    _, ledger = _batch_run(spark, sf_dir)
    return times(spark.table(ledger).drop("run_timestamp"), "timestamp_ntz")


@query
def empty_run_ledger(spark, sf_dir):
    """Nothing is newer than the override: nothing is sent, and the old mark is kept."""
    _, ledger = _batch_run(spark, sf_dir, datetime(2030, 1, 1))
    return times(spark.table(ledger).drop("run_timestamp"), "timestamp_ntz")


@query
def fatal_run_results(spark, sf_dir):
    """A run that a refusal stopped, and the next one, which sends the rest: every row is delivered once."""
    source, results = _stored(spark, memberships(spark, sf_dir), "input"), _name("output")
    schema = C.result_schema(conform(spark.table(source), FIRST_PARTY.contract).schema)
    spark.catalog.createTable(results, path=shared_path(spark, "output"), source="parquet", schema=schema)
    status = None
    try:
        run_batch(spark, FIRST_PARTY, senders.expire_midway, source, results, **_by_event())
    except SendError as error:
        status = error.status_code
    refused = spark.table(results).filter("error_code = 'Unauthorized'").limit(1).count()
    run_batch(spark, FIRST_PARTY, senders.accept_all, source, results, skip_delivered_by=["event_id"], **_by_event())
    rows = spark.table(results).groupBy("event_id").agg(F.count_if("success").alias("delivered"))
    return rows.select("event_id", "delivered", F.lit(status).alias("status"), F.lit(refused).alias("refused"))


@query
def live_strays(spark, sf_dir):
    """What a run counts when every response names an item too many."""
    source = _stored(spark, memberships(spark, sf_dir), "input")
    run = run_batch(spark, FIRST_PARTY, senders.name_one_too_many, source, _name("output"), **_by_event())
    values = {"records": run.records, "succeeded": run.succeeded, "strays": run.strays}
    return spark.range(1).select(*[F.lit(value).cast("long").alias(name) for name, value in values.items()])


@query
def stream_increment(spark, sf_dir):
    prepare(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = times(spark.sql(MEMBERSHIPS, events=events), "timestamp")
    path = shared_path(spark, "stream-results")
    for _ in range(2):
        stream = run_stream(
            rows,
            FIRST_PARTY,
            senders.reject_bad_events,
            path,
            f"{path}-checkpoint",
            batch_size=25,
            processed_at=SENT_AT,
        )
        stream.awaitTermination()
    return times(spark.read.parquet(path).drop("stream_run", "stream_batch"), "timestamp_ntz")


@query
def stream_retry(spark, sf_dir):
    """Rows that arrive twice and are sent once; what fails is sent again by two restarts from the checkpoint."""
    prepare(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = times(spark.sql(MEMBERSHIPS, events=events), "timestamp")
    rows = rows.unionByName(rows)
    path = shared_path(spark, "retry-results")
    for sender in (senders.reject_bad_events, senders.reject_worse_events, senders.accept_all):
        stream = run_retrying_stream(
            rows,
            ["event_id"],
            FIRST_PARTY,
            sender,
            path,
            f"{path}-checkpoint",
            wait=timedelta(0),
            batch_size=25,
            processed_at=SENT_AT,
        )
        stream.awaitTermination()
    results = spark.read.schema("event_id long, attempt int, success boolean, error_code string").parquet(path)
    return results.select("event_id", "attempt", "success", "error_code")


# --- reports and later runs --------------------------------------------------------------------


def _pushed(spark, sf_dir):
    return push(memberships(spark, sf_dir), FIRST_PARTY, senders.reject_bad_events, processed_at=SENT_AT)


@query
def status_totals(spark, sf_dir):
    return report.totals(_pushed(spark, sf_dir))


@query
def status_summary(spark, sf_dir):
    return report.status_summary(_pushed(spark, sf_dir))


@query
def failed_rows(spark, sf_dir):
    return times(report.failed_rows(_pushed(spark, sf_dir)), "timestamp_ntz")


@query
def succeeded_rows(spark, sf_dir):
    return times(report.succeeded_rows(_pushed(spark, sf_dir)), "timestamp_ntz")


def _two_runs(spark, sf_dir):
    """Results of a run over everything, and of a second one with what failed in the first."""
    first = _pushed(spark, sf_dir)
    again = history.retry_set(first, ["event_id"]).drop(*STATUS[1:])
    second = push(again, FIRST_PARTY, senders.reject_worse_events, processed_at=SENT_AGAIN_AT)
    return first.unionByName(second)


@query
def retry_set(spark, sf_dir):
    return times(history.retry_set(_two_runs(spark, sf_dir), ["event_id"]), "timestamp_ntz")


@query
def retry_users(spark, sf_dir):
    """By a key with a long history: users whose latest result in a segment is a failure."""
    key = ["id_type", "id_value", "segment_name"]
    events = _pushed(spark, sf_dir).withColumn("processed_timestamp", F.col("timestamp_utc"))
    return times(history.retry_set(events, key).select(*key, *STATUS), "timestamp_ntz")


@query
def replay_skip(spark, sf_dir):
    rows = history.skip_delivered(memberships(spark, sf_dir), _two_runs(spark, sf_dir), ["event_id"])
    return times(rows, "timestamp_ntz")


@query
def replay_skip_updated(spark, sf_dir):
    """Rows that changed after their delivery go out again."""
    later = F.col("updated_at") + F.expr("INTERVAL 24 HOUR")
    updated_at = F.when(F.col("event_id") % 3 == 0, later).otherwise(F.col("updated_at"))
    rows = memberships(spark, sf_dir).withColumn("updated_at", updated_at)
    rows = history.skip_delivered(rows, _two_runs(spark, sf_dir), ["event_id"], version="updated_at")
    return times(rows, "timestamp_ntz")


@query
def replay_skip_pruned(spark, sf_dir):
    """An increment against the results of the second run alone."""
    mark = last_mark(_ledger(spark, sf_dir), "view")
    rows = new_rows(memberships(spark, sf_dir), FIRST_PARTY.contract, mark)
    rows = history.skip_delivered(rows, _two_runs(spark, sf_dir), ["event_id"], since=SENT_AGAIN_AT)
    return times(rows, "timestamp_ntz")


@query
def replay_skip_hot(spark, sf_dir):
    """By segment, of which there are few: every key is hot."""
    delivered = push(memberships(spark, sf_dir), FIRST_PARTY, senders.accept_two_segments, processed_at=SENT_AT)
    rows = history.skip_delivered(memberships(spark, sf_dir), delivered, ["segment_name"], hot_rows=100)
    return times(rows, "timestamp_ntz")
