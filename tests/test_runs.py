from datetime import datetime, timedelta, timezone
from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpour import (
    CONTRACTS,
    ConfigurationError,
    ContractError,
    DsrMerchant,
    FirstParty,
    RequestType,
    SendError,
    create_input_table,
    create_ledger_table,
    create_output_table,
    partial,
    result_schema,
    run_batch,
)
from outpour.contracts import with_updated_at
from outpour.operators import deliver
from outpour.operators.increment import last_mark, new_rows
from outpour.plans import batch
from outpour.sources.tables import append_rows, append_run, stamp_updated, visible_results
from outpour.sources.types import holds, join_types
from tests.senders import accepting, failing_first_item, logging_sender, refusing, requests_in

CONTEXT = FirstParty("adv")
CONTRACT = CONTEXT.contract
MEMBER = "id_type string, id_value string, segment_name string, updated_at timestamp"


def at(day, hour=0):
    return datetime(2024, 1, day, hour, tzinfo=timezone.utc)


def members(spark, *days):
    rows = [("TDID", f"v{day}", "s", at(day) if day else None) for day in days]
    return spark.createDataFrame(rows, MEMBER)


@pytest.fixture
def tables(spark):
    """Names of an input, an output and a ledger table; all exist and are empty."""
    suffix = uuid4().hex
    return (
        create_input_table(spark, CONTRACT, f"in_{suffix}"),
        create_output_table(spark, CONTRACT, f"out_{suffix}"),
        create_ledger_table(spark, f"ledger_{suffix}"),
    )


def delivered(spark, table):
    return sorted(row["id_value"] for row in spark.table(table).collect())


# --- tables ---


def test_tables_have_the_columns_of_the_contract(spark, tables):
    source, results, ledger = tables
    assert spark.table(source).columns == with_updated_at(CONTRACT.schema).names
    assert spark.table(results).columns == result_schema(with_updated_at(CONTRACT.schema)).names
    assert spark.table(ledger).columns == ["feed", "last_processed_date", "run_timestamp", "records_processed"]


def test_default_names_and_second_creation(spark):
    contract = CONTRACTS["dsr_merchant"]
    assert create_input_table(spark, contract) == "delivery_dsr_merchant_input"
    append_rows(spark.createDataFrame([("TDID", "a")], "id_type string, id_value string"), "delivery_dsr_merchant_input")
    assert create_input_table(spark, contract) == "delivery_dsr_merchant_input"
    assert spark.table("delivery_dsr_merchant_input").count() == 1
    assert create_output_table(spark, contract) == "delivery_dsr_merchant_output"
    assert create_ledger_table(spark) == "delivery_ledger"


def test_external_location(spark, tmp_path):
    name = create_input_table(spark, CONTRACTS["conversion"], f"ext_{uuid4().hex}", str(tmp_path / "x"), "parquet")
    rows = spark.createDataFrame([("t", at(1))], "tracking_tag_id string, timestamp_utc timestamp")
    append_rows(stamp_updated(rows), name)
    assert spark.read.parquet(str(tmp_path / "x")).count() == 1
    assert spark.table(name).filter("updated_at IS NOT NULL AND line_items IS NULL").count() == 1


def test_append_matches_names(spark, tables):
    source = tables[0]
    append_rows(members(spark, 1).select("updated_at", "segment_name", "id_value", "id_type"), source)
    row = spark.table(source).first()
    assert (row["id_type"], row["id_value"], row["bid_factor"]) == ("TDID", "v1", None)


def test_append_refuses_unknown_columns(spark, tables):
    with pytest.raises(ContractError, match="note"):
        append_rows(members(spark, 1).withColumn("note", F.lit("x")), tables[0])
    assert spark.table(tables[0]).count() == 0


def test_append_checks_types_before_anything_is_sent(spark, tables, tmp_path):
    source, results = f"odd_{uuid4().hex}", tables[1]
    members(spark, 1).withColumn("ttl_in_minutes", F.lit("soon")).write.saveAsTable(source)
    with pytest.raises(ContractError, match="ttl_in_minutes"):
        run_batch(spark, CONTEXT, logging_sender(str(tmp_path)), source, results)
    assert requests_in(tmp_path) == []
    append_rows(members(spark, 1).withColumn("bid_factor", F.lit(2)), tables[0])
    assert spark.table(tables[0]).first()["bid_factor"] == 2.0


# --- increments ---


def test_mark_is_the_latest_of_the_feed(spark, tables):
    ledger = tables[2]
    assert last_mark(spark.table(ledger), "a") is None
    append_run(spark, ledger, "a", datetime(2024, 1, 1), at(2), 1)
    append_run(spark, ledger, "a", datetime(2024, 6, 15), at(2), 1)
    append_run(spark, ledger, "b", datetime(2025, 1, 1), at(2), 1)
    append_run(spark, ledger, "a", None, at(2), 0)
    assert last_mark(spark.table(ledger), "a") == datetime(2024, 6, 15, tzinfo=timezone.utc)


def test_new_rows_are_strictly_later(spark):
    df = members(spark, 1, 2, 3, None)
    found = lambda mark, *rest: sorted(r["id_value"] for r in new_rows(df, CONTRACT, mark, *rest).collect())
    assert found(at(2)) == ["v3"]
    assert found(datetime(2024, 1, 2)) == ["v3"]
    assert found(at(2), timedelta(days=1)) == ["v2", "v3"]
    assert found(None) == ["v1", "v2", "v3", "vNone"]


def test_increments_need_updated_at(spark):
    with pytest.raises(ContractError, match="updated_at"):
        new_rows(members(spark, 1).drop("updated_at"), CONTRACT, None)


def test_increment_filter_reaches_the_scan(spark, tmp_path):
    members(spark, 1, 2).write.parquet(str(tmp_path / "in"))
    rows = new_rows(spark.read.parquet(str(tmp_path / "in")), CONTRACT, at(1)).select("id_value")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at" in plan.split("PushedFilters")[1]
    assert "segment_name" not in plan.split("ReadSchema")[1]


# --- runs ---


def test_runs_take_what_is_new(spark, tables, tmp_path):
    source, results, ledger = tables
    sender = logging_sender(str(tmp_path))
    append_rows(members(spark, 1, 2), source)
    first = run_batch(spark, CONTEXT, sender, source, results, ledger, new_rows_only=True)
    assert (first.records, first.succeeded, first.failed, first.mark) == (2, 2, 0, at(2))
    append_rows(members(spark, 2, 3), source)
    second = run_batch(spark, CONTEXT, sender, source, results, ledger, new_rows_only=True)
    assert (second.records, second.mark) == (1, at(3))
    assert delivered(spark, results) == ["v1", "v2", "v3"]
    assert sorted(i["tdid"] for r in requests_in(tmp_path) for i in r["items"]) == ["v1", "v2", "v3"]
    runs = spark.table(ledger).orderBy("run_timestamp").collect()
    assert [(row["feed"], row["records_processed"]) for row in runs] == [("first_party", 2), ("first_party", 1)]


def test_empty_run_keeps_the_mark(spark, tables, tmp_path):
    source, results, ledger = tables
    sender = logging_sender(str(tmp_path))
    empty = run_batch(spark, CONTEXT, sender, source, results, ledger, new_rows_only=True)
    assert (empty.records, empty.mark) == (0, None)
    append_rows(members(spark, 1), source)
    run_batch(spark, CONTEXT, accepting, source, results, ledger, new_rows_only=True)
    again = run_batch(spark, CONTEXT, sender, source, results, ledger, new_rows_only=True)
    assert (again.records, again.mark) == (0, at(1))
    assert requests_in(tmp_path) == []
    counts = [row["records_processed"] for row in spark.table(ledger).orderBy("run_timestamp").collect()]
    assert counts == [0, 1, 0]


@pytest.mark.parametrize("parallelism", [None, "source", 3])
def test_empty_run_with_any_spreading(spark, tables, parallelism):
    source, results, ledger = tables
    summary = run_batch(spark, CONTEXT, accepting, source, results, ledger, parallelism=parallelism)
    assert summary.records == 0


def test_all_rows_without_a_ledger(spark, tables):
    source, results, _ = tables
    append_rows(members(spark, 1, 2, None), source)
    for _ in range(2):
        assert run_batch(spark, CONTEXT, accepting, source, results).records == 3
    assert spark.table(results).count() == 6


def test_backfill(spark, tables):
    source, results, ledger = tables
    append_rows(members(spark, 1, 2, 3), source)
    run_batch(spark, CONTEXT, accepting, source, results, ledger, new_rows_only=True)
    summary = run_batch(spark, CONTEXT, accepting, source, results, ledger, new_rows_only=True, since=at(1))
    assert (summary.records, summary.mark) == (2, at(3))
    assert delivered(spark, results) == ["v1", "v2", "v2", "v3", "v3"]


def test_feeds_do_not_hide_each_other(spark, tables):
    source, results, ledger = tables
    append_rows(members(spark, 1), source)
    for feed in ("one", "two"):
        assert run_batch(spark, CONTEXT, accepting, source, results, ledger, new_rows_only=True, feed=feed).records == 1


def test_late_rows_with_overlap(spark, tables):
    """Rows that arrive behind the mark are found again, and those delivered before are not sent twice."""
    source, results, ledger = tables
    append_rows(members(spark, 1, 3), source)
    run_batch(spark, CONTEXT, accepting, source, results, ledger, new_rows_only=True)
    append_rows(members(spark, 2, 4), source)
    options = {"new_rows_only": True, "overlap": timedelta(days=5), "skip_delivered_by": ["id_type", "id_value"]}
    summary = run_batch(spark, CONTEXT, accepting, source, results, ledger, **options)
    assert (summary.records, summary.mark) == (2, at(4))
    assert delivered(spark, results) == ["v1", "v2", "v3", "v4"]


def test_changed_rows_go_out_again(spark, tables):
    source, results, ledger = tables
    options = {"new_rows_only": True, "overlap": timedelta(days=9), "skip_delivered_by": ["id_type", "id_value"]}
    append_rows(members(spark, 1, 2), source)
    run_batch(spark, CONTEXT, accepting, source, results, ledger, **options)
    append_rows(members(spark, 1).withColumn("updated_at", F.lit(at(5))), source)
    changed = run_batch(spark, CONTEXT, accepting, source, results, ledger, **options)
    assert (changed.records, changed.mark) == (1, at(5))
    assert run_batch(spark, CONTEXT, accepting, source, results, ledger, **options).records == 0
    assert delivered(spark, results) == ["v1", "v1", "v2"]


def test_mark_counts_rows_that_were_left_out(spark, tables):
    source, results, ledger = tables
    append_rows(members(spark, 1, 2), source)
    run_batch(spark, CONTEXT, accepting, source, results)
    options = {"new_rows_only": True, "skip_delivered_by": ["id_type", "id_value"]}
    summary = run_batch(spark, CONTEXT, accepting, source, results, ledger, **options)
    assert (summary.records, summary.mark) == (0, at(2))


def test_stamps_in_the_future_and_missing_ones_are_counted(spark, tables):
    source, results, ledger = tables
    ahead = members(spark, 9).withColumn("updated_at", F.lit(datetime(2099, 1, 1, tzinfo=timezone.utc)))
    append_rows(members(spark, 1).unionByName(ahead), source)
    first = run_batch(spark, CONTEXT, accepting, source, results, ledger, new_rows_only=True)
    assert (first.records, first.mark, first.ahead, first.unstamped) == (2, at(1), 1, 0)
    append_rows(members(spark, 2, None), source)
    second = run_batch(spark, CONTEXT, accepting, source, results, ledger, new_rows_only=True)
    assert (second.records, second.mark, second.ahead, second.unstamped) == (2, at(2), 1, 1)


def test_failures_are_counted_and_recorded(spark, tables):
    source, results, ledger = tables
    append_rows(members(spark, 1, 2, 3).coalesce(1), source)
    summary = run_batch(spark, CONTEXT, failing_first_item, source, results, ledger, parallelism=1)
    assert (summary.records, summary.succeeded, summary.failed) == (3, 2, 1)
    assert spark.table(results).filter("error_code = 'INVALID_ID'").count() == 1


def test_refusal_records_what_was_sent(spark, tables):
    source, results, ledger = tables
    append_rows(members(spark, 1, 2, 3).coalesce(1), source)
    with pytest.raises(SendError):
        run_batch(spark, CONTEXT, refusing, source, results, ledger, parallelism=1, batch_size=2)
    stored = spark.table(results).collect()
    assert len(stored) == 2 and {(row["success"], row["error_code"]) for row in stored} == {(False, "Unauthorized")}
    assert spark.table(ledger).count() == 0
    again = run_batch(spark, CONTEXT, accepting, source, results, ledger, skip_delivered_by=["id_value"])
    assert again.records == 3 and spark.table(ledger).count() == 1


def test_results_of_a_broken_run_are_not_seen(spark, tables, monkeypatch):
    source, suffix = tables[0], uuid4().hex
    results = create_output_table(spark, CONTRACT, f"runs_{suffix}", with_run_id=True)
    ledger = create_ledger_table(spark, f"runs_ledger_{suffix}", with_run_id=True)
    append_rows(members(spark, 1, 2), source)
    options = {"new_rows_only": True, "skip_delivered_by": ["id_value"]}
    with monkeypatch.context() as patch:
        patch.setattr(batch, "append_run", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_batch(spark, CONTEXT, accepting, source, results, ledger, **options)
    assert spark.table(results).count() == 2
    assert visible_results(spark.table(results), spark.table(ledger)).count() == 0
    assert run_batch(spark, CONTEXT, accepting, source, results, ledger, **options).records == 2
    seen = visible_results(spark.table(results), spark.table(ledger))
    assert sorted(row["id_value"] for row in seen.collect()) == ["v1", "v2"] and spark.table(results).count() == 4
    assert seen.select("run_id").distinct().count() == 1
    append_rows(members(spark, 3, 4).coalesce(1), source)
    with pytest.raises(SendError):
        run_batch(spark, CONTEXT, refusing, source, results, ledger, parallelism=1, batch_size=1, **options)
    seen = visible_results(spark.table(results), spark.table(ledger))
    assert seen.count() == 3 and seen.filter("error_code = 'Unauthorized'").count() == 1
    assert run_batch(spark, CONTEXT, accepting, source, results, ledger, **options).records == 2


def test_a_run_shuffles_its_rows_once(spark, tables, monkeypatch):
    """Few delivered keys are taken to the rows, and rows with few copies are numbered without folding them."""
    source, results, ledger = tables
    plans, options = [], {"skip_delivered_by": ["id_value"], "key": ["id_value"], "bucket": F.length("id_value"), "batch_size": 2}

    def attempt(*args, **more):
        attempted = deliver.attempt(*args, **more)
        plans.append(attempted._jdf.queryExecution().executedPlan().toString())
        return attempted

    monkeypatch.setattr(batch, "attempt", attempt)
    append_rows(members(spark, 1, 2, 3).unionByName(members(spark, 3)), source)
    assert run_batch(spark, CONTEXT, accepting, source, results, ledger, **options).records == 4
    append_rows(members(spark, 4), source)
    assert run_batch(spark, CONTEXT, accepting, source, results, ledger, **options).records == 1
    assert [text.count("hashpartitioning") for text in plans] == [1, 1]
    assert delivered(spark, results) == ["v1", "v2", "v3", "v3", "v4"]


def test_results_from_before_run_ids_are_seen(spark):
    old = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id int, run_id string")
    ledger = spark.createDataFrame([("f", "a"), ("f", None), ("f", "a")], "feed string, run_id string")
    assert sorted(row["id"] for row in visible_results(old, ledger).collect()) == [1, 2]
    assert visible_results(old.drop("run_id"), ledger).count() == 3


def test_run_ids_need_a_ledger_with_them(spark, tables):
    results = create_output_table(spark, CONTRACT, f"runs_{uuid4().hex}", with_run_id=True)
    for ledger in (None, tables[2]):
        with pytest.raises(ConfigurationError, match="run id"):
            run_batch(spark, CONTEXT, accepting, tables[0], results, ledger)


def test_output_table_for_further_columns(spark, tables):
    source, results = f"extra_{uuid4().hex}", f"extra_out_{uuid4().hex}"
    rows = spark.sql(
        """SELECT 'TDID' id_type, 'a' id_value, 's' segment_name, 3L ttl_in_minutes, TIMESTAMP '2024-01-01' updated_at,
           named_struct('x', 1) AS more, array(named_struct('y', 2S)) AS list, 'h' AS _hidden"""
    )
    rows.write.saveAsTable(source)
    schema = rows.withColumn("more", F.struct(F.lit(1).cast("long").alias("x"), F.lit("z").alias("z"))).schema
    create_output_table(spark, CONTRACT, results, input_schema=schema)
    run_batch(spark, CONTEXT, accepting, source, results)
    row = spark.table(results).first()
    assert (row["ttl_in_minutes"], row["more"].asDict(), row["list"][0]["y"], row["success"]) == (3, {"x": 1, "z": None}, 2, True)
    assert "_hidden" not in spark.table(results).columns
    with pytest.raises(ContractError, match="id_value"):
        create_output_table(spark, CONTRACT, results + "b", input_schema=rows.withColumn("ID_VALUE", F.lit(1)).schema)


@pytest.mark.parametrize(
    "a, b, both",
    [
        ("int", "int", "int"), ("int", "bigint", "bigint"), ("tinyint", "float", "float"), ("int", "float", "double"),
        ("bigint", "double", None), ("bigint", "decimal(5,2)", "decimal(21,2)"), ("decimal(38,0)", "decimal(38,10)", None),
        ("void", "string", "string"), ("string", "int", None), ("date", "timestamp", None),
        ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("map<string,int>", "map<int,int>", None), ("array<int>", "int", None),
        ("struct<a:int>", "struct<b:string,a:bigint>", "struct<a:bigint,b:string>"), ("struct<a:int>", "struct<a:string>", None),
    ],
)
def test_types_that_hold_both(spark, a, b, both):
    a, b = (T.StructType.fromDDL(f"x {kind}")[0].dataType for kind in (a, b))
    found = join_types(a, b)
    assert (found and found.simpleString()) == both
    flipped = join_types(b, a)
    assert (flipped is None) == (found is None)
    if found is not None:
        assert holds(found, a) and holds(found, b) or "struct" in both


def naming_too_many():
    return lambda request: partial([(0, "LOW", None), (len(request.items) + 1, "HIGH", None), (1, "BAD", None)])


def test_strays_are_counted(spark, tables):
    source, results, _ = tables
    append_rows(members(spark, 1, 2, 3, 4, 5).coalesce(1), source)
    with pytest.warns(UserWarning, match="6 items"):
        summary = run_batch(spark, CONTEXT, naming_too_many, source, results, parallelism=1, batch_size=2)
    assert (summary.records, summary.succeeded, summary.strays) == (5, 2, 6)


def test_guards(spark, tables, tmp_path):
    source, results, ledger = tables
    sender = logging_sender(str(tmp_path))
    append_rows(members(spark, 1), source)
    with pytest.raises(ConfigurationError, match="ledger_table"):
        run_batch(spark, CONTEXT, sender, source, results, new_rows_only=True)
    with pytest.raises(ConfigurationError, match="no_such_ledger"):
        run_batch(spark, CONTEXT, sender, source, results, "no_such_ledger")
    with pytest.raises(ConfigurationError, match="since"):
        run_batch(spark, CONTEXT, sender, source, results, ledger, since=at(1))
    assert requests_in(tmp_path) == []


def test_strict_run(spark, tables, tmp_path):
    source, results, ledger = tables
    append_rows(members(spark, 1).withColumn("id_type", F.lit("CoreID")), source)
    with pytest.raises(ContractError):
        run_batch(spark, CONTEXT, logging_sender(str(tmp_path)), source, results, ledger, strict=True)
    summary = run_batch(spark, CONTEXT, logging_sender(str(tmp_path)), source, results, ledger)
    assert (summary.failed, requests_in(tmp_path)) == (1, [])


def test_table_without_updated_at_and_no_output_table(spark):
    source, results = f"plain_{uuid4().hex}", f"new_{uuid4().hex}"
    spark.createDataFrame([("TDID", "a", 1)], "id_type string, id_value string, extra int").write.saveAsTable(source)
    ledger = create_ledger_table(spark, f"ledger_{uuid4().hex}")
    before = datetime.now(timezone.utc)
    summary = run_batch(spark, DsrMerchant(1, RequestType.DELETION), accepting, source, results, ledger)
    assert summary.records == 1 and summary.mark >= before
    assert spark.table(results).columns[:3] == ["id_type", "id_value", "extra"]
