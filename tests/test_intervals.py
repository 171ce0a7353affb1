from datetime import datetime, timedelta, timezone
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from outpour import (
    ConfigurationError,
    ContractError,
    FirstParty,
    SendError,
    create_coverage_table,
    create_input_table,
    create_output_table,
    fatal,
    run_intervals,
)
from outpour.operators.intervals import cells, intervals, open_cells
from outpour.sources.tables import append_rows
from tests.senders import accepting, failing_first_item, logging_sender, requests_in

CONTEXT = FirstParty("adv")
CONTRACT = CONTEXT.contract
MEMBER = "id_type string, id_value string, segment_name string, updated_at timestamp"
HOUR = timedelta(hours=1)
KEY = ["id_value"]


def at(hour, minute=0):
    return datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(hours=hour, minutes=minute)


def members(spark, *rows):
    return spark.createDataFrame([("TDID", name, "s", stamp) for name, stamp in rows], MEMBER)


@pytest.fixture
def tables(spark):
    suffix = uuid4().hex
    return (
        create_input_table(spark, CONTRACT, f"in_{suffix}"),
        create_output_table(spark, CONTRACT, f"out_{suffix}"),
        create_coverage_table(spark, f"coverage_{suffix}"),
    )


def run(spark, tables, sender=accepting, **options):
    return run_intervals(spark, CONTEXT, sender, *tables, KEY, **options)


def sent(spark, tables):
    return sorted(row["id_value"] for row in spark.table(tables[1]).collect())


def covered(spark, tables):
    rows = intervals(spark.table(tables[2])).orderBy("feed", "from_date").collect()
    start = at(0).timestamp()
    hours = lambda stamp: (stamp.replace(tzinfo=timezone.utc).timestamp() - start) / 3600
    return [(row["feed"], hours(row["from_date"]), hours(row["to_date"]), row["records"]) for row in rows]


def test_late_rows_are_sent_once_wherever_they_fall(spark, tables):
    append_rows(members(spark, ("a", at(5)), ("b", at(6, 30)), ("c", at(9))), tables[0])
    assert run(spark, tables).records == 3
    assert covered(spark, tables) == [("first_party", 5, 7, 2), ("first_party", 9, 10, 1)]
    append_rows(members(spark, ("before", at(1)), ("between", at(8)), ("inside", at(6, 10)), ("new", at(12))), tables[0])
    assert run(spark, tables).records == 4
    assert sent(spark, tables) == ["a", "b", "before", "between", "c", "inside", "new"]
    spans = [(1, 2, 1), (5, 7, 3), (8, 10, 2), (12, 13, 1)]
    assert covered(spark, tables) == [("first_party", *span) for span in spans]
    assert run(spark, tables).records == 0
    assert spark.table(tables[2]).count() == 3 + 4


def test_rows_without_a_stamp_and_rows_of_the_future(spark, tables):
    ahead = datetime(2200, 1, 1, tzinfo=timezone.utc)
    append_rows(members(spark, ("a", None), ("b", None), ("c", ahead), ("d", datetime(1969, 12, 31, 23, 59, tzinfo=timezone.utc))), tables[0])
    summary = run(spark, tables)
    assert (summary.records, summary.unstamped, summary.mark) == (2, 2, None)
    summary = run(spark, tables)
    assert (summary.records, summary.unstamped) == (0, 2)
    assert sent(spark, tables) == ["c", "d"]


def test_a_changed_row_goes_out_again_and_a_failed_one_does_not(spark, tables):
    append_rows(members(spark, ("a", at(1)), ("b", at(1, 1))), tables[0])
    assert run(spark, tables, failing_first_item, parallelism="source", batch_size=2).failed >= 1
    append_rows(members(spark, ("a", at(1, 30)), ("c", at(1, 2))), tables[0])
    assert run(spark, tables).records == 2
    assert sent(spark, tables) == ["a", "a", "b", "c"]


def test_no_rows(spark, tables):
    assert run(spark, tables).records == 0
    assert covered(spark, tables) == []


def test_feeds_and_grains_are_apart(spark, tables):
    append_rows(members(spark, ("a", at(1)), ("b", at(2, 30))), tables[0])
    assert run(spark, tables, feed="x").records == 2
    assert covered(spark, tables) == [("x", 1, 3, 2)]
    # Cells of another width are not covered; rows that have a result are left out all the same.
    assert run(spark, tables, feed="x", grain=timedelta(days=1)).records == 0
    assert run(spark, tables, feed="x", grain=timedelta(days=1)).records == 0
    assert covered(spark, tables) == [("x", 0, 24, 4)]


def test_a_stopped_run_leaves_its_cells_open(spark, tables, tmp_path):
    append_rows(members(spark, *[(f"v{n}", at(n)) for n in range(6)]), tables[0])
    options = {"parallelism": 1, "batch_size": 2}
    refusing = logging_sender(str(tmp_path), lambda request: fatal(401, "no") if b"v" in request.body() else None)
    with pytest.raises(SendError):
        run(spark, tables, refusing, **options)
    assert covered(spark, tables) == []
    tried = len(requests_in(str(tmp_path)))
    assert tried == 1
    # The refused batch has its status; the others are sent now.
    assert run(spark, tables, **options).records == 4
    assert len(sent(spark, tables)) == 6 == len(set(sent(spark, tables)))


def test_digest_does_not_depend_on_order_but_on_every_row(spark):
    rows = [("a", at(1)), ("b", at(1, 5)), ("b", at(1, 5)), (None, at(1))]
    digest = lambda given: [row["digest"] for row in cells(members(spark, *given), CONTRACT, KEY, HOUR).collect()]
    whole = digest(rows)
    assert digest(rows[::-1]) == whole
    others = [rows[1:], rows[:1] + rows[3:], [*rows, rows[0]], [*rows, rows[0], rows[0]], [("a", at(1, 1)), *rows[1:]]]
    assert all(digest(other) != whole for other in others)


def test_the_first_pass_reads_key_and_stamp_alone(spark, tables):
    append_rows(members(spark, ("a", at(1))), tables[0])
    found = open_cells(spark.table(tables[0]), spark.table(tables[2]), CONTRACT, KEY, "first_party", HOUR)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id_value:string,updated_at:timestamp>" in plan


def test_guards(spark, tables):
    with pytest.raises(ConfigurationError):
        run_intervals(spark, CONTEXT, accepting, tables[0], tables[1], f"none_{uuid4().hex}", KEY)
    with pytest.raises(ConfigurationError):
        run(spark, tables, grain=timedelta(0))
    with pytest.raises(ContractError):
        run_intervals(spark, CONTEXT, accepting, *tables, ["no_such_column"])


def test_neighbours_are_one_interval(spark):
    row = lambda feed, a, b, n, run: (feed, at(a), at(b), n, n, at(run))
    schema = "feed string, from_date timestamp, to_date timestamp, records long, digest long, run_timestamp timestamp"
    rows = [row("x", 1, 2, 5, 50), row("x", 2, 3, 1, 50), row("x", 1, 2, 7, 60), row("x", 0, 10, 1, 50), row("x", 11, 12, 1, 50)]
    found = intervals(spark.createDataFrame([*rows, row("y", 2, 3, 4, 50)], schema))
    shown = {(r["feed"], r["n"]) for r in found.select("feed", F.col("records").alias("n")).collect()}
    assert shown == {("x", 9), ("x", 1), ("y", 4)}
