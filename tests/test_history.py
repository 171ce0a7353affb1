import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from outpour.operators import keyfilter
from outpour.operators.history import retry_set, skip_delivered
from outpour.operators.keyfilter import look_at

START = datetime(2024, 1, 1)
RESULTS = "key string, n int, success boolean, error_code string, processed_timestamp timestamp"


def results(spark, *rows):
    """(key, n, success, hour) each."""
    full = [(k, n, ok, None if ok else "X", START + timedelta(hours=hour)) for k, n, ok, hour in rows]
    return spark.createDataFrame(full, RESULTS)


def test_latest_status_counts(spark):
    df = results(spark, ("a", 1, False, 1), ("a", 2, True, 2), ("b", 3, True, 1), ("b", 4, False, 2), ("c", 5, False, 0))
    assert sorted((row["key"], row["n"]) for row in retry_set(df, ["key"]).collect()) == [("b", 4), ("c", 5)]


def test_success_wins_at_the_same_instant(spark):
    df = results(spark, ("a", 1, False, 1), ("a", 2, True, 1), ("b", 3, False, 1), ("b", 3, False, 1))
    assert [(row["key"], row["n"]) for row in retry_set(df, ["key"]).collect()] == [("b", 3)]


def test_retry_against_a_model(spark):
    rng = random.Random(3)
    rows = [(f"k{rng.randint(0, 40)}", n, rng.random() < 0.5, n) for n in range(300)]
    latest = {}
    for row in rows:
        latest[row[0]] = row
    expected = sorted((k, n) for k, n, ok, _ in latest.values() if not ok)
    found = retry_set(results(spark, *rows).repartition(5), ["key"])
    assert sorted((row["key"], row["n"]) for row in found.collect()) == expected


def test_null_keys_are_one_key(spark):
    df = results(spark, (None, 1, False, 1), (None, 2, True, 2), ("a", 3, False, 1))
    assert [row["n"] for row in retry_set(df, ["key"]).collect()] == [3]
    assert [row["n"] for row in retry_set(df.filter("n <> 2"), ["key"]).orderBy("n").collect()] == [1, 3]


def test_retry_plan(spark, tmp_path):
    """Rows are reduced before the shuffle, the join adds none, and successes are read narrow."""
    results(spark, ("a", 1, False, 1)).write.parquet(str(tmp_path / "results"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = retry_set(spark.read.parquet(str(tmp_path / "results")), ["key"])
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "partial_max_by" in plan and plan.count("hashpartitioning") == 2 and "SortMergeJoin" in plan
    scans = [line.split("ReadSchema: ")[1] for line in plan.split("\n") if "FileScan" in line]
    assert len(scans) == 2
    assert "struct<key:string,success:boolean,processed_timestamp:timestamp>" in scans


@pytest.mark.parametrize("hot_rows", [1, 20, 1_000_000])
def test_skip_against_a_model(spark, hot_rows):
    rng = random.Random(5)
    kinds = [*["hot1"] * 20, *["hot2"] * 10, None, *[f"k{n}" for n in range(30)]]
    rows = [(rng.choice(kinds), n) for n in range(400)]
    done = [("hot1", 1, True, 1), ("k1", 1, True, 1), ("k2", 1, False, 1), ("k3", 1, True, 1), ("k3", 1, False, 2)]
    delivered = {key for key, _, ok, _ in done if ok}
    frame = spark.createDataFrame(rows, "key string, n int").repartition(4)
    left = skip_delivered(frame, results(spark, *done), ["key"], hot_rows)
    expected = sorted(n for key, n in rows if key not in delivered)
    assert sorted(row["n"] for row in left.collect()) == expected
    assert left.columns == ["key", "n"]


def test_skip_by_two_columns_with_nulls(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), (None, 1), ("b", 1)], "key string, n int")
    done = results(spark, ("a", 1, True, 1), (None, 1, True, 1), ("a", None, True, 1))
    for hot_rows in (0, 10):
        left = {tuple(row) for row in skip_delivered(rows, done, ["key", "n"], hot_rows).collect()}
        assert left == {("a", None), (None, 1), ("b", 1)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_is_held_against_the_increment_where_it_is_scanned(spark, tmp_path):
    done = results(spark, *[(f"k{n}", n, n % 2 == 0, n % 48) for n in range(2000)])
    done.withColumn("id", F.col("n").cast("int")).repartition(3).write.parquet(str(tmp_path / "results"))
    spark.range(500, 600).write.parquet(str(tmp_path / "rows"))
    history, rows = (spark.read.parquet(str(tmp_path / name)) for name in ("results", "rows"))
    since = START + timedelta(hours=24)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    left = skip_delivered(rows, history, ["id"], since=since)
    text = plan(left)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in text.split("\n") if "FileScan" in line and "processed_timestamp" in line]
    assert len(scans) == 1 and all(
        part in scans[0] for part in ("EqualTo(success,true)", "GreaterThanOrEqual(processed_timestamp", "GreaterThanOrEqual(id,500)", "LessThanOrEqual(id,599)")
    )
    assert "n:int" not in scans[0] and text.count(str(tmp_path / "rows")) == 1
    expected = [n for n in range(500, 600) if not (n % 2 == 0 and n % 48 >= 24)]
    assert sorted(row["id"] for row in left.collect()) == expected


def test_thousands_of_hot_keys_are_dealt_out(spark):
    rows = spark.range(120_000).selectExpr("id % 6000 AS key", "id").repartition(3)
    rows = rows.filter("key < 5000 OR id < 6000")  # 5000 keys have 20 rows, 1000 have one
    done = spark.range(0, 6000, 3).selectExpr("cast(id as string) key", "id n", "true success", "timestamp'2024-01-01' processed_timestamp")
    done = done.withColumn("key", F.col("key").cast("int"))
    seen = look_at(rows, [F.col("key").cast("bigint")])
    heavy = seen.heavy(10)
    assert 4950 <= heavy.count() <= 5000 and heavy.filter("__parts < 2").count() == 0
    left = skip_delivered(rows, done, ["key"], 10)
    assert "__part" in plan(left) and "LeftAnti" in plan(left)
    assert left.count() == rows.filter("key % 3 <> 0").count()
    one = spark.range(5000).selectExpr("cast(1 as bigint) key", "'same' AS text").repartition(8)
    assert skip_delivered(one, done, ["key"], 100).count() == 5000 and skip_delivered(one, done.selectExpr("1 key", "n", "success", "processed_timestamp"), ["key"], 100).count() == 0


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_few_delivered_keys_come_to_the_rows(spark, hot_rows):
    rows = spark.range(3000).selectExpr("if(id % 10 = 0, null, id) AS key", "id").repartition(3)
    done = spark.range(0, 30_000, 7).selectExpr("id AS key", "id % 2 = 0 AS success", "timestamp'2024-01-01' AS processed_timestamp")
    seen = look_at(rows, [F.col("key").cast("bigint")], ranged=["key"])
    left = skip_delivered(rows, done, ["key"], hot_rows, seen=seen, keys_first=True)
    text = plan(left)
    assert "LeftAnti" in text and "hashpartitioning" not in text and "SortMergeJoin" not in text
    expected = skip_delivered(rows, done, ["key"], hot_rows)
    assert sorted(row["id"] for row in left.collect()) == sorted(row["id"] for row in expected.collect())


def test_bound_of_copies_counts_rows_without_a_key(spark):
    rows = spark.range(100).selectExpr("if(id < 40, null, id) AS key")
    seen = look_at(rows, [F.col("key")])
    assert seen.most_copies == 40 and seen.most_rows < 5
    assert look_at(rows.limit(0), [F.col("key")]).most_copies == 0


def test_filter_is_as_large_as_its_keys(spark):
    few = look_at(spark.range(1000), [F.col("id")])
    assert few.size == 256 and abs(few.keys - 1000) < 30
    none = look_at(spark.range(0), [F.col("id")])
    assert none.keys == 0 and none.marked(spark.range(5), [F.col("id")], "hit").filter("hit").count() == 0
    many = look_at(spark.range(0, 4_000_000, 1, 4), [F.col("id")])
    assert many.size == 1 << 20 and abs(many.keys / 4_000_000 - 1) < 0.01
    marked = many.marked(spark.range(3_900_000, 4_200_000, 1, 4), [F.col("id")], "hit")
    inside = F.col("id") < 4_000_000
    row = marked.agg(F.count_if(inside & F.col("hit")).alias("own"), F.count_if(~inside & F.col("hit")).alias("false")).first()
    assert row["own"] == 100_000 and row["false"] < 0.05 * 200_000


def test_filter_that_would_say_little_is_none(spark, monkeypatch):
    monkeypatch.setattr(keyfilter, "MAX_WORDS", 64)
    full = look_at(spark.range(100_000), [F.col("id")])
    assert full.packed is None and full.marked(spark.range(3), [F.col("id")], "hit").filter("hit").count() == 3
    rows = spark.range(100_000).withColumnRenamed("id", "key")
    done = spark.range(10).selectExpr("id AS key", "true success", "timestamp'2024-01-01' processed_timestamp")
    assert skip_delivered(rows, done, ["key"]).count() == 99_990


def test_keys_of_other_types_are_compared_by_the_join(spark):
    done = spark.sql("SELECT '7' AS key, true AS success, timestamp'2024-01-01' AS processed_timestamp")
    assert [row["key"] for row in skip_delivered(spark.range(6, 9).toDF("key"), done, ["key"]).orderBy("key").collect()] == [6, 8]
    lower = spark.sql("SELECT 'a' COLLATE utf8_lcase AS key")
    upper = done.select(F.expr("'A' COLLATE utf8_lcase AS key"), "success", "processed_timestamp")
    assert skip_delivered(lower, upper, ["key"]).count() == 0


def test_retry_set_of_rows_with_a_map(spark):
    rows = spark.sql(
        "SELECT 'k' AS id, map('a', 1) AS note, false AS success, timestamp'2024-01-01' AS processed_timestamp"
    )
    assert [row["note"] for row in retry_set(rows, ["id"]).collect()] == [{"a": 1}]
