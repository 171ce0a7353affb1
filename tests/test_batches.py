import json
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from outpour import ContractError, Conversion, FirstParty
from outpour.operators.batches import SPREAD_BATCHES, gather_requests, number_batches


def batches(numbered):
    """Batch -> its item numbers, sorted."""
    found = defaultdict(list)
    for row in numbered.select("bucket", "batch_no", "item_number").collect():
        found[row["bucket"], row["batch_no"]].append(row["item_number"])
    return {batch: sorted(numbers) for batch, numbers in found.items()}


def check(numbered, df, batch_size):
    """Every row in one batch, items 1..n, all batches of a bucket full but the last."""
    assert Counter(map(tuple, numbered.select(*df.columns).collect())) == Counter(map(tuple, df.collect()))
    last = defaultdict(int)
    found = batches(numbered)
    for (bucket, batch_no), numbers in found.items():
        assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) <= batch_size
        last[bucket] = max(last[bucket], batch_no)
    for (bucket, batch_no), numbers in found.items():
        assert batch_no == last[bucket] or len(numbers) == batch_size
    for bucket, number in last.items():
        assert {b for k, b in found if k == bucket} == set(range(number + 1))


@pytest.mark.parametrize("unique_rows", [False, True])
@pytest.mark.parametrize("bucket, slices", [(None, 1), ("id % 3", 1), ("id % 3", 4), ("0", 2)])
def test_rows_are_numbered_once(spark, unique_rows, bucket, slices):
    df = spark.range(1000).withColumn("name", F.concat(F.lit("n"), F.col("id")))
    label = F.expr(bucket) if bucket else None
    check(number_batches(df, 7, ["id"], label, slices, unique_rows), df, 7)


def test_both_ways_agree_and_do_not_depend_on_partitions(spark):
    df = spark.range(500).withColumn("x", F.col("id") * 2)
    bucket = F.expr("id div 100")
    expected = set(number_batches(df, 9, ["id"], bucket).collect())
    assert set(number_batches(df.repartition(7), 9, ["id"], bucket, unique_rows=True).collect()) == expected
    assert set(number_batches(df.coalesce(1), 9, ["id"], bucket, parallelism=3).collect()) == expected
    assert {r["bucket"] for r in expected} == set(range(5))


@pytest.mark.parametrize("unique_rows", [False, True])
def test_global_numbers_depend_on_rows_alone(spark, unique_rows):
    df = spark.range(1, 2000, 1, 3).selectExpr("id * 7919 % 2003 AS id", "id % 5 AS n")
    df = df if unique_rows else df.unionByName(spark.range(900).selectExpr("cast(5 as bigint) id", "cast(1 as bigint) n"))
    only, seen = F.expr("n <> 3"), []
    for partitions, frame in ((3, df), (7, df.repartition(11)), (1, df.coalesce(1))):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            numbered = number_batches(frame, 10, ["id"], "global", unique_rows=unique_rows, only=only)
            seen.append(Counter(map(tuple, numbered.collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert seen[0] == seen[1] == seen[2]
    placed = sorted((row[3], row[4], row[0]) for row in seen[0].elements() if row[3] is not None)
    ids = sorted(row["id"] for row in df.filter(only).collect())
    assert placed == [(k // 10, k % 10 + 1, one) for k, one in enumerate(ids)]
    assert sum(row[3] is None for row in seen[0].elements()) == df.filter(~only).count()


def test_global_numbers_of_nothing(spark):
    assert number_batches(spark.range(0), 5, ["id"], "global").collect() == []
    assert number_batches(spark.range(3), 5, ["id"], "global", only=F.lit(False)).filter("batch_no IS NULL").count() == 3
    with pytest.raises(ValueError):
        number_batches(spark.range(1), 5, ["id"], "elsewhere")


ODD = """
SELECT id, IF(id % 2 = 0, map('a', 1, 'b', 2), map('b', 2, 'a', 1)) AS m,
  IF(id % 3 = 0, 'A', 'a') COLLATE utf8_lcase AS c, IF(id % 4 = 0, -0.0D, 0.0D) AS z,
  parse_json(IF(id % 5 = 0, '{"x": [1, null]}', '7')) AS v,
  IF(id % 6 = 0, NULL, array(named_struct('m', map(1, 'x'), 'c', 'Q' COLLATE utf8_lcase))) AS n
FROM (SELECT id % 60 AS id FROM range(240))
"""


@pytest.mark.parametrize("bucket", [None, "global", "0"])
@pytest.mark.parametrize("unique_rows", [False, True])
def test_columns_of_any_type(spark, bucket, unique_rows):
    df = spark.sql(ODD).repartition(3)
    df = df.dropDuplicates(["id"]) if unique_rows else df
    label = F.expr(bucket) if bucket == "0" else bucket
    numbered = number_batches(df, 7, ["id"], label, unique_rows=unique_rows)
    shown = ["id", "to_json(array_sort(map_entries(m))) m", "cast(c as binary) c", "cast(z as string) z", "to_json(v) v", "to_json(n) n"]
    assert Counter(map(str, numbered.selectExpr(*shown).collect())) == Counter(map(str, df.selectExpr(*shown).collect()))
    check(numbered.select("id", "bucket", "batch_no", "item_number"), df.select("id"), 7)


@pytest.mark.parametrize("key", ["m", "c", "v", "z"])
def test_keys_of_any_type(spark, key):
    df = spark.sql(ODD).dropDuplicates(["id"])
    expected = None
    for frame in (df, df.repartition(5)):
        numbered = number_batches(frame, 7, [key, "id"], "global")
        numbers = sorted(map(tuple, numbered.select("id", "batch_no", "item_number").collect()))
        assert expected in (None, numbers) and len(numbers) == 60
        expected = numbers


def test_copies_hold_most_rows(spark):
    size = 3
    copies = 3 * SPREAD_BATCHES * size + 5
    hot = spark.range(copies).select(F.lit(1).alias("id"), F.lit("same").alias("name"))
    df = hot.union(spark.range(2, 50).select("id", F.lit("other"))).union(hot.limit(4).withColumn("name", F.lit("z")))
    numbered = number_batches(df, size, ["id"])
    check(numbered, df, size)
    check(number_batches(df, size, ["id"], F.lit(0)), df, size)
    # The copies of one row are written by several tasks.
    tasks = numbered.filter("name = 'same'").select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1


def test_only_some_rows_are_numbered(spark):
    df = spark.range(200)
    for unique_rows in (False, True):
        numbered = number_batches(df, 6, ["id"], F.expr("id div 50"), unique_rows=unique_rows, only=F.expr("id % 4 <> 0"))
        assert numbered.count() == 200
        check(numbered.filter("batch_no IS NOT NULL"), df.filter("id % 4 <> 0"), 6)
        rest = numbered.filter("batch_no IS NULL").select("id", "item_number").collect()
        assert sorted(row["id"] for row in rest) == list(range(0, 200, 4))
        assert all(row["item_number"] is None for row in rest)


def test_nested_columns_and_odd_names(spark):
    df = spark.sql("SELECT id, array(named_struct('a', id % 3)) AS `l.s`, NULL AS `b c` FROM range(40)")
    assert number_batches(df, 4, ["id"]).count() == 40


def test_number_of_hash_buckets(spark):
    df = spark.range(400)
    for unique_rows in (False, True):
        numbered = number_batches(df, 10, ["id"], 3, unique_rows=unique_rows)
        check(numbered, df, 10)
        assert numbered.select("bucket").distinct().count() == 3


def test_columns_must_be_free(spark):
    with pytest.raises(ContractError, match="batch_no"):
        number_batches(spark.range(1).withColumn("Batch_No", F.lit(1)), 10, ["id"])


def test_sizes_are_checked(spark):
    with pytest.raises(ValueError):
        number_batches(spark.range(1), 0, ["id"])
    with pytest.raises(ValueError):
        number_batches(spark.range(1), 1, ["id"], slices=0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffles(spark):
    df = spark.createDataFrame([(n, "y") for n in range(20)], "id long, x string")
    assert plan(number_batches(df, 10, ["id"], unique_rows=True)).count("Exchange") == 1
    assert plan(number_batches(df, 10, ["id"])).count("Exchange") == 3


def test_few_copies_are_numbered_without_folding(spark):
    """In one shuffle over as many tasks, with the same numbers; a bound that says too little changes nothing."""
    df = spark.range(300).selectExpr("id div 3 AS id", "id % 2 AS other", "cast(null AS string) AS note")
    bucket, only = F.expr("id div 20"), F.expr("id % 7 <> 0")
    folded = number_batches(df, 4, ["id"], bucket, only=only)
    few = number_batches(df, 4, ["id"], bucket, only=only, most_copies=2)
    assert plan(few).count("Exchange") == 1 and "hashpartitioning(__bucket" in plan(few)
    assert sorted(map(str, few.collect())) == sorted(map(str, folded.collect()))
    hashed = [number_batches(df, 4, ["id"], 3, most_copies=most) for most in (None, 2)]
    assert sorted(map(str, hashed[0].collect())) == sorted(map(str, hashed[1].collect()))
    many = number_batches(df, 4, ["id"], bucket, most_copies=SPREAD_BATCHES * 4 + 1)
    assert plan(many).count("Exchange") == 3
    assert number_batches(df, 4, ["id"], "global", most_copies=2).filter("batch_no = 0").count() == 4


def test_requests(spark):
    rows = [(n, "TDID" if n % 5 else "CoreID", f"v{n}", "s") for n in range(23)]
    df = spark.createDataFrame(rows, "n int, id_type string, id_value string, segment_name string")
    numbered = number_batches(df, 4, ["n"], F.lit(0), unique_rows=True, only=F.col("id_type") == "TDID")
    requests = gather_requests(numbered, FirstParty("adv"), "t1").orderBy("batch_no").collect()
    sendable = [n for n in range(23) if n % 5]
    assert [row["items"] for row in requests] == [4, 4, 4, 4, 2]
    for row in requests:
        body = json.loads(row["body"])
        sent = [item["tdid"] for item in body.pop("items")]
        assert sent == [f"v{n}" for n in sendable[row["batch_no"] * 4 :][:4]]
        assert body == json.loads(row["envelope"]) and body["data_load_trace_id"] == "t1"
        assert not row["has_user_ids"]


def test_requests_without_another_shuffle(spark):
    df = spark.range(100).selectExpr("id", "'TDID' id_type", "'v' id_value", "'s' segment_name")
    requests = gather_requests(number_batches(df, 10, ["id"], unique_rows=True), FirstParty("a"))
    assert plan(requests).count("Exchange") == 1


def test_user_id_format_is_per_request(spark):
    df = spark.sql(
        """SELECT id, 't' tracking_tag_id, TIMESTAMP '2024-01-01' timestamp_utc, 'i' impression_id,
           CASE WHEN id = 3 THEN array(named_struct('type', 'EUID', 'id', 'e')) END user_ids FROM range(6)"""
    )
    numbered = number_batches(df, 2, ["id"], F.lit(0))
    requests = gather_requests(numbered, Conversion("p")).orderBy("batch_no").collect()
    formats = [json.loads(row["envelope"]).get("user_id_array_metadata_format") for row in requests]
    assert formats == [None, ["type", "id"], None]
