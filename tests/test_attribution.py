import random

import pytest
from pyspark.sql import functions as F

from outpour.functions.attribution import (
    RESPONSE_TYPE,
    attribute_batch,
    status_phrase,
    status_phrase_column,
    stray_failures,
)
from outpour.operators.attribute import attribute

BATCHES = f"n int, response {RESPONSE_TYPE}"


def model(failed, rows):
    """The rules, one failure after the other."""
    errors, general, any_general = {}, None, False
    for number, code, message in failed:
        if number is None:
            general, any_general = (code, message), True
        else:
            errors[number] = (code, message)
    statuses = []
    for number in range(1, rows + 1):
        if number in errors:
            statuses.append((False, *errors[number]))
        elif any_general:
            statuses.append((False, *general))
        else:
            statuses.append((True, None, None))
    return statuses


def column_statuses(spark, responses):
    given = [(0, batch, rows, response) for batch, (rows, response) in enumerate(responses)]
    df = spark.createDataFrame(given, f"bucket long, batch_no long, {BATCHES}").filter("n > 0")
    numbered = df.select("bucket", "batch_no", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("item_number"))
    found = attribute(numbered, df.drop("n")).orderBy("batch_no", "item_number")
    return [tuple(row) for row in found.select("success", "error_code", "error_message").collect()]


CASES = [
    ([], 2),
    ([(1, "INVALID_ID", "m")], 2),
    ([(None, "UNKNOWN", "m")], 2),
    ([(1, "INVALID_ID", "a"), (None, "UNKNOWN", "b")], 2),
    ([(None, None, None)], 2),
    ([(2, None, None)], 3),
    ([(1, "A", "x"), (1, "B", "y")], 1),
    ([(None, "A", "x"), (None, "B", "y")], 2),
    ([(0, "A", "x"), (3, "B", "y"), (-1, "C", "z")], 2),
]


@pytest.mark.parametrize("failed, rows", CASES)
def test_cases(spark, failed, rows):
    expected = model(failed, rows)
    assert list(zip(*attribute_batch(failed, rows))) == expected
    assert column_statuses(spark, [(rows, ("partial", None, None, failed))]) == expected


def test_random_batches(spark):
    rng = random.Random(7)
    batches = []
    for _ in range(400):
        rows = rng.randint(1, 8)
        numbers = [None, *range(-1, rows + 3)]
        failed = [
            (rng.choice(numbers), rng.choice([None, "A", "B"]), rng.choice([None, "x", "y"]))
            for _ in range(rng.randint(0, 6))
        ]
        batches.append((rows, failed))
    expected = [status for rows, failed in batches for status in model(failed, rows)]
    assert [s for rows, failed in batches for s in zip(*attribute_batch(failed, rows))] == expected
    assert column_statuses(spark, [(r, ("partial", None, None, f)) for r, f in batches]) == expected


def test_whole_batch_outcomes(spark):
    responses = [
        (2, ("transient", None, "timed out", None)),
        (1, ("server_error", 503, "body", None)),
        (1, ("server_error", 599, None, [])),
        (1, ("ok", None, None, None)),
    ]
    assert column_statuses(spark, responses) == [
        (False, None, "timed out"),
        (False, None, "timed out"),
        (False, "Service Unavailable", "body"),
        (False, "HTTP 599", None),
        (True, None, None),
    ]


def test_phrases(spark):
    codes = [200, 404, 418, 429, 500, 502, 599, 700]
    df = spark.createDataFrame([(c,) for c in codes], "status int").select(status_phrase_column(F.col("status")))
    assert [row[0] for row in df.collect()] == [status_phrase(c) for c in codes]
    assert status_phrase(500) == "Internal Server Error" and status_phrase(700) == "HTTP 700"


def test_strays(spark):
    failed = [(0, None, None), (3, None, None), (4, None, None), (None, None, None)]
    df = spark.createDataFrame([(3, ("ok", None, None, failed)), (3, ("ok", None, None, None))], BATCHES)
    counts = df.select(stray_failures(F.col("response.failed"), F.col("n"))).collect()
    assert [row[0] for row in counts] == [2, 0]


def test_response_is_computed_for_a_batch_and_not_for_each_of_its_rows(spark):
    """Where responses are made from the rows, no filter on them may end up below the step that finds the batches."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf(RESPONSE_TYPE)
    def respond(batch_no):
        calls.add(1)
        return None if batch_no == 1 else ("partial", None, None, [(1, "A", "x"), (None, "B", "y")])

    numbered = spark.range(2000).selectExpr("0L bucket", "id div 1000 batch_no", "cast(id % 1000 + 1 as int) item_number")
    batches = numbered.select("bucket", "batch_no").distinct()
    found = attribute(numbered, batches.withColumn("response", respond("batch_no")))
    counts = found.groupBy("success", "error_code", "error_message").count().collect()
    expected = {(False, None, "No response", 1000), (False, "A", "x", 1), (False, "B", "y", 999)}
    assert {tuple(row) for row in counts} == expected
    assert calls.value <= 20
