import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from outpour import CONTRACTS, Conversion, DsrMerchant, FirstParty, RequestType, ThirdParty, conform
from outpour.functions.identity import ID_FIELDS, USER_ID_CODES, identity_field, is_known_identity
from outpour.operators.batches import shape
from outpour.operators.checks import quarantine, require_sendable, violations
from outpour.errors import ContractError

MEMBER = "id_type string, id_value string, segment_name string"
IDS = "array<struct<type:string,id:string>>"
AT = datetime(2024, 5, 6, 7, 8, 9, 123456)


def items(df, context):
    shaped = shape(conform(df, context.contract), context)
    return [row["_item"] and json.loads(row["_item"]) for row in shaped.collect()]


def test_required_fields_only(spark):
    df = spark.createDataFrame([("TDID", "abc", "seg")], MEMBER)
    expected = [{"tdid": "abc", "data": [{"name": "seg"}]}]
    assert items(df, FirstParty("a")) == expected
    assert items(df, ThirdParty("p")) == expected


def test_all_first_party_fields(spark):
    schema = f"{MEMBER}, cookie_mapping_partner_id string, timestamp_utc timestamp, ttl_in_minutes int, \
        base_bid_cpm double, base_bid_cpm_metadata string, bid_factor double"
    df = spark.createDataFrame([("rampid", "r", "seg", "c", AT, 5, 1.5, "m", 0.25)], schema)
    data = {"name": "seg", "timestamp_utc": "2024-05-06T07:08:09.123456Z", "ttl_in_minutes": 5}
    bids = {"base_bid_cpm": 1.5, "base_bid_cpm_metadata": "m", "bid_factor": 0.25}
    partner = {"cookie_mapping_partner_id": "c"}
    assert items(df, FirstParty("a")) == [{"ramp_id": "r", "data": [data | bids]} | partner]
    assert items(df, ThirdParty("p")) == [{"ramp_id": "r", "data": [data]} | partner]


def test_null_optionals_are_not_sent(spark):
    df = spark.createDataFrame([("UID2", "u", "seg", None)], f"{MEMBER}, ttl_in_minutes int")
    assert items(df, FirstParty("a")) == [{"uid2": "u", "data": [{"name": "seg"}]}]


def test_time_text_does_not_depend_on_session_zone(spark):
    df = spark.sql("SELECT 'TDID' id_type, 'a' id_value, 's' segment_name, TIMESTAMP '2024-05-06 07:08:09Z' timestamp_utc")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert items(df, ThirdParty("p"))[0]["data"][0]["timestamp_utc"] == "2024-05-06T07:08:09.000000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_subject_requests(spark):
    df = spark.createDataFrame([("netID", "n"), ("FirstId", "f")], "id_type string, id_value string")
    assert items(df, DsrMerchant(1, RequestType.DELETION)) == [{"net_id": "n"}, {"first_id": "f"}]


@pytest.mark.parametrize("change", [str.upper, str.lower, str.title])
def test_every_identity_in_any_case(spark, change):
    df = spark.createDataFrame([(change(name), field) for name, field in ID_FIELDS.items()], "name string, field string")
    wrong = df.filter((identity_field(F.col("name")) != F.col("field")) | ~is_known_identity(F.col("name")))
    assert wrong.count() == 0 and len(ID_FIELDS) == 12


def test_unknown_identities(spark):
    df = spark.createDataFrame([("CoreID",), ("",), (None,), ("tdid ",)], "name string")
    found = df.select(identity_field(F.col("name")).alias("field"), is_known_identity(F.col("name")).alias("known"))
    assert [tuple(row) for row in found.collect()] == [(None, False)] * 4


def conversion(spark, columns, *rows):
    rows = [("t", AT, *row) for row in rows]
    return spark.createDataFrame(rows, f"tracking_tag_id string, timestamp_utc timestamp, {columns}")


BARE = {"tracking_tag_id": "t", "timestamp_utc": "2024-05-06T07:08:09.123456Z"}


def test_user_id_codes(spark):
    all_types = [(name.lower() if n % 2 else name, f"v{n}") for n, name in enumerate(USER_ID_CODES)]
    df = conversion(spark, f"user_ids {IDS}", (all_types,), ([],), (None,))
    pairs = [[str(n), f"v{n}"] for n in range(7)]
    assert items(df, Conversion("p")) == [BARE | {"user_id_array": pairs}, BARE, BARE]


def test_unknown_user_id_type_is_not_sent(spark):
    df = conversion(spark, f"user_ids {IDS}", ([("TDID", "a"), ("ID5", "b")],), ([(None, "a")],), ([("EUID", "e")],))
    assert items(df, Conversion("p")) == [None, None, BARE | {"user_id_array": [["4", "e"]]}]


def test_nested_nulls_and_empty_lists(spark):
    schema = "line_items array<struct<item_code:string,name:string,qty:string,price:string,cat:string>>, \
        privacy_settings array<struct<privacy_type:string,is_applicable:string,consent_string:string>>"
    lines = [("c1", "n", "1", "2.50", None), ("c2", None, None, None, "k")]
    df = conversion(spark, schema, (lines, [("GDPR", "true", None)]), ([], []), (None, None))
    full = {
        "line_items": [{"item_code": "c1", "name": "n", "qty": "1", "price": "2.50"}, {"item_code": "c2", "cat": "k"}],
        "privacy_settings": [{"privacy_type": "GDPR", "is_applicable": "true"}],
    }
    assert items(df, Conversion("p")) == [BARE | full, BARE, BARE]


def test_plain_conversion_fields(spark):
    names = [f.name for f in CONTRACTS["conversion"].optional if f.dataType.simpleString() == "string"]
    df = conversion(spark, ", ".join(f"{name} string" for name in names), tuple(f"v-{name}" for name in names))
    assert len(names) == 22
    assert items(df, Conversion("p")) == [BARE | {name: f"v-{name}" for name in names}]


def test_quarantine_keeps_every_row_once(spark):
    df = spark.createDataFrame([("TDID", "a"), ("CoreID", "b"), (None, "c")], "id_type string, id_value string")
    sendable, rejected = quarantine(df, CONTRACTS["dsr_merchant"])
    assert [row["id_value"] for row in sendable.collect()] == ["a"]
    assert [(row["id_value"], row["reject_reasons"]) for row in rejected.collect()] == [
        ("b", ["UNKNOWN_ID_TYPE"]),
        ("c", ["UNKNOWN_ID_TYPE"]),
    ]


def test_documented_rules(spark):
    ids = [("TDID", str(n)) for n in range(21)]
    rows = [(ids[:20], None), (ids, None), (None, "imp"), ([], None), (None, None)]
    df = conversion(spark, f"user_ids {IDS}, impression_id string", *rows)
    df = df.withColumn("tracking_tag_id", F.when(F.size("user_ids") != 21, F.col("tracking_tag_id")))
    found = violations(conform(df, CONTRACTS["conversion"]), CONTRACTS["conversion"])
    reasons = sorted(row["reject_reasons"] for row in found.collect())
    assert reasons == sorted(
        [["NULL_TRACKING_TAG_ID", "TOO_MANY_USER_IDS"], ["NULL_TRACKING_TAG_ID"]]
        + [["NO_IDENTITY"], ["NULL_TRACKING_TAG_ID", "NO_IDENTITY"]]
    )


def test_strict_check(spark):
    df = spark.createDataFrame([("TDID", "a"), ("CoreID", "b")], "id_type string, id_value string")
    with pytest.raises(ContractError, match="UNKNOWN_ID_TYPE"):
        require_sendable(df, CONTRACTS["dsr_merchant"])
    require_sendable(df.limit(1), CONTRACTS["dsr_merchant"])
