import json
import pickle

import pytest
from pyspark.sql import types as T

from outpour import (
    CONTRACTS,
    LEDGER_SCHEMA,
    ContractError,
    Conversion,
    DataOrigin,
    DeliveryError,
    DsrAdvertiser,
    DsrMerchant,
    DsrThirdParty,
    FirstParty,
    RequestType,
    SendError,
    ThirdParty,
    conform,
    result_schema,
    validate,
)
from outpour.errors import fatal_text, send_error

STATUS = ["success", "error_code", "error_message", "processed_timestamp"]
ORIGIN = {"id": "outpour", "type": "Integration"}


def empty(spark, *names):
    return spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType()) for name in names]))


@pytest.mark.parametrize(
    "name, required, columns",
    [
        ("first_party", ["id_type", "id_value", "segment_name"], 9),
        ("third_party", ["id_type", "id_value", "segment_name"], 6),
        ("conversion", ["tracking_tag_id", "timestamp_utc"], 27),
        ("dsr_advertiser", ["id_type", "id_value"], 2),
        ("dsr_third_party", ["id_type", "id_value"], 2),
        ("dsr_merchant", ["id_type", "id_value"], 2),
    ],
)
def test_columns(name, required, columns):
    assert CONTRACTS[name].required == required
    assert len(CONTRACTS[name].schema) == columns


def test_required_present(spark):
    validate(empty(spark, "id_type", "id_value", "segment_name", "more"), CONTRACTS["first_party"])


def test_all_missing_are_named(spark):
    with pytest.raises(ContractError) as caught:
        validate(empty(spark, "id_type"), CONTRACTS["first_party"])
    assert caught.value.columns == ["id_value", "segment_name"]
    assert caught.value.mode == "input" and "segment_name" in str(caught.value)


def test_output_needs_status(spark):
    contract = CONTRACTS["dsr_merchant"]
    validate(empty(spark, *contract.required, *STATUS), contract, "output")
    with pytest.raises(ContractError) as caught:
        validate(empty(spark, "id_type", "success"), contract, "output")
    assert caught.value.columns == ["id_value", "error_code", "error_message", "processed_timestamp"]


def test_conform_fills_typed_nulls(spark):
    conformed = conform(empty(spark, "id_type", "id_value", "segment_name", "extra"), CONTRACTS["first_party"])
    assert conformed.columns[:4] == ["id_type", "id_value", "segment_name", "extra"]
    for field in CONTRACTS["first_party"].optional:
        assert conformed.schema[field.name].dataType == field.dataType


def test_conform_fills_nested(spark):
    conformed = conform(empty(spark, "tracking_tag_id", "timestamp_utc"), CONTRACTS["conversion"])
    for field in CONTRACTS["conversion"].optional:
        assert conformed.schema[field.name].dataType == field.dataType


def test_conform_keeps_column_in_other_case(spark):
    df = spark.createDataFrame([("TDID", "a", "s", 7)], "id_type string, id_value string, segment_name string, TTL_IN_MINUTES int")
    row = conform(df, CONTRACTS["third_party"]).first()
    assert row["TTL_IN_MINUTES"] == 7
    assert len([name for name in row.asDict() if name.lower() == "ttl_in_minutes"]) == 1


def test_case_sensitive_session(spark):
    df = empty(spark, "ID_TYPE", "id_value")
    validate(df, CONTRACTS["dsr_merchant"])
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ContractError):
            validate(df, CONTRACTS["dsr_merchant"])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_conform_drops_hidden_and_is_idempotent(spark):
    df = empty(spark, "id_type", "id_value", "_rescued", "odd name", "a.b")
    once = conform(df, CONTRACTS["dsr_merchant"])
    assert once.columns == ["id_type", "id_value", "odd name", "a.b"]
    assert conform(once, CONTRACTS["dsr_merchant"]).columns == once.columns


def test_status_clash_is_refused(spark):
    with pytest.raises(ContractError) as caught:
        conform(empty(spark, "id_type", "id_value", "Success"), CONTRACTS["dsr_merchant"])
    assert caught.value.columns == ["success"]


def test_result_schema():
    schema = result_schema(T.StructType([T.StructField("a", T.LongType())]))
    assert schema.names == ["a", *STATUS]
    assert all(field.nullable for field in schema)


def test_ledger_schema():
    assert LEDGER_SCHEMA.names == ["feed", "last_processed_date", "run_timestamp", "records_processed"]


ENVELOPES = [
    (FirstParty("a"), {"advertiser_id": "a", "data_origins": [ORIGIN]}),
    (
        FirstParty("a", "p", (DataOrigin("crm", "Partner"),)),
        {"advertiser_id": "a", "data_provider_id": "p", "data_origins": [{"id": "crm", "type": "Partner"}, ORIGIN]},
    ),
    (ThirdParty("p"), {"data_provider_id": "p", "is_user_id_already_hashed": False, "data_origins": [ORIGIN]}),
    (ThirdParty("p", True), {"data_provider_id": "p", "is_user_id_already_hashed": True, "data_origins": [ORIGIN]}),
    (DsrAdvertiser("a", RequestType.OPT_OUT), {"advertiser_id": "a", "request_type": "OptOut"}),
    (
        DsrAdvertiser("a", RequestType.DELETION, "p"),
        {"advertiser_id": "a", "data_provider_id": "p", "request_type": "Deletion"},
    ),
    (DsrThirdParty("p", "Deletion"), {"data_provider_id": "p", "request_type": "Deletion"}),
    (
        DsrThirdParty("p", RequestType.OPT_OUT, "b"),
        {"data_provider_id": "p", "brand_id": "b", "request_type": "OptOut"},
    ),
    (DsrMerchant(7, RequestType.OPT_OUT), {"merchant_id": 7, "request_type": "OptOut"}),
    (Conversion("p"), {"data_provider_id": "p", "data_origins": [ORIGIN]}),
]


@pytest.mark.parametrize("context, fields", ENVELOPES)
def test_envelope_and_pickle(context, fields):
    assert json.loads(context.envelope()) == fields
    assert json.loads(context.envelope("t1")) == {**fields, "data_load_trace_id": "t1"}
    assert pickle.loads(pickle.dumps(context)) == context


def test_user_id_format_and_base_url():
    assert json.loads(Conversion("p").envelope(with_user_ids=True))["user_id_array_metadata_format"] == ["type", "id"]
    assert ThirdParty("p", base_url_override="https://example.org").base_url_override == "https://example.org"


def test_unknown_request_type():
    with pytest.raises(ValueError):
        DsrMerchant(1, "Forget").envelope()


def test_send_error_travels_as_text():
    body = 'line\n"quoted" {x} [/outpour-fatal] ü'
    error = send_error(RuntimeError("before " + fatal_text(403, body, (3, 4)) + " after"))
    assert isinstance(error, DeliveryError)
    assert (error.status_code, error.response_text, error.batch) == (403, body, (3, 4))
    assert "403" in str(error) and "3/4" in str(error)
    assert "no response" in str(SendError(None, "x", (0, 0)))
    assert send_error(RuntimeError("something else")) is None
