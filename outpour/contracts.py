"""Destinations: their table contracts, the context of a delivery, and the status and ledger columns.

In a contract *not nullable* means "the column must be there" and *nullable* means "the column
may be absent and is then filled with nulls". Values are checked separately
(``operators.checks``).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column
from pyspark.sql import types as T

from outpour.functions import payloads

ORIGIN = {"id": "outpour", "type": "Integration"}

STATUS_FIELDS = [
    T.StructField("success", T.BooleanType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("processed_timestamp", T.TimestampType()),
]

UPDATED_AT = T.StructField("updated_at", T.TimestampType())

# Names the run that wrote a result, and in the ledger the run that is whole.
RUN_ID = T.StructField("run_id", T.StringType())

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("last_processed_date", T.TimestampType()),
        T.StructField("run_timestamp", T.TimestampType()),
        T.StructField("records_processed", T.LongType()),
    ]
)

# One row for each cell of time that a run has read.
COVERAGE_SCHEMA = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("from_date", T.TimestampType()),
        T.StructField("to_date", T.TimestampType()),
        T.StructField("records", T.LongType()),
        T.StructField("digest", T.LongType()),
        T.StructField("run_timestamp", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Contract:
    """What a destination takes: columns, where it goes, and how a row becomes an item."""

    name: str
    display_name: str
    path: str
    schema: T.StructType
    item: Callable[[Column], Column]
    by_identity: bool

    @property
    def required(self) -> list[str]:
        return [field.name for field in self.schema if not field.nullable]

    @property
    def optional(self) -> list[T.StructField]:
        return [field for field in self.schema if field.nullable]


def result_schema(input_schema: T.StructType) -> T.StructType:
    """Columns of a delivery's result: those of the input, then the status."""
    return T.StructType([*input_schema.fields, *STATUS_FIELDS])


def with_updated_at(schema: T.StructType) -> T.StructType:
    """The columns plus ``updated_at``, by which increments are selected."""
    return T.StructType([*schema.fields, UPDATED_AT])


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _list_of(name: str, *fields: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.StructType(_strings(*fields))))


def _columns(required: list[T.StructField], optional: list[T.StructField]) -> T.StructType:
    return T.StructType([*(T.StructField(f.name, f.dataType, False) for f in required), *optional])


# The columns of each destination.
_IDENTITY = _strings("id_type", "id_value")
_MEMBERSHIP = [*_IDENTITY, *_strings("segment_name")]
_TIMESTAMP_UTC = T.StructField("timestamp_utc", T.TimestampType())
_AUDIENCE = [
    *_strings("cookie_mapping_partner_id"),
    _TIMESTAMP_UTC,
    T.StructField("ttl_in_minutes", T.IntegerType()),
]
_BIDS = [
    T.StructField("base_bid_cpm", T.DoubleType()),
    *_strings("base_bid_cpm_metadata"),
    T.StructField("bid_factor", T.DoubleType()),
]
_CONVERSION = [*_strings("tracking_tag_id"), _TIMESTAMP_UTC]
_CONVERSION_DETAILS = [
    _list_of("user_ids", "type", "id"),
    *_strings(*payloads.CONVERSION_FIELDS),
    _list_of("line_items", "item_code", "name", "qty", "price", "cat"),
    _list_of("privacy_settings", "privacy_type", "is_applicable", "consent_string"),
]

# Name, display name and path of each destination.
CONTRACTS = {
    contract.name: contract
    for contract in [
        Contract(
            "first_party",
            "Advertiser",
            "/data/advertiser",
            _columns(_MEMBERSHIP, [*_AUDIENCE, *_BIDS]),
            payloads.first_party_item,
            True,
        ),
        Contract(
            "third_party",
            "Third Party",
            "/data/thirdparty",
            _columns(_MEMBERSHIP, _AUDIENCE),
            payloads.third_party_item,
            True,
        ),
        Contract(
            "dsr_advertiser",
            "Deletion/Opt-Out Advertiser",
            "/data/deletion-optout/advertiser",
            _columns(_IDENTITY, []),
            payloads.subject_request_item,
            True,
        ),
        Contract(
            "dsr_third_party",
            "Deletion/Opt-Out Third Party",
            "/data/deletion-optout/thirdparty",
            _columns(_IDENTITY, []),
            payloads.subject_request_item,
            True,
        ),
        Contract(
            "dsr_merchant",
            "Deletion/Opt-Out Merchant",
            "/data/deletion-optout/merchant",
            _columns(_IDENTITY, []),
            payloads.subject_request_item,
            True,
        ),
        Contract(
            "conversion",
            "Offline Conversion",
            "/providerapi/offlineconversion",
            _columns(_CONVERSION, _CONVERSION_DETAILS),
            payloads.conversion_item,
            False,
        ),
    ]
}


class RequestType(str, Enum):
    """What a data subject asks for."""

    OPT_OUT = "OptOut"
    DELETION = "Deletion"


@dataclass(frozen=True)
class DataOrigin:
    """A system the data came from; goes into the request beside our own entry."""

    id: str
    type: str


@dataclass(frozen=True, kw_only=True)
class Context:
    """Where a delivery goes and the ids that scope it. Fields that are None are not sent."""

    base_url_override: str | None = None

    @property
    def contract(self) -> Contract:
        raise NotImplementedError

    def scope(self) -> dict:
        """The fields of the request that this context sets."""
        raise NotImplementedError

    def envelope(self, trace_id: str | None = None, with_user_ids: bool = False) -> str:
        """JSON text of the request without its items."""
        fields = self.scope()
        origins = fields.pop("data_origins", None)
        if with_user_ids:
            fields["user_id_array_metadata_format"] = ["type", "id"]
        fields["data_load_trace_id"] = trace_id
        fields["data_origins"] = origins
        return json.dumps({k: v for k, v in fields.items() if v is not None}, separators=(",", ":"))


def _origins(given: tuple[DataOrigin, ...] | None) -> list[dict]:
    return [*({"id": origin.id, "type": origin.type} for origin in given or ()), ORIGIN]


@dataclass(frozen=True)
class FirstParty(Context):
    advertiser_id: str
    data_provider_id: str | None = None
    data_origins: tuple[DataOrigin, ...] | None = None

    @property
    def contract(self) -> Contract:
        return CONTRACTS["first_party"]

    def scope(self) -> dict:
        return {
            "advertiser_id": self.advertiser_id,
            "data_provider_id": self.data_provider_id,
            "data_origins": _origins(self.data_origins),
        }


@dataclass(frozen=True)
class ThirdParty(Context):
    data_provider_id: str
    is_user_id_already_hashed: bool = False
    data_origins: tuple[DataOrigin, ...] | None = None

    @property
    def contract(self) -> Contract:
        return CONTRACTS["third_party"]

    def scope(self) -> dict:
        return {
            "data_provider_id": self.data_provider_id,
            "is_user_id_already_hashed": self.is_user_id_already_hashed,
            "data_origins": _origins(self.data_origins),
        }


@dataclass(frozen=True)
class DsrAdvertiser(Context):
    advertiser_id: str
    request_type: RequestType
    data_provider_id: str | None = None

    @property
    def contract(self) -> Contract:
        return CONTRACTS["dsr_advertiser"]

    def scope(self) -> dict:
        return {
            "advertiser_id": self.advertiser_id,
            "data_provider_id": self.data_provider_id,
            "request_type": RequestType(self.request_type).value,
        }


@dataclass(frozen=True)
class DsrThirdParty(Context):
    data_provider_id: str
    request_type: RequestType
    brand_id: str | None = None

    @property
    def contract(self) -> Contract:
        return CONTRACTS["dsr_third_party"]

    def scope(self) -> dict:
        return {
            "data_provider_id": self.data_provider_id,
            "brand_id": self.brand_id,
            "request_type": RequestType(self.request_type).value,
        }


@dataclass(frozen=True)
class DsrMerchant(Context):
    merchant_id: int
    request_type: RequestType

    @property
    def contract(self) -> Contract:
        return CONTRACTS["dsr_merchant"]

    def scope(self) -> dict:
        return {"merchant_id": self.merchant_id, "request_type": RequestType(self.request_type).value}


@dataclass(frozen=True)
class Conversion(Context):
    data_provider_id: str
    data_origins: tuple[DataOrigin, ...] | None = None

    @property
    def contract(self) -> Contract:
        return CONTRACTS["conversion"]

    def scope(self) -> dict:
        return {"data_provider_id": self.data_provider_id, "data_origins": _origins(self.data_origins)}
