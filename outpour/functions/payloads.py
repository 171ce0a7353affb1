"""Payload items: one struct per row, and its JSON text.

A null field means "not sent": ``to_json`` leaves null fields out at every depth, so no row is
ever rewritten to drop them. Empty arrays are turned to null for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outpour.functions.identity import ID_FIELDS, user_id_pairs

# Optional plain fields of a conversion, in payload order.
CONVERSION_FIELDS = [
    "data_provider_user_id",
    "cookie_mapping_partner_id",
    "order_id",
    "impression_id",
    "value",
    "value_currency",
    "country",
    "region",
    "metro",
    "city",
    "merchant_id",
    "event_name",
    *[f"td{n}" for n in range(1, 11)],
]

# Micros are kept (Spark's default JSON format cuts to millis) and the zone is always UTC.
_JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timeZone": "UTC"}


def item_json(item: Column) -> Column:
    """JSON text of a payload item without its null fields."""
    return F.to_json(item, _JSON_OPTIONS)


def non_empty(values: Column) -> Column:
    """The array, or null when it is null or empty."""
    return F.when(F.size(values) > 0, values)


def _identity_columns(field: Column) -> list[Column]:
    return [F.when(field == name, F.col("id_value")).alias(name) for name in ID_FIELDS.values()]


def _membership(field: Column, *data_fields: str) -> Column:
    data = F.struct(F.col("segment_name").alias("name"), *[F.col(name).alias(name) for name in data_fields])
    partner = F.col("cookie_mapping_partner_id").alias("cookie_mapping_partner_id")
    return F.struct(*_identity_columns(field), F.array(data).alias("data"), partner)


# The items below take the identity's payload field as a Column, so that a caller who has
# looked it up in an earlier projection does not pay for the lookup once per field.


def first_party_item(field: Column) -> Column:
    """A membership with its time, lifetime and bids."""
    bids = ["base_bid_cpm", "base_bid_cpm_metadata", "bid_factor"]
    return _membership(field, "timestamp_utc", "ttl_in_minutes", *bids)


def third_party_item(field: Column) -> Column:
    """A membership with its time and lifetime."""
    return _membership(field, "timestamp_utc", "ttl_in_minutes")


def subject_request_item(field: Column) -> Column:
    """The identity a deletion or opt-out is about."""
    return F.struct(*_identity_columns(field))


def conversion_item(field: Column) -> Column:
    """A conversion with its user ids, line items and privacy settings; has no single identity."""
    return F.struct(
        F.col("tracking_tag_id").alias("tracking_tag_id"),
        F.col("timestamp_utc").alias("timestamp_utc"),
        user_id_pairs(F.col("user_ids")).alias("user_id_array"),
        *[F.col(name).alias(name) for name in CONVERSION_FIELDS],
        non_empty(F.col("line_items")).alias("line_items"),
        non_empty(F.col("privacy_settings")).alias("privacy_settings"),
    )
