"""Identity names: which payload field an identity goes to, and its code in a conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identity name in upper case -> field of the payload item.
ID_FIELDS = {
    "TDID": "tdid",
    "DAID": "daid",
    "UID2": "uid2",
    "UID2TOKEN": "uid2_token",
    "EUID": "euid",
    "EUIDTOKEN": "euid_token",
    "RAMPID": "ramp_id",
    "ID5": "id5",
    "NETID": "net_id",
    "FIRSTID": "first_id",
    "MERKURYID": "merkury_id",
    "IQVIAPPID": "iqvia_ppid",
}

# User id type in upper case -> code in a conversion's user id array.
USER_ID_CODES = {
    "TDID": "0",
    "DAID": "1",
    "UID2": "2",
    "UID2TOKEN": "3",
    "EUID": "4",
    "EUIDTOKEN": "5",
    "RAMPID": "6",
}


def lookup(table: dict, key: Column) -> Column:
    """Value of ``key`` in a small constant table; null when it is not there."""
    entries = F.create_map(*[F.lit(part) for pair in table.items() for part in pair])
    return F.try_element_at(entries, key)


def identity_field(id_type: Column) -> Column:
    """Payload field for an identity name, whatever its case; null for unknown names."""
    return lookup(ID_FIELDS, F.upper(id_type))


def is_known_identity(id_type: Column) -> Column:
    """True for a known identity name; false for unknown and for null ones."""
    return F.coalesce(F.upper(id_type).isin(*ID_FIELDS), F.lit(False))


def user_id_code(user_id_type: Column) -> Column:
    """Code of a user id type, whatever its case; null for unknown types."""
    return lookup(USER_ID_CODES, F.upper(user_id_type))


def user_id_pairs(user_ids: Column) -> Column:
    """``[code, id]`` pairs in the given order; null when there are no user ids."""
    pairs = F.transform(user_ids, lambda user: F.array(user_id_code(user["type"]), user["id"]))
    return F.when(F.size(user_ids) > 0, pairs)


def has_unknown_user_id(user_ids: Column) -> Column:
    """True when some user id has no code."""
    unknown = F.exists(user_ids, lambda user: user_id_code(user["type"]).isNull())
    return F.coalesce(unknown, F.lit(False))
