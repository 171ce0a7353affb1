"""Value checks: rows that cannot be shaped, and rows that break what a destination documents.

The checks are Columns, so a row is judged in the pass that shapes it: a rejected row is not
sent and its reasons become its status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpour.contracts import Contract
from outpour.errors import ContractError
from outpour.functions.identity import has_unknown_user_id, is_known_identity

# Fixed value: most user ids one conversion may carry.
MAX_USER_IDS = 20


def _reasons(checks: dict[str, Column]) -> Column:
    """The names of the checks that a row fails. Concatenation stays in generated code."""
    none = F.array().cast("array<string>")
    found = [F.when(broken, F.array(F.lit(reason))).otherwise(none) for reason, broken in checks.items()]
    return found[0] if len(found) == 1 else F.concat(*found)


def _unshapeable(contract: Contract, field: Column | None) -> dict[str, Column]:
    if contract.by_identity:
        known = is_known_identity(F.col("id_type")) if field is None else field.isNotNull()
        return {"UNKNOWN_ID_TYPE": ~known}
    return {"UNKNOWN_USER_ID_TYPE": has_unknown_user_id(F.col("user_ids"))}


def _documented(contract: Contract) -> dict[str, Column]:
    checks = {f"NULL_{name.upper()}": F.col(name).isNull() for name in contract.required}
    if not contract.by_identity:
        ids = F.coalesce(F.size("user_ids"), F.lit(0))
        checks["TOO_MANY_USER_IDS"] = ids > MAX_USER_IDS
        checks["NO_IDENTITY"] = (ids <= 0) & F.col("impression_id").isNull()
    return checks


def rejection_reasons(contract: Contract, documented: bool = False, field: Column | None = None) -> Column:
    """Why a conformed row cannot be sent; an empty array if it can.

    Always: an identity name without a payload field. With ``documented`` also the rules the
    destination documents: required values present, at most 20 user ids, user ids or an
    impression id. ``field`` is the identity's payload field if it is at hand already.
    """
    checks = _unshapeable(contract, field)
    return _reasons(checks | _documented(contract) if documented else checks)


def quarantine(df: DataFrame, contract: Contract, documented: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split a conformed frame into rows that can be sent and rows with ``reject_reasons``."""
    judged = df.withColumn("reject_reasons", rejection_reasons(contract, documented))
    sendable = judged.filter(F.size("reject_reasons") == 0).drop("reject_reasons")
    return sendable, judged.filter(F.size("reject_reasons") > 0)


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """The rows of a conformed frame that break some rule, with ``reject_reasons``."""
    return quarantine(df, contract, documented=True)[1]


def require_sendable(df: DataFrame, contract: Contract, documented: bool = False) -> None:
    """Strict mode: raise if any row of a conformed frame would be rejected.

    Runs one job that reads only the checked columns and stops at the first such row.
    """
    reasons = rejection_reasons(contract, documented)
    first = df.select(reasons.alias("reject_reasons")).filter(F.size("reject_reasons") > 0).take(1)
    if first:
        found = list(first[0]["reject_reasons"])
        raise ContractError(f"{contract.display_name}: some rows cannot be sent: {found}", found, contract.name)
