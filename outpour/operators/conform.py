"""Bring a frame to the contract of its destination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpour.contracts import STATUS_FIELDS, Contract
from outpour.errors import ContractError


def same_name_rule(spark: SparkSession):
    """Function that maps column names to what the session compares them by."""
    exact = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    return (lambda name: name) if exact else str.lower


def missing_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Those of ``names`` that the frame does not have. Looks at the schema only."""
    rule = same_name_rule(df.sparkSession)
    present = {rule(name) for name in df.columns}
    return [name for name in names if rule(name) not in present]


def validate(df: DataFrame, contract: Contract, mode: str = "input") -> None:
    """Raise ``ContractError`` naming every required column that is absent.

    ``mode="output"`` asks for the status columns too. Further columns are welcome.
    """
    if mode not in ("input", "output"):
        raise ValueError(f"mode must be 'input' or 'output', not {mode!r}")
    status = [field.name for field in STATUS_FIELDS]
    missing = missing_columns(df, contract.required + (status if mode == "output" else []))
    if missing:
        message = f"{contract.display_name}: the {mode} frame lacks {missing}"
        raise ContractError(message, missing, contract.name, mode)


def drop_hidden(df: DataFrame) -> DataFrame:
    """The frame without the columns whose name starts with an underscore."""
    return df.select(*[F.col(quoted(name)) for name in df.columns if not name.startswith("_")])


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """The frame with every column of the contract, ready to be shaped.

    Required columns are checked, absent optional ones become typed nulls, hidden columns go and
    all others stay as they are, in one projection.
    """
    validate(df, contract)
    status = [field.name for field in STATUS_FIELDS]
    clashing = [name for name in status if name not in missing_columns(df, status)]
    if clashing:
        message = f"{contract.display_name}: {clashing} would clash with the status columns"
        raise ContractError(message, clashing, contract.name)
    absent = set(missing_columns(df, [field.name for field in contract.optional]))
    return df.select(
        *[F.col(quoted(name)) for name in df.columns if not name.startswith("_")],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in contract.optional if f.name in absent],
    )


def quoted(name: str) -> str:
    """The column name as an identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"
