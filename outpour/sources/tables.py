"""Input, output and ledger tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpour.contracts import COVERAGE_SCHEMA, LEDGER_SCHEMA, RUN_ID, Contract, result_schema, with_updated_at
from outpour.errors import ConfigurationError, ContractError
from outpour.operators.conform import missing_columns, quoted, same_name_rule
from outpour.operators.increment import instant
from outpour.sources.types import holds, join_schemas, widened


def _create(spark: SparkSession, name: str, schema: T.StructType, location: str | None, source: str | None) -> str:
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=location, source=source, schema=schema)
    return name


def create_input_table(
    spark: SparkSession,
    contract: Contract,
    name: str | None = None,
    location: str | None = None,
    source: str | None = None,
) -> str:
    """Create, if absent, the table an upstream job fills: the contract and ``updated_at``.

    ``location`` makes the table external; ``source`` is its format (the session's default if
    not given). Returns the name.
    """
    name = name or f"delivery_{contract.name}_input"
    return _create(spark, name, with_updated_at(contract.schema), location, source)


def create_output_table(
    spark: SparkSession,
    contract: Contract,
    name: str | None = None,
    location: str | None = None,
    source: str | None = None,
    input_schema: T.StructType | None = None,
    with_run_id: bool = False,
) -> str:
    """Create, if absent, the table of results: the input table's columns and the status.

    ``input_schema`` is what will be delivered, where that has further columns or wider types than the contract: each
    column gets the narrowest type that holds both. ``with_run_id`` adds the column by which a run's results become
    visible at once (see ``visible_results``).
    """
    name = name or f"delivery_{contract.name}_output"
    schema = with_updated_at(contract.schema)
    if input_schema is not None:
        shown = T.StructType([field for field in input_schema if not field.name.startswith("_")])
        try:
            schema = join_schemas(schema, shown, same_name_rule(spark))
        except ValueError as error:
            raise ContractError(f"{contract.display_name}: {error}", [], contract.name, "output") from error
    schema = result_schema(schema)
    return _create(spark, name, T.StructType([*schema, RUN_ID]) if with_run_id else schema, location, source)


def create_ledger_table(
    spark: SparkSession,
    name: str | None = None,
    location: str | None = None,
    source: str | None = None,
    with_run_id: bool = False,
) -> str:
    """Create, if absent, the table with one row per run. Feeds may share it.

    ``with_run_id``: the row also says which results are whole, see ``visible_results``.
    """
    schema = T.StructType([*LEDGER_SCHEMA, RUN_ID]) if with_run_id else LEDGER_SCHEMA
    return _create(spark, name or "delivery_ledger", schema, location, source)


def create_coverage_table(
    spark: SparkSession, name: str | None = None, location: str | None = None, source: str | None = None
) -> str:
    """Create, if absent, the table of cells of time that runs by intervals have read. Feeds may share it."""
    return _create(spark, name or "delivery_coverage", COVERAGE_SCHEMA, location, source)


def visible_results(results: DataFrame, ledger: DataFrame) -> DataFrame:
    """The results of runs that the ledger has, and those from before runs had an id.

    A run writes its results first and then one row to the ledger, so what it wrote counts from that row on, all at once;
    what a broken run left behind is never seen. The join is with one row for each run, which Spark broadcasts
    as long as that is small.
    """
    if missing_columns(results, [RUN_ID.name]):
        return results
    runs = ledger.filter(F.col(RUN_ID.name).isNotNull()).select(F.col(RUN_ID.name).alias("__run")).distinct()
    joined = results.join(runs, F.col(RUN_ID.name) == F.col("__run"), "left")
    return joined.filter(F.col(RUN_ID.name).isNull() | F.col("__run").isNotNull()).drop("__run")


def require_table(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name):
        raise ConfigurationError(f"table {name} does not exist; create it before the run")


def stamp_updated(df: DataFrame) -> DataFrame:
    """Rows for an input table, marked as changed now."""
    return df.withColumn("updated_at", F.current_timestamp())


# Types, each of which may go into a column of a later one.
_WIDENING = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def _fits(given: T.DataType, stored: T.DataType) -> bool:
    """Whether every value of a type can be stored as another."""
    here, there = given.simpleString(), stored.simpleString()
    widens = here in _WIDENING and there in _WIDENING and _WIDENING.index(here) < _WIDENING.index(there)
    return here == there or widens or holds(stored, given)


def aligned(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """The frame in a table's columns and types; absent ones become nulls.

    A column that the table does not have, or has with a type that the values may not fit, is an
    error here, before anything is computed: what has been sent must not fail to be stored.
    """
    rule = same_name_rule(df.sparkSession)
    stored = {rule(field.name): field.dataType for field in schema}
    unknown = [field.name for field in df.schema if rule(field.name) not in stored]
    if unknown:
        raise ContractError(f"table {table} has no column {unknown}", unknown, table, "output")
    misfits = [field.name for field in df.schema if not _fits(field.dataType, stored[rule(field.name)])]
    if misfits:
        raise ContractError(f"table {table} has another type for {misfits}", misfits, table, "output")
    own = {rule(field.name): field.dataType for field in df.schema}
    columns = []
    for field in schema:
        if rule(field.name) in own:
            column = widened(F.col(quoted(field.name)), own[rule(field.name)], field.dataType)
        else:
            column = F.lit(None).cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def append_rows(df: DataFrame, table: str) -> None:
    """Append to a table by column name; a table that is not there is created from the frame."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        stored = spark.table(table)
        df = aligned(df, stored.schema, table)
        df.write.insertInto(table)
    else:
        df.write.saveAsTable(table)


def append_run(
    spark: SparkSession,
    ledger: str,
    feed: str,
    mark: datetime | None,
    run_at: datetime,
    records: int,
    run_id: str | None = None,
) -> None:
    """Append the record of one run, in one file: it is there as a whole or not at all."""
    last = F.lit(None) if mark is None else instant(mark)
    values = [F.lit(feed), last, instant(run_at), F.lit(records)]
    row = [value.cast(f.dataType).alias(f.name) for value, f in zip(values, LEDGER_SCHEMA)]
    if run_id is not None:
        row.append(F.lit(run_id).alias(RUN_ID.name))
    append_rows(spark.range(0, 1, 1, 1).select(*row), ledger)
