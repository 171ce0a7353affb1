"""Deliver audience, conversion and data-subject-request tables from Spark."""

from outpour.contracts import (
    CONTRACTS,
    LEDGER_SCHEMA,
    Context,
    Contract,
    Conversion,
    DataOrigin,
    DsrAdvertiser,
    DsrMerchant,
    DsrThirdParty,
    FirstParty,
    RequestType,
    ThirdParty,
    result_schema,
)
from outpour.errors import ConfigurationError, ContractError, DeliveryError, SendError
from outpour.operators.conform import conform, validate
from outpour.operators.deliver import Outcome, Request, deliver, fatal, ok, partial, server_error, transient
from outpour.plans.batch import RunSummary, run_batch
from outpour.plans.intervals import run_intervals
from outpour.plans.push import push
from outpour.sources.tables import (
    create_coverage_table,
    create_input_table,
    create_ledger_table,
    create_output_table,
    visible_results,
)
from outpour.streaming.increments import run_stream
from outpour.streaming.retries import run_retrying_stream

__all__ = [
    "CONTRACTS",
    "LEDGER_SCHEMA",
    "ConfigurationError",
    "Context",
    "Contract",
    "ContractError",
    "Conversion",
    "DataOrigin",
    "DeliveryError",
    "DsrAdvertiser",
    "DsrMerchant",
    "DsrThirdParty",
    "FirstParty",
    "Outcome",
    "Request",
    "RequestType",
    "RunSummary",
    "SendError",
    "ThirdParty",
    "conform",
    "create_coverage_table",
    "create_input_table",
    "create_ledger_table",
    "create_output_table",
    "deliver",
    "fatal",
    "ok",
    "partial",
    "push",
    "result_schema",
    "run_batch",
    "run_intervals",
    "run_retrying_stream",
    "run_stream",
    "server_error",
    "transient",
    "validate",
    "visible_results",
]
