"""From the response to a batch back to the status of each of its rows.

Two forms of the same rules: a Column for responses that lie in a table, and a function over
one batch for the sender inside a task. Rules, in order:

1. a failure with the row's item number is the row's error (the last one, if repeated);
2. else a failure without item number is the error of every remaining row (again the last);
3. else the row succeeded.

An error whose code and message are both null is still an error, so presence is decided on the
struct and never on its fields. Item numbers outside the batch match no row.
"""

from __future__ import annotations

from http import HTTPStatus

from pyspark.sql import Column
from pyspark.sql import functions as F

from outpour.functions.identity import lookup

RESPONSE_TYPE = (
    "struct<kind:string,status:int,message:string,"
    "failed:array<struct<item_number:int,error_code:string,message:string>>>"
)

# Kinds of responses that fail a batch as a whole.
WHOLE_KINDS = ("transient", "server_error")

_PHRASES = {status.value: status.phrase for status in HTTPStatus}


def status_phrase(status: int) -> str:
    """Reason phrase of a status code; ``HTTP <code>`` for codes without one."""
    return _PHRASES.get(status, f"HTTP {status}")


def status_phrase_column(status: Column) -> Column:
    """``status_phrase`` over a column."""
    return F.coalesce(lookup(_PHRASES, status), F.concat(F.lit("HTTP "), status.cast("string")))


def _error(code: Column, message: Column) -> Column:
    return F.struct(code.alias("error_code"), message.alias("error_message"))


def item_error(line: Column) -> Column:
    """Error struct of one line of a response's failures."""
    return _error(line["error_code"], line["message"])


def batch_error(response: Column) -> Column:
    """Error struct of the items that a response (``RESPONSE_TYPE``) does not name; null when they succeeded."""
    no_code = F.lit(None).cast("string")
    last = F.try_element_at(F.filter(response["failed"], lambda line: line["item_number"].isNull()), F.lit(-1))
    return (
        F.when(response["kind"] == "transient", _error(no_code, response["message"]))
        .when(
            response["kind"] == "server_error",
            _error(status_phrase_column(response["status"]), response["message"]),
        )
        .otherwise(F.when(last.isNotNull(), item_error(last)))
    )


def stray_failures(failed: Column, batch_rows: Column) -> Column:
    """How many failures name an item number outside 1..batch_rows."""
    strays = F.filter(failed, lambda line: (line["item_number"] < 1) | (line["item_number"] > batch_rows))
    return F.coalesce(F.size(strays), F.lit(0))


def count_strays(failed: tuple[tuple[int | None, str | None, str | None], ...], rows: int) -> int:
    """``stray_failures`` of the response to a batch of ``rows`` items."""
    return sum(1 for number, _, _ in failed if number is not None and not 1 <= number <= rows)


def attribute_batch(
    failed: list[tuple[int | None, str | None, str | None]], rows: int
) -> tuple[list[bool], list[str | None], list[str | None]]:
    """Success, error code and error message of each of ``rows`` items."""
    if not failed:
        return [True] * rows, [None] * rows, [None] * rows
    by_item = {number: (code, message) for number, code, message in failed if number is not None}
    general = [(code, message) for number, code, message in failed if number is None]
    fallback = general[-1] if general else None
    errors = [by_item.get(number, fallback) for number in range(1, rows + 1)]
    return (
        [error is None for error in errors],
        [error and error[0] for error in errors],
        [error and error[1] for error in errors],
    )
