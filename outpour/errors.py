"""Exceptions raised on the driver, and the way a task reports a fatal response to it."""

from __future__ import annotations

import json
import re

_FATAL = re.compile(r"\[outpour-fatal\](\{.*?\})\[/outpour-fatal\]", re.DOTALL)


class DeliveryError(Exception):
    """Base of every error this package raises."""


class ConfigurationError(DeliveryError):
    """The call, the session or a table is not set up for what was asked."""


class ContractError(DeliveryError):
    """A frame does not satisfy the contract of its destination."""

    def __init__(self, message: str, columns: list[str], contract: str, mode: str = "input") -> None:
        self.columns = columns
        self.contract = contract
        self.mode = mode
        super().__init__(message)


class SendError(DeliveryError):
    """The destination refused a whole request, or the sender itself broke.

    ``batch`` is ``(bucket, batch_no)``: the partition and the place in it, or the numbers
    that ``number_batches`` gave. ``results``, where there are some to read, are the rows that were sent.
    """

    results = None

    def __init__(self, status_code: int | None, response_text: str, batch: tuple[int, int]) -> None:
        self.status_code = status_code
        self.response_text = response_text
        self.batch = batch
        status = "no response" if status_code is None else f"HTTP {status_code}"
        super().__init__(f"Delivery failed ({status}) at batch {batch[0]}/{batch[1]}: {response_text}")


def fatal_text(status_code: int | None, response_text: str, batch: tuple[int, int]) -> str:
    """A fatal response as text, for a task to hand to the driver, where ``send_error`` reads it back.

    The body goes in as hex so that no text in it can end the marker.
    """
    fields = json.dumps({"status": status_code, "body": response_text.encode("utf-8", "replace").hex(), "batch": batch})
    return f"[outpour-fatal]{fields}[/outpour-fatal] {response_text}"


def send_error(error: BaseException | str) -> SendError | None:
    """The typed error behind a failed Spark job or in a text; None if there is no fatal response in it."""
    found = _FATAL.search(str(error))
    if found is None:
        return None
    fields = json.loads(found.group(1))
    body = bytes.fromhex(fields["body"]).decode("utf-8")
    return SendError(fields["status"], body, tuple(fields["batch"]))
