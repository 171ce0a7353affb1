"""Sender factories for the queries: pure functions of the request, so that SQL can predict them."""

from __future__ import annotations

import re

from outpour.operators.deliver import Outcome, Request, Send, fatal, ok, partial, server_error, transient

_EVENT_ID = re.compile(r'"base_bid_cpm_metadata":"(\d+)"')


def _bad_events(request: Request, divisor: int = 11) -> list[tuple]:
    """Every item whose event id is divisible by 11 fails."""
    ids = [int(_EVENT_ID.search(item).group(1)) for item in request.items]
    return [(n, "BAD", f"event {event_id}") for n, event_id in enumerate(ids, 1) if event_id % divisor == 0]


def accept_all() -> Send:
    def send(request: Request) -> Outcome:
        return ok()

    return send


def reject_bad_events() -> Send:
    def send(request: Request) -> Outcome:
        return partial(_bad_events(request))

    return send


def reject_worse_events() -> Send:
    """Of the bad events, half fail again."""

    def send(request: Request) -> Outcome:
        return partial(_bad_events(request, 22))

    return send


def accept_two_segments() -> Send:
    """Only views and clicks are taken."""
    taken = ('"name":"view"', '"name":"click"')

    def send(request: Request) -> Outcome:
        refused = [n for n, item in enumerate(request.items, 1) if not any(name in item for name in taken)]
        return partial([(n, "SEGMENT", None) for n in refused])

    return send


def reject_fifth_batches() -> Send:
    """Bad events, and a general error for every fifth batch."""

    def send(request: Request) -> Outcome:
        general = [(None, "GEN", f"batch {request.batch_no}")] if request.batch_no % 5 == 0 else []
        return partial(_bad_events(request) + general)

    return send


def break_often() -> Send:
    """Of four batches one times out, one meets a broken server and one an unheard-of status."""

    def send(request: Request) -> Outcome:
        kind = request.batch_no % 4
        if kind == 0:
            return transient("timed out")
        if kind == 1:
            return server_error(503, "overloaded")
        if kind == 2:
            return server_error(599, "odd")
        return partial(_bad_events(request))

    return send


def expire_midway() -> Send:
    """Batches with every hundredth event meet an expired token."""

    def send(request: Request) -> Outcome:
        return fatal(401, "token expired") if _bad_events(request, 100) else ok()

    return send


def echo_key() -> Send:
    """Every item fails with the request's key as code."""

    def send(request: Request) -> Outcome:
        return partial([(None, request.key, None)])

    return send


def name_one_too_many() -> Send:
    """Each response names the item behind the last one."""

    def send(request: Request) -> Outcome:
        return partial([(len(request.items) + 1, "HIGH", "no such item")])

    return send
