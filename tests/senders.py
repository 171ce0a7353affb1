"""Sender factories for tests, and the log of what they sent."""

from __future__ import annotations

import json
import os
from uuid import uuid4

from outpour import fatal, ok, partial


def logging_sender(folder, outcome=None):
    """Writes every request to a file of its own; answers with ``outcome(request)`` or success."""

    def factory():
        maker = uuid4().hex

        def send(request):
            sent = {
                "items": [json.loads(item) for item in request.items],
                "batch": [request.bucket, request.batch_no],
                "envelope": json.loads(request.envelope),
                "path": request.path,
                "pid": os.getpid(),
                "sender": maker,
            }
            with open(os.path.join(folder, uuid4().hex), "w") as file:
                json.dump(sent, file)
            return outcome(request) if outcome else ok()

        return send

    return factory


def requests_in(folder):
    found = []
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as file:
            found.append(json.load(file))
    return found


def accepting():
    return lambda request: ok()


def failing_first_item():
    return lambda request: partial([(1, "INVALID_ID", "bad")])


def refusing():
    return lambda request: fatal(401, 'no "entry" [/outpour-fatal] here')
