"""Structured log lines: one JSON object a line to CORPUSENGINE_LOG (a file, or - for stderr; unset: nowhere), and timed spans."""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime


def log(event: str, **fields) -> dict:
    line = {"ts": datetime.now(UTC).isoformat(), "event": event} | fields
    sink = os.environ.get("CORPUSENGINE_LOG")
    if sink == "-":
        print(json.dumps(line, default=str), file=sys.stderr)
    elif sink:
        with open(sink, "a", encoding="utf-8") as f:
            f.write(json.dumps(line, default=str) + "\n")
    return line


@contextmanager
def span(event: str, **fields) -> Iterator[dict]:
    """Logs how long the block took and whether it failed; what the block puts into the dict goes along."""
    began, more = time.monotonic(), {}
    try:
        yield more
    except BaseException as e:
        log(event, ok=False, seconds=round(time.monotonic() - began, 3), error=f"{type(e).__name__}: {e}", **fields, **more)
        raise
    log(event, ok=True, seconds=round(time.monotonic() - began, 3), **fields, **more)
