"""Retry of one call: a fresh counter per call, a pause between attempts."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

R = TypeVar("R")


def with_retry(
    action: Callable[[], R],
    attempts: int = 3,
    delay_s: float = 5.0,
    retry_on: tuple[type[BaseException], ...] = (Exception,),
    sleep: Callable[[float], None] = time.sleep,
    give_up_on: tuple[type[BaseException], ...] = (ValueError, TypeError),
) -> R:
    """Run ``action``; on failure wait ``delay_s`` and try again, ``attempts`` in all.

    Wrap the *action* (``collect``, ``save``), not only the reader: a JDBC
    reader connects at ``load()`` only to resolve the schema, and rows move at
    the action. The last error is raised, never swallowed. Errors in
    ``give_up_on`` (bad input, which a retry cannot fix) are raised at once.
    """
    if attempts < 1:
        raise ValueError("attempts must be at least 1")
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except give_up_on:
            raise
        except retry_on:
            if attempt == attempts:
                raise
            sleep(delay_s)
    raise AssertionError("unreachable")
