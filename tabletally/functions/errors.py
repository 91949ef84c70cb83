"""Text of an exception for error rows."""

from __future__ import annotations


def error_text(exc: BaseException) -> str:
    """The whole message; an exception without one gives the name of its type."""
    return str(exc) or type(exc).__name__
