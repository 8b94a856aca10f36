"""Failure type raised by every check in the library."""

from __future__ import annotations


class CheckFailed(AssertionError):
    """A data check did not hold; ``report`` carries the measured numbers."""

    def __init__(self, message: str, report: dict | None = None):
        super().__init__(message)
        self.report = dict(report or {})
