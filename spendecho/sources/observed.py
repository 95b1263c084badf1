"""Counters of a write."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed(seen: Observation, name: str, empty: int = 0) -> int:
    """A counter of a finished write. Adaptive planning drops the counter together with
    an input that turns out to be empty; then it is `empty`."""
    try:
        return seen.get[name]
    except Py4JJavaError as e:
        if "AssertionError" not in str(e):
            raise
        return empty
