"""Backoff arithmetic and error classes."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column
from pyspark.sql import functions as F

R = TypeVar("R")

# Status names by class.
TRANSIENT = frozenset({"UNAVAILABLE", "DEADLINE_EXCEEDED", "RESOURCE_EXHAUSTED", "ABORTED", "INTERNAL"})
ROW_LEVEL = frozenset({"INVALID_ARGUMENT", "OUT_OF_RANGE", "ALREADY_EXISTS", "FAILED_PRECONDITION"})
LOOKUP_RETRYABLE = frozenset({"ABORTED", "DEADLINE_EXCEEDED", "UNAVAILABLE"})


# Status names by service and class; the first class that any cause of a chain belongs to counts.
_RETRIED = ("UNAVAILABLE", "DEADLINE_EXCEEDED", "ABORTED", "RESOURCE_EXHAUSTED")
SERVICE_CLASSES = {
    "warehouse": [
        ("SCHEMA_MISMATCH", ("SCHEMA_MISMATCH_EXTRA_FIELDS",)),
        ("WRITER_REFRESH", ("STREAM_FINALIZED", "STREAM_NOT_FOUND", "INVALID_STREAM_STATE")),
        ("MISSING_TABLE", ("NOT_FOUND",)),
        ("TRANSIENT", (*_RETRIED, "INTERNAL", "CANCELLED", "UNKNOWN")),
    ],
    "kv": [("MISSING_TABLE", ("NOT_FOUND",)), ("TERMINAL", _RETRIED), ("ROW_LEVEL", ("INVALID_ARGUMENT",))],
    "bus": [("MISSING_TOPIC", ("NOT_FOUND",)), ("CANCELLATION", ("CANCELLED",)), ("ROW_LEVEL", ("INVALID_ARGUMENT",))],
    "relational": [("TRANSIENT", _RETRIED), ("ROW_LEVEL", ("INVALID_ARGUMENT", "ALREADY_EXISTS"))],
    "tasks": [("DONE", ("ALREADY_EXISTS",)), ("MISSING_QUEUE", ("NOT_FOUND",)), ("TRANSIENT", (*_RETRIED, "INTERNAL", "UNKNOWN")), ("ROW_LEVEL", ("INVALID_ARGUMENT",))],
}
CONSTRAINT_STATUSES = ("FAILED_PRECONDITION", "OUT_OF_RANGE")


def service_class(service: str, statuses: Column, rejected_rows: Column | None = None, route_violations: bool = False) -> Column:
    """What an error of a service means, from the statuses of its chain of causes.

    ``rejected_rows`` says that the service has named the rows at fault, which outranks
    every status of a warehouse. ``route_violations`` makes violated constraints of a
    relational table faults of their rows instead of the job.
    """
    classes = list(SERVICE_CLASSES[service])
    if service == "relational" and route_violations:
        classes.append(("ROW_LEVEL", CONSTRAINT_STATUSES))
    case = F.when(F.coalesce(rejected_rows, F.lit(False)), "ROW_LEVEL") if rejected_rows is not None else F.when(F.lit(False), "ROW_LEVEL")
    for name, members in classes:
        case = case.when(F.exists(statuses, lambda s: s.isin(*members)), name)  # noqa: B023
    return case.otherwise("TERMINAL")


def base_backoff_ms(attempt: Column, initial_ms: int, cap_ms: int) -> Column:
    """min(initial * 2^(attempt-1), cap), without jitter."""
    doubled = F.least(attempt - 1, F.lit(40)).cast("int")
    return F.least(F.lit(initial_ms).cast("double") * F.pow(F.lit(2.0), doubled), F.lit(float(cap_ms))).cast("bigint")


def backoff_ms(attempt: int, initial_ms: int, cap_ms: int, rng: random.Random | None = None) -> float:
    """The same with a factor drawn from 0.75 to 1.25."""
    return min(initial_ms * 2 ** min(attempt - 1, 40), cap_ms) * (rng or random).uniform(0.75, 1.25)


def error_class(status: Column) -> Column:
    """TRANSIENT, ROW_LEVEL or TERMINAL."""
    return F.when(status.isin(*sorted(TRANSIENT)), "TRANSIENT").when(status.isin(*sorted(ROW_LEVEL)), "ROW_LEVEL").otherwise("TERMINAL")


def chain_class(statuses: Column) -> Column:
    """Class of a chain of causes: a transient one outranks a data-shaped one."""
    return (
        F.when(F.exists(statuses, lambda s: s.isin(*sorted(TRANSIENT))), "TRANSIENT")
        .when(F.exists(statuses, lambda s: s.isin(*sorted(ROW_LEVEL))), "ROW_LEVEL")
        .otherwise("TERMINAL")
    )


class RetryableError(Exception):
    def __init__(self, status: str, message: str = ""):
        super().__init__(message or status)
        self.status = status


def with_retries(call: Callable[[], R], attempts: int, initial_ms: int, cap_ms: int, retryable: frozenset[str] = LOOKUP_RETRYABLE, sleep: Callable[[float], None] = time.sleep) -> R:
    """The call's result, tried again after a backoff while its error is retryable."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except RetryableError as e:
            if e.status not in retryable or attempt == attempts:
                raise
            sleep(backoff_ms(attempt, initial_ms, cap_ms) / 1000)
    raise AssertionError("attempts must be positive")
