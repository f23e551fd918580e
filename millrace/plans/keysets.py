"""Composite-key predicates: which of a query's conditions select a range of the key.

Key columns are walked in order: equalities extend a prefix, the first column with a
range ends it, and everything behind stays a filter. On a table that is sorted or
bucketed by its key the selected part prunes files and row groups; what the range
does not say exactly is returned as the remaining filter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARISONS = ("=", "<", "<=", ">", ">=", "is_not_null")


@dataclass(frozen=True)
class Condition:
    column: str
    op: str
    value: object = None

    def column_expression(self) -> Column:
        c = F.col(self.column)
        if self.op == "is_not_null":
            return c.isNotNull()
        return {"=": c == F.lit(self.value), "<": c < F.lit(self.value), "<=": c <= F.lit(self.value), ">": c > F.lit(self.value), ">=": c >= F.lit(self.value)}[self.op]


@dataclass
class KeySelection:
    """Conditions the key range enforces exactly, those still to be filtered, and whether nothing can match."""

    enforced: list[Condition]
    remaining: list[Condition]
    empty: bool = False

    def apply(self, df: DataFrame) -> DataFrame:
        if self.empty:
            return df.limit(0)
        wanted = [c.column_expression() for c in self.enforced + self.remaining]
        return df.filter(reduce(lambda a, b: a & b, wanted)) if wanted else df


def convertible(condition: Condition) -> bool:
    """Whether a literal says the same as a key value: no NaN, no null; floats and UUIDs by equality alone.

    A service compares these in an order of its own.
    """
    if condition.op == "is_not_null":
        return True
    if condition.op not in COMPARISONS or condition.value is None:
        return False
    return not (isinstance(condition.value, float) and math.isnan(condition.value))


def select(key_columns: list[str], conditions: list[Condition]) -> KeySelection:
    """Splits conjoined conditions into a key range and the rest."""
    usable = [c for c in conditions if c.column in key_columns and convertible(c) and c.op != "is_not_null"]
    enforced: list[Condition] = []
    empty = False
    for name in key_columns:
        own = [c for c in usable if c.column == name]
        equal = [c for c in own if c.op == "="]
        if equal:
            value = equal[0].value
            empty |= any(not _holds(value, c) for c in own)
            enforced += own
            continue
        lows, highs = [c for c in own if c.op[0] == ">"], [c for c in own if c.op[0] == "<"]
        if lows and highs:
            low, high = max(c.value for c in lows), min(c.value for c in highs)
            strict = any(c.op == ">" and c.value == low for c in lows) or any(c.op == "<" and c.value == high for c in highs)
            empty |= low > high or (low == high and strict)
        enforced += own
        break
    return KeySelection(enforced, [c for c in conditions if c not in enforced], empty)


def _holds(value, condition: Condition) -> bool:
    return {"=": value == condition.value, "<": value < condition.value, "<=": value <= condition.value, ">": value > condition.value, ">=": value >= condition.value}[condition.op]
