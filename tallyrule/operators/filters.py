"""Row filters on one column; all are plain predicates Catalyst can push down."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrule.functions.columns import find


def filter_eq_or_null(df: DataFrame, col: str, value: str | None = None) -> DataFrame:
    """Rows where ``col <=> value``; with ``value=None`` rows where ``col`` is null."""
    c = F.col(col)
    return df.filter(c.isNull() if value is None else c.eqNullSafe(value))


def filter_rlike_or_null(df: DataFrame, col: str, pattern: str | None = None) -> DataFrame:
    """Rows where ``pattern`` is found in ``col`` (unanchored); with ``None`` rows where it is null."""
    c = F.col(col)
    return df.filter(c.isNull() if pattern is None else find(c, pattern))


def filter_none_rlike(df: DataFrame, col: str, patterns: Sequence[str] | None = None) -> DataFrame:
    """Rows where none of ``patterns`` is found in ``col``.

    A null ``col`` is dropped too: ``NOT (null RLIKE p)`` is null. The default
    patterns are the twelve merchant super-categories.
    """
    if patterns is None:
        from tallyrule.plans.merchant_spec import SUPERCAT_PATTERNS

        patterns = SUPERCAT_PATTERNS
    if not patterns:
        return df
    c = F.col(col)
    return df.filter(reduce(lambda a, b: a & b, (~find(c, p) for p in patterns)))


def unlabelled(df: DataFrame, col: str = "brand") -> DataFrame:
    """Rows no rule labelled."""
    return df.filter(F.col(col).isNull())
