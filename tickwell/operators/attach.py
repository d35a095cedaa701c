"""Add the columns of a one-row-per-key table to rows whose keys may be skewed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.session import stored


def join_on(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool = False
) -> DataFrame:
    """Join on equally named keys and keep the left ones."""
    right = right.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    tests = [
        F.col(k).eqNullSafe(F.col(f"_on_{k}")) if null_safe else F.col(k) == F.col(f"_on_{k}")
        for k in keys
    ]
    return left.join(right, reduce(lambda a, b: a & b, tests), how).drop(
        *[f"_on_{k}" for k in keys]
    )


def attach(rows: DataFrame, table: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join ``table`` (one row per key) to ``rows``; nulls are keys like others.

    The table is written once, so its size is known: below Spark's broadcast
    threshold the rows stay where they are, above it both sides are dealt out
    and adaptive execution splits the hot keys among the rows.
    """
    return join_on(rows, stored(table), on, how, null_safe=True)
