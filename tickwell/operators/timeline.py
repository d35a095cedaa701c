"""Windows over short series, one task per series.

This is for series of a proven small length, such as bars whose number per
series is limited. Series of any length are dealt out: see ``dealt``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.schema import need_columns


@dataclass(frozen=True)
class Timeline:
    """A table of series: ``by`` names a series, ``order`` sorts its rows."""

    df: DataFrame
    by: tuple[str, ...]
    order: tuple[str, ...]

    def window(self, *more: str):
        return Window.partitionBy(*self.by, *more).orderBy(*self.order)

    def last_rows(self, n: int):
        return self.window().rowsBetween(1 - n, 0)

    def so_far(self, *more: str):
        return self.window(*more).rowsBetween(Window.unboundedPreceding, 0)

    def before(self):
        return self.window().rowsBetween(Window.unboundedPreceding, -1)

    def with_columns(self, columns: dict[str, Column]) -> Timeline:
        return replace(self, df=self.df.withColumns(columns))

    def rows(self) -> DataFrame:
        """The rows of the series, without helper columns."""
        return self.df.drop(*[c for c in self.df.columns if c.startswith("_")])


def whole(df: DataFrame, by=("symbol",), order=("ts", "row_id")) -> Timeline:
    """One window partition per series."""
    need_columns(df, *by, *order)
    return Timeline(df, tuple(by), tuple(order))


def position(t: Timeline, name: str) -> Timeline:
    """Number the rows of every series from 0."""
    return t.with_columns({name: F.row_number().over(t.window()).cast("bigint") - 1})


def fill_forward(t: Timeline, value: str, name: str) -> Timeline:
    """Three columns about the rows up to each row: ``name`` is the latest
    non-null ``value``, ``name_before`` the same for the row before, and
    ``name_previous`` the value of the row before, null or not."""
    known = F.last(value, ignorenulls=True).over(t.so_far())
    t = t.with_columns({name: known, f"{name}_previous": F.lag(value).over(t.window())})
    return t.with_columns({f"{name}_before": F.lag(name).over(t.window())})
