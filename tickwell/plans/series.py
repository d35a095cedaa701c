"""Series and bars prepared for display: resampling, indicators, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.fixed_values import MAX_POINTS
from tickwell.operators.bars import auto_bars, resample
from tickwell.operators.indicators import all_indicators
from tickwell.operators.stats import ohlcv_stats, series_stats, unpivot
from tickwell.operators.dealt import Dealt, Position, along
from tickwell.operators.timeline import Timeline, position, whole
from tickwell.session import keep


def ohlcv_view(
    df: DataFrame, by=("symbol",), points: int = MAX_POINTS, prices=None
) -> tuple[DataFrame, DataFrame]:
    """Bars with all indicators, and one row of statistics per series.

    After resampling no series has more than 2 * ``points`` + 1 bars, so each
    fits into one task.
    """
    t = whole(keep(auto_bars(df, by=by, points=points, prices=prices)), by=by)
    return all_indicators(t).rows(), ohlcv_stats(t)


def timeseries_view(
    df: DataFrame,
    aggregation: str = "mean",
    values=None,
    by=("symbol",),
    points: int = MAX_POINTS,
    exact: dict[str, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Long rows (series, metric, ts, value) and statistics per metric."""
    table = keep(resample(df, aggregation, values, by=by, points=points, exact=exact))
    values = [c for c in table.columns if c not in (*by, "ts", "row_id")]
    return (
        unpivot(table, values, [*by, "ts", "row_id"]),
        series_stats(table, values, by=by, exact={v: n + 4 for v, n in (exact or {}).items()}),
    )


def line_points(t: Timeline | Dealt, value: str, name: str) -> DataFrame:
    """Points (series, name, x, y) of a line chart, x counting the rows."""
    numbered = along(t, value, Position("x")) if isinstance(t, Dealt) else position(t, "x").rows()
    return numbered.select(*t.by, F.lit(name).alias("name"), "x", F.col(value).alias("y"))


def as_arrays(df: DataFrame, values: list[str], by=("symbol",)) -> DataFrame:
    """One row per series with an array per column in time order; for series
    that were resampled, whose length is limited."""
    rows = F.array_sort(F.collect_list(F.struct("ts", "row_id", *values)))
    packed = df.groupBy(*by).agg(rows.alias("_rows"))
    return packed.select(
        *by,
        F.col("_rows.ts").alias("dates"),
        *[F.col(f"_rows.{v}").alias(v) for v in values],
    )


def candles(df: DataFrame, by=("symbol",)) -> DataFrame:
    return df.select(*by, "ts", "open", "high", "low", "close")


def align_metrics(metrics: DataFrame, leading: str, others: list[str], by=("company",)):
    """One row per date of the ``leading`` map column, with the values of the
    other map columns on that date, null where they have none."""
    points = metrics.select(*by, *others, F.explode(leading).alias("date", leading))
    return points.select(
        *by, "date", leading, *[F.col(o)[F.col("date")].alias(o) for o in others]
    )
