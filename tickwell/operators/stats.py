"""One row of statistics per series."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.fixed_values import TRADING_DAYS
from tickwell.functions.numbers import exact_mean
from tickwell.functions.order import time_key
from tickwell.operators.dealt import Dealt, Returns, along
from tickwell.operators.indicators import returns
from tickwell.operators.timeline import Timeline
from tickwell.schema import numeric_columns


def unpivot(df: DataFrame, values: list[str], keys: list[str]) -> DataFrame:
    """Long rows (keys, metric, value)."""
    doubles = df.select(*keys, *[F.col(v).cast("double").alias(v) for v in values])
    return doubles.unpivot(keys, values, "metric", "value")


def series_stats(
    df: DataFrame,
    values: list[str] | None = None,
    by=("symbol",),
    but=(),
    exact: dict[str, int] | None = None,
):
    """Mean, sample deviation, minimum and maximum of every value column.

    ``exact`` names columns of so many decimal digits, whose means are exact.
    """
    values = values or numeric_columns(df, but=(*by, *but))
    mean = F.avg("value")
    for name, digits in (exact or {}).items():
        mean = F.when(F.col("metric") == name, exact_mean(F.col("value"), digits)).otherwise(mean)
    return (
        unpivot(df, values, list(by))
        .groupBy(*by, "metric")
        .agg(
            mean.alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )


def ohlcv_stats(t: Timeline | Dealt, row_id: str | None = "row_id") -> DataFrame:
    """Summary, price and return statistics of OHLCV rows."""
    rows = along(t, "close", Returns()) if isinstance(t, Dealt) else returns(t).rows()
    key = time_key(t.order[0], row_id)
    first, last = F.min_by("close", key), F.max_by("close", key)
    mean, std = F.avg("simple_return"), F.stddev_samp("simple_return")
    year = math.sqrt(TRADING_DAYS)
    return rows.groupBy(*t.by).agg(
        F.min(t.order[0]).alias("start_date"),
        F.max(t.order[0]).alias("end_date"),
        F.count(F.lit(1)).alias("trading_days"),
        last.alias("current_price"),
        F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume_total"),
        F.avg("volume").alias("volume_avg"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.avg("close").alias("mean"),
        F.stddev_samp("close").alias("std"),
        ((F.try_divide(last, first) - 1) * 100).alias("total_return"),
        (mean * 100).alias("daily_returns_mean"),
        (std * 100).alias("daily_returns_std"),
        (F.try_divide(mean, std) * year).alias("sharpe_ratio"),
        (F.stddev_samp("log_return") * year * 100).alias("volatility_annualized"),
    )


def price_range(df: DataFrame, by=("symbol",), ts: str = "ts") -> DataFrame:
    """First and last time and the extreme closes of every series."""
    return df.groupBy(*by).agg(
        F.min(ts).alias("first_date"),
        F.max(ts).alias("last_date"),
        F.min("close").alias("low_close"),
        F.max("close").alias("high_close"),
    )
