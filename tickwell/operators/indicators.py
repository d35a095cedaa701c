"""Technical indicators over short series, as windows.

Every function takes a ``Timeline`` and adds columns. The same indicators
along series of any length are the steps of ``dealt``.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.fixed_values import (
    BOLLINGER_ROWS,
    BOLLINGER_WIDTH,
    MACD_FAST,
    MACD_SIGNAL,
    MACD_SLOW,
    MOVING_AVERAGES,
    RSI_ROWS,
)
from tickwell.operators.timeline import Timeline, fill_forward

# Weights below exp(-40) vanish in double precision.
BLOCK = 40.0


def _rolling(t: Timeline, column: str, n: int, how) -> Column:
    """Aggregate of the last ``n`` rows, null unless all are non-null."""
    frame = t.last_rows(n)
    return F.when(F.count(column).over(frame) == n, how(column).over(frame))


def moving_averages(t: Timeline, close: str = "close", periods=MOVING_AVERAGES) -> Timeline:
    return t.with_columns({f"ma{n}": _rolling(t, close, n, F.avg) for n in periods})


def difference(t: Timeline, close: str = "close", name: str = "change") -> Timeline:
    return t.with_columns({name: F.col(close) - F.lag(close).over(t.window())})


def rsi(t: Timeline, close: str = "close", n: int = RSI_ROWS) -> Timeline:
    """Relative strength from simple means of gains and losses; rows without
    a change (the first one, gaps) count as 0 in both."""
    t = difference(t, close, "_change")
    change = F.col("_change")
    t = t.with_columns(
        {
            "_gain": F.when(change > 0, change).otherwise(0.0),
            "_loss": F.when(change < 0, -change).otherwise(0.0),
        }
    )
    t = t.with_columns(
        {
            "_up": _rolling(t, "_gain", n, F.sum),
            "_down": _rolling(t, "_loss", n, F.sum),
        }
    )
    ratio = F.try_divide(F.col("_up"), F.col("_down"))
    value = F.when((F.col("_down") == 0) & (F.col("_up") > 0), 100.0).otherwise(
        100 - 100 / (1 + ratio)
    )
    return replace(
        t, df=t.df.withColumn("rsi", value).drop("_change", "_gain", "_loss", "_up", "_down")
    )


def bollinger(t: Timeline, close: str = "close", n: int = BOLLINGER_ROWS) -> Timeline:
    middle = _rolling(t, close, n, F.avg)
    spread = _rolling(t, close, n, F.stddev_samp) * BOLLINGER_WIDTH
    return t.with_columns(
        {"bb_upper": middle + spread, "bb_lower": middle - spread, "bb_middle": middle}
    )


def decay_sums(
    df: DataFrame, keys: list[str], order: list[str], sums: dict[str, tuple[str, str]]
) -> DataFrame:
    """Running sums that fade: s = s_before * exp(-fade) + add, one for every
    ``{name: (fade, add)}``; the total fade so far is added as ``{name}_t``.

    A plain window sum of add * exp(total fade) would overflow, so the rows
    are cut into blocks over which the total fade grows by ``BLOCK``. A block
    needs the end of the block before it and nothing older.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({f"{n}_t": F.sum(fade).over(w) for n, (fade, _) in sums.items()})
    for name, (_, add) in sums.items():
        total, block, inner = f"{name}_t", f"{name}_b", f"{name}_i"
        df = df.withColumn(block, F.floor(F.col(total) / BLOCK))
        in_block = Window.partitionBy(*keys, block).orderBy(*order)
        in_block = in_block.rowsBetween(Window.unboundedPreceding, 0)
        rise = F.col(total) - F.col(block) * BLOCK
        df = df.withColumn(
            inner, F.exp(-rise) * F.sum(F.col(add) * F.exp(rise)).over(in_block)
        )
        # The end of the latest block before: rows of equal total have equal sums.
        before = Window.partitionBy(*keys).orderBy(block)
        before = before.rangeBetween(Window.unboundedPreceding, -1)
        end, reached = F.max_by(inner, total).over(before), F.max(total).over(before)
        carried = end * F.exp(reached - F.col(total))
        df = df.withColumn(name, F.col(inner) + F.coalesce(carried, F.lit(0.0)))
        df = df.drop(block, inner)
    return df


def _fade(gap: Column, alpha: float) -> Column:
    """-ln c where c = d^gap / (d^gap + alpha) is the share of the old value."""
    decay = gap * (-math.log1p(-alpha))
    return F.when(decay > 30, decay + math.log(alpha)).otherwise(
        F.log1p(alpha * F.exp(F.least(decay, F.lit(30.0))))
    )


def exponential_average(t: Timeline, column: str, spans: dict[str, int]) -> Timeline:
    """Exponential moving averages, one per ``{name: span}``.

    y starts at the first value; each later value moves it by a share that
    grows with the number of rows since the value before it; rows without a
    value keep y.
    """
    w = t.window()
    x = F.col(column)
    df = t.df.withColumn("_n", F.row_number().over(w))
    df = df.withColumn("_prev", F.last(F.when(x.isNotNull(), F.col("_n")), True).over(t.before()))
    gap = F.col("_n") - F.col("_prev")
    later = x.isNotNull() & F.col("_prev").isNotNull()
    # Rows before the first value.
    df = df.withColumn("_blank", x.isNull() & F.col("_prev").isNull())
    shares = {}
    for name, span in spans.items():
        fade, add = f"_{name}_fade", f"_{name}_add"
        df = df.withColumn(fade, F.when(later, _fade(gap, 2.0 / (span + 1))).otherwise(0.0))
        share = F.when(later, -F.expm1(-F.col(fade))).otherwise(1.0)
        df = df.withColumn(add, F.when(x.isNotNull(), share * x).otherwise(0.0))
        shares[f"_{name}"] = (fade, add)
    df = decay_sums(df, list(t.by), list(t.order), shares)
    df = df.drop(*[c for pair in shares.values() for c in pair])
    for name in spans:
        df = df.withColumn(name, F.when(~F.col("_blank"), F.col(f"_{name}"))).drop(f"_{name}", f"_{name}_t")
    return replace(t, df=df.drop("_n", "_prev", "_blank"))


def macd(t: Timeline, close: str = "close") -> Timeline:
    t = exponential_average(t, close, {"ema_fast": MACD_FAST, "ema_slow": MACD_SLOW})
    t = t.with_columns({"macd": F.col("ema_fast") - F.col("ema_slow")})
    t = exponential_average(t, "macd", {"macd_signal": MACD_SIGNAL})
    return t.with_columns({"macd_histogram": F.col("macd") - F.col("macd_signal")})


def returns(t: Timeline, close: str = "close") -> Timeline:
    """Simple returns over forward-filled values and log returns over the
    values as they are; a previous value of zero gives null."""
    t = fill_forward(t, close, "_fill")
    simple = F.try_divide(F.col("_fill"), F.col("_fill_before")) - 1
    log = F.ln(F.try_divide(F.col(close), F.col("_fill_previous")))
    df = t.df.withColumns({"simple_return": simple, "log_return": log})
    return replace(t, df=df.drop("_fill", "_fill_before", "_fill_previous"))


def all_indicators(t: Timeline, close: str = "close") -> Timeline:
    """All indicator columns; for bars, which are few per series."""
    return macd(bollinger(rsi(moving_averages(t, close), close), close), close)
