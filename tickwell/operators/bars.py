"""Resampling of ticks and series into buckets, and the filling of empty buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.fixed_values import MAX_POINTS
from tickwell.functions.numbers import exact_mean
from tickwell.functions.order import micros, time_key
from tickwell.operators.attach import attach
from tickwell.operators.dealt import Previous, along, deal
from tickwell.operators.timeline import whole
from tickwell.schema import need_columns, numeric_columns
from tickwell.session import keep

SECOND = 1_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR
WEEK = 7 * DAY
# 1970-01-04 was the first Sunday after the epoch.
FIRST_SUNDAY = 3 * DAY

AGGREGATIONS = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min}


def moment(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def time_of(df: DataFrame, column: str, strict: bool = False) -> DataFrame:
    """Parse a text column of times; bad values become null or, when strict,
    an error of the whole job."""
    text = F.col(column)
    if dict(df.dtypes)[column] != "string":
        return df.withColumn(column, text.cast("timestamp_ntz"))
    parsed = F.try_to_timestamp(text)
    if strict:
        bad = F.raise_error(F.concat(F.lit("not a time: "), text))
        parsed = F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(bad)
    return df.withColumn(column, parsed.cast("timestamp_ntz"))


def spans(df: DataFrame, by: list[str], ts: str) -> DataFrame:
    """First and last time and number of rows of every series."""
    return df.groupBy(*by).agg(
        F.min(micros(ts)).alias("_first"),
        F.max(micros(ts)).alias("_last"),
        F.count(F.lit(1)).alias("_rows"),
    )


def bucket_width(span: Column, points: int, weekly: bool) -> Column:
    """Bucket width in microseconds for a series that lasts ``span``.

    Spans under an hour are cut by seconds, under a day by hours, then by days
    and, for generic series, from four weeks on by weeks. The width is a whole
    number of that unit, rounded down but at least one, so the number of
    buckets may exceed ``points`` but never 2 * ``points`` + 1 for spans of at
    least ``points`` units, nor ``points`` + 1 for shorter ones.
    """

    def units(unit: int) -> Column:
        return F.greatest(F.lit(1), F.floor(span / unit / points)).cast("bigint") * F.lit(unit)

    def whole_days(unit: int) -> Column:
        days = F.floor(span / DAY)
        n = F.floor(days / (unit // DAY) / points)
        return F.greatest(F.lit(1), n).cast("bigint") * F.lit(unit)

    width = F.when(span < HOUR, units(SECOND)).when(span < DAY, units(HOUR))
    if weekly:
        return width.when(span < 4 * WEEK, whole_days(DAY)).otherwise(whole_days(WEEK))
    return width.otherwise(whole_days(DAY))


def _back_to(us: Column, origin: Column | int, width: Column | int) -> Column:
    """The latest of origin, origin + width, ... that is not after a time."""
    return us - F.pmod(us - origin, F.lit(width) if isinstance(width, int) else width)


def _sunday(us: Column) -> Column:
    """The Sunday that ends the Monday-to-Sunday week of a time."""
    day = _back_to(us, 0, DAY)
    return day + F.pmod(F.lit(FIRST_SUNDAY) - day, F.lit(WEEK))


def bucket_start(us: Column, first: Column, width: Column, weekly: bool) -> Column:
    """Label of the bucket of a time.

    Second, hour and day buckets count from midnight of the series' first day
    and are named by their start; week buckets are named by the Sunday that
    ends them and count from the Sunday of the first week.
    """
    by_start = _back_to(us, _back_to(first, 0, DAY), width)
    if not weekly:
        return by_start
    by_end = _sunday(us) + F.pmod(_sunday(first) - _sunday(us), width)
    return F.when(width >= WEEK, by_end).otherwise(by_start)


def first_last(value: str, ts: str, row_id: str | None) -> tuple[Column, Column]:
    """First and last non-null value by time."""
    key = F.when(F.col(value).isNotNull(), time_key(ts, row_id))
    return F.min_by(value, key), F.max_by(value, key)


def _ohlcv(ts: str, row_id: str | None, prices: dict[str, str]) -> list[Column]:
    return [
        first_last(prices["open"], ts, row_id)[0].alias("open"),
        F.max(prices["high"]).alias("high"),
        F.min(prices["low"]).alias("low"),
        first_last(prices["close"], ts, row_id)[1].alias("close"),
        F.coalesce(F.sum(prices["volume"]), F.lit(0.0)).alias("volume"),
    ]


OWN = {c: c for c in ("open", "high", "low", "close", "volume")}


def tick_prices(price: str, volume: str) -> dict[str, str]:
    """Read single prices as bars that open and close at that price."""
    return {"open": price, "high": price, "low": price, "close": price, "volume": volume}


def bars(
    df: DataFrame,
    width: int,
    by=("symbol",),
    ts: str = "ts",
    row_id: str | None = "row_id",
    prices: dict[str, str] | None = None,
) -> DataFrame:
    """OHLCV bars of a fixed width (microseconds, counted from midnight of
    1970-01-01): one partial and one final aggregation."""
    prices = prices or OWN
    need_columns(df, *by, ts, *prices.values())
    start = _back_to(micros(ts), 0, width)
    return (
        df.groupBy(*by, start.alias("_start"))
        .agg(*_ohlcv(ts, row_id, prices))
        .select(*by, moment(F.col("_start")).alias("ts"), *OWN)
    )


def _bucketed(df, by, ts, row_id, points, weekly) -> tuple[DataFrame, list[str]]:
    """Rows with their bucket, and the columns that name a bucket.

    Series of at most ``points`` rows keep their rows: for them ``_start`` is
    the time itself and ``_own`` the number that keeps equal times apart.
    """
    plan = (
        spans(df, by, ts)
        .withColumn("_width", bucket_width(F.col("_last") - F.col("_first"), points, weekly))
        .withColumn("_many", F.col("_rows") > points)
    )
    rows = attach(df, plan, by, how="inner")
    start = bucket_start(micros(ts), F.col("_first"), F.col("_width"), weekly)
    rows = rows.withColumn("_start", F.when(F.col("_many"), start).otherwise(micros(ts)))
    rows = rows.withColumn("_own", F.when(~F.col("_many"), F.col(row_id)))
    rows = rows.withColumn("_step", F.when(F.col("_many"), F.col("_width")))
    return rows, [*by, "_start", "_own", "_step"]


def fill_gaps(table: DataFrame, before: Column, values: list[str], zero: list[str]) -> DataFrame:
    """Add the empty buckets between the buckets of every series.

    ``table`` has a row per series and ``_start``, ``before`` is the bucket
    before; ``_step`` is the distance of buckets, null for series to be left
    alone. Sums are 0 in empty buckets, all else null. Every bucket brings the
    empty ones since the bucket before.
    """
    step, start = F.col("_step"), F.col("_start")
    table = table.withColumn("_from", F.coalesce(before + step, start))
    # Two steps keep the arrays short however wide a gap is; a series without
    # a step keeps its single start.
    width = F.coalesce(step, F.lit(1))
    stretch = width * 1000
    table = table.withColumn("_from", F.explode(F.sequence(F.col("_from"), start, stretch)))
    to = F.least(F.col("_from") + stretch - width, start)
    table = table.withColumn("_slot", F.explode(F.sequence(F.col("_from"), to, width)))
    real = F.col("_slot") == start
    empty = {c: F.lit(0.0) if c in zero else F.lit(None) for c in values}
    filled = {c: F.when(real, F.col(c)).otherwise(e) for c, e in empty.items()}
    filled["_start"] = F.col("_slot")
    return table.withColumns(filled).drop("_from", "_slot")


def _bucket_before(table: DataFrame, by: list[str]) -> Column:
    """For resampled series, whose length is limited."""
    return F.lag("_start").over(whole(table, by, ("_start",)).window())


def _finished(table: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    return table.select(
        *by,
        moment(F.col("_start")).alias("ts"),
        F.coalesce("_own", "_start").alias("row_id"),
        *values,
    )


def auto_bars(
    df: DataFrame,
    by=("symbol",),
    ts: str = "ts",
    row_id: str = "row_id",
    prices: dict[str, str] | None = None,
    points: int = MAX_POINTS,
    gaps: bool = True,
) -> DataFrame:
    """OHLCV bars whose width follows from the length of each series.

    Series of at most ``points`` rows come back as they are. No series has
    more than 2 * ``points`` + 1 rows afterwards, however many it had before.
    """
    prices, by, values = prices or OWN, list(by), list(OWN)
    need_columns(df, *by, ts, row_id, *prices.values())
    rows, bucket = _bucketed(df, by, ts, row_id, points, weekly=False)
    table = rows.groupBy(*bucket).agg(*_ohlcv(ts, row_id, prices))
    if gaps:
        table = fill_gaps(table, _bucket_before(table, by), values, zero=["volume"])
    return _finished(table, by, values)


def resample(
    df: DataFrame,
    aggregation: str = "mean",
    values: list[str] | None = None,
    by=("symbol",),
    ts: str = "ts",
    row_id: str = "row_id",
    points: int = MAX_POINTS,
    gaps: bool = True,
    exact: dict[str, int] | None = None,
) -> DataFrame:
    """Every value column aggregated per bucket; width as in ``auto_bars``,
    but with week buckets for spans of four weeks and more.

    ``exact`` names columns whose values have so many decimal digits, such as
    prices in whole cents. Their means are sums of whole numbers over the
    count, rounded half up to four digits more, whatever the order of rows.
    """
    if aggregation not in AGGREGATIONS:
        raise ValueError(f"aggregation must be one of {sorted(AGGREGATIONS)}")
    by = list(by)
    need_columns(df, *by, ts, row_id)
    values = values or numeric_columns(df, but=(*by, ts, row_id))
    need_columns(df, *values)
    rows, bucket = _bucketed(df, by, ts, row_id, points, weekly=True)
    how = AGGREGATIONS[aggregation]
    merged = {v: how(v).cast("double") for v in values}
    if aggregation == "mean":
        merged |= {v: exact_mean(F.col(v), n) for v, n in (exact or {}).items()}
    if aggregation == "sum":
        # A bucket without any value sums to 0; a row that stays as it is does not.
        merged = {
            v: F.coalesce(c, F.when(F.first("_many"), F.lit(0.0))) for v, c in merged.items()
        }
    table = rows.groupBy(*bucket).agg(*[c.alias(v) for v, c in merged.items()])
    if gaps:
        zero = values if aggregation == "sum" else []
        table = fill_gaps(table, _bucket_before(table, by), values, zero)
    return _finished(table, by, values)


def fixed_grid(
    table: DataFrame,
    width: int,
    by=("symbol",),
    ts: str = "ts",
    zero=("volume",),
    parts: int | None = None,
) -> DataFrame:
    """Add the empty buckets between the first and the last bar of a series of any length."""
    by = list(by)
    values = [c for c in table.columns if c not in (*by, ts)]
    table = table.withColumn("_start", micros(ts)).withColumn("_step", F.lit(width).cast("bigint"))
    # Microseconds of a date are whole numbers of fewer than 53 bits.
    rows = along(deal(table, by, ("_start",), parts), "_start", Previous("_before"))
    return fill_gaps(rows, F.col("_before"), values, list(zero)).select(*by, moment(F.col("_start")).alias(ts), *values)
