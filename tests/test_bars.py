"""Buckets, bars, gap filling and statistics against pandas and by hand."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwell.operators import bars as br
from tickwell.operators import stats
from tickwell.operators.dealt import deal
from tickwell.operators.timeline import whole
from tickwell.plans import series

HEAD = "symbol string, ts timestamp, row_id long, close double, volume double"


def ticks(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, t string, row_id long, close double, volume double")
    return df.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")


def width_of(spark, seconds, points, weekly):
    span = F.lit(int(seconds * 1_000_000)).cast("bigint")
    return spark.range(1).select(br.bucket_width(span, points, weekly)).first()[0]


@pytest.mark.parametrize(
    "seconds, weekly, ohlcv",
    [
        (600, br.SECOND, br.SECOND),
        (3599, 3 * br.SECOND, 3 * br.SECOND),
        (7200, br.HOUR, br.HOUR),
        (3 * 86400, br.DAY, br.DAY),
        (30 * 86400, br.WEEK, br.DAY),
        (20 * 365.25 * 86400, br.WEEK, 7 * br.DAY),
    ],
)
def test_bucket_widths(spark, seconds, weekly, ohlcv):
    assert width_of(spark, seconds, 1000, True) == weekly
    assert width_of(spark, seconds, 1000, False) == ohlcv


def labels(spark, days, width, weekly):
    first = min(days)
    df = spark.createDataFrame([(d, first) for d in days], "t string, f string")
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    start = br.bucket_start(us("t"), us("f"), F.lit(width).cast("bigint"), weekly)
    return [str(r[0]) for r in df.select(br.moment(start)).collect()]


def test_weeks_end_on_sundays(spark):
    got = labels(spark, ["2024-01-03", "2024-01-07 15:00:00", "2024-01-08"], br.WEEK, True)
    assert [g[:10] for g in got] == ["2024-01-07", "2024-01-07", "2024-01-14"]


def test_day_buckets_start_at_the_first_midnight(spark):
    got = labels(spark, ["2024-01-03 05:17:00", "2024-01-05 00:00:00", "2024-01-08 23:00:00"], 2 * br.DAY, False)
    assert [g[:10] for g in got] == ["2024-01-03", "2024-01-05", "2024-01-07"]


@pytest.mark.parametrize("rule, days", [("3W", 400), ("2W", 200)])
def test_several_weeks_as_in_pandas(spark, rule, days):
    rng = np.random.default_rng(1)
    ts = pd.Timestamp("2024-01-03 05:17") + pd.to_timedelta(np.sort(rng.integers(0, days * 86400, 300)), unit="s")
    pdf = pd.DataFrame({"symbol": "a", "ts": ts, "row_id": range(300), "v": rng.normal(size=300)})
    want = pdf.set_index("ts")["v"].resample(rule).sum()
    weeks = int((pdf.ts.max() - pdf.ts.min()).days / 7)
    points = next(p for p in range(1, 200) if weeks // p == int(rule[0]))
    got = br.resample(spark.createDataFrame(pdf), "sum", ["v"], points=points).toPandas().sort_values("ts")
    assert got.ts.tolist() == want.index.tolist()
    np.testing.assert_allclose(got.v, want.to_numpy())


@pytest.mark.parametrize("span, rule", [(3500, "3s"), (20 * 3600, "1h"), (200 * 86400, "2D")])
def test_bars_as_in_pandas(spark, span, rule):
    rng = np.random.default_rng(2)
    n = 400
    offsets = np.sort(np.append(rng.integers(0, span, n - 2), [0, span]))
    pdf = pd.DataFrame({"symbol": "a", "ts": pd.Timestamp("2024-01-03 05:17:01") + pd.to_timedelta(offsets, unit="s"),
                        "row_id": range(n), "close": rng.normal(size=n), "volume": rng.random(n)})
    pdf.loc[rng.random(n) < 0.2, "close"] = np.nan
    points = {"3s": 1000, "1h": 15, "2D": 100}[rule]
    r = pdf.set_index("ts")
    want = pd.DataFrame({"open": r.close.resample(rule).first(), "high": r.close.resample(rule).max(),
                         "low": r.close.resample(rule).min(), "close": r.close.resample(rule).last(),
                         "volume": r.volume.resample(rule).sum()})
    df = spark.createDataFrame(pdf).withColumn("close", F.when(~F.isnan("close"), F.col("close")))
    df = df.repartition(7)
    prices = br.tick_prices("close", "volume")
    points = min(points, n - 1)
    if rule == "3s":
        got = br.bars(df, 3 * br.SECOND, prices=prices)
        got = br.fixed_grid(got, 3 * br.SECOND)
    else:
        got = br.auto_bars(df, prices=prices, points=points)
    got = got.toPandas().sort_values("ts", ignore_index=True)
    assert got.ts.tolist() == want.index.tolist()
    for c in want:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float))


def test_first_and_last_skip_nulls_and_ties_follow_the_row_id(spark):
    rows = [
        ("a", "2024-01-01 00:00:00", 1, None, 1.0),
        ("a", "2024-01-01 00:00:00", 3, 5.0, 1.0),
        ("a", "2024-01-01 00:00:00", 2, 4.0, 1.0),
        ("a", "2024-01-01 00:30:00", -7, 8.0, None),
        ("a", "2024-01-01 00:30:00", 9223372036854775807, 6.0, 1.0),
        ("a", "2024-01-01 03:00:00", 6, None, None),
    ]
    hourly = br.bars(ticks(spark, rows), br.HOUR, prices=br.tick_prices("close", "volume"))
    got = br.fixed_grid(hourly, br.HOUR).orderBy("ts").collect()
    assert [(r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in got] == [
        (4.0, 8.0, 4.0, 6.0, 4.0),
        (None, None, None, None, 0.0),
        (None, None, None, None, 0.0),
        (None, None, None, None, 0.0),
    ]


def test_short_series_keep_their_rows(spark):
    rows = [("a", "2024-01-01 00:00:00", i, float(i), 1.0) for i in range(5)]
    rows += [("b", f"2024-01-{d:02d} 10:00:00", d, float(d), 1.0) for d in range(1, 30)]
    got = br.auto_bars(ticks(spark, rows), prices=br.tick_prices("close", "volume"), points=10)
    counts = dict(got.groupBy("symbol").count().collect())
    assert counts == {"a": 5, "b": 15}


def test_a_series_of_any_length_ends_up_short(spark):
    df = spark.range(200_000).select(
        F.lit("a").alias("symbol"),
        F.timestamp_seconds(F.col("id") * 600 + F.pmod(F.xxhash64("id"), F.lit(600))).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("row_id"), F.rand(1).alias("close"), F.lit(1.0).alias("volume"),
    )
    got = br.auto_bars(df, prices=br.tick_prices("close", "volume"))
    assert 1000 <= got.count() <= 2001
    assert got.agg(F.sum("volume")).first()[0] == 200_000


def test_wide_gaps(spark):
    rows = [("a", "2024-01-01 00:00:00", 1, 1.0, 1.0), ("a", "2024-01-01 01:00:00", 2, 2.0, 1.0)]
    per_second = br.bars(ticks(spark, rows), br.SECOND, prices=br.tick_prices("close", "volume"))
    rows = [("b", f"2024-01-01 {m // 60:02d}:{m % 60:02d}:07", m, 1.0, 1.0) for m in range(0, 900, 3)]
    per_second = per_second.unionByName(
        br.bars(ticks(spark, rows), br.SECOND, prices=br.tick_prices("close", "volume")))
    for parts in (1, 30):
        got = br.fixed_grid(per_second, br.SECOND, parts=parts)
        counts = got.groupBy("symbol").agg(F.countDistinct("ts"), F.count("*"), F.sum("volume"), F.count("close"))
        assert sorted(tuple(r) for r in counts.collect()) == [
            ("a", 3601, 3601, 2.0, 2), ("b", 897 * 60 + 1, 897 * 60 + 1, 300.0, 300)]


def test_unknown_aggregation_and_missing_columns(spark):
    df = ticks(spark, [("a", "2024-01-01 00:00:00", 1, 1.0, 1.0)])
    with pytest.raises(ValueError):
        br.resample(df, "median")
    with pytest.raises(ValueError):
        br.resample(df, "mean", ["nothing"])
    with pytest.raises(ValueError):
        br.auto_bars(df)


def test_statistics_as_in_pandas(spark):
    rng = np.random.default_rng(5)
    n = 900
    close = 50 + np.cumsum(rng.normal(size=n)) * 0.1
    pdf = pd.DataFrame({"symbol": "a", "ts": pd.date_range("2024-01-01", periods=n, freq="h"), "row_id": range(n),
                        "close": close, "high": close + 1, "low": close - 1, "open": close, "volume": rng.random(n)})
    ret, log = pdf.close.pct_change(), np.log(pdf.close / pdf.close.shift())
    want = {
        "trading_days": n, "current_price": close[-1], "volume_total": pdf.volume.sum(),
        "volume_avg": pdf.volume.mean(), "high": pdf.high.max(), "low": pdf.low.min(),
        "mean": close.mean(), "std": pdf.close.std(), "total_return": (close[-1] / close[0] - 1) * 100,
        "daily_returns_mean": ret.mean() * 100, "daily_returns_std": ret.std() * 100,
        "sharpe_ratio": ret.mean() / ret.std() * np.sqrt(252),
        "volatility_annualized": log.std() * np.sqrt(252) * 100,
    }
    df = spark.createDataFrame(pdf)
    for t in (whole(df), deal(df, parts=20)):
        got = stats.ohlcv_stats(t).first().asDict()
        for name, value in want.items():
            assert got[name] == pytest.approx(value, rel=1e-9), name
        assert got["start_date"] == pdf.ts.iloc[0] and got["end_date"] == pdf.ts.iloc[-1]


def test_line_points_arrays_and_views(spark):
    rows = [("a", f"2024-01-01 0{h}:00:00", h, float(h), 1.0) for h in (3, 1, 2)]
    df = ticks(spark, rows)
    points = series.line_points(deal(df, parts=2), "close", "close").orderBy("x").collect()
    assert [(p["x"], p["y"]) for p in points] == [(0, 1.0), (1, 2.0), (2, 3.0)]
    packed = series.as_arrays(df, ["close"]).first()
    assert packed["close"] == [1.0, 2.0, 3.0] and len(packed["dates"]) == 3
    values, figures = series.timeseries_view(df, "mean")
    assert sorted(r["metric"] for r in figures.collect()) == ["close", "volume"]
    assert values.count() == 6
    bars, summary = series.ohlcv_view(df, prices=br.tick_prices("close", "volume"))
    assert bars.count() == 3 and summary.first()["trading_days"] == 3


def test_metrics_align_by_date(spark):
    df = spark.sql(
        "select 'c' company, map('2021', 1D, '2022', 2D) revenue, map('2022', 0.5D) margin, "
        "map('2020', 9D, '2021', 7D) net_income"
    )
    got = series.align_metrics(df, "revenue", ["margin", "net_income"]).orderBy("date").collect()
    assert [tuple(r) for r in got] == [("c", "2021", 1.0, None, 7.0), ("c", "2022", 2.0, 0.5, None)]


def test_times_parse_or_fail(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",), ("2024-01-01",), ("soon",), (None,)], "t string")
    got = [r[0] for r in br.time_of(df, "t").collect()]
    assert [g is None for g in got] == [False, False, True, True]
    with pytest.raises(Exception, match="not a time: soon"):
        br.time_of(df, "t", strict=True).collect()
