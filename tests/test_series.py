"""Series operators against pandas, in one piece and cut into small chunks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwell.operators import dealt as dl
from tickwell.operators import indicators as ind
from tickwell.operators import timeline as tl
from tickwell.operators.attach import attach


def random_series(seed, sizes, nulls=0.3, ties=True):
    rng = np.random.default_rng(seed)
    parts = []
    for i, n in enumerate(sizes):
        close = 100 + np.cumsum(rng.normal(size=n))
        close[rng.random(n) < nulls] = np.nan
        steps = rng.integers(0 if ties else 1, 3, size=n)
        ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.cumsum(steps), unit="s")
        parts.append(
            pd.DataFrame({"symbol": f"s{i}", "ts": ts, "row_id": np.arange(n), "close": close})
        )
    return pd.concat(parts, ignore_index=True)


def spark_rows(spark, pdf):
    shuffled = pdf.sample(frac=1, random_state=1)
    df = spark.createDataFrame(shuffled)
    return df.withColumn("close", F.when(~F.isnan("close"), F.col("close")))


def collect(rows, columns):
    out = rows.select("symbol", "ts", "row_id", *columns).toPandas()
    return out.sort_values(["symbol", "ts", "row_id"], ignore_index=True)


def layouts(df, window, *steps):
    """The same columns by windows, and along rows in few parts and in many."""
    yield window(tl.whole(df)).rows()
    for parts in (1, 3, 40):
        yield dl.along(dl.deal(df, parts=parts), "close", *steps)


def per_symbol(pdf, fn):
    pdf = pdf.sort_values(["symbol", "ts", "row_id"], ignore_index=True)
    return pd.concat([fn(g["close"].reset_index(drop=True)) for _, g in pdf.groupby("symbol")],
                     ignore_index=True)


def check(got, want):
    np.testing.assert_array_equal(got.isna().to_numpy(), want.isna().to_numpy())
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float), rtol=1e-8, atol=1e-7)


@pytest.fixture(scope="module")
def series():
    pdf = random_series(3, [3000, 1100, 40, 1])
    hole = (pdf.symbol == "s0") & pdf.row_id.between(900, 2100)
    pdf.loc[hole, "close"] = np.nan
    pdf.loc[(pdf.symbol == "s1") & (pdf.row_id < 300), "close"] = np.nan
    return pdf


def test_parts_are_ranges_of_one_order(spark, series):
    t = dl.deal(spark_rows(spark, series), parts=40)
    rows = t.df.toPandas()
    assert len(rows) == len(series) and t.rows().columns == ["symbol", "ts", "row_id", "close"]
    per_part = rows.groupby(dl.PART)
    assert len(per_part) > 30 and per_part.size().max() < 400
    # As they lie in the parts, one after the other, the rows are in order.
    lying = rows.sort_values(dl.PART, kind="stable", ignore_index=True)[["symbol", "ts", "row_id"]]
    assert lying.equals(lying.sort_values(["symbol", "ts", "row_id"], kind="stable", ignore_index=True))


def test_one_time_held_by_all_rows_is_spread(spark):
    df = spark.range(5000).select(
        F.lit("a").alias("symbol"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"),
        F.col("id").alias("row_id"),
        F.col("id").cast("double").alias("close"),
    )
    t = dl.deal(df, parts=50)
    assert t.df.groupBy(dl.PART).count().agg(F.max("count")).first()[0] <= 400
    assert dl.along(t, "close", dl.Position("x")).where(F.col("x") != F.col("row_id")).count() == 0


def test_rows_without_a_name_are_a_series(spark):
    df = spark.range(500).select(
        F.when(F.col("id") < 200, "A").alias("symbol"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"),
        F.col("id").alias("row_id"),
    )
    rows = dl.along(dl.deal(df, parts=20), "row_id", dl.Position("x"), dl.Previous("before"))
    base = F.when(F.col("symbol") == "A", 0).otherwise(200)
    assert rows.count() == 500
    assert rows.where(F.col("x") != F.col("row_id") - base).count() == 0
    assert rows.where("before is null").count() == 2 and rows.where("before <> row_id - 1").count() == 0


def test_a_table_without_names_is_one_series(spark):
    df = spark.range(300).select(F.col("id").alias("ts"), F.col("id").cast("double").alias("close"))
    rows = dl.along(dl.deal(df, (), ("ts",), parts=9), "close", dl.Position("x"), dl.Averages([7]))
    assert rows.where("x <> ts or ma7 <> ts - 3").count() == 0 and rows.where("ma7 is null").count() == 6


@pytest.mark.parametrize("parts", [1, 60])
def test_border_rows_reach_over_short_parts(spark, parts):
    # Parts of about five rows, windows of fifty.
    df = spark.range(300).select(
        F.lit("A").alias("symbol"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("row_id"),
        F.col("id").cast("double").alias("close"),
    )
    rows = dl.along(dl.deal(df, parts=parts), "close", dl.Averages([50]))
    assert rows.where("ma50 is null").count() == 49
    assert rows.where("abs(ma50 - (close - 24.5)) > 1e-9").count() == 0


def test_all_steps_in_one_pass(spark, series):
    t = dl.deal(spark_rows(spark, series).withColumn("rsi", F.lit("old")), parts=12)
    steps = [dl.Averages(), dl.Strength(), dl.Bands(), dl.Change(), dl.Convergence(), dl.Returns(), dl.Position("x")]
    together = collect(dl.along(t, "close", *steps), [c for s in steps for c in s.columns])
    for step in steps:
        names = list(step.columns)
        assert together[names].equals(collect(dl.along(t, "close", step), names)[names])


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    for parts in (1, 7):
        rows, n = dl.numbered(df, ["k"], "place", parts)
        assert n == 1000 and rows.where("place <> k").count() == 0 and rows.count() == 1000
    rows, n = dl.numbered(df.limit(0), ["k"], "place", 3)
    assert n == 0 and rows.count() == 0


def test_no_rows(spark, series):
    empty = spark_rows(spark, series).limit(0)
    assert dl.along(dl.deal(empty, parts=4), "close", dl.Convergence(), dl.Averages()).count() == 0


@pytest.mark.parametrize("n", [1, 63, 64, 65, 5000])
def test_recurrence(n):
    rng = np.random.default_rng(n)
    a, b, y = rng.random(n), rng.normal(size=(n, 2)), np.array([3.0, -1.0])
    got, want = dl.recur(a, b, y), np.empty((n, 2))
    for t in range(n):
        want[t] = y = a[t] * y + b[t]
    np.testing.assert_allclose(got, want, rtol=1e-10, atol=1e-12)


def test_one_shuffle_for_any_number_of_indicators(spark, series):
    t = dl.deal(spark_rows(spark, series), parts=4)
    plan = dl.along(t, "close", dl.Averages(), dl.Convergence())._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_position(spark, series):
    df = spark_rows(spark, series)
    want = per_symbol(series, lambda c: pd.Series(range(len(c))))
    for rows in layouts(df, lambda t: tl.position(t, "x"), dl.Position("x")):
        check(collect(rows, ["x"])["x"], want)


def test_rolling_indicators(spark, series):
    df = spark_rows(spark, series.assign(close=series.close.interpolate()))
    dense = series.assign(close=series.close.interpolate())

    def rsi(c):
        d = c.diff()
        up = d.where(d > 0, 0).rolling(14).mean()
        down = (-d.where(d < 0, 0)).rolling(14).mean()
        return 100 - 100 / (1 + up / down)

    want = {f"ma{n}": per_symbol(dense, lambda c, n=n: c.rolling(n).mean()) for n in (5, 10, 20, 50)}
    want["rsi"] = per_symbol(dense, rsi)
    want["bb_upper"] = per_symbol(dense, lambda c: c.rolling(20).mean() + 2 * c.rolling(20).std())
    want["bb_lower"] = per_symbol(dense, lambda c: c.rolling(20).mean() - 2 * c.rolling(20).std())
    windows = lambda t: ind.bollinger(ind.rsi(ind.moving_averages(t)))
    for rows in layouts(df, windows, dl.Bands(), dl.Strength(), dl.Averages()):
        got = collect(rows, list(want))
        for name, expected in want.items():
            check(got[name], expected)


def test_rolling_needs_full_windows_of_values(spark):
    rows = [("a", i, v) for i, v in enumerate([1.0, 2.0, None, 4.0, 5.0, 6.0])]
    df = spark.createDataFrame(rows, "symbol string, row_id long, close double").withColumn(
        "ts", F.timestamp_seconds("row_id")
    )
    for rows in layouts(df, lambda t: ind.moving_averages(t, periods=[3]), dl.Averages([3])):
        got = collect(rows, ["ma3"])["ma3"]
        assert got.isna().tolist() == [True] * 5 + [False] and got.iloc[5] == 5


def test_rsi_of_flat_and_rising(spark):
    rows = [(s, i, v) for i in range(30) for s, v in (("flat", 7.0), ("up", float(i)))]
    df = spark.createDataFrame(rows, "symbol string, row_id long, close double").withColumn(
        "ts", F.timestamp_seconds("row_id")
    )
    for rows in layouts(df, ind.rsi, dl.Strength()):
        got = collect(rows, ["rsi"])
        assert got[got.symbol == "flat"]["rsi"].isna().all()
        up = got[got.symbol == "up"]["rsi"].to_numpy()
        assert np.isnan(up[:13]).all() and (up[13:] == 100).all()


@pytest.mark.parametrize("span", [3, 9, 26, 200])
def test_exponential_average_with_gaps(spark, series, span):
    df = spark_rows(spark, series)
    want = per_symbol(series, lambda c: c.ewm(span=span, adjust=False).mean())
    windows = lambda t: ind.exponential_average(t, "close", {"e": span})
    for rows in layouts(df, windows, dl.Exponential({"e": span})):
        check(collect(rows, ["e"])["e"], want)


def test_exponential_average_small(spark):
    for values, want in [
        ([1.0, None, None, 4.0, 5.0], [1, 1, 1, 3.4, 4.2]),
        ([None, 2.0, 4.0], [None, 2, 3]),
    ]:
        rows = [("a", i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "symbol string, row_id long, close double").withColumn(
            "ts", F.timestamp_seconds("row_id")
        )
        windows = lambda t: ind.exponential_average(t, "close", {"e": 3})
        for rows in layouts(df, windows, dl.Exponential({"e": 3})):
            check(collect(rows, ["e"])["e"], pd.Series(want, dtype=float))


def test_macd(spark, series):
    df = spark_rows(spark, series)

    def macd(c):
        return c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()

    want = {
        "macd": per_symbol(series, macd),
        "macd_signal": per_symbol(series, lambda c: macd(c).ewm(span=9, adjust=False).mean()),
    }
    for rows in layouts(df, ind.macd, dl.Convergence()):
        got = collect(rows, list(want))
        for name, expected in want.items():
            check(got[name], expected)


def test_returns(spark, series):
    df = spark_rows(spark, series)
    simple = per_symbol(series, lambda c: c.ffill() / c.ffill().shift() - 1)
    log = per_symbol(series, lambda c: np.log(c / c.shift()))
    for rows in layouts(df, ind.returns, dl.Returns()):
        got = collect(rows, ["simple_return", "log_return"])
        check(got["simple_return"], simple)
        check(got["log_return"], log)


def test_returns_fill_and_zero(spark):
    rows = [("a", i, v) for i, v in enumerate([1.0, None, 3.0, 0.0, 5.0])]
    df = spark.createDataFrame(rows, "symbol string, row_id long, close double").withColumn(
        "ts", F.timestamp_seconds("row_id")
    )
    for rows in layouts(df, ind.returns, dl.Returns()):
        got = collect(rows, ["simple_return"])["simple_return"]
        check(got, pd.Series([None, 0, 2, -1, None], dtype=float))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_attach_by_broadcast_and_by_shuffle(spark, threshold):
    rows = spark.range(1000).select(
        F.when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        "id",
    ).withColumn("k", F.when(F.col("id") != 999, F.col("k")))
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = attach(rows, table, ["k"]).toPandas().sort_values("id", ignore_index=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 1000 and got["n"].notna().all()
    sizes = got.groupby("k", dropna=False)["id"].transform("size")
    assert (got["n"] == sizes).all()


def test_long_exponential_average(spark):
    pdf = random_series(8, [20000])
    pdf.loc[pdf.row_id.between(7000, 8500), "close"] = np.nan
    df = spark_rows(spark, pdf)
    want = per_symbol(pdf, lambda c: c.ewm(span=26, adjust=False).mean())
    windows = lambda t: ind.exponential_average(t, "close", {"e": 26})
    for rows in layouts(df, windows, dl.Exponential({"e": 26})):
        check(collect(rows, ["e"])["e"], want)
