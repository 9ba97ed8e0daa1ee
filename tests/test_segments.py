"""Segmented scans and overlapping blocks against plain windows over the whole key."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickwise.operators import segments as S
from tickwise.operators import windows as W
from tickwise.plans import marts

STAGED = ("ticker string, trade_date date, open_price double, high_price double, low_price double, "
          "close_price double, volume decimal(38,0), loaded_at timestamp_ntz")
T0 = dt.datetime(2026, 1, 1)


def _history(spark, days=1500, tickers=("A", "B", None)):
    """Gaps of weeks and of years, a zero close, and a ticker that is null."""
    r, rows = random.Random(3), []
    for t in tickers:
        day = dt.date(1990, 1, 1)
        for i in range(days if t == "A" else days // 10):
            day += dt.timedelta(days=r.choice([1, 1, 1, 3, 20, 700 if i % 200 == 7 else 2]))
            close = 0.0 if i == 40 else round(r.uniform(1, 100), 2)
            rows.append((t, day, close, close, close, close, Decimal(r.randint(1, 10 ** 6)), T0))
    r.shuffle(rows)
    return spark.createDataFrame(rows, STAGED).repartition(3)


def _whole_portfolio(stg):
    """M1 by one window over each ticker's whole history."""
    w = W.by_ticker()
    back = stg.withColumn("prev_close_price", W.prev_close(w)).withColumn(
        "daily_return_pct", W.pct_change(F.col("close_price"), F.col("prev_close_price")))
    return back.select(
        "ticker", "trade_date", "prev_close_price", "daily_return_pct",
        W.moving_average("close_price", w, 20).alias("ma_20day"),
        W.moving_average("close_price", w, 50).alias("ma_50day"),
        W.rolling_stddev("daily_return_pct", w, 20).alias("rolling_volatility_20d"),
        W.cumulative_return(w).alias("cumulative_return_pct"), W.running_peak(w).alias("running_peak"),
        W.drawdown(F.col("close_price"), W.running_peak(w)).alias("drawdown_pct"))


def _rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("block", [50, 64, 1024])
def test_portfolio_equals_whole_windows(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    stg = _history(spark)
    expected = _whole_portfolio(stg)
    assert _rows(marts.mart_portfolio(stg), expected.columns) == _rows(expected, expected.columns)


@pytest.mark.parametrize("block", [20, 64])
def test_risk_equals_whole_windows(spark, monkeypatch, block):
    stg = _history(spark)
    portfolio = marts.mart_portfolio(stg)
    w = W.by_ticker()
    base = portfolio.where("daily_return_pct IS NOT NULL")
    avg = F.avg("daily_return_pct").over(W.trailing(w, 20))
    expected = base.select(
        "ticker", "trade_date", W.sharpe_ratio(avg, F.col("rolling_volatility_20d")).alias("sharpe_ratio_20d"),
        W.running_min("drawdown_pct", w).alias("max_drawdown_pct"),
        W.moving_average("volume", w, 20, scale=0).alias("avg_volume_20d"))
    whole = _rows(expected, expected.columns)
    staged = spark.createDataFrame(portfolio.collect(), portfolio.schema)
    monkeypatch.setattr(S, "BLOCK", block)
    assert _rows(marts.mart_risk(staged), expected.columns) == whole


def test_places_and_running_values(spark):
    rows = [("A", None, 5.0), ("A", dt.date(2020, 5, 1), None), ("A", dt.date(2021, 1, 1), 7.0),
            ("A", dt.date(2021, 1, 2), 1.0), (None, dt.date(2019, 1, 1), 2.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = S.running(df, "k", "d", top=("max", "v"), low=("min", "v"), head=("first", "v"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("A", None, 5.0, 0, 5.0, 5.0, 5.0), ("A", dt.date(2020, 5, 1), None, 1, 5.0, 5.0, 5.0),
        ("A", dt.date(2021, 1, 1), 7.0, 2, 7.0, 5.0, 5.0), ("A", dt.date(2021, 1, 2), 1.0, 3, 7.0, 1.0, 5.0),
        (None, dt.date(2019, 1, 1), 2.0, 0, 2.0, 2.0, 2.0)], key=str)
    assert S.running(df.limit(0), "k", "d", top=("max", "v")).count() == 0


def test_blocks_overlap_by_the_halo(spark):
    df = spark.range(10).select(F.lit("A").alias("k"), F.col("id").alias(S.PLACE))
    got = {(r[S.CUT], r[S.PLACE], r[S.COPY]) for r in S.overlapping(df, 2, rows=4).collect()}
    assert got == {(p // 4, p, False) for p in range(10)} | {(1, 2, True), (1, 3, True), (2, 6, True), (2, 7, True)}
    with pytest.raises(ValueError, match="halo"):
        S.overlapping(df, 4, rows=4)


def test_one_ticker_is_spread_over_tasks(spark, monkeypatch):
    """No window but those over the one-row-a-year summaries is partitioned by ticker alone."""
    monkeypatch.setattr(S, "BLOCK", 64)
    stg = _history(spark, tickers=("A",))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for mart in (marts.mart_portfolio(stg), marts.mart_risk(marts.mart_portfolio(stg))):
            rows = mart.withColumn("task", F.spark_partition_id()).collect()
            assert len({r.task for r in rows}) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plan = marts.mart_portfolio(stg)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    whole = [line for line in windows if "_cut#" not in line.rsplit("], [", 2)[-2]]
    assert windows and all("_of_" in line or "_year#" in line for line in whole)


def test_running_moves_rows_once_and_joins_nothing(spark):
    """The years' sums stand in front of their rows; a join on the null-safe key moved all rows again."""
    stg = _history(spark, days=60)
    plan = S.running(stg, "ticker", "trade_date", top=("max", "close_price"))._jdf.queryExecution().executedPlan()
    assert "Join" not in plan.toString()


def test_means_from_sums_equal_whole_frames(spark):
    """Nulls do not count, a frame without values has no mean; also where a block begins."""
    r = random.Random(5)
    rows = [(k, i, None if i in (0, 1) or r.random() < 0.2 else r.uniform(-9, 9), Decimal(i)) for k in "AB" for i in range(130)]
    df = spark.createDataFrame(rows, "k string, i int, v double, n decimal(38,0)")
    w = Window.partitionBy("k").orderBy("i")
    got = W.with_means(df, w, 10, {"m20": ("v", 20), "m50": ("v", 50), "n20": ("n", 20)})
    want = df.select("k", "i", *[F.avg(F.col(c).cast("double")).over(W.trailing(w, n)) for c, n in (("v", 20), ("v", 50), ("n", 20))])
    for a, b in zip(sorted(got.drop("v", "n").collect()), sorted(want.collect()), strict=True):
        assert a[:2] == b[:2] and all(x is y is None or x == pytest.approx(y, rel=1e-12, abs=1e-12) for x, y in zip(a[2:], b[2:]))
    with pytest.raises(ValueError, match="multiple"):
        W.with_means(df, w, 10, {"m": ("v", 25)})


def test_correlation_equals_whole_frames(spark):
    """Also a change that stays the same (no correlation) and missing changes."""
    r = random.Random(7)
    rows = [(k, i, r.uniform(-5, 5), {"A": r.uniform(-1, 1), "B": 0.1}[k] if i % 9 else None) for k in "AB" for i in range(90)]
    df = spark.createDataFrame(rows, "k string, i int, x double, y double")
    w = Window.partitionBy("k").orderBy("i")
    got = W.with_rolling_correlation(df, "x", "y", w, "c").select("k", "i", "c")
    assert sorted(got.collect(), key=str) == sorted(df.select("k", "i", W.rolling_correlation("x", "y", w)).collect(), key=str)
    assert got.where("k = 'B' AND c IS NOT NULL").count() == 0
