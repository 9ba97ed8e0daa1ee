import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tickwise.operators import windows as W
from tickwise.operators.staging import stg_stock_prices
from tickwise.plans import marts
from tickwise.plans.registry import QUERIES
from tickwise.sources import fixtures

from .conftest import SMOKE_SF


def test_portfolio_properties(spark):
    p = QUERIES["mart_portfolio"](spark, SMOKE_SF)
    bad = p.where((F.col("drawdown_pct") > 0) | (F.col("running_peak") < F.col("close_price")))
    assert bad.count() == 0
    w = W.by_ticker()
    mono = p.select((F.col("running_peak") < F.lag("running_peak").over(w)).alias("drop"))
    assert mono.where("drop").count() == 0


def test_staging_keeps_latest_and_filters_before_dedup(spark):
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    d = dt.date(2026, 1, 1)
    raw = spark.createDataFrame([
        ("A", d, 1.0, 2.0, 1.0, 2.0, 10, t0),
        ("A", d, 1.0, 2.0, 1.0, 3.0, 0, t1),      # later but volume 0: filtered first
        ("a", d, 1.0, 2.0, 1.0, 4.0, 5, t1),      # raw-case key is its own key
    ], "ticker string, trade_date date, open_price double, high_price double, low_price double, "
       "close_price double, volume bigint, loaded_at timestamp_ntz")
    out = sorted((r.ticker, r.close_price) for r in stg_stock_prices(raw).collect())
    assert out == [("A", 2.0), ("A", 4.0)]


def test_correlation_is_the_models_formula_not_pearson(spark):
    x, y = [1.0, 2.0, 3.0], [1.0, 2.0, 4.0]
    df = spark.createDataFrame([("T", i, a, b) for i, (a, b) in enumerate(zip(x, y))],
                               "ticker string, trade_date int, x double, y double")
    got = df.select(W.rolling_correlation("x", "y", W.by_ticker()).alias("c")).collect()[-1].c
    expected = (np.mean(np.multiply(x, y)) - np.mean(x) * np.mean(y)) / (
        np.std(x, ddof=1) * np.std(y, ddof=1))
    assert got == round(expected, 4)
    assert got != round(float(np.corrcoef(x, y)[0, 1]), 4)


def test_risk_nulls_when_volatility_is_zero(spark):
    rows = [("T", dt.date(2026, 1, d), 10.0) for d in range(1, 6)]
    stg = spark.createDataFrame(rows, "ticker string, trade_date date, close_price double") \
        .select("*", F.lit(1.0).alias("open_price"), F.lit(11.0).alias("high_price"),
                F.lit(1.0).alias("low_price"), F.lit(5).cast("bigint").alias("volume"))
    risk = marts.mart_risk(marts.mart_portfolio(stg)).orderBy("trade_date").collect()
    assert all(r.sharpe_ratio_20d is None and r.var_95_pct is None for r in risk)
    assert risk[0].rolling_volatility_20d is None       # one return → no sample stddev


def test_macro_join_is_exact_date_inner(spark):
    corr = QUERIES["mart_macro_correlation"](spark, SMOKE_SF)
    stg_macro = QUERIES["stg_macro_indicators"](spark, SMOKE_SF)
    missing = corr.join(stg_macro, (corr.trade_date == stg_macro.indicator_date)
                        & (corr.indicator_name == stg_macro.indicator_name), "left_anti")
    assert missing.count() == 0


def test_raw_fixture_shapes(spark):
    raw = fixtures.raw_stock_prices(spark, SMOKE_SF)
    assert raw.columns == ["ticker", "trade_date", "open_price", "high_price", "low_price",
                           "close_price", "volume", "loaded_at"]


def test_parameterised_summary_matches_dataframe_form(spark):
    from tickwise.operators import reads as RD
    port = QUERIES["mart_portfolio"](spark, SMOKE_SF)
    picked = ["S1", "S3", "S1' OR '1'='1"]
    via_sql = sorted(RD.portfolio_summary_sql(spark, port, picked).collect())
    via_df = sorted(RD.portfolio_summary(port, picked).collect())
    assert via_sql == via_df and [r.ticker for r in via_sql] == ["S1", "S3"]
    assert RD.portfolio_summary_sql(spark, port, []).count() == 0
