"""Mart models M1-M3, composed from staging and the window columns.

Presentation ORDER BY is left out of the models (it would force a global
range shuffle); sinks sort within partitions and readers order the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.rounding import round_half_up
from tickwise.operators import segments as S
from tickwise.operators import windows as W
from tickwise.operators.joins import stock_macro_join

PORTFOLIO_COLUMNS = (
    "ticker", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume",
    "prev_close_price", "daily_return_pct", "ma_20day", "ma_50day", "rolling_volatility_20d",
    "cumulative_return_pct", "running_peak", "drawdown_pct", "updated_at",
)
RISK_COLUMNS = (
    "ticker", "trade_date", "daily_return_pct", "rolling_volatility_20d", "sharpe_ratio_20d",
    "max_drawdown_pct", "var_95_pct", "avg_volume_20d", "cumulative_return_pct", "updated_at",
)
CORRELATION_COLUMNS = (
    "ticker", "trade_date", "indicator_name", "indicator_value", "indicator_change_pct",
    "daily_return_pct", "rolling_correlation_20d", "updated_at",
)
# The averages over trailing rows: column and rows of each.
PORTFOLIO_MEANS = {"_mean_20": ("close_price", W.SHORT_WINDOW), "_mean_50": ("close_price", W.LONG_WINDOW)}
RISK_MEANS = {"_mean_return": ("daily_return_pct", W.SHORT_WINDOW), "_mean_volume": ("volume", W.SHORT_WINDOW)}


def _stamp(updated_at: Column | None) -> Column:
    return (F.current_timestamp() if updated_at is None else updated_at).alias("updated_at")


def mart_portfolio(stg: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """M1: returns, 20/50-row moving averages, volatility, cumulative return, drawdown.

    First close and peak come from a segmented scan, the trailing frames from overlapping
    blocks (``operators.segments``), so a ticker of any length is spread over tasks.
    """
    placed = S.running(stg, "ticker", "trade_date", _first_close=("first", "close_price"),
                       running_peak=("max", "close_price"))
    w = S.by_block("ticker")
    returns = S.overlapping(placed, W.LONG_WINDOW - 1) \
        .withColumn("prev_close_price", W.prev_close(w)) \
        .withColumn("daily_return_pct", W.pct_change(F.col("close_price"), F.col("prev_close_price")))
    metrics = W.with_means(returns, w, W.MEAN_STEP, PORTFOLIO_MEANS).select(
        "*",
        round_half_up("_mean_20", 4).alias("ma_20day"),
        round_half_up("_mean_50", 4).alias("ma_50day"),
        W.rolling_stddev("daily_return_pct", w, W.SHORT_WINDOW).alias("rolling_volatility_20d"),
        W.pct_change(F.col("close_price"), F.col("_first_close")).alias("cumulative_return_pct"),
        W.drawdown(F.col("close_price"), F.col("running_peak")).alias("drawdown_pct"),
    )
    return S.own_rows(metrics, *PORTFOLIO_COLUMNS[:-1], _stamp(updated_at))


def mart_risk(portfolio: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """M2: Sharpe, running max drawdown, parametric VaR, average volume.

    The non-null-return filter sits below these windows (and above the
    portfolio ones), as in the model: the first day's volume leaves the
    20-row average, and frames after a zero close differ from M1's.
    """
    base = portfolio.select(
        "ticker", "trade_date", "daily_return_pct", "rolling_volatility_20d", "drawdown_pct",
        "cumulative_return_pct", "volume",
    ).where(F.col("daily_return_pct").isNotNull())
    placed = S.running(base, "ticker", "trade_date", max_drawdown_pct=("min", "drawdown_pct"))
    w = S.by_block("ticker")
    avg_ret, vol = F.col("_mean_return"), F.col("rolling_volatility_20d")
    metrics = W.with_means(S.overlapping(placed, W.SHORT_WINDOW - 1), w, W.MEAN_STEP, RISK_MEANS).select(
        "*",
        W.sharpe_ratio(avg_ret, vol).alias("sharpe_ratio_20d"),
        W.value_at_risk(avg_ret, vol).alias("var_95_pct"),
        round_half_up("_mean_volume", 0).alias("avg_volume_20d"),
    )
    return S.own_rows(metrics, *RISK_COLUMNS[:-1], _stamp(updated_at))


def macro_changes(stg_macro: DataFrame) -> DataFrame:
    """Change in percent against the previous observation of the same indicator."""
    w = W.by_ticker(("indicator_name",), "indicator_date")
    return stg_macro.select(
        "indicator_name", "indicator_date", "value",
        W.pct_change(F.col("value"), F.lag("value").over(w)).alias("indicator_change_pct"),
    )


def mart_macro_correlation(portfolio: DataFrame, stg_macro: DataFrame,
                           updated_at: Column | None = None) -> DataFrame:
    """M3: returns ⋈ macro changes by exact date, then the 20-row rolling correlation."""
    returns = portfolio.select("ticker", "trade_date", "daily_return_pct").where(
        F.col("daily_return_pct").isNotNull())
    joined = stock_macro_join(returns, macro_changes(stg_macro)).select(
        "ticker", "trade_date", "daily_return_pct", "indicator_name",
        F.col("value").alias("indicator_value"), "indicator_change_pct",
    )
    w = W.by_ticker(("ticker", "indicator_name"))
    correlated = W.with_rolling_correlation(joined, "daily_return_pct", "indicator_change_pct", w,
                                            "rolling_correlation_20d")
    return correlated.select(*CORRELATION_COLUMNS[:-1], _stamp(updated_at))
