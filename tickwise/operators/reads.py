"""Read models behind the dashboard: summaries, top-k, latest rows, filtered series.

Short ticker selections are pushed-down ``isin`` predicates (a ticker predicate
passes through the ticker-partitioned windows into the Parquet scan), long ones
and tables are semi-joins; an empty selection gives an empty result, not all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.rounding import round_half_up
from tickwise.operators.audit import COMPLETED_STATUSES, MACRO_PIPELINE, STOCK_PIPELINE

# Which tickers: a list, a table with a column ``ticker``, or None for all.
Selection = Sequence[str] | DataFrame | None
# Tickers that a predicate may list.
LONG_LIST = 1000
RECENT_RUNS = 20
MESSAGE_PREVIEW = 160
FAILURE_WINDOW_DAYS = 7


def select_tickers(df: DataFrame, tickers: Selection) -> DataFrame:
    """Keep the selected tickers; ``None`` means all, an empty selection means none.

    A list is a predicate that reaches the scan.  A table of tickers, or a list of more than
    ``LONG_LIST``, is a semi-join, whose size no plan has to carry.
    """
    if tickers is None:
        return df
    if not isinstance(tickers, DataFrame):
        if len(tickers) == 0:
            return df.limit(0)
        if len(tickers) <= LONG_LIST:
            return df.where(F.col("ticker").isin(*tickers))
        tickers = df.sparkSession.createDataFrame([(t,) for t in tickers], "ticker string")
    wanted = tickers.select(F.col("ticker").alias("_wanted"))
    return df.join(wanted, F.col("ticker") == F.col("_wanted"), "left_semi")


def portfolio_summary(portfolio: DataFrame, tickers: Selection = None) -> DataFrame:
    """A1: per ticker price range and rounded volatility / best return / max drawdown."""
    return select_tickers(portfolio, tickers).groupBy("ticker").agg(
        F.max("close_price").alias("max_price"),
        F.min("close_price").alias("min_price"),
        round_half_up(F.avg("rolling_volatility_20d"), 2).alias("avg_volatility"),
        round_half_up(F.max("cumulative_return_pct"), 2).alias("best_return"),
        round_half_up(F.min("drawdown_pct"), 2).alias("max_drawdown"),
    )


def _arg(order: Column, ticker: str = "ticker") -> Column:
    """Ticker of the smallest non-null ``order``; ties go to the smallest ticker."""
    return F.min_by(F.col(ticker), F.when(order.isNotNull(), F.struct(order, F.col(ticker))))


def portfolio_extremes(summary: DataFrame, selected: Selection = None) -> DataFrame:
    """A2-A4: best / worst performer, most volatile, and the headline numbers.

    "Avg Volatility" is the maximum of the per-ticker averages, as displayed.
    "Tickers Tracked" is the size of the selection, with or without rows; without a
    selection every ticker of the summary is selected.
    """
    if selected is None:
        tracked = F.count(F.lit(1))
    elif isinstance(selected, DataFrame):
        # the selection may have tickers without rows, or the summary none at all
        return portfolio_extremes(summary, ()).withColumn(
            "tickers_tracked", selected.agg(F.count_distinct("ticker")).scalar())
    else:
        tracked = F.lit(len(selected)).cast("bigint")
    best, vol = F.col("best_return"), F.col("avg_volatility")
    return summary.agg(
        _arg(-best).alias("best_ticker"),
        _arg(best).alias("worst_ticker"),
        _arg(-vol).alias("most_volatile_ticker"),
        F.max(best).alias("best_return"),
        F.min(best).alias("worst_return"),
        F.max(vol).alias("avg_volatility"),
        tracked.alias("tickers_tracked"),
    )


def ticker_list(portfolio: DataFrame) -> DataFrame:
    """A5: distinct tickers (order them when presenting)."""
    return portfolio.select("ticker").distinct()


def indicator_list(correlation: DataFrame, tickers: Selection = None) -> DataFrame:
    """Distinct non-null indicator names of the selected tickers."""
    return (select_tickers(correlation, tickers).where(F.col("indicator_name").isNotNull())
            .select("indicator_name").distinct())


def indicator_coverage(correlation: DataFrame, tickers: Selection = None) -> DataFrame:
    """Per indicator, whether any rolling correlation is non-null."""
    return select_tickers(correlation, tickers).groupBy("indicator_name").agg(
        F.bool_or(F.col("rolling_correlation_20d").isNotNull()).alias("has_correlation"))


def failed_recent(logs: DataFrame, as_of: Column) -> DataFrame:
    """FAILED runs completed in the 7 days up to ``as_of``."""
    since = F.timestamp_add("DAY", F.lit(-FAILURE_WINDOW_DAYS), as_of)
    return logs.where((F.col("status") == "FAILED") & (F.col("completed_at") >= since)).agg(
        F.count(F.lit(1)).alias("failed_count"))


def recent_runs(logs: DataFrame, n: int = RECENT_RUNS) -> DataFrame:
    """The latest ``n`` runs (a top-k by design), message clipped to 160 characters."""
    return logs.orderBy(F.col("completed_at").desc(), F.col("run_id").desc()).limit(n).select(
        "run_id", "completed_at", "pipeline_name", "entity_name", "status", "rows_fetched",
        "rows_valid", "rows_inserted", "rows_updated", "rows_unchanged", "rows_dropped",
        "duration_ms", "error_code",
        F.substring("error_message", 1, MESSAGE_PREVIEW).alias("error_message"))


def recent_run_totals(logs: DataFrame, n: int = RECENT_RUNS) -> DataFrame:
    """Inserted / updated / unchanged / dropped summed over the latest ``n`` runs only."""
    return recent_runs(logs, n).agg(
        F.sum("rows_inserted").alias("rows_inserted"),
        F.sum("rows_updated").alias("rows_updated"),
        F.sum("rows_unchanged").alias("rows_unchanged"),
        F.sum("rows_dropped").alias("rows_dropped"),
    )


def latest_run(logs: DataFrame, pipeline_name: str) -> DataFrame:
    """R2: the newest completed (non-FAILED) run of one pipeline."""
    return (logs.where((F.col("pipeline_name") == pipeline_name)
                       & F.col("status").isin(*COMPLETED_STATUSES))
            .orderBy(F.col("completed_at").desc(), F.col("run_id").desc()).limit(1)
            .select("entity_name", "completed_at", "status"))


def latest_stock_run(logs: DataFrame) -> DataFrame:
    return latest_run(logs, STOCK_PIPELINE)


def latest_macro_run(logs: DataFrame) -> DataFrame:
    return latest_run(logs, MACRO_PIPELINE)


def price_history(portfolio: DataFrame, tickers: Selection = None) -> DataFrame:
    """The price-chart columns."""
    return select_tickers(portfolio, tickers).select(
        "ticker", "trade_date", "close_price", "ma_20day", "ma_50day", "rolling_volatility_20d",
        "daily_return_pct")


def moving_average_series(portfolio: DataFrame, ticker: str) -> DataFrame:
    """Close and both moving averages of one ticker."""
    return portfolio.where(F.col("ticker") == ticker).select(
        "trade_date", "close_price", "ma_20day", "ma_50day")


def risk_series(risk: DataFrame, tickers: Selection = None) -> DataFrame:
    """The risk-chart columns."""
    return select_tickers(risk, tickers).select(
        "ticker", "trade_date", "rolling_volatility_20d", "sharpe_ratio_20d", "max_drawdown_pct",
        "var_95_pct", "cumulative_return_pct")


def macro_series(correlation: DataFrame, tickers: Selection = None,
                 indicator: str | None = None) -> DataFrame:
    """Correlation-chart columns for the selected tickers, then one indicator."""
    df = select_tickers(correlation, tickers)
    if indicator is not None:
        df = df.where(F.col("indicator_name") == indicator)
    return df.select("ticker", "trade_date", "indicator_name", "indicator_value",
                     "rolling_correlation_20d")


def latest_indicator_values(correlation: DataFrame, indicator: str,
                            tickers: Selection = None) -> DataFrame:
    """Per ticker, the indicator value on its latest matched day, rounded to 2."""
    df = macro_series(correlation, tickers, indicator)
    return df.groupBy("ticker").agg(
        F.max("trade_date").alias("trade_date"),
        round_half_up(F.max_by("indicator_value", "trade_date"), 2).alias("indicator_value"))


SUMMARY_SQL = """
SELECT ticker, MAX(close_price) AS max_price, MIN(close_price) AS min_price,
       CAST(ROUND(CAST(AVG(rolling_volatility_20d) AS DECIMAL(38,8)), 2) AS DOUBLE) AS avg_volatility,
       CAST(ROUND(CAST(MAX(cumulative_return_pct) AS DECIMAL(38,8)), 2) AS DOUBLE) AS best_return,
       CAST(ROUND(CAST(MIN(drawdown_pct) AS DECIMAL(38,8)), 2) AS DOUBLE) AS max_drawdown
FROM {portfolio}
WHERE ticker IN (SELECT explode(:tickers))
GROUP BY ticker
"""


def portfolio_summary_sql(spark, portfolio: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """The summary as SQL text with one bound parameter, the array of selected tickers.

    The text is the same for every selection, and no value is spliced into it.  Spark joins
    with the array's elements.  An empty selection runs nothing.
    """
    if len(tickers) == 0:
        return portfolio_summary(portfolio, tickers)
    return spark.sql(SUMMARY_SQL, args={"tickers": list(tickers)}, portfolio=portfolio)
