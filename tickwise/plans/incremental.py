"""Marts after a late batch, rebuilt from window state and the changed days only.

A window column at a day depends on few facts about the days before it: the ticker's first close,
its peak, its lowest drawdown, and its last 49 rows.  ``window_state`` takes these from a mart as
it is, one row for each ticker, up to the day before the ticker's first changed one.
``refresh_portfolio`` and ``refresh_risk`` put those rows in front of the staged rows from that
day on, compute these alone, and take all earlier rows from the mart.

The rows in front carry the facts: the running peak of the last row before is the peak of all of
them, so the same segmented scan and blocks as in the full build (``plans.marts``) continue it.

Defined cases: a ticker that the mart does not have is built from its first day; a ticker without
a change keeps its rows; a change at a ticker's first day rebuilds all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.rounding import round_half_up
from tickwise.operators import segments as S
from tickwise.operators import windows as W
from tickwise.plans.marts import PORTFOLIO_COLUMNS, PORTFOLIO_MEANS, RISK_COLUMNS, RISK_MEANS, _stamp

RECENT = W.LONG_WINDOW - 1


def first_changes(changed_rows: DataFrame) -> DataFrame:
    """ticker and since, its first changed day, of rows that a batch inserted, updated or removed."""
    return changed_rows.groupBy(F.upper("ticker").alias("ticker")).agg(F.min("trade_date").alias("since"))


def _matched(df: DataFrame, changes: DataFrame, how: str) -> DataFrame:
    c = changes.select(F.col("ticker").alias("_c"), "since")
    return df.join(c, F.col("ticker").eqNullSafe(F.col("_c")), how).drop("_c")


def _kept(old: DataFrame, changes: DataFrame) -> DataFrame:
    """The mart's rows before the first change of their ticker."""
    return _matched(old, changes, "left").where("since IS NULL OR trade_date < since").drop("since")


def _tail(rows: DataFrame, changes: DataFrame) -> DataFrame:
    return _matched(rows, changes, "inner").where("trade_date >= since").drop("since")


def rows_since(raw: DataFrame, changes: DataFrame) -> DataFrame:
    """RAW rows of changed tickers from their first changed day on: what staging has to read."""
    c = changes.select(F.col("ticker").alias("_c"), "since")
    return raw.join(c, F.upper("ticker").eqNullSafe(F.col("_c")) & (F.col("trade_date") >= F.col("since"))) \
        .drop("_c", "since")


def window_state(portfolio: DataFrame, changes: DataFrame) -> DataFrame:
    """ticker, first_close, running_peak, max_drawdown_pct and recent: an array of the last
    ``RECENT`` rows (trade_date, close_price, daily_return_pct, volume) before ``since``.

    The lowest drawdown is that of days with a return, as the risk mart has it.
    """
    before = _matched(portfolio, changes, "inner").where("trade_date < since")
    newest = Window.partitionBy("ticker").orderBy(F.desc("trade_date"))
    # the limit is applied before the shuffle too, so no task sees a long history
    last = before.select("ticker", "trade_date", "close_price", "daily_return_pct", "volume",
                         F.row_number().over(newest).alias("_n")).where(F.col("_n") <= RECENT)
    recent = last.groupBy("ticker").agg(F.sort_array(F.collect_list(
        F.struct("trade_date", "close_price", "daily_return_pct", "volume"))).alias("recent"))
    facts = before.groupBy(F.col("ticker").alias("_t")).agg(
        F.min_by("close_price", "trade_date").alias("first_close"), F.max("running_peak").alias("running_peak"),
        F.min(F.when(F.col("daily_return_pct").isNotNull(), F.col("drawdown_pct"))).alias("max_drawdown_pct"))
    return recent.join(facts, F.col("ticker").eqNullSafe(F.col("_t"))).drop("_t")


def _in_front(state: DataFrame) -> DataFrame:
    return state.select("ticker", "first_close", "running_peak", "max_drawdown_pct", F.explode("recent").alias("_r")) \
        .select("ticker", "first_close", "running_peak", "max_drawdown_pct", "_r.*")


def refresh_portfolio(old: DataFrame, stg: DataFrame, changes: DataFrame,
                      updated_at: Column | None = None, state: DataFrame | None = None) -> DataFrame:
    """M1 after a change: ``old`` before each ticker's ``since``, and from that day on rows built
    from ``state`` and ``stg``, which needs to hold no earlier days of the changed tickers."""
    state = window_state(old, changes) if state is None else state
    nothing = F.lit(None)
    plain = {f.name: f.dataType for f in stg.schema.fields}
    days = ("open_price", "high_price", "low_price")
    front = _in_front(state).select(
        "ticker", "trade_date", *[nothing.cast(plain[c]).alias(c) for c in days], "close_price",
        F.col("volume").cast(plain["volume"]).alias("volume"),
        F.col("first_close").alias("_first"), F.col("running_peak").alias("_top"), F.lit(True).alias("_front"))
    new = _tail(stg, changes).select(
        "ticker", "trade_date", *days, "close_price", "volume", F.col("close_price").alias("_first"),
        F.col("close_price").alias("_top"), F.lit(False).alias("_front"))
    placed = S.running(front.unionByName(new), "ticker", "trade_date", _first_close=("first", "_first"),
                       running_peak=("max", "_top"))
    w = S.by_block("ticker")
    returns = S.overlapping(placed, RECENT).withColumn("prev_close_price", W.prev_close(w)).withColumn(
        "daily_return_pct", W.pct_change(F.col("close_price"), F.col("prev_close_price")))
    metrics = W.with_means(returns, w, W.MEAN_STEP, PORTFOLIO_MEANS).select(
        "*",
        round_half_up("_mean_20", 4).alias("ma_20day"),
        round_half_up("_mean_50", 4).alias("ma_50day"),
        W.rolling_stddev("daily_return_pct", w, W.SHORT_WINDOW).alias("rolling_volatility_20d"),
        W.pct_change(F.col("close_price"), F.col("_first_close")).alias("cumulative_return_pct"),
        W.drawdown(F.col("close_price"), F.col("running_peak")).alias("drawdown_pct"))
    rebuilt = S.own_rows(metrics.where(~F.col("_front")), *PORTFOLIO_COLUMNS[:-1], _stamp(updated_at))
    return _kept(old, changes).select(*PORTFOLIO_COLUMNS).unionByName(rebuilt)


def refresh_risk(old: DataFrame, portfolio: DataFrame, changes: DataFrame,
                 updated_at: Column | None = None, state: DataFrame | None = None) -> DataFrame:
    """M2 after a change, from the refreshed M1 in the same way; its state is that of the days
    with a return, as those are the rows of its frames."""
    returns = portfolio.where("daily_return_pct IS NOT NULL")
    state = window_state(returns, changes) if state is None else state
    shown = ("daily_return_pct", "rolling_volatility_20d", "cumulative_return_pct")
    types = {f.name: f.dataType for f in portfolio.schema.fields}
    front = _in_front(state).select(
        "ticker", "trade_date", "daily_return_pct", "volume", F.col("max_drawdown_pct").alias("_low"),
        *[F.lit(None).cast(types[c]).alias(c) for c in shown[1:]], F.lit(True).alias("_front"))
    new = _tail(returns, changes).select(
        "ticker", "trade_date", "daily_return_pct", "volume", F.col("drawdown_pct").alias("_low"), *shown[1:],
        F.lit(False).alias("_front"))
    placed = S.running(front.unionByName(new), "ticker", "trade_date", max_drawdown_pct=("min", "_low"))
    w = S.by_block("ticker")
    average, vol = F.col("_mean_return"), F.col("rolling_volatility_20d")
    metrics = W.with_means(S.overlapping(placed, RECENT), w, W.MEAN_STEP, RISK_MEANS).select(
        "*", W.sharpe_ratio(average, vol).alias("sharpe_ratio_20d"), W.value_at_risk(average, vol).alias("var_95_pct"),
        round_half_up("_mean_volume", 0).alias("avg_volume_20d"))
    rebuilt = S.own_rows(metrics.where(~F.col("_front")), *RISK_COLUMNS[:-1], _stamp(updated_at))
    return _kept(old, changes).select(*RISK_COLUMNS).unionByName(rebuilt)
