"""Window-function columns of the marts (all ROWS frames, one ordering column).

Every column here shares ``PARTITION BY ticker ORDER BY trade_date`` (or the
(ticker, indicator) pair for the correlation), so a whole mart is one hash
exchange and one sort; the frames differ only inside the Window operator.

After staging a ticker holds at most one row per calendar day, so a window
partition is bounded by the length of the calendar, not by the data volume.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickwise.functions.rounding import round_half_up

# Fixed values of the risk model.
RISK_FREE_DAILY_PCT = 0.0198      # 5 % a year expressed per trading day, in percent
TRADING_DAYS = 252                # annualisation factor for the Sharpe ratio
VAR_95_Z = 1.645                  # one-sided 95 % normal quantile
SHORT_WINDOW = 20
LONG_WINDOW = 50
# Rows whose sums the averages over both are added up from.
MEAN_STEP = 10


def by_ticker(partition: tuple[str, ...] = ("ticker",), order: str = "trade_date") -> WindowSpec:
    return Window.partitionBy(*partition).orderBy(order)


def trailing(spec: WindowSpec, rows: int) -> WindowSpec:
    return spec.rowsBetween(-(rows - 1), Window.currentRow)


def cumulative(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def nonzero(c: Column) -> Column:
    """NULLIF(c, 0): the zero-divisor guard (ANSI division by zero raises otherwise)."""
    return F.when(c != 0, c)


def pct_change(current: Column, previous: Column, scale: int = 4) -> Column:
    """ROUND((cur - prev) / NULLIF(prev, 0) * 100, scale)."""
    return round_half_up((current - previous) / nonzero(previous) * 100, scale)


# -- W2..W9: portfolio -------------------------------------------------------

def prev_close(spec: WindowSpec) -> Column:
    return F.lag("close_price").over(spec)


def moving_average(col: str, spec: WindowSpec, rows: int, scale: int = 4) -> Column:
    return round_half_up(F.avg(F.col(col).cast("double")).over(trailing(spec, rows)), scale)


def with_means(df: DataFrame, spec: WindowSpec, step: int, means: Mapping[str, tuple[str, int]]) -> DataFrame:
    """``df`` with averages (null values do not count) over trailing rows: name to (column, rows).

    A trailing frame is folded anew for every row.  So only frames of ``step`` rows are, and the
    sums of longer ones (``rows`` is a multiple of ``step``) are added up from theirs.
    """
    columns = list(dict.fromkeys(c for c, _ in means.values()))
    own = {c: (f"_sum_{i}", f"_count_{i}") for i, c in enumerate(columns)}
    frame, types = trailing(spec, step), dict(df.dtypes)
    # a plain column is not copied into the shuffle
    value = {c: F.col(c) if types[c] == "double" else F.col(c).cast("double") for c in columns}
    parts = df.select("*", *[F.sum(v).over(frame).alias(own[c][0]) for c, v in value.items()],
                      *[F.count(c).over(frame).alias(own[c][1]) for c in columns])

    def whole(part: str, rows: int, zero: Column) -> Column:
        total = F.coalesce(part, zero)
        for back in range(step, rows, step):
            total = total + F.coalesce(F.lag(part, back).over(spec), zero)
        return total

    def mean(column: str, rows: int) -> Column:
        if rows % step:
            raise ValueError(f"{rows} rows are no multiple of {step}")
        total, n = own[column]
        return whole(total, rows, F.lit(0.0)) / nonzero(whole(n, rows, F.lit(0)))

    return parts.select(*df.columns, *[mean(c, rows).alias(name) for name, (c, rows) in means.items()])


def rolling_stddev(col: str, spec: WindowSpec, rows: int, scale: int = 4) -> Column:
    """Sample standard deviation over the trailing rows; null for fewer than 2 values."""
    return round_half_up(F.stddev_samp(col).over(trailing(spec, rows)), scale)


def cumulative_return(spec: WindowSpec) -> Column:
    first = F.first("close_price").over(cumulative(spec))
    return round_half_up((F.col("close_price") - first) / nonzero(first) * 100, 4)


def running_peak(spec: WindowSpec) -> Column:
    return F.max("close_price").over(cumulative(spec))


def drawdown(close: Column, peak: Column) -> Column:
    return round_half_up((close - peak) / nonzero(peak) * 100, 4)


# -- W10..W13: risk ----------------------------------------------------------

def sharpe_ratio(avg_return: Column, volatility: Column) -> Column:
    return round_half_up(
        (avg_return - RISK_FREE_DAILY_PCT) / nonzero(volatility) * math.sqrt(TRADING_DAYS), 4)


def value_at_risk(avg_return: Column, volatility: Column) -> Column:
    return round_half_up(avg_return - VAR_95_Z * nonzero(volatility), 4)


def running_min(col: str, spec: WindowSpec) -> Column:
    return F.min(col).over(cumulative(spec))


# -- W15..W18: rolling correlation --------------------------------------------

def with_rolling_correlation(df: DataFrame, x: str, y: str, spec: WindowSpec, name: str,
                             rows: int = SHORT_WINDOW, step: int = 5) -> DataFrame:
    """``rolling_correlation`` as a column of ``df``, its averages from shorter sums."""
    frame = trailing(spec, rows)
    # the first window moves the rows, so products need not move
    spread = df.withColumn("_spread", F.stddev_samp(x).over(frame) * F.stddev_samp(y).over(frame))
    means = with_means(spread.withColumn("_xy", F.col(x) * F.col(y)), spec, step, {
        "_mean_x": (x, rows), "_mean_y": (y, rows), "_mean_xy": ("_xy", rows)})
    value = (F.col("_mean_xy") - F.col("_mean_x") * F.col("_mean_y")) / nonzero(F.col("_spread"))
    return means.select(*df.columns, round_half_up(value, 4).alias(name))


def rolling_correlation(x: str, y: str, spec: WindowSpec, rows: int = SHORT_WINDOW) -> Column:
    """(E[XY] - E[X]E[Y]) / NULLIF(s_x * s_y, 0) over the trailing rows, rounded to 4.

    Population covariance over sample deviations — deliberately not ``corr()``:
    it equals r·(n-1)/n on complete frames, and E[XY] skips rows where either
    side is null while E[X] and E[Y] do not.
    """
    frame = trailing(spec, rows)
    avg_x = F.avg(x).over(frame)
    avg_y = F.avg(y).over(frame)
    std_x = F.stddev_samp(x).over(frame)
    std_y = F.stddev_samp(y).over(frame)
    avg_xy = F.avg(F.col(x) * F.col(y)).over(frame)
    return round_half_up((avg_xy - avg_x * avg_y) / nonzero(std_x * std_y), 4)
