"""Plan shapes the scale design relies on, and exact results under a hot key."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tickwise.operators import normalize as N
from tickwise.operators.joins import stock_macro_join
from tickwise.operators.staging import stg_stock_prices
from tickwise.plans import marts
from tickwise.plans.registry import QUERIES

from .conftest import SMOKE_SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_raw(spark, n_hot=3000, n_other=6000):
    """One (ticker, date) key holds a third of all rows, in many versions."""
    d = dt.date(2026, 1, 5)
    base = dt.datetime(2026, 1, 5)
    rows = [("HOT", d, 1.0, 2.0, 1.0, 1.5, 10, base + dt.timedelta(seconds=i)) for i in range(n_hot)]
    rows += [(f"T{i % 50}", d + dt.timedelta(days=i // 50), 1.0, 2.0, 1.0, 1.5, 10, base)
             for i in range(n_other)]
    return spark.createDataFrame(
        rows, "ticker string, trade_date date, open_price double, high_price double, "
              "low_price double, close_price double, volume bigint, loaded_at timestamp_ntz")


def test_hot_key_is_reduced_before_the_shuffle(spark):
    stg = stg_stock_prices(_hot_raw(spark).repartition(8))
    hot = stg.where("ticker = 'HOT'").collect()
    assert len(hot) == 1
    assert hot[0].loaded_at == dt.datetime(2026, 1, 5) + dt.timedelta(seconds=2999)
    plan = _plan(stg)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the partial limit sits below the exchange (map side)
    assert plan.index("Exchange") < plan.rindex("Partial")


def test_unbounded_batch_dedup_is_exact_with_a_hot_key(spark):
    n = 3000
    rows = [(i, "AAPL", "2026-01-02", "1", "10", "1", str(1 + i % 7), "10") for i in range(n)]
    rows += [(n + i, f"T{i}", "2026-01-02", "1", "2", "1", "1", "10") for i in range(2 * n)]
    df = spark.createDataFrame(rows, "_input_order bigint, ticker string, trade_date string, "
                                     "open_price string, high_price string, low_price string, "
                                     "close_price string, volume string")
    valid, rejected = N.stock_normalization(df.repartition(8))
    hot = valid.where("ticker = 'AAPL'").collect()
    assert [(r._input_order, r.close_price) for r in hot] == [(n - 1, 1 + (n - 1) % 7)]
    assert rejected.where("reason = 'duplicate_key'").count() == n - 1
    # losers are found on the unique row identity, not on the business key
    assert "LeftAnti" in _plan(rejected)


def test_macro_join_follows_measured_bytes(spark):
    """No strategy is forced and nothing runs while the plan is built; results agree either way."""
    port = QUERIES["mart_portfolio"](spark, SMOKE_SF)
    changes = marts.macro_changes(QUERIES["stg_macro_indicators"](spark, SMOKE_SF))
    returns = port.select("ticker", "trade_date", "daily_return_pct").where(
        F.col("daily_return_pct").isNotNull())
    cols = ["ticker", "trade_date", "indicator_name", "indicator_change_pct"]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job may run")
    joined = stock_macro_join(returns, changes).select(cols)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    small = sorted(joined.collect())
    assert "BroadcastHashJoin" in _plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = stock_macro_join(returns, changes).select(cols)
        assert sorted(big.collect()) == small
        assert "SortMergeJoin" in _plan(big)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_metrics_and_single_model_checks_scan_once(spark):
    for name in ("stock_normalization_metrics", "macro_normalization_metrics", "dq_unique_stock_key",
                 "dq_valid_ohlcv"):
        assert _scans(QUERIES[name](spark, SMOKE_SF)) == 1, name
    assert _scans(QUERIES["dq_accepted_values"](spark, SMOKE_SF)) == 2  # orders and customer


def test_mart_exchanges(spark):
    """Rows move for the staging dedup, the cuts by year and the blocks; summaries move besides."""
    plan = _plan(QUERIES["mart_portfolio"](spark, SMOKE_SF))
    initial = plan.split("Initial Plan")[-1]
    for keys in (r"ticker#\d+, trade_date#\d+", r"ticker#\d+, _cut#\d+"):
        assert re.search(rf"Exchange hashpartitioning\({keys}", initial), keys
    assert "CartesianProduct" not in plan and "SinglePartition" not in plan


def test_ticker_predicate_reaches_the_scan(spark):
    df = QUERIES["moving_average_series"](spark, SMOKE_SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the filter on the window partition key is below every Window node
    assert plan.rindex("Window") < plan.rindex("Filter")
