"""Data-quality checks: each returns the violating rows (zero rows = pass).

``dq_report`` runs all 28 checks (22 not-null, 1 accepted-values, 5 singular)
and returns one row per check.  All checks of a model that look at single rows are
counted as the model is written (``watched``), or else in one pass over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickwise.operators.audit import count_violations, status_violations

# The columns each model guarantees non-null, and accepted names.
NOT_NULL = {
    "stg_stock_prices": ("ticker", "trade_date", "close_price", "volume", "loaded_at"),
    "stg_macro_indicators": ("indicator_name", "indicator_date", "value", "loaded_at"),
    "mart_portfolio": ("ticker", "trade_date", "close_price", "updated_at"),
    "mart_risk": ("ticker", "trade_date", "cumulative_return_pct", "updated_at"),
    "mart_macro_correlation": ("ticker", "indicator_name", "trade_date", "indicator_value",
                               "updated_at"),
}
ACCEPTED_INDICATORS = ("CONSUMER PRICE INDEX", "FEDERAL FUNDS RATE", "GROSS DOMESTIC PRODUCT",
                       "UNEMPLOYMENT RATE", "10 YEAR TREASURY RATE")
LOGS = "pipeline_logs"
# Freshness of the stock source, in days.
FRESHNESS_WARN_DAYS = 3
FRESHNESS_ERROR_DAYS = 7


def dq_not_null(model: DataFrame, model_name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Q1: (model, column, failures) for each guaranteed column, from one aggregation."""
    cols = list(columns or NOT_NULL[model_name])
    counts = model.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.select(
        F.lit(model_name).alias("model"),
        F.expr(f"stack({len(cols)}, {stack}) AS (column_name, failures)"))


def dq_accepted_values(stg_macro: DataFrame,
                       accepted: Sequence[str] = ACCEPTED_INDICATORS) -> DataFrame:
    """Q2: staged macro rows with an indicator name outside the list (null passes)."""
    return stg_macro.where(~F.col("indicator_name").isin(*accepted))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once (GROUP BY … HAVING COUNT(*) > 1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def dq_unique_stock_key(stg_stock: DataFrame) -> DataFrame:
    """Q3."""
    return duplicate_keys(stg_stock, ["ticker", "trade_date"])


def dq_unique_macro_key(stg_macro: DataFrame) -> DataFrame:
    """Q4."""
    return duplicate_keys(stg_macro, ["indicator_name", "indicator_date"])


def invalid_ohlcv() -> Column:
    o, h, l, c, v = (F.col(x) for x in ("open_price", "high_price", "low_price", "close_price",
                                        "volume"))
    return ((o <= 0) | (h <= 0) | (l <= 0) | (c <= 0) | (v <= 0)
            | (h < o) | (h < l) | (h < c) | (l > o) | (l > h) | (l > c))


def dq_valid_ohlcv(stg_stock: DataFrame) -> DataFrame:
    """Q5: non-positive or inconsistent bars (a null operand raises nothing)."""
    return stg_stock.where(invalid_ohlcv()).select("ticker", "trade_date")


def dq_log_counts(logs: DataFrame) -> DataFrame:
    """Q6: audit rows whose counts are negative or do not reconcile."""
    return logs.where(count_violations()).select("run_id")


def dq_log_status(logs: DataFrame) -> DataFrame:
    """Q7: audit rows with an unknown status or pipeline."""
    return logs.where(status_violations()).select("run_id")


def source_freshness(raw: DataFrame, as_of: Column, source_name: str = "raw_stock_prices",
                     loaded_at: str = "loaded_at") -> DataFrame:
    """Newest load vs ``as_of``; error after 7 days, warn after 3, else pass."""
    newest = raw.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), as_of)
    day = 86_400 * 1_000_000
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(age > FRESHNESS_ERROR_DAYS * day, F.lit("error"))
              .when(age > FRESHNESS_WARN_DAYS * day, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return newest.select(F.lit(source_name).alias("source_name"), "max_loaded_at",
                         (age / 1_000_000).cast("bigint").alias("age_seconds"),
                         status.alias("status"))


def row_checks(model: str) -> dict[str, Column]:
    """The checks of a model that look at one row at a time: check name to its violation."""
    checks = {f"not_null_{model}_{c}": F.col(c).isNull() for c in NOT_NULL.get(model, ())}
    if model == "stg_macro_indicators":
        checks["accepted_values_stg_macro_indicators_indicator_name"] = ~F.col("indicator_name").isin(
            *ACCEPTED_INDICATORS)
    if model == "stg_stock_prices":
        checks["assert_valid_stock_ohlcv"] = invalid_ohlcv()
    if model == LOGS:
        checks |= {"assert_pipeline_log_counts": count_violations(), "assert_pipeline_log_status": status_violations()}
    return checks


def watched(df: DataFrame, model: str) -> tuple[DataFrame, Observation]:
    """``df`` with its row checks counted while it is written, and where the counts will be.

    Only a full write of the frame counts every row, and it must be written once."""
    seen = Observation()
    return df.observe(seen, *[F.count_if(v).alias(name) for name, v in row_checks(model).items()]), seen


def counted(df: DataFrame, model: str) -> DataFrame:
    """(check_name, failures) of a model's row checks, from one aggregation."""
    checks = row_checks(model)
    counts = df.agg(*[F.count_if(v).alias(name) for name, v in checks.items()])
    stack = ", ".join(f"'{c}', `{c}`" for c in checks)
    return counts.select(F.expr(f"stack({len(checks)}, {stack}) AS (check_name, failures)"))


def _failures(check: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check).alias("check_name"), "failures")


def dq_report(models: dict[str, DataFrame], logs: DataFrame,
              seen: Mapping[str, Observation] | None = None) -> DataFrame:
    """Q8: every check as (check_name, failures, passed); 28 rows.

    Row checks of the models in ``seen`` were counted as they were written (``watched``) and cost
    no scan; those of another model are one aggregation.  The two key checks read their model."""
    seen = seen or {}
    frames = {**models, LOGS: logs}
    parts = [counted(frames[name], name) for name in (*NOT_NULL, LOGS) if name not in seen]
    parts += [_failures("assert_unique_stock_key", dq_unique_stock_key(models["stg_stock_prices"])),
              _failures("assert_unique_macro_key", dq_unique_macro_key(models["stg_macro_indicators"]))]
    found = [(check, n) for own in seen.values() for check, n in own.get.items()]
    if found:  # one row for each check
        parts.append(logs.sparkSession.createDataFrame(found, "check_name string, failures bigint"))
    return reduce(DataFrame.unionByName, parts).select(
        "check_name", F.col("failures").cast("bigint").alias("failures"), (F.col("failures") == 0).alias("passed"))
