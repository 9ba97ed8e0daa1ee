"""Staging models: filter, canonicalise, keep the latest load per key.

The dedup partition uses the *raw* key columns, exactly as the SQL models
resolve ``PARTITION BY ticker`` to the base column (so ``aapl`` and ``AAPL``
on one day are two keys; ``dq_unique_stock_key`` reports that case).

``row_number() = 1`` lets Spark insert a partial ``WindowGroupLimit`` before
the shuffle, so each map task forwards at most one version per key: a key
holding a third of all versions is reduced map-side, not in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STOCK_COLUMNS = ("ticker", "trade_date", "open_price", "high_price", "low_price",
                 "close_price", "volume", "loaded_at")
MACRO_COLUMNS = ("indicator_name", "indicator_date", "value", "loaded_at")


# Total order that picks the surviving version of a key (latest load first).
STOCK_ORDER = ("loaded_at", "close_price", "open_price", "high_price", "low_price", "volume")
MACRO_ORDER = ("loaded_at", "value")


def _desc(cols) -> list:
    return [F.col(c).desc_nulls_last() for c in cols]


def latest_per_key(df: DataFrame, keys: list[str], order) -> DataFrame:
    """Keep the first row per key, ordering by ``order`` columns descending (row_number = 1)."""
    w = Window.partitionBy(*keys).orderBy(*_desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def stg_stock_prices(raw: DataFrame) -> DataFrame:
    """T1. ``close_price IS NOT NULL AND volume > 0`` before the dedup, latest ``loaded_at`` wins.

    Ties on ``loaded_at`` break on the row values (close, open, high, low, volume,
    all descending) so the survivor is deterministic; rows equal on all of them
    are indistinguishable in the output.
    """
    src = raw.select(*STOCK_COLUMNS).where(
        F.col("close_price").isNotNull() & (F.col("volume") > 0))
    latest = latest_per_key(src, ["ticker", "trade_date"], STOCK_ORDER)
    return latest.select(
        F.upper("ticker").alias("ticker"),
        F.col("trade_date").cast("date").alias("trade_date"),
        F.col("open_price").cast("double").alias("open_price"),
        F.col("high_price").cast("double").alias("high_price"),
        F.col("low_price").cast("double").alias("low_price"),
        F.col("close_price").cast("double").alias("close_price"),
        # RAW volumes are whole numbers of up to 38 digits; nothing narrower holds them all
        F.col("volume"),
        F.col("loaded_at"),
    )


def stg_macro_indicators(raw: DataFrame) -> DataFrame:
    """T2. ``value IS NOT NULL``, latest ``loaded_at`` per (indicator_name, indicator_date)."""
    src = raw.select(*MACRO_COLUMNS).where(F.col("value").isNotNull())
    latest = latest_per_key(src, ["indicator_name", "indicator_date"], MACRO_ORDER)
    return latest.select(
        F.upper("indicator_name").alias("indicator_name"),
        F.col("indicator_date").cast("date").alias("indicator_date"),
        F.col("value").cast("double").alias("value"),
        F.col("loaded_at"),
    )
