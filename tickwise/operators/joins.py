"""The stock/macro date join, and the series dimension.

No join strategy is forced: with adaptive execution Spark broadcasts the macro
side when its measured size in bytes is below the session's threshold, and
otherwise merges sorted partitions and splits skewed ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stock_macro_join(returns: DataFrame, macro: DataFrame) -> DataFrame:
    """J1. Stock returns ⋈ macro observations on exact date equality (inner).

    One output row per indicator observed on the trading day; a monthly point
    matches only when its date is itself a trading day.
    """
    return returns.join(macro, returns["trade_date"] == macro["indicator_date"], "inner")


def series_dimension(spark: SparkSession, names: Mapping[str, str]) -> DataFrame:
    """The configured series (id to display name) as a dimension table.

    It is configuration, a handful of rows that do not grow with the data."""
    return spark.createDataFrame(list(names.items()), "series_id string, indicator_name string")


def with_series_id(points: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Points of the configured series with their ids, looked up by display name."""
    return points.join(F.broadcast(series_dimension(points.sparkSession, names)), "indicator_name")
