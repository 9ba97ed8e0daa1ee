"""Readers for the supplied Parquet tables and the RAW contracts.

Reads are plain ``spark.read.parquet`` so Catalyst prunes columns and pushes
filters into the scan; no schema inference beyond the Parquet footer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# RAW contracts (staging reads these columns by name; extras are ignored).
PRICE_TYPE = T.DecimalType(38, 4)
VOLUME_TYPE = T.DecimalType(38, 0)
INDICATOR_TYPE = T.DecimalType(38, 6)

RAW_STOCK_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("trade_date", T.DateType()),
    T.StructField("open_price", PRICE_TYPE),
    T.StructField("high_price", PRICE_TYPE),
    T.StructField("low_price", PRICE_TYPE),
    T.StructField("close_price", PRICE_TYPE),
    T.StructField("volume", VOLUME_TYPE),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

RAW_MACRO_SCHEMA = T.StructType([
    T.StructField("indicator_name", T.StringType()),
    T.StructField("indicator_date", T.DateType()),
    T.StructField("value", INDICATOR_TYPE),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

PIPELINE_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_timestamp", T.TimestampNTZType(), False),
    T.StructField("completed_at", T.TimestampNTZType(), False),
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("entity_name", T.StringType(), False),
    T.StructField("rows_fetched", T.LongType(), False),
    T.StructField("rows_valid", T.LongType(), False),
    T.StructField("rows_inserted", T.LongType(), False),
    T.StructField("rows_updated", T.LongType(), False),
    T.StructField("rows_unchanged", T.LongType(), False),
    T.StructField("rows_dropped", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("duration_ms", T.LongType(), False),
    T.StructField("error_code", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
])

