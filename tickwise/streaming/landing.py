"""File-triggered ingestion: payloads landing in a folder drive the same run.

Each landed file holds JSON lines ``{"payload_id", "ticker", "payload"}``
(stock) or ``{"payload_id", "series_id", "indicator_name", "payload"}``
(macro).  Structured Streaming tracks which files were processed in its
checkpoint; every micro-batch is one ingestion run through ``foreachBatch``.
The run's key is the stream's id and the batch's number, so a micro-batch that
is replayed after its commit neither loads nor logs anything twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickwise.plans.ingest import run_macro_ingestion, run_stock_ingestion
from tickwise.sources.warehouse import Warehouse

STOCK_LANDING_SCHEMA = T.StructType([
    T.StructField("payload_id", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("payload", T.StringType()),
])
MACRO_LANDING_SCHEMA = T.StructType([
    T.StructField("payload_id", T.StringType()),
    T.StructField("series_id", T.StringType()),
    T.StructField("indicator_name", T.StringType()),
    T.StructField("payload", T.StringType()),
])


def start_landing_stream(spark: SparkSession, landing_dir: str, warehouse: Warehouse,
                         checkpoint_location: str, kind: str = "stock",
                         available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it drains what has landed and stops.

    ``checkpoint_location`` names the stream: its batches are numbered within it.
    """
    schema = STOCK_LANDING_SCHEMA if kind == "stock" else MACRO_LANDING_SCHEMA
    run = run_stock_ingestion if kind == "stock" else run_macro_ingestion
    source = spark.readStream.schema(schema).json(landing_dir)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.limit(1).count() == 0:
            return
        run(batch.sparkSession, batch, warehouse, run_key=f"{kind}:{checkpoint_location}:{epoch_id}")

    writer = (source.writeStream.foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
