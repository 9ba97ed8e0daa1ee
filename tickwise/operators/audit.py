"""Run status, audit rows, invariants and message redaction — all as columns.

One ingestion job processes every entity at once, keyed by a batch id; each
entity still gets its own audit row, and a failed entity (bad payload) becomes
a FAILED row while the others load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.redact import redact_message

# Pipelines, statuses and the public message per error code.
STOCK_PIPELINE = "STOCK_INGESTION"
MACRO_PIPELINE = "MACRO_INGESTION"
PIPELINES = (STOCK_PIPELINE, MACRO_PIPELINE)
STATUSES = ("SUCCESS", "PARTIAL_SUCCESS", "NO_CHANGES", "NO_VALID_ROWS", "FAILED")
COMPLETED_STATUSES = ("SUCCESS", "PARTIAL_SUCCESS", "NO_CHANGES", "NO_VALID_ROWS")
MERGED_STATUSES = ("SUCCESS", "PARTIAL_SUCCESS", "NO_CHANGES")
ERROR_MESSAGES = {
    "API_RESPONSE_INVALID": "Provider response was invalid.",
    "API_RATE_LIMITED": "Provider request was rate limited.",
    "API_DATA_UNAVAILABLE": "Provider data was unavailable.",
    "API_TIMEOUT": "Provider request timed out.",
    "NORMALIZATION_ERROR": "Batch could not be normalised.",
    "SNOWFLAKE_LOAD_ERROR": "Batch could not be loaded.",
}
ENTITY_NAME_MAX = 128
COUNT_COLUMNS = ("rows_fetched", "rows_valid", "rows_inserted", "rows_updated",
                 "rows_unchanged", "rows_dropped")
LOG_COLUMNS = ("run_id", "run_timestamp", "completed_at", "pipeline_name", "entity_name",
               *COUNT_COLUMNS, "status", "duration_ms", "error_code", "error_message")


def run_status(valid: Column, inserted: Column, updated: Column, dropped: Column,
               error_code: Column | None = None) -> Column:
    """FAILED on an error; else NO_VALID_ROWS, NO_CHANGES, PARTIAL_SUCCESS, SUCCESS."""
    expr = F.when(error_code.isNotNull(), F.lit("FAILED")) if error_code is not None else None
    for cond, status in ((valid == 0, "NO_VALID_ROWS"),
                         ((inserted == 0) & (updated == 0), "NO_CHANGES"),
                         (dropped > 0, "PARTIAL_SUCCESS")):
        expr = F.when(cond, F.lit(status)) if expr is None else expr.when(cond, F.lit(status))
    return expr.otherwise(F.lit("SUCCESS"))


def duration_ms(started: Column, completed: Column) -> Column:
    """U4: whole milliseconds between two timestamps, never negative."""
    return F.greatest(F.lit(0).cast("bigint"),
                      F.timestamp_diff("MILLISECOND", started, completed).cast("bigint"))


def uuid_from(*parts: Column) -> Column:
    """A UUID-shaped id (md5 of the parts): unique if one part is, reproducible if all are."""
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def error_message_for(code: Column) -> Column:
    expr = None
    for k, msg in ERROR_MESSAGES.items():
        expr = F.when(code == k, F.lit(msg)) if expr is None else expr.when(code == k, F.lit(msg))
    return expr


def run_log(batches: DataFrame, metrics: DataFrame, counts: DataFrame, *, pipeline_name: str,
            started_at: str, completed_at: str, run_key: str, batch_col: str = "payload_id",
            entity_col: str = "entity_name", secrets: Sequence[str] = ()) -> DataFrame:
    """One 15-column audit row per batch; ``run_key`` makes its ids differ from other runs'.

    ``batches``: batch id, entity, error_code (null when usable);
    ``metrics``: batch id + fetched/valid/dropped (normalisation);
    ``counts``:  batch id + inserted/updated/unchanged (merge).
    Joins are per batch (one row each side), so they stay small and unskewed.
    """
    started = F.lit(started_at).cast("timestamp_ntz")
    completed = F.lit(completed_at).cast("timestamp_ntz")
    j = (batches.join(metrics, batch_col, "left").join(counts, batch_col, "left"))
    failed = F.col("error_code").isNotNull()
    z = F.lit(0).cast("bigint")
    fetched = F.coalesce(F.col("rows_fetched"), z)
    valid = F.coalesce(F.col("rows_valid"), z)
    dropped = F.coalesce(F.col("rows_dropped"), z)
    ins = F.when(failed, z).otherwise(F.coalesce(F.col("rows_inserted"), z))
    upd = F.when(failed, z).otherwise(F.coalesce(F.col("rows_updated"), z))
    unch = F.when(failed, z).otherwise(F.coalesce(F.col("rows_unchanged"), z))
    return j.select(
        uuid_from(F.lit(pipeline_name), F.col(batch_col), F.lit(run_key)).alias("run_id"),
        started.alias("run_timestamp"),
        completed.alias("completed_at"),
        F.lit(pipeline_name).alias("pipeline_name"),
        F.substring(F.col(entity_col), 1, ENTITY_NAME_MAX).alias("entity_name"),
        fetched.alias("rows_fetched"), valid.alias("rows_valid"), ins.alias("rows_inserted"),
        upd.alias("rows_updated"), unch.alias("rows_unchanged"), dropped.alias("rows_dropped"),
        run_status(valid, ins, upd, dropped, F.col("error_code")).alias("status"),
        duration_ms(started, completed).alias("duration_ms"),
        F.col("error_code"),
        F.when(failed, redact_message(error_message_for(F.col("error_code")), secrets))
        .alias("error_message"),
    )


def count_violations() -> Column:
    """Q6 predicate: negative counts, or counts that do not reconcile for the status.

    Three-valued on purpose: a null operand does not make a violation.
    """
    negative = None
    for c in (*COUNT_COLUMNS, "duration_ms"):
        e = F.col(c) < 0
        negative = e if negative is None else negative | e
    normalized = (F.col("status") != "FAILED") & (
        F.col("rows_valid") + F.col("rows_dropped") != F.col("rows_fetched"))
    merged = F.col("status").isin(*MERGED_STATUSES) & (
        F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_unchanged")
        != F.col("rows_valid"))
    return negative | normalized | merged


def status_violations() -> Column:
    """Q7 predicate: status or pipeline outside the allowed values."""
    return ~F.col("status").isin(*STATUSES) | ~F.col("pipeline_name").isin(*PIPELINES)


def run_log_violations(logs: DataFrame) -> DataFrame:
    """Audit rows breaking any invariant the writer enforces, with the rule broken."""
    no_valid = (F.col("status") == "NO_VALID_ROWS") & (
        (F.col("rows_valid") != 0) | (F.col("rows_inserted") != 0)
        | (F.col("rows_updated") != 0) | (F.col("rows_unchanged") != 0))
    rule = (F.when(F.coalesce(status_violations(), F.lit(False)), F.lit("metadata"))
            .when(F.coalesce(count_violations(), F.lit(False)), F.lit("counts"))
            .when(F.coalesce(no_valid, F.lit(False)), F.lit("no_valid_rows")))
    return logs.select("run_id", "pipeline_name", "status", rule.alias("violation")).where(
        F.col("violation").isNotNull())


def redact_messages(logs: DataFrame, secrets: Sequence[str] = ()) -> DataFrame:
    """U7 over a message column: redact credentials, flatten lines, clip to 500."""
    return logs.where(F.col("error_message").isNotNull()).select(
        "run_id", redact_message(F.col("error_message"), secrets).alias("error_message"))


def run_summary(logs: DataFrame) -> DataFrame:
    """U8: per pipeline, entity runs by outcome and whether the run as a whole failed."""
    return logs.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("entity_runs"),
        F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
        F.bool_or(F.col("status") == "FAILED").alias("any_failed"),
        F.sum("rows_inserted").alias("rows_inserted"),
        F.sum("rows_updated").alias("rows_updated"),
    )
