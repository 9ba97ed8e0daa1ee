"""One ingestion run: landed payloads → normalised batches → upsert → audit rows.

``stock_run_plan`` / ``macro_run_plan`` are the pure plans (DataFrames in,
DataFrames out).  ``run_*_ingestion`` execute them against the warehouse.
All entities (payloads) of the run are processed by one set of Spark jobs and
give what one run after the other, in landing order, would: a later payload
updates what an earlier one loaded, and each payload's counts are taken against
the state left by those before it.  A bad payload becomes a FAILED audit row
and the others still load.

The per-row reasons are staged under the shared checkpoint folder (lineage cut;
survives executor loss).  The labelled merge is written once, by month, where its
final rows are the snapshot's; counts are read from it.  The touched months and
the audit rows are then published by one commit.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.parse import canonical_upper, date_text, strip_text
from tickwise.operators import audit as AU
from tickwise.operators import normalize as N
from tickwise.operators import upsert as U
from tickwise.sources import payloads as P
from tickwise.sources import sinks
from tickwise.sources.tables import RAW_MACRO_SCHEMA, RAW_STOCK_SCHEMA
from tickwise.sources.warehouse import RAW_TABLES, ConcurrentCommit, Warehouse

TS_FORMAT = "%Y-%m-%d %H:%M:%S.%f"
# Times a run merges again when others commit before it.
ATTEMPTS = 10
# Payloads merge in this order.
ORDER = ("landing_order", "payload_id")
Stage = Callable[[DataFrame, str], DataFrame]
# The snapshot rows a batch may touch, given the batch's valid rows.
Target = Callable[[DataFrame], DataFrame]


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime(TS_FORMAT)


def _keep(df: DataFrame, name: str) -> DataFrame:
    return df


@dataclass(frozen=True)
class RunPlan:
    batches: DataFrame   # payload_id, entity_name, error_code (null = usable)
    metrics: DataFrame   # payload_id + normalisation counts
    merged: DataFrame    # labelled merge (_action, payload_id; _final = new snapshot row)

    def audit(self, pipeline_name: str, started_at: str, completed_at: str, run_key: str,
              secrets: Sequence[str] = ()) -> DataFrame:
        return AU.run_log(self.batches, self.metrics, U.merge_counts(self.merged, ["payload_id"]),
                          pipeline_name=pipeline_name, started_at=started_at,
                          completed_at=completed_at, run_key=run_key, secrets=secrets)

    def snapshot(self) -> DataFrame:
        return self.merged.where("_final").drop("_action", "_final", "payload_id")


def _landed(payloads: DataFrame) -> DataFrame:
    """Payloads without a landing order come in the order of their ids."""
    if "landing_order" in payloads.columns:
        return payloads
    return payloads.withColumn("landing_order", F.lit(0).cast("bigint"))


def _typed(target: DataFrame, schema) -> DataFrame:
    return target.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _merged(target: DataFrame | Target, valid: DataFrame, schema, keys, values, started_at: str) -> DataFrame:
    rows = target(valid) if callable(target) else target
    return U.merge_in_order(_typed(rows, schema), valid, keys, values, ORDER,
                            F.lit(started_at).cast("timestamp_ntz"), carry=["payload_id"])


def _entity(name: Column) -> Column:
    return F.coalesce(F.substring(name, 1, AU.ENTITY_NAME_MAX), F.lit(""))


def stock_run_plan(payloads: DataFrame, target: DataFrame | Target, started_at: str,
                   stage: Stage = _keep) -> RunPlan:
    """Plan of one stock run against ``target`` (the snapshot rows it may touch).

    A payload whose ticker is no ticker fails before any of its rows is counted.
    """
    landed = _landed(payloads)
    ticker = canonical_upper("ticker")
    good = F.coalesce(ticker.rlike(N.TICKER_PATTERN), F.lit(False))
    batches = stage(P.classify_stock_payloads(landed).select(
        "payload_id", _entity(ticker).alias("entity_name"),
        F.when(~good, F.lit(N.NormalizationError.code)).otherwise(F.col("error_code")).alias("error_code")),
        "batches")
    rows = P.parse_stock_payloads(landed.where(good), ("payload_id", "landing_order", "ticker"))
    final = stage(N.stock_reasons(rows, batch_cols=ORDER), "reasons")
    metrics = N.metrics_from_reasons(final, N.STOCK_REASONS, ["payload_id"])
    merged = _merged(target, N.valid_stock_rows(final, ORDER), RAW_STOCK_SCHEMA, U.STOCK_KEY, U.STOCK_VALUES,
                     started_at)
    return RunPlan(batches, metrics, merged)


def macro_run_plan(payloads: DataFrame, target: DataFrame | Target, started_at: str,
                   stage: Stage = _keep) -> RunPlan:
    """Plan of one macro run; the entity is the series' display name."""
    landed = _landed(payloads)
    batches = stage(P.classify_macro_payloads(landed).select(
        "payload_id", _entity(strip_text("indicator_name")).alias("entity_name"), "error_code"), "batches")
    rows = P.parse_macro_payloads(landed, ("payload_id", "landing_order", "series_id", "indicator_name"))
    final = stage(N.macro_reasons(rows, batch_cols=ORDER), "reasons")
    metrics = N.metrics_from_reasons(final, N.MACRO_REASONS, ["payload_id"])
    merged = _merged(target, N.valid_macro_rows(final, ORDER), RAW_MACRO_SCHEMA, U.MACRO_KEY, U.MACRO_VALUES,
                     started_at)
    return RunPlan(batches, metrics, merged)


def _attempt(spark: SparkSession, plan_fn, payloads: DataFrame, warehouse: Warehouse, table: str,
             pipeline: str, started: str, secrets: Sequence[str], key: str) -> DataFrame:
    """Merge the payloads into what is committed now, and commit that."""
    state = warehouse.state(spark)
    _, date = RAW_TABLES[table]
    attempt = uuid.uuid4().hex

    def stage(df: DataFrame, name: str) -> DataFrame:
        return sinks.stage(spark, df, name, f"{pipeline.lower()}-{attempt}")

    def touched(valid: DataFrame) -> DataFrame:
        """Snapshot rows in the months the batch touches; the calendar bounds their number."""
        months = [r[0] for r in valid.select(date_text(date, "yyyy-MM")).distinct().collect()]
        return warehouse.read(spark, table, months, state)

    plan = plan_fn(payloads, touched, started, stage)
    written = warehouse.write(spark, state, table, plan.merged)
    plan = RunPlan(plan.batches, plan.metrics, written.rows(spark))
    audit = stage(plan.audit(pipeline, started, _now(), key, secrets), "audit")
    warehouse.commit(spark, state, key, table, written, audit)
    return audit


def _execute(spark: SparkSession, plan_fn, payloads: DataFrame, warehouse: Warehouse, table: str,
             pipeline: str, started_at: str | None, secrets: Sequence[str], run_key: str | None) -> DataFrame:
    """One run.  If another one commits meanwhile, merge again into what that one left."""
    started, key = started_at or _now(), run_key or uuid.uuid4().hex
    for left in reversed(range(ATTEMPTS)):
        done = warehouse.committed(spark, key)
        if done is not None:  # this very run is committed; a replay changes nothing
            return done
        try:
            return _attempt(spark, plan_fn, payloads, warehouse, table, pipeline, started, secrets, key)
        except ConcurrentCommit:
            if not left:
                raise
    raise AssertionError("unreachable")


def run_stock_ingestion(spark: SparkSession, payloads: DataFrame, warehouse: Warehouse,
                        started_at: str | None = None, secrets: Sequence[str] = (),
                        run_key: str | None = None) -> DataFrame:
    """Ingest stock payloads (payload_id, ticker, payload and, if known, landing_order).

    Returns the audit rows committed.  A ``run_key`` that is committed already is not run again.
    """
    return _execute(spark, stock_run_plan, payloads, warehouse, "raw_stock_prices", AU.STOCK_PIPELINE,
                    started_at, secrets, run_key)


def run_macro_ingestion(spark: SparkSession, payloads: DataFrame, warehouse: Warehouse,
                        started_at: str | None = None, secrets: Sequence[str] = (),
                        run_key: str | None = None) -> DataFrame:
    """Ingest macro payloads (payload_id, series_id, indicator_name, payload, landing_order)."""
    return _execute(spark, macro_run_plan, payloads, warehouse, "raw_macro_indicators", AU.MACRO_PIPELINE,
                    started_at, secrets, run_key)
