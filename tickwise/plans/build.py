"""The model build and the whole pipeline run.

``build_models`` materialises the marts: M1 is written once and read back by
M2 and M3 (the shared intermediate is a written table, not recomputed and
not a local checkpoint), and all three are published by one commit, so a reader
has the old marts or the new ones.  ``run_daily_build`` mirrors the stage order of the
original runner: stock ingestion, macro ingestion, then the build only if no
entity failed; a failed data test fails the build.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators import quality as Q
from tickwise.operators.staging import stg_macro_indicators, stg_stock_prices
from tickwise.plans import marts
from tickwise.plans.ingest import ATTEMPTS, run_macro_ingestion, run_stock_ingestion
from tickwise.sources import sinks
from tickwise.sources.warehouse import ConcurrentCommit, Warehouse


class BuildFailed(RuntimeError):
    """Some of the data tests found rows; ``checks`` names them with their counts."""

    def __init__(self, checks: dict[str, int]):
        super().__init__("Data tests failed: " + ", ".join(f"{k} ({n})" for k, n in sorted(checks.items())))
        self.checks = checks


def build_models(spark: SparkSession, raw_stock: DataFrame, raw_macro: DataFrame,
                 warehouse: Warehouse, updated_at: Column | None = None,
                 logs: DataFrame | None = None) -> DataFrame:
    """Staging views → three mart tables → the 28 data tests (returned as a frame)."""
    stamp = updated_at if updated_at is not None else F.current_timestamp()
    stg_stock = stg_stock_prices(raw_stock)
    stg_macro = stg_macro_indicators(raw_macro)
    stg_stock.createOrReplaceTempView("stg_stock_prices")
    stg_macro.createOrReplaceTempView("stg_macro_indicators")
    state, attempt, folders, seen = warehouse.state(spark), uuid.uuid4().hex, {}, {}

    def written(name: str, df: DataFrame, order: list[str]) -> DataFrame:
        folders[name] = warehouse.mart_folder(state, name, attempt)
        checked, seen[name] = Q.watched(df, name)
        sinks.write_mart(checked, folders[name], order)
        return spark.read.schema(df.schema).parquet(folders[name])

    portfolio = written("mart_portfolio", marts.mart_portfolio(stg_stock, stamp), ["ticker", "trade_date"])
    models = {
        "stg_stock_prices": stg_stock,
        "stg_macro_indicators": stg_macro,
        "mart_portfolio": portfolio,
        "mart_risk": written("mart_risk", marts.mart_risk(portfolio, stamp), ["ticker", "trade_date"]),
        "mart_macro_correlation": written(
            "mart_macro_correlation", marts.mart_macro_correlation(portfolio, stg_macro, stamp),
            ["ticker", "indicator_name", "trade_date"]),
    }
    publish_marts(spark, warehouse, folders, attempt)
    return Q.dq_report(models, warehouse.logs(spark) if logs is None else logs, seen)


def publish_marts(spark: SparkSession, warehouse: Warehouse, folders: dict[str, str], attempt: str) -> None:
    """Make written marts the current ones, all at once.  A commit in between changes no mart's
    folder that this build wrote, so the record is made again on the newer state."""
    for left in reversed(range(ATTEMPTS)):
        try:
            return warehouse.commit_marts(spark, warehouse.state(spark), f"build-{attempt}", folders, attempt)
        except ConcurrentCommit:
            if not left:
                raise


def failed_checks(report: DataFrame) -> dict[str, int]:
    """The failed rows of a ``dq_report`` (28 rows at most)."""
    return {r["check_name"]: r["failures"] for r in report.where("NOT passed").collect()}


def run_daily_build(spark: SparkSession, stock_payloads: DataFrame | None,
                    macro_payloads: DataFrame | None, warehouse: Warehouse,
                    started_at: str | None = None) -> dict:
    """Ingest (stock, then macro), then build the models unless an entity failed.

    Returns the audit rows, the report and ``failed``; raises ``BuildFailed`` when a data test
    finds rows, after the marts and the audit rows are written, as the original's build does.
    """
    failed = False
    summary: dict = {}
    for name, payloads, run in (("stock", stock_payloads, run_stock_ingestion),
                                ("macro", macro_payloads, run_macro_ingestion)):
        if payloads is not None:
            audit = run(spark, payloads, warehouse, started_at)
            summary[name] = audit
            failed |= audit.where(F.col("status") == "FAILED").limit(1).count() > 0
    summary["ingestion_failed"] = summary["failed"] = failed
    if not failed:
        state = warehouse.state(spark)
        report = sinks.stage(spark, build_models(
            spark, warehouse.read(spark, "raw_stock_prices", state=state),
            warehouse.read(spark, "raw_macro_indicators", state=state), warehouse), "dq")
        summary["dq"] = report
        if checks := failed_checks(report):
            raise BuildFailed(checks)
    return summary
