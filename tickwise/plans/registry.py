"""The query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every entry reads the supplied tables (through ``tickwise.sources.fixtures``)
and runs over them whole.  ``updated_at`` and other clock values are fixed
parameters so results can be compared with the oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators import normalize as N
from tickwise.operators.staging import stg_macro_indicators, stg_stock_prices
from tickwise.plans import marts
from tickwise.plans.oracle import AS_OF
import uuid

from tickwise.sources import sinks
from tickwise.plans.ingest import macro_run_plan, stock_run_plan
from tickwise.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def _stg_stock(spark, sf):
    return stg_stock_prices(fixtures.raw_stock_prices(spark, sf))


def _stg_macro(spark, sf):
    return stg_macro_indicators(fixtures.raw_macro_indicators(spark, sf))


def _portfolio(spark, sf):
    return marts.mart_portfolio(_stg_stock(spark, sf), updated_at=as_of())


QUERIES: dict[str, Query] = {
    "stg_stock_prices": _stg_stock,
    "stg_macro_indicators": _stg_macro,
    "mart_portfolio": _portfolio,
    "mart_risk": lambda spark, sf: marts.mart_risk(_portfolio(spark, sf), updated_at=as_of()),
    "mart_macro_correlation": lambda spark, sf: marts.mart_macro_correlation(
        _portfolio(spark, sf), _stg_macro(spark, sf), updated_at=as_of()),
}


def _plain(df: DataFrame) -> DataFrame:
    """RAW decimals as results show them: prices and values as doubles, volumes as text."""
    return df.select(*[F.col(f.name).cast("string" if f.name == "volume" else "double").alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema.fields])


def _stock_norm(spark, sf):
    return N.stock_normalization(fixtures.dirty_stock_batch(spark, sf))


def _macro_norm(spark, sf):
    return N.macro_normalization(fixtures.dirty_macro_batch(spark, sf))


QUERIES.update({
    "normalize_stock_rows": lambda spark, sf: _plain(_stock_norm(spark, sf)[0]),
    "rejected_stock_rows": lambda spark, sf: _stock_norm(spark, sf)[1].select("_input_order", "reason"),
    "stock_normalization_metrics": lambda spark, sf: N.stock_batch_metrics(
        fixtures.dirty_stock_batch(spark, sf)),
    "stock_reason_counts": lambda spark, sf: N.reason_counts(_stock_norm(spark, sf)[1]),
    "normalize_macro_rows": lambda spark, sf: _plain(_macro_norm(spark, sf)[0]),
    "rejected_macro_rows": lambda spark, sf: _macro_norm(spark, sf)[1].select("_input_order", "reason"),
    "macro_normalization_metrics": lambda spark, sf: N.macro_batch_metrics(
        fixtures.dirty_macro_batch(spark, sf)),
})


from tickwise.sources import payloads as P  # noqa: E402


def _ingest_stock(spark, sf):
    rows = P.parse_stock_payloads(fixtures.stock_payloads(spark, sf))
    return _plain(N.normalize_stock_rows(rows, batch_cols=["payload_id"]))


def _ingest_macro(spark, sf):
    rows = P.parse_macro_payloads(fixtures.macro_payloads(spark, sf))
    return _plain(N.normalize_macro_rows(rows, batch_cols=["payload_id"]))


QUERIES.update({
    "classify_stock_payloads": lambda spark, sf: P.classify_stock_payloads(
        fixtures.stock_payloads(spark, sf)),
    "parse_stock_payloads": lambda spark, sf: P.parse_stock_payloads(
        fixtures.stock_payloads(spark, sf)),
    "ingest_stock_payloads": _ingest_stock,
    "classify_macro_payloads": lambda spark, sf: P.classify_macro_payloads(
        fixtures.macro_payloads(spark, sf)),
    "parse_macro_payloads": lambda spark, sf: P.parse_macro_payloads(
        fixtures.macro_payloads(spark, sf)),
    "ingest_macro_payloads": _ingest_macro,
    "latest_observations": lambda spark, sf: P.latest_observations(
        _stg_macro(spark, sf), key="indicator_name"),
})


from tickwise.operators import audit as AU  # noqa: E402
from tickwise.operators import quality as Q  # noqa: E402
from tickwise.operators import reads as RD  # noqa: E402
from tickwise.operators import upsert as U  # noqa: E402
from tickwise.plans.oracle import (  # noqa: E402
    FOCUS_INDICATOR, MA_TICKER, RUN_COMPLETED, RUN_KEY, RUN_STARTED)


def _risk(spark, sf):
    return marts.mart_risk(_portfolio(spark, sf), updated_at=as_of())


def _correlation(spark, sf):
    return marts.mart_macro_correlation(_portfolio(spark, sf), _stg_macro(spark, sf),
                                        updated_at=as_of())


def _returns_joined(spark, sf):
    p = _portfolio(spark, sf).select("ticker", "trade_date", "daily_return_pct").where(
        F.col("daily_return_pct").isNotNull())
    from tickwise.operators.joins import stock_macro_join
    j = stock_macro_join(p, marts.macro_changes(_stg_macro(spark, sf)))
    return j.select("ticker", "trade_date", "daily_return_pct", "indicator_name",
                    F.col("value").alias("indicator_value"), "indicator_change_pct")


def _merged_stock(spark, sf):
    return U.upsert_stock_prices(fixtures.upsert_stock_target(spark, sf),
                                 fixtures.upsert_stock_source(spark, sf))


def _stager(spark):
    """Stage frames as tables in the checkpoint folder (one computation each, lineage cut)."""
    key = f"registry-{uuid.uuid4().hex}"
    return lambda df, name: sinks.stage(spark, df, name, key)


def _stock_run_plan(spark, sf):
    """One stock ingestion run over the landed payloads against yesterday's snapshot.

    The landed payloads and the per-row reasons feed several branches
    (classification, metrics, merge), so each is written once to the
    checkpoint folder instead of being recomputed per branch.
    """
    stage = _stager(spark)
    payloads = stage(fixtures.stock_payloads(spark, sf), "payloads")
    return stock_run_plan(payloads, fixtures.upsert_stock_target(spark, sf), RUN_STARTED, stage)


def _stock_run(spark, sf):
    return _stock_run_plan(spark, sf).audit(AU.STOCK_PIPELINE, RUN_STARTED, RUN_COMPLETED, RUN_KEY)


def _macro_run(spark, sf):
    """One macro ingestion run over the landed macro payloads against yesterday's snapshot."""
    stage = _stager(spark)
    payloads = stage(fixtures.macro_payloads(spark, sf), "payloads")
    plan = macro_run_plan(payloads, fixtures.upsert_macro_target(spark, sf), RUN_STARTED, stage)
    return plan.audit(AU.MACRO_PIPELINE, RUN_STARTED, RUN_COMPLETED, RUN_KEY)


def _overlapping_stock(spark, sf):
    """A run whose payloads overlap: each is merged into what the earlier ones left."""
    stage = _stager(spark)
    payloads = stage(fixtures.overlapping_stock_payloads(spark, sf), "payloads")
    return stock_run_plan(payloads, fixtures.upsert_stock_target(spark, sf), RUN_STARTED, stage)


def _overlapping_macro(spark, sf):
    stage = _stager(spark)
    payloads = stage(fixtures.overlapping_macro_payloads(spark, sf), "payloads")
    return macro_run_plan(payloads, fixtures.upsert_macro_target(spark, sf), RUN_STARTED, stage)


def _statuses(plan):
    """Per payload its merge counts and the status they give."""
    counts = U.merge_counts(plan.merged, ["payload_id"])
    j = plan.batches.join(plan.metrics, "payload_id", "left").join(counts, "payload_id", "left")
    z = F.lit(0).cast("bigint")
    n = {c: F.coalesce(c, z) for c in ("rows_valid", "rows_inserted", "rows_updated", "rows_unchanged",
                                       "rows_dropped")}
    return j.select("payload_id", *[v.alias(c) for c, v in n.items()], AU.run_status(
        n["rows_valid"], n["rows_inserted"], n["rows_updated"], n["rows_dropped"],
        F.col("error_code")).alias("status"))


def _stock_run_status(spark, sf):
    """U2 on its own: the status each payload's counts give (payload id, status)."""
    return _statuses(_stock_run_plan(spark, sf)).select("payload_id", "status")


def _logs(spark, sf):
    return fixtures.pipeline_logs(spark, sf)


def _dq_stock(spark, sf):
    return stg_stock_prices(fixtures.raw_stock_prices_with_faults(spark, sf))


def _dq_macro(spark, sf):
    return stg_macro_indicators(fixtures.raw_macro_indicators_with_faults(spark, sf))


def _dq_models(spark, sf):
    """Staging and marts over the fault-planted RAW tables, and the row checks counted while the
    shared models were written to the checkpoint folder, as the build writes its marts."""
    stage, seen = _stager(spark), {}

    def written(name, df):
        checked, seen[name] = Q.watched(df, name)
        return stage(checked, name)

    stg_s = written("stg_stock_prices", _dq_stock(spark, sf))
    stg_m = written("stg_macro_indicators", _dq_macro(spark, sf))
    port = written("mart_portfolio", marts.mart_portfolio(stg_s, updated_at=as_of()))
    return {
        "stg_stock_prices": stg_s,
        "stg_macro_indicators": stg_m,
        "mart_portfolio": port,
        "mart_risk": marts.mart_risk(port, updated_at=as_of()),
        "mart_macro_correlation": marts.mart_macro_correlation(port, stg_m, updated_at=as_of()),
    }, seen


def _dq_report(spark, sf):
    models, seen = _dq_models(spark, sf)
    return Q.dq_report(models, _logs(spark, sf), seen)


def _dq_not_null(spark, sf):
    models, _ = _dq_models(spark, sf)
    return reduce(DataFrame.unionByName, [Q.dq_not_null(models[name], name) for name in Q.NOT_NULL])


def _summary(spark, sf):
    return RD.portfolio_summary(_portfolio(spark, sf))


QUERIES.update({
    # single metrics (each inventory row checked on its own)
    "daily_returns": lambda spark, sf: _portfolio(spark, sf).select(
        "ticker", "trade_date", "close_price", "prev_close_price", "daily_return_pct"),
    "moving_averages": lambda spark, sf: _portfolio(spark, sf).select(
        "ticker", "trade_date", "ma_20day", "ma_50day"),
    "rolling_volatility": lambda spark, sf: _portfolio(spark, sf).select(
        "ticker", "trade_date", "rolling_volatility_20d"),
    "drawdown": lambda spark, sf: _portfolio(spark, sf).select(
        "ticker", "trade_date", "cumulative_return_pct", "running_peak", "drawdown_pct"),
    "risk_metrics": lambda spark, sf: _risk(spark, sf).select(
        "ticker", "trade_date", "sharpe_ratio_20d", "max_drawdown_pct", "var_95_pct",
        "avg_volume_20d"),
    "macro_changes": lambda spark, sf: marts.macro_changes(_stg_macro(spark, sf)),
    "stock_macro_join": _returns_joined,
    # upsert and run accounting
    "upsert_stock_prices": _merged_stock,
    "upsert_macro_indicators": lambda spark, sf: U.upsert_macro_indicators(
        fixtures.upsert_macro_target(spark, sf), fixtures.upsert_macro_source(spark, sf)),
    "merge_counts": lambda spark, sf: U.merge_counts(_merged_stock(spark, sf), ["ticker"]),
    "run_log": _stock_run,
    "macro_run_log": _macro_run,
    "run_status": lambda spark, sf: _stock_run_status(spark, sf),
    "ingest_overlapping_stock": lambda spark, sf: _statuses(_overlapping_stock(spark, sf)),
    "ingest_overlapping_macro": lambda spark, sf: _statuses(_overlapping_macro(spark, sf)),
    "overlapping_stock_snapshot": lambda spark, sf: _plain(_overlapping_stock(spark, sf).snapshot()),
    "overlapping_macro_snapshot": lambda spark, sf: _plain(_overlapping_macro(spark, sf).snapshot()),
    "run_log_violations": lambda spark, sf: AU.run_log_violations(_logs(spark, sf)),
    "redact_messages": lambda spark, sf: AU.redact_messages(
        _logs(spark, sf), secrets=[fixtures.PLANTED_SECRET]),
    "run_summary": lambda spark, sf: AU.run_summary(_logs(spark, sf)),
    # data quality
    "dq_not_null": _dq_not_null,
    "dq_accepted_values": lambda spark, sf: Q.dq_accepted_values(_dq_macro(spark, sf)),
    "dq_unique_stock_key": lambda spark, sf: Q.dq_unique_stock_key(_dq_stock(spark, sf)),
    "dq_unique_macro_key": lambda spark, sf: Q.dq_unique_macro_key(_dq_macro(spark, sf)),
    "dq_valid_ohlcv": lambda spark, sf: Q.dq_valid_ohlcv(_dq_stock(spark, sf)),
    "dq_log_counts": lambda spark, sf: Q.dq_log_counts(_logs(spark, sf)),
    "dq_log_status": lambda spark, sf: Q.dq_log_status(_logs(spark, sf)),
    "dq_report": _dq_report,
    "source_freshness": lambda spark, sf: Q.source_freshness(
        fixtures.raw_stock_prices(spark, sf), as_of()),
    # dashboard reads
    "portfolio_summary": _summary,
    "portfolio_extremes": lambda spark, sf: RD.portfolio_extremes(_summary(spark, sf)),
    "ticker_list": lambda spark, sf: RD.ticker_list(_portfolio(spark, sf)),
    "indicator_list": lambda spark, sf: RD.indicator_list(_correlation(spark, sf)),
    "indicator_coverage": lambda spark, sf: RD.indicator_coverage(_correlation(spark, sf)),
    "failed_recent": lambda spark, sf: RD.failed_recent(_logs(spark, sf), as_of()),
    "recent_runs": lambda spark, sf: RD.recent_runs(_logs(spark, sf)),
    "recent_run_totals": lambda spark, sf: RD.recent_run_totals(_logs(spark, sf)),
    "latest_stock_run": lambda spark, sf: RD.latest_stock_run(_logs(spark, sf)),
    "latest_macro_run": lambda spark, sf: RD.latest_macro_run(_logs(spark, sf)),
    "price_history": lambda spark, sf: RD.price_history(_portfolio(spark, sf)),
    "moving_average_series": lambda spark, sf: RD.moving_average_series(
        _portfolio(spark, sf), MA_TICKER),
    "risk_series": lambda spark, sf: RD.risk_series(_risk(spark, sf)),
    "macro_series": lambda spark, sf: RD.macro_series(
        _correlation(spark, sf), indicator=FOCUS_INDICATOR),
    "latest_indicator_values": lambda spark, sf: RD.latest_indicator_values(
        _correlation(spark, sf), FOCUS_INDICATOR),
})


# -- tables that are written and read back, selections, refreshed marts -----------------------

from tickwise.plans import incremental as I  # noqa: E402
from tickwise.plans.build import publish_marts  # noqa: E402
from tickwise.plans.ingest import run_stock_ingestion  # noqa: E402
from tickwise.session import checkpoint_dir  # noqa: E402
from tickwise.sources.tables import PIPELINE_LOG_SCHEMA, RAW_STOCK_SCHEMA  # noqa: E402
from tickwise.sources.warehouse import ConcurrentCommit, Warehouse  # noqa: E402


def _new_name(kind: str) -> str:
    return f"tickwise_{kind}_{uuid.uuid4().hex}"


def _new_warehouse(spark) -> Warehouse:
    return Warehouse(f"{checkpoint_dir(spark).rstrip('/')}/tickwise/{_new_name('warehouse')}")


def _staging_view(spark, sf):
    name = _new_name("stg_stock_prices")
    _stg_stock(spark, sf).createOrReplaceTempView(name)
    return spark.table(name)


def _audit_log_table(spark, sf):
    """Create the table twice, append the audit rows of one pipeline and then the others."""
    name, logs = _new_name("pipeline_logs"), _logs(spark, sf)
    sinks.create_audit_table(spark, name)
    stock = F.col("pipeline_name") == AU.STOCK_PIPELINE
    sinks.append_audit_rows(spark, logs.where(stock), name)
    sinks.create_audit_table(spark, name)
    sinks.append_audit_rows(spark, logs.where(~stock).select(*reversed(logs.columns)), name)
    return spark.table(name)


def _published_portfolio(spark, sf):
    wh = _new_warehouse(spark)
    folder = wh.mart_folder(wh.state(spark), "mart_portfolio", uuid.uuid4().hex)
    sinks.write_mart(_portfolio(spark, sf), folder, ["ticker", "trade_date"])
    publish_marts(spark, wh, {"mart_portfolio": folder}, uuid.uuid4().hex)
    return wh.read_mart(spark, "mart_portfolio")


def _bucketed_upsert(spark, sf):
    snapshot = sinks.write_bucketed(spark, fixtures.upsert_stock_target(spark, sf), _new_name("snapshot"), U.STOCK_KEY)
    return U.upsert_stock_prices(snapshot, fixtures.upsert_stock_source(spark, sf))


def _first_and_second_load(spark, sf):
    """The marts of the first load, the changes of the second, and the rows to stage again."""
    stage = _stager(spark)
    raw = fixtures.raw_stock_prices(spark, sf, with_source_key=True)
    later = fixtures.lands_later()
    old = stage(marts.mart_portfolio(stg_stock_prices(raw.where(~later)), updated_at=as_of()), "old_portfolio")
    changes = stage(I.first_changes(raw.where(later)), "changes")
    new = I.refresh_portfolio(old, stg_stock_prices(I.rows_since(raw, changes)), changes, as_of())
    return stage, old, changes, new


def _refreshed_risk(spark, sf):
    stage, old, changes, new = _first_and_second_load(spark, sf)
    old_risk = stage(marts.mart_risk(old, updated_at=as_of()), "old_risk")
    return I.refresh_risk(old_risk, stage(new, "portfolio"), changes, as_of())


def _interleaved(spark, sf):
    """Run A commits after B has read the state; B's late commit is refused and B runs again;
    then B is replayed.  The warehouse after that."""
    wh = _new_warehouse(spark)
    no_log = spark.createDataFrame([], PIPELINE_LOG_SCHEMA)
    snapshot = fixtures.upsert_stock_target(spark, sf).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_STOCK_SCHEMA.fields])
    wh.commit(spark, wh.state(spark), "first", "raw_stock_prices", snapshot, no_log)
    payloads = _stager(spark)(fixtures.overlapping_stock_payloads(spark, sf), "payloads")
    first = F.col("landing_order") == 0
    read_by_b = wh.state(spark)
    run_stock_ingestion(spark, payloads.where(first), wh, RUN_STARTED, run_key="A")
    try:
        wh.commit(spark, read_by_b, "B", "raw_stock_prices", snapshot, no_log)
    except ConcurrentCommit:
        pass
    for _ in range(2):
        run_stock_ingestion(spark, payloads.where(~first), wh, RUN_STARTED, run_key="B")
    return wh


def _log_totals(logs):
    names = ("rows_inserted", "rows_updated", "rows_unchanged", "rows_dropped")
    return logs.groupBy("status").agg(F.count(F.lit(1)).alias("runs"), *[F.sum(c).alias(c) for c in names])


def _rerun_totals(spark, sf):
    """The same payloads twice: what the second run's audit rows say."""
    wh = _new_warehouse(spark)
    payloads = _stager(spark)(fixtures.stock_payloads(spark, sf), "payloads")
    run_stock_ingestion(spark, payloads, wh, RUN_STARTED)
    return _log_totals(run_stock_ingestion(spark, payloads, wh, RUN_STARTED))


QUERIES.update({
    "staging_view": _staging_view,
    "audit_log_table": _audit_log_table,
    "published_portfolio": _published_portfolio,
    "bucketed_upsert_stock_prices": _bucketed_upsert,
    "refreshed_mart_portfolio": lambda spark, sf: _first_and_second_load(spark, sf)[3],
    "refreshed_mart_risk": _refreshed_risk,
    "interleaved_stock_snapshot": lambda spark, sf: _plain(_interleaved(spark, sf).read(spark, "raw_stock_prices")),
    "interleaved_stock_log": lambda spark, sf: _log_totals(_interleaved(spark, sf).logs(spark)),
    "rerun_stock_log": _rerun_totals,
    # selections from a table of tickers
    "selected_price_history": lambda spark, sf: RD.price_history(
        _portfolio(spark, sf), fixtures.watch_list(spark, sf)),
    "selected_risk_series": lambda spark, sf: RD.risk_series(_risk(spark, sf), fixtures.watch_list(spark, sf)),
    "selected_macro_series": lambda spark, sf: RD.macro_series(
        _correlation(spark, sf), fixtures.watch_list(spark, sf), FOCUS_INDICATOR),
    "selected_summary": lambda spark, sf: RD.portfolio_summary(_portfolio(spark, sf), fixtures.watch_list(spark, sf)),
    "selected_extremes": lambda spark, sf: RD.portfolio_extremes(
        RD.portfolio_summary(_portfolio(spark, sf), fixtures.watch_list(spark, sf)), fixtures.watch_list(spark, sf)),
    "bound_summary": lambda spark, sf: RD.portfolio_summary_sql(
        spark, _portfolio(spark, sf), [r.ticker for r in fixtures.watch_list(spark, sf).collect()]),
    "empty_selection_summary": lambda spark, sf: RD.portfolio_summary(
        _portfolio(spark, sf), fixtures.watch_list(spark, sf, region="")),
})
