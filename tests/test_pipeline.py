"""End-to-end: ingest landed payloads into a warehouse, rebuild, rerun, stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tickwise.operators import upsert as U
from tickwise.plans.build import BuildFailed, build_models, run_daily_build
from tickwise.plans.ingest import run_macro_ingestion, run_stock_ingestion
from tickwise.sources import fixtures
from tickwise.sources import payloads as P
from tickwise.sources.warehouse import Warehouse
from tickwise.streaming.landing import start_landing_stream

from .conftest import SMOKE_SF


def _usable(payloads, classify, key):
    good = classify(payloads).where("error_code IS NULL").select("payload_id")
    return payloads.join(good, "payload_id", "left_semi").where(~F.col("payload_id").rlike(":(huge|ticker)$"))


def test_ingest_then_rerun_is_no_changes(spark, scratch):
    wh = Warehouse(scratch)
    payloads = fixtures.stock_payloads(spark, SMOKE_SF).where(F.col("ticker").isin("S1", "S2", fixtures.BAD_TICKER))
    first = run_stock_ingestion(spark, payloads, wh)
    rows = first.collect()
    statuses = {r.status for r in rows}
    assert "FAILED" in statuses and ({"SUCCESS", "PARTIAL_SUCCESS"} & statuses)
    bad = [r for r in rows if r.entity_name == fixtures.BAD_TICKER.upper()]
    assert bad and {(r.status, r.error_code, r.rows_fetched) for r in bad} == {("FAILED", "NORMALIZATION_ERROR", 0)}
    inserted = sum(r.rows_inserted for r in rows)
    snap = wh.read(spark, "raw_stock_prices")
    assert snap.count() == inserted == snap.select(*U.STOCK_KEY).distinct().count()
    # the bar of extreme numbers is loaded with the others
    assert {r.volume for r in snap.where("trade_date = '2099-01-01'").collect()} == {10 ** 30}
    second = run_stock_ingestion(spark, payloads, wh)
    for r in second.where("status <> 'FAILED'").collect():
        assert r.rows_inserted == 0 and r.rows_updated == 0
        assert r.status in ("NO_CHANGES", "NO_VALID_ROWS")
    assert sorted(wh.read(spark, "raw_stock_prices").collect()) == sorted(snap.collect())
    logs = wh.logs(spark)
    assert logs.count() == 2 * len(rows) == logs.select("run_id").distinct().count()
    assert logs.where("duration_ms = 0").count() == 0


@pytest.mark.parametrize("kind", ["stock", "macro"])
def test_overlapping_payloads_update_each_other(spark, scratch, kind):
    wh = Warehouse(scratch)
    payloads, run, table, key = (
        (fixtures.overlapping_stock_payloads(spark, SMOKE_SF).where("ticker = 'S1'"), run_stock_ingestion,
         "raw_stock_prices", U.STOCK_KEY) if kind == "stock" else
        (fixtures.overlapping_macro_payloads(spark, SMOKE_SF), run_macro_ingestion, "raw_macro_indicators",
         U.MACRO_KEY))
    first = run(spark, payloads, wh).agg(F.sum("rows_inserted"), F.sum("rows_updated")).first()
    snap = wh.read(spark, table)
    assert first[1] > 0 and snap.count() == first[0] == snap.select(*key).distinct().count()
    # the last payload of each entity finds its rows as it left them
    last = payloads.where("landing_order = 2")
    again = run(spark, last, wh).collect()
    assert {r.status for r in again} <= {"NO_CHANGES", "NO_VALID_ROWS"}
    assert sorted(wh.read(spark, table).collect()) == sorted(snap.collect())


def test_identical_rerun_of_one_fetch_is_no_changes(spark, scratch):
    wh = Warehouse(scratch)
    payloads = fixtures.overlapping_macro_payloads(spark, SMOKE_SF).where("landing_order = 1")
    run_macro_ingestion(spark, payloads, wh)
    again = run_macro_ingestion(spark, payloads, wh)
    assert {r.status for r in again.collect()} == {"NO_CHANGES"}
    assert {r.entity_name for r in again.collect()} == set(fixtures.SERIES_NAMES.values())


def test_full_pipeline_builds_models_and_gates(spark, scratch):
    wh = Warehouse(scratch)
    stock = _usable(fixtures.stock_payloads(spark, SMOKE_SF), P.classify_stock_payloads, "ticker")
    macro = _usable(fixtures.macro_payloads(spark, SMOKE_SF), P.classify_macro_payloads, "series_id")
    summary = run_daily_build(spark, stock, macro, wh)
    assert summary["ingestion_failed"] is False and summary["failed"] is False
    dq = {r.check_name: r.passed for r in summary["dq"].collect()}
    assert len(dq) == 28 and all(dq.values())
    for name in ("mart_portfolio", "mart_risk", "mart_macro_correlation"):
        assert wh.read_mart(spark, name).count() > 0
    # an unknown indicator is a failed data test: the build fails
    other = macro.where("series_id = 'GDP'").withColumn("indicator_name", F.lit("Something Else"))
    with pytest.raises(BuildFailed, match="accepted_values"):
        run_daily_build(spark, None, other, wh)


def test_build_models_from_fixtures(spark, scratch):
    wh = Warehouse(scratch)
    dq = build_models(spark, fixtures.raw_stock_prices(spark, SMOKE_SF),
                      fixtures.raw_macro_indicators(spark, SMOKE_SF), wh,
                      logs=fixtures.pipeline_logs(spark, SMOKE_SF))
    got = {r.check_name: r.failures for r in dq.collect()}
    assert got["assert_pipeline_log_status"] > 0 and got["not_null_mart_portfolio_ticker"] == 0
    port = wh.read_mart(spark, "mart_portfolio")
    assert port.count() == fixtures.raw_stock_prices(spark, SMOKE_SF).where(
        "close_price IS NOT NULL AND volume > 0").select("ticker", "trade_date").distinct().count()


def test_landing_stream_drives_ingestion(spark, scratch):
    wh = Warehouse(os.path.join(scratch, "wh"))
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    rows = fixtures.stock_payloads(spark, SMOKE_SF).where(F.col("ticker") == "S3").collect()
    with open(os.path.join(landing, "batch-0001.json"), "w") as fh:
        for r in rows:
            fh.write(json.dumps(r.asDict()) + "\n")
    q = start_landing_stream(spark, landing, wh, os.path.join(scratch, "stream-ckpt"))
    q.awaitTermination(300)
    logs = wh.logs(spark)
    assert logs.count() == len(rows)
    snap = wh.read(spark, "raw_stock_prices")
    assert snap.count() > 0
    # a batch that is replayed after its commit is not run again
    key = spark.read.parquet(wh.path("commits", "*")).first()["run_key"]
    replay = run_stock_ingestion(spark, fixtures.stock_payloads(spark, SMOKE_SF).limit(0), wh, run_key=key)
    assert replay.count() == len(rows) and wh.logs(spark).count() == len(rows)
