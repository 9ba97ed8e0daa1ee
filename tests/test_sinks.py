import datetime as dt
import glob
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickwise.plans.ingest import run_stock_ingestion
from tickwise.sources import sinks
from tickwise.sources.tables import PIPELINE_LOG_SCHEMA, RAW_STOCK_SCHEMA
from tickwise.sources.warehouse import ConcurrentCommit, Warehouse

T0 = dt.datetime(2026, 1, 1)


def test_audit_table_created_once_and_appends_typed_rows(spark, scratch):
    path = os.path.join(scratch, "logs")
    sinks.ensure_audit_table(spark, path)
    sinks.ensure_audit_table(spark, path)          # idempotent, never drops
    assert sinks.read_pipeline_logs(spark, path).count() == 0
    row = spark.createDataFrame([(
        "r1", "2026-01-01 00:00:00", "2026-01-01 00:00:01", "STOCK_INGESTION", "AAPL",
        1, 1, 1, 0, 0, 0, "SUCCESS", 1000, None, None)],
        "run_id string, run_timestamp string, completed_at string, pipeline_name string, "
        "entity_name string, rows_fetched int, rows_valid int, rows_inserted int, "
        "rows_updated int, rows_unchanged int, rows_dropped int, status string, "
        "duration_ms int, error_code string, error_message string")
    sinks.append_pipeline_log(spark, row, path)
    sinks.append_pipeline_log(spark, row, path)
    logs = sinks.read_pipeline_logs(spark, path)
    assert logs.count() == 2
    assert logs.schema.simpleString() == PIPELINE_LOG_SCHEMA.simpleString()


def _bars(spark, *bars):
    return spark.createDataFrame(
        [("A", dt.date.fromisoformat(d), *[Decimal("1")] * 3, Decimal(str(c)), Decimal(10), T0) for d, c in bars],
        RAW_STOCK_SCHEMA)


def _log(spark, n):
    return spark.createDataFrame([(f"r{n}", T0, T0, "STOCK_INGESTION", "A", 1, 1, 1, 0, 0, 0, "SUCCESS", 5, None, None)],
                                 PIPELINE_LOG_SCHEMA)


def _commit(spark, wh, n, *bars):
    wh.commit(spark, wh.state(spark), f"run{n}", "raw_stock_prices", _bars(spark, *bars), _log(spark, n))


def _closes(spark, wh):
    return sorted((str(r.trade_date), float(r.close_price)) for r in wh.read(spark, "raw_stock_prices").collect())


def test_commit_replaces_only_touched_months(spark, scratch):
    wh = Warehouse(scratch)
    assert wh.read(spark, "raw_stock_prices").count() == 0 and wh.logs(spark).count() == 0
    _commit(spark, wh, 1, ("2026-01-05", 1.5), ("2026-02-05", 1.5))
    _commit(spark, wh, 2, ("2026-02-05", 1.8), ("2026-02-06", 1.9))
    assert _closes(spark, wh) == [("2026-01-05", 1.5), ("2026-02-05", 1.8), ("2026-02-06", 1.9)]
    assert sorted(r.run_id for r in wh.logs(spark).collect()) == ["r1", "r2"]
    # a read of some months opens only their files
    files = wh.read(spark, "raw_stock_prices", ["2026-02"]).inputFiles()
    assert files and all("month=2026-02" in f and "/000000000002-" in f for f in files)


def test_file_count_follows_months(spark, scratch):
    wh = Warehouse(scratch)
    days = [(str(dt.date(2026, 1, 1) + dt.timedelta(days=i)), 1.0) for i in range(120)]
    rows = _bars(spark, *days).repartition(16)
    wh.commit(spark, wh.state(spark), "run", "raw_stock_prices", rows, _log(spark, 1))
    assert len(wh.read(spark, "raw_stock_prices").inputFiles()) == 4


def test_crash_between_the_writes_leaves_nothing(spark, scratch, monkeypatch):
    wh = Warehouse(scratch)
    _commit(spark, wh, 1, ("2026-01-05", 1.5))
    monkeypatch.setattr(sinks, "typed_log", lambda rows: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _commit(spark, wh, 2, ("2026-01-05", 9.0))
    monkeypatch.undo()
    assert _closes(spark, wh) == [("2026-01-05", 1.5)] and wh.logs(spark).count() == 1
    _commit(spark, wh, 2, ("2026-01-05", 2.0))
    assert _closes(spark, wh) == [("2026-01-05", 2.0)] and wh.logs(spark).count() == 2


def test_two_runs_cannot_follow_one_state(spark, scratch):
    wh = Warehouse(scratch)
    state = wh.state(spark)
    _commit(spark, wh, 1, ("2026-01-05", 1.5))
    with pytest.raises(ConcurrentCommit):
        wh.commit(spark, state, "late", "raw_stock_prices", _bars(spark, ("2026-01-05", 7.0)), _log(spark, 2))
    assert _closes(spark, wh) == [("2026-01-05", 1.5)]


def test_unreadable_file_raises_and_changes_nothing(spark, scratch):
    wh = Warehouse(scratch)
    bar = '{"Time Series (Daily)": {"%s": {"1. open": "3", "2. high": "4", "3. low": "2", "4. close": "3", "5. volume": "8"}}}'
    pay = lambda day: spark.createDataFrame([("p", "A", bar % day)], "payload_id string, ticker string, payload string")
    run_stock_ingestion(spark, pay("2026-01-05"), wh)
    run_stock_ingestion(spark, pay("2026-02-05"), wh)
    for name in glob.glob(f"{scratch}/data/raw_stock_prices/000000000001-*/month=2026-01/*.parquet"):
        with open(name, "wb") as fh:
            fh.write(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        run_stock_ingestion(spark, pay("2026-01-06"), wh)
    assert wh.state(spark).version == 2 and wh.logs(spark).count() == 2
    run_stock_ingestion(spark, pay("2026-02-06"), wh)       # other months do not open that file
    assert wh.read(spark, "raw_stock_prices", ["2026-02"]).count() == 2
    with pytest.raises(Exception, match="(?i)parquet"):
        wh.read(spark, "raw_stock_prices", ["2026-01"]).collect()


def test_write_mart_sorts_within_files(spark, scratch):
    path = os.path.join(scratch, "mart")
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("ticker"),
                                  (1000 - F.col("id")).alias("trade_date")).repartition(2)
    sinks.write_mart(df, path, ["ticker", "trade_date"])
    back = spark.read.parquet(path)
    assert back.count() == 1000


def test_stage_cuts_lineage_into_checkpoint_folder(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    staged = sinks.stage(spark, df, "probe")
    plan = staged._jdf.queryExecution().analyzed().toString()
    assert "Relation" in plan and "Range" not in plan
    assert staged.agg(F.sum("x")).collect()[0][0] == 90


def _payload(spark, day, close):
    bar = ('{"Time Series (Daily)": {"%s": {"1. open": "3", "2. high": "9", "3. low": "2", "4. close": "%s", '
           '"5. volume": "8"}}}' % (day, close))
    return spark.createDataFrame([(f"p-{day}-{close}", "A", bar)], "payload_id string, ticker string, payload string")


def test_a_refused_commit_leaves_the_other_runs_rows(spark, scratch, monkeypatch):
    """B reads the state, A commits, B goes on: B is refused, merges again, and both are there."""
    wh = Warehouse(scratch)
    run_stock_ingestion(spark, _payload(spark, "2026-01-05", 3), wh)
    commit, seen = Warehouse.commit, []

    def interleaved(self, spark, state, run_key, table, rows, log):
        if run_key == "B" and not seen:
            seen.append("A")
            run_stock_ingestion(spark, _payload(spark, "2026-01-06", 4), wh, run_key="A")
            with pytest.raises(ConcurrentCommit):
                commit(self, spark, state, run_key, table, rows, log)
            # what A committed is what readers see, rows and log
            assert _closes(spark, wh) == [("2026-01-05", 3.0), ("2026-01-06", 4.0)]
            assert wh.logs(spark).count() == 2
            raise ConcurrentCommit("refused")
        commit(self, spark, state, run_key, table, rows, log)

    monkeypatch.setattr(Warehouse, "commit", interleaved)
    audit = run_stock_ingestion(spark, _payload(spark, "2026-01-06", 5), wh, run_key="B").collect()
    # B met A's row, so it updated it
    assert [(r.rows_inserted, r.rows_updated) for r in audit] == [(0, 1)]
    assert _closes(spark, wh) == [("2026-01-05", 3.0), ("2026-01-06", 5.0)]
    assert wh.state(spark).version == 3 and wh.logs(spark).count() == 3
    again = run_stock_ingestion(spark, _payload(spark, "2026-01-06", 5), wh, run_key="B")
    assert again.count() == 1 and wh.state(spark).version == 3


def test_rename_to_a_taken_name_fails(spark, scratch):
    for name in ("a", "b"):
        spark.range(1).write.parquet(os.path.join(scratch, name))
    target = os.path.join(scratch, "to", "here")
    assert sinks.rename_if_absent(spark, os.path.join(scratch, "a"), target)
    assert not sinks.rename_if_absent(spark, os.path.join(scratch, "b"), target)
    assert spark.read.parquet(target).count() == 1
    assert sinks.folder_names(spark, os.path.join(scratch, "to")) == ["here"]
    assert sinks.folder_names(spark, os.path.join(scratch, "nowhere")) == []


def test_marts_are_published_together(spark, scratch):
    """A reader that began before a publication keeps its files; a later one has the new ones."""
    from tickwise.plans.build import publish_marts
    wh = Warehouse(scratch)
    for n in (3, 5):
        state = wh.state(spark)
        folders = {m: wh.mart_folder(state, m, f"try{n}") for m in ("mart_portfolio", "mart_risk")}
        for path in folders.values():
            sinks.write_mart(spark.range(n).select(F.col("id").alias("ticker")), path, ["ticker"])
        if n == 5:
            before = wh.read_mart(spark, "mart_portfolio")
            assert before.count() == 3
            _commit(spark, wh, 9, ("2026-01-05", 1.5))      # another run commits in between
        publish_marts(spark, wh, folders, f"try{n}")
    assert before.count() == 3
    assert {m: wh.read_mart(spark, m).count() for m in folders} == {"mart_portfolio": 5, "mart_risk": 5}
    assert _closes(spark, wh) == [("2026-01-05", 1.5)] and wh.logs(spark).count() == 1


def test_mart_files_prune_a_ticker(spark, scratch):
    path = os.path.join(scratch, "ranged")
    df = spark.range(4000).select(F.concat(F.lit("T"), (F.col("id") % 40 + 10).cast("string")).alias("ticker"),
                                  F.col("id").alias("trade_date"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_mart(df, path, ["ticker", "trade_date"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("ticker"), F.max("ticker")).collect()
    hit = [f for f in files if f[1] <= "T20" <= f[2]]
    assert len(files) > 2 and len(hit) <= 2


def test_clear_run_removes_a_runs_staged_tables(spark):
    kept = sinks.stage(spark, spark.range(3), "t", "run-kept")
    sinks.stage(spark, spark.range(3), "t", "run-done")
    assert sinks.clear_run(spark, "run-done") and not sinks.clear_run(spark, "run-done")
    assert kept.count() == 3
