"""Refreshed marts, bucketed merges, observed checks, selections and tables by name."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickwise.operators import quality as Q
from tickwise.operators import reads as RD
from tickwise.operators import upsert as U
from tickwise.plans import incremental as I
from tickwise.plans import marts
from tickwise.plans.registry import QUERIES, _dq_models, _new_name
from tickwise.sources import fixtures, sinks
from tickwise.sources.tables import PIPELINE_LOG_SCHEMA, RAW_STOCK_SCHEMA
from tickwise.sources.warehouse import ConcurrentCommit, Warehouse

from .conftest import SMOKE_SF
from .test_segments import STAGED, T0



def _stamp():
    return F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")


def _staged(spark, rows):
    return spark.createDataFrame([(t, d, c, c, c, c, Decimal(v), T0) for t, d, c, v in rows], STAGED)


def _days(ticker, n, seed, start=dt.date(2020, 1, 1), zeros=()):
    r = random.Random(seed)
    return [(ticker, start + dt.timedelta(days=2 * i), 0.0 if i in zeros else round(r.uniform(1, 90), 2),
             r.randint(1, 10 ** 5)) for i in range(n)]


@pytest.mark.parametrize("change", ["append", "correct", "first day", "new ticker", "after zeros"])
def test_refresh_equals_rebuild(spark, change):
    """State and changed days give the marts that all rows give."""
    zeros = tuple(range(95, 130)) if change == "after zeros" else (3,)
    base = _days("A", 140, 1, zeros=zeros) + _days("B", 80, 2) + _days(None, 20, 3)
    at = {"append": len(base), "correct": 70, "first day": 0, "new ticker": len(base), "after zeros": 135}[change]
    new = list(base)
    if change == "append":
        batch = _days("A", 5, 4, start=dt.date(2021, 6, 1)) + _days("B", 60, 5, start=dt.date(2021, 6, 1))
        new += batch
    elif change == "new ticker":
        batch = _days("C", 30, 6)
        new += batch
    else:
        t, d, c, v = base[at]
        batch = [(t, d, c + 50.0, v + 1)]
        new[at] = batch[0]
    old_p = marts.mart_portfolio(_staged(spark, base), _stamp())
    old_p = spark.createDataFrame(old_p.collect(), old_p.schema)
    old_r = marts.mart_risk(old_p, _stamp())
    changes = I.first_changes(_staged(spark, batch))
    whole_p = marts.mart_portfolio(_staged(spark, new), _stamp())
    got_p = I.refresh_portfolio(old_p, _staged(spark, new), changes, _stamp())
    assert sorted(got_p.collect(), key=str) == sorted(whole_p.collect(), key=str)
    got_r = I.refresh_risk(old_r, got_p, changes, _stamp())
    assert sorted(got_r.collect(), key=str) == sorted(marts.mart_risk(whole_p, _stamp()).collect(), key=str)


def test_refresh_stages_changed_days_only(spark):
    rows = _staged(spark, _days("A", 30, 1) + _days("B", 30, 2))
    changes = I.first_changes(rows.where("ticker = 'A' AND trade_date >= '2020-02-10'"))
    kept = I.rows_since(rows, changes).agg(F.min("trade_date"), F.max("ticker"), F.count(F.lit(1))).first()
    assert kept[0] >= dt.date(2020, 2, 10) and kept[1] == "A" and kept[2] == 10


def _final_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan.split("Initial Plan")[-1])


def test_bucketed_merge_moves_the_batch_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target, batch = (f(spark, SMOKE_SF) for f in (fixtures.upsert_stock_target, fixtures.upsert_stock_source))
        bucketed = sinks.write_bucketed(spark, target, _new_name("snapshot"), U.STOCK_KEY)
        staged = spark.createDataFrame(batch.collect(), batch.schema)
        merged = U.upsert_stock_prices(bucketed, staged)
        moved = _final_exchanges(merged)
        assert len(moved) == 1 and moved[0].startswith("s_ticker"), moved
        plain = U.upsert_stock_prices(target, staged)
        assert sorted(merged.collect(), key=str) == sorted(plain.select(merged.columns).collect(), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batches_of_a_run_move_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.createDataFrame([("A", dt.date(2026, 1, 1), 1.0, T0)],
                                       "k string, d date, v double, loaded_at timestamp_ntz")
        source = spark.createDataFrame(
            [("A", dt.date(2026, 1, 1), 1.0, 0), ("A", dt.date(2026, 1, 1), None, 1), ("A", dt.date(2026, 1, 1), None, 2),
             ("A", dt.date(2026, 1, 1), 1.0, 3), ("B", dt.date(2026, 1, 1), 2.0, 2)],
            "k string, d date, v double, batch int")
        merged = U.merge_in_order(target, source, ("k", "d"), ("v",), ("batch",), _stamp(), carry=["batch"])
        assert len(_final_exchanges(merged)) == 2
        got = {(r.k, r.batch): (r._action, r.v, r._final) for r in merged.collect()}
        assert got == {("A", 0): ("unchanged", 1.0, False), ("A", 1): ("update", None, False),
                       ("A", 2): ("unchanged", None, False), ("A", 3): ("update", 1.0, True),
                       ("B", 2): ("insert", 2.0, True)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_reads_no_observed_model_again(spark):
    models, seen = _dq_models(spark, SMOKE_SF)
    report = Q.dq_report(models, fixtures.pipeline_logs(spark, SMOKE_SF), seen)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    # one for each key check, the log, and what the risk and correlation marts are made of; the risk
    # mart's plan names its input twice, for the rows and the summaries of one shuffle
    assert plan.count("Relation [") <= 7
    plain = Q.dq_report(models, fixtures.pipeline_logs(spark, SMOKE_SF))
    assert sorted(report.collect()) == sorted(plain.collect()) and report.count() == 28


def test_selections(spark):
    port = spark.createDataFrame([("A", 1.0, 2.0, 3.0, -1.0), ("B", 5.0, None, None, -2.0)],
                                 "ticker string, close_price double, rolling_volatility_20d double, "
                                 "cumulative_return_pct double, drawdown_pct double")

    def table(*names):
        return spark.createDataFrame([(n,) for n in names], "ticker string")

    for chosen, found in ((["A"], 1), (["A", "Z"], 1), ([], 0), (None, 2), (["A"] + [f"x{i}" for i in range(2000)], 1),
                          (table("A", "A", "Z"), 1), (table(), 0), (table(None), 0)):
        assert RD.select_tickers(port, chosen).count() == found
    long = RD.select_tickers(port, [f"x{i}" for i in range(2000)])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in long and "x77" not in long
    for chosen, size in ((table("A", "Z"), 2), (["A", "Z"], 2), (None, 1), (table(), 0)):
        kept = RD.portfolio_summary(port.where("ticker = 'A'"), None if chosen is None else chosen)
        assert RD.portfolio_extremes(kept, chosen).first().tickers_tracked == size
    bound = RD.portfolio_summary_sql(spark, port, ["B", "it's"])
    assert [r.ticker for r in bound.collect()] == ["B"]


def test_audit_table_by_name(spark):
    name = _new_name("audit")
    sinks.create_audit_table(spark, name)
    rows = spark.createDataFrame([tuple(f"{i}" if f.dataType.typeName() in ("string", "long") else None for i, f in
                                        enumerate(PIPELINE_LOG_SCHEMA.fields))],
                                 ", ".join(f"{f.name} string" for f in PIPELINE_LOG_SCHEMA.fields))
    sinks.append_audit_rows(spark, rows, name)
    sinks.create_audit_table(spark, name)
    sinks.append_audit_rows(spark, rows.select(*reversed(rows.columns)), name)
    assert spark.table(name).count() == 2 and spark.table(name).distinct().count() == 1
    assert [f.dataType for f in spark.table(name).schema.fields] == [f.dataType for f in PIPELINE_LOG_SCHEMA.fields]
    with pytest.raises(sinks.WrongColumns):
        sinks.append_audit_rows(spark, rows.drop("status"), name)
    assert spark.table(name).count() == 2


def test_new_queries_are_registered():
    assert {"refreshed_mart_risk", "interleaved_stock_log", "selected_extremes"} <= set(QUERIES)


def test_a_taken_version_is_refused_before_anything_is_written(spark, scratch):
    wh = Warehouse(f"{scratch}/early")
    none = spark.createDataFrame([], PIPELINE_LOG_SCHEMA)
    rows = spark.createDataFrame([], RAW_STOCK_SCHEMA)
    read = wh.state(spark)
    wh.commit(spark, read, "A", "raw_stock_prices", rows, none)
    held = {k: sorted(sinks.folder_names(spark, wh.path(*k.split("/")))) for k in ("data/raw_stock_prices", "log")}
    with pytest.raises(ConcurrentCommit):
        wh.commit(spark, read, "B", "raw_stock_prices", rows, none)
    assert held == {k: sorted(sinks.folder_names(spark, wh.path(*k.split("/")))) for k in held}


def test_bars_move_to_their_payload_as_numbers(spark):
    """The second exchange of the payloads' bars holds no text of theirs and no arrays."""
    df = fixtures.stock_payloads(spark, SMOKE_SF)
    initial = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    lines = initial.splitlines()
    assert sum("Exchange hashpartitioning" in line for line in lines) == 2
    assert not any("ObjectHashAggregate" in line for line in lines[max(
        i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line):])
