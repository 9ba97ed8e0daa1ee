import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickwise.operators import audit as AU
from tickwise.operators import upsert as U

SCHEMA = ("ticker string, trade_date date, open_price double, high_price double, "
          "low_price double, close_price double, volume bigint, loaded_at timestamp_ntz")
T0 = dt.datetime(2026, 1, 1)
T1 = dt.datetime(2026, 1, 2)
D1, D2, D3 = dt.date(2026, 1, 1), dt.date(2026, 1, 2), dt.date(2026, 1, 5)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_merge_actions_and_values(spark):
    target = frame(spark, [("A", D1, 1.0, 2.0, 1.0, 2.0, 10, T0),
                           ("A", D2, 1.0, 2.0, 1.0, 2.0, 10, T0),
                           ("B", D1, 5.0, 6.0, 4.0, 5.0, 7, T0)])
    source = frame(spark, [("A", D1, 1.0, 2.0, 1.0, 2.0, 10, T1),       # unchanged
                           ("A", D2, 1.0, 2.0, 1.0, 2.5, 10, T1),       # update
                           ("A", D3, 1.0, 2.0, 1.0, 2.0, 10, T1)])      # insert
    out = {(r.ticker, r.trade_date): r for r in U.upsert_stock_prices(target, source).collect()}
    assert {k: r._action for k, r in out.items()} == {
        ("A", D1): "unchanged", ("A", D2): "update", ("A", D3): "insert", ("B", D1): "keep"}
    assert out[("A", D1)].loaded_at == T0          # unchanged keeps its load time
    assert out[("A", D2)].loaded_at == T1 and out[("A", D2)].close_price == 2.5
    counts = U.merge_counts(U.upsert_stock_prices(target, source)).collect()[0]
    assert (counts.rows_inserted, counts.rows_updated, counts.rows_unchanged) == (1, 1, 1)


def test_null_safe_comparison(spark):
    target = frame(spark, [("A", D1, None, 2.0, 1.0, 2.0, 10, T0)])
    same = frame(spark, [("A", D1, None, 2.0, 1.0, 2.0, 10, T1)])
    other = frame(spark, [("A", D1, 1.0, 2.0, 1.0, 2.0, 10, T1)])
    assert U.upsert_stock_prices(target, same).collect()[0]._action == "unchanged"
    assert U.upsert_stock_prices(target, other).collect()[0]._action == "update"


def test_rerun_is_idempotent(spark):
    source = frame(spark, [("A", D1, 1.0, 2.0, 1.0, 2.0, 10, T1), ("A", D2, 1.0, 2.0, 1.0, 2.0, 9, T1)])
    first = U.upsert_stock_prices(frame(spark, []), source).drop("_action")
    again = U.merge_counts(U.upsert_stock_prices(first, source)).collect()[0]
    assert (again.rows_inserted, again.rows_updated, again.rows_unchanged) == (0, 0, 2)


@pytest.mark.parametrize("valid,ins,upd,dropped,err,status", [
    (0, 0, 0, 2, None, "NO_VALID_ROWS"),
    (2, 0, 0, 0, None, "NO_CHANGES"),
    (2, 1, 0, 1, None, "PARTIAL_SUCCESS"),
    (2, 1, 0, 0, None, "SUCCESS"),
    (2, 1, 0, 0, "API_TIMEOUT", "FAILED"),
])
def test_run_status(spark, valid, ins, upd, dropped, err, status):
    df = spark.createDataFrame([(valid, ins, upd, dropped, err)],
                               "v bigint, i bigint, u bigint, d bigint, e string")
    got = df.select(AU.run_status(F.col("v"), F.col("i"), F.col("u"), F.col("d"), F.col("e")))
    assert got.collect()[0][0] == status


def test_run_log_row(spark):
    batches = spark.createDataFrame([("p1", "AAPL", None), ("p2", "MSFT", "API_RATE_LIMITED")],
                                    "payload_id string, entity_name string, error_code string")
    metrics = spark.createDataFrame([("p1", 3, 2, 1)],
                                    "payload_id string, rows_fetched bigint, rows_valid bigint, "
                                    "rows_dropped bigint")
    counts = spark.createDataFrame([("p1", 1, 1, 0)],
                                   "payload_id string, rows_inserted bigint, rows_updated bigint, "
                                   "rows_unchanged bigint")
    rows = {r.entity_name: r for r in AU.run_log(
        batches, metrics, counts, pipeline_name=AU.STOCK_PIPELINE,
        started_at="2026-01-01 00:00:00", completed_at="2026-01-01 00:00:01.5", run_key="a").collect()}
    ok, failed = rows["AAPL"], rows["MSFT"]
    assert (ok.status, ok.duration_ms, ok.error_message) == ("PARTIAL_SUCCESS", 1500, None)
    assert (failed.status, failed.rows_fetched, failed.error_code) == ("FAILED", 0, "API_RATE_LIMITED")
    assert failed.error_message == AU.ERROR_MESSAGES["API_RATE_LIMITED"]
    assert len(ok.run_id) == 36 and ok.run_id != failed.run_id
    other = AU.run_log(batches, metrics, counts, pipeline_name=AU.STOCK_PIPELINE, run_key="b",
                       started_at="2026-01-01 00:00:00", completed_at="2026-01-01 00:00:01.5").collect()
    assert not {r.run_id for r in other} & {ok.run_id, failed.run_id}


def test_merge_in_order_is_one_run_after_the_other(spark):
    """Counts and snapshot of one plan equal those of separate merges in landing order."""
    import random

    rnd = random.Random(4)
    days = [D1, D2, D3]
    def bars(n):
        keys = rnd.sample([(t, d) for t in "ABC" for d in days], n)
        return [(t, d, 1.0, 2.0, 1.0, float(rnd.randint(1, 2)), 10) for t, d in keys]
    target = frame(spark, [(*b, T0) for b in bars(4)])
    batches = [bars(5) for _ in range(4)]
    state, want = target, {}
    for i, b in enumerate(batches):
        merged = U.upsert_stock_prices(state, frame(spark, [(*r, T1) for r in b]))
        c = U.merge_counts(merged).collect()[0]
        want[f"p{i}"] = tuple(c)
        state = spark.createDataFrame(merged.drop("_action").collect(), SCHEMA)
    rows = [(f"p{i}", i, *r) for i, b in enumerate(batches) for r in b]
    source = spark.createDataFrame(rows, "payload_id string, landing_order bigint, " + SCHEMA.rsplit(",", 1)[0])
    merged = U.merge_in_order(target, source, U.STOCK_KEY, U.STOCK_VALUES, ("landing_order", "payload_id"),
                              F.lit(T1).cast("timestamp_ntz"), ["payload_id"])
    got = {r[0]: tuple(r)[1:] for r in U.merge_counts(merged, ["payload_id"]).collect()}
    assert got == want
    final = merged.where("_final").select(*state.columns)
    assert sorted(final.collect()) == sorted(state.collect())
    assert final.select(*U.STOCK_KEY).distinct().count() == final.count()


def test_violations_find_planted_faults(spark):
    cols = ("run_id string, pipeline_name string, status string, rows_fetched bigint, "
            "rows_valid bigint, rows_inserted bigint, rows_updated bigint, rows_unchanged bigint, "
            "rows_dropped bigint, duration_ms bigint")
    logs = spark.createDataFrame([
        ("ok", "STOCK_INGESTION", "SUCCESS", 3, 3, 3, 0, 0, 0, 5),
        ("neg", "STOCK_INGESTION", "SUCCESS", 3, 3, 3, 0, 0, 0, -1),
        ("sum", "STOCK_INGESTION", "PARTIAL_SUCCESS", 3, 2, 2, 0, 0, 2, 5),
        ("name", "OTHER", "SUCCESS", 3, 3, 3, 0, 0, 0, 5),
        ("nvr", "MACRO_INGESTION", "NO_VALID_ROWS", 3, 1, 0, 0, 0, 2, 5),
        ("failed", "MACRO_INGESTION", "FAILED", 3, 0, 0, 0, 0, 0, 5),
    ], cols)
    got = {r.run_id: r.violation for r in AU.run_log_violations(logs).collect()}
    assert got == {"neg": "counts", "sum": "counts", "name": "metadata", "nvr": "no_valid_rows"}
