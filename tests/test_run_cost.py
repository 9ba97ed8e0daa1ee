"""What an ingestion run reads, moves and writes once: plain payloads, merges in order, month folders."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickwise.functions.parse import date_text, parse_date
from tickwise.operators import normalize as N
from tickwise.operators import upsert as U
from tickwise.plans.ingest import ORDER, run_stock_ingestion
from tickwise.session import checkpoint_dir
from tickwise.sources import payloads as P
from tickwise.sources import sinks
from tickwise.sources.tables import RAW_STOCK_SCHEMA
from tickwise.sources.warehouse import SUPERSEDED, Warehouse

SERIES = '"Time Series (Daily)"'
T0 = dt.datetime(2026, 1, 1)


def _bar(price, volume=10):
    fields = zip(P.STOCK_FIELDS.values(), [price] * 4 + [volume])
    return "{" + ", ".join(f'"{k}": "{v}"' for k, v in fields) + "}"


def _payloads(spark, rows):
    return spark.createDataFrame(rows, "payload_id string, ticker string, payload string, landing_order bigint")


@pytest.mark.parametrize("payload,opens", [
    ('{%s: {"d1": {"1. open": "1"}, "d2": {"1. open": null}}}' % SERIES, ["1", None]),
    # the texts of bare numbers are those JSON copies have
    ('{%s: {"d1": {"1. open": NaN}, "d2": {"1. open": 1e400}, "d3": {"1. open": 12.50}}}' % SERIES,
     ["NaN", "Infinity", "12.5"]),
    ('{%s: {"d1": {"1. open": {"a": ["b"]}}}}' % SERIES, ['{"a":["b"]}']),
    ('{%s: {"d1": {"1. open": "\\u0041\\""}}}' % SERIES, ['A"']),
    # the first of two series counts, the last of two equal fields
    ('{%s: {"d1": {"1. open": "1"}}, %s: {"d1": {"1. open": "2"}}}' % (SERIES, SERIES), ["1"]),
    ('{%s: {"d1": {"1. open": "1", "1. open": "2"}}}' % SERIES, ["2"]),
    ('{%s: {"d1": {"1. open": "1"}, "d2": [], "d3": null, "d4": "{}"}}' % SERIES, ["1", None, None, None]),
    # a key that is only part of an error key, or its text elsewhere, is no error; a null one is
    ('{"Meta Data": {"1. Information": "Notes"}, %s: {"d1": {"1. open": "1"}}}' % SERIES, ["1"]),
    ('{%s: {"d1": {"1. open": "1"}}, "Note": null}' % SERIES, []),
    ("{%s: {'d1': {'1. open': '1'}}, 'Note': null}" % SERIES, []),
    ('{%s: {"d1": {"1. open": "1"}}, oops' % SERIES, []),
])
def test_plain_and_other_payloads_read_alike(spark, payload, opens):
    rows = P.parse_stock_payloads(_payloads(spark, [("p", "A", payload, 0)])).collect()
    assert [r.open_price for r in sorted(rows, key=lambda r: r._input_order)] == opens
    code = P.classify_stock_payloads(_payloads(spark, [("p", "A", payload, 0)])).first().error_code
    assert (code is None) == bool(opens)


def test_a_plain_payload_is_read_in_one_pass(spark, scratch):
    """Days come with their fields; the methods made for it are small enough to be compiled."""
    _payloads(spark, [("p", "A", "{}", 0)]).write.parquet(scratch + "/p")
    read = spark.read.parquet(scratch + "/p")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan shows its generated code
    try:
        rows = P.parse_stock_payloads(read, ("payload_id", "landing_order", "ticker"))
        parts = {"from_json(StructField(Time Series (Daily),MapType(StringType,StructType":
                 N.stock_reasons(rows, batch_cols=ORDER), "jsonObjectKeys": P.classify_stock_payloads(read)}
        for part, df in parts.items():
            plan = df._jdf.queryExecution().executedPlan()
            assert part in plan.toString()
            code = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package").codegenStringSeq(plan)
            largest = max(code.apply(i)._3().maxMethodCodeSize() for i in range(code.size()))
            assert 0 < largest < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_merges_in_order_make_no_lists(spark):
    schema = "k string, v double, loaded_at timestamp_ntz"
    target = spark.createDataFrame([("A", 1.0, T0), ("B", 1.0, T0), ("Z", None, T0)], schema)
    source = spark.createDataFrame([("A", 1.0, 0), ("A", 1.0, 1), ("B", 2.0, 0), ("B", 1.0, 1), ("C", None, 0),
                                    ("C", None, 2), (None, 1.0, 0), (None, 1.0, 1)], "k string, v double, batch int")
    merged = U.merge_in_order(target, source, ("k",), ("v",), ("batch",), F.lit("2026-02-02").cast("timestamp_ntz"),
                              carry=["batch"])
    assert "collect_list" not in merged._jdf.queryExecution().executedPlan().toString()
    late = dt.datetime(2026, 2, 2)
    assert {(r.k, r.batch): (r._action, r.v, r.loaded_at, r._final) for r in merged.collect()} == {
        ("A", 0): ("unchanged", 1.0, T0, False), ("A", 1): ("unchanged", 1.0, T0, True),
        # changed and changed back: the values of the target, and yet a later load
        ("B", 0): ("update", 2.0, late, False), ("B", 1): ("update", 1.0, late, True),
        ("C", 0): ("insert", None, late, False), ("C", 2): ("unchanged", None, late, True),
        (None, 0): ("insert", 1.0, late, False), (None, 1): ("unchanged", 1.0, late, True),
        ("Z", None): ("keep", None, T0, True)}


def test_a_run_writes_its_merge_once(spark, scratch):
    """The labelled merge stands in month folders only; replaced rows are counted and in no table."""
    def payload(days):
        return '{%s: {%s}}' % (SERIES, ", ".join(f'"{d}": {_bar(p)}' for d, p in days.items()))

    staged = f"{checkpoint_dir(spark).rstrip('/')}/tickwise"
    before = set(sinks.folder_names(spark, staged))
    wh = Warehouse(scratch)
    log = run_stock_ingestion(spark, _payloads(spark, [
        ("p0", "A", payload({"2026-01-30": 1, "2026-02-02": 2}), 0),
        ("p1", "A", payload({"2026-02-02": 3, "2026-02-03": 4}), 1),
        ("p2", "A", '{"Note": null}', 2)]), wh)
    for name in set(sinks.folder_names(spark, staged)) - before:
        assert "merged" not in sinks.folder_names(spark, f"{staged}/{name}")
    held = wh.state(spark).months["raw_stock_prices"]
    assert sorted(held) == ["2026-01", "2026-02"]
    parent = held["2026-02"].rpartition("/")[0]
    assert f"month={SUPERSEDED}" in sinks.folder_names(spark, parent)
    table = wh.read(spark, "raw_stock_prices")
    assert [f.name for f in table.schema.fields] == [f.name for f in RAW_STOCK_SCHEMA.fields]
    assert sorted((str(r.trade_date), r.close_price) for r in table.collect()) == [
        ("2026-01-30", Decimal(1)), ("2026-02-02", Decimal(3)), ("2026-02-03", Decimal(4))]
    counts = {r.status: 0 for r in log.collect()}
    assert set(counts) == {"SUCCESS", "FAILED"}
    assert log.agg(F.sum("rows_inserted"), F.sum("rows_updated"), F.sum("rows_unchanged")).first()[:] == (3, 1, 0)


def test_date_texts_and_plain_dates(spark):
    days = spark.createDataFrame([(dt.date(2026, 1, 2),), (dt.date(1, 3, 4),), (dt.date(9999, 12, 31),), (None,)], "d date")
    far = spark.sql("SELECT CAST('+12026-01-02' AS DATE) AS d UNION ALL SELECT CAST('-0004-01-02' AS DATE)")
    for form in ("yyyy-MM", "yyyy-MM-dd"):
        for df in (days, far):
            assert df.where(~date_text("d", form).eqNullSafe(F.date_format("d", form))).count() == 0
    texts = spark.createDataFrame([("2026-02-28",), ("2026-02-30",), ("2026-2-1",), ("2026-02-28\n",), ("0999-01-01",)], "t string")
    assert [str(r[0]) for r in texts.select(parse_date("t")).collect()] == [
        "2026-02-28", "None", "2026-02-01", "2026-02-28", "0999-01-01"]
