import pytest

from tickwise.sources import payloads as P

GOOD = ('{"Time Series (Daily)": {"2031-07-09": {"1. open": "17.5", "2. high": "18.25", '
        '"3. low": "16", "4. close": "18", "5. volume": "3300"}}}')


def stock(spark, *payloads):
    return spark.createDataFrame([(str(i), "AAPL", p) for i, p in enumerate(payloads)],
                                 "payload_id string, ticker string, payload string")


def macro(spark, *payloads):
    return spark.createDataFrame([(str(i), "GDP", "Gross Domestic Product", p)
                                  for i, p in enumerate(payloads)],
                                 "payload_id string, series_id string, indicator_name string, "
                                 "payload string")


@pytest.mark.parametrize("payload,code", [
    (GOOD, None),
    ('{"Note": null}', "API_RATE_LIMITED"),
    ('{"Information": "i", "Error Message": "x"}', "API_RATE_LIMITED"),
    ('{"Error Message": "x"}', "API_DATA_UNAVAILABLE"),
    ("{}", "API_DATA_UNAVAILABLE"),
    ('{"Time Series (Daily)": {}}', "API_DATA_UNAVAILABLE"),
    ('{"Time Series (Daily)": [1]}', "API_DATA_UNAVAILABLE"),
    ("[1]", "API_RESPONSE_INVALID"),
    ("{oops", "API_RESPONSE_INVALID"),
    (None, "API_RESPONSE_INVALID"),
])
def test_stock_error_codes(spark, payload, code):
    assert P.classify_stock_payloads(stock(spark, payload)).collect()[0].error_code == code


def test_stock_payload_rows(spark):
    rows = P.parse_stock_payloads(stock(spark, GOOD)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.trade_date, r.open_price, r.high_price, r.low_price, r.close_price, r.volume) == (
        "2031-07-09", "17.5", "18.25", "16", "18", "3300")


def test_non_object_day_gives_null_fields_and_duplicate_key_keeps_last(spark):
    p = ('{"Time Series (Daily)": {"2026-01-02": {"1. open": "1"}, "2026-01-01": 5, '
         '"2026-01-02": {"1. open": "9"}}}')
    rows = sorted(P.parse_stock_payloads(stock(spark, p)).collect(), key=lambda r: r._input_order)
    assert [(r._input_order, r.trade_date, r.open_price) for r in rows] == [
        (0, "2026-01-02", "9"), (1, "2026-01-01", None)]


def test_error_payload_yields_no_rows(spark):
    assert P.parse_stock_payloads(stock(spark, '{"Note": 1}', "{oops")).count() == 0


@pytest.mark.parametrize("payload,code", [
    ('{"observations": [{"date": "2026-01-01", "value": "4.2"}]}', None),
    ('{"error_code": 400}', "API_DATA_UNAVAILABLE"),
    ('{"error_message": "x"}', "API_DATA_UNAVAILABLE"),
    ('{"observations": []}', "API_DATA_UNAVAILABLE"),
    ('{"observations": {}}', "API_DATA_UNAVAILABLE"),
    ("{}", "API_DATA_UNAVAILABLE"),
    ("[1]", "API_RESPONSE_INVALID"),
    ("{oops", "API_RESPONSE_INVALID"),
])
def test_macro_error_codes(spark, payload, code):
    assert P.classify_macro_payloads(macro(spark, payload)).collect()[0].error_code == code


def test_macro_rows_keep_missing_marker_and_non_objects(spark):
    p = '{"observations": [{"date": "2026-01-01", "value": "."}, 5, {"date": "2026-02-01", "value": 4.2}]}'
    rows = sorted(P.parse_macro_payloads(macro(spark, p)).collect(), key=lambda r: r._input_order)
    assert [(r.indicator_date, r.value) for r in rows] == [
        ("2026-01-01", "."), (None, None), ("2026-02-01", "4.2")]


def test_latest_observations_is_top_k_per_series(spark):
    df = spark.createDataFrame([("A", i) for i in range(150)] + [("B", i) for i in range(3)],
                               "series_id string, indicator_date int")
    out = P.latest_observations(df, limit=100)
    counts = {r.series_id: r["count"] for r in out.groupBy("series_id").count().collect()}
    assert counts == {"A": 100, "B": 3}
    assert out.where("series_id = 'A'").agg({"indicator_date": "min"}).collect()[0][0] == 50


def test_a_repeated_date_among_ten_thousand(spark):
    """First position and last value of each date, in time that follows the payload's length."""
    import datetime as dt
    import json
    import time

    days = [str(dt.date(1990, 1, 1) + dt.timedelta(days=i)) for i in range(10_000)]
    parts = [f'{json.dumps(d)}: {{"4. close": "{i}"}}' for i, d in enumerate(days)]
    parts += [f'"{days[5]}": {{"4. close": "again"}}', f'"{days[5]}": {{"4. close": "last"}}',
              f'"{days[0]}": "no object"']
    body = '{"Time Series (Daily)": {' + ", ".join(parts) + "}}"
    df = spark.createDataFrame([("p", "A", body)], "payload_id string, ticker string, payload string")
    started = time.time()
    got = {r.trade_date: (r._input_order, r.close_price) for r in P.parse_stock_payloads(df).collect()}
    assert time.time() - started < 60
    want = {d: (i, str(i)) for i, d in enumerate(days)} | {days[5]: (5, "last"), days[0]: (0, None)}
    assert got == want
