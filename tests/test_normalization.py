"""The normalisation cases of the reference, as DataFrame rows."""

import pytest

from tickwise.operators import normalize as N

STOCK = dict(ticker="AAPL", trade_date="2026-01-02", open_price="100.123456",
             high_price="110.123456", low_price="90.123456", close_price="105.123456",
             volume="1000")
MACRO = dict(series_id="GDP", indicator_name="Gross Domestic Product",
             indicator_date="2026-01-01", value="123.123456789")
STOCK_COLS = ["_input_order", *N.STOCK_INPUT_COLUMNS]
MACRO_COLS = ["_input_order", *N.MACRO_INPUT_COLUMNS]


def stock_batch(spark, *overrides):
    rows = [tuple([i] + [{**STOCK, **o}[c] for c in N.STOCK_INPUT_COLUMNS])
            for i, o in enumerate(overrides)]
    return spark.createDataFrame(rows, ", ".join(
        ["_input_order bigint"] + [f"{c} string" for c in N.STOCK_INPUT_COLUMNS]))


def macro_batch(spark, *overrides):
    rows = [tuple([i] + [{**MACRO, **o}[c] for c in N.MACRO_INPUT_COLUMNS])
            for i, o in enumerate(overrides)]
    return spark.createDataFrame(rows, ", ".join(
        ["_input_order bigint"] + [f"{c} string" for c in N.MACRO_INPUT_COLUMNS]))


def reasons(rejected):
    return sorted(r.reason for r in rejected.collect())


def test_valid_row_is_rounded_half_even(spark):
    valid, rejected = N.stock_normalization(stock_batch(spark, {}))
    row = valid.collect()[0]
    assert (row.ticker, str(row.trade_date)) == ("AAPL", "2026-01-02")
    assert [str(x) for x in (row.open_price, row.high_price, row.low_price, row.close_price)] == [
        "100.1235", "110.1235", "90.1235", "105.1235"]
    assert row.volume == 1000 and rejected.count() == 0


@pytest.mark.parametrize("override,reason", [
    ({"close_price": None}, "invalid_ohlc"),
    ({"close_price": "0"}, "invalid_ohlc"),
    ({"open_price": "-1"}, "invalid_ohlc"),
    ({"open_price": "inf"}, "invalid_ohlc"),
    ({"high_price": "99"}, "inconsistent_ohlc"),
    ({"volume": None}, "invalid_volume"),
    ({"volume": "0"}, "invalid_volume"),
    ({"volume": "-1"}, "invalid_volume"),
    ({"volume": "1.5"}, "invalid_volume"),
    ({"trade_date": "not-a-date"}, "invalid_trade_date"),
    ({"ticker": "AAPL;DROP"}, "invalid_ticker"),
    ({"ticker": "AA PL"}, "invalid_ticker"),
    ({"ticker": "bad ticker!"}, "invalid_ticker"),
])
def test_stock_reject_reasons(spark, override, reason):
    valid, rejected = N.stock_normalization(stock_batch(spark, override))
    assert valid.count() == 0
    assert reasons(rejected) == [reason]


def test_first_reason_wins(spark):
    _, rejected = N.stock_normalization(stock_batch(spark, {"ticker": "bad!", "volume": "0"}))
    assert reasons(rejected) == ["invalid_ticker"]


def test_ticker_is_stripped_and_upper_cased(spark):
    valid, _ = N.stock_normalization(stock_batch(spark, {"ticker": " brk.b "}))
    assert valid.collect()[0].ticker == "BRK.B"


def test_duplicate_keeps_last(spark):
    valid, rejected = N.stock_normalization(
        stock_batch(spark, {"close_price": "101"}, {"close_price": "102"}))
    assert [r.close_price for r in valid.collect()] == [102.0]
    assert reasons(rejected) == ["duplicate_key"]


def test_dedup_runs_after_validity(spark):
    valid, rejected = N.stock_normalization(
        stock_batch(spark, {"close_price": "101"}, {"close_price": "0"}))
    assert [r.close_price for r in valid.collect()] == [101.0]
    assert reasons(rejected) == ["invalid_ohlc"]


def test_all_invalid_keeps_columns(spark):
    valid, _ = N.stock_normalization(stock_batch(spark, {"close_price": None}))
    assert valid.count() == 0
    assert set(N.STOCK_INPUT_COLUMNS) <= set(valid.columns)


def test_metrics_reconcile(spark):
    batch = stock_batch(spark, {}, {"volume": "0"}, {"close_price": "101"}, {"ticker": "x y"})
    m = N.stock_batch_metrics(batch).collect()[0]
    assert m == N.metrics_from_reasons(N.stock_reasons(batch), N.STOCK_REASONS).collect()[0]
    assert (m.rows_fetched, m.rows_valid, m.rows_dropped) == (4, 1, 3)
    assert m.rows_valid + m.rows_dropped == m.rows_fetched
    assert (m.dropped_duplicate_key, m.dropped_invalid_volume, m.dropped_invalid_ticker) == (1, 1, 1)


def test_missing_columns_raise(spark):
    df = stock_batch(spark, {}).drop("volume", "ticker")
    with pytest.raises(N.NormalizationError, match="ticker, volume"):
        N.stock_normalization(df)


@pytest.mark.parametrize("override,reason", [
    ({"value": "."}, "invalid_value"),
    ({"value": None}, "invalid_value"),
    ({"value": "bad"}, "invalid_value"),
    ({"value": "inf"}, "invalid_value"),
    ({"indicator_date": "bad"}, "invalid_indicator_date"),
    ({"series_id": "bad id!"}, "invalid_series_id"),
    ({"indicator_name": "  "}, "invalid_indicator_name"),
])
def test_macro_reject_reasons(spark, override, reason):
    valid, rejected = N.macro_normalization(macro_batch(spark, override))
    assert valid.count() == 0
    assert reasons(rejected) == [reason]


def test_macro_value_rounding_zero_and_negative_valid(spark):
    valid, _ = N.macro_normalization(macro_batch(
        spark, {}, {"indicator_date": "2026-02-01", "value": "0"},
        {"indicator_date": "2026-03-01", "value": "-1.5"}))
    assert sorted(float(r.value) for r in valid.collect()) == [-1.5, 0.0, 123.123457]


def test_macro_duplicate_keeps_last(spark):
    valid, rejected = N.macro_normalization(macro_batch(spark, {"value": "1"}, {"value": "2"}))
    assert [r.value for r in valid.collect()] == [2.0]
    assert reasons(rejected) == ["duplicate_key"]


def test_extreme_numbers_stay_in_their_row(spark):
    """A volume of 31 digits and a price of 32 load exactly; what RAW cannot hold is rejected."""
    big = {"open_price": "1e31", "high_price": "1e31", "low_price": "1e31", "close_price": "1e31"}
    valid, rejected = N.stock_normalization(stock_batch(
        spark, {"volume": "1e30"}, {"trade_date": "2026-01-03", **big},
        {"trade_date": "2026-01-04", "volume": "9007199254740993"},
        {"trade_date": "2026-01-05", "volume": "1e38"},
        {"trade_date": "2026-01-06", **{k: "1e34" for k in big}}))
    rows = {str(r.trade_date): r for r in valid.collect()}
    assert rows["2026-01-02"].volume == 10 ** 30 and rows["2026-01-03"].close_price == 10 ** 31
    assert rows["2026-01-04"].volume == 9007199254740993
    assert reasons(rejected) == ["invalid_ohlc", "invalid_volume"]


def test_empty_batch_metrics(spark):
    m = N.stock_batch_metrics(stock_batch(spark, {}).limit(0)).collect()[0]
    assert set(m) == {0}
