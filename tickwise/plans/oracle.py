"""Independent DuckDB SQL for every registered query.

Each oracle re-derives its inputs from the supplied tables with its own CTEs
(the same mapping as ``tickwise.sources.fixtures``, written in SQL) and then
states the model in plain SQL.  Nothing here is executed by Spark.
"""

from __future__ import annotations

AS_OF = "2024-01-31 00:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def R(x: str, n: int) -> str:
    """ROUND through decimal(38,8), the same route the Spark side takes."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,8)), {n}) AS DOUBLE)"


def NEAREST(x: str, n: int) -> str:
    """Scaled to an integer, ties to even (adding 1.5 * 2^52 leaves no fraction bits), scaled back."""
    v = f"(({x}) * 1e{n}::DOUBLE)"
    return (f"(CASE WHEN abs({v}) < 4503599627370496 THEN ({v} + 6755399441055744::DOUBLE) - 6755399441055744::DOUBLE "
            f"ELSE {v} END / 1e{n}::DOUBLE)")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


RAW_STOCK = f"""raw_stock_prices AS (
  SELECT l_orderkey AS source_key, 'S' || CAST(l_suppkey AS VARCHAR) AS ticker,
         CAST(l_shipdate AS DATE) AS trade_date,
         {R('l_extendedprice * (1 - l_discount)', 4)} AS open_price,
         {R('l_extendedprice * (1 + l_tax) + 1', 4)} AS high_price,
         {R('l_extendedprice * (1 - l_discount) * 0.9', 4)} AS low_price,
         CASE WHEN l_orderkey % 97 <> 0 THEN l_extendedprice END AS close_price,
         CAST(CASE WHEN l_orderkey % 89 = 0 THEN 0 ELSE l_quantity END AS BIGINT) AS volume,
         l_shipdate + to_seconds(l_orderkey) AS loaded_at
  FROM lineitem)"""

STG_STOCK = """stg_stock_prices AS (
  SELECT UPPER(ticker) AS ticker, CAST(trade_date AS DATE) AS trade_date,
         CAST(open_price AS DOUBLE) AS open_price, CAST(high_price AS DOUBLE) AS high_price,
         CAST(low_price AS DOUBLE) AS low_price, CAST(close_price AS DOUBLE) AS close_price,
         CAST(volume AS BIGINT) AS volume, loaded_at
  FROM (SELECT *, ROW_NUMBER() OVER (
               PARTITION BY ticker, trade_date
               ORDER BY loaded_at DESC NULLS LAST, close_price DESC NULLS LAST,
                        open_price DESC NULLS LAST, high_price DESC NULLS LAST,
                        low_price DESC NULLS LAST, volume DESC NULLS LAST) AS row_num
        FROM raw_stock_prices
        WHERE close_price IS NOT NULL AND volume > 0) c
  WHERE row_num = 1)"""

RAW_MACRO = """raw_macro_indicators AS (
  SELECT o_orderkey AS source_key, CASE c_mktsegment
           WHEN 'AUTOMOBILE' THEN 'Consumer Price Index'
           WHEN 'BUILDING' THEN 'Federal Funds Rate'
           WHEN 'FURNITURE' THEN 'Gross Domestic Product'
           WHEN 'HOUSEHOLD' THEN 'Unemployment Rate'
           WHEN 'MACHINERY' THEN '10 Year Treasury Rate' END AS indicator_name,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(o_orderdate AS DATE)
              ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS indicator_date,
         CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS value,
         o_orderdate + to_seconds(o_orderkey) AS loaded_at
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

STG_MACRO = """stg_macro_indicators AS (
  SELECT UPPER(indicator_name) AS indicator_name, CAST(indicator_date AS DATE) AS indicator_date,
         CAST(value AS DOUBLE) AS value, loaded_at
  FROM (SELECT *, ROW_NUMBER() OVER (
               PARTITION BY indicator_name, indicator_date
               ORDER BY loaded_at DESC NULLS LAST, value DESC NULLS LAST) AS row_num
        FROM raw_macro_indicators WHERE value IS NOT NULL) c
  WHERE row_num = 1)"""

PORTFOLIO = f"""days AS (
  SELECT *, lag(close_price, 1) OVER by_day AS yesterday,
         first(close_price) OVER (by_day ROWS UNBOUNDED PRECEDING) AS opening,
         max(close_price) OVER (by_day ROWS UNBOUNDED PRECEDING) AS running_peak,
         {R('avg(close_price) OVER (by_day ROWS 19 PRECEDING)', 4)} AS ma_20day,
         {R('avg(close_price) OVER (by_day ROWS 49 PRECEDING)', 4)} AS ma_50day
  FROM stg_stock_prices WINDOW by_day AS (PARTITION BY ticker ORDER BY trade_date)),
moves AS (
  SELECT * EXCLUDE (yesterday, opening), yesterday AS prev_close_price,
         {R('(close_price - yesterday) / nullif(yesterday, 0) * 100', 4)} AS daily_return_pct,
         {R('(close_price - opening) / nullif(opening, 0) * 100', 4)} AS cumulative_return_pct,
         {R('(close_price - running_peak) / nullif(running_peak, 0) * 100', 4)} AS drawdown_pct
  FROM days),
mart_portfolio AS (
  SELECT ticker, trade_date, open_price, high_price, low_price, close_price, volume, prev_close_price,
         daily_return_pct, ma_20day, ma_50day,
         {R('stddev_samp(daily_return_pct) OVER (PARTITION BY ticker ORDER BY trade_date ROWS 19 PRECEDING)', 4)}
           AS rolling_volatility_20d,
         cumulative_return_pct, running_peak, drawdown_pct, {AS_OF_SQL} AS updated_at
  FROM moves)"""

RISK = f"""mart_risk AS (
  SELECT ticker, trade_date, daily_return_pct, rolling_volatility_20d,
    {R('(avg(daily_return_pct) OVER month_back - 0.0198) / nullif(rolling_volatility_20d, 0) * sqrt(252)', 4)}
      AS sharpe_ratio_20d,
    min(drawdown_pct) OVER (so_far ROWS UNBOUNDED PRECEDING) AS max_drawdown_pct,
    {R('avg(daily_return_pct) OVER month_back - 1.645 * nullif(rolling_volatility_20d, 0)', 4)} AS var_95_pct,
    {R('avg(volume) OVER month_back', 0)} AS avg_volume_20d,
    cumulative_return_pct, {AS_OF_SQL} AS updated_at
  FROM mart_portfolio WHERE daily_return_pct IS NOT NULL
  WINDOW so_far AS (PARTITION BY ticker ORDER BY trade_date),
         month_back AS (PARTITION BY ticker ORDER BY trade_date ROWS 19 PRECEDING))"""

MACRO_CHANGE = f"""macro_steps AS (
  SELECT indicator_name, indicator_date, value,
         lag(value) OVER (PARTITION BY indicator_name ORDER BY indicator_date) AS was
  FROM stg_macro_indicators),
macro_changes AS (
  SELECT indicator_name, indicator_date, value,
         {R('(value - was) / nullif(was, 0) * 100', 4)} AS indicator_change_pct
  FROM macro_steps)"""

JOINED = """stock_macro AS (
  SELECT ticker, trade_date, daily_return_pct, indicator_name, value AS indicator_value, indicator_change_pct
  FROM mart_portfolio JOIN macro_changes ON indicator_date = trade_date
  WHERE daily_return_pct IS NOT NULL)"""

CORRELATION = f"""mart_macro_correlation AS (
  SELECT ticker, trade_date, indicator_name, indicator_value, indicator_change_pct, daily_return_pct,
    {R('''(avg(daily_return_pct * indicator_change_pct) OVER pair
        - avg(daily_return_pct) OVER pair * avg(indicator_change_pct) OVER pair)
       / nullif(stddev_samp(daily_return_pct) OVER pair * stddev_samp(indicator_change_pct) OVER pair, 0)''', 4)}
      AS rolling_correlation_20d,
    {AS_OF_SQL} AS updated_at
  FROM stock_macro
  WINDOW pair AS (PARTITION BY ticker, indicator_name ORDER BY trade_date ROWS 19 PRECEDING))"""

STOCK_CHAIN = (RAW_STOCK, STG_STOCK)
MACRO_CHAIN = (RAW_MACRO, STG_MACRO)
PORTFOLIO_CHAIN = STOCK_CHAIN + (PORTFOLIO,)
RISK_CHAIN = PORTFOLIO_CHAIN + (RISK,)
CORRELATION_CHAIN = PORTFOLIO_CHAIN + MACRO_CHAIN + (MACRO_CHANGE, JOINED, CORRELATION)

ORACLE: dict[str, str] = {
    "stg_stock_prices": with_(*STOCK_CHAIN) + "SELECT * FROM stg_stock_prices",
    "stg_macro_indicators": with_(*MACRO_CHAIN) + "SELECT * FROM stg_macro_indicators",
    "mart_portfolio": with_(*PORTFOLIO_CHAIN) + "SELECT * FROM mart_portfolio",
    "mart_risk": with_(*RISK_CHAIN) + "SELECT * FROM mart_risk",
    "mart_macro_correlation": with_(*CORRELATION_CHAIN) + "SELECT * FROM mart_macro_correlation",
}

# -- normalisation -------------------------------------------------------------

NUM_RE = r"(?i)[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)"
ISO_RE = r"\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?"


def STRIP(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def NUM(x: str) -> str:
    s = STRIP(f"CAST({x} AS VARCHAR)")
    return f"(CASE WHEN regexp_full_match({s}, '{NUM_RE}') THEN TRY_CAST({s} AS DOUBLE) END)"


def DATE_(x: str) -> str:
    s = STRIP(x)
    return (f"(CASE WHEN regexp_full_match({s}, '{ISO_RE}') THEN "
            f"CAST(TRY_CAST(regexp_replace({s}, 'Z$', '') AS TIMESTAMP) AS DATE) END)")


def FIN(x: str) -> str:
    return f"coalesce(isfinite({x}), false)"


DIRTY_STOCK = """dirty_stock AS (
  SELECT event_id AS _input_order,
    CASE WHEN event_id % 11 = 0 THEN 'bad ticker!'
         WHEN event_id % 7 = 0 THEN ' u' || CAST(user_id AS VARCHAR) || ' '
         ELSE 'U' || CAST(user_id AS VARCHAR) END AS ticker,
    CASE WHEN event_id % 13 = 0 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d') END AS trade_date,
    CAST(value AS VARCHAR) AS open_price,
    CASE WHEN event_id % 23 = 0 THEN '0.001' ELSE CAST(value + 1 AS VARCHAR) END AS high_price,
    CASE WHEN event_id % 29 = 0 THEN 'inf' WHEN event_id % 37 = 0 THEN '1.0d'
         ELSE CAST(value / 2 AS VARCHAR) END AS low_price,
    CAST(value AS VARCHAR) AS close_price,
    CASE WHEN event_id % 17 = 0 THEN '0' WHEN event_id % 19 = 0 THEN '1.5'
         WHEN event_id % 31 = 0 THEN NULL ELSE CAST(user_id + 1 AS VARCHAR) END AS volume
  FROM events)"""

STOCK_NORMALIZED = f"""stock_parsed AS (
  SELECT _input_order, upper({STRIP('ticker')}) AS ticker, {DATE_('trade_date')} AS trade_date,
         {NUM('open_price')} AS open_price, {NUM('high_price')} AS high_price,
         {NUM('low_price')} AS low_price, {NUM('close_price')} AS close_price,
         {NUM('volume')} AS volume
  FROM dirty_stock),
stock_tagged AS (
  SELECT *, CASE
    WHEN NOT coalesce(regexp_full_match(ticker, '[A-Z][A-Z0-9.-]{{0,9}}'), false) THEN 'invalid_ticker'
    WHEN trade_date IS NULL THEN 'invalid_trade_date'
    WHEN NOT ({FIN('open_price')} AND {FIN('high_price')} AND {FIN('low_price')} AND {FIN('close_price')}
              AND open_price > 0 AND high_price > 0 AND low_price > 0 AND close_price > 0) THEN 'invalid_ohlc'
    WHEN high_price < low_price OR high_price < open_price OR high_price < close_price
         OR low_price > open_price OR low_price > close_price THEN 'inconsistent_ohlc'
    WHEN NOT {FIN('volume')} OR volume <= 0 OR volume % 1 <> 0 THEN 'invalid_volume'
  END AS reason
  FROM stock_parsed),
stock_final AS (
  SELECT *, COALESCE(reason, CASE WHEN ROW_NUMBER() OVER (
              PARTITION BY reason IS NULL, ticker, trade_date ORDER BY _input_order DESC) > 1
            THEN 'duplicate_key' END) AS final_reason
  FROM stock_tagged)"""

DIRTY_MACRO = """dirty_macro AS (
  SELECT event_id AS _input_order,
    CASE WHEN event_id % 23 = 0 THEN 'bad id!' ELSE event_type END AS series_id,
    CASE WHEN event_id % 29 = 0 THEN '  ' ELSE event_type END AS indicator_name,
    CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%d') END AS indicator_date,
    CASE WHEN event_id % 11 = 0 THEN '.' WHEN event_id % 13 = 0 THEN 'bad'
         WHEN event_id % 17 = 0 THEN 'inf' WHEN event_id % 19 = 0 THEN NULL
         ELSE CAST(value AS VARCHAR) END AS value
  FROM events)"""

MACRO_NORMALIZED = f"""macro_parsed AS (
  SELECT _input_order, upper({STRIP('series_id')}) AS series_id,
         {STRIP('indicator_name')} AS indicator_name,
         {DATE_('indicator_date')} AS indicator_date,
         {NUM("CASE WHEN value <> '.' THEN value END")} AS value
  FROM dirty_macro),
macro_tagged AS (
  SELECT *, CASE
    WHEN NOT coalesce(regexp_full_match(series_id, '[A-Z0-9_.-]{{1,64}}'), false) THEN 'invalid_series_id'
    WHEN NOT coalesce(length(indicator_name) BETWEEN 1 AND 128, false) THEN 'invalid_indicator_name'
    WHEN indicator_date IS NULL THEN 'invalid_indicator_date'
    WHEN NOT {FIN('value')} THEN 'invalid_value'
  END AS reason
  FROM macro_parsed),
macro_final AS (
  SELECT *, COALESCE(reason, CASE WHEN ROW_NUMBER() OVER (
              PARTITION BY reason IS NULL, series_id, indicator_date ORDER BY _input_order DESC) > 1
            THEN 'duplicate_key' END) AS final_reason
  FROM macro_tagged)"""

STOCK_REASONS = ("invalid_ticker", "invalid_trade_date", "invalid_ohlc", "inconsistent_ohlc",
                 "invalid_volume", "duplicate_key")
MACRO_REASONS = ("invalid_series_id", "invalid_indicator_name", "invalid_indicator_date",
                 "invalid_value", "duplicate_key")


def _metrics_sql(final: str, reasons) -> str:
    per = ",\n  ".join(f"CAST(count_if(final_reason = '{r}') AS BIGINT) AS dropped_{r}"
                        for r in reasons)
    return (f"SELECT count(*) AS rows_fetched,\n"
            f"  CAST(count_if(final_reason IS NULL) AS BIGINT) AS rows_valid,\n"
            f"  CAST(count_if(final_reason IS NOT NULL) AS BIGINT) AS rows_dropped,\n  {per}\nFROM {final}")


ORACLE.update({
    "normalize_stock_rows": with_(DIRTY_STOCK, STOCK_NORMALIZED) + """
SELECT _input_order, ticker, trade_date, """ + ", ".join(
        f"{NEAREST(c, 4)} AS {c}" for c in ("open_price", "high_price", "low_price", "close_price")) + """,
       CAST(CAST(volume AS BIGINT) AS VARCHAR) AS volume
FROM stock_final WHERE final_reason IS NULL""",
    "rejected_stock_rows": with_(DIRTY_STOCK, STOCK_NORMALIZED)
    + "SELECT _input_order, final_reason AS reason FROM stock_final WHERE final_reason IS NOT NULL",
    "stock_normalization_metrics": with_(DIRTY_STOCK, STOCK_NORMALIZED)
    + _metrics_sql("stock_final", STOCK_REASONS),
    "stock_reason_counts": with_(DIRTY_STOCK, STOCK_NORMALIZED)
    + "SELECT final_reason AS reason, count(*) AS rows FROM stock_final "
      "WHERE final_reason IS NOT NULL GROUP BY final_reason",
    "normalize_macro_rows": with_(DIRTY_MACRO, MACRO_NORMALIZED) + f"""
SELECT _input_order, series_id, indicator_name, indicator_date, {NEAREST("value", 6)} AS value
FROM macro_final WHERE final_reason IS NULL""",
    "rejected_macro_rows": with_(DIRTY_MACRO, MACRO_NORMALIZED)
    + "SELECT _input_order, final_reason AS reason FROM macro_final WHERE final_reason IS NOT NULL",
    "macro_normalization_metrics": with_(DIRTY_MACRO, MACRO_NORMALIZED)
    + _metrics_sql("macro_final", MACRO_REASONS),
})

# -- payloads ------------------------------------------------------------------

STOCK_BARS = """stock_bars AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
      PARTITION BY ticker, trade_date
      ORDER BY loaded_at DESC NULLS LAST, close_price DESC NULLS LAST, open_price DESC NULLS LAST,
               high_price DESC NULLS LAST, low_price DESC NULLS LAST, volume DESC NULLS LAST) AS rn
    FROM raw_stock_prices) b WHERE rn = 1),
stock_groups AS (
  SELECT *, ticker || ':' || strftime(trade_date, '%Y-%m') AS payload_id,
    (CAST(substr(ticker, 2) AS INTEGER) + year(trade_date) * 12 + month(trade_date)) % 37 AS code,
    ROW_NUMBER() OVER (PARTITION BY ticker, strftime(trade_date, '%Y-%m')
                       ORDER BY trade_date DESC) - 1 AS pos
  FROM stock_bars)"""

MACRO_POINTS = """macro_points AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
      PARTITION BY indicator_name, indicator_date
      ORDER BY loaded_at DESC NULLS LAST, value DESC NULLS LAST) AS rn
    FROM raw_macro_indicators) p WHERE rn = 1),
series_dim AS (
  SELECT * FROM (VALUES ('FEDFUNDS', 'Federal Funds Rate'), ('CPIAUCSL', 'Consumer Price Index'),
                        ('GDP', 'Gross Domestic Product'), ('UNRATE', 'Unemployment Rate'),
                        ('DGS10', '10 Year Treasury Rate')) t(series_id, indicator_name)),
macro_groups AS (
  SELECT p.*, d.series_id, d.series_id || ':' || CAST(year(indicator_date) AS VARCHAR) AS payload_id,
    (year(indicator_date) + length(d.series_id)) % 13 AS code,
    ROW_NUMBER() OVER (PARTITION BY d.series_id, year(indicator_date)
                       ORDER BY indicator_date DESC) - 1 AS pos
  FROM macro_points p JOIN series_dim d ON p.indicator_name = d.indicator_name)"""

STOCK_PAYLOAD_CHAIN = (RAW_STOCK, STOCK_BARS)
MACRO_PAYLOAD_CHAIN = (RAW_MACRO, MACRO_POINTS)


def DEC(x: str, s: int) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,{s})) AS VARCHAR)"


def PRICE(x: str) -> str:
    """A price as its payload text says it, normalised."""
    return NEAREST(f"CAST(CAST({x} AS DECIMAL(18,4)) AS DOUBLE)", 4)


HUGE = NEAREST("1e31::DOUBLE", 4)
HUGE_VOLUME = "'1' || repeat('0', 30)"
PRICES = ("open_price", "high_price", "low_price", "close_price")

# Every payload: the groups themselves (landed first) and the extra ones.
STOCK_LANDED = """stock_landed AS (
  SELECT DISTINCT payload_id, ticker, 0 AS landed, NULL AS error_code, code, payload_id AS base FROM stock_groups
  UNION ALL SELECT DISTINCT payload_id || ':error', ticker, 1, CASE
      WHEN code <= 2 THEN 'API_RATE_LIMITED' WHEN code <= 6 THEN 'API_DATA_UNAVAILABLE'
      ELSE 'API_RESPONSE_INVALID' END, code, NULL FROM stock_groups WHERE code BETWEEN 1 AND 9
  UNION ALL SELECT DISTINCT payload_id || ':huge', ticker, 1, NULL, code, NULL FROM stock_groups WHERE code = 10
  UNION ALL SELECT DISTINCT payload_id || ':ticker', 'bad ticker!', 1, NULL, code, payload_id FROM stock_groups
    WHERE code = 11)"""
MACRO_LANDED = """macro_landed AS (
  SELECT DISTINCT payload_id, series_id, indicator_name, 0 AS landed, NULL AS error_code FROM macro_groups
  UNION ALL SELECT DISTINCT payload_id || ':error', series_id, indicator_name, 1,
    CASE WHEN code <= 5 THEN 'API_DATA_UNAVAILABLE' ELSE 'API_RESPONSE_INVALID' END
  FROM macro_groups WHERE code BETWEEN 1 AND 8)"""

STOCK_PAYLOAD_CHAIN += (STOCK_LANDED,)
MACRO_PAYLOAD_CHAIN += (MACRO_LANDED,)

ORACLE.update({
    "classify_stock_payloads": with_(*STOCK_PAYLOAD_CHAIN)
    + "SELECT payload_id, ticker, error_code FROM stock_landed",
    "parse_stock_payloads": with_(*STOCK_PAYLOAD_CHAIN) + f"""
SELECT l.payload_id, l.ticker, g.pos AS _input_order, strftime(trade_date, '%Y-%m-%d') AS trade_date,
       {DEC('open_price', 4)} AS open_price, {DEC('high_price', 4)} AS high_price,
       {DEC('low_price', 4)} AS low_price, {DEC('close_price', 4)} AS close_price,
       CAST(volume AS VARCHAR) AS volume
FROM stock_groups g JOIN stock_landed l ON l.base = g.payload_id
UNION ALL SELECT payload_id, ticker, 0, '2099-01-01', '1e31', '1e31', '1e31', '1e31', '1e30'
FROM stock_landed WHERE ends_with(payload_id, ':huge')""",
    "ingest_stock_payloads": with_(*STOCK_PAYLOAD_CHAIN) + f"""
SELECT payload_id, pos AS _input_order, ticker, trade_date,
       {", ".join(f"{PRICE(c)} AS {c}" for c in PRICES)}, CAST(volume AS VARCHAR) AS volume
FROM stock_groups WHERE close_price IS NOT NULL AND volume > 0
UNION ALL SELECT payload_id, 0, ticker, DATE '2099-01-01', {HUGE}, {HUGE}, {HUGE}, {HUGE}, {HUGE_VOLUME}
FROM stock_landed WHERE ends_with(payload_id, ':huge')""",
    "classify_macro_payloads": with_(*MACRO_PAYLOAD_CHAIN)
    + "SELECT payload_id, series_id, indicator_name, error_code FROM macro_landed",
    "parse_macro_payloads": with_(*MACRO_PAYLOAD_CHAIN) + f"""
SELECT payload_id, series_id, indicator_name, pos AS _input_order,
       strftime(indicator_date, '%Y-%m-%d') AS indicator_date,
       coalesce({DEC('value', 2)}, '.') AS value
FROM macro_groups""",
    "ingest_macro_payloads": with_(*MACRO_PAYLOAD_CHAIN) + f"""
SELECT payload_id, pos AS _input_order, series_id, indicator_name, indicator_date,
       {NEAREST("CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)", 6)} AS value
FROM macro_groups WHERE value IS NOT NULL""",
    "latest_observations": with_(*MACRO_CHAIN) + """
SELECT indicator_name, indicator_date, value, loaded_at FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY indicator_name ORDER BY indicator_date DESC) AS rn
  FROM stg_macro_indicators) t WHERE rn <= 100""",
})

# -- single metrics -----------------------------------------------------------------

ORACLE.update({
    "daily_returns": with_(*PORTFOLIO_CHAIN)
    + "SELECT ticker, trade_date, close_price, prev_close_price, daily_return_pct FROM mart_portfolio",
    "moving_averages": with_(*PORTFOLIO_CHAIN)
    + "SELECT ticker, trade_date, ma_20day, ma_50day FROM mart_portfolio",
    "rolling_volatility": with_(*PORTFOLIO_CHAIN)
    + "SELECT ticker, trade_date, rolling_volatility_20d FROM mart_portfolio",
    "drawdown": with_(*PORTFOLIO_CHAIN)
    + "SELECT ticker, trade_date, cumulative_return_pct, running_peak, drawdown_pct FROM mart_portfolio",
    "risk_metrics": with_(*RISK_CHAIN)
    + "SELECT ticker, trade_date, sharpe_ratio_20d, max_drawdown_pct, var_95_pct, avg_volume_20d FROM mart_risk",
    "macro_changes": with_(*MACRO_CHAIN, MACRO_CHANGE) + "SELECT * FROM macro_changes",
    "stock_macro_join": with_(*PORTFOLIO_CHAIN, *MACRO_CHAIN, MACRO_CHANGE, JOINED)
    + "SELECT * FROM stock_macro",
})

# -- upsert ---------------------------------------------------------------------------

STOCK_ORDER_SQL = ("loaded_at DESC NULLS LAST, close_price DESC NULLS LAST, open_price DESC NULLS LAST, "
                   "high_price DESC NULLS LAST, low_price DESC NULLS LAST, volume DESC NULLS LAST")


def _ups_stock(name: str, residue: int) -> str:
    return f"""{name} AS (
  SELECT ticker, trade_date, open_price, high_price, low_price, close_price, volume, loaded_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, trade_date ORDER BY {STOCK_ORDER_SQL}) AS rn
        FROM raw_stock_prices
        WHERE close_price IS NOT NULL AND volume > 0 AND source_key % 3 <> {residue}) x
  WHERE rn = 1)"""


def _ups_macro(name: str, residue: int) -> str:
    return f"""{name} AS (
  SELECT indicator_name, indicator_date, value, loaded_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY indicator_name, indicator_date
                                     ORDER BY loaded_at DESC NULLS LAST, value DESC NULLS LAST) AS rn
        FROM raw_macro_indicators WHERE value IS NOT NULL AND source_key % 3 <> {residue}) x
  WHERE rn = 1)"""


def _merge_ctes(keys, values) -> str:
    """``merged`` (the labelled full outer join) and ``merged_rows`` (the new snapshot rows)."""
    k0 = keys[0]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    differs = " OR ".join(f"t.{v} IS DISTINCT FROM s.{v}" for v in values)
    cols = [*keys, *values, "loaded_at"]
    pick = ",\n         ".join(
        f"CASE WHEN _action IN ('insert', 'update') THEN s_{c} ELSE t_{c} END AS {c}" for c in cols)
    tsel = ", ".join(f"t.{c} AS t_{c}" for c in cols)
    ssel = ", ".join(f"s.{c} AS s_{c}" for c in cols)
    return f"""merged AS (
  SELECT {tsel}, {ssel},
    CASE WHEN t.{k0} IS NULL THEN 'insert' WHEN s.{k0} IS NULL THEN 'keep'
         WHEN {differs} THEN 'update' ELSE 'unchanged' END AS _action
  FROM ups_target t FULL OUTER JOIN ups_source s ON {on}),
merged_rows AS (
  SELECT {pick}, _action FROM merged)"""


STOCK_KEYS = ("ticker", "trade_date")
STOCK_VALUES = ("open_price", "high_price", "low_price", "close_price", "volume")
STOCK_MERGE_CHAIN = (RAW_STOCK, _ups_stock("ups_target", 1), _ups_stock("ups_source", 2),
                     _merge_ctes(STOCK_KEYS, STOCK_VALUES))
MACRO_MERGE_CHAIN = (RAW_MACRO, _ups_macro("ups_target", 1), _ups_macro("ups_source", 2),
                     _merge_ctes(("indicator_name", "indicator_date"), ("value",)))

ORACLE.update({
    "upsert_stock_prices": with_(*STOCK_MERGE_CHAIN) + "SELECT * FROM merged_rows",
    "upsert_macro_indicators": with_(*MACRO_MERGE_CHAIN) + "SELECT * FROM merged_rows",
    "merge_counts": with_(*STOCK_MERGE_CHAIN) + """
SELECT ticker, CAST(count_if(_action = 'insert') AS BIGINT) AS rows_inserted,
       CAST(count_if(_action = 'update') AS BIGINT) AS rows_updated,
       CAST(count_if(_action = 'unchanged') AS BIGINT) AS rows_unchanged
FROM merged_rows WHERE _action <> 'keep' GROUP BY ticker""",
})

# -- audit log (B7) -------------------------------------------------------------------

LOGS = """pipeline_logs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id,
    ts - to_microseconds(CAST(floor(value * 1000) AS BIGINT)) AS run_timestamp,
    ts AS completed_at,
    CASE WHEN event_id % 101 = 0 THEN 'OTHER' WHEN event_id % 2 = 0 THEN 'STOCK_INGESTION'
         ELSE 'MACRO_INGESTION' END AS pipeline_name,
    'U' || CAST(user_id AS VARCHAR) AS entity_name,
    k AS rows_fetched,
    CASE WHEN event_type = 'purchase' THEN 0 ELSE k - k % 4 END AS rows_valid,
    CASE WHEN event_type IN ('click', 'view') THEN k - k % 4 ELSE 0 END AS rows_inserted,
    CAST(0 AS BIGINT) AS rows_updated,
    CASE WHEN event_type = 'signup' THEN k - k % 4 ELSE 0 END AS rows_unchanged,
    CAST(CASE WHEN event_type = 'purchase' THEN k ELSE k % 4 END
         + CASE WHEN event_id % 103 = 0 THEN 1 ELSE 0 END AS BIGINT) AS rows_dropped,
    CASE event_type WHEN 'click' THEN 'SUCCESS' WHEN 'view' THEN 'PARTIAL_SUCCESS'
         WHEN 'signup' THEN 'NO_CHANGES' WHEN 'purchase' THEN 'NO_VALID_ROWS'
         WHEN 'error' THEN 'FAILED' END AS status,
    CAST(floor(value) AS BIGINT) AS duration_ms,
    CASE WHEN event_type = 'error' THEN CASE event_id % 3 WHEN 0 THEN 'API_TIMEOUT'
         WHEN 1 THEN 'API_RATE_LIMITED' ELSE 'SNOWFLAKE_LOAD_ERROR' END END AS error_code,
    CASE WHEN event_type = 'error' THEN
      'GET https://api.example/query?symbol=U' || CAST(user_id AS VARCHAR) || '&apikey=K'
      || CAST(event_id AS VARCHAR) || ' failed' || chr(13) || chr(10) || 'token=T'
      || CAST(event_id AS VARCHAR)
      || CASE WHEN event_id % 5 = 0 THEN ' password hunter2' ELSE '' END
      || ' ' || repeat('x', CAST(event_id % 600 AS INTEGER)) END AS error_message
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e)"""

COUNT_VIOLATION = """(rows_fetched < 0 OR rows_valid < 0 OR rows_inserted < 0 OR rows_updated < 0
   OR rows_unchanged < 0 OR rows_dropped < 0 OR duration_ms < 0
   OR (status <> 'FAILED' AND rows_valid + rows_dropped <> rows_fetched)
   OR (status IN ('SUCCESS', 'PARTIAL_SUCCESS', 'NO_CHANGES')
       AND rows_inserted + rows_updated + rows_unchanged <> rows_valid))"""
STATUS_VIOLATION = """(status NOT IN ('SUCCESS', 'PARTIAL_SUCCESS', 'NO_CHANGES', 'NO_VALID_ROWS', 'FAILED')
   OR pipeline_name NOT IN ('STOCK_INGESTION', 'MACRO_INGESTION'))"""


def REDACT(x: str, secrets=("hunter2",)) -> str:
    e = f"CASE WHEN coalesce({x}, '') = '' THEN 'Pipeline processing failed.' ELSE {x} END"
    for sec in secrets:
        e = f"replace({e}, '{sec}', '[REDACTED]')"
    e = (f"regexp_replace({e}, '(api[_-]?key|apikey|password|token|secret)\\s*[=:]\\s*[^\\s&,;]+', "
         f"'\\1=[REDACTED]', 'gi')")
    e = f"regexp_replace({e}, '([?&](?:api_key|apikey|token)=)[^&\\s]+', '\\1[REDACTED]', 'gi')"
    e = f"translate({e}, chr(13) || chr(10), '  ')"
    return f"substr({e}, 1, 500)"


LOG_COLS_14 = ("run_id, completed_at, pipeline_name, entity_name, status, rows_fetched, rows_valid, "
               "rows_inserted, rows_updated, rows_unchanged, rows_dropped, duration_ms, error_code")

ORACLE.update({
    "dq_log_counts": with_(LOGS) + f"SELECT run_id FROM pipeline_logs WHERE {COUNT_VIOLATION}",
    "dq_log_status": with_(LOGS) + f"SELECT run_id FROM pipeline_logs WHERE {STATUS_VIOLATION}",
    "run_log_violations": with_(LOGS) + f"""
SELECT run_id, pipeline_name, status, violation FROM (
  SELECT *, CASE
    WHEN coalesce({STATUS_VIOLATION}, false) THEN 'metadata'
    WHEN coalesce({COUNT_VIOLATION}, false) THEN 'counts'
    WHEN coalesce(status = 'NO_VALID_ROWS' AND (rows_valid <> 0 OR rows_inserted <> 0
         OR rows_updated <> 0 OR rows_unchanged <> 0), false) THEN 'no_valid_rows' END AS violation
  FROM pipeline_logs) v WHERE violation IS NOT NULL""",
    "redact_messages": with_(LOGS)
    + f"SELECT run_id, {REDACT('error_message')} AS error_message FROM pipeline_logs "
      "WHERE error_message IS NOT NULL",
    "run_summary": with_(LOGS) + """
SELECT pipeline_name, count(*) AS entity_runs,
       CAST(count_if(status = 'FAILED') AS BIGINT) AS failed_runs,
       bool_or(status = 'FAILED') AS any_failed,
       CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
       CAST(sum(rows_updated) AS BIGINT) AS rows_updated
FROM pipeline_logs GROUP BY pipeline_name""",
    "failed_recent": with_(LOGS) + f"""
SELECT count(*) AS failed_count FROM pipeline_logs
WHERE status = 'FAILED' AND completed_at >= {AS_OF_SQL} - INTERVAL 7 DAY""",
    "recent_runs": with_(LOGS) + f"""
SELECT {LOG_COLS_14}, substr(error_message, 1, 160) AS error_message
FROM pipeline_logs ORDER BY completed_at DESC, run_id DESC LIMIT 20""",
    "recent_run_totals": with_(LOGS) + """
SELECT CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
       CAST(sum(rows_updated) AS BIGINT) AS rows_updated,
       CAST(sum(rows_unchanged) AS BIGINT) AS rows_unchanged,
       CAST(sum(rows_dropped) AS BIGINT) AS rows_dropped
FROM (SELECT * FROM pipeline_logs ORDER BY completed_at DESC, run_id DESC LIMIT 20) r""",
    "latest_stock_run": with_(LOGS) + """
SELECT entity_name, completed_at, status FROM pipeline_logs
WHERE pipeline_name = 'STOCK_INGESTION'
  AND status IN ('SUCCESS', 'PARTIAL_SUCCESS', 'NO_CHANGES', 'NO_VALID_ROWS')
ORDER BY completed_at DESC, run_id DESC LIMIT 1""",
    "latest_macro_run": with_(LOGS) + """
SELECT entity_name, completed_at, status FROM pipeline_logs
WHERE pipeline_name = 'MACRO_INGESTION'
  AND status IN ('SUCCESS', 'PARTIAL_SUCCESS', 'NO_CHANGES', 'NO_VALID_ROWS')
ORDER BY completed_at DESC, run_id DESC LIMIT 1""",
})

# -- runs: payloads merged one after the other -----------------------------------------------

RUN_STARTED = "2024-01-31 00:00:00"
RUN_COMPLETED = "2024-01-31 00:05:00"
RUN_KEY = "run-1"


def _sequence(rows: str, keys, values) -> str:
    """``steps``: each row of ``rows`` (payload_id, landed, keys, values) with what it did to the
    state that the payloads before it left, starting from ``ups_target``."""
    on = " AND ".join(f"{{0}}.{k} = r.{k}" for k in keys)
    now = "row(" + ", ".join(f"r.{v}" for v in values) + ")"
    old = "row(" + ", ".join(f"p.{v}" for v in values) + ")"
    start = "row(" + ", ".join(f"t.{v}" for v in values) + ")"
    return f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(keys)} ORDER BY landed, payload_id) AS turn,
         count(*) OVER (PARTITION BY {", ".join(keys)}) AS turns
  FROM {rows}),
steps AS (
  SELECT r.*, t.loaded_at AS old_loaded_at, CASE
      WHEN p.turn IS NULL AND t.{keys[0]} IS NULL THEN 'insert'
      WHEN p.turn IS NOT NULL AND {now} IS DISTINCT FROM {old} THEN 'update'
      WHEN p.turn IS NULL AND {now} IS DISTINCT FROM {start} THEN 'update'
      ELSE 'unchanged' END AS did
  FROM numbered r
  LEFT JOIN numbered p ON {on.format("p")} AND p.turn = r.turn - 1
  LEFT JOIN ups_target t ON {on.format("t")}),
step_counts AS (
  SELECT payload_id, count_if(did = 'insert') AS rows_inserted, count_if(did = 'update') AS rows_updated,
         count_if(did = 'unchanged') AS rows_unchanged
  FROM steps GROUP BY payload_id)"""


_COUNTS = ("rows_valid", "rows_inserted", "rows_updated", "rows_unchanged", "rows_dropped")
_STATUS = """CASE WHEN error_code IS NOT NULL THEN 'FAILED' WHEN rows_valid = 0 THEN 'NO_VALID_ROWS'
         WHEN rows_inserted = 0 AND rows_updated = 0 THEN 'NO_CHANGES'
         WHEN rows_dropped > 0 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END"""


def _run_counts(landed: str, fetched: str, entity: str) -> str:
    """``run_counts``: one row per payload of ``landed`` with its counts and status.

    ``fetched`` has payload_id and ``ok`` for every row of every usable payload.
    """
    return f"""payload_metrics AS (
  SELECT payload_id, count(*) AS rows_fetched, count_if(ok) AS rows_valid, count_if(NOT ok) AS rows_dropped
  FROM {fetched} GROUP BY payload_id),
run_counts AS (
  SELECT *, {_STATUS} AS status FROM (
    SELECT l.payload_id, {entity} AS entity_name, l.error_code,
      {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("rows_fetched", *_COUNTS))}
    FROM {landed} l LEFT JOIN payload_metrics m ON m.payload_id = l.payload_id
    LEFT JOIN step_counts s ON s.payload_id = l.payload_id) c)"""


def _log_rows(pipeline: str) -> str:
    return f"""
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
         || '-' || substr(h, 21, 12) AS run_id,
  TIMESTAMP '{RUN_STARTED}' AS run_timestamp, TIMESTAMP '{RUN_COMPLETED}' AS completed_at,
  '{pipeline}' AS pipeline_name, entity_name, rows_fetched, rows_valid, rows_inserted, rows_updated,
  rows_unchanged, rows_dropped, status, CAST(300000 AS BIGINT) AS duration_ms, error_code,
  CASE error_code WHEN 'API_RESPONSE_INVALID' THEN 'Provider response was invalid.'
       WHEN 'API_RATE_LIMITED' THEN 'Provider request was rate limited.'
       WHEN 'NORMALIZATION_ERROR' THEN 'Batch could not be normalised.'
       WHEN 'API_DATA_UNAVAILABLE' THEN 'Provider data was unavailable.' END AS error_message
FROM (SELECT *, md5('{pipeline}|' || payload_id || '|{RUN_KEY}') AS h FROM run_counts) r"""


_STATUS_ROWS = f"SELECT payload_id, {', '.join(_COUNTS)}, status FROM run_counts"


def _new_snapshot(keys, values, shown) -> str:
    """Keys no payload has as they were; the others as the last payload left them."""
    by = ", ".join(keys)
    return f"""
SELECT {by}, {", ".join(shown)}, CASE WHEN bool_or(did <> 'unchanged') OVER (PARTITION BY {by})
    THEN TIMESTAMP '{RUN_STARTED}' ELSE old_loaded_at END AS loaded_at
FROM steps QUALIFY turn = turns
UNION ALL SELECT {by}, {", ".join(shown)}, loaded_at FROM ups_target t
WHERE NOT EXISTS (SELECT 1 FROM steps s WHERE {" AND ".join(f"s.{k} = t.{k}" for k in keys)})"""


MACRO_KEYS, MACRO_VALUES = ("indicator_name", "indicator_date"), ("value",)
_VALUE = NEAREST("CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)", 6)

STOCK_RUN_CHAIN = (*STOCK_PAYLOAD_CHAIN, _ups_stock("ups_target", 1), f"""stock_fetched AS (
  SELECT payload_id, close_price IS NOT NULL AND volume > 0 AS ok FROM stock_groups
  UNION ALL SELECT payload_id, true FROM stock_landed WHERE ends_with(payload_id, ':huge')),
stock_valid AS (
  SELECT payload_id, 0 AS landed, ticker, trade_date, {", ".join(f"{PRICE(c)} AS {c}" for c in PRICES)},
         CAST(volume AS DECIMAL(38,0)) AS volume
  FROM stock_groups WHERE close_price IS NOT NULL AND volume > 0
  UNION ALL SELECT payload_id, 1, ticker, DATE '2099-01-01', {HUGE}, {HUGE}, {HUGE}, {HUGE},
    CAST({HUGE_VOLUME} AS DECIMAL(38,0))
  FROM stock_landed WHERE ends_with(payload_id, ':huge')),
stock_entities AS (
  SELECT * REPLACE (CASE WHEN ticker = 'bad ticker!' THEN 'NORMALIZATION_ERROR' ELSE error_code END AS error_code)
  FROM stock_landed)""", _sequence("stock_valid", STOCK_KEYS, STOCK_VALUES),
    _run_counts("stock_entities", "stock_fetched", "upper(l.ticker)"))

MACRO_RUN_CHAIN = (*MACRO_PAYLOAD_CHAIN, _ups_macro("ups_target", 1), f"""macro_fetched AS (
  SELECT payload_id, value IS NOT NULL AS ok FROM macro_groups),
macro_valid AS (
  SELECT payload_id, 0 AS landed, indicator_name, indicator_date, {_VALUE} AS value
  FROM macro_groups WHERE value IS NOT NULL)""", _sequence("macro_valid", MACRO_KEYS, MACRO_VALUES),
    _run_counts("macro_landed", "macro_fetched", "l.indicator_name"))

STOCK_OVERLAP_CHAIN = (RAW_STOCK, _ups_stock("ups_target", 1), f"""fetched AS (
  SELECT * EXCLUDE (rn), close_price IS NOT NULL AND volume > 0 AS ok,
    ticker || ':' || strftime(trade_date, '%Y-%m') || ':' || CAST(landed AS VARCHAR) AS payload_id
  FROM (SELECT *, source_key % 3 AS landed, row_number() OVER (
          PARTITION BY ticker, trade_date, source_key % 3 ORDER BY {STOCK_ORDER_SQL}) AS rn
        FROM raw_stock_prices) x WHERE rn = 1),
landed_payloads AS (SELECT DISTINCT payload_id, ticker, NULL AS error_code FROM fetched),
stock_valid AS (
  SELECT payload_id, landed, ticker, trade_date, {", ".join(f"{PRICE(c)} AS {c}" for c in PRICES)}, volume
  FROM fetched WHERE ok)""", _sequence("stock_valid", STOCK_KEYS, STOCK_VALUES),
    _run_counts("landed_payloads", "fetched", "ticker"))

MACRO_OVERLAP_CHAIN = (RAW_MACRO, _ups_macro("ups_target", 1), f"""series_dim AS (
  SELECT * FROM (VALUES ('FEDFUNDS', 'Federal Funds Rate'), ('CPIAUCSL', 'Consumer Price Index'),
                        ('GDP', 'Gross Domestic Product'), ('UNRATE', 'Unemployment Rate'),
                        ('DGS10', '10 Year Treasury Rate')) t(series_id, indicator_name)),
fetched AS (
  SELECT x.*, value IS NOT NULL AS ok,
    series_id || ':' || CAST(year(indicator_date) AS VARCHAR) || ':' || CAST(landed AS VARCHAR) AS payload_id
  FROM (SELECT *, source_key % 3 AS landed, row_number() OVER (
          PARTITION BY indicator_name, indicator_date, source_key % 3
          ORDER BY loaded_at DESC NULLS LAST, value DESC NULLS LAST) AS rn
        FROM raw_macro_indicators) x JOIN series_dim USING (indicator_name) WHERE rn = 1),
landed_payloads AS (SELECT DISTINCT payload_id, indicator_name, NULL AS error_code FROM fetched),
macro_valid AS (
  SELECT payload_id, landed, indicator_name, indicator_date, {_VALUE} AS value FROM fetched WHERE ok)""",
    _sequence("macro_valid", MACRO_KEYS, MACRO_VALUES),
    _run_counts("landed_payloads", "fetched", "indicator_name"))

_STOCK_SHOWN = (*PRICES, "CAST(CAST(volume AS DECIMAL(38,0)) AS VARCHAR) AS volume")

ORACLE.update({
    "run_log": with_(*STOCK_RUN_CHAIN) + _log_rows("STOCK_INGESTION"),
    "run_status": with_(*STOCK_RUN_CHAIN) + "SELECT payload_id, status FROM run_counts",
    "macro_run_log": with_(*MACRO_RUN_CHAIN) + _log_rows("MACRO_INGESTION"),
    "ingest_overlapping_stock": with_(*STOCK_OVERLAP_CHAIN) + _STATUS_ROWS,
    "ingest_overlapping_macro": with_(*MACRO_OVERLAP_CHAIN) + _STATUS_ROWS,
    "overlapping_stock_snapshot": with_(*STOCK_OVERLAP_CHAIN)
    + _new_snapshot(STOCK_KEYS, STOCK_VALUES, _STOCK_SHOWN),
    "overlapping_macro_snapshot": with_(*MACRO_OVERLAP_CHAIN) + _new_snapshot(MACRO_KEYS, MACRO_VALUES, ("value",)),
})

# -- data quality ---------------------------------------------------------------------------

RAW_STOCK_FAULTY = RAW_STOCK.replace("raw_stock_prices AS (", "raw_stock_clean AS (", 1) + """,
raw_stock_prices AS (
  SELECT source_key,
    CASE WHEN source_key % 61 = 0 THEN lower(ticker) ELSE ticker END AS ticker, trade_date,
    CASE WHEN source_key % 59 = 0 THEN -open_price ELSE open_price END AS open_price,
    CASE WHEN source_key % 53 = 0 THEN low_price ELSE high_price END AS high_price,
    CASE WHEN source_key % 53 = 0 THEN high_price ELSE low_price END AS low_price,
    close_price, volume, loaded_at
  FROM raw_stock_clean)"""
RAW_MACRO_FAULTY = RAW_MACRO.replace("raw_macro_indicators AS (", "raw_macro_clean AS (", 1) + """,
raw_macro_indicators AS (
  SELECT source_key,
    CASE WHEN source_key % 71 = 0 THEN 'Unknown Series'
         WHEN source_key % 67 = 0 THEN lower(indicator_name) ELSE indicator_name END AS indicator_name,
    indicator_date, value, loaded_at
  FROM raw_macro_clean)"""

NOT_NULL = {
    "stg_stock_prices": ("ticker", "trade_date", "close_price", "volume", "loaded_at"),
    "stg_macro_indicators": ("indicator_name", "indicator_date", "value", "loaded_at"),
    "mart_portfolio": ("ticker", "trade_date", "close_price", "updated_at"),
    "mart_risk": ("ticker", "trade_date", "cumulative_return_pct", "updated_at"),
    "mart_macro_correlation": ("ticker", "indicator_name", "trade_date", "indicator_value",
                               "updated_at"),
}
ACCEPTED = ("'CONSUMER PRICE INDEX', 'FEDERAL FUNDS RATE', 'GROSS DOMESTIC PRODUCT', "
            "'UNEMPLOYMENT RATE', '10 YEAR TREASURY RATE'")
OHLCV_VIOLATION = """(open_price <= 0 OR high_price <= 0 OR low_price <= 0 OR close_price <= 0
   OR volume <= 0 OR high_price < open_price OR high_price < low_price OR high_price < close_price
   OR low_price > open_price OR low_price > high_price OR low_price > close_price)"""

DQ_CHAIN = (RAW_STOCK_FAULTY, STG_STOCK, RAW_MACRO_FAULTY, STG_MACRO, PORTFOLIO, RISK, MACRO_CHANGE,
            JOINED, CORRELATION, LOGS)


def _not_null_sql(check_names: bool) -> str:
    parts = []
    for model, cols in NOT_NULL.items():
        for c in cols:
            label = (f"'not_null_{model}_{c}' AS check_name" if check_names
                     else f"'{model}' AS model, '{c}' AS column_name")
            parts.append(f"SELECT {label}, CAST(count_if({c} IS NULL) AS BIGINT) AS failures "
                         f"FROM {model}")
    return "\nUNION ALL ".join(parts)


ORACLE.update({
    "dq_not_null": with_(*DQ_CHAIN) + _not_null_sql(False),
    "dq_accepted_values": with_(*DQ_CHAIN)
    + f"SELECT * FROM stg_macro_indicators WHERE indicator_name NOT IN ({ACCEPTED})",
    "dq_unique_stock_key": with_(*DQ_CHAIN) + """
SELECT ticker, trade_date, count(*) AS row_count FROM stg_stock_prices
GROUP BY ticker, trade_date HAVING count(*) > 1""",
    "dq_unique_macro_key": with_(*DQ_CHAIN) + """
SELECT indicator_name, indicator_date, count(*) AS row_count FROM stg_macro_indicators
GROUP BY indicator_name, indicator_date HAVING count(*) > 1""",
    "dq_valid_ohlcv": with_(*DQ_CHAIN)
    + f"SELECT ticker, trade_date FROM stg_stock_prices WHERE {OHLCV_VIOLATION}",
    "dq_report": with_(*DQ_CHAIN) + f"""
SELECT check_name, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (
{_not_null_sql(True)}
UNION ALL SELECT 'accepted_values_stg_macro_indicators_indicator_name', count(*)
  FROM stg_macro_indicators WHERE indicator_name NOT IN ({ACCEPTED})
UNION ALL SELECT 'assert_unique_stock_key', count(*) FROM (SELECT ticker, trade_date
  FROM stg_stock_prices GROUP BY ticker, trade_date HAVING count(*) > 1) d
UNION ALL SELECT 'assert_unique_macro_key', count(*) FROM (SELECT indicator_name, indicator_date
  FROM stg_macro_indicators GROUP BY indicator_name, indicator_date HAVING count(*) > 1) d
UNION ALL SELECT 'assert_valid_stock_ohlcv', count(*) FROM stg_stock_prices WHERE {OHLCV_VIOLATION}
UNION ALL SELECT 'assert_pipeline_log_counts', count(*) FROM pipeline_logs WHERE {COUNT_VIOLATION}
UNION ALL SELECT 'assert_pipeline_log_status', count(*) FROM pipeline_logs WHERE {STATUS_VIOLATION}
) c""",
    "source_freshness": with_(RAW_STOCK) + f"""
SELECT 'raw_stock_prices' AS source_name, max(loaded_at) AS max_loaded_at,
  CAST(floor((epoch_us({AS_OF_SQL}) - epoch_us(max(loaded_at))) / 1000000) AS BIGINT) AS age_seconds,
  CASE WHEN max(loaded_at) IS NULL THEN 'error'
       WHEN epoch_us({AS_OF_SQL}) - epoch_us(max(loaded_at)) > 7 * 86400000000 THEN 'error'
       WHEN epoch_us({AS_OF_SQL}) - epoch_us(max(loaded_at)) > 3 * 86400000000 THEN 'warn'
       ELSE 'pass' END AS status
FROM raw_stock_prices""",
})

# -- dashboard reads ---------------------------------------------------------------------------

SUMMARY = f"""summary AS (
  SELECT ticker, MAX(close_price) AS max_price, MIN(close_price) AS min_price,
         {R('AVG(rolling_volatility_20d)', 2)} AS avg_volatility,
         {R('MAX(cumulative_return_pct)', 2)} AS best_return,
         {R('MIN(drawdown_pct)', 2)} AS max_drawdown
  FROM mart_portfolio GROUP BY ticker)"""
MA_TICKER = "S1"
FOCUS_INDICATOR = "10 YEAR TREASURY RATE"

ORACLE.update({
    "portfolio_summary": with_(*PORTFOLIO_CHAIN, SUMMARY) + "SELECT * FROM summary",
    "portfolio_extremes": with_(*PORTFOLIO_CHAIN, SUMMARY) + """
SELECT
  (SELECT ticker FROM summary WHERE best_return IS NOT NULL ORDER BY best_return DESC, ticker LIMIT 1)
    AS best_ticker,
  (SELECT ticker FROM summary WHERE best_return IS NOT NULL ORDER BY best_return ASC, ticker LIMIT 1)
    AS worst_ticker,
  (SELECT ticker FROM summary WHERE avg_volatility IS NOT NULL
   ORDER BY avg_volatility DESC, ticker LIMIT 1) AS most_volatile_ticker,
  (SELECT max(best_return) FROM summary) AS best_return,
  (SELECT min(best_return) FROM summary) AS worst_return,
  (SELECT max(avg_volatility) FROM summary) AS avg_volatility,
  (SELECT count(*) FROM summary) AS tickers_tracked""",
    "ticker_list": with_(*PORTFOLIO_CHAIN) + "SELECT DISTINCT ticker FROM mart_portfolio",
    "indicator_list": with_(*CORRELATION_CHAIN)
    + "SELECT DISTINCT indicator_name FROM mart_macro_correlation WHERE indicator_name IS NOT NULL",
    "indicator_coverage": with_(*CORRELATION_CHAIN) + """
SELECT indicator_name, bool_or(rolling_correlation_20d IS NOT NULL) AS has_correlation
FROM mart_macro_correlation GROUP BY indicator_name""",
    "price_history": with_(*PORTFOLIO_CHAIN) + """
SELECT ticker, trade_date, close_price, ma_20day, ma_50day, rolling_volatility_20d, daily_return_pct
FROM mart_portfolio""",
    "moving_average_series": with_(*PORTFOLIO_CHAIN) + f"""
SELECT trade_date, close_price, ma_20day, ma_50day FROM mart_portfolio WHERE ticker = '{MA_TICKER}'""",
    "risk_series": with_(*RISK_CHAIN) + """
SELECT ticker, trade_date, rolling_volatility_20d, sharpe_ratio_20d, max_drawdown_pct, var_95_pct,
       cumulative_return_pct FROM mart_risk""",
    "macro_series": with_(*CORRELATION_CHAIN) + f"""
SELECT ticker, trade_date, indicator_name, indicator_value, rolling_correlation_20d
FROM mart_macro_correlation WHERE indicator_name = '{FOCUS_INDICATOR}'""",
    "latest_indicator_values": with_(*CORRELATION_CHAIN) + f"""
SELECT ticker, max(trade_date) AS trade_date,
       {R('arg_max(indicator_value, trade_date)', 2)} AS indicator_value
FROM mart_macro_correlation WHERE indicator_name = '{FOCUS_INDICATOR}' GROUP BY ticker""",
})

# -- written tables, refreshed marts, selections ------------------------------------------------

WATCHED_REGION = "EUROPE"
WATCHED = f"""watched AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = '{WATCHED_REGION}'
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR)
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = '{WATCHED_REGION}')"""
_WATCHED_ONLY = " ticker IN (SELECT ticker FROM watched)"
_WATCHED_SUMMARY = SUMMARY.replace("FROM mart_portfolio GROUP", f"FROM mart_portfolio WHERE{_WATCHED_ONLY} GROUP")
_SECOND_COUNTS = """
SELECT status, count(*) AS runs, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
       CAST(sum(rows_updated) AS BIGINT) AS rows_updated, CAST(sum(rows_unchanged) AS BIGINT) AS rows_unchanged,
       CAST(sum(rows_dropped) AS BIGINT) AS rows_dropped
FROM """

ORACLE.update({
    "staging_view": ORACLE["stg_stock_prices"],
    "audit_log_table": with_(LOGS) + "SELECT * FROM pipeline_logs",
    "published_portfolio": ORACLE["mart_portfolio"],
    "bucketed_upsert_stock_prices": ORACLE["upsert_stock_prices"],
    # a refreshed mart is the mart of all rows
    "refreshed_mart_portfolio": ORACLE["mart_portfolio"],
    "refreshed_mart_risk": ORACLE["mart_risk"],
    # the runs leave what one run after the other does
    "interleaved_stock_snapshot": ORACLE["overlapping_stock_snapshot"],
    "interleaved_stock_log": with_(*STOCK_OVERLAP_CHAIN) + _SECOND_COUNTS + "run_counts GROUP BY status",
    # every valid row of the second run is there already
    "rerun_stock_log": with_(*STOCK_RUN_CHAIN) + _SECOND_COUNTS + f"""(
  SELECT * REPLACE ({_STATUS} AS status) FROM (
    SELECT * REPLACE (0 AS rows_inserted, 0 AS rows_updated, rows_valid AS rows_unchanged) FROM run_counts) r) s
GROUP BY status""",
    "selected_price_history": with_(*PORTFOLIO_CHAIN, WATCHED) + f"""
SELECT ticker, trade_date, close_price, ma_20day, ma_50day, rolling_volatility_20d, daily_return_pct
FROM mart_portfolio WHERE{_WATCHED_ONLY}""",
    "selected_risk_series": with_(*RISK_CHAIN, WATCHED) + f"""
SELECT ticker, trade_date, rolling_volatility_20d, sharpe_ratio_20d, max_drawdown_pct, var_95_pct,
       cumulative_return_pct FROM mart_risk WHERE{_WATCHED_ONLY}""",
    "selected_macro_series": with_(*CORRELATION_CHAIN, WATCHED) + f"""
SELECT ticker, trade_date, indicator_name, indicator_value, rolling_correlation_20d
FROM mart_macro_correlation WHERE indicator_name = '{FOCUS_INDICATOR}' AND{_WATCHED_ONLY}""",
    "selected_summary": with_(*PORTFOLIO_CHAIN, WATCHED, _WATCHED_SUMMARY) + "SELECT * FROM summary",
    "bound_summary": with_(*PORTFOLIO_CHAIN, WATCHED, _WATCHED_SUMMARY) + "SELECT * FROM summary",
    "selected_extremes": ORACLE["portfolio_extremes"].replace(SUMMARY, f"{WATCHED}, {_WATCHED_SUMMARY}").replace(
        "(SELECT count(*) FROM summary)", "(SELECT count(DISTINCT ticker) FROM watched)"),
    "empty_selection_summary": with_(*PORTFOLIO_CHAIN, SUMMARY) + "SELECT * FROM summary WHERE false",
})
