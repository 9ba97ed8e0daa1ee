"""RAW-shaped inputs derived from the supplied tables.

The reference lands API payloads into RAW tables; here the same shapes are
derived, row for row, from the TPC-H-like tables so every operator runs over
whole tables and its work grows with them.  Each derivation is re-stated as a
DuckDB CTE in ``tickwise.plans.oracle`` so the oracle is independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.parse import date_text
from tickwise.functions.rounding import round_half_up
from tickwise.operators.joins import with_series_id
from tickwise.sources.tables import read_table

# Market segment → indicator display name (one per macro series).
SEGMENT_INDICATOR = {
    "AUTOMOBILE": "Consumer Price Index",
    "BUILDING": "Federal Funds Rate",
    "FURNITURE": "Gross Domestic Product",
    "HOUSEHOLD": "Unemployment Rate",
    "MACHINERY": "10 Year Treasury Rate",
}
# The one segment whose series is daily; the rest are monthly (first of month).
DAILY_SEGMENT = "MACHINERY"


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def raw_stock_prices(spark: SparkSession, sf_dir: str, with_source_key: bool = False) -> DataFrame:
    """``raw_stock_prices`` ← lineitem: one row per line, several versions per key."""
    li = read_table(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    extra = [F.col("l_orderkey").alias("source_key")] if with_source_key else []
    return li.select(*extra,
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        round_half_up(net, 4).alias("open_price"),
        round_half_up(F.col("l_extendedprice") * (1 + F.col("l_tax")) + 1, 4).alias("high_price"),
        round_half_up(net * 0.9, 4).alias("low_price"),
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_extendedprice")).alias("close_price"),
        F.when(F.col("l_orderkey") % 89 == 0, F.lit(0))
        .otherwise(F.col("l_quantity")).cast("bigint").alias("volume"),
        _plus_seconds(F.col("l_shipdate"), F.col("l_orderkey")).alias("loaded_at"),
    )


def _segment_name(seg: Column) -> Column:
    expr = None
    for segment, name in SEGMENT_INDICATOR.items():
        expr = (F.when(seg == segment, F.lit(name)) if expr is None
                else expr.when(seg == segment, F.lit(name)))
    return expr


def raw_macro_indicators(spark: SparkSession, sf_dir: str, with_source_key: bool = False) -> DataFrame:
    """``raw_macro_indicators`` ← orders ⋈ customer: five series, one daily, four monthly."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    day = F.col("o_orderdate").cast("date")
    extra = [F.col("o_orderkey").alias("source_key")] if with_source_key else []
    return joined.select(*extra,
        _segment_name(F.col("c_mktsegment")).alias("indicator_name"),
        F.when(F.col("c_mktsegment") == DAILY_SEGMENT, day)
        .otherwise(F.trunc(day, "month")).alias("indicator_date"),
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_totalprice")).alias("value"),
        _plus_seconds(F.col("o_orderdate"), F.col("o_orderkey")).alias("loaded_at"),
    )


def _text(c: Column) -> Column:
    return c.cast("string")


def dirty_stock_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed stock batch with planted faults, one row per event (all text columns).

    Faults are planted by event id so every class of reject occurs; the first
    matching case of each column wins.  ``_input_order`` is the event id.
    """
    ev = read_table(spark, sf_dir, "events")
    i, uid, val = F.col("event_id"), F.col("user_id"), F.col("value")
    return ev.select(
        i.alias("_input_order"),
        F.when(i % 11 == 0, F.lit("bad ticker!"))
        .when(i % 7 == 0, F.concat(F.lit(" u"), _text(uid), F.lit(" ")))
        .otherwise(F.concat(F.lit("U"), _text(uid))).alias("ticker"),
        F.when(i % 13 == 0, F.lit("not-a-date"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("trade_date"),
        _text(val).alias("open_price"),
        F.when(i % 23 == 0, F.lit("0.001")).otherwise(_text(val + 1)).alias("high_price"),
        F.when(i % 29 == 0, F.lit("inf")).when(i % 37 == 0, F.lit("1.0d"))
        .otherwise(_text(val / 2)).alias("low_price"),
        _text(val).alias("close_price"),
        F.when(i % 17 == 0, F.lit("0")).when(i % 19 == 0, F.lit("1.5"))
        .when(i % 31 == 0, F.lit(None).cast("string"))
        .otherwise(_text(uid + 1)).alias("volume"),
    )


def dirty_macro_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed macro batch with planted faults, one row per event (all text columns)."""
    ev = read_table(spark, sf_dir, "events")
    i = F.col("event_id")
    return ev.select(
        i.alias("_input_order"),
        F.when(i % 23 == 0, F.lit("bad id!")).otherwise(F.col("event_type")).alias("series_id"),
        F.when(i % 29 == 0, F.lit("  ")).otherwise(F.col("event_type")).alias("indicator_name"),
        F.when(i % 7 == 0, F.lit("bad"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("indicator_date"),
        F.when(i % 11 == 0, F.lit(".")).when(i % 13 == 0, F.lit("bad"))
        .when(i % 17 == 0, F.lit("inf")).when(i % 19 == 0, F.lit(None).cast("string"))
        .otherwise(_text(F.col("value"))).alias("value"),
    )


# Macro series id → display name (the five default series).
SERIES_NAMES = {
    "FEDFUNDS": "Federal Funds Rate",
    "CPIAUCSL": "Consumer Price Index",
    "GDP": "Gross Domestic Product",
    "UNRATE": "Unemployment Rate",
    "DGS10": "10 Year Treasury Rate",
}

# The error payload forms that land besides the real ones.
STOCK_ERROR_PAYLOADS = (
    '{"Note": null}',
    '{"Information": "i", "Error Message": "x"}',
    '{"Error Message": "x"}',
    '{}',
    '{"Time Series (Daily)": {}}',
    '{"Time Series (Daily)": [1, 2]}',
    '[1]',
    '{oops',
    None,
)
MACRO_ERROR_PAYLOADS = (
    '{"error_code": 400, "error_message": "Bad Request"}',
    '{"error_message": "x"}',
    '{"observations": []}',
    '{"observations": {}}',
    '{}',
    '[1]',
    '{oops',
    None,
)
# Which groups get an extra payload: by a code in 0..36 (stock) or 0..12 (macro).
STOCK_ERROR_MODULUS = 37
MACRO_ERROR_MODULUS = 13
STOCK_HUGE_CODE = len(STOCK_ERROR_PAYLOADS) + 1
STOCK_TICKER_CODE = STOCK_HUGE_CODE + 1
# A bar at the far end of the RAW columns, and an entity that is no ticker.
HUGE_DAY, HUGE_PRICE, HUGE_VOLUME = "2099-01-01", "1e31", "1e30"
HUGE_PAYLOAD = (f'{{"Time Series (Daily)": {{"{HUGE_DAY}": {{"1. open": "{HUGE_PRICE}", '
                f'"2. high": "{HUGE_PRICE}", "3. low": "{HUGE_PRICE}", "4. close": "{HUGE_PRICE}", '
                f'"5. volume": "{HUGE_VOLUME}"}}}}}}')
BAD_TICKER = "bad ticker!"
# Fetches that overlap: every source row belongs to one of them.
FETCHES = 3


def _form(code: Column, forms) -> Column:
    """The form planted for a code 1..n."""
    expr = F.lit(None).cast("string")
    for i, form in enumerate(forms, start=1):
        expr = F.when(code == i, F.lit(form).cast("string")).otherwise(expr)
    return expr


def _with_extras(payloads: DataFrame, extras: list[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """Every payload, and after it those extra ones whose condition holds; they land later."""
    def row(changes: dict[str, Column]) -> Column:
        return F.struct(*[changes.get(c, F.col(c)).alias(c) for c in payloads.columns if c != "code"])

    rows = [F.array(row({}))] + [
        F.when(cond, F.array(row(changes | {"landing_order": F.lit(1).cast("bigint")}))).otherwise(F.array())
        for cond, changes in extras]
    return payloads.select(F.inline(F.concat(*rows)))


def _decimal_text(c: Column, scale: int) -> Column:
    return c.cast(f"decimal(18,{scale})").cast("string")


def latest_stock_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per (ticker, day): the latest load of the raw rows, unfiltered."""
    from tickwise.operators.staging import STOCK_ORDER, latest_per_key
    return latest_per_key(raw_stock_prices(spark, sf_dir), ["ticker", "trade_date"], STOCK_ORDER)


def _stock_bodies(bars: DataFrame, by: list[Column]) -> DataFrame:
    """One JSON per (ticker, month, ``by``), newest day first: at most 31 bars each.

    Bars move to their month as numbers; their texts are made there.  All are digits, so nothing
    needs an escape; a null field is left out, a null day is refused.
    """
    texts = {
        "1. open": _decimal_text(F.col("open_price"), 4),
        "2. high": _decimal_text(F.col("high_price"), 4),
        "3. low": _decimal_text(F.col("low_price"), 4),
        "4. close": _decimal_text(F.col("close_price"), 4),
        "5. volume": F.col("volume").cast("string"),
    }
    fields = F.concat_ws(",", *[F.concat(F.lit(f'"{name}":"'), text, F.lit('"')) for name, text in texts.items()])
    day = F.coalesce(date_text("trade_date", "yyyy-MM-dd"), F.raise_error(F.lit("a bar without a day")))
    moved = bars.drop("loaded_at").withColumn("month", F.trunc("trade_date", "month")) \
        .repartition("ticker", "month", *by)
    entries = moved.select("ticker", "month", *by, day.alias("d"), F.concat(
        F.lit('"'), day, F.lit('":{'), fields, F.lit("}")).alias("b"))
    grouped = entries.groupBy("ticker", "month", *by).agg(
        F.sort_array(F.collect_list(F.struct("d", "b")), asc=False)["b"].alias("days"))
    return grouped.withColumn("month", date_text("month", "yyyy-MM")).withColumn("payload", F.concat(
        F.lit('{"Time Series (Daily)":{'), F.concat_ws(",", "days"), F.lit("}}")))


def stock_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed stock responses: one per (ticker, month), with every bar of the raw rows.

    By (supplier + month index) % 37 some groups are followed by an extra payload: 1..9 one of
    the error forms, 10 a bar of extreme numbers, 11 the same bars under a bad ticker.
    """
    bodies = _stock_bodies(latest_stock_bars(spark, sf_dir), [])
    code = (F.substring("ticker", 2, 20).cast("int")
            + F.substring("month", 1, 4).cast("int") * 12
            + F.substring("month", 6, 2).cast("int")) % STOCK_ERROR_MODULUS
    landed = bodies.select(F.concat_ws(":", "ticker", "month").alias("payload_id"), "ticker", "payload",
                           F.lit(0).cast("bigint").alias("landing_order"), code.alias("code"))
    c, pid = F.col("code"), F.col("payload_id")
    return _with_extras(landed, [
        (c.between(1, len(STOCK_ERROR_PAYLOADS)), {
            "payload_id": F.concat(pid, F.lit(":error")), "payload": _form(c, STOCK_ERROR_PAYLOADS)}),
        (c == STOCK_HUGE_CODE, {"payload_id": F.concat(pid, F.lit(":huge")), "payload": F.lit(HUGE_PAYLOAD)}),
        (c == STOCK_TICKER_CODE, {"payload_id": F.concat(pid, F.lit(":ticker")), "ticker": F.lit(BAD_TICKER)}),
    ])


def overlapping_stock_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fetches of every ticker and month, landed one after the other; their days overlap."""
    from tickwise.operators.staging import STOCK_ORDER, latest_per_key
    raw = raw_stock_prices(spark, sf_dir, with_source_key=True).withColumn(
        "fetch", F.col("source_key") % FETCHES)
    bars = latest_per_key(raw, ["ticker", "trade_date", "fetch"], STOCK_ORDER)
    return _stock_bodies(bars, [F.col("fetch")]).select(
        F.concat_ws(":", "ticker", "month", F.col("fetch").cast("string")).alias("payload_id"), "ticker",
        "payload", F.col("fetch").alias("landing_order"))


def latest_macro_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per (indicator, date): the latest load, null values kept."""
    from tickwise.operators.staging import MACRO_ORDER, latest_per_key
    return latest_per_key(raw_macro_indicators(spark, sf_dir),
                          ["indicator_name", "indicator_date"], MACRO_ORDER)


def _macro_bodies(spark: SparkSession, points: DataFrame, by: list[Column]) -> DataFrame:
    """One JSON per (series, year, ``by``), newest first, at most 366 points; ``"."`` marks missing."""
    named = with_series_id(points, SERIES_NAMES)
    value_text = F.coalesce(_decimal_text(F.col("value"), 2), F.lit("."))
    grouped = named.groupBy("series_id", "indicator_name", F.year("indicator_date").alias("year"), *by).agg(
        F.sort_array(F.collect_list(F.struct(
            F.date_format("indicator_date", "yyyy-MM-dd").alias("date"),
            value_text.alias("value"))), asc=False).alias("observations"))
    return grouped.withColumn("payload", F.to_json(F.struct("observations")))


def macro_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed macro responses: one per (series, year), with every point of the raw rows.

    Groups whose (year + length of the series id) % 13 is 1..8 are followed by an extra
    payload with one of the error forms.
    """
    bodies = _macro_bodies(spark, latest_macro_points(spark, sf_dir), [])
    landed = bodies.select(
        F.concat_ws(":", "series_id", F.col("year").cast("string")).alias("payload_id"),
        "series_id", "indicator_name", "payload", F.lit(0).cast("bigint").alias("landing_order"),
        ((F.col("year") + F.length("series_id")) % MACRO_ERROR_MODULUS).alias("code"))
    c = F.col("code")
    return _with_extras(landed, [(c.between(1, len(MACRO_ERROR_PAYLOADS)), {
        "payload_id": F.concat("payload_id", F.lit(":error")), "payload": _form(c, MACRO_ERROR_PAYLOADS)})])


def overlapping_macro_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fetches of every series and year whose dates overlap; each is a series id of its
    own that shares the display name."""
    from tickwise.operators.staging import MACRO_ORDER, latest_per_key
    raw = raw_macro_indicators(spark, sf_dir, with_source_key=True).withColumn(
        "fetch", F.col("source_key") % FETCHES)
    points = latest_per_key(raw, ["indicator_name", "indicator_date", "fetch"], MACRO_ORDER)
    fetch = F.col("fetch").cast("string")
    return _macro_bodies(spark, points, [F.col("fetch")]).select(
        F.concat_ws(":", "series_id", F.col("year").cast("string"), fetch).alias("payload_id"),
        F.concat_ws("_", "series_id", fetch).alias("series_id"),
        F.concat(F.lit(" "), "indicator_name", F.lit(" ")).alias("indicator_name"), "payload",
        F.col("fetch").alias("landing_order"))


# -- upsert pair (B6) ------------------------------------------------------------
# Yesterday's snapshot and today's batch, both built from every source row:
# rows with source key ≡ 1 (mod 3) exist only in the batch (inserts), ≡ 2 only
# in the snapshot (kept), ≡ 0 in both (updated or unchanged).

def _valid_latest_stock(raw: DataFrame) -> DataFrame:
    from tickwise.operators.staging import STOCK_ORDER, latest_per_key
    valid = raw.where(F.col("close_price").isNotNull() & (F.col("volume") > 0))
    return latest_per_key(valid, ["ticker", "trade_date"], STOCK_ORDER).drop("source_key")


def upsert_stock_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_stock_prices(spark, sf_dir, with_source_key=True)
    return _valid_latest_stock(raw.where(F.col("source_key") % 3 != 1))


def upsert_stock_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_stock_prices(spark, sf_dir, with_source_key=True)
    return _valid_latest_stock(raw.where(F.col("source_key") % 3 != 2))


def _valid_latest_macro(raw: DataFrame) -> DataFrame:
    from tickwise.operators.staging import MACRO_ORDER, latest_per_key
    return latest_per_key(raw.where(F.col("value").isNotNull()),
                          ["indicator_name", "indicator_date"], MACRO_ORDER).drop("source_key")


def upsert_macro_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_macro_indicators(spark, sf_dir, with_source_key=True)
    return _valid_latest_macro(raw.where(F.col("source_key") % 3 != 1))


def upsert_macro_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_macro_indicators(spark, sf_dir, with_source_key=True)
    return _valid_latest_macro(raw.where(F.col("source_key") % 3 != 2))


# -- a second load and a watch list ----------------------------------------------
# Days from SECOND_LOAD on land with the second load, and so does every
# LATE_EVERY-th source key from LATE_FROM on (corrections of days already built).
SECOND_LOAD, LATE_FROM, LATE_EVERY = "1997-01-01", "1995-06-01", 97
WATCHED_REGION = "EUROPE"


def lands_later() -> Column:
    """Whether a raw stock row (with its source key) comes with the second load."""
    return (F.col("trade_date") >= F.lit(SECOND_LOAD).cast("date")) | (
        (F.col("trade_date") >= F.lit(LATE_FROM).cast("date")) & (F.col("source_key") % LATE_EVERY == 0))


def watch_list(spark: SparkSession, sf_dir: str, region: str = WATCHED_REGION) -> DataFrame:
    """A table of selected tickers: the suppliers of a region, and its nations, which have no bars."""
    nations = read_table(spark, sf_dir, "nation").join(
        read_table(spark, sf_dir, "region").where(F.col("r_name") == region),
        F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = read_table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return suppliers.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker")).unionByName(
        nations.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("ticker")))


# -- audit log (B7) --------------------------------------------------------------
# Event type → run status, and a secret planted in messages.
EVENT_STATUS = {
    "click": "SUCCESS",
    "view": "PARTIAL_SUCCESS",
    "signup": "NO_CHANGES",
    "purchase": "NO_VALID_ROWS",
    "error": "FAILED",
}
PLANTED_SECRET = "hunter2"


def pipeline_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pipeline_logs`` ← events: one audit row per event, with planted faults.

    Every 101st run names an unknown pipeline and every 103rd over-counts its
    drops, so the data-quality checks have rows to find.
    """
    ev = read_table(spark, sf_dir, "events")
    i, et = F.col("event_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    status = None
    for e, st in EVENT_STATUS.items():
        status = F.when(et == e, F.lit(st)) if status is None else status.when(et == e, F.lit(st))
    valid = F.when(et == "purchase", F.lit(0).cast("bigint")).otherwise(k - k % 4)
    zero = F.lit(0).cast("bigint")
    failed = et == "error"
    code = F.when(i % 3 == 0, F.lit("API_TIMEOUT")).when(i % 3 == 1, F.lit("API_RATE_LIMITED")) \
        .otherwise(F.lit("SNOWFLAKE_LOAD_ERROR"))
    message = F.concat(
        F.lit("GET https://api.example/query?symbol=U"), F.col("user_id").cast("string"),
        F.lit("&apikey=K"), i.cast("string"), F.lit(" failed\r\ntoken=T"), i.cast("string"),
        F.when(i % 5 == 0, F.lit(" password " + PLANTED_SECRET)).otherwise(F.lit("")),
        F.lit(" "), F.expr("repeat('x', cast(event_id % 600 as int))"))
    return ev.select(
        i.cast("string").alias("run_id"),
        F.timestamp_add("MICROSECOND", -F.floor(F.col("value") * 1000), F.col("ts"))
        .alias("run_timestamp"),
        F.col("ts").alias("completed_at"),
        F.when(i % 101 == 0, F.lit("OTHER")).when(i % 2 == 0, F.lit("STOCK_INGESTION"))
        .otherwise(F.lit("MACRO_INGESTION")).alias("pipeline_name"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("entity_name"),
        k.alias("rows_fetched"),
        valid.alias("rows_valid"),
        F.when(et.isin("click", "view"), valid).otherwise(zero).alias("rows_inserted"),
        zero.alias("rows_updated"),
        F.when(et == "signup", valid).otherwise(zero).alias("rows_unchanged"),
        (F.when(et == "purchase", k).otherwise(k % 4)
         + F.when(i % 103 == 0, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("rows_dropped"),
        status.alias("status"),
        F.floor(F.col("value")).cast("bigint").alias("duration_ms"),
        F.when(failed, code).alias("error_code"),
        F.when(failed, message).alias("error_message"),
    )


# -- RAW tables with planted quality faults (for the data-quality checks) ----------
# Stock: source key % 61 → lower-case ticker (a second raw key that upper-cases
# onto the first), % 59 → negative open, % 53 → high and low swapped.
# Macro: source key % 67 → lower-case name, % 71 → a name outside the accepted list.
UNKNOWN_INDICATOR = "Unknown Series"


def raw_stock_prices_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_stock_prices(spark, sf_dir, with_source_key=True)
    k = F.col("source_key")
    swap = k % 53 == 0
    return raw.select(
        F.when(k % 61 == 0, F.lower("ticker")).otherwise(F.col("ticker")).alias("ticker"),
        "trade_date",
        F.when(k % 59 == 0, -F.col("open_price")).otherwise(F.col("open_price")).alias("open_price"),
        F.when(swap, F.col("low_price")).otherwise(F.col("high_price")).alias("high_price"),
        F.when(swap, F.col("high_price")).otherwise(F.col("low_price")).alias("low_price"),
        "close_price", "volume", "loaded_at")


def raw_macro_indicators_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_macro_indicators(spark, sf_dir, with_source_key=True)
    k = F.col("source_key")
    return raw.select(
        F.when(k % 71 == 0, F.lit(UNKNOWN_INDICATOR))
        .when(k % 67 == 0, F.lower("indicator_name"))
        .otherwise(F.col("indicator_name")).alias("indicator_name"),
        "indicator_date", "value", "loaded_at")
