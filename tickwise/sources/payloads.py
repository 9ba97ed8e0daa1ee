"""Landed API payloads → rows, and payload → error code.

A payload row is (batch id, entity, JSON text).  Everything is parsed on the
JVM with ``from_json``; rows keep their position inside the payload, the input
ordinal the normaliser needs.  Payloads with an error code yield no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Payload keys and error codes of the two APIs.
STOCK_SERIES_KEY = "Time Series (Daily)"
STOCK_FIELDS = {
    "open_price": "1. open",
    "high_price": "2. high",
    "low_price": "3. low",
    "close_price": "4. close",
    "volume": "5. volume",
}
STOCK_RATE_LIMIT_KEYS = ("Note", "Information")
STOCK_ERROR_KEY = "Error Message"
MACRO_LIST_KEY = "observations"
MACRO_ERROR_KEYS = ("error_code", "error_message")
API_RESPONSE_INVALID = "API_RESPONSE_INVALID"
API_RATE_LIMITED = "API_RATE_LIMITED"
API_DATA_UNAVAILABLE = "API_DATA_UNAVAILABLE"
# Newest observations a macro request returns (limit=100, sort_order=desc).
MACRO_FETCH_LIMIT = 100
# Where a reader puts the text of a payload it could not read whole.
MALFORMED = "_malformed"


def _has_key(keys: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(keys, key), F.lit(False))


def _top(payloads: DataFrame, id_cols) -> DataFrame:
    """``id_cols`` and the payload's top-level object, parsed once; null for what is no object."""
    return payloads.select(*id_cols, F.explode(F.array(F.from_json("payload", "map<string,string>"))).alias("top"))


def _opened(payloads: DataFrame, id_cols, key: str, body_type: str) -> DataFrame:
    """``id_cols``, the payload's top-level object and the value of ``key``, each parsed once.

    ``explode`` of one value is a barrier: what reads the parsed columns cannot be pushed
    below it and parse again.  A payload that is no object has a null ``top``.
    """
    return _top(payloads, id_cols).select("*", F.explode(F.array(F.from_json(F.col("top")[key], body_type))).alias("body"))


def _odd_stock_payload() -> Column:
    """Whether a payload's text holds an escape, an error key, or the series' key twice.

    A search is cheap where its first character is rare, so a key is looked for before its quotes
    are.
    """
    def holds(text: str) -> Column:
        return F.contains("payload", F.lit(text))

    after = F.substring("payload", F.instr("payload", F.lit(STOCK_SERIES_KEY)) + len(STOCK_SERIES_KEY),
                        F.lit(2 ** 31 - 1))
    odd = holds("\\") | F.contains(after, F.lit(STOCK_SERIES_KEY))
    for key in (*STOCK_RATE_LIMIT_KEYS, STOCK_ERROR_KEY):
        odd = odd | (holds(key) & (holds(f'"{key}"') | holds(f"'{key}'")))
    return odd


def _stock_opened(payloads: DataFrame, id_cols) -> DataFrame:
    """``id_cols``, ``error_code`` and the days of every stock payload, behind barriers like those
    of ``_opened``.

    A *plain* payload is read in one pass: ``days`` maps a date to its fields.  Any other one goes
    the way of ``_opened`` and has a ``body`` of texts.  Plain means that both ways give the same:
    one series, whose days are objects of different dates, and nothing odd.
    """
    series = T.StructType([T.StructField(STOCK_SERIES_KEY, T.MapType(T.StringType(), _day_schema())),
                           T.StructField(MALFORMED, T.StringType())])
    tested = payloads.withColumn("odd", _odd_stock_payload())
    opened = tested.select(*id_cols, "payload", F.explode(F.array(F.when(
        ~F.col("odd"), F.from_json("payload", series, {"columnNameOfCorruptRecord": MALFORMED})))).alias("read"))
    days = F.col("read")[STOCK_SERIES_KEY]
    plain = (F.col("read")[MALFORMED].isNull() & (F.size(days) > 0)
             & (F.size(F.array_distinct(F.map_keys(days))) == F.size(days)))
    marked = opened.withColumn("plain", F.coalesce(plain, F.lit(False)))
    top = marked.select(*id_cols, "plain", days.alias("days"), F.explode(F.array(
        F.when(~F.col("plain"), F.from_json("payload", "map<string,string>")))).alias("top"))
    body = top.select("*", F.explode(F.array(
        F.from_json(F.col("top")[STOCK_SERIES_KEY], "map<string,string>"))).alias("body"))
    return body.select(*id_cols, "plain", "days", "body",
                       F.when(~F.col("plain"), _stock_error_code(F.size("body"))).alias("error_code"))


def _macro_opened(payloads: DataFrame, id_cols) -> DataFrame:
    return _opened(payloads, id_cols, MACRO_LIST_KEY, "array<string>").withColumn(
        "error_code", _macro_error_code())


def _stock_error_code(n_days: Column) -> Column:
    """Null for a usable payload, else the error code, in priority order."""
    keys = F.map_keys("top")
    limited = _has_key(keys, STOCK_RATE_LIMIT_KEYS[0]) | _has_key(keys, STOCK_RATE_LIMIT_KEYS[1])
    return (F.when(keys.isNull(), F.lit(API_RESPONSE_INVALID))
            .when(limited, F.lit(API_RATE_LIMITED))
            .when(_has_key(keys, STOCK_ERROR_KEY), F.lit(API_DATA_UNAVAILABLE))
            .when(F.coalesce(n_days, F.lit(0)) <= 0, F.lit(API_DATA_UNAVAILABLE)))


def _macro_error_code() -> Column:
    """Invalid → API_RESPONSE_INVALID; error keys or no observations → API_DATA_UNAVAILABLE."""
    keys = F.map_keys("top")
    return (F.when(keys.isNull(), F.lit(API_RESPONSE_INVALID))
            .when(_has_key(keys, MACRO_ERROR_KEYS[0]) | _has_key(keys, MACRO_ERROR_KEYS[1]),
                  F.lit(API_DATA_UNAVAILABLE))
            .when(F.coalesce(F.size("body"), F.lit(0)) <= 0, F.lit(API_DATA_UNAVAILABLE)))


def classify_stock_payloads(payloads: DataFrame, id_cols=("payload_id", "ticker")) -> DataFrame:
    """The days are counted by their keys, without a copy of each; a series that is no such object
    or holds an escape, which a copy may refuse, is read as ``parse_stock_payloads`` would."""
    top = _top(payloads, id_cols)
    series = F.col("top")[STOCK_SERIES_KEY]
    n_days = F.coalesce(F.when(~F.contains(series, F.lit("\\")), F.array_size(F.json_object_keys(series))),
                        F.size(F.from_json(series, "map<string,string>")))
    return top.select(*id_cols, _stock_error_code(n_days).alias("error_code"))


def classify_macro_payloads(payloads: DataFrame,
                            id_cols=("payload_id", "series_id", "indicator_name")) -> DataFrame:
    return _macro_opened(payloads, id_cols).select(*id_cols, "error_code")


def _day_schema() -> T.StructType:
    return T.StructType([T.StructField(src, T.StringType()) for src in STOCK_FIELDS.values()])


def _observation_schema() -> T.StructType:
    return T.StructType([T.StructField("date", T.StringType()), T.StructField("value", T.StringType())])


def _repeated(series: Column) -> Column:
    """The entries of a series with a repeated date, by date and position; null for others."""
    entries = F.transform(F.map_entries(series), lambda e, i: F.struct(
        e["key"].alias("key"), i.alias("pos"), e["value"].alias("value")))
    keys = F.map_keys(series)
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.sort_array(entries))


def _days(series: Column, repeated: Column) -> Column:
    """Days of a series map as (pos, key, fields); each day's JSON is parsed exactly once.

    A repeated date keeps its first position and its last value (JSON object semantics of the
    producer): in ``repeated`` its entries stand together, so the first and the last of each
    date are two filtered arrays of one length.  Parsing inside the array keeps every field a
    plain struct read of the generator output, so no later filter can be pushed below the
    explode and re-run the parser per reference.
    """
    schema = _day_schema()

    def day(key: Column, pos: Column, value: Column) -> Column:
        return F.struct(pos.alias("pos"), key.alias("key"), F.from_json(value, schema).alias("fields"))

    def other(place: Column, entry: Column) -> Column:
        return ~F.coalesce(F.get(repeated, place)["key"] == entry["key"], F.lit(False))

    plain = F.transform(F.map_entries(series), lambda e, i: day(e["key"], i, e["value"]))
    firsts = F.filter(repeated, lambda e, i: other(i - 1, e))
    lasts = F.filter(repeated, lambda e, i: other(i + 1, e))
    merged = F.zip_with(firsts, lasts, lambda f, l: day(f["key"], f["pos"], l["value"]))
    return F.when(repeated.isNotNull(), merged).otherwise(plain)


def parse_stock_payloads(payloads: DataFrame, id_cols=("payload_id", "ticker")) -> DataFrame:
    """One text row per day of every usable stock payload, with its position.

    A day whose value is not an object gives a row of null fields.
    """
    usable = _stock_opened(payloads, id_cols).where("error_code IS NULL")
    # each once per payload, behind barriers like the parsed columns
    usable = usable.select(*id_cols, "days", "body", F.explode(F.array(_repeated(F.col("body")))).alias("repeated"))
    usable = usable.select(*id_cols, "days", "body", F.explode(F.array(_days(F.col("body"), F.col("repeated"))))
                           .alias("others"))
    # a date that is repeated keeps the place of its first entry
    other = F.transform("others", lambda d: F.struct(d["key"].alias("key"), d["fields"].alias("value")))
    places = F.transform("others", lambda d: d["pos"])
    # of a plain payload a bare NaN or infinity was read with quotes around it
    quote = F.when(F.col("others").isNull(), F.lit('"')).otherwise(F.lit(""))
    usable = usable.select(*id_cols, "days", F.explode(F.array(F.struct(
        other.alias("entries"), places.alias("places"), quote.alias("quote")))).alias("other"))
    days = usable.select(*id_cols, "other.places", "other.quote", F.posexplode(
        F.coalesce(F.col("other.entries"), F.map_entries("days"))).alias("place", "d"))
    return days.select(
        *id_cols,
        F.coalesce(F.get("places", F.col("place")), F.col("place")).cast("bigint").alias("_input_order"),
        F.col("d.key").alias("trade_date"),
        *[F.btrim(F.col("d.value").getField(src), F.col("quote")).alias(dst) for dst, src in STOCK_FIELDS.items()],
    )


def parse_macro_payloads(payloads: DataFrame,
                         id_cols=("payload_id", "series_id", "indicator_name")) -> DataFrame:
    """S3: one text row per observation; a non-object element gives null date and value."""
    schema = _observation_schema()
    usable = _macro_opened(payloads, id_cols).where("error_code IS NULL")
    parsed = F.transform(F.col("body"), lambda o, i: F.struct(
        i.alias("pos"), F.from_json(o, schema).alias("fields")))
    rows = usable.select(*id_cols, F.explode(parsed).alias("o"))
    return rows.select(
        *id_cols,
        F.col("o.pos").cast("bigint").alias("_input_order"),
        F.col("o.fields.date").alias("indicator_date"),
        F.col("o.fields.value").alias("value"),
    )


def latest_observations(df: DataFrame, key: str = "series_id", order: str = "indicator_date",
                        limit: int = MACRO_FETCH_LIMIT) -> DataFrame:
    """The newest ``limit`` observations per series (a top-k per group by design).

    ``row_number() <= k`` is planned with a partial WindowGroupLimit, so each
    map task forwards at most k rows per series before the shuffle.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")
