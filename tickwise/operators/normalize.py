"""Normalisation of landed batches: validate, route rejects with a reason, keep-last dedup.

Each rule is a column expression and the first failing rule names the reason.
All batches are normalised in one job keyed by ``batch_cols`` (an entity or
run id); the input ordinal ``order_col`` must be supplied by the caller (for
payloads it is the ``posexplode`` position), never invented here.

Outputs: valid rows (``normalize_*``), rejected rows with their reason
(``rejected_*``), and per-batch counts (``metrics_from_reasons``, ``batch_metrics``).

Scale: the keep-last dedup is a ``row_number() = 1`` (map-side partial limit),
and the duplicate losers are found by an anti join on the row identity
(batch, ordinal), which is unique — a hot business key cannot skew it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.parse import (
    canonical_upper, is_finite, is_positive_finite, parse_date, parse_integer, parse_number, strip_text,
)
from tickwise.functions.rounding import round_half_even
from tickwise.sources.tables import INDICATOR_TYPE, PRICE_TYPE


class NormalizationError(ValueError):
    code = "NORMALIZATION_ERROR"


# Batch contracts, patterns and reason codes.
STOCK_INPUT_COLUMNS = ("ticker", "trade_date", "open_price", "high_price", "low_price",
                       "close_price", "volume")
MACRO_INPUT_COLUMNS = ("series_id", "indicator_name", "indicator_date", "value")
TICKER_PATTERN = r"^[A-Z][A-Z0-9.-]{0,9}\z"
SERIES_ID_PATTERN = r"^[A-Z0-9_.-]{1,64}\z"
INDICATOR_NAME_MAX = 128
MACRO_MISSING_MARKER = "."
STOCK_REASONS = ("invalid_ticker", "invalid_trade_date", "invalid_ohlc", "inconsistent_ohlc",
                 "invalid_volume", "duplicate_key")
MACRO_REASONS = ("invalid_series_id", "invalid_indicator_name", "invalid_indicator_date",
                 "invalid_value", "duplicate_key")
PRICE_COLUMNS = ("open_price", "high_price", "low_price", "close_price")
# The RAW columns hold decimal(38,4) prices and decimal(38,6) values; beyond that a row is invalid.
PRICE_LIMIT, INDICATOR_LIMIT = 1e34, 1e32


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Schema-only check on the driver; missing names reported sorted."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise NormalizationError("Missing required columns: " + ", ".join(missing))


def _first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    expr = None
    for failed, reason in rules:
        expr = F.when(failed, F.lit(reason)) if expr is None else expr.when(failed, F.lit(reason))
    return expr


def _as_generated(df: DataFrame) -> DataFrame:
    """Re-emit every row as generator output (``inline`` of a one-element array).

    Catalyst pushes a filter through a projection by inlining the projected
    expressions into the predicate.  The reason rules reference each parsed
    value several times, so ``where(reason IS NULL)`` would re-run every parser
    per reference (measured 4× slower).  A filter cannot be pushed below a
    generator, so after this step the parsed values are plain attributes.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _tag(df: DataFrame, values: dict[str, Column], rules, order_col: str,
         batch_cols: Sequence[str]) -> DataFrame:
    parsed = df.select(*batch_cols, F.col(order_col).alias("_input_order"),
                       *[v.alias(k) for k, v in values.items()])
    return _as_generated(parsed.withColumn("reason", _first_reason(rules)))


def _batch_final(tagged: DataFrame, key: Sequence[str], batch_cols: Sequence[str]) -> DataFrame:
    """One window over (batch, key): losers among the valid rows become ``duplicate_key``.

    Each batch is one landed document, already held whole by one parser task,
    so a window partition is bounded by the document.
    """
    w = Window.partitionBy(*batch_cols, *key, F.col("reason").isNull()).orderBy(
        F.col("_input_order").desc())
    ranked = tagged.withColumn("_rn", F.row_number().over(w))
    dup = F.col("reason").isNull() & (F.col("_rn") > 1)
    return ranked.withColumn(
        "reason", F.when(dup, F.lit("duplicate_key")).otherwise(F.col("reason"))).drop("_rn")


def _survivors_and_rejects(tagged: DataFrame, key: Sequence[str],
                           batch_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(surviving valid rows, rejected rows with their final reason).

    Without batch columns the whole input is one batch of unbounded size:
    survivors are picked with ``row_number() = 1`` (partial, map-side limit)
    and losers found by an anti join on the unique row identity, so a key
    holding a third of all rows never lands in one task.
    """
    if batch_cols:
        final = _batch_final(tagged, key, batch_cols)
        return final.where(F.col("reason").isNull()), final.where(F.col("reason").isNotNull())
    valid = tagged.where(F.col("reason").isNull())
    w = Window.partitionBy(*key).orderBy(F.col("_input_order").desc())
    survivors = valid.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    losers = (valid.join(survivors.select("_input_order"), ["_input_order"], "left_anti")
              .withColumn("reason", F.lit("duplicate_key")))
    return survivors, tagged.where(F.col("reason").isNotNull()).unionByName(losers)


def _final_reasons(tagged: DataFrame, key: Sequence[str], batch_cols: Sequence[str]) -> DataFrame:
    """Every row once with its final reason: null for the surviving valid row of each key."""
    if batch_cols:
        return _batch_final(tagged, key, batch_cols)
    survivors, rejected = _survivors_and_rejects(tagged, key, batch_cols)
    return survivors.unionByName(rejected)


# -- stock ---------------------------------------------------------------------

def _stock_tagged(df: DataFrame, order_col: str, batch_cols: Sequence[str]) -> DataFrame:
    require_columns(df, [*STOCK_INPUT_COLUMNS, order_col, *batch_cols])
    values = {
        "ticker": canonical_upper("ticker"),
        "trade_date": parse_date("trade_date"),
        **{c: parse_number(c) for c in PRICE_COLUMNS},
        "volume": parse_number("volume"),
        "volume_exact": parse_integer("volume"),
    }
    o, h, l, c = (F.col(x) for x in PRICE_COLUMNS)
    prices_ok = (is_positive_finite(o) & is_positive_finite(h) & is_positive_finite(l)
                 & is_positive_finite(c) & (F.greatest(o, h, l, c) < PRICE_LIMIT))
    v = F.col("volume")
    # Each parsed value is referenced as few times as possible: Catalyst inlines
    # the parse into every reference when it pushes the reason filter down.
    rules = [
        (~F.coalesce(F.col("ticker").rlike(TICKER_PATTERN), F.lit(False)), "invalid_ticker"),
        (F.col("trade_date").isNull(), "invalid_trade_date"),
        (~prices_ok, "invalid_ohlc"),
        ((h < F.greatest(l, o, c)) | (l > F.least(o, c)), "inconsistent_ohlc"),
        (~(is_positive_finite(v) & (v % 1 == 0) & F.col("volume_exact").isNotNull()), "invalid_volume"),
    ]
    return _tag(df, values, rules, order_col, batch_cols)


def valid_stock_rows(final: DataFrame, batch_cols: Sequence[str] = ()) -> DataFrame:
    """Loaded rows of a final-reason frame, rounded and typed as the RAW contract."""
    return final.where(F.col("reason").isNull()).select(
        *batch_cols, "_input_order", "ticker", "trade_date",
        *[round_half_even(p, 4).cast(PRICE_TYPE).alias(p) for p in PRICE_COLUMNS],
        F.col("volume_exact").alias("volume"))


def stock_normalization(df: DataFrame, order_col: str = "_input_order",
                        batch_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) of a stock batch."""
    survivors, rejected = _survivors_and_rejects(
        _stock_tagged(df, order_col, batch_cols), ["ticker", "trade_date"], batch_cols)
    return valid_stock_rows(survivors, batch_cols), rejected


def stock_reasons(df: DataFrame, order_col: str = "_input_order",
                  batch_cols: Sequence[str] = ()) -> DataFrame:
    """Every input row once, with its final reason (null = loaded)."""
    return _final_reasons(_stock_tagged(df, order_col, batch_cols), ["ticker", "trade_date"],
                          batch_cols)


def normalize_stock_rows(df: DataFrame, order_col: str = "_input_order",
                         batch_cols: Sequence[str] = ()) -> DataFrame:
    """Valid, deduplicated, rounded stock rows (plus the input ordinal)."""
    return stock_normalization(df, order_col, batch_cols)[0]


def rejected_stock_rows(df: DataFrame, order_col: str = "_input_order",
                        batch_cols: Sequence[str] = ()) -> DataFrame:
    """Every dropped stock row with the first rule it failed (or ``duplicate_key``)."""
    return stock_normalization(df, order_col, batch_cols)[1].select(
        *batch_cols, "_input_order", "reason")


# -- macro ---------------------------------------------------------------------

def _macro_tagged(df: DataFrame, order_col: str, batch_cols: Sequence[str]) -> DataFrame:
    require_columns(df, [*MACRO_INPUT_COLUMNS, order_col, *batch_cols])
    name = strip_text("indicator_name")
    value_text = F.when(F.col("value").cast("string") != MACRO_MISSING_MARKER,
                        F.col("value").cast("string"))
    values = {
        "series_id": canonical_upper("series_id"),
        "indicator_name": name,
        "indicator_date": parse_date("indicator_date"),
        "value": parse_number(value_text),
    }
    rules = [
        (~F.coalesce(F.col("series_id").rlike(SERIES_ID_PATTERN), F.lit(False)),
         "invalid_series_id"),
        (~F.coalesce(F.length("indicator_name").between(1, INDICATOR_NAME_MAX), F.lit(False)),
         "invalid_indicator_name"),
        (F.col("indicator_date").isNull(), "invalid_indicator_date"),
        (~(is_finite(F.col("value")) & (F.abs("value") < INDICATOR_LIMIT)), "invalid_value"),
    ]
    return _tag(df, values, rules, order_col, batch_cols)


def valid_macro_rows(final: DataFrame, batch_cols: Sequence[str] = ()) -> DataFrame:
    """Loaded rows of a final-reason frame, value rounded to 6 places."""
    return final.where(F.col("reason").isNull()).select(
        *batch_cols, "_input_order", "series_id", "indicator_name", "indicator_date",
        round_half_even("value", 6).cast(INDICATOR_TYPE).alias("value"))


def macro_normalization(df: DataFrame, order_col: str = "_input_order",
                        batch_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) of a macro batch; dedup key is (series_id, date)."""
    survivors, rejected = _survivors_and_rejects(
        _macro_tagged(df, order_col, batch_cols), ["series_id", "indicator_date"], batch_cols)
    return valid_macro_rows(survivors, batch_cols), rejected


def macro_reasons(df: DataFrame, order_col: str = "_input_order",
                  batch_cols: Sequence[str] = ()) -> DataFrame:
    """Every input row once, with its final reason (null = loaded)."""
    return _final_reasons(_macro_tagged(df, order_col, batch_cols), ["series_id", "indicator_date"],
                          batch_cols)


def normalize_macro_rows(df: DataFrame, order_col: str = "_input_order",
                         batch_cols: Sequence[str] = ()) -> DataFrame:
    return macro_normalization(df, order_col, batch_cols)[0]


def rejected_macro_rows(df: DataFrame, order_col: str = "_input_order",
                        batch_cols: Sequence[str] = ()) -> DataFrame:
    return macro_normalization(df, order_col, batch_cols)[1].select(
        *batch_cols, "_input_order", "reason")


# -- counts --------------------------------------------------------------------

def metrics_from_reasons(tagged: DataFrame, reasons: Sequence[str],
                         batch_cols: Sequence[str] = ()) -> DataFrame:
    """Per batch fetched / valid / dropped and one count per reason, from a frame that
    holds every row once with its final reason.  Duplicates count as dropped."""
    aggs = [F.count(F.lit(1)).alias("rows_fetched"),
            F.count_if(F.col("reason").isNull()).alias("rows_valid"),
            F.count_if(F.col("reason").isNotNull()).alias("rows_dropped")]
    aggs += [F.count_if(F.col("reason") == r).alias(f"dropped_{r}") for r in reasons]
    grouped = tagged.groupBy(*batch_cols) if batch_cols else tagged
    return grouped.agg(*aggs)


def batch_metrics(tagged: DataFrame, key: Sequence[str], reasons: Sequence[str]) -> DataFrame:
    """The counts of one unbounded batch in a single pass over its tagged rows.

    Which of a key's rows survives does not matter for counting: a key with n valid rows has
    n - 1 duplicates.  Rows are counted by (reason, key of valid rows), pre-aggregated before
    the shuffle, and those counts are summed up.
    """
    ok = F.col("reason").isNull()
    per_key = tagged.groupBy("reason", *[F.when(ok, F.col(k)).alias(k) for k in key]).agg(
        F.count(F.lit(1)).alias("n"))
    lost = F.when(ok, F.col("n") - 1).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    aggs = [total("n").alias("rows_fetched"), F.count_if(ok).alias("rows_valid"),
            (total("n") - F.count_if(ok)).alias("rows_dropped")]
    for r in reasons:
        n = total(lost) if r == "duplicate_key" else total(F.when(F.col("reason") == r, F.col("n")))
        aggs.append(n.alias(f"dropped_{r}"))
    return per_key.agg(*aggs)


def stock_batch_metrics(df: DataFrame, order_col: str = "_input_order") -> DataFrame:
    return batch_metrics(_stock_tagged(df, order_col, ()), ["ticker", "trade_date"], STOCK_REASONS)


def macro_batch_metrics(df: DataFrame, order_col: str = "_input_order") -> DataFrame:
    return batch_metrics(_macro_tagged(df, order_col, ()), ["series_id", "indicator_date"], MACRO_REASONS)


def reason_counts(rejected: DataFrame, batch_cols: Sequence[str] = ()) -> DataFrame:
    """The reason histogram in long form (batch, reason, rows)."""
    return rejected.groupBy(*batch_cols, "reason").agg(F.count(F.lit(1)).alias("rows"))
