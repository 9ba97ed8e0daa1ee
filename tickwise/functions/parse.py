"""Guarded lenient parsing, written as JVM-side column expressions.

``try_cast`` alone is more lenient than the pandas coercion it stands in for
(it accepts ``'1.0d'``, ``'1f'`` and a bare year as a date), so each cast sits
behind a full-match guard.  Unparsable input gives null, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted textual forms, each as one capture inside optional
# surrounding white space, so a single regexp_extract both strips and
# validates ('' when the text is not one).
# A decimal or scientific number with optional sign, or inf / infinity / nan:
NUMBER_CAPTURE = (r"(?iU)^\s*([+-]?(?:\d+\.?\d*(?:e[+-]?\d+)?|\.\d+(?:e[+-]?\d+)?"
                  r"|inf|infinity|nan))\s*$")
# an ISO-8601 date, optionally with a time, then an optional zone offset:
ISO_DATE_CAPTURE = (r"(?U)^\s*(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?)"
                    r"(?:Z|([+-](?:0\d|1[0-8])(?::?[0-5]\d)?))?\s*$")
# other date forms, each with the pattern that reads its capture:
DATE_FORMS = (
    (r"(?U)^\s*(\d{8})\s*$", "yyyyMMdd"),
    (r"(?U)^\s*(\d{1,2}/\d{1,2}/\d{4})\s*$", "M/d/yyyy"),
    (r"(?U)^\s*([A-Za-z]{3} \d{1,2}, \d{4})\s*$", "MMM d, yyyy"),
    (r"(?U)^\s*(\d{4}-\d{1,2}-\d{1,2})\s*$", "yyyy-M-d"),
    (r"(?U)^\s*(\d{4}-\d{2}-\d{2}[T ]\d{2})\s*$", "yyyy-MM-dd['T'][' ']HH"),
)
# the usual date, which needs none of the passes above:
PLAIN_DATE_PATTERN = r"^[12][0-9]{3}-[0-9]{2}-[0-9]{2}\z"
# Leading / trailing white space in the Unicode sense (Spark's trim strips spaces only).
EDGE_SPACE_PATTERN = r"(?U)^\s+|\s+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Python ``str.strip()``: remove Unicode white space at both ends."""
    return F.regexp_replace(_col(c).cast("string"), EDGE_SPACE_PATTERN, "")


def canonical_upper(c: Column | str) -> Column:
    """Strip, then upper-case: the canonical form of tickers and series ids."""
    return F.upper(strip_text(c))


def parse_number(c: Column | str) -> Column:
    """Text (or number) → double; null when the text is not a plain number.

    One regular-expression pass per value: the capture is empty for anything
    that is not a number, and ``try_cast('')`` is null.
    """
    return F.regexp_extract(_col(c).cast("string"), NUMBER_CAPTURE, 1).try_cast("double")


def is_finite(c: Column | str) -> Column:
    """True for a non-null, non-NaN, non-infinite double; false otherwise (never null)."""
    return F.coalesce(F.abs(_col(c)) < F.lit(float("inf")), F.lit(False))


def is_positive_finite(c: Column | str) -> Column:
    """0 < x < ∞ with one reference to x; false for null and NaN (NaN sorts above ∞)."""
    x = _col(c)
    return F.coalesce((x > 0) & (x < F.lit(float("inf"))), F.lit(False))


def parse_integer(c: Column | str) -> Column:
    """Text (or number) → decimal(38,0), exact; null when it is no number or does not fit."""
    return F.regexp_extract(_col(c).cast("string"), NUMBER_CAPTURE, 1).try_cast("decimal(38,0)")


def parse_date(c: Column | str) -> Column:
    """A date in ISO form, or in one of ``DATE_FORMS``; null for anything else."""
    text = _col(c).cast("string")
    out = parse_iso_date(text)
    for capture, form in DATE_FORMS:
        found = F.regexp_extract(text, capture, 1)
        out = F.when(found != "", F.to_date(F.try_to_timestamp(found, F.lit(form)))).otherwise(out)
    return F.when(text.rlike(PLAIN_DATE_PATTERN), text.try_cast("date")).otherwise(out)


def parse_iso_date(c: Column | str) -> Column:
    """ISO date or timestamp text → UTC calendar date; null for anything else.

    Computed on TIMESTAMP_NTZ with an explicit offset, so the result does not
    depend on the session time zone.
    """
    text = _col(c).cast("string")
    local = F.regexp_extract(text, ISO_DATE_CAPTURE, 1).try_cast("timestamp_ntz")
    offset = F.regexp_extract(text, ISO_DATE_CAPTURE, 2)
    zone = F.when(offset != "", offset).otherwise(F.lit("UTC"))
    return F.to_date(F.convert_timezone(zone, F.lit("UTC"), local))


def date_text(c: Column | str, form: str) -> Column:
    """``date_format`` of a date by ``form``, "yyyy-MM" or "yyyy-MM-dd".

    Years of four digits are cut from the date's own text, without a formatter.
    """
    day = _col(c)
    usual = day.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))
    return F.when(usual, F.substring(day.cast("string"), 1, len(form))).otherwise(F.date_format(day, form))
