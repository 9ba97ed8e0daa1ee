"""Rounding helpers.

SQL-model ROUND goes through ``decimal(38,8)`` so that double noise beyond the
8th place cannot tip a near-midpoint the other way; the same text is used in
the DuckDB oracle.  Values the decimal cannot hold have no digits to round and
stay as they are.  The normaliser rounds the scaled double to the nearest
integer, ties to even, as pandas does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL_ROUTE = "decimal(38,8)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, scale: int) -> Column:
    """ROUND(x, n) of the SQL models: half away from zero, via decimal(38,8), as double."""
    x = _col(c)
    return F.coalesce(F.round(x.try_cast(DECIMAL_ROUTE), scale).cast("double"), x.cast("double"))


def round_half_even(c: Column | str, scale: int) -> Column:
    """pandas ``Series.round``: scale, round to the nearest integer (ties to even), scale back."""
    factor = float(10 ** scale)
    return F.rint(_col(c) * F.lit(factor)) / F.lit(factor)
