"""Window columns of one long key in several tasks: segmented scans and overlapping blocks.

``PARTITION BY key ORDER BY day`` gives a key to one task, however long its history.  Here a
key's rows are cut twice, and no window sees more than one cut:

* ``running`` cuts by calendar year.  A year is summed up by one pre-aggregated row, and a scan of
  these (one row for each key and year) gives what the years before hand on.  That row stands in
  front of its year's rows, so one window over them continues the places and running values
  (max, min, first): rows move once and meet no join.
* ``overlapping`` cuts by place into blocks of ``BLOCK`` rows and copies the last ``halo`` rows
  of a block into the next one.  A trailing frame of up to ``halo`` + 1 rows then lies within a
  block; the copies are dropped again after the frames are taken.

Defined cases: a null day is before all others, in a cut of its own; a null key is a key.  Rows of
a key that share a day have one cut and no fixed order among themselves, as in any window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows of a block; a trailing frame may not be longer.
BLOCK = 1024
PLACE, CUT, COPY = "_place", "_cut", "_copy"
#: The year of a null day, before any year there is.
NO_YEAR = -(1 << 31)

_MERGE = {"max": F.greatest, "min": F.least}
_SCAN = {"max": F.max, "min": F.min, "first": F.first}


def _sum_up(how: str, column: str, day: str) -> Column:
    """What a cut hands on of a value; days of a cut are all null or none is."""
    if how != "first":
        return _SCAN[how](column)
    return F.min_by(column, F.coalesce(F.col(day).cast("date"), F.lit("1970-01-01").cast("date")))


def running(df: DataFrame, key: str, day: str, **values: tuple[str, str]) -> DataFrame:
    """``df`` with ``_place`` (from 0, by ``day`` within ``key``) and running values.

    ``values`` name the new columns, each as ("max" | "min" | "first", column): the value over
    the key's rows up to the current one.  Nulls do not count for max and min; first is that of
    the key's first row, null or not.
    """
    cut = df.withColumn(CUT, F.coalesce(F.year(day), F.lit(NO_YEAR)))
    years = cut.groupBy(F.col(key).alias("_key"), F.col(CUT).alias("_year")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[_sum_up(how, column, day).alias(f"_of_{name}") for name, (how, column) in values.items()])
    before = Window.partitionBy("_key").orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    handed = years.select(F.col("_key").alias(key), F.col("_year").alias(CUT), F.sum("_n").over(before).alias("_before"), *[
        _SCAN[how](f"_of_{name}").over(before).alias(f"_old_{name}") for name, (how, _) in values.items()])
    handed = handed.where(F.col("_before").isNotNull()).select(
        key, CUT, F.struct("_before", *[f"_old_{name}" for name in values]).alias("_handed"))
    # a key's first year gets nothing, so no null day meets the handed row, whose day is null
    both = cut.unionByName(handed, allowMissingColumns=True)
    inside = Window.partitionBy(key, CUT).orderBy(day)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # plain columns only, so that none is copied into the shuffle
    scanned = both.select(
        *df.columns, "_handed", F.first("_handed").over(upto).alias("_old"), F.row_number().over(inside).alias("_n"),
        *[_SCAN[how](column).over(upto).alias(f"_in_{name}") for name, (how, column) in values.items()])
    old = F.col("_old")

    def whole(name: str, how: str) -> Column:
        own, handed_on = F.col(f"_in_{name}"), old[f"_old_{name}"]
        if how == "first":
            return F.when(old.isNull(), own).otherwise(handed_on)
        return _MERGE[how](handed_on, own)

    # a handed row counts for as many places as there are before its year
    place = F.col("_n") - 1 + F.when(old.isNull(), 0).otherwise(old["_before"] - 1)
    return scanned.where(F.col("_handed").isNull()).select(
        *df.columns, place.alias(PLACE), *[whole(name, how).alias(name) for name, (how, _) in values.items()])


def overlapping(df: DataFrame, halo: int, rows: int | None = None) -> DataFrame:
    """``df`` (with ``_place``) with its block ``_cut``, and ``_copy`` for the rows that stand at
    the head of a block only to fill the frames of others."""
    size = BLOCK if rows is None else rows
    if halo >= size:
        raise ValueError(f"a halo of {halo} rows does not fit blocks of {size}")
    block = F.floor(F.col(PLACE) / size)
    tail = F.col(PLACE) % size >= size - halo
    return df.withColumn(CUT, F.explode(F.when(tail, F.array(block, block + 1)).otherwise(F.array(block)))) \
        .withColumn(COPY, F.col(CUT) > block)


def by_block(key: str | Sequence[str]) -> WindowSpec:
    """The window of a key's block, in order."""
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys, CUT).orderBy(PLACE)


def own_rows(df: DataFrame, *columns) -> DataFrame:
    """``columns`` of the rows that are no copies."""
    return df.filter(~F.col(COPY)).select(*columns)
