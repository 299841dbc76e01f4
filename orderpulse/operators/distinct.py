"""Exact distinct counts that can be merged: one bitmap per day, from which any range of days is counted.

Every value gets a number once. A day's values are the set bits of bitmaps of 4 KB, each for a run of numbers, so days
combine by a bitwise or, and weeks, months or any range come from stored days without the rows behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 4096  # numbers are given out in so many lanes, one per hash of the value, so that no task numbers all values


def numbered(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, number) for each distinct non-null value; numbers are unique and leave few gaps.

    Values of the table `known` keep their numbers, so that a stored table can be extended by new days.
    """
    new = values.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
    lane = F.pmod(F.xxhash64("value"), F.lit(LANES))
    if known is not None:
        new = new.join(known, "value", "left_anti")
        taken = known.groupBy(F.pmod(F.col("number"), F.lit(LANES)).alias("_lane")).agg(F.max("number").alias("_last"))
    place = F.row_number().over(Window.partitionBy("_lane").orderBy("value"))
    new = new.withColumn("_lane", lane).withColumn("_place", place.cast("long"))
    if known is None:
        return new.select("value", ((F.col("_place") - 1) * LANES + F.col("_lane")).alias("number"))
    new = new.join(taken, "_lane", "left")
    first = F.coalesce(F.col("_last"), F.col("_lane") - LANES)
    return known.union(new.select("value", (first + F.col("_place") * LANES).alias("number")))


def daily_bitmaps(rows: DataFrame, day: Column, column: str, numbers: DataFrame) -> DataFrame:
    """(day, bucket, bits): the values of `column` on each day. Combined before the shuffle, so hot days cost no more."""
    held = rows.select(day.alias("day"), F.col(column).alias("value")).join(numbers, "value")
    return held.groupBy("day", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def distinct_over(bitmaps: DataFrame, *by: Column) -> DataFrame:
    """Exact distinct values of the days that each group of `by` holds, as `values`."""
    whole = bitmaps.select(*by, "bucket", "bits")
    names = [c for c in whole.columns if c not in ("bucket", "bits")]
    whole = whole.groupBy(*names, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return whole.groupBy(*names).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("values"))
