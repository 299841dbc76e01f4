"""A helper that keeps one hot key from becoming one huge task.

Aggregates need none of this: Spark combines them before the shuffle. Order-dependent steps would
otherwise bring all rows of a key to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranged(rows: DataFrame, *order: str) -> DataFrame:
    """Rows in partitions of about equal size by ranges of `order`, with the partition's number as `_part`."""
    return rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())


def with_previous(rows: DataFrame, key: str, time: str, tie: str, value: str, alias: str) -> DataFrame:
    """Add `value` of the row before, within `key`, ordered by `time`, then `tie`, which is unique within a key.

    Rows are ranged by key, time and tie, so that a key with any share of the rows, in one hour or without any times,
    lies in as many partitions as its size asks for, and each partition looks at its own rows of a key. A second window
    carries values over the borders: only the first and last row of each partition meet there by key, two for every
    partition that a key touches. One lazy plan serves every size; it shuffles the rows three times, and none twice in
    different ways, so that a partition's number means the same everywhere.
    """
    order = [F.col(time), F.col(tie)]
    own = Window.partitionBy("_part", key).orderBy(*order)
    carried = F.struct(F.col(value).alias("value"))
    found = ranged(rows, key, time, tie).withColumns({"_within": F.lag(carried).over(own), "_after": F.lead(F.lit(1)).over(own)})
    border = F.col("_within").isNull() | F.col("_after").isNull()
    found = found.withColumn("_meets", F.when(~border, F.col("_part")))
    over = F.lag(carried).over(Window.partitionBy(key, "_meets").orderBy(*order))
    found = found.withColumn("_before", F.when(F.col("_within").isNull(), over))
    return found.select(*rows.columns, F.coalesce("_within", "_before")["value"].alias(alias))
