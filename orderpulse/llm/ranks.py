"""Exact ranks within groups of any size: rows are ranged over all tasks, numbered there, and shifted by what lies before."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderpulse.llm.common import stored


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their task (`_task`) and their number in the task's run of the same `grp` (`_at`)."""
    task, last, held = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        grp = batch["grp"].dictionary_encode()
        codes = grp.indices.to_numpy()
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        at = np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))
        if batch["grp"][0].as_py() == last:
            at[: starts[1] if len(starts) > 1 else n] += held
        last, held = batch["grp"][n - 1].as_py(), int(at[-1]) + 1
        yield batch.append_column("_task", pa.array(np.full(n, task), pa.int32())).append_column("_at", pa.array(at, pa.int64()))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with `rank` (from 0) within the text column `grp`, which must not be null, and the group's size `n`.

    Nulls come first and texts in the order of their UTF-8 bytes. Rows that tie in all columns of `order` get different
    ranks, fixed by where they are read. No group meets in one task; what is summed is one row per task and group.
    """
    by = ["grp", *order, "_tie"]
    placed = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.drop("_tie")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema) + ", _task int, _at long"
    placed = stored(placed.mapInArrow(_numbered, ddl), "ranged")
    held = placed.groupBy("grp", "_task").agg(F.count("*").alias("_held"))
    whole = Window.partitionBy("grp")
    before = F.sum("_held").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select("grp", "_task", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_held").over(whole).alias("n"))
    joined = placed.join(held, ["grp", "_task"])
    return joined.withColumn("rank", F.col("_at") + F.col("_before")).drop("_task", "_at", "_before")
