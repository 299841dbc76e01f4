"""Write, audit, publish: readers of a table see a whole version that passed its contracts, before, during and after."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

from orderpulse.operators.contracts import enforce
from orderpulse.session import store_times_with_statistics

KEPT_VERSIONS = 3  # a reader that holds an older version's plan can finish within so many further publications


def publish(
    spark: SparkSession,
    rows: DataFrame,
    name: str,
    audit: Callable[[DataFrame], DataFrame] | None = None,
    folder: str | None = None,
    kept: int = KEPT_VERSIONS,
) -> list[Row]:
    """Write `rows` once as a new version, audit what was written, then point `name` at it.

    `name` is a view over one version's folder, replaced in a single step, also when the schema changes: there is no
    moment without a table. `audit` maps the written rows to a contract report; a failed contract of severity error
    raises before anything is replaced, and the version is removed. Of earlier versions in `folder` (default: the
    warehouse) the newest stay, `kept` with the new one; publishing moves no data. Returns the report.
    """
    store_times_with_statistics(spark)
    folder = folder or spark.conf.get("spark.sql.warehouse.dir")
    default = folder.removeprefix("file:") == f"{os.getcwd()}/spark-warehouse"
    if default and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.sql.warehouse.dir to a folder every executor can reach")
    versions = f"{folder.rstrip('/')}/versions/{name}"
    path = f"{versions}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(path)
        report = enforce(audit(spark.read.parquet(path))) if audit else []
    except BaseException:
        _remove(spark, path)
        raise
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # once, where a table of an earlier kind stands
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    for old in version_folders(spark, versions)[:-kept]:
        _remove(spark, old)
    return report


def version_folders(spark: SparkSession, versions: str) -> list[str]:
    """Folders of a table's versions, oldest first."""
    top = spark._jvm.org.apache.hadoop.fs.Path(versions)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().toString() for f in files.listStatus(top)) if files.exists(top) else []


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
