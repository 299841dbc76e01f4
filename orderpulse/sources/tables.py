"""Catalog tables: names per layer, reads, refreshes and counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.session import store_times_with_statistics


@dataclass(frozen=True)
class Layers:
    """Schema names of the layers. In the `ci` target all layers share one schema."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    target: str = "prod"
    ci_schema: str = "ci"

    def schema(self, layer: str) -> str:
        return self.ci_schema if self.target == "ci" else getattr(self, layer)

    def name(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.read.table(self.name(layer, table))

    def stream(self, spark: SparkSession, layer: str, table: str, files_per_batch: int | None = None) -> DataFrame:
        reader = spark.readStream
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.table(self.name(layer, table))

    def create_schemas(self, spark: SparkSession) -> None:
        for layer in ("bronze", "silver", "gold"):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.schema(layer)}")


def clustered(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows ranged and sorted by `columns`, so that a stored table skips files on range filters.

    Add a unique column at the end: ranges can then also cut through one hot value.
    """
    return rows.repartitionByRange(*columns).sortWithinPartitions(*columns)


def refresh(rows: DataFrame, name: str) -> None:
    """Replace a derived table by its newly computed rows."""
    store_times_with_statistics(rows.sparkSession)
    rows.write.mode("overwrite").format("parquet").saveAsTable(name)


def refresh_bucketed(rows: DataFrame, name: str, key: str, buckets: int) -> None:
    """Same, laid out by `key`, so that aggregates and joins on it need no shuffle.

    All rows of a key share a file, so this is for keys without a hot value.
    """
    store_times_with_statistics(rows.sparkSession)
    (
        rows.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )


def table_folder(spark: SparkSession, name: str) -> str:
    """Where a table lies that is written by its folder."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/folders/{name}"


def over_folder(spark: SparkSession, name: str, folder: str) -> None:
    """Table `name` over a partitioned folder, with the partitions that it has now."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder}'")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def table_count(spark: SparkSession, schema: str) -> int:
    """Number of tables in a schema, without temporary views."""
    return sum(not table.isTemporary for table in spark.catalog.listTables(schema))


def newest_run(runs: DataFrame, time: str = "committed_at") -> DataFrame:
    """The newest row of a run log; only the top row is kept while reading."""
    return runs.orderBy(F.desc_nulls_last(time)).limit(1)
