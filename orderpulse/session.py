"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for a cluster session. Batch shuffles start wide and AQE merges small partitions,
# so the same code fits megabytes and terabytes. Streams cannot be re-planned: their state
# is split by spark.sql.shuffle.partitions, fixed at the first start of a checkpoint.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Times with minimum and maximum in the file footers, so that time ranges skip files.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Dedup on event_id alone never forgets an id, so its state must live on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def cluster_builder(name: str = "orderpulse") -> SparkSession.Builder:
    builder = SparkSession.builder.appName(name)
    for key, value in CLUSTER_SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def use_utc(spark: SparkSession) -> SparkSession:
    """All times in the model are UTC; times without a zone mean UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def store_times_with_statistics(spark: SparkSession) -> None:
    """Stored times carry no minimum and maximum in Spark's default format; called before tables are written."""
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="orderpulse-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
