"""Small pieces that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.session import work_folder

PIECE_BYTES = 4 << 20  # texts are worked on in pieces of about this size, which bounds memory


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns that are needed, so that no further column can get in the way."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_bytes(column: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts make up about `size` bytes; a longer text is a run of its own."""
    sizes = np.array([x or 0 for x in pa.compute.binary_length(batch.column(column)).to_pylist()], np.int64)
    long = np.flatnonzero(sizes > size)
    cut = np.unique(np.r_[np.flatnonzero(np.diff(np.cumsum(sizes) // size)) + 1, long, long + 1])
    start = 0
    for stop in [*cut.tolist(), batch.num_rows]:
        if stop > start:
            yield batch.slice(start, stop - start)
        start = stop


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 64-bit integers that spreads every input bit (SplitMix64's finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stored(frame: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """The frame written to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = work_folder(spark, purpose)
    frame.write.option("compression", compression).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


class Scratch:
    """Intermediate tables of one job in the shared folder, each removed as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def store(self, frame: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
        path = work_folder(self.spark, purpose)
        frame.write.option("compression", compression).parquet(path)
        out = self.spark.read.schema(frame.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def free(self, *frames: DataFrame) -> None:
        """Remove the tables of frames that `store` returned; others are left alone."""
        for frame in frames:
            _, path = self.paths.pop(id(frame), (None, None))
            if path:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def free_all_but(self, *kept: DataFrame) -> None:
        names = {id(k) for k in kept}
        self.free(*[frame for name, (frame, _) in list(self.paths.items()) if name not in names])
