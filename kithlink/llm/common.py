"""What the operators share: scratch tables, byte-balanced batches, safe text columns."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only where that is unset and all runs on this machine (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = getattr(spark, "_kithlink_scratch", None)
        if not root:
            root = "file://" + tempfile.mkdtemp(prefix="kithlink-")
            spark._kithlink_scratch = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/kithlink/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage with a written table in the shared folder, and read it back.

    The table is on shared storage, so a lost executor costs nothing that was written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def frugal(run):
    """run, for mapInArrow, with what it has freed given back to the system at its end: Spark keeps workers, and their memory, for later stages."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL(None).malloc_trim(0)

    return go


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that nothing refers to any more; it notices only when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def drop_scratch(*tables: DataFrame) -> None:
    """Delete scratch tables that no returned DataFrame reads."""
    for df in tables:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_lengths(texts: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()


def byte_batches(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes each; a longer row is a range of its own."""
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)
