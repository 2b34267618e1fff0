"""Sessions, and what Python workers need to find this package."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parent.parent)
#: Rows of pairs of ids that are sent to every task (some 100 bytes each).
BROADCAST_ROWS = 300_000


def local_session(cpus: int = 8, name: str = "kithlink") -> SparkSession:
    """A session for one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KITHLINK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, and send them batches that a few MB of memory hold, unless the session says how many rows."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(rows) and spark.conf.get(rows) == "10000":
        spark.conf.set(rows, "2000")
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *paths]))
    return spark


def checkpoint_folder(spark: SparkSession) -> None:
    """Let RDDs be kept in the folder of spark.checkpoint.dir; a temporary one stands in only where that is unset and all runs on this machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="kithlink-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """df, kept in the folder that checkpoint_folder sets."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def kept_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, where tasks can open files."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(root or 'file://' + tempfile.mkdtemp(prefix='kithlink-')).rstrip('/')}/kithlink/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """df, written as Parquet at such a path, in a folder for each value of the columns `by`, which are the last ones."""
    path = kept_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str) -> DataFrame:
    """df, kept, and to be sent to every task if it has few rows, so that what it is joined with needn't be shuffled."""
    rows = kept(df, name)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def opened(uri: str):
    """The store of a file and its path there, for pyarrow."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])
