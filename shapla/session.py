"""Session helpers: table loading, shared working folder, size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted rows times its row width stay below this many bytes.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); a private one only where it is unset and Spark runs on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "shapla-shared")
    return base.rstrip("/")


_made: list[str] = []


def materialize(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives the loss of executors.

    The folder lives until `clean` or the end of the Python process.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/shapla/{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean_at_exit)
    _made.append(path)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its form."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.delete(p, True)


def clean(spark: SparkSession) -> int:
    """Deletes what `materialize` has written so far; DataFrames built on it can't be used any more."""
    n = len(_made)
    while _made:
        remove(spark, _made.pop())
    return n


def _clean_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    try:
        if spark is not None:
            clean(spark)
    except Exception:  # noqa: BLE001 - the JVM may be gone
        pass


def broadcast_if(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """`df` with a broadcast hint when its counted size is below BROADCAST_BYTES; else as it is (shuffled join)."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
