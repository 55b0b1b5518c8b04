"""Tables that cut lineage: Parquet in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a temporary folder, in local mode alone: elsewhere each machine would have its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="ohmbridge-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, parts) -> None:
    """A text, or the parts of one as they come, as one file on any file system that Spark reaches."""
    fs, p = _file_system(spark, path)
    # no checksum files beside it on a local disk
    fs.setWriteChecksum(False)
    try:
        out = fs.create(p, True)
    finally:
        fs.setWriteChecksum(True)
    try:
        for part in [parts] if isinstance(parts, str) else parts:
            out.write(bytearray(part.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """What such a file holds; None where there is none."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    found = fs.open(p)
    try:
        return bytes(found.readAllBytes()).decode()
    finally:
        found.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/ohmbridge/{name}-{uuid.uuid4().hex}"
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    return path


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again; ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing reads it any more."""
    for df in tables:
        path = getattr(df, "_scratch", None)
        if path:
            fs, p = _file_system(df.sparkSession, path)
            fs.delete(p, True)
