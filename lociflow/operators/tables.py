"""Tables that a plan writes in the shared folder and reads again, to cut lineage and to fix what must not be computed twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; for a local master only, a temporary one where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="lociflow-"))
    return _LOCAL[0]


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, which goes when the application ends."""
    top = f"{shared_folder(spark)}/lociflow-{spark.sparkContext.applicationId}"
    files, at = file_system(spark, top)
    files.mkdirs(at)
    files.deleteOnExit(at)
    return f"{top}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet and read again: a lost executor then costs a read, and a second use no second run."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_text(spark: SparkSession, path: str) -> str:
    files, at = file_system(spark, path)
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a small file whole, by a draft and a rename; false, and no change, where it exists and is not to be replaced."""
    files, at = file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if replace and files.exists(at):
        files.delete(at, False)
    done = not files.exists(at) and files.rename(draft, at)
    if not done:
        files.delete(draft, False)
    return bool(done)
