"""Helpers shared by the operators: shared folders, materialised tables, fixed hashes."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIR: str | None = None
#: White space that separates words: space and U+0009 to U+000D.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
#: Bits of the table of wanted keys (8 MB at any input).
WANTED_BITS = 26
#: Rows of a narrow table that one file should hold.
ROWS_PER_FILE = 500_000
#: Bytes of a row group, which a task holds whole while it writes or reads it.
ROW_GROUP = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where that is unset a temporary folder serves, but only for a local master: on a cluster
    each executor would write to its own disk, so that is an error.
    """
    global _LOCAL_DIR
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _LOCAL_DIR is None:
        _LOCAL_DIR = "file://" + tempfile.mkdtemp(prefix="lociflow-")
    return _LOCAL_DIR


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the actions inside (dots as double underscores), put back afterwards."""
    before = {}
    for name, value in values.items():
        key = name.replace("__", ".")
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def materialize(df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again.

    ``rows``, about as many as a narrow table has at most, keeps its files from being many and tiny: the
    last stage then runs as that many tasks as files are needed, and one per core at least.
    This cuts the lineage: a lost executor costs a re-read of the table, not a recomputation.
    Spark drops the shuffle files of the write when it ends; tables that nobody discards go
    when the application ends.
    """
    spark = df.sparkSession
    top = f"{shared_dir(spark)}/tables-{spark.sparkContext.applicationId}"
    path = f"{top}/{tag}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_FILE)))
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    files, target = _file_system(spark, top)
    files.deleteOnExit(target)
    out = spark.read.schema(df.schema).parquet(path)
    out._lociflow_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables made by ``materialize`` that no later plan reads."""
    for df in tables:
        path = getattr(df, "_lociflow_path", None)
        if path:
            files, target = _file_system(df.sparkSession, path)
            files.delete(target, True)


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, which gives back what Arrow's pool holds of its batches: Spark keeps a worker and its pool for other tasks."""

    @functools.wraps(run)
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return work


def key_bit(key: Column) -> Column:
    """The bit of a key in a bitmap of ``WANTED_BITS`` bits."""
    return F.pmod(F.xxhash64(key), F.lit(1 << WANTED_BITS)).cast("int")


def bitmap_of(bits: DataFrame) -> np.ndarray:
    """Bitmap of the one int column of ``bits``: ``WANTED_BITS`` bits at any input.

    It lets the rows through that a join may need, before their texts are worked on or moved; a
    shared bit only lets a row through that the join then drops.
    """
    name = bits.columns[0]
    words = bits.select(F.expr(f"{name} div 64").cast("int").alias("word"), F.expr(f"shiftleft(1L, cast({name} % 64 as int))").alias("bits"))
    out = np.zeros(1 << (WANTED_BITS - 6), np.int64)
    table = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # 2 ** 20 rows at most
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out


def in_bitmap(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 6] >> (bits & 63)) & 1 == 1


def without_rows(docs: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows that ``known`` (``key``, stays) rules out.

    A key that is not in ``known`` stays.  One that is in it with stays true stays once, and
    with stays null as often as it occurs.  Only rows whose key may be in ``known``, by a bitmap
    of fixed size, are moved to meet it; all others pass where they are.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bitmap_of(known.select(key_bit(F.col(key)).alias("b"))))

    @F.pandas_udf("boolean")
    def possible(b: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bits.value, b.to_numpy()))

    marked = docs.withColumn("__possible", possible(key_bit(F.col(key))))
    sure = marked.where("not __possible").drop("__possible")
    met = marked.where("__possible").drop("__possible").join(known.select(key, F.lit(True).alias("__known"), F.col("stays").alias("__stays")), key, "left")
    met = met.where("__known is null or __stays is null or __stays")
    once = met.where("__known and __stays").dropDuplicates([key]).select(docs.columns)
    often = met.where("__known is null or __stays is null").select(docs.columns)
    return sure.unionByName(often).unionByName(once)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound what one Arrow batch of whole texts can hold, in rows and in bytes.

    Plans made here run later, under the session's settings then; so these stay set, as bounds
    that only get smaller.
    """
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        held = spark.conf.get(key, None)
        if held is None or not held.isdigit() or not 0 < int(held) <= value:
            spark.conf.set(key, str(value))


def id_bucket(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def id_bucket_py(value, modulus: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus
