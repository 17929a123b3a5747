"""Incremental ingest: a folder of article files as a stream, merged by key into a table of hash buckets.

A table is a folder of data folders and manifests.  A manifest names, for every bucket of the key's hash, the data folder that
holds it; the newest is the table.  A micro-batch rewrites only the buckets that its keys fall in, into a
folder of its own, and commits by one atomic rename of its manifest.  So readers see a batch whole or not at all, a batch that died
before its commit leaves nothing that is read, and one that is replayed after it does nothing.  Old versions go when
no reader holds them.  One stream writes a table.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lociflow.operators.relational import last_wins, replace_by_key
from lociflow.operators.tables import file_system, read_text, write_text
from lociflow.sources.readers import ARTICLES

#: Buckets of a new table, and versions that stay readable without a hold.
BUCKETS, KEEP = 64, 2
_BUCKET = "__bucket"


def article_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(ARTICLES).option("maxFilesPerTrigger", files_per_batch).json(folder)


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, at = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def versions(spark: SparkSession, target: str) -> list[int]:
    """Committed versions, oldest first."""
    return [int(n.removesuffix(".json")) for n in _names(spark, f"{target}/manifests") if n.endswith(".json")]


def manifest(spark: SparkSession, target: str, version: int) -> dict:
    return json.loads(read_text(spark, f"{target}/manifests/{version:010d}.json"))


def read_table(spark: SparkSession, target: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """A version of the table (the newest by default), or some of its buckets; None before the first commit."""
    known = versions(spark, target)
    if not known:
        return None
    found = manifest(spark, target, known[-1] if version is None else version)
    paths = [f"{target}/data/{folder}/{_BUCKET}={k}" for k, folder in found["buckets"].items() if buckets is None or int(k) in buckets]
    schema = StructType.fromJson(found["schema"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


@contextlib.contextmanager
def held(spark: SparkSession, target: str) -> Iterator[DataFrame]:
    """The newest version, which stays readable until the block ends, whatever is written meanwhile."""
    version = versions(spark, target)[-1]
    path = f"{target}/holds/{version}-{uuid.uuid4().hex}"
    write_text(spark, path, "", replace=False)
    try:
        yield read_table(spark, target, version)
    finally:
        files, at = file_system(spark, path)
        files.delete(at, False)


def vacuum(spark: SparkSession, target: str, keep: int = KEEP) -> int:
    """Delete versions but for the last ``keep`` and held ones, and data folders that no other names; returns how many folders went."""
    known = versions(spark, target)
    stay = {*known[-keep:], *(int(n.partition("-")[0]) for n in _names(spark, f"{target}/holds"))}
    for v in known:
        if v not in stay:
            files, at = file_system(spark, f"{target}/manifests/{v:010d}.json")
            files.delete(at, False)
    used = {folder for v in stay if v in known for folder in manifest(spark, target, v)["buckets"].values()}
    gone = [n for n in _names(spark, f"{target}/data") if n not in used]
    for name in gone:
        files, at = file_system(spark, f"{target}/data/{name}")
        files.delete(at, True)
    return len(gone)


def merge_batch(batch: DataFrame, version: int, target: str, key: str = "pmid", buckets: int = BUCKETS, keep: int = KEEP) -> dict | None:
    """Replace-by-key merge of ``batch`` into the table, as ``version``; the last of several rows of a key counts.

    Returns the manifest, or None where this version or a later one is committed already.  It has the numbers of rows that were new,
    written and in all, so the share that a batch rewrites can be watched.
    """
    spark = batch.sparkSession
    known = versions(spark, target)
    if known and known[-1] >= version:
        return None
    before = manifest(spark, target, known[-1]) if known else None
    n = before["n_buckets"] if before else buckets
    new = last_wins(batch.withColumn("__o", F.monotonically_increasing_id()), [key], "__o").drop("__o")
    schema = new.schema.jsonValue()
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")
    new = new.withColumn(_BUCKET, bucket).persist()
    try:
        counts = {r[0]: r[1] for r in new.groupBy(_BUCKET).count().collect()}  # a row per touched bucket
        merged = new
        touched = [k for k in counts if before and str(k) in before["buckets"]]
        if touched:
            old = read_table(spark, target, known[-1], touched)
            merged = replace_by_key(old.withColumn(_BUCKET, bucket), new, key)
        folder = f"{version:010d}-{uuid.uuid4().hex[:12]}"
        merged.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{target}/data/{folder}")
    finally:
        new.unpersist()
    written = {str(r[0]): r[1] for r in spark.read.parquet(f"{target}/data/{folder}").groupBy(_BUCKET).count().collect()} if counts else {}
    rows = {**(before["rows"] if before else {}), **written}
    out = {
        "version": version, "n_buckets": n, "schema": schema, "buckets": {**(before["buckets"] if before else {}), **dict.fromkeys(written, folder)}, "rows": rows,
        "new_rows": sum(counts.values()), "written_rows": sum(written.values()), "total_rows": sum(rows.values()),
    }
    if not write_text(spark, f"{target}/manifests/{version:010d}.json", json.dumps(out), replace=False):
        return None
    vacuum(spark, target, keep)
    return out


def upsert(stream: DataFrame, target: str, checkpoint: str, key: str = "pmid", buckets: int = BUCKETS, keep: int = KEEP) -> StreamingQuery:
    """Merge every micro-batch of ``stream`` into the table at ``target``; the batch's number is the version."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, target, key, buckets, keep)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts per tumbling window with a bound on late rows."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), by).count()
