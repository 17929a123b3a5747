"""The reference's key views as a bucketed table on disk, written once and joined without moving it (JN-03, SRC-06).

The exploded keys (step, key, hit) are written in buckets of (step, key), sorted, with a manifest of their schema, buckets and rows.  A join
on step and key then shuffles the asking rows alone, into as many partitions as there are buckets.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lociflow.operators.tables import file_system, read_text, write_text

#: Rows of a bucket, about.
ROWS = 2_000_000


def _table_name(path: str) -> str:
    return "lociflow_index_" + hashlib.sha256(path.encode()).hexdigest()[:16]


def write_index(index: DataFrame, path: str, by: tuple[str, ...] = ("step", "key"), buckets: int | None = None) -> dict:
    """Write ``index`` at ``path``; returns its manifest.  Buckets follow the rows unless they are given."""
    spark = index.sparkSession
    n = buckets or max(1, -(-index.count() // ROWS))
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # each task has whole buckets, so a bucket is one file
    index.repartition(n, *by).write.format("parquet").option("path", path).bucketBy(n, *by).sortBy(*by).mode("overwrite").saveAsTable(name)
    out = {"buckets": n, "by": list(by), "schema": index.schema.jsonValue(), "rows": spark.table(name).count()}
    write_text(spark, f"{path}.index.json", json.dumps(out))
    return out


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, known to this session as bucketed."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        files, note = file_system(spark, f"{path}.index.json")
        if not files.exists(note):
            raise FileNotFoundError(f"no index at {path}")
        known = json.loads(read_text(spark, note.toString()))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(known["schema"]).fields)
        by = ", ".join(known["by"])
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {known['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)
