"""Places of rows in an order, over a whole table or inside their key, without one task that sorts it all (WIN-05, JN-10, JN-11).

Rows are range-partitioned by key, order and a hash of the whole row, so ties and hot keys spread over partitions; what a
partition holds is sorted there once and written with its index.  Counts per partition are added up (one row per
partition), and a place is the partition's offset and the index.  Inside a key the place of the key's
first row is taken off.  Partitions are as many as make ``ROWS`` rows each.

Nulls sort first; rows that tie in the order stand by their hash, the same in every run; rows that are equal in all
columns are interchangeable.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociflow.operators.tables import written

#: Rows of a partition; partitions up to which their offsets are broadcast (16 bytes each).
ROWS, MOST_BROADCAST = 1_000_000, 1 << 20
_INDEX_BITS = 33


def _placed(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """``df`` with ``__place``, from 0, in the order of ``by``."""
    count = df.count()
    pieces = max(1, -(-count // rows))
    tie = F.xxhash64(*[F.col(c) for c, kind in df.dtypes if not kind.startswith(("map", "variant"))])
    order = [F.col(c) for c in by] + [tie]
    # the index in the partition: the lower bits of what Spark numbers rows with
    dealt = df.repartitionByRange(pieces, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    table = written(dealt, "ordered").withColumn("__piece", F.shiftright("__at", _INDEX_BITS)).withColumn("__at", F.expr(f"__at & {(1 << _INDEX_BITS) - 1}L"))
    sizes = table.groupBy("__piece").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__piece", before.alias("__before"))  # one row per partition
    joined = table.join(F.broadcast(offsets) if pieces <= MOST_BROADCAST else offsets, "__piece")
    return joined.withColumn("__place", F.col("__before") + F.col("__at")).drop("__piece", "__at", "__before")


def numbered(df: DataFrame, order: list[str], out: str, rows: int = ROWS) -> DataFrame:
    """Adds the 1-based place of every row in the order of the columns ``order``."""
    return _placed(df, order, rows).withColumn(out, F.col("__place") + 1).drop("__place")


def ranked(df: DataFrame, keys: list[str], order: list[str], out: str, rows: int = ROWS) -> DataFrame:
    """Adds the 1-based place of every row among the rows of its key; null keys are one key."""
    placed = _placed(df, [*keys, *order], rows)
    starts = placed.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min("__place").alias("__start"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    # one row per key on the right: a hot key's rows on the left are split where the join is skewed
    joined = placed.join(starts, same)
    return joined.withColumn(out, F.col("__place") - F.col("__start") + 1).select(*df.columns, out)
