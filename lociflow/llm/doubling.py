"""Prefix doubling over every position, as it is usually written (the check of operator 7).

Each position starts with the rank of its first eight bytes.  In every round Spark sorts the
pairs (rank, rank at the offset) over all partitions and numbers the distinct pairs; positions
whose pair occurs in one row only leave, and so do those whose second half has left.  The offset
doubles until the ranks cover ``threshold`` bytes.  What is left at the end repeats.

A round moves every position that is left several times, some 16 bytes each: the README has
measured figures.  ``suffix`` gives the same result at a fraction of that, which the tests compare.

Edge cases: null texts have no positions; rows are told apart by a hash of id and text, so repeated rows are one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import discard, materialize, small_batches

FIRST = 8


def _positions(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(text or b"", np.uint8)
                n = len(data) - FIRST + 1
                for lo in range(0, max(0, n), 100_000):
                    part = np.lib.stride_tricks.sliding_window_view(data, FIRST)[lo : lo + 100_000]
                    rank = np.ascontiguousarray(part).view(">i8").reshape(-1).astype(np.int64)
                    yield pa.record_batch([pa.array(np.full(len(rank), row)), pa.array(np.arange(lo, lo + len(rank))), pa.array(rank)], ["row", "pos", "rank"])

    return docs.select("row", "text").mapInArrow(run, "row long, pos long, rank long")


def _reranked(pairs: DataFrame) -> DataFrame:
    """(row, pos, rank) from (row, pos, r1, r2): equal pairs get one number, in the order of the pairs."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, -1
        for batch in batches:
            part, r1, r2 = (batch.column(k).to_numpy() for k in (0, 3, 4))
            if not len(r1):
                continue
            fresh = np.append((r1[0], r2[0]) != last, (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1]))
            rank = at + np.cumsum(fresh)
            at, last = int(rank[-1]), (r1[-1], r2[-1])
            yield pa.record_batch([batch.column(1), batch.column(2), pa.array((part.astype(np.int64) << 40) + rank)], ["row", "pos", "rank"])

    ordered = pairs.repartitionByRange("r1", "r2").sortWithinPartitions("r1", "r2")
    return ordered.select(F.spark_partition_id().alias("part"), "row", "pos", "r1", "r2").mapInArrow(number, "row long, pos long, rank long")


def _repeated(ranks: DataFrame) -> DataFrame:
    several = ranks.groupBy("rank").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a <> b").select("rank")
    return ranks.join(several, "rank", "left_semi").select("row", "pos", "rank")


def repeated_positions(docs: DataFrame, threshold: int = 50, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, row, pos): starts of strings of ``threshold`` bytes that also start in a document with a smaller id."""
    small_batches(docs.sparkSession, 64)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).withColumn("row", F.xxhash64("doc_id", "text")).dropDuplicates(["row"])
    state = materialize(_repeated(_positions(rows)), "ranks")
    length = FIRST
    while length < threshold:
        offset = min(length, threshold - length)
        second = state.select("row", (F.col("pos") - offset).alias("pos"), F.col("rank").alias("r2"))
        after = materialize(_repeated(_reranked(state.withColumnRenamed("rank", "r1").join(second, ["row", "pos"]))), "ranks")
        discard(state)
        state, length = after, length + offset
    named = state.join(rows.select("row", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id")), "row")
    least = named.groupBy("rank").agg(F.min("doc_id").alias("least"))
    return named.join(least, "rank").where("doc_id > least").select("doc_id", "row", "pos")
