"""Exact length histogram of encoded documents (operator 4).

Each document is encoded once with a public byte-level vocabulary; only its length leaves
the task, and lengths are summed into one row per distinct length before the shuffle.
The histogram is written once; suffix sums over it answer, for every context limit: how many
documents reach the limit, the tokens that fit in it, quantiles and totals.  The suffix sums run in two
levels (blocks of lengths, then lengths inside a block), so no task reads the whole
histogram.

Edge cases: null and empty texts have length 0 and are counted; very long texts are encoded
whole; repeated rows count as often as they occur; clashing extra columns are not read; an
empty table gives an empty histogram, and limits then have zero totals.  The vocabulary is read
from a folder that every executor has; its path is a parameter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociflow.llm.common import materialize, small_batches

#: Folder of the public vocabulary files; the path is a parameter of every function here.
TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The published splitting pattern of this byte-level vocabulary (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 1024


@lru_cache(maxsize=2)
def encoder(folder: str, vocabulary: str):
    import tiktoken

    with open(f"{folder}/{vocabulary}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(docs: DataFrame, text: str = "text", folder: str = TOKENIZER_DIR, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row (n_tokens) for each row of ``docs``."""
    small_batches(docs.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(folder, vocabulary).encode_ordinary
        for batch in batches:
            yield pa.record_batch([pa.array([len(encode(t)) if t else 0 for t in batch.column(0).to_pylist()], pa.int64())], ["n_tokens"])

    return docs.select(text).mapInArrow(lengths, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """Per distinct length L, read as a context limit.

    n_docs: documents of length L; docs_at_least / tokens_at_least: those of length >= L;
    docs_below / tokens_below: the others; tokens_within_limit: the sum of min(length, L),
    what remains when every document is cut at L; tokens_cut: the rest; docs_total,
    tokens_total; quantile: the part of documents of length <= L.
    For a limit between two lengths, the row of the next greater length holds the suffix
    (``answer_limits``).
    """
    h = materialize(histogram, "lengths").withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("block", F.expr(f"n_tokens div {BLOCK}"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # one row per 1,024 lengths: the block table is bounded by the longest document
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(Window.partitionBy(F.lit(1))).alias("docs_total"),
        F.sum("t").over(Window.partitionBy(F.lit(1))).alias("tokens_total"),
    )
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = h.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(inside) + F.col("docs_after")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("tokens_after")).alias("tokens_at_least"),
        "docs_total",
        "tokens_total",
    )
    out = out.withColumn("docs_below", F.col("docs_total") - F.col("docs_at_least")).withColumn("tokens_below", F.col("tokens_total") - F.col("tokens_at_least"))
    out = out.withColumn("tokens_within_limit", F.col("tokens_below") + F.col("n_tokens") * F.col("docs_at_least"))
    return out.withColumn("tokens_cut", F.col("tokens_total") - F.col("tokens_within_limit")).withColumn(
        "quantile", (F.col("docs_below") + F.col("n_docs")) / F.col("docs_total")
    )


def answer_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """docs_over, tokens_cut and tokens_within_limit for any limits, exact.

    One pass over the table reads, for all of them, the suffix sums of the next longer length.
    """
    wanted = sorted({int(x) for x in limits})
    following = [F.min(F.when(F.col("n_tokens") > x, F.struct("n_tokens", "docs_at_least", "tokens_at_least"))).alias(f"x{k}") for k, x in enumerate(wanted)]
    row = table.agg(F.max("tokens_total").alias("total"), *following).first()
    out = []
    for k, x in enumerate(wanted):
        found = row[f"x{k}"]
        over, tokens = (found["docs_at_least"], found["tokens_at_least"]) if found else (0, 0)
        out.append((x, over, tokens - x * over, (row["total"] or 0) - (tokens - x * over)))
    return table.sparkSession.createDataFrame(out, "context_limit long, docs_over long, tokens_cut long, tokens_within_limit long")


def quantile_lengths(table: DataFrame, quantiles: list[float]) -> DataFrame:
    """The least length that at least the given part of documents does not exceed; null on an empty table."""
    wanted = sorted({float(q) for q in quantiles})
    row = table.agg(*[F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias(f"x{k}") for k, q in enumerate(wanted)]).first()
    return table.sparkSession.createDataFrame([(q, row[f"x{k}"]) for k, q in enumerate(wanted)], "q double, n_tokens long")
