"""The training-data pipeline: language ID, near duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as Parquet in the shared folder and reads it again as the next stage's input.  All stages
but the last return the columns of ``documents``, with whatever other columns they have.

Edge cases, of every stage: an empty table gives an empty one; repeated rows are rows of their own but where a stage
says otherwise; texts are read whole, whatever their length; further columns pass unchanged, whatever their names, but for those
that ``shard`` sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.llm import decontam, jaccard, langid, mixing, sharding
from lociflow.llm.common import id_bucket, materialize, without_rows

#: Near duplicates: five-word shingles, Jaccard of 0.8 or more.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
#: Mixing takes every document at most once here.
PIPELINE_EPOCHS, PIPELINE_BUDGET_PERCENT = 1, 60


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with its further columns under names that no stage uses; ``toDF`` gives them their own back."""
    return docs.toDF(*[c if c in ("doc_id", "text", "lang", "source") else f"further{k}" for k, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compressor decides; undecided ones go.

    Null, empty and letterless texts, and ties of two languages, are undecided.  Null languages are not learned from; without any
    to learn from all documents go.
    """
    dictionaries = langid.fit_dictionaries(docs.where(id_bucket(F.col("doc_id"), 3) != 1))
    apart = _apart(docs)
    return langid.identify(apart, dictionaries).where("not rejected").select(apart.columns).toDF(*docs.columns)


def _with_row_key(docs: DataFrame) -> DataFrame:
    """``__row``: a 64-bit hash of id and text, which stands for the row where ids are null or repeated.

    Rows that share it have equal ids and texts (two others share one with a chance of about
    n^2 / 2^65), so every decision about a row holds for its repeats.
    """
    return docs.withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), "text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component (null ids last).

    Rows that repeat one id and text keep one row; wordless texts without an id stay.  Only rows
    that go, or that occur more than once, are looked up; the others are not moved.
    """
    found = jaccard.jaccard_components(docs, SHINGLE_WORDS, SIMILARITY_PERCENT, links=False)
    n = docs.count()
    found = materialize(found.select("row", "doc_id", "component", "n_shingles"), "found", n)
    nameless = F.col("doc_id").isNull()
    first = found.groupBy("component").agg(F.min(F.struct(nameless.alias("nameless"), "doc_id", "row")).alias("m"), F.count("*").alias("n")).where("n > 1").select("component", F.col("m.row").alias("first"))
    rows = found.join(first, "component").groupBy("row").agg(F.max(F.when(nameless & (F.col("n_shingles") == 0), 1).otherwise(0)).alias("free"), F.min("first").alias("first"))
    apart = _apart(docs)
    known = rows.select(F.col("row").alias("__row"), F.when(F.col("free") == 0, F.col("row") == F.col("first")).alias("stays"))
    return without_rows(_with_row_key(apart), materialize(known, "known", n), "__row").select(apart.columns).toDF(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; all rows of a hit id and text go, and only those.

    Null and wordless texts have no window and stay; an item of fewer words than a window is one; items without id are sought too.
    """
    apart = _apart(docs)
    keyed = _with_row_key(apart)
    hits = decontam.contamination(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="__row", slop=0)
    bad = hits.where(F.size("exact_items") > 0).select(F.col("doc_id").alias("__row")).distinct()
    return without_rows(keyed, materialize(bad.withColumn("stays", F.lit(False)), "bad", docs.count()), "__row").select(apart.columns).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the leaf budgets select.

    A null language or source counts as the empty name; null and wordless texts cost nothing; repeated rows are
    selected as often as they occur.
    """
    apart = _apart(docs)
    return mixing.mix_sources(apart, budget_percent=PIPELINE_BUDGET_PERCENT, max_epochs=PIPELINE_EPOCHS).select(apart.columns).toDF(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot; columns of the names that it sets are replaced.

    A null text counts as the empty one and a null id sorts first; rows that agree in id and text share a shard.
    """
    return sharding.histogram_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: Compression and shingle components have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
