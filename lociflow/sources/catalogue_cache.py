"""A cache of catalogue payloads that asks only for what it lacks (SRC-19).

The cache is a table of hash buckets by name: (rs, state, payload, checked_at).  States: found, absent (the catalogue has no such name)
and failed (no answer).  A refresh asks for wanted names that the cache does not know, or whose answer is older than its state
may be, and merges the answers by name; so a run that follows at once asks for nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.operators.tables import written
from lociflow.streaming import ingest

#: Seconds for which an answer holds: found, absent, failed.
DAY = 86_400
MAX_AGE = {"found": 180 * DAY, "absent": 30 * DAY, "failed": DAY}
COLUMNS = ["rs", "state", "payload", "checked_at"]


@dataclass(frozen=True)
class Refresh:
    """How many names were wanted, known and fresh, asked for, and of these found, absent and failed."""

    wanted: int
    fresh: int
    asked: int
    found: int
    absent: int
    failed: int


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    table = ingest.read_table(spark, path)
    return spark.createDataFrame([], "rs string, state string, payload string, checked_at long") if table is None else table.select(COLUMNS)


def stale_or_missing(wanted: DataFrame, cache: DataFrame, now: int, max_age: dict[str, int] = MAX_AGE) -> DataFrame:
    """(rs) of wanted names without a fresh answer; null and blank names are left out."""
    names = wanted.select(F.lower(F.trim("rs")).alias("rs")).where("rs <> ''").distinct()
    holds = F.create_map(*[F.lit(x) for kv in max_age.items() for x in kv])[F.col("state")]
    return names.join(cache.where(F.lit(now) - F.col("checked_at") < holds).select("rs"), "rs", "left_anti")


def refresh(wanted: DataFrame, path: str, fetch: Callable[[DataFrame], DataFrame], now: int, max_age: dict[str, int] = MAX_AGE, buckets: int = 64) -> Refresh:
    """Bring the cache at ``path`` up to date for the names in ``wanted`` (rs), as of ``now`` (seconds).

    ``fetch`` takes (rs) and returns (rs, payload, error): an error means no answer; a row that is missing, or has neither, that the
    catalogue lacks the name.
    """
    spark = wanted.sparkSession
    cache = read_cache(spark, path)
    asked = written(stale_or_missing(wanted, cache, now, max_age), "asked")
    n = asked.count()
    total = wanted.select(F.lower(F.trim("rs")).alias("rs")).where("rs <> ''").distinct().count()
    if not n:
        return Refresh(total, total, 0, 0, 0, 0)
    answers = fetch(asked).select(F.col("rs").alias("__rs"), "payload", "error")
    state = F.when(F.col("error").isNotNull(), "failed").when(F.col("payload").isNotNull(), "found").otherwise("absent")
    rows = written(asked.join(answers, F.col("rs") == F.col("__rs"), "left").select("rs", state.alias("state"), F.when(F.col("error").isNull(), F.col("payload")).alias("payload"), F.lit(now).cast("long").alias("checked_at")), "answers")
    # no answer does not drop one that is there: it stays, as old as it was
    known = cache.where("state = 'found'").select("rs", F.lit(True).alias("__kept"))
    kept = rows.join(known, "rs", "left").where("not (state = 'failed' and __kept is not null)").select(COLUMNS)
    versions = ingest.versions(spark, path)
    ingest.merge_batch(kept, versions[-1] + 1 if versions else 0, path, "rs", buckets)
    by_state = {r.state: r["count"] for r in rows.groupBy("state").count().collect()}  # three rows
    return Refresh(total, total - n, n, by_state.get("found", 0), by_state.get("absent", 0), by_state.get("failed", 0))
