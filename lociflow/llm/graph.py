"""Connected components of a link table, computed in Spark by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import discard, materialize


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(id, component): the smallest id reachable from every id in ``links`` (a, b).

    Each round takes the least label among neighbours and then the label's own label, which
    halves the remaining depth; rounds are written to the shared folder.  Empty links give
    an empty table.  ``rows``: about as many links as there are at most.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "edges", rows)
    many = both.count()
    state = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label"), F.lit(None).cast("long").alias("was")), "labels", many)
    while True:
        now = state.select("id", "label")
        seen = both.join(now.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        moved = now.join(seen.withColumnRenamed("a", "id"), "id").select("id", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        jump = moved.select(F.col("id").alias("to"), F.col("to").alias("further"))
        after = materialize(moved.join(jump, "to").select("id", F.least("to", "further").alias("label"), "was"), "labels", many)
        discard(state)
        state = after
        if not state.where("label <> was").limit(1).count():
            discard(both)
            out = state.select("id", F.col("label").alias("component"))
            out._lociflow_path = state._lociflow_path
            return out
