"""Places over a table and inside hot keys."""

import random
import statistics

from pyspark.sql import functions as F

from lociflow.operators import ranks
from lociflow.operators import relational as R


def skewed(spark, n=3000):
    rng = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", None, *map(str, range(40))]), rng.randrange(50)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k string, o int").repartition(5)


def test_places_over_the_whole_table(spark):
    rows, df = skewed(spark)
    for size in (10**6, 200):
        got = ranks.numbered(df, ["o"], "i", size).collect()
        assert sorted(r.i for r in got) == list(range(1, len(rows) + 1))
        by_place = sorted(got, key=lambda r: r.i)
        assert [r.o for r in by_place] == sorted(r[2] for r in rows)
    assert ranks.numbered(df.where("o < 0"), ["o"], "i").count() == 0
    again = {r.id: r.i for r in ranks.numbered(df.repartition(2), ["o"], "i", 300).collect()}
    assert again == {r.id: r.i for r in got}  # ties stand the same in every run


def test_places_in_hot_keys_and_even_partitions(spark):
    rows, df = skewed(spark)
    got = ranks.ranked(df, ["k"], ["o", "id"], "i", 150).collect()
    want, seen = {}, {}
    for i, k, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2], r[0])):
        seen[k] = want[i] = seen.get(k, 0) + 1
    assert {r.id: r.i for r in got} == want
    # a third of the rows has one key, and one order value half of those: no partition has more than twice the median
    flat = df.withColumn("o", F.when(F.col("k") == "hot", F.col("o") % 2).otherwise(F.col("o")))
    dealt = flat.repartitionByRange(20, "k", "o", F.xxhash64("id", "k", "o")).groupBy(F.spark_partition_id().alias("p")).count().collect()
    sizes = [r["count"] for r in dealt]
    assert len(sizes) == 20 and max(sizes) <= 2 * statistics.median(sizes)


def test_bag_semi_join_with_a_hot_key(spark):
    rows, df = skewed(spark)
    wanted = [("hot",)] * 700 + [("a",)] * 2 + [("zz",)] + [(None,)]
    got = sorted(r.id for r in R.bag_semi(df, spark.createDataFrame(wanted, "k string"), ["k"], "id").collect())
    hot, a = ([r[0] for r in rows if r[1] == k] for k in ("hot", "a"))
    assert got == sorted(hot[:700] + a[:2])


def test_overlay_with_a_hot_key(spark):
    n = 900
    df = spark.createDataFrame([(i, f"r{i}", "positive", "hot") for i in range(n)], "o long, audit_id string, cls string, k string")
    notes = spark.createDataFrame([(i, "x", "positive", "hot", f"v{i}") for i in range(n // 2)], "n long, audit_id string, cls string, k string, v string")
    got = {r.o: r.v for r in R.overlay(df, notes, "audit_id", ["k"], "cls", ["v"], "o", "n").collect()}
    assert got == {i: f"v{i}" if i < n // 2 else None for i in range(n)}
