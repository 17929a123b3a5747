"""Generic relational operators over DataFrames; every tie is settled by an explicit order."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.operators.ranks import numbered, ranked
from lociflow.operators.tables import written

#: Width of an interval bin in bases.
BIN_SIZE = 250_000


def best_per_key(df: DataFrame, keys: list[str], score: list[Column], order: str) -> DataFrame:
    """The row of least (score..., order) per key; one row per key and task is shuffled (Spark aggregates structs by sorting)."""
    packed = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.min_by(packed, F.struct(*[s.alias(f"s{i}") for i, s in enumerate(score)], F.col(order).alias("o"))).alias("__best"))
    return best.select("__best.*")


def latest_by(df: DataFrame, keys: list[str], updated: str, order: str) -> DataFrame:
    """Latest row per key; among equal times the later input row."""
    packed = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(packed, F.struct(F.coalesce(F.col(updated).cast("string"), F.lit("")), F.col(order))).alias("__r")).select("__r.*")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    packed = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(packed, order).alias("__r")).select("__r.*")


def first_per_key(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def multimap(df: DataFrame, key: str, order: str) -> DataFrame:
    """key -> array of row structs in input order (for keys of bounded size, such as one article)."""
    row = F.struct(F.col(order).alias("__o"), *[F.col(c) for c in df.columns if c not in (key, order)])
    return df.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("rows"))


def ladder_lookup(df: DataFrame, row_id: str, keys: Column, table: DataFrame, table_key: str, value: str) -> DataFrame:
    """First successful step of an alternative-key lookup.

    ``keys`` is an array of struct(step, key); a step succeeds when its key has exactly one
    distinct ``value``.  Adds match_step and match_value (null where no step succeeds), and
    match_status ok, ambiguous or missing.
    """
    asked = df.select(F.col(row_id).alias("__id"), F.explode(keys).alias("k")).select("__id", "k.step", "k.key")
    # the table is reduced to one row per key before it meets the rows
    known = table.groupBy(F.col(table_key).alias("key")).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    hits = asked.join(known, "key").groupBy("__id", "step").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    found = hits.groupBy("__id").agg(
        F.min(F.when(F.col("lo") == F.col("hi"), F.struct("step", F.col("lo").alias("v")))).alias("m"),
        F.count("*").alias("n"),
    )
    out = df.join(found, df[row_id] == found["__id"], "left")
    status = F.when(F.col("m").isNotNull(), "ok").when(F.col("n") > 0, "ambiguous").otherwise("missing")
    return out.select(*[df[c] for c in df.columns], F.col("m.step").alias("match_step"), F.col("m.v").alias("match_value"), status.alias("match_status"))


def alternative_key_join(df: DataFrame, keys: list[tuple[str, Column]], table: DataFrame, table_key: str, payload: list[str]) -> DataFrame:
    """Left lookups by each key in order of precedence; the first hit wins, with its method name."""
    out = df
    for i, (_, key) in enumerate(keys):
        right = table.select(F.col(table_key).alias(f"__k{i}"), F.struct(*payload).alias(f"__p{i}"))
        out = out.join(right, key == F.col(f"__k{i}"), "left")
    hit = F.coalesce(*[F.col(f"__p{i}") for i in range(len(keys))])
    method = reduce(lambda c, i: F.when(F.col(f"__p{i}").isNotNull(), keys[i][0]).otherwise(c), range(len(keys) - 1, -1, -1), F.lit("default"))
    out = out.withColumn("match_method", method).withColumn("__hit", hit)
    return out.select(*df.columns, "match_method", *[F.col(f"__hit.{p}").alias(p) for p in payload])


def interval_join(left: DataFrame, right: DataFrame, on: str, left_span: tuple[str, str], right_span: tuple[str, str], bin_size: int = BIN_SIZE) -> DataFrame:
    """Overlapping pairs of closed intervals with equal ``on``.

    Both sides are cut into bins and joined on (on, bin): an equi join that shuffles, where a
    bare range predicate would be a nested loop.  A pair is emitted in the first bin that
    both share, so it needs no distinct afterwards.
    """
    cut = lambda df, lo, hi, name: df.withColumn(name, F.explode(F.sequence(F.floor(F.col(lo) / bin_size), F.floor(F.col(hi) / bin_size))))
    a = cut(left, *left_span, "__bin")
    b = cut(right.withColumnRenamed(on, "__on"), *right_span, "__bin_r")
    (al, ah), (bl, bh) = left_span, right_span
    meets = (F.col(on) == F.col("__on")) & (F.col("__bin") == F.col("__bin_r")) & (F.col(al) <= F.col(bh)) & (F.col(bl) <= F.col(ah))
    first = F.col("__bin") == F.greatest(F.floor(F.col(al) / bin_size), F.floor(F.col(bl) / bin_size))
    return a.join(b, meets).where(first).drop("__bin", "__bin_r", "__on")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores before an expensive function, where its scan may have fewer parts than cores.

    Only an input smaller than one split per core moves, so at most that much is shuffled; larger ones have parts enough.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if estimate < cores * split else df


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt by number over several tasks a core, before a function that costs far more than moving its rows.

    Spark joins the small partitions behind a join by their bytes; those dealt by number stay apart, and hot keys are spread.
    """
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed where they stand: filters on them, Spark's own before an explode included, stay above.

    Else a filter and the costly function in it go below the deal of a small scan, into its one task, and the function runs again
    above.  An observed count keeps them apart.
    """
    return df.observe(f"settled-{uuid.uuid4().hex}", F.count("*").alias("rows"))


def anti_any_key(df: DataFrame, row_id: str, keys: list[Column], excluded: DataFrame, excluded_key: str) -> DataFrame:
    """Rows none of whose keys is excluded; rows without any key stay."""
    hit = df.select(F.col(row_id).alias("__id"), F.explode(F.array_compact(F.array(*keys))).alias("__k")).join(excluded.select(F.col(excluded_key).alias("__k")).distinct(), "__k", "left_semi").select("__id").distinct()
    return df.join(hit, df[row_id] == hit["__id"], "left_anti")


def cohort(df: DataFrame, ids: DataFrame, key: str, expected: int | None = None) -> DataFrame:
    """Rows whose key is listed (FIL-01); where ``expected`` keys must be met, another number is an error that names some of the missing."""
    kept = df.join(ids.select(key).distinct(), key, "left_semi")
    if expected is not None:
        met = kept.select(key).distinct()
        n = met.count()
        if n != expected:
            missing = [r[0] for r in ids.select(key).distinct().join(met, key, "left_anti").orderBy(key).limit(10).collect()]
            raise ValueError(f"{n} of {expected} listed keys are there; missing: {', '.join(map(str, missing)) or 'none of the list'}")
    return kept


def bag_semi(df: DataFrame, wanted: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Multiset semi join: each wanted row keeps one row of ``df`` with its key, in order.

    Wanted rows are counted per key; a row stays when its place in its key is within the count, so no key is one sort.
    """
    asked = wanted.groupBy(*keys).agg(F.count("*").alias("__wanted"))
    known = df.join(asked.select(*keys), keys, "left_semi")
    return ranked(known, keys, [order], "__rn").join(asked, keys).where("__rn <= __wanted").select(df.columns)


def bag_semi_with_fallback(df: DataFrame, wanted: DataFrame, keys: list[str], fallback: list[str], order: str) -> DataFrame:
    """``bag_semi``; what it leaves over is matched again on the shorter key."""
    exact = written(bag_semi(df, wanted, keys, order), "exact")
    rest = df.join(exact.select(order), order, "left_anti")
    used = exact.groupBy(*keys).agg(F.count("*").alias("__u"))
    # how many of a key are still wanted: counts do, as wanted rows of one key are alike
    still = wanted.groupBy(*keys).agg(F.count("*").alias("__n")).join(used, keys, "left").withColumn("__left", F.col("__n") - F.coalesce("__u", F.lit(0)))
    open_ = still.groupBy(*fallback).agg(F.sum("__left").alias("__wanted")).where("__wanted > 0")
    known = rest.join(open_.select(*fallback), fallback, "left_semi")
    more = ranked(known, fallback, [order], "__rn").join(open_, fallback).where("__rn <= __wanted").select(df.columns)
    return exact.unionByName(more)


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows whose key the new rows do not touch, and the new rows."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def overlay(df: DataFrame, notes: DataFrame, row_id: str, keys: list[str], class_key: str, payload: list[str], order: str, note_order: str) -> DataFrame:
    """Annotations onto rows: by id, else by key, else by the key without its class (JN-11).

    A note without content counts for nothing.  By id the last note wins.  By key the rows in order take the notes in order,
    each note once, and never one that an id has taken; the classless key serves rows whose whole key no note has.
    """
    full, loose = [class_key, *keys], keys
    content = reduce(lambda a, b: a | b, [F.coalesce(F.trim(F.col(p).cast("string")), F.lit("")) != "" for p in payload])
    note = notes.where(content).select(F.col(row_id).alias("__nid"), *full, F.col(note_order).alias("__no"), F.struct(*payload).alias("__note"))
    latest = note.where("__nid is not null and __nid <> ''").groupBy("__nid").agg(F.max_by(F.struct("__no", "__note"), "__no").alias("__by_id"))
    out = df.join(latest, df[row_id] == latest["__nid"], "left").drop("__nid")
    taken = out.where("__by_id is not null").select(F.col("__by_id.__no").alias("__no")).distinct()
    free = note.join(taken, "__no", "left_anti")
    named = notes.select(*full).distinct().withColumn("__has", F.lit(True))
    waiting = out.where("__by_id is null").join(named, full, "left")

    def dealt(rows: DataFrame, some: DataFrame, on: list[str]) -> DataFrame:
        # the key and the place in it: a hot key is as many join keys as it has rows
        right = ranked(some.select(*on, "__no", "__note"), on, ["__no"], "__rn")
        return ranked(rows, on, [order], "__rn").join(right, [*on, "__rn"], "left").drop("__rn")

    whole = written(dealt(waiting.where("__has"), free, full), "noted")
    rest = free.join(whole.where("__no is not null").select("__no"), "__no", "left_anti")
    wide = dealt(waiting.where("__has is null"), rest, loose)
    parts = [out.where("__by_id is not null").withColumn("__note", F.col("__by_id.__note")), whole, wide]
    columns = [*[F.col(c) for c in df.columns], *[F.col(f"__note.{p}").alias(p) for p in payload]]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*columns) for p in parts])


def loose_token_match(a: Column, b: Column) -> Column:
    """rs names agree exactly; other names when one contains the other (not transitive: use inside one article)."""
    x, y = (F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", "")) for c in (a, b))
    rs = x.rlike(r"^rs\d+$") | y.rlike(r"^rs\d+$")
    return (x != "") & (y != "") & F.when(rs, x == y).otherwise(F.contains(x, y) | F.contains(y, x))


def stable_distinct_ci(values: Column) -> Column:
    """Distinct ignoring case, first spelling and order kept."""
    low = F.transform(values, lambda v: F.lower(v))
    return F.filter(values, lambda v, i: F.array_position(low, F.lower(v)) == i + 1)


def dedup_alleles(df: DataFrame, allele: list[str], rank: list[Column], order: str, note_key: str, note_limit: int = 500) -> DataFrame:
    """Best row per complete allele at the first place of its group; incomplete rows pass (AGG-09).

    Adds place, group_size and dropped_keys: the ``note_key`` values of dropped rows, in order, cut at ``note_limit``; only as
    many of them as the cut can show are gathered.
    """
    complete = reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "" for c in allele])
    score = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], F.col(order).alias("o"))
    packed = F.struct(*[F.col(c) for c in df.columns])
    whole = df.where(complete)
    best = whole.groupBy(*[F.col(c).alias(f"__{c}") for c in allele]).agg(F.min_by(packed, score).alias("__b"), F.min(order).alias("place"), F.count("*").alias("group_size"))
    # every key takes a character and a separator at least
    shown = whole.select(*allele, F.col(order).alias("o"), F.col(note_key).cast("string").alias("k")).withColumn("__n", F.row_number().over(Window.partitionBy(*allele).orderBy("o"))).where(f"__n <= {note_limit // 2 + 2}")
    listed = shown.groupBy(*[F.col(c).alias(f"__{c}") for c in allele]).agg(F.sort_array(F.collect_list(F.struct("o", "k"))).alias("__all"))
    dropped = F.filter("__all", lambda x: x["o"] != F.col("__b")[order])
    kept = best.join(listed, [f"__{c}" for c in allele]).select("__b.*", "place", "group_size", F.substring(F.array_join(F.transform(dropped, lambda x: x["k"]), ";"), 1, note_limit).alias("dropped_keys"))
    rest = df.where(~complete).withColumn("place", F.col(order)).withColumn("group_size", F.lit(1).cast("long")).withColumn("dropped_keys", F.lit(""))
    return kept.unionByName(rest)


def unique_argmax(df: DataFrame, keys: list[str], criteria: list[Column], value: str, least: list[float | None] | None = None) -> DataFrame:
    """Per key the value of the greatest first criterion when that is unique and not below ``least``, else by the next, else null (AGG-16)."""
    n = range(len(criteria))
    each = df.groupBy(*keys, F.col(value).alias("__v")).agg(*[F.max(c).alias(f"__c{i}") for i, c in enumerate(criteria)])
    whole = Window.partitionBy(*keys)
    each = each.withColumns({f"__m{i}": F.max(f"__c{i}").over(whole) for i in n})
    at = lambda i: F.when(F.col(f"__c{i}") == F.col(f"__m{i}"), F.col("__v"))
    found = each.groupBy(*keys).agg(*[f(at(i)).alias(f"__{name}{i}") for i in n for name, f in (("lo", F.min), ("hi", F.max))], *[F.max(f"__m{i}").alias(f"__m{i}") for i in n])
    enough = lambda i: F.lit(True) if not least or least[i] is None else F.col(f"__m{i}") >= least[i]
    return found.select(*keys, F.coalesce(*[F.when((F.col(f"__lo{i}") == F.col(f"__hi{i}")) & enough(i), F.col(f"__lo{i}")) for i in n]).alias(value))


def carry_forward(df: DataFrame, keys: list[str], order: str, column: str, out: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(column, ignorenulls=True).over(w))


def neighbours(df: DataFrame, keys: list[str], order: str, text: str, radius: int, out: str) -> DataFrame:
    """Text of the row and ``radius`` rows on either side, joined by a space."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-radius, radius)
    return df.withColumn(out, F.array_join(F.collect_list(text).over(w), " "))


def first_in_group(df: DataFrame, key: str, date: str) -> DataFrame:
    """Adds first_date and is_first: least date of the key, by string order."""
    w = Window.partitionBy(key)
    return df.withColumn("first_date", F.min(date).over(w)).withColumn("is_first", F.col(date) == F.col("first_date"))


def audit_ids(df: DataFrame, parts: list[str], order: str) -> DataFrame:
    """{class}_{id}_{i:04d}: i is the place of the row among all rows of the run (WIN-05)."""
    place = F.col("__i").cast("string")
    label = F.when(F.length(place) < 4, F.lpad(place, 4, "0")).otherwise(place)
    return numbered(df, [order], "__i").withColumn("audit_id", F.concat_ws("_", *[F.col(p).cast("string") for p in parts], label)).drop("__i")


def compare_with_gold(candidates: DataFrame, gold: DataFrame, keys: list[str], allele: list[str], order: str) -> DataFrame:
    """Gold rows with the last candidate of their key; exact where all allele columns agree."""
    c = last_wins(candidates, keys, order).select(*keys, F.struct(*allele).alias("__c"))
    out = gold.join(c, keys, "left")
    return out.withColumn("exact", reduce(lambda a, b: a & b, [F.col(x).cast("string").eqNullSafe(F.col(f"__c.{x}").cast("string")) for x in allele]) & F.col("__c").isNotNull()).drop("__c")


def gold_report(candidates: DataFrame, gold: DataFrame, keys: list[str], allele: list[str], order: str) -> DataFrame:
    """One row: gold rows, those with a whole allele, candidate rows, exact matches and their rate to four places (JN-12)."""
    whole = reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "" for c in allele])
    compared = compare_with_gold(candidates, gold.where(whole), keys, allele, order).agg(F.count("*").alias("gold_with_4col"), F.coalesce(F.sum(F.col("exact").cast("long")), F.lit(0)).alias("genomic_exact_match"))
    counts = gold.agg(F.count("*").alias("gold_rows")).crossJoin(candidates.agg(F.count("*").alias("candidate_rows")))
    return counts.crossJoin(compared).withColumn("genomic_match_rate", F.when(F.col("gold_with_4col") > 0, F.round(F.col("genomic_exact_match") / F.col("gold_with_4col"), 4)))


def dedup_links(links: DataFrame, order: str, variant: str = "variant", evidence: str = "evidence_sentence", prefix: int = 240) -> DataFrame:
    """First link per variant and the first ``prefix`` characters of its evidence (AGG-10)."""
    return first_per_key(links, [*[F.col(c) for c in ("pmid",) if c in links.columns], F.col(variant), F.substring(F.coalesce(F.col(evidence), F.lit("")), 1, prefix)], order)


def merged_pairs(abstract: DataFrame, full_text: DataFrame, order: str) -> DataFrame:
    """Abstract pairs, first per (pmid, variant, clinical), and all full-text pairs, each with its source (AGG-11, SET-01)."""
    once = first_per_key(abstract, [F.col("pmid"), F.col("variant"), F.col("clinical")], order)
    marked = lambda df, source: df.withColumn("evidence_source", F.coalesce(F.col("evidence_source"), F.lit(source)) if "evidence_source" in df.columns else F.lit(source))
    return marked(once, "abstract").unionByName(marked(full_text, "fulltext"), allowMissingColumns=True)


def histogram(df: DataFrame, key: str, value: str, out: str, empty: str = "NA") -> DataFrame:
    """key -> map of value to count (AGG-19)."""
    counted = df.groupBy(key, F.coalesce(F.nullif(F.col(value), F.lit("")), F.lit(empty)).alias("v")).agg(F.count("*").alias("n"))
    return counted.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("v", "n")))).alias(out))


def passage_with(passages: Column, sentence: Column) -> Column:
    """The first passage that contains a sentence; null without one (JN-15)."""
    return F.when(F.coalesce(sentence, F.lit("")) != "", F.get(F.filter(passages, lambda p: F.contains(p, sentence)), 0))


def only_in(found: Column, known: Column) -> Column:
    """Distinct values that are new (SET-03, SET-06), in order of appearance."""
    return F.array_except(F.coalesce(found, F.array().cast("array<string>")), F.coalesce(known, F.array().cast("array<string>")))


def overlap_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys of either table alone and of both (SET-04)."""
    both = a.select(key).distinct().withColumn("__a", F.lit(1)).join(b.select(key).distinct().withColumn("__b", F.lit(1)), key, "full")
    has = lambda c: F.col(c).isNotNull()
    count = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)
    return both.agg(count(has("__a") & ~has("__b"), "only_first"), count(~has("__a") & has("__b"), "only_second"), count(has("__a") & has("__b"), "both"))


def sidecar(df: DataFrame, notes: DataFrame, value: str, default: str, out: str) -> DataFrame:
    """The last value noted for (pmid, lower variant), else a default (JN-13)."""
    known = notes.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(F.col("pmid").alias("__p"), F.lower("variant").alias("__v")).agg(F.max_by(value, "ord").alias("__x"))
    return df.join(known, (F.col("pmid") == F.col("__p")) & (F.lower("variant") == F.col("__v")), "left").withColumn(out, F.coalesce("__x", F.lit(default))).drop("__p", "__v", "__x")


def nearest(df: DataFrame, keys: list[str], lo: str, hi: str, start: Column, end: Column, within: int, order: str) -> DataFrame:
    """Per key the row whose span lies nearest to start..end, at most ``within`` away; the first among equals (WIN-06)."""
    apart = F.when(F.col(hi) < start, start - F.col(hi)).when(F.col(lo) > end, F.col(lo) - end).otherwise(0)
    return best_per_key(df.withColumn("distance", apart).where(F.col("distance") <= within), keys, [F.col("distance")], order)
