"""Mixing sources to target weights by hierarchical budgets (operator 5).

A token budget is propagated through a tree domain -> language -> source.  Each node takes
its weighted part of its parent's budget, at most what the leaves below it can supply in
``max_epochs`` passes; what a node cannot use goes to its siblings in proportion to their
weights, and reaches the parent's siblings only when the whole subtree is exhausted (water
filling with whole numbers: level = (budget - full children) / (weights of the others)).

Every leaf then reads whole seeded epochs and a token-prefix of the next one: documents in
the order of md5(seed:epoch:doc_id:md5(text)), as many as fit in what is left.  Prefix sums run
in two levels, 4,096 buckets of that order per leaf and then the rows of the one bucket that
the budget ends in, so a leaf with a third of all rows is spread over many tasks.

Texts are read once, for a table of one narrow row per document (names, hash, tokens); all
budgets, orders and prefixes are taken on it.  ``mix_sources`` then adds the texts: what lies in
whole epochs or before the last bucket passes by the leaf's plan alone, and only the few rows of
a last bucket meet the table of what is selected there.

Tokens are words (runs of other than white space).  The tree has one row per (domain,
language, source); it is joined, and broadcast by Spark only where it measures it as small.

Edge cases: null language or source count as the empty name; a null or wordless text has no
tokens, costs nothing and is kept with its place in the order; repeated rows share a place
and are interchangeable; an empty table gives no rows; clashing extra columns are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.llm.common import SPACE_CLASS, discard, materialize

#: Production parameters: weights per domain and language (others get 1), budget and epochs.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "fr": 2, "de": 2, "es": 2}
BUDGET_PERCENT, MAX_EPOCHS, SEED = 60, 2, 17
_ADDED = ("domain", "epoch", "n_tokens", "leaf_budget", "place")


def domain_of(source: str = "source") -> Column:
    """The catalogue of domains: four groups of sources by the number in their name."""
    return F.concat(F.lit("d"), F.coalesce(F.expr(f"try_cast(nullif(regexp_extract({source}, '([0-9]+)$', 1), '') as bigint)"), F.lit(0)) % 4)


def word_count(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_CLASS))).cast("long")


def _weights(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, w in sorted(weights.items()):
        out = F.when(F.col(column) == name, w).otherwise(out)
    return out.cast("long")


def _fill(nodes: DataFrame, parent: list[str], by: str) -> DataFrame:
    """Budgets of sibling nodes: ``cap`` and ``w`` of each, ``parent_budget`` over them."""
    order = Window.partitionBy(*parent).orderBy((F.col("cap") / F.col("w")), by)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    out = (
        nodes.withColumn("full_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("fits", F.col("cap") * F.col("w_left") >= (F.col("parent_budget") - F.col("full_before")) * F.col("w"))
        .withColumn("level_full", F.min(F.when(F.col("fits"), F.col("full_before"))).over(whole))
        .withColumn("level_w", F.max(F.when(F.col("fits"), F.col("w_left"))).over(whole))
    )
    share = F.expr("((parent_budget - level_full) * w) div level_w")
    return out.withColumn("budget", F.when(F.col("level_w").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), share))).drop("full_before", "w_left", "fits", "level_full", "level_w", "parent_budget", "w")


def leaf_budgets(leaves: DataFrame, budget_percent: int, max_epochs: int, domain_weights: dict[str, int], lang_weights: dict[str, int]) -> DataFrame:
    """``leaves`` (domain, lang, source, avail) with the budget of each leaf."""
    leaves = leaves.withColumn("cap", F.col("avail") * max_epochs)
    total = leaves.agg(F.expr(f"coalesce(sum(avail), 0) * {budget_percent} div 100").alias("parent_budget"))
    domains = leaves.groupBy("domain").agg(F.sum("cap").alias("cap")).crossJoin(F.broadcast(total)).withColumn("w", _weights("domain", domain_weights)).withColumn("root", F.lit(0))
    domains = _fill(domains, ["root"], "domain").select("domain", F.col("budget").alias("parent_budget"))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(domains, "domain").withColumn("w", _weights("lang", lang_weights))
    langs = _fill(langs, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("parent_budget"))
    sources = leaves.join(langs, ["domain", "lang"]).withColumn("w", F.lit(1).cast("long"))
    return _fill(sources, ["domain", "lang"], "source").drop("cap")


@dataclass
class Plan:
    """The narrow rows, one row per leaf (whole epochs, where the next one ends), and the rows selected in last buckets."""

    rows: DataFrame
    leaves: DataFrame
    ends: DataFrame


LEAF = ["domain", "__l", "__s"]


def _leaf_columns(docs: DataFrame) -> DataFrame:
    return (
        docs.withColumn("__l", F.coalesce(F.col("lang").cast("string"), F.lit("")))
        .withColumn("__s", F.coalesce(F.col("source").cast("string"), F.lit("")))
        .withColumn("domain", domain_of("source"))
    )


def _identity(text: str) -> Column:
    """What is hashed for a row's places: its id and the hash of its text."""
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _place(epoch: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.col("__id")).cast("binary"))


def plan_mix(docs: DataFrame, budget_percent: int, max_epochs: int, seed: int, domain_weights: dict[str, int], lang_weights: dict[str, int], text: str) -> Plan:
    rows = _leaf_columns(docs).select("doc_id", "lang", "source", *LEAF, _identity(text).alias("__id"), word_count(F.col(text)).alias("n_tokens"))
    rows = materialize(rows, "rows")
    leaves = rows.groupBy("domain", F.col("__l").alias("lang"), F.col("__s").alias("source")).agg(F.sum("n_tokens").alias("avail"))
    budgets = leaf_budgets(leaves, budget_percent, max_epochs, domain_weights, lang_weights).where("avail > 0 or budget > 0")
    budgets = budgets.select(
        F.col("domain"), F.col("lang").alias("__l"), F.col("source").alias("__s"), F.col("budget").alias("leaf_budget"),
        F.expr("case when avail > 0 then budget div avail else 0 end").alias("whole"),
        F.expr("case when avail > 0 then budget % avail else 0 end").alias("rest"),
    )
    # one row per leaf: written, so that its size is known and Spark broadcasts it only where it is small
    budgets = materialize(budgets, "budgets")
    # tokens per leaf and bucket of the epoch that the budget ends in
    following = rows.join(budgets, LEAF).withColumn("bucket", F.substring(_place(F.col("whole"), seed), 1, 3))
    sums = following.groupBy(*LEAF, "bucket").agg(F.sum("n_tokens").alias("t"), F.max("rest").alias("rest"))
    running = F.sum("t").over(Window.partitionBy(*LEAF).orderBy("bucket"))
    ends = sums.withColumn("through", running).where("through > rest").groupBy(*LEAF).agg(F.min("bucket").alias("end_bucket"), F.min(F.col("through") - F.col("t")).alias("before"))
    plan = materialize(budgets.join(ends, LEAF, "left"), "plan")
    discard(budgets)
    last = rows.join(plan.where(f"whole < {max_epochs}"), LEAF).withColumn("place", _place(F.col("whole"), seed)).where(F.substring("place", 1, 3) == F.col("end_bucket"))
    prefix = Window.partitionBy(*LEAF).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    chosen = last.withColumn("__run", F.sum("n_tokens").over(prefix)).where("before + __run <= rest")
    return Plan(rows, plan, materialize(chosen.select("doc_id", "lang", "source", *LEAF, "__id", F.col("whole").alias("epoch"), "n_tokens", "leaf_budget"), "ends"))


def _whole_epochs(rows: DataFrame, plan: DataFrame, max_epochs: int, seed: int) -> DataFrame:
    """Rows in whole epochs, and those before the last bucket of the next one, with their epoch."""
    epochs = F.sequence(F.lit(0).cast("long"), F.least(F.col("whole"), F.lit(max_epochs - 1).cast("long")))
    passes = rows.join(plan, LEAF).withColumn("epoch", F.explode(epochs))
    return passes.where((F.col("epoch") < F.col("whole")) | F.col("end_bucket").isNull() | (F.substring(_place(F.col("epoch"), seed), 1, 3) < F.col("end_bucket")))


def mix_selection(
    docs: DataFrame,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    domain_weights: dict[str, int] = DOMAIN_WEIGHTS,
    lang_weights: dict[str, int] = LANG_WEIGHTS,
    text: str = "text",
) -> DataFrame:
    """One row for each selected document and epoch, without texts: doc_id, domain, lang, source, epoch, n_tokens, leaf_budget."""
    plan = plan_mix(docs, budget_percent, max_epochs, seed, domain_weights, lang_weights, text)
    out = ["doc_id", "domain", "lang", "source", "epoch", "n_tokens", "leaf_budget"]
    return _whole_epochs(plan.rows, plan.leaves, max_epochs, seed).select(*out).unionByName(plan.ends.select(*out))


def mix_sources(
    docs: DataFrame,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    domain_weights: dict[str, int] = DOMAIN_WEIGHTS,
    lang_weights: dict[str, int] = LANG_WEIGHTS,
    text: str = "text",
) -> DataFrame:
    """One row for each selected document and epoch: ``docs``'s columns, domain, epoch, n_tokens, leaf_budget."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in _ADDED])
    plan = plan_mix(docs, budget_percent, max_epochs, seed, domain_weights, lang_weights, text)
    out = [*docs.columns, "domain", "epoch", "n_tokens", "leaf_budget"]
    rows = _leaf_columns(docs).withColumn("__id", _identity(text))
    below = _whole_epochs(rows, plan.leaves, max_epochs, seed).withColumn("n_tokens", word_count(F.col(text)))
    # a row that repeats in a last bucket is selected as often as its narrow rows are
    taken = plan.ends.groupBy("__id", *LEAF).agg(F.count("*").alias("times"), F.min("epoch").alias("epoch"), F.min("n_tokens").alias("n_tokens"))
    last = rows.join(plan.leaves.where(f"whole < {max_epochs}"), LEAF).where(F.substring(_place(F.col("whole"), seed), 1, 3) == F.col("end_bucket"))
    copy = F.row_number().over(Window.partitionBy("__id", *LEAF).orderBy(F.lit(0)))
    at_end = last.join(taken, ["__id", *LEAF]).withColumn("__copy", copy).where("__copy <= times")
    return below.select(*out).unionByName(at_end.select(*out))


def mixing_sql(budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """doc_id, domain, lang, source, epoch, n_tokens, leaf_budget for DuckDB."""
    case = lambda column, weights: "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"

    def fill(name: str, source: str, parent: str, by: str) -> str:
        return f"""
{name}_a AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY cap / w, {by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
  sum(w) OVER (PARTITION BY {parent}) - coalesce(sum(w) OVER (PARTITION BY {parent} ORDER BY cap / w, {by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left FROM {source}),
{name}_b AS (SELECT *, min(CASE WHEN cap * w_left >= (pb - full_before) * w THEN full_before END) OVER (PARTITION BY {parent}) AS lf,
  max(CASE WHEN cap * w_left >= (pb - full_before) * w THEN w_left END) OVER (PARTITION BY {parent}) AS lw FROM {name}_a),
{name} AS (SELECT *, CASE WHEN lw IS NULL THEN cap ELSE least(cap, (pb - lf) * w // lw) END AS budget FROM {name}_b)"""

    return f"""
WITH rows0 AS (SELECT doc_id, lang, source, coalesce(lang, '') AS l, coalesce(source, '') AS s, text,
  'd' || (coalesce(TRY_CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT), 0) % 4) AS domain,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT domain, l, s, sum(n_tokens) AS avail, sum(n_tokens) * {max_epochs} AS cap FROM rows0 GROUP BY ALL),
d0 AS (SELECT domain, 0 AS root, sum(cap) AS cap, {case("domain", DOMAIN_WEIGHTS)} AS w, (SELECT sum(avail) * {budget_percent} // 100 FROM leaves) AS pb FROM leaves GROUP BY domain),
{fill("d1", "d0", "root", "domain")},
l0 AS (SELECT leaves.domain, l, sum(leaves.cap) AS cap, {case("l", LANG_WEIGHTS)} AS w, any_value(d1.budget) AS pb FROM leaves JOIN d1 ON leaves.domain = d1.domain GROUP BY leaves.domain, l),
{fill("l1", "l0", "domain", "l")},
s0 AS (SELECT leaves.*, 1 AS w, l1.budget AS pb FROM leaves JOIN l1 ON leaves.domain = l1.domain AND leaves.l = l1.l),
{fill("s1", "s0", "domain, l", "s")},
plan AS (SELECT domain, l, s, budget, CASE WHEN avail > 0 THEN budget // avail ELSE 0 END AS whole, CASE WHEN avail > 0 THEN budget % avail ELSE 0 END AS rest FROM s1 WHERE avail > 0 OR budget > 0),
sel AS (SELECT r.*, p.budget, p.whole, p.rest, unnest(range(0, CAST(least(p.whole + 1, {max_epochs}) AS BIGINT))) AS epoch FROM rows0 r JOIN plan p ON r.domain = p.domain AND r.l = p.l AND r.s = p.s),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, l, s, epoch ORDER BY md5('{seed}:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) ROWS UNBOUNDED PRECEDING) AS through FROM sel)
SELECT doc_id, domain, lang, source, CAST(epoch AS BIGINT) AS epoch, n_tokens, CAST(budget AS BIGINT) AS leaf_budget FROM run WHERE epoch < whole OR through <= rest"""
