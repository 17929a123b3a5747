"""Quality rules as one Spark projection (operator 6, native).

A threshold table of length, symbol, stop-word and line ratios is compiled into Column
expressions; nothing is shuffled and no user function runs.  Ratios are compared as whole
numbers (``per_mille`` of the denominator), so every engine agrees on them.

Repeated 5-word windows are found inside the row: window hashes (64 bits) are sorted with
their positions, neighbours that agree mark a window as repeated, and the lengths of the
union of marked windows are summed, n log n in the number of words.

Edge cases: null and empty texts count zero everywhere and fail the base rules (fewer than
10 words); very long texts are read whole; repeated rows each get their own result; input
columns whose names clash with a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import SPACE_CLASS

#: Stop words of the corpus languages, compared with words as they stand or with one leading capital.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not are or this from at an he",
    "fr": "le la les de des et un une que qui en du dans pour est par sur au pas avec plus",
    "de": "der die das und in den von zu mit ist im des ein eine nicht dem auf für sich",
    "es": "el la los las de que y en un una por con del se no su para es al lo",
}
MIN_WORDS, WINDOW, REPEAT_PERCENT = 10, 5, 20


@dataclass(frozen=True)
class Rule:
    """Keep when ``least`` <= 1000 * value / of <= ``most`` (per mille); ``of`` None compares the value itself."""

    name: str
    value: str
    of: str | None
    least: int | None = None
    most: int | None = None

    def passes(self) -> Column:
        scaled = F.col(self.value) if self.of is None else F.col(self.value) * 1000
        unit = F.lit(1) if self.of is None else F.col(self.of)
        out = F.lit(True)
        if self.least is not None:
            out = out & (scaled >= unit * self.least)
        if self.most is not None:
            out = out & (scaled <= unit * self.most)
        return out

    def sql(self) -> str:
        scaled, unit = (self.value, "1") if self.of is None else (f"{self.value} * 1000", self.of)
        parts = [f"{scaled} >= {unit} * {self.least}"] * (self.least is not None) + [f"{scaled} <= {unit} * {self.most}"] * (self.most is not None)
        return "(" + " AND ".join(parts or ["true"]) + ")"


#: The production thresholds.
RULES = (
    Rule("enough words", "n_words", None, least=MIN_WORDS),
    Rule("mean word length", "word_chars", "n_words", least=2000, most=15000),
    Rule("symbols to words", "n_symbols", "n_words", most=100),
    Rule("stop words to words", "n_stop_words", "n_words", least=20),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=500),
)


def stop_word_list() -> list[str]:
    words = sorted({w for line in STOP_WORDS.values() for w in line.split()})
    return sorted({*words, *(w.capitalize() for w in words)})


def _without(value: Column, chars: str) -> Column:
    for c in chars:
        value = F.replace(value, F.lit(c), F.lit(""))
    return value


def with_quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the counts, base_failed and kept."""
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "base_failed", "kept")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in measures])
    value = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(value, F.lit(" \t\n\x0b\f\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def repeated(w: Column) -> Column:
        """Words in windows that occur twice; rows without such a window skip the sort."""

        def union_size(starts: Column) -> Column:
            steps = F.transform(starts, lambda p, k: F.least(F.coalesce(F.get(starts, k + 1), p + WINDOW) - p, F.lit(WINDOW)))
            return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

        def marked(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            keep = F.transform(s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
            return F.sort_array(F.filter(keep, lambda p: p.isNotNull()))

        def covered(h: Column) -> Column:
            by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
            found = F.element_at(F.transform(F.transform(F.array(by_hash), marked), union_size), 1)
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(found)

        # one-element arrays bind an inner result to a lambda variable, so that it is computed once
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return F.when(F.size(w) >= WINDOW, F.element_at(F.transform(F.array(hashes), covered), 1)).otherwise(F.lit(0))

    counts = F.element_at(
        F.transform(
            F.array(words),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                repeated(w).cast("long").alias("n_repeat_words"),
                F.size(F.filter(w, lambda x: x.isin(*stop_word_list()))).cast("long").alias("n_stop_words"),
            ),
        ),
        1,
    )
    line_counts = F.element_at(F.transform(F.array(lines), lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d"))), 1)
    out = (
        docs.withColumn("__c", counts)
        .withColumn("__l", line_counts)
        .select(
            *docs.columns,
            F.col("__c.n_words").alias("n_words"),
            F.length(_without(value, " \t\n\x0b\f\r")).cast("long").alias("word_chars"),
            (F.length(value) - F.length(_without(value, "#*$%&|<>"))).cast("long").alias("n_symbols"),
            (F.col("__l.n") - F.col("__l.d")).alias("n_dup_lines"),
            F.col("__c.n_repeat_words").alias("n_repeat_words"),
            F.col("__c.n_stop_words").alias("n_stop_words"),
            F.col("__l.n").alias("n_lines"),
        )
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & rule.passes()
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict)


def quality_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same for DuckDB over ``documents``."""
    stops = ", ".join(f"'{w}'" for w in stop_word_list())
    return f"""
WITH base AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
grams AS (
  SELECT rid, unnest(range(1, len(w) - {WINDOW - 2})) AS i, w FROM base WHERE len(w) >= {WINDOW}),
marked AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, list_aggregate(w[i:i+{WINDOW - 1}], 'string_agg', ' ')) AS c FROM grams),
starts AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM marked WHERE c >= 2),
rep AS (
  SELECT rid, sum(least(coalesce(nxt, i + {WINDOW}) - i, {WINDOW})) AS n FROM starts GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: x IN ({stops}))) AS BIGINT) AS n_stop_words,
         CAST(len(l) AS BIGINT) AS n_lines
  FROM base LEFT JOIN rep USING (rid)),
f AS (SELECT *, (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {REPEAT_PERCENT}) AS base_failed FROM m)
SELECT *, NOT base_failed AND {" AND ".join(r.sql() for r in rules)} AS kept FROM f"""
