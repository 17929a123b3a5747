"""Sinks: records, fixed-column tables, routes and reports."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.functions import patterns as P
from lociflow.operators.ranks import numbered

EXPORT_FIELDS = [*P.EXPORT_PRIMARY, *P.EXPORT_REST]


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def with_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns as strings: missing ones and nulls are empty, booleans 'true' and 'false', extras go."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.coalesce(F.col(have[c.lower()]).cast("string"), F.lit("")).alias(c) if c.lower() in have else F.lit("").alias(c) for c in columns])


def write_table(df: DataFrame, path: str, columns: list[str], sep: str = ",", bom: bool = False) -> None:
    """Fixed columns with a header; ``bom`` puts a byte-order mark before it, as spreadsheets ask for."""
    out = with_columns(df, columns)
    out = out.toDF(*(["\ufeff" + columns[0], *columns[1:]] if bom else columns))
    out.write.mode("overwrite").csv(path, header=True, sep=sep, emptyValue="")


def write_routes(df: DataFrame, path: str, *route: str) -> None:
    """One pass over the rows, one folder per route value."""
    df.write.mode("overwrite").partitionBy(*route).json(path)


def report_table(stages: dict[str, DataFrame], by: dict[str, list[str]]) -> DataFrame:
    """(stage, column, value, n): row counts (column null) and all category counts of every stage, as a table of any length."""
    parts = []
    for name, df in stages.items():
        row = lambda c, v, n: (F.lit(name).alias("stage"), F.lit(c).cast("string").alias("column"), v.cast("string").alias("value"), n.alias("n"))  # noqa: B023, E731
        parts.append(df.agg(F.count("*").alias("n")).select(*row(None, F.lit(None), F.col("n"))))
        parts += [df.groupBy(c).agg(F.count("*").alias("n")).select(*row(c, F.col(c), F.col("n"))) for c in by.get(name, [])]
    return reduce(lambda a, b: a.unionByName(b), parts)


def stage_report(stages: dict[str, DataFrame], by: dict[str, list[str]]) -> str:
    """``report_table`` as JSON, for categories of a size that a report can show."""
    out: dict = {}
    for r in report_table(stages, by).orderBy("stage", "column", F.desc("n"), "value").toLocalIterator():
        entry = out.setdefault(r.stage, {})
        if r.column is None:
            entry["rows"] = r.n
        else:
            entry.setdefault(r.column, {})[str(r.value)] = r.n
    return json.dumps(out, sort_keys=True)


ENUMERATIONS = ("sample_class", "resolve_status", "resolve_method", "genomic_region", "screen_grade", "link_tier")


def export_contract(df: DataFrame) -> str:
    """JSON beside an export: column order, values of its enumerations, counts (SNK-05).

    All counts come from one pass over the rows: one grouping set for each enumeration, one for classes by grade, one for all.
    """
    have = [c for c in ENUMERATIONS if c in df.columns]
    sets = [[c] for c in have] + ([["sample_class", "screen_grade"]] if {"sample_class", "screen_grade"} <= {*have} else []) + [[]]
    named = df.select(*have) if have else df.select(F.lit(1).alias("__one"))
    grouped = named.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in have]) if have else named.groupBy()
    marks = [F.grouping(c).alias(f"__{c}") for c in have]
    counted: dict[str, dict[str, int]] = {c: {} for c in have}
    grades: dict[str, dict[str, int]] = {}
    rows = 0
    for r in grouped.agg(F.count("*").alias("n"), *marks).collect():  # a row per value of an enumeration
        by = [c for c in have if not r[f"__{c}"]]
        if len(by) == 1:
            counted[by[0]][str(r[by[0]])] = r.n
        elif by:
            grades.setdefault(str(r.sample_class), {})[str(r.screen_grade)] = r.n
        else:
            rows = r.n
    return json.dumps({"columns": EXPORT_FIELDS, "rows": rows, "enums": {k: sorted(v) for k, v in counted.items()}, "counts": counted, "screen_grade_by_class": grades}, sort_keys=True)


def text_cache(df: DataFrame, body: str, links: str, abstract: str) -> DataFrame:
    """Cached text: the body from 400 characters on, else with links, below 200 with the abstract, null below 120."""
    b, k, a = (F.coalesce(F.col(c), F.lit("")) for c in (body, links, abstract))
    t = F.when(F.length(b) >= 400, b).otherwise(F.trim(F.concat_ws("\n", F.nullif(b, F.lit("")), F.nullif(k, F.lit("")))))
    t = F.when(F.length(t) < 200, F.trim(F.concat_ws("\n", F.nullif(t, F.lit("")), F.nullif(a, F.lit(""))))).otherwise(t)
    return df.withColumn("cached_text", F.when(F.length(t) >= 120, t))


def review_pages(df: DataFrame, title: str, order: str, per_page: int = 2000) -> DataFrame:
    """(page, html): all records in order as pages of bounded size, each with its records as escaped JSON (SNK-06).

    Write it with ``partitionBy("page")`` as text; every page is made in one task.
    """
    safe = title.replace("&", "&amp;").replace("<", "&lt;")
    record = F.replace(F.replace(F.to_json(F.struct(*df.columns)), F.lit("<"), F.lit("\\u003c")), F.lit("&"), F.lit("\\u0026"))
    rows = numbered(df.withColumn("__j", record), [order], "__i").select(F.expr(f"cast((__i - 1) div {per_page} as int)").alias("page"), F.struct(F.col("__i").alias("i"), F.col("__j").alias("j")).alias("x"))
    data = F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["j"]), ",")
    head = F.concat(F.lit(f'<!doctype html><meta charset="utf-8"><title>{safe} '), (F.col("page") + 1).cast("string"), F.lit('</title><script type="application/json" id="records">['))
    return rows.groupBy("page").agg(data.alias("d")).select("page", F.concat(head, F.col("d"), F.lit("]</script>")).alias("html"))


def write_fasta(df: DataFrame, path: str, width: int = 60) -> None:
    """Contigs (chrom, seq) as FASTA files with lines of one length, as many files as partitions."""
    lines = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    df.where("seq <> ''").select(F.concat(F.lit(">"), "chrom", F.lit("\n"), lines).alias("value")).write.text(path)
