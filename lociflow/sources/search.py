"""Boolean literature queries compiled to filters over an article table (the offline form of a PubMed search).

Grammar: terms and phrases with an optional [Field], AND, OR, NOT (left to right, as PubMed reads them), parentheses, and
date ranges ``"2026/01/01"[Date - Publication] : "3000"[Date - Publication]``.  A term matches whole words, case aside; a
trailing ``*`` matches any ending.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r'\s*(?:(\()|(\))|(:)|(AND|OR|NOT)(?=[\s(])|(?:"([^"]*)"|([^\s()\[\]":]+))\s*(?:\[([^\]]*)\])?)')


def parse(query: str) -> list[tuple[str, str, str]]:
    """(kind, value, field) tokens."""
    out, at = [], 0
    query = query.strip()
    while at < len(query):
        m = _TOKEN.match(query, at)
        if m is None or m.end() == at:
            raise ValueError(f"cannot read the query at {query[at : at + 30]!r}")
        at = m.end()
        for kind, group in (("(", 1), (")", 2), (":", 3), ("op", 4)):
            if m[group]:
                out.append((kind, m[group], ""))
                break
        else:
            out.append(("term", m[5] if m[5] is not None else m[6], (m[7] or "All Fields").strip().lower()))
    return out


def _word(term: str) -> str:
    words = [re.escape(w.rstrip("*")) + (r"\w*" if w.endswith("*") else "") for w in re.split(r"[\s-]+", term.strip())]
    return r"(?i)(?<!\w)" + r"[\s-]+".join(words) + r"(?!\w)"


def compile_query(query: str, fields: dict[str, Column], default: Column) -> Column:
    """A filter for a query; ``fields`` maps lower-case field names to text columns (dates as YYYY/MM/DD), others use ``default``."""
    tokens = parse(query)
    at = 0

    def value() -> Column:
        nonlocal at
        kind, text, field = tokens[at]
        at += 1
        if kind == "(":
            inner = expression()
            if at >= len(tokens) or tokens[at][0] != ")":
                raise ValueError("a parenthesis is not closed")
            at += 1
            return inner
        if kind != "term":
            raise ValueError(f"unexpected {text!r}")
        column = F.coalesce(fields.get(field, default), F.lit(""))
        if at < len(tokens) and tokens[at][0] == ":":
            high = tokens[at + 1][1]
            at += 2
            return (column >= text) & (F.substring(column, 1, len(high)) <= high)
        return column.rlike(_word(text))

    def expression() -> Column:
        nonlocal at
        out = value()
        while at < len(tokens) and tokens[at][0] == "op":
            op = tokens[at][1]
            at += 1
            right = value()
            out = out & right if op == "AND" else out | right if op == "OR" else out & ~right
        return out

    out = expression()
    if at != len(tokens):
        raise ValueError("the query goes on after its end")
    return out


def with_query_hits(articles: DataFrame, queries: dict[str, str], fields: dict[str, Column], default: Column) -> DataFrame:
    """source_query_ids (queries that match) and missed_query_ids (the others, sorted), and only articles that some query finds."""
    hits = F.array_compact(F.array(*[F.when(compile_query(q, fields, default), F.lit(name)) for name, q in sorted(queries.items())]))
    out = articles.withColumn("source_query_ids", hits).where(F.size("source_query_ids") > 0)
    return out.withColumn("missed_query_ids", F.array_except(F.array(*[F.lit(n) for n in sorted(queries)]), F.col("source_query_ids")))
