"""Gates: named conditions with a state, compiled to Columns.

States: ``required`` and ``enabled`` filter, ``audit_only`` only annotates, ``disabled`` is
left out.  The audit profile annotates every condition and drops nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lociflow.functions import patterns as P
from lociflow.functions.text import blank, is_generic_clinical

STATES = ("required", "enabled", "disabled", "audit_only")
PROFILES = ("audit", "strict", "custom", "resume")


@dataclass(frozen=True)
class Gate:
    name: str
    condition: Column
    state: str = "required"

    def __post_init__(self):
        if self.state not in STATES:
            raise ValueError(f"unknown gate state {self.state!r}")


def with_profile(gates: list[Gate], profile: str = "strict", declared: dict[str, str] | None = None) -> list[Gate]:
    """The gates as a profile has them.

    audit annotates all that is not disabled; strict takes them as they are; custom, and resume which runs on its results, take
    the state that ``declared`` has for a gate.
    """
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    unknown = {*(declared or {})} - {g.name for g in gates}
    if unknown:
        raise ValueError(f"no such gates: {', '.join(sorted(unknown))}")
    if profile in ("custom", "resume"):
        return [replace(g, state=(declared or {}).get(g.name, g.state)) for g in gates]
    return [replace(g, state="audit_only") if profile == "audit" and g.state != "disabled" else g for g in gates]


def apply_gates(df: DataFrame, gates: list[Gate], profile: str = "strict", declared: dict[str, str] | None = None, counts: Observation | None = None) -> DataFrame:
    """gate_<name> columns, gate_failed (names) and, but for gates that only annotate, only rows that pass.

    ``counts`` observes, in the pass that any action makes anyway, the rows that came in, that passed each gate, and that
    stay; ``gate_counts`` reads it afterwards.
    """
    used = [g for g in with_profile(gates, profile, declared) if g.state != "disabled"]
    passed = {g.name: F.coalesce(g.condition, F.lit(False)) for g in used}
    out = df.withColumns({f"gate_{n}": c for n, c in passed.items()})
    failed = F.array_compact(F.array(*[F.when(~F.col(f"gate_{g.name}"), F.lit(g.name)) for g in used])) if used else F.array().cast("array<string>")
    out = out.withColumn("gate_failed", failed)
    filters = [F.col(f"gate_{g.name}") for g in used if g.state in ("required", "enabled")]
    stays = reduce(lambda a, b: a & b, filters, F.lit(True))
    if counts is not None:
        total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
        out = out.observe(counts, F.count("*").alias("rows"), total(stays).alias("kept"), *[total(F.col(f"gate_{g.name}")).alias(f"gate_{g.name}") for g in used])
    return out.where(stays) if filters else out


def gate_counts(counts: Observation, gates: list[Gate], profile: str = "strict", declared: dict[str, str] | None = None) -> list[tuple[str, str, int, int]]:
    """(gate, state, passed, failed) after an action on what ``apply_gates`` returned; the last row, "all", has what stays and what goes."""
    seen = counts.get
    rows = [(g.name, g.state, seen[f"gate_{g.name}"]) for g in with_profile(gates, profile, declared) if g.state != "disabled"]
    return [(name, state, n, seen["rows"] - n) for name, state, n in [*rows, ("all", profile, seen["kept"])]]


def settings_of(gates: list[Gate], profile: str = "strict", declared: dict[str, str] | None = None) -> list[list[str]]:
    """Names, states and conditions as plain values, for fingerprints."""
    return [[g.name, g.state, str(g.condition)] for g in with_profile(gates, profile, declared)]


def review_gates(tiers: tuple[str, ...] = ("A",)) -> list[Gate]:
    """Quality gates of the review corpus: strict takes tier A, extended A and B."""
    return [
        Gate("gene", ~blank(F.col("gene"))),
        Gate("confidence", F.col("discovery_confidence") == "high"),
        Gate("method", F.col("method").isin(*P.METHOD_RANK)),
        Gate("clinical_source", F.col("clinical_source").isin(*P.ENTITY_SOURCES)),
        Gate("clinical_text", ~is_generic_clinical(F.col("clinical"))),
        Gate("gene_source", F.col("gene_source").isin(*P.GENE_SOURCES)),
        Gate("tier", F.col("tier").isin(*tiers)),
    ]


def review_score() -> list[Column]:
    """Least is best: tier, method, full text, sentence, own gene (card 9.2)."""
    rank = lambda c, table: F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col(c)], F.lit(9))
    return [
        rank("tier", P.TIER_RANK),
        rank("method", P.METHOD_RANK),
        F.when(F.col("evidence_source") == "fulltext", 0).otherwise(1),
        F.when(blank(F.col("evidence_sentence")), 1).otherwise(0),
        F.when(F.col("gene_source") == "row_gene", 0).otherwise(1),
    ]
