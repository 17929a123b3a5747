"""Column functions over text: sentences, variants, cues, labels, windows, keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lociflow.functions import patterns as P
from lociflow.operators.relational import settled

SENTENCE_SPLIT = r"(?<=[.!?])\s+(?=[A-Z0-9\"'(\[])"
LOCAL_RADIUS = 180
#: Runs of white space as Python's ``\s`` has it (Java's ``\s`` is ASCII only); the same in RE2.
WHITE = r"[\s\x0B\x1C-\x1F\x{85}\pZ]+"


def blank(c: Column) -> Column:
    """Null, empty and all-space strings alike."""
    return F.coalesce(F.trim(c), F.lit("")) == ""


def sentences(text: Column, pattern: str = SENTENCE_SPLIT) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), pattern), lambda s: F.trim(s)), lambda s: s != "")


def all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({pattern})"), F.lit(1))


def is_generic_clinical(clinical: Column) -> Column:
    """Names nothing: every part between semicolons is a bare head, filler, or an adjective of inheritance (TXT-08); null and blank texts are generic."""
    listed = lambda *tables: F.array(*[F.lit(w) for w in sorted(set().union(*tables))])

    def names_nothing(part: Column) -> Column:
        # one-element arrays bind the words once
        words = F.filter(F.transform(F.split(F.trim(part), P.CLINICAL_SEPARATOR), lambda w: F.lower(w)), lambda w: w != "")
        weak = (F.get(words, 0) == "syndromic") & (F.size(F.array_except(F.slice(words, 2, 1000), listed(P.SYNDROMIC_WEAK))) == 0)
        filler = F.size(F.array_except(words, listed(P.CLINICAL_STOP, P.GENERIC_CLINICAL, P.INHERITANCE_ONLY))) == 0
        return F.when(F.size(words) > 1, weak | filler).otherwise(F.size(F.array_except(words, listed(P.GENERIC_CLINICAL))) == 0)

    return F.forall(F.split(F.coalesce(clinical, F.lit("")), ";"), names_nothing)


def cues(text: Column, table: dict[str, str]) -> Column:
    """Names of the cues that occur."""
    return F.array_compact(F.array(*[F.when(F.coalesce(text, F.lit("")).rlike(p), F.lit(name)) for name, p in table.items()]))


def window_around(text: Column, needle: Column, radius: int = LOCAL_RADIUS) -> Column:
    """Characters around the first case-sensitive place; the whole text when absent or blank."""
    at = F.position(needle, text)
    lo = F.greatest(at - radius, F.lit(1))
    return F.when(blank(needle) | (at == 0), text).otherwise(F.substring(text, lo, at + F.length(needle) + radius - lo))


def with_discovery(df, text: str = "text", variant: str = "variant"):
    """discovery_label, discovery_confidence, cue arrays and keep_as_new_discovery (behaviour card 9.1).

    One-element arrays bind each step to a lambda variable: a filter on the label that
    Catalyst pushes down then repeats one expression instead of a tree of them.
    """
    groups = {"novel": P.NOVEL_CUES, "prev": P.PREVIOUS_CUES, "cite": P.CITATION_CUES, "expand": P.EXPANSION_CUES}
    whole = F.coalesce(F.col(text), F.lit(""))
    near = F.transform(F.array(window_around(whole, F.coalesce(F.col(variant), F.lit("")))), lambda w: F.struct(*[cues(w, c).alias(g) for g, c in groups.items()]))
    both = F.transform(near, lambda n: F.struct(n.alias("near"), *[F.when(F.size(n[g]) > 0, n[g]).otherwise(cues(whole, c)).alias(g) for g, c in groups.items()]))
    said = lambda label, confidence: F.struct(F.lit(label).alias("label"), (F.lit(confidence) if isinstance(confidence, str) else confidence).alias("confidence"))

    def verdict(c: Column) -> Column:
        novel, prev, cite, expand = (F.size(c[g]) > 0 for g in groups)
        l_novel, l_prev = F.size(c["near"]["novel"]) > 0, F.size(c["near"]["prev"]) > 0
        strong = F.arrays_overlap(c["novel"], F.array(*[F.lit(x) for x in P.STRONG_NOVEL]))
        # later rules win, so they are asked first
        found = (
            F.when(expand & novel, said("novel", "high"))
            .when(novel & prev & l_prev & ~l_novel, said("previously_reported", "medium"))
            .when(novel & prev & l_novel & ~l_prev, said("novel", "medium"))
            .when(novel & prev, said("unclear", "low"))
            .when(novel & ~prev & ~cite, said("novel", F.when(strong, F.lit("high")).otherwise(F.lit("medium"))))
            .when(prev & expand & ~novel, said("phenotype_expansion", "medium"))
            .when(prev & ~novel, said("previously_reported", "high"))
            .when(cite & ~novel, said("citation_of_prior", "high"))
            .otherwise(said("unclear", "low"))
        )
        return F.struct(found.alias("v"), *[c[g].alias(g) for g in groups])

    df = df.withColumn("__v", F.element_at(F.transform(both, verdict), 1))
    df = df.withColumn("discovery_label", F.col("__v.v.label")).withColumn("discovery_confidence", F.col("__v.v.confidence"))
    df = df.withColumns({f"cue_{g}": F.col(f"__v.{g}") for g in groups})
    df = df.withColumn("keep_as_new_discovery", F.col("discovery_label").isin("novel", "phenotype_expansion")).drop("__v")
    return settled(df)


def search_terms(variant: Column) -> Column:
    """Spellings of a variant for text matching, in order, lower case (HGV-11)."""
    v = F.lower(F.trim(F.coalesce(variant, F.lit(""))))
    relaxed = F.regexp_replace(v, r"[()\s]", "")
    named = F.nullif(F.regexp_extract(relaxed, r"(?i)\b([a-z]{1,4}\d+[^;\s,]*)\b", 1), F.lit(""))
    tail = F.when(relaxed.rlike(r"^[pc]\."), F.substring(relaxed, 3, 1 << 20))
    return F.filter(F.array_distinct(F.array_compact(F.array(v, F.nullif(F.regexp_extract(v, r"(rs\d{4,})", 1), F.lit("")), relaxed, tail, named))), lambda t: t != "")


def same_allele(a: Column, b: Column) -> Column:
    """Two names share a spelling of four characters or more (HGV-12)."""
    long_terms = lambda c: F.filter(search_terms(c), lambda t: F.length(t) >= 4)
    return F.arrays_overlap(long_terms(a), long_terms(b))


def pathogenicity(text: Column, gene: Column, variant: Column) -> Column:
    """struct(label, confidence, anchor_kind, evidence): the first spelling of the variant, the gene or the whole text decides the window (card 9.4)."""
    whole = F.coalesce(text, F.lit(""))
    # one-element arrays bind an inner result to a lambda variable, so that it is computed once
    once = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)

    def place(low: Column) -> Column:
        places = F.filter(F.transform(search_terms(variant), lambda x: F.position(x, low)), lambda at: at > 0)
        by_gene = F.when(blank(gene), F.lit(0)).otherwise(F.position(F.lower(F.trim(gene)), low))
        return F.struct(F.coalesce(F.get(places, 0), F.lit(0)).alias("variant"), by_gene.alias("gene"))

    def window(at: Column) -> Column:
        anchor = F.when(at["variant"] > 0, at["variant"]).otherwise(at["gene"])
        lo = F.greatest(anchor - 900, F.lit(1))
        context = F.when(anchor > 0, F.substring(whole, lo, anchor + 1400 - lo)).otherwise(whole)
        return F.struct(context.alias("context"), F.when(at["variant"] > 0, "variant").when(at["gene"] > 0, "gene").otherwise("text").alias("kind"))

    names = ("lp", "p", "vus", "lb", "b")
    patterns = (P.LIKELY_PATHOGENIC, P.PATHOGENIC, P.UNCERTAIN, P.LIKELY_BENIGN, P.BENIGN)

    def found(w: Column) -> Column:
        return F.struct(w["kind"].alias("kind"), *[_snippet(w["context"], x).alias(n) for n, x in zip(names, patterns, strict=True)])

    def verdict(f: Column) -> Column:
        lp, p, vus, lb, b = (f[n].isNotNull() for n in names)
        anchored = f["kind"] != "text"
        both = (lp | p) & (lb | b)
        label = F.when(both, "conflicting").when(lp, "likely_pathogenic").when(p, "pathogenic").when(vus, "uncertain").when(lb, "likely_benign").when(b, "benign").otherwise("not_evaluated")
        sure = F.when(blank(text), "no_fulltext").when(both, "medium").when(lp | p | vus | lb | b, F.when(anchored, "high").otherwise("low")).otherwise(F.when(anchored, "low").otherwise("very_low"))
        evidence = F.coalesce(f["lp"], f["p"], F.when(~both, f["vus"]), f["lb"], f["b"], F.lit(""))
        return F.struct(label.alias("label"), sure.alias("confidence"), f["kind"].alias("anchor_kind"), evidence.alias("evidence"))

    return once(once(once(once(F.lower(whole), place), window), found), verdict)


def _snippet(context: Column, pattern: str, before: int = 180, after: int = 220) -> Column:
    """Text around the first place of a pattern; null without one."""
    found = F.regexp_instr(context, F.lit(pattern))
    lo = F.greatest(found - before, F.lit(1))
    length = F.length(F.regexp_extract(context, pattern, 0))
    return F.when(found > 0, F.trim(F.substring(context, lo, found - lo + length + after)))


def pub_date_key(year: Column, month: Column) -> Column:
    """'YYYY-MM', or 'YYYY' for an unknown month; null without a year."""
    named = F.create_map(*[F.lit(x) for kv in P.MONTHS.items() for x in kv])[F.substring(F.initcap(F.trim(month)), 1, 3)]
    number = F.when(F.trim(month).rlike("^[0-9]{1,2}$"), F.trim(month)).try_cast("int")
    mm = F.coalesce(F.when(number.between(1, 12), F.lpad(number.cast("string"), 2, "0")), named)
    return F.when(blank(year), F.lit(None)).when(mm.isNull(), F.trim(year)).otherwise(F.concat(F.trim(year), F.lit("-"), mm))


def normalize_name(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.lower(F.coalesce(name, F.lit(""))), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def normalize_issn(issn: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(issn, F.lit(""))), "[^0-9X]", "")


def normalize_pmcid(value: Column) -> Column:
    digits = F.regexp_extract(F.coalesce(value, F.lit("")), r"(?i)^\s*(?:PMC)?(\d+)\s*$", 1)
    return F.when(digits == "", F.lit(None)).otherwise(F.concat(F.lit("PMC"), digits))


def clip(text: Column, n: int = 700) -> Column:
    """White space collapsed; more than ``n`` characters are cut to ``n - 1`` and an ellipsis."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " "))
    return F.when(F.length(flat) > n, F.concat(F.substring(flat, 1, n - 1), F.lit("…"))).otherwise(flat)


def first_snippet(text: Column, word: Column, radius: int = 42) -> Column:
    at = F.position(F.lower(word), F.lower(F.coalesce(text, F.lit(""))))
    lo = F.greatest(at - radius, F.lit(1))
    return F.when(at > 0, F.trim(F.regexp_replace(F.substring(text, lo, at + F.length(word) + radius - lo), r"\s+", " ")))


def html_to_text(html: Column) -> Column:
    steps = [(r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " "), (r"(?s)<!--.*?-->", " "), (r"(?i)<(?:br|/p|/div|/li|/h[1-6])\s*/?>", "\n"), (r"(?s)<[^>]+>", " "), (r"&nbsp;", " "), (r"[ \t]+", " "), (r"\s*\n\s*", "\n")]
    return F.btrim(reduce(lambda c, s: F.regexp_replace(c, s[0], s[1]), steps, F.coalesce(html, F.lit(""))), F.lit(" \n\t\r"))


def section_type(title: Column) -> Column:
    """Type of a section by the first group of words that its title has."""
    low = F.lower(F.coalesce(title, F.lit("")))
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    (kind, words), *rest = P.SECTION_WORDS
    out = F.when(has(words), kind)
    for kind, words in rest:
        out = out.when(has(words), kind)
    return out.when(F.startswith(low, F.lit("fig")), "FIG").otherwise("OTHER")


def usable_passage(section: Column, kind: Column, text: Column, least: int = 40) -> Column:
    return ~F.coalesce(F.upper(section), F.lit("")).isin(*P.SKIPPED_SECTIONS) & (F.coalesce(F.lower(kind), F.lit("")) != "ref") & (F.length(F.trim(F.coalesce(text, F.lit("")))) >= least)


def is_concrete(variant: Column) -> Column:
    """A name of a nucleotide, protein or catalogued variant, not a phrase (FIL-10)."""
    return F.coalesce(variant, F.lit("")).rlike(P.CONCRETE_STRING)


def in_body(section: Column) -> Column:
    """Sections that links are looked for in (FIL-04)."""
    return F.upper(F.coalesce(section, F.lit(""))).isin(*P.BODY_SECTIONS)


def stamped(text: Column, source: Column) -> Column:
    """Abstract text marked as such, once (FIL-14)."""
    marked = F.contains(text, F.lit("[abstract]")) | F.contains(text, F.lit("[fulltext:"))
    return F.when((source == "abstract") & ~marked, F.concat(F.lit("[abstract] "), text)).otherwise(text)


def evidence_source(given: Column, scope: Column, full_text_source: Column, section: Column) -> Column:
    """abstract or fulltext: as given, else by what the row has (FIL-14)."""
    known = F.coalesce(given, scope)
    return F.when(known.isin("abstract", "fulltext"), known).when(~blank(full_text_source) | ~blank(section), "fulltext").otherwise("abstract")


def mentioned(variant: Column, text: Column) -> Column:
    """The text has the variant, or what follows its last colon, spaces aside."""
    squeezed = lambda c: F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", ""))
    v, t = squeezed(variant), squeezed(text)
    core = F.element_at(F.split(v, ":"), -1)
    return (v != "") & (t != "") & (F.contains(t, v) | ((core != "") & F.contains(t, core)))


def negative_link_tier(preset: Column, variant: Column, evidence: Column, rule: Column) -> Column:
    """struct(tier, reason): how firmly a negative allele is tied to its evidence (CLS-05)."""
    given, r = F.upper(F.trim(F.coalesce(preset, F.lit("")))), F.coalesce(rule, F.lit(""))
    e = F.coalesce(evidence, F.lit(""))
    has_variant, has_cue = mentioned(variant, evidence), e.rlike(P.NEGATIVE_CUE)
    both = has_variant & has_cue
    named = F.when(r == "", F.lit("unspecified")).otherwise(r)
    said = lambda tier, reason: F.struct((F.lit(tier) if isinstance(tier, str) else tier).alias("tier"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))
    return (
        F.when(given.isin("A", "B", "C"), said(given, "preset"))
        .when(F.trim(e) == "", said("C", "no_negative_evidence"))
        .when(both & r.isin(*P.TIER_A_RULES), said("A", F.concat(F.lit("same_sentence_classify_or_control:"), r)))
        .when(both & r.isin(*P.TIER_B_RULES), said("B", F.concat(F.lit("same_sentence_or_window_association:"), r)))
        .when(both & r.rlike("window|nearest|null"), said("B", F.concat(F.lit("same_sentence_windowish:"), named)))
        .when(both, said("A", F.concat(F.lit("same_sentence_variant_and_neg_cue:"), named)))
        .when(has_variant | has_cue, said("B", "partial_variant_or_cue_only"))
        .when(e.rlike(P.NEGATIVE_TOKEN) & has_cue, said("B", "generic_variant_token_and_cue"))
        .otherwise(said("C", "unconfirmed_cooccurrence"))
    )


def screen_grade(journal_tier: Column, recomputed: Column) -> Column:
    """A, B or C: as given, else by the journal, else C (CLS-06)."""
    ok = lambda c: F.when(F.upper(F.trim(c)).isin("A", "B", "C"), F.upper(F.trim(c)))
    return F.coalesce(ok(journal_tier), ok(recomputed), F.lit("C"))


def dual_presence(variants: Column, clinical: Column) -> Column:
    return (F.size(F.coalesce(variants, F.array())) > 0) & (F.size(F.coalesce(clinical, F.array())) > 0)
