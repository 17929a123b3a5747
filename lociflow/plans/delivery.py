"""Delivery: export rows, allele dedup, human review, quality checks, and the narrative of a row's way through the stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.functions import hgvs, text
from lociflow.functions import patterns as P
from lociflow.operators import relational as R
from lociflow.plans.stages import _rank
from lociflow.sources import readers
from lociflow.sources.sinks import EXPORT_FIELDS, with_columns

VERDICT = ["human_verdict", "human_comment", "human_fail_stage", "human_genomic_region"]


def is_delivered(need_alt: bool = True) -> Column:
    """Status ok and coordinates; the alternative base is asked for unless ``need_alt`` is off (FIL-08)."""
    filled = lambda c: ~text.blank(F.col(c).cast("string"))
    out = (F.col("resolve_status") == "ok") & filled("chromosome_ucsc") & filled("position") & filled("ref")
    return out & filled("alt") if need_alt else out


def export_rows(resolved: DataFrame) -> DataFrame:
    """Rows of ``resolver.resolve`` in the export's columns, as strings (HGV-28)."""
    r, part = F.col("resolved"), F.col("parts")
    rows = resolved.withColumns(
        {
            "chromosome": r["chrom"], "chromosome_ucsc": hgvs.chrom_ucsc(r["chrom"]), "position": r["pos"], "ref": r["ref"], "alt": r["alt"], "c_hgvs": part["c"], "p_hgvs": part["p"], "nt_pro_only": part["level"],
            "variant_text": F.col("variant"), "assembly": F.coalesce(r["assembly"], F.lit("GRCh38")), "chromosome_notation": F.lit("bare_ncbi"), "transcript_id": part["nm"], "transcript_version": part["nm_version"],
            "transcript_id_input": part["nm"], "transcript_match": r["match"], "resolve_method": r["method"], "resolve_status": r["status"], "resolve_confidence": r["confidence"], "resolve_note": r["note"],
            "allele_query_source": F.when(r["method"] == "rs_dbsnp", "dbsnp").otherwise(""), "pubmed_url": F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), F.col("pmid"), F.lit("/")),
        }
    )
    keep = [c for c in ("row_id",) if c in rows.columns]
    return with_columns(rows, [*EXPORT_FIELDS, *keep])


def dedup_rank() -> list[Column]:
    """Least is best (card 9.8)."""
    upper = lambda c: F.upper(F.coalesce(F.col(c), F.lit("")))
    letter = lambda c, letters: F.coalesce(F.create_map(*[F.lit(x) for i, k in enumerate(letters) for x in (k, i)])[upper(c)], F.lit(9))
    return [
        _rank("resolve_status", P.STATUS_RANK), F.when(F.col("sample_class") == "positive", 0).otherwise(1), _rank("review_tier", P.REVIEW_RANK), letter("link_tier", "AB"), letter("screen_grade", "ABC"),
        _rank("nt_pro_only", P.LEVEL_RANK), F.coalesce("pmid", F.lit("")), F.coalesce("locus_key_src", F.lit("")),
    ]


def dedup_export(rows: DataFrame, order: str) -> DataFrame:
    """One row per whole allele by the rank of card 9.8, at the first place of its group; the note names what was dropped."""
    known = rows.withColumn("ref_upper", F.upper("ref")).withColumn("alt_upper", F.upper("alt"))
    best = R.dedup_alleles(known, ["chromosome_ucsc", "position", "ref_upper", "alt_upper"], dedup_rank(), order, "locus_key_src")
    noted = F.concat(F.lit("genomic_dedup n="), F.col("group_size").cast("string"), F.lit(" dropped="), F.replace("dropped_keys", F.lit(";"), F.lit(",")))
    note = F.when(F.col("group_size") > 1, F.concat_ws("; ", F.nullif(F.coalesce("resolve_note", F.lit("")), F.lit("")), noted)).otherwise(F.coalesce("resolve_note", F.lit("")))
    return best.withColumn("resolve_note", note).drop("ref_upper", "alt_upper", "dropped_keys", "group_size")


def reviewed(rows: DataFrame, notes: DataFrame, order: str, note_order: str, allowed: list[str] | None = None) -> DataFrame:
    """Rows that a person has passed, in an allowed region: theirs where given, else the pipeline's (FIL-12)."""
    noted = R.overlay(rows, notes, "audit_id", ["pmid", "gene", "variant_text"], "sample_class", VERDICT, order, note_order)
    used = F.coalesce(F.nullif(F.trim("human_genomic_region"), F.lit("")), F.trim("genomic_region"), F.lit(""))
    passed = noted.withColumn("region_used", used).where(F.lower(F.trim("human_verdict")) == "pass")
    return passed if allowed is None else passed.where(F.col("region_used").isin(*allowed))


def check_alleles(rows: DataFrame, sequence: DataFrame, row_id: str) -> DataFrame:
    """check_status and checks of every export row against the sequence (HGV-26)."""
    chrom, pos = hgvs.norm_chrom(F.col("chromosome_ucsc")), hgvs.norm_pos(F.col("position"))
    asked = rows.select(row_id, chrom.alias("b_chrom"), pos.alias("b_lo"), (pos + F.length(F.trim("ref")) - 1).alias("b_hi")).where("b_chrom is not null and b_lo >= 1 and b_hi >= b_lo")
    bases = readers.fetch_bases(asked, sequence, "b_chrom", "b_lo", "b_hi", "bases").select(F.col(row_id).alias("__b"), "bases")
    known = readers.contig_lengths(sequence).select(F.col("chrom").alias("__c"), "length")
    out = rows.join(bases, rows[row_id] == bases["__b"], "left").join(known, chrom == F.col("__c"), "left")
    checked = hgvs.coordinate_check(F.col("chromosome_ucsc"), F.col("position"), F.col("ref"), F.col("alt"), F.col("length"), F.col("bases"))
    return out.withColumn("__k", checked).select(*rows.columns, F.col("__k.status").alias("check_status"), F.col("__k.checks").alias("checks"))


def with_context(rows: DataFrame, sequence: DataFrame, row_id: str, width: int = 5) -> DataFrame:
    """context_ref_5bp with positions, ref_ok_fasta (OK, BAD, ERR, NA) and the inferred fix (HGV-27)."""
    chrom, pos, n = hgvs.norm_chrom(F.col("chromosome_ucsc")), hgvs.norm_pos(F.col("position")), F.length(F.trim(F.coalesce("ref", F.lit(""))))
    known = readers.contig_lengths(sequence).select(F.col("chrom").alias("__c"), "length")
    placed = rows.withColumns({"__chrom": chrom, "__pos": pos, "__n": n}).join(known, chrom == F.col("__c"), "left").withColumn("__lo", F.greatest(F.col("__pos") - width, F.lit(1))).withColumn("__hi", F.least(F.col("__pos") + F.col("__n") - 1 + width, F.col("length")))
    asked = placed.where("__n > 0 and __pos >= 1 and __hi >= __pos + __n - 1").select(row_id, F.col("__chrom").alias("b_chrom"), F.col("__lo").alias("b_lo"), F.col("__hi").alias("b_hi"))
    bases = readers.fetch_bases(asked, sequence, "b_chrom", "b_lo", "b_hi", "bases").select(F.col(row_id).alias("__b"), "bases")
    out = placed.join(bases, placed[row_id] == bases["__b"], "left")
    own = F.substring("bases", (F.col("__pos") - F.col("__lo") + 1).cast("int"), F.col("__n"))
    empty = text.blank(F.col("chromosome_ucsc")) | text.blank(F.col("position").cast("string")) | (F.col("__n") == 0)
    state = F.when(empty, "NA").when(F.col("bases").isNull(), "ERR").when(own == F.upper(F.trim("ref")), "OK").otherwise("BAD")
    r, a = F.upper(F.trim("ref")), F.upper(F.trim("alt"))
    shape = (
        F.when((F.length(r) > F.length(a)) & (a != "") & F.startswith(r, a), "del as VCF left-aligned (REF=anchor+deleted, ALT=anchor)")
        .when((a == F.concat(r, r)) & (r != "") & F.contains(F.lower(F.coalesce("c_hgvs", F.lit(""))), F.lit("dup")), "dup interval as tandem (REF=dup, ALT=REF+REF)")
        .when((F.length(r) == 1) & (F.length(a) == 1) & (F.col("resolve_method") == "ensembl_mane_p_map"), "p.-lift emitted SNV at differing coding base (single-base REF/ALT)")
    )
    noted = F.when(F.lower("resolve_note").rlike("gene corrected|normalized hyphen|left-aligned|left aligned|dup|range"), F.when(F.length("resolve_note") > 140, F.concat(F.substring("resolve_note", 1, 137), F.lit("..."))).otherwise(F.col("resolve_note")))
    method = F.when(text.blank(F.col("resolve_method")), "no_fix_operation_inferred").otherwise(F.concat(F.lit("resolve_method="), F.col("resolve_method")))
    fix = F.concat_ws("; ", F.array_distinct(F.array_compact(F.array(noted, shape))))
    return out.select(*rows.columns, F.when(state.isin("OK", "BAD"), hgvs.with_positions(F.col("bases"), F.col("__lo"))).otherwise("").alias("context_ref_5bp"), state.alias("ref_ok_fasta"), F.when(fix == "", method).otherwise(fix).alias("fix_operation"))


def _line(label: str, *columns: str) -> Column:
    return F.concat(F.lit(f"{label}: "), F.concat_ws(" / ", *[F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("-")) for c in columns]))


#: What each stage tells about a row: heading, and lines of (label, columns).
NARRATIVE = (
    ("Stage 1, retrieval", (("title", ("title",)), ("journal", ("journal", "journal_iso", "issn")), ("queries that hit", ("source_query_ids",)), ("queries that missed", ("missed_query_ids",)))),
    ("Stage 2, abstract links", (("link", ("variant_text", "gene", "clinical")), ("tier and method", ("tier", "method")), ("evidence", ("evidence_sentence",)))),
    ("Stage 3, full text", (("source and section", ("ft_source", "section")), ("found in the full text", ("variant_discovered_in_fulltext",)))),
    ("Stage 4, discovery", (("label and confidence", ("discovery_label", "discovery_confidence")), ("kept as new", ("keep_as_new_discovery",)))),
    ("Stage 5, reference", (("route", ("route",)), ("lookup keys", ("lookup_keys",)))),
    ("Stage 6, review", (("tier and locus", ("review_tier", "locus_key_src")),)),
    ("Stage 7, journal", (("tier and score", ("journal_tier", "journal_priority_score")), ("grade", ("screen_grade",)))),
    ("Stage 8, pathogenicity", (("label", ("label",)), ("evidence", ("pathogenicity_evidence",)))),
    ("Stage 9, genome", (("names", ("c_hgvs", "p_hgvs", "c_hgvs_strand")), ("method", ("resolve_method", "resolve_status", "resolve_confidence")), ("allele", ("chromosome_ucsc", "position", "ref", "alt")), ("region", ("genomic_region", "genomic_region_genes")), ("note", ("resolve_note",)))),
)


def with_narrative(rows: DataFrame) -> DataFrame:
    """stage1_text to stage9_text, and reasoning_chain_text over them (STR-05); columns a row lacks show as a dash."""
    have = {c: t for c, t in rows.dtypes}
    flat = lambda c: F.array_join(F.col(c).cast("array<string>"), ", ").alias(c) if have[c].startswith("array") else F.col(c).cast("string").alias(c)
    wanted = dict.fromkeys(c for _, lines in NARRATIVE for _, columns in lines for c in columns)
    shown = F.struct(*[flat(c) if c in have else F.lit(None).cast("string").alias(c) for c in wanted])
    out = rows.withColumn("__n", shown)
    for k, (heading, lines) in enumerate(NARRATIVE, 1):
        told = [_line(label, *[f"__n.{c}" for c in columns]) for label, columns in lines]
        out = out.withColumn(f"stage{k}_text", F.concat_ws("\n", F.lit(heading), *told))
    return out.withColumn("reasoning_chain_text", F.concat_ws("\n\n", *[f"stage{k}_text" for k in range(1, len(NARRATIVE) + 1)])).drop("__n")


def stamp(rows: DataFrame) -> DataFrame:
    """evidence_source and text_scope of every row, and abstract texts marked (FIL-14); missing columns count as null."""
    at = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    source = text.evidence_source(at("evidence_source"), at("text_scope"), at("ft_source"), at("section"))
    out = rows.withColumn("__s", source)
    out = out.withColumns({"evidence_source": F.col("__s"), "text_scope": F.col("__s")})
    return (out.withColumn("text", text.stamped(F.col("text"), F.col("__s"))) if "text" in rows.columns else out).drop("__s")
