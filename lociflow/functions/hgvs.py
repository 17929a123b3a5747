"""Column functions over variant names, chromosomes, positions and alleles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lociflow.functions import patterns as P


def tight(variant: Column) -> Column:
    """'c.5A > G' as 'c.5A>G'."""
    return F.regexp_replace(F.trim(F.coalesce(variant, F.lit(""))), r"\s*>\s*", ">")


def variant_token(variant: Column) -> Column:
    t = tight(variant)
    return F.when(t.rlike(r"(?i)^rs\d+$"), F.lower(t)).otherwise(t)


def norm_var(variant: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(variant, F.lit("")), r"\s+", ""))


def protein_key(variant: Column) -> Column:
    """Lower case, no parentheses, one-letter residues."""
    t = norm_var(variant)
    body = F.regexp_replace(F.substring(t, 3, 1 << 20), r"^[()]+|[()]+$", "")
    swapped = reduce(lambda c, kv: F.regexp_replace(c, rf"(?<![a-z]){kv[0]}(?![a-z])", kv[1].replace("*", "\\*")), [kv for kv in P.AMINO_ACIDS.items() if len(kv[0]) == 3], body)
    return F.when(F.startswith(t, F.lit("p.")), F.concat(F.lit("p."), swapped)).otherwise(t)


def is_synonymous(variant: Column) -> Column:
    k = protein_key(variant)
    same = F.regexp_extract(k, r"^p\.([a-z*])\d+([a-z*=])$", 1)
    other = F.regexp_extract(k, r"^p\.([a-z*])\d+([a-z*=])$", 2)
    return F.endswith(k, F.lit("=")) | ((same != "") & (same == other))


def components(variant: Column) -> Column:
    """struct(nm, nm_version, c, p, rs); absent parts are null."""
    v = F.coalesce(variant, F.lit(""))
    part = lambda p, g=1: F.nullif(F.regexp_extract(v, p, g), F.lit(""))
    c, p = part(rf"(?i)\b({P.C_NAME})"), part(rf"(?i)\b({P.P_NAME})")
    return F.struct(
        F.upper(part(r"(?i)\b(NM_\d+)(?:\.(\d+))?")).alias("nm"),
        part(r"(?i)\b(NM_\d+)\.(\d+)", 2).cast("int").alias("nm_version"),
        F.regexp_replace(c, r"\s+", "").alias("c"),
        F.when(F.contains(p, F.lit("(")), p).otherwise(F.rtrim(p, F.lit(")"))).alias("p"),
        F.lower(part(r"(?i)\b(rs\d{4,})\b")).alias("rs"),
    )


def level(parts: Column) -> Column:
    nt = parts["c"].isNotNull() | parts["rs"].isNotNull()
    return F.when(nt & parts["p"].isNotNull(), "both").when(nt, "nt").when(parts["p"].isNotNull(), "pro").otherwise("other")


def lookup_keys(parts: Column, gene: Column) -> Column:
    """array of struct(step, key) for the reference ladder: rs, NM+c, gene+c, gene+p."""
    g = F.upper(F.trim(gene))
    rows = [(1, parts["rs"]), (2, F.concat(parts["nm"], F.lit("|"), parts["c"])), (3, F.concat(g, F.lit("|"), parts["c"])), (4, F.when(parts["p"].isNotNull(), F.concat(g, F.lit("|"), protein_key(parts["p"]))))]
    return F.filter(F.array(*[F.struct(F.lit(s).alias("step"), k.alias("key")) for s, k in rows]), lambda x: x["key"].isNotNull())


def norm_chrom(value: Column) -> Column:
    """1-22, X, Y or MT; null for anything else (one rule for every caller)."""
    t = F.upper(F.regexp_replace(F.trim(F.coalesce(value.cast("string"), F.lit(""))), r"(?i)^chr", ""))
    nc = F.regexp_extract(t, r"^NC_0*(\d+)(?:\.\d+)?$", 1)
    t = F.when(nc == "23", "X").when(nc == "24", "Y").when(nc.isin("12920", "1807"), "MT").when(nc != "", nc).when(t == "M", "MT").otherwise(t)
    t = F.regexp_replace(t, "^0+(?=[0-9])", "")
    return F.when(t.rlike("^(?:[1-9]|1[0-9]|2[0-2]|X|Y|MT)$"), t)


def chrom_ucsc(value: Column) -> Column:
    c = norm_chrom(value)
    return F.when(c == "MT", "chrM").otherwise(F.concat(F.lit("chr"), c))


def norm_pos(value: Column) -> Column:
    digits = F.regexp_replace(F.trim(value.cast("string")), ",", "")
    return F.when(digits.rlike("^[0-9]{1,15}$"), digits).try_cast("long")


def assembly(text: Column) -> Column:
    found = F.lower(F.regexp_extract(F.coalesce(text, F.lit("")), P.ASSEMBLY, 1))
    return F.when(found.isin("grch38", "hg38"), "GRCh38").when(found.isin("grch37", "hg19"), "GRCh37")


def literal_locus(text: Column) -> Column:
    """struct(chrom, pos, ref, alt, status) from 'chr1:1,234 A>G' or an NC_ g. name; 'partial' without alleles."""
    t = F.coalesce(text, F.lit(""))
    change, bare = P.CHR_CHANGE, P.CHR_POS
    named = r"(?i)\b(NC_\d+(?:\.\d+)?):g\.(\d+)([ACGT])\s*>\s*([ACGT])\b"
    pick = lambda p, ok: F.when(t.rlike(p), F.struct(norm_chrom(F.regexp_extract(t, p, 1)).alias("chrom"), norm_pos(F.regexp_extract(t, p, 2)).alias("pos"), (F.upper(F.regexp_extract(t, p, 3)) if ok else F.lit(None).cast("string")).alias("ref"), (F.upper(F.regexp_extract(t, p, 4)) if ok else F.lit(None).cast("string")).alias("alt"), F.lit("ok" if ok else "partial").alias("status")))
    return F.coalesce(pick(named, True), pick(change, True), pick(bare, False))


def geometry(ref: Column, alt: Column) -> Column:
    """snv, mnv, dup_tandem, del_vcf, ins_vcf or delins."""
    n, m = F.length(ref), F.length(alt)
    return F.when((n == 1) & (m == 1), "snv").when(n == m, "mnv").when(alt == F.concat(ref, ref), "dup_tandem").when((m < n) & F.startswith(ref, alt), "del_vcf").when((n < m) & F.startswith(alt, ref), "ins_vcf").otherwise("delins")


def geometry_warning(ref: Column, alt: Column) -> Column:
    """Why an unequal pair is no clean prefix form; null where it is one (HGV-25)."""
    n = F.least(F.length(ref), F.length(alt))
    shared = F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: (k <= n) & (F.substring(ref, F.lit(1), k) == F.substring(alt, F.lit(1), k))))
    reason = F.when(shared == 0, F.lit("delins_no_shared_prefix")).when(shared > 1, F.concat(F.lit("delins_shared_prefix="), shared.cast("string"), F.lit("_not_strict_vcf_left_align"))).otherwise("delins_unequal_non_prefix")
    return F.when(geometry(ref, alt) == "delins", reason)


def coordinate_check(chrom: Column, pos: Column, ref: Column, alt: Column, contig_length: Column, reference: Column) -> Column:
    """struct(status, checks): PASS, PASS_WARN, SKIP_EMPTY, FAIL_SYNTAX, FAIL_COORD, FAIL_FETCH or FAIL_REF (HGV-26).

    ``pos`` is the exported text; ``reference`` holds the joined bases of the reference allele's span.
    """
    c, p, r, a = (F.trim(F.coalesce(x.cast("string"), F.lit(""))) for x in (chrom, pos, ref, alt))
    r, a, n = F.upper(r), F.upper(a), F.when(p.rlike(r"^[+-]?[0-9]{1,18}$"), p).try_cast("long")
    said = lambda status, checks: F.struct(F.lit(status).alias("status"), (F.lit(checks) if isinstance(checks, str) else checks).alias("checks"))
    warning = geometry_warning(r, a)
    passed = F.concat_ws(",", geometry(r, a), warning, F.lit("fasta_ref_match"))
    return (
        F.when((c == "") | (p == "") | (r == ""), said("SKIP_EMPTY", "missing_chrom_or_pos_or_ref"))
        .when(n.isNull(), said("FAIL_SYNTAX", "position_not_integer"))
        .when(n < 1, said("FAIL_COORD", "position_lt_1"))
        .when(~r.rlike("^[ACGTN]+$"), said("FAIL_SYNTAX", "ref_non_acgtn"))
        .when(a == "", said("FAIL_SYNTAX", "alt_empty"))
        .when(~a.rlike("^[ACGTN]+$"), said("FAIL_SYNTAX", "alt_non_acgtn"))
        .when(r == a, said("FAIL_SYNTAX", "ref_equals_alt"))
        .when(contig_length.isNull(), said("FAIL_COORD", "chrom_not_in_fasta"))
        .when(n + F.length(r) - 1 > contig_length, said("FAIL_COORD", "ref_span_past_contig_end"))
        .when(reference.isNull(), said("FAIL_FETCH", "no_bases"))
        .when(F.upper(reference) != r, said("FAIL_REF", "fasta_ref_mismatch"))
        .when(warning.isNotNull(), said("PASS_WARN", passed))
        .otherwise(said("PASS", passed))
    )


def with_positions(bases: Column, start: Column) -> Column:
    """'A[101]C[102]...' (HGV-27)."""
    each = F.transform(F.filter(F.split(F.coalesce(bases, F.lit("")), ""), lambda b: b != ""), lambda b, i: F.concat(b, F.lit("["), (start + i).cast("string"), F.lit("]")))
    return F.array_join(each, "")
