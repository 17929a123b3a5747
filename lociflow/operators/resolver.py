"""From a variant in literature to one genomic allele: reference hits, literal names, transcript lifts, catalogued alleles.

Every way gives a candidate column; the ladder is one ``coalesce`` over them (card 9.7).  Keys are joined once for all
steps; what belongs to one row is then decided on small arrays, without another shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociflow.functions import alleles, hgvs
from lociflow.functions import patterns as P
from lociflow.operators.relational import dealt, settled
from lociflow.operators.tables import written
from lociflow.sources import readers

GRCH38 = "GRCh38"
METHODS = ("rs_clinvar", "nm_c_clinvar", "gene_c_clinvar", "gene_p_clinvar")
HIT = ["assembly", "chrom", "pos", "ref", "alt", "gene", "nm", "nm_version", "c", "p", "rs"]
ALLELE = "struct<chrom:string,pos:bigint,ref:string,alt:string,assembly:string,method:string,status:string,confidence:string,match:string,note:string>"


def allele(chrom, pos, ref, alt, assembly, method, status, confidence, match="not_applicable", note="") -> Column:
    """A candidate of the type ``ALLELE``; strings are literals."""
    lit = lambda c: F.lit(c) if c is None or isinstance(c, str) else c
    names = ("chrom", "pos", "ref", "alt", "assembly", "method", "status", "confidence", "match", "note")
    return F.struct(*[lit(v).cast("long" if n == "pos" else "string").alias(n) for n, v in zip(names, (chrom, pos, ref, alt, assembly, method, status, confidence, match, note), strict=True)]).cast(ALLELE)


def _keys(nm: Column, version: Column, c: Column, protein: Column, rs: Column, gene: Column) -> Column:
    """array of struct(step, key) over the four steps."""
    g, low = F.upper(F.trim(gene)), F.lower(c)
    single = [(1, rs), (2, F.concat(nm, F.lit("."), version, F.lit("|"), low)), (2, F.concat(nm, F.lit("|"), low)), (3, F.concat(g, F.lit("|"), low))]
    rows = F.array(*[F.struct(F.lit(s).alias("step"), k.alias("key")) for s, k in single])
    by_protein = F.transform(F.coalesce(protein, F.array().cast("array<string>")), lambda k: F.struct(F.lit(4).alias("step"), F.concat(g, F.lit("|"), k).alias("key")))
    return F.filter(F.concat(rows, by_protein), lambda x: x["key"].isNotNull())


def reference_index(table: DataFrame) -> DataFrame:
    """(step, key, hit) of every reference row, all spellings of its p. name included; hits of the preferred assembly hide others of the same key."""
    keyed = settled(table.withColumn("__p", alleles.protein_key_list("p"))).select(
        F.explode(_keys(F.col("nm"), F.col("nm_version").cast("string"), F.col("c"), F.col("__p"), F.col("rs"), F.col("gene"))).alias("k"),
        F.struct(*[F.col(c).cast("string" if c != "pos" else "long").alias(c) for c in HIT]).alias("hit"),
    ).select("k.step", "k.key", "hit")
    preferred = F.max(F.when(F.col("hit.assembly") == GRCH38, 1).otherwise(0)).over(Window.partitionBy("step", "key"))
    return keyed.withColumn("__best", preferred).where((F.col("__best") == 0) | (F.col("hit.assembly") == GRCH38)).drop("__best")


def _locus(h: Column) -> Column:
    return F.concat_ws("|", h["chrom"], h["pos"].cast("string"), h["ref"], h["alt"])


def _narrowed(hits: Column, keep: Callable[[Column], Column], when: Column | None = None) -> Column:
    """Hits that pass, unless none does."""
    passed = F.filter(hits, lambda h: F.coalesce(keep(h), F.lit(False)))
    use = F.size(passed) > 0
    return F.when(use if when is None else use & when, passed).otherwise(hits)


def unique_genomic(hits: Column) -> Column:
    """The one allele that all hits agree on, over all assemblies or in the preferred one; else null (JN-04)."""
    usable = F.filter(hits, lambda h: (F.coalesce(h["ref"], F.lit("")) != "") & (F.coalesce(h["alt"], F.lit("")) != "") & (h["ref"] != h["alt"]))
    kinds = F.size(F.array_distinct(F.transform(usable, lambda h: F.concat_ws("|", h["assembly"], _locus(h)))))
    newer = F.filter(usable, lambda h: h["assembly"] == GRCH38)
    return F.when(kinds == 1, F.get(usable, 0)).when(F.size(F.array_distinct(F.transform(newer, _locus))) == 1, F.get(newer, 0))


def pick_hit(df: DataFrame, hits: str, gene: Column, nm: Column, version: Column, out: str) -> DataFrame:
    """``out``: struct(hit, match): gene first, then the transcript, then whatever is unique (card 9.6)."""
    pool, exact, same = f"__{out}_pool", f"__{out}_exact", f"__{out}_same"
    df = df.withColumn(pool, _narrowed(F.col(hits), lambda h: h["gene"] == F.upper(F.trim(gene))))
    of_nm = lambda h: F.upper(h["nm"]) == F.upper(nm)
    df = df.withColumn(same, F.filter(pool, lambda h: F.coalesce(of_nm(h), F.lit(False))))
    df = df.withColumn(exact, F.filter(same, lambda h: version.isNull() | F.coalesce(h["nm_version"] == version.cast("string"), F.lit(False))))
    df = df.withColumns({f"{c}_one": unique_genomic(F.col(c)) for c in (pool, exact, same)})
    asked = nm.isNotNull()
    said = lambda hit, match: F.struct(hit.alias("hit"), F.lit(match).alias("match") if isinstance(match, str) else match.alias("match"))
    nothing = F.lit(None).cast(dict(df.dtypes)[f"{pool}_one"])
    any_ = F.col(f"{pool}_one")
    label = F.when(asked & ~F.coalesce(of_nm(any_), F.lit(False)), "clinvar_other_transcript").when(asked, "exact_nm").when(any_["nm"].isNotNull(), "clinvar_preferred_transcript").otherwise("no_transcript_in_clinvar")
    picked = (
        F.when(F.coalesce(F.size(pool), F.lit(0)) <= 0, said(nothing, "none"))
        .when(asked & (F.size(exact) > 0) & F.col(f"{exact}_one").isNotNull(), said(F.col(f"{exact}_one"), F.when(version.isNotNull(), "exact_nm_version").otherwise("exact_nm")))
        .when(asked & (F.size(exact) > 0), said(nothing, "ambiguous_nm"))
        .when(asked & F.col(f"{same}_one").isNotNull(), said(F.col(f"{same}_one"), F.when(version.isNotNull(), "nm_version_mismatch").otherwise("exact_nm")))
        .when(any_.isNotNull(), said(any_, label))
        .otherwise(said(nothing, "ambiguous"))
    )
    return df.withColumn(out, picked).drop(pool, exact, same, *(f"{c}_one" for c in (pool, exact, same)))


def reference_alleles(rows: DataFrame, index: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``rows`` (row id, gene, parts) with ``reference``: the ladder rs, NM + c, gene + c, gene + p with the rs pool between steps (JN-03)."""
    part = lambda n: F.col(f"parts.{n}")
    keyed = rows.withColumn("__protein", alleles.protein_key_list(part("p")))
    asked = keyed.select(F.col(row_id).alias("__id"), F.explode(_keys(part("nm"), part("nm_version"), part("c"), F.col("__protein"), part("rs"), F.col("gene"))).alias("k")).select("__id", "k.step", "k.key")
    found = asked.join(index, ["step", "key"]).select("__id", "step", "hit").distinct()
    order = lambda k: F.sort_array(F.collect_list(F.when(F.col("step") == k, F.col("hit"))))
    hits = found.groupBy("__id").agg(*[order(k).alias(f"__h{k}") for k in (1, 2, 3, 4)])
    df = dealt(keyed.join(hits, keyed[row_id] == hits["__id"], "left").drop("__id"))
    many = lambda c: F.size(c) > 1
    df = df.withColumn("__h1", _narrowed(F.col("__h1"), lambda h: F.lower(h["c"]) == F.lower(part("c")), many("__h1")))
    df = df.withColumn("__h1", _narrowed(F.col("__h1"), lambda h: F.array_contains(F.col("__protein"), F.lower(h["p"])), many("__h1")))
    df = pick_hit(df, "__h1", F.col("gene"), part("nm"), part("nm_version"), "__p1")
    pool = F.transform(F.coalesce(F.col("__h1"), F.array().cast(dict(df.dtypes)["__h1"])), _locus)
    df = df.withColumn("__pool", pool)
    for k in (2, 3, 4):
        df = df.withColumn(f"__h{k}", _narrowed(F.col(f"__h{k}"), lambda h: F.array_contains("__pool", _locus(h))))
        df = pick_hit(df, f"__h{k}", F.col("gene"), part("nm"), part("nm_version"), f"__p{k}")

    def hit_of(k: int) -> Column:
        h, match = F.col(f"__p{k}.hit"), F.col(f"__p{k}.match")
        sure = F.when(h["assembly"] == GRCH38, "high").otherwise("medium")
        return F.when(h.isNotNull(), allele(h["chrom"], h["pos"], h["ref"], h["alt"], h["assembly"], METHODS[k - 1], "ok", sure, match, F.concat(F.lit(f"{METHODS[k - 1]}; transcript_match="), match)))

    n = F.size(F.array_distinct(F.transform("__h4", lambda h: F.concat_ws("|", h["assembly"], _locus(h), h["nm"]))))
    unclear = F.when(F.size("__h4") > 0, allele(None, None, "", "", GRCH38, "gene_p_clinvar", "failed", "low", "ambiguous", F.concat(F.lit("gene+p matched "), n.cast("string"), F.lit(" ClinVar genomic alleles (ambiguous)"))))
    return df.withColumn("reference", F.coalesce(*[hit_of(k) for k in (1, 2, 3, 4)], unclear)).drop("__protein", "__pool", *[f"__{c}{k}" for c in "hp" for k in (1, 2, 3, 4)])


# -- catalogued alleles ----------------------------------------------------------------
def catalogue_alleles(alleles_: DataFrame, frequencies: DataFrame, movements: DataFrame) -> DataFrame:
    """One allele per rs name or none (card 9.9): alleles (rs, is_ptlp, seq_id, pos, ref, alt), frequencies (rs, seq_id, ref, alt, study, count,
    total), movements (rs, seq_id, ref, alt, weight).

    The preferred placement's alleles count; one allele is taken, else the unique most frequent, else the unique most observed.
    """
    names = F.create_map(*[F.lit(x) for kv in P.GRCH38_ACCESSIONS.items() for x in kv])
    known = alleles_.withColumn("chrom", names[F.col("seq_id")]).where("chrom is not null and ref <> alt")
    ptlp = F.max(F.col("is_ptlp").cast("int")).over(Window.partitionBy("rs"))
    pool = known.withColumn("__best", ptlp).where("__best = 0 or is_ptlp").groupBy("rs", "chrom", "pos", "ref", "alt").agg(F.max("seq_id").alias("seq_id"))
    liked = F.lower("study").rlike("|".join(P.FREQUENCY_STUDIES))
    frequency = frequencies.where("total > 0 and ref <> alt").groupBy("rs", "seq_id", "ref", "alt").agg(F.max(F.col("count") / F.col("total") * F.when(liked, 2.0).otherwise(1.0)).alias("f"))
    seen = movements.where("ref <> alt").groupBy("rs", "seq_id", "ref", "alt").agg(F.sum("weight").alias("w"))
    key = ["rs", "seq_id", "ref", "alt"]
    scored = pool.join(frequency, key, "left").join(seen, key, "left").withColumns({"f": F.coalesce("f", F.lit(-1.0)), "w": F.coalesce("w", F.lit(0))})
    whole = Window.partitionBy("rs")
    scored = scored.withColumns({"n": F.count("*").over(whole), "fm": F.max("f").over(whole), "wm": F.max("w").over(whole)})
    scored = scored.withColumns({"fn": F.sum((F.col("f") == F.col("fm")).cast("int")).over(whole), "wn": F.sum((F.col("w") == F.col("wm")).cast("int")).over(whole)})
    by_f = (F.col("fm") >= 0) & (F.col("fn") == 1)
    by_w = (F.col("wm") > 0) & (F.col("wn") == 1)
    keep = F.when(F.col("n") == 1, F.lit(True)).when(by_f, F.col("f") == F.col("fm")).when(by_w, F.col("w") == F.col("wm")).otherwise(False)
    note = F.when(F.col("n") == 1, "").when(by_f, "multi_allelic_chose_highest_frequency").otherwise("multi_allelic_chose_most_clinvar_obs")
    return scored.where(keep).select("rs", "chrom", "seq_id", "pos", "ref", "alt", note.alias("selection_note"))


# -- transcript lifts ------------------------------------------------------------------
_CODE = dict(zip((a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"), "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", strict=True))
_COMPLEMENT = str.maketrans("ACGTN", "TGCAN")
_C_PARTS = r"c\.([-*]?\d+)([+-]\d+)?(?:_([-*]?\d+)([+-]\d+)?)?(delins|del|dup|ins)?([ACGT]*)(?:>([ACGT]))?"
_C_NAME = re.compile(_C_PARTS, re.I)
_RESIDUE, _CHANGE = re.compile(r"p\.\(?[A-Za-z]{1,3}(\d+)(?:[A-Za-z]{1,3}|\*)\)?"), re.compile(r"p\.\(?([A-Za-z]{1,3})\d+([A-Za-z]{1,3}|\*)\)?")
LIFT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()), T.StructField("ref", T.StringType()), T.StructField("alt", T.StringType())])


class _Walk:
    """A transcript's bases in its own direction, by the lengths of its exons: no list of all positions is made."""

    def __init__(self, exons: list, cds: list, strand: str):
        self.back = strand == "-"
        self.exons = sorted(exons, reverse=self.back)
        self.ends = list(accumulate(b - a + 1 for a, b in self.exons))  # bases up to and with each exon
        lo, hi = min(a for a, _ in cds), max(b for _, b in cds)
        self.first, self.last = self.place(hi if self.back else lo), self.place(lo if self.back else hi)

    def place(self, position: int) -> int | None:
        """Place in the transcript of a genomic position, from 0; null outside the exons."""
        if self.back:
            k = bisect_left(self.exons, -position, key=lambda x: -x[1])
            k = next((j for j in (k - 1, k) if 0 <= j < len(self.exons) and self.exons[j][0] <= position <= self.exons[j][1]), None)
        else:
            k = bisect_right(self.exons, position, key=lambda x: x[0]) - 1
            k = k if k >= 0 and position <= self.exons[k][1] else None
        if k is None:
            return None
        a, b = self.exons[k]
        return self.ends[k] - (b - a + 1) + (b - position if self.back else position - a)

    def at(self, place: int) -> int | None:
        """Genomic position of a place; null outside the transcript."""
        k = bisect_right(self.ends, place)
        if place < 0 or k == len(self.ends):
            return None
        a, b = self.exons[k]
        left = self.ends[k] - place - 1  # bases of the exon behind it
        return a + left if self.back else b - left


def _walk(exons: list, cds: list, strand: str) -> _Walk | None:
    walk = _Walk(exons, cds, strand) if exons and cds else None
    return walk if walk and walk.first is not None and walk.last is not None else None


def lift_c(name: str | None, exons: list, cds: list, strand: str) -> dict | None:
    """Genomic span and bases of a c. name: substitutions, del, dup, ins, delins; introns by offset; - and * positions over the exons (HGV-21)."""
    m = _C_NAME.fullmatch((name or "").replace(" ", ""))
    walk = _walk(exons, cds, strand) if m else None
    if walk is None:
        return None

    def place(number: str, offset: str | None) -> int | None:
        n = int(number.lstrip("*"))
        position = walk.at(walk.last + n if number[0] == "*" else walk.first + n if n < 0 else walk.first + n - 1)
        return None if position is None else position + (-int(offset or 0) if walk.back else int(offset or 0))

    a = place(m[1], m[2])
    b = place(m[3], m[4]) if m[3] else a
    if a is None or b is None:
        return None
    bases, changed = m[6].upper(), (m[7] or "").upper()
    if walk.back:
        bases, changed = bases.translate(_COMPLEMENT)[::-1], changed.translate(_COMPLEMENT)
    lo, hi = min(a, b), max(a, b)
    if m[7]:
        return {"kind": "sub", "lo": lo, "hi": hi, "ref": bases, "alt": changed} if len(bases) == 1 and lo == hi else None
    if not m[5] or (m[5].lower() == "ins" and (not bases or hi - lo != 1)) or (m[5].lower() == "delins" and not bases):
        return None
    return {"kind": m[5].lower(), "lo": lo, "hi": hi, "ref": None, "alt": bases if m[5].lower() in ("ins", "delins") else None}


def codon_positions(name: str | None, exons: list, cds: list, strand: str) -> list[int]:
    """Genomic positions of the three bases of a p. name's codon, in transcript direction."""
    m = _RESIDUE.fullmatch(name or "")
    walk = _walk(exons, cds, strand) if m else None
    if walk is None:
        return []
    k = walk.first + 3 * (int(m[1]) - 1)
    return [walk.at(k + i) for i in range(3)] if k + 2 <= walk.last else []


def lift_p(name: str | None, positions: list[int], bases: list[str], strand: str) -> dict | None:
    """The single-base change in the codon that gives the named residue; the first by place and base; null without one."""
    m = _CHANGE.fullmatch(name or "")
    if not m or len(positions) != 3 or len(bases) != 3 or not all(bases):
        return None
    short = lambda r: r.upper() if len(r) == 1 else P.AMINO_ACIDS.get(r.lower(), "?").upper()
    codon = "".join(bases) if strand != "-" else "".join(bases).translate(_COMPLEMENT)
    was, becomes = short(m[1]), short(m[2])
    if was == becomes or _CODE.get(codon) != was:
        return None
    for k in range(3):
        for base in "ACGT":
            if base != codon[k] and _CODE.get(codon[:k] + base + codon[k + 1 :]) == becomes:
                return {"kind": "sub", "lo": positions[k], "hi": positions[k], "ref": bases[k], "alt": base.translate(_COMPLEMENT) if strand == "-" else base}
    return None


def _spans(value) -> list[tuple[int, int]]:
    return [] if value is None else [(int(x["start"]), int(x["end"])) for x in value]


@F.pandas_udf(LIFT)
def lift_names(names: pd.Series, exons: pd.Series, cds: pd.Series, strands: pd.Series) -> pd.DataFrame:
    rows = [lift_c(n, _spans(e), _spans(c), s) or {} for n, e, c, s in zip(names, exons, cds, strands, strict=True)]
    return pd.DataFrame({k: pd.Series([r.get(k) for r in rows], dtype="Int64" if k in ("lo", "hi") else object) for k in LIFT.fieldNames()})


@F.pandas_udf(T.ArrayType(T.LongType()))
def _codon(names: pd.Series, exons: pd.Series, cds: pd.Series, strands: pd.Series) -> pd.Series:
    return pd.Series([codon_positions(n, _spans(e), _spans(c), s) for n, e, c, s in zip(names, exons, cds, strands, strict=True)])


@F.pandas_udf(LIFT)
def _lift_p(names: pd.Series, positions: pd.Series, bases: pd.Series, strands: pd.Series) -> pd.DataFrame:
    rows = [lift_p(n, list(p) if p is not None else [], list(b) if b is not None else [], s) or {} for n, p, b, s in zip(names, positions, bases, strands, strict=True)]
    return pd.DataFrame({k: pd.Series([r.get(k) for r in rows], dtype="Int64" if k in ("lo", "hi") else object) for k in LIFT.fieldNames()})


def transcript_alleles(rows: DataFrame, transcripts: DataFrame, sequence: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``rows`` with ``lifted``: the allele that the gene's reference transcript gives for the c. name, else for the p. name."""
    tx = transcripts.select(F.upper("gene").alias("__g"), F.col("chrom").alias("__chrom"), "exons", "cds", F.col("strand").alias("__strand"), F.concat_ws(".", "t", "version").alias("__t"))
    df = rows.join(tx, F.upper("gene") == F.col("__g"), "left").drop("__g")
    df = df.withColumn("__c", lift_names("parts.c", "exons", "cds", "__strand")).withColumn("__codon", F.when(F.col("parts.c").isNull(), _codon("parts.p", "exons", "cds", "__strand")))
    spans = df.select(row_id, F.col("__chrom").alias("b_chrom"), F.when(F.col("__c.kind").isin("sub", "dup", "delins"), F.col("__c.lo")).otherwise(F.col("__c.lo") - (F.col("__c.kind") == "del").cast("int")).alias("b_lo"), F.when(F.col("__c.kind") == "ins", F.col("__c.lo")).otherwise(F.col("__c.hi")).alias("b_hi")).where("b_lo is not null")
    bases = readers.fetch_bases(spans, sequence, "b_chrom", "b_lo", "b_hi", "bases").select(F.col(row_id).alias("__b"), "bases")
    each = df.select(row_id, F.col("__chrom").alias("b_chrom"), F.posexplode("__codon").alias("k", "b_lo")).withColumn("b_hi", F.col("b_lo"))
    letters = readers.fetch_bases(each, sequence, "b_chrom", "b_lo", "b_hi", "base").groupBy(F.col(row_id).alias("__l")).agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "base"))), lambda x: x["base"]).alias("letters"))
    df = df.join(bases, df[row_id] == bases["__b"], "left").join(letters, df[row_id] == letters["__l"], "left").withColumn("__p", _lift_p("parts.p", "__codon", "letters", "__strand"))
    c, b = F.col("__c"), F.col("bases")
    ref = F.when(c["kind"] == "sub", c["ref"]).otherwise(b)
    alt = F.when(c["kind"].isin("sub", "delins"), c["alt"]).when(c["kind"] == "del", F.substring(b, 1, 1)).when(c["kind"] == "dup", F.concat(b, b)).when(c["kind"] == "ins", F.concat(b, c["alt"]))
    pos = c["lo"] - (c["kind"] == "del").cast("int")
    note = F.concat(F.lit("MANE "), F.col("__t"), F.lit(" lift"))
    by_c = F.when(c["kind"].isNotNull() & ref.isNotNull() & alt.isNotNull(), allele(F.col("__chrom"), pos, ref, alt, GRCH38, "ensembl_mane_c_map", "ok", "medium", "ensembl_mane_select", note))
    silent = hgvs.is_synonymous(F.col("parts.p"))
    failed = lambda method, why: allele(None, None, "", "", GRCH38, method, "failed", "low", "ensembl_mane_select", why)
    p = F.col("__p")
    by_p = F.when(p["kind"].isNotNull(), allele(F.col("__chrom"), p["lo"], p["ref"], p["alt"], GRCH38, "ensembl_mane_p_map", "ok", "medium", "ensembl_mane_select", note))
    has_c, has_p, has_tx = F.col("parts.c").isNotNull(), F.col("parts.p").isNotNull() & F.col("parts.c").isNull(), F.col("__t") != ""
    lifted = F.when(has_c & has_tx, F.coalesce(by_c, failed("ensembl_mane_c_map", "MANE c. lift failed"))).when(has_p & silent, failed("ensembl_mane_p_map", "synonymous p. name skipped")).when(has_p & has_tx, F.coalesce(by_p, failed("ensembl_mane_p_map", "MANE p. lift failed")))
    out = df.withColumn("lifted", lifted).withColumn("c_hgvs_strand", F.when(has_c, F.coalesce("__strand", F.lit(""))).otherwise(""))
    return out.select(*rows.columns, "lifted", "c_hgvs_strand")


# -- the ladder ------------------------------------------------------------------------
def _from_text(a: Column) -> Column:
    assembly = F.coalesce(a["assembly"], F.lit(GRCH38))
    return F.when(a["status"].isNotNull(), allele(a["chrom"], a["pos"], F.coalesce(a["ref"], F.lit("")), F.coalesce(a["alt"], F.lit("")), assembly, a["method"], a["status"], a["confidence"], "not_applicable", F.lit("")))


def resolve(rows: DataFrame, index: DataFrame, row_id: str = "row_id", transcripts: DataFrame | None = None, sequence: DataFrame | None = None, catalogue: DataFrame | None = None) -> DataFrame:
    """``rows`` (row id, variant, gene, evidence, cached_text) with ``parts``, ``resolved`` and ``c_hgvs_strand`` (HGV-23, card 9.7).

    Without transcripts and sequence, or without the catalogue of rs names, those steps are left out.  An allele of the
    preferred assembly whose reference bases differ from the sequence loses its position and is partial.
    """
    blob = F.concat_ws(" ", "variant", "evidence")
    df = rows.withColumn("parts", alleles.components_with_evidence("variant", "evidence"))
    df = df.withColumn("__own", _from_text(alleles.literal("variant"))).withColumn("__text", F.when(F.col("parts.level") != "pro", _from_text(alleles.literal(blob))))
    df = df.withColumn("__literal", F.coalesce("__own", "__text"))
    df = df.withColumn("__near", _from_text(alleles.literal_near("cached_text", "gene", "variant", "parts.c", "parts.p")))
    df = reference_alleles(written(df, "parts"), index, row_id)  # asks and rows both read it: names are taken apart once
    none = F.lit(None).cast(ALLELE)
    if transcripts is not None and sequence is not None:
        df = transcript_alleles(df, transcripts, sequence, row_id)
    else:
        df = df.withColumn("lifted", none).withColumn("c_hgvs_strand", F.lit(""))
    if catalogue is not None:
        known = catalogue.select(F.lower("rs").alias("__rs"), allele(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"), GRCH38, "rs_dbsnp", "ok", "high", "not_applicable", F.col("selection_note")).alias("__dbsnp"))
        df = df.join(known, F.lower("parts.rs") == F.col("__rs"), "left").drop("__rs")
    else:
        df = df.withColumn("__dbsnp", none)
    part = lambda n: F.col(f"parts.{n}")
    ok = lambda c: F.when(F.col(f"{c}.status") == "ok", F.col(c))
    rest = lambda c: F.when(F.col(f"{c}.status") != "ok", F.col(c))
    better = part("c").isNotNull() | part("rs").isNotNull() | (part("p").isNotNull() & F.col("gene").isNotNull())
    sub = F.coalesce(*[F.when(F.regexp_extract(t, P.C_SUBSTITUTION, 1) != "", t) for t in (F.col("variant"), part("c"), F.when(part("level") != "pro", blob))])
    letters = F.when(sub.isNotNull(), allele(None, None, F.upper(F.regexp_extract(sub, P.C_SUBSTITUTION, 1)), F.upper(F.regexp_extract(sub, P.C_SUBSTITUTION, 2)), GRCH38, "c_hgvs_alleles_only", "partial", "low", "none", "ref/alt from the c. name"))
    silent_rs = F.when(part("rs").isNotNull() & F.col("lifted.note").startswith("synonymous"), allele(None, None, "", "", GRCH38, "rs_unresolved", "failed", "low", "none", "rs name without a unique allele; synonymous p. name"))
    named = F.coalesce(hgvs.assembly(blob), F.lit(GRCH38))
    unresolved = allele(None, None, "", "", named, "unresolved", "failed", "low", F.when(part("nm").isNotNull(), "input_only").otherwise("none"), "no genomic map")

    def confirmed(columns: list[Column]) -> Column:
        return F.coalesce(*columns)

    chosen = confirmed([ok("__literal"), F.when(~better, rest("__literal")), ok("reference"), ok("__near"), ok("lifted"), ok("__dbsnp"), rest("reference"), rest("__near"), silent_rs, rest("lifted"), letters, rest("__literal"), unresolved])
    out = df.withColumn("resolved", chosen).select(*rows.columns, "parts", "resolved", "c_hgvs_strand")
    return reconfirmed(out, sequence, row_id) if sequence is not None else out


def reconfirmed(rows: DataFrame, sequence: DataFrame, row_id: str) -> DataFrame:
    """Alleles whose reference bases are not those of the sequence lose position and bases."""
    r = F.col("resolved")
    asked = rows.where((r["assembly"] == GRCH38) & r["pos"].isNotNull() & (r["ref"] != "") & r["chrom"].isNotNull()).select(row_id, r["chrom"].alias("b_chrom"), r["pos"].alias("b_lo"), (r["pos"] + F.length(r["ref"]) - 1).alias("b_hi"))
    bases = readers.fetch_bases(asked, sequence, "b_chrom", "b_lo", "b_hi", "bases").select(F.col(row_id).alias("__b"), "bases")
    df = rows.join(bases, rows[row_id] == bases["__b"], "left")
    wrong = allele(r["chrom"], None, "", "", r["assembly"], r["method"], "partial", "low", r["match"], F.concat(r["note"], F.lit("; ref mismatch with FASTA")))
    return df.withColumn("resolved", F.when(F.col("bases").isNotNull() & (F.upper("bases") != r["ref"]), wrong).otherwise(r)).select(*rows.columns)
