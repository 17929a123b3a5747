"""Text, name and span functions on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from lociflow.functions import alleles, genes, hgvs, spans, text
from lociflow.operators import resolver
from lociflow.sources import search


def values(spark, column, rows, names="x"):
    schema = ", ".join(f"{n} string" for n in names.split())
    return [r[0] for r in spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema).select(column).collect()]


def test_sentences(spark):
    assert values(spark, text.sentences(F.col("x")), ['One a. Two b! "Three." (Four) e.g. no', None, " "]) == [["One a.", "Two b!", '"Three." (Four) e.g. no'], [], []]


def test_discovery_rules(spark):
    cases = {
        "We identified a novel change.": ("novel", "high"),
        "A de novo change.": ("novel", "medium"),
        "It was previously reported.": ("previously_reported", "high"),
        "Smith et al. reported it.": ("citation_of_prior", "high"),
        "A known variant that expands the phenotypic spectrum.": ("phenotype_expansion", "medium"),
        "A novel change; Smith et al. reported another.": ("unclear", "low"),
        "A novel change which expands the spectrum.": ("novel", "high"),
        "Nothing here.": ("unclear", "low"),
    }
    df = spark.createDataFrame([(k, None) for k in cases], "text string, variant string")
    got = {r.text: (r.discovery_label, r.discovery_confidence) for r in text.with_discovery(df).collect()}
    assert got == cases
    far = "novel " + "x" * 400 + " c.5A>G was previously reported."
    row = text.with_discovery(spark.createDataFrame([(far, "c.5A>G")], "text string, variant string")).first()
    assert row.discovery_label == "previously_reported"  # the local window sees only the prior cue


def test_dates_and_names(spark):
    key = text.pub_date_key(F.col("y"), F.col("m"))
    assert values(spark, key, [("2026", "Jan"), ("2026", "1"), ("2026", "13"), ("2026", None), (None, "1"), ("2026", "december")], "y m") == ["2026-01", "2026-01", "2026", "2026", None, "2026-12"]
    assert values(spark, text.normalize_name(F.col("x")), ["The Journal of A & B.", None]) == ["the journal of a and b", ""]
    assert values(spark, text.normalize_pmcid(F.col("x")), ["PMC12", "12", "x", None]) == ["PMC12", "PMC12", None, None]


def test_pathogenicity(spark):
    v = text.pathogenicity(F.col("t"), F.col("g"), F.col("v"))
    got = values(spark, v, [("c.1A>G is likely pathogenic", "G", "c.1A>G"), ("c.1A>G pathogenic, others benign", "G", "c.1A>G"), ("GENE1 is a VUS", "GENE1", "c.9"), ("benign", None, None), (None, "G", "c"), ("c.1A>G", "G", "c.1A>G")], "t g v")
    assert got[0].evidence == "c.1A>G is likely pathogenic" and got[4].evidence == ""
    assert [tuple(r)[:3] for r in got] == [("likely_pathogenic", "high", "variant"), ("conflicting", "medium", "variant"), ("uncertain", "high", "gene"), ("benign", "low", "text"), ("not_evaluated", "no_fulltext", "text"), ("not_evaluated", "low", "variant")]


def test_names(spark):
    assert values(spark, hgvs.protein_key(F.col("x")), ["p.(Arg69Leu)", "p.R69L", "p.Trp5Ter", "c.5A>G", None]) == ["p.r69l", "p.r69l", "p.w5*", "c.5a>g", ""]
    assert values(spark, hgvs.is_synonymous(F.col("x")), ["p.Leu5=", "p.L5L", "p.L5R"]) == [True, True, False]
    parts = values(spark, hgvs.components(F.col("x")), ["NM_000001.3:c.5A > G (p.Arg2Leu) RS12345", "nothing"])
    assert tuple(parts[0]) == ("NM_000001", 3, "c.5A>G", "p.Arg2Leu", "rs12345") and tuple(parts[1]) == (None,) * 5
    assert values(spark, hgvs.norm_chrom(F.col("x")), ["chr1", "M", "MT", "NC_000023.11", "23", "", None, "chr07"]) == ["1", "MT", "MT", "X", None, None, None, "7"]
    assert values(spark, hgvs.norm_pos(F.col("x")), ["1,234", "x", "", None]) == [1234, None, None, None]
    loci = values(spark, hgvs.literal_locus(F.col("x")), ["chr1:1,234 A>G", "NC_000002.12:g.55C>T", "chr3:99999", "none"])
    assert [tuple(x) if x else None for x in loci] == [("1", 1234, "A", "G", "ok"), ("2", 55, "C", "T", "ok"), ("3", 99999, None, None, "partial"), None]
    assert values(spark, hgvs.geometry(F.col("r"), F.col("a")), [("A", "G"), ("AC", "GT"), ("AC", "ACAC"), ("ACG", "A"), ("A", "ACG"), ("ACG", "TT")], "r a") == ["snv", "mnv", "dup_tandem", "del_vcf", "ins_vcf", "delins"]
    status = hgvs.coordinate_check(F.col("c"), F.col("p"), F.col("r"), F.col("a"), F.lit(100).cast("long"), F.col("b"))
    cases = [("chr1", "5", "A", "G", "A"), ("", None, "", "", None), ("chr1", "5", "A", "A", "A"), ("chr1", "5", "A", "G", "T"), ("chr1", "5", "ACG", "TT", "ACG"), ("chr1", "x", "A", "G", "A"), ("chr1", "0", "A", "G", "A"), ("chr1", "100", "AC", "G", None), ("chr1", "5", "ACG", "ATT", "ACG"), ("chr1", "5", "ACGA", "ACT", "ACGA")]
    got = values(spark, status, cases, "c p r a b")
    assert [r.status for r in got] == ["PASS", "SKIP_EMPTY", "FAIL_SYNTAX", "FAIL_REF", "PASS_WARN", "FAIL_SYNTAX", "FAIL_COORD", "FAIL_COORD", "PASS", "PASS_WARN"]
    assert got[9].checks == "delins,delins_shared_prefix=2_not_strict_vcf_left_align,fasta_ref_match"
    assert values(spark, hgvs.with_positions(F.col("x"), F.lit(7)), ["ACG", "", None]) == ["A[7]C[8]G[9]", "", ""]


def test_spans_and_genes():
    found = spans.find_spans("The c.206G>T (p.Arg69Leu) change in EDA caused Marfan syndrome.")
    assert [(s["kind"], s["norm"]) for s in found] == [("variant", "c.206G>T"), ("variant", "p.Arg69Leu"), ("clinical", "Marfan syndrome")]
    assert all("The c.206G>T (p.Arg69Leu) change in EDA caused Marfan syndrome."[s["start"] : s["end"]] == s["text"] for s in found)
    assert genes.resolve_gene("c.206G>T", "c.206G>T (p.Arg69Leu) in EDA") == ("EDA", "adjacent")
    assert genes.resolve_gene("c.5A>G", "the BRCA1 c.5A>G") == ("BRCA1", "adjacent")
    assert genes.resolve_gene("rs12345", "HOTX rs12345, a variant located in the TCP10L2 locus") == ("TCP10L2", "locus_phrase")
    assert genes.resolve_gene("rs12345", "HOTX rs12345 was seen") == (None, "none")
    notes = {"variants": [{"hgvs": "rs12345", "identifier": "x;CorrespondingGene:77"}], "genes": [{"identifier": "77", "name": "KIT"}]}
    assert genes.resolve_gene("RS12345", "RS12345 alone", pubtator=notes) == ("KIT", "pubtator")
    assert genes.resolve_gene("c.9A>T", "Nothing here.", abstract="Far away. We saw c.9A>T. It lies in a gene termed ABCD5.") == ("ABCD5", "naming_cue")
    assert genes.negative_gene("FOO1 carried c.7C>T, as did BS1.", "c.7C>T", "BAR2") == "FOO1" and genes.negative_gene("PM2 c.7C>T", "c.7C>T", "BAR2") == "BAR2"
    assert genes.corrected_gene("OLD1", "c.5A>G", "In NEW1 c.5A>G.", known=frozenset({"OLD1"})) == ("NEW1", "gene corrected from literature neighbor window: OLD1→NEW1")
    assert not any(map(genes.plausible_gene, ["DNA", "Japan", "P22H", "A", "12", None, "VUS"]))
    assert spans.disease_name("autosomal recessive disorder") is None and spans.disease_name("with the Alstrom syndrome type 2") == "Alstrom syndrome type 2"
    assert [s["norm"] for s in spans.clinical_spans("a rare syndromic intellectual deficit and acute myeloid leukemia")] == ["syndromic intellectual deficit", "acute myeloid leukemia"]
    assert spans.is_generic_clinical("syndrome; rare disorder") and not spans.is_generic_clinical("syndrome; Noonan syndrome")
    assert spans.known_variant_links("We saw c.5A>G and c.55A>G in a patient with epilepsy.", ["c.5A>G", "c.55A>G"])[0]["variant"] == "c.55A>G"
    assert spans.paired_names("c.5A>G (p.Arg2Leu); rs1234 (p.K3R)")[:2] == [("c.5A>G", "p.Arg2Leu"), ("p.Arg2Leu", "c.5A>G")]
    assert {n["rule"] for n in spans.negatives_in("rs99999 was not associated with risk. Unlike c.1A>G, c.7C>T was reclassified as likely benign.", "c.1A>G")} >= {"rs_null_association", "reclassified_lb"}
    assert spans.passage_links("A c.9A>T change was seen here. Patients had ataxia in all cases.")[0]["tier"] == "B"


def test_html_text(spark):
    assert values(spark, text.html_to_text(F.col("x")), ["<p>a&nbsp;b</p><script>x</script><p>c</p>"]) == ["a b\nc"]
    assert values(spark, text.section_type(F.col("x")), ["Materials and methods", "Results", "Foo"]) == ["METHODS", "RESULTS", "OTHER"]
    assert values(spark, text.usable_passage(F.lit("REF"), F.lit("p"), F.col("x")), ["y" * 50]) == [False]


def test_clip(spark):
    cut = values(spark, text.clip(F.col("x"), 5), ["ab cdef", "abc  \n de", "abc d", " \u00a0a\u2003\x1cb ", None])
    assert cut == ["ab c…", "abc …", "abc d", "a b", ""]


def test_clipped_text_query(spark, tmp_path):
    import duckdb

    import __spark_entry__ as entry

    rows = [(1, "x " * 400), (2, "y" * 700), (3, "z" * 701), (4, "a\u00a0\x0b b"), (5, None), (6, "w" * 698 + " tail")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.clipped for r in entry.queries()["clipped_text"](spark, str(tmp_path)).collect()}
    documents = duckdb.read_parquet(f"{tmp_path}/documents.parquet/*.parquet")  # noqa: F841
    assert found == dict(duckdb.sql(entry.oracle_sql()["clipped_text"]).fetchall())
    assert found[2] == "y" * 700 and found[3] == "z" * 699 + "…" and found[6] == "w" * 698 + " …"


def test_negative_rules():
    hits = lambda text, anchor="c.1A>G": [(n["rule"], n["variant"], n["label"]) for n in spans.negatives_in(text, anchor)]
    assert hits("The alleles c.10A>G and c.11C>T in our second cohort were classified by two laboratories as benign.") == [("were_classified_lb", "c.11C>T", "benign")]
    assert hits("As a negative control we used c.55G>A.") == [("control_cue_with_variant", "c.55G>A", "benign")]
    assert ("classify_then_nearby_var", "c.7C>T", "uncertain") in hits("It was classified as a VUS: c.7C>T.")
    assert ("variant_then_vus", "c.7C>T", "uncertain") in hits("c.7C>T was seen twice and classified as a VUS.")
    assert hits("c.7C>T is benign beside c.1A>G.") == [("nearest_other_to_label", "c.7C>T", "benign")]
    assert not hits("c.7C>T was classified as a VUS despite a VUS call.") and not hits("The benign tumor had c.7C>T, a control variant.")
    for words in ("may not be related", "is not related to risk", "no association was found", "no association observed", "not significantly associated", "no significant associations"):
        assert hits(f"The site rs12345 {words}.") == [("rs_null_association", "rs12345", "association_null")]
    assert hits("The site rs12345 is not related to risk.", "rs12345") == [("rs_null_association", "rs12345", "association_null")]


def test_clinical_upgrade():
    weak = {"clinical": "fulltext_context", "clinical_subtype": "narrative_context", "clinical_source": None, "tier": "B"}
    up = lambda *x: tuple(spans.upgrade_clinical(weak, *x).values())
    assert up("With ataxia.", None, None, None, "c.5A>G") == ("ataxia", "syndrome_disease", "lexicon_sentence", "A")
    assert up("x", "Also obesity.", None, None, "c.5A>G") == ("obesity", "phenotype_term", "lexicon_paragraph", "B")
    assert up("x", None, "Noonan syndrome", None, "c.5A>G") == ("Noonan syndrome", "syndrome_disease", "lexicon_title", "A")
    notes = {"relations": [{"role1": {"type": "Variant", "name": "c.5A>G"}, "role2": {"type": "Disease", "name": "Gout"}}], "diseases": [{"name": "Flu", "section": "title"}, {"name": "Rash", "section": "results"}]}
    assert up("x", None, None, notes, "c.5A > G") == ("Gout", "pubtator_disease", "pubtator_relation", "A")
    assert up("x", None, None, {"diseases": notes["diseases"]}, "c.5A>G") == ("Rash", "pubtator_disease", "pubtator_abstract", "B")
    assert up("x", None, None, None, "c.5A>G") == ("fulltext_context", "narrative_context", "narrative_context", "B")


def test_alleles():
    assert alleles.protein_keys("p.(Pro12=)") == {"p.pro12=", "p.p12=", "p.p12p", "p.pro12pro", "p.p12pro", "p.pro12p"}
    assert alleles.protein_keys("c.5A>G") == set()
    two = "c.439G>T (p.Val147Leu), c.193A>T (p.Thr65Ser), p.P1192P (rs766447664) and p.S1437S (rs1131692092)"
    assert alleles.merged_components("p.Thr65Ser", two)["c"] == "c.193A>T"
    assert alleles.merged_components("p.Ala75Asp", two)["c"] is None
    assert alleles.merged_components("rs1131692092", two)["p"] == "p.S1437S"
    assert alleles.merged_components("c.439G>T", two)["p"] == "p.Val147Leu"
    assert alleles.merged_components("c.12", "see c.12+3A>G") == alleles.merged_components("c.12", "see c.12+3A>G")
    assert [(s["kind"], s["chrom"], s["pos"], s["ref"]) for s in alleles.literal_spans("hg38 chr1:1,234 A>G and NC_000002.12:g.55C>T, rs12345")] == [("genomic_chrpos_change", "1", 1234, "A"), ("hgvs_g_nc", "2", 55, "C"), ("rsid", None, None, None)]
    assert (lambda a: (a["status"], a["pos"]))(alleles.literal_allele("chr3:99999")) == ("partial", None)
    text = "x " * 300 + "FOO1 c.5A>G at chr7 123456 A G in hg19. " + "y " * 300 + "chr8:777 C>T"
    assert (lambda a: (a["chrom"], a["pos"], a["assembly"]))(alleles.cached_text_allele(text, "FOO1", "c.5A>G")) == ("7", 123456, "GRCh37")
    assert alleles.region_cue("an intergenic enhancer")[0] == "intergenic" and alleles.anchor_genes("20 kb upstream of MYC")[::2] == ("MYC", "upstream")
    assert alleles.allows_intergenic("an intronic change", "hgvs_g") == (False, None) and alleles.allows_intergenic("a change", "hgvs_g") == (True, "unknown_noncoding")


def test_lifts():
    exons, cds = [(101, 110), (201, 220)], [(104, 110), (201, 211)]
    at = lambda name, strand="+": (lambda r: r and (r["kind"], r["lo"], r["hi"], r["ref"], r["alt"]))(resolver.lift_c(name, exons, cds, strand))
    assert at("c.1A>G") == ("sub", 104, 104, "A", "G") and at("c.8A>G") == ("sub", 201, 201, "A", "G")
    assert at("c.7+2T>C") == ("sub", 112, 112, "T", "C") and at("c.8-1G>A") == ("sub", 200, 200, "G", "A")
    assert at("c.-1A>G") == ("sub", 103, 103, "A", "G") and at("c.*1A>G") == ("sub", 212, 212, "A", "G")
    assert at("c.1A>G", "-") == ("sub", 211, 211, "T", "C") and at("c.12A>G", "-") == ("sub", 110, 110, "T", "C")
    assert at("c.2_3del") == ("del", 105, 106, None, None) and at("c.2_3insGA", "-") == ("ins", 209, 210, None, "TC")
    assert at("c.999A>G") is None and at("p.A1B") is None
    assert resolver.codon_positions("p.Met3Val", exons, cds, "+") == [110, 201, 202]
    assert resolver.lift_p("p.Met1Val", [104, 105, 106], ["A", "T", "G"], "+") == {"kind": "sub", "lo": 104, "hi": 104, "ref": "A", "alt": "G"}
    assert resolver.lift_p("p.M1V", [106, 105, 104], ["T", "A", "C"], "-") == {"kind": "sub", "lo": 106, "hi": 106, "ref": "T", "alt": "C"}
    assert resolver.lift_p("p.Leu1Val", [104, 105, 106], ["A", "T", "G"], "+") is None


def test_boolean_queries(spark):
    df = spark.createDataFrame([(1, "A pathogenic variant of the heart", "2026/03/01"), (2, "Loss-of-function mutations", "2025/12/31"), (3, None, None)], "i long, t string, d string")
    fields = {"title/abstract": F.col("t"), "date - publication": F.col("d")}
    hits = lambda q: [r.i for r in df.where(search.compile_query(q, fields, F.col("t"))).orderBy("i").collect()]
    assert hits('"loss of function"[Title/Abstract] OR variant') == [1, 2]
    assert hits('(variant OR mutation*) AND ("2026/01/01"[Date - Publication] : "3000"[Date - Publication])') == [1]
    assert hits("variant NOT heart") == [] and hits("mutation") == []
    with pytest.raises(ValueError, match="not closed"):
        search.compile_query("(a AND b", fields, F.col("t"))
