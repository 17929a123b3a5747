"""Readers, writers, stages, streaming and the catalogue on tiny fixtures."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lociflow.functions import hgvs
from lociflow.plans import stages
from lociflow.sources import readers, sinks
from lociflow.streaming import ingest


def test_records_and_lists(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"pmid": "1", "title": "t"}\n\n{"pmid": "2"}\n')
    assert [r.pmid for r in readers.jsonl(spark, str(tmp_path / "a.jsonl"), readers.ARTICLES).orderBy("ord").collect()] == ["1", "2"]
    assert readers.jsonl_or_empty(spark, str(tmp_path / "none.jsonl"), readers.ARTICLES).count() == 0
    (tmp_path / "ids.txt").write_text("# head\n 12 x\n\n3\n12\n")
    assert [r.pmid for r in readers.id_list(spark, str(tmp_path / "ids.txt")).collect()] == ["12", "3"]
    (tmp_path / "b.csv").write_text("﻿pmid,gene\n1,G\n", encoding="utf-8")
    assert readers.csv(spark, str(tmp_path / "b.csv")).columns == ["pmid", "gene"]


def test_reference_tables(spark, tmp_path):
    head = "Assembly\tChromosome\tPositionVCF\tReferenceAlleleVCF\tAlternateAlleleVCF\tName\tGeneSymbol\tRS# (dbSNP)\n"
    rows = ["GRCh38\t1\t10\tA\tG\tNM_1.2(G1):c.5A>G (p.Arg2Leu)\tG1\t111", "GRCh37\t1\t9\tA\tG\tNM_1.2(G1):c.5A>G (p.Arg2Leu)\tG1\t111", "GRCh38\t1\tna\tA\tG\tx\tG2\t-1", "GRCh38\t2\t7\tA\tA\tx\tG2\t5"]
    with gzip.open(tmp_path / "v.tsv.gz", "wt") as f:
        f.write(head + "\n".join(rows) + "\n")
    table = readers.clinvar(spark, str(tmp_path / "v.tsv.gz"))
    assert table.count() == 2
    keys = {(r.key, r.locus) for r in readers.clinvar_keys(table).collect()}
    assert ("rs111", "GRCh38:1:10:A:G") in keys and not any("GRCh37" in locus for _, locus in keys)
    links = spark.createDataFrame([(1, "rs111", "G1"), (2, "c.5A>G", "G1"), (3, "c.9A>G", "G1"), (4, "hello", None)], "row_id long, variant string, gene string")
    routed = stages.match_reference(links.withColumn("variant", F.when(F.col("row_id") == 1, "rs1111").otherwise(F.col("variant"))), readers.clinvar_keys(table).unionByName(spark.createDataFrame([("rs1111", "L")], "key string, locus string")))
    assert {r.row_id: r.route for r in routed.collect()} == {1: "known", 2: "known", 3: "absent", 4: "unresolvable"}


def test_genome(spark, tmp_path):
    lines = ["1\ts\tCDS\t120\t150\t.\t+\t0\tParent=transcript:t1,transcript:t7;Parent=x", "1\ts\texon\t110\t160\t.\t+\t.\tParent=transcript:t1", "1\ts\tmRNA\t100\t400\t.\t+\t.\tID=transcript:t1;Parent=gene:g1;biotype=protein_coding;tag=basic,MANE_Select;version=3", "1\ts\tmRNA\t100\t400\t.\t+\t.\tID=transcript:t2;Parent=gene:g1", "1\ts\tgene\t100\t400\t.\t+\t.\tID=gene:g1;Name=AAA;biotype=protein_coding", "1\ts\tncRNA_gene\t600\t700\t.\t+\t.\tID=gene:g2;Name=BBB;biotype=lncRNA"]
    (tmp_path / "g.gff3").write_text("##gff\n" + "\n".join(lines) + "\n")
    features = readers.gff3_features(readers.gff3(spark, str(tmp_path / "g.gff3")))
    loci = spark.createDataFrame([(1, "1", 130, "A"), (2, "1", 155, "A"), (3, "1", 300, "A"), (4, "1", 650, "A"), (5, "1", 5000, "A"), (6, None, None, None)], "row_id long, chrom string, pos long, ref string")
    got = {r.row_id: (r.genomic_region, r.genomic_region_genes, r.genomic_region_transcripts) for r in stages.region_of(loci, features).collect()}
    assert got == {1: ("coding", "AAA", "t1"), 2: ("utr", "AAA", "t1"), 3: ("intron", "AAA", ""), 4: ("ncrna_gene", "BBB", ""), 5: ("intergenic", "", ""), 6: ("", "", "")}
    noted = stages.region_of(loci.withColumn("cat", F.lit("ZZZ")), features, catalog_gene="cat").where("row_id in (1, 5)").orderBy("row_id").collect()
    assert [r.genomic_region_note for r in noted] == ["catalog_gene ZZZ not overlapping position; GFF3=AAA", "catalog_gene ZZZ not overlapping position; intergenic"]
    mane = readers.mane_transcripts(readers.gff3(spark, str(tmp_path / "g.gff3"))).collect()
    assert [(r.gene, r.t, r.version, r.strand, [tuple(x) for x in r.exons], [tuple(x) for x in r.cds]) for r in mane] == [("AAA", "t1", "3", "+", [(110, 160)], [(120, 150)])]
    (tmp_path / "r.fa").write_text(">1 first\nACGTACGTAC\nGTTTT\n>2\nGGGG\n")
    seq = readers.fasta(spark, str(tmp_path / "r.fa"), 4)
    asked = spark.createDataFrame([(1, "1", 3, 9), (2, "2", 1, 4), (3, "1", 14, 20), (4, "1", 15, 15)], "i long, chrom string, s long, e long")
    got = {r.i: r.b for r in readers.fetch_bases(asked, seq, "chrom", "s", "e", "b", 4).collect()}
    assert got == {1: "GTACGTA", 2: "GGGG", 3: None, 4: "T"}


def test_passages(spark):
    bioc = json.dumps({"documents": [{"passages": [{"infons": {"section_type": "INTRO", "type": "p"}, "text": "x", "offset": 3}]}]})
    assert [tuple(r) for r in readers.bioc_passages(spark.createDataFrame([("1", bioc)], "pmid string, j string"), "j").collect()] == [("1", 0, "INTRO", "p", "x", 3)]
    plain = spark.createDataFrame([("1", "Introduction\n\nFirst block.\n\nResults\n\nSecond\nblock.")], "pmid string, t string")
    assert [(r.section_type, r.text) for r in readers.plain_passages(plain, "t", "pmid").orderBy("idx").collect()] == [("INTRO", "First block."), ("RESULTS", "Second block.")]
    page = spark.createDataFrame([("1", "<h2>Methods</h2><p>One</p><script>p</script><p>Two")], "pmid string, h string")
    assert [(r.section_type, r.text) for r in readers.html_passages(page, "h", "pmid").orderBy("idx").collect()] == [("METHODS", "One"), ("METHODS", "Two")]
    jats = spark.createDataFrame([("1", "<article-title>T</article-title><abstract><p>A</p></abstract><body><sec><title>Results</title><p>R</p></sec></body>")], "pmid string, x string")
    assert [r.section_type for r in readers.jats_passages(jats, "x", "pmid").orderBy("idx").collect()] == ["TITLE", "ABSTRACT", "RESULTS"]
    cand = spark.createDataFrame([("1", "bioc", "s"), ("1", "html", "x" * 2000), ("1", "html", "y" * 900), ("2", "bioc", "s"), ("2", "jats", "t")], "pmid string, source string, text string")
    assert {r.pmid: r.source for r in readers.source_cascade(cand, "pmid", ["bioc", "jats", "html"]).collect()} == {"1": "html", "2": "jats"}
    spdi = lambda p, d, i: {"allele": {"spdi": {"seq_id": "NC_000001.11", "position": p, "deleted_sequence": d, "inserted_sequence": i}}}
    payload = json.dumps({"primary_snapshot_data": {"placements_with_allele": [{"seq_id": "NC_000001.11", "is_ptlp": True, "alleles": [spdi(9, "A", "A"), spdi(9, "A", "G")]}]}})
    assert [(r.pos, r.ref, r.alt) for r in readers.dbsnp_alleles(spark.createDataFrame([("rs1", payload)], "rs string, j string"), "j", "rs").collect()] == [(10, "A", "G")]


def test_sinks_and_runner(spark, tmp_path):
    df = spark.createDataFrame([(1, True, None, "A"), (2, False, "x", "B")], "pmid long, ok boolean, gene string, cls string")
    sinks.write_table(df, str(tmp_path / "t"), ["gene", "pmid", "ok", "extra"], "\t")
    back = spark.read.csv(str(tmp_path / "t"), header=True, sep="\t").orderBy("pmid").collect()
    assert [r.ok for r in back] == ["true", "false"] and back[0].extra is None
    sinks.write_routes(df, str(tmp_path / "routes"), "cls")
    assert (tmp_path / "routes" / "cls=A").exists()
    assert json.loads(sinks.stage_report({"s": df}, {"s": ["cls"]})) == {"s": {"rows": 2, "cls": {"A": 1, "B": 1}}}
    pages = sinks.review_pages(spark.range(5).withColumn("x", F.lit("<b>")), "a<b", "id", 2).orderBy("page").collect()
    assert len(pages) == 3 and not any("<b" in p.html for p in pages) and sum(p.html.count('"id":') for p in pages) == 5
    sinks.write_table(df, str(tmp_path / "bom"), ["gene", "pmid"], bom=True)
    assert readers.csv(spark, str(tmp_path / "bom")).columns == ["gene", "pmid"]
    assert json.loads(sinks.export_contract(df.withColumn("sample_class", F.lit("p"))))["counts"] == {"sample_class": {"p": 2}}
    with pytest.raises(FileNotFoundError, match="nowhere"):
        readers.preflight(spark, [str(tmp_path), str(tmp_path / "nowhere")])
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache" / "PMID77.txt").write_text("x")
    assert readers.seed_cache(spark, str(tmp_path / "cache"), str(tmp_path / "seeded"), ["77", "88"]) == 1
    cached = sinks.text_cache(spark.createDataFrame([("b" * 500, "", ""), ("b" * 50, "l" * 50, "a" * 90), ("b", "", "")], "b string, l string, a string"), "b", "l", "a")
    assert [None if r.cached_text is None else len(r.cached_text) for r in cached.collect()] == [500, 192, None]
    run = stages.Runner({"one": lambda t: t["in"].where("pmid > 0"), "two": lambda t: t["one"].where("ok")}, {"in": df})
    calls = []
    kept = stages.Runner({"one": lambda t: calls.append(1) or t["in"]}, {"in": df}, str(tmp_path / "run"))
    assert kept.run()["one"].count() == 2 and kept.run()["one"].count() == 2 and len(calls) == 1
    assert run.only("2").run()["two"].count() == 0 and run.run(last="one")["one"].count() == 2


def test_funnel(spark):
    rows = [("1", "We identified a novel AAA1 c.5A>G variant in a child with Marfan syndrome.", "", 0), ("2", "The BBB2 c.7C>T variant was previously reported in Noonan syndrome.", "", 1), ("3", "No variant.", None, 2)]
    found = stages.discover(stages.link_articles(spark.createDataFrame(rows, "pmid string, title string, abstract string, ord long")))
    assert {r.pmid: (r.gene, r.discovery_label, r.tier) for r in found.collect()} == {"1": ("AAA1", "novel", "A"), "2": ("BBB2", "previously_reported", "A")}
    kept = stages.review(found.withColumn("row_id", F.col("ord")))
    assert {r.locus_key for r in kept.collect()} == {"AAA1|c.5a>g", "BBB2|c.7c>t"}
    sites = stages.new_sites(spark.createDataFrame([("1", "rs1234"), ("1", "rs9999"), ("1", "c.5A>G")], "pmid string, variant string"), spark.createDataFrame([("1", "c.5A>G (rs1234)")], "pmid string, text string"))
    assert {r.variant: r.kept for r in sites.collect()} == {"rs1234": True, "rs9999": False, "c.5A>G": True}
    journals = spark.createDataFrame([("nature", "Nature", "A", 0)], "alias_key string, canonical_name string, tier_name string, ord long")
    ranked = stages.rank_journals(spark.createDataFrame([(None, None, "Nature.", "fulltext"), (None, None, "Other", "abstract")], "issn string, journal_iso string, journal string, evidence_source string"), journals)
    assert sorted((r.journal_priority_score, r.match_method) for r in ranked.collect()) == [(5, "default"), (35, "journal_alias")]
    negatives = stages.negative_alleles(spark.createDataFrame([("1", "We saw c.5A>G. In AAA1 the likely benign (c.9C>T) change. Also not pathogenic (c.8C>T).")], "pmid string, text string"), spark.createDataFrame([("1", "c.5A>G")], "pmid string, variant string"), spark.createDataFrame([("AAA1", "c.8C>T")], "gene string, variant string"))
    assert {r.variant for r in negatives.collect()} == {"c.9C>T"}
    assert spark.createDataFrame([("chrM",)], "x string").select(hgvs.chrom_ucsc(F.col("x"))).first()[0] == "chrM"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"pmid": "1", "title": "old"}\n{"pmid": "2", "title": "x"}\n')
    go = lambda: ingest.upsert(ingest.article_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    go()
    (tmp_path / "in" / "b.json").write_text('{"pmid": "1", "title": "new"}\n')
    go()
    assert {r.pmid: r.title for r in ingest.read_table(spark, str(tmp_path / "out")).collect()} == {"1": "new", "2": "x"}


def test_catalogue_runs(spark):
    registered = entry.queries()
    assert set(entry.oracle_sql()) <= set(registered)
    assert entry.entry(spark).count() > 0
