"""Relational operators against plain Python on small tables."""

import random

from pyspark.sql import functions as F

from lociflow.operators import relational as R
from lociflow.operators import resolver
from lociflow.plans import delivery
from lociflow.plans.gates import Gate, apply_gates


def test_interval_join_equals_nested_loop(spark):
    rng = random.Random(1)
    make = lambda n: [(i, rng.choice("ab"), a := rng.randrange(3000), a + rng.randrange(900)) for i in range(n)]
    left, right = make(60), make(80)
    a = spark.createDataFrame(left, "i long, c string, lo long, hi long")
    b = spark.createDataFrame(right, "j long, c string, s long, e long")
    for width in (64, 1000, 250_000):
        got = sorted((r.i, r.j) for r in R.interval_join(a, b, "c", ("lo", "hi"), ("s", "e"), width).collect())
        assert got == sorted((x[0], y[0]) for x in left for y in right if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])


def test_best_latest_and_order_independence(spark):
    rows = [(i, i % 5, random.Random(i).randrange(3)) for i in range(60)]
    want = {k: min((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0])) for k in range(5)}
    for seed in (1, 2):
        shuffled = random.Random(seed).sample(rows, len(rows))
        df = spark.createDataFrame(shuffled, "o long, k long, s long").repartition(3)
        assert {r.k: tuple(r) for r in R.best_per_key(df, ["k"], [F.col("s")], "o").collect()} == want
        once = R.best_per_key(df, ["k"], [F.col("s")], "o")
        assert sorted(once.collect()) == sorted(R.best_per_key(once, ["k"], [F.col("s")], "o").collect())
    notes = spark.createDataFrame([("a", "2", 1), ("a", "2", 2), ("a", "1", 3)], "id string, u string, o long")
    assert R.latest_by(notes, ["id"], "u", "o").first().o == 2


def test_ladder(spark):
    table = spark.createDataFrame([("k1", "L1"), ("k1", "L2"), ("k2", "L3"), ("k3", "L4")], "key string, locus string")
    rows = spark.createDataFrame([(1, ["k1", "k2"]), (2, ["k1"]), (3, ["zz"]), (4, ["k3", "k2"])], "id long, ks array<string>")
    keys = F.transform("ks", lambda k, i: F.struct((i + 1).alias("step"), k.alias("key")))
    got = {r.id: (r.match_step, r.match_value, r.match_status) for r in R.ladder_lookup(rows, "id", keys, table, "key", "locus").collect()}
    assert got == {1: (2, "L3", "ok"), 2: (None, None, "ambiguous"), 3: (None, None, "missing"), 4: (1, "L4", "ok")}


def test_anti_bag_and_replace(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, None)], "id long, k1 string, k2 string")
    bad = spark.createDataFrame([("x",)], "k string")
    assert sorted(r.id for r in R.anti_any_key(rows, "id", [F.col("k1"), F.col("k2")], bad, "k").collect()) == [1, 3]
    chains = spark.createDataFrame([(1, "p", "v", "A"), (2, "p", "v", "A"), (3, "p", "v", "B"), (4, "q", "w", "A")], "o long, pmid string, v string, cls string")
    want = spark.createDataFrame([("p", "v", "A"), ("q", "w", "C")], "pmid string, v string, cls string")
    assert sorted(r.o for r in R.bag_semi_with_fallback(chains, want, ["pmid", "v", "cls"], ["pmid", "v"], "o").collect()) == [1, 4]
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string")
    new = spark.createDataFrame([(2, "c"), (2, "d")], "k long, x string")
    assert sorted(map(tuple, R.replace_by_key(old, new, "k").collect())) == [(1, "a"), (2, "c"), (2, "d")]


def test_dedup_argmax_and_arrays(spark):
    rows = spark.createDataFrame([(1, "1", "A", 2, "x"), (2, "1", "A", 1, "y"), (3, None, "A", 0, "z"), (4, "1", "A", 1, "w")], "o long, chrom string, ref string, r long, key string")
    got = {r.o: (r.place, r.group_size, r.dropped_keys) for r in R.dedup_alleles(rows, ["chrom", "ref"], [F.col("r")], "o", "key").collect()}
    assert got == {2: (1, 3, "x;w"), 3: (3, 1, "")}
    arg = spark.createDataFrame([("g", "a", 2, 1), ("g", "b", 2, 3), ("h", "c", 1, 1), ("h", "d", 1, 1)], "k string, v string, c1 long, c2 long")
    assert {r.k: r.v for r in R.unique_argmax(arg, ["k"], [F.col("c1"), F.col("c2")], "v").collect()} == {"g": "b", "h": None}
    assert {r.k: r.v for r in R.unique_argmax(arg, ["k"], [F.col("c1"), F.col("c2")], "v", [3, 4]).collect()} == {"g": None, "h": None}
    ci = spark.createDataFrame([(["A", "a", "b", "B", "c"],)], "x array<string>").select(R.stable_distinct_ci(F.col("x"))).first()[0]
    assert ci == ["A", "b", "c"]
    match = spark.createDataFrame([("rs12", "rs123"), ("c.5A>G", "NM_1:c.5A>G"), ("", "x")], "a string, b string").select(R.loose_token_match(F.col("a"), F.col("b")))
    assert [r[0] for r in match.collect()] == [False, True, False]


def test_gates(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x long")
    gates = [Gate("big", F.col("x") > 2), Gate("odd", F.col("x") % 2 == 1, "audit_only"), Gate("no", F.col("x") > 99, "disabled")]
    assert [r.x for r in apply_gates(df, gates).collect()] == [5]
    assert {r.x: r.gate_failed for r in apply_gates(df, gates, "audit").collect()} == {1: ["big"], 5: [], None: ["big", "odd"]}


def test_overlay_takes_each_note_once(spark):
    rows = spark.createDataFrame([(1, "a", "pos", "k"), (2, "b", "pos", "k"), (3, "c", "pos", "k"), (4, "d", "neg", "k"), (5, "e", "neg", "z")], "o long, audit_id string, cls string, k string")
    notes = spark.createDataFrame([(1, "a", "pos", "k", "old"), (2, "a", "pos", "k", "new"), (3, "x", "pos", "k", "first"), (4, "y", "pos", "k", " "), (5, "y", "other", "k", "loose")], "n long, audit_id string, cls string, k string, v string")
    got = {r.o: r.v for r in R.overlay(rows, notes, "audit_id", ["k"], "cls", ["v"], "o", "n").collect()}
    assert got == {1: "new", 2: "old", 3: "first", 4: "loose", 5: None}


def test_numbering_and_reports(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("o"), F.lit("c").alias("cls"))
    got = R.audit_ids(df, ["cls"], "o").orderBy("o").collect()
    assert [r.audit_id for r in got][:2] + [got[-1].audit_id] == ["c_0001", "c_0002", "c_1000"]
    gold = spark.createDataFrame([("1", "A", "G"), ("2", "C", None), ("3", "T", "A")], "k string, ref string, alt string")
    cand = spark.createDataFrame([("1", "A", "C", 1), ("1", "A", "G", 2), ("3", "T", "C", 3)], "k string, ref string, alt string, o long")
    assert tuple(R.gold_report(cand, gold, ["k"], ["ref", "alt"], "o").first()) == (3, 3, 2, 1, 0.5)


def test_resolver(spark):
    hits = [("GRCh38", "1", 10, "A", "G", "G1", "NM_1", "2", "c.5A>G", "p.Arg2Leu", "rs11111"), ("GRCh37", "1", 8, "A", "G", "G1", "NM_1", "2", "c.5A>G", "p.Arg2Leu", "rs11111"), ("GRCh38", "1", 20, "C", "T", "G2", "NM_2", "1", "c.9C>T", None, "rs22222"), ("GRCh38", "1", 21, "C", "A", "G2", "NM_3", "1", "c.9C>A", None, "rs22222")]
    index = resolver.reference_index(spark.createDataFrame(hits, "assembly string, chrom string, pos long, ref string, alt string, gene string, nm string, nm_version string, c string, p string, rs string"))
    seq = spark.createDataFrame([("1", 0, "A" * 9 + "A" + "A" * 9 + "CC" + "ACGTACGTAC" * 10)], "chrom string, chunk_no int, seq string")
    tx = spark.createDataFrame([("G9", "1", "T9", "1", "+", [(22, 121)], [(22, 81)])], "gene string, chrom string, t string, version string, strand string, exons array<struct<start:long,end:long>>, cds array<struct<start:long,end:long>>")
    alleles_ = spark.createDataFrame([("rs33333", True, "NC_000001.11", 30, "A", "G"), ("rs33333", True, "NC_000001.11", 30, "A", "T")], "rs string, is_ptlp boolean, seq_id string, pos long, ref string, alt string")
    freq = spark.createDataFrame([("rs33333", "NC_000001.11", "A", "G", "GnomAD", 1.0, 10.0), ("rs33333", "NC_000001.11", "A", "T", "other", 1.0, 10.0)], "rs string, seq_id string, ref string, alt string, study string, count double, total double")
    moves = spark.createDataFrame([], "rs string, seq_id string, ref string, alt string, weight int")
    known = resolver.catalogue_alleles(alleles_, freq, moves)
    assert [(r.alt, r.selection_note) for r in known.collect()] == [("G", "multi_allelic_chose_highest_frequency")]
    rows = [(1, "rs11111", "G1", "", None), (2, "p.R2L", "G1", "", None), (3, "rs22222", "G2", "the c.9C>T (rs22222) change", None), (4, "rs22222", "G2", "", None), (5, "c.4A>G", "G9", "", None), (6, "c.3del", "G9", "", None), (7, "rs33333", None, "", None), (8, "hello", None, "", "hello is at chr1:15 A>G"), (9, "GRCh38 chr1:12 G>A", None, "", None), (10, "c.77A>T", "G7", "", None)]
    solved = resolver.resolve(spark.createDataFrame(rows, "row_id long, variant string, gene string, evidence string, cached_text string"), index, transcripts=tx, sequence=seq, catalogue=known).cache()
    got = {r.row_id: r for r in solved.collect()}
    found = {i: (r.resolved.method, r.resolved.status, r.resolved.pos, r.resolved.ref, r.resolved.alt) for i, r in got.items()}
    assert found[1] == ("rs_clinvar", "ok", 10, "A", "G") and found[2] == ("gene_p_clinvar", "ok", 10, "A", "G")
    assert found[3] == ("rs_clinvar", "ok", 20, "C", "T") and found[4][0] == "unresolved"
    assert found[5] == ("ensembl_mane_c_map", "partial", None, "", "") and got[5].c_hgvs_strand == "+"  # the base there is T
    assert found[6] == ("ensembl_mane_c_map", "ok", 23, "CG", "C") and found[7][:2] == ("rs_dbsnp", "ok")
    assert found[8] == ("pdf_literal_genomic", "ok", 15, "A", "G") and found[9] == ("literal_genomic_chrpos_change", "partial", None, "", "")
    assert found[10] == ("c_hgvs_alleles_only", "partial", None, "A", "T")
    exported = delivery.with_narrative(delivery.export_rows(solved.withColumn("pmid", F.lit("9")))).cache()
    assert exported.where("resolve_status = 'ok'").where(delivery.is_delivered()).count() == 6
    assert "rs_clinvar" in exported.where("variant_text = 'rs11111'").first().stage9_text
    deduped = delivery.dedup_export(exported.withColumn("o", F.col("row_id").cast("long")), "o")
    assert deduped.count() == 9 and "genomic_dedup n=2" in deduped.where("variant_text = 'p.R2L'").first().resolve_note
    checked = delivery.with_context(exported.withColumn("row_id", F.col("row_id").cast("long")), seq, "row_id")
    assert {r.row_id: r.ref_ok_fasta for r in checked.collect()}[1] == "OK"
