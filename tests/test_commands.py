"""Every command on small files."""

import json

import pytest

from lociflow.__main__ import COMMANDS, main
from lociflow.operators import index_table, resolver
from lociflow.sources import readers

ARTICLE = {"pmid": "1", "title": "We identified a novel AAA1 c.5A>G variant in a child with Marfan syndrome.", "abstract": "In AAA1 c.9C>T was later reclassified as benign."}


@pytest.fixture()
def put(tmp_path):
    def write(name, *rows):
        (tmp_path / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")
        return str(tmp_path / name)

    return write


def rows(spark, path):
    return [r.asDict(True) for r in spark.read.json(path).collect()]


def test_funnel_commands(spark, put, tmp_path):
    out = lambda name: str(tmp_path / name)
    articles = put("articles.jsonl", ARTICLE, {"pmid": "2", "title": "No variant at all.", "abstract": None})
    assert main(["link", "--articles", articles, "--out", out("links")]) == 0
    assert [(r["pmid"], r["variant"], r["gene"]) for r in rows(spark, out("links"))] == [("1", "c.5A>G", "AAA1")]
    assert main(["discovery", "--links", out("links"), "--out", out("found")]) == 0
    assert rows(spark, out("found"))[0]["discovery_label"] == "novel"
    assert main(["filter", "--links", out("found"), "--out", out("kept"), "--tier", "strict"]) == 0
    assert [r["locus_key"] for r in rows(spark, out("kept"))] == ["AAA1|c.5a>g"]
    assert main(["filter", "--links", out("found"), "--out", out("some"), "--profile", "custom", "--gates", '{"confidence": "disabled", "tier": "audit_only"}']) == 0
    assert len(rows(spark, out("some"))) == 1 and "gate_confidence" not in rows(spark, out("some"))[0]
    journals = put("journals.jsonl", {"alias_key": "nature", "canonical_name": "Nature", "tier_name": "A"})
    ranked = put("ranked.jsonl", {"pmid": "1", "issn": None, "journal_iso": "x", "journal": "Nature", "evidence_source": "abstract"})
    assert main(["journal", "--input", ranked, "--journals", journals, "--out", out("ranks")]) == 0
    assert rows(spark, out("ranks"))[0]["journal_priority_score"] == 30
    texts = put("texts.jsonl", {"pmid": "1", "cached_text": "The c.5A>G variant was pathogenic."})
    assert main(["pathogenicity", "--input", out("links"), "--texts", texts, "--out", out("labels")]) == 0
    assert rows(spark, out("labels"))[0]["pathogenicity"]["label"] == "pathogenic"
    whole = put("whole.jsonl", {"pmid": "1", "text": ARTICLE["title"] + " " + ARTICLE["abstract"]})
    none = put("none.jsonl", {"gene": "X", "variant": "c.1A>G"})
    assert main(["negatives", "--articles", whole, "--anchors", out("links"), "--positives", none, "--out", out("negatives")]) == 0
    assert [(r["variant"], r["label"]) for r in rows(spark, out("negatives"))] == [("c.9C>T", "benign")]
    bodies = put("bodies.jsonl", {"pmid": "1", "body": "<article><body><sec><title>Results</title><p>The AAA1 c.7G>A variant was seen in a child with Noonan syndrome and in others.</p></sec></body></article>"})
    assert main(["enrich", "--fulltext", bodies, "--articles", articles, "--out", out("full")]) == 0
    assert ("c.7G>A", "RESULTS") in {(r["variant"], r["section"]) for r in rows(spark, out("full"))}
    cached = put("cached.jsonl", {"pmid": "1", "body": "b" * 500, "links": "", "abstract": ""})
    assert main(["materialize", "--input", cached, "--out", out("cache")]) == 0 and len(rows(spark, out("cache"))[0]["cached_text"]) == 500
    assert main(["stamp", "--input", out("links"), "--out", out("stamped")]) == 0 and rows(spark, out("stamped"))[0]["text"].startswith("[abstract]")
    for command, more in (("pipeline", []), ("single", ["--pmid", "1"])):
        for profile in ("strict", "resume"):
            assert main([command, "--articles", articles, "--out", out(command), "--profile", profile, *more]) == 0
        assert spark.read.parquet(out(command) + "/review").count() == 1


def test_delivery_commands(spark, put, tmp_path):
    out = lambda name: str(tmp_path / name)
    reference = put("reference.jsonl", {"assembly": "GRCh38", "chrom": "7", "pos": 5, "ref": "A", "alt": "G", "gene": "AAA1", "nm": "NM_1", "nm_version": "1", "c": "c.5A>G", "p": "p.Lys2Arg", "rs": "rs12345"})
    found = put("found.jsonl", *({"pmid": str(k), "gene": "AAA1", "variant": v, "sample_class": "positive"} for k, v in enumerate(("c.5A>G", "rs12345", "c.8C>T"))))
    with pytest.raises(SystemExit):
        main(["export", "--input", found, "--out", out("export")])
    assert main(["export", "--input", found, "--reference", reference, "--out", out("export")]) == 0
    table = readers.csv(spark, out("export"))
    assert {(r.position, r.ref, r.resolve_status) for r in table.collect()} == {("5", "A", "ok"), (None, "C", "partial")}
    contract = json.loads((tmp_path / "export.contract.json").read_text())
    assert contract["rows"] == 2 and contract["counts"]["resolve_status"] == {"ok": 1, "partial": 1} and contract["enums"]["sample_class"] == ["positive"]
    index_table.write_index(resolver.reference_index(spark.read.json(reference)), out("index"), buckets=2)
    assert main(["export", "--input", found, "--index", out("index"), "--out", out("export2")]) == 0
    assert readers.csv(spark, out("export2")).count() == 2
    articles = put("articles.jsonl", {"pmid": "1", "text": "Of these c.5A>G (rs12345) was new."})
    notes = put("notes.jsonl", {"audit_id": "positive_1_0002", "sample_class": "positive", "pmid": "1", "gene": "AAA1", "variant_text": "rs12345", "human_verdict": "pass", "human_comment": "", "human_fail_stage": "", "human_genomic_region": "coding"})
    named = put("named.jsonl", *({"pmid": str(k), "gene": "AAA1", "variant": v, "variant_text": v, "sample_class": "positive", "genomic_region": ""} for k, v in enumerate(("c.5A>G", "rs12345", "rs99999"))))
    assert main(["deliver", "--input", named, "--articles", articles, "--notes", notes, "--out", out("delivery")]) == 0
    assert {r["variant"] for r in rows(spark, out("delivery/new_site"))} == {"c.5A>G", "rs12345"}
    audit = rows(spark, out("delivery/audit"))
    assert {r["audit_id"] for r in audit} == {"positive_0_0001", "positive_1_0002"} and all("Stage 9" in r["reasoning_chain_text"] for r in audit)
    assert "rs12345" in spark.read.text(out("delivery/html")).first()[0]
    assert [r.variant_text for r in readers.csv(spark, out("delivery/review_export")).collect()] == ["rs12345"]


def test_checks_and_manifests(spark, put, tmp_path, capsys):
    out = lambda name: str(tmp_path / name)
    (tmp_path / "g.fa").write_text(">chr7\nACGTACGTACGT\n")
    (tmp_path / "e.csv").write_text("pmid,gene,variant_text,chromosome_ucsc,position,ref,alt,c_hgvs,resolve_method,resolve_note\n1,G,c.5A>G,chr7,5,A,G,,m,\n2,G,c.6A>G,chr7,6,A,G,,m,\n")
    for command, column, want in (("qc-refalt", "check_status", ["FAIL_REF", "PASS"]), ("qc-context", "ref_ok_fasta", ["BAD", "OK"])):
        assert main([command, "--input", out("e.csv"), "--fasta", out("g.fa"), "--out", out(command)]) == 0
        assert sorted(r[column] for r in readers.csv(spark, out(command)).collect()) == want
    assert main(["bootstrap", "--reference", out("g.fa"), "--out", out("manifest")]) == 0
    [entry] = rows(spark, out("manifest"))
    assert entry["file"] == "g.fa" and entry["length"] == 19 and len(entry["sha256"]) == 64
    assert main(["compare", "--gold", out("e.csv"), "--candidate", out("e.csv")]) == 0
    assert json.loads(capsys.readouterr().out)["genomic_match_rate"] == 1.0


def test_every_command_is_known_and_told():
    assert len({c[0] for c in COMMANDS}) == len(COMMANDS) and all(run.__doc__ for _, run, _, _ in COMMANDS)
    with pytest.raises(SystemExit):
        main(["nothing"])
