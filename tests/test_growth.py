"""Steps whose work must grow with the input: plans, calls and whole results on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from lociflow.functions import spans, sql
from lociflow.plans import catalogue, stages
from lociflow.sources import readers


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_article_texts_are_read_once_a_name_and_not_broadcast(spark):
    rows = [(1, "a", "G", "c.5A>G"), (2, "a", "G", "c.5A>G"), (3, "b", None, "c.7C>T"), (4, None, "G", None), (5, "c", "G", "c.5A>G")]
    rows = spark.createDataFrame(rows, "id long, pmid string, gene string, variant string")
    texts = spark.createDataFrame([("a", "c.5A>G was benign."), ("b", "c.7C>T is pathogenic."), ("b", "It was benign, c.7C>T.")], "pmid string, cached_text string")
    out = stages.label_pathogenicity(rows, texts)
    plan = _plan(out)
    assert "Broadcast" not in plan  # a text is far longer than the estimate of its column
    aggregate, verdict = plan.find("HashAggregate"), plan.rfind("pathogenicity#")
    assert -1 < verdict < aggregate  # judged above the distinct names
    assert out.columns == ["pmid", "id", "gene", "variant", "pathogenicity"]
    got = sorted((r.id, r.pathogenicity.label, r.pathogenicity.confidence) for r in out.collect())
    assert got == [(1, "benign", "high"), (2, "benign", "high"), (3, "benign", "high"), (3, "pathogenic", "high"), (4, "not_evaluated", "no_fulltext"), (5, "not_evaluated", "no_fulltext")]


@pytest.mark.parametrize("name", ["lateral_negatives", "negative_loci", "article_records", "negative_evidence_rules", "evidence_names", "nearby_literals"])
def test_costly_extractors_run_on_all_cores(spark, name):
    # one small file is one split, so one task would read all texts
    assert "RoundRobinPartitioning" in _plan(catalogue.queries()[name](spark, "/root/testdata/sf0.001"))


def test_table_functions_take_many_arguments_a_batch(spark):
    sql.register(spark)
    texts = spark.range(3).selectExpr("id", "concat('We saw c.', id, 'A>G. It was likely benign (c.', id + 1, 'C>T).') AS text", "concat('c.', id, 'A>G') AS anchor")
    texts.createOrReplaceTempView("growth_texts")
    found = spark.sql("SELECT x.id, n.variant FROM growth_texts x, LATERAL negative_evidence(x.text, x.anchor) n")
    assert "ArrowEvalPythonUDTF" not in _plan(found)  # a batch of its own for every row
    assert {tuple(r) for r in found.collect()} == {(k, f"c.{k + 1}C>T") for k in range(3)}


def test_words_before_expressions_lose_no_match():
    rng = random.Random(7)
    words = "likely benign|not pathogenic|VUS|variant of uncertain significance|was classified as|reclassified as|classified as a VUS|c.5A>G|c.7C > T|p.Arg5Gln|p.(Arg5Gln)|p.R5Q|rs12345|NM_1.2:c.5A>G|IVS3+1G>A|not associated with|may not be related|benign control|compared to the benign|benign tumor|without benign variations|B/LB/P/LP|PolyPhen|colored based on|1000G, ExAC|previously classified as|pathogenic impact|(|)|.|,|missense mutation|mutational|rare syndrome|syndromic obesity|HP:1234567|HPO|clinical features|manifested as|insulin resistance|H-SIRS|seizures|developmental delay|hypoglycemia|AML|loss of Y|blood cancer|ſ|K|é".split("|")
    everything = [p for group in spans._compiled() for _, p in group] + [r.cue for r in spans._RULES] + [spans._SOFT, spans._EXCLUDED, spans._OVERTURNED, spans._PATHOGENIC_AMID]
    skipped = 0
    for _ in range(1500):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))
        text = text.replace("s", "ſ") if rng.random() < 0.1 else text.upper() if rng.random() < 0.2 else text
        for p in everything:
            assert [m.span() for m in p.finditer(text)] == [m.span() for m in p.re.finditer(text)]
            skipped += not p.able(text)
    assert skipped > 20_000


_RECORD = "<PubmedArticle><MedlineCitation><PMID>{0}</PMID><Article><Journal><ISSN> 1-2 </ISSN><JournalIssue><PubDate><Year>2001</Year></PubDate></JournalIssue><Title>J &amp; K</Title></Journal><ArticleTitle>On <i>x</i> y</ArticleTitle><Abstract><AbstractText>a <b>not</b> c</AbstractText><AbstractText/><AbstractText>d<!-- n -->e</AbstractText></Abstract></Article><CommentsCorrections><PMID>9</PMID></CommentsCorrections></MedlineCitation><ArticleId IdType='pmc'>PMC{0}</ArticleId><ArticleId IdType='pmc'>PMC0</ArticleId></PubmedArticle>"


def test_article_records_are_read_once_and_as_by_paths(spark):
    texts = [_RECORD.format(k) for k in range(3)] + ["<a/>", "<PMID>1</PMID>", "", None, "<Abstract><AbstractText> </AbstractText></Abstract>"]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    out = readers.efetch_articles(rows, "x")
    assert "xpath" not in _plan(out)
    one = lambda path: F.expr(f"nullif(trim(xpath_string(x, '{path}')), '')")
    want = rows.select(
        one("//MedlineCitation/PMID"), one("//ArticleTitle"), F.array_join(F.expr("xpath(x, '//Abstract/AbstractText/text()')"), " "), one("//Journal/Title"), one("//Journal/ISOAbbreviation"), one("//Journal/ISSN"),
        one("//JournalIssue/PubDate/Year"), one("//JournalIssue/PubDate/Month"), one('//ArticleId[@IdType="doi"]'), one('//ArticleId[@IdType="pmc"]'),
    )
    got = out.select("pmid", "title", "abstract", "journal", "journal_iso", "issn", "pub_date.year", "pub_date.month", "doi", "pmcid")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
