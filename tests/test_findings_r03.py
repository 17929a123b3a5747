"""Plans whose costly steps ran in one task, in a few, or twice."""

from pyspark.sql import functions as F

from lociflow.operators import resolver
from lociflow.plans import catalogue, stages


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_on_discovery_stay_above_the_deal_of_a_small_scan(spark):
    plan = _plan(catalogue.queries()["review_gate_best"](spark, "/root/testdata/sf0.001"))
    above, below = plan.split("RoundRobinPartitioning")
    assert "RLIKE" in above
    assert "RLIKE" not in below  # the scan's one task


def test_negatives_are_searched_once(spark):
    texts = spark.createDataFrame([("1", "We saw c.1A>G. In G1 c.8C>T was later reclassified as benign."), ("2", "We saw c.1A>G. In G2 c.15C>T was later reclassified as benign.")], "pmid string, text string")
    anchors = spark.createDataFrame([("1", "c.1A>G", "G1"), ("2", "c.1A>G", "G2")], "pmid string, variant string, gene string")
    positives = spark.createDataFrame([("g1", "c.8C>T")], "gene string, variant string")
    out = stages.negative_alleles(texts, anchors, positives)
    assert "ArrowEvalPython" not in _plan(out)
    assert [(r.pmid, r.variant, r.label) for r in out.collect()] == [("2", "c.15C>T", "benign")]
    # without a gene, only the bare name of a positive counts
    nameless = stages.negative_alleles(texts.withColumn("text", F.regexp_replace("text", "In G\\d ", "There ")), anchors.withColumn("gene", F.lit(None).cast("string")), positives)
    assert [(r.pmid, r.gene) for r in nameless.collect()] == [("2", None)]


def test_full_text_is_dealt_before_its_searches(spark):
    passages = spark.createDataFrame([("1", 0, "RESULTS", "paragraph", "The c.5A>G variant was found in a boy with Alstrom syndrome.")], "pmid string, idx int, section_type string, passage_type string, text string")
    heads = spark.createDataFrame([("1", "A case", "", None)], "pmid string, title string, abstract string, pubtator string")
    plan = _plan(stages.link_full_text(passages, heads))
    assert plan.count("RoundRobinPartitioning") == 2
    assert "ArrowEvalPython" in plan
    assert sum("ArrowEvalPython [variants_scanned(text" in line for line in plan.splitlines()) == 1


def test_names_are_taken_apart_once(spark):
    rows = spark.createDataFrame([("1", "c.5A>G", "AAA1", "", None), ("2", "rs12345", "AAA2", "", None)], "row_id string, variant string, gene string, evidence string, cached_text string")
    table = spark.createDataFrame([("GRCh38", "1", 5, "A", "G", "AAA1", "NM_1", "2", "c.5A>G", None, "rs9")], "assembly string, chrom string, pos long, ref string, alt string, gene string, nm string, nm_version string, c string, p string, rs string")
    out = resolver.resolve(rows, resolver.reference_index(table))
    assert "components_with_evidence" not in _plan(out)
    assert sorted((r.row_id, r.resolved.pos, r.resolved.status) for r in out.collect()) == [("1", 5, "ok"), ("2", None, "failed")]
