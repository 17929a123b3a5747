"""Passages in document order, generic clinical texts, scanned variants and places of names."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from lociflow.functions import genes, spans, text
from lociflow.functions import patterns as P
from lociflow.sources import passages

PAGE = (
    '<html><title>Some page title - PMC</title><body><p>outside</p><article><h1 class="content-title">Own <i>title</i></h1><section><h2 class="pmc_sec_title">Methods</h2><p>m1<p>m2 <b>x</b>y'
    '<section><h3 class="pmc_sec_title">Results of it</h3><table><tr><td><p>cell</p></td></tr></table><ul><li><p>item</p></li></ul></section><p>m3 &amp; &eacute;</p></section>'
    '<section id="ref-list1"><p>ref</p></section><section>bare text</section><p>Open in a new tab x</p></article><article><p>second</p></article><p>after</p>'
)
ARTICLE = (
    '<?xml version="1.0"?><!DOCTYPE article PUBLIC "x" "y.dtd"><article><front><article-title>The <i>T</i></article-title><abstract><title>Summary</title><p>A&nbsp;b</p></abstract></front>'
    "<body><p>lead</p><sec><title>Results</title><p>R1 <list><list-item><p>inner</p></list-item></list> tail</p><sec><title>A case</title><table-wrap><caption><p>cap</p></caption></table-wrap>"
    "</sec><p>after</p></sec></body><back><ref><article-title>other</article-title></ref><p>no</p></back></article>"
)


def test_page_in_document_order():
    got = [(kind, t, head) for kind, _, t, head in passages.html_page(PAGE)]
    assert got == [
        ("TITLE", "Own title", None), ("METHODS", "m1", "Methods"), ("METHODS", "m2 x y", "Methods"), ("RESULTS", "cell", "Results of it"), ("RESULTS", "item", "Results of it"),
        ("METHODS", "m3 & é", "Methods"), ("OTHER", "bare text", "Own title"),
    ]
    assert passages.html_page(None) == passages.html_page("") == passages.html_page("<script><p>x</p>") == []
    for piece in ("<p>", "<section>", "</div>", "<b>", "<article><p>x", "</p>", "<section><p>y</p>"):
        began = time.perf_counter()
        passages.html_page(piece * 5000)
        assert time.perf_counter() - began < 2, piece


def test_jats_in_document_order():
    got = [(kind, t) for kind, _, t, _ in passages.jats_article(ARTICLE)]
    assert got == [("TITLE", "The T"), ("ABSTRACT", "SummaryA b"), ("OTHER", "lead"), ("RESULTS", "R1 inner tail"), ("RESULTS", "inner"), ("CASE", "cap"), ("CASE", "after")]
    assert passages.jats_article("<a><b></a>") == passages.jats_article(None) == []


def test_passages_as_rows(spark):
    rows = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, "", "x"), (4, "<p>" + "long " * 100_000, "x")], "pmid long, h string, idx string")
    got = passages.html_passages(rows, "h", "pmid").orderBy("pmid", "idx").collect()
    assert [(r.pmid, r.idx) for r in got] == [(1, i) for i in range(7)] + [(4, 0)] and len(got[-1].text) == 499_999
    assert passages.jats_passages(rows.where("pmid = 2"), "h", "pmid").count() == 0
    plain = spark.createDataFrame([(1, "lead in\n\nINTRODUCTION\nFirst\n block.\n\n\n\x0cMethods and material\n\nSecond block.")], "pmid long, t string")
    assert [(r.section_type, r.text) for r in passages.plain_passages(plain, "t", "pmid").orderBy("idx").collect()] == [("OTHER", "lead in"), ("INTRO", "First block."), ("METHODS", "Second block.")]


def test_generic_clinical_text_is_the_same_in_both_forms(spark):
    rng = random.Random(3)
    words = ["syndrome", "Syndromic", "disorder", "the", "autosomal", "x-linked", "early-onset", "Marfan", "type", "cases", "spectrum", ";", " ; ", "-", "–", "familial", "2"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(600)] + [None, "", " ", ";", "syndromic", "SYNDROME", "syndromic cases"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.g for r in df.select(text.is_generic_clinical(F.col("t")).alias("g")).collect()]
    assert got == [spans.is_generic_clinical(t) for t in texts] and 50 < sum(got) < 550


@pytest.mark.parametrize(
    ("said", "want"),
    [
        ("RS12345 and c.5A > G, p.(Arg2Leu); rs12345 again", ["rs12345", "c.5A>G", "p.(Arg2Leu)"]),
        ("p.R5Q before c.7del\n and IVS2+1G>A", ["p.R5Q", "c.7del", "IVS2+1G>A"]),
        ("a novel variant", []),
        (None, []),
    ],
)
def test_scanned_variants_keep_the_order_of_the_text(said, want):
    assert spans.scan_variants(said) == want


def test_review_needs_a_named_clinical_text(spark):
    from lociflow.plans.gates import apply_gates, review_gates

    row = {"gene": "G", "discovery_confidence": "high", "method": next(iter(P.METHOD_RANK)), "clinical_source": P.ENTITY_SOURCES[0], "gene_source": P.GENE_SOURCES[0], "tier": "A"}
    df = spark.createDataFrame([row | {"clinical": c, "id": i} for i, c in enumerate(["syndrome", "Noonan syndrome", "disorder", ""])])
    assert [r.id for r in apply_gates(df, review_gates()).collect()] == [1]
    audit = {r.id: r.gate_failed for r in apply_gates(df, review_gates(), "audit").collect()}
    assert audit == {0: ["clinical_text"], 1: [], 2: ["clinical_text"], 3: ["clinical_text"]}


def test_places_are_those_of_an_escaped_expression():
    import re

    rng = random.Random(9)
    for _ in range(500):
        t = "".join(rng.choice("abAB.>( )İß") for _ in range(30))
        name = "".join(rng.choice("abAB.>(") for _ in range(rng.randrange(1, 4)))
        assert list(genes.find_all(t, name)) == [m.span() for m in re.finditer(re.escape(name), t, re.I)]
    assert list(genes.find_all("abc", "")) == []


def test_section_words_are_tried_in_order(spark):
    titles = ["Patient results", "Figure 1", "Fig. 2", "Materials", None, "x", "Summary table"]
    df = spark.createDataFrame([(x,) for x in titles], "t string")
    assert [r.k for r in df.select(text.section_type(F.col("t")).alias("k")).collect()] == [passages.section_of(x) for x in titles]
    assert [passages.section_of(x) for x in ("Patient results", "Figure 1", "Fig. 2", "Materials", None, "x")] == ["CASE", "FIG", "FIG", "METHODS", "OTHER", "OTHER"]
    pairs = itertools.combinations([w for _, words in P.SECTION_WORDS for w in words], 2)
    assert all(passages.section_of(f"{b} {a}") == passages.section_of(a) for a, b in pairs)
