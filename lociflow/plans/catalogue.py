"""Registered queries over the driver tables, each with SQL that says the same where SQL can.

The driver's texts hold no variant names, so articles are written from row keys with the
same ``concat`` in Spark and SQL; every query runs over its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lociflow.functions import alleles, genes, hgvs, spans, sql, text
from lociflow.functions import patterns as P
from lociflow.operators import index_table
from lociflow.operators import relational as R
from lociflow.operators import resolver
from lociflow.operators.tables import fresh_path
from lociflow.plans import delivery, gates, stages
from lociflow.plans.gates import Gate, apply_gates, review_gates
from lociflow.sources import catalogue_cache, indexed_fasta, readers, search, sinks
from lociflow.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts over all cores, for what costs far more than the scan: a small file is one split or a few."""
    return R.spread(t(spark, sf_dir, "part"))


#: One synthetic article per part: a discovery label, an rs name and a disease name each.
_LEADS = (
    "We identified a novel c.{k}A>G variant in GENE{s}",
    "The c.{k}A>G variant was previously reported in ClinVar in GENE{s}",
    "Smith et al. reported the c.{k}A>G variant in GENE{s}",
    "The c.{k}A>G variant is a known variant that expands the phenotypic spectrum in GENE{s}",
    "The c.{k}A>G variant of GENE{s} was studied",
)


def _article_sql(key: str = "p_partkey", size: str = "p_size", kind: str = "p_type") -> str:
    lead = "CASE {s} % 5 " + " ".join(f"WHEN {i} THEN concat('{x.split('{k}')[0]}', {key}, '{x.split('{k}')[1].split('{s}')[0]}', {size}, '{x.split('{s}')[1]}')" for i, x in enumerate(_LEADS)) + " END"
    return f"concat({lead.format(s=size)}, ' with ', {kind}, ' syndrome. It is also listed (rs', 100000 + {key}, ').')"


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).select(F.col("p_partkey").cast("string").alias("pmid"), F.col("p_partkey").alias("ord"), F.col("p_size").alias("size"), F.expr(_article_sql()).alias("text"), F.expr("concat('c.', p_partkey, 'A>G')").alias("variant"), F.expr("concat('GENE', p_size)").alias("gene"), F.col("p_type").alias("kind"))


_ARTICLES = f"(SELECT CAST(p_partkey AS VARCHAR) AS pmid, p_partkey AS ord, p_size AS size, {_article_sql()} AS text, concat('c.', p_partkey, 'A>G') AS variant, concat('GENE', p_size) AS gene, p_type AS kind FROM part)"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles to linked, labelled and gated variants, best row per locus."""
    rows = articles(spark, sf_dir)
    linked = stages.link_articles(rows.select("pmid", F.lit("").alias("title"), F.col("text").alias("abstract"), "ord"))
    found = stages.discover(linked).withColumn("row_id", F.struct("ord", "sentence_no"))
    return stages.review(found).select("pmid", "gene", "variant", "clinical", "tier", "discovery_label", "discovery_confidence", "locus_key", "review_tier")


@query(
    f"""SELECT pmid, gene, variant, kind || ' syndrome' AS clinical, 'A' AS tier, CASE size % 5 WHEN 0 THEN 'novel' WHEN 1 THEN 'previously_reported' ELSE 'citation_of_prior' END AS discovery_label, 'high' AS discovery_confidence,
 gene || '|' || lower(variant) AS locus_key, 'strict' AS review_tier FROM {_ARTICLES} WHERE size % 5 IN (0, 2)"""
)
def funnel_review(spark, sf_dir):
    """Flagship: span links, discovery label, gates, best per locus."""
    return flagship(spark, sf_dir)


# -- text and names --------------------------------------------------------------------
@query(f"SELECT pmid, regexp_extract(text, 'c\\.[0-9]+[ACGT]>[ACGT]') AS c, regexp_extract(text, 'rs[0-9]{{4,}}') AS rs FROM {_ARTICLES}")
def variant_components(spark, sf_dir):
    parts = hgvs.components(F.col("text"))
    return articles(spark, sf_dir).select("pmid", parts["c"].alias("c"), parts["rs"].alias("rs"))


@query(f"SELECT pmid, CAST(i AS INTEGER) AS i, trim(s) AS sentence FROM (SELECT pmid, unnest(string_split(x, chr(1))) AS s, unnest(range(0, len(string_split(x, chr(1))))) AS i FROM (SELECT pmid, regexp_replace(text, '([.!?])\\s+([A-Z0-9\"''(\\[])', '\\1' || chr(1) || '\\2', 'g') AS x FROM {_ARTICLES}))")
def sentence_split(spark, sf_dir):
    return articles(spark, sf_dir).select("pmid", F.posexplode(text.sentences(F.col("text"))).alias("i", "sentence"))


@query(
    f"""WITH c AS (SELECT pmid, regexp_matches(text, '(?i)\\bnovel\\b') AS n1, regexp_matches(text, '(?i)\\bwe\\s+identif') AS n2,
 regexp_matches(text, '(?i)\\bprevious(?:ly)?\\s+report|\\bknown\\s+variant\\b|\\bClinVar\\b') AS p, regexp_matches(text, '\\bet al\\. report') AS ci, regexp_matches(text, '(?i)\\bexpands the phenotypic spectrum') AS ex FROM {_ARTICLES})
SELECT pmid, CASE WHEN ex AND n1 THEN 'novel' WHEN n1 AND p THEN 'unclear' WHEN n1 AND NOT ci THEN 'novel' WHEN p AND ex THEN 'phenotype_expansion' WHEN p THEN 'previously_reported' WHEN ci THEN 'citation_of_prior' ELSE 'unclear' END AS discovery_label,
 CASE WHEN n1 AND NOT p AND NOT ci THEN 'high' WHEN p AND ex THEN 'medium' WHEN p OR ci THEN 'high' ELSE 'low' END AS discovery_confidence FROM c"""
)
def discovery_label(spark, sf_dir):
    return text.with_discovery(articles(spark, sf_dir)).select("pmid", "discovery_label", "discovery_confidence")


@query(
    f"""SELECT CASE size % 5 WHEN 0 THEN 'novel' WHEN 1 THEN 'previously_reported' WHEN 2 THEN 'citation_of_prior' WHEN 3 THEN 'phenotype_expansion' ELSE 'unclear' END AS discovery_label, count(*) AS n FROM {_ARTICLES} GROUP BY 1"""
)
def discovery_counts(spark, sf_dir):
    return text.with_discovery(articles(spark, sf_dir)).groupBy("discovery_label").agg(F.count("*").alias("n"))


_STRIPPED = "html"
for _pattern, _by in ((r"(?is)<script\b.*?</script\s*>", " "), (r"(?is)<style\b.*?</style\s*>", " "), (r"(?is)<noscript\b.*?</noscript\s*>", " "), (r"(?s)<!--.*?-->", " "), (r"(?i)<(?:br|/p|/div|/li|/h[1-6])\s*/?>", "\n"), (r"(?s)<[^>]+>", " "), (r"&nbsp;", " "), (r"[ \t]+", " "), (r"\s*\n\s*", "\n")):
    _STRIPPED = f"regexp_replace({_STRIPPED}, '{_pattern}', '{_by}', 'g')"


@query(f"SELECT page_id, trim({_STRIPPED}, ' ' || chr(9) || chr(10) || chr(13)) AS plain FROM pages")
def html_strip(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", text.html_to_text(F.col("html")).alias("plain"))


_KIND = "CASE " + " ".join(f"WHEN {' OR '.join(f"contains(lower(head), '{w}')" for w in words)} THEN '{kind}'" for kind, words in P.SECTION_WORDS) + " WHEN starts_with(lower(head), 'fig') THEN 'FIG' ELSE 'OTHER' END"


def _plain_sql(html: str) -> str:
    """Text of a piece of html, with the character references that the pages have."""
    decoded = f"replace(replace(replace(replace(regexp_replace({html}, '(?s)<[^>]+>', ' ', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"
    return f"trim(regexp_replace({decoded}, '{text.WHITE}', ' ', 'g'))"


@query(
    f"""WITH c AS (SELECT page_id, regexp_replace(html, '(?is)<(?:script|style|noscript)\\b.*?</(?:script|style|noscript)\\s*>|<!--.*?-->', '', 'g') AS h FROM pages),
a AS (SELECT page_id, regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1) AS t, regexp_extract(h, '(?is)<article[^>]*>(.*?)(?:</article>|$)', 1) AS b FROM c),
-- a piece begins at every start tag of a block and ends at its end tag
s AS (SELECT page_id, unnest(string_split(regexp_replace(b, '(?i)(<(?:p|h[1-4])[ >])', chr(1) || '\\1', 'g'), chr(1))) AS x, unnest(range(len(string_split(regexp_replace(b, '(?i)(<(?:p|h[1-4])[ >])', chr(1) || '\\1', 'g'), chr(1))))) AS i FROM a),
q AS (SELECT page_id, i, regexp_matches(x, '(?i)^<h') AS is_head, {_plain_sql("regexp_extract(x, '(?is)^(.*?)(?:</(?:p|h[1-4])>|$)', 1)")} AS text FROM s WHERE regexp_matches(x, '(?i)^<(?:p|h[1-4])[ >]')),
w AS (SELECT *, last_value(CASE WHEN is_head AND length(text) < 120 THEN text END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY i) AS head FROM q),
r AS (SELECT page_id, i, {_KIND} AS section_type, 'paragraph' AS passage_type, text, head AS section_title FROM w WHERE NOT is_head AND text <> ''
 UNION ALL SELECT page_id, -1, 'TITLE', 'title', {_plain_sql("t")}, NULL FROM a WHERE length({_plain_sql("t")}) > 5)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS idx, section_type, passage_type, text, section_title FROM r"""
)
def page_passages(spark, sf_dir):
    """Title and paragraphs of every page in page order, with the section and heading that they stand under."""
    return readers.html_passages(t(spark, sf_dir, "pages"), "html", "page_id")


@query(f"SELECT doc_id, CASE WHEN length(flat) > 700 THEN left(flat, 699) || '…' ELSE flat END AS clipped FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '{text.WHITE}', ' ', 'g')) AS flat FROM documents)")
def clipped_text(spark, sf_dir):
    """Every document clipped."""
    return t(spark, sf_dir, "documents").select("doc_id", text.clip(F.col("text")).alias("clipped"))


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y') || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '-' || strftime(o_orderdate, '%m') END AS date_key FROM orders"""
)
def pub_date_keys(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    month = F.when(F.col("o_orderkey") % 3 == 0, "unknown").when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "MMM")).otherwise(F.month("o_orderdate").cast("string"))
    return o.select("o_orderkey", text.pub_date_key(F.year("o_orderdate").cast("string"), month).alias("date_key"))


@query("SELECT p_partkey, trim(regexp_replace(lower(replace(concat(p_name, ' & ', p_brand), '&', ' and ')), '[^a-z0-9]+', ' ', 'g')) AS name_key FROM part")
def journal_name_key(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", text.normalize_name(F.concat("p_name", F.lit(" & "), "p_brand")).alias("name_key"))


@query(
    """SELECT p_partkey, CASE WHEN length(r) = 1 AND length(a) = 1 THEN 'snv' WHEN length(r) = length(a) THEN 'mnv' WHEN a = r || r THEN 'dup_tandem' WHEN length(a) < length(r) AND starts_with(r, a) THEN 'del_vcf'
 WHEN length(r) < length(a) AND starts_with(a, r) THEN 'ins_vcf' ELSE 'delins' END AS geometry FROM (SELECT p_partkey, substr('ACGTACGT', CAST(1 + p_partkey % 4 AS INTEGER), CAST(1 + p_size % 3 AS INTEGER)) AS r, substr('ACGTACGT', CAST(1 + p_size % 4 AS INTEGER), CAST(1 + p_partkey % 5 AS INTEGER)) AS a FROM part)"""
)
def allele_geometry(spark, sf_dir):
    p = t(spark, sf_dir, "part").select("p_partkey", F.expr("substring('ACGTACGT', int(1 + p_partkey % 4), int(1 + p_size % 3))").alias("r"), F.expr("substring('ACGTACGT', int(1 + p_size % 4), int(1 + p_partkey % 5))").alias("a"))
    return p.select("p_partkey", hgvs.geometry(F.col("r"), F.col("a")).alias("geometry"))


@query("SELECT p_partkey, 'chr' || CASE p_size WHEN 23 THEN 'X' WHEN 24 THEN 'Y' WHEN 25 THEN 'M' ELSE CAST(p_size AS VARCHAR) END AS chrom, p_partkey * 1000 AS pos FROM part WHERE p_size BETWEEN 1 AND 25")
def genomic_literal(spark, sf_dir):
    names = F.expr("concat('hg38 chr', case p_size when 23 then 'X' when 24 then 'Y' when 25 then 'M' else cast(p_size as string) end, ':', format_number(p_partkey * 1000, 0), ' A>G')")
    found = t(spark, sf_dir, "part").select("p_partkey", hgvs.literal_locus(names).alias("l")).where("l is not null and l.chrom is not null")
    return found.select("p_partkey", hgvs.chrom_ucsc(F.col("l.chrom")).alias("chrom"), F.col("l.pos").alias("pos"))


@query(
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'likely_pathogenic' WHEN 1 THEN 'conflicting' WHEN 2 THEN 'uncertain' ELSE 'not_evaluated' END AS label, CASE p_size % 4 WHEN 1 THEN 'medium' WHEN 3 THEN 'low' ELSE 'high' END AS confidence, 'variant' AS anchor_kind FROM part"""
)
def pathogenicity_label(spark, sf_dir):
    words = F.expr("concat('The variant c.', p_partkey, 'A>G was classified as ', case p_size % 4 when 0 then 'likely pathogenic' when 1 then 'pathogenic or benign' when 2 then 'a VUS' else 'interesting' end, '.')")
    rows = parts(spark, sf_dir).select("p_partkey", text.pathogenicity(words, F.lit("GENE"), F.expr("concat('c.', p_partkey, 'A>G')")).alias("v"))
    return rows.select("p_partkey", "v.label", "v.confidence", "v.anchor_kind")


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def content_hash(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


def _span_sql(kind: str, subtype: str, found: str, where: str = "true") -> str:
    return f"SELECT pmid, '{kind}' AS kind, '{subtype}' AS subtype, {found} AS text, CAST(strpos(text, {found}) - 1 AS INTEGER) AS start, CAST(strpos(text, {found}) - 1 + length({found}) AS INTEGER) AS \"end\", {found} AS norm FROM {_ARTICLES} WHERE {where}"


@query(" UNION ALL ".join([_span_sql("variant", "hgvs_c", "variant"), _span_sql("variant", "rsid", "('rs' || (100000 + ord))"), _span_sql("clinical", "syndrome_disease", "(kind || ' syndrome')"), _span_sql("clinical", "clinical_cue", "'phenotypic spectrum'", "size % 5 = 3")]))
def text_spans(spark, sf_dir):
    """All spans with offsets of every synthetic article."""
    return articles(spark, sf_dir).select("pmid", F.explode(spans.spans("text")).alias("s")).select("pmid", "s.*")


#: Texts with several kinds of names in another order each; spaces in a change, and a name that comes again.
_SCANNED = "CASE p_partkey % 3 WHEN 0 THEN concat('First RS', 100000 + p_partkey, ', then c.', p_partkey, 'A > G and p.Arg', p_partkey, 'Gln; again rs', 100000 + p_partkey, '.') WHEN 1 THEN concat('Both p.(Arg', p_partkey, 'Gln) and IVS', p_size, '+1G>A, with c.', p_partkey, 'del and rs', 100000 + p_partkey, '.') ELSE concat('A novel variant, p.R', p_partkey, 'Q, at NM_', 1000 + p_size, '.2:c.', p_partkey, 'A>G.') END"
_SCAN_PATTERNS = {k: P.VARIANTS[k] for k in P.CONCRETE}


@query(
    # every match of every pattern with its place: the texts before it, found by splitting at the match
    "WITH x AS (SELECT p_partkey AS id, " + _SCANNED + " AS text FROM part), m AS ("
    + " UNION ALL ".join(f"SELECT id, text, unnest(regexp_extract_all(text, '{p}')) AS v FROM x" for p in _SCAN_PATTERNS.values())
    + """), n AS (SELECT id, strpos(text, v) AS pl, length(v) AS n, regexp_replace(CASE WHEN regexp_matches(v, '(?i)^rs[0-9]+$') THEN lower(v) ELSE v END, '(?i)([ACGT])\\s*>\\s*([ACGT])', '\\1>\\2') AS v FROM m),
o AS (SELECT id, v, min(pl * 1000 + n) AS place FROM n GROUP BY id, v)
SELECT id, string_agg(v, '|' ORDER BY place) AS variants FROM o GROUP BY id"""
)
def scanned_variants(spark, sf_dir):
    """Concrete names of a text in the order of their places (TXT-14)."""
    found = parts(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.expr(_SCANNED).alias("text"))
    return found.select("id", F.array_join(spans.variants_scanned("text"), "|").alias("variants"))


@query(f"SELECT pmid, variant, CASE WHEN size % 5 IN (0, 2) THEN gene END AS gene FROM {_ARTICLES}")
def gene_binding(spark, sf_dir):
    rows = articles(spark, sf_dir).select("pmid", "variant", genes.gene_for("text", "variant", F.lit(None).cast("string")).alias("g"))
    return rows.select("pmid", "variant", F.col("g.gene").alias("gene"))


#: Per p_partkey % 10 a text ({v} the anchor, {w} another variant, {r} an rs name) and its hits (rule, label, role, confidence).
#: As in the reference, a loose token that keeps the full stop or parenthesis behind it is not the nearest variant and gives no row.
_NEGATIVE_CASES = (
    ("We studied {v}. The change was likely benign ({w}).", [("classify_paren", "likely_benign", "", "high"), ("window_classify_paren", "likely_benign", "", "medium")]),
    ("{w} was later reclassified as benign.", [("reclassified_lb", "benign", "", "high"), ("variant_then_label", "benign", "", "medium")]),
    ("It was classified as benign, namely {w}.", [("classify_then_nearby_var", "benign", "", "high")]),
    ("{w} in our second cohort was classified by two laboratories as benign.", [("were_classified_lb", "benign", "", "high")]),
    ("{w} was again seen and classified as VUS.", [("variant_then_vus", "uncertain", "", "high"), ("variant_then_label", "uncertain", "", "medium")]),
    ("{w} is a non-pathogenic change.", [("variant_then_label", "not_pathogenic", "", "medium")]),
    ("A benign polymorphism, {w}, was seen.", [("label_then_variant", "benign", "", "medium")]),
    ("{w} is benign beside {v}.", [("nearest_other_to_label", "benign", "", "low")]),
    ("As a negative control we used {w} beside {v}.", [("control_cue_with_variant", "benign", "control_variant", "medium")]),
    ("The site {r} may not be related to risk.", [("rs_null_association", "association_null", "association_null_site", "medium")]),
)
_NEGATIVE_NAMES = {"{v}": "', concat('c.', p_partkey, 'A>G'), '", "{w}": "', concat('c.', p_partkey + 1, 'C>T'), '", "{r}": "', concat('rs', 100000 + p_partkey), '"}


def _negative_text_sql() -> str:
    def case(x: str) -> str:
        for name, sql in _NEGATIVE_NAMES.items():
            x = x.replace(name, sql)
        return f"concat('{x}')"

    return "CASE p_partkey % 10 " + " ".join(f"WHEN {i} THEN {case(x)}" for i, (x, _) in enumerate(_NEGATIVE_CASES)) + " END"


_NEGATIVE_HITS = ", ".join(f"({i}, '{rule}', '{label}', '{role or 'same_paper_other_site'}', '{sure}')" for i, (_, hits) in enumerate(_NEGATIVE_CASES) for rule, label, role, sure in hits)


@query(f"SELECT p_partkey AS id, CASE k WHEN 9 THEN 'rs' || (100000 + p_partkey) ELSE 'c.' || (p_partkey + 1) || 'C>T' END AS variant, label, role, confidence, rule FROM part JOIN (VALUES {_NEGATIVE_HITS}) h(k, rule, label, role, confidence) ON k = p_partkey % 10")
def negative_evidence_rules(spark, sf_dir):
    """Rows of all ten rules, each on texts that trigger it."""
    found = spans.negatives(F.expr(_negative_text_sql()), F.expr("concat('c.', p_partkey, 'A>G')"))
    return parts(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.explode(found).alias("n")).select("id", "n.variant", "n.label", "n.role", "n.confidence", "n.rule")


# -- joins -----------------------------------------------------------------------------
@query("SELECT e.event_id, p.p_partkey FROM events e JOIN part p ON (e.user_id % 25) = (p.p_size % 25) AND e.event_id BETWEEN p.p_partkey * 7 AND p.p_partkey * 7 + 40")
def interval_overlap(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 25).alias("chrom"), F.col("event_id").alias("lo"), F.col("event_id").alias("hi"))
    p = t(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 25).cast("long").alias("chrom"), (F.col("p_partkey") * 7).alias("f_lo"), (F.col("p_partkey") * 7 + 40).alias("f_hi"))
    return R.interval_join(e, p, "chrom", ("lo", "hi"), ("f_lo", "f_hi"), 256).select("event_id", "p_partkey")


@query(
    """SELECT c_custkey, CASE WHEN n1.n_nationkey IS NOT NULL THEN 'key' WHEN n2.n_nationkey IS NOT NULL THEN 'name' ELSE 'default' END AS match_method, coalesce(n1.n_name, n2.n_name) AS n_name
 FROM customer LEFT JOIN nation n1 ON n1.n_nationkey = CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END LEFT JOIN nation n2 ON n2.n_nationkey = CASE WHEN c_custkey % 3 <> 2 THEN c_nationkey END"""
)
def alternative_keys(spark, sf_dir):
    c, n = t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation")
    keys = [("key", F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey"))), ("name", F.when(F.col("c_custkey") % 3 != 2, F.col("c_nationkey")))]
    return R.alternative_key_join(c.select("c_custkey", "c_nationkey"), keys, n, "n_nationkey", ["n_name"]).select("c_custkey", "match_method", "n_name")


@query(
    """WITH k AS (SELECT c_custkey, 1 AS step, c_nationkey AS key FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 2, c_custkey % 40 FROM customer),
h AS (SELECT c_custkey, step, min(s_suppkey) AS lo, max(s_suppkey) AS hi FROM k JOIN supplier ON s_nationkey = key GROUP BY ALL),
m AS (SELECT c_custkey, min(CASE WHEN lo = hi THEN step END) AS step, count(*) AS n FROM h GROUP BY c_custkey)
SELECT c.c_custkey, m.step AS match_step, h.lo AS match_value, CASE WHEN m.step IS NOT NULL THEN 'ok' WHEN m.n > 0 THEN 'ambiguous' ELSE 'missing' END AS match_status FROM customer c LEFT JOIN m USING (c_custkey) LEFT JOIN h ON h.c_custkey = c.c_custkey AND h.step = m.step"""
)
def lookup_ladder(spark, sf_dir):
    c, s = t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), t(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey")
    keys = F.filter(F.array(F.struct(F.lit(1).alias("step"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey").cast("long")).alias("key")), F.struct(F.lit(2).alias("step"), (F.col("c_custkey") % 40).alias("key"))), lambda x: x["key"].isNotNull())
    return R.ladder_lookup(c, "c_custkey", keys, s, "s_nationkey", "s_suppkey").drop("c_nationkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def anti_any_key(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    bad = t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("c"), "c_custkey").alias("k")).union(t(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.concat(F.lit("o"), "l_orderkey")))
    return R.anti_any_key(o, "o_orderkey", [F.concat(F.lit("c"), "o_custkey"), F.concat(F.lit("o"), "o_orderkey")], bad, "k").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def semi_filter(spark, sf_dir):
    return t(spark, sf_dir, "orders").join(t(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi").select("o_orderkey")


@query(
    """WITH a AS (SELECT l_orderkey, l_linenumber, l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 10 + l_linenumber) AS rn FROM lineitem), w AS (SELECT o_custkey % 100 + 1 AS k, count(*) AS n FROM orders GROUP BY 1)
SELECT l_orderkey, l_linenumber FROM a JOIN w ON l_suppkey = k AND rn <= n"""
)
def bag_semi_join(spark, sf_dir):
    a = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return R.bag_semi(a, t(spark, sf_dir, "orders").select((F.col("o_custkey") % 100 + 1).alias("k")), ["k"], "ord").select("l_orderkey", "l_linenumber")


@query("SELECT o.o_orderkey, l.l_linenumber FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE position(CAST(l.l_linenumber AS VARCHAR) IN CAST(o.o_custkey AS VARCHAR)) > 0")
def loose_match(spark, sf_dir):
    o, line = t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem")
    joined = o.join(line, o["o_orderkey"] == line["l_orderkey"])
    return joined.where(R.loose_token_match(F.col("o_custkey").cast("string"), F.col("l_linenumber").cast("string"))).select("o_orderkey", "l_linenumber")


@query("SELECT o.o_orderkey, (c.c_custkey IS NOT NULL AND c.seg = o.o_orderstatus) AS exact FROM orders o LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'O' ELSE 'F' END AS seg FROM customer) c ON c.c_custkey = o.o_custkey")
def gold_comparison(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 2 == 0, "O").otherwise("F").alias("o_orderstatus"), F.col("c_custkey").alias("ord"))
    return R.compare_with_gold(c, t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_custkey"], ["o_orderstatus"], "ord").select("o_orderkey", "exact")


_OVERLAY = """WITH r AS (SELECT p_partkey AS ord, 'id' || p_partkey AS audit_id, CASE WHEN p_partkey % 2 = 0 THEN 'positive' ELSE 'negative' END AS cls, p_size % 10 AS k FROM part),
n AS (SELECT p_partkey AS no, 'id' || p_partkey AS audit_id, CASE WHEN p_partkey % 3 = 0 THEN 'positive' ELSE 'other' END AS cls, p_size % 10 AS k, 'v' || p_partkey AS v FROM part WHERE p_partkey % 7 = 0),"""


@query(
    _OVERLAY
    + """ byid AS (SELECT r.ord, n.no, n.v FROM r JOIN n USING (audit_id)), free AS (SELECT * FROM (SELECT no, 'x' AS audit_id, cls, k, v FROM n WHERE false) UNION ALL SELECT p_partkey, 'x', CASE WHEN p_partkey % 3 = 0 THEN 'positive' ELSE 'other' END, p_size % 10, 'w' || p_partkey FROM part WHERE p_partkey % 11 = 0),
named AS (SELECT DISTINCT cls, k FROM (SELECT cls, k FROM n UNION ALL SELECT cls, k FROM free)),
w AS (SELECT r.*, named.k IS NOT NULL AS has FROM r LEFT JOIN named ON r.cls = named.cls AND r.k = named.k WHERE r.ord NOT IN (SELECT ord FROM byid)),
f1 AS (SELECT *, row_number() OVER (PARTITION BY cls, k ORDER BY no) AS rn FROM free), w1 AS (SELECT *, row_number() OVER (PARTITION BY cls, k ORDER BY ord) AS rn FROM w WHERE has),
m1 AS (SELECT w1.ord, f1.no, f1.v FROM w1 LEFT JOIN f1 ON w1.cls = f1.cls AND w1.k = f1.k AND w1.rn = f1.rn),
f2 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY no) AS rn FROM free WHERE no NOT IN (SELECT no FROM m1 WHERE no IS NOT NULL)), w2 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ord) AS rn FROM w WHERE NOT has),
m2 AS (SELECT w2.ord, f2.v FROM w2 LEFT JOIN f2 ON w2.k = f2.k AND w2.rn = f2.rn)
SELECT ord, v FROM byid UNION ALL SELECT ord, v FROM m1 UNION ALL SELECT ord, v FROM m2"""
)
def annotation_overlay(spark, sf_dir):
    """Notes by id, then one each by class and key, then by key alone."""
    p = t(spark, sf_dir, "part")
    rows = p.select(F.col("p_partkey").alias("ord"), F.expr("concat('id', p_partkey)").alias("audit_id"), F.expr("if(p_partkey % 2 = 0, 'positive', 'negative')").alias("cls"), F.expr("p_size % 10").alias("k"))
    note = lambda d, name, v: p.where(f"p_partkey % {d} = 0").select(F.expr(f"p_partkey * 2 + {int(d == 11)}").alias("no"), F.expr(name).alias("audit_id"), F.expr("if(p_partkey % 3 = 0, 'positive', 'other')").alias("cls"), F.expr("p_size % 10").alias("k"), F.expr(f"concat('{v}', p_partkey)").alias("v"))
    notes = note(7, "concat('id', p_partkey)", "v").unionByName(note(11, "'x'", "w"))
    return R.overlay(rows, notes, "audit_id", ["k"], "cls", ["v"], "ord", "no").select("ord", "v")


# -- aggregation, order, windows -------------------------------------------------------
@query("SELECT * EXCLUDE (rn) FROM (SELECT l_partkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END, CAST(-l_quantity AS BIGINT), l_orderkey * 10 + l_linenumber) AS rn FROM lineitem) WHERE rn = 1")
def best_per_locus(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    rank = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return R.best_per_key(rows, ["l_partkey"], [rank, (-F.col("l_quantity")).cast("long")], "ord").select("l_partkey", "l_orderkey", "l_linenumber")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_annotation(spark, sf_dir):
    return R.latest_by(t(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts", "event_id").select("user_id", "event_id")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS BIGINT) AS level FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (l_returnflag, l_linestatus), ())")
def report_counts(spark, sf_dir):
    t(spark, sf_dir, "lineitem").createOrReplaceTempView("lociflow_lineitem")
    return spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping_id(l_returnflag, l_linestatus) AS level FROM lociflow_lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (l_returnflag, l_linestatus), ())")


@query("SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS n_priorities FROM orders GROUP BY o_custkey")
def count_distinct_per_group(spark, sf_dir):
    return t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.countDistinct("o_orderpriority").alias("n_priorities"))


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, min(l_orderkey * 10 + l_linenumber) LIMIT 30")
def top_journals(spark, sf_dir):
    g = t(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))
    return g.orderBy(F.desc("n"), "o").limit(30).select("l_partkey", "n")


@query("SELECT o_orderkey, strftime(min(o_orderdate) OVER (PARTITION BY o_custkey), '%Y-%m') AS first_date, strftime(o_orderdate, '%Y-%m') = strftime(min(o_orderdate) OVER (PARTITION BY o_custkey), '%Y-%m') AS is_first FROM orders")
def first_in_corpus(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("d"))
    return R.first_in_group(o, "o_custkey", "d").select("o_orderkey", "first_date", "is_first")


@query(
    """WITH k AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, CAST(l_quantity AS BIGINT) ORDER BY CASE l_returnflag WHEN 'A' THEN 0 ELSE 1 END, o) AS rn, min(o) OVER (PARTITION BY l_suppkey, CAST(l_quantity AS BIGINT)) AS place FROM (SELECT *, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS o FROM lineitem)),
d AS (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS q, substr(string_agg(CAST(l_partkey AS VARCHAR), ';' ORDER BY o), 1, 500) AS dropped FROM k WHERE rn > 1 GROUP BY ALL)
SELECT k.o AS ord, k.place, coalesce(d.dropped, '') AS dropped_keys FROM k LEFT JOIN d ON d.l_suppkey = k.l_suppkey AND d.q = CAST(k.l_quantity AS BIGINT) WHERE rn = 1"""
)
def allele_dedup(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("long").alias("q"), "l_partkey", "l_returnflag", ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias("ord"))
    return R.dedup_alleles(rows, ["l_suppkey", "q"], [F.when(F.col("l_returnflag") == "A", 0).otherwise(1)], "ord", "l_partkey").select("ord", "place", "dropped_keys")


@query(
    """WITH m AS (SELECT l_suppkey, max(l_quantity) AS a, max(l_linenumber) AS b FROM lineitem GROUP BY l_suppkey), x AS (SELECT l.l_suppkey, list_distinct(list(l_partkey) FILTER (WHERE l_quantity = a)) AS s, list_distinct(list(l_partkey) FILTER (WHERE l_linenumber = b)) AS u FROM lineitem l JOIN m ON l.l_suppkey = m.l_suppkey GROUP BY l.l_suppkey)
SELECT l_suppkey, CASE WHEN len(s) = 1 THEN s[1] WHEN len(u) = 1 THEN u[1] END AS l_partkey FROM x"""
)
def unique_argmax(spark, sf_dir):
    return R.unique_argmax(t(spark, sf_dir, "lineitem"), ["l_suppkey"], [F.col("l_quantity"), F.col("l_linenumber")], "l_partkey")


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS last_user FROM conversations")
def section_carry_forward(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").withColumn("u", F.when(F.col("role") == "user", F.col("text")))
    return R.carry_forward(c, ["conv_id"], "turn", "u", "last_user").select("conv_id", "turn", "last_user")


@query("SELECT conv_id, turn, string_agg(text, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM conversations")
def neighbour_window(spark, sf_dir):
    return R.neighbours(t(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", 2, "near").select("conv_id", "turn", "near")


@query("SELECT conv_id, turn, text || ' ' || lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS pair FROM conversations")
def sentence_pairs(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return t(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat("text", F.lit(" "), F.lead("text").over(w)).alias("pair"))


@query("SELECT conv_id, turn, role || '_' || conv_id || '_' || CASE WHEN i < 1000 THEN lpad(CAST(i AS VARCHAR), 4, '0') ELSE CAST(i AS VARCHAR) END AS audit_id FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS i FROM conversations)")
def audit_ids(spark, sf_dir):
    """Numbered over all rows of the run."""
    c = t(spark, sf_dir, "conversations").select("role", "conv_id", "turn", (F.col("conv_id") * 100_000 + F.col("turn")).alias("ord"))
    return R.audit_ids(c, ["role", "conv_id"], "ord").select("conv_id", "turn", "audit_id")


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS body, count(*) AS n_turns FROM conversations GROUP BY conv_id")
def literature_blob(spark, sf_dir):
    m = R.multimap(t(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn")
    return m.select("conv_id", F.array_join(F.transform("rows", lambda r: r["text"]), " ").alias("body"), F.size("rows").cast("long").alias("n_turns"))


# -- sets, merges, gates ---------------------------------------------------------------
@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 4 <> 0 UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 4 = 0")
def replace_by_key(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return R.replace_by_key(o, o.where("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("new")), "o_orderkey")


@query("SELECT o_custkey % 50 AS k FROM orders INTERSECT ALL SELECT l_suppkey % 50 FROM lineitem")
def bag_intersection(spark, sf_dir):
    return t(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("k")).intersectAll(t(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 50).alias("k")))


@query("SELECT l_orderkey, l_linenumber, (l_quantity > 10) AS gate_quantity, (l_returnflag <> 'R') AS gate_flag FROM lineitem WHERE l_quantity > 10")
def gate_compiler(spark, sf_dir):
    compiled = [Gate("quantity", F.col("l_quantity") > 10), Gate("flag", F.col("l_returnflag") != "R", "audit_only"), Gate("tax", F.col("l_tax") > 1, "disabled")]
    return apply_gates(t(spark, sf_dir, "lineitem"), compiled).select("l_orderkey", "l_linenumber", "gate_quantity", "gate_flag")


#: Clinical texts by p_partkey: names, bare heads, filler, inheritance, several parts.
_CLINICAL_CASES = ("concat({k}, ' syndrome')", "'syndrome'", "'a severe autosomal recessive disorder'", "'syndromic forms'", "concat('disorder; ', {k}, ' disease')", "'Familial X-linked disease; phenotype'", "' ; '", "'obesity'", "concat('congenital ', {k}, '-', {k}, ' dystrophy type 2')")


def _clinical_sql(key: str, kind: str) -> str:
    return f"CASE {key} % {len(_CLINICAL_CASES)} " + " ".join(f"WHEN {i} THEN {x.replace('{k}', kind)}" for i, x in enumerate(_CLINICAL_CASES)) + " END"


def _generic_sql(clinical: str) -> str:
    """Whether no part of a clinical text names anything, worked out on lists of words."""
    listed = lambda *tables: "[" + ", ".join(f"'{w}'" for w in sorted(set().union(*tables))) + "]"
    parts = f"list_transform(string_split({clinical}, ';'), lambda p: list_filter(string_split(regexp_replace(lower(trim(p)), '{P.CLINICAL_SEPARATOR}', ' ', 'g'), ' '), lambda w: w <> ''))"
    inside = lambda words, table: f"len(list_filter({words}, lambda w: NOT list_contains({table}, w))) = 0"
    nothing = (
        f"CASE WHEN len(p) > 1 THEN (p[1] = 'syndromic' AND {inside('p[2:]', listed(P.SYNDROMIC_WEAK))}) OR {inside('p', listed(P.CLINICAL_STOP, P.GENERIC_CLINICAL, P.INHERITANCE_ONLY))} "
        f"ELSE {inside('p', listed(P.GENERIC_CLINICAL))} END"
    )
    return f"len(list_filter({parts}, lambda p: NOT ({nothing}))) = 0"


@query(
    f"""SELECT gene || '|' || lower(v) AS locus_key, pmid FROM (SELECT gene, variant AS v, pmid, row_number() OVER (PARTITION BY gene, lower(variant) ORDER BY ord) AS rn FROM {_ARTICLES} WHERE size % 5 IN (0, 1, 2) AND NOT ({_generic_sql(_clinical_sql("ord", "kind"))})) WHERE rn = 1"""
)
def review_gate_best(spark, sf_dir):
    rows = text.with_discovery(articles(spark, sf_dir)).withColumn("clinical", F.expr(_clinical_sql("ord", "kind"))).withColumns({"method": F.lit("same_sentence_cooccurrence"), "clinical_source": F.lit("lexicon_entity"), "gene_source": F.lit("row_gene"), "tier": F.lit("A"), "evidence_source": F.lit("abstract"), "evidence_sentence": F.col("text")})
    return stages.review(rows, ("A",), "ord").select("locus_key", "pmid")


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id")
def empty_short_circuit(spark, sf_dir):
    """A stage whose gates pass nothing leaves the rows that it would have replaced or dropped."""
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    nothing = apply_gates(c, [Gate("none", F.col("turn") < 0)]).select("conv_id", "turn", "role")
    kept = R.anti_any_key(R.replace_by_key(c, nothing, "conv_id"), "conv_id", [F.col("conv_id")], nothing, "conv_id")
    return kept.groupBy("conv_id").agg(F.count("*").alias("n"))


@query(
    """WITH r AS (SELECT o_orderkey AS row_id, '1' AS chrom, o_orderkey * 3 % 1000000 + 1 AS pos, 'A' AS ref FROM orders), g AS (SELECT p_partkey * 500 AS s, 'G' || p_partkey AS gene, p_size % 3 = 0 AS nc FROM part)
SELECT r.*, CASE WHEN gene IS NULL THEN 'intergenic' WHEN NOT nc AND pos - s BETWEEN 80 AND 150 THEN 'coding' WHEN pos - s BETWEEN 50 AND 200 THEN CASE WHEN nc THEN 'ncrna_exon' ELSE 'utr' END WHEN nc THEN 'ncrna_gene' ELSE 'intron' END AS genomic_region,
 coalesce(gene, '') AS genomic_region_genes, CASE WHEN gene IS NULL THEN '' WHEN NOT nc AND pos - s BETWEEN 80 AND 150 THEN 'CDS' WHEN pos - s BETWEEN 50 AND 200 THEN 'exon' ELSE 'gene' END AS genomic_region_feature, '' AS genomic_region_transcripts, '' AS genomic_region_note
FROM r LEFT JOIN g ON pos BETWEEN s AND s + 400"""
)
def region_annotation(spark, sf_dir):
    """Genomic region by interval joins: orders as loci, parts as genes with exons and coding parts."""
    p = t(spark, sf_dir, "part").select(F.lit("1").alias("chrom"), (F.col("p_partkey") * 500).alias("s"), F.expr("concat('G', p_partkey)").alias("gene"), F.when(F.col("p_size") % 3 == 0, "lncRNA").otherwise("protein_coding").alias("biotype"))
    part = lambda kind, lo, hi: p.select("chrom", F.lit(kind).alias("type"), (F.col("s") + lo).alias("start"), (F.col("s") + hi).alias("end"), "gene", "biotype")
    features = part("gene", 0, 400).unionByName(part("exon", 50, 200)).unionByName(part("cds", 80, 150).where("biotype = 'protein_coding'"))
    rows = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.lit("1").alias("chrom"), (F.col("o_orderkey") * 3 % 1_000_000 + 1).alias("pos"), F.lit("A").alias("ref"))
    return stages.region_of(rows, features)


@query(f"SELECT pmid, CASE WHEN size % 5 < 3 THEN '' ELSE 'confidence,' END || 'clinical_source,' || CASE WHEN {_generic_sql(_clinical_sql('ord', 'kind'))} THEN 'clinical_text,' ELSE '' END || 'tier' AS gate_failed FROM {_ARTICLES}")
def gate_audit(spark, sf_dir):
    """All gates annotated, nothing dropped."""
    rows = text.with_discovery(articles(spark, sf_dir)).withColumn("clinical", F.expr(_clinical_sql("ord", "kind"))).withColumns({"method": F.lit("same_abstract_cooccurrence"), "clinical_source": F.lit("lexicon_cue"), "gene_source": F.lit("row_gene"), "tier": F.lit("B")})
    return apply_gates(rows, review_gates(), "audit").select("pmid", F.array_join("gate_failed", ",").alias("gate_failed"))




# -- genes, alleles, loci --------------------------------------------------------------
_K = "p_partkey"


def _case(values: tuple[str, ...], by: str) -> str:
    return f"CASE {by} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query(f"SELECT {_K}, concat('p.arg', {_K}, 'gln,p.arg', {_K}, 'q,p.r', {_K}, 'gln,p.r', {_K}, 'q') AS keys FROM part WHERE {_K} % 2 = 0 UNION ALL SELECT {_K}, concat('p.p', {_K}, '=,p.p', {_K}, 'p,p.p', {_K}, 'pro,p.pro', {_K}, '=,p.pro', {_K}, 'p,p.pro', {_K}, 'pro') FROM part WHERE {_K} % 2 = 1")
def protein_spellings(spark, sf_dir):
    """Lookup keys of changed and of silent residues (HGV-05), in the order of their letters."""
    name = F.expr(f"if({_K} % 2 = 0, concat('p.(Arg', {_K}, 'Gln)'), concat('p.P', {_K}, '='))")
    keys = alleles.protein_key_list(name)
    return parts(spark, sf_dir).select(_K, F.array_join(F.array_sort(keys), ",").alias("keys"))


_GENE_TEXTS = ("concat('In BRCA', {k}, ' c.{k}A>G was seen.')", "concat('We saw c.{k}A>G (p.Arg5Gln) in BRCA', {k}, '.')", "concat('A change, c.{k}A>G, was found. The gene was named BRCA', {k}, '.')", "concat('We saw c.{k}A>G here. The BRCA', {k}, ' mutation is rare.')", "concat('We saw c.{k}A>G, located in the BRCA', {k}, ' locus.')", "'We saw c.{k}A>G alone.'")
_GENE_RULES = ("adjacent", "adjacent", "naming_cue", "neighbour", "locus_phrase", "none")


def _named(texts: tuple[str, ...]) -> str:
    return _case(tuple(x.replace("c.{k}A", f"c.', {_K}, 'A").replace("{k}", _K) if x.startswith("concat") else "concat(" + x.replace("{k}", f"', {_K}, '") + ")" for x in texts), _K)


@query(f"SELECT {_K}, CASE WHEN {_K} % 6 < 5 THEN 'BRCA' || {_K} END AS gene, {_case(tuple(repr(r) for r in _GENE_RULES), _K)} AS rule FROM part")
def gene_ladder(spark, sf_dir):
    """Every step of the gene ladder, with the rule that found the symbol (GEN-02 to GEN-08)."""
    rows = parts(spark, sf_dir).select(_K, genes.gene_for(F.expr(_named(_GENE_TEXTS)), F.expr(f"concat('c.', {_K}, 'A>G')"), F.lit(None).cast("string")).alias("g"))
    return rows.select(_K, "g.gene", "g.rule")


@query(f"SELECT {_K}, 'BRCA' || {_K} AS gene, CASE WHEN {_K} % 2 = 0 THEN 'gene corrected from literature adjacency: OLD' || {_K} || '→BRCA' || {_K} END AS note FROM part")
def gene_correction(spark, sf_dir):
    """The gene beside the variant overrides the corpus gene, with a note (GEN-10)."""
    null = F.lit(None).cast("string")
    given = F.expr(f"concat(if({_K} % 2 = 0, 'OLD', 'BRCA'), {_K})")
    run = genes.gene_correction()
    return parts(spark, sf_dir).select(_K, run(given, F.expr(f"concat('c.', {_K}, 'A>G')"), F.expr(f"concat('We saw BRCA', {_K}, ' c.', {_K}, 'A>G.')"), null, null, null, null).alias("g")).select(_K, "g.gene", "g.note")


_VARIANTS = ("concat('c.', {k}, 'A>G')", "concat('rs', 100000 + {k})", "concat('NM_', {k}, '.2:c.', {k}, 'A>G')", "concat('c.', {k}, 'C>T')", "concat('GRCh38 chr7:', 5000 + {k}, ' A>G')", "concat('chr7:', 50000 + {k})")


@query(
    f"""SELECT {_K}, CASE k WHEN 3 THEN NULL WHEN 4 THEN '7' WHEN 5 THEN '7' ELSE CAST(p_size % 22 + 1 AS VARCHAR) END AS chrom, CASE k WHEN 3 THEN NULL WHEN 4 THEN 5000 + {_K} WHEN 5 THEN NULL ELSE 1000 + {_K} END AS pos,
 CASE k WHEN 3 THEN 'C' WHEN 5 THEN '' ELSE 'A' END AS ref, CASE k WHEN 3 THEN 'T' WHEN 5 THEN '' ELSE 'G' END AS alt,
 {_case(("'gene_c_clinvar'", "'rs_clinvar'", "'nm_c_clinvar'", "'c_hgvs_alleles_only'", "'literal_genomic_chrpos_change'", "'literal_genomic_chrpos'"), _K)} AS method, {_case(("'ok'", "'ok'", "'ok'", "'partial'", "'ok'", "'partial'"), _K)} AS status,
 {_case(("'high'", "'high'", "'high'", "'low'", "'high'", "'low'"), _K)} AS confidence, {_case(("'clinvar_preferred_transcript'", "'clinvar_preferred_transcript'", "'exact_nm_version'", "'none'", "'not_applicable'", "'not_applicable'"), _K)} AS match FROM (SELECT *, {_K} % 6 AS k FROM part)"""
)
def resolver_ladder(spark, sf_dir):
    """Variants to alleles by rs name, transcript, gene, literal name, and what is left when the reference disagrees (HGV-23, JN-03, JN-04)."""
    p = parts(spark, sf_dir)
    rows = p.select(F.col(_K).alias("row_id"), F.expr(_case(tuple(v.replace("{k}", _K) for v in _VARIANTS), _K)).alias("variant"), F.expr("concat('GENE', p_size)").alias("gene"), F.lit("").alias("evidence"), F.lit(None).cast("string").alias("cached_text"))
    row = lambda assembly, pos, ref, alt: p.select(F.lit(assembly).alias("assembly"), F.expr("cast(p_size % 22 + 1 as string)").alias("chrom"), F.expr(pos).alias("pos"), F.lit(ref).alias("ref"), F.lit(alt).alias("alt"), F.expr("concat('GENE', p_size)").alias("gene"), F.expr(f"concat('NM_', {_K})").alias("nm"), F.lit("2").alias("nm_version"), F.expr(f"concat('c.', {_K}, '{ref}>{alt}')").alias("c"), F.lit(None).cast("string").alias("p"), F.expr(f"concat('rs', 100000 + {_K})").alias("rs") if ref == "A" else F.lit(None).cast("string").alias("rs"))
    table = row("GRCh38", f"1000 + {_K}", "A", "G").unionByName(row("GRCh37", f"900 + {_K}", "A", "G"))
    table = table.unionByName(row("GRCh38", f"2000 + {_K}", "C", "T")).unionByName(row("GRCh38", f"3000 + {_K}", "C", "T"))
    path = fresh_path(spark, "index")
    index_table.write_index(resolver.reference_index(table), path, buckets=8)  # written once, joined where it lies
    out = resolver.resolve(rows, index_table.read_index(spark, path))
    return out.select(F.col("row_id").alias(_K), "resolved.chrom", "resolved.pos", "resolved.ref", "resolved.alt", "resolved.method", "resolved.status", "resolved.confidence", "resolved.match")


@query(
    f"""SELECT {_K}, CASE k WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL_REF' WHEN 2 THEN 'SKIP_EMPTY' WHEN 3 THEN 'FAIL_SYNTAX' WHEN 4 THEN 'PASS' WHEN 5 THEN 'PASS_WARN' ELSE 'FAIL_COORD' END AS check_status,
 CASE k WHEN 0 THEN 'snv,fasta_ref_match' WHEN 1 THEN 'fasta_ref_mismatch' WHEN 2 THEN 'missing_chrom_or_pos_or_ref' WHEN 3 THEN 'ref_equals_alt' WHEN 4 THEN 'del_vcf,fasta_ref_match' WHEN 5 THEN 'delins,delins_no_shared_prefix,fasta_ref_match' ELSE 'ref_span_past_contig_end' END AS checks FROM (SELECT *, {_K} % 7 AS k FROM part)"""
)
def allele_checks(spark, sf_dir):
    """Export rows against a sequence of repeated ACGT (HGV-25, HGV-26)."""
    p = t(spark, sf_dir, "part")
    pos = f"({_K} % 1000) * 4 + 1"
    rows = p.select(_K, F.expr(f"if({_K} % 7 = 2, '', 'chr1')").alias("chromosome_ucsc"), F.expr(f"cast(if({_K} % 7 = 6, 9999999, {pos}) as string)").alias("position"), F.expr(_case(("'A'", "'G'", "'A'", "'A'", "'ACG'", "'AC'", "'A'"), _K)).alias("ref"), F.expr(_case(("'G'", "'T'", "'G'", "'A'", "'A'", "'TTT'", "'G'"), _K)).alias("alt"))
    sequence = spark.range(2).select(F.lit("1").alias("chrom"), F.col("id").cast("int").alias("chunk_no"), F.repeat(F.lit("ACGT"), F.lit(readers.CHUNK // 4)).alias("seq"))
    return delivery.check_alleles(rows, sequence, _K).select(_K, "check_status", "checks")


_TIER = (("likely benign", "classify_paren", "A", "same_sentence_classify_or_control:classify_paren"), ("not associated", "window_rs_null_association", "B", "same_sentence_or_window_association:window_rs_null_association"), ("interesting", "classify_paren", "B", "partial_variant_or_cue_only"), ("benign", "other_rule", "A", "same_sentence_variant_and_neg_cue:other_rule"))


@query(f"SELECT {_K}, {_case(tuple(repr(x[2]) for x in _TIER), _K)} AS tier, {_case(tuple(repr(x[3]) for x in _TIER), _K)} AS reason FROM part")
def negative_tiers(spark, sf_dir):
    """Link tier of negative alleles by rule and evidence (CLS-05)."""
    words = F.expr(f"concat('The c.', {_K}, 'A>G change was ', {_case(tuple(repr(x[0]) for x in _TIER), _K)}, '.')")
    tier = text.negative_link_tier(F.lit(None).cast("string"), F.expr(f"concat('c.', {_K}, 'A>G')"), words, F.expr(_case(tuple(repr(x[1]) for x in _TIER), _K)))
    return t(spark, sf_dir, "part").select(_K, tier.alias("t")).select(_K, "t.tier", "t.reason")


@query(f"SELECT {_K}, CASE {_K} % 4 WHEN 0 THEN 'abstract' WHEN 1 THEN 'fulltext' WHEN 2 THEN 'fulltext' ELSE 'abstract' END AS evidence_source, CASE {_K} % 4 WHEN 0 THEN '[abstract] ' || p_name WHEN 3 THEN '[abstract] ' || p_name ELSE p_name END AS text, {_case(("'A'", "'C'", "'B'"), _K)} AS grade FROM part")
def stamped_rows(spark, sf_dir):
    """Source and mark of evidence (FIL-14), and the screen grade with its fallback (CLS-06)."""
    p = t(spark, sf_dir, "part").select(_K, F.col("p_name").alias("text"), F.expr(f"case {_K} % 4 when 0 then 'abstract' when 1 then 'fulltext' end").alias("evidence_source"), F.expr(f"if({_K} % 4 = 2, 'RESULTS', null)").alias("section"), F.expr(_case(("'a'", "'WATCH'", "null"), _K)).alias("tier"), F.expr(_case(("'C'", "'x'", "'b'"), _K)).alias("again"))
    return delivery.stamp(p).select(_K, "evidence_source", "text", text.screen_grade(F.col("tier"), F.col("again")).alias("grade"))


@query(f"SELECT pmid, variant, kind || ' syndrome' AS clinical, 'A' AS tier, 'fulltext_same_sentence_cooccurrence' AS method, CASE WHEN size % 5 IN (0, 2) THEN gene END AS gene, true AS in_fulltext FROM {_ARTICLES} UNION ALL SELECT pmid, 'rs' || (100000 + ord), kind || ' syndrome', 'B', 'fulltext_known_variant_sentence', NULL, true FROM {_ARTICLES}")
def full_text_links(spark, sf_dir):
    """Passages to links: sentence links, sentences of known variants, clinical text out of the title, genes (TXT-11 to TXT-15, AGG-10)."""
    rows = articles(spark, sf_dir)
    passages = rows.select("pmid", F.lit(0).alias("idx"), F.lit("RESULTS").alias("section_type"), F.lit("paragraph").alias("passage_type"), F.replace("text", F.lit("It is also listed (rs"), F.lit("It is also listed as one of many in the catalogues of this year (rs")).alias("text"))
    heads = rows.select("pmid", F.lit("A case of ataxia").alias("title"), F.lit("").alias("abstract"), F.lit(None).cast("string").alias("pubtator"))
    return stages.link_full_text(passages, heads).select("pmid", "variant", "clinical", "tier", "method", "gene", F.col("variant_discovered_in_fulltext").alias("in_fulltext"))


# -- links, reports, searches ----------------------------------------------------------
@query("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag, l_suppkey ORDER BY l_orderkey * 10 + l_linenumber) AS rn FROM lineitem) WHERE rn = 1")
def link_dedup(spark, sf_dir):
    """First link per variant and evidence prefix (AGG-10)."""
    rows = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("variant"), F.concat(F.lpad(F.col("l_suppkey").cast("string"), 240, "0"), F.col("l_orderkey").cast("string")).alias("evidence_sentence"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return R.dedup_links(rows, "ord").select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, 'abstract' AS evidence_source FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority, o_orderstatus ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderkey % 2 = 0) WHERE rn = 1 UNION ALL SELECT o_orderkey, 'fulltext' FROM orders WHERE o_orderkey % 2 = 1")
def merged_pairs(spark, sf_dir):
    """Abstract pairs once, full-text pairs all (AGG-11, SET-01)."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("pmid"), F.col("o_orderpriority").alias("variant"), F.col("o_orderstatus").alias("clinical"))
    return R.merged_pairs(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), "o_orderkey").select("o_orderkey", "evidence_source")


@query("SELECT conv_id, string_agg(role || '=' || n, ',' ORDER BY role) AS counts FROM (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY ALL) GROUP BY conv_id")
def section_histogram(spark, sf_dir):
    h = R.histogram(t(spark, sf_dir, "conversations"), "conv_id", "role", "h")
    return h.select("conv_id", F.array_join(F.transform(F.map_entries("h"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


@query("SELECT CAST(count(*) FILTER (WHERE b IS NULL) AS BIGINT) AS only_first, CAST(count(*) FILTER (WHERE a IS NULL) AS BIGINT) AS only_second, CAST(count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS BIGINT) AS both FROM (SELECT DISTINCT c_custkey AS a FROM customer WHERE c_custkey % 2 = 0) x FULL JOIN (SELECT DISTINCT o_custkey AS b FROM orders) y ON a = b")
def overlap_counts(spark, sf_dir):
    return R.overlap_counts(t(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")), t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


@query(
    """WITH g AS (SELECT o_orderkey, o_custkey, o_orderstatus, nullif(o_orderpriority, '1-URGENT') AS x FROM orders), w AS (SELECT * FROM g WHERE x IS NOT NULL)
SELECT (SELECT count(*) FROM g) AS gold_rows, (SELECT count(*) FROM customer) AS candidate_rows, (SELECT count(*) FROM w) AS gold_with_4col, count(*) FILTER (WHERE seg = o_orderstatus) AS genomic_exact_match,
 round(count(*) FILTER (WHERE seg = o_orderstatus) / (SELECT count(*) FROM w), 4) AS genomic_match_rate FROM w LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'O' ELSE 'F' END AS seg FROM customer) c ON c_custkey = o_custkey"""
)
def gold_report(spark, sf_dir):
    """Counts and rate of exact matches (JN-12)."""
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, "O").otherwise("F").alias("s"), F.lit("x").alias("x"), F.col("c_custkey").alias("ord"))
    gold = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"), F.when(F.col("o_orderpriority") != "1-URGENT", "x").alias("x"))
    return R.gold_report(c, gold, ["k"], ["s", "x"], "ord")


@query("SELECT o_orderkey, coalesce(c_mktsegment, 'positive_candidate') AS label FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 3 = 0 AND o_orderstatus = 'O'")
def sidecar_labels(spark, sf_dir):
    """A label from a side table, else the default (JN-13)."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("pmid"), F.col("o_orderstatus").alias("variant"))
    notes = t(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("pmid"), F.lit("o").alias("variant"), F.col("c_mktsegment").alias("v"), F.col("c_custkey").alias("ord"))
    return R.sidecar(o, notes, "v", "positive_candidate", "label").select("o_orderkey", "label")


@query(r"SELECT doc_id, CASE WHEN q1 AND q2 THEN 'q1,q2' WHEN q1 THEN 'q1' ELSE 'q2' END AS hits, CASE WHEN q1 AND q2 THEN '' WHEN q1 THEN 'q2' ELSE 'q1' END AS missed FROM (SELECT doc_id, regexp_matches(text, '(?i)\bthe\b') AND (regexp_matches(text, '(?i)\bof\b') OR regexp_matches(text, '(?i)\bwith\b')) AS q1, regexp_matches(text, '(?i)\blicen\w*') AND NOT regexp_matches(text, '(?i)\bwas\b') AS q2 FROM documents WHERE text IS NOT NULL) WHERE q1 OR q2")
def query_hits(spark, sf_dir):
    """Boolean queries over whole texts, with the queries that missed (SRC-10, SET-06)."""
    queries = {"q1": 'the[Title/Abstract] AND ("of"[Title/Abstract] OR with)', "q2": "licen* NOT was"}
    found = search.with_query_hits(t(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text"), queries, {"title/abstract": F.col("text")}, F.col("text"))
    return found.select("doc_id", F.array_join("source_query_ids", ",").alias("hits"), F.array_join("missed_query_ids", ",").alias("missed"))


@query("SELECT l_orderkey, l_linenumber, distance FROM (SELECT l_orderkey, l_linenumber, greatest(20 - CAST(l_quantity AS BIGINT) - 2, CAST(l_quantity AS BIGINT) - 24, 0) AS distance, row_number() OVER (PARTITION BY l_orderkey ORDER BY greatest(20 - CAST(l_quantity AS BIGINT) - 2, CAST(l_quantity AS BIGINT) - 24, 0), l_linenumber) AS rn FROM lineitem WHERE greatest(20 - CAST(l_quantity AS BIGINT) - 2, CAST(l_quantity AS BIGINT) - 24, 0) <= 10) WHERE rn = 1")
def nearest_span(spark, sf_dir):
    """The span nearest to an anchor within a bound (WIN-06)."""
    rows = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("lo"), (F.col("l_quantity").cast("long") + 2).alias("hi"))
    return R.nearest(rows, ["l_orderkey"], "lo", "hi", F.lit(20), F.lit(24), 10, "l_linenumber").select("l_orderkey", "l_linenumber", "distance")


@query(
    f"""SELECT {_K}, CASE {_K} % 5 WHEN 0 THEN 'unresolvable' WHEN 1 THEN 'absent' WHEN 2 THEN 'known_same_phenotype' WHEN 3 THEN 'known_new_phenotype' ELSE 'known_phenotype_unclear' END AS route FROM part"""
)
def reference_routes(spark, sf_dir):
    """The five routes against a reference with phenotypes (JN-08)."""
    p = t(spark, sf_dir, "part")
    rows = p.select(F.col(_K).alias("row_id"), F.expr(f"if({_K} % 5 = 0, 'a phrase', concat('c.', {_K}, 'A>G'))").alias("variant"), F.expr(f"concat('GENE', {_K})").alias("gene"), F.lit("Alstrom syndrome").alias("clinical"))
    keys = p.where(f"{_K} % 5 > 1").select(F.expr(f"concat('GENE', {_K}, '|c.', {_K}, 'A>G')").alias("key"), F.col(_K).cast("string").alias("locus"))
    phenotypes = p.where(f"{_K} % 5 in (2, 3)").select(F.col(_K).cast("string").alias("locus"), F.expr(f"if({_K} % 5 = 2, 'ALSTROM SYNDROME, type 1', 'ataxia')").alias("phenotype"))
    return stages.route_reference(stages.match_reference(rows, keys), phenotypes).select(F.col("row_id").alias(_K), "route")


@query(f"SELECT {_K}, CASE WHEN {_K} % 4 < 2 THEN 'coding' ELSE 'utr' END AS region_used FROM part WHERE {_K} % 2 = 0 AND {_K} % 3 <> 0 AND ({_K} % 4 < 2 OR p_size % 2 = 0)")
def passed_rows(spark, sf_dir):
    """Rows that a person passed, in the allowed region of the person or the pipeline (FIL-12)."""
    p = t(spark, sf_dir, "part").where(f"{_K} % 4 < 2 or p_size % 2 = 0")
    rows = p.select(_K, F.expr(f"concat('id', {_K})").alias("audit_id"), F.lit("positive").alias("sample_class"), F.col(_K).cast("string").alias("pmid"), F.lit("G").alias("gene"), F.lit("v").alias("variant_text"), F.expr(f"if({_K} % 3 = 0, 'intron', 'coding')").alias("genomic_region"))
    notes = p.select(F.col(_K).alias("no"), F.expr(f"concat('id', {_K})").alias("audit_id"), F.lit("positive").alias("sample_class"), F.col(_K).cast("string").alias("pmid"), F.lit("G").alias("gene"), F.lit("v").alias("variant_text"), F.expr(f"if({_K} % 2 = 0, 'Pass', 'fail')").alias("human_verdict"), F.lit("").alias("human_comment"), F.lit("").alias("human_fail_stage"), F.expr(f"if({_K} % 4 >= 2 and {_K} % 3 <> 0, 'utr', '')").alias("human_genomic_region"))
    return delivery.reviewed(rows, notes, _K, "no", ["coding", "utr"]).select(_K, "region_used")


# -- sequences, transcripts, SQL functions, incremental tables ---------------------------
_PIECE = "substring('ACGTTGCAGATTACA', int(1 + p_partkey % 7), int(3 + p_partkey % 6))"


@query(
    f"""WITH g AS (SELECT p_size % 20 AS c, string_agg({_PIECE.replace("substring", "substr").replace("int(", "CAST(").replace("% 7)", "% 7 AS INTEGER)").replace("% 6)", "% 6 AS INTEGER)")}, '' ORDER BY p_partkey) AS seq FROM part WHERE p_size % 20 > 0 GROUP BY 1),
a AS (SELECT o_orderkey, CAST(1 + o_orderkey % 21 AS BIGINT) AS c, 1 + o_orderkey * 7 % 900 AS s, 1 + o_orderkey * 7 % 900 + o_custkey % 90 AS e FROM orders)
SELECT o_orderkey, CASE WHEN e <= length(seq) THEN substr(seq, s, e - s + 1) END AS bases FROM a LEFT JOIN g ON a.c = g.c"""
)
def indexed_bases(spark, sf_dir):
    """Sequences written as FASTA, indexed, and read by byte ranges: the bases of every order's span (SRC-08, SNK)."""
    p = t(spark, sf_dir, "part").where("p_size % 20 > 0").select(F.expr("cast(p_size % 20 as string)").alias("chrom"), F.struct("p_partkey", F.expr(_PIECE).alias("s")).alias("x"))
    whole = p.groupBy("chrom").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["s"]), "").alias("seq"))
    path = fresh_path(spark, "fasta")
    sinks.write_fasta(whole, path)
    asked = t(spark, sf_dir, "orders").select("o_orderkey", F.expr("cast(1 + o_orderkey % 21 as string)").alias("chrom"), F.expr("1 + o_orderkey * 7 % 900").alias("s"), F.expr("1 + o_orderkey * 7 % 900 + o_custkey % 90").alias("e"))
    return indexed_fasta.fetch_indexed(asked, indexed_fasta.build_index(spark, path), "chrom", "s", "e", "bases", 128).select("o_orderkey", "bases")


#: Names by p_partkey % 6 against a transcript of three exons of 100 bases, 100 apart, of which the bases 51 to 250 are coding.
_LIFTED = ("concat('c.', 1 + {k} % 200, 'A>G')", "concat('c.-', 1 + {k} % 50, 'C>T')", "concat('c.*', 1 + {k} % 50, 'del')", "concat('c.50+', 1 + {k} % 90, 'G>A')", "concat('c.', 1 + {k} % 150, '_', 3 + {k} % 150, 'delinsTTG')", "concat('c.', 500 + {k}, 'A>G')")


@query(
    f"""WITH n AS (SELECT p_partkey AS k, p_partkey % 6 AS m, p_partkey % 2 = 1 AS back, CASE p_partkey % 6 WHEN 0 THEN 50 + p_partkey % 200 WHEN 1 THEN 49 - p_partkey % 50 WHEN 2 THEN 250 + p_partkey % 50 WHEN 3 THEN 99 WHEN 4 THEN 50 + p_partkey % 150 END AS a,
 CASE p_partkey % 6 WHEN 3 THEN 1 + p_partkey % 90 ELSE 0 END AS o FROM part),
-- the place in the transcript as a genomic one: 200 bases from exon to exon, mirrored on the other strand
p AS (SELECT *, (a // 100) * 200 + a % 100 + 1 + o AS f, CASE WHEN m = 4 THEN ((a + 2) // 100) * 200 + (a + 2) % 100 + 1 ELSE (a // 100) * 200 + a % 100 + 1 + o END AS g FROM n),
q AS (SELECT *, k * 1000 + CASE WHEN back THEN 501 - g ELSE f END AS lo, k * 1000 + CASE WHEN back THEN 501 - f ELSE g END AS hi FROM p)
SELECT k AS p_partkey, CASE WHEN m < 5 THEN CASE m WHEN 2 THEN 'del' WHEN 4 THEN 'delins' ELSE 'sub' END END AS kind, CASE WHEN m < 5 THEN lo END AS lo, CASE WHEN m < 5 THEN hi END AS hi,
 CASE m WHEN 0 THEN CASE WHEN back THEN 'T' ELSE 'A' END WHEN 1 THEN CASE WHEN back THEN 'G' ELSE 'C' END WHEN 3 THEN CASE WHEN back THEN 'C' ELSE 'G' END END AS ref,
 CASE m WHEN 0 THEN CASE WHEN back THEN 'C' ELSE 'G' END WHEN 1 THEN CASE WHEN back THEN 'A' ELSE 'T' END WHEN 3 THEN CASE WHEN back THEN 'T' ELSE 'A' END WHEN 4 THEN CASE WHEN back THEN 'CAA' ELSE 'TTG' END END AS alt FROM q"""
)
def transcript_lift(spark, sf_dir):
    """c. names of both strands to genomic spans: coding, UTR, intron offsets, spans over exons, places outside (HGV-21)."""
    span = lambda a, b: F.struct((F.col(_K) * 1000 + a).alias("start"), (F.col(_K) * 1000 + b).alias("end"))
    exons = F.array(*[span(200 * i + 1, 200 * i + 100) for i in range(3)])
    cds = F.array(span(51, 100), span(201, 300), span(401, 450))
    name = F.expr(_case(tuple(x.replace("{k}", _K) for x in _LIFTED), _K))
    rows = parts(spark, sf_dir).select(_K, resolver.lift_names(name, exons, cds, F.expr(f"if({_K} % 2 = 1, '-', '+')")).alias("l"))
    return rows.select(_K, "l.kind", "l.lo", "l.hi", "l.ref", "l.alt")


@query(
    f"""WITH x AS (SELECT p_partkey AS id, p_partkey % 10 AS k, {_negative_text_sql()} AS text, CASE p_partkey % 10 WHEN 9 THEN 'rs' || (100000 + p_partkey) ELSE 'c.' || (p_partkey + 1) || 'C>T' END AS variant FROM part)
SELECT id, rule, variant, CAST(strpos(evidence, variant) - 1 AS INTEGER) AS place FROM (SELECT x.*, h.rule, CASE WHEN h.rule = 'classify_paren' THEN split_part(text, '. ', 2) ELSE text END AS evidence FROM x JOIN (VALUES {_NEGATIVE_HITS}) h(k, rule, label, role, confidence) ON h.k = x.k)"""
)
def lateral_negatives(spark, sf_dir):
    """SQL over the registered table functions: negative evidence of every text, and where its name stands in the sentence (2.11)."""
    sql.register(spark)
    parts(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.expr(_negative_text_sql()).alias("text"), F.expr("concat('c.', p_partkey, 'A>G')").alias("anchor")).createOrReplaceTempView("lociflow_texts")
    return spark.sql("SELECT x.id, n.rule, n.variant, s.start AS place FROM lociflow_texts x, LATERAL negative_evidence(x.text, x.anchor) n, LATERAL text_spans(n.evidence) s WHERE s.kind = 'variant' AND s.norm = n.variant")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 16 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 4 > 0 UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 16 = 0 THEN 'new' ELSE o_orderstatus END FROM orders WHERE o_orderkey % 4 = 0")
def bucketed_upsert(spark, sf_dir):
    """Three batches merged by key into a table of hash buckets; each rewrites the buckets of its keys only (2.10)."""
    o, target = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), fresh_path(spark, "upserts")
    batches = (o.where("o_orderkey % 4 > 0"), o.where("o_orderkey % 4 = 0"), o.where("o_orderkey % 16 = 0").withColumn("o_orderstatus", F.lit("new")))
    for version, batch in enumerate(batches):
        ingest.merge_batch(batch, version, target, "o_orderkey", 16)
    return ingest.read_table(spark, target)


@query("SELECT time_bucket(INTERVAL '10 minutes', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark, sf_dir):
    """Counts per window and kind, the batch form of the stream (2.10)."""
    counted = ingest.windowed_counts(t(spark, sf_dir, "events"), "ts", "event_type")
    return counted.select(F.col("window.start").alias("start"), "event_type", F.col("count").alias("n"))


@query(
    """WITH g AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_quantity > 10) AS q, count(*) FILTER (WHERE l_returnflag <> 'R') AS f, count(*) FILTER (WHERE l_tax < 0.05) AS t, count(*) FILTER (WHERE l_quantity > 10 AND l_tax < 0.05) AS k FROM lineitem)
SELECT 'quantity' AS gate, 'required' AS state, q AS passed, n - q AS failed FROM g UNION ALL SELECT 'flag', 'audit_only', f, n - f FROM g UNION ALL SELECT 'tax', 'enabled', t, n - t FROM g UNION ALL SELECT 'all', 'custom', k, n - k FROM g"""
)
def gate_counts(spark, sf_dir):
    """What every gate passed and failed under declared states, observed in the one pass that writes the rows (SNK-07, FIL-11)."""
    declared = [Gate("quantity", F.col("l_quantity") > 10), Gate("flag", F.col("l_returnflag") != "R"), Gate("tax", F.col("l_tax") < 0.05, "disabled")]
    states, counts = {"flag": "audit_only", "tax": "enabled"}, Observation()
    apply_gates(t(spark, sf_dir, "lineitem"), declared, "custom", states, counts).write.parquet(fresh_path(spark, "gated"))
    return spark.createDataFrame(gates.gate_counts(counts, declared, "custom", states), "gate string, state string, passed long, failed long")


@query(f"SELECT 'rs' || (100000 + k) AS rs, CASE WHEN k % 7 = 0 THEN 'failed' WHEN p_partkey IS NULL THEN 'absent' ELSE 'found' END AS state, CASE WHEN k % 7 > 0 THEN 'GENE' || p_size END AS gene, CAST(0 AS BIGINT) AS asked_again FROM (SELECT DISTINCT o_custkey AS k FROM orders) o LEFT JOIN part ON p_partkey = k AND k % 3 > 0")
def catalogue_refresh(spark, sf_dir):
    """Names of a run asked from a payload table, some unknown there, some without an answer; a second refresh asks for nothing (SRC-19, GEN-11)."""
    wanted = t(spark, sf_dir, "orders").select(F.expr("concat('RS', 100000 + o_custkey)").alias("rs"))
    gene = "struct(array(struct(array(struct(array(struct(concat('GENE', p_size) as locus, cast(p_size as bigint) as id, '' as name)) as genes)) as assembly_annotation)) as allele_annotations)"
    source = t(spark, sf_dir, "part").where("p_partkey % 3 > 0").select(F.expr("concat('rs', 100000 + p_partkey)").alias("rs"), F.expr(f"to_json(struct({gene} as primary_snapshot_data))").alias("payload"))

    def fetch(asked):
        error = F.when(F.substring("rs", 3, 20).cast("long") % 7 == 100_000 % 7, "timeout")
        return asked.join(source, "rs", "left").withColumn("error", error)

    path = fresh_path(spark, "catalogue")
    catalogue_cache.refresh(wanted, path, fetch, 1_000_000, buckets=8)
    again = catalogue_cache.refresh(wanted, path, fetch, 1_000_100, buckets=8)
    cache = catalogue_cache.read_cache(spark, path)
    named = readers.dbsnp_genes(cache.where("payload is not null"), "payload", "rs").select("rs", "gene")
    return cache.join(named, "rs", "left").select("rs", "state", "gene", F.lit(again.asked).cast("long").alias("asked_again"))


from lociflow.plans import catalogue_branches  # noqa: E402, F401  (registers its queries)
