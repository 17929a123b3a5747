"""Queries over readers, writers and branches that the main catalogue does not reach, each with SQL; files are written from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociflow.functions import alleles, genes, text
from lociflow.operators import relational as R
from lociflow.operators import resolver
from lociflow.operators.tables import fresh_path
from lociflow.plans import delivery, stages
from lociflow.plans.catalogue import _K, _case, parts, query, t
from lociflow.sources import readers, sinks


# -- files -------------------------------------------------------------------------------
@query("SELECT CAST(p_partkey AS VARCHAR) AS pmid, p_name AS title, CAST(1990 + p_size % 30 AS VARCHAR) AS year, CASE WHEN p_size % 2 = 0 THEN '7' END AS month FROM part")
def record_files(spark, sf_dir):
    """Article records written one to a line and read again by their schema; a folder that is not there is empty (SRC-01, SRC-02, SNK-03)."""
    path = fresh_path(spark, "records")
    rows = t(spark, sf_dir, "part").select(F.col(_K).cast("string").alias("pmid"), F.col("p_name").alias("title"), F.struct((1990 + F.col("p_size") % 30).cast("string").alias("year"), F.when(F.col("p_size") % 2 == 0, "7").alias("month")).alias("pub_date"))
    sinks.write_jsonl(rows, path)
    read = readers.jsonl(spark, path, readers.ARTICLES).unionByName(readers.jsonl_or_empty(spark, path + "-none", readers.ARTICLES))
    return read.select("pmid", "title", "pub_date.year", "pub_date.month")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0)")
def cohort_filter(spark, sf_dir):
    """Ids out of a list file with comments and notes, and the rows of the cohort; their number is asserted (SRC-04, FIL-01)."""
    path = fresh_path(spark, "ids")
    some = t(spark, sf_dir, "customer").where("c_custkey % 5 = 0")
    some.select(F.expr("concat(if(c_custkey % 2 = 0, ' ', ''), c_custkey, '  noted')").alias("v")).union(spark.range(3).select(F.concat(F.lit("# comment "), "id"))).write.text(path)
    ids = readers.id_list(spark, path)
    articles = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("pmid"))
    cohort = R.cohort(articles, ids, "pmid", expected=some.count())
    return t(spark, sf_dir, "orders").join(cohort.select(F.col("pmid").cast("long").alias("o_custkey")), "o_custkey", "left_semi").select("o_orderkey")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CASE WHEN s_nationkey % 2 = 0 THEN 'true' ELSE 'false' END AS even, '' AS lacking FROM supplier")
def table_files(spark, sf_dir):
    """A table of fixed columns written with a byte-order mark and quotes, and read again (SRC-05, SNK-01)."""
    path = fresh_path(spark, "table")
    sinks.write_table(t(spark, sf_dir, "supplier").withColumn("even", F.col("s_nationkey") % 2 == 0), path, ["s_suppkey", "s_name", "even", "lacking"], bom=True)
    return readers.csv(spark, path).select("s_suppkey", "s_name", "even", F.coalesce("lacking", F.lit("")).alias("lacking"))


@query(
    f"""WITH r AS (SELECT {_K} AS k, p_size, CASE WHEN {_K} % 2 = 0 THEN 'GRCh38' ELSE 'GRCh37' END AS a FROM part WHERE {_K} % 5 > 0),
l AS (SELECT k, a, concat_ws(':', a, CAST(1 + p_size % 22 AS VARCHAR), CAST(1000 + k AS VARCHAR), 'A', 'G') AS locus, k // 4 AS g FROM r)
SELECT DISTINCT 'rs' || (100000 + g) AS key, locus FROM l WHERE a = 'GRCh38' OR g NOT IN (SELECT g FROM l WHERE a = 'GRCh38')"""
)
def variant_tables(spark, sf_dir):
    """A variant summary as a tab-separated file: valid rows, and loci by rs name where the newer assembly hides the other (SRC-06)."""
    path = fresh_path(spark, "variants")
    p = t(spark, sf_dir, "part")
    rows = p.select(
        F.expr(f"if({_K} % 2 = 0, 'GRCh38', 'GRCh37')").alias("Assembly"), F.expr("cast(1 + p_size % 22 as string)").alias("Chromosome"), F.expr(f"if({_K} % 5 = 0, 'na', cast(1000 + {_K} as string))").alias("PositionVCF"),
        F.lit("A").alias("ReferenceAlleleVCF"), F.lit("G").alias("AlternateAlleleVCF"), F.lit("a name").alias("Name"), F.lit("-").alias("GeneSymbol"), F.expr(f"cast(100000 + {_K} div 4 as string)").alias("RS# (dbSNP)"),
    )
    rows.write.csv(path, header=True, sep="\t", quote="")
    return readers.clinvar_keys(readers.clinvar(spark, path)).where("key like 'rs%'")


@query(f"SELECT 't' || {_K} AS t, CAST({_K} * 100 + 11 AS BIGINT) AS cds_start, CAST({_K} * 100 + CASE WHEN p_size % 2 = 0 THEN 60 ELSE 20 END AS BIGINT) AS cds_end, 'G' || {_K} AS gene, CASE WHEN p_size % 3 = 0 THEN 'MANE' ELSE '' END AS tag FROM part WHERE p_size > 5")
def feature_files(spark, sf_dir):
    """Genes, transcripts and coding parts as GFF3: spans per transcript, the gene behind two parents, the tagged transcripts (SRC-07, AGG-17)."""
    path = fresh_path(spark, "features")
    p = t(spark, sf_dir, "part").where("p_size > 5")
    line = lambda kind, lo, hi, notes: F.expr(f"concat_ws('\t', cast(1 + p_size % 22 as string), 'x', '{kind}', cast({_K} * 100 + {lo} as string), cast({_K} * 100 + {hi} as string), '.', '+', '.', {notes})")
    lines = F.array(
        line("CDS", 11, 20, f"concat('Parent=transcript:t', {_K})"), F.when(F.col("p_size") % 2 == 0, line("CDS", 51, 60, f"concat('ID=cds:c', {_K}, ';Parent=transcript:t', {_K}, ',transcript:other')")), line("exon", 1, 20, f"concat('Parent=transcript:t', {_K})"),
        line("mRNA", 1, 80, f"concat('ID=transcript:t', {_K}, ';Parent=gene:g', {_K}, if(p_size % 3 = 0, ';tag=basic,MANE_Select', ''))"), line("gene", 1, 80, f"concat('ID=gene:g', {_K}, ';Name=G', {_K}, ';biotype=protein_coding')"), F.lit("# a comment"),
    )
    p.select(F.explode(F.array_compact(lines)).alias("value")).write.text(path)
    raw = readers.gff3(spark, path)
    found = readers.gff3_features(raw).where("type = 'cds'").select(F.col("transcript").alias("t"), "gene").distinct()
    tagged = readers.mane_transcripts(raw).select("t", F.lit("MANE").alias("tag"))
    return readers.cds_spans(raw).join(found, "t").join(tagged, "t", "left").select("t", "cds_start", "cds_end", "gene", F.coalesce("tag", F.lit("")).alias("tag"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS chrom, CAST(length(s_name) * (1 + s_suppkey % 9) AS BIGINT) AS length FROM supplier WHERE s_suppkey BETWEEN 1 AND 22")
def sequence_files(spark, sf_dir):
    """Contigs as FASTA lines, read in chunks without an index: their lengths (SRC-08)."""
    path = fresh_path(spark, "contigs")
    contigs = t(spark, sf_dir, "supplier").where("s_suppkey between 1 and 22").select(F.col("s_suppkey").cast("string").alias("chrom"), F.expr("repeat(translate(s_name, '#', 'N'), int(1 + s_suppkey % 9))").alias("seq"))
    sinks.write_fasta(contigs.repartition(4), path, 7)
    return readers.contig_lengths(readers.fasta(spark, path, 16))


_ORDERED = "row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1"


def _conversations(spark, sf_dir, piece):
    """conv_id and an array of ``piece`` over its turns in order."""
    c = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return c.select("conv_id", F.transform("turns", piece).alias("turns"))


@query(f"SELECT conv_id, CAST({_ORDERED} AS INTEGER) AS idx, upper(role) AS section_type, 'paragraph' AS passage_type, text, CAST(turn * 10 AS INTEGER) AS \"offset\" FROM conversations")
def bioc_files(spark, sf_dir):
    """Passages of BioC records (SRC-12)."""
    passage = lambda x: F.struct(F.create_map(F.lit("section_type"), F.upper(x["role"]), F.lit("type"), F.lit("paragraph")).alias("infons"), x["text"].alias("text"), (x["turn"] * 10).cast("int").alias("offset"))
    rows = _conversations(spark, sf_dir, passage).select("conv_id", F.to_json(F.struct(F.array(F.struct(F.col("turns").alias("passages"))).alias("documents"))).alias("payload"))
    return readers.bioc_passages(rows, "payload").select("conv_id", "idx", "section_type", "passage_type", "text", "offset")


_FLAT = f"trim(regexp_replace(text, '{text.WHITE}', ' ', 'g'))"


@query(
    f"""WITH c AS (SELECT *, {_ORDERED} AS i, {_FLAT} AS flat FROM conversations)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1 AS INTEGER) AS idx, CASE WHEN i = 0 THEN 'TITLE' WHEN role = 'user' THEN 'CASE' WHEN role = 'system' THEN 'METHODS' ELSE 'OTHER' END AS section_type, flat AS text FROM c WHERE flat <> ''"""
)
def jats_files(spark, sf_dir):
    """JATS articles: a title and sections with lists and tables in document order (SRC-13)."""
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = lambda x: F.concat(F.lit("<sec><title>"), F.when(x["role"] == "user", "A case").when(x["role"] == "system", "Methods").otherwise("Answer"), F.lit("</title><list><list-item><p>"), safe(x["text"]), F.lit("</p></list-item></list></sec>"))
    rows = _conversations(spark, sf_dir, lambda x: F.struct(body(x).alias("s"), safe(x["text"]).alias("t")))
    whole = F.concat(F.lit('<?xml version="1.0"?><article><front><article-title>'), F.col("turns")[0]["t"], F.lit("</article-title></front><body>"), F.array_join(F.transform(F.slice("turns", 2, 1000), lambda x: x["s"]), ""), F.lit("</body></article>"))
    return readers.jats_passages(rows.select("conv_id", whole.alias("x")), "x", "conv_id").select("conv_id", "idx", "section_type", "text")


@query(f"SELECT conv_id, CAST({_ORDERED} AS INTEGER) AS idx, CASE role WHEN 'user' THEN 'RESULTS' WHEN 'system' THEN 'METHODS' ELSE 'DISCUSS' END AS section_type, {_FLAT} AS text FROM conversations")
def plain_files(spark, sf_dir):
    """Plain text: section lines, and the paragraphs under them (SRC-16)."""
    head = lambda x: F.when(x["role"] == "user", "RESULTS").when(x["role"] == "system", "Methods").otherwise("Discussion of it")
    block = lambda x: F.concat(head(x), F.lit("\n"), F.regexp_replace(x["text"], r"\n\s*\n", "\n"))
    rows = _conversations(spark, sf_dir, block).select("conv_id", F.array_join("turns", "\n\n").alias("t"))
    return readers.plain_passages(rows, "t", "conv_id").select("conv_id", "idx", "section_type", "text")


@query(
    """WITH s AS (SELECT conv_id, CASE turn % 3 WHEN 0 THEN 'bioc' WHEN 1 THEN 'jats' ELSE 'html' END AS source, turn, text FROM conversations),
n AS (SELECT conv_id, source, CASE source WHEN 'bioc' THEN 0 WHEN 'jats' THEN 1 ELSE 2 END AS w, count(*) >= 2 AND sum(length(text)) >= 2500 AS ok FROM s GROUP BY ALL),
c AS (SELECT conv_id, first(source ORDER BY CASE WHEN ok THEN 0 ELSE 1 END, CASE WHEN ok THEN w ELSE -w END) AS source FROM n GROUP BY conv_id)
SELECT s.conv_id, s.turn, s.source FROM s JOIN c ON s.conv_id = c.conv_id AND s.source = c.source"""
)
def source_choice(spark, sf_dir):
    """The first source with enough text, else the last that has any (SRC-18)."""
    rows = t(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.expr("case turn % 3 when 0 then 'bioc' when 1 then 'jats' else 'html' end").alias("source"))
    return readers.source_cascade(rows, "conv_id", ["bioc", "jats", "html"]).select("conv_id", "turn", "source")


@query(
    """WITH s AS (SELECT conv_id, CASE turn % 3 WHEN 0 THEN 'bioc' WHEN 1 THEN 'jats' ELSE 'pmc_html' END AS source, turn, CASE WHEN conv_id % 2 = 0 THEN 'jats' ELSE 'pdf' END AS stated FROM conversations),
w AS (SELECT *, CASE WHEN contains(stated, source) THEN 0 WHEN source = 'pmc_html' THEN 1 WHEN source = 'bioc' THEN 2 END AS w FROM s), m AS (SELECT conv_id, min(w) AS w FROM w GROUP BY conv_id)
SELECT w.conv_id, w.turn, w.source FROM w JOIN m ON w.conv_id = m.conv_id AND w.w = m.w"""
)
def cached_sources(spark, sf_dir):
    """The source that an article was parsed from, else its cached page, else its cached record (SRC-17)."""
    rows = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr("case turn % 3 when 0 then 'bioc' when 1 then 'jats' else 'pmc_html' end").alias("source"), F.expr("if(conv_id % 2 = 0, 'jats', 'pdf')").alias("stated_source"))
    return readers.cached_source(rows, "conv_id").select("conv_id", "turn", "source")


@query(f"SELECT CAST({_K} AS VARCHAR) AS pmid, p_name AS title, CASE WHEN p_size % 2 = 0 THEN p_type || ' ' || p_brand ELSE p_type END AS abstract, p_brand AS journal, CAST(2000 + p_size % 20 AS VARCHAR) AS year, CASE WHEN p_size % 3 > 0 THEN '10.1/' || {_K} END AS doi FROM part")
def article_records(spark, sf_dir):
    """Article records out of their XML: titles, all parts of an abstract, journal, date and ids (SRC-11)."""
    xml = F.expr(
        f"concat('<PubmedArticle><MedlineCitation><PMID>', {_K}, '</PMID><Article><ArticleTitle>', p_name, '</ArticleTitle><Abstract><AbstractText>', p_type, '</AbstractText>', if(p_size % 2 = 0, concat('<AbstractText>', p_brand, '</AbstractText>'), ''), "
        "'</Abstract><Journal><Title>', p_brand, '</Title><JournalIssue><PubDate><Year>', 2000 + p_size % 20, '</Year></PubDate></JournalIssue></Journal></Article></MedlineCitation><PubmedData><ArticleIdList>', "
        f"if(p_size % 3 > 0, concat('<ArticleId IdType=\"doi\">10.1/', {_K}, '</ArticleId>'), ''), '</ArticleIdList></PubmedData></PubmedArticle>')"
    )
    return readers.efetch_articles(t(spark, sf_dir, "part").select(xml.alias("x")), "x").select("pmid", "title", "abstract", "journal", "pub_date.year", "doi")


# -- genes, names, alleles ---------------------------------------------------------------
#: Annotation of an article: a gene, and a variant of it by identifier or by id; the SQL reads the same JSON.
_NOTE = f"concat('{{\"variants\": [{{\"hgvs\": \"', if({_K} % 2 = 0, concat('rs', 100000 + {_K}), concat('c.', {_K}, 'A>G')), '\", \"identifier\": \"tmVar:x;CorrespondingGene:', p_size, '\"}}], \"genes\": [{{\"identifier\": \"', p_size + {_K} % 3 div 2, '\", \"name\": \"ABCD', p_size, '\"}}]}}')"
_NOTE_SQL = _NOTE.replace(f"if({_K} % 2 = 0, concat('rs', 100000 + {_K}), concat('c.', {_K}, 'A>G'))", f"CASE WHEN {_K} % 2 = 0 THEN concat('rs', 100000 + {_K}) ELSE concat('c.', {_K}, 'A>G') END").replace(f"{_K} % 3 div 2", f"{_K} % 3 // 2")


@query(
    f"""WITH x AS (SELECT {_K}, p_size, {_NOTE_SQL} AS j FROM part), y AS (SELECT *, CASE WHEN json_extract_string(j, '$.genes[0].identifier') = regexp_extract(json_extract_string(j, '$.variants[0].identifier'), 'CorrespondingGene:([0-9]+)', 1) THEN json_extract_string(j, '$.genes[0].name') END AS noted FROM x)
SELECT {_K}, CASE WHEN {_K} % 4 = 0 THEN 'WXYZ' || p_size WHEN {_K} % 5 = 0 AND {_K} % 2 = 0 THEN coalesce(noted, 'GIVEN1') WHEN {_K} % 5 = 0 THEN 'GIVEN1' ELSE noted END AS gene,
 CASE WHEN {_K} % 4 = 0 THEN 'locus_phrase' WHEN {_K} % 5 = 0 AND ({_K} % 2 = 1 OR noted IS NULL) THEN 'given' WHEN noted IS NOT NULL THEN 'pubtator' ELSE 'none' END AS rule FROM y"""
)
def gene_annotations(spark, sf_dir):
    """Genes of rs names by locus phrase, annotation and corpus, and of other names by corpus and annotation (GEN-08, JN-14)."""
    p = parts(spark, sf_dir)
    null = F.lit(None).cast("string")
    variant = F.expr(f"if({_K} % 2 = 0, concat('rs', 100000 + {_K}), concat('c.', {_K}, 'A>G'))")
    evidence = F.expr(f"if({_K} % 4 = 0, concat('We saw rs', 100000 + {_K}, ' located in the WXYZ', p_size, ' locus.'), 'Nothing was said of it.')")
    g = genes.gene_in_article(variant, evidence, null, null, null, F.expr(_NOTE), F.expr(f"if({_K} % 5 = 0, 'GIVEN1', null)"))
    return p.select(_K, g.alias("g")).select(_K, "g.gene", "g.rule")


@query(
    f"""SELECT {_K}, CASE WHEN {_K} % 3 = 0 THEN 'c.' || {_K} || 'A>G' WHEN {_K} % 3 = 1 THEN 'c.' || {_K} || 'C>T' END AS c, CASE WHEN {_K} % 3 < 2 THEN 'p.Arg' || {_K} || 'Gln' END AS p, CASE WHEN {_K} % 3 = 2 THEN 'rs' || (100000 + {_K}) END AS rs,
 CASE {_K} % 3 WHEN 0 THEN 'pro' WHEN 1 THEN 'nt' ELSE 'other' END AS level FROM part"""
)
def evidence_names(spark, sf_dir):
    """Names of a variant completed by what its evidence writes beside them, and by nothing else (HGV-07 to HGV-10)."""
    variant = F.expr(_case((f"concat('p.Arg', {_K}, 'Gln')", f"concat('c.', {_K}, 'C>T')", f"concat('rs', 100000 + {_K})"), _K))
    said = F.expr(f"concat('We found c.', {_K}, 'A>G (p.Arg', {_K}, 'Gln) and c.', {_K}, 'C>T (p.Arg', {_K}, 'Gln), not c.9G>A.')")
    return parts(spark, sf_dir).select(_K, alleles.components_with_evidence(variant, said).alias("x")).select(_K, "x.c", "x.p", "x.rs", "x.level")


@query(f"SELECT {_K}, '7' AS chrom, CAST(CASE WHEN {_K} % 2 = 0 THEN 5000 + {_K} ELSE 9000 + {_K} END AS BIGINT) AS pos, 'pdf_literal_genomic' AS method, 'ok' AS status FROM part")
def nearby_literals(spark, sf_dir):
    """The genomic change that an article writes near a variant, not the one far from it (HGV-20)."""
    far = "repeat('and nothing of note was written in between. ', 12)"
    said = F.expr(f"concat('It lies at chr7:', 5000 + {_K}, ' A>G. ', if({_K} % 2 = 0, concat('c.', {_K}, 'A>G is meant. '), ''), {far}, 'Another at chr7:', 9000 + {_K}, ' C>T. ', if({_K} % 2 = 1, concat('c.', {_K}, 'A>G is meant.'), ''))")
    null = F.lit(None).cast("string")
    found = alleles.literal_near(said, null, F.expr(f"concat('c.', {_K}, 'A>G')"), null, null)
    return parts(spark, sf_dir).select(_K, found.alias("a")).select(_K, "a.chrom", "a.pos", "a.method", "a.status")


@query(
    """WITH l AS (SELECT l_orderkey, l_linenumber, max(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY ALL), a AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, max(q) OVER (PARTITION BY l_orderkey) AS m FROM l),
b AS (SELECT *, count(*) FILTER (WHERE q = m) OVER (PARTITION BY l_orderkey) AS top FROM a)
SELECT 'rs' || l_orderkey AS rs, CAST(100 + l_linenumber AS BIGINT) AS pos, CASE WHEN n = 1 THEN '' ELSE 'multi_allelic_chose_highest_frequency' END AS note FROM b WHERE n = 1 OR (top = 1 AND q = m)"""
)
def catalogue_choice(spark, sf_dir):
    """One allele per catalogued name: the only one, else the unique most frequent, else none (HGV-22, AGG-15)."""
    rows = t(spark, sf_dir, "lineitem").select(F.expr("concat('rs', l_orderkey)").alias("rs"), F.lit("NC_000001.11").alias("seq_id"), (100 + F.col("l_linenumber")).cast("long").alias("pos"), F.lit("A").alias("ref"), F.expr("substring('CGTCGTCGT', l_linenumber, 1)").alias("alt"), F.col("l_quantity").alias("q"), "l_linenumber")
    # alleles are told apart by their bases: one with as many bases as its line has
    rows = rows.withColumn("alt", F.expr("concat('C', repeat('G', l_linenumber))"))
    known = rows.select("rs", F.lit(True).alias("is_ptlp"), "seq_id", "pos", "ref", "alt")
    frequencies = rows.select("rs", "seq_id", "ref", "alt", F.lit("some study").alias("study"), F.col("q").alias("count"), F.lit(100.0).alias("total"))
    movements = known.select("rs", "seq_id", "ref", "alt", F.lit(1).alias("weight")).where("false")
    return resolver.catalogue_alleles(known, frequencies, movements).select("rs", "pos", F.col("selection_note").alias("note"))


@query(
    f"""WITH x AS (SELECT {_K}, ({_K} % 1000) * 4 + 1 AS pos FROM part)
SELECT {_K}, CASE {_K} % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'BAD' ELSE 'NA' END AS ref_ok_fasta,
 CASE WHEN {_K} % 3 = 2 THEN '' ELSE (SELECT string_agg(substr('ACGT', CAST((p - 1) % 4 + 1 AS INTEGER), 1) || '[' || p || ']', '' ORDER BY p) FROM range(greatest(pos - 5, 1), pos + 6) r(p)) END AS context_ref_5bp FROM x"""
)
def sequence_context(spark, sf_dir):
    """Five bases on either side of an export row, with positions, and whether its reference base is right (HGV-27)."""
    rows = t(spark, sf_dir, "part").select(_K, F.lit("chr1").alias("chromosome_ucsc"), F.expr(f"cast(({_K} % 1000) * 4 + 1 as string)").alias("position"), F.expr(_case(("'A'", "'C'", "''"), _K)).alias("ref"), F.lit("T").alias("alt"), F.lit("").alias("c_hgvs"), F.lit("x").alias("resolve_method"), F.lit("").alias("resolve_note"))
    sequence = spark.range(2).select(F.lit("1").alias("chrom"), F.col("id").cast("int").alias("chunk_no"), F.repeat(F.lit("ACGT"), F.lit(readers.CHUNK // 4)).alias("seq"))
    return delivery.with_context(rows, sequence, _K).select(_K, "ref_ok_fasta", "context_ref_5bp")


# -- joins, choices, labels --------------------------------------------------------------
@query("SELECT o_orderkey, CASE WHEN c_custkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'likely_benign' WHEN c_custkey % 3 = 1 THEN 'pathogenic' ELSE 'not_evaluated' END AS label FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 3 < 2")
def article_labels(spark, sf_dir):
    """Pathogenicity of a row by the cached text of its article; articles without a text are not evaluated (JN-01)."""
    rows = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("pmid"), F.lit("G").alias("gene"), F.expr("if(o_orderkey % 2 = 0, 'c.5A>G', 'c.7C>T')").alias("variant"))
    words = F.expr("if(c_custkey % 3 = 0, concat('The c.5A>G change was likely benign. ', repeat('Nothing more was said of it here. ', 60), 'Then c.7C>T was seen.'), 'All of it was pathogenic, c.5A>G and c.7C>T.')")
    texts = t(spark, sf_dir, "customer").where("c_custkey % 3 < 2").select(F.col("c_custkey").alias("pmid"), words.alias("cached_text"))
    return stages.label_pathogenicity(rows, texts).select("o_orderkey", F.col("pathogenicity.label").alias("label"))


@query("WITH c AS (SELECT conv_id, list(text ORDER BY turn) AS ps FROM conversations GROUP BY conv_id) SELECT conv_id, list_filter(ps, lambda p: contains(p, substr(ps[len(ps)], 3, 12)))[1] AS passage FROM c")
def passage_of_sentence(spark, sf_dir):
    """The first passage that has a piece of evidence in it (JN-15)."""
    c = _conversations(spark, sf_dir, lambda x: x["text"])
    return c.select("conv_id", R.passage_with(F.col("turns"), F.substring(F.element_at("turns", -1), 3, 12)).alias("passage"))


@query(
    rf"""WITH d AS (SELECT doc_id, text, strpos(lower(text), 'the') AS p FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN p > 0 THEN trim(regexp_replace(substr(text, greatest(p - 42, 1), p + 45 - greatest(p - 42, 1)), '\s+', ' ', 'g')) END AS snippet FROM d"""
)
def first_snippets(spark, sf_dir):
    """The surroundings of the first place of a word (WIN-07)."""
    return t(spark, sf_dir, "documents").where("text is not null").select("doc_id", text.first_snippet(F.col("text"), F.lit("the")).alias("snippet"))


@query(
    """WITH j AS (SELECT p_brand, p_size % 3 AS m, p_partkey FROM part)
SELECT p_partkey, CASE WHEN m = 0 THEN 'issn' WHEN m = 1 THEN 'journal_alias' ELSE 'default' END AS match_method, CASE WHEN m = 0 THEN 'A' WHEN m = 1 THEN 'B' ELSE 'C' END AS journal_tier,
 CASE WHEN m = 0 THEN 30 WHEN m = 1 THEN 20 ELSE 5 END + CASE WHEN p_partkey % 2 = 0 THEN 5 ELSE 0 END AS journal_priority_score FROM j"""
)
def journal_ranks(spark, sf_dir):
    """Journals by number, then by name; their tiers and scores, and the bonus of full text (CLS-07, STR-03, MAP-01)."""
    p = t(spark, sf_dir, "part")
    rows = p.select(_K, F.expr("if(p_size % 3 = 0, '1234-567x', null)").alias("issn"), F.lit(None).cast("string").alias("journal_iso"), F.expr("if(p_size % 3 = 1, concat('The ', p_brand, ' & Co.'), 'unknown')").alias("journal"), F.expr(f"if({_K} % 2 = 0, 'fulltext', 'abstract')").alias("evidence_source"))
    named = p.select(text.normalize_name(F.expr("concat('the ', p_brand, ' and co')")).alias("alias_key"), F.col("p_brand").alias("canonical_name"), F.lit("B").alias("tier_name"), F.lit(1).alias("ord")).distinct()
    journals = named.unionByName(spark.createDataFrame([("1234567X", "One", "WATCH", 1), ("1234567X", "Two", "A", 2)], named.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")))
    return stages.rank_journals(rows, journals).select(_K, "match_method", "journal_tier", "journal_priority_score")


@query(
    """WITH s AS (SELECT l_orderkey, l_returnflag AS v, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS o FROM lineitem), x AS (SELECT l_orderkey, CASE WHEN o % 2 = 0 THEN lower(v) ELSE v END AS v, o FROM s),
f AS (SELECT l_orderkey, lower(v) AS low, min({'o': o, 'v': v}) AS m FROM x GROUP BY 1, 2)
SELECT l_orderkey, string_agg(m.v, ',' ORDER BY m) AS names FROM f GROUP BY l_orderkey"""
)
def distinct_spellings(spark, sf_dir):
    """Distinct names whatever their case, in the first spelling and order (AGG-12)."""
    o = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")
    rows = t(spark, sf_dir, "lineitem").select("l_orderkey", F.struct(o.alias("o"), F.when(o % 2 == 0, F.lower("l_returnflag")).otherwise(F.col("l_returnflag")).alias("v")).alias("x"))
    names = rows.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["v"]).alias("names"))
    return names.select("l_orderkey", F.array_join(R.stable_distinct_ci(F.col("names")), ",").alias("names"))


@query(f"SELECT {_K}, {_case(('\'rs_with_paired_c\'', '\'bare_rs\'', '\'concrete_name\''), _K)} AS site_reason, CASE WHEN {_K} % 3 = 0 THEN 'c.' || {_K} || 'A>G' END AS paired_c, {_K} % 3 <> 1 AS kept FROM part")
def new_site_reasons(spark, sf_dir):
    """Rows that name a site: bare rs names only where the article writes a c. name beside them (FIL-07)."""
    p = parts(spark, sf_dir)
    rows = p.select(_K, F.col(_K).cast("string").alias("pmid"), F.expr(_case((f"concat('RS', 100000 + {_K})", f"concat('rs', 100000 + {_K})", f"concat('c.', {_K}, 'C>T')"), _K)).alias("variant"))
    words = p.select(F.col(_K).cast("string").alias("pmid"), F.expr(f"if({_K} % 3 = 0, concat('Of these c.', {_K}, 'A>G (rs', 100000 + {_K}, ') was new.'), 'Nothing.')").alias("text"))
    return stages.new_sites(rows, words).select(_K, "site_reason", "paired_c", "kept")


@query(
    f"""WITH x AS (SELECT {_K} AS k, 'G' || p_size AS gene, 'c.' || (p_size * 7 + 1) || 'C>T' AS v FROM part WHERE p_size % 5 > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY gene, v ORDER BY k % 2, CAST(k AS VARCHAR)) AS n FROM x)
SELECT CAST(k AS VARCHAR) AS pmid, v AS variant, CASE WHEN k % 2 = 0 THEN 'benign' ELSE 'likely_benign' END AS label, gene || '|' || lower(v) AS locus FROM r WHERE n = 1"""
)
def negative_loci(spark, sf_dir):
    """Negative alleles of all papers: without positives, best per paper, then best per locus over papers (AGG-07, AGG-08, GEN-09)."""
    p = parts(spark, sf_dir)
    words = p.select(F.col(_K).cast("string").alias("pmid"), F.expr(f"concat('We saw c.1A>G. In G', p_size, ' c.', p_size * 7 + 1, 'C>T was later reclassified as ', if({_K} % 2 = 0, 'benign', 'likely benign'), '.')").alias("text"))
    anchors = p.select(F.col(_K).cast("string").alias("pmid"), F.lit("c.1A>G").alias("variant"), F.expr("concat('G', p_size)").alias("gene"))
    positives = p.where("p_size % 5 = 0").select(F.expr("concat('G', p_size)").alias("gene"), F.expr("concat('c.', p_size * 7 + 1, 'C>T')").alias("variant")).distinct()
    found = stages.negative_alleles(words, anchors, positives)
    return found.select("pmid", "variant", "label", F.col("negative_locus_key").alias("locus"))


@query("SELECT role, CAST(count(*) AS BIGINT) AS n FROM conversations GROUP BY role UNION ALL SELECT NULL, count(*) FROM conversations")
def stage_counts(spark, sf_dir):
    """Rows and categories of a stage's result as a report table (SNK-07)."""
    table = sinks.report_table({"turns": t(spark, sf_dir, "conversations")}, {"turns": ["role"]})
    return table.select(F.col("value").alias("role"), "n")


@query("SELECT CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS INTEGER) AS page, CAST(o_orderkey AS VARCHAR) AS id FROM orders")
def review_records(spark, sf_dir):
    """Review pages of bounded size: every record on the page that its place gives (SNK-06)."""
    pages = sinks.review_pages(t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "Orders", "o_orderkey", 500)
    return pages.select("page", F.explode(F.regexp_extract_all("html", F.lit('"o_orderkey":([0-9]+)'), F.lit(1))).alias("id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'PMC' || o_custkey WHEN o_orderkey % 3 = 1 THEN 'PMC' || o_custkey END AS pmcid FROM orders")
def article_ids(spark, sf_dir):
    """Article ids with and without their prefix, and what is none (STR-03)."""
    raw = F.expr("case o_orderkey % 3 when 0 then concat(' pmc', o_custkey) when 1 then cast(o_custkey as string) else concat('x', o_custkey) end")
    return t(spark, sf_dir, "orders").select("o_orderkey", text.normalize_pmcid(raw).alias("pmcid"))
