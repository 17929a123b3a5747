"""Sources: declared schemas for records, lists, tables, features, sequences and full text."""

from __future__ import annotations

from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociflow.functions import hgvs
from lociflow.operators import relational as R
from lociflow.sources.passages import html_passages, jats_passages, plain_passages

__all__ = ["html_passages", "jats_passages", "plain_passages"]

_S = T.StringType()
#: Built from type objects, so that the module imports without a session.
ARTICLES = T.StructType(
    [T.StructField(n, _S) for n in ("pmid", "title", "abstract", "journal", "journal_iso", "issn")]
    + [T.StructField("pub_date", T.StructType([T.StructField("year", _S), T.StructField("month", _S)]))]
    + [T.StructField("doi", _S), T.StructField("pmcid", _S), T.StructField("source_query_ids", T.ArrayType(_S)), T.StructField("pubmed_url", _S)]
)
BIOC = "documents array<struct<passages array<struct<infons map<string,string>, text string, offset int>>>>"
#: Bases per row of a sequence table.
CHUNK = 1 << 16


def jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One record per line; blank lines are skipped; ``ord`` follows file and line order."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path).withColumn("ord", F.monotonically_increasing_id())


def jsonl_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``jsonl``; a missing path gives an empty table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema).withColumn("ord", F.lit(0).cast("long"))
    return jsonl(spark, path, schema)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """First token of each line that is not a comment, sorted and distinct."""
    t = F.trim(F.col("value"))
    return spark.read.text(path).where((t != "") & ~F.startswith(t, F.lit("#"))).select(F.split(t, r"\s+")[0].alias("pmid")).distinct().orderBy("pmid")


def csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header; a byte-order mark before the first name is dropped."""
    df = spark.read.csv(path, header=True, sep=sep, multiLine=True, escape='"')
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def clinvar(spark: SparkSession, path: str) -> DataFrame:
    """Variant summary (TSV, also gzipped): valid rows as assembly, chrom, pos, ref, alt, gene, rs, nm, c, p.

    gzip cannot be split, so the rows are spread again before they are parsed.
    """
    raw = spark.read.csv(path, header=True, sep="\t", quote="")
    has = lambda *names: F.coalesce(*[F.nullif(F.col(f"`{n}`"), F.lit("na")) for n in names if n in raw.columns])
    df = raw.repartition(spark.sparkContext.defaultParallelism).select(
        F.col("Assembly").alias("assembly"),
        hgvs.norm_chrom(F.col("Chromosome")).alias("chrom"),
        hgvs.norm_pos(has("PositionVCF", "Start")).alias("pos"),
        F.upper(has("ReferenceAlleleVCF", "ReferenceAllele")).alias("ref"),
        F.upper(has("AlternateAlleleVCF", "AlternateAllele")).alias("alt"),
        F.upper(F.col("GeneSymbol")).alias("gene"),
        F.when(has("RS# (dbSNP)", "RS#").rlike("^[0-9]+$"), F.concat(F.lit("rs"), has("RS# (dbSNP)", "RS#"))).alias("rs"),
        hgvs.components(F.col("Name")).alias("parts"),
    )
    ok = F.col("assembly").isin("GRCh37", "GRCh38") & F.col("chrom").isNotNull() & F.col("pos").isNotNull() & F.col("ref").rlike("^[ACGTN]+$") & F.col("alt").rlike("^[ACGTN]+$") & (F.col("ref") != F.col("alt"))
    return df.where(ok)


def clinvar_keys(table: DataFrame) -> DataFrame:
    """(key, locus) of all four ladders; GRCh38 loci hide others of the same key."""
    locus = F.concat_ws(":", "assembly", "chrom", "pos", "ref", "alt")
    parts = F.struct(F.col("parts.nm").alias("nm"), F.col("parts.c").alias("c"), F.col("parts.p").alias("p"), F.col("rs").alias("rs"))
    keyed = table.select(F.explode(hgvs.lookup_keys(parts, F.col("gene"))).alias("k"), locus.alias("locus"), (F.col("assembly") == "GRCh38").alias("new")).select("k.key", "locus", "new")
    best = F.max("new").over(Window.partitionBy("key"))
    return keyed.withColumn("__b", best).where(F.col("new") == F.col("__b")).select("key", "locus").distinct()


def gff3(spark: SparkSession, path: str) -> DataFrame:
    """Features with the attributes in use; ids without their type prefix, the first of several parents, the first of repeated attributes."""
    raw = spark.read.text(path).where(~F.startswith("value", F.lit("#")) & (F.col("value") != ""))
    f = F.split("value", "\t")
    df = raw.where(F.size(f) >= 9).select(F.get(f, 0).alias("seq"), F.get(f, 2).alias("type"), F.get(f, 3).try_cast("long").alias("start"), F.get(f, 4).try_cast("long").alias("end"), F.get(f, 6).alias("strand"), F.split(F.get(f, 8), ";").alias("attrs")).where("start is not null and end is not null")
    attr = lambda name: F.nullif(F.trim(F.substring(F.get(F.filter("attrs", lambda a: F.startswith(F.trim(a), F.lit(f"{name}="))), 0), F.lit(len(name) + 2), F.lit(1 << 20))), F.lit(""))
    clean = lambda c: F.regexp_replace(F.split(c, ",")[0], r"^(?:gene|transcript|rna|exon|cds):", "")
    return df.select(
        hgvs.norm_chrom(F.col("seq")).alias("chrom"), F.lower("type").alias("type"), "start", "end", "strand", clean(attr("ID")).alias("id"), clean(attr("Parent")).alias("parent"),
        F.coalesce(attr("Name"), attr("gene")).alias("name"), F.coalesce(attr("biotype"), attr("gene_biotype")).alias("biotype"), attr("tag").alias("tag"), attr("version").alias("version"),
    ).where("chrom is not null")


def gff3_features(features: DataFrame) -> DataFrame:
    """Features with their gene and transcript: parents are resolved by joins, so file order does not matter; a parent may be the gene itself."""
    genes = features.where(F.col("type").isin("gene", "ncrna_gene", "pseudogene")).select(F.coalesce("id", "parent").alias("g_id"), F.coalesce("name", "id", "parent").alias("gene"), "biotype")
    named = genes.select(F.col("g_id").alias("t_id"), "gene", F.col("biotype").alias("g_biotype"), F.lit(None).cast("string").alias("transcript"))
    transcripts = features.where("parent is not null and id is not null").where(~F.col("type").isin("exon", "cds", "five_prime_utr", "three_prime_utr")).join(genes.drop("biotype"), F.col("parent") == F.col("g_id")).join(genes.select(F.col("g_id").alias("g2"), F.col("biotype").alias("g_biotype")), F.col("parent") == F.col("g2"))
    named = named.unionByName(transcripts.select(F.col("id").alias("t_id"), "gene", "g_biotype", F.col("id").alias("transcript")))
    parts = features.where(F.col("type").isin("exon", "cds", "five_prime_utr", "three_prime_utr")).join(named, F.col("parent") == F.col("t_id"), "left")
    parts = parts.select("chrom", "type", "start", "end", "strand", F.coalesce("gene", "name").alias("gene"), F.coalesce(F.nullif("g_biotype", F.lit("")), "biotype").alias("biotype"), "transcript")
    own = features.join(genes.select("g_id", "gene"), F.coalesce("id", "parent") == F.col("g_id")).where(F.col("type").isin("gene", "ncrna_gene", "pseudogene")).select("chrom", "type", "start", "end", "strand", "gene", "biotype", F.lit(None).cast("string").alias("transcript"))
    return own.unionByName(parts)


def mane_transcripts(raw: DataFrame) -> DataFrame:
    """gene, chrom, t, version, strand, exons and cds (sorted arrays of spans) of the transcripts tagged MANE_Select."""
    tagged = raw.where("type in ('mrna', 'transcript') and tag rlike 'MANE_Select'").select(F.col("id").alias("t"), F.col("parent").alias("__g"), "strand", "chrom", "version")
    span = F.struct("start", "end")
    parts = raw.where("type in ('exon', 'cds')").groupBy(F.col("parent").alias("t")).agg(*[F.sort_array(F.collect_set(F.when(F.col("type") == k, span))).alias(name) for k, name in (("exon", "exons"), ("cds", "cds"))])
    names = raw.where(F.col("type") == "gene").select(F.col("id").alias("__g"), F.upper(F.coalesce("name", "id")).alias("gene"))
    return tagged.join(parts, "t").join(names, "__g").select("gene", "chrom", "t", "version", "strand", "exons", "cds")


def cds_spans(raw: DataFrame) -> DataFrame:
    """First and last coding base per transcript (AGG-17)."""
    return raw.where("type = 'cds'").groupBy(F.col("parent").alias("t")).agg(F.min("start").alias("cds_start"), F.max("end").alias("cds_end"))


def fasta(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """(chrom, chunk_no, seq): fixed-width chunks for joins by position.

    Lines stay lines until their offset is known: contigs and offsets are carried from block to block of the files by one
    row per block and contig, so no task holds a whole contig.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i")).where("trim(value) <> ''")
    head = F.when(F.startswith("value", F.lit(">")), F.split(F.substring("value", 2, 1 << 20), r"\s+")[0])
    inside = Window.partitionBy("file", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("head", head).withColumn("own", F.last("head", ignorenulls=True).over(inside))
    blocks = lines.groupBy("file", "block").agg(F.max_by("own", "i").alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("file", "block", F.last("last", ignorenulls=True).over(before).alias("from_before"))
    bases = lines.where("head is null").join(carried, ["file", "block"]).withColumn("contig", F.coalesce("own", "from_before")).withColumn("s", F.upper(F.regexp_replace("value", r"\s+", "")))
    per = bases.groupBy("file", "contig", "block").agg(F.sum(F.length("s")).alias("n"))
    starts = per.select("file", "contig", "block", F.coalesce(F.sum("n").over(Window.partitionBy("file", "contig").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    so_far = F.coalesce(F.sum(F.length("s")).over(Window.partitionBy("file", "contig", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = bases.withColumn("__in", so_far).join(starts, ["file", "contig", "block"]).withColumn("at", F.col("offset") + F.col("__in"))
    cut = placed.withColumn("chunk_no", F.explode(F.sequence(F.floor(F.col("at") / chunk), F.floor((F.col("at") + F.length("s") - 1) / chunk))))
    lo = F.greatest(F.col("chunk_no") * chunk - F.col("at"), F.lit(0)).cast("int")
    hi = F.least((F.col("chunk_no") + 1) * chunk - F.col("at"), F.length("s")).cast("int")
    pieces = cut.select(hgvs.norm_chrom(F.col("contig")).alias("chrom"), F.col("chunk_no").cast("int").alias("chunk_no"), (F.col("at") + lo).alias("o"), F.substring("s", lo + 1, hi - lo).alias("s"))
    return pieces.groupBy("chrom", "chunk_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o", "s"))), lambda x: x["s"]), "").alias("seq"))


def contig_lengths(sequence: DataFrame) -> DataFrame:
    """(chrom, length) of a sequence table."""
    return sequence.groupBy("chrom").agg(F.sum(F.length("seq")).cast("long").alias("length"))


def fetch_bases(df: DataFrame, sequence: DataFrame, chrom: str, start: str, end: str, out: str, chunk: int = CHUNK) -> DataFrame:
    """Bases start..end (1-based, closed) of each row: a join on (chrom, chunk), two chunks where a span crosses."""
    rows = df.withColumn("__row", F.monotonically_increasing_id()).withColumn("chunk_no", F.explode(F.sequence(F.floor((F.col(start) - 1) / chunk), F.floor((F.col(end) - 1) / chunk))))
    seq = sequence.select(F.col("chrom").alias("__c"), F.col("chunk_no").cast("long").alias("__n"), "seq")
    lo = F.greatest(F.col(start) - F.col("chunk_no") * chunk, F.lit(1)).cast("int")
    hi = F.least(F.col(end) - F.col("chunk_no") * chunk, F.lit(chunk)).cast("int")
    hit = rows.join(seq, (F.col(chrom) == F.col("__c")) & (F.col("chunk_no") == F.col("__n")), "left").select(*df.columns, "__row", "chunk_no", F.substring("seq", lo, hi - lo + 1).alias("__s"))
    joined = hit.groupBy("__row", *df.columns).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_no", "__s"))), lambda x: x["__s"]), "").alias(out))
    return joined.select(*df.columns, F.when((F.col(start) >= 1) & (F.length(out) == F.col(end) - F.col(start) + 1), F.col(out)).alias(out))


def bioc_passages(df: DataFrame, payload: str) -> DataFrame:
    """Passages of the first document of a BioC JSON payload."""
    parsed = F.from_json(payload, BIOC)
    out = df.select(*[c for c in df.columns if c != payload], F.posexplode(parsed["documents"][0]["passages"]).alias("idx", "p"))
    return out.select(*[c for c in df.columns if c != payload], "idx", F.col("p.infons")["section_type"].alias("section_type"), F.col("p.infons")["type"].alias("passage_type"), F.col("p.text").alias("text"), F.col("p.offset").alias("offset"))


def source_cascade(candidates: DataFrame, key: str, preference: list[str]) -> DataFrame:
    """The first source by preference with 2 passages and 2,500 characters, else the last non-empty one."""
    place = F.create_map(*[F.lit(x) for i, s in enumerate(preference) for x in (s, i)])[F.col("source")]
    stats = candidates.groupBy(key, "source").agg(F.count("*").alias("n_passages"), F.sum(F.length("text")).alias("n_chars")).withColumn("__at", place)
    ok = (F.col("n_passages") >= 2) & (F.col("n_chars") >= 2500)
    choice = stats.groupBy(key).agg(F.min_by("source", F.struct(F.when(ok, 0).otherwise(1), F.when(ok, F.col("__at")).otherwise(-F.col("__at")))).alias("source"))
    return candidates.join(choice, [key, "source"], "left_semi")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and size of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def dbsnp_alleles(df: DataFrame, payload: str, rs: str) -> DataFrame:
    """Alleles of RefSNP JSON payloads: (rs, is_ptlp, seq_id, pos, ref, alt); SPDI positions become 1-based."""
    schema = "primary_snapshot_data struct<placements_with_allele array<struct<seq_id string, is_ptlp boolean, alleles array<struct<allele struct<spdi struct<seq_id string, position long, deleted_sequence string, inserted_sequence string>>>>>>>"
    placements = df.select(rs, F.explode(F.from_json(payload, schema)["primary_snapshot_data"]["placements_with_allele"]).alias("pl"))
    alleles = placements.select(rs, F.col("pl.is_ptlp").alias("is_ptlp"), F.explode("pl.alleles.allele.spdi").alias("s"))
    return alleles.where("s.deleted_sequence <> s.inserted_sequence").select(rs, "is_ptlp", F.col("s.seq_id").alias("seq_id"), (F.col("s.position") + 1).alias("pos"), F.col("s.deleted_sequence").alias("ref"), F.col("s.inserted_sequence").alias("alt"))


def dbsnp_genes(df: DataFrame, payload: str, rs: str) -> DataFrame:
    """(rs, gene, gene_id) of RefSNP payloads, distinct; ``unique_gene`` is set where a payload names one gene only (GEN-11)."""
    schema = "primary_snapshot_data struct<allele_annotations array<struct<assembly_annotation array<struct<genes array<struct<locus string, id bigint, name string>>>>>>>"
    genes = F.flatten(F.flatten(F.transform(F.from_json(payload, schema)["primary_snapshot_data"]["allele_annotations"], lambda a: a["assembly_annotation"]["genes"])))
    rows = df.select(rs, F.explode(genes).alias("g")).select(rs, F.upper(F.trim("g.locus")).alias("gene"), F.col("g.id").alias("gene_id")).where("gene <> ''").groupBy(rs, "gene").agg(F.max("gene_id").alias("gene_id"))
    return rows.withColumn("unique_gene", F.when(F.count("*").over(Window.partitionBy(rs)) == 1, F.col("gene")))


def dbsnp_frequencies(df: DataFrame, payload: str, rs: str) -> DataFrame:
    """(rs, seq_id, ref, alt, study, count, total) of RefSNP payloads (AGG-15)."""
    schema = "primary_snapshot_data struct<allele_annotations array<struct<frequency array<struct<study_name string, allele_count double, total_count double, observation struct<seq_id string, deleted_sequence string, inserted_sequence string>>>>>>"
    rows = F.flatten(F.from_json(payload, schema)["primary_snapshot_data"]["allele_annotations"]["frequency"])
    f = df.select(rs, F.explode(rows).alias("f"))
    return f.select(rs, F.col("f.observation.seq_id").alias("seq_id"), F.upper("f.observation.deleted_sequence").alias("ref"), F.upper("f.observation.inserted_sequence").alias("alt"), F.col("f.study_name").alias("study"), F.col("f.allele_count").alias("count"), F.col("f.total_count").alias("total"))


def dbsnp_movements(df: DataFrame, payload: str, rs: str) -> DataFrame:
    """(rs, seq_id, ref, alt, weight): observations, ClinVar ones counting three."""
    at = "struct<seq_id string, deleted_sequence string, inserted_sequence string>"
    rows = df.select(rs, F.explode(F.from_json(payload, f"present_obs_movements array<struct<allele_in_cur_release {at}, observation {at}, component_ids array<struct<type string>>>>")["present_obs_movements"]).alias("m"))
    o = F.coalesce(F.col("m.allele_in_cur_release"), F.col("m.observation"))
    weight = F.aggregate(F.coalesce(F.col("m.component_ids.type"), F.array().cast("array<string>")), F.lit(0), lambda w, t: w + F.when(F.lower(t) == "clinvar", 3).otherwise(1))
    return rows.select(rs, o["seq_id"].alias("seq_id"), F.upper(o["deleted_sequence"]).alias("ref"), F.upper(o["inserted_sequence"]).alias("alt"), F.greatest(weight, F.lit(1)).alias("weight"))


class _Record:
    """One article's fields, each out of the first element of its path; an abstract out of all its pieces of text."""

    PATHS = {
        ("MedlineCitation", "PMID"): "pmid", ("Journal", "Title"): "journal", ("Journal", "ISOAbbreviation"): "journal_iso", ("Journal", "ISSN"): "issn",
        ("JournalIssue", "PubDate", "Year"): "year", ("JournalIssue", "PubDate", "Month"): "month",
    }
    IDS = {"doi": "doi", "pmc": "pmcid"}

    def __init__(self) -> None:
        self.stack: list[tuple[str, str | None, int]] = [("", None, 0), ("", None, 0)]  # name, field, first piece
        self.parts: list[str] = []
        self.fields: dict[str, str] = {}
        self.abstract: list[str] = []
        self.cut = True  # the next piece of an abstract is a text of its own

    def start(self, tag: str, attributes: dict) -> None:
        parent = self.stack[-1][0]
        field = "title" if tag == "ArticleTitle" else self.IDS.get(attributes.get("IdType")) if tag == "ArticleId" else self.PATHS.get((parent, tag)) or self.PATHS.get((self.stack[-2][0], parent, tag))
        if field in self.fields:
            field = None
        elif field:
            self.fields[field] = ""
        self.stack.append((tag, field, len(self.parts)))
        self.cut = True

    def end(self, _tag: str) -> None:
        _, field, first = self.stack.pop()
        if field:
            self.fields[field] = "".join(self.parts[first:]).strip(" ")
        self.cut = True

    def text(self, data: str) -> None:
        self.parts.append(data)
        if self.stack[-1][0] == "AbstractText" and self.stack[-2][0] == "Abstract":
            if self.cut:
                self.abstract.append(data)
            else:
                self.abstract[-1] += data
            self.cut = False

    def between(self, *_: str) -> None:
        self.cut = True


def pubmed_record(xml: str | None) -> dict[str, str | None]:
    """Fields of an article's XML by one reading; none of a null or empty text, an error on what is no XML."""
    if not xml:
        return {}
    record, parser = _Record(), expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = record.start, record.end, record.text
    parser.CommentHandler = parser.ProcessingInstructionHandler = record.between
    parser.Parse(xml, True)
    return {k: v or None for k, v in record.fields.items()} | {"abstract": " ".join(record.abstract)}


_RECORD = T.StructType([T.StructField(n, _S) for n in ("pmid", "title", "abstract", "journal", "journal_iso", "issn", "year", "month", "doi", "pmcid")])


@F.pandas_udf(_RECORD)
def _pubmed_records(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([pubmed_record(x) for x in texts], columns=_RECORD.fieldNames(), dtype=object)


def efetch_articles(df: DataFrame, xml: str) -> DataFrame:
    """Article records out of PubMed XML, one article per row, read once and on all cores (SRC-11)."""
    r = F.col("__r")
    fields = [r[n].alias(n) for n in _RECORD.fieldNames() if n not in ("year", "month", "doi", "pmcid")]
    return R.spread(df).select(_pubmed_records(F.expr(xml)).alias("__r")).select(*fields, F.struct(r["year"].alias("year"), r["month"].alias("month")).alias("pub_date"), r["doi"].alias("doi"), r["pmcid"].alias("pmcid"))


def cached_source(candidates: DataFrame, key: str, stated: str = "stated_source") -> DataFrame:
    """Passages of the source an article was parsed from, else of its cached page, else of its cached record (SRC-17)."""
    wanted = F.when(F.contains(F.col(stated), F.col("source")), 0).when(F.col("source") == "pmc_html", 1).when(F.col("source") == "bioc", 2)
    ranked = candidates.withColumn("__w", wanted).where("__w is not null")
    best = ranked.groupBy(key).agg(F.min(F.struct("__w", "source")).alias("m")).select(key, F.col("m.source").alias("source"))
    return ranked.drop("__w").join(best, [key, "source"], "left_semi")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """file, length and SHA-256 of reference files, by name (SRC-23)."""
    return file_hashes(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", "sha256").orderBy("file")


def preflight(spark: SparkSession, paths: list[str]) -> None:
    """Stop before a run whose inputs are missing (FIL-09)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    missing = [p for p in paths if not hadoop(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop(p))]
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))


def seed_cache(spark: SparkSession, source: str, target: str, ids: list[str]) -> int:
    """Copy the cached files of some articles, by id in the name, where the target lacks them (SRC-24); returns how many."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    a, b = hadoop.Path(source), hadoop.Path(target)
    files, to = a.getFileSystem(conf), b.getFileSystem(conf)
    to.mkdirs(b)
    copied = 0
    for i in ids:
        for status in files.globStatus(hadoop.Path(f"{source}/*{i}*")) or []:
            goal = hadoop.Path(b, status.getPath().getName())
            if not to.exists(goal):
                copied += bool(hadoop.FileUtil.copy(files, status.getPath(), to, goal, False, conf))
    return copied
