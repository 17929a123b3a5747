"""The stages of the funnel as DataFrame -> DataFrame functions, and a runner over them."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lociflow.functions import genes, hgvs, spans, text
from lociflow.functions import patterns as P
from lociflow.operators import relational as R
from lociflow.operators.tables import file_system, read_text, write_text, written
from lociflow.plans.gates import Gate, apply_gates, gate_counts, review_gates, review_score, settings_of


def link_articles(articles: DataFrame) -> DataFrame:
    """Articles (pmid, title, abstract, ...) to variant-phenotype links with a gene."""
    rows = R.spread(articles).withColumn("text", F.trim(F.concat_ws(" ", "title", "abstract")))
    keep = [c for c in ("pmid", "text", "journal", "journal_iso", "issn", "pub_date", "ord") if c in rows.columns]
    linked = spans.explode_links(rows, "text", keep)
    bound = genes.gene_for(F.col("evidence_sentence"), F.col("variant"), F.lit(None).cast("string"))
    return linked.withColumn("__g", bound).withColumn("gene", F.col("__g.gene")).withColumn("gene_rule", F.col("__g.rule")).withColumn("gene_source", F.when(F.col("gene").isNotNull(), "row_gene")).withColumn("evidence_source", F.lit("abstract")).drop("__g")


def discover(links: DataFrame) -> DataFrame:
    """Discovery labels on the evidence sentence, publication keys and first-in-corpus flags."""
    df = text.with_discovery(links.withColumn("__e", F.when(text.blank(F.col("evidence_sentence")), F.col("text")).otherwise(F.col("evidence_sentence"))), "__e", "variant").drop("__e")
    if "pub_date" in df.columns:
        df = df.withColumn("paper_pub_date", text.pub_date_key(F.col("pub_date.year"), F.col("pub_date.month")))
    else:
        df = df.withColumn("paper_pub_date", F.lit(None).cast("string"))
    return R.first_in_group(df.withColumn("__v", hgvs.norm_var(F.col("variant"))), "__v", "paper_pub_date").drop("__v").withColumnRenamed("first_date", "variant_first_seen_in_corpus").withColumnRenamed("is_first", "is_first_in_corpus")


def match_reference(rows: DataFrame, reference_keys: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Route against a reference table (key, locus): known, absent, or unresolvable without a key."""
    keyed = rows.withColumn("lookup_keys", hgvs.lookup_keys(hgvs.components(F.col("variant")), F.col("gene")))
    out = R.ladder_lookup(keyed, row_id, F.col("lookup_keys"), reference_keys, "key", "locus")
    return out.withColumn("route", F.when(F.size("lookup_keys") == 0, "unresolvable").when(F.col("match_status") == "missing", "absent").otherwise("known"))


def review(rows: DataFrame, tiers: tuple[str, ...] = ("A", "B"), order: str = "row_id") -> DataFrame:
    """Gated rows, best per gene and variant, with review_tier strict (A) or extended."""
    passed = apply_gates(rows, review_gates(tiers)).withColumn("locus_key", F.concat(F.coalesce("gene", F.lit("")), F.lit("|"), F.lower("variant")))
    best = R.best_per_key(passed, ["locus_key"], review_score(), order)
    return best.withColumn("review_tier", F.when(F.col("tier") == "A", "strict").otherwise("extended"))


def rank_journals(rows: DataFrame, journals: DataFrame) -> DataFrame:
    """ISSN, then ISO name, then name; tier score plus a bonus for full text."""
    table = R.last_wins(journals, ["alias_key"], "ord")
    keys = [("issn", F.nullif(text.normalize_issn(F.col("issn")), F.lit(""))), ("journal_iso_alias", text.normalize_name(F.col("journal_iso"))), ("journal_alias", text.normalize_name(F.col("journal")))]
    out = R.alternative_key_join(rows, keys, table, "alias_key", ["canonical_name", "tier_name"])
    tier = F.coalesce("tier_name", F.lit("C"))
    score = F.create_map(*[F.lit(x) for kv in P.JOURNAL_SCORES.items() for x in kv])[tier] + F.when(F.col("evidence_source") == "fulltext", P.FULLTEXT_BONUS).otherwise(0)
    return out.withColumn("journal_tier", tier).withColumn("journal_priority_score", score).drop("tier_name")


def label_pathogenicity(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Labels from the cached text of the article, read once for all rows of one article, gene and variant.

    Whole texts are never broadcast: an estimate of their size knows nothing of what a column makes of them.
    """
    keys = ["pmid", "gene", "variant"]
    asked = rows.select(*keys).distinct().join(texts.select("pmid", "cached_text").hint("merge"), "pmid", "left")
    verdict = text.pathogenicity(F.col("cached_text"), F.col("gene"), F.col("variant"))
    labels = asked.select(*[F.col(k).alias(f"__{k}") for k in keys], verdict.alias("pathogenicity"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return rows.join(labels.hint("merge"), same).select("pmid", *[c for c in rows.columns if c != "pmid"], "pathogenicity")


def _rank(column: str, table: dict) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col(column)], F.lit(9))


def locus_key(gene: Column, variant: Column) -> Column:
    """GENE or NA, and the longest search term of four characters or more (the first among equals)."""
    terms = F.filter(text.search_terms(variant), lambda t: F.length(t) >= 4)
    longest = F.get(F.filter(terms, lambda t: F.length(t) == F.array_max(F.transform(terms, lambda x: F.length(x)))), 0)
    g = F.upper(F.trim(F.coalesce(gene, F.lit(""))))
    return F.concat(F.when(g == "", "NA").otherwise(g), F.lit("|"), F.lower(F.regexp_replace(F.coalesce(longest, F.trim(F.coalesce(variant, F.lit("")))), r"[\s()]", "")))


def negative_alleles(articles: DataFrame, anchors: DataFrame, positives: DataFrame, independent: bool = False) -> DataFrame:
    """Negative evidence beside each anchor, without positives, best per paper and then per locus.

    ``independent`` renames the role of other sites in a paper, as for runs without positives beside them.
    """
    named = anchors.select("pmid", F.col("variant").alias("anchor"), *(["gene"] if "gene" in anchors.columns else [F.lit(None).cast("string").alias("gene")])).withColumnRenamed("gene", "anchor_gene")
    found = R.dealt(articles.join(named, "pmid")).select("pmid", "anchor_gene", F.explode(spans.negatives(F.col("text"), F.col("anchor"))).alias("n")).select("pmid", "anchor_gene", "n.*")
    found = found.withColumn("gene", genes.gene_of_negative("evidence", "variant", "anchor_gene")).drop("anchor_gene")
    if independent:
        found = found.withColumn("role", F.when(F.col("role") == "same_paper_other_site", "corpus_benign_mention").otherwise(F.col("role")))
    # the order of a hit: its paper and sentence, then what it says
    found = found.withColumn("row_id", F.struct("pmid", "sentence_no", "rule", "variant", "label", "role", "gene"))
    found = written(found, "negatives")  # read twice below: texts are searched once
    low = F.lower("variant")
    keys = [F.lower(locus_key(F.col("gene"), F.col("variant"))), F.concat(F.lower("gene"), F.lit("|"), low), F.concat(F.lit("|"), low)]
    excluded = positives.select(F.explode(F.array(F.lower(locus_key(F.col("gene"), F.col("variant"))), F.concat(F.lower(F.coalesce("gene", F.lit(""))), F.lit("|"), low), F.concat(F.lit("|"), low))).alias("k"))
    # keys are names of a gene and a variant: each pair is looked up once, not each hit
    pairs = found.select("gene", "variant").distinct().withColumn("pair", F.struct("gene", "variant"))
    stays = R.anti_any_key(pairs, "pair", keys, excluded, "k").select(F.col("gene").alias("__g"), F.col("variant").alias("__v"))
    kept = found.join(stays, F.col("gene").eqNullSafe(F.col("__g")) & (F.col("variant") == F.col("__v")), "left_semi")
    sure = F.create_map(*[F.lit(x) for x in ("high", 0, "medium", 1, "low", 2)])[F.col("confidence")]
    paper = R.best_per_key(kept, ["pmid", "variant"], [_rank("role", P.ROLE_PRIORITY), _rank("label", P.LABEL_PRIORITY), sure], "row_id")
    paper = paper.withColumn("negative_locus_key", locus_key(F.col("gene"), F.col("variant")))
    best = R.best_per_key(paper, ["negative_locus_key"], [_rank("label", P.LABEL_PRIORITY), _rank("role", P.ROLE_PRIORITY), sure], "row_id")
    tier = text.negative_link_tier(F.lit(None).cast("string"), F.col("variant"), F.col("evidence"), F.col("rule"))
    return best.withColumn("__t", tier).withColumn("link_tier", F.col("__t.tier")).withColumn("link_reason", F.col("__t.reason")).drop("__t", "row_id")


#: Features up to this length are cut into narrow bins, longer ones into wide ones.
SHORT_FEATURE, NARROW_BIN = 8192, 8192


def region_of(rows: DataFrame, features: DataFrame, row_id: str = "row_id", catalog_gene: str | None = None) -> DataFrame:
    """Region class of the strongest overlapping features, with the genes and transcripts of that class only (HGV-24).

    CDS, then UTR, exon of a protein gene, protein gene (intron), exon and gene of non-coding RNA, pseudogene, other gene
    (intron); no feature is intergenic, and a row without coordinates has empty fields.
    """
    spans_ = rows.where("chrom is not null and pos is not null").select(row_id, F.col("chrom"), F.col("pos").alias("lo"), (F.col("pos") + F.greatest(F.length(F.coalesce("ref", F.lit("N"))), F.lit(1)) - 1).alias("hi"))
    transcript = F.col("transcript") if "transcript" in features.columns else F.lit(None).cast("string")
    known = features.select("chrom", F.lower("type").alias("type"), F.col("start").alias("f_lo"), F.col("end").alias("f_hi"), "gene", "biotype", transcript.alias("transcript"))
    short = F.col("f_hi") - F.col("f_lo") < SHORT_FEATURE
    parts = [R.interval_join(spans_, known.where(c), "chrom", ("lo", "hi"), ("f_lo", "f_hi"), width) for c, width in ((short, NARROW_BIN), (~short, R.BIN_SIZE))]
    hits = parts[0].unionByName(parts[1])
    b = F.coalesce(F.col("biotype"), F.lit(""))
    kind = F.when(b.isin(*P.PROTEIN_BIOTYPES), "protein").when(b.isin(*P.NCRNA_BIOTYPES), "ncrna").when(F.contains(F.lower(b), F.lit("pseudogene")), "pseudo").otherwise("other")
    is_gene, is_exon = F.col("type").isin(*P.GENE_TYPES), F.col("type") == "exon"
    classes = [
        (F.col("type") == "cds", "coding", "CDS"), (F.col("type").rlike("utr"), "utr", "UTR"), (is_exon & (kind == "protein"), "utr", "exon"), (is_gene & (kind == "protein"), "intron", "gene"),
        (is_exon & (kind == "ncrna"), "ncrna_exon", "exon"), (is_gene & (kind == "ncrna"), "ncrna_gene", "gene"), (is_gene & (kind == "pseudo"), "pseudogene", "gene"), (is_gene, "intron", "gene"),
    ]
    rank = F.when(classes[0][0], 0)
    for i, (c, _, _) in enumerate(classes[1:], 1):
        rank = rank.when(c, i)
    named = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit("")))), ";")
    per = hits.withColumn("__rank", rank).where("__rank is not null").groupBy(row_id, "__rank").agg(named("gene").alias("g"), named("transcript").alias("t"))
    best = per.groupBy(row_id).agg(F.min(F.struct("__rank", "g", "t")).alias("m"))
    value = lambda k: F.element_at(F.array(*[F.lit(c[k]) for c in classes]), F.col("m.__rank") + 1)
    found = best.select(row_id, value(1).alias("genomic_region"), F.col("m.g").alias("genomic_region_genes"), value(2).alias("genomic_region_feature"), F.when(F.col("m.__rank").isin(0, 1, 2, 4), F.col("m.t")).otherwise("").alias("genomic_region_transcripts"))
    out = rows.join(found, row_id, "left")
    placed = F.col("chrom").isNotNull() & F.col("pos").isNotNull()
    out = out.withColumn("genomic_region", F.when(placed, F.coalesce("genomic_region", F.lit("intergenic"))).otherwise(""))
    out = out.withColumns({c: F.coalesce(c, F.lit("")) for c in ("genomic_region_genes", "genomic_region_feature", "genomic_region_transcripts")})
    cat = F.upper(F.trim(F.coalesce(F.col(catalog_gene), F.lit("")))) if catalog_gene else F.lit("")
    names = F.col("genomic_region_genes")
    elsewhere = F.concat(F.lit("catalog_gene "), cat, F.lit(" not overlapping position; "))
    note = F.when((cat == "") | ~placed, "").when(F.col("genomic_region") == "intergenic", F.concat(elsewhere, F.lit("intergenic"))).when((names != "") & ~F.array_contains(F.split(F.upper(names), ";"), cat), F.concat(elsewhere, F.lit("GFF3="), F.replace(names, F.lit(";"), F.lit(",")))).otherwise("")
    return out.withColumn("genomic_region_note", note)


def new_sites(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Drop bare rs rows unless the article writes a c. name with that rs; fills c_hgvs and a reason (FIL-07)."""
    found = articles.select("pmid", F.explode(spans.pairs(F.col("text"))).alias("p")).select("pmid", F.lower("p.name").alias("__rs"), F.col("p.partner").alias("__c")).where("__rs like 'rs%' and __c like 'c.%'")
    found = found.groupBy("pmid", "__rs").agg(F.min("__c").alias("paired_c"))
    out = rows.withColumn("__rs", F.lower("variant")).join(found, ["pmid", "__rs"], "left")
    bare = F.col("__rs").rlike(r"^rs\d+$")
    reason = F.when(~bare, "concrete_name").when(F.col("paired_c").isNotNull(), "rs_with_paired_c").otherwise("bare_rs")
    return out.withColumn("site_reason", reason).withColumn("kept", F.col("site_reason") != "bare_rs").drop("__rs")


def link_full_text(passages: DataFrame, articles: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Passages (pmid, idx, section_type, passage_type, text) to links with upgraded clinical text and a gene (TXT-15).

    Variants of the abstract and of all passages are looked for in every passage; links of passages come before links of
    known variants, and the first per variant and evidence stays.  ``articles``: pmid, title, abstract, pubtator (JSON).
    """
    body = passages.where(text.usable_passage(F.col("section_type"), F.col("passage_type"), F.col("text")) & text.in_body(F.col("section_type")))
    scanned = body.select("pmid", "idx", spans.variants_scanned("text").alias("v"))
    # in the order of the passages; a filter on what was found would search twice, and below the deal of a small scan
    found = scanned.groupBy("pmid").agg(F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("idx", "v"))), lambda x: x["v"]))).alias("found"))
    own = articles if known is None else articles.join(known, "pmid", "left")
    seeds = own.select("pmid", "title", "abstract", "pubtator", (F.coalesce("known", F.array().cast("array<string>")) if known is not None else spans.variants_scanned(F.concat_ws(" ", "title", "abstract"))).alias("own"))
    rows = body.join(seeds, "pmid").join(found, "pmid", "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))
    rows = R.dealt(rows)
    new = R.only_in(F.col("found"), F.col("own"))
    both = F.concat(
        F.transform(spans.links_in_passage("text"), lambda x: F.struct(F.lit(0).alias("kind"), x.alias("l"))),
        F.transform(spans.links_of_known("text", F.array_distinct(F.concat("own", "found"))), lambda x: F.struct(F.lit(1).alias("kind"), x.alias("l"))),
    )
    links = rows.select("pmid", "idx", "title", "abstract", "pubtator", F.col("section_type").alias("section"), F.col("text").alias("passage"), new.alias("new"), F.posexplode(both).alias("n", "x"))
    links = links.select("pmid", "idx", "n", "title", "abstract", "pubtator", "section", "passage", "new", "x.kind", "x.l.*")
    links = links.withColumn("variant", hgvs.variant_token(F.col("variant"))).where(text.is_concrete(F.col("variant")) | (F.col("method") == "fulltext_known_variant_sentence"))
    once = R.dealt(R.dedup_links(links.withColumn("__o", F.struct("kind", "idx", "n")), "__o").drop("__o"))
    better = spans.upgraded(F.struct("clinical", "clinical_subtype", "clinical_source", "tier"), "evidence_sentence", "passage", "title", "pubtator", "variant")
    once = once.withColumn("__u", better)
    once = once.withColumns({c: F.col(f"__u.{c}") for c in ("clinical", "clinical_subtype", "clinical_source", "tier")})
    bound = genes.gene_in_article("variant", "evidence_sentence", "title", "abstract", "passage", "pubtator", F.lit(None).cast("string"))
    once = once.withColumn("__g", bound).withColumn("gene", F.col("__g.gene")).withColumn("gene_rule", F.col("__g.rule"))
    once = once.withColumn("variant_discovered_in_fulltext", F.array_contains("new", F.col("variant"))).withColumn("evidence_source", F.lit("fulltext"))
    return once.drop("__u", "__g", "new", "kind", "n", "passage", "abstract", "pubtator")


def route_reference(rows: DataFrame, known_phenotypes: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Five routes of rows that ``match_reference`` has labelled (JN-08): absent, known with the same, a new or an unclear phenotype, unresolvable.

    ``known_phenotypes``: (locus, phenotype).  A phenotype agrees when one text contains the other, signs and case aside.
    """
    flat = lambda c: text.normalize_name(c)
    noted = known_phenotypes.where(~text.blank(F.col("phenotype"))).groupBy(F.col("locus").alias("__l")).agg(F.collect_set(flat(F.col("phenotype"))).alias("__known"))
    out = rows.join(noted, F.col("match_value") == F.col("__l"), "left").drop("__l")
    own = flat(F.col("clinical"))
    same = F.exists("__known", lambda k: F.contains(k, own) | F.contains(own, k))
    label = (
        F.when(F.col("route") == "unresolvable", "unresolvable")
        .when(F.col("route") == "absent", "absent")
        .when(F.col("__known").isNull() | (own == ""), "known_phenotype_unclear")
        .when(same, "known_same_phenotype")
        .otherwise("known_new_phenotype")
    )
    return out.withColumn("route", label).drop("__known")


class ChangedUpstream(RuntimeError):
    """What a resumed run builds on is missing or was made under other settings."""


@dataclass(frozen=True)
class Stage:
    """A stage, the tables that it reads (all before it, if not said), its gates and other settings that its result depends on."""

    run: Callable[[dict[str, DataFrame]], DataFrame]
    reads: tuple[str, ...] | None = None
    gates: tuple[Gate, ...] = ()
    settings: dict = field(default_factory=dict)


@dataclass
class Runner:
    """Runs named stages in order, functions or ``Stage``.

    With a ``folder`` every result is written there and reread, with a fingerprint of its gates, its settings and the fingerprints of what
    it reads.  A later run reuses finished results of the same fingerprint, unless ``force`` is set, so a changed gate
    runs its stage and what lies behind it.  The profile ``resume`` builds on finished results only: the stages before the
    first must stand with equal fingerprints.  ``reports`` has the counts of each stage's gates, made in the pass
    that writes it.  ``inputs`` names the versions of given tables.  Without a folder results are kept lazily.
    """

    stages: dict[str, Callable[[dict[str, DataFrame]], DataFrame] | Stage]
    tables: dict[str, DataFrame] = field(default_factory=dict)
    folder: str | None = None
    force: bool = False
    profile: str = "strict"
    declared: dict[str, dict[str, str]] = field(default_factory=dict)
    inputs: dict[str, str] = field(default_factory=dict)
    reports: dict[str, list[tuple[str, str, int, int]]] = field(default_factory=dict)

    def _stage(self, name: str) -> Stage:
        stage = self.stages[name]
        return stage if isinstance(stage, Stage) else Stage(stage)

    def fingerprint(self, name: str) -> str:
        """Of a stage's settings and all that it reads; of a given table, its version."""
        if name not in self.stages:
            return f"{name}:{self.inputs.get(name, '')}"
        stage, names = self._stage(name), list(self.stages)
        given = [t for t in self.tables if t not in self.stages]
        reads = stage.reads if stage.reads is not None else (*given, *names[: names.index(name)])
        profile = "custom" if self.profile == "resume" else self.profile  # a resumed run goes on with what custom wrote
        gates = settings_of(list(stage.gates), profile, self.declared.get(name))
        said = [name, gates, profile if stage.gates else "", stage.settings, [self.fingerprint(r) for r in sorted(reads)]]
        return hashlib.sha256(json.dumps(said, sort_keys=True, default=str).encode()).hexdigest()

    def _recorded(self, spark: SparkSession, path: str) -> dict | None:
        """What stands beside a finished result."""
        files, done = file_system(spark, f"{path}/_SUCCESS")
        _, note = file_system(spark, f"{path}.stage.json")
        return json.loads(read_text(spark, note.toString())) if files.exists(done) and files.exists(note) else None

    def run(self, first: str | None = None, last: str | None = None) -> dict[str, DataFrame]:
        names = list(self.stages)
        lo, hi = names.index(first) if first else 0, names.index(last) + 1 if last else len(names)
        spark = SparkSession.getActiveSession()
        for k, name in enumerate(names[:hi]):
            stage = self._stage(name)
            if self.folder is None:
                if k >= lo:
                    df = stage.run(self.tables)
                    self.tables[name] = apply_gates(df, list(stage.gates), self.profile, self.declared.get(name)) if stage.gates else df
                continue
            path, mark = f"{self.folder}/{name}", self.fingerprint(name)
            found = self._recorded(spark, path)
            same = found is not None and found["fingerprint"] == mark
            if k < lo and not same and self.profile == "resume":
                raise ChangedUpstream(f"{name} is {'of other settings or inputs' if found else 'not finished'}: run from it")
            if k < lo and not same and found is None:
                raise ChangedUpstream(f"{name} is not finished: run from it")
            if k >= lo and (not same or self.force):
                self._write(spark, stage, name, path, mark)
            elif found and found.get("gates"):
                self.reports[name] = [tuple(x) for x in found["gates"]]
            self.tables[name] = spark.read.parquet(path)
        return self.tables

    def _write(self, spark: SparkSession, stage: Stage, name: str, path: str, mark: str) -> None:
        df, counts = stage.run(self.tables), Observation()
        profile = "custom" if self.profile == "resume" else self.profile
        if stage.gates:
            df = apply_gates(df, list(stage.gates), profile, self.declared.get(name), counts)
        df.write.mode("overwrite").parquet(path)
        if stage.gates:
            self.reports[name] = gate_counts(counts, list(stage.gates), profile, self.declared.get(name))
        write_text(spark, f"{path}.stage.json", json.dumps({"fingerprint": mark, "gates": self.reports.get(name)}))

    def only(self, pmid: str) -> Runner:
        """The same stages over one article."""
        return Runner(self.stages, {k: t.where(F.col("pmid") == pmid) if "pmid" in t.columns else t for k, t in self.tables.items()}, profile=self.profile, declared=self.declared)
