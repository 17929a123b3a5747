"""Command line: ``python -m lociflow COMMAND ...`` over files that Spark can read."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, path: str) -> DataFrame:
    from lociflow.sources import readers

    if path.endswith((".csv", ".tsv")):
        return readers.csv(spark, path, "\t" if path.endswith(".tsv") else ",")
    return spark.read.parquet(path) if path.rstrip("/").endswith((".parquet", ".pq")) else readers.jsonl(spark, path)


def _placed(df: DataFrame, name: str = "ord") -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.monotonically_increasing_id())


def _json(df: DataFrame, out: str) -> int:
    df.write.mode("overwrite").json(out)
    return 0


def _table(df: DataFrame, out: str) -> int:
    df.write.mode("overwrite").csv(out, header=True)
    return 0


def compare(spark: SparkSession, a: argparse.Namespace) -> int:
    """Candidates against a gold table; 1 when a whole gold allele is not met."""
    from lociflow.operators import relational as R

    def shaped(path: str) -> DataFrame:
        df = _read(spark, path)
        at = lambda *names: F.trim(F.coalesce(*[F.col(n).cast("string") for n in names if n in df.columns], F.lit("")))
        return df.select(
            at("pmid").alias("pmid"), F.upper(at("gene")).alias("gene"), F.replace(F.lower(at("variant_text", "variant")), F.lit(" "), F.lit("")).alias("variant"), at("chromosome_ucsc", "chromosome").alias("chrom"),
            at("position").alias("pos"), F.upper(at("ref")).alias("ref"), F.upper(at("alt")).alias("alt"), F.monotonically_increasing_id().alias("ord"),
        )

    report = R.gold_report(shaped(a.candidate), shaped(a.gold), ["pmid", "gene", "variant"], ["chrom", "pos", "ref", "alt"], "ord").first().asDict()
    print(json.dumps(report, indent=2))
    return int(report["genomic_exact_match"] != report["gold_with_4col"])


def bootstrap(spark: SparkSession, a: argparse.Namespace) -> int:
    """Manifest of reference files."""
    from lociflow.sources import readers

    return _json(readers.manifest(spark, a.reference), a.out)


def stamp(spark: SparkSession, a: argparse.Namespace) -> int:
    """Source of evidence on every row."""
    from lociflow.plans import delivery

    return _json(delivery.stamp(_read(spark, a.input)), a.out)


def link(spark: SparkSession, a: argparse.Namespace) -> int:
    """Links of abstracts."""
    from lociflow.plans import stages

    return _json(stages.link_articles(_read(spark, a.articles)), a.out)


def enrich(spark: SparkSession, a: argparse.Namespace) -> int:
    """Links of full texts: JATS, HTML, BioC or plain text by pmid (column ``body``)."""
    from lociflow.plans import stages
    from lociflow.sources import readers

    bodies = _read(spark, a.fulltext).select("pmid", "body")
    if a.format == "bioc":
        passages = readers.bioc_passages(bodies, "body").select("pmid", "idx", "section_type", "passage_type", "text")
    else:
        passages = {"jats": readers.jats_passages, "html": readers.html_passages, "plain": readers.plain_passages}[a.format](bodies, "body", "pmid")
    articles = _read(spark, a.articles)
    missing = [F.lit(None).cast("string").alias(c) for c in ("title", "abstract", "pubtator") if c not in articles.columns]
    return _json(stages.link_full_text(passages, articles.select("*", *missing)), a.out)


def materialize(spark: SparkSession, a: argparse.Namespace) -> int:
    """Cached text of articles out of body, links and abstract."""
    from lociflow.sources import sinks

    return _json(sinks.text_cache(_read(spark, a.input), "body", "links", "abstract"), a.out)


def discovery(spark: SparkSession, a: argparse.Namespace) -> int:
    """Discovery labels of links."""
    from lociflow.plans import stages

    return _json(stages.discover(_read(spark, a.links)), a.out)


def filter_rows(spark: SparkSession, a: argparse.Namespace) -> int:
    """Review gates and the best row per locus; with a profile of declared states, and the gates' counts on standard output."""
    from pyspark.sql import Observation

    from lociflow.plans import gates, stages

    rows, declared = _placed(_read(spark, a.links), "row_id"), json.loads(a.gates) if a.gates else None
    tiers = ("A",) if a.tier == "strict" else ("A", "B")
    if a.profile == "strict":
        return _json(stages.review(rows, tiers), a.out)
    counts = Observation()
    _json(gates.apply_gates(rows, gates.review_gates(tiers), a.profile, declared, counts), a.out)
    print(json.dumps(gates.gate_counts(counts, gates.review_gates(tiers), a.profile, declared)))
    return 0


def journal(spark: SparkSession, a: argparse.Namespace) -> int:
    """Journal tiers and scores."""
    from lociflow.plans import stages

    return _json(stages.rank_journals(_read(spark, a.input), _placed(_read(spark, a.journals))), a.out)


def pathogenicity(spark: SparkSession, a: argparse.Namespace) -> int:
    """Pathogenicity labels out of cached texts."""
    from lociflow.plans import stages

    return _json(stages.label_pathogenicity(_read(spark, a.input), _read(spark, a.texts)), a.out)


def negatives(spark: SparkSession, a: argparse.Namespace) -> int:
    """Negative alleles beside the anchors of articles."""
    from lociflow.plans import stages

    return _json(stages.negative_alleles(_read(spark, a.articles), _read(spark, a.anchors), _read(spark, a.positives), a.independent), a.out)


def export(spark: SparkSession, a: argparse.Namespace) -> int:
    """Variants to alleles by a reference table, one row per allele, with a contract beside it."""
    from lociflow.operators import index_table, resolver
    from lociflow.operators.tables import write_text, written
    from lociflow.plans import delivery
    from lociflow.sources import sinks

    rows = _placed(_read(spark, a.input), "row_id")
    missing = [F.lit("").alias(c) for c in ("evidence", "cached_text") if c not in rows.columns]
    if a.index:
        index = index_table.read_index(spark, a.index)
    else:
        index = resolver.reference_index(_read(spark, a.reference))
    # written: the ladder is run once, and what follows starts from a plain table
    resolved = written(resolver.resolve(rows.select("*", *missing), index), "resolved")
    found = delivery.export_rows(resolved).withColumn("row_id", F.col("row_id").cast("long"))
    best = written(delivery.dedup_export(found, "row_id").drop("row_id", "place"), "export")
    sinks.write_table(best, a.out, sinks.EXPORT_FIELDS)
    write_text(spark, f"{a.out}.contract.json", sinks.export_contract(best))
    return 0


def deliver(spark: SparkSession, a: argparse.Namespace) -> int:
    """Steps of a delivery: new sites, the narrative of every row, review pages, rows that a person has passed."""
    from lociflow.operators import relational as R
    from lociflow.plans import delivery, stages
    from lociflow.sources import sinks

    rows = _placed(_read(spark, a.input))
    steps = ("new-site", "audit", "html", "review-export") if a.step == "all" else (a.step,)
    if "new-site" in steps:
        rows = stages.new_sites(rows, _read(spark, a.articles)).where("kept") if a.articles else rows
        _json(rows, f"{a.out}/new_site")
    if "audit" in steps:
        rows = R.audit_ids(delivery.with_narrative(rows), [c for c in ("sample_class", "pmid") if c in rows.columns], "ord")
        _json(rows, f"{a.out}/audit")
    if "html" in steps:
        sinks.review_pages(rows, "Review", "ord").write.mode("overwrite").partitionBy("page").text(f"{a.out}/html")
    if "review-export" in steps and a.notes:
        sinks.write_table(delivery.reviewed(rows, _placed(_read(spark, a.notes), "no"), "ord", "no"), f"{a.out}/review_export", [*sinks.EXPORT_FIELDS, "human_verdict", "human_comment", "region_used"])
    return 0


def pipeline(spark: SparkSession, a: argparse.Namespace) -> int:
    """All stages over articles, or over one of them; resumable by stage."""
    from lociflow.plans import stages
    from lociflow.sources import readers

    readers.preflight(spark, [a.articles])
    articles = _read(spark, a.articles)
    if getattr(a, "pmid", None):
        articles = articles.where(F.col("pmid") == a.pmid)
    steps = {
        "link": lambda t: stages.link_articles(t["articles"]),
        "discover": lambda t: stages.discover(t["link"]).withColumn("row_id", F.struct("pmid", "sentence_no")),
        "review": lambda t: stages.review(t["discover"]),
    }
    run = stages.Runner(steps, {"articles": articles}, a.out, a.force, a.profile, inputs={"articles": f"{a.articles} {getattr(a, 'pmid', '')}"})
    run.run(a.first, a.last)
    return 0


def qc(spark: SparkSession, a: argparse.Namespace) -> int:
    """Export rows against a sequence: the reference bases, or five bases of context."""
    from lociflow.plans import delivery
    from lociflow.sources import readers

    rows = _read(spark, a.input).withColumn("__row", F.monotonically_increasing_id())
    check = delivery.check_alleles if a.command == "qc-refalt" else delivery.with_context
    return _table(check(rows, readers.fasta(spark, a.fasta), "__row").drop("__row"), a.out)


#: Command, what runs it, paths that it needs, and further options (name, settings).
_RUN = [("--from", {"dest": "first"}), ("--to", {"dest": "last"}), ("--force", {"action": "store_true"}), ("--profile", {"default": "strict", "choices": ("strict", "custom", "resume")})]
COMMANDS: list[tuple[str, Callable[[SparkSession, argparse.Namespace], int], tuple[str, ...], list]] = [
    ("compare", compare, ("gold", "candidate"), []),
    ("bootstrap", bootstrap, ("reference", "out"), []),
    ("stamp", stamp, ("input", "out"), []),
    ("link", link, ("articles", "out"), []),
    ("enrich", enrich, ("fulltext", "articles", "out"), [("--format", {"default": "jats", "choices": ("jats", "html", "bioc", "plain")})]),
    ("materialize", materialize, ("input", "out"), []),
    ("discovery", discovery, ("links", "out"), []),
    ("filter", filter_rows, ("links", "out"), [("--tier", {"default": "extended", "choices": ("strict", "extended")}), ("--profile", {"default": "strict", "choices": ("strict", "audit", "custom")}), ("--gates", {"help": "states by gate, as JSON"})]),
    ("journal", journal, ("input", "journals", "out"), []),
    ("pathogenicity", pathogenicity, ("input", "texts", "out"), []),
    ("negatives", negatives, ("articles", "anchors", "positives", "out"), [("--independent", {"action": "store_true"})]),
    ("export", export, ("input", "out"), [("--reference", {}), ("--index", {})]),
    ("deliver", deliver, ("input", "out"), [("--step", {"default": "all", "choices": ("all", "new-site", "audit", "html", "review-export")}), ("--articles", {}), ("--notes", {})]),
    ("pipeline", pipeline, ("articles", "out"), _RUN),
    ("single", pipeline, ("articles", "out", "pmid"), _RUN),
    ("qc-refalt", qc, ("input", "fasta", "out"), []),
    ("qc-context", qc, ("input", "fasta", "out"), []),
]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lociflow", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, run, paths, options in COMMANDS:
        sub = commands.add_parser(name, help=(run.__doc__ or "").strip().splitlines()[0])
        sub.set_defaults(run=run)
        for p in paths:
            sub.add_argument(f"--{p}", required=True)
        for option, settings in options:
            sub.add_argument(option, **settings)
    a = parser.parse_args(argv)
    if a.command == "export" and not (a.reference or a.index):
        parser.error("export needs --reference or --index")
    return a.run(SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
