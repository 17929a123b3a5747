"""The extractors as functions of SQL: table functions for ``LATERAL`` and scalar functions, registered by name.

Table functions plan their schema from the types of their arguments, so a wrong argument fails before a row is read; their rows come
in batches of many arguments, as an Arrow batch would be one argument's.  ``register`` makes all of them known to a session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from lociflow.functions import alleles, genes, spans


def _table_function(row: T.StructType, extract: Callable[..., list[dict]], n_arguments: int):
    """A table function of ``n_arguments`` strings that returns the rows of ``extract``."""
    names = row.fieldNames()

    class Extract:
        @staticmethod
        def analyze(*arguments: AnalyzeArgument) -> AnalyzeResult:
            if len(arguments) != n_arguments:
                raise ValueError(f"expected {n_arguments} arguments, found {len(arguments)}")
            for k, a in enumerate(arguments):
                if not isinstance(a.dataType, T.StringType | T.NullType):
                    raise ValueError(f"argument {k + 1} must be a string, not {a.dataType.simpleString()}")
            return AnalyzeResult(row)

        def eval(self, *arguments: str | None) -> Iterator[tuple]:
            for found in extract(*arguments):
                yield tuple(found[n] for n in names)

    return udtf(Extract, useArrow=False)


def table_functions() -> dict:
    """Name to table function: spans, links, links of passages, negative evidence, genomic names and paired names of a text."""
    pair = T.StructType([T.StructField("name", T.StringType()), T.StructField("partner", T.StringType())])
    locus = alleles.genomic_spans.returnType.elementType
    return {
        "text_spans": _table_function(spans.SPAN, lambda text: spans.find_spans(text or ""), 1),
        "sentence_links": _table_function(spans.LINK, lambda text: spans.sentence_links(text or ""), 1),
        "passage_links": _table_function(spans.LINK, lambda text: spans.passage_links(text or ""), 1),
        "negative_evidence": _table_function(spans.NEGATIVE, lambda text, anchor: spans.negatives_in(text or "", anchor), 2),
        "genomic_names": _table_function(locus, lambda text: alleles.literal_spans(text), 1),
        "paired_names": _table_function(pair, lambda text: [{"name": a, "partner": b} for a, b in spans.paired_names(text)], 1),
    }


def scalar_functions() -> dict:
    """Name to scalar function: the variants of a text, the gene of a variant, the parts and keys of names, alleles written out."""
    return {
        "variants_scanned": spans.variants_scanned,
        "gene_of_variant": genes.gene_for,
        "variant_parts": alleles.components_with_evidence,
        "protein_keys": alleles.protein_key_list,
        "literal_allele": alleles.literal,
        "region_of_sentence": alleles.region_of_sentence,
    }


def register(spark: SparkSession) -> list[str]:
    """Make all functions known to the session's SQL; returns their names."""
    tables, scalars = table_functions(), scalar_functions()
    for name, f in tables.items():
        spark.udtf.register(name, f)
    for name, f in scalars.items():
        spark.udf.register(name, f)
    return [*tables, *scalars]
